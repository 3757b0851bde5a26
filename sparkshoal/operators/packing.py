"""Far too many small files: consolidation into few well-sized ones.

Small files are read as combined splits (partition size and the cost of opening
a file set for the purpose), brought to the wanted number of tasks by coalesce
without a shuffle, written to a staging folder of the shared file system, and
verified against the source (rows, bytes and a checksum that ignores order)
before the folder takes its final name. A failed check leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkshoal.functions.text import file_stem, is_blank, strip_space
from sparkshoal.session import put_in_place, remove_path, scratch_path, settings, table
from sparkshoal.sources.listing import listed

#: Groups of exact copies up to this size are paired in one row, larger ones by a join, or on request with their first file only.
PAIRED = 64
HOT = 1000  # groups with more than this part of all files are hot; there are at most as many
SPREAD = 32  # parts the pairs of a large group are spread over


@dataclass
class Packed:
    """What a consolidation wrote."""

    path: str
    files: int
    rows: int
    source_splits: int


def _summary(df: DataFrame, check: list[str]) -> tuple[int, int, int]:
    """Rows, bytes of text, and an order-free checksum over the columns ``check``."""
    size = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in check), F.lit(0))
    hashed = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in check])
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b"), F.coalesce(F.sum(hashed.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.b, int(r.h)


def pack(spark: SparkSession, read: Callable[[], DataFrame], path: str, check: list[str], target_bytes: int = 128 << 20, open_cost: int = 1 << 20, expand: float = 1.0) -> Packed:
    """Consolidate what ``read()`` reads (a lazy scan of many small files) into Parquet files of about ``target_bytes``.

    ``open_cost`` is what opening one file counts for when splits are combined;
    ``expand`` is output bytes per byte read. The number of files follows the
    bytes of the source, so it grows with the data and a task's share does not.
    An empty source gives an empty table. Raises ValueError, leaving nothing,
    if rows, bytes or checksum of the staged output differ from the source.
    """
    staging = f"{path}.staging"
    with settings(spark, spark__sql__files__maxPartitionBytes=str(int(target_bytes / max(expand, 1e-9))), spark__sql__files__openCostInBytes=str(open_cost)):
        source = read()
        splits = source.rdd.getNumPartitions()
        size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        wanted = max(1, min(splits, -(-int(size * expand) // target_bytes)))
        source.coalesce(wanted).write.mode("overwrite").parquet(staging)
        before = _summary(source, check)
        staged = spark.read.parquet(staging)
        after = _summary(staged, check)
    if before != after:
        remove_path(spark, staging)
        raise ValueError(f"staged output differs from its source: {before} and {after}")
    put_in_place(spark, staging, path)
    return Packed(path, wanted, after[0], splits)


def read_tiny_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """A folder tree of tiny text files as rows: file_path, body, n_bytes, written_at; empty files are rows too."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    full = files.select(F.col("path").alias("file_path"), F.decode("content", "UTF-8").alias("body"), F.col("length").alias("n_bytes"), F.col("modificationTime").alias("written_at"))
    empty = listed(spark, folder, glob).where("length = 0").select(F.col("path").alias("file_path"), F.lit("").alias("body"), F.col("length").alias("n_bytes"), F.col("modified").alias("written_at"))
    return full.unionByName(empty)


def canonical_lines(body: Column) -> Column:
    """Lines of a text, stripped, without empty ones, sorted; null gives none."""
    lines = F.split(F.coalesce(body, F.lit("")), r"\r\n|[\n\r\x0B\f\x{85}\x{2028}\x{2029}]")
    return F.array_sort(F.filter(F.transform(lines, strip_space), lambda x: x != ""))


def packed_labels(spark: SparkSession, files: Callable[[], DataFrame], path: str) -> DataFrame:
    """Label files packed at ``path``, each with its image's name and the digest of its lines."""
    def read() -> DataFrame:
        name = F.when(is_blank(F.col("out_name")), file_stem(F.col("file_path"))).otherwise(F.col("out_name"))
        return files().select("file_id", name.alias("image"), "file_path", "body", "n_bytes", "written_at", F.md5(F.array_join(canonical_lines(F.col("body")), "\n")).alias("digest"))

    pack(spark, read, path, ["file_id", "image", "body", "digest"])
    return spark.read.parquet(path)


def copies(packed: DataFrame, every: bool = False) -> DataFrame:
    """Pairs (lo_file_id, hi_file_id) of files of one image with the same lines.

    Up to ``PAIRED`` copies every pair is given. Of a larger group too if
    ``every``; else its copies are each paired with its first file, which
    together with the group loses no link.
    """
    files = packed.where("file_id is not null and image is not null").select("image", "digest", "file_id")
    groups = files.groupBy("image", "digest").agg(F.count_distinct("file_id").alias("n"), F.min("file_id").alias("lo"))
    several = groups.where("n > 1")
    members = files.join(several, ["image", "digest"])
    small = members.where(F.col("n") <= PAIRED).groupBy("image", "digest").agg(F.array_sort(F.collect_set("file_id")).alias("ids"))
    pairs = F.flatten(F.transform("ids", lambda a: F.transform(F.filter("ids", lambda b: b > a), lambda b: F.struct(a.alias("lo_file_id"), b.alias("hi_file_id")))))
    small_pairs = small.select(F.explode(pairs).alias("p")).select("p.*")
    large = members.where(F.col("n") > PAIRED).select("image", "digest", "file_id", "lo").distinct()
    if not every:
        return small_pairs.unionByName(large.where("file_id > lo").select(F.col("lo").alias("lo_file_id"), F.col("file_id").alias("hi_file_id")))
    los = large.select("image", "digest", F.col("file_id").alias("lo_file_id"), F.pmod(F.xxhash64("file_id"), F.lit(SPREAD)).cast("int").alias("part"))
    his = large.select("image", "digest", F.col("file_id").alias("hi_file_id"), F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"))
    return small_pairs.unionByName(los.join(his, ["image", "digest", "part"]).where("lo_file_id < hi_file_id").select("lo_file_id", "hi_file_id"))


def copy_classes(packed: DataFrame) -> DataFrame:
    """Each file with the class of its copies: file_id, image, class_id (the smallest file_id of its image with the same lines), links (how many other files are in it).

    The form in which a group of copies of any size can be read whole: rows grow
    with the files, not with the pairs. Files are counted by (image, lines) on
    the map side, so a hot group is a few rows before it is joined. Null file_ids
    and files without an image's name give nothing; a repeated file_id counts once.
    """
    files = packed.where("file_id is not null and image is not null").select("file_id", "image", "digest").distinct()
    groups = files.groupBy("image", "digest").agg(F.min("file_id").alias("class_id"), (F.count("*") - 1).alias("links"))
    # Copies are looked up by broadcast where one group holds a large part of all files (at most ``HOT`` such groups), by a join otherwise.
    many = files.count() // HOT
    hot = groups.where(F.col("links") >= max(many, PAIRED))
    joined = files.join(F.broadcast(hot), ["image", "digest"]).unionByName(files.join(groups.where(F.col("links") < max(many, PAIRED)), ["image", "digest"]))
    return joined.select("file_id", "image", "class_id", "links")


def current_records(packed: DataFrame) -> DataFrame:
    """One record for each image: its last written file (ties and null times: the largest file_id), with its number of files."""
    newest = F.max(F.struct("written_at", "file_id", "body", "digest"))
    return packed.where("image is not null").groupBy("image").agg(newest.alias("r"), F.count("*").alias("files")).select("image", "r.file_id", "r.body", "r.digest", "files")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "p6-packed")
    return copies(packed_labels(spark, lambda: table(spark, sf_dir, "label_files"), path), every=True)


def p6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "p6-packed")
    records = current_records(packed_labels(spark, lambda: table(spark, sf_dir, "label_files"), path))
    return records.select("image", "file_id", "files", F.array_join(canonical_lines(F.col("body")), "\n").alias("lines"))


def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every label file with the class of its copies and its number of links."""
    path = scratch_path(spark, "p6-packed")
    return copy_classes(packed_labels(spark, lambda: table(spark, sf_dir, "label_files"), path))


def p6_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the consolidation did: rows kept, images covered, files listed and files written are consistent."""
    path = scratch_path(spark, "p6-packed")
    packed = packed_labels(spark, lambda: table(spark, sf_dir, "label_files"), path)
    return packed.agg(F.count("*").alias("files_in"), F.countDistinct("file_id").alias("file_ids"), F.countDistinct("image").alias("images"), F.sum(F.length("body")).alias("body_chars"))
