"""Audit of raw file trees: duplicates, collisions, extensions, folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkshoal.functions.text import file_name


def extension_counts(files: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent file extensions of each top folder."""
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    counts = files.groupBy("folder", ext.alias("ext")).agg(F.count("*").alias("files"))
    rank = F.row_number().over(Window.partitionBy("folder").orderBy(F.desc("files"), "ext"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n)


def name_collisions(files: DataFrame, path: str = "path") -> DataFrame:
    """Base names that occur more than once."""
    return files.groupBy(file_name(F.col(path)).alias("name")).agg(F.count("*").alias("files")).where("files > 1")


def exact_duplicates(files: DataFrame, size: str, content: str) -> DataFrame:
    """Groups of files with the same size, not zero, and MD5: size, md5, files, redundant (files less one).

    Contents are hashed only where sizes meet: the sizes that occur twice are
    found first without reading contents, then decide what is hashed. The
    content itself never crosses a shuffle.
    """
    files = files.where(F.col(size) > 0)
    sizes = files.groupBy(F.col(size).alias("_size")).agg(F.count("*").alias("_n")).where("_n > 1").select("_size")
    hashed = files.select(F.col(size).alias("_size"), F.md5(content).alias("md5")).join(sizes, "_size", "left_semi")
    groups = hashed.groupBy(F.col("_size").alias("size"), "md5").agg(F.count("*").alias("files")).where("files > 1")
    return groups.withColumn("redundant", F.col("files") - 1)


def tree_summary(files: DataFrame, folders: int = 40, examples: int = 6) -> tuple[DataFrame, DataFrame]:
    """Folders with most images, and the first annotation files of each extension."""
    image = F.lower("path").rlike(r"\.(jpe?g|png|bmp|tiff?|webp)$")
    parent = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    dirs = files.where(image).groupBy(parent.alias("folder")).agg(F.count("*").alias("images")).orderBy(F.desc("images"), "folder").limit(folders)
    ext = F.lower(F.regexp_extract("path", r"(\.(?:json|xml|txt|csv|ya?ml|mat))$", 1))
    notes = files.withColumn("ext", ext).where("ext <> ''").withColumn("rank", F.row_number().over(Window.partitionBy("ext").orderBy("path"))).where(F.col("rank") <= examples)
    return dirs, notes.select("ext", "path", "rank")
