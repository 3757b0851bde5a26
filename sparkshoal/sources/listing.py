"""File listings: image lookup and layout resolution over a DataFrame of paths."""

from __future__ import annotations

import fnmatch
import os
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkshoal.functions.text import file_name, file_stem

IMAGE_TYPES = [".jpg", ".jpeg", ".png", ".bmp", ".tif", ".tiff", ".webp"]  # in order of preference (fixed values)


def listed(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Files under a folder, empty ones too: path, length, modified; contents are not read.

    One task lists the top level, many walk what lies below; the driver lists
    nothing. (Spark's own file sources leave empty files out.)
    """
    from pyarrow import fs as pfs

    uri = folder if "://" in folder else Path(folder.removeprefix("file:")).resolve().as_uri()
    _, root = pfs.FileSystem.from_uri(uri)
    lead = uri[: len(uri) - len(root.lstrip("/"))].rstrip("/") + "/" if not uri.startswith("file:") else "file:///"

    def level(batches):
        import pandas as pd
        from pyarrow import fs

        own, _ = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for path in batch["path"]:
                top = own.get_file_info(fs.FileSelector(path))
                for at in range(0, len(top), 50_000):
                    yield pd.DataFrame([(x.path, x.type == fs.FileType.Directory, x.size or 0, x.mtime_ns // 1000 if x.mtime_ns else 0) for x in top[at : at + 50_000]], columns=["path", "is_folder", "length", "micros"])

    def walk(batches):
        import pandas as pd
        from pyarrow import fs

        own, _ = fs.FileSystem.from_uri(uri)
        for batch in batches:
            rows = []
            for path, is_folder, length, micros in zip(batch["path"], batch["is_folder"], batch["length"], batch["micros"]):
                found = [(x.path, x.size, x.mtime_ns // 1000) for x in own.get_file_info(fs.FileSelector(path, recursive=True)) if x.type == fs.FileType.File] if is_folder else [(path, length, micros)]
                rows += [(lead + p.lstrip("/"), n, t) for p, n, t in found if fnmatch.fnmatchcase(p.rsplit("/", 1)[-1], glob)]
            yield pd.DataFrame(rows, columns=["path", "length", "micros"])

    tops = spark.createDataFrame([(root,)], "path string").mapInPandas(level, "path string, is_folder boolean, length long, micros long").repartition("path")
    return tops.mapInPandas(walk, "path string, length long, micros long").select("path", "length", F.timestamp_micros("micros").alias("modified"))


def find_images(wanted: DataFrame, name: str, listing: DataFrame, folder: str) -> DataFrame:
    """``wanted`` with ``image_path``: the file of that name (or relative path) in ``folder``, else one of the same stem there with an image's extension, else one anywhere below.

    Ties go by extension in the order of ``IMAGE_TYPES``, then by path. Null if there is none.
    """
    base = folder.rstrip("/")
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    rank = F.array_position(F.array(*[F.lit(x) for x in IMAGE_TYPES]), ext)
    files = listing.select("path", file_name(F.col("path")).alias("_file"), file_stem(F.col("path")).alias("_stem"), rank.alias("_rank"), F.regexp_replace("path", r"^(file:)?/*" + "(?:" + re.escape(base.replace("file:", "").lstrip("/")) + r")/", "").alias("_rel"))
    files = files.withColumn("_direct", F.col("_rel") == F.col("_file"))
    w = wanted.withColumn("_want_stem", file_stem(F.col(name)))
    hits = w.join(files, F.col("_want_stem") == F.col("_stem"))
    literal = F.col("_rel") == F.col(name)
    tier = F.when(literal, 0).when(F.col("_direct") & (F.col("_rank") > 0), 1).when(F.col("_rank") > 0, 2)
    best = hits.withColumn("_tier", tier).where("_tier is not null").groupBy(F.col(name).alias("_name")).agg(F.min(F.struct("_tier", "_rank", "path")).alias("_best"))
    out = w.join(best, F.col(name) == F.col("_name"), "left").withColumn("image_path", F.col("_best.path"))
    return out.drop("_want_stem", "_name", "_best")


def resolve_path(root: str, pattern: str, folder: bool = False) -> str | None:
    """A layout entry below ``root``: as written, as a glob, by base name anywhere, then without regard to case; fewest parts first, then alphabetically."""
    base = Path(root)
    right = (lambda p: p.is_dir()) if folder else (lambda p: p.is_file())
    if "*" not in pattern and right(base / pattern):
        return str(base / pattern)
    everything = [Path(d) / n for d, dirs, files in os.walk(base) for n in (dirs if folder else files)]
    name = Path(pattern).name
    best = lambda ps: min(ps, key=lambda p: (len(p.parts), str(p)), default=None)
    for test in (lambda p: fnmatch.fnmatchcase(p.relative_to(base).as_posix(), pattern), lambda p: fnmatch.fnmatchcase(p.name, name), lambda p: fnmatch.fnmatchcase(p.name.lower(), name.lower())):
        hit = best([p for p in everything if test(p) and right(p)])
        if hit is not None:
            return str(hit)
    return None
