"""Session helpers: loading tables, the shared scratch folder, scoped settings."""

from __future__ import annotations

import contextlib
import sys
import tempfile
import types
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share: ``spark.checkpoint.dir``.

    Where that is unset, a local master gets a temporary folder; any other raises
    RuntimeError, as its executors share no such folder.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if where is None and current.isDefined():
        return current.get().rstrip("/")
    if where is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder there that all executors share")
        where = tempfile.mkdtemp(prefix="sparkshoal-")
    if not current.isDefined():
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a staged table in the shared folder; it goes when the driver ends, as lazy results may read it till then."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    jvm = spark.sparkContext._jvm
    p, q = jvm.org.apache.hadoop.fs.Path(old), jvm.org.apache.hadoop.fs.Path(new)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(p, q):
        raise OSError(f"cannot move {old} to {new}")


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """A staged folder takes its final name. What was there is moved aside first and goes last, so a job that dies between loses nothing."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    aside = f"{path}.before-{uuid.uuid4().hex}"
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    if there:
        rename_path(spark, path, aside)
    rename_path(spark, staged, path)
    if there:
        remove_path(spark, aside)


def checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(spark)
    return df.checkpoint(eager=True)


def worker_cache() -> dict:
    """What a Python worker keeps from task to task (functions sent by value get new globals with every task)."""
    return sys.modules.setdefault("_sparkshoal_worker", types.ModuleType("_sparkshoal_worker")).__dict__.setdefault("kept", {})


@contextlib.contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings (dots written as double underscores) for the length of a block."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
