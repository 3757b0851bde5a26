"""Joins to a table of one row a key that hold where one key has a large part of all rows, and joins that ask only whether a key is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkshoal.operators.labels import small

HOT = 1000  # keys with more than this part of all rows are hot: there are fewer than this many, however many rows there are
FEW = 100_000  # rows of one key that one task takes without trouble


def looked_up(rows: DataFrame, keys: list[str], table: DataFrame, few: int = FEW) -> DataFrame:
    """``rows`` left-joined to ``table``, which has one row for each value of ``keys``, a hot key's rows staying where they are.

    Keys are counted (on the map side first). Those with more than a
    ``HOT``-th of all rows, fewer than ``HOT`` in number, are looked up in a
    broadcast part of the table; all others are joined by a shuffle, which no key
    can then skew. Null keys find nothing. ``rows`` is read up to three times, so
    it should be cheap to read. Columns of the table beside the keys must have
    names of their own.
    """
    counts = rows.where(F.lit(True) & ~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))).groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = counts.where(F.col("_n") > max(few, rows.count() // HOT)).drop("_n")
    if not hot.take(1):
        return rows.join(table, keys, "left")
    hot = F.broadcast(hot)  # fewer than HOT rows
    return rows.join(hot, keys, "left_anti").join(table, keys, "left").unionByName(rows.join(hot, keys, "left_semi").join(F.broadcast(table.join(hot, keys, "left_semi")), keys, "left"))


def not_in(items: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Items whose keys ``done`` doesn't have (what is still to do); an item with a null key stays."""
    return items.join(done.select(*keys).distinct(), keys, "left_anti")


def flagged(items: DataFrame, known: DataFrame, key: str, name: str = "known") -> DataFrame:
    """Items with a flag that says whether ``known`` has their key; a null key is not known."""
    return items.join(small(known.select(key).where(F.col(key).isNotNull()).distinct().withColumn(name, F.lit(True))), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` (the same columns) doesn't have; nulls equal nulls."""
    return a.distinct().exceptAll(b.distinct())
