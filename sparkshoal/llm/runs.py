"""Repeated consecutive events in sequences, collapsed into one event each.

Each event is compared with its predecessor by a lag window, changes are
flagged, the running sum of flags numbers the runs, and runs are aggregated.
Events are range-partitioned by sequence and place, and each partition's part of
a sequence is a block, worked on by itself. So a sequence with a third of all
rows spreads over many tasks, however its positions are clumped; runs that go on
across the edge of a block are joined by the same lag comparison over the
blocks' ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkshoal.functions.text import file_stem, group_of
from sparkshoal.session import checkpointed, table


def near(a: Column, b: Column, bits: int) -> Column:
    """At most ``bits`` of 64 bits differ; null compares as different."""
    return F.coalesce(F.bit_count(a.bitwiseXOR(b)) <= bits, F.lit(False))


def collapse(events: DataFrame, sequence: list[str], position: str | list[str], event: str, key: str, time: str, bits: int = 6, least: int = 2, parts: int | None = None) -> DataFrame:
    """Runs of at least ``least`` consecutive events, each within ``bits`` bits of the one before.

    ``position`` (a column or several, of any type with an order) orders a
    sequence, ties go by ``key`` (long). Events with a null position, event or
    key are passed over. Null sequence columns are a value like any other.
    Result: the sequence columns, lo_key, hi_key, events, first_position,
    last_position (of several columns: structs), started_us, duration_s (between
    the earliest and latest known time; null if none is known). Other columns are
    ignored. ``parts`` is the number of ranges (the session's if null); the
    result doesn't depend on it.
    """
    s = [f"s{i}" for i in range(len(sequence))]
    order = [position] if isinstance(position, str) else list(position)
    p = [f"p{i}" for i in range(len(order))]
    rows = events.select(*[F.col(c).alias(a) for c, a in zip(sequence, s)], *[F.col(c).alias(a) for c, a in zip(order, p)], F.col(event).alias("ev"), F.col(key).alias("k"), F.col(time).alias("t"))
    rows = rows.where(" and ".join(f"{c} is not null" for c in [*p, "ev", "k"]))
    ranges = [*s, *p, "k"]
    placed = rows.repartitionByRange(*ranges) if parts is None else rows.repartitionByRange(parts, *ranges)
    rows = placed.withColumn("block", F.spark_partition_id())
    inside = Window.partitionBy(*s, "block").orderBy(*p, "k")
    flagged = rows.withColumn("change", (~near(F.col("ev"), F.lag("ev").over(inside), bits)).cast("int"))
    numbered = flagged.withColumn("run", F.sum("change").over(inside))
    at = F.struct(*p, "k", "ev")
    # Written down, so that runs and ends come from the same blocks; a row for each run.
    runs = checkpointed(events.sparkSession, numbered.groupBy(*s, "block", "run").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"), F.min(at).alias("first"), F.max(at).alias("last"), F.min("t").alias("t0"), F.max("t").alias("t1")))
    # The ends of each block: does its first run go on from the block before?
    ends = runs.groupBy(*s, "block").agg(F.max("run").alias("runs"), F.min_by("first", "run").alias("first"), F.max_by("last", "run").alias("last"))
    across = Window.partitionBy(*s).orderBy("block")
    goes_on = near(F.col("first.ev"), F.lag("last.ev").over(across), bits)
    ends = ends.withColumn("goes_on", goes_on)
    # The block where the run open at a block's end began: its own, unless all of it is one run that goes on.
    origin = F.max(F.when(~(F.col("goes_on") & (F.col("runs") == 1)), F.struct("block", "runs"))).over(across.rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.withColumn("origin", origin).where("goes_on").select(*[F.col(c).alias(f"e_{c}") for c in s], F.col("block").alias("e_block"), "origin")
    same = (F.col("block") == F.col("e_block")) & (F.col("run") == 1)
    for c in s:
        same = same & F.col(c).eqNullSafe(F.col(f"e_{c}"))
    home = F.coalesce("origin", F.struct("block", F.col("run").alias("runs")))
    joined = runs.join(ends, same, "left").select(*s, home.alias("home"), "n", "lo", "hi", "first", "last", "t0", "t1")
    whole = joined.groupBy(*s, "home").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("first").alias("first"), F.max("last").alias("last"), F.min("t0").alias("t0"), F.max("t1").alias("t1"))
    place = lambda e: F.col(f"{e}.p0") if len(p) == 1 else F.struct(*[F.col(f"{e}.{a}").alias(c) for a, c in zip(p, order)])
    seconds = F.round((F.unix_micros("t1") - F.unix_micros("t0")) / 1e6, 6)
    return whole.where(F.col("n") >= least).select(*[F.col(a).alias(c) for c, a in zip(sequence, s)], F.col("lo").alias("lo_key"), F.col("hi").alias("hi_key"), F.col("n").alias("events"), place("first").alias("first_position"), place("last").alias("last_position"), F.unix_micros("t0").alias("started_us"), seconds.alias("duration_s"))


def frames(samples: DataFrame) -> DataFrame:
    """Samples as frames of their groups: each sample_id once (its first arrival), numbered by the last number in the file's stem.

    A number of any length counts: frames are ordered by its length without
    leading zeros (``size``), then by its digits. Names without a number have no
    place (null).
    """
    first = samples.where("sample_id is not null").groupBy("sample_id").agg(F.min(F.struct("ingested_at", "dataset", "group_key", "image_path", "dhash", "captured_at")).alias("r")).select("sample_id", "r.*")
    digits = F.nullif(F.regexp_replace(F.regexp_extract(file_stem(F.col("image_path")), r"(\d+)\D*$", 1), r"^0+(?=\d)", ""), F.lit(""))
    return first.select("sample_id", "dataset", group_of(F.col("group_key"), F.col("image_path")).alias("group_name"), F.length(digits).alias("size"), digits.alias("frame"), "dhash", "captured_at")


def p5_events(spark, sf_dir: str) -> DataFrame:
    found = collapse(frames(table(spark, sf_dir, "samples")), ["dataset", "group_name"], ["size", "frame"], "dhash", "sample_id", "captured_at")
    frame = lambda c: F.col(f"{c}.frame").try_cast("bigint")
    return found.withColumns({"first_position": frame("first_position"), "last_position": frame("last_position")}).withColumnsRenamed({"lo_key": "lo_sample_id", "hi_key": "hi_sample_id", "events": "frames", "first_position": "first_frame", "last_position": "last_frame"})


def p5_found(spark, sf_dir: str) -> DataFrame:
    return p5_events(spark, sf_dir).select("lo_sample_id", "hi_sample_id")
