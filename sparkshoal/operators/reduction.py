"""Thinning of sequences: order, stride, near-duplicates, rarity cap, budgets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sparkshoal.operators.ranking import spread_row_number
from sparkshoal.session import checkpointed

BLOCK = 50_000  # hashes of one group that a task decides at once
MOST_IN_A_TASK = 100_000  # rows that one task may sort


def stride(items: DataFrame, groups: list[str], order: list[str], step: int | Column) -> DataFrame:
    """Every ``step``-th row of each group in order, from the first; a step up to 1, or null, keeps all. A column gives each row's step."""
    if isinstance(step, int) and step <= 1:
        return items
    every = F.greatest(F.coalesce(F.lit(step), F.lit(1)), F.lit(1))
    return spread_row_number(items, groups, order, "_rn").where((F.col("_rn") - 1) % every == 0).drop("_rn")


def _leaders(groups: list[str], value: str, threshold: str) -> Callable:
    def run(batches):
        current, kept, n = None, np.zeros(1024, dtype=np.uint64), 0
        for batch in batches:
            take = np.zeros(batch.num_rows, dtype=bool)
            keys = zip(*[batch.column(g).to_pylist() for g in groups])
            limits = batch.column(threshold).to_pylist()
            values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for i, (key, v, limit) in enumerate(zip(keys, values, limits)):
                if key != current:
                    current, n = key, 0
                if n and np.bitwise_count(kept[:n] ^ v).min() <= limit:
                    continue
                if n == len(kept):
                    kept = np.concatenate([kept, np.zeros_like(kept)])
                kept[n] = v
                n += 1
                take[i] = True
            yield batch.filter(pa.array(take))

    return run


def _apart(value: str, threshold: str) -> Callable:
    """Of a block's rows those that lie further than their threshold from every kept hash."""

    def run(rows: pa.Table, heads: pa.Table) -> pa.Table:
        v = rows.column(value).to_numpy().astype(np.int64).view(np.uint64)
        limit = rows.column(threshold).to_numpy()
        h = heads.column("_head").to_numpy().astype(np.int64).view(np.uint64) if heads.num_rows else np.zeros(0, dtype=np.uint64)
        take = np.ones(len(v), dtype=bool)
        for at in range(0, len(h), 512):
            live = np.flatnonzero(take)
            near = np.bitwise_count(v[live, None] ^ h[None, at : at + 512]).min(axis=1) <= limit[live]
            take[live[near]] = False
        return rows.filter(pa.array(take))

    return run


def _in_blocks(rows: DataFrame, groups: list[str], order: list[str], value: str, block: int) -> DataFrame:
    """``near_duplicates`` of rows whose groups are too large for a task.

    Rows are cut into blocks of their group's order. In turn the next blocks, as
    many as hold ``block`` undecided rows, are decided in one task a group, and
    what they keep is held against all later blocks of the group side by side.
    So no task has more than ``block`` rows and as many kept hashes, and each
    pair of hashes is compared at most once, as in the plain loop.
    """
    spark, schema = rows.sparkSession, rows.schema
    part = max(1, block // 4)
    left = spread_row_number(rows, groups, order, "_rn").withColumn("_block", F.floor((F.col("_rn") - 1) / part)).drop("_rn")
    left = checkpointed(spark, left)
    keep: list[DataFrame] = []
    while True:
        sizes = left.groupBy(*groups, "_block").agg(F.count("*").alias("n"))
        so_far = F.sum("n").over(Window.partitionBy(*groups).orderBy("_block"))
        ends = [(r["_block"], r["n"]) for r in sizes.withColumn("n", so_far).groupBy("_block").agg(F.max("n").alias("n")).orderBy("_block").collect()]  # one row a block
        if not ends:
            break
        last = max([b for b, n in ends if n <= block], default=ends[0][0])
        now = left.where(F.col("_block") <= last).drop("_block").repartition(*groups).sortWithinPartitions(*groups, *order)
        kept = checkpointed(spark, now.mapInArrow(_leaders(groups, value, "_bits"), T.StructType(schema.fields)))
        keep.append(kept)
        later = left.where(F.col("_block") > last)
        if ends[-1][0] <= last:
            break
        named = [f"_g{i}" for i in range(len(groups))]
        placed = [f"_h{i}" for i in range(len(groups))]
        places = later.select(*[F.col(g).alias(n) for g, n in zip(groups, placed)], F.col("_block").alias("_at")).distinct()
        on = F.lit(True)
        for p, n in zip(placed, named):
            on = on & F.col(p).eqNullSafe(F.col(n))
        heads = places.join(kept.select(*[F.col(g).alias(n) for g, n in zip(groups, named)], F.col(value).alias("_head")), on).select(*placed, "_at", "_head")
        left = checkpointed(spark, later.groupBy(*groups, "_block").cogroup(heads.groupBy(*placed, "_at")).applyInArrow(_apart(value, "_bits"), later.schema))
    out = keep[0] if keep else rows.limit(0)
    for k in keep[1:]:
        out = out.unionByName(k)
    return out


def near_duplicates(items: DataFrame, groups: list[str], order: list[str], value: str, threshold: int | Column, block: int = BLOCK) -> DataFrame:
    """Rows left when each is dropped that lies within ``threshold`` bits of an earlier kept row of its group.

    Not transitive: a row is held only against kept ones. Rows with a null hash
    go; a threshold up to 0, or null, keeps all rows as they are. A column gives
    the threshold, the same for all rows of a group. Of rows with one hash only
    the first can stay, so the others are taken out before anything is gathered.
    The rest of a group of up to ``block`` hashes streams through one task in
    order, which holds kept hashes only; larger groups go block by block (see
    ``_in_blocks``), with the same rows in the end. ``groups`` must not be empty.
    """
    if isinstance(threshold, int) and threshold <= 0:
        return items
    bits = F.coalesce(F.lit(threshold), F.lit(0)).cast("int")
    left_alone = items.where(bits <= 0) if isinstance(threshold, Column) else None
    whole = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate([*order, *items.columns])], bits.alias("bits"))
    firsts = items.where(F.col(value).isNotNull() & (bits > 0)).groupBy(*[F.col(g).alias(f"g{i}") for i, g in enumerate(groups)], F.col(value).alias("v")).agg(F.min(whole).alias("r"))
    n = len(order)
    rows = firsts.select(*[F.col(f"r.c{n + i}").alias(c) for i, c in enumerate(items.columns)], F.col("r.bits").alias("_bits"))
    whole_groups = lambda r: r.repartition(*groups).sortWithinPartitions(*groups, *order).mapInArrow(_leaders(groups, value, "_bits"), T.StructType(rows.schema.fields))
    large = items.where(F.col(value).isNotNull() & (bits > 0)).groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]).agg(F.count("*").alias("_n")).where(F.col("_n") > block).drop("_n")
    if large.take(1):
        same = F.lit(True)
        for i, g in enumerate(groups):
            same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
        rows = checkpointed(items.sparkSession, rows)
        large = checkpointed(items.sparkSession, large)
        out = whole_groups(rows.join(large, same, "left_anti")).unionByName(_in_blocks(rows.join(large, same, "left_semi"), groups, order, value, block))
    else:
        out = whole_groups(rows)
    out = out.drop("_bits")
    return out if left_alone is None else out.unionByName(left_alone)


def rarity(labels: DataFrame, item: str, label: str, per: list[str]) -> DataFrame:
    """Rarity of each item: the sum over its labels of all labels over those of the same class, rounded to nine decimals."""
    freq = labels.groupBy(*per, label).agg(F.count("*").alias("_n"))
    weight = freq.withColumn("_w", F.sum("_n").over(Window.partitionBy(*per)) / F.col("_n"))  # one row a class
    counts = labels.groupBy(*per, item, label).agg(F.count("*").alias("_k")).join(weight, [*per, label])
    ordered = F.array_sort(F.collect_list(F.struct(F.col(label).alias("l"), (F.col("_k") * F.col("_w")).alias("v"))))
    return counts.groupBy(*per, item).agg(F.round(F.aggregate(ordered, F.lit(0.0), lambda acc, x: acc + x["v"]), 9).alias("rarity"))


def capped(items: DataFrame, source: list[str], group: str, order: list[str], limit: int | Column | None, first: str = "seq") -> DataFrame:
    """At most ``limit`` rows of each source, taken in turns from its groups, each group's rarest rows first.

    ``items`` has ``rarity`` (null counts as 0) and a sequence number ``first``; groups take turns in
    order of their first appearance. No limit, 0, or no more rows than it: all stay. A column gives each source's limit.
    """
    if limit is None or isinstance(limit, int) and not limit:
        return items
    most = F.coalesce(F.nullif(F.lit(limit), F.lit(0)), F.lit((1 << 31) - 1))
    placed = items.withColumn("_less", -F.coalesce("rarity", F.lit(0.0)))
    ranked = spread_row_number(placed, [*source, group], ["_less", *order], "_rn").where(F.col("_rn") <= most)  # ranks beyond the limit can't be taken
    heads = items.groupBy(*source, group).agg(F.min(first).alias("_head"))
    turns = ranked.join(heads, [*source, group]).select(*items.columns, "_rn", "_head")
    return spread_row_number(turns, source, ["_rn", "_head", group], "_turn").where(F.col("_turn") <= most).select(*items.columns)


def first_of_each(items: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    if n > 1000:  # more than the optimizer keeps short on the map side
        return spread_row_number(items, [group], order, "_rn").where(F.col("_rn") <= n).drop("_rn")
    return items.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def round_robin(items: DataFrame, concept: str, concept_ord: str, order: list[str], key: str, budget: int, done: DataFrame | None = None) -> DataFrame:
    """Up to ``budget`` distinct keys, concepts taking turns; the first concept to reach a key owns it.

    ``done`` (column ``key``) lists keys already had; they are skipped and use up
    budget. Result: the rows of ``items`` that are taken, with ``turn``.
    """
    placed = spread_row_number(items, [concept], order, "_rn")
    owner = F.min(F.struct(F.col("_rn").alias("_a"), F.col(concept_ord).alias("_b"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(items.columns)]))
    owned = placed.groupBy(F.col(key).alias("_key")).agg(owner.alias("r")).select(F.col("r._a").alias("turn"), *[F.col(f"r.c{i}").alias(c) for i, c in enumerate(items.columns)])
    left = budget
    if done is not None:
        keys = done.select(F.col(key)).distinct()
        owned = owned.join(keys, key, "left_anti")
        left = max(0, budget - keys.count())
    return first_rows(owned, ["turn", concept_ord], left)


def first_rows(items: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in order. More than one task should sort are found by their row numbers, over many tasks."""
    if n <= MOST_IN_A_TASK:
        return items.orderBy(*order).limit(n)
    return spread_row_number(items, [], order, "_rn").where(F.col("_rn") <= n).drop("_rn")
