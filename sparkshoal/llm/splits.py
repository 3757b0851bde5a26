"""Splits that keep related records together.

Records that share any attribute value (group, author, source, entity) form one
component. Components come from a distributed union-find: every partition
builds a forest of its own links, forests are merged level by level over fewer
partitions, and a level never holds more links in a task than ``task_edges``.
Components then go, largest first, to the split furthest below its target.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkshoal.functions.keys import stable_bucket
from sparkshoal.functions.text import group_of, split_name
from sparkshoal.operators.lookup import looked_up
from sparkshoal.session import checkpointed, table

SHARES = {"train": 0.8, "val": 0.1, "test": 0.1}


def _forest(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
    """Union-find over one partition's links; yields (node, root) for every node that is no root."""
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch["node"], batch["root"]):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, r) for x in parent if (r := find(x)) != x]
    for at in range(0, len(rows), 50_000):
        yield pd.DataFrame(rows[at : at + 50_000], columns=["node", "root"])


def components(links: DataFrame, a: str, b: str, task_edges: int = 2_000_000, fan_in: int = 8) -> DataFrame:
    """Connected components of string links: one row (node, root) for each node but the roots.

    The root is the smallest node of its component. A node missing from the
    result is its own root. Null ends and self links add nothing; repeated links
    count once; an empty input gives no rows.
    """
    spark = links.sparkSession
    schema = "node string, root string"
    edges = links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    forest = checkpointed(spark, edges.mapInPandas(_forest, schema))
    parts = max(1, forest.rdd.getNumPartitions())
    while True:
        least = max(1, math.ceil(forest.count() / task_edges))
        parts = max(least, parts // fan_in, 1)
        merged = (forest.coalesce(1) if parts == 1 else forest.repartition(parts, "node")).mapInPandas(_forest, schema)
        if parts == 1:
            return checkpointed(spark, merged)
        merged = checkpointed(spark, merged)
        # Shortcut: a root that is itself a node elsewhere hands its nodes on, and stays linked to its own root.
        up = merged.groupBy("node").agg(F.min("root").alias("higher")).withColumnRenamed("node", "root")
        short = looked_up(merged, ["root"], up).select("node", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved"))
        forest = checkpointed(spark, short)
        several = forest.groupBy("node").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
        if parts == least and not forest.where("moved").take(1) and not several.take(1):
            return forest.select("node", "root").distinct()
        forest = forest.select("node", "root")


def _picks(sizes: list[tuple[int, int]], shares: Mapping[str, float]) -> list[tuple[int, list[int]]]:
    """How many of the groups of each size go to each split, for groups taken largest first.

    The greedy choices among groups of one size are the largest elements of the
    sequences d, d - size, d - 2 size, ... (d: what a split lacks), so most are
    counted at once and only the last few are made one by one.
    """
    total = sum(s * n for s, n in sizes)
    weight = sum(shares.values()) or 1
    lack = [total * w / weight for w in shares.values()]
    out = []
    for size, n in sorted(sizes, reverse=True):
        got = [0] * len(lack)
        if n > 4 * len(lack):
            active = list(range(len(lack)))
            while True:
                level = (sum(lack[i] for i in active) - n * size) / len(active) + size
                if all(lack[i] > level for i in active) or len(active) == 1:
                    break
                active = [i for i in active if lack[i] > level] or [max(active, key=lambda i: lack[i])]
            for i in active:
                got[i] = max(0, min(n - sum(got), math.ceil((lack[i] - level) / size)))
                lack[i] -= got[i] * size
        for _ in range(n - sum(got)):
            i = max(range(len(lack)), key=lambda j: lack[j])
            got[i] += 1
            lack[i] -= size
        out.append((size, got))
    return out


def assign(groups: DataFrame, shares: Mapping[str, float] = SHARES, rank_task: int = 1_000_000) -> DataFrame:
    """A split for each group (root string, n long), largest first to the split furthest below target.

    Only the histogram of sizes reaches the driver: N records have at most
    sqrt(2 N) different group sizes. Groups of one size are interchangeable;
    they are ranked by (bucket of an MD5, root), the same on every machine, and
    the ranks cut at the greedy counts.
    """
    spark = groups.sparkSession
    sizes = [(r.n, r.k) for r in groups.groupBy("n").agg(F.count("*").alias("k")).collect()]
    names = list(shares)
    cuts = spark.createDataFrame([(s, [sum(g[: i + 1]) for i in range(len(g))]) for s, g in _picks(sizes, shares)], "n long, cut array<long>")
    buckets = max(16, sum(k for _, k in sizes) // rank_task + 1)
    g = groups.withColumn("bucket", stable_bucket(F.col("root"), buckets))
    before = g.groupBy("n", "bucket").agg(F.count("*").alias("k")).select("n", "bucket", (F.sum("k").over(Window.partitionBy("n").orderBy("bucket")) - F.col("k")).alias("before"))
    ranked = g.withColumn("rn", F.row_number().over(Window.partitionBy("n", "bucket").orderBy("root"))).join(before, ["n", "bucket"]).join(cuts, "n")
    rank = F.col("before") + F.col("rn")
    split = F.coalesce(*[F.when(rank <= F.get("cut", F.lit(i)), name) for i, name in enumerate(names)])
    return ranked.select("root", "n", split.alias("split"))


def split_records(records: DataFrame, record: str, attributes: list[str], shares: Mapping[str, float] = SHARES) -> DataFrame:
    """One split for each record, equal for all records joined by any shared attribute value.

    Rows of the same record are one record and tie their attribute values
    together. Attribute columns are strings that name what they hold, e.g.
    ``author:x``; null attributes join nothing. A record without any attribute
    stands alone. Rows with a null record are left out. Other columns are ignored.
    Result: record, root, split.
    """
    nodes = F.array_compact(F.array(*[F.col(a) for a in attributes]))
    nodes = F.when(F.size(nodes) == 0, F.array(F.concat(F.lit("record:"), F.col(record).cast("string")))).otherwise(nodes)
    rows = records.where(F.col(record).isNotNull()).select(F.col(record).alias("record"), F.explode(nodes).alias("node")).distinct()
    ends = rows.groupBy("record").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    tied = rows.join(ends.where("first <> last"), "record").select("first", "node").distinct()
    roots = components(tied, "first", "node")
    # A group's node, or a component's root, may be that of a third of all records: hot keys are looked up where their rows are.
    firsts = checkpointed(records.sparkSession, ends.select("record", F.col("first").alias("node")))
    homes = looked_up(firsts, ["node"], roots).select("record", F.coalesce("root", "node").alias("root"))
    homes = checkpointed(records.sparkSession, homes)
    splits = assign(homes.groupBy("root").agg(F.count("*").alias("n")), shares).select("root", "split")
    return looked_up(homes, ["root"], checkpointed(records.sparkSession, splits)).select("record", "root", "split")


def images(samples: DataFrame, manifest: DataFrame) -> DataFrame:
    """Every image of samples and manifest (image = dataset and path) with its group node."""
    a = samples.select("dataset", F.col("image_path").alias("path"), "group_key")
    b = manifest.select("dataset", F.col("source_path").alias("path"), "group_key")
    node = F.concat_ws("\x1f", F.coalesce("dataset", F.lit("")), F.coalesce(group_of(F.col("group_key"), F.col("path")), F.lit("")))
    return a.unionByName(b).where("path is not null").select(F.concat_ws("\x1f", F.coalesce("dataset", F.lit("")), "path").alias("image"), node.alias("node"))


def split_groups(manifest: DataFrame) -> DataFrame:
    """Groups that lie in more than one split, all builds taken together.

    Every spelling of a group is linked to its spelling-free form; a component is
    a group. Result: dataset, out_name (first of all rows of the group).
    """
    spelt = F.concat_ws("\x1f", F.lit("s"), F.coalesce("dataset", F.lit("")), F.coalesce("group_key", F.lit("")), F.coalesce("stem_path", F.lit("")))
    plain = F.concat_ws("\x1f", F.lit("p"), F.coalesce("dataset", F.lit("")), F.coalesce(group_of(F.col("group_key"), F.col("source_path")), F.lit("")))
    named = group_of(F.col("group_key"), F.lit("")) != ""
    rows = manifest.withColumn("stem_path", F.when(F.coalesce(named, F.lit(False)), F.lit("")).otherwise(F.col("source_path"))).select("dataset", "out_name", split_name(F.col("split")).alias("split"), spelt.alias("spelt"), plain.alias("plain"))
    # Rows of one spelling are gathered first, so that a hot group crosses the network as a few rows.
    small = rows.groupBy("spelt").agg(F.first("plain").alias("plain"), F.first("dataset").alias("dataset"), F.min("out_name").alias("out_name"), F.collect_set("split").alias("splits"))
    small = checkpointed(manifest.sparkSession, small)
    roots = components(small, "spelt", "plain")
    grouped = small.join(roots, small.spelt == roots.node, "left").groupBy(F.coalesce("root", "plain").alias("root")).agg(F.min("dataset").alias("dataset"), F.min("out_name").alias("out_name"), F.array_distinct(F.flatten(F.collect_set("splits"))).alias("splits"))
    return grouped.where(F.size("splits") > 1).select("dataset", "out_name")


def p1_found(spark, sf_dir: str) -> DataFrame:
    return split_groups(table(spark, sf_dir, "manifest"))


def p1_splits(spark, sf_dir: str) -> DataFrame:
    found = split_records(images(table(spark, sf_dir, "samples"), table(spark, sf_dir, "manifest")), "image", ["node"])
    return found.select(F.split("record", "\x1f")[0].alias("dataset"), F.split("record", "\x1f")[1].alias("image_path"), "split")


def p1_shares(spark, sf_dir: str) -> DataFrame:
    found = split_records(images(table(spark, sf_dir, "samples"), table(spark, sf_dir, "manifest")), "image", ["node"])
    per = found.groupBy("split").agg(F.count("*").alias("images"), F.countDistinct("root").alias("groups"))
    return per.select("split", "images", "groups", F.round(F.col("images") / F.sum("images").over(Window.partitionBy()), 4).alias("share"))
