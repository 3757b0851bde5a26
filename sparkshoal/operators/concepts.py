"""Concepts resolved to classes through a taxonomic closure, and what follows from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkshoal.operators.labels import small
from sparkshoal.session import checkpointed


def closure(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Descendants of every taxon (taxon, descendant) from parent edges (parent, child), however far down; cycles end.

    Every round joins the pairs found so far with each other, so paths double in
    length, until no pair is new: 8 rounds for a chain of 200 levels.
    """
    pairs = checkpointed(spark, edges.select(F.col("parent").alias("taxon"), F.col("child").alias("descendant")).distinct())
    had, now = -1, pairs.count()
    while had < now:
        below = pairs.select(F.col("taxon").alias("descendant"), F.col("descendant").alias("lower"))
        longer = pairs.join(below, "descendant").select("taxon", F.col("lower").alias("descendant"))
        pairs = checkpointed(spark, pairs.union(longer).distinct())
        had, now = now, pairs.count()
    return pairs


def concept_frequency(records: DataFrame) -> DataFrame:
    """Boxes of every concept in the records' box arrays."""
    return records.select(F.explode("boxes").alias("b")).groupBy(F.col("b.concept").alias("concept")).agg(F.count("*").alias("boxes"))


def resolve(seen: DataFrame, wanted: DataFrame, descendants: DataFrame) -> DataFrame:
    """The class of each seen concept: concept, boxes, unified_class, method, via.

    ``wanted`` (concept, class) are the taxa asked for, ``descendants`` (taxon,
    descendant) their closure. A concept asked for itself is exact. Else the taxa
    above it decide: one class in all, or the one taxon below all others of them
    (ancestry-specific); several classes are a CONFLICT, none is unresolved, both
    with a blank class. ``via`` lists the taxa above, joined by semicolons.
    """
    w = wanted.groupBy(F.col("concept").alias("taxon")).agg(F.min("class").alias("class"))
    up = seen.select("concept").distinct().join(small(descendants.select("taxon", F.col("descendant").alias("concept")).distinct()), "concept").join(small(w), "taxon", "left")
    # A taxon is deepest if all other taxa above the concept contain it: it lies below as many of them as there are others.
    inside = descendants.select(F.col("taxon").alias("over"), F.col("descendant").alias("taxon")).distinct()
    others = up.select("concept", F.col("taxon").alias("over"))
    depth = up.join(small(inside), "taxon").join(others, ["concept", "over"]).where("taxon <> over").groupBy("concept", "taxon").agg(F.count("*").alias("under"))
    marked = up.join(depth, ["concept", "taxon"], "left")
    per = marked.groupBy("concept").agg(F.count("*").alias("n"), F.countDistinct("class").alias("classes"), F.min("class").alias("one"), F.array_join(F.array_sort(F.collect_list("taxon")), ";").alias("via"), F.collect_list(F.struct(F.coalesce("under", F.lit(0)).alias("under"), "class")).alias("taxa"))
    deepest = F.filter("taxa", lambda t: t["under"] == F.col("n") - 1)
    out = seen.join(small(w.select(F.col("taxon").alias("concept"), F.col("class").alias("own"))), "concept", "left").join(per, "concept", "left")
    method = F.when(F.col("own").isNotNull(), "exact").when(F.col("classes") == 1, "ancestry").when((F.col("classes") > 1) & (F.size(deepest) == 1), "ancestry-specific").when(F.col("classes") > 1, "CONFLICT").otherwise("unresolved")
    out = out.withColumn("method", method)
    unified = F.when(F.col("method") == "exact", F.col("own")).when(F.col("method") == "ancestry", F.col("one")).when(F.col("method") == "ancestry-specific", F.get(deepest, F.lit(0))["class"]).otherwise("")
    via = F.when(F.col("method") == "exact", F.col("concept")).when(F.col("method") == "unresolved", "").otherwise(F.col("via"))
    return out.select("concept", "boxes", unified.alias("unified_class"), "method", via.alias("via"))


def tally(resolved: DataFrame) -> DataFrame:
    """Boxes by outcome; both kinds of ancestry count as one."""
    kind = F.when(F.col("method") == "ancestry-specific", "ancestry").otherwise(F.lower("method"))
    return resolved.groupBy(kind.alias("outcome")).agg(F.sum("boxes").alias("boxes"), F.count("*").alias("concepts"))


def cached_closure(spark: SparkSession, path: str, wanted: DataFrame, fetch: Callable[[str], list[str] | None]) -> DataFrame:
    """Descendants (taxon, descendant) of every wanted taxon, fetched once and kept in a table at ``path``.

    Only taxa the table doesn't have are fetched, by tasks (``fetch`` gives a
    taxon's descendants, or None if it can't be had now, which is tried again
    next time). What a run fetched is appended as a whole, so a run that is
    stopped repeats nothing that an earlier one ended. A taxon without
    descendants is kept as a row with a null descendant, which isn't returned.
    """
    schema = "taxon string, descendant string"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    had = spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for taxon in batch["taxon"]:
                got = fetch(taxon)
                if got is not None:
                    rows += [(taxon, d) for d in got or [None]]
            yield pd.DataFrame(rows, columns=["taxon", "descendant"])

    todo = wanted.select(F.col("concept").alias("taxon")).where("taxon is not null").distinct().join(had.select("taxon").distinct(), "taxon", "left_anti")
    checkpointed(spark, todo.mapInPandas(run, schema)).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path).where("descendant is not null").distinct()


def with_files(records: DataFrame, files: DataFrame, name: str = "file_name") -> DataFrame:
    """Records whose file is among ``files`` (column ``name``); a compile leaves the others out."""
    return records.join(files.select(name).distinct(), name, "left_semi")


def compiled(records: DataFrame, concept_map: DataFrame | None, classes: DataFrame, least_complete: float = 0.0, order: str = "rec_id") -> DataFrame:
    """Records with their boxes resolved to classes, incomplete ones left out.

    ``records``: ``order``, file_name, width, height, dive, concept, cls, boxes
    (array of concept, x, y, w, h). Without a concept map a box of the record's
    own concept takes the record's class. Boxes equal in class and place count
    once. A record stays if it has no boxes, or resolved / (resolved +
    unresolved) is at least ``least_complete``. Result: the record's columns,
    resolved (array of cls, x, y, w, h) and unresolved.
    """
    base = records.select(order, "file_name", "width", "height", "dive", "concept", "cls", "boxes")
    ex = base.select(order, F.col("concept").alias("rec_concept"), F.col("cls").alias("rec_cls"), F.posexplode("boxes").alias("pos", "b"))
    if concept_map is None:
        ex = ex.withColumn("cls", F.when(F.col("b.concept") == F.col("rec_concept"), F.col("rec_cls")))
    else:
        cm = concept_map.where("unified_class is not null and unified_class <> ''").select(F.col("concept").alias("m_concept"), F.col("unified_class").alias("cls"))
        ex = ex.join(small(cm), F.col("b.concept") == F.col("m_concept"), "left")
    known = classes.select(F.col("name").alias("cls")).distinct().withColumn("known", F.lit(True))
    ex = ex.join(small(known), "cls", "left")
    per = ex.groupBy(order).agg(F.array_sort(F.collect_list(F.when(F.col("known"), F.struct("pos", "cls", "b.x", "b.y", "b.w", "b.h")))).alias("hits"), F.count_if(F.col("known").isNull()).alias("unresolved"))
    distinct = F.array_distinct(F.transform("hits", lambda x: F.struct(x["cls"].alias("cls"), x["x"].alias("x"), x["y"].alias("y"), x["w"].alias("w"), x["h"].alias("h"))))
    out = base.join(per, order, "left").withColumn("resolved", F.coalesce(distinct, F.array().cast("array<struct<cls:string,x:double,y:double,w:double,h:double>>"))).withColumn("unresolved", F.coalesce("unresolved", F.lit(0)))
    n = F.size("resolved") + F.col("unresolved")
    return out.where((n == 0) | (F.size("resolved") / n >= least_complete)).drop("hits", "boxes")


def coco_tables(records: DataFrame, classes: DataFrame, order: str = "rec_id") -> tuple[DataFrame, DataFrame]:
    """Images and annotations with ids in the order of the log, of ``compiled`` records."""
    from sparkshoal.operators.ranking import spread_row_number

    numbered = spread_row_number(records.withColumn("_all", F.lit(0)), ["_all"], [order], "id")
    images = numbered.select("id", "file_name", "width", "height", "dive", "concept")
    flat = numbered.select(F.col("id").alias("image_id"), F.posexplode("resolved").alias("pos", "b"), F.lit(0).alias("_all"))
    cat = classes.select(F.col("name").alias("c_name"), F.col("cid").alias("category_id"))
    ann = spread_row_number(flat, ["_all"], ["image_id", "pos"], "id").join(small(cat), F.col("b.cls") == F.col("c_name"))
    return images, ann.select("id", "image_id", "category_id", F.array("b.x", "b.y", "b.w", "b.h").alias("bbox"), F.lit(0).alias("iscrowd"))
