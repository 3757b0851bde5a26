"""The corpus build as one plan: map, thin, cap, split, fit, publish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkshoal.functions import boxes as B
from sparkshoal.functions.keys import out_name
from sparkshoal.functions.text import file_name, group_of
from sparkshoal.operators import labels, reduction
from sparkshoal.operators.corpus import split_of
from sparkshoal.session import checkpointed, table

#: What each source asks for: keep every n-th frame, how alike frames may be, how many images at most, whether it is in use (it is if nothing is said). Sources not listed are taken as they are.
REGISTRY = {"kelpline": {"stride": 2, "near": 6, "cap": 20_000}, "murkbay": {"stride": 2, "near": 6}, "quaycam": {"stride": 3, "near": 6}, "abyssnet": {"near": 4, "cap": 5_000}}
OUT_W, OUT_H = 640, 480


def selected(registry: dict[str, dict], names: list[str] | None = None) -> list[str]:
    """Sources of a registry in use and, if ``names`` are given, among them; ValueError if none is left."""
    out = [k for k, v in registry.items() if v.get("enabled", True) and (not names or k in names)]
    if not out:
        raise ValueError("no source selected")
    return out


def from_sources(items: DataFrame, registry: dict[str, dict], names: list[str] | None = None) -> DataFrame:
    """Items of the registry's selected sources."""
    return items.where(F.col("dataset").isin(selected(registry, names)))


def samples(spark: SparkSession, d: str) -> DataFrame:
    """Images with their boxes nested: each sample_id and box_id once."""
    s = table(spark, d, "samples").where("sample_id is not null").groupBy("sample_id").agg(F.min(F.struct("ingested_at", "dataset", "image_path", "group_key", "negative", "width", "height", "dhash")).alias("r")).select("sample_id", "r.*")
    b = table(spark, d, "boxes").groupBy("box_id").agg(F.min(F.struct("sample_id", B.box(F.col("label"), F.col("cx"), F.col("cy"), F.col("w"), F.col("h")).alias("b"))).alias("r")).select("box_id", "r.*")
    nested = b.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("box_id", "b"))).alias("bs"))
    own = F.coalesce(B.valid(F.transform("bs", lambda x: x["b"])), F.array().cast(f"array<{B.BOX}>"))
    return s.join(nested, "sample_id", "left").select("sample_id", "dataset", "image_path", file_name(F.col("image_path")).alias("name"), group_of(F.col("group_key"), F.col("image_path")).alias("group"), "negative", "width", "height", "dhash", own.alias("boxes"))


def mapped(spark: SparkSession, d: str, items: DataFrame) -> DataFrame:
    """Items with ``labels`` (class ids of the concept map's classes) and their disposition."""
    cm = table(spark, d, "fathomnet_concept_map").where("coalesce(unified_class, '') <> ''")
    classes = cm.select(F.col("unified_class").alias("name")).distinct().select((F.row_number().over(Window.orderBy("name")) - 1).alias("cid"), "name")  # one row a class
    entries = cm.select(F.lit("all").alias("dataset"), F.col("concept").alias("label"), F.col("unified_class").alias("class"), F.lit(0).alias("ord"))  # the reviewed map holds for every source
    each = items.select("sample_id", F.lit("all").alias("dataset"), F.posexplode("boxes").alias("pos", "b")).select("sample_id", "dataset", "pos", "b", F.col("b.label").alias("label"))
    hit = labels.map_labels(each, classes, entries).where("cid is not null")
    kept = hit.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("pos", "cid", "b.cx", "b.cy", "b.w", "b.h"))).alias("labels"))
    none = F.array().cast("array<struct<pos:int,cid:int,cx:double,cy:double,w:double,h:double>>")
    out = items.join(kept, "sample_id", "left").withColumn("labels", F.coalesce("labels", none))
    return out.withColumn("disposition", labels.disposition(F.size("boxes"), F.size("labels"), F.coalesce("negative", F.lit(False))))


def _wish(what: str) -> Column:
    """What the registry asks of a row's source, null where it asks nothing."""
    out = F.lit(None).cast("int")
    for source, wish in REGISTRY.items():
        if what in wish:
            out = F.when(F.col("dataset") == source, F.lit(wish[what])).otherwise(out)
    return out


def thinned(items: DataFrame) -> DataFrame:
    """Each source thinned as the registry asks: stride, then near-duplicates, then the rarity cap; one plan for all sources.

    Only keys go through the sorts; the images join what is left of them at the end.
    """
    items = checkpointed(items.sparkSession, items)
    own = reduction.stride(items.select("sample_id", "dataset", "group", "name", "dhash"), ["dataset", "group"], ["name", "sample_id"], _wish("stride"))
    own = checkpointed(items.sparkSession, reduction.near_duplicates(own, ["dataset", "group"], ["name", "sample_id"], "dhash", _wish("near"))).drop("dhash")
    labels_left = items.select("dataset", "sample_id", F.explode("labels.cid").alias("cid")).join(own.select("sample_id"), "sample_id", "left_semi")
    rare = reduction.rarity(labels_left, "sample_id", "cid", ["dataset"])
    kept = reduction.capped(own.join(rare, ["dataset", "sample_id"], "left"), ["dataset"], "group", ["name", "sample_id"], _wish("cap"), "sample_id")
    return items.join(kept.select("sample_id"), "sample_id", "left_semi")


def fitted(items: DataFrame) -> DataFrame:
    """Labels moved to the target geometry; images of unknown size keep theirs; annotated images left without labels go."""
    as_box = F.transform("labels", lambda x: B.box(x["cid"].cast("string"), x["cx"], x["cy"], x["w"], x["h"]))
    known = F.col("width").isNotNull() & F.col("height").isNotNull() & (F.col("width") > 0) & (F.col("height") > 0)
    moved = B.clamp(F.when(known, B.crop(as_box, F.col("width"), F.col("height"), OUT_W, OUT_H)).otherwise(as_box))
    out = items.withColumn("_had", F.size("labels") > 0).withColumn("labels", F.transform(moved, lambda b: F.struct(b["label"].cast("int").alias("cid"), b["cx"].alias("cx"), b["cy"].alias("cy"), b["w"].alias("w"), b["h"].alias("h"))))
    return out.where(~F.col("_had") | (F.size("labels") > 0)).drop("_had")


def corpus(spark: SparkSession, d: str, seed: int = 42) -> DataFrame:
    """The built corpus, ready to be written by split."""
    kept = mapped(spark, d, samples(spark, d)).where(F.col("disposition").isin("kept", "negative"))
    out = fitted(thinned(kept))
    return out.withColumn("split", split_of(seed, F.col("dataset"), F.col("group"))).withColumn("out_name", out_name(F.col("dataset"), F.col("image_path")))


def dispositions(spark: SparkSession, d: str) -> DataFrame:
    """Images of each dataset by what becomes of them when labels are mapped."""
    return mapped(spark, d, samples(spark, d)).groupBy("dataset").agg(F.count("*").alias("images"), *[F.count_if(F.col("disposition") == k).alias(k) for k in ("kept", "negative", "dropped_all_labels", "no_annotations")])


def funnel(spark: SparkSession, d: str) -> DataFrame:
    """Dispositions before thinning, and how many images the corpus keeps."""
    after = corpus(spark, d).groupBy("dataset").agg(F.count("*").alias("built"))
    return dispositions(spark, d).join(after, "dataset", "left").withColumn("built", F.coalesce("built", F.lit(0)))
