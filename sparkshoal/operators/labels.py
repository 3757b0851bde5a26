"""Source labels onto a shared taxonomy, with every drop accounted for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkshoal.functions.text import strip_space

SMALL_ROWS = 200_000  # taxonomies and label tables up to this many rows are broadcast, larger ones are joined
SMALL_BYTES = 1 << 20  # plans over no more bytes than this are small without a count


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is proven small: by the bytes its plan reads, or by a bounded count (which runs the plan up to there)."""
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= SMALL_BYTES:
        return F.broadcast(df)
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def taxonomy(spark: SparkSession, names: dict[int, str], maps: dict[str, dict[str, str]]) -> tuple[DataFrame, DataFrame]:
    """Classes (cid, name) and label table (dataset, label, class, ord) of a configuration."""
    classes = spark.createDataFrame(list(names.items()), "cid int, name string")
    rows = [(d, k, v, i) for d, table in maps.items() for i, (k, v) in enumerate(table.items())]
    return classes, spark.createDataFrame(rows, "dataset string, label string, class string, ord int")


def map_labels(boxes: DataFrame, classes: DataFrame, table: DataFrame, dataset: str = "dataset", label: str = "label") -> DataFrame:
    """``boxes`` with ``cid`` (int) and ``dropped`` (boolean).

    A label counts as mapped by its exact entry, else by the first entry of its
    dataset equal without regard to case (the label's ends stripped), else as the
    class of that name. An entry whose class isn't in the taxonomy gives no cid
    and is no drop; a label without any entry is a drop. Null labels are drops.
    Existing columns ``cid`` and ``dropped`` are replaced.
    """
    exact = table.groupBy("dataset", "label").agg(F.min_by("class", "ord").alias("x_class")).select(F.col("dataset").alias("x_ds"), F.col("label").alias("x_label"), "x_class")
    loose = table.groupBy("dataset", F.lower("label").alias("l_label")).agg(F.min_by("class", "ord").alias("l_class")).select(F.col("dataset").alias("l_ds"), "l_label", "l_class")
    ids = classes.groupBy("name").agg(F.max("cid").alias("t_cid")).select(F.col("name").alias("t_name"), "t_cid")
    low = F.lower(strip_space(F.col(label)))
    out = boxes.drop("cid", "dropped").withColumn("_low", low)
    out = out.join(small(exact), (F.col(dataset) == F.col("x_ds")) & (F.col(label) == F.col("x_label")), "left")
    out = out.join(small(loose), (F.col(dataset) == F.col("l_ds")) & (F.col("_low") == F.col("l_label")), "left")
    hit = F.col("x_ds").isNotNull() | F.col("l_ds").isNotNull()
    target = F.when(F.col("x_ds").isNotNull(), F.col("x_class")).when(F.col("l_ds").isNotNull(), F.col("l_class")).otherwise(F.col("_low"))
    out = out.withColumn("_target", target).withColumn("_hit", hit).join(small(ids), F.col("_target") == F.col("t_name"), "left")
    dropped = ~F.col("_hit") & F.col("t_cid").isNull()
    return out.withColumn("cid", F.col("t_cid")).withColumn("dropped", dropped).drop("x_ds", "x_label", "x_class", "l_ds", "l_label", "l_class", "t_name", "t_cid", "_low", "_target", "_hit")


def disposition(source_boxes: Column, kept_labels: Column, negative: Column) -> Column:
    """What becomes of a sample: kept, dropped_all_labels, negative or no_annotations."""
    return F.when(kept_labels > 0, "kept").when(source_boxes > 0, "dropped_all_labels").when(negative, "negative").otherwise("no_annotations")


def dropped_counts(mapped: DataFrame, dataset: str = "dataset", label: str = "label") -> DataFrame:
    """Boxes dropped for each dataset and label."""
    return mapped.where("dropped").groupBy(F.col(dataset).alias("dataset"), F.col(label).alias("label")).agg(F.count("*").alias("boxes"))


def top_drops(mapped: DataFrame, dataset: str = "dataset", label: str = "label", n: int = 30) -> DataFrame:
    """The ``n`` labels dropped most often, ties by dataset and label."""
    return dropped_counts(mapped, dataset, label).orderBy(F.desc("boxes"), "dataset", "label").limit(n)


def dead_targets(classes: DataFrame, table: DataFrame) -> DataFrame:
    """Entries of a label table whose class the taxonomy doesn't have."""
    return table.join(small(classes.select(F.col("name").alias("class")).distinct()), "class", "left_anti").select("dataset", "label", "class")
