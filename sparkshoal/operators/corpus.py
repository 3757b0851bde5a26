"""Splits by group hash, repeat factors, and reports over a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkshoal.functions.keys import class_score, stable_bucket
from sparkshoal.operators.labels import small
from sparkshoal.operators.reduction import first_rows
from sparkshoal.session import checkpointed


def everything():
    """A window over all rows; only for tables of one row a source, split or class."""
    return Window.partitionBy()


def split_of(seed: int, dataset: Column, group: Column, train: int = 80, val: int = 10) -> Column:
    """Split of a group, a pure function of seed, dataset and group."""
    b = stable_bucket(F.concat_ws(":", F.lit(str(seed)), dataset, group), 100)
    return F.when(b < train, "train").when(b < train + val, "val").otherwise("test")


def group_report(items: DataFrame, few: int = 10, many: int = 100) -> DataFrame:
    """Groups and images of each dataset, the splits they landed in, and a warning for few groups under many images."""
    g = items.groupBy("dataset").agg(F.countDistinct("group").alias("groups"), F.count("*").alias("images"), F.array_join(F.array_sort(F.collect_set("split")), ",").alias("splits"))
    return g.withColumn("too_few_groups", (F.col("groups") < few) & (F.col("images") >= many))


def class_report(labels: DataFrame, classes: DataFrame, splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """For each class its boxes, images, boxes an image, and images in each split; classes without any stay.

    ``labels`` has one row a box: image, split, cid. One aggregation by (cid,
    image, split) carries both counts, and combines on the map side.
    """
    per_image = labels.groupBy("cid", "image", "split").agg(F.count("*").alias("n"))
    counts = per_image.groupBy("cid").agg(F.sum("n").alias("boxes"), F.count("*").alias("images"), *[F.count_if(F.col("split") == s).alias(f"{s}_images") for s in splits])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = small(classes).join(counts, "cid", "left")
    pct = F.round(100 * zero("boxes") / F.greatest(F.sum(zero("boxes")).over(everything()), F.lit(1)), 6)  # one row a class
    return out.select("cid", "name", zero("boxes").alias("boxes"), zero("images").alias("images"), pct.alias("box_pct"), F.round(F.when(zero("images") > 0, F.col("boxes") / F.col("images")).otherwise(0.0), 6).alias("boxes_per_image"), *[zero(f"{s}_images").alias(f"{s}_images") for s in splits])


def blind_classes(report: DataFrame) -> DataFrame:
    """Classes that can't be evaluated (images, but none in val or none in test) or are empty."""
    kind = F.when(F.col("images") == 0, "empty").when((F.col("val_images") == 0) | (F.col("test_images") == 0), "blind")
    return report.withColumn("problem", kind).where("problem is not null").select("cid", "name", "problem", "images")


def source_shares(items: DataFrame, source: str, limit: float = 0.25) -> DataFrame:
    """Share of each source and whether it is more than ``limit``."""
    n = items.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(everything())  # one row a source
    return n.select("source", "n", F.round(share, 6).alias("share"), (share > limit).alias("too_large"))


def source_by_class(labels: DataFrame, source: str) -> DataFrame:
    """Images of each class by source with their share of the class's images."""
    n = labels.select("cid", "image", F.col(source).alias("source")).distinct().groupBy("cid", "source").agg(F.count("*").alias("images"))
    return n.withColumn("pct", F.round(100 * F.col("images") / F.sum("images").over(Window.partitionBy("cid")), 6))


def split_shares(items: DataFrame) -> DataFrame:
    """Images and images without labels by split, with their shares of all."""
    n = items.groupBy("split").agg(F.count("*").alias("images"), F.count_if(F.col("n_labels") == 0).alias("negatives"))
    return n.select("split", "images", "negatives", F.round(F.col("images") / F.sum("images").over(everything()), 6).alias("share"))


def repeat_factors(train: DataFrame, threshold: float = 0.10) -> DataFrame:
    """How often each training image is listed: image, factor.

    ``train`` has one row a label of a training image: image, cid. A class in a
    share f of the images weighs max(1, sqrt(threshold / f)); an image goes by its
    rarest class, rounded half to even.
    """
    spark = train.sparkSession
    # One shuffle of the labels: a row for each image with its classes; all that follows reads these rows, which lie by image.
    per = checkpointed(spark, train.groupBy("image").agg(F.collect_set("cid").alias("cids")).where(F.size("cids") > 0))
    # The null added to each image's classes counts the images in the same pass.
    counts = per.select(F.explode(F.concat("cids", F.array(F.lit(None)))).alias("cid")).groupBy("cid").agg(F.count("*").alias("c"))
    share = F.col("c") / F.max(F.when(F.col("cid").isNull(), F.col("c"))).over(everything())  # one row a class
    weight = checkpointed(spark, counts.withColumn("share", share).where("cid is not null").select("cid", F.greatest(F.lit(1.0), F.sqrt(F.lit(threshold) / F.col("share"))).alias("w")))
    return per.select("image", F.explode("cids").alias("cid")).join(small(weight), "cid").groupBy("image").agg(F.greatest(F.lit(1), F.bround(F.max("w")).cast("int")).alias("factor"))


def repeated(images: DataFrame, factors: DataFrame) -> DataFrame:
    """Each image as many times as its factor says; images without one once."""
    out = images.join(factors, "image", "left")
    return out.select("image", F.explode(F.sequence(F.lit(1), F.coalesce("factor", F.lit(1)))).alias("copy"))


def domain_counts(items: DataFrame, domains: DataFrame) -> DataFrame:
    """Images by domain and split; datasets without a domain are left out."""
    return items.join(small(domains), "dataset").groupBy("domain", "split").agg(F.count("*").alias("images"))


def without_domain(items: DataFrame, domains: DataFrame) -> DataFrame:
    """Datasets in use that have no domain; must be empty before images are enhanced or evaluated."""
    return items.select("dataset").distinct().join(small(domains), "dataset", "left_anti")


def taxonomy_differences(corpus: DataFrame, model: DataFrame) -> DataFrame:
    """Class ids whose names differ between two taxonomies (cid, name); empty if they agree."""
    a, b = corpus.select("cid", F.col("name").alias("corpus_name")), model.select("cid", F.col("name").alias("model_name"))
    return a.join(b, "cid", "full_outer").where(~F.col("corpus_name").eqNullSafe(F.col("model_name")))


def sampled(items: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """A share of the rows, the same on every run and in every engine: those whose key's bucket (of a million) lies below the fraction."""
    return items.where(stable_bucket(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 1_000_000) < fraction * 1_000_000)


def top(items: DataFrame, by: list[str], n: int) -> DataFrame:
    return first_rows(items, by, n)


def with_source(labels: DataFrame, manifest: DataFrame) -> DataFrame:
    """Labels (image) with the ``dataset`` the manifest (out_name, dataset) has for their image, ``?`` where it has none."""
    known = manifest.where("out_name is not null").groupBy(F.col("out_name").alias("image")).agg(F.max("dataset").alias("dataset"))
    return labels.drop("dataset").join(known, "image", "left").withColumn("dataset", F.coalesce("dataset", F.lit("?")))


def unify_report(items: DataFrame, labels: DataFrame, classes: DataFrame, dropped: DataFrame, limit: float = 0.25) -> DataFrame:
    """The report of a build as rows: section, name, n, share, flag.

    ``items``: dataset, split, n_labels; ``labels``: cid, one row a box;
    ``dropped``: dataset, label, boxes (the top ones). Sections: images (total,
    each split, negatives; share of all images), boxes (each class, also those
    without any; share of all boxes), source (share of all images, flag if more
    than ``limit``), dropped (``dataset:label``). One row a class, source or split.
    """
    share = lambda n, of: F.round(F.col(n) / F.greatest(of, F.lit(1)), 6)
    per = items.groupBy("dataset", "split").agg(F.count("*").alias("n"), F.count_if(F.col("n_labels") == 0).alias("neg"))
    per = checkpointed(items.sparkSession, per)  # one row a source and split
    total = F.max("n_all").over(everything())
    splits = spark_rows(items, [("train",), ("val",), ("test",)], "name string").join(per.groupBy(F.col("split").alias("name")).agg(F.sum("n").alias("n")), "name", "left")
    parts = [
        per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("total").alias("name"), "n"),
        splits.select("name", F.coalesce("n", F.lit(0)).alias("n")),
        per.agg(F.coalesce(F.sum("neg"), F.lit(0)).alias("n")).select(F.lit("negatives").alias("name"), "n"),
    ]
    images = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("n_all", F.when(F.col("name") == "total", F.col("n")))
    images = images.select(F.lit("images").alias("section"), "name", "n", share("n", total).alias("share"), F.lit(False).alias("flag"))
    counts = labels.groupBy("cid").agg(F.count("*").alias("n"))
    boxes = small(classes).join(counts, "cid", "left").withColumn("n", F.coalesce("n", F.lit(0))).select(F.lit("boxes").alias("section"), "name", "n", share("n", F.sum("n").over(everything())).alias("share"), F.lit(False).alias("flag"))
    sources = per.groupBy(F.col("dataset").alias("name")).agg(F.sum("n").alias("n"))
    sources = sources.withColumn("share", F.col("n") / F.greatest(F.sum("n").over(everything()), F.lit(1))).select(F.lit("source").alias("section"), "name", "n", F.round("share", 6).alias("share"), (F.col("share") > limit).alias("flag"))
    drops = dropped.select(F.lit("dropped").alias("section"), F.concat_ws(":", "dataset", F.coalesce("label", F.lit("None"))).alias("name"), F.col("boxes").alias("n"), F.lit(None).cast("double").alias("share"), F.lit(False).alias("flag"))
    return images.unionByName(boxes).unionByName(sources).unionByName(drops)


def spark_rows(like: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame(rows, schema)


def report_text(report: DataFrame) -> str:
    """The report of ``unify_report`` as lines of text, sections in order, sources and drops by count."""
    sections = ["images", "boxes", "source", "dropped"]
    rows = sorted(report.collect(), key=lambda r: (sections.index(r.section), 0 if r.section in ("images", "boxes") else -r.n))  # one row a class, source or split, and the top drops
    out: list[str] = []
    for s in sections:
        out += [f"{s}"] + [f"  {r.name:<30} {r.n:>9}" + (f"  {r.share:6.1%}" if r.share is not None else "") + ("  over the limit" if r.flag else "") for r in rows if r.section == s]
    return "\n".join(out) + "\n"


def domain_scores(scores: DataFrame) -> DataFrame:
    """Scores by class side by side for each domain: cid, name, cells (``domain=score`` in order of domains). ``scores``: domain, cid, name, ap (null: no instances)."""
    cell = F.struct("domain", F.concat(F.col("domain"), F.lit("="), class_score(F.col("ap"))).alias("text"))
    return scores.groupBy("cid", "name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(cell)), lambda c: c["text"]), "  ").alias("cells"))
