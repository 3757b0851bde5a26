"""Logs, manifests and maps as tables, and the sinks that write them."""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkshoal.functions import images, pixels
from sparkshoal.functions.boxes import label_line
from sparkshoal.sources.listing import listed

PROGRESS = "uuid string, file_name string, width int, height int, dive string, concept string, cls string, boxes array<struct<concept:string,x:double,y:double,w:double,h:double>>"
MANIFEST = "out_name string, split string, dataset string, group string, n_boxes int, source_path string"
CONCEPT_MAP = "concept string, boxes bigint, unified_class string, method string, via string"


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The log of finished items; blank, broken and cut-off lines are skipped, an absent file is an empty log."""
    if "://" not in path and not os.path.exists(path):
        return spark.createDataFrame([], PROGRESS)
    return spark.read.schema(PROGRESS).option("mode", "DROPMALFORMED").json(path).where("uuid is not null")


def read_manifest(spark: SparkSession, path: str, many_lines: bool = False) -> DataFrame:
    """A manifest as written: an unquoted empty value is null, an empty pair of quotes an empty value. With ``many_lines`` values may hold line breaks; a file is then read by one task."""
    return spark.read.schema(MANIFEST).option("header", True).option("escape", '"').option("nullValue", "\\N").option("multiLine", many_lines).csv(path)


def read_concept_map(spark: SparkSession, path: str) -> DataFrame:
    """A reviewed concept map; rows with a blank class are left out."""
    return spark.read.schema(CONCEPT_MAP).option("header", True).option("escape", '"').csv(path).where("trim(coalesce(unified_class, '')) <> ''")


def write_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """A table as CSV files in order, blanks at the ends of values kept."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_corpus(items: DataFrame, path: str) -> None:
    """Items (out_name, split, labels: array of cid, cx, cy, w, h) as Parquet by split; overwriting leaves nothing stale."""
    items.write.mode("overwrite").partitionBy("split").parquet(path)


def write_label_files(items: DataFrame, folder: str) -> int:
    """One text file for each item at ``labels/<split>/<out_name>.txt``, written whole and then named; returns the number of files.

    ``folder`` must be a file system all executors share.
    """

    def run(batches):
        import pandas as pd

        for batch in batches:
            for split, name, text in zip(batch["split"], batch["out_name"], batch["text"]):
                place = Path(folder) / "labels" / split
                place.mkdir(parents=True, exist_ok=True)
                fd, temporary = tempfile.mkstemp(dir=place, suffix=".part")
                with os.fdopen(fd, "w", encoding="utf-8") as f:
                    f.write(text)
                os.replace(temporary, place / f"{name}.txt")
            yield pd.DataFrame({"n": [len(batch)]})

    lines = F.transform("labels", lambda b: label_line(b["cid"], b))
    text = F.when(F.size(lines) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    written = items.select("split", "out_name", text.alias("text")).mapInPandas(run, "n long")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_lines(df: DataFrame, column: str, order: list[str], path: str, by: str | None = None) -> None:
    """A column as text files in order; ``by`` gives a folder for each of its values (lists by domain)."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order).select(*([by] if by else []), F.col(column).cast("string").alias("value"))
    writer = out.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).text(path)


def write_atomically(path: str, text: str) -> None:
    """A small file written beside its place and moved there whole."""
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    fd, temporary = tempfile.mkstemp(dir=p.parent)
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(temporary, p)


def dataset_yaml(names: dict[int, str], train: str, val: str, test: str, path: str | None = None) -> str:
    """Text of a training configuration; without ``path`` the lists stand for themselves."""
    head = [f"path: {path}"] if path else []
    return "\n".join([*head, f"train: {train}", f"val: {val}", f"test: {test}", "names:", *[f"  {i}: {n}" for i, n in sorted(names.items())], ""])


def domain_yaml(base: str, split: str, domain: str) -> str:
    """A training configuration (text of ``dataset_yaml``) whose ``split`` is the list of one domain; its path goes, train and val stay or get their usual places."""
    lines = [x for x in base.splitlines() if not x.startswith(("path:", f"{split}:"))]
    keys = {x.split(":")[0] for x in lines}
    extra = [f"{k}: images/{k}" for k in ("train", "val") if k not in keys and k != split]
    return "\n".join([*extra, f"{split}: {split}_{domain}.txt", *lines, ""])


def copy_images(jobs: DataFrame, change: Callable[[bytes], bytes | None] | None = None) -> DataFrame:
    """Files copied by tasks: jobs (source, target, changed: whether ``change`` applies to the content); counts of copied, changed and failed ones.

    Each file is written beside its place and moved there whole. A source that
    is missing, or that ``change`` gives None for, is a failure and writes
    nothing. Paths must lie on a file system all executors share.
    """

    def run(batches):
        import pandas as pd

        for batch in batches:
            done = {"copied": 0, "changed": 0, "failed": 0}
            for source, target, changed in zip(batch["source"], batch["target"], batch["changed"]):
                try:
                    data = Path(source.removeprefix("file://")).read_bytes()
                except OSError:
                    data = None
                if data is not None and changed and change is not None:
                    data = change(data)
                if data is None:
                    done["failed"] += 1
                    continue
                place = Path(target)
                place.parent.mkdir(parents=True, exist_ok=True)
                fd, temporary = tempfile.mkstemp(dir=place.parent, suffix=".part")
                with os.fdopen(fd, "wb") as f:
                    f.write(data)
                os.replace(temporary, place)
                done["changed" if changed and change is not None else "copied"] += 1
            yield pd.DataFrame([done])

    counts = jobs.select("source", "target", F.coalesce("changed", F.lit(False)).alias("changed")).mapInPandas(run, "copied long, changed long, failed long")
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("copied", "changed", "failed")])


def write_images(items: DataFrame, folder: str, out_w: int, out_h: int, mode: str = "crop") -> DataFrame:
    """Images of items (image_path, split, out_name) in the target geometry at ``images/<split>/<out_name>.png``; counts as of ``copy_images``. PNG and BMP are read, others are failures."""

    def change(data: bytes) -> bytes | None:
        image = images.decode(data)
        return None if image is None else images.encode_png(pixels.fitted(image, out_w, out_h, mode))

    place = F.concat(F.lit(f"{folder}/images/"), F.col("split"), F.lit("/"), F.col("out_name"), F.lit(".png"))
    return copy_images(items.select(F.regexp_replace("image_path", "^file:/+", "/").alias("source"), place.alias("target"), F.lit(True).alias("changed")), change)


def enhanced(data: bytes) -> bytes | None:
    """White balance, gamma and contrast of a PNG or BMP, the inputs of the enhancement network, blended in equal parts (the network's weights are not here)."""
    image = images.decode(data)
    if image is None or image.ndim == 2:
        return None
    three = [pixels.white_balance(image), pixels.gamma(image), np.repeat(pixels.clahe(images.grey(image))[..., None], 3, axis=2)]
    return images.encode_png(np.rint(np.mean(three, axis=0)).astype(np.uint8))


def publish_enhanced(spark: SparkSession, corpus: str, out: str, names: dict[int, str]) -> None:
    """What makes an enhanced corpus ready for training beside its images: the label files of ``corpus``, its repeat list, and two configurations without a path."""
    labels = listed(spark, f"{corpus}/labels", "*.txt").select(F.regexp_replace("path", "^file:/+", "/").alias("source"))
    copy_images(labels.select("source", F.regexp_replace("source", "^" + re.escape(corpus.rstrip("/")), out.rstrip("/")).alias("target"), F.lit(False).alias("changed"))).collect()
    write_atomically(f"{out}/dataset.yaml", dataset_yaml(names, "images/train", "images/val", "images/test"))
    write_atomically(f"{out}/dataset_rfs.yaml", dataset_yaml(names, "train_rfs.txt", "images/val", "images/test"))
    if os.path.exists(f"{corpus}/train_rfs.txt"):
        write_atomically(f"{out}/train_rfs.txt", Path(f"{corpus}/train_rfs.txt").read_text(encoding="utf-8"))


def coco_json(images: DataFrame, annotations: DataFrame, classes: DataFrame, path: str) -> None:
    """Compiled images and annotations as JSON lines in three folders, ids in order (one document would need one task); ``readers.read_coco`` reads them again."""
    for name, df, key in (("images", images, "id"), ("annotations", annotations, "id"), ("categories", classes.select(F.col("cid").alias("id"), "name"), "id")):
        df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").json(f"{path}/{name}")


#: States of a source (fixed values).
STATES = ("pending", "downloading", "extracting", "complete", "failed", "manual_required")


class StateTable:
    """State of every dataset in one small file, replaced whole at every change."""

    def __init__(self, path: str) -> None:
        self.path = path
        try:
            self.datasets = json.loads(Path(path).read_text(encoding="utf-8"))["datasets"]
        except (OSError, ValueError, KeyError):
            self.datasets = {}

    def status(self, name: str) -> str:
        return self.datasets.get(name, {}).get("status", "pending")

    def set(self, name: str, status: str, **more) -> None:
        if status not in STATES:
            raise ValueError(f"no state {status}")
        self.datasets[name] = {**self.datasets.get(name, {}), **more, "status": status, "updated": time.strftime("%Y-%m-%d %H:%M:%S")}
        write_atomically(self.path, json.dumps({"version": 1, "datasets": self.datasets}, indent=1))

    def listing(self, spark: SparkSession, registry: DataFrame) -> DataFrame:
        """Datasets of the registry (name) with their state, pending if none is known."""
        rows = [(k, v.get("status"), v.get("updated")) for k, v in self.datasets.items()]
        known = spark.createDataFrame(rows, "name string, status string, updated string")
        return registry.join(F.broadcast(known), "name", "left").withColumn("status", F.coalesce("status", F.lit("pending")))  # one row a dataset


def first_success(methods: list, manual: bool = False) -> bool:
    """Tries ways to get a source (callables that return success): the first success ends it; manual ones must all succeed."""
    if manual:
        return bool(methods) and all([m() for m in methods])
    return any(m() for m in methods)


