"""Annotation formats into one nested model.

Every reader gives dataset, image_path, boxes (array of struct), group, negative
and seq (a sort key that keeps the source's order). Boxes keep their source
label until mapping. Broken inputs are skipped as each docstring says.

``*_samples`` take parsed rows; ``read_*`` take files, all alike: (spark,
annotations, images, dataset, options). With ``images``, a folder, each sample's
image is looked up there (``listing.find_images``) and samples without one go;
``images=None`` keeps the names as they are written.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkshoal.functions import boxes as B
from sparkshoal.functions import images as I
from sparkshoal.functions import pixels
from sparkshoal.functions.keys import make_group, number
from sparkshoal.functions.text import SPACE, file_name, file_stem, strip_space
from sparkshoal.operators.labels import small
from sparkshoal.operators.packing import read_tiny_files
from sparkshoal.operators.reduction import first_of_each
from sparkshoal.sources.listing import IMAGE_TYPES, find_images, listed

IMAGE = "struct<id:bigint,file_name:string,width:double,height:double,dive:string>"
COCO = f"images array<{IMAGE}>, annotations array<struct<image_id:bigint,category_id:bigint,bbox:array<double>,iscrowd:int>>, categories array<struct<id:bigint,name:string>>"
VOC = "filename string, size struct<width:string,height:string>, object array<struct<name:string,bndbox:struct<xmin:string,ymin:string,xmax:string,ymax:string>>>"
EMPTY = f"array<{B.BOX}>"


def _samples(df: DataFrame, dataset: str, image: Column, boxes: Column, group: Column, seq: Column, negative: Column | None = None) -> DataFrame:
    return df.select(F.lit(dataset).alias("dataset"), image.alias("image_path"), F.coalesce(boxes, F.array().cast(EMPTY)).alias("boxes"), group.alias("group"), (F.lit(False) if negative is None else negative).alias("negative"), seq.alias("seq"))


def on_disk(samples: DataFrame, files: DataFrame, folder: str, mode: str = "none", pattern: str | None = None, other: Column | None = None) -> DataFrame:
    """Samples with the path of their image among ``files`` (path) of a folder; ``other`` is a second name to try. Those without a file go.

    Groups made from names (mode none or regex) are made from the file found.
    """
    columns = samples.columns
    found = find_images(samples.withColumnRenamed("image_path", "_named"), "_named", files, folder)
    if other is not None:
        found = find_images(found.withColumnRenamed("image_path", "_first").withColumn("_other", other), "_other", files, folder)
        found = found.withColumn("image_path", F.coalesce("_first", "image_path"))
    found = found.where("image_path is not null")
    if mode != "field":
        found = found.withColumn("group", make_group(file_stem(F.col("image_path")), mode, pattern))
    return found.select(*columns)


def coco_samples(docs: DataFrame, dataset: str, mode: str = "none", pattern: str | None = None) -> DataFrame:
    """Samples of parsed COCO documents (columns path, images, annotations, categories).

    Crowd annotations, those without an image, with a box that isn't four numbers or
    an image without positive sides give no box; an unknown category's label is its
    id. Of repeated image ids the last counts, in the place of the first.
    """
    # Images and annotations of a document become rows in one pass and meet in one aggregation by image, which is the only shuffle.
    name = lambda a: F.coalesce(F.try_element_at(F.filter("categories", lambda c: c["id"] == a["category_id"]), F.lit(-1))["name"], a["category_id"].cast("string"))
    plain = F.filter("annotations", lambda a: (F.coalesce(a["iscrowd"], F.lit(0)) == 0) & (F.size(a["bbox"]) == 4))
    none = lambda kind: F.lit(None).cast(kind)
    an_type = "struct<at:int,name:string,bb:array<double>>"
    ims = F.transform("images", lambda im, i: F.struct(im["id"].alias("id"), i.alias("pos"), im.alias("im"), none(an_type).alias("an")))
    ans = F.transform(plain, lambda a, i: F.struct(a["image_id"].alias("id"), none("int").alias("pos"), none(IMAGE).alias("im"), F.struct(i.alias("at"), name(a).alias("name"), a["bbox"].alias("bb")).alias("an")))
    empty = F.array().cast(f"array<struct<id:bigint,pos:int,im:{IMAGE},an:{an_type}>>")
    rows = docs.select(F.col("path").alias("_doc"), F.explode(F.concat(F.coalesce(ims, empty), F.coalesce(ans, empty))).alias("x")).select("_doc", "x.*")
    out = rows.groupBy("_doc", "id").agg(F.min("pos").alias("seq"), F.max_by("im", "pos").alias("im"), F.array_sort(F.collect_list("an")).alias("ans")).where("seq is not null")

    def one(a: Column) -> Column:
        x, y, w, h = (a["bb"][i] for i in range(4))
        return B.from_corners(a["name"], x, y, x + w, y + h, F.col("im.width"), F.col("im.height"))

    stem = file_stem(F.col("im.file_name"))
    return _samples(out, dataset, F.col("im.file_name"), B.valid(F.transform("ans", one)), make_group(stem, mode, pattern, F.col("im.dive")), F.col("seq"))


def coco_table_samples(images: DataFrame, annotations: DataFrame, categories: DataFrame, dataset: str, mode: str = "none", pattern: str | None = None) -> DataFrame:
    """As ``coco_samples``, of one corpus given as three tables (rows of COCO's three lists): the form in which no task holds a whole document.

    ``seq`` is the image's id. Of repeated ids of images or categories one counts.
    """
    im = images.where("id is not null").groupBy("id").agg(F.max(F.struct("file_name", "width", "height", "dive")).alias("im"))
    names = categories.groupBy(F.col("id").alias("category_id")).agg(F.max("name").alias("name"))
    plain = annotations.where((F.coalesce("iscrowd", F.lit(0)) == 0) & (F.size("bbox") == 4))
    named = plain.join(small(names), "category_id", "left").join(im, F.col("image_id") == im.id)
    x, y, w, h = (F.col("bbox")[i] for i in range(4))
    one = B.from_corners(F.coalesce("name", F.col("category_id").cast("string")), x, y, x + w, y + h, F.col("im.width"), F.col("im.height"))
    per = named.select("image_id", F.col("_order"), one.alias("b")).where("b is not null").groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("_order", "b"))).alias("bs"))
    out = im.join(per, F.col("id") == per.image_id, "left")
    stem = file_stem(F.col("im.file_name"))
    return _samples(out, dataset, F.col("im.file_name"), B.valid(F.transform("bs", lambda s: s["b"])), make_group(stem, mode, pattern, F.col("im.dive")), F.col("id"))


def read_coco(spark: SparkSession, annotations: str, images: str | None, dataset: str, mode: str = "none", pattern: str | None = None, tables: bool = False) -> DataFrame:
    """Samples of COCO documents; with ``tables`` of a folder of JSON lines as ``tables.coco_json`` writes it."""
    if tables:
        struct = lambda name: T.StructType.fromDDL(COCO)[name].dataType.elementType
        im, an, cat = (spark.read.schema(T.StructType([*struct(k).fields, *([T.StructField("id", T.LongType())] if k == "annotations" else [])])).json(f"{annotations}/{k}") for k in ("images", "annotations", "categories"))
        found = coco_table_samples(im, an.withColumn("_order", F.coalesce("id", F.monotonically_increasing_id())), cat, dataset, mode, pattern)
    else:
        docs = spark.read.option("multiLine", True).schema(COCO).json(annotations).withColumn("path", F.input_file_name())
        found = coco_samples(docs, dataset, mode, pattern)
    return found if images is None else on_disk(found, listed(spark, images), images, mode, pattern)


def voc_samples(docs: DataFrame, dataset: str, mode: str = "none", pattern: str | None = None) -> DataFrame:
    """Samples of parsed VOC files (columns of ``VOC`` and path).

    A file without positive sizes is skipped, an object without a name or with a
    coordinate that is no number too. Names are stripped. The image is the named one, else the file's stem.
    """
    docs = docs.withColumns({"_w": number(strip_space(F.col("size.width"))), "_h": number(strip_space(F.col("size.height")))}).where("_w > 0 and _h > 0")
    # Numbers are read once for each object, then put together.
    read = lambda o: F.struct(strip_space(o["name"]).alias("label"), *[number(strip_space(o["bndbox"][k])).alias(k) for k in ("xmin", "ymin", "xmax", "ymax")])
    docs = docs.withColumn("_read", F.transform(F.coalesce("object", F.array().cast("array<struct<name:string,bndbox:struct<xmin:string,ymin:string,xmax:string,ymax:string>>>")), read))
    named = F.coalesce(F.nullif(strip_space(F.col("filename")), F.lit("")), file_stem(F.col("path")))
    whole = F.filter("_read", lambda o: (F.coalesce(o["label"], F.lit("")) != "") & (o["xmin"] + o["ymin"] + o["xmax"] + o["ymax"]).isNotNull())
    objects = F.transform(whole, lambda o: B.from_corners(o["label"], o["xmin"], o["ymin"], o["xmax"], o["ymax"], F.col("_w"), F.col("_h")))
    return _samples(docs, dataset, named, B.valid(objects), make_group(file_stem(named), mode, pattern), F.col("path"))


def read_voc(spark: SparkSession, annotations: str, images: str | None, dataset: str, mode: str = "none", pattern: str | None = None) -> DataFrame:
    """Samples of VOC files; an image that isn't found by its name is looked for by the file's stem."""
    docs = spark.read.format("xml").option("rowTag", "annotation").option("recursiveFileLookup", "true").schema(VOC).load(annotations).withColumn("path", F.input_file_name())
    found = voc_samples(docs, dataset, mode, pattern)
    return found if images is None else on_disk(found, listed(spark, images), images, mode, pattern, F.concat(file_stem(F.col("seq")), F.lit(".jpg")))


def yolo_boxes(body: Column, names: list[str]) -> Column:
    """Valid boxes of a label file's text: lines of at least five numbers; an index past ``names`` is its own label."""
    table = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")

    # One step a pass, so that no line is split and no number read more than once.
    lines = F.filter(F.split(F.coalesce(body, F.lit("")), r"\r\n|\n|\r"), lambda x: x != "")
    tokens = F.filter(F.transform(lines, lambda x: F.split(strip_space(x), f"{SPACE}+")), lambda t: F.size(t) >= 5)
    numbers = F.transform(tokens, lambda t: F.transform(F.slice(t, 1, 5), number))
    read = F.filter(numbers, lambda v: F.forall(v, lambda x: x.isNotNull()) & (F.abs(v[0]) < 1e9))

    def one(v: Column) -> Column:
        index = v[0].cast("int")
        known = (index >= 0) & (index < len(names))
        label = F.when(known, F.get(table, F.when(known, index).otherwise(0))).otherwise(index.cast("string"))
        return B.box(label, v[1], v[2], v[3], v[4])

    return B.valid(F.transform(read, one))


def yolo_samples(images: DataFrame, labels: DataFrame, dataset: str, names: list[str], mode: str = "none", pattern: str | None = None) -> DataFrame:
    """Samples of images (path), each with the boxes of the label file (path, body) of its stem, if there is one."""
    own = labels.select(file_stem(F.col("path")).alias("stem"), F.col("path").alias("l_path"), "body").groupBy("stem").agg(F.min_by("body", "l_path").alias("body"))
    out = images.select("path", file_stem(F.col("path")).alias("stem")).join(own, "stem", "left")
    return _samples(out, dataset, F.col("path"), yolo_boxes(F.col("body"), names), make_group(F.col("stem"), mode, pattern), F.col("path"))


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder whose ending is an image's."""
    return listed(spark, folder).where(F.lower("path").rlike("(" + "|".join(x.replace(".", r"\.") for x in IMAGE_TYPES) + ")$"))


def read_yolo(spark: SparkSession, annotations: str, images: str, dataset: str, names: list[str] = (), mode: str = "none", pattern: str | None = None) -> DataFrame:
    """Samples of a folder of images with the label files of a folder of annotations."""
    labels = read_tiny_files(spark, annotations, "*.txt").select(F.col("file_path").alias("path"), "body")
    return yolo_samples(image_files(spark, images), labels, dataset, list(names), mode, pattern)


def yolo_corpus(spark: SparkSession, root: str) -> DataFrame:
    """A written corpus read again: split, stem and cid of every label line with five parts; images without lines keep one row with a null cid."""
    raw = read_tiny_files(spark, f"{root}/labels", "*.txt").select(F.col("file_path").alias("path"), F.col("body").alias("value"))
    parts = raw.select(F.regexp_extract("path", r"/labels/([^/]+)/", 1).alias("split"), file_stem(F.col("path")).alias("image"), F.explode_outer(F.filter(F.transform(F.split("value", r"\r\n|\n|\r"), lambda x: F.split(strip_space(x), f"{SPACE}+")), lambda t: F.size(t) >= 5)).alias("t"))
    return parts.select("split", "image", F.try_element_at("t", F.lit(1)).try_cast("int").alias("cid"))


def mask_samples(images: DataFrame, dataset: str, palette: dict[str, str], least: float = 0.0015, most: float = 0.6, mode: str = "none", pattern: str | None = None) -> DataFrame:
    """Samples of colour masks: columns path, height, width, data (BGR bytes). ``palette`` maps "R,G,B" to a label."""
    table = {tuple(int(x) for x in k.split(",")): v for k, v in palette.items()}

    def run(batches):
        for batch in batches:
            found = []
            for h, w, data in zip(batch["height"], batch["width"], batch["data"]):
                rgb = np.frombuffer(data, dtype=np.uint8).reshape(int(h), int(w), 3)[:, :, ::-1]
                found.append([dict(zip(("label", "cx", "cy", "w", "h"), b)) for b in pixels.palette_boxes(rgb, table, least, most)])
            yield pd.DataFrame({"path": batch["path"], "boxes": found})

    out = images.select("path", "height", "width", "data").where("data is not null").mapInPandas(run, f"path string, boxes {EMPTY}")
    return _samples(out, dataset, F.col("path"), F.col("boxes"), make_group(file_stem(F.col("path")), mode, pattern), F.col("path"))


def decoded(spark: SparkSession, folder: str, colour: bool) -> DataFrame:
    """Image files below a folder as path, height, width, data: BGR bytes, or grey ones. Files that can't be read have null data."""

    def run(batches):
        for batch in batches:
            found = [I.decode(c) for c in batch["content"]]
            if colour:
                found = [None if x is None else (np.repeat(x[..., None], 3, axis=2) if x.ndim == 2 else x[..., ::-1]) for x in found]
            else:
                found = [None if x is None else I.grey(x) for x in found]
            shapes = [(0, 0) if x is None else x.shape[:2] for x in found]
            yield pd.DataFrame({"path": batch["path"], "height": [s[0] for s in shapes], "width": [s[1] for s in shapes], "data": [None if x is None else np.ascontiguousarray(x).tobytes() for x in found]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "content")
    wanted = files.where(F.lower("path").rlike("(" + "|".join(x.replace(".", r"\.") for x in IMAGE_TYPES) + ")$"))
    return wanted.mapInPandas(run, "path string, height int, width int, data binary")


def read_masks(spark: SparkSession, annotations: str, images: str | None, dataset: str, palette: dict[str, str] | None = None, least: float = 0.0015, most: float = 0.6, mode: str = "none", pattern: str | None = None) -> DataFrame:
    """Samples of colour mask files (PNG or BMP; see ``functions.images``)."""
    found = mask_samples(decoded(spark, annotations, True), dataset, palette or {}, least, most, mode, pattern)
    return found if images is None else on_disk(found.withColumn("image_path", file_name(F.col("image_path"))), listed(spark, images), images, mode, pattern)


def read_negatives(spark: SparkSession, annotations: str, images: str | None, dataset: str, obstacles: list[int] = (0,), most: float = 0.01, mode: str = "none", pattern: str | None = None) -> DataFrame:
    """Images known to be empty by their grey code masks (PNG)."""
    found = negative_samples(decoded(spark, annotations, False), dataset, list(obstacles), most, mode, pattern)
    return found if images is None else on_disk(found, listed(spark, images), images, mode, pattern)


def negative_samples(masks: DataFrame, dataset: str, obstacles: list[int], most: float = 0.01, mode: str = "none", pattern: str | None = None) -> DataFrame:
    """Images known to be empty: grey code masks (path, height, width, data) named ``<stem>m.png`` with at most a share of obstacle pixels."""

    def run(batches):
        for batch in batches:
            share = [pixels.share_of(np.frombuffer(d, dtype=np.uint8), obstacles) for d in batch["data"]]
            yield pd.DataFrame({"path": batch["path"], "share": share})

    shares = masks.where(F.col("path").rlike(r"m\.png$") & F.col("data").isNotNull()).select("path", "data").mapInPandas(run, "path string, share double")
    stem = F.regexp_replace(file_stem(F.col("path")), "m$", "")
    return _samples(shares.where(F.col("share") <= most), dataset, stem, F.array().cast(EMPTY), make_group(stem, mode, pattern), F.col("path"), F.lit(True))


def smd_boxes(rows: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Frame boxes in 1-based pixels (video, frame, cls, xmin, ymin, w, h, width, height) as normalised boxes of frame ``frame - 1``; class 0 is invalid.

    ``sizes`` (video, width, height) gives the size of each video once for all its frames, where rows have none.
    """
    if sizes is not None:
        rows = rows.drop("width", "height").join(small(sizes.groupBy("video").agg(F.max("width").alias("width"), F.max("height").alias("height"))), "video")
    x, y = F.col("xmin") - 1, F.col("ymin") - 1
    b = B.from_corners(F.col("cls").cast("string"), x, y, x + F.col("w"), y + F.col("h"), F.col("width"), F.col("height"))
    per = rows.where("cls <> 0").groupBy("video", (F.col("frame") - 1).alias("frame")).agg(F.collect_list(b).alias("boxes"))
    return per.withColumn("boxes", B.strictly_inside(F.col("boxes")))


def qualifying_videos(rows: DataFrame, classes: list[int]) -> DataFrame:
    """Videos (video, boxes) with at least one box of the wanted classes; ``rows`` as ``smd_boxes`` takes them."""
    return rows.where(F.col("cls").isin(list(classes))).groupBy("video").agg(F.count("*").alias("boxes"))


def concept_index(results: DataFrame, most: int, order: list[str]) -> DataFrame:
    """A search index cut to ``most`` records a concept: those without a url go before the cut."""
    return first_of_each(results.where("url is not null and url <> ''"), "concept", order, most)


def read_smd(spark: SparkSession, path: str) -> DataFrame:
    """Ground truth of MATLAB files as rows for ``smd_boxes`` (give it the videos' sizes); needs SciPy, raises ImportError where it is missing."""
    import scipy.io  # noqa: F401

    def run(batches):
        import io

        import scipy.io as sio

        for batch in batches:
            rows = []
            for p, content in zip(batch["path"], batch["content"]):
                mat = sio.loadmat(io.BytesIO(content), squeeze_me=True, struct_as_record=False)
                frames = np.atleast_1d(next(v for k, v in mat.items() if not k.startswith("__")))
                for i, f in enumerate(frames, 1):
                    for c, bb in zip(np.atleast_1d(getattr(f, "Objects", [])), np.atleast_2d(getattr(f, "BB", np.zeros((0, 4))))):
                        rows.append((p, i, int(c), *map(float, bb)))
            yield pd.DataFrame(rows, columns=["video", "frame", "cls", "xmin", "ymin", "w", "h"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "video string, frame int, cls int, xmin double, ymin double, w double, h double")


#: Readers by name; a configuration's layout names one.
READERS: dict[str, Callable[..., DataFrame]] = {"coco": read_coco, "voc": read_voc, "yolo": read_yolo, "mask_rgb": read_masks, "mask_negative": read_negatives}


def read(name: str, *args, **options) -> DataFrame:
    """Samples by a named reader (spark, annotations, images, dataset, options); an unknown name raises ValueError."""
    if name not in READERS:
        raise ValueError(f"no reader {name}; there are {', '.join(READERS)}")
    return READERS[name](*args, **options)


def union(parts: list[DataFrame]) -> DataFrame:
    """All parts of all sources, one below the other, with the part's number."""
    if not parts:
        raise ValueError("nothing to read")
    numbered = [p.withColumn("seq", F.col("seq").cast("string")).withColumn("part", F.lit(i)) for i, p in enumerate(parts)]
    out = numbered[0]
    for p in numbered[1:]:
        out = out.unionByName(p)
    return out
