"""All core queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkshoal.functions import boxes as B
from sparkshoal.functions import keys as K
from sparkshoal.functions import images, pixels
from sparkshoal.functions.text import file_name, file_stem, split_name
from sparkshoal.operators import audit, concepts, corpus, labels, lookup, packing, reduction
from sparkshoal.operators.labels import small
from sparkshoal.plans import build
from sparkshoal.session import scratch_path, table
from sparkshoal.sources import archives, listing, readers, tables
from sparkshoal.streaming import progress as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def micro(c: Column) -> Column:
    """Millionths as a whole number: alike in every engine where the doubles are."""
    return F.floor(c * 1e6 + 0.5)


_SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SPLIT = "case when b < 80 then 'train' when b < 90 then 'val' else 'test' end"
BUCKET = "('0x' || substr(md5({}), 1, 8))::bigint % 100"
SKEW = "floor(log2(1 + l_partkey % 256))::int"
ORDER_SPLIT = f"select o_orderkey image, {SPLIT} split from (select o_orderkey, {BUCKET.format("'42:orders:' || o_custkey")} b from orders)"


def skewed_class() -> Column:
    return F.floor(F.log2(1 + F.col("l_partkey") % 256)).cast("int")


def order_images(spark: SparkSession, d: str) -> DataFrame:
    """Orders as images, customers as their groups."""
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("image"), F.col("o_custkey").cast("string").alias("group")).withColumn("split", corpus.split_of(42, F.lit("orders"), F.col("group")))


def order_labels(spark: SparkSession, d: str, cid: Column) -> DataFrame:
    """Lines of orders as boxes of images."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("image"), cid.alias("cid"))
    return lines.join(order_images(spark, d).select("image", "split"), "image")


# ---------------------------------------------------------------- the corpus report

FLAGS = [(0, "A"), (1, "N"), (2, "R"), (3, "none")]
REPORT_SQL = f"""with im as ({ORDER_SPLIT}), l as (select l_orderkey image, case l_returnflag when 'A' then 0 when 'N' then 1 when 'R' then 2 end cid from lineitem),
x as (select l.*, split from l join im using (image)), c as (select * from (values (0,'A'),(1,'N'),(2,'R'),(3,'none')) t(cid, name)),
a as (select cid, count(*) boxes, count(distinct image) images, count(distinct case when split='train' then image end) train_images, count(distinct case when split='val' then image end) val_images, count(distinct case when split='test' then image end) test_images from x group by cid)
select c.cid, c.name, coalesce(boxes,0) boxes, coalesce(images,0) images, round(100 * coalesce(boxes,0) / greatest(sum(coalesce(boxes,0)) over (), 1), 6) box_pct, round(coalesce(boxes/images,0.0),6) boxes_per_image, coalesce(train_images,0) train_images, coalesce(val_images,0) val_images, coalesce(test_images,0) test_images from c left join a using (cid)"""


def _report(spark: SparkSession, d: str) -> DataFrame:
    cid = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "R", 2)
    return corpus.class_report(order_labels(spark, d, cid), spark.createDataFrame(FLAGS, "cid int, name string"))


@query(REPORT_SQL)
def corpus_class_split(spark, d):
    return _report(spark, d)


@query(f"select cid, name, case when images = 0 then 'empty' else 'blind' end problem, images from ({REPORT_SQL}) where images = 0 or val_images = 0 or test_images = 0")
def blind_classes(spark, d):
    return corpus.blind_classes(_report(spark, d))


@query(f"""with im as ({ORDER_SPLIT}), n as (select o_orderkey image, count(l_orderkey) n from orders left join lineitem on l_orderkey = o_orderkey group by 1)
select split, count(*) images, count(*) filter (where n = 0) negatives, round(count(*) / sum(count(*)) over (), 6) share from im join n using (image) group by split""")
def split_shares(spark, d):
    n = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("image")).agg(F.count("*").alias("k"))
    items = order_images(spark, d).join(n, "image", "left").withColumn("n_labels", F.coalesce("k", F.lit(0)))
    return corpus.split_shares(items)


# ---------------------------------------------------------------- labels

EVENT_MAP = {"events": {"View": "seen", "click": "touched", "ERROR ": "broken", "signup": "gone"}}
EVENT_NAMES = {0: "seen", 1: "touched", 2: "purchase"}


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    classes, entries = labels.taxonomy(spark, EVENT_NAMES, EVENT_MAP)
    return labels.map_labels(table(spark, d, "events").withColumn("dataset", F.lit("events")), classes, entries, label="event_type")


# "View" meets "view" without regard to case; "ERROR " doesn't meet "error" (keys aren't stripped); "gone" is a dead target; "purchase" is a class of that name.
MAPPED_SQL = "select *, case event_type when 'view' then 0 when 'click' then 1 when 'purchase' then 2 end cid, event_type = 'error' dropped from events"


@query(f"""with m as ({MAPPED_SQL}), u as (select user_id, count(*) source_boxes, count(cid) kept from m group by 1)
select case when kept > 0 then 'kept' when source_boxes > 0 then 'dropped_all_labels' else 'no_annotations' end disposition, count(*) samples, sum(source_boxes)::bigint source_boxes, sum(kept)::bigint kept_boxes from u group by 1""")
def map_label_dispositions(spark, d):
    per = _mapped(spark, d).groupBy("user_id").agg(F.count("*").alias("source_boxes"), F.count("cid").alias("kept"))
    per = per.withColumn("disposition", labels.disposition(F.col("source_boxes"), F.col("kept"), F.lit(False)))
    return per.groupBy("disposition").agg(F.count("*").alias("samples"), F.sum("source_boxes").alias("source_boxes"), F.sum("kept").alias("kept_boxes"))


@query(f"select 'events' dataset, event_type label, count(*) boxes from ({MAPPED_SQL}) where dropped group by 2")
def dropped_labels(spark, d):
    return labels.dropped_counts(_mapped(spark, d), label="event_type")


@query("select * from (values ('events','ERROR ','broken'),('events','signup','gone')) t(dataset, label, class)")
def dead_targets(spark, d):
    return labels.dead_targets(*labels.taxonomy(spark, EVENT_NAMES, EVENT_MAP))


# ---------------------------------------------------------------- groups and splits


@query(f"select event_id, 'user' || user_id \"group\", {SPLIT} split from (select *, {BUCKET.format("'7:events:user' || user_id")} b from events)")
def group_split(spark, d):
    g = F.concat(F.lit("user"), F.col("user_id").cast("string"))
    return table(spark, d, "events").select("event_id", g.alias("group")).withColumn("split", corpus.split_of(7, F.lit("events"), F.col("group")))


@query(f"""with s as (select *, 'user' || user_id g, {BUCKET.format("'7:events:user' || user_id")} b from events), t as (select *, {SPLIT} split from s)
select 'events' dataset, count(distinct g) "groups", count(*) images, string_agg(distinct split, ',' order by split) splits, count(distinct g) < 10 and count(*) >= 100 too_few_groups from t""")
def group_report(spark, d):
    return corpus.group_report(group_split(spark, d).withColumn("dataset", F.lit("events")))


@query(r"""select sample_id, case when dataset in ('kelpline','murkbay') then regexp_extract(stem, '^(?:([A-Za-z]+[-_][0-9]+).*)', 1) else stem end g, dataset || '_' || substr(sha1(image_path), 1, 10) out_name from (select *, regexp_replace(regexp_extract(image_path, '[^/]*$'), '(.)\.[^.]*$', '\1') stem from samples) where dataset not in ('kelpline','murkbay') or regexp_matches(stem, '^(?:([A-Za-z]+[-_][0-9]+).*)')
union all select sample_id, stem, dataset || '_' || substr(sha1(image_path), 1, 10) from (select *, regexp_replace(regexp_extract(image_path, '[^/]*$'), '(.)\.[^.]*$', '\1') stem from samples) where dataset in ('kelpline','murkbay') and not regexp_matches(stem, '^(?:([A-Za-z]+[-_][0-9]+).*)')""")
def image_keys(spark, d):
    stem = file_stem(F.col("image_path"))
    by_clip = F.col("dataset").isin("kelpline", "murkbay")
    g = F.when(by_clip, K.make_group(stem, "regex", "([A-Za-z]+[-_][0-9]+).*")).otherwise(K.make_group(stem))
    return table(spark, d, "samples").select("sample_id", g.alias("g"), K.out_name(F.col("dataset"), F.col("image_path")).alias("out_name"))


# ---------------------------------------------------------------- thinning


@query("select event_id, user_id from (select *, row_number() over (partition by user_id order by ts, event_id) rn from events) where (rn - 1) % 6 = 0")
def stride(spark, d):
    return reduction.stride(table(spark, d, "events").select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"], 6).select("event_id", "user_id")


@query("""with h as (select vec_id, label, list_reduce(list_prepend(0::bigint, list_transform(range(1, 64), lambda i: case when i % 8 = 0 then -1 when embedding[i] < embedding[i + 1] then 1 else 0 end::bigint)), lambda acc, x: case when x < 0 then acc else acc * 2 + x end) h from embeddings),
g as (select label, list({'v': vec_id, 'h': h} order by vec_id) l from h group by label),
k as (select label, list_reduce(list_prepend([l[1]], list_transform(l[2:], lambda x: [x])), lambda acc, x: case when len(list_filter(acc, lambda a: bit_count(xor(a.h, x[1].h)) <= 18)) > 0 then acc else list_concat(acc, x) end) kept from g)
select unnest(kept).v vec_id, label from k""")
def near_dup(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", "label", K.dhash_of_gray(F.col("embedding"), 8).alias("hash"))
    return reduction.near_duplicates(rows, ["label"], ["vec_id"], "hash", 18).select("vec_id", "label")


RARITY_SQL = f"""with f as (select {SKEW} cid, count(*) n from lineitem group by 1), t as (select sum(n) a from f),
k as (select l_orderkey image, {SKEW} cid, count(*) k from lineitem group by all),
r as (select image, round(list_reduce(list_prepend(0.0::double, list((k * (a / n))::double order by cid)), lambda acc, x: acc + x), 9) rarity from k join f using (cid), t group by image)
select o_orderkey image, o_custkey grp, coalesce(rarity, 0) rarity from orders left join r on image = o_orderkey"""


@query(f"""with i as ({RARITY_SQL}), a as (select *, row_number() over (partition by grp order by rarity desc, image) rn, min(image) over (partition by grp) head from i)
select image, grp from a order by rn, head, grp limit 3000""")
def rarity_cap(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("image"), skewed_class().alias("cid"))
    items = table(spark, d, "orders").select(F.col("o_orderkey").alias("image"), F.col("o_custkey").alias("grp"), F.lit("orders").alias("dataset"))
    rare = reduction.rarity(lines, "image", "cid", [])
    return reduction.capped(items.join(rare, "image", "left"), ["dataset"], "grp", ["image"], 3000, "image").select("image", "grp")


@query("""with p as (select doc_id, lang, n_chars, row_number() over (partition by lang order by doc_id) rn from documents where n_chars is not null and lang is not null),
o as (select *, row_number() over (partition by n_chars order by rn, lang) own from p)
select doc_id, lang, n_chars, rn turn from o where own = 1 and n_chars not in (select n_chars from documents where source = 'config_comment' and n_chars is not null) order by rn, lang limit (select greatest(0, 300 - count(distinct n_chars)) from documents where source = 'config_comment')""")
def round_robin_budget(spark, d):
    docs = table(spark, d, "documents").where("n_chars is not null and lang is not null")
    done = table(spark, d, "documents").where("source = 'config_comment' and n_chars is not null").select("n_chars")
    found = reduction.round_robin(docs.select("doc_id", "lang", "n_chars"), "lang", "lang", ["doc_id"], "n_chars", 300, done)
    return found.select("doc_id", "lang", "n_chars", F.col("turn").cast("bigint").alias("turn"))


@query("select doc_id, source from (select doc_id, source, row_number() over (partition by source order by doc_id) rn from documents where source is not null) where rn <= 25")
def first_per_concept(spark, d):
    return reduction.first_of_each(table(spark, d, "documents").where("source is not null").select("doc_id", "source"), "source", ["doc_id"], 25)


FACTOR_SQL = f"""with im as ({ORDER_SPLIT}), p as (select distinct l_orderkey image, {SKEW} cid from lineitem join im on image = l_orderkey where split = 'train'),
n as (select count(distinct image) n from p), w as (select cid, greatest(1.0, sqrt(0.1 / (count(*) / any_value(n)))) w from p, n group by cid)
select image, greatest(1, round_even(max(w), 0)::int)::int factor from p join w using (cid) group by image"""


def _factors(spark: SparkSession, d: str) -> DataFrame:
    return corpus.repeat_factors(order_labels(spark, d, skewed_class()).where("split = 'train'").select("image", "cid"))


@query(FACTOR_SQL)
def repeat_factor(spark, d):
    return _factors(spark, d)


@query(f"with f as ({FACTOR_SQL}), im as ({ORDER_SPLIT}) select image, unnest(range(1, coalesce(factor, 1) + 1))::int copy from im left join f using (image) where split = 'train'")
def rfs_list(spark, d):
    return corpus.repeated(order_images(spark, d).where("split = 'train'").select("image"), _factors(spark, d))


@query("select sample_id from samples where dataset = 'reefsnap' order by sample_id, image_path limit 50")
def first_n(spark, d):
    return corpus.top(table(spark, d, "samples").where("dataset = 'reefsnap'").select("sample_id", "image_path"), ["sample_id", "image_path"], 50).select("sample_id")


@query("select o_orderkey from orders where ('0x' || substr(md5('0:' || o_orderkey), 1, 8))::bigint % 1000000 < 100000")
def hash_sample(spark, d):
    return corpus.sampled(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.1)


# ---------------------------------------------------------------- geometry

SAMPLE_SIZES = "select sample_id, any_value(width) width, any_value(height) height from (select sample_id, width, height from samples where width is not null and height is not null order by all) group by 1 having min(width) = max(width) and min(height) = max(height)"
ONE_BOX = "select distinct box_id, sample_id, label, cx, cy, w, h from boxes where box_id in (select box_id from boxes group by 1 having count(distinct (cx, cy, w, h)) <= 1)"


def _box_rows(spark: SparkSession, d: str, change: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """Each box with its image's size, changed as an array of one box; what is left, in millionths."""
    sizes = table(spark, d, "samples").where("width is not null and height is not null").groupBy("sample_id").agg(F.min("width").alias("width"), F.min("height").alias("height"), F.max("width").alias("w2"), F.max("height").alias("h2")).where("width = w2 and height = h2")
    rows = table(spark, d, "boxes").select("box_id", "sample_id", B.box(F.col("label"), F.col("cx"), F.col("cy"), F.col("w"), F.col("h")).alias("b")).distinct().join(sizes, "sample_id")
    out = rows.select("box_id", F.explode(change(B.valid(F.array("b")), F.col("width"), F.col("height"))).alias("b"))
    return out.select("box_id", *[micro(F.col(f"b.{c}")).alias(c) for c in ("cx", "cy", "w", "h")])


VALID = "isfinite(cx) and isfinite(cy) and w > 1e-4 and w <= 1.5 and h > 1e-4 and h <= 1.5 and cx > -0.5 and cx < 1.5 and cy > -0.5 and cy < 1.5"
BOXES_SQL = f"with s as (select sample_id, min(width) width, min(height) height from samples where width is not null and height is not null group by 1 having min(width) = max(width) and min(height) = max(height)), v as (select distinct b.box_id, b.label, cx, cy, w, h, width, height from boxes b join s using (sample_id) where {VALID})"
M = "floor({} * 1e6 + 0.5)::bigint"
OUT4 = lambda a, b, c, e: f"{M.format(f'({a})')} cx, {M.format(f'({b})')} cy, {M.format(f'({c})')} w, {M.format(f'({e})')} h"


@query(f"""{BOXES_SQL}, k as (select *, case when width / height > 640 / 480 then round_even(height * (640 / 480), 0)::bigint else width end cw, case when width / height > 640 / 480 then height else round_even(width / (640 / 480), 0)::bigint end ch from v),
o as (select *, floor((width - cw) / 2) xo, floor((height - ch) / 2) yo from k),
p as (select *, (cx - w / 2) * width - xo x1, (cx + w / 2) * width - xo x2, (cy - h / 2) * height - yo y1, (cy + h / 2) * height - yo y2 from o),
q as (select *, greatest((x2 - x1) * (y2 - y1), 1e-9) area, greatest(x1, 0.0) a1, greatest(y1, 0.0) b1, least(x2, cw::double) a2, least(y2, ch::double) b2 from p)
select box_id, {OUT4('(a1 + a2) / 2 / cw', '(b1 + b2) / 2 / ch', '(a2 - a1) / cw', '(b2 - b1) / ch')} from q where a2 > a1 and b2 > b1 and (a2 - a1) * (b2 - b1) / area >= 0.3""")
def box_norm_crop(spark, d):
    return _box_rows(spark, d, lambda b, w, h: B.fit(b, w, h, 640, 480, "crop"))


@query(f"""{BOXES_SQL}, k as (select *, least(640 / width, 480 / height) s from v), o as (select *, floor((640 - round_even(width * s, 0)::bigint) / 2) l, floor((480 - round_even(height * s, 0)::bigint) / 2) t from k)
select box_id, {OUT4('(cx * width * s + l) / 640', '(cy * height * s + t) / 480', 'w * width * s / 640', 'h * height * s / 480')} from o""")
def box_pad(spark, d):
    return _box_rows(spark, d, lambda b, w, h: B.fit(b, w, h, 640, 480, "pad"))


@query(f"""with v as (select distinct box_id, label, cx, cy, w, h from boxes where {VALID}), k as (select *, greatest(cx - w / 2, 0.0) x1, greatest(cy - h / 2, 0.0) y1, least(cx + w / 2, 1.0) x2, least(cy + h / 2, 1.0) y2 from v)
select box_id, {OUT4('(x1 + x2) / 2', '(y1 + y2) / 2', 'x2 - x1', 'y2 - y1')} from k where x2 - x1 >= 1e-3 and y2 - y1 >= 1e-3""")
def box_clamp(spark, d):
    """All boxes, whatever is known of their image's size."""
    rows = table(spark, d, "boxes").select("box_id", B.box(F.col("label"), F.col("cx"), F.col("cy"), F.col("w"), F.col("h")).alias("b")).distinct()
    out = rows.select("box_id", F.explode(B.clamp(B.valid(F.array("b")))).alias("b"))
    return out.select("box_id", *[micro(F.col(f"b.{c}")).alias(c) for c in ("cx", "cy", "w", "h")])


@query(f"select count(*) boxes, count(*) filter (where coalesce({VALID}, false)) valid from boxes")
def box_validity(spark, d):
    one = B.valid(F.array(B.box(F.col("label"), F.col("cx"), F.col("cy"), F.col("w"), F.col("h"))))
    return table(spark, d, "boxes").agg(F.count("*").alias("boxes"), F.count_if(F.size(one) == 1).alias("valid"))


# ---------------------------------------------------------------- readers

NUM = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
LINES_SQL = rf"""with l as (select file_id, list_filter(string_split_regex(trim(line), '\s+'), lambda x: x <> '') t from (select file_id, unnest(string_split_regex(coalesce(body, ''), '\r\n|\n|\r')) line from label_files)),
n as (select file_id, t, case when regexp_matches(t[1], {NUM}) then trunc(t[1]::double)::int end c, try_cast(t[2] as double) cx, try_cast(t[3] as double) cy, try_cast(t[4] as double) w, try_cast(t[5] as double) h from l where len(t) >= 5 and regexp_matches(t[1], {NUM}) and regexp_matches(t[2], {NUM}) and regexp_matches(t[3], {NUM}) and regexp_matches(t[4], {NUM}) and regexp_matches(t[5], {NUM})),
v as (select * from n where w > 1e-4 and w <= 1.5 and h > 1e-4 and h <= 1.5 and cx > -0.5 and cx < 1.5 and cy > -0.5 and cy < 1.5)"""
SIX = ["gear", "swimmer", "drifter", "plantlife", "reefbed", "finfish"]


@query(LINES_SQL + f" select case when c between 0 and 5 then {SIX!r}[c + 1] else c::varchar end label, count(*) boxes, sum({M.format('cx')})::bigint cx, sum({M.format('w')})::bigint w from v group by 1")
def yolo_parse(spark, d):
    found = table(spark, d, "label_files").select(F.explode(readers.yolo_boxes(F.col("body"), SIX)).alias("b"))
    return found.groupBy("b.label").agg(F.count("*").alias("boxes"), F.sum(micro(F.col("b.cx"))).alias("cx"), F.sum(micro(F.col("b.w"))).alias("w"))


@query(LINES_SQL + " select file_id, string_agg(printf('%d %.6f %.6f %.6f %.6f', c, cx, cy, w, h), ';' order by c, cx, cy, w, h) lines from v group by file_id")
def label_lines(spark, d):
    found = table(spark, d, "label_files").select("file_id", F.explode(readers.yolo_boxes(F.col("body"), [])).alias("b")).withColumn("c", F.col("b.label").cast("int"))
    line = B.label_line(F.col("c"), F.col("b"))
    return found.groupBy("file_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c", "b.cx", "b.cy", "b.w", "b.h", line.alias("line")))), lambda x: x["line"]), ";").alias("lines"))


@query("""with o as (select * from orders), l as (select l_orderkey k, coalesce(count(*) filter (where l_quantity > 0), 0) n, sum(floor(((l_quantity + l_quantity + 20) / 2 / 200) * 1e6 + 0.5))::bigint cx from lineitem group by 1)
select 'o' || o_orderkey || '.jpg' image_path, coalesce(n, 0) boxes, coalesce(cx, 0)::bigint cx from o left join l on k = o_orderkey""")
def voc_parse(spark, d):
    q = F.col("l_quantity").cast("string")
    obj = F.concat(F.lit("<object><name> "), F.col("l_returnflag"), F.lit(" </name><bndbox><xmin>"), q, F.lit("</xmin><ymin>10</ymin><xmax>"), (F.col("l_quantity") + 20).cast("string"), F.lit("</xmax><ymax>60</ymax></bndbox></object>"))
    per = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.array_join(F.collect_list(obj), "").alias("objects"))
    nameless = F.lit("<object><name> </name><bndbox><xmin>1</xmin><ymin>10</ymin><xmax>30</xmax><ymax>60</ymax></bndbox></object><object><bndbox><xmin>1</xmin><ymin>10</ymin><xmax>30</xmax><ymax>60</ymax></bndbox></object>")
    xml = F.concat(F.lit("<annotation><filename>o"), F.col("o_orderkey").cast("string"), F.lit(".jpg</filename><size><width>200</width><height>100</height></size>"), F.coalesce("objects", F.lit("")), nameless, F.lit("</annotation>"))
    docs = table(spark, d, "orders").join(per, F.col("o_orderkey") == F.col("k"), "left").select(F.from_xml(xml, readers.VOC, {"rowTag": "annotation"}).alias("x"), F.concat(F.lit("x/"), F.col("o_orderkey").cast("string"), F.lit(".xml")).alias("path")).select("path", "x.*")
    found = readers.voc_samples(docs, "orders")
    return found.select("image_path", F.size("boxes").cast("bigint").alias("boxes"), F.coalesce(F.aggregate("boxes", F.lit(0).cast("bigint"), lambda a, b: a + micro(b["cx"])), F.lit(0)).alias("cx"))


@query("""with f as (select l_orderkey k, count(*) filter (where l_linenumber <> 7) n, sum(case when l_linenumber <> 7 then floor(((l_quantity + l_quantity + 20) / 2 / 200) * 1e6 + 0.5) end)::bigint cx from lineitem group by 1)
select 'o' || o_orderkey || '.jpg' image_path, coalesce(n, 0) boxes, coalesce(cx, 0)::bigint cx, 'c' || o_custkey "group" from orders left join f on k = o_orderkey""")
def coco_parse(spark, d):
    q = F.col("l_quantity")
    an = F.struct(F.col("l_orderkey").alias("image_id"), F.lit(1).cast("bigint").alias("category_id"), F.array(q, F.lit(10.0), F.lit(20.0), F.lit(50.0)).alias("bbox"), (F.col("l_linenumber") == 7).cast("int").alias("iscrowd"))
    anns = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(an).alias("annotations"))
    im = F.array(F.struct(F.col("o_orderkey").alias("id"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("file_name"), F.lit(200.0).alias("width"), F.lit(100.0).alias("height"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("dive")))
    text = F.to_json(F.struct(im.alias("images"), F.coalesce("annotations", F.array().cast("array<struct<image_id:bigint,category_id:bigint,bbox:array<double>,iscrowd:int>>")).alias("annotations"), F.array(F.struct(F.lit(1).cast("bigint").alias("id"), F.lit("thing").alias("name"))).alias("categories")))
    docs = table(spark, d, "orders").join(anns, F.col("o_orderkey") == F.col("k"), "left").select(F.col("o_orderkey").cast("string").alias("path"), F.from_json(text, readers.COCO).alias("x")).select("path", "x.*")
    found = readers.coco_samples(docs, "orders", mode="field")
    return found.select("image_path", F.size("boxes").cast("bigint").alias("boxes"), F.coalesce(F.aggregate("boxes", F.lit(0).cast("bigint"), lambda a, b: a + micro(b["cx"])), F.lit(0)).alias("cx"), "group")


@query("select uuid, file_name, width, height, concept, len(boxes)::int n_boxes from progress where uuid is not null")
def progress_log(spark, d):
    """The log written as lines of text, each followed by a copy that is cut off and a blank line, and read again."""
    folder = scratch_path(spark, "progress-log")
    lines = table(spark, d, "progress").select(F.to_json(F.struct("uuid", "file_name", "width", "height", "dive", "concept", "cls", "boxes")).alias("line"))
    lines.select(F.explode(F.array("line", F.expr("substring(line, 1, length(line) - 2)"), F.lit(""))).alias("line")).write.mode("overwrite").text(f"{folder}/log")
    return tables.read_progress(spark, f"{folder}/log").select("uuid", "file_name", "width", "height", "concept", F.when(F.col("boxes").isNotNull(), F.size("boxes")).alias("n_boxes"))


@query(r"""with n as (select regexp_extract(source_path,'[^/]*$') name from manifest union select regexp_replace(regexp_extract(source_path,'[^/]*$'),'(.)\.[^.]*$','\1') || '.bmp' from manifest), m as (select name, regexp_replace(name,'(.)\.[^.]*$','\1') stem from n),
f as (select distinct image_path path, regexp_replace(image_path, '^kelpline/frames/', '') rel, regexp_extract(image_path,'[^/]*$') file, regexp_replace(regexp_extract(image_path,'[^/]*$'),'(.)\.[^.]*$','\1') stem, lower(regexp_extract(image_path,'(\.[^./]+)$',1)) ext from samples),
r as (select *, list_position(['.jpg','.jpeg','.png','.bmp','.tif','.tiff','.webp'], ext) rk from f)
select name, first(path order by tier, rk, path) filter (where tier is not null) image_path from (select distinct m.name, r.path, r.rk, case when rel = m.name then 0 when rel = file and rk > 0 then 1 when rk > 0 then 2 end tier from m left join r on m.stem = r.stem) group by name""")
def image_lookup(spark, d):
    files = table(spark, d, "samples").select(F.col("image_path").alias("path")).distinct()
    name = file_name(F.col("source_path"))
    wanted = table(spark, d, "manifest").select(F.explode(F.array(name, F.concat(file_stem(name), F.lit(".bmp")))).alias("name")).distinct()
    return listing.find_images(wanted, "name", files, "kelpline/frames").select("name", "image_path")


@query("""with f as (select *, count(*) over (partition by sample_id, frame) from (select sample_id video, 1 + box_id % 5 frame, case when label is null then 0 else 1 end cls, 1 + 100 * cx xmin, 1 + 100 * cy ymin, 100 * w w, 100 * h h, cx, cy from boxes) t(sample_id, frame, cls, xmin, ymin, w, h, cx, cy)),
b as (select sample_id video, frame - 1 frame, (xmin - 1 + (xmin - 1 + w)) / 2 / 100 ncx, (ymin - 1 + (ymin - 1 + h)) / 2 / 100 ncy, (xmin - 1 + w - (xmin - 1)) / 100 nw, (ymin - 1 + h - (ymin - 1)) / 100 nh, cls from f)
select video, frame, count(*) filter (where coalesce(not isnan(ncx) and not isnan(ncy) and not isnan(nw) and not isnan(nh) and ncx between 0 and 1 and ncy between 0 and 1 and nw > 0 and nw <= 1 and nh > 0 and nh <= 1, false)) boxes from b where cls <> 0 group by all""")
def smd_frames(spark, d):
    rows = table(spark, d, "boxes").select(F.col("sample_id").alias("video"), (1 + F.col("box_id") % 5).alias("frame"), F.when(F.col("label").isNull(), 0).otherwise(1).alias("cls"), (1 + 100 * F.col("cx")).alias("xmin"), (1 + 100 * F.col("cy")).alias("ymin"), (100 * F.col("w")).alias("w"), (100 * F.col("h")).alias("h"), F.lit(100).alias("width"), F.lit(100).alias("height"))
    return readers.smd_boxes(rows).select("video", "frame", F.size("boxes").cast("bigint").alias("boxes"))


# ---------------------------------------------------------------- concepts

TAXA = [("Crustadae", "crawler"), ("Mollinae", "finfish"), ("Osteida", "swimmer"), ("Veloria", "reefbed"), ("Tendriphyta", "plantlife"), ("Draekenpia", "drifter")]
TAXA_SQL = "select * from (values " + ",".join(f"('{a}','{b}')" for a, b in TAXA) + ") t(taxon, class)"
SEEN_SQL = "select b.concept, count(*) boxes from (select unnest(boxes) b from progress) where b is not null group by 1"
DESC_SQL = "select distinct trim(unnest(string_split(via, ';'))) taxon, concept descendant from fathomnet_concept_map where via is not null union select 'Veloria', 'Tendriphyta'"
RESOLVE_SQL = f"""with seen as ({SEEN_SQL}), w as ({TAXA_SQL}), ds as ({DESC_SQL}),
up as (select distinct s.concept, taxon, class from seen s join ds on descendant = s.concept left join w using (taxon)),
un as (select u.concept, u.taxon, count(*) under from up u join up o on o.concept = u.concept and o.taxon <> u.taxon join ds on ds.taxon = o.taxon and ds.descendant = u.taxon group by all),
p as (select concept, count(*) n, count(distinct class) classes, min(class) one, string_agg(taxon, ';' order by taxon) via, list(class) filter (where coalesce(under, 0) = nn - 1) deep from (select up.*, under, count(*) over (partition by concept) nn from up left join un using (concept, taxon)) group by concept)
select s.concept, s.boxes, case when w.class is not null then w.class when classes = 1 then one when classes > 1 and len(deep) = 1 then deep[1] else '' end unified_class, case when w.class is not null then 'exact' when classes = 1 then 'ancestry' when classes > 1 and len(deep) = 1 then 'ancestry-specific' when classes > 1 then 'CONFLICT' else 'unresolved' end method, case when w.class is not null then s.concept when classes >= 1 then via else '' end via from seen s left join w on w.taxon = s.concept left join p on p.concept = s.concept"""


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    seen = concepts.concept_frequency(table(spark, d, "progress").select(F.filter("boxes", lambda b: b.isNotNull()).alias("boxes")))
    wanted = spark.createDataFrame(TAXA, "concept string, class string")
    below = table(spark, d, "fathomnet_concept_map").where("via is not null").select(F.explode(F.split("via", ";")).alias("taxon"), F.col("concept").alias("descendant")).select(F.trim("taxon").alias("taxon"), "descendant")
    nested = spark.createDataFrame([("Veloria", "Tendriphyta")], "taxon string, descendant string")
    return concepts.resolve(seen, wanted, below.unionByName(nested))


@query(SEEN_SQL)
def concept_frequency(spark, d):
    return concepts.concept_frequency(table(spark, d, "progress").select(F.filter("boxes", lambda b: b.isNotNull()).alias("boxes")))


@query(RESOLVE_SQL)
def concept_resolve(spark, d):
    return _resolved(spark, d)


@query(f"select case when method = 'ancestry-specific' then 'ancestry' else lower(method) end outcome, sum(boxes)::bigint boxes, count(*) concepts from ({RESOLVE_SQL}) group by 1")
def concept_tally(spark, d):
    return concepts.tally(_resolved(spark, d))


@query("with recursive e as (select r_regionkey parent, 100 + n_nationkey child from region join nation on n_regionkey = r_regionkey union select 100 + n_nationkey, 1000 + s_suppkey from nation join supplier on s_nationkey = n_nationkey), t as (select parent taxon, child descendant from e union select t.taxon, e.child from t join e on t.descendant = e.parent) select taxon::bigint taxon, descendant::bigint descendant from t")
def taxa_closure(spark, d):
    a = table(spark, d, "nation").select(F.col("n_regionkey").cast("long").alias("parent"), (100 + F.col("n_nationkey")).cast("long").alias("child"))
    b = table(spark, d, "supplier").select((100 + F.col("s_nationkey")).cast("long").alias("parent"), (1000 + F.col("s_suppkey")).cast("long").alias("child"))
    return concepts.closure(spark, a.unionByName(b))


CLASSES = ["reefbed", "finfish", "swimmer", "litter", "crawler"]
COMPLETE_SQL = f"""with cm as (select concept, unified_class cls from fathomnet_concept_map where coalesce(unified_class, '') <> ''), b as (select rec_id, generate_subscripts(boxes, 1) pos, unnest(boxes) b from progress),
r as (select rec_id, count(distinct case when cls in {tuple(CLASSES)} then (cls, b.x, b.y, b.w, b.h) end) resolved, count(*) filter (where cls is null or cls not in {tuple(CLASSES)}) unresolved from b left join cm on cm.concept = b.concept group by 1)
select rec_id, coalesce(resolved, 0) resolved, coalesce(unresolved, 0) unresolved from progress left join r using (rec_id) where coalesce(resolved, 0) + coalesce(unresolved, 0) = 0 or resolved / (resolved + unresolved) >= 0.7"""


def _compiled(spark: SparkSession, d: str) -> DataFrame:
    known = spark.createDataFrame(list(enumerate(CLASSES)), "cid int, name string")
    return concepts.compiled(table(spark, d, "progress"), table(spark, d, "fathomnet_concept_map"), known, 0.7)


@query(COMPLETE_SQL)
def completeness(spark, d):
    return _compiled(spark, d).select("rec_id", F.size("resolved").cast("bigint").alias("resolved"), "unresolved")


@query(f"select row_number() over (order by rec_id) id, p.file_name, resolved annotations from ({COMPLETE_SQL}) join progress p using (rec_id)")
def coco_compile(spark, d):
    known = spark.createDataFrame(list(enumerate(CLASSES)), "cid int, name string")
    images, notes = concepts.coco_tables(_compiled(spark, d), known)
    per = notes.groupBy(F.col("image_id").alias("id")).agg(F.count("*").alias("annotations"))
    return images.join(per, "id", "left").select("id", "file_name", F.coalesce("annotations", F.lit(0)).alias("annotations"))


# ---------------------------------------------------------------- audit


@query("select n_bytes size, md5(body) md5, count(*) files, count(*) - 1 redundant from label_files where n_bytes > 0 and body is not null group by all having count(*) > 1")
def exact_dups(spark, d):
    return audit.exact_duplicates(table(spark, d, "label_files").where("body is not null"), "n_bytes", "body")


@query("select regexp_extract(file_path, '[^/]*$') name, count(*) files from label_files group by 1 having count(*) > 1")
def name_collisions(spark, d):
    return audit.name_collisions(table(spark, d, "label_files"), "file_path")


@query(r"select folder, ext, files, rank from (select *, row_number() over (partition by folder order by files desc, ext)::int rank from (select split_part(file_path, '/', 1) folder, lower(regexp_extract(file_path, '(\.[^./]+)$', 1)) ext, count(*) files from label_files group by all)) where rank <= 5")
def extension_counts(spark, d):
    files = table(spark, d, "label_files").select(F.split("file_path", "/")[0].alias("folder"), F.col("file_path").alias("path"))
    return audit.extension_counts(files)


@query(r"select regexp_extract(image_path, '^(.*)/[^/]*$', 1) folder, count(*) images from samples where regexp_matches(lower(image_path), '\.(jpe?g|png|bmp|tiff?|webp)$') group by 1 order by 2 desc, 1 limit 40")
def tree_summary(spark, d):
    return audit.tree_summary(table(spark, d, "samples").select(F.col("image_path").alias("path")))[0]


# ---------------------------------------------------------------- sources, domains, taxonomies


@query("select source, n, round(n / sum(n) over (), 6) share, n / sum(n) over () > 0.25 too_large from (select source, count(*) n from documents group by 1)")
def source_share(spark, d):
    return corpus.source_shares(table(spark, d, "documents"), "source")


@query(f"select cid, source, images, round(100 * images / sum(images) over (partition by cid), 6) pct from (select {SKEW} cid, o_orderpriority source, count(distinct o_orderkey) images from lineitem join orders on o_orderkey = l_orderkey group by all)")
def source_by_class(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("image"), skewed_class().alias("cid"))
    prio = table(spark, d, "orders").select(F.col("o_orderkey").alias("image"), F.col("o_orderpriority").alias("origin"))
    return corpus.source_by_class(lines.join(prio, "image"), "origin")


DOMAINS = {"kelpline": "submerged", "murkbay": "submerged", "quaycam": "surface", "abyssnet": "submerged", "reefsnap": "submerged", "siltset": "submerged", "harbortrash": "surface"}
DOMAIN_SQL = "select * from (values " + ",".join(f"('{a}','{b}')" for a, b in DOMAINS.items()) + ") t(dataset, domain)"
MANIFEST_SPLIT = "case when lower(regexp_replace(split, '^\\s+|\\s+$', '', 'g')) in ('valid','validation') then 'val' when lower(regexp_replace(split, '^\\s+|\\s+$', '', 'g')) in ('train','val','test') then lower(regexp_replace(split, '^\\s+|\\s+$', '', 'g')) end"


def _domains(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DOMAINS.items()), "dataset string, domain string")


@query(f"select domain, {MANIFEST_SPLIT} split, count(*) images from manifest join ({DOMAIN_SQL}) using (dataset) group by all")
def domain_counts(spark, d):
    return corpus.domain_counts(table(spark, d, "manifest").withColumn("split", split_name(F.col("split"))), _domains(spark))


@query(f"select distinct dataset from manifest where dataset not in (select dataset from ({DOMAIN_SQL}))")
def missing_domain(spark, d):
    return corpus.without_domain(table(spark, d, "manifest"), _domains(spark))


@query("select n_nationkey cid, n_name corpus_name, case when n_nationkey % 7 <> 0 then case when n_nationkey % 5 = 0 then lower(n_name) else n_name end end model_name from nation where n_nationkey % 7 = 0 or n_nationkey % 5 = 0")
def taxonomy_guard(spark, d):
    a = table(spark, d, "nation").select(F.col("n_nationkey").alias("cid"), F.col("n_name").alias("name"))
    b = a.where("cid % 7 <> 0").withColumn("name", F.when(F.col("cid") % 5 == 0, F.lower("name")).otherwise(F.col("name")))
    return corpus.taxonomy_differences(a, b)


@query("with u as (select dataset, image_path path, 0 part from samples union all select dataset, source_path, 1 from manifest) select dataset, part, count(*) n, count(distinct path) paths from u group by all")
def union_sources(spark, d):
    parts = [table(spark, d, t).select("dataset", F.col(c).alias("path"), F.col(c).alias("seq")) for t, c in (("samples", "image_path"), ("manifest", "source_path"))]
    return readers.union(parts).groupBy("dataset", "part").agg(F.count("*").alias("n"), F.countDistinct("path").alias("paths"))


@query("select distinct dataset, image_path from samples except select dataset, source_path from manifest")
def not_listed(spark, d):
    return lookup.difference(table(spark, d, "samples").select("dataset", "image_path"), table(spark, d, "manifest").select("dataset", F.col("source_path").alias("image_path")))


@query("select distinct p.concept, m.concept is not null known from progress p left join fathomnet_concept_map m on m.concept = p.concept where p.concept is not null")
def concept_flags(spark, d):
    return lookup.flagged(table(spark, d, "progress").where("concept is not null").select("concept").distinct(), table(spark, d, "fathomnet_concept_map"), "concept")


@query("select out_name, n_boxes from manifest m where not exists (select 1 from label_files l where l.out_name = m.out_name) and n_boxes is not null")
def not_done(spark, d):
    return lookup.not_in(table(spark, d, "manifest").where("n_boxes is not null").select("out_name", "n_boxes"), table(spark, d, "label_files"), ["out_name"])


@query("select source, count(*) texts, case when b < 1024 then printf('%.1fB', b::double) when b < 1048576 then printf('%.1fKB', b / 1024.0) when b < 1073741824 then printf('%.1fMB', b / 1048576.0) else printf('%.1fGB', b / 1073741824.0) end size from (select source, n_chars, sum(n_chars) over (partition by source) b from documents where source is not null) group by source, b")
def source_sizes(spark, d):
    n = table(spark, d, "documents").where("source is not null").groupBy("source").agg(F.count("*").alias("texts"), F.sum("n_chars").alias("b"))
    return n.select("source", "texts", K.human_bytes(F.col("b")).alias("size"))


@query("select label, case when ap is null then 'n/a (0 instances)' else printf('%.4f', ap) end score from (select label, avg(case when label % 3 > 0 then 0.5 + label / 16.0 end) ap from embeddings group by label)")
def class_scores(spark, d):
    ap = F.avg(F.when(F.col("label") % 3 > 0, 0.5 + F.col("label") / 16.0))
    return table(spark, d, "embeddings").groupBy("label").agg(ap.alias("ap")).select("label", K.class_score(F.col("ap")).alias("score"))


@query(r"select rec_id, coalesce(nullif(regexp_extract('https://x/' || coalesce(dive, '') || '/img/' || file_name, '/([A-Za-z]+/[DTV]?\d{3,5})/', 1), ''), uuid) dive_key from progress")
def dive_keys(spark, d):
    url = F.concat(F.lit("https://x/"), F.coalesce("dive", F.lit("")), F.lit("/img/"), F.col("file_name"))
    return table(spark, d, "progress").select("rec_id", K.dive_of(url, F.col("uuid")).alias("dive_key"))


@query("select file_id, string_split(file_path, '/')[-2] || '_' || string_split(file_path, '/')[-1] flat from label_files")
def flat_names(spark, d):
    return table(spark, d, "label_files").select("file_id", K.flat_name(F.col("file_path")).alias("flat"))


# ---------------------------------------------------------------- pixels (rows only)


# Components of 8 by 8 masks by reachability: a cell's component is named by its first cell.
CELLS_SQL = """with recursive c as (select vec_id v, i, i % 8 x, i // 8 y from (select vec_id, unnest(range(0, 64)) i, unnest(embedding) e from embeddings) where e > 0),
r as (select v, i a, i b from c union select r.v, r.a, n.i from r join c m on m.v = r.v and m.i = r.b join c n on n.v = r.v and abs(n.x - m.x) <= 1 and abs(n.y - m.y) <= 1),
k as (select v, a, min(b) root from r group by all), p as (select c.v, root, min(x) l, max(x) + 1 rt, min(y) t, max(y) + 1 bt, count(*) n from c join k on k.v = c.v and k.a = c.i group by all)"""


@query(f"{CELLS_SQL} select v vec_id, 'thing' label, (l + rt) / 16.0::double cx, (t + bt) / 16.0::double cy, (rt - l) / 8.0::double w, (bt - t) / 8.0::double h from p where n / 64 between 0.05 and 0.6")
def mask_components(spark, d):
    """Embeddings as 8 by 8 masks (positive or not): boxes of their components."""

    def run(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            rows = [(v, *b) for v, e in zip(batch["vec_id"], batch["embedding"]) for b in pixels.mask_boxes((np.asarray(e) > 0).reshape(8, 8), "thing", 0.05, 0.6)]
            yield pd.DataFrame(rows, columns=["vec_id", "label", "cx", "cy", "w", "h"])

    return table(spark, d, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, label string, cx double, cy double, w double, h double")


def _codes(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as 8 by 8 grey codes 0 to 4."""
    code = F.transform("embedding", lambda x: F.least(F.floor(F.abs(x) * 20), F.lit(4)))
    data = F.unhex(F.array_join(F.transform(code, lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return table(spark, d, "embeddings").select(F.concat(F.col("vec_id").cast("string"), F.lit("m.png")).alias("path"), F.lit(8).alias("height"), F.lit(8).alias("width"), data.alias("data"))


@query("select vec_id::varchar image_path, true negative from embeddings where len(list_filter(embedding, lambda x: least(floor(abs(x::double) * 20), 4) = 0)) / 64 <= 0.35")
def negative_mine(spark, d):
    return readers.negative_samples(_codes(spark, d), "codes", [0], 0.35).select("image_path", "negative")


@query(f"{CELLS_SQL} select e.vec_id || '.png' image_path, count(n)::int boxes from embeddings e left join (select * from p where n / 64 between 0.05 and 0.6) q on q.v = e.vec_id group by 1")
def palette_masks(spark, d):
    rgb = F.transform(F.sequence(F.lit(0), F.lit(191)), lambda i: F.when(F.get("embedding", F.floor(i / 3).cast("int")) > 0, 255).otherwise(0))
    data = F.unhex(F.array_join(F.transform(rgb, lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    images = table(spark, d, "embeddings").select(F.concat(F.col("vec_id").cast("string"), F.lit(".png")).alias("path"), F.lit(8).alias("height"), F.lit(8).alias("width"), data.alias("data"))
    return readers.mask_samples(images, "masks", {"255,255,255": "bright"}, 0.05, 0.6).select("image_path", F.size("boxes").alias("boxes"))


# Eight pixels a row become nine means, each of two neighbours; of 64 pixels the white balance cuts none at either end.
LUT_SQL = """with g as (select vec_id, list_transform(embedding, lambda x: floor((least(greatest(x, -1::float), 1::float) + 1::float) * 127::float)::int) v from embeddings),
s as (select vec_id, v, list_transform(range(0, 72), lambda i: round_even(((i % 9) * coalesce(v[(i // 9) * 8 + i % 9], 0) * (case when i % 9 = 0 then 0 else 1 end) + (8 - i % 9) * (case when i % 9 = 8 then 0 else v[(i // 9) * 8 + i % 9 + 1] end)) / 8.0, 0)) m from g),
h as (select vec_id, v, list_reduce(list_prepend(0::hugeint, list_transform(range(0, 64), lambda i: (case when m[(i // 8) * 9 + i % 8 + 1] < m[(i // 8) * 9 + i % 8 + 2] then 1 else 0 end)::hugeint)), lambda acc, x: acc * 2 + x) hash from s)
select vec_id, (case when hash >= 9223372036854775808 then hash - 18446744073709551616 else hash end)::bigint hash, list_avg(v) level, list_avg(list_transform(v, lambda x: round_even((x - list_min(v)) * (255.0::double / greatest(list_max(v) - list_min(v), 1)), 0))) balanced, list_avg(list_transform(v, lambda x: floor(pow(x / 255.0::double, 1 / 0.7::double) * 255))) brightened from h"""


@query(LUT_SQL)
def lut_ops(spark, d):
    """White balance and gamma over embeddings as small images: mean level before and after."""

    def run(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            rows = []
            for v, e in zip(batch["vec_id"], batch["embedding"]):
                image = np.repeat(((np.clip(np.asarray(e), -1, 1) + 1) * 127).astype(np.uint8).reshape(8, 8, 1), 3, axis=2)
                rows.append((v, pixels.dhash(image[..., 0]), float(image.mean()), float(pixels.white_balance(image).mean()), float(pixels.gamma(image).mean())))
            yield pd.DataFrame(rows, columns=["vec_id", "hash", "level", "balanced", "brightened"])

    return table(spark, d, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, hash long, level double, balanced double, brightened double")


# ---------------------------------------------------------------- streaming and the whole build


@query("with p as (select *, row_number() over (partition by uuid order by rec_id) rn from progress where uuid is not null) select uuid from p where rn = 1")
def progress_stream(spark, d):
    """The log written as JSON lines, read as a stream, each uuid once; the streamed table is read back."""
    folder = scratch_path(spark, "progress-stream")
    table(spark, d, "progress").drop("rec_id", "logged_at").write.json(f"{folder}/in")
    stream.append(stream.first_of_each(stream.stream(spark, f"{folder}/in")).select("uuid"), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema("uuid string").parquet(f"{folder}/out")


@query("select dive, count(*) lines from progress where uuid is not null group by dive")
def progress_recompute(spark, d):
    """The same log, a report over all of it written anew with each batch."""
    folder = scratch_path(spark, "progress-recompute")
    table(spark, d, "progress").drop("rec_id", "logged_at").write.json(f"{folder}/in")
    lines = stream.stream(spark, f"{folder}/in").where("uuid is not null")
    stream.recompute(lines, f"{folder}/log", lambda log: log.groupBy("dive").agg(F.count("*").alias("lines")), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


# Labels meet the reviewed map exactly or without regard to case, or name a class themselves.
STATS_SQL = rf"""with s as (select *, row_number() over (partition by sample_id order by ingested_at nulls first, dataset nulls first, image_path nulls first, group_key nulls first, negative nulls first) nth from samples where sample_id is not null),
b as (select distinct box_id, sample_id, label from boxes where {VALID}),
m as (select lower(concept) k from fathomnet_concept_map where coalesce(unified_class, '') <> '' union select unified_class from fathomnet_concept_map where coalesce(unified_class, '') <> ''),
x as (select sample_id, count(*) boxes, count(k) kept from b left join m on k = lower(regexp_replace(label, '^{_SPACE}+|{_SPACE}+$', '', 'g')) group by 1),
y as (select dataset, case when kept > 0 then 'kept' when boxes > 0 then 'dropped_all_labels' when negative then 'negative' else 'no_annotations' end disposition from s left join x using (sample_id) where nth = 1)
select dataset, count(*) images, count(*) filter (where disposition = 'kept') kept, count(*) filter (where disposition = 'negative') negative, count(*) filter (where disposition = 'dropped_all_labels') dropped_all_labels, count(*) filter (where disposition = 'no_annotations') no_annotations from y group by dataset"""


@query(STATS_SQL)
def reader_stats(spark, d):
    return build.dispositions(spark, d)


_STRIP = lambda c: f"regexp_replace({c}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"
_STEM = r"regexp_replace(regexp_extract(image_path, '[^/]*$'), '(.)\.[^.]*$', '\1')"
_GROUP = f"regexp_replace(lower({_STRIP(f'case when coalesce({_STRIP("group_key")}, {chr(39) * 2}) = {chr(39) * 2} then {_STEM} else group_key end')}), '{_SPACE[:-1]}_\\-]+', '-', 'g')"
_WISH = lambda what: "case dataset " + " ".join(f"when '{k}' then {v[what]}" for k, v in build.REGISTRY.items() if what in v) + " end"
# The build stage by stage: first arrivals, boxes by class, stride, near-duplicates in a loop over each group, cap in turns of groups, crop, clamp.
BUILD_SQL = rf"""with s0 as (select *, row_number() over (partition by sample_id order by ingested_at nulls first, dataset nulls first, image_path nulls first, group_key nulls first, negative nulls first, width nulls first, height nulls first, dhash nulls first) nth from samples where sample_id is not null),
s as (select sample_id, dataset, image_path, regexp_extract(image_path, '[^/]*$') nm, {_GROUP} grp, negative, width, height, dhash from s0 where nth = 1),
cl as (select unified_class nm, row_number() over (order by unified_class) - 1 cid from (select distinct unified_class from fathomnet_concept_map where coalesce(unified_class, '') <> '')),
lk as (select lower(concept) k, unified_class c, 0 o, concept x from fathomnet_concept_map where coalesce(unified_class, '') <> '' union all select nm, nm, 1, nm from cl),
kk as (select k, first(c order by o, x) c from lk group by k),
b as (select distinct box_id, sample_id, label, cx, cy, w, h from boxes where {VALID}),
bx as (select b.*, cid from b join kk on k = lower({_STRIP('label')}) join cl on cl.nm = kk.c),
cnt as (select sample_id, count(*) kept from bx group by 1), anyb as (select sample_id, count(*) n from b group by 1),
m as (select s.*, coalesce(kept, 0) kept, case when kept > 0 then 'kept' when n > 0 then 'dropped_all_labels' when negative then 'negative' else 'no_annotations' end disposition from s left join cnt using (sample_id) left join anyb using (sample_id)),
u as (select *, row_number() over (partition by dataset, grp order by nm, sample_id) rn from m where disposition in ('kept', 'negative')),
st as (select * from u where (rn - 1) % greatest(coalesce({_WISH('stride')}, 1), 1) = 0),
nd as (select dataset, grp, list({{'s': sample_id, 'h': dhash}} order by nm, sample_id) l, any_value({_WISH('near')}) lim from st where {_WISH('near')} > 0 and dhash is not null group by all),
kp as (select unnest(list_reduce(list_prepend([l[1]], list_transform(l[2:], lambda x: [x])), lambda acc, x: case when len(list_filter(acc, lambda a: bit_count(xor(a.h, x[1].h)) <= lim)) > 0 then acc else list_concat(acc, x) end)).s sample_id from nd union all select sample_id from st where coalesce({_WISH('near')}, 0) <= 0),
th as (select st.* from st join kp using (sample_id)), lb as (select dataset, sample_id, cid, count(*) k from bx join th using (sample_id) group by all),
fr as (select dataset, cid, sum(k) n from lb group by all), wt as (select dataset, cid, sum(n) over (partition by dataset) / n w from fr),
ra as (select dataset, sample_id, round(list_reduce(list_prepend(0.0::double, list((k * w)::double order by cid)), lambda acc, x: acc + x), 9) rarity from lb join wt using (dataset, cid) group by all),
ca as (select th.*, row_number() over (partition by th.dataset, grp order by coalesce(rarity, 0) desc, nm, sample_id) g_rn, min(sample_id) over (partition by th.dataset, grp) head from th left join ra using (sample_id)),
cp as (select *, row_number() over (partition by dataset order by g_rn, head, grp) turn from ca),
fi as (select * from cp where turn <= coalesce(nullif({_WISH('cap')}, 0), 2147483647)),
ge as (select fi.sample_id, bx.cx, bx.cy, bx.w, bx.h, width, height, coalesce(width > 0 and height > 0, false) known, case when width / height > 640 / 480 then round_even(height * (640 / 480), 0)::bigint else width end cw, case when width / height > 640 / 480 then height else round_even(width / (640 / 480), 0)::bigint end ch from fi join bx using (sample_id)),
p as (select *, (cx - w / 2) * width - floor((width - cw) / 2) x1, (cx + w / 2) * width - floor((width - cw) / 2) x2, (cy - h / 2) * height - floor((height - ch) / 2) y1, (cy + h / 2) * height - floor((height - ch) / 2) y2 from ge),
q as (select *, greatest(x1, 0.0) a1, greatest(y1, 0.0) b1, least(x2, cw::double) a2, least(y2, ch::double) b2 from p),
v as (select sample_id, case when known then (a1 + a2) / 2 / cw else cx end cx, case when known then (b1 + b2) / 2 / ch else cy end cy, case when known then (a2 - a1) / cw else w end w, case when known then (b2 - b1) / ch else h end h from q where not known or (a2 > a1 and b2 > b1 and (a2 - a1) * (b2 - b1) / greatest((x2 - x1) * (y2 - y1), 1e-9) >= 0.3)),
n as (select sample_id, count(*) n_labels from v where least(cx + w / 2, 1.0) - greatest(cx - w / 2, 0.0) >= 1e-3 and least(cy + h / 2, 1.0) - greatest(cy - h / 2, 0.0) >= 1e-3 group by 1),
o as (select *, {BUCKET.format("'42:' || dataset || ':' || grp")} b from fi left join n using (sample_id) where kept = 0 or n_labels > 0)
select dataset, image_path, grp "group", {SPLIT} split, dataset || '_' || substr(sha1(image_path), 1, 10) out_name, coalesce(n_labels, 0)::int n_labels, disposition from o"""


@query(BUILD_SQL)
def corpus_build(spark, d):
    return build.corpus(spark, d).select("dataset", "image_path", "group", "split", "out_name", F.size("labels").alias("n_labels"), "disposition")


@query(f"with a as ({STATS_SQL}), z as (select dataset, count(*) built from ({BUILD_SQL}) group by 1) select a.*, coalesce(built, 0) built from a left join z using (dataset)")
def corpus_funnel(spark, d):
    return build.funnel(spark, d)


# ---------------------------------------------------------------- files on disk: 25 small images and what is said of them


def _write_files(df: DataFrame) -> None:
    """Rows (place, content: bytes) as files, written by tasks."""

    def run(batches):
        from pathlib import Path

        import pandas as pd

        for batch in batches:
            for place, content in zip(batch["place"], batch["content"]):
                Path(place).parent.mkdir(parents=True, exist_ok=True)
                Path(place).write_bytes(content)
            yield pd.DataFrame({"n": [len(batch)]})

    df.select("place", "content").mapInPandas(run, "n long").agg(F.sum("n")).collect()


def _picture_files(spark: SparkSession, d: str, folder: str, kind: str) -> None:
    """A PNG of 16 by 8 pixels for each nation: a picture (none where the key divides by 5), a colour mask, or codes."""

    def run(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            rows = []
            for key, region in zip(batch["n_nationkey"], batch["n_regionkey"]):
                grey = np.full((8, 16), 1, dtype=np.uint8)
                grey.ravel()[: key % 4] = 0
                mask = np.zeros((8, 16, 3), dtype=np.uint8)
                mask[2:6, 1 : 3 + region] = (200, 30, 20)
                if kind != "picture" or key % 5:
                    image = grey if kind == "codes" else mask if kind == "mask" else np.repeat((grey * 100 + np.arange(16, dtype=np.uint8))[..., None], 3, axis=2)
                    rows.append((f"{folder}/n{key}{'m' if kind == 'codes' else ''}.png", images.encode_png(image)))
            yield pd.DataFrame(rows, columns=["place", "content"])

    _write_files(table(spark, d, "nation").select("n_nationkey", "n_regionkey").mapInPandas(run, "place string, content binary"))


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


_SUPPLIED = "select 'n' || n_nationkey || '.png' name, count(s_suppkey) boxes from nation left join supplier on s_nationkey = n_nationkey where n_nationkey % 5 <> 0 group by 1"


@query(_SUPPLIED)
def coco_on_disk(spark, d):
    """A COCO document whose names have another ending than the files, some without a file."""
    folder = _local(scratch_path(spark, "coco"))
    _picture_files(spark, d, f"{folder}/images", "picture")
    nations = table(spark, d, "nation").select(F.struct(F.col("n_nationkey").cast("bigint").alias("id"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit(".jpg")).alias("file_name"), F.lit(100.0).alias("width"), F.lit(100.0).alias("height")).alias("im")).agg(F.collect_list("im").alias("images"))  # 25 rows
    notes = table(spark, d, "supplier").select(F.struct(F.col("s_nationkey").cast("bigint").alias("image_id"), F.lit(1).alias("category_id"), F.array(F.lit(10.0), F.lit(10.0), F.lit(20.0), F.lit(20.0)).alias("bbox")).alias("an"))
    lines = [nations.select(F.to_json("images").alias("t")), notes.agg(F.to_json(F.collect_list("an")).alias("t"))]
    doc = '{"images": ' + lines[0].first().t + ', "annotations": ' + lines[1].first().t + ', "categories": [{"id": 1, "name": "thing"}]}'
    tables.write_atomically(f"{folder}/doc.json", doc)
    return readers.read("coco", spark, f"{folder}/doc.json", f"{folder}/images", "nations").select(file_name(F.col("image_path")).alias("name"), F.size("boxes").cast("bigint").alias("boxes"))


@query(_SUPPLIED)
def voc_on_disk(spark, d):
    """VOC files: odd ones name no file that there is, so their own stem finds the image; one is broken."""
    folder = _local(scratch_path(spark, "voc"))
    _picture_files(spark, d, f"{folder}/images", "picture")
    per = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_join(F.collect_list(F.lit("<object><name>thing</name><bndbox><xmin>10</xmin><ymin>10</ymin><xmax>30</xmax><ymax>60</ymax></bndbox></object>")), "").alias("objects"))
    key = F.col("n_nationkey").cast("string")
    named = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("n"), key, F.lit(".jpg"))).otherwise(F.concat(F.lit("scan"), key))
    xml = F.concat(F.lit("<annotation><filename>"), named, F.lit("</filename><size><width>100</width><height>100</height></size>"), F.coalesce("objects", F.lit("")), F.lit("</annotation>"))
    files = table(spark, d, "nation").join(per, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(F.concat(F.lit(f"{folder}/notes/n"), key, F.lit(".xml")).alias("place"), F.encode(xml, "UTF-8").alias("content"))
    _write_files(files.unionByName(spark.createDataFrame([(f"{folder}/notes/broken.xml", bytearray(b"<annotation><filename>n1.png</filename><size>"))], "place string, content binary")))
    return readers.read("voc", spark, f"{folder}/notes", f"{folder}/images", "nations").select(file_name(F.col("image_path")).alias("name"), F.size("boxes").cast("bigint").alias("boxes"))


@query("select 'n' || n_nationkey || '.png' name, 'red' label, (4 + n_regionkey) / 32.0::double cx, 0.5::double cy, (2 + n_regionkey) / 16.0::double w, 0.5::double h from nation where n_nationkey % 5 <> 0")
def masks_on_disk(spark, d):
    folder = _local(scratch_path(spark, "masks"))
    _picture_files(spark, d, f"{folder}/images", "picture")
    _picture_files(spark, d, f"{folder}/masks", "mask")
    found = readers.read("mask_rgb", spark, f"{folder}/masks", f"{folder}/images", "nations", palette={"255,0,0": "red", "0,0,255": "blue"})
    return found.select(file_name(F.col("image_path")).alias("name"), F.explode("boxes").alias("b")).select("name", "b.*")


@query("select 'n' || n_nationkey || '.png' name, true negative from nation where n_nationkey % 5 <> 0 and n_nationkey % 4 <= 1")
def negatives_on_disk(spark, d):
    """Codes with none to three of 128 pixels of obstacles; at most one in a hundred is allowed."""
    folder = _local(scratch_path(spark, "codes"))
    _picture_files(spark, d, f"{folder}/images", "picture")
    _picture_files(spark, d, f"{folder}/codes", "codes")
    return readers.read("mask_negative", spark, f"{folder}/codes", f"{folder}/images", "nations", obstacles=[0]).select(file_name(F.col("image_path")).alias("name"), "negative")


@query("select count(*) filter (where n_nationkey % 5 <> 0 and n_regionkey % 2 = 0) copied, count(*) filter (where n_nationkey % 5 <> 0 and n_regionkey % 2 = 1) changed, count(*) filter (where n_nationkey % 5 = 0) failed from nation")
def enhanced_copies(spark, d):
    """Images of one domain enhanced, those of the other copied as they are, missing ones counted."""
    folder = _local(scratch_path(spark, "enhanced"))
    _picture_files(spark, d, f"{folder}/in", "picture")
    name = F.concat(F.lit("/n"), F.col("n_nationkey").cast("string"), F.lit(".png"))
    jobs = table(spark, d, "nation").select(F.concat(F.lit(f"{folder}/in"), name).alias("source"), F.concat(F.lit(f"{folder}/out"), name).alias("target"), (F.col("n_regionkey") % 2 == 1).alias("changed"))
    return tables.copy_images(jobs, tables.enhanced)


@query("select n_nationkey, case when n_nationkey % 2 = 0 then -1 else 0 end::bigint hash from nation")
def picture_hashes(spark, d):
    """Difference hashes of picture files that grow brighter, or darker, from left to right."""
    folder = _local(scratch_path(spark, "hashes"))

    def paint(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            ramp = lambda key: np.repeat(np.arange(40, 40 + 18 * 6, 6, dtype=np.uint8)[None, :: 1 if key % 2 == 0 else -1], 16, axis=0)
            yield pd.DataFrame({"place": [f"{folder}/{key}.png" for key in batch["n_nationkey"]], "content": [images.encode_png(ramp(key)) for key in batch["n_nationkey"]]})

    def read(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            grey = [np.frombuffer(x, dtype=np.uint8).reshape(h, w) for x, h, w in zip(batch["data"], batch["height"], batch["width"])]
            yield pd.DataFrame({"path": batch["path"], "hash": [pixels.dhash(g) for g in grey]})

    _write_files(table(spark, d, "nation").select("n_nationkey").mapInPandas(paint, "place string, content binary"))
    found = readers.decoded(spark, folder, False).mapInPandas(read, "path string, hash long")
    return found.select(file_stem(F.col("path")).cast("int").alias("n_nationkey"), "hash")


@query("select out_name, split, dataset, group_key \"group\", n_boxes, source_path from manifest where out_name is not null")
def manifest_round_trip(spark, d):
    """The manifest written as CSV, in order, and read again."""
    folder = scratch_path(spark, "manifest")
    rows = table(spark, d, "manifest").where("out_name is not null").select("out_name", "split", "dataset", F.col("group_key").alias("group"), "n_boxes", "source_path")
    tables.write_csv(rows, f"{folder}/manifest", ["out_name", "source_path"])
    return tables.read_manifest(spark, f"{folder}/manifest", many_lines=True)


@query("select case when n_regionkey < 3 then 'train' when n_regionkey = 3 then 'val' else 'test' end split, 'n' || n_nationkey image, case when s_suppkey is not null then n_regionkey end cid, count(*) lines from nation left join supplier on s_nationkey = n_nationkey group by all")
def corpus_round_trip(spark, d):
    """A corpus of 25 images written as label files and scanned again; images without boxes keep an empty file."""
    folder = _local(scratch_path(spark, "corpus"))
    per = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.count("*").cast("int").alias("k"))
    one = F.struct(F.col("n_regionkey").alias("cid"), F.lit(0.5).alias("cx"), F.lit(0.5).alias("cy"), F.lit(0.25).alias("w"), F.lit(0.25).alias("h"))
    split = F.when(F.col("n_regionkey") < 3, "train").when(F.col("n_regionkey") == 3, "val").otherwise("test")
    rows = table(spark, d, "nation").join(per, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(split.alias("split"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("out_name"), F.when(F.col("k") > 0, F.array_repeat(one, F.col("k"))).otherwise(F.array().cast("array<struct<cid:int,cx:double,cy:double,w:double,h:double>>")).alias("labels"))
    tables.write_label_files(rows, folder)
    return readers.yolo_corpus(spark, folder).groupBy("split", "image", "cid").agg(F.count("*").alias("lines"))


@query(f"select domain, './images/test/' || out_name || '.jpg' line from manifest join ({DOMAIN_SQL}) using (dataset) where {MANIFEST_SPLIT} = 'test'")
def domain_lists(spark, d):
    """Test images as one list a domain, written as text in order and read again; domains without any have no list."""
    folder = scratch_path(spark, "lists")
    rows = table(spark, d, "manifest").where(split_name(F.col("split")) == "test").join(small(_domains(spark)), "dataset").select("domain", F.concat(F.lit("./images/test/"), F.col("out_name"), F.lit(".jpg")).alias("line"))
    tables.write_lines(rows, "line", ["domain", "line"], f"{folder}/lists", "domain")
    return spark.read.schema("value string, domain string").text(f"{folder}/lists").select("domain", F.col("value").alias("line"))


@query("select file_path path, '.txt' ext, (row_number() over (order by file_path))::int rank from (select distinct file_path from label_files where lower(file_path) like '%.txt') qualify rank <= 6 union all select * from (select distinct source_path path, '.json' ext, 0 rank from manifest where source_path like '%.json')")
def tree_notes(spark, d):
    """The first annotation files of each ending."""
    files = table(spark, d, "label_files").select(F.col("file_path").alias("path")).unionByName(table(spark, d, "manifest").select(F.col("source_path").alias("path"))).distinct()
    return audit.tree_summary(files)[1].select("path", "ext", "rank")


@query(f"select dataset name, case when domain = 'surface' then 'complete' when dataset = 'murkbay' then 'failed' else 'pending' end status from ({DOMAIN_SQL})")
def source_states(spark, d):
    """States of sources, kept in a file that is read anew, beside the whole registry."""
    path = _local(scratch_path(spark, "state")) + "/state.json"
    states = tables.StateTable(path)
    states.set("murkbay", "downloading")
    states.set("murkbay", "failed", error="no answer")
    for name, domain in DOMAINS.items():
        if domain == "surface":
            states.set(name, "complete")
    return tables.StateTable(path).listing(spark, _domains(spark).select(F.col("dataset").alias("name"))).select("name", "status")


@query("select concept, boxes, unified_class, method, via from fathomnet_concept_map where trim(coalesce(unified_class, '')) <> ''")
def concept_map_round_trip(spark, d):
    """The reviewed concept map written as CSV and read again; rows with a blank class stay out."""
    folder = scratch_path(spark, "map")
    tables.write_csv(table(spark, d, "fathomnet_concept_map").select("concept", "boxes", "unified_class", "method", "via"), f"{folder}/map", ["concept"])
    return tables.read_concept_map(spark, f"{folder}/map")


@query("select 'n' || n_nationkey || '.txt' name, length(n_name) bytes from nation")
def archive_files(spark, d):
    """An archive with litter and one top folder, found by part of its name, unpacked and listed; nothing leaves the folder."""
    import zipfile

    folder = _local(scratch_path(spark, "archive"))
    with zipfile.ZipFile(f"{folder}/nations_v2.zip", "w") as z:
        for r in table(spark, d, "nation").select("n_nationkey", "n_name").collect():  # 25 rows
            z.writestr(f"top/texts/n{r.n_nationkey}.txt", r.n_name)
        z.writestr("top/__MACOSX/n1.txt", "x")
        z.writestr("top/texts/.DS_Store", "x")
    archives.extract(archives.find_archive("nations.zip", [f"{folder}/nowhere", folder]), f"{folder}/out")
    texts = listing.resolve_path(f"{folder}/out", "TEXTS", folder=True)
    return listing.listed(spark, texts).select(file_name(F.col("path")).alias("name"), F.col("length").alias("bytes"))


@query(f"select p.file_name image_path, resolved boxes from ({COMPLETE_SQL}) join progress p using (rec_id)")
def coco_round_trip(spark, d):
    """The compiled log written as COCO tables and read again: every image with its boxes."""
    folder = scratch_path(spark, "coco-tables")
    known = spark.createDataFrame(list(enumerate(CLASSES)), "cid int, name string")
    sized = _compiled(spark, d).withColumns({"width": F.lit(1e7), "height": F.lit(1e7), "resolved": F.transform("resolved", lambda b: F.struct(b["cls"].alias("cls"), F.lit(1e5).alias("x"), F.lit(1e5).alias("y"), F.lit(1e6).alias("w"), F.lit(1e6).alias("h")))})
    tables.coco_json(*concepts.coco_tables(sized, known), known, folder)
    return readers.read("coco", spark, folder, None, "log", tables=True).select("image_path", F.size("boxes").cast("bigint").alias("boxes"))


@query("select p.* from (select rec_id, file_name from progress) p semi join (select file_name from progress where coalesce(len(boxes), 0) > 0) f using (file_name)")
def compiled_files(spark, d):
    """Lines whose file is there (files here: those some line has boxes for)."""
    files = table(spark, d, "progress").where("size(boxes) > 0").select("file_name")
    return concepts.with_files(table(spark, d, "progress").select("rec_id", "file_name"), files).select("rec_id", "file_name")


@query("select sample_id video, count(*) boxes from boxes where 1 + box_id % 6 in (2, 5) group by 1")
def qualifying_videos(spark, d):
    rows = table(spark, d, "boxes").select(F.col("sample_id").alias("video"), (1 + F.col("box_id") % 6).cast("int").alias("cls"))
    return readers.qualifying_videos(rows, [2, 5])


@query("select concept, rec_id from (select concept, rec_id, row_number() over (partition by concept order by rec_id) rn from progress where file_name is not null and file_name <> '' and file_name not like '%.png') where rn <= 15")
def concept_index(spark, d):
    results = table(spark, d, "progress").select("concept", "rec_id", F.when(~F.col("file_name").like("%.png"), F.col("file_name")).alias("url"))
    return readers.concept_index(results, 15, ["rec_id"]).select("concept", "rec_id")


@query("with e as (select r_regionkey, r_name taxon, n_name descendant from region left join nation on n_regionkey = r_regionkey where r_regionkey < 4) select taxon, descendant from e where descendant is not null")
def cached_taxa(spark, d):
    """Descendants fetched in two runs; the second asks only for what the first doesn't have."""
    folder = scratch_path(spark, "taxa")
    below = {r.r_name: r.n for r in table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).where("r_regionkey < 4").groupBy("r_name").agg(F.collect_list("n_name").alias("n")).collect()}  # five rows
    wanted = table(spark, d, "region").select(F.col("r_name").alias("concept"), "r_regionkey")
    concepts.cached_closure(spark, f"{folder}/cache", wanted.where("r_regionkey < 2"), below.get)
    return concepts.cached_closure(spark, f"{folder}/cache", wanted, below.get)


@query(f"select dataset, count(distinct sample_id) images from samples where dataset in ({', '.join(repr(k) for k in build.REGISTRY if k != 'quaycam')}) group by 1")
def selected_sources(spark, d):
    registry = {**build.REGISTRY, "quaycam": {**build.REGISTRY["quaycam"], "enabled": False}}
    return build.from_sources(table(spark, d, "samples"), registry).groupBy("dataset").agg(F.countDistinct("sample_id").alias("images"))


_DROPS = rf"""select b.dataset, label, count(*) boxes from boxes b left join (select lower(concept) k from fathomnet_concept_map where coalesce(unified_class, '') <> '' union select unified_class from fathomnet_concept_map where coalesce(unified_class, '') <> '') m on k = lower(regexp_replace(label, '^{_SPACE}+|{_SPACE}+$', '', 'g')) where k is null group by 1, 2 order by 3 desc, 1 nulls first, 2 nulls first limit 30"""


def _top_drops(spark: SparkSession, d: str) -> DataFrame:
    cm = table(spark, d, "fathomnet_concept_map").where("coalesce(unified_class, '') <> ''")
    classes = cm.select(F.col("unified_class").alias("name")).distinct().withColumn("cid", F.lit(0))
    entries = cm.select(F.lit("all").alias("dataset"), F.col("concept").alias("label"), F.col("unified_class").alias("class"), F.lit(0).alias("ord"))
    rows = table(spark, d, "boxes").select(F.col("dataset").alias("origin"), F.lit("all").alias("dataset"), "label")
    return labels.top_drops(labels.map_labels(rows, classes, entries).drop("dataset").withColumnRenamed("origin", "dataset"))


@query(_DROPS)
def top_dropped(spark, d):
    return _top_drops(spark, d)


@query(f"""with im as (select o_orderpriority dataset, image, split, coalesce(n, 0) n from ({ORDER_SPLIT}) join orders on o_orderkey = image left join (select l_orderkey image, count(*) n from lineitem group by 1) using (image)), t as (select count(*) n from im), l as (select case l_returnflag when 'A' then 'A' when 'N' then 'N' when 'R' then 'R' end nm from lineitem)
select 'images' section, 'total' name, n, round(n / greatest(n, 1), 6) share, false flag from t union all select 'images', s, count(image), round(count(image) / greatest(any_value(t.n), 1), 6), false from t, (select unnest(['train', 'val', 'test']) s) x left join im on split = s group by s
union all select 'images', 'negatives', count(*) filter (where im.n = 0), round(count(*) filter (where im.n = 0) / greatest(count(*), 1), 6), false from im
union all select 'boxes', c, count(nm), round(count(nm) / (select count(*) from l where nm is not null), 6), false from (select unnest(['A', 'N', 'R', 'none']) c) y left join l on nm = c group by c
union all select 'source', dataset, count(*), round(count(*) / any_value(t.n), 6), count(*) / any_value(t.n) > 0.25 from im, t group by dataset
union all select 'dropped', coalesce(dataset || ':', '') || coalesce(label, 'None'), boxes, null, false from ({_DROPS})""")
def unify_report(spark, d):
    """The report of a build: images, boxes, sources, dropped labels."""
    n = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("image")).agg(F.count("*").alias("k"))
    prio = table(spark, d, "orders").select(F.col("o_orderkey").alias("image"), F.col("o_orderpriority").alias("dataset"))
    items = order_images(spark, d).join(prio, "image").join(n, "image", "left").select("dataset", "split", F.coalesce("k", F.lit(0)).alias("n_labels"))
    cid = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "R", 2)
    return corpus.unify_report(items, table(spark, d, "lineitem").select(cid.alias("cid")), spark.createDataFrame(FLAGS, "cid int, name string"), _top_drops(spark, d))


@query("with l as (select distinct coalesce(out_name, 'file' || file_id) image, unnest(regexp_extract_all(coalesce(body, ''), '(?m)^\\s*(\\d+)\\s', 1)) c from label_files), m as (select out_name, max(dataset) dataset from manifest where out_name is not null group by 1), n as (select c::int cid, coalesce(dataset, '?') source, count(distinct image) images from l left join m on out_name = image group by all) select cid, source, images, round(100 * images / sum(images) over (partition by cid), 6) pct from n")
def label_sources(spark, d):
    """Images of each class by source; label files the manifest doesn't list count under ``?``."""
    cls = F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit(r"(?m)^\s*(\d+)\s"), F.lit(1))
    rows = table(spark, d, "label_files").select(F.coalesce("out_name", F.concat(F.lit("file"), F.col("file_id").cast("string"))).alias("image"), F.explode(cls).alias("c")).select("image", F.col("c").cast("int").alias("cid"))
    return corpus.source_by_class(corpus.with_source(rows, table(spark, d, "manifest")), "dataset")


@query("select label cid, 'class ' || label name, string_agg(domain || '=' || case when ap is null then 'n/a (0 instances)' else printf('%.4f', ap) end, '  ' order by domain) cells from (select label, case when vec_id % 2 = 0 then 'surface' else 'submerged' end domain, avg(case when label % 3 > 0 then 0.5 + label / 16.0 end) ap from embeddings group by all) group by label")
def domain_scores(spark, d):
    domain = F.when(F.col("vec_id") % 2 == 0, "surface").otherwise("submerged")
    ap = F.avg(F.when(F.col("label") % 3 > 0, 0.5 + F.col("label") / 16.0))
    scores = table(spark, d, "embeddings").groupBy(domain.alias("domain"), F.col("label").alias("cid")).agg(ap.alias("ap")).withColumn("name", F.concat(F.lit("class "), F.col("cid").cast("string")))
    return corpus.domain_scores(scores)


for name in ("p6_found", "p6_classes", "p6_records", "p6_layout"):
    QUERIES[name] = getattr(packing, name)

_FILES = rf"""with f as (select file_id, file_path, body, written_at, case when coalesce(regexp_replace(out_name, '{_SPACE}', '', 'g'), '') = '' then regexp_replace(regexp_extract(file_path, '[^/]*$'), '(.)\.[^.]*$', '\1') else out_name end image,
list_sort(list_filter(list_transform(regexp_split_to_array(coalesce(body, ''), '\r\n|[\n\r\x0B\f\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: regexp_replace(x, '^{_SPACE}+|{_SPACE}+$', '', 'g')), lambda x: x <> '')) lines from label_files)"""
SQL["p6_found"] = _FILES + " select a.file_id lo_file_id, b.file_id hi_file_id from f a join f b on a.image = b.image and a.lines = b.lines and a.file_id < b.file_id"
SQL["p6_classes"] = _FILES + ", g as (select distinct file_id, image, lines from f where file_id is not null and image is not null) select file_id, image, min(file_id) over (partition by image, lines) class_id, count(*) over (partition by image, lines) - 1 links from g"
SQL["p6_records"] = _FILES + " select image, arg_max(file_id, (coalesce(epoch_us(written_at), -9000000000000000000), file_id)) file_id, count(*) files, array_to_string(arg_max(lines, (coalesce(epoch_us(written_at), -9000000000000000000), file_id)), chr(10)) lines from f group by image"
SQL["p6_layout"] = _FILES + " select count(*) files_in, count(distinct file_id) file_ids, count(distinct image) images, sum(length(body))::bigint body_chars from f"
