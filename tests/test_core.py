"""Core operators against plain loops on small fixtures."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkshoal.functions import boxes as B
from sparkshoal.functions import keys as K
from sparkshoal.functions import images, pixels
from sparkshoal.functions.text import file_stem, group_of, is_blank, split_name
from sparkshoal.operators import audit, concepts, corpus, labels, packing, ranking, reduction
from sparkshoal.sources import archives, listing, readers, tables
from sparkshoal.streaming import progress as stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def values(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame([(*d, i) for i, d in enumerate(data)], schema + ", i int").orderBy("i").select(*columns).collect()]


# ---------------------------------------------------------------- text and keys


def test_text_functions(spark):
    data = [("a/b.c/IMG_1.tar.gz",), (".hidden",), ("x",), (None,), ("   ",)]
    assert values(spark, data, "p string", file_stem(F.col("p")), is_blank(F.col("p"))) == [("IMG_1.tar", False), (".hidden", False), ("x", False), (None, True), ("   ", True)]
    groups = [(" Quay  cam-4__72\t", "x/a.png"), ("", "x/Frame_1.png"), (None, "S 1.JPG"), ("QUAY CAM 4 72", "y")]
    assert values(spark, groups, "g string, p string", group_of(F.col("g"), F.col("p"))) == [("quay-cam-4-72",), ("frame-1",), ("s-1",), ("quay-cam-4-72",)]
    assert values(spark, [(" TRAIN",), ("Valid",), ("validation\n",), ("dev",), (None,)], "s string", split_name(F.col("s"))) == [("train",), ("val",), ("val",), (None,), (None,)]


def test_keys(spark):
    import hashlib

    keys = ["a", "42:d:g", "é" * 50, ""]
    want = [(int(hashlib.md5(k.encode()).hexdigest()[:8], 16) % 100, "d_" + hashlib.sha1(k.encode()).hexdigest()[:10]) for k in keys]
    assert values(spark, [(k,) for k in keys], "k string", K.stable_bucket(F.col("k")), K.out_name(F.lit("d"), F.col("k"))) == want
    stems = [("vid_12_f3", "7"), ("other", None), ("vid_9_f1", "")]
    assert values(spark, stems, "s string, f string", K.make_group(F.col("s")), K.make_group(F.col("s"), "regex", r"(vid_\d+)_"), K.make_group(F.col("s"), "field", field=F.col("f"))) == [("vid_12_f3", "vid_12", "7"), ("other", "other", "other"), ("vid_9_f1", "vid_9", "vid_9_f1")]
    assert values(spark, [("1.5",), ("1.0f",), ("1_0",), ("nan",), ("-.5e1",), ("",), (None,)], "t string", K.number(F.col("t"))) == [(1.5,), (None,), (None,), (None,), (-5.0,), (None,), (None,)]
    assert values(spark, [(0,), (1023,), (1536,), (5 << 30,)], "n long", K.human_bytes(F.col("n"))) == [("0.0B",), ("1023.0B",), ("1.5KB",), ("5.0GB",)]
    assert values(spark, [(5, 3), (-1, 0)], "a long, b long", K.hamming(F.col("a"), F.col("b"))) == [(2,), (64,)]


def test_hash_of_gray_in_both_forms(spark):
    r = np.random.default_rng(0)
    grays = [r.integers(0, 255, (8, 9)) for _ in range(5)]
    got = values(spark, [([int(x) for x in g.ravel()],) for g in grays], "g array<int>", K.dhash_of_gray(F.col("g")))
    assert [x for (x,) in got] == [pixels.dhash(g) for g in grays]


# ---------------------------------------------------------------- boxes

BOX = "label string, cx double, cy double, w double, h double, width int, height int"


def one():
    return B.box(F.col("label"), F.col("cx"), F.col("cy"), F.col("w"), F.col("h"))


def cropped(cx, cy, w, h, width, height, ow=640, oh=480, least=0.3):
    if width / height > ow / oh:
        cw, ch = round(height * ow / oh) if False else int(round(height * (ow / oh))), height
    else:
        cw, ch = width, int(round(width / (ow / oh)))
    left, top = (width - cw) // 2, (height - ch) // 2
    x1, y1, x2, y2 = (cx - w / 2) * width - left, (cy - h / 2) * height - top, (cx + w / 2) * width - left, (cy + h / 2) * height - top
    area = max((x2 - x1) * (y2 - y1), 1e-9)
    a1, b1, a2, b2 = max(x1, 0), max(y1, 0), min(x2, cw), min(y2, ch)
    if a2 <= a1 or b2 <= b1 or (a2 - a1) * (b2 - b1) / area < least:
        return None
    return ((a1 + a2) / 2 / cw, (b1 + b2) / 2 / ch, (a2 - a1) / cw, (b2 - b1) / ch)


def test_crop_equals_a_loop(spark):
    r = random.Random(0)
    data = [("x", r.uniform(-0.1, 1.1), r.uniform(-0.1, 1.1), r.uniform(0, 0.9), r.uniform(0, 0.9), *r.choice([(1920, 1080), (640, 480), (480, 640), (721, 333)])) for _ in range(300)]
    got = values(spark, data, BOX, B.fit(F.array(one()), F.col("width"), F.col("height"), 640, 480))
    for d, (bs,) in zip(data, got):
        want = cropped(*d[1:])
        assert (want is None) == (not bs) and (want is None or tuple(bs[0])[1:] == pytest.approx(want, abs=1e-12))


def test_box_rules(spark):
    nan = float("nan")
    data = [("a", 0.5, 0.5, 1e-4, 0.5, 1, 1), ("b", 0.5, 0.5, 1.5, 0.5, 1, 1), ("c", -0.5, 0.5, 0.1, 0.1, 1, 1), ("d", nan, 0.5, 0.1, 0.1, 1, 1), ("e", 0.5, 0.5, nan, 0.1, 1, 1), ("f", None, 0.5, 0.1, 0.1, 1, 1), ("g", 0.0, 0.0, 0.001, 0.1, 1, 1)]
    got = values(spark, data, BOX, F.size(B.valid(F.array(one()))), F.size(B.clamp(B.valid(F.array(one())))), F.size(B.strictly_inside(F.array(one()))))
    assert got == [(0, 0, 1), (1, 1, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0), (1, 0, 1)]
    assert values(spark, [("x", 0.5, 0.5, 0.5, 0.5, 100, 50)], BOX, B.pad(F.array(one()), F.col("width"), F.col("height"), 100, 100))[0][0][0][1:] == (0.5, 0.5, 0.5, 0.25)
    assert values(spark, [("x", 0.5, 0.25, 0.125, 1 / 3, 1, 1)], BOX, B.label_line(F.lit(3), one())) == [("3 0.500000 0.250000 0.125000 0.333333",)]


# ---------------------------------------------------------------- labels


def test_label_mapping_and_dispositions(spark):
    classes, table = labels.taxonomy(spark, {0: "fish", 1: "gear"}, {"d": {"Cod": "fish", "cod ": "gear", "Net": "retired", "net": "gear"}})
    data = [("d", "Cod"), ("d", "COD"), ("d", "Net"), ("d", " nEt\t"), ("d", "GEAR "), ("d", "boot"), ("e", "Cod"), ("d", None), ("d", "Cod")]
    df = spark.createDataFrame([(*x, i, 7) for i, x in enumerate(data)], "dataset string, label string, i int, cid int")
    got = [(r.cid, r.dropped) for r in labels.map_labels(df, classes, table).orderBy("i").collect()]
    assert got == [(0, False), (0, False), (None, False), (None, False), (1, False), (None, True), (None, True), (None, True), (0, False)]
    assert rows(labels.dropped_counts(labels.map_labels(df, classes, table))) == sorted([("d", "boot", 1), ("e", "Cod", 1), ("d", None, 1)], key=repr)
    assert {r.label for r in labels.dead_targets(classes, table).collect()} == {"Net"}
    assert labels.map_labels(df.limit(0), classes, table).count() == 0
    assert values(spark, [(2, 1, False), (2, 0, False), (0, 0, True), (0, 0, False)], "a int, b int, n boolean", labels.disposition(F.col("a"), F.col("b"), F.col("n"))) == [("kept",), ("dropped_all_labels",), ("negative",), ("no_annotations",)]


# ---------------------------------------------------------------- thinning


def test_row_numbers_over_any_number_of_partitions(spark):
    r = random.Random(0)
    data = [("hot" if r.random() < 0.6 else r.choice(["a", "b", None]), r.randrange(1000), i) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, p int, i int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    got = {x.i: x.rn for x in ranking.spread_row_number(df, ["g"], ["p", "i"]).collect()}
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    by = defaultdict(list)
    for g, p, i in data:
        by[g].append((p, i))
    # Rows that come out of a shuffle in any order, and partitions joined at run time, give the same numbers.
    wide = df.withColumn("payload", F.repeat(F.lit("x"), 2000)).repartition(7, F.rand())
    assert {x.i: x.rn for x in ranking.spread_row_number(wide, ["g"], ["p", "i"]).collect()} == got
    assert got == {i: n for q in by.values() for n, (_, i) in enumerate(sorted(q), 1)}


def test_stride(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 0)], "g string, n int")
    assert rows(reduction.stride(df, ["g"], ["n"], 4)) == [("a", 0), ("a", 4), ("a", 8), ("b", 0)]
    assert reduction.stride(df, ["g"], ["n"], 1).count() == 11 and reduction.stride(df.limit(0), ["g"], ["n"], 3).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_near_duplicates_equal_a_loop(spark, seed):
    r = random.Random(seed)
    centres = [r.getrandbits(63) for _ in range(6)]
    data = []
    for i in range(300):
        h = r.choice(centres)
        for _ in range(r.randrange(0, 5)):
            h ^= 1 << r.randrange(63)
        data.append((r.choice(["a", "b", None]), f"n{r.randrange(150):03d}", i, None if r.random() < 0.05 else h, [i], None))
    df = spark.createDataFrame(data, "g string, name string, seq int, h long, payload array<int>, extra int")
    kept = defaultdict(list)
    for g, _, i, h, *_ in sorted((d for d in data if d[3] is not None), key=lambda d: (d[1], d[2])):
        if all(bin(h ^ o).count("1") > 4 for o, _ in kept[g]):
            kept[g].append((h, i))
    got = reduction.near_duplicates(df, ["g"], ["name", "seq"], "h", 4)
    assert sorted(x.seq for x in got.collect()) == sorted(i for v in kept.values() for _, i in v)
    blocks = reduction.near_duplicates(df, ["g"], ["name", "seq"], "h", 4, block=[8, 20, 60][seed])  # groups too large for a task
    assert sorted(x.seq for x in blocks.collect()) == sorted(x.seq for x in got.collect()) and blocks.columns == df.columns
    assert got.columns == df.columns and reduction.near_duplicates(df, ["g"], ["name"], "h", 0).count() == 300
    assert reduction.near_duplicates(df.limit(0), ["g"], ["name"], "h", 4).count() == 0


@pytest.mark.parametrize("limit", [None, 0, 7, 40, 500])
def test_rarity_cap_equals_a_loop(spark, limit):
    r = random.Random(1)
    items = [(i, f"g{r.randrange(6)}", f"n{r.randrange(30):02d}", "s") for i in range(80)]
    tags = [(i, r.choice("aaaaabbc")) for i, *_ in items for _ in range(r.randrange(0, 4))]
    freq = Counter(c for _, c in tags)
    total = sum(freq.values())
    rare = {i: round(sum(n * (total / freq[c]) for c, n in sorted(Counter(c for j, c in tags if j == i).items())), 9) for i, *_ in items}
    groups = defaultdict(list)
    for i, g, n, _ in items:
        groups[g].append((-rare[i], n, i))
    want, queues = [], [sorted(q) for q in groups.values()]
    for turn in itertools.zip_longest(*queues):
        want += [x[2] for x in turn if x is not None]
    want = sorted(want[: limit or None])
    df = spark.createDataFrame(items, "seq int, g string, name string, source string")
    t = spark.createDataFrame(tags, "seq int, cid string")
    got = reduction.capped(df.join(reduction.rarity(t, "seq", "cid", []), "seq", "left"), ["source"], "g", ["name", "seq"], limit)
    assert sorted(x.seq for x in got.collect()) == want


def test_round_robin_equals_a_loop(spark):
    for seed in range(3):
        r = random.Random(seed)
        items = [(i, f"c{i % 4}", r.randrange(40)) for i in range(90)]
        done = {r.randrange(40) for _ in range(5)}
        df = spark.createDataFrame(items, "i int, concept string, key int")
        got = sorted(x.i for x in reduction.round_robin(df, "concept", "concept", ["i"], "key", 20, spark.createDataFrame([(k,) for k in done], "key int")).collect())
        queues = {c: [x for x in items if x[1] == c] for c in ("c0", "c1", "c2", "c3")}
        have, taken = set(done), []
        for n in range(90):
            for q in queues.values():
                if n < len(q) and q[n][2] not in have and len(have) < 20:
                    have.add(q[n][2])
                    taken.append(q[n][0])
        assert got == sorted(taken)


# ---------------------------------------------------------------- corpus


def test_repeat_factors(spark):
    pairs = [(i, "common") for i in range(400)] + [(0, "rare"), (0, "rare"), (1, "mid"), (2, "mid"), (3, "mid")]
    n = 400
    want = {}
    for image in range(n):
        own = {c for i, c in pairs if i == image}
        f = {c: len({i for i, x in pairs if x == c}) / n for c in own}
        want[image] = max(1, round(max(max(1.0, math.sqrt(0.1 / v)) for v in f.values())))
    df = spark.createDataFrame(pairs, "image int, cid string")
    factors = corpus.repeat_factors(df)
    assert {r.image: r.factor for r in factors.collect()} == want
    images = spark.createDataFrame([(0,), (5,), (999,)], "image int")
    assert Counter(r.image for r in corpus.repeated(images, factors).collect()) == {0: want[0], 5: 1, 999: 1}
    assert corpus.repeat_factors(df.limit(0)).count() == 0


def test_reports(spark):
    lab = spark.createDataFrame([("i1", "train", 0), ("i1", "train", 0), ("i2", "val", 0), ("i3", "test", 1)], "image string, split string, cid int")
    classes = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "cid int, name string")
    report = corpus.class_report(lab, classes)
    assert rows(report) == [(0, "a", 3, 2, 75.0, 1.5, 1, 1, 0), (1, "b", 1, 1, 25.0, 1.0, 0, 0, 1), (2, "c", 0, 0, 0.0, 0.0, 0, 0, 0)]
    assert {(r.name, r.problem) for r in corpus.blind_classes(report).collect()} == {("a", "blind"), ("b", "blind"), ("c", "empty")}
    shares = corpus.source_shares(spark.createDataFrame([("x",)] * 3 + [("y",)], "s string"), "s")
    assert rows(shares) == [("x", 3, 0.75, True), ("y", 1, 0.25, False)]
    a = spark.createDataFrame([(0, "x"), (1, "y")], "cid int, name string")
    b = spark.createDataFrame([(0, "x"), (1, "z"), (2, "w")], "cid int, name string")
    assert rows(corpus.taxonomy_differences(a, b)) == [(1, "y", "z"), (2, None, "w")]
    assert corpus.taxonomy_differences(a, a).count() == 0


def test_splits_depend_on_the_group_only(spark):
    df = spark.createDataFrame([("d", f"g{i % 50}") for i in range(500)], "dataset string, group string").withColumn("split", corpus.split_of(42, F.col("dataset"), F.col("group")))
    assert df.groupBy("group").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0


# ---------------------------------------------------------------- concepts


def test_concepts_resolve_as_the_rules_say(spark):
    wanted = [("Anthozoa", "reef"), ("Actiniaria", "invert"), ("Teleostei", "fish"), ("Salmo", "fish"), ("Mollusca", "invert"), ("Cephalopoda", "fish")]
    below = {"Anthozoa": ["Actiniaria", "Metridium"], "Actiniaria": ["Metridium"], "Teleostei": ["Cod", "Salmo", "Salmo salar"], "Salmo": ["Salmo salar"], "Mollusca": ["Squid"], "Cephalopoda": ["Squid"]}
    seen = spark.createDataFrame([("Actiniaria", 5), ("Metridium", 4), ("Cod", 3), ("Salmo salar", 2), ("Squid", 1), ("Rock", 9)], "concept string, boxes long")
    got = {r.concept: (r.unified_class, r.method, r.via) for r in concepts.resolve(seen, spark.createDataFrame(wanted, "concept string, class string"), spark.createDataFrame([(k, v) for k, vs in below.items() for v in vs], "taxon string, descendant string")).collect()}
    assert got == {"Actiniaria": ("invert", "exact", "Actiniaria"), "Metridium": ("invert", "ancestry-specific", "Actiniaria;Anthozoa"), "Cod": ("fish", "ancestry", "Teleostei"), "Salmo salar": ("fish", "ancestry", "Salmo;Teleostei"), "Squid": ("", "CONFLICT", "Cephalopoda;Mollusca"), "Rock": ("", "unresolved", "")}


def test_completeness_and_compiled_ids(spark):
    b = lambda c, x=0.0: (c, x, 0.0, 1.0, 1.0)
    schema = "rec_id long, file_name string, width int, height int, dive string, concept string, cls string, boxes array<struct<concept:string,x:double,y:double,w:double,h:double>>"
    data = [(1, "a", 1, 1, "d", "c", "k", [b("A", float(i)) for i in range(7)] + [b("?", float(i)) for i in range(3)]), (2, "b", 1, 1, "d", "c", "k", [b("A"), b("?")]), (3, "c", 1, 1, "d", "c", "k", []), (4, "d", 1, 1, "d", "c", "k", None), (5, "e", 1, 1, "d", "c", "k", [b("A"), b("A2"), b("A")])]
    cm = spark.createDataFrame([("A", "x"), ("A2", "x"), ("?", "retired"), ("B", "")], "concept string, unified_class string")
    classes = spark.createDataFrame([(0, "x")], "cid int, name string")
    out = concepts.compiled(spark.createDataFrame(data, schema), cm, classes, 0.7)
    assert {r.rec_id: (len(r.resolved), r.unresolved) for r in out.collect()} == {1: (7, 3), 3: (0, 0), 4: (0, 0), 5: (1, 0)}
    images, notes = concepts.coco_tables(out, classes)
    assert rows(images.select("id", "file_name")) == [(1, "a"), (2, "c"), (3, "d"), (4, "e")]
    assert sorted((r.id, r.image_id) for r in notes.collect()) == [(i, 1) for i in range(1, 8)] + [(8, 4)]


# ---------------------------------------------------------------- audit and packing


def test_duplicates_and_collisions(spark):
    df = spark.createDataFrame([("a/x.txt", 3, "abc"), ("b/x.txt", 3, "abc"), ("c/y.txt", 3, "abd"), ("d/z.txt", 4, "abcd"), ("e/u.txt", 0, ""), ("e/v.txt", 0, ""), ("e/w.txt", None, "abc")], "path string, size int, body string")
    assert [(r.size, r.files, r.redundant) for r in audit.exact_duplicates(df, "size", "body").collect()] == [(3, 2, 1)]
    assert rows(audit.name_collisions(df)) == [("x.txt", 2)]


def test_packing_loses_nothing(spark, tmp_path):
    for i in range(60):
        spark.createDataFrame([(i, f"body {i}" if i % 7 else None)], "id long, body string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    done = packing.pack(spark, lambda: spark.read.parquet(f"{tmp_path}/in"), f"{tmp_path}/out", ["id", "body"])
    assert done.rows == 60 and done.files == 1 and len(list((tmp_path / "out").glob("*.parquet"))) == 1
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(spark.read.parquet(f"{tmp_path}/in"))
    unstable = lambda: spark.read.parquet(f"{tmp_path}/in").withColumn("body", F.current_timestamp().cast("string"))
    with pytest.raises(ValueError):
        packing.pack(spark, unstable, f"{tmp_path}/bad", ["id", "body"])
    assert not (tmp_path / "bad").exists() and not (tmp_path / "bad.staging").exists()


def test_tiny_files_on_disk(spark, tmp_path):
    for i in range(30):
        (tmp_path / "f" / f"d{i % 3}").mkdir(parents=True, exist_ok=True)
        (tmp_path / "f" / f"d{i % 3}" / f"{i}.txt").write_text(f"line {i}\n" if i else "")
    done = packing.pack(spark, lambda: packing.read_tiny_files(spark, f"{tmp_path}/f", "*.txt"), f"{tmp_path}/o", ["file_path", "body"])
    assert done.rows == 30 and spark.read.parquet(f"{tmp_path}/o").where("n_bytes = length(body)").count() == 30


def test_copies_of_label_files(spark, monkeypatch):
    schema = "image string, digest string, file_id long, n int"
    data = [("a", "x", i, 0) for i in (5, 1, 3, 3)] + [("a", "y", 9, 0), ("b", "x", 2, 0), (None, "x", 4, 0), (None, "x", 6, 0), ("c", "z", None, 0)]
    df = spark.createDataFrame(data, schema)
    assert rows(packing.copies(df)) == [(1, 3), (1, 5), (3, 5)]
    monkeypatch.setattr(packing, "PAIRED", 2)
    assert rows(packing.copies(df)) == [(1, 3), (1, 5)]
    assert packing.copies(df.limit(0)).count() == 0
    assert rows(packing.copy_classes(df)) == [(1, "a", 1, 2), (2, "b", 2, 0), (3, "a", 1, 2), (5, "a", 1, 2), (9, "a", 9, 0)]
    assert packing.copy_classes(df.limit(0)).count() == 0
    lines = values(spark, [(" b \r\na\n\n",), ("a\rb",), ("",), (None,)], "t string", packing.canonical_lines(F.col("t")))
    assert lines == [(["a", "b"],), (["a", "b"],), ([],), ([],)]


def test_every_pair_of_many_copies(spark, tmp_path):
    data = [(i, f"a/{i}.txt", "one", "b\r\na" if i % 2 else "a\nb", 4) for i in range(66)] + [(5, "a/5.txt", "one", "a\nb", 4), (100, "c.txt", "two", "x", 1), (101, "c.txt", "two", "x", 1)]
    df = spark.createDataFrame(data, "file_id long, file_path string, out_name string, body string, n_bytes long").withColumn("written_at", F.lit(None).cast("timestamp"))
    df.write.parquet(f"{tmp_path}/label_files.parquet")
    want = [(i, j) for i in range(66) for j in range(i + 1, 66)] + [(100, 101)]
    assert sorted(rows(packing.p6_found(spark, str(tmp_path)))) == want


# ---------------------------------------------------------------- readers


def test_yolo_lines(spark):
    text = "0 .5 .5 .1 .1\n0.0 0.5 0.5 0.1 0.1 extra\r\n7 0.5 0.5 0.1 0.1\nabc 0.5 0.5 0.1 0.1\n1 0.5 0.5 0.1\n1 nan 0.5 0.1 0.1\n1 0.5 0.5 9 0.1\n\n inf 0.5 0.5 0.1 0.1\n-1 0.5 0.5 0.1 0.1"
    got = values(spark, [(text,), ("",), (None,)], "t string", F.transform(readers.yolo_boxes(F.col("t"), ["a", "b"]), lambda b: b["label"]))
    assert got == [(["a", "a", "7", "-1"],), ([],), ([],)]


def test_coco_and_voc(spark, tmp_path):
    doc = {"images": [{"id": 1, "file_name": "x/a.jpg", "width": 100, "height": 50, "dive": "D1"}, {"id": 2, "file_name": "b.jpg", "width": None, "height": 5}, {"id": 3, "file_name": "c.jpg", "width": 0, "height": 5}, {"id": 4, "file_name": "d.jpg", "width": 10, "height": 10}], "annotations": [{"image_id": 1, "category_id": 9, "bbox": [10, 10, 20, 10]}, {"image_id": 1, "category_id": 5, "bbox": [10, 10, 20, 10], "iscrowd": 0}, {"image_id": 1, "category_id": 9, "bbox": [1, 2, 3, 4], "iscrowd": 1}, {"image_id": 77, "category_id": 9, "bbox": [1, 2, 3, 4]}, {"image_id": 1, "category_id": 9, "bbox": [1, 2, 3]}, {"image_id": 2, "category_id": 9, "bbox": [1, 2, 3, 4]}], "categories": [{"id": 9, "name": "fish"}]}
    import json

    (tmp_path / "c.json").write_text(json.dumps(doc, indent=1))
    got = {r.image_path: r for r in readers.read("coco", spark, f"{tmp_path}/c.json", None, "d", mode="field").collect()}
    assert set(got) == {"x/a.jpg", "b.jpg", "c.jpg", "d.jpg"} and got["x/a.jpg"].group == "D1" and got["b.jpg"].group == "b"
    assert [tuple(b) for b in got["x/a.jpg"].boxes] == [("fish", 0.2, 0.3, 0.2, 0.2), ("5", 0.2, 0.3, 0.2, 0.2)] and not got["b.jpg"].boxes
    (tmp_path / "v").mkdir()
    one = "<annotation><filename>{f}</filename><size><width>100</width><height>{h}</height></size><object><name> cod </name><bndbox><xmin>10</xmin><ymin>10</ymin><xmax>30</xmax><ymax>20</ymax></bndbox></object><object><name>net</name><bndbox><xmin>x</xmin><ymin>1</ymin><xmax>3</xmax><ymax>2</ymax></bndbox></object></annotation>"
    (tmp_path / "v" / "p.xml").write_text(one.format(f="p.jpg", h=50))
    (tmp_path / "v" / "q.xml").write_text(one.format(f="", h=50))
    (tmp_path / "v" / "r.xml").write_text(one.format(f="r.jpg", h=0))
    (tmp_path / "v" / "s.xml").write_text("<annotation><filename>s.jpg")
    got = {r.image_path: [tuple(b) for b in r.boxes] for r in readers.read_voc(spark, f"{tmp_path}/v", None, "d").collect()}
    assert got == {"p.jpg": [("cod", 0.2, 0.3, 0.2, 0.2)], "q": [("cod", 0.2, 0.3, 0.2, 0.2)]}
    with pytest.raises(ValueError):
        readers.read("nothing")


def test_corpus_written_and_read_again(spark, tmp_path):
    items = spark.createDataFrame([("train", "a", [(0, 0.5, 0.5, 0.1, 0.1), (1, 0.5, 0.5, 0.2, 0.2)]), ("val", "b", [])], "split string, out_name string, labels array<struct<cid:int,cx:double,cy:double,w:double,h:double>>")
    assert tables.write_label_files(items, str(tmp_path)) == 2
    for part in (items, items.where("split = 'train'")):  # a second build leaves nothing of the first
        tables.write_corpus(part, f"{tmp_path}/table")
    assert rows(spark.read.parquet(f"{tmp_path}/table").select("split", "out_name", F.size("labels"))) == [("train", "a", 2)]
    assert rows(readers.yolo_corpus(spark, str(tmp_path))) == sorted([("train", "a", 0), ("train", "a", 1), ("val", "b", None)], key=repr)
    (tmp_path / "images").mkdir()
    (tmp_path / "images" / "a.jpg").write_bytes(b"x")
    got = readers.read("yolo", spark, f"{tmp_path}/labels/train", f"{tmp_path}/images", "d", names=["cod", "net"]).collect()
    assert [b.label for b in got[0].boxes] == ["cod", "net"]


def test_masks(spark):
    mask = np.zeros((10, 10), dtype=bool)
    mask[1:3, 1:3] = mask[3, 3] = mask[8, 7:9] = True
    assert pixels.components(mask) == [(1, 1, 3, 3, 5), (7, 8, 2, 1, 2)]
    assert [b[0] for b in pixels.mask_boxes(mask, "m", 0.02, 0.05)] == ["m", "m"] and len(pixels.mask_boxes(mask, "m", 0.03, 0.6)) == 1
    ring = np.ones((5, 5), dtype=bool)
    ring[2, 2] = False
    assert pixels.components(ring) == [(0, 0, 5, 5, 24)] and pixels.components(np.zeros((0, 0), dtype=bool)) == []
    bgr = np.zeros((4, 4, 3), dtype=np.uint8)
    bgr[:2, :2] = (0, 20, 200)
    df = spark.createDataFrame([("m/a.png", 4, 4, bytearray(bgr.tobytes())), ("m/b.png", 4, 4, None)], "path string, height int, width int, data binary")
    got = readers.mask_samples(df, "d", {"255,0,0": "red"}).collect()
    assert len(got) == 1 and tuple(got[0].boxes[0]) == ("red", 0.25, 0.25, 0.5, 0.5)
    codes = spark.createDataFrame([("x/0001m.png", 1, 4, bytearray([1, 1, 1, 2])), ("x/0002m.png", 1, 4, bytearray([0, 1, 1, 2])), ("x/0003.png", 1, 4, bytearray([1] * 4))], "path string, height int, width int, data binary")
    assert [(r.image_path, r.negative) for r in readers.negative_samples(codes, "d", [0]).collect()] == [("0001", True)]


def test_enhancement_tables():
    image = np.random.default_rng(0).integers(40, 200, (16, 16, 3)).astype(np.uint8)
    assert pixels.white_balance(image).min() == 0 and pixels.white_balance(image).max() == 255
    assert pixels.white_balance(np.full((4, 4, 3), 7, dtype=np.uint8)).shape == (4, 4, 3)
    assert (pixels.gamma(image) <= image).all() and pixels.interpolation(10, 5) == "area" and pixels.interpolation(5, 10) == "linear"


def test_images_written_and_read_again():
    r = np.random.default_rng(3)
    colour, grey = r.integers(0, 256, (7, 5, 3)).astype(np.uint8), r.integers(0, 256, (6, 9)).astype(np.uint8)
    assert (images.decode(images.encode_png(colour)) == colour).all() and (images.decode(images.encode_png(grey)) == grey).all()
    assert images.decode(b"") is images.decode(None) is images.decode(images.encode_png(grey)[:40]) is images.decode(b"BM12") is None
    for kind in range(5):  # every filter, put on by its definition and taken off again
        lines, above = [], np.zeros((5, 3), dtype=int)
        for line in colour.astype(int):
            left, corner = np.vstack([[0, 0, 0], line[:-1]]), np.vstack([[0, 0, 0], above[:-1]])
            p = left + above - corner
            near = np.where((abs(p - left) <= abs(p - above)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - above) <= abs(p - corner), above, corner))
            lines.append((line - [0, left, above, (left + above) // 2, near][kind]) & 255)
            above = line
        back, above = [], np.zeros((5, 3), dtype=np.uint8)
        for line in lines:
            above = images._unfiltered(kind, line.astype(np.uint8), above)
            back.append(above)
        assert (np.array(back) == colour).all()
    pixel_rows = b"".join(line[:, ::-1].tobytes() + b"\0" for line in colour[::-1])
    bmp = b"BM" + (54 + len(pixel_rows)).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (5).to_bytes(4, "little") + (7).to_bytes(4, "little") + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + bytes(24) + pixel_rows
    assert (images.decode(bmp) == colour).all()


def test_contrast_and_geometry_of_pixels():
    r = np.random.default_rng(4)
    flat = r.integers(100, 110, (64, 80)).astype(np.uint8)
    spread = pixels.clahe(flat)
    assert spread.shape == flat.shape and spread.std() > flat.std() and pixels.clahe(flat, clip=1e9).std() > spread.std()
    assert pixels.clahe(np.full((9, 9), 7, dtype=np.uint8)).shape == (9, 9)
    wide = np.zeros((10, 40, 3), dtype=np.uint8)
    wide[:, 14:26] = 200
    assert pixels.fitted(wide, 8, 6).shape == (6, 8, 3) and (pixels.fitted(wide, 8, 6) > 150).mean() > 0.8
    padded = pixels.fitted(wide, 8, 6, "pad")
    assert padded.shape == (6, 8, 3) and (padded[0] == 114).all() and pixels.resize(wide[..., 0], 80, 20).shape == (20, 80)


def test_corpus_images_and_publishing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.png").write_bytes(images.encode_png(np.full((6, 8, 3), 90, dtype=np.uint8)))
    (tmp_path / "in" / "b.png").write_bytes(b"no image")
    items = spark.createDataFrame([(f"file://{tmp_path}/in/a.png", "train", "x_1"), (f"{tmp_path}/in/b.png", "val", "x_2"), (f"{tmp_path}/in/c.png", "val", "x_3")], "image_path string, split string, out_name string")
    assert tuple(tables.write_images(items, f"{tmp_path}/out", 4, 3).first()) == (0, 1, 2)
    assert images.decode((tmp_path / "out" / "images" / "train" / "x_1.png").read_bytes()).shape == (3, 4, 3)
    labels_ = spark.createDataFrame([("train", "x_1", [(0, 0.5, 0.5, 0.1, 0.1)])], "split string, out_name string, labels array<struct<cid:int,cx:double,cy:double,w:double,h:double>>")
    tables.write_label_files(labels_, f"{tmp_path}/out")
    (tmp_path / "out" / "train_rfs.txt").write_text("./images/train/x_1.png\n")
    tables.publish_enhanced(spark, f"{tmp_path}/out", f"{tmp_path}/better", {0: "cod"})
    assert (tmp_path / "better" / "labels" / "train" / "x_1.txt").read_text() == "0 0.500000 0.500000 0.100000 0.100000\n"
    assert "train: train_rfs.txt" in (tmp_path / "better" / "dataset_rfs.yaml").read_text() and (tmp_path / "better" / "train_rfs.txt").exists()
    text = tables.domain_yaml(tables.dataset_yaml({0: "cod"}, "images/train", "images/val", "images/test", "/x"), "test", "surface")
    assert "test: test_surface.txt" in text and "path:" not in text and "train: images/train" in text and "  0: cod" in text


def test_report_as_text(spark):
    items = spark.createDataFrame([("a", "train", 2), ("a", "train", 0), ("b", "val", 1)], "dataset string, split string, n_labels long")
    labels_ = spark.createDataFrame([(0,), (0,), (1,), (None,)], "cid int")
    classes = spark.createDataFrame([(0, "cod"), (1, "net"), (2, "none")], "cid int, name string")
    drops = spark.createDataFrame([("a", "crab", 5), (None, None, 9)], "dataset string, label string, boxes long")
    text = corpus.report_text(corpus.unify_report(items, labels_, classes, drops))
    assert text.splitlines()[0] == "images" and "over the limit" in text and text.index("None") < text.index("a:crab")
    assert {(r.section, r.name): r.n for r in corpus.unify_report(items.limit(0), labels_.limit(0), classes, drops.limit(0)).collect()}[("images", "total")] == 0


def test_registry_selects(spark):
    from sparkshoal.plans import build

    registry = {"a": {}, "b": {"enabled": False}, "c": {"stride": 2}}
    assert build.selected(registry) == ["a", "c"] and build.selected(registry, ["c", "b"]) == ["c"]
    with pytest.raises(ValueError):
        build.selected(registry, ["b"])


def test_stopped_stream_goes_on_where_it_was(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.json").write_text(f'{{"uuid": "u{i}"}}\n')
    start = lambda: stream.append(stream.stream(spark, f"{tmp_path}/in", files_per_trigger=1).select("uuid"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    stream.run_until(start(), lambda: True, 0.01)
    assert stream.run_until(start(), lambda: False) is False
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [("u0",), ("u1",), ("u2",)]


def test_shared_folder_is_asked_for_off_one_machine():
    from types import SimpleNamespace

    from sparkshoal import session

    none = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(master="spark://far:7077", getConf=lambda: SimpleNamespace(get=lambda k: None), _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)))
    with pytest.raises(RuntimeError):
        session.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=context))


def test_image_lookup(spark):
    files = spark.createDataFrame([("root/a.jpg",), ("root/b.png",), ("root/b.jpg",), ("root/deep/c.JPG",), ("root/c.txt",)], "path string")
    wanted = spark.createDataFrame([("a.jpg",), ("b.bmp",), ("c.png",), ("none.jpg",), (None,)], "name string")
    assert dict(rows(listing.find_images(wanted, "name", files, "root"))) == {"a.jpg": "root/a.jpg", "b.bmp": "root/b.jpg", "c.png": "root/deep/c.JPG", "none.jpg": None, None: None}


def test_layout_and_archives(tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "set.zip", "w") as z:
        z.writestr("top/Images/a.jpg", "x")
        z.writestr("top/__MACOSX/b", "x")
        z.writestr("top/labels.json", "{}")
    out = tmp_path / "out"
    out.mkdir()
    assert archives.extract(str(tmp_path / "set.zip"), str(out)) == 2 and (out / "labels.json").exists()
    assert listing.resolve_path(str(out), "images", folder=True).endswith("Images") and listing.resolve_path(str(out), "*.json").endswith("labels.json") and listing.resolve_path(str(out), "none") is None
    with pytest.raises(ValueError):
        archives.safe_target(str(out), "../x")
    assert archives.find_archive("set.zip", [str(tmp_path)]).endswith("set.zip") and archives.find_archive("SET.tar", [str(tmp_path)]).endswith("set.zip")


def test_state_and_failover(spark, tmp_path):
    s = tables.StateTable(f"{tmp_path}/s.json")
    s.set("a", "complete")
    again = tables.StateTable(f"{tmp_path}/s.json")
    registry = spark.createDataFrame([("a",), ("b",)], "name string")
    assert again.status("a") == "complete" and {(r.name, r.status) for r in again.listing(spark, registry).collect()} == {("a", "complete"), ("b", "pending")}
    with pytest.raises(ValueError):
        s.set("a", "odd")
    calls = []
    ways = [lambda: calls.append(1) or False, lambda: calls.append(2) or True, lambda: calls.append(3) or True]
    assert tables.first_success(ways) and calls == [1, 2] and not tables.first_success(ways, manual=True)


def test_log_as_table_and_stream(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"uuid":"u1","file_name":"a"}\n\n{"uuid":"u2","boxes":[{"concept":"c","x":1,"y":2,"w":3,"h":4}]}\n{"uuid":"u3","fi')
    assert [r.uuid for r in tables.read_progress(spark, str(folder)).orderBy("uuid").collect()] == ["u1", "u2"]
    assert tables.read_progress(spark, f"{tmp_path}/none").count() == 0
    run = lambda: stream.append(stream.first_of_each(stream.stream(spark, str(folder))).select("uuid"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    run()
    (folder / "b.jsonl").write_text('{"uuid":"u2"}\n{"uuid":"u4"}\n')
    run()
    assert sorted(r.uuid for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["u1", "u2", "u4"]
    count = lambda log: log.groupBy("uuid").agg(F.count("*").alias("n"))
    stream.recompute(stream.stream(spark, str(folder)).where("uuid is not null"), f"{tmp_path}/all", count, f"{tmp_path}/report", f"{tmp_path}/cp2").awaitTermination()
    assert {r.uuid: r.n for r in spark.read.parquet(f"{tmp_path}/report").collect()} == {"u1": 1, "u2": 2, "u4": 1}


def test_manifest_and_lists(spark, tmp_path):
    df = spark.createDataFrame([("b", "train", "d", 'g "x", y', 1, "p"), ("a", "val", "d", "g", 0, "p")], tables.MANIFEST)
    tables.write_csv(df, f"{tmp_path}/m", ["out_name"])
    assert rows(tables.read_manifest(spark, f"{tmp_path}/m")) == rows(df)
    tables.write_lines(df, "out_name", ["out_name"], f"{tmp_path}/l", by="split")
    assert rows(spark.read.text(f"{tmp_path}/l/split=train")) == [("b",)]
    assert tables.dataset_yaml({1: "b", 0: "a"}, "t", "v", "x").splitlines()[-2:] == ["  0: a", "  1: b"]


def test_closure_reaches_the_end_of_deep_chains_and_cycles(spark):
    edges = [(i, i + 1) for i in range(150)] + [(1000, 1001), (1001, 1000), (None, 1), (3, None), (0, 1)]
    df = spark.createDataFrame(edges, "parent long, child long")
    got = {tuple(r) for r in concepts.closure(spark, df).collect()}
    want = {(i, j) for i in range(150) for j in range(i + 1, 151)} | {(a, b) for a in (1000, 1001) for b in (1000, 1001)} | {(i, None) for i in range(4)} | {(None, j) for j in range(1, 151)} | {(None, None)}
    assert got == want and concepts.closure(spark, df.limit(0)).count() == 0


def test_look_up_with_hot_keys(spark):
    from sparkshoal.operators.lookup import looked_up

    data = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 40}") for i in range(600)]
    df = spark.createDataFrame(data, "i long, k string")
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("unused", 3)], "k string, v int")
    want = rows(df.join(table, "k", "left"))
    assert rows(looked_up(df, ["k"], table, few=50)) == rows(looked_up(df, ["k"], table)) == want
    assert looked_up(df.limit(0), ["k"], table).count() == 0
