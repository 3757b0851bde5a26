"""Mixing sources to target weights.

Token weights of (source, language, topic) cells are raked to the wanted shares
of the sources and the natural shares of languages and topics by iterative
proportional fitting, with each source's cap on repeats kept. Topics are clusters
of texts by their tokens, fitted on all texts (``fit_topics``): each is encoded
once, and passes over its token counts move the centres. A text's expected
number of uses is its cell's weight over its cell's tokens: the whole part is
given, the rest drawn in the order of a hash of its id over the rest. How far the
draw goes is calibrated for each source on a histogram of all its texts by that
order and by size: what is too large for the tokens still needed is passed over.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType
from pyspark.sql.window import Window

from sparkshoal.functions.text import is_blank
from sparkshoal.session import checkpointed, remove_path, scratch_path, settings, table, worker_cache

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's makers cut text before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LANGUAGES = ("en", "de", "fr", "es")
TOPICS = 6  # clusters of texts
HASHED = 2_048  # buckets token numbers are counted in
AT_ONCE = 1 << 16  # counts of a block of texts
FINE = 1 << 20  # parts of one in which texts are summed: whole numbers, whose sum no order of texts changes
BUCKETS = 1024
#: Columns of a block of texts: arrays, and packed numbers (see ``text_blocks``).
KEPT = ("doc_id", "source", "lang", "tokens")
PACKED = ("draws", "sizes", "buckets", "counts")
#: Runs of white space that the pattern's engine, which goes back over them, is spared. White space as that engine has it.
LONG_BLANK = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")


def _encoder(path: str) -> Callable:
    """A maker of the encoder whose ranks lie at ``path``, which the driver reads and sends along: workers need no such file, and build it once each."""
    with open(path, "rb") as f:
        data = zlib.compress(f.read(), 1)
    mark = hashlib.md5(data).hexdigest()

    def get():
        import base64

        import tiktoken

        cache = worker_cache().setdefault("encoders", {})
        if mark not in cache:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, zlib.decompress(data).splitlines())}
            cache[mark] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return cache[mark]

    return get


def encode_whole(code, text: str) -> list[int]:
    """Tokens of a text of any form; see ``token_counts``."""
    if len(text) < 1000:  # no room for a long run
        return code.encode_ordinary(text)
    out: list[int] = []
    at = 0
    for run in LONG_BLANK.finditer(text):
        end = run.end() - (run.end() < len(text))
        out += code.encode_ordinary(text[at : run.start()])
        out += code._encode_single_piece(text[run.start() : end])
        at = end
    return out + code.encode_ordinary(text[at:]) if at else code.encode_ordinary(text)


def sizes_and_bags(path: str):
    """A column function: ``tokens`` of a text, and which buckets of token numbers it has (``buckets``, 16 bits each) how often (``counts``, 32 bits each)."""
    get = _encoder(path)

    @F.pandas_udf("tokens long, buckets binary, counts binary")
    def run(texts: pd.Series) -> pd.DataFrame:
        code = get()
        out = []
        for t in texts:
            ids = np.asarray(encode_whole(code, t) if isinstance(t, str) else [], dtype=np.int64)
            counts = np.bincount(ids % HASHED, minlength=HASHED)
            buckets = counts.nonzero()[0] if len(ids) else np.zeros(1, dtype=np.int64)
            out.append((len(ids), buckets.astype("<u2").tobytes(), counts[buckets].astype("<u4").tobytes()))
        return pd.DataFrame(out, columns=["tokens", "buckets", "counts"])

    return run


def text_blocks(documents: DataFrame, source: Column, path: str = TOKENIZER, seed: int = 42) -> DataFrame:
    """Every text that isn't blank once, of the smallest doc_id with a ``source``, in blocks of ``AT_ONCE`` counts at most, but a text at least.

    A block has its texts' doc_id, source, lang and tokens as arrays, and as packed
    numbers their draws (64 bits, by doc_id), how many buckets each has (16), and all
    buckets (16) and counts (8, or 32 where one needs them), so that a pass over them
    costs few rows and bytes.
    """
    lang = F.when(F.col("lang").isin(*LANGUAGES), F.col("lang")).otherwise("other")
    small = documents.where(F.col("doc_id").isNotNull() & ~is_blank(F.col("text"))).select("doc_id", F.md5("text").alias("text_id"), source.alias("source"), lang.alias("lang"), sizes_and_bags(path)("text").alias("x")).select("doc_id", "text_id", "source", "lang", "x.*")
    one = F.min(F.struct(F.col("source").isNull().alias("unwanted"), "doc_id", "source", "lang", "tokens", "buckets", "counts"))
    texts = small.groupBy("text_id").agg(one.alias("r")).select(*[f"r.{c}" for c in KEPT], F.xxhash64("r.doc_id", F.lit(seed)).alias("draw"), "r.buckets", "r.counts")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at, buckets = _numbers(batch.column("buckets"), "<u2")
            counts = _numbers(batch.column("counts"), "<u4")[1]
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(at, at[start] + AT_ONCE, side="right")) - 1)
                own, here = batch.slice(start, stop - start), slice(at[start], at[stop])
                packed = own.column("draw").to_numpy().astype("<i8"), np.diff(at[start : stop + 1]).astype("<u2"), buckets[here], counts[here].astype("<u4" if counts[here].max() > 255 else "u1")
                lists = [pa.ListArray.from_arrays(pa.array([0, stop - start], pa.int32()), own.column(c)) for c in KEPT]
                yield pa.RecordBatch.from_arrays([*lists, *[pa.array([x.tobytes()], pa.binary()) for x in packed]], names=[*KEPT, *PACKED])
                start = stop

    schema = StructType()
    for c in KEPT:
        schema.add(c, ArrayType(texts.schema[c].dataType))
    for c in PACKED:
        schema.add(c, BinaryType())
    return texts.mapInArrow(run, schema)


def _numbers(column, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the numbers of each value of a binary Arrow column begin and end, and the numbers of all."""
    import pyarrow as pa

    if not len(column):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=kind)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype="<i8" if pa.types.is_large_binary(column.type) else "<i4")[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (at - at[0]) // np.dtype(kind).itemsize, np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]].view(kind)


def _block(batch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block, where each text's counts begin, and the bucket and the number of each count. Every text has a count."""
    sizes, buckets, counts = (batch.column(c)[i].as_buffer() for c in ("sizes", "buckets", "counts"))
    sizes, buckets = np.frombuffer(sizes, "<u2"), np.frombuffer(buckets, "<u2")
    counts = np.frombuffer(counts, f"<u{counts.size // len(buckets)}")
    return np.cumsum(sizes, dtype=np.int64) - sizes, buckets.astype(np.intp), counts.astype(float)


def _likeness(weights: np.ndarray, starts: np.ndarray, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each topic's weights over each text's tokens (topic, text)."""
    out = np.empty((len(weights), len(starts)))
    for k, w in enumerate(weights):
        x = w.take(buckets)
        x *= counts
        np.add.reduceat(x, starts, out=out[k])
    return out


def _unit(rarity: np.ndarray, starts: np.ndarray, buckets: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts weighted by rarity, and their length for each text."""
    x = rarity.take(buckets) * counts
    return x, np.maximum(np.sqrt(np.add.reduceat(x * x, starts)), 1e-9)


def _totals(blocks: DataFrame, size: int, part: Callable) -> np.ndarray:
    """``size`` whole numbers, summed over all texts; ``part`` gives those of a block. Tasks hand on one row each, the driver gets one in all."""

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                total += part(*_block(batch, i))
        yield _row(total=total.tobytes())

    def add(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for x in batch.column("total"):
                total += np.frombuffer(x.as_buffer(), dtype=np.int64)
        yield _row(total=total.tobytes())

    rows = blocks.select("sizes", "buckets", "counts").mapInArrow(run, "total binary").repartition(1).mapInArrow(add, "total binary").collect()
    return np.frombuffer(rows[0].total, dtype=np.int64) if rows else np.zeros(size, dtype=np.int64)


def _row(**values):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([v]) for v in values.values()], names=list(values))


def _next_centre(blocks: DataFrame, centres: np.ndarray, rarity: np.ndarray) -> np.ndarray | None:
    """A text drawn from all, in proportion to how unlike the nearest centre it is (k-means++); None if there is none unlike."""
    weights, step = np.vstack([np.zeros((1, HASHED)), centres * rarity]), len(centres)

    def run(batches):
        best = None
        for batch in batches:
            for i in range(batch.num_rows):
                starts, buckets, counts = _block(batch, i)
                unlike = 1 - (_likeness(weights, starts, buckets, counts) / _unit(rarity, starts, buckets, counts)[1]).max(axis=0)
                # The least of exponential times whose rates are the unlikenesses, by a draw of its own for each centre.
                draw = np.frombuffer(batch.column("draws")[i].as_buffer(), "<u8") * np.uint64(2 * step + 1)
                u = (((draw ^ (draw >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(12)).astype(float) + 0.5) / float(1 << 52)
                key = np.where(unlike > 1e-9, -np.log(u) / np.maximum(unlike, 1e-9), np.inf)
                j = int(key.argmin())
                if key[j] < (best["key"] if best else np.inf):
                    here = slice(starts[j], starts[j + 1] if j + 1 < len(starts) else None)
                    best = {"key": float(key[j]), "draw": int(draw[j]) >> 1, "buckets": buckets[here].astype("<u2").tobytes(), "counts": counts[here].astype("<u4").tobytes()}
        if best:
            yield _row(**best)

    r = blocks.select(*PACKED).mapInArrow(run, "key double, draw long, buckets binary, counts binary").orderBy("key", "draw").first()
    if r is None:
        return None
    x = np.zeros(HASHED)
    x[np.frombuffer(r.buckets, "<u2")] = np.frombuffer(r.counts, "<u4")
    x *= rarity
    return x / np.linalg.norm(x)


def fit_topics(blocks: DataFrame, topics: int = TOPICS) -> np.ndarray:
    """Weights (topic, bucket of a token's number) whose sum over a text's tokens is greatest for its topic.

    Spherical k-means over the hashed token counts of all texts of ``blocks`` (see
    ``text_blocks``), weighted by their rarity. Each step is one pass: rarity, the
    first centres, and up to 20 moves of the centres, ended when they stay. Only
    sums (``topics`` by ``HASHED`` numbers) reach the driver; neither the order of
    texts nor their parting changes them. Fewer different texts than topics give fewer
    topics, none gives one.
    """
    seen = _totals(blocks, HASHED + 1, lambda starts, buckets, counts: np.append(np.bincount(buckets, minlength=HASHED), len(starts)))
    if not seen[HASHED]:
        return np.zeros((1, HASHED))
    rarity = np.log((1 + seen[HASHED]) / (1 + seen[:HASHED])) + 1e-3
    centres = np.zeros((0, HASHED))
    while len(centres) < topics and (x := _next_centre(blocks, centres, rarity)) is not None:
        centres = np.vstack([centres, x])
    for _ in range(20):
        weights = centres * rarity

        def part(starts, buckets, counts, weights=weights):
            own = _likeness(weights, starts, buckets, counts).argmax(axis=0)
            x, length = _unit(rarity, starts, buckets, counts)
            sizes = np.diff(np.append(starts, len(buckets)))
            x = np.rint(x * np.repeat(FINE / length, sizes))
            return np.bincount(np.repeat(own * HASHED, sizes) + buckets, weights=x, minlength=weights.size).astype(np.int64)

        new = _totals(blocks, centres.size, part).reshape(centres.shape).astype(float)
        length = np.linalg.norm(new, axis=1, keepdims=True)
        new = np.where(length > 0, new / np.maximum(length, 1e-9), centres)
        if np.abs(new - centres).max() < 1e-5:
            break
        centres = new
    return centres * rarity


def with_topics(blocks: DataFrame, weights: np.ndarray) -> DataFrame:
    """The texts of ``blocks``, a row each, with their topic: doc_id, source, lang, tokens, topic."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            topic = [_likeness(weights, *_block(batch, i)).argmax(axis=0) for i in range(batch.num_rows)]
            if topic:
                yield pa.RecordBatch.from_arrays([*[batch.column(c).flatten() for c in KEPT], pa.array(np.concatenate(topic), pa.int32())], names=[*KEPT, "topic"])

    schema = StructType()
    for c in KEPT:
        schema.add(c, blocks.schema[c].dataType.elementType)
    return blocks.select(*KEPT, "sizes", "buckets", "counts").mapInArrow(run, schema.add("topic", IntegerType()))


def token_counts(path: str = TOKENIZER):
    """A column function: number of tokens of a text under the tokenizer whose ranks lie at ``path``.

    Every text is encoded whole. Long runs of white space, on which the pattern's
    engine runs out of stack, are handed over as the one piece that the pattern
    makes of them: all of the run but its last character if more text follows.
    """

    get = _encoder(path)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        code = get()
        return texts.map(lambda t: len(encode_whole(code, t)) if isinstance(t, str) else 0).astype("int64")

    return count


def rake(tokens: np.ndarray, shares: np.ndarray, caps: np.ndarray, total: float, rounds: int = 500) -> np.ndarray:
    """Tokens wanted of each cell (source, language, topic), by iterative proportional fitting.

    Sources meet ``shares`` of ``total`` (the last step of every round), languages
    and topics their shares of ``tokens`` as nearly as the caps (uses of a text of
    each source) allow.
    """
    want = tokens.astype(float).copy()
    natural = tokens.sum()
    limit = tokens * caps[:, None, None]
    for _ in range(rounds):
        old = want.copy()
        for axis, others in ((1, (0, 2)), (2, (0, 1))):
            now, goal = want.sum(axis=others), tokens.sum(axis=others) / natural * total
            want *= np.divide(goal, now, out=np.ones_like(now), where=now > 0).reshape([-1 if i == axis else 1 for i in range(3)])
        for s, share in enumerate(shares):
            want[s] = _fill(want[s], limit[s], share * total)
        if np.abs(want - old).max() < 1e-9 * max(1.0, total):
            break
    return want


def _fill(x: np.ndarray, limit: np.ndarray, goal: float) -> np.ndarray:
    """``x`` scaled to sum to ``goal`` with no cell above its limit."""
    goal = min(goal, limit.sum())
    x = np.where((x <= 0) & (limit > 0), limit * 1e-12, x)
    full = np.zeros(x.shape, dtype=bool)
    while True:
        rest = goal - limit[full].sum()
        free = x[~full].sum()
        scaled = np.where(full, limit, x * (rest / free if free > 0 else 0))
        over = (scaled > limit * (1 + 1e-12)) & ~full
        if not over.any():
            return scaled
        full |= over


def draw_cell(at: Column, tokens: Column) -> Column:
    """Cell of the histogram that calibrates a draw: texts of like place in the order and like size.

    A text of place ``at`` is expected to be drawn below 1. Up to there places are
    cut evenly, beyond in proportion, so however far a draw must go on it meets
    cells of about a ``BUCKETS``-th of what was drawn before them.
    """
    place = F.floor(F.when(at < 1, at * BUCKETS).otherwise(BUCKETS * (1 + F.log2(at))))
    return place * 64 + F.floor(F.log2(F.greatest(tokens, F.lit(1))))


def fill(cells: list[tuple[int, int]], need: float) -> list[int]:
    """Cells (cell, tokens) to take for ``need`` tokens: in their order, those too large for what is still needed passed over, and in the end the smallest of these if that comes nearer."""
    taken, least = [], None
    for cell, n in cells:
        if n <= need:
            taken.append(cell)
            need -= n
        elif least is None or n < least[1]:
            least = cell, n
    return [*taken, least[0]] if least and least[1] < 2 * need else taken


def mix(documents: DataFrame, targets: DataFrame, tokenizer: str = TOKENIZER, total: float | None = None, seed: int = 42) -> tuple[DataFrame, list[tuple]]:
    """Uses of each text, and per source what was wanted and what came of it.

    A text that occurs under several doc_ids is one text (of the smallest doc_id
    with a wanted source). Blank texts and texts of sources without a positive
    share are left out. Shares are taken over the sources that have texts.
    ``total`` tokens, by default as many as the texts of wanted sources have, are
    lowered to what the caps allow. A null cap is one use.
    Result: doc_id, source, copies, tokens (rows with copies > 0).
    """
    spark = documents.sparkSession
    wanted = {r.source: (r.share, r.cap) for r in targets.where("source is not null and target_share > 0").groupBy("source").agg(F.max("target_share").alias("share"), F.coalesce(F.max("max_repeats"), F.lit(1)).alias("cap")).collect()}
    names = sorted(wanted)
    source = F.when(F.col("source").isin(names), F.col("source")) if names else F.lit(None).cast("string")
    blocks, path = text_blocks(documents, source, tokenizer, seed), scratch_path(spark, "texts")
    blocks.write.mode("overwrite").option("compression", "snappy").parquet(path)
    blocks = spark.read.schema(blocks.schema).parquet(path)
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="32"):  # a row is a whole block
        weights = fit_topics(blocks)
        texts = checkpointed(spark, with_topics(blocks, weights).where("source is not null"))
    remove_path(spark, path)
    langs, topics = [*LANGUAGES, "other"], list(range(len(weights)))
    tokens = np.zeros((len(names), len(langs), len(topics)))
    for r in texts.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("n")).collect():
        tokens[names.index(r.source), langs.index(r.lang), topics.index(r.topic)] = r.n
    there = tokens.sum(axis=(1, 2)) > 0
    shares = np.array([wanted[s][0] if t else 0.0 for s, t in zip(names, there)])
    shares = shares / shares.sum() if shares.sum() else shares
    caps = np.array([max(0, wanted[s][1]) for s in names], dtype=float)
    most = min([c * t / s for c, t, s in zip(caps, tokens.sum(axis=(1, 2)), shares) if s > 0], default=0.0)
    goal = min(total or tokens.sum(), most)
    uses = np.divide(rake(tokens, shares, caps, goal), tokens, out=np.zeros_like(tokens), where=tokens > 0) if there.any() else tokens
    cells = [(s, lang, t, float(min(uses[i, j, k], caps[i]))) for i, s in enumerate(names) for j, lang in enumerate(langs) for k, t in enumerate(topics)]
    uses_of = spark.createDataFrame(cells, "source string, lang string, topic int, uses double")
    u = (F.xxhash64("doc_id", F.lit(seed)).bitwiseAND((1 << 52) - 1)) / float(1 << 52)
    drawn = texts.join(F.broadcast(uses_of), ["source", "lang", "topic"]).withColumn("whole", F.floor(F.col("uses") + 1e-9)).withColumn("part", F.greatest(F.col("uses") - F.col("whole"), F.lit(0.0)))  # at most sources x languages x topics rows
    drawn = drawn.withColumn("at", F.when(F.col("part") > 1e-9, u / F.col("part"))).withColumn("cell", draw_cell(F.col("at"), F.col("tokens")))
    base = {r.source: r.n for r in drawn.groupBy("source").agg(F.sum(F.col("whole") * F.col("tokens")).alias("n")).collect()}
    steps: dict[str, list] = {}
    for r in drawn.where("cell is not null").groupBy("source", "cell").agg(F.sum("tokens").alias("n")).orderBy("source", "cell").collect():
        steps.setdefault(r.source, []).append((r.cell, r.n))
    chosen = [(s, cell) for s, share in zip(names, shares) for cell in fill(steps.get(s, []), share * goal - base.get(s, 0))]
    cut = spark.createDataFrame(chosen, "source string, cell long").withColumn("extra", F.lit(1).cast("long"))
    taken = drawn.join(F.broadcast(cut), ["source", "cell"], "left").select("doc_id", "source", (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("long").alias("copies"), "tokens").where("copies > 0")  # at most sources x cells
    return taken, [(s, wanted[s][0], float(share), int(wanted[s][1])) for s, share in zip(names, shares)]


def p8_mix(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark, sf_dir: str) -> DataFrame:
    """Wanted and actual share of tokens of every source of the targets."""
    taken, wanted = mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))
    goals = spark.createDataFrame(wanted, "source string, target_share double, attainable_share double, max_repeats int")
    got = taken.groupBy("source").agg(F.sum(F.col("copies") * F.col("tokens")).alias("tokens"), F.count("*").alias("texts"), F.max("copies").alias("most_copies"))
    return goals.join(got, "source", "left").withColumn("all_tokens", F.sum("tokens").over(Window.partitionBy())).select("source", "target_share", F.round("attainable_share", 6).alias("attainable_share"), F.round(F.coalesce("tokens", F.lit(0)) / F.col("all_tokens"), 6).alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("texts", F.lit(0)).alias("texts"), "max_repeats", F.coalesce("most_copies", F.lit(0)).alias("most_copies"))


def p8_checks(spark, sf_dir: str) -> DataFrame:
    """What the mix promises, source by source: its attainable share, met within 0.03, and its cap kept."""
    shares = p8_shares(spark, sf_dir)
    near = F.abs(F.coalesce("actual_share", F.lit(0.0)) - F.col("attainable_share")) <= 0.03
    return shares.select("source", "attainable_share", near.alias("share_met"), (F.col("most_copies") <= F.col("max_repeats")).alias("cap_kept"))
