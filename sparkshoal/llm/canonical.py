"""Mapping free-entered values to a canonical list.

A BK-tree over the reference entries under Levenshtein distance returns every
entry within a threshold; the triangle inequality prunes subtrees. The search
runs over a whole batch of distinct values at once: at each tree node the
distance of the node's entry to all values still alive there is computed by the
bit-parallel recurrence of Myers (1999, Hyyro's form) in numpy. The tree holds
entries as folded letters without spaces, and every entry a value gets comes from
it: readings of the value (as typed, without remarks, words in other order, in
the singular, cut off by dots) are looked up, each within its own threshold.
Larger reference lists are cut into shards, each searched with its own tree; the
rules that pick a winner are applied once, to the nearest entries of all shards.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkshoal.operators.lookup import looked_up
from sparkshoal.session import checkpointed, table

#: Letters of other scripts and digits that stand for a Latin letter by their look (fixed values).
LOOKALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ø": "o", "ł": "l", "đ": "d", "æ": "ae", "œ": "oe", "ß": "ss",
}
DIGIT = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
#: Words and marks people add to a name without changing what it denotes (fixed values).
REMARKS = ["cf", "aff", "sp", "spp", "indet", "juv", "juvenile", "adult", "unsure", "uncertain", "maybe", "possibly", "probably", "likely", "partial", "partly", "occluded", "left edge", "right edge", "top edge", "bottom edge", "left", "right", "edge", "cropped", "blurry", "blurred", "dead", "unknown", "tbc", "check"]


def remark_pattern(remarks: list[str]) -> re.Pattern:
    return re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, remarks), key=len, reverse=True)) + r")\b\.?") if remarks else re.compile(r"(?!)")


_REMARK = remark_pattern(REMARKS)
_COUNT = re.compile(r"#\s*\d+|\b\d+\s*[x×]\s+|\bx\s*\d+\b|\(\d+\)|\b\d+$")
_WORD = re.compile(r"[^\W_]+")


def fold(value: str) -> str:
    """Lower case, no accents, look-alike letters made Latin, invisible characters gone."""
    out = []
    for ch in unicodedata.normalize("NFKD", value.casefold()):
        kind = unicodedata.category(ch)
        if kind not in ("Mn", "Cf", "Cc") or ch in "\t\n\r\x0b\x0c":
            out.append(LOOKALIKE.get(ch, ch))
    return "".join(out)


def variants(value: str, remarks: re.Pattern = _REMARK) -> list[str]:
    """Readings of a typed value, plainest first: as folded, then without remarks, then with its words in other order."""
    text = fold(value)
    if not any(ch.isalpha() for ch in text):
        return []
    text = re.sub(r"(?<=[a-z])[0-9](?=[a-z])|(?<=[a-z])[0-9](?=$|\s)|(?<![\w#])[0-9](?=[a-z]{3})", lambda m: DIGIT.get(m.group(), m.group()), text)
    plain = " ".join(_WORD.findall(text))
    bare = _COUNT.sub(" ", remarks.sub(" ", text))
    out = [plain, " ".join(_WORD.findall(bare))]
    words = _WORD.findall(bare)
    if 2 <= len(words) <= 4:
        out.append(" ".join(words[1:] + words[:1]))
        out.append(" ".join(words[-1:] + words[:-1]))
    return list(dict.fromkeys(x for x in out if x))


def encode(values: list[str], width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Values as a zero-padded matrix of character codes, and their lengths."""
    lengths = np.array([len(v) for v in values], dtype=np.int64)
    codes = np.zeros((len(values), max(int(lengths.max(initial=0)), 1)), dtype=np.uint32)
    for i, v in enumerate(values):
        codes[i, : len(v)] = np.frombuffer(v.encode("utf-32-le"), dtype=np.uint32)
    return codes, lengths


def distances(pattern: str, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Levenshtein distance of one pattern to each coded value (patterns over 64 characters: plain rows)."""
    m = len(pattern)
    if m == 0:
        return lengths.copy()
    if m > 64:
        return np.array([_rows(pattern, c[:n]) for c, n in zip(codes, lengths)], dtype=np.int64)
    letters = sorted(set(pattern))
    masks = np.zeros(len(letters) + 1, dtype=np.uint64)
    for i, ch in enumerate(pattern):
        masks[letters.index(ch) + 1] |= np.uint64(1 << i)
    known = np.array([ord(x) for x in letters], dtype=np.uint32)
    at = np.searchsorted(known, codes)
    at[at == len(known)] = 0
    eq_all = np.where(known[at] == codes, masks[at + 1], np.uint64(0))
    one, top = np.uint64(1), np.uint64(m - 1)
    n = len(codes)
    pv, mv = np.full(n, ~np.uint64(0), dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    score, out = np.full(n, m, dtype=np.int64), np.full(n, m, dtype=np.int64)
    for j in range(codes.shape[1]):
        eq = eq_all[:, j]
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        score += ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64)
        ph = (ph << one) | one
        mh = mh << one
        pv = mh | ~(xv | ph)
        mv = ph & xv
        out = np.where(lengths == j + 1, score, out)
    return out


def _rows(pattern: str, codes: np.ndarray) -> int:
    row = np.arange(len(pattern) + 1)
    p = np.frombuffer(pattern.encode("utf-32-le"), dtype=np.uint32)
    for i, c in enumerate(codes, 1):
        best = np.minimum(row[:-1] + (p != c), row[1:] + 1)
        new = np.concatenate(([i], best))
        step = np.arange(len(new))
        row = np.minimum.accumulate(new - step) + step
    return int(row[-1])


class BKTree:
    """A BK-tree over distinct strings: children of a node lie at their distance from it."""

    def __init__(self, entries: Iterable[str]) -> None:
        self.entries: list[str] = []
        self.children: list[dict[int, int]] = []
        for e in dict.fromkeys(entries):
            self._add(e)

    def _add(self, entry: str) -> None:
        codes, lengths = encode([entry])
        at, new = 0, len(self.entries)
        self.entries.append(entry)
        self.children.append({})
        while new:
            d = int(distances(self.entries[at], codes, lengths)[0])
            if d not in self.children[at]:
                self.children[at][d] = new
                return
            at = self.children[at][d]

    def search(self, values: list[str], limit: np.ndarray) -> list[tuple[np.ndarray, str, np.ndarray]]:
        """(positions of values, entry, distances) for every entry within each value's own limit."""
        found = []
        if not self.entries or not values:
            return found
        order = np.argsort([len(v) for v in values], kind="stable")
        for part in np.array_split(order, max(1, len(order) // 2048)):
            codes, lengths = encode([values[i] for i in part])
            todo = [(0, np.arange(len(part)))]
            while todo:
                node, alive = todo.pop()
                d = distances(self.entries[node], codes[alive], lengths[alive])
                hit = d <= limit[part[alive]]
                if hit.any():
                    found.append((part[alive[hit]], self.entries[node], d[hit]))
                for step, child in self.children[node].items():
                    near = np.abs(d - step) <= limit[part[alive]]
                    if near.any():
                        todo.append((child, alive[near]))
        return found


def tolerance(length: int) -> int:
    """Edits allowed for a name of this length."""
    return 0 if length < 4 else 1 if length < 6 else 2 if length < 12 else 3


def _joined(text: str) -> str:
    return text.replace(" ", "")


def readings(value: str, remarks: re.Pattern = _REMARK) -> list[tuple[str, int]]:
    """What a value is looked up by, without spaces, plainest first, each with its tolerance; a singular of a plural must be an entry itself."""
    texts = variants(value, remarks)
    out = [(_joined(t), tolerance(len(t))) for t in texts]
    out += [(_joined(t[: -len(e)]), 0) for t in texts for e in ("es", "s") if t.endswith(e) and len(t) > len(e) + 3]
    return list(dict(reversed(out)).items())[::-1]


Found = tuple[dict[str, tuple[int, int]], dict[str, int]]  # nearest entries with (distance, reading); entries a cut-off value goes on to with their distance


def candidates(values: list[str], tree: BKTree, remarks: re.Pattern = _REMARK) -> list[Found]:
    """For each value the tree's nearest entries, and the entries that begin with a value cut off by dots.

    All come from searches of the tree under the edit metric: a cut-off value's
    with the number of letters the longest entry has more, as an entry that
    begins with a stem lies exactly as far from it as it has letters more. Of
    these two are given at most: only a single one counts.
    """
    texts, limits, owner = [], [], []
    for i, v in enumerate(values):
        for k, (t, limit) in enumerate(readings(v, remarks)):
            texts.append(t)
            limits.append(limit)
            owner.append((i, k))
    near: list[dict[str, tuple[int, int]]] = [{} for _ in values]
    for where, entry, d in tree.search(texts, np.array(limits, dtype=np.int64)):
        for at, dist in zip(where.tolist(), d.tolist()):
            i, k = owner[at]
            near[i][entry] = min((dist, k), near[i].get(entry, (99, 0)))
    stems = []
    for i, v in enumerate(values):
        cut = re.fullmatch(r"(.*\S)\s*(?:…|\.{1,3})", v.strip())
        stem = "".join(_WORD.findall(fold(cut.group(1)))) if cut else ""
        if len(stem) >= 5 and not any(d == 0 for d, _ in near[i].values()):
            stems.append((i, stem))
    longer: list[dict[str, int]] = [{} for _ in values]
    most = max(map(len, tree.entries), default=0)
    for where, entry, d in tree.search([s for _, s in stems], np.array([max(0, most - len(s)) for _, s in stems], dtype=np.int64)):
        for at, dist in zip(where.tolist(), d.tolist()):
            i, stem = stems[at]
            if entry.startswith(stem) and len(longer[i]) < 2:
                longer[i][entry] = dist
    out = []
    for i in range(len(values)):
        least = min((d for d, _ in near[i].values()), default=0)
        out.append(({e: x for e, x in near[i].items() if x[0] == least}, longer[i]))
    return out


def decide(value: str, near: dict[str, tuple[int, int]], longer: dict[str, int], names: dict[str, list[str]], remarks: re.Pattern = _REMARK) -> tuple[str, int] | None:
    """The one entry a value denotes with the distance of its reading, or None, from the candidates of the whole list.

    Several entries equally near are told apart by two swapped neighbours (one
    slip of the hand, two edits), then by the plainer reading.
    """
    if len(longer) == 1 and not any(d == 0 for d, _ in near.values()):
        winners, least = list(longer), next(iter(longer.values()))
    elif near:
        least = min(d for d, _ in near.values())
        winners = [e for e, (d, _) in near.items() if d == least]
        if len(winners) > 1:
            swaps = [e for e in winners if any(_swapped(t, e) for t, _ in readings(value, remarks))]
            plainest = min(near[e][1] for e in winners)
            winners = swaps if len(swaps) == 1 else [e for e in winners if near[e][1] == plainest]
    else:
        return None
    if len(winners) != 1:
        return None
    alike = names[winners[0]]  # entries that differ only in what folding takes away
    codes, lengths = encode(alike)
    return (alike[int(np.argmin(distances(value, codes, lengths)))] if len(alike) > 1 else alike[0], least)


def match(values: list[str], tree: BKTree, names: dict[str, list[str]], remarks: re.Pattern = _REMARK) -> list[tuple[str, int] | None]:
    """The one entry each value denotes with the distance of its nearest reading, or None.

    The nearest entry under the tree's metric wins. An entry that ties with
    another at the same distance is not chosen unless an exact check tells them
    apart (``decide``). A value cut off by dots (``Baeraltria...``) denotes the
    only entry that begins so. A value nearer to no entry than its tolerance
    denotes none.
    """
    return [decide(v, near, longer, names, remarks) for v, (near, longer) in zip(values, candidates(values, tree, remarks))]


def _swapped(a: str, b: str) -> bool:
    """True if two neighbouring characters of ``a`` swapped give ``b``."""
    if len(a) != len(b):
        return False
    off = [i for i in range(len(a)) if a[i] != b[i]]
    return len(off) == 2 and off[1] == off[0] + 1 and a[off[0]] == b[off[1]] and a[off[1]] == b[off[0]]


def canonical(rows: DataFrame, value: str, entries: DataFrame, entry: str, shard_entries: int = 50_000, slice_values: int = 200_000, remarks: list[str] = REMARKS) -> DataFrame:
    """``rows`` with the entry its value denotes and the distance of its nearest reading, as ``_entry`` and ``_distance`` (null: none).

    Each task looks up its own distinct values once, so nothing is shuffled and
    a hot value costs one search a task. That is so up to ``shard_entries``
    entries, which are sent to the tasks. A larger list is cut into shards that
    stay with the tasks: the distinct values meet every shard in slices of about
    ``slice_values``, each pair of shard and slice in a task of its own, the
    rules of ``match`` are applied once to the candidates of all shards, and rows
    get their value's outcome by a join that hot values don't skew
    (``looked_up``). The outcome is the same either way. ``remarks`` are words
    and marks that don't change what a value denotes. Null and blank values
    denote none. Existing columns ``_entry`` and ``_distance`` are replaced.
    """
    pattern = remark_pattern(remarks)
    names = entries.select(F.col(entry).alias("e")).where("e is not null").distinct()
    shards = max(1, -(-names.count() // shard_entries))
    kept = rows.drop("_entry", "_distance")
    if shards == 1:
        schema = T.StructType([*kept.schema.fields, T.StructField("_entry", T.StringType()), T.StructField("_distance", T.IntegerType())])
        return kept.mapInArrow(_searcher(value, _folded(r.e for r in names.collect()), pattern), schema)
    spark = rows.sparkSession
    values = checkpointed(spark, kept.select(F.col(value).alias("v")).where("v is not null").distinct())
    slices = max(1, -(-values.count() // slice_values))
    left = values.select("v", F.pmod(F.xxhash64("v"), F.lit(slices)).alias("slice"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    right = names.select("e", F.pmod(F.xxhash64("e"), F.lit(shards)).alias("own"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("part"))
    found = left.groupBy("shard", "slice").cogroup(right.groupBy("own", "part")).applyInArrow(_collector(pattern), "v string, line string")
    each = found.groupBy("v").agg(F.collect_list("line").alias("lines"))  # at most a line a shard
    decided = checkpointed(spark, each.mapInArrow(_decider(pattern), "v string, _entry string, _distance int"))
    return looked_up(kept.withColumn("v", F.col(value)), ["v"], decided).select(*kept.columns, "_entry", "_distance") if "v" not in kept.columns else looked_up(kept, [value], decided.withColumnRenamed("v", value)).select(*kept.columns, "_entry", "_distance")


def _folded(own: Iterable[str]) -> dict[str, list[str]]:
    """Entries by their folded letters, which the tree holds."""
    names: dict[str, list[str]] = {}
    for e in sorted(own):
        key = "".join(_WORD.findall(fold(e)))
        if key:
            names.setdefault(key, []).append(e)
    return names


def _searcher(value: str, names: dict[str, list[str]], remarks: re.Pattern) -> Callable:
    def run(batches):
        tree = BKTree(names)
        seen: dict[str, tuple[str, int] | None] = {}
        for batch in batches:
            texts = batch.column(value).to_pylist()
            if len(seen) > 500_000:
                seen.clear()
            new = [x for x in dict.fromkeys(texts) if x is not None and x not in seen]
            seen.update(zip(new, match(new, tree, names, remarks)))
            got = [seen[x] if x is not None else None for x in texts]
            found = [pa.array([g[0] if g else None for g in got], pa.string()), pa.array([g[1] if g else None for g in got], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, "_entry", "_distance"])

    return run


def _collector(remarks: re.Pattern) -> Callable:
    """The candidates a shard has for the values of a slice: a line of JSON for each value that has any."""

    def run(values: pa.Table, own: pa.Table) -> pa.Table:
        names = _folded(own.column("e").to_pylist())
        texts = values.column("v").to_pylist()
        found = [(v, json.dumps([near, longer, {e: names[e] for e in [*near, *longer]}])) for v, (near, longer) in zip(texts, candidates(texts, BKTree(names), remarks)) if near or longer]
        return pa.table({"v": pa.array([v for v, _ in found], pa.string()), "line": pa.array([x for _, x in found], pa.string())})

    return run


def _decider(remarks: re.Pattern) -> Callable:
    """Applies the rules to the candidates of all shards."""

    def one(text: str, lines: list[str]) -> tuple[str, int] | None:
        near: dict[str, tuple[int, int]] = {}
        longer: dict[str, int] = {}
        names: dict[str, list[str]] = {}
        for line in lines:
            n, more, own = json.loads(line)
            near.update({e: min(tuple(x), near.get(e, (99, 0))) for e, x in n.items()})
            longer.update(more)
            for e, alike in own.items():
                names[e] = sorted({*alike, *names.get(e, [])})
        return decide(text, near, longer, names, remarks)

    def run(batches):
        for batch in batches:
            texts = batch.column("v").to_pylist()
            got = [one(v, lines) for v, lines in zip(texts, batch.column("lines").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("v"), pa.array([g[0] if g else None for g in got], pa.string()), pa.array([g[1] if g else None for g in got], pa.int32())], names=["v", "_entry", "_distance"])

    return run


def p2_found(spark, sf_dir: str) -> DataFrame:
    boxes, entries = table(spark, sf_dir, "boxes"), table(spark, sf_dir, "fathomnet_concept_map")
    found = canonical(boxes.select("box_id", "label").where("label is not null"), "label", entries, "concept")
    # Rows of one box count once; the entry itself, written character for character, is no case.
    return found.where("_entry is not null and _entry <> label and box_id is not null").groupBy("box_id").agg(F.min("_entry").alias("concept"))


def p2_unmatched(spark, sf_dir: str) -> DataFrame:
    """Labels that denote no entry, with their boxes."""
    boxes, entries = table(spark, sf_dir, "boxes"), table(spark, sf_dir, "fathomnet_concept_map")
    found = canonical(boxes.select("box_id", "label"), "label", entries, "concept")
    return found.where("_entry is null").groupBy("label").agg(F.countDistinct("box_id").alias("boxes"))
