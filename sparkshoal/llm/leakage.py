"""Evaluation texts leaking into training text.

Every passage of ``words`` consecutive words of a test item is looked for with an
error budget of k edits. A passage is cut into k + 1 pieces; k edits leave at
least one piece whole (pigeonhole), so an Aho-Corasick automaton over all pieces
finds every candidate exactly, and Myers' bit-parallel recurrence gives the edit
distance of the passage to the text around the hit. Letter case and all that
stands between words make no difference.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkshoal.session import table

WORD = re.compile(r"[^\W_]+")
HELD = 64_000_000  # characters of documents a task holds while it goes through the shards
RESULT = "doc_id long, item_id long, distance int, passages int"


def plain(text: str) -> str:
    """Lower-case words of a text with one space around each."""
    return " " + " ".join(WORD.findall(text.lower())) + " "


def passages(text: str, words: int) -> list[str]:
    own = WORD.findall(text.lower())
    return list(dict.fromkeys(" " + " ".join(own[i : i + words]) + " " for i in range(len(own) - words + 1)))


def pieces(passage: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 pieces of a passage with their places."""
    n = min(errors + 1, len(passage))
    cuts = [len(passage) * i // n for i in range(n + 1)]
    return [(a, passage[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        out[ch] = out.get(ch, 0) | 1 << i
    return out


def nearest(pattern: str, peq: dict[str, int], text: str) -> int:
    """Least edit distance of ``pattern`` to any part of ``text`` (Myers 1999, on integers of any length)."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for ch in text:
        eq = peq.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = ph << 1 & full, mh << 1 & full
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv
        best = min(best, score)
    return best


def _bag(text: str) -> np.ndarray:
    """How often each byte occurs in a text."""
    return np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)


def _automaton(items: list[tuple[int, str]], words: int, errors: int) -> Callable[[list[tuple[int, str]]], list[tuple]]:
    """A search for the passages of some items: takes documents (id, plain words), gives rows of ``RESULT``."""
    import ahocorasick

    owners: dict[str, list[int]] = {}
    for item, text in items:
        for p in passages(text, words):
            owners.setdefault(p, []).append(item)
    texts = list(owners)
    at: dict[str, list[tuple[int, int]]] = {}
    for k, p in enumerate(texts):
        for place, piece in pieces(p, errors):
            at.setdefault(piece, []).append((k, place))
    automaton = ahocorasick.Automaton()
    for piece, where in at.items():
        automaton.add_word(piece, (len(piece), where))
    if at:
        automaton.make_automaton()
    peq, bags = [masks(p) for p in texts], [_bag(p) for p in texts]
    slack = [errors if p.isascii() else 4 * errors for p in texts]  # an edit changes at most four bytes

    def search(docs: list[tuple[int, str]]) -> list[tuple]:
        rows = []
        for doc, body in docs:
            if not at:
                break
            best: dict[int, int] = {}
            tried: set[tuple[int, int]] = set()
            for end, (size, where) in automaton.iter(body):
                start = end - size + 1
                for k, place in where:
                    if best.get(k) == 0:
                        continue
                    lo = start - place
                    if (k, lo) in tried:  # another piece of the passage led here
                        continue
                    tried.add((k, lo))
                    around = body[max(0, lo - errors) : max(0, lo) + len(texts[k]) + errors]
                    if texts[k] in around:
                        d = 0
                    elif np.maximum(bags[k] - _bag(around), 0).sum() > slack[k]:  # more letters are missing than edits could supply
                        continue
                    else:
                        d = nearest(texts[k], peq[k], around)
                    if d <= errors:
                        best[k] = min(d, best.get(k, d))
            found: dict[int, list[int]] = {}
            for k, d in best.items():
                for item in owners[texts[k]]:
                    found.setdefault(item, []).append(d)
            rows += [(doc, item, min(ds), len(ds)) for item, ds in found.items()]
        return rows

    return search


def _finder(shards: list[list[tuple[int, str]]], words: int, errors: int, held: int = HELD) -> Callable:
    """Documents are read once: those held at a time meet the automaton of one shard after the other."""

    def run(batches):
        kept = [_automaton(shards[0], words, errors)] if len(shards) == 1 else None
        docs, size = [], 0

        def searched():
            for k in range(len(shards)):
                rows = (kept[k] if kept else _automaton(shards[k], words, errors))(docs)
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "passages"])

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                if isinstance(text, str):
                    docs.append((doc, plain(text)))
                    size += len(docs[-1][1])
                if size > (held if kept is None else held // 16):
                    yield from searched()
                    docs, size = [], 0
        if docs:
            yield from searched()

    return run


def leaks(documents: DataFrame, items: DataFrame, words: int = 8, errors: int = 2, shard_chars: int = 1_000_000, scan_chars: int = 128_000_000) -> DataFrame:
    """Documents that hold a passage of ``words`` words of an item within ``errors`` edits.

    ``documents``: doc_id, text; ``items``: item_id, text; whole texts are
    searched. Items are taken in shards of about ``shard_chars`` characters, each
    of which makes an automaton of some hundred megabytes; a task holds one at a
    time and takes the documents it has in memory through one after the other,
    so the corpus is read once for all shards. Only items of more than
    ``scan_chars`` together, which no task should hold, ask for another scan.
    The result doesn't depend on either. Rows of one doc_id or item_id count once.
    Null ids and texts, and items of fewer words, give nothing. Result: doc_id,
    item_id, distance (of the nearest passage), passages (how many were found).
    """
    known = items.where("item_id is not null and text is not null").select("item_id", "text")
    chars = known.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    scans = max(1, -(-chars // scan_chars))
    docs = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    out = None
    for k in range(scans):
        own = sorted((r.item_id, r.text) for r in known.where(F.pmod(F.xxhash64("item_id"), F.lit(scans)) == k).collect())  # at most about scan_chars
        cut, size = [[]], 0
        for item in own:
            if size > shard_chars:
                cut.append([])
                size = 0
            cut[-1].append(item)
            size += len(item[1])
        part = docs.mapInPandas(_finder(cut, words, errors), RESULT)
        out = part if out is None else out.unionByName(part)
    return out.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"), F.max("passages").alias("passages"))


def p7_found(spark, sf_dir: str) -> DataFrame:
    # The exact check: distance 0 means the words themselves, spaces included.
    return p7_leaks(spark, sf_dir).where("distance = 0").select("doc_id", "item_id")


def p7_leaks(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
