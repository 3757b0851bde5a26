"""Personal information inside free text.

A linear-chain conditional random field over word-shape features labels every
token; Viterbi decoding runs in numpy over many lines at once. Beside its shape
a word has a class: whether public tokenizers' vocabularies hold it as a common
word, only with a capital, or not at all, which tells names from the words of a
heading without any list of names. The model is trained on the small table of
``pii_table`` by maximum likelihood when it is first needed (some seconds; the
same weights everywhere). What it finds is then checked exactly: a phone number
must have a phone number's digits, an address a number, and so on, and ends are
moved to the ends of the form they lie in.
"""

from __future__ import annotations

import base64
import hashlib
import os
import pickle
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from sparkshoal.llm import pii_table
from sparkshoal.session import table, worker_cache

KINDS = ["email", "phone", "id_number", "address", "person_name"]
LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
#: Vocabularies that tell common words (lists of base64 pieces and ranks); any number of files, those missing are passed over.
VOCABULARIES = ("/opt/tokenizers/byte_bpe_50k.tiktoken", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
PLACES, ROADS = {w.lower() for w in pii_table.GEO}, {w.lower().rstrip(".") for w in pii_table.ROAD_KIND + pii_table.ROAD_ABROAD}
FREQUENT = 6000  # pieces up to this rank are frequent words
#: A run of digit groups with what joins them, and short groups of letters beside them.
RUN = re.compile(r"(?:(?:\(\+?|\+)|(?<![^\W_])(?:[A-Z]{1,3}[ \-]?|[a-z]{2}(?=\d)|[a-z]{2} (?=\d\d \d\d \d\d ))(?=\d))?(?<!\d)\d+(?:(?:[.\-–/_ ]| [\-–/] |\) ?| ?\()\d+|[A-Z]{1,2}(?=\d)\d+| ?[A-Z]{1,2} (?=\d)\d+|-?[A-Za-z](?![^\W_]))*")
EMAIL_SPACED = re.compile(r"[\w.+%\-]*\w ?(?:[@＠]| ?[\[(]at[\])]) ?\w[\w\-]*(?:(?:\.| ?[\[(]dot[\])] ?| dot )\w[\w\-]*)+", re.I)
WINDOW, MARGIN = 4096, 64
CLOSE = 6  # no run of digit groups has more characters than these between digits, or before its first
TOKEN_OR_BREAK = re.compile(r"\n|" + TOKEN.pattern)
#: What Python counts as white space, but for the line break.
SPACES = np.array([c for c in range(0x3001) if chr(c).isspace() and c != 10], dtype=np.uint32)
OFFSETS = (0, -1, 1, -2, 2)


def shape(token: str) -> str:
    c = token[0]
    if c.isdigit():
        return f"d{min(len(token), 11)}"
    if not c.isalpha():
        return token
    if token.isupper():
        return "X" if len(token) == 1 else "XX" if len(token) < 4 else "XXX"
    if token.islower():
        return "x" if len(token) < 3 else "xxx"
    return "Xx" if token[1:].islower() else "xX"


class Lexicon:
    """Classes of words by the vocabularies of tokenizers."""

    def __init__(self, paths: Iterable[str] = VOCABULARIES) -> None:
        self.low: dict[str, int] = {}
        self.cap: dict[str, int] = {}
        self.forms: dict[str, str] = {}
        for path in paths:
            if not os.path.exists(path):
                continue
            with open(path, "rb") as f:
                for piece, rank in map(bytes.split, f):
                    word = base64.b64decode(piece).decode("utf-8", "ignore")
                    if word[:1] == " " and len(word) > 2 and word[1:].isalpha():
                        words = self.low if word[1:].islower() else self.cap if word[1].isupper() and word[2:].islower() else None
                        if words is not None:
                            words[word[1:]] = min(int(rank), words.get(word[1:], 1 << 30))

    def kind(self, token: str) -> str:
        """``g`` a kind of place, ``r`` a kind of road; ``f`` or ``c`` a frequent or common word, with ``p`` if it is more often written with a capital; ``p`` known with a capital only; ``u`` unknown."""
        if token.lower() in ROADS:
            return "r"
        if token.lower() in PLACES:
            return "g"
        low, cap = self.low.get(token.lower()), self.cap.get(token.lower().capitalize())
        if low is None:
            return "u" if cap is None else "p"
        return ("f" if low < FREQUENT else "c") + ("p" if cap is not None and cap < low else "")

    def form(self, token: str) -> str:
        """Shape of a token, with a word's class."""
        if token not in self.forms:
            if len(self.forms) > 200_000:
                self.forms.clear()
            self.forms[token] = shape(token) + (":" + self.kind(token) if token[0].isalpha() else "")
        return self.forms[token]


def own_features(token: str, lexicon: Lexicon) -> tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
    """Features a token gives itself, its neighbours, and the tokens two away."""
    low, form = token.lower(), shape(token)
    far = (f"w={low}", f"s={form}")
    if token[0].isalpha():
        far += (f"k={lexicon.form(token).split(':')[1]}", f"s+k={lexicon.form(token)}")
    near = far + ((f"e3={low[-3:]}",) if token[0].isalpha() else ())
    mine = near
    if token[0].isalpha():
        mine += (f"e2={low[-2:]}", f"e4={low[-4:]}", f"b3={low[:3]}", f"n={min(len(low), 12)}", f"s+e3={form}{low[-3:]}")
    elif token[0].isdigit():
        mine += (f"b1={token[0]}", f"b2={token[:2]}")
    return mine, near, far


def signature(run: str) -> tuple[str, str]:
    """Shape of a run of digit groups, in full and rough."""
    full = re.sub(r"\d+", lambda m: str(min(len(m.group()), 9)), re.sub(r"[A-Za-z]", "A", run)).replace("–", "-")
    digits = sum(ch.isdigit() for ch in run)
    return full, f"{digits}/{'A' in full}/{full[0] in '+('}/{''.join(sorted(set(full) - set('0123456789A')))}"


def tokens_of(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    found = [(m.group(), m.start(), m.end()) for m in TOKEN.finditer(text)]
    if not found:
        return [], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    words, starts, ends = zip(*found)
    return list(words), np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)


def run_features(text: str, words: list[str], starts: np.ndarray) -> list[tuple[int, int, tuple[str, ...]]]:
    """(first token, token after last, features) of every run of digit groups of at least five digits in a text."""
    out = []
    for m in RUN.finditer(text):
        if sum(map(str.isdigit, m.group())) < 5:
            continue
        a, b = int(np.searchsorted(starts, m.start())), int(np.searchsorted(starts, m.end()))
        full, rough = signature(m.group())
        before = [w.lower() for w in words[max(0, a - 4) : a] if w[0].isalpha()][-2:]
        left = [f"l{i}={w}" for i, w in enumerate(reversed(before))]
        out.append((a, b, (f"r={full}", f"q={rough}", *left, f"r+l={full}|{before[-1] if before else ''}")))
    return out


class Model:
    """Weights of the field: one row of label weights for each feature, transitions, and starts; and the lexicon it was trained with."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, moves: np.ndarray, first: np.ndarray, lexicon: Lexicon) -> None:
        self.index, self.weights, self.moves, self.first, self.lexicon = index, weights, moves, first, lexicon
        self.mark = hashlib.md5(weights.tobytes() + moves.tobytes() + first.tobytes()).hexdigest()

    def packed(self) -> bytes:
        """The model as bytes that travel to the workers, which read them once each."""
        return zlib.compress(pickle.dumps((self.index, self.weights, self.moves, self.first, self.lexicon.low, self.lexicon.cap)), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Model:
        *own, low, cap = pickle.loads(zlib.decompress(data))
        lexicon = Lexicon(())
        lexicon.low, lexicon.cap = low, cap
        return cls(*own, lexicon)


def _pair(before: str, form: str, glued: bool) -> str:
    return f"p|{before}|{int(glued)}|{form}"


def allowed() -> tuple[np.ndarray, np.ndarray]:
    """Which label may follow which, and which may come first: an inside label only goes on what is open."""
    moves = np.ones((len(LABELS), len(LABELS)), dtype=bool)
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            moves[:, j] = False
            moves[LABELS.index("B" + label[1:]), j] = moves[j, j] = True
    return moves, np.array([label[0] != "I" for label in LABELS])


@lru_cache(maxsize=2)
def train(copies: int = 5, epochs: int = 4, rate: float = 0.25, decay: float = 1e-4, batch: int = 64, seed: int = 7, vocabularies: tuple[str, ...] = VOCABULARIES) -> Model:
    """Maximum-likelihood weights by AdaGrad over the labelled table (``copies`` bounds its rows: under 400 lines a copy).

    Of one word in four the identity is hidden in training, so that its shape and
    its neighbours must do.
    """
    lexicon = Lexicon(vocabularies)
    hidden = re.compile(r"-?\d\|(?:w|e2|e3|e4|b3|s\+e3)=")
    numbers: dict[str, int] = {}
    number = lambda x: numbers.setdefault(x, len(numbers))

    @lru_cache(maxsize=None)
    def features(word: str) -> list[tuple[list[int], list[int]]]:
        """For each offset the word's features, and those left when its identity is hidden."""
        mine, near, far = own_features(word, lexicon)
        named = [[f"{o}|{x}" for x in (mine if o == 0 else near if abs(o) == 1 else far)] for o in OFFSETS]
        return [([number(x) for x in own], [number(x) for x in own if not hidden.match(x)]) for own in named]

    edges = [number(f"{o}|edge") for o in OFFSETS]
    rows, drop = [], np.random.default_rng(seed)
    for text, spans in pii_table.labelled(copies, seed):
        words, starts, ends = tokens_of(text)
        if not words:
            continue
        hide = (drop.random(len(words)) < 1 / 4).astype(int).tolist()
        own = [features(w) for w in words]
        forms = [lexicon.form(w) for w in words]
        feats = []
        for i in range(len(words)):
            f = list(own[i][0][hide[i]])
            for k, o in enumerate(OFFSETS[1:], 1):
                f += own[i + o][k][hide[i]] if 0 <= i + o < len(words) else [edges[k]]
            f.append(number(_pair(forms[i - 1] if i else "^", forms[i], i > 0 and starts[i] == ends[i - 1])))
            feats.append(f)
        for a, b, fs in run_features(text, words, starts):
            for i in range(a, b):
                feats[i] += [number(("F|" if i == a else "R|") + x) for x in fs]
        gold = np.zeros(len(words), dtype=np.int64)
        for a, b, kind in spans:
            inside = np.flatnonzero((starts >= a) & (starts < b))
            gold[inside] = LABELS.index("I-" + kind)
            gold[inside[:1]] = LABELS.index("B-" + kind)
        rows.append((np.array([x for f in feats for x in f], dtype=np.int64), np.array([len(f) for f in feats], dtype=np.int64), gold))
    # Features met at most twice say nothing; what is left is numbered anew.
    often = np.bincount(np.concatenate([r[0] for r in rows]), minlength=len(numbers)) > 2
    index = {x: i for i, x in enumerate(x for x, k in numbers.items() if often[k])}
    anew = np.cumsum(often) - 1
    coded = []
    for ids, per, gold in rows:
        kept = often[ids]
        coded.append((anew[ids[kept]], np.add.reduceat(kept.astype(np.int64), np.concatenate(([0], np.cumsum(per)[:-1]))), gold))
    n_labels = len(LABELS)
    ok, ok_first = allowed()
    weights, moves, first = np.zeros((len(index), n_labels), dtype=np.float32), np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    g_w, g_m, g_f = np.full((len(index), 1), 1e-3, dtype=np.float32), np.full_like(moves, 1e-3), np.full_like(first, 1e-3)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(coded))
    batches = [_batch([coded[i] for i in order[at : at + batch]], n_labels) for at in range(0, len(order), batch)]
    mean_w, mean_m, mean_f, seen = np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(first), 0
    for epoch in range(epochs):
        for k in rng.permutation(len(batches)).tolist():
            b = batches[k]
            emit = np.add.reduceat(weights[b["ids"]], b["begins"], axis=0).astype(float)
            marginal, pair, start = _expected(emit, b["lengths"], moves, first, ok, ok_first)
            d_emit = (b["hot"] - marginal).astype(np.float32)
            d_w = np.add.reduceat(d_emit[b["owner"]], b["cuts"], axis=0) - np.float32(decay * len(emit)) * weights[b["own"]]
            d_m, d_f = b["moves"] - pair, b["first"] - start
            g_w[b["own"]] += (d_w**2).mean(axis=1, keepdims=True)
            g_m += d_m**2
            g_f += d_f**2
            weights[b["own"]] += np.float32(rate) * d_w / np.sqrt(g_w[b["own"]])
            moves += rate * d_m / np.sqrt(g_m)
            first += rate * d_f / np.sqrt(g_f)
            if epoch >= epochs // 3:  # what is kept is the mean over the later steps
                seen += 1
                mean_w += weights
                mean_m += moves
                mean_f += first
    weights, moves, first = mean_w / seen, mean_m / seen, mean_f / seen
    keep = np.abs(weights).max(axis=1) > 1e-3
    names = [k for k in index if keep[index[k]]]
    return Model({k: i for i, k in enumerate(names)}, weights[keep], np.where(ok, moves, -1e9).astype(np.float32), np.where(ok_first, first, -1e9).astype(np.float32), lexicon)


def _batch(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n_labels: int) -> dict[str, np.ndarray]:
    """What the rounds of training need of a batch of chains (feature numbers, how many a token has, labels), longest first."""
    rows = sorted(rows, key=lambda r: -len(r[2]))
    lengths, ids, per, gold = np.array([len(r[2]) for r in rows]), *(np.concatenate([r[i] for r in rows]) for i in range(3))
    order = np.argsort(ids, kind="stable")
    own, cuts = np.unique(ids[order], return_index=True)
    heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    later = np.ones(len(gold), dtype=bool)
    later[heads] = False
    hot, moves = np.zeros((len(gold), n_labels)), np.zeros((n_labels, n_labels))
    hot[np.arange(len(gold)), gold] = 1
    np.add.at(moves, (gold[np.flatnonzero(later) - 1], gold[later]), 1)
    return {"lengths": lengths, "ids": ids, "begins": np.concatenate(([0], np.cumsum(per)[:-1])), "owner": np.repeat(np.arange(len(per)), per)[order], "own": own, "cuts": cuts, "hot": hot, "moves": moves, "first": np.bincount(gold[heads], minlength=n_labels).astype(float)}


def _expected(emit: np.ndarray, lengths: np.ndarray, moves: np.ndarray, first: np.ndarray, ok: np.ndarray, ok_first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label marginals, expected transitions and expected starts of a batch of chains (longest first), by scaled forward-backward."""
    n_labels, n, steps = emit.shape[1], len(lengths), int(lengths.max())
    heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    go, begin = np.where(ok, np.exp(moves), 0), np.where(ok_first, np.exp(first), 0)
    seen = np.exp(emit - emit.max(axis=1, keepdims=True))
    alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
    scale = np.zeros(len(emit))
    for t in range(steps):
        live = int(np.count_nonzero(lengths > t))
        at = heads[:live] + t
        a = (begin if t == 0 else alpha[at - 1] @ go) * seen[at]
        scale[at] = a.sum(axis=1)
        alpha[at] = a / scale[at][:, None]
    for t in range(steps - 1, -1, -1):
        live = int(np.count_nonzero(lengths > t))
        at = heads[:live] + t
        last = lengths[:live] == t + 1
        b = np.ones((live, n_labels))
        inner = ~last
        if inner.any():
            nxt = at[inner] + 1
            b[inner] = (beta[nxt] * seen[nxt] / scale[nxt][:, None]) @ go.T
        beta[at] = b
    marginal = alpha * beta
    marginal /= marginal.sum(axis=1, keepdims=True)
    later = np.ones(len(emit), dtype=bool)
    later[heads] = False
    now = np.flatnonzero(later)
    right = beta[now] * seen[now] / scale[now][:, None]
    pair = go * (alpha[now - 1].T @ right)
    return marginal, pair, marginal[heads].sum(axis=0)


class Tagger:
    """Finds spans in texts with a trained model; keeps the scores of words it has met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known = {k.split("|w=", 1)[1] for k in model.index if "|w=" in k}
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {"\n": 0}
        edge = np.zeros((5, len(LABELS)), dtype=np.float32)
        for k, o in enumerate(OFFSETS[1:], 1):
            edge[k] = self._sum([f"{o}|edge"])
        self.scores = [edge]
        self.shapes: dict[str, int] = {"^": 0}
        self.shape_of = [0]
        self.pair_scores: dict[int, np.ndarray] = {}
        self.matrix = np.zeros((0, 5, len(LABELS)), dtype=np.float32)
        self.run_scores: dict[tuple[str, ...], tuple[np.ndarray, np.ndarray]] = {}

    def _sum(self, feats: Iterable[str]) -> np.ndarray:
        own = [self.model.index[f] for f in feats if f in self.model.index]
        return self.model.weights[own].sum(axis=0) if own else np.zeros(len(LABELS), dtype=np.float32)

    def _word(self, token: str) -> int:
        if token[0].isdigit() and token not in self.known:  # numbers the table doesn't know differ by length and first digits only
            alike = f"\n{min(len(token), 11)}{token[:2]}"
            if alike in self.ids:
                self.ids[token] = self.ids[alike]
                return self.ids[token]
            self.ids[alike] = len(self.scores)
        mine, near, far = own_features(token, self.model.lexicon)
        row = np.empty((5, len(LABELS)), dtype=np.float32)
        for k, o in enumerate(OFFSETS):
            row[k] = self._sum(f"{o}|{x}" for x in (mine if o == 0 else near if abs(o) == 1 else far))
        self.scores.append(row)
        self.shape_of.append(self.shapes.setdefault(self.model.lexicon.form(token), len(self.shapes)))
        self.ids[token] = len(self.scores) - 1
        return len(self.scores) - 1

    def _emissions(self, ty: np.ndarray, glued: np.ndarray) -> np.ndarray:
        """Label scores of all tokens (word numbers, 0 between lines) from their own and their neighbours' features."""
        if len(self.matrix) != len(self.scores):
            self.matrix = np.concatenate([self.matrix, np.stack(self.scores[len(self.matrix) :])])
        emit = self.matrix[ty, 0]
        for k, o in enumerate(OFFSETS[1:], 1):
            if o < 0:
                emit[-o:] += self.matrix[ty[:o], k]
            else:
                emit[:-o] += self.matrix[ty[o:], k]
        sh = np.array(self.shape_of, dtype=np.int64)[ty]
        code = (np.concatenate(([0], sh[:-1])) * 4096 + sh) * 2 + glued
        names = list(self.shapes)
        kinds, at = np.unique(code, return_inverse=True)
        for c in kinds.tolist():
            if c not in self.pair_scores:
                self.pair_scores[c] = self._sum([_pair(names[c // 2 // 4096], names[c // 2 % 4096], c % 2)])
        emit += np.stack([self.pair_scores[c] for c in kinds.tolist()])[at]
        return emit

    def _add_runs(self, text: str, words: list[str], ty: np.ndarray, starts: np.ndarray, ends: np.ndarray, emit: np.ndarray) -> None:
        """Adds the scores of runs of digit groups to their tokens. Runs are looked for only where five digits stand close."""
        digit_shape = np.array([n[0] == "d" and n[1:].isdigit() for n in self.shapes])
        at = np.flatnonzero(digit_shape[np.array(self.shape_of)[ty]])
        if not len(at):
            return
        fresh = np.concatenate(([True], starts[at[1:]] - ends[at[:-1]] > CLOSE))
        heads = np.flatnonzero(fresh)
        digits = np.add.reduceat(ends[at] - starts[at], heads)
        tails = np.append(heads[1:], len(at)) - 1
        dense = digits > 4
        places = zip(starts[at[heads[dense]]].tolist(), ends[at[tails[dense]]].tolist())
        runs = [(m.start(), m.end(), m.group()) for a, b in places for m in RUN.finditer(text, a - CLOSE, b + CLOSE) if m.end() - m.start() > 4 and sum(map(str.isdigit, m.group())) > 4]
        if not runs:
            return
        first = np.searchsorted(starts, [r[0] for r in runs]).tolist()
        after = np.searchsorted(starts, [r[1] for r in runs]).tolist()
        for (_, _, run), a, b in zip(runs, first, after):
            before: list[str] = []
            for w in reversed(words[max(0, a - 4) : a]):
                if w == "\n":
                    break
                if w[0].isalpha() and len(before) < 2:
                    before.append(w.lower())
            full, rough = signature(run)
            feats = (f"r={full}", f"q={rough}", *[f"l{i}={w}" for i, w in enumerate(before)], f"r+l={full}|{before[0] if before else ''}")
            if feats not in self.run_scores:
                self.run_scores[feats] = (self._sum("F|" + f for f in feats), self._sum("R|" + f for f in feats))
            head, rest = self.run_scores[feats]
            emit[a] += head
            emit[a + 1 : b] += rest

    def decode(self, emit: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best label path of every chain (Viterbi), chains side by side."""
        order = np.argsort(-lengths, kind="stable")
        heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))[order]
        sizes = lengths[order]
        back = np.zeros((len(emit), len(LABELS)), dtype=np.int8)
        out = np.zeros(len(emit), dtype=np.int8)
        score = None
        final = np.zeros((len(sizes), len(LABELS)), dtype=np.float32)
        for t in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes, -t, side="left"))
            at = heads[:live] + t
            if t == 0:
                score = emit[at] + self.model.first
            else:
                step = score[:live, :, None] + self.model.moves[None]
                best = step.argmax(axis=1)
                back[at] = best
                score = np.take_along_axis(step, best[:, None, :], axis=1)[:, 0] + emit[at]
            final[:live] = score
        label = final.argmax(axis=1)
        for t in range(int(sizes.max(initial=0)) - 1, -1, -1):
            live = int(np.searchsorted(-sizes, -t, side="left"))
            at = heads[:live] + t
            out[at] = label[:live]
            label[:live] = np.where(t > 0, back[at, label[:live]], label[:live])
        return out

    def lines(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """Spans (start, end, kind) of each of several lines, as labelled by the model.

        All lines go through as one text with two breaks between them, so that
        words, places and scores are found by few calls over whole arrays.
        """
        found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        whole = "\n\n" + "\n\n".join(texts) + "\n\n"
        words = TOKEN_OR_BREAK.findall(whole)
        ids, word = self.ids, self._word
        ty = np.array([ids[w] if w in ids else word(w) for w in words], dtype=np.int64)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        solid = np.flatnonzero(~np.isin(codes, SPACES))  # tokens cover all that is no white space, in order
        last = np.cumsum(sizes)
        starts, ends = solid[last - sizes], solid[last - 1] + 1
        real = ty > 0
        if not real.any():
            return found
        glued = np.zeros(len(ty), dtype=np.int64)
        glued[1:] = (starts[1:] == ends[:-1]) & real[1:] & real[:-1]
        emit = self._emissions(ty, glued)
        self._add_runs(whole, words, ty, starts, ends, emit)
        edges = np.diff(np.concatenate(([0], real.view(np.int8), [0])))
        heads, lengths = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - np.flatnonzero(edges == 1)
        labels = np.zeros(len(ty), dtype=np.int8)
        labels[real] = self.decode(emit[real], lengths)
        begins = np.cumsum([2] + [len(t) + 2 for t in texts])  # where each line starts in the whole
        for at in np.flatnonzero(labels % 2 == 1).tolist():  # odd labels begin a span
            line = int(np.searchsorted(begins, starts[at], side="right")) - 1
            b = at
            while labels[b + 1] == labels[at] + 1:
                b += 1
            found[line].append((int(starts[at] - begins[line]), int(ends[b] - begins[line]), LABELS[labels[at]][2:]))
        return found

    def texts(self, texts: list[str], budget: int = 3_000_000) -> list[list[tuple[int, int, str]]]:
        """Checked spans of whole texts. Lines are labelled apart; a line of many tokens in windows that overlap."""
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        queue: list[tuple[int, int, int, int, str]] = []
        held = 0

        def flush() -> None:
            nonlocal queue, held
            if len(self.ids) + len(self.run_scores) > 400_000:
                self.clear()
            for (owner, base, lo, hi, _), spans in zip(queue, self.lines([q[4] for q in queue])):
                out[owner] += [(a + base, b + base, k) for a, b, k in spans if lo <= a + base < hi]
            queue, held = [], 0

        for owner, text in enumerate(texts):
            for m in re.finditer(r"[^\n]+", text):
                for base, lo, hi, piece in _windows(m.group(), m.start()):
                    queue.append((owner, base, lo, hi, piece))
                    held += len(piece)
                    if held > budget:
                        flush()
        flush()
        return [check(text, sorted(spans)) for text, spans in zip(texts, out)]


def _windows(line: str, base: int) -> Iterable[tuple[int, int, int, str]]:
    """(offset, first and after-last character whose spans count, text) of a line, whole or in windows of ``WINDOW`` tokens that overlap."""
    if len(line) <= 4 * WINDOW:
        yield base, base, base + len(line), line
        return
    starts = tokens_of(line)[1]
    step = WINDOW - 2 * MARGIN
    for a in range(0, max(1, len(starts)), step):
        lo = int(starts[a]) if a else 0
        hi = int(starts[a + step]) if a + step < len(starts) else len(line)
        left = int(starts[max(0, a - MARGIN)]) if a else 0
        right = int(starts[a + step + MARGIN]) if a + step + MARGIN < len(starts) else len(line)
        yield base + left, base + lo, base + hi, line[left:right]


TITLE = re.compile(r"(?:(?:Dr|Mr|Mrs|Ms|Mme|Mlle|M|Frau|Herr|Prof|Sr|Sra|Señora?|Doctora?|doctora?|Capt|Captain)\b\.? +)+")
_LEAD = re.compile(r"(?:(?:Flat|Unit|Apt|Apartment|Suite) \w+,? *)$", re.I)
_HOUSE = re.compile(r"(?<!\w)\d{1,4}(?: (?:bis|ter))?,? +$")
_TOWN = re.compile(r",?\n[^\W\d_]+(?:[ \-][^\W\d_]+)? \d{5}\b")


def _cut(text: str, at: int) -> bool:
    """True if a place lies inside a run of letters and digits."""
    return 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()


def _hash(text: str, at: int) -> bool:
    """True if the letters and digits that begin at a place read as a hexadecimal digest: small letters at two places or more, or between digits."""
    run = re.compile(r"[0-9a-f]{7,}(?![^\W_])").match(text, at)
    return run is not None and (len(re.findall(r"[a-f]+", run.group())) > 1 or re.fullmatch(r"\d+[a-f]+\d+", run.group()) is not None)


def check(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Exact check of labelled spans: their form must be one their kind can have, and their ends are the form's ends."""
    out: list[tuple[int, int, str]] = []
    for a, b, kind in spans:
        lo = max(text.rfind("\n", 0, a) + 1, out[-1][1] if out and out[-1][1] <= a else 0)
        hi = text.find("\n", b)
        hi = len(text) if hi < 0 else hi
        near = text[max(lo, a - 80) : min(hi, b + 80)]
        off = max(lo, a - 80)
        if kind == "email":
            m = next((m for m in EMAIL_SPACED.finditer(near) if m.start() + off < b and m.end() + off > a), None)
            if m is None:
                continue
            a, b = m.start() + off, m.end() + off
            if text[a : a + 7].lower() == "mailto:":
                a += 7
        elif kind in ("phone", "id_number"):
            m = next((m for m in RUN.finditer(near) if m.start() + off < b and m.end() + off > a), None)
            digits = sum(ch.isdigit() for ch in text[a:b])
            if m is not None and sum(map(str.isdigit, m.group())) <= 15:
                if kind == "phone":
                    a = min(a, m.start() + off)
                while a > lo and text[a - 1].isdigit():
                    a -= 1
                b = max(b, m.end() + off)
                digits = sum(ch.isdigit() for ch in text[a:b])
            while kind == "phone" and a < b and not (text[a].isdigit() or text[a] in "+("):
                a += 1
            if kind == "phone" and not 7 <= digits <= 15 or kind == "id_number" and (digits < 5 or _cut(text, a) or _hash(text, a)):
                continue
        elif kind == "address":
            m = _HOUSE.search(text[lo:a])
            if m and text[a].isalpha():
                a = lo + m.start()
            m = _LEAD.search(text[lo:a])
            if m:
                a = lo + m.start()
            if not any(ch.isdigit() for ch in text[a:b]) or sum(ch.isalpha() for ch in text[a:b]) < 3 or _cut(text, a) or _cut(text, b):
                continue
            m = _TOWN.match(text, b)
            if m:
                b = m.end()
        else:
            while a < b and not text[a].isalpha():
                a += 1
            m = TITLE.match(text, a)
            if m and len(re.findall(r"[^\W\d_]+", text[m.end() : b])) > 1:  # else the title is an initial
                a = m.end()
            if len(re.findall(r"[^\W\d_]+", text[a:b])) < 2 or any(ch.isdigit() for ch in text[a:b]) or unicodedata.category(text[b : b + 1] or " ") in ("So", "Sk", "No"):
                continue
        if out and a < out[-1][1]:
            continue
        if out and kind == "address" == out[-1][2] and not text[out[-1][1] : a].strip(" ,"):
            out[-1] = (out[-1][0], b, kind)
            continue
        out.append((a, b, kind))
    return out


def _tagging(model: Model, extra: str | None) -> Callable:
    mark, data = model.mark, model.packed()

    def run(batches):
        kept = worker_cache()
        if kept.get("pii model") != mark:
            kept["pii model"], kept["pii tagger"] = mark, Tagger(Model.unpacked(data))
        tagger = kept["pii tagger"]
        for batch in batches:
            for at in range(0, max(1, len(batch)), 4000):
                part = batch.iloc[at : at + 4000]
                texts = [t if isinstance(t, str) else "" for t in part["text"]]
                spans = tagger.texts(texts)
                if extra is None:
                    rows = [(d, k, a + 1, b + 1) for d, found in zip(part["doc_id"], spans) for a, b, k in found]
                    yield pd.DataFrame(rows, columns=["doc_id", "kind", "start_at", "end_at"])
                else:
                    done = [replaced(t, f) if isinstance(raw, str) else None for raw, t, f in zip(part["text"], texts, spans)]
                    yield pd.DataFrame({"doc_id": part["doc_id"], extra: done, "replaced": [len(f) for f in spans]})

    return run


def replaced(text: str, spans: list[tuple[int, int, str]]) -> str:
    """A text with each span replaced by a placeholder that names its kind; the rest is unchanged."""
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join([*out, text[at:]])


def occurrences(documents: DataFrame) -> DataFrame:
    """One row for each occurrence: doc_id, kind, start_at, end_at (1-based characters, end exclusive).

    Rows of one doc_id count once where their occurrences agree. Null ids and
    texts give nothing. Nothing is shuffled but the occurrences.
    """
    docs = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    return docs.mapInPandas(_tagging(train(), None), "doc_id long, kind string, start_at long, end_at long").distinct()


def redacted(documents: DataFrame) -> DataFrame:
    """Texts with personal information replaced by placeholders: doc_id, text (null stays null), replaced (how many)."""
    docs = documents.where("doc_id is not null").select("doc_id", "text")
    return docs.mapInPandas(_tagging(train(), "text"), "doc_id long, text string, replaced int")


def p9_found(spark, sf_dir: str) -> DataFrame:
    return occurrences(table(spark, sf_dir, "documents")).select("doc_id", "kind", "start_at").distinct()


def p9_redacted(spark, sf_dir: str) -> DataFrame:
    return redacted(table(spark, sf_dir, "documents"))
