"""Toxicity: a linear classifier with counterfactual regularisation, in numpy.

A document's features are the hashed words and four- and five-byte pieces of
words that occur in it (present or not). Labelled sentences that name an identity
group are also taken with the term swapped for another group's; the squared
change of the score is penalised, so that the mention as such moves no
score. An L1 penalty leaves a few thousand weights at most.

Fitted on at most ``SAMPLE`` labelled documents of at most ``LONGEST`` bytes;
every text is scored whole.

Results for odd input: null, empty and blank texts have no feature and get
the model's base score; without labelled rows of both kinds every score is 0;
repeated rows are scored each; a null doc_id is scored and not held out; a
text of any length is scored whole; a score at the threshold is toxic; other
columns, whatever their names, are passed through.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bytetext as B
from .labelled import labelled_sample

SAMPLE, LONGEST = 4000, 65_536
SLOTS, PIECES = 1 << 20, (4, 5)
#: bytes of text whose features are made at once on the driver
AT_ONCE = 1 << 20
LEAST_DOCS, LEAST_CHI2, STEPS, L1, FAIR = 4, 12.0, 800, 1e-4, 1.0

# Identity terms by language, each list of one kind of word so that swapped sentences stay well-formed.
IDENTITY = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "african", "european", "american", "arab", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("man", "woman"), ("men", "women"), ("boy", "girl"), ("male", "female"), ("he", "she"),
    ("immigrant", "refugee", "foreigner", "native"), ("immigrants", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled"), ("old", "young"),
    ("christ", "muslim", "jude", "hindu", "buddhist"), ("frau", "mann"), ("frauen", "männer"),
    ("chrétien", "musulman", "juif", "hindou", "bouddhiste"), ("femme", "homme"), ("femmes", "hommes"),
    ("cristiano", "musulmán", "judío", "hindú", "budista"), ("mujer", "hombre"), ("mujeres", "hombres"),
)
_SWAP = {w: tuple(x for x in group if x != w) for group in reversed(IDENTITY) for w in group}
_TERM = re.compile(r"(?<!\w)(" + "|".join(sorted(_SWAP, key=len, reverse=True)) + r")(?!\w)", re.IGNORECASE)
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")


def features(f: B.Flat) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every word and word piece, repeated ones too."""
    w = B.words(f, B.ALNUM)
    rows = [np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))]
    slots = [(w.hashes % np.uint64(SLOTS)).astype(np.int64)]
    n = len(f.data)
    low, inside = B._LOWER[f.data], B.ALNUM[f.data]
    for size in PIECES:
        if n < size:
            continue
        v = np.full(n - size + 1, np.uint64(size) << np.uint64(56), np.uint64)
        ok = np.ones(n - size + 1, bool)
        for j in range(size):
            v |= low[j: n - size + 1 + j].astype(np.uint64) << np.uint64(8 * j)
            ok &= inside[j: n - size + 1 + j]
        at = np.flatnonzero(ok)
        row = np.searchsorted(f.offsets, at, side="right") - 1
        same = at + size <= f.offsets[row + 1]
        at, row = at[same], row[same]
        rows.append(row)
        slots.append((B.mix(v[at]) % np.uint64(SLOTS)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(slots)


def _present(f: B.Flat, index: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature); features are slots, or their numbers in ``index`` (-1: none)."""
    row, slot = features(f)
    if index is not None:
        slot = index[slot]
        row, slot = row[slot >= 0], slot[slot >= 0]
    pair = np.unique(row * SLOTS + slot)
    return pair // SLOTS, pair % SLOTS


def _swapped(text: str) -> list[tuple[str, str]]:
    """Sentences that name a group, each with the sentence that names another."""
    out = []
    for s in _SENTENCE.findall(text):
        if _TERM.search(s):
            others = max(len(_SWAP[t.lower()]) for t in _TERM.findall(s))
            for i in range(others):
                out.append((s, _TERM.sub(lambda m: _SWAP[m[1].lower()][i % len(_SWAP[m[1].lower()])], s)))
    return out


def _in_turn(texts: list[bytes]):
    """(first number, texts) in runs of about ``AT_ONCE`` bytes: features take tens of bytes a byte of text."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= AT_ONCE):
            size += len(texts[j])
            j += 1
        yield i, texts[i:j]
        i = j


class _Pairs:
    """The swapped sentences' features: a pair that is there n times is held once, with weight n."""

    def __init__(self, index: np.ndarray):
        self.index, self.number, self.weight, self.parts = index, {}, [], []
        self.waiting: list[tuple[str, str]] = []
        self.size = 0

    def add(self, text: str) -> None:
        for pair in _swapped(text):
            key = blake2b("\0".join(pair).encode(), digest_size=16).digest()
            at = self.number.setdefault(key, len(self.weight))
            if at < len(self.weight):
                self.weight[at] += 1
                continue
            self.weight.append(1)
            self.waiting.append(pair)
            self.size += 2 * len(pair[0])
            if self.size > AT_ONCE:
                self._take()

    def _take(self) -> None:
        first = len(self.weight) - len(self.waiting)
        for side, sign in ((0, -1.0), (1, 1.0)):
            row, col = _present(B.flat(pa.array([p[side] for p in self.waiting])), self.index)
            self.parts.append((row + first, col, np.full(len(row), sign)))
        self.waiting, self.size = [], 0

    def arrays(self):
        """(pair, feature, -1 of the sentence or 1 of the swapped one, weight of each pair)"""
        if self.waiting:
            self._take()
        row, col, sign = (np.concatenate(x) for x in zip(*self.parts))
        return row, col, sign, np.array(self.weight, np.float64)


def fit(sample: list[tuple[bytes, int]]):
    """(slots, weights, bias), None where a label is missing.

    Two passes over the texts, a run at a time: counts of each slot choose the
    features, then only these are kept.
    """
    y = np.array([v for _, v in sample], np.float64)
    if len(set(y.tolist())) < 2:
        return None
    texts = [t for t, _ in sample]
    a, both, terms = np.zeros(SLOTS), np.zeros(SLOTS), set()
    for i, part in _in_turn(texts):
        r, c = _present(B.flat(pa.array([t.decode("utf-8", "replace") for t in part])), None)
        a += np.bincount(c, y[i + r], SLOTS)
        both += np.bincount(c, minlength=SLOTS)
        for t in part:
            terms.update(_TERM.findall(t.decode("utf-8", "replace")))
    b = both - a
    pos, neg = y.sum(), (1 - y).sum()
    total = pos + neg
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = total * (a * (neg - b) - b * (pos - a)) ** 2 / (pos * neg * both * (total - both))
    chosen = np.flatnonzero((both >= min(LEAST_DOCS, pos)) & ~(chi2 < LEAST_CHI2) & (both < total))
    if terms:  # the terms' own features stay in, so that the penalty can act on them
        terms |= {x for t in terms for x in _SWAP[t.lower()]}
        chosen = np.union1d(chosen, np.unique(_present(B.flat(pa.array(sorted(terms))), None)[1]))
    index = np.full(SLOTS, -1, np.int64)
    index[chosen] = np.arange(len(chosen))
    held, swaps = [], _Pairs(index)
    for i, part in _in_turn(texts):
        r, c = _present(B.flat(pa.array([t.decode("utf-8", "replace") for t in part])), index)
        held.append((r + i, c))
        for t in part:
            swaps.add(t.decode("utf-8", "replace"))
    rows, cols = (np.concatenate(x) for x in zip(*held))
    weight = np.where(y == 1, 0.5 / pos, 0.5 / neg)
    pairs = bool(swaps.weight)
    if pairs:
        prow, pcol, sign, times = swaps.arrays()
        times /= times.sum()
    n = len(chosen)
    w, bias, v, vb, t = np.zeros(n), 0.0, np.zeros(n), 0.0, 1.0

    def curve(x: np.ndarray, x0: float) -> tuple[np.ndarray, float]:
        """The loss's largest curvature, applied to a direction."""
        s = 0.25 * weight * (np.bincount(rows, x[cols], len(y)) + x0)
        out = np.bincount(cols, s[rows], n)
        if pairs:
            out = out + FAIR * np.bincount(pcol, sign * (times * np.bincount(prow, sign * x[pcol], len(times)))[prow], n)
        return out, s.sum()
    d, d0 = np.ones(n), 1.0
    for _ in range(30):  # power iteration
        size = (d @ d + d0 * d0) ** 0.5
        d, d0 = curve(d / size, d0 / size)
    step = 1 / (1.1 * (d @ d + d0 * d0) ** 0.5)
    for _ in range(STEPS):  # accelerated proximal gradient
        s = np.bincount(rows, v[cols], len(y)) + vb
        d = weight * (1 / (1 + np.exp(-s)) - y)
        g, gb = np.bincount(cols, d[rows], n), d.sum()
        if pairs:
            change = times * np.bincount(prow, sign * v[pcol], len(times))
            g = g + FAIR * np.bincount(pcol, sign * change[prow], n)
        new = v - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0)
        new_b = vb - step * gb
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - bias)
        w, bias, t = new, new_b, t2
    used = np.flatnonzero(w)
    return chosen[used], w[used], bias


def scores(model, f: B.Flat) -> np.ndarray:
    index, weights, bias = model
    row, k = _present(f, index)
    s = np.bincount(row, weights[k], len(f.offsets) - 1) + bias
    return 1 / (1 + np.exp(-s))


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``(doc_id, text, ...) with all their columns, and _held_out, _score, _predicted (which replace
    columns of these names).

    Learns from ``labels``(doc_id, toxic) where ``held_out`` (over doc_id) is false.
    """
    model = fit(labelled_sample(docs, labels, "toxic", ~held_out, SAMPLE, LONGEST))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    own = ("_held_out", "_score", "_predicted")
    carried = [c for c in docs.columns if c not in own]
    beside = [c for c in carried if c != "text"]
    taken = docs.select(F.struct(*[F.col(f"`{c}`") for c in beside]).alias("_row"), F.col("text").cast("string").alias("text"),
                        F.coalesce(held_out, F.lit(False)).alias("_held_out"))

    def run(batches):
        m = sent.value
        if m is not None:
            index = np.full(SLOTS, -1, np.int64)
            index[m[0]] = np.arange(len(m[0]))
            m = (index, m[1], m[2])
        for b in batches:
            for part in B.slices(b, "text"):
                score = np.zeros(part.num_rows) if m is None else scores(m, B.flat(part.column(part.schema.get_field_index("text"))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*part.schema.names, "_score"])

    schema = T.StructType([*taken.schema.fields, T.StructField("_score", T.DoubleType())])
    return taken.mapInArrow(run, schema).select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in carried],
                                                "_held_out", "_score", (F.col("_score") >= threshold).cast("int").alias("_predicted"))
