"""Language-model scores: a gated recurrent network over words, in numpy.

Words belong to classes by their last two bytes; the output softmax is
factored into P(class | state) and P(word | class, state). The ``SHORT``
most frequent words (and the end mark) have outputs of their own; a class's
other words share one output, within which a word has the share
(c + 0.5) / (sum over them of (c + 0.5) + 0.5), c being its training count
and the last half standing for words never seen. So every text has a proper
probability, and counts of rare words are never truncated.

Counts cover all tokens of all training documents. The weights are fitted
by truncated backpropagation over the training documents where they lie:
in each round every task goes once through its share of them, the state
carried from window to window, and the tasks' weights are averaged (in two
steps, so that no task gathers more than about the square root of their
number). Scoring carries the state through each whole document.

Results for odd input: a null, empty or blank text is one end mark; rows
with a null doc_id are scored but never learnt from (crc32 of null is
null) and held_out is false; with no training documents N = V = 0 and the
untrained network scores; repeated rows are scored each.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .scratch import Scratch

#: words with outputs of their own; words whose counts are sent to every task, at most (both bounded, whatever the corpus)
SHORT, FREQUENT = 1024, 131_072
CLASSES, HIDDEN = 64, 16
#: documents scored side by side; tokens a task holds at once (besides the rest of one Arrow batch)
LANES, TOKENS_AT_ONCE = 512, 3_500_000
#: training: steps of a window, most lanes, updates aimed at for each TOKENS_AT_ONCE, and the longest run that carries
#: one state (scoring carries it through the whole document)
WINDOW, LEARN_LANES, UPDATES, RUN = 32, 768, 150, 1024
ROUNDS = (0.25, 1.0)  # the share of the training documents up to which each round goes
RATE = 0.01
UPDATE = 256  # tokens an update of the weights is made of at least
END = -0x6E0D_A11E_57EE_D00D  # hash standing for the end mark

_F = np.float32


class Vocabulary(NamedTuple):
    """Sent to every task. short/frequent: sorted hashes; slot: where a short word's output lies; first: where each class's begin."""
    short: np.ndarray
    short_slot: np.ndarray
    first: np.ndarray
    frequent: np.ndarray
    frequent_log: np.ndarray  # log10(c + 0.5)
    rest_log: np.ndarray  # by class: log10 of the sum over its other words of (c + 0.5), plus 0.5


class Tokens(NamedTuple):
    hashes: np.ndarray  # signed; END after each row's words
    cls: np.ndarray
    first: np.ndarray


def tokens(texts: pa.Array) -> Tokens:
    f = B.flat(texts)
    w = B.words(f, B.SPACED)
    n = np.diff(w.first)
    first = np.concatenate([[0], np.cumsum(n + 1)])
    h = np.full(first[-1], END, np.int64)
    c = np.full(first[-1], CLASSES, np.int32)
    at = np.arange(len(w.hashes)) + np.repeat(np.arange(len(n)), n)
    h[at] = w.hashes.view(np.int64)
    last = f.data[w.ends - 1].astype(np.uint64)
    two = np.where(w.ends - w.starts > 1, f.data[w.ends - 2], 0).astype(np.uint64)
    c[at] = (B.mix(two * np.uint64(256) + (last | np.uint64(0))) % np.uint64(CLASSES)).astype(np.int32)
    return Tokens(h, c, first)


def _at(table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    i = np.searchsorted(table, h)
    i[i == len(table)] = 0
    return i, table[i] == h


def slots(t: Tokens, v: Vocabulary) -> np.ndarray:
    """Each token's output: its own if it is a short word, its class's shared one (the class's first) otherwise."""
    i, own = _at(v.short, t.hashes)
    out = v.first[t.cls].astype(np.int32)
    out[own] = v.short_slot[i[own]]
    return out


# ---- the network -------------------------------------------------------------------------------------------------

def fresh(v: Vocabulary, slot_logits: np.ndarray, class_logits: np.ndarray) -> dict[str, np.ndarray]:
    """Starts as the unigram model: the output biases are log counts."""
    rng = np.random.default_rng(5)
    n = int(v.first[-1])
    small = lambda *s: rng.normal(0, 0.1, s).astype(_F)
    return {"x": small(n + 1, 3 * HIDDEN), "u": small(HIDDEN, 3 * HIDDEN),
            "c": np.concatenate([small(CLASSES + 1, HIDDEN), (class_logits - class_logits.max()).astype(_F)[:, None]], axis=1),
            "o": np.concatenate([small(n, HIDDEN), (slot_logits - slot_logits.max()).astype(_F)[:, None]], axis=1)}


def _step(p, inp, h):
    x, g = p["x"][inp], h @ p["u"]
    k = 2 * HIDDEN
    zr = x[:, :k] + g[:, :k]
    np.negative(zr, out=zr)
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    n = np.tanh(x[:, k:] + zr[:, HIDDEN:] * g[:, k:])
    return zr, n, g[:, k:], n + zr[:, :HIDDEN] * (h - n)


def _output(p, first, cls_of_slot, states, target, grads=None):
    """ln P of each target given its state; adds gradients (of the sum of negative ln P) if asked.

    States lie within -1 and 1 and biases at or below 0, so exp cannot overflow.
    """
    c = cls_of_slot[target]
    one = np.concatenate([states, np.ones((len(states), 1), _F)], axis=1)
    out = np.empty(len(target))
    d_states = None if grads is None else np.empty_like(states)
    for i in range(0, len(target), 2048):  # blocks that stay in cache
        s, k = one[i: i + 2048], c[i: i + 2048]
        e = s @ p["c"].T
        rows = np.arange(len(k))
        ln = e[rows, k]
        np.exp(e, out=e)
        total = e @ np.ones(e.shape[1], _F)
        out[i: i + 2048] = ln - np.log(total)
        if grads is not None:
            e *= (1 / total)[:, None]
            e[rows, k] -= 1
            grads["c"] += e.T @ s
            d_states[i: i + 2048] = e @ p["c"][:, :HIDDEN]
    order = np.argsort(c.astype(np.uint8), kind="stable")
    cut = np.searchsorted(c[order], np.arange(len(first)))
    one, near = one[order], target[order]
    got = np.zeros(len(order))
    for k in range(len(first) - 1):
        i, j, a, b = cut[k], cut[k + 1], first[k], first[k + 1]
        if i == j or b - a < 2:
            continue
        s = one[i:j]
        e = s @ p["o"][a:b].T
        r, t = np.arange(j - i), near[i:j] - a
        got[i:j] = e[r, t]
        np.exp(e, out=e)
        total = e @ np.ones(b - a, _F)
        got[i:j] -= np.log(total)
        if grads is not None:
            e *= (1 / total)[:, None]
            e[r, t] -= 1
            grads["o"][a:b] += e.T @ s
            d_states[order[i:j]] += e @ p["o"][a:b, :HIDDEN]
    out[order] += got
    return out, d_states


def _lanes(first: np.ndarray, lanes: int):
    """Whole documents dealt to lanes of about equal length: the token order, and each lane's begin and length (longest first)."""
    n = np.diff(first)
    heap = [(0, i) for i in range(lanes)]
    own: list[list[int]] = [[] for _ in range(lanes)]
    for d in np.argsort(-n, kind="stable"):
        size, i = heapq.heappop(heap)
        own[i].append(int(d))
        heapq.heappush(heap, (size + int(n[d]), i))
    own = sorted((o for o in own if o), key=lambda o: -int(n[o].sum()))
    docs = np.array([d for o in own for d in o], np.int64)
    length = np.array([int(n[o].sum()) for o in own], np.int64)
    order = np.repeat(first[docs] - np.concatenate([[0], np.cumsum(n[docs])[:-1]]), n[docs]) + np.arange(n.sum())
    return order, np.concatenate([[0], np.cumsum(length)[:-1]]), length


def _windows(target: np.ndarray, first: np.ndarray, start_mark: int, lanes: int):
    """Windows of the lanes: steps' inputs, targets (step by lane, lanes still running first), and where each token stood."""
    n = len(first) - 1
    order, begin, length = _lanes(first, min(lanes, n))
    inp = np.empty(len(target), np.int32)
    inp[1:] = target[:-1]
    inp[first[:-1]] = start_mark
    t = 0
    while t < length[0]:
        steps = []
        for s in range(t, min(t + WINDOW, int(length[0]))):
            m = int(np.searchsorted(-length, -s, side="left"))  # lanes longer than s
            steps.append(order[begin[:m] + s])
        yield steps, inp
        t += WINDOW


def score(p, v: Vocabulary, target: np.ndarray, first: np.ndarray) -> np.ndarray:
    """ln P of every token given all before it in its document."""
    out = np.zeros(len(target), np.float64)
    cls_of_slot = np.repeat(np.arange(CLASSES + 1), np.diff(v.first))
    mark = int(v.first[-1])
    h = np.zeros((LANES, HIDDEN), _F)
    states, where, size = [], [], 0
    for steps, inp in _windows(target, first, mark, LANES):
        for at in steps:
            i = inp[at]
            h = h[: len(at)] * (i != mark)[:, None]
            h = _step(p, i, h)[3]
            states.append(h)
            size += len(at)
        where += steps
        if size >= 16_384:
            at = np.concatenate(where)
            out[at] = _output(p, v.first, cls_of_slot, np.concatenate(states), target[at])[0]
            states, where, size = [], [], 0
    if size:
        at = np.concatenate(where)
        out[at] = _output(p, v.first, cls_of_slot, np.concatenate(states), target[at])[0]
    return out


class Trainer:
    def __init__(self, p, v: Vocabulary):
        self.p = {k: a.copy() for k, a in p.items()}
        self.v = v
        self.cls = np.repeat(np.arange(CLASSES + 1), np.diff(v.first))
        self.m = {k: np.zeros_like(a) for k, a in p.items()}
        self.s = {k: np.zeros_like(a) for k, a in p.items()}
        self.t = 0

    def learn(self, target: np.ndarray, first: np.ndarray) -> None:
        p, mark, k2 = self.p, int(self.v.first[-1]), 2 * HIDDEN
        lanes = int(np.clip(len(target) // (WINDOW * UPDATES), 4, LEARN_LANES))
        n = np.diff(first)
        first = np.unique(np.concatenate([first] + [first[:-1][n > r] + r for r in range(RUN, int(n.max()), RUN)]))
        h = np.zeros((lanes, HIDDEN), _F)
        grads, seen = None, 0
        for steps, inp in _windows(target, first, mark, lanes):
            kept, states = [], []
            for at in steps:
                i = inp[at]
                go = (i != mark)[:, None]
                h = h[: len(at)] * go
                zr, n, gn, new = _step(p, i, h)
                kept.append((i, go, h, zr, n, gn))
                states.append(new)
                h = new
            at = np.concatenate(steps)
            if grads is None:
                grads = {k: np.zeros_like(a) for k, a in p.items()}
            _, d_all = _output(p, self.v.first, self.cls, np.concatenate(states), target[at], grads)
            ends = np.cumsum([len(s) for s in steps])
            d_next = np.zeros((0, HIDDEN), _F)
            d_x = np.empty((len(at), 3 * HIDDEN), _F)
            for j in range(len(steps) - 1, -1, -1):
                i, go, h0, zr, n, gn = kept[j]
                m = len(i)
                d = d_all[ends[j] - m: ends[j]]
                d[: len(d_next)] += d_next
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                rest = 1 - z
                dn = d * rest
                rest *= h0 - n
                dn *= 1 - n * n
                dx = d_x[ends[j] - m: ends[j]]
                d = d * z
                np.multiply(d, rest, out=dx[:, :HIDDEN])
                dx[:, k2:] = dn
                dn *= r
                np.multiply(dn, gn * (1 - r), out=dx[:, HIDDEN:k2])
                dg = dx.copy()
                dg[:, k2:] = dn
                grads["u"] += h0.T @ dg
                d += dg @ p["u"].T
                d_next = d * go
            i = np.concatenate([k[0] for k in kept])
            order = np.argsort(i, kind="stable")
            which, begin = np.unique(i[order], return_index=True)
            grads["x"][which] += np.add.reduceat(d_x[order], begin, axis=0)
            seen += len(at)
            if seen >= UPDATE:
                self._update(grads, seen)
                grads, seen = None, 0
        if seen:
            self._update(grads, max(seen, UPDATE))

    def _update(self, grads, seen: int) -> None:
        self.t += 1
        rate = RATE * min(1.0, self.t / 20) / (1 + self.t / 400)
        for k, g in grads.items():
            g /= seen
            np.clip(g, -0.5, 0.5, out=g)
            self.m[k] += 0.1 * (g - self.m[k])
            self.s[k] += 0.01 * (g * g - self.s[k])
            self.p[k] -= rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.s[k] / (1 - 0.99 ** self.t)) + 1e-6)


def _pack(p) -> bytes:
    return b"".join(np.ascontiguousarray(p[k], _F).tobytes() for k in sorted(p))


def _unpack(raw: np.ndarray, like) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = raw[at: at + like[k].size].reshape(like[k].shape).astype(_F)
        at += like[k].size
    return out


def _gathered(batches, text: int):
    """(row numbers' batches, tokens) in runs of about TOKENS_AT_ONCE tokens, whole rows."""
    held, size = [], 0
    for b in batches:
        for part in B.slices(b, b.schema.names[text]):
            t = tokens(part.column(text))
            held.append((part, t))
            size += len(t.hashes)
            if size >= TOKENS_AT_ONCE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _joined(held, v: Vocabulary):
    target = np.concatenate([slots(t, v) for _, t in held])
    base = np.concatenate([[0], np.cumsum([len(t.hashes) for _, t in held])])
    first = np.concatenate([t.first[:-1] + base[i] for i, (_, t) in enumerate(held)] + [base[-1:]])
    return target, first


# ---- the jobs ----------------------------------------------------------------------------------------------------

def _counts(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for part in B.slices(b, "text"):
                t = tokens(part.column(0))
                h, at, n = np.unique(t.hashes, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(t.cls[at]), pa.array(n.astype(np.int64))], names=["tok", "cls", "n"])
    return docs.select("text").mapInArrow(run, "tok bigint, cls int, n bigint").groupBy("tok").agg(F.max("cls").alias("cls"), F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, most: int):
    """The words whose counts lie above the highest bound that at most ``most`` words pass, most frequent first.

    The bound comes from a histogram of counts, one row an interval of a
    64th of a doubling, so the driver gets at most some thousand rows and then
    the words themselves, however many partitions hold them. Words about the
    bound that stand in one interval are all in or all out.
    """
    interval = F.floor(F.log2(F.col("n").cast("double")) * 64).cast("int")
    bound, words = None, 0
    for r in sorted(counts.groupBy(interval.alias("i")).agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r["i"]):
        words += r["words"]
        if words > most:
            break
        bound = r["i"]
    none = F.lit(False) if bound is None else interval >= bound
    return counts.where(none).toPandas().sort_values(["n", "tok"], ascending=[False, True], ignore_index=True)


def _vocabulary(counts: DataFrame):
    top = _most_frequent(counts, FREQUENT)
    short = top[:SHORT].copy()
    if not (short["tok"] == END).any():
        short = short[: SHORT - 1].reset_index(drop=True)
        short.loc[len(short)] = [END, CLASSES, 0]
    own = counts.join(F.broadcast(counts.sparkSession.createDataFrame([(int(t),) for t in short["tok"]], "tok bigint")), "tok", "left_anti")
    rest = np.full(CLASSES + 1, 0.5)
    for r in own.groupBy("cls").agg(F.sum(F.col("n") + 0.5).alias("s")).collect():
        rest[r["cls"]] += r["s"]
    cls, tok, n = (short[c].to_numpy(np.int64) for c in ("cls", "tok", "n"))
    # a class's outputs: the shared one, then its short words; the end mark's class has no other words, but keeps the form
    order = np.lexsort((tok, cls))
    size = np.bincount(cls, minlength=CLASSES + 1) + 1
    first = np.concatenate([[0], np.cumsum(size)])
    slot = np.empty(len(tok), np.int64)
    slot[order] = np.arange(len(tok)) + cls[order] + 1
    mass = np.empty(first[-1])
    mass[first[:-1]] = rest
    mass[slot] = n + 0.5
    logits = np.log(mass)
    class_logits = np.log(np.add.reduceat(mass, first[:-1]))
    by = np.argsort(tok)
    by_f = np.argsort(top["tok"].to_numpy(np.int64))
    v = Vocabulary(tok[by].astype(np.int64), slot[by], first.astype(np.int64), top["tok"].to_numpy(np.int64)[by_f],
                   np.log10(top["n"].to_numpy(np.float64)[by_f] + 0.5), np.log10(rest))
    return v, logits, class_logits


def _sum_weights(batches):
    total, rows = None, 0
    for b in batches:
        for i in range(b.num_rows):
            w = np.frombuffer(b.column(1)[i].as_buffer(), np.float64)
            total = w.copy() if total is None else total + w
            rows += 1
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([total.tobytes()], pa.binary())], names=["task", "w"])


def _round(docs: DataFrame, v: Vocabulary, p):
    """Every task learns from its documents; the average of their weights, each by its number of tokens."""
    sc = docs.sparkSession.sparkContext
    sent = sc.broadcast((v, p))

    def run(batches):
        v, p = sent.value
        trainer, seen = Trainer(p, v), 0
        for held in _gathered(batches, 0):
            target, first = _joined(held, v)
            trainer.learn(target, first)
            seen += len(target)
        if seen:
            w = np.concatenate([[1.0], np.frombuffer(_pack(trainer.p), _F).astype(np.float64)]) * seen
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([w.tobytes()], pa.binary())], names=["task", "w"])

    each = docs.select("text").mapInArrow(run, "task bigint, w binary")
    some = each.repartition(max(1, int(docs.sparkSession.sparkContext.defaultParallelism ** 0.5) + 1)).mapInArrow(_sum_weights, "task bigint, w binary")
    got = some.repartition(1).mapInArrow(_sum_weights, "task bigint, w binary").collect()
    if not got:
        return p
    w = np.frombuffer(got[0]["w"], np.float64)
    return _unpack((w[1:] / w[0]).astype(_F), p)


def language_model_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row a row of ``docs``(doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out``: a boolean column of ``docs``; the model and the counts learn
    from rows where it is false. base_score: add-half unigram log10
    probability of the text's words and end; score: the network's.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "recurrent")
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out.alias("_out"))
    learn = docs.where("_out = false")
    counts = scratch.keep(_counts(learn), "counts")
    n_all, n_types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    v, slot_logits, class_logits = _vocabulary(counts)
    p = fresh(v, slot_logits, class_logits)
    share = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1000)) / 1000.0
    low = 0.0
    for high in ROUNDS:
        p = _round(learn.where((share >= low) & (share < high)), v, p)
        low = high
    sent = spark.sparkContext.broadcast((v, p))

    def run(batches):
        v, p = sent.value
        for held in _gathered(batches, 2):
            target, first = _joined(held, v)
            ln = score(p, v, target, first)
            done = 0
            for part, t in held:
                m = len(t.hashes)
                row = np.repeat(np.arange(part.num_rows), np.diff(t.first))
                own = target[done: done + m] != v.first[t.cls]
                s = ln[done: done + m] / np.log(10) - np.where(own, 0.0, v.rest_log[t.cls])
                done += m
                i, known = _at(v.frequent, t.hashes)
                known |= t.hashes == END  # the end mark is frequent, or never seen: then it needs no other table
                logs = np.where(known, v.frequent_log[np.minimum(i, len(v.frequent_log) - 1)] if len(v.frequent) else np.log10(0.5), 0.0)
                shared = np.where(own | ~known, 0.0, logs)  # log10(c + 0.5) also weighs a shared output's word
                rows = part.num_rows
                at = np.flatnonzero(~known)
                uniq, mult = np.unique(np.stack([row[at], t.hashes[at]]), axis=1, return_counts=True) if len(at) else (np.zeros((2, 0), np.int64), np.zeros(0, np.int64))
                off = np.searchsorted(uniq[0], np.arange(rows + 1))
                rare = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.StructArray.from_arrays(
                    [pa.array(uniq[1]), pa.array(mult.astype(np.int32))], ["tok", "m"]))
                known_n = np.bincount(row, known & ((t.hashes != END) | (len(v.frequent) > 0)), rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(3), pa.array(np.diff(t.first)), pa.array(known_n), pa.array(np.bincount(row, logs, rows)),
                     pa.array(np.bincount(row, s + shared, rows)), rare], names=["rid", "doc_id", "_out", "n_tokens", "known", "logs", "score", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = scratch.keep(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text", "_out").mapInArrow(
        run, f"rid bigint, doc_id {kind}, _out boolean, n_tokens bigint, known bigint, logs double, score double, rare array<struct<tok:bigint,m:int>>"), "scored")
    rare = scored.select("rid", F.explode("rare").alias("r")).select("rid", "r.tok", "r.m").join(counts.select("tok", "n"), "tok", "left")
    more = rare.groupBy("rid").agg(F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"),
                                   F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("more_known"))
    unit = float(np.log10(n_all + 0.5 * (n_types + 1)))
    added = F.coalesce("more", F.lit(0.0))
    return scored.drop("rare").join(more, "rid", "left").select(
        "doc_id", F.coalesce("_out", F.lit(False)).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(n_all)).cast("bigint").alias("train_tokens"), (F.col("logs") + added - F.col("n_tokens") * unit).alias("base_score"),
        (F.col("score") + added).alias("score"))
