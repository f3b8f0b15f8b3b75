"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are embedded; learned filters of ``WIDTH`` bytes run over
them with step ``STEP``. One more input channel, the echo, is 1 where the
last four bytes stood a few bytes before as well, which a filter of a few
bytes could not see. Each filter's maximum is taken over chunks of ``CHUNK``
bytes that overlap by half and cover the whole text, whatever its length;
the chunks' maxima are combined (their mean and their maximum, by filter)
into one probability.

The network is fitted on at most ``SAMPLE`` labelled documents of at most
``LONGEST`` bytes (see ``labelled``); every text is scored whole.

Results for odd input: null and empty texts are scored as one chunk of no
bytes; without labelled rows of both kinds every score is 0.5; repeated rows
are scored each; a null doc_id is scored and not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .labelled import labelled_sample

SAMPLE, LONGEST = 3000, 32_768
DIM, WIDTH, STEP, FILTERS = 7, 8, 2, 24
HALF = 256  # a chunk is two halves
CHUNK = 2 * HALF
ECHO = range(2, 25)
EPOCHS, BATCH, RATE = 6, 32, 0.01
_F = np.float32
_IN = WIDTH * (DIM + 1)


def _halves(f: B.Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and echoes of every half chunk, with the WIDTH bytes after it; and where each text's halves begin."""
    size = np.diff(f.offsets)
    count = np.maximum(-(-size // HALF), 1)
    first = np.concatenate([[0], np.cumsum(count)])
    padded = np.zeros(first[-1] * HALF + WIDTH, np.uint8)
    at = np.repeat(first[:-1] * HALF - f.offsets[:-1], size) + np.arange(len(f.data))
    padded[at] = f.data
    echo = np.zeros(len(padded), bool)
    for lag in ECHO:
        same = padded[lag:] == padded[:-lag]
        four = same[3:] & same[2:-1] & same[1:-2] & same[:-3]
        echo[lag + 3:] |= four
    echo &= padded > 0
    rows = np.lib.stride_tricks.as_strided(padded, (first[-1], HALF + WIDTH), (HALF, 1))
    marks = np.lib.stride_tricks.as_strided(echo, (first[-1], HALF + WIDTH), (HALF, 1))
    # bytes after a text's end belong to the next text
    rows, marks = rows.copy(), marks.copy()
    rows[first[1:] - 1, HALF:] = 0
    marks[first[1:] - 1, HALF:] = False
    return rows, marks, first


def _patches(p, rows, marks) -> np.ndarray:
    x = np.empty((*rows.shape, DIM + 1), _F)
    x[:, :, :DIM] = p["embed"][rows]
    x[:, :, DIM] = marks
    n, w = rows.shape[0], HALF // STEP
    s = x.strides
    return np.lib.stride_tricks.as_strided(x, (n, w, _IN), (s[0], STEP * s[1], s[2])).reshape(n * w, _IN)


def _maxima(p, rows, marks, places: bool = False):
    out = np.empty((len(rows), FILTERS), _F)
    arg = np.empty((len(rows), FILTERS), np.int32) if places else None
    for i in range(0, len(rows), 16):
        r, m = rows[i: i + 16], marks[i: i + 16]
        y = (_patches(p, r, m) @ p["filter"]).reshape(len(r), HALF // STEP, FILTERS)
        if places:
            arg[i: i + 16] = y.argmax(axis=1)
        out[i: i + 16] = y.max(axis=1)
    return out, arg


def _features(p, half: np.ndarray, first: np.ndarray):
    """Chunk activations, and by text their mean and maximum."""
    last = np.zeros(len(half), bool)
    last[first[1:] - 1] = True
    nxt = np.where(last, np.arange(len(half)), np.arange(len(half)) + 1).clip(max=len(half) - 1)
    second = half[nxt] > half
    chunk = np.tanh(np.maximum(half, half[nxt]) + p["bias"])
    n = np.diff(first)
    mean = np.add.reduceat(chunk, first[:-1], axis=0) / n[:, None]
    top = np.maximum.reduceat(chunk, first[:-1], axis=0)
    return chunk, nxt, second, np.concatenate([mean, top], axis=1)


def probabilities(p, f: B.Flat) -> np.ndarray:
    rows, marks, first = _halves(f)
    half, _ = _maxima(p, rows, marks)
    feats = _features(p, half, first)[3]
    return 1 / (1 + np.exp(-(feats @ p["out"] + p["out_bias"]).astype(np.float64)))


def _gradients(p, f: B.Flat, y: np.ndarray):
    rows, marks, first = _halves(f)
    half, arg = _maxima(p, rows, marks, places=True)
    chunk, nxt, second, feats = _features(p, half, first)
    d = ((1 / (1 + np.exp(-(feats @ p["out"] + p["out_bias"])))) - y).astype(_F) / len(y)
    g = {"out": feats.T @ d + 1e-4 * p["out"], "out_bias": np.array([d.sum()], _F)}
    n = np.diff(first)
    text = np.repeat(np.arange(len(y)), n)
    df = d[:, None] * p["out"][None, :]
    dc = (df[:, :FILTERS] / n[:, None])[text]
    top = feats[:, FILTERS:]
    dc += np.where(chunk == top[text], df[:, FILTERS:][text], 0)
    dc *= 1 - chunk ** 2
    g["bias"] = dc.sum(axis=0)
    dh = np.where(second, 0, dc)
    np.add.at(dh, nxt, np.where(second, dc, 0))
    # only the places of the maxima have a gradient
    h, k = np.nonzero(dh)
    w = dh[h, k]
    at = arg[h, k] * STEP
    span = at[:, None] + np.arange(WIDTH)
    b, m = rows[h[:, None], span], marks[h[:, None], span]
    x = np.concatenate([p["embed"][b], m[:, :, None].astype(_F)], axis=2).reshape(len(h), _IN)
    one = np.zeros((len(h), FILTERS), _F)
    one[np.arange(len(h)), k] = w
    g["filter"] = x.T @ one
    back = (w[:, None] * p["filter"].T[k]).reshape(len(h), WIDTH, DIM + 1)[:, :, :DIM]
    g["embed"] = np.stack([np.bincount(b.ravel(), back[:, :, c].ravel(), 256) for c in range(DIM)], axis=1).astype(_F)
    return g


def fit(sample: list[tuple[bytes, int]]) -> dict[str, np.ndarray] | None:
    """None where a label is missing."""
    if len({y for _, y in sample}) < 2:
        return None
    rng = np.random.default_rng(9)
    p = {"embed": rng.normal(0, 0.5, (256, DIM)).astype(_F), "filter": rng.normal(0, 0.25, (_IN, FILTERS)).astype(_F),
         "bias": np.full(FILTERS, -1.0, _F), "out": np.zeros(2 * FILTERS, _F), "out_bias": np.zeros(1, _F)}
    m = {k: np.zeros_like(a) for k, a in p.items()}
    s = {k: np.zeros_like(a) for k, a in p.items()}
    t, steps = 0, EPOCHS * -(-len(sample) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(sample))
        for i in range(0, len(order), BATCH):
            part = [sample[j] for j in order[i: i + BATCH]]
            f = B.flat(pa.array([x.decode("utf-8", "replace") for x, _ in part]))
            t += 1
            for k, g in _gradients(p, f, np.array([y for _, y in part], _F)).items():
                m[k] += 0.1 * (g - m[k])
                s[k] += 0.01 * (g * g - s[k])
                p[k] = p[k] - RATE * (1 - t / (steps + 1)) * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.99 ** t)) + 1e-7)
    return {k: a.astype(_F) for k, a in p.items()}


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.3) -> DataFrame:
    """One row a row of ``docs``(doc_id, text): doc_id, held_out, score, predicted.

    Learns from ``labels``(doc_id, quality) where ``held_out`` (over doc_id) is false.
    """
    p = fit(labelled_sample(docs, labels, "quality", ~held_out, SAMPLE, LONGEST))
    sent = docs.sparkSession.sparkContext.broadcast(p)

    def run(batches):
        p = sent.value
        for b in batches:
            for part in B.slices(b, "text", 1 << 20):
                score = np.full(part.num_rows, 0.5) if p is None else probabilities(p, B.flat(part.column(2)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score)], names=["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
