"""Benchmark decontamination: prefix-filtered set join.

An item's windows are its runs of ``window`` consecutive words (a shorter
item is one window). A window occurs in a document when all its shingles do,
in place; so its rarest shingle alone is a sufficient prefix to join on.
Shingles are ordered by the number of documents that have them, counted over
the whole corpus; the join on the prefix shingle is bounded by position and
length (the window must begin and end inside the document), and what is left
is verified word by word over the window.

Results for odd input: null texts and texts without words have no words and
no spans; items without words have no window; rows repeated in either table
count once as an item, and each as a document; a null item_id takes part but
is not listed among a document's items.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bytetext as B
from .scratch import Scratch

#: The documents' shingles are tested against a bitmap of the items' shingles of this fixed size (1 MB); what it
#: lets through by chance is dropped by the join that follows.
BITMAP_BITS = 23


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))


def _ranges(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.concatenate([[0], np.cumsum(count)])
    return np.repeat(start - first[:-1], count) + np.arange(first[-1]), first


def windows(bench: DataFrame, window: int, shingle: int) -> DataFrame:
    """item_id, win_words (hashes), and for each shingle of the window its hash and offset: one row a (window, shingle)."""
    def run(batches):
        for b in batches:
            for part in B.slices(b, "text"):
                w = B.words(B.flat(part.column(1)), B.ALNUM)
                n = np.diff(w.first)
                count = np.where(n > window, n - window + 1, np.minimum(n, 1))
                start, first = _ranges(w.first[:-1], count)
                size = np.repeat(np.minimum(n, window), count)
                row = np.repeat(np.arange(part.num_rows), count)
                # shingles inside each window
                k = np.minimum(size, shingle)
                per = size - k + 1
                at, _ = _ranges(start, per)
                win = np.repeat(np.arange(len(start)), per)
                sh = _shingle(w.hashes, at, k[win])
                words, wf = _ranges(start, size)
                col = _lists(w.hashes.view(np.int64)[words], wf).take(pa.array(win))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row[win])), col, pa.array(sh.view(np.int64)), pa.array((at - start[win]).astype(np.int32))],
                    names=["item_id", "win_words", "shingle", "offset"])
    return bench.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "item_id string, win_words array<bigint>, shingle bigint, offset int")


def _shingle(h: np.ndarray, at: np.ndarray, k) -> np.ndarray:
    k = np.broadcast_to(k, at.shape)
    out = k.astype(np.uint64)
    for j in range(int(k.max()) if len(k) else 0):
        use = k > j
        out = np.where(use, B.mix(out * np.uint64(0x2545F4914F6CDD1D) + h[np.where(use, at + j, at)] + np.uint64(j)), out)
    return out


def _hit_rows(batch: pa.RecordBatch, sizes: list[int], bitmap: np.ndarray, window: int):
    w = B.words(B.flat(batch.column(2)), B.ALNUM)
    n = np.diff(w.first)
    row_of = np.repeat(np.arange(batch.num_rows), n)
    left = w.first[1:][row_of] - np.arange(len(w.hashes)) if len(row_of) else row_of
    mask = np.uint64(len(bitmap) * 8 - 1)
    pos, shs = [], []
    for k in sizes:
        at = np.flatnonzero(left >= k)
        s = _shingle(w.hashes, at, k)
        slot = s & mask
        ok = (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
        pos.append(at[ok])
        shs.append(s[ok])
    at, sh = np.concatenate(pos), np.concatenate(shs)
    order = np.argsort(at, kind="stable")
    at, sh = at[order], sh[order]
    row = row_of[at] if len(at) else at
    lo = np.maximum(at - (window - 1), w.first[row])
    hi = np.minimum(at + window, w.first[row + 1])
    ctx, cf = _ranges(lo, hi - lo)
    ids, keys = batch.column(0), batch.column(1)
    nothing = pa.nulls(batch.num_rows, pa.int32())
    yield pa.RecordBatch.from_arrays(
        [ids, keys, pa.array(n.astype(np.int64)), nothing, pa.nulls(batch.num_rows, pa.int64()), nothing, pa.nulls(batch.num_rows, pa.list_(pa.int64()))],
        names=["doc_id", "key", "n_words", "pos", "shingle", "before", "context"])
    if len(at):
        r = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [ids.take(r), keys.take(r), pa.nulls(len(at), pa.int64()), pa.array((at - w.first[row]).astype(np.int32)), pa.array(sh.view(np.int64)),
             pa.array((at - lo).astype(np.int32)), _lists(w.hashes.view(np.int64)[ctx], cf)],
            names=["doc_id", "key", "n_words", "pos", "shingle", "before", "context"])


def _bitmap(shingles: DataFrame, bits: int) -> np.ndarray:
    """2**bits bits, those of the shingles' slots set; at most 2**(bits-6) rows come to the driver, whatever the input."""
    mask = (1 << bits) - 1
    rows = shingles.select(F.col("shingle").bitwiseAND(F.lit(mask)).alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("bits")).toPandas()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["w"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out.view(np.uint8)


def contaminated_spans(docs: DataFrame, bench: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """One row a row of ``docs``(doc_id, text): doc_id, key, n_words, spans, items.

    spans: array of (begin, end) word positions, end excluded, disjoint and in
    order: the words inside any occurrence of an item's window. items: the
    item_ids (as strings) with an occurring window, sorted. key is a hash of
    doc_id and text. spans and items are null for documents without hits.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    wins = scratch.keep(windows(bench, window, shingle).distinct(), "windows")
    bitmap = spark.sparkContext.broadcast(_bitmap(wins, BITMAP_BITS))
    sizes = list(range(1, shingle + 1))  # shorter ones stand for items of so few words

    def scan(batches):
        for b in batches:
            for part in B.slices(b, "text"):
                yield from _hit_rows(part, sizes, bitmap.value, window)

    text = F.col("text").cast("string")
    scanned = scratch.keep(docs.select("doc_id", F.xxhash64("doc_id", text).alias("key"), text.alias("text")).mapInArrow(
        scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key bigint, n_words bigint, pos int, shingle bigint, before int, context array<bigint>"), "scanned")
    hits = scanned.where("pos is not null")
    df = hits.select("shingle", "key").distinct().groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))
    prefix = wins.select("win_words", "shingle", "offset").distinct().join(df, "shingle", "left").groupBy("win_words").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "shingle", "offset")).alias("p")).where("p.df > 0").select(
        "win_words", F.size("win_words").alias("len"), "p.shingle", "p.offset")
    start = F.col("before") - F.col("offset")
    found = scratch.keep(
        hits.join(prefix, "shingle").where((start >= 0) & (start + F.col("len") <= F.size("context")))
        .where(F.slice("context", start + 1, F.col("len")) == F.col("win_words"))
        .select("doc_id", "key", (F.col("pos") - F.col("offset")).alias("begin"), (F.col("pos") - F.col("offset") + F.col("len")).alias("end"), "win_words")
        .distinct(), "found")
    doc = ["doc_id", "key"]
    order = Window.partitionBy(*doc).orderBy("begin")
    ends = found.groupBy(*doc, "begin").agg(F.max("end").alias("end"))
    spans = (ends.withColumn("before", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("span", F.sum(F.when(F.col("begin") > F.col("before"), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy(*doc, "span").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
             .groupBy(*doc).agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans")))
    items = (found.select(*doc, "win_words").join(wins.select("win_words", "item_id").distinct(), "win_words")
             .groupBy(*doc).agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    d, s, i = scanned.where("pos is null").select(*doc, "n_words").alias("d"), spans.alias("s"), items.alias("i")

    def same(x: str) -> Column:
        return (F.col("d.key") == F.col(f"{x}.key")) & F.col("d.doc_id").eqNullSafe(F.col(f"{x}.doc_id"))
    return (d.join(s, same("s"), "left").join(i, same("i"), "left")
            .select("d.doc_id", "d.key", "d.n_words", "s.spans", "i.items"))
