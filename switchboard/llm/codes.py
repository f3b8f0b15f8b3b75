"""Vector code compression: product codes, assigned with LAESA pivots.

A vector's components become integers floor(4096 x) and are cut into ``PARTS``
equal parts; each part position has a codebook of at most ``ENTRIES`` entries,
refined in ``ROUNDS`` rounds. Which entry is nearest is found as LAESA does:
every part's distances to the position's fixed pivots (``PIVOTS`` of the first
codebook's entries, each the farthest from those before it) are computed once
and kept. In a round |d(part, pivot) - d(pivot, entry)| is a lower bound of
d(part, entry); entries are taken in the order of their largest bound, and a
part is done with when its next bound exceeds its best exact distance. Exact
distances are squared Euclidean in 64-bit integers. Bounds are doubles, so a
slack covers their rounding: pruning never changes an assignment.

A task adds up its parts by (position, entry) and hands on at most
PARTS * ENTRIES sums; only the codebooks (of fixed size) come to the driver.

Results for odd input: rows whose vector is null, or holds null or non-finite
components, are left out. The width is that of the first codebook's smallest
vec_id (ties: the smallest vector); a kept vector of another width, and every
vector where the width is 0 or no multiple of PARTS, has null code and error.
Integers beyond +-``_limit(width)`` (over 30,000 times the usual component)
count as that limit, so that no sum of squares leaves 64 bits. Null vec_ids are
coded and seed no codebook; rows of one vec_id are rows of their own (seeds go by
vec_id, then by their integers). Fewer than ENTRIES rows make fewer entries. An empty
table gives no rows. Other columns are passed through; the results' names
``code``, ``error``, ``label_error`` and ``codebooks_sha256`` replace input columns.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import Scratch

SCALE, PARTS, ENTRIES, ROUNDS, PIVOTS = 4096, 8, 16, 6, 4
#: rows compared at once; shares of a label when its errors are joined back
ROWS_AT_ONCE, SHARES = 16_384, 16


def _limit(width: int) -> int:
    """The largest magnitude whose squared differences over ``width`` components sum to less than 2**62."""
    return math.isqrt((1 << 62) // max(width, 1)) // 2


def _floor(x: Column) -> Column:
    return F.floor(F.least(F.greatest(F.lit(float(SCALE)) * x, F.lit(-2.0 ** 52)), F.lit(2.0 ** 52))).cast("bigint")


def _choose_pivots(entries: np.ndarray) -> np.ndarray:
    """Of one position's first entries: the first, then each time the farthest from those chosen."""
    chosen = [0]
    gap = ((entries - entries[0]) ** 2).sum(axis=1)
    while len(chosen) < min(PIVOTS, len(entries)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((entries - entries[chosen[-1]]) ** 2).sum(axis=1))
    return entries[chosen]


def _distances(parts: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances as doubles, rows x others."""
    return np.sqrt(((parts[:, None, :] - others[None, :, :]) ** 2).sum(axis=2).astype(np.float64))


def nearest_entries(parts: np.ndarray, to_pivots: np.ndarray, pivots: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each part's nearest entry (ties: the lower index), its squared distance, and how many exact distances that took."""
    n = len(parts)
    bound = np.abs(to_pivots[:, :, None] - _distances(pivots, entries)[None, :, :]).max(axis=1)
    order = np.argsort(bound, axis=1, kind="stable")
    best, at, spent = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64), 0
    left = np.arange(n)
    for k in range(len(entries)):
        e = order[left, k]
        low = bound[left, e] * (1 - 1e-9) - 1e-6  # doubles are off by far less
        go = np.maximum(low, 0) ** 2 <= best[left]  # an equal distance may belong to a lower index
        left, e = left[go], e[go]
        if not len(left):
            break
        exact = ((parts[left] - entries[e]) ** 2).sum(axis=1)
        spent += len(left)
        better = (exact < best[left]) | ((exact == best[left]) & (e < at[left]))
        best[left[better]], at[left[better]] = exact[better], e[better]
    return at, best, spent


def _matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), width)


def _prepare(width: int, pivots: list[np.ndarray]):
    """Adds to each row its clipped integers and its parts' distances to their pivots."""
    size, limit = width // PARTS, _limit(width)

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, ROWS_AT_ONCE):
                part = b.slice(i, ROWS_AT_ONCE)
                at = part.schema.get_field_index("_q")
                q = np.clip(_matrix(part.column(at), width, np.int64), -limit, limit)
                far = np.concatenate([_distances(q[:, p * size:(p + 1) * size], pivots[p]) for p in range(PARTS)], axis=1)
                cols = [c for k, c in enumerate(part.columns) if k != at]
                names = [n for n in part.schema.names if n != "_q"]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(list(q), pa.list_(pa.int64())), pa.array(list(far), pa.list_(pa.float64()))], names=[*names, "_q", "_far"])
    return run


def _assigned(b: pa.RecordBatch, width: int, pivots: list[np.ndarray], books: list[np.ndarray]):
    """(integers, entries by position, squared distances by position) of a batch."""
    size = width // PARTS
    q = _matrix(b.column(b.schema.get_field_index("_q")), width, np.int64)
    far = _matrix(b.column(b.schema.get_field_index("_far")), sum(len(p) for p in pivots), np.float64)
    at, best, lo = [], [], 0
    for p in range(PARTS):
        a, d, _ = nearest_entries(q[:, p * size:(p + 1) * size], far[:, lo: lo + len(pivots[p])], pivots[p], books[p])
        at.append(a)
        best.append(d)
        lo += len(pivots[p])
    return q, np.stack(at, axis=1), np.stack(best, axis=1)


def _sums(width: int, pivots: list[np.ndarray], sent):
    size = width // PARTS

    def run(batches):
        books = sent.value
        n = np.zeros((PARTS, ENTRIES), np.int64)
        total = np.zeros((PARTS, ENTRIES, size), np.int64)
        for b in batches:
            for i in range(0, b.num_rows, ROWS_AT_ONCE):
                q, at, _ = _assigned(b.slice(i, ROWS_AT_ONCE), width, pivots, books)
                for p in range(PARTS):
                    n[p] += np.bincount(at[:, p], minlength=ENTRIES)
                    np.add.at(total[p], at[:, p], q[:, p * size:(p + 1) * size])
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(n[p, e]),
                                          pa.array(list(total[p, e]), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])
    return run


def _codes(width: int, pivots: list[np.ndarray], sent):
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, ROWS_AT_ONCE):
                part = b.slice(i, ROWS_AT_ONCE)
                _, at, best = _assigned(part, width, pivots, sent.value)
                code = ["".join(f"{x:02x}" for x in row) for row in at.tolist()]
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("_row")), pa.array(code, pa.string()), pa.array(best.sum(axis=1))],
                                                 names=["_row", "code", "error"])
    return run


def _refined(kept: DataFrame, width: int, pivots: list[np.ndarray], books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: the floors of the means of the parts that each entry is nearest to."""
    size = width // PARTS
    sent = kept.sparkSession.sparkContext.broadcast(books)
    sums = kept.select("_q", "_far").mapInArrow(_sums(width, pivots, sent), "part int, entry int, n bigint, total array<bigint>")
    # a sum over very many rows may leave 64 bits
    wide = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    new = [b.copy() for b in books]
    for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *wide).collect():  # at most PARTS * ENTRIES rows
        new[r["part"]][r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(size)]
    sent.unpersist()
    return new


def compressed_codes(vectors: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """(the kept rows of ``vectors``(vec_id, embedding, label, ...) with code, error, label_error and codebooks_sha256, the final codebooks by position).

    ``label_error`` is the error summed over the rows of the same label, nulls together.
    """
    scratch = Scratch(vectors.sparkSession, "codes")
    spark = vectors.sparkSession
    own = ("code", "error", "label_error", "codebooks_sha256")
    rest = [c for c in vectors.columns if c not in own]
    e = F.col("embedding").cast("array<double>")
    sound = F.col("embedding").isNotNull() & F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.where(sound).select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"), F.transform(e, _floor).alias("_q"))
    first = rows.where("_row.vec_id is not null").orderBy("_row.vec_id", "_q").limit(1).collect()
    width = len(first[0]["_q"]) if first else 0
    out = T.StructType([rows.schema["_row"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    books: list[np.ndarray] = []
    if width and width % PARTS == 0:
        size, limit = width // PARTS, _limit(width)
        # a top-k by (vec_id, integers): ENTRIES rows from each task at most
        seeds = rows.where((F.size("_q") == width) & F.col("_row.vec_id").isNotNull()).orderBy("_row.vec_id", "_q").limit(ENTRIES).select("_q").collect()
        start = np.clip(np.array([r["_q"] for r in seeds], np.int64), -limit, limit)
        books = [start[:, p * size:(p + 1) * size].copy() for p in range(PARTS)]
        pivots = [_choose_pivots(b) for b in books]
        schema = T.StructType([rows.schema["_row"], T.StructField("_q", T.ArrayType(T.LongType())), T.StructField("_far", T.ArrayType(T.DoubleType()))])
        kept = scratch.keep(rows.where(F.size("_q") == width).mapInArrow(_prepare(width, pivots), schema), "parts")
        for _ in range(ROUNDS):
            books = _refined(kept, width, pivots, books)
        sent = spark.sparkContext.broadcast(books)
        coded = kept.select("_row", "_q", "_far").mapInArrow(_codes(width, pivots, sent), out)
        coded = coded.unionByName(rows.where(F.size("_q") != width).select("_row", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error")))
    else:
        coded = rows.select("_row", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    coded = scratch.keep(coded, "coded")
    digest = hashlib.sha256(",".join(str(int(x)) for b in books for entry in b for x in entry).encode()).hexdigest()
    sums = coded.groupBy(F.col("_row.label").alias("_label")).agg(F.sum("error").alias("label_error"))
    # a label may hold a third of all rows: its rows go to SHARES keys
    sums = sums.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    dealt = coded.withColumn("_share", F.pmod(F.xxhash64("code", "_row.vec_id"), F.lit(SHARES)).cast("int"))
    joined = dealt.join(sums, (dealt["_share"] == sums["_share"]) & dealt["_row.label"].eqNullSafe(sums["_label"]))
    return joined.select("_row.*", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")), books
