"""Words of whole Arrow text columns as 64-bit hashes, without a Python object per word.

Texts are taken as UTF-8 bytes. All word rules here are given by classes of
single ASCII bytes (bytes of other characters belong to words), so a byte
table decides where words begin and end. A word's hash is a polynomial of
its lower-cased bytes modulo 2**64, mixed; equal words have equal hashes,
different words differ but for chance (2**-64 a pair).
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 18


def _byte_class(pred) -> np.ndarray:
    return np.array([pred(b) for b in range(256)], dtype=bool)


#: words are runs without blanks: [^\x20\x09-\x0D]+
SPACED = _byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: words are runs of letters, digits and all other than ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once lower-cased
ALNUM = _byte_class(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


_VALUE = mix(_LOWER.astype(U64) + U64(0x1234567))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, U64(base & (2**64 - 1)), dtype=U64)
    p[0] = 1
    return np.cumprod(p, dtype=U64)


class _Tables:
    up = _powers(_BASE, _BLOCK + 1)
    down = _powers(pow(_BASE, -1, 2**64), _BLOCK + 1)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n < len(cls.up):
            return cls.up, cls.down
        return _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 2**64), n + 1)  # one word longer than a block


class Flat(NamedTuple):
    """The bytes of some rows' texts, and where each row's bytes begin (and the last ends)."""
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """hashes/starts/ends: one entry a word; first: where each row's words begin (and the last ends)."""
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def flat(col: pa.Array) -> Flat:
    """Null texts count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[col.offset: col.offset + len(col) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    data = data[offs[0]: offs[-1]] if len(offs) else data[:0]
    return Flat(data, offs - (offs[0] if len(offs) else 0))


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows of about ``max_bytes`` of text (a longer text is a run of its own)."""
    if batch.num_rows == 0:
        return
    offs = flat(batch.column(batch.schema.get_field_index(text))).offsets
    i = 0
    while i < batch.num_rows:
        j = int(np.searchsorted(offs, offs[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), batch.num_rows)
        yield batch.slice(i, j - i)
        i = j


def words(f: Flat, cls: np.ndarray, hashed: bool = True) -> Words:
    data, offs = f
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, U64), z, z, np.zeros(len(offs), np.int64))
    w = cls[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    edge = offs[(offs < n)]
    before[edge] = False
    starts = np.flatnonzero(w & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    edge = edge[edge > 0] - 1
    after[edge] = False
    ends = np.flatnonzero(w & ~after) + 1
    first = np.searchsorted(starts, offs)
    hashes = _hash(data, starts, ends) if hashed else np.zeros(0, U64)
    return Words(hashes, starts, ends, first)


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        s0 = starts[i]
        j = max(int(np.searchsorted(ends, s0 + _BLOCK, side="right")), i + 1)
        seg = data[s0: ends[j - 1]]
        up, down = _Tables.upto(len(seg))
        total = np.empty(len(seg) + 1, U64)
        total[0] = 0
        np.cumsum(_VALUE[seg] * up[: len(seg)], out=total[1:])
        s, e = starts[i:j] - s0, ends[i:j] - s0
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(U64)
        i = j
    return mix(out)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles in order, and where each row's begin.

    A row of fewer than k words, but not none, has one: its whole sequence.
    """
    n_words = np.diff(w.first)
    count = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(w.first[:-1] - first[:-1], count) + np.arange(first[-1])
    size = np.repeat(np.minimum(n_words, k), count)
    h = size.astype(U64) * U64(0xD6E8FEB86659FD93)
    for j in range(k):
        use = size > j
        src = w.hashes[np.where(use, at + j, 0)] if len(w.hashes) else np.zeros(0, U64)
        h = np.where(use, mix(h * U64(0x2545F4914F6CDD1D) + src + U64(j)), h)
    return h, first
