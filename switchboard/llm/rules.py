"""Quality rules: base counts, and how far a document's distributions lie from its language's.

Two histograms of every whole text are compared with a reference of the text's
language by Jensen-Shannon distance (base 2, square root, 0 to 1): code points
by ``CLASSES``, and words by a list of the language's common words (one bin a
word, one for all others). A reference is the mean of the shares of all
documents of the language that pass the base rules and the length guards, taken
twice: the second time without the documents that are far from the first mean,
so that junk does not shape what it is compared with. There is one row a listed
language, so the join to it is broadcast.

A document's language is its ``lang`` where words are listed for that; else
the listed language whose common words make up most of the text (ties: the
first by name), or none where no word is listed; texts of none have a reference
of their own and are judged by their characters alone.

Guards: few words or code points say little about a distribution, so a text of
fewer than ``LEAST_WORDS`` words is not judged by its words and one of fewer
than ``LEAST_CHARS`` code points not by its characters, and both limits are
widened by a multiple of 1 / sqrt(n), as n draws lie that far from their own
distribution.

Results for odd input: null, empty and blank texts have no words, counts of 0
and fail the base rules; an empty table gives no rows; a language without
a document that may count for its reference has no reference and rejects
nothing by it; repeated rows are judged each (and count each); a null doc_id
is judged like any other; a text of any length is taken whole; other columns
are passed through, this operator's own are in one struct ``_rules``, which
replaces an input column of that name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bytetext as B
from .scratch import Scratch

# The commonest words by language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei".split(),
    "en": "the of and to a in is for that on with was as it by at be this are from he not or his have an they which you were her had".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre".split(),
    "fr": "de la le et les des en un une du est dans que pour qui au il sur pas par plus se ne ce avec sont son aux ou sa mais nous".split(),
}
CLASSES = ("lower", "upper", "digit", "blank", "line", "stop", "mark", "symbol", "other")
WINDOW, LEAST_WORDS, LEAST_CHARS = 5, 50, 200
#: Jensen-Shannon distances over which a document is rejected, and what is added to them times 1 / sqrt(n)
CHAR_LIMIT, WORD_LIMIT = 0.17, 0.18
CHAR_WIDER, WORD_WIDER = 0.8, 1.6


def _classes() -> np.ndarray:
    """The class of each byte that begins a character, 9 for bytes inside one."""
    out = np.full(256, 7)
    for b in range(256):
        c = chr(b)
        if 0x80 <= b <= 0xBF:
            out[b] = 9
        elif b > 0xBF:
            out[b] = 8
        elif c.islower():
            out[b] = 0
        elif c.isupper():
            out[b] = 1
        elif c.isdigit():
            out[b] = 2
        elif c in " \t":
            out[b] = 3
        elif 0x0A <= b <= 0x0D:
            out[b] = 4
        elif c in ".,":
            out[b] = 5
        elif c in "!?;:'\"()-":
            out[b] = 6
    return out


_CLASS = _classes()
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_LINE = np.arange(256) != 0x0A
_EXACT = B.mix(np.arange(256).astype(np.uint64) + np.uint64(0x51ED27))


def _exact_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, upper and lower case apart (equal runs alike, others but for chance)."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(int(np.searchsorted(ends, base + B._BLOCK, side="right")), i + 1)
        part = data[base: ends[j - 1]]
        up, down = B._Tables.upto(len(part))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_EXACT[part] * up[: len(part)], dtype=np.uint64)])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return B.mix(out)


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _seen_twice(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (row, hash) pairs: whether the pair is there more than once, whether it is not the first of its kind."""
    key = hashes ^ B.mix(rows.astype(np.uint64) + np.uint64(77))
    _, first, at, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    later = np.ones(len(key), bool)
    later[first] = False
    return n[at] > 1, later


def base_counts(f: B.Flat) -> dict[str, np.ndarray]:
    rows = len(f.offsets) - 1
    lead = (f.data & 0xC0) != 0x80
    w = B.words(f, B.SPACED, hashed=False)
    n_words = np.diff(w.first)
    row_of = np.repeat(np.arange(rows), n_words)
    hashes = _exact_hashes(f.data, w.starts, w.ends)
    at = np.flatnonzero(np.arange(len(hashes)) + WINDOW <= w.first[row_of + 1]) if len(hashes) else np.zeros(0, np.int64)
    h = np.zeros(len(at), np.uint64)
    for j in range(WINDOW):
        h = B.mix(h * np.uint64(0x2545F4914F6CDD1D) + hashes[at + j] + np.uint64(j))
    twice, _ = _seen_twice(row_of[at], h)
    step = np.zeros(len(hashes) + WINDOW + 1, np.int64)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + WINDOW, -1)
    covered = np.cumsum(step)[: len(hashes)] > 0
    lines = B.words(f, _LINE, hashed=False)
    line_row = np.repeat(np.arange(rows), np.diff(lines.first))
    some = np.searchsorted(w.starts, lines.ends) > np.searchsorted(w.starts, lines.starts)
    _, later = _seen_twice(line_row[some], _exact_hashes(f.data, lines.starts[some], lines.ends[some]))
    return {"n_words": n_words, "word_chars": _per_row(B.SPACED[f.data] & lead, f.offsets), "n_symbols": _per_row(_SYMBOL[f.data], f.offsets),
            "n_dup_lines": np.bincount(line_row[some][later], minlength=rows), "n_repeat_words": _per_row(covered, w.first)}


def char_histogram(f: B.Flat) -> np.ndarray:
    rows = len(f.offsets) - 1
    row_of = np.repeat(np.arange(rows), np.diff(f.offsets))
    cls = _CLASS[f.data]
    own = cls < len(CLASSES)
    return np.bincount(row_of[own] * len(CLASSES) + cls[own], minlength=rows * len(CLASSES)).reshape(rows, len(CLASSES))


def word_histograms(f: B.Flat, common: dict[str, list[str]]) -> dict[str, np.ndarray]:
    """For each language: rows x (its common words, all other words). Words are runs of letters, digits and non-ASCII, A-Z lower-cased."""
    rows = len(f.offsets) - 1
    w = B.words(f, B.ALNUM)
    n = np.diff(w.first)
    row_of = np.repeat(np.arange(rows), n)
    out = {}
    for lang, listed in common.items():
        known = B.words(B.flat(pa.array(listed)), B.ALNUM)
        order = np.argsort(known.hashes)
        at = np.minimum(np.searchsorted(known.hashes, w.hashes, sorter=order), len(listed) - 1)
        hit = known.hashes[order[at]] == w.hashes
        counts = np.bincount(row_of[hit] * len(listed) + order[at[hit]], minlength=rows * len(listed)).reshape(rows, len(listed))
        out[lang] = np.concatenate([counts, (n - counts.sum(axis=1))[:, None]], axis=1)
    return out


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_FEATURES = T.StructType([*[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("language", T.StringType()),
                          T.StructField("chars", T.ArrayType(T.LongType())), T.StructField("common", T.ArrayType(T.LongType()))])


def _features(common: dict[str, list[str]]):
    names = sorted(common)

    def run(batches):
        for batch in batches:
            for part in B.slices(batch, "_text"):
                f = B.flat(part.column(part.schema.get_field_index("_text")))
                counts, chars, words = base_counts(f), char_histogram(f), word_histograms(f, common)
                listed = np.stack([words[n][:, :-1].sum(axis=1) for n in names], axis=1) if names else np.zeros((part.num_rows, 0))
                language, common_counts = [], []
                for i, given in enumerate(part.column(part.schema.get_field_index("_lang")).to_pylist()):
                    if given not in common:
                        given = names[int(listed[i].argmax())] if names and listed[i].max() else None
                    language.append(given)
                    common_counts.append(None if given is None else words[given][i].tolist())
                made = pa.StructArray.from_arrays(
                    [*[pa.array(counts[c].astype(np.int64)) for c in _COUNTS], pa.array(language, pa.string()),
                     pa.array(chars.tolist(), pa.list_(pa.int64())), pa.array(common_counts, pa.list_(pa.int64()))], names=[x.name for x in _FEATURES])
                rest = [n for n in part.schema.names if n not in ("_text", "_lang")]
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(n)) for n in rest], made], names=[*rest, "_rules"])
    return run


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.transform(counts, lambda x: x / total)


def jensen_shannon(p: Column, q: Column) -> Column:
    """The distance of two arrays of shares of equal length (null where one is null)."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
    sums = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.aggregate(sums, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def quality_rules(docs: DataFrame, common: dict[str, list[str]] | None = None, char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """The rows of ``docs``(text, lang, ...) with all their columns but the text, and ``_rules``: the five counts, language,
    chars, common (the histograms), base_failed, char_distance, word_distance (null where there is nothing to compare) and kept.
    """
    common = COMMON_WORDS if common is None else common
    spark = docs.sparkSession
    carried = [c for c in docs.columns if c not in ("text", "_rules")]
    taken = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_row"), F.col("text").cast("string").alias("_text"),
                        (F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")).alias("_lang"))
    schema = T.StructType([taken.schema["_row"], T.StructField("_rules", _FEATURES)])
    found = Scratch(spark, "rules").keep(taken.mapInArrow(_features(common), schema), "features")
    r = found.select("_row", "_rules.*")
    r = r.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    r = r.withColumn("n_points", F.aggregate("chars", F.lit(0).cast("bigint"), lambda a, x: a + x))
    r = r.withColumn("n_listed", F.coalesce(F.aggregate("common", F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0)))
    long_chars, long_words = F.col("n_points") >= LEAST_CHARS, F.col("n_listed") >= LEAST_WORDS
    r = r.withColumn("p", F.when(long_chars, _shares(F.col("chars")))).withColumn("w", F.when(long_words, _shares(F.col("common"))))
    widest = max([len(v) + 1 for v in common.values()], default=1)

    def compared(counted: DataFrame) -> DataFrame:
        """``r`` with its distances from the references of the documents ``counted``."""
        refs = counted.groupBy(F.coalesce("language", F.lit("")).alias("ref")).agg(
            *[F.avg(F.col("p")[i]).alias(f"p{i}") for i in range(len(CLASSES))], *[F.avg(F.get("w", F.lit(i))).alias(f"w{i}") for i in range(widest)])
        ref_w = F.filter(F.array(*[f"w{i}" for i in range(widest)]), lambda x: x.isNotNull())
        refs = refs.select("ref", F.when(F.col("p0").isNotNull(), F.array(*[f"p{i}" for i in range(len(CLASSES))])).alias("ref_p"),
                           F.when(F.col("w0").isNotNull(), ref_w).alias("ref_w"))
        both = r.join(F.broadcast(refs), F.coalesce("language", F.lit("")) == F.col("ref"), "left")
        return both.withColumn("char_distance", jensen_shannon(F.col("p"), F.col("ref_p"))).withColumn("word_distance", jensen_shannon(F.col("w"), F.col("ref_w")))

    def far(distance: str, limit: float, wider: float, n: str) -> Column:
        return F.coalesce(F.col(distance) > limit + wider / F.sqrt(F.greatest(F.col(n), F.lit(1))), F.lit(False))
    near = ~far("char_distance", char_limit, CHAR_WIDER, "n_points") & ~far("word_distance", word_limit, WORD_WIDER, "n_listed")
    sound = compared(r.where("not base_failed")).where("not base_failed").where(near)
    judged = compared(sound.select(*r.columns))
    return judged.withColumn("kept", ~F.col("base_failed") & near).select(
        "_row.*", F.struct(*_COUNTS, "language", "chars", "common", "base_failed", "char_distance", "word_distance", "kept").alias("_rules"))
