"""License scan: MinHash bands over overlapping text windows, in DataFrame functions only.

Templates and texts are sequences of lower-cased words; shingles have ``K``
words. For a template of n shingles, windows of w shingles are laid over the
text with step s, w - s + 1 >= n, so that every place of the template lies
wholly in some window. Each window has ``BANDS`` minwise values (bands of one
row), and retrieves the templates that share one of them. A window that holds
a whole template of n shingles has similarity n / w with it, 0.39 at least
for the classes of (w, s) below and 0.49 for those that _classes adds for
longer templates, however long, and is retrieved with probability
1 - (1 - n/w)^8: 0.98 and 0.995 at least; one that holds 0.8 of the shingles,
which is enough to match, with 0.94 at least. A template's class is that of
its places, repeated shingles counted, as the window must hold them all.
Retrieved windows are verified by exact shingle containment. A template of
fewer than K words cannot be looked for: it is an error.

Results for odd input: null and empty texts, and texts of fewer than K words,
have no match; repeated rows each come back; rows keep their order of
columns only by name; a null doc_id is scanned like any other.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytetext import mix
from .licence_texts import TEXTS

K, BANDS, CONTAINED = 3, 8, 0.8
#: (window, step, most shingles of a template), smallest first
CLASSES = ((4, 2, 3), (8, 3, 6), (13, 3, 11), (24, 6, 19), (48, 12, 37), (96, 24, 73))

# License notices as they are commonly written.
TEMPLATES = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license."),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3.",),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3.",),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "Licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0 Universal.",),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}
#: the notices and the usual full texts and headers
ALL = {name: TEMPLATES.get(name, ()) + TEXTS.get(name, ()) for name in sorted({*TEMPLATES, *TEXTS})}

_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_XOR = [int(x) for x in mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)]


def template_words(text: str) -> list[str]:
    return [w for w in re.split(_NOT_WORD, text.lower()) if w]


def _shingles(words: Column) -> Column:
    n = F.size(words) - (K - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(K)]))).otherwise(F.array().cast("array<bigint>"))


def _moved(band: int):
    """The band's hash of a shingle: its 64-bit hash, exclusive-or a constant."""
    return lambda x: x.bitwiseXOR(F.lit(_XOR[band]))


def _least(hashes: Column, band: int) -> Column:
    return F.array_min(F.transform(hashes, _moved(band)))


def _classes(places: int) -> list[tuple[int, int, int]]:
    """CLASSES, and as many more as a template of so many shingles needs."""
    out = list(CLASSES)
    while out[-1][2] < places:
        most = out[-1][2] * 3 // 2
        out.append((most + most // 3 - 1, most // 3, most))
    return out


def templates(spark, notices: dict[str, tuple[str, ...]]) -> DataFrame:
    """license, n, cls, shingles, bands: a table as small as the notices given."""
    rows = [(name, template_words(t)) for name, texts in notices.items() for t in texts]
    for name, words in rows:
        if len(words) < K:
            raise ValueError(f"a template of {name} has fewer than {K} words")
    classes = _classes(max((len(words) for _, words in rows), default=0) - K + 1)
    t = spark.createDataFrame(rows, "license string, words array<string>").withColumn("shingles", F.array_distinct(_shingles(F.col("words"))))
    t = t.withColumn("n", F.size("shingles"))
    cls = F.lit(len(classes) - 1)
    for i, (_, _, most) in reversed(list(enumerate(classes[:-1]))):
        cls = F.when(F.size("words") - (K - 1) <= most, F.lit(i)).otherwise(cls)
    return t.withColumn("cls", cls).withColumn("bands", F.array(*[_least(F.col("shingles"), b) for b in range(BANDS)]))


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("bigint") for v in values])


def _settled(rows: DataFrame) -> DataFrame:
    """The same rows, their columns computed once here (a projection above would compute them again at every use)."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def _windows(window: int, step: int) -> Column:
    """The steps at which windows begin that hold one of the shingles in _at.

    A window's least value in a band can only equal a template's if the window
    holds that very shingle, so the bands of other windows need no look.
    """
    def around(i: Column) -> Column:
        low = F.greatest(F.lit(0), F.ceil((i - (window - 1)) / step).cast("int"))
        high = F.floor(i / step).cast("int")
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.flatten(F.transform("_at", around)))


def _retrieved(j: Column, window: int, step: int, of: list[dict]) -> Column:
    """Whether the window that begins with step j has a band in common with one of the templates."""
    hit = F.lit(False)
    for b in range(BANDS):
        hit = hit | _least(F.slice("_sh", j * step + 1, window), b).isin(sorted({t["bands"][b] for t in of}))
    return hit


def _hits(window: int, step: int, own: list[dict]):
    return lambda j: _retrieved(j, window, step, own)


def _found(c: int, window: int, step: int, t: dict) -> Column:
    """The template's verified places, a struct for each window that retrieved it."""
    sh = _longs(t["shingles"])

    def place(j: Column) -> Column:
        own = F.slice("_sh", j * step + 1, window)
        at = F.filter(F.transform(own, lambda x, i: F.when(F.array_contains(sh, x), i + j * step)), lambda i: i.isNotNull())
        return F.struct(F.lit(t["license"]).alias("license"), F.array_min(at).alias("begin"), (F.array_max(at) + K).alias("end"),
                        (size(j) / float(t["n"])).alias("contained"), size(j).alias("found"))

    def size(j: Column) -> Column:
        return F.size(F.array_intersect(F.slice("_sh", j * step + 1, window), sh))
    near = F.filter(f"_c{c}", lambda j: _retrieved(j, window, step, [t]) & (size(j) / float(t["n"]) >= CONTAINED))
    return F.transform(near, place)


def license_matches(docs: DataFrame, notices: dict[str, tuple[str, ...]] = ALL) -> DataFrame:
    """The rows of ``docs`` with _licenses: an array of (license, begin, end, contained), in order of place.

    begin and end (excluded) are word positions that bound the template's
    shingles in the window; contained is the share of them found. Of
    overlapping matches the one of most shingles found stays (then the fullest,
    the longest, the first by name), so that a whole text goes before a line of
    it. The array is empty without match. A column _licenses of ``docs`` is replaced.
    """
    beside = [c for c in docs.columns if c not in ("text", "_licenses")]
    found = _matched(docs.select(F.struct(*[F.col(f"`{c}`") for c in beside]).alias("_row"), "text"), notices)
    return found.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns if c != "_licenses"], "_licenses")


def _matched(docs: DataFrame, notices: dict[str, tuple[str, ...]]) -> DataFrame:
    """``license_matches`` of docs(_row, text)."""
    known = [r.asDict() for r in templates(docs.sparkSession, notices).collect()]
    low = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = _settled(docs.withColumn("_words", F.filter(F.split(low, _NOT_WORD), lambda w: w != "")))
    rows = _settled(rows.withColumn("_sh", _shingles(F.col("_words"))).drop("_words"))
    seeds = sorted({t["bands"][b] ^ _XOR[b] for t in known for b in range(BANDS)})
    rows = _settled(rows.withColumn("_at", F.filter(F.transform("_sh", lambda x, i: F.when(x.isin(seeds), i)), lambda i: i.isNotNull())))
    parts, retrieved = [], {}
    for c, (window, step, _) in enumerate(_classes(max((len(template_words(t)) for texts in notices.values() for t in texts), default=0) - K + 1)):
        own = [t for t in known if t["cls"] == c]
        if own:
            retrieved[f"_c{c}"] = F.filter(_windows(window, step), _hits(window, step, own))
            parts += [_found(c, window, step, t) for t in own]
    rows = _settled(rows.withColumns(retrieved)) if retrieved else rows
    if not parts:
        return docs.withColumn("_licenses", F.array().cast("array<struct<license:string,begin:int,end:int,contained:double>>"))
    rows = _settled(rows.withColumn("_all", F.array_distinct(F.concat(*parts))).select(*docs.columns, "_all"))

    def better(y: Column, x: Column) -> Column:
        def rank(m: Column) -> Column:
            return F.struct(-m["found"], -m["contained"], m["begin"] - m["end"], m["license"], m["begin"])
        return (y["begin"] < x["end"]) & (x["begin"] < y["end"]) & (rank(y) < rank(x))
    best = F.filter("_all", lambda x: ~F.exists("_all", lambda y: better(y, x)))
    return rows.withColumn("_licenses", F.array_sort(F.transform(best, lambda m: F.struct(m["begin"].alias("begin"), m["end"].alias("end"), m["license"].alias("license"), m["contained"].alias("contained"))))).drop("_all")
