"""Vector codes, the manifest and the quality rules: odd input against brute force."""
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from switchboard.llm import codes, merkle, rules, sha256

NAN, INF = float("nan"), float("inf")


# ---- vector codes ---------------------------------------------------------------

def brute_codes(rows):
    """(vec_id, code, error) of the rows by plain loops over Python integers."""
    good = [(i, [math.floor(4096 * x) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((r for r in good if r[0] is not None), key=lambda r: (r[0], r[1]))
    width = len(first[0][1]) if first else 0
    if not width or width % 8:
        return [(i, None, None) for i, _ in good]
    limit = codes._limit(width)
    good = [(i, [max(-limit, min(limit, x)) for x in q]) for i, q in good]
    first = sorted((r for r in good if r[0] is not None and len(r[1]) == width), key=lambda r: (r[0], r[1]))[:16]
    s = width // 8
    cut = lambda q, p: q[p * s:(p + 1) * s]
    books = [[cut(q, p) for _, q in first] for p in range(8)]

    def assign(q, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(q, p), e)), k) for k, e in enumerate(books[p]))
    fit = [q for _, q in good if len(q) == width]
    for _ in range(6):
        for p in range(8):
            held = collections.defaultdict(list)
            for q in fit:
                held[assign(q, p)[1]].append(cut(q, p))
            books[p] = [[sum(c) // len(held[k]) for c in zip(*held[k])] if held[k] else e for k, e in enumerate(books[p])]
    out = []
    for i, q in good:
        if len(q) != width:
            out.append((i, None, None))
            continue
        a = [assign(q, p) for p in range(8)]
        out.append((i, "".join(f"{k:02x}" for _, k in a), sum(d for d, _ in a)))
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, "c", "x") for i, v, lab in rows], "vec_id bigint, embedding array<double>, label int, code string, _q string")


def table_of(df):
    return sorted([(r["vec_id"], r["code"], r["error"]) for r in df.collect()], key=repr)


def random_vectors(n, width=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width))
    return [(i, (centres[i % 5] + rng.normal(size=width) * 0.1).tolist(), [None, 1, 2, 1, 1][i % 5]) for i in range(n)]


def test_codes_equal_brute_force_with_odd_rows(spark):
    rows = random_vectors(90)
    rows += [(200, None, 1), (201, [NAN] + [0.0] * 15, 1), (202, [INF] + [0.0] * 15, 1), (203, [None] + [0.0] * 15, 1), (204, [], None), (205, [1.0] * 8, 2),
             (None, rows[3][1], 2), rows[4], rows[4], (206, [1e30] * 16, 1), (207, [-1e300] * 16, 1), (208, [0.0] * 16, None)]
    df, books = codes.compressed_codes(vectors(spark, rows))
    assert table_of(df) == sorted(brute_codes(rows), key=repr)
    sums = collections.Counter()
    for r in df.collect():
        sums[r["label"]] += r["error"] or 0
    assert all(r["label_error"] == sums[r["label"]] for r in df.collect())
    text = ",".join(str(int(x)) for b in books for e in b for x in e)
    assert {r["codebooks_sha256"] for r in df.collect()} == {hashlib.sha256(text.encode()).hexdigest()}


def test_codes_with_few_and_no_rows_and_ties(spark):
    for rows in (random_vectors(5), [(i, [float(i % 2)] * 8, 1) for i in range(20)], [(i, [1.0, 2.0, 3.0], 1) for i in range(4)], [(None, [1.0] * 8, 1)]):
        df, _ = codes.compressed_codes(vectors(spark, rows))
        assert table_of(df) == sorted(brute_codes(rows), key=repr)
    df, books = codes.compressed_codes(vectors(spark, random_vectors(3)).limit(0))
    assert df.collect() == [] and books == []


def test_pruning_never_changes_the_nearest_entry():
    rng = np.random.default_rng(4)
    for scale in (3, 1000, 1 << 26):
        parts = rng.integers(-scale, scale, size=(4000, 4))
        entries = rng.integers(-scale, scale, size=(16, 4))
        entries[5] = entries[2]
        pivots = codes._choose_pivots(entries)
        at, best, spent = codes.nearest_entries(parts, codes._distances(parts, pivots), pivots, entries)
        exact = ((parts[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        assert (at == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
        assert spent < 15 * len(parts)


# ---- manifest -------------------------------------------------------------------

def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def way(tree, i):
    out = []
    for level in tree[:-1]:
        lo = i // 16 * 16
        out.append((level[lo:lo + 16], i - lo))
        i //= 16
    return out


def brute_manifest(rows, other):
    """rows(doc_id, text, lang, source, n_chars); other(row) is the text after tampering."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {s: levels([leaf(r, r[1]) for r in by[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by[s]):
            path = way(trees[s], i) + way(top, k)
            x = leaf(r, other(r))
            for run, j in path:
                x = sha("".join(run[:j] + [x] + run[j + 1:]))
            out.append((r[0], leaf(r, r[1]), trees[s][-1][0], top[-1][0], sha("".join("".join(run[:j] + run[j + 1:]) for run, j in path)), x, x == top[-1][0]))
    return sorted(out, key=repr)


def tampered(r):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), r[1]) if r[1] is not None else None
    return lower if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[1]


def manifest(spark, rows, levels=3):
    docs = spark.createDataFrame([(*r, True, 1, b"x") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, _none boolean, pos int, leaf binary")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.verified_manifest(docs, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, {"text": lowered}, levels)


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def odd_documents():
    rows = [(i, f"Text NUMBER {i} é", "en", "hot" if i % 2 else ["a", "B", "ü", None, ""][i % 5], i) for i in range(300)]
    return rows + [(None, "No id", "de", "hot", None), (None, None, None, None, None), (5, "Text NUMBER 5 é", "en", "hot", 5), (6, "", "en", "lone", 0),
                   (2**53 + 1, "LONG " * 40000, "en", "hot", 1), (7, "-", "-", "-", 1)]


@pytest.mark.parametrize("levels_in_a_cell", [3, 1])  # cells of 16 leaves make the trees several stages high
def test_manifest_equals_brute_force(spark, levels_in_a_cell):
    rows = odd_documents()
    got = sorted([tuple(r[c] for c in NAMES) for r in manifest(spark, rows, levels_in_a_cell).collect()], key=repr)
    assert got == brute_manifest(rows, tampered)


def test_manifest_of_one_leaf_and_of_none(spark):
    for rows in ([(1, "A", "en", "s", 1)], [(1, "A", "en", "s", 1), (2, "B", "en", "t", 1)]):
        got = sorted([tuple(r[c] for c in NAMES) for r in manifest(spark, rows).collect()], key=repr)
        assert got == brute_manifest(rows, tampered)


def test_manifest_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = merkle.verified_manifest(docs, F.lit(False), {})
    assert out.columns == NAMES and out.collect() == []
    assert merkle.Manifest(docs).root() is None


def test_states_resume_where_hashing_was():
    rng = np.random.default_rng(2)
    digests = rng.integers(0, 256, size=(37, 32), dtype=np.uint8)
    states, above = merkle.midstates(digests)
    hexes = [bytes(d).hex() for d in digests]
    want = [sha("".join(hexes[i:i + 16])) for i in range(0, 37, 16)]
    assert [bytes(x).hex() for x in above] == want
    new = rng.integers(0, 256, size=(37, 32), dtype=np.uint8)
    folded = merkle.fold_level(digests, states, np.arange(37), new)
    for i in range(37):
        run = hexes[i // 16 * 16: i // 16 * 16 + 16]
        run[i % 16] = bytes(new[i]).hex()
        assert bytes(folded[i]).hex() == sha("".join(run))
    assert bytes(sha256.to_bytes(sha256.START[None, :])[0]).hex().startswith("6a09e667bb67ae85")


# ---- quality rules ----------------------------------------------------------------

def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n)


PLAIN = "the old man and his dog were on the road to the village by the river in the morning and it was a fine day for a walk with them".split()


def plain(rng, n):
    return " ".join(PLAIN[int(x)] + ("." if k % 12 == 11 else "") for k, x in enumerate(rng.integers(0, len(PLAIN), n)))


def rule_rows():
    rng = np.random.default_rng(9)
    rows = [(i, plain(rng, 300), "en") for i in range(60)]
    rows += [(100, plain(rng, 300).upper() + "!!", "en"), (101, " ".join(w + "###" for w in plain(rng, 300).split()), "en"),
             (102, " ".join(f"zx{int(x)}" for x in rng.integers(0, 9000, 300)), "en"), (103, "spam " * 400, "en"),
             (104, None, "en"), (105, "", None), (106, " \t\n ", "xx"), (107, "a b c", "en"), (108, "é ß 漢字 😀 word " * 3, None), (109, "same line\nsame line\n\nSame line\n same line", "en"),
             (110, plain(rng, 20), "en"), (111, "One\x1ctwo\x85three four\r\nfive", "en"), (None, plain(rng, 200), None), (112, plain(rng, 60000), "en"), rows[0]]
    return rows


def judged(spark, rows):
    df = spark.createDataFrame([(i, t, g, "x", 1, "y") for i, t, g in rows], "doc_id bigint, text string, lang string, _row string, n_words int, _rules string")
    return rules.quality_rules(df)


def test_base_counts_equal_brute_force(spark):
    rows = rule_rows()
    out = judged(spark, rows)
    assert out.columns == ["doc_id", "lang", "_row", "n_words", "_rules"]
    got = sorted([(r["doc_id"], *[r["_rules"][c] for c in (*rules._COUNTS, "base_failed")]) for r in out.collect()], key=repr)
    assert got == sorted([(i, *brute_counts(t)) for i, t, _ in rows], key=repr)


def test_distances_equal_brute_force(spark):
    out = {r["doc_id"]: r["_rules"] for r in judged(spark, rule_rows()).collect()}
    kept = [r for r in out.values() if r["kept"] and r["language"] == "en" and sum(r["chars"]) >= rules.LEAST_CHARS]

    def distance(p, q):
        m = (p + q) / 2
        part = lambda x: float(np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0])))
        return math.sqrt(max((part(p) + part(q)) / 2, 0))
    # rows that count for a reference are those near the first one; here just the ones that are kept (once more for the repeated row)
    shares = [np.array(r["chars"]) / sum(r["chars"]) for r in [*kept, out[0]]]
    ref = np.mean(shares, axis=0)
    for i in (1, 100, 101, 102):
        assert abs(out[i]["char_distance"] - distance(np.array(out[i]["chars"]) / sum(out[i]["chars"]), ref)) < 1e-9


def test_junk_is_rejected_and_plain_text_kept(spark):
    out = {r["doc_id"]: r["_rules"]["kept"] for r in judged(spark, rule_rows()).collect()}
    assert all(out[i] for i in range(60)) and out[110] and out[None] and out[112]
    assert not any(out[i] for i in (100, 101, 102, 103, 104, 105, 106, 107))


def test_rules_on_empty_tables_and_without_languages(spark):
    assert judged(spark, rule_rows()).limit(0).collect() == []
    df = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert rules.quality_rules(df).collect() == []
    some = spark.createDataFrame([(1, "word " * 3 + "other things are here and there too maybe", "en")], "doc_id bigint, text string, lang string")
    assert rules.quality_rules(some, common={}).first()["_rules"]["kept"] is True
    assert rules.quality_rules(some.drop("lang")).first()["_rules"]["language"] == "en"


def test_rules_tell_labelled_quality(spark):
    """On the test tables: junk that the base rules leave is mostly rejected, good text is kept."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = rules.quality_rules(docs.select("doc_id", "lang", "text")).select("doc_id", "_rules.base_failed", "_rules.kept").join(labels, "doc_id").where("not base_failed").collect()
    good, junk = [r["kept"] for r in rows if r["quality"] == 1], [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(junk) <= 0.3 * len(junk)
