"""The pipeline's stages against brute force: null and repeated ids, int and bigint ids, clashing columns, empty tables."""
import re

import numpy as np
import pytest

import corpus_pipeline as P
from switchboard.llm import toxicity as T

EXTRA = ["_row", "_key", "_score", "_matches", "_words", "row", "key", "_gone", "_mix"]
CLEAN = "quiet rain fell over the old harbour while people walked home".split()


def sentence(rng, n):
    return " ".join(f"{CLEAN[int(x)]}{int(y)}" for x, y in zip(rng.integers(0, len(CLEAN), n), rng.integers(0, 400, n)))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near(a, b):
    a, b = shingles(a), shingles(b)
    return bool(a) and 100 * len(a & b) >= 80 * len(a | b)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = np.random.default_rng(7)
    bench = [sentence(rng, 40) for _ in range(3)]
    rows, labels = [], []
    for i in range(60):
        text = sentence(rng, 60)
        if i % 6 == 0:
            text += " you pathetic vile idiot"
        rows.append((i, text))
        labels.append((i, 1, int(i % 6 == 0)))
    base = rows[7][1].split()
    rows.append((100, " ".join(base)))                                          # a copy of 7
    rows.append((101, " ".join(["changed", *base[1:]])))                        # a near copy of 7
    rows.append((102, sentence(rng, 30) + " " + " ".join(bench[0].split()[5:17])))  # leaked
    rows.append((103, sentence(rng, 30) + " mail anna.berg@example.org or +1 (017) 555-7713"))
    rows += [(None, sentence(rng, 50)), (104, None), (105, ""), (106, "   "), (8, sentence(rng, 55)), (9, rows[9][1])]
    return rows, labels, bench


@pytest.fixture(scope="module", params=["int", "bigint"])
def folder(spark, tables, request, tmp_path_factory):
    rows, labels, bench = tables
    path = str(tmp_path_factory.mktemp("pipeline"))
    langs = ["en", "de", "fr", "es"]
    spark.createDataFrame([(i, t, langs[n % 4], "s", len(t or ""), *["x"] * len(EXTRA)) for n, (i, t) in enumerate(rows)],
                          f"doc_id {request.param}, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in EXTRA)
                          ).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, f"doc_id {request.param}, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(n, t) for n, t in enumerate(bench)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def stage(spark, folder, name, docs=None):
    docs = spark.read.parquet(f"{folder}/documents.parquet") if docs is None else docs
    out = dict(P.STAGES)[name](spark, docs, folder)
    if name != "mixing":
        assert out.columns == docs.columns and out.schema == docs.schema or [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    return out


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_stage_names():
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_dedup", "decontamination", "personal_data", "mixing"]


def test_toxicity_stage(spark, folder, tables):
    rows = tables[0]
    kept = pairs(stage(spark, folder, "toxicity"))
    want = [r for r in rows if "pathetic" not in (r[1] or "")]
    assert kept == sorted(want, key=repr)


def test_near_dedup_stage(spark, folder, tables):
    rows = sorted(set(tables[0]), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    group = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if near(a, rows[j][1]) and rows[i][0] is not None and rows[j][0] is not None:
                group = [group[j] if g == group[i] else g for g in group]
    want = [r for i, r in enumerate(rows) if group[i] == i or not shingles(r[1])]
    assert pairs(stage(spark, folder, "near_dedup")) == sorted(want, key=repr)


def test_decontamination_stage(spark, folder, tables):
    rows, _, bench = tables
    windows = {tuple(b.split()[i:i + 10]) for b in bench for i in range(31)}

    def leaked(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return any(tuple(w[i:i + 10]) in windows for i in range(len(w)))
    assert pairs(stage(spark, folder, "decontamination")) == sorted([r for r in rows if not leaked(r[1])], key=repr)


def test_personal_data_stage(spark, folder, tables):
    out = stage(spark, folder, "personal_data")
    got = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert out.count() == len(tables[0])
    text = next(t for i, t in got if i == 103)
    assert "anna.berg" not in text and "555-7713" not in text and "@" in text
    assert got[(103, text)]["n_chars"] == len(text)
    plain = [r for r in tables[0] if r[0] != 103]
    assert all(r in got for r in plain)


def test_mixing_stage(spark, folder, tables):
    docs = spark.read.parquet(f"{folder}/documents.parquet").dropDuplicates(["doc_id", "text"])
    out = stage(spark, folder, "mixing", docs)
    rows = out.collect()
    assert set(P.DOCUMENTS) <= set(out.columns) and rows and all(r["copies"] > 0 for r in rows)
    assert all(abs(r["p_de"] + r["p_en"] + r["p_es"] + r["p_fr"] - 1) < 1e-9 and abs(r["copies"] - r["rate"]) < 1 for r in rows)
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert {(r["doc_id"], r["text"]) for r in rows} <= texts and len(rows) == len({(r["doc_id"], r["text"]) for r in rows})


def test_run_applies_every_stage(spark, folder, tables):
    rows = P.run(spark, folder).collect()
    ids = [r["doc_id"] for r in rows]
    assert not set(ids) & {0, 6, 12, 100, 101, 102} and len(rows) > 10
    assert not any("pathetic" in (r["text"] or "") or "anna.berg" in (r["text"] or "") for r in rows)


def test_run_on_empty_tables(spark, folder, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_fit_counts_repeated_sentences_without_holding_them():
    """The same sentence many times weighs as often as it is there, and is held once."""
    line = "the black man sat. "
    texts = [((line * n + f"word{n} calm").encode(), 0) for n in range(1, 30)] + [((line + f"vile{n % 3} idiot").encode(), 1) for n in range(30)]
    pairs = T._Pairs(np.zeros(T.SLOTS, np.int64))
    for t, _ in texts:
        pairs.add(t.decode())
    every = [p for t, _ in texts for p in T._swapped(t.decode())]
    row, col, sign, times = pairs.arrays()
    assert len(times) == len(set(every)) and times.sum() == len(every)
    slots, weights, bias = T.fit(texts)
    assert len(slots) and np.isfinite(weights).all() and np.isfinite(bias)


def test_fit_in_turns_equals_fit_at_once(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [((sentence(rng, 40) + (" the gay idiot" if i % 3 == 0 else " the old boy")).encode(), int(i % 3 == 0)) for i in range(90)]
    one = T.fit(texts)
    monkeypatch.setattr(T, "AT_ONCE", 500)
    many = T.fit(texts)
    assert (one[0] == many[0]).all() and np.allclose(one[1], many[1]) and np.isclose(one[2], many[2])
