"""Whole licence texts and headers are found, and a template that cannot be looked for is an error."""
import numpy as np
import pytest

from switchboard.llm.licence_texts import TEXTS
from switchboard.llm.licences import license_matches


def run(spark, texts, **notices):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: [m["license"] for m in r["_licenses"]] for r in license_matches(d, **notices).collect()}


def test_full_texts_and_headers(spark):
    rows = [(name, t) for name, texts in TEXTS.items() for t in texts]
    pad = "some words before it " * 30
    got = run(spark, [f"{pad}\n{t}\n{pad}" for _, t in rows] + [TEXTS["BSD-2-Clause"][0].replace("COPYRIGHT HOLDERS AND CONTRIBUTORS", "REGENTS"), pad])
    assert [got[i] for i in range(len(rows))] == [[name] for name, _ in rows]
    assert got[len(rows)] == ["BSD-2-Clause"] and got[len(rows) + 1] == []


def test_long_and_repetitive_notices(spark):
    rng = np.random.default_rng(9)
    long = " ".join(f"w{int(x)}" for x in rng.integers(0, 300, 1500))
    same = " ".join((["the same clause over again"] * 40) + [f"end{i}" for i in range(60)])
    notices = {"LONG": (long,), "SAME": (same,)}
    got = run(spark, ["x " * 77 + long + " y" * 50, "z " * 31 + same, " ".join(long.split()[:600])], notices=notices)
    assert got == {0: ["LONG"], 1: ["SAME"], 2: []}
    with pytest.raises(ValueError):
        run(spark, ["x"], notices={"SHORT": ("two words",)})
