"""Steps whose size must not grow with one group, node or partition count, against brute force."""
import itertools

import numpy as np
from pyspark.sql import functions as F

from switchboard.llm import minhash, recurrent, surrogates, vectors
from switchboard.llm.components import connected_components
from switchboard.llm.scratch import Scratch
from test_operators import components


def test_most_frequent_words_keep_to_the_bound(spark):
    rng = np.random.default_rng(11)
    rows = [(int(t), 0, int(n)) for t, n in enumerate(rng.zipf(1.3, 900).clip(1, 10 ** 12))]
    counts = spark.createDataFrame(rows, "tok bigint, cls int, n bigint").repartition(7)
    size = sorted((n for _, _, n in rows), reverse=True)
    for most in (0, 1, 40, 300, 900, 2000):
        got = recurrent._most_frequent(counts, most)
        assert len(got) <= most and list(got["n"]) == size[:len(got)]
        # all or none of the words of one count; those left out lie within one interval of the bound
        assert len(got) in (0, 900) or size[len(got)] < size[len(got) - 1]
        if len(got) < min(most, 900):
            step = [int(np.floor(np.log2(n) * 64)) for n in size[len(got): most + 1]]
            assert len(set(step)) == 1
    assert not len(recurrent._most_frequent(counts.where("n < 0"), 5))


def test_remaining_pairs_meet_once_in_parts_of_both_sides(spark, monkeypatch):
    monkeypatch.setattr(minhash, "REST", 3)
    rng = np.random.default_rng(12)
    at = {rep: {int(x) for x in rng.integers(0, 3, 2)} for rep in range(60)}
    label = {rep: 100 if rep % 4 == 0 else rep for rep in at}
    label[1] = label[2] = 200
    sig = {f: 0 for f in minhash._SIG}
    size = {v: sum(v in nodes for nodes in at.values()) for v in range(3)}
    kind = ", ".join(f"{f}: bigint" for f in minhash._SIG)
    large = spark.createDataFrame([(v, rep, 50, sig, label[rep], size[v], 0) for rep, nodes in at.items() for v in nodes],
                                  f"node bigint, rep bigint, n bigint, sig struct<{kind}>, label bigint, c bigint, lo bigint")
    got = [(r["a"], r["b"]) for r in minhash._rest_pairs(large, 80).collect()]
    assert sorted(got) == [(a, b) for a, b in itertools.combinations(at, 2) if at[a] & at[b] and label[a] != label[b]]


def test_forest_connects_what_the_links_connect():
    rng = np.random.default_rng(13)
    for n, m, share in ((1, 1, 1.0), (30, 50, 0.02), (60, 40, 0.01), (40, 40, 0.5), (200, 300, 1.0), (5, 5, 0.0)):
        hit = rng.random((n, m)) < share
        left, right = np.arange(n) * 7, 10_000 + np.arange(m)
        got = vectors._forest(hit, left, right)
        every = list(zip(*(x.tolist() for x in np.nonzero(hit))))
        mine = [(a // 7, b - 10_000) for a, b in got]
        assert all(hit[a, b] for a, b in mine) and len(set(mine)) == len(mine)
        root = lambda links: components(n + m, [(a, n + b) for a, b in links])
        assert root(every) == root(mine)
        assert len(mine) == n + m - len(set(root(every)))


def test_numbers_of_a_full_format_come_to_an_end(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "LATE", 2)
    # country code and two digits: most of the numbers that keep the format are the corpus's own
    numbers = [f"{i:02d}" for i in range(80)]
    atoms = spark.createDataFrame([("phone", f"+352{x}", f"+352 {x}") for x in numbers] + [("ssn", x, x) for x in numbers], "kind string, canon string, shown string")
    got = surrogates.assign(atoms, "secret", Scratch(spark, "surrogates")).collect()
    for kind in ("phone", "ssn"):
        new = [r["same"] for r in got if r["kind"] == kind]
        assert len(new) == len(set(new)) == 80 and not set(new) & {r["canon"] for r in got}
    assert all(r["surrogate"].startswith("+352 ") for r in got if r["kind"] == "phone")


def _jobs(spark, group, run):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        out = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(group))


def test_components_take_few_jobs_a_round(spark):
    """A job is a plan and broadcasts that the driver makes and holds; links are read once a round, labels twice."""
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(300)] + [(7, 7), (None, 5), (900, 901), (901, 900)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got, jobs = _jobs(spark, f"components-{id(df)}", lambda: connected_components(df, Scratch(spark, "test")))
    want = {i: 0 for i in range(41)} | {100: 100, 900: 900, 901: 900} | {200 + i: 100 for i in range(300)}
    assert sorted((r["id"], r["label"]) for r in got.collect()) == sorted(want.items())
    assert jobs <= 36


def test_a_round_of_components_is_one_join(spark):
    """Each join of a small table is a broadcast that the driver builds and holds; a vertex's label counts as one more neighbour."""
    df = spark.createDataFrame([(i, i + 1) for i in range(12)] + [(50, 60), (60, 55), (60, 60), (None, 5)], "a bigint, b bigint")
    plans = []

    class Plans(Scratch):
        def keep(self, df, name="t"):
            plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
            return super().keep(df, name)

    got = connected_components(df, Plans(spark, "test"))
    want = {i: 0 for i in range(13)} | {50: 50, 55: 50, 60: 50}
    assert sorted((r["id"], r["label"]) for r in got.collect()) == sorted(want.items())
    rounds = [p for name, p in plans if name == "labels"][1:]
    assert rounds and all(p.count("Join ") == 1 for p in rounds)


def test_near_duplicates_take_few_tables(spark):
    """A component found at one level is one vertex of the next, so later rounds are few; links and the first members are no tables."""
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for family in range(6):
        words = [f"w{family}x{i}" for i in range(200)]
        for j in range(90):
            mine, doc_id = list(words), 1000 * family + 7 * j % 631
            for at in rng.choice(200, 3, replace=False):
                mine[at] = f"n{family}x{j}x{at}"
            rows.append((doc_id, " ".join(mine)))
            want[doc_id] = 1000 * family
    names = []

    class Tables(Scratch):
        def keep(self, df, name="t"):
            names.append(name)
            return super().keep(df, name)

    was, minhash.Scratch = minhash.Scratch, Tables
    try:
        got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), k=2, threshold=80)
        assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want
    finally:
        minhash.Scratch = was
    assert "links" not in names and names.count("members") <= minhash.DEPTH - 1
    assert len(names) <= 18, names


def test_no_name_part_is_lower_cased_by_the_optimizer(spark):
    """lower() of a literal is folded on the driver, which loads ICU's tables for it; syllables are in lower case as they are."""
    part = spark.range(1).select(surrogates._part(F.lit("given:m"), F.lit("ann"), F.sha2(F.col("id").cast("string"), 256), F.lit(0)).alias("p"))
    assert "lower(" not in part._jdf.queryExecution().analyzed().toString()
    for syllables in surrogates.SYLLABLES.values():
        assert all(s == s.lower() for s in syllables)


def test_remaining_pairs_of_a_hot_node_take_few_tasks(spark):
    """Equal to the pairs by ``_alike``; a hot node is not split into runs of one side times runs of the other."""
    rng = np.random.default_rng(14)
    rows = []
    for rep in range(400):
        family, n = rep % 9, 300 + rep % 40
        base = np.random.default_rng(family).integers(-2 ** 63, 2 ** 63, len(minhash._SIG))
        flips = [sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 12), replace=False)) for _ in base]
        sig = {f: int(x) ^ y for f, x, y in zip(minhash._SIG, base, flips)}
        rows += [(v, rep, n, sig, rep if rep % 5 else 1000 + family, 400, 0) for v in ((1, 2) if rep % 3 else (2,))]
    kind = ", ".join(f"{f}: bigint" for f in minhash._SIG)
    schema = f"node bigint, rep bigint, n bigint, sig struct<{kind}>, label bigint, c bigint, lo bigint"
    large = Scratch(spark, "test").keep(spark.createDataFrame(rows, schema))
    hot = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "12",
           "spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1k"}
    was = {c: spark.conf.get(c) for c in hot}
    sc, group = spark.sparkContext, "hot-node"
    try:
        for c, v in hot.items():
            spark.conf.set(c, v)
        sc.setJobGroup(group, group)
        got = sorted((r["a"], r["b"]) for r in minhash._rest_pairs(large.repartition(40), 80).collect())
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
        for c, v in was.items():
            spark.conf.set(c, v)
    one = large.where("node = 2")
    want = one.alias("x").join(one.alias("y"), (F.col("x.rep") < F.col("y.rep")) & (F.col("x.label") != F.col("y.label")) & minhash._alike("x", "y", 80))
    want = sorted(tuple(r) for r in want.select(F.col("x.rep"), F.col("y.rep")).collect())
    assert 100 < len(want) < 400 * 399 / 2 / 2 and got == want
    infos = [sc.statusTracker().getStageInfo(s) for j in sc.statusTracker().getJobIdsForGroup(group) for s in sc.statusTracker().getJobInfo(j).stageIds]
    tasks = max(i.numTasks for i in infos if i)
    assert tasks <= 60, tasks
