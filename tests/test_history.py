"""Histories from two sources and from expiring rows, against brute force."""
import datetime as dt
import random

from pyspark.sql import functions as F

from switchboard.operators import history as H
from switchboard.operators.transforms import scd2_build

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_two_sources_carry_each_attribute(spark):
    a = spark.createDataFrame([(1, at(0), 1, "A", 10), (1, at(48), 2, "A", None), (2, at(1), 1, "B", 5)], "k long, t timestamp_ntz, i long, grade string, org long")
    b = spark.createDataFrame([(1, at(24), 1, "OUT", 77), (1, at(48), 2, "IN", None), (1, at(60), 3, "NOTE", 9), (None, at(1), 4, "IN", 1)],
                              "k long, t timestamp_ntz, i long, kind string, org long")
    first = H.observations(a, ["k"], F.col("t"), 0, "i", {"grade": H.stated(F.col("grade")), "org": H.stated(F.col("org"))})
    second = H.observations(b, ["k"], F.col("t"), 1, "i", {"status": H.stated_if(F.col("kind") != "NOTE", F.col("kind")),
                                                        "org": H.stated_if(F.col("org").isNotNull() & (F.col("kind") != "NOTE"), F.col("org"))})
    got = H.merged_history([first, second], ["k"], ["grade", "org", "status"], "id")
    rows = [(r["k"], r["grade"], r["org"], r["status"], r["eff_from_ts"], r["eff_to_ts"], r["is_current"]) for r in got.orderBy("k", "eff_from_ts").collect()]
    assert rows == [(1, "A", 10, None, at(0), at(24), False), (1, "A", 77, "OUT", at(24), at(48), False),
                    (1, "A", None, "IN", at(48), None, True), (2, "B", 5, None, at(1), None, True)]


def brute_intervals(rows):
    """State of a key at every time that matters, by scanning all rows."""
    rows = [r for r in rows if r[3] is None or r[3] > r[2]]
    out = []
    for k in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == k]
        times = sorted({r[2] for r in mine} | {r[3] for r in mine if r[3]})
        states = []
        for t in times:
            begun = [r for r in mine if r[2] <= t]
            last = max(begun, key=lambda r: (r[2], r[1]))
            states.append((t, last[4] if last[3] is None or last[3] > t else None))
        runs = [s for i, s in enumerate(states) if i == 0 or states[i - 1][1] != s[1]]
        out += [(k, v, t, runs[i + 1][0] if i + 1 < len(runs) else None) for i, (t, v) in enumerate(runs) if v is not None]
    return sorted(out, key=repr)


def test_interval_history_equals_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(120):
        f = rnd.randrange(0, 60)
        rows.append((rnd.choice([1, 1, 1, 2, 3]), i, at(f), rnd.choice([None, at(f + rnd.randrange(-3, 30))]), rnd.choice(["x", "y"])))
    df = spark.createDataFrame(rows, "k long, i long, f timestamp_ntz, t timestamp_ntz, v string")
    for width in (3600 * 5, 86400 * 30):
        got = H.interval_history(df, ["k"], "i", "f", "t", ["v"], "id", width)
        assert sorted([(r["k"], r["v"], r["eff_from_ts"], r["eff_to_ts"]) for r in got.collect()], key=repr) == brute_intervals(rows)
        assert got.where("is_current <> (eff_to_ts is null)").count() == 0 and got.select("id").distinct().count() == got.count()


def test_empty_sources(spark):
    none = spark.createDataFrame([], "k long, i long, f timestamp_ntz, t timestamp_ntz, v string")
    assert H.interval_history(none, ["k"], "i", "f", "t", ["v"], "id").collect() == []
    seen = H.observations(none, ["k"], F.col("f"), 0, "i", {"v": H.stated(F.col("v"))})
    assert H.merged_history([seen], ["k"], ["v"], "id").collect() == []


def test_history_plans_run_no_job(spark):
    df = spark.createDataFrame([(1, "A", T0, 1)], "k long, attr string, ts timestamp_ntz, tb long")
    spark.sparkContext.setJobGroup("history-plan", "plan only")
    scd2_build(df, "k", ["attr"], "ts", "tb")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("history-plan")
    spark.sparkContext.setJobGroup("", "")


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_short_and_long_keys_have_the_same_versions(spark):
    rnd = random.Random(11)
    rows = []
    for _ in range(300):  # ids repeat, also within a key and at one time
        f = rnd.randrange(0, 40)
        rows.append((rnd.choice([1, 1, 1, 1, 2, 3, None]), rnd.randrange(0, 60), at(f) if rnd.random() > 0.05 else None, rnd.choice([None, at(f + rnd.randrange(-3, 20))]),
                     rnd.choice(["x", "y", None]), rnd.choice([1, None])))
    df = spark.createDataFrame(rows, "k long, i long, f timestamp_ntz, t timestamp_ntz, v string, w long")
    short, long, both = [H.interval_history(df, ["k"], "i", "f", "t", ["v", "w"], "id", 3600 * 5, limit) for limit in (1000, 0, 60)]
    assert short.count() > 30 and _same(short, long) and _same(short, both)
    seen = [H.observations(df.dropDuplicates(["i"]), ["k"], F.col(c), r, "i", {"v": H.stated(F.col("v")), "w": H.stated_if(F.col("w") == 1, F.col("i"))}) for r, c in enumerate("ft")]
    short, long, both = [H.merged_history(seen, ["k"], ["v", "w"], "id", 3600 * 5, limit) for limit in (1000, 0, 20)]
    assert short.count() > 30 and _same(short, long) and _same(short, both)


def _shuffles(df):
    """Shuffles that ran, in the plan as AQE left it."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum(line.lstrip(" :+-*(0123456789)").startswith("Exchange") for line in final.splitlines())


def test_rows_of_short_keys_are_shuffled_once(spark):
    df = spark.createDataFrame([(i % 7, i, at(i % 50), at(i % 50 + 9), "xy"[i % 2]) for i in range(200)], "k long, i long, f timestamp_ntz, t timestamp_ntz, v string")
    assert _shuffles(H.interval_history(df, ["k"], "i", "f", "t", ["v"], "id")) <= 2  # the counts of the keys, the rows
    seen = H.observations(df, ["k"], F.col("f"), 0, "i", {"v": H.stated(F.col("v"))})
    assert _shuffles(H.merged_history([seen], ["k"], ["v"], "id")) <= 2
