"""``as_of`` of short keys (one window), long keys (buckets) and both."""
import datetime as dt
import random

from pyspark.sql import functions as F

from switchboard.operators.timeline import as_of, long_keys, split_long

T0 = dt.datetime(2024, 1, 1)


def test_short_and_long_keys_find_the_same_versions(spark):
    rnd = random.Random(3)
    when = lambda: rnd.choice([None, *[T0 + dt.timedelta(minutes=rnd.randrange(3000)) for _ in range(15)]])
    key = lambda: rnd.choice([None, 1, 1, 1, 2, 3])
    vs = [(key(), when(), i) for i in range(60)]
    fs = [(key(), when(), i) for i in range(200)]
    versions = spark.createDataFrame(vs, "a long, since timestamp_ntz, sk long")
    facts = spark.createDataFrame(fs, "agent long, ts timestamp_ntz, n long")

    def brute(a, t):
        held = [(v[1], v[2]) for v in vs if None not in (a, t, v[0], v[1]) and v[0] == a and v[1] <= t]
        return max(held)[1] if held else None
    for limit in (10_000, 60, 0):
        got = as_of(facts, versions, {"agent": "a"}, "ts", "since", {"sk": "at"}, ["sk"], limit=limit)
        assert sorted(map(tuple, got.select("n", "at").collect())) == [(n, brute(a, t)) for a, t, n in fs]


def test_null_keys_are_counted_and_split(spark):
    df = spark.createDataFrame([(None, 1)] * 5 + [(1, None)] * 2 + [(1, 1)] * 4, "a long, b long")
    short, long = split_long(df, ["a", "b"], long_keys(df, ["a", "b"], 3))
    assert short.count() == 2 and long.count() == 9 and long.where(F.col("a").isNull()).count() == 5


def test_facts_of_short_keys_are_shuffled_once(spark):
    versions = spark.createDataFrame([(1, T0, 7)], "a long, since timestamp_ntz, sk long")
    facts = spark.range(100).select((F.col("id") % 9).alias("agent"), F.lit(T0).cast("timestamp_ntz").alias("ts"))
    df = as_of(facts, versions, {"agent": "a"}, "ts", "since", {"sk": "at"})
    assert df.where("at = 7").count() == 11
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum(line.lstrip(" :+-*(0123456789)").startswith("Exchange") for line in final.splitlines()) <= 2
