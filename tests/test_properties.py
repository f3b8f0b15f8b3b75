"""Property tests: distributed order operators equal Spark's windows / brute
force on random data (skewed and NULL keys, duplicate times, any partition
count)."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from switchboard.operators.intervals import count_points_in_windows
from switchboard.operators.ordered import with_global_ntile
from switchboard.operators.timeline import as_of, carry_forward, ordered_concat, with_next, with_previous

T0 = dt.datetime(2024, 1, 1)
KEYS = st.one_of(st.none(), st.sampled_from(["hot", "hot", "hot", "a", "b", "c"]))
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 40), st.integers(0, 9)), min_size=1, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def table(spark, rows):
    data = [(i, k, T0 + dt.timedelta(hours=h), v) for i, (k, h, v) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, k string, ts timestamp_ntz, v long")


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 7))
def test_ranged_lag_property(spark, rows, parts):
    df = table(spark, rows)
    w = Window.partitionBy("k").orderBy("ts", "id")
    exp = df.withColumns({"p": F.lag("v").over(w), "n": F.lead("v").over(w)})
    got = with_next(with_previous(df, ["k"], "ts", ["id"], "v", "p", width=parts * 1800), ["k"], "ts", ["id"], "v", "n", width=parts * 1800)
    assert sorted(map(tuple, got.select("id", "p", "n").collect()), key=repr) == sorted(map(tuple, exp.select("id", "p", "n").collect()), key=repr)


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 7))
def test_carry_forward_property(spark, rows, parts):
    df = table(spark, rows).withColumn("v", F.when(F.col("v") < 5, F.col("v")))
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    got = carry_forward(df, ["k"], "ts", ["id"], {"v": "p"}, width=parts * 3600)
    exp = df.withColumn("p", F.last("v", ignorenulls=True).over(w))
    assert sorted(map(tuple, got.select("id", "p").collect()), key=repr) == sorted(map(tuple, exp.select("id", "p").collect()), key=repr)


@SETTINGS
@given(rows=ROWS, versions=ROWS, parts=st.integers(1, 7))
def test_as_of_property(spark, rows, versions, parts):
    facts, held = table(spark, rows), table(spark, versions)
    got = as_of(facts, held, {"k": "k"}, "ts", "ts", {"id": "version"}, ["id"], width=parts * 3600)
    exp = {}
    for i, (k, h, _) in enumerate(rows):
        exp[i] = max(((vh, j) for j, (vk, vh, _) in enumerate(versions) if k is not None and vk == k and vh <= h), default=(None, None))[1]
    assert {r["id"]: r["version"] for r in got.collect()} == exp and got.columns == [*facts.columns, "version"]


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 7), buckets=st.integers(1, 6))
def test_global_ntile_property(spark, rows, parts, buckets):
    df = table(spark, rows)
    got = with_global_ntile(df, buckets, [F.col("v"), F.col("id")], "t", num_partitions=parts)
    exp = df.withColumn("t", F.ntile(buckets).over(Window.orderBy("v", "id")).cast("bigint"))
    assert sorted(map(tuple, got.select("id", "t").collect())) == sorted(map(tuple, exp.select("id", "t").collect()))


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 7), width=st.integers(0, 12))
def test_interval_count_property(spark, rows, parts, width):
    df = table(spark, rows)
    probes = df.select(F.col("id").alias("pid"), "k", F.col("ts").alias("lo"),
                       F.timestamp_add("HOUR", F.lit(width), F.col("ts")).alias("hi"))
    got = count_points_in_windows(df, probes, key="k", ts="ts", lo="lo", hi="hi", carry=["pid"], out="m", width=parts * 3600)
    pts = [(k, T0 + dt.timedelta(hours=h)) for k, h, _ in rows]
    exp = {}
    for i, (k, h, _) in enumerate(rows):
        lo = T0 + dt.timedelta(hours=h)
        hi = lo + dt.timedelta(hours=width)
        exp[i] = 0 if k is None else sum(1 for pk, pt in pts if pk == k and lo < pt <= hi)
    assert {r["pid"]: r["m"] for r in got.collect()} == exp


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 7))
def test_ordered_concat_property(spark, rows, parts):
    df = table(spark, rows).withColumn("s", F.when(F.col("v") == 0, F.lit(None)).otherwise(F.col("v").cast("string")))
    got = ordered_concat(df, ["k"], "ts", ["id"], "s", ",", "path", width=parts * 3600)
    each = F.array_sort(F.collect_list(F.struct("ts", "id", "s")))
    exp = df.groupBy("k").agg(F.array_join(F.transform(each, lambda x: x["s"]), ",").alias("path"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, exp.collect()), key=repr)
