"""Distributed order operators against Spark's own windows / brute force,
on data with one key holding a third of all rows."""
import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from switchboard.operators.intervals import count_points_in_windows
from switchboard.operators.ordered import (with_global_ntile, with_global_percent_rank,
                                           with_global_row_number)
from switchboard.operators.timeline import ordered_concat, with_previous


def skewed(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "HOT" if i % 3 == 0 else f"k{rnd.randint(0, 200)}"
        if i % 97 == 0:
            key = None
        rows.append((i, key, rnd.randint(0, 50), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 20000))))
    return spark.createDataFrame(rows, "id long, k string, v long, ts timestamp_ntz")


def test_global_row_number_matches_window(spark):
    df = skewed(spark)
    got = with_global_row_number(df, [F.col("v"), F.col("id")], "rn", num_partitions=7)
    exp = df.withColumn("rn", F.row_number().over(Window.orderBy("v", "id")))
    assert got.select("id", "rn").exceptAll(exp.select("id", "rn")).count() == 0
    assert got.count() == df.count()


def test_global_ntile_matches_window(spark):
    df = skewed(spark, n=1003)
    for b in (4, 5, 7):
        got = with_global_ntile(df, b, [F.col("v"), F.col("id")], "t", num_partitions=5)
        exp = df.withColumn("t", F.ntile(b).over(Window.orderBy("v", "id")))
        assert got.select("id", "t").exceptAll(exp.select("id", F.col("t").cast("bigint"))).count() == 0


def test_global_percent_rank_matches_window(spark):
    df = skewed(spark, n=777)
    got = with_global_percent_rank(df, "v", [F.col("id")], "pr", num_partitions=6)
    exp = df.withColumn("pr", F.percent_rank().over(Window.orderBy("v")))
    g = {r["id"]: r["pr"] for r in got.collect()}
    e = {r["id"]: r["pr"] for r in exp.collect()}
    assert g.keys() == e.keys() and all(abs(g[k] - e[k]) < 1e-12 for k in g)


def test_ranged_lag_matches_window_with_hot_key(spark):
    df = skewed(spark)
    got = with_previous(df, ["k"], "ts", ["id"], "ts", "prev")
    exp = df.withColumn("prev", F.lag("ts").over(Window.partitionBy("k").orderBy("ts", "id")))
    assert got.select("id", "prev").exceptAll(exp.select("id", "prev")).count() == 0
    assert got.count() == df.count()


def test_lag_does_not_depend_on_the_bucket_width(spark):
    df = skewed(spark)
    exp = df.withColumn("prev", F.lag("ts").over(Window.partitionBy("k").orderBy("ts", "id")))
    for width in (60, 86400 * 400):
        got = with_previous(df, ["k"], "ts", ["id"], "ts", "prev", width=width)
        assert got.select("id", "prev").exceptAll(exp.select("id", "prev")).count() == 0


def test_interval_counts_match_brute_force(spark):
    df = skewed(spark, n=1200)
    probes = df.select(F.col("id").alias("pid"), "k", F.col("ts").alias("lo"),
                       F.timestamp_add("HOUR", F.lit(36), F.col("ts")).alias("hi"))
    got = count_points_in_windows(df, probes, key="k", ts="ts", lo="lo", hi="hi", carry=["pid"], out="m")
    got_w = count_points_in_windows(df, probes, key="k", ts="ts", lo="lo", hi="hi", carry=["pid"], out="m", width=7 * 86400)
    rows = df.collect()
    expected = {}
    for p in rows:
        lo, hi = p["ts"], p["ts"] + dt.timedelta(hours=36)
        expected[p["id"]] = 0 if p["k"] is None else sum(
            1 for q in rows if q["k"] == p["k"] and lo < q["ts"] <= hi)
    assert {r["pid"]: r["m"] for r in got.collect()} == expected
    assert {r["pid"]: r["m"] for r in got_w.collect()} == expected


def test_interval_counts_with_duplicate_points(spark):
    t0 = dt.datetime(2024, 1, 1)
    pts = [(i, "c", t0 + dt.timedelta(hours=1)) for i in range(50)] + [(100, "c", t0 + dt.timedelta(hours=5))]
    df = spark.createDataFrame(pts, "id long, k string, ts timestamp_ntz")
    probes = spark.createDataFrame([(1, "c", t0, t0 + dt.timedelta(hours=2)), (2, "c", t0, t0 + dt.timedelta(hours=2)),
                                    (3, "c", t0 + dt.timedelta(hours=1), t0 + dt.timedelta(hours=6)), (4, None, t0, t0)],
                                   "pid long, k string, lo timestamp_ntz, hi timestamp_ntz")
    for width in (600, 3600, 86400):
        got = count_points_in_windows(df, probes, key="k", ts="ts", lo="lo", hi="hi", carry=["pid"], out="m", width=width)
        assert {r["pid"]: r["m"] for r in got.collect()} == {1: 50, 2: 50, 3: 1, 4: 0}
    repeated = probes.drop("pid")
    got = count_points_in_windows(df, repeated, key="k", ts="ts", lo="lo", hi="hi", carry=["k"], out="m")
    assert sorted(r["m"] for r in got.collect()) == [0, 1, 50, 50]


def test_ordered_concat_matches_collect(spark):
    df = skewed(spark, n=2000).select("k", F.lit("c").alias("c"), "ts", "id",
                                      F.when(F.col("id") % 13 == 0, F.lit(None)).when(F.col("id") % 17 == 0, F.lit(""))
                                      .otherwise(F.col("v").cast("string")).alias("s"))
    a = ordered_concat(df, ["k", "c"], "ts", ["id"], "s", " > ", "path")
    rows = F.array_sort(F.collect_list(F.struct("ts", "id", "s")))
    b = df.groupBy("k", "c").agg(F.array_join(F.transform(rows, lambda x: x["s"]), " > ").alias("path"))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_hot_key_is_many_groups(spark):
    from switchboard.operators import timeline
    df = skewed(spark, n=6000)
    hot = df.where(F.col("k") == "HOT")
    assert hot.count() > 6000 // 3 - 50   # about a third of all rows
    groups = hot.groupBy(timeline.bucket(df, "ts").alias("b")).count().agg(F.max("count").alias("m"), F.count("*").alias("n")).first()
    assert groups["n"] > 50 and groups["m"] < hot.count() / 10


def test_hot_key_is_split_across_range_partitions(spark):
    df = skewed(spark, n=6000)
    assert df.where(F.col("k") == "HOT").count() > 6000 // 3 - 50   # about a third of all rows
    ranged = df.repartitionByRange(8, F.col("k").asc_nulls_first(), F.col("ts"), F.col("id"))
    sizes = [r["n"] for r in ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    hot_parts = ranged.where(F.col("k") == "HOT").select(F.spark_partition_id()).distinct().count()
    assert hot_parts >= 2 and max(sizes) <= 2 * (6000 / 8)


def test_stepped_row_number_matches_window(spark):
    from switchboard.operators.ordered import ntile_of, with_stepped_row_number
    df = skewed(spark, n=900).withColumn("v", F.when(F.col("id") % 50 != 0, F.col("v")))
    spark.sparkContext.setJobGroup("stepped", "plan")
    got = with_stepped_row_number(df, [F.floor(F.col("v") / 3), F.col("v"), F.floor(F.col("id") / 100)], [F.col("v"), F.col("id")], "rn")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("stepped")
    spark.sparkContext.setJobGroup("", "")
    w = Window.orderBy("v", "id")
    exp = df.withColumns({"rn": F.row_number().over(w).cast("bigint"), "t": F.ntile(7).over(w).cast("bigint")})
    out = got.withColumn("t", ntile_of(F.col("rn"), F.col("_sb_total"), 7)).drop("_sb_total").select(*exp.columns)
    assert out.count() == 900 and out.exceptAll(exp).count() == 0
