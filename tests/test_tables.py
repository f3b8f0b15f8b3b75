"""Layout jobs: range buckets, pruning, clustering, expiration, MV refresh."""
import datetime as dt
import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from switchboard.operators import tables as L


def test_range_bucket_is_one_month_for_valid_keys(spark):
    keys = [20200101, 20200131, 20200201, 20241231, 20301130, 20191231, 20301201, None]
    df = spark.createDataFrame([(k,) for k in keys], "date_key long")
    got = [r["b"] for r in df.select(L.range_bucket("date_key", *L.DATE_KEY_RANGE).alias("b")).collect()]
    assert got == [0, 0, 1, 411, 1010, -1, -1, None]


def test_read_range_prunes_bucket_folders(spark):
    df = spark.range(0, 2000).select(
        (F.lit(20200101) + (F.col("id") % 24) * 100 + F.col("id") % 28).cast("long").alias("date_key"),
        F.col("id").alias("v"))
    path = L.scratch_path(spark, "t_bucket")
    L.write_range_bucketed(df, path, "date_key", *L.DATE_KEY_RANGE)
    r = L.read_range(spark, path, "date_key", 20200301, 20200415, *L.DATE_KEY_RANGE)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date_key__bucket" in plan
    exp = df.where(F.col("date_key").between(20200301, 20200415)).count()
    assert r.count() == exp


def test_clustered_files_have_disjoint_key_ranges(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("agent_sk"), F.col("id").alias("v"))
    path = L.scratch_path(spark, "t_clustered")
    L.write_clustered(df, path, ["agent_sk"], num_partitions=5)
    ranges = []
    local = path[len("file:"):] if path.startswith("file:") else path
    for f in glob.glob(os.path.join(local, "*.parquet")):
        st = pq.ParquetFile(f).metadata.row_group(0).column(0).statistics
        ranges.append((st.min, st.max))
    ranges.sort()
    assert len(ranges) >= 2
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_expire_partitions_drops_only_old_dates(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(0, 120, 10)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "d date, v long")
    path = L.scratch_path(spark, "t_expire")
    L.write_date_partitioned(df, path, "d")
    dropped = L.expire_partitions(spark, path, "d", dt.date(2024, 5, 1), days=90)
    cutoff = dt.date(2024, 5, 1) - dt.timedelta(days=90)
    assert dropped == sorted(str(d) for d in days if d < cutoff)
    assert sorted(r["d"] for r in spark.read.parquet(path).collect()) == [d for d in days if d >= cutoff]


def test_refresh_touches_only_given_partitions(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "date_key long, v long")
    path = L.scratch_path(spark, "t_mv")
    L.refresh_materialized(a, path, "date_key", key_range=None)
    b = spark.createDataFrame([(1, 11), (2, 99), (3, 30)], "date_key long, v long")
    touched = spark.createDataFrame([(1,), (3,)], "date_key long")
    L.refresh_materialized(b, path, "date_key", touched, key_range=None)
    got = sorted((r["date_key"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, 11), (2, 20), (3, 30)]


def test_refresh_in_month_buckets(spark):
    a = spark.createDataFrame([(20240105, 10), (20240210, 20), (20240215, 21)], "date_key long, v long")
    path = L.scratch_path(spark, "t_mv_b")
    L.refresh_materialized(a, path, "date_key")
    b = spark.createDataFrame([(20240105, 11), (20240210, 99), (20240215, 98), (20240301, 30)], "date_key long, v long")
    touched = spark.createDataFrame([(20240106,), (20240302,)], "date_key long")  # January and March changed
    L.refresh_materialized(b, path, "date_key", touched)
    back = spark.read.parquet(path)
    assert sorted((r["date_key"], r["v"]) for r in back.collect()) == [
        (20240105, 11), (20240210, 20), (20240215, 21), (20240301, 30)]
    assert L.list_partitions(spark, path, "date_key__bucket") and len(L.list_partitions(spark, path, "date_key__bucket")) == 3


def test_layer_reconcile_statuses(spark):
    s = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 1.0), (3, 2.0)], "k long, x double")
    o = spark.createDataFrame([(1, 10.0), (2, 1.5), (4, 1.0)], "k long, x double")
    got = {r["k"]: r["recon_status"] for r in L.layer_reconcile(s, o, ["k"], "x").collect()}
    assert got == {1: "ROW_COUNT_MISMATCH", 2: "SUM_MISMATCH", 3: "MISSING_IN_ODS", 4: "MISSING_IN_STAGING"}


def test_expire_table_uses_declared_layout(spark):
    from switchboard.sources import schemas
    root = L.scratch_path(spark, "t_layout")
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(0, 150, 30)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "call_id long, load_date date")
    L.write_date_partitioned(df, f"{root}/stg_tel_call", "load_date")
    assert schemas.LAYOUT["stg_tel_call"][2] == 90
    dropped = L.expire_table(spark, root, "stg_tel_call", dt.date(2026, 6, 2))
    assert dropped == [str(d) for d in days if d < dt.date(2026, 6, 2) - dt.timedelta(days=90)]
    assert L.expire_table(spark, root, "fact_interaction", dt.date(2026, 6, 2)) == []


def test_date_partition_filter_from_string_literal_prunes(spark):
    df = spark.range(0, 300).select(F.col("id").alias("call_id"),
                                    F.date_add(F.lit(dt.date(2026, 5, 30)), (F.col("id") % 6).cast("int")).alias("load_date"))
    path = L.scratch_path(spark, "t_stg_tel_call")
    L.write_date_partitioned(df, path, "load_date")
    q = spark.read.parquet(path).where("load_date = '2026-06-02'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan and "2026-06-02" in plan
    assert q.count() == 50


def test_cluster_key_predicate_is_pushed_and_skips_files(spark):
    df = spark.range(0, 20000).select((F.col("id") * 7919 % 500).alias("agent_sk"), F.col("id").alias("v"))
    path = L.scratch_path(spark, "t_clustered_push")
    L.write_clustered(df, path, ["agent_sk"], num_partitions=8)
    q = spark.read.parquet(path).where(F.col("agent_sk") == 1)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(agent_sk), EqualTo(agent_sk,1)]" in plan
    assert q.count() == 40
    # file-level min/max: only the file whose range holds 1 can match
    local = path[len("file:"):] if path.startswith("file:") else path
    hits = 0
    for f in glob.glob(os.path.join(local, "*.parquet")):
        st = pq.ParquetFile(f).metadata.row_group(0).column(0).statistics
        hits += st.min <= 1 <= st.max
    assert hits == 1
