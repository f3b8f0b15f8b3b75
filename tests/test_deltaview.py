"""Signed deltas: the stored view equals recomputation after inserts, updates and deletes; zone maps leave files out."""
import pytest
from pyspark.sql import functions as F

from switchboard.operators import deltaview as D
from switchboard.operators import zonemap as Z
from switchboard.operators.tables import scratch_path, write_date_partitioned
from switchboard.plans import views as V

SCHEMA = "k long, v long, w decimal(12,2), date_key long"


def rows(spark, data):
    return spark.createDataFrame(data, "k long, v long, w double, date_key long").withColumn("w", F.col("w").cast("decimal(12,2)"))


def plain(df):
    return sorted([tuple(r) for r in df.groupBy("k", "date_key").agg(F.sum("v"), F.sum("w")).collect()], key=repr)


def shown(view):
    return sorted([(r["k"], r["date_key"], r["v"], r["w"]) for r in view.rows().collect()], key=repr)


def test_refresh_equals_recomputation(spark):
    base = [(i % 5, i, i / 4, 20240101 + (i % 3) * 100) for i in range(60)] + [(None, 1, 1.0, 20240101), (1, None, 2.0, None), (9, None, None, 20250101), (7, 3, 1.5, 20190101)]
    view = D.SummedView(spark, scratch_path(spark, "delta"), ["k", "date_key"], ["v", "w"])
    view.create(rows(spark, base))
    assert shown(view) == plain(rows(spark, base))
    gone = [r for r in base if r[0] == 2 or r[3] in (20250101, 20190101)]
    came = [(11, 5, 0.25, 20260501), (1, 8, None, None), (3, -4, 0.75, 20240201)]
    changed = [(r, (r[0], (r[1] or 0) + 1, r[2], r[3])) for r in base if r[0] == 4]
    view.refresh(inserted=rows(spark, came + [n for _, n in changed]), deleted=rows(spark, gone + [o for o, _ in changed]))
    left = [r for r in base if r not in gone and r[0] != 4] + came + [n for _, n in changed]
    assert shown(view) == plain(rows(spark, left))
    view.refresh(inserted=rows(spark, left).limit(0))
    assert shown(view) == plain(rows(spark, left))
    view.refresh(deleted=rows(spark, [r for r in left if r[3] == 20260501]))
    assert shown(view) == plain(rows(spark, [r for r in left if r[3] != 20260501]))


def test_a_refresh_reads_only_the_folders_it_touches(spark):
    view = D.SummedView(spark, scratch_path(spark, "delta_plan"), ["k", "date_key"], ["v"])
    view.create(rows(spark, [(1, 1, 1.0, 20240101 + m * 100) for m in range(6)]))
    read = view.stored([400, None])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date_key__bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r["date_key"] for r in read.collect()} == {20240101}


def test_zone_map_opens_few_files_of_a_clustered_table_and_all_of_a_plain_one(spark):
    df = spark.range(4000).select((F.col("id") % 100).alias("a"), (F.col("id") % 7).alias("b"), F.when(F.col("id") % 3 != 0, F.col("id")).alias("c"))
    path = scratch_path(spark, "zoned")
    Z.write_zoned(df, path, ["a", "b"], num_partitions=10)
    found = Z.read_zoned(spark, path, {"a": (42, 43), "b": (0, 3)})
    assert found.total == 10 and found.kept <= 2
    assert found.rows.count() == df.where("a between 42 and 43 and b <= 3").count()
    assert Z.read_zoned(spark, path, {"a": (500, 600)})[1:] == (0, 10) and Z.read_zoned(spark, path, {"a": (500, 600)}).rows.count() == 0
    nothing = Z.read_zoned(spark, path, {"a": (500, 600)}).rows.agg(F.count_distinct("_metadata.file_path").alias("n")).first()
    assert nothing["n"] == 0
    assert Z.read_zoned(spark, path, {"c": (5, 9)}).rows.count() == df.where("c between 5 and 9").count()
    dealt = scratch_path(spark, "dealt")
    df.repartition(10).write.parquet(dealt)
    Z.write_zones(spark, dealt, ["a", "b"])
    assert Z.read_zoned(spark, dealt, {"a": (42, 43)}).kept == 10
    with pytest.raises(ValueError):
        Z.write_zoned(df, path, ["a", "b", "c", "a"])


def test_zone_map_of_a_partitioned_table_keeps_the_partition_column(spark):
    df = spark.range(200).select(F.col("id").alias("a"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("d"))
    path = scratch_path(spark, "zoned_p")
    Z.write_zoned(df, path, ["a"], partition_col="d", num_partitions=4)
    import datetime as dt
    found = Z.read_zoned(spark, path, {"d": (dt.date(2024, 1, 2), dt.date(2024, 1, 2))})
    assert found.kept < found.total and found.rows.count() == 50


def test_dates_land_in_their_folders(spark):
    df = spark.range(100).select(F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("d"))
    path = scratch_path(spark, "dated")
    write_date_partitioned(df, path, "d")
    files = spark.read.parquet(path).select("d", F.col("_metadata.file_path").alias("f")).distinct().collect()
    assert all(f"/d={r['d']}/" in r["f"] for r in files)


def test_sketches_roll_up_without_the_base(spark):
    f = spark.range(3000).select((F.col("id") % 3).alias("date_key"), (F.col("id") % 700).alias("agent_sk"), F.lit("V").alias("channel"))
    d = spark.range(700).select(F.col("id").alias("agent_sk"), F.concat(F.lit("S"), (F.col("id") % 2).cast("string")).alias("site_code"))
    path = scratch_path(spark, "sketches")
    V.active_agents_sketches(f, d).write.parquet(path)
    stored = spark.read.parquet(path)
    whole = V.active_agents_over(stored).first()
    assert abs(whole["approx_active_agents"] - 700) <= 70 and whole["interactions"] == 3000
    sites = {r["site_code"]: r["approx_active_agents"] for r in V.active_agents_over(stored, "site_code").collect()}
    assert all(abs(n - 350) <= 35 for n in sites.values())
