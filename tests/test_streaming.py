"""Streaming jobs over several micro-batches equal the batch results."""
import os

from pyspark.sql import functions as F

from switchboard.operators import changelog
from switchboard.operators.tables import scratch_path
from switchboard.plans import views as V
from switchboard.sources import bridge as B
from switchboard.streaming import jobs as S

SF = "/root/testdata/sf0.01"


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _split_files(spark, df, n, name, col):
    """Land ``df`` as ``n`` parquet files in one folder, split on ``col``."""
    root = scratch_path(spark, name)
    for i in range(n):
        df.where(F.col(col) % n == i).coalesce(1).write.parquet(f"{root}/part{i}")
    return root


def _stream(spark, root, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(root))


def test_queue_hourly_stream_over_three_batches(spark):
    fx = B.Fixtures(spark, SF)
    li = fx("lineitem")
    root = _split_files(spark, li, 3, "li_split", "l_orderkey")
    src = B.fact_queue_interval(fx.with_tables({"lineitem": _stream(spark, root, li.schema)}))
    target, ck = scratch_path(spark, "qh_t"), scratch_path(spark, "qh_ck")
    q = S.queue_hourly_stream(src, target, ck, watermark="100000 days")
    q.awaitTermination(600)
    assert q.exception() is None and q.lastProgress is not None
    got = spark.read.parquet(target).select("queue_sk", "hour_of_day", "offered", "answered", "abandoned",
                                            "answered_in_sl", "date_key")
    exp = V.queue_hourly(B.fact_queue_interval(fx))
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0


def test_cdc_merge_stream_over_three_batches(spark):
    fx = B.Fixtures(spark, SF)
    ev = fx("events")
    # batches in time order: a change feed arrives chronologically
    root = scratch_path(spark, "ev_split")
    for i, (lo, hi) in enumerate([(1, 10), (10, 20), (20, 32)]):
        ev.where((F.dayofmonth("ts") >= lo) & (F.dayofmonth("ts") < hi)).coalesce(1).write.parquet(f"{root}/part{i}")
    from switchboard.plans.layer_jobs import _change_feed
    changes = _change_feed(fx.with_tables({"events": _stream(spark, root, ev.schema)}))
    target, ck = scratch_path(spark, "cdc_t"), scratch_path(spark, "cdc_ck")
    q = S.cdc_merge_stream(changes, ["user_id"], ["event_type", "value"], target, ck)
    q.awaitTermination(600)
    assert q.exception() is None
    got = changelog.ChangeLog(spark, target, ["user_id"], ["event_type", "value"]).current()
    exp = changelog.current(changelog.merge(None, _change_feed(fx), ["user_id"], ["event_type", "value"]), ["user_id"], ["event_type", "value"])
    assert got.count() == exp.count() and got.exceptAll(exp).count() == 0
    assert os.path.isdir(_local(target))


def test_sessions_in_append_mode_over_several_files(spark):
    """A session is written once, when the watermark has passed it; late events of it are dropped; state goes with it."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    m = lambda x: t0 + dt.timedelta(minutes=x)
    files = [[("a", m(0)), ("a", m(10)), ("b", m(5))], [("a", m(200)), ("b", m(20))], [("c", m(400))], [("a", m(12)), ("c", m(900))]]
    root = scratch_path(spark, "append_in")
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, "k string, ts timestamp_ntz").coalesce(1).write.parquet(f"{root}/part{i}")
    target, ck = scratch_path(spark, "append_t"), scratch_path(spark, "append_ck")
    q = S.session_stream(_stream(spark, root, spark.read.parquet(f"{root}/part0").schema), "k", "ts", "30 minutes", target, ck)
    q.awaitTermination(600)
    assert q.exception() is None
    got = sorted((r["k"], r["session_start"], r["session_end"], r["events"]) for r in spark.read.parquet(target).collect())
    assert got == [("a", m(0), m(40), 2), ("a", m(200), m(230), 1), ("b", m(5), m(50), 2), ("c", m(400), m(430), 1)]
    rows = [s.numRowsTotal for p in q.recentProgress for s in p.stateOperators]
    assert rows[-1] <= 2 and max(rows) < 5  # of five sessions in all


def test_a_partition_with_all_rows_is_written_by_many_tasks(spark):
    """Dates outside the declared range share one bucket; no task takes all of its rows."""
    target = scratch_path(spark, "one_bucket")
    df = spark.range(4000).select((F.col("id") % 50).alias("k"), F.col("id").alias("n"), F.lit(-1).cast("bigint").alias("b"))
    S._upsert_partitions(df, target, ["k", "n"], "b")
    again = df.where("n < 1000").withColumn("k", F.col("k") + 0)
    S._upsert_partitions(again, target, ["k", "n"], "b")
    got = spark.read.parquet(target)
    assert got.count() == 4000 and got.select("n").distinct().count() == 4000
    sizes = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 3000
