"""Registered runs of the table-level jobs (L1-L8) on the fixture tables.

Each run writes its table under the shared checkpoint folder
(``spark.checkpoint.dir``), reads it back through the layout (partition
folders, bucket predicate, clustered files) and returns a summary whose
values the DuckDB oracle computes straight from the fixtures.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import tables as L
from ..operators import zonemap as Z
from ..operators.deltaview import SummedView
from ..sources import bridge as B
from ..sources.warehouse import Warehouse
from . import views as V


def _fx(spark, sf_dir):
    return B.Fixtures(spark, sf_dir)


def write_date_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = B.fact_interaction(_fx(spark, sf_dir)).withColumn("event_date", F.to_date("start_ts"))
    path = L.scratch_path(spark, "fact_interaction")
    L.write_date_partitioned(f, path, "event_date")
    back = spark.read.parquet(path)
    own = F.concat(F.lit("/event_date="), F.col("event_date").cast("string"), F.lit("/"))
    return back.groupBy(F.col("event_date").cast("date").alias("event_date")).agg(
        F.count(F.lit(1)).alias("row_count"), F.bool_and(F.contains(F.col("_metadata.file_path"), own)).alias("in_own_folder"))


SHIFT_YEARS = 250000  # fixture lineitem dates (1995-2001) moved into the 2020s range


def _bucket_feed(fx) -> DataFrame:
    """fact_queue_interval with keys shifted into the range, plus the edge keys
    of the layout: before the range, at its exclusive end, and NULL (the rows
    of queues 1, 2 and 3)."""
    f = B.fact_queue_interval(fx)
    q = F.col("queue_sk")
    key = (F.when(q == 1, F.lit(20191231)).when(q == 2, F.lit(20301201)).when(q == 3, F.lit(None))
           .otherwise(F.col("date_key") + SHIFT_YEARS))
    return f.withColumn("date_key", key.cast("bigint"))


PROBE_RANGE = (20210101, 20210331)


def write_range_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end, step = L.DATE_KEY_RANGE
    path = L.scratch_path(spark, "fact_queue_interval")
    L.write_range_bucketed(_bucket_feed(_fx(spark, sf_dir)), path, "date_key", start, end, step, ["queue_sk"])
    b = "date_key" + L.BUCKET_SUFFIX
    all_rows = spark.read.parquet(path).groupBy(F.col(b).cast("bigint").alias("bucket")).agg(
        F.count(F.lit(1)).alias("row_count"))
    probe = (L.read_range(spark, path, "date_key", *PROBE_RANGE, start, end, step)
             .groupBy(F.col(b).cast("bigint").alias("_pb")).agg(F.count(F.lit(1)).alias("probe_rows")))
    j = all_rows.join(probe, all_rows.bucket.eqNullSafe(probe._pb), "left")
    return j.select("bucket", "row_count", F.coalesce("probe_rows", F.lit(0)).alias("probe_rows"))


def write_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustered by (agent, state), with a zone map; how many of the files hold agent 1 is shown beside the counts."""
    path = L.scratch_path(spark, "fact_agent_activity")
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    Z.write_zoned(B.fact_agent_activity(_fx(spark, sf_dir)), path, ["agent_sk", "state_code"], num_partitions=n)
    found = Z.read_zoned(spark, path, {"agent_sk": (1, 1)})
    full = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("full_count"))
    part = found.rows.agg(F.count(F.lit(1)).alias("filtered_count"))
    # agent 1 is a fiftieth of the rows: two neighbouring files of a few, a tenth of many
    few = found.kept <= max(2, found.total // 10) < found.total
    return full.crossJoin(F.broadcast(part)).select("full_count", "filtered_count", F.lit(few).alias("skips_files"))


EXPIRE_AS_OF = dt.date(2024, 4, 15)


def expire_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _fx(spark, sf_dir)("events").select("event_id", "user_id", F.to_date("ts").alias("event_date"))
    path = L.scratch_path(spark, "events")
    L.write_date_partitioned(e, path, "event_date")
    L.expire_partitions(spark, path, "event_date", EXPIRE_AS_OF)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("event_date").cast("date").alias("event_date")).agg(F.count(F.lit(1)).alias("row_count"))


def refresh_materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materialise V16 from half of the base, then refresh only the date
    partitions the other half touches; the result must equal V16 on all."""
    fx = _fx(spark, sf_dir)
    li = fx("lineitem")
    old_li = li.where(F.col("l_orderkey") % 2 == 0)
    base_old = B.fact_queue_interval(fx.with_tables({"lineitem": old_li}))
    base_new = B.fact_queue_interval(fx)
    path = L.scratch_path(spark, "mv_agg_queue_hourly")
    L.refresh_materialized(V.queue_hourly(base_old), path, "date_key")
    touched = B.fact_queue_interval(fx.with_tables({"lineitem": li.where(F.col("l_orderkey") % 2 == 1)})).select("date_key")
    L.refresh_materialized(V.queue_hourly(base_new), path, "date_key", touched)
    back = spark.read.parquet(path)
    return back.select("queue_sk", "hour_of_day", "offered", "answered", "abandoned", "answered_in_sl", "date_key")


HOURLY = ["offered", "answered", "abandoned", "answered_in_sl"]


def refresh_by_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V16 stored from half of the lines, then kept by deltas: the other half comes, a tenth goes, a tenth changes."""
    fx = _fx(spark, sf_dir)
    k = F.col("l_orderkey")

    def hourly_rows(where):
        f = B.fact_queue_interval(fx.with_tables({"lineitem": fx("lineitem").where(where)}))
        return f.withColumn("hour_of_day", F.hour("interval_start_ts").cast("bigint"))
    view = SummedView(spark, L.scratch_path(spark, "mv_by_delta"), ["queue_sk", "hour_of_day", "date_key"], HOURLY)
    view.create(hourly_rows(k % 2 == 0))
    view.refresh(inserted=hourly_rows(k % 2 == 1))
    changed = hourly_rows(k % 10 == 2)
    view.refresh(inserted=changed.withColumn("offered", F.col("offered") + 1), deleted=changed.unionByName(hourly_rows(k % 10 == 0)))
    return view.rows()


AUDIT_TARGETS = {"event_id": "bigint", "ts": "timestamp", "value": "decimal(12,2)", "props": "bigint",
                 "created_ms": "bigint", "start_epoch": "bigint"}


def conformance_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a landed (all-text) copy of events against its target types."""
    e = _fx(spark, sf_dir)("events")
    ms = X.epoch_millis("ts")
    landed = e.select(F.col("event_id").cast("string").alias("event_id"), F.col("ts").cast("string").alias("ts"),
                      F.when(F.col("event_id") % 50 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
                      F.col("props"), ms.cast("bigint").cast("string").alias("created_ms"),
                      F.when(F.col("event_id") % 40 == 0, ms.cast("bigint")).otherwise(X.epoch_seconds("ts"))
                      .cast("string").alias("start_epoch"))
    return L.conformance_audit(landed, AUDIT_TARGETS, epoch_ms_cols=("created_ms",), epoch_s_cols=("start_epoch",))


def key_integrity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    wh = Warehouse.fixtures(spark, sf_dir)
    return L.key_integrity_audit([
        ("lineitem_duplicate_order_line", L.duplicate_keys(fx("lineitem"), ["l_orderkey", "l_linenumber"])),
        ("supplier_duplicate_key", L.duplicate_keys(fx("supplier"), ["s_suppkey"])),
        ("orders_orphan_customer", L.orphans(fx("orders"), fx("customer"), "o_custkey", "c_custkey")),
        ("fact_interaction_orphan_agent", L.orphans(wh["fact_interaction"], wh["dim_agent"], "agent_sk", "agent_sk")),
        ("ods_invoice_orphan_staged", L.orphans(wh["ods_invoice_acid"], wh["stg_fin_invoice"], "invoice_id", "invoice_id")),
        ("stg_invoice_missing_in_ods", L.orphans(wh["stg_fin_invoice"], wh["ods_invoice_acid"], "invoice_id", "invoice_id")),
    ])


def layer_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = Warehouse.fixtures(spark, sf_dir)
    staged = wh["stg_fin_invoice"].withColumn("period_month", X.month_start(X.millis_to_ts("issued_ts_sec")))
    ods = wh["ods_invoice_acid"].withColumn("period_month", X.month_start("issued_ts"))
    r = L.layer_reconcile(staged, ods, ["period_month"], "total_amount")
    return r.select("period_month", "staged_rows", "ods_rows", F.col("staged_sum").cast("decimal(24,2)").alias("staged_sum"),
                    F.col("ods_sum").cast("decimal(24,2)").alias("ods_sum"), "recon_status")


TABLE_JOBS = {f.__name__: f for f in (
    write_date_partitioned, write_range_bucketed, write_clustered, expire_partitions, refresh_materialized, refresh_by_delta,
    conformance_audit, key_integrity_audit, layer_reconcile)}
