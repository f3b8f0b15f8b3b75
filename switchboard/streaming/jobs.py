"""Structured Streaming versions of the incremental ideas.

The reference has no streaming code; it has materialized views that the
warehouse refreshes incrementally and change feeds. These jobs keep the
same results up to date from file streams:

* S1 ``queue_hourly_stream`` - V16 as a watermarked 1-hour window
  aggregation; each micro-batch upserts the touched (queue, hour) groups
  into a date-partitioned table (dynamic overwrite of touched dates only);
* S2 ``cdc_merge_stream`` - T6: each micro-batch is an increment of a change
  log with tombstones, merged when it is read;
* S3 ``session_stream`` - gap-based sessions (``session_window``) per
  customer, upserted by (customer, session start).

State lives in the streaming checkpoint; targets and checkpoints live in the
shared folder named by ``spark.checkpoint.dir``. Event time is TIMESTAMP_NTZ
in the tables; watermarks need TIMESTAMP, so it is converted through epoch
micros (no session-zone dependence).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import exprs as X
from ..operators.changelog import ChangeLog
from ..operators.tables import BUCKET_SUFFIX, DATE_KEY_RANGE, range_bucket
from ..session import ensure_checkpoint_dir


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _upsert_partitions(batch: DataFrame, target: str, keys: list[str], partition_col: str) -> None:
    """Replace the batch's groups inside the partitions it touches.

    Existing rows of touched partitions that the batch does not update are
    kept; the merged rows are checkpointed (cutting the read of ``target``)
    and written with dynamic partition overwrite. Tasks take ranges of
    (partition, keys), so a partition with all the rows is many tasks' files.
    """
    spark = batch.sparkSession
    ensure_checkpoint_dir(spark)
    batch = batch.persist()  # read twice below; recomputable from the stream's batch
    try:
        # as many partitions as the batch falls into; their names filter the read of the target at its folders
        touched = [r[0] for r in batch.select(partition_col).distinct().collect()]
        if not touched:
            return
        merged = batch
        if _exists(spark, target):
            named = [t for t in touched if t is not None]
            within = F.col(partition_col).isin(named) if named else F.lit(False)
            old = spark.read.schema(batch.schema).parquet(target).where(within | F.col(partition_col).isNull() if None in touched else within)
            old = old.join(batch.select(*keys), keys, "left_anti").select(*batch.columns)
            merged = batch.unionByName(old)
        merged = merged.checkpoint(eager=True)
    finally:
        batch.unpersist()
    (merged.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), partition_col, *keys)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(target))


def queue_hourly_stream(fact_queue_interval: DataFrame, target: str, checkpoint: str,
                        watermark: str = "2 hours", available_now: bool = True) -> StreamingQuery:
    """Hourly queue sums kept current from a stream of interval rows."""
    f = fact_queue_interval.withColumn("_t", X.ntz_to_instant("interval_start_ts")).withWatermark("_t", watermark)
    agg = f.groupBy("queue_sk", F.window("_t", "1 hour").alias("_w")).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("offered", "answered", "abandoned", "answered_in_sl")])
    start = X.instant_to_ntz(F.col("_w.start"))
    out = agg.select("queue_sk", F.hour(start).cast("bigint").alias("hour_of_day"), "offered", "answered",
                     "abandoned", "answered_in_sl", X.date_key(start).alias("date_key"))

    def write(batch: DataFrame, _epoch: int) -> None:
        # stored in the table's layout: month buckets of date_key
        b = batch.withColumn("date_key" + BUCKET_SUFFIX, range_bucket("date_key", *DATE_KEY_RANGE))
        _upsert_partitions(b, target, ["queue_sk", "hour_of_day", "date_key"], "date_key" + BUCKET_SUFFIX)

    w = out.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def cdc_merge_stream(changes: DataFrame, keys: list[str], payload: list[str], target: str, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """A change feed as increments of the change log at ``target`` (T6), one a micro-batch.

    A micro-batch is written as its number's increment and rewrites nothing; a
    replayed one replaces itself. Deletes are kept, so a late update does not
    bring a row back. Readers take ``ChangeLog(...).current()``; compaction is
    a job of its own.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        ChangeLog(batch.sparkSession, target, keys, payload).append(batch, epoch)

    w = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def session_stream(events: DataFrame, key: str, ts: str, gap: str, target: str, checkpoint: str,
                   watermark: str = "1 hour", available_now: bool = True,
                   output_mode: str = "append") -> StreamingQuery:
    """S3: gap-based sessions per key (session_window), upserted by
    (key, session start) into a table partitioned by the session's date.

    ``append`` (default, unbounded streams): a session is written once the
    watermark has passed its end, and its state is then dropped.
    ``complete``: every batch re-emits all sessions - exact at the end of a
    bounded replay, but state is never evicted.
    """
    e = events.withColumn("_t", X.ntz_to_instant(ts)).withWatermark("_t", watermark)
    agg = e.groupBy(key, F.session_window("_t", gap).alias("_s")).agg(F.count(F.lit(1)).alias("events"))
    start, end = X.instant_to_ntz(F.col("_s.start")), X.instant_to_ntz(F.col("_s.end"))
    out = agg.select(key, start.alias("session_start"), end.alias("session_end"), "events",
                     F.to_date(start).alias("session_date"))

    def write(batch: DataFrame, _epoch: int) -> None:
        _upsert_partitions(batch, target, [key, "session_start"], "session_date")

    w = out.writeStream.outputMode(output_mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
