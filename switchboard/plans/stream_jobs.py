"""Registered runs of the streaming jobs (S1-S3) on the fixture tables.

Each run streams a fixture Parquet file through the job with an
``availableNow`` trigger, waits for it, and returns the target table. The
checkpoint and target live under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changelog import ChangeLog
from ..operators.tables import scratch_path
from ..sources import bridge as B
from ..streaming import jobs as S
from .layer_jobs import _change_feed

def _run(q) -> None:
    """Wait until the stream has read all there is, however long; raise what ended it early."""
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def queue_hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = B.Fixtures(spark, sf_dir)
    src = B.fact_queue_interval(fx.with_tables({"lineitem": fx.stream("lineitem")}))
    target, ck = scratch_path(spark, "queue_hourly_stream"), scratch_path(spark, "queue_hourly_stream_ck")
    _run(S.queue_hourly_stream(src, target, ck))
    return spark.read.parquet(target).select("queue_sk", "hour_of_day", "offered", "answered", "abandoned",
                                             "answered_in_sl", F.col("date_key").cast("bigint").alias("date_key"))


def cdc_merge_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = B.Fixtures(spark, sf_dir)
    changes = _change_feed(fx.with_tables({"events": fx.stream("events")}))
    target, ck = scratch_path(spark, "cdc_merge_stream"), scratch_path(spark, "cdc_merge_stream_ck")
    _run(S.cdc_merge_stream(changes, ["user_id"], ["event_type", "value"], target, ck))
    return ChangeLog(spark, target, ["user_id"], ["event_type", "value"]).current()


SESSION_GAP = "30 minutes"


def session_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = B.Fixtures(spark, sf_dir)
    ev = fx.stream("events").select("user_id", "ts")
    target, ck = scratch_path(spark, "session_stream"), scratch_path(spark, "session_stream_ck")
    # a bounded replay: complete mode so that sessions still open at the end
    # of the input are written too
    _run(S.session_stream(ev, "user_id", "ts", SESSION_GAP, target, ck, output_mode="complete"))
    return spark.read.parquet(target).select("user_id", "session_start", "session_end", "events")


def session_stream_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default (append) mode: sessions that the watermark has passed, each written once, its state dropped."""
    fx = B.Fixtures(spark, sf_dir)
    target, ck = scratch_path(spark, "session_stream_closed"), scratch_path(spark, "session_stream_closed_ck")
    _run(S.session_stream(fx.stream("events").select("user_id", "ts"), "user_id", "ts", SESSION_GAP, target, ck))
    return spark.read.parquet(target).select("user_id", "session_start", "session_end", "events")


STREAM_JOBS = {f.__name__: f for f in (queue_hourly_stream, cdc_merge_stream, session_stream, session_stream_closed)}
