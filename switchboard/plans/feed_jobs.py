"""Registered round trips through the landed-feed readers.

Each run lands a fixture-derived feed in its source format under the shared
checkpoint folder (pipe-delimited text, CSV with quoting, JSON lines with
nested arrays, raw log lines), reads it back with the declared schema
through ``sources.feeds`` and runs the transform that consumes it. The
oracle is the same transform computed in SQL straight from the fixtures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import changelog
from ..operators import transforms as T
from ..operators.tables import scratch_path
from ..sources import bridge as B
from ..sources import feeds
from .layer_jobs import _epoch_ms, _ivr_logs, _surveys, chat_transcripts_feed


def pipe_delta_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events landed as the ticket-worklog change feed (``|``-separated, one
    folder per extract date), read back and merged (T6) on worklog_id."""
    e = B.Fixtures(spark, sf_dir)("events")
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    landed = e.select(F.col("event_id").alias("worklog_id"), F.col("user_id").alias("ticket_id"),
                      (F.col("user_id") % 50).alias("agent_id"), F.floor("value").cast("bigint").alias("minutes_logged"),
                      _epoch_ms("ts").alias("log_ms"), F.col("event_type").alias("note"), op.alias("op"),
                      (X.epoch_seconds("ts") * 1000 + F.col("event_id") % 1000).alias("change_ms"),
                      F.to_date("ts").alias("extract_ts"))
    path = scratch_path(spark, "stg_tkt_worklog_delta")
    landed.write.option("sep", "|").option("header", "false").partitionBy("extract_ts").csv(path)
    feed = feeds.read_pipe_delta(spark, path, "stg_tkt_worklog_delta")
    payload = ["ticket_id", "agent_id", "minutes_logged", "log_ms", "note"]
    merged = changelog.current(changelog.merge(None, feed, ["worklog_id"], payload), ["worklog_id"], payload)
    return merged.select("worklog_id", "ticket_id", "agent_id", "minutes_logged", X.millis_to_ts("log_ms").alias("log_ts"),
                         "note", "last_change_ts")


def json_feed_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat transcripts landed as JSON lines with nested message arrays, read
    back with the declared schema, then T14."""
    feed = chat_transcripts_feed(B.Fixtures(spark, sf_dir))
    path = scratch_path(spark, "stg_file_chat_transcripts")
    feed.write.partitionBy("feed_date").json(path)
    back = feeds.read_json_feed(spark, path, "stg_file_chat_transcripts")
    return T.chat_session_metrics(back).select("chat_ref", "message_count", "agent_message_count",
                                               "customer_message_count", "first_response_seconds", "event_date")


def csv_feed_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey responses landed as quoted CSV (free text with commas, quotes and
    line breaks), read back PERMISSIVE with the declared schema, then T16."""
    s = _surveys(B.Fixtures(spark, sf_dir))
    landed = s.select("survey_id", "interaction_ref", "survey_ms", "csat_score", "nps_score",
                      (F.col("nps_score") >= 9).alias("fcr_claimed"),
                      F.concat(F.lit('said "'), F.col("client_code"), F.lit('", then,\nmore')).alias("verbatim"),
                      "client_code", "feed_date")
    path = scratch_path(spark, "stg_file_survey_csat")
    landed.write.option("header", "true").option("escape", '"').partitionBy("feed_date").csv(path)
    back = feeds.read_csv_feed(spark, path, "stg_file_survey_csat")
    return T.survey_cleanse(back)


IVR_LINE = r"^(\d+)\|(\d+)\|([^|]+)\|([^|]+)\|([^|]*)\|(.*)$"


def log_feed_ivr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IVR events landed as raw log lines (one folder per client and day),
    parsed by regex (T21) into the log table's shape, then T13."""
    ev = _ivr_logs(B.Fixtures(spark, sf_dir))
    line = F.concat_ws("|", F.col("event_ms").cast("string"), F.col("event_seq").cast("string"), "session_ref",
                       "menu_path", "key_pressed", F.lit("tail"))
    landed = ev.select(line.alias("value"), "client_code", F.to_date(X.millis_to_ts("event_ms")).alias("feed_date"))
    path = scratch_path(spark, "stg_file_ivr_logs")
    landed.write.partitionBy("client_code", "feed_date").text(path)
    lines = feeds.read_log_lines(spark, path)
    parsed = T.regex_log_parse(lines, IVR_LINE, ["event_ms", "event_seq", "session_ref", "menu_path", "key_pressed",
                                                 "raw_tail"])
    logs = parsed.select(F.col("event_ms").cast("bigint").alias("event_ms"), F.col("event_seq").cast("bigint").alias("event_seq"),
                         "session_ref", "menu_path", "key_pressed", "raw_tail", F.col("client_code").cast("string").alias("client_code"))
    return T.ivr_sessionize(logs)


FEED_JOBS = {f.__name__: f for f in (pipe_delta_feed, json_feed_chat, csv_feed_survey, log_feed_ivr)}
