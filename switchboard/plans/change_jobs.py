"""The eight change feeds and the ods tables they keep (T6), as stored change logs.

``TARGETS`` says for each ods table its feed, key and the columns that are not
simply the feed's. The feeds here are made from ``lineitem``: an order's lines
are the changes of one row, whose increment does not follow their time, so
that updates older than a delete land after it. Each run appends two increments
and reads the merged table in its declared columns.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import changelog as C
from ..operators.tables import scratch_path
from ..sources import bridge as B
from ..sources.schemas import conform, schema


class Target(NamedTuple):
    feed: str
    key: str
    made: dict[str, Callable[[], Column]]


def _month_of_text(c: str) -> Callable[[], Column]:
    """'YYYY-MM' or 'YYYY-MM-DD' text -> first of the month."""
    return lambda: F.trunc(F.to_date(F.substring(c, 1, 7), "yyyy-MM"), "month")


TARGETS = {
    "ods_timesheet": Target("stg_fin_timesheet_delta", "timesheet_id", {"work_month": _month_of_text("work_date")}),
    "ods_payroll_adjustment": Target("stg_fin_payroll_adj_delta", "adjustment_id", {"period_month": _month_of_text("period_month")}),
    "ods_sla_credit": Target("stg_crm_sla_credit_delta", "sla_credit_id", {"period_month": _month_of_text("period_month")}),
    "ods_callback_request": Target("stg_tel_callback_request_delta", "callback_id", {
        "requested_ts": lambda: X.seconds_to_ts("requested_epoch"), "scheduled_ts": lambda: X.seconds_to_ts("scheduled_epoch"),
        "event_date": lambda: F.to_date(X.seconds_to_ts("requested_epoch"))}),
    "ods_shift_swap": Target("stg_wfm_shift_swap_delta", "swap_id", {"swap_month": _month_of_text("swap_date")}),
    "ods_ticket_worklog": Target("stg_tkt_worklog_delta", "worklog_id", {
        "log_ts": lambda: X.millis_to_ts("log_ms"), "event_date": lambda: F.to_date(X.millis_to_ts("log_ms"))}),
    "ods_attrition_event": Target("stg_hr_attrition_event_delta", "attrition_event_id", {
        "notice_ts": lambda: X.seconds_to_ts("notice_epoch"), "event_month": lambda: X.month_start(X.seconds_to_ts("notice_epoch"))}),
}


def change_log(spark: SparkSession, table: str, path: str) -> C.ChangeLog:
    """The stored change log behind an ods table."""
    t = TARGETS[table]
    payload = [f.name for f in schema(t.feed) if f.name not in (t.key, *C.META)]
    return C.ChangeLog(spark, path, [t.key], payload)


def ods_table(log: C.ChangeLog, table: str) -> DataFrame:
    """The ods table of a change log, in its declared columns."""
    rows = log.current()
    return conform(rows.withColumns({c: make() for c, make in TARGETS[table].made.items()}), table)


def rate_card(base: DataFrame, changes: C.ChangeLog) -> DataFrame:
    """``ods_rate_card``: the latest snapshot of each card, with the new rate of its latest change that stands.

    A delete withdraws its change, so the one before it counts again; cards without a standing change keep the
    snapshot's rate and have no last_change_ts.
    """
    last = base.groupBy("rate_card_id").agg(F.max_by(F.struct(*[c for c in base.columns if c != "rate_card_id"]), "load_date").alias("v"))
    stands = changes.current().groupBy(F.col("rate_card_id").alias("_card")).agg(
        F.max_by(F.struct("new_rate", "last_change_ts"), F.struct("last_change_ts", "rate_change_id")).alias("c"))
    j = last.join(stands, F.col("rate_card_id") == F.col("_card"), "left")
    return conform(j.select("rate_card_id", "v.program_id", "v.service_code", F.coalesce("c.new_rate", "v.rate").alias("rate"), "v.currency",
                            X.seconds_to_ts("v.effective_ts").alias("effective_ts"), X.seconds_to_ts("v.expiry_ts").alias("expiry_ts"),
                            "c.last_change_ts", F.col("v.load_date").alias("snapshot_date")), "ods_rate_card")


# ---- fixture feeds -------------------------------------------------------------

FIRST, SECOND = dt.date(2001, 10, 1), dt.date(2001, 10, 2)


def _changes(fx) -> DataFrame:
    """lineitem as changes: op, change_ms and extract_ts beside all its columns."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    op = F.when(n == 1, "I").when((k + n) % 5 == 0, "D").otherwise("U")
    return fx("lineitem").select("*", op.alias("op"), (X.epoch_seconds("l_shipdate") * 1000 + (k * 37 + n * 11) % 86_400_000).alias("change_ms"),
                                 F.when((k + 3 * n) % 2 == 0, F.lit(FIRST)).otherwise(F.lit(SECOND)).alias("extract_ts"))


def _feed(fx, table: str) -> DataFrame:
    """The feed of an ods table in the declared columns of its staging table."""
    text, month = F.date_format("l_shipdate", "yyyy-MM-dd"), F.date_format("l_shipdate", "yyyy-MM")
    agent, program, part = F.col("l_suppkey") % 50, F.col("l_partkey") % 25, F.col("l_partkey")
    qty, money, at = F.col("l_quantity").cast("bigint"), F.floor("l_extendedprice"), X.epoch_seconds("l_shipdate")
    returned = F.col("l_returnflag") == "R"
    cols = {
        "ods_timesheet": dict(agent_id=agent, work_date=text, program_id=program, billable_minutes=qty * 10,
                              nonbillable_minutes=F.col("l_linenumber") * 5, approved_flag=returned),
        "ods_payroll_adjustment": dict(agent_id=agent, period_month=month, adj_type=F.col("l_returnflag"), amount=money),
        "ods_sla_credit": dict(program_id=program, sla_target_id=part % 40, period_month=month, credit_amount=money, reason=F.col("l_linestatus")),
        "ods_callback_request": dict(call_id=part, queue_id=agent, requested_epoch=at, scheduled_epoch=at + qty * 600, completed_flag=returned),
        "ods_shift_swap": dict(requesting_agent_id=agent, accepting_agent_id=part % 50, schedule_id=part, swap_date=text, status=F.col("l_returnflag")),
        "ods_ticket_worklog": dict(ticket_id=part, agent_id=agent, minutes_logged=qty, log_ms=at * 1000 + 5, note=F.col("l_linestatus")),
        "ods_attrition_event": dict(agent_id=agent, notice_epoch=at, last_day=text, attrition_type=F.col("l_returnflag"),
                                    reason_code=F.col("l_linestatus"), regrettable_flag=returned),
    }[table]
    t = TARGETS[table]
    made = _changes(fx).select(F.col("l_orderkey").alias(t.key), *[c.alias(n) for n, c in cols.items()], *C.META)
    return made.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema(t.feed)])


def _append_increments(log: C.ChangeLog, feed: DataFrame) -> C.ChangeLog:
    log.append(feed.where(F.col("extract_ts") == F.lit(FIRST)), 0)
    log.append(feed.where(F.col("extract_ts") == F.lit(SECOND)), 1)
    return log


def _merge(table: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        log = change_log(spark, table, scratch_path(spark, table))
        return ods_table(_append_increments(log, _feed(B.Fixtures(spark, sf_dir), table)), table)
    run.__name__ = f"{table}_merge"
    return run


def ods_rate_card_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = B.Fixtures(spark, sf_dir)
    k = F.col("p_partkey")
    base = fx("part").select(k.alias("rate_card_id"), (k % 25).alias("program_id"), F.col("p_brand").alias("service_code"),
                             F.col("p_retailprice").cast("decimal(12,4)").alias("rate"), F.lit("USD").alias("currency"),
                             (k * 3600).alias("effective_ts"), F.when(k % 4 == 0, k * 3600 + 86400).cast("bigint").alias("expiry_ts"),
                             F.explode(F.array(F.lit(FIRST), F.when(k % 3 == 0, F.lit(SECOND)))).alias("load_date")).where("load_date is not null")
    changes = _changes(fx).select(F.col("l_orderkey").alias("rate_change_id"), F.col("l_partkey").alias("rate_card_id"),
                                  F.col("l_quantity").cast("decimal(12,4)").alias("old_rate"), F.floor("l_extendedprice").cast("decimal(12,4)").alias("new_rate"),
                                  F.col("l_returnflag").alias("change_reason"), *C.META)
    log = C.ChangeLog(spark, scratch_path(spark, "rate_card"), ["rate_change_id"], ["rate_card_id", "old_rate", "new_rate", "change_reason"])
    return rate_card(base, _append_increments(log, changes))


CHANGE_JOBS = {f"{t}_merge": _merge(t) for t in TARGETS}
CHANGE_JOBS["ods_rate_card_merge"] = ods_rate_card_merge
TARGETS_AND_CARDS = sorted([*TARGETS, "ods_rate_card"])
