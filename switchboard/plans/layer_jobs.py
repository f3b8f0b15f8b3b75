"""Registered runs of the layer transforms on the driver's fixture tables.

Each function maps a fixture table to the staging shape the transform
expects (the "feed"), then calls the transform in ``operators.transforms``.
The feed rules follow FIXTURES.md ("further sources") and are chosen here;
every feed is a projection of whole fixture tables, so the work grows with
them. Signature: (spark, sf_dir) -> DataFrame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import transforms as T
from ..operators.changelog import ChangeLog
from ..operators.tables import scratch_path
from ..sources import bridge as B
from ..sources.warehouse import Warehouse
from . import views as V

# ---- shared fixture feeds ---------------------------------------------------


def _fx(spark, sf_dir):
    return B.Fixtures(spark, sf_dir)


def _epoch_ms(ts):
    return X.epoch_millis(ts)


def _k(props="props"):
    """The numeric value of the single JSON key of events.props."""
    return F.regexp_extract(F.col(props), r'"k":\s*(\d+)', 1)


def _change_feed(fx) -> DataFrame:
    """events as a change feed keyed by user_id: I on signup, D on error, else U."""
    e = fx("events")
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return e.select("user_id", "event_type", "value", op.alias("op"),
                    (X.epoch_seconds("ts") * 1000 + F.col("event_id") % 1000).alias("change_ms"),
                    F.to_date("ts").alias("extract_ts"))


# ---- T1-T5: expression transforms -----------------------------------------

def epoch_seconds_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _fx(spark, sf_dir)("orders").select(F.col("o_orderkey").alias("client_id"),
                                            (X.epoch_seconds("o_orderdate") + F.col("o_orderkey") % 86400).alias("created_ts"))
    return T.epoch_seconds_to_ts(o, "created_ts")


def epoch_millis_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _fx(spark, sf_dir)("events").select(F.col("event_id").alias("ticket_id"), _epoch_ms("ts").alias("created_ms"))
    return T.epoch_millis_to_ts(e, "created_ms", "created_ts").select("ticket_id", "created_ts")


def oracle_string_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _fx(spark, sf_dir)("orders")
    k = F.col("o_orderkey")
    text = (F.when(k % 13 == 0, F.concat(F.lit("BAD"), k.cast("string")))
            .when(k % 17 == 0, F.lit("20011340120000"))
            .otherwise(X.format_ntz(X.add_seconds("o_orderdate", k))))
    return o.select(k.alias("contract_id"), text.alias("signed_dt")).select(
        "contract_id", "signed_dt", T.oracle_string_to_ts("signed_dt").alias("signed_ts"))


def mislabelled_millis_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = B.stg_fin_invoice(_fx(spark, sf_dir)).select("invoice_id", "issued_ts_sec")
    return T.mislabelled_millis_to_ts(inv, "issued_ts_sec", "issued_ts").select(
        "invoice_id", "issued_ts", "issued_ts_unit_is_millis")


def promote_partition_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _fx(spark, sf_dir)("orders")
    m = F.when(F.col("o_orderkey") % 29 == 0, F.lit(None).cast("string")).otherwise(F.date_format(F.to_date("o_orderdate"), "yyyy-MM"))
    return o.select(F.col("o_orderkey").alias("invoice_id"), m.alias("period_month_text")).select(
        "invoice_id", T.promote_partition_string("period_month_text").alias("period_month"))


# ---- T6-T9: merge, history, upsert, snapshot ---------------------------------

def cdc_delta_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two increments of a stored change log: the first half of the month, then the second."""
    feed = _change_feed(_fx(spark, sf_dir))
    cut = F.lit(dt.date(2024, 1, 15))
    log = ChangeLog(spark, scratch_path(spark, "cdc_delta_merge"), ["user_id"], ["event_type", "value"])
    log.append(feed.where(F.col("extract_ts") < cut), 0)
    log.append(feed.where(F.col("extract_ts") >= cut), 1)
    return log.current()


def scd2_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _fx(spark, sf_dir)("orders").select(F.col("o_custkey").alias("agent_id"), F.col("o_orderpriority").alias("job_grade"),
                                            F.col("o_orderstatus").alias("status"), "o_orderdate", "o_orderkey")
    return T.scd2_build(o, "agent_id", ["job_grade", "status"], "o_orderdate", "o_orderkey", "agent_history_id")


def current_state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _fx(spark, sf_dir)("customer")
    k = F.col("c_custkey")
    current = c.where(k % 4 != 0).select(k.alias("client_id"), F.col("c_name").alias("client_name"),
                                         F.col("c_mktsegment").alias("industry"), F.lit("OLD").alias("status"))
    batch = c.where(k % 2 == 0).select(k.alias("client_id"), F.col("c_name").alias("client_name"),
                                       F.lower("c_mktsegment").alias("industry"), F.lit("NEW").alias("status"))
    return T.current_state_upsert(current, batch, ["client_id"])


def snapshot_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _fx(spark, sf_dir)("orders").select(
        (F.col("o_custkey") % 25).alias("program_id"), X.month_start("o_orderdate").alias("load_date"),
        F.col("o_orderpriority").alias("program_code"), F.col("o_orderstatus").alias("status"),
        X.add_seconds("o_orderdate", F.col("o_orderkey")).alias("updated_ts"), "o_orderkey")
    return T.snapshot_conform(o, "program_id", "load_date", ["updated_ts", "o_orderkey"],
                              ["program_code", "status", "updated_ts"])


# ---- T10-T21: cleanse ----------------------------------------------------------

def _schedules(fx):
    e = fx("events").where(F.col("event_type").isin("signup", "view"))
    start = X.epoch_seconds("ts")
    return e.select(F.col("event_id").alias("schedule_id"), (F.col("user_id") % 50).alias("agent_id"),
                    (F.col("event_id") % 6).alias("shift_id"), F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("sched_date"),
                    start.alias("start_epoch"), (start + F.floor(F.col("value") * 60)).alias("end_epoch"),
                    F.concat(F.lit("S"), (F.col("user_id") % 25).cast("string")).alias("site_code"))


def _shifts(fx):
    r = F.col("r_regionkey")
    return fx("region").select(r.cast("bigint").alias("shift_id"), F.concat(F.lit("SH"), r.cast("string")).alias("shift_code"),
                               (r % 2 == 0).alias("overnight_flag"))


def schedule_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    return T.schedule_enrich(_schedules(fx), _shifts(fx))


def adherence_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _fx(spark, sf_dir)("events").where(F.col("event_type") == "error")
    start = X.epoch_seconds("ts")
    feed = e.select(F.col("event_id").alias("adherence_event_id"), (F.col("user_id") % 50).alias("agent_id"),
                    start.alias("start_epoch"), (start + F.floor(F.col("value") * 37)).alias("end_epoch"))
    return T.adherence_minutes(feed)


def _calls(fx):
    o = fx("orders")
    k = F.col("o_orderkey")
    start = X.epoch_seconds("o_orderdate") + k % 86400
    return o.select(k.alias("call_id"), start.alias("start_epoch"),
                    F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(start + k % 30).cast("bigint").alias("answer_epoch"))


def call_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    li = fx("lineitem")
    seg_type = F.when(F.col("l_linenumber") % 3 == 0, "TALK").when(F.col("l_linenumber") % 3 == 1, "HOLD").otherwise("ACW")
    start = X.epoch_seconds("l_shipdate")
    seg = li.select(F.col("l_orderkey").alias("call_id"), seg_type.alias("segment_type"), start.alias("start_epoch"),
                    (start + F.col("l_quantity").cast("bigint") * 10).alias("end_epoch"))
    return T.call_durations(_calls(fx), seg)


def _ivr_logs(fx):
    e = fx("events")
    return e.select(F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("-"),
                             X.format_ntz("ts", with_time=False)).alias("session_ref"),
                    F.concat(F.lit("C"), (F.col("user_id") % 5).cast("string")).alias("client_code"),
                    _epoch_ms("ts").alias("event_ms"), F.col("event_id").alias("event_seq"),
                    F.col("event_type").alias("menu_path"), (_k().cast("bigint") % 10).cast("string").alias("key_pressed"))


def ivr_sessionize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.ivr_sessionize(_ivr_logs(_fx(spark, sf_dir)))


def ivr_path_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.ivr_path_fact(T.ivr_sessionize(_ivr_logs(_fx(spark, sf_dir))))


def chat_transcripts_feed(fx) -> DataFrame:
    """conversations -> one transcript row per conversation with its messages
    array (a conversation is one chat: its turns are the array)."""
    c = fx("conversations")
    base = F.lit(1_700_000_000_000) + F.col("conv_id") * 60000
    sender = F.when(F.col("role") == "assistant", "agent").when(F.col("role") == "user", "customer").otherwise("system")
    msgs = c.select("conv_id", "turn", F.struct(sender.alias("sender"), (base + F.col("turn") * 30000).alias("ts_ms"),
                                                F.col("text").alias("text")).alias("m"))
    chats = msgs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "m"))).alias("_ms"),
                                        F.max("turn").alias("_last"))
    feed = chats.select(F.concat(F.lit("CH"), F.col("conv_id").cast("string")).alias("chat_ref"),
                        F.lit("C0").alias("client_code"), (F.lit(1_700_000_000_000) + F.col("conv_id") * 60000).alias("started_ms"),
                        (F.lit(1_700_000_000_000) + F.col("conv_id") * 60000 + F.col("_last") * 30000).alias("ended_ms"),
                        F.transform("_ms", lambda x: x["m"]).alias("messages"))
    return feed.select("chat_ref", F.lit("Q0").alias("queue_code"), F.lit("agent@example.com").alias("agent_email"),
                       "started_ms", "ended_ms", "messages",
                       F.array(F.struct(F.lit("channel").alias("key"), F.lit("web").alias("value"))).alias("metadata"),
                       "client_code", F.to_date(X.millis_to_ts("started_ms")).alias("feed_date"))


def chat_session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = chat_transcripts_feed(_fx(spark, sf_dir))
    return T.chat_session_metrics(feed).select("chat_ref", "message_count", "agent_message_count",
                                               "customer_message_count", "first_response_seconds", "event_date")


def email_sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _fx(spark, sf_dir)("events").where(F.col("event_type") == "purchase")
    rec = _epoch_ms("ts")
    feed = e.select(F.concat(F.lit("M"), F.col("event_id").cast("string")).alias("email_ref"),
                    F.concat(F.lit("C"), (F.col("user_id") % 5).cast("string")).alias("client_code"),
                    rec.alias("received_ms"), (rec + F.floor(F.col("value") * 60000)).alias("first_reply_ms"))
    return T.email_sla(feed)


def _surveys(fx):
    e = fx("events").where(F.col("event_type").isin("view", "purchase"))
    return e.select(F.concat(F.lit("S"), F.floor(F.col("event_id") / 3).cast("string")).alias("survey_id"),
                    F.concat(F.lit("C"), (F.col("user_id") % 5).cast("string")).alias("client_code"),
                    F.concat(F.lit("I"), F.col("event_id").cast("string")).alias("interaction_ref"),
                    _epoch_ms("ts").alias("survey_ms"), (F.col("event_id") % 5 + 1).alias("csat_score"),
                    (F.col("event_id") % 11).alias("nps_score"), F.to_date("ts").alias("feed_date"))


def survey_cleanse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.survey_cleanse(_surveys(_fx(spark, sf_dir)))


def qa_section_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _fx(spark, sf_dir)("lineitem")
    sec = F.struct(F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("section_code"),
                   F.lit(10).cast("bigint").alias("max_points"),
                   (F.col("l_quantity").cast("bigint") % 11).alias("scored_points"))
    forms = li.groupBy(F.concat(F.lit("QA"), F.col("l_orderkey").cast("string")).alias("qa_form_id")).agg(
        F.collect_list(sec).alias("sections"))
    return T.qa_section_totals(forms)


def _channel_parts(fx):
    e = fx("events")
    base = e.select(F.col("event_id").alias("source_key"),
                    F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("customer_ref"),
                    F.col("ts").alias("start_ts"), X.add_seconds("ts", F.floor("value")).alias("end_ts"), "event_type")
    part = lambda *types: base.where(F.col("event_type").isin(*types)).drop("event_type")
    return part("click"), part("view"), part("purchase"), part("signup", "error")


def interaction_unify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.interaction_unify(*_channel_parts(_fx(spark, sf_dir)))


def dialer_connect(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _fx(spark, sf_dir)("events").where(F.col("event_type").isin("signup", "error"))
    feed = e.select(F.concat(F.lit("A"), F.col("event_id").cast("string")).alias("attempt_id"),
                    (F.col("user_id") % 50).alias("agent_id"), _epoch_ms("ts").alias("attempt_ms"),
                    F.upper("event_type").alias("result_code"), (F.floor("value") % 7).cast("bigint").alias("talk_seconds"))
    return T.dialer_connect(feed)


def map_to_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events.props (JSON object) as a MAP -> entries, one row per entry."""
    e = _fx(spark, sf_dir)("events").select("event_id", F.from_json("props", "map<string,bigint>").alias("props_map"))
    t = T.map_to_entries(e, "props_map", "entries")
    return t.select("event_id", F.inline("entries")).select("event_id", "key", "value")


LOG_PATTERN = r"^EV (\d+) U(\d+) (\w+) (.*)$"


def regex_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _fx(spark, sf_dir)("events")
    lines = e.select(F.concat(F.lit("EV "), F.col("event_id").cast("string"), F.lit(" U"), F.col("user_id").cast("string"),
                              F.lit(" "), F.col("event_type"), F.lit(" "), F.col("props")).alias("value"))
    return T.regex_log_parse(lines, LOG_PATTERN, ["event_ref", "user_ref", "menu_path", "raw_tail"])


# ---- T22-T28: dimensions --------------------------------------------------------

def dim_date_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _fx(spark, sf_dir)("orders")
    bounds = o.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    return T.dim_date_generate(bounds)


def dim_agent_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    org = B.ods_org_unit(fx).select("org_unit_id", "unit_name", "site_code")
    return T.dim_agent_build(B.ods_agent_scd2(fx), org)


def dim_client_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    clients = fx("region").select(F.col("r_regionkey").cast("bigint").alias("client_id"),
                                  F.concat(F.lit("C"), F.col("r_regionkey").cast("string")).alias("client_code"),
                                  F.col("r_name").alias("client_name"), F.lit("ACTIVE").alias("status"))
    contacts = fx("nation").select(F.col("n_nationkey").cast("bigint").alias("contact_id"),
                                   F.col("n_regionkey").cast("bigint").alias("client_id"), F.col("n_name").alias("full_name"),
                                   F.concat(F.lower("n_name"), F.lit("@example.com")).alias("email"),
                                   (F.col("n_nationkey") % 2 == 0).alias("is_primary"))
    return T.dim_client_build(clients, contacts)


def dim_program_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    programs = fx("nation").select(F.col("n_nationkey").cast("bigint").alias("program_id"),
                                   F.col("n_name").alias("program_code"), F.col("n_regionkey").cast("bigint").alias("client_id"),
                                   F.lit("LIVE").alias("status"))
    contracts = fx("orders").select(F.col("o_orderkey").alias("contract_id"), (F.col("o_custkey") % 25).alias("program_id"),
                                    F.col("o_orderdate").alias("start_ts"), F.col("o_orderpriority").alias("billing_model"))
    return T.dim_program_build(programs, contracts)


def dim_org_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.dim_org_flatten(Warehouse.fixtures(spark, sf_dir).run(V.org_hierarchy))


def dim_small_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.dim_small_build(B.ods_org_unit(_fx(spark, sf_dir)), "site_code", "site_sk")


def fact_interaction_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    e = fx("events").select(F.concat(F.lit("I"), F.col("event_id").cast("string")).alias("interaction_id"),
                            (F.col("user_id") % 150).alias("agent_id"), (F.col("user_id") % 25).alias("program_id"),
                            "ts", X.date_key("ts").alias("date_key"))
    f = T.lookup_sk(e, B.dim_agent(fx), "agent_id", "agent_id", "agent_sk")
    f = T.lookup_sk(f, B.dim_program(fx), "program_id", "program_id", "program_sk")
    return f.select("interaction_id", "agent_sk", "program_sk", F.col("ts").alias("start_ts"), "date_key")


# ---- T29-T42: facts and aggregates ----------------------------------------------

def agent_activity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _fx(spark, sf_dir)("events")
    start = X.epoch_seconds("ts")
    feed = e.select((F.col("user_id") % 50).alias("agent_id"), F.upper("event_type").alias("state_code"),
                    start.alias("start_epoch"), (start + F.floor("value")).alias("end_epoch"))
    return T.agent_activity_rollup(feed)


def queue_interval_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _fx(spark, sf_dir)("events")
    answer = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(X.add_seconds("ts", F.col("event_id") % 40))
    calls = e.select((F.col("user_id") % 50).alias("queue_id"), F.col("ts").alias("start_ts"), answer.alias("answer_ts"),
                     X.add_seconds("ts", F.col("event_id") % 40 + F.floor("value")).alias("end_ts"))
    return T.queue_interval_rollup(calls)


def survey_and_qa_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    s = T.survey_cleanse(_surveys(fx))
    f = B.fact_interaction(fx).select("interaction_id", "agent_sk", "program_sk")
    j = s.join(f, s.interaction_ref == f.interaction_id, "left")
    return j.select("survey_id", F.col("interaction_ref").alias("interaction_id"),
                    F.coalesce("agent_sk", F.lit(T.UNKNOWN_SK)).cast("bigint").alias("agent_sk"),
                    F.coalesce("program_sk", F.lit(T.UNKNOWN_SK)).cast("bigint").alias("program_sk"),
                    "survey_ts", "csat_score", "nps_score", X.date_key("survey_ts").alias("date_key"))


def billing_line_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    lines = B.fact_billing_line(fx)
    inv = fx("orders").select(F.col("o_orderkey").alias("_inv"), F.col("o_orderstatus").alias("invoice_status"))
    svc = fx("nation").select(F.col("n_nationkey").cast("bigint").alias("_svc_prog"),
                              F.concat(F.lit("SVC-"), F.col("n_name")).alias("service_code"))
    j = (lines.join(inv, F.col("invoice_id") == F.col("_inv"), "left")
         .join(svc, F.col("program_sk") == F.col("_svc_prog"), "left"))
    return j.select("invoice_line_id", "invoice_id", "client_sk", "program_sk", "service_code", "line_amount",
                    "invoice_status", "period_month")


def adherence_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _fx(spark, sf_dir)("events").select((F.col("user_id") % 50).alias("agent_sk"), X.date_key("ts").alias("date_key"),
                                            "event_type", F.floor("value").cast("bigint").alias("minutes"))
    part = lambda *t: e.where(F.col("event_type").isin(*t)).select("agent_sk", "date_key", "minutes")
    return T.adherence_daily(part("signup", "view", "click"), part("error"), part("click"), part("purchase"))


PRIORITY_SLA_HOURS = {"1-URGENT": 4, "2-HIGH": 24, "3-MEDIUM": 72, "4-NOT SPECIFIED": 120, "5-LOW": 240}


def ticket_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    o = fx("orders")
    cats = o.select("o_orderpriority").distinct().select(
        F.abs(F.hash("o_orderpriority")).cast("bigint").alias("category_id"),
        F.col("o_orderpriority").alias("category_code"),
        F.coalesce(*[F.when(F.col("o_orderpriority") == k, F.lit(v)) for k, v in PRIORITY_SLA_HOURS.items()],
                   F.lit(120)).cast("bigint").alias("sla_hours"))
    last_ship = fx("lineitem").groupBy(F.col("l_orderkey").alias("_lk")).agg(F.max("l_shipdate").alias("_ship"))
    t = o.join(last_ship, F.col("o_orderkey") == F.col("_lk"), "left").select(
        F.col("o_orderkey").alias("ticket_id"), (F.col("o_custkey") % 25).alias("program_id"),
        F.abs(F.hash("o_orderpriority")).cast("bigint").alias("category_id"), F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created_ts"),
        F.when(F.col("o_orderstatus") == "F", F.col("_ship")).alias("resolved_ts"))
    ev = fx("lineitem").select(F.col("l_orderkey").alias("ticket_id"))
    return T.ticket_fact(t, ev, cats)


def agent_daily_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    daily = T.agent_daily(B.fact_interaction(fx), B.fact_agent_activity(fx))
    return T.agent_weekly(daily)


def program_monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    p = B.dim_program(fx).select("program_sk", "client_id",
                                 F.concat(F.lit("LOB"), (F.col("program_sk") % 3).cast("string")).alias("line_of_business"))
    return T.program_monthly_rollup(B.fact_interaction(fx), p)


def queue_hourly_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    hourly = V.queue_hourly(B.fact_queue_interval(fx))
    fc = (fx("supplier").select(F.col("s_suppkey").alias("queue_sk"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
          .select("queue_sk", F.col("h").cast("bigint").alias("hour_of_day"),
                  ((F.col("queue_sk") + F.col("h")) % 7 + 10).cast("bigint").alias("forecast_volume")))
    return T.queue_hourly_variance(hourly, fc)


def csat_rollup_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    e = fx("events").where(F.col("event_type").isin("purchase", "view"))
    s = e.select((F.col("user_id") % 25).alias("program_sk"), (F.col("user_id") % 50).alias("agent_sk"),
                 X.month_start("ts").alias("period_month"), (F.col("event_id") % 5 + 1).alias("csat_score"),
                 (F.col("event_id") % 11).alias("nps_score"))
    p = B.dim_program(fx).select(F.col("program_sk").alias("_p"), F.col("client_id").alias("client_sk"))
    a = B.dim_agent(fx).select(F.col("agent_sk").alias("_a"), "site_code")
    j = s.join(p, F.col("program_sk") == F.col("_p"), "left").join(a, F.col("agent_sk") == F.col("_a"), "left")
    return T.csat_rollup_monthly(j)


def billing_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    lines = B.fact_billing_line(fx)
    o = fx("orders")
    credit = o.select((F.col("o_custkey") % 5).alias("client_sk"), (F.col("o_custkey") % 25).alias("program_sk"),
                      X.month_start("o_orderdate").alias("period_month"),
                      (F.floor("o_totalprice") % 100).cast("decimal(12,2)").alias("credit_amount"))
    telco = o.where(F.col("o_orderstatus") == "F").select(
        (F.col("o_custkey") % 5).alias("client_sk"), (F.col("o_custkey") % 25).alias("program_sk"),
        X.month_start("o_orderdate").alias("period_month"),
        (F.floor("o_totalprice") % 50).cast("decimal(12,2)").alias("charge_amount"))
    return T.billing_monthly(lines, credit, telco)


def site_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = _fx(spark, sf_dir)
    daily = T.agent_daily(B.fact_interaction(fx), B.fact_agent_activity(fx))
    adh = B.fact_adherence_daily(fx).select(F.col("agent_sk").alias("_a2"), F.col("date_key").alias("_d2"), "adherence_pct")
    daily = daily.join(adh, (F.col("agent_sk") == F.col("_a2")) & (F.col("date_key") == F.col("_d2")), "left")
    qsite = fx("supplier").select(F.col("s_suppkey").alias("queue_sk"),
                                  F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("site_code"))
    return T.site_daily(daily, B.dim_agent(fx), B.fact_queue_interval(fx), qsite)


def keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.keyword_counts(_fx(spark, sf_dir)("documents").select("doc_id", "text"))


JOBS = {f.__name__: f for f in (
    epoch_seconds_to_ts, epoch_millis_to_ts, oracle_string_to_ts, mislabelled_millis_to_ts, promote_partition_string,
    cdc_delta_merge, scd2_build, current_state_upsert, snapshot_conform, schedule_enrich, adherence_minutes,
    call_durations, ivr_sessionize, chat_session_metrics, email_sla, survey_cleanse, qa_section_totals,
    interaction_unify, dialer_connect, map_to_entries, regex_log_parse, dim_date_generate, dim_agent_build,
    dim_client_build, dim_program_build, dim_org_flatten, dim_small_build, fact_interaction_load,
    agent_activity_rollup, queue_interval_rollup, survey_and_qa_facts, billing_line_load, adherence_daily,
    ticket_fact, ivr_path_fact, agent_daily_weekly, program_monthly_rollup, queue_hourly_variance,
    csat_rollup_monthly, billing_monthly, site_daily, keyword_counts)}
