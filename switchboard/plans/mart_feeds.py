"""Staging tables at their declared width, made from the fixture tables.

``FEEDS`` states each as (fixture table, copies, filter, column expressions) in
expressions that Spark SQL and DuckDB read alike, so that the feed of a
build and that of its oracle are one text; the transforms on top are written
twice. ``copies`` repeats each row with ``n`` = 1.. (later loads of a key, the
segments of a call); every fixture row is in, and filters only pick the
kinds of events that a source has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..sources.schemas import schema

LOADED = "CASE WHEN n = 2 THEN DATE '2024-01-20' ELSE DATE '2024-01-05' END"
AGAIN = "n = 1 OR {0} % 3 = 0"
#: January 2024 in epoch seconds, its length
JANUARY, MONTH_SECONDS = 1704067200, 2592000
LINE = "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey * 10 + l_suppkey % 10)"
MAIL = "'a' || CAST(user_id AS STRING) || '@example.com'"
CODE = "'C' || CAST(user_id % 7 AS STRING)"

Feed = tuple[str, int, str, dict[str, str]]

FEEDS: dict[str, list[Feed]] = {
    "stg_crm_client": [("region", 2, AGAIN.format("r_regionkey"), dict(
        client_id="r_regionkey", client_code="'C' || CAST(r_regionkey AS STRING)", client_name="r_name",
        industry="CASE WHEN n = 2 THEN 'TECH' ELSE 'RETAIL' END", hq_country="'US'", status="CASE WHEN n = 2 THEN 'CHANGED' ELSE 'ACTIVE' END",
        created_ts="1600000000 + r_regionkey * 1000", updated_ts="1600000000 + n", load_date=LOADED))],
    "stg_crm_client_contact": [("nation", 1, "TRUE", dict(
        contact_id="n_nationkey", client_id="n_regionkey", full_name="n_name", email="lower(n_name) || '@example.com'", phone="NULL", role="'BUYER'",
        is_primary="n_nationkey % 2 = 0", created_ts="1600000000", load_date=LOADED))],
    "stg_crm_program": [("nation", 2, AGAIN.format("n_nationkey"), dict(
        program_id="n_nationkey", client_id="n_regionkey", program_code="'P' || CAST(n_nationkey AS STRING)", program_name="n_name",
        line_of_business="'LOB' || CAST((n_nationkey + n) % 3 AS STRING)", channel_mix="'VOICE'", site_code="'S' || CAST(n_nationkey AS STRING)",
        status="'LIVE'", go_live_ts="1500000000 + n_nationkey * 86400", updated_ts="1600000000 + n", load_date=LOADED))],
    "stg_crm_contract": [("part", 1, "TRUE", dict(
        contract_id="p_partkey", client_id="p_partkey % 5", program_id="p_partkey % 25", contract_no="'K' || CAST(p_partkey AS STRING)",
        start_dt="CASE WHEN p_partkey % 13 = 0 THEN 'BAD' ELSE '2023' || lpad(CAST(1 + p_partkey % 12 AS STRING), 2, '0') || '01080000' END",
        end_dt="'20251231235959'", billing_model="CASE WHEN p_partkey % 3 = 0 THEN 'FTE' ELSE 'UNIT' END", currency="'USD'",
        signed_dt="CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE '20221105123000' END", status="'SIGNED'", load_date=LOADED))],
    "stg_crm_contract_line": [("part", 2, AGAIN.format("p_partkey"), dict(
        contract_line_id="p_partkey", contract_id="p_partkey", line_no="1", service_code="p_brand", uom="'HOUR'", unit_rate="p_partkey % 90 + 10",
        min_commit="p_partkey % 1000", effective_dt="'20230101000000'", load_date=LOADED))],
    "stg_hr_agent": [("customer", 2, AGAIN.format("c_custkey"), dict(
        agent_id="c_custkey", employee_no="'E' || CAST(c_custkey AS STRING)", first_name="c_mktsegment",
        last_name="CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_name END", email="'a' || CAST(c_custkey AS STRING) || '@example.com'",
        org_unit_id="c_nationkey + 1", job_grade="CASE WHEN n = 2 THEN 'SENIOR' ELSE c_mktsegment END",
        employment_type="CASE WHEN c_custkey % 3 = 0 THEN 'PART' ELSE 'FULL' END", hire_ts="1600000000 + c_custkey * 3600",
        term_ts="CASE WHEN c_custkey % 11 = 0 THEN 1700000000 + c_custkey END", status="CASE WHEN c_custkey % 11 = 0 THEN 'TERM' ELSE 'ACTIVE' END", load_date=LOADED))],
    "stg_hr_employment_event": [("events", 1, "event_type = 'signup'", dict(
        event_id="event_id", agent_id="user_id", event_type="CASE event_id % 4 WHEN 0 THEN 'TRANSFER' WHEN 1 THEN 'LEAVE' WHEN 2 THEN 'REHIRE' ELSE 'REVIEW' END",
        event_ts="sec", from_org_unit_id="NULL", to_org_unit_id="event_id % 25 + 1", reason_code="'X'", load_date=LOADED))],
    "stg_hr_org_unit": [("region", 1, "TRUE", dict(
        org_unit_id="r_regionkey + 101", parent_unit_id="NULL", unit_code="r_name", unit_name="r_name", unit_type="'REGION'", site_code="'S0'",
        cost_center="'CC' || CAST(r_regionkey AS STRING)", created_ts="1500000000", load_date=LOADED)),
        ("nation", 2, AGAIN.format("n_nationkey"), dict(
            org_unit_id="n_nationkey + 1", parent_unit_id="n_regionkey + 101", unit_code="n_name", unit_name="CASE WHEN n = 2 THEN lower(n_name) ELSE n_name END",
            unit_type="'SITE'", site_code="'S' || CAST(n_nationkey AS STRING)", cost_center="'CC' || CAST(n_nationkey AS STRING)", created_ts="1500000000", load_date=LOADED))],
    "stg_tel_queue": [("supplier", 2, AGAIN.format("s_suppkey"), dict(
        queue_id="s_suppkey", queue_code="'Q' || CAST(s_suppkey AS STRING)", queue_name="s_name", program_id="s_suppkey % 25",
        media_type="CASE WHEN s_suppkey % 2 = 0 THEN 'VOICE' ELSE 'CHAT' END", priority="n", created_epoch="1500000000", load_date=LOADED))],
    "stg_wfm_shift": [("region", 2, AGAIN.format("r_regionkey"), dict(
        shift_id="r_regionkey", shift_code="'SH' || CAST(r_regionkey * 10 + n AS STRING)", shift_name="r_name", start_hhmm="'0800'", end_hhmm="'1630'",
        overnight_flag="r_regionkey % 2 = 0", site_code="'S0'", created_epoch="1500000000", load_date=LOADED))],
    "stg_tel_disposition_code": [("part", 2, AGAIN.format("p_partkey"), dict(
        disposition_code="'D' || CAST(p_partkey AS STRING)", disposition_desc="CASE WHEN n = 2 THEN upper(p_name) ELSE p_name END", category="p_type",
        billable_flag="p_partkey % 2 = 0", created_epoch="1500000000", load_date=LOADED))],
    "stg_wfm_schedule": [("events", 1, "event_type IN ('signup', 'view')", dict(
        schedule_id="event_id", agent_id="user_id", shift_id="event_id % 6", sched_date="day_text", start_epoch="sec", end_epoch="sec + CAST(floor(value * 60) AS BIGINT)",
        paid_minutes="floor(value)", activity_code="event_type", load_date="DATE '2024-02-01'", site_code="'S' || CAST(user_id % 25 AS STRING)"))],
    "stg_wfm_adherence_event": [("events", 1, "event_type = 'error'", dict(
        adherence_event_id="event_id", agent_id="user_id", schedule_id="event_id - 1", exception_type="CASE WHEN event_id % 3 = 0 THEN 'LATE' ELSE 'BREAK' END",
        start_epoch="sec", end_epoch="sec + CAST(floor(value * 37) AS BIGINT)", approved_flag="event_id % 2 = 0", load_date="DATE '2024-02-01'"))],
    "stg_wfm_timeoff_request": [("events", 1, "event_type = 'purchase' AND event_id % 7 = 0", dict(
        timeoff_id="event_id", agent_id="user_id", request_epoch="sec", start_date="day_text", end_date="CASE WHEN event_id % 2 = 0 THEN next_day_text ELSE day_text END",
        timeoff_type="'PTO'", status="CASE WHEN event_id % 3 = 0 THEN 'DENIED' ELSE 'APPROVED' END", load_date="DATE '2024-02-01'"))],
    "ods_timesheet": [("events", 1, "event_type = 'click'", dict(
        timesheet_id="event_id", agent_id="user_id", work_date="day_text", program_id="event_id % 25", billable_minutes="floor(value)",
        nonbillable_minutes="event_id % 30", approved_flag="TRUE", last_change_ts="NULL", work_month="DATE '2024-01-01'"))],
    "stg_tel_agent_state_event": [("events", 1, "TRUE", dict(
        agent_id="user_id", state_code="CASE event_type WHEN 'click' THEN 'TALK' WHEN 'view' THEN 'READY' WHEN 'purchase' THEN 'ACW' WHEN 'signup' THEN 'HOLD' "
                                       "ELSE 'AUX' || CAST(event_id % 3 AS STRING) END", start_epoch="sec", end_epoch="sec + CAST(floor(value) AS BIGINT)"))],
    "stg_tel_call": [("events", 1, "event_type = 'click'", dict(
        call_id="event_id", ani="NULL", dnis="NULL", queue_id="event_id % 12", agent_id="user_id", program_id="event_id % 26", start_epoch="sec",
        answer_epoch="CASE WHEN event_id % 8 <> 0 THEN sec + event_id % 30 END", end_epoch="sec + event_id % 30 + CAST(floor(value) AS BIGINT)",
        disposition_code="'D' || CAST(event_id % 20 AS STRING)", direction="CASE WHEN event_id % 5 = 0 THEN 'OUT' ELSE 'IN' END",
        recording_id="'R' || CAST(event_id AS STRING)", load_date="DATE '2024-02-01'"))],
    "stg_tel_call_segment": [("events", 3, "event_type = 'click' AND event_id % 9 <> 0", dict(
        segment_id="event_id * 10 + n", call_id="event_id", segment_no="n", segment_type="CASE n WHEN 1 THEN 'TALK' WHEN 2 THEN 'HOLD' ELSE 'ACW' END",
        start_epoch="sec", end_epoch="sec + (event_id * n) % 100", agent_id="user_id", load_date="DATE '2024-02-01'"))],
    "stg_file_email_interaction": [("events", 1, "event_type = 'purchase'", dict(
        email_ref="'M' || CAST(event_id AS STRING)", mailbox="'box' || CAST(event_id % 4 AS STRING)", agent_email=MAIL, received_ms="ms",
        first_reply_ms="CASE WHEN event_id % 10 <> 0 THEN ms + CAST(floor(value * 60000) AS BIGINT) END",
        resolved_ms="CASE WHEN event_id % 4 <> 0 THEN ms + CAST(floor(value * 90000) AS BIGINT) END", subject_category="'billing'", client_code=CODE, feed_date="DATE '2024-02-01'"))],
    "stg_file_dialer_result": [("events", 1, "event_type = 'signup'", dict(
        attempt_id="'A' || CAST(event_id AS STRING)", campaign_code="'CP' || CAST(event_id % 3 AS STRING)", phone_hash="NULL", agent_id="user_id", attempt_ms="ms",
        result_code="upper(event_type)", talk_seconds="CAST(floor(value) AS BIGINT) % 7", client_code=CODE, feed_date="DATE '2024-02-01'"))],
    "stg_file_interaction_export": [("events", 1, "event_type = 'error'", dict(
        interaction_ref="CAST(event_id AS STRING)", channel="'SOCIAL'", client_interaction_id="NULL", agent_email=MAIL, start_ms="ms", end_ms="ms + CAST(floor(value * 1000) AS BIGINT)",
        outcome="CASE event_id % 3 WHEN 0 THEN 'RESOLVED' WHEN 1 THEN 'OPEN' END", customer_ref="'U' || CAST(user_id AS STRING)", client_code=CODE, feed_date="DATE '2024-02-01'"))],
    "stg_file_survey_csat": [("events", 1, "event_type IN ('click', 'purchase')", dict(
        survey_id="'S' || CAST(CAST(floor(event_id / 3) AS BIGINT) AS STRING)",
        interaction_ref="CASE WHEN event_type = 'click' THEN 'C' ELSE 'EM' END || CAST(event_id AS STRING)", survey_ms="ms", csat_score="event_id % 5 + 1",
        nps_score="event_id % 11", fcr_claimed="event_id % 2 = 0", verbatim="CASE WHEN event_id % 4 = 0 THEN 'fine' END", client_code=CODE, feed_date="CAST(day_text AS DATE)"))],
    "stg_tkt_ticket": [("orders", 2, AGAIN.format("o_orderkey"), dict(
        ticket_id="o_orderkey", ticket_no="'T' || CAST(o_orderkey AS STRING)", program_id="o_custkey % 27", category_id="o_custkey % 6", opened_by_agent_id="NULL",
        assigned_agent_id="o_custkey", interaction_ref="NULL", priority="o_orderpriority", status="CASE WHEN n = 2 THEN 'CLOSED' ELSE o_orderstatus END",
        created_ms=f"({JANUARY} + o_orderkey * 7919 % {MONTH_SECONDS}) * 1000", updated_ms=f"({JANUARY} + n) * 1000", load_date=LOADED))],
    "stg_tkt_ticket_event": [("lineitem", 1, "TRUE", dict(
        ticket_event_id=LINE, ticket_id="l_orderkey", event_type="CASE WHEN l_linenumber % 4 = 0 THEN 'RESOLVED' ELSE 'NOTE' END",
        event_ms=f"({JANUARY} + l_orderkey * 7919 % {MONTH_SECONDS} + l_linenumber * 5000) * 1000", actor_agent_id="NULL", old_value="NULL", new_value="NULL",
        load_date="DATE '2024-02-01'"))],
    "stg_tkt_category": [("region", 2, AGAIN.format("r_regionkey"), dict(
        category_id="r_regionkey", category_code="'CAT' || CAST(r_regionkey AS STRING)", category_name="r_name", sla_hours="r_regionkey * 2 + n", created_ms="0", load_date=LOADED))],
    "stg_fin_invoice": [("orders", 2, AGAIN.format("o_orderkey"), dict(
        invoice_id="o_orderkey", invoice_no="'INV' || CAST(o_orderkey AS STRING)", client_id="o_custkey % 6", program_id="o_custkey % 25", period_month="month_text",
        issued_ts_sec="sec * 1000 + 250", due_ts_sec="(sec + 2592000) * 1000", currency="'USD'", total_amount="o_totalprice",
        status="CASE WHEN n = 2 THEN 'PAID' ELSE 'ISSUED' END", load_date=LOADED))],
    "stg_fin_invoice_line": [("lineitem", 1, "TRUE", dict(
        invoice_line_id=LINE, invoice_id="l_orderkey", contract_line_id="l_partkey + 3", qty="l_quantity", unit_rate="floor(l_extendedprice)",
        line_amount="floor(l_extendedprice)", adjustment_flag="l_discount > 0.05", created_ms="sec * 1000", load_date="DATE '2024-02-01'"))],
}


def _base(fx, name: str) -> DataFrame:
    """A fixture table with its time as epoch seconds (sec), milliseconds (ms) and texts."""
    df = fx(name)
    ts = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}.get(name)
    if ts is None:
        return df
    day = F.to_date(ts)
    return df.withColumns({"sec": X.epoch_seconds(ts), "ms": X.epoch_millis(ts), "day_text": day.cast("string"), "next_day_text": F.date_add(day, 1).cast("string"),
                           "month_text": F.substring(day.cast("string"), 1, 7)})


#: declared staging columns that a feed leaves out (no target reads them) are not made
def staging(fx, table: str) -> DataFrame:
    """A staging table in its declared types."""
    if table == "stg_file_chat_transcripts":
        from .layer_jobs import chat_transcripts_feed
        return chat_transcripts_feed(fx)
    if table == "stg_file_qa_forms":
        return _qa_forms(fx)
    types = {f.name: f.dataType for f in schema(table)}
    out = None
    for base, copies, where, cols in FEEDS[table]:
        rows = _base(fx, base).withColumn("n", F.explode(F.array(*[F.lit(i + 1).cast("bigint") for i in range(copies)]))).where(where)
        part = rows.select(*[F.expr(e).cast("timestamp_ntz" if types[c].typeName() == "timestamp" else types[c]).alias(c) for c, e in cols.items()])
        out = part if out is None else out.unionByName(part)
    return out


def _qa_forms(fx) -> DataFrame:
    """One evaluation an order, its lines being the sections."""
    section = F.struct(F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("section_code"), F.lit(10).cast("bigint").alias("max_points"),
                       F.when(F.col("l_partkey") % 23 != 0, F.col("l_quantity").cast("bigint") % 11).alias("scored_points"))
    k = F.col("l_orderkey")
    return fx("lineitem").groupBy("l_orderkey").agg(F.collect_list(section).alias("sections")).select(
        F.concat(F.lit("QA"), k.cast("string")).alias("qa_form_id"), F.concat(F.lit("C"), k.cast("string")).alias("interaction_ref"), F.lit("qa@example.com").alias("evaluator_email"),
        ((F.lit(JANUARY) + k * 7919 % MONTH_SECONDS) * 1000).alias("evaluated_ms"), F.lit("v1").alias("form_version"), "sections", (k % 9 == 0).alias("auto_fail"),
        F.lit(None).cast("decimal(5,2)").alias("overall_pct"), F.concat(F.lit("C"), (k % 5).cast("string")).alias("client_code"), F.lit("2024-02-01").cast("date").alias("feed_date"))
