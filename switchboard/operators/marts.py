"""Staging -> ods -> dm at full width: every target column.

Each function is named after the table that it builds and takes the tables of
its parameters, so ``Builds`` can make any target from whatever holds its
sources. Results have the declared columns and types (``schemas.conform``).
Rules that the reference does not fix are named in the docstrings.

Facts find an agent's version by ``timeline.as_of``: the one in force when the
fact happened, -1 (unknown) before the first. Clients, programs and queues keep
one row a key and are looked up by an equi-join.
"""

from __future__ import annotations

import inspect
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..sources.schemas import COLUMNS, conform
from .ordered import with_global_row_number
from .timeline import as_of
from .transforms import PATH_JOIN, SEGMENT_TYPES, UNKNOWN_SK, oracle_string_to_ts

#: minutes that an approved day off counts
DAY_OFF_MINUTES = 480
HANDLED = ("TALK", "HOLD", "ACW")
RESOLVED_EVENT = "RESOLVED"


def _last_load(stg: DataFrame, key: str, order: str = "load_date") -> DataFrame:
    """The row of each key's last load (ties: the largest row)."""
    rest = [c for c in stg.columns if c != key]
    return stg.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("_v")).select(key, "_v.*")


def _each_snapshot(stg: DataFrame, key: str) -> DataFrame:
    """One row a key and load date (ties: the largest row), with snapshot_date."""
    rest = [c for c in stg.columns if c not in (key, "load_date")]
    return stg.groupBy(key, F.col("load_date").alias("snapshot_date")).agg(F.max(F.struct(*rest)).alias("_v")).select(key, "snapshot_date", "_v.*")


def _keyed(df: DataFrame, dim: DataFrame, natural: str, sk: str, on: str | None = None) -> DataFrame:
    """``df`` with the surrogate key of a dimension that has one row a key; -1 where there is none."""
    d = dim.groupBy(F.col(on or natural).alias("_nk")).agg(F.max(sk).alias("_sk"))
    return df.join(d, F.col(natural) == F.col("_nk"), "left").withColumn(sk, F.coalesce("_sk", F.lit(UNKNOWN_SK)).cast("bigint")).drop("_nk", "_sk")


def _agent_at(df: DataFrame, versions: DataFrame, ts: str, agent: str = "agent_id", out: str = "agent_sk") -> DataFrame:
    """``df`` with the surrogate key of the agent's version in force at ``ts``."""
    found = as_of(df, versions, {agent: "agent_id"}, ts, "eff_from_ts", {"agent_sk": "_at_sk"}, ["agent_sk"])
    return found.withColumn(out, F.coalesce("_at_sk", F.lit(UNKNOWN_SK)).cast("bigint")).drop("_at_sk")


def _end_of_day(day: str) -> Column:
    return X.add_seconds(F.col(day).cast("timestamp_ntz"), F.lit(86399))


# ---- ods: the last load of each key (T8) -------------------------------------------

def ods_client_acid(stg_crm_client: DataFrame) -> DataFrame:
    c = _last_load(stg_crm_client, "client_id")
    return c.withColumns({"created_ts": X.seconds_to_ts("created_ts"), "updated_ts": X.seconds_to_ts("updated_ts")})


def ods_agent_acid(stg_hr_agent: DataFrame) -> DataFrame:
    """full_name = first name, blank, last name (NULL when either is)."""
    a = _last_load(stg_hr_agent, "agent_id")
    return a.withColumns({"full_name": F.concat("first_name", F.lit(" "), "last_name"), "hire_ts": X.seconds_to_ts("hire_ts"),
                          "term_ts": X.seconds_to_ts("term_ts")})


def ods_ticket_acid(stg_tkt_ticket: DataFrame, stg_tkt_ticket_event: DataFrame) -> DataFrame:
    """resolved_ts = the last RESOLVED event of the ticket."""
    done = (stg_tkt_ticket_event.where(F.col("event_type") == RESOLVED_EVENT).groupBy(F.col("ticket_id").alias("_tid"))
            .agg(X.millis_to_ts(F.max("event_ms")).alias("resolved_ts")))
    t = _last_load(stg_tkt_ticket, "ticket_id").join(done, F.col("ticket_id") == F.col("_tid"), "left")
    return t.withColumns({"created_ts": X.millis_to_ts("created_ms"), "updated_ts": X.millis_to_ts("updated_ms")})


def ods_invoice_acid(stg_fin_invoice: DataFrame) -> DataFrame:
    """issued_ts_sec and due_ts_sec hold milliseconds, whatever their names say."""
    i = _last_load(stg_fin_invoice, "invoice_id")
    return i.withColumns({"issued_ts": X.millis_to_ts("issued_ts_sec"), "due_ts": X.millis_to_ts("due_ts_sec")})


# ---- ods: snapshots (T9) -----------------------------------------------------------

def ods_program(stg_crm_program: DataFrame) -> DataFrame:
    p = _each_snapshot(stg_crm_program, "program_id")
    return p.withColumns({"go_live_ts": X.seconds_to_ts("go_live_ts"), "updated_ts": X.seconds_to_ts("updated_ts")})


def ods_contract(stg_crm_contract: DataFrame) -> DataFrame:
    c = _each_snapshot(stg_crm_contract, "contract_id")
    return c.withColumns({f"{x}_ts": oracle_string_to_ts(F.col(f"{x}_dt")) for x in ("start", "end", "signed")})


def ods_contract_line(stg_crm_contract_line: DataFrame) -> DataFrame:
    return _each_snapshot(stg_crm_contract_line, "contract_line_id").withColumn("effective_ts", oracle_string_to_ts(F.col("effective_dt")))


def ods_org_unit(stg_hr_org_unit: DataFrame) -> DataFrame:
    return _each_snapshot(stg_hr_org_unit, "org_unit_id").withColumn("created_ts", X.seconds_to_ts("created_ts"))


def ods_queue(stg_tel_queue: DataFrame) -> DataFrame:
    return _each_snapshot(stg_tel_queue, "queue_id").withColumn("created_ts", X.seconds_to_ts("created_epoch"))


# ---- ods: cleansed events (T10-T12, T14-T19) ------------------------------------------

def ods_schedule(stg_wfm_schedule: DataFrame, stg_wfm_shift: DataFrame) -> DataFrame:
    shift = _last_load(stg_wfm_shift, "shift_id").select(F.col("shift_id").alias("_sh"), "shift_code")
    s = stg_wfm_schedule.join(shift, F.col("shift_id") == F.col("_sh"), "left")
    return s.withColumns({"start_ts": X.seconds_to_ts("start_epoch"), "end_ts": X.seconds_to_ts("end_epoch"),
                          "sched_date": F.to_date("sched_date", "yyyy-MM-dd")})


def ods_adherence_event(stg_wfm_adherence_event: DataFrame) -> DataFrame:
    """exception_minutes = whole minutes between start and end; the day is that of the start."""
    start = X.seconds_to_ts("start_epoch")
    return stg_wfm_adherence_event.withColumns({"start_ts": start, "end_ts": X.seconds_to_ts("end_epoch"), "event_date": F.to_date(start),
                                                "exception_minutes": X.floor_div(F.col("end_epoch") - F.col("start_epoch"), 60)})


def ods_call(stg_tel_call: DataFrame, stg_tel_call_segment: DataFrame) -> DataFrame:
    """Segment seconds by type, ring = answer - start, abandoned = never answered."""
    secs = F.col("end_epoch") - F.col("start_epoch")
    seg = stg_tel_call_segment.groupBy(F.col("call_id").alias("_cid")).agg(
        *[F.sum(F.when(F.col("segment_type") == t, secs)).alias(f"{t.lower()}_seconds") for t in SEGMENT_TYPES])
    c = stg_tel_call.join(seg, F.col("call_id") == F.col("_cid"), "left")
    start = X.seconds_to_ts("start_epoch")
    return c.withColumns({**{f"{t.lower()}_seconds": F.coalesce(f"{t.lower()}_seconds", F.lit(0)) for t in SEGMENT_TYPES},
                          "start_ts": start, "answer_ts": X.seconds_to_ts("answer_epoch"), "end_ts": X.seconds_to_ts("end_epoch"),
                          "ring_seconds": F.col("answer_epoch") - F.col("start_epoch"), "abandoned_flag": F.col("answer_epoch").isNull(),
                          "call_date": F.to_date(start)})


def ods_chat_session(stg_file_chat_transcripts: DataFrame) -> DataFrame:
    """Counts over the message array; first response = first agent message minus start, whole seconds."""
    def by(sender: str) -> Column:
        return F.filter("messages", lambda m: m["sender"] == sender)
    first = F.array_min(F.transform(by("agent"), lambda m: m["ts_ms"]))
    started = X.millis_to_ts("started_ms")
    return stg_file_chat_transcripts.withColumns({
        "started_ts": started, "ended_ts": X.millis_to_ts("ended_ms"), "message_count": F.size("messages"), "agent_message_count": F.size(by("agent")),
        "customer_message_count": F.size(by("customer")), "first_response_seconds": X.floor_div(first - F.col("started_ms"), 1000),
        "event_date": F.to_date(started)})


def ods_email_interaction(stg_file_email_interaction: DataFrame) -> DataFrame:
    """reply_sla_minutes = whole minutes from receipt to first reply."""
    received = X.millis_to_ts("received_ms")
    return stg_file_email_interaction.withColumns({
        "received_ts": received, "first_reply_ts": X.millis_to_ts("first_reply_ms"), "resolved_ts": X.millis_to_ts("resolved_ms"),
        "reply_sla_minutes": X.floor_div(F.col("first_reply_ms") - F.col("received_ms"), 60000), "event_date": F.to_date(received)})


def ods_survey_response(stg_file_survey_csat: DataFrame) -> DataFrame:
    """One row a survey: the last feed, then the last survey time."""
    rest = [c for c in stg_file_survey_csat.columns if c != "survey_id"]
    order = F.struct("feed_date", "survey_ms", *[c for c in rest if c not in ("feed_date", "survey_ms")])
    s = stg_file_survey_csat.groupBy("survey_id").agg(F.max_by(F.struct(*rest), order).alias("_v")).select("survey_id", "_v.*")
    return s.withColumns({"survey_ts": X.millis_to_ts("survey_ms"), "event_date": F.to_date(X.millis_to_ts("survey_ms"))})


def ods_qa_evaluation(stg_file_qa_forms: DataFrame) -> DataFrame:
    """Points folded over the sections; overall_pct = 100 * scored / maximum, two places."""
    zero = F.lit(0).cast("bigint")

    def points(field: str) -> Column:
        return F.aggregate("sections", zero, lambda a, x: a + F.coalesce(x[field], zero))
    evaluated = X.millis_to_ts("evaluated_ms")
    q = stg_file_qa_forms.withColumns({"section_count": F.size("sections"), "scored_points": points("scored_points"), "max_points": points("max_points"),
                                       "evaluated_ts": evaluated, "event_date": F.to_date(evaluated)})
    return q.withColumn("overall_pct", X.pct2(F.col("scored_points"), F.col("max_points")))


def ods_dialer_attempt(stg_file_dialer_result: DataFrame) -> DataFrame:
    """connected = any talk time."""
    at = X.millis_to_ts("attempt_ms")
    return stg_file_dialer_result.withColumns({"attempt_ts": at, "connected_flag": F.col("talk_seconds") > 0, "event_date": F.to_date(at)})


def ods_interaction(ods_call: DataFrame, ods_chat_session: DataFrame, ods_email_interaction: DataFrame, ods_dialer_attempt: DataFrame,
                    stg_file_interaction_export: DataFrame, ods_program: DataFrame, ods_client_acid: DataFrame, ods_queue: DataFrame,
                    ods_agent_acid: DataFrame) -> DataFrame:
    """Five channels in one table; id = channel letter (C call, H chat, E e-mail, D dialer, X export) and source key.

    Calls take their client from the program, chats and e-mails their agent from the address. Resolved: a call that was
    answered, an e-mail with a resolution, a chat that ended, a connected dialer attempt, an export of outcome RESOLVED.
    """
    agents = ods_agent_acid.groupBy(F.col("email").alias("_mail")).agg(F.min("agent_id").alias("_mail_agent"))
    queues = ods_queue.groupBy(F.col("queue_code").alias("_qc")).agg(F.max_by("queue_id", F.struct("snapshot_date", "queue_id")).alias("_q"))
    programs = ods_program.groupBy(F.col("program_id").alias("_p")).agg(F.max_by("client_id", F.struct("snapshot_date", "client_id")).alias("_pc"))
    clients = ods_client_acid.select(F.col("client_id").alias("_c"), F.col("client_code").alias("_cc"))
    codes = programs.join(clients, F.col("_pc") == F.col("_c"), "left").select("_p", "_cc")
    none = F.lit(None)

    def shape(df: DataFrame, letter: str, key: str, channel: str | Column, system: str, start: Column, end: Column, resolved: Column, client: Column,
              program: Column = none, queue: Column = none, agent: Column = none, customer: Column = none) -> DataFrame:
        return df.select(F.concat(F.lit(letter), F.col(key).cast("string")).alias("interaction_id"), (F.lit(channel) if isinstance(channel, str) else channel).alias("channel"),
                         client.alias("client_code"), program.cast("bigint").alias("program_id"), queue.cast("bigint").alias("queue_id"),
                         agent.cast("bigint").alias("agent_id"), customer.cast("string").alias("customer_ref"), start.alias("start_ts"), end.alias("end_ts"),
                         resolved.alias("resolved_flag"), F.lit(system).alias("source_system"))
    mailed = lambda df: df.join(agents, F.col("agent_email") == F.col("_mail"), "left")
    c = F.col
    calls = shape(ods_call.join(codes, c("program_id") == c("_p"), "left"), "C", "call_id", "VOICE", "TEL", c("start_ts"), c("end_ts"),
                  ~c("abandoned_flag"), c("_cc"), c("program_id"), c("queue_id"), c("agent_id"))
    chats = shape(mailed(ods_chat_session).join(queues, c("queue_code") == c("_qc"), "left"), "H", "chat_ref", "CHAT", "CHAT", c("started_ts"), c("ended_ts"),
                  c("ended_ts").isNotNull(), c("client_code"), queue=c("_q"), agent=c("_mail_agent"))
    mails = shape(mailed(ods_email_interaction), "E", "email_ref", "EMAIL", "MAIL", c("received_ts"), F.coalesce("resolved_ts", "first_reply_ts"),
                  c("resolved_ts").isNotNull(), c("client_code"), agent=c("_mail_agent"))
    dials = shape(ods_dialer_attempt, "D", "attempt_id", "DIALER", "DIALER", c("attempt_ts"), X.add_seconds("attempt_ts", "talk_seconds"),
                  c("connected_flag"), c("client_code"), agent=c("agent_id"))
    export = shape(mailed(stg_file_interaction_export), "X", "interaction_ref", c("channel"), "EXPORT", X.millis_to_ts("start_ms"), X.millis_to_ts("end_ms"),
                   F.coalesce(c("outcome") == "RESOLVED", F.lit(False)), c("client_code"), agent=c("_mail_agent"), customer=c("customer_ref"))
    u = reduce(DataFrame.unionByName, [calls, chats, mails, dials, export])
    return u.withColumns({"handle_seconds": X.epoch_seconds("end_ts") - X.epoch_seconds("start_ts"), "event_date": F.to_date("start_ts")})


# ---- dimensions (T23-T27) ------------------------------------------------------------

def dim_agent_versions(ods_agent_scd2: DataFrame, ods_agent_acid: DataFrame, ods_org_unit: DataFrame) -> DataFrame:
    """``dim_agent`` with eff_from_ts: a row a version; the key is the row number by agent, time and history id."""
    unit = ods_org_unit.groupBy(F.col("org_unit_id").alias("_ou")).agg(F.max_by(F.struct(F.col("unit_name").alias("team_name"), "site_code"), F.struct("snapshot_date", "unit_name")).alias("_u"))
    master = ods_agent_acid.select(F.col("agent_id").alias("_a"), "full_name", X.date_key("hire_ts").alias("hire_date_key"))
    numbered = with_global_row_number(ods_agent_scd2, [F.col("agent_id"), F.col("eff_from_ts"), F.col("agent_history_id")], "agent_sk")
    h = numbered.join(unit, F.col("org_unit_id") == F.col("_ou"), "left").join(master, F.col("agent_id") == F.col("_a"), "left")
    return h.select("agent_sk", "agent_id", "employee_no", "full_name", "job_grade", "employment_type", "org_unit_id", "_u.team_name", "_u.site_code", "status",
                    "hire_date_key", "is_current", "eff_from_ts")


def dim_agent(dim_agent_versions: DataFrame) -> DataFrame:
    return dim_agent_versions


def dim_client(ods_client_acid: DataFrame, stg_crm_client_contact: DataFrame) -> DataFrame:
    """The primary contact is the one with the lowest id; client_sk = client_id."""
    pc = (stg_crm_client_contact.where(F.col("is_primary")).groupBy(F.col("client_id").alias("_cid"))
          .agg(F.min(F.struct("contact_id", "full_name", "email")).alias("_pc")))
    c = ods_client_acid.join(pc, F.col("client_id") == F.col("_cid"), "left")
    return c.withColumns({"client_sk": F.col("client_id"), "primary_contact_name": F.col("_pc.full_name"), "primary_contact_email": F.col("_pc.email")})


def dim_program(ods_program: DataFrame, ods_contract: DataFrame) -> DataFrame:
    """The last snapshot of a program, with the billing model of its latest contract (start, then id); program_sk = program_id."""
    p = _last_load(ods_program, "program_id", "snapshot_date")
    lc = ods_contract.groupBy(F.col("program_id").alias("_pid")).agg(
        F.max(F.struct(F.col("start_ts").isNotNull().alias("some"), "start_ts", "contract_id", "snapshot_date", "billing_model")).alias("_c"))
    p = p.join(lc, F.col("program_id") == F.col("_pid"), "left")
    return p.withColumns({"program_sk": F.col("program_id"), "billing_model": F.col("_c.billing_model"), "go_live_date_key": X.date_key("go_live_ts")})


def dim_queue(ods_queue: DataFrame) -> DataFrame:
    return _last_load(ods_queue, "queue_id", "snapshot_date").withColumn("queue_sk", F.col("queue_id"))


def dim_shift(stg_wfm_shift: DataFrame) -> DataFrame:
    return _last_load(stg_wfm_shift, "shift_id").withColumn("shift_sk", F.col("shift_id"))


def dim_disposition(stg_tel_disposition_code: DataFrame) -> DataFrame:
    """One row a code; the key is the code's place in order."""
    return with_global_row_number(_last_load(stg_tel_disposition_code, "disposition_code"), [F.col("disposition_code")], "disposition_sk")


def dim_site(ods_org_unit: DataFrame) -> DataFrame:
    """The sites that org units name: named after the SITE unit, region after the unit above it. Country and zone have no source."""
    u = _last_load(ods_org_unit, "org_unit_id", "snapshot_date")
    above = u.select(F.col("org_unit_id").alias("_up"), F.col("unit_name").alias("_region"))
    named = u.join(above, F.col("parent_unit_id") == F.col("_up"), "left").where(F.col("site_code").isNotNull())
    at = F.when(F.col("unit_type") == "SITE", F.struct(F.col("org_unit_id").alias("id"), F.col("unit_name").alias("n"), F.col("_region").alias("r")))
    s = named.groupBy("site_code").agg(F.min(at).alias("_s"))
    s = with_global_row_number(s, [F.col("site_code")], "site_sk")
    return s.select("site_sk", "site_code", F.col("_s.n").alias("site_name"), F.col("_s.r").alias("region"), F.lit(None).cast("string").alias("country"),
                    F.lit(None).cast("string").alias("timezone"))


def dim_org(ods_org_unit: DataFrame) -> DataFrame:
    """The hierarchy's paths as level names; org_sk = the row number by unit id."""
    from ..plans.views import org_hierarchy
    u = _last_load(ods_org_unit, "org_unit_id", "snapshot_date")
    cost = u.select(F.col("org_unit_id").alias("_id"), "cost_center")
    names = F.split("path_names", F.lit(PATH_JOIN), -1)
    o = org_hierarchy(u).join(cost, F.col("org_unit_id") == F.col("_id"))
    o = o.withColumns({f"level{i + 1}_name": F.get(names, F.lit(i)) for i in range(4)})
    return with_global_row_number(o, [F.col("org_unit_id")], "org_sk")


# ---- facts (T28, T29, T31-T34) ---------------------------------------------------------

def fact_interaction(ods_interaction: DataFrame, dim_client: DataFrame, dim_program: DataFrame, dim_queue: DataFrame, dim_agent_versions: DataFrame) -> DataFrame:
    f = _keyed(ods_interaction, dim_client, "client_code", "client_sk")
    f = _keyed(f, dim_program, "program_id", "program_sk")
    f = _keyed(f, dim_queue, "queue_id", "queue_sk")
    return _agent_at(f, dim_agent_versions, "start_ts").withColumn("date_key", X.date_key("start_ts"))


def fact_agent_activity(stg_tel_agent_state_event: DataFrame, dim_agent_versions: DataFrame) -> DataFrame:
    """Seconds, occurrences, first and last start by agent version, state and day of the start."""
    e = stg_tel_agent_state_event.select("agent_id", "state_code", X.seconds_to_ts("start_epoch").alias("_ts"), (F.col("end_epoch") - F.col("start_epoch")).alias("_s"))
    e = _agent_at(e, dim_agent_versions, "_ts")
    return e.groupBy("agent_sk", "state_code", X.date_key("_ts").alias("date_key")).agg(
        F.sum("_s").alias("state_seconds"), F.count(F.lit(1)).alias("occurrence_count"), F.min("_ts").alias("first_state_ts"), F.max("_ts").alias("last_state_ts"))


def _by_interaction(df: DataFrame, fact_interaction: DataFrame) -> DataFrame:
    keys = fact_interaction.select(F.col("interaction_id").alias("_i"), "agent_sk", "program_sk", "client_sk")
    unknown = {k: F.coalesce(k, F.lit(UNKNOWN_SK)).cast("bigint") for k in ("agent_sk", "program_sk", "client_sk")}
    return df.join(keys, F.col("interaction_ref") == F.col("_i"), "left").withColumns({**unknown, "interaction_id": F.col("interaction_ref")})


def fact_csat_survey(ods_survey_response: DataFrame, fact_interaction: DataFrame) -> DataFrame:
    """Keys of the interaction that the survey names."""
    return _by_interaction(ods_survey_response, fact_interaction).withColumn("date_key", X.date_key("survey_ts"))


def fact_qa_evaluation(ods_qa_evaluation: DataFrame, fact_interaction: DataFrame) -> DataFrame:
    """Keys of the interaction that was evaluated."""
    return _by_interaction(ods_qa_evaluation, fact_interaction).withColumn("date_key", X.date_key("evaluated_ts"))


def fact_billing_line(stg_fin_invoice_line: DataFrame, ods_contract_line: DataFrame, ods_invoice_acid: DataFrame, dim_client: DataFrame, dim_program: DataFrame) -> DataFrame:
    """Service from the contract line, client, program, status and month from the invoice."""
    line = _last_load(stg_fin_invoice_line, "invoice_line_id")
    service = ods_contract_line.groupBy(F.col("contract_line_id").alias("_cl")).agg(F.max_by("service_code", F.struct("snapshot_date", "service_code")).alias("service_code"))
    inv = ods_invoice_acid.select(F.col("invoice_id").alias("_inv"), "client_id", "program_id", "period_month", F.col("status").alias("invoice_status"))
    f = line.join(service, F.col("contract_line_id") == F.col("_cl"), "left").join(inv, F.col("invoice_id") == F.col("_inv"), "left")
    f = _keyed(_keyed(f, dim_client, "client_id", "client_sk"), dim_program, "program_id", "program_sk")
    return f.withColumn("period_month", F.to_date(F.concat("period_month", F.lit("-01")), "yyyy-MM-dd"))


def occupancy(states: DataFrame) -> DataFrame:
    """agent_sk, date_key, handled and ready seconds of ``fact_agent_activity``."""
    s = F.col("state_seconds")
    return states.groupBy("agent_sk", "date_key").agg(F.sum(F.when(F.col("state_code").isin(*HANDLED), s).otherwise(0)).alias("_handled"),
                                                      F.sum(F.when(F.col("state_code").isin(*HANDLED, "READY"), s).otherwise(0)).alias("_staffed"))


def fact_adherence_daily(ods_schedule: DataFrame, ods_adherence_event: DataFrame, ods_timesheet: DataFrame, stg_wfm_timeoff_request: DataFrame,
                         fact_agent_activity: DataFrame, dim_agent_versions: DataFrame) -> DataFrame:
    """Minutes per agent version (in force at the day's end) and day; adherence = 100 * (scheduled - exception) / scheduled,
    occupancy = 100 * handled / (handled + ready) of the activity, both NULL without a divisor or beyond three digits.
    An approved request counts DAY_OFF_MINUTES a day."""
    def minutes(df: DataFrame, day: Column, m: Column, tag: str) -> DataFrame:
        return df.select("agent_id", day.alias("_day"), m.cast("bigint").alias("_m"), F.lit(tag).alias("_tag"))
    off = stg_wfm_timeoff_request.where(F.col("status") == "APPROVED").select("agent_id", F.explode(F.sequence(F.to_date("start_date"), F.to_date("end_date"))).alias("_d"))
    u = reduce(DataFrame.unionByName, [
        minutes(ods_schedule, F.col("sched_date"), F.col("paid_minutes"), "scheduled"), minutes(ods_adherence_event, F.col("event_date"), F.col("exception_minutes"), "exception"),
        minutes(ods_timesheet, F.to_date("work_date"), F.col("billable_minutes") + F.col("nonbillable_minutes"), "worked"),
        minutes(off, F.col("_d"), F.lit(DAY_OFF_MINUTES), "timeoff")])
    tags = ("scheduled", "worked", "exception", "timeoff")
    daily = u.groupBy("agent_id", "_day").agg(*[F.coalesce(F.sum(F.when(F.col("_tag") == t, F.col("_m"))), F.lit(0)).alias(f"{t}_minutes") for t in tags])
    daily = _agent_at(daily.withColumn("_end", _end_of_day("_day")), dim_agent_versions, "_end").withColumn("date_key", X.date_key("_day"))
    names = [f"{t}_minutes" for t in tags]
    # several agents may be unknown on a day: one row a key
    daily = daily.groupBy("agent_sk", "date_key").agg(*[F.sum(n).alias(n) for n in names])
    occ = occupancy(fact_agent_activity).select(F.col("agent_sk").alias("_a"), F.col("date_key").alias("_d"), "_handled", "_staffed")
    j = daily.join(occ, (F.col("agent_sk") == F.col("_a")) & (F.col("date_key") == F.col("_d")), "left")
    return j.withColumns({"adherence_pct": X.pct2(F.col("scheduled_minutes") - F.col("exception_minutes"), F.col("scheduled_minutes")),
                          "occupancy_pct": X.pct2(F.col("_handled"), F.col("_staffed"))})


def fact_ticket(ods_ticket_acid: DataFrame, stg_tkt_ticket_event: DataFrame, stg_tkt_category: DataFrame, dim_program: DataFrame, dim_agent_versions: DataFrame) -> DataFrame:
    """The assigned agent's version in force when the ticket was opened; breached = more minutes than the category's hours."""
    touches = stg_tkt_ticket_event.groupBy(F.col("ticket_id").alias("_tid")).agg(F.count(F.lit(1)).alias("touch_count"))
    cat = _last_load(stg_tkt_category, "category_id").select(F.col("category_id").alias("_cat"), "category_code", "sla_hours")
    t = ods_ticket_acid.join(touches, F.col("ticket_id") == F.col("_tid"), "left").join(cat, F.col("category_id") == F.col("_cat"), "left")
    t = _agent_at(_keyed(t, dim_program, "program_id", "program_sk"), dim_agent_versions, "created_ts", "assigned_agent_id", "assigned_agent_sk")
    minutes = X.floor_div(X.epoch_seconds("resolved_ts") - X.epoch_seconds("created_ts"), 60)
    return t.withColumns({"resolution_minutes": minutes, "sla_breached_flag": F.coalesce(minutes > F.col("sla_hours") * 60, F.lit(False)),
                          "touch_count": F.coalesce("touch_count", F.lit(0)), "date_key": X.date_key("created_ts")})


# ---- aggregates (T36, T37) -----------------------------------------------------------

def _weighted(df: DataFrame, value: str) -> tuple[Column, Column]:
    """Sums for an average of a two-place decimal weighted by interactions, in hundredths."""
    w = F.when(F.col(value).isNotNull(), F.col("interactions_handled"))
    return F.sum((F.col(value) * 100).cast("bigint") * F.col("interactions_handled")).alias(f"_{value}_n"), F.sum(w).alias(f"_{value}_d")


def agg_agent_daily(fact_interaction: DataFrame, fact_agent_activity: DataFrame, fact_adherence_daily: DataFrame, dim_agent: DataFrame) -> DataFrame:
    """Per agent version and day: volume and handle time, state seconds, adherence and occupancy, the version's site."""
    i = fact_interaction.groupBy("agent_sk", "date_key").agg(F.count(F.lit(1)).alias("interactions_handled"), F.sum("handle_seconds").alias("_h"), F.count("handle_seconds").alias("_n"))
    st, s = F.col("state_code"), F.col("state_seconds")
    a = fact_agent_activity.groupBy("agent_sk", "date_key").agg(
        F.sum(F.when(st == "TALK", s)).alias("talk_seconds"), F.sum(F.when(st == "ACW", s)).alias("acw_seconds"), F.sum(F.when(st.like("AUX%"), s)).alias("aux_seconds"),
        F.sum(F.when(st.isin(*HANDLED), s).otherwise(0)).alias("_handled"), F.sum(F.when(st.isin(*HANDLED, "READY"), s).otherwise(0)).alias("_staffed"))
    adh = fact_adherence_daily.select("agent_sk", "date_key", "adherence_pct")
    parts = ("interactions_handled", "_h", "_n", "talk_seconds", "acw_seconds", "aux_seconds", "_handled", "_staffed", "adherence_pct")
    u = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [i, a, adh]).groupBy("agent_sk", "date_key").agg(*[F.max(c).alias(c) for c in parts])
    site = dim_agent.select(F.col("agent_sk").alias("_a"), "site_code")
    u = u.join(site, F.col("agent_sk") == F.col("_a"), "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("interactions_handled", "talk_seconds", "acw_seconds", "aux_seconds")}
    return u.withColumns({**zero, "avg_handle_seconds": X.ratio2(F.col("_h"), F.col("_n"), "decimal(8,2)"), "occupancy_pct": X.pct2(F.col("_handled"), F.col("_staffed"))})


def agg_agent_weekly(agg_agent_daily: DataFrame) -> DataFrame:
    """Per agent version and ISO week (its Monday): averages weighted by interactions."""
    day = X.parse_date_key("date_key")
    d = agg_agent_daily.withColumn("week_start_key", X.date_key(F.date_sub(day, F.weekday(day))))
    names = {"avg_handle_seconds": "decimal(8,2)", "adherence_pct": "decimal(5,2)", "occupancy_pct": "decimal(5,2)"}
    g = d.groupBy("agent_sk", "week_start_key").agg(F.max("site_code").alias("site_code"), F.count(F.lit(1)).alias("days_worked"),
                                                    F.sum("interactions_handled").alias("interactions_handled"), *[c for n in names for c in _weighted(d, n)])
    return g.withColumns({n: X.ratio0(F.col(f"_{n}_n"), F.col(f"_{n}_d"), kind) for n, kind in names.items()})


def agg_program_monthly(fact_interaction: DataFrame, fact_csat_survey: DataFrame, fact_billing_line: DataFrame, dim_program: DataFrame) -> DataFrame:
    """Month x ROLLUP(client, program, line of business) of interactions, satisfaction and billing; each input is summed at
    the finest grain first. grouping_level 0 is the detail."""
    lob = dim_program.select(F.col("program_sk").alias("_p"), "line_of_business")
    keys = ["period_month", "client_sk", "program_sk", "line_of_business"]

    def fine(df: DataFrame, month: Column, *aggs: Column) -> DataFrame:
        return df.withColumn("period_month", month).join(lob, F.col("program_sk") == F.col("_p"), "left").groupBy(*keys).agg(*aggs)
    parts = [fine(fact_interaction, X.month_start("start_ts"), F.count(F.lit(1)).alias("_n"), F.sum("handle_seconds").alias("_h"), F.count("handle_seconds").alias("_hn")),
             fine(fact_csat_survey, X.month_start("survey_ts"), F.sum("csat_score").alias("_cs"), F.count("csat_score").alias("_cn")),
             fine(fact_billing_line, F.col("period_month"), F.sum("line_amount").alias("_b"))]
    u = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    g = u.groupingSets([keys, keys[:3], keys[:2], keys[:1]], *keys).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("interactions"), F.sum("_h").alias("_h"), F.sum("_hn").alias("_hn"), F.sum("_cs").alias("_cs"), F.sum("_cn").alias("_cn"),
        F.sum("_b").alias("billed_amount"), F.grouping_id().alias("grouping_level"))
    return g.withColumns({"avg_handle_seconds": X.ratio2(F.col("_h"), F.col("_hn"), "decimal(8,2)"), "avg_csat": X.ratio2(F.col("_cs"), F.col("_cn"), "decimal(5,2)")})


BUILDERS: dict[str, Callable[..., DataFrame]] = {n: f for n, f in globals().items() if n in COLUMNS or n == "dim_agent_versions"}


class Builds:
    """Targets made from ``source``(name) -> DataFrame: a table is built when a builder is known for it and the source
    does not hold it (``held``), and only once."""

    def __init__(self, source: Callable[[str], DataFrame], held: set[str] = frozenset()):
        self._source, self._held, self._made = source, held, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            make = BUILDERS.get(name)
            if make is None or name in self._held:
                self._made[name] = self._source(name)
            else:
                made = make(**{p: self[p] for p in inspect.signature(make).parameters})
                self._made[name] = conform(made, name) if name in COLUMNS else made
        return self._made[name]
