"""Layer transforms: staging -> ods -> dm (T1-T42; T6 is in ``operators.changelog``).

The reference fixes only the source and target tables of these jobs; the
rules below that it does not fix are chosen here and named in each
docstring. Every transform is a DataFrame function (no driver loops, no
collect); per-key "latest row" logic is a max-by aggregate so that partial
aggregation absorbs hot keys, and per-key sequences (SCD-2) use the
two-level windows of ``operators.timeline``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from .ordered import with_global_row_number
from .timeline import ordered_concat, with_next, with_previous

# --- fixed values chosen here ----------------------------------------------
MILLIS_THRESHOLD = 100_000_000_000          # a "seconds" value above this is millis
SL_THRESHOLD_SECONDS = 20
INTERVAL_MINUTES = 30
IVR_TRANSFER_KEY = "0"
PATH_JOIN = " > "
UNKNOWN_SK = -1
# ---------------------------------------------------------------------------


def epoch_seconds_to_ts(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """INT64 epoch seconds -> TIMESTAMP (0 and negatives kept)."""
    return df.withColumn(out or col, X.seconds_to_ts(col))


def epoch_millis_to_ts(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """INT64 epoch milliseconds -> TIMESTAMP."""
    return df.withColumn(out or col, X.millis_to_ts(col))


def oracle_string_to_ts(s) -> Column:
    """T3: 'YYYYMMDDHH24MISS' text -> TIMESTAMP, NULL for text that is not a
    valid instant (wrong length, non-digits, month 13 ...)."""
    s = X.col(s)
    part = lambda a, n: F.substring(s, a, n).try_cast("int")
    ok = s.rlike(r"^[0-9]{14}$")
    ts = F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2), part(9, 2), part(11, 2),
                                  part(13, 2).cast("decimal(8,6)"))
    return F.when(ok, ts)


def mislabelled_millis_to_ts(df: DataFrame, col: str, out: str) -> DataFrame:
    """T4: a column named seconds whose values are milliseconds -> TIMESTAMP,
    plus ``<out>_unit_is_millis`` (value magnitude above 1e11) as an audit."""
    return (df.withColumn(out, X.millis_to_ts(col))
            .withColumn(f"{out}_unit_is_millis", F.abs(F.col(col)) > F.lit(MILLIS_THRESHOLD)))


def promote_partition_string(m) -> Column:
    """T5: 'YYYY-MM' partition text -> first day of that month (DATE)."""
    return F.to_date(F.concat(X.col(m), F.lit("-01")), "yyyy-MM-dd")


def _signature(cols: list[str]) -> Column:
    return F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols])


def scd2_build(changes: DataFrame, key: str, tracked: list[str], ts: str, tiebreak: str,
               id_col: str = "history_id") -> DataFrame:
    """Type-2 history from timestamped snapshots of tracked attributes.

    A row opens a version when its tracked values differ from the previous
    row of the key (LAG on a row signature); ``eff_to_ts`` is the next
    version's ``eff_from_ts`` (NULL for the current one). history id =
    sha2(key|eff_from microseconds). Both the LAG and the "next version" run
    in two levels (``timeline``), so one key with a huge history is split
    across tasks.
    """
    base = changes.select(key, *tracked, F.col(ts).alias("eff_from_ts"), F.col(tiebreak).alias("_tb"),
                          _signature(tracked).alias("_sig"))
    with_prev = with_previous(base, [key], "eff_from_ts", ["_tb"], "_sig", "_prev_sig")
    versions = with_prev.where(F.col("_prev_sig").isNull() | (F.col("_prev_sig") != F.col("_sig"))).drop("_prev_sig", "_sig")
    nxt = with_next(versions, [key], "eff_from_ts", ["_tb"], "eff_from_ts", "eff_to_ts")
    micros = X.epoch_micros("eff_from_ts")
    return nxt.select(
        F.sha2(F.concat_ws("|", F.col(key).cast("string"), micros.cast("string")), 256).alias(id_col),
        key, *tracked, "eff_from_ts", "eff_to_ts", F.col("eff_to_ts").isNull().alias("is_current"),
        F.year("eff_from_ts").cast("bigint").alias("eff_from_year"))


def current_state_upsert(current: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE without MERGE: full outer join on the key, newer batch value
    wins per column, rows of either side are kept (last load wins)."""
    cols = [c for c in current.columns if c not in keys]
    c = current.select(*keys, *[F.col(x).alias(f"_c_{x}") for x in cols], F.lit(True).alias("_in_c"))
    b = batch.select(*keys, *[F.col(x).alias(f"_b_{x}") for x in cols], F.lit(True).alias("_in_b"))
    j = c.join(b, keys, "full_outer")
    return j.select(*keys, *[F.when(F.col("_in_b").isNotNull(), F.col(f"_b_{x}")).otherwise(F.col(f"_c_{x}")).alias(x)
                             for x in cols])


def snapshot_conform(stg: DataFrame, key: str, snapshot_col: str, order_cols: list[str],
                     cols: list[str]) -> DataFrame:
    """One row per key and snapshot (the latest by ``order_cols``)."""
    latest = stg.groupBy(key, snapshot_col).agg(
        F.max_by(F.struct(*cols), F.struct(*order_cols)).alias("_v"))
    return latest.select(key, *[F.col(f"_v.{c}").alias(c) for c in cols], F.col(snapshot_col).alias("snapshot_date"))


def schedule_enrich(stg_wfm_schedule: DataFrame, stg_wfm_shift: DataFrame) -> DataFrame:
    """Schedule rows with shift code, TIMESTAMP bounds and DATE partition."""
    sh = stg_wfm_shift.select(F.col("shift_id").alias("_sh"), "shift_code")
    s = stg_wfm_schedule.join(sh, F.col("shift_id") == F.col("_sh"), "left")
    return s.select("schedule_id", "agent_id", "shift_id", "shift_code",
                    X.seconds_to_ts("start_epoch").alias("start_ts"), X.seconds_to_ts("end_epoch").alias("end_ts"),
                    F.floor((F.col("end_epoch") - F.col("start_epoch")) / 60).cast("bigint").alias("paid_minutes"),
                    "site_code", F.to_date("sched_date", "yyyy-MM-dd").alias("sched_date"))


def adherence_minutes(stg_wfm_adherence_event: DataFrame) -> DataFrame:
    """Exception minutes = floor((end - start) / 60)."""
    e = stg_wfm_adherence_event
    return e.select("adherence_event_id", "agent_id", X.seconds_to_ts("start_epoch").alias("start_ts"),
                    X.seconds_to_ts("end_epoch").alias("end_ts"),
                    F.floor((F.col("end_epoch") - F.col("start_epoch")) / 60).cast("bigint").alias("exception_minutes"),
                    F.to_date(X.seconds_to_ts("start_epoch")).alias("event_date"))


SEGMENT_TYPES = ("TALK", "HOLD", "ACW")


def call_durations(stg_tel_call: DataFrame, stg_tel_call_segment: DataFrame) -> DataFrame:
    """Per call, segment seconds pivoted by type (fixed list, no
    driver-side discovery), ring time and abandonment."""
    seg = stg_tel_call_segment.select("call_id", "segment_type",
                                      (F.col("end_epoch") - F.col("start_epoch")).alias("_d"))
    piv = seg.groupBy(F.col("call_id").alias("_cid")).agg(*[
        F.sum(F.when(F.col("segment_type") == t, F.col("_d")).otherwise(0)).cast("bigint").alias(f"{t.lower()}_seconds")
        for t in SEGMENT_TYPES])
    c = stg_tel_call.join(piv, F.col("call_id") == F.col("_cid"), "left")
    return c.select("call_id", (F.col("answer_epoch") - F.col("start_epoch")).alias("ring_seconds"),
                    *[F.coalesce(F.col(f"{t.lower()}_seconds"), F.lit(0)).alias(f"{t.lower()}_seconds")
                      for t in SEGMENT_TYPES],
                    F.col("answer_epoch").isNull().alias("abandoned_flag"),
                    F.to_date(X.seconds_to_ts("start_epoch")).alias("call_date"))


def ivr_sessionize(stg_file_ivr_logs: DataFrame) -> DataFrame:
    """IVR events -> one row per session: first/last event, full menu
    path in event order, hops, exit key; contained = the last key is not
    the operator transfer key. The path is built by ``ordered_concat``: the
    events of an hour first, then the hours, so no task gathers all events of a
    session."""
    e = stg_file_ivr_logs
    g = e.groupBy("session_ref", "client_code").agg(
        F.min("event_ms").alias("_first"), F.max("event_ms").alias("_last"),
        F.count(F.lit(1)).alias("hops"),
        F.max_by("key_pressed", F.struct("event_ms", "event_seq")).alias("exit_key"))
    path = ordered_concat(e, ["session_ref", "client_code"], "event_ms", ["event_seq"], "menu_path", PATH_JOIN,
                          "menu_path_full", width=3_600_000)
    path = path.select(F.col("session_ref").alias("_ref"), F.col("client_code").alias("_client"), "menu_path_full")
    # null-safe: an unparsed log line has no session or client, and is kept as a session of its own
    g = g.join(path, F.col("session_ref").eqNullSafe(F.col("_ref")) & F.col("client_code").eqNullSafe(F.col("_client")))
    return g.select("session_ref", "client_code", X.millis_to_ts("_first").alias("first_event_ts"),
                    X.millis_to_ts("_last").alias("last_event_ts"), "menu_path_full",
                    "hops", F.coalesce(F.col("exit_key") != IVR_TRANSFER_KEY, F.lit(True)).alias("contained_flag"),
                    "exit_key", F.to_date(X.millis_to_ts("_first")).alias("event_date"))


def ivr_path_fact(ods_ivr_session: DataFrame) -> DataFrame:
    """Session fact with duration and date key."""
    s = ods_ivr_session
    return s.select("session_ref", "client_code", "menu_path_full", "hops", "contained_flag", "exit_key",
                    (X.epoch_seconds("last_event_ts") - X.epoch_seconds("first_event_ts")).alias("duration_seconds"),
                    X.date_key("first_event_ts").alias("date_key"))


def chat_session_metrics(stg_file_chat_transcripts: DataFrame) -> DataFrame:
    """Message counts and first agent response from the message array
    (higher-order functions on the row; no explode, no shuffle)."""
    msgs = F.col("messages")
    agent = F.filter(msgs, lambda m: m["sender"] == "agent")
    first_agent_ms = F.array_min(F.transform(agent, lambda m: m["ts_ms"]))
    return stg_file_chat_transcripts.select(
        "chat_ref", "client_code", X.millis_to_ts("started_ms").alias("started_ts"),
        X.millis_to_ts("ended_ms").alias("ended_ts"), F.size(msgs).cast("bigint").alias("message_count"),
        F.size(agent).cast("bigint").alias("agent_message_count"),
        F.size(F.filter(msgs, lambda m: m["sender"] == "customer")).cast("bigint").alias("customer_message_count"),
        F.floor((first_agent_ms - F.col("started_ms")) / 1000).cast("bigint").alias("first_response_seconds"),
        F.to_date(X.millis_to_ts("started_ms")).alias("event_date"))


def email_sla(stg_file_email_interaction: DataFrame) -> DataFrame:
    """Minutes from receipt to first reply (floored)."""
    e = stg_file_email_interaction
    return e.select("email_ref", "client_code", X.millis_to_ts("received_ms").alias("received_ts"),
                    X.millis_to_ts("first_reply_ms").alias("first_reply_ts"),
                    F.floor((F.col("first_reply_ms") - F.col("received_ms")) / 60000).cast("bigint").alias("reply_sla_minutes"),
                    F.to_date(X.millis_to_ts("received_ms")).alias("event_date"))


def survey_cleanse(stg_file_survey_csat: DataFrame) -> DataFrame:
    """One row per survey id; the latest feed (then latest survey time) wins."""
    cols = ["client_code", "interaction_ref", "survey_ms", "csat_score", "nps_score"]
    g = stg_file_survey_csat.groupBy("survey_id").agg(
        F.max_by(F.struct(*cols), F.struct("feed_date", "survey_ms")).alias("_v"))
    return g.select("survey_id", "_v.client_code", "_v.interaction_ref",
                    X.millis_to_ts("_v.survey_ms").alias("survey_ts"), "_v.csat_score", "_v.nps_score",
                    F.to_date(X.millis_to_ts("_v.survey_ms")).alias("event_date"))


def qa_section_totals(stg_file_qa_forms: DataFrame) -> DataFrame:
    """Section count and point totals folded over the section array."""
    s = F.col("sections")
    zero = F.lit(0).cast("bigint")
    scored = F.aggregate(s, zero, lambda acc, x: acc + F.coalesce(x["scored_points"], zero))
    mx = F.aggregate(s, zero, lambda acc, x: acc + F.coalesce(x["max_points"], zero))
    return stg_file_qa_forms.select("qa_form_id", F.size(s).cast("bigint").alias("section_count"),
                                    scored.alias("scored_points"), mx.alias("max_points"),
                                    (X.safe_divide(scored, mx) * 100).alias("overall_pct"))


def interaction_unify(calls: DataFrame, chats: DataFrame, emails: DataFrame, dialer: DataFrame) -> DataFrame:
    """One interaction table from four channels; id = channel letter +
    source key (C call, H chat, E email, D dialer - chosen here)."""
    def shape(df, letter, channel, system):
        return df.select(F.concat(F.lit(letter), F.col("source_key").cast("string")).alias("interaction_id"),
                         F.lit(channel).alias("channel"), "customer_ref", "start_ts", "end_ts",
                         X.epoch_seconds("end_ts").alias("_e"), X.epoch_seconds("start_ts").alias("_s"),
                         F.lit(system).alias("source_system"))
    parts = [shape(calls, "C", "VOICE", "TEL"), shape(chats, "H", "CHAT", "CHAT"),
             shape(emails, "E", "EMAIL", "MAIL"), shape(dialer, "D", "DIALER", "DIALER")]
    u = reduce(DataFrame.unionByName, parts)
    return u.select("interaction_id", "channel", "customer_ref", "start_ts", "end_ts",
                    (F.col("_e") - F.col("_s")).alias("handle_seconds"), "source_system",
                    F.to_date("start_ts").alias("event_date"))


def dialer_connect(stg_file_dialer_result: DataFrame) -> DataFrame:
    """connected = talk_seconds > 0."""
    d = stg_file_dialer_result
    return d.select("attempt_id", "agent_id", X.millis_to_ts("attempt_ms").alias("attempt_ts"), "result_code",
                    (F.col("talk_seconds") > 0).alias("connected_flag"), "talk_seconds",
                    F.to_date(X.millis_to_ts("attempt_ms")).alias("event_date"))


def map_to_entries(df: DataFrame, map_col: str, out: str) -> DataFrame:
    """MAP -> ARRAY<STRUCT<key, value>> (duplicates survive in arrays)."""
    return df.withColumn(out, F.map_entries(map_col))


def regex_log_parse(lines: DataFrame, pattern: str, fields: list[str], text_col: str = "value") -> DataFrame:
    """One capture group per field; unparsed lines keep NULL fields."""
    ok = F.col(text_col).rlike(pattern)
    return lines.select(*[c for c in lines.columns if c != text_col],
                        *[F.when(ok, F.regexp_extract(text_col, pattern, i + 1)).alias(f) for i, f in enumerate(fields)])


# fixed-date US holidays (month, day), chosen here
US_FIXED_HOLIDAYS = ((1, 1), (7, 4), (11, 11), (12, 25))


def dim_date_generate(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """One row per calendar day between the bounds (fiscal = calendar)."""
    d = F.col("full_date_d")
    days = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("full_date_d"))
    hol = reduce(lambda a, b: a | b, [(F.month(d) == m) & (F.dayofmonth(d) == dd) for m, dd in US_FIXED_HOLIDAYS])
    return days.select(
        X.date_key(d).alias("date_key"), F.date_format(d, "yyyy-MM-dd").alias("full_date"),
        (F.weekday(d) + 1).cast("bigint").alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"), F.month(d).cast("bigint").alias("month_no"),
        F.date_format(d, "MMMM").alias("month_name"), F.quarter(d).cast("bigint").alias("quarter_no"),
        F.year(d).cast("bigint").alias("year_no"), (F.weekday(d) >= 5).alias("is_weekend"), hol.alias("is_holiday_us"),
        F.concat(F.lit("FY"), F.year(d).cast("string"), F.lit("-P"), F.lpad(F.month(d).cast("string"), 2, "0")).alias("fiscal_period"))


def dim_agent_build(ods_agent_scd2: DataFrame, ods_org_unit: DataFrame) -> DataFrame:
    """One dimension row per agent version; surrogate key = global row
    number over (agent_id, eff_from_ts, history id), computed over range
    partitions; team name from the org unit."""
    org = ods_org_unit.select(F.col("org_unit_id").alias("_ou"), F.col("unit_name").alias("team_name"),
                              F.col("site_code"))
    h = ods_agent_scd2.join(org, F.col("org_unit_id") == F.col("_ou"), "left")
    latest = ods_agent_scd2.groupBy(F.col("agent_id").alias("_a")).agg(
        F.max(F.struct("eff_from_ts", "agent_history_id")).alias("_mx"))
    h = h.join(latest, F.col("agent_id") == F.col("_a"), "left")
    h = with_global_row_number(h, [F.col("agent_id"), F.col("eff_from_ts"), F.col("agent_history_id")], "agent_sk")
    cur = (F.col("_mx.eff_from_ts") == F.col("eff_from_ts")) & (F.col("_mx.agent_history_id") == F.col("agent_history_id"))
    return h.select("agent_sk", "agent_id", "employee_no", "job_grade", "employment_type", "org_unit_id", "team_name",
                    "site_code", "status", cur.alias("is_current"))


def dim_client_build(ods_client_acid: DataFrame, stg_crm_client_contact: DataFrame) -> DataFrame:
    """Client with its primary contact (lowest contact_id among primaries)."""
    pc = (stg_crm_client_contact.where(F.col("is_primary") == F.lit(True))
          .groupBy(F.col("client_id").alias("_cid"))
          .agg(F.min_by(F.struct("full_name", "email"), F.col("contact_id")).alias("_pc")))
    c = ods_client_acid.join(pc, F.col("client_id") == F.col("_cid"), "left")
    return c.select(F.col("client_id").alias("client_sk"), "client_id", "client_code", "client_name",
                    F.col("_pc.full_name").alias("primary_contact_name"),
                    F.col("_pc.email").alias("primary_contact_email"), "status")


def dim_program_build(ods_program: DataFrame, ods_contract: DataFrame) -> DataFrame:
    """Program with the billing model of its latest contract
    (latest start, then highest contract id)."""
    lc = ods_contract.groupBy(F.col("program_id").alias("_pid")).agg(
        F.max_by(F.struct("billing_model", "contract_id"), F.struct("start_ts", "contract_id")).alias("_c"))
    p = ods_program.join(lc, F.col("program_id") == F.col("_pid"), "left")
    return p.select(F.col("program_id").alias("program_sk"), "program_id", "program_code", "client_id",
                    F.col("_c.billing_model").alias("billing_model"),
                    F.col("_c.contract_id").alias("latest_contract_id"), "status")


def dim_org_flatten(org_paths: DataFrame, levels: int = 4) -> DataFrame:
    """Hierarchy paths (V1 output) split into level1..levelN names."""
    parts = F.split(F.col("path_names"), F.lit(" > "), -1)
    return org_paths.select("org_unit_id", "unit_code", "unit_name", "unit_type",
                            *[F.get(parts, i).alias(f"level{i + 1}_name") for i in range(levels)],
                            "site_code", "depth")


def dim_small_build(codes: DataFrame, code_col: str, sk_col: str) -> DataFrame:
    """Distinct codes with a dense surrogate key in code order."""
    d = codes.select(code_col).where(F.col(code_col).isNotNull()).distinct()
    return with_global_row_number(d, [F.col(code_col)], sk_col).select(sk_col, code_col)


def _left_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys of which a NULL equals a NULL, as two GROUP BY results of the same keys need."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r, on, "left").drop(*[f"_r_{k}" for k in keys])


def lookup_sk(fact: DataFrame, dim: DataFrame, natural: str, dim_natural: str, sk: str) -> DataFrame:
    """Surrogate-key lookup with UNKNOWN (-1) for misses. The dimension side
    is deduplicated on its natural key first so the fact cannot fan out: of
    several versions the current one counts, else the latest key."""
    version = F.struct(F.coalesce(F.col("is_current"), F.lit(False)).alias("c"), F.col(sk)) if "is_current" in dim.columns else F.col(sk)
    d = dim.groupBy(F.col(dim_natural).alias("_nk")).agg(F.max_by(sk, version).alias("_sk"))
    j = fact.join(d, F.col(natural) == F.col("_nk"), "left")
    return j.withColumn(sk, F.coalesce(F.col("_sk"), F.lit(UNKNOWN_SK)).cast("bigint")).drop("_nk", "_sk")


def agent_activity_rollup(stg_tel_agent_state_event: DataFrame) -> DataFrame:
    """Per agent, state and day: seconds, occurrences, first/last start.
    Days are those of the state start (no split at midnight)."""
    e = stg_tel_agent_state_event.select("agent_id", "state_code", X.seconds_to_ts("start_epoch").alias("_ts"),
                                         (F.col("end_epoch") - F.col("start_epoch")).alias("_secs"))
    g = e.groupBy(F.col("agent_id").alias("agent_sk"), "state_code", X.date_key("_ts").alias("date_key")).agg(
        F.sum("_secs").cast("bigint").alias("state_seconds"), F.count(F.lit(1)).alias("occurrence_count"),
        F.min("_ts").alias("first_state_ts"), F.max("_ts").alias("last_state_ts"))
    return g.select("agent_sk", "state_code", "state_seconds", "occurrence_count", "first_state_ts",
                    "last_state_ts", "date_key")


def queue_interval_rollup(ods_call: DataFrame, minutes: int = INTERVAL_MINUTES,
                          sl_seconds: int = SL_THRESHOLD_SECONDS) -> DataFrame:
    """Calls -> 30-minute queue intervals with a 20-second service level."""
    c = ods_call.select("queue_id", "start_ts", "answer_ts", "end_ts",
                        F.window("start_ts", f"{minutes} minutes").start.alias("interval_start_ts"))
    speed = X.epoch_seconds("answer_ts") - X.epoch_seconds("start_ts")
    handle = X.epoch_seconds("end_ts") - X.epoch_seconds("answer_ts")
    g = c.groupBy(F.col("queue_id").alias("queue_sk"), "interval_start_ts").agg(
        F.count(F.lit(1)).alias("offered"), F.count("answer_ts").alias("answered"),
        F.count(F.when(F.col("answer_ts").isNull(), 1)).alias("abandoned"),
        F.count(F.when(speed <= sl_seconds, 1)).alias("answered_in_sl"),
        F.avg(speed).alias("avg_speed_answer_sec"), F.avg(handle).alias("avg_handle_sec"))
    return g.select("queue_sk", "interval_start_ts", "offered", "answered", "abandoned", "answered_in_sl",
                    F.lit(sl_seconds).cast("bigint").alias("sl_threshold_sec"), "avg_speed_answer_sec",
                    "avg_handle_sec", X.date_key("interval_start_ts").alias("date_key"))


def adherence_daily(schedule_minutes: DataFrame, exception_minutes: DataFrame, worked_minutes: DataFrame,
                    timeoff_minutes: DataFrame) -> DataFrame:
    """Four per (agent, day) inputs, tagged and unioned, summed in one
    aggregate (a NULL agent or day is one group, as in GROUP BY).
    adherence = 100 * (scheduled - exception) / scheduled."""
    keys = ["agent_sk", "date_key"]
    names = ["scheduled_minutes", "worked_minutes", "exception_minutes", "timeoff_minutes"]
    inputs = [schedule_minutes, worked_minutes, exception_minutes, timeoff_minutes]
    u = reduce(DataFrame.unionByName, [df.select(*keys, F.col("minutes").cast("bigint").alias("_m"), F.lit(n).alias("_tag"))
                                       for df, n in zip(inputs, names)])
    j = u.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(F.col("_tag") == n, F.col("_m"))), F.lit(0)).cast("bigint").alias(n)
                               for n in names])
    return j.select("*", X.safe_pct(F.col("scheduled_minutes") - F.col("exception_minutes"),
                                    "scheduled_minutes").alias("adherence_pct"))


def ticket_fact(ods_ticket_acid: DataFrame, stg_tkt_ticket_event: DataFrame, stg_tkt_category: DataFrame) -> DataFrame:
    """Ticket with touch count, resolution minutes and SLA breach
    (breached = resolution minutes > sla_hours * 60)."""
    touches = stg_tkt_ticket_event.groupBy(F.col("ticket_id").alias("_tid")).agg(F.count(F.lit(1)).alias("touch_count"))
    cat = stg_tkt_category.select(F.col("category_id").alias("_cat"), "category_code", "sla_hours")
    t = (ods_ticket_acid.join(touches, F.col("ticket_id") == F.col("_tid"), "left")
         .join(cat, F.col("category_id") == F.col("_cat"), "left"))
    minutes = F.floor((X.epoch_seconds("resolved_ts") - X.epoch_seconds("created_ts")) / 60).cast("bigint")
    return t.select("ticket_id", "program_id", "category_code", "priority", "status", "created_ts", "resolved_ts",
                    minutes.alias("resolution_minutes"),
                    F.coalesce(minutes > F.col("sla_hours") * 60, F.lit(False)).alias("sla_breached_flag"),
                    F.coalesce(F.col("touch_count"), F.lit(0)).alias("touch_count"),
                    X.date_key("created_ts").alias("date_key"))


def agent_weekly(agg_agent_daily: DataFrame) -> DataFrame:
    """T36 (weekly half): days worked, volume and volume-weighted handle time
    per agent and ISO week (Monday start)."""
    day = X.parse_date_key("date_key")
    d = agg_agent_daily.select("agent_sk", "interactions_handled", "handle_seconds_total",
                               F.date_sub(day, F.weekday(day)).alias("_wk"))  # Monday of the ISO week
    g = d.groupBy("agent_sk", "_wk").agg(
        F.count(F.lit(1)).alias("days_worked"), F.sum("interactions_handled").cast("bigint").alias("interactions_handled"),
        F.sum("handle_seconds_total").alias("_h"))
    return g.select("agent_sk", "days_worked", "interactions_handled",
                    X.safe_divide("_h", "interactions_handled").alias("avg_handle_seconds"),
                    X.date_key("_wk").alias("week_start_key"))


def agent_daily(fact_interaction: DataFrame, fact_agent_activity: DataFrame) -> DataFrame:
    """T36 (daily half): interactions and state seconds per agent and day."""
    i = fact_interaction.select("agent_sk", "date_key", "start_ts", "end_ts").groupBy("agent_sk", "date_key").agg(
        F.count(F.lit(1)).alias("interactions_handled"),
        F.sum(X.epoch_seconds("end_ts") - X.epoch_seconds("start_ts")).cast("bigint").alias("handle_seconds_total"))
    st, secs = F.col("state_code"), F.col("state_seconds")
    a = fact_agent_activity.groupBy("agent_sk", "date_key").agg(
        F.sum(F.when(st == "TALK", secs).otherwise(0)).cast("bigint").alias("talk_seconds"),
        F.sum(F.when(st == "ACW", secs).otherwise(0)).cast("bigint").alias("acw_seconds"),
        F.sum(F.when(st.like("AUX%"), secs).otherwise(0)).cast("bigint").alias("aux_seconds"))
    j = (i.unionByName(a, allowMissingColumns=True).groupBy("agent_sk", "date_key")
         .agg(*[F.sum(c).alias(c) for c in ("interactions_handled", "handle_seconds_total", "talk_seconds", "acw_seconds", "aux_seconds")]))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return j.select("agent_sk", "date_key", z("interactions_handled"), z("handle_seconds_total"),
                    X.safe_divide("handle_seconds_total", "interactions_handled").alias("avg_handle_seconds"),
                    z("talk_seconds"), z("acw_seconds"), z("aux_seconds"))


def program_monthly_rollup(fact_interaction: DataFrame, dim_program: DataFrame) -> DataFrame:
    """Month x ROLLUP(client, program, line of business); grouping_level
    = GROUPING(client)*4 + GROUPING(program)*2 + GROUPING(lob) (0 = detail)."""
    p = dim_program.select(F.col("program_sk").alias("_p"), F.col("client_id").alias("client_sk"), "line_of_business")
    f = (fact_interaction.select("program_sk", "start_ts", "end_ts",
                                 X.month_start("start_ts").alias("period_month"))
         .join(p, F.col("program_sk") == F.col("_p")))
    handle = X.epoch_seconds("end_ts") - X.epoch_seconds("start_ts")
    keys = ["period_month", "client_sk", "program_sk", "line_of_business"]
    sets = [keys, keys[:3], keys[:2], keys[:1]]
    # finest grain first (sums and counts), so the rollup expands the small
    # aggregate instead of every fact row
    fine = f.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(handle).alias("_h"),
                                F.count(handle).alias("_hn"))
    g = fine.groupingSets(sets, *keys).agg(
        F.sum("_n").cast("bigint").alias("interactions"),
        F.try_divide(F.sum("_h").cast("double"), F.sum("_hn").cast("double")).alias("avg_handle_seconds"),
        # period_month is in every set, so its bit is always 0
        F.grouping_id().cast("bigint").alias("grouping_level"))
    return g.select("client_sk", "program_sk", "line_of_business", "interactions", "avg_handle_seconds",
                    "grouping_level", "period_month")


def queue_hourly_variance(queue_hourly: DataFrame, forecast: DataFrame) -> DataFrame:
    """Hourly queue volume against forecast; variance % = 100 *
    (offered - forecast) / forecast, NULL without a forecast."""
    fc = forecast.select(F.col("queue_sk").alias("_q"), F.col("hour_of_day").alias("_h"), "forecast_volume")
    j = queue_hourly.join(fc, (F.col("queue_sk") == F.col("_q")) & (F.col("hour_of_day") == F.col("_h")), "left")
    return j.select("queue_sk", "hour_of_day", "offered", "answered", "abandoned",
                    X.safe_pct("answered_in_sl", "answered").alias("sl_pct"), "forecast_volume",
                    X.safe_pct(F.col("offered") - F.col("forecast_volume"), "forecast_volume").alias("volume_variance_pct"),
                    "date_key")


def csat_rollup_monthly(surveys: DataFrame) -> DataFrame:
    """Month x ROLLUP(client, program, site) of csat; promoter nps >= 9,
    detractor nps <= 6."""
    keys = ["period_month", "client_sk", "program_sk", "site_code"]
    nps = F.col("nps_score")
    # finest grain first; the rollup then expands the small aggregate
    fine = surveys.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("csat_score").alias("_cs"), F.count("csat_score").alias("_cn"),
        F.sum(F.when(nps >= 9, 1).otherwise(0)).alias("_pro"), F.sum(F.when(nps <= 6, 1).otherwise(0)).alias("_det"))
    n = F.sum("_n").cast("double")
    g = fine.groupingSets([keys, keys[:3], keys[:2], keys[:1]], *keys).agg(
        F.sum("_n").cast("bigint").alias("surveys"),
        F.try_divide(F.sum("_cs").cast("double"), F.sum("_cn").cast("double")).alias("avg_csat"),
        (F.try_divide(F.sum("_pro").cast("double"), n) * 100).alias("pct_promoters"),
        (F.try_divide(F.sum("_det").cast("double"), n) * 100).alias("pct_detractors"),
        F.grouping_id().cast("bigint").alias("grouping_id"))
    return g.select("client_sk", "program_sk", "site_code", "surveys", "avg_csat", "pct_promoters",
                    "pct_detractors", "grouping_id", "period_month")


def billing_monthly(fact_billing_line: DataFrame, ods_sla_credit: DataFrame, telco: DataFrame) -> DataFrame:
    """Billed, SLA credits and telco cost per client, program and month;
    net = billed - credits - telco. Each input is aggregated before the join."""
    keys = ["client_sk", "program_sk", "period_month"]
    b = fact_billing_line.groupBy(*keys).agg(F.sum("line_amount").cast("decimal(14,2)").alias("billed_amount"))
    c = ods_sla_credit.groupBy(*keys).agg(F.sum("credit_amount").cast("decimal(12,2)").alias("sla_credit_amount"))
    t = telco.groupBy(*keys).agg(F.sum("charge_amount").cast("decimal(12,2)").alias("telco_cost_amount"))
    j = _left_null_safe(_left_null_safe(b, c, keys), t, keys)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    net = (z("billed_amount") - z("sla_credit_amount") - z("telco_cost_amount")).cast("decimal(14,2)")
    return j.select("client_sk", "program_sk", "billed_amount", "sla_credit_amount", "telco_cost_amount",
                    net.alias("net_revenue"), "period_month")


def site_daily(agg_agent_daily: DataFrame, dim_agent: DataFrame, fact_queue_interval: DataFrame,
               dim_queue_site: DataFrame) -> DataFrame:
    """Per site and day: active agents, interactions, volume-weighted
    handle time, service level and mean adherence."""
    a = dim_agent.select(F.col("agent_sk").alias("_a"), "site_code")
    d = agg_agent_daily.join(a, F.col("agent_sk") == F.col("_a")).groupBy("site_code", "date_key").agg(
        F.count_distinct("agent_sk").alias("agents_active"), F.sum("interactions_handled").cast("bigint").alias("interactions"),
        F.sum("handle_seconds_total").alias("_h"), F.avg(F.col("adherence_pct").cast("double")).alias("adherence_pct"))
    q = dim_queue_site.select(F.col("queue_sk").alias("_q"), F.col("site_code").alias("_qs"))
    s = (fact_queue_interval.join(q, F.col("queue_sk") == F.col("_q"))
         .groupBy(F.col("_qs").alias("site_code"), "date_key")
         .agg(F.sum("answered_in_sl").alias("_in"), F.sum("answered").alias("_ans")))
    j = _left_null_safe(d, s, ["site_code", "date_key"])
    return j.select("site_code", "agents_active", "interactions", X.safe_divide("_h", "interactions").alias("avg_handle_seconds"),
                    X.safe_pct("_in", "_ans").alias("sl_pct"), "adherence_pct", "date_key")


def keyword_counts(texts: DataFrame, text_col: str = "text", key_col: str = "doc_id") -> DataFrame:
    """Lower-cased space-split tokens of every whole text: occurrences and
    documents per keyword. Partial aggregation absorbs very common words."""
    tok = texts.select(key_col, F.explode(F.split(F.lower(F.col(text_col)), " ")).alias("keyword"))
    per_doc = tok.groupBy("keyword", key_col).agg(F.count(F.lit(1)).alias("_n"))
    return per_doc.groupBy("keyword").agg(F.sum("_n").cast("bigint").alias("occurrences"),
                                          F.count(F.lit(1)).alias("documents"))
