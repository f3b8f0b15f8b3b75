"""DuckDB oracles of the full-width builds (``build_<table>``).

A table is a CTE here: staging tables come from the expressions of
``plans.mart_feeds``, targets are written by their rules (ROW_NUMBER for the
last load, correlated look-ups for the version in force, ROLLUP for the
monthly aggregate). An oracle is the CTEs that its table needs.
"""

from __future__ import annotations

import re


from .oracle_ods import day_key, month, ts_of, ts_of_ms
from .plans.mart_feeds import FEEDS, JANUARY, MONTH_SECONDS
from .sources.schemas import COLUMNS

_TIMES = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}


def _base(name: str) -> str:
    ts = _TIMES.get(name)
    if ts is None:
        return name
    return (f"(SELECT *, CAST(floor(epoch({ts})) AS BIGINT) AS sec, epoch_us({ts}) // 1000 AS ms, strftime({ts}, '%Y-%m-%d') AS day_text, "
            f"strftime(CAST({ts} AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day_text, strftime({ts}, '%Y-%m') AS month_text FROM {name})")


def _types(table: str) -> dict[str, str]:
    """Column -> SQL type of a declared table."""
    return dict(c.strip().split(" ", 1) for c in re.split(r",\s*(?![^<(]*[>)])", COLUMNS[table]))


def _feed(table: str) -> str:
    types = _types(table)
    return "\nUNION ALL\n".join(
        f"SELECT {', '.join(f'CAST({e} AS {types[c]}) AS {c}' for c, e in cols.items())} FROM {_base(base)}, range(1, {copies + 1}) t(n) WHERE {where}"
        for base, copies, where, cols in FEEDS[table])


def _last(table: str, key: str, by: str = "load_date") -> str:
    return f"(SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {by} DESC) = 1)"


def _oracle_time(text: str) -> str:
    return f"CASE WHEN regexp_full_match({text}, '[0-9]{{14}}') THEN try_strptime({text}, '%Y%m%d%H%M%S') END"


def _half_up(num: str, den: str, kind: str) -> str:
    """num hundredths / den, halves up."""
    n, d = f"(2 * CAST({num} AS HUGEINT) + {den})", f"(2 * CAST({den} AS HUGEINT))"
    return f"CASE WHEN {den} > 0 THEN TRY_CAST(CAST((({n} - (({n} % {d}) + {d}) % {d}) // {d}) AS DECIMAL(38,2)) / 100 AS {kind}) END"


def _ratio(num: str, den: str, kind: str) -> str:
    return _half_up(f"(100 * ({num}))", f"({den})", kind)


def _pct(num: str, den: str) -> str:
    return _half_up(f"(10000 * ({num}))", f"({den})", "DECIMAL(5,2)")


def _version(agent: str, at: str) -> str:
    """The key of the agent's version in force at a time."""
    return f"coalesce((SELECT max(v.agent_sk) FROM dim_agent_versions v WHERE v.agent_id = {agent} AND v.eff_from_ts <= {at}), -1)"


def _epoch(ts: str) -> str:
    return f"CAST(floor(epoch({ts})) AS BIGINT)"


_MINUTES = "CAST(floor(({0}) / 60) AS BIGINT)"
C: dict[str, str] = {t: _feed(t) for t in FEEDS}

C["chat_turns"] = """SELECT conv_id, 1700000000000 + conv_id * 60000 AS started_ms, max(turn) AS last, count(*) AS n, count(*) FILTER (WHERE role = 'assistant') AS agent,
  count(*) FILTER (WHERE role = 'user') AS customer, min(turn) FILTER (WHERE role = 'assistant') AS first FROM conversations GROUP BY conv_id"""
C["ods_client_acid"] = f"SELECT client_id, client_code, client_name, industry, hq_country, status, {ts_of('created_ts')} AS created_ts, {ts_of('updated_ts')} AS updated_ts FROM {_last('stg_crm_client', 'client_id')}"
C["ods_agent_acid"] = f"""SELECT agent_id, employee_no, first_name || ' ' || last_name AS full_name, email, org_unit_id, job_grade, employment_type,
  {ts_of('hire_ts')} AS hire_ts, {ts_of('term_ts')} AS term_ts, status FROM {_last('stg_hr_agent', 'agent_id')}"""
C["ods_ticket_acid"] = f"""SELECT t.ticket_id, ticket_no, program_id, category_id, assigned_agent_id, priority, status, {ts_of_ms('created_ms')} AS created_ts, {ts_of_ms('updated_ms')} AS updated_ts,
  (SELECT {ts_of_ms('max(event_ms)')} FROM stg_tkt_ticket_event e WHERE e.ticket_id = t.ticket_id AND e.event_type = 'RESOLVED') AS resolved_ts FROM {_last('stg_tkt_ticket', 'ticket_id')} t"""
C["ods_invoice_acid"] = f"""SELECT invoice_id, invoice_no, client_id, program_id, period_month, {ts_of_ms('issued_ts_sec')} AS issued_ts, {ts_of_ms('due_ts_sec')} AS due_ts, currency, total_amount, status
  FROM {_last('stg_fin_invoice', 'invoice_id')}"""
C["ods_program"] = f"""SELECT program_id, client_id, program_code, program_name, line_of_business, channel_mix, site_code, status, {ts_of('go_live_ts')} AS go_live_ts, {ts_of('updated_ts')} AS updated_ts,
  load_date AS snapshot_date FROM stg_crm_program"""
C["ods_contract"] = f"""SELECT contract_id, client_id, program_id, contract_no, {_oracle_time('start_dt')} AS start_ts, {_oracle_time('end_dt')} AS end_ts, billing_model, currency,
  {_oracle_time('signed_dt')} AS signed_ts, status, load_date AS snapshot_date FROM stg_crm_contract"""
C["ods_contract_line"] = f"SELECT contract_line_id, contract_id, line_no, service_code, uom, unit_rate, min_commit, {_oracle_time('effective_dt')} AS effective_ts, load_date AS snapshot_date FROM stg_crm_contract_line"
C["ods_org_unit"] = f"SELECT org_unit_id, parent_unit_id, unit_code, unit_name, unit_type, site_code, cost_center, {ts_of('created_ts')} AS created_ts, load_date AS snapshot_date FROM stg_hr_org_unit"
C["ods_queue"] = f"SELECT queue_id, queue_code, queue_name, program_id, media_type, priority, {ts_of('created_epoch')} AS created_ts, load_date AS snapshot_date FROM stg_tel_queue"
C["ods_schedule"] = f"""SELECT schedule_id, agent_id, s.shift_id, h.shift_code, {ts_of('start_epoch')} AS start_ts, {ts_of('end_epoch')} AS end_ts, paid_minutes, activity_code, s.site_code,
  CAST(sched_date AS DATE) AS sched_date FROM stg_wfm_schedule s LEFT JOIN {_last('stg_wfm_shift', 'shift_id')} h ON h.shift_id = s.shift_id"""
C["ods_adherence_event"] = f"""SELECT adherence_event_id, agent_id, schedule_id, exception_type, {ts_of('start_epoch')} AS start_ts, {ts_of('end_epoch')} AS end_ts,
  {_MINUTES.format('end_epoch - start_epoch')} AS exception_minutes, approved_flag, CAST({ts_of('start_epoch')} AS DATE) AS event_date FROM stg_wfm_adherence_event"""
C["ods_call"] = f"""SELECT c.call_id, queue_id, agent_id, program_id, direction, {ts_of('start_epoch')} AS start_ts, {ts_of('answer_epoch')} AS answer_ts, {ts_of('end_epoch')} AS end_ts,
  answer_epoch - start_epoch AS ring_seconds, {', '.join(f"CAST(coalesce((SELECT sum(g.end_epoch - g.start_epoch) FROM stg_tel_call_segment g WHERE g.call_id = c.call_id AND g.segment_type = '{t}'), 0) AS BIGINT) AS {t.lower()}_seconds" for t in ('TALK', 'HOLD', 'ACW'))},
  answer_epoch IS NULL AS abandoned_flag, disposition_code, recording_id, CAST({ts_of('start_epoch')} AS DATE) AS call_date FROM stg_tel_call c"""
C["ods_chat_session"] = f"""SELECT 'CH' || conv_id AS chat_ref, 'C0' AS client_code, 'Q0' AS queue_code, 'agent@example.com' AS agent_email, {ts_of_ms('started_ms')} AS started_ts,
  {ts_of_ms('started_ms + last * 30000')} AS ended_ts, n AS message_count, agent AS agent_message_count, customer AS customer_message_count, CAST(first * 30 AS BIGINT) AS first_response_seconds,
  CAST({ts_of_ms('started_ms')} AS DATE) AS event_date FROM chat_turns"""
C["ods_email_interaction"] = f"""SELECT email_ref, client_code, mailbox, agent_email, {ts_of_ms('received_ms')} AS received_ts, {ts_of_ms('first_reply_ms')} AS first_reply_ts, {ts_of_ms('resolved_ms')} AS resolved_ts,
  CAST(floor((first_reply_ms - received_ms) / 60000) AS BIGINT) AS reply_sla_minutes, subject_category, CAST({ts_of_ms('received_ms')} AS DATE) AS event_date FROM stg_file_email_interaction"""
C["ods_survey_response"] = f"""SELECT survey_id, client_code, interaction_ref, {ts_of_ms('survey_ms')} AS survey_ts, csat_score, nps_score, fcr_claimed, verbatim, CAST({ts_of_ms('survey_ms')} AS DATE) AS event_date
  FROM {_last('stg_file_survey_csat', 'survey_id', 'feed_date DESC, survey_ms')}"""
C["ods_qa_evaluation"] = f"""SELECT 'QA' || l_orderkey AS qa_form_id, 'C' || (l_orderkey % 5) AS client_code, 'C' || l_orderkey AS interaction_ref, 'qa@example.com' AS evaluator_email,
  {ts_of(f'{JANUARY} + l_orderkey * 7919 % {MONTH_SECONDS}')} AS evaluated_ts, 'v1' AS form_version, count(*) AS section_count, CAST(coalesce(sum(CAST(l_quantity AS BIGINT) % 11) FILTER (WHERE l_partkey % 23 <> 0), 0) AS BIGINT) AS scored_points,
  CAST(10 * count(*) AS BIGINT) AS max_points, l_orderkey % 9 = 0 AS auto_fail, {_pct("coalesce(sum(CAST(l_quantity AS BIGINT) % 11) FILTER (WHERE l_partkey % 23 <> 0), 0)", '10 * count(*)')} AS overall_pct,
  CAST({ts_of(f'{JANUARY} + l_orderkey * 7919 % {MONTH_SECONDS}')} AS DATE) AS event_date FROM lineitem GROUP BY l_orderkey"""
C["ods_dialer_attempt"] = f"""SELECT attempt_id, client_code, campaign_code, agent_id, {ts_of_ms('attempt_ms')} AS attempt_ts, result_code, talk_seconds > 0 AS connected_flag, talk_seconds,
  CAST({ts_of_ms('attempt_ms')} AS DATE) AS event_date FROM stg_file_dialer_result"""
_BY_MAIL = "(SELECT min(agent_id) FROM ods_agent_acid a WHERE a.email = agent_email)"
C["five_channels"] = f"""SELECT 'C' || call_id AS interaction_id, 'VOICE' AS channel, (SELECT k.client_code FROM {_last('ods_program', 'program_id', 'snapshot_date')} p JOIN ods_client_acid k USING (client_id)
    WHERE p.program_id = ods_call.program_id) AS client_code, program_id, queue_id, agent_id, NULL AS customer_ref, start_ts, end_ts, NOT abandoned_flag AS resolved_flag, 'TEL' AS source_system FROM ods_call
UNION ALL SELECT 'H' || chat_ref, 'CHAT', client_code, NULL, (SELECT q.queue_id FROM ods_queue q WHERE q.queue_code = ods_chat_session.queue_code ORDER BY snapshot_date DESC, q.queue_id DESC LIMIT 1),
    {_BY_MAIL}, NULL, started_ts, ended_ts, ended_ts IS NOT NULL, 'CHAT' FROM ods_chat_session
UNION ALL SELECT 'E' || email_ref, 'EMAIL', client_code, NULL, NULL, {_BY_MAIL}, NULL, received_ts, coalesce(resolved_ts, first_reply_ts), resolved_ts IS NOT NULL, 'MAIL' FROM ods_email_interaction
UNION ALL SELECT 'D' || attempt_id, 'DIALER', client_code, NULL, NULL, agent_id, NULL, attempt_ts, attempt_ts + to_seconds(talk_seconds), connected_flag, 'DIALER' FROM ods_dialer_attempt
UNION ALL SELECT 'X' || interaction_ref, channel, client_code, NULL, NULL, {_BY_MAIL}, customer_ref, {ts_of_ms('start_ms')}, {ts_of_ms('end_ms')}, coalesce(outcome = 'RESOLVED', FALSE), 'EXPORT' FROM stg_file_interaction_export"""
C["ods_interaction"] = f"SELECT *, {_epoch('end_ts')} - {_epoch('start_ts')} AS handle_seconds, CAST(start_ts AS DATE) AS event_date FROM five_channels"

# the agent's history: snapshots and events in one window a key
_MASTER = ("employee_no", "org_unit_id", "job_grade", "employment_type", "status")
C["agent_said"] = f"""SELECT agent_id, CAST(load_date AS TIMESTAMP) AS t, 0 AS r, hire_ts AS tie, {', '.join(f"{{'v': {a}}} AS {a}" for a in _MASTER)} FROM stg_hr_agent
UNION ALL BY NAME SELECT agent_id, {ts_of('event_ts')} AS t, 1 AS r, event_id AS tie, CASE WHEN event_type IN ('TRANSFER', 'REHIRE') THEN {{'v': to_org_unit_id}} END AS org_unit_id,
  CASE event_type WHEN 'LEAVE' THEN {{'v': 'LEAVE'}} WHEN 'REHIRE' THEN {{'v': 'ACTIVE'}} END AS status FROM stg_hr_employment_event"""
C["agent_known"] = f"""SELECT agent_id, t, {', '.join(f"(last_value({a} IGNORE NULLS) OVER w).v AS {a}" for a in _MASTER)}, row_number() OVER (PARTITION BY agent_id, t ORDER BY r DESC, tie DESC) AS n
  FROM agent_said WINDOW w AS (PARTITION BY agent_id ORDER BY t, r, tie ROWS UNBOUNDED PRECEDING)"""
C["agent_starts"] = f"""SELECT *, row_number() OVER w = 1 OR {' OR '.join(f'{a} IS DISTINCT FROM lag({a}) OVER w' for a in _MASTER)} AS opens FROM (SELECT * FROM agent_known WHERE n = 1)
  WINDOW w AS (PARTITION BY agent_id ORDER BY t)"""
C["dim_agent_versions"] = f"""SELECT row_number() OVER (ORDER BY h.agent_id, h.t) AS agent_sk, h.agent_id, h.employee_no, a.full_name, h.job_grade, h.employment_type, h.org_unit_id, u.unit_name AS team_name, u.site_code, h.status,
  {day_key('a.hire_ts')} AS hire_date_key, row_number() OVER (PARTITION BY h.agent_id ORDER BY h.t DESC) = 1 AS is_current, h.t AS eff_from_ts
  FROM agent_starts h LEFT JOIN {_last('ods_org_unit', 'org_unit_id', 'snapshot_date')} u ON u.org_unit_id = h.org_unit_id LEFT JOIN ods_agent_acid a ON a.agent_id = h.agent_id WHERE h.opens"""
C["dim_agent"] = "SELECT * EXCLUDE (eff_from_ts) FROM dim_agent_versions"
C["dim_client"] = """SELECT c.client_id AS client_sk, c.client_id, client_code, client_name, industry, hq_country, p.full_name AS primary_contact_name, p.email AS primary_contact_email, status
  FROM ods_client_acid c LEFT JOIN (SELECT * FROM stg_crm_client_contact WHERE is_primary QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY contact_id) = 1) p ON p.client_id = c.client_id"""
C["dim_program"] = f"""SELECT p.program_id AS program_sk, p.program_id, program_code, program_name, p.client_id, line_of_business, channel_mix, site_code, c.billing_model, p.status, {day_key('go_live_ts')} AS go_live_date_key
  FROM {_last('ods_program', 'program_id', 'snapshot_date')} p LEFT JOIN (SELECT * FROM ods_contract QUALIFY row_number() OVER (PARTITION BY program_id ORDER BY start_ts DESC NULLS LAST, contract_id DESC) = 1) c
  ON c.program_id = p.program_id"""
C["dim_queue"] = f"SELECT queue_id AS queue_sk, queue_id, queue_code, queue_name, program_id, media_type, priority FROM {_last('ods_queue', 'queue_id', 'snapshot_date')}"
C["dim_shift"] = f"SELECT shift_id AS shift_sk, shift_id, shift_code, shift_name, start_hhmm, end_hhmm, overnight_flag, site_code FROM {_last('stg_wfm_shift', 'shift_id')}"
C["dim_disposition"] = f"SELECT row_number() OVER (ORDER BY disposition_code) AS disposition_sk, disposition_code, disposition_desc, category, billable_flag FROM {_last('stg_tel_disposition_code', 'disposition_code')}"
C["units"] = f"SELECT * FROM {_last('ods_org_unit', 'org_unit_id', 'snapshot_date')}"
C["dim_site"] = """SELECT row_number() OVER (ORDER BY s.site_code) AS site_sk, s.site_code, u.unit_name AS site_name, r.unit_name AS region, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS timezone
  FROM (SELECT DISTINCT site_code FROM units WHERE site_code IS NOT NULL) s
  LEFT JOIN (SELECT * FROM units WHERE unit_type = 'SITE' QUALIFY row_number() OVER (PARTITION BY site_code ORDER BY org_unit_id) = 1) u ON u.site_code = s.site_code LEFT JOIN units r ON r.org_unit_id = u.parent_unit_id"""
C["dim_org"] = """SELECT row_number() OVER (ORDER BY org_unit_id) AS org_sk, * FROM (
  SELECT org_unit_id, unit_code, unit_name, unit_type, unit_name AS level1_name, CAST(NULL AS VARCHAR) AS level2_name, CAST(NULL AS VARCHAR) AS level3_name, CAST(NULL AS VARCHAR) AS level4_name, site_code, cost_center
  FROM units WHERE parent_unit_id IS NULL
  UNION ALL SELECT c.org_unit_id, c.unit_code, c.unit_name, c.unit_type, p.unit_name, c.unit_name, NULL, NULL, c.site_code, c.cost_center FROM units c JOIN units p ON p.org_unit_id = c.parent_unit_id AND p.parent_unit_id IS NULL)"""
C["fact_interaction"] = f"""SELECT interaction_id, coalesce((SELECT max(client_sk) FROM dim_client d WHERE d.client_code = i.client_code), -1) AS client_sk,
  coalesce((SELECT program_sk FROM dim_program d WHERE d.program_id = i.program_id), -1) AS program_sk, coalesce((SELECT queue_sk FROM dim_queue d WHERE d.queue_id = i.queue_id), -1) AS queue_sk,
  {_version('i.agent_id', 'i.start_ts')} AS agent_sk, customer_ref, start_ts, end_ts, handle_seconds, resolved_flag, source_system, {day_key('start_ts')} AS date_key, channel FROM ods_interaction i"""
C["activity_rows"] = f"SELECT {_version('e.agent_id', ts_of('e.start_epoch'))} AS agent_sk, state_code, {ts_of('start_epoch')} AS t, end_epoch - start_epoch AS s FROM stg_tel_agent_state_event e"
C["fact_agent_activity"] = f"""SELECT agent_sk, state_code, CAST(sum(s) AS BIGINT) AS state_seconds, count(*) AS occurrence_count, min(t) AS first_state_ts, max(t) AS last_state_ts, {day_key('t')} AS date_key
  FROM activity_rows GROUP BY agent_sk, state_code, {day_key('t')}"""
_KEYS = "coalesce(f.agent_sk, -1) AS agent_sk, coalesce(f.program_sk, -1) AS program_sk, coalesce(f.client_sk, -1) AS client_sk"
C["fact_csat_survey"] = f"""SELECT survey_id, interaction_ref AS interaction_id, {_KEYS}, survey_ts, csat_score, nps_score, fcr_claimed, {day_key('survey_ts')} AS date_key
  FROM ods_survey_response s LEFT JOIN fact_interaction f ON f.interaction_id = s.interaction_ref"""
C["fact_qa_evaluation"] = f"""SELECT qa_form_id, interaction_ref AS interaction_id, {_KEYS.rsplit(',', 1)[0].replace(', coalesce(f.client_sk', '')}, evaluated_ts, scored_points, max_points, overall_pct, auto_fail, {day_key('evaluated_ts')} AS date_key
  FROM ods_qa_evaluation q LEFT JOIN fact_interaction f ON f.interaction_id = q.interaction_ref"""
C["fact_billing_line"] = f"""SELECT l.invoice_line_id, l.invoice_id, coalesce(c.client_sk, -1) AS client_sk, coalesce(p.program_sk, -1) AS program_sk, s.service_code, l.qty, l.unit_rate, l.line_amount, l.adjustment_flag,
  i.status AS invoice_status, CAST(i.period_month || '-01' AS DATE) AS period_month
  FROM (SELECT * FROM stg_fin_invoice_line QUALIFY row_number() OVER (PARTITION BY invoice_line_id ORDER BY load_date DESC, invoice_id DESC, contract_line_id DESC, qty DESC, unit_rate DESC, line_amount DESC, adjustment_flag DESC, created_ms DESC) = 1) l
  LEFT JOIN {_last('ods_contract_line', 'contract_line_id', 'snapshot_date')} s ON s.contract_line_id = l.contract_line_id LEFT JOIN ods_invoice_acid i ON i.invoice_id = l.invoice_id
  LEFT JOIN dim_client c ON c.client_id = i.client_id LEFT JOIN dim_program p ON p.program_id = i.program_id"""
C["agent_minutes"] = """SELECT agent_id, sched_date AS d, paid_minutes AS sch, 0 AS wrk, 0 AS exc, 0 AS tof FROM ods_schedule
UNION ALL SELECT agent_id, event_date, 0, 0, exception_minutes, 0 FROM ods_adherence_event
UNION ALL SELECT agent_id, CAST(work_date AS DATE), 0, billable_minutes + nonbillable_minutes, 0, 0 FROM ods_timesheet
UNION ALL SELECT agent_id, CAST(unnest(generate_series(CAST(start_date AS DATE), CAST(end_date AS DATE), INTERVAL 1 DAY)) AS DATE), 0, 0, 0, 480 FROM stg_wfm_timeoff_request WHERE status = 'APPROVED'"""
C["agent_occupancy"] = """SELECT agent_sk, date_key, sum(state_seconds) FILTER (WHERE state_code IN ('TALK', 'HOLD', 'ACW')) AS handled, sum(state_seconds) FILTER (WHERE state_code IN ('TALK', 'HOLD', 'ACW', 'READY')) AS staffed
  FROM fact_agent_activity GROUP BY agent_sk, date_key"""
C["version_minutes"] = f"""SELECT {_version('m.agent_id', "m.d + INTERVAL '86399' SECOND")} AS agent_sk, {day_key('d')} AS date_key, sch, wrk, exc, tof
  FROM (SELECT agent_id, d, sum(sch) AS sch, sum(wrk) AS wrk, sum(exc) AS exc, sum(tof) AS tof FROM agent_minutes GROUP BY agent_id, d) m"""
C["fact_adherence_daily"] = f"""SELECT m.agent_sk, CAST(sch AS BIGINT) AS scheduled_minutes, CAST(wrk AS BIGINT) AS worked_minutes, CAST(exc AS BIGINT) AS exception_minutes, CAST(tof AS BIGINT) AS timeoff_minutes,
  {_pct('sch - exc', 'sch')} AS adherence_pct, {_pct('coalesce(handled, 0)', 'coalesce(staffed, 0)')} AS occupancy_pct, m.date_key
  FROM (SELECT agent_sk, date_key, sum(sch) AS sch, sum(wrk) AS wrk, sum(exc) AS exc, sum(tof) AS tof FROM version_minutes GROUP BY agent_sk, date_key) m
  LEFT JOIN agent_occupancy o ON o.agent_sk = m.agent_sk AND o.date_key = m.date_key"""
C["fact_ticket"] = f"""SELECT t.ticket_id, coalesce(p.program_sk, -1) AS program_sk, k.category_code, {_version('t.assigned_agent_id', 't.created_ts')} AS assigned_agent_sk, t.priority, t.status, t.created_ts, t.resolved_ts,
  {_MINUTES.format(f"{_epoch('t.resolved_ts')} - {_epoch('t.created_ts')}")} AS resolution_minutes,
  coalesce({_MINUTES.format(f"{_epoch('t.resolved_ts')} - {_epoch('t.created_ts')}")} > k.sla_hours * 60, FALSE) AS sla_breached_flag,
  (SELECT count(*) FROM stg_tkt_ticket_event e WHERE e.ticket_id = t.ticket_id) AS touch_count, {day_key('t.created_ts')} AS date_key
  FROM ods_ticket_acid t LEFT JOIN dim_program p ON p.program_id = t.program_id LEFT JOIN {_last('stg_tkt_category', 'category_id')} k ON k.category_id = t.category_id"""
C["agent_days"] = """SELECT agent_sk, date_key FROM fact_interaction UNION SELECT agent_sk, date_key FROM fact_agent_activity UNION SELECT agent_sk, date_key FROM fact_adherence_daily"""
C["agg_agent_daily"] = f"""SELECT k.agent_sk, v.site_code, coalesce(i.n, 0) AS interactions_handled, {_ratio('coalesce(i.h, 0)', 'coalesce(i.hn, 0)', 'DECIMAL(8,2)')} AS avg_handle_seconds,
  CAST(coalesce(a.talk, 0) AS BIGINT) AS talk_seconds, CAST(coalesce(a.acw, 0) AS BIGINT) AS acw_seconds, CAST(coalesce(a.aux, 0) AS BIGINT) AS aux_seconds, d.adherence_pct,
  {_pct('coalesce(o.handled, 0)', 'coalesce(o.staffed, 0)')} AS occupancy_pct, k.date_key
  FROM agent_days k LEFT JOIN (SELECT agent_sk, date_key, count(*) AS n, sum(handle_seconds) AS h, count(handle_seconds) AS hn FROM fact_interaction GROUP BY ALL) i USING (agent_sk, date_key)
  LEFT JOIN (SELECT agent_sk, date_key, sum(state_seconds) FILTER (WHERE state_code = 'TALK') AS talk, sum(state_seconds) FILTER (WHERE state_code = 'ACW') AS acw,
             sum(state_seconds) FILTER (WHERE starts_with(state_code, 'AUX')) AS aux FROM fact_agent_activity GROUP BY ALL) a USING (agent_sk, date_key)
  LEFT JOIN agent_occupancy o USING (agent_sk, date_key) LEFT JOIN fact_adherence_daily d USING (agent_sk, date_key) LEFT JOIN dim_agent v ON v.agent_sk = k.agent_sk"""


def _by_volume(value: str, kind: str) -> str:
    return (_half_up(f"coalesce(sum(CAST({value} * 100 AS BIGINT) * interactions_handled), 0)",
                     f"coalesce(sum(interactions_handled) FILTER (WHERE {value} IS NOT NULL), 0)", kind) + f" AS {value}")


C["agg_agent_weekly"] = f"""SELECT agent_sk, max(site_code) AS site_code, count(*) AS days_worked, CAST(sum(interactions_handled) AS BIGINT) AS interactions_handled, {_by_volume('avg_handle_seconds', 'DECIMAL(8,2)')},
  {_by_volume('adherence_pct', 'DECIMAL(5,2)')}, {_by_volume('occupancy_pct', 'DECIMAL(5,2)')}, {day_key('w')} AS week_start_key
  FROM (SELECT *, CAST(date_trunc('week', strptime(CAST(date_key AS VARCHAR), '%Y%m%d')) AS DATE) AS w FROM agg_agent_daily) GROUP BY agent_sk, w"""
C["program_months"] = f"""SELECT {month('start_ts')} AS period_month, client_sk, program_sk, 1 AS n, handle_seconds AS h, NULL AS cs, NULL AS b FROM fact_interaction
UNION ALL SELECT {month('survey_ts')}, client_sk, program_sk, 0, NULL, csat_score, NULL FROM fact_csat_survey UNION ALL SELECT period_month, client_sk, program_sk, 0, NULL, NULL, line_amount FROM fact_billing_line"""
C["agg_program_monthly"] = f"""SELECT client_sk, program_sk, line_of_business, CAST(sum(n) AS BIGINT) AS interactions, {_ratio('coalesce(sum(h), 0)', 'count(h)', 'DECIMAL(8,2)')} AS avg_handle_seconds,
  {_ratio('coalesce(sum(cs), 0)', 'count(cs)', 'DECIMAL(5,2)')} AS avg_csat, CAST(sum(b) AS DECIMAL(14,2)) AS billed_amount, CAST(GROUPING(client_sk, program_sk, line_of_business) AS BIGINT) AS grouping_level, period_month
  FROM (SELECT m.*, p.line_of_business FROM program_months m LEFT JOIN dim_program p USING (program_sk))
  GROUP BY GROUPING SETS ((period_month, client_sk, program_sk, line_of_business), (period_month, client_sk, program_sk), (period_month, client_sk), (period_month))"""


def _needed(name: str, into: list[str]) -> list[str]:
    for other in C:
        if other != name and other not in into and re.search(rf"\b{other}\b", C[name]):
            _needed(other, into)
    if name not in into:
        into.append(name)
    return into


def oracle(table: str) -> str:
    parts = _needed(table, [])
    return "WITH " + ",\n".join(f"{n} AS (\n{C[n]})" for n in parts) + f"\nSELECT {', '.join(_types(table))} FROM {table}"



ORACLE_MARTS = {f"build_{t}": oracle(t) for t in C if t in COLUMNS and t not in FEEDS}
