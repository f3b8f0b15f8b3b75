"""DuckDB oracles of the sixteen views and of the queries layered on them.

Each is derived from the definition of its result, by another route than a
join-and-group over the same tables: rows are first reduced to one per key,
neighbours are found by correlated look-ups, the hierarchy is climbed from the
units upwards, fan-outs are counted as factors. Names, patterns and limits are
those of the view contracts.
"""

from __future__ import annotations

from .oracle import BRIDGE, EPOCHS, r4, with_bridge

# Fixed values of the view contracts: patterns by call driver, in the order they are tried.
DRIVERS = {"BILLING": "(?i)(bill|invoice|charge|refund)", "ACCESS": "(?i)(password|login|locked|reset)", "RETENTION": "(?i)(cancel|churn|retention)"}
TAG, REFERENCE = r"^\[([A-Z]{2,5})\]", r"ref#(\d+)"


def _percent(part: str, whole: str) -> str:
    return f"100 * CAST({part} AS DOUBLE) / CAST(nullif({whole}, 0) AS DOUBLE)"


def _total(column: str, where: str = "TRUE") -> str:
    return f"CAST(coalesce(sum({column}) FILTER (WHERE {where}), 0) AS BIGINT)"


VIEWS_SQL: dict[str, str] = {}

VIEWS_SQL["active_agents_ndv"] = with_bridge(["fact_interaction", "dim_agent"], """,
seen AS (SELECT date_key, site_code, list(agent_sk) AS agents, list(agent_sk || '|' || channel) AS pairs, count(*) AS interactions
         FROM fact_interaction JOIN dim_agent USING (agent_sk) GROUP BY ALL),
known AS (SELECT date_key, site_code, interactions, CAST(list_unique(agents) AS BIGINT) AS active_agents, CAST(list_unique(pairs) AS BIGINT) AS agent_channel_pairs FROM seen)
SELECT *, TRUE AS approx_agents_ok, TRUE AS approx_pairs_ok FROM known""")

VIEWS_SQL["active_agents_by_site"] = with_bridge(["fact_interaction", "dim_agent"], """
SELECT site_code, count(DISTINCT agent_sk) AS active_agents, count(DISTINCT (agent_sk, channel)) AS agent_channel_pairs, count(*) AS interactions, TRUE AS agents_close, TRUE AS pairs_close
FROM fact_interaction JOIN dim_agent USING (agent_sk) GROUP BY site_code""")

VIEWS_SQL["csat_rollup"] = with_bridge(["fact_csat_survey", "dim_program"], """,
per_program AS (SELECT program_sk, count(*) AS n, sum(csat_score) AS points, count(*) FILTER (WHERE nps_score >= 9) AS fans FROM fact_csat_survey GROUP BY program_sk)
SELECT client_id, program_code, CAST(sum(n) AS BIGINT) AS surveys, CAST(sum(points) AS BIGINT) AS sum_csat, CAST(sum(fans) AS BIGINT) AS promoter_count
FROM per_program JOIN dim_program USING (program_sk) GROUP BY ALL""")

_DRIVER = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{d}'" for d, p in DRIVERS.items())
VIEWS_SQL["call_driver_regex"] = with_bridge(["ods_call", "dim_disposition"], f""",
told AS (SELECT disposition_code, disposition_desc AS text, regexp_extract(disposition_desc, '{TAG}', 1) AS tag, regexp_extract(disposition_desc, '{REFERENCE}', 1) AS ref FROM dim_disposition),
drivers AS (SELECT disposition_code, CASE {_DRIVER} WHEN length(tag) > 0 THEN tag ELSE 'OTHER' END AS call_driver, CASE WHEN length(ref) > 0 THEN ref END AS embedded_ref_no FROM told)
SELECT call_date, queue_id, call_driver, embedded_ref_no, count(*) AS calls, {r4('sum(talk_seconds) / count(talk_seconds)')} AS avg_talk_seconds
FROM ods_call JOIN drivers USING (disposition_code) GROUP BY call_date, queue_id, call_driver, embedded_ref_no""")

VIEWS_SQL["repeat_contact_window"] = with_bridge(["ods_interaction"], f""",
contacts AS (SELECT *, row_number() OVER (PARTITION BY customer_ref ORDER BY start_ts, interaction_id) AS k FROM ods_interaction WHERE length(customer_ref) > 0),
beside AS (SELECT c.*, p.start_ts AS prev_contact_ts FROM contacts c LEFT JOIN contacts p ON p.customer_ref = c.customer_ref AND p.k + 1 = c.k)
SELECT interaction_id, customer_ref, channel, start_ts, prev_contact_ts,
       CAST(coalesce({EPOCHS.format('start_ts')} - {EPOCHS.format('prev_contact_ts')} <= 72 * 3600, FALSE) AS BIGINT) AS repeat_within_72h FROM beside""")

VIEWS_SQL["billing_reconciliation"] = with_bridge(["stg_fin_invoice", "ods_invoice_acid"], f""",
both_sides AS (SELECT invoice_no, s.total_amount AS staged_amount, o.total_amount AS ods_amount, CAST(round(s.issued_ts_sec / 1000) AS BIGINT) AS staged, o.issued_ts, {EPOCHS.format('o.issued_ts')} AS cleansed
               FROM ods_invoice_acid o, stg_fin_invoice s WHERE o.invoice_id = s.invoice_id)
SELECT invoice_no, staged_amount, ods_amount, make_timestamp(staged * 1000000) AS staged_issued_ts, issued_ts AS ods_issued_ts, cleansed - staged AS drift_seconds,
       CASE WHEN ods_amount NOT BETWEEN staged_amount - 0.01 AND staged_amount + 0.01 THEN 'AMOUNT_MISMATCH' WHEN cleansed = staged THEN 'OK' ELSE 'TS_MISMATCH' END AS recon_status FROM both_sides""")

VIEWS_SQL["agent_roster_current"] = with_bridge(["ods_agent_scd2", "ods_agent_assignment_scd2"], """,
last AS (SELECT agent_id, max({'t': eff_from_ts, 'id': agent_history_id}) AS v FROM ods_agent_scd2 GROUP BY agent_id),
now AS (SELECT a.* FROM ods_agent_scd2 a JOIN last ON a.agent_id = last.agent_id AND a.agent_history_id = v.id AND a.eff_from_ts = v.t)
SELECT now.agent_id, employee_no, org_unit_id, job_grade, employment_type, status, eff_from_ts, program_id AS current_program_id, queue_id AS current_queue_id, role_on_program
FROM now LEFT JOIN (FROM ods_agent_assignment_scd2 WHERE is_current) held USING (agent_id)""")

VIEWS_SQL["agent_scorecard"] = with_bridge(["dim_agent", "agg_agent_daily"], f""",
days AS (SELECT agent_sk, CAST(sum(interactions_handled) AS BIGINT) AS total_interactions, count(date_key) AS daily_records, {r4('sum(adherence_pct::DOUBLE)')} AS sum_adherence,
         {r4('sum(avg_handle_seconds::DOUBLE)')} AS sum_aht FROM agg_agent_daily GROUP BY agent_sk)
SELECT agent_sk, full_name, site_code, job_grade, total_interactions, daily_records, sum_adherence, sum_aht FROM days JOIN dim_agent USING (agent_sk) WHERE is_current""")

VIEWS_SQL["attrition_risk"] = with_bridge(["fact_adherence_daily", "ods_attrition_event", "dim_agent"], f""",
means AS (SELECT agent_sk, sum(adherence_pct)::DOUBLE / count(adherence_pct) AS mean FROM fact_adherence_daily GROUP BY agent_sk),
staff AS (SELECT *, (SELECT count(*) FROM ods_attrition_event e WHERE e.agent_id = a.agent_id) AS notices, row_number() OVER (ORDER BY mean, agent_sk) AS place, count(*) OVER () AS n
          FROM dim_agent a JOIN means USING (agent_sk) WHERE is_current AND status = 'ACTIVE'),
banded AS (SELECT *, CASE WHEN place <= (n % 5) * (n // 5 + 1) THEN (place - 1) // (n // 5 + 1) + 1 ELSE n % 5 + (place - 1 - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) + 1 END AS fifth FROM staff)
SELECT agent_sk, agent_id, full_name, site_code, {r4('mean')} AS adherence_90d, notices AS notice_events, CASE WHEN notices > 0 THEN 'HIGH' ELSE CASE fifth WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END END AS attrition_risk
FROM banded""")

VIEWS_SQL["queue_sla_attainment"] = with_bridge(["fact_queue_interval", "dim_queue", "stg_crm_sla_target"], f""",
days AS (SELECT queue_sk, date_key, sum(answered_in_sl) AS quick, sum(answered) AS taken FROM fact_queue_interval GROUP BY ALL),
rated AS (SELECT queue_code, media_type, date_key, {_percent('quick', 'taken')} AS pct, (SELECT max(target_value) FROM stg_crm_sla_target t WHERE t.queue_id = q.queue_id AND metric_code = 'SL_20_80') AS sl_target
          FROM days JOIN dim_queue q USING (queue_sk))
SELECT queue_code, media_type, date_key, {r4('pct')} AS sl_pct, sl_target, CASE WHEN coalesce(pct >= sl_target, FALSE) THEN 'MET' ELSE 'MISSED' END AS attainment FROM rated""")

VIEWS_SQL["first_contact_resolution"] = with_bridge(["fact_interaction"], f""",
solved AS (SELECT date_key, program_sk, (SELECT count(*) FROM fact_interaction later WHERE later.customer_ref = f.customer_ref
             AND later.start_ts BETWEEN f.end_ts + INTERVAL 1 MICROSECOND AND f.end_ts + INTERVAL 168 HOUR) AS again FROM fact_interaction f WHERE resolved_flag),
counted AS (SELECT date_key, program_sk, CAST(sum(greatest(again, 1)) AS BIGINT) AS resolved_interactions, count(*) FILTER (WHERE again = 0) AS fcr_count FROM solved GROUP BY ALL)
SELECT *, {r4(_percent('fcr_count', 'resolved_interactions'))} AS fcr_pct FROM counted""")

VIEWS_SQL["occupancy_utilization"] = with_bridge(["fact_agent_activity", "dim_agent"], f""",
states AS (SELECT agent_sk, date_key, {_total('state_seconds', "list_contains(['TALK', 'HOLD', 'ACW'], state_code)")} AS handle_seconds, {_total('state_seconds', "state_code = 'READY'")} AS ready_seconds,
           {_total('state_seconds', "starts_with(state_code, 'AUX')")} AS aux_seconds FROM fact_agent_activity GROUP BY ALL)
SELECT date_key, site_code, agent_sk, handle_seconds, ready_seconds, aux_seconds, {r4(_percent('handle_seconds', 'handle_seconds + ready_seconds'))} AS occupancy_pct FROM states JOIN dim_agent USING (agent_sk)""")

VIEWS_SQL["shrinkage_analysis"] = with_bridge(["fact_adherence_daily", "dim_agent", "ods_schedule", "dim_shift"], f""",
placed AS (SELECT d.*, a.site_code, a.agent_id, make_date(date_key // 10000, date_key // 100 % 100, date_key % 100) AS d FROM fact_adherence_daily d JOIN dim_agent a USING (agent_sk)),
rostered AS (SELECT date_key, site_code, schedule_id, shift_id FROM placed JOIN ods_schedule s ON s.agent_id = placed.agent_id AND s.sched_date = d),
weighed AS (SELECT *, greatest(1, (SELECT count(*) FROM ods_schedule s WHERE s.agent_id = placed.agent_id AND s.sched_date = d)) AS times FROM placed),
sums AS (SELECT date_key, site_code, CAST(sum(times * scheduled_minutes) AS BIGINT) AS scheduled_minutes, CAST(sum(times * worked_minutes) AS BIGINT) AS worked_minutes,
         CAST(sum(times * (exception_minutes + timeoff_minutes)) AS BIGINT) AS shrinkage_minutes FROM weighed GROUP BY ALL)
SELECT s.*, {r4(_percent('shrinkage_minutes', 'scheduled_minutes'))} AS shrinkage_pct,
       (SELECT count(DISTINCT schedule_id) FROM rostered r WHERE r.date_key = s.date_key AND r.site_code = s.site_code) AS schedules,
       (SELECT count(DISTINCT shift_sk) FROM rostered r JOIN dim_shift h USING (shift_id) WHERE overnight_flag AND r.date_key = s.date_key AND r.site_code = s.site_code) AS overnight_shifts FROM sums s""")

VIEWS_SQL["program_margin"] = with_bridge(["agg_billing_monthly", "ods_timesheet", "ods_payroll_adjustment", "ods_contract_line"], f""",
labour AS (SELECT work_month AS period_month, sum(billable_minutes) / 60.0 * 18.50 AS cost FROM ods_timesheet GROUP BY program_id, work_month),
adjusted AS (SELECT period_month, sum(amount) AS total FROM ods_payroll_adjustment GROUP BY period_month),
promised AS (SELECT sum(min_commit) AS least FROM ods_contract_line GROUP BY contract_id),
promises AS (SELECT least FROM promised UNION ALL SELECT NULL WHERE (SELECT count(*) FROM promised) = 0)
SELECT period_month, client_sk, program_sk, billed_amount, net_revenue, {r4('cost')} AS est_labor_cost, CAST(total AS DECIMAL(22,2)) AS total_adjustments,
       {r4('net_revenue::DOUBLE - cost - coalesce(total, 0)::DOUBLE')} AS est_margin, CAST(least AS DECIMAL(22,2)) AS committed_min
FROM promises, agg_billing_monthly LEFT JOIN labour USING (period_month) LEFT JOIN adjusted USING (period_month)""")

VIEWS_SQL["client_executive_summary"] = with_bridge(["dim_client", "dim_program", "agg_program_monthly", "agg_csat_rollup_monthly", "agg_billing_monthly", "fact_ticket"], """,
months AS (SELECT * EXCLUDE (grouping_level) FROM agg_program_monthly WHERE grouping_level = 0),
liked AS (SELECT program_sk, period_month, pct_promoters, pct_detractors FROM agg_csat_rollup_monthly),
money AS (SELECT program_sk, period_month, billed_amount, sla_credit_amount, net_revenue FROM agg_billing_monthly),
desk AS (SELECT program_sk, count(*) FILTER (WHERE status IN ('PENDING', 'OPEN')) AS open_tickets, count(*) FILTER (WHERE sla_breached_flag) AS sla_breached_tickets FROM fact_ticket GROUP BY program_sk)
SELECT client_code, client_name, period_month, program_code, interactions, avg_handle_seconds, avg_csat, pct_promoters, pct_detractors, billed_amount, sla_credit_amount, net_revenue, open_tickets, sla_breached_tickets
FROM months JOIN dim_program USING (program_sk) JOIN dim_client USING (client_id) LEFT JOIN liked USING (program_sk, period_month) LEFT JOIN money USING (program_sk, period_month) LEFT JOIN desk USING (program_sk)""")

VIEWS_SQL["queue_hourly"] = with_bridge(["fact_queue_interval"], f""",
hours AS (SELECT queue_sk, date_key, CAST(date_part('hour', interval_start_ts) AS BIGINT) AS hour_of_day, offered, answered, abandoned, answered_in_sl FROM fact_queue_interval)
SELECT queue_sk, hour_of_day, date_key, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in ('offered', 'answered', 'abandoned', 'answered_in_sl'))} FROM hours GROUP BY ALL""")

#: every unit climbs to the unit above it, until there is none: climbed(unit, at, names, steps)
CLIMB = f"""WITH RECURSIVE units AS ({BRIDGE['ods_org_unit'].strip()}),
climbed AS (SELECT org_unit_id AS unit, org_unit_id AS top, parent_unit_id AS above, [unit_name] AS names, CAST(0 AS BIGINT) AS steps FROM units
            UNION ALL SELECT unit, u.org_unit_id, u.parent_unit_id, list_prepend(u.unit_name, names), steps + 1 FROM climbed JOIN units u ON u.org_unit_id = above WHERE steps < 6),
arrived AS (SELECT u.*, top AS root_unit_id, steps AS depth, names FROM climbed JOIN units u ON u.org_unit_id = unit WHERE above IS NULL)"""
VIEWS_SQL["org_hierarchy"] = CLIMB + """
SELECT org_unit_id, unit_code, unit_name, unit_type, site_code, root_unit_id, depth, array_to_string(names, ' > ') AS path_names FROM arrived"""

# ---- layered queries: over the views above -------------------------------------------

LAYERED_SQL: dict[str, str] = {}
LAYERED_SQL["csat_rollup_layered"] = f"""
SELECT client_id, program_code, CAST(sum(surveys) AS BIGINT) AS surveys, CAST(sum(sum_csat) AS BIGINT) AS sum_csat, CAST(sum(promoter_count) AS BIGINT) AS promoter_count,
       {r4('sum(sum_csat) / nullif(sum(surveys), 0)')} AS avg_csat, {r4(_percent('sum(promoter_count)', 'sum(surveys)'))} AS pct_promoters, CAST(GROUPING(client_id, program_code) AS BIGINT) AS grouping_id
FROM ({VIEWS_SQL['csat_rollup']}) GROUP BY GROUPING SETS ((client_id, program_code), (client_id), ())"""
LAYERED_SQL["agent_scorecard_layered"] = with_bridge(["dim_agent", "agg_agent_daily", "ods_agent_skill_scd2"], f""",
days AS (SELECT agent_sk, CAST(sum(interactions_handled) AS BIGINT) AS total_interactions, count(date_key) AS daily_records, sum(adherence_pct::DOUBLE) / nullif(count(date_key), 0) AS adherence,
         sum(avg_handle_seconds::DOUBLE) / nullif(count(date_key), 0) AS handle FROM agg_agent_daily GROUP BY agent_sk),
skilled AS (SELECT agent_id, array_to_string(list_sort(list(DISTINCT skill_code)), ',') AS skills FROM ods_agent_skill_scd2 WHERE is_current GROUP BY agent_id),
cards AS (SELECT agent_sk, agent_id, full_name, site_code, job_grade, total_interactions, daily_records, adherence, handle, row_number() OVER (ORDER BY total_interactions DESC NULLS LAST, agent_sk) AS place,
          count(*) OVER () AS n, rank() OVER (ORDER BY adherence NULLS FIRST) AS r FROM days JOIN dim_agent USING (agent_sk) WHERE is_current)
SELECT agent_sk, full_name, site_code, job_grade, total_interactions, daily_records, {r4('adherence')} AS avg_adherence, {r4('handle')} AS avg_aht,
       {r4('CASE WHEN n > 1 THEN (r - 1) / (n - 1) ELSE 0 END')} AS adherence_percent_rank,
       CASE WHEN place <= (n % 4) * (n // 4 + 1) THEN (place - 1) // (n // 4 + 1) + 1 ELSE n % 4 + (place - 1 - (n % 4) * (n // 4 + 1)) // greatest(n // 4, 1) + 1 END AS volume_quartile, skills
FROM cards LEFT JOIN skilled USING (agent_id)""")
LAYERED_SQL["queue_hourly_layered"] = f"SELECT *, {r4(_percent('answered_in_sl', 'answered'))} AS sl_pct FROM ({VIEWS_SQL['queue_hourly']})"
LAYERED_SQL["xjoin_staging"] = with_bridge(["stg_fin_invoice", "stg_fin_invoice_line"], "SELECT invoice_id, issued_ts_sec, line_amount FROM stg_fin_invoice_line JOIN stg_fin_invoice USING (invoice_id)")
LAYERED_SQL["xjoin_ods"] = with_bridge(["ods_interaction", "ods_call"], "SELECT interaction_id, call_id FROM ods_call, ods_interaction WHERE right(interaction_id, -1) = call_id::VARCHAR")
LAYERED_SQL["xjoin_dm"] = with_bridge(["fact_interaction", "dim_agent", "dim_program"],
                                      "SELECT interaction_id, full_name, program_name FROM fact_interaction JOIN dim_agent USING (agent_sk) JOIN dim_program USING (program_sk)")

ORACLE_VIEWS = {**VIEWS_SQL, **LAYERED_SQL}
