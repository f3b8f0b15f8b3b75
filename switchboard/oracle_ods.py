"""DuckDB oracles of the change-feed targets, the histories and the fact loads.

Each says its result by the rule, in another way than the Spark jobs: sorted
rows and ROW_NUMBER for the merges, correlated look-ups for the versions in force.
"""

from __future__ import annotations

EPOCH = "CAST(floor(epoch({0})) AS BIGINT)"


def ts_of(seconds: str) -> str:
    return f"make_timestamp(CAST({seconds} AS BIGINT) * 1000000)"


def ts_of_ms(ms: str) -> str:
    return f"make_timestamp(CAST({ms} AS BIGINT) * 1000)"


def day_key(ts: str) -> str:
    return f"CAST(year({ts}) * 10000 + month({ts}) * 100 + day({ts}) AS BIGINT)"


def month(ts: str) -> str:
    return f"CAST(date_trunc('month', {ts}) AS DATE)"


SQL: dict[str, str] = {}

# ---- change feeds ---------------------------------------------------------------

_AT = EPOCH.format("l_shipdate")
_CHANGE = f"{_AT} * 1000 + (l_orderkey * 37 + l_linenumber * 11) % 86400000"
_LATE = "(l_orderkey + 3 * l_linenumber) % 2"
_OP = "CASE WHEN l_linenumber = 1 THEN 0 WHEN (l_orderkey + l_linenumber) % 5 = 0 THEN 2 ELSE 1 END"


def _last_change(key: str, payload: dict[str, str], out: str) -> str:
    """The last change of each key that is no delete; ``out`` selects from its payload, ``at`` and key."""
    cols = ", ".join(f"{v} AS {k}" for k, v in payload.items())
    order = ", ".join(f"{k} DESC" for k in payload)
    return f"""WITH c AS (SELECT l_orderkey AS {key}, {cols}, {_CHANGE} AS ms, {_LATE} AS late, {_OP} AS op FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ms DESC, late DESC, op DESC, {order}) AS n FROM c)
SELECT {out}, {ts_of_ms('ms')} AS last_change_ts FROM ranked WHERE n = 1 AND op < 2"""


_AGENT, _PROGRAM, _TEXT = "l_suppkey % 50", "l_partkey % 25", "strftime(l_shipdate, '%Y-%m-%d')"
_MONEY = "CAST(floor(l_extendedprice) AS DECIMAL(12,2))"

SQL["ods_timesheet_merge"] = _last_change("timesheet_id", dict(
    agent_id=_AGENT, work_date=_TEXT, program_id=_PROGRAM, billable_minutes="CAST(l_quantity AS BIGINT) * 10",
    nonbillable_minutes="CAST(l_linenumber * 5 AS BIGINT)", approved_flag="l_returnflag = 'R'"),
    f"timesheet_id, agent_id, work_date, program_id, billable_minutes, nonbillable_minutes, approved_flag, {month('CAST(work_date AS DATE)')} AS work_month")
SQL["ods_payroll_adjustment_merge"] = _last_change("adjustment_id", dict(
    agent_id=_AGENT, period_month=month("l_shipdate"), adj_type="l_returnflag", amount=_MONEY), "adjustment_id, agent_id, adj_type, amount, period_month")
SQL["ods_sla_credit_merge"] = _last_change("sla_credit_id", dict(
    program_id=_PROGRAM, sla_target_id="l_partkey % 40", period_month=month("l_shipdate"), credit_amount=_MONEY, reason="l_linestatus"),
    "sla_credit_id, program_id, sla_target_id, credit_amount, reason, period_month")
SQL["ods_callback_request_merge"] = _last_change("callback_id", dict(
    call_id="l_partkey", queue_id=_AGENT, requested=_AT, scheduled=f"{_AT} + CAST(l_quantity AS BIGINT) * 600", completed_flag="l_returnflag = 'R'"),
    f"callback_id, call_id, queue_id, {ts_of('requested')} AS requested_ts, {ts_of('scheduled')} AS scheduled_ts, completed_flag, CAST({ts_of('requested')} AS DATE) AS event_date")
SQL["ods_shift_swap_merge"] = _last_change("swap_id", dict(
    requesting_agent_id=_AGENT, accepting_agent_id="l_partkey % 50", schedule_id="l_partkey", swap_date=_TEXT, status="l_returnflag"),
    f"swap_id, requesting_agent_id, accepting_agent_id, schedule_id, swap_date, status, {month('CAST(swap_date AS DATE)')} AS swap_month")
SQL["ods_ticket_worklog_merge"] = _last_change("worklog_id", dict(
    ticket_id="l_partkey", agent_id=_AGENT, minutes_logged="CAST(l_quantity AS BIGINT)", log=f"{_AT} * 1000 + 5", note="l_linestatus"),
    f"worklog_id, ticket_id, agent_id, minutes_logged, {ts_of_ms('log')} AS log_ts, note, CAST({ts_of_ms('log')} AS DATE) AS event_date")
SQL["ods_attrition_event_merge"] = _last_change("attrition_event_id", dict(
    agent_id=_AGENT, notice=_AT, last_day=_TEXT, attrition_type="l_returnflag", reason_code="l_linestatus", regrettable_flag="l_returnflag = 'R'"),
    f"attrition_event_id, agent_id, {ts_of('notice')} AS notice_ts, last_day, attrition_type, reason_code, regrettable_flag, {month(ts_of('notice'))} AS event_month")

SQL["ods_rate_card_merge"] = f"""WITH c AS (SELECT l_orderkey AS id, l_partkey AS card, CAST(l_quantity AS DECIMAL(12,4)) AS old_rate,
      CAST(floor(l_extendedprice) AS DECIMAL(12,4)) AS rate, l_returnflag AS reason, {_CHANGE} AS ms, {_LATE} AS late, {_OP} AS op FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ms DESC, late DESC, op DESC, card DESC, old_rate DESC, rate DESC, reason DESC) AS n FROM c),
stands AS (SELECT card, arg_max(rate, (ms, id)) AS rate, max(ms) AS ms FROM ranked WHERE n = 1 AND op < 2 GROUP BY card)
SELECT p_partkey AS rate_card_id, p_partkey % 25 AS program_id, p_brand AS service_code,
       coalesce(s.rate, CAST(p_retailprice AS DECIMAL(12,4))) AS rate, 'USD' AS currency, {ts_of('p_partkey * 3600')} AS effective_ts,
       CASE WHEN p_partkey % 4 = 0 THEN {ts_of('p_partkey * 3600 + 86400')} END AS expiry_ts, {ts_of_ms('s.ms')} AS last_change_ts,
       CASE WHEN p_partkey % 3 = 0 THEN DATE '2001-10-02' ELSE DATE '2001-10-01' END AS snapshot_date
FROM part LEFT JOIN stands s ON s.card = p_partkey"""

# ---- histories --------------------------------------------------------------------

_LINE = "(l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey * 10 + l_suppkey % 10"


def _runs(states: str, keys: str, attributes: list[str], id_col: str, here: str = "TRUE") -> str:
    """CTEs and SELECT: runs of equal states of states(keys, t, attributes)."""
    was = " OR ".join(f"{a} IS DISTINCT FROM lag({a}) OVER w" for a in [*attributes, "here"])
    ident = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys.split(", "))
    return f"""told AS (SELECT *, {here} AS here FROM {states}),
starts AS (SELECT *, row_number() OVER w = 1 OR {was} AS opens FROM told WINDOW w AS (PARTITION BY {keys} ORDER BY t)),
runs AS (SELECT *, lead(t) OVER (PARTITION BY {keys} ORDER BY t) AS eff_to_ts FROM starts WHERE opens)
SELECT sha256({ident} || '|' || CAST(epoch_us(t) AS VARCHAR)) AS {id_col}, {keys}, {', '.join(attributes)}, t AS eff_from_ts, eff_to_ts,
       eff_to_ts IS NULL AS is_current, CAST(year(t) AS BIGINT) AS eff_from_year FROM runs WHERE here"""


_MASTER = {"employee_no": "'E' || CAST(o_custkey AS VARCHAR)", "org_unit_id": "o_custkey % 40", "job_grade": "o_orderpriority",
           "employment_type": "CASE WHEN o_custkey % 3 = 0 THEN 'PART' ELSE 'FULL' END",
           "status": "CASE WHEN o_orderkey % 50 <> 0 THEN o_orderstatus END"}
_EVENT = {"org_unit_id": "CASE WHEN l_linenumber % 4 IN (0, 2) AND l_suppkey % 9 <> 0 THEN {'v': l_suppkey % 40} END",
          "status": "CASE l_linenumber % 4 WHEN 1 THEN {'v': 'TERM'} WHEN 2 THEN {'v': 'ACTIVE'} END"}

SQL["agent_history"] = f"""WITH said AS (
  SELECT o_custkey AS agent_id, CAST(o_orderdate AS DATE)::TIMESTAMP AS t, 0 AS r, o_orderkey AS tie, {', '.join(f"{{'v': {v}}} AS {k}" for k, v in _MASTER.items())} FROM orders
  UNION ALL BY NAME
  SELECT l_partkey % 1500 AS agent_id, l_shipdate AS t, 1 AS r, {_LINE} AS tie, {', '.join(f"{v} AS {k}" for k, v in _EVENT.items())} FROM lineitem),
known AS (SELECT agent_id, t, {', '.join(f"last_value({a} IGNORE NULLS) OVER w AS {a}" for a in _MASTER)}, row_number() OVER (PARTITION BY agent_id, t ORDER BY r DESC, tie DESC) AS n
          FROM said WINDOW w AS (PARTITION BY agent_id ORDER BY t, r, tie ROWS UNBOUNDED PRECEDING)),
states AS (SELECT agent_id, t, {', '.join(f"{a}.v AS {a}" for a in _MASTER)} FROM known WHERE n = 1),
{_runs('states', 'agent_id', list(_MASTER), 'agent_history_id')}"""


def _intervals(keys: dict[str, str], attributes: dict[str, str], every: int, id_col: str, once: str = "") -> str:
    """Openings and the ends of what holds then, by one window a key."""
    names = ", ".join(keys)
    return f"""rows AS (SELECT {', '.join(f"{v} AS {k}" for k, v in {**keys, **attributes}.items())}, {_LINE} AS id, l_shipdate AS t0,
      CASE WHEN l_partkey % {every} = 0 THEN l_shipdate + to_days(CAST(CASE WHEN l_quantity = 7 THEN -1 ELSE l_quantity * 20 END AS INTEGER)) END AS t1 FROM lineitem{once}),
good AS (SELECT * FROM rows WHERE t1 IS NULL OR t1 > t0),
acts AS (SELECT {names}, t0 AS t, 1 AS kind, id, {{'id': id, {', '.join(f"'{a}': {a}" for a in attributes)}}} AS opened FROM good
         QUALIFY row_number() OVER (PARTITION BY {names}, t0 ORDER BY id DESC, {', '.join(f'{a} DESC' for a in attributes)}) = 1
         UNION ALL SELECT {names}, t1, 0, id, NULL FROM good WHERE t1 IS NOT NULL),
holds AS (SELECT *, last_value(opened IGNORE NULLS) OVER (PARTITION BY {names} ORDER BY t, kind, id ROWS UNBOUNDED PRECEDING) AS cur FROM acts),
states AS (SELECT {names}, t, max(kind) AS kind, {', '.join(f"any_value(opened.{a}) FILTER (WHERE kind = 1) AS {a}" for a in attributes)}
           FROM holds WHERE kind = 1 OR cur.id = id GROUP BY {names}, t),
{_runs('states', names, list(attributes), id_col, 'kind = 1')}"""


SQL["agent_skill_history"] = f"""WITH h AS (WITH {_intervals({'agent_id': 'l_suppkey', 'skill_id': 'l_partkey % 20'},
    {'proficiency': 'CAST(l_linenumber AS BIGINT)', 'certified': "l_returnflag = 'R'"}, 3, 'agent_skill_history_id',
    ' QUALIFY row_number() OVER (PARTITION BY id ORDER BY CAST(t0 AS DATE) DESC, agent_id DESC, skill_id DESC, proficiency DESC, certified DESC, t0 DESC, t1 DESC NULLS LAST) = 1')})
SELECT h.*, n.n_name AS skill_code FROM h LEFT JOIN nation n ON n.n_nationkey = h.skill_id AND n.n_nationkey < 18"""
SQL["agent_assignment_history"] = "WITH " + _intervals({'agent_id': 'l_suppkey', 'program_id': 'l_partkey % 25'},
    {'queue_id': 'l_orderkey % 100', 'role_on_program': 'l_returnflag'}, 2, 'assignment_history_id')

ORACLE_ODS = SQL
