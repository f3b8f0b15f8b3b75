"""View output contracts: column names, order and types.

Timestamps are TIMESTAMP_NTZ holding UTC (zone-free); NUMERIC columns are
checked on their scale; adherence_90d keeps the AVG(NUMERIC) scale because
the view text has no cast.
"""
import pytest

from switchboard.plans.catalog import VIEW_NAMES
from switchboard.sources.warehouse import Warehouse

SF = "/root/testdata/sf0.001"

# fixed values: the view signatures
SIGNATURES = {
    "vw_org_hierarchy": "org_unit_id bigint, unit_code string, unit_name string, unit_type string, site_code string, "
                        "root_unit_id bigint, depth bigint, path_names string",
    "vw_active_agents_ndv": "date_key bigint, site_code string, approx_active_agents bigint, "
                            "approx_agent_channel_pairs bigint, interactions bigint",
    "vw_csat_rollup": "client_id bigint, program_code string, surveys bigint, sum_csat bigint, promoter_count bigint",
    "vw_call_driver_regex": "call_date date, queue_id bigint, call_driver string, embedded_ref_no string, calls bigint, "
                            "avg_talk_seconds double",
    "vw_repeat_contact_window": "interaction_id string, customer_ref string, channel string, start_ts timestamp, "
                                "prev_contact_ts timestamp, repeat_within_72h bigint",
    "vw_billing_reconciliation": "invoice_no string, staged_amount decimal(.,2), ods_amount decimal(.,2), "
                                 "staged_issued_ts timestamp, ods_issued_ts timestamp, drift_seconds bigint, "
                                 "recon_status string",
    "vw_agent_roster_current": "agent_id bigint, employee_no string, org_unit_id bigint, job_grade string, "
                               "employment_type string, status string, eff_from_ts timestamp, current_program_id bigint, "
                               "current_queue_id bigint, role_on_program string",
    "vw_agent_scorecard": "agent_sk bigint, full_name string, site_code string, job_grade string, total_interactions bigint, "
                          "daily_records bigint, sum_adherence double, sum_aht double",
    "vw_attrition_risk": "agent_sk bigint, agent_id bigint, full_name string, site_code string, adherence_90d decimal(.,9), "
                         "notice_events bigint, attrition_risk string",
    "vw_queue_sla_attainment": "queue_code string, media_type string, date_key bigint, sl_pct double, "
                               "sl_target decimal(.,4), attainment string",
    "vw_first_contact_resolution": "date_key bigint, program_sk bigint, resolved_interactions bigint, fcr_count bigint, "
                                   "fcr_pct double",
    "vw_occupancy_utilization": "date_key bigint, site_code string, agent_sk bigint, handle_seconds bigint, "
                                "ready_seconds bigint, aux_seconds bigint, occupancy_pct double",
    "vw_shrinkage_analysis": "date_key bigint, site_code string, scheduled_minutes bigint, worked_minutes bigint, "
                             "shrinkage_minutes bigint, shrinkage_pct double, schedules bigint, overnight_shifts bigint",
    "vw_program_margin": "period_month date, client_sk bigint, program_sk bigint, billed_amount decimal(.,2), "
                         "net_revenue decimal(.,2), est_labor_cost double, total_adjustments decimal(.,2), "
                         "est_margin double, committed_min decimal(.,2)",
    "vw_client_executive_summary": "client_code string, client_name string, period_month date, program_code string, "
                                   "interactions bigint, avg_handle_seconds decimal(.,2), avg_csat decimal(.,2), "
                                   "pct_promoters decimal(.,2), pct_detractors decimal(.,2), billed_amount decimal(.,2), "
                                   "sla_credit_amount decimal(.,2), net_revenue decimal(.,2), open_tickets bigint, "
                                   "sla_breached_tickets bigint",
    "mv_agg_queue_hourly": "queue_sk bigint, hour_of_day bigint, offered bigint, answered bigint, abandoned bigint, "
                           "answered_in_sl bigint, date_key bigint",
}


def spark_type(t):
    name = t.simpleString()
    if name.startswith("decimal"):
        return f"decimal(.,{t.scale})"
    return {"timestamp_ntz": "timestamp"}.get(name, name)


@pytest.mark.parametrize("view", sorted(SIGNATURES))
def test_view_signature(spark, view):
    df = Warehouse.fixtures(spark, SF).run(VIEW_NAMES[view])
    got = ", ".join(f"{f.name} {spark_type(f.dataType)}" for f in df.schema.fields)
    assert got == SIGNATURES[view]
    ts = [f for f in df.schema.fields if "timestamp" in f.dataType.simpleString()]
    assert all(f.dataType.simpleString() == "timestamp_ntz" for f in ts)
