"""Declared schemas and layout of the 100 warehouse tables.

Column names, order and types are fixed values of the table contract
(they must equal the reference DDL); they are kept as Spark DDL strings and
parsed by Spark. Layout: partition column (date, or integer range
[start, end, step]), clustering columns, partition expiration in days.
"""

from __future__ import annotations

# --- fixed values: table columns (name -> Spark DDL) ----------------------
COLUMNS = {
    "stg_crm_client": "client_id bigint, client_code string, client_name string, industry string, hq_country string, status string, created_ts bigint, updated_ts bigint, load_date date",
    "stg_crm_client_contact": "contact_id bigint, client_id bigint, full_name string, email string, phone string, role string, is_primary boolean, created_ts bigint, load_date date",
    "stg_crm_program": "program_id bigint, client_id bigint, program_code string, program_name string, line_of_business string, channel_mix string, site_code string, status string, go_live_ts bigint, updated_ts bigint, load_date date",
    "stg_crm_contract": "contract_id bigint, client_id bigint, program_id bigint, contract_no string, start_dt string, end_dt string, billing_model string, currency string, signed_dt string, status string, load_date date",
    "stg_crm_contract_line": "contract_line_id bigint, contract_id bigint, line_no bigint, service_code string, uom string, unit_rate decimal(12,4), min_commit decimal(12,2), effective_dt string, load_date date",
    "stg_crm_sla_target": "sla_target_id bigint, program_id bigint, queue_id bigint, metric_code string, target_value decimal(10,4), penalty_pct decimal(5,2), effective_ts bigint, load_date date",
    "stg_hr_agent": "agent_id bigint, employee_no string, first_name string, last_name string, email string, org_unit_id bigint, job_grade string, employment_type string, hire_ts bigint, term_ts bigint, status string, load_date date",
    "stg_hr_org_unit": "org_unit_id bigint, parent_unit_id bigint, unit_code string, unit_name string, unit_type string, site_code string, cost_center string, created_ts bigint, load_date date",
    "stg_hr_employment_event": "event_id bigint, agent_id bigint, event_type string, event_ts bigint, from_org_unit_id bigint, to_org_unit_id bigint, reason_code string, load_date date",
    "stg_hr_skill": "skill_id bigint, skill_code string, skill_name string, skill_family string, created_ts bigint, load_date date",
    "stg_hr_agent_skill": "agent_skill_id bigint, agent_id bigint, skill_id bigint, proficiency bigint, certified boolean, effective_ts bigint, expiry_ts bigint, load_date date",
    "stg_wfm_shift": "shift_id bigint, shift_code string, shift_name string, start_hhmm string, end_hhmm string, overnight_flag boolean, site_code string, created_epoch bigint, load_date date",
    "stg_wfm_schedule": "schedule_id bigint, agent_id bigint, shift_id bigint, sched_date string, start_epoch bigint, end_epoch bigint, paid_minutes bigint, activity_code string, load_date date, site_code string",
    "stg_wfm_adherence_event": "adherence_event_id bigint, agent_id bigint, schedule_id bigint, exception_type string, start_epoch bigint, end_epoch bigint, approved_flag boolean, load_date date",
    "stg_wfm_forecast": "forecast_id bigint, queue_id bigint, interval_start_epoch bigint, forecast_volume bigint, forecast_aht_sec bigint, required_fte decimal(8,2), load_date date",
    "stg_wfm_timeoff_request": "timeoff_id bigint, agent_id bigint, request_epoch bigint, start_date string, end_date string, timeoff_type string, status string, load_date date",
    "stg_tel_call": "call_id bigint, ani string, dnis string, queue_id bigint, agent_id bigint, program_id bigint, start_epoch bigint, answer_epoch bigint, end_epoch bigint, disposition_code string, direction string, recording_id string, load_date date",
    "stg_tel_call_segment": "segment_id bigint, call_id bigint, segment_no bigint, segment_type string, start_epoch bigint, end_epoch bigint, agent_id bigint, load_date date",
    "stg_tel_queue": "queue_id bigint, queue_code string, queue_name string, program_id bigint, media_type string, priority bigint, created_epoch bigint, load_date date",
    "stg_tel_agent_state_event": "state_event_id bigint, agent_id bigint, state_code string, start_epoch bigint, end_epoch bigint, reason_code string, load_date date",
    "stg_tel_disposition_code": "disposition_code string, disposition_desc string, category string, billable_flag boolean, created_epoch bigint, load_date date",
    "stg_tkt_ticket": "ticket_id bigint, ticket_no string, program_id bigint, category_id bigint, opened_by_agent_id bigint, assigned_agent_id bigint, interaction_ref string, priority string, status string, created_ms bigint, updated_ms bigint, load_date date",
    "stg_tkt_ticket_event": "ticket_event_id bigint, ticket_id bigint, event_type string, event_ms bigint, actor_agent_id bigint, old_value string, new_value string, load_date date",
    "stg_tkt_category": "category_id bigint, category_code string, category_name string, sla_hours bigint, created_ms bigint, load_date date",
    "stg_fin_invoice": "invoice_id bigint, invoice_no string, client_id bigint, program_id bigint, period_month string, issued_ts_sec bigint, due_ts_sec bigint, currency string, total_amount decimal(14,2), status string, load_date date",
    "stg_fin_invoice_line": "invoice_line_id bigint, invoice_id bigint, contract_line_id bigint, qty decimal(12,2), unit_rate decimal(12,4), line_amount decimal(14,2), adjustment_flag boolean, created_ms bigint, load_date date",
    "stg_fin_rate_card": "rate_card_id bigint, program_id bigint, service_code string, rate decimal(12,4), currency string, effective_ts bigint, expiry_ts bigint, load_date date",
    "stg_fin_timesheet_delta": "timesheet_id bigint, agent_id bigint, work_date string, program_id bigint, billable_minutes bigint, nonbillable_minutes bigint, approved_flag boolean, op string, change_ms bigint, extract_ts date",
    "stg_fin_payroll_adj_delta": "adjustment_id bigint, agent_id bigint, period_month string, adj_type string, amount decimal(12,2), op string, change_ms bigint, extract_ts date",
    "stg_crm_sla_credit_delta": "sla_credit_id bigint, program_id bigint, sla_target_id bigint, period_month string, credit_amount decimal(12,2), reason string, op string, change_ms bigint, extract_ts date",
    "stg_tel_callback_request_delta": "callback_id bigint, call_id bigint, queue_id bigint, requested_epoch bigint, scheduled_epoch bigint, completed_flag boolean, op string, change_ms bigint, extract_ts date",
    "stg_wfm_shift_swap_delta": "swap_id bigint, requesting_agent_id bigint, accepting_agent_id bigint, schedule_id bigint, swap_date string, status string, op string, change_ms bigint, extract_ts date",
    "stg_tkt_worklog_delta": "worklog_id bigint, ticket_id bigint, agent_id bigint, minutes_logged bigint, log_ms bigint, note string, op string, change_ms bigint, extract_ts date",
    "stg_hr_attrition_event_delta": "attrition_event_id bigint, agent_id bigint, notice_epoch bigint, last_day string, attrition_type string, reason_code string, regrettable_flag boolean, op string, change_ms bigint, extract_ts date",
    "stg_fin_rate_card_change_delta": "rate_change_id bigint, rate_card_id bigint, old_rate decimal(12,4), new_rate decimal(12,4), change_reason string, op string, change_ms bigint, extract_ts date",
    "stg_file_interaction_export": "interaction_ref string, channel string, client_interaction_id string, agent_email string, start_ms bigint, end_ms bigint, outcome string, customer_ref string, client_code string, feed_date date",
    "stg_file_survey_csat": "survey_id string, interaction_ref string, survey_ms bigint, csat_score bigint, nps_score bigint, fcr_claimed boolean, verbatim string, client_code string, feed_date date",
    "stg_file_qa_forms": "qa_form_id string, interaction_ref string, evaluator_email string, evaluated_ms bigint, form_version string, sections array<struct<section_code:string, max_points:bigint, scored_points:bigint>>, auto_fail boolean, overall_pct decimal(5,2), client_code string, feed_date date",
    "stg_file_ivr_logs": "event_ms bigint, session_ref string, menu_path string, key_pressed string, raw_tail string, client_code string, feed_date date",
    "stg_file_chat_transcripts": "chat_ref string, queue_code string, agent_email string, started_ms bigint, ended_ms bigint, messages array<struct<sender:string, ts_ms:bigint, text:string>>, metadata array<struct<key:string, value:string>>, client_code string, feed_date date",
    "stg_file_roster": "employee_no string, agent_email string, client_login string, role_on_program string, active_flag boolean, as_of_ms bigint, client_code string, feed_date date",
    "stg_file_telco_invoice": "telco_invoice_id string, carrier string, circuit_id string, usage_minutes bigint, charge_amount decimal(12,2), bill_period string, billed_ms bigint, client_code string, feed_date date",
    "stg_file_dialer_result": "attempt_id string, campaign_code string, phone_hash string, agent_id bigint, attempt_ms bigint, result_code string, talk_seconds bigint, client_code string, feed_date date",
    "stg_file_email_interaction": "email_ref string, mailbox string, agent_email string, received_ms bigint, first_reply_ms bigint, resolved_ms bigint, subject_category string, client_code string, feed_date date",
    "stg_file_speech_analytics": "recording_id string, call_ref string, analyzed_ms bigint, sentiment_score double, silence_pct double, talk_over_count bigint, keywords array<string>, client_code string, feed_date date",
    "ods_program": "program_id bigint, client_id bigint, program_code string, program_name string, line_of_business string, channel_mix string, site_code string, status string, go_live_ts timestamp, updated_ts timestamp, snapshot_date date",
    "ods_contract": "contract_id bigint, client_id bigint, program_id bigint, contract_no string, start_ts timestamp, end_ts timestamp, billing_model string, currency string, signed_ts timestamp, status string, snapshot_date date",
    "ods_contract_line": "contract_line_id bigint, contract_id bigint, line_no bigint, service_code string, uom string, unit_rate decimal(12,4), min_commit decimal(12,2), effective_ts timestamp, snapshot_date date",
    "ods_org_unit": "org_unit_id bigint, parent_unit_id bigint, unit_code string, unit_name string, unit_type string, site_code string, cost_center string, created_ts timestamp, snapshot_date date",
    "ods_queue": "queue_id bigint, queue_code string, queue_name string, program_id bigint, media_type string, priority bigint, created_ts timestamp, snapshot_date date",
    "ods_schedule": "schedule_id bigint, agent_id bigint, shift_id bigint, shift_code string, start_ts timestamp, end_ts timestamp, paid_minutes bigint, activity_code string, site_code string, sched_date date",
    "ods_adherence_event": "adherence_event_id bigint, agent_id bigint, schedule_id bigint, exception_type string, start_ts timestamp, end_ts timestamp, exception_minutes bigint, approved_flag boolean, event_date date",
    "ods_call": "call_id bigint, queue_id bigint, agent_id bigint, program_id bigint, direction string, start_ts timestamp, answer_ts timestamp, end_ts timestamp, ring_seconds bigint, talk_seconds bigint, hold_seconds bigint, acw_seconds bigint, abandoned_flag boolean, disposition_code string, recording_id string, call_date date",
    "ods_ivr_session": "session_ref string, client_code string, first_event_ts timestamp, last_event_ts timestamp, menu_path_full string, hops bigint, contained_flag boolean, exit_key string, event_date date",
    "ods_chat_session": "chat_ref string, client_code string, queue_code string, agent_email string, started_ts timestamp, ended_ts timestamp, message_count bigint, agent_message_count bigint, customer_message_count bigint, first_response_seconds bigint, event_date date",
    "ods_email_interaction": "email_ref string, client_code string, mailbox string, agent_email string, received_ts timestamp, first_reply_ts timestamp, resolved_ts timestamp, reply_sla_minutes bigint, subject_category string, event_date date",
    "ods_survey_response": "survey_id string, client_code string, interaction_ref string, survey_ts timestamp, csat_score bigint, nps_score bigint, fcr_claimed boolean, verbatim string, event_date date",
    "ods_qa_evaluation": "qa_form_id string, client_code string, interaction_ref string, evaluator_email string, evaluated_ts timestamp, form_version string, section_count bigint, scored_points bigint, max_points bigint, auto_fail boolean, overall_pct decimal(5,2), event_date date",
    "ods_interaction": "interaction_id string, channel string, client_code string, program_id bigint, queue_id bigint, agent_id bigint, customer_ref string, start_ts timestamp, end_ts timestamp, handle_seconds bigint, resolved_flag boolean, source_system string, event_date date",
    "ods_dialer_attempt": "attempt_id string, client_code string, campaign_code string, agent_id bigint, attempt_ts timestamp, result_code string, connected_flag boolean, talk_seconds bigint, event_date date",
    "ods_timesheet": "timesheet_id bigint, agent_id bigint, work_date string, program_id bigint, billable_minutes bigint, nonbillable_minutes bigint, approved_flag boolean, last_change_ts timestamp, work_month date",
    "ods_payroll_adjustment": "adjustment_id bigint, agent_id bigint, adj_type string, amount decimal(12,2), last_change_ts timestamp, period_month date",
    "ods_sla_credit": "sla_credit_id bigint, program_id bigint, sla_target_id bigint, credit_amount decimal(12,2), reason string, last_change_ts timestamp, period_month date",
    "ods_callback_request": "callback_id bigint, call_id bigint, queue_id bigint, requested_ts timestamp, scheduled_ts timestamp, completed_flag boolean, last_change_ts timestamp, event_date date",
    "ods_shift_swap": "swap_id bigint, requesting_agent_id bigint, accepting_agent_id bigint, schedule_id bigint, swap_date string, status string, last_change_ts timestamp, swap_month date",
    "ods_ticket_worklog": "worklog_id bigint, ticket_id bigint, agent_id bigint, minutes_logged bigint, log_ts timestamp, note string, last_change_ts timestamp, event_date date",
    "ods_attrition_event": "attrition_event_id bigint, agent_id bigint, notice_ts timestamp, last_day string, attrition_type string, reason_code string, regrettable_flag boolean, last_change_ts timestamp, event_month date",
    "ods_rate_card": "rate_card_id bigint, program_id bigint, service_code string, rate decimal(12,4), currency string, effective_ts timestamp, expiry_ts timestamp, last_change_ts timestamp, snapshot_date date",
    "ods_agent_scd2": "agent_history_id string, agent_id bigint, employee_no string, org_unit_id bigint, job_grade string, employment_type string, status string, eff_from_ts timestamp, eff_to_ts timestamp, is_current boolean, eff_from_year bigint",
    "ods_agent_skill_scd2": "agent_skill_history_id string, agent_id bigint, skill_id bigint, skill_code string, proficiency bigint, certified boolean, eff_from_ts timestamp, eff_to_ts timestamp, is_current boolean, eff_from_year bigint",
    "ods_agent_assignment_scd2": "assignment_history_id string, agent_id bigint, program_id bigint, queue_id bigint, role_on_program string, eff_from_ts timestamp, eff_to_ts timestamp, is_current boolean, eff_from_year bigint",
    "ods_client_acid": "client_id bigint, client_code string, client_name string, industry string, hq_country string, status string, created_ts timestamp, updated_ts timestamp",
    "ods_agent_acid": "agent_id bigint, employee_no string, full_name string, email string, org_unit_id bigint, job_grade string, employment_type string, hire_ts timestamp, term_ts timestamp, status string",
    "ods_ticket_acid": "ticket_id bigint, ticket_no string, program_id bigint, category_id bigint, assigned_agent_id bigint, priority string, status string, created_ts timestamp, updated_ts timestamp, resolved_ts timestamp",
    "ods_invoice_acid": "invoice_id bigint, invoice_no string, client_id bigint, program_id bigint, period_month string, issued_ts timestamp, due_ts timestamp, currency string, total_amount decimal(14,2), status string",
    "dim_date": "date_key bigint, full_date string, day_of_week bigint, day_name string, week_of_year bigint, month_no bigint, month_name string, quarter_no bigint, year_no bigint, is_weekend boolean, is_holiday_us boolean, fiscal_period string",
    "dim_agent": "agent_sk bigint, agent_id bigint, employee_no string, full_name string, job_grade string, employment_type string, org_unit_id bigint, team_name string, site_code string, status string, hire_date_key bigint, is_current boolean",
    "dim_client": "client_sk bigint, client_id bigint, client_code string, client_name string, industry string, hq_country string, primary_contact_name string, primary_contact_email string, status string",
    "dim_program": "program_sk bigint, program_id bigint, program_code string, program_name string, client_id bigint, line_of_business string, channel_mix string, site_code string, billing_model string, status string, go_live_date_key bigint",
    "dim_queue": "queue_sk bigint, queue_id bigint, queue_code string, queue_name string, program_id bigint, media_type string, priority bigint",
    "dim_site": "site_sk bigint, site_code string, site_name string, region string, country string, timezone string",
    "dim_shift": "shift_sk bigint, shift_id bigint, shift_code string, shift_name string, start_hhmm string, end_hhmm string, overnight_flag boolean, site_code string",
    "dim_org": "org_sk bigint, org_unit_id bigint, unit_code string, unit_name string, unit_type string, level1_name string, level2_name string, level3_name string, level4_name string, site_code string, cost_center string",
    "dim_disposition": "disposition_sk bigint, disposition_code string, disposition_desc string, category string, billable_flag boolean",
    "fact_interaction": "interaction_id string, client_sk bigint, program_sk bigint, queue_sk bigint, agent_sk bigint, customer_ref string, start_ts timestamp, end_ts timestamp, handle_seconds bigint, resolved_flag boolean, source_system string, date_key bigint, channel string",
    "fact_agent_activity": "agent_sk bigint, state_code string, state_seconds bigint, occurrence_count bigint, first_state_ts timestamp, last_state_ts timestamp, date_key bigint",
    "fact_queue_interval": "queue_sk bigint, interval_start_ts timestamp, offered bigint, answered bigint, abandoned bigint, answered_in_sl bigint, sl_threshold_sec bigint, avg_speed_answer_sec decimal(8,2), avg_handle_sec decimal(8,2), date_key bigint",
    "fact_csat_survey": "survey_id string, interaction_id string, client_sk bigint, program_sk bigint, agent_sk bigint, survey_ts timestamp, csat_score bigint, nps_score bigint, fcr_claimed boolean, date_key bigint",
    "fact_qa_evaluation": "qa_form_id string, interaction_id string, agent_sk bigint, program_sk bigint, evaluated_ts timestamp, scored_points bigint, max_points bigint, overall_pct decimal(5,2), auto_fail boolean, date_key bigint",
    "fact_billing_line": "invoice_line_id bigint, invoice_id bigint, client_sk bigint, program_sk bigint, service_code string, qty decimal(12,2), unit_rate decimal(12,4), line_amount decimal(14,2), adjustment_flag boolean, invoice_status string, period_month date",
    "fact_adherence_daily": "agent_sk bigint, scheduled_minutes bigint, worked_minutes bigint, exception_minutes bigint, timeoff_minutes bigint, adherence_pct decimal(5,2), occupancy_pct decimal(5,2), date_key bigint",
    "fact_ticket": "ticket_id bigint, program_sk bigint, category_code string, assigned_agent_sk bigint, priority string, status string, created_ts timestamp, resolved_ts timestamp, resolution_minutes bigint, sla_breached_flag boolean, touch_count bigint, date_key bigint",
    "fact_ivr_path": "session_ref string, client_code string, menu_path_full string, hops bigint, contained_flag boolean, exit_key string, duration_seconds bigint, date_key bigint",
    "agg_agent_daily": "agent_sk bigint, site_code string, interactions_handled bigint, avg_handle_seconds decimal(8,2), talk_seconds bigint, acw_seconds bigint, aux_seconds bigint, adherence_pct decimal(5,2), occupancy_pct decimal(5,2), date_key bigint",
    "agg_agent_weekly": "agent_sk bigint, site_code string, days_worked bigint, interactions_handled bigint, avg_handle_seconds decimal(8,2), adherence_pct decimal(5,2), occupancy_pct decimal(5,2), week_start_key bigint",
    "agg_program_monthly": "client_sk bigint, program_sk bigint, line_of_business string, interactions bigint, avg_handle_seconds decimal(8,2), avg_csat decimal(5,2), billed_amount decimal(14,2), grouping_level bigint, period_month date",
    "agg_queue_hourly": "queue_sk bigint, hour_of_day bigint, offered bigint, answered bigint, abandoned bigint, sl_pct decimal(5,2), forecast_volume bigint, volume_variance_pct decimal(7,2), date_key bigint",
    "agg_csat_rollup_monthly": "client_sk bigint, program_sk bigint, site_code string, surveys bigint, avg_csat decimal(5,2), pct_promoters decimal(5,2), pct_detractors decimal(5,2), grouping_id bigint, period_month date",
    "agg_billing_monthly": "client_sk bigint, program_sk bigint, billed_amount decimal(14,2), sla_credit_amount decimal(12,2), telco_cost_amount decimal(12,2), net_revenue decimal(14,2), period_month date",
    "agg_site_daily": "site_code string, agents_active bigint, interactions bigint, avg_handle_seconds decimal(8,2), sl_pct decimal(5,2), adherence_pct decimal(5,2), date_key bigint",
}

# --- fixed values: layout (partition, cluster columns, expiration days) --
LAYOUT = {
    "stg_crm_client": (("load_date", None), (), 90),
    "stg_crm_client_contact": (("load_date", None), (), 90),
    "stg_crm_program": (("load_date", None), (), 90),
    "stg_crm_contract": (("load_date", None), (), 90),
    "stg_crm_contract_line": (("load_date", None), (), 90),
    "stg_crm_sla_target": (("load_date", None), (), 90),
    "stg_hr_agent": (("load_date", None), (), 90),
    "stg_hr_org_unit": (("load_date", None), (), 90),
    "stg_hr_employment_event": (("load_date", None), (), 90),
    "stg_hr_skill": (("load_date", None), (), 90),
    "stg_hr_agent_skill": (("load_date", None), (), 90),
    "stg_wfm_shift": (("load_date", None), (), 90),
    "stg_wfm_schedule": (("load_date", None), ("site_code",), 90),
    "stg_wfm_adherence_event": (("load_date", None), (), 90),
    "stg_wfm_forecast": (("load_date", None), (), 90),
    "stg_wfm_timeoff_request": (("load_date", None), (), 90),
    "stg_tel_call": (("load_date", None), ("call_id",), 90),
    "stg_tel_call_segment": (("load_date", None), (), 90),
    "stg_tel_queue": (("load_date", None), (), 90),
    "stg_tel_agent_state_event": (("load_date", None), (), 90),
    "stg_tel_disposition_code": (("load_date", None), (), 90),
    "stg_tkt_ticket": (("load_date", None), (), 90),
    "stg_tkt_ticket_event": (("load_date", None), (), 90),
    "stg_tkt_category": (("load_date", None), (), 90),
    "stg_fin_invoice": (("load_date", None), (), 90),
    "stg_fin_invoice_line": (("load_date", None), (), 90),
    "stg_fin_rate_card": (("load_date", None), (), 90),
    "stg_fin_timesheet_delta": (("extract_ts", None), (), 90),
    "stg_fin_payroll_adj_delta": (("extract_ts", None), (), 90),
    "stg_crm_sla_credit_delta": (("extract_ts", None), (), 90),
    "stg_tel_callback_request_delta": (("extract_ts", None), (), 90),
    "stg_wfm_shift_swap_delta": (("extract_ts", None), (), 90),
    "stg_tkt_worklog_delta": (("extract_ts", None), (), 90),
    "stg_hr_attrition_event_delta": (("extract_ts", None), (), 90),
    "stg_fin_rate_card_change_delta": (("extract_ts", None), (), 90),
    "stg_file_interaction_export": (("feed_date", None), ("client_code",), 90),
    "stg_file_survey_csat": (("feed_date", None), ("client_code",), 90),
    "stg_file_qa_forms": (("feed_date", None), ("client_code",), 90),
    "stg_file_ivr_logs": (("feed_date", None), ("client_code",), 90),
    "stg_file_chat_transcripts": (("feed_date", None), ("client_code",), 90),
    "stg_file_roster": (("feed_date", None), ("client_code",), 90),
    "stg_file_telco_invoice": (("feed_date", None), ("client_code",), 90),
    "stg_file_dialer_result": (("feed_date", None), ("client_code",), 90),
    "stg_file_email_interaction": (("feed_date", None), ("client_code",), 90),
    "stg_file_speech_analytics": (("feed_date", None), ("client_code",), 90),
    "ods_program": (("snapshot_date", None), (), None),
    "ods_contract": (("snapshot_date", None), (), None),
    "ods_contract_line": (("snapshot_date", None), (), None),
    "ods_org_unit": (("snapshot_date", None), (), None),
    "ods_queue": (("snapshot_date", None), (), None),
    "ods_schedule": (("sched_date", None), (), None),
    "ods_adherence_event": (("event_date", None), (), None),
    "ods_call": (("call_date", None), (), None),
    "ods_ivr_session": (("event_date", None), (), None),
    "ods_chat_session": (("event_date", None), (), None),
    "ods_email_interaction": (("event_date", None), (), None),
    "ods_survey_response": (("event_date", None), (), None),
    "ods_qa_evaluation": (("event_date", None), (), None),
    "ods_interaction": (("event_date", None), (), None),
    "ods_dialer_attempt": (("event_date", None), (), None),
    "ods_timesheet": (("work_month", None), (), None),
    "ods_payroll_adjustment": (("period_month", None), (), None),
    "ods_sla_credit": (("period_month", None), (), None),
    "ods_callback_request": (("event_date", None), (), None),
    "ods_shift_swap": (("swap_month", None), (), None),
    "ods_ticket_worklog": (("event_date", None), (), None),
    "ods_attrition_event": (("event_month", None), (), None),
    "ods_rate_card": (("snapshot_date", None), (), None),
    "ods_agent_scd2": (("eff_from_year", (2018, 2031, 1)), (), None),
    "ods_agent_skill_scd2": (("eff_from_year", (2018, 2031, 1)), (), None),
    "ods_agent_assignment_scd2": (("eff_from_year", (2018, 2031, 1)), (), None),
    "ods_client_acid": (None, ("client_id",), None),
    "ods_agent_acid": (None, ("agent_id",), None),
    "ods_ticket_acid": (None, ("ticket_id",), None),
    "ods_invoice_acid": (None, ("invoice_id",), None),
    "dim_date": (None, (), None),
    "dim_agent": (None, (), None),
    "dim_client": (None, (), None),
    "dim_program": (None, (), None),
    "dim_queue": (None, (), None),
    "dim_site": (None, (), None),
    "dim_shift": (None, (), None),
    "dim_org": (None, (), None),
    "dim_disposition": (None, (), None),
    "fact_interaction": (("date_key", (20200101, 20301201, 100)), ("channel", "agent_sk", "client_sk",), None),
    "fact_agent_activity": (("date_key", (20200101, 20301201, 100)), ("agent_sk", "state_code",), None),
    "fact_queue_interval": (("date_key", (20200101, 20301201, 100)), ("queue_sk",), None),
    "fact_csat_survey": (("date_key", (20200101, 20301201, 100)), ("program_sk",), None),
    "fact_qa_evaluation": (("date_key", (20200101, 20301201, 100)), (), None),
    "fact_billing_line": (("period_month", None), ("client_sk", "program_sk",), None),
    "fact_adherence_daily": (("date_key", (20200101, 20301201, 100)), (), None),
    "fact_ticket": (("date_key", (20200101, 20301201, 100)), (), None),
    "fact_ivr_path": (("date_key", (20200101, 20301201, 100)), (), None),
    "agg_agent_daily": (("date_key", (20200101, 20301201, 100)), ("agent_sk",), None),
    "agg_agent_weekly": (("week_start_key", (20200101, 20301201, 100)), (), None),
    "agg_program_monthly": (("period_month", None), (), None),
    "agg_queue_hourly": (("date_key", (20200101, 20301201, 100)), (), None),
    "agg_csat_rollup_monthly": (("period_month", None), (), None),
    "agg_billing_monthly": (("period_month", None), ("client_sk", "program_sk",), None),
    "agg_site_daily": (("date_key", (20200101, 20301201, 100)), (), None),
}

# --- fixed values: the three layers (dataset descriptions) --------------------
LAYERS = {
    "staging": "Landing mirrors of source systems; epochs kept as INT64",
    "ods": "Cleansed and merged operational data; all times as TIMESTAMP",
    "dm": "Dimensional marts, aggregates and views",
}


def layer_of(table: str) -> str:
    return "staging" if table.startswith("stg_") else "ods" if table.startswith("ods_") else "dm"


# --- fixed values: column descriptions of the staging layer, by how a column's time is kept ---
SECONDS, MILLIS = "epoch SECONDS (legacy)", "epoch MILLISECONDS (legacy)"
NOT_SECONDS, ORACLE_TEXT = "!! name says seconds, VALUES ARE MILLIS !!", "Oracle string YYYYMMDDHH24MISS (legacy)"


def description(table: str, column: str, kind: str) -> str | None:
    """The description of a column: staging tables say how they keep times; other columns have none."""
    if not table.startswith("stg_"):
        return None
    if kind == "bigint":
        if column.endswith("_ts_sec"):
            return NOT_SECONDS
        if column.endswith("_ms"):
            return MILLIS
        if column.endswith(("_ts", "_epoch")):
            return SECONDS
    return ORACLE_TEXT if kind == "string" and column.endswith("_dt") else None


def schema(table: str):
    """Declared StructType of a table (parsed by Spark from the DDL string); a described column has it as its ``comment``,
    which tables written with the schema keep."""
    from pyspark.sql.types import StructField, StructType
    told = [(f, description(table, f.name, f.dataType.simpleString())) for f in StructType.fromDDL(COLUMNS[table])]
    return StructType([StructField(f.name, f.dataType, f.nullable, {"comment": d} if d else None) for f, d in told])


def empty(spark, table: str):
    """An empty DataFrame with the declared schema (schema-only scan)."""
    return spark.createDataFrame([], schema(table))


def ntz_schema(table: str):
    """The declared schema with TIMESTAMP as TIMESTAMP_NTZ (UTC), as the library's tables carry it."""
    from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType
    return StructType([StructField(f.name, TimestampNTZType() if isinstance(f.dataType, TimestampType) else f.dataType) for f in schema(table)])


def conform(df, table: str):
    """The declared columns of ``table`` in their order, cast to their types; a column that is missing is an error."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ntz_schema(table)])


def partition_columns(table: str) -> list[str]:
    """Folder partition columns as written by the table jobs: the date column,
    or ``<col>__bucket`` for integer-range partitioning."""
    part = LAYOUT[table][0]
    if part is None:
        return []
    col, rng = part
    return [col if rng is None else col + "__bucket"]


def create_databases(spark, prefix: str = "") -> list[str]:
    """CREATE DATABASE IF NOT EXISTS for the three layers, with descriptions."""
    names = []
    for layer, comment in LAYERS.items():
        name = f"{prefix}{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT '{comment}'")
        names.append(name)
    return names


def create_tables(spark, root: str, tables: list[str] | None = None) -> dict[str, str]:
    """Create every table as an empty Parquet folder with its declared schema
    and partition layout under ``root``; returns table -> path."""
    from ..operators.tables import range_bucket
    paths = {}
    for t in tables or list(COLUMNS):
        df = empty(spark, t)
        part = LAYOUT[t][0]
        w = df
        if part is not None and part[1] is not None:
            w = df.withColumn(part[0] + "__bucket", range_bucket(part[0], *part[1]))
        path = f"{root.rstrip('/')}/{t}"
        writer = w.write.mode("ignore")
        cols = partition_columns(t)
        if cols:
            writer = writer.partitionBy(*cols)
        writer.parquet(path)
        paths[t] = path
    return paths
