"""Corrected variants of the three views whose joins fan out.

The views in ``views.py`` reproduce the reference exactly, fan-outs
included. These variants keep the same outputs without the fan-out; the
rules are chosen here:

* FCR counts interactions, not join rows (semi/anti join semantics);
* margin joins labour on program *and* month (program_sk -> program_id
  through the program dimension) and takes the committed minimum as one
  total over all contract lines instead of one row per contract;
* shrinkage sums each adherence row once; distinct counts are unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.intervals import count_points_in_windows
from . import views as V


def first_contact_resolution_corrected(fact_interaction: DataFrame) -> DataFrame:
    """Per day and program: resolved interactions, those with no repeat contact
    of the customer in (end, end + 7 days], and the percentage."""
    points = fact_interaction.select("customer_ref", F.col("start_ts").alias("ts"))
    probes = (fact_interaction.where(F.col("resolved_flag") == F.lit(True))
              .select("customer_ref", "date_key", "program_sk", F.col("end_ts").alias("lo"),
                      X.add_days_exact("end_ts", V.FCR_WINDOW_DAYS).alias("hi")))
    m = count_points_in_windows(points, probes, key="customer_ref", ts="ts", lo="lo", hi="hi",
                                carry=["date_key", "program_sk"], out="repeats", copies="n")
    g = m.groupBy("date_key", "program_sk").agg(
        F.sum("n").cast("bigint").alias("resolved_interactions"),
        F.sum(F.when(F.col("repeats") == 0, F.col("n")).otherwise(0)).cast("bigint").alias("fcr_count"))
    return g.select("date_key", "program_sk", "resolved_interactions", "fcr_count",
                    (X.safe_divide("fcr_count", "resolved_interactions") * F.lit(100.0)).alias("fcr_pct"))


def program_margin_corrected(agg_billing_monthly: DataFrame, dim_program: DataFrame, ods_timesheet: DataFrame,
                             ods_payroll_adjustment: DataFrame, ods_contract_line: DataFrame) -> DataFrame:
    """One row per billing row: labour of that program and month, the month's
    adjustments, and the total committed minimum."""
    b = agg_billing_monthly.select("period_month", "client_sk", "program_sk", "billed_amount", "net_revenue")
    p = dim_program.select(F.col("program_sk").alias("_psk"), F.col("program_id").alias("_pid"))
    lab = (ods_timesheet.groupBy(F.col("program_id").alias("_lab_pid"), F.col("work_month").alias("_lab_m"))
           .agg(F.sum("billable_minutes").alias("billable_cost_minutes")))
    adj = (ods_payroll_adjustment.groupBy(F.col("period_month").alias("_adj_m"))
           .agg(F.sum("amount").alias("total_adjustments")))
    # exactly one row: a bounded broadcast
    cmt = ods_contract_line.agg(F.sum("min_commit").alias("committed_min"))
    j = (b.join(p, F.col("_psk") == F.col("program_sk"), "left")
         .join(lab, (F.col("_lab_pid") == F.col("_pid")) & (F.col("_lab_m") == F.col("period_month")), "left")
         .join(adj, F.col("_adj_m") == F.col("period_month"), "left")
         .crossJoin(F.broadcast(cmt)))
    labor = F.col("billable_cost_minutes") / F.lit(60.0) * F.lit(V.LABOR_RATE_PER_HOUR)
    margin = (F.col("net_revenue").cast("double") - labor
              - F.coalesce(F.col("total_adjustments"), F.lit(0)).cast("double"))
    return j.select("period_month", "client_sk", "program_sk", "billed_amount", "net_revenue",
                    labor.cast("double").alias("est_labor_cost"),
                    F.col("total_adjustments").cast("decimal(22,2)").alias("total_adjustments"),
                    margin.alias("est_margin"), F.col("committed_min").cast("decimal(22,2)").alias("committed_min"))


def shrinkage_analysis_corrected(fact_adherence_daily: DataFrame, dim_agent: DataFrame, ods_schedule: DataFrame,
                                 dim_shift: DataFrame) -> DataFrame:
    """V13 with each adherence row summed once (no schedule fan-out)."""
    f = fact_adherence_daily.select("agent_sk", "date_key", "scheduled_minutes", "worked_minutes",
                                    "exception_minutes", "timeoff_minutes")
    a = dim_agent.select("agent_sk", "agent_id", "site_code")
    j = f.join(a, "agent_sk")
    sums = j.groupBy("date_key", "site_code").agg(
        F.sum("scheduled_minutes").cast("bigint").alias("scheduled_minutes"),
        F.sum("worked_minutes").cast("bigint").alias("worked_minutes"),
        F.sum(F.col("exception_minutes") + F.col("timeoff_minutes")).cast("bigint").alias("shrinkage_minutes"))
    lit = V.shrinkage_analysis(fact_adherence_daily, dim_agent, ods_schedule, dim_shift).select(
        "date_key", "site_code", "schedules", "overnight_shifts")
    lit = lit.withColumnsRenamed({"date_key": "_d", "site_code": "_site"})
    g = sums.join(lit, F.col("date_key").eqNullSafe(F.col("_d")) & F.col("site_code").eqNullSafe(F.col("_site")), "left")
    return g.select("date_key", "site_code", "scheduled_minutes", "worked_minutes", "shrinkage_minutes",
                    X.safe_pct("shrinkage_minutes", "scheduled_minutes").alias("shrinkage_pct"),
                    "schedules", "overnight_shifts")
