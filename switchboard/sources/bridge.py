"""Warehouse-shaped tables derived from the driver's fixture tables.

The warehouse queries read contact-centre tables (``fact_interaction``,
``dim_agent`` ...). The test data is a TPC-H-like star schema, so each
warehouse table here is a plain projection (or one aggregate) over a fixture
table. Every projection is narrow and grows linearly with the fixture; the
DuckDB oracle builds the same tables independently in SQL
(``switchboard/oracle.py``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import add_seconds, date_key, epoch_seconds, month_start

FIXTURE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                  "events", "documents", "embeddings", "pages", "benchmark", "labels",
                  "conversations")


class Fixtures:
    """Lazy readers for the driver's Parquet tables in one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def with_tables(self, replacements: dict) -> "Fixtures":
        """The same fixtures with some tables replaced by derived (or
        streaming) DataFrames; bridge builders then run on those."""
        outer = self

        class _Replaced(Fixtures):
            def __call__(self, name):
                return replacements[name] if name in replacements else outer(name)
        return _Replaced(self.spark, self.sf_dir)

    def stream(self, name: str, max_files_per_trigger: int = 1) -> DataFrame:
        """The table as a file stream (its folder, filtered to its file)."""
        schema = self(name).schema
        return (self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
                .option("maxFilesPerTrigger", max_files_per_trigger).parquet(self.sf_dir))


def _channel(event_type):
    return (F.when(event_type == "click", "VOICE").when(event_type == "view", "CHAT")
            .when(event_type == "purchase", "EMAIL").otherwise("DIALER"))


def _s(c):
    return F.col(c).cast("string")


# --- builders, one per warehouse table ------------------------------------

def ods_org_unit(fx: Fixtures) -> DataFrame:
    r = fx("region").select(
        (F.col("r_regionkey") + 1).cast("bigint").alias("org_unit_id"),
        F.lit(None).cast("bigint").alias("parent_unit_id"),
        F.col("r_name").alias("unit_code"), F.col("r_name").alias("unit_name"),
        F.lit("REGION").alias("unit_type"), F.lit("S0").alias("site_code"))
    n = fx("nation").select(
        (F.col("n_nationkey") + 100).cast("bigint").alias("org_unit_id"),
        (F.col("n_regionkey") + 1).cast("bigint").alias("parent_unit_id"),
        F.col("n_name").alias("unit_code"), F.col("n_name").alias("unit_name"),
        F.lit("SITE").alias("unit_type"), F.concat(F.lit("S"), _s("n_nationkey")).alias("site_code"))
    c = fx("customer").select(
        (F.col("c_custkey") + 1000000).cast("bigint").alias("org_unit_id"),
        F.when(F.col("c_custkey") % 8 == 0, (F.col("c_nationkey") + 100).cast("bigint"))
         .otherwise(F.col("c_custkey") + 1000000 - 1).cast("bigint").alias("parent_unit_id"),
        F.col("c_mktsegment").alias("unit_code"), F.col("c_name").alias("unit_name"),
        F.lit("TEAM").alias("unit_type"), F.concat(F.lit("S"), _s("c_nationkey")).alias("site_code"))
    return r.unionByName(n).unionByName(c)


def dim_agent(fx: Fixtures) -> DataFrame:
    s = F.col("s_suppkey")
    return fx("supplier").select(
        s.alias("agent_sk"), s.alias("agent_id"), F.col("s_name").alias("full_name"),
        F.concat(F.lit("G"), (s % 4).cast("string")).alias("job_grade"),
        F.concat(F.lit("S"), _s("s_nationkey")).alias("site_code"),
        F.when(s % 7 == 0, "TERM").otherwise("ACTIVE").alias("status"),
        (s % 5 != 0).alias("is_current"))


def dim_program(fx: Fixtures) -> DataFrame:
    return fx("nation").select(
        F.col("n_nationkey").cast("bigint").alias("program_sk"),
        F.col("n_nationkey").cast("bigint").alias("program_id"),
        F.col("n_name").alias("program_code"),
        F.concat(F.lit("Program "), F.col("n_name")).alias("program_name"),
        F.col("n_regionkey").cast("bigint").alias("client_id"))


def dim_client(fx: Fixtures) -> DataFrame:
    return fx("region").select(
        F.col("r_regionkey").cast("bigint").alias("client_sk"),
        F.col("r_regionkey").cast("bigint").alias("client_id"),
        F.concat(F.lit("C"), _s("r_regionkey")).alias("client_code"),
        F.col("r_name").alias("client_name"))


def dim_queue(fx: Fixtures) -> DataFrame:
    s = F.col("s_suppkey")
    return fx("supplier").select(
        s.alias("queue_sk"), s.alias("queue_id"),
        F.concat(F.lit("Q"), s.cast("string")).alias("queue_code"),
        F.when(s % 2 == 0, "VOICE").otherwise("CHAT").alias("media_type"))


def dim_disposition(fx: Fixtures) -> DataFrame:
    k = F.col("p_partkey")
    ref = F.concat(F.lit(" ref#"), (k % 20).cast("string"))
    m = k % 7
    desc = (F.when(m == 0, F.concat(F.lit("Refund for "), F.col("p_name"), ref))
            .when(m == 1, F.concat(F.lit("Account LOCKED: "), F.col("p_name")))
            .when(m == 2, F.concat(F.lit("wants to Cancel "), F.col("p_name")))
            .when(m == 3, F.concat(F.lit("["), F.upper(F.substring("p_type", 1, 4)), F.lit("] "), F.col("p_name")))
            .when(m == 4, F.concat(F.col("p_name"), ref))
            .when(m == 5, F.lit(None).cast("string"))
            .otherwise(F.col("p_name")))
    return fx("part").select(F.concat(F.lit("D"), k.cast("string")).alias("disposition_code"),
                             desc.alias("disposition_desc"))


def ods_call(fx: Fixtures) -> DataFrame:
    o = F.col("o_orderkey")
    return fx("orders").select(
        o.alias("call_id"), F.to_date("o_orderdate").alias("call_date"),
        (F.col("o_custkey") % 50).alias("queue_id"),
        (F.floor("o_totalprice").cast("bigint") % 900).alias("talk_seconds"),
        F.concat(F.lit("D"), (o % 500).cast("string")).alias("disposition_code"))


def ods_interaction(fx: Fixtures) -> DataFrame:
    e = F.col("event_id")
    cust = (F.when(e % 97 == 0, F.lit(None).cast("string")).when(e % 89 == 0, F.lit(""))
            .otherwise(F.concat(F.lit("U"), _s("user_id"))))
    return fx("events").select(
        F.concat(F.lit("I"), e.cast("string")).alias("interaction_id"), cust.alias("customer_ref"),
        _channel(F.col("event_type")).alias("channel"), F.col("ts").alias("start_ts"))


def fact_interaction(fx: Fixtures) -> DataFrame:
    return fx("events").select(
        F.concat(F.lit("I"), _s("event_id")).alias("interaction_id"),
        (F.col("user_id") % 50).alias("agent_sk"), (F.col("user_id") % 25).alias("program_sk"),
        F.concat(F.lit("U"), _s("user_id")).alias("customer_ref"),
        _channel(F.col("event_type")).alias("channel"), F.col("ts").alias("start_ts"),
        add_seconds("ts", F.floor("value")).alias("end_ts"),
        (F.col("event_type") != "error").alias("resolved_flag"), date_key("ts").alias("date_key"))


def fact_agent_activity(fx: Fixtures) -> DataFrame:
    et = F.col("event_type")
    state = (F.when(et == "click", "TALK").when(et == "view", "HOLD").when(et == "purchase", "ACW")
             .when(et == "signup", "READY").otherwise(F.concat(F.lit("AUX"), (F.col("event_id") % 3).cast("string"))))
    return fx("events").select(
        (F.col("user_id") % 50).alias("agent_sk"), state.alias("state_code"),
        F.floor("value").cast("bigint").alias("state_seconds"), date_key("ts").alias("date_key"))


def fact_queue_interval(fx: Fixtures) -> DataFrame:
    q = F.col("l_quantity")
    big = F.when(q > 2, 1).otherwise(0)
    return fx("lineitem").select(
        F.col("l_suppkey").alias("queue_sk"),
        add_seconds("l_shipdate", (F.col("l_orderkey") % 48) * 1800).alias("interval_start_ts"),
        q.cast("bigint").alias("offered"),
        (q.cast("bigint") - F.col("l_orderkey") % 3 * big).alias("answered"),
        F.when(q > 2, F.col("l_orderkey") % 3).otherwise(0).cast("bigint").alias("abandoned"),
        F.when(F.col("l_returnflag") == "R", 0).otherwise(F.floor(q * 0.8)).cast("bigint").alias("answered_in_sl"),
        date_key("l_shipdate").alias("date_key"))


def stg_crm_sla_target(fx: Fixtures) -> DataFrame:
    s = F.col("s_suppkey")
    return fx("supplier").where(s % 4 != 3).select(
        s.alias("queue_id"), F.when(s % 10 == 9, "ASA").otherwise("SL_20_80").alias("metric_code"),
        (s % 30 + 60).cast("decimal(10,4)").alias("target_value"))


def fact_csat_survey(fx: Fixtures) -> DataFrame:
    e = F.col("event_id")
    return fx("events").where(F.col("event_type").isin("purchase", "view")).select(
        e.alias("survey_id"), (F.col("user_id") % 25).alias("program_sk"),
        (e % 5 + 1).alias("csat_score"), (e % 11).alias("nps_score"))


def stg_fin_invoice(fx: Fixtures) -> DataFrame:
    o = F.col("o_orderkey")
    return fx("orders").select(
        o.alias("invoice_id"), F.concat(F.lit("INV"), o.cast("string")).alias("invoice_no"),
        (epoch_seconds("o_orderdate") * 1000 + (o % 3) * 700).alias("issued_ts_sec"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("total_amount"))


def ods_invoice_acid(fx: Fixtures) -> DataFrame:
    o = F.col("o_orderkey")
    bump = F.when(o % 10 == 0, 0.05).when(o % 10 == 1, 0.01).otherwise(0.0)
    return fx("orders").where(o % 11 != 0).select(
        o.alias("invoice_id"), F.col("o_orderdate").alias("issued_ts"),
        (F.col("o_totalprice") + bump).cast("decimal(14,2)").alias("total_amount"))


def ods_agent_scd2(fx: Fixtures) -> DataFrame:
    c = F.col("o_custkey")
    return fx("orders").select(
        F.concat(F.lit("H"), _s("o_orderkey")).alias("agent_history_id"),
        c.alias("agent_id"), F.concat(F.lit("E"), c.cast("string")).alias("employee_no"),
        (c % 40).alias("org_unit_id"), F.col("o_orderpriority").alias("job_grade"),
        F.when(c % 3 == 0, "PART").otherwise("FULL").alias("employment_type"),
        F.col("o_orderstatus").alias("status"),
        add_seconds("o_orderdate", F.col("o_orderkey")).alias("eff_from_ts"))


def ods_agent_assignment_scd2(fx: Fixtures) -> DataFrame:
    c = F.col("c_custkey")
    return fx("customer").select(
        c.alias("agent_id"), F.col("c_nationkey").cast("bigint").alias("program_id"),
        (c % 100).alias("queue_id"), F.col("c_mktsegment").alias("role_on_program"),
        (c % 3 != 0).alias("is_current"))


def _events_by_agent_day(fx: Fixtures) -> DataFrame:
    return fx("events").select((F.col("user_id") % 50).alias("agent_sk"), date_key("ts").alias("date_key"),
                               "value", "ts")


def agg_agent_daily(fx: Fixtures) -> DataFrame:
    n = F.count(F.lit(1))
    return _events_by_agent_day(fx).groupBy("agent_sk", "date_key").agg(
        n.alias("interactions_handled"),
        # floor of an average of whole numbers is exact in any engine
        F.floor(F.avg(F.floor("value"))).cast("decimal(8,2)").alias("avg_handle_seconds"),
        (n % 101).cast("decimal(5,2)").alias("adherence_pct"))


def agg_agent_weekly(fx: Fixtures) -> DataFrame:
    return (fx("events").groupBy((F.col("user_id") % 50).alias("agent_sk"), F.weekofyear("ts").alias("wk"))
            .agg(F.count(F.lit(1)).alias("interactions_handled")))


def fact_adherence_daily(fx: Fixtures) -> DataFrame:
    n = F.count(F.lit(1))
    return _events_by_agent_day(fx).groupBy("agent_sk", "date_key").agg(
        (n * 60).alias("scheduled_minutes"), (n * 55).alias("worked_minutes"),
        (n % 7).alias("exception_minutes"), (n % 4).alias("timeoff_minutes"),
        (100 - n % 37).cast("decimal(5,2)").alias("adherence_pct"))


def ods_attrition_event(fx: Fixtures) -> DataFrame:
    o = F.col("o_orderkey")
    return fx("orders").where(o % 400 == 0).select(o.alias("attrition_event_id"),
                                                    (F.col("o_custkey") % 100).alias("agent_id"))


def ods_schedule(fx: Fixtures) -> DataFrame:
    e = F.col("event_id")
    return fx("events").where(F.col("event_type").isin("signup", "view")).select(
        e.alias("schedule_id"), (F.col("user_id") % 50).alias("agent_id"), (e % 6).alias("shift_id"),
        F.to_date("ts").alias("sched_date"))


def dim_shift(fx: Fixtures) -> DataFrame:
    r = F.col("r_regionkey")
    return fx("region").select(r.cast("bigint").alias("shift_sk"), r.cast("bigint").alias("shift_id"),
                               (r % 2 == 0).alias("overnight_flag"))


def agg_billing_monthly(fx: Fixtures) -> DataFrame:
    li = fx("lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice", "l_discount")
    s = fx("supplier").select("s_suppkey", "s_nationkey")
    n = fx("nation").select("n_nationkey", "n_regionkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    # SUM(CAST(x AS DECIMAL(12,2))) summed as exact integer cents: a 22-digit
    # decimal sum runs on BigDecimal, a BIGINT sum on longs; values are equal
    def cents(c):
        return F.sum(F.round(c.cast("decimal(12,2)") * 100).cast("bigint"))

    def money(c):
        return (c.cast("decimal(20,0)") / 100).cast("decimal(14,2)")
    billed = cents(F.col("l_extendedprice"))
    credit = cents(F.col("l_discount") * 100)
    g = j.groupBy(month_start("l_shipdate").alias("period_month"),
                  F.col("n_regionkey").cast("bigint").alias("client_sk"),
                  F.col("s_nationkey").cast("bigint").alias("program_sk")).agg(
        billed.alias("_b"), credit.alias("_c"))
    return g.select("period_month", "client_sk", "program_sk", money(F.col("_b")).alias("billed_amount"),
                    money(F.col("_c")).alias("sla_credit_amount"),
                    money(F.col("_b") - F.col("_c")).alias("net_revenue"))


def ods_timesheet(fx: Fixtures) -> DataFrame:
    return fx("orders").where(F.col("o_orderstatus") == "F").select(
        (F.col("o_custkey") % 25).cast("bigint").alias("program_id"),
        month_start("o_orderdate").alias("work_month"),
        (F.floor("o_totalprice").cast("bigint") % 480).alias("billable_minutes"))


def ods_payroll_adjustment(fx: Fixtures) -> DataFrame:
    return fx("orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.month("o_orderdate") != 6)).select(
        month_start("o_orderdate").alias("period_month"),
        (F.floor("o_totalprice") % 1000).cast("decimal(12,2)").alias("amount"))


def ods_contract_line(fx: Fixtures) -> DataFrame:
    return fx("nation").select(F.col("n_regionkey").cast("bigint").alias("contract_id"),
                               (F.col("n_nationkey") + 100).cast("decimal(12,2)").alias("min_commit"))


def agg_program_monthly(fx: Fixtures) -> DataFrame:
    return fx("orders").groupBy(month_start("o_orderdate").alias("period_month"),
                                (F.col("o_custkey") % 25).alias("program_sk")).agg(
        F.count(F.lit(1)).alias("interactions"),
        F.floor(F.avg(F.floor("o_totalprice")) / 1000).cast("decimal(8,2)").alias("avg_handle_seconds"),
        (F.max(F.col("o_custkey") % 5) + 1).cast("decimal(5,2)").alias("avg_csat"),
        F.lit(0).cast("bigint").alias("grouping_level"))


def agg_csat_rollup_monthly(fx: Fixtures) -> DataFrame:
    o = F.col("o_orderkey")
    n = F.count(F.lit(1))
    prom = F.sum(F.when(o % 11 >= 9, 1).otherwise(0))
    det = F.sum(F.when(o % 11 <= 6, 1).otherwise(0))
    return fx("orders").groupBy(month_start("o_orderdate").alias("period_month"),
                                (F.col("o_custkey") % 25).alias("program_sk")).agg(
        n.alias("surveys"),
        F.round(prom * 100.0 / n, 2).cast("decimal(5,2)").alias("pct_promoters"),
        F.round(det * 100.0 / n, 2).cast("decimal(5,2)").alias("pct_detractors"))


def ods_agent_skill_scd2(fx: Fixtures) -> DataFrame:
    """Skills of an agent (supplier) = brands of the parts it ships (one row
    per shipped line), so the table grows linearly with lineitem."""
    li = fx("lineitem").select("l_suppkey", "l_partkey", "l_linenumber")
    p = fx("part").select("p_partkey", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_suppkey").alias("agent_id"), F.col("p_brand").alias("skill_code"),
        (F.col("p_partkey") % 5).alias("proficiency"),
        (F.col("l_linenumber") % 3 != 0).alias("is_current"))


def fact_ticket(fx: Fixtures) -> DataFrame:
    st = F.col("o_orderstatus")
    return fx("orders").select(
        F.col("o_orderkey").alias("ticket_id"), (F.col("o_custkey") % 25).alias("program_sk"),
        F.when(st == "O", "OPEN").when(st == "P", "PENDING").otherwise("CLOSED").alias("status"),
        (F.col("o_orderpriority") == "1-URGENT").alias("sla_breached_flag"))


BUILDERS = {f.__name__: f for f in (
    ods_org_unit, dim_agent, dim_program, dim_client, dim_queue, dim_disposition, ods_call,
    ods_interaction, fact_interaction, fact_agent_activity, fact_queue_interval,
    stg_crm_sla_target, fact_csat_survey, stg_fin_invoice, ods_invoice_acid, ods_agent_scd2,
    ods_agent_assignment_scd2, agg_agent_daily, agg_agent_weekly, fact_adherence_daily,
    ods_attrition_event, ods_schedule, dim_shift, agg_billing_monthly, ods_timesheet,
    ods_payroll_adjustment, ods_contract_line, agg_program_monthly, agg_csat_rollup_monthly,
    ods_agent_skill_scd2, fact_ticket)}


def union_all(dfs) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def stg_fin_invoice_line(fx: Fixtures) -> DataFrame:
    li = F.col("l_linenumber")
    return fx("lineitem").select(
        (F.col("l_orderkey") * 10 + li).alias("invoice_line_id"), F.col("l_orderkey").alias("invoice_id"),
        F.col("l_quantity").cast("decimal(12,2)").alias("qty"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("line_amount"),
        (F.col("l_discount") > 0.05).alias("adjustment_flag"))


def fact_billing_line(fx: Fixtures) -> DataFrame:
    li = fx("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice")
    s = fx("supplier").select("s_suppkey", "s_nationkey")
    n = fx("nation").select("n_nationkey", "n_regionkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return j.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("invoice_line_id"),
                    F.col("l_orderkey").alias("invoice_id"),
                    F.col("n_regionkey").cast("bigint").alias("client_sk"),
                    F.col("s_nationkey").cast("bigint").alias("program_sk"),
                    F.col("l_extendedprice").cast("decimal(14,2)").alias("line_amount"),
                    month_start("l_shipdate").alias("period_month"))


def stg_tel_call(fx: Fixtures) -> DataFrame:
    return fx("orders").select(
        F.col("o_orderkey").alias("call_id"), (F.col("o_custkey") % 50).alias("queue_id"),
        epoch_seconds("o_orderdate").alias("start_epoch"),
        F.date_sub(F.lit("2026-06-02").cast("date"), (F.col("o_orderkey") % 90).cast("int")).alias("load_date"))


BUILDERS.update({f.__name__: f for f in (stg_fin_invoice_line, fact_billing_line, stg_tel_call)})
