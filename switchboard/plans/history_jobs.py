"""The three type-2 histories (T7) on feeds made from orders and lineitem.

Orders are the agent master's snapshots, lineitem the employment events (some at
the very time of a snapshot), skills and assignments (which overlap, expire or
stay open). All rows of the tables are in the feeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import history as H
from ..sources import bridge as B
from ..sources.schemas import conform


def stg_hr_agent(fx) -> DataFrame:
    c = F.col("o_custkey")
    return fx("orders").select(c.alias("agent_id"), F.concat(F.lit("E"), c.cast("string")).alias("employee_no"), (c % 40).alias("org_unit_id"),
                               F.col("o_orderpriority").alias("job_grade"), F.when(c % 3 == 0, "PART").otherwise("FULL").alias("employment_type"),
                               F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderstatus")).alias("status"), F.col("o_orderkey").alias("hire_ts"),
                               F.to_date("o_orderdate").alias("load_date"))


def _line_id():
    """A key of lineitem's rows (order and line number alone repeat)."""
    return (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey") * 10 + F.col("l_suppkey") % 10


def stg_hr_employment_event(fx) -> DataFrame:
    n = F.col("l_linenumber") % 4
    kind = F.when(n == 0, "TRANSFER").when(n == 1, "TERMINATION").when(n == 2, "REHIRE").otherwise("REVIEW")
    return fx("lineitem").select(_line_id().alias("event_id"), (F.col("l_partkey") % 1500).alias("agent_id"), kind.alias("event_type"),
                                 X.epoch_seconds("l_shipdate").alias("event_ts"), F.lit(None).cast("bigint").alias("from_org_unit_id"),
                                 F.when(F.col("l_suppkey") % 9 != 0, F.col("l_suppkey") % 40).alias("to_org_unit_id"))


def _until(every: int):
    """Some rows expire, a few before they begin."""
    days = F.when(F.col("l_quantity") == 7, F.lit(-1)).otherwise(F.col("l_quantity") * 20).cast("bigint")
    return F.when(F.col("l_partkey") % every == 0, X.epoch_seconds("l_shipdate") + days * 86400)


def agent_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = B.Fixtures(spark, sf_dir)
    return conform(H.agent_history(stg_hr_agent(fx), stg_hr_employment_event(fx)), "ods_agent_scd2")


def agent_skill_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = B.Fixtures(spark, sf_dir)
    held = fx("lineitem").select(_line_id().alias("agent_skill_id"), F.col("l_suppkey").alias("agent_id"), (F.col("l_partkey") % 20).alias("skill_id"),
                                 F.col("l_linenumber").cast("bigint").alias("proficiency"), (F.col("l_returnflag") == "R").alias("certified"),
                                 X.epoch_seconds("l_shipdate").alias("effective_ts"), _until(3).alias("expiry_ts"), F.to_date("l_shipdate").alias("load_date"))
    skills = fx("nation").where(F.col("n_nationkey") < 18).select(F.col("n_nationkey").cast("bigint").alias("skill_id"), F.col("n_name").alias("skill_code"),
                                                                 F.lit("2001-01-01").cast("date").alias("load_date"))
    return conform(H.agent_skill_history(held, skills), "ods_agent_skill_scd2")


def agent_assignment_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = B.Fixtures(spark, sf_dir)
    rows = fx("lineitem").select(_line_id().alias("assignment_id"), F.col("l_suppkey").alias("agent_id"), (F.col("l_partkey") % 25).alias("program_id"),
                                 (F.col("l_orderkey") % 100).alias("queue_id"), F.col("l_returnflag").alias("role_on_program"),
                                 F.col("l_shipdate").alias("start_ts"), X.seconds_to_ts(_until(2)).alias("end_ts"))
    return conform(H.agent_assignment_history(rows), "ods_agent_assignment_scd2")


HISTORY_JOBS = {f.__name__: f for f in (agent_history, agent_skill_history, agent_assignment_history)}
