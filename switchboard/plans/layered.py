"""Queries layered on the three materialized views (Q1-Q3).

The warehouse materializes raw sums only (its materialized views allow no
ROLLUP, windows or scalar transforms over aggregates) and states that the
rest is "layered via query". These are those queries. Rules not fixed by
the reference are chosen here and documented per function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.ordered import with_global_ntile, with_global_percent_rank
from . import views as V


def csat_rollup_layered(fact_csat_survey: DataFrame, dim_program: DataFrame) -> DataFrame:
    """Q1: ROLLUP(client_id, program_code) over V3 with derived ratios.

    grouping_id = GROUPING(client_id) * 2 + GROUPING(program_code):
    0 = detail, 1 = client subtotal, 3 = grand total. The rollup runs on the
    already aggregated V3 rows (one per client and program).
    """
    base = V.csat_rollup(fact_csat_survey, dim_program)
    g = base.rollup("client_id", "program_code").agg(
        F.sum("surveys").cast("bigint").alias("surveys"), F.sum("sum_csat").cast("bigint").alias("sum_csat"),
        F.sum("promoter_count").cast("bigint").alias("promoter_count"),
        F.grouping_id().cast("bigint").alias("grouping_id"))
    return g.select("client_id", "program_code", "surveys", "sum_csat", "promoter_count",
                    X.safe_divide("sum_csat", "surveys").alias("avg_csat"),
                    X.safe_pct("promoter_count", "surveys").alias("pct_promoters"), "grouping_id")


def agent_scorecard_layered(dim_agent: DataFrame, agg_agent_daily: DataFrame,
                            ods_agent_skill_scd2: DataFrame) -> DataFrame:
    """Q2: V8 plus averages, PERCENT_RANK of mean adherence, volume quartile
    and the agent's current skills.

    Chosen here: percent rank ascending by mean adherence (ties share a rank);
    NTILE(4) by total_interactions descending, ties by agent_sk; skills are
    the distinct current skill codes sorted and joined with ','. Both global
    windows run over range partitions, not one task.
    """
    sc = V.agent_scorecard(dim_agent, agg_agent_daily)
    sc = sc.select("*", X.safe_divide("sum_adherence", "daily_records").alias("avg_adherence"),
                   X.safe_divide("sum_aht", "daily_records").alias("avg_aht"))
    sc = with_global_percent_rank(sc, "avg_adherence", [F.col("agent_sk")], "adherence_percent_rank")
    sc = with_global_ntile(sc, 4, [F.col("total_interactions").desc_nulls_last(), F.col("agent_sk")],
                           "volume_quartile")
    ids = dim_agent.select("agent_sk", "agent_id")
    skills = (ods_agent_skill_scd2.where(F.col("is_current") == F.lit(True))
              .select("agent_id", "skill_code").distinct()
              .groupBy("agent_id").agg(F.array_join(F.array_sort(F.collect_list("skill_code")), ",").alias("skills")))
    out = sc.join(ids, "agent_sk", "left").join(skills, "agent_id", "left")
    return out.select("agent_sk", "full_name", "site_code", "job_grade", "total_interactions", "daily_records",
                      "avg_adherence", "avg_aht", "adherence_percent_rank", "volume_quartile", "skills")


def queue_hourly_layered(fact_queue_interval: DataFrame) -> DataFrame:
    """Q3: V16 plus sl_pct = 100 * answered_in_sl / answered (NULL on zero)."""
    h = V.queue_hourly(fact_queue_interval)
    return h.select("*", X.safe_pct("answered_in_sl", "answered").alias("sl_pct"))
