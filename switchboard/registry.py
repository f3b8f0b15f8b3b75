"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracles.

Every registered query reads the driver's tables in ``sf_dir`` through the
bridge, runs over whole tables, and returns the view's columns. For the
value comparison, doubles are rounded to 4 places (``_compare``) in the
query and in the oracle alike.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.tables import scratch_path
from .plans import access as A
from .plans import change_jobs as CJ
from .plans import corrected as C
from .plans import feed_jobs as FJ
from .plans import history_jobs as HJ
from .plans import layer_jobs as J
from .plans import mart_jobs as MJ
from .plans import stream_jobs as SJ
from .plans import table_jobs as TJ
from .plans import layered as L
from .plans import views as V
from .sources.warehouse import Warehouse


def _compare(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, 4).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def _view(fn: Callable[..., DataFrame], post: Callable[[DataFrame], DataFrame] | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = Warehouse.fixtures(spark, sf_dir).run(fn)
        if post is not None:
            df = post(df)
        return _compare(df)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _adherence_as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("adherence_90d", F.round(F.col("adherence_90d").cast("double"), 4))


def active_agents_ndv_checked(fact_interaction: DataFrame, dim_agent: DataFrame) -> DataFrame:
    """V2 with exact distinct counts next to the sketches, and a flag that each
    sketch is within tolerance (sketch values of two engines never agree
    bit for bit, so they are not compared raw)."""
    f = fact_interaction.select("date_key", "agent_sk", "channel")
    a = dim_agent.select("agent_sk", "site_code")
    pair = F.concat(F.col("agent_sk").cast("string"), F.lit("|"), F.col("channel"))
    g = f.join(a, "agent_sk").groupBy("date_key", "site_code").agg(
        F.approx_count_distinct("agent_sk", 0.05).alias("_aa"), F.approx_count_distinct(pair, 0.05).alias("_ap"),
        F.count_distinct("agent_sk").alias("active_agents"), F.count_distinct(pair).alias("agent_channel_pairs"),
        F.count(F.lit(1)).alias("interactions"))
    ok = lambda approx, exact: F.abs(F.col(approx) - F.col(exact)) <= F.col(exact) * 0.15 + 1
    return g.select("date_key", "site_code", "active_agents", "agent_channel_pairs", "interactions",
                    ok("_aa", "active_agents").alias("approx_agents_ok"),
                    ok("_ap", "agent_channel_pairs").alias("approx_pairs_ok"))


def active_agents_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2's sketches stored by day and site, rolled up to sites, beside exact counts: within a tenth (and one)."""
    wh = Warehouse.fixtures(spark, sf_dir)
    path = scratch_path(spark, "agent-sketches")
    wh.run(V.active_agents_sketches).write.parquet(path)
    rolled = V.active_agents_over(spark.read.parquet(path), "site_code")
    f = wh["fact_interaction"].select("agent_sk", "channel").join(wh["dim_agent"].select("agent_sk", "site_code"), "agent_sk")
    exact = f.groupBy(F.col("site_code").alias("_s")).agg(F.count_distinct("agent_sk").alias("active_agents"),
                                                          F.count_distinct("agent_sk", "channel").alias("agent_channel_pairs"))
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.col(b) * 0.1 + 1
    return rolled.join(exact, F.col("site_code").eqNullSafe(F.col("_s"))).select(
        "site_code", "active_agents", "agent_channel_pairs", "interactions", close("approx_active_agents", "active_agents").alias("agents_close"),
        close("approx_agent_channel_pairs", "agent_channel_pairs").alias("pairs_close"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "org_hierarchy": _view(V.org_hierarchy),
    "active_agents_ndv": _view(active_agents_ndv_checked),
    # the view itself; its sketches agree with no other engine's bit for bit, so it has no oracle
    "active_agents_ndv_view": _view(V.active_agents_ndv),
    "active_agents_by_site": active_agents_by_site,
    "csat_rollup": _view(V.csat_rollup),
    "call_driver_regex": _view(V.call_driver_regex),
    "repeat_contact_window": _view(V.repeat_contact_window),
    "billing_reconciliation": _view(V.billing_reconciliation),
    "agent_roster_current": _view(V.agent_roster_current),
    "agent_scorecard": _view(V.agent_scorecard),
    "attrition_risk": _view(V.attrition_risk, _adherence_as_double),
    "queue_sla_attainment": _view(V.queue_sla_attainment),
    "first_contact_resolution": _view(V.first_contact_resolution),
    "occupancy_utilization": _view(V.occupancy_utilization),
    "shrinkage_analysis": _view(V.shrinkage_analysis),
    "program_margin": _view(V.program_margin),
    "client_executive_summary": _view(V.client_executive_summary),
    "queue_hourly": _view(V.queue_hourly),
    "csat_rollup_layered": _view(L.csat_rollup_layered),
    "agent_scorecard_layered": _view(L.agent_scorecard_layered),
    "queue_hourly_layered": _view(L.queue_hourly_layered),
    "xjoin_staging": _view(A.xjoin_staging),
    "xjoin_ods": _view(A.xjoin_ods),
    "xjoin_dm": _view(A.xjoin_dm),
    "first_contact_resolution_corrected": _view(C.first_contact_resolution_corrected),
    "program_margin_corrected": _view(C.program_margin_corrected),
    "shrinkage_analysis_corrected": _view(C.shrinkage_analysis_corrected),
}


def _scan(table: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return A.scan_count(table)(Warehouse.fixtures(spark, sf_dir)[table])
    run.__name__ = f"scan_count_{table}"
    return run


for _t in A.SCAN_CONDITIONS:
    QUERIES[f"scan_count_{_t}"] = _scan(_t)


for _name, _fn in {**J.JOBS, **TJ.TABLE_JOBS, **SJ.STREAM_JOBS, **FJ.FEED_JOBS, **CJ.CHANGE_JOBS, **HJ.HISTORY_JOBS, **MJ.MART_JOBS}.items():
    QUERIES[_name] = (lambda f: (lambda spark, sf_dir: _compare(f(spark, sf_dir))))(_fn)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from .oracle import ORACLE
    from .oracle_layers import ORACLE_LAYERS
    from .oracle_marts import ORACLE_MARTS
    from .oracle_ods import ORACLE_ODS
    from .oracle_views import ORACLE_VIEWS
    return {k: v for k, v in {**ORACLE, **ORACLE_VIEWS, **ORACLE_LAYERS, **ORACLE_ODS, **ORACLE_MARTS}.items() if k in QUERIES}
