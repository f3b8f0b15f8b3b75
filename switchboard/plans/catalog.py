"""Register the warehouse views in the session: CREATE VIEW / MATERIALIZED VIEW.

The sixteen views become temporary views named as in the warehouse
(``vw_*`` and ``mv_agg_queue_hourly``), so SQL users can query them by name;
the three materialized ones can instead be read from the tables kept by
``operators.tables.refresh_materialized``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources.warehouse import Warehouse
from . import views as V

# fixed values: object names of the warehouse views
VIEW_NAMES = {
    "vw_org_hierarchy": V.org_hierarchy,
    "vw_active_agents_ndv": V.active_agents_ndv,
    "vw_csat_rollup": V.csat_rollup,
    "vw_call_driver_regex": V.call_driver_regex,
    "vw_repeat_contact_window": V.repeat_contact_window,
    "vw_billing_reconciliation": V.billing_reconciliation,
    "vw_agent_roster_current": V.agent_roster_current,
    "vw_agent_scorecard": V.agent_scorecard,
    "vw_attrition_risk": V.attrition_risk,
    "vw_queue_sla_attainment": V.queue_sla_attainment,
    "vw_first_contact_resolution": V.first_contact_resolution,
    "vw_occupancy_utilization": V.occupancy_utilization,
    "vw_shrinkage_analysis": V.shrinkage_analysis,
    "vw_program_margin": V.program_margin,
    "vw_client_executive_summary": V.client_executive_summary,
    "mv_agg_queue_hourly": V.queue_hourly,
}
MATERIALIZED = ("vw_csat_rollup", "vw_agent_scorecard", "mv_agg_queue_hourly")


def register_views(spark: SparkSession, wh: Warehouse, names: list[str] | None = None) -> list[str]:
    """createOrReplaceTempView for each view (lazy: nothing runs until queried)."""
    done = []
    for name in names or list(VIEW_NAMES):
        wh.run(VIEW_NAMES[name]).createOrReplaceTempView(name)
        done.append(name)
    return done
