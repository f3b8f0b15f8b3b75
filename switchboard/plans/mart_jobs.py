"""Registered builds of every target of ``operators.marts``: build_<table>, in declared columns, from the fixture staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import history as H
from ..operators import marts as M
from ..sources import bridge as B
from ..sources.schemas import COLUMNS, conform
from .mart_feeds import FEEDS, staging


def builds(spark: SparkSession, sf_dir: str) -> M.Builds:
    fx = B.Fixtures(spark, sf_dir)

    def source(name: str) -> DataFrame:
        if name == "ods_agent_scd2":
            return conform(H.agent_history(made["stg_hr_agent"], made["stg_hr_employment_event"]), name)
        return staging(fx, name)
    made = M.Builds(source, held=set(FEEDS))
    return made


def _build(table: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return builds(spark, sf_dir)[table]
    run.__name__ = f"build_{table}"
    return run


TARGETS = [n for n in M.BUILDERS if n in COLUMNS]
MART_JOBS = {f"build_{t}": _build(t) for t in TARGETS}
