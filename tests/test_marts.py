"""Full-width builds: declared columns, the version in force at a fact's time, unknown keys, decimals without doubles."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from switchboard.functions import exprs as X
from switchboard.operators import marts as M
from switchboard.plans import mart_jobs
from switchboard.sources import schemas

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark):
    return mart_jobs.builds(spark, SF)


@pytest.mark.parametrize("table", mart_jobs.TARGETS)
def test_target_has_its_declared_columns(built, table):
    assert [(f.name, f.dataType) for f in built[table].schema] == [(f.name, f.dataType) for f in schemas.ntz_schema(table)]


def versions(spark):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(1, 7, t), (2, 7, t + dt.timedelta(days=10)), (3, 8, t)], "agent_sk long, agent_id long, eff_from_ts timestamp_ntz")


def test_facts_take_the_version_in_force(spark):
    t = dt.datetime(2024, 1, 1)
    facts = spark.createDataFrame([("before", 7, t - dt.timedelta(seconds=1)), ("first", 7, t), ("old", 7, t + dt.timedelta(days=9)), ("change", 7, t + dt.timedelta(days=10)),
                                   ("new", 7, t + dt.timedelta(days=400)), ("other", 8, t + dt.timedelta(days=400)), ("none", 9, t), ("null", None, t), ("when", 7, None)],
                                  "f string, agent_id long, start_ts timestamp_ntz")
    out = M._agent_at(facts, versions(spark), "start_ts")
    assert {r["f"]: r["agent_sk"] for r in out.collect()} == {"before": -1, "first": 1, "old": 1, "change": 2, "new": 2, "other": 3, "none": -1, "null": -1, "when": -1}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_late_version_does_not_move_older_facts(spark):
    t = dt.datetime(2024, 1, 5)
    facts = spark.createDataFrame([(7, t)], "agent_id long, start_ts timestamp_ntz")
    later = versions(spark).union(spark.createDataFrame([(9, 7, t + dt.timedelta(days=30))], "agent_sk long, agent_id long, eff_from_ts timestamp_ntz"))
    assert M._agent_at(facts, later, "start_ts").first()["agent_sk"] == 1


def test_a_hot_agent_is_many_groups(spark):
    t = dt.datetime(2024, 1, 1)
    facts = spark.range(4000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("agent_id"),
                                     F.timestamp_add("MINUTE", F.col("id"), F.lit(t).cast("timestamp_ntz")).alias("start_ts"))
    out = M._agent_at(facts, versions(spark), "start_ts")
    assert out.where("agent_id = 7").groupBy("agent_sk").count().collect()[0]["count"] == facts.where("agent_id = 7").count()


def test_facts_are_not_multiplied(built):
    for fact, source, key in (("fact_interaction", "ods_interaction", "interaction_id"), ("fact_csat_survey", "ods_survey_response", "survey_id"),
                              ("fact_qa_evaluation", "ods_qa_evaluation", "qa_form_id"), ("fact_ticket", "ods_ticket_acid", "ticket_id")):
        assert built[fact].count() == built[source].count() == built[fact].select(key).distinct().count()


def test_upsert_keeps_the_last_load(built):
    rows = {r["client_id"]: (r["status"], r["industry"]) for r in built["ods_client_acid"].collect()}
    assert rows[0] == ("CHANGED", "TECH") and rows[1] == ("ACTIVE", "RETAIL")


def test_rollup_levels_add_up(built):
    a = built["agg_program_monthly"]
    totals = {r["grouping_level"]: (r["n"], r["b"]) for r in a.groupBy("grouping_level").agg(F.sum("interactions").alias("n"), F.sum("billed_amount").alias("b")).collect()}
    assert set(totals) == {0, 1, 3, 7} and len(set(totals.values())) == 1


def test_two_place_ratios_round_halves_up_exactly(spark):
    rows = [(469, 200), (1, 3), (-1, 2), (-5, 1000), (5, 1000), (1, 0), (0, 7), (None, 3), (2**52, 1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, n bigint, d bigint")
    got = [r["x"] for r in df.select("i", X.ratio2(F.col("n"), F.col("d"), "decimal(8,2)").alias("x")).orderBy("i").collect()]
    assert got == [Decimal("2.35"), Decimal("0.33"), Decimal("-0.50"), Decimal("0.00"), Decimal("0.01"), None, Decimal("0.00"), None, None]


def test_a_build_takes_what_the_source_holds(spark):
    held = {"ods_queue": spark.createDataFrame([(1, "Q1", "n", 2, "VOICE", 3, None, dt.date(2024, 1, 1))], schemas.ntz_schema("ods_queue"))}
    made = M.Builds(held.__getitem__, held=set(held))
    assert [r["queue_sk"] for r in made["dim_queue"].collect()] == [1]


def test_builds_of_empty_tables(spark):
    """Every target builds from empty staging tables."""
    made = M.Builds(lambda name: spark.createDataFrame([], schemas.ntz_schema(name)), held={n for n in schemas.COLUMNS if n.startswith("stg_") or n in ("ods_agent_scd2", "ods_timesheet")})
    for t in ("fact_interaction", "fact_ticket", "agg_agent_weekly", "agg_program_monthly", "dim_org", "dim_site"):
        assert made[t].collect() == []
