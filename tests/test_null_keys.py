"""NULL keys, deleted partitions and versions: cases the fixture tables do not hold."""
import tempfile

from pyspark.sql import functions as F

from switchboard.operators import tables as TB
from switchboard.operators import transforms as T


def test_reconcile_keeps_equal_null_keys_together(spark):
    s = spark.createDataFrame([(None, 2), (None, 3), (1, 1)], "k int, v int")
    got = {r["k"]: r["recon_status"] for r in TB.layer_reconcile(s, s, ["k"], "v").collect()}
    assert got == {None: "OK", 1: "OK"}
    lost = TB.layer_reconcile(s, s.where("k = 1"), ["k"], "v").where("k is null").first()
    assert lost["recon_status"] == "MISSING_IN_ODS" and lost["staged_rows"] == 2


def test_adherence_null_agent_is_one_row(spark):
    m = spark.createDataFrame([(None, 20240101, 60), (5, 20240101, 30)], "agent_sk bigint, date_key bigint, minutes bigint")
    rows = T.adherence_daily(m, m, m, m).collect()
    assert len(rows) == 2 and all(r["scheduled_minutes"] == r["timeoff_minutes"] > 0 for r in rows)


def test_site_daily_null_site_keeps_service_level(spark):
    agents = spark.createDataFrame([(1, 20240101, 4, 40, 90.0)], "agent_sk bigint, date_key bigint, interactions_handled bigint, handle_seconds_total bigint, adherence_pct double")
    dim = spark.createDataFrame([(1, None)], "agent_sk bigint, site_code string")
    q = spark.createDataFrame([(7, 20240101, 8, 10)], "queue_sk bigint, date_key bigint, answered_in_sl bigint, answered bigint")
    site = spark.createDataFrame([(7, None)], "queue_sk bigint, site_code string")
    assert T.site_daily(agents, dim, q, site).first()["sl_pct"] == 80.0


def test_sessions_with_null_keys_stay(spark):
    e = spark.createDataFrame([("s", "c", 1000, 1, "m", "1"), (None, "c", 2000, 1, "m", "2"), (None, None, 3000, 1, "m", "0")],
                              "session_ref string, client_code string, event_ms bigint, event_seq bigint, menu_path string, key_pressed string")
    assert T.ivr_sessionize(e).count() == 3


def test_lookup_takes_the_current_version(spark):
    dim = spark.createDataFrame([(1, "a", False), (2, "a", True), (3, "b", None)], "sk bigint, nk string, is_current boolean")
    fact = spark.createDataFrame([("a",), ("b",), ("z",)], "k string")
    got = {r["k"]: r["sk"] for r in T.lookup_sk(fact, dim, "k", "nk", "sk").collect()}
    assert got == {"a": 2, "b": 3, "z": T.UNKNOWN_SK}


def test_refresh_drops_what_the_base_lost(spark):
    path = tempfile.mkdtemp() + "/mv"
    view = spark.createDataFrame([(20240101, 1), (20250101, 2)], "date_key int, n int")
    TB.refresh_materialized(view, path, "date_key")
    kept = view.where("n = 1")
    TB.refresh_materialized(kept, path, "date_key", touched=view.where("n = 2").select("date_key"))
    assert spark.read.parquet(path).count() == 1
    TB.refresh_materialized(view, path, "date_key")
    TB.refresh_materialized(kept, path, "date_key")
    assert [r["n"] for r in spark.read.parquet(path).select(F.col("n")).collect()] == [1]
