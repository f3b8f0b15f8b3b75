"""Layer transforms: merge idempotence, SCD-2 non-overlap, upsert, parsing."""
import datetime as dt

from pyspark.sql import functions as F

from switchboard.operators import transforms as T


def test_scd2_versions_do_not_overlap(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, "A", t0 + dt.timedelta(days=i), i) for i in range(6)]
    rows[2] = (1, "B", rows[2][2], 2)
    rows[3] = (1, "B", rows[3][2], 3)
    df = spark.createDataFrame(rows, "k long, attr string, ts timestamp_ntz, tb long")
    v = sorted(T.scd2_build(df, "k", ["attr"], "ts", "tb").collect(), key=lambda r: r["eff_from_ts"])
    assert [r["attr"] for r in v] == ["A", "B", "A"]
    assert [r["is_current"] for r in v] == [False, False, True]
    assert all(a["eff_to_ts"] == b["eff_from_ts"] for a, b in zip(v, v[1:]))


def test_upsert_batch_wins_and_keeps_both_sides(spark):
    cur = spark.createDataFrame([(1, "old"), (2, "old")], "id long, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new")], "id long, v string")
    assert sorted(map(tuple, T.current_state_upsert(cur, new, ["id"]).collect())) == [(1, "old"), (2, "new"), (3, "new")]


def test_oracle_string_to_ts_rejects_bad_text(spark):
    df = spark.createDataFrame([("20240102030405",), ("20241340120000",), ("BAD",), (None,)], "s string")
    got = [r["t"] for r in df.select(T.oracle_string_to_ts("s").alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None, None]


def test_keyword_counts_whole_texts(spark):
    df = spark.createDataFrame([(1, "The cat the"), (2, "the dog")], "doc_id long, text string")
    got = {r["keyword"]: (r["occurrences"], r["documents"]) for r in T.keyword_counts(df).collect()}
    assert got == {"the": (3, 2), "cat": (1, 1), "dog": (1, 1)}


def test_chat_metrics_from_message_array(spark):
    df = spark.createDataFrame(
        [("c1", "C", 1000, 9000, [("customer", 1000, "hi"), ("agent", 4500, "hello"), ("agent", 6000, "x")])],
        "chat_ref string, client_code string, started_ms long, ended_ms long, "
        "messages array<struct<sender:string, ts_ms:long, text:string>>")
    r = T.chat_session_metrics(df).first()
    assert (r["message_count"], r["agent_message_count"], r["customer_message_count"], r["first_response_seconds"]) == (3, 2, 1, 3)
