"""LAG in two levels keeps every value and does not depend on size."""
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from switchboard.operators.timeline import with_previous


def test_big_integers_and_far_timestamps_keep_their_values(spark):
    far = dt.datetime(9999, 12, 31, 23, 59, 59)
    rows = [(None if i % 7 == 0 else "hot" if i % 3 else f"k{i % 5}", i, 2**53 + 2 * i + 1 if i % 11 else None, far if i % 4 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, id bigint, v bigint, ts timestamp_ntz")
    w = Window.partitionBy("k").orderBy("id")
    for value in ("v", "ts"):
        want = df.withColumn("p", F.lag(value).over(w))
        got = with_previous(df, ["k"], "id", [], value, "p", width=9)
        assert got.schema["p"].dataType == want.schema["p"].dataType
        assert {r["id"]: r["p"] for r in got.collect()} == {r["id"]: r["p"] for r in want.collect()}


def test_no_job_before_the_result_is_asked_for(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, id bigint")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lag-plan", "plan only")
    plan = with_previous(df, ["k"], "id", [], "id", "p", width=1)
    assert not tracker.getJobIdsForGroup("lag-plan")
    spark.sparkContext.setJobGroup("", "")
    assert {r["id"]: r["p"] for r in plan.collect()} == {1: None, 2: 1}
