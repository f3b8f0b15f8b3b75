"""Change log: latest change wins, tombstones stay, compaction, replays, and the eight merged targets."""
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from switchboard.operators import changelog as C
from switchboard.operators.tables import scratch_path
from switchboard.plans import change_jobs
from switchboard.sources import schemas

D = dt.date(2024, 1, 1)
SCHEMA = "id long, a string, op string, change_ms long, extract_ts date"


def feed(spark, rows):
    return spark.createDataFrame([(i, a, op, ms, D + dt.timedelta(days=x)) for i, a, op, ms, x in rows], SCHEMA)


def brute(rows):
    """{id: a} by sorting."""
    out = {}
    for r in sorted(rows, key=lambda r: (r[3], r[4], C.OP_RANK[r[2]], r[1] is not None, r[1] or "")):
        out[r[0]] = None if r[2] == "D" else (r[1],)
    return {k: v[0] for k, v in out.items() if v}


def now(df):
    return {r["id"]: r["a"] for r in df.collect()}


def test_latest_wins_and_deletes_drop(spark):
    rows = [(1, "x", "I", 10, 0), (1, "y", "U", 20, 0), (2, "p", "I", 10, 0), (2, None, "D", 30, 0), (3, "q", "U", 5, 0), (3, "r", "D", 5, 0), (None, "n", "I", 1, 0)]
    assert now(C.current(C.merge(None, feed(spark, rows), ["id"], ["a"]), ["id"], ["a"])) == {1: "y", None: "n"}


def test_merge_is_idempotent(spark):
    ch = feed(spark, [(1, "x", "I", 10, 0), (2, "y", "U", 20, 0), (2, "y", "D", 20, 0)])
    once = C.merge(None, ch, ["id"], ["a"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, C.merge(once, ch, ["id"], ["a"]).collect()))


def test_a_late_update_does_not_bring_a_row_back(spark):
    log = C.ChangeLog(spark, scratch_path(spark, "late"), ["id"], ["a"])
    assert log.state() is None and log.current() is None
    log.append(feed(spark, [(1, "x", "I", 1000, 0), (1, None, "D", 5000, 0), (2, "k", "I", 1000, 0)]), 0)
    log.append(feed(spark, [(1, "late", "U", 4000, 1), (2, "later", "U", 4000, 1)]), 1)
    assert now(log.current()) == {2: "later"}
    log.append(feed(spark, [(1, "new", "I", 6000, 2)]), 2)
    assert now(log.current()) == {1: "new", 2: "later"}


def test_replay_counts_once_and_increments_are_independent_files(spark):
    log = C.ChangeLog(spark, scratch_path(spark, "replay"), ["id"], ["a"])
    log.append(feed(spark, [(1, "x", "I", 1, 0)]), 0)
    log.append(feed(spark, [(1, "wrong", "U", 9, 0)]), 1)
    log.append(feed(spark, [(1, "right", "U", 2, 0)]), 1)
    assert now(log.current()) == {1: "right"}


def test_compaction_keeps_young_tombstones_and_refuses_older_changes(spark):
    log = C.ChangeLog(spark, scratch_path(spark, "compact"), ["id"], ["a"])
    log.append(feed(spark, [(1, "x", "D", 100, 0), (2, "y", "D", 900, 0), (3, "z", "I", 100, 0)]), 0)
    log.append(feed(spark, [(4, "w", "I", 300, 0)]), 1)
    log.compact(500)
    assert {r["id"]: r["op"] for r in log.state().collect()} == {2: "D", 3: "I", 4: "I"}
    assert len(log._parts()[0]) == 1
    log.append(feed(spark, [(1, "late", "U", 50, 1), (2, "late", "U", 800, 1), (3, "late", "U", 499, 1), (4, "now", "U", 500, 1)]), 2)
    assert now(log.current()) == {3: "z", 4: "now"}
    log.compact(100)  # a watermark is never lowered
    assert log._parts()[2] == 500 and now(log.current()) == {3: "z", 4: "now"}
    assert {r["id"]: r["op"] for r in log.state().collect()} == {2: "D", 3: "I", 4: "U"}


def test_an_unfinished_increment_is_not_read(spark):
    path = scratch_path(spark, "unfinished")
    log = C.ChangeLog(spark, path, ["id"], ["a"])
    log.append(feed(spark, [(1, "x", "I", 1, 0)]), 0)
    log.append(feed(spark, [(1, "y", "U", 2, 0)]), 1)
    fs, p = log._fs(f"{path}/increment-{1:012d}/_SUCCESS")
    fs.delete(p, False)
    assert now(log.current()) == {1: "x"}


ROWS = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b"]), st.sampled_from("IUD"), st.integers(0, 5), st.integers(0, 2)), min_size=1, max_size=25)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, cut=st.integers(0, 25))
def test_any_split_into_increments_gives_the_same(spark, rows, cut):
    state = None
    for part in (rows[:cut], rows[cut:]):
        state = C.merge(state, feed(spark, part), ["id"], ["a"])
    assert now(C.current(state, ["id"], ["a"])) == brute(rows)


@pytest.mark.parametrize("table", change_jobs.TARGETS_AND_CARDS)
def test_targets_have_their_declared_columns(spark, table):
    got = change_jobs.CHANGE_JOBS[f"{table}_merge"](spark, "/root/testdata/sf0.001")
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schemas.ntz_schema(table)]
    assert got.count() > 0
