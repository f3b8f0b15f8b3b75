"""View semantics on hand-made rows: the traps of SURVEY 0 and 1.4."""
import datetime as dt

from pyspark.sql import functions as F

from switchboard.plans import views as V

T0 = dt.datetime(2024, 1, 1)


def ts(h):
    return T0 + dt.timedelta(hours=h)


def test_repeat_contact_window_drops_null_and_empty_and_flags_72h(spark):
    rows = [("a", "c1", "VOICE", ts(0)), ("b", "c1", "CHAT", ts(72)), ("c", "c1", "CHAT", ts(144.01)),
            ("d", None, "VOICE", ts(1)), ("e", "", "VOICE", ts(2))]
    df = spark.createDataFrame(rows, "interaction_id string, customer_ref string, channel string, start_ts timestamp_ntz")
    out = {r["interaction_id"]: r for r in V.repeat_contact_window(df).collect()}
    assert set(out) == {"a", "b", "c"}
    assert out["a"]["repeat_within_72h"] == 0 and out["a"]["prev_contact_ts"] is None
    assert out["b"]["repeat_within_72h"] == 1          # exactly 259200 s
    assert out["c"]["repeat_within_72h"] == 0


def test_billing_reconciliation_status_order(spark):
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds())
    stg = spark.createDataFrame([(1, "I1", base * 1000 + 1500, 10.00), (2, "I2", base * 1000 + 400, 10.00),
                                 (3, "I3", base * 1000, 10.00)],
                                "invoice_id long, invoice_no string, issued_ts_sec long, total_amount double") \
        .withColumn("total_amount", F.col("total_amount").cast("decimal(14,2)"))
    ods = spark.createDataFrame([(1, T0, 10.00), (2, T0, 10.00), (3, T0, 10.02)],
                                "invoice_id long, issued_ts timestamp_ntz, total_amount double") \
        .withColumn("total_amount", F.col("total_amount").cast("decimal(14,2)"))
    out = {r["invoice_no"]: r for r in V.billing_reconciliation(stg, ods).collect()}
    assert out["I1"]["recon_status"] == "TS_MISMATCH" and out["I1"]["drift_seconds"] == -2   # 1.5 s rounds to 2
    assert out["I2"]["recon_status"] == "OK"
    assert out["I3"]["recon_status"] == "AMOUNT_MISMATCH"


def test_org_hierarchy_caps_depth_and_drops_orphans(spark):
    rows = [(1, None, "r")] + [(i, i - 1, f"u{i}") for i in range(2, 10)] + [(50, 999, "orphan")]
    df = spark.createDataFrame(rows, "org_unit_id long, parent_unit_id long, unit_name string") \
        .withColumn("unit_code", F.col("unit_name")).withColumn("unit_type", F.lit("T")).withColumn("site_code", F.lit("S"))
    out = V.org_hierarchy(df).collect()
    assert max(r["depth"] for r in out) == 6 and len(out) == 7
    assert all(r["root_unit_id"] == 1 for r in out)
    assert [r["path_names"] for r in out if r["depth"] == 2] == ["r > u2 > u3"]


def test_first_contact_resolution_counts_join_rows(spark):
    rows = [("i1", 1, 1, "c", ts(0), ts(1), True, 20240101), ("i2", 1, 1, "c", ts(2), ts(3), True, 20240101),
            ("i3", 1, 1, "c", ts(4), ts(5), False, 20240101), ("i4", 1, 2, "d", ts(0), ts(1), True, 20240101),
            ("i5", 1, 2, "d", ts(200), ts(201), True, 20240101)]
    df = spark.createDataFrame(rows, "interaction_id string, agent_sk long, program_sk long, customer_ref string, "
                                     "start_ts timestamp_ntz, end_ts timestamp_ntz, resolved_flag boolean, date_key long")
    got = sorted(tuple(r) for r in V.first_contact_resolution(df).collect())
    ref = sorted(tuple(r) for r in V.first_contact_resolution_join(df).collect())
    assert got == ref
    # program 1: i1 matches i2, i3 (2 rows); i2 matches i3 (1 row) -> 3 rows, none without repeat
    assert got[0][2:4] == (3, 0)


def test_program_margin_on_true_keeps_rows_when_right_empty(spark):
    b = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 1, 10.0, 8.0)],
                              "period_month date, client_sk long, program_sk long, billed_amount double, net_revenue double")
    ts_ = spark.createDataFrame([(1, dt.date(2024, 1, 1), 120)], "program_id long, work_month date, billable_minutes long")
    adj = spark.createDataFrame([], "period_month date, amount decimal(12,2)")
    cl = spark.createDataFrame([], "contract_id long, min_commit decimal(12,2)")
    out = V.program_margin(b, ts_, adj, cl).collect()
    assert len(out) == 1 and out[0]["committed_min"] is None and abs(out[0]["est_labor_cost"] - 37.0) < 1e-9
    cl2 = spark.createDataFrame([(1, 5.0), (2, 6.0)], "contract_id long, min_commit double") \
        .withColumn("min_commit", F.col("min_commit").cast("decimal(12,2)"))
    assert len(V.program_margin(b, ts_, adj, cl2).collect()) == 2


def test_agent_roster_latest_row_ties_go_to_larger_history_id(spark):
    h = spark.createDataFrame([("h1", 7, "E7", 1, "G1", "FULL", "A", T0), ("h2", 7, "E7", 2, "G2", "FULL", "A", T0),
                               ("h0", 7, "E7", 3, "G3", "FULL", "A", ts(-5))],
                              "agent_history_id string, agent_id long, employee_no string, org_unit_id long, "
                              "job_grade string, employment_type string, status string, eff_from_ts timestamp_ntz")
    a = spark.createDataFrame([(7, 10, 20, "R", True), (7, 11, 21, "R2", True), (7, 12, 22, "X", False)],
                              "agent_id long, program_id long, queue_id long, role_on_program string, is_current boolean")
    out = V.agent_roster_current(h, a).collect()
    assert len(out) == 2 and {r["org_unit_id"] for r in out} == {2}


def test_call_driver_first_match_wins(spark):
    c = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 10, d) for d in ("D1", "D2", "D3", "D4", "D5")],
                              "call_date date, queue_id long, talk_seconds long, disposition_code string")
    d = spark.createDataFrame([("D1", "Refund on login ref#12"), ("D2", "[ABCD] cancel"), ("D3", "[AB] note"),
                               ("D4", None), ("D5", "[abc] x")], "disposition_code string, disposition_desc string")
    out = {(r["call_driver"], r["embedded_ref_no"]) for r in V.call_driver_regex(c, d).collect()}
    assert out == {("BILLING", "12"), ("RETENTION", None), ("AB", None), ("OTHER", None)}


def test_shrinkage_weighted_sums_equal_literal_fanout(spark):
    f = spark.createDataFrame([(1, 20240101, 60, 55, 5, 1), (1, 20240101, 30, 20, 2, 0), (2, 20240101, 10, 10, 0, 0),
                               (3, 20240102, 40, 40, 1, 1), (None, 20240102, 7, 7, 7, 7)],
                              "agent_sk long, date_key long, scheduled_minutes long, worked_minutes long, "
                              "exception_minutes long, timeoff_minutes long")
    a = spark.createDataFrame([(1, 11, "S1"), (2, 12, "S1"), (3, 13, "S2")], "agent_sk long, agent_id long, site_code string")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    s = spark.createDataFrame([(100, 11, 1, d1), (101, 11, 2, d1), (102, 12, 1, d1), (103, 13, 3, d2), (104, 13, None, d2)],
                              "schedule_id long, agent_id long, shift_id long, sched_date date")
    sh = spark.createDataFrame([(1, 1, True), (2, 2, False), (3, 3, True), (3, 30, True)],
                               "shift_sk long, shift_id long, overnight_flag boolean")
    got = sorted(tuple(r) for r in V.shrinkage_analysis(f, a, s, sh).collect())
    exp = sorted(tuple(r) for r in V.shrinkage_analysis_literal(f, a, s, sh).collect())
    assert got == exp and len(got) == 2


def test_repeat_contact_window_matches_brute_force_on_fixture(spark):
    from switchboard.sources.warehouse import Warehouse
    wh = Warehouse.fixtures(spark, "/root/testdata/sf0.001")
    src = [r for r in wh["ods_interaction"].collect() if r["customer_ref"]]
    by_cust = {}
    for r in src:
        by_cust.setdefault(r["customer_ref"], []).append(r)
    expected = {}
    for rows in by_cust.values():
        rows.sort(key=lambda r: (r["start_ts"], r["interaction_id"]))
        for prev, cur in zip([None] + rows[:-1], rows):
            p = prev["start_ts"] if prev else None
            flag = int(p is not None and (int(cur["start_ts"].replace(tzinfo=dt.timezone.utc).timestamp() // 1)
                                          - int(p.replace(tzinfo=dt.timezone.utc).timestamp() // 1)) <= 259200)
            expected[cur["interaction_id"]] = (p, flag)
    got = {r["interaction_id"]: (r["prev_contact_ts"], r["repeat_within_72h"])
           for r in wh.run(V.repeat_contact_window).collect()}
    assert got == expected


def test_left_join_on_true_on_a_grid(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "a long")
    right = spark.createDataFrame([(10,), (20,), (20,), (None,)], "b long")
    empty = spark.createDataFrame([], "b long")
    pairs = V.left_join_on_true(left, right)
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    assert key(pairs.collect()) == key((a["a"], b["b"]) for a in left.collect() for b in right.collect())
    plan = pairs._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert key(V.left_join_on_true(left, empty).collect()) == key((a["a"], None) for a in left.collect())
    assert V.left_join_on_true(empty, right).collect() == []


def test_hierarchy_guards(spark):
    """Depth over the guard, orphans, cycles and a root without a child."""
    chain = [(i, i - 1 if i > 1 else None) for i in range(1, 11)]
    rows = chain + [(20, 99), (21, 20), (30, 31), (31, 30), (40, None), (41, 41)]
    df = spark.createDataFrame([(i, p, f"c{i}", f"n{i}", "T", "S") for i, p in rows],
                               "org_unit_id long, parent_unit_id long, unit_code string, unit_name string, unit_type string, site_code string")
    for depth in (0, 1, 2, 3, 6, 8):
        got = {r["org_unit_id"]: (r["root_unit_id"], r["depth"], r["path_names"]) for r in V.org_hierarchy(df, depth).collect()}
        want = {i: (1, i - 1, " > ".join(f"n{k}" for k in range(1, i + 1))) for i in range(1, min(10, depth + 1) + 1)} | {40: (40, 0, "n40")}
        assert got == want


def test_attrition_orders_by_nine_places(spark):
    """Two means that agree to six places fall into different bands."""
    agents = spark.createDataFrame([(i, i, f"a{i}", "S1", "ACTIVE", True) for i in range(1, 6)],
                                   "agent_sk long, agent_id long, full_name string, site_code string, status string, is_current boolean")
    days = [(5, f"{50 + (k == 0) * 0.01:.2f}") for k in range(30000)] + [(4, f"{50 + (k == 0) * 0.01:.2f}") for k in range(20000)]
    days += [(1, "10.00"), (2, "20.00"), (3, "90.00")]
    adh = spark.createDataFrame(days, "agent_sk long, p string").select("agent_sk", F.col("p").cast("decimal(5,2)").alias("adherence_pct"))
    none = spark.createDataFrame([], "agent_id long")
    weekly = spark.createDataFrame([], "agent_sk long")
    out = {r["agent_sk"]: r["adherence_90d"] for r in V.attrition_risk(adh, none, weekly, agents).collect()}
    assert out[5] < out[4] and round(out[5], 6) == round(out[4], 6)


def test_attrition_banding(spark):
    agents = spark.createDataFrame([(i, 100 + i, f"a{i}", "S1", "ACTIVE", True) for i in range(1, 11)]
                                   + [(11, 111, "term", "S1", "TERM", True), (12, 112, "old", "S1", "ACTIVE", False)],
                                   "agent_sk long, agent_id long, full_name string, site_code string, status string, "
                                   "is_current boolean")
    adh = spark.createDataFrame([(i, 20240101, float(50 + i)) for i in range(1, 13)],
                                "agent_sk long, date_key long, adherence_pct double") \
        .withColumn("adherence_pct", F.col("adherence_pct").cast("decimal(5,2)"))
    notice = spark.createDataFrame([(1, 110), (2, 110)], "attrition_event_id long, agent_id long")
    weekly = spark.createDataFrame([(1, 1, 10)], "agent_sk long, wk long, interactions_handled long")
    out = {r["agent_sk"]: (r["attrition_risk"], r["notice_events"]) for r in V.attrition_risk(adh, notice, weekly, agents).collect()}
    assert set(out) == set(range(1, 11))                       # only current ACTIVE agents
    assert [out[i][0] for i in range(1, 11)] == ["HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "LOW", "LOW", "LOW", "HIGH"]
    assert out[10][1] == 2 and out[5][1] == 0


def test_queue_sla_null_target_and_zero_answered_are_missed(spark):
    f = spark.createDataFrame([(1, 20240101, 10, 9), (2, 20240101, 0, 0), (3, 20240101, 10, 5)],
                              "queue_sk long, date_key long, answered long, answered_in_sl long")
    q = spark.createDataFrame([(1, 1, "Q1", "VOICE"), (2, 2, "Q2", "VOICE"), (3, 3, "Q3", "CHAT")],
                              "queue_sk long, queue_id long, queue_code string, media_type string")
    t = spark.createDataFrame([(1, "SL_20_80", 80.0), (2, "SL_20_80", 80.0), (3, "ASA", 10.0)],
                              "queue_id long, metric_code string, target_value double") \
        .withColumn("target_value", F.col("target_value").cast("decimal(10,4)"))
    out = {r["queue_code"]: (r["sl_pct"], r["attainment"]) for r in V.queue_sla_attainment(f, q, t).collect()}
    assert out == {"Q1": (90.0, "MET"), "Q2": (None, "MISSED"), "Q3": (50.0, "MISSED")}


def test_occupancy_null_without_handle_or_ready_time(spark):
    f = spark.createDataFrame([(20240101, 1, "AUX1", 30), (20240101, 2, "TALK", 30), (20240101, 2, "READY", 10)],
                              "date_key long, agent_sk long, state_code string, state_seconds long")
    a = spark.createDataFrame([(1, "S1"), (2, "S1")], "agent_sk long, site_code string")
    out = {r["agent_sk"]: (r["aux_seconds"], r["occupancy_pct"]) for r in V.occupancy_utilization(f, a).collect()}
    assert out == {1: (30, None), 2: (0, 75.0)}
