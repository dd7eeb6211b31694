"""Alert operators at the edges of time, and against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from selvatrace.operators import alerts as al
from selvatrace.operators.forest import annual_series, focal_stats, transition_matrix
from selvatrace.plans import grid

T0 = 1_700_000_000


def alerts_of(spark, rows):
    rows = [(i, p, round(sec * 1_000_000), source, area) for i, p, sec, source, area in rows]
    df = spark.createDataFrame(rows, "alert_id bigint, plot_id bigint, micros bigint, source string, area double")
    return df.select(
        "alert_id", "plot_id", F.timestamp_micros("micros").alias("ts"), "source",
        F.col("area").cast("decimal(18,4)").alias("area_ha"),
    )


def test_incident_gap_may_be_exactly_reached(spark):
    gap, micro = 3600, 0.000001
    rows = [
        (1, 1, T0, "a", 1.0),
        (2, 1, T0 + gap - micro, "a", 1.0),  # just under: same incident
        (3, 1, T0 + 2 * gap - micro, "a", 1.0),  # exactly the gap: still the same
        (4, 1, T0 + 3 * gap, "a", 1.0),  # just over: a new one
        (5, 1, T0 + 9 * gap, "a", 1.0),
        (6, 2, T0, "a", 1.0),
    ]
    got = al.incidents(alerts_of(spark, rows), gap).collect()
    assert sorted((r.plot_id, r.incident_no, r.n_alerts) for r in got) == [(1, 1, 3), (1, 2, 1), (1, 3, 1), (2, 1, 1)]


@pytest.mark.parametrize("gap", [7, 60, 1000])
def test_incidents_equal_session_windows(spark, gap):
    rng = random.Random(gap)
    rows = [(i, 1 if i % 3 == 0 else rng.randrange(5), T0 + rng.randrange(20000), "a", 1.0) for i in range(600)]
    df = alerts_of(spark, rows)
    ours = al.incidents(df, gap).select("plot_id", "started", "n_alerts")
    plain = df.groupBy("plot_id", F.session_window("ts", f"{gap} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n_alerts"))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.select("plot_id", "w.start", "n_alerts").collect()))


def test_asof_edges(spark):
    alerts = alerts_of(spark, [(1, 1, T0, "x", 1.0), (2, 1, T0 + 10, "x", 1.0), (3, 2, T0, "x", 1.0), (4, 3, T0 - 5, "x", 1.0)])
    states = spark.createDataFrame(
        [(1, T0, 7, "same time"), (1, T0, 8, "tied, larger id"), (2, T0, 9, None), (3, T0, 10, "too late")],
        "plot_id bigint, sec bigint, state_id bigint, v string",
    ).select("plot_id", F.timestamp_seconds("sec").alias("ts"), "state_id", "v")
    for size in (1, 2, 10**6):
        got = {r.alert_id: (r.state_id, r.state_v) for r in al.asof_state(alerts, states, ["plot_id"], size).collect()}
        assert got == {1: (8, "tied, larger id"), 2: (8, "tied, larger id"), 3: (9, None), 4: (None, None)}


@pytest.mark.parametrize("window", [1, 50, 5000])
def test_confirm_equals_brute_force(spark, window):
    rng = random.Random(window)
    a = [(i, rng.randrange(4), T0 + rng.randrange(30000), "a", 1.0) for i in range(300)]
    b = [(i, 1 if i % 3 == 0 else rng.randrange(4), T0 + rng.randrange(30000), "b", 1.0) for i in range(200)]
    want = {x[0] for x in a if any(x[1] == y[1] and abs(x[2] - y[2]) <= window for y in b)}
    got = [r.alert_id for r in al.confirm_alerts(alerts_of(spark, a), alerts_of(spark, b), window).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("days,crowd,chunk", [(1, 256, 10**6), (30, 256, 10**6), (4000, 256, 20), (4000, 0, 10**6), (300, 3, 5)])
def test_tenure_with_overlaps_and_open_ends(spark, days, crowd, chunk):
    rng = random.Random(days)
    day = 86400
    held = []
    for i in range(60):
        start = rng.randrange(900)
        held.append((i, rng.randrange(5), start, None if i % 7 == 0 else start + rng.choice([2, 9, 300])))
    facts = [(i, rng.randrange(6), rng.randrange(1000)) for i in range(250)]
    tenures = spark.createDataFrame(held, "holder_id bigint, plot_id bigint, a bigint, b bigint").select(
        "plot_id", "holder_id", F.timestamp_seconds(F.lit(T0) + F.col("a") * day).alias("valid_from"),
        F.timestamp_seconds(F.lit(T0) + F.col("b") * day).alias("valid_to"),
    )
    rows = spark.createDataFrame(facts, "fact bigint, plot_id bigint, d bigint").withColumn(
        "ts", F.timestamp_seconds(F.lit(T0) + F.col("d") * day)
    )
    want = []
    for f, plot, d in facts:
        holders = [h for h, p, s, e in held if p == plot and s <= d and (e is None or d < e)]
        want += [(f, h) for h in holders or [None]]
    got = [(r.fact, r.holder_id) for r in al.tenure_join(rows, tenures, "ts", days, crowd, rows_per_chunk=chunk).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_a_fact_far_ahead_makes_no_copies(spark):
    """One fact in the year 9999 among facts of 2023: neither the cover nor the rows joined to grow with it."""
    day = 86400
    held = [(i, i % 50, 10 * i, None if i % 2 else 10 * i + 5) for i in range(200)] + [(900, None, 1, None), (901, 3, None, None), (902, 4, None, 7)]
    tenures = spark.createDataFrame(held, "holder_id bigint, plot_id bigint, a bigint, b bigint").select(
        "plot_id", "holder_id", F.timestamp_seconds(F.lit(T0) + F.col("a") * day).alias("valid_from"),
        F.timestamp_seconds(F.lit(T0) + F.col("b") * day).alias("valid_to"),
    )
    days = lambda c: F.unix_micros(c).cast("double") / 86400e6
    spans, _ = grid.cover(al.closed_spans(tenures, days), ["_plot"], [("_from", "_to")], 1.0, 256, grid.FINEST)
    assert spans.count() == 100 * 6  # six days touched by each tenure with an end
    facts = [(i, i % 50, T0 + (i + 1) * day) for i in range(100)] + [(100, 7, 253_000_000_000), (101, None, T0), (102, 99, None)]
    rows = spark.createDataFrame(facts, "fact bigint, plot_id bigint, s bigint").select("fact", "plot_id", F.timestamp_seconds("s").alias("ts"))
    got = {}
    for r in al.tenure_join(rows, tenures, "ts", 1.0).collect():
        got.setdefault(r.fact, []).append(r.holder_id)
    for f, plot, s in facts:
        want = [h for h, p, a, b in held if p == plot and p is not None and a is not None and s is not None
                and T0 + a * day <= s and (b is None or s < T0 + b * day)]
        assert sorted(got[f], key=str) == sorted(want or [None], key=str)
    begun, cells = al.open_tenures(rows, tenures, "ts", None)
    assert begun.filter("fact = 100").first()._begun == sum(p == 7 and b is None for _, p, _, b in held)
    assert cells.count() == 100  # one row for each tenure without an end, whatever the facts


def test_classify_takes_the_first_band_that_fits(spark):
    df = alerts_of(spark, [(1, 1, T0, "fire", 9.0), (2, 1, T0, "cut", 9.0), (3, 1, T0, "cut", 50.0), (4, 1, T0, "cut", 1.0)])
    out = al.classify_alerts(df, [("big", 40.0, None), ("hot", 5.0, ["fire"]), ("mid", 5.0, None)], "small")
    assert {r.alert_id: r.severity for r in out.collect()} == {1: "hot", 2: "mid", 3: "big", 4: "small"}


def test_dedup_and_top_break_ties_by_id(spark):
    df = alerts_of(spark, [(3, 1, T0, "a", 5.0), (2, 1, T0, "a", 5.0), (1, 1, T0 + 1, "a", 7.0), (4, 1, T0 + 1, "b", 5.0)])
    assert sorted(r.alert_id for r in al.dedup_alerts(df, ["plot_id", "source"]).collect()) == [2, 4]
    assert sorted(r.alert_id for r in al.top_alerts(df, 2).collect()) == [1, 2]


def test_monitoring_gaps(spark):
    plots = spark.createDataFrame([(1,), (2,)], "plot_id bigint")
    df = alerts_of(spark, [(1, 1, 1704067200.0, "a", 1.0), (2, 1, 1704067201.0, "a", 1.0)])  # 2024-01-01
    gaps = al.monitoring_gaps(df, al.calendar(plots, "2024-01-01", "2024-01-02")).collect()
    assert sorted((r.plot_id, str(r.day)) for r in gaps) == [(1, "2024-01-02"), (2, "2024-01-01"), (2, "2024-01-02")]


def test_annual_series_fills_gaps(spark):
    obs = spark.createDataFrame([(1, "2000-05-01", 2.0), (1, "2000-07-01", 1.0), (1, "2003-01-01", 4.0), (2, "2001-01-01", 1.0)], "plot_id bigint, d string, a double")
    obs = obs.select("plot_id", F.to_date("d").alias("obs_date"), F.col("a").cast("decimal(18,4)").alias("area_ha"))
    got = sorted((r.plot_id, r.year, float(r.area_ha), float(r.running_ha)) for r in annual_series(obs).collect())
    assert got == [(1, 2000, 3, 3), (1, 2001, 0, 3), (1, 2002, 0, 3), (1, 2003, 4, 7), (2, 2001, 1, 1)]


def test_transitions_of_repeated_days(spark):
    rows = [(1, "2000-01-01", c) for c in "AAB"] + [(1, "2000-01-02", c) for c in "AB"] + [(2, "2000-01-01", "A")]
    obs = spark.createDataFrame(rows, "plot_id bigint, d string, cls string").withColumn("obs_date", F.to_date("d"))
    got = {(r.from_cls, r.to_cls): r.n_steps for r in transition_matrix(obs, ["plot_id"]).collect()}
    assert got == {("A", "A"): 1, ("A", "B"): 2, ("B", "A"): 1}


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_focal_equals_brute_force(spark, radius):
    rng = random.Random(radius)
    cells = [(rng.randrange(12), rng.randrange(12), rng.randrange(10)) for _ in range(80)]
    df = spark.createDataFrame(cells, "cx bigint, cy bigint, area_ha int")
    want = {}
    for x, y, _ in cells:
        near = [v for a, b, v in cells if abs(a - x) <= radius and abs(b - y) <= radius]
        want[(x, y)] = (sum(near), len(near))
    assert {(r.cx, r.cy): (r.focal_sum, r.focal_n) for r in focal_stats(df, radius).collect()} == want


def test_undated_observations_enter_no_total(spark):
    obs = spark.createDataFrame([(1, "2000-05-01", 3.0), (1, None, 5.0)], "plot_id int, d string, area_ha double").withColumn("obs_date", F.to_date("d"))
    assert [(r.year, r.area_ha, r.running_ha) for r in annual_series(obs).collect()] == [(2000, 3.0, 3.0)]


def test_alert_without_area_is_unknown(spark):
    df = spark.createDataFrame([(1, None, "fire")], "alert_id int, area_ha decimal(18,4), source string")
    assert al.classify_alerts(df, [("big", 40.0, None)], "small").first().severity == "unknown"
