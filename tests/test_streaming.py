"""Streams over several batches: late rows, repeats, upserts, restarts."""

import random

import pytest
from pyspark.sql import functions as F

from selvatrace.operators.alerts import confirm_alerts
from selvatrace.session import scratch_path
from selvatrace.streaming import alerts as live
from selvatrace.streaming.sink import _folders, compact, drain, finish, read_upserts, stream_sink

T0 = 1_704_067_200  # 2024-01-01
HOUR = 3600
SCHEMA = "alert_id bigint, plot_id bigint, ts timestamp, source string, area_ha decimal(18,4)"


def put(spark, folder, rows):
    """One more file, and so one more batch."""
    df = spark.createDataFrame([(i, p, T0 + s, src) for i, p, s, src in rows], "alert_id bigint, plot_id bigint, s bigint, source string")
    df.select(
        "alert_id", "plot_id", F.timestamp_seconds("s").alias("ts"), "source", F.lit(1).cast("decimal(18,4)").alias("area_ha")
    ).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "alerts")


def test_late_rows_count_within_the_delay_only(spark, folder):
    put(spark, folder, [(1, 1, 0, "a"), (2, 1, 10 * HOUR, "a")])
    put(spark, folder, [(3, 1, 9 * HOUR, "a"), (4, 1, 30 * HOUR, "a")])  # 3 is late but within two hours
    put(spark, folder, [(5, 1, 1 * HOUR, "a"), (6, 1, 50 * HOUR, "a")])  # 5 is far too late
    out = drain(live.stream_tumbling(stream(spark, folder), "1 hour", "2 hours"), "late").collect()
    hours = {int((r.win_start.timestamp() - T0) // HOUR): r.n_alerts for r in out}
    assert hours == {0: 1, 9: 1, 10: 1, 30: 1}


def test_sliding_windows_overlap(spark, folder):
    put(spark, folder, [(1, 1, 90 * 60, "a"), (2, 1, 48 * HOUR, "a")])
    out = drain(live.stream_sliding(stream(spark, folder), "2 hours", "1 hour", "1 hour"), "slide").collect()
    assert sorted(int((r.win_start.timestamp() - T0) // HOUR) for r in out) == [0, 1]


def test_incidents_span_batches(spark, folder):
    put(spark, folder, [(1, 1, 0, "a"), (2, 2, 0, "a")])
    put(spark, folder, [(3, 1, HOUR, "a"), (4, 2, 5 * HOUR, "a")])
    put(spark, folder, [(5, 9, 90 * HOUR, "a")])
    out = drain(live.stream_incidents(stream(spark, folder), "2 hours", "10 hours"), "inc").collect()
    assert sorted((r.plot_id, r.n_alerts) for r in out) == [(1, 2), (2, 1), (2, 1)]


def test_dedup_over_batches(spark, folder):
    put(spark, folder, [(1, 1, 0, "a"), (1, 1, 0, "a"), (2, 1, HOUR, "a")])
    put(spark, folder, [(1, 1, 0, "a"), (3, 1, 2 * HOUR, "a")])
    out = drain(live.stream_dedup(stream(spark, folder), ["alert_id"], "5 hours"), "dedup").collect()
    assert sorted(r.alert_id for r in out) == [1, 2, 3]


@pytest.mark.parametrize("salts", [1, 5])
def test_enrich_keeps_unknown_plots(spark, folder, salts):
    put(spark, folder, [(1, 1, 0, "a"), (2, 7, 0, "a")])
    facts = spark.createDataFrame([(1, "north")], "plot_id bigint, admin1 string")
    out = drain(live.stream_enrich(stream(spark, folder), facts, salts), "enrich").collect()
    assert sorted((r.alert_id, r.plot_id, r.admin1) for r in out) == [(1, 1, "north"), (2, 7, None)]


@pytest.mark.parametrize("salts", [1, 3])
def test_confirm_across_batches(spark, folder, salts):
    put(spark, folder, [(1, 1, 0, "a"), (2, 1, 20 * HOUR, "a"), (3, 2, 0, "a")])
    put(spark, folder, [(4, 1, 2 * HOUR, "b"), (5, 1, 2 * HOUR, "b"), (6, 2, 3 * HOUR, "b")])
    s = stream(spark, folder)
    out = drain(
        live.stream_confirm(s.filter("source = 'a'"), s.filter("source = 'b'"), "2 HOURS", "48 hours", salts), "confirm"
    ).collect()
    assert [r.alert_id for r in out] == [1]


def test_confirm_closed_equals_batch_and_keeps_spans_only(spark, folder):
    rng = random.Random(4)
    day = lambda d, n, src: [(1000 * d + n * 7 + i, rng.randrange(4), 24 * HOUR * d + rng.randrange(24 * HOUR), src) for i in range(n)]
    for d in range(4):
        put(spark, folder, day(d, 40, "a") + [(i + 5_000_000, *r[1:]) for i, r in enumerate(day(d, 30, "b"))])
    put(spark, folder, [(1, 9, 24 * HOUR * 9, "a"), (2, 9, 24 * HOUR * 9, "b")])  # closes all before
    put(spark, folder, [(6_000_000 + i, 8, 24 * HOUR * 9 + i % 2, "b") for i in range(500)])  # one plot, one span
    s = stream(spark, folder)
    live_rows = live.stream_confirm_closed(s.filter("source = 'a'"), s.filter("source = 'b'"), 2 * HOUR, "26 hours")
    out, steps = scratch_path(spark, "closed"), scratch_path(spark, "closed-progress")
    query = live_rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", steps).trigger(availableNow=True).start()
    finish(query, 300)
    state = {op["operatorName"]: op["numRowsTotal"] for op in query.lastProgress["stateOperators"]}
    assert state["stateStoreSave"] == 2  # the spans still open, of 501 rows
    whole = spark.read.schema(SCHEMA).parquet(folder)
    want = confirm_alerts(whole.filter("source = 'a'"), whole.filter("source = 'b'"), 2 * HOUR).collect()
    got = [r.alert_id for r in spark.read.schema(live_rows.schema).parquet(out).collect()]
    assert sorted(got) == sorted(r.alert_id for r in want if r.plot_id != 9) and len(got) > 20


def test_status_is_upserted_and_restarts_continue(spark, folder):
    out = scratch_path(spark, "status")
    status = live.stream_status(_after(spark, folder, [(1, 1, 0, "a"), (2, 2, 0, "a")]), 2.0)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in status.schema)
    finish(stream_sink(status, out), 120)
    put(spark, folder, [(3, 1, HOUR, "b")])
    finish(stream_sink(status, out), 120)  # takes up where the first run stopped
    got = {r.plot_id: (r.n_alerts, r.last_source, r.status) for r in read_upserts(spark, out, ["plot_id"], schema).collect()}
    assert got == {1: (2, "b", "active"), 2: (1, "a", "watch")}
    again = spark.read.parquet(f"{out}/batch_id=0")
    again_rows = again.collect()
    spark.createDataFrame(again_rows, again.schema).write.mode("overwrite").parquet(f"{out}/batch_id=0")  # a batch run twice
    repeat = {r.plot_id: r.n_alerts for r in read_upserts(spark, out, ["plot_id"], schema).collect()}
    assert repeat == {1: 2, 2: 1}


def test_compaction_bounds_folders_and_survives_crashes(spark):
    out, schema = scratch_path(spark, "many"), "k bigint, v bigint"
    batch = lambda i: spark.createDataFrame([(i % 7, i), (100 + i, i)], schema).coalesce(1).write.mode("overwrite").parquet(f"{out}/batch_id={i}")
    told = lambda: {r.k: r.v for r in read_upserts(spark, out, ["k"], schema).collect()}
    want = {}
    for i in range(12):
        batch(i)
        want |= {i % 7: i, 100 + i: i}
    assert told() == want
    # A draft that was never renamed does not count, nor do folders that a merged one has replaced.
    spark.createDataFrame([(0, 999)], schema).withColumn("batch_id", F.lit(10).cast("bigint")).write.parquet(f"{out}/_drafts/torn")
    assert told() == want and compact(spark, out, ["k"], schema) == 2
    assert told() == want and _folders(spark, out, "batch_id=") == [11]
    batch(3)  # as if it had not been deleted
    batch(11)  # the newest batch runs again
    for i in range(12, 15):
        batch(i)
        want |= {i % 7: i, 100 + i: i}
    assert told() == want and compact(spark, out, ["k"], schema) == 2 and told() == want
    assert _folders(spark, f"{out}/_merged", "upto=") == [13] and _folders(spark, out, "batch_id=") == [14]
    assert compact(spark, out, ["k"], schema) == 2 and told() == want


def _after(spark, folder, rows):
    put(spark, folder, rows)
    return stream(spark, folder)


def test_finish_raises_what_stopped_the_stream(spark, folder):
    put(spark, folder, [(1, 1, 0, "a")])
    broken = stream(spark, folder).select(F.raise_error(F.lit("no good")).cast("string").alias("x"))
    with pytest.raises(Exception, match="no good"):
        drain(broken, "broken", 120)
