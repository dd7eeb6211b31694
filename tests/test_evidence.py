"""Status, dossiers, samples and accuracy figures."""

import json
import math

import pytest
from pyspark.sql import functions as F

from selvatrace.operators import evidence

MOVES = "src bigint, dst bigint, d string, qty decimal(18,4)"


def small_dossier(spark, page_rows, rows_per_chunk):
    status = spark.createDataFrame([(1, "signal"), (2, "no_signal"), (3, "signal")], "plot_id bigint, status string")
    alerts = spark.range(100).select(
        F.col("id").alias("alert_id"),
        F.when(F.col("id") < 95, 1).otherwise(3).cast("bigint").alias("plot_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 40000).alias("ts"),
        F.lit("fire").alias("source"),
        F.lit(1).cast("decimal(18,4)").alias("area_ha"),
    )
    moves = spark.createDataFrame([], MOVES).withColumn("moved_on", F.to_date("d"))
    return evidence.dossier(status, alerts, moves, page_rows, rows_per_chunk).collect()


@pytest.mark.parametrize("page_rows,rows_per_chunk", [(10, 7), (10, 10**6), (1000, 40)])
def test_dossier_pages_hold_every_entry_once(spark, page_rows, rows_per_chunk):
    rows = small_dossier(spark, page_rows, rows_per_chunk)
    by_plot = {}
    for r in sorted(rows, key=lambda r: (r.plot_id, r.page)):
        document = json.loads(r.document)
        assert document["page"] == r.page and len(document["entries"]) <= page_rows
        by_plot.setdefault(r.plot_id, []).extend(e["ref"] for e in document["entries"])
    assert by_plot == {1: list(range(95)), 2: [], 3: list(range(95, 100))}
    pages = sorted(r.page for r in rows if r.plot_id == 1)
    assert pages == list(range(1, math.ceil(95 / page_rows) + 1))


def test_technical_status(spark):
    plots = spark.createDataFrame([(i,) for i in range(1, 5)], "plot_id bigint")
    obs = spark.createDataFrame([(1,), (2,), (3,)], "plot_id bigint")
    loss = spark.createDataFrame([(1, 5.0), (2, 4.9), (4, 9.0)], "plot_id bigint, a double").select(
        "plot_id", F.col("a").cast("decimal(18,4)").alias("area_after")
    )
    alerts = spark.createDataFrame([(3,), (3,), (4,)], "plot_id bigint")
    got = {r.plot_id: r.status for r in evidence.technical_status(plots, obs, loss, alerts, 5.0).collect()}
    assert got == {1: "signal", 2: "no_signal", 3: "signal", 4: "insufficient_data"}


def test_review_sample_repeats(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("stratum"))
    first = evidence.review_sample(df, "id", ["stratum"], 7, "s").select("id").collect()
    again = evidence.review_sample(df.repartition(9), "id", ["stratum"], 7, "s").select("id").collect()
    other = evidence.review_sample(df, "id", ["stratum"], 7, "t").select("id").collect()
    assert len(first) == 21 and sorted(first) == sorted(again) and sorted(first) != sorted(other)


def test_accuracy_by_hand(spark):
    counts = {("f", "f"): 8, ("f", "d"): 2, ("d", "d"): 5, ("d", "f"): 5, ("x", "f"): 4}
    rows = [k for k, n in counts.items() for _ in range(n)]
    checked = spark.createDataFrame(rows, "mapped string, truth string")
    areas = spark.createDataFrame([("f", 60.0), ("d", 30.0), ("x", 10.0)], "mapped string, area double")
    got = {r.cls: r for r in evidence.accuracy_report(checked, areas).collect()}
    w, n = {"f": 0.6, "d": 0.3, "x": 0.1}, {"f": 10, "d": 10, "x": 4}
    for c in "fdx":
        share = {m: counts.get((m, c), 0) / n[m] for m in w}
        p = sum(w[m] * share[m] for m in w)
        var = sum(w[m] ** 2 * share[m] * (1 - share[m]) / (n[m] - 1) for m in w)
        assert got[c].users_accuracy == pytest.approx(share[c])
        assert got[c].area_estimate == pytest.approx(100 * p)
        assert got[c].area_std_error == pytest.approx(100 * math.sqrt(var))
        if p:
            assert got[c].producers_accuracy == pytest.approx(w[c] * share[c] / p)
        else:
            assert got[c].producers_accuracy is None


def test_unsampled_class_is_told(spark):
    checked = spark.createDataFrame([(1, 1)] * 3 + [(2, 2)] * 3, "mapped int, truth int")
    areas = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 80.0)], "mapped int, area double")
    got = {r.cls: (r.unsampled, r.area_estimate) for r in evidence.accuracy_report(checked, areas).collect()}
    assert got == {1: (False, 10.0), 2: (False, 10.0), 3: (True, None)}
