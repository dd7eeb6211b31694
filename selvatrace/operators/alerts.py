"""Batch operators over alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from selvatrace.plans import grid
from selvatrace.plans.ordered import ROWS_PER_CHUNK, first_rows, last_seen, running_total, time_chunk


def classify_alerts(alerts: DataFrame, bands: list[tuple[str, float, list[str] | None]], otherwise: str) -> DataFrame:
    """Adds ``severity``: the first band whose area and source fit.

    A band is (label, smallest area, sources or None for any). An alert without an area is ``unknown``.
    """
    label = F.when(F.col("area_ha").isNull(), "unknown")
    for name, at_least, sources in bands:
        fits = F.col("area_ha") >= F.lit(at_least).cast("decimal(18,4)")
        if sources is not None:
            fits = fits & F.col("source").isin(sources)
        label = label.when(fits, name)
    return alerts.withColumn("severity", label.otherwise(otherwise))


def dedup_alerts(alerts: DataFrame, key: list[str]) -> DataFrame:
    """The earliest alert per key; the smaller id wins at equal times."""
    return first_rows(alerts, key, [F.col("ts"), F.col("alert_id")], 1)


def top_alerts(alerts: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest alerts per plot; the smaller id wins at equal areas."""
    return first_rows(alerts, ["plot_id"], [F.col("area_ha").desc(), F.col("alert_id")], k)


def incidents(alerts: DataFrame, gap_seconds: int) -> DataFrame:
    """Alerts of a plot merged into incidents; a pause longer than ``gap_seconds`` starts a
    new one, just as in Spark's ``session_window``.

    Two alerts inside one span of ``gap_seconds`` are always closer than the gap, so every
    span is reduced to one row before anything is sorted: a plot is left with at most one row
    per span of the record, however many alerts it has.
    """
    spans = alerts.groupBy("plot_id", time_chunk(F.col("ts"), gap_seconds).alias("_span")).agg(
        F.min("ts").alias("_from"), F.max("ts").alias("_to"), F.count(F.lit(1)).alias("_n"), F.sum("area_ha").alias("_a")
    )
    by_span = W.partitionBy("plot_id").orderBy("_span")
    pause = F.unix_micros("_from") - F.unix_micros(F.lag("_to").over(by_span))
    starts = F.when(pause <= gap_seconds * 1_000_000, 0).otherwise(1)
    numbered = spans.withColumn("_starts", starts).withColumn(
        "incident_no", F.sum("_starts").over(by_span.rowsBetween(W.unboundedPreceding, 0))
    )
    return numbered.groupBy("plot_id", "incident_no").agg(
        F.min("_from").alias("started"),
        F.max("_to").alias("ended"),
        F.sum("_n").alias("n_alerts"),
        F.sum("_a").alias("area_ha"),
    )


def asof_state(
    alerts: DataFrame, states: DataFrame, key: list[str], rows_per_chunk: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """Each alert with the latest state of its key at or before it; null where there is none.

    ``alerts`` and ``states`` both carry ``ts``; ``states`` also carries ``state_id``, which
    breaks ties. State columns come back prefixed with ``state_``. Both sides are merged into
    one ordered scan, so no alert ever meets more than one state; keys with more than
    ``rows_per_chunk`` rows are cut along time.
    """
    state_cols = [c for c in states.columns if c not in {*key, "ts", "state_id"}]
    left = alerts.select(
        *key, "ts", F.lit(1).alias("_side"), F.lit(None).cast("bigint").alias("_tie"), F.struct("*").alias("_alert")
    )
    right = states.select(
        *key,
        "ts",
        F.lit(0).alias("_side"),
        F.col("state_id").cast("bigint").alias("_tie"),
        F.struct(
            F.col("ts").alias("state_ts"), "state_id", *[F.col(c).alias(f"state_{c}") for c in state_cols]
        ).alias("_state"),
    )
    merged = left.unionByName(right, allowMissingColumns=True)
    seen = last_seen(merged, key, ["ts", "_side", "_tie"], "_state", "_seen", rows_per_chunk)
    return seen.filter(F.col("_side") == 1).select("_alert.*", "_seen.*")


def tenure_join(
    facts: DataFrame, tenures: DataFrame, ts: str, span_days: float, crowd: int = 256, levels: int = grid.FINEST,
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """Each fact with the holder of its plot at that time: ``valid_from <= ts < valid_to``.

    Facts without a holder are kept, and tenures may overlap. Tenures with an end are cut into spans of
    ``span_days`` and joined on (plot, span), so a fact meets only the tenures of its own span
    and a hot plot is spread over time; a span crowded with short tenures is cut finer. A fact
    lies in one span, so nothing is matched twice. Tenures without an end have no span to be cut into: they are
    numbered by their beginning, one ordered scan tells each fact how many of its plot have begun, and it meets exactly
    these, by number (``open_tenures``). So no copy of a tenure depends on how late the latest fact is.
    ``span_days``, ``crowd``, ``levels`` and ``rows_per_chunk`` do not change the result.
    """

    def day(c: Column) -> Column:
        return F.unix_micros(c).cast("double") / F.lit(86400e6)

    facts, endless = open_tenures(facts, tenures, ts, rows_per_chunk)
    held = closed_spans(tenures, day)
    spans, crowded = grid.cover(held, ["_plot"], [("_from", "_to")], span_days, crowd, levels)
    crowded = [c.withColumnRenamed("_plot", "plot_id") for c in crowded]
    keyed = grid.leaf_of(facts, ["plot_id"], [day(F.col(ts))], span_days, crowded)
    # One row to meet the spans, and one for each tenure that has begun.
    nth = F.explode(F.sequence(F.lit(0).cast("bigint"), "_begun"))
    keyed = keyed.withColumn("_nth", nth).withColumns(
        {"_plvl": F.when(F.col("_nth") > 0, ENDLESS).otherwise(F.col("_plvl")), "_p0": F.when(F.col("_nth") > 0, F.col("_nth")).otherwise(F.col("_p0"))}
    )
    holds = (
        (F.col("plot_id") == F.col("_plot"))
        & grid.same_leaf(1)
        & (F.col("valid_from") <= F.col(ts))
        & (F.col("valid_to").isNull() | (F.col(ts) < F.col("valid_to")))
    )
    met = keyed.join(spans.unionByName(endless, allowMissingColumns=True), holds, "left")
    met = met.filter(F.col("_plot").isNotNull() | (F.col("_begun") == 0))
    return met.drop(*grid.helper_columns(1), "_plot", "_from", "_to", "_begun", "_nth")


ENDLESS = -1  # the level of cells that tenures without an end stand in, one for each


def closed_spans(tenures: DataFrame, day: Callable[[Column], Column]) -> DataFrame:
    """The tenures with an end, that last any time, with both ends in days."""
    return tenures.filter(F.col("valid_from") < F.col("valid_to")).select(
        F.col("plot_id").alias("_plot"),
        "holder_id",
        "valid_from",
        "valid_to",
        day(F.col("valid_from")).alias("_from"),
        day(F.col("valid_to")).alias("_to"),
    )


def open_tenures(facts: DataFrame, tenures: DataFrame, ts: str, rows_per_chunk: int | None) -> tuple[DataFrame, DataFrame]:
    """``facts`` with ``_begun``, the number of tenures without an end that have begun on their plot, and these tenures,
    each in the cell of its number. Both sides are merged into one ordered scan; busy plots are cut along time."""
    still = tenures.filter("valid_to IS NULL AND valid_from IS NOT NULL AND plot_id IS NOT NULL").select(
        "plot_id", F.col("valid_from").alias("_at"), F.lit(0).alias("_side"), F.struct("holder_id", "valid_from", "valid_to").alias("_tenure")
    )
    merged = facts.withColumns({"_at": F.col(ts), "_side": F.lit(1)}).unionByName(still, allowMissingColumns=True)
    order = ["_at", "_side", "_tenure"]
    begun = running_total(merged, ["plot_id"], order, (F.col("_side") == 0).cast("bigint"), "_begun", rows_per_chunk)
    numbered = running_total(still, ["plot_id"], order, F.lit(1).cast("bigint"), "_no", rows_per_chunk)
    cells = numbered.select(F.col("plot_id").alias("_plot"), "_tenure.*", F.lit(ENDLESS).alias("_lvl"), F.col("_no").alias("_c0"))
    return begun.filter("_side = 1").select(*facts.columns, "_begun"), cells


def confirm_alerts(a: DataFrame, b: DataFrame, window_seconds: int) -> DataFrame:
    """Alerts of ``a`` that have an alert of ``b`` on the same plot at most ``window_seconds`` away.

    ``b`` is reduced to its first and last time per plot and span of ``window_seconds``. That
    is enough: an alert is confirmed by anything in its own span, by the last alert of the
    span before, or by the first alert of the span after. So each alert meets one row.
    """
    width = window_seconds * 1_000_000
    ends = b.groupBy("plot_id", time_chunk(F.col("ts"), window_seconds).alias("_at")).agg(
        F.min("ts").alias("_first"), F.max("ts").alias("_last")
    )
    near = (
        ends.select("plot_id", "_at", "_first", "_last", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("_d"))
        .groupBy("plot_id", (F.col("_at") + F.col("_d")).alias("_span"))
        .agg(
            F.max(F.when(F.col("_d") == 1, F.col("_last"))).alias("_earlier"),
            F.max(F.col("_d") == 0).alias("_same"),
            F.min(F.when(F.col("_d") == -1, F.col("_first"))).alias("_later"),
        )
        .withColumnRenamed("plot_id", "_plot")
        .withColumnRenamed("_span", "_near")
    )
    keyed = a.withColumn("_span", time_chunk(F.col("ts"), window_seconds))
    t = F.unix_micros("ts")
    confirmed = (
        (F.col("plot_id") == F.col("_plot"))
        & (F.col("_span") == F.col("_near"))
        & (
            F.col("_same")
            | F.coalesce(t - F.unix_micros("_earlier") <= width, F.lit(False))
            | F.coalesce(F.unix_micros("_later") - t <= width, F.lit(False))
        )
    )
    return keyed.join(near, confirmed, "left_semi").drop("_span")


def source_sets(a: DataFrame, b: DataFrame, op: str) -> DataFrame:
    """Plots reported by either, both or only the first source.

    Each side is reduced to its distinct plots first, so a hot plot meets itself once.
    """
    left, right = a.select("plot_id").distinct(), b.select("plot_id").distinct()
    if op == "either":
        return left.union(right).distinct()
    if op == "both":
        return left.intersect(right)
    if op == "only_first":
        return left.subtract(right)
    raise ValueError(f"unknown set operation {op!r}")


def calendar(plots: DataFrame, first: str, last: str) -> DataFrame:
    """One row per plot and day from ``first`` to ``last``."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return plots.select("plot_id", F.explode(days).alias("day"))


def monitoring_gaps(alerts: DataFrame, days: DataFrame) -> DataFrame:
    """Plot-days of the calendar without any alert."""
    seen = alerts.select("plot_id", F.to_date("ts").alias("day")).distinct()
    return days.join(seen, ["plot_id", "day"], "left_anti")
