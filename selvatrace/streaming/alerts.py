"""Alert operators on streams. ``delay`` is how late an alert may come, as Spark interval text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selvatrace.plans.ordered import time_chunk
from selvatrace.session import cut_lineage


def stream_tumbling(stream: DataFrame, width: str, delay: str) -> DataFrame:
    """Alerts and area per source and fixed window."""
    return stream_sliding(stream, width, width, delay)


def stream_sliding(stream: DataFrame, width: str, slide: str, delay: str) -> DataFrame:
    """Alerts and area per source and overlapping window."""
    return (
        stream.withWatermark("ts", delay)
        .groupBy(F.window("ts", width, slide).alias("w"), "source")
        .agg(F.count(F.lit(1)).alias("n_alerts"), F.sum("area_ha").alias("area_ha"))
        .select(F.col("w.start").alias("win_start"), F.col("w.end").alias("win_end"), "source", "n_alerts", "area_ha")
    )


def stream_incidents(stream: DataFrame, gap: str, delay: str) -> DataFrame:
    """Incidents live: a pause longer than ``gap`` on a plot starts a new one.

    With merging in local partitions on (see ``session.SETTINGS``), a hot plot's alerts are
    merged into sessions inside each map task before they are shuffled.
    """
    return (
        stream.withWatermark("ts", delay)
        .groupBy("plot_id", F.session_window("ts", gap).alias("w"))
        .agg(F.max("ts").alias("ended"), F.count(F.lit(1)).alias("n_alerts"), F.sum("area_ha").alias("area_ha"))
        .select("plot_id", F.col("w.start").alias("started"), "ended", "n_alerts", "area_ha")
    )


def stream_dedup(stream: DataFrame, key: list[str], delay: str) -> DataFrame:
    """Drops repeats of a key that come within ``delay`` of each other, and rows later than it."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(key)


def _salted(left: DataFrame, right: DataFrame, spread_by: str, salts: int) -> tuple[DataFrame, DataFrame]:
    """Shares each join key among ``salts`` tasks: left rows draw a number, right rows go to all.

    Batch joins need no such help, but streaming joins are not split at run time.
    """
    drawn = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    return drawn, right.withColumn("_salt_r", F.explode(every))


def stream_enrich(stream: DataFrame, plot_facts: DataFrame, salts: int) -> DataFrame:
    """Attaches what is known of the plot; alerts on unknown plots are kept.

    ``plot_facts`` holds one row per plot and is written out once here, as every micro-batch reads it. A hot plot is shared by ``salts`` tasks; 1 is right
    where the facts are small enough for Spark to broadcast them.
    """
    left, right = _salted(stream, cut_lineage(plot_facts.withColumnRenamed("plot_id", "_plot")), "alert_id", salts)
    same = (F.col("plot_id") == F.col("_plot")) & (F.col("_salt") == F.col("_salt_r"))
    return left.join(right, same, "left").drop("_plot", "_salt", "_salt_r")


def stream_confirm(a: DataFrame, b: DataFrame, window: str, delay: str, salts: int) -> DataFrame:
    """Alerts of ``a`` with an alert of ``b`` on the same plot at most ``window`` away, live.

    A hot plot is shared by ``salts`` tasks. Pass the rarer source as ``b``.
    """
    left, right = _salted(
        a.withWatermark("ts", delay),
        b.select(F.col("plot_id").alias("_plot"), F.col("ts").alias("_ts")).withWatermark("_ts", delay),
        "alert_id",
        salts,
    )
    wide = F.expr(f"INTERVAL {window}")
    near = (
        (F.col("plot_id") == F.col("_plot"))
        & (F.col("_salt") == F.col("_salt_r"))
        & (F.col("_ts") >= F.col("ts") - wide)
        & (F.col("_ts") <= F.col("ts") + wide)
    )
    return left.join(right, near, "left_semi").drop("_salt")


def stream_confirm_closed(a: DataFrame, b: DataFrame, window_seconds: int, delay: str) -> DataFrame:
    """``stream_confirm`` once the time span of the confirming alert is closed, with little state.

    Alerts of ``b`` are kept as their first and last time per plot and span of ``window_seconds``, combined in the map tasks,
    so state grows with spans and not with alerts. A closed span meets the alerts of ``a`` in itself and in the two spans beside
    it, which is enough (see ``operators.alerts.confirm_alerts``). Plots are shared by spans, and so no copies are drawn.
    """
    spans = (
        b.withWatermark("ts", delay)
        .groupBy("plot_id", F.window("ts", f"{window_seconds} seconds").alias("_w"))
        .agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"))
    )
    beside = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    closed = spans.select(
        F.col("plot_id").alias("_plot"), "_first", "_last", F.window_time("_w").alias("_closes"),
        time_chunk(F.col("_w.start"), window_seconds).alias("_at"), beside.alias("_d"),
    ).withColumn("_near", F.col("_at") + F.col("_d"))
    left = a.withWatermark("ts", delay).withColumn("_span", time_chunk(F.col("ts"), window_seconds))
    wide, twice = F.expr(f"INTERVAL {window_seconds} SECONDS"), F.expr(f"INTERVAL {2 * window_seconds} SECONDS")
    near = (
        (F.col("plot_id") == F.col("_plot"))
        & (F.col("_span") == F.col("_near"))
        & (
            (F.col("_d") == 0)
            | ((F.col("_d") == 1) & (F.col("_last") >= F.col("ts") - wide))
            | ((F.col("_d") == -1) & (F.col("_first") <= F.col("ts") + wide))
        )
        # Follows from the spans; lets both sides forget what can meet nothing any more.
        & (F.col("_closes") >= F.col("ts") - twice)
        & (F.col("_closes") <= F.col("ts") + twice)
    )
    return left.join(closed, near, "left_semi").drop("_span")


def stream_status(stream: DataFrame, active_area: float) -> DataFrame:
    """Running status per plot, for update mode: totals, newest source, ``watch`` or ``active``.

    A built-in aggregate carries the state, so alerts of a hot plot are combined in each map
    task before its state is touched; a Python state function would see each one by itself.
    """
    totals = stream.groupBy("plot_id").agg(
        F.count(F.lit(1)).alias("n_alerts"),
        F.sum("area_ha").alias("area_ha"),
        F.max("ts").alias("last_ts"),
        F.max_by("source", F.struct("ts", "alert_id")).alias("last_source"),
    )
    active = F.col("area_ha") >= F.lit(active_area).cast("decimal(18,4)")
    return totals.withColumn("status", F.when(active, "active").otherwise("watch"))
