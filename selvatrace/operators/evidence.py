"""Evidence products: technical status, dossiers, review samples, accuracy figures.

They report technical signals and leave every verdict to the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from selvatrace.plans.ordered import ROWS_PER_CHUNK, first_rows, join_on, running_total


def technical_status(plots: DataFrame, obs: DataFrame, loss: DataFrame, alerts: DataFrame, min_area: float) -> DataFrame:
    """``insufficient_data``, ``signal`` or ``no_signal`` per plot.

    A plot without observations has insufficient data. It shows a signal when the area lost
    after the cut-off (``loss.area_after``) reaches ``min_area`` or an alert lies on it. Every
    input is reduced to one row per plot before it is joined.
    """
    seen = obs.groupBy("plot_id").agg(F.count(F.lit(1)).alias("n_obs"))
    lost = loss.groupBy("plot_id").agg(F.sum("area_after").alias("area_after"))
    alerted = alerts.groupBy("plot_id").agg(F.count(F.lit(1)).alias("n_alerts"))
    joined = plots.select("plot_id")
    for side in (seen, lost, alerted):
        joined = joined.join(side, "plot_id", "left")
    filled = joined.select(
        "plot_id",
        F.coalesce("n_obs", F.lit(0)).alias("n_obs"),
        F.coalesce("area_after", F.lit(0)).alias("area_after"),
        F.coalesce("n_alerts", F.lit(0)).alias("n_alerts"),
    )
    signal = (F.col("area_after") >= F.lit(min_area).cast("decimal(18,4)")) | (F.col("n_alerts") > 0)
    status = F.when(F.col("n_obs") == 0, "insufficient_data").when(signal, "signal").otherwise("no_signal")
    return filled.withColumn("status", status)


def dossier(
    status: DataFrame, alerts: DataFrame, movements: DataFrame, page_rows: int, rows_per_chunk: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """One nested record per plot of ``status``, also as JSON, in numbered pages of ``page_rows``
    entries.

    Entries are the plot's alerts and, per supplying site, its movements. A plot with few
    entries has one page; a plot with a third of all alerts has many, so no record outgrows a
    task and no entry is left out. A plot without entries has one page with none.
    """
    entries = alerts.select(
        "plot_id",
        F.to_date("ts").alias("on_day"),
        F.lit("alert").alias("kind"),
        F.col("alert_id").alias("ref"),
        F.col("source").alias("note"),
        F.col("area_ha").cast("decimal(18,4)").alias("amount"),
    ).unionByName(
        movements.groupBy(F.col("dst").alias("plot_id"), F.col("src").alias("ref"))
        .agg(F.min("moved_on").alias("on_day"), F.sum("qty").cast("decimal(18,4)").alias("amount"))
        .select("plot_id", "on_day", F.lit("origin").alias("kind"), "ref", F.lit("site").alias("note"), "amount")
    )
    numbered = running_total(entries, ["plot_id"], ["on_day", "kind", "ref"], F.lit(1), "_no", rows_per_chunk)
    entry = F.struct(
        F.date_format("on_day", "yyyy-MM-dd").alias("on_day"),
        "kind",
        "ref",
        "note",
        F.col("amount").cast("string").alias("amount"),
    )
    # Each plot adds a row without an entry to its first page, so a plot without any has a page.
    paged = numbered.select(
        "plot_id",
        (F.floor((F.col("_no") - 1) / page_rows) + 1).alias("page"),
        F.struct("_no", entry.alias("_entry")).alias("_numbered"),
    ).unionByName(status.select("plot_id", F.lit(1).cast("bigint").alias("page")), allowMissingColumns=True)
    pages = (
        paged.groupBy("plot_id", "page")
        .agg(F.sort_array(F.collect_list("_numbered")).alias("_entries"))
        .select("plot_id", "page", F.transform("_entries", lambda e: e["_entry"]).alias("entries"))
    )
    record = pages.join(status.select("plot_id", "status"), "plot_id").select("plot_id", "page", "status", "entries")
    return record.withColumn("document", F.to_json(F.struct("plot_id", "page", "status", "entries")))


def review_sample(df: DataFrame, key: str, strata: list[str], n: int, seed: str) -> DataFrame:
    """``n`` rows per stratum for review by others: the same for the same seed, whatever the
    partitioning, because rows are drawn in the order of a hash of key and seed."""
    ticket = F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.lit(seed)), 256)
    return first_rows(df.withColumn("ticket", ticket), strata, [F.col("ticket"), F.col(key)], n)


def confusion_matrix(checked: DataFrame) -> DataFrame:
    """Counts per mapped and checked class with each row's and column's share."""
    cells = checked.groupBy("mapped", "truth").agg(F.count(F.lit(1)).alias("n"))
    return cells.withColumns(
        {
            "share_of_mapped": F.col("n").cast("double") / F.sum("n").over(W.partitionBy("mapped")).cast("double"),
            "share_of_truth": F.col("n").cast("double") / F.sum("n").over(W.partitionBy("truth")).cast("double"),
        }
    )


def accuracy_report(checked: DataFrame, class_areas: DataFrame) -> DataFrame:
    """User's and producer's accuracy and the area estimate with its standard error per class.

    The stratified estimator of Olofsson et al. (2014), doi:10.1016/j.rse.2014.02.015: with
    W_i the share of the mapped area in class i, class j covers ``sum_i W_i n_ij / n_i`` of the
    area, with variance ``sum_i W_i^2 (n_ij/n_i)(1 - n_ij/n_i)/(n_i - 1)``.
    ``class_areas`` is (mapped, area). A class with area and no checked row is ``unsampled`` and has no
    estimate; its area is then missing from the others' sum. After the first count only class pairs are left.
    """
    seen = checked.groupBy("mapped", "truth").agg(F.count(F.lit(1)).alias("_n"))
    # Every class gets its diagonal cell, so a class that was never confirmed shows 0.
    diagonal = seen.select(F.explode(F.array("mapped", "truth")).alias("mapped")).select(
        "mapped", F.col("mapped").alias("truth"), F.lit(0).cast("bigint").alias("_n")
    )
    areas = class_areas.groupBy("mapped").agg(F.sum("area").cast("double").alias("_area"))
    mapped = areas.select("mapped", F.col("mapped").alias("truth"), F.lit(0).cast("bigint").alias("_n"))
    counts = seen.unionByName(diagonal).unionByName(mapped).groupBy("mapped", "truth").agg(F.sum("_n").alias("_n"))
    total = areas.agg(F.sum("_area").alias("_total")).scalar()
    weights = areas.select("mapped", (F.col("_area") / total).alias("_w"))
    hit = F.col("mapped").eqNullSafe(F.col("truth"))
    cells = (
        join_on(counts.withColumn("_row", F.sum("_n").over(W.partitionBy("mapped"))), weights, ["mapped"], "left")
        .withColumn("_w", F.coalesce("_w", F.lit(0.0)))
        .withColumn("_share", F.col("_n").cast("double") / F.nullif(F.col("_row").cast("double"), F.lit(0.0)))
        .withColumn("_p", F.coalesce(F.col("_w") * F.col("_share"), F.lit(0.0)))
        .withColumn(
            "_var",
            F.col("_w") * F.col("_w") * F.col("_share") * (F.lit(1.0) - F.col("_share"))
            / F.nullif((F.col("_row") - 1).cast("double"), F.lit(0.0)),
        )
    )
    return (
        cells.groupBy(F.col("truth").alias("cls"))
        .agg(
            F.sum("_n").alias("n_checked"),
            F.max(F.when(hit, F.col("_share"))).alias("users_accuracy"),
            F.sum(F.when(hit, F.col("_p")).otherwise(0.0)).alias("_hits"),
            F.sum("_p").alias("_p"),
            F.sqrt(F.sum("_var")).alias("_se"),
            F.coalesce(F.max(F.when(hit, (F.col("_w") > 0) & (F.col("_row") == 0))), F.lit(False)).alias("unsampled"),
        )
        .select(
            "cls",
            "n_checked",
            "users_accuracy",
            (F.col("_hits") / F.nullif(F.col("_p"), F.lit(0.0))).alias("producers_accuracy"),
            F.when(~F.col("unsampled"), F.col("_p") * total).alias("area_estimate"),
            F.when(~F.col("unsampled"), F.col("_se") * total).alias("area_std_error"),
            "unsampled",
        )
    )
