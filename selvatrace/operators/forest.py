"""Operators over land-cover observations.

Every aggregate combines on the map side, and every window runs either over rows that were
aggregated first (so a group is bounded by days, years or classes) or through the chunked
scans in ``plans.ordered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from selvatrace.plans.ordered import ROWS_PER_CHUNK, first_rows, join_on, over_previous
from selvatrace.session import cut_lineage


def zonal_stats(obs: DataFrame, zone: list[str], value: str, band: float) -> DataFrame:
    """Count, nulls, sum, mean, min, max and exact median of ``value`` per zone; a zone of nulls only stays.

    Observations are first reduced to one row per zone and distinct value. Counts per band of
    width ``band`` then say which band holds the median and how many values lie below it; that
    goes into the band as one more row, and ranks are counted inside each band. So the values
    of one zone are shared among as many tasks as it has bands. Any width gives the same result.
    """
    v = F.col(value)
    hist = (
        obs.groupBy(*zone, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_band", F.floor(v / F.lit(band)).cast("bigint"))
    )
    per_zone = W.partitionBy(*zone)
    below = per_zone.orderBy("_band").rowsBetween(W.unboundedPreceding, -1)
    middle_bands = (
        hist.filter(v.isNotNull())
        .groupBy(*zone, "_band")
        .agg(F.sum("_n").alias("_in_band"))
        .withColumn("_below", F.coalesce(F.sum("_in_band").over(below), F.lit(0)))
        .withColumn("_all", F.sum("_in_band").over(per_zone))
        .withColumn("_low", F.floor((F.col("_all") + 1) / 2))
        .withColumn("_high", F.floor(F.col("_all") / 2) + 1)
        .filter((F.col("_below") < F.col("_high")) & (F.col("_below") + F.col("_in_band") >= F.col("_low")))
        .select(*zone, "_band", "_below", "_low", "_high")
    )
    in_band = W.partitionBy(*zone, "_band")
    ranked = (
        hist.unionByName(middle_bands, allowMissingColumns=True)
        # Bands without the median have no such row, so their ranks stay null.
        .withColumn("_base", F.max("_below").over(in_band))
        .withColumn("_lo", F.max("_low").over(in_band))
        .withColumn("_hi", F.max("_high").over(in_band))
        .withColumn("_to", F.col("_base") + F.sum("_n").over(in_band.orderBy(value).rowsBetween(W.unboundedPreceding, 0)))
    )

    def at(rank: str) -> Column:
        reached = F.col("_to")
        return F.max(F.when((reached >= F.col(rank)) & (reached - F.col("_n") < F.col(rank)), v)).cast("double")

    return (
        ranked.groupBy(*zone)
        .agg(
            F.coalesce(F.sum(F.when(v.isNotNull(), F.col("_n"))), F.lit(0)).alias("n_obs"),
            F.coalesce(F.sum(F.when(v.isNull(), F.col("_n"))), F.lit(0)).alias("n_null"),
            F.sum(v * F.col("_n")).alias("total"),
            F.min(v).alias("smallest"),
            F.max(v).alias("largest"),
            ((at("_lo") + at("_hi")) / F.lit(2.0)).alias("median"),
        )
        .withColumn("mean", F.col("total").cast("double") / F.nullif(F.col("n_obs").cast("double"), F.lit(0.0)))
    )


def class_area(obs: DataFrame, classes: list[str]) -> DataFrame:
    """Area per plot with one column per class; an absent class is 0."""
    zero = F.lit(0).cast(obs.schema["area_ha"].dataType)
    return obs.groupBy("plot_id").agg(
        *[F.sum(F.when(F.col("cls") == c, F.col("area_ha")).otherwise(zero)).alias(f"area_{c.lower()}") for c in classes]
    )


def loss_after_cutoff(loss: DataFrame, cutoff: str) -> DataFrame:
    """Lost area per plot up to and after ``cutoff``, with the share that came after."""
    day = F.lit(cutoff).cast("date")
    zero = F.lit(0).cast(loss.schema["area_ha"].dataType)
    after = F.col("obs_date") > day
    parts = loss.groupBy("plot_id").agg(
        F.sum(F.when(after, zero).otherwise(F.col("area_ha"))).alias("area_before"),
        F.sum(F.when(after, F.col("area_ha")).otherwise(zero)).alias("area_after"),
    )
    both = (F.col("area_before") + F.col("area_after")).cast("double")
    return parts.withColumn("share_after", F.col("area_after").cast("double") / F.nullif(both, F.lit(0.0)))


def transition_matrix(obs: DataFrame, key: list[str]) -> DataFrame:
    """How often one class follows another, over successive observations of a key.

    Observations of one key, day and class are equal, so they are counted first: ``n`` of
    them make ``n - 1`` steps from the class to itself. What is left per key is at most one
    row per day and class.
    """
    runs = obs.groupBy(*key, "obs_date", "cls").agg(F.count(F.lit(1)).alias("_n"))
    steps = runs.withColumn("_from", F.lag("cls").over(W.partitionBy(*key).orderBy("obs_date", "cls")))
    pairs = F.array(
        F.struct(F.col("_from").alias("from_cls"), F.col("cls").alias("to_cls"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.col("cls").alias("from_cls"), F.col("cls").alias("to_cls"), (F.col("_n") - 1).alias("n")),
    )
    return (
        steps.select(F.inline(pairs))
        .filter(F.col("from_cls").isNotNull() & (F.col("n") > 0))
        .groupBy("from_cls", "to_cls")
        .agg(F.sum("n").alias("n_steps"))
    )


def annual_series(obs: DataFrame) -> DataFrame:
    """Area per plot and year with a running total; years without observations show 0.

    Undated observations belong to no year and are left out; ``validate_split`` can name them.
    The series runs from a plot's first to its last year. Each yearly row fills the gap that
    follows it, so no calendar has to be joined.
    """
    yearly = obs.filter(F.col("obs_date").isNotNull()).groupBy("plot_id", F.year("obs_date").alias("_year")).agg(F.sum("area_ha").alias("_area"))
    by_year = W.partitionBy("plot_id").orderBy("_year")
    last_filled = F.coalesce(F.lead("_year").over(by_year) - 1, F.col("_year"))
    running = by_year.rowsBetween(W.unboundedPreceding, 0)
    return yearly.select(
        "plot_id", "_year", "_area", F.sum("_area").over(running).alias("running_ha"), last_filled.alias("_until")
    ).select(
        "plot_id",
        F.explode(F.sequence("_year", "_until")).alias("year"),
        "_year",
        "_area",
        "running_ha",
    ).select(
        "plot_id",
        "year",
        F.when(F.col("year") == F.col("_year"), F.col("_area")).otherwise(F.lit(0)).alias("area_ha"),
        "running_ha",
    )


def baseline_anomaly(
    series: DataFrame, key: list[str], order: list[str], value: str, n: int, rows_per_chunk: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """z-score of each value against the ``n`` values of its key right before it.

    Null while fewer than two earlier values exist or they do not vary. Keys with more than
    ``rows_per_chunk`` values are cut along the first column of ``order``.
    """
    rows = series.select(*key, *order, F.col(value).cast("double").alias("value"))
    base = {"base_mean": F.avg("value"), "base_std": F.stddev_samp("value")}
    z = (F.col("value") - F.col("base_mean")) / F.nullif(F.col("base_std"), F.lit(0.0))
    return over_previous(rows, key, order, n, base, rows_per_chunk).withColumn("z_score", z)


def best_composite(pixels: DataFrame, period: str) -> DataFrame:
    """The best observation per cell and period: highest quality, then latest, then highest id."""
    keyed = pixels.withColumn("period", F.date_trunc(period, "obs_ts"))
    order = [F.col(c).desc() for c in ("quality", "obs_ts", "obs_id")]
    return first_rows(keyed, ["cx", "cy", "period"], order, 1)


def focal_stats(pixels: DataFrame, radius: int) -> DataFrame:
    """Sum and mean of the observed area over the square of cells around each observed cell.

    The square is summed along x and then along y, so a cell is copied 2r+1 times twice
    instead of (2r+1)**2 times.
    """
    offsets = F.sequence(F.lit(-radius), F.lit(radius))
    cells = pixels.groupBy("cx", "cy").agg(F.sum("area_ha").alias("area"), F.count(F.lit(1)).alias("n"))
    along_x = (
        cells.select("cx", "cy", "area", "n", F.explode(offsets).alias("_d"))
        .groupBy((F.col("cx") + F.col("_d")).alias("cx"), "cy")
        .agg(F.sum("area").alias("area"), F.sum("n").alias("n"), F.max(F.col("_d") == 0).alias("_own"))
    )
    along_y = (
        along_x.select("cx", "cy", "area", "n", "_own", F.explode(offsets).alias("_d"))
        .groupBy("cx", (F.col("cy") + F.col("_d")).alias("cy"))
        .agg(
            F.sum("area").alias("focal_sum"),
            F.sum("n").alias("focal_n"),
            F.max(F.col("_own") & (F.col("_d") == 0)).alias("_own"),
        )
    )
    return along_y.filter("_own").select(
        "cx",
        "cy",
        "focal_sum",
        "focal_n",
        (F.col("focal_sum").cast("double") / F.col("focal_n").cast("double")).alias("focal_mean"),
    )


def admin_rollup(df: DataFrame, levels: list[str], measure: str, how: str = "rollup") -> DataFrame:
    """Totals at each administrative level: ``rollup``, ``cube`` or ``each`` level by itself.

    Rows are summed at the finest level first; only those sums are copied per level.
    """
    finest = df.groupBy(*levels).agg(F.sum(measure).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    if how == "rollup":
        grouped = finest.rollup(*levels)
    elif how == "cube":
        grouped = finest.cube(*levels)
    elif how == "each":
        grouped = finest.groupingSets([[c] for c in levels], *levels)
    else:
        raise ValueError(f"unknown grouping {how!r}")
    return grouped.agg(
        F.grouping_id().alias("level_id"), F.sum("_sum").alias("total"), F.sum("_n").alias("n_rows")
    )


def rank_plots(df: DataFrame, region: str, value: str, key: str, tiles: int) -> DataFrame:
    """Row number, rank, dense rank, percent rank and tile of each plot in its region, largest first.

    Rows are range-partitioned by (region, value, key), which splits a large region and even a
    single tied value among tasks. That layout is written out once, so its partition numbers
    stay the same when it is read twice. Each partition is ranked by itself and then shifted by
    what the partitions before it hold. Expects one row per plot.
    """
    spark = df.sparkSession
    order = [F.col(value).desc(), F.col(key)]
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid_out = cut_lineage(
        df.select(region, value, key)
        .repartitionByRange(spread, F.col(region), *order)
        .withColumn("_part", F.spark_partition_id())
    )
    part = W.partitionBy(region, "_part")
    ranked = laid_out.select(
        "*",
        F.row_number().over(part.orderBy(*order)).alias("_row"),
        F.rank().over(part.orderBy(order[0])).alias("_rank"),
        F.dense_rank().over(part.orderBy(order[0])).alias("_dense"),
    )
    edges = ranked.groupBy(region, "_part").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max("_dense").alias("_values"),
        F.max("_rank").alias("_last_rank"),
        F.max(value).alias("_first"),
        F.min(value).alias("_last"),
    )
    in_region = W.partitionBy(region)
    earlier = in_region.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    goes_on = F.col("_first").eqNullSafe(F.col("_prev_last")) & F.col("_prev_last").isNotNull()
    shifts = (
        edges.withColumn("_prev_last", F.lag("_last").over(in_region.orderBy("_part")))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_region_n", F.sum("_n").over(in_region))
        .withColumn("_goes_on", goes_on)
        # Rank of the partition's last value; unknown while that value began in an earlier one.
        .withColumn(
            "_own_last_rank",
            F.when(~F.col("_goes_on") | (F.col("_values") > 1), F.col("_shift") + F.col("_last_rank")),
        )
        .withColumn("_prev_rank", F.max("_own_last_rank").over(earlier))
        .withColumn("_new_values", F.col("_values") - F.col("_goes_on").cast("int"))
        .withColumn("_dense_shift", F.coalesce(F.sum("_new_values").over(earlier), F.lit(0)) - F.col("_goes_on").cast("int"))
        .select(region, "_part", "_prev_last", "_shift", "_region_n", "_prev_rank", "_dense_shift")
    )
    joined = join_on(ranked, shifts, [region, "_part"])
    row = F.col("_row") + F.col("_shift")
    tied_with_earlier = F.col(value).eqNullSafe(F.col("_prev_last")) & F.col("_prev_rank").isNotNull()
    rank = F.when(tied_with_earlier, F.col("_prev_rank")).otherwise(F.col("_rank") + F.col("_shift"))
    size = F.floor(F.col("_region_n") / tiles)
    larger = F.col("_region_n") % tiles
    in_larger = larger * (size + 1)
    tile = F.when(row <= in_larger, F.floor((row - 1) / (size + 1))).otherwise(
        larger + F.floor((row - 1 - in_larger) / F.greatest(size, F.lit(1)))
    )
    share = F.when(F.col("_region_n") == 1, F.lit(0.0)).otherwise(
        (F.col("rank_no") - 1).cast("double") / F.greatest(F.col("_region_n") - 1, F.lit(1)).cast("double")
    )
    return (
        joined.withColumn("row_no", row)
        .withColumn("rank_no", rank)
        .withColumn("dense_no", F.col("_dense") + F.col("_dense_shift"))
        .withColumn("percent_no", share)
        .withColumn("tile_no", tile + 1)
        .select(region, value, key, "row_no", "rank_no", "dense_no", "percent_no", "tile_no")
    )
