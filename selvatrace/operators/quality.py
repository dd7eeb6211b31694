"""Validation, versions, run comparison and data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from selvatrace.functions.digest import digest_sum, row_text
from selvatrace.plans.ordered import first_rows, join_on


def validate_split(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the others with the names of the rules they break.

    A rule that comes out null counts as broken.
    """
    broken = F.filter(
        F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]),
        lambda reason: reason.isNotNull(),
    )
    marked = df.withColumn("reasons", broken)
    return marked.filter(F.size("reasons") == 0).drop("reasons"), marked.filter(F.size("reasons") > 0)


def latest_version(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The newest row per key. Rows equal in ``order`` are told apart by their other columns,
    so the same row wins however the data is partitioned. (Maps have no order and are left
    out of that.)"""
    rest = [f.name for f in df.schema if f.name not in {*key, *order} and not isinstance(f.dataType, T.MapType)]
    return first_rows(df, key, [F.col(c).desc() for c in [*order, *rest]], 1)


def manifest(df: DataFrame, dataset: str, cols: list[str], params: dict[str, str]) -> DataFrame:
    """Row count and a checksum that ignores row order but not repeated rows."""
    settings = F.create_map(*[F.lit(x) for pair in sorted(params.items()) for x in pair]).cast("map<string,string>")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        digest_sum(row_text(df, cols)).alias("checksum"),
    ).select(F.lit(dataset).alias("dataset"), "n_rows", "checksum", settings.alias("params"))


def run_diff(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows in which two runs differ: ``added``, ``removed``, or ``changed`` (old and new row).

    Grouping by the whole row nets equal rows out on the map side, nulls included, and only
    the rows that differ go on to be sorted out by key. Repeated keys stay linear: no old row
    is ever paired with a new one. A column that only one run has is null in the other. ``copies`` counts how often a row is missing or extra.
    """
    before, after = old.withColumn("_by", F.lit(-1)), new.withColumn("_by", F.lit(1))
    both = before.unionByName(after, allowMissingColumns=True)
    cols = [c for c in both.columns if c != "_by"]
    differing = both.groupBy(*cols).agg(F.sum("_by").alias("_net")).filter(F.col("_net") != 0)
    kinds = differing.groupBy(*key).agg(F.max(F.col("_net") > 0).alias("_came"), F.max(F.col("_net") < 0).alias("_went"))
    change = F.when(F.col("_came") & F.col("_went"), "changed").when(F.col("_came"), "added").otherwise("removed")
    return (
        join_on(differing, kinds, key)
        .withColumn("change", change)
        .withColumn("side", F.when(F.col("_net") > 0, "new").otherwise("old"))
        .withColumn("copies", F.abs("_net").cast("bigint"))
        .drop("_net", "_came", "_went")
    )


ACCURACY = 10_000  # a reported percentile's rank is off by one in this many rows at most


def quality_report(df: DataFrame, cols: list[str], percentiles: list[float] | None = None) -> DataFrame:
    """Per column: rows, nulls, smallest, largest, approximate distinct count and percentiles.

    One pass; sketches of bounded size are merged. Percentiles are given for numeric columns.
    """
    wanted = percentiles or []
    reports = []
    for name in cols:
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        c = F.col(name)
        marks = F.percentile_approx(c.cast("double"), wanted, ACCURACY) if numeric and wanted else F.lit(None).cast("array<double>")
        reports.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(F.lit(1)).alias("n_rows"),
                F.sum(c.isNull().cast("bigint")).alias("n_nulls"),
                F.min(c).cast("string").alias("smallest"),
                F.max(c).cast("string").alias("largest"),
                F.approx_count_distinct(c).alias("approx_distinct"),
                marks.alias("percentiles"),
            )
        )
    return df.agg(F.array(*reports).alias("_reports")).select(F.inline("_reports"))


def percentile_ranks(df: DataFrame, cols: list[str], percentiles: list[float]) -> DataFrame:
    """Where the percentiles that ``quality_report`` gives for numeric columns really stand.

    One more pass counts, for each reported ``value``, the values below it and those up to it. ``within`` says whether that
    interval of ranks meets the asked one, widened by the sketch's stated error (one row in ``ACCURACY``). Only the reported
    values, a few per column, pass through the driver. A column without values has null values, which are within.
    """
    numeric = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
    entries = []
    reported = quality_report(df, numeric, percentiles).select("column_name", "percentiles").collect() if numeric else []
    for row in reported:
        c = F.col(row["column_name"]).cast("double")
        for share, value in zip(percentiles, row["percentiles"] or [None] * len(percentiles), strict=True):
            mark = F.lit(value).cast("double")
            entries.append(
                F.struct(
                    F.lit(row["column_name"]).alias("column_name"),
                    F.lit(share).alias("percentile"),
                    mark.alias("value"),
                    F.count(c).alias("n_values"),
                    F.count_if(c < mark).alias("n_below"),
                    F.count_if(c <= mark).alias("n_upto"),
                )
            )
    if not entries:
        nothing = "column_name string, percentile double, value double, n_values bigint, n_below bigint, n_upto bigint, within boolean"
        return df.sparkSession.createDataFrame([], nothing)
    ranks = df.agg(F.array(*entries).alias("_ranks")).select(F.inline("_ranks"))
    slack, asked = F.col("n_values") / F.lit(float(ACCURACY)), F.col("percentile") * F.col("n_values")
    meets = (F.col("n_below") <= F.ceil(asked + slack)) & (F.col("n_upto") >= F.floor(asked - slack))
    return ranks.withColumn("within", (F.col("n_values") == 0) | meets)
