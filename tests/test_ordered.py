"""Chunked scans give the plain window's result however keys are cut, hot and null keys included."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from selvatrace.operators.forest import baseline_anomaly, rank_plots, zonal_stats
from selvatrace.plans.ordered import (
    RANGE_BYTES,
    RANGES_PER_PARTITION,
    busy_keys,
    first_rows,
    last_seen,
    next_row,
    over_previous,
    range_count,
    running_total,
    split_busy_keys,
)

START = 1_700_000_000


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        # A third of all rows on one key; some rows without a key; states and gaps mixed in.
        key = 1 if i % 3 == 0 else rng.choice([2, 3, 4, None])
        state = rng.choice([None, None, rng.randrange(50)])
        when = None if i % 50 == 0 else START + rng.randrange(60) * 3600
        rows.append((i, key, when, state, rng.randrange(100)))
    df = spark.createDataFrame(rows, "id bigint, k bigint, sec bigint, state int, v int")
    return df.withColumn("ts", F.timestamp_seconds("sec")).cache()


def as_set(df):
    return sorted(map(str, df.collect()))


SIZES = [1, 7, 100, 250, 10**6]  # rows per chunk: every key cut, only the hot one, none


@pytest.mark.parametrize("size", SIZES)
def test_running_total(series, size):
    w = W.partitionBy("k").orderBy("ts", "id").rowsBetween(W.unboundedPreceding, 0)
    plain = series.select("id", F.sum("v").over(w).alias("t"))
    assert as_set(running_total(series, ["k"], ["ts", "id"], F.col("v"), "t", size).select("id", "t")) == as_set(plain)


@pytest.mark.parametrize("size", SIZES)
def test_last_seen(series, size):
    w = W.partitionBy("k").orderBy("ts", "id").rowsBetween(W.unboundedPreceding, 0)
    plain = series.select("id", F.last("state", ignorenulls=True).over(w).alias("s"))
    assert as_set(last_seen(series, ["k"], ["ts", "id"], "state", "s", size).select("id", "s")) == as_set(plain)


@pytest.mark.parametrize("size", SIZES)
def test_next_row(series, size):
    plain = series.select("id", F.lead("v").over(W.partitionBy("k").orderBy("ts", "id")).alias("n"))
    ours = next_row(series, ["k"], ["ts", "id"], ["v"], "n", size)
    assert as_set(ours.select("id", F.col("n.v").alias("n"))) == as_set(plain)


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("n", [1, 2, 9])
def test_baseline_anomaly(series, size, n):
    w = W.partitionBy("k").orderBy("ts", "id").rowsBetween(-n, -1)
    v = F.col("v").cast("double")
    plain = series.select("id", F.round(F.avg(v).over(w), 9).alias("m"), F.round(F.stddev_samp(v).over(w), 9).alias("s"))
    ours = baseline_anomaly(series, ["k"], ["ts", "id"], "v", n, size)
    assert as_set(ours.select("id", F.round("base_mean", 9).alias("m"), F.round("base_std", 9).alias("s"))) == as_set(plain)


def test_only_busy_keys_are_cut(series):
    cut, by = split_busy_keys(series, ["k"], ["ts", "id"], 250)
    assert by == ["k", "_chunk"]
    parts = {r.k: (r.parts, r.largest) for r in cut.groupBy("k", "_chunk").count().groupBy("k").agg(
        F.count(F.lit(1)).alias("parts"), F.max("count").alias("largest")).collect()}
    assert all(parts[k][0] == 1 for k in (2, 3, 4, None))
    assert parts[1][0] >= 2 and parts[1][1] < 300
    assert split_busy_keys(series, ["k"], ["ts", "id"], 10**6)[1] == ["k"]


@pytest.mark.parametrize("when", ["CASE WHEN id = 0 THEN 0 ELSE 1700000000 + id END", "1700000000"])
def test_stray_times_and_busy_days_make_no_large_chunk(spark, when):
    rows = spark.range(20_000).select("id", F.lit(1).alias("k"), F.timestamp_seconds(F.expr(when)).alias("ts"))
    cut, by = split_busy_keys(rows.repartition(8), ["k"], ["ts", "id"], 2_000)
    sizes = [r["count"] for r in cut.groupBy(*by).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 4_000


def test_ranges_follow_bytes_and_cluster(spark):
    """Many busy keys make no more ranges than tasks are wanted for; wide rows make as many as their bytes need."""
    rows = spark.range(30_000).select("id", (F.col("id") % 3000).alias("k"), F.timestamp_seconds("id").alias("ts"))
    cut, by = split_busy_keys(rows.repartition(8), ["k"], ["ts", "id"], 5)
    most = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert cut.select("_chunk").distinct().count() <= most
    # A border cuts one key at most.
    assert cut.groupBy("k").agg(F.count_distinct("_chunk").alias("n")).filter("n > 1").count() < most
    assert [range_count(rows, n, 10**9) for n in (10, 10**9, 10**11)] == [2, -(-24 * 10**9 // RANGE_BYTES), -(-24 * 10**11 // RANGE_BYTES)]


def test_sketch_names_the_busy_keys(spark):
    """A third of the rows on one key, ten keys of a thousand, and 40,000 keys of one row; null is a key too."""
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") < 20_000, F.col("id") % 10).otherwise(F.col("id"))
    rows = spark.range(80_000).select(key.alias("k")).repartition(8)
    busy, n_rows = busy_keys(rows, ["k"], 1000)
    got = {r._busy for r in busy.collect()}
    want = rows.groupBy("k").count().filter("count > 1000").select(F.xxhash64("k").alias("h"))
    assert got == {r.h for r in want.collect()} and len(got) == 11 and 39_000 < n_rows < 42_000
    assert busy_keys(rows, ["k"], 10**6)[1] == 0


@pytest.mark.parametrize("n", [3, 50, 400])
def test_lead_in_spans_chunks_shorter_than_it(series, n):
    """The rows looked back on may lie several chunks before."""
    w = W.partitionBy("k").orderBy("ts", "id").rowsBetween(-n, -1)
    plain = series.select("id", F.sum("v").over(w).alias("s"), F.count("v").over(w).alias("c"))
    ours = over_previous(series, ["k"], ["ts", "id"], n, {"s": F.sum("v"), "c": F.count("v")}, 7)
    assert as_set(ours.select("id", "s", "c")) == as_set(plain)


@pytest.mark.parametrize("band", [0.5, 7.0, 1000.0])
def test_zonal_median(series, band):
    plain = series.groupBy("k").agg(F.percentile("v", 0.5).alias("m"), F.count("v").alias("n"))
    ours = zonal_stats(series, ["k"], "v", band)
    assert as_set(ours.select("k", F.col("median").alias("m"), F.col("n_obs").alias("n"))) == as_set(plain)


@pytest.mark.parametrize("n", [1, 40, 150])
def test_first_rows(series, n):
    w = W.partitionBy("k").orderBy("v", "id")
    plain = series.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).select("id")
    assert as_set(first_rows(series, ["k"], [F.col("v"), F.col("id")], n).select("id")) == as_set(plain)


def test_first_rows_cuts_before_the_shuffle(series):
    plan = first_rows(series, ["k"], [F.col("v")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("tiles", [1, 4, 7, 500])
def test_rank_plots_with_long_ties(spark, tiles):
    rng = random.Random(3)
    rows = [(i, "north" if i % 3 else "south", 0 if i % 2 else rng.randrange(6)) for i in range(400)] + [(999, "east", 5)]
    df = spark.createDataFrame(rows, "plot_id bigint, admin1 string, loss int").repartition(5)
    w, o = W.partitionBy("admin1"), [F.col("loss").desc(), F.col("plot_id")]
    plain = df.select(
        "plot_id",
        F.row_number().over(w.orderBy(*o)).cast("bigint").alias("a"),
        F.rank().over(w.orderBy(o[0])).cast("bigint").alias("b"),
        F.dense_rank().over(w.orderBy(o[0])).cast("bigint").alias("c"),
        F.percent_rank().over(w.orderBy(o[0])).alias("d"),
        F.ntile(tiles).over(w.orderBy(*o)).cast("bigint").alias("e"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")  # many partitions, so single values span several
    try:
        ours = rank_plots(df, "admin1", "loss", "plot_id", tiles).select(
            "plot_id",
            F.col("row_no").cast("bigint").alias("a"),
            F.col("rank_no").cast("bigint").alias("b"),
            F.col("dense_no").cast("bigint").alias("c"),
            F.col("percent_no").alias("d"),
            F.col("tile_no").cast("bigint").alias("e"),
        )
        assert as_set(ours) == as_set(plain)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_zone_of_nulls_stays(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, None)], "z int, v double")
    got = {r.z: (r.n_obs, r.n_null, r.median, r["mean"]) for r in zonal_stats(df, ["z"], "v", 1.0).collect()}
    assert got == {1: (1, 1, 2.0, 2.0), 2: (0, 1, None, None)}
