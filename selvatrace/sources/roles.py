"""Role views: the stored tables seen as sites, plots, alerts, observations, movements.

The tables hold no geometry. Coordinates are made from keys, so they repeat exactly in any
engine and mean nothing on the ground.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from selvatrace.plans.ordered import next_row

# Fixed schemas: evidence has to be repeatable, and inferred types drift.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}

MEASURE = "decimal(18,4)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stored table, read with its fixed schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _coord(base: float, key: str, step: int, span: int) -> Column:
    return F.lit(base) + (F.col(key) * step % span).cast("double") / F.lit(span / 10.0)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Establishments with their two administrative levels."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("site_id"),
            F.col("r_name").alias("admin1"),
            F.col("n_name").alias("admin2"),
            _coord(-65.0, "s_suppkey", 37, 1000).alias("lon"),
            _coord(-35.0, "s_suppkey", 61, 1000).alias("lat"),
        )
    )


def plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plots as one concave ring each."""
    centre = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("plot_id"),
        _coord(-65.0, "c_custkey", 37, 1000).alias("cx"),
        _coord(-35.0, "c_custkey", 61, 1000).alias("cy"),
        ((F.col("c_custkey") % 5 + 1).cast("double") / F.lit(50.0)).alias("h"),
    )

    def vertex(x: Column, y: Column) -> Column:
        return F.struct(x.alias("x"), y.alias("y"))

    cx, cy, h = F.col("cx"), F.col("cy"), F.col("h")
    ring = F.array(
        vertex(cx - h, cy - h), vertex(cx + h, cy - h), vertex(cx + h, cy + h), vertex(cx, cy), vertex(cx - h, cy + h)
    )
    return centre.select("plot_id", F.array(ring).alias("rings"))


def plot_admin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Administrative levels of each plot."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("plot_id"), F.col("r_name").alias("admin1"), F.col("n_name").alias("admin2"))
    )


def as_alerts(events: DataFrame) -> DataFrame:
    """Event rows as alerts; works on a stored table and on a stream alike."""
    return events.select(
        F.col("event_id").alias("alert_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("plot_id"),
        F.col("event_type").alias("source"),
        F.col("value").cast(MEASURE).alias("area_ha"),
        _coord(-65.0, "event_id", 7919, 100000).alias("lon"),
        _coord(-35.0, "event_id", 104729, 100000).alias("lat"),
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored alerts."""
    return as_alerts(table(spark, sf_dir, "events"))


def raster(spark: SparkSession, sf_dir: str, deg: float) -> DataFrame:
    """Alert positions as raster cells with a date, a class and a quality score."""
    a = alerts(spark, sf_dir)
    return a.select(
        F.floor(F.col("lon") / F.lit(deg)).alias("cx"),
        F.floor(F.col("lat") / F.lit(deg)).alias("cy"),
        F.col("ts").alias("obs_ts"),
        F.col("alert_id").alias("obs_id"),
        F.col("source").alias("cls"),
        "area_ha",
        F.floor("area_ha").cast("bigint").alias("quality"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land-cover observations that already carry their plot."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag", "l_quantity")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("plot_id"),
        F.col("l_shipdate").cast("date").alias("obs_date"),
        F.col("l_returnflag").alias("cls"),
        F.col("l_quantity").cast(MEASURE).alias("area_ha"),
    )


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lot movements from a site to a buyer."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").alias("src"),
        F.col("o_custkey").alias("dst"),
        F.col("o_orderdate").cast("date").alias("moved_on"),
        F.col("l_partkey").alias("lot_id"),
        F.col("l_quantity").cast(MEASURE).alias("qty"),
    )


def nation_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same movements between nations: one kind of node, so the graph is closed."""
    site = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("bigint").alias("s_nat"))
    buyer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("c_nat"))
    return (
        movements(spark, sf_dir)
        .join(site, F.col("src") == F.col("s_suppkey"))
        .join(buyer, F.col("dst") == F.col("c_custkey"))
        .select(F.col("s_nat").alias("src"), F.col("c_nat").alias("dst"), "moved_on", "lot_id", "qty")
    )


def tenures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who held a plot from when to when; the last holder has no end."""
    order = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("plot_id"),
        F.col("o_orderkey").alias("holder_id"),
        F.col("o_orderdate").cast("timestamp").alias("valid_from"),
    )
    nxt = next_row(order, ["plot_id"], ["valid_from", "holder_id"], ["valid_from"], "_next")
    return nxt.select("plot_id", "holder_id", "valid_from", F.col("_next.valid_from").alias("valid_to"))
