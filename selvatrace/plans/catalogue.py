"""The registered queries: each runs one operator over whole stored tables.

A query takes (spark, folder of the tables) and returns a DataFrame of plain columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from selvatrace.operators import alerts as al
from selvatrace.operators import chain, evidence, forest, quality, spatial
from selvatrace.session import SETTINGS, scratch_path
from selvatrace.sources import layers, roles
from selvatrace.streaming import alerts as live
from selvatrace.streaming.sink import drain, drain_upserts

Query = Callable[[SparkSession, str], DataFrame]

CUTOFF = "2000-12-31"
HOUR = 3600


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text, whole numbers as bigint: types that read
    the same from any engine."""

    def column(field: T.StructField):
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def _rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


def _loss(spark: SparkSession, d: str) -> DataFrame:
    return roles.observations(spark, d).filter(F.col("cls") == "R")


def _points(spark: SparkSession, d: str) -> DataFrame:
    return roles.alerts(spark, d).select("alert_id", "lon", "lat")


def _plot_centres(spark: SparkSession, d: str) -> DataFrame:
    centre = F.col("rings")[0][3]
    return roles.plots(spark, d).select(F.col("plot_id").alias("id"), centre["x"].alias("lon"), centre["y"].alias("lat"))


def _site_points(spark: SparkSession, d: str) -> DataFrame:
    return roles.sites(spark, d).select(F.col("site_id").alias("id"), "lon", "lat")


def _source(spark: SparkSession, d: str, name: str) -> DataFrame:
    return roles.alerts(spark, d).filter(F.col("source") == name)


# Sources, sinks, provenance


def _layer(spark: SparkSession, rows: DataFrame, fmt: str) -> DataFrame:
    path = scratch_path(spark, "layer")
    rows.write.format("parquet" if fmt == "parquet" else "text").save(path)
    good, bad = layers.read_layer(spark, path, fmt, "c_custkey bigint, c_nationkey int")
    none = F.lit(-1)
    return good.select("c_custkey", "c_nationkey", F.lit("").alias("bad_row")).unionByName(
        bad.select(none.cast("bigint").alias("c_custkey"), none.alias("c_nationkey"), F.col(layers.BAD_ROW).alias("bad_row"))
    )


def read_layer(spark: SparkSession, d: str) -> DataFrame:
    second = F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).otherwise(F.col("c_nationkey").cast("string"))
    lines = roles.table(spark, d, "customer").select(F.concat_ws(",", F.col("c_custkey").cast("string"), second))
    return _layer(spark, lines, "csv")


def read_layer_parquet(spark: SparkSession, d: str) -> DataFrame:
    return _layer(spark, roles.table(spark, d, "customer").select("c_custkey", "c_nationkey"), "parquet")


def read_layer_parquet_mixed(spark: SparkSession, d: str) -> DataFrame:
    """One folder whose files hold whole numbers, text and fractions in the same column."""
    rows, path = roles.table(spark, d, "customer"), scratch_path(spark, "layer")
    low, kind = F.col("c_acctbal") < 0, F.col("c_custkey") % 3
    text = F.when(low, F.col("c_mktsegment")).otherwise(F.col("c_nationkey").cast("string"))
    fraction = F.col("c_nationkey") + F.when(low, 0.5).otherwise(0.0)
    for i, value in enumerate((F.col("c_nationkey"), text, fraction)):
        rows.filter(kind == i).select("c_custkey", value.alias("c_nationkey")).write.mode("append").parquet(path)
    good, bad = layers.read_layer(spark, path, "parquet", "c_custkey bigint, c_nationkey int")
    told = bad.select(
        F.lit(-1).cast("bigint").alias("c_custkey"), F.lit(-1).alias("c_nationkey"), F.col(layers.BAD_ROW).alias("bad_row")
    )
    return good.withColumn("bad_row", F.lit("")).unionByName(told)


def read_layer_json(spark: SparkSession, d: str) -> DataFrame:
    whole = F.to_json(F.struct("c_custkey", "c_nationkey"))
    torn = F.concat(F.lit('{"c_custkey":'), F.col("c_custkey").cast("string"))
    lines = roles.table(spark, d, "customer").select(F.when(F.col("c_acctbal") < 0, torn).otherwise(whole))
    return _layer(spark, lines, "json")


def parse_polygons(spark: SparkSession, d: str) -> DataFrame:
    pairs = F.transform("rings", lambda ring: F.transform(ring, lambda v: F.array(v.x, v.y)))
    text = F.to_json(F.struct(F.lit("Polygon").alias("type"), pairs.alias("coordinates")))
    parsed = layers.parse_polygons(roles.plots(spark, d).select("plot_id", text.alias("geojson")), "plot_id", "geojson")
    return (
        parsed.select("plot_id", F.posexplode("rings").alias("ring_no", "ring"))
        .select("plot_id", "ring_no", F.posexplode("ring").alias("vertex_no", "v"))
        .select("plot_id", "ring_no", "vertex_no", "v.x", "v.y")
    )


def validate_split(spark: SparkSession, d: str) -> DataFrame:
    rules = {
        "area_over_five": F.col("area_ha") > 5,
        "known_source": F.col("source") != "error",
        "west_of_58": F.col("lon") < -58.0,
    }
    ok, rejected = quality.validate_split(roles.alerts(spark, d), rules)
    return ok.select("alert_id", F.lit("").alias("reasons")).unionByName(
        rejected.select("alert_id", F.concat_ws(",", "reasons").alias("reasons"))
    )


def latest_version(spark: SparkSession, d: str) -> DataFrame:
    return quality.latest_version(roles.alerts(spark, d), ["plot_id", "source"], ["ts", "alert_id"]).select(
        "plot_id", "source", "alert_id", "ts", "area_ha"
    )


def manifest(spark: SparkSession, d: str) -> DataFrame:
    cols = ["plot_id", "obs_date", "cls", "area_ha"]
    made = quality.manifest(roles.observations(spark, d), "observation", cols, {"cutoff": CUTOFF})
    return made.select(
        "dataset", "n_rows", F.col("checksum").cast("string").alias("checksum"), F.col("params")["cutoff"].alias("cutoff")
    )


def run_diff(spark: SparkSession, d: str) -> DataFrame:
    base = roles.table(spark, d, "customer")
    old = base.filter(F.col("c_acctbal") >= 0).select("c_custkey", "c_nationkey", "c_mktsegment")
    moved = F.when(F.col("c_mktsegment") == "BUILDING", "HOUSEHOLD").otherwise(F.col("c_mktsegment"))
    new = base.filter(F.col("c_acctbal") < 9000).select("c_custkey", "c_nationkey", moved.alias("c_mktsegment"))
    return quality.run_diff(old, new, ["c_custkey"])


def write_evidence(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "evidence")
    obs = roles.observations(spark, d)
    layers.write_evidence(obs, path, ["cls"], ["plot_id", "obs_date", "area_ha"])
    return spark.read.schema(obs.schema).parquet(path)


def _order_report(spark: SparkSession, d: str) -> DataFrame:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return quality.quality_report(roles.table(spark, d, "orders"), cols, [0.25, 0.5, 0.75])


def quality_report(spark: SparkSession, d: str) -> DataFrame:
    return _order_report(spark, d).select("column_name", "n_rows", "n_nulls", "smallest", "largest")


def quality_report_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Exact distinct counts, and whether the sketches lie within three of their standard errors (5 %)."""
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    orders = roles.table(spark, d, "orders")
    exact = orders.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("n_distinct")) for c in cols]).alias("_r"))
    off = F.abs(F.col("approx_distinct") - F.col("n_distinct"))
    return (
        _order_report(spark, d)
        .join(exact.select(F.inline("_r")), "column_name")
        .select("column_name", "n_distinct", (off <= F.greatest(F.lit(1.0), 0.15 * F.col("n_distinct"))).alias("close"))
    )


def quality_report_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Whether each reported percentile stands where it should, within the sketch's stated error."""
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    ranks = quality.percentile_ranks(roles.table(spark, d, "orders"), cols, [0.01, 0.25, 0.5, 0.75, 0.99])
    return ranks.select("column_name", "percentile", "n_values", "within")


# Spatial


def cell_id(spark: SparkSession, d: str) -> DataFrame:
    return spatial.cell_id(_points(spark, d), 0.5).select("alert_id", "cx", "cy")


def cover_cells(spark: SparkSession, d: str) -> DataFrame:
    return spatial.cover_cells(roles.plots(spark, d), 0.1)


def _pip(how: str, deg: float, crowd: int) -> Query:
    return lambda spark, d: spatial.pip_join(_points(spark, d), roles.plots(spark, d), deg, how, crowd)


def within_distance_join(spark: SparkSession, d: str) -> DataFrame:
    return spatial.within_distance_join(_plot_centres(spark, d), _site_points(spark, d), 60000.0)


def knn_join(spark: SparkSession, d: str) -> DataFrame:
    return spatial.knn_join(_plot_centres(spark, d), _site_points(spark, d), k=3)


def bbox_overlap_join(spark: SparkSession, d: str) -> DataFrame:
    return spatial.bbox_overlap_join(roles.plots(spark, d), 0.25)


def polygon_area(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(spatial.polygon_area(roles.plots(spark, d)), 4, "area_ha")


def cell_density(spark: SparkSession, d: str) -> DataFrame:
    return spatial.cell_density(_points(spark, d), 0.5, 20)


def focal_stats(spark: SparkSession, d: str) -> DataFrame:
    return forest.focal_stats(roles.raster(spark, d, 0.25), 2)


# Forest observations


def zonal_stats(spark: SparkSession, d: str) -> DataFrame:
    return forest.zonal_stats(roles.observations(spark, d), ["plot_id"], "area_ha", band=8.0)


def zonal_stats_by_class(spark: SparkSession, d: str) -> DataFrame:
    return forest.zonal_stats(roles.observations(spark, d), ["cls"], "area_ha", band=8.0)


def class_area(spark: SparkSession, d: str) -> DataFrame:
    return forest.class_area(roles.observations(spark, d), ["A", "N", "R"])


def loss_after_cutoff(spark: SparkSession, d: str) -> DataFrame:
    return forest.loss_after_cutoff(_loss(spark, d), CUTOFF)


def transition_matrix(spark: SparkSession, d: str) -> DataFrame:
    return forest.transition_matrix(roles.observations(spark, d), ["plot_id"])


def annual_series(spark: SparkSession, d: str) -> DataFrame:
    return forest.annual_series(_loss(spark, d))


def _anomaly(**options: int) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        scored = forest.baseline_anomaly(
            roles.alerts(spark, d), ["plot_id"], ["ts", "alert_id"], "area_ha", n=7, **options
        )
        return _rounded(scored, 6, "base_mean", "base_std", "z_score").select(
            "alert_id", "plot_id", "value", "base_mean", "base_std", "z_score"
        )

    return run


def best_composite(spark: SparkSession, d: str) -> DataFrame:
    return forest.best_composite(roles.raster(spark, d, 0.5), "week").select(
        "cx", "cy", "period", "obs_id", "quality", "cls", "area_ha"
    )


def _loss_by_admin(spark: SparkSession, d: str) -> DataFrame:
    lost = _loss(spark, d).groupBy("plot_id").agg(F.sum("area_ha").alias("area_ha"))
    return lost.join(roles.plot_admin(spark, d), "plot_id")


def _admin(how: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        out = forest.admin_rollup(_loss_by_admin(spark, d), ["admin1", "admin2"], "area_ha", how)
        return out.select(
            F.coalesce("admin1", F.lit("(all)")).alias("admin1"),
            F.coalesce("admin2", F.lit("(all)")).alias("admin2"),
            F.col("level_id").cast("bigint").alias("level_id"),
            "total",
            "n_rows",
        )

    return run


def rank_plots(spark: SparkSession, d: str) -> DataFrame:
    return forest.rank_plots(_loss_by_admin(spark, d), "admin1", "area_ha", "plot_id", tiles=4)


# Alerts, batch

BANDS = [("severe", 100.0, None), ("severe", 50.0, ["error", "purchase"]), ("moderate", 20.0, None)]


def classify_alerts(spark: SparkSession, d: str) -> DataFrame:
    return al.classify_alerts(roles.alerts(spark, d), BANDS, "low").select("alert_id", "source", "area_ha", "severity")


def dedup_alerts(spark: SparkSession, d: str) -> DataFrame:
    keyed = roles.alerts(spark, d).withColumn("day", F.to_date("ts"))
    return al.dedup_alerts(keyed, ["plot_id", "source", "day"]).select("plot_id", "source", "day", "alert_id", "ts")


def incidents(spark: SparkSession, d: str) -> DataFrame:
    return al.incidents(roles.alerts(spark, d), 2 * HOUR)


def _asof(**options: int) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        errors = _source(spark, d, "error").select("alert_id", "plot_id", "ts", "area_ha")
        signups = _source(spark, d, "signup").select("plot_id", "ts", F.col("alert_id").alias("state_id"), "area_ha")
        return al.asof_state(errors, signups, ["plot_id"], **options)

    return run


def asof_tenure(spark: SparkSession, d: str) -> DataFrame:
    obs = roles.observations(spark, d).select("plot_id", F.col("obs_date").cast("timestamp").alias("ts"), "area_ha")
    states = roles.tenures(spark, d).select("plot_id", F.col("valid_from").alias("ts"), F.col("holder_id").alias("state_id"))
    found = al.asof_state(obs, states, ["plot_id"])
    return found.groupBy("plot_id", F.coalesce("state_id", F.lit(-1)).alias("holder_id")).agg(
        F.count(F.lit(1)).alias("n_obs"), F.sum("area_ha").alias("area_ha")
    )


def tenure_join(spark: SparkSession, d: str) -> DataFrame:
    obs = roles.observations(spark, d).withColumn("ts", F.col("obs_date").cast("timestamp"))
    held = al.tenure_join(obs, roles.tenures(spark, d), "ts", span_days=180.0)
    return held.select("plot_id", "obs_date", "area_ha", F.coalesce("holder_id", F.lit(-1)).alias("holder_id"))


def confirm_alerts(spark: SparkSession, d: str) -> DataFrame:
    return al.confirm_alerts(_source(spark, d, "error"), _source(spark, d, "purchase"), 6 * HOUR).select(
        "alert_id", "plot_id", "ts"
    )


def _set(op: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        # Among alerts of every size each plot has both sources, and the difference would be empty.
        large = roles.alerts(spark, d).filter(F.col("area_ha") > 50)
        return al.source_sets(
            large.filter(F.col("source") == "error"), large.filter(F.col("source") == "purchase"), op
        )

    return run


def monitoring_gaps(spark: SparkSession, d: str) -> DataFrame:
    days = al.calendar(roles.plots(spark, d), "2024-01-01", "2024-01-31")
    return al.monitoring_gaps(roles.alerts(spark, d), days)


def top_alerts(spark: SparkSession, d: str) -> DataFrame:
    return al.top_alerts(roles.alerts(spark, d), 3).select("plot_id", "alert_id", "area_ha")


# Alerts, streaming


def alert_stream(spark: SparkSession, d: str) -> DataFrame:
    """The stored events as a stream; the glob keeps the other tables of the folder out."""
    events = (
        spark.readStream.schema(roles.SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(d)
    )
    return roles.as_alerts(events)


def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return drain(live.stream_tumbling(alert_stream(spark, d), "1 day", "1 day"), "tumbling")


def stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    return drain(live.stream_sliding(alert_stream(spark, d), "2 days", "1 day", "1 day"), "sliding")


def stream_incidents(spark: SparkSession, d: str) -> DataFrame:
    return drain(live.stream_incidents(alert_stream(spark, d), "2 hours", "1 day"), "incidents")


def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    twice = alert_stream(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return drain(live.stream_dedup(twice, ["alert_id"], "31 days"), "dedup").select("alert_id", "plot_id", "ts", "area_ha")


def stream_enrich(spark: SparkSession, d: str) -> DataFrame:
    newest = quality.latest_version(
        roles.tenures(spark, d).select("plot_id", "holder_id", "valid_from"), ["plot_id"], ["valid_from", "holder_id"]
    )
    facts = roles.plot_admin(spark, d).join(newest, "plot_id", "left")
    out = drain(live.stream_enrich(alert_stream(spark, d), facts, salts=4), "enrich")
    return out.select("alert_id", "plot_id", "admin1", "admin2", F.coalesce("holder_id", F.lit(-1)).alias("holder_id"))


def stream_confirm(spark: SparkSession, d: str) -> DataFrame:
    errors = alert_stream(spark, d).filter(F.col("source") == "error")
    purchases = alert_stream(spark, d).filter(F.col("source") == "purchase")
    out = drain(live.stream_confirm(errors, purchases, "6 HOURS", "1 day", salts=4), "confirm")
    return out.select("alert_id", "plot_id", "ts")


def stream_confirm_closed(spark: SparkSession, d: str) -> DataFrame:
    errors = alert_stream(spark, d).filter(F.col("source") == "error")
    purchases = alert_stream(spark, d).filter(F.col("source") == "purchase")
    out = drain(live.stream_confirm_closed(errors, purchases, 6 * HOUR, "1 day"), "confirm-closed")
    return out.select("alert_id", "plot_id", "ts")


def stream_status(spark: SparkSession, d: str) -> DataFrame:
    return drain_upserts(live.stream_status(alert_stream(spark, d), 1000.0), "status", ["plot_id"])


def stream_sink(spark: SparkSession, d: str) -> DataFrame:
    counts = live.stream_tumbling(alert_stream(spark, d), "1 day", "1 day")
    return drain_upserts(counts, "sink", ["win_start", "win_end", "source"])


# Supply chain


def edge_totals(spark: SparkSession, d: str) -> DataFrame:
    return chain.edge_totals(roles.movements(spark, d))


def _lots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lots = roles.table(spark, d, "part").select(F.col("p_partkey").alias("lot_id"), "p_brand")
    return lots, roles.movements(spark, d).filter(F.col("moved_on") >= F.lit("2001-06-01").cast("date"))


def linked_lots(spark: SparkSession, d: str) -> DataFrame:
    return chain.linked_lots(*_lots(spark, d))


def unlinked_lots(spark: SparkSession, d: str) -> DataFrame:
    return chain.unlinked_lots(*_lots(spark, d))


def _main_routes(spark: SparkSession, d: str) -> DataFrame:
    totals = chain.edge_totals(roles.nation_movements(spark, d))
    best = totals.groupBy("src").agg(F.max_by("dst", F.struct("qty", -F.col("dst"))).alias("dst"))
    return best.filter(F.col("src") != F.col("dst"))


def reach(spark: SparkSession, d: str) -> DataFrame:
    return chain.reach(_main_routes(spark, d), 8)


def reach_dense(spark: SparkSession, d: str) -> DataFrame:
    return chain.reach(roles.nation_movements(spark, d).select("src", "dst"), 8)


def reach_from(spark: SparkSession, d: str) -> DataFrame:
    """From the sites of one region along all movements."""
    origins = roles.sites(spark, d).filter(F.col("admin1") == "AMERICA").select(F.col("site_id").alias("origin"))
    return chain.reach_from(roles.movements(spark, d), 3, origins)


def reach_counts(spark: SparkSession, d: str) -> DataFrame:
    """From all sites along all movements."""
    origins = roles.table(spark, d, "supplier").select(F.col("s_suppkey").alias("origin"))
    return chain.reach_counts(roles.movements(spark, d), 3, origins)


def exposure(spark: SparkSession, d: str) -> DataFrame:
    flagged = roles.table(spark, d, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("node"),
        F.when(F.col("n_regionkey") == 1, 1).otherwise(0).alias("own"),
    )
    return _rounded(chain.exposure(roles.nation_movements(spark, d), flagged, 3), 9, "exposure")


def mass_balance(spark: SparkSession, d: str) -> DataFrame:
    return chain.mass_balance(roles.nation_movements(spark, d))


def origin_completeness(spark: SparkSession, d: str) -> DataFrame:
    known = roles.sites(spark, d).filter(F.col("admin1").isin("AFRICA", "ASIA"))
    return chain.origin_completeness(roles.movements(spark, d), known)


def hop_delay(spark: SparkSession, d: str) -> DataFrame:
    return chain.hop_delay(roles.movements(spark, d)).withColumn("delay_days", F.coalesce("delay_days", F.lit(-1)))


# Evidence products


def _status(spark: SparkSession, d: str) -> DataFrame:
    recent = roles.observations(spark, d).filter(F.col("obs_date") > F.lit("2001-01-31").cast("date"))
    lost = forest.loss_after_cutoff(recent.filter(F.col("cls") == "R"), "2001-03-31")
    return evidence.technical_status(roles.plots(spark, d), recent, lost, roles.alerts(spark, d), 40.0)


def technical_status(spark: SparkSession, d: str) -> DataFrame:
    return _status(spark, d)


def dossier(spark: SparkSession, d: str) -> DataFrame:
    status = _status(spark, d).select("plot_id", "status")
    made = evidence.dossier(status, roles.alerts(spark, d), roles.movements(spark, d), page_rows=50)
    return made.select("plot_id", "page", "document")


def review_sample(spark: SparkSession, d: str) -> DataFrame:
    return evidence.review_sample(roles.alerts(spark, d), "alert_id", ["source"], 25, "round-1").select(
        "source", "alert_id", "ticket"
    )


def _checked(spark: SparkSession, d: str) -> DataFrame:
    return roles.table(spark, d, "labels").select("doc_id", F.col("quality").alias("mapped"), F.col("toxic").alias("truth"))


def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return evidence.confusion_matrix(_checked(spark, d))


def accuracy_report(spark: SparkSession, d: str) -> DataFrame:
    checked = _checked(spark, d)
    sizes = roles.table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("area"))
    report = evidence.accuracy_report(checked, checked.join(sizes, "doc_id").select("mapped", "area"))
    return _rounded(report, 6, "users_accuracy", "producers_accuracy", "area_estimate", "area_std_error")


def entry(spark: SparkSession, d: str) -> DataFrame:
    """Observed area per plot beside what was lost before and after the cut-off."""
    lost = forest.loss_after_cutoff(_loss(spark, d), CUTOFF)
    return zonal_stats(spark, d).join(lost, "plot_id", "left")


_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        read_layer, read_layer_json, read_layer_parquet, read_layer_parquet_mixed, parse_polygons, validate_split, latest_version, manifest, run_diff, write_evidence,
        quality_report, quality_report_sketches, quality_report_percentiles,
        cell_id, cover_cells, within_distance_join, knn_join, bbox_overlap_join, polygon_area, cell_density, focal_stats,
        zonal_stats, zonal_stats_by_class, class_area, loss_after_cutoff, transition_matrix, annual_series,
        best_composite, rank_plots,
        classify_alerts, dedup_alerts, incidents, asof_tenure, tenure_join, confirm_alerts,
        monitoring_gaps, top_alerts,
        stream_tumbling, stream_sliding, stream_incidents, stream_dedup, stream_enrich, stream_confirm, stream_confirm_closed,
        stream_status, stream_sink,
        edge_totals, linked_lots, unlinked_lots, reach, reach_dense, reach_from, reach_counts, exposure, mass_balance, origin_completeness,
        hop_delay,
        technical_status, dossier, review_sample, confusion_matrix, accuracy_report,
    )
}
_QUERIES |= {
    "baseline_anomaly": _anomaly(),
    "baseline_anomaly_split": _anomaly(rows_per_chunk=20),  # so few that keys are cut
    "asof_state": _asof(),
    "asof_state_split": _asof(rows_per_chunk=8),
    "pip_join": _pip("inner", 0.1, 256),
    "pip_join_crowded": _pip("inner", 1.0, 16),  # wide cells, so that crowded ones are split
    "pip_join_left": _pip("left", 0.1, 256),
    "pip_join_semi": _pip("semi", 0.1, 256),
    "pip_join_anti": _pip("anti", 0.1, 256),
    "admin_rollup": _admin("rollup"),
    "admin_cube": _admin("cube"),
    "admin_each": _admin("each"),
    "source_sets_either": _set("either"),
    "source_sets_both": _set("both"),
    "source_sets_only_first": _set("only_first"),
}


def prepare(spark: SparkSession) -> None:
    """Applies those session settings that can still be set on a running session."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        prepare(spark)
        return plain(query(spark, d))

    return run


def queries() -> dict[str, Query]:
    """All registered queries by name."""
    return {name: _registered(query) for name, query in _QUERIES.items()} | {"entry": _registered(entry)}
