"""Expected results of the registered queries as plain SQL over the stored tables.

Each statement states the result directly (every edge of every plot, every pair, every row in
order) and shares no plan with the operator it checks.
"""

from __future__ import annotations

R = 6371008.8


def _coord(base: int, key: str, step: int, span: int) -> str:
    return f"CAST({base} AS DOUBLE) + CAST({key}*{step} % {span} AS DOUBLE)/CAST({span // 10} AS DOUBLE)"


def _metres(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    half_lat = f"sin(radians({lat2} - {lat1})/2.0::DOUBLE)"
    half_lon = f"sin(radians({lon2} - {lon1})/2.0::DOUBLE)"
    h = f"{half_lat}*{half_lat} + cos(radians({lat1}))*cos(radians({lat2}))*{half_lon}*{half_lon}"
    return f"round({2 * R}::DOUBLE * asin(sqrt(least(1.0::DOUBLE, {h}))), 3)"


def _day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def _time(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


ROLES = f"""
WITH RECURSIVE site AS (
  SELECT s_suppkey AS site_id, r_name AS admin1, n_name AS admin2,
         {_coord(-65, "s_suppkey", 37, 1000)} AS lon, {_coord(-35, "s_suppkey", 61, 1000)} AS lat
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
plot AS (
  SELECT c_custkey AS plot_id, {_coord(-65, "c_custkey", 37, 1000)} AS cx, {_coord(-35, "c_custkey", 61, 1000)} AS cy,
         CAST(c_custkey % 5 + 1 AS DOUBLE)/CAST(50 AS DOUBLE) AS h
  FROM customer),
vertex AS (
  SELECT plot_id, 0 AS no, cx-h AS x, cy-h AS y FROM plot UNION ALL
  SELECT plot_id, 1, cx+h, cy-h FROM plot UNION ALL
  SELECT plot_id, 2, cx+h, cy+h FROM plot UNION ALL
  SELECT plot_id, 3, cx, cy FROM plot UNION ALL
  SELECT plot_id, 4, cx-h, cy+h FROM plot),
edge AS (
  SELECT a.plot_id, a.no, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_
  FROM vertex a JOIN vertex b ON a.plot_id = b.plot_id AND b.no = (a.no + 1) % 5),
box AS (
  SELECT plot_id, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM vertex GROUP BY plot_id),
plot_admin AS (
  SELECT c_custkey AS plot_id, r_name AS admin1, n_name AS admin2
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
alert AS (
  SELECT event_id AS alert_id, ts, user_id AS plot_id, event_type AS source, CAST(value AS DECIMAL(18,4)) AS area_ha,
         {_coord(-65, "event_id", 7919, 100000)} AS lon, {_coord(-35, "event_id", 104729, 100000)} AS lat
  FROM events),
observation AS (
  SELECT o_custkey AS plot_id, CAST(l_shipdate AS DATE) AS obs_date, l_returnflag AS cls,
         CAST(l_quantity AS DECIMAL(18,4)) AS area_ha
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
loss AS (SELECT * FROM observation WHERE cls = 'R'),
movement AS (
  SELECT l_suppkey AS src, o_custkey AS dst, CAST(o_orderdate AS DATE) AS moved_on, l_partkey AS lot_id,
         CAST(l_quantity AS DECIMAL(18,4)) AS qty
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
nation_movement AS (
  SELECT CAST(s_nationkey AS BIGINT) AS src, CAST(c_nationkey AS BIGINT) AS dst, moved_on, lot_id, qty
  FROM movement JOIN supplier ON src = s_suppkey JOIN customer ON dst = c_custkey),
tenure AS (
  SELECT o_custkey AS plot_id, o_orderkey AS holder_id, o_orderdate AS valid_from,
         lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to
  FROM orders)
"""


def _pip(select: str, tail: str) -> str:
    return f""", hit AS (
  SELECT a.alert_id, e.plot_id FROM alert a JOIN edge e
    ON (e.ay > a.lat) <> (e.by_ > a.lat)
   AND a.lon < (e.bx - e.ax)*(a.lat - e.ay)/nullif(e.by_ - e.ay, 0) + e.ax
  GROUP BY a.alert_id, e.plot_id HAVING count(*) % 2 = 1)
SELECT {select} FROM {tail}"""


_TUMBLING = """
SELECT strftime(win_start, '%Y-%m-%d %H:%M:%S.%f') AS win_start, strftime(win_end, '%Y-%m-%d %H:%M:%S.%f') AS win_end,
       source, count(*) AS n_alerts, CAST(sum(area_ha) AS DOUBLE) AS area_ha
FROM (SELECT *, time_bucket(INTERVAL '1 day', ts) AS win_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS win_end FROM alert)
"""

_CLOSED = "(SELECT max(ts) - INTERVAL '1 day' FROM alert)"

_INCIDENT = """, marked AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '2 hours' THEN 0 ELSE 1 END AS starts FROM alert
  WINDOW w AS (PARTITION BY plot_id ORDER BY ts, alert_id)),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY plot_id ORDER BY ts, alert_id ROWS UNBOUNDED PRECEDING) AS incident_no FROM marked)
"""

_ADMIN = """, lost AS (SELECT plot_id, sum(area_ha) AS area_ha FROM loss GROUP BY plot_id),
placed AS (SELECT * FROM lost JOIN plot_admin USING (plot_id))
SELECT coalesce(admin1, '(all)') AS admin1, coalesce(admin2, '(all)') AS admin2,
       CAST(grouping(admin1, admin2) AS BIGINT) AS level_id, CAST(sum(area_ha) AS DOUBLE) AS total, count(*) AS n_rows
FROM placed GROUP BY """

_STATUS = """, recent AS (SELECT * FROM observation WHERE obs_date > DATE '2001-01-31'),
seen AS (SELECT plot_id, count(*) AS n_obs FROM recent GROUP BY plot_id),
lost AS (SELECT plot_id, sum(CASE WHEN obs_date > DATE '2001-03-31' THEN area_ha ELSE 0 END) AS area_after
         FROM recent WHERE cls = 'R' GROUP BY plot_id),
alerted AS (SELECT plot_id, count(*) AS n_alerts FROM alert GROUP BY plot_id),
status AS (
  SELECT plot_id, coalesce(n_obs, 0) AS n_obs, CAST(coalesce(area_after, 0) AS DOUBLE) AS area_after,
         coalesce(n_alerts, 0) AS n_alerts,
         CASE WHEN n_obs IS NULL THEN 'insufficient_data'
              WHEN coalesce(area_after, 0) >= 40 OR n_alerts > 0 THEN 'signal' ELSE 'no_signal' END AS status
  FROM plot LEFT JOIN seen USING (plot_id) LEFT JOIN lost USING (plot_id) LEFT JOIN alerted USING (plot_id))
"""

_SETS = """, large AS (SELECT * FROM alert WHERE area_ha > 50)
SELECT plot_id FROM large WHERE source = 'error' {op} SELECT plot_id FROM large WHERE source = 'purchase'"""

_ZONAL = """
SELECT {zone}, count(area_ha) AS n_obs, count(*) - count(area_ha) AS n_null, CAST(sum(area_ha) AS DOUBLE) AS total, CAST(min(area_ha) AS DOUBLE) AS smallest,
       CAST(max(area_ha) AS DOUBLE) AS largest, median(CAST(area_ha AS DOUBLE)) AS median,
       CAST(sum(area_ha) AS DOUBLE)/CAST(count(area_ha) AS DOUBLE) AS mean
FROM observation GROUP BY {zone}"""

_LOSS = """
SELECT plot_id, CAST(sum(CASE WHEN obs_date > DATE '2000-12-31' THEN 0 ELSE area_ha END) AS DOUBLE) AS area_before,
       CAST(sum(CASE WHEN obs_date > DATE '2000-12-31' THEN area_ha ELSE 0 END) AS DOUBLE) AS area_after,
       CAST(sum(CASE WHEN obs_date > DATE '2000-12-31' THEN area_ha ELSE 0 END) AS DOUBLE)
         / nullif(CAST(sum(area_ha) AS DOUBLE), 0) AS share_after
FROM loss GROUP BY plot_id"""

_RASTER = """, raster AS (
  SELECT CAST(floor(lon/{deg}::DOUBLE) AS BIGINT) AS cx, CAST(floor(lat/{deg}::DOUBLE) AS BIGINT) AS cy, ts AS obs_ts,
         alert_id AS obs_id, source AS cls, area_ha, CAST(floor(area_ha) AS BIGINT) AS quality FROM alert)
"""

_EXPOSURE_STEP = """, e{t} AS (
  SELECT b.node, b.own + (1 - b.own) * coalesce(sum(s.share * p.exposure), 0) AS exposure
  FROM base b LEFT JOIN share s ON s.dst = b.node LEFT JOIN e{p} p ON p.node = s.src GROUP BY b.node, b.own)"""


def oracle_sql() -> dict[str, str]:
    """Expected result by query name."""
    body = {
        "read_layer": """
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, '' AS bad_row FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT -1, -1, CAST(c_custkey AS VARCHAR) || ',' || c_mktsegment FROM customer WHERE c_acctbal < 0""",
        "read_layer_json": """
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, '' AS bad_row FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT -1, -1, '{"c_custkey":' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0""",
        "read_layer_parquet": """
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, '' AS bad_row FROM customer""",
        "read_layer_parquet_mixed": """
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, '' AS bad_row FROM customer WHERE c_custkey % 3 = 0 OR c_acctbal >= 0
UNION ALL SELECT -1, -1, CASE c_custkey % 3 WHEN 1 THEN '{"c_custkey":' || c_custkey || ',"c_nationkey":"' || c_mktsegment || '"}'
  ELSE '{"c_custkey":' || c_custkey || ',"c_nationkey":' || c_nationkey || '.5}' END
FROM customer WHERE c_custkey % 3 > 0 AND c_acctbal < 0""",
        "parse_polygons": """
SELECT plot_id, CAST(0 AS BIGINT) AS ring_no, CAST(no AS BIGINT) AS vertex_no, x, y FROM vertex""",
        "validate_split": """
SELECT alert_id, concat_ws(',', CASE WHEN area_ha > 5 THEN NULL ELSE 'area_over_five' END,
  CASE WHEN source <> 'error' THEN NULL ELSE 'known_source' END, CASE WHEN lon < -58 THEN NULL ELSE 'west_of_58' END) AS reasons
FROM alert""",
        "latest_version": f"""
SELECT plot_id, source, alert_id, {_time("ts")} AS ts, CAST(area_ha AS DOUBLE) AS area_ha FROM alert
QUALIFY row_number() OVER (PARTITION BY plot_id, source ORDER BY ts DESC, alert_id DESC) = 1""",
        "manifest": """
, texts AS (SELECT concat_ws('|', length(a) || ':' || a, length(b) || ':' || b, length(c) || ':' || c, length(d) || ':' || d) AS t
  FROM (SELECT CAST(plot_id AS VARCHAR) AS a, CAST(obs_date AS VARCHAR) AS b, cls AS c, CAST(area_ha AS VARCHAR) AS d FROM observation))
SELECT 'observation' AS dataset, count(*) AS n_rows,
       CAST(sum(CAST('0x' || substr(sha256(t), 1, 15) AS BIGINT)) AS VARCHAR) AS checksum, '2000-12-31' AS cutoff FROM texts""",
        "run_diff": """
, old AS (SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal >= 0),
new AS (SELECT c_custkey, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOUSEHOLD' ELSE c_mktsegment END AS c_mktsegment
        FROM customer WHERE c_acctbal < 9000),
joined AS (
  SELECT o.c_custkey AS ok, o.c_nationkey AS on_, o.c_mktsegment AS os, n.c_custkey AS nk, n.c_nationkey AS nn, n.c_mktsegment AS ns,
         CASE WHEN o.c_custkey IS NULL THEN 'added' WHEN n.c_custkey IS NULL THEN 'removed' ELSE 'changed' END AS change
  FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey
  WHERE (o.c_nationkey, o.c_mktsegment) IS DISTINCT FROM (n.c_nationkey, n.c_mktsegment))
SELECT ok AS c_custkey, CAST(on_ AS BIGINT) AS c_nationkey, os AS c_mktsegment, change, 'old' AS side, CAST(1 AS BIGINT) AS copies
FROM joined WHERE ok IS NOT NULL
UNION ALL SELECT nk, CAST(nn AS BIGINT), ns, change, 'new', 1 FROM joined WHERE nk IS NOT NULL""",
        "write_evidence": f"""
SELECT plot_id, {_day("obs_date")} AS obs_date, cls, CAST(area_ha AS DOUBLE) AS area_ha FROM observation""",
        "quality_report": "\n"
        + "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
            f"CAST(min({c}) AS VARCHAR) AS smallest, CAST(max({c}) AS VARCHAR) AS largest FROM orders"
            for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        ),
        "quality_report_sketches": "\n"
        + "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, TRUE AS close FROM orders"
            for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        ),
        "quality_report_percentiles": "\n"
        + "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, {p}::DOUBLE AS percentile, count({c}) AS n_values, TRUE AS within FROM orders"
            for c in ("o_orderkey", "o_custkey", "o_totalprice")
            for p in (0.01, 0.25, 0.5, 0.75, 0.99)
        ),
        "cell_id": """
SELECT alert_id, CAST(floor(lon/0.5::DOUBLE) AS BIGINT) AS cx, CAST(floor(lat/0.5::DOUBLE) AS BIGINT) AS cy FROM alert""",
        "cover_cells": """
SELECT plot_id, cx, cy FROM (
  SELECT plot_id, unnest(range(CAST(floor(xmin/0.1::DOUBLE) AS BIGINT), CAST(floor(xmax/0.1::DOUBLE) AS BIGINT) + 1)) AS cx, ymin, ymax FROM box),
  unnest(range(CAST(floor(ymin/0.1::DOUBLE) AS BIGINT), CAST(floor(ymax/0.1::DOUBLE) AS BIGINT) + 1)) AS u(cy)""",
        "pip_join": _pip("alert_id, lon, lat, plot_id", "hit JOIN (SELECT alert_id, lon, lat FROM alert) USING (alert_id)"),
        "pip_join_left": _pip("alert_id, lon, lat, plot_id", "(SELECT alert_id, lon, lat FROM alert) LEFT JOIN hit USING (alert_id)"),
        "pip_join_semi": _pip("alert_id, lon, lat", "alert WHERE alert_id IN (SELECT alert_id FROM hit)"),
        "pip_join_anti": _pip("alert_id, lon, lat", "alert WHERE alert_id NOT IN (SELECT alert_id FROM hit)"),
        "within_distance_join": f"""
, pairs AS (SELECT plot_id AS a_id, site_id AS b_id, {_metres("cx", "cy", "lon", "lat")} AS metres FROM plot, site)
SELECT * FROM pairs WHERE metres <= 60000""",
        "knn_join": f"""
, pairs AS (SELECT plot_id AS a_id, site_id AS b_id, {_metres("cx", "cy", "lon", "lat")} AS metres FROM plot, site)
SELECT a_id, b_id, metres, row_number() OVER (PARTITION BY a_id ORDER BY metres, b_id) AS rank_no FROM pairs
QUALIFY rank_no <= 3""",
        "bbox_overlap_join": """
SELECT a.plot_id AS a_plot_id, b.plot_id AS b_plot_id FROM box a JOIN box b
ON a.plot_id < b.plot_id AND a.xmin <= b.xmax AND b.xmin <= a.xmax AND a.ymin <= b.ymax AND b.ymin <= a.ymax""",
        "polygon_area": f"""
, flat AS (
  SELECT plot_id, {R}::DOUBLE*radians(ax - x0) AS px, {R}::DOUBLE*(sin(radians(ay)) - sin(radians(y0))) AS py,
         {R}::DOUBLE*radians(bx - x0) AS qx, {R}::DOUBLE*(sin(radians(by_)) - sin(radians(y0))) AS qy
  FROM edge JOIN (SELECT plot_id, x AS x0, y AS y0 FROM vertex WHERE no = 0) USING (plot_id))
SELECT plot_id, round(abs(sum(px*qy - qx*py))/2/10000, 4) AS area_ha FROM flat GROUP BY plot_id""",
        "cell_density": """
SELECT CAST(floor(lon/0.5::DOUBLE) AS BIGINT) AS cx, CAST(floor(lat/0.5::DOUBLE) AS BIGINT) AS cy, count(*) AS n_points
FROM alert GROUP BY 1, 2 ORDER BY n_points DESC, cx, cy LIMIT 20""",
        "focal_stats": _RASTER.format(deg="0.25")
        + """, cells AS (SELECT cx, cy, sum(area_ha) AS area, count(*) AS n FROM raster GROUP BY cx, cy)
SELECT a.cx, a.cy, CAST(sum(b.area) AS DOUBLE) AS focal_sum, CAST(sum(b.n) AS BIGINT) AS focal_n,
       CAST(sum(b.area) AS DOUBLE)/CAST(sum(b.n) AS DOUBLE) AS focal_mean
FROM cells a JOIN cells b ON b.cx BETWEEN a.cx - 2 AND a.cx + 2 AND b.cy BETWEEN a.cy - 2 AND a.cy + 2 GROUP BY a.cx, a.cy""",
        "zonal_stats": _ZONAL.format(zone="plot_id"),
        "zonal_stats_by_class": _ZONAL.format(zone="cls"),
        "class_area": """
SELECT plot_id, CAST(coalesce(sum(area_ha) FILTER (cls = 'A'), 0) AS DOUBLE) AS area_a,
       CAST(coalesce(sum(area_ha) FILTER (cls = 'N'), 0) AS DOUBLE) AS area_n,
       CAST(coalesce(sum(area_ha) FILTER (cls = 'R'), 0) AS DOUBLE) AS area_r
FROM observation GROUP BY plot_id""",
        "loss_after_cutoff": _LOSS,
        "transition_matrix": """
SELECT from_cls, cls AS to_cls, count(*) AS n_steps FROM (
  SELECT cls, lag(cls) OVER (PARTITION BY plot_id ORDER BY obs_date, cls) AS from_cls FROM observation)
WHERE from_cls IS NOT NULL GROUP BY from_cls, cls""",
        "annual_series": """
, yearly AS (SELECT plot_id, CAST(year(obs_date) AS BIGINT) AS year, sum(area_ha) AS area FROM loss GROUP BY 1, 2),
days AS (SELECT plot_id, unnest(range(min(year), max(year) + 1)) AS year FROM yearly GROUP BY plot_id)
SELECT plot_id, year, CAST(coalesce(area, 0) AS DOUBLE) AS area_ha,
       CAST(sum(coalesce(area, 0)) OVER (PARTITION BY plot_id ORDER BY year) AS DOUBLE) AS running_ha
FROM days LEFT JOIN yearly USING (plot_id, year)""",
        "baseline_anomaly": """
, based AS (
  SELECT alert_id, plot_id, CAST(area_ha AS DOUBLE) AS value, avg(CAST(area_ha AS DOUBLE)) OVER w AS m,
         CASE WHEN count(*) OVER w > 1 THEN stddev_samp(CAST(area_ha AS DOUBLE)) OVER w END AS s
  FROM alert WINDOW w AS (PARTITION BY plot_id ORDER BY ts, alert_id ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT alert_id, plot_id, value, round(m, 6) AS base_mean, round(s, 6) AS base_std, round((value - m)/nullif(s, 0), 6) AS z_score
FROM based""",
        "best_composite": _RASTER.format(deg="0.5")
        + f"""
SELECT cx, cy, {_time("period")} AS period, obs_id, quality, cls, CAST(area_ha AS DOUBLE) AS area_ha
FROM (SELECT *, CAST(date_trunc('week', obs_ts) AS TIMESTAMP) AS period FROM raster)
QUALIFY row_number() OVER (PARTITION BY cx, cy, period ORDER BY quality DESC, obs_ts DESC, obs_id DESC) = 1""",
        "admin_rollup": _ADMIN + "ROLLUP (admin1, admin2)",
        "admin_cube": _ADMIN + "CUBE (admin1, admin2)",
        "admin_each": _ADMIN + "GROUPING SETS ((admin1), (admin2))",
        "rank_plots": """
, lost AS (SELECT plot_id, sum(area_ha) AS area_ha FROM loss GROUP BY plot_id)
SELECT admin1, CAST(area_ha AS DOUBLE) AS area_ha, plot_id,
       row_number() OVER (PARTITION BY admin1 ORDER BY area_ha DESC, plot_id) AS row_no,
       rank() OVER (PARTITION BY admin1 ORDER BY area_ha DESC) AS rank_no,
       dense_rank() OVER (PARTITION BY admin1 ORDER BY area_ha DESC) AS dense_no,
       percent_rank() OVER (PARTITION BY admin1 ORDER BY area_ha DESC) AS percent_no,
       ntile(4) OVER (PARTITION BY admin1 ORDER BY area_ha DESC, plot_id) AS tile_no
FROM lost JOIN plot_admin USING (plot_id)""",
        "classify_alerts": """
SELECT alert_id, source, CAST(area_ha AS DOUBLE) AS area_ha,
       CASE WHEN area_ha IS NULL THEN 'unknown' WHEN area_ha >= 100 OR (area_ha >= 50 AND source IN ('error', 'purchase')) THEN 'severe'
            WHEN area_ha >= 20 THEN 'moderate' ELSE 'low' END AS severity FROM alert""",
        "dedup_alerts": f"""
SELECT plot_id, source, {_day("ts")} AS day, alert_id, {_time("ts")} AS ts FROM alert
QUALIFY row_number() OVER (PARTITION BY plot_id, source, CAST(alert.ts AS DATE) ORDER BY alert.ts, alert_id) = 1""",
        "incidents": _INCIDENT
        + f"""
SELECT plot_id, CAST(incident_no AS BIGINT) AS incident_no, {_time("min(ts)")} AS started, {_time("max(ts)")} AS ended,
       count(*) AS n_alerts, CAST(sum(area_ha) AS DOUBLE) AS area_ha
FROM numbered GROUP BY plot_id, incident_no""",
        "asof_state": f"""
, e AS (SELECT * FROM alert WHERE source = 'error'),
s AS (SELECT plot_id AS sp, ts AS sts, alert_id AS state_id, area_ha AS sa FROM alert WHERE source = 'signup')
SELECT alert_id, plot_id, {_time("ts")} AS ts, CAST(area_ha AS DOUBLE) AS area_ha, {_time("sts")} AS state_ts, state_id,
       CAST(sa AS DOUBLE) AS state_area_ha
FROM e LEFT JOIN s ON plot_id = sp AND sts <= ts
QUALIFY row_number() OVER (PARTITION BY alert_id ORDER BY s.sts DESC NULLS LAST, state_id DESC) = 1""",
        "asof_tenure": """
, obs AS (SELECT row_number() OVER () AS n, plot_id, CAST(obs_date AS TIMESTAMP) AS ts, area_ha FROM observation),
found AS (
  SELECT n, obs.plot_id, area_ha, holder_id FROM obs LEFT JOIN tenure t ON t.plot_id = obs.plot_id AND t.valid_from <= ts
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY t.valid_from DESC NULLS LAST, holder_id DESC) = 1)
SELECT plot_id, coalesce(holder_id, -1) AS holder_id, count(*) AS n_obs, CAST(sum(area_ha) AS DOUBLE) AS area_ha
FROM found GROUP BY 1, 2""",
        "tenure_join": f"""
SELECT o.plot_id, {_day("obs_date")} AS obs_date, CAST(area_ha AS DOUBLE) AS area_ha, coalesce(holder_id, -1) AS holder_id
FROM observation o LEFT JOIN tenure t
  ON o.plot_id = t.plot_id AND valid_from <= CAST(obs_date AS TIMESTAMP) AND (valid_to IS NULL OR CAST(obs_date AS TIMESTAMP) < valid_to)""",
        "confirm_alerts": f"""
SELECT alert_id, plot_id, {_time("ts")} AS ts FROM alert a WHERE source = 'error' AND EXISTS (
  SELECT 1 FROM alert b WHERE b.source = 'purchase' AND b.plot_id = a.plot_id
    AND b.ts BETWEEN a.ts - INTERVAL '6 hours' AND a.ts + INTERVAL '6 hours')""",
        "source_sets_either": _SETS.format(op="UNION"),
        "source_sets_both": _SETS.format(op="INTERSECT"),
        "source_sets_only_first": _SETS.format(op="EXCEPT"),
        "monitoring_gaps": f"""
, days AS (SELECT plot_id, CAST(d AS DATE) AS day FROM plot,
  (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL '1 day')) AS d))
SELECT plot_id, {_day("day")} AS day FROM days
WHERE NOT EXISTS (SELECT 1 FROM alert a WHERE a.plot_id = days.plot_id AND CAST(a.ts AS DATE) = days.day)""",
        "top_alerts": """
SELECT plot_id, alert_id, CAST(area_ha AS DOUBLE) AS area_ha FROM alert
QUALIFY row_number() OVER (PARTITION BY plot_id ORDER BY alert.area_ha DESC, alert_id) <= 3""",
        "stream_tumbling": _TUMBLING + f"WHERE win_end <= {_CLOSED} GROUP BY ALL",
        "stream_sliding": f"""
SELECT {_time("win_start")} AS win_start, {_time("win_end")} AS win_end, source, count(*) AS n_alerts,
       CAST(sum(area_ha) AS DOUBLE) AS area_ha
FROM (SELECT *, win_start + INTERVAL '2 days' AS win_end FROM (
  SELECT *, CAST(time_bucket(INTERVAL '1 day', ts) - k * INTERVAL '1 day' AS TIMESTAMP) AS win_start FROM alert, (SELECT unnest([0, 1]) AS k)))
WHERE win_end <= {_CLOSED} GROUP BY ALL""",
        "stream_incidents": _INCIDENT
        + f"""
SELECT plot_id, {_time("min(ts)")} AS started, {_time("max(ts)")} AS ended, count(*) AS n_alerts,
       CAST(sum(area_ha) AS DOUBLE) AS area_ha
FROM numbered GROUP BY plot_id, incident_no HAVING max(ts) + INTERVAL '2 hours' <= {_CLOSED}""",
        "stream_dedup": f"""
SELECT alert_id, plot_id, {_time("ts")} AS ts, CAST(area_ha AS DOUBLE) AS area_ha FROM alert""",
        "stream_enrich": """
, newest AS (SELECT plot_id, holder_id FROM tenure
  QUALIFY row_number() OVER (PARTITION BY plot_id ORDER BY valid_from DESC, holder_id DESC) = 1)
SELECT alert_id, a.plot_id, admin1, admin2, coalesce(holder_id, -1) AS holder_id
FROM alert a LEFT JOIN plot_admin p ON a.plot_id = p.plot_id LEFT JOIN newest n ON a.plot_id = n.plot_id""",
        "stream_confirm_closed": f"""
, closed AS (SELECT * FROM alert WHERE source = 'purchase' AND time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours'
  <= (SELECT least(max(ts) FILTER (source = 'error'), max(ts) FILTER (source = 'purchase')) - INTERVAL '1 day' FROM alert))
SELECT alert_id, plot_id, {_time("ts")} AS ts FROM alert a WHERE source = 'error' AND EXISTS (
  SELECT 1 FROM closed b WHERE b.plot_id = a.plot_id AND b.ts BETWEEN a.ts - INTERVAL '6 hours' AND a.ts + INTERVAL '6 hours')""",
        "stream_status": f"""
SELECT plot_id, count(*) AS n_alerts, CAST(sum(area_ha) AS DOUBLE) AS area_ha, {_time("max(ts)")} AS last_ts,
       arg_max(source, ts) AS last_source, CASE WHEN sum(area_ha) >= 1000 THEN 'active' ELSE 'watch' END AS status
FROM alert GROUP BY plot_id""",
        "stream_sink": _TUMBLING + "GROUP BY ALL",
        "edge_totals": f"""
SELECT src, dst, CAST(sum(qty) AS DOUBLE) AS qty, count(DISTINCT lot_id) AS n_lots, {_day("min(moved_on)")} AS first_on,
       {_day("max(moved_on)")} AS last_on FROM movement GROUP BY src, dst""",
        "linked_lots": """
SELECT p_partkey AS lot_id, p_brand FROM part
WHERE p_partkey IN (SELECT lot_id FROM movement WHERE moved_on >= DATE '2001-06-01')""",
        "unlinked_lots": """
SELECT p_partkey AS lot_id, p_brand FROM part
WHERE p_partkey NOT IN (SELECT lot_id FROM movement WHERE moved_on >= DATE '2001-06-01')""",
        "reach": """
, totals AS (SELECT src, dst, sum(qty) AS qty FROM nation_movement GROUP BY src, dst),
route AS (SELECT src, dst FROM (SELECT * FROM totals QUALIFY row_number() OVER (PARTITION BY src ORDER BY qty DESC, dst) = 1) WHERE src <> dst),
walk AS (SELECT src, dst, 1 AS depth FROM route
  UNION SELECT w.src, r.dst, w.depth + 1 FROM walk w JOIN route r ON w.dst = r.src WHERE w.depth < 8)
SELECT src AS origin, dst AS node, CAST(min(depth) AS BIGINT) AS depth FROM walk GROUP BY src, dst""",
        "reach_dense": """
, route AS (SELECT DISTINCT src, dst FROM nation_movement),
walk AS (SELECT src, dst, 1 AS depth FROM route
  UNION SELECT w.src, r.dst, w.depth + 1 FROM walk w JOIN route r ON w.dst = r.src WHERE w.depth < 8)
SELECT src AS origin, dst AS node, CAST(min(depth) AS BIGINT) AS depth FROM walk GROUP BY src, dst""",
        "reach_from": """
, route AS (SELECT DISTINCT src, dst FROM movement),
walk AS (SELECT src, dst, 1 AS depth FROM route WHERE src IN (
    SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AMERICA')
  UNION SELECT w.src, r.dst, w.depth + 1 FROM walk w JOIN route r ON w.dst = r.src WHERE w.depth < 3)
SELECT src AS origin, dst AS node, CAST(min(depth) AS BIGINT) AS depth FROM walk GROUP BY src, dst""",
        "reach_counts": """
, route AS (SELECT DISTINCT src, dst FROM movement),
walk AS (SELECT src, dst, 1 AS depth FROM route
  UNION SELECT w.src, r.dst, w.depth + 1 FROM walk w JOIN route r ON w.dst = r.src WHERE w.depth < 3),
least_depth AS (SELECT src, dst, CAST(min(depth) AS BIGINT) AS depth FROM walk GROUP BY src, dst)
SELECT dst AS node, depth, count(*) AS n_origins FROM least_depth GROUP BY dst, depth""",
        "exposure": """
, totals AS (SELECT src, dst, CAST(sum(qty) AS DOUBLE) AS qty FROM nation_movement GROUP BY src, dst),
share AS (SELECT src, dst, qty/sum(qty) OVER (PARTITION BY dst) AS share FROM totals),
base AS (SELECT CAST(n_nationkey AS BIGINT) AS node, CASE WHEN n_regionkey = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS own FROM nation),
e0 AS (SELECT node, own AS exposure FROM base)"""
        + "".join(_EXPOSURE_STEP.format(t=t, p=t - 1) for t in (1, 2, 3))
        + "\nSELECT node, round(exposure, 9) AS exposure FROM e3",
        "mass_balance": """
, came AS (SELECT dst AS node, sum(qty) AS q FROM nation_movement GROUP BY dst),
went AS (SELECT src AS node, sum(qty) AS q FROM nation_movement GROUP BY src)
SELECT node, CAST(coalesce(came.q, 0) AS DOUBLE) AS qty_in, CAST(coalesce(went.q, 0) AS DOUBLE) AS qty_out,
       CAST(coalesce(came.q, 0) - coalesce(went.q, 0) AS DOUBLE) AS difference FROM came FULL JOIN went USING (node)""",
        "origin_completeness": """
SELECT dst, CAST(sum(qty) AS DOUBLE) AS qty,
       CAST(sum(CASE WHEN site_id IS NOT NULL THEN qty ELSE 0 END) AS DOUBLE) AS qty_known,
       CAST(sum(CASE WHEN site_id IS NOT NULL THEN qty ELSE 0 END) AS DOUBLE)/nullif(CAST(sum(qty) AS DOUBLE), 0) AS share_known
FROM movement LEFT JOIN (SELECT site_id FROM site WHERE admin1 IN ('AFRICA', 'ASIA')) ON src = site_id GROUP BY dst""",
        "hop_delay": f"""
, numbered AS (SELECT lot_id, moved_on, row_number() OVER (PARTITION BY lot_id, moved_on) AS nth,
  max(moved_on) OVER (PARTITION BY lot_id ORDER BY moved_on RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS before
  FROM movement)
SELECT lot_id, {_day("moved_on")} AS moved_on, nth,
       CASE WHEN nth > 1 THEN 0 ELSE CAST(coalesce(CAST(moved_on AS DATE) - CAST(before AS DATE), -1) AS BIGINT) END AS delay_days
FROM numbered""",
        "technical_status": _STATUS + "SELECT * FROM status",
        "dossier": _STATUS
        + """, entry AS (
  SELECT plot_id, CAST(ts AS DATE) AS on_day, 'alert' AS kind, alert_id AS ref, source AS note, area_ha AS amount FROM alert
  UNION ALL
  SELECT dst, min(moved_on), 'origin', src, 'site', CAST(sum(qty) AS DECIMAL(18,4)) FROM movement GROUP BY dst, src),
numbered AS (SELECT *, row_number() OVER (PARTITION BY plot_id ORDER BY on_day, kind, ref) AS no FROM entry),
pages AS (
  SELECT plot_id, (no - 1)//50 + 1 AS page,
         list(struct_pack(on_day := CAST(on_day AS VARCHAR), kind := kind, ref := ref, note := note, amount := CAST(amount AS VARCHAR)) ORDER BY no) AS entries
  FROM numbered GROUP BY 1, 2)
SELECT plot_id, coalesce(page, 1) AS page,
       CAST(to_json(struct_pack(plot_id := plot_id, page := coalesce(page, 1), status := status, entries := coalesce(entries, []))) AS VARCHAR) AS document
FROM status LEFT JOIN pages USING (plot_id)""",
        "review_sample": """
, drawn AS (SELECT source, alert_id, sha256(CAST(alert_id AS VARCHAR) || '|round-1') AS ticket FROM alert)
SELECT * FROM drawn QUALIFY row_number() OVER (PARTITION BY source ORDER BY ticket, alert_id) <= 25""",
        "confusion_matrix": """
SELECT CAST(quality AS BIGINT) AS mapped, CAST(toxic AS BIGINT) AS truth, count(*) AS n,
       CAST(count(*) AS DOUBLE)/CAST(sum(count(*)) OVER (PARTITION BY quality) AS DOUBLE) AS share_of_mapped,
       CAST(count(*) AS DOUBLE)/CAST(sum(count(*)) OVER (PARTITION BY toxic) AS DOUBLE) AS share_of_truth
FROM labels GROUP BY quality, toxic""",
        "accuracy_report": """
, n AS (SELECT quality AS i, toxic AS j, CAST(count(*) AS DOUBLE) AS n FROM labels GROUP BY 1, 2),
r AS (SELECT i, sum(n) AS n FROM n GROUP BY i),
w AS (SELECT quality AS i, CAST(sum(n_chars) AS DOUBLE) AS area FROM labels JOIN documents USING (doc_id) GROUP BY quality),
tot AS (SELECT sum(area) AS a FROM w),
c AS (SELECT n.i, n.j, n.n, area/a AS w, n.n/r.n AS s, r.n AS rn, a FROM n JOIN r ON n.i = r.i JOIN w ON n.i = w.i, tot)
SELECT CAST(j AS BIGINT) AS cls, CAST(sum(n) AS BIGINT) AS n_checked, round(max(s) FILTER (i = j), 6) AS users_accuracy,
       round(sum(w*s) FILTER (i = j)/sum(w*s), 6) AS producers_accuracy, round(sum(w*s)*max(a), 6) AS area_estimate,
       round(sqrt(sum(w*w*s*(1 - s)/(rn - 1)))*max(a), 6) AS area_std_error,
       j NOT IN (SELECT i FROM r) AND j IN (SELECT i FROM w) AS unsampled
FROM c GROUP BY j""",
    }
    body["baseline_anomaly_split"] = body["baseline_anomaly"]
    body["asof_state_split"] = body["asof_state"]
    body["pip_join_crowded"] = body["pip_join"]
    body["stream_confirm"] = body["confirm_alerts"]
    body["entry"] = f", z AS ({body['zonal_stats']}), l AS ({body['loss_after_cutoff']}) SELECT * FROM z LEFT JOIN l USING (plot_id)"
    return {name: ROLES.strip() + sql for name, sql in body.items()}
