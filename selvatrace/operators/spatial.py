"""Spatial joins as equi-joins on grid cells.

Spark plans a bare spatial predicate as a nested loop. Here one side is put into its single
grid cell and the other is copied to the cells it covers, so Spark joins on the cell, picks
broadcast or shuffle by measured size, and splits a hot cell at run time. The exact test
runs inside the join. Where one cell is crowded on the other side as well, the grid is made
finer there first.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from selvatrace.functions.geometry import (
    EARTH_RADIUS_M,
    area_ha,
    bounds,
    great_circle_m,
    inside,
    lon_reach_deg,
    metres_to_degrees,
    plot_edges,
)
from selvatrace.plans import grid
from selvatrace.plans.grid import cell
from selvatrace.plans.ordered import first_rows
from selvatrace.session import cut_lineage, stored

BOX_AXES = [("xmin", "xmax"), ("ymin", "ymax")]
JOIN_TYPES = {"inner": "inner", "left": "left", "semi": "left_semi", "anti": "left_anti"}


def cell_id(points: DataFrame, deg: float) -> DataFrame:
    """Adds the grid cell ``(cx, cy)`` of each point."""
    return points.withColumns({"cx": cell(F.col("lon"), deg), "cy": cell(F.col("lat"), deg)})


def cover_cells(plots: DataFrame, deg: float) -> DataFrame:
    """One row per plot and grid cell of its bounding box."""
    boxed = plots.select("plot_id", *bounds(F.col("rings")))
    cells = grid.touch(boxed, BOX_AXES, deg).select("plot_id", F.col("_c0").alias("cx"), F.col("_c1").alias("cy"))
    return cells.filter(F.col("cx").isNotNull())


def pip_join(
    points: DataFrame, plots: DataFrame, deg: float, how: str = "inner", crowd: int = 256, levels: int = grid.FINEST
) -> DataFrame:
    """Points joined to the plots that hold them: inner, left, semi or anti.

    A point has one leaf cell, so no pair can repeat. A row of the cover holds only the edges
    that matter in its cell: a ray runs right from the point, so an edge above, below or left
    of the cell cannot be crossed. Edges are sorted into rows of cells first and then into the
    cells of a row, so a plot of many thousand vertices is not copied whole to every cell, and
    costs a point only the edges level with its cell. The box test comes before ray casting and spares it for most
    candidates. A cell hot with points is split by Spark's skew join, which can split the left
    side of all four join types. Plots of one shape are one row of the cover, which holds their ids in blocks, so a shape is tested
    once however many plots have it; semi and anti joins need no ids. ``points`` carries ``lon`` and ``lat`` and no ``plot_id``;
    ``deg``, ``crowd`` and ``levels`` shape the grid and do not change the result.
    """
    shaped = plots.select("plot_id", "rings", F.md5(F.col("rings").cast("string")).alias("_shape"))
    if how in ("semi", "anti"):
        shapes = shaped.groupBy("_shape").agg(F.first("rings").alias("rings"))
    else:
        shapes = grid.in_blocks(shaped, ["_shape"], "plot_id", "rings")
    held = [c for c in shapes.columns if c == "_many"]
    boxed = shapes.select(*held, plot_edges(F.col("rings")).alias("_edges"), *bounds(F.col("rings")))

    def narrow(df: DataFrame, axis: int, width: float | Column) -> DataFrame:
        # One cell of slack on each side keeps rounding at a cell border from dropping an edge.
        if axis == 0:
            low, high = (F.col("_c0") - 1) * F.lit(width), (F.col("_c0") + 2) * F.lit(width)
            kept = F.filter("_edges", lambda e: (F.greatest(e.ay, e.by) >= low) & (F.least(e.ay, e.by) <= high))
        else:
            left = (F.col("_c1") - 1) * F.lit(width)
            kept = F.filter("_edges", lambda e: F.greatest(e.ax, e.bx) >= left)
        return df.withColumn("_edges", kept)

    rows_first = [("ymin", "ymax"), ("xmin", "xmax")]
    leaves, crowded = grid.cover(boxed, [], rows_first, deg, crowd, levels, narrow)
    holds = (
        grid.same_leaf(2)
        & F.col("lon").between(F.col("xmin"), F.col("xmax"))
        & F.col("lat").between(F.col("ymin"), F.col("ymax"))
        & inside(F.col("_edges"), F.col("lon"), F.col("lat"))
    )
    keyed = grid.leaf_of(points, [], [F.col("lat"), F.col("lon")], deg, crowded)
    joined = keyed.join(leaves, holds, JOIN_TYPES[how])
    joined = joined.drop(*grid.helper_columns(2), "xmin", "ymin", "xmax", "ymax", "_edges")
    if not held:
        return joined
    return joined.withColumn("plot_id", F.explode_outer("_many") if how == "left" else F.explode("_many")).drop("_many")


def within_distance_join(a: DataFrame, b: DataFrame, metres: float) -> DataFrame:
    """Pairs ``(a_id, b_id, metres)`` no further apart than ``metres``.

    Both sides are ``(id, lon, lat)``. Each point of ``b`` is copied to the cells its search
    circle touches, with the reach in longitude taken from its own latitude; pass the smaller
    side as ``b``. A cell is half a radius high and cells in the corners of the box are left
    out, so on even data a point of ``a`` is compared with less than twice its partners. It has
    one cell, so no pair can repeat. Points of one place are one row in blocks, so a distance is worked out once for all
    pairs of points at the same two places, and tasks are cut by the pairs they make.
    """
    deg = metres_to_degrees(metres)
    width = deg / 2
    # The hair over the exact reach covers the rounding of the distance to millimetres.
    slack = 1e-7
    circles = grid.in_blocks(b.select("id", "lon", "lat"), ["lon", "lat"], "id")
    circles = circles.select(F.col("_many").alias("_bs"), F.col("lon").alias("_blon"), F.col("lat").alias("_blat"))
    wide, high = lon_reach_deg(F.col("_blat"), metres) + slack, F.lit(deg + slack)
    boxed = circles.withColumns(
        {
            "xmin": F.col("_blon") - wide,
            "xmax": F.col("_blon") + wide,
            "ymin": F.col("_blat") - high,
            "ymax": F.col("_blat") + high,
        }
    )
    around = (
        grid.touch(boxed, BOX_AXES, width)
        .filter(_metres_to_cell(F.col("_blon"), F.col("_blat"), width) <= F.lit(metres + 0.01))
        .drop("xmin", "xmax", "ymin", "ymax")
    )
    keyed = grid.in_blocks(a.select("id", "lon", "lat"), ["lon", "lat"], "id").select(
        F.col("_many").alias("_as"),
        "lon",
        "lat",
        cell(F.col("lon"), width).alias("_c0"),
        cell(F.col("lat"), width).alias("_c1"),
    )
    keyed, around = stored(keyed, "places"), stored(around, "circles")
    distance = great_circle_m(F.col("lon"), F.col("lat"), F.col("_blon"), F.col("_blat"))
    met = grid.dealt_join(keyed, around, ["_c0", "_c1"], F.size("_as"), F.size("_bs"))
    near = met.withColumn("metres", distance).filter(F.col("metres") <= F.lit(float(metres)))
    each = near.select(F.explode("_as").alias("a_id"), "_bs", "metres")
    return each.select("a_id", F.explode("_bs").alias("b_id"), "metres")


def _metres_to_cell(lon: Column, lat: Column, width: float) -> Column:
    """No more than the distance from a point to any point of the cell ``(_c0, _c1)``.

    The haversine formula with the gaps between point and cell, and the cosine at the cell's
    latitude farthest from the equator: every term is then at its smallest.
    """
    w = F.lit(width)
    west, south = F.col("_c0") * w, F.col("_c1") * w
    gap_lon = F.greatest(F.lit(0.0), west - lon, lon - west - w)
    gap_lat = F.greatest(F.lit(0.0), south - lat, lat - south - w)
    poleward = F.least(F.lit(90.0), F.greatest(F.abs(south), F.abs(south + w)))
    h = F.pow(F.sin(F.radians(gap_lat) / 2), F.lit(2.0)) + F.cos(F.radians(lat)) * F.cos(F.radians(poleward)) * F.pow(
        F.sin(F.radians(gap_lon) / 2), F.lit(2.0)
    )
    return F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


# Width in degrees of the coarsest cells of the nearest-neighbour search: the whole world is
# nine by five of them, which bounds the table of their counts.
TOP_DEG = 45.0
PARTS = 4  # a cell has this many parts along each axis at the next level
DEEPEST = 12  # levels after which a cell is about a metre wide


def knn_join(a: DataFrame, b: DataFrame, k: int, levels: int = DEEPEST, crowd: int = 128) -> DataFrame:
    """The ``k`` nearest points of ``b`` for each point of ``a``; the smaller id wins ties.

    Exact, with no search radius to choose. The search pairs cells that hold points of ``a`` with
    cells that hold points of ``b``, and goes down grids that are each split fourfold. At every level a cell of ``a`` keeps
    only cells that can still hold one of its points' nearest: counts per cell give a distance within which ``k``
    points are certain, and cells wholly beyond it are left out. A cell of ``a`` is settled once the cells
    it keeps hold no more than ``crowd`` points (or eight times ``k``), and only the others go on. So each point meets about that many
    others however dense or sparse ``b`` is around it. Of points at one place only the ``k`` smallest ids can
    matter, so copies are cut first. Points of ``a`` at one place have the same nearest ones, which are found for blocks of them.

    The search runs here, over counts per cell, two joins a level; the points are read for the counts and for the
    last join. ``levels`` bounds the depth; neither it nor ``crowd`` changes the result.
    """
    finest = TOP_DEG / PARTS ** (levels - 1)
    places = first_rows(
        b.select(F.col("id").alias("b_id"), F.col("lon").alias("_blon"), F.col("lat").alias("_blat")),
        ["_blon", "_blat"],
        [F.col("b_id")],
        k,
    ).withColumns({"_x": cell(F.col("_blon"), finest), "_y": cell(F.col("_blat"), finest)})
    asking = grid.in_blocks(a.select("id", "lon", "lat"), ["lon", "lat"], "id")
    asking = stored(asking.withColumn("_no", F.monotonically_increasing_id()), "places")
    origin = asking.select("_no", "lon", "lat").withColumns(
        {"_ax": cell(F.col("lon"), finest), "_ay": cell(F.col("lat"), finest)}
    )
    held = cut_lineage(places.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("_n")))
    asked = cut_lineage(origin.select("_ax", "_ay").distinct())

    def up(name: str, level: int) -> Column:
        # Coarser cells come from the finest ones, so a cell and its parts always agree.
        return F.floor(F.col(name) / PARTS ** (levels - 1 - level)).cast("bigint")

    def theirs(level: int) -> DataFrame:
        return held.groupBy(up("_x", level).alias("_x"), up("_y", level).alias("_y")).agg(F.sum("_n").alias("_n"))

    def ours(level: int) -> DataFrame:
        return asked.select(up("_ax", level).alias("_ax"), up("_ay", level).alias("_ay")).distinct()

    # Cells off the globe are cut, which leaves at most 9 x 5 on either side.
    world = ours(0).withColumn("_x", F.explode(F.sequence(F.lit(-4).cast("bigint"), F.lit(4).cast("bigint")))).withColumn(
        "_y", F.explode(F.sequence(F.lit(-2).cast("bigint"), F.lit(2).cast("bigint")))
    )
    rows = world.join(theirs(0), ["_x", "_y"])
    settled = []
    for level in range(levels):
        rows = cut_lineage(_cells_in_reach(rows, TOP_DEG / PARTS**level, k))
        done = (F.col("_left") <= max(crowd, 8 * k)) | F.lit(level == levels - 1)
        settled.append(rows.filter(done).select(F.lit(level).alias("_lvl"), "_ax", "_ay", "_x", "_y"))
        parents = rows.filter(~done).select(*[F.col(c).alias(f"_p{c}") for c in ("_ax", "_ay", "_x", "_y")])
        if parents.isEmpty():
            break
        above = {f"_p{c}": F.floor(F.col(c) / PARTS).cast("bigint") for c in ("_ax", "_ay", "_x", "_y")}
        mine = ours(level + 1).withColumns({c: above[c] for c in ("_p_ax", "_p_ay")})
        other = theirs(level + 1).withColumns({c: above[c] for c in ("_p_x", "_p_y")})
        rows = parents.join(mine, ["_p_ax", "_p_ay"]).join(other, ["_p_x", "_p_y"]).drop(*above)
    found = reduce(DataFrame.unionByName, settled)
    used = range(len(settled))

    def at_levels(points: DataFrame, x: str, y: str) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(i).alias("l"), up(x, i).alias("x"), up(y, i).alias("y")) for i in used])
        placed = points.withColumn("_at", F.explode(cells))
        return placed.withColumns({"_lvl": F.col("_at.l"), x: F.col("_at.x"), y: F.col("_at.y")}).drop("_at")

    candidates = at_levels(places, "_x", "_y").join(found, ["_lvl", "_x", "_y"]).drop("_x", "_y")
    pairs = (
        at_levels(origin, "_ax", "_ay")
        .join(candidates, ["_lvl", "_ax", "_ay"])
        .select("_no", "b_id", great_circle_m(F.col("lon"), F.col("lat"), F.col("_blon"), F.col("_blat")).alias("metres"))
    )
    nearest = W.partitionBy("_no").orderBy("metres", "b_id")
    ranked = pairs.withColumn("rank_no", F.row_number().over(nearest)).filter(F.col("rank_no") <= k)
    each = ranked.join(asking.select("_no", "_many"), "_no")
    return each.select(F.explode("_many").alias("a_id"), "b_id", "metres", "rank_no")


def _centre_and_radius(x: str, y: str, deg: float) -> tuple[Column, Column, Column]:
    """A cell's centre, and a distance within which all its points are of it.

    Put half the cell's width and height into the haversine formula, with the cosine at the
    cell's latitude nearest the equator.
    """
    half = F.lit(math.sin(math.radians(deg) / 4) ** 2)
    equatorward = F.greatest(F.lit(0.0), F.abs((F.col(y) + 0.5) * F.lit(deg)) - F.lit(deg / 2))
    squared = half * (F.lit(1.0) + F.pow(F.cos(F.radians(equatorward)), F.lit(2.0)))
    radius = F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(squared)) + F.lit(0.01)
    lat = F.least(F.lit(90.0), (F.col(y) + 0.5) * F.lit(deg))  # the pole itself has a cell of its own
    return (F.col(x) + 0.5) * F.lit(deg), lat, radius


def _cells_in_reach(rows: DataFrame, deg: float, k: int) -> DataFrame:
    """Drops cells ``(_x, _y)`` wholly beyond the distance within which ``k`` points are certain for every point of
    the cell ``(_ax, _ay)``, and adds how many points the others hold.

    The distance between the centres plus or minus both radii bounds the distance between any two points.
    """
    lon, lat, radius = _centre_and_radius("_x", "_y", deg)
    alon, alat, aradius = _centre_and_radius("_ax", "_ay", deg)
    one = W.partitionBy("_ax", "_ay")
    closest_first = one.orderBy("_far", "_x", "_y").rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.withColumns({"_mid": great_circle_m(alon, alat, lon, lat), "_both": radius + aradius})
        .withColumn("_far", F.col("_mid") + F.col("_both"))
        .withColumn("_sure", F.sum("_n").over(closest_first))
        .withColumn("_limit", F.min(F.when(F.col("_sure") >= k, F.col("_far"))).over(one))
        .filter(F.col("_limit").isNull() | (F.col("_mid") - F.col("_both") <= F.col("_limit")))
        .withColumn("_left", F.sum("_n").over(one))
        .select("_ax", "_ay", "_x", "_y", "_left")
    )


def bbox_overlap_join(plots: DataFrame, deg: float, crowd: int = 256, levels: int = grid.FINEST) -> DataFrame:
    """Pairs of plots whose bounding boxes overlap, each pair once, smaller id first.

    Two boxes can share many cells; the pair is kept only in the leaf cell that holds the lower
    left corner of their overlap, so no distinct is needed. Equal boxes are one row in blocks, which meet once for all their pairs.
    """
    ends = ["xmin", "ymin", "xmax", "ymax"]
    boxed = grid.in_blocks(plots.select("plot_id", *bounds(F.col("rings"))), ends, "plot_id")
    boxed = stored(boxed.withColumn("_no", F.monotonically_increasing_id()), "boxes")
    cells, _ = grid.cover(boxed, [], BOX_AXES, deg, crowd, levels)
    cells = stored(cells, "box-cells")
    width = grid.leaf_width(deg)
    a, b = (cells.withColumnsRenamed({c: f"{s}_{c}" for c in ("_no", "_many", *ends)}) for s in "ab")
    corner_x = F.greatest("a_xmin", "b_xmin")
    corner_y = F.greatest("a_ymin", "b_ymin")
    overlap = (
        (F.col("a__no") <= F.col("b__no"))
        & (corner_x <= F.least("a_xmax", "b_xmax"))
        & (corner_y <= F.least("a_ymax", "b_ymax"))
        & (F.floor(corner_x / width) == F.col("_c0"))
        & (F.floor(corner_y / width) == F.col("_c1"))
    )
    met = grid.dealt_join(a, b, ["_lvl", "_c0", "_c1"], F.size("a__many"), F.size("b__many")).filter(overlap)
    # Two blocks meet once, so each of their pairs comes out once. A block that meets itself pairs each id with those after it.
    within = F.col("a__no") == F.col("b__no")
    each = met.select(F.posexplode("a__many").alias("_at", "_a"), "b__many", within.alias("_within"))
    rest = F.when(F.col("_within"), F.slice("b__many", F.col("_at") + 2, F.size("b__many"))).otherwise(F.col("b__many"))
    each = each.select("_a", F.explode(rest).alias("_b")).filter("_a <> _b")
    return each.select(F.least("_a", "_b").alias("a_plot_id"), F.greatest("_a", "_b").alias("b_plot_id"))


def polygon_area(plots: DataFrame) -> DataFrame:
    """Area of each plot in hectares, holes subtracted."""
    return plots.select("plot_id", area_ha(F.col("rings")).alias("area_ha"))


def cell_density(points: DataFrame, deg: float, k: int) -> DataFrame:
    """The ``k`` fullest grid cells with their point counts; the smaller cell wins ties."""
    return (
        cell_id(points, deg)
        .groupBy("cx", "cy")
        .agg(F.count(F.lit(1)).alias("n_points"))
        .orderBy(F.col("n_points").desc(), "cx", "cy")
        .limit(k)
    )
