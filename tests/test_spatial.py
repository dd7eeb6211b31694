"""Spatial operators against brute force and hand-made shapes."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from selvatrace.functions.geometry import EARTH_RADIUS_M
from selvatrace.operators import spatial
from selvatrace.plans import grid

RINGS = "plot_id bigint, rings array<array<struct<x:double,y:double>>>"

SHAPES = {
    1: [[(0, 0), (2, 0), (2, 2), (0, 2)]],  # square
    2: [[(3, 0), (5, 0), (5, 2), (4, 1), (3, 2)]],  # concave
    3: [[(0, 3), (3, 3), (3, 6), (0, 6)], [(1, 4), (2, 4), (2, 5), (1, 5)]],  # with a hole
    4: [[(6, 0), (7, 0), (7, 1), (6, 1), (6, 0)]],  # already closed
    5: [[(0, 9), (2, 9), (2, 7), (0, 7)]],  # reversed
    6: [[(8, 8), (9, 9), (8, 8)]],  # no area
}


def make_plots(spark, shapes):
    rows = [(k, [[(float(x), float(y)) for x, y in r] for r in rings]) for k, rings in shapes.items()]
    return spark.createDataFrame(rows, RINGS)


def points_of(spark, coords):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(coords)], "pt bigint, lon double, lat double")


def even_odd(rings, x, y):
    hits = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                hits += 1
    return hits % 2 == 1


def metres(p, q):
    lon1, lat1, lon2, lat2 = map(math.radians, (*p, *q))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("deg,crowd", [(0.3, 256), (0.3, 10**6), (1.0, 1), (4.0, 0), (50.0, 0)])
def test_pip_join_on_hand_made_shapes(spark, deg, crowd):
    rng = random.Random(1)
    coords = [(rng.uniform(-1, 10), rng.uniform(-1, 10)) for _ in range(300)]
    coords += [(1.0, 1.0), (1.5, 4.5), (0.5, 4.5), (4.0, 1.5), (4.0, 0.5), (6.5, 0.5), (1.0, 8.0), (None, 1.0), (1.0, None)]
    want = {
        (i, k)
        for i, (x, y) in enumerate(coords)
        if x is not None and y is not None
        for k, rings in SHAPES.items()
        if even_odd(rings, x, y)
    }
    points, plots = points_of(spark, coords), make_plots(spark, SHAPES)

    def join(how):
        return spatial.pip_join(points, plots, deg, how, crowd=crowd).collect()

    inner = [(r.pt, r.plot_id) for r in join("inner")]
    assert sorted(inner) == sorted(want)
    hit = {i for i, _ in want}
    assert {r.pt for r in join("semi")} == hit
    assert {r.pt for r in join("anti")} == set(range(len(coords))) - hit
    left = join("left")
    assert {r.pt for r in left if r.plot_id is None} == set(range(len(coords))) - hit
    assert len(left) == len(want) + len(coords) - len(hit)
    # Turning a ring or walking it the other way changes nothing.
    turned = {k: [r[2:] + r[:2] if r[0] != r[-1] else r[::-1] for r in rings] for k, rings in SHAPES.items()}
    again = spatial.pip_join(points, make_plots(spark, turned), deg, crowd=crowd).collect()
    assert sorted((r.pt, r.plot_id) for r in again) == sorted(want)


@pytest.mark.parametrize("deg,crowd", [(0.05, 256), (0.5, 0)])
def test_pip_join_with_many_vertices(spark, deg, crowd):
    rng = random.Random(8)
    spokes = [2 * math.pi * i / 700 for i in range(700)]
    star = [(math.cos(t) * r, math.sin(t) * r) for t, r in zip(spokes, [rng.uniform(0.4, 1.0) for _ in spokes], strict=True)]
    coords = [(rng.uniform(-1, 1), rng.uniform(-1, 1)) for _ in range(600)]
    got = spatial.pip_join(points_of(spark, coords), make_plots(spark, {1: [star]}), deg, crowd=crowd).collect()
    want = [i for i, p in enumerate(coords) if even_odd([star], *p)]
    assert sorted(r.pt for r in got) == want and len(want) > 100


def test_a_plot_is_not_copied_whole_to_its_cells(spark, monkeypatch):
    ring = [(math.cos(2 * math.pi * i / 400), math.sin(2 * math.pi * i / 400)) for i in range(400)]
    seen = []
    original = grid.cover

    def spy(*args):
        seen.append(original(*args))
        return seen[0]

    monkeypatch.setattr(grid, "cover", spy)
    spatial.pip_join(points_of(spark, [(0.0, 0.0)]), make_plots(spark, {1: [ring]}), 0.05)
    cells = seen[0][0].select(F.size("_edges").alias("n")).agg(F.count("n").alias("cells"), F.avg("n").alias("n")).first()
    assert cells.cells > 1500 and cells.n < 40


@pytest.fixture(scope="module")
def crowded_boxes():
    """A few wide boxes, and a third of all boxes tiny and in one corner of one cell."""
    rng = random.Random(5)
    shapes = {}
    for k in range(240):
        if k % 3 == 0:
            x, y, w = rng.uniform(0, 0.1), rng.uniform(0, 0.1), 0.01
        else:
            x, y, w = rng.uniform(-5, 5), rng.uniform(-5, 5), rng.choice([0.05, 0.4, 3.0])
        shapes[k] = [[(x, y), (x + w, y), (x + w, y + w), (x, y + w)]]
    return shapes


@pytest.mark.parametrize("deg,crowd", [(1.0, 10**6), (1.0, 8), (8.0, 4)])
def test_crowded_cells_change_nothing(spark, crowded_boxes, deg, crowd):
    rng = random.Random(6)
    coords = [(rng.uniform(0, 0.1), rng.uniform(0, 0.1)) for _ in range(200)]
    coords += [(rng.uniform(-5, 5), rng.uniform(-5, 5)) for _ in range(200)]
    plots = make_plots(spark, crowded_boxes)
    got = spatial.pip_join(points_of(spark, coords), plots, deg, crowd=crowd).select("pt", "plot_id").collect()
    want = sorted((i, k) for i, p in enumerate(coords) for k, rings in crowded_boxes.items() if even_odd(rings, *p))
    assert sorted(map(tuple, got)) == want

    def box(k):
        xs, ys = zip(*crowded_boxes[k][0], strict=True)
        return min(xs), min(ys), max(xs), max(ys)

    boxes = {k: box(k) for k in crowded_boxes}
    pairs = sorted(
        (a, b)
        for a in boxes
        for b in boxes
        if a < b
        and max(boxes[a][0], boxes[b][0]) <= min(boxes[a][2], boxes[b][2])
        and max(boxes[a][1], boxes[b][1]) <= min(boxes[a][3], boxes[b][3])
    )
    assert sorted(map(tuple, spatial.bbox_overlap_join(plots, deg, crowd=crowd).collect())) == pairs


def test_crowded_cells_are_really_split(spark, crowded_boxes):
    tiny = {k: s for k, s in crowded_boxes.items() if k % 3 == 0 or k % 40 == 1}
    boxed = make_plots(spark, tiny).select("plot_id", *spatial.bounds(F.col("rings")))
    cover, by_level = grid.cover(boxed, [], spatial.BOX_AXES, 1.0, 4, 2)
    assert len(by_level) == 2
    whole, _ = grid.cover(boxed, [], spatial.BOX_AXES, 1.0, 10**6, 2)

    def candidates(c):
        return c.groupBy("_lvl", "_c0", "_c1").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]

    assert candidates(cover) < candidates(whole) / 3
    # Boxes that fill their cell stay in one piece, however many there are.
    same = make_plots(spark, {k: [[(0.1, 0.1), (0.9, 0.1), (0.9, 0.9), (0.1, 0.9)]] for k in range(50)})
    boxed = same.select("plot_id", *spatial.bounds(F.col("rings")))
    cover, by_level = grid.cover(boxed, [], spatial.BOX_AXES, 1.0, 4, 2)
    assert by_level == [] and cover.count() == 50


def test_a_crowded_cell_is_split_however_deep_it_lies(spark):
    rng = random.Random(8)
    boxes = [(i, x, x + 1e-7, y, y + 1e-7) for i, (x, y) in enumerate((rng.uniform(0, 5e-4), rng.uniform(0, 5e-4)) for _ in range(600))]
    boxed = spark.createDataFrame(boxes, "plot_id long, xmin double, xmax double, ymin double, ymax double")
    cover, by_level = grid.cover(boxed, [], spatial.BOX_AXES, 1.0, 16, grid.FINEST)
    assert 4 <= len(by_level) < grid.FINEST
    assert cover.groupBy("_lvl", "_c0", "_c1").count().agg(F.max("count")).first()[0] <= 16
    # Copies of one box can never be told apart.
    copies = boxed.select(F.explode(F.sequence(F.lit(1), F.lit(50))).alias("plot_id"), "xmin", "xmax", "ymin", "ymax").filter("xmin < 1e-5")
    one = copies.join(F.broadcast(copies.limit(1).drop("plot_id")), ["xmin", "xmax", "ymin", "ymax"], "left_semi")
    assert grid.cover(one, [], spatial.BOX_AXES, 1.0, 16, grid.FINEST)[1] == []


def test_dense_points_meet_few_others(spark, monkeypatch):
    rng = random.Random(9)
    coords = [(10 + rng.uniform(0, 0.5), 50 + rng.uniform(0, 0.5)) for _ in range(2000)]
    left = []
    original = spatial._cells_in_reach

    def spy(*args):
        left.append(original(*args))
        return left[-1]

    monkeypatch.setattr(spatial, "_cells_in_reach", spy)
    got = spatial.knn_join(as_ids(spark, coords), as_ids(spark, coords), 2, crowd=64)
    assert len(left) < spatial.DEEPEST
    assert left[-1].agg(F.max("_left")).first()[0] <= 64
    first = {r.a_id: r.b_id for r in got.filter("rank_no = 1").collect()}
    assert first == {i: i for i in range(2000)}


def as_ids(spark, coords):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(coords)], "id bigint, lon double, lat double")


@pytest.mark.parametrize("base_lat", [0.0, -34.0, 71.0, -88.5])
def test_within_distance(spark, base_lat):
    rng = random.Random(2)
    a = [(rng.uniform(-1, 1), base_lat + rng.uniform(-1, 1)) for _ in range(150)]
    b = [(rng.uniform(-1, 1), base_lat + rng.uniform(-1, 1)) for _ in range(80)]
    want = {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if round(metres(p, q), 3) <= 30000}
    got = [(r.a_id, r.b_id) for r in spatial.within_distance_join(as_ids(spark, a), as_ids(spark, b), 30000.0).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), k=st.integers(1, 6), levels=st.sampled_from([1, 3, 5, 12]), crowd=st.sampled_from([1, 128]))
def test_knn_equals_brute_force(spark, seed, k, levels, crowd):
    rng = random.Random(seed)
    heap = (rng.uniform(-170, 170), rng.uniform(-80, 80))
    b = [heap] * 10  # copies at one place
    b += [(heap[0] + rng.uniform(-0.01, 0.01), heap[1] + rng.uniform(-0.01, 0.01)) for _ in range(20)]  # dense
    b += [(rng.uniform(-179, 179), rng.uniform(-89, 89)) for _ in range(30)]  # sparse
    a = [heap, (heap[0] + 0.5, heap[1])] + [(rng.uniform(-179, 179), rng.uniform(-89, 89)) for _ in range(15)]
    want = []
    for i, p in enumerate(a):
        ranked = sorted((round(metres(p, q), 2), j) for j, q in enumerate(b))
        want.append([d for d, _ in ranked[:k]])
    got = spatial.knn_join(as_ids(spark, a), as_ids(spark, b), k, levels, crowd).collect()
    for i in range(len(a)):
        mine = sorted((r for r in got if r.a_id == i), key=lambda r: r.rank_no)
        assert [r.rank_no for r in mine] == list(range(1, k + 1))
        assert all(abs(r.metres - d) < 0.02 for r, d in zip(mine, want[i], strict=True))
        assert [(r.metres, r.b_id) for r in mine] == sorted((r.metres, r.b_id) for r in mine)
    at_heap = sorted((r.rank_no, r.b_id) for r in got if r.a_id == 0)
    assert [b_id for _, b_id in at_heap] == list(range(k))  # smallest ids among the copies


def test_knn_with_fewer_points_than_k(spark):
    got = spatial.knn_join(as_ids(spark, [(0.0, 0.0)]), as_ids(spark, [(1.0, 1.0), (100.0, 50.0)]), 5, 3).collect()
    assert sorted((r.b_id, r.rank_no) for r in got) == [(0, 1), (1, 2)]


def test_area_of_a_spherical_band_and_holes(spark):
    shapes = {1: [[(0, 0), (1, 0), (1, 1), (0, 1)]], 2: [[(0, 0), (2, 0), (2, 1), (0, 1)], [(0, 0), (1, 0), (1, 1), (0, 1)]], 6: SHAPES[6]}
    area = {r.plot_id: r.area_ha for r in spatial.polygon_area(make_plots(spark, shapes)).collect()}
    exact = EARTH_RADIUS_M**2 * math.radians(1) * math.sin(math.radians(1)) / 10000
    assert area[1] == pytest.approx(exact, rel=1e-12)
    assert area[2] == pytest.approx(exact, rel=1e-9)
    assert area[6] == 0


def test_points_on_cell_borders(spark):
    got = spatial.cell_id(points_of(spark, [(0.5, -0.5), (0.49999, -0.50001), (-0.5, 0.0)]), 0.5).collect()
    assert [(r.cx, r.cy) for r in got] == [(1, -1), (0, -2), (-1, 0)]


@pytest.fixture(params=[1024, 3])
def copies(request, spark, monkeypatch):
    """Places and shapes that many rows share, in blocks of two sizes and with the pairs of a place dealt to several tasks."""
    monkeypatch.setattr(grid, "BLOCK", request.param)
    monkeypatch.setattr(grid, "TASK_PAIRS", 40)
    places = [(0.0, 0.0), (0.1, 0.1), (0.1, 0.5), (3.0, 3.0), (None, 1.0)]
    return [places[i % 5] if i % 2 else places[0] for i in range(60)] + [(0.01 * i, 0.2) for i in range(20)]


def test_rows_that_share_a_place_each_come_out(spark, copies):
    a, b = as_ids(spark, copies), as_ids(spark, copies[1::3])
    known = [(i, p) for i, p in enumerate(copies) if p[0] is not None]
    others = [(j, q) for j, q in enumerate(copies[1::3]) if q[0] is not None]
    got = [(r.a_id, r.b_id) for r in spatial.within_distance_join(a, b, 30000.0).collect()]
    assert sorted(got) == sorted((i, j) for i, p in known for j, q in others if round(metres(p, q), 3) <= 30000)
    nearest = sorted((r.a_id, r.rank_no, r.b_id) for r in spatial.knn_join(a, b, 2).collect())
    ranked = {i: sorted((round(metres(p, q), 3), j) for j, q in others)[:2] for i, p in known}
    assert nearest == sorted((i, n + 1, j) for i, best in ranked.items() for n, (_, j) in enumerate(best))


def test_rows_that_share_a_shape_each_come_out(spark, copies):
    squares = {k: (0.05 * (k % 4), 0.1 * (k % 3)) for k in range(40)}
    shapes = {k: [[(x, y), (x + 0.12, y), (x + 0.12, y + 0.15), (x, y + 0.15)]] for k, (x, y) in squares.items()}
    plots, points = make_plots(spark, shapes), points_of(spark, copies)
    inside = [(i, k) for i, p in enumerate(copies) if p[0] is not None for k, rings in shapes.items() if even_odd(rings, *p)]
    hit = {i for i, _ in inside}
    got = {how: spatial.pip_join(points, plots, 0.1, how, crowd=2) for how in ("inner", "left", "semi", "anti")}
    assert sorted((r.pt, r.plot_id) for r in got["inner"].collect()) == sorted(inside)
    missed = [i for i in range(len(copies)) if i not in hit]
    assert sorted(((r.pt, r.plot_id or -1) for r in got["left"].collect() if r.plot_id != 0)) == sorted(
        [(i, k) for i, k in inside if k] + [(i, -1) for i in missed]
    )
    assert sorted(r.pt for r in got["semi"].collect()) == sorted(hit) and sorted(r.pt for r in got["anti"].collect()) == missed

    def apart(p, q):
        return max(abs(p[0] - q[0]) - 0.12, abs(p[1] - q[1]) - 0.15)

    pairs = [(k, m) for k in squares for m in squares if k < m and apart(squares[k], squares[m]) <= 0]
    assert sorted(map(tuple, spatial.bbox_overlap_join(plots, 0.1, crowd=2).collect())) == pairs


def test_a_shape_is_tested_once_however_many_plots_have_it(spark, monkeypatch):
    covered = []
    original = grid.cover
    monkeypatch.setattr(grid, "cover", lambda *args: covered.append(args[0]) or original(*args))
    plots = make_plots(spark, {k: SHAPES[1 + k % 5] for k in range(100)})
    for how in ("inner", "left", "semi", "anti"):
        spatial.pip_join(points_of(spark, [(1.0, 1.0)]), plots, 1.0, how)
    spatial.bbox_overlap_join(plots, 1.0)
    assert [df.count() for df in covered] == [5] * 5
