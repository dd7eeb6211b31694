"""Chain operators on chains, diamonds, cycles, self-loops and isolated nodes."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from selvatrace.functions import bits
from selvatrace.operators import chain


def edges_of(spark, pairs):
    rows = [(s, d, float(q)) for s, d, q in pairs]
    return spark.createDataFrame(rows, "src bigint, dst bigint, q double").select(
        "src", "dst", F.col("q").cast("decimal(18,4)").alias("qty")
    )


def least_depths(pairs, limit):
    out = {}
    frontier = {(s, d) for s, d in pairs}
    for depth in range(1, limit + 1):
        frontier = {p for p in frontier if p not in out}
        out.update({p: depth for p in frontier})
        frontier = {(o, d) for o, n in frontier for s, d in pairs if s == n}
    return out


CYCLIC = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 4), (5, 6), (5, 7), (6, 8), (7, 8), (1, 2)]


@pytest.mark.parametrize("limit", [1, 2, 5, 20])
def test_reach_on_cycles(spark, limit):
    got = chain.reach(spark.createDataFrame(CYCLIC, "src bigint, dst bigint"), limit).collect()
    pairs = {(r.origin, r.node): r.depth for r in got}
    assert len(pairs) == len(got) and pairs == least_depths(set(CYCLIC), limit)


def test_reach_through_a_hub(spark):
    pairs = [(i, 0) for i in range(1, 60)] + [(0, i) for i in range(60, 120)]
    got = {(r.origin, r.node): r.depth for r in chain.reach(spark.createDataFrame(pairs, "src bigint, dst bigint"), 4).collect()}
    assert got == least_depths(set(pairs), 4)


def test_reach_without_edges(spark):
    assert chain.reach(spark.createDataFrame([], "src bigint, dst bigint"), 3).count() == 0


@pytest.mark.parametrize("steps", [0, 1, 3])
def test_exposure_equals_hand_loop(spark, steps):
    rng = random.Random(4)
    pairs = [(rng.randrange(8), rng.randrange(8), rng.randrange(1, 50)) for _ in range(40)]
    own = {0: 1.0, 1: 0.25, 99: 1.0}
    nodes = {n for s, d, _ in pairs for n in (s, d)} | set(own)
    exp = {n: own.get(n, 0.0) for n in nodes}
    for _ in range(steps):
        nxt = {}
        for n in nodes:
            intake = sum(q for _, d, q in pairs if d == n)
            came = sum(q * exp[s] for s, d, q in pairs if d == n) / intake if intake else 0.0
            nxt[n] = own.get(n, 0.0) + (1 - own.get(n, 0.0)) * came
        exp = nxt
    flags = spark.createDataFrame(list(own.items()), "node bigint, own double")
    got = {r.node: float(r.exposure) for r in chain.exposure(edges_of(spark, pairs), flags, steps).collect()}
    assert got.keys() == exp.keys()
    assert all(abs(got[n] - exp[n]) < 1e-12 for n in exp)


def test_exposure_does_not_depend_on_partitioning(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(30), rng.randrange(30), rng.random() * 100) for _ in range(500)]
    flags = spark.createDataFrame([(3, 1.0), (4, 0.3)], "node bigint, own double")
    runs = [sorted(map(tuple, chain.exposure(edges_of(spark, pairs).repartition(n), flags, 3).collect())) for n in (1, 6)]
    assert runs[0] == runs[1]


def test_mass_balance_of_a_closed_graph_is_zero(spark):
    pairs = [(1, 2, 5), (2, 3, 3), (3, 1, 1), (4, 4, 2)]
    got = {r.node: (float(r.qty_in), float(r.qty_out)) for r in chain.mass_balance(edges_of(spark, pairs)).collect()}
    assert got == {1: (1, 5), 2: (5, 3), 3: (3, 1), 4: (2, 2)}
    assert chain.mass_balance(edges_of(spark, pairs)).agg(F.sum("difference")).first()[0] == 0


def test_hop_delay_and_links(spark):
    rows = [(1, "2000-01-01"), (1, "2000-01-01"), (1, "2000-01-31"), (2, "2000-01-05")]
    moves = spark.createDataFrame(rows, "lot_id bigint, d string").withColumn("moved_on", F.to_date("d"))
    got = sorted((r.lot_id, r.n_moves, r.delay_days) for r in chain.hop_days(moves).collect() if r.delay_days)
    assert got == [(1, 1, 30)]
    each = sorted((r.lot_id, str(r.moved_on), r.nth, r.delay_days) for r in chain.hop_delay(moves).collect())
    assert each == [(1, "2000-01-01", 1, None), (1, "2000-01-01", 2, 0), (1, "2000-01-31", 1, 30), (2, "2000-01-05", 1, None)]
    lots = spark.createDataFrame([(1,), (2,), (3,), (None,)], "lot_id bigint")
    assert [r.lot_id for r in chain.linked_lots(lots, moves).orderBy("lot_id").collect()] == [1, 2]
    assert {r.lot_id for r in chain.unlinked_lots(lots, moves).collect()} == {3, None}


def test_origin_completeness(spark):
    moves = edges_of(spark, [(1, 9, 3), (2, 9, 1), (2, 8, 4)])
    known = spark.createDataFrame([(1,), (1,)], "site_id bigint")
    assert {r.dst: r.share_known for r in chain.origin_completeness(moves, known).collect()} == {9: 0.75, 8: 0.0}


def test_reach_from_given_origins(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 1)], "src int, dst int")
    got = {(r.origin, r.node, r.depth) for r in chain.reach(edges, 2, spark.createDataFrame([(5,), (9,)], "origin int")).collect()}
    assert got == {(5, 1, 1), (5, 2, 2)}


@pytest.mark.parametrize("limit", [1, 3, 6])
def test_reach_by_bitmaps_equals_pairs(spark, limit):
    """1,300 origins, so several blocks of bits, on a graph with cycles, a hub, loops and dead ends."""
    pairs = [(i, (i * 7) % 1300) for i in range(1300)] + [(i, 5) for i in range(0, 1300, 3)] + [(5, 2000 + i) for i in range(40)]
    edges = spark.createDataFrame([*pairs, *pairs[:50], (None, 1), (1, None)], "src bigint, dst bigint")
    origins = spark.createDataFrame([(i,) for i in [*range(1300), 5, 5, 2001, 9999, None]], "origin bigint")
    want = {(r.origin, r.node, r.depth) for r in chain.reach(edges.dropna(), limit, origins).collect()}
    got = [(r.origin, r.node, r.depth) for r in chain.reach_from(edges, limit, origins).collect()]
    assert len(got) == len(want) and set(got) == want
    counts = {(r.node, r.depth): r.n_origins for r in chain.reach_counts(edges, limit, origins).collect()}
    assert counts == dict(Counter((node, depth) for _, node, depth in want))
    assert chain.reach_from(edges, limit, origins.filter("origin > 9000")).count() == 0


def grid_of(spark):
    """Nodes 0 to 59 lead to each other, and each to twenty of 1,000 that lead nowhere."""
    pairs = [(i, (i * 7 + k) % 60) for i in range(60) for k in (1, 5)] + [(i, 100 + (i * 20 + k) % 1000) for i in range(60) for k in range(20)]
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def test_only_nodes_that_lead_on_keep_bits_from_step_to_step(spark, monkeypatch):
    kept = []
    stored = chain.stored
    monkeypatch.setattr(chain, "stored", lambda df, name: kept.append((name, stored(df, name))) or kept[-1][1])
    origins = spark.range(60).toDF("origin")
    got = {(r.node, r.depth): r.n_origins for r in chain.reach_counts(grid_of(spark), 3, origins).collect()}
    want = Counter((r.node, r.depth) for r in chain.reach(grid_of(spark), 3, origins).collect())
    assert got == dict(want)
    bits = [df for name, df in kept if name == "reach-bits"]
    assert bits and all(df.filter("src >= 100").count() == 0 for df in bits)


def test_reach_in_several_parts(spark, monkeypatch):
    """Blocks of origins that are not sent at once, and blocks too large to send."""
    edges = spark.createDataFrame([(i, (i * 7 + k) % 1300) for i in range(1300) for k in (1, 2)], "src bigint, dst bigint")
    origins = spark.range(1300).toDF("origin")
    want = {(r.origin, r.node, r.depth) for r in chain.reach(edges, 3, origins).collect()}
    monkeypatch.setattr(chain, "SENT_ROWS", 3000)
    monkeypatch.setattr(chain, "SENT_ORIGINS", 0)
    assert {(r.origin, r.node, r.depth) for r in chain.reach_from(edges, 3, origins).collect()} == want


def test_pairs_are_made_last(spark):
    """Nothing is shuffled or joined after the pairs of ``reach_from`` are made."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = chain.reach_from(grid_of(spark), 2, spark.range(60).toDF("origin"))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above = plan[: plan.index("Generate explode")]
    assert "Exchange" not in above and "Join" not in above


def test_bits_are_united_where_the_edges_are(spark, monkeypatch):
    """A node's bits are complete in the task that reads its edges: none is shuffled."""
    plans = []
    stored = chain.stored
    monkeypatch.setattr(chain, "stored", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or stored(df, name))
    chain.reach_counts(grid_of(spark), 3, spark.range(60).toDF("origin"))
    found = [plan for name, plan in plans if name in ("reach-found", "reach-bits")]
    assert len(found) >= 5 and all("Exchange" not in plan for plan in found)


def test_names_are_put_to_bits_without_a_join(spark):
    plan = chain.reach_from(grid_of(spark), 3, spark.range(60).toDF("origin"))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "getbit" not in plan


@pytest.mark.parametrize(("sent", "met"), [(1000, 50), (24_000, 1 << 17), (10**7, 200)])
def test_reach_in_parts_of_any_size(spark, monkeypatch, sent, met):
    """3,000 origins, so blocks that are cut, taken alone or side by side; a hub that all lead to, and nodes named by text."""
    pairs = {(i, (i * 7 + k * k) % 3000) for i in range(3000) for k in (1, 4)} | {(i, 9000) for i in range(3000)} | {(9000, 9001)}
    steps, want = {}, Counter()
    for a, b in pairs:
        steps.setdefault(a, set()).add(b)
    for start in range(3000):
        seen, now = set(), {start}
        for depth in (1, 2, 3):
            now = {b for a in now for b in steps.get(a, ())} - seen
            seen |= now
            want.update((f"n{b}", depth) for b in now)
    monkeypatch.setattr(chain, "SENT_ROWS", sent)
    monkeypatch.setattr(bits, "MET_ROWS", met)
    edges = spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in pairs], "src string, dst string")
    origins = spark.createDataFrame([(f"n{i}",) for i in range(3000)], "origin string")
    got = {(r.node, r.depth): r.n_origins for r in chain.reach_counts(edges, 3, origins).collect()}
    assert got == dict(want)
    near = chain.reach_from(edges, 2, origins).groupBy("node", "depth").count().collect()
    assert {(r.node, r.depth): r["count"] for r in near} == {k: n for k, n in want.items() if k[1] < 3}


def test_rows_of_bits_are_united_by_key():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 2**63, (50, bits.WIDE), dtype=np.uint64) & rng.integers(0, 2**63, (50, bits.WIDE), dtype=np.uint64)
    key = np.append(rng.integers(0, 40, 5000), np.full(3000, 77))
    row = rng.integers(0, 3, len(key)) + key % 48
    keys, words = bits.or_by(key, rows, row)
    assert keys.tolist() == sorted(set(key.tolist()))
    for k, w in zip(keys, words, strict=True):
        assert (w == np.bitwise_or.reduce(rows[row[key == k]], axis=0)).all()


def test_nodes_are_found_by_any_value():
    for values in ([5, -7, 2**63 - 1, -(2**63)], [5, 7, 6], [0, 2**40]):
        find = bits.finder(pa.array(values, pa.int64()))
        asked = [*values, 8, 4, -(2**63) + 1, 2**62]
        assert find(pa.array(asked, pa.int64())).tolist() == [values.index(v) if v in values else -1 for v in asked]
    assert bits.finder(pa.array(["a", "b"]))(pa.array(["b", "x", "a"])).tolist() == [1, -1, 0]
    assert bits.finder(pa.array([3, 4], pa.int32()))(pa.array([4, 9], pa.int64())).tolist() == [1, -1]
