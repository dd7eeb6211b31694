"""Calibration with ties, ridge weights, repeated labels, and queues of many sources."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from selvatrace.llm import packing, quality_model, queries


def plain_isotonic(raw, y):
    """Isotonic means by the largest mean from the left of the smallest mean to the right (min-max formula)."""
    values = sorted(set(raw))
    total = [sum(b for a, b in zip(raw, y) if a == v) for v in values]
    count = [list(raw).count(v) for v in values]
    mean = lambda i, j: sum(total[i : j + 1]) / sum(count[i : j + 1])
    n = len(values)
    return values, [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]


def test_order_of_equal_scores_plays_no_part():
    raw = np.array([0.1, 0.5, 0.5, 0.5, 0.5, 0.9])
    told = set()
    for middle in itertools.permutations([1.0, 0.0, 0.0, 1.0]):
        edges, levels = quality_model.isotonic(raw, np.array([0.0, *middle, 1.0]))
        told.add(tuple(np.interp([0.1, 0.4, 0.5, 0.9], edges, levels)))
    assert len(told) == 1


def test_isotonic_against_the_min_max_formula():
    random = np.random.default_rng(4)
    for _ in range(200):
        n = int(random.integers(1, 15))
        raw, y = random.integers(0, 6, n) / 4, random.integers(0, 2, n).astype(float)
        values, want = plain_isotonic(raw.tolist(), y.tolist())
        edges, levels = quality_model.isotonic(raw, y)
        # Each pool holds the values of one level; levels are pulled to the mean by one row.
        pulled = []
        for w in sorted(set(np.round(want, 12))):
            held = [v for v, w2 in zip(values, want) if abs(w2 - w) < 1e-9]
            rows = sum(r in held for r in raw)
            pulled.append((w * rows + y.mean()) / (rows + 1))
        assert len(edges) == len(pulled) and np.allclose(levels, np.maximum.accumulate(pulled))


@pytest.fixture(scope="module")
def labelled(spark):
    random = np.random.default_rng(7)
    rows = [(i, *[float(x) for x in random.normal(size=len(quality_model.STATISTICS))]) for i in range(600)]
    stats = spark.createDataFrame(rows, "doc_id bigint, " + ", ".join(f"{c} double" for c in quality_model.STATISTICS))
    labels = stats.select("doc_id", (F.col("log_words") + F.col("marks") > 0).cast("int").alias("quality"))
    return stats, labels


def test_ridge_weights_solve_the_whole_system(spark, labelled):
    stats, labels = labelled
    model = quality_model.fit(stats, labels)
    part = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(quality_model.CALIBRATE)) != 0
    rows = stats.join(labels, "doc_id").filter(part & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)).toPandas()
    z = quality_model.fourier((rows[list(quality_model.STATISTICS)].to_numpy() - model.mean) / model.scale)
    # A ridge solution has no gradient.
    slope = z.T @ (z @ model.weights - rows["quality"].to_numpy()) + quality_model.RIDGE * model.weights
    assert np.abs(slope).max() < 1e-6


def test_repeated_ids_count_once(labelled):
    stats, labels = labelled
    once = quality_model.fit(stats, labels)
    more = quality_model.fit(stats.union(stats.filter("doc_id % 3 = 0")), labels.union(labels).union(labels.filter("doc_id % 2 = 0")))
    x = np.random.default_rng(1).normal(size=(50, len(quality_model.STATISTICS)))
    assert np.allclose(once.score(x), more.score(x), atol=1e-6)


def test_five_hundred_sources_share_no_queue(spark):
    docs = spark.range(1000).select(
        F.col("id").alias("doc_id"), F.lit("a few words").alias("text"),
        F.when(F.col("id") % 500 > 0, F.concat(F.lit("src"), F.col("id") % 500)).alias("source"),
    )
    names = packing.sources_of(docs, "source", packing.QUEUES)
    assert len(names) == 500 and names[-1] is None and packing.sources_of(docs, "source", 499) is None
    held = packing.tokens(docs, queries.vocabulary(), "doc_id", "text", "source", packing.QUEUES, names)
    of = {r.doc_id: r.queue for r in held.collect()}
    assert len(set(of.values())) == 500 and all(of[i] == of[i + 500] for i in range(500))


def test_targets_of_shared_queues_add_up(spark, monkeypatch):
    """Each window of one stream brings each queue the sum of its sources' targets."""
    monkeypatch.setattr(packing, "QUEUES", 2)
    targets = {"a": 0.2, "b": 0.1, "c": 0.3, "d": 0.4}
    rows = [(i, "some words of a text", "abcd"[i % 4]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    queue = dict(docs.select("source", F.pmod(F.xxhash64("source"), F.lit(2))).distinct().collect())
    shares = {q: sum(t for s, t in targets.items() if queue[s] == q) for q in queue.values()}
    pieces = packing.packed(docs, queries.vocabulary(), targets, window=200, sequence=50).collect()
    total = sum(p.length for p in pieces)
    assert total == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
    source = {i: s for i, _, s in rows}
    brought = dict.fromkeys(shares, 0)
    for p in pieces:
        if p.sequence_id < 4:  # the first window
            brought[queue[source[p.doc_id]]] += p.length
    assert sum(brought.values()) == 200
    assert all(abs(n - 200 * shares[q]) <= 1 for q, n in brought.items())
    assert packing.queue_weights({0: 100, 1: 300}, {0: 0.5}) == {0: 200, 1: 300}
