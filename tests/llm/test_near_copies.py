"""Near copies against all pairs, and what the pipeline's stage leaves of them."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from selvatrace.llm import near_copies, simhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def changed(words, rng, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**9)}"
    return out


def made():
    """Texts of 4 to 300 words, copies with 1 to 12 words changed, and a crowd around one text."""
    rng = random.Random(3)
    out = [None, "", "one two", "One  TWO"]
    for _ in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((4, 5, 9, 60, 120, 300)))]
        out += [" ".join(words), *[" ".join(changed(words, rng, rng.randint(1, 12))) for _ in range(3)]]
    base = [f"c{i}" for i in range(150)]
    return out + [" ".join(changed(base, rng, rng.randint(1, 9))) for _ in range(60)]


def brute(texts):
    sets = [near_copies.shingles(t) for t in texts]
    root = list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if near_copies.alike(sets[a], sets[b]) and root[a] != root[b]:
            lo, hi = sorted((root[a], root[b]))
            root = [lo if r == hi else r for r in root]
    return root


@pytest.mark.parametrize("crowd", [64, 8])
def test_classes_equal_all_pairs(spark, crowd):
    texts = made()
    rows = spark.createDataFrame(list(enumerate(texts)), "row bigint, text string").repartition(3)
    got = {r.row: r.component for r in near_copies.classes(rows, crowd=crowd).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_stage_drops_near_copies(spark):
    texts = made()
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute(texts)))


def long_texts():
    """Texts of 250 to 1,500 words that share passages of any length, and copies with up to a tenth of their words changed."""
    rng, out = random.Random(8), []
    passage = [f"p{i}" for i in range(800)]
    for _ in range(14):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((250, 270, 600, 1500)))]
        words = passage[: rng.choice((0, 60, 400, 800))] + own
        out += [" ".join(words), *[" ".join(changed(words, rng, int(len(words) * rng.uniform(0.01, 0.06)))) for _ in range(3)]]
    return out


def test_finer_counts_never_discard_alike_texts():
    texts = long_texts()
    sets, own = [near_copies.shingles(t) for t in texts], list(near_copies.hashed(texts))
    fine = [near_copies.fine_counts(h) for h in own]
    unlike = passed = 0
    for a, b in combinations(range(len(texts)), 2):
        allowed = near_copies.finely_alike(fine[a], fine[b], len(own[a]), len(own[b]))
        if near_copies.alike(sets[a], sets[b]):
            assert allowed
        elif min(len(own[a]), len(own[b])) > near_copies.FINER:
            unlike, passed = unlike + 1, passed + allowed
    assert passed < 0.05 * unlike
    busy = near_copies.fine_counts(own[0][:1].repeat(2000))  # one class holds them all
    assert near_copies.finely_alike(busy, near_copies.fine_counts(own[1].repeat(3)), 2000, 2000)


def test_long_texts_equal_all_pairs(spark):
    texts = long_texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "row bigint, text string").repartition(3)
    assert {r.row: r.component for r in near_copies.classes(rows).collect()} == dict(enumerate(brute(texts)))


def test_wide_fingerprint_is_the_majority_of_each_bit():
    rng = random.Random(5)
    for n in (1, 2, 7, 255, 256, 4080, 4081, 9000):
        hashes = np.array([rng.getrandbits(64) for _ in range(n)], dtype=np.uint64)
        for seed, word in zip(simhash._SEEDS, simhash.wide_fingerprint(hashes).tolist(), strict=True):
            each = simhash.mixed(hashes ^ seed).tolist()
            assert word % (1 << 64) == sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in each) > n)


def noted(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "key bigint, text string").repartition(3)
    marked = near_copies.marks(rows, "key", "text").withColumn("node", F.monotonically_increasing_id()).localCheckpoint()
    return rows, marked, near_copies.grouped(marked).localCheckpoint()


def test_simhash_links_most_alike_sets_and_no_others(spark):
    texts = long_texts()
    rows, marked, nodes = noted(spark, texts)
    keys = {r.node: r.least for r in nodes.collect()}
    got = {tuple(sorted((keys[r.a], keys[r.b]))) for r in near_copies.similar(nodes, marked, rows).collect()}
    sets = [near_copies.shingles(t) for t in texts]
    want = {p for p in combinations(range(len(texts)), 2) if near_copies.alike(sets[p[0]], sets[p[1]])}
    assert got <= want and len(got) > 0.6 * len(want)


@pytest.mark.parametrize("crowd", [64, 3])
def test_wide_links_within_cells(spark, crowd):
    rows = [(i, 100, [1, 2, 3, 4 ^ (1 << i)]) for i in range(6)] + [(9, 900, [1, 2, 3, 4]), (10, 100, [~1, ~2, ~3, ~4])]
    prints = spark.createDataFrame(rows, "node bigint, n bigint, print array<bigint>")
    got = {(r.a, r.b) for r in simhash.wide_links(prints, crowd).collect()}
    # A crowded cell has its smallest node as star; cells of the last word's table hold one node each.
    assert got == (set(combinations(range(6), 2)) if crowd == 64 else {(0, i) for i in range(1, 6)})


def test_tokens_meet_once_and_busy_ones_are_counted_first(spark):
    busy = near_copies.BUSY << 56
    rows = [(t, n) for t in (5, busy + 5) for n in range(7)] + [(6, 1), (busy + 6, 1), (7, 1), (7, 2)]
    placed = spark.createDataFrame(rows, "token bigint, node bigint").repartition(2)
    got = sorted(tuple(r) for r in near_copies.cells(placed).select("token", "node", "held").collect())
    assert got == sorted([(t, n, 7) for t in (5, busy + 5) for n in range(7)] + [(7, 1, 2), (7, 2, 2)])


def test_stage_shuffles_only_texts_in_doubt(spark, tmp_path):
    """Of documents without copies no text is shuffled, even where nothing is small enough to be sent to all."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(i, f"a{i} b{i} c{i} d{i} e{i} " * 3, "en", "s", 0) for i in range(60)] + [(77, "a7 b7 c7 d7 e7 " * 3, "en", "s", 0)] * 2, SCHEMA)
        docs.write.parquet(str(tmp_path / "docs"))
        kept = corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(str(tmp_path / "docs")), "")
        assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
        alone, doubtful = near_copies.split(docs, ["doc_id"], docs.filter("doc_id = 77"))
        assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
        assert alone.count() + doubtful.count() == 62 and doubtful.filter("doc_id = 77").count() == 2 and doubtful.count() < 6
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "LeftSemi" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
