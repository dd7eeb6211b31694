"""Near-duplicate documents by SimHash fingerprints and tables of distances to pivots.

Method. Every distinct fingerprint gets its Hamming distances to a fixed set of reference
fingerprints: some random ones, and each of them with one block of bits flipped. The difference of
two such distances is the distance within that block. Fingerprints at most ``RADIUS`` bits apart
agree on at least ``BLOCKS - RADIUS`` blocks, so they agree on all pivot distances within those:
candidates meet by an equality join on them. A pair whose distance tables differ anywhere by more than
the radius is discarded unseen; the survivors' own distance is verified.

A cell with more than ``CROWD`` fingerprints is never paired out. Two fingerprints are at most two
bits apart exactly if one flip of a bit (or none) leads both to the same number, and at most 65
fingerprints lead to any number. So crowded fingerprints link to the smallest one at each number they
lead to: as exact, and linear in their count.

Defined results: a null text has no words and fingerprint zero, which links like any other; repeated
rows and ids give a row each; a null id never becomes a component id unless all ids of the component
are null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from selvatrace.llm.common import mixed, pick, written

RADIUS = 2
BLOCKS = 4
REFERENCES = 8
CROWD = 64
SHINGLE = 3
SEED = 42
#: Wide fingerprints: words of 64 bits, bits to a table, and the most bits that differ between sets worth comparing. Sets with a
#: Jaccard similarity of 0.8 differ in about 39 of 256 bits, with a deviation of 6; unlike sets in about 128.
WORDS, TABLE_BITS, WIDE_RADIUS = 4, 16, 72

_WIDTH = 64 // BLOCKS


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


_BLOCK_MASKS = [((1 << _WIDTH) - 1) << (_WIDTH * b) for b in range(BLOCKS)]
_RANDOM = [xxhash.xxh64_intdigest(f"pivot {r}", SEED) for r in range(REFERENCES)]


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of the words' shingles, as an unsigned number."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(size)], strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 255 * 64):  # byte sums of 255 rows cannot overflow
        part = h[i : i + 255 * 64]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for j in range(0, len(bits), 255):
            ones += np.add.reduce(bits[j : j + 255], axis=0, dtype=np.uint8)
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * ones > len(h))))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): one row per row of ``docs``; fp is the fingerprint as a signed bigint."""
    rows = pick(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_signed(fingerprint(t)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=[key, "fp"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, fp bigint")


def _distance(a: Column, b: Column | int) -> Column:
    other = F.lit(_signed(b)) if isinstance(b, int) else b
    return F.bit_count(a.bitwiseXOR(other))


def pivot_tables(fps: DataFrame) -> DataFrame:
    """Adds ``far`` (distances to the random references) and ``near`` (per block, the distances
    within it, each from the distances to a reference and to its twin with that block flipped)."""
    x = F.col("fp")
    far = [_distance(x, r) for r in _RANDOM]
    near = [
        F.array(*[((_distance(x, r) - _distance(x, r ^ m) + F.lit(_WIDTH)) / 2).cast("tinyint") for r in _RANDOM])
        for m in _BLOCK_MASKS
    ]
    return fps.withColumn("far", F.array(*[d.cast("tinyint") for d in far])).withColumn("near", F.array(*near))


def links(fps: DataFrame) -> DataFrame:
    """(a, b) with a < b: pairs of distinct fingerprints ``fp`` whose union of paths joins all that are
    within the radius of each other. Pairs in uncrowded cells come out one by one, crowded ones as stars."""
    cells = [
        F.struct(F.lit(n).alias("n"), F.xxhash64(F.lit(n), *[F.col("near")[b] for b in kept]).alias("cell"))
        for n, kept in enumerate(combinations(range(BLOCKS), BLOCKS - RADIUS))
    ]
    placed = (
        pivot_tables(fps)
        .select("fp", "far", F.explode(F.array(*cells)).alias("c"))
        .select("fp", "far", F.col("c.n").alias("n"), F.col("c.cell").alias("cell"))
    )
    shared = placed.groupBy("n", "cell").agg(F.count("*").alias("held")).filter("held > 1")
    members = written(placed.join(shared, ["n", "cell"]), "simhash-cells")
    few = members.filter(F.col("held") <= CROWD)
    one = few.select("n", "cell", F.col("fp").alias("a"), F.col("far").alias("fa"))
    two = few.select("n", "cell", F.col("fp").alias("b"), F.col("far").alias("fb"))
    apart = F.array_max(F.zip_with("fa", "fb", lambda p, q: F.abs(p - q)))
    pairs = (
        one.join(two, ["n", "cell"])
        .filter((F.col("a") < F.col("b")) & (apart <= RADIUS))
        .filter(_distance(F.col("a"), F.col("b")) <= RADIUS)
        .select("a", "b")
    )
    crowded = members.filter(F.col("held") > CROWD).select("fp").distinct()
    flips = F.array(F.lit(0), *[F.lit(_signed(1 << i)) for i in range(64)])
    at = Window.partitionBy("number")
    stars = (
        crowded.select("fp", F.explode(flips).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("number"))
        .select(F.min("fp").over(at).alias("a"), F.col("fp").alias("b"))
        .filter("a < b")
    )
    return pairs.union(stars).distinct()


_LANES, _SHIFTS = np.uint64(0x0101010101010101), np.arange(8, dtype=np.uint64)
_SEEDS = np.array([(w + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for w in range(WORDS)], dtype=np.uint64)


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """SimHash of a set of 64-bit hashes in ``WORDS`` signed numbers: a bit is 1 if set in over half of the remixed hashes."""
    ones = np.zeros((WORDS, 8, 8), dtype=np.int64)  # word, bit of a byte, byte
    for at in range(0, len(hashes), 255 * 16):
        h = mixed(hashes[None, at : at + 255 * 16] ^ _SEEDS[:, None])
        lanes = (h[:, None, :] >> _SHIFTS[None, :, None]) & _LANES
        sums = np.add.reduceat(lanes, np.arange(0, h.shape[1], 255), axis=2)  # byte sums of 255 rows cannot overflow
        ones += sums.view(np.uint8).reshape(WORDS, 8, -1, 8).sum(axis=2, dtype=np.int64)
    bits = (2 * ones > len(hashes)).transpose(0, 2, 1).reshape(WORDS, 64)
    return np.packbits(bits, axis=1, bitorder="little").view("<i8").reshape(WORDS)


def wide_links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b) with a < b: pairs of ``prints`` (node, n, print) that may be alike. They agree on one of the tables of
    ``TABLE_BITS`` bits, their sizes n are of one class (0.8 to 1), and at most ``WIDE_RADIUS`` bits differ. A cell of more than ``crowd``
    nodes compares each with its smallest only. Most similar pairs come out, not all: an exact join has to find the rest."""
    per, mask = 64 // TABLE_BITS, (1 << TABLE_BITS) - 1
    size = F.floor(F.log("n") / F.log(F.lit(1.25)))
    blocks = [F.shiftright(F.col("print")[t // per], TABLE_BITS * (t % per)).bitwiseAND(mask) for t in range(WORDS * per)]
    cells = F.array(*[F.xxhash64(F.lit(t), size, b) for t, b in enumerate(blocks)])
    within = Window.partitionBy("cell")
    placed = prints.select("node", F.explode(cells).alias("cell"))
    members = placed.select("node", "cell", F.count("*").over(within).alias("held"), F.min("node").over(within).alias("first"))
    members = written(members.filter("held > 1"), "simhash-tables")
    few = members.filter(F.col("held") <= crowd)
    one, two = (few.select("cell", F.col("node").alias(x)) for x in "ab")
    stars = members.filter((F.col("held") > crowd) & (F.col("first") < F.col("node"))).select(F.col("first").alias("a"), F.col("node").alias("b"))
    pairs = one.join(two, "cell").filter("a < b").select("a", "b").union(stars).distinct()
    one, two = (prints.select(F.col("node").alias(x), F.col("print").alias(f"print_{x}")) for x in "ab")
    apart = sum((_distance(F.col("print_a")[w], F.col("print_b")[w]) for w in range(1, WORDS)), _distance(F.col("print_a")[0], F.col("print_b")[0]))
    return pairs.join(one, "a").join(two, "b").filter(apart <= WIDE_RADIUS).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) can reach.

    Labels spread to neighbours and then jump to their label's label. A node of these edges has few
    neighbours (``links``), and no step gathers a component in one place.
    """
    both = written(edges.union(edges.select("b", "a")).toDF("node", "other"), "simhash-edges")
    labels = written(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "simhash-labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), "root"), "other")
        spread = (
            seen.select("node", "root")
            .union(labels)
            .groupBy("node")
            .agg(F.min("root").alias("near"))
        )
        jump = labels.select(F.col("node").alias("near"), F.col("root").alias("far"))
        moved = spread.join(jump, "near", "left").select("node", F.least("near", F.coalesce("far", "near")).alias("root"))
        after = written(moved, "simhash-labels")
        old = labels.select("node", F.col("root").alias("old"))
        if after.join(old, "node").filter("root <> old").limit(1).count() == 0:
            return after
        labels = after


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id): one row per row of ``docs``."""
    marked = written(fingerprints(docs, key, text), "simhash-fingerprints")
    groups = written(marked.groupBy("fp").agg(F.min(key).alias("first")), "simhash-groups")
    roots = components(links(groups.select("fp")))
    rooted = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


