"""Benchmark passages in documents, found by winnowed fingerprints.

Method. A text's words are hashed, ``GRAM`` consecutive words make a k-gram, and every window of
``WINDOW - GRAM + 1`` k-grams keeps the one with the smallest hash (the last of equals). A document and an
item that share ``WINDOW`` words keep the same k-gram of them, so no shared span of that length escapes.
Documents and items are joined on the kept hashes, and each hit is extended word by word to both
sides; only runs of ``WINDOW`` equal words count. Items shorter than that are one window of all their words, and are
joined on the hash of the whole.

A Bloom filter of the items' hashes, of fixed size, drops document hashes that cannot join before
they leave the task. If the benchmark is very large the filter lets more through and the result
stays the same. Whether the join is a broadcast or a shuffle is Spark's choice by size.

Defined results: a null text has no words; items without words or id match nothing; repeated items count once by
id; repeated rows of documents give a row each; empty tables give no rows, or documents without hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selvatrace.llm.common import lean, mixed, pick, slabs

WINDOW = 10
GRAM = 5
#: Size of the Bloom filter: 2 ** 23 bits, one megabyte.
BLOOM_LOG2 = 23

_SIDE = WINDOW - GRAM
#: A-Z to lower case; bytes that are neither digit, letter nor part of a longer character to a blank.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    np.multiply.accumulate(np.full(n - 1, _BASE | np.uint64(1)), out=out[1:]) if n > 1 else None
    return out


def folded(text: str | None) -> bytes:
    """The text's bytes with all that separates words turned into blanks."""
    return (text or "").encode("utf-8", "replace").translate(_WORD_BYTES)


def word_hashes(joined: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word of folded bytes."""
    raw = np.frombuffer(joined, dtype=np.uint8)
    inside = np.empty(len(raw) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    np.not_equal(raw, 32, out=inside[1:-1].view(bool))
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    letters = raw[raw != 32].astype(np.uint64)
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(firsts, lengths)
    powers = _powers(int(lengths.max()))
    return starts, ends, mixed(np.add.reduceat(letters * powers[place], firsts) + lengths.astype(np.uint64))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words, one for each start that leaves room."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        total = total * _BASE + words[j : j + n]
    return mixed(total + np.uint64(size))


def winnow(grams: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Starts of the k-grams that some window of one text keeps. ``owner``: the text of each word."""
    span = WINDOW - GRAM + 1
    n = len(owner) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best = grams[:n].copy()
    at = np.zeros(n, dtype=np.int64)
    for j in range(1, span):
        other = grams[j : j + n]
        take = other <= best
        best[take] = other[take]
        at[take] = j
    whole = owner[:n] == owner[WINDOW - 1 :]
    return np.unique((np.arange(n) + at)[whole])


def filter_bits(hashes: np.ndarray) -> np.ndarray:
    mask = np.uint64((1 << BLOOM_LOG2) - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(32)) & mask])


_KIND = "kind int, fp bigint, pos int, left array<string>, gram array<string>, right array<string>"


def _found(joined: bytes, starts: np.ndarray, ends: np.ndarray, lo: int, hi: int, at: int, size: int) -> tuple:
    """Words before (nearest first), of, and after the k-gram at word ``at``; lo, hi bound its text."""
    word = lambda i: joined[starts[i] : ends[i]].decode("utf-8", "replace")
    side = _SIDE if size == GRAM else 0
    left = [word(i) for i in range(at - 1, max(lo, at - side) - 1, -1)]
    right = [word(i) for i in range(at + size, min(hi, at + size + side))]
    return left, [word(i) for i in range(at, at + size)], right


def item_fingerprints(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, kind, fp, pos, left, gram, right): the kept k-grams of each item with the words around them."""
    rows = pick(items, key, text).select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
    rows = rows.filter("item IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for item, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                joined = folded(t)
                starts, ends, words = word_hashes(joined)
                n = len(words)
                size = GRAM if n >= WINDOW else n
                if not n:
                    continue
                grams = gram_hashes(words, size)
                keep = winnow(grams, np.zeros(n, dtype=np.int64)) if n >= WINDOW else [0]
                kind = 0 if n >= WINDOW else n
                for p in keep:
                    fp = int(grams[p].view(np.int64)) if kind == 0 else int(mixed(grams[p : p + 1] + np.uint64(kind))[0].view(np.int64))
                    out.append((item, kind, fp, int(p), *_found(joined, starts, ends, 0, n, int(p), size)))
            yield _batch(out, _ITEM_TYPES)

    return rows.mapInArrow(lean(run), f"item string, {_KIND}")


_WORDS = pa.list_(pa.string())
_HIT_TYPES = [pa.int32(), pa.int64(), pa.int32(), _WORDS, _WORDS, _WORDS]
_ITEM_TYPES = [pa.string(), *_HIT_TYPES]
_NAMES = ["kind", "fp", "pos", "left", "gram", "right"]


def _batch(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in types]
    names = ["item", *_NAMES] if len(types) == 7 else _NAMES
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)


def bloom(prints: DataFrame) -> np.ndarray:
    """The filter's bytes. At most 2 ** BLOOM_LOG2 / 64 numbers come to the driver."""
    mask = (1 << BLOOM_LOG2) - 1
    bits = prints.select(
        F.explode(F.array(F.col("fp").bitwiseAND(mask), F.shiftrightunsigned("fp", 32).bitwiseAND(mask))).alias("bit")
    )
    words = (
        bits.select(F.shiftright("bit", 6).alias("w"), F.expr("shiftleft(1L, CAST(bit & 63 AS INT))").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .collect()
    )
    out = np.zeros(1 << (BLOOM_LOG2 - 6), dtype=np.int64)
    for r in words:
        out[r["w"]] = r["b"]
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def document_fingerprints(docs: DataFrame, key: str, text: str, sieve: np.ndarray, short: list[int]) -> DataFrame:
    """(key, text_hash, n_words, kind, fp, ...): one row with a null kind for each document, and one for
    each of its kept k-grams that passes the filter. ``short``: the lengths of items below a window."""
    rows = pick(docs, key, text).select(key, text, F.xxhash64(text).alias("text_hash"))
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(sieve, bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = np.unpackbits(packed.value, bitorder="little").astype(bool)

        def may(hashes: np.ndarray) -> np.ndarray:
            a, b = filter_bits(hashes)
            return passing[a] & passing[b]

        for batch in batches:
            texts = [folded(t) for t in batch.column(1).to_pylist()]
            counts = np.zeros(len(texts), dtype=np.int64)
            whose: list[int] = []
            hits: list[tuple] = []
            for lo, hi in slabs(texts):
                joined = b" ".join(texts[lo:hi])
                ends_of = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
                starts, ends, words = word_hashes(joined)
                owner = np.searchsorted(ends_of, starts, side="right")
                held = np.bincount(owner, minlength=hi - lo)
                counts[lo:hi] = held
                last = np.cumsum(held)
                grams = gram_hashes(words, GRAM)
                kept = winnow(grams, owner)
                found = [(0, GRAM, kept[may(grams[kept])], grams)]
                for size in short:
                    whole = mixed(gram_hashes(words, size) + np.uint64(size))
                    at = np.flatnonzero(owner[: len(whole)] == owner[size - 1 :]) if len(whole) else np.zeros(0, np.int64)
                    found.append((size, size, at[may(whole[at])], whole))
                for kind, size, at, hashes in found:
                    for p in at.tolist():
                        d = int(owner[p])
                        first = int(last[d] - held[d])
                        whose.append(lo + d)
                        parts = _found(joined, starts, ends, first, int(last[d]), p, size)
                        hits.append((kind, int(hashes[p].view(np.int64)), p - first, *parts))
            index = pa.array([*range(len(texts)), *whose], pa.int64())
            found_rows = _batch(hits, _HIT_TYPES)
            columns = [pa.concat_arrays([pa.nulls(len(texts), c.type), c]) for c in found_rows.columns]
            base = [batch.column(0).take(index), batch.column(2).take(index), pa.array(counts).take(index)]
            yield pa.RecordBatch.from_arrays([*base, *columns], names=[key, "text_hash", "n_words", *_NAMES])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"`{key}` {kind}, text_hash bigint, n_words bigint, {_KIND}")


def _equal_run(a: str, b: str):
    """How many leading words two arrays have in common."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same))


def _merged(hits: DataFrame) -> DataFrame:
    """``hits`` with the runs of words in sorted ``hits`` merged into ``spans``, in one pass, and their words counted in ``n_hit``."""
    kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    names = hits.columns
    at, rest = names.index("hits"), [c for c in names if c != "hits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, counts = [], []
            for i in range(b.num_rows):
                one = b.column(at)[i].values
                starts, ends = (one.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                reach = np.maximum.accumulate(ends)
                first = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]]) if len(starts) else np.zeros(0, np.int64)
                lows, highs = starts[first], reach[np.r_[first[1:] - 1, len(starts) - 1]] if len(starts) else first
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(lows, highs, strict=True)])
                counts.append(int((highs - lows).sum()))
            out = {c: b.column(names.index(c)) for c in rest}
            yield pa.RecordBatch.from_pydict(out | {"spans": pa.array(spans, kinds), "n_hit": pa.array(counts, pa.int64())})

    schema = ", ".join(f"`{c}` {hits.schema[c].dataType.simpleString()}" for c in rest)
    return hits.mapInArrow(lean(run), f"{schema}, spans array<struct<start:int,end:int>>, n_hit bigint")


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(key, n_words, n_hit, item_ids, spans): one row per row of ``docs``. ``item_ids``: the items with a
    window in the text, as sorted strings; ``spans``: the hit runs of words, merged, as (start, end)."""
    prints = item_fingerprints(items, item_key, item_text).distinct()
    short = [r["kind"] for r in prints.filter("kind > 0").select("kind").distinct().collect()]  # below WINDOW
    held = document_fingerprints(docs, key, text, bloom(prints), sorted(short))
    # A document's own row joins nothing; its hash spreads such rows over the partitions.
    held = held.withColumn("fp", F.coalesce("fp", F.xxhash64("text_hash", key))).withColumn("kind", F.coalesce("kind", F.lit(-1)))
    theirs = prints.select(
        "kind", "fp", "item", F.col("left").alias("l2"), F.col("gram").alias("g2"), F.col("right").alias("r2")
    )
    met = held.join(theirs, ["kind", "fp"], "left")
    before, after = _equal_run("left", "l2"), _equal_run("right", "r2")
    size = F.size("gram")
    enough = F.when(F.col("kind") > 0, F.lit(0)).otherwise(F.lit(WINDOW))
    hit = F.when(
        (F.col("gram") == F.col("g2")) & (before + size + after >= enough),
        F.struct((F.col("pos") - before).cast("int").alias("start"), (F.col("pos") + size + after).cast("int").alias("end")),
    )
    per_doc = (
        met.select(key, "text_hash", "n_words", (F.col("kind") == -1).cast("int").alias("own"), hit.alias("hit"), "item")
        .groupBy(key, "text_hash", "n_words")
        .agg(
            F.sum("own").alias("repeats"),
            F.array_sort(F.collect_set("hit")).alias("hits"),
            F.array_sort(F.collect_set(F.when(F.col("hit").isNotNull(), F.col("item")))).alias("item_ids"),
        )
    )
    counted = _merged(per_doc)
    again = F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))
    return counted.select(key, "n_words", "n_hit", "item_ids", "spans", again.alias("_")).drop("_")
