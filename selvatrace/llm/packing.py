"""Packing documents into token sequences by mixture-controlled deficit round-robin.

Method. Each source is a queue of its documents' tokens. Windows of ``WINDOW`` tokens are filled
from all queues in turn: in window k a queue may bring its tokens up to floor(weight * time), where time is the
share of the mixture served by the end of that window. What a queue is owed beyond whole tokens is
carried on, so at every window its total is within one token of its target. An empty queue leaves its share to the rest in
proportion to their weights. Windows follow each other without gaps and are cut every ``SEQUENCE`` tokens.

Because the rounds only depend on queue totals, no task has to play them in order: a token's window and
place follow from its position in its queue. Positions come from running totals within each task,
written with the tokens, and from the totals of the tasks before. So deficits carry over windows and partitions alike.

The last tokens that fill no sequence are cut into sequences of 512, 256, ... tokens, which need no padding.

Proportions hold for windows. Within one, each source is one run, so most sequences of 1,024 tokens are of one source.

Defined results: a null text is empty, so its document is one closing token; a null source is a queue
of its own; sources that share a queue (see ``QUEUES``) share the sum of their targets; repeated rows are packed each; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from selvatrace.llm.common import lean, pick, written

SEQUENCE = 1024
#: Tokens that one round over the queues brings.
WINDOW = 64 * SEQUENCE
CLOSING = 0
#: Each source has its own queue up to this number of sources; beyond it they share queues by hash, which bounds what the driver sees.
QUEUES = 4096
#: Rows of the table of queue totals per task, three numbers each, that are broadcast.
BROADCAST_ROWS = 200_000
#: Rows that go to Python at once in the pipeline: distinct words of a batch are encoded once, so more rows save time.
BATCH_ROWS = 1000
#: Bytes of text whose distinct words are encoded together.
PART_BYTES = 16 << 20
#: White space other than single blanks and line ends between words may group differently: no parts then.
ODD = r"\s\s|[^\S \n]|^ | $|\n$|[\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


class Encoder:
    """Token ids as little-endian unsigned 16-bit numbers, for the vocabulary at ``path``.

    A blank between two other characters always starts a token, so texts fall apart there; each distinct
    part of a slab is encoded once, all in one go, and told apart by its bytes.
    """

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode = encoding.encode_to_numpy
        self.size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        self.size[list(ranks.values())] = [len(b) for b in ranks]

    def whole(self, text: str) -> np.ndarray:
        return self.encode(text, allowed_special=set(), disallowed_special=()).astype("<u2")

    def ids(self, texts: pa.Array) -> pa.Array:
        """Ids of each text of a string array without nulls."""
        odd = pc.match_substring_regex(texts, ODD)
        split = pc.split_pattern(pc.if_else(odd, pa.scalar(""), texts), " ")
        bounds, parts = split.offsets.to_numpy(), split.flatten()
        bounds = bounds - bounds[0]
        first = np.zeros(len(parts), dtype=bool)
        first[bounds[:-1]] = True
        rest = parts.filter(pa.array(~first)).dictionary_encode()
        known = rest.dictionary
        starts = parts.filter(pa.array(first)).to_pylist()
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            starts[i] = texts[i].as_py()
        heads = [self.whole(t).tobytes() for t in starts]
        if len(known):
            joined = pc.binary_join(pa.array([known.to_pylist()], pa.list_(pa.string())), " ")[0].as_py()
            raw = self.whole(" " + joined)
            bytes_to = np.cumsum(pc.binary_length(known).to_numpy() + 1)
            cut = 2 * (np.searchsorted(np.cumsum(self.size[raw]), bytes_to) + 1)
            ends = np.concatenate([[0], cut]).astype(np.int32)
            encoded = pa.Array.from_buffers(pa.binary(), len(known), [None, pa.py_buffer(ends), pa.py_buffer(raw.tobytes())])
        else:
            encoded = pa.array([], pa.binary())
        index = np.empty(len(parts), dtype=np.int64)
        index[~first] = rest.indices.to_numpy()
        index[first] = len(known) + np.arange(len(heads))
        flat = pa.concat_arrays([encoded, pa.array(heads, pa.binary())]).take(pa.array(index))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat), b"")


def sources_of(docs: DataFrame, source: str, most: int) -> list[str | None] | None:
    """The distinct sources in order, null last; None where there are more than ``most``."""
    rows = pick(docs, source).select(F.col(source).cast("string").alias("s")).distinct().limit(most + 1).collect()
    return None if len(rows) > most else sorted((r["s"] for r in rows), key=lambda s: (s is None, s or ""))


def queue_weights(totals: dict[int, int], targets: dict[int, float]) -> dict[int, int]:
    """Weight of each queue: its share of all tokens if it has a target, else its tokens."""
    whole = sum(totals.values())
    return {q: max(1, round(targets[q] * whole)) if q in targets else n for q, n in totals.items()}


def tokens(
    docs: DataFrame, vocabulary: str, key: str, text: str, source: str, queues: int, names: list[str | None] | None = None
) -> DataFrame:
    """(key, queue, task, before, n, ids): each document's ids with the closing one, and how many ids of
    its queue its task had before it. A queue is the place of the source in ``names``, or a hash of the source where there are
    none. Written, so that tasks and their order stay what they are."""
    number = F.pmod(F.xxhash64(F.col(source).cast("string")), F.lit(queues)).cast("int") if names is None else F.col(source).cast("string")
    rows = pick(docs, key, text, source).select(key, text, number.alias("queue"))
    closing = np.array([CLOSING], dtype="<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        task = TaskContext.get().partitionId()
        had: dict[int, int] = {}
        for b in batches:
            told = b.column(2) if names is None else pc.index_in(b.column(2), pa.array(names, pa.string()))
            texts = pc.fill_null(b.column(1), "")
            starts = [0, *np.flatnonzero(np.diff(np.cumsum(pc.binary_length(texts).to_numpy()) // PART_BYTES)) + 1, len(texts)]
            pieces = [encoder.ids(texts.slice(i, j - i)) for i, j in zip(starts, starts[1:]) if j > i]
            ids = pc.binary_join_element_wise(pa.concat_arrays(pieces) if pieces else pa.array([], pa.binary()), closing, b"")
            lengths = (pc.binary_length(ids).to_numpy() // 2).tolist()
            before = []
            for q, n in zip(told.to_pylist(), lengths, strict=True):
                at = had.get(q, 0)
                before.append(at)
                had[q] = at + n
            columns = [
                b.column(0), told, pa.array([task] * len(ids), pa.int32()),
                pa.array(before, pa.int64()), pa.array(lengths, pa.int64()), ids,
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "queue", "task", "before", "n", "ids"])

    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, queue int, task int, before bigint, n bigint, ids binary"
    return written(rows.mapInArrow(lean(run), schema), "packing-tokens")


class Rounds:
    """Where each queue stands after each window. ``totals``: tokens by queue; ``weights``: their shares."""

    def __init__(self, totals: dict[int, int], weights: dict[int, int], window: int, sequence: int):
        self.window, self.sequence = window, sequence
        self.queues = sorted(q for q, n in totals.items() if n)
        self.totals = {q: totals[q] for q in self.queues}
        self.weights = {q: weights[q] for q in self.queues}
        self.total = sum(self.totals.values())
        # Time at which each queue runs dry, and all tokens served and weights left from there on.
        self.phases = [(Fraction(0), Fraction(0), sum(self.weights.values()))]
        for dry in sorted({Fraction(self.totals[q], self.weights[q]) for q in self.queues}):
            time, served, weight = self.phases[-1]
            left = sum(w for q, w in self.weights.items() if Fraction(self.totals[q], w) > dry)
            self.phases.append((dry, served + (dry - time) * weight, left))
        self.seen: dict[int, tuple] = {}
        self.full = self.total - self.total % sequence

    def _time(self, served: int) -> Fraction:
        time, start, weight = max((p for p in self.phases if p[1] <= served), key=lambda p: p[1])
        return time + (Fraction(served - start) / weight if weight else 0)

    def _stand(self, k: int) -> dict[int, int]:
        if k * self.window >= self.total:
            return self.totals
        time = self._time(k * self.window)
        return {q: min(n, self.weights[q] * time.numerator // time.denominator) for q, n in self.totals.items()}

    def at(self, k: int) -> tuple[dict[int, int], dict[int, int], dict[int, int]]:
        """For window k: where each queue starts and ends, and where its tokens go."""
        if k not in self.seen:
            if len(self.seen) > 4096:
                self.seen.clear()
            start, end = self._stand(k), self._stand(k + 1)
            place, put = sum(start.values()), {}
            for q in self.queues:
                put[q] = place
                place += end[q] - start[q]
            self.seen[k] = (start, end, put)
        return self.seen[k]

    def window_of(self, queue: int, position: int) -> int:
        """The window that takes the token at ``position`` of ``queue``."""
        time = Fraction(position, self.weights[queue])
        start, served, weight = max((p for p in self.phases if p[0] <= time), key=lambda p: p[0])
        k = int((served + (time - start) * weight) // self.window)
        while k and self.at(k)[0][queue] > position:
            k -= 1
        while self.at(k)[1][queue] <= position:
            k += 1
        return k

    def sequence_of(self, place: int) -> tuple[int, int, int]:
        """Sequence, offset in it and its length for a place in the whole stream."""
        if place < self.full:
            return place // self.sequence, place % self.sequence, self.sequence
        number, start, rest = self.full // self.sequence, self.full, self.total - self.full
        while True:
            size = 1 << (rest.bit_length() - 1)
            if place < start + size:
                return number, place - start, size
            number, start, rest = number + 1, start + size, rest - size

    def pieces(self, queue: int, position: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of each piece of the ``n`` tokens at ``position``."""
        done, k = 0, self.window_of(queue, position)
        while done < n:
            start, end, put = self.at(k)
            most = min(n - done, end[queue] - position - done)
            while most > 0:
                number, offset, size = self.sequence_of(put[queue] + position + done - start[queue])
                length = min(most, size - offset)
                yield done, length, number, offset
                done += length
                most -= length
            k += 1


def packed(
    docs: DataFrame,
    vocabulary: str,
    targets: dict[str, float] | None = None,
    window: int = WINDOW,
    sequence: int = SEQUENCE,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row per piece.

    ``vocabulary``: path of the ranks on every machine. ``targets``: share of each source in a window;
    sources without one, and all where it is None, get their share of the tokens.
    """
    spark = docs.sparkSession
    names = sources_of(docs, source, QUEUES)
    held = tokens(docs, vocabulary, key, text, source, QUEUES, names)
    by_task = held.groupBy("queue", "task").agg(F.sum("n").alias("n"))
    per_queue = by_task.groupBy("queue").agg(F.sum("n").alias("n"), F.count("*").alias("tasks")).collect()
    totals = {r["queue"]: r["n"] for r in per_queue}
    shares: dict[int, float] = {}
    if targets and names is not None:
        shares = {q: targets[s] for q, s in enumerate(names) if s in targets}
    elif targets:
        named = spark.createDataFrame(list(targets.items()), "source string, share double")
        numbered = named.select(F.pmod(F.xxhash64("source"), F.lit(QUEUES)).cast("int").alias("q"), "share")
        shares = {r["q"]: r["share"] for r in numbered.groupBy("q").agg(F.sum("share").alias("share")).collect()}
    rounds = Rounds(totals, queue_weights(totals, shares), window, sequence)
    # Running totals over tasks: one row per queue and task.
    earlier = Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("queue", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    if sum(r["tasks"] for r in per_queue) <= BROADCAST_ROWS:  # else Spark shuffles both sides
        offsets = F.broadcast(offsets)
    placed = held.join(offsets, ["queue", "task"]).select(
        key, "queue", (F.col("before") + F.col("ahead")).alias("position"), "ids"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, out = [], []
            queues, positions, all_ids = (b.column(i).to_pylist() for i in (1, 2, 3))
            for i, (q, position, raw) in enumerate(zip(queues, positions, all_ids, strict=True)):
                ids = np.frombuffer(raw, dtype="<u2").astype("<u4")
                for start, length, number, offset in rounds.pieces(q, position, len(ids)):
                    index.append(i)
                    out.append((start, length, zlib.crc32(ids[start : start + length]), len(ids), number, offset))
            columns = zip(*out, strict=True) if out else [[]] * 6
            names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(index, pa.int64())), *[pa.array(c, pa.int64()) for c in columns]], names=names
            )

    kind = held.schema[key].dataType.simpleString()
    longs = ", ".join(f"{c} bigint" for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
    return placed.mapInArrow(lean(run), f"`{key}` {kind}, {longs}")
