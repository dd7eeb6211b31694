"""Rows of bits, 64 to a word: read, united by the nodes that they belong to, and counted, inside tasks.

Executors need numpy (2.0 or later) and pyarrow, but not this package: its functions travel with the tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDE = 32  # words in a row of bits, which stands for up to 2,048 origins
MET_ROWS = 1 << 17  # rows of bits that a task looks at in one go, about 32 MB

#: Makes a batch of nodes and of rows, in order of their nodes: the place of the node, the block of origins and, for each step, the
#: bits of those that reach the node within it.
Finish = Callable[[pa.Array, np.ndarray, np.ndarray, list[np.ndarray]], pa.RecordBatch]


def as_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of bits as words."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u8").reshape(-1, WIDE)


def as_column(bits: np.ndarray) -> pa.Array:
    bits = np.ascontiguousarray(bits)
    ends = np.arange(len(bits) + 1, dtype=np.int32) * (8 * WIDE)
    return pa.Array.from_buffers(pa.binary(), len(bits), [None, pa.py_buffer(ends), pa.py_buffer(bits)])


def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of bits with the one that is at ``at``."""
    for b in batches:
        at = b.column(2).to_numpy()
        bits = np.zeros((len(at), WIDE), dtype=np.uint64)
        bits[np.arange(len(at)), at >> 6] = np.uint64(1) << (at & 63).astype(np.uint64)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), as_column(bits)], names=["src", "_block", "_bits"])


def bits_kind(n_steps: int) -> str:
    return ", ".join(["_block bigint", *[f"_r{i} binary" for i in range(n_steps)]])


def as_bits(nodes: pa.Array, owner: np.ndarray, block: np.ndarray, within: list[np.ndarray]) -> pa.RecordBatch:
    names = ["node", "_block", *[f"_r{i}" for i in range(len(within))]]
    return pa.RecordBatch.from_arrays([nodes.take(pa.array(owner)), pa.array(block), *map(as_column, within)], names=names)


def finished(finish: Finish) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield finish(b.column(0), np.arange(b.num_rows), b.column(1).to_numpy(), [as_matrix(b.column(i)) for i in range(2, b.num_columns)])

    return run


def packed(part: pa.Table, n_steps: int) -> tuple[np.ndarray, pa.Array, list[tuple]]:
    """The blocks and nodes of a part and, for each step: where the rows of each node begin, the place of each row's block, and the
    rows. Where nodes have rows of most blocks, those of a node are one, and its block is the first."""
    blocks, steps = np.unique(part.column("_block").to_numpy()), []
    src = part.column("src").combine_chunks().dictionary_encode()
    codes, step = src.indices.to_numpy(), part.column("_step").to_numpy()
    places = np.searchsorted(blocks, part.column("_block").to_numpy())
    for i in range(n_steps):
        held = np.flatnonzero(step == i)
        held = held[np.argsort(codes[held], kind="stable")]
        bits = as_matrix(part.column("_bits").take(pa.array(held)))
        code, place = codes[held], places[held]
        n = np.bincount(code, minlength=len(src.dictionary))
        if len(blocks) > 1 and 2 * len(held) >= len(blocks) * np.count_nonzero(n):
            wide = np.zeros((np.count_nonzero(n), len(blocks), WIDE), dtype=np.uint64)
            n = n > 0
            wide[(np.cumsum(n) - 1)[code], place] = bits
            bits, place = wide.reshape(len(wide), -1), np.zeros(len(wide), dtype=np.int64)
        steps.append((np.append(0, np.cumsum(n)), place, bits))
    return blocks, src.dictionary, steps


def finder(known: pa.Array) -> Callable[[pa.Array], np.ndarray]:
    """Where in ``known`` values are; -1 for others."""
    if pa.types.is_integer(known.type) and len(known):
        values = known.to_numpy().astype(np.int64)
        low, span = int(values.min()), int(values.max()) - int(values.min())
        if span < (1 << 20) + 8 * len(values):
            place = np.full(span + 3, -1, dtype=np.int64)
            place[values - low + 1] = np.arange(len(values))
            # What wraps around lies outside too.
            return lambda asked: place[np.clip(asked.to_numpy().astype(np.int64) - low, -1, span + 1) + 1]
    return lambda asked: pc.fill_null(pc.index_in(asked, value_set=known.cast(asked.type)), -1).to_numpy()


def met(sent: Broadcast, finish: Finish) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: what ``finish`` makes of nodes that any of the sent nodes leads to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, known, steps = sent.value
        find = finder(known)
        for b in batches:
            lists = b.column(1)
            at = find(lists.flatten())
            hit = np.flatnonzero(at >= 0)
            owners, at = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[hit], at[hit]
            asked = []
            for start, _, bits in steps:
                first = start[at]
                n = start[at + 1] - first
                some = slice(None) if n.all() else np.flatnonzero(n)
                asked.append((owners[some], first[some], n[some], bits.shape[1] // WIDE))
            # Nodes are taken together up to MET_ROWS rows of bits, a larger one alone.
            rows = np.cumsum(np.sum([width * np.bincount(o, n, len(lists)) for o, _, n, width in asked], axis=0))
            total = rows[-1] if len(rows) else 0
            cut = np.unique(np.searchsorted(rows, np.arange(0, total + MET_ROWS, MET_ROWS), side="right"))
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                each = []
                for (owner, first, n, _), (_, place, bits) in zip(asked, steps, strict=True):
                    a, z = np.searchsorted(owner, (lo, hi))
                    each.append(united(owner[a:z] - lo, first[a:z], n[a:z], place, len(blocks), bits))
                keys = each[-1][0]  # what is reached within fewer steps is among them
                if not len(keys):
                    continue
                within = [np.zeros((len(keys), WIDE), dtype=np.uint64) for _ in each[:-1]] + [each[-1][1]]
                for whole, (some, words) in zip(within[:-1], each[:-1], strict=True):
                    whole[np.searchsorted(keys, some)] = words
                yield finish(b.column(0).slice(lo, hi - lo), keys // len(blocks), blocks[keys % len(blocks)], within)

    return run


def united(owner: np.ndarray, first: np.ndarray, n: np.ndarray, place: np.ndarray, n_blocks: int, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, each an owner and the place of a block, in order, and the union of their rows of ``bits``: ``n`` from ``first`` on."""
    width = bits.shape[1] // WIDE
    each = n_blocks if width == 1 else 1
    ends = np.cumsum(n)
    got: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - n[at] + 2 * MET_ROWS // width)))
        many = n[at:to]
        row = np.repeat(first[at:to] - (ends[at:to] - many - (ends[at] - many[0])), many) + np.arange(many.sum())
        got.append(or_by(np.repeat(owner[at:to], many) * each + place[row], bits, row))
        if len(got) > 1:  # of an owner that fills more than one round
            key, words = (np.concatenate(x) for x in zip(*got, strict=True))
            got = [or_by(key, words, np.arange(len(key)))]
        at = to
    if not got:
        return np.zeros(0, dtype=np.int64), np.zeros((0, WIDE), dtype=np.uint64)
    key, words = got[0]
    if each == n_blocks:
        return key, words
    key, words = (key[:, None] * n_blocks + np.arange(n_blocks)).ravel(), words.reshape(-1, WIDE)
    some = words.any(axis=1)
    return (key, words) if some.all() else (key[some], words[some])


def or_by(key: np.ndarray, bits: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the union of the rows ``row`` of ``bits`` that have each."""
    at_once = max(16, 1024 * WIDE // bits.shape[1])
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, row = key[order], row[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    n = np.diff(np.append(first, len(key)))
    out = np.empty((len(first), bits.shape[1]), dtype=np.uint64)
    order = np.argsort(-n, kind="stable")
    long = int(np.count_nonzero(n > 1024))
    for i in order[:long]:
        held = row[first[i] : first[i] + n[i]]
        out[i] = reduce(np.bitwise_or, [np.bitwise_or.reduce(bits[held[a : a + at_once]], axis=0) for a in range(0, len(held), at_once)])
    more = np.empty((at_once, bits.shape[1]), dtype=np.uint64)
    for a in range(long, len(order), at_once):
        some = order[a : a + at_once]
        start, size = first[some], n[some]
        union = bits[row[start]]
        # The k-th rows of all keys that have so many; the keys with most rows come first.
        have = len(size) - np.searchsorted(size[::-1], np.arange(1, size[0]), side="right")
        for k, m in enumerate(have.tolist(), 1):
            np.take(bits, row[start[:m] + k], axis=0, out=more[:m], mode="clip")
            np.bitwise_or(union[:m], more[:m], out=union[:m])
        out[some] = union
    return key[first], out


def pairs(n_steps: int, names: Broadcast | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow`` over (node, _block, bits within each step): (node, depth, those origins of the block that reach the node
    first at that depth). ``names``: the first number of each block and all origins in order; else the row's last column has its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if names is not None:
                blocks, starts, origins = names.value
                start = starts[np.searchsorted(blocks, b.column(1).to_numpy())]
            else:
                origins, start = b.column(b.num_columns - 1).flatten(), b.column(b.num_columns - 1).offsets.to_numpy()
                start = start[:-1] - start[0]
            fixed = not origins.null_count and pa.types.is_primitive(origins.type) and not pa.types.is_boolean(origins.type)
            held = origins.to_numpy() if fixed else None
            for lo in range(0, b.num_rows, 512):
                before = np.uint64(0)
                for depth in range(1, n_steps + 1):
                    now = as_matrix(b.column(depth + 1).slice(lo, 512))
                    fresh, before = now & ~before, now
                    kept = np.flatnonzero(fresh.any(axis=1))
                    if not len(kept):
                        continue
                    fresh = fresh[kept]
                    at = np.flatnonzero(np.unpackbits(fresh.view(np.uint8), bitorder="little").view(bool))
                    no = start[lo + kept][at // (64 * WIDE)] + at % (64 * WIDE)
                    each = pa.array(held[no], origins.type) if fixed else origins.take(pa.array(no))
                    ends = np.append(0, np.cumsum(np.bitwise_count(fresh).sum(axis=1, dtype=np.int64))).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), each)
                    columns = [b.column(0).take(pa.array(lo + kept)), pa.array(np.full(len(kept), depth, dtype=np.int32)), lists]
                    yield pa.RecordBatch.from_arrays(columns, names=["node", "depth", "_origins"])

    return run


def as_names(named: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The blocks of numbered origins, where each begins, and the origins in order of their numbers."""
    no = named.column("_no").to_numpy()
    order = np.argsort(no)
    blocks, starts = np.unique(no[order] // (64 * WIDE), return_index=True)
    return blocks, starts, named.column("origin").combine_chunks().take(pa.array(order))


def counts(depths: range) -> tuple[Finish, Callable[[int], str]]:
    """(node, _n{depth}): how many origins of a part reach a node first at each depth."""
    names = [f"_n{d}" for d in depths]

    def finish(nodes: pa.Array, owner: np.ndarray, block: np.ndarray, within: list[np.ndarray]) -> pa.RecordBatch:
        so_far = [np.bitwise_count(bits).sum(axis=1, dtype=np.int64) for bits in within]
        so_far += [so_far[-1]] * (len(depths) - len(so_far))
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        each = np.add.reduceat(np.diff(so_far, axis=0, prepend=0), first, axis=1)
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(owner[first])), *map(pa.array, each)], names=["node", *names])

    return finish, lambda _: ", ".join(f"{n} bigint" for n in names)
