"""Range joins as equi-joins on grid cells, for intervals in time and boxes in space alike.

Boxes are copied to the cells they touch, a point lies in one cell, and the two are joined on
the cell. One width cannot suit everything: where many small boxes lie in one wide cell, every
point there would meet every box. Such crowded cells are split, and only they.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selvatrace.session import cut_lineage, stored

SPLIT = 8  # a cell is split this many times along each axis; a power of two splits exactly
BROADCAST_CELLS = 200_000  # a few numbers each, so a few megabytes
FINEST = 8  # splits after which a degree is six nanodegrees, finer than coordinates are

Narrow = Callable[[DataFrame, int, float | Column], DataFrame]


def cell(coord: Column, width: float) -> Column:
    """Index of the cell of ``width`` that holds ``coord``."""
    return F.floor(coord / F.lit(float(width)))


def leaf_width(width: float) -> Column:
    """Width of a leaf cell, from its level."""
    return F.lit(float(width)) / F.pow(F.lit(float(SPLIT)), F.col("_lvl"))


def touch(boxes: DataFrame, axes: list[tuple[str, str]], width: float, narrow: Narrow | None = None) -> DataFrame:
    """One row per box and cell it touches, with the cell in ``_c0``, ``_c1``, ...

    An axis is a pair of columns: the box's low and high end. A box without ends touches no
    cell and keeps one row with null cells, which joins nothing. (The outer explode is on
    purpose: for a plain one Spark first filters on the size of the sequences, and works out
    the ends of every box twice.) ``narrow`` is called after each axis, with the number of the axis
    and the width, to cut what a row carries down to its cell before the next copy is made.
    """
    spans = {f"_s{i}": F.sequence(cell(F.col(low), width), cell(F.col(high), width)) for i, (low, high) in enumerate(axes)}
    out = boxes.withColumns(spans)
    for i in range(len(axes)):
        out = out.withColumn(f"_c{i}", F.explode_outer(f"_s{i}"))
        out = narrow(out, i, width) if narrow else out
    return out.drop(*spans)


def _parts(axes: list[tuple[str, str]], part: float) -> list[tuple[Column, Column]]:
    """Per axis, the first and last part of width ``part`` that a box touches within its cell."""
    return [
        (
            F.greatest(cell(F.col(low), part), F.col(f"_c{i}") * SPLIT),
            F.least(cell(F.col(high), part), F.col(f"_c{i}") * SPLIT + SPLIT - 1),
        )
        for i, (low, high) in enumerate(axes)
    ]


def crowded_cells(
    boxes: DataFrame, keys: list[str], axes: list[tuple[str, str]], width: float, crowd: int, levels: int
) -> list[DataFrame]:
    """The cells to split, level by level.

    These are found here, a job per level, to know whether there are any and whether they are few enough to
    broadcast. Only the ends of boxes are counted, and from the second level on only those in crowded cells.
    """
    names = [f"_c{i}" for i in range(len(axes))]
    ends = [end for axis in axes for end in axis]
    rows = touch(boxes.select(*keys, *ends), axes, width)
    found = []
    for level in range(levels):
        spans = _parts(axes, width / SPLIT ** (level + 1))
        touched = reduce(mul, [to - start + 1 for start, to in spans])
        alike = reduce(and_, [F.min(end) == F.max(end) for end in ends])
        crowded = cut_lineage(
            rows.groupBy(*keys, *names)
            .agg(F.count(F.lit(1)).alias("_n"), F.sum(touched).alias("_touched"), alike.alias("_alike"))
            .filter((F.col("_n") > crowd) & (F.col("_touched") * 4 <= F.col("_n") * SPLIT ** len(axes)) & ~F.col("_alike"))
            .select(*keys, *names)
        )
        n_crowded = crowded.count()
        if n_crowded == 0:
            break
        found.append(F.broadcast(crowded) if n_crowded <= BROADCAST_CELLS else crowded)
        rows = rows.join(found[-1], [*keys, *names], "left_semi").withColumns(
            {f"_s{i}": F.sequence(*span) for i, span in enumerate(spans)}
        )
        for i, c in enumerate(names):
            rows = rows.withColumn(c, F.explode(f"_s{i}"))
        rows = cut_lineage(rows.select(*keys, *ends, *names))
    return found


def cover(
    boxes: DataFrame,
    keys: list[str],
    axes: list[tuple[str, str]],
    width: float,
    crowd: int,
    levels: int,
    narrow: Narrow | None = None,
) -> tuple[DataFrame, list[DataFrame]]:
    """Covers boxes with cells per key and splits the crowded ones.

    A cell that more than ``crowd`` boxes touch is split eightfold along each axis, again and again
    while it is crowded; after ``levels`` times a part is finer than coordinates are. It stays whole where the
    boxes would fill most of its parts, or are all the same: splitting would only make copies. Returns one row per
    box and leaf cell (``_lvl``, ``_c0``, ...) and the crowded cells of each level. The boxes themselves are read
    once for the cover, which follows the crowded cells down without shuffling where these can be broadcast.
    """
    names = [f"_c{i}" for i in range(len(axes))]
    found = crowded_cells(boxes, keys, axes, width, crowd, levels)
    rows = touch(boxes, axes, width, narrow).withColumn("_lvl", F.lit(0))
    for level, crowded in enumerate(found):
        marks = crowded.withColumnsRenamed({c: f"_m{c}" for c in [*keys, *names]})
        here = [F.col("_lvl") == level, *[F.col(c) == F.col(f"_m{c}") for c in [*keys, *names]]]
        split = F.col("_m_c0").isNotNull()
        spans = _parts(axes, width / SPLIT ** (level + 1))
        rows = rows.join(marks, reduce(and_, here), "left").withColumns(
            {f"_s{i}": F.when(split, F.sequence(*span)).otherwise(F.array(f"_c{i}")) for i, span in enumerate(spans)}
            | {"_lvl": F.when(split, level + 1).otherwise(F.col("_lvl"))}
        )
        for i, c in enumerate(names):
            rows = rows.withColumn(c, F.explode_outer(f"_s{i}"))
            rows = narrow(rows, i, leaf_width(width)) if narrow else rows
        rows = rows.drop(*marks.columns, *[f"_s{i}" for i in range(len(names))])
    return rows, found


def leaf_of(
    points: DataFrame, keys: list[str], coords: list[Column], width: float, crowded_by_level: list[DataFrame]
) -> DataFrame:
    """Adds the leaf cell of each point: ``_plvl``, ``_p0``, ``_p1``, ...

    Points are shuffled for this only where the crowded cells are too many to broadcast.
    """
    names = [f"_p{i}" for i in range(len(coords))]
    keyed = points.withColumns({"_plvl": F.lit(0)} | {p: cell(x, width) for p, x in zip(names, coords, strict=True)})
    for level, crowded in enumerate(crowded_by_level):
        part = width / SPLIT ** (level + 1)
        marks = crowded.select(
            *[F.col(k).alias(f"_m_{k}") for k in keys], *[F.col(f"_c{i}").alias(f"_m{i}") for i in range(len(names))]
        )
        here = [F.col("_plvl") == level]
        here += [F.col(k) == F.col(f"_m_{k}") for k in keys]
        here += [F.col(p) == F.col(f"_m{i}") for i, p in enumerate(names)]
        split = F.col("_m0").isNotNull()
        finer = {p: F.when(split, cell(x, part)).otherwise(F.col(p)) for p, x in zip(names, coords, strict=True)}
        keyed = (
            keyed.join(marks, reduce(and_, here), "left")
            .withColumns({"_plvl": F.when(split, level + 1).otherwise(F.col("_plvl"))} | finer)
            .drop(*marks.columns)
        )
    return keyed


def same_leaf(axes: int) -> Column:
    """Join condition: the point's leaf cell is the box's."""
    return reduce(and_, [F.col("_plvl") == F.col("_lvl")] + [F.col(f"_p{i}") == F.col(f"_c{i}") for i in range(axes)])


def helper_columns(axes: int) -> list[str]:
    """Columns to drop after the join."""
    return ["_plvl", "_lvl", *[f"_{x}{i}" for x in "pc" for i in range(axes)]]


BLOCK = 1024  # rows that one row of a block stands for, at most about
TASK_PAIRS = 4_000_000  # pairs that one task makes, about
MOST_TASKS = 20_000


def in_blocks(rows: DataFrame, alike: list[str], value: str, *first: str) -> DataFrame:
    """Rows that agree in ``alike`` as blocks: (alike, ``first``, _many), with the values in the array ``_many``.

    What is joined by place or shape alone then meets each place or shape once, however many rows share it. A block holds
    about ``BLOCK`` rows at most, so no group stands in one row. The columns ``first`` follow from ``alike``.
    """
    large = rows.groupBy(*alike).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > BLOCK)
    large = stored(large.select(*alike, F.ceil(F.col("_n") / BLOCK).alias("_blocks")), "large-groups")
    if large.isEmpty():
        dealt = rows.withColumn("_block", F.lit(0).cast("bigint"))
    else:
        number = F.coalesce(F.pmod(F.xxhash64(value), F.col("_blocks")), F.lit(0)).alias("_block")
        same = reduce(and_, [F.col(f"_r.{c}").eqNullSafe(F.col(f"_l.{c}")) for c in alike])
        dealt = rows.alias("_r").join(large.alias("_l"), same, "left").select("_r.*", number)
    nulls = (F.count(F.lit(1)) - F.count(value)).cast("int")
    null = F.lit(None).cast(rows.schema[value].dataType)
    many = F.concat(F.collect_list(value), F.array_repeat(null, nulls)).alias("_many")
    return dealt.groupBy(*alike, "_block").agg(*[F.first(c).alias(c) for c in first], many).drop("_block")


def dealt_join(a: DataFrame, b: DataFrame, keys: list[str], size_a: Column, size_b: Column) -> DataFrame:
    """Inner join of ``a`` and ``b`` on ``keys`` in tasks that each make about ``TASK_PAIRS`` pairs.

    Blocks are few bytes that become many rows, so tasks cannot be cut by bytes. The pairs of each key are counted
    first (a row counts for its size); a key with more than a task's share has its rows of ``a`` dealt to several tasks,
    and its rows of ``b`` copied to them.
    """
    of_a, of_b = (df.groupBy(*keys).agg(F.sum(size.cast("double")).alias(n)) for df, size, n in ((a, size_a, "_wa"), (b, size_b, "_wb")))
    pairs = F.col("_wa") * F.col("_wb")
    work = stored(of_a.join(of_b, keys).select(*keys, pairs.alias("_pairs")), "pairs-per-cell")
    total, largest = work.agg(F.sum("_pairs"), F.max("_pairs")).first()
    tasks = max(1, min(MOST_TASKS, int((total or 0) // TASK_PAIRS) + 1))
    most = max(TASK_PAIRS, (total or 0) / MOST_TASKS)
    if (largest or 0) > 2 * most:
        shares = work.select(*keys, F.ceil(F.col("_pairs") / most).cast("int").alias("_shares"))
        others = [F.col(c) for c in a.columns if c not in keys]
        a = a.join(shares, keys).withColumn("_share", F.pmod(F.xxhash64(*others), F.col("_shares")).cast("int"))
        b = b.join(shares, keys).withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
        a, b, keys = a.drop("_shares"), b.drop("_shares"), [*keys, "_share"]
    joined = a.repartition(tasks, *keys).join(b.repartition(tasks, *keys), keys)
    return joined.drop("_share")
