"""Operators over lot movements (edges of the supply chain)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from selvatrace.session import cut_lineage, stored

if TYPE_CHECKING:
    from selvatrace.functions.bits import Finish


def edge_totals(movements: DataFrame) -> DataFrame:
    """Quantity, distinct lots, first and last date per (src, dst)."""
    return movements.groupBy("src", "dst").agg(
        F.sum("qty").alias("qty"),
        F.count_distinct("lot_id").alias("n_lots"),
        F.min("moved_on").alias("first_on"),
        F.max("moved_on").alias("last_on"),
    )


def linked_lots(lots: DataFrame, movements: DataFrame) -> DataFrame:
    """Lots with a traced movement. Movements are reduced to distinct lots first."""
    return lots.join(movements.select("lot_id").distinct(), "lot_id", "left_semi")


def unlinked_lots(lots: DataFrame, movements: DataFrame) -> DataFrame:
    """Lots without any traced movement."""
    return lots.join(movements.select("lot_id").distinct(), "lot_id", "left_anti")


def reach(edges: DataFrame, max_depth: int, origins: DataFrame | None = None) -> DataFrame:
    """Every ``(origin, node)`` pair within ``max_depth`` steps and the least depth.

    ``origins`` (one column, ``origin``) names the nodes to start from. Without it all nodes do, and the
    result grows with their square.

    Each step joins only the pairs that were new in the step before, keeps those not seen yet,
    and writes them to the shared folder, so cycles end and the plan does not grow. A node
    that reaches itself lies on a cycle and is reported.
    """
    steps = cut_lineage(edges.select("src", "dst").distinct())
    fresh = steps.select(F.col("src").alias("origin"), F.col("dst").alias("node"), F.lit(1).alias("depth"))
    if origins is not None:
        fresh = fresh.join(origins.select("origin").distinct(), "origin", "left_semi")
    rounds = [fresh]
    for depth in range(2, max_depth + 1):
        if fresh.isEmpty():
            break
        seen = reduce(DataFrame.unionByName, rounds).select("origin", "node")
        further = (
            fresh.join(steps, F.col("node") == F.col("src"))
            .select("origin", F.col("dst").alias("node"))
            .distinct()
            .join(seen, ["origin", "node"], "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        fresh = cut_lineage(further)
        rounds.append(fresh)
    return reduce(DataFrame.unionByName, rounds)


SENT_ROWS = 800_000  # rows of bits that go to every task at once, about 200 MB
SENT_ORIGINS = 2_000_000  # origins whose names do: 16 MB


def reach_from(edges: DataFrame, max_depth: int, origins: DataFrame) -> DataFrame:
    """``reach`` from many named origins (one column, ``origin``), by bitmaps.

    Origins are numbered, and each step carries one row of bits per node and block of 2,048 origins instead of one per
    node and origin. Pairs are made only at the end, where a row of bits and the names of its block meet: no pair is shuffled.
    Null origins reach nothing.
    """
    from selvatrace.functions import bits

    named, found, n_steps = _origin_bits(edges, max_depth, origins, bits.as_bits, bits.bits_kind)
    sent = None
    if named.count() <= SENT_ORIGINS:
        sent = edges.sparkSession.sparkContext.broadcast(bits.as_names(named.toArrow()))
    else:
        in_order = F.array_sort(F.collect_list(F.struct("_no", "origin")))
        blocks = named.groupBy(F.floor(F.col("_no") / F.lit(64 * bits.WIDE)).alias("_block")).agg(F.transform(in_order, lambda o: o.origin).alias("_named"))
        found = found.join(blocks, "_block").select(*found.columns, "_named")
    kind = f"node {found.schema['node'].dataType.simpleString()}, depth int, _origins array<{named.schema['origin'].dataType.simpleString()}>"
    return found.mapInArrow(bits.pairs(n_steps, sent), kind).select(F.explode("_origins").alias("origin"), "node", "depth")


def reach_counts(edges: DataFrame, max_depth: int, origins: DataFrame) -> DataFrame:
    """How many of ``origins`` reach each node first in ``depth`` steps. No pair is ever written out."""
    from selvatrace.functions import bits

    depths = range(1, max_depth + 1)
    _, found, _ = _origin_bits(edges, max_depth, origins, *bits.counts(depths))
    found = found.groupBy("node").agg(*[F.sum(f"_n{d}").alias(f"_n{d}") for d in depths])
    each = F.array(*[F.struct(F.lit(d).alias("depth"), F.col(f"_n{d}").alias("n_origins")) for d in depths])
    return found.select("node", F.inline(F.filter(each, lambda e: e.n_origins > 0)))


def _origin_bits(
    edges: DataFrame, max_depth: int, origins: DataFrame, finish: Finish, kind: Callable[[int], str]
) -> tuple[DataFrame, DataFrame, int]:
    """(_no, origin); (node, ``kind``): what ``finish`` makes of the origins that reach a node within 1, 2, ... steps; and after how many
    steps no more do.

    The sources of a node's edges are one row, so a node's bits are complete in the task that holds it and nothing is
    shuffled for them. Only nodes that have edges of their own keep bits from step to step: of the origins that reach them
    within so many steps, themselves included. All others get theirs in one pass at the end, from their sources. Origins are
    numbered in order, so that the origins of a block reach much the same nodes if near ids go together. The bits that
    nodes hand on go to the tasks in bounded parts, block by block; each part reads the edges once.
    """
    from selvatrace.functions import bits

    pairs = edges.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL").repartition("dst")
    into = stored(pairs.groupBy(F.col("dst").alias("node")).agg(F.collect_set("src").alias("_from")), "reach-edges")
    sources = stored(into.select(F.explode("_from").alias("src")).distinct(), "reach-sources")
    ordered = sources.join(origins.select("origin").distinct(), F.col("src") == F.col("origin")).sort("origin")
    named = stored(ordered.withColumn("_no", F.monotonically_increasing_id()), "reach-origins")  # dense within each task
    first = named.select("src", F.floor(F.col("_no") / F.lit(64 * bits.WIDE)).alias("_block"), (F.col("_no") % (64 * bits.WIDE)).alias("at"))
    kinds = f"src {first.schema['src'].dataType.simpleString()}, _block bigint, _bits binary"
    known = [stored(first.mapInArrow(bits.alone, kinds), "reach-bits")]
    if max_depth > 1:
        own = F.array(F.col("src"))
        inner = sources.join(into, F.col("src") == F.col("node"), "left").select("src", F.coalesce(F.concat("_from", own), own).alias("_from"))
        inner = stored(inner, "reach-inner")
    size = [F.sum(F.bitmap_count("_bits"))]
    for _ in range(1, max_depth):
        parts = _along(inner, known[-1].withColumn("_step", F.lit(0)), 1, bits.as_bits, kinds)
        if not parts:
            break
        known.append(stored(reduce(DataFrame.unionByName, parts), "reach-bits"))
        if known[-1].agg(*size).first() == known[-2].agg(*size).first():
            known.pop()
            break
    steps = reduce(DataFrame.unionByName, [k.withColumn("_step", F.lit(i)) for i, k in enumerate(known)])
    kind = f"node {into.schema['node'].dataType.simpleString()}, {kind(len(known))}"
    done = _along(into, steps, len(known), finish, kind)
    if not done:
        done = [edges.sparkSession.createDataFrame([], kind)]
    return named.select("_no", "origin"), reduce(DataFrame.unionByName, done), len(known)


def _along(rows: DataFrame, held: DataFrame, n_steps: int, finish: Finish, kind: str) -> list[DataFrame]:
    """What ``finish`` makes of ``rows`` (a node, and those that lead to it) and of the bits that are ``held`` (src, _block, _bits, _step), in
    parts of whole blocks. A block too large for one part goes in several, whose bits are put together by a shuffle."""
    from selvatrace.functions import bits

    spark = rows.sparkSession
    node = rows.columns[0]

    def met(part: DataFrame, finish: Finish, kind: str) -> DataFrame:
        sent = spark.sparkContext.broadcast(bits.packed(part.toArrow(), n_steps))
        found = stored(rows.mapInArrow(bits.met(sent, finish), kind), "reach-found")
        sent.destroy()
        return found

    done = []
    for lo, hi, n in _parts_of_blocks(held):
        part = held.filter(F.col("_block").between(lo, hi))
        if n <= SENT_ROWS:
            done.append(met(part, finish, kind))
            continue
        pieces = -(-n // SENT_ROWS)
        steps = [f"_r{i}" for i in range(n_steps)]
        some = f"{node} {rows.schema[node].dataType.simpleString()}, {bits.bits_kind(n_steps)}"
        each = [met(part.filter(F.pmod(F.xxhash64("src"), F.lit(pieces)) == i), bits.as_bits, some) for i in range(pieces)]
        whole = [F.substring(F.bitmap_or_agg(r), 1, 8 * bits.WIDE).alias(r) for r in steps]
        whole = reduce(DataFrame.unionByName, each).groupBy(node, "_block").agg(*whole)
        done.append(stored(whole.mapInArrow(bits.finished(finish), kind), "reach-found"))
    return done


def _parts_of_blocks(bits: DataFrame) -> list[tuple[int, int, int]]:
    """First block, last block and rows of parts of ``bits`` that are each small enough to go to every executor, if their blocks are."""
    sizes = bits.groupBy("_block").count().orderBy("_block").collect()
    parts: list[tuple[int, int, int]] = []
    for block, n in sizes:
        if parts and parts[-1][2] + n <= SENT_ROWS:
            parts[-1] = (parts[-1][0], block, parts[-1][2] + n)
        else:
            parts.append((block, block, n))
    return parts


def exposure(edges: DataFrame, own: DataFrame, steps: int) -> DataFrame:
    """Share of what each node hands on that came from flagged origins, over ``steps`` steps.

    ``own`` gives a node's own flagged share (0 to 1). One step is
    ``exposure = own + (1 - own) * sum(share of intake from src * exposure of src)``.
    Shares are decimals: the sums then do not depend on the order they are taken in.
    """
    number = "decimal(38,18)"
    totals = edges.groupBy("src", "dst").agg(F.sum("qty").alias("_qty")).filter(F.col("_qty") > 0)
    intake = totals.groupBy("dst").agg(F.sum("_qty").alias("_all"))
    shares = cut_lineage(
        totals.join(intake, "dst").select(
            "src",
            "dst",
            (F.col("_qty").cast("decimal(20,4)") / F.col("_all").cast("decimal(20,4)"))
            .cast("decimal(19,18)")
            .alias("_share"),
        )
    )
    ends = shares.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    base = cut_lineage(
        ends.unionByName(own.select("node"))
        .distinct()
        .join(own.groupBy("node").agg(F.max("own").alias("own")), "node", "left")
        .select("node", F.coalesce(F.col("own"), F.lit(0)).cast("decimal(19,18)").alias("own"))
    )
    now = base.select("node", "own", F.col("own").cast("decimal(19,18)").alias("exposure"))
    for _ in range(steps):
        came_in = (
            shares.join(now.select(F.col("node").alias("src"), F.col("exposure").alias("_exp")), "src")
            .groupBy(F.col("dst").alias("node"))
            .agg(F.sum((F.col("_share") * F.col("_exp")).cast(number)).cast("decimal(19,18)").alias("_in"))
        )
        mixed = F.col("own") + (F.lit(1) - F.col("own")) * F.coalesce(F.col("_in"), F.lit(0).cast("decimal(19,18)"))
        now = cut_lineage(
            base.join(came_in, "node", "left").select("node", "own", mixed.cast("decimal(19,18)").alias("exposure"))
        )
    return now.select("node", "exposure")


def mass_balance(movements: DataFrame) -> DataFrame:
    """Quantity in, out and their difference per node, in one pass over the movements."""
    zero = F.lit(0).cast(movements.schema["qty"].dataType)
    ends = F.array(
        F.struct(F.col("dst").alias("node"), F.col("qty").alias("came"), zero.alias("went")),
        F.struct(F.col("src").alias("node"), zero.alias("came"), F.col("qty").alias("went")),
    )
    return (
        movements.select(F.inline(ends))
        .groupBy("node")
        .agg(F.sum("came").alias("qty_in"), F.sum("went").alias("qty_out"))
        .withColumn("difference", F.col("qty_in") - F.col("qty_out"))
    )


def origin_completeness(movements: DataFrame, known_sites: DataFrame) -> DataFrame:
    """Share of each buyer's quantity that came from a known site.

    Movements are summed per (src, dst) before they meet the sites.
    """
    edges = movements.groupBy("src", "dst").agg(F.sum("qty").alias("qty"))
    known = known_sites.select(F.col("site_id").alias("_site")).distinct()
    zero = F.lit(0).cast(edges.schema["qty"].dataType)
    return (
        edges.join(known, F.col("src") == F.col("_site"), "left")
        .groupBy("dst")
        .agg(
            F.sum("qty").alias("qty"),
            F.sum(F.when(F.col("_site").isNotNull(), F.col("qty")).otherwise(zero)).alias("qty_known"),
        )
        .withColumn("share_known", F.col("qty_known").cast("double") / F.nullif(F.col("qty").cast("double"), F.lit(0.0)))
    )


def hop_delay(movements: DataFrame) -> DataFrame:
    """Per movement: its place among the lot's movements of the day, and the days since the lot's previous movement.

    The first movement of a day carries the delay since the lot's previous day, the others 0. Movements
    are counted per lot and day before days are ordered, and expanded after, so no window sees a lot's rows.
    """
    days = hop_days(movements)
    nth = F.explode(F.sequence(F.lit(1), F.col("n_moves").cast("int"))).alias("nth")
    return days.select("lot_id", "moved_on", nth, "delay_days").withColumn(
        "delay_days", F.when(F.col("nth") == 1, F.col("delay_days")).otherwise(0)
    )


def hop_days(movements: DataFrame) -> DataFrame:
    """Per lot and day with movements: how many, and the days since its previous such day."""
    days = movements.groupBy("lot_id", "moved_on").agg(F.count(F.lit(1)).alias("n_moves"))
    before = F.lag("moved_on").over(W.partitionBy("lot_id").orderBy("moved_on"))
    return days.withColumn("delay_days", F.datediff("moved_on", before))
