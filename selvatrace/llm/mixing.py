"""Mixing sources to target weights by weighted sampling without replacement.

Method (Efraimidis and Spirakis). Every source gets a target of words. A source whose target is more than its size is first
taken whole, as often as it fits: its complete epochs. What is left of the target is a sample without replacement: each
document draws an exponential number divided by its quality weight, the source is sorted by these, and documents are
taken in that order until the running total of their words reaches the rest. The one that crosses it gives its first
words only, so a source gives its target to the word.

Targets. Sources in code point order, null last, weigh 1, 2, 3, 1, ... and share the words of all documents. A target stops at
``MOST`` times its source's size, and what is over is shared again by weight until none is above. All of this is
whole-number arithmetic on one row per source, in Spark; the driver sees sums only.

Draws come from a hash of id and text, so reruns agree. Running totals are cut along the drawn order where a source has
very many documents (``plans.ordered``), so no source has to fit one task.

Defined results: a null or wordless text has size 0 and gives nothing; a null source is a source of its own; repeated rows
draw alike and are taken one after the other; empty tables give no rows; texts of any length count whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from selvatrace.llm.common import pick, written
from selvatrace.plans.ordered import ROWS_PER_CHUNK, join_on, running_total

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 29
WORD = r"[^\x20\x09-\x0D]+"
#: Characters that prose holds few of.
_ODD = "0123456789#*$%&|<>{}[]=_~^\\/@+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def quality_weight(text: Column) -> Column:
    """Between 0.05 and 1: less for texts with many digits and signs, least for empty ones. Any positive column can stand in for it."""
    odd = F.length(text) - F.length(F.translate(text, _ODD, ""))
    return F.greatest(F.lit(0.05), F.lit(1.0) - 4 * F.try_divide(odd, F.length(text)))


def drawn(docs: DataFrame, key: str, text: str, source: str, weight: Column | None = None) -> DataFrame:
    """(id, source, size, arrival, tie): the size of each document and the number it is sorted by."""
    rows = pick(docs, key, text, source).toDF("id", "text", "source")
    tie = F.xxhash64(F.lit(SEED), F.col("id").cast("string"), "text")
    even = (F.pmod(tie, F.lit(1 << 52)) + 0.5) / float(1 << 52)
    weight = quality_weight(F.col("text")) if weight is None else weight
    arrival = -F.log(even) / F.coalesce(weight, F.lit(1.0))
    return rows.select("id", "source", words(F.col("text")).alias("size"), arrival.alias("arrival"), tie.alias("tie"))


def _numbered(sources: DataFrame) -> DataFrame:
    """Adds ``no``, from 0 in code point order with null last: numbers within ranges, moved by the ranges before."""
    laid = sources.repartitionByRange(F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id())
    laid = written(laid, "mixing-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("part").agg(F.count("*").alias("held"))
    moved = parts.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last("source")))
    return laid.withColumn("inside", inside).join(moved, "part").select("source", "held", (F.col("before") + F.col("inside") - 1).alias("no"))


def targets(drawn_rows: DataFrame) -> DataFrame:
    """(source, source_size, target, budget): the target of each source, and the whole words of it."""
    sources = drawn_rows.groupBy("source").agg(F.sum("size").alias("held"))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("no") % len(WEIGHTS) + 1).cast("int"))
    sources = written(_numbered(sources).withColumn("weight", weight), "mixing-weights")
    total, share = sources.agg(F.sum("held"), F.sum("weight")).first()
    total, share = int(total or 0), int(share or 1)
    whole = lambda x: F.lit(x).cast("decimal(20,0)") if isinstance(x, int) else x.cast("decimal(18,0)")
    most = F.col("held") * MOST
    left = total
    while True:
        # Above its bound: weight * left / share > most.
        above = whole(F.col("weight")) * whole(left) > whole(most) * whole(share)
        bound, rest = sources.agg(F.sum(F.when(above, most)), F.sum(F.when(~above, F.col("weight")))).first()
        after = total - int(bound or 0), int(rest or 1)
        if after == (left, share):
            break
        left, share = after
    part = whole(F.col("weight")) * whole(left)
    return sources.select(
        "source", F.col("held").alias("source_size"),
        F.when(above, most.cast("double")).otherwise(part.cast("double") / float(share)).alias("target"),
        F.when(above, most).otherwise(F.call_function("div", part, whole(share))).alias("budget"),
    )


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weight: Column | None = None,
    rows_per_chunk: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """(key, source, size, source_size, target, epochs, taken): one row per row of ``docs``; ``epochs``: how often the
    document is taken whole, ``taken``: the words that the mix takes of it, repeats counted. ``weight``: a column over
    ``id``, ``text`` and ``source``."""
    rows = written(drawn(docs, key, text, source, weight), "mixing-drawn")
    plan = targets(rows)
    order = ["arrival", "tie", "id", "size"]
    placed = running_total(rows, ["source"], order, F.col("size"), "upto", rows_per_chunk)
    full = F.coalesce(F.expr("budget div nullif(source_size, 0)"), F.lit(0))
    rest = F.col("budget") - full * F.col("source_size")
    more = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("upto") - F.col("size"))))
    taken = (full * F.col("size") + more).cast("bigint")
    return join_on(placed, plan, ["source"]).select(
        F.col("id").alias(key), "source", "size", "source_size", "target",
        F.coalesce(F.try_divide(taken, "size").cast("bigint"), F.lit(0)).alias("epochs"), taken.alias("taken"),
    )


def copies(docs: DataFrame, mixed: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, copy, text): the texts of the mix, one row per copy; the last may hold a document's first words only.
    Ids must be distinct."""
    whole = mixed.select(key, "size", "taken").filter("taken > 0")
    runs = whole.withColumn("copy", F.explode(F.sequence(F.lit(0), F.expr("(taken - 1) div size").cast("int"))))
    here = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size"))
    held = pick(docs, key, text).join(runs.withColumn("here", here), key)
    first = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.col("here").cast("int")), " ")
    return held.select(key, "copy", F.when(F.col("here") == F.col("size"), F.col(text)).otherwise(first).alias(text))
