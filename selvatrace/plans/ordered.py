"""Ordered scans that never put one busy key into one task.

A window over a key sorts all rows of that key in one task, which fails when the key holds
a third of the table. So busy keys are looked for first, with a sketch of bounded size. Without
one the plain window is best. Otherwise the rows of busy keys are laid out by ranges of key and
order, and every other key stays whole. How many ranges there are follows from the bytes of those
rows and from the cluster, never from the number of keys; a border cuts one key at most, so few keys
have anything to hand on. What a chunk (a key's rows in one range) has to hand on is reduced on the
map side to one row, or to the few that the scan looks back on; these are scanned per key; and each
chunk gets what the chunks before it hand on as more rows, the lead-in. One window over (key, chunk)
then sees all it needs and the lead-in rows are dropped. The full rows are shuffled once and never
joined, and null keys form a key like any other. The result is the same for every way of cutting.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from selvatrace.session import cut_lineage

ROWS_PER_CHUNK = 1_000_000  # a key with more rows is cut; one task sorts this many with ease
RANGE_BYTES = 128 << 20  # what a range holds at most, if rows are as wide as their types suggest
RANGES_PER_PARTITION = 4  # and ranges made for the sake of rows, per shuffle partition
TRACKED = 1 << 16  # numbers of the sketch of busy keys; one that holds a 16,000th of all rows is never missed
MOST_BUSY = 1 << 14
FEW_ROWS = 100  # rows per key and map task that one task can well take in
SALTS = 64


def time_chunk(ts: Column, seconds: int) -> Column:
    """Number of the time span of ``seconds`` that holds ``ts``."""
    return F.floor(F.unix_micros(ts) / F.lit(int(seconds) * 1_000_000))


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; the left key columns stay."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    joined = left.join(renamed, same, how)
    return joined.drop(*[f"_r_{k}" for k in keys])


def _width(kind: T.DataType) -> int:
    """Bytes of a value, about."""
    if isinstance(kind, T.StructType):
        return sum(_width(f.dataType) for f in kind.fields)
    fixed = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}
    return fixed.get(type(kind), 8 if isinstance(kind, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)) else 32)


def range_count(df: DataFrame, n_rows: int, rows_per_chunk: int) -> int:
    """Ranges for ``n_rows`` rows like those of ``df``: enough that each is of bounded size, and beyond that as many as
    ``rows_per_chunk`` asks for, up to a few per shuffle partition."""
    by_bytes = -(-n_rows * _width(df.schema) // RANGE_BYTES)
    # Half as many again: borders from a sample are not exact.
    by_rows = -(-3 * n_rows // (2 * rows_per_chunk))
    at_once = RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(by_bytes, min(by_rows, at_once), 2)


def busy_keys(df: DataFrame, keys: list[str], rows_per_chunk: int) -> tuple[DataFrame, int]:
    """Hashes ``_busy`` of the keys with more than ``rows_per_chunk`` rows, and how many rows these have, about.

    A sketch of frequent items is merged from all tasks; it holds ``TRACKED`` numbers whatever the number of keys, and
    names ``MOST_BUSY`` keys at most, the largest. A key too small for it, with less than a 16,000th of all rows, stays whole.
    """
    top = F.expr(f"approx_top_k(_hash, {MOST_BUSY}, {TRACKED})")
    found = df.select(F.xxhash64(*keys).alias("_hash")).agg(top.alias("_top")).select(F.inline("_top"))
    busy = cut_lineage(found.filter(F.col("count") > rows_per_chunk).withColumnRenamed("item", "_busy"))
    return busy.select("_busy"), busy.agg(F.sum("count")).first()[0] or 0


def split_busy_keys(
    df: DataFrame, keys: list[str], order: list[str], rows_per_chunk: int | None = ROWS_PER_CHUNK
) -> tuple[DataFrame, list[str]]:
    """Cuts keys with more than ``rows_per_chunk`` rows into chunks along ``order``.

    Returns the rows and the columns to partition by: the keys, and ``_chunk`` where any key is
    busy; rows of ordinary keys have none. Busy rows are laid out by ranges of key and order, whose bounds Spark
    takes from a sample of those rows, so neither a stray time nor a busy day widens a chunk; the
    layout is written out, as its partition numbers are the chunks. Only rows equal in all of ``order`` stay together.
    Runs a job that sketches keys, and one over busy rows. None spares both where no key can be busy.
    """
    if rows_per_chunk is None:
        return df, keys
    busy, n_rows = busy_keys(df, keys, rows_per_chunk)
    if not n_rows:
        return df, keys
    # At most MOST_BUSY numbers.
    marked = df.join(F.broadcast(busy), F.xxhash64(*keys) == F.col("_busy"), "left")
    ranges = range_count(df, n_rows, rows_per_chunk)
    laid = marked.filter(F.col("_busy").isNotNull()).drop("_busy").repartitionByRange(ranges, *keys, *order)
    hot = cut_lineage(laid.withColumn("_chunk", F.spark_partition_id()))
    calm = marked.filter(F.col("_busy").isNull()).drop("_busy").withColumn("_chunk", F.lit(None).cast("int"))
    return calm.unionByName(hot), [*keys, "_chunk"]


def _earlier(keys: list[str]) -> W:
    return W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)


def _with_extra(df: DataFrame, extra: DataFrame) -> DataFrame:
    """``df`` and the rows handed on, told apart by ``_own``."""
    own = df.withColumn("_own", F.lit(True))
    return own.unionByName(extra.withColumn("_own", F.lit(False)), allowMissingColumns=True)


def running_total(
    df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, rows_per_chunk: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the key's rows up to and including this one.

    ``order`` must be total within a key; busy keys are cut along it.
    """
    rows, by = split_busy_keys(df.withColumn("_value", value), keys, order, rows_per_chunk)
    frame = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    if by == keys:
        return rows.withColumn(name, F.sum("_value").over(frame)).drop("_value")
    handed_on = (
        rows.filter(F.col("_chunk").isNotNull())
        .groupBy(*by)
        .agg(F.sum("_value").alias("_value"))
        .withColumn("_value", F.sum("_value").over(_earlier(keys)))
        .filter(F.col("_value").isNotNull())
    )
    frame = W.partitionBy(*by).orderBy("_own", *order).rowsBetween(W.unboundedPreceding, 0)
    totals = _with_extra(rows, handed_on).withColumn(name, F.sum("_value").over(frame))
    return totals.filter("_own").drop("_own", "_value", "_chunk")


def last_seen(
    df: DataFrame, keys: list[str], order: list[str], value: str, name: str, rows_per_chunk: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """Adds ``name``: the latest non-null ``value`` of the key at or before this row."""
    rows, by = split_busy_keys(df, keys, order, rows_per_chunk)
    newest = F.last(value, ignorenulls=True)
    frame = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    if by == keys:
        return rows.withColumn(name, newest.over(frame))
    handed_on = (
        rows.filter(F.col("_chunk").isNotNull())
        .groupBy(*by)
        .agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias(value))
        .withColumn(value, newest.over(_earlier(keys)))
        .filter(F.col(value).isNotNull())
    )
    frame = W.partitionBy(*by).orderBy("_own", *order).rowsBetween(W.unboundedPreceding, 0)
    return _with_extra(rows, handed_on).withColumn(name, newest.over(frame)).filter("_own").drop("_own", "_chunk")


def next_row(
    df: DataFrame, keys: list[str], order: list[str], cols: list[str], name: str, rows_per_chunk: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """Adds ``name``: a struct of ``cols`` from the key's next row, null on its last row."""
    rows, by = split_busy_keys(df.withColumn("_cols", F.struct(*cols)), keys, order, rows_per_chunk)
    if by == keys:
        return rows.withColumn(name, F.lead("_cols").over(W.partitionBy(*by).orderBy(*order))).drop("_cols")
    handed_on = (
        rows.filter(F.col("_chunk").isNotNull())
        .groupBy(*by)
        .agg(F.min_by("_cols", F.struct(*order)).alias("_cols"))
        .withColumn("_cols", F.lead("_cols").over(W.partitionBy(*keys).orderBy("_chunk")))
        .filter(F.col("_cols").isNotNull())
    )
    # Here the extra row comes from the chunk after, so it goes last.
    frame = W.partitionBy(*by).orderBy(F.col("_own").desc(), *order)
    found = _with_extra(rows, handed_on).withColumn(name, F.lead("_cols").over(frame))
    return found.filter("_own").drop("_own", "_cols", "_chunk")


def over_previous(
    df: DataFrame, keys: list[str], order: list[str], n: int, new: dict[str, Column], rows_per_chunk: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """Adds aggregates over the ``n`` rows of the key right before each row.

    Rows are numbered along their key from the sizes of its chunks. A chunk that begins at number s is led in by the rows
    numbered s - n to s - 1, whichever chunks hold them: each takes exactly these, by their numbers, from the last rows
    of the chunks that others follow.
    """
    rows, by = split_busy_keys(df, keys, order, rows_per_chunk)
    frame = W.partitionBy(*by).orderBy(*order).rowsBetween(-n, -1)
    wanted = {name: agg.over(frame) for name, agg in new.items()}
    if by == keys:
        return rows.withColumns(wanted)
    hot = rows.filter(F.col("_chunk").isNotNull())
    along = W.partitionBy(*keys).orderBy("_chunk")
    sizes = hot.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    begins = F.coalesce(F.sum("_size").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # The few chunks of keys that a border cuts.
    cut = cut_lineage(
        sizes.select(*by, begins.alias("_begin"), "_size", F.lead("_chunk").over(along).isNotNull().alias("_followed"))
        .filter((F.col("_begin") > 0) | F.col("_followed"))
    )
    last = W.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        join_on(hot, cut.filter("_followed"), by)
        .withColumn("_back", F.row_number().over(last))
        .filter(F.col("_back") <= n)
        .withColumn("_no", F.col("_begin") + F.col("_size") - F.col("_back"))
        .drop("_begin", "_size", "_followed", "_back", "_chunk")
    )
    begin = F.col("_begin")
    needed = cut.filter(begin > 0).select(*by, F.explode(F.sequence(F.greatest(begin - n, F.lit(0)), begin - 1)).alias("_no"))
    lead_in = join_on(tails, needed, [*keys, "_no"]).drop("_no")
    return _with_extra(rows, lead_in).withColumns(wanted).filter("_own").drop("_own", "_chunk")


def first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key.

    Spark cuts each key to ``n`` rows inside every map task before it shuffles (window group
    limit), so a hot key arrives as ``n`` rows per map task. Where that is still much, the cut
    is made in two rounds over salted keys.
    """
    if n > FEW_ROWS:
        round_one = W.partitionBy(*keys, "_salt").orderBy(*order)
        # A hash of the row, not a random number: a task that runs again must salt alike.
        hashable = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
        df = (
            df.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(SALTS)))
            .withColumn("_rn", F.row_number().over(round_one))
            .filter(F.col("_rn") <= n)
            .drop("_salt", "_rn")
        )
    return (
        df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        .filter(F.col("_rn") <= n)
        .drop("_rn")
    )
