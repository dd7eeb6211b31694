"""Row text and checksums that do not depend on partitioning or row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_text(df: DataFrame, cols: list[str]) -> Column:
    """One unambiguous text per row: each value carries its length, so neither a null nor a
    separator inside a value can make two different rows read the same."""

    def part(name: str) -> Column:
        kind = df.schema[name].dataType
        value = F.col(name)
        if isinstance(kind, T.TimestampNTZType):
            value = F.unix_micros(value.cast("timestamp"))
        elif isinstance(kind, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(value)
        text = value.cast("string")
        return F.concat_ws(":", F.length(text).cast("string"), text)

    # concat_ws would skip a null, so a null value gets a mark of its own.
    return F.concat_ws("|", *[F.when(F.col(c).isNull(), F.lit("-")).otherwise(part(c)) for c in cols])


def digest_sum(text: Column) -> Column:
    """Sum over all rows of the first 15 hex digits of the SHA-256 of ``text``.

    The 60-bit numbers are summed as three 20-bit pieces: long sums run in generated code, hold
    for 2**43 rows, and spare a big-decimal addition per row.
    """
    number = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")
    mask = F.lit(2**20 - 1)
    pieces = [F.shiftright(number, 20 * i).bitwiseAND(mask) for i in range(3)]
    total = F.lit(0).cast("decimal(38,0)")
    for i, piece in enumerate(pieces):
        weight = F.lit(2 ** (20 * i)).cast("decimal(14,0)")
        total = total + (F.coalesce(F.sum(piece), F.lit(0)).cast("decimal(20,0)") * weight)
    return total.cast("decimal(38,0)")
