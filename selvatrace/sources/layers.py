"""Reading layers with a fixed schema and writing evidence."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD_ROW = "_bad_row"
FILE = "_file"
GEOJSON = "type string, coordinates array<array<array<double>>>"


def read_layer(
    spark: SparkSession, path: str, fmt: str, schema: str, header: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows of a parquet, CSV or JSON layer, and the rows that do not fit the schema.

    The bad rows come back as their text in ``_bad_row``, with the file they stand in, instead of failing the run or
    turning into nulls unseen. With ``header``, lines of a CSV layer equal to its first line are no rows. Parquet files
    carry their own types: see ``_parquet_layer``.
    """
    if fmt == "parquet":
        return _parquet_layer(spark, path, schema)
    if fmt not in {"csv", "json"}:
        raise ValueError(f"unknown layer format {fmt!r}")
    # Read as text and parse here: the schema's own columns may then be pruned freely, which
    # the readers forbid for a query on the bad-row column alone.
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias(FILE))
    first = text.first() if header and fmt == "csv" else None
    if first is not None:
        text = text.filter(F.col("value") != first["value"])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_ROW}
    if fmt == "json":
        parsed = F.from_json("value", f"{schema}, {BAD_ROW} string", options)
    else:
        parsed = F.from_csv("value", f"{schema}, {BAD_ROW} string", options)
    rows = text.filter(F.length(F.trim("value")) > 0).select(parsed.alias("_row"), "value", FILE)
    bad = F.col(f"_row.{BAD_ROW}").isNotNull()
    names = [f.name for f in T.StructType.fromDDL(schema)]
    return (
        rows.filter(~bad).select(*[F.col("_row")[n].alias(n) for n in names]),
        rows.filter(bad).select(F.col("value").alias(BAD_ROW), FILE),
    )


def _parquet_layer(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The layer's rows in the wanted types, and as JSON those that hold a value that these types cannot hold.

    Footers are read first, in Spark's own distributed job. Where all files agree with the schema they are read with it, and
    no row is bad. Otherwise files are read in runs of one type each: text must parse, and any other value must come back
    unchanged from the cast (2.0 fits a whole number, 2.5 does not). Columns that a file lacks are null.
    """
    wanted = T.StructType.fromDDL(schema)
    whole = spark.read.schema(schema).parquet(path)
    files = sorted(unquote(f) for f in whole.inputFiles())
    none = spark.createDataFrame([], f"{BAD_ROW} string, {FILE} string")
    runs = _runs(spark, path, files) if files else []
    kinds = {f.name.lower(): f.dataType for f in wanted}
    if all(kinds.get(f.name.lower(), f.dataType) == f.dataType for _, found in runs for f in found):
        return whole, none
    good, bad = [], []
    for some, found in runs:
        rows = _reader(spark, path, some).schema(found).parquet(*some)
        held = {f.name.lower(): f for f in found}
        casts, broken = [], F.lit(False)
        for f in wanted:
            value, fits = _as_wanted(spark, held.get(f.name.lower()), f)
            casts.append(value.alias(f.name))
            broken = broken | ~fits
        text = F.to_json(F.struct(*[F.col(f"`{n}`") for n in found.names]), {"ignoreNullFields": "false"})
        good.append(rows.filter(~broken).select(*casts))
        bad.append(rows.filter(broken).select(text.alias(BAD_ROW), F.col("_metadata.file_path").alias(FILE)))
    return reduce(DataFrame.unionByName, good), reduce(DataFrame.unionByName, bad)


def _reader(spark: SparkSession, path: str, files: list[str]) -> DataFrameReader:
    """A reader for some files of ``path`` that still sees the columns in the names of its folders."""
    one = files[0].endswith(path.removeprefix("file:").rstrip("/"))
    return spark.read if one or set(path) & set("*?[{") else spark.read.option("basePath", path)


def _runs(spark: SparkSession, path: str, files: list[str]) -> list[tuple[list[str], T.StructType]]:
    """The files in runs whose types agree, each with its merged schema.

    Where Spark cannot merge the footers of a run it is halved. So files that agree take one job, and others about
    two for each level of halving at each change of type along the sorted names.
    """
    try:
        return [(files, _reader(spark, path, files).option("mergeSchema", "true").parquet(*files).schema)]
    except (PySparkException, Py4JJavaError) as e:  # Spark's own error comes unconverted from the reading job
        if len(files) == 1 or "CANNOT_MERGE" not in str(e):
            raise
    half = len(files) // 2
    return _runs(spark, path, files[:half]) + _runs(spark, path, files[half:])


def _as_wanted(spark: SparkSession, held: T.StructField | None, wanted: T.StructField) -> tuple[Column, Column]:
    """The value in the wanted type, and whether it fits."""
    if held is None:
        return F.lit(None).cast(wanted.dataType), F.lit(True)
    was = F.col(f"`{held.name}`")
    if held.dataType == wanted.dataType:
        return was, F.lit(True)
    value = was.try_cast(wanted.dataType)
    same = value.isNotNull() if isinstance(held.dataType, T.StringType) else value.try_cast(held.dataType).eqNullSafe(was)
    try:
        spark.createDataFrame([], T.StructType([held])).select(value, same).schema  # noqa: B018
    except AnalysisException:  # there is no such cast
        return F.lit(None).cast(wanted.dataType), was.isNull()
    return value, was.isNull() | same


def parse_polygons(df: DataFrame, key: str, geojson: str) -> DataFrame:
    """GeoJSON polygons as ``rings``; anything else comes back with null rings.

    Ring 0 is the outer ring, the rest are holes.
    """
    shape = F.from_json(geojson, GEOJSON)

    def vertex(p: Column) -> Column:
        return F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))

    rings = F.transform(shape["coordinates"], lambda ring: F.transform(ring, vertex))
    return df.select(key, F.when(shape["type"] == "Polygon", rings).alias("rings"))


def polygon_rules(rings: Column) -> dict[str, Column]:
    """Named rules for ``validate_split``: what the spatial operators take for granted."""
    vertices = F.flatten(rings)
    return {
        "has_rings": F.size(rings) > 0,
        "ring_has_three_vertices": F.forall(rings, lambda r: F.size(F.array_distinct(r)) >= 3),
        "no_null_coordinate": F.forall(vertices, lambda v: v.x.isNotNull() & v.y.isNotNull()),
        "inside_the_world": F.forall(vertices, lambda v: v.x.between(-180.0, 180.0) & v.y.between(-90.0, 90.0)),
        "narrower_than_half_the_world": F.array_max(F.transform(vertices, lambda v: v.x))
        - F.array_min(F.transform(vertices, lambda v: v.x))
        < 180.0,
    }


def write_evidence(df: DataFrame, path: str, parts: list[str], order: list[str], files: int | None = None) -> None:
    """Writes ``df`` partitioned by ``parts`` with rows in ``order`` inside each file.

    The ranges are cut by ``parts`` and ``order`` together, so a part that holds most of the
    rows is spread over several tasks and files. Without ``files`` their number follows the data: Spark's shuffle
    partitions, merged by size at run time.
    """
    keys = [F.col(c) for c in [*parts, *order]]
    ranges = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    (
        ranges.sortWithinPartitions(*keys)
        .write.mode("errorifexists")
        .partitionBy(*parts)
        .parquet(path)
    )
