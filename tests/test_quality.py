"""Validation, versions, manifests, run comparison, layers."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from selvatrace.operators import quality
from selvatrace.session import scratch_path
from selvatrace.sources import layers


def test_validate_split_counts_a_null_rule_as_broken(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id int, v int")
    ok, bad = quality.validate_split(df, {"positive": F.col("v") > 0, "small": F.col("v") < 3})
    assert [r.id for r in ok.collect()] == []
    assert {r.id: r.reasons for r in bad.collect()} == {1: ["small"], 2: ["positive"], 3: ["positive", "small"]}


def test_latest_version_is_the_same_for_any_partitioning(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(5), rng.randrange(3), rng.randrange(100)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k int, version int, v int")
    want = sorted(max(r for r in rows if r[0] == k) for k in range(5))
    for n in (1, 7):
        got = quality.latest_version(df.repartition(n), ["k"], ["version"]).collect()
        assert sorted((r.k, r.version, r.v) for r in got) == want


def test_manifest(spark):
    df = spark.createDataFrame([(i, f"v{i}", None if i % 4 else float(i)) for i in range(200)], "id bigint, s string, x double")
    cols = ["id", "s", "x"]

    def checksum(d):
        r = quality.manifest(d, "d", cols, {"b": "2", "a": "1"}).first()
        assert r.params == {"a": "1", "b": "2"}
        return r.n_rows, r.checksum

    base = checksum(df)
    assert checksum(df.repartition(9)) == base
    assert checksum(df.orderBy(F.desc("id"))) == base
    assert checksum(df.unionByName(df.limit(1)))[1] != base[1]  # a repeated row shows
    assert checksum(df.filter("id < 0")) == (0, 0)


def test_manifest_tells_nulls_and_separators_apart(spark):
    schema = "a string, b string"
    pairs = [("x", None), (None, "x"), ("x|1:y", ""), ("x", "1:y|"), ("-", "-"), (None, None), ("", "")]
    sums = [quality.manifest(spark.createDataFrame([p], schema), "d", ["a", "b"], {}).first().checksum for p in pairs]
    assert len(set(sums)) == len(pairs)


def test_run_diff(spark):
    schema = "key bigint, v string"
    old = spark.createDataFrame([(1, "same"), (2, "gone"), (3, "before"), (5, None), (6, None), (7, "d"), (7, "d"), (None, "n")], schema)
    new = spark.createDataFrame([(1, "same"), (3, "after"), (4, "came"), (5, "value"), (6, None), (7, "d"), (None, "n")], schema)
    got = {(r.key, r.v, r.change, r.side, r.copies) for r in quality.run_diff(old, new, ["key"]).collect()}
    assert got == {
        (2, "gone", "removed", "old", 1),
        (3, "before", "changed", "old", 1),
        (3, "after", "changed", "new", 1),
        (4, "came", "added", "new", 1),
        (5, None, "changed", "old", 1),
        (5, "value", "changed", "new", 1),
        (7, "d", "removed", "old", 1),  # one copy fewer
    }
    assert quality.run_diff(old, old.repartition(5), ["key"]).count() == 0


def test_quality_report(spark):
    df = spark.createDataFrame([(1, "b"), (None, "a"), (3, None)], "n int, s string")
    got = {r.column_name: r for r in quality.quality_report(df, ["n", "s"], [0.5]).collect()}
    assert (got["n"].n_rows, got["n"].n_nulls, got["n"].smallest, got["n"].largest, got["n"].approx_distinct) == (3, 1, "1", "3", 2)
    assert got["n"].percentiles == [1.0] and got["s"].percentiles is None
    assert (got["s"].smallest, got["s"].largest, got["s"].n_nulls) == ("a", "b", 1)


@pytest.mark.parametrize(
    "fmt,lines",
    [
        ("json", ['{"id": 1, "v": 2.5}', '{"id": "x", "v": 1}', "{broken", '{"id": 3, "v": null}', ""]),
        ("csv", ["1,2.5", "x,1", "2,3,4,5", "3,", ""]),
    ],
)
def test_read_layer_keeps_bad_rows(spark, fmt, lines):
    path = scratch_path(spark, "layer-test")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, bad = layers.read_layer(spark, path, fmt, "id bigint, v double")
    assert sorted((r.id, r.v) for r in good.collect()) == [(1, 2.5), (3, None)]
    assert sorted(r._bad_row for r in bad.collect()) == sorted(lines[1:3])


def test_read_layer_parquet(spark):
    good, bad = layers.read_layer(spark, "/root/testdata/sf0.001/region.parquet", "parquet", "r_regionkey int, r_name string")
    assert good.count() == 5 and bad.count() == 0
    with pytest.raises(ValueError):
        layers.read_layer(spark, "x", "xml", "a int")


def test_parse_polygons_and_rules(spark):
    square = "[[0,0],[1,0],[1,1],[0,1],[0,0]]"
    rows = [
        (1, '{"type":"Polygon","coordinates":[%s]}' % square),
        (2, '{"type":"Polygon","coordinates":[%s,[[0.2,0.2],[0.4,0.2],[0.4,0.4]]]}' % square),
        (3, '{"type":"Point","coordinates":[0,0]}'),
        (4, "{broken"),
        (5, None),
        (6, '{"type":"Polygon","coordinates":[[[0,0],[1,1]]]}'),
        (7, '{"type":"Polygon","coordinates":[[[170,0],[-170,0],[-170,1]]]}'),
        (8, '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,95]]]}'),
        (9, '{"type":"Polygon","coordinates":[[[0,0],[1],[1,1],[0,1]]]}'),
    ]
    parsed = layers.parse_polygons(spark.createDataFrame(rows, "id bigint, j string"), "id", "j")
    sizes = {r.id: None if r.rings is None else [len(x) for x in r.rings] for r in parsed.collect()}
    assert sizes == {1: [5], 2: [5, 3], 3: None, 4: None, 5: None, 6: [2], 7: [3], 8: [3], 9: [4]}
    ok, bad = quality.validate_split(parsed, layers.polygon_rules(F.col("rings")))
    assert sorted(r.id for r in ok.collect()) == [1, 2]
    why = {r.id: r.reasons for r in bad.collect()}
    assert why[6] == ["ring_has_three_vertices"]
    assert why[7] == ["narrower_than_half_the_world"]
    assert why[8] == ["inside_the_world"]
    assert "no_null_coordinate" in why[9]
    assert "has_rings" in why[3]


def test_write_evidence_is_sorted_and_split(spark):
    path = scratch_path(spark, "evidence-test")
    rows = [(i, "hot" if i % 3 else "cold") for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, part string").repartition(6)
    layers.write_evidence(df, path, ["part"], ["id"], files=6)
    back = spark.read.schema("id bigint, part string").parquet(path)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    files = back.groupBy(F.input_file_name().alias("f"), "part").agg(F.min("id").alias("a"), F.max("id").alias("b")).collect()
    assert sum(f.part == "hot" for f in files) > 1  # the large part has more than one file
    spans = sorted((f.a, f.b) for f in files if f.part == "hot")
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    one = spark.read.schema("id bigint").parquet(next(f.f for f in files))
    ids = [r.id for r in one.collect()]
    assert ids == sorted(ids)


def test_fixed_schema_of_every_table_matches_the_files(spark):
    from selvatrace.sources.roles import SCHEMAS

    for name, ddl in SCHEMAS.items():
        stored = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").schema
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in T.StructType.fromDDL(ddl)]


def test_run_diff_sees_new_columns(spark):
    old = spark.createDataFrame([(1, "a")], "key int, v string")
    new = spark.createDataFrame([(1, "a", 7)], "key int, v string, extra int")
    got = {(r.side, r.change, r.extra) for r in quality.run_diff(old, new, ["key"]).collect()}
    assert got == {("old", "changed", None), ("new", "changed", 7)}
    assert {(r.side, r.extra) for r in quality.run_diff(new, old, ["key"]).collect()} == {("old", 7), ("new", None)}


def test_csv_header_is_no_row(spark):
    path = scratch_path(spark, "headed")
    spark.createDataFrame([("name,n",), ("a,1",), ("b,x",)], "value string").coalesce(1).write.text(path)
    good, bad = layers.read_layer(spark, path, "csv", "name string, n int", header=True)
    assert [tuple(r) for r in good.collect()] == [("a", 1)] and [r._bad_row for r in bad.collect()] == ["b,x"]


def test_parquet_files_that_do_not_fit(spark):
    path = scratch_path(spark, "mixed layer")  # a blank in the path
    files = [
        ([(1, 1.5, "p")], "id bigint, v double, extra string"),
        ([("7", 2.0), ("x", 3.0), (None, 4.0)], "id string, v double"),
        ([(8, [1]), (9, None)], "id int, v array<int>"),
        ([(3.0,), (2.5,)], "ID double"),
    ]
    for i, (rows, schema) in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/part={i % 2}")
    good, bad = layers.read_layer(spark, path, "parquet", "id bigint, v double, part int")
    got = sorted(((r.id, r.v, r.part) for r in good.collect()), key=str)
    assert got == sorted([(1, 1.5, 0), (7, 2.0, 1), (None, 4.0, 1), (9, None, 0), (3, None, 1)], key=str)
    told = {r._bad_row.replace(" ", ""): r._file for r in bad.collect()}
    assert len(told) == 3 and all(f.endswith(".parquet") for f in told.values())
    assert any('"id":"x"' in t for t in told) and any('"v":[1]' in t for t in told) and any("2.5" in t for t in told)
    assert [r.v for r in good.select("v").filter("id = 1").collect()] == [1.5]


def test_percentile_ranks(spark):
    df = spark.range(1, 30_001).select(F.col("id").alias("n"), (F.col("id") % 3).cast("double").alias("tied"), F.lit(None).cast("int").alias("none"))
    got = {(r.column_name, r.percentile): r for r in quality.percentile_ranks(df, ["n", "tied", "none"], [0.1, 0.5]).collect()}
    assert len(got) == 6 and all(r.within for r in got.values())
    assert got["none", 0.5].value is None and got["none", 0.5].n_values == 0
    assert (got["tied", 0.5].n_below, got["tied", 0.5].n_upto) == (10_000, 20_000)
    assert abs(got["n", 0.1].n_upto - 3000) <= 4
    assert quality.percentile_ranks(df.select(F.lit("a").alias("s")), ["s"], [0.5]).count() == 0


def test_percentile_ranks_names_a_bad_mark(spark, monkeypatch):
    """A reported value that stands elsewhere is told apart."""
    df, real = spark.range(1000).select(F.col("id").alias("n")), quality.quality_report
    off = lambda *a: real(*a).withColumn("percentiles", F.array(F.lit(700.0)))
    monkeypatch.setattr(quality, "quality_report", off)
    assert [r.within for r in quality.percentile_ranks(df, ["n"], [0.5]).collect()] == [False]
