"""Every text operator and pipeline stage on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from selvatrace.llm import decontaminate, html_text, language, packing, quality, quality_model, queries, secret_scan, simhash, toxicity, urls

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use for columns of their own, and one that differs from an input's in case only.
EXTRA = ("score", "spans", "kept", "fp", "n", "ids", "queue", "words", "TEXT", "kind", "y")
LONG = "long winding road " * 40_000
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, "   \n\t ", None, "s", 5),
    (4, LONG, "en", "s", len(LONG)),
    (5, "same words here and there again today", "en", "s", 10),
    (5, "same words here and there again today", "en", "s", 10),
    (6, "same words here and there again today", None, None, None),
    (None, "no id at all", "en", "s", 12),
    (7, "٣ été Ünï 漢字 😀 token=abcdef1234", "fr", "t", None),
]
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (5, 1, 1), (4, None, None), (None, 0, 1), (99, 0, 0)], LABELS)


def crowded(df):
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(EXTRA) if c not in df.columns])


OPERATORS = {
    "quality": lambda s, d, lab: quality.cascade(d),
    "quality_model": lambda s, d, lab: quality_model.classify(d, lab),
    "language": lambda s, d, lab: language.identify(d, language.fit(d)),
    "toxicity": lambda s, d, lab: toxicity.score(d, toxicity.fit(d, lab)),
    "secrets": lambda s, d, lab: secret_scan.scan(d),
    "simhash": lambda s, d, lab: simhash.near_duplicates(d),
    "decontaminate": lambda s, d, lab: decontaminate.contamination(d, s.read.parquet(f"{FOLDER}/benchmark.parquet")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(spark, docs, labels, name):
    out = OPERATORS[name](spark, docs, labels)
    rows = out.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((r[0] is None, r[0] or 0) for r in ROWS)
    again = OPERATORS[name](spark, crowded(docs).repartition(3), labels).collect()
    told = lambda x: sorted(str(tuple(v for c, v in zip(r.__fields__, r, strict=True) if c != "rejected_by")) for r in x)
    assert told(again) == told(rows)
    empty = OPERATORS[name](spark, docs.limit(0), labels.limit(0))
    assert empty.columns == out.columns and empty.count() == 0


def test_defined_values(spark, docs, labels):
    assert {r.lang_pred for r in OPERATORS["language"](spark, docs, labels).filter("doc_id IN (1, 2, 3)").collect()} == {"und"}
    prints = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert prints[1].fingerprint == "0" * 16 and prints[3].component_id == 1 and prints[6].component_id == 5
    secrets = {r.doc_id: r.secrets for r in secret_scan.scan(docs).collect()}
    assert [(s.kind, s.start, s.end) for s in secrets[7]] == [("assign", 15, 31)]
    assert all(r.toxicity < 0.5 for r in OPERATORS["toxicity"](spark, docs, labels).collect())
    alone = quality_model.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in alone} == {1.0}


def test_packing_edges(spark, docs):
    out = packing.packed(crowded(docs), queries.vocabulary()).collect()
    for i in (1, 2):
        assert [(r.start, r.length, r.doc_tokens) for r in out if r.doc_id == i] == [(0, 1, 1)]
    assert sum(r.length for r in out if r.doc_id == 5) == 2 * next(r.doc_tokens for r in out if r.doc_id == 5)
    assert any(r.doc_id is None for r in out)
    assert packing.packed(docs.limit(0), queries.vocabulary()).count() == 0


def test_pages_edges(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no scheme", "<p>"), (None, "http://A.Example.net/en/x?q#f", "plain text"), (5, "u", "<div " * 3000)]
    pages = spark.createDataFrame([*rows, rows[3]], "page_id bigint, url string, html string")
    texts = html_text.extract(crowded(pages)).collect()
    assert len(texts) == 6 and all(r.text is not None for r in texts)
    assert [r.text for r in texts if r.page_id in (1, 2, 3)] == ["", "", ""]
    judged = urls.judge(crowded(pages), queries.URL_RULES).collect()
    assert {(r.host, r.path, r.rule, r.verdict) for r in judged if r.page_id is None} == {("a.example.net", "/en/x", "example.net/en/", "allow")}
    assert {(r.host, r.path, r.verdict) for r in judged if r.page_id in (1, 2, 3)} == {("", "", "allow")}
    assert html_text.extract(pages.limit(0)).count() == 0 and urls.judge(pages.limit(0), {}).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, name, stage):
    for given in (docs, crowded(docs), docs.limit(0)):
        out = stage(spark, given, FOLDER)
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS
        rows = out.collect()
        assert bool(rows) == bool(given.count())


def test_stage_decisions(spark, docs):
    kept = dict(corpus_pipeline.STAGES)["simhash_dedup"](spark, docs, FOLDER).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 4, 5, 7] and any(r.doc_id is None for r in kept)
    clean = {r.doc_id: r for r in dict(corpus_pipeline.STAGES)["secret_scan"](spark, docs, FOLDER).collect()}
    assert clean[7].text == "٣ été Ünï 漢字 😀 <assign>" and clean[7].n_chars == 23 and clean[1].text is None


def test_stages_decide_by_row(spark):
    """Several rows without an id, and ids on different texts, beside an id that repeats."""
    hit = spark.read.parquet(f"{FOLDER}/benchmark.parquet").filter("size(split(text, ' ')) > 12").first().text
    rows = [
        (None, "the first of the nameless"), (None, "another one without a name"), (None, "another one without a name"),
        (1, "a text on its own"), (1, "quite a different text"), (1, "quite a different text"), (2, "a text on its own"),
        (3, "this one is clean"), (3, f"before {hit} after"), (None, f"quite some other words here, more than a few, stand above {hit}"), (None, "a text on its own"),
    ]
    given = spark.createDataFrame([(i, t, "en", "s", k) for k, (i, t) in enumerate(rows)], SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    left = stages["simhash_dedup"](spark, given, FOLDER).collect()
    gone = [rows[2], rows[5], rows[6], rows[10]]
    told = lambda x: sorted(x, key=str)
    want = list(rows)
    for r in gone:
        want.remove(r)
    assert told((r.doc_id, r.text) for r in left) == told(want)
    left = stages["decontamination"](spark, given, FOLDER).collect()
    assert sorted(r.n_chars for r in left) == [0, 1, 2, 3, 4, 5, 6, 7, 10]
