"""Quality rules as a short-circuit cascade, in built-in functions only.

Method. Each rule rejects a text by one measure. On a sample, every rule's cost (seconds to evaluate it
over the sample, above the cost of reading) and selectivity (share of the sample that it rejects) are estimated. Rules are then
ordered by rejections per cost and chained in one CASE expression, so that a text rejected early never reaches the
costly rules behind. The order changes how fast a verdict is found and never the verdict, as any failing rule
rejects.

Defined results: a null or empty text has no words and fails the rule on their number; a rule whose measure is undefined for
a text (a share of no words) does not reject it; repeated rows give a row each; an empty table gives an
empty result and leaves the rules in their given order; other columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selvatrace.llm.common import pick

#: Documents of the sample that orders the rules.
SAMPLE_ROWS = 400
REPEAT_WINDOW = 8

_SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, _SPACE, "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def n_repeat_words(word_list: Column, size: int = REPEAT_WINDOW) -> Column:
    """Words in windows of ``size`` words that the text holds at least twice.

    Windows are compared by 64-bit hashes. Where all differ, which is usual, that is all. Else the
    repeated windows are found by sorting hashes with their places, and the words they cover are counted from left to right.
    """

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(order: Column) -> Column:
            twice = F.filter(
                order,
                lambda x, k: (F.get(order, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(order, k + 1)["h"].eqNullSafe(x["h"])),
            )
            places = F.array_sort(F.transform(twice, lambda x: x["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            return F.aggregate(
                places,
                start,
                lambda a, i: F.struct(
                    (a["n"] + i + F.lit(size) - F.greatest(a["end"], i)).alias("n"), (i + F.lit(size)).alias("end")
                ),
                lambda a: a["n"],
            )

        return let(placed, again)

    def windows(hashed: Column) -> Column:
        last = F.size(hashed) - size
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(hashed, i + j) for j in range(size)]))

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    hashed = F.transform(word_list, lambda w: F.xxhash64(w))
    return let(hashed, lambda x: let(windows(x), count)).cast("bigint")


@dataclass(frozen=True)
class Rule:
    """``rejects``: from the text and its measures, a condition under which the text goes."""

    name: str
    rejects: Callable[[Column, dict[str, Column]], Column]


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def _upper_share(text: Column) -> Column:
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return _share(F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")), letters)


def _letter_share(text: Column, m: dict[str, Column]) -> Column:
    return _share(F.length(F.regexp_replace(text, r"[^\p{L}]+", "")), m["word_chars"])


#: Limits follow those in use for web text: word count, word length, symbols, capitals, letters, repeated lines and words.
RULES = (
    Rule("few_words", lambda t, m: m["n_words"] < 20),
    Rule("repeated_words", lambda t, m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    Rule("word_length", lambda t, m: ~_share(m["word_chars"], m["n_words"]).between(2, 14)),
    Rule("symbols", lambda t, m: _share(m["n_symbols"], m["n_words"]) > 0.3),
    Rule("repeated_lines", lambda t, m: _share(m["n_dup_lines"], F.size(F.split(t, "\n"))) > 0.5),
    Rule("capitals", lambda t, m: _upper_share(t) > 0.4),
    Rule("letters", lambda t, m: _letter_share(t, m) < 0.6),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, measures): the null text as empty."""
    rows = pick(docs, key, text).select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    t = F.col("text")
    both = let(words(t), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), n_repeat_words(w).alias("again")))
    # The struct is a column of its own and is read twice from the same row.
    return (
        rows.select(key, "text", both.alias("w"), word_chars(t).alias("word_chars"), n_symbols(t).alias("n_symbols"), n_dup_lines(t).alias("n_dup_lines"))
        .select(key, "text", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("w.again").alias("n_repeat_words"))
    )


def ordered(rows: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """Rules with their cost (seconds) and selectivity on a sample, by rejections per cost."""
    sample = rows.limit(sample_rows).repartition(1).persist()
    try:
        total = sample.count()
        if not total:
            return [(r, 0.0, 0.0) for r in rules]
        columns = {c: F.col(c) for c in MEASURES}

        def timed(condition: Column) -> tuple[float, int]:
            began = time.perf_counter()
            hit = sample.agg(F.sum(condition.cast("int"))).first()[0]
            return time.perf_counter() - began, hit or 0

        timed(F.col("n_words") < 0)
        idle, _ = timed(F.col("n_words") < 0)
        told = []
        for rule in rules:
            seconds, hit = timed(rule.rejects(F.col("text"), columns))
            told.append((rule, max(seconds - idle, 1e-3), hit / total))
        return sorted(told, key=lambda x: -x[2] / x[1])
    finally:
        sample.unpersist()


def cascade(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, measures, kept, rejected_by): one row per row of ``docs``. ``rejected_by``: the first rule, in
    the order found on the sample, that the text fails."""
    rows = measured(docs, key, text)
    columns = {c: F.col(c) for c in MEASURES}
    verdict = F.lit(None).cast("string")
    for rule, _, _ in reversed(ordered(rows, rules)):
        verdict = F.when(rule.rejects(F.col("text"), columns), F.lit(rule.name)).otherwise(verdict)
    return rows.select(key, *MEASURES, verdict.alias("rejected_by")).withColumn("kept", F.col("rejected_by").isNull())
