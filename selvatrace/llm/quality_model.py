"""Quality scores by random Fourier features, ridge regression and isotonic calibration.

Method. A text is a short vector of statistics (lengths, shares of kinds of characters, distinct words and lines).
Random cosine features of the standardised vector approximate a Gaussian kernel. Each
partition of labelled rows sums its part of the normal equations; the sums are added up and solved with a ridge penalty. The pool-adjacent-violators
rule then fits a rising step curve from raw scores to probabilities, on labelled rows that the regression did not see.

Learning uses at most about ``FIT_ROWS`` labelled rows, chosen by a hash of the id.

Defined results: null and empty texts have all statistics zero and are scored like any other; without labels of both classes every score is
the share of label 1 (1 without labels); repeated rows give a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from selvatrace.llm import quality
from selvatrace.llm.common import about, bucket, pick, written

FIT_ROWS = 60_000
#: Raw scores that agree to this many digits are ties.
TIE_DIGITS = 10
FEATURES = 256
WIDTH = 3.0
RIDGE = 1.0
SEED = 20
#: One part in so many of the training rows calibrates.
CALIBRATE = 4

STATISTICS = (
    "log_words", "word_length", "symbols", "capitals", "digits", "marks", "distinct_words", "distinct_lines", "words_per_line",
)


def _count(text: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kind}]+", ""))


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, STATISTICS): built-in functions only; the text does not leave the JVM."""
    rows = pick(docs, key, text).select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    t = F.col("text")
    counted = rows.select(
        key,
        quality.let(
            quality.words(t), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d"))
        ).alias("w"),
        quality.let(
            F.split(t, "\n"), lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))
        ).alias("x"),
        quality.word_chars(t).alias("chars"),
        _count(t, "#*$%&|<>").alias("symbols"),
        _count(t, r"\p{Lu}").alias("capitals"),
        _count(t, "0-9").alias("digits"),
        _count(t, "!?.,;:").alias("marks"),
    )
    n = F.greatest(F.col("w.n"), F.lit(1))
    chars = F.greatest("chars", F.lit(1))
    # A text's share of distinct words falls with its length, in its logarithm about linearly.
    return counted.select(
        key,
        F.log1p("w.n").alias("log_words"),
        (F.col("chars") / n).alias("word_length"),
        F.least(F.col("symbols") / n, F.lit(4.0)).alias("symbols"),
        (F.col("capitals") / chars).alias("capitals"),
        (F.col("digits") / chars).alias("digits"),
        (F.col("marks") / n).alias("marks"),
        (F.log1p("w.d") / F.greatest(F.log1p("w.n"), F.lit(0.7))).alias("distinct_words"),
        (F.col("x.d") / F.greatest(F.col("x.n"), F.lit(1))).alias("distinct_lines"),
        F.log1p(F.col("w.n") / F.greatest(F.col("x.n"), F.lit(1))).alias("words_per_line"),
    )


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray  # raw scores at which the calibrated score rises
    levels: np.ndarray  # calibrated score from each edge on

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), self.levels[0])
        raw = fourier((x - self.mean) / self.scale) @ self.weights
        return np.interp(raw, self.edges, self.levels)


def fourier(x: np.ndarray) -> np.ndarray:
    """Random cosine features of standardised vectors, a linear part and a constant."""
    random = np.random.default_rng(SEED)
    directions = random.normal(size=(x.shape[1], FEATURES)) / WIDTH
    shifts = random.uniform(0, 2 * np.pi, FEATURES)
    x = np.clip(x, -6, 6)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(x @ directions + shifts), np.ones((len(x), 1))])


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Middle raw score and mean label of the pools that the pool-adjacent-violators rule leaves.

    Equal raw scores (to ``TIE_DIGITS`` digits) are one pool before the rule, so the order of rows plays no part. Pools are pulled towards the overall mean by one row's weight, so that no score is exactly 0 or 1.
    """
    values, which, rows = np.unique(np.round(raw, TIE_DIGITS), return_inverse=True, return_counts=True)
    ones = np.bincount(which, y, len(values))
    pools: list[list[float]] = []  # sum of labels, rows, sum of raw scores
    for r, label, n in zip(values.tolist(), ones.tolist(), rows.tolist(), strict=True):
        pools.append([label, n, r * n])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    mean = float(y.mean())
    edges = np.array([p[2] / p[1] for p in pools])
    levels = np.array([(p[0] + mean) / (p[1] + 1) for p in pools])
    return edges, np.maximum.accumulate(levels)


def fit(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", folds: int = 5) -> Model:
    """Learns from labelled rows whose CRC-32 of the id is no multiple of ``folds``.

    An id counts once however often it is repeated: with the mean of its labels, and the least of its texts' statistics.
    """
    known = pick(labels, key, label).filter(F.col(label).isNotNull() & F.col(key).isNotNull() & (bucket(F.col(key), folds) != 0))
    known = known.groupBy(key).agg(F.avg((F.col(label) > 0).cast("double")).alias("y"))
    known = about(known, key, known.count(), FIT_ROWS)
    part = F.pmod(F.xxhash64(F.lit(3), key), F.lit(CALIBRATE)) == 0
    rows = stats.join(known, key).groupBy(key, "y").agg(F.min(F.struct(*STATISTICS)).alias("s"))
    rows = rows.select("s.*", "y", part.alias("later"))
    rows = rows.repartition(8).persist()
    size = rows.agg(
        F.count("*").alias("n"), F.sum("y").alias("ones"), F.sum((~F.col("later")).cast("int")).alias("used"),
        *[F.avg(c).alias(f"m_{c}") for c in STATISTICS], *[F.stddev_pop(c).alias(f"s_{c}") for c in STATISTICS],
    ).first()
    ones = size["ones"] or 0.0
    if not size["n"] or ones in (0.0, float(size["n"])) or not size["used"] or size["used"] == size["n"]:
        rows.unpersist()
        share = ones / size["n"] if size["n"] else 1.0
        return Model(np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(1), np.array([share]))
    mean = np.array([size[f"m_{c}"] for c in STATISTICS])
    scale = np.array([size[f"s_{c}"] or 1.0 for c in STATISTICS])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, right = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for b in batches:
            z = fourier((b[list(STATISTICS)].to_numpy() - mean) / scale)
            gram += z.T @ z
            right += z.T @ b["y"].to_numpy()
        yield pd.DataFrame({"gram": [gram.ravel().tolist()], "right_side": [right.tolist()]})

    parts = rows.filter("NOT later").mapInPandas(sums, "gram array<double>, right_side array<double>").collect()
    gram = sum(np.array(p["gram"]) for p in parts).reshape(FEATURES + 1, FEATURES + 1)
    right = sum(np.array(p["right_side"]) for p in parts)
    weights = np.linalg.solve(gram + RIDGE * np.eye(FEATURES + 1), right)
    rest = rows.filter("later").toPandas()
    rows.unpersist()
    raw = fourier((rest[list(STATISTICS)].to_numpy() - mean) / scale) @ weights
    return Model(mean, scale, weights, *isotonic(raw, rest["y"].to_numpy()))


def scored(stats: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, score) from the statistics."""
    kind = stats.schema[key].dataType.simpleString()

    @F.pandas_udf("double")
    def scores(*columns: pd.Series) -> pd.Series:
        return pd.Series(np.clip(model.score(np.column_stack(columns)), 0, 1))

    return stats.select(F.col(key).cast(kind), scores(*STATISTICS).alias("score"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(key, score): one row per row of ``docs``. Statistics are computed once and written."""
    stats = written(statistics(docs, key, text), "quality-statistics")
    return scored(stats, fit(stats, labels, key, label), key)
