"""Allow or block URLs: rules first, then logistic regression on hashed character n-grams.

Method. A small labelled table of URLs, made from general words, trains the regression: 3-, 4- and 5-grams of host and path, marked by
which of the two they come from and hashed into a fixed number of features. Rules
name a host, with all its subdomains, and the start of a path; the longest that fits wins over the model.

Defined results: a URL that is null or has no ``://`` has empty host and path, fits no rule, and is judged by
the model like any other (an empty one is allowed); ties between equally long rules cannot occur, as two such rules that fit are
the same; repeated rows give a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selvatrace.llm.common import pick

FEATURES = 4096
SIZES = (3, 4, 5)
ROUNDS = 300

#: The small labelled table: general words of addresses that are sold or abused (1), and of ordinary ones (0).
WORDS = {
    1: (
        "casino poker slots jackpot roulette betting bets lottery blackjack pills viagra cialis pharmacy meds cheap replica discount "
        "porn xxx adult sexy singles webcam escort ads adserver banner popup click tracker tracking spam seo backlinks loans payday "
        "debt crypto forex profit crack keygen warez torrent prize win winner bonus free rich"
    ).split(),
    0: (
        "river library news weather university council museum docs recipes kitchen garden school hospital science journal maps city "
        "forum hiking history archive books travel guide sports results cinema reviews music notes family health energy water bridge "
        "mountain village theatre orchestra painting bakery coffee bicycle railway airport harbor court parliament education research "
        "physics biology climate nature forest bird house paper letter"
    ).split(),
}
ENDS = (".com", ".org", ".net", ".info", ".co.uk")
FRONTS = ("", "www.", "blog.", "m.", "")
PATHS = ("", "/", "/index.html", "/about", "/2020/05/story", "/item?id=7")


def labelled(words: dict[int, list[str]] = WORDS) -> list[tuple[str, str, int]]:
    """(host, path, label): each word alone and before three others of its label. What stands around them, and the
    paths, are the same for both labels."""
    out = []
    for label, own in words.items():
        for i, word in enumerate(own):
            names = [word, *(f"{word}{'-' if (i + s) % 2 else ''}{own[(i + s) % len(own)]}" for s in (1, 7, 16))]
            for j, name in enumerate(names, i):
                out.append((FRONTS[j % len(FRONTS)] + name + ENDS[j * 3 % len(ENDS)], PATHS[j % len(PATHS)], label))
    return out


def features(host: str, path: str) -> np.ndarray:
    """Sorted distinct features of an address."""
    found = set()
    for mark, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in SIZES:
            found.update(zlib.crc32(f"{mark}{text[i : i + n]}".encode("utf-8", "replace")) % FEATURES for i in range(len(text) - n + 1))
    return np.array(sorted(found), dtype=np.int64)


def train(rows: list[tuple[str, str, int]]) -> np.ndarray:
    """Weights of the features and, last, the constant: gradient steps on the mean loss with a small penalty."""
    x = np.zeros((len(rows), FEATURES + 1))
    for i, (host, path, _) in enumerate(rows):
        at = features(host, path)
        x[i, at] = 1 / np.sqrt(max(1, len(at)))
    x[:, -1] = 1
    y = np.array([r[2] for r in rows], dtype=float)
    w = np.zeros(FEATURES + 1)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 4.0 * (x.T @ (p - y) / len(y) + 1e-4 * w)
    return w


def judge(
    pages: DataFrame,
    rules: dict[str, str],
    key: str = "page_id",
    url: str = "url",
    training: list[tuple[str, str, int]] | None = None,
    limit: float = 0.5,
) -> DataFrame:
    """(key, host, path, rule, spam, verdict): one row per row of ``pages``. ``rules``: ``host/path`` to its verdict;
    ``spam``: the model's probability that the address is to be blocked."""
    weights = train(training or labelled())
    rows = pick(pages, key, url)
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substring(u, F.instr(u, "://") + 3, F.length(u))).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    split = rows.select(key, rest.alias("rest")).select(
        key,
        F.translate(F.regexp_extract("rest", r"(?s)^[^/?#]*", 0), upper, lower).alias("host"),
        F.regexp_extract("rest", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"),
    )
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        host, _, path = rule.partition("/")
        here = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits.append(F.when(here & F.col("path").startswith(f"/{path}"), F.lit(rule)))
    ruled = split.withColumn("rule", F.coalesce(*fits) if fits else F.lit(None).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            told = []
            for host, path in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                at = features(host, path)
                told.append(weights[at].sum() / np.sqrt(max(1, len(at))) + weights[-1])
            spam = 1 / (1 + np.exp(-np.array(told, dtype=float)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(spam, pa.float64())], names=[key, "host", "path", "rule", "spam"])

    kind = ruled.schema[key].dataType.simpleString()
    scored = ruled.mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, spam double")
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    empty = F.col("host") == ""
    by_model = F.when((F.col("spam") >= limit) & ~empty, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce(by_rule, by_model))
