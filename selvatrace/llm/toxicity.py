"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Method. Texts are folded: lower case, look-alike letters of other scripts and digits that stand for
letters become the letters meant, and all other marks become blanks. Lexicon entries are
beginnings of words. One automaton finds them at word starts; the longest entry of a word counts, unless an exception
phrase covers it. The entries' weights add up, are set against the text's length, and a logistic
curve turns both into a score.

The lexicon has given words and learned ones: beginnings of words whose share of toxic training
documents is surely larger than of the others. Their weights are the logarithm of that ratio. Of beginnings that one set of
counts cannot tell apart only the longest is kept, so that no other word shares a needlessly short one. Learning
sees at most about ``FIT_ROWS`` labelled rows, chosen by a hash of the id.

Defined results: a null or empty text has no entries and gets the score of a text without any; with hardly any labels of
one class only the given words count, with default weights; null ids are scored like others; repeated rows give a row
each; repeated or contradictory labels count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selvatrace.llm.common import about, bucket, lean, logistic, pick, small

#: Most labelled rows that learning uses, about.
FIT_ROWS = 12_000
#: With fewer labelled rows of either class nothing is learned.
LEAST_ROWS = 5
#: Most learned entries.
ENTRIES = 2_000
SHORTEST, LONGEST = 3, 10
GIVEN_WEIGHT = 3.0

#: Words that insult, and phrases in which they do not.
GIVEN = (
    "asshole", "bastard", "bitch", "clown", "cretin", "degenerate", "disgusting", "dumbass", "filth", "freak", "garbage human",
    "idiot", "imbecile", "jerk", "loser", "lowlife", "moron", "pathetic", "scum", "shut up", "stupid", "trash", "vermin",
    "worthless",
)
EXCEPTIONS = (
    "clown fish", "clownfish", "trash can", "trash bin", "trash bag", "trash collection", "loser bracket", "control freak",
    "idiot proof", "jerk chicken", "jerk seasoning", "scum line", "pond scum", "class clown", "sympathetic",
)

#: Digits and signs read as letters, and letters of other scripts that look like Latin ones.
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_ALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l",
}


class _Fold(dict):
    """Code points to their folded form, filled as they are met."""

    def __missing__(self, point: int) -> str:
        char = chr(point)
        plain = unicodedata.normalize("NFKC", char).lower() if point >= 128 else char.lower()
        plain = _ALIKE.get(plain, _DIGITS.get(plain, plain))
        self[point] = plain if plain.isalpha() else "" if unicodedata.category(char) in ("Cf", "Mn") else " "
        return self[point]


def folded(text: str | None, table: _Fold) -> str:
    """The folded text, with a blank in front."""
    return " " + (text or "").lower().translate(table)


def automaton(weights: dict[str, float]) -> ahocorasick.Automaton:
    """Entries and exceptions, all anchored at word starts. A null weight marks an exception."""
    out = ahocorasick.Automaton()
    for entry, weight in weights.items():
        out.add_word(" " + entry, (len(entry), weight))
    for phrase in EXCEPTIONS:
        if phrase not in weights:
            out.add_word(" " + phrase, (len(phrase), None))
    out.make_automaton()
    return out


def hits(text: str, lexicon: ahocorasick.Automaton) -> list[tuple[int, float]]:
    """(start, weight) of the words that count in a folded text."""
    best: dict[int, tuple[int, float | None]] = {}
    excused: list[tuple[int, int]] = []
    for end, (size, weight) in lexicon.iter(text):
        start = end - size + 1
        if weight is None:
            excused.append((start, end))
        elif start not in best or best[start][0] < size:
            best[start] = (size, weight)
    return [(s, w) for s, (_, w) in best.items() if not any(a <= s <= b for a, b in excused)]


def features(found: list[tuple[int, float]], n_words: int) -> tuple[float, float, float]:
    """Total weight, weight per hundred words (both damped), and whether there are several hits."""
    total = sum(w for _, w in found)
    return math.log1p(total), math.log1p(100 * total / (n_words + 20)), float(len(found) > 1)


@dataclass
class Lexicon:
    weights: dict[str, float]
    curve: np.ndarray  # of the features, and the constant


#: Without training: a text with two given words is toxic.
_CURVE = np.array([3.0, 0.0, 0.0, -5.0])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class that hold each beginning of a word."""
    table = _Fold()
    for b in batches:
        seen = (Counter(), Counter())
        for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            words = {w[:LONGEST] for w in folded(text, table).split()}
            seen[toxic > 0].update({w[:k] for w in words for k in range(SHORTEST, len(w) + 1)})
        keys = [*(seen[0].keys() | seen[1].keys())]
        yield pa.RecordBatch.from_pydict(
            {
                "entry": pa.array(keys, pa.string()),
                "clean": pa.array([seen[0][k] for k in keys], pa.int64()),
                "toxic": pa.array([seen[1][k] for k in keys], pa.int64()),
            }
        )


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5) -> Lexicon:
    """Learns from labelled rows whose CRC-32 of the id is no multiple of ``folds``."""
    known = pick(labels, key, label).filter(F.col(label).isNotNull() & F.col(key).isNotNull() & (bucket(F.col(key), folds) != 0))
    known = about(known, key, known.count(), FIT_ROWS)
    if known.count() <= 4 * FIT_ROWS:  # more only where many labels share an id; then Spark chooses
        known = F.broadcast(known)
    rows = pick(docs, key, text).join(known, key).select(text, F.col(label).cast("int").alias("y")).repartition(16)
    rows = rows.persist()
    sizes = {r["y"] > 0: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(False, 0), sizes.get(True, 0)
    if min(clean, toxic) < LEAST_ROWS:
        rows.unpersist()
        return Lexicon(dict.fromkeys(GIVEN, GIVEN_WEIGHT), _CURVE)
    log = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    unsure = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    learned = (
        rows.mapInArrow(lean(_counted), "entry string, clean bigint, toxic bigint")
        .groupBy("entry")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter("toxic >= 3")
        .select("entry", "clean", "toxic", log.alias("weight"), (log - 1.96 * unsure).alias("sure"))
        .filter("sure > 1.5")
        .orderBy(F.desc("sure"), "entry")
        .limit(ENTRIES)
        .collect()
    )
    longer = {(r["entry"][:-1], r["clean"], r["toxic"]) for r in learned}
    told = [r for r in learned if (r["entry"], r["clean"], r["toxic"]) not in longer]
    weights = dict.fromkeys(GIVEN, GIVEN_WEIGHT) | {r["entry"]: float(r["weight"]) for r in told}

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, table = automaton(weights), _Fold()
        for b in small(batches):
            texts = [folded(t, table) for t in b.column(0).to_pylist()]
            x = [features(hits(t, lexicon), len(t.split())) for t in texts]
            columns = [pa.array([r[i] for r in x], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, b.column(1)], names=["a", "b", "c", "y"])

    sample = rows.mapInArrow(lean(featured), "a double, b double, c double, y int").toPandas()
    rows.unpersist()
    curve = logistic(sample[["a", "b", "c"]].to_numpy(), (sample["y"] > 0).to_numpy().astype(float), 0.1)
    return Lexicon(weights, curve)


def score(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(key, toxicity, n_hits): one row per row of ``docs``; with ``carry``, those columns of it in place of the key."""
    columns = carry or [key]
    rows = pick(docs, *dict.fromkeys([*columns, text]))
    at = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, table = automaton(lexicon.weights), _Fold()
        for b in small(batches):
            found, x = [], []
            for t in b.column(at).to_pylist():
                plain = folded(t, table)
                found.append(hits(plain, entries))
                x.append(features(found[-1], len(plain.split())) if found[-1] else (0.0, 0.0, 0.0))
            z = np.hstack([np.array(x).reshape(-1, 3), np.ones((len(x), 1))]) @ lexicon.curve
            scores = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            counts = pa.array([len(f) for f in found], pa.int64())
            carried = [b.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*carried, pa.array(scores), counts], names=[*columns, "toxicity", "n_hits"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(lean(run), f"{kinds}, toxicity double, n_hits bigint")
