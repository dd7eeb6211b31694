"""Language of texts and of their parts: scripts, word scores, and Viterbi with a switching penalty.

Method. Words are runs of letters. A word's script, read from the lead bytes of its UTF-8 form, leaves
only the languages seen with that script in training. Its score for each is the log-likelihood of its
byte trigrams (hashed, with marks at both ends). Viterbi then labels the words of a text so that the scores minus
``PENALTY`` for each switch are greatest, and runs of one label are the spans.

Most texts have one language. A constant label, the best of these, is the optimum if no other language gains more
than half the penalty on any stretch of words: n stretches of others cost at least n - 1 switches, and one alone
gains nothing. This is checked with running sums first, and only other texts go through the recursion.

Learning uses about ``FIT_ROWS`` texts with a language, chosen by a hash of the id, but of each language about
``LEAST_ROWS`` if it has so many. Every language of these is kept; beyond 256 languages trigrams share buckets.

Defined results: a null text or one without a letter is ``und`` with score 0 and no spans; so is every text if nothing was learned;
words of a script that no language uses count for none; ties go to the language first by name; repeated rows give a row
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selvatrace.llm.common import bucket, pick, slabs

FIT_ROWS = 6_000
LEAST_ROWS = 50
BUCKETS_LOG2, FEWEST_LOG2 = 15, 10
#: Numbers in the table of trigrams, up to which its buckets are not halved.
TABLE_LOG2 = 23
PENALTY = 12.0
#: Most that one word can speak against a language, so that names and typos start no switch.
WORD_LIMIT = 6.0
#: Share of a language's training words that a script needs to count as used.
SCRIPT_SHARE = 0.005
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
#: ASCII letters and all bytes of longer characters stay; the rest separates words.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _script_table() -> np.ndarray:
    """Script number of each UTF-8 lead byte: 1 Latin, then Greek, Cyrillic, Armenian or Hebrew, Arabic, Indic and
    other, Han or kana, Hangul; 0 for bytes that tell nothing."""
    out = np.zeros(256, dtype=np.int8)
    ranges = ((0x61, 0x7A, 1), (0xC3, 0xCA, 1), (0xCD, 0xCF, 2), (0xD0, 0xD3, 3), (0xD4, 0xD7, 4), (0xD8, 0xDF, 5), (0xE0, 0xE1, 6), (0xE3, 0xE9, 7), (0xEA, 0xED, 8))
    for lo, hi, script in ranges:
        out[lo : hi + 1] = script
    return out


_SCRIPTS = _script_table()
N_SCRIPTS = 9


def _words(joined: bytes) -> tuple[np.ndarray, ...]:
    """Start and length of each word, and hash and word number of each of its trigrams."""
    raw = np.frombuffer(joined, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = raw != 32
    edges = np.flatnonzero(np.diff(inside))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    # The i-th trigram of a word ends one byte after its i-th byte: a blank stands at either end.
    padded = np.full(len(raw) + 2, 32, dtype=np.uint32)
    padded[1:-1] = raw
    at = np.flatnonzero(raw != 32)
    code = (padded[at] << np.uint32(16)) | (padded[at + 1] << np.uint32(8)) | padded[at + 2]
    hashed = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS_LOG2)
    firsts = np.cumsum(lengths) - lengths
    scripts = np.maximum.reduceat(_SCRIPTS[raw[at]], firsts) if len(starts) else np.zeros(0, np.int8)
    return starts, lengths, firsts, hashed, scripts


def prepared(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace").translate(_LETTERS)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # log-likelihood of each trigram bucket by language
    allowed: np.ndarray  # scripts by languages


def sampled(rows: DataFrame, key: str, lang: str) -> DataFrame:
    """About ``FIT_ROWS`` rows, by a hash of the key; of a language about ``LEAST_ROWS`` at least, or all."""
    held = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    total = sum(held.values())
    if total <= FIT_ROWS:
        return rows
    cuts = [(name, int((1 << 20) * max(FIT_ROWS / total, min(1, LEAST_ROWS / n)))) for name, n in held.items()]
    of = F.broadcast(rows.sparkSession.createDataFrame(cuts, f"`{lang}` string, cut int"))
    return rows.join(of, lang).filter(F.pmod(F.xxhash64(F.lit(7), key), F.lit(1 << 20)) < F.col("cut"))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, held_out: int = 2) -> Model:
    """Learns from texts with a language whose CRC-32 of the id is not ``held_out`` modulo ``folds``."""
    rows = pick(docs, key, text, lang).filter(
        F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull() & (bucket(F.col(key), folds) != held_out)
    )
    rows = sampled(rows, key, lang).select(text, lang)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for b in batches:
            for t, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                _, _, _, hashed, scripts = _words(prepared(t))
                held = totals.setdefault(name, np.zeros((1 << BUCKETS_LOG2) + N_SCRIPTS, dtype=np.int64))
                held[: 1 << BUCKETS_LOG2] += np.bincount(hashed, minlength=1 << BUCKETS_LOG2)
                held[1 << BUCKETS_LOG2 :] += np.bincount(scripts, minlength=N_SCRIPTS)
        for name, held in totals.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at)), "at": pa.array(at), "n": pa.array(held[at])})

    counts = rows.mapInArrow(count, "lang string, at bigint, n bigint").groupBy("lang", "at").agg(F.sum("n").alias("n")).persist()
    names = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    bits = BUCKETS_LOG2
    while bits > FEWEST_LOG2 and len(names) << bits > 1 << TABLE_LOG2:
        bits -= 1
    # Bucket numbers are the first bits of a hash; those of scripts follow the last bucket.
    place = F.when(F.col("at") < 1 << BUCKETS_LOG2, F.shiftright("at", BUCKETS_LOG2 - bits)).otherwise(
        F.col("at") - (1 << BUCKETS_LOG2) + (1 << bits)
    )
    found = counts.groupBy("lang", place.alias("at")).agg(F.sum("n").alias("n")).toPandas()
    counts.unpersist()
    number = {name: i for i, name in enumerate(names)}
    held = np.zeros((len(names), (1 << bits) + N_SCRIPTS))
    held[[number[x] for x in found["lang"]], found["at"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=float)
    grams, scripts = held[:, : 1 << bits] + 0.1, held[:, 1 << bits :]
    table = np.log(grams / grams.sum(axis=1, keepdims=True)).T.astype(np.float32)
    shares = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(names, np.ascontiguousarray(table), (shares >= SCRIPT_SHARE).T)


def word_scores(model: Model, firsts: np.ndarray, hashed: np.ndarray, scripts: np.ndarray) -> np.ndarray:
    """Words by languages: at most 0, the best language of a word at 0."""
    if not len(firsts):
        return np.zeros((0, len(model.languages)), dtype=np.float32)
    shift = np.uint32((1 << BUCKETS_LOG2).bit_length() - len(model.table).bit_length())
    scores = np.add.reduceat(model.table[hashed >> shift], firsts, axis=0)
    allowed = model.allowed[scripts]
    none = ~allowed.any(axis=1)
    scores[~allowed] = -np.inf
    scores[none] = 0
    scores -= scores.max(axis=1, keepdims=True)
    return np.maximum(scores, -WORD_LIMIT)


def constant(scores: np.ndarray, penalty: float = PENALTY) -> int:
    """The best constant label if it is sure to be the optimum, else -1."""
    best = int(scores.sum(axis=0, dtype=np.float64).argmax())
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64)
    low = np.minimum(np.minimum.accumulate(gain, axis=0), 0)
    stretch = gain[0].max(initial=0) if len(gain) == 1 else max(gain[0].max(), (gain[1:] - low[:-1]).max())
    return best if 2 * stretch <= penalty else -1


def viterbi(texts: list[np.ndarray], penalty: float = PENALTY) -> list[np.ndarray]:
    """For the word scores of each text, the labels with the greatest sum minus ``penalty`` for each switch.

    All texts advance word by word together, the longest first, so that each step is one array operation.
    """
    if not texts:
        return []
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate([texts[i] for i in order])
    offsets = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
    running = np.searchsorted(-lengths[order], -np.arange(lengths.max()), side="left")  # texts longer than t
    stay = np.arange(flat.shape[1], dtype=np.int16 if flat.shape[1] < 1 << 15 else np.int32)
    back = np.empty(flat.shape, dtype=stay.dtype)
    value = flat[offsets].astype(np.float64)
    for t in range(1, len(running)):
        n = running[t]
        at, now = offsets[:n] + t, value[:n]
        top = now.argmax(axis=1)
        floor = now.max(axis=1) - penalty
        move = now < floor[:, None]
        back[at] = np.where(move, top[:, None], stay)
        value[:n] = np.where(move, floor[:, None], now) + flat[at]
    label = value.argmax(axis=1)
    out = np.empty(len(flat), dtype=np.int64)
    for t in range(len(running) - 1, -1, -1):
        n = running[t]
        at = offsets[:n] + t
        out[at] = label[:n]
        if t:
            label[:n] = back[at, label[:n]]
    paths: list[np.ndarray] = [out] * len(texts)
    for place, i in enumerate(order):
        paths[i] = out[offsets[place] : offsets[place] + lengths[i]]
    return paths


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, spans): one row per row of ``docs``. A text that begins and ends in one
    language is of that language, whatever it quotes; else the language of most letters counts. ``score``: the share of
    the text's letters in the spans of that language; ``spans``: (lang, from word, to word), the end exclusive."""
    rows = pick(docs, key, text)
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    most = max(1 << 16, (1 << 22) // max(len(model.languages), 4))
    # Plain arrays: a broadcast is read where this package need not be installed.
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.table, model.allowed))

    def judged(path: np.ndarray, lengths: np.ndarray, names: list[str]) -> tuple[str, float, list[dict]]:
        cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
        spans = [{"lang": names[path[a]], "start": a, "end": z} for a, z in zip(cuts, cuts[1:], strict=False)]
        held = np.bincount(path, weights=lengths, minlength=len(names))
        best = int(path[0]) if path[0] == path[-1] else int(held.argmax())
        return names[best], float(held[best] / held.sum()), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = Model(*sent.value)
        names = learned.languages
        for b in batches:
            raw = b.column(1).to_pylist()
            told: list[tuple[str, float, list[dict]]] = [(UNKNOWN, 0.0, [])] * len(raw)
            texts = [prepared(t) for t in raw]
            open_texts: list[tuple[int, np.ndarray, np.ndarray]] = []
            for lo, hi in slabs(texts, most):
                starts, lengths, firsts, hashed, scripts = _words(b" ".join(texts[lo:hi]))
                scores = word_scores(learned, firsts, hashed, scripts) if names else np.zeros((0, 0))
                ends_of = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
                cut = np.searchsorted(starts, ends_of)
                for i, (a, z) in enumerate(zip([0, *cut[:-1].tolist()], cut.tolist(), strict=True), lo):
                    if not names or not _LETTER.search(raw[i] or ""):
                        continue
                    if (label := constant(scores[a:z])) >= 0:
                        told[i] = (names[label], 1.0, [{"lang": names[label], "start": 0, "end": z - a}])
                    else:
                        open_texts.append((i, scores[a:z].copy(), lengths[a:z]))
            for (i, _, lengths), path in zip(open_texts, viterbi([s for _, s, _ in open_texts]), strict=True):
                told[i] = judged(path, lengths, names)
            columns = zip(*told, strict=True) if told else [[], [], []]
            kinds = (pa.string(), pa.float64(), span_type)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]],
                names=[key, "lang_pred", "score", "spans"],
            )

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double, spans array<struct<lang:string,start:int,end:int>>")
