"""How far each source's use of terms lies from that of the other sources of its language, in exact arithmetic.

Method (Gustavson's row accumulation). A term-major index holds one row per kept term: the groups (a group is a source of
a language) that use it, and how often. Each task goes through its rows of the index group by group: the group's terms
lead to their index rows, and these scatter what they change into one dense vector over the group's peers. No pair of
postings is ever a row; a task hands on its vectors only, and their sums are the result.

An index row holds only groups that use the term. So the vectors first assume that nobody else uses it, and are then
corrected. With p and p0 the group's share of a used and of an unused term, q and q0 a peer's:

    sum of f(p, q) over all kept terms = V f(p0, q0) + sum over the group's terms of f(p, q0) - f(p0, q0)
                                       + sum over the peer's terms of f(p0, q) - f(p0, q0)
                                       + sum over common terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

The first line needs no index row, only how many terms share a count; the last is what the scatter adds up.

Bounds. The driver and the tasks see one number per group and one per language. The result has a row for every pair of
groups of a language, so groups are few by what is asked for. Vectors that reach ``HELD`` numbers are handed on early.

Defined results: null text, lang and source read as ''; a group without a term takes part with shares of unused terms
only; a language without kept terms has divergence 0; texts of any length count whole; repeated rows count each; an empty
table gives no rows; other columns are ignored. Numbers stay exact up to 9e15 occurrences in a language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from selvatrace.llm.common import pick, written
from selvatrace.plans.ordered import first_rows

LEAST_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Counts that a task gathers before it hands them on, and numbers in its vectors.
GATHERED, HELD = 300_000, 1 << 22
#: Pairs of numbers compared in one numpy pass.
BLOCK = 1 << 19

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of letters of A-Z, as a-z, and of all characters beyond ASCII."""
    return text.translate(_LETTERS).split()


def shares(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), by long division in steps that fit 64 bits."""
    out, rest = np.divmod(np.asarray(count, dtype=np.int64) + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q) ** 2 / q)."""
    d = p - q
    return d * d // q


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df): occurrences of each term in each group, and documents that hold it; summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, held) in counts.items():
                words = pa.array(list(n), pa.binary()).cast(pa.string())
                columns = [pa.repeat(pa.scalar(x, pa.string()), len(n)) for x in (lang, source)]
                numbers = [pa.array(x, pa.int64()) for x in (list(n.values()), [held[w] for w in n])]
                yield pa.RecordBatch.from_arrays([*columns, words, *numbers], names=["lang", "source", "term", "n", "df"])
            counts.clear()

        for b in batches:
            texts = b.column(2).cast(pa.binary())
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts, strict=True):
                n, held = counts.setdefault((lang, source), (Counter(), Counter()))
                words = terms(text.as_py())
                n.update(words)
                held.update(set(words))
            if sum(len(n) for n, _ in counts.values()) > GATHERED:
                yield from told()
        yield from told()

    rows = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n bigint, df bigint")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def term_index(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, term, total, uses): one row per kept term; ``uses`` holds (no, n) for each group that has it, by number."""
    uses = F.sort_array(F.collect_list(F.struct("no", "n")))
    named = counted(docs).join(groups.select("lang", "source", "no"), ["lang", "source"])
    kept = named.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("df").alias("held"), uses.alias("uses"))
    return kept.filter(F.col("held") >= LEAST_DOCUMENTS).drop("held")


def partial_sums(index: DataFrame, facts: dict[str, tuple[int, np.ndarray]]) -> DataFrame:
    """(lang, no, peer, value): what the index rows of each task add to V f(p0, q0). ``facts``: per language V and the
    occurrences of kept terms in each of its groups."""
    sent = index.sparkSession.sparkContext.broadcast(facts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Vectors over the peers of a group, and over the groups that a peer is compared with.
        own: dict[tuple[str, int], np.ndarray] = {}
        others: dict[tuple[str, int], np.ndarray] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for vectors, names in ((own, ("no", "peer")), (others, ("peer", "no"))):
                for (lang, one), v in vectors.items():
                    at = np.flatnonzero(v)
                    columns = {"lang": pa.repeat(pa.scalar(lang, pa.string()), len(at)), names[0]: pa.array(np.full(len(at), one, np.int32)),
                               names[1]: pa.array(at.astype(np.int32)), "value": pa.array(v[at])}
                    yield pa.RecordBatch.from_arrays([columns[c] for c in ("lang", "no", "peer", "value")], names=["lang", "no", "peer", "value"])
                vectors.clear()

        def add(lang: str, starts: np.ndarray, no: np.ndarray, n: np.ndarray) -> None:
            v, sums = sent.value[lang]
            size = sums + v
            p0 = shares(np.zeros(len(size)), size)
            p = shares(n, size[no])
            vector = lambda kind, g: kind.setdefault((lang, int(g)), np.zeros(len(size), dtype=np.int64))
            # Used by one side: equal counts of a group have equal shares, so each is worked out once.
            pairs, times = np.unique(np.stack([no, p]), axis=1, return_counts=True)
            step = max(1, BLOCK // len(size))
            for i in range(0, len(times), step):
                g, used, m = pairs[0, i : i + step], pairs[1, i : i + step, None], times[i : i + step, None]
                first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
                unused = p0[g][:, None]
                here = np.add.reduceat(m * (apart(used, p0) - apart(unused, p0)), first)
                there = np.add.reduceat(m * (apart(p0, used) - apart(p0, unused)), first)
                for k, at in enumerate(first):
                    vector(own, g[at])[:] += here[k]
                    vector(others, g[at])[:] += there[k]
            # Used by both: the group's terms, their index rows, and what these change for each peer.
            lengths = np.diff(starts)
            term = np.repeat(np.arange(len(lengths)), lengths)
            order = np.argsort(no, kind="stable")
            cuts = np.flatnonzero(np.r_[True, no[order][1:] != no[order][:-1]]) if len(no) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(no)], strict=True):
                g, mine = int(no[order[lo]]), order[lo:hi]
                row, reach = vector(own, g), np.cumsum(lengths[term[mine]])
                while len(mine):
                    take = max(1, int(np.searchsorted(reach, BLOCK, side="right")))
                    part, mine, reach = mine[:take], mine[take:], reach[take:] - reach[take - 1]
                    fan = lengths[term[part]]
                    at = np.repeat(starts[term[part]] - np.cumsum(fan) + fan, fan) + np.arange(fan.sum())
                    peer, q, p_own = no[at], p[at], np.repeat(p[part], fan)
                    change = apart(p_own, q) - apart(p_own, p0[peer]) - apart(p0[g], q) + apart(p0[g], p0[peer])
                    np.add.at(row, peer, change)

        for b in batches:
            langs = b.column(0).dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                uses = b.column(1).filter(pa.array(langs.indices.to_numpy(zero_copy_only=False) == k))
                flat = uses.flatten()
                starts = np.r_[0, np.cumsum(uses.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
                add(lang, starts, flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy())
            if sum(len(v) for kind in (own, others) for v in kind.values()) > HELD:
                yield from told()
        yield from told()

    return index.select("lang", "uses").mapInArrow(run, "lang string, no int, peer int, value bigint")


def unused_sums(groups: DataFrame, facts: dict[str, tuple[int, np.ndarray]]) -> DataFrame:
    """(lang, no, peer, value): V f(p0, q0) of each group and each other of its language."""
    sent = groups.sparkSession.sparkContext.broadcast(facts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, no in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                v, sums = sent.value[lang]
                p0 = shares(np.zeros(len(sums)), np.maximum(sums + v, 1))
                peers = np.delete(np.arange(len(sums), dtype=np.int32), no)
                columns = [pa.repeat(pa.scalar(lang, pa.string()), len(peers)), pa.array(np.full(len(peers), no, np.int32)),
                           pa.array(peers), pa.array(v * apart(p0[no], p0)[peers])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "no", "peer", "value"])

    return groups.select("lang", "no").mapInArrow(run, "lang string, no int, peer int, value bigint")


def _share(n: str, total: Column) -> Column:
    whole = F.expr(f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 1 AS DECIMAL(20,0))")
    return F.call_function("div", whole, total.cast("decimal(20,0)")) + 1


def _ranked(rows: DataFrame) -> DataFrame:
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(by))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank). ``pair``: the divergence of each source from each other source of its
    language; ``term``: the terms that a source uses more than its language does, by what they add, the first 200."""
    blank = F.lit("")
    docs = pick(docs, text, lang, source).toDF("text", "lang", "source").select(*[F.coalesce(c, blank).alias(c) for c in ("text", "lang", "source")])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = written(docs.select("lang", "source").distinct().withColumn("no", number), "divergence-groups")
    index = written(term_index(docs, groups), "divergence-index")
    sizes = index.select("lang", F.explode("uses").alias("u")).groupBy("lang", "u.no").agg(F.sum("u.n").alias("used"))
    kept = index.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all_used"))
    known = groups.join(sizes, ["lang", "no"], "left").join(kept, "lang", "left").fillna(0, ["used", "v", "all_used"])
    known = written(known, "divergence-sizes")
    facts: dict[str, tuple[int, np.ndarray]] = {}
    numbers = known.select("lang", "no", "used", "v").toPandas().sort_values("no")
    for name, rows in numbers.groupby("lang"):
        facts[name] = int(rows["v"].iloc[0]), rows["used"].to_numpy(dtype=np.int64)

    sums = unused_sums(groups, facts).union(partial_sums(index, facts)).groupBy("lang", "no", "peer")
    pairs = sums.agg(F.sum(F.col("value").cast("decimal(20,0)")).cast("bigint").alias("value")).filter("no <> peer")
    names = known.select("lang", "no", "source")
    peers = names.select("lang", F.col("no").alias("peer"), F.col("source").alias("item"))
    pair = _ranked(pairs.join(names, ["lang", "no"]).join(peers, ["lang", "peer"]).select("lang", "source", "item", "value"))

    uses = index.select("lang", "term", "total", F.explode("uses").alias("u")).select("lang", "term", "total", "u.no", "u.n")
    p, q = _share("n", F.col("used") + F.col("v")), _share("total", F.col("all_used") + F.col("v"))
    above = uses.join(known, ["lang", "no"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    above = above.select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    term = _ranked(first_rows(above, ["lang", "source"], [F.desc("value"), F.col("item")], TOP_TERMS))
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pair.withColumn("part", F.lit("pair")).select(*columns).union(term.withColumn("part", F.lit("term")).select(*columns))
