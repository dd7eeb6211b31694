"""Mixing against plain arithmetic, divergence against its formula, conversation repair against all edits; and their edges."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import groupby

import duckdb
import pytest
from pyspark.sql import functions as F

from selvatrace.llm import conversations, divergence, mixing, queries, sql

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Targets by resharing what is over, in fractions. ``sizes``: of each source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        want = {s: Fraction(left * weight[s], sum(weight[x] for x in free)) for s in free}
        over = [s for s in free if want[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **want}
        fixed |= {s: Fraction(3 * sizes[s]) for s in over}


MIX = "doc_id bigint, text string, source string, size int, id string"


def mix_rows(rng, n):
    names = ["src1", "src10", "src2", "\U0001f600", "", None, "Z", "tiny"]
    rows = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice((0, 1, 5, 40, 300)))), rng.choice(names[:7])) for i in range(n)]
    rows += [(n, None, "src2"), (n + 1, " \n", "void"), (n + 2, "one two", "tiny"), (None, "no id here", "src1"), (5, rows[5][1], rows[5][2])]
    return [(*r, 7, "x") for r in rows]


@pytest.mark.parametrize("chunk", [10**6, 20])
def test_mix_against_plain_arithmetic(spark, chunk):
    rows = mix_rows(random.Random(1), 400)
    df = spark.createDataFrame(rows, MIX).repartition(5)
    got = mixing.mix(df, rows_per_chunk=chunk).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes, taken, docs = Counter(), Counter(), {}
    for i, text, source, *_ in rows:
        docs[i] = len(WORD.findall(text or ""))
        sizes[source] += docs[i]
    want = plain_targets(sizes)
    for r in got:
        assert r.size == docs[r.doc_id] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(want[r.source])) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        whole = int(want[r.source] // sizes[r.source]) if sizes[r.source] else 0
        assert whole * r.size <= r.taken <= (whole + 1) * r.size
    assert all(taken[s] == int(want[s]) for s in sizes)
    # All but one document of a source are taken whole a number of times.
    cut = Counter(r.source for r in got if r.size and r.taken % r.size)
    assert max(cut.values(), default=0) <= 1
    again = mixing.mix(df.repartition(3), rows_per_chunk=chunk).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_prefers_weights(spark):
    """Of equally long documents of one source, heavier ones are drawn first about as often as their weight says."""
    rows = [(i, "a b c d", "s" if i < 4000 else "t", 0, "x") for i in range(6000)]
    heavy = F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0)
    got = mixing.mix(spark.createDataFrame(rows, MIX), weight=heavy).filter("source = 's' AND epochs = 1").collect()
    # Half of the words are drawn; the share of heavy ones among them is 1 - y ** 3, where y + y ** 3 = 1.
    assert len(got) == 2000 and 0.65 < sum(r.doc_id % 2 == 0 for r in got) / len(got) < 0.715
    light = spark.createDataFrame([("plain words only",), ("12 34 <<>> 99",), ("",), (None,)], "t string")
    assert [r[0] for r in light.select(mixing.quality_weight(F.col("t"))).collect()] == [1.0, 0.05, 0.05, 0.05]


def test_copies_have_the_words_taken(spark):
    rows = [r for r in mix_rows(random.Random(2), 60) if r[0] is not None][:-1]
    df = spark.createDataFrame(rows, MIX)
    mixed = mixing.mix(df)
    words = Counter()
    for r in mixing.copies(df, mixed).collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == Counter({r.doc_id: r.taken for r in mixed.collect() if r.taken})


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], MIX)
    assert mixing.mix(empty).count() == 0
    blank = mixing.mix(spark.createDataFrame([(1, "", "s", 0, ""), (2, None, None, 0, "")], MIX)).collect()
    assert {(r.size, r.target, r.taken, r.epochs) for r in blank} == {(0, 0.0, 0, 0)}


def plain_audit(rows):
    """Every row of the audit by its formula. ``rows``: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    found = [re.findall(r"[a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t)) for t, _, _ in rows]
    held, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for words, (_, lang, source) in zip(found, rows, strict=True):
        held[lang].update(set(words))
        n[lang, source].update(words)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = {t for t, k in held[lang].items() if k >= 3}
        whole = Counter()
        for s in sources:
            whole.update(n[lang, s])

        def share(c):
            total = sum(c[t] for t in kept) + len(kept)  # noqa: B023
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}  # noqa: B023

        p, q = {s: share(n[lang, s]) for s in sources}, share(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources - {s}]
            term = [(-f(p[s][t], q[t]), t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, values in (("pair", pair), ("term", term)):
                ranked = enumerate(sorted(values, key=lambda x: (x[0], x[1].encode())), 1)
                out |= {(lang, s, part, item, -v, rank) for rank, (v, item) in ranked if part == "pair" or rank <= 200}
    return out


def audit_rows(rng):
    langs, sources = ["en", "de", None], ["a", "b", "\U0001f600", "￿", None]
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)] + ["Été", "漢字", "İ", "Ǆ", "x" * 5000]
    rows = [(" ".join(rng.choices(words, k=rng.choice((0, 1, 30, 200)))) + rng.choice(("", "1 2", "!A-B")), rng.choice(langs), rng.choice(sources)) for _ in range(150)]
    return rows + [(None, "en", "silent"), ("only here twice", "fr", "a"), ("only here twice", "fr", "b"), ("", None, "c"), rows[3], rows[3]]


@pytest.mark.parametrize("block, held", [(divergence.BLOCK, divergence.HELD), (7, 3)])
def test_audit_against_its_formula(spark, monkeypatch, block, held):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "GATHERED", held * 10)
    rows = audit_rows(random.Random(4))
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "text string, lang string, source string, term int, no string").repartition(4)
    got = [tuple(r) for r in divergence.audit(df).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(rows)
    assert divergence.audit(df.limit(0)).count() == 0


def test_shares_are_exact():
    rng = random.Random(5)
    for total in (1, 7, 10**9, 9 * 10**15 - 1):
        counts = [0, total - 1, *[rng.randrange(total) for _ in range(50)]]
        assert divergence.shares(counts, total).tolist() == [1 + 10**9 * (c + 1) // total for c in counts]


# Conversations


def plain_repair(rows):
    """The cheapest and then least edits, over all of them. ``rows``: (turn, role, text) in order."""
    seen, faults, counts = set(), [], Counter()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        faults.append(fault)
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    state = {"": (0, "", ())}

    def inserted(state):
        for _ in range(3):
            for s, (cost, audit, lines) in list(state.items()):
                role = "assistant" if s == "u" else "user"
                new = cost + 5, audit + "I", (*lines, f"{role}:")
                state[role[0]] = min(state.get(role[0], new), new)
        return state

    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for s, (cost, audit, lines) in inserted(state).items():
            options = [(s, 2, "D", ())]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] in step[s]:
                    options.append((role[0], more, "K", (f"{role}:{text}",)))
                given = "assistant" if s == "u" else "user"
                options.append((given[0], 1 + more, "R", (f"{given}:{text}",)))
            for to, c, letter, line in options:
                new = cost + c, audit + letter, lines + line
                after[to] = min(after.get(to, new), new)
        state = after
    cost, audit, lines = min(v for s, v in inserted(state).items() if s in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha), lines


CONVERSATION = "conv_id bigint, turn bigint, role string, text string, key string, side int"


def turn_rows(rng):
    rows = []
    for conv in [None, *range(60)]:
        kind = rng.randrange(4)
        for turn in range(rng.choice((1, 2, 5, 9, 14))):
            role = rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None)) if kind else ("user", "assistant")[turn % 2]
            text = rng.choice(("Yes.", "No!", "cut off", "", " \n", None, "a? ", f"t{turn}.", f"Long {'word ' * 300}end"))
            for _ in range(rng.choice((1, 1, 1, 3))):
                rows.append((conv, None if rng.random() < 0.1 else turn + rng.choice((0, 0, 3)), role, text))
    return rows + [(100, t, "system", "s.") for t in range(70)] + [(101, t, "user", f"{t}.") for t in range(33)] + [(102, 1, "user", "same.")] * 50


def in_order(rows):
    rows = [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
    return {k: [r[1:] for r in g] for k, g in groupby(rows, key=lambda r: r[0])}


@pytest.mark.parametrize("rows_per_piece", [conversations.ROWS_PER_PIECE, 6])
def test_repair_against_all_edits(spark, rows_per_piece):
    rows = turn_rows(random.Random(6))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], CONVERSATION).repartition(3)
    want = {k: plain_repair(v) for k, v in in_order(rows).items()}
    got = {r[0]: tuple(r)[1:] for r in conversations.summary(df, rows_per_piece=rows_per_piece).collect()}
    assert got == {k: v[0] for k, v in want.items()}
    lines = defaultdict(list)
    for r in sorted(conversations.repair(df, rows_per_piece=rows_per_piece).collect(), key=lambda r: r.place):
        lines[r.conv_id].append(r)
    assert {k: "".join(r.edit for r in v) for k, v in lines.items()} == {k: v[0][6] for k, v in want.items()}
    assert all(tuple(f"{r.role}:{r.text}" for r in v if r.edit != "D") == want[k][1] for k, v in lines.items())


@pytest.mark.parametrize("n", [1, 2, 31, 1000])
def test_powers_equal_single_steps(n):
    powers = conversations.Powers()
    for code in range(12):
        to_come = conversations.LAST
        for _ in range(n):
            to_come = conversations.onto(powers.power(code, 0), to_come)
        assert powers.before(code, n, conversations.LAST) == to_come
        assert powers.cost([(code, n)], conversations.LAST) == conversations.onto(powers.matrix([(code, n)]), conversations.LAST)


def test_lost_and_empty_conversations(spark):
    rows = [(1, 0, "user", "a.", 0), (1, 1, "assistant", "b.", 0), (2, 0, "user", "q.", 2), (2, 1, "assistant", "r.", 1), (None, None, None, None, 1)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, n int")
    got = {r[0]: tuple(r)[1:] for r in conversations.summary(df, n="n").collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got[1] == (0, 0, 0, 0, 0, 0, "", nothing) and got[None] == (0, 1, 0, 0, 0, 2, "D", nothing)
    assert got[2][:7] == (0, 0, 1, 0, 1, 2, "KDK")
    assert conversations.summary(df.limit(0), n="n").count() == 0 and conversations.repair(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op12_divergence_audit", "op13_conversation_repair"])
def test_expected_sql_with_nulls(spark, tmp_path, name):
    """The registered queries and their SQL agree on rows that the stored tables lack."""
    spark.createDataFrame(turn_rows(random.Random(8)), "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame(audit_rows(random.Random(9)), "text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for t in ("conversations", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(sql.oracle_sql()[name]).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in queries.queries()[name](spark, str(tmp_path)).collect())
