"""Repair of conversations whose turns were lost, emptied, cut off, repeated or given to the wrong role.

A repaired conversation's role initials read ``(s?(ua)+)?``: perhaps a system turn, then user and assistant in turn, or nothing.
Keeping a row costs 0, giving it to user or assistant 1, deleting it 2, inserting an empty turn 5; blank rows and
repetitions must go, and a row that stays though it is cut off costs 5 more. The cheapest edits are found; among equally
cheap ones those whose initials (D, I, K, R) come first as ASCII text.

Method (run-length dynamic program). A row is a symbol: its role and its fault. Equal symbols in a row are one run. A
symbol is a 4 by 4 matrix of least costs between the states of the pattern above (nothing yet, after s, after u, after a),
and edits of several rows are the matrices' min-plus product. A run of n rows is crossed by the powers of its matrix that n's
binary digits name, each computed once in a task. From the costs still to come at the ends of runs the choices are then
unrolled, run by run, by the first letter that keeps the cost least: a letter leads to one state only, so this is the
least text of all.

Long conversations. Rows are reduced to symbols and counts before anything is sorted, equal rows to one. A conversation
of more than ``ROWS_PER_PIECE`` rows is cut into pieces (``plans.ordered``): each becomes one matrix, the few matrices of a
conversation give every piece its costs to come, each piece then tells which state it leads to from which, and all pieces
are unrolled at once. Its repaired text streams through one task in order, as a hash over it cannot be split; never more
than its edits, a byte per row, is held there.

Defined results: a null role or text is one space; a null key is a conversation of its own; rows are ordered by turn,
nulls first, then role and the text's SHA-256; a row with ``n`` = 0 is no row, but its conversation comes out, empty;
texts of any length are whole; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selvatrace.llm.common import pick, written
from selvatrace.plans.ordered import join_on, split_busy_keys

ROWS_PER_PIECE = 100_000
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
FINE, TRUNCATED, GONE = range(3)
ROLES = "sua?"
NEXT_ROLE = ("user", "user", "assistant", "user")  # what may be inserted or given in each state
SPACE = " \t\n\x0b\x0c\r"

Matrix = tuple[tuple[float, ...], ...]
_FAR = float("inf")
_STATES = range(4)
#: Where a role leads from each state; None: it may not stand there.
_STEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "?": (None,) * 4}
_GIVEN = tuple(_STEP[r[0]][s] for s, r in enumerate(NEXT_ROLE))
#: A conversation may end before anything or after an assistant.
END = (0.0, _FAR, _FAR, 0.0)


def edits(code: int, state: int) -> list[tuple[str, int, float]]:
    """(letter, next state, cost) of what can be done with a row of this symbol, least letter first."""
    role, fault = ROLES[code // 3], code % 3
    out: list[tuple[str, int, float]] = [("D", state, DELETE)]
    if fault != GONE:
        more = CUT_OFF if fault == TRUNCATED else 0
        if (kept := _STEP[role][state]) is not None:
            out.append(("K", kept, KEEP + more))
        out.append(("R", _GIVEN[state], REROLE + more))
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in _STATES) for j in _STATES) for i in _STATES)


def onto(a: Matrix, to_come: tuple[float, ...]) -> tuple[float, ...]:
    return tuple(min(a[i][k] + to_come[k] for k in _STATES) for i in _STATES)


_ONE: Matrix = tuple(tuple(0.0 if i == j else _FAR for j in _STATES) for i in _STATES)
_INSERT: Matrix = tuple(tuple(0.0 if i == j else INSERT if _GIVEN[i] == j else _FAR for j in _STATES) for i in _STATES)
#: Any number of insertions; more than two in a row only lead back.
_INSERTS = times(_INSERT, _INSERT)


class Powers:
    """The binary powers of the symbols' matrices, each computed once."""

    def __init__(self) -> None:
        self.held: dict[int, list[Matrix]] = {}

    def power(self, code: int, k: int) -> Matrix:
        """Least costs over 2 ** k rows of the symbol, with insertions before each."""
        known = self.held.setdefault(code, [])
        if not known:
            row = [[_FAR] * 4 for _ in _STATES]
            for i in _STATES:
                for _, j, cost in edits(code, i):
                    row[i][j] = min(row[i][j], cost)
            known.append(times(_INSERTS, tuple(map(tuple, row))))
        while len(known) <= k:
            known.append(times(known[-1], known[-1]))
        return known[k]

    def before(self, code: int, n: int, to_come: tuple[float, ...]) -> tuple[float, ...]:
        """Costs to come before a run of ``n`` rows, from those after it."""
        for k in range(n.bit_length()):
            if n >> k & 1:
                to_come = onto(self.power(code, k), to_come)
        return to_come

    def cost(self, runs: list[tuple[int, int]], to_come: tuple[float, ...]) -> tuple[float, ...]:
        """Costs to come before the runs, from those after them."""
        for code, n in reversed(runs):
            to_come = self.before(code, n, to_come)
        return to_come

    def matrix(self, runs: list[tuple[int, int]]) -> Matrix:
        out = _ONE
        for code, n in runs:
            for k in range(n.bit_length()):
                if n >> k & 1:
                    out = times(out, self.power(code, k))
        return out

    def unroll(self, runs: list[tuple[int, int]], state: int, to_come: tuple[float, ...]) -> tuple[str, int]:
        """The least edits over ``runs`` from ``state``, and the state they lead to. Insertions stand before a row."""
        ends = [to_come]
        for code, n in reversed(runs):
            ends.append(self.before(code, n, ends[-1]))
        out: list[str] = []
        for (code, n), after in zip(runs, reversed(ends[:-1]), strict=True):
            state = self._run(code, n, state, after, out)
        return "".join(out), state

    def _run(self, code: int, n: int, state: int, after: tuple[float, ...], out: list[str]) -> int:
        """Unrolls one run: a stretch of rows with the costs after it, halved until it is a row."""
        stretches = [(n, after)]
        while stretches:
            n, after = stretches.pop()
            if n > 1:
                k = (n - 1).bit_length() - 1
                stretches += [(1 << k, after), (n - (1 << k), onto(self.power(code, k), after))]
                continue
            least = onto(self.power(code, 0), after)[state]
            while True:
                found = [(x, s) for x, s, cost in edits(code, state) if cost + after[s] == least]
                letter, to = min([*found, *self._inserted(code, state, after, least)])
                out.append(letter)
                state = to
                if letter != "I":
                    break
                least -= INSERT
        return state

    def _inserted(self, code: int, state: int, after: tuple[float, ...], least: float) -> list[tuple[str, int]]:
        to = _GIVEN[state]
        return [("I", to)] if INSERT + onto(self.power(code, 0), after)[to] == least else []


def closing(state: int) -> str:
    """Insertions after the last row."""
    return {0: "", 1: "II", 2: "I", 3: ""}[state]


#: Costs to come after the last row.
LAST = onto(_INSERTS, END)


def collapsed(codes: list[int], counts: list[int]) -> list[tuple[int, int]]:
    """Runs of equal symbols; what must go is one symbol whatever its role."""
    steps = [(9 + GONE if c % 3 == GONE else c, n) for c, n in zip(codes, counts, strict=True)]
    return [(c, sum(n for _, n in same)) for c, same in groupby((s for s in steps if s[1]), key=lambda x: x[0])]


def prepared(turns: DataFrame, key: str, turn: str, role: str, text: str, n: str | None) -> DataFrame:
    """(key, turn, role, digest, text, n): roles and texts without nulls."""
    names = [key, turn, role, text, *([n] if n else [])]
    rows = pick(turns, *names).toDF(*["key", "turn", "role", "text", "n"][: len(names)])
    space = F.lit(" ")
    rows = rows.select(
        "key", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.col("n") if n else F.lit(1)).cast("bigint").alias("n"),
    )
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def marked(turns: DataFrame) -> DataFrame:
    """One row for each distinct (key, turn, role, text), without the text: its digest, initial, how many there are (n)
    and whether it is blank, cut off, or the first of its role and text."""
    bare = F.rtrim("text", F.lit(SPACE))
    # What a search for the last character that is not white space finds.
    cut = ~F.substring(bare, -1, 1).isin(".", "!", "?")
    rows = turns.select(
        "key", "turn", "role", "digest", (bare == "").alias("blank"), cut.alias("cut"), "n"
    )
    rows = rows.groupBy("key", "turn", "role", "digest", "blank", "cut").agg(F.sum("n").alias("n"))
    real = F.col("n") > 0
    at = F.when(real, F.struct(F.col("turn").isNotNull().alias("known"), "turn"))
    firsts = rows.groupBy("key", "role", "digest").agg(F.min(at).alias("at"))
    held = join_on(rows, firsts, ["key", "role", "digest"])
    first = (F.col("at.turn").eqNullSafe(F.col("turn")) & ~F.col("blank")).alias("first")
    return held.select("key", "turn", "role", "digest", "blank", "cut", "n", first)


def counted(rows: DataFrame) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated) of each key of ``marked``."""
    n, real = F.col("n"), F.col("n") > 0
    turn = F.when(real, F.col("turn"))
    once = (F.col("first") & real).cast("bigint")
    spread = F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn)
    return rows.groupBy("key").agg(
        F.coalesce(spread, F.lit(0)).cast("bigint").alias("gaps"),
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(n - once)).alias("duplicate"),
        F.sum(F.when(F.col("cut"), once).otherwise(0)).alias("truncated"),
    )


def pieces(rows: DataFrame, rows_per_piece: int) -> DataFrame:
    """(key, piece, codes, counts): the symbols of each key in order; ``piece`` is null where a key is not cut."""
    initial = F.substring("role", 1, 1)
    base = F.lit(3 * len(ROLES) - 3)
    for i, r in enumerate(ROLES[:-1]):
        base = F.when(initial == r, 3 * i).otherwise(base)
    own = base + F.when(F.col("first"), F.when(F.col("cut"), TRUNCATED).otherwise(FINE)).otherwise(GONE)
    coded = rows.select("key", "turn", "role", "digest", own.alias("own"), (base + GONE).alias("again"), "n")
    cut, by = split_busy_keys(coded, ["key"], ["turn", "role", "digest"], rows_per_piece)
    if by == ["key"]:
        cut = cut.withColumn("_chunk", F.lit(None).cast("int"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "digest", "own", "again", "n")
    steps = F.sort_array(F.collect_list(F.when(F.col("n") > 0, at)))
    # A row, and its repetitions.
    twice = lambda one, rest: F.flatten(F.transform("steps", lambda s: F.array(one(s), rest(s))))
    return cut.groupBy("key", F.col("_chunk").alias("piece")).agg(steps.alias("steps")).select(
        "key", "piece", twice(lambda s: s["own"], lambda s: s["again"]).alias("codes"),
        twice(lambda s: F.lit(1).cast("bigint"), lambda s: s["n"] - 1).alias("counts"),
    )


_LEGAL = {(0, 1), (1, 2), (2, 1)}


def broken(codes: list[int], counts: list[int]) -> tuple[int, int | None, int | None]:
    """Neighbours that may not follow each other, and the first and last role."""
    steps = [(c // 3, n) for c, n in zip(codes, counts, strict=True) if n > 0]
    wrong = sum(n - 1 for _, n in steps) + sum((a[0], b[0]) not in _LEGAL for a, b in zip(steps, steps[1:], strict=False))
    return wrong, steps[0][0] if steps else None, steps[-1][0] if steps else None


_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(),
          "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32())}


def _fields(kinds: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in kinds.items())


def _each_row(df: DataFrame, how: Callable[..., dict], kinds: dict[str, str]) -> DataFrame:
    """``key`` and the fields of ``kinds`` that ``how`` makes of a row's other columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for b in batches:
            rows = zip(*[c.to_pylist() for c in b.columns[1:]], strict=True)
            made = [how(powers, **dict(zip(b.schema.names[1:], r, strict=True))) for r in rows]
            columns = [pa.array([m[name] for m in made], _TYPES[kind]) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["key", *kinds])

    return df.mapInArrow(run, f"key {df.schema['key'].dataType.simpleString()}, {_fields(kinds)}")


def _each_key(df: DataFrame, how: Callable[[list[dict]], list[dict]], kinds: dict[str, str]) -> DataFrame:
    """The same for all rows of a key at once, in the order of their pieces; there is one row per piece."""

    def run(table: pa.Table) -> pa.Table:
        made = how(sorted(table.to_pylist(), key=lambda r: r["piece"]))
        keys = table.column("key").take(pa.array([0] * len(made)))
        return pa.table({"key": keys} | {name: pa.array([m[name] for m in made], _TYPES[kind]) for name, kind in kinds.items()})

    return df.groupBy("key").applyInArrow(run, f"key {df.schema['key'].dataType.simpleString()}, {_fields(kinds)}")


def _fact(powers: Powers, piece: int, codes: list[int], counts: list[int]) -> dict:
    wrong, first, last = broken(codes, counts)
    matrix = [x for row in powers.matrix(collapsed(codes, counts)) for x in row]
    return {"piece": piece, "wrong": wrong, "first": first, "last": last, "matrix": matrix}


def _backward(rows: list[dict]) -> list[dict]:
    """The costs after each piece, and its faults of order with the seam before it."""
    to_come, out = LAST, []
    for r in reversed(rows):
        out.append({"piece": r["piece"], "to_come": list(to_come), "wrong": r["wrong"], "final": not out})
        m = r["matrix"]
        to_come = onto(tuple(tuple(m[4 * i : 4 * i + 4]) for i in _STATES), to_come)
    out.reverse()
    for before, r, made in zip(rows, rows[1:], out[1:], strict=False):
        made["wrong"] += (before["last"], r["first"]) not in _LEGAL
    return out


def _lead(powers: Powers, codes: list[int], counts: list[int], to_come: list[float], **rest) -> dict:
    """The state that each state leads to through a piece."""
    runs = collapsed(codes, counts)
    return rest | {"to_come": to_come, "leads": [powers.unroll(runs, s, tuple(to_come))[1] for s in _STATES]}


def _forward(rows: list[dict]) -> list[dict]:
    state = 0
    for r in rows:
        r["start"], state = state, r["leads"][state]
    return rows


def _unrolled(powers: Powers, piece: int, codes: list[int], counts: list[int], start: int, to_come: list[float], wrong: int, final: bool) -> dict:
    runs, after = collapsed(codes, counts), tuple(to_come or LAST)
    text, state = powers.unroll(runs, start or 0, after)
    cost = powers.cost(runs, after)[start or 0]
    if final is None or final:
        text += closing(state)
    else:
        cost -= after[state]
    return {"piece": piece, "edits": text, "wrong": broken(codes, counts)[0] if wrong is None else wrong, "cost": int(cost)}


_SEAM = {"piece": "int", "start": "int", "to_come": "array<double>", "wrong": "bigint", "final": "boolean"}


def planned(rows: DataFrame, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """(key, piece, edits, wrong, cost) for the rows of ``marked``: the edits of each piece of each key, a letter each."""
    whole = written(pieces(rows, rows_per_piece), "conversations-symbols")
    cut = whole.filter("piece IS NOT NULL")
    if cut.limit(1).count():
        facts = written(_each_row(cut, _fact, {"piece": "int", "wrong": "bigint", "first": "int", "last": "int", "matrix": "array<double>"}), "conversations-facts")
        ends = written(_each_key(facts, _backward, {c: k for c, k in _SEAM.items() if c != "start"}), "conversations-ends")
        leads = {c: k for c, k in _SEAM.items() if c != "start"} | {"leads": "array<int>"}
        led = _each_row(join_on(cut, ends, ["key", "piece"]), _lead, leads)
        whole = join_on(whole, written(_each_key(led, _forward, _SEAM), "conversations-seams"), ["key", "piece"], "left")
    else:
        for c, kind in list(_SEAM.items())[1:]:
            whole = whole.withColumn(c, F.lit(None).cast(kind))
    whole = whole.select("key", "piece", "codes", "counts", "start", "to_come", "wrong", "final")
    return _each_row(whole, _unrolled, {"piece": "int", "edits": "string", "wrong": "bigint", "cost": "bigint"})


class Reader:
    """Follows one conversation: its edits first, then its rows in order."""

    def __init__(self) -> None:
        self.edits: list[str] = []
        self.at = self.wrong = self.cost = self.state = 0

    def plan(self, edits: str, wrong: int, cost: int) -> None:
        self.edits.append(edits)
        self.wrong, self.cost = self.wrong + wrong, self.cost + cost

    def _given(self) -> str:
        role = NEXT_ROLE[self.state]
        self.state = _GIVEN[self.state]
        return role

    def lines(self, role: str | None, text: str | None) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) up to the next row, or for no row up to the end."""
        if len(self.edits) > 1:
            self.edits = ["".join(self.edits)]
        audit = self.edits[0] if self.edits else ""
        while self.at < len(audit):
            letter = audit[self.at]
            self.at += 1
            if letter == "I":
                yield "I", self._given(), ""
                continue
            if letter == "K":
                self.state = _STEP[role[:1]][self.state]
            yield letter, self._given() if letter == "R" else role, text
            return


def _in_order(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """Every key's edits and then its rows, in order, in one task per key."""
    first = plan.select("key", F.lit(0).alias("side"), "piece", "edits", "wrong", "cost")
    rows = turns.filter("n > 0").withColumn("side", F.lit(1))
    both = first.unionByName(rows, allowMissingColumns=True).repartition("key")
    both = both.sortWithinPartitions("key", "side", "piece", "turn", "role", "digest")
    return both.select("key", "side", "edits", "wrong", "cost", "role", "n", "text")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Reader, tuple | None]]:
    """(key, reader, line) for every line of every key in order, and then (key, reader, None)."""
    key, reader = None, None
    for b in batches:
        keys, side, edits, wrong, cost, role, n = (b.column(i).to_pylist() for i in range(7))
        for i, is_row in enumerate(side):
            if reader is None or keys[i] != key:
                if reader is not None:
                    yield from ((key, reader, line) for line in reader.lines(None, None))
                    yield key, reader, None
                key, reader = keys[i], Reader()
            if is_row:
                text = b.column(7)[i].as_py()
                for _ in range(n[i]):
                    yield from ((key, reader, line) for line in reader.lines(role[i], text))
            else:
                reader.plan(edits[i], wrong[i], cost[i])
    if reader is not None:
        yield from ((key, reader, line) for line in reader.lines(None, None))
        yield key, reader, None


def _streamed(given: DataFrame, plan: DataFrame, how: Callable[[Iterator], Iterator[tuple]], kinds: dict[str, str]) -> DataFrame:
    """What ``how`` makes of the lines of each task's keys, in batches of bounded size."""
    kind = given.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        size, key_type = 0, pa.null()

        def opened() -> Iterator[pa.RecordBatch]:
            nonlocal key_type
            for b in batches:
                key_type = b.schema.field(0).type
                yield b

        def told() -> pa.RecordBatch:
            types = [key_type, *[_TYPES[k] for k in kinds.values()]]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["key", *kinds])

        for row in how(_read(opened())):
            made.append(row)
            size += 64 + sum(len(x) for x in row if isinstance(x, str))
            if size > 1 << 22:
                yield told()
                made, size = [], 0
        if made:
            yield told()

    return _in_order(given, plan).mapInArrow(run, f"key {kind}, {_fields(kinds)}")


def _plan(turns: DataFrame, rows_per_piece: int) -> tuple[DataFrame, DataFrame]:
    rows = written(marked(turns), "conversations-rows")
    return rows, written(planned(rows, rows_per_piece), "conversations-plan")


def repair(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", n: str | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """(key, place, edit, role, text): every edit of every conversation in order, with the role that it gives; the repaired
    conversation is what is left without D. ``n``: how often each row stands there."""

    def lines(read: Iterator) -> Iterator[tuple]:
        place = 0
        for k, _, line in read:
            if line is None:
                place = 0
            else:
                yield k, place, *line
                place += 1

    given = prepared(turns, key, turn, role, text, n)
    kinds = {"place": "bigint", "edit": "string", "role": "string", "text": "string"}
    return _streamed(given, _plan(given, rows_per_piece)[1], lines, kinds).withColumnRenamed("key", key)


def summary(
    turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", n: str | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): one row per conversation.
    ``audit``: the letters of its edits; the hash is over the lines ``role:text`` of the repaired conversation."""

    def digests(read: Iterator) -> Iterator[tuple]:
        digest, lines = hashlib.sha256(), 0
        for k, reader, line in read:
            if line is None:
                yield k, reader.wrong, reader.cost, "".join(reader.edits), digest.hexdigest()
                digest, lines = hashlib.sha256(), 0
            elif line[0] != "D":
                digest.update((f"\n{line[1]}:" if lines else f"{line[1]}:").encode())
                digest.update(line[2].encode())
                lines += 1

    given = prepared(turns, key, turn, role, text, n)
    rows, plan = _plan(given, rows_per_piece)
    kinds = {"illegal": "bigint", "cost": "bigint", "audit": "string", "repaired_sha256": "string"}
    told = _streamed(given, plan, digests, kinds)
    return join_on(counted(rows), told, ["key"]).withColumnRenamed("key", key)
