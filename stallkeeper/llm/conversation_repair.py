"""Conversations brought to ``(system? (user assistant)+)?`` by the cheapest edits, by block tables.

Turns are kept (free), given the role user or assistant, deleted, or inserted with an empty text. Blank
turns and repetitions have to be deleted; a turn cut short costs ``CUT`` more unless it is deleted. Of the
cheapest lists of edits the one whose initials (D, I, K, R) come first in ASCII order is chosen.

*Vectors*: before each turn, the costs of the rest from each state of the pattern (nothing yet, after
system, after user, after a pair). Only differences matter for what comes before, so a vector is its least cost
and one of a few normalised vectors, which are found once by following all symbols from the
vector at the end.

*Blocks* (the method of the Four Russians): a turn is one of nine symbols (role and fault), and for every
normalised vector and every block of ``BLOCK`` symbols the vector before the block and the cost are in a
table. A conversation is worked off from its end, a lookup for each block.

*Tracing* goes from the start. A block is expanded backward from the vector behind it, so the vector before
each of its turns is known, and takes the first edit in ASCII order that leads to the least cost; as
each edit leads to one state only, the whole list is the first one. What a block gives from a state is
looked up when it comes again.

Two passes, each over rows dealt by conversation and sorted, neither with a join. The first has no texts: it
holds a byte per turn and 16 bytes for each different one, and yields the audit. The second streams
the texts behind their audit and holds none of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stallkeeper.llm.common import map_batches, new_stage, values

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
BLOCK = 4
START, SYSTEM, USER, PAIR = range(4)
FINAL = (START, PAIR)
# By state, the state after the only role that can be inserted or given; and by initial, after a kept turn.
GIVEN = {START: USER, SYSTEM: USER, USER: PAIR, PAIR: USER}
KEPT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, PAIR: USER},
    "a": {USER: PAIR},
    "": {},
}
INITIALS = ("s", "u", "a", "")
# Two symbols for each initial, whole and cut short, and one for turns that have to go.
GONE = 2 * len(INITIALS)
SYMBOLS = GONE + 1
FAR = 10**6
LEGAL = {"su", "ua", "au"}
# White space of the fault tests; every other character counts.
BLANKS = " \t\n\v\f\r"
EMPTY = hashlib.sha256().hexdigest()

AUDIT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def _inserted(costs: list[int]) -> list[int]:
    """Costs with as many insertions first as help."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[GIVEN[s]]) for s, c in enumerate(costs)]
    return costs


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a turn in a state: initial, cost, next state; in ASCII order."""
    found = [("D", DELETE, state)]
    if symbol != GONE:
        initial, cut = INITIALS[symbol // 2], CUT * (symbol % 2)
        if state in KEPT[initial]:
            found.append(("K", KEEP + cut, KEPT[initial][state]))
        found.append(("R", REROLE + cut, GIVEN[state]))
    return found


def step(symbol: int, after: Iterable[int]) -> list[int]:
    """The costs before a turn from those behind it."""
    after = list(after)
    return _inserted([min(c + after[to] for _, c, to in _edits(symbol, s)) for s in range(4)])


class Tables:
    """Normalised vectors, and by vector and block what comes before the block and its cost."""

    def __init__(self):
        end = _inserted([0 if s in FINAL else FAR for s in range(4)])
        self.vectors = [tuple(end)]
        number = {self.vectors[0]: 0}
        to, cost = [], []
        for vector in self.vectors:  # grows while it is read
            for symbol in range(SYMBOLS):
                before = step(symbol, vector)
                least = min(before)
                normal = tuple(c - least for c in before)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                to.append(number[normal])
                cost.append(least)
        self.to = np.array(to).reshape(-1, SYMBOLS)
        self.cost = np.array(cost).reshape(-1, SYMBOLS)
        blocks = np.arange(SYMBOLS**BLOCK)
        at = np.repeat(np.arange(len(self.vectors))[:, None], len(blocks), 1)
        total = np.zeros(at.shape, np.int64)
        for i in range(BLOCK):  # the last symbol of a block is its lowest digit
            symbol = np.broadcast_to(blocks // SYMBOLS**i % SYMBOLS, at.shape)
            total += self.cost[at, symbol]
            at = self.to[at, symbol]
        self.block_to, self.block_cost = at.tolist(), total.tolist()
        self.traced: dict[tuple, tuple[str, int]] = {}

    def trace(self, symbols: bytes, behind: int, state: int) -> tuple[str, int]:
        """Edits of a block from a state, before the vector ``behind``, and the state they lead to."""
        known = (symbols, behind, state)
        if known not in self.traced:
            line = [behind]
            for x in reversed(symbols):
                line.append(int(self.to[line[-1], x]))
            edits = ""
            for x, here, after in zip(symbols, line[:0:-1], line[-2::-1]):
                costs, rest = self.vectors[here], self.vectors[after]
                more = int(self.cost[after, x])
                while True:
                    least = costs[state] + more
                    options = [o for o in _edits(x, state) if o[1] + rest[o[2]] == least]
                    if INSERT + costs[GIVEN[state]] == costs[state]:
                        options.append(("I", 0, GIVEN[state]))
                    edit, _, state = min(options)
                    edits += edit
                    if edit != "I":
                        break
            self.traced[known] = edits, state
        return self.traced[known]

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """The least cost and the first of its lists of edits."""
        short = len(symbols) % BLOCK
        blocks = [symbols[i : i + BLOCK] for i in range(short, len(symbols), BLOCK)]
        behind, cost = [0], 0
        for block in reversed(blocks):
            number = 0
            for x in block:
                number = number * SYMBOLS + x
            cost += self.block_cost[behind[-1]][number]
            behind.append(self.block_to[behind[-1]][number])
        vector = behind[-1]
        for x in reversed(symbols[:short]):
            cost += int(self.cost[vector, x])
            vector = int(self.to[vector, x])
        cost += self.vectors[vector][START]
        state, edits = START, []
        for part, number in zip([symbols[:short], *blocks], reversed(behind)):
            found, state = self.trace(part, number, state)
            edits.append(found)
        while state not in FINAL:
            edits.append("I")
            state = GIVEN[state]
        return cost, "".join(edits)


def _turns(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows under fixed names; a null role or text is empty."""
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    return rows.select(
        F.col(f"`{key}`").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        said[0].alias("role"),
        said[1].alias("text"),
        F.substring(
            F.unhex(F.sha2(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said), 256)), 1, 16
        ).alias("said"),
    )


def _dealt(rows: DataFrame, *more: str) -> DataFrame:
    """Dealt by conversation, in the order of turns, null first; what says the same is adjacent."""
    order = ["conv", *more, F.col("turn").asc_nulls_first(), "said"]
    return rows.repartition("conv").sortWithinPartitions(*order)


def audit_conversations(
    rows: DataFrame,
    conversations: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv`` and the columns of ``AUDIT`` of each id in the first column of ``conversations``.

    ``gaps``: turn numbers missing between the least and the largest. ``blank``, ``duplicate`` (role and text
    occurred before), ``truncated`` (does not end in ``.``, ``!`` or ``?``): turns by their first fault.
    ``illegal``: neighbouring turns whose initials of roles are not su, ua or au. ``cost`` and ``audit``:
    the edits. Conversations without turns have zeros and no edits. Null ids are one conversation; a null
    role or text is empty; turns of one number are in the order of a hash of role and text.
    """
    turns = _turns(rows, key, turn, role, text)
    kept = F.rtrim(F.col("text"), F.lit(BLANKS))
    narrow = turns.select(
        "conv",
        "turn",
        "said",
        F.substring("role", 1, 1).alias("initial"),
        (kept == "").alias("blank"),
        (~F.substring(kept, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    ids = conversations.select(F.col(conversations.columns[0]).alias("conv")).distinct()
    none = {c: F.lit(None).cast(t) for c, t in narrow.dtypes if c != "conv"}
    # A row without a hash stands for the conversation itself.
    narrow = narrow.unionByName(ids.withColumns(none))
    names = [c.split()[0] for c in AUDIT.split(", ")]

    def audited(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        table, conv, going = Tables(), None, False
        symbols, seen, numbers = bytearray(), set(), [0, 0, 0]
        counts, last = [0, 0, 0, 0], None

        def close(out: dict) -> None:
            cost, edits = table.repair(bytes(symbols))
            n, low, high = numbers
            found = (high - low + 1 - n if n else 0, *counts, cost, edits)
            for name, value in zip(("conv", *names), (conv, *found)):
                out[name].append(value)

        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("conv", *names)}
            columns = ("conv", "turn", "said", "initial", "blank", "cut")
            for own, at, said, initial, blank, cut in zip(*(values(batch, c) for c in columns)):
                if not going or own != conv:
                    if going:
                        close(out)
                    conv, going, last, now = own, True, None, None
                    symbols, seen, numbers, counts = bytearray(), set(), [0, 0, 0], [0, 0, 0, 0]
                if said is None:
                    continue
                if at is not None and at != now:
                    numbers = [numbers[0] + 1, numbers[1] if numbers[0] else at, at]
                    now = at
                if last is not None and last + initial not in LEGAL:
                    counts[3] += 1
                last = initial
                if blank:
                    counts[0] += 1
                    symbols.append(GONE)
                elif said in seen:
                    counts[1] += 1
                    symbols.append(GONE)
                else:
                    counts[2] += cut
                    place = INITIALS.index(initial) if initial in INITIALS else len(INITIALS) - 1
                    symbols.append(2 * place + cut)
                seen.add(said)
            yield out
        if going:
            out = {n: [] for n in ("conv", *names)}
            close(out)
            yield out

    kind = ids.schema[0].dataType.simpleString()
    return map_batches(_dealt(narrow), audited, f"conv {kind}, {AUDIT}")


def _behind_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Turns with their texts, the row of the audit ahead of each conversation."""
    turns = rows.withColumn("kind", F.lit(1))
    ahead = audits.withColumn("kind", F.lit(0))
    return _dealt(turns.unionByName(ahead, allowMissingColumns=True), "kind")


def _replayed(batches: Iterable[pa.RecordBatch], begin: Callable, emit: Callable, end: Callable):
    """Calls ``begin(row)``, ``emit(edit, role, text)`` for each repaired turn, and ``end()``.

    Yields after each batch.
    """
    edits, at, state = "", 0, START

    def given() -> str:
        nonlocal state
        state = GIVEN[state]
        return "user" if state == USER else "assistant"

    def insert() -> None:
        nonlocal at
        while at < len(edits) and edits[at] == "I":
            emit("I", given(), "")
            at += 1

    started = False
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                if started:
                    insert()
                    end()
                begin(row)
                edits, at, state, started = row["audit"], 0, START, True
                continue
            insert()
            edit, at = edits[at], at + 1
            if edit == "K":
                state = KEPT[row["role"][:1]][state]
                emit(edit, row["role"], row["text"])
            elif edit == "R":
                emit(edit, given(), row["text"])
        yield
    if started:
        insert()
        end()
        yield


def repaired_turns(
    rows: DataFrame,
    audits: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv, place, edit, role, text``: the turns of the repaired conversations, from place 1.

    ``audits`` is what ``audit_conversations`` gives for the same rows.
    """
    together = _behind_audits(_turns(rows, key, turn, role, text), audits)
    kind = audits.schema["conv"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        out: dict[str, list] = {n: [] for n in ("conv", "place", "edit", "role", "text")}
        now = [None, 0]

        def begin(row: dict) -> None:
            now[:] = row["conv"], 0

        def emit(*turn: str) -> None:
            now[1] += 1
            for name, value in zip(out, (*now, *turn)):
                out[name].append(value)

        for _ in _replayed(batches, begin, emit, lambda: None):
            yield out
            out = {n: [] for n in out}

    return map_batches(together, run, f"conv {kind}, place long, edit string, role string, text string")


def repair_digests(
    rows: DataFrame,
    audits: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``audits`` with ``repaired_sha256``, of the repaired ``role:text`` joined by line feeds."""
    together = _behind_audits(_turns(rows, key, turn, role, text), audits)
    names = audits.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in audits.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        out: dict[str, list] = {n: [] for n in (*names, "repaired_sha256")}
        now: list = [None, None, ""]  # the audit, the hash so far, what goes before the next turn

        def begin(row: dict) -> None:
            now[:] = row, hashlib.sha256(), ""

        def emit(_, role: str, text: str) -> None:
            now[1].update(f"{now[2]}{role}:{text}".encode())
            now[2] = "\n"

        def end() -> None:
            for name in names:
                out[name].append(now[0][name])
            out["repaired_sha256"].append(now[1].hexdigest())

        for _ in _replayed(batches, begin, emit, end):
            yield out
            out = {n: [] for n in out}

    return map_batches(together, run, f"{schema}, repaired_sha256 string")


def repair(rows: DataFrame, conversations: DataFrame, **columns: str) -> DataFrame:
    """Audits and digests in one; see ``audit_conversations`` and ``repair_digests``."""
    audits = new_stage(rows.sparkSession)(audit_conversations(rows, conversations, **columns), "audits")
    return repair_digests(rows, audits, **columns)
