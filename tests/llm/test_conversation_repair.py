import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from stallkeeper.llm.conversation_repair import (
    AUDIT, EMPTY, GONE, INITIALS, SYMBOLS, Tables, audit_conversations, repair, repaired_turns,
)
from stallkeeper.llm.queries import damaged

ROWS = "conv_id long, turn long, role string, text string"
PATTERN = re.compile("(s?(ua)+)?")


def cheapest(symbols):
    """All edits of a few turns, with up to two insertions before each and at the end."""
    best = None
    gaps = itertools.product(("", "I", "II"), repeat=len(symbols) + 1)
    gaps = list(gaps)
    for edits in itertools.product("DKR", repeat=len(symbols)):
        if any(s == GONE and e != "D" for s, e in zip(symbols, edits)):
            continue
        cost = sum({"D": 4, "K": 0, "R": 3}[e] for e in edits)
        cost += sum(3 for s, e in zip(symbols, edits) if e != "D" and s != GONE and s % 2)
        for gap in gaps:
            line = "".join(g + e for g, e in zip(gap, (*edits, "")))
            whole = cost + 3 * line.count("I")
            if best and (whole, line) >= best:
                continue
            # Initials of the turns that are left; inserted and given ones may be u or a.
            left, at = [], 0
            for e in line:
                if e == "I" or e == "R":
                    left.append("ua")
                elif e == "K":
                    left.append(INITIALS[symbols[at] // 2] or "x")
                at += e in "DKR"
            if any(PATTERN.fullmatch("".join(c)) for c in itertools.product(*left)):
                best = whole, line
    return best


def test_tables_equal_exhaustive_search():
    tables = Tables()
    for n in range(3):
        for symbols in itertools.product(range(SYMBOLS), repeat=n):
            assert tables.repair(bytes(symbols)) == cheapest(symbols), symbols
    draw = random.Random(4)
    for _ in range(25):
        symbols = [draw.randrange(SYMBOLS) for _ in range(4)]
        assert tables.repair(bytes(symbols)) == cheapest(symbols), symbols


def test_blocks_equal_single_steps():
    """Lists of any length cost what working them off turn by turn costs."""
    tables, draw = Tables(), random.Random(8)
    for n in range(0, 41):
        symbols = bytes(draw.randrange(SYMBOLS) for _ in range(n))
        cost, vector = 0, 0
        for x in reversed(symbols):
            cost, vector = cost + int(tables.cost[vector, x]), int(tables.to[vector, x])
        found, edits = tables.repair(symbols)
        assert found == cost + tables.vectors[vector][0]
        assert len(edits.replace("I", "")) == n


def facts(turns):
    """Counts and symbols of the turns (turn, role, text) in order."""
    seen, symbols, counts = set(), [], [0, 0, 0]
    for _, role, text in turns:
        shown = text.strip(" \t\n\v\f\r")
        if not shown or (role, text) in seen:
            counts[1 if shown else 0] += 1
            symbols.append(GONE)
        else:
            cut = shown[-1] not in ".!?"
            counts[2] += cut
            symbols.append(2 * (INITIALS.index(role[:1]) if role[:1] in "sua" and role else 3) + cut)
        seen.add((role, text))
    pairs = zip(turns, turns[1:])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
    numbers = {t for t, _, _ in turns if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    return [gaps, *counts, illegal], symbols


def replay(turns, edits):
    left, at = [], 0
    for e in edits:
        if e == "I":
            left.append([None, ""])
        else:
            if e == "K":
                left.append([turns[at][1], turns[at][2]])
            elif e == "R":
                left.append([None, turns[at][2]])
            at += 1
    led = bool(left) and left[0][0] is not None and left[0][0][:1] == "s"
    for i, turn in enumerate(left):
        if turn[0] is None:
            turn[0] = ("user", "assistant")[(i - led) % 2]
    return "\n".join(f"{r}:{t}" for r, t in left)


def test_damaged_conversations_equal_brute_force(spark):
    draw = random.Random(9)
    texts = ["One. Two!", "Cut off here", "  ", None, "Why?\n", "ü.  ", "Ends. "]
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    rows = []
    for conv in range(60):
        rows += [
            (conv, draw.choice((t, 2 * t, None)) if conv % 3 else t, draw.choice(roles), draw.choice(texts))
            for t in range(draw.randint(1, 4))
        ]
    rows = [(c, t, r, x) for n, (c, t, r, x) in enumerate(rows) if (c, t) not in {y[:2] for y in rows[:n]}]
    df = spark.createDataFrame(rows, ROWS).withColumn("kind", F.lit(7)).withColumn("audit", F.lit("x"))
    found = {r["conv"]: r for r in repair(damaged(df), df.select("conv_id")).collect()}
    assert set(found) == {r[0] for r in rows}
    names = [c.split()[0] for c in AUDIT.split(", ")]
    for conv in found:
        turns = []
        for c, t, r, x in rows:
            case = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
            if c != conv or case == 0:
                continue
            r, x = " " if r is None else r, " " if x is None else x
            x = "" if case == 1 else re.sub("[.!?]", "", x) if case == 2 else x
            turns += [(t, "user" if case == 4 else r, x)] * (2 if case == 3 else 1)
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0))
        counts, symbols = facts(turns)
        cost, edits = Tables().repair(bytes(symbols))
        if len(symbols) <= 3:
            assert (cost, edits) == cheapest(symbols)
        row = found[conv]
        assert [row[n] for n in names] == [*counts, cost, edits], conv
        assert row["repaired_sha256"] == hashlib.sha256(replay(turns, edits).encode()).hexdigest()


def test_repaired_turns(spark):
    rows = [
        (1, 0, "system", "Be kind."),
        (1, 1, "user", "Who?"),
        (1, 2, "user", "Who?"),
        (2, None, "tool", "Out."),
        (2, 3, "assistant", "In."),
    ]
    df = spark.createDataFrame(rows, ROWS)
    audits = audit_conversations(df, df.select("conv_id"))
    found = repaired_turns(df, audits).orderBy("conv", "place").collect()
    assert [tuple(r) for r in found] == [
        (1, 1, "K", "system", "Be kind."),
        (1, 2, "K", "user", "Who?"),
        (1, 3, "I", "assistant", ""),
        (2, 1, "R", "user", "Out."),
        (2, 2, "K", "assistant", "In."),
    ]


@pytest.mark.parametrize("null_id", [False, True])
def test_awkward_rows(spark, null_id):
    conv = None if null_id else 5
    rows = [(conv, None, None, None), (conv, None, None, None), (conv, 1, "user", "long. " * 50_000)]
    rows += [(6, 0, "user", None)]
    df = spark.createDataFrame(rows, ROWS)
    found = {r["conv"]: r for r in repair(df, df.select("conv_id")).collect()}
    assert found[conv]["audit"] == "DDKI" and found[conv]["blank"] == 2 and found[conv]["gaps"] == 0
    assert found[6]["audit"] == "D" and found[6]["repaired_sha256"] == EMPTY
    none = df.limit(0)
    assert repair(none, none.select("conv_id")).collect() == []
    # Ids without a turn: zeros, no edits, the hash of nothing.
    alone = repair(none, df.where("conv_id = 6").select("conv_id")).collect()
    assert [tuple(r) for r in alone] == [(6, 0, 0, 0, 0, 0, 0, "", EMPTY)]
