import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallkeeper.llm import prefix_trie as module
from stallkeeper.llm.prefix_trie import NODE, DoubleArray, prefix_trie, turn_ids
from stallkeeper.llm.queries import borrowed_openings

ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = [c.split()[0] for c in NODE.split(", ")]


def conversations(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in found.items()}


def brute(whole):
    """The nodes of the trie of {id: turns}."""
    members = defaultdict(list)
    for conv, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        inner = {m[:-1] for m in members if m}
        ends = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(node))))
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        out.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                sum(m[:-1] == node for m in members if m),
                sum(m not in inner for m in below),
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def nodes(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def some_rows(seed, n, words, most=6):
    draw = random.Random(seed)
    return [
        (conv, turn, draw.choice(("user", "assistant", None)), draw.choice(words))
        for conv in range(n)
        for turn in range(draw.randint(1, most))
    ]


@pytest.mark.parametrize("seed,words", [(1, ["a", "ü"]), (2, ["a", "b", "", None]), (3, list("abcdefgh"))])
def test_equals_brute_force(spark, seed, words):
    rows = some_rows(seed, 120, words)
    # A common opening of several turns, behind which all differ, and many equal conversations.
    for conv in range(200, 260):
        rows += [(conv, t, "user", f"open {t}") for t in range(3)] + [(conv, 9, "user", f"x{conv}")]
    rows += [(conv, 0, "system", "same") for conv in range(300, 360)]
    df = spark.createDataFrame(rows, ROWS)
    found = prefix_trie(turn_ids(df, "conv_id", "turn", "role", "text"), df.select("conv_id"))
    assert nodes(found) == brute(conversations(rows))


def test_heavy_prefixes_are_spread_over_shards(spark):
    rows = [(c, t, "user", "open") for c in range(100) for t in range(3)]
    rows += [(c, 3, "user", f"x{c}") for c in range(100)]
    df = spark.createDataFrame(rows, ROWS)
    turns = turn_ids(df, "conv_id", "turn", "role", "text")
    paths = module._whole(turns, None).select("path")
    heavy = module._heavy(paths, 100 // 8)
    assert len(heavy) == 3
    dealt = module._whole(turns, None).select(
        F.lit(1).cast("long").alias("n"), "conv", "path", "sizes", F.lit("").alias("ends")
    )
    dealt = module._dealt(dealt, heavy)
    assert dealt.select("shard").distinct().count() == 100
    assert [r[0] for r in dealt.select("above").distinct().collect()] == [3]


def test_borrowed_openings(spark):
    import zlib

    rows = some_rows(7, 60, list("abc"), 12)
    rows = [r for r in rows if r[0] % 10 != 5]  # some openings are of no conversation
    whole = conversations(rows)
    expected = {}
    for c, turns in whole.items():
        h = zlib.crc32(str(c).encode()) % 9
        expected[c] = whole.get(c - c % 5, [])[:h] + turns[h:]
    df = spark.createDataFrame(rows, ROWS)
    turns = borrowed_openings(turn_ids(df, "conv_id", "turn", "role", "text"))
    assert any(not t for t in expected.values())
    assert nodes(prefix_trie(turns, df.select("conv_id"))) == brute(expected)


def test_awkward_rows(spark):
    rows = [
        (None, 0, "user", "no id"),
        (1, None, None, None),
        (1, 2, "user", "x"),
        (1, None, None, None),
        (2, 5, "", ""),
        (2, 7, "", ""),
        (2, 9, "user", "x"),
        (3, 1, "user", "long " * 100_000),
        (-4, 0, "a", "bc"),
        (-5, 0, "ab", "c"),
    ]
    df = spark.createDataFrame(rows, ROWS)
    for name in ("conv", "place", "id", "size", "key", "path", "end"):
        df = df.withColumn(name, F.lit("x"))
    found = prefix_trie(turn_ids(df, "conv_id", "turn", "role", "text"), df.select("conv_id"))
    assert nodes(found) == brute(conversations(rows))
    none = df.limit(0)
    found = prefix_trie(turn_ids(none, "conv_id", "turn", "role", "text"), none.select("conv_id"))
    assert nodes(found) == []
    # Ids without a turn are members of the root.
    found = prefix_trie(turn_ids(none, "conv_id", "turn", "role", "text"), df.select("conv_id"))
    assert [r[:7] for r in nodes(found)] == [(-5, 0, None, 5, 0, 1, 0)]


def test_double_array():
    draw = random.Random(2)
    some = {tuple(draw.randrange(300) for _ in range(draw.randint(0, 4))) for _ in range(2000)}
    trie = DoubleArray([np.array(s, np.int64) for s in sorted(some)])
    for sequence in some:
        slot = np.zeros(1, np.int64)
        for turn in sequence:
            slot = trie.step(slot, np.array([turn]))
            assert slot[0] > 0
    prefixes = {s[:d] for s in some for d in range(len(s) + 1)}
    assert (trie.check >= 0).sum() == len(prefixes) - 1
    used = len(prefixes) / len(trie.check)
    assert used > 0.25
    for _ in range(2000):
        asked = tuple(draw.randrange(300) for _ in range(2))
        slot = trie.step(trie.step(np.zeros(1, np.int64), np.array(asked[:1])), np.array(asked[1:]))
        if asked[:1] in prefixes:
            assert (slot[0] > 0) == (asked in prefixes)
