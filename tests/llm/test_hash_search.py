import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallkeeper.llm import hash_search
from stallkeeper.llm.hash_search import SUBSTRINGS, Shard, fit_coder, nearest

VECTORS = "vec_id long, embedding array<double>"


def brute(rows, asked, k):
    """Nearest rows of each id of ``asked``, as (query, rank, id, distance)."""
    width = max(len(v) for _, v in rows)
    full = [(i, np.array(list(v) + [0.0] * (width - len(v)))) for i, v in rows]
    out = []
    for q in asked:
        own = next(v for i, v in full if i == q)
        found = sorted((float(np.sqrt(((v - own) ** 2).sum())), i) for i, v in full if i != q)
        out += [(q, n, i, d) for n, (d, i) in enumerate(found[:k], 1)]
    return out


def recall(found, expected):
    hit = {(q, i) for q, _, i, _ in found} & {(q, i) for q, _, i, _ in expected}
    return len(hit) / len(expected)


def cloud(n, d, spread, centres, seed):
    draw = np.random.default_rng(seed)
    at = draw.normal(size=(centres, d))
    return [(i, (at[i % centres] + spread * draw.normal(size=d)).tolist()) for i in range(n)]


@pytest.mark.parametrize("d,spread,centres", [(48, 1.0, 1), (48, 0.02, 3), (3, 1.0, 2), (1, 1.0, 1)])
def test_recall_against_brute_force(spark, monkeypatch, d, spread, centres):
    monkeypatch.setattr(hash_search, "SHARD_ROWS", 700)
    monkeypatch.setattr(hash_search, "QUERY_BLOCK", 8)
    rows = cloud(2000, d, spread, centres, d)
    df = spark.createDataFrame(rows, VECTORS)
    found = [tuple(r) for r in nearest(df.where("vec_id % 100 = 0"), df, "vec_id", "embedding").collect()]
    expected = brute(rows, range(0, 2000, 100), 10)
    assert len(found) == len(expected)
    assert recall(found, expected) >= 0.95
    exact = {(q, i): s for q, _, i, s in brute(rows, range(0, 2000, 100), 2000)}
    assert all(exact[q, i] == pytest.approx(s, abs=1e-12) for q, _, i, s in found)
    for q in range(0, 2000, 100):
        own = sorted(r[1:] for r in found if r[0] == q)
        assert [r[0] for r in own] == list(range(1, 11))
        assert [r[2] for r in own] == sorted(r[2] for r in own)


def test_every_code_within_the_radius_is_met():
    rows = np.random.default_rng(5).normal(size=(3000, 40))
    coder = fit_coder(rows[:1000])
    shard = Shard.of(np.arange(3000), rows, coder)
    codes = coder.codes(rows)
    assert codes.shape == (3000, SUBSTRINGS)
    own = codes[7]
    apart = np.bitwise_count(codes ^ own).sum(1)
    for level, j in ((0, 31), (1, 5), (2, 31)):
        met = set()
        for part in range(SUBSTRINGS):
            reach = level if part <= j else level - 1
            near = np.bitwise_count(np.arange(256, dtype=np.uint8) ^ own[part]) <= reach
            for value in np.flatnonzero(near):
                at = slice(shard.start[part, value], shard.start[part, value + 1])
                met |= set(shard.order[part, at].tolist())
        assert set(np.flatnonzero(apart <= level * SUBSTRINGS + j).tolist()) <= met


def test_awkward_rows(spark):
    draw = random.Random(3)
    good = [(i, [draw.choice((0.5, -0.25, 1.0)) for _ in range(4)]) for i in range(30)]
    good += [(7, good[7][1]), (40, [1.0]), (41, [0.5, 0.5]), (100, good[3][1])]
    bad = [(200, None), (300, [1.0, None]), (400, [math.nan]), (500, [math.inf]), (600, [0.0] * 4)]
    bad += [(700, []), (None, [1.0])]
    df = spark.createDataFrame(good + bad, VECTORS)
    for name in ("id", "vector", "block", "salt", "score", "ids"):
        df = df.withColumn(name, F.lit(1))
    asked = df.where("vec_id % 100 = 0 or vec_id is null")
    found = [tuple(r) for r in nearest(asked, df, "vec_id", "embedding").collect()]
    # Ties and repeated rows are as in brute force.
    expected = brute(good, [0, 100], 10)
    assert sorted((*r[:3], round(r[3], 9)) for r in found) == sorted((*r[:3], round(r[3], 9)) for r in expected)


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (100, [1.0, 2.0])], "vec_id long, embedding array<float>")
    found = nearest(df, df, "vec_id", "embedding").collect()
    assert sorted(tuple(r) for r in found) == [(0, 1, 100, 2.0), (100, 1, 0, 2.0)]
    assert nearest(df.limit(0), df, "vec_id", "embedding").collect() == []
    assert nearest(df, df.limit(0), "vec_id", "embedding").collect() == []
    alone = df.where("vec_id = 0")
    assert nearest(alone, alone, "vec_id", "embedding").collect() == []
