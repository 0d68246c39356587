import math
import random

from pyspark.sql import functions as F

from stallkeeper.llm import exact_topk
from stallkeeper.llm.exact_topk import top_k


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "CANDIDATE_BLOCK", 16)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 3)
    draw = random.Random(1)
    rows = [(i, [draw.choice((0.0, 0.5, -0.25, 1 / 3)) for _ in range(6)]) for i in range(150)]
    rows += [(200, None), (201, [1.0, None]), (202, [math.nan]), (203, [math.inf]), (None, [1.0])]
    rows += [(204, []), (205, [0.0] * 6), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1))
    asked = df.where("vec_id % 25 = 0 or vec_id in (7, 200, 204)")
    found = [tuple(r) for r in top_k(asked, df, "vec_id", "embedding", 10).collect()]
    good = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    expected = []
    for q in sorted({i for i, _ in good if i % 25 == 0 or i in (7, 204)}):
        for v in [v for i, v in good if i == q][:1]:
            scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q]
            expected += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:10], 1)]
    assert sorted(r for r in found if r[0] != 7) == [r for r in expected if r[0] != 7]
    # The query that is there twice has its candidates from both rows.
    assert [r[2:] for r in sorted(found) if r[0] == 7][::2] == [r[2:] for r in expected if r[0] == 7][:5]


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in top_k(df.where("vec_id = 0"), df, "vec_id", "embedding").collect()] == [
        (0, 1, 1, 2048 * 1024)
    ]
    assert top_k(df.limit(0), df, "vec_id", "embedding").collect() == []
    assert top_k(df.limit(0), df.limit(0), "vec_id", "embedding").collect() == []
