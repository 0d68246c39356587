import random

import numpy as np
from pyspark.sql import functions as F

from cases import awkward, empty
from stallkeeper.llm.common import bounded_sample, table
from stallkeeper.llm.queries import op5_toxicity
from stallkeeper.llm import toxicity
from stallkeeper.llm.toxicity import BlockMaxIndex, fit_toxicity, score_toxicity


def test_nearest_equals_brute_force():
    draw = random.Random(3)
    vectors = []
    for _ in range(700):
        terms = tuple(sorted(draw.sample(range(40), draw.randint(1, 6))))
        w = np.array([draw.choice((1.0, 2.0, 3.5)) for _ in terms])
        vectors.append((terms, tuple(w / np.linalg.norm(w))))
    index = BlockMaxIndex(vectors, 40)
    dense = np.zeros((700, 40))
    for e, (t, w) in enumerate(vectors):
        dense[e, list(t)] = w
    for t, w in vectors[::13]:
        q = np.zeros(40)
        q[list(t)] = w
        exact = [round(float(x), 9) for x in dense @ q]
        order = sorted((e for e in range(700) if exact[e] > 0), key=lambda e: (-exact[e], e))[:10]
        found = index.nearest(list(t), list(w), 10)
        assert [e for _, e in found] == order


def test_blocks_are_skipped_and_neighbours_exact(monkeypatch):
    monkeypatch.setattr(toxicity, "HEAVY_TERMS", 100)
    draw = random.Random(11)
    vectors = []
    for e in range(1500):  # fifty vocabularies
        terms = tuple(sorted(draw.sample(range(40 * (e % 50), 40 * (e % 50) + 40), 8)))
        w = np.array([draw.random() + 0.1 for _ in terms])
        vectors.append((terms, tuple(w / np.linalg.norm(w))))
    index = BlockMaxIndex(vectors, 2000)
    dense = np.zeros((1500, 2000))
    for e, (t, w) in enumerate(vectors):
        dense[e, list(t)] = w
    for t, w in vectors[::25]:
        exact = np.round(dense[:, list(t)] @ np.array(w), 9)
        bound = index.bounds([(np.array(t), np.array(w))])[0]
        assert (exact[index.number] <= bound).all()
        order = sorted((e for e in range(1500) if exact[e] > 0), key=lambda e: (-exact[e], e))[:10]
        assert [e for _, e in index.nearest(t, w, 10)] == order
    assert index.opened < 0.2 * 60 * index.size


def test_scores_equal_brute_force(spark):
    """Frequencies, weights, neighbours, votes and calibration, counted anew."""
    import math
    import zlib
    from collections import Counter

    from stallkeeper.llm.quality import isotonic

    draw = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    labelled = [
        (i, " ".join(draw.choices(words, k=12)) + (" scum" if i % 4 == 0 else ""), int(i % 4 == 0))
        for i in range(160)
    ]
    texts = [(i, " ".join(draw.choices(words, k=10)) + " scum" * (i % 2)) for i in range(40)]
    found = judged(spark, labelled, texts)
    everything = [Counter(t.split()) for _, t in texts] + [Counter(t.split()) for _, t, _ in labelled]
    known = {w for _, t, _ in labelled for w in t.split()}
    df = Counter(w for c in everything for w in c)
    idf = {w: (math.log((1 + len(everything)) / (1 + df[w])) + 1) * (10 if w == "scum" else 1) for w in known}

    def vector(t):
        v = {w: (1 + math.log(n)) * idf[w] for w, n in Counter(t.split()).items() if w in known}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()}

    parts = [zlib.crc32(f"calibration {i}".encode()) % 4 == 0 for i, _, _ in labelled]
    examples = sorted((str(i), vector(t), y) for (i, t, y), c in zip(labelled, parts) if not c)

    def near(t):
        v = vector(t)
        scored = [(-round(sum(x * e.get(w, 0) for w, x in v.items()), 9), n) for n, (_, e, _) in enumerate(examples)]
        return [(-s, n) for s, n in sorted(scored)[:10] if s < 0]

    def share(t):
        votes = [(1 / (1.05 - s), examples[n][2]) for s, n in near(t)]
        return sum(v * y for v, y in votes) / sum(v for v, _ in votes)

    weight, positive = np.zeros(200), np.zeros(200)
    for (_, t, y), c in zip(labelled, parts):
        if c:
            step = min(199, int(share(t) * 200))
            weight[step] += 1
            positive[step] += y
    steps = isotonic(weight, positive)
    for i, t in texts:
        assert [e.id for e in found[i].evidence] == [examples[n][0] for _, n in near(t)[:3]]
        assert abs(found[i].score - steps[min(199, int(share(t) * 200))]) < 1e-9


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = table(spark, sf_dir, "labels")
    held_out = op5_toxicity(spark, sf_dir).where("held_out").join(labels, "doc_id")
    right = held_out.select(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).first()[0]
    assert right >= 0.97
    assert held_out.where("toxic = 0 and predicted = 1").count() <= 3


def test_awkward_rows(spark):
    rows = awkward(spark)
    labels = rows.select(F.col("doc_id").alias("id"), "text", (F.col("doc_id") % 2).alias("label"))
    model = fit_toxicity(labels, rows)
    scored = score_toxicity(rows, model)
    assert sorted(scored.columns) == sorted(rows.columns)
    assert all(0 <= r.score <= 1 for r in scored.collect())
    nothing = fit_toxicity(labels.limit(0), empty(spark))
    assert {r.score for r in score_toxicity(rows, nothing).collect()} == {0.5}
    assert score_toxicity(empty(spark), nothing).collect() == []


def judged(spark, labelled, texts):
    rows = spark.createDataFrame(labelled, "id long, text string, label int")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = fit_toxicity(rows, docs.select("text").unionAll(rows.select("text")))
    return {r.doc_id: r for r in score_toxicity(docs, model).collect()}


def prose(seed, words=30):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(words))


def test_copies_do_not_crowd_out_toxic_words(spark):
    copied = " ".join(f"copied{i}word" for i in range(3000))
    labelled = [(i, copied, 1) for i in range(40)]
    labelled += [(100 + i, f"{prose(i)} scum", 1) for i in range(20)]
    labelled += [(200 + i, prose(1000 + i), 0) for i in range(60)]
    found = judged(spark, labelled, [(1, f"{prose(9001)} scum"), (2, copied)])
    assert found[1].evidence and all(e.toxic == 1.0 for e in found[1].evidence)


def test_examples_need_no_toxic_word(spark):
    labelled = [(i, prose(i), int(i < 20)) for i in range(80)]
    found = judged(spark, labelled, [(i, prose(i)) for i in range(80)])
    exact = {i: r.evidence[0] for i, r in found.items() if r.evidence and r.evidence[0].similarity == 1}
    assert all(e.id == str(i) and e.toxic == int(i < 20) for i, e in exact.items())
    assert {e.toxic for e in exact.values()} == {0.0, 1.0}
    assert len(exact) > 40  # the examples' part of the labelled texts


def test_sample_of_a_sample_has_about_its_bytes(spark, monkeypatch):
    """Labelled rows that the caller has sampled by their id are sampled anew, not by the same hash again."""
    monkeypatch.setattr(toxicity, "MAX_BYTES", 20_000)
    rows = spark.range(40_000).select(F.col("id").cast("string"), F.lit("x" * 100).alias("text"))
    assert 130 <= toxicity._sampled(rows).count() <= 280  # of 200
    given = bounded_sample(rows, "id", 2_000)
    assert 1_700 <= given.count() <= 2_300
    assert 130 <= toxicity._sampled(given).count() <= 280
