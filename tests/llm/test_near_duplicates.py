import random

import numpy as np

from cases import awkward, empty
from stallkeeper.llm.near_duplicates import (
    SIMILARITY,
    near_duplicates,
    probability_jaccard,
    shingles,
    sketches,
    words_of,
)


def classes_by_brute_force(texts: dict[int, str]) -> dict[int, int]:
    known, parent = {}, {i: i for i in texts}
    sets = {i: shingles(words_of(t), known) for i, t in texts.items()}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sorted(texts):
        for j in sorted(texts):
            if i < j and len(sets[i][0]) and probability_jaccard(sets[i], sets[j]) >= SIMILARITY:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in texts}


def made_texts() -> dict[int, str]:
    draw = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    passage = " ".join(draw.choices(words, k=60))
    texts = {}
    for group in range(12):
        base = draw.choices(words, k=draw.choice((3, 40, 120, 400)))
        for copy in range(draw.choice((1, 2, 8, 40))):
            own = list(base)
            for _ in range(draw.choice((0, 1, 2, 4, 8, 14))):
                own[draw.randrange(len(own))] = draw.choice(words)
            texts[len(texts)] = " ".join(own)
    for _ in range(40):  # texts that share a long passage only
        texts[len(texts)] = passage + " " + " ".join(draw.choices(words, k=draw.choice((20, 60))))
    return texts


def test_classes_equal_brute_force(spark):
    texts = made_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert found == classes_by_brute_force(texts)


def test_a_big_group_of_near_copies(spark):
    """Copies of one text that differ in their own places, more than a block of them."""
    draw = random.Random(6)
    words = [f"w{i}" for i in range(5000)]
    base = draw.choices(words, k=100)
    texts = {}
    for i in range(300):
        own = list(base)
        for _ in range(draw.choice((0, 1, 2, 3, 4, 5))):
            own[draw.randrange(100)] = draw.choice(words)
        texts[i] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert found == classes_by_brute_force(texts)


def test_sketches_estimate_the_similarity():
    draw = random.Random(7)
    words = draw.choices([f"w{i}" for i in range(900)], k=400)
    other = words[:340] + draw.choices([f"v{i}" for i in range(900)], k=60)
    a, b = shingles(words, {}), shingles(other, {})
    x, y = sketches([a, b], 4096)
    assert abs((x == y).mean() - probability_jaccard(a, b)) < 0.03
    assert probability_jaccard(a, a) == 1.0
    lighter = (a[0], a[1] / 7)
    assert np.isclose(probability_jaccard(lighter, b), probability_jaccard(a, b))


def test_awkward_rows(spark):
    found = near_duplicates(awkward(spark)).collect()
    assert len(found) == 10
    classes = {r.doc_id: r.class_id for r in found}
    assert classes[6] == 1 and classes[2] == 2 and classes[3] == 3 and classes[4] == 4
    assert near_duplicates(empty(spark)).collect() == []
