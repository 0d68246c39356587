import random

import numpy as np

from cases import awkward, empty
from stallkeeper.llm.decontaminate import (
    CELL,
    CELLS,
    GRAM,
    LEAST_OVERLAP,
    ItemIndex,
    find_contamination,
    question_and_answer,
    words_of,
)

SF = "/root/testdata/sf0.01"


def plain_overlap(side, words):
    n = min(GRAM, len(side))
    there = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    own = {tuple(side[i : i + n]) for i in range(len(side) - n + 1)}
    return len(own & there) / len(own)


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    sides = {r.item_id: question_and_answer(r.text) for r in items.collect()}
    expected = set()
    for r in docs.collect():
        words = words_of(r.text)
        for item, both in sides.items():
            if all(plain_overlap(s, words) >= LEAST_OVERLAP for s in both):
                expected.add((r.doc_id, item))
    found = find_contamination(docs, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected and expected


def test_passages_equal_exhaustive_scores():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(3, 150)))) for i in range(70)]
    texts = [draw.choices(words, k=draw.randint(0, 400)) for _ in range(30)]
    texts += [t + words_of(items[i][1]) + t for i, t in enumerate(texts[:20])]
    frequency = {w: draw.randint(1, 50) for w in words}
    index = ItemIndex(items, frequency, 100)
    weights = [dict() for _ in index.parts]
    for t, found in enumerate(index.postings):
        for e, x in found:
            weights[e][t] = x
    expected = set()
    for i, text in enumerate(texts):
        for c in range(-(-len(text) // CELL)):
            terms = {index.number.get(w) for w in text[c * CELL : (c + CELLS) * CELL]}
            for e, own in enumerate(weights):
                if sum(x for t, x in own.items() if t in terms) >= 1 - 1e-9:
                    expected.add((i, e, c))
    found = {(t, e, c) for t, e, _, c in index.hits(texts)}
    assert found == expected and len(expected) > 20
    assert np.isfinite([s for _, _, s, _ in index.hits(texts)]).all()


def test_changed_and_partial_copies(spark):
    words = [f"word{i}" for i in range(60)]
    item = " ".join(words[:40]) + ".\n" + " ".join(words[40:]) + "."
    filler = " ".join(f"other{i}" for i in range(500))
    changed = " ".join("x" if i in (10, 50) else w.upper() for i, w in enumerate(words))
    rows = [(1, f"{filler} {item} {filler}"), (2, changed), (3, " ".join(words[:40])), (4, filler)]
    rows += [(5, f"{filler} {' '.join(words[:20])}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(9, item), (10, None), (11, "")], "item_id int, text string")
    found = find_contamination(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 9), (2, 9)]


def test_awkward_rows(spark):
    items = spark.createDataFrame([(1, "A plain text of a few words, nothing more.")], "item_id long, text string")
    found = find_contamination(awkward(spark), items)
    assert sorted(r.doc_id for r in found.collect()) == [1, 1, 6]
    assert find_contamination(empty(spark), items).collect() == []
    assert find_contamination(awkward(spark), items.limit(0)).collect() == []
