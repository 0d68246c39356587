"""The stored index: equal to scoring every text, reads only what a query asks for, survives dead runs."""

import math
import random
import re

import pytest

from stallkeeper.operators.text_index import B, K1, TextIndex

ROWS = "doc_id long, text string"


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def made_texts():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(draw.choices(vocabulary, k=draw.randrange(1, 80))) for i in range(120)}
    texts |= {200: None, 201: "", 202: "!!", 203: "W1-w2 w1;w2 É", 204: texts[5], 205: "w1 " * 3000}
    return texts


def bm25(texts, query):
    cut = {k: tokens(t) for k, t in texts.items()}
    mean = sum(map(len, cut.values())) / len(cut)
    scores, matched = {}, {}
    for word in set(tokens(query)):
        holders = [k for k, ws in cut.items() if word in ws]
        rarity = math.log(1 + (len(cut) - len(holders) + 0.5) / (len(holders) + 0.5))
        for k in holders:
            times = cut[k].count(word)
            damped = times + K1 * (1 - B + B * len(cut[k]) / mean)
            scores[k] = scores.get(k, 0) + rarity * times * (K1 + 1) / damped
            matched[k] = matched.get(k, 0) + 1
    return sorted(((round(s, 6), -k, matched[k]) for k, s in scores.items()), reverse=True)


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    """Three generations, one of them without rows; a row without a key."""
    made = TextIndex(spark, str(tmp_path_factory.mktemp("index")))
    rows = list(made_texts().items())
    made.add(spark.createDataFrame(rows[:70], ROWS), "a")
    made.add(spark.createDataFrame([*rows[70:], (None, "w1 w2")], ROWS), "b", parts=3)
    made.add(spark.createDataFrame([], ROWS), "none")
    return made


def test_scores_equal_brute_force(index):
    texts = made_texts()
    for query in ("w1 w2 w1", "W7", "w3, w4; w5 é unknown"):
        found = [(r.score, -r.key, r.matched) for r in index.ranked(query, 1000).collect()]
        wanted = bm25(texts, query)
        assert [f[1:] for f in found] == [w[1:] for w in wanted]
        assert [f[0] for f in found] == pytest.approx([w[0] for w in wanted], abs=2e-6)
        assert [r.key for r in index.ranked(query, 3).collect()] == [-w[1] for w in wanted[:3]]
    every = {r.key for r in index.ranked("w1 w2", 1000, every_word=True).collect()}
    assert every == {k for k, t in texts.items() if {"w1", "w2"} <= set(tokens(t))}


def test_phrases_equal_brute_force(index):
    for phrase in ("w1 w2", "w1 w1", "w3", "w1 w2 w1 w2", "w9 w8 w7"):
        ws, wanted = tokens(phrase), {}
        for k, t in made_texts().items():
            own = tokens(t)
            at = [i for i in range(len(own)) if own[i : i + len(ws)] == ws]
            if at:
                wanted[k] = (len(at), at[0])
        found = {r.key: (r.occurrences, r.first_position) for r in index.phrase(phrase).collect()}
        assert found == wanted


@pytest.mark.parametrize("query", ("", "?!", "unknown"))
def test_queries_that_find_nothing(index, query):
    assert index.ranked(query).count() == 0 and index.phrase(query).count() == 0


def test_an_empty_index_finds_nothing(spark, folder):
    empty = TextIndex(spark, f"{folder}/none")
    assert empty.ranked("w1").count() == 0 and empty.phrase("w1 w2").count() == 0


def test_only_buckets_of_the_query_are_read(index):
    postings = index.postings({"w1"})
    postings.collect()
    scan = postings._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() <= 2  # one for each generation with rows
    assert len(postings.inputFiles()) > 2 * 10  # of all buckets
    plan = index.ranked("w1")._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(word,w1)" in plan or "In(word, [w1])" in plan
    assert "Python" not in plan and "ArrowEval" not in plan


def test_unfinished_generations_do_not_count_and_reruns_replace(spark, folder):
    index = TextIndex(spark, folder)
    index.add(spark.createDataFrame([(1, "old words")], ROWS), "run")
    index.add(spark.createDataFrame([(2, "old new words")], ROWS), "run")  # the same run again
    index.add(spark.createDataFrame([(3, "words of a dead run")], ROWS), "dead")
    from stallkeeper.sources.storage import remove

    remove(spark, f"{folder}/totals/generation=dead")
    assert [r.key for r in index.ranked("words").collect()] == [2]
    assert [(r.key, r.first_position) for r in index.phrase("new words").collect()] == [(2, 1)]
    assert index.totals().select("documents", "words").collect() == [(1, 3)]
    index.add(spark.createDataFrame([(3, "words")], ROWS), "dead")
    assert [r.key for r in index.ranked("words").collect()] == [3, 2]
