import numpy as np
from pyspark.sql import functions as F

from cases import awkward, empty
from stallkeeper.llm.language import (
    ByteNetwork,
    fit_language,
    letter_runs,
    padded,
    predict_language,
)
from stallkeeper.llm.queries import op7_language


def test_gradients_equal_differences():
    network = ByteNetwork(["a", "b", "c"])
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    symbols, mask = padded(["abc", "xyz", "übe"[:2]])
    labels = np.array([0, 2, 1])
    _, g = network.gradients(symbols, mask, labels)
    draw = np.random.default_rng(0)
    for name, value in network.p.items():
        used = np.argwhere(g[name] != 0)
        for at in used[draw.choice(len(used), min(4, len(used)), replace=False)]:
            at, step = tuple(at), 1e-3
            old = value[at]
            losses = []
            for x in (old + step, old - step):
                value[at] = x
                losses.append(network.gradients(symbols, mask, labels)[0])
            value[at] = old
            slope = (losses[0] - losses[1]) / (2 * step)
            assert np.isclose(g[name][at], slope, rtol=2e-2, atol=2e-5), name


def test_word_scores_do_not_depend_on_company():
    network = ByteNetwork(["a", "b"])
    words = ["one", "a", "longerword", "ü"]
    together = network.word_scores(words)
    alone = np.concatenate([network.word_scores([w]) for w in words])
    assert np.allclose(together, alone, atol=1e-5)


def test_letter_runs():
    assert letter_runs("Ab1c ½x_y") == ["ab", "c", "x", "y"]
    assert letter_runs("a" * 70) == ["a" * 32, "a" * 32, "a" * 6]
    assert letter_runs(None) == [] and letter_runs("12 ½") == []


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = op7_language(spark, sf_dir).where("held_out").join(docs, "doc_id")
    right = found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.97


def test_awkward_rows(spark):
    rows = awkward(spark)
    labels = rows.select(F.col("doc_id").alias("id"), "text", (F.col("doc_id") % 2).cast("string").alias("lang"))
    network = fit_language(labels, steps=5)
    found = predict_language(rows, network)
    assert sorted(found.columns) == sorted(rows.columns)
    for r in found.collect():
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und") != letters and 0 <= r.score <= 1
    assert fit_language(labels.limit(0)) is None
    assert {r.lang_pred for r in predict_language(rows, None).collect()} == {"und"}
    assert predict_language(empty(spark), network).collect() == []
