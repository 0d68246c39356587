import numpy as np
from pyspark.sql import functions as F

from cases import awkward, empty
from stallkeeper.llm.queries import labelled, op3_quality
from stallkeeper.llm.common import table
from stallkeeper.llm.quality import features, fit_quality, isotonic, score_quality, statistics_of


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = table(spark, sf_dir, "labels")
    held_out = op3_quality(spark, sf_dir).where("held_out").join(labels, "doc_id")
    right = held_out.select(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right >= 0.95


def test_learnt_rows_are_not_held_out(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    import zlib

    ids = {r.id for r in labelled(docs, labels, "quality").collect()}
    assert ids == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}


def test_features_approximate_a_gaussian_kernel():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(60, len(statistics_of("a"))))
    z = features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * 4.0**2))
    assert np.abs(z @ z.T - exact).max() < 0.35 and np.abs(z @ z.T - exact).mean() < 0.06


def test_isotonic_rises_and_keeps_the_mean():
    weight, positive = np.array([2.0, 2, 2, 4]), np.array([1.0, 0, 2, 3])
    fitted = isotonic(weight, positive)
    assert (np.diff(fitted) >= 0).all()
    assert np.isclose((fitted * (weight + 0.5)).sum(), positive.sum() + 1)
    assert (isotonic(np.zeros(4), np.zeros(4)) == 0.5).all()


def test_awkward_rows(spark):
    rows = awkward(spark)
    labels = rows.select(F.col("doc_id").alias("id"), "text", (F.col("doc_id") % 2).alias("label"))
    model = fit_quality(labels)
    scored = score_quality(rows, model)
    assert sorted(scored.columns) == sorted(rows.columns)
    assert all(0 <= r.score <= 1 for r in scored.collect())
    nothing = fit_quality(labels.limit(0))
    assert {r.score for r in score_quality(rows, nothing).collect()} == {0.5}
    assert score_quality(empty(spark), model).collect() == []
