"""Triage, sampling, search and labels for people who annotate listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from stallkeeper.plans.stages import Stage, scratch, stages_in


def shuffled_order(key: str, seed: int) -> Column:
    """Pseudo-random order that any engine with MD5 can reproduce."""
    return F.md5(F.concat_ws("~", F.col(key).cast("string"), F.lit(str(seed))))


def topics(
    df: DataFrame,
    key: str,
    text: str = "text",
    k: int = 8,
    seed: int = 42,
    max_iter: int = 10,
    stage: Stage | None = None,
) -> DataFrame:
    """Most likely topic per row (online LDA) and its weight.

    Words are hashed, so no vocabulary is collected and none is cut. The texts are cut into words
    once; every iteration reads the staged counts of every text.
    """
    cut = [
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"\W+", minTokenLength=3),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=1 << 16),
    ]
    lda = LDA(
        k=k,
        seed=seed,
        maxIter=max_iter,
        subsamplingRate=1.0,
        featuresCol="_counts",
        topicDistributionCol="_topics",
    )
    prepared = df.select(key, F.coalesce(text, F.lit("")).alias("_text"))
    stage = stage or stages_in(scratch(df.sparkSession))
    counts = stage(PipelineModel(cut).transform(prepared).select(key, "_counts"), "counts")
    weights = lda.fit(counts).transform(counts)
    mix = weights.select(key, vector_to_array("_topics").alias("mix"))
    return mix.select(
        key,
        (F.array_position("mix", F.array_max("mix")) - 1).cast("int").alias("topic"),
        F.array_max("mix").alias("weight"),
    )


def label_sample(df: DataFrame, group: str, key: str, quota: int, seed: int = 42) -> DataFrame:
    """``quota`` rows per group to be labelled. Spark cuts each task to the quota before shuffling."""
    order = Window.partitionBy(group).orderBy(shuffled_order(key, seed), key)
    return df.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= quota).drop("_at")


def keyword_search(
    df: DataFrame, key: str, keywords: Sequence[str], text: str = "text", limit: int = 20
) -> DataFrame:
    """Top rows by number of keyword occurrences, any case; ``matches`` holds the number."""
    lowered = F.lower(F.coalesce(text, F.lit("")))

    def occurrences(word: str) -> Column:
        without = F.replace(lowered, F.lit(word), F.lit(""))
        return ((F.length(lowered) - F.length(without)) / len(word)).cast("int")

    matches = sum((occurrences(word.lower()) for word in keywords if word), F.lit(0))
    found = df.withColumn("matches", matches).filter(F.col("matches") > 0)
    return found.orderBy(F.desc("matches"), key).limit(limit)


def random_search(df: DataFrame, key: str, limit: int = 20, seed: int = 42) -> DataFrame:
    """Repeatable random rows."""
    return df.orderBy(shuffled_order(key, seed), key).limit(limit)


def vector_search(
    df: DataFrame, key: str, query: Sequence[float], vector: str = "embedding", limit: int = 10
) -> DataFrame:
    """Rows whose vector is most similar (cosine) to the query image's vector.

    The query travels as a literal and the sort keeps ``limit`` rows per task, so nothing but the
    candidates of each task is moved.
    """
    norm = sum(float(x) * float(x) for x in query) ** 0.5
    literal = F.array(*(F.lit(float(x)) for x in query))

    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    own = F.col(vector)
    similarity = F.try_divide(dot(own, literal), F.sqrt(dot(own, own)) * F.lit(norm))
    scored = df.select(key, similarity.alias("similarity"))
    return scored.orderBy(F.desc("similarity"), key).limit(limit)


def latest_labels(labels: DataFrame, key: str, when: str) -> DataFrame:
    """The newest label row per item; older ones are history. Of equal times the greater row counts."""
    rest = [when, *(c for c in labels.columns if c not in (key, when))]
    newest = labels.groupBy(key).agg(F.max(F.struct(*rest)).alias("_newest"))
    return newest.select(key, "_newest.*").select(*labels.columns)


def with_labels(rows: DataFrame, labels: DataFrame, key: str, when: str) -> DataFrame:
    """Rows with their latest label, NULL where nobody has labelled them yet."""
    return rows.join(latest_labels(labels, key, when), key, "left")
