"""Classifier columns: text classification, zero-shot labelling, and the choice between them."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from stallkeeper.constants import ZERO_SHOT_LABELS, ZERO_SHOT_TEMPLATE

TASKS = ("text-classification", "zero-shot-classification", "both", "multi-model")

_ARTICLES = ("a", "an", "the")

# Scores a text against a label; the label comes with the sentence the template makes of it.
Scorer = Callable[[Column, str, str], Column]
# Adds ``label`` and ``score`` to a DataFrame with a ``text`` column.
TextClassifier = Callable[[DataFrame], DataFrame]


def words(text: Column) -> Column:
    return F.split(F.lower(text), "[^a-z]+")


def label_words(label: str) -> list[str]:
    return list(dict.fromkeys(w for w in label.lower().split() if w not in _ARTICLES))


def word_share(found: Column, label: str, hypothesis: str) -> Column:
    """Default scorer: share of the label's words, articles aside, among the text's words."""
    wanted = F.array(*(F.lit(w) for w in label_words(label)))
    hits = F.size(F.filter(wanted, lambda w: F.array_contains(found, w)))
    return hits / F.lit(float(len(label_words(label))))


def zero_shot(
    df: DataFrame,
    text: str = "text",
    labels: Sequence[str] = ZERO_SHOT_LABELS,
    template: str = ZERO_SHOT_TEMPLATE,
    scorer: Scorer | None = None,
) -> DataFrame:
    """Add ``label_product`` and ``score_product``: the best-scoring label, the earlier on a tie.

    The labels are a literal list, so scoring stays inside the row: no join, no shuffle. A scorer
    of the caller's own gets the text column; the default one gets the text's words.
    """
    base = df.withColumn("_input", F.col(text) if scorer else words(F.coalesce(text, F.lit(""))))
    score = scorer or word_share
    scored = F.array(
        *(
            F.struct(
                score(F.col("_input"), label, template.format(label)).alias("score"),
                F.lit(-at).alias("earlier"),
                F.lit(label).alias("label"),
            )
            for at, label in enumerate(labels)
        )
    )
    best = base.withColumn("_best", F.array_max(scored))
    return best.select(
        *df.columns,
        F.col("_best.label").alias("label_product"),
        F.col("_best.score").alias("score_product"),
    )


def train_text_classifier(
    examples: DataFrame,
    path: str,
    text: str = "text",
    label: str = "label",
    features: int = 1 << 16,
) -> PipelineModel:
    """Hashed word counts, IDF weights, logistic regression; the model is kept under ``path``.

    The texts are cut into words and hashed once; the counts are written below ``path``, and both
    fits, with all their passes, read those. The model is returned as read back: fresh from training
    it drags its summary, and with it the session, into every task.
    """
    cut = [
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"\W+"),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features),
    ]
    prepared = examples.select(
        F.coalesce(text, F.lit("")).alias("_text"), F.col(label).cast("double").alias("_label")
    )
    counts = PipelineModel(cut).transform(prepared).select("_counts", "_label")
    counts.write.mode("overwrite").parquet(f"{path}/counts")
    counts = examples.sparkSession.read.parquet(f"{path}/counts")
    idf = IDF(inputCol="_counts", outputCol="_features").fit(counts)
    regression = LogisticRegression(
        featuresCol="_features",
        labelCol="_label",
        predictionCol="_prediction",
        probabilityCol="_probability",
        rawPredictionCol="_raw",
        maxIter=20,
        regParam=0.01,
    ).fit(idf.transform(counts))
    PipelineModel([*cut, idf, regression]).write().overwrite().save(f"{path}/model")
    return PipelineModel.load(f"{path}/model")


def classify_text(df: DataFrame, model: PipelineModel, text: str = "text") -> DataFrame:
    """Add ``label`` (0 or 1) and ``score``, the probability the model gives that label."""
    scored = model.transform(df.withColumn("_text", F.coalesce(text, F.lit(""))))
    return scored.select(
        *df.columns,
        F.col("_prediction").cast("int").alias("label"),
        F.array_max(vector_to_array("_probability")).alias("score"),
    )


def _word_counts(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Occurrences of every word, by row or whatever ``keep`` names; combined before the shuffle."""
    cut = df.select(*keep, F.explode(words(F.coalesce(text, F.lit("")))).alias("word"))
    return cut.filter("word <> ''").groupBy(*keep, "word").agg(F.count(F.lit(1)).alias("n"))


def train_naive_bayes(
    examples: DataFrame, text: str = "text", label: str = "label"
) -> tuple[DataFrame, float]:
    """Multinomial naive Bayes for labels 0 and 1, one pass over the word counts.

    Gives ``word, weight`` with ``weight = log p(word | 1) - log p(word | 0)``, one added to every
    count, and the log odds of the labels. Words no example has weigh nothing.
    """
    own = examples.filter(F.col(label).isin(0, 1))
    ones, zeros = (F.count_if(F.col(label) == y).alias(f"n{y}") for y in (1, 0))
    n1, n0 = own.agg(ones, zeros).first()
    counts = _word_counts(own, text, label).groupBy("word").agg(
        *(F.sum(F.when(F.col(label) == y, F.col("n")).otherwise(0)).alias(f"n{y}") for y in (1, 0))
    )
    size = counts.agg(
        F.count(F.lit(1)).alias("v"), F.sum("n1").alias("all1"), F.sum("n0").alias("all0")
    )
    given = [F.log((F.col(f"n{y}") + 1) / (F.col(f"all{y}") + F.col("v"))) for y in (1, 0)]
    # ``size`` is one row.
    weights = counts.join(F.broadcast(size)).select("word", (given[0] - given[1]).alias("weight"))
    return weights, math.log(max(n1, 1) / max(n0, 1))


def classify_naive_bayes(
    df: DataFrame, model: tuple[DataFrame, float], key: str, text: str = "text"
) -> DataFrame:
    """``key``, ``label`` and ``score``, the probability of that label, of rows unique by ``key``.

    Only word counts meet the model; rows without a known word have the odds of the labels.
    """
    weights, odds = model
    found = _word_counts(df, text, key).join(weights, "word")
    sums = found.groupBy(key).agg(F.sum(F.col("n") * F.col("weight")).alias("_sum"))
    log_odds = F.coalesce("_sum", F.lit(0.0)) + F.lit(odds)
    return df.select(key).join(sums, key, "left").select(
        key,
        (log_odds > 0).cast("int").alias("label"),
        (1 / (1 + F.exp(-F.abs(log_odds)))).alias("score"),
    )


def run_task(
    df: DataFrame,
    task: str | None,
    classifier: TextClassifier | None = None,
    scorer: Scorer | None = None,
    models: Mapping[str, TextClassifier] | None = None,
) -> DataFrame:
    """Add the columns of ``task``; none without one.

    ``multi-model`` applies several classifiers and suffixes their columns with their names.
    """
    if task is None:
        return df
    if task not in TASKS:
        raise ValueError(f"unknown task {task!r}; one of {', '.join(TASKS)}")
    if task == "multi-model":
        if not models:
            raise ValueError("multi-model needs models")
        for name, model in models.items():
            df = model(df).withColumnsRenamed(
                {"label": f"label_{name}", "score": f"score_{name}"}
            )
        return df
    if task in ("text-classification", "both"):
        if classifier is None:
            raise ValueError(f"{task} needs a classifier")
        df = classifier(df)
    if task in ("zero-shot-classification", "both"):
        df = zero_shot(df, scorer=scorer)
    return df


def confusion(df: DataFrame, truth: str = "truth", predicted: str = "label") -> DataFrame:
    """Counts per true and predicted label."""
    return df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))


def evaluate(confusions: DataFrame, truth: str = "truth", predicted: str = "label") -> DataFrame:
    """Accuracy, precision, recall and F1 of label 1 from a confusion table."""

    def total(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("double")

    t, p = F.col(truth), F.col(predicted)
    sums = confusions.agg(
        total((t == 1) & (p == 1)).alias("tp"),
        total((t == 0) & (p == 1)).alias("fp"),
        total((t == 1) & (p == 0)).alias("fn"),
        total((t == 0) & (p == 0)).alias("tn"),
    )
    rates = sums.select(
        F.try_divide(F.expr("tp + tn"), F.expr("tp + tn + fp + fn")).alias("accuracy"),
        F.try_divide(F.col("tp"), F.expr("tp + fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.expr("tp + fn")).alias("recall"),
    )
    return rates.withColumn(
        "f1",
        F.try_divide(
            F.lit(2.0) * F.col("precision") * F.col("recall"), F.expr("precision + recall")
        ),
    )
