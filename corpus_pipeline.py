"""Documents to training data: five stages, each over all documents that the one before has kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result as
Parquet below the cluster's shared folder and reads it again as the next stage's documents. All
stages but the last return the columns of documents. SQL cannot state the stages (random features,
nearest neighbours, sketches), so there is none; tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stallkeeper.llm.bpe import bpe_decode, bpe_encode
from stallkeeper.llm.common import free_name, new_stage, row_key, table
from stallkeeper.llm.decontaminate import find_contamination
from stallkeeper.llm.near_duplicates import near_duplicates
from stallkeeper.llm.quality import fit_quality, score_quality
from stallkeeper.llm.queries import QUALITY_LEAST, TOXICITY_LEAST, labelled, tokenizer_spec
from stallkeeper.llm.toxicity import fit_toxicity, score_toxicity

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects.

    Each row is judged by its text; null and empty texts too, repeated rows alike. No column is touched.
    """
    score = free_name(docs, "score")
    model = fit_quality(labelled(docs, table(spark, sf_dir, "labels"), "quality"))
    scored = score_quality(docs, model, score=score)
    return scored.where(F.col(score) >= QUALITY_LEAST).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are more likely toxic than not.

    Each row is judged by its text; null and empty texts have no neighbours and the score of such, repeated
    rows are judged alike. No column is touched.
    """
    score, evidence = free_name(docs, "score"), free_name(docs, "evidence")
    model = fit_toxicity(labelled(docs, table(spark, sf_dir, "labels"), "toxic"), docs)
    scored = score_toxicity(docs, model, score=score, evidence=evidence)
    return scored.where(F.col(score) < TOXICITY_LEAST).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the least id, stays.

    A document is a row of an id and a text: rows equal in both are one document, different texts
    under one id are judged each, and so are texts without an id, which come last in their class. Null texts
    and texts without a word are no duplicates of others.
    """
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    classes = near_duplicates(keyed, key=key)
    lost = classes.where(F.col(key) != F.col("class_id")).select(key).distinct()
    kept = keyed.join(lost, key, "left_anti")
    if not keyed.groupBy(key).count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([key])
    return kept.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain a test item, whatever their ids."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    found = find_contamination(keyed, table(spark, sf_dir, "benchmark"), key=key)
    lost = new_stage(spark)(found.select(key).distinct(), "contaminated")
    return keyed.join(lost, key, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document that is left, a row for each; a null or empty text has none.

    ``decoded_sha256`` is of what the ids decode to. The ids are written in between: a task that encodes and
    decodes would have two Python workers, which stay beside the executor's JVM.
    """
    spec = tokenizer_spec()
    ids = new_stage(spark)(bpe_encode(docs, spec), "ids")
    encoded = bpe_decode(ids, spec)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = new_stage(spark)
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
