import hashlib
import os
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cases import AWKWARD
from stallkeeper.llm import queries, toxicity
from stallkeeper.llm.common import CLEANUP, give_back, new_stage, table
from stallkeeper.llm.queries import QUERIES, tokenizer_spec

SF = "/root/testdata/sf0.01"


def test_stages_and_queries():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality",
        "toxicity",
        "near_duplicates",
        "decontamination",
        "bpe",
    ]
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_whole_run(spark):
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r for r in table(spark, SF, "labels").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert 0.5 < len(found) / len(texts) < 1
    bad = [i for i, r in labels.items() if not r.quality]
    assert sum(i in found for i in bad) <= 0.05 * len(bad)
    assert len({texts[i] for i in found}) == len(found)
    library = Tokenizer.from_str(tokenizer_spec())
    for i in sorted(found)[::50]:
        ids = library.encode(texts[i], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[i].ids == ids and found[i].n_tokens == len(ids)
        assert found[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_stages_keep_the_columns_and_stand_awkward_rows(spark):
    documents = table(spark, SF, "documents")
    few = [(i, t, "en", "s", 0) for i, t in AWKWARD]
    odd = spark.createDataFrame(few, documents.schema)
    for docs in (odd, documents.limit(0)):
        for _, function in corpus_pipeline.STAGES[:-1]:
            result = function(spark, docs, SF)
            assert result.columns == documents.columns
            result.count()
        assert corpus_pipeline.encode(spark, docs, SF).count() == docs.count()
    kept = corpus_pipeline.drop_near_duplicates(spark, odd, SF)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted("1 2 3 4 5 7 8 None".split())


def test_rows_are_judged_by_id_and_text(spark):
    long_a, long_b = ("word%d " * 60) % tuple(range(60)), ("other%d " * 60) % tuple(range(60))
    rows = [(1, long_a), (1, long_b), (1, long_b), (2, long_b), (None, long_a), (None, "alone " * 9)]
    item = table(spark, SF, "benchmark").first()["text"]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'x' AS row_key", "1.5 AS score", "'y' AS evidence")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    found = sorted((str(r.doc_id), r.text[:5]) for r in kept.collect())
    assert found == [("1", "other"), ("1", "word0"), ("None", "alone")]
    leaked = docs.unionAll(docs.limit(1).selectExpr("NULL", f"'{item.replace(chr(39), '')}'", "'x'", "1.5", "'y'"))
    clean = corpus_pipeline.drop_contaminated(spark, leaked, SF)
    assert clean.count() == len(rows)
    judged = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert {(r.score, r.evidence) for r in judged.collect()} <= {(1.5, "y")}


def test_toxicity_learns_from_its_bytes_of_many_labels(spark, folder, monkeypatch):
    """Both bounds of the fit are passed: rows of labels, and bytes of the texts of these."""
    monkeypatch.setattr(queries, "MAX_LABELLED", 800)
    monkeypatch.setattr(toxicity, "MAX_BYTES", 2_000)
    models = []

    def fit(*given):
        models.append(toxicity.fit_toxicity(*given))
        return models[-1]

    monkeypatch.setattr(corpus_pipeline, "fit_toxicity", fit)
    docs = spark.range(8_000).select(F.col("id").alias("doc_id"), F.format_string("page %019d", "id").alias("text"))
    docs.select("doc_id", F.lit(0).alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, folder).count() == 8_000
    assert 30 <= sum(models[0].texts) <= 100  # three fourths of about 83, not of 640


def test_encoding_has_one_python_worker_per_task(spark):
    docs = spark.createDataFrame([(1, "a few words"), (2, None)], "doc_id long, text string")
    encoded = corpus_pipeline.encode(spark, docs, SF)
    assert encoded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: r.n_tokens > 0 for r in encoded.collect()} == {1: True, 2: False}


def test_a_stage_leaves_no_shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        tops = [d.getPath() for d in manager.localDirs()]
        return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}

    known, before = files(), spark.conf.get(CLEANUP)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    staged = new_stage(spark)(counted, "counted")
    end = time.time() + 10  # files are removed beside the query
    while files() - known and time.time() < end:
        time.sleep(0.1)
    assert not files() - known
    assert spark.conf.get(CLEANUP) == before
    assert sorted(r["count"] for r in staged.collect()) == [142] * 1 + [143] * 6


def test_free_memory_is_given_back():
    def resident():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"Anonymous: +(\d+)", f.read())[1]) / 1024

    if not os.path.exists("/proc/self/smaps_rollup"):
        pytest.skip("memory can't be read here")
    blocks = [np.ones(10_000) for _ in range(2000)]
    held = blocks[::200]  # lie between the others
    del blocks
    before = resident()
    give_back()
    assert resident() < before - 75
    assert len(held) == 10
