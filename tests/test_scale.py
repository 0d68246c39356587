"""Steps whose time or memory grew faster than the input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallkeeper.llm import near_duplicates
from stallkeeper.operators import search
from stallkeeper.operators.merge import merge_by_url
from stallkeeper.operators.parse import parse_pages
from stallkeeper.operators.text_index import TextIndex, word_positions
from stallkeeper.plans import batch, queries
from stallkeeper.plans.stages import stages_in
from stallkeeper.schemas import EVIDENCE
from stallkeeper.sources.tables import write_json_lines


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("files", (1, 3))
def test_a_feed_from_one_file_and_from_a_folder(spark, tmp_path, files):
    texts = [(i, f"text {i % 7}") for i in range(20)]
    made = spark.createDataFrame(texts, "doc_id long, text string").repartition(files)
    made.write.parquet(str(tmp_path / "documents.parquet" if files > 1 else tmp_path / "made"))
    if files == 1:
        part = next((tmp_path / "made").glob("*.parquet"))
        (tmp_path / "documents.parquet").write_bytes(part.read_bytes())
    found = queries.stream_dedup(spark, str(tmp_path))
    assert found.count() == found.distinct().count() == 7


@pytest.mark.parametrize("archives", (1, 40))
def test_lines_of_few_archives_are_dealt_out(spark, tmp_path, archives):
    folder = f"{tmp_path}/in/shop/data_pages"
    rows = spark.range(80, numPartitions=archives).select(
        F.concat(F.lit("https://x.com/itm/"), "id").alias("url"),
        F.base64(F.concat(F.lit("<title>t</title>text "), "id")).alias("content"),
        F.lit("text/html").alias("content_type"),
        F.lit(1).alias("fetch_time"),
    )
    write_json_lines(rows, folder, "deflate")
    job = batch.Job(f"{tmp_path}/in", f"{tmp_path}/out", "shop")
    chosen = batch.pending_files(spark, job).orderBy("source_file").collect()
    files = spark.createDataFrame(
        [(r["snapshot"], r["source_file"], i) for i, r in enumerate(chosen)],
        "snapshot string, source_file string, file_no long",
    )
    lines = batch.ordered_lines(spark, job, files, [r["path"] for r in chosen])
    assert ("hashpartitioning(page_order" in plan_of(lines)) == (archives == 1)
    assert lines.select("page_order").distinct().count() == 80
    batch.run_all(spark, job)
    assert batch.read_listings(spark, job).count() == 80
    assert batch.read_run_table(spark, job, "counters").agg(F.sum("kept")).first()[0] == 80


def test_pages_are_parsed_in_small_batches(spark):
    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        pages = spark.range(3000, numPartitions=1).select(
            F.lit("https://x.com/itm/1").alias("url"), F.lit("<title>t</title>text").alias("html")
        )
        found = [r.n for r in parse_pages(pages).mapInArrow(sizes, "n long").collect()]
        assert sum(found) == 3000 and max(found) <= 512
    finally:
        spark.conf.set(name, before)


def test_the_merge_carries_numbers_not_names_of_files(spark):
    rows = [("b", 1, "late"), ("a", 9, "early"), (None, 20, "first"), ("a", 2, None)]
    pages = spark.createDataFrame(rows, "source_file string, page_order long, name string")
    fields = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in EVIDENCE.fields}
    fields |= {"url": F.lit("u"), "snapshot": F.lit("all"), "text": F.concat(F.lit("text "), "name")}
    fields |= {c: F.col(c) for c in pages.columns}
    pages = pages.select(*(c.alias(n) for n, c in fields.items())).drop("has_text")
    for of, wanted in ((pages, "first"), (pages.filter("source_file IS NOT NULL"), "early")):
        merged = merge_by_url(of, ["source_file", "page_order"])
        assert merged.select("name", "text").collect() == [(wanted, f"text {wanted}")]
    minima = [line for line in plan_of(merged).splitlines() if "min(" in line]
    assert minima and not any("source_file" in line for line in minima)


def test_topics_cut_the_texts_once(spark, folder):
    staged, stage = [], stages_in(folder)

    def kept(rows, name):
        staged.append(name)
        return stage(rows, name)

    rows = spark.createDataFrame([(1, "some words here"), (2, None), (3, "other words")], "id long, text string")
    found = search.topics(rows, "id", k=2, max_iter=2, stage=kept)
    assert staged == ["counts"] and "counts" in plan_of(found) and "text#" not in plan_of(found)
    assert [r.id for r in found.orderBy("id").collect()] == [1, 2, 3]


def test_positions_of_a_word_leave_their_document_together(spark, folder):
    rows = [(1, ["a", "b", "a", ""]), (2, [""]), (2, ["b", "é", "b", ""])]
    found = word_positions(spark.createDataFrame(rows, "key long, words array<string>"))
    assert sorted(found.collect()) == [
        (1, "", [3], 3), (1, "a", [0, 2], 3), (1, "b", [1], 3),
        (2, "", [0], 0), (2, "", [3], 3), (2, "b", [0, 2], 3), (2, "é", [1], 3),
    ]
    index = TextIndex(spark, folder)
    index.add(spark.createDataFrame([(1, "b a"), (1, "a"), (2, "a a")], "doc_id long, text string"), "run")
    held = {(r.key): r.positions for r in index.postings({"a"}).collect()}
    assert held == {1: [0, 1], 2: [0, 1]}


def test_sketches_do_not_depend_on_how_many_are_made_at_once(monkeypatch):
    draw = np.random.default_rng(1)
    sets = [(np.unique(draw.integers(1, 2**63, n).astype(np.uint64)), None) for n in (1, 40, 500, 3)]
    sets = [(h, np.ones(len(h))) for h, _ in sets]
    sizes, one = [], near_duplicates._sketches
    monkeypatch.setattr(near_duplicates, "_sketches", lambda s, n: sizes.append(len(s)) or one(s, n))
    whole = near_duplicates.sketches(sets, 64)
    monkeypatch.setattr(near_duplicates, "AT_ONCE", 200)
    assert (near_duplicates.sketches(sets, 64) == whole).all() and sizes == [4, 3, 1]
