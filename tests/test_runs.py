"""Runs: how files are cut into them, files that fail, batch and stream over one output."""

import pytest
from pyspark.sql import functions as F

from stallkeeper.operators import extract, lookup
from stallkeeper.operators.search import keyword_search, latest_labels
from stallkeeper.plans.batch import (
    Inputs,
    backfill,
    read_listings,
    read_manifest,
    read_run_table,
    run_all,
    run_batch,
)
from stallkeeper.sources.index import holds_phrase
from stallkeeper.streaming.ingest import ingest_stream
from test_jobs import URL, archive, job_in, page, titles  # noqa: F401


def rows_of(spark, job):
    columns = ["url", "id", "title", "text", "image", "name"]
    return sorted(map(tuple, read_listings(spark, job).select(*columns).collect()), key=repr)


def write_four(archive):
    """Addresses and texts that come again in later archives."""
    archive("a", (URL + "1", "<p>first</p>"), (URL + "2", page("two", "b")))
    archive("b", (URL + "1", page("late title", "c", "i.png")), (URL + "3", page("three", "b")))
    archive("c", (URL + "3", page("three", "d")), (URL + "1", page("later title", "e", "j.png")))
    archive("d", (URL + "4", page("two", "b")), (URL + "2", page("zwei", "f", "k.png")))


def test_the_cut_into_runs_does_not_matter(spark, tmp_path, archive):  # noqa: F811
    write_four(archive)
    found = []
    for cap in (1, 2, 10):
        job = job_in(tmp_path, files_per_run=cap)
        job = type(job)(job.input_root, f"{tmp_path}/out{cap}", "shop", files_per_run=cap)
        assert len(run_all(spark, job)) == {1: 4, 2: 2, 10: 1}[cap]
        found.append(rows_of(spark, job))
    for cap in (1, 3):
        job = type(job)(job.input_root, f"{tmp_path}/stream{cap}", "shop")
        ingest_stream(spark, job, files_per_trigger=cap).awaitTermination()
        found.append(rows_of(spark, job))
    assert all(rows == found[0] for rows in found[1:])
    by_url = {r[0]: r for r in found[0]}
    assert by_url[URL + "1"][2:5] == ("late title", "first", "i.png")
    assert by_url[URL + "2"][2:5] == ("two", "twob", "k.png")
    assert by_url[URL + "3"][2:4] == ("three", "threeb") and URL + "4" not in by_url


@pytest.mark.parametrize("broken", ["cut", "garbage"])
def test_files_that_cannot_be_read_stay_pending(spark, tmp_path, archive, broken):  # noqa: F811
    job = job_in(tmp_path)
    archive("1", (URL + "1", page("one", "x")))
    archive("2", *[(f"{URL}9{i}", page(f"t{i}", f"text {i} " * 30)) for i in range(200)])
    file = tmp_path / "in/shop/data_pages/2.deflate"
    whole = file.read_bytes()
    file.write_bytes(whole[: len(whole) // 2] if broken == "cut" else b"no stream at all")
    (tmp_path / "in/shop/data_pages/.2.deflate.crc").unlink(missing_ok=True)
    assert len(run_all(spark, job)) == 1
    assert titles(spark, job) == ["one"] and read_manifest(spark, job).count() == 1
    failed = read_run_table(spark, job, "failed").collect()
    assert [r.source_file.rsplit("/", 1)[1] for r in failed] == ["2.deflate"] and failed[0].error
    file.write_bytes(whole)
    assert len(run_all(spark, job)) == 1
    assert len(titles(spark, job)) == 201
    assert read_run_table(spark, job, "failed").count() == 0


def test_stream_after_batch_and_new_checkpoints_lose_nothing(spark, tmp_path, archive):  # noqa: F811
    import shutil

    job = job_in(tmp_path)
    archive("1", (URL + "1", page("one", "x")))
    run_all(spark, job)
    ingest_stream(spark, job).awaitTermination()
    assert titles(spark, job) == ["one"]
    archive("2", (URL + "2", page("two", "y")))
    ingest_stream(spark, job).awaitTermination()
    shutil.move(job.table("_checkpoint"), str(tmp_path / "lost"))
    archive("3", (URL + "3", page("three", "z")))
    ingest_stream(spark, job).awaitTermination()
    assert titles(spark, job) == ["one", "three", "two"]
    assert run_batch(spark, job) is None and read_manifest(spark, job).count() == 3


def test_a_rerun_with_fewer_rows_keeps_none_of_the_dead_attempt(spark, tmp_path, archive):  # noqa: F811
    import shutil

    job = job_in(tmp_path, temporal=True)
    archive("1", (URL + "1", page("one", "x")), date="d1")
    archive("2", (URL + "2", page("two", "y")), date="d2")
    run_all(spark, job)
    shutil.move(job.table("manifest"), str(tmp_path / "manifest_before"))
    archive("2", (URL + "2", "<p>no title</p>"), date="d2")
    run_all(spark, job)
    assert titles(spark, job) == ["one"]
    assert not list((tmp_path / "out").glob("_stages/*"))


def test_columns_of_several_models_can_be_read_and_survive_a_backfill(spark, tmp_path, archive):  # noqa: F811
    archive("1", (URL + "1", page("one", "x", "i")))
    job = job_in(tmp_path, task="multi-model")

    def always(value):
        return lambda df: df.withColumns({"label": F.lit(value), "score": F.lit(0.5)})

    run_all(spark, job, Inputs(models={"a": always(0), "b": always(1)}))
    row = read_listings(spark, job).first()
    assert (row["label_a"], row["label_b"]) == (0, 1)
    images = job_in(tmp_path, images=True, task="zero-shot-classification")
    fetched = spark.createDataFrame([("i", "p")], "url string, path string")
    backfill(spark, images, Inputs(fetched_images=fetched))
    row = read_listings(spark, images).first()
    assert (row["label_a"], row["label_b"]) == (0, 1) and row["image_path"] and row["label_product"]


def test_index_hits_and_phrases_of_a_job(spark, tmp_path, archive):  # noqa: F811
    archive("1", (URL + "1", page("one", "x")), (URL + "2", page("two", "sold out")))
    hits = spark.createDataFrame(
        [("all", -1, URL + "5", "hit", "new", "a.com", None), ("all", -2, URL + "6", "h", "sold out", "a.com", None)],
        "snapshot string, page_order bigint, url string, title string, text string, domain string, retrieved string",
    )
    job = job_in(tmp_path, phrases=("sold out",))
    run_all(spark, job, Inputs(hits=hits))
    assert titles(spark, job) == ["hit", "one"]


def test_only_hot_keys_are_salted(spark):
    rows = spark.range(900).selectExpr("id", "if(id % 3 = 0, 'hot', if(id % 3 = 1, string(id), null)) AS key")
    table = spark.range(900).selectExpr("if(id = 0, 'hot', string(id)) AS key", "id AS value")
    found = lookup.lookup(rows, table, "key", ["id"], broadcast_bytes=0, hot_rows=50)
    plain = rows.join(table, "key", "left").select("id", "key", "value")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    copies = table.count() + lookup.SALTS - 1
    generated = []

    def walk(node):
        if node.nodeName() == "Generate":
            generated.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            walk(node.plan())

    walk(found._jdf.queryExecution().executedPlan())
    assert generated == [copies]


def test_bad_rules_are_left_out(spark):
    rules = spark.createDataFrame(
        [("shop", "name", "<b>(.*?)</b>"), ("shop", "seller", "(unclosed"), ("other", "name", "x")],
        "domain string, field string, pattern string",
    )
    pages = spark.createDataFrame([("shop", "<b>n</b>"), ("other", "x")], "site string, html string")
    found = extract.with_site_rules(pages, rules, sites=["shop"]).collect()
    records = {r.site: r.rule_candidate for r in found}
    assert records["shop"].name == "n" and records["shop"].seller is None and records["other"] is None


def test_ties_and_odd_keywords(spark):
    labels = spark.createDataFrame([(1, 0, 5), (1, 1, 5), (2, 1, 3), (2, 0, 9)], "k int, label int, at int")
    for rows in (labels, labels.orderBy(F.desc("label"))):
        assert sorted((r.k, r.label) for r in latest_labels(rows, "k", "at").collect()) == [(1, 1), (2, 0)]
    df = spark.createDataFrame([(1, "a+b a+b")], "k int, text string")
    assert keyword_search(df, "k", ["", "A+b"]).first().matches == 2
    assert df.select(holds_phrase(F.lit("x .a y"), ["b.a"])).first()[0] is False
    assert df.select(holds_phrase(F.lit("see b.a here"), ["b.a"])).first()[0] is True
