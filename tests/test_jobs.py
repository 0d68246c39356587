"""Whole jobs: batch runs, reruns, backfill, streams, partition independence."""

import pytest
from pyspark.sql import functions as F

from stallkeeper.operators.classify import classify_text, run_task, train_text_classifier, zero_shot
from stallkeeper.plans import sample_crawl
from stallkeeper.plans.batch import Inputs, Job, backfill, export_csv, read_listings, read_manifest, run_all, run_batch
from stallkeeper.plans.listings import build_listings
from stallkeeper.sources.history import TextHistory
from stallkeeper.plans.queries import write_archives
from stallkeeper.plans.stages import stages_in
from stallkeeper.streaming.dedup import dedup_stream
from stallkeeper.streaming.ingest import ingest_stream


@pytest.fixture
def archive(spark, tmp_path):
    """Writes pages, given as (url, html), as one archive of a crawler folder."""
    import base64
    import json
    import zlib

    def write(name, *pages, date=None):
        folder = tmp_path / "in" / (f"{date}/shop" if date else "shop") / "data_pages"
        folder.mkdir(parents=True, exist_ok=True)
        lines = [
            json.dumps({"url": u, "content": base64.b64encode(h.encode()).decode(), "fetch_time": 1676048703245})
            for u, h in pages
        ]
        (folder / f"{name}.deflate").write_bytes(zlib.compress("\n".join(lines).encode()))

    return write


def job_in(tmp_path, **options):
    return Job(str(tmp_path / "in"), str(tmp_path / "out"), "shop", **options)


def page(title, text, image=""):
    extra = f'<meta property="og:image" content="{image}">' if image else ""
    return f"<title>{title}</title>{extra}<p>{text}</p>"


def titles(spark, job):
    return sorted(r["title"] for r in read_listings(spark, job).collect())


URL = "https://a.com/itm/"


def test_runs_are_incremental_and_repeatable(spark, tmp_path, archive):
    job = job_in(tmp_path)
    archive("1", (URL + "1", page("one", "x")), (URL + "2", page("two", "y")))
    first = run_batch(spark, job)
    assert first and run_batch(spark, job) is None
    # A later archive repeats the text of page one under another address and adds a page.
    archive("2", (URL + "3", page("one", "x")), (URL + "4", page("four", "z")))
    second = run_batch(spark, job)
    assert second not in (None, first)
    assert titles(spark, job) == ["four", "one", "two"]
    assert read_manifest(spark, job).count() == 2


def test_nothing_to_do_without_archives(spark, tmp_path):
    assert run_all(spark, job_in(tmp_path)) == []


@pytest.mark.parametrize("spread", [None, 2])
def test_an_empty_archive_is_done_once(spark, tmp_path, archive, spread):
    job = job_in(tmp_path, spread=spread)
    archive("1")
    rules = sample_crawl.rules(spark)
    assert len(run_all(spark, job, Inputs(rules=rules))) == 1
    assert read_listings(spark, job).count() == 0 and read_manifest(spark, job).count() == 1


def test_an_empty_archive_in_a_stream(spark, tmp_path, archive):
    job = job_in(tmp_path)
    archive("1")
    ingest_stream(spark, job).awaitTermination()
    archive("2", (URL + "1", page("one", "x")))
    ingest_stream(spark, job).awaitTermination()
    assert titles(spark, job) == ["one"]


def test_files_per_run_leaves_the_rest_for_the_next_run(spark, tmp_path, archive):
    job = job_in(tmp_path, files_per_run=1)
    for i in range(3):
        archive(str(i), (f"{URL}{i}", page(f"t{i}", str(i))))
    assert len(run_all(spark, job)) == 3
    assert titles(spark, job) == ["t0", "t1", "t2"]


def test_a_run_that_died_leaves_no_trace(spark, tmp_path, archive):
    """Output and text keys without manifest rows count for nobody, and the rerun is complete."""
    job = job_in(tmp_path)
    archive("1", (URL + "1", page("one", "x")))
    run_id = run_batch(spark, job)
    history = TextHistory(spark, job.table("seen_text"))
    history.write(spark.read.parquet(f"{history.path}/keys/generation={run_id}"), "dead")
    manifest = job.table("manifest")
    import shutil

    shutil.move(manifest, str(tmp_path / "manifest_before"))
    assert titles(spark, job) == []
    assert run_batch(spark, job).split("-")[0] == run_id.split("-")[0]
    assert titles(spark, job) == ["one"]


def test_merge_across_archives_follows_their_order(spark, tmp_path, archive):
    job = job_in(tmp_path, spread=3)
    archive("b", (URL + "1", page("later", "b")))
    archive("a", (URL + "1", "<p>a</p>"), (URL + "1", page("second", "c", "i.png")))
    run_all(spark, job)
    row = read_listings(spark, job).first()
    assert (row["title"], row["text"], row["image"]) == ("second", "a", "i.png")


def test_temporal_job_keeps_snapshots_apart(spark, tmp_path, archive):
    job = job_in(tmp_path, temporal=True)
    archive("1", (URL + "1", page("one", "x")), date="2023-01-01")
    archive("1", (URL + "1", page("one", "y")), date="2023-01-02")
    run_all(spark, job)
    assert sorted(r["snapshot"] for r in read_listings(spark, job).collect()) == ["2023-01-01", "2023-01-02"]
    export_csv(spark, job, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def test_backfill_replaces_plain_runs(spark, tmp_path, archive):
    archive("1", (URL + "1", page("one", "x", "i1")), (URL + "2", page("two", "y", "i2")))
    plain = job_in(tmp_path)
    run_all(spark, plain)
    assert read_listings(spark, plain).filter("image_path is not null").count() == 0
    fetched = spark.createDataFrame([("i1", "p")], "url string, path string")
    images = job_in(tmp_path, images=True, image_date="d", task="zero-shot-classification")
    backfill(spark, images, Inputs(fetched_images=fetched))
    found = {r["title"]: r for r in read_listings(spark, images).collect()}
    assert sorted(found) == ["one", "two"]
    assert found["one"]["image_path"] == f"images-d/{found['one']['id']}.png"
    assert found["two"]["image_path"] is None
    assert found["one"]["label_product"] == "a real animal"
    # A second backfill finds nothing to do, and the archives stay done.
    backfill(spark, images, Inputs(fetched_images=fetched))
    assert read_listings(spark, images).count() == 2 and run_batch(spark, images) is None


def test_stream_ingest_adds_only_what_is_new(spark, tmp_path, archive):
    job = job_in(tmp_path)
    archive("1", (URL + "1", page("one", "x")), (URL + "1", page("uno", "w")))
    ingest_stream(spark, job).awaitTermination()
    ingest_stream(spark, job).awaitTermination()
    assert titles(spark, job) == ["one"]
    archive("2", (URL + "2", page("two", "y")), (URL + "3", page("one", "x")))
    ingest_stream(spark, job).awaitTermination()
    assert titles(spark, job) == ["one", "two"]


def test_stream_dedup_remembers(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "d bigint, text string"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = dedup_stream(spark.readStream.schema(schema).parquet(source), "d")
        (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start(out)
            .awaitTermination()
        )
        return spark.read.parquet(out).count()

    assert arrive(*[(i, "hot") for i in range(50)], (100, "x")) == 2
    assert arrive((200, " HOT "), (201, "y"), (202, "x")) == 3


def test_listings_do_not_depend_on_the_partitioning(spark, sf_dir, tmp_path):
    lines = sample_crawl.crawl(spark, sf_dir)

    def rows(name, lines, partitions, salts):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        listings, _ = build_listings(
            lines.repartition(partitions),
            stages_in(str(tmp_path / name)),
            rules=sample_crawl.rules(spark),
            frames=sample_crawl.frames(spark, sf_dir),
            url_salts=salts,
        )
        return sorted(map(repr, listings.collect()))

    try:
        assert rows("one", lines, 1, 1) == rows("eight", lines, 8, 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_index_hits_join_the_crawl(spark, sf_dir, tmp_path):
    """A hit adds a listing, unless its text was crawled before it."""
    lines = sample_crawl.crawl(spark, sf_dir)
    crawled, _ = build_listings(lines, stages_in(str(tmp_path / "crawl")))
    text = crawled.orderBy("url").first()["text"]
    hits = spark.createDataFrame(
        [
            ("hits", 10**9, "https://b.com/itm/1", "T", "new text", "b.com", "2024-01-01T00:00:00.000+0000"),
            ("hits", 10**9 + 1, "https://b.com/itm/2", "T", text, "b.com", None),
            ("hits", 10**9 + 2, "https://b.com/itm/3", "T", "Result not found", "b.com", None),
        ],
        "snapshot string, page_order bigint, url string, title string, text string, domain string, retrieved string",
    )
    both, _ = build_listings(
        lines, stages_in(str(tmp_path / "both")), rules=sample_crawl.rules(spark), hits=hits
    )
    assert both.count() == crawled.count() + 1
    hit = both.filter("snapshot = 'hits'").first()
    assert (hit["url"], hit["title"], hit["price"]) == ("https://b.com/itm/1", "T", None)
    assert hit["retrieved_ts"].year == 2024


def test_a_url_with_a_third_of_all_pages(spark, tmp_path):
    import base64

    body = "concat('<title>t</title>', if(id % 3 = 0, '', '<meta property=\"og:title\" content=\"n\">'), id)"
    lines = spark.range(600).selectExpr(
        "'s' AS snapshot", "id AS page_order",
        "if(id % 3 = 0, 'https://a.com/itm/hot', concat('https://a.com/itm/', id)) AS url",
        f"base64(encode({body}, 'UTF-8')) AS content", "'text/html' AS content_type",
        "1676048703245 AS fetch_time", "CAST(NULL AS STRING) AS _corrupt",
    )
    listings, _ = build_listings(lines, stages_in(str(tmp_path)), url_salts=4)
    assert listings.count() == 401
    assert listings.filter("name = 'n'").count() == 400


# --- classifiers ------------------------------------------------------------------------------


def test_zero_shot_prefers_the_earlier_label_on_a_tie(spark):
    df = spark.createDataFrame([(1, "A TOY, a real animal"), (2, "nothing"), (3, None)], "k int, text string")
    found = {r["k"]: r for r in zero_shot(df).collect()}
    assert (found[1]["label_product"], found[1]["score_product"]) == ("a real animal", 1.0)
    assert (found[2]["label_product"], found[2]["score_product"]) == ("a real animal", 0.0)
    assert found[3]["score_product"] == 0.0


def test_zero_shot_with_a_scorer_of_the_callers(spark):
    df = spark.createDataFrame([("abc",)], "text string")

    def scorer(text, label, hypothesis):
        assert hypothesis == f"about {label}"
        return F.levenshtein(text, F.lit(label)).cast("double")

    found = zero_shot(df, labels=["abc", "xyz"], template="about {}", scorer=scorer).first()
    assert (found["label_product"], found["score_product"]) == ("xyz", 3.0)


def test_text_classifier_learns(spark, tmp_path):
    rows = [(i, "fur skull antler" if i % 2 else "plastic toy car", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, text string, truth int")
    model = train_text_classifier(df, str(tmp_path), label="truth", features=1 << 10)
    found = classify_text(df, model)
    assert found.filter("label <> truth").count() == 0
    assert found.filter("score < 0.5 or score > 1").count() == 0


def test_tasks(spark):
    df = spark.createDataFrame([(1, "toy")], "k int, text string")
    assert run_task(df, None) is df

    def constant(value):
        return lambda d: d.withColumns({"label": F.lit(value), "score": F.lit(1.0)})

    assert run_task(df, "text-classification", constant(1)).columns[-2:] == ["label", "score"]
    both = run_task(df, "both", constant(1)).columns
    assert both[-4:] == ["label", "score", "label_product", "score_product"]
    several = run_task(df, "multi-model", models={"a": constant(0), "b": constant(1)}).first()
    assert (several["label_a"], several["label_b"]) == (0, 1)
    with pytest.raises(ValueError):
        run_task(df, "unknown")
    with pytest.raises(ValueError):
        run_task(df, "both")
