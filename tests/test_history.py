"""The history of texts, the commit log, and jobs whose files come in any order or at once."""

from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from stallkeeper.plans import batch
from stallkeeper.plans.batch import Inputs, pending_files, read_listings, read_manifest, run_all, run_files
from stallkeeper.plans.stages import stages_in
from stallkeeper.schemas import REPLACED
from stallkeeper.sources.commits import CommitLog
from stallkeeper.sources.history import BUCKETS, TextHistory, bloom, may_hold
from stallkeeper.sources.storage import create_new
from test_jobs import URL, archive, job_in, page  # noqa: F401


SAME = page("same", "same text")


def urls(spark, job):
    return sorted(r.url[-1] for r in read_listings(spark, job).collect())


def hashes(low, high):
    import hashlib

    return np.array([list(hashlib.sha256(str(i).encode()).digest()) for i in range(low, high)], np.uint8)


def test_filters_hold_all_keys_and_few_others():
    own, others = hashes(0, 3000), hashes(3000, 23_000)
    bits = bloom(own)
    assert may_hold(bits, own).all()
    assert may_hold(bits, others).mean() < 0.01
    assert len(bits) * 8 < 2 * 10 * len(own)


def keys(spark, low, high):
    key = F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("key")
    return spark.range(low, high).select(
        key, F.lit("all").alias("snapshot"), F.lit("f").alias("source_file"),
        F.col("id").alias("page_order"), F.lit("u").alias("url"),
    )


def test_lookups_equal_a_join_and_new_texts_read_nothing(spark, folder):
    history = TextHistory(spark, f"{folder}/seen")
    names = [f"g{i}" for i in range(20)]
    for i, name in enumerate(names):
        history.write(keys(spark, 40 * i, 40 * i + 40), name)
    stage = stages_in(f"{folder}/work")

    def found(low, high, names, tag):
        rows = history.lookup(keys(spark, low, high), names, stage, tag)
        return sorted(r.page_order for r in rows.collect()), rows

    assert found(30, 55, names, "some")[0] == list(range(30, 55))
    assert found(30, 55, names[:1], "first")[0] == list(range(30, 40))  # generations that do not count
    assert found(30, 55, [], "none")[0] == []
    # Of 1600 new keys in 20 generations few pass the filters, and only their buckets would be read.
    asked = 1600
    assert found(5000, 5000 + asked, names, "fresh")[0] == []
    assert spark.read.parquet(f"{folder}/work/fresh").count() < 0.02 * asked * len(names)
    plan = found(30, 55, names, "plan")[1]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "PartitionFilters: [" in plan
    assert "generation" in plan.split("PartitionFilters: [")[1]
    assert history.compact(names, "whole")
    assert history.generations(names) == {"whole"}
    assert found(30, 55, names, "after")[0] == list(range(30, 55))
    assert history.generations([*names, "next"]) == {"whole", "next"}
    assert BUCKETS <= 256


def test_one_of_two_commits_wins_and_unfinished_ones_do_not_count(spark, folder):
    log = CommitLog(spark, f"{folder}/log", REPLACED)
    assert log.version() == 0 and log.read().count() == 0
    assert log.put(1, [{"old": "a", "new": "x"}])
    assert not log.put(1, [{"old": "b", "new": "y"}])
    assert log.put(2, [{"old": "b", "new": "y", "seq": 7}])
    assert create_new(spark, f"{folder}/log/{3:012d}.json", '{"old": "c", "new": "z"}\n')
    assert log.version() == 3
    assert sorted(tuple(r) for r in log.read().collect()) == [("a", "x", 1), ("b", "y", 7)]
    assert log.read(1).count() == 1


def test_two_jobs_that_commit_at_once(spark, tmp_path, archive, monkeypatch):  # noqa: F811
    """Another job commits between the snapshot of a run and its own commit."""
    job = job_in(tmp_path)
    archive("1", (URL + "1", page("one", "x")), (URL + "3", SAME))
    archive("2", (URL + "1", page("one again", "y", "i.png")), (URL + "2", SAME))
    files = {r.source_file.rsplit("/", 1)[1]: r for r in pending_files(spark, job).collect()}
    put, tried = CommitLog.put, []

    def interrupted(log, version, rows):
        if not tried:
            tried.append(version)
            assert run_files(spark, job, Inputs(), [files["1.deflate"]])
        return put(log, version, rows)

    monkeypatch.setattr(CommitLog, "put", interrupted)
    assert run_files(spark, job, Inputs(), [files["2.deflate"]])
    assert read_manifest(spark, job).select("seq").distinct().count() == 2
    assert urls(spark, job) == ["1", "3"]  # of one text the page in the first file
    row = read_listings(spark, job).filter(F.col("url") == URL + "1").first()
    assert row.title == "one" and row.image == "i.png"  # merged from both
    # A run over files that another job has committed meanwhile is given up.
    assert run_files(spark, job, Inputs(), [files["1.deflate"]]) is None
    assert read_manifest(spark, job).count() == 2


def test_listings_do_not_depend_on_the_order_of_arrival(spark, tmp_path, archive):  # noqa: F811
    archive("a", (URL + "1", SAME), (URL + "4", page("four", "own")))
    archive("b", (URL + "2", SAME), (URL + "4", page("later", "other")))
    archive("c", (URL + "3", SAME), (URL + "2", page("two c", "third")))
    found = []
    for order in ("abc", "cba", "bca"):
        job = replace(job_in(tmp_path), output_root=str(tmp_path / f"out_{order}"))
        files = {r.source_file.rsplit("/", 1)[1][0]: r for r in pending_files(spark, job).collect()}
        for name in order:
            run_files(spark, job, Inputs(), [files[name]])
        found.append(sorted((r.url[-1], r.title) for r in read_listings(spark, job).collect()))
    assert found[0] == [("1", "same"), ("2", "two c"), ("4", "four")]
    assert found == [found[0]] * 3


def test_generations_are_put_together(spark, tmp_path, archive, monkeypatch):  # noqa: F811
    monkeypatch.setattr(batch, "GENERATIONS", 1)
    job = job_in(tmp_path, files_per_run=1)
    archive("1", (URL + "1", SAME))
    archive("2", (URL + "2", SAME))
    run_all(spark, job)
    runs = {r.run_id for r in read_manifest(spark, job).collect()}
    assert len(runs) == 2
    assert len(TextHistory(spark, job.table("seen_text")).generations(runs)) == 1
    archive("3", (URL + "3", SAME), (URL + "5", page("five", "y")))
    run_all(spark, job)
    assert urls(spark, job) == ["1", "5"]
    assert not list((tmp_path / "out").glob("_pending/*"))


def test_a_run_opens_the_evidence_of_runs_that_share_an_address_only(spark, tmp_path, archive, monkeypatch):  # noqa: F811
    job = job_in(tmp_path, files_per_run=1)
    for name in "1234":
        archive(name, (URL + name, page(f"title {name}", f"text {name}")))
    run_all(spark, job)
    manifest = read_manifest(spark, job)
    run_of = {r.source_file.rsplit("/", 1)[1][0]: r.run_id for r in manifest.collect()}
    stage = stages_in(str(tmp_path / "work"))

    def met(tag, *names):
        rows = spark.createDataFrame([("all", URL + n) for n in names], "snapshot string, url string")
        found = batch.earlier_evidence(spark, job, batch.with_address_key(rows), manifest, stage, tag)
        return found, sorted(r.run_id for r in found.collect())

    assert met("two", "2", "4", "9")[1] == sorted((run_of["2"], run_of["4"]))
    found, runs = met("new", "8", "9")
    assert runs == [] and "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    plan = met("plan", "3")[0]._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert run_of["3"] in filters and not any(run_of[n] in filters for n in "124")
    # A generation that stands for several runs still names each.
    monkeypatch.setattr(batch, "GENERATIONS", 1)
    assert batch.compact_history(spark, job)
    assert met("after", "1", "4")[1] == sorted((run_of["1"], run_of["4"]))
    # The evidence of an earlier run is merged with that of a later one.
    archive("5", (URL + "2", page("later title", "other text", "i.png")), (URL + "5", page("five", "5")))
    run_all(spark, job)
    row = read_listings(spark, job).filter(F.col("url") == URL + "2").first()
    assert row.title == "title 2" and row.image == "i.png"
