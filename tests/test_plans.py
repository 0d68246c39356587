"""What the plans have to look like."""

import pytest
from pyspark.sql import functions as F

from stallkeeper.operators import dedup, search
from stallkeeper.plans import queries, sample_crawl
from stallkeeper.plans.listings import merged_listings, parsed_pages
from stallkeeper.plans.stages import stages_in
from stallkeeper.sources import manifest


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def shuffled_joins(spark):
    """No broadcasts by size, as with tables that are large."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pages_are_parsed_once_and_after_the_cheap_filters(spark, sf_dir, tmp_path):
    lines = stages_in(str(tmp_path))(sample_crawl.crawl(spark, sf_dir), "lines")
    plan = plan_of(parsed_pages(lines))
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
    below = plan[plan.index("MapInArrow"):]
    assert "Contains(url" in below
    # The test of the address and of the content reaches the scan.
    pushed = below[below.index("PushedFilters"):]
    assert "StringContains(url,/itm/)" in pushed and "IsNotNull(content)" in pushed
    # The body is decoded in one projection, not again in a filter.
    filters = [line for line in below.splitlines() if "Filter" in line and "FileScan" not in line]
    assert all("unbase64" not in line for line in filters)


def test_listings_shuffle_pages_once_to_dedup_and_once_to_merge(spark, sf_dir, tmp_path):
    stage = stages_in(str(tmp_path))
    pages = stage(parsed_pages(sample_crawl.crawl(spark, sf_dir)), "pages")
    winners = stage(dedup.first_of_each_text(pages.select("text_key", "page_order"), "page_order"), "w")
    plan = plan_of(merged_listings(pages, winners, stage))
    # Both sides of the join on the page number, and the merge.
    assert plan.count("Exchange hashpartitioning") == 3
    assert "partial_min" in plan and "html" not in plan
    assert "Python" not in plan and "MapInArrow" not in plan


def test_page_text_stays_out_of_the_merge(spark, sf_dir, tmp_path):
    stage = stages_in(str(tmp_path))
    pages = stage(parsed_pages(sample_crawl.crawl(spark, sf_dir)), "pages")
    winners = stage(dedup.first_of_each_text(pages.select("text_key", "page_order"), "page_order"), "w")
    plan = plan_of(merged_listings(pages, winners, stage))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    # One scan for the merge without text, one for the texts alone; no aggregate holds a text.
    assert sum("text:string" in s for s in scans) == 1 and len(scans) == 2
    assert "title" not in next(s for s in scans if "text:string" in s)
    assert not any("text#" in a.replace("has_text#", "") for a in plan.splitlines() if "Aggregate" in a)


def test_winners_are_decided_on_narrow_rows_combined_before_the_shuffle(spark, sf_dir, tmp_path):
    pages = stages_in(str(tmp_path))(parsed_pages(sample_crawl.crawl(spark, sf_dir)), "pages")
    keys = dedup.first_of_each_text(pages.select("text_key", "page_order"), "page_order")
    plan = plan_of(keys)
    assert "partial_min(page_order" in plan and plan.count("Exchange") == 1
    assert "ReadSchema: struct<page_order:bigint,text_key:string>" in plan


def test_time_range_reaches_the_scan(spark, sf_dir):
    plan = plan_of(queries.time_range_extract(spark, sf_dir))
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00)" in plan and "LessThan(ts,2024-01-22T00:00)" in plan
    assert "value" not in plan[plan.index("ReadSchema"):]


def test_samples_are_cut_before_the_shuffle(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = plan_of(search.label_sample(documents.select("source", "doc_id"), "source", "doc_id", 5))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_top_k_searches_move_only_their_candidates(spark, sf_dir):
    for query in (queries.keyword_search, queries.random_search, queries.vector_search):
        plan = plan_of(query(spark, sf_dir))
        assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_committed_rows_are_found_by_join_not_by_collecting(spark):
    rows = spark.range(10).select(F.col("id").cast("string").alias("run_id"))
    done = spark.createDataFrame([("s", "f", False, "1")], "snapshot string, source_file string, enriched boolean, run_id string")
    assert "LeftSemi" in plan_of(manifest.rows_of_current_runs(rows, done))


@pytest.mark.parametrize("name", ["zero_shot_documents", "text_repair", "page_domain", "price_list"])
def test_row_wise_work_needs_no_shuffle_and_no_python(spark, sf_dir, name):
    plan = plan_of(queries.QUERIES[name](spark, sf_dir))
    assert "Exchange" not in plan and "Python" not in plan
