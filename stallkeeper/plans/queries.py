"""One query per operator over the given tables, or over what Spark derives from them."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stallkeeper.functions import fields, prices, text as texts, urls
from stallkeeper.functions.variants import image_text
from stallkeeper.operators import (
    classify,
    counters,
    dedup,
    extract,
    filters,
    geo,
    images,
    search,
)
from stallkeeper.operators.merge import merge_by_url, merge_page
from stallkeeper.operators.parse import parse_pages
from stallkeeper.operators.text_index import TextIndex
from stallkeeper.plans import sample_crawl
from stallkeeper.plans.batch import (
    Inputs,
    Job,
    pending_files,
    read_listings,
    read_run_table,
    run_all,
    run_batch,
    run_files,
)
from stallkeeper.plans.listings import build_listings, finished, pages_of_hits, parsed_pages
from stallkeeper.plans.stages import scratch, stages_in
from stallkeeper.schemas import LISTINGS
from stallkeeper.sources import archives, index, manifest, tables
from stallkeeper.sources.history import TextHistory
from stallkeeper.streaming.dedup import dedup_stream
from stallkeeper.streaming.ingest import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

CRAWLER = "shop"
KEYWORDS = ("the", "que")
RANGE_START, RANGE_END = "2024-01-08 00:00:00", "2024-01-22 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_archives(lines: DataFrame, folder: str, *more_lines: Column) -> None:
    """Crawl lines as compressed JSON lines; ``more_lines`` are written behind each of them."""
    record = F.to_json(F.struct("url", "content", "content_type", "fetch_time"))
    written = F.explode(F.array(record, *more_lines)).alias("value")
    lines.select(written).write.option("compression", "deflate").text(folder)


def page_lines(pages: DataFrame, url: Column, content: Column, epoch_ms: Column) -> DataFrame:
    return pages.select(
        url.alias("url"),
        F.base64(F.encode(content, "UTF-8")).alias("content"),
        F.lit("text/html").alias("content_type"),
        epoch_ms.alias("fetch_time"),
    )


# --- whole jobs -------------------------------------------------------------------------------


def compared(listings: DataFrame) -> DataFrame:
    """Listing columns in a form any engine can state."""
    return listings.select(
        "url",
        "title",
        F.md5("text").alias("text_md5"),
        "domain",
        "name",
        "description",
        "image",
        "retrieved",
        "production_data",
        "category",
        F.round("price", 6).alias("price"),
        "currency",
        "seller",
        "seller_type",
        "seller_url",
        F.array_join("seller_info", "; ").alias("seller_info"),
        "location",
        "id",
    )


def listing_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings, _ = build_listings(
        sample_crawl.crawl(spark, sf_dir),
        stages_in(scratch(spark)),
        rules=sample_crawl.rules(spark),
        frames=sample_crawl.frames(spark, sf_dir),
    )
    return compared(listings)


def _sample_job(spark: SparkSession, sf_dir: str, archives: int | None = None) -> tuple[Job, Inputs]:
    """The sample crawl as archives on disk, and the tables a job over them uses."""
    root = scratch(spark)
    pages = sample_crawl.crawl(spark, sf_dir)
    # Sorted, so the archives' names and lines follow the page order.
    if archives is None:
        pages = pages.orderBy("page_order")
    else:
        pages = pages.repartitionByRange(archives, "page_order").sortWithinPartitions("page_order")
    write_archives(pages, f"{root}/in/{CRAWLER}/data_pages")
    parts = table(spark, sf_dir, "part")
    fetched = parts.select(
        sample_crawl.image_url(F.col("p_partkey")).alias("url"), F.lit("store").alias("path")
    )
    inputs = Inputs(
        gazetteer=sample_crawl.gazetteer(spark, sf_dir),
        rules=sample_crawl.rules(spark),
        frames=sample_crawl.frames(spark, sf_dir),
        fetched_images=fetched,
    )
    job = Job(
        f"{root}/in",
        f"{root}/out",
        CRAWLER,
        images=True,
        image_date="2023-02",
        task="zero-shot-classification",
    )
    return job, inputs


def _job_result(spark: SparkSession, job: Job) -> DataFrame:
    return read_listings(spark, job).select(
        "url",
        "title",
        F.md5("text").alias("text_md5"),
        "name",
        "description",
        "retrieved",
        F.round("price", 6).alias("price"),
        "currency",
        "seller",
        "seller_url",
        "location",
        "loc_name",
        "lat",
        "lon",
        "country",
        "image_path",
        "label_product",
        F.round("score_product", 6).alias("score_product"),
    )


def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    job, inputs = _sample_job(spark, sf_dir)
    run_all(spark, job, inputs)
    return _job_result(spark, job)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    job, inputs = _sample_job(spark, sf_dir)
    ingest_stream(spark, job, inputs).awaitTermination()
    return _job_result(spark, job)


def _in_archives(spark: SparkSession, sf_dir: str, archives: int = 8) -> tuple[Job, Inputs]:
    """The sample job with its crawl in several archives, one file to a run."""
    job, inputs = _sample_job(spark, sf_dir, archives)
    return replace(job, files_per_run=1), inputs


def multi_run_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    job, inputs = _in_archives(spark, sf_dir)
    run_all(spark, job, inputs)
    return _job_result(spark, job)


def batch_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the archives by a batch run, then a stream over the same folder."""
    job, inputs = _in_archives(spark, sf_dir)
    run_batch(spark, replace(job, files_per_run=4), inputs)
    ingest_stream(spark, job, inputs).awaitTermination()
    return _job_result(spark, job)


def arrival_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last archive comes first: the listings are those of the order of names."""
    job, inputs = _in_archives(spark, sf_dir, 3)
    # As many as there are archives, which the query has made.
    files = sorted(pending_files(spark, job).collect(), key=lambda r: r["source_file"])
    for row in reversed(files):
        run_files(spark, job, inputs, [row])
    return _job_result(spark, job)


def concurrent_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs over the same archives and output at the same time."""
    job, inputs = _in_archives(spark, sf_dir, 3)
    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(run_all, spark, job, inputs) for _ in range(2)]:
            done.result()
    return _job_result(spark, job)


def _broken_lines(spark: SparkSession, sf_dir: str) -> Job:
    """A job over pages, each with a cut line and one that is not base64 behind it."""
    root = scratch(spark)
    pages = table(spark, sf_dir, "pages")
    lines = page_lines(pages, F.col("url"), F.col("html"), F.col("page_id") * 1000)
    broken = F.to_json(
        F.struct("url", F.concat("content", F.lit("!")).alias("content"), "content_type")
    )
    cut = F.concat(F.lit('{"url": "cut '), F.col("url"))
    write_archives(lines, f"{root}/in/{CRAWLER}/data_pages", cut, broken)
    job = Job(f"{root}/in", f"{root}/out", CRAWLER, token="")
    run_all(spark, job)
    return job


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_run_table(spark, _broken_lines(spark, sf_dir), "quarantine")
    return rows.select("snapshot", "reason", "line")


def file_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of all files; how many files there are depends on the cluster."""
    rows = read_run_table(spark, _broken_lines(spark, sf_dir), "counters")
    return rows.groupBy("snapshot").agg(
        *(F.sum(c).alias(c) for c in ("received", "kept", "malformed"))
    )


# --- sources, sinks, increments ---------------------------------------------------------------


def crawl_archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    pages = table(spark, sf_dir, "pages")
    lines = page_lines(pages, F.col("url"), F.col("html"), F.col("page_id") * 1000)
    # Behind every good line a cut one, and one whose content is not base64.
    broken = F.to_json(
        F.struct("url", F.concat("content", F.lit("!")).alias("content"), "content_type")
    )
    write_archives(lines, f"{root}/{CRAWLER}/data_pages", F.lit('{"url": "cut'), broken)
    read = archives.read_archives(spark, archives.archive_glob(root, CRAWLER, temporal=False))
    pages = archives.listing_pages(read, token="").filter(filters.has_content(F.col("html")))
    return pages.select("url", "domain", "retrieved", F.md5("html").alias("html_md5"))


def temporal_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark)
    six_days = F.date_add(
        F.lit("2024-01-01"), (F.floor(F.datediff("ts", F.lit("2024-01-01")) / 6) * 6).cast("int")
    )
    events = table(spark, sf_dir, "events").withColumn("crawl_date", six_days.cast("string"))
    url = F.concat(F.lit("https://www.example.com/itm/"), F.col("event_id"))
    for day in [r[0] for r in events.select("crawl_date").distinct().collect()]:
        one_day = events.filter(F.col("crawl_date") == day)
        write_archives(
            page_lines(one_day, url, F.col("props"), F.unix_millis(F.col("ts").cast("timestamp"))),
            f"{root}/{day}/{CRAWLER}/data_pages",
        )
    read = archives.read_archives(
        spark, archives.archive_glob(root, CRAWLER, temporal=True), temporal=True
    )
    return archives.listing_pages(read).groupBy("snapshot").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.min("retrieved").alias("first_retrieved"),
        F.sum(F.length("html")).alias("n_chars"),
    )


def _phrased_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, of which every tenth ends like a page that found nothing."""
    ending = (
        F.when(F.col("doc_id") % 10 == 3, F.lit(" Item Not found."))
        .when(F.col("doc_id") % 10 == 4, F.lit(" item not found"))
        .otherwise(F.lit(""))
    )
    return table(spark, sf_dir, "documents").withColumn("text", F.concat("text", ending))


def index_hit_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    url = F.concat(F.lit("https://www."), F.col("source"), F.lit(".com/itm/"), F.col("doc_id"))
    hits = _phrased_documents(spark, sf_dir).select(
        F.struct(
            url.alias("url"),
            F.col("lang").alias("title"),
            "text",
            F.concat("source", F.lit(".com")).alias("domain"),
            F.lit("2024-01-01T00:00:00.000+0000").alias("retrieved"),
        ).alias("_source")
    )
    tables.write_json_lines(hits, folder)
    numbered = index.read_index_hits(spark, folder).select(
        F.lit("hits").alias("snapshot"), F.col("url").alias("page_order"), "*"
    )
    keep = ["page_order", "snapshot", "url", "text", "domain", "retrieved"]
    per_page = merge_page(extract.with_candidates(pages_of_hits(numbered)), keep)
    return finished(merge_by_url(per_page, "page_order")).select(
        "url", "title", "domain", F.md5("text").alias("text_md5"), "retrieved", "id"
    )


def _event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    wording = F.get(
        F.array(*(F.lit(t) for t in ("Item NOT found.", "notfound", "No exact  matches-found"))),
        F.pmod("event_id", F.lit(5)).cast("int"),
    )
    return table(spark, sf_dir, "events").withColumn("text", wording)


def time_range_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The column's own type, so that the range reaches the scan.
    start, end = (F.lit(t).cast("timestamp_ntz") for t in (RANGE_START, RANGE_END))
    found = index.time_range_extract(
        _event_texts(spark, sf_dir), start, end, retrieved="ts"
    )
    return found.select("event_id", "user_id", "text")


def index_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    found = time_range_extract(spark, sf_dir)
    tables.write_json_lines(found, folder)
    return spark.read.schema(found.schema).json(folder)


def doc_count_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.document_counts(table(spark, sf_dir, "documents"), "source")


def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    tables.write_partitions(table(spark, sf_dir, "documents"), folder, "lang")
    files = tables.list_objects(spark, folder, glob="*.parquet")
    return files.groupBy(F.split_part("name", F.lit("/"), F.lit(1)).alias("folder")).agg(
        F.min(F.col("length") > 0).alias("filled")
    )


def partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.col("lang").alias("snapshot"), F.lit("run-1").alias("run_id")
    )
    tables.write_partitions(documents, folder, "snapshot", "run_id")
    # The same run again, for one snapshot only: replaces that partition, keeps the others.
    tables.write_partitions(documents.filter("snapshot = 'en'"), folder, "snapshot", "run_id")
    return tables.read_parquet(spark, folder).groupBy("snapshot", "run_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_chars").alias("n_chars")
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.array("lang", "source").alias("seller_info")
    )
    tables.write_csv(documents, folder)
    read = tables.read_csv(
        spark, folder, spark.createDataFrame([], "doc_id bigint, text string, seller_info string").schema
    )
    return read.select("doc_id", F.md5("text").alias("text_md5"), "seller_info")


def skip_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    def as_files(df: DataFrame) -> DataFrame:
        return df.select(
            F.lit("all").alias("snapshot"), F.col("doc_id").cast("string").alias("source_file")
        )

    return manifest.unprocessed(
        as_files(table(spark, sf_dir, "documents")), as_files(table(spark, sf_dir, "labels"))
    )


def backfill_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    run_id = F.concat(F.lit("run-"), F.pmod("p_partkey", F.lit(16)))
    url = F.concat(F.lit("https://www.example.com/itm/"), F.col("p_partkey"))
    outputs = parts.select(
        url.alias("url"),
        F.lit(sample_crawl.SNAPSHOT).alias("snapshot"),
        sample_crawl.image_url(F.col("p_partkey")).alias("image"),
        fields.row_id(F.lit(sample_crawl.SNAPSHOT), url).alias("id"),
        run_id.alias("run_id"),
    )
    runs = outputs.select(
        F.lit(sample_crawl.SNAPSHOT).alias("snapshot"),
        F.concat("run_id", F.lit(".deflate")).alias("source_file"),
        (F.substring_index("run_id", "-", -1).cast("int") % 2 == 0).alias("enriched"),
        "run_id",
    ).distinct()
    # Two of three images could be fetched.
    fetched = parts.filter(F.col("p_size") % 3 > 0).select(
        sample_crawl.image_url(F.col("p_partkey")).alias("url"), F.lit("store").alias("path")
    )
    waiting = manifest.to_backfill(outputs, runs)
    return images.with_image_path(waiting, fetched, ["snapshot", "url"], "images-2023-02").select(
        "url", "run_id", "image_path"
    )


# --- filters and columns ----------------------------------------------------------------------


def listing_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = parsed_pages(sample_crawl.crawl(spark, sf_dir))
    return usable.filter(filters.has_title(F.col("title"))).select("url", "title")


def page_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = urls.domain(F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id", domain.alias("domain"), urls.site_label(domain).alias("site")
    )


def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_pages(table(spark, sf_dir, "pages")).select("page_id", "title")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_pages(table(spark, sf_dir, "pages")).select(
        "page_id", F.md5("text").alias("text_md5")
    )


def fetch_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = fields.fetch_time_text(F.unix_millis(F.col("ts").cast("timestamp")))
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.alias("retrieved"),
        F.unix_millis(fields.fetch_time(text)).alias("retrieved_ms"),
    )


def _price_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice")
    styles = F.array(
        F.format_string("%.2f", price),
        F.concat(F.lit("US $"), F.format_number(price * 100, 2)),
        F.concat(F.lit("$10 - $"), F.format_string("%.0f", price)),
        F.concat(F.lit("-"), F.format_string("%.2f", price)),
        F.lit("call us"),
        F.concat(F.format_string("%.2f", price), F.lit(".5")),
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.get(styles, F.pmod("p_partkey", F.lit(6)).cast("int")).alias("written")
    )


def price_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _price_texts(spark, sf_dir).select(
        "p_partkey", F.round(prices.price_from_text(F.col("written")), 6).alias("price")
    )


def price_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice")
    # Text counts, numbers and nulls do not.
    listed = F.to_json(
        F.struct(
            F.format_string("%.2f", price).alias("a"),
            F.concat(F.lit("$"), F.format_number(price * 10, 2)).alias("b"),
        )
    )
    mixed = F.regexp_replace(listed, r'^\{"a":(.*),"b":(.*)\}$', '[$1,$2,7,null,"free"]')
    value = F.when(F.col("p_partkey") % 3 > 0, mixed).otherwise(F.lit("[10,20]"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.round(prices.price_from_value(F.try_parse_json(value)), 6).alias("price"),
    )


def currency_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_brand = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.array_sort(F.collect_set("p_type")).alias("types")
    )
    return per_brand.select("p_brand", prices.join_currencies(F.col("types")).alias("currency"))


def text_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(texts.repair_mojibake(broken)).alias("text_md5")
    )


def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" \n "), "text", F.lit("\t "))
    return table(spark, sf_dir, "documents").select(
        "doc_id", texts.text_key(padded).alias("text_key")
    )


def description_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.concat(
        F.lit(" Great\n  "), "p_name", F.lit("\n eBay   "), "p_type", F.lit(" eBay ")
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", texts.clean_description(written).alias("description")
    )


def image_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    shapes = F.array(
        F.to_json(F.struct(name.alias("url"))),
        F.to_json(F.struct(name.alias("contentUrl"), F.lit("u").alias("url"))),
        F.to_json(F.array(name, F.lit("second"))),
        F.to_json(F.array(F.struct(F.lit("").alias("contentUrl"), name.alias("url")))),
        F.concat(F.lit('"'), name, F.lit('"')),
        F.lit("null"),
    )
    written = F.get(shapes, F.pmod("p_partkey", F.lit(6)).cast("int"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        image_text(F.try_parse_json(written), ("contentUrl", "url")).alias("image"),
    )


def type_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loose table brought to the listing schema: casts, missing columns, nested text."""
    loose = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("url"),
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_retailprice").cast("string"))
        .otherwise(F.lit("n/a"))
        .alias("price"),
        F.struct(F.col("p_brand").alias("b")).alias("category"),
        F.col("p_name").alias("name"),
    )
    return fields.to_types(loose, LISTINGS).select(
        "url", F.round("price", 6).alias("price"), "category", "name", "seller"
    )


def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    row_id = fields.row_id(F.lit("all"), F.col("url"))
    return table(spark, sf_dir, "pages").select(
        "page_id", row_id.alias("id"), fields.image_key("images", "crawl", row_id).alias("image_key")
    )


# --- extraction -------------------------------------------------------------------------------


def _evidence(spark: SparkSession, sf_dir: str, records: Column) -> DataFrame:
    """The candidates one extractor finds on the sample pages."""
    pages = parsed_pages(sample_crawl.crawl(spark, sf_dir))
    return pages.select("page_order", F.posexplode(records).alias("src_ord", "record")).select(
        "page_order",
        "src_ord",
        "record.name",
        "record.description",
        "record.image",
        "record.production_data",
        "record.category",
        F.round("record.price", 6).alias("price"),
        "record.currency",
        "record.seller",
        "record.seller_type",
        "record.seller_url",
        "record.location",
    )


def _one(record: Column) -> Column:
    return F.filter(F.array(record), lambda r: r.isNotNull())


def extract_jsonld(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evidence(spark, sf_dir, extract.jsonld_candidates(F.col("jsonld")))


def extract_microdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evidence(spark, sf_dir, extract.microdata_candidates(F.col("microdata")))


def extract_opengraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evidence(spark, sf_dir, _one(extract.open_graph_candidate(F.col("metas"))))


def extract_dublincore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evidence(spark, sf_dir, _one(extract.dublin_core_candidate(F.col("metas"))))


def extract_ebay(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = parsed_pages(sample_crawl.crawl(spark, sf_dir))
    return pages.filter(extract.has_seller_block(F.col("site"))).select(
        "page_order",
        "seller",
        F.array_join("seller_info", "; ").alias("seller_info"),
        "seller_url",
        "location",
    )


def ebay_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = stages_in(scratch(spark))
    pages = stage(parsed_pages(sample_crawl.crawl(spark, sf_dir)), "pages")
    texts_of_frames = extract.frame_descriptions(pages, sample_crawl.frames(spark, sf_dir))
    described = extract.with_frame_description(
        pages.select("page_order", "frame_src"),
        stage(texts_of_frames, "descriptions"),
        ["page_order"],
    )
    return described.select("page_order", "frame_src", "frame_description")


def domain_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = archives.listing_pages(sample_crawl.crawl(spark, sf_dir))
    # One pattern among the rules is no regular expression; it is left out.
    rules = sample_crawl.rules(spark)
    bad = rules.limit(1).withColumns({"field": F.lit("location"), "pattern": F.lit("(unclosed")})
    found = extract.with_site_rules(pages, rules.unionByName(bad))
    matched = F.col("rule_candidate").isNotNull() & F.col("html").isNotNull()
    return found.filter(matched).select(
        "page_order",
        F.col("rule_candidate.name").alias("name"),
        F.col("rule_candidate.seller").alias("seller"),
        F.col("rule_candidate.currency").alias("currency"),
    )


def candidate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many candidates each kind of evidence gives."""
    pages = parsed_pages(sample_crawl.crawl(spark, sf_dir), sample_crawl.rules(spark))
    rows = extract.candidate_rows(extract.with_candidates(pages), ["page_order"])
    return rows.groupBy("src_rank").agg(F.count(F.lit(1)).alias("n_candidates"))


# --- deduplication and lookups ----------------------------------------------------------------


def dedup_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup.dedup_text(table(spark, sf_dir, "documents"), "doc_id")
    return kept.select("doc_id", "source", "n_chars")


def dedup_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents are texts of earlier runs, in four generations of which three are put together."""
    documents = table(spark, sf_dir, "documents")
    folder = scratch(spark)
    stage, history = stages_in(f"{folder}/work"), TextHistory(spark, f"{folder}/seen")
    key = F.unhex(texts.text_key(F.col("text"))).alias("key")
    first = documents.groupBy(key).agg(F.min("doc_id").alias("page_order"))
    earlier = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi").select(
        key,
        F.lit("all").alias("snapshot"),
        F.col("source").alias("source_file"),
        F.col("doc_id").alias("page_order"),
        F.lit(None).cast("string").alias("url"),
    )
    names = [f"run-{i}" for i in range(4)]
    for i, name in enumerate(names):
        history.write(earlier.filter(F.pmod("page_order", F.lit(4)) == i), name)
    history.compact(names[:3], "whole")
    asked = stage(first.filter("key IS NOT NULL"), "asked")
    seen = history.lookup(asked, names, stage).select("key").distinct()
    new = asked.join(seen, "key", "left_anti").select(F.col("page_order").alias("doc_id"))
    return documents.join(new, "doc_id", "left_semi").select("doc_id", "source", "n_chars")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    # A pattern, because a stream takes neither a single file nor files in a folder of that name otherwise.
    documents = spark.readStream.schema(table(spark, sf_dir, "documents").schema).parquet(
        f"{sf_dir}/documents.parque[t]"
    )
    (
        dedup_stream(documents, "doc_id")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
        .awaitTermination()
    )
    return tables.read_parquet(spark, f"{folder}/out").select("text_key")


def geocode(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    written = F.array(
        F.col("n_name"),
        F.concat(F.lit("Springfield, "), F.col("n_name"), F.lit(", NATION_0")),
        F.lit("Nowhere"),
        F.lit("None"),
        F.lit("US"),
    )
    rows = suppliers.select(
        "s_suppkey", F.get(written, F.pmod("s_suppkey", F.lit(5)).cast("int")).alias("location")
    )
    # One more place under the name the alias table gives.
    usa = table(spark, sf_dir, "region").filter("r_name = 'AMERICA'").select(
        F.lit("USA").alias("name"),
        F.lit(40.0).alias("lat"),
        F.lit(-100.0).alias("lon"),
        F.col("r_name").alias("country"),
    )
    places = sample_crawl.gazetteer(spark, sf_dir).unionByName(usa)
    return geo.geocode(rows, places, ["s_suppkey"])


def _place_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers below suppliers, nations and regions; some suppliers below themselves or below no place."""

    def place(kind: str, key: Column) -> Column:
        return F.concat(F.lit(kind), key.cast("string"))

    supplier, number = F.col("s_suppkey"), F.col("s_suppkey") % 20
    above = F.when(number == 0, place("s", supplier)).when(number == 1, F.lit("gone"))
    return (
        table(spark, sf_dir, "region")
        .select(place("r", F.col("r_regionkey")).alias("place_id"), F.lit(None).cast("string").alias("parent_id"))
        .unionAll(table(spark, sf_dir, "nation").select(place("n", F.col("n_nationkey")), place("r", F.col("n_regionkey"))))
        .unionAll(
            table(spark, sf_dir, "supplier").select(
                place("s", supplier), above.otherwise(place("n", F.col("s_nationkey")))
            )
        )
        .unionAll(
            table(spark, sf_dir, "customer").select(
                place("c", F.col("c_custkey")), place("s", F.col("c_custkey") % 120)
            )
        )
    )


def geocode_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country of a place is the place without a parent above it."""
    return geo.top_places(_place_tree(spark, sf_dir), stages_in(scratch(spark)))


def image_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    url = F.concat(F.lit("https://www.example.com/itm/"), F.col("p_partkey"))
    # A third of the listings share one picture, some have none.
    image = F.when(F.col("p_partkey") % 3 == 0, F.lit("https://img.example.com/0.jpg")).when(
        F.col("p_partkey") % 7 > 0, sample_crawl.image_url(F.col("p_partkey"))
    )
    listings = parts.select(
        F.lit("all").alias("snapshot"),
        url.alias("url"),
        image.alias("image"),
        fields.row_id(F.lit("all"), url).alias("id"),
    )
    fetched = parts.filter(F.col("p_size") % 2 == 0).select(
        sample_crawl.image_url(F.col("p_partkey")).alias("url"), F.lit("store").alias("path")
    )
    found = images.with_image_path(listings, fetched, ["url"], "images-2023-02", "shop")
    return found.select("url", "id", "image_path")


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _phrased_documents(spark, sf_dir)
    return counters.counts_per_group(
        documents, "source", filters.has_page_text(F.col("text")), F.octet_length("text")
    )


# --- classifiers ------------------------------------------------------------------------------


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("truth"))
    return table(spark, sf_dir, "documents").join(truth, "doc_id")


def classify_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _labelled(spark, sf_dir)
    model = classify.train_text_classifier(labelled, scratch(spark), label="truth")
    documents = table(spark, sf_dir, "documents")
    scored = classify.run_task(
        documents, "text-classification", lambda df: classify.classify_text(df, model)
    )
    return scored.select("doc_id", "label", F.round("score", 6).alias("score"))


def classifier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _labelled(spark, sf_dir)
    # A fold that depends on the id alone: the model is judged on texts it was not trained on.
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(5))
    model = classify.train_text_classifier(
        labelled.filter(fold > 0), scratch(spark), label="truth"
    )
    scored = classify.classify_text(labelled.filter(fold == 0), model)
    return classify.evaluate(classify.confusion(scored))


def _bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the labels of even documents, and the labels where there are any."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    examples = documents.select("doc_id", "text").join(labels.select("doc_id", "quality"), "doc_id")
    model = classify.train_naive_bayes(examples.filter("doc_id % 2 = 0"), label="quality")
    found = classify.classify_naive_bayes(documents.select("doc_id", "text"), model, "doc_id")
    return found.join(labels.select("doc_id", F.col("quality").alias("truth")), "doc_id", "left")


def naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bayes(spark, sf_dir).select("doc_id", "label", F.round("score", 4).alias("score"))


def naive_bayes_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _bayes(spark, sf_dir).filter("doc_id % 2 = 1 AND truth IS NOT NULL")
    return classify.confusion(held_out)


def confusion_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity labels taken as predictions of the quality label."""
    labels = table(spark, sf_dir, "labels")
    return classify.confusion(labels, "quality", "toxic")


def label_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = classify.evaluate(confusion_table(spark, sf_dir), "quality", "toxic")
    return metrics.select(*(F.round(c, 6).alias(c) for c in metrics.columns))


def zero_shot(spark: SparkSession, sf_dir: str) -> DataFrame:
    adverts = sample_crawl.offers(spark, sf_dir).select("k", F.col("description").alias("text"))
    scored = classify.run_task(adverts, "zero-shot-classification")
    return scored.select("k", "label_product", F.round("score_product", 6).alias("score_product"))


def zero_shot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the caller's own over the documents."""
    scored = classify.zero_shot(
        table(spark, sf_dir, "documents"), labels=["the hand", "und der", "est que", "los que"]
    )
    return scored.select(
        "doc_id", "label_product", F.round("score_product", 6).alias("score_product")
    )


def multi_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two simple classifiers side by side, their columns suffixed."""

    def longer_than(limit: int) -> classify.TextClassifier:
        def classify_length(df: DataFrame) -> DataFrame:
            over = F.length("text") > limit
            return df.withColumns(
                {"label": over.cast("int"), "score": F.when(over, 1.0).otherwise(0.5)}
            )

        return classify_length

    scored = classify.run_task(
        table(spark, sf_dir, "documents"),
        "multi-model",
        models={"short": longer_than(500), "long": longer_than(5000)},
    )
    return scored.select("doc_id", "label_short", "score_short", "label_long", "score_long")


# --- triage and search ------------------------------------------------------------------------


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.topics(table(spark, sf_dir, "documents"), "doc_id")
    return found.select("doc_id", "topic", F.round("weight", 6).alias("weight"))


def label_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = search.label_sample(table(spark, sf_dir, "documents"), "source", "doc_id", quota=5)
    return sampled.select("source", "doc_id")


def keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.keyword_search(table(spark, sf_dir, "documents"), "doc_id", KEYWORDS)
    return found.select("doc_id", "matches")


def _indexed_documents(spark: SparkSession, sf_dir: str) -> tuple[TextIndex, list[str]]:
    """All documents, indexed by two runs, and the first eight words of the one with the least id."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    index = TextIndex(spark, scratch(spark))
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    index.add(documents.filter(english), "english")
    index.add(documents.filter(~english), "other")
    first = documents.agg(F.min_by("text", "doc_id")).first()[0]
    return index, index.query_words(first)[:8]


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, words = _indexed_documents(spark, sf_dir)
    return index.ranked(" ".join(words), limit=20).withColumnRenamed("key", "doc_id")


def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds the first two words of the first document in a row."""
    index, words = _indexed_documents(spark, sf_dir)
    return index.phrase(" ".join(words[:2])).withColumnRenamed("key", "doc_id")


def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.random_search(table(spark, sf_dir, "documents"), "doc_id").select("doc_id")


def vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    query = vectors.agg(F.min_by("embedding", "vec_id")).first()[0]
    found = search.vector_search(vectors, "vec_id", query)
    return found.select("vec_id", F.round("similarity", 6).alias("similarity"))


def label_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two judgements per labelled document, the newer one exported beside every document."""
    labels = table(spark, sf_dir, "labels")
    first_newer = F.col("quality") == 1
    history = labels.select(
        "doc_id",
        F.explode(
            F.array(
                F.struct(F.col("quality").alias("label"), F.when(first_newer, 2).otherwise(1).alias("at")),
                F.struct(F.col("toxic").alias("label"), F.when(first_newer, 1).otherwise(2).alias("at")),
            )
        ).alias("judgement"),
    ).select("doc_id", "judgement.*")
    rows = search.with_labels(
        table(spark, sf_dir, "documents").select("doc_id", "lang"), history, "doc_id", "at"
    ).select("doc_id", "lang", "label")
    folder = scratch(spark)
    tables.write_csv(rows, folder)
    return tables.read_csv(spark, folder, rows.schema)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        listing_merge,
        batch_run,
        stream_ingest,
        multi_run_merge,
        batch_then_stream,
        arrival_order,
        concurrent_commits,
        quarantine,
        file_counters,
        crawl_archive_scan,
        temporal_scan,
        index_hit_scan,
        time_range_extract,
        index_export,
        doc_count_by_source,
        object_listing,
        partitioned_sink,
        csv_roundtrip,
        skip_processed,
        backfill_enrichment,
        listing_filter,
        page_domain,
        page_title,
        page_text,
        fetch_time,
        price_scalar,
        price_list,
        currency_join,
        text_repair,
        text_keys,
        description_cleanup,
        image_values,
        type_contract,
        row_ids,
        extract_jsonld,
        extract_microdata,
        extract_opengraph,
        extract_dublincore,
        extract_ebay,
        ebay_description,
        domain_rules,
        candidate_counts,
        dedup_text,
        dedup_history,
        stream_dedup,
        geocode,
        geocode_hierarchy,
        image_manifest,
        run_counters,
        classify_text,
        classifier_metrics,
        naive_bayes,
        naive_bayes_metrics,
        confusion_table,
        label_metrics,
        zero_shot,
        zero_shot_documents,
        multi_model,
        topics,
        label_sample,
        keyword_search,
        ranked_search,
        phrase_search,
        random_search,
        vector_search,
        label_export,
    )
}
