"""Filters, deduplication, lookups, index extract, manifest, sinks."""

import zlib

import pytest
from pyspark.sql import functions as F

from stallkeeper.operators import counters, dedup, filters, geo, images, lookup
from stallkeeper.sources import archives, index, manifest, tables

LONG = "d bigint, text string"


@pytest.mark.parametrize(
    "text, kept",
    [("... Not found ...", False), ("... not found ...", True), ("", False), (None, False), ("ok", True)],
)
def test_page_text_filter(one_value, text, kept):
    assert bool(one_value(filters.has_page_text(F.col("v")), text)) is kept


@pytest.mark.parametrize(
    "text, excluded",
    [
        ("Item NOT found.", True),
        ("no  exact\nmatches-found", True),
        ("notfound", False),
        ("not foundation", False),
        ("knot found", False),
        (None, False),
    ],
)
def test_excluded_phrases(spark, text, excluded):
    docs = spark.createDataFrame([("2024-01-02", text)], "retrieved string, text string")
    found = index.time_range_extract(docs, "2024-01-01", "2024-01-03").count()
    assert found == (0 if excluded else 1)


def test_time_range_is_half_open(spark):
    docs = spark.createDataFrame(
        [("2024-01-01", "a"), ("2024-01-02", "b"), ("2024-01-03", "c")], "retrieved string, text string"
    )
    rows = index.time_range_extract(docs, "2024-01-01", "2024-01-03").collect()
    assert sorted(r["text"] for r in rows) == ["a", "b"]


def kept(df):
    return sorted(r[0] for r in df.select("d").collect())


def test_dedup_keeps_the_first_text(spark):
    rows = spark.createDataFrame([(2, " abc "), (1, "Abc"), (3, "x"), (4, "abc\n")], LONG)
    assert kept(dedup.dedup_text(rows, "d")) == [1, 3]


def test_dedup_against_other_runs_only(spark):
    rows = spark.createDataFrame([(1, "Abc"), (2, "x")], LONG)
    from stallkeeper.functions.text import text_key

    seen = spark.createDataFrame([("abc", "old")], "t string, run_id string").select(
        text_key(F.col("t")).alias("text_key"), "run_id"
    )
    assert kept(dedup.dedup_text(rows, "d", seen_text=seen, run_id="new")) == [2]
    assert kept(dedup.dedup_text(rows, "d", seen_text=seen, run_id="old")) == [1, 2]


def test_dedup_of_a_hot_text(spark):
    """A third of all rows share a text: one of them stays, and every other row too."""
    rows = spark.range(3000).select(
        F.col("id").alias("d"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text"),
    )
    assert dedup.dedup_text(rows, "d").count() == 2001


@pytest.mark.parametrize("limit", [None, 0])
def test_lookup_broadcast_and_salted_agree(spark, limit):
    rows = spark.range(500).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id")))
        .alias("key"),
    )
    table = rows.filter("key is not null").select("key").distinct().withColumn("v", F.length("key"))
    found = lookup.lookup(rows, table, "key", ["id"], broadcast_bytes=limit)
    assert found.columns[-1] == "v" and found.count() == 500
    assert found.filter("key = 'hot' and v = 3").count() == 167
    assert found.filter("key is null and v is null").count() == 166


def test_measured_size_grows_with_the_table(spark):
    small, large = (spark.range(n).select(F.repeat(F.lit("x"), 100).alias("v")) for n in (10, 1000))
    assert 10 * 100 < lookup.measured_bytes(small) < lookup.measured_bytes(large)
    assert not lookup.small_enough(large, 1000)


def test_geocode_takes_the_first_part_that_resolves(spark):
    places = spark.createDataFrame(
        [("Paris", 48.9, 2.4, "France"), ("France", 46.0, 2.0, "France"), ("USA", 40.0, -100.0, "USA")],
        "name string, lat double, lon double, country string",
    )
    rows = spark.createDataFrame(
        [(1, "Nowhere, Paris, France"), (2, "US"), (3, "None"), (4, " Paris"), (5, ""), (6, None)],
        "d int, location string",
    )
    found = {r["d"]: r for r in geo.geocode(rows, places, ["d"]).collect()}
    assert (found[1]["loc_name"], found[1]["lat"], found[1]["country"]) == ("Paris", 48.9, "France")
    assert (found[2]["location"], found[2]["loc_name"]) == ("USA", "USA")
    assert [found[d]["loc_name"] for d in (3, 4, 5, 6)] == [None] * 4
    assert found[3]["location"] is None


def test_image_path_only_for_fetched_images(spark):
    rows = spark.createDataFrame(
        [("u1", "i1", "1"), ("u2", "gone", "2"), ("u3", None, "3")], "url string, image string, id string"
    )
    fetched = spark.createDataFrame([("i1", "p"), ("i1", "q")], "url string, path string")
    found = images.with_image_path(rows, fetched, ["url"], "images-d").orderBy("url").collect()
    assert [r["image_path"] for r in found] == ["images-d/1.png", None, None]


def test_counters_ride_along(spark, folder):
    df, seen = counters.observed(spark.range(10), F.col("id") > 6, even=F.col("id") % 2 == 0)
    df.write.parquet(f"{folder}/x")
    assert seen.get == {"received": 10, "kept": 3, "even": 5}


# --- archives ---------------------------------------------------------------------------------


def write_deflate(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(zlib.compress(text.encode()))


def test_archive_scan(spark, tmp_path):
    good = '{"url":"https://www.a.com/itm/%d","content":"YWJj","fetch_time":1676048703245}'
    lines = [good % 1, "{broken", good % 2, '{"url":"https://a.com/other","content":"YWJj"}',
             '{"url":"https://a.com/itm/3","content":""}', '{"url":"https://a.com/itm/4","content":"!!"}']
    folder = tmp_path / "shop" / "data_pages"
    write_deflate(folder / "a.deflate", "\n".join(lines))
    (folder / "garbage.deflate").write_bytes(b"not zlib at all")
    (folder / "notes.txt").write_text("ignored")
    read = archives.read_archives(spark, archives.archive_glob(str(tmp_path), "shop", False))
    readable, quarantined = filters.split_malformed(read.cache())
    assert readable.count() == 5 and quarantined.count() == 1
    assert quarantined.first()["_corrupt"] == "{broken"
    in_order = [r["url"][-1] for r in readable.orderBy("row_no").collect()]
    assert in_order == ["1", "2", "r", "3", "4"]
    pages = {r["url"]: r for r in archives.listing_pages(read).collect()}
    assert sorted(u[-1] for u in pages) == ["1", "2", "4"]
    one = pages["https://www.a.com/itm/1"]
    assert (one["html"], one["domain"], one["site"], one["snapshot"]) == ("abc", "a.com", "a", "all")
    assert one["retrieved"] == "2023-02-10T17:05:03.245+0000"
    assert pages["https://a.com/itm/4"]["html"] is None


def test_temporal_archives_carry_their_snapshot(spark, tmp_path):
    for day in ("2023-01-01", "2023-01-02"):
        write_deflate(tmp_path / day / "shop" / "data_pages" / "a.deflate", '{"url":"u"}')
        write_deflate(tmp_path / day / "other" / "data_pages" / "a.deflate", '{"url":"v"}')
    read = archives.read_archives(spark, archives.archive_glob(str(tmp_path), "shop", True), True)
    assert sorted((r["snapshot"], r["url"]) for r in read.collect()) == [
        ("2023-01-01", "u"),
        ("2023-01-02", "u"),
    ]


def test_index_hits(spark, tmp_path):
    (tmp_path / "hits.json").write_text(
        '{"_source":{"url":"u","text":"t","domain":"shop.com"}}\n{"_source":{"url":"v","text":"Not found"}}\n{}\n'
    )
    hits = index.index_pages(index.read_index_hits(spark, str(tmp_path))).collect()
    assert [(r["url"], r["site"]) for r in hits] == [("u", "shop")]


# --- tables and manifest ----------------------------------------------------------------------


def test_object_listing(spark, tmp_path):
    for name in ("2023-01-01/a.bin", "2023-01-01/sub/b.bin", "2023-01-02/c.bin"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
    everything = tables.list_objects(spark, str(tmp_path))
    assert sorted(r["name"] for r in everything.collect()) == [
        "2023-01-01/a.bin", "2023-01-01/sub/b.bin", "2023-01-02/c.bin"]
    assert tables.list_objects(spark, str(tmp_path), date="2023-01-02").count() == 1


def test_csv_keeps_text_as_it_is(spark, folder):
    rows = [(1, ' lead, "quoted"\nline two '), (2, "plain"), (3, None), (4, "back\\slash")]
    df = spark.createDataFrame(rows, LONG)
    tables.write_csv(df, f"{folder}/x")
    read = tables.read_csv(spark, f"{folder}/x", df.schema)
    assert sorted((r[0], r[1]) for r in read.collect()) == rows


MANIFEST = "snapshot string, source_file string, enriched boolean, run_id string"


def test_manifest(spark):
    done = spark.createDataFrame(
        [("s", "f1", False, "r1"), ("s", "f1", True, "r1-enriched"), ("s", "f2", False, "r2")], MANIFEST
    )
    files = spark.createDataFrame([("s", "f1"), ("s", "f3")], "snapshot string, source_file string")
    assert [r["source_file"] for r in manifest.unprocessed(files, done).collect()] == ["f3"]
    assert sorted(r["run_id"] for r in manifest.current_runs(done).collect()) == ["r1-enriched", "r2"]
    rows = spark.createDataFrame([("r1",), ("r1-enriched",), ("r2",), ("died",)], "run_id string")
    assert sorted(r[0] for r in manifest.rows_of_current_runs(rows, done).collect()) == ["r1-enriched", "r2"]
    assert [r[0] for r in manifest.to_backfill(rows, done).collect()] == ["r2"]
    assert sorted(r[0] for r in manifest.committed(rows, done).collect()) == ["r1", "r2"]


def test_missing_table_is_empty(spark, folder):
    from stallkeeper.schemas import MANIFEST as schema

    assert manifest.read_or_empty(spark, f"{folder}/none", schema).count() == 0
