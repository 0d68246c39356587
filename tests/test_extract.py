"""Candidates from metadata, one JSON value per case."""

import json

import pytest
from pyspark.sql import functions as F

from stallkeeper.functions.fields import location_name
from stallkeeper.operators import extract
from stallkeeper.operators.merge import merge_by_url, merge_candidates, merge_page
from stallkeeper.operators.parse import parse_pages
from stallkeeper.schemas import CANDIDATE


@pytest.fixture
def candidates(spark):
    def of(extractor, *values):
        texts = F.array(*(F.lit(json.dumps(v)) for v in values))
        df = spark.range(1, numPartitions=1).select(texts.alias("v"))
        return df.select(F.inline(extractor(F.col("v")))).collect()

    return of


@pytest.fixture
def jsonld(candidates):
    def of(value):
        rows = candidates(extract.jsonld_candidates, value)
        return rows[0].asDict() if rows else None

    return of


@pytest.fixture
def microdata(candidates):
    def of(value):
        return candidates(extract.microdata_candidates, value)[0].asDict()

    return of


def product(**fields):
    return {"@type": "Product", **fields}


SELLER = {"name": "s", "@type": "Person", "url": "u", "address": {"addressCountry": "US"}}


def test_jsonld_offer(spark, jsonld):
    found = jsonld(product(name="n", offers={"price": "5", "priceCurrency": "USD", "seller": SELLER}))
    assert (found["name"], found["price"], found["currency"]) == ("n", 5.0, "USD")
    assert (found["seller"], found["seller_type"], found["seller_url"]) == ("s", "Person", "u")
    assert found["location"] == "US"
    assert spark.range(1).select(location_name(F.lit(found["location"]))).first()[0] == "USA"


@pytest.mark.parametrize(
    "offers, price, currency",
    [
        ({"lowPrice": "10", "highPrice": "20"}, 15.0, None),
        ({"lowPrice": 10, "highPrice": 20}, None, None),
        ({"price": None, "lowPrice": "10"}, 10.0, None),
        ({"price": "1", "lowPrice": "10"}, 1.0, None),
        ([{"price": "1", "priceCurrency": "USD"}, {"price": "2"}], 2.0, None),
        ([{"price": "1", "priceCurrency": "USD"}, "text"], 1.0, "USD"),
        ({"price": -5, "priceCurrency": ["USD", "EUR"]}, -5.0, "USD, EUR"),
        ({"price": ["10", "20"]}, 15.0, None),
        ("text", None, None),
        ([], None, None),
        ({}, None, None),
        (None, None, None),
    ],
)
def test_jsonld_prices(jsonld, offers, price, currency):
    found = jsonld(product(offers=offers))
    assert (found["price"], found["currency"]) == (price, currency)


def test_jsonld_last_seller_of_several_offers(jsonld):
    other = {"name": "t", "@type": "Organization"}
    found = jsonld(product(offers=[{"seller": SELLER}, {"seller": other}, {"seller": "text"}, {}]))
    assert (found["seller"], found["seller_type"], found["seller_url"]) == ("t", "Organization", None)
    assert found["location"] == "US"


@pytest.mark.parametrize(
    "value", [{"@type": ["Product"]}, {"@graph": [product()]}, {"@type": "Thing"}, {"name": "n"}, 5]
)
def test_jsonld_other_types_give_nothing(jsonld, value):
    assert jsonld(value) is None


def test_jsonld_odd_shapes_become_text_or_null(jsonld):
    found = jsonld(
        product(name=5, category=["a", "b"], image=[{"url": "i"}], offers={"seller": "text"})
    )
    assert (found["name"], found["category"], found["image"]) == ("5", '["a","b"]', "i")
    assert found["seller"] is None


def test_several_products_keep_their_order(candidates):
    rows = candidates(extract.jsonld_candidates, product(name="a"), {"@type": "X"}, product(name="b"))
    assert [r["name"] for r in rows] == ["a", "b"]


@pytest.mark.parametrize(
    "item, expected",
    [
        ({"image": {"url": "i"}}, {"image": '{"url":"i"}'}),
        ({"image": {"contentUrl": "c"}}, {"image": "c"}),
        ({"price": "9", "offers": {"priceCurrency": "GBP"}}, {"price": 9.0, "currency": "GBP"}),
        ({"offers": [{"price": "1"}, {"price": "2"}]}, {"price": 1.0}),
        (
            {"offers": [{"price": "1"}, {"price": "2"}], "seller": {"name": "s"}},
            {"price": None, "seller": "s"},
        ),
        ({"offers": {"price": "3", "seller": SELLER}}, {"seller": "s", "seller_url": None, "location": "US"}),
        ({"seller": SELLER}, {"seller": "s", "seller_type": "Person", "seller_url": "u"}),
        ({"mainEntity": {"offers": {"price": "4"}}}, {"price": 4.0}),
        (
            {
                "mainEntity": {"offers": {"price": "4", "priceCurrency": "USD", "seller": SELLER}},
                "offers": {"price": "5"},
            },
            {"price": 5.0, "currency": None, "seller": "s"},
        ),
        ({"mainEntity": {"offers": [{"price": "4"}]}, "price": "6"}, {"price": 6.0}),
        ({"offers": "text", "seller": "text", "mainEntity": "text"}, {"price": None, "seller": None}),
        ({"price": ["10", "20"], "name": ["a", "b"]}, {"price": 15.0, "name": '["a","b"]'}),
        ({"@type": "Breadcrumb"}, {"name": None}),
    ],
)
def test_microdata(microdata, item, expected):
    found = microdata(item)
    assert {name: found[name] for name in expected} == expected


META = "v array<struct<name string, property string, content string, price string, currency string, category string>>"


def of_metas(spark, extractor, metas):
    df = spark.createDataFrame([(metas,)], META)
    row = df.select(extractor(F.col("v")).alias("c")).first()["c"]
    return row.asDict() if row else None


def test_open_graph(spark):
    metas = [
        (None, "og:title", " ", None, None, None),
        (None, "og:title", "t", None, None, None),
        (None, "og:title", "later", None, None, None),
        (None, "product:price:amount", "$7", None, None, None),
        (None, "og:see_also", "w", None, None, None),
    ]
    found = of_metas(spark, extract.open_graph_candidate, metas)
    assert (found["name"], found["price"], found["seller_url"]) == ("t", 7.0, "w")
    assert of_metas(spark, extract.open_graph_candidate, metas[:0]) is None


def test_dublin_core(spark):
    bare = ("description", None, "c", None, None, None)
    priced = ("description", None, "c", "3", "USD", "cat")
    assert of_metas(spark, extract.dublin_core_candidate, [bare]) is None
    found = of_metas(spark, extract.dublin_core_candidate, [bare, priced, bare])
    assert (found["name"], found["description"], found["price"]) == ("description", "c", 3.0)
    assert (found["currency"], found["category"]) == ("USD", "cat")


# --- merge ------------------------------------------------------------------------------------


def merged(spark, *records):
    names = CANDIDATE.fieldNames()
    rows = [(0, i, tuple(r.get(n) for n in names)) for i, r in enumerate(records)]
    schema = f"c array<struct<src_rank int, src_ord int, record {CANDIDATE.simpleString()}>>"
    df = spark.createDataFrame([(rows,)], schema)
    return df.select(merge_candidates("c").alias("m")).first()["m"].asDict()


def test_merge_takes_the_first_value_that_is_not_null(spark):
    assert merged(spark, {"title": "t"}, {"name": "a"}, {"name": "b"})["name"] == "a"
    assert merged(spark, {}, {"name": ""}, {"name": "a"})["name"] == ""
    assert merged(spark, {}, {"price": None}, {"price": 5.0})["price"] == 5.0
    assert merged(spark, {}, {"seller_info": ["x", "y"]})["seller_info"] == ["x", "y"]


@pytest.mark.parametrize("salts", [1, 4])
def test_merge_by_url(spark, salts):
    rows = [
        (3, "s", "u", "T3", None, ["x"]),
        (1, "s", "u", None, 5.0, None),
        (2, "s", "u", "T2", 6.0, None),
        (1, "other", "u", "O", None, None),
        (4, "s", None, "lost", None, None),
    ]
    df = spark.createDataFrame(
        rows, "at int, snapshot string, url string, title string, price double, seller_info array<string>"
    )
    pages = df.select("*", *(F.lit(None).cast("string").alias(n) for n in
        ("text", "domain", "name", "description", "image", "retrieved", "production_data", "category",
         "currency", "seller", "seller_type", "seller_url", "location", "ships to")))
    found = {r["snapshot"]: r for r in merge_by_url(pages, "at", salts).collect()}
    assert len(found) == 2
    assert (found["s"]["title"], found["s"]["price"], found["s"]["seller_info"]) == ("T2", 5.0, ["x"])
    assert found["other"]["title"] == "O"


# --- whole pages ------------------------------------------------------------------------------


def page_record(spark, html, site="ebay", **more):
    df = spark.createDataFrame([(1, f"https://{site}.com/itm/1", site, html)], "k int, url string, site string, html string")
    pages = parse_pages(df)
    for name, value in more.items():
        pages = pages.withColumn(name, F.lit(value))
    pages = extract.with_candidates(pages)
    return merge_page(pages, ["k"]).first().asDict()


BLOCK = (
    '<div class="d-stores-info-categories__container__info__section"><a href="h"><span>bob</span></a></div>'
    '<script type="application/ld+json">{"@type":"Product","name":"n","description":"ld",'
    '"offers":{"price":"call","seller":{"name":"other"}}}</script>'
    '<meta property="product:price:amount" content="3">'
)


def test_priorities_on_a_page(spark):
    found = page_record(spark, BLOCK, frame_description="frame")
    assert (found["seller"], found["description"], found["name"], found["price"]) == ("bob", "frame", "n", 3.0)
    assert page_record(spark, BLOCK, frame_description="")["description"] == "ld"
    assert page_record(spark, BLOCK, site="other")["seller"] == "other"


def test_site_rules(spark):
    pages = spark.createDataFrame(
        [(1, "etsy", "<h1>ring</h1><b>$5</b>"), (2, "unknown", "<h1>x</h1>"), (3, "etsy", None)],
        "k int, site string, html string",
    )
    rules = spark.createDataFrame(
        [
            ("etsy", "product", "<h1>([^<]*)</h1>"),
            ("etsy", "name", "never"),
            ("etsy", "price", "<b>([^<]*)</b>"),
            ("etsy", "seller", "no group"),
            ("etsy", "strange", "(.*)"),
            ("unknown", "name", "(.*)"),
        ],
        "domain string, field string, pattern string",
    )
    found = {r["k"]: r["rule_candidate"] for r in extract.with_site_rules(pages, rules).collect()}
    assert (found[1]["name"], found[1]["price"], found[1]["seller"]) == ("ring", 5.0, None)
    assert found[2] is None
    assert found[3] is None or found[3]["name"] is None


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_frame_descriptions(spark, broadcast_bytes, monkeypatch):
    from stallkeeper.operators import lookup

    if broadcast_bytes is not None:
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    pages = spark.createDataFrame([(1, "f1"), (2, None), (3, "f1"), (4, "gone")], "k int, frame_src string")
    frames = spark.createDataFrame(
        [("f1", "<p>A\n eBay</p><p>b</p>"), ("unused", "<p>x</p>")], "url string, html string"
    )
    descriptions = extract.frame_descriptions(pages, frames)
    described = extract.with_frame_description(pages, descriptions, ["k"])
    found = described.select("k", "frame_description").collect()
    assert sorted((r[0], r[1]) for r in found) == [(1, "A b"), (2, None), (3, "A b"), (4, None)]
