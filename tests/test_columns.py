"""Column expressions against hand-derived cases."""

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stallkeeper.functions import fields, prices, text, urls
from stallkeeper.functions.variants import image_text


@pytest.mark.parametrize(
    "written, price",
    [
        ("US $1,299.50", 1299.5),
        ("£20", 20),
        ("$10 - $20", 1020),
        ("1.234,56", 1.23456),
        ("EUR 5,00", 500),
        ("3 for £10.50", 310.5),
        ("1e3", 13),
        ("free", None),
        ("", None),
        ("1.2.3", None),
        (".", None),
        ("12.", 12),
        ("-5", 5),
        (None, None),
    ],
)
def test_price_from_text(one_value, written, price):
    assert one_value(prices.price_from_text(F.col("v")), written) == price


@pytest.mark.parametrize(
    "json, price",
    [
        ('["10","20"]', 15.0),
        ('["10",null]', 10.0),
        ('["$1,000","free"]', 1000.0),
        ("[10,20]", None),
        ('["10",20]', 10.0),
        ("[]", None),
        ("-5", -5.0),
        ("1e3", 1000.0),
        ('"1e3"', 13.0),
        ('{"a":1}', None),
        ("null", None),
        (None, None),
    ],
)
def test_price_from_value(one_value, json, price):
    assert one_value(prices.price_from_value(F.try_parse_json("v")), json) == price


@pytest.mark.parametrize(
    "json, currency",
    [('["USD","EUR"]', "USD, EUR"), ('"USD"', "USD"), ("null", None), (None, None)],
)
def test_currency_from_value(one_value, json, currency):
    assert one_value(prices.currency_from_value(F.try_parse_json("v")), json) == currency


@pytest.mark.parametrize(
    "url, domain, site",
    [
        ("https://www.ebay.co.uk/itm/1", "ebay.co.uk", "ebay"),
        ("http://u@www.a.www.b.com:80/x", "u@a.b.com:80", "u@a"),
        ("https://m.ebay.com/itm/1", "m.ebay.com", "m"),
        ("//cdn.example.com?x", "cdn.example.com", "cdn"),
        ("a.com/itm/1", "", ""),
        ("not a url", "", ""),
    ],
)
def test_domain(one_value, url, domain, site):
    assert one_value(urls.domain(F.col("v")), url) == domain
    assert one_value(urls.site_label(urls.domain(F.col("v"))), url) == site


def test_fetch_time(one_value):
    shown = one_value(fields.fetch_time_text(F.col("v")), 1676048703245, "bigint")
    assert shown == "2023-02-10T17:05:03.245+0000"
    millis = F.unix_millis(fields.fetch_time(F.col("v")))
    assert one_value(millis, shown) == 1676048703245
    assert one_value(millis, "yesterday") is None


@pytest.mark.parametrize(
    "content, html",
    [
        ("YWJjZA==", "abcd"),
        ("YWJj!!ZA", None),
        ("", ""),
        ("Y2Fmw6k=", "café"),  # UTF-8
        ("Y2Fm6Q==", "café"),  # Latin-1
        (None, None),
    ],
)
def test_page_html(one_value, content, html):
    assert one_value(fields.page_html(F.col("v")), content) == html


@pytest.mark.parametrize(
    "name, expected", [("US", "USA"), ("GB", "Great Britain"), ("None", None), ("France", "France")]
)
def test_location_name(one_value, name, expected):
    assert one_value(fields.location_name(F.col("v")), name) == expected


@pytest.mark.parametrize(
    "broken, repaired",
    [("Ã©tÃ©", "été"), ("été", "été"), ("Â£5", "£5"), ("日本", "日本"), ("plain", "plain"), (None, None)],
)
def test_repair_mojibake(one_value, broken, repaired):
    assert one_value(text.repair_mojibake(F.col("v")), broken) == repaired


def test_clean_description(one_value):
    assert one_value(text.clean_description(F.col("v")), "Great\n\xa0 item eBay ") == "Great item"


def evaluated(spark, expression, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").coalesce(1)
    return [row[1] for row in df.select("i", expression.alias("r")).orderBy("i").collect()]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.text(alphabet=" \t\n\x0b\x1c\x1f\x85\xa0\u2003\u3000aÉ.", max_size=12), min_size=40, max_size=80
    )
)
def test_strip_is_python_strip(spark, values):
    found = evaluated(spark, text.normalised(F.col("v")), values)
    assert found == [value.strip().lower() for value in values]


def plain_price(written):
    digits = re.sub(r"[^0-9,.]", "", written).replace(",", "")
    try:
        return float(digits)
    except ValueError:
        return None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.,$ -e£", max_size=10), min_size=40, max_size=80))
def test_price_is_what_the_rule_says(spark, values):
    found = evaluated(spark, prices.price_from_text(F.col("v")), values)
    assert found == [plain_price(value) for value in values]


@pytest.mark.parametrize(
    "json, image",
    [
        ('"i"', "i"),
        ('{"contentUrl":"c","url":"u"}', "c"),
        ('{"contentUrl":"","url":"u"}', "u"),
        ('{"width":5}', '{"width":5}'),
        ('[{"url":"i"}]', "i"),
        ('["a","b"]', "a"),
        ('[{"contentUrl":"c"},"b"]', "c"),
        ('{"url":["x","y"]}', "x"),
        ("[]", "[]"),
        ("null", None),
        (None, None),
    ],
)
def test_image_text(one_value, json, image):
    expression = image_text(F.try_parse_json("v"), ("contentUrl", "url"))
    assert one_value(expression, json) == image


def test_row_id_is_stable_and_uuid_shaped(one_value):
    expression = fields.row_id(F.lit("all"), F.col("v"))
    first = one_value(expression, "https://a/itm/1")
    assert re.fullmatch(r"[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}", first)
    assert first == one_value(expression, "https://a/itm/1")
    assert first != one_value(expression, "https://a/itm/2")


def test_image_key(one_value):
    assert one_value(fields.image_key("b", "f", F.col("v")), "1") == "b/f/1.png"
    assert one_value(fields.image_key("b", None, F.col("v")), "1") == "b/1.png"
    assert one_value(fields.image_key(None, "f", F.col("v")), "1") == "f/1.png"
    assert one_value(fields.image_key("b", "f", F.col("v")), None) is None
