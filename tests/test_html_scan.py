"""The HTML scan on small pages."""

import json

import pytest
from hypothesis import given, settings, strategies as st

from stallkeeper.operators.html_scan import json_objects, scan, separated_text
from stallkeeper.operators.parse import _NAMES
from stallkeeper.schemas import PARSED

BASE = "https://www.ebay.com/itm/1"


def parsed(html):
    return scan(html, BASE, _NAMES)


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a &amp; b</p>", "a & b"),
        ("<title>T</title><p>x</p>", "Tx"),
        ("a<script>var t='</p>';</script>b", "ab"),
        ("a<style>p{}</style>b<template><i>no</i></template>c", "abc"),
        ("a<!-- <p>no</p> -->b<!DOCTYPE html>c<?php no ?>d", "abcd"),
        ("a<!-- never closed", "a"),
        ("<textarea>a <b> &lt;</textarea>b", "a <b> <b"),
        ('<a title="x > y">link</a>', "link"),
        ("<a title=it's>link</a> it's", "link it's"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("a<br/>b<script>x", "ab"),
        ("", ""),
    ],
)
def test_visible_text(html, text):
    assert parsed(html)["text"] == text


@pytest.mark.parametrize(
    "html, title",
    [
        ("<title>a &eacute;</title><title>b</title>", "a é"),
        ("<title></title>", None),
        ("<TITLE lang=en>x</TITLE>", "x"),
        ("<p>no</p>", None),
    ],
)
def test_title(html, title):
    assert parsed(html)["title"] == title


def test_jsonld_blocks():
    blocks = parsed(
        '<script type="application/ld+json">{"a":"x\ny"}</script>'
        "<script type='Application/LD+JSON'>[{\"b\":1},2,{\"c\":3}]</script>"
        '<script type="application/ld+json"><!-- {"d":4} --></script>'
        '<script type="application/ld+json">{broken</script>'
        '<script>{"e":5}</script>'
    )["jsonld"]
    assert [json.loads(b) for b in blocks] == [{"a": "x\ny"}, {"b": 1}, {"c": 3}, {"d": 4}]


def test_json_objects_keeps_odd_values_parseable():
    assert json_objects('{"a": NaN}') == ['{"a": null}']
    assert json_objects('"text"') == []


def test_meta_tags():
    metas = parsed(
        '<meta property="og:title" content="t &amp; u"><META NAME=description CONTENT=c price="3">'
    )["metas"]
    assert metas[0]["property"] == "og:title" and metas[0]["content"] == "t & u"
    assert (metas[1]["name"], metas[1]["content"], metas[1]["price"]) == ("description", "c", "3")


def items(html):
    return [json.loads(i) for i in parsed(html)["microdata"]]


def test_microdata_nests_and_repeats():
    found = items(
        '<div itemscope itemtype="https://schema.org/Product">'
        '<h1 itemprop="name"> A <b>b</b>\n c </h1><img itemprop="image" src="/i.png">'
        '<div itemprop="offers" itemscope itemtype="http://schema.org/Offer">'
        '<span itemprop="price" content="9">nine</span><meta itemprop="price" content="10">'
        '<a itemprop="url seller" href="u">x</a></div>'
        "<p itemprop=description>first<p>second</div>"
        "<div itemscope><i itemprop=x>1</i></div>"
    )
    assert found == [
        {
            "@type": "Product",
            "name": "A b c",
            "image": "https://www.ebay.com/i.png",
            "offers": {
                "@type": "Offer",
                "price": ["9", "10"],
                "url": "https://www.ebay.com/itm/u",
                "seller": "https://www.ebay.com/itm/u",
            },
            "description": "first",
        },
        {"x": "1"},
    ]


def test_microdata_of_unclosed_elements():
    assert items('<div itemscope><span itemprop="name">n') == [{"name": "n"}]


SELLER = "d-stores-info-categories__container__info__section"
PLACE = "ux-labels-values col-12 ux-labels-values--itemLocation"


def test_seller_block():
    found = parsed(
        f'<div class="x {SELLER}"><a href="https://e/u?a=1&amp;b=2"><span> bob <i>s</i></span></a>'
        '<span class="ux-textspans ux-textspans--BOLD">99%</span>'
        '<span class="ux-textspans">no</span>'
        '<span class="ux-textspans ux-textspans--BOLD">12 sold</span></div>'
        f'<div class="{PLACE}">Located in: <span>Paris: France </span></div>'
        '<iframe id="desc_ifr" src="https://f/1"></iframe>'
    )
    assert found["seller"] == "bobs"
    assert found["seller_info"] == ["99%", "12 sold"]
    assert found["seller_url"] == "https://e/u?a=1&amp;b=2"
    assert found["location"] == "France"
    assert found["frame_src"] == "https://f/1"


def test_seller_block_of_another_shape_gives_nulls():
    found = parsed(f'<div class="{SELLER}"><b>bob</b></div>')
    assert (found["seller"], found["seller_info"], found["seller_url"]) == (None, [], None)
    assert parsed("<div>bob</div>")["seller_info"] is None


def test_separated_text():
    html = "<title>t</title><div>Lovely\n&nbsp; <b>cup</b></div><script>no</script>end"
    assert separated_text(html) == "t\nLovely\ncup\nend"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/!-='\"& abip\n", max_size=60))
def test_any_input_is_read_to_the_end(html):
    found = scan("<div itemscope>" + html, BASE, _NAMES)
    assert set(found) == set(PARSED.fieldNames())
    separated_text(html)
