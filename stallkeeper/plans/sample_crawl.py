"""A crawl made by Spark from the part, supplier and nation tables.

One page per part, sold by the supplier whose key is the part key modulo the number of suppliers.
What a page says follows from base columns, so the expected listing can be stated in SQL without
looking at any HTML. The kind of metadata, the site and the way a price is written cycle with the
part key; every 101 parts the same irregular pages recur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stallkeeper.constants import (
    DESCRIPTION_FRAME_ID,
    LOCATION_BLOCK_CLASS,
    PHRASES_TO_FILTER,
    SELLER_BLOCK_CLASS,
    SELLER_SPAN_CLASS,
    ZERO_SHOT_LABELS,
)

FIRST_FETCH = 1676048703245
CYCLE = 101
NOT_A_LISTING, NO_CONTENT, BAD_BASE64, FIRST_PHRASE = 0, 1, 2, 3
NO_TITLE, SAME_URL, LATIN1, SAME_TEXT = 8, 9, 10, 12
SNAPSHOT = "2023-02-10"

_NAV = '<li><a href="/browse?c=1&amp;s=2" class="nav-link">More</a></li>'
_SCRIPT = "window.cfg = {a: 1, b: '<p>not text</p>'};"


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part, seller and country per listing, with the facts the pages are made of."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    sellers = supplier.count()
    # Few bytes become many here, so the narrow rows are spread before the pages are made.
    spread = part.repartition(spark.sparkContext.defaultParallelism, "p_partkey")
    sold = spread.withColumn("s_suppkey", F.pmod("p_partkey", F.lit(sellers)))
    joined = sold.join(supplier, "s_suppkey").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    key = F.col("p_partkey")
    block = F.floor(key / 6)
    labels = F.array(*(F.lit(label) for label in ZERO_SHOT_LABELS))
    price = F.col("p_retailprice")
    return joined.select(
        key.alias("k"),
        F.pmod(key, F.lit(6)).alias("kind"),
        F.element_at(
            F.array(F.lit("ebay"), F.lit("picclick"), F.lit("example")),
            (F.pmod(block, F.lit(3)) + 1).cast("int"),
        ).alias("site"),
        F.pmod(F.floor(key / 18), F.lit(4)).alias("style"),
        F.pmod(key, F.lit(CYCLE)).alias("turn"),
        "p_name",
        "p_brand",
        "p_type",
        F.concat(
            F.col("p_type"),
            F.lit(" piece, "),
            F.element_at(labels, (F.pmod(key, F.lit(len(ZERO_SHOT_LABELS))) + 1).cast("int")),
        ).alias("description"),
        F.format_string("%.2f", price).alias("price_plain"),
        F.concat(F.lit("US $"), F.format_number(price + 1000, 2)).alias("price_dollars"),
        F.format_string("%.2f", price + 10).alias("price_high"),
        "s_suppkey",
        "s_name",
        F.col("n_name").alias("country"),
    )


def _tag(name: str, attribute: str, key: str, content: Column, **more: Column) -> Column:
    extra = [F.concat(F.lit(f' {a}="'), c, F.lit('"')) for a, c in more.items()]
    return F.concat(
        F.lit(f'<{name} {attribute}="{key}" content="'), content, F.lit('"'), *extra, F.lit(">")
    )


def _price_text() -> Column:
    return (
        F.when(F.col("style") == 1, F.col("price_dollars"))
        .when(F.col("style") == 3, F.lit("call us"))
        .otherwise(F.col("price_plain"))
    )


def image_url(key: Column) -> Column:
    return F.concat(F.lit("https://img.example.com/"), key, F.lit(".jpg"))


def seller_url(key: Column) -> Column:
    return F.concat(F.lit("https://sellers.example.com/"), key)


def frame_url(key: Column) -> Column:
    return F.concat(F.lit("https://frames.example.com/itmdesc/"), key)


def _jsonld() -> Column:
    seller = F.struct(
        F.lit("Organization").alias("@type"),
        F.col("s_name").alias("name"),
        seller_url(F.col("s_suppkey")).alias("url"),
        F.struct(F.col("country").alias("addressCountry")).alias("address"),
    )
    ranged = F.col("style") == 2
    product = F.struct(
        F.lit("Product").alias("@type"),
        F.col("p_name").alias("name"),
        F.col("description"),
        F.array(F.struct(image_url(F.col("k")).alias("url"))).alias("image"),
        F.col("p_type").alias("category"),
        F.lit("2020-01-02").alias("productionDate"),
        F.struct(
            F.when(~ranged, _price_text()).alias("price"),
            F.when(ranged, F.col("price_plain")).alias("lowPrice"),
            F.when(ranged, F.col("price_high")).alias("highPrice"),
            F.lit("USD").alias("priceCurrency"),
            seller.alias("seller"),
        ).alias("offers"),
    )
    return F.concat(
        F.lit('<script type="application/ld+json">'), F.to_json(product), F.lit("</script>")
    )


def _microdata() -> Column:
    def prop(name: str, value: Column) -> Column:
        return _tag("meta", "itemprop", name, value)

    prices = F.when(
        F.col("style") == 2,
        F.concat(prop("price", F.col("price_plain")), prop("price", F.col("price_high"))),
    ).otherwise(prop("price", _price_text()))
    scope = '<div itemprop="{}" itemscope itemtype="https://schema.org/{}">'
    return F.concat(
        F.lit('<div itemscope itemtype="https://schema.org/Product">'),
        prop("name", F.col("p_name")),
        prop("description", F.col("description")),
        F.lit('<img itemprop="image" src="'),
        image_url(F.col("k")),
        F.lit('">'),
        prop("category", F.col("p_type")),
        F.lit(scope.format("offers", "Offer")),
        prices,
        prop("priceCurrency", F.lit("GBP")),
        F.lit(scope.format("seller", "Person")),
        prop("name", F.col("s_name")),
        F.lit(scope.format("address", "PostalAddress")),
        prop("addressCountry", F.col("country")),
        F.lit("</div></div></div></div>"),
    )


def _open_graph() -> Column:
    def prop(name: str, value: Column) -> Column:
        return _tag("meta", "property", name, value)

    return F.concat(
        prop("og:title", F.lit(" ")),
        prop("og:title", F.col("p_name")),
        prop("og:description", F.col("description")),
        prop("og:image", image_url(F.col("k"))),
        prop("og:see_also", seller_url(F.col("s_suppkey"))),
        prop("product:price:amount", _price_text()),
        prop("product:price:currency", F.lit("EUR")),
        prop("product:category", F.col("p_type")),
    )


def _dublin_core() -> Column:
    return _tag(
        "meta",
        "name",
        "description",
        F.col("description"),
        price=_price_text(),
        currency=F.lit("CAD"),
        category=F.col("p_type"),
    )


def _seller_block() -> Column:
    return F.concat(
        F.lit(f'<div class="{SELLER_BLOCK_CLASS}"><a href="'),
        seller_url(F.col("s_suppkey")),
        F.lit('"><span>'),
        F.col("s_name"),
        F.lit(f'</span></a><span class="{SELLER_SPAN_CLASS}">99.5% positive</span>'),
        F.lit(f'<span class="{SELLER_SPAN_CLASS}">'),
        F.col("p_brand"),
        F.lit(f'</span></div><div class="{LOCATION_BLOCK_CLASS}">Located in: <span>'),
        F.col("country"),
        F.lit(f'</span></div><iframe id="{DESCRIPTION_FRAME_ID}" src="'),
        frame_url(F.col("k")),
        F.lit('"></iframe>'),
    )


def _html() -> Column:
    kind, turn = F.col("kind"), F.col("turn")
    in_head = (
        F.when(kind == 1, _jsonld())
        .when(kind == 3, _open_graph())
        .when(kind == 4, _dublin_core())
        .otherwise(F.lit(""))
    )
    in_body = F.when(kind == 2, _microdata()).when(kind == 5, _seller_block()).otherwise(F.lit(""))
    title = F.when(turn == NO_TITLE, F.lit("")).otherwise(
        F.concat(
            F.lit("<title>"), F.col("p_name"), F.lit(" &amp; café #"), F.col("k"), F.lit("</title>")
        )
    )
    phrases = F.array(*(F.lit(p) for p in PHRASES_TO_FILTER))
    at = turn - FIRST_PHRASE
    phrase = F.when(
        (at >= 0) & (at < len(PHRASES_TO_FILTER)),
        F.concat(F.lit("<p>"), F.get(phrases, at.cast("int")), F.lit("</p>")),
    ).otherwise(F.lit(""))
    return F.concat(
        F.lit("<!DOCTYPE html><html><head>"),
        title,
        in_head,
        F.lit(f"<script>{_SCRIPT * 20}</script></head><body><ul>"),
        F.lit(_NAV * 10),
        F.lit("</ul><!-- item --><h1>"),
        F.col("p_name"),
        F.lit("</h1><p>Lot "),
        F.col("k"),
        F.lit(": "),
        F.col("description"),
        F.lit("</p><p>Sold by <b>"),
        F.col("s_name"),
        F.lit("</b></p>"),
        phrase,
        in_body,
        F.lit("</body></html>"),
    )


def crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive lines ``url, content, content_type, fetch_time`` with snapshot and page order."""
    pages = offers(spark, sf_dir).select("k", "site", "turn", _html().alias("html"))
    # A page that repeats the text of the page before it, and one that repeats its address.
    repeated = pages.filter(F.col("turn") == SAME_TEXT - 1).select(
        (F.col("k") + 1).alias("k"), F.col("html").alias("earlier_html")
    )
    renamed = pages.filter(F.col("turn") == SAME_URL - 1).select(
        (F.col("k") + 1).alias("k"), F.col("site").alias("earlier_site")
    )
    full = pages.join(repeated, "k", "left").join(renamed, "k", "left")
    turn = F.col("turn")
    html = F.coalesce("earlier_html", "html")
    body = F.when(turn == LATIN1, F.encode(html, "ISO-8859-1")).otherwise(F.encode(html, "UTF-8"))
    same_url = (turn == SAME_URL) & F.col("earlier_site").isNotNull()
    url_key = F.when(same_url, F.col("k") - 1).otherwise(F.col("k"))
    return full.select(
        F.lit(SNAPSHOT).alias("snapshot"),
        F.col("k").alias("page_order"),
        F.concat(
            F.lit("https://www."),
            F.when(same_url, F.col("earlier_site")).otherwise(F.col("site")),
            F.when(turn == NOT_A_LISTING, F.lit(".com/usr/")).otherwise(F.lit(".com/itm/")),
            url_key,
        ).alias("url"),
        F.when(turn == NO_CONTENT, F.lit(""))
        .when(turn == BAD_BASE64, F.lit("YWJj!!ZA"))
        .otherwise(F.base64(body))
        .alias("content"),
        F.lit("text/html").alias("content_type"),
        (F.lit(FIRST_FETCH) + F.col("k")).alias("fetch_time"),
        F.lit(None).cast("string").alias("_corrupt"),
    )


def rules(spark: SparkSession) -> DataFrame:
    """Patterns for one of the sites."""
    return spark.createDataFrame(
        [
            ("picclick", "product", "<h1>([^<]*)</h1>"),
            ("picclick", "seller", "Sold by <b>([^<]*)</b>"),
        ],
        "domain string, field string, pattern string",
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Description frames ``(url, html)`` of every other block of 18 parts."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    key = F.col("p_partkey")
    return parts.filter(F.pmod(F.floor(key / 18), F.lit(2)) == 0).select(
        frame_url(key).alias("url"),
        F.concat(
            F.lit("<html><body><div>Lovely\n&nbsp; "),
            F.col("p_type"),
            F.lit("</div><p>eBay item "),
            key,
            F.lit("</p></body></html>"),
        ).alias("html"),
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations under their region."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("name"),
        (F.col("n_nationkey") * 1.5).alias("lat"),
        (F.col("n_nationkey") * -2.5).alias("lon"),
        F.col("r_name").alias("country"),
    )
