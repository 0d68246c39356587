"""Candidate records: what each kind of evidence on a page says about the product.

Every extractor maps columns of a parsed page to a struct (or an array of structs) with the fields
of ``CANDIDATE``. Nothing is exploded, so a page stays one row until the merge.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stallkeeper.constants import RULE_SITES
from stallkeeper.functions.prices import (
    currency_from_value,
    mean_price_of_texts,
    price_from_text,
    price_from_value,
)
from stallkeeper.functions.text import clean_description
from stallkeeper.functions.variants import (
    as_list,
    field,
    field_text,
    image_text,
    is_filled,
    is_filled_object,
    is_list,
    last,
    let,
    objects_of,
)
from stallkeeper.operators.lookup import lookup
from stallkeeper.operators.parse import frame_text
from stallkeeper.schemas import CANDIDATE

# Merge priority of the evidence on one page; a lower rank wins.
BASE, SELLER_BLOCK, SITE_RULES, MICRODATA, OPEN_GRAPH, DUBLIN_CORE, JSON_LD = range(7)


def candidate(**values: Column) -> Column:
    """A candidate struct; fields that are not given are NULL."""

    def value(f: T.StructField) -> Column:
        if f.name in values:
            return values[f.name].alias(f.name)
        return F.expr(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}")

    return F.struct(*(value(f) for f in CANDIDATE.fields))


def base_candidate(title: Column) -> Column:
    return candidate(title=title)


def seller_block_candidate(
    seller: Column, seller_info: Column, seller_url: Column, location: Column, description: Column
) -> Column:
    """Auction-site seller block; the long description counts only when it is not empty."""
    return candidate(
        seller=seller,
        seller_info=seller_info,
        seller_url=seller_url,
        location=location,
        description=F.nullif(description, F.lit("")),
    )


def has_seller_block(site: Column) -> Column:
    return site.contains("ebay")


def jsonld_candidates(blocks: Column) -> Column:
    """One candidate per JSON-LD object whose type is exactly ``Product``.

    Of several offers the last one sets price and currency, and the last one with a seller sets
    the seller.
    """
    values = F.transform(blocks, F.try_parse_json)
    products = F.filter(values, lambda v: field_text(v, "@type") == "Product")

    def offer_parts(v: Column) -> Column:
        return let(
            objects_of(field(v, "offers")),
            lambda offers: let(
                F.filter(F.transform(offers, lambda o: field(o, "seller")), is_filled_object),
                lambda sellers: F.struct(
                    v.alias("product"),
                    last(offers).alias("offer"),
                    last(sellers).alias("seller"),
                    last(
                        F.filter(
                            F.transform(sellers, lambda s: field(s, "address")), is_filled_object
                        )
                    ).alias("address"),
                ),
            ),
        )

    def to_candidate(p: Column) -> Column:
        v, offer, seller = p["product"], p["offer"], p["seller"]
        bounds = F.array(field(offer, "lowPrice"), field(offer, "highPrice"))
        return candidate(
            name=field_text(v, "name"),
            description=field_text(v, "description"),
            image=image_text(field(v, "image"), ("contentUrl", "url")),
            production_data=field_text(v, "productionDate"),
            category=field_text(v, "category"),
            price=F.when(
                field_text(offer, "price").isNotNull(), let(field(offer, "price"), price_from_value)
            ).otherwise(mean_price_of_texts(bounds)),
            currency=let(field(offer, "priceCurrency"), currency_from_value),
            seller=field_text(seller, "name"),
            seller_type=field_text(seller, "@type"),
            seller_url=field_text(seller, "url"),
            location=field_text(p["address"], "addressCountry"),
        )

    return F.transform(F.transform(products, offer_parts), to_candidate)


def microdata_candidates(items: Column) -> Column:
    """One candidate per top-level microdata item, whatever its type.

    The offer of ``mainEntity``, then the item's own offer, override the item. A seller on the item
    itself overrides theirs; only without one is the first of a list of offers looked at.
    """
    values = F.filter(F.transform(items, F.try_parse_json), lambda v: v.isNotNull())

    def object_or_null(value: Column) -> Column:
        return F.when(is_filled_object(value), value)

    def with_seller(offer: Column) -> Column:
        return let(
            offer,
            lambda o: F.struct(
                o.alias("offer"), object_or_null(field(o, "seller")).alias("seller")
            ),
        )

    def parts(v: Column) -> Column:
        offers = field(v, "offers")
        first_of_list = F.when(
            ~is_filled(field(v, "seller")) & is_list(offers), F.get(as_list(offers), F.lit(0))
        )
        return F.struct(
            v.alias("item"),
            # Later entries override earlier ones.
            F.array(
                with_seller(object_or_null(field(field(v, "mainEntity"), "offers"))),
                with_seller(object_or_null(offers)),
                with_seller(first_of_list),
            ).alias("offers"),
            object_or_null(field(v, "seller")).alias("seller"),
        )

    def to_candidate(p: Column) -> Column:
        v, own = p["item"], p["seller"]
        present = F.filter(p["offers"], lambda o: o["offer"].isNotNull())
        prices = F.filter(
            F.transform(present, lambda o: field(o["offer"], "price")), lambda x: x.isNotNull()
        )
        offer_sellers = F.filter(
            F.transform(present, lambda o: o["seller"]), lambda s: s.isNotNull()
        )
        sellers = F.concat(offer_sellers, F.filter(F.array(own), lambda s: s.isNotNull()))
        addresses = F.filter(
            F.transform(sellers, lambda s: field(s, "address")), is_filled_object
        )
        return let(
            F.struct(last(sellers).alias("seller"), last(addresses).alias("address")),
            lambda s: candidate(
                name=field_text(v, "name"),
                description=field_text(v, "description"),
                image=image_text(field(v, "image"), ("contentUrl",)),
                production_data=field_text(v, "productionDate"),
                category=field_text(v, "category"),
                price=let(F.coalesce(last(prices), field(v, "price")), price_from_value),
                currency=let(field(last(present)["offer"], "priceCurrency"), currency_from_value),
                seller=field_text(s["seller"], "name"),
                seller_type=field_text(s["seller"], "@type"),
                seller_url=field_text(own, "url"),
                location=field_text(s["address"], "addressCountry"),
            ),
        )

    return F.transform(F.transform(values, parts), to_candidate)


def open_graph_candidate(metas: Column) -> Column:
    """Of a repeated property the first non-empty content counts."""

    def content(name: str) -> Column:
        tags = F.filter(
            metas, lambda m: (m["property"] == name) & (F.trim(m["content"]) != "")
        )
        return F.get(tags, F.lit(0))["content"]

    record = candidate(
        name=content("og:title"),
        description=content("og:description"),
        image=content("og:image"),
        category=content("product:category"),
        price=price_from_text(content("product:price:amount")),
        currency=content("product:price:currency"),
        seller_url=content("og:see_also"),
    )
    return F.when(F.exists(metas, lambda m: m["property"].isNotNull()), record)


def dublin_core_candidate(metas: Column) -> Column:
    """Only a ``description`` tag that also carries a price counts; the last such tag wins."""
    priced = F.filter(metas, lambda m: (m["name"] == "description") & (m["price"] != ""))
    return let(
        last(priced),
        lambda m: F.when(
            m.isNotNull(),
            candidate(
                name=m["name"],
                description=m["content"],
                price=price_from_text(m["price"]),
                currency=m["currency"],
                category=m["category"],
            ),
        ),
    )


# --- rules per site -------------------------------------------------------------------------

log = logging.getLogger(__name__)

_RULE_FIELDS = [
    f.name for f in CANDIDATE.fields if isinstance(f.dataType, T.StringType) or f.name == "price"
]


def fold_rules(rules: DataFrame, sites: Sequence[str] = RULE_SITES) -> dict[str, dict[str, str]]:
    """Patterns by site and field; ``product`` is another word for name.

    At most one pattern per site and known field is kept, so what is collected is bounded by
    ``sites``, the sites rules may be written for. Patterns that are no regular expressions are
    left out and reported; their pages keep all other evidence.
    """
    named = rules.select(
        F.col("domain").alias("site"),
        F.when(F.col("field") == "product", "name").otherwise(F.col("field")).alias("field"),
        # A rule written for ``product`` replaces one for ``name``.
        F.struct((F.col("field") != "product").alias("second"), "pattern").alias("rule"),
    )
    wanted = F.col("site").isin(list(sites)) & F.col("field").isin(_RULE_FIELDS)
    one_each = (
        named.filter(wanted & F.col("rule.pattern").isNotNull())
        .groupBy("site", "field")
        .agg(F.min("rule")["pattern"].alias("pattern"))
    )
    compiled = rules.sparkSession._jvm.java.util.regex.Pattern
    folded: dict[str, dict[str, str]] = {}
    for site, field, pattern in sorted(map(tuple, one_each.collect())):
        try:
            compiled.compile(f"{pattern}()")
        except IllegalArgumentException as error:
            log.warning("rule of %s for %s left out: %s", site, field, error)
            continue
        folded.setdefault(site, {})[field] = pattern
    return folded


def with_site_rules(
    pages: DataFrame, rules: DataFrame, html: str = "html", sites: Sequence[str] = RULE_SITES
) -> DataFrame:
    """Add ``rule_candidate``, the fields the site's own patterns find in the page.

    The patterns are literals in the plan, compiled once per task, and a page meets only its site's.
    """
    folded = fold_rules(rules, sites)

    def record(patterns: dict[str, str]) -> Column:
        def value(name: str) -> Column:
            if name not in patterns:
                return F.lit(None).cast("double" if name == "price" else "string")
            # The empty group at the end stands in for group 1 of a pattern without groups.
            found = F.regexp_extract(F.col(html), f"{patterns[name]}()", 1)
            text = F.nullif(found, F.lit(""))
            return price_from_text(text) if name == "price" else text

        return candidate(**{name: value(name) for name in _RULE_FIELDS})

    found = F.lit(None).cast(CANDIDATE)
    for site, patterns in folded.items():
        found = F.when(F.col("site") == site, record(patterns)).otherwise(found)
    return pages.withColumn("rule_candidate", found)


# --- descriptions kept in frames --------------------------------------------------------------


def frame_descriptions(
    pages: DataFrame, frames: DataFrame, source: str = "frame_src"
) -> DataFrame:
    """``frame_src, frame_description`` from already crawled frame pages ``(url, html)``.

    Frames nobody refers to are dropped first, and each remaining frame is read once.
    """
    wanted = pages.select(F.col(source).alias("url")).filter(F.col("url").isNotNull()).distinct()
    return (
        frames.select("url", "html")
        .join(wanted, "url", "left_semi")
        .groupBy("url")
        .agg(F.min("html").alias("html"))
        .select(
            F.col("url").alias(source),
            clean_description(frame_text(F.col("html"))).alias("frame_description"),
        )
    )


def with_frame_description(
    pages: DataFrame, descriptions: DataFrame, page_key: list[str], source: str = "frame_src"
) -> DataFrame:
    """Add ``frame_description``. Stage the descriptions: the lookup measures them first."""
    return lookup(pages, descriptions, source, page_key)


# --- all evidence of a page -------------------------------------------------------------------


def with_candidates(pages: DataFrame) -> DataFrame:
    """Add ``candidates``: every record of the page, in merge order.

    Uses the columns of ``PARSED`` plus ``site``, and ``rule_candidate`` and
    ``frame_description`` where an earlier step has added them.
    """

    def optional(name: str, dtype: T.DataType) -> Column:
        return F.col(name) if name in pages.columns else F.lit(None).cast(dtype)

    def ranked(rank: int, records: Column) -> Column:
        return F.transform(
            records,
            lambda record, at: F.struct(
                F.lit(rank).alias("src_rank"), at.alias("src_ord"), record.alias("record")
            ),
        )

    def one(rank: int, record: Column) -> Column:
        return F.filter(ranked(rank, F.array(record)), lambda c: c["record"].isNotNull())

    seller_block = F.when(
        has_seller_block(F.col("site")),
        seller_block_candidate(
            F.col("seller"),
            F.col("seller_info"),
            F.col("seller_url"),
            F.col("location"),
            optional("frame_description", T.StringType()),
        ),
    )
    return pages.withColumn(
        "candidates",
        F.concat(
            one(BASE, base_candidate(F.col("title"))),
            one(SELLER_BLOCK, seller_block),
            one(SITE_RULES, optional("rule_candidate", CANDIDATE)),
            ranked(MICRODATA, microdata_candidates(F.col("microdata"))),
            one(OPEN_GRAPH, open_graph_candidate(F.col("metas"))),
            one(DUBLIN_CORE, dublin_core_candidate(F.col("metas"))),
            ranked(JSON_LD, jsonld_candidates(F.col("jsonld"))),
        ),
    )


def candidate_rows(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The candidates as rows, for inspection; the merge does not need them exploded."""
    return pages.select(*keep, F.inline("candidates")).select(
        *keep, "src_rank", "src_ord", "record.*"
    )
