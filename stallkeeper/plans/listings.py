"""From crawled pages to one row per listing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stallkeeper.constants import LISTING_URL_TOKEN, PHRASES_TO_FILTER
from stallkeeper.functions.fields import fetch_time, location_name, row_id
from stallkeeper.functions.text import repair_mojibake, text_key
from stallkeeper.operators.dedup import first_of_each_text
from stallkeeper.operators.extract import (
    frame_descriptions,
    with_candidates,
    with_frame_description,
    with_site_rules,
)
from stallkeeper.operators.filters import has_page_text, has_title
from stallkeeper.operators.merge import merge_by_url, merge_page
from stallkeeper.operators.parse import parse_pages
from stallkeeper.plans.stages import Stage
from stallkeeper.schemas import PARSED
from stallkeeper.sources.archives import listing_pages
from stallkeeper.sources.index import index_pages

ORDER = "page_order"
PAGE_COLUMNS = [ORDER, "snapshot", "url", "domain", "site", "retrieved"]
_REPAIRED = ("title", "text", "name", "description")


def parsed_pages(
    lines: DataFrame,
    rules: DataFrame | None = None,
    token: str = LISTING_URL_TOKEN,
    phrases: Sequence[str] = PHRASES_TO_FILTER,
) -> DataFrame:
    """Usable pages with everything the extractors need; the page body itself ends here.

    ``lines`` are archive lines with a ``page_order`` that is unique per page.
    """
    named = [c for c in ("source_file",) if c in lines.columns]
    pages = listing_pages(lines, token).select(*PAGE_COLUMNS, *named, "html")
    if rules is not None:
        pages = with_site_rules(pages, rules)
    usable = parse_pages(pages).filter(has_page_text(F.col("text"), phrases))
    return usable.withColumn("text_key", text_key(F.col("text")))


def pages_of_hits(
    hits: DataFrame, phrases: Sequence[str] = PHRASES_TO_FILTER
) -> DataFrame:
    """Index hits (with ``snapshot`` and ``page_order``) as pages that carry base evidence only."""
    pages = index_pages(hits, phrases).withColumn("text_key", text_key(F.col("text")))
    filled = {
        f.name: F.lit(None).cast(f.dataType) if f.name.startswith("seller") else F.array().cast(f.dataType)
        for f in PARSED.fields
        if f.name in ("jsonld", "microdata", "metas", "seller", "seller_info", "seller_url")
    }
    missing = {name: F.lit(None).cast("string") for name in ("location", "frame_src")}
    return pages.withColumns({**filled, **missing})


def page_evidence(
    pages: DataFrame,
    winners: DataFrame,
    stage: Stage,
    frames: DataFrame | None = None,
) -> DataFrame:
    """One row per page that stays, with all its evidence merged into one record.

    Repeated texts are the smaller part, so what goes is taken out by its page numbers; the pages
    themselves do not move where those are few enough to be broadcast.
    """
    losers = pages.select(ORDER).join(winners.select(ORDER), ORDER, "left_anti")
    kept = pages.join(stage(losers, "losers"), ORDER, "left_anti")
    if frames is not None:
        descriptions = stage(frame_descriptions(kept, frames), "frame_descriptions")
        kept = with_frame_description(kept, descriptions, [ORDER])
    named = [c for c in ("source_file",) if c in pages.columns]
    keep = [*named, ORDER, "snapshot", "url", "text", "domain", "retrieved"]
    return merge_page(with_candidates(kept), keep)


def merged_listings(
    pages: DataFrame,
    winners: DataFrame,
    stage: Stage,
    frames: DataFrame | None = None,
    url_salts: int = 1,
) -> DataFrame:
    """Evidence of the pages that stay, merged per page and then per snapshot and URL.

    The evidence is staged: its records are read once for the merge and its texts once behind it.
    """
    evidence = stage(page_evidence(pages, winners, stage, frames), "evidence")
    return finished(merge_by_url(evidence, ORDER, url_salts))


def finished(listings: DataFrame) -> DataFrame:
    """Drop rows without title, repair texts, name locations, add time and id."""
    return listings.filter(has_title(F.col("title"))).withColumns(
        {
            **{name: repair_mojibake(F.col(name)) for name in _REPAIRED},
            "location": location_name(F.col("location")),
            "retrieved_ts": fetch_time(F.col("retrieved")),
            "id": row_id(F.col("snapshot"), F.col("url")),
        }
    )


def staged_pages(
    lines: DataFrame,
    stage: Stage,
    rules: DataFrame | None = None,
    hits: DataFrame | None = None,
    token: str = LISTING_URL_TOKEN,
    phrases: Sequence[str] = PHRASES_TO_FILTER,
) -> DataFrame:
    """The parsed pages, written once: they are read several times, and parsing is the expensive step."""
    pages = parsed_pages(lines, rules, token, phrases)
    if hits is not None:
        pages = pages.unionByName(pages_of_hits(hits, phrases), allowMissingColumns=True)
    return stage(pages, "pages")


def build_listings(
    lines: DataFrame,
    stage: Stage,
    url_salts: int = 1,
    frames: DataFrame | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """The listings of one run by itself, and its ``(text_key, page_order)`` pairs.

    ``options`` are those of ``staged_pages``.
    """
    pages = staged_pages(lines, stage, **options)
    winners = stage(first_of_each_text(pages.select("text_key", ORDER), ORDER), "winners")
    evidence = stage(page_evidence(pages, winners, stage, frames), "evidence")
    return finished(merge_by_url(evidence, ORDER, url_salts)), winners
