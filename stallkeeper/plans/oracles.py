"""What the registered queries have to return, as plain SQL over the given tables.

The expected listings are stated from base columns; no SQL here looks at the HTML the sample crawl
makes of them.
"""

from __future__ import annotations

from stallkeeper.constants import PHRASES_TO_FILTER, ZERO_SHOT_LABELS
from stallkeeper.plans.sample_crawl import FIRST_FETCH, SNAPSHOT


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _row_id(text: str) -> str:
    digest = f"sha256({text})"
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({digest}, {at}, {n})" for at, n in parts)


def _best_label(source: str, key: str, text: str, labels: list[str]) -> str:
    """Label with the largest share of its words (articles aside) in the text, the earlier on a tie."""
    words = [[w for w in dict.fromkeys(label.split()) if w not in ("a", "an", "the")] for label in labels]
    wanted = "[" + ", ".join(_list(w) for w in words) + "]"
    return f"""
    SELECT {key}, label AS label_product, round(score, 6) AS score_product FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, pos) AS place FROM (
        SELECT {key}, label, pos, len(list_intersect(wanted, words))::DOUBLE / len(wanted) AS score
        FROM (SELECT {key}, string_split_regex(lower({text}), '[^a-z]+') AS words FROM {source}),
             (SELECT unnest({_list(labels)}) AS label, unnest({wanted}) AS wanted,
                     unnest(range({len(labels)})) AS pos)
      )
    ) WHERE place = 1"""


_OFFERS = f"""
offers AS (
  SELECT p_partkey AS k, p_partkey % 6 AS kind,
         (['ebay', 'picclick', 'example'])[((p_partkey // 6) % 3 + 1)::INT] AS site,
         (p_partkey // 18) % 4 AS style, p_partkey % 101 AS turn, p_name, p_brand, p_type,
         p_type || ' piece, ' || ({_list(ZERO_SHOT_LABELS)})[(p_partkey % 7 + 1)::INT] AS description,
         p_retailprice AS price, s_suppkey, s_name, n_name AS country
  FROM part
  JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)
  JOIN nation ON s_nationkey = n_nationkey
)"""

# One row per page that passes the filters, with the evidence the page holds.
_PAGES = f"""{_OFFERS},
usable AS (
  SELECT o.* EXCLUDE (site),
         CASE WHEN turn = 9 THEN (['ebay', 'picclick', 'example'])[(((k - 1) // 6) % 3 + 1)::INT]
              ELSE site END AS site,
         CASE WHEN turn = 9 THEN k - 1 ELSE k END AS url_key
  FROM offers o WHERE turn NOT BETWEEN 0 AND 7
),
pages AS (
  SELECT *,
    'https://www.' || site || '.com/itm/' || url_key AS url,
    CASE WHEN turn <> 8 THEN p_name || ' & café #' || k END AS title,
    coalesce(CASE WHEN turn <> 8 THEN p_name || ' & café #' || k END, '') || repeat('More', 10)
      || p_name || 'Lot ' || k || ': ' || description || 'Sold by ' || s_name
      || CASE WHEN kind = 5 THEN s_name || '99.5% positive' || p_brand || 'Located in: ' || country
              ELSE '' END AS text,
    strftime(make_timestamp(({FIRST_FETCH} + k) * 1000), '%Y-%m-%dT%H:%M:%S.%g+0000') AS retrieved,
    CASE WHEN style = 3 THEN NULL
         WHEN style = 1 THEN price + 1000
         WHEN style = 2 AND kind IN (1, 2) THEN price + 5
         ELSE price END AS asked,
    'https://img.example.com/' || k || '.jpg' AS image_url,
    'https://sellers.example.com/' || s_suppkey AS shop_url,
    kind = 5 AND site = 'ebay' AS on_ebay,
    CASE WHEN (k // 18) % 2 = 0 THEN 'Lovely ' || p_type || ' item ' || k END AS frame_text
  FROM usable
)"""

_LISTINGS = f"""{_PAGES},
merged AS (
  SELECT *,
    CASE WHEN site = 'picclick' OR kind IN (1, 2, 3) THEN p_name
         WHEN kind = 4 THEN 'description' END AS m_name,
    CASE WHEN on_ebay THEN frame_text WHEN kind BETWEEN 1 AND 4 THEN description END AS m_description,
    CASE WHEN kind IN (1, 2, 3) THEN image_url END AS m_image,
    CASE WHEN kind = 1 THEN '2020-01-02' END AS m_date,
    CASE WHEN kind BETWEEN 1 AND 4 THEN p_type END AS m_category,
    CASE WHEN kind BETWEEN 1 AND 4 THEN asked END AS m_price,
    CASE kind WHEN 1 THEN 'USD' WHEN 2 THEN 'GBP' WHEN 3 THEN 'EUR' WHEN 4 THEN 'CAD' END AS m_currency,
    CASE WHEN on_ebay OR site = 'picclick' OR kind IN (1, 2) THEN s_name END AS m_seller,
    CASE kind WHEN 1 THEN 'Organization' WHEN 2 THEN 'Person' END AS m_type,
    CASE WHEN on_ebay OR kind IN (1, 3) THEN shop_url END AS m_url,
    CASE WHEN on_ebay THEN '99.5% positive; ' || p_brand END AS m_info,
    CASE WHEN on_ebay OR kind IN (1, 2) THEN country END AS m_location
  FROM pages WHERE turn <> 12
),
listings AS (
  SELECT url,
    arg_min(title, k) FILTER (WHERE title IS NOT NULL) AS title,
    arg_min(text, k) AS text,
    arg_min(site, k) || '.com' AS domain,
    arg_min(m_name, k) FILTER (WHERE m_name IS NOT NULL) AS name,
    arg_min(m_description, k) FILTER (WHERE m_description IS NOT NULL) AS description,
    arg_min(m_image, k) FILTER (WHERE m_image IS NOT NULL) AS image,
    arg_min(retrieved, k) AS retrieved,
    arg_min(m_date, k) FILTER (WHERE m_date IS NOT NULL) AS production_data,
    arg_min(m_category, k) FILTER (WHERE m_category IS NOT NULL) AS category,
    arg_min(m_price, k) FILTER (WHERE m_price IS NOT NULL) AS price,
    arg_min(m_currency, k) FILTER (WHERE m_currency IS NOT NULL) AS currency,
    arg_min(m_seller, k) FILTER (WHERE m_seller IS NOT NULL) AS seller,
    arg_min(m_type, k) FILTER (WHERE m_type IS NOT NULL) AS seller_type,
    arg_min(m_url, k) FILTER (WHERE m_url IS NOT NULL) AS seller_url,
    arg_min(m_info, k) FILTER (WHERE m_info IS NOT NULL) AS seller_info,
    arg_min(m_location, k) FILTER (WHERE m_location IS NOT NULL) AS location
  FROM merged GROUP BY url HAVING count(title) > 0
)"""

_JOB = f"""
WITH {_LISTINGS},
labels_of AS ({_best_label('listings', 'url', 'text', ZERO_SHOT_LABELS)})
SELECT url, title, md5(text) AS text_md5, name, description, retrieved, round(price, 6) AS price,
       currency, seller, seller_url, location, n_name AS loc_name, n_nationkey * 1.5::DOUBLE AS lat,
       n_nationkey * -2.5::DOUBLE AS lon, r_name AS country,
       CASE WHEN image IS NOT NULL
            THEN 'images-2023-02/' || {_row_id("'all~' || url")} || '.png' END AS image_path,
       label_product, score_product
FROM listings LEFT JOIN nation ON location = n_name LEFT JOIN region ON n_regionkey = r_regionkey
JOIN labels_of USING (url)"""


def _evidence(kind: int, **columns: str) -> str:
    """Candidates of one kind of metadata; columns that are not given are NULL."""
    names = (
        "name description image production_data category price currency seller seller_type "
        "seller_url location"
    ).split()
    values = ", ".join(
        f"{columns.get(n, 'NULL::DOUBLE' if n == 'price' else 'NULL::VARCHAR')} AS {n}" for n in names
    )
    # The page that repeats the one before it holds that page's evidence.
    return f"""
    WITH {_PAGES}, shown AS (
      SELECT * FROM pages WHERE turn <> 12
      UNION ALL BY NAME SELECT * REPLACE (k + 1 AS k) FROM pages
      WHERE turn = 11 AND k + 1 < (SELECT count(*) FROM part)
    )
    SELECT k AS page_order, 0 AS src_ord, {values} FROM shown WHERE kind = {kind}"""


_PHRASED = """(SELECT doc_id, lang, source, text || CASE doc_id % 10
    WHEN 3 THEN ' Item Not found.' WHEN 4 THEN ' item not found' ELSE '' END AS text FROM documents)"""
_NO_PHRASE = " AND ".join(f"NOT contains(text, '{p}')" for p in PHRASES_TO_FILTER)
_TEXT_KEY = r"sha256(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')))"
_RANGE = """
SELECT event_id, user_id, text FROM (
  SELECT event_id, user_id, ts,
         (['Item NOT found.', 'notfound', 'No exact  matches-found'])[(event_id % 5 + 1)::INT] AS text
  FROM events)
WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'
  AND NOT coalesce(regexp_matches(lower(text), '(result|exact|item)?\\W*not\\W+found|no\\W+exact\\W+matches\\W+found'), false)"""
_VISIBLE = r"""regexp_replace(regexp_replace(html,
    '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<![^>]*>', '', 'g'), '<[^>]*>', '', 'g')"""


def _decoded(text: str) -> str:
    """The entities the pages hold; at the end of a cut text the semicolon may be missing."""
    for entity, char in (("&quot", '"'), ("&middot", "·"), ("&copy", "©"), ("&amp", "&")):
        text = f"regexp_replace({text}, '{entity};?', '{char}', 'g')"
    return text


_PRICES = """(SELECT p_partkey, p_partkey % 6 AS style, p_retailprice AS p FROM part)"""

_BAYES = """
WITH words AS (
  SELECT doc_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM documents)
  WHERE word <> '' GROUP BY ALL
), counts AS (
  SELECT word, sum(CASE WHEN quality = 1 THEN n ELSE 0 END) AS n1,
    sum(CASE WHEN quality = 0 THEN n ELSE 0 END) AS n0
  FROM words JOIN labels USING (doc_id) WHERE doc_id % 2 = 0 GROUP BY word
), size AS (
  SELECT count(*) AS v, sum(n1) AS all1, sum(n0) AS all0 FROM counts
), weights AS (
  SELECT word, ln((n1 + 1) / (all1 + v)) - ln((n0 + 1) / (all0 + v)) AS weight FROM counts, size
), odds AS (
  SELECT ln(count(*) FILTER (WHERE quality = 1) / count(*) FILTER (WHERE quality = 0)) AS odds
  FROM labels JOIN documents USING (doc_id) WHERE doc_id % 2 = 0
), sums AS (
  SELECT doc_id, sum(n * weight) AS total FROM words JOIN weights USING (word) GROUP BY doc_id
), found AS (
  SELECT doc_id, coalesce(total, 0) + odds AS x
  FROM documents LEFT JOIN sums USING (doc_id), odds
)"""

ORACLES: dict[str, str] = {
    "listing_merge": f"""
        WITH {_LISTINGS}
        SELECT url, title, md5(text) AS text_md5, domain, name, description, image, retrieved,
               production_data, category, round(price, 6) AS price, currency, seller, seller_type,
               seller_url, seller_info, location, {_row_id(f"'{SNAPSHOT}~' || url")} AS id
        FROM listings""",
    "batch_run": _JOB,
    "stream_ingest": _JOB,
    "multi_run_merge": _JOB,
    "batch_then_stream": _JOB,
    "arrival_order": _JOB,
    "concurrent_commits": _JOB,
    "quarantine": """
        SELECT 'all' AS snapshot, 'malformed' AS reason, '{"url": "cut ' || url AS line FROM pages
        UNION ALL
        SELECT 'all', 'not base64', url FROM pages WHERE html IS NOT NULL""",
    "file_counters": """
        SELECT 'all' AS snapshot, 3 * count(*) AS received,
               count(*) FILTER (WHERE html <> '') + count(html) AS kept, count(*) AS malformed
        FROM pages""",
    "crawl_archive_scan": """
        SELECT url, replace(regexp_extract(url, '//([^/?#]*)', 1), 'www.', '') AS domain,
               strftime(make_timestamp(page_id * 1000000), '%Y-%m-%dT%H:%M:%S.%g+0000') AS retrieved,
               md5(html) AS html_md5
        FROM pages WHERE html <> ''""",
    "temporal_scan": """
        SELECT strftime(DATE '2024-01-01' + (6 * (date_diff('day', DATE '2024-01-01', ts::DATE) // 6))::INT,
                        '%Y-%m-%d') AS snapshot,
               count(*) AS n_pages,
               strftime(min(date_trunc('millisecond', ts)), '%Y-%m-%dT%H:%M:%S.%g+0000') AS first_retrieved,
               sum(length(props))::BIGINT AS n_chars
        FROM events GROUP BY 1""",
    "index_hit_scan": f"""
        SELECT url, lang AS title, source || '.com' AS domain, md5(text) AS text_md5,
               '2024-01-01T00:00:00.000+0000' AS retrieved, {_row_id("'hits~' || url")} AS id
        FROM (SELECT *, 'https://www.' || source || '.com/itm/' || doc_id AS url FROM {_PHRASED})
        WHERE text <> '' AND {_NO_PHRASE}""",
    "time_range_extract": _RANGE,
    "index_export": _RANGE,
    "doc_count_by_source": "SELECT source, count(*) AS n_docs FROM documents GROUP BY source",
    "object_listing": "SELECT DISTINCT 'lang=' || lang AS folder, true AS filled FROM documents",
    "partitioned_sink": """
        SELECT lang AS snapshot, 'run-1' AS run_id, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_chars
        FROM documents GROUP BY lang""",
    "csv_roundtrip": """
        SELECT doc_id, md5(text) AS text_md5, '["' || lang || '","' || source || '"]' AS seller_info
        FROM documents""",
    "skip_processed": """
        SELECT 'all' AS snapshot, doc_id::VARCHAR AS source_file FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "backfill_enrichment": f"""
        SELECT url, 'run-' || (p_partkey % 16) AS run_id,
               CASE WHEN p_size % 3 > 0 THEN 'images-2023-02/' || {_row_id(f"'{SNAPSHOT}~' || url")}
                    || '.png' END AS image_path
        FROM (SELECT *, 'https://www.example.com/itm/' || p_partkey AS url FROM part)
        WHERE (p_partkey % 16) % 2 = 1""",
    "listing_filter": f"""
        WITH {_PAGES}
        SELECT url, title FROM pages WHERE turn NOT IN (8, 12)
        UNION ALL
        SELECT 'https://www.' || o.site || '.com/itm/' || o.k, p.title
        FROM offers o JOIN pages p ON o.k = p.k + 1 WHERE o.turn = 12""",
    "page_domain": """
        SELECT page_id, replace(regexp_extract(url, '//([^/?#]*)', 1), 'www.', '') AS domain,
               split_part(replace(regexp_extract(url, '//([^/?#]*)', 1), 'www.', ''), '.', 1) AS site
        FROM pages""",
    "page_title": f"""
        SELECT page_id, nullif({_decoded("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}, '') AS title
        FROM pages""",
    "page_text": f"SELECT page_id, md5({_decoded(_VISIBLE)}) AS text_md5 FROM pages",
    "fetch_time": """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g+0000') AS retrieved,
               epoch_us(ts) // 1000 AS retrieved_ms
        FROM events""",
    "price_scalar": f"""
        SELECT p_partkey, round(CASE style WHEN 0 THEN p WHEN 1 THEN p * 100
            WHEN 2 THEN ('10' || printf('%.0f', p))::DOUBLE WHEN 3 THEN p END, 6) AS price
        FROM {_PRICES}""",
    "price_list": f"""
        SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN round((p + p * 10) / 2, 6) END AS price
        FROM {_PRICES}""",
    "currency_join": """
        SELECT p_brand, array_to_string(list_sort(list(DISTINCT p_type)), ', ') AS currency
        FROM part GROUP BY p_brand""",
    "text_repair": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "text_keys": f"SELECT doc_id, {_TEXT_KEY} AS text_key FROM documents",
    "description_cleanup": """
        SELECT p_partkey, 'Great ' || p_name || ' ' || p_type AS description FROM part""",
    "image_values": """
        SELECT p_partkey, CASE WHEN p_partkey % 6 < 5 THEN p_name END AS image FROM part""",
    "type_contract": """
        SELECT p_partkey::VARCHAR AS url,
               CASE WHEN p_partkey % 2 = 0 THEN round(p_retailprice, 6) END AS price,
               '{"b":"' || p_brand || '"}' AS category, p_name AS name, NULL::VARCHAR AS seller
        FROM part""",
    "row_ids": f"""
        SELECT page_id, id, 'images/crawl/' || id || '.png' AS image_key
        FROM (SELECT page_id, {_row_id("'all~' || url")} AS id FROM pages)""",
    "extract_jsonld": _evidence(
        1,
        name="p_name",
        description="description",
        image="image_url",
        production_data="'2020-01-02'",
        category="p_type",
        price="round(asked, 6)",
        currency="'USD'",
        seller="s_name",
        seller_type="'Organization'",
        seller_url="shop_url",
        location="country",
    ),
    "extract_microdata": _evidence(
        2,
        name="p_name",
        description="description",
        image="image_url",
        category="p_type",
        price="round(asked, 6)",
        currency="'GBP'",
        seller="s_name",
        seller_type="'Person'",
        location="country",
    ),
    "extract_opengraph": _evidence(
        3,
        name="p_name",
        description="description",
        image="image_url",
        category="p_type",
        price="round(asked, 6)",
        currency="'EUR'",
        seller_url="shop_url",
    ),
    "extract_dublincore": _evidence(
        4,
        name="'description'",
        description="description",
        category="p_type",
        price="round(asked, 6)",
        currency="'CAD'",
    ),
    "extract_ebay": f"""
        WITH {_PAGES}
        SELECT o.k AS page_order,
               CASE WHEN p.kind = 5 THEN p.s_name END AS seller,
               CASE WHEN p.kind = 5 THEN '99.5% positive; ' || p.p_brand END AS seller_info,
               CASE WHEN p.kind = 5 THEN p.shop_url END AS seller_url,
               CASE WHEN p.kind = 5 THEN p.country END AS location
        FROM (SELECT k, site, CASE WHEN turn = 12 THEN k - 1 ELSE k END AS shown FROM usable) o
        JOIN pages p ON p.k = o.shown WHERE o.site = 'ebay'""",
    "ebay_description": f"""
        WITH {_PAGES}
        SELECT o.k AS page_order,
               CASE WHEN p.kind = 5 THEN 'https://frames.example.com/itmdesc/' || p.k END AS frame_src,
               CASE WHEN p.kind = 5 THEN p.frame_text END AS frame_description
        FROM (SELECT k, CASE WHEN turn = 12 THEN k - 1 ELSE k END AS shown FROM usable) o
        JOIN pages p ON p.k = o.shown""",
    "domain_rules": f"""
        WITH {_OFFERS}
        SELECT o.k AS page_order, p.p_name AS name, p.s_name AS seller, NULL::VARCHAR AS currency
        FROM (SELECT k, CASE WHEN turn = 12 THEN k - 1 ELSE k END AS shown,
                     CASE WHEN turn = 9 THEN k - 1 ELSE k END AS url_key
              FROM offers WHERE turn NOT IN (0, 1, 2)) o
        JOIN offers p ON p.k = o.shown
        WHERE (o.url_key // 6) % 3 = 1""",
    "candidate_counts": f"""
        WITH {_PAGES},
        shown AS (
          SELECT o.site, p.kind
          FROM (SELECT k, site, CASE WHEN turn = 12 THEN k - 1 ELSE k END AS shown FROM usable) o
          JOIN pages p ON p.k = o.shown)
        SELECT unnest(range(7))::INT AS src_rank,
               unnest([count(*), count(*) FILTER (WHERE site = 'ebay'),
                       count(*) FILTER (WHERE site = 'picclick'), count(*) FILTER (WHERE kind = 2),
                       count(*) FILTER (WHERE kind = 3), count(*) FILTER (WHERE kind = 4),
                       count(*) FILTER (WHERE kind = 1)]) AS n_candidates
        FROM shown""",
    "dedup_text": f"""
        SELECT doc_id, source, n_chars FROM documents
        QUALIFY row_number() OVER (PARTITION BY {_TEXT_KEY} ORDER BY doc_id) = 1""",
    "dedup_history": f"""
        SELECT doc_id, source, n_chars FROM (
          SELECT d.*, row_number() OVER (PARTITION BY {_TEXT_KEY} ORDER BY d.doc_id) AS place,
                 count(l.quality) OVER (PARTITION BY {_TEXT_KEY}) AS seen
          FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
        WHERE place = 1 AND seen = 0""",
    "stream_dedup": f"SELECT DISTINCT {_TEXT_KEY} AS text_key FROM documents",
    "geocode_hierarchy": """
        WITH RECURSIVE places AS (
          SELECT 'r' || r_regionkey AS id, NULL::VARCHAR AS parent FROM region
          UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
          UNION ALL SELECT 's' || s_suppkey, CASE s_suppkey % 20 WHEN 0 THEN 's' || s_suppkey
            WHEN 1 THEN 'gone' ELSE 'n' || s_nationkey END FROM supplier
          UNION ALL SELECT 'c' || c_custkey, 's' || c_custkey % 120 FROM customer
        ), up AS (
          SELECT id, id AS at, 0::BIGINT AS levels FROM places
          UNION ALL
          SELECT up.id, q.id, up.levels + 1 FROM up JOIN places p ON p.id = up.at
          JOIN places q ON q.id = p.parent WHERE up.levels < 8
        ), tops AS (
          SELECT up.* FROM up JOIN places p ON p.id = up.at
          WHERE p.parent IS NULL OR p.parent NOT IN (SELECT id FROM places)
        )
        SELECT places.id AS place_id, tops.at AS top, tops.levels
        FROM places LEFT JOIN tops ON tops.id = places.id""",
    "geocode": """
        SELECT s_suppkey,
               CASE s_suppkey % 5 WHEN 0 THEN n_name
                    WHEN 1 THEN 'Springfield, ' || n_name || ', NATION_0'
                    WHEN 2 THEN 'Nowhere' WHEN 4 THEN 'USA' END AS location,
               CASE WHEN s_suppkey % 5 < 2 THEN n_name WHEN s_suppkey % 5 = 4 THEN 'USA' END AS loc_name,
               CASE WHEN s_suppkey % 5 < 2 THEN n_nationkey * 1.5::DOUBLE
                    WHEN s_suppkey % 5 = 4 THEN 40.0::DOUBLE END AS lat,
               CASE WHEN s_suppkey % 5 < 2 THEN n_nationkey * -2.5::DOUBLE
                    WHEN s_suppkey % 5 = 4 THEN -100.0::DOUBLE END AS lon,
               CASE WHEN s_suppkey % 5 < 2 THEN r_name WHEN s_suppkey % 5 = 4 THEN 'AMERICA' END AS country
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "image_manifest": f"""
        WITH listings AS (
          SELECT 'https://www.example.com/itm/' || p_partkey AS url,
                 CASE WHEN p_partkey % 3 = 0 THEN 0 WHEN p_partkey % 7 > 0 THEN p_partkey END AS picture
          FROM part)
        SELECT l.url, {_row_id("'all~' || url")} AS id,
               CASE WHEN p.p_size % 2 = 0
                    THEN 'images-2023-02/shop/' || {_row_id("'all~' || url")} || '.png' END AS image_path
        FROM listings l LEFT JOIN part p ON p.p_partkey = l.picture""",
    "run_counters": f"""
        SELECT source, count(*) AS received,
               count(*) FILTER (WHERE text <> '' AND {_NO_PHRASE}) AS kept,
               sum(strlen(text))::BIGINT AS bytes
        FROM {_PHRASED} GROUP BY source""",
    "naive_bayes": f"""{_BAYES}
        SELECT doc_id, (x > 0)::INT AS label, round(1 / (1 + exp(-abs(x))), 4) AS score FROM found""",
    "naive_bayes_metrics": f"""{_BAYES}
        SELECT quality AS truth, (x > 0)::INT AS label, count(*) AS n
        FROM found JOIN labels USING (doc_id) WHERE doc_id % 2 = 1 GROUP BY ALL""",
    "confusion_table": """
        SELECT quality, toxic, count(*) AS n FROM labels GROUP BY quality, toxic""",
    "label_metrics": """
        WITH s AS (
          SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 1)::DOUBLE AS tp,
                 count(*) FILTER (WHERE quality = 0 AND toxic = 1)::DOUBLE AS fp,
                 count(*) FILTER (WHERE quality = 1 AND toxic = 0)::DOUBLE AS fn,
                 count(*)::DOUBLE AS n, count(*) FILTER (WHERE quality = toxic)::DOUBLE AS same
          FROM labels),
        r AS (SELECT same / n AS accuracy, tp / nullif(tp + fp, 0) AS "precision",
                     tp / nullif(tp + fn, 0) AS recall FROM s)
        SELECT round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision",
               round(recall, 6) AS recall,
               round(2 * "precision" * recall / nullif("precision" + recall, 0), 6) AS f1
        FROM r""",
    "zero_shot": f"WITH {_OFFERS} {_best_label('offers', 'k', 'description', ZERO_SHOT_LABELS)}",
    "zero_shot_documents": _best_label(
        "documents", "doc_id", "text", ["the hand", "und der", "est que", "los que"]
    ),
    "multi_model": """
        SELECT doc_id, (length(text) > 500)::INT AS label_short,
               CASE WHEN length(text) > 500 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS score_short,
               (length(text) > 5000)::INT AS label_long,
               CASE WHEN length(text) > 5000 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS score_long
        FROM documents""",
    "label_sample": """
        SELECT source, doc_id FROM documents
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || '~42'), doc_id) <= 5""",
    "keyword_search": """
        SELECT doc_id, matches FROM (
          SELECT doc_id, ((length(t) - length(replace(t, 'the', ''))) // 3
                          + (length(t) - length(replace(t, 'que', ''))) // 3)::INT AS matches
          FROM (SELECT doc_id, lower(text) AS t FROM documents))
        WHERE matches > 0 ORDER BY matches DESC, doc_id LIMIT 20""",
    "ranked_search": r"""
        WITH cut AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS words
                     FROM documents),
        whole AS (SELECT count(*) AS n, sum(len(words)) / count(*) AS mean FROM cut),
        asked AS (SELECT DISTINCT unnest(first_words) AS word
                  FROM (SELECT words[1:8] AS first_words FROM cut ORDER BY doc_id LIMIT 1)),
        found AS (SELECT doc_id, asked.word, len(words) AS length, count(*) AS times
                  FROM (SELECT doc_id, words, unnest(words) AS word FROM cut) AS listed JOIN asked USING (word)
                  GROUP BY doc_id, asked.word, len(words)),
        holders AS (SELECT word, count(*) AS holders FROM found GROUP BY word)
        SELECT doc_id, round(sum(ln(1 + (n - holders + 0.5) / (holders + 0.5)) * times * 2.2
                                 / (times + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score,
               count(*)::INT AS matched
        FROM found JOIN holders USING (word), whole
        GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 20""",
    "phrase_search": r"""
        WITH cut AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS words
                     FROM documents),
        asked AS (SELECT words[1] AS one, words[2] AS two FROM cut ORDER BY doc_id LIMIT 1),
        placed AS (SELECT doc_id, unnest(list_filter(range(1, len(words)),
                            lambda i: words[i] = one AND words[i + 1] = two)) AS place
                   FROM cut, asked)
        SELECT doc_id, count(*)::INT AS occurrences, (min(place) - 1)::INT AS first_position
        FROM placed GROUP BY doc_id""",
    "random_search": """
        SELECT doc_id FROM documents ORDER BY md5(doc_id || '~42'), doc_id LIMIT 20""",
    "vector_search": """
        SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[],
                 (SELECT arg_min(embedding, vec_id) FROM embeddings)::DOUBLE[]), 6) AS similarity
        FROM embeddings ORDER BY list_cosine_similarity(embedding::DOUBLE[],
                 (SELECT arg_min(embedding, vec_id) FROM embeddings)::DOUBLE[]) DESC, vec_id LIMIT 10""",
    "label_export": """
        SELECT doc_id, lang, CASE WHEN quality = 1 THEN quality ELSE toxic END AS label
        FROM documents LEFT JOIN labels USING (doc_id)""",
}
