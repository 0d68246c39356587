"""SQL that states the results of the queries from the base tables, where SQL can."""

OP8 = """
WITH v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(
    embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.id AS query_id, c.id AS vec_id,
    list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.id <> c.id
  WHERE q.id % 100 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
    vec_id, score
  FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""

_BOTH = ("accepted", "rejected")


def _order(k: int) -> str:
    """One order of the smoothed character models."""
    parts = []
    for c in _BOTH:
        shorter = f"s.p_{c}" if k > 1 else "(1.0::DOUBLE / 256)"
        parts.append(f"(n.{c} + 2.0::DOUBLE * {shorter}) / (h.{c} + 2.0::DOUBLE) AS p_{c}")
    below = f"JOIN o{k - 1} s ON s.gram = substr(n.gram, 2)" if k > 1 else ""
    return f"""
n{k} AS (
  SELECT substr(gram, {6 - k}) AS gram, sum(accepted) AS accepted, sum(rejected) AS rejected
  FROM grams GROUP BY 1
), h{k} AS (
  SELECT substr(gram, 1, {k - 1}) AS context, sum(accepted) AS accepted, sum(rejected) AS rejected
  FROM n{k} GROUP BY 1
), o{k} AS (
  SELECT n.gram, {", ".join(parts)}
  FROM n{k} n JOIN h{k} h ON h.context = substr(n.gram, 1, {k - 1}) {below}
)"""


OP4 = f"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), judged AS (
  SELECT *, host || path AS address,
    CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1')
        THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/')
        THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
    END AS rule
  FROM parts
), ruled AS (
  SELECT *, rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') AS blocked FROM judged
), texts AS (
  SELECT address,
    count(*) FILTER (WHERE NOT blocked) AS accepted, count(*) FILTER (WHERE blocked) AS rejected,
    substr(md5(address), 1, 1) IN ('0', '1', '2', '3') AND max(rule) IS NOT NULL AS held_out
  FROM ruled WHERE address <> '' GROUP BY address
), spots AS (
  SELECT *, unnest(range(1, length(address) + 2)) AS i FROM texts
), pieces AS (
  SELECT *, substr(repeat(chr(2), 4) || address || chr(3), i::INTEGER, 5) AS gram FROM spots
), grams AS (
  SELECT gram, sum(CASE WHEN held_out THEN 0 ELSE accepted END) AS accepted,
    sum(CASE WHEN held_out THEN 0 ELSE rejected END) AS rejected
  FROM pieces GROUP BY gram
), {", ".join(_order(k) for k in range(1, 6))},
scores AS (
  SELECT p.address, p.rejected, p.held_out, avg(ln(o.p_rejected) - ln(o.p_accepted)) AS score
  FROM pieces p JOIN o5 o ON o.gram = p.gram
  WHERE p.held_out OR p.accepted + p.rejected = 0
  GROUP BY 1, 2, 3
), facts AS (
  SELECT count(*) FILTER (WHERE rejected = 0) AS n_a, count(*) FILTER (WHERE rejected > 0) AS n_r,
    avg(score) FILTER (WHERE rejected = 0) AS m_a, avg(score) FILTER (WHERE rejected > 0) AS m_r,
    sum(score * score) FILTER (WHERE rejected = 0) AS s_a,
    sum(score * score) FILTER (WHERE rejected > 0) AS s_r
  FROM scores WHERE held_out
), slope AS (
  SELECT *, (m_r - m_a)
    / greatest((s_a - n_a * m_a * m_a + s_r - n_r * m_r * m_r) / (n_a + n_r), 1e-6) AS b
  FROM facts
)
SELECT r.page_id, r.host, r.path, r.rule,
  CASE WHEN r.blocked THEN 'block' WHEN r.rule IS NOT NULL THEN 'allow'
    WHEN s.score * l.b + ln(l.n_r / l.n_a) - l.b * (l.m_a + l.m_r) / 2 > 0 THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN (SELECT address, score FROM scores WHERE NOT held_out) s
  ON s.address = r.address
CROSS JOIN slope l
"""

def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII string, bit by bit."""
    bit = "lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda y: ascii(y)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {byte}), 4294967295::BIGINT)"


OP12 = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    concat(strlen(coalesce(role, '')), ':', role, text) AS said, strlen(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT c, {_crc32("c::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT c FROM t)
), r AS (
  SELECT i.c, 0 AS part, t.pos, t.said, t.size FROM ids i JOIN t ON t.c = i.c - i.c % 5 AND t.pos <= i.h
  UNION ALL
  SELECT i.c, 1, t.pos, t.said, t.size FROM ids i JOIN t ON t.c = i.c AND t.pos > i.h
), s AS (
  SELECT ids.c, list(said ORDER BY part, pos) FILTER (said IS NOT NULL) AS said,
    list(size ORDER BY part, pos) FILTER (said IS NOT NULL) AS sizes
  FROM ids LEFT JOIN r ON r.c = ids.c GROUP BY 1
), m AS (
  SELECT c, d, coalesce(said[1:d], []) AS node, d = coalesce(len(said), 0) AS at_end,
    CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM s, unnest(range(0, coalesce(len(said), 0) + 1)) AS u(d)
), n AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, max(size) AS size,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (at_end), '')) AS ends_sha256
  FROM m GROUP BY 1, 2
), k AS (
  SELECT node[1:d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1
), own AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.node = n.node
), below AS (
  SELECT node[1:i] AS node, sum((n_children = 0)::BIGINT) AS n_leaves,
    sum((n_convs - 1) * size) AS saved_tokens
  FROM own, unnest(range(0, d + 1)) AS u(i) GROUP BY 1
)
SELECT own.conv_id, own.d AS depth, up.conv_id AS parent_conv_id, own.n_convs, own.n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, own.ends_sha256
FROM own JOIN below ON below.node = own.node
LEFT JOIN own up ON own.d > 0 AND up.node = own.node[1:own.d - 1]
"""

def _turn(state: str, given: str, kept: dict[str, str]) -> str:
    """The cheapest and then first edits from a state, if the first one is not an insertion."""
    options = [f"{{'c': 4 + p.{state}.c, 'e': 'D' || p.{state}.e}}"]
    for initial, to in kept.items():
        options.append(
            f"CASE WHEN NOT b.gone AND b.initial = '{initial}' "
            f"THEN {{'c': b.cut + p.{to}.c, 'e': 'K' || p.{to}.e}} END"
        )
    options.append(
        f"CASE WHEN NOT b.gone THEN {{'c': 3 + b.cut + p.{given}.c, 'e': 'R' || p.{given}.e}} END"
    )
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))"


def _least(state: str, given: str) -> str:
    return f"list_min([{state}, {{'c': 3 + {given}.c, 'e': 'I' || {given}.e}}])"


OP13 = f"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")} % 20 AS x
  FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN x = 4 THEN 'user' ELSE role END AS role,
    CASE x WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM t, unnest(CASE WHEN x = 3 THEN [1, 2] ELSE [1] END) AS u(time)
  WHERE x <> 0
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown, role[1] AS initial
  FROM d
), f AS (
  SELECT *, shown = '' AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    shown[-1] NOT IN ('.', '!', '?') AS short,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS clash,
    count(*) OVER (PARTITION BY conv_id) AS size
  FROM n
), g AS (
  SELECT *, blank OR again AS gone, CASE WHEN short THEN 3 ELSE 0 END AS cut FROM f
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
    count(*) FILTER (short AND NOT gone) AS truncated, count(*) FILTER (clash) AS illegal
  FROM g GROUP BY 1
), rest AS (
  SELECT conv_id, size + 1 AS i, {{'c': 0, 'e': ''}} AS v0, {{'c': 6, 'e': 'II'}} AS vs,
    {{'c': 3, 'e': 'I'}} AS vu, {{'c': 0, 'e': ''}} AS va
  FROM g WHERE i = 1
  UNION ALL
  SELECT conv_id, i, {_least("v0", "wu")}, {_least("vs", "wu")}, wu, wa
  FROM (
    SELECT *, {_least("vu", "va")} AS wu, {_least("va", "vu")} AS wa
    FROM (
      SELECT b.conv_id, b.i,
        {_turn("v0", "vu", {"s": "vs", "u": "vu"})} AS v0, {_turn("vs", "vu", {"u": "vu"})} AS vs,
        {_turn("vu", "va", {"a": "va"})} AS vu, {_turn("va", "vu", {"u": "vu"})} AS va
      FROM rest p JOIN g b ON b.conv_id IS NOT DISTINCT FROM p.conv_id AND b.i = p.i - 1
    )
  )
), audits AS (
  SELECT conv_id, v0.c AS cost, v0.e AS audit FROM rest WHERE i = 1
), edits AS (
  SELECT conv_id, spot, audit[spot] AS edit, audit,
    spot - length(replace(translate(audit[1:spot], 'DKR', '___'), '_', '')) AS i
  FROM audits, unnest(range(1, length(audit) + 1)) AS u(spot)
), placed AS (
  SELECT e.conv_id, e.spot, e.edit, g.role, g.text,
    row_number() OVER (PARTITION BY e.conv_id ORDER BY e.spot) AS place,
    first_value(e.edit = 'K' AND g.initial = 's') OVER (PARTITION BY e.conv_id ORDER BY e.spot) AS led
  FROM edits e LEFT JOIN g ON e.edit <> 'I' AND g.conv_id IS NOT DISTINCT FROM e.conv_id AND g.i = e.i
  WHERE e.edit <> 'D'
), said AS (
  SELECT conv_id, sha256(string_agg(
    CASE WHEN edit = 'K' THEN role WHEN (place - led::INTEGER) % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY spot)) AS repaired_sha256
  FROM placed GROUP BY 1
)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN audits ON audits.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM k.conv_id
"""

ORACLES: dict[str, str] = {
    "op4_url_filter": OP4,
    "op8_exact_topk": OP8,
    "op12_prefix_trie": OP12,
    "op13_conversation_repair": OP13,
}
