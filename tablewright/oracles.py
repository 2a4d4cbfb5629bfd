"""DuckDB SQL that gives the rows of the registered queries."""

from __future__ import annotations

from tablewright.queries import CLAIMS, EVENT_COLUMNS, SITE


HREFS = r"""regexp_extract_all(html, '(?i)<a[^>]+href=["'']([^"'']+)["'']', 1)"""
PATH = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
HOST = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
#: RE2 has no lookahead: one branch for each place of the first hyphen.
SLUG = "/(?:-[a-z0-9-]{5,}|[a-z0-9]-[a-z0-9-]{4,}|[a-z0-9]{2}-[a-z0-9-]{3,}|[a-z0-9]{3}-[a-z0-9-]{2,}|[a-z0-9]{4}-[a-z0-9-]+|[a-z0-9]{5,}-[a-z0-9-]*)/"


def pattern(path: str) -> str:
    out = f"regexp_replace({path}, '[#?].*', '')"
    for rule, to in (
        (r"/([a-z])/[a-z]+\d+[a-z]?\.html$", r"/\1/{id}.html"),
        (r"/(coaches|players|teams)/[a-z]+\d+[a-z]?\.html$", r"/\1/{id}.html"),
        (r"\d{4,}", "{year}"),
        (r"/\d+", "/{n}"),
        (SLUG, "/{slug}/"),
        (r"/[a-z0-9]{14,}/", "/{slug}/"),
        (r"\b(p|t|l|in|pro)-[A-Za-z0-9-]{3,}", r"\1-{id}"),
    ):
        out = f"regexp_replace({out}, '{rule}', '{to}', 'g')"
    return f"coalesce(nullif({out}, ''), '/')"


def shard(text: str, n: int, algorithm: str = "sha256") -> str:
    out = "0"
    for i in range(8 if algorithm == "sha256" else 5):
        out = f"(({out}) * {2**32 % n} + ('0x' || substr({algorithm}({text}), {i * 8 + 1}, 8))::BIGINT) % {n}"
    return f"({out})::INTEGER"


LINKS = f"""
links AS (
  SELECT src, src_order, (i - 1)::INTEGER AS link_pos, href, dst, {pattern("regexp_extract(dst, '^[a-z]+://[^/?#]*([^?#]*)', 1)")} AS url_pattern
  FROM (SELECT url AS src, page_id AS src_order, i, hs[i] AS href, regexp_extract(url, '^[a-z]+://[^/?#]*') || hs[i] AS dst
    FROM (SELECT *, unnest(range(1, len(hs) + 1)) AS i FROM (SELECT *, {HREFS} AS hs FROM pages)))
  WHERE NOT (href LIKE 'mailto:%' OR href LIKE 'javascript:%' OR href LIKE '#%' OR href LIKE 'tel:%'))"""
PATTERNS = f"patterns AS (SELECT {pattern(PATH)} AS url_pattern, count(*)::BIGINT AS pages_seen FROM pages GROUP BY 1)"


def whole(c: str) -> str:
    return f"trunc({c})::BIGINT::VARCHAR"


def items(row: str) -> str:
    """Line items of existing orders with their place on the order's page."""
    return f"""
items AS (
  SELECT *, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, mark) - 1)::INTEGER AS row_pos
  FROM (SELECT l.*, o_custkey, year(o_orderdate)::INTEGER AS year, {row} AS mark FROM lineitem l JOIN orders ON l_orderkey = o_orderkey))"""


ROSTER_ROW = f"'<tr><td>' || {whole('l_linenumber')} || '</td><td><a href=''/football/stats/p-x' || {whole('l_partkey')} || '''>Part ' || {whole('l_partkey')} || '</a></td><td> ' || l_returnflag || '&nbsp; </td></tr>'"
STAT_ROW = f"""'<tr class=''' || lower(l_linestatus) || '''><td><a href=/football/stats/p-x' || {whole('l_partkey')} || '>Part&nbsp;' || {whole('l_partkey')} || '</a></td><td>' || {whole('l_quantity')} || '</td><td>' || {whole('l_extendedprice')} || '</td><td>' || (CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END) || '</td></tr>'"""
GROUP_ROW = f"'<tr><td>' || {whole('l_partkey')} || '</td><td>' || {whole('l_extendedprice')} || '</td><td>' || {whole('l_linenumber')} || '</td></tr>'"
ORPHAN_ROW = f"'<td>' || {whole('l_linenumber')} || '<td>lost</td><td>' || {whole('l_partkey')} || '</td>'"
LINEUP_ROW = f"(CASE WHEN l_linenumber % 3 = 1 THEN '<tr><th colspan=3>Team &amp; ' || l_linestatus || {whole('l_linenumber')} || '</th></tr>' ELSE '' END) || '<tr><td>1</td><td> <b>' || l_returnflag || '</b> </td><td><a href=''/players/x/p' || {whole('l_partkey')} || '.html''>Part <i>' || {whole('l_partkey')} || '</i></a></td></tr>'"
OLDER_ROW = f"'<tr><td>' || {whole('l_quantity')} || '</td><td><svg><path></svg> ' || l_returnflag || ' &amp; </td><td><a href=''/players/part-' || {whole('l_partkey')} || '/stats/''>x</a></td><td>cut</td></tr><tr><td> </td></tr>'"

VERDICT = """CASE WHEN {n} = 0 THEN 'unusable'
  WHEN list_has_all({ids}, ['player', 'team', 'season']) THEN 'canonical_candidate'
  WHEN list_has_all({ids}, ['player', 'season']) THEN 'identity_only'
  WHEN list_has_any({cols}, ['story', 'description', 'note', 'headline']) THEN 'context_only'
  WHEN len({ids}) > 0 THEN 'corroborating_witness' ELSE 'unusable' END"""
STATUS = """CASE WHEN status_code BETWEEN 200 AND 299 THEN 'ok' WHEN status_code = 404 THEN 'absent' WHEN status_code = 429 THEN 'throttled'
  WHEN status_code >= 500 THEN 'retryable' WHEN status_code IN (401, 403) THEN 'blocked' ELSE 'error' END"""
LEDGER = "ledger AS (SELECT event_id, event_type, [200, 204, 301, 401, 403, 404, 410, 429, 500, 503][event_id % 10 + 1]::INTEGER AS status_code FROM events)"


def slug(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[^a-z0-9]+', '_', 'g'), '_')"


def header_keys(labels: str, blank: str, more: str) -> str:
    return f"""
WITH r AS (SELECT p_partkey, (i - 1)::INTEGER AS pos, ls[i] AS label FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT p_partkey, string_split({labels}, ' ') AS ls FROM part))),
b AS (SELECT *, {slug('label')} = '' AS blank, CASE WHEN {slug('label')} = '' THEN {blank} ELSE {slug('label')} END AS base FROM r),
n AS (SELECT *, row_number() OVER (PARTITION BY p_partkey, base ORDER BY pos) AS n FROM b)
SELECT p_partkey, pos, CASE WHEN n = 1 THEN base ELSE base || '_' || n::VARCHAR END AS key{more} FROM n"""


CLAIM_ROWS = ", ".join(f"('{p}', '{n}', {i})" for i, (p, n) in enumerate(CLAIMS))
CLAIMED = f"""claimed AS (
  SELECT p.url_pattern, (SELECT c.dataset FROM (VALUES {CLAIM_ROWS}) c(prefix, dataset, position) WHERE c.prefix <> '/' AND starts_with(p.url_pattern, c.prefix)
    ORDER BY length(c.prefix) DESC, c.position LIMIT 1) AS claimed_by_dataset FROM patterns p)"""
ROOT = "https://www.statscrew.com"
STAT_COLUMNS = ("player", "comp", "comp_2", "team")


def fingerprint(names: tuple[str, ...]) -> str:
    import hashlib
    import json

    return hashlib.sha256(json.dumps(sorted(names), separators=(",", ":")).encode()).hexdigest()


ORACLES = {
    "url_pattern_inventory": f"WITH {LINKS} SELECT url_pattern, count(*)::BIGINT AS links, count(DISTINCT src)::BIGINT AS pages FROM links GROUP BY 1",
    "page_pattern_counts": f"WITH {PATTERNS} SELECT * FROM patterns",
    "link_projection": f"WITH {LINKS} SELECT src, link_pos, href, dst FROM links",
    "link_distinct_sorted": f"SELECT page_id, array_to_string(list_sort(list_distinct({HREFS})), ' ') AS links FROM pages",
    "url_allowed_filter": f"SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https?://') AND {HOST} NOT LIKE 'www.%' AND ({PATH} LIKE '/en%' OR {PATH} LIKE '/de/%')",
    "shard_assignment": f"SELECT page_id, {shard('url', 60)} AS shard, {shard('url', 7, 'sha1')} AS older_shard FROM pages",
    "one_hop_quota_sample": f"""
WITH {LINKS},
first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dst ORDER BY src_order, link_pos) AS k FROM links) WHERE k = 1 AND dst NOT IN (SELECT url FROM pages)),
events AS (SELECT dst, src_order, link_pos, url_pattern, true AS is_link FROM first
  UNION ALL SELECT url, page_id, -1, {pattern(PATH)}, false FROM pages WHERE length(html) > 0)
SELECT dst, src_order, link_pos, url_pattern FROM (SELECT *, row_number() OVER (PARTITION BY url_pattern ORDER BY src_order, link_pos) AS nth FROM events) WHERE nth <= 3 AND is_link""",
    "work_items_from_urls": """
SELECT o_orderkey, dataset, CASE WHEN dataset = 'player_season_stats' THEN 'p|c' || o_custkey::VARCHAR ELSE year(o_orderdate)::VARCHAR || '|C' || o_custkey::VARCHAR END AS key,
  CASE WHEN dataset <> 'player_season_stats' THEN year(o_orderdate)::INTEGER END AS season, CASE WHEN dataset <> 'player_season_stats' THEN 'C' || o_custkey::VARCHAR END AS team,
  CASE WHEN dataset = 'player_season_stats' THEN 'c' || o_custkey::VARCHAR END AS source_player_id
FROM orders, (SELECT unnest(['team_season_roster', 'team_season_stats', 'player_season_stats']) AS dataset)
WHERE (o_orderkey % 4 = 0 AND dataset = 'team_season_roster') OR (o_orderkey % 4 = 1 AND dataset = 'team_season_stats') OR (o_orderkey % 4 = 2 AND dataset = 'player_season_stats')""",
    "dataset_names": f"""
WITH {PATTERNS}
SELECT url_pattern, coalesce(nullif(array_to_string(list_filter(list_transform(list_filter(string_split(trim(url_pattern, '/'), '/'), lambda p: p <> '' AND NOT contains(p, '{{')),
  lambda p: trim(regexp_replace(replace(lower(p), '.html', ''), '[^a-z0-9]+', '_', 'g'), '_')), lambda s: s <> ''), '_'), ''), 'family') AS dataset FROM patterns""",
    "robots_filter": f"SELECT page_id, CASE WHEN {HOST} LIKE '%.org' THEN false WHEN {HOST} LIKE '%.net' THEN true ELSE NOT starts_with({PATH}, '/en') END AS allowed FROM pages",
    "schema_fingerprints": f"SELECT page_id, sha256(to_json(list_sort(list_distinct({HREFS})))::VARCHAR) AS fingerprint FROM pages",
    "surface_verdicts": f"""
WITH e AS (SELECT event_id % 997 AS bucket, value, CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_COLUMNS.items())} END AS c FROM events),
u AS (SELECT bucket, coalesce(list_sort(list(DISTINCT c) FILTER (value > 20)), []) AS cols, count(*) FILTER (value > 20) AS n FROM e GROUP BY 1),
i AS (SELECT *, list_filter(cols, lambda x: x IN ('player', 'team', 'season', 'year')) AS ids FROM u)
SELECT bucket, array_to_string(cols, ',') AS cols, {VERDICT.format(n='n', ids='ids', cols='cols')} AS usability FROM i""",
    "status_classes": f"WITH {LEDGER} SELECT event_id, status_code, {STATUS} AS status FROM ledger",
    "ledger_status_counts": f"WITH {LEDGER} SELECT event_type, {STATUS} AS status, count(*)::BIGINT AS requests FROM ledger GROUP BY ALL",
    "header_unique_keys": header_keys("concat_ws(' ', p_name, p_type, '?', p_name, p_brand, '--', p_type)", "'col_' || pos::VARCHAR", ", label, blank, n > 1 AS duplicate"),
    "older_header_keys": header_keys("concat_ws(' ', p_name, '?', p_type, '!', p_name)", "'col'", ""),
    "squeezed_text": r"SELECT doc_id, sha256(trim(regexp_replace(text, '[\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}]+', ' ', 'g'))) AS squeezed FROM documents",
    "first_seen_content": "SELECT sha256(text) AS content_sha256, min(doc_id) AS doc_id, min_by(source, doc_id) AS source, count(*)::BIGINT AS pages_observed FROM documents GROUP BY 1",
    "provenance_stamps": f"SELECT page_id, sha256(html) AS content_sha256, '1' AS parser_version, {shard('url', 8)} AS shard_id FROM pages",
    "json_lines": """SELECT '{"n_comment":' || coalesce('"' || CASE WHEN n_nationkey % 2 = 0 THEN n_name END || '"', 'null') || ',"n_name":"' || n_name || '","n_nationkey":' || n_nationkey::VARCHAR || ',"n_regionkey":' || n_regionkey::VARCHAR || '}' AS line FROM nation""",
    "manifest_problems": """
SELECT * FROM (SELECT CASE s_suppkey % 5 WHEN 0 THEN '../' WHEN 1 THEN '/' ELSE '' END || s_name AS path,
  CASE WHEN s_suppkey % 5 IN (0, 1) THEN 'unsafe path' WHEN s_suppkey % 7 = 0 THEN 'missing file' WHEN s_suppkey % 3 = 0 THEN 'checksum mismatch' END AS problem FROM supplier) WHERE problem IS NOT NULL""",
    "roster_roundtrip": f"""
WITH {items(ROSTER_ROW)}
SELECT l_orderkey AS order_key, year AS season, 'C' || o_custkey::VARCHAR AS team, 'Part ' || {whole('l_partkey')} AS player, 'x' || {whole('l_partkey')} AS source_player_id, l_returnflag AS position, row_pos FROM items""",
    "stats_roundtrip_tagged": f"""
WITH {items(STAT_ROW)}
SELECT l_orderkey AS order_key, 'passing_stats' AS table_tag, row_pos, year AS season, CASE WHEN l_returnflag = 'N' THEN 'C' || o_custkey::VARCHAR ELSE l_returnflag END AS team, 'Part ' || {whole('l_partkey')} AS player,
  'x' || {whole('l_partkey')} AS source_player_id, lower(l_linestatus) AS row_class, false AS is_total_row, {whole('l_quantity')} AS comp, {whole('l_extendedprice')} AS comp_2, nullif(l_returnflag, 'N') AS stat_team, NULL AS yds FROM items
UNION ALL SELECT DISTINCT l_orderkey, 'receiving', 0, year, 'C' || o_custkey::VARCHAR, 'Totals', NULL, NULL, true, NULL, NULL, NULL, '7' FROM items""",
    "results_roundtrip": """
SELECT 'C' || o_custkey::VARCHAR AS team, year(o_orderdate)::INTEGER AS season, (row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey) - 1)::INTEGER AS row_pos,
  CASE WHEN o_orderstatus = 'F' THEN 'post_season' ELSE 'reg_season' END AS row_class, array_to_string(list_sort(list_distinct(['W' || o_orderkey::VARCHAR, 'C' || o_custkey::VARCHAR])), ' ') AS game_team_ids,
  'May 1' AS date, o_orderkey::VARCHAR AS stat_player, NULL AS col_2, 'W at C' AS game FROM orders""",
    "orphan_rows_roundtrip": f"""
WITH {items(ORPHAN_ROW)},
c AS (SELECT l_orderkey, 2 * row_pos AS spot, 'lost' AS t FROM items UNION ALL SELECT l_orderkey, 2 * row_pos + 1, {whole('l_partkey')} FROM items UNION ALL SELECT l_orderkey, 2 * count(*), 'extra' FROM items GROUP BY 1),
n AS (SELECT l_orderkey, count(*) AS n FROM c GROUP BY 1)
SELECT l_orderkey AS order_key, (n // 2)::INTEGER AS orphan_rows, (n % 2)::INTEGER AS dropped_partial_cells, (spot // 2)::INTEGER AS row_pos, max(CASE WHEN spot % 2 = 0 THEN t END) AS no, max(CASE WHEN spot % 2 = 1 THEN t END) AS part
FROM c JOIN n USING (l_orderkey) WHERE spot // 2 < n // 2 GROUP BY l_orderkey, n, spot // 2""",
    "group_header_roundtrip": f"""
WITH {items(GROUP_ROW)}
SELECT l_orderkey AS order_key, row_pos, 2 AS header_rows, 'part,base,tax' AS headers, 'Price' AS tax_group, {whole('l_partkey')} AS part, {whole('l_extendedprice')} AS base, {whole('l_linenumber')} AS tax FROM items""",
    "lineup_roundtrip": f"""
WITH {items(LINEUP_ROW)},
r AS (SELECT *, last_value(CASE WHEN l_linenumber % 3 = 1 THEN 'Team & ' || l_linestatus || {whole('l_linenumber')} END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY row_pos) AS team FROM items)
SELECT l_orderkey AS order_key, year AS season, team, 'Part ' || {whole('l_partkey')} AS player, 'p' || {whole('l_partkey')} AS source_player_id, l_returnflag AS position FROM r WHERE team IS NOT NULL""",
    "older_table_roundtrip": f"""
WITH {items(OLDER_ROW)}
SELECT l_orderkey AS order_key, year AS season, 'Game Logs' AS "table", row_pos, {whole('l_quantity')} AS fum, l_returnflag || ' &' AS lost, 'x' AS fum_2, {whole('l_quantity')} AS fumbles, l_returnflag || ' &' AS fumbles_lost,
  'part-' || {whole('l_partkey')} AS player_slug FROM items""",
    "column_dictionary": """
WITH n AS (SELECT count(DISTINCT l_orderkey)::BIGINT AS pages FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT table_tag, table_caption, column_key, column_position::INTEGER AS column_position, source_label, source_title, 1 AS header_rows, 0 AS blank_headers, dup::INTEGER AS duplicate_headers, pages AS pages_observed
FROM n, (VALUES ('passing_stats', 'Passing Stats', 'player', 0, 'Player', NULL, 1), ('passing_stats', 'Passing Stats', 'comp', 1, 'Comp', 'Quantity shipped', 1), ('passing_stats', 'Passing Stats', 'comp_2', 2, 'Comp', NULL, 1),
  ('passing_stats', 'Passing Stats', 'stat_team', 3, 'Team', NULL, 1), ('receiving', 'Receiving', 'player', 0, 'player', NULL, 0), ('receiving', 'Receiving', 'yds', 1, 'yds', NULL, 0)) v(table_tag, table_caption, column_key, column_position, source_label, source_title, dup)
WHERE pages > 0""",
    "described_tables": f"""
WITH n AS (SELECT l_orderkey, count(*)::INTEGER AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT l_orderkey AS order_key, 0 AS position, 'comp,comp_2,player,team' AS headers, 4 AS n_headers, n AS n_rows, '{fingerprint(STAT_COLUMNS)}' AS schema_fingerprint, 'corroborating_witness' AS surface FROM n
UNION ALL SELECT l_orderkey, 1, 'player,yds', 2, 1, '{fingerprint(("player", "yds"))}', 'corroborating_witness' FROM n""",
    "pattern_tables": f"""
WITH n AS (SELECT l_orderkey, o_custkey, year(o_orderdate) AS year, count(*)::INTEGER AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
p AS (SELECT *, '{SITE}stats/t-C' || o_custkey::VARCHAR || '/y-' || year::VARCHAR || '?o=' || l_orderkey::VARCHAR AS url, {pattern("'/football/stats/t-C' || o_custkey::VARCHAR || '/y-' || year::VARCHAR")} AS url_pattern FROM n),
e AS (SELECT url_pattern, string_agg(url, ' ' ORDER BY l_orderkey) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY url_pattern ORDER BY l_orderkey) AS k FROM p) WHERE k <= 3 GROUP BY 1)
SELECT url_pattern, count(*)::BIGINT AS pages_seen, any_value(examples) AS examples, 2 AS n_distinct_table_shapes, count(*)::BIGINT AS first_seen_on, max(n)::INTEGER AS first_max_rows, 'comp,comp_2,player,team' AS first_headers FROM p JOIN e USING (url_pattern) GROUP BY 1""",
    "pilot_stability": """
WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
t AS (SELECT l_orderkey, n, 'comp,comp_2,player,team' AS headers, '0' AS positions, n AS linked, 'player,team' AS id_columns FROM n
  UNION ALL SELECT l_orderkey, 1, CASE WHEN l_orderkey % 3 = 0 THEN 'player,yds' ELSE 'player,rec' END, '1', 0, 'player' FROM n)
SELECT headers, count(*)::BIGINT AS pages_carrying, sum(n)::BIGINT AS total_rows, round(count(*) / (SELECT count(*) FROM n), 3) AS page_share,
  CASE WHEN count(*) / (SELECT count(*) FROM n) >= 0.9 THEN 'structural' WHEN count(*) / (SELECT count(*) FROM n) >= 0.5 THEN 'common' ELSE 'variant' END AS stability,
  min_by(linked, l_orderkey)::INTEGER AS rows_with_source_native_id_href, any_value(id_columns) AS id_columns, any_value(positions) AS positions FROM t GROUP BY headers""",
    "harvest_ledger": """
WITH n AS (SELECT l_orderkey, o_custkey, year(o_orderdate) AS year, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT year::VARCHAR || '|C' || o_custkey::VARCHAR || '|' || l_orderkey::VARCHAR AS key, CASE WHEN l_orderkey % 3 = 0 THEN 404 ELSE 200 END AS status_code,
  ['absent', 'ok', 'parse_error'][l_orderkey % 3 + 1] AS status, CASE WHEN l_orderkey % 3 = 2 THEN 'no usable captioned stat rows' END AS error, CASE WHEN l_orderkey % 3 = 1 THEN n + 1 ELSE 0 END::BIGINT AS record_count FROM n""",
    "landed_page_join": "SELECT url, 200 AS status_code, 'ok' AS status FROM pages UNION ALL SELECT url || '/missing', 404, 'absent' FROM pages",
    "longest_prefix_claim": f"WITH {PATTERNS}, {CLAIMED} SELECT * FROM claimed",
    "three_state_report": f"""
WITH {PATTERNS}, {CLAIMED},
held AS (SELECT * FROM (SELECT {pattern(PATH)} AS url_pattern, count(*)::BIGINT AS pages_held FROM pages WHERE page_id % 5 = 0 GROUP BY 1) WHERE pages_held % 2 = 0),
r AS (SELECT url_pattern, coalesce(pages_held, 0) AS pages_already_held, pages_seen, (pages_seen % 3)::INTEGER AS table_shapes, claimed_by_dataset,
  CASE WHEN pages_held > 0 THEN 'HELD' WHEN claimed_by_dataset IS NOT NULL THEN 'DECLARED_NOT_HELD' ELSE 'UNCLAIMED' END AS state FROM patterns JOIN claimed USING (url_pattern) LEFT JOIN held USING (url_pattern))
SELECT url_pattern, state, pages_already_held, pages_seen, table_shapes, table_shapes * 10 AS max_rows, ['', 's1', 's1,s2'][table_shapes + 1] AS surfaces, claimed_by_dataset, table_shapes > 0 AND state <> 'HELD' AS worth_fetching FROM r""",
    "views_left_to_do": f"""
WITH u AS (SELECT c_custkey::VARCHAR AS slug, c_nationkey FROM customer WHERE {shard('c_custkey::VARCHAR', 3, 'sha1')} = 1),
done AS (SELECT o_custkey::VARCHAR AS slug FROM orders GROUP BY 1 HAVING bool_and(o_orderstatus <> 'P'))
SELECT slug, 'career' AS view, NULL::INTEGER AS season, 'https://www.nfl.com/players/' || slug || '/stats/' AS url FROM u WHERE slug NOT IN (SELECT slug FROM done)
UNION ALL SELECT slug, 'logs', (c_nationkey + y)::INTEGER, 'https://www.nfl.com/players/' || slug || '/stats/logs/' || (c_nationkey + y)::VARCHAR || '/' FROM u, (SELECT unnest(range(1990, 1993)) AS y)""",
    "job_matrix": """
WITH t AS (SELECT r_name AS source, n_name AS dataset, (n_nationkey % 5 + 1)::INTEGER AS shards FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT source, dataset, shards, s::INTEGER AS shard FROM (SELECT *, unnest(range(shards)) AS s FROM t WHERE source = 'ASIA') UNION ALL SELECT source, dataset, 3, 2 FROM t""",
    "parallel_cap": """
SELECT greatest(1, least(floor(4.0 * min(r_regionkey * 0.25 + 0.75))::BIGINT, sum(n_nationkey % 5 + 1)))::BIGINT AS max_parallel FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "seed_expansion": """
SELECT 'https://x/' || n_name AS url FROM nation
UNION SELECT 'https://x/' || r_name || '/' || y::VARCHAR || '/' FROM region, (SELECT unnest(range(1900, 1990)) AS y) WHERE y BETWEEN greatest(r_regionkey + 1918, 1920) AND least(r_regionkey * 2 + 1920, 1925)
UNION SELECT 'https://x/t-C' || o_custkey::VARCHAR || '/y-' || year(o_orderdate)::VARCHAR FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997""",
    "holdings_sum": "SELECT event_type AS source, '/u/' || (user_id % 50)::VARCHAR AS url_pattern, count(*) FILTER (value > 30)::BIGINT AS pages_held FROM events GROUP BY ALL",
    "discovery_counts": f"""
WITH {LEDGER}, {PATTERNS}
SELECT (SELECT count(*) FROM ledger)::BIGINT AS requests, (SELECT count(*) FROM ledger WHERE status_code BETWEEN 200 AND 299)::BIGINT AS pages_ok, (SELECT count(*) FROM ledger WHERE status_code = 401)::BIGINT AS robots_denied,
  count(*)::BIGINT AS patterns, count(*) FILTER (pages_seen % 3 > 0)::BIGINT AS patterns_with_tables, sum(pages_seen % 3)::BIGINT AS table_shapes FROM patterns""",
    "gate_reasons": """
WITH e AS (SELECT user_id, count(*) AS requests, count(*) FILTER (event_type = 'error') AS denied, count(*) FILTER (event_type = 'purchase') AS work, count(*) FILTER (event_type = 'view') AS records FROM events GROUP BY 1)
SELECT user_id, CASE WHEN denied = requests THEN 'every request was denied by robots.txt' WHEN work = 0 THEN 'requests gave ZERO work items' END AS census,
  CASE WHEN work = 0 THEN 'no work items: the census failed' WHEN records = 0 THEN 'work items gave ZERO records' END AS harvest,
  CASE WHEN records = 0 THEN 'the pilot fetched 0 pages: the sample says nothing about the family' END AS pilot FROM e""",
    "crawl_depths": """
WITH e AS (SELECT DISTINCT 'c' || o_custkey::VARCHAR AS src, 'o' || o_orderkey::VARCHAR AS dst FROM orders UNION SELECT 'o' || l_orderkey::VARCHAR, 'p' || l_partkey::VARCHAR FROM lineitem
  UNION SELECT 'p' || l_partkey::VARCHAR, 's' || l_suppkey::VARCHAR FROM lineitem UNION SELECT 's' || l_suppkey::VARCHAR, 'c' || l_suppkey::VARCHAR FROM lineitem),
d0 AS (SELECT DISTINCT 'c' || c_custkey::VARCHAR AS url, 0 AS depth FROM customer), d1 AS (SELECT DISTINCT dst AS url, 1 AS depth FROM e JOIN d0 ON src = url),
d2 AS (SELECT DISTINCT dst AS url, 2 AS depth FROM e JOIN d1 ON src = url), d3 AS (SELECT DISTINCT dst AS url, 3 AS depth FROM e JOIN d2 ON src = url),
d4 AS (SELECT DISTINCT dst AS url, 4 AS depth FROM e JOIN d3 ON src = url), d5 AS (SELECT DISTINCT dst AS url, 5 AS depth FROM e JOIN d4 ON src = url)
SELECT url, min(depth)::INTEGER AS depth FROM (SELECT * FROM d0 UNION ALL SELECT * FROM d1 UNION ALL SELECT * FROM d2 UNION ALL SELECT * FROM d3 UNION ALL SELECT * FROM d4 UNION ALL SELECT * FROM d5) GROUP BY url""",
    "census_surfaces": f"""
WITH s AS (SELECT '{ROOT}/football/roster/t-S' || s_suppkey::VARCHAR || '/y-1963' AS url, 'S' || s_suppkey::VARCHAR AS team, '{ROOT}/football/l-n' || s_nationkey::VARCHAR AS nation FROM supplier)
SELECT url, '1963|' || team AS key, 1963 AS season, team, {shard('nation', 3)} AS owner, 1 AS row_count, '["col_0","player","season","team"]' AS columns_json,
  '{fingerprint(("col_0", "player", "season", "team"))}' AS fingerprint, 'canonical_candidate' AS usability FROM s""",
    "census_request_counts": """
SELECT 'ok' AS status, 0 AS depth, 1::BIGINT AS requests UNION ALL SELECT 'ok', 1, count(DISTINCT s_nationkey)::BIGINT FROM supplier UNION ALL SELECT 'ok', 2, count(*)::BIGINT FROM supplier
UNION ALL SELECT * FROM (SELECT 'absent', 1, count(*)::BIGINT AS n FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)) WHERE n > 0""",
    "census_links": """
WITH s AS (SELECT 'https://h.example/a/s' || s_suppkey::VARCHAR AS src, s_suppkey::VARCHAR AS k FROM supplier)
SELECT src, 'https://h.example/u' || k AS dst FROM s UNION ALL SELECT src, 'https://h.example/q?a=' || k || '&b=2' FROM s UNION ALL SELECT src, src || '#f' FROM s
UNION ALL SELECT src, 'https://h.example/a/next/' || k FROM s
UNION ALL SELECT 'https://h.example/map' || n_nationkey::VARCHAR, 'https://h.example/m' || n_nationkey::VARCHAR FROM nation""",
    "census_depths": f"""
WITH m AS (SELECT min(r_regionkey) AS first, max(r_regionkey) AS last FROM region)
SELECT '{ROOT}/football/' AS url, 'ok' AS status, 200 AS status_code, 0 AS depth
UNION ALL SELECT '{ROOT}/football/d' || r_regionkey::VARCHAR, 'ok', 200, (r_regionkey - first + 1)::INTEGER FROM region, m
UNION ALL SELECT '{ROOT}/football/d' || (last + 1)::VARCHAR, 'absent', 404, (last - first + 2)::INTEGER FROM m
UNION ALL SELECT '{ROOT}/football/roster/t-N' || n_nationkey::VARCHAR || '/y-1963', 'ok', 200, (n_regionkey - first + 2)::INTEGER FROM nation, m""",
    "sampled_family": f"SELECT url, page_id AS pos FROM pages WHERE {pattern(PATH)} = '/en/{{n}}' ORDER BY page_id LIMIT 12",
    "running_labels": """
WITH f AS (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS flag FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, last_value(nullif(flag, 'N') IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS running FROM f""",
}

