"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tablewright.llm.queries import MIX_EPOCHS, MIX_WEIGHTS, PLANTED_TEXT


def weight_case(level: str) -> str:
    cases = " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in sorted(MIX_WEIGHTS.get(level, {}).items()))
    return f"(CASE {cases} ELSE 1 END)" if cases else "1"


def water_level(source: str, parents: str, name: str) -> str:
    """The budgets of `source` (parents, name, cap, weight, parent's budget)."""
    over = f"OVER (PARTITION BY {parents} ORDER BY cap::DOUBLE / weight, {name}"
    return f"""
      SELECT * REPLACE (CASE WHEN is_full THEN cap ELSE (weight::HUGEINT * greatest(lv.rest, 0) // lv.heft)::BIGINT END AS budget)
      FROM (SELECT *, min(CASE WHEN NOT is_full THEN {{'r': cap::DOUBLE / weight, 'k': {name}, 'rest': rest, 'heft': heft}} END) OVER (PARTITION BY {parents}) AS lv
        FROM (SELECT *, cap::HUGEINT * heft <= weight::HUGEINT * greatest(rest, 0) AS is_full
          FROM (SELECT *, (budget - coalesce(sum(cap) {over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
                (sum(weight) {over} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS heft FROM ({source}))))"""


MIXING = f"""
WITH d AS (
  SELECT doc_id, coalesce('d' || (ascii(right(source, 1)) % 3)::VARCHAR, '') AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens, md5(coalesce(text, '')) AS digest FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * {MIX_EPOCHS})::BIGINT AS cap FROM d GROUP BY ALL),
b1 AS ({water_level(f"SELECT 0 AS root, domain, sum(cap)::BIGINT AS cap, {weight_case('domain')} AS weight, ((SELECT sum(tokens) FROM leaves) * 6 // 10)::BIGINT AS budget FROM leaves GROUP BY domain", "root", "domain")}),
b2 AS ({water_level(f"SELECT n.domain, n.lang, n.cap, {weight_case('lang')} AS weight, b1.budget FROM (SELECT domain, lang, sum(cap)::BIGINT AS cap FROM leaves GROUP BY ALL) n JOIN b1 USING (domain)", "domain", "lang")}),
b3 AS ({water_level("SELECT n.domain, n.lang, n.source, n.cap, 1 AS weight, b2.budget FROM leaves n JOIN b2 USING (domain, lang)", "domain, lang", "source")}),
need AS (
  SELECT l.domain, l.lang, l.source, e.epoch, least(b3.budget - e.epoch * l.tokens, l.tokens) AS need
  FROM leaves l JOIN b3 USING (domain, lang, source), (SELECT unnest(range({MIX_EPOCHS})) AS epoch) e),
placed AS (
  SELECT d.*, n.epoch, n.need, ('0x' || substr(md5('17:' || n.epoch::VARCHAR || ':' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || d.digest), 1, 12))::BIGINT AS h
  FROM d JOIN need n USING (domain, lang, source) WHERE n.need > 0),
summed AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, epoch::BIGINT AS epoch FROM summed WHERE before < need
"""

_ESCAPED = r"replace(replace(replace({}, '\', '\b'), '<', '\l'), '#', '\h')"
CHAT = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PLANTED_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED_TEXT}'),
n AS (
  SELECT *, length('<|start|>' || replace({_ESCAPED.format('role')}, chr(10), '\n') || chr(10) || {_ESCAPED.format('text')} || '<|end|>' || chr(10)) AS size,
    row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS total,
    coalesce(max(CASE WHEN role = 'assistant' THEN 1 END) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS answered
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM n)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR (i = total AND answered = 0) THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""

EXACT = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_points DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

QUALITY = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
grams AS (
  SELECT doc_id, i, words[i] || chr(0) || words[i + 1] || chr(0) || words[i + 2] || chr(0) || words[i + 3] || chr(0) || words[i + 4] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
spots AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
cover AS (SELECT doc_id, sum(least(5, coalesce(next - i, 5))) AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM spots) GROUP BY doc_id),
lines AS (
  SELECT doc_id, host, l, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm
  FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY doc_id),
content AS (SELECT doc_id, lower(trim(regexp_replace(text, '[\x20\x09-\x0D]+', ' ', 'g'))) AS words FROM d),
held AS (SELECT l.host, l.norm, count(DISTINCT c.words) AS n FROM lines l JOIN content c USING (doc_id) GROUP BY ALL),
gone AS (SELECT host, norm FROM held WHERE n > 20),
lost AS (
  SELECT doc_id, sum(len(regexp_extract_all(l.norm, '[^ ]+'))) AS n FROM lines l JOIN gone g ON l.host IS NOT DISTINCT FROM g.host AND l.norm = g.norm GROUP BY doc_id),
base AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lost.n, 0) AS lost
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cover USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (lost > 0 AND (n_words - lost < 10 OR (n_words - lost) * 100 < n_words * 25)) AS kept
FROM base
"""

ORACLES = {
    "op4_mixing": MIXING,
    "op5_chat": CHAT,
    "op8_exact": EXACT,
    "op9_quality": QUALITY,
}
