"""DuckDB SQL with the same results, where SQL can express them."""

from __future__ import annotations

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
RANKED = f"""
    WITH words AS (
      SELECT doc_id, unnest(regexp_extract_all({LOWERED.format('text')}, '{TERM}')) AS term FROM documents),
    freq AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
    sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM freq GROUP BY doc_id),
    whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
    held AS (SELECT term, count(*) AS df FROM freq GROUP BY term),
    asked AS (
      SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all({LOWERED.format('text')}, '{TERM}')) AS term FROM benchmark)
      GROUP BY ALL),
    scored AS (
      SELECT item_id, doc_id, CAST(sum(
          times * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
          * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
      FROM asked JOIN freq USING (term) JOIN held USING (term) JOIN sizes USING (doc_id) CROSS JOIN whole
      GROUP BY item_id, doc_id)
    SELECT item_id, CAST(rn AS INTEGER) AS rank, doc_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rn FROM scored WHERE score > 0)
    WHERE rn <= 20"""

LLM_ORACLES: dict[str, str] = {
    "op1_line_dedup": r"""
WITH parts AS (
  SELECT doc_id, text, source, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, coalesce(source, '') AS site, unnest(range(len(parts))) AS pos, unnest(parts) AS raw
  FROM parts
), trimmed AS (
  SELECT *, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM lines
), boilerplate AS (
  SELECT line FROM trimmed WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 5
), marked AS (
  SELECT t.*, b.line IS NOT NULL AS gone FROM trimmed t LEFT JOIN boilerplate b ON t.line = b.line
), cleaned AS (
  SELECT doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(c.n_lines, 0)::BIGINT AS n_lines, coalesce(c.n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(c.text, '')) AS text_sha256
FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id
""",
    "op5_exact_dedup": r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text
  FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY text)
""",
    "op6_source_mix": r"""
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (3 * sum(size))::BIGINT AS most,
    ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *,
    (sum(source_size) OVER () - coalesce(sum(most) OVER below, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0))::DOUBLE AS level,
    most / weight AS full_at
  FROM sources
  WINDOW below AS (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), settled AS (
  SELECT min_by(level, full_at) AS level FROM filled WHERE level <= full_at
), targets AS (
  SELECT s.source, s.source_size, least(s.most::DOUBLE, s.weight * t.level) AS target
  FROM sources s CROSS JOIN settled t
), rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('17:' || d.doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS chance,
    d.source
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), tried AS (
  SELECT r.*, s.shift,
    (size * (floor(rate) + CASE WHEN
      (chance + s.shift / 64.0::DOUBLE) - floor(chance + s.shift / 64.0::DOUBLE) < rate - floor(rate)
      THEN 1 ELSE 0 END))::BIGINT AS taken
  FROM rated r CROSS JOIN (SELECT unnest(range(64)) AS shift) s
), best AS (
  SELECT source, arg_min(shift, (off, shift)) AS shift FROM (
    SELECT source, shift, abs(sum(taken)::BIGINT - any_value(target)) AS off FROM tried GROUP BY source, shift)
  GROUP BY source
)
SELECT t.doc_id, t.size, t.source_size, t.target, t.taken
FROM tried t JOIN best b ON t.source IS NOT DISTINCT FROM b.source AND t.shift = b.shift
""",
    "op11_ranked_search": RANKED,
}
