"""DuckDB SQL for the queries that SQL can express."""

_WORD_COUNT = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

#: The closed form of the mix: with one family of constraints each source has one rate.
MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, {_WORD_COUNT}::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 12))::BIGINT AS draw
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, 3.0::DOUBLE * source_size AS most,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM totals
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (
              ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked
), targets AS (
  SELECT source, source_size,
         least(most, weight * (SELECT min_by(level, most / weight) FROM levels WHERE level * weight <= most)) AS target
  FROM levels
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN round(target / source_size, 9) ELSE 0 END AS rate FROM targets
), running AS (
  SELECT s.doc_id, s.size, s.source, s.draw, r.source_size, r.target, floor(r.rate) AS whole, r.rate,
         r.target - floor(r.rate) * r.source_size AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN rate > whole AND through - size / 2.0 <= budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running
"""

EXACT = r"""
WITH keys AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM keys
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM ranked
"""

#: Where a backslash goes into a text; each pattern can't overlap itself.
_CONTROLS = (
    r"<\\*\|", r"<\\*s>", r"<\\*/s>", r"<\\*<SYS>>", r"<\\*</SYS>>", r"<\\*unk>", r"\|\\*>", r"\[\\*INST\]", r"\[\\*/INST\]",
)


def _added(column: str) -> str:
    return " + ".join(f"len(regexp_extract_all({column}, '{p}'))" for p in _CONTROLS)


CHAT = rf"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY place)) AS loss_sha256,
       sum(length('<|im_start|>') + length(role) + {_added("role")}
           + (length(role) - length(replace(role, chr(10), ''))) * (length('<|nl|>') - 1) + 1
           + length(text) + {_added("text")} + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

REVISITS = r"""
WITH bare AS (
  SELECT page_id, coalesce(html, '') AS html, md5(coalesce(html, '')) AS tag,
         regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u
  FROM pages
), keyed AS (
  SELECT page_id, html, tag,
         regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^www[0-9]*\.|:(80|443)$', '', 'g')
         || regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
         list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
                               lambda x: x <> '' AND NOT regexp_matches(x, '^utm_'))) AS query
  FROM bare
), named AS (
  SELECT *, place || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS url FROM keyed
), lagged AS (
  SELECT *, lag(page_id) OVER w AS earlier, lag(tag) OVER w AS earlier_tag, lag(length(html)) OVER w AS earlier_size
  FROM named WINDOW w AS (PARTITION BY url ORDER BY page_id)
), judged AS (
  SELECT *, CASE WHEN earlier IS NULL THEN 'orphan' WHEN tag = earlier_tag THEN 'resolved' ELSE 'changed' END AS outcome FROM lagged
)
SELECT page_id, url, outcome, earlier AS response_page_id,
       CASE WHEN outcome = 'resolved' THEN
         'content-length: ' || earlier_size::VARCHAR || chr(10) || 'content-type: text/html' || chr(10)
         || 'date: not-modified ' || page_id::VARCHAR || chr(10) || 'etag: W/' || tag END AS headers
FROM judged
"""

#: Revisits by rules of the URL's digest, so that every outcome and every merge occurs.
REVISITS_RULED = r"""
WITH ruled AS (
  SELECT page_id, CASE WHEN md5(coalesce(url, ''))[1] < '4' THEN 'https://hot.example.net/front' ELSE url END AS url,
         md5(coalesce(url, ''))[2] AS claim, md5(coalesce(url, ''))[3] AS has,
         ('0x' || md5(coalesce(url, ''))[4])::BIGINT AS late,
         sha1(coalesce(html, '')) AS d, md5(coalesce(html, '')) AS e, 'day ' || (page_id // 16)::VARCHAR AS m, length(coalesce(html, '')) AS size
  FROM pages
), bare AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM ruled
), keyed AS (
  SELECT *, regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^www[0-9]*\.|:(80|443)$', '', 'g')
         || regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
         list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
                               lambda x: x <> '' AND NOT regexp_matches(x, '^utm_'))) AS query
  FROM bare
), named AS (
  SELECT * EXCLUDE (url), place || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS url FROM keyed
), responses AS (
  SELECT page_id, url, page_id * 2 AS moment, size, e AS tag,
         CASE WHEN has NOT IN ('c', 'e', 'f') THEN d END AS digest, CASE WHEN has NOT IN ('d', 'e', 'f') THEN e END AS etag,
         CASE WHEN has NOT IN ('c', 'd', 'f') THEN m END AS modified
  FROM named
), revisits AS (
  SELECT page_id, url, page_id * 2 + late * 2 - 1 AS moment, late,
         CASE WHEN claim IN ('4', '5', 'd') THEN d WHEN claim IN ('a', 'e') THEN d || 'x' END AS digest,
         CASE WHEN claim IN ('0', '1', '2', '3', 'a', 'f') THEN e WHEN claim IN ('8', '9', 'd') THEN e || 'x' END AS etag,
         CASE WHEN claim IN ('6', '7') THEN m WHEN claim = 'c' THEN m || 'x' END AS modified
  FROM named
), found AS (
  SELECT v.*, r.page_id AS response_page_id, r.size, r.tag,
         coalesce(v.digest = r.digest, v.etag = r.etag, v.modified = r.modified) AS agree
  FROM revisits v ASOF LEFT JOIN responses r ON v.url = r.url AND v.moment > r.moment
), judged AS (
  SELECT *, CASE WHEN response_page_id IS NULL THEN 'orphan' WHEN agree IS NULL THEN 'unproven'
                 WHEN agree THEN 'resolved' ELSE 'changed' END AS outcome
  FROM found
)
SELECT page_id, url, outcome, response_page_id,
       CASE WHEN outcome = 'resolved' THEN
         'cache-control: ' || CASE WHEN late < 8 THEN 'max-age=' || page_id::VARCHAR ELSE 'no-cache' END || chr(10)
         || 'content-length: ' || size::VARCHAR || chr(10) || 'content-type: text/html' || chr(10)
         || 'date: not-modified ' || page_id::VARCHAR || chr(10) || 'etag: ' || coalesce('W/' || etag, tag) || chr(10)
         || CASE WHEN late % 2 = 1 THEN 'expires: ' || page_id::VARCHAR || chr(10) ELSE '' END
         || 'x-page: ' || response_page_id::VARCHAR END AS headers
FROM judged
"""
