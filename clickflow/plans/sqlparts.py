"""SQL fragments shared by the oracle queries (DuckDB dialect, also valid Spark SQL)."""

from __future__ import annotations

from clickflow.config import FIXTURE_URL_MARKERS, GROUP1_EVENTS, GROUP2_EVENTS, MAX_ATTEMPTS


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


G1 = sql_list(GROUP1_EVENTS)
G12 = sql_list(GROUP1_EVENTS + GROUP2_EVENTS)
MARKER_TEST = " AND ".join(f"strpos(url, '{m}') = 0" for m in FIXTURE_URL_MARKERS) or "TRUE"

TAGGED = f"""tagged AS (
 SELECT *, CASE WHEN collection IN ({G1}) THEN 1 ELSE 2 END AS event_group
 FROM raw_data WHERE collection IN ({G12}))"""

RESOLVED = """resolved AS (
 SELECT *, CASE WHEN event_group = 1 THEN coalesce(nullif(product_id, ''), nullif(viewing_product_id, ''))
  ELSE nullif(viewing_product_id, '') END AS resolved_id,
  CASE WHEN event_group = 1 THEN current_url ELSE referrer_url END AS url
 FROM tagged)"""

VALID_URLS = f"""valid_urls AS (
 SELECT * FROM resolved WHERE url IS NOT NULL AND url <> '' AND {MARKER_TEST})"""

FIRST_URL = """first_url AS (
 SELECT resolved_id AS product_id, url, event_group, _id FROM (
  SELECT *, row_number() OVER (PARTITION BY resolved_id ORDER BY event_group, _id) AS rn
  FROM {src} WHERE resolved_id IS NOT NULL) z WHERE rn = 1)"""

CLASSIFIED = """classified AS (
 SELECT *, CASE WHEN status_code = 200 THEN 'success' WHEN status_code = 404 THEN 'err_404'
  WHEN status_code = 403 THEN 'err_403' WHEN status_code = 429 THEN 'err_429'
  WHEN status_code BETWEEN 500 AND 599 THEN 'err_5xx'
  WHEN status_code IS NULL AND error_kind = 'network' THEN 'err_network' ELSE 'err_other' END AS status
 FROM attempts)"""

MESSAGES = """CASE WHEN status = 'err_network' THEN NULL WHEN status_code IS NULL THEN 0 ELSE status_code END AS http_code,
  CASE WHEN status = 'success' THEN '' WHEN status = 'err_404' THEN 'Page Not Found'
   WHEN status = 'err_403' THEN 'Forbidden' WHEN status = 'err_429' THEN 'Rate limit'
   WHEN status_code IS NULL THEN coalesce(error_kind, '') ELSE 'HTTP ' || CAST(status_code AS VARCHAR) END AS error_msg"""

FINAL = f"""final AS (
 SELECT product_id, url, attempt AS attempts, status, {MESSAGES} FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY
    CASE WHEN status IN ('success', 'err_404') OR attempt >= {MAX_ATTEMPTS} THEN 0 ELSE 1 END,
    CASE WHEN status IN ('success', 'err_404') OR attempt >= {MAX_ATTEMPTS} THEN attempt ELSE -attempt END) AS rn
  FROM classified) z WHERE rn = 1)"""

FINISHED = """finished AS (
 SELECT DISTINCT product_id FROM final
 WHERE status IN ('success', 'err_404') AND product_id IS NOT NULL AND product_id <> '')"""

# Regex text extraction in DuckDB, for the page shapes of the fixture.
def name_sql(html: str) -> str:
    # patterns of the oracle's own: nothing is shared with the code under test
    heading_pattern = r"(?is)<h1\s[^>]*class\s*=\s*[\"'](?:[^\"']*\s)?page-title(?:\s[^\"']*)?[\"'][^>]*>(.*?)</h1\s*>"
    span_pattern = r"(?is)<span(?:\s[^>]*)?>(.*?)</span\s*>"
    tag_pattern = r"(?is)(<meta\s[^>]*property\s*=\s*[\"']og:title[\"'][^>]*>)"
    content_dq, content_sq = r"(?is)\scontent\s*=\s*\"([^\"]*)\"", r"(?is)\scontent\s*=\s*'([^']*)'"
    entities = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))

    def q(p: str) -> str:
        return "'" + p.replace("'", "''") + "'"

    def decode(x: str) -> str:
        for ent, ch in entities:
            x = f"replace({x}, {q(ent)}, {q(ch)})"
        return x

    def strip(x: str) -> str:
        return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"

    heading = f"regexp_extract({html}, {q(heading_pattern)}, 1)"
    span = f"regexp_extract({heading}, {q(span_pattern)}, 1)"
    text = strip(decode(f"regexp_replace({span}, '\\s*<[^>]+>\\s*', '', 'g')"))
    tag = f"regexp_extract({html}, {q(tag_pattern)}, 1)"
    content = (f"coalesce(nullif(regexp_extract({tag}, {q(content_dq)}, 1), ''), "
               f"nullif(regexp_extract({tag}, {q(content_sq)}, 1), ''))")
    return f"coalesce(nullif({text}, ''), nullif({decode(content)}, ''), 'Unknown name')"


def strip_sql(x: str) -> str:
    return f"regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '^\\s+|\\s+$', '', 'g')"
