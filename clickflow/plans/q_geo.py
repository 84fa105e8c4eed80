"""IP-path queries: distinct addresses, lookup, normalise/validate, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.operators import geo
from clickflow.operators import quality as dq
from clickflow.operators import reports as rep
from clickflow.plans.registry import register
from clickflow.sources import fixtures as fx
from clickflow.sources.fixtures import with_fixtures
from clickflow.plans.sqlparts import strip_sql


def _located(spark, d) -> DataFrame:
    return geo.locate_ips(geo.unique_ips(fx.raw_data(spark, d)), fx.ip_ranges(spark, d))


def _validated(spark, d) -> DataFrame:
    return dq.validate_location(dq.normalize_location(_located(spark, d)))


# the oracle's own reading of addresses: four decimal numbers without leading zeros
NUM = ("CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536"
       " + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT)")
QUAD = ("(len(string_split(ip, '.')) = 4 AND len(list_filter(string_split(ip, '.'), lambda x: "
        "x <> CAST(TRY_CAST(x AS UTINYINT) AS VARCHAR) OR TRY_CAST(x AS UTINYINT) IS NULL)) = 0)")
PARSED = f"""ips AS (SELECT DISTINCT ip FROM raw_data),
 parsed AS (SELECT ip, CASE WHEN {QUAD} THEN {NUM} END AS n FROM ips)"""
BAD = "(p.n IS NULL AND NOT (p.ip IS NULL OR p.ip = '' OR p.ip LIKE '%:%:%'))"
LOCATED = f"""{PARSED},
 located AS (SELECT p.ip,
  CASE WHEN {BAD} THEN 'INVALID IP ADDRESS' ELSE r.country_short END AS country_short,
  CASE WHEN {BAD} THEN 'INVALID IP ADDRESS' ELSE r.country_long END AS country_long,
  CASE WHEN {BAD} THEN 'INVALID IP ADDRESS' ELSE r.region END AS region,
  CASE WHEN {BAD} THEN 'INVALID IP ADDRESS' ELSE r.city END AS city
  FROM parsed p LEFT JOIN ip_ranges r ON p.n BETWEEN r.ip_from AND r.ip_to)"""
NORMALIZED = f"""normalized AS (SELECT {strip_sql('ip')} AS ip, {strip_sql('country_short')} AS country_short,
  {strip_sql('country_long')} AS country_long, {strip_sql('region')} AS region, {strip_sql('city')} AS city
  FROM located)"""
MISSING = " OR ".join(f"{c} IN ('-', '', 'n/a', 'N/A')" for c in geo.LOCATION_COLS)
REASON = f"""CASE WHEN ip = '' THEN 'missing_ip' WHEN {MISSING} THEN 'missing_location_info'
  WHEN upper(country_long) = 'INVALID IP ADDRESS' THEN 'invalid_ip' ELSE 'valid' END"""
VALIDATED = f"validated AS (SELECT *, {REASON} AS reason FROM normalized)"
QUALITY = """count(*) AS total, count(*) FILTER (WHERE reason = 'missing_ip') AS dq_missing_ip,
 count(*) FILTER (WHERE reason = 'missing_location_info') AS dq_missing_location_info,
 count(*) FILTER (WHERE reason = 'invalid_ip') AS dq_invalid_ip,
 count(*) FILTER (WHERE reason = 'valid') AS dq_valid"""
FIX = ("raw_data", "ip_ranges")


@register("count_ips", with_fixtures(
    "SELECT count(*) AS distinct_ips, count(ip) AS distinct_ips_non_null FROM (SELECT DISTINCT ip FROM raw_data) z",
    "raw_data"))
def q_count_ips(spark, d):
    """OP-26: distinct address count, null group counted (and not)."""
    return geo.count_ips(fx.raw_data(spark, d))


@register("unique_ips", with_fixtures("SELECT DISTINCT ip FROM raw_data", "raw_data"))
def q_unique_ips(spark, d):
    """OP-27: unique address list."""
    return geo.unique_ips(fx.raw_data(spark, d))


@register("parse_ipv4", with_fixtures(
    f"WITH {PARSED} SELECT ip, n AS ip_number, n IS NOT NULL AS is_ipv4 FROM parsed", "raw_data"))
def q_parse_ipv4(spark, d):
    """IPv4 text -> number with strict octet syntax."""
    return geo.parse_ipv4(geo.unique_ips(fx.raw_data(spark, d)))


@register("locate_ips", with_fixtures(f"WITH {LOCATED} SELECT * FROM located", *FIX))
def q_locate_ips(spark, d):
    """OP-22: range lookup of every distinct address (as-of per /16 bin)."""
    return _located(spark, d)


@register("normalize_location", with_fixtures(f"WITH {LOCATED}, {NORMALIZED} SELECT * FROM normalized", *FIX))
def q_normalize_location(spark, d):
    """OP-18: null -> '', cast, strip for the five location fields."""
    return dq.normalize_location(_located(spark, d))


@register("validate_location", with_fixtures(
    f"WITH {LOCATED}, {NORMALIZED}, {VALIDATED} SELECT *, reason = 'valid' AS is_valid FROM validated", *FIX))
def q_validate_location(spark, d):
    """OP-19: ordered location rules."""
    return _validated(spark, d)


@register("ip_locations", with_fixtures(
    f"WITH {LOCATED}, {NORMALIZED}, {VALIDATED} SELECT ip, country_short, country_long, region, city "
    "FROM validated WHERE reason = 'valid'", *FIX))
def q_ip_locations(spark, d):
    """OP-20/45a: clean ip_locations rows (full-refresh content)."""
    clean, _ = dq.split_valid(_validated(spark, d))
    return clean


@register("location_rejects", with_fixtures(
    f"WITH {LOCATED}, {NORMALIZED}, {VALIDATED} SELECT ip, country_short, country_long, region, city, reason "
    "FROM validated WHERE reason <> 'valid'", *FIX))
def q_location_rejects(spark, d):
    """OP-20: quarantined location rows with the first failing rule."""
    _, rejects = dq.split_valid(_validated(spark, d))
    return rejects


@register("ip_locations_refresh", with_fixtures(
    f"WITH {LOCATED}, {NORMALIZED}, {VALIDATED} SELECT ip, country_short, country_long, region, city "
    "FROM validated WHERE reason = 'valid'", *FIX))
def q_ip_locations_refresh(spark, d):
    """OP-45a: ip_locations rebuilt twice by full refresh (replaced, not appended) and read
    back."""
    from clickflow.plans.iplocate import run_ip_locations
    from clickflow.session import work_path
    out = work_path(spark, "ip_locations")
    for _ in range(2):
        run_ip_locations(spark, fx.raw_data(spark, d), fx.ip_ranges(spark, d), out)
    return spark.read.parquet(out)


@register("ip_quality", with_fixtures(f"WITH {LOCATED}, {NORMALIZED}, {VALIDATED} SELECT {QUALITY} FROM validated",
                                      *FIX))
def q_ip_quality(spark, d):
    """OP-29: location reason counters (they sum to the distinct address count)."""
    return rep.location_quality(_validated(spark, d))


@register("ip_report", with_fixtures(
    f"""WITH {LOCATED}, {NORMALIZED}, {VALIDATED}, q AS (SELECT {QUALITY} FROM validated)
 SELECT *, round(CASE WHEN total = 0 THEN NULL ELSE dq_valid * 100.0 / total END, 1) AS valid_rate FROM q""", *FIX))
def q_ip_report(spark, d):
    """OP-30: final IP report row."""
    return rep.ip_report(_validated(spark, d))


IP_QUERY_CHUNK = 1000
_PROG_COLS = ", ".join(f"CAST(sum(n_dq_{x}) OVER w AS BIGINT) AS dq_{x}"
                       for x in ("missing_ip", "missing_location_info", "invalid_ip", "valid"))


@register("ip_chunk_progress", with_fixtures(
    f"""WITH {LOCATED}, {NORMALIZED}, {VALIDATED},
 numbered AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY ip NULLS FIRST) - 1) / {IP_QUERY_CHUNK}) AS INTEGER) + 1
  AS chunk FROM validated),
 per AS (SELECT chunk, count(*) AS n,
  count(*) FILTER (WHERE reason = 'missing_ip') AS n_dq_missing_ip,
  count(*) FILTER (WHERE reason = 'missing_location_info') AS n_dq_missing_location_info,
  count(*) FILTER (WHERE reason = 'invalid_ip') AS n_dq_invalid_ip,
  count(*) FILTER (WHERE reason = 'valid') AS n_dq_valid FROM numbered GROUP BY chunk)
 SELECT chunk, n, CAST(sum(n) OVER w AS BIGINT) AS processed, {_PROG_COLS},
  CAST(sum(n) OVER () - sum(n) OVER w AS BIGINT) AS pending
 FROM per WINDOW w AS (ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", *FIX))
def q_ip_chunk_progress(spark, d):
    """OP-36 for the IP job: progress per insert batch of distinct addresses."""
    return rep.ip_progress(_validated(spark, d), IP_QUERY_CHUNK)


# 128-bit numbers of both families: groups of the two halves around "::" with zeros between
_MIXED = f"""ips AS (SELECT DISTINCT ip FROM mixed_ips),
 tails AS (SELECT ip AS text, CASE WHEN contains(ip, ':') THEN string_split(ip, ':')[-1] ELSE ip END AS ip FROM ips),
 quads AS (SELECT text, CASE WHEN {QUAD} THEN {NUM} END AS n FROM tails),
 plain AS (SELECT text, n, CASE WHEN n IS NOT NULL AND contains(text, ':')
   THEN regexp_extract(text, '^(.*:)[^:]*$', 1) || format('{{:x}}:{{:x}}', n // 65536, n % 65536) ELSE text END AS p FROM quads),
 halves AS (SELECT text, n, list_transform(string_split(p, '::'), lambda h: CASE WHEN h = '' THEN [] ELSE string_split(h, ':') END) AS h FROM plain),
 counted AS (SELECT *, len(flatten(h)) AS k, len(list_filter(flatten(h), lambda g: NOT regexp_full_match(g, '[0-9a-fA-F]{{1,4}}'))) AS odd FROM halves),
 keyed AS (SELECT text AS ip, CASE WHEN NOT contains(text, ':') THEN 281470681743360::HUGEINT + n
   WHEN odd = 0 AND ((len(h) = 1 AND k = 8) OR (len(h) = 2 AND k <= 7)) THEN list_reduce(list_transform(
    list_concat(h[1], list_transform(range(8 - k), lambda z: '0'), coalesce(h[2], [])), lambda g: ('0x' || g)::BIGINT::HUGEINT),
    lambda a, b: a * 65536 + b) END AS key FROM counted),
 hits AS (SELECT k.ip, k.key, r.*, row_number() OVER (PARTITION BY k.ip ORDER BY r.ip_to - r.ip_from, r.ip_from, r.country_short) AS place
  FROM keyed k LEFT JOIN mixed_ranges r ON k.key BETWEEN r.ip_from AND r.ip_to)"""
_BAD_MIXED = "key IS NULL AND ip IS NOT NULL AND ip <> ''"


@register("locate_mixed_ips", with_fixtures(
    f"WITH {_MIXED} SELECT ip, " + ", ".join(f"CASE WHEN {_BAD_MIXED} THEN 'INVALID IP ADDRESS' ELSE {c} END AS {c}" for c in geo.LOCATION_COLS)
    + " FROM hits WHERE place = 1", "mixed_ranges", "mixed_ips"))
def q_locate_mixed_ips(spark, d):
    """OP-04/22: IPv4 and IPv6 addresses in nested, crossing and equal ranges, read from a CSV edition
    with 128-bit ends; the narrowest range that holds an address wins."""
    from clickflow.session import work_path
    from clickflow.sources.tables import read_ip_ranges
    path = work_path(spark, "ip-edition")
    fx.mixed_ranges(spark, d).write.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    ranges = read_ip_ranges(spark, path, fmt="csv", text_ends=True)
    return geo.locate_ips(geo.unique_ips(fx.mixed_ips(spark, d)), ranges)
