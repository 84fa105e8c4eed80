"""Clickstream-shaped views derived from the driver's tables (see FIXTURES.md).

``raw_data``, ``ip_ranges``, ``product_pages`` and ``attempts`` are built with the
DataFrame API from ``events``, ``nation``/``region`` and ``pages``; the ``*_SQL`` texts
are the same derivations in SQL, used as CTEs by the DuckDB oracle. Both give equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mod(c, n):
    return (c % F.lit(n)) == 0


def raw_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    et = F.col("event_type")
    return e.select(
        F.lpad(eid.cast("string"), 24, "0").alias("_id"),
        F.when(et == "view", "view_product_detail").when(et == "purchase", "add_to_cart_action")
        .when(et == "signup", "select_product_option")
        .when(et == "click", "product_view_all_recommend_clicked").otherwise("error").alias("collection"),
        F.when(et == "click", F.lit(None).cast("string")).when(_mod(eid, 7), "")
        .when(_mod(eid, 11), F.lit(None).cast("string"))
        .otherwise((uid * 100 + k % 20).cast("string")).alias("product_id"),
        F.when(_mod(eid, 13), F.lit(None).cast("string"))
        .otherwise((uid * 100 + k % 25).cast("string")).alias("viewing_product_id"),
        F.when(_mod(eid, 17), F.lit(None).cast("string"))
        .when(_mod(eid, 19), F.concat(F.lit("https://stage.shop.example/p/"), eid.cast("string")))
        .otherwise(F.concat(F.lit("https://www.shop.example/p/"), eid.cast("string"))).alias("current_url"),
        F.when(_mod(eid, 23), "")
        .when(_mod(eid, 29), F.concat(F.lit("https://test.shop.example/r/"), eid.cast("string")))
        .otherwise(F.concat(F.lit("https://www.shop.example/r/"), eid.cast("string"))).alias("referrer_url"),
        F.when(_mod(eid, 97), F.lit(None).cast("string")).when(_mod(eid, 50), "")
        .when(_mod(eid, 101), "999.1.1.1").when(_mod(eid, 103), "not-an-ip")
        .otherwise(F.concat(((eid * 7) % 224).cast("string"), F.lit("."), (uid % 256).cast("string"),
                           F.lit(".0."), (eid % 4).cast("string"))).alias("ip"),
        F.when(_mod(eid, 5), "").when(_mod(eid, 6), F.lit(None).cast("string"))
        .otherwise(uid.cast("string")).alias("user_id_db"),
        F.when(_mod(eid, 41), "").otherwise(F.concat(F.lit("dev-"), ((uid * 31) % 997).cast("string"))).alias("device_id"),
        (uid % 12).cast("string").alias("store_id"),
        F.concat((eid % 3).cast("string"), F.lit(".0")).alias("api_version"),
        F.when(_mod(eid, 20), "").when(_mod(eid, 21), "0").when(_mod(eid, 33), F.lit(None).cast("string"))
        .otherwise(F.col("value").cast("string")).alias("price"),
        F.when(_mod(eid, 8), F.lit(None).cast("string")).otherwise((eid % 90).cast("string")).alias("cat_id"),
        F.when(_mod(eid, 9), F.lit(None).cast("boolean")).otherwise(_mod(eid, 2)).alias("is_paypal"),
        F.col("ts"),
    )


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """199 /8 ranges with gaps. Range i = a*25 + b over nation keys a, b; expressed as an
    explode of the (at most 9) multiples per b plus a semi-join on a, not a cross join."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    b = (nation.join(region, nation.n_regionkey == region.r_regionkey)
         .select(F.col("n_nationkey").cast("bigint").alias("b"), "n_name", "r_name")
         .withColumn("i", F.explode(F.sequence(F.col("b"), F.lit(223).cast("bigint"), F.lit(25).cast("bigint"))))
         .where(F.col("i") < 224))
    a_keys = nation.select(F.col("n_nationkey").cast("bigint").alias("a"))
    x = (b.withColumn("a", F.floor(F.col("i") / 25).cast("bigint"))
         .join(a_keys, "a", "left_semi")
         .where(F.col("i") % 9 != 1))
    i = F.col("i")
    m = i % 40
    return x.select(
        (i * 16777216).alias("ip_from"),
        (i * 16777216 + 16777215).alias("ip_to"),
        F.when(m == 3, "-").otherwise(F.substring("n_name", 1, 2)).alias("country_short"),
        F.when(m == 3, "-").otherwise(F.col("n_name")).alias("country_long"),
        F.when(m == 4, "n/a").otherwise(F.col("r_name")).alias("region"),
        F.when(m == 5, " N/A ").when(m == 6, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" City"), i.cast("string"))).alias("city"),
    )


#: First number of the IPv4-mapped space, of 2001:db8::/32, and the sizes of a /32 and a /48 of IPv6.
V4_BASE, DOC_BASE, DOC_SIZE, NET_SIZE = (0xFFFF << 32, 0x20010DB8 << 96, 1 << 96, 1 << 80)


def mixed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of both families with text ends in digits: the /8 ranges, /16 and /24 blocks nested
    in them, ranges that cross two /8 blocks, twins of nested blocks, and IPv6 prefixes in three levels."""
    def number(c):
        return (c.cast("decimal(20,0)") + F.lit(V4_BASE).cast("decimal(20,0)")).cast("string")

    base = ip_ranges(spark, sf_dir).withColumns({"ip_from": number(F.col("ip_from")), "ip_to": number(F.col("ip_to"))})
    b = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("b"), "n_name")
    block = (F.col("b") * 7 + 3) * 16777216 + F.col("b") * 65536
    cross = (F.col("b") * 8 + 1) * 16777216 + 200 * 65536

    def rows(of: DataFrame, first, last, tag: str) -> DataFrame:
        return of.select(first.alias("ip_from"), last.alias("ip_to"), F.concat(F.lit(tag), F.col("b").cast("string")).alias("country_short"),
                         F.concat("n_name", F.lit(f" {tag}")).alias("country_long"), F.lit(tag).alias("region"),
                         F.concat(F.lit("City "), F.col("b").cast("string")).alias("city"))

    def wide(n):
        return F.lit(str(n)).cast("decimal(38,0)")

    doc = wide(DOC_BASE) + F.col("b").cast("decimal(2,0)") * F.lit(str(NET_SIZE)).cast("decimal(25,0)")
    parts = [
        rows(b, number(block), number(block + 65535), "N"), rows(b, number(block), number(block + 255), "I"),
        rows(b.where("b % 5 = 0"), number(block), number(block + 65535), "Z"),
        rows(b, number(cross), number(cross + 16777216 - 150 * 65536 - 1), "X"),
        rows(b.where("b = 0"), wide(DOC_BASE).cast("string"), wide(DOC_BASE + DOC_SIZE - 1).cast("string"), "D"),
        rows(b, doc.cast("string"), (doc + wide(NET_SIZE - 1)).cast("string"), "S"),
        rows(b.where("b % 2 = 0"), doc.cast("string"), (doc + wide(65535)).cast("string"), "T"),
    ]
    out = base
    for p in parts:
        out = out.unionByName(p)
    return out


def mixed_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address of every event: IPv6 compressed and in full, IPv4, IPv4-mapped, and broken text."""
    e = table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    v4 = F.concat_ws(".", (eid * 7 % 224).cast("string"), (uid % 32).cast("string"), F.lit("0"), (eid % 4).cast("string"))
    net, host = F.format_string("%x", uid % 40), F.format_string("%x", eid % 65536)
    return e.select(
        F.when(eid % 97 == 0, F.lit(None).cast("string")).when(eid % 101 == 0, "2001:db8:::1").when(eid % 103 == 0, "1:2:3")
        .when(eid % 107 == 0, F.concat(F.lit("2002:"), net, F.lit("::"), host)).when(eid % 109 == 0, "300.1.2.3")
        .when(eid % 4 == 0, F.concat(F.lit("2001:db8:"), net, F.lit("::"), host))
        .when(eid % 4 == 1, F.concat(F.lit("2001:0DB8:"), net, F.lit(":0:0:0:1:"), host))
        .when(eid % 4 == 2, v4).otherwise(F.concat(F.lit("::ffff:"), v4)).alias("ip"))


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    html = F.col("html")
    meta = F.lit('<meta charset="utf-8">')
    shape = pid % 4
    return p.select(
        pid.alias("page_id"), pid.cast("string").alias("product_id"), F.col("url"),
        F.when(shape == 0, F.replace(F.replace(html, F.lit("<h1>"), F.lit('<h1 class="page-title"><span>')),
                                     F.lit("</h1>"), F.lit("</span></h1>")))
        .when(shape == 1, F.replace(html, meta, F.concat(
            F.lit('<meta charset="utf-8"><meta property="og:title" content=" Item '), pid.cast("string"), F.lit('">'))))
        .when(shape == 2, F.replace(
            F.replace(html, F.lit("<h1>"), F.lit('<h1 class="page-title"><span> </span>')), meta,
            F.concat(F.lit('<meta charset="utf-8"><meta property="og:title" content="Item '),
                     pid.cast("string"), F.lit('">'))))
        .otherwise(html).alias("html"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three attempts per page; attempt numbers come from a 3-element array literal."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    z = p.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    pid, n = F.col("page_id"), F.col("n")
    x = (pid * 5 + (pid % 7) * n * 3 + (pid % 3) * n * n) % 13
    codes = {0: 404, 1: 403, 2: 403, 3: 429, 4: 429, 5: 503, 6: 500, 9: 301}
    status = F.when(x.isin(7, 8), F.lit(None).cast("int"))
    for key, code in codes.items():
        status = status.when(x == key, F.lit(code))
    status = status.otherwise(F.lit(200))
    return z.select(
        pid.cast("string").alias("product_id"), F.col("url"), n.cast("int").alias("attempt"),
        status.alias("status_code"),
        F.when(x == 7, "network").when(x == 8, "other").alias("error_kind"),
    )


def _tried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine attempts per page (three rounds of three), their outcome number and time in seconds."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    z = p.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(9))))
    pid, n = F.col("page_id"), F.col("n")
    return z.select(
        "page_id", "url", "n", (F.floor((n - 1) / 3) + 1).cast("int").alias("round"), ((n - 1) % 3 + 1).cast("int").alias("attempt"),
        ((pid * 5 + (pid % 7) * n * 3 + (pid % 3) * n * n) % 13).alias("x"),
        (F.lit(1_700_000_000).cast("bigint") + n * 1000 + pid % 100).alias("finished_at"))


def attempt_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of three attempts per page, each with its time."""
    x = F.col("x")
    status = F.when(x.isin(7, 8), F.lit(None).cast("int"))
    for key, code in {0: 404, 1: 403, 2: 403, 3: 429, 4: 429, 5: 503, 6: 500, 9: 301}.items():
        status = status.when(x == key, F.lit(code))
    return _tried(spark, sf_dir).select(
        F.col("page_id").cast("string").alias("product_id"), "url", "round", "attempt", status.otherwise(F.lit(200)).alias("status_code"),
        F.when(x == 7, "network").when(x == 8, "other").alias("error_kind"), "finished_at")


def round_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of every attempt that got an answer, captured shortly before its outcome: a product
    page for 200, else a page of refusal whose heading looks like a product's."""
    t = _tried(spark, sf_dir).where(~F.col("x").isin(7, 8))
    title = F.when(F.col("x") > 9, F.concat(F.lit("Item "), F.col("page_id").cast("string"), F.lit(" capture "), F.col("n").cast("string"))) \
        .otherwise(F.lit("Access denied"))
    return t.select(
        F.col("page_id").cast("string").alias("product_id"), "round", (F.col("finished_at") - 1 - F.col("page_id") % 5).alias("captured_at"),
        F.concat(F.lit('<html><h1 class="page-title"><span>'), title, F.lit("</span></h1></html>")).alias("html"))


# --- The same views as SQL text (DuckDB / Spark SQL), for the oracle ---------------

RAW_DATA_SQL = """SELECT lpad(CAST(event_id AS STRING),24,'0') AS _id,
 CASE event_type WHEN 'view' THEN 'view_product_detail' WHEN 'purchase' THEN 'add_to_cart_action'
  WHEN 'signup' THEN 'select_product_option' WHEN 'click' THEN 'product_view_all_recommend_clicked' ELSE 'error' END AS collection,
 CASE WHEN event_type='click' THEN NULL WHEN event_id%7=0 THEN '' WHEN event_id%11=0 THEN NULL
  ELSE CAST(user_id*100 + CAST(regexp_extract(props,'([0-9]+)',1) AS BIGINT)%20 AS STRING) END AS product_id,
 CASE WHEN event_id%13=0 THEN NULL
  ELSE CAST(user_id*100 + CAST(regexp_extract(props,'([0-9]+)',1) AS BIGINT)%25 AS STRING) END AS viewing_product_id,
 CASE WHEN event_id%17=0 THEN NULL WHEN event_id%19=0 THEN 'https://stage.shop.example/p/' || CAST(event_id AS STRING)
  ELSE 'https://www.shop.example/p/' || CAST(event_id AS STRING) END AS current_url,
 CASE WHEN event_id%23=0 THEN '' WHEN event_id%29=0 THEN 'https://test.shop.example/r/' || CAST(event_id AS STRING)
  ELSE 'https://www.shop.example/r/' || CAST(event_id AS STRING) END AS referrer_url,
 CASE WHEN event_id%97=0 THEN NULL WHEN event_id%50=0 THEN '' WHEN event_id%101=0 THEN '999.1.1.1'
  WHEN event_id%103=0 THEN 'not-an-ip'
  ELSE CAST(event_id*7%224 AS STRING) || '.' || CAST(user_id%256 AS STRING) || '.0.' || CAST(event_id%4 AS STRING) END AS ip,
 CASE WHEN event_id%5=0 THEN '' WHEN event_id%6=0 THEN NULL ELSE CAST(user_id AS STRING) END AS user_id_db,
 CASE WHEN event_id%41=0 THEN '' ELSE 'dev-' || CAST(user_id*31%997 AS STRING) END AS device_id,
 CAST(user_id%12 AS STRING) AS store_id, CAST(event_id%3 AS STRING) || '.0' AS api_version,
 CASE WHEN event_id%20=0 THEN '' WHEN event_id%21=0 THEN '0' WHEN event_id%33=0 THEN NULL ELSE CAST(value AS STRING) END AS price,
 CASE WHEN event_id%8=0 THEN NULL ELSE CAST(event_id%90 AS STRING) END AS cat_id,
 CASE WHEN event_id%9=0 THEN NULL ELSE event_id%2=0 END AS is_paypal, ts
FROM events"""

IP_RANGES_SQL = """SELECT i*16777216 AS ip_from, i*16777216+16777215 AS ip_to,
 CASE WHEN i%40=3 THEN '-' ELSE substr(n_name,1,2) END AS country_short,
 CASE WHEN i%40=3 THEN '-' ELSE n_name END AS country_long,
 CASE WHEN i%40=4 THEN 'n/a' ELSE r_name END AS region,
 CASE WHEN i%40=5 THEN ' N/A ' WHEN i%40=6 THEN NULL ELSE ' City' || CAST(i AS STRING) END AS city
FROM (SELECT CAST(a.n_nationkey AS BIGINT)*25+b.n_nationkey AS i, b.n_name, r.r_name
      FROM nation a CROSS JOIN nation b JOIN region r ON b.n_regionkey=r.r_regionkey) x
WHERE i<224 AND i%9<>1"""

PRODUCT_PAGES_SQL = """SELECT page_id, CAST(page_id AS STRING) AS product_id, url, CASE page_id%4
 WHEN 0 THEN replace(replace(html,'<h1>','<h1 class="page-title"><span>'),'</h1>','</span></h1>')
 WHEN 1 THEN replace(html,'<meta charset="utf-8">','<meta charset="utf-8"><meta property="og:title" content=" Item ' || CAST(page_id AS STRING) || '">')
 WHEN 2 THEN replace(replace(html,'<h1>','<h1 class="page-title"><span> </span>'),'<meta charset="utf-8">','<meta charset="utf-8"><meta property="og:title" content="Item ' || CAST(page_id AS STRING) || '">')
 ELSE html END AS html
FROM pages"""

ATTEMPTS_SQL = """SELECT CAST(page_id AS STRING) AS product_id, url, n AS attempt,
 CASE x WHEN 0 THEN 404 WHEN 1 THEN 403 WHEN 2 THEN 403 WHEN 3 THEN 429 WHEN 4 THEN 429 WHEN 5 THEN 503
  WHEN 6 THEN 500 WHEN 7 THEN NULL WHEN 8 THEN NULL WHEN 9 THEN 301 ELSE 200 END AS status_code,
 CASE x WHEN 7 THEN 'network' WHEN 8 THEN 'other' END AS error_kind
FROM (SELECT page_id, url, n, (page_id*5 + (page_id%7)*n*3 + (page_id%3)*n*n)%13 AS x
      FROM pages CROSS JOIN (SELECT 1 AS n UNION ALL SELECT 2 UNION ALL SELECT 3) k) z"""

_TRIED_SQL = """SELECT page_id, url, n, CAST(floor((n - 1) / 3) AS INTEGER) + 1 AS round, CAST((n - 1) % 3 AS INTEGER) + 1 AS attempt,
   (page_id*5 + (page_id%7)*n*3 + (page_id%3)*n*n)%13 AS x, 1700000000 + n*1000 + page_id%100 AS finished_at
  FROM pages CROSS JOIN (SELECT 1 AS n UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5 UNION ALL
   SELECT 6 UNION ALL SELECT 7 UNION ALL SELECT 8 UNION ALL SELECT 9) k"""

ATTEMPT_ROUNDS_SQL = f"""SELECT CAST(page_id AS STRING) AS product_id, url, round, attempt,
 CASE x WHEN 0 THEN 404 WHEN 1 THEN 403 WHEN 2 THEN 403 WHEN 3 THEN 429 WHEN 4 THEN 429 WHEN 5 THEN 503
  WHEN 6 THEN 500 WHEN 7 THEN NULL WHEN 8 THEN NULL WHEN 9 THEN 301 ELSE 200 END AS status_code,
 CASE x WHEN 7 THEN 'network' WHEN 8 THEN 'other' END AS error_kind, finished_at
FROM ({_TRIED_SQL}) z"""

ROUND_PAGES_SQL = f"""SELECT CAST(page_id AS STRING) AS product_id, round, finished_at - 1 - page_id%5 AS captured_at,
 '<html><h1 class="page-title"><span>' || CASE WHEN x > 9 THEN 'Item ' || CAST(page_id AS STRING) || ' capture ' || CAST(n AS STRING)
  ELSE 'Access denied' END || '</span></h1></html>' AS html
FROM ({_TRIED_SQL}) z WHERE x NOT IN (7, 8)"""

_BLOCK = "((b * 7 + 3) * 16777216 + b * 65536)"
_CROSS = "((b * 8 + 1) * 16777216 + 200 * 65536)"
_DOC = f"({DOC_BASE}::HUGEINT + b * {NET_SIZE}::HUGEINT)"


def _mixed_part(first: str, last: str, tag: str, where: str = "true") -> str:
    return (f"SELECT {first} AS ip_from, {last} AS ip_to, '{tag}' || b::VARCHAR AS country_short, n_name || ' {tag}' AS country_long, "
            f"'{tag}' AS region, 'City ' || b::VARCHAR AS city FROM (SELECT n_nationkey::HUGEINT AS b, n_name FROM nation) z WHERE {where}")


MIXED_RANGES_SQL = " UNION ALL ".join([
    f"SELECT {V4_BASE}::HUGEINT + ip_from AS ip_from, {V4_BASE}::HUGEINT + ip_to AS ip_to, country_short, country_long, region, city FROM ({IP_RANGES_SQL}) y",
    _mixed_part(f"{V4_BASE} + {_BLOCK}", f"{V4_BASE} + {_BLOCK} + 65535", "N"), _mixed_part(f"{V4_BASE} + {_BLOCK}", f"{V4_BASE} + {_BLOCK} + 255", "I"),
    _mixed_part(f"{V4_BASE} + {_BLOCK}", f"{V4_BASE} + {_BLOCK} + 65535", "Z", "b % 5 = 0"),
    _mixed_part(f"{V4_BASE} + {_CROSS}", f"{V4_BASE} + {_CROSS} + 16777216 - 150 * 65536 - 1", "X"),
    _mixed_part(f"{DOC_BASE}::HUGEINT", f"{DOC_BASE + DOC_SIZE - 1}::HUGEINT", "D", "b = 0"), _mixed_part(_DOC, f"{_DOC} + {NET_SIZE - 1}::HUGEINT", "S"),
    _mixed_part(_DOC, f"{_DOC} + 65535", "T", "b % 2 = 0")])

_V4_TEXT = "CAST(event_id*7%224 AS STRING) || '.' || CAST(user_id%32 AS STRING) || '.0.' || CAST(event_id%4 AS STRING)"
MIXED_IPS_SQL = f"""SELECT CASE WHEN event_id%97=0 THEN NULL WHEN event_id%101=0 THEN '2001:db8:::1' WHEN event_id%103=0 THEN '1:2:3'
 WHEN event_id%107=0 THEN '2002:' || format('{{:x}}', user_id%40) || '::' || format('{{:x}}', event_id%65536) WHEN event_id%109=0 THEN '300.1.2.3'
 WHEN event_id%4=0 THEN '2001:db8:' || format('{{:x}}', user_id%40) || '::' || format('{{:x}}', event_id%65536)
 WHEN event_id%4=1 THEN '2001:0DB8:' || format('{{:x}}', user_id%40) || ':0:0:0:1:' || format('{{:x}}', event_id%65536)
 WHEN event_id%4=2 THEN {_V4_TEXT} ELSE '::ffff:' || {_V4_TEXT} END AS ip
FROM events"""

FIXTURE_SQL = {
    "mixed_ranges": MIXED_RANGES_SQL,
    "mixed_ips": MIXED_IPS_SQL,
    "attempt_rounds": ATTEMPT_ROUNDS_SQL,
    "round_pages": ROUND_PAGES_SQL,
    "raw_data": RAW_DATA_SQL,
    "ip_ranges": IP_RANGES_SQL,
    "product_pages": PRODUCT_PAGES_SQL,
    "attempts": ATTEMPTS_SQL,
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named fixture views as CTEs (merged with a leading WITH)."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{FIXTURE_SQL[n]}\n)" for n in names)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
