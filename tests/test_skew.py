"""One key holding a third of all rows: results stay whole and exact, and the plans
pre-aggregate before the shuffle (a hot key costs one row per map task)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickflow.operators import candidates as cand
from clickflow.operators import events as ev
from clickflow.operators import geo
from clickflow.operators import warehouse as wh
from conftest import plan_text, rows

G1 = "view_product_detail"


def hot_events(spark, n=6000):
    data = []
    for i in range(n):
        pid = "HOT" if i % 3 == 0 else f"p{i % 500}"
        data.append((f"{i:06d}", G1, pid, None, f"https://w/{i}", "r", "9.9.9.9" if i % 3 == 0 else f"1.2.{i % 200}.{i % 7}"))
    return spark.createDataFrame(data, "_id string, collection string, product_id string, viewing_product_id string, "
                                       "current_url string, referrer_url string, ip string").repartition(8)


def test_hot_product_candidates(spark):
    df = hot_events(spark)
    got = cand.candidates(df)
    t = ev.resolve_url(ev.resolve_product_id(ev.tag_event_group(df)))
    w = Window.partitionBy("resolved_id").orderBy("event_group", "_id")
    exp = (t.withColumn("rn", F.row_number().over(w)).where("rn = 1")
           .select(F.col("resolved_id").alias("product_id"), "url", "event_group", "_id"))
    assert rows(got) == rows(exp)
    assert dict(rows(got, "product_id", "url"))["HOT"] == "https://w/0"
    tree = plan_text(got).split("\n\n")[0]
    # final aggregate above the exchange, partial aggregate below it
    lines = [ln for ln in tree.splitlines() if "Aggregate" in ln or "Exchange" in ln]
    assert [("Exchange" in ln) for ln in lines][:3] == [False, True, False]
    assert "partial_min" in plan_text(got)


def test_hot_ip_distinct_and_lookup(spark):
    df = hot_events(spark)
    u = geo.unique_ips(df)
    assert u.count() == df.select("ip").distinct().count()
    text = plan_text(u)
    # partial aggregate below the exchange: the hot address is reduced map-side
    assert "HashAggregate" in text and "Keys [1]: [ip" in text
    ranges = spark.createDataFrame([(0, 4294967295, "X", "All", "R", "C")],
                                   "ip_from bigint, ip_to bigint, country_short string, country_long string, "
                                   "region string, city string")
    loc = geo.locate_ips(u, ranges)
    assert loc.where(F.col("country_short") == "X").count() == u.count()


def test_hot_duplicated_target_key_merge(spark):
    target = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("K")).otherwise(F.col("id").cast("string")).alias("_id"))
    source = spark.createDataFrame([("K",), ("new1",), ("1",), ("new2",)], "_id string")
    new = wh.merge_insert_only(target, source, "_id", source_is_bounded=True)
    assert rows(new) == [("new1",), ("new2",)]
    text = plan_text(new)
    assert "SortMergeJoin" not in text


def test_session_has_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
