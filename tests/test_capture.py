"""Candidate selection: groups, truthy ids, URL rules, exclusion, first URL wins."""

from pyspark.sql import functions as F

from clickflow.operators import candidates as cand
from clickflow.operators import events as ev
from conftest import rows

G1, G2 = "view_product_detail", "product_view_all_recommend_clicked"
SCHEMA = "_id string, collection string, product_id string, viewing_product_id string, current_url string, referrer_url string"


def raw(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_event_groups_and_truthy_ids(spark):
    df = raw(spark, [
        ("01", G1, "", "v1", "u", "r"),        # '' falls through to viewing id (T1)
        ("02", G1, "0", "v2", "u", "r"),       # '0' is truthy as a string
        ("03", G2, "p3", "v3", "u", "r"),      # group 2 uses viewing id only
        ("04", G2, "p4", "", "u", "r"),        # no truthy id
        ("05", "other", "p5", "v5", "u", "r"),
        ("06", G1, None, None, "u", "r"),
    ])
    t = ev.resolve_product_id(ev.tag_event_group(df))
    assert rows(t, "_id", "event_group", "resolved_id") == [
        ("01", 1, "v1"), ("02", 1, "0"), ("03", 2, "v3"), ("04", 2, None), ("06", 1, None)]


def test_url_rules(spark):
    df = raw(spark, [
        ("01", G1, "p", None, "https://www.x/p", "r"),
        ("02", G1, "p", None, "https://stage.shop.x/p", "r"),
        ("03", G2, None, "v", "cur", "https://test.shop.x/r"),
        ("04", G2, None, "v", "cur", ""),
        ("05", G1, "p", None, None, "r"),
        ("06", G1, "p", None, "https://STAGE.SHOP.x/p", "r"),   # markers are case-sensitive
    ])
    t = ev.resolve_url(ev.tag_event_group(df), ["stage.shop", "test.shop"])
    assert rows(t, "_id", "url") == [("01", "https://www.x/p"), ("06", "https://STAGE.SHOP.x/p")]


def test_first_url_group1_first_and_filter_before_dedupe(spark):
    df = raw(spark, [
        ("05", G2, None, "A", "c", "https://www/r5"),
        ("07", G1, "A", None, "https://www/p7", "r"),
        ("06", G1, "A", None, "https://stage.shop/p6", "r"),    # earlier but filtered (T5)
        ("01", G2, None, "B", "c", "https://www/r1"),
        ("03", G2, None, "B", "c", "https://www/r3"),
    ])
    c = cand.candidates(df, None, ["stage.shop"])
    assert rows(c) == [("A", "https://www/p7", 1, "07"), ("B", "https://www/r1", 2, "01")]


def test_exclusion_semantics(spark):
    df = raw(spark, [
        ("01", G1, "A", "Z", "u1", "r"),     # viewing id finished -> dropped
        ("02", G1, "A", "Y", "u2", "r"),     # kept: A wins with u2
        ("03", G1, None, None, "u3", "r"),   # null keys kept by the anti-join
        ("04", G2, "F", "B", "c", "r4"),     # group 2: product_id is not tested
        ("05", G1, "F", "C", "u5", "r"),     # product id finished -> dropped
        ("06", G1, "", "F", "u6", "r"),      # resolves to F -> dropped
    ])
    finished = spark.createDataFrame([("Z",), ("F",), ("",), (None,)], "product_id string")
    t = ev.tag_event_group(df)
    kept = cand.exclude_finished(t, finished)
    assert [r[0] for r in rows(kept, "_id")] == ["02", "03", "04"]
    c = cand.candidates(df, finished)
    assert rows(c, "product_id", "url") == [("A", "u2"), ("B", "r4")]


def test_candidates_equals_row_level_exclusion_then_first_url(spark):
    import random
    rnd = random.Random(7)
    ids = ["a", "b", "c", "d", "", None]
    data = []
    for i in range(400):
        g = rnd.choice([G1, G2, "x"])
        data.append((f"{i:04d}", g, rnd.choice(ids), rnd.choice(ids), rnd.choice(["u", "", None]) and f"u{i}",
                     rnd.choice(["r", "", None]) and f"r{i}"))
    df = raw(spark, data)
    finished = spark.createDataFrame([("b",), ("d",)], "product_id string")
    fast = cand.candidates(df, finished)
    t = ev.resolve_url(ev.resolve_product_id(cand.exclude_finished(ev.tag_event_group(df), finished)))
    slow = cand.first_url(t)
    assert rows(fast) == rows(slow)
    assert fast.select("product_id").distinct().count() == fast.count()


def test_counts_and_pending(spark):
    df = raw(spark, [
        ("01", G1, "A", None, "u", "r"),
        ("02", G1, "", "B", None, "r"),      # counted in total even without URL (T7)
        ("03", G2, None, "C", "c", "r3"),
    ])
    finished = spark.createDataFrame([("A",), ("Q",)], "product_id string")
    assert cand.count_products(df).first()["total_products"] == 3
    p = cand.pending_count(df, finished).first().asDict()
    assert p == {"total_products": 3, "finished": 2, "pending_estimate": 1, "pending_exact": 1}


def test_finished_and_next_round(spark):
    results = spark.createDataFrame(
        [("A", "success"), ("B", "err_404"), ("C", "err_403"), ("A", "success")], "product_id string, status string")
    assert rows(cand.finished_ids(results)) == [("A",), ("B",)]
    cands = spark.createDataFrame([("A", "u"), ("C", "u")], "product_id string, url string")
    assert rows(cand.next_round(cands, results)) == [("C", "u")]


def test_candidates_plan_partial_aggregate_before_shuffle(spark):
    from conftest import plan_text
    df = raw(spark, [("01", G1, "A", None, "u", "r")])
    text = plan_text(cand.candidates(df))
    # map-side combine: a partial aggregate sits below the exchange
    assert "partial_min" in text


def test_candidates_disjoint_from_finished(spark):
    from conftest import SF_SMALL
    from clickflow.sources import fixtures as fx
    raw = fx.raw_data(spark, SF_SMALL)
    first = cand.candidates(raw)
    finished = first.select("product_id").orderBy("product_id").limit(50)   # some products are done
    nxt = cand.candidates(raw, finished)
    assert nxt.join(finished, "product_id").count() == 0
    assert nxt.select("product_id").distinct().count() == nxt.count()


def test_exclude_finished_is_hash_anti_join(spark):
    from conftest import plan_text
    df = ev.tag_event_group(raw(spark, [("01", G1, "A", "B", "u", "r")]))
    finished = spark.createDataFrame([("A",)], "product_id string")
    text = plan_text(cand.exclude_finished(df, finished))
    assert "LeftAnti" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_integer_ids_match_string_finished_ids(spark):
    """T3: ids compared as strings on both sides."""
    df = spark.createDataFrame([("01", G1, 7, 8, "u1", "r"), ("02", G1, 9, 10, "u2", "r"),
                                ("03", G1, 0, 11, "u3", "r")],     # 0 is falsy: falls through to 11 (T1)
                               "_id string, collection string, product_id bigint, viewing_product_id bigint, "
                               "current_url string, referrer_url string")
    finished = spark.createDataFrame([("7",)], "product_id string")
    assert rows(cand.candidates(df, finished), "product_id") == [("11",), ("9",)]
    assert [r[0] for r in rows(cand.exclude_finished(ev.tag_event_group(df), finished), "_id")] == ["02", "03"]



def test_finished_union(spark):
    ok = spark.createDataFrame([("a",), ("b",), ("",)], "product_id string")
    gone = spark.createDataFrame([("b",), ("c",), (None,)], "product_id string")
    assert rows(cand.finished_union(ok, gone)) == [("a",), ("b",), ("c",)]



def test_large_finished_path_equals_broadcast_path(spark):
    import random
    rnd = random.Random(3)
    ids = [f"p{i}" for i in range(30)] + ["", None]
    data = [(f"{i:04d}", rnd.choice([G1, G2, "x"]), rnd.choice(ids), rnd.choice(ids),
             f"https://w/c{i}", f"https://w/r{i}") for i in range(600)]
    df = raw(spark, data)
    finished = spark.createDataFrame([(f"p{i}",) for i in range(0, 30, 4)], "product_id string")
    small = cand.candidates(df, finished)
    large = cand.candidates(df, finished, broadcast_limit_bytes=0)      # force the pre-aggregated path
    assert rows(small) == rows(large)
    from conftest import plan_text
    text = plan_text(cand.candidates(df, finished, broadcast_limit_bytes=0))
    assert text.count("partial_min") >= 2                                # reduced before each shuffle
