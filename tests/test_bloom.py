"""Bloom filter built by aggregation, and what it keeps out of the shuffle."""

import pytest
from pyspark.sql import functions as F

from clickflow.operators import bloom, candidates as cand
from clickflow.operators import events as ev
from conftest import rows


def test_filter_has_no_false_negatives_and_merges(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("k"))
    words = bloom.words_for(20_000)
    a, b = (bloom.build(ids.where(F.pmod(F.substring("k", 2, 9).cast("long"), F.lit(2)) == i), "k", words) for i in (0, 1))
    whole = bloom.build(ids, "k", words)
    assert rows(bloom.merge(a, b)) == rows(whole) and whole.count() <= words
    probe = ids.unionByName(spark.range(20_000).select(F.concat(F.lit("q"), F.col("id").cast("string")).alias("k"))).unionByName(
        spark.createDataFrame([(None,)], "k string"))
    got = bloom.flagged(probe, "k", whole, words).groupBy(F.substring("k", 1, 1).alias("s")).agg(F.sum(F.col("_maybe").cast("int")).alias("hits"))
    hits = dict(rows(got))
    assert hits["p"] == 20_000 and hits["q"] < 0.06 * 20_000 and hits[None] == 0


@pytest.mark.parametrize("keys,limit,want", [(0, 1 << 20, 1), (64, 1 << 20, 12), (10 ** 9, 1 << 20, None), (5, 0, None)])
def test_words_within_the_limit(keys, limit, want):
    assert bloom.words_for(keys, limit) == want


def _events(spark, n=4000):
    return spark.range(n).select(
        F.format_string("%06d", "id").alias("_id"), F.lit("view_product_detail").alias("collection"), F.concat(F.lit("p"), (F.col("id") % 900).cast("string")).alias("product_id"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("p"), (F.col("id") % 1300).cast("string"))).alias("viewing_product_id"),
        F.lit("https://w/1").alias("current_url"), F.lit("r").alias("referrer_url"))


def test_equal_rows_at_budget_zero(spark):
    raw = _events(spark)
    finished = spark.range(0, 1300, 13).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("product_id"))
    tagged = ev.tag_event_group(raw)
    want, got = cand.exclude_finished(tagged, finished), cand.exclude_finished(tagged, finished, broadcast_limit_bytes=0)
    assert rows(got.select(*want.columns)) == rows(want) and want.count() > 0
    cols = ["product_id", "url", "event_group", "_id"]
    assert rows(cand.candidates(raw, finished, broadcast_limit_bytes=0), *cols) == rows(cand.candidates(raw, finished), *cols)
    # no room for the filter either: the plain shuffled anti-join
    ids = finished.select(F.col("product_id").alias("_fid"))
    assert rows(cand._without(raw, "viewing_product_id", ids, False, 0)) == rows(cand._without(raw, "viewing_product_id", ids, True))


def test_only_rows_that_may_match_are_shuffled(spark):
    raw = _events(spark).select("_id", "viewing_product_id")
    ids = spark.range(0, 1300, 130).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("_fid"))
    kept = cand._without(raw, "viewing_product_id", ids, False)
    n = kept.count()
    really = raw.join(ids, F.col("viewing_product_id") == F.col("_fid"), "left_semi").count()
    assert n == raw.count() - really
    words = bloom.words_for(ids.count())
    maybe = bloom.flagged(raw, "viewing_product_id", bloom.build(ids, "_fid", words), words).where("_maybe").count()
    assert really <= maybe <= really + 0.08 * raw.count()
