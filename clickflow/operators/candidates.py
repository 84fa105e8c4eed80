"""Candidate selection: one URL per product, finished ids excluded.

Plan shape (one scan of the events, one shuffle of events):
  scan (event-name predicate + 6 columns) -> tag group -> resolve id/url -> URL filter
  -> anti-join on viewing_product_id (row level; hash side is the finished set)
  -> min(struct(group, _id, url)) per resolved id  (partial aggregate before the shuffle,
     so a hot product costs one row per map task, not one per event)
  -> anti-join on the resolved id (runs on the aggregate's partitioning).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.config import BROADCAST_LIMIT_BYTES, FINAL_STATUSES, GROUP1_EVENTS, GROUP2_EVENTS, ID_BYTES
from clickflow.operators import bloom
from clickflow.operators.common import merge_rows
from clickflow.operators.events import resolve_product_id, resolve_url, tag_event_group

_NEEDED = ["_id", "collection", "product_id", "viewing_product_id", "current_url", "referrer_url"]


def _ids(finished: DataFrame, col: str = "product_id") -> DataFrame:
    """Finished ids as non-blank strings (a blank id would exclude blank-id events)."""
    return (finished.select(F.col(col).cast("string").alias("_fid"))
            .where(F.col("_fid").isNotNull() & (F.col("_fid") != "")))


def _sized_ids(finished: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """The finished ids and whether their measured bytes fit the broadcast budget."""
    f = _ids(finished)
    size = f.agg(F.sum(F.octet_length("_fid") + F.lit(ID_BYTES))).first()[0] or 0
    return f, size <= limit


def _without(df: DataFrame, col: str, ids: DataFrame, small: bool, filter_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Rows of ``df`` whose ``col`` is not among ``ids``. Small sets are broadcast. Beyond the
    budget a Bloom filter of the ids (``operators.bloom``) tells which rows may match: only
    these meet the ids in a shuffled, exact anti-join. All others, and rows with a null key, go
    past the shuffle."""
    if small:
        ids = F.broadcast(ids)
        return df.join(ids, F.col(col) == ids["_fid"], "left_anti")
    words = bloom.words_for(ids.count(), filter_bytes)
    if words is None:
        maybe = df.where(F.col(col).isNotNull())
        past = df.where(F.col(col).isNull())
    else:
        told = bloom.flagged(df, col, bloom.build(ids, "_fid", words), words)
        maybe, past = told.where("_maybe").drop("_maybe"), told.where(~F.col("_maybe")).drop("_maybe")
    return past.unionByName(maybe.join(ids, F.col(col) == ids["_fid"], "left_anti"))


def _marked(df: DataFrame, col: str, ids: DataFrame, small: bool, out: str = "_done") -> DataFrame:
    """``df`` with ``out``: the id (of the distinct ``ids``) that equals ``col``, else null. Null
    keys go past a shuffled join."""
    mark = ids.select(F.col("_fid").alias(out))
    if small:
        return df.join(F.broadcast(mark), F.col(col) == F.col(out), "left")
    keyed = df.where(F.col(col).isNotNull()).join(mark, F.col(col) == F.col(out), "left")
    return keyed.unionByName(df.where(F.col(col).isNull()).withColumn(out, F.lit(None).cast("string")))


def exclude_finished(df: DataFrame, finished: DataFrame, group_col: str = "event_group",
                     broadcast_limit_bytes: int | None = None) -> DataFrame:
    """Row-level store-side exclusion: a group-1 row is dropped when either its
    product_id or its viewing_product_id is finished; a group-2 row when its
    viewing_product_id is. Rows with a null key are kept (left_anti, never NOT IN).
    The finished ids are broadcast when their bytes fit ``broadcast_limit_bytes``;
    beyond it a Bloom filter keeps all rows that cannot match out of the shuffled anti-joins."""
    limit = BROADCAST_LIMIT_BYTES if broadcast_limit_bytes is None else broadcast_limit_bytes
    f, small = _sized_ids(finished, limit)
    k1 = F.when(F.col(group_col) == 1, F.col("product_id").cast("string"))
    out = _without(df.withColumn("_k1", k1), "_k1", f, small).drop("_k1")
    out = _without(out.withColumn("_k2", F.col("viewing_product_id").cast("string")), "_k2", f, small)
    return out.drop("_k2")


def first_url(df: DataFrame, id_col: str = "resolved_id", group_col: str = "event_group",
              order_col: str = "_id", url_col: str = "url") -> DataFrame:
    """One row per product id: group-1 rows before group-2 rows, then ``order_col``.
    ``min(struct)`` is decomposable, so each map task pre-reduces its rows."""
    best = F.min(F.struct(F.col(group_col).alias("g"), F.col(order_col).alias("o"), F.col(url_col).alias("u")))
    return (df.where(F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("product_id"))
            .agg(best.alias("_b"))
            .select("product_id", F.col("_b.u").alias("url"), F.col("_b.g").alias("event_group"),
                    F.col("_b.o").alias(order_col)))


def candidates(raw: DataFrame, finished: DataFrame | None = None, markers: Sequence[str] = (),
               group1: Sequence[str] = GROUP1_EVENTS, group2: Sequence[str] = GROUP2_EVENTS,
               broadcast_limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Work items (product_id, url, event_group, _id): the first valid URL per product
    among events not touching a finished id.

    Equivalent to the row-level exclusion followed by ``first_url``: every row whose
    resolved id is finished is excluded anyway (the resolved id is one of the tested
    fields), so that test moves after the aggregate, where the data is one row per
    product and already partitioned by it. The viewing_product_id test is applied to
    every row: for a group-1 row with its own product_id it is the only test that can
    differ from the resolved-id test (and for the others it repeats it).

    The finished ids are counted first (one small job). When they fit
    ``broadcast_limit_bytes`` the viewing-id test is a broadcast hash anti-join on the
    event rows (no shuffle). Beyond it, events are first reduced map-side to one row per
    (product, viewing id) with ``min(struct)``, and of those only the rows that a Bloom filter
    of the ids lets through meet them in a shuffled anti-join (the test is constant inside such a
    group, so the result is the same); a second ``min`` per product finishes the job."""
    ev = tag_event_group(raw.select(*_NEEDED), group1, group2)
    ev = resolve_url(resolve_product_id(ev), markers)
    if finished is None:
        return first_url(ev)
    f, small = _sized_ids(finished, broadcast_limit_bytes)
    ev = ev.withColumn("_k2", F.col("viewing_product_id").cast("string"))
    if small:
        fb = F.broadcast(f)
        kept = ev.join(fb, F.col("_k2") == fb["_fid"], "left_anti").drop("_k2")
        best = first_url(kept)
        return best.join(fb, best["product_id"] == fb["_fid"], "left_anti")
    return _best_urls(_without(_work_pairs(ev), "_k2", f, False), f, False)


def _work_pairs(ev: DataFrame) -> DataFrame:
    """One row per (product, viewing id) with its first valid URL as a struct (null if none of
    its events has one). Mergeable: the least of two such rows stands for the events of both."""
    key = F.struct(F.col("event_group").alias("g"), F.col("_id").alias("o"), F.col("url").alias("u"))
    return (ev.where(F.col("resolved_id").isNotNull())
            .groupBy("resolved_id", "_k2").agg(F.min(F.when(F.col("url").isNotNull(), key)).alias("_b")))


def _best_urls(pairs: DataFrame, ids: DataFrame, small: bool) -> DataFrame:
    """The first URL per product of the pairs that are left, without the finished products."""
    best = (pairs.groupBy(F.col("resolved_id").alias("product_id")).agg(F.min("_b").alias("_b")).where("_b IS NOT NULL")
            .select("product_id", F.col("_b.u").alias("url"), F.col("_b.g").alias("event_group"),
                    F.col("_b.o").alias("_id")))
    return _without(best, "product_id", ids, small)


def work_state(raw: DataFrame, markers: Sequence[str] = (), group1: Sequence[str] = GROUP1_EVENTS,
               group2: Sequence[str] = GROUP2_EVENTS) -> DataFrame:
    """What candidate selection needs of the events: one row per (product, viewing id) with the
    first valid URL (null if there is none). One event scan with map-side minima; written once, it
    serves the counts and the candidates of any number of rounds."""
    ev = resolve_product_id(tag_event_group(raw.select(*_NEEDED), group1, group2))
    urls = resolve_url(ev, markers, keep_invalid=True)
    return _work_pairs(urls.withColumn("_k2", F.col("viewing_product_id").cast("string")))


def state_candidates(state: DataFrame, finished: DataFrame | None = None,
                     broadcast_limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``candidates`` from a ``work_state`` instead of the events."""
    ids, small = _sized_ids(finished, broadcast_limit_bytes) if finished is not None else (None, False)
    if ids is None:
        ids, small = state.select(F.lit("").alias("_fid")).limit(0), True
    return _best_urls(_without(state, "_k2", ids, small), ids, small)


def count_products(raw: DataFrame, group1: Sequence[str] = GROUP1_EVENTS,
                   group2: Sequence[str] = GROUP2_EVENTS) -> DataFrame:
    """Distinct resolved product ids over both groups (no URL rule), one row."""
    ev = resolve_product_id(tag_event_group(raw.select("collection", "product_id", "viewing_product_id"),
                                            group1, group2))
    return ev.agg(F.count_distinct("resolved_id").alias("total_products"))


def pending_count(raw: DataFrame, finished: DataFrame, markers: Sequence[str] = ()) -> DataFrame:
    """Pending work, two ways: ``pending_estimate`` = distinct ids - finished ids (the
    original formula, which ignores URL rules and can drift below zero) and
    ``pending_exact`` = candidates left after exclusion."""
    ids, small = _sized_ids(finished, BROADCAST_LIMIT_BYTES)
    ids = ids.distinct()
    # one event scan: the state's pairs learn whether their viewing id is finished, then each
    # product whether a pair with a URL is left
    pairs = _marked(work_state(raw, markers), "_k2", ids, small)
    products = pairs.groupBy("resolved_id").agg(F.min(F.when(F.col("_done").isNull(), F.col("_b"))).isNotNull().alias("open"))
    judged = _marked(products, "resolved_id", ids, small)
    counts = judged.agg(F.count(F.lit(1)).alias("total_products"),
                        F.count(F.when(F.col("open") & F.col("_done").isNull(), 1)).alias("pending_exact"))
    n_finished = ids.agg(F.count(F.lit(1)).alias("finished"))
    return merge_rows(counts, n_finished).select(
        "total_products", "finished",
        (F.col("total_products") - F.col("finished")).alias("pending_estimate"), "pending_exact")


def finished_ids(results: DataFrame, id_col: str = "product_id", status_col: str = "status",
                 final: Sequence[str] = FINAL_STATUSES) -> DataFrame:
    """Finished ids = ids whose status is final (success or 404), deduplicated."""
    return (results.where(F.col(status_col).isin(list(final)))
            .select(F.col(id_col).cast("string").alias("product_id"))
            .where(F.col("product_id").isNotNull() & (F.col("product_id") != ""))
            .distinct())


def finished_union(*id_frames: DataFrame, col: str = "product_id") -> DataFrame:
    """Finished ids from several id sources (e.g. the success ids and the 404 ids):
    union, blanks dropped, deduplicated."""
    from functools import reduce
    parts = [_ids(f, col).withColumnRenamed("_fid", "product_id") for f in id_frames]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def next_round(cands: DataFrame, results: DataFrame, final: Sequence[str] = FINAL_STATUSES) -> DataFrame:
    """Work for the next round: candidates whose last result is not final."""
    done = finished_ids(results, final=final).withColumnRenamed("product_id", "_fid")
    return cands.join(done, cands["product_id"] == done["_fid"], "left_anti")
