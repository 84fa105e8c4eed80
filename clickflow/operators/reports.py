"""Counters and reports (one-row aggregates, all in a single pass each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.config import CAPTURE_BATCH_SIZE, IP_INSERT_BATCH, LOCATION_REASONS, PRODUCT_REASONS, STATUSES


def _count_if(cond):
    return F.count(F.when(cond, F.lit(1)))


def outcome_counts(results: DataFrame, status_col: str = "status") -> DataFrame:
    """processed, success and the named errors; an unknown status counts as err_other."""
    st = F.col(status_col)
    known = [s for s in STATUSES if s != "err_other"]
    aggs = [F.count(F.lit(1)).alias("processed")]
    aggs += [_count_if(st == s).alias(s) for s in known]
    aggs.append(_count_if(~st.isin(known) | st.isNull()).alias("err_other"))
    return results.agg(*aggs)


def product_quality(validated: DataFrame, reason_col: str = "reason") -> DataFrame:
    """dq_<reason> counters over validated success rows."""
    r = F.col(reason_col)
    return validated.agg(*[_count_if(r == x).alias(f"dq_{x}") for x in PRODUCT_REASONS])


def location_quality(validated: DataFrame, reason_col: str = "reason") -> DataFrame:
    r = F.col(reason_col)
    return validated.agg(F.count(F.lit(1)).alias("total"),
                         *[_count_if(r == x).alias(f"dq_{x}") for x in LOCATION_REASONS])


def quality_counts(validated: DataFrame, kind: str = "product", reason_col: str = "reason") -> DataFrame:
    """Reason counters of validated rows: ``kind`` is ``product`` or ``location``."""
    if kind == "location":
        return location_quality(validated, reason_col)
    return product_quality(validated, reason_col)


def success_rate(num: str, den: str, digits: int = 1):
    """Percent, rounded half away from zero; null instead of an error on a zero total."""
    return F.round(F.try_divide(F.col(num) * F.lit(100.0), F.col(den)), digits)


def crawl_report(log: DataFrame, validated_success: DataFrame | None = None) -> DataFrame:
    """One row: outcome counters, product data-quality counters and the success rate
    (percent of processed items, one decimal).

    Given only the result log, everything is one aggregation over it: the rules are
    evaluated inline for successful rows, so the log is read once."""
    if validated_success is not None:
        from clickflow.operators.common import merge_rows
        rep = merge_rows(outcome_counts(log), product_quality(validated_success))
        return rep.withColumn("success_rate", success_rate("success", "processed"))
    from clickflow.operators.quality import normalize_product, product_reason
    norm = normalize_product(log)
    reason = F.when(F.col("status") == "success", product_reason())
    st = F.col("status")
    known = [x for x in STATUSES if x != "err_other"]
    aggs = [F.count(F.lit(1)).alias("processed")]
    aggs += [_count_if(st == x).alias(x) for x in known]
    aggs.append(_count_if(~st.isin(known) | st.isNull()).alias("err_other"))
    aggs += [_count_if(reason == x).alias(f"dq_{x}") for x in PRODUCT_REASONS]
    return norm.agg(*aggs).withColumn("success_rate", success_rate("success", "processed"))


def ip_report(validated: DataFrame) -> DataFrame:
    """One row: total distinct addresses, reason counters and the valid rate."""
    rep = location_quality(validated)
    return rep.withColumn("valid_rate", success_rate("dq_valid", "total"))


def running_totals(df: DataFrame, order_col: str, sum_cols: list[str], block: int = 1024) -> DataFrame:
    """Cumulative sums (``cum_<c>``) and grand totals (``total_<c>``) of ``sum_cols`` in
    ``order_col`` order, for integer, distinct, non-negative ``order_col`` values.

    A prefix scan over as many levels as it needs: rows are grouped into blocks of ``block``
    consecutive keys, blocks into blocks of blocks, until one block is left; then the offsets come down
    again. Every window is partitioned and sees at most ``block`` rows, whatever the number of rows. The
    height follows from the greatest key (one small aggregate)."""
    top = df.agg(F.max(order_col)).first()[0] or 0
    levels = [df.select(F.col(order_col).cast("long").alias("_k"), *[F.col(c).alias(f"_s_{c}") for c in sum_cols])]
    while top >= block:
        top //= block
        up = levels[-1].groupBy(F.floor(F.col("_k") / block).alias("_k")).agg(*[F.sum(f"_s_{c}").alias(f"_s_{c}") for c in sum_cols])
        levels.append(up)
    # sums before each key: those inside its block of the level, and those before the block
    before = None
    for level in reversed(levels):
        ahead = Window.partitionBy("_blk").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
        here = level.withColumn("_blk", F.floor(F.col("_k") / block)).select("_k", "_blk", *[F.coalesce(F.sum(f"_s_{c}").over(ahead), F.lit(0)).alias(f"_b_{c}") for c in sum_cols])
        if before is not None:
            off = before.select(F.col("_k").alias("_blk"), *[F.col(f"_b_{c}").alias(f"_o_{c}") for c in sum_cols])
            here = here.join(off, "_blk").select("_k", *[(F.col(f"_b_{c}") + F.col(f"_o_{c}")).alias(f"_b_{c}") for c in sum_cols])
        before = here.drop("_blk")
    totals = levels[-1].agg(*[F.sum(f"_s_{c}").alias(f"total_{c}") for c in sum_cols]).first()
    joined = df.join(before, F.col(order_col) == F.col("_k"))
    return joined.select(*df.columns, *[(F.col(f"_b_{c}") + F.col(c)).alias(f"cum_{c}") for c in sum_cols],
                         *[F.lit(totals[f"total_{c}"]).cast("long").alias(f"total_{c}") for c in sum_cols])


def progress(df: DataFrame, order_col: str, size: int, counters: dict, block: int = 1024) -> DataFrame:
    """Running progress per chunk of ``size`` rows in ``order_col`` order: per chunk its
    row count ``n``, cumulative ``processed`` and cumulative counter columns (one per
    ``counters`` entry: name -> condition), and rows ``pending`` after the chunk.
    Distributed numbering and a prefix scan of as many levels as it needs: no window over all rows
    or chunks."""
    from clickflow.operators.export import chunk_column, numbered_rows
    from clickflow.session import work_path
    spark = df.sparkSession
    # one row per chunk (rows / size of them), read by every level of the scan: written once, so
    # the numbered data is read once and its cached ranges go as soon as it is
    path = work_path(spark, "chunks")
    with numbered_rows(df, [order_col], out="_rn") as numbered:
        chunks = numbered.withColumn("chunk", chunk_column("_rn", size, 1))
        (chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), *[_count_if(cond).alias(f"n_{k}") for k, cond in counters.items()])
         .write.parquet(path))
    per = spark.read.parquet(path)
    sums = ["n"] + [f"n_{k}" for k in counters]
    cum = running_totals(per, "chunk", sums, block)
    return cum.select("chunk", "n", F.col("cum_n").alias("processed"),
                      *[F.col(f"cum_n_{k}").alias(k) for k in counters],
                      (F.col("total_n") - F.col("cum_n")).alias("pending"))


def chunk_progress(results: DataFrame, order_col: str = "product_id", size: int = CAPTURE_BATCH_SIZE,
                   status_col: str = "status", block: int = 1024) -> DataFrame:
    """Capture progress per batch of ``size`` items: cumulative successes, 404s, items to
    retry, and items pending."""
    st = F.col(status_col)
    return progress(results, order_col, size, {"success": st == "success", "err_404": st == "err_404",
                                               "to_retry": ~st.isin("success", "err_404")}, block)


def ip_progress(validated: DataFrame, size: int = IP_INSERT_BATCH, block: int = 1024) -> DataFrame:
    """IP progress per insert batch of ``size`` distinct addresses (address order):
    cumulative valid rows and rejects per reason, and addresses pending."""
    r = F.col("reason")
    return progress(validated, "ip", size, {f"dq_{x}": r == x for x in LOCATION_REASONS}, block)
