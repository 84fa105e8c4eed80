"""As-of join: for each point the nearest mark of its key at or before it.

One sorted union instead of pairs: marks and points are dealt to range partitions by
(key, place), marks first at equal places, and each point takes the last mark before it. The partitions come
from the data, so a key with a third of all rows is spread over many of them; a point
whose mark lies in an earlier partition gets it from the carry, the last mark before each
partition (one row per partition).

The dealt rows are written once to the shared folder: both passes must see the same
partitions, and lost executors reread them. Only keys, places and ``value`` move, so give a
small value (what identifies the mark) and join the rest back by it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.session import work_path


def dealt_by_range(df: DataFrame, order: dict[str, Column], name: str, num_partitions: int | None = None) -> DataFrame:
    """``df`` with the columns ``order`` and its range partition ``_part`` in their order, written
    to the shared folder and read back. Equal rows may fall on both sides of a border, so give
    an order that tells them apart where that matters."""
    spark = df.sparkSession
    n = int(num_partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumns(order).repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    path = work_path(spark, name)
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def asof_join(points: DataFrame, marks: DataFrame, by: Sequence[str], at: str, mark_at: str, value: str,
              out: str = "mark", num_partitions: int | None = None) -> DataFrame:
    """``points`` with the column ``out``: the ``value`` of the mark with the same ``by`` columns and
    the greatest ``mark_at`` not after ``at`` (of equal ones the greatest value), null when
    there is none. Points with a null key or place have no mark; marks with a null key or place take no part."""
    keys = [f"_by{i}" for i in range(len(by))]

    def whole(cols: Sequence[str]) -> Column:
        met = F.lit(True)
        for c in cols:
            met = met & F.col(c).isNotNull()
        return met

    m = marks.where(whole([*by, mark_at])).select(
        *[F.col(c).alias(k) for k, c in zip(keys, by, strict=True)], F.col(mark_at).alias("_at"), F.lit(0).alias("_kind"),
        F.col(value).alias("_value"), F.lit(None).cast(points.schema.simpleString()).alias("_point"))
    point = F.struct(*[F.col(f"`{c}`") for c in points.columns])
    p = points.where(whole([*by, at])).select(
        *[F.col(c).alias(k) for k, c in zip(keys, by, strict=True)], F.col(at).alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast(m.schema["_value"].dataType).alias("_value"), point.alias("_point"))
    # the salt lets equal points part; marks at one place stay in the order of their values
    salt = F.when(F.col("_kind") == 1, F.monotonically_increasing_id()).otherwise(F.lit(-1).cast("long"))
    order = {**{k: F.col(k) for k in keys}, "_at": F.col("_at"), "_kind": F.col("_kind"), "_value": F.col("_value"), "_salt": salt}
    dealt = dealt_by_range(m.unionByName(p), order, "asof", num_partitions)
    mark = F.when(F.col("_kind") == 0, F.struct(*keys, "_at", "_value"))
    # the last mark before each partition: one row per partition
    ends = dealt.where("_kind = 0").groupBy("_part").agg(F.max(mark).alias("_end"))
    parts = dealt.select("_part").distinct().join(ends, "_part", "left")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select("_part", F.max("_end").over(before).alias("_carry"))
    upto = Window.partitionBy("_part", *keys).orderBy("_at", "_kind", "_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = dealt.withColumn("_own", F.last(mark, ignorenulls=True).over(upto)).where("_kind = 1").join(F.broadcast(carry), "_part")
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"_carry.{k}") == F.col(k))
    hit = F.coalesce(F.col("_own._value"), F.when(same, F.col("_carry._value")))
    told = found.select("_point.*", hit.alias(out))
    none = points.where(~whole([*by, at])).withColumn(out, F.lit(None).cast(m.schema["_value"].dataType))
    return told.unionByName(none)
