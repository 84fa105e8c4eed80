"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickflow.config import BROADCAST_LIMIT_BYTES
from clickflow.session import work_path
from clickflow.sources import fs

#: A word: a run of characters outside space and \\x09-\\x0D.
WORD = r"[^\x20\x09-\x0D]+"
#: A side is broadcast only when its measured size is at most this many bytes.
BROADCAST_BYTES = BROADCAST_LIMIT_BYTES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor rereads files that all executors share, and every
    later reader sees the same rows."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made._saved_path = path
    return made


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``saved`` that nothing will read again."""
    for t in tables:
        fs.delete(t.sparkSession, t._saved_path)


def _width(df: DataFrame) -> Column:
    """Bytes of a row, from the column types."""
    total = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            part = F.octet_length(c)
        elif kind.startswith("array"):
            part = F.size(c) * 16
        else:
            part = F.lit(16)
        total = total + F.coalesce(part.cast("long"), F.lit(0)) + 8
    return total


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows of a saved table (one aggregate, one row to the driver)."""
    return int(df.select(F.sum(_width(df)).alias("b")).first()["b"] or 0)


def join_measured(big: DataFrame, small: DataFrame, keys: dict[str, Column] | Sequence[str], how: str = "left",
                  limit: int = BROADCAST_BYTES) -> DataFrame:
    """Null-safe join of ``big`` with the saved table ``small``.

    ``keys`` maps columns of ``small`` to expressions over ``big``. ``small`` is broadcast
    when its measured size is within ``limit``; beyond it both sides are shuffled and
    adaptive execution splits the partitions of hot keys. The key columns of ``small``
    are dropped; its other columns must not clash with those of ``big``."""
    keys = keys if isinstance(keys, dict) else {k: F.col(k) for k in keys}
    side = small.select(*[F.col(k).alias(f"_key_{k}") for k in keys],
                        *[F.col(c) for c in small.columns if c not in keys])
    if measured_bytes(small) <= limit:
        side = F.broadcast(side)
    on = None
    for k, expr in keys.items():
        one = expr.eqNullSafe(F.col(f"_key_{k}"))
        on = one if on is None else on & one
    out = big.join(side, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_key_{k}" for k in keys])


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """The rows of ``df`` as one struct column ``_row`` beside the ``named`` expressions, so
    that columns an operator makes cannot clash with those of its input."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                     *[e.alias(n) for n, e in named.items()])


def ranked(df: DataFrame, order: Sequence[Column], name: str, out: str = "rank") -> DataFrame:
    """``df`` (saved) with its row number from 0 in the given order, without one task for
    all rows: range partitions, their counts (one row each) and the position within."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = {f"_o{i}": c for i, c in enumerate(order)}
    dealt = saved(df.withColumns(cols).repartitionByRange(n, *cols).withColumn("_part", F.spark_partition_id()), name)
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*cols)) - 1
    return (dealt.withColumn("_at", within).join(F.broadcast(offsets), "_part")
            .withColumn(out, F.col("_off") + F.col("_at")).drop("_part", "_off", "_at", *cols))
