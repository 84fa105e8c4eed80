"""Ordered, chunked, incremental export.

Global numbering in key order without a single-task window:
  1. ``repartitionByRange(n, key)`` + ``sortWithinPartitions(key)``: partition i holds a
     key range below partition i+1, rows sorted inside;
  2. that result is materialised ONCE (persisted, or checkpointed to the shared folder).
     Both passes below must see the same partition boundaries, and a range exchange
     that is planned twice samples its bounds twice with different seeds;
  3. per partition its row count (a tiny aggregate) -> exclusive prefix sums (n rows);
  4. ``monotonically_increasing_id`` gives each row its partition index (high bits) and
     in-partition position (low 33 bits); row number = offset[partition] + position,
     via a join with the broadcast offsets (n rows: bounded by the partition count).
A lost executor recomputes lost cached blocks from the same lineage (same partitioner),
so numbering stays stable under failures.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickflow.config import EXPORT_CHUNK_SIZE
from clickflow.sources import commits, fs

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return int(n)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ordered_export(df: DataFrame, keys: Sequence[str] | str = "_id", num_partitions: int | None = None) -> DataFrame:
    """Rows in key order across partitions (range-partitioned, sorted within)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.repartitionByRange(_num_partitions(df, num_partitions), *keys).sortWithinPartitions(*keys)


def materialize_ranged(df: DataFrame, keys: Sequence[str], num_partitions: int | None = None,
                       mode: str = "persist") -> DataFrame:
    """Range-partition and sort by ``keys`` and materialise the result once.

    ``persist``: executor memory/disk with lineage (recomputed identically on loss);
    ``checkpoint``: reliable copy in the shared checkpoint folder (lineage cut)."""
    from pyspark import StorageLevel
    from clickflow.session import checkpoint_root
    ranged = df.repartitionByRange(_num_partitions(df, num_partitions), *keys).sortWithinPartitions(*keys)
    if mode == "checkpoint":
        checkpoint_root(df.sparkSession)
        return ranged.checkpoint(eager=True)
    return ranged.persist(StorageLevel.MEMORY_AND_DISK)


def _number(ranged: DataFrame, out: str) -> DataFrame:
    counts = (ranged.select(F.spark_partition_id().alias("_p"))
              .groupBy("_p").agg(F.count(F.lit(1)).alias("_n")))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_p", (F.sum("_n").over(w) - F.col("_n")).alias("_off"))
    numbered = (ranged.withColumn("_mid", F.monotonically_increasing_id())
                .withColumn("_p", F.shiftright("_mid", _POS_BITS).cast("int")))
    joined = numbered.join(F.broadcast(offsets), "_p")
    rn = F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_POS_MASK)) + F.lit(1)
    return joined.withColumn(out, rn).drop("_p", "_mid", "_off")


def row_numbers(df: DataFrame, keys: Sequence[str] | str, num_partitions: int | None = None,
                out: str = "row_number", mode: str = "persist") -> DataFrame:
    """1-based global row number in ``keys`` order (keys should be unique; ties are
    broken arbitrarily). The materialised ranged rows stay cached for the session; use
    ``numbered_rows`` to release them when done."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _number(materialize_ranged(df, keys, num_partitions, mode), out)


@contextmanager
def numbered_rows(df: DataFrame, keys: Sequence[str] | str, num_partitions: int | None = None,
                  out: str = "row_number", mode: str = "persist"):
    """``row_numbers`` whose cached range partitions are released on exit."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranged = materialize_ranged(df, keys, num_partitions, mode)
    try:
        yield _number(ranged, out)
    finally:
        ranged.unpersist()


def chunk_column(rn_col: str, size: int, start: int = 1):
    return (F.floor((F.col(rn_col) - 1) / F.lit(size)) + F.lit(start)).cast("int")


def assign_chunks(df: DataFrame, keys: Sequence[str] | str = "_id", size: int = EXPORT_CHUNK_SIZE,
                  start: int = 1, num_partitions: int | None = None, out: str = "part_number") -> DataFrame:
    """Part number per row: rows in key order, ``size`` per part, numbered from ``start``."""
    numbered = row_numbers(df, keys, num_partitions, out="_rn")
    return numbered.withColumn(out, chunk_column("_rn", size, start)).drop("_rn")


def rows_for_bytes(df: DataFrame, part_bytes: int) -> int:
    """Rows per part so that a part holds about ``part_bytes`` of text (rows as JSON), at least one
    (one aggregate, one row to the driver)."""
    row = df.select(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("b")).agg(F.avg("b").alias("b")).first()
    return max(1, int(part_bytes // max(1.0, row["b"] or 1.0)))


def chunk_manifest(df: DataFrame, key: str = "_id", part_col: str = "part_number") -> DataFrame:
    """Per part: row count and first/last key."""
    return (df.groupBy(part_col)
            .agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first_id"), F.max(key).alias("last_id")))


def export_parts(df: DataFrame, root: str, table: str, part_col: str = "part_number") -> str:
    """Write each part below ``root/<table>/part_number=<n>/``. Dynamic partition
    overwrite replaces exactly the parts present in ``df`` (a rerun of the same part
    replaces it, other parts stay)."""
    path = f"{root.rstrip('/')}/{table}".rstrip("/")
    # No repartition: rows are already range-partitioned by key, so each task writes
    # the few parts its key range covers (several files per part, no extra shuffle).
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col).parquet(path))
    return path


def _state_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/_state/{table}"


def load_state(spark: SparkSession, root: str, table: str) -> tuple[str | None, int]:
    """(last_id, part_number) saved for ``table``; (None, 0) when none exists: the highest complete
    commit (``sources.commits``)."""
    version, doc = commits.head(spark, _state_path(root, table))
    return (doc.get("last_id"), int(doc["part_number"])) if doc else (None, 0)


def write_state(spark: SparkSession, root: str, table: str, last_id, part_number: int, staged: str | None = None) -> None:
    """Commit the table's state, and with it the parts below ``staged``. The commit is exclusive: if
    another run has committed these parts, it fails with ``CommitConflict``."""
    commits.commit(spark, _state_path(root, table), int(part_number), {
        "table": table, "last_id": None if last_id is None else str(last_id), "part_number": int(part_number), "staged": staged})


def publish(spark: SparkSession, root: str, table: str) -> None:
    """Move the committed parts of the last run to their place below ``root/<table>``. Repeating it, also
    after a crash half-way, changes nothing."""
    _, doc = commits.head(spark, _state_path(root, table))
    staged = doc.get("staged") if doc else None
    if not staged or not fs.exists(spark, staged):
        return
    for part in sorted(n for n in fs.names(spark, staged) if n.startswith("part_number=")):
        place = f"{root.rstrip('/')}/{table}/{part}"
        fs.delete(spark, place)   # never committed: an older attempt's
        fs.rename(spark, f"{staged}/{part}", place)
    fs.delete(spark, staged)


def save_state(manifest: DataFrame, root: str, table: str) -> None:
    """Save the highest part and its last key, computed by Spark from the manifest (one
    row to the driver)."""
    row = manifest.agg(F.max_by("last_id", "part_number").alias("last_id"),
                       F.max("part_number").alias("part_number")).first()
    if row["part_number"] is not None:
        write_state(manifest.sparkSession, root, table, row["last_id"], row["part_number"])


def reset_state(spark: SparkSession, root: str, table: str) -> None:
    """Explicit state reset (the next export starts from part 1 over all rows)."""
    fs.delete(spark, _state_path(root, table))


def _identity(df: DataFrame, key: str):
    """What tells a row from the exported ones: its key, or all of it when the key is null."""
    whole = F.concat(F.lit("row:"), F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256))
    return F.coalesce(F.concat(F.lit("key:"), F.col(key).cast("string")), whole)


def not_exported(df: DataFrame, exported: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` that ``exported`` does not hold, by key (null keys: by the whole row)."""
    done = exported.select(*df.columns).select(_identity(df, key).alias("_done")).distinct()
    return df.join(done, _identity(df, key) == F.col("_done"), "left_anti")


def incremental_export(spark: SparkSession, df: DataFrame, root: str, table: str, key: str = "_id",
                       size: int = EXPORT_CHUNK_SIZE, force_string: Sequence[str] | None = None,
                       num_partitions: int | None = None, arrival_ordered: bool = True,
                       part_bytes: int | None = None) -> DataFrame:
    """Export the rows that earlier runs have not exported as new parts, then save the state. Parts have
    ``size`` rows, or about ``part_bytes`` if that is given (so that a large export is not cut into
    a folder per 250,000 narrow rows).

    ``arrival_ordered`` says that ``key`` grows with arrival (an object id): new rows then are
    those above the saved watermark, and rows with a null key, which no watermark can see,
    are compared with the exported ones. Keys that say nothing about arrival (a product id,
    an address) need ``arrival_ordered=False``: all rows are compared with the exported
    keys, so an id that sorts below the last one is not lost.

    Order of commits: the parts are written to a folder of this run, the state commit names it
    (exclusive: of two runs at once one fails before it has touched a part), then the parts move to their place.
    A crash before the commit leaves the state as it was, one after it is made good by the next run,
    which publishes first. Row count and last key of the slice come from one aggregate over the
    materialised range partitions (two scalars to the driver). Returns the manifest of the parts
    written by this run (read back from storage, lazily)."""
    from clickflow.config import FORCE_STRING_COLUMNS
    from clickflow.operators.events import slice_after
    from clickflow.operators.standardize import standardize

    publish(spark, root, table)
    last_id, last_part = load_state(spark, root, table)
    path = f"{root.rstrip('/')}/{table}"
    strings = FORCE_STRING_COLUMNS if force_string is None else force_string
    if last_part == 0:
        std = standardize(df, strings)
    else:
        exported = spark.read.option("mergeSchema", "true").parquet(path).where(F.col("part_number") <= F.lit(last_part))
        whole = standardize(df, strings)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in whole.schema.fields if f.name not in exported.columns]
        exported = exported.select("*", *missing)
        if arrival_ordered and last_id is not None:
            lost = not_exported(whole.where(F.col(key).isNull()), exported.where(F.col(key).isNull()), key)
            std = standardize(slice_after(df, key, last_id), strings).unionByName(lost)
        else:
            std = not_exported(whole, exported, key)
    ranged = materialize_ranged(std, [key], num_partitions)
    try:
        # fills the cache; the numbering and the write then read it
        summary = ranged.agg(F.count(F.lit(1)).alias("n"), F.max(key).alias("last_id")).first()
        n = int(summary["n"])
        if n > 0:
            size = rows_for_bytes(ranged, part_bytes) if part_bytes else size
            numbered = (_number(ranged, "_rn")
                        .withColumn("part_number", chunk_column("_rn", size, last_part + 1)).drop("_rn"))
            staged = f"{root.rstrip('/')}/_staged/{table}-{uuid.uuid4().hex[:12]}"
            export_parts(numbered, staged, "")
            top = summary["last_id"] if last_id is None or summary["last_id"] is None else max(str(summary["last_id"]), str(last_id))
            write_state(spark, root, table, last_id if top is None else top, last_part + -(-n // size), staged)
            publish(spark, root, table)
    finally:
        ranged.unpersist()
    if n == 0:
        return spark.createDataFrame([], "part_number int, rows bigint, first_id string, last_id string")
    written = spark.read.parquet(path).where(F.col("part_number") > F.lit(last_part))
    return chunk_manifest(written, key)

