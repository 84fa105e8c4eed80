"""Warehouse loading: schema alignment, insert-only merge, first load, full load.

Tables are catalog tables stored as Parquet at explicit locations (under the shared
checkpoint folder when the caller gives none). Delta/Iceberg are not on the classpath,
so MERGE is expressed as an anti-join plus an append."""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.sources import commits, fs

_SIMPLE = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def align_to(df: DataFrame, schema: T.StructType, mode: str = "lenient") -> tuple[DataFrame, list[str]]:
    """Same columns, order and types as ``schema``; missing columns are null, extra columns
    are dropped and reported. ``lenient``: a value that does not fit becomes null
    (``nulled_values`` counts them). ``strict``: it fails the load."""
    if mode not in ("lenient", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    src = {f.name: f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name not in src:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{f.name}`")
        have = src[f.name].dataType
        if have == f.dataType:
            cols.append(c)
        elif isinstance(f.dataType, _SIMPLE) and isinstance(have, _SIMPLE):
            fits = c.try_cast(f.dataType)
            if mode == "strict":
                bad = F.concat(F.lit(f"column {f.name}: value does not fit {f.dataType.simpleString()}: "), c.cast("string"))
                fits = F.when(c.isNotNull() & fits.isNull(), F.raise_error(bad).cast(f.dataType)).otherwise(fits)
            cols.append(fits.alias(f.name))
        else:
            cols.append(c.cast(f.dataType).alias(f.name))
    lost = [n for n in df.columns if n not in set(schema.fieldNames())]
    return df.select(*cols), lost


def nulled_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column of both ``df`` and ``schema``: values that lenient alignment turns into null."""
    src = {f.name: f.dataType for f in df.schema.fields}
    lost = [F.count(F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(), 1)).alias(f.name)
            for f in schema.fields if isinstance(f.dataType, _SIMPLE) and isinstance(src.get(f.name), _SIMPLE) and src[f.name] != f.dataType]
    return df.agg(*lost) if lost else df.limit(0).select()


def merge_insert_only(target: DataFrame, source: DataFrame, key: str = "_id",
                      source_is_bounded: bool | None = None, dedupe_source: bool = False,
                      prune_target: bool = False, between: tuple | None = None) -> DataFrame:
    """Rows of ``source`` to append: those whose key is absent from ``target``. Matched
    rows are left alone (never updated); null keys are always inserted; duplicates inside
    the source are all inserted unless ``dedupe_source``.

    Plan: the target's key column is semi-joined with the source keys first, so a large
    target is scanned (one column) but never shuffled when the source is small; the
    source is then anti-joined with the few matched keys. ``source_is_bounded`` states
    that the source is one export part (size known), which makes its keys safe to
    broadcast. ``None`` (default) checks it: the source keys are counted and broadcast
    only when they fit the budget; beyond it the joins shuffle (sort-merge).

    ``prune_target`` bounds the target scan by the source's key range (two scalars from
    one small aggregate): parts arrive in key order, so the filter reaches the Parquet
    scan and row-group statistics skip nearly all of a target written in key order. ``between``
    (first and last key) bounds it where the caller knows that no other key of the source is in the target."""
    if dedupe_source:
        source = source.dropDuplicates([key])
    skeys = source.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull())
    # measured whatever the caller says: a wrong promise must not broadcast a large side
    from clickflow.config import BROADCAST_LIMIT_BYTES, ID_BYTES
    ends = [F.min("_k").alias("lo"), F.max("_k").alias("hi")] if prune_target and between is None else []
    seen = skeys.agg(F.sum(F.octet_length(F.col("_k").cast("string")) + ID_BYTES).alias("size"), *ends).first()
    size = seen["size"] or 0
    if ends and seen["lo"] is not None:
        between = seen["lo"], seen["hi"]
    if between is not None:
        target = target.where(F.col(key).between(F.lit(between[0]), F.lit(between[1])))
    source_is_bounded = source_is_bounded is not False and size <= BROADCAST_LIMIT_BYTES
    if source_is_bounded:
        skeys = F.broadcast(skeys)
    tkeys = target.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull())
    # distinct: a key repeated in the target collapses map-side, so the matched set is
    # bounded by the source's distinct keys
    matched = tkeys.join(skeys, "_k", "left_semi").distinct()
    if source_is_bounded:
        return source.join(F.broadcast(matched), source[key] == matched["_k"], "left_anti")
    # null keys are inserted in any case: past the shuffle, or they would meet in one task
    keyed = source.where(F.col(key).isNotNull()).join(matched, F.col(key) == matched["_k"], "left_anti")
    return keyed.unionByName(source.where(F.col(key).isNull()))


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def create_from(df: DataFrame, table: str, path: str) -> bool:
    """First load: create ``table`` at ``path`` from the staged rows when it does not
    exist (schema taken from the rows). Returns True when it created the table."""
    spark = df.sparkSession
    if table_exists(spark, table):
        return False
    df.write.format("parquet").option("path", path).saveAsTable(table)
    return True


def append_rows(df: DataFrame, table: str) -> None:
    """Append rows already aligned to the table's column order, then refresh the
    table's cached file listing so every reader in the session sees the new files."""
    df.write.insertInto(table, overwrite=False)
    df.sparkSession.catalog.refreshTable(table)


def _table_state(spark: SparkSession, table: str) -> tuple:
    """What changes with every write to a table: its folder, and the folder's files, bytes and time of change."""
    path = table_path(spark, table)
    return path, *fs.usage(spark, path)


class HeldKeys:
    """The key ranges that a target table holds, as far as the one loader that fills it knows. A batch whose
    ranges meet none of them has new keys only, so it needs no look at the target, however large
    that is. The ranges hold for the files that were there after the loader's last write: if the table has other
    files now (another writer's, or none seen yet), its whole key range is read from it."""

    #: Key types that Python orders as Spark does.
    KINDS = (T.StringType(), T.LongType(), T.IntegerType())

    def __init__(self) -> None:
        self._starts: list = []
        self._ends: list = []
        self._files: tuple | None = None

    def _around(self, lo, hi) -> tuple[int, int]:
        """The slice of the ranges that meet [lo, hi]."""
        return bisect_left(self._ends, lo), bisect_right(self._starts, hi)

    def _add(self, lo, hi) -> None:
        i, j = self._around(lo, hi)
        if i < j:
            lo, hi = min(lo, self._starts[i]), max(hi, self._ends[j - 1])
        self._starts[i:j], self._ends[i:j] = [lo], [hi]

    def meets(self, table: str, target: DataFrame, key: str, spans: Sequence[tuple]) -> tuple | None:
        """First and last key that ``spans`` (first and last key each) can have in common with the target; None: no key."""
        now = _table_state(target.sparkSession, table)
        if now != self._files:
            self._starts, self._ends = [], []
            row = target.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
            if row["lo"] is not None:
                self._add(row["lo"], row["hi"])
            self._files = now
        found = [(max(lo, self._starts[i]), min(hi, self._ends[j - 1])) for lo, hi in spans
                 for i, j in [self._around(lo, hi)] if i < j]
        return (min(lo for lo, _ in found), max(hi for _, hi in found)) if found else None

    def loaded(self, spark: SparkSession, table: str, spans: Sequence[tuple]) -> None:
        """The rows of ``spans`` are in the target now, by this loader's write."""
        for lo, hi in spans:
            self._add(lo, hi)
        self._files = _table_state(spark, table)


def load_part(batch: DataFrame, table: str, path: str, key: str = "_id",
              source_is_bounded: bool | None = None, prune_target: bool = True, mode: str = "strict",
              spans: Sequence[tuple] | None = None, held: HeldKeys | None = None) -> str:
    """One arriving part: create the target from it, or align it to the target's schema
    and insert the rows whose key is new. Columns that the target lacks are added to it; with
    the default mode a value that does not fit fails the load (so that it can be retried).
    With ``spans`` (key ranges that hold all keys of the batch) and the loader's ``held`` the target is read only where
    it can have keys of the batch. Returns 'created' or 'merged'."""
    spark = batch.sparkSession
    kind = batch.schema[key].dataType if key in batch.columns else None
    ranged = spans is not None and held is not None and kind in HeldKeys.KINDS
    if create_from(batch, table, path):
        if ranged:
            held.loaded(spark, table, spans)
        return "created"
    spark.catalog.refreshTable(table)   # parts may have landed from another writer
    known = set(spark.table(table).columns)
    fresh = [f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields if f.name not in known]
    if fresh:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(fresh)})")
    target = spark.table(table)
    aligned, _none = align_to(batch, target.schema, mode)
    ranged = ranged and target.schema[key].dataType == kind
    between = held.meets(table, target, key, spans) if ranged else None
    if ranged and between is None:
        new = aligned
    else:
        new = merge_insert_only(target, aligned, key, source_is_bounded=source_is_bounded,
                                prune_target=prune_target, between=between)
    append_rows(new, table)
    if ranged:
        held.loaded(spark, table, spans)
    return "merged"


def _versions(location: str) -> str:
    return f"{location.rstrip('/')}/_versions"


def replace_table(spark: SparkSession, table: str, path: str) -> None:
    """Let ``table`` stand for the Parquet files at ``path``. A table of the same columns, or with
    columns missing at its end, is switched in place, so it is there all the time. Otherwise it is
    dropped and made anew (``sync_table`` makes good a crash between the two)."""
    if table_exists(spark, table):
        have, want = spark.table(table).schema.fields, spark.read.parquet(path).schema.fields
        kept = [(f.name, f.dataType) for f in want[:len(have)]] == [(f.name, f.dataType) for f in have]
        if kept:
            fresh = [f"`{f.name}` {f.dataType.simpleString()}" for f in want[len(have):]]
            if fresh:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(fresh)})")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")   # external: drops the name, not the files
    spark.catalog.createTable(table, path, "parquet")


def table_path(spark: SparkSession, table: str) -> str | None:
    """The folder that a table stands for, None when there is no such table."""
    if not table_exists(spark, table):
        return None
    rows = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location"]   # no job
    return rows[0]["data_type"] if rows else None


def sync_table(spark: SparkSession, table: str, location: str) -> bool:
    """Let the table stand for the last committed version below ``location``: what a load that was
    cut off between its commit and the switch has left undone. Returns whether it changed the table."""
    _, doc = commits.head(spark, _versions(location))
    if not doc:
        return False
    now = table_path(spark, table)
    if now is not None and now.rstrip("/").endswith(doc["path"].rstrip("/").removeprefix("file:").lstrip("/")):
        return False
    replace_table(spark, table, doc["path"])
    return True


def drop_old_versions(spark: SparkSession, location: str, keep: int = 2) -> list[str]:
    """Delete the files of all versions but the last ``keep`` committed ones, and of loads that
    were never committed. For the owner of the table, when no reader holds an older version."""
    docs = [commits.read(spark, _versions(location), v) for v in commits.versions(spark, _versions(location))]
    held = [d["path"].rsplit("/", 1)[-1] for d in docs if d][-keep:]
    gone = [n for n in fs.names(spark, location) if n.startswith("version-") and n not in held]
    for n in gone:
        fs.delete(spark, f"{location.rstrip('/')}/{n}")
    return gone


def load_full(spark: SparkSession, root: str, tables: Sequence[str], locations: dict[str, str],
              names: dict[str, str] | None = None) -> DataFrame:
    """Truncate-and-load each table from all its parts below ``root/<table>`` (columns of all
    parts, without the part number). The rows are written to a new version below the table's
    location; the version is committed (exclusive: of two loads at once one fails), then the table is
    switched to it. A load that fails or is cut off before the commit leaves the table as it was, one that is
    cut off after it is made good by the next load or by ``sync_table``. A failing table is
    reported and does not stop the others. Returns (table_name, status, rows, error) -- one row per table."""
    from clickflow.sources.tables import read_parts
    names = names or {}
    report = []
    from pyspark.sql import Observation
    for t in tables:
        target = names.get(t, t)
        try:
            sync_table(spark, target, locations[t])
            last, _ = commits.head(spark, _versions(locations[t]))
            obs = Observation(f"load_{t}")
            parts = read_parts(spark, root, t).drop("part_number").observe(obs, F.count(F.lit(1)).alias("rows"))
            version = f"{locations[t].rstrip('/')}/version-{uuid.uuid4().hex[:12]}"
            parts.write.parquet(version)
            rows = int(obs.get["rows"])   # counted on the write itself
            commits.commit(spark, _versions(locations[t]), last + 1, {"path": version, "rows": rows})
            replace_table(spark, target, version)
            report.append((t, "loaded", rows, None))
        except Exception as ex:  # noqa: BLE001 - one table's failure must not stop the rest
            report.append((t, "failed", None, f"{type(ex).__name__}: {ex}"))
    return spark.createDataFrame(report, "table_name string, status string, rows bigint, error string")


def row_count(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).agg(F.count(F.lit(1)).alias("rows"))
