"""Event-driven load: each new Parquet part of a table is staged as a micro-batch and
loaded into the warehouse table (create on first load, else insert-only merge).

One streaming query per target table, so two first loads of one table cannot race.
The file source tracks which parts were seen in its checkpoint; ``foreachBatch``
failures fail the batch and it is replayed, which the insert-only merge absorbs for
keyed rows."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickflow.functions.paths import part_table_name
from clickflow.sources import fs
from clickflow.operators.warehouse import HeldKeys, load_part


#: Bytes of part files in one micro-batch, unless the caller says otherwise.
MAX_BATCH_BYTES = 32 << 30


def stream_parts(spark: SparkSession, root: str, table: str, schema: T.StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """New ``*.parquet`` files below ``root/<table>`` as a stream of rows, with the source file
    path and the table name derived from it. The schema is fixed while the query runs;
    ``stream_part_files`` is for parts that may bring new columns."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.parquet(f"{root.rstrip('/')}/{table}")
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def stream_part_files(spark: SparkSession, root: str, table: str, max_files_per_trigger: int | None = None,
                      max_bytes_per_trigger: int | None = MAX_BATCH_BYTES) -> DataFrame:
    """The names (path, length) of new ``*.parquet`` files below ``root/<table>`` as a stream; the files
    themselves are not read. A batch holds files of about ``max_bytes_per_trigger``, or a number of files if that is
    given instead (the source takes one limit), and one file at least."""
    limit = {"maxFilesPerTrigger": str(max_files_per_trigger)} if max_files_per_trigger else \
        {"maxBytesPerTrigger": str(max_bytes_per_trigger)} if max_bytes_per_trigger else {}
    schema = "path string, modificationTime timestamp, length long, content binary"
    return (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.parquet").options(**limit)
            .load(f"{root.rstrip('/')}/{table}").select("path", "length"))


@contextmanager
def listing_tasks(spark: SparkSession):
    """Within it, many folders or files are listed by as many tasks as run at once; by default a job has a task for
    each, up to 10,000. The batches of a stream that is started in it keep the setting, the stream's own listings
    have it as long as the block lasts."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def batch_loader(target: str, target_path: str, key: str = "_id", marker_root: str | None = None,
                 drop_cols: tuple[str, ...] = ("part_number",), loaded: dict[int, int] | None = None, keep: bool = True):
    """The ``foreachBatch`` body: create or insert-only merge the batch into ``target``.

    With ``marker_root`` a batch id is recorded after its rows are committed and a batch
    seen again (a replay after a failure) is skipped, so even rows without a key land
    exactly once. ``loaded`` receives the input rows of each batch, counted from the batch. Keys are looked up in the
    target only where a part file (``_source_file``) overlaps the key ranges loaded so far. ``keep``: the batch is
    persisted while it is loaded (not needed where its columns can be read from Parquet one by one)."""
    held = HeldKeys()

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marker = f"{marker_root.rstrip('/')}/{batch_id}" if marker_root else None
        if marker is not None and fs.exists(spark, marker):
            return
        # The batch is read twice (keys, then rows): keep it for the batch only.
        rows = batch.drop(*[c for c in drop_cols if c in batch.columns])
        rows = rows.persist() if keep else rows
        try:
            by = ["_source_file"] if "_source_file" in rows.columns else []
            ends = [F.min(key).alias("lo"), F.max(key).alias("hi")] if key in rows.columns else []
            files = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *ends).collect()   # one row per file of the batch
            if loaded is not None:
                loaded[batch_id] = sum(f["rows"] for f in files)
            spans = [(f["lo"], f["hi"]) for f in files if f["lo"] is not None] if ends else None
            load_part(rows.drop("_source_file"), target, target_path, key, spans=spans, held=held)
        finally:
            if keep:
                rows.unpersist()
        if marker is not None:
            fs.touch(spark, marker)

    return body


def file_batch_loader(root: str, table: str, target: str, target_path: str, key: str = "_id", marker_root: str | None = None,
                      drop_cols: tuple[str, ...] = ("part_number",), loaded: dict[int, int] | None = None):
    """The ``foreachBatch`` body for ``stream_part_files``: the files of the batch are read by their names
    with the merged schema of this batch, so a column that first appears in it is loaded
    (and added to ``target``) without a restart. Files that have gone since are passed over.
    The batch bounds the list of names."""
    body = batch_loader(target, target_path, key, marker_root, drop_cols, loaded, keep=False)

    def read(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        paths = sorted({r["path"] for r in batch.select("path").collect()})
        reader = spark.read.option("mergeSchema", "true").option("basePath", f"{root.rstrip('/')}/{table}")
        try:
            rows = reader.parquet(*paths) if paths else None
        except AnalysisException as ex:
            if ex.getCondition() != "PATH_NOT_FOUND":
                raise
            paths = [p for p in paths if fs.exists(spark, p)]
            rows = reader.parquet(*paths) if paths else None
        if rows is not None:
            body(rows.withColumn("_source_file", F.input_file_name()), batch_id)

    return read


def start_part_load(spark: SparkSession, root: str, table: str, target: str, target_path: str,
                    checkpoint: str, key: str = "_id", schema: T.StructType | None = None,
                    drop_cols: tuple[str, ...] = ("part_number",), available_now: bool = True,
                    max_files_per_trigger: int | None = None,
                    trigger_interval: str = "10 seconds", loaded: dict[int, int] | None = None,
                    max_bytes_per_trigger: int | None = MAX_BATCH_BYTES) -> StreamingQuery:
    """Start the load stream for one table: a stream of file names whose batches (bounded by bytes) are read
    with their own schema, so parts may bring new columns while the query runs. With ``schema`` every part is
    read with it instead; give it, or start later, where no part exists yet. Committed batch ids
    are recorded under the checkpoint folder, so a replayed batch is not loaded twice."""
    markers = f"{checkpoint.rstrip('/')}/_loaded_batches"
    if schema is None and not fs.exists(spark, f"{root.rstrip('/')}/{table}"):
        raise ValueError(f"no parts under {root}/{table} yet: pass the part schema explicitly")
    with listing_tasks(spark):
        if schema is not None:
            src = stream_parts(spark, root, table, schema, max_files_per_trigger)
            body = batch_loader(target, target_path, key, markers, drop_cols, loaded)
        else:
            src = stream_part_files(spark, root, table, max_files_per_trigger, max_bytes_per_trigger)
            body = file_batch_loader(root, table, target, target_path, key, markers, drop_cols, loaded)
        writer = src.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger_interval)
        return writer.start()


def part_files(df_with_path: DataFrame, path_col: str = "_source_file") -> DataFrame:
    """Per source file: table name from the path and row count."""
    return (df_with_path.groupBy(path_col)
            .agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("table_name", part_table_name(F.col(path_col))))


def load_available(spark: SparkSession, root: str, table: str, target: str, target_path: str,
                   checkpoint: str, key: str = "_id", max_files_per_trigger: int | None = None) -> int:
    """Load every part present now (``availableNow``), wait for it, fail on a batch
    error, and refresh the target in the calling session (batches run on a cloned
    session whose table cache is separate). Returns the number of input rows."""
    loaded: dict[int, int] = {}
    with listing_tasks(spark):
        q = start_part_load(spark, root, table, target, target_path, checkpoint, key,
                            max_files_per_trigger=max_files_per_trigger, loaded=loaded)
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"part load failed: {q.exception()}")
    if spark.catalog.tableExists(target):
        spark.catalog.refreshTable(target)
    return sum(loaded.values())


def load_available_tables(spark: SparkSession, root: str, tables: dict[str, str], target_root: str,
                          checkpoint_root: str, max_files_per_trigger: int | None = None) -> dict[str, int]:
    """Event-driven load for several tables: one stream per target table (so two first
    loads of one table cannot race), each with its own checkpoint. ``tables`` maps a
    table name to its key. Returns input rows per table."""
    out = {}
    for table, key in tables.items():
        out[table] = load_available(spark, root, table, table, f"{target_root.rstrip('/')}/{table}",
                                    f"{checkpoint_root.rstrip('/')}/{table}", key, max_files_per_trigger)
    return out
