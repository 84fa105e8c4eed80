"""Event-driven load: stream of arriving parts -> create, then insert-only merge."""

import uuid

from pyspark.sql import functions as F

from clickflow.operators import export as ex
from clickflow.session import work_path
from clickflow.streaming.load import load_available
from conftest import rows


def _run(spark, root, target, tpath, ckpt):
    return load_available(spark, root, "ev", target, tpath, ckpt, max_files_per_trigger=2)


def test_stream_load_matches_batch_and_resumes(spark):
    root = work_path(spark, "t-stream")
    df = spark.createDataFrame([(f"{i:05d}", i % 7, f"n{i}") for i in range(300)], "_id string, g int, name string")
    first = df.where(F.col("_id") < "00200")
    ex.export_parts(ex.assign_chunks(first, "_id", 50), root, "ev")
    target = f"t_stream_{uuid.uuid4().hex[:8]}"
    tpath, ckpt = work_path(spark, target), work_path(spark, target + "_ckpt")
    assert _run(spark, root, target, tpath, ckpt) == 200
    assert rows(spark.table(target)) == rows(first)
    # new parts arrive (and one old part is re-delivered as a new file): only new keys land
    rest = ex.assign_chunks(df, "_id", 50, start=1).where(F.col("part_number") >= 4)
    ex.export_parts(rest, root, "ev")
    assert _run(spark, root, target, tpath, ckpt) == 150     # re-delivered part 4 + parts 5, 6
    assert rows(spark.table(target)) == rows(df)
    assert _run(spark, root, target, tpath, ckpt) == 0       # nothing new: nothing read
    assert spark.table(target).select("_id").distinct().count() == 300



def test_replayed_batch_is_loaded_once(spark):
    from clickflow.streaming.load import batch_loader
    target = f"t_replay_{uuid.uuid4().hex[:8]}"
    body = batch_loader(target, work_path(spark, target), "_id", work_path(spark, target + "_markers"))
    b0 = spark.createDataFrame([("a", 1), (None, 2)], "_id string, v int")
    b1 = spark.createDataFrame([("b", 3), (None, 4)], "_id string, v int")
    body(b0, 0)
    body(b1, 1)
    body(b1, 1)                                   # replay after a failure
    spark.catalog.refreshTable(target)
    assert spark.table(target).count() == 4
    assert spark.table(target).where("_id is null").count() == 2



def test_multi_table_load(spark):
    from clickflow.plans.multi_table import export_tables
    from clickflow.streaming.load import load_available_tables
    root = work_path(spark, "t-multi")
    a = spark.createDataFrame([(f"{i:04d}", i) for i in range(120)], "_id string, v int")
    b = spark.createDataFrame([(f"p{i:03d}", f"n{i}") for i in range(40)], "product_id string, product_name string")
    sfx = uuid.uuid4().hex[:6]
    export_tables(spark, {f"ev_{sfx}": (a, "_id"), f"pn_{sfx}": (b, "product_id")}, root, size=50)
    got = load_available_tables(spark, root, {f"ev_{sfx}": "_id", f"pn_{sfx}": "product_id"},
                                work_path(spark, "t-multi-wh"), work_path(spark, "t-multi-ck"))
    assert got == {f"ev_{sfx}": 120, f"pn_{sfx}": 40}
    assert rows(spark.table(f"pn_{sfx}")) == rows(b)


def test_continuous_trigger_picks_up_new_parts(spark):
    from clickflow.streaming.load import start_part_load
    root = work_path(spark, "t-cont")
    df = spark.createDataFrame([(f"{i:04d}", i) for i in range(90)], "_id string, v int")
    ex.export_parts(ex.assign_chunks(df.where(F.col("v") < 40), "_id", 20), root, "ev")
    target = f"t_cont_{uuid.uuid4().hex[:8]}"
    q = start_part_load(spark, root, "ev", target, work_path(spark, target), work_path(spark, target + "_ck"),
                        available_now=False, trigger_interval="1 second")
    try:
        q.processAllAvailable()
        ex.export_parts(ex.assign_chunks(df, "_id", 20).where(F.col("part_number") >= 3), root, "ev")
        q.processAllAvailable()
    finally:
        q.stop()
    spark.catalog.refreshTable(target)
    assert rows(spark.table(target)) == rows(df)


def _looks(monkeypatch):
    """The key ranges of the target that the loads look at, one entry per merge."""
    from clickflow.operators import warehouse as wh
    seen, merge = [], wh.merge_insert_only
    monkeypatch.setattr(wh, "merge_insert_only", lambda *a, **k: seen.append(k.get("between")) or merge(*a, **k))
    return seen


def test_batches_of_new_key_ranges_do_not_read_the_target(spark, monkeypatch):
    seen = _looks(monkeypatch)
    root = work_path(spark, "t-ranges")
    df = spark.createDataFrame([(f"{i:05d}", i) for i in range(400)], "_id string, v int")
    # parts of 20 rows written by 4 tasks, so the batches' whole ranges overlap, the parts' do not
    ex.export_parts(ex.assign_chunks(df, "_id", 20, num_partitions=4), root, "ev")
    target = f"t_ranges_{uuid.uuid4().hex[:8]}"
    tpath, ckpt = work_path(spark, target), work_path(spark, target + "_ck")
    assert _run(spark, root, target, tpath, ckpt) == 400
    assert rows(spark.table(target)) == rows(df)
    assert seen == []
    # a part is delivered again together with a new one, in a run that has to learn the target's range
    again = spark.createDataFrame([("00010", -1), ("00399", -1), ("00400", 400)], "_id string, v int")
    ex.export_parts(again.coalesce(1).withColumn("part_number", F.lit(99)), root, "ev")
    assert _run(spark, root, target, tpath, ckpt) == 3
    assert seen == [("00010", "00399")]
    assert rows(spark.table(target)) == rows(df) + [("00400", 400)]
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"


def test_only_shared_ranges_are_looked_up_and_other_writers_are_seen(spark, monkeypatch):
    from clickflow.operators import warehouse as wh
    from clickflow.streaming.load import batch_loader
    seen = _looks(monkeypatch)
    target = f"t_held_{uuid.uuid4().hex[:8]}"
    body = batch_loader(target, work_path(spark, target))

    def part(*keys):
        return spark.createDataFrame([(k, f"/p{i}", 1) for i, ks in enumerate(keys) for k in ks], "_id string, _source_file string, v int")

    body(part("ac", "gi"), 0)                          # ranges a-c and g-i
    body(part("df", [None, None], "kk"), 1)            # between and beside them; null keys are always new
    assert seen == []
    body(part("ce", "xz"), 2)                          # c-e meets a-c and d-f: c is known, e is new
    assert seen == [("c", "e")]
    other = spark.createDataFrame([("q", 7)], "_id string, v int")
    wh.append_rows(other, target)
    body(part("q", "r"), 3)                            # q came from another writer
    assert len(seen) == 2
    body(part("s"), 4)                                 # s meets x-z's whole range, read anew: looked up, not found
    assert rows(spark.table(target).select("_id")) == rows(spark.createDataFrame(
        [(k,) for k in "acgidfkkexzqrs"] + [(None,), (None,)], "_id string"))


def test_keys_of_other_types_are_looked_up_as_before(spark, monkeypatch):
    from clickflow.streaming.load import batch_loader
    seen = _looks(monkeypatch)
    target = f"t_kinds_{uuid.uuid4().hex[:8]}"
    body = batch_loader(target, work_path(spark, target))
    body(spark.createDataFrame([(1.0, 1), (2.0, 1)], "_id double, v int"), 0)
    body(spark.createDataFrame([(2.0, 2), (3.0, 2)], "_id double, v int"), 1)
    assert seen == [None]
    assert rows(spark.table(target)) == [(1.0, 1), (2.0, 1), (3.0, 2)]


def test_vanished_parts_are_passed_over(spark):
    from clickflow.streaming.load import file_batch_loader
    root = work_path(spark, "t-gone")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "_id string, v int")
    ex.export_parts(df.withColumn("part_number", F.col("v")), root, "ev")
    names = [r[0] for r in spark.read.parquet(f"{root}/ev").select("_metadata.file_path").distinct().collect()]
    target = f"t_gone_{uuid.uuid4().hex[:8]}"
    body = file_batch_loader(root, "ev", target, work_path(spark, target))
    body(spark.createDataFrame([(n,) for n in names + names + [f"{root}/ev/part_number=9/gone.parquet"]], "path string"), 0)
    assert rows(spark.table(target)) == rows(df)
    body(spark.createDataFrame([(f"{root}/ev/part_number=9/gone.parquet",)], "path string"), 1)
    assert rows(spark.table(target)) == rows(df)
