"""Parts that arrive while things run: new columns in a running stream, bounded batches, stored sketches,
exports and loads that are cut off or run at once, samples, prefix scans."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from clickflow.operators import export as ex
from clickflow.operators import part_profile as pp
from clickflow.operators import profile as pf
from clickflow.operators import reports as rep
from clickflow.operators import standardize as st
from clickflow.operators import warehouse as wh
from clickflow.session import work_path
from clickflow.sources import commits, fs
from clickflow.streaming.load import load_available, start_part_load
from conftest import plan_text, rows, srt


class Killed(Exception):
    pass


def _part(spark, root, n, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{root}/ev/part_number={n}")


def test_a_running_stream_stores_a_new_column(spark):
    root, target = work_path(spark, "t-new-col"), f"t_newcol_{uuid.uuid4().hex[:8]}"
    _part(spark, root, 1, [("a", 1), ("b", 2)], "_id string, v int")
    q = start_part_load(spark, root, "ev", target, work_path(spark, target), work_path(spark, target + "_ck"), available_now=False, trigger_interval="1 second")
    try:
        q.processAllAvailable()
        _part(spark, root, 2, [("c", 3, "new")], "_id string, v int, later string")
        q.processAllAvailable()
        _part(spark, root, 3, [("b", 9, "old"), ("d", 4, None)], "_id string, v int, later string")   # b comes again
        q.processAllAvailable()
    finally:
        q.stop()
    spark.catalog.refreshTable(target)
    assert rows(spark.table(target), "_id", "v", "later") == srt([("a", 1, None), ("b", 2, None), ("c", 3, "new"), ("d", 4, None)])


def test_batches_are_bounded_by_bytes(spark):
    root, target = work_path(spark, "t-bytes"), f"t_bytes_{uuid.uuid4().hex[:8]}"
    for n in range(6):
        _part(spark, root, n, [(f"{n}-{i}", "x" * 50) for i in range(40)], "_id string, v string")
    size = os.path.getsize(next(os.path.join(d, f) for d, _, names in os.walk(root.removeprefix("file:")) for f in names if f.endswith(".parquet")))
    loaded = {}
    q = start_part_load(spark, root, "ev", target, work_path(spark, target), work_path(spark, target + "_ck"), max_bytes_per_trigger=2 * size + size // 2, loaded=loaded)
    q.awaitTermination()
    assert q.exception() is None and sum(loaded.values()) == 240 and max(loaded.values()) <= 80 and len(loaded) >= 3
    spark.catalog.refreshTable(target)
    assert spark.table(target).count() == 240


def test_a_part_delivered_twice_is_stored_once(spark):
    root, target = work_path(spark, "t-twice"), f"t_twice_{uuid.uuid4().hex[:8]}"
    place, ck = work_path(spark, target), work_path(spark, target + "_ck")
    for n in (1, 2):
        _part(spark, root, n, [("a", 1), ("b", 2)], "_id string, v int")
        load_available(spark, root, "ev", target, place, ck)
    assert rows(spark.table(target)) == [("a", 1), ("b", 2)]


def _keyed(spark, ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "_id string, name string")


FIRST, ALL = [f"{i:03d}" for i in range(25)], [f"{i:03d}" for i in range(60)]


@pytest.mark.parametrize("step,after", [("export_parts", False), ("export_parts", True), ("write_state", False), ("write_state", True),
                                        ("publish", False), ("rename", False), ("rename", True), ("publish", True)])
def test_export_survives_a_kill_between_any_two_steps(spark, monkeypatch, step, after):
    root = work_path(spark, "t-cut")
    ex.incremental_export(spark, _keyed(spark, FIRST), root, "t", size=10)
    with monkeypatch.context() as m:
        owner = ex.fs if step == "rename" else ex
        real, calls = getattr(owner, step), []

        def cut(*a, **k):
            calls.append(1)
            if step == "publish" and len(calls) == 1:     # the one at the start of a run
                return real(*a, **k)
            if after:
                real(*a, **k)
            raise Killed
        m.setattr(owner, step, cut)
        with pytest.raises(Killed):
            ex.incremental_export(spark, _keyed(spark, ALL), root, "t", size=10)
    ex.incremental_export(spark, _keyed(spark, ALL), root, "t", size=10)
    got = spark.read.parquet(f"{root}/t")
    assert rows(got, "_id") == [(i,) for i in ALL]
    assert sorted(r["count"] for r in got.groupBy("part_number").count().collect()) == [5, 5, 10, 10, 10, 10, 10]
    assert ex.load_state(spark, root, "t") == ("059", 7)
    if step in ("publish", "rename") or (step, after) == ("write_state", True):    # it was committed: nothing stays staged
        assert not fs.names(spark, f"{root}/_staged")


def test_two_exports_at_once(spark, monkeypatch):
    """The run that commits second fails before it has touched a part of the other."""
    root = work_path(spark, "t-both")
    real = ex.export_parts
    inside = []

    def overtaken(*a, **k):
        real(*a, **k)
        if not inside:
            inside.append(1)
            ex.incremental_export(spark, _keyed(spark, ALL), root, "t", size=10)
    monkeypatch.setattr(ex, "export_parts", overtaken)
    with pytest.raises(commits.CommitConflict):
        ex.incremental_export(spark, _keyed(spark, FIRST), root, "t", size=10)
    monkeypatch.undo()
    assert rows(spark.read.parquet(f"{root}/t"), "_id") == [(i,) for i in ALL]
    assert ex.incremental_export(spark, _keyed(spark, ALL), root, "t", size=10).count() == 0


def _load(spark, root, place, name):
    return wh.load_full(spark, root, ["t"], {"t": place}, {"t": name}).first()["status"]


@pytest.mark.parametrize("columns", ["same", "more", "others"])
@pytest.mark.parametrize("step", ["commit", "replace_table", "inside"])
def test_reload_survives_a_kill_between_any_two_steps(spark, monkeypatch, step, columns):
    root, place, name = work_path(spark, "t-rl"), work_path(spark, "t-rl-place"), f"t_rl_{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([("1", 1)], "_id string, a int").write.parquet(f"{root}/t/part_number=1")
    assert _load(spark, root, place, name) == "loaded"
    if columns == "others":
        fs.delete(spark, f"{root}/t/part_number=1")
    new = {"same": [("2", 2)], "more": [("2", 2, "x")], "others": [(5, "2")]}[columns]
    spark.createDataFrame(new, {"same": "_id string, a int", "more": "_id string, a int, b string", "others": "c int, _id string"}[columns]) \
        .write.parquet(f"{root}/t/part_number=2")
    want = 1 if columns == "others" else 2
    with monkeypatch.context() as m:
        if step == "inside":      # after the drop, or after the switch
            real = spark.catalog.createTable if columns == "others" else spark.catalog.refreshTable
            m.setattr(type(spark.catalog), real.__name__, lambda *a, **k: (_ for _ in ()).throw(Killed()))
        else:
            m.setattr(wh.commits if step == "commit" else wh, step, lambda *a, **k: (_ for _ in ()).throw(Killed()))
        assert _load(spark, root, place, name) == "failed"
    if step != "commit":
        wh.sync_table(spark, name, place)
        spark.catalog.refreshTable(name)
        assert spark.table(name).count() == want
    else:
        assert spark.table(name).count() == 1
    assert _load(spark, root, place, name) == "loaded" and spark.table(name).count() == want
    assert wh.sync_table(spark, name, place) is False
    assert len(wh.drop_old_versions(spark, place, keep=1)) >= 1 and spark.table(name).count() == want
    spark.sql(f"DROP TABLE {name}")


def test_two_reloads_at_once_conflict(spark, monkeypatch):
    root, place, name = work_path(spark, "t-rl2"), work_path(spark, "t-rl2-place"), f"t_rl2_{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([("1", 1)], "_id string, a int").write.parquet(f"{root}/t/part_number=1")
    real = commits.commit

    def overtaken(sp, folder, version, doc, *a):
        monkeypatch.undo()
        real(sp, folder, version, {"path": "elsewhere"})
        real(sp, folder, version, doc, *a)
    monkeypatch.setattr(wh.commits, "commit", overtaken)
    got = wh.load_full(spark, root, ["t"], {"t": place}, {"t": name}).first()
    assert got["status"] == "failed" and "CommitConflict" in got["error"]


def test_null_keys_of_a_large_source_go_past_the_shuffle(spark):
    target = spark.range(0, 300, 3).select(F.col("id").cast("string").alias("_id"))
    source = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("_id"), "id")
    got = wh.merge_insert_only(target, source, "_id", source_is_bounded=False)
    want = wh.merge_insert_only(target, source, "_id", source_is_bounded=True)
    assert rows(got) == rows(want) and got.where("_id IS NULL").count() == 300
    assert "Union" in plan_text(got)


def test_profile_of_parts_reads_new_parts_only(spark):
    root = work_path(spark, "t-sketch")
    raw = spark.range(6000).select(
        F.col("id").cast("string").alias("_id"), F.when(F.col("id") % 4 == 0, "").otherwise("u").alias("user_id_db"), (F.col("id") % 700).cast("string").alias("device_id"),
        (F.col("id") % 5).cast("string").alias("store_id"), F.lit("1").alias("api_version"), F.when(F.col("id") % 9 == 0, "0").otherwise("5").alias("price"))
    give = lambda df, n: ex.export_parts(df.withColumn("part_number", F.lit(n)), root, "t")
    give(raw.where(F.col("_id").cast("int") < 4000), 1)
    first = pp.update_sketches(spark, root, "t")
    assert first >= 1 and pp.update_sketches(spark, root, "t") == 0
    give(raw.where(F.col("_id").cast("int").between(3000, 5999)), 2)       # 1000 keys twice
    second = len([n for n in fs.names(spark, f"{root}/t/part_number=2") if n.endswith(".parquet")])
    assert pp.update_sketches(spark, root, "t") == second
    got, everything = pp.stored_profile(spark, root, "t").first(), spark.read.parquet(f"{root}/t")
    want = pf.profile(everything).first()
    for c in ("total_rows", "null_key_count", "null_user_id_db", "null_pct_user_id_db", "null_device_id", "zero_or_null_price_count", "is_id_unique"):
        assert got[c] == want[c], c
    for c in ("distinct_id_count", "distinct_devices", "distinct_stores", "distinct_api_versions"):
        assert abs(got[c] - want[c]) <= 3 * pp.ERROR * want[c], c
    give(raw.where(F.col("_id").cast("int") < 10), 2)                      # the part is replaced
    again = pp.stored_profile(spark, root, "t").first()
    assert again["total_rows"] == 4010


@pytest.mark.parametrize("block", [2, 4, 1024])
def test_running_totals_over_many_levels(spark, block):
    keys = [k for k in range(1, 200) if k % 7]
    df = spark.createDataFrame([(k, k * k, 1) for k in keys], "k int, a long, b int").repartition(5)
    got = rep.running_totals(df, "k", ["a", "b"], block)
    want, a, b = [], 0, 0
    for k in keys:
        a, b = a + k * k, b + 1
        want.append((k, k * k, 1, a, b))
    assert sorted(tuple(r)[:5] for r in got.collect()) == want
    assert set(rows(got, "total_a", "total_b")) == {(a, b)}
    # every window is partitioned: nothing but the one-row totals meets in one task
    tree = plan_text(got).split("\n\n")[0]
    assert "SinglePartition" not in tree
    assert rep.running_totals(df.limit(0), "k", ["a"], block).count() == 0


def test_samples_are_the_same_on_every_run(spark):
    df = spark.createDataFrame([(i, f"v{i % 30}" if i % 3 else None, [i]) for i in range(200)], "k int, s string, a array<int>")
    one = rows(st.sample_columns(df, n=7, key="k"))
    assert one == rows(st.sample_columns(df.repartition(6), n=7, key="k"))
    assert [c for c, *_ in one] == ["a"] * 7 + ["k"] * 7 + ["s"] * 7
    assert "[" in one[0][2] and all(v for *_, v in one)
    assert rows(st.sample_non_null(df, "s", 5)) == rows(st.sample_non_null(df.repartition(3), "s", 5))
    assert rows(st.sample_columns(df.limit(0), n=3)) == [] and len(rows(st.sample_columns(df, ["s"], 500))) == 133


def test_parts_sized_by_bytes(spark):
    root = work_path(spark, "t-part-bytes")
    df = spark.range(1000).select(F.format_string("%06d", "id").alias("_id"), F.lit("x" * 80).alias("name"))
    per_row = len('{"_id":"000000","name":""}') + 80
    m = ex.incremental_export(spark, df, root, "t", size=10, part_bytes=250 * per_row)
    assert [r["rows"] for r in m.orderBy("part_number").collect()] == [250] * 4
    assert ex.load_state(spark, root, "t") == ("000999", 4)


def test_listing_of_columns_reads_no_row(spark):
    path = work_path(spark, "t-listing")
    spark.range(5).select(F.col("id"), F.lit("x").alias("s")).write.parquet(path)
    got = pf.catalog_columns({"b": spark.read.parquet(path), "a": spark.createDataFrame([], "z int")}, counts=False)
    assert [tuple(r) for r in got.collect()] == [("a", "z", "INT", "YES", 1), ("b", "id", "BIGINT", "YES", 1), ("b", "s", "STRING", "YES", 2)]
    assert "Scan parquet" not in plan_text(got)
