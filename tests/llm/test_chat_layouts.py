"""Layouts of records that carry other fields too."""

import json

from pyspark.sql import functions as F

from clickflow.llm import chat


def test_other_fields_do_not_hide_a_layout(spark):
    said = [("user", "q"), ("assistant", "a")]
    talk = [{"role": "user", "content": "q"}, {"annotations": [], "refusal": None, "audio": {"a": [{"b": 1}]}, "role": "assistant", "content": "a"}]
    records = [
        ({"messages": talk}, "messages", said), ({"messages": talk, "input": "x", "prompt": "y"}, "messages", said),
        ({"messages": [None, *talk]}, "messages", [("", ""), *said]),
        ({"conversations": [{"from": "human", "meta": [{"x": [1]}], "value": "q"}, {"from": "gpt", "value": "a"}], "output": 1}, "conversations", said),
        ({"prompt": "q", "response": "a", "input": "z"}, "prompt_response", said),
        ({"instruction": "q", "output": "a", "prompt": "z"}, "instruction", said),
        ({"instruction": "q", "input": "r", "output": "a", "prompt": "z"}, "instruction_input", [("user", "q\n\nr"), ("assistant", "a")]),
        ({"other": {"role: x, content": [{"role": "a", "content": "b"}]}}, None, []), ({"messages": [1, {"role": "a", "content": "b"}]}, None, []),
        ({"messages": "text"}, None, []), ({"messages": []}, None, []), ({"conv_id": 1, "turn": 1, "role": "user", "text": "t"}, None, [])]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, (r, *_) in enumerate(records)], "i int, j string")
    layout, turns = chat.record_turns(F.col("j"))
    got = {r.i: (r.layout, [(t.role, t.text) for t in r.turns]) for r in df.select("i", layout.alias("layout"), turns.alias("turns")).collect()}
    for i, (record, name, want) in enumerate(records):
        assert got[i] == (name, want), record


def test_tables_with_a_field_of_another_layout(spark):
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], "conv_id long, turn long, role string, text string")
    for extra in ("input", "output", "prompt"):
        assert chat.frame_layout(rows.withColumn(extra, F.lit("x"))) == "turn_rows"
        assert [len(r.turns) for r in chat.canonical(rows.withColumn(extra, F.lit("x"))).collect()] == [2]


def test_paths_of_variant_schemas(spark):
    records = [{"a": 1, "b": [{"c": [{"d": 1}], "e": None}], "f": {}, "g": {"h": "x"}}, [1], {"x.y": 1, "p[": {"q`": 2.5}}, {"m": []}, 7, {"z": [[{"k": 1}]]}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(99, None), (98, "{broken")], "i int, j string")
    paths = chat.schema_paths(F.schema_of_variant(F.try_parse_json("j")))
    got = {r["i"]: None if r["p"] is None else sorted(r["p"]) for r in df.select("i", paths.alias("p")).collect()}
    assert got == {0: ["a", "b[].c[].d", "b[].e", "g.h"], 1: ["[]"], 2: ["p\\[.q`", "x\\.y"], 3: ["m[]"], 4: [], 5: ["z[][].k"], 98: None, 99: None}


def test_one_fingerprint_per_schema(spark):
    """Both ways give the same layouts and turns; equal paths in any order have one fingerprint."""
    records = [{"prompt": "q", "response": "a"}, {"response": "a2", "prompt": "q2"}, {"prompt": "q", "response": "a", "id": 5}, {"messages": [{"role": "user", "content": "x"}]},
               {"nothing": 1}, {"prompt": "q"}]
    df = spark.createDataFrame([(json.dumps(r), "old") for r in records] + [(None, "old")], "j string, other string")
    made = chat.record_layouts(df, "j")
    layout, turns = chat.record_turns(F.col("j"))
    assert sorted(map(str, made.select("j", "layout", "turns").collect())) == sorted(map(str, df.select("j", layout.alias("layout"), turns.alias("turns")).collect()))
    assert [r["layout"] for r in made.orderBy("j").collect()] == [None, "messages", None, "prompt_response", "prompt_response", None, "prompt_response"]
    one, two = (chat.fingerprint(F.array(*map(F.lit, p))) for p in (["a", "b[].c"], ["b[].c", "a"]))
    assert spark.range(1).select(one == two).first()[0]
    assert chat.record_layouts(df.limit(0), "j").count() == 0
