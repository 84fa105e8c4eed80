"""The operators against brute force and libraries, with nulls, empty and long texts, ties,
repeated rows, empty tables and clashing extra columns."""

import hashlib
import json
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from clickflow.llm import chat, licenses, line_dedup, mixing, near_dup, pieces, quality, token_counts, topk, toxicity
from clickflow.llm.components import components
from clickflow.llm.shingles import fingerprints, hashed_lines, hashed_texts, pieces as line_pieces, shingle_sets
from conftest import rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns whose names clash."""
    from pyspark.sql import functions as F

    def make(items):
        rows = [(i[0], i[1], "en", i[2] if len(i) > 2 else "s", 0) for i in items]
        df = spark.createDataFrame(rows, DOCS)
        return df.withColumn("kept", F.lit(True)).withColumn("size", F.lit(7)).withColumn("n_words", F.lit("x"))
    return make


ODD = ["", None, "<|endoftext|>", "a<|endoftext|> b", "  x  \n\n y\t", "a" * 300, "don't 'S", "▁a▁ ▁▁b", "日本語🙂 x",
       "\x00\x01", "￿￾ x", "one two", "\x1c\x85 z　q", "x " * 3000]


def prose(seed, n, vocab=400):
    r = random.Random(seed)
    return " ".join("w%d" % r.randrange(vocab) for _ in range(n))


def near_corpus():
    base = prose(1, 80, 5000).split()
    items = [(0, " ".join(base)), (3, " ".join(base)), (5, " ".join(base).upper())]
    for k in range(40):  # copies with one to five words changed
        words = list(base)
        r = random.Random(k)
        for _ in range(1 + k % 5):
            words[r.randrange(80)] = f"x{k}"
        items.append((10 + k, " ".join(words)))
    return items + [(100, None), (101, ""), (102, "two words"), (103, "two words"), (104, prose(9, 3000, 9000)), (104, prose(9, 3000, 9000))]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(words):
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def groups(sets, num, den):
    ids, root = list(sets), {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for i, a in enumerate(ids):
        find(a)
        for b in ids[:i]:
            k = len(sets[a] & sets[b])
            if k and k * den >= num * (len(sets[a]) + len(sets[b]) - k):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_near_duplicates_equal_brute_force(spark, make_docs):
    items = near_corpus()
    sets = {i: shingles(words_of(t)) for i, t in items}
    want = groups(sets, 85, 100)
    got = near_dup.near_duplicates(make_docs(items), 85, 100).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted(
        (i, len(sets[i]), want[i], want[i] == i) for i, _ in items)
    kept = near_dup.keep_one(make_docs(items), 85, 100)
    assert kept.columns == make_docs(items).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in want if want[i] == i)


def test_near_duplicates_without_ids_and_rows(spark, make_docs):
    t = prose(2, 30)
    got = near_dup.near_duplicates(make_docs([(None, t), (7, t), (None, "other words")])).collect()
    assert sorted((r.component_id, r.kept) for r in got if r.component_id is not None) == [(7, False), (7, True)]
    assert [r.kept for r in got if r.component_id is None] == [True]
    assert near_dup.near_duplicates(make_docs([(1, "a")]).limit(0)).count() == 0


def test_signature_estimates_jaccard():
    r = np.random.default_rng(0)
    common, a, b = (r.integers(0, 2 ** 63, n, dtype=np.uint64) for n in (300, 50, 50))
    values = np.r_[common, a, common, b]
    owner = np.repeat([0, 1], 350)
    sig = near_dup.super_minhash(values, owner, 2)
    assert abs((sig[0] == sig[1]).mean() - 300 / 400) < 0.15
    one = near_dup.super_minhash(values[:1], np.zeros(1, dtype=np.int64), 1)
    assert len(np.unique(one)) == near_dup.M  # a permutation: each place at a rank of its own


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + k) for k in range(1, 20)] + [(5, 5)]
    got = dict(rows(components(spark.createDataFrame(edges, "u long, v long"))))
    assert got == {**{i: 0 for i in range(31)}, **{100 + k: 100 for k in range(20)}}


def test_line_dedup_equals_brute_force(spark, make_docs):
    lines = [t for _, t in near_corpus() if t] + ["", "   ", "two words"]
    items = [(i, "\n".join(lines[i::7] + [f"own line {i} of this document here"])) for i in range(7)]
    items += [(50, None), (51, ""), (52, "two words\nnew one"), (None, "two words")]
    earlier, want = [], {}
    for i, text in items:
        left = []
        for line in (text or "").split("\n"):
            s = shingles(words_of(line))
            match = s and any(len(s & e) * 100 >= 80 * len(s | e) for e in earlier)   # a missing id comes last
            if s:
                earlier.append(s)
            if not match:
                left.append(line)
        want[i] = "\n".join(left) if text is not None else None
    got = {r._row.doc_id: r._text for r in line_dedup.dedup_lines(make_docs(items)).collect()}
    assert got == want
    out = line_dedup.without_repeated_lines(make_docs([(1, "a b\nc"), (2, "a b"), (3, "")]))
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "a b\nc"), (3, "")]
    assert line_dedup.dedup_lines(make_docs([(1, "a")]).limit(0)).count() == 0


def test_top_k_equals_brute_force(spark):
    r = np.random.default_rng(3)
    vectors = {i: r.normal(size=6).round(2).tolist() for i in range(0, 1200, 3)}
    vectors |= {5000: vectors[0], 5001: vectors[0], 5100: vectors[0]}
    items = list(vectors.items()) + [(1, None), (2, [1.0, None] + [0.0] * 4), (4, [float("nan")] * 6), (None, [1.0] * 6), (7, [1e30] * 6), (9, [1.0])]
    df = spark.createDataFrame(items, "vec_id long, embedding array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")   # shards and queries over many batches
    try:
        got = topk.top_k(df, df.where("vec_id % 100 = 0"), k=5, shard_rows=64).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    exact = {i: [int(np.floor(1024 * x)) for x in v] for i, v in items if i is not None and v and None not in v and not np.isnan(v).any()}
    want = []
    for q in (i for i in exact if i % 100 == 0):
        scored = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(exact[q], v, strict=True)))), i)
                        for i, v in exact.items() if i != q and len(v) == len(exact[q]))
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert sorted(tuple(x) for x in got) == sorted(want)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_mix_comes_near_its_targets_and_repeats(spark, make_docs):
    items = [(i, prose(i, 20 + i % 9), ["a", "b", "c", None][i % 4]) for i in range(800)] + [(900, None, "a"), (901, "", "z")]
    docs = make_docs(items)
    plan = mixing.mix_plan(docs).collect()
    size, taken, target = Counter(), Counter(), {}
    for r in plan:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    total = sum(size.values())
    assert abs(sum(target.values()) - 1.5 * total) < 1e-6 * total
    assert all(target[s] <= 2 * size[s] + 1e-9 and abs(taken[s] - target[s]) <= 0.1 * size[s] + 1 for s in size)
    assert sorted(plan, key=str) == sorted(mixing.mix_plan(docs).collect(), key=str)
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.copies for r in plan if r.copies})
    assert mixing.mix_plan(docs.limit(0)).count() == 0


def test_tokens_equal_the_library(spark, make_docs):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    docs = make_docs([(i, t) for i, t in enumerate(ODD)])
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, path).collect()}
    for i, t in enumerate(ODD):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 512)


def test_merges_one_at_a_time_when_ranks_are_out_of_order():
    symbols = token_counts.byte_symbols()
    vocab = {c: i for i, c in enumerate(symbols)} | {"ab": 256, "bc": 257, "abc": 258, "abca": 259}
    spec = {"model": {"vocab": vocab, "merges": ["b c", "abc a", "a bc"]}, "added_tokens": []}
    merger = token_counts.RankMerger(spec)
    assert not merger.together
    assert merger.counts([b"abcabc", b"", b"zz"]).tolist() == [2, 0, 2]  # abca|bc


def test_pieces_equal_the_library(spark, make_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = pieces.PieceCodec(open(path, "rb").read()).sp
    docs = make_docs([(i, t) for i, t in enumerate(ODD)] + [(99, "y" * 5000 + " z" * 50)])
    got = {r.doc_id: r for r in pieces.encode_decode(docs, path, with_ids=True).collect()}
    for i, t in [*enumerate(ODD), (99, "y" * 5000 + " z" * 50)]:
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        raw = np.array(ids, dtype="<u4").tobytes()
        assert (got[i].n_tokens, bytes(got[i].ids), got[i].decoded) == (len(ids), raw, sp.decode(ids))
        assert got[i].ids_sha256 == hashlib.sha256(raw).hexdigest()


def test_chat_round_trip_and_layouts(spark):
    from pyspark.sql import functions as F
    records = [{"messages": [{"role": "user", "content": "a<|im_end|>\\|\n"}, {"role": "assistant", "content": "\\<|b"}], "extra": 1},
               {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]},
               {"prompt": "p", "response": "r"}, {"instruction": "i", "input": "", "output": "o"}, {"foo": {"role": "x"}}]
    want = [[("user", "a<|im_end|>\\|\n"), ("assistant", "\\<|b")], [("user", "q"), ("assistant", "")],
            [("user", "p"), ("assistant", "r")], [("user", "i"), ("assistant", "o")], []]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(5, "{bad"), (6, None)], "conv_id long, j string")
    layout, turns = chat.record_turns(F.col("j"))
    made = chat.format_turns(df.select("conv_id", layout.alias("layout"), turns.alias("turns")))
    got = {r.conv_id: [(t.role, t.text) for t in r.t] for r in made.select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    assert [got[i] for i in range(7)] == want + [[], []]
    table = spark.createDataFrame([(1, 1, "assistant", None), (1, 0, "us\ner\\n", "x"), (1, None, "user", "late"), (None, 0, "user", "lone")],
                                  "conv_id long, turn long, role string, text string").withColumn("layout", F.lit(3))
    out = {r.conv_id: r for r in chat.digests(chat.format_turns(chat.canonical(table))).collect()}
    said = "us\ner\\n\nx\nassistant\n\nuser\nlate\n"
    assert (out[1].n_turns, out[1].turns_sha256, out[1].loss_chars) == (3, hashlib.sha256(said.encode()).hexdigest(), 0)
    assert out[None].n_turns == 1 and chat.canonical(table.limit(0)).count() == 0


def test_quality_measures_equal_brute_force(spark, make_docs):
    texts = [prose(i, 60 + i % 50) for i in range(120)] + [prose(1, 30) + "\n" + prose(1, 30) + "\n" + prose(1, 30), "x " * 500, "#$% | a" * 90,
                                                           None, "", "  \n", "a b c a b c a b c"]
    docs = make_docs([(i, t, None if i % 5 == 0 else "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        win = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        hit = {k + x for k in range(len(w) - 2) if win[tuple(w[k:k + 3])] > 1 for x in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in t or ""), len(lines) - len(set(lines)), len(hit)), i
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        assert got[i].base_failed == failed and not (failed and got[i].kept)
    assert all(got[i].kept for i in range(120)) and not got[122].kept
    good = quality.keep_good(docs)
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == {i for i in got if got[i].kept}
    assert quality.quality(docs.limit(0)).count() == 0


def test_toxicity_held_out(spark, make_docs):
    def text(i, bad):
        return prose(i, 60) + (" you worthless idiot scum " * (1 + i % 3) if bad else "")
    items = [(i, text(i, i % 3 == 0)) for i in range(300)] + [(400, None), (401, ""), (401, "")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(150)] + [(400, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(make_docs(items), labels).collect()
    assert len(got) == len(items)
    assert all(r.toxic == (r.doc_id % 3 == 0) for r in got if 150 <= r.doc_id < 300)
    assert all(0 <= r.expected_severity <= 3 for r in got) and not any(r.toxic for r in got if r.doc_id >= 400)
    none = toxicity.toxicity(make_docs(items), labels.limit(0)).collect()
    assert all(r.expected_severity == 0 for r in none)


def test_licences_and_inheritance(spark):
    files = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c.py", "code without a notice"), (3, "a/b/d.py", "Licensed under CC BY-NC 4.0.\ncode"),
             (4, "z/e.py", "x"), (5, None, None), (6, "a/b/COPYING", "Licensed under the Apache License, Version 2.0."), (7, "a/f.py", ""), (8, "top.py", "x")]
    got = {r.key: r for r in licenses.licences(spark.createDataFrame(files, "key long, path string, text string")).collect()}
    assert {k: (r.licence, r.origin, r.licence_dir) for k, r in got.items()} == {
        1: ("MIT", "own", None), 2: ("Apache-2.0", "inherited", "a/b"), 3: ("CC-BY-NC-4.0", "own", None), 4: (None, "none", None),
        5: (None, "none", None), 6: ("Apache-2.0", "own", None), 7: ("MIT", "inherited", "a"), 8: (None, "none", None)}


def test_shingle_sets():
    values, owner, sizes = shingle_sets(*hashed_texts([b"a " * 9, b"", b"a b", b"b a", b"A\tB"]))
    f1, _ = fingerprints(values, owner, 5)
    assert sizes.tolist() == [1, 0, 1, 1, 1] and f1[2] == f1[4] != f1[3]
    by_rank = shingle_sets(*hashed_texts([b"c d e f g h i j", b"x"]), rank=lambda v: v % np.uint64(7))
    ranks = (by_rank[0][:4] % np.uint64(7)).tolist()
    assert ranks == sorted(ranks) and by_rank[2].tolist() == [4, 1]


def test_words_hashed_in_bulk():
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "B", "\u00a0", "\u00e9", " ", "\t", "\x0b", "\r", "\n", "xyzxyzxy", "w" * 9, "v" * 70])
                     for _ in range(rng.randrange(80))).encode() for _ in range(300)] + [b"", b"\n\n", b" "]
    words, sizes, of, number = hashed_lines(texts)
    lines = [(i, k, line.split()) for i, t in enumerate(texts) for k, line in enumerate(t.lower().split(b"\n"))]
    assert [(i, k, len(w)) for i, k, w in lines] == list(zip(of.tolist(), number.tolist(), sizes.tolist(), strict=True))
    plain = [w for *_, ws in lines for w in ws]
    assert len(set(zip(plain, words.tolist(), strict=True))) == len(set(plain)) == len(set(words.tolist()))
    for limit in (1, 10, 1000):
        cut = list(line_pieces(texts, limit))
        assert [b"\n".join(p for i, _, p in cut if i == k) for k in range(len(texts))] == texts
        assert all(first == sum(p.count(b"\n") + 1 for j, f, p in cut if j == i and f < first) for i, first, _ in cut)


def test_pipeline_stages_keep_columns_and_act(spark, make_docs):
    items = [(i, prose(i, 70, 3000) + "\n" + prose(1000 + i, 70, 3000), "ab"[i % 2]) for i in range(30)]
    items += [(100, items[0][1], "a"), (101, "short", "a"), (102, None, None)]
    docs = make_docs(items)
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, "")
        assert out.columns == docs.columns, name
        now = spark.createDataFrame(out.collect(), out.schema)
    left = {r.doc_id for r in now.collect()}
    assert left <= {*range(30), 101} and 102 not in left      # a short text goes only for what it holds
    last = corpus_pipeline.STAGES[-1][1](spark, now, "")
    assert last.count() == now.count()


@pytest.mark.parametrize("name", ["op1_top_k", "op2_mix_sources", "op6_chat_format", "op7_quality_rules", "op8_near_duplicates", "op10_line_dedup"])
def test_queries_equal_their_sql(spark, name):
    import duckdb
    from clickflow.llm.queries import ORACLE_SQL, QUERIES
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    got = QUERIES[name](spark, "/root/testdata/sf0.001")
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    norm = lambda v: repr(round(v, 6)) if isinstance(v, float) else repr(v)
    assert sorted(tuple(norm(r[c]) for c in sorted(cols)) for r in got.collect()) == sorted(
        tuple(norm(r[cols.index(c)]) for c in sorted(cols)) for r in res.fetchall())
