"""Fences that follow the texts, and the encoder's batch agenda, codec memory and checks."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clickflow.llm import pieces, quality
from conftest import rows

DOCS = "doc_id long, text string, lang string, source string"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _texts(n, share, seed, source, lang="en"):
    """Texts of 60 words, each word followed by a symbol with the given chance."""
    r = random.Random(seed)
    return [(" ".join("w%d" % r.randrange(10 ** 6) + ("#" if r.random() < share else "") for _ in range(60)), lang, source) for _ in range(n)]


def _judged(spark, items):
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(items)], DOCS)
    return df, {r["doc_id"]: r for r in quality.quality(df).collect()}


def test_a_fence_moves_with_its_group(spark, monkeypatch):
    """The same texts are odd in one group and ordinary in another: no constant decides."""
    monkeypatch.setattr(quality, "MIN_GROUP", 50)
    plain, dense = _texts(300, 0.0, 1, "plain"), _texts(300, 0.5, 2, "dense")
    odd = _texts(8, 0.5, 3, "plain")
    _, got = _judged(spark, plain + dense + odd)
    kept = [got[i]["kept"] for i in range(len(got))]
    assert all(kept[:300]) and all(kept[300:600]) and not any(kept[600:])
    fence = {s: {got[i]["f_symbols"] for i in range(a, b)} for s, a, b in (("plain", 0, 300), ("dense", 300, 600))}
    assert len(fence["plain"]) == len(fence["dense"]) == 1 and min(fence["plain"]) < min(fence["dense"])
    # the whole group shifted: its fence shifts along
    _, moved = _judged(spark, _texts(300, 0.1, 1, "plain") + dense)
    assert moved[0]["f_symbols"] > got[0]["f_symbols"]
    assert sum(not moved[i]["kept"] for i in range(300)) <= 3


def test_a_lump_of_odd_texts_does_not_move_the_fence(spark, monkeypatch):
    monkeypatch.setattr(quality, "MIN_GROUP", 50)
    for lump in (1, 20, 70):
        _, got = _judged(spark, _texts(300, 0.0, 1, "s") + _texts(lump, 0.9, 2, "s"))
        assert all(got[i]["kept"] for i in range(300)) and not any(got[i]["kept"] for i in range(300, 300 + lump)), lump


def test_small_groups_take_the_fence_of_their_language_or_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(quality, "MIN_GROUP", 200)
    items = _texts(250, 0.0, 1, "big") + _texts(5, 0.0, 2, "small") + _texts(1, 0.9, 3, "small") + _texts(4, 0.0, 4, "other", "xx") + [(None, None, None), ("", "en", "small")]
    _, got = _judged(spark, items)
    assert len({got[i]["f_symbols"] for i in range(256)}) == 1 and not got[255]["kept"] and got[250]["kept"]
    assert got[256]["f_symbols"] is not None and all(got[i]["kept"] for i in range(256, 260))
    assert not got[260]["kept"] and not got[261]["kept"]
    assert rows(quality.quality(spark.createDataFrame([], DOCS))) == []


def test_repeated_rows_get_equal_verdicts(spark):
    df, got = _judged(spark, _texts(40, 0.2, 1, "s") * 3)
    assert all(got[i]["kept"] == got[i + 40]["kept"] == got[i + 80]["kept"] for i in range(40))
    assert quality.keep_good(df.unionByName(df)).count() == 2 * quality.keep_good(df).count()


# -- the encoder ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    with open(MODEL, "rb") as f:
        return f.read()


def _odd_texts():
    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzäéßøABCXYZ0123456789.,'-日本語🙂▁́"
    words = lambda n, size: " ".join("".join(r.choice(letters) for _ in range(r.randrange(1, size))) for _ in range(n))
    return [words(40, 12) for _ in range(60)] + [words(3, 400), "a" * 5000, "ab" * 3000, "日本" * 900, "", " ", "\n\n", "x \n y", "￿ ￾", "ﬁ ½ Å", "the the the"]


def test_batch_agenda_equals_the_library(model):
    codec = pieces.PieceCodec(model)
    texts = _odd_texts()
    for _ in range(2):       # all new, then remembered
        for t, ids in zip(texts, codec.encode(texts), strict=True):
            assert codec.numbers(ids) == codec.sp.encode(t, add_bos=True, add_eos=True)


def test_both_agendas_agree(model):
    codec = pieces.PieceCodec(model)
    segments = [s for t in _odd_texts()[:40] for s in codec.find(codec.sp.normalize(t)) if s]
    for s, ids in zip(segments, codec.merge_many(segments), strict=True):
        if ids is not None:
            assert codec.native(ids) == codec.merge(s), s
    assert codec.merge_many([]) == [] and codec.merge_many([""]) == [None]


def test_memory_is_bounded_and_old_segments_come_back(model, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    codec = pieces.PieceCodec(model)
    for _ in range(2):
        for t in _odd_texts()[:20]:
            (ids,) = codec.encode([t])
            assert codec.numbers(ids) == codec.sp.encode(t, add_bos=True, add_eos=True)
            assert len(codec.known) <= 50 and len(codec.before) <= 50 + 60


def test_every_segment_is_checked(model):
    """An agenda that goes wrong stops the job, for cut and for whole texts."""
    for cut in (True, False):
        codec = pieces.PieceCodec(model)
        if not cut:
            codec.cut, codec.find = False, lambda text: [text]
        texts = ["good words here", "and more of them"]
        for t, ids in zip(texts, codec.encode(texts), strict=True):
            assert codec.numbers(ids) == codec.sp.encode(t, add_bos=True, add_eos=True)
        codec.pair_rank = codec.pair_rank[::-1].copy()
        with pytest.raises(ValueError, match="differs from the library"):
            codec.encode(["these are other words", "understanding newspapers everywhere"])


def test_encoder_with_repeated_rows_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (2, "")], "doc_id long, text string")
    got = rows(pieces.encode_decode(df, MODEL), "doc_id", "n_tokens")
    assert got == [(None, 2), (1, 4), (1, 4), (2, 2)] or sorted(x[1] for x in got) == [2, 2, 4, 4]
    assert rows(pieces.encode_decode(df.limit(0), MODEL)) == []
    digests = pieces.encode_decode(df, MODEL).where("doc_id = 1").select("ids_sha256", "decoded_sha256").distinct()
    assert digests.count() == 1


def test_codec_is_kept_per_process(model):
    assert pieces.codec_of(model) is pieces.codec_of(model)
    assert len(pieces._CODEC) == 1


# -- training on whole texts -----------------------------------------------------------------

def test_telling_words_at_the_end_of_a_very_long_text_train(spark):
    """No feature of a training text is dropped: the telling words come after 20,000 others."""
    from clickflow.llm import toxicity
    r = random.Random(5)
    long = lambda i: " ".join("l%s" % "".join(r.choice("abcdefghij") for _ in range(9)) for _ in range(20_000))
    items = [(i, (long(i) if i < 4 else "plain words here ") + (" zorgle blarfing snert" if i % 2 == 0 else " kind friendly note")) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in items], "doc_id long, text string, features string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(40)], "doc_id long, toxic int")
    rows_, toxic, amount = toxicity.training_sample(docs, labels)
    assert all({"zorgle", "blarfing", "snert"} <= set(f) for f, t in zip(rows_, toxic, strict=True) if t)
    assert all(a > 0 for a, t in zip(amount, toxic, strict=True) if t)
    got = {x["doc_id"]: x["toxic"] for x in toxicity.toxicity(docs, labels).collect()}
    assert all(got[i] == (i % 2 == 0) for i in range(4, 60))      # four long texts of chance prefixes are no held-out set


def test_repeated_ids_train_with_one_defined_text(spark):
    from clickflow.llm import toxicity
    docs = spark.createDataFrame([(1, "good one"), (1, "bad other"), (2, "bad words"), (3, "good words")] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, toxic int")
    one = rows(toxicity.sample_rows(docs, labels), "doc_id", "features")
    assert len(one) == 3 and one == rows(toxicity.sample_rows(docs.repartition(5), labels), "doc_id", "features")


# -- rows of their own ------------------------------------------------------------------------

def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    from clickflow.llm import line_dedup
    items = [(2, "hello there line one two\nclean A"), (2, "different first line\nclean B"), (None, "a line that stands twice here\nx y"), (None, "a line that stands twice here\nz"),
             (1, "first one of all the lines"), (1, "first one of all the lines"), (3, None)]
    df = spark.createDataFrame([(i, t, "c") for i, t in items], "doc_id long, text string, _d string")
    got = sorted(((r["_row"]["doc_id"], r["_row"]["text"], r["_text"]) for r in line_dedup.dedup_lines(df).collect()), key=str)
    kept = {t: k for _, t, k in got}
    assert kept["different first line\nclean B"] == "different first line\nclean B" and kept["hello there line one two\nclean A"] == "hello there line one two\nclean A"
    assert sorted(len(kept[t].split("\n")) for t in ("a line that stands twice here\nx y", "a line that stands twice here\nz")) == [1, 2]
    assert [k for _, t, k in got if t == "first one of all the lines"] == ["first one of all the lines"] * 2 and len(got) == 7


def test_one_document_of_a_group_stays_whatever_the_ids(spark):
    from clickflow.llm import near_dup
    base = " ".join("w%d" % i for i in range(80))
    near = base.replace("w40", "other")
    items = [(1, base), (None, base), (None, "words of a text that stands alone here"), (5, base + " more"), (5, near), (None, None), (None, ""), (7, "two words"), (7, "two words")]
    df = spark.createDataFrame([(i, t, "c") for i, t in items], "doc_id long, text string, stays string")
    got = sorted(((r["doc_id"], r["text"]) for r in near_dup.keep_one(df).collect()), key=str)
    assert got == sorted([(1, base), (None, "words of a text that stands alone here"), (None, None), (None, ""), (7, "two words")], key=str)
    assert near_dup.keep_one(df.where("doc_id = 5")).count() == 1        # near-equal texts under one id
    assert near_dup.keep_one(df.where("doc_id is null and text is not null")).count() == 3


@pytest.mark.parametrize("lines", [400, 1600])
def test_lines_of_one_template_do_not_meet(spark, lines):
    """Two changing fields in a template of 50 words: similarity 0.77, so nothing matches and nothing is paired."""
    from clickflow.llm import line_dedup, setjoin
    from clickflow.llm.common import saved
    template = lambda i: " ".join([f"u{i}a", *(f"t{k}" for k in range(1, 20)), f"u{i}b", *(f"t{k}" for k in range(21, 50))])
    df = spark.createDataFrame([(i, template(i)) for i in range(lines)], "doc_id long, text string")
    told, alone = line_dedup.numbered(df)
    _, counts = line_dedup.line_classes(told)
    later = saved(spark.createDataFrame([], "d long, l int"), "t-later")
    postings = setjoin.shared_postings(line_dedup._first_prefixes(told, later, counts, 80, 100), 80, 100)
    # a unique token that shares a rare counter with a frequent one may let a line meet the others: linear, never all pairs
    assert alone and postings.count() <= 4 * lines and setjoin.central_pairs(postings, 80, 100).count() <= 4 * lines
    bits = postings.select("t", "id", "n", "p", "c", F.array(*[F.lit(0).cast("long")] * setjoin.WORDS).alias("bits"))
    assert setjoin.open_pairs(bits, F.col("x_id") < F.col("y_id"), 80, 100).count() <= 4 * lines
    assert line_dedup.removed_lines(told, 80, 100, alone).count() == 0


def test_plans_beyond_the_broadcast_limit_give_the_same_results(spark, monkeypatch):
    """Nothing broadcast: texts and lists are shuffled instead."""
    from functools import partial

    from clickflow.llm import common, line_dedup, near_dup, setjoin
    import clickflow.llm.components as hubs
    r = random.Random(8)
    base = [" ".join("w%d" % r.randrange(3000) for _ in range(30)) for _ in range(12)]
    items = [(i, "\n".join(r.sample(base, 4) + [f"own line {i} " + " ".join("x%d" % r.randrange(99) for _ in range(9))])) for i in range(60)]
    items += [(100 + i, items[i][1].replace("w1", "v1", i % 3)) for i in range(30)]
    df = spark.createDataFrame(items, "doc_id long, text string").repartition(4)
    lines = lambda: rows(line_dedup.dedup_lines(df).select("_row.doc_id", "_text", "_removed"))
    groups = lambda: rows(near_dup.near_duplicates(df, 60, 100))
    want = lines(), groups()
    for module in (line_dedup, near_dup, setjoin, hubs):
        monkeypatch.setattr(module, "join_measured", partial(common.join_measured, limit=0))
    assert (lines(), groups()) == want
    assert len({r[2] for r in want[1]}) < 90 and sum(r[2] for r in want[0]) > 100
