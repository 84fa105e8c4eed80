"""Repeated passages, lexical search and whitening against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickflow.llm import lexical, substrings, whitening
from conftest import rows, srt

DOCS = "doc_id long, text string, lang string, n_words string, spans int, kept boolean"


def make_docs(spark, items):
    return spark.createDataFrame([(i, t, "en", "x", 7, True) for i, t in items], DOCS)


# -- repeated passages ---------------------------------------------------------------------

def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_repeats(items, width):
    """(doc_id, n_words, spans, kept) with windows counted one by one."""
    count = Counter()
    for _, t in items:
        w = words_of(t)
        count.update(tuple(w[p:p + width]) for p in range(len(w) - width + 1))
    out = []
    for i, t in items:
        w = words_of(t)
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if count[tuple(w[p:p + width])] > 1:
                gone[p:p + width] = [True] * width
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return srt(out)


def told_repeats(docs, width, seed, **k):
    made = substrings.without_repeats(docs, width, seed, **k)
    return rows(made.select("_row.doc_id", "n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("gone"), "kept"))


def repeat_corpus():
    r = random.Random(3)
    new = lambda n: ["w%d" % r.randrange(10 ** 6) for _ in range(n)]
    passage, other, base = new(60), new(36), new(90)
    items = [(0, " ".join(base)), (1, "  ".join(base)), (2, "\n".join(base)), (2, " ".join(base)), (None, " ".join(base))]
    for k in range(30):  # one passage in many contexts
        items.append((10 + k, " ".join(new(k % 7 * 5) + passage + new(k % 5 * 9))))
    for k in range(12):  # parts of the passage: from both ends, long and short ones
        a, n = r.randrange(20), 20 + 4 * k
        items.append((50 + k, " ".join(new(12) + passage[a:a + n] + new(3))))
    items += [(70, " ".join(new(5) + other + new(40) + other)), (71, " ".join(["a"] * 40)), (72, " ".join(["a"] * 20)), (73, " ".join(["b", "c"] * 30))]
    near = list(base)
    near[45] = "changed"
    items += [(74, " ".join(near)), (75, None), (76, ""), (77, " \t\n"), (78, " ".join(base[:35])), (79, " ".join(base[:34])), (80, "x" * 5000),
              (81, "word\x00odd\x85é　z " * 40), (82, " ".join(new(3000) + passage + new(2000)))]
    return items


@pytest.mark.parametrize("width,seed,limit", [(35, 10, None), (35, 10, 0), (8, 3, None), (5, 5, None), (12, 1, 0)])
def test_repeats_equal_brute_force(spark, width, seed, limit):
    """Also with nothing broadcast; pieces of texts are tested below."""
    items = repeat_corpus()
    assert told_repeats(make_docs(spark, items).repartition(7), width, seed, limit=limit) == brute_repeats(items, width)


def test_repeats_with_few_words_equal_brute_force(spark):
    r = random.Random(5)
    items = [(i, " ".join(r.choice("ab") for _ in range(r.randrange(0, 40)))) for i in range(60)]
    assert told_repeats(make_docs(spark, items), 6, 3) == brute_repeats(items, 6)


def test_repeats_of_an_empty_table(spark):
    assert told_repeats(make_docs(spark, [(1, "a")]).limit(0), 35, 10) == []


@pytest.mark.parametrize("limit", [1, 50, 300, 10 ** 6])
def test_pieces_hold_every_window_once(limit):
    r = random.Random(limit)
    text = b"".join(b"w%d" % r.randrange(999) * r.choice([1, 1, 30]) + r.choice([b" ", b"\n\n", b" \t"]) for _ in range(300))
    for t in (text, b"  " + text + b"  ", b"x" * 1000, b"", b" " * 500):
        words, held = t.split(), []
        for first, part in substrings.pieces(t, 7, limit):
            w = part.split()
            held += [(first + p, tuple(w[p:p + 7])) for p in range(len(w) - 6)]
        assert sorted(held) == [(p, tuple(words[p:p + 7])) for p in range(len(words) - 6)]


def test_equal_windows_choose_equal_anchors():
    r = random.Random(9)
    shared = ["s%d" % i for i in range(50)]
    texts = [" ".join(["x%d" % r.randrange(99) for _ in range(n)] + shared + ["y%d" % r.randrange(99)] * n).encode() for n in (0, 3, 40, 200)]
    of, a, c1, c2, lo, hi = substrings.seeds(texts, 20, 6)
    sizes = substrings.word_counts(texts)
    start = np.cumsum(sizes) - sizes
    found = defaultdict(set)
    for o, anchor, first, last in zip(of, a, lo - start[of], hi - start[of]):
        for p in range(first, last + 1):
            found[tuple(texts[o].split()[p:p + 20])].add(anchor)
    assert sum(len(v) for v in found.values()) == len(found)          # one anchor for each different window
    assert (np.sort(hi - lo + 1).sum() == sum(sizes - 19))            # every window has one


def test_copies_make_one_class(spark):
    """Thousands of copies are counted, not paired: rows that are extended again do not grow with them."""
    base = " ".join("w%d" % i for i in range(200))
    for n in (10, 400):
        docs = make_docs(spark, [(i, base) for i in range(n)] + [(9999, base.replace("w150", "other"))])
        found = substrings.repeats(docs)
        assert found.count() == 2
        got = {r["doc_id"]: r["n"] for r in substrings.without_repeats(docs).select("_row.doc_id", F.size("spans").alias("n")).collect()}
        assert got[0] == 1 and got[9999] == 2


# -- lexical search ------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k):
    held = [(i, Counter(terms_of(t)), len(terms_of(t))) for i, t in docs]
    held = [h for h in held if h[2]]
    total, words = len(held), sum(h[2] for h in held)
    df = Counter(t for h in held for t in h[1])
    asked = defaultdict(Counter)
    for i, t in items:
        asked[i].update(terms_of(t))
    out = []
    for i, q in asked.items():
        scores = []
        for d, c, n in held:
            m = 100 - 25 + (25 * n * total) // words
            s = sum(r * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m)) for t, r in q.items() if c[t])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(i, n + 1, d, -s) for n, (s, _, d) in enumerate(sorted(scores)[:k])]
    return srt(out)


def search_corpus():
    r = random.Random(6)
    text = lambda n: " ".join(r.choice(["The", "cat", "CAT", "cats", "dog", "über", "日本", "x1", "a-b", "it's", "end."]) for _ in range(n))
    docs = [(i, text(r.randrange(1, 60))) for i in range(120)] + [(500, None), (501, ""), (502, "?! --"), (503, "cat " * 3000), (None, "cat dog"), (None, "cat dog")]
    docs += [(600 + i, "same words here") for i in range(30)] + [(7, "cat dog"), (7, "cat dog"), (504, "\x00cat\x7fdog\x80 ＣＡＴ")]
    items = [(0, "The cat"), (1, "cats"), (2, "same same WORDS"), (3, None), (4, "nowhere"), (5, ""), (6, "über 日本 a b s"), (0, "dog dog"), (None, "end x1"), (8, "ca t d"), (9, "cat")]
    return docs, items


@pytest.mark.parametrize("limit", [1 << 22, 30])
def test_search_equals_brute_force(spark, limit):
    docs, items = search_corpus()
    d = make_docs(spark, docs).withColumnsRenamed({"n_words": "rank", "spans": "score"}).repartition(5)
    i = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, doc_id int")
    assert rows(lexical.search(d, i, 6, limit)) == brute_search(docs, items, 6)
    assert rows(lexical.search(d, i, 500)) == brute_search(docs, items, 500)


def test_search_of_empty_tables(spark):
    docs, items = search_corpus()
    d, i = make_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    for a, b in ((d.limit(0), i), (d, i.limit(0)), (d.where("text IS NULL"), i)):
        assert rows(lexical.search(a, b)) == []


def test_scan_finds_whole_terms_only():
    s = lexical.Scanner(["cat", "cats", "t", "a b", "über"])
    n, found = s.scan("Cat cats scat cat-cat,t ÜBER über t".encode())
    assert n == 9 and Counter(found.tolist()) == {0: 3, 1: 1, 2: 2, 4: 1}
    assert lexical.Scanner([]).scan(b"a b")[0] == 2


def test_best_keeps_the_least_ids_of_ties():
    best = lexical.Best(2, 3)
    for a in range(0, 40, 8):
        best.add(np.array([[5, a + i] for i in range(8)]), np.arange(40 - a, 32 - a, -1), np.zeros(8, dtype=np.int64))
    item, score, _, ids = best.held
    assert list(zip(item, score, ids)) == [(0, 5, 1), (0, 5, 2), (0, 5, 3), (1, 39, 1), (1, 38, 2), (1, 37, 3)]


# -- whitening -------------------------------------------------------------------------------

def brute_whitening(vectors, count=4):
    """vec_id -> (deviation, |whitened| per component), and (n, explained), by the symmetric eigensolver."""
    x = {k: np.floor(256 * np.asarray(v, dtype=float)).astype(np.int64) for k, v in vectors}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = fit - s / n
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1][:count], q[:, ::-1][:, :count]
    return {k: (int(((n * v - s) ** 2).sum()), np.abs((v - s / n) @ q / np.sqrt(e))) for k, v in x.items()}, n, e / np.trace(y.T @ y / n)


VECTORS = "vec_id long, embedding array<double>, n string, component int"


def frame(spark, items):
    return spark.createDataFrame([(k, v, "x", 1) for k, v in items], VECTORS)


def test_whitening_equals_the_eigensolver(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)       # several rounds of folding
    rng = np.random.default_rng(2)
    data = rng.standard_normal((400, 12)) * np.linspace(3, 0.2, 12) + 5
    items = [(i, v.tolist()) for i, v in enumerate(data)] + [(1000, data[0].tolist()), (1000, data[0].tolist())]
    odd = [(2000, None), (2001, [1.0] * 11 + [None]), (2002, [1.0] * 11 + [math.nan]), (2003, [math.inf] + [1.0] * 11), (2004, [])]
    got = whitening.whiten(frame(spark, items + odd).repartition(9)).collect()
    want, n, explained = brute_whitening(items)
    assert Counter(r["vec_id"] for r in got) == Counter({**{k: 4 for k, _ in items}, 1000: 8})
    for r in got:
        deviation, w = want[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == deviation and r["identity_error"] < 1e-12
        assert abs(r["explained"] - explained[r["component"] - 1]) < 1e-12
        assert abs(abs(r["whitened"]) - w[r["component"] - 1]) < 1e-9


def test_whitening_of_flat_mixed_and_empty_tables(spark):
    rng = np.random.default_rng(3)
    two = [(i, [float(a), float(b), float(a + b), 1.0, 0.0]) for i, (a, b) in enumerate(rng.integers(-9, 9, (50, 2)))]
    short = [(100 + i, [float(i)]) for i in range(3)]
    same = [(200 + i, [0.5, 0.5]) for i in range(4)]
    got = whitening.whiten(frame(spark, two + short + same + [(None, [0.0])])).collect()
    by = defaultdict(list)
    for r in got:
        by[r["vec_id"]].append(r)
    assert [r["whitened"] is None for r in sorted(by[0], key=lambda r: r["component"])] == [False, False, True, True]
    assert by[0][0]["identity_error"] < 1e-12 and len(by[100]) == 1 and by[100][0]["n"] == 3 and len(by[None]) == 1
    assert [(r["whitened"], r["explained"], r["deviation"], r["n"]) for r in by[200]] == [(None, None, 0, 1)] * 2
    assert rows(whitening.whiten(frame(spark, two).limit(0))) == []


def test_huge_entries_are_cut_to_longs(spark):
    got = whitening.whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [2.0 ** 40, 2.0])])).collect()
    assert {r["deviation"] for r in got if r["vec_id"] != 9} <= {2 ** 63 - 1} and len(got) == 6


SHAPES = {
    "random": lambda g: g.standard_normal((300, 20)), "low rank": lambda g: g.standard_normal((300, 3)) @ g.standard_normal((3, 20)),
    "equal values": lambda g: np.vstack([np.eye(20), -np.eye(20)]), "graded": lambda g: g.standard_normal((300, 20)) * 10.0 ** -np.arange(20),
    "graded the other way": lambda g: g.standard_normal((300, 20)) * 10.0 ** np.arange(-20, 0), "zero": lambda g: np.zeros((30, 20)),
    "close values": lambda g: np.linalg.qr(g.standard_normal((200, 20)))[0] * np.r_[np.ones(10), np.full(10, 1 - 1e-9)], "few rows": lambda g: g.standard_normal((3, 20)),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_solver(shape):
    a = SHAPES[shape](np.random.default_rng(7))
    r = None
    for k in range(0, len(a), 64):
        r = whitening.fold(r, a[k:k + 64])
    diagonal, above, v = whitening.bidiagonal(r)
    size = max(1e-300, np.linalg.norm(a, 2))
    b = np.diag(diagonal) + np.diag(above, 1)
    assert np.abs(v.T @ (r.T @ r) @ v - b.T @ b).max() <= 1e-13 * size ** 2
    values = whitening.singular_values(diagonal, above)
    assert np.abs(values - np.linalg.svd(b, compute_uv=False)).max() <= 1e-13 * size
    made = whitening.solved(r, len(a), 6)
    d = np.array([m[3] for m in made])
    assert np.abs(d @ d.T - np.eye(6)).max() < 1e-12
    for _, e, _, one, _ in made:
        assert np.linalg.norm(a.T @ (a @ one) / len(a) - e * np.array(one)) <= 1e-13 * size ** 2


def test_small_values_of_a_graded_bidiagonal_are_accurate():
    """High relative accuracy: each value of a graded matrix to nearly all its digits."""
    from fractions import Fraction
    diagonal, above = 10.0 ** -np.arange(8.0), 0.5 * 10.0 ** -np.arange(7.0)
    values = whitening.singular_values(diagonal, above)
    product = Fraction(1)
    for x in diagonal:
        product *= Fraction(float(x))
    assert abs(float(np.prod(values)) / float(product) - 1) < 1e-13
