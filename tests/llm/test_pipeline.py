"""The whole pipeline against a brute-force version of every stage."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece

import corpus_pipeline
from clickflow.llm import quality
from clickflow.session import work_path
from conftest import srt

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = r"[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def alike(a, b):
    return 100 * len(a & b) >= 80 * len(a | b)


# -- the stages, row by row -------------------------------------------------------------------

def quality_stage(docs):
    def measures(text):
        w, text = words(text), text or ""
        grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        again = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if words(x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(lines), len(again)

    def bins(m, half=0.5):
        n, chars, symbols, dup, lines, again = m
        pairs = [(symbols, chars), (dup, lines), (again, n), (chars, n)]
        return [math.ceil(math.log((a + half) / (b + 1)) / math.log(1.02)) if a + half > 0 else -10 ** 9 for a, b in pairs]

    told = [(d, measures(d[1])) for d in docs]
    passed = [(d, bins(m)) for d, m in told if m[0] >= 50 and 100 * m[5] <= 50 * m[0]]
    limits = []
    for k in range(4):      # all groups are small: the fences of the corpus
        x = sorted(b[k] for _, b in passed)
        at = lambda q: x[math.ceil(q * len(x)) - 1]
        fence = 2 * at(0.99) - at(0.9)
        occupied = sorted(set(x))
        run = 0
        for a, b in zip(occupied, occupied[1:]):
            run = sum(v <= a for v in x)
            if b - a >= math.ceil(math.log(4) / math.log(1.02)) and run >= 0.75 * len(x):
                fence = min(fence, a)
                break
        limits.append(fence)
    inside = lambda b: all(v <= f for v, f in zip(b, limits))
    short = [d for d, m in told if 0 < m[0] < 50 and 100 * m[5] <= 50 * m[0] and inside(bins(m, -0.5))]
    return [d for d, b in passed if inside(b)] + short


def line_stage(docs):
    seen, out = [], []
    for d in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        left = []
        for line in d[1].split("\n"):
            s = shingles(line)
            match = bool(s) and any(alike(s, e) for e in seen)
            if s:
                seen.append(s)
            if not match:
                left.append(line)
        text = "\n".join(left)
        if text == d[1] or words(text):
            out.append((d[0], text, *d[2:]))
    return out


def near_stage(docs):
    sets = [shingles(d[1]) for d in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and alike(sets[i], sets[j]):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, d in enumerate(docs):
        groups[find(i)].append(d)
    return [min(g, key=lambda d: (d[0] is None, d[0] or 0)) for g in groups.values()]


def mix_stage(docs):
    size = Counter()
    for d in docs:
        size[d[3]] += len(words(d[1]))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(size.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = 2.0 * size[s]
            left -= target[s]
        open_ -= full
    out = []
    for d in docs:
        rate = target[d[3]] / size[d[3]] if size[d[3]] else 0.0
        name = "mix" + (str(d[0]) if d[0] is not None else d[1] or "")
        draw = int(hashlib.md5(name.encode()).hexdigest()[:13], 16) / 16 ** 13
        out += [d] * (math.floor(rate) + (draw < rate - math.floor(rate)))
    return out


def piece_stage(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = []
    for d in docs:
        ids = sp.encode(d[1] or "", add_bos=True, add_eos=True)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        out.append((d[0], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    return out


def corpus():
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n))
    text = lambda: "\n".join(line(r.randrange(6, 25)) for _ in range(r.randrange(4, 12)))
    shared = [line(20) for _ in range(4)]
    docs = []
    for i in range(160):
        t = text()
        if i % 5 == 0:
            t += "\n" + r.choice(shared)
        docs.append(t)
    for k in range(12):     # copies, near copies whose lines all differ a little, and ones with a changed line
        base = docs[k * 3]
        docs += [base, base.upper(), re.sub(r"\b(\w+)$", "changed", base), base + "\n" + line(8)]
        docs.append("\n".join(x + " " + word() + " " + word() if j % 2 else word() + " " + x for j, x in enumerate(base.split("\n"))))
    docs += ["#$% " + text().replace(" ", " # ") for _ in range(6)]
    docs += ["short but clean", "That*** atly.###", "one two three one two three one two three", "", None, "again and again " * 40, "x" * 30_000 + " " + text(), "Ünïcode 日本 " + text()]
    items = [(i, t, ("en", "fr", None)[i % 3], ("web", "book", None, "news")[i % 4], len(t or "")) for i, t in enumerate(docs)]
    return items + [(None, docs[7], "en", "web", 1), (None, text(), "en", "web", 1)]


def test_pipeline_equals_brute_force(spark):
    docs = corpus()
    folder = work_path(spark, "t-pipeline")
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    want, sizes = docs, [len(docs)]
    for stage in (quality_stage, line_stage, near_stage, mix_stage):
        want = stage(want)
        sizes.append(len(want))
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] and sizes[4] > sizes[3]     # every stage acts
    got = corpus_pipeline.run(spark, folder)
    assert srt(tuple(x) for x in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == srt(piece_stage(want))


def test_pipeline_of_an_empty_table_and_of_repeated_rows(spark):
    folder = work_path(spark, "t-pipeline-empty")
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
    again = work_path(spark, "t-pipeline-again")
    text = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) for i in range(8))
    spark.createDataFrame([(i, text, "en", "s", 1) for i in range(6)] * 2, DOCS).write.parquet(f"{again}/documents.parquet")
    # one text twice over: one document stays, taken once or twice by the mix
    assert 1 <= corpus_pipeline.run(spark, again).count() <= 2
    assert quality.MIN_GROUP > 12
