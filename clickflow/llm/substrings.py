"""Removal of repeated passages by seed and extend.

A window is ``WIDTH`` consecutive words of one text. It is repeated if its words also start
anywhere else, in any text. All words of repeated windows go.

Seeds are winnowed anchors: of the ``WIDTH - SEED + 1`` runs of ``SEED`` words in a window the one with
the least hash (the last of equal ones) is its anchor. Equal windows choose equal anchors
at the same place, so a repeated window always has an anchor that stands twice. Texts are joined on
their anchors; what an anchor that stands once covers is done. Every other seed is extended both
ways, over the words of all the windows that chose it (at most WIDTH - SEED on either side):

* places whose extended seeds are equal as a whole match there completely. They are counted
  by the hash of the extension, so thousands of copies are one class and never pairs;
* one place of each different extension of an anchor is extended again, now to every split of
  ``WIDTH`` words around the seed, and equal extensions are counted. Those that stand twice are matches.

Neighbouring matches merge to maximal repeats: spans of at least ``WIDTH`` words all of whose
windows are repeated. Windows are judged on the input, not on what is left. Equal words are told
by 128 bits of hash.

Everything is grouped by hash with map-side counts; lists of anchors and classes are
broadcast up to 64 MB measured, else shuffled, where adaptive execution splits hot keys. Texts stream
through Arrow batches in pieces of about ``PIECE`` bytes that overlap by WIDTH - 1 words, so
memory does not follow the longest text. What later steps read again is written to the shared folder.

Defined results: a null text has no words; a text shorter than a window loses nothing; rows with
equal texts are copies whatever their ids (null and repeated ids included) and lose what any other copy
loses; extra columns stay in ``_row`` and cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from clickflow.llm.common import discard, join_measured, packed, saved
from clickflow.llm.shingles import mixed, portions

#: Words of a window and of a seed.
WIDTH, SEED = 35, 10
#: Bytes of texts that are hashed at a time.
PIECE = 1 << 21
_U = np.uint64
_LOW = _U(0xFFFFFFFF)
_BASES = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Masks of the first 0 to 8 bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def text_key() -> list[Column]:
    """Two independent hashes of ``text`` (null: empty), by which equal texts meet."""
    t = F.coalesce("text", F.lit(""))
    return [F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(1), t).alias("k2")]


def pieces(text: bytes, width: int, limit: int = 0):
    """(number of its first word, bytes) of pieces of a text of about ``limit`` bytes; each
    starts with the last width - 1 words of the one before."""
    at, first, limit = 0, 0, limit or PIECE
    size = limit
    while len(text) - at > size:
        gap = _GAP.search(text, at + size)
        end = gap.start() if gap else len(text)
        part = text[at:end]
        tail = part.rsplit(None, width - 1)
        if len(tail) < width or end == len(text):  # few words this long: take more of the text
            size *= 2
            continue
        yield first, part
        first += len(part.split()) - (width - 1)
        at, size = at + len(tail[0]), limit
    yield first, text[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent hashes of every word in order, and the words of each text."""
    raw = np.frombuffer(b"\n".join([b"", *texts]) + b"\n" * 8, dtype=np.uint8)
    space = _SPACE[raw]
    cuts = np.flatnonzero(space[1:] != space[:-1]) + 1  # words begin and end in turn
    starts, length = cuts[0::2], cuts[1::2] - cuts[0::2]
    eight = np.ndarray(len(raw) - 7, dtype="<u8", buffer=raw, strides=(1,))
    seed = (length.astype(np.uint64) * _U(_BASES[0])) ^ (eight[starts] & _FIRST[np.minimum(length, 8)])
    both = [mixed(seed, 21), mixed(seed, 22)]
    k, at = 8, np.flatnonzero(length > 8)
    while len(at):
        more = eight[starts[at] + k] & _FIRST[np.minimum(length[at] - k, 8)]
        for h, salt in zip(both, (21, 22), strict=True):
            h[at] = mixed(h[at] ^ more, salt)
        k += 8
        at = at[length[at] > k]
    ends = np.cumsum([len(t) + 1 for t in texts])
    sizes = np.diff(np.r_[0, np.searchsorted(starts, ends)])
    return both[0], both[1], sizes


class Spans:
    """Hashes of any span of a sequence of words, from sums of hashes times powers."""

    def __init__(self, words: np.ndarray, base: int):
        n = len(words)
        inverse = pow(base, -1, 1 << 64)
        self.back = np.cumprod(np.r_[_U(1), np.full(n, inverse, dtype=np.uint64)])
        up = np.cumprod(np.r_[_U(1), np.full(max(0, n - 1), base, dtype=np.uint64)])[:n]
        self.sums = np.r_[_U(0), np.cumsum(words * up)]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]


def window_places(sizes: np.ndarray, width: int) -> np.ndarray:
    """Where the windows of all texts start, in the sequence of all their words."""
    total = int(sizes.sum())
    place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.flatnonzero(place + width <= np.repeat(sizes, sizes))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    reach = 1
    while reach * 2 <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[:len(x) - (width - reach)], x[width - reach:]) if width > reach else x


def seeds(texts: list[bytes], width: int, seed: int) -> tuple[np.ndarray, ...]:
    """Anchors of the texts: (text, anchor hash, two hashes of the extension, first and last
    window that chose it), windows counted in the sequence of all words of ``texts``."""
    first, second, sizes = word_hashes(texts)
    windows = window_places(sizes, width)
    if not len(windows):
        return (np.zeros(0, dtype=np.int64),) * 6
    one, two = Spans(first, _BASES[0]), Spans(second, _BASES[1])
    runs = np.arange(len(first) - seed + 1)
    gram = mixed(one.of(runs, runs + seed), 23)
    # the last of equal hashes wins: 32 bits of hash before the place
    least = sliding_min((gram & ~_LOW) | (_LOW - runs.astype(np.uint64)), width - seed + 1)
    chosen = (_LOW - (least[windows] & _LOW)).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (windows[1:] != windows[:-1] + 1)])
    lo, hi, anchor = windows[cut], windows[np.r_[cut[1:], len(windows)] - 1], chosen[cut]
    shape = ((anchor - lo) * width + (hi - lo)).astype(np.uint64)
    ends = np.cumsum(sizes)
    return (np.searchsorted(ends, lo, "right"), gram[anchor].view(np.int64), mixed(one.of(lo, hi + width) ^ shape, 24).view(np.int64),
            mixed(two.of(lo, hi + width) + shape, 25).view(np.int64), lo, hi)


def _cut(batch, column: int, width: int):
    """(row, number of the first word, bytes) of all pieces of the texts of a batch."""
    import pyarrow as pa

    for i, t in enumerate(batch.column(column).cast(pa.binary()).to_pylist()):
        for first, part in pieces(t or b"", width):
            yield i, first, part


def _anchors(keyed: DataFrame, width: int, seed: int) -> DataFrame:
    """(k1, k2, a, c1, c2, lo, hi) of every anchor of every text."""
    import pyarrow as pa

    def sown(batches):
        for batch in batches:
            for held in portions(_cut(batch, 2, width), lambda x: len(x[2]), PIECE):
                of, a, c1, c2, lo, hi = seeds([x[2] for x in held], width, seed)
                row = np.array([x[0] for x in held], dtype=np.int64)[of]
                sizes = word_counts([x[2] for x in held])
                shift = np.array([x[1] for x in held], dtype=np.int64) - (np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(a), pa.array(c1), pa.array(c2),
                     pa.array(lo + shift[of]), pa.array(hi + shift[of])], names=["k1", "k2", "a", "c1", "c2", "lo", "hi"])

    return keyed.mapInArrow(sown, "k1 long, k2 long, a long, c1 long, c2 long, lo long, hi long")


def _extended(keyed: DataFrame, width: int) -> DataFrame:
    """(k1, k2, w1, w2, p, alone) of the windows of each place in the column ``open``."""
    import pyarrow as pa

    def grown(batches):
        for batch in batches:
            asked = [[(x["lo"], x["hi"], x["alone"]) for x in r] for r in batch.column(3).to_pylist()]
            for held in portions(_cut(batch, 2, width), lambda x: len(x[2]), PIECE):
                first, second, sizes = word_hashes([x[2] for x in held])
                one, two = Spans(first, _BASES[0]), Spans(second, _BASES[1])
                begin = np.cumsum(sizes) - sizes
                rows, places, starts, alone = [], [], [], []
                for (row, number, _), size, at in zip(held, sizes.tolist(), begin.tolist(), strict=True):
                    for lo, hi, single in asked[row]:
                        p = np.arange(max(lo, number), min(hi, number + size - width) + 1)
                        rows.append(np.full(len(p), row))
                        places.append(p)
                        starts.append(p - number + at)
                        alone.append(np.full(len(p), single))
                if not rows:
                    continue
                row, start = np.concatenate(rows).astype(np.int64), np.concatenate(starts).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(one.of(start, start + width).view(np.int64)),
                     pa.array(two.of(start, start + width).view(np.int64)), pa.array(np.concatenate(places).astype(np.int64)),
                     pa.array(np.concatenate(alone).astype(bool))], names=["k1", "k2", "w1", "w2", "p", "alone"])

    return keyed.mapInArrow(grown, "k1 long, k2 long, w1 long, w2 long, p long, alone boolean")


def word_counts(texts: list[bytes]) -> np.ndarray:
    return np.array([len(t.split()) for t in texts], dtype=np.int64)


def repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED, limit: int | None = None) -> DataFrame:
    """(k1, k2, spans): the maximal repeats (start, end), in words, of each text that has any,
    by its key. A saved table."""
    bound = {} if limit is None else {"limit": limit}
    keyed = docs.select(*text_key(), F.coalesce("text", F.lit("")).alias("text"))
    anchors = saved(_anchors(keyed, width, seed), "repeat-anchors")
    shared = saved(anchors.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a"), "repeat-shared")
    held = saved(join_measured(anchors, shared, ["a"], "left_semi", **bound), "repeat-held")
    discard(anchors, shared)
    # equal extensions: one class each
    classes = saved(held.groupBy("a", "c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "lo", "hi")).alias("at")), "repeat-classes")
    many = saved(classes.where("n > 1").select("a", "c1", "c2"), "repeat-many")
    complete = join_measured(held, many, ["a", "c1", "c2"], "left_semi", **bound).select("k1", "k2", "lo", "hi")
    # different extensions of one anchor: every split around the seed
    several = saved(classes.groupBy("a").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("a"), "repeat-several")
    open_ = join_measured(classes, several, ["a"], "left_semi", **bound).select("at.*", (F.col("n") == 1).alias("alone"))
    lists = saved(open_.groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi", "alone")).alias("open")), "repeat-open")
    grown = saved(_extended(join_measured(keyed, lists, ["k1", "k2"], "inner", **bound), width), "repeat-windows")
    again = saved(grown.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"), F.max("alone").alias("alone"))
                  .where("n > 1 and alone").select("w1", "w2"), "repeat-again")
    partial = join_measured(grown.where("alone"), again, ["w1", "w2"], "left_semi", **bound).select("k1", "k2", F.col("p").alias("lo"), F.col("p").alias("hi"))
    runs = complete.unionByName(partial).distinct().groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("found"))
    made = saved(_merged(runs, width), "repeat-spans")
    discard(held, classes, many, several, lists, grown, again)
    return made


#: Maximal repeats of a text, in words.
SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))


def merged(found: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
    """Maximal repeats as (first word, end) from runs of repeated windows in order."""
    out: list[tuple[int, int]] = []
    for lo, hi in found:
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi + width))
        else:
            out.append((lo, hi + width))
    return out


def _span_array(spans: list[list[tuple[int, int]]]):
    import pyarrow as pa

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], kind)


def _merged(runs: DataFrame, width: int) -> DataFrame:
    """(k1, k2, spans) of (k1, k2, found): neighbouring and overlapping runs as one repeat."""
    import pyarrow as pa

    def joined(batches):
        for batch in batches:
            spans = [merged([(x["lo"], x["hi"]) for x in f], width) for f in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _span_array(spans)], names=["k1", "k2", "spans"])

    return runs.select("k1", "k2", "found").mapInArrow(joined, StructType([StructField("k1", LongType()), StructField("k2", LongType()), StructField("spans", SPANS)]))


def without_repeats(docs: DataFrame, width: int = WIDTH, seed: int = SEED, limit: int | None = None) -> DataFrame:
    """(_row, n_words, spans, kept) of each row of ``docs`` (text and any other columns): the row,
    its number of words, its maximal repeats as (start, end) in words, and the words that are
    left, joined by one space."""
    import pyarrow as pa

    found = repeats(docs, width, seed, limit)
    k1, k2 = text_key()
    keyed = packed(docs, _k1=k1, _k2=k2, _text=F.coalesce("text", F.lit("")))
    bound = {} if limit is None else {"limit": limit}
    told = join_measured(keyed, found, {"k1": F.col("_k1"), "k2": F.col("_k2")}, **bound).select("_row", "_text", "spans")

    def stripped(batches):
        for batch in batches:
            n, kept = [], []
            spans = [[(x["start"], x["end"]) for x in s or ()] for s in batch.column(2).to_pylist()]
            for text, gone in zip(batch.column(1).cast(pa.binary()).to_pylist(), spans, strict=True):
                words = text.split()
                n.append(len(words))
                for a, b in reversed(gone):
                    del words[a:b]
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), _span_array(spans), pa.array(kept, pa.binary()).cast(pa.string())],
                                             names=["_row", "n_words", "spans", "kept"])

    return told.mapInArrow(stripped, StructType([told.schema["_row"], StructField("n_words", LongType()), StructField("spans", SPANS),
                                                 StructField("kept", StringType())]))
