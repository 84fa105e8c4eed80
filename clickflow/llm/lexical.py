"""Ranked lexical search by scanning documents with an Aho-Corasick automaton.

The terms of the items (the stated queries) form one automaton. Every term stands in it
between two guards, and a text is scanned with all its separators turned into guards, so a
match is a whole term and never a part of a longer one. The scan counts term frequencies
straight from the text; there is no index of the documents. Each output of the automaton
maps to the items that hold the term, and so to their scores.

Items are dealt to blocks whose terms take at most ``TERM_BYTES`` (measured; an item with
more is a block of its own), so the automaton and what is shipped with it stay bounded
whatever the number of items. Each block reads the texts once and keeps per document its
length and the terms found; document frequencies are sums over these. The second step scores in
integers and keeps the ``k`` best of each item per task; they are merged in two steps, first among
groups of tasks, then per item.

Defined results: a null text has no terms; documents without terms are not counted; items
without terms get no rows; rows that share an item_id (null included) are one item with the
terms of all of them, repeats counted; each row of the documents is a document, so a repeated one is
ranked as often as it stands; equal scores go to the smaller doc_id, null last; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import discard, saved

#: A term: a run of ASCII letters, digits and characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of the terms of one block of items (an automaton takes about 60 times as much).
TERM_BYTES = 4 << 20
#: Scores (documents by items) that a task holds at a time, and (document, item) additions made at a time.
CELLS = 1 << 18
#: Bytes of texts that are scanned at a time.
PIECE = 1 << 21
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RESULT = "item_id long, rank int, doc_id long, score long"


def _guarded() -> bytes:
    """What each byte of a text becomes: letters in lower case, separators the guard (a space)."""
    word = [chr(c).isalnum() or c >= 128 for c in range(256)]
    return bytes((ord(chr(c).lower()) if c < 128 else c) if word[c] else 32 for c in range(256))


GUARDED = _guarded()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of all items (item_id, text)."""
    low = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    terms = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(low, F.lit(TERM), 0)).alias("term"))
    return terms.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("item_id"), F.lit(blocks))


def _blocks(asked: DataFrame, limit: int) -> int:
    """So many blocks that each has at most ``limit`` bytes of terms or a single item."""
    blocks = 1
    while True:
        size = asked.groupBy(_block(blocks).alias("b")).agg(
            F.sum(F.octet_length("term") + 8).alias("bytes"), F.min("item_id").eqNullSafe(F.max("item_id")).alias("one"))
        over = size.where((F.col("bytes") > limit) & ~F.col("one")).agg(F.max("bytes")).first()[0]
        if over is None:
            return blocks
        blocks *= 2


class Scanner:
    """Term frequencies of texts, for the given terms."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, term in enumerate(terms):
            # bytes as Latin-1 characters: one state per byte, one unit per byte of the text
            self.automaton.add_word(f" {term.encode().decode('latin-1')} ", i)
        if terms:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[int, np.ndarray]:
        """Number of terms of a text, and the place in ``terms`` of every occurrence."""
        low = text.translate(GUARDED)
        if not len(self.automaton):
            return len(low.split()), np.zeros(0, dtype=np.int64)
        return len(low.split()), np.fromiter((i for _, i in self.automaton.iter(f" {low.decode('latin-1')} ")), dtype=np.int64)


def _slices(batch):
    """Runs of rows of a batch with about ``PIECE`` bytes of text."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0)).astype(np.int64)
    run = (np.cumsum(sizes) - sizes) // PIECE
    cuts = np.r_[np.flatnonzero(np.r_[True, run[1:] != run[:-1]]), len(sizes)] if len(sizes) else np.zeros(1, dtype=np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield batch.slice(a, b - a)


def _scan(docs: DataFrame, terms) -> DataFrame:
    """(doc_id, n, terms, times) of every document with terms; ``terms`` is a broadcast."""
    import pyarrow as pa

    def scanned(batches):
        scanner = Scanner(terms.value)
        width = max(1, len(terms.value))
        for batch in (part for whole in batches for part in _slices(whole)):
            told = [scanner.scan(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
            n = np.array([t[0] for t in told], dtype=np.int64)
            sizes = np.array([len(t[1]) for t in told], dtype=np.int64)
            pairs, times = np.unique(np.repeat(np.arange(len(told)), sizes) * width + np.concatenate([t[1] for t in told]), return_counts=True)
            ends = pa.array(np.r_[0, np.cumsum(np.bincount(pairs // width, minlength=len(told)))].astype(np.int32))
            made = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.ListArray.from_arrays(ends, pa.array((pairs % width).astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int64)))], names=["doc_id", "n", "terms", "times"])
            yield made.filter(pa.array(n > 0))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(scanned, "doc_id long, n long, terms array<int>, times array<long>")


class Best:
    """The ``k`` highest scores of each item so far; ties to smaller ids, missing ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.zeros(items, dtype=np.int64)
        self.held = [np.zeros(0, dtype=np.int64) for _ in range(4)]  # item, score, no id, id

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        doc, item = np.nonzero((scores > 0) & (scores >= self.least))
        new = (item, scores[doc, item], missing[doc], ids[doc])
        item, score, none, at = self.held = [np.concatenate(x) for x in zip(self.held, new, strict=True)]
        order = np.lexsort((at, none, -score, item))
        item = item[order]
        first = np.searchsorted(item, item)
        order = order[np.arange(len(item)) - first < self.k]
        self.held = [x[order] for x in self.held]
        full, count = np.unique(self.held[0], return_counts=True)
        last = np.cumsum(count) - 1
        self.least[full[count == self.k]] = self.held[1][last[count == self.k]]


def scored(n, sizes, terms, times, weights, total, words, starts, items, repeats, width) -> np.ndarray:
    """Scores (documents by items) of documents with the given lengths and terms found."""
    doc = np.repeat(np.arange(len(n)), sizes)
    m = 75 + (25 * n * total) // words
    value = weights[terms] * ((1_000_000_000 * times) // (1000 * times + 12 * m[doc]))
    out = np.zeros(len(n) * width, dtype=np.int64)
    fan = starts[terms + 1] - starts[terms]
    ends = np.cumsum(fan)
    a = 0
    while a < len(terms):  # so many terms that their items stay within CELLS
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CELLS, "right")))
        f = fan[a:b]
        at = np.repeat(starts[terms[a:b]] - (np.cumsum(f) - f), f) + np.arange(f.sum())
        np.add.at(out, np.repeat(doc[a:b] * width, f) + items[at], np.repeat(value[a:b], f) * repeats[at])
        a = b
    return out.reshape(len(n), width)


def _best(hits: DataFrame, shipped, k: int) -> DataFrame:
    """(item, doc_id, score): the ``k`` best documents of each item in each task."""
    import pyarrow as pa

    def judged(batches):
        ids, weights, total, words, starts, items, repeats = shipped.value
        best, step = Best(len(ids), k), max(1, CELLS // max(1, len(ids)))
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                doc, terms, times = batch.column(0), batch.column(2), batch.column(3)
                sizes = np.diff(np.asarray(terms.offsets))
                best.add(scored(np.asarray(batch.column(1)), sizes, np.asarray(terms.flatten()).astype(np.int64), np.asarray(times.flatten()),
                                weights, total, words, starts, items, repeats, len(ids)),
                         np.asarray(doc.fill_null(0)), np.asarray(doc.is_null()).astype(np.int64))
        item, score, none, at = best.held
        yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in item], pa.int64()), pa.array(at, mask=none.astype(bool)), pa.array(score)],
                                         names=["item_id", "doc_id", "score"])

    return hits.mapInArrow(judged, "item_id long, doc_id long, score long")


def _search_block(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The best documents per task for the items of one block (bounded by ``TERM_BYTES``)."""
    spark = docs.sparkSession
    rows = asked.collect()
    terms = sorted({r["term"] for r in rows})
    ids = sorted({r["item_id"] for r in rows}, key=lambda i: (i is None, i))
    hits = saved(_scan(docs, spark.sparkContext.broadcast(terms)), "lexical-hits")
    total, words = hits.agg(F.count(F.lit(1)), F.sum("n")).first()
    held = dict(hits.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect())
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(terms))], dtype=np.int64)
    place, number = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(ids)}
    mapped = np.array(sorted((place[r["term"]], number[r["item_id"]], r["times"]) for r in rows), dtype=np.int64).reshape(-1, 3)
    starts = np.searchsorted(mapped[:, 0], np.arange(len(terms) + 1))
    made = _best(hits, spark.sparkContext.broadcast((ids, weights, total, words, starts, mapped[:, 1], mapped[:, 2])), k)
    groups = max(1, math.isqrt(hits.rdd.getNumPartitions()))
    near = saved(made.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(groups))), "lexical-best")
    discard(hits)
    return near


def search(docs: DataFrame, items: DataFrame, k: int = 20, limit: int = TERM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents (doc_id, text) of each item
    (item_id, text) with a score above 0."""
    asked = saved(item_terms(items), "lexical-items")
    blocks = _blocks(asked, limit)
    out = docs.sparkSession.createDataFrame([], _RESULT)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for b in range(blocks):
        near = _search_block(docs, asked.where(_block(blocks) == b), k)
        group = near.withColumn("r", F.row_number().over(Window.partitionBy("item_id", "g").orderBy(*order))).where(F.col("r") <= k)
        best = group.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
        out = out.unionByName(best.select("item_id", "rank", "doc_id", "score"))
    discard(asked)
    return out
