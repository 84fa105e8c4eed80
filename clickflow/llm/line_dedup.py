"""Line dedup by an exact set-similarity join.

A line's tokens are its distinct word shingles (five words, A-Z lower-cased; a shorter line
is one token). A line goes when an earlier line, by (doc_id, line number), has Jaccard
similarity num/den or more with it. Lines with equal token sets form a class by a 128-bit
fingerprint: all but the first of a class go at once. The first lines meet in a
set-similarity join (``setjoin``): tokens in order of rarity, prefix, length and positional
filters, then verification on the full sets. The join first compares each token's most
central line with the others; lines that this removes are closed, and only pairs whose
later line is still open are compared after that. So a group of copies costs about one
pair per line, and no match is lost.

Shingles instead of single words keep the join linear: a vocabulary is finite, so lists of
lines by word grow with the corpus, while lists by shingle grow with actual repetition.

No text is shuffled unless the lists of removed lines outgrow the broadcast limit; classes
are reduced map-side, so a line that makes up a third of all lines is one row per task.

Documents are in order of their ids; where ids repeat or are missing, each different text is a
document of its own, in order of id (missing ones last) and text hash.

Defined results: lines without words are never removed; a null or empty text stays as it
is; rows that repeat an id and a text are one document told more than once and are treated
alike; long lines and texts count whole; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm import setjoin
from clickflow.llm.common import WORD, discard, join_measured, packed, ranked, saved
from clickflow.llm.shingles import fingerprints, hashed_lines, pieces, portions, shingle_sets


def _lines(batch, inside: bool = True):
    """Portions of the lines with words of a batch (id, text, and line numbers if there are
    three columns): (ids, line numbers, word hashes, words per line). The line numbers are
    the lines to read, or those to leave out (``inside`` false); null stands for none."""
    import pyarrow as pa

    batch = batch.filter(batch.column(0).is_valid())
    keys = batch.column(0).to_numpy()
    chosen = None
    if batch.num_columns > 2:
        lists = batch.column(2)
        of = np.repeat(np.arange(len(keys)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        chosen = (of << 32) | lists.flatten().to_numpy().astype(np.int64)
    texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
    for part in portions(pieces(texts), lambda p: len(p[2])):
        words, sizes, of, at = hashed_lines([p[2] for p in part])
        text, first = (np.array([p[k] for p in part], dtype=np.int64)[of] for k in (0, 1))
        at = at + first
        take = sizes > 0
        if chosen is not None:
            take &= np.isin((text << 32) | at, chosen, invert=not inside)
        if not take.all():
            words, sizes, text, at = words[np.repeat(take, sizes)], sizes[take], text[take], at[take]
        if len(sizes):
            yield keys[text], at, words, sizes


def _told(docs: DataFrame) -> list:
    """Id and text hashes of each row: what tells documents apart."""
    text = F.coalesce("text", F.lit(""))
    return [F.col("doc_id").cast("long").alias("i"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` with ``_d``, a number per document in order, and whether each row has one of its own. It
    is the id where every row has an id of its own (one look at that column); else the rank of id and
    text hash."""
    ids = docs.select(F.col("doc_id").cast("long").alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("c"))
    if ids.where("i is null or c > 1").limit(1).isEmpty():
        return docs.withColumn("_d", F.col("doc_id").cast("long")), True
    order = [F.col("i").isNull(), F.coalesce("i", F.lit(0)), F.col("k1"), F.col("k2")]
    keys = saved(ranked(docs.select(*_told(docs)).distinct(), order, "line-ranked", "_d").select("i", "k1", "k2", "_d"), "line-keys")
    return join_measured(docs, keys, dict(zip(("i", "k1", "k2"), _told(docs), strict=True))), False


def line_classes(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """A saved table of all lines with words (d, l, f1, f2, n; bucket null) and the count sketch
    of their tokens, from one pass over the texts."""
    import pyarrow as pa

    names = ["d", "l", "f1", "f2", "n", "bucket"]

    def read(batches):
        sketch = np.zeros(setjoin.BUCKETS, dtype=np.int64)
        for b in batches:
            for d, at, words, lengths in _lines(b):
                values, owner, sizes = shingle_sets(words, lengths)
                f1, f2 = fingerprints(values, owner, len(sizes))
                sketch += np.bincount(setjoin.bucket_of(values), minlength=setjoin.BUCKETS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d), pa.array(at.astype(np.int32)), pa.array(f1), pa.array(f2), pa.array(sizes),
                     pa.nulls(len(sizes), pa.int32())], names=names)
        used = np.flatnonzero(sketch)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.nulls(len(used), pa.int32()), none, none, pa.array(sketch[used]),
                                          pa.array(used.astype(np.int32))], names=names)

    rows = saved(docs.select("_d", "text").mapInArrow(
        read, "d long, l int, f1 long, f2 long, n long, bucket int"), "line-rows")
    counts = setjoin.gathered_sketch(rows.where("bucket is not null").select("bucket", "n"))
    return rows, counts


def _first_prefixes(docs: DataFrame, later: DataFrame, counts: np.ndarray, num: int, den: int) -> DataFrame:
    """(id, n, ts) of the first line of each class: its (d, l), size and prefix of rare tokens."""
    import pyarrow as pa

    shipped = docs.sparkSession.sparkContext.broadcast(counts)
    skipped = saved(later.groupBy(F.col("d").alias("doc")).agg(F.collect_set("l").alias("skip")), "line-later")
    rows = join_measured(docs.select("_d", "text"), skipped, {"doc": F.col("_d")})

    def cut(batches):
        rank = setjoin.rarity_rank(shipped.value)
        for b in batches:
            for d, at, words, lengths in _lines(b, inside=False):
                values, owner, sizes = shingle_sets(words, lengths, rank)
                place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                prefix = setjoin.prefix_size(sizes, num, den)
                ends = np.r_[0, np.cumsum(prefix)].astype(np.int32)
                rare = pa.array(values[place < prefix[owner]].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d), pa.array(at.astype(np.int32)), pa.array(sizes.astype(np.int32)),
                     pa.ListArray.from_arrays(ends, rare)], names=["d", "l", "n", "ts"])

    made = rows.select("_d", "text", "skip").mapInArrow(cut, "d long, l int, n int, ts array<long>")
    return made.select(F.struct("d", "l").alias("id"), "n", "ts")


def _sets(docs: DataFrame, lines: DataFrame, alone: bool) -> DataFrame:
    """A saved table of the full sets (id, tokens, bits) of the lines in ``lines`` (id)."""
    import pyarrow as pa

    wanted = saved(lines.groupBy(F.col("id.d").alias("doc")).agg(F.collect_set("id.l").alias("lines")), "line-wanted")
    rows = join_measured(docs.select("_d", "text"), wanted, {"doc": F.col("_d")}, "inner")

    def made(batches):
        for b in batches:
            for d, at, words, lengths in _lines(b):
                values, owner, sizes = shingle_sets(words, lengths)
                ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                bits = setjoin.parity_bits(values, owner, len(sizes)).reshape(-1)
                steps = np.arange(0, len(bits) + 1, setjoin.WORDS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d), pa.array(at.astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64))),
                     pa.ListArray.from_arrays(steps, pa.array(bits))], names=["d", "l", "tokens", "bits"])

    got = rows.select("_d", "text", "lines").mapInArrow(made, "d long, l int, tokens array<long>, bits array<long>")
    sets = got.select(F.struct("d", "l").alias("id"), "tokens", "bits")
    # one set per line, however often its document is told; with ids of their own nothing is shuffled
    return saved(sets if alone else sets.dropDuplicates(["id"]), "line-sets")


def removed_lines(docs: DataFrame, num: int = 80, den: int = 100, alone: bool = False) -> DataFrame:
    """(d, l) of every line of ``docs`` (text and ``_d`` of ``numbered``) that matches an earlier one."""
    rows, counts = line_classes(docs)
    lines = rows.where("bucket is null")
    repeated = lines.groupBy("f1", "f2").agg(F.min(F.struct("d", "l")).alias("first"), F.count(F.lit(1)).alias("c")) \
        .where("c > 1").select("f1", "f2", "first")
    # written, so that the join has plain shuffles on both sides and a line that is everywhere can be split
    repeated = saved(repeated, "line-repeated")
    later = join_measured(lines, repeated, ["f1", "f2"], "inner").where("struct(d, l) <> first").select("d", "l")
    later = saved(later if alone else later.distinct(), "line-copies")
    postings = setjoin.shared_postings(_first_prefixes(docs, later, counts, num, den), num, den)
    sets = _sets(docs, postings.select("id").distinct(), alone)
    central = saved(setjoin.central_pairs(postings, num, den), "line-central")
    gone = saved(setjoin.verified(central, sets, num, den).select("b").distinct(), "line-gone")
    labels = sets.select("id", "bits").join(gone.select(F.col("b").alias("id"), F.lit(True).alias("gone")), "id", "left")
    rest = setjoin.open_pairs(postings.where("c > 2").join(labels, "id"), F.col("y_gone").isNull() & (F.col("x_id") < F.col("y_id")), num, den)
    more = setjoin.verified(rest.join(central, ["a", "b"], "left_anti"), sets, num, den).select("b")
    near = gone.unionByName(more).distinct().select("b.d", "b.l")
    removed = saved(later.unionByName(near), "line-removed")
    discard(rows, repeated, later, postings, sets, central, gone)
    return removed


def dedup_lines(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` in ``_row``, with ``_text`` (the text without the removed lines),
    ``_lines`` and ``_removed`` (numbers of lines)."""
    told, alone = numbered(packed(docs, doc_id=F.col("doc_id"), text=F.col("text")))
    removed = removed_lines(told, num, den, alone)
    gone = removed.groupBy(F.col("d").alias("doc")).agg(F.collect_set("l").alias("_gone"))
    rows = told.select("_row", "_d", F.col("text").alias("_t"))
    rows = join_measured(rows, saved(gone, "line-lists"), {"doc": F.col("_d")})
    discard(removed)
    split = F.split("_t", "\n")
    lines = F.octet_length("_t") - F.octet_length(F.replace("_t", F.lit("\n"), F.lit(""))) + 1
    left = F.array_join(F.filter(split, lambda x, i: ~F.array_contains("_gone", i)), "\n")
    return rows.select("_row", F.when(F.col("_gone").isNull() | F.col("_t").isNull(), F.col("_t")).otherwise(left).alias("_text"),
                       F.coalesce(lines, F.lit(0)).cast("long").alias("_lines"),
                       F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("_removed"))


def without_repeated_lines(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``. Documents that lose all their words
    (complete copies of earlier text) are dropped; the others keep every column."""
    made = dedup_lines(docs, num, den).where((F.col("_removed") == 0) | F.col("_text").rlike(WORD))
    return made.select(*[F.col("_text").alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
