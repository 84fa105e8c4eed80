"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

Signatures: every shingle draws, from its own hash, a permutation of the ``M`` signature
places and a value in [j, j + 1) for the place at rank j; a place keeps the least value.
The ranks of an element are correlated (a permutation visits each place once), which lowers
the variance of the estimate, and a document stops as soon as all its places hold values
below the next rank. The ranks are drawn for all shingles of many documents at a time in
numpy; documents that are done leave the arrays.

Grouping: documents with equal shingle sets form a class by a 128-bit fingerprint, so exact
copies never meet. Class signatures are cut into ``BANDS`` bands; classes that agree in a
band join a cluster (union-find over one edge per member and band). At similarity 0.85 a
pair agrees in none of 32 bands of 4 with probability 6e-11. Within a cluster, links are
verified on the full sets: candidates come from the rarest shingles of each set (prefix
join), first with the most central set of each shingle, then for all pairs that are not
yet in one component. Groups of near copies cost about one pair per member, no pair of a
cluster is lost, and no group is ever gathered in one task or on the driver.

Defined results: a null or empty text has an empty set and is linked with nothing; rows
with equal ids and texts belong to one class and are all kept if its id is the least;
a null id never is the least when there is another, and a component of null ids alone has
component_id null and kept true; ids are not needed to be unique; very long texts count
whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm import setjoin
from clickflow.llm.common import discard, join_measured, packed, saved
from clickflow.llm.components import components
from clickflow.llm.shingles import fingerprints, hashed_texts, mixed, portions, shingle_sets

BANDS, ROWS = 32, 4
M = BANDS * ROWS
_U = np.uint64
#: Members of sets whose prefixes are cut at a time (a larger set is cut alone).
HELD = 1 << 19
#: Rank in the high bits of a signature value, the fraction below.
_RANK = _U(56)


def super_minhash(values: np.ndarray, owner: np.ndarray, n: int, m: int = M) -> np.ndarray:
    """Signatures (n x m, 64 bits: rank and fraction) of ``n`` sets given as hashes with their
    set; sets without members keep the largest value everywhere."""
    top = np.iinfo(np.uint64).max
    sig = np.full((n, m), top, dtype=np.uint64)
    flat = sig.reshape(-1)
    active, of = values, owner
    perm = None
    for j in range(m):
        if not len(active):
            break
        draw = mixed(active, 100 + 2 * j)
        k = j + (mixed(active, 101 + 2 * j) % _U(m - j)).astype(np.int64)
        rows = np.arange(len(active))
        if j == 0:
            place = k
            first = k
        else:
            if perm is None:  # most sets are done after the first rank: permutations start here
                perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(active), 1))
                perm[rows, first], perm[:, 0] = 0, first
            place = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[:, j]
        value = (_U(j) << _RANK) | (draw >> _U(8))
        np.minimum.at(flat, of * m + place, value)
        # done: every place has a value of this rank or a lower one
        owners = np.unique(of)
        open_ = np.zeros(n, dtype=bool)
        open_[owners] = (sig[owners] == top).any(axis=1)
        keep = open_[of]
        if not keep.all():
            active, of = active[keep], of[keep]
            first = first[keep] if perm is None else None
            perm = perm[keep] if perm is not None else None
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (n x BANDS); equal keys say equal values in the band."""
    cut = sig.reshape(len(sig), BANDS, ROWS)
    key = np.zeros((len(sig), BANDS), dtype=np.uint64)
    for r in range(ROWS):
        key = mixed(key ^ cut[:, :, r], 300 + r)
    return mixed(key + np.arange(BANDS, dtype=np.uint64)[None, :], 310).view(np.int64)


def _text_key() -> dict:
    """Two independent hashes of the text (null: empty)."""
    t = F.coalesce("text", F.lit(""))
    return {"k1": F.xxhash64(t), "k2": F.xxhash64(F.lit(1), t)}


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, n_shingles, f1, f2, bands) of every row of ``docs``; k1 and k2 tell its text."""
    import pyarrow as pa

    def signed(batches):
        for b in batches:
            at = 0
            for part in portions([t or b"" for t in b.column(3).cast(pa.binary()).to_pylist()], len):
                values, owner, sizes = shingle_sets(*hashed_texts(part))
                f1, f2 = fingerprints(values, owner, len(part))
                keys = band_keys(super_minhash(values, owner, len(part)))
                lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.reshape(-1)))
                told = [b.column(i).slice(at, len(part)) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*told, pa.array(sizes), pa.array(f1), pa.array(f2), lists],
                                                 names=["doc_id", "k1", "k2", "n_shingles", "f1", "f2", "bands"])
                at += len(part)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", *[e.alias(k) for k, e in _text_key().items()], "text").mapInArrow(
        signed, f"doc_id {kind}, k1 long, k2 long, n_shingles long, f1 long, f2 long, bands array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """(f1, f2, tokens, bits) of every row of ``docs``: its fingerprint, whole set and parity bits."""
    import pyarrow as pa

    def made(batches):
        for b in batches:
            for part in portions([t or b"" for t in b.column(0).cast(pa.binary()).to_pylist()], len):
                values, owner, sizes = shingle_sets(*hashed_texts(part))
                f1, f2 = fingerprints(values, owner, len(part))
                ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                bits = setjoin.parity_bits(values, owner, len(part)).reshape(-1)
                words = np.arange(0, len(bits) + 1, setjoin.WORDS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f1), pa.array(f2), pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64))),
                     pa.ListArray.from_arrays(words, pa.array(bits))], names=["f1", "f2", "tokens", "bits"])

    return docs.select("text").mapInArrow(made, "f1 long, f2 long, tokens array<long>, bits array<long>")


def _held(batch):
    """Slices of a batch (id, cluster, tokens) of about ``HELD`` tokens."""
    ends = np.cumsum(batch.column(2).value_lengths().to_numpy().astype(np.int64))
    cuts = np.r_[np.flatnonzero(np.diff(ends // HELD)) + 1, batch.num_rows]
    start = 0
    for end in cuts:
        yield batch.slice(start, end - start)
        start = end


def prefixes(sets: DataFrame, counts: np.ndarray, num: int, den: int) -> DataFrame:
    """(id, n, ts) of each set (id, cluster, tokens): its size and its rarest tokens; tokens of
    different clusters differ."""
    import pyarrow as pa

    shipped = sets.sparkSession.sparkContext.broadcast(counts)

    def cut(batches):
        counted = shipped.value
        for b in (part for batch in batches for part in _held(batch)):
            lists = b.column(2)
            values = lists.flatten().to_numpy().view(np.uint64)
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            values = values[setjoin.rarity_order(values, owner, counted)]
            place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            lengths = setjoin.prefix_size(sizes, num, den)
            keep = place < lengths[owner]
            group = b.column(1).to_numpy().astype(np.int64).view(np.uint64)[owner[keep]]
            tokens = mixed(values[keep] ^ mixed(group, 21), 22).view(np.int64)
            lists = pa.ListArray.from_arrays(np.r_[0, np.cumsum(lengths)].astype(np.int32), pa.array(tokens))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), lists], names=["id", "n", "ts"])

    return sets.select("id", "cluster", "tokens").mapInArrow(cut, "id long, n long, ts array<long>")


def _links(clustered: DataFrame, docs: DataFrame, num: int, den: int) -> DataFrame:
    """Verified links (u, v) between the classes of ``clustered`` (id, cluster, f1, f2, first)
    that connect all that are similar."""
    wanted = saved(clustered.select("first").distinct(), "near-wanted")
    texts = join_measured(docs, wanted, {"first": F.col("doc_id")}, "left_semi")
    sets = full_sets(texts).join(clustered.select("id", "cluster", "f1", "f2"), ["f1", "f2"])
    sets = saved(sets.select("id", "cluster", "tokens", "bits").dropDuplicates(["id"]), "near-sets")
    token = F.explode("tokens").alias("x")
    bucket = F.shiftrightunsigned("x", 20).bitwiseAND(F.lit(setjoin.BUCKETS - 1)).alias("bucket")
    counts = setjoin.gathered_sketch(sets.select(token).select(bucket, F.lit(1).alias("n")))
    postings = setjoin.shared_postings(prefixes(sets, counts, num, den), num, den)
    found = saved(setjoin.verified(setjoin.central_pairs(postings, num, den), sets, num, den)
                  .select(F.col("a").alias("u"), F.col("b").alias("v")), "near-links")
    known = saved(components(found), "near-known")
    labels = sets.select("id", "bits").join(known, F.col("id") == F.col("node"), "left").select(
        "id", "bits", F.coalesce("component", "id").alias("root"))
    labelled = postings.where("c > 2").join(labels, "id").select("t", "id", "n", "p", "c", "root", "bits")
    rest = setjoin.open_pairs(labelled, F.col("x_root") < F.col("y_root"), num, den)
    more = setjoin.verified(rest, sets, num, den).select(F.col("a").alias("u"), F.col("b").alias("v"))
    links = saved(found.unionByName(more), "near-links")
    discard(wanted, sets, postings, found, known)
    return links


def _grouped(docs: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Saved tables: (doc_id, k1, k2, n_shingles, f1, f2, bands) of every row, k1 and k2 telling its text,
    and (f1, f2, g) of every class of equal sets with its group."""
    signed = saved(signatures(docs), "near-signed")
    some = signed.where("n_shingles > 0")
    classes = some.groupBy("f1", "f2").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    classes = saved(classes.withColumn("id", F.monotonically_increasing_id()), "near-classes")
    keys = classes.select("id", F.explode("bands").alias("k"))
    heads = keys.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("m")).where("c > 1").select("k", "m")
    edges = keys.join(heads, "k").where("id <> m").select(F.col("id").alias("u"), F.col("m").alias("v"))
    clusters = components(edges)
    clustered = saved(classes.join(clusters, F.col("id") == F.col("node")).select(
        "id", F.col("component").alias("cluster"), "f1", "f2", "first"), "near-clustered")
    links = _links(clustered, docs, num, den)
    groups = saved(components(links), "near-groups")
    named = saved(classes.join(groups, F.col("id") == F.col("node"), "left").select(
        "f1", "f2", "first", F.coalesce("component", "id").alias("g")), "near-classed")
    discard(classes, clustered, links, groups)
    return signed, named


def near_duplicates(docs: DataFrame, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text):
    documents are linked from Jaccard num/den on and grouped by their links."""
    signed, classed = _grouped(docs, num, den)
    ids = classed.groupBy("g").agg(F.min("first").alias("component_id"))
    named = saved(classed.join(ids, "g").select("f1", "f2", "component_id"), "near-named")
    discard(classed)
    alone = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    together = join_measured(signed.where("n_shingles > 0"), named, ["f1", "f2"]).select("doc_id", "n_shingles", "component_id")
    return together.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group one row stays, that with the least
    id (a missing one last), then the least hash of its text; of equal rows one. Texts without
    words are linked with nothing and all stay."""
    signed, classed = _grouped(docs, num, den)
    rows = join_measured(signed.where("n_shingles > 0").select("doc_id", "k1", "k2", "f1", "f2"), classed.select("f1", "f2", "g"), ["f1", "f2"])
    told = rows.groupBy("g", "doc_id", "k1", "k2").agg(F.count(F.lit(1)).alias("times"))   # equal rows as one
    key = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "k1", "k2")
    best = told.groupBy("g").agg(F.min(key).alias("best"), F.count(F.lit(1)).alias("rows"), F.max("times").alias("most"))
    best = saved(best.where("rows > 1 or most > 1").select("g", "best"), "near-best")
    judged = told.join(best, "g").withColumn("stays", key == F.col("best")).where("not stays or times > 1")
    verdicts = saved(judged.select("doc_id", "k1", "k2", "stays"), "near-kept")
    discard(signed, classed, best)
    whole = packed(docs, _id=F.col("doc_id"), **{f"_{k}": e for k, e in _text_key().items()})
    marked = join_measured(whole, verdicts, {"doc_id": F.col("_id"), "k1": F.col("_k1"), "k2": F.col("_k2")})
    once = marked.where("stays is null").select("_row.*")
    again = marked.where("stays").dropDuplicates(["_id", "_k1", "_k2"]).select("_row.*")
    return once.unionByName(again)
