"""Exact set-similarity join (Jaccard) by rarity order, prefix, length and positional filters.

Each set's tokens are ordered by rarity, the rarest first. Two sets of similarity t can only
match when they share a token within the larger one's prefix of n - ceil(t n) + 1 tokens and the smaller
one's index prefix of n - ceil(2 t / (1 + t) n) + 1 (of equally large ones the lesser id counts as the smaller). Sets that
have most of a template in common but too little to match so share no token there: what differs
is rarer and fills the index prefix. Rarity comes from a count sketch of ``BUCKETS`` counters filled from all sets; any order that is
the same for all sets gives exact results, so collisions in the sketch cost time only.

Postings (token, set, size, position) of tokens that one set alone holds, or that no set has in its
index prefix, are dropped after one count. The rest is joined in two steps: first each token's most central set (the one
with the fewest rarer tokens) with the token's other sets, then, once the callers have
merged or removed what that finds, whatever pairs are still open and whose parity bits
differ in few enough places (an exact filter). Groups of copies so cost
one pair per member instead of all pairs, and no pair is lost. A token that two sets hold is
done after the first step, as its only pair is that of the central set and the other. Candidates are verified on
the full sets. All joins are plain shuffled ones, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import discard, join_measured, saved

BUCKETS = 1 << 16
#: 64-bit words of a set's parity bits.
WORDS = 8


def bucket_of(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)


def gathered_sketch(rows: DataFrame) -> np.ndarray:
    """The counters of ``rows`` (bucket, n) added up: at most ``BUCKETS`` rows to the driver."""
    got = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def rarity_rank(counts: np.ndarray):
    """A function of tokens: the rank of their counter, the rarest first (16 bits)."""
    rank = np.empty(BUCKETS, dtype=np.uint64)
    rank[np.argsort(counts, kind="stable")] = np.arange(BUCKETS, dtype=np.uint64)
    return lambda values: rank[bucket_of(values)]


def rarity_order(values: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Order of tokens group by group, the rarest first. The tokens of a group come in order of
    value, which a stable sort keeps among equally rare ones."""
    rare = np.minimum(counts[bucket_of(values)], (1 << 40) - 1)
    return np.argsort((owner.astype(np.int64) << 40) | rare, kind="stable")


def prefix_size(n, num: int, den: int):
    """Tokens of sets of ``n`` that any match of similarity num/den must reach; none where even a
    set with one more token is less similar, so that only equal sets (one class) match."""
    return np.where(den * n >= num * (n + 1), n - (num * n + den - 1) // den + 1, 0)


def _index_size(n: Column, num: int, den: int) -> Column:
    """Tokens of the smaller of two sets that any match must reach."""
    return n - F.floor((F.lit(2 * num) * n + F.lit(num + den - 1)) / F.lit(num + den)) + 1


def _needed(n1: Column, n2: Column, num: int, den: int) -> Column:
    """Least overlap of sets of these sizes: ceil(t / (1 + t) (n1 + n2))."""
    return F.floor((F.lit(num) * (n1 + n2) + F.lit(num + den - 1)) / F.lit(num + den))


def _filters(id1, n1, p1, id2, n2, p2, num: int, den: int) -> Column:
    """Length, index-prefix and positional filters for a shared token at these positions (from
    0). They take the token for the first that the sets share: a similar pair
    passes them at that token, and one passing token makes a candidate."""
    sizes = (F.lit(den) * F.least(n1, n2) >= F.lit(num) * F.greatest(n1, n2))
    first_smaller = (n1 < n2) | ((n1 == n2) & (id1 < id2))
    indexed = F.when(first_smaller, p1 < _index_size(n1, num, den)).otherwise(p2 < _index_size(n2, num, den))
    return sizes & indexed & (F.least(n1 - p1, n2 - p2) >= _needed(n1, n2, num, den))


def shared_postings(lists: DataFrame, num: int, den: int) -> DataFrame:
    """The postings (t, id, n, p, c) of ``lists`` (id, n, ts: the prefix in order) whose token
    more than one set holds, and one in its index prefix, with the number of sets that hold it, saved."""
    every = saved(lists, "join-all")  # the texts are read once for the count and the join
    held = every.select("n", F.posexplode("ts").alias("p", "t"))
    often = held.groupBy("t").agg(F.count(F.lit(1)).alias("c"), F.max(F.col("p") < _index_size(F.col("n"), num, den)).alias("i"))
    often = saved(often.where("c > 1 and i").select("t", "c"), "join-shared")
    postings = every.select("id", "n", F.posexplode("ts").alias("p", "t")).select("t", "id", "n", "p")
    made = saved(join_measured(postings, often, ["t"], "inner"), "join-postings")
    discard(every, often)
    return made


def central_pairs(postings: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct candidates (a, b) of each token's most central set with its others."""
    key = F.struct("p", "id")
    heads = postings.groupBy("t").agg(F.min_by(F.struct("id", "n", "p"), key).alias("h"))
    joined = postings.join(heads, "t").where("id <> h.id")
    joined = joined.where(_filters(F.col("id"), F.col("n"), F.col("p"), F.col("h.id"), F.col("h.n"), F.col("h.p"), num, den))
    return joined.select(F.least("id", "h.id").alias("a"), F.greatest("id", "h.id").alias("b")).distinct()


def parity_bits(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """``WORDS`` 64-bit words per set: each member flips one bit."""
    out = np.zeros((n, WORDS), dtype=np.uint64)
    at = values >> np.uint64(40)
    np.bitwise_xor.at(out, (owner, (at % np.uint64(WORDS)).astype(np.int64)),
                      np.uint64(1) << ((at // np.uint64(WORDS)) % np.uint64(64)))
    return out.view(np.int64)


def _bits_allow(x: Column, y: Column, n1: Column, n2: Column, num: int, den: int) -> Column:
    """Members of one set alone flip bits apart: bits that differ are at most as many as members
    that differ, so too many of them rule a pair out (never a similar one)."""
    apart = F.lit(0)
    for i in range(WORDS):
        apart = apart + F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i))))
    return apart <= n1 + n2 - 2 * _needed(n1, n2, num, den)


def open_pairs(postings: DataFrame, is_open: Column, num: int, den: int) -> DataFrame:
    """Distinct candidates (a, b) of all sets that share a token, beyond those that
    ``central_pairs`` gives for tokens of two sets, and for which ``is_open``,
    over the columns of ``postings`` prefixed x_ and y_, holds. ``postings`` has the parity
    ``bits`` of each set and may carry more columns. ``is_open`` decides which side is which."""
    postings = postings.where("c > 2").drop("c")
    x, y = (postings.select(*[F.col(c).alias(f"{s}_{c}") for c in postings.columns]) for s in "xy")
    joined = x.join(y, (F.col("x_t") == F.col("y_t")) & is_open & _filters(
        F.col("x_id"), F.col("x_n"), F.col("x_p"), F.col("y_id"), F.col("y_n"), F.col("y_p"), num, den) & _bits_allow(
        F.col("x_bits"), F.col("y_bits"), F.col("x_n"), F.col("y_n"), num, den))
    return joined.select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The candidates (a, b) whose sets (id, tokens) have Jaccard num/den or more."""
    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.select("a", "b", F.size("ta").alias("na"), F.size("tb").alias("nb"),
                       F.size(F.array_intersect("ta", "tb")).alias("i"))
    return both.where(F.col("i") * den >= (F.col("na") + F.col("nb") - F.col("i")) * num).select("a", "b")
