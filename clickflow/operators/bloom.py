"""A mergeable Bloom filter, built by aggregation and tested by a broadcast join.

Blocked: a key sets ``PROBES`` bits of one 64-bit word, so building is one ``bit_or`` per word
(map-side combined; two filters of one size merge the same way) and a test is one hash lookup
and one mask. A key that was added always passes; others pass with a probability of a few per cent
at ``BITS`` bits a key. It stands before an exact join and keeps rows that cannot match out of the
shuffle; it never decides by itself."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.config import BROADCAST_LIMIT_BYTES

#: Bits per key that are aimed at, the least that still help, and bits set per key.
BITS, LEAST_BITS, PROBES = 12, 5, 5
#: Bytes that a word takes when it is broadcast (its number, its bits, and the hash table).
WORD_BYTES = 32


def words_for(keys: int, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> int | None:
    """64-bit words for so many keys within the limit; None where fewer than ``LEAST_BITS`` a key would be left."""
    most = limit_bytes // WORD_BYTES
    words = max(1, min(-(-keys * BITS // 64), most))
    return words if most and words * 64 >= keys * LEAST_BITS else None


def word_of(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words).cast("long"))


def mask_of(key: Column) -> Column:
    """The bits of a key in its word, from a second hash."""
    h = F.xxhash64(F.lit(97), key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(PROBES)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def build(keys: DataFrame, col: str, words: int) -> DataFrame:
    """The filter of the non-null keys: (word, bits), at most ``words`` rows."""
    k = F.col(col)
    return keys.where(k.isNotNull()).groupBy(word_of(k, words).alias("word")).agg(F.bit_or(mask_of(k)).alias("bits"))


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """The filter of the keys of both (built with equal ``words``)."""
    return a.unionByName(b).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def flagged(df: DataFrame, col: str, bloom: DataFrame, words: int, out: str = "_maybe") -> DataFrame:
    """``df`` with ``out``: whether the key may be in the filter (false for null keys)."""
    side = bloom.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    mask = mask_of(F.col(col))
    hit = F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))
    joined = df.join(F.broadcast(side), word_of(F.col(col), words) == F.col("_word"), "left")
    return joined.withColumn(out, F.col(col).isNotNull() & hit).drop("_word", "_bits")
