"""Mixing sources to target weights.

The words of each source are counted over all documents; targets follow from the weights,
the budget and a cap; each document is then taken floor(rate) times, plus once more when a
hash of its id falls below the fraction of the rate (rate = target / size of its source).

Only the table of sources (one row each) is ever gathered: ranks come from range
partitions, the water level from a few one-row aggregates, and the rates go back to the
documents by a measured broadcast or, beyond its limit, a shuffled join whose hot sources
adaptive execution splits. No source's rows meet in one task.

Defined results: a null text has size 0; a null source is a source of its own, ranked
last; a source without words has target 0 and its documents are not emitted; documents
with equal ids (and null ids with equal texts) draw the same copy; an empty table gives an
empty result. The draw is a hash of the id, so reruns and retried tasks agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import WORD, join_measured, packed, ranked, saved

#: Hex digits of the digest that make the uniform draw (52 bits fit a double exactly).
_DIGITS = 13


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) from the digest of seed and id (null id: the text)."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), text, F.lit(""))))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") / F.lit(float(16 ** _DIGITS))


def source_targets(sized: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: tuple[int, int] = (3, 2),
                   cap: int = 2) -> DataFrame:
    """Targets per source of ``sized`` (source, size), as a saved table
    (source, source_size, target).

    Sources by code point, null last, weigh ``weights`` in turn and share ``budget`` (a
    fraction) of all words; a target stops at ``cap`` times its source's size, and what
    goes beyond is shared again by weight until none is above. Exact integer arithmetic
    (decimal) decides who is capped; each round is one aggregate over the sources."""
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    stats = ranked(stats, [F.col("source").isNull(), F.col("source")], "mix-sources")
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    stats = saved(stats.select("source", "source_size", turn.cast("long").alias("weight")), "mix-weights")
    num, den = budget
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    total, weight = (int(x or 0) for x in stats.agg(F.sum(exact("source_size")), F.sum(exact("weight"))).first())
    capped_size, free_weight = 0, weight
    while True:
        pool = num * total - den * cap * capped_size
        above = exact("weight") * F.lit(pool).cast("decimal(38,0)") > \
            exact("source_size") * F.lit(den * cap * free_weight).cast("decimal(38,0)")
        row = stats.agg(F.sum(F.when(above, exact("source_size"))).alias("s"),
                        F.sum(F.when(~above, exact("weight"))).alias("w")).first()
        now = (int(row["s"] or 0), int(row["w"] or 0))
        if now == (capped_size, free_weight) or not now[1]:
            break
        capped_size, free_weight = now
    shared = F.col("weight") * F.lit(float(pool)) / F.lit(float(den * max(1, free_weight)))
    return stats.select("source", "source_size", F.when(above, F.col("source_size") * float(cap))
                        .otherwise(shared).alias("target"))


def copies_of(target: Column, source_size: Column, draw: Column) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return F.floor(rate).cast("long") + F.when(draw < rate - F.floor(rate), 1).otherwise(0)


def mix_plan(docs: DataFrame, seed: str = "mix", **targets) -> DataFrame:
    """Per document of ``docs`` (doc_id, source, text): its size, its source's size and
    target, how often it is taken and the words that makes."""
    sized = saved(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                              uniform(F.col("doc_id"), F.col("text"), seed).alias("draw")), "mix-sized")
    rated = join_measured(sized, source_targets(sized, **targets), ["source"])
    rated = rated.withColumn("copies", copies_of(F.col("target"), F.col("source_size"), F.col("draw")))
    return rated.select("doc_id", "source", "size", "source_size", "target", "copies",
                        (F.col("copies") * F.col("size")).alias("taken"))


def mix_sources(docs: DataFrame, seed: str = "mix", **targets) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken (0, 1, 2, ... times)."""
    sized = docs.select("source", word_count(F.col("text")).alias("size"))
    rows = packed(docs, _source=F.col("source"), _draw=uniform(F.col("doc_id"), F.col("text"), seed))
    rated = join_measured(rows, source_targets(sized, **targets), {"source": F.col("_source")})
    rated = rated.withColumn("_copies", copies_of(F.col("target"), F.col("source_size"), F.col("_draw")).cast("int"))
    taken = rated.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return taken.select("_row.*")
