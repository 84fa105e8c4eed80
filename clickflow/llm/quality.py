"""Quality rules with adaptive thresholds (DataFrame functions only).

Each text gets base measures; fixed rules reject the shortest and the most repetitive ones.
For the others every cutoff comes from the texts themselves: each ratio goes into a log-binned
quantile sketch (relative error ``GAMMA - 1``) per language and source. The sketch is a count per
bin, so partial sketches merge by adding counts: map-side within a group, then from (language,
source) up to the language and the whole corpus for groups too small to stand alone. Shares are
taken as (count + 1/2) / (size + 1), so a text without any says no more than its size allows.

A group's fence, in bins of its own sketch, is the lower of

* its tail carried on: as far above the 99th percentile, in ratio, as that is above the 90th;
* the edge of a gap in its upper quarter: where no text lies within a factor of ``GAP`` above. A
  lump of odd texts beyond it can hold up to a quarter of the group and does not move it.

No constant is a cutoff of any measure. The thresholds (one row per language and source) are
joined back to the documents.

A group's sketch has at most a few hundred bins per measure whatever its size, and hot
groups are pre-aggregated before the shuffle. Windows are found within the row by sorting
its word triples, so no text is exploded into rows.

Defined results: a null text has no words and fails the base rules, as does an empty one;
null languages and sources are groups of their own; equal rows get equal verdicts; a very
long text is measured whole; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import WORD, discard, join_measured, packed, saved

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
GAMMA = 1.02
#: The adaptive measures.
RATIOS = ["symbols", "dup_lines", "repeats", "word_length"]
#: Documents that a group needs for thresholds of its own (its 99th percentile should be of ten texts).
MIN_GROUP = 1000
#: A gap is empty up to this factor; at most this share of a group may lie beyond one.
GAP, BEYOND = 4.0, 0.25
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def measured(docs: DataFrame, **keep: Column) -> DataFrame:
    """Base measures of ``docs.text`` (whole texts), beside the ``keep`` expressions."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(*[e.alias(n) for n, e in keep.items()], text.alias("_t"),
                     F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_w"),
                     F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("_l"))
    n = F.size("_w")
    # each window as "words\nposition": sorting brings equal windows together
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.concat(
        F.concat_ws(" ", *[F.get("_w", i - 1 + k) for k in range(WINDOW)]), F.lit("\n"), i.cast("string")))).otherwise(_empty("string"))
    df = df.withColumn("_s", F.sort_array(windows))
    df = df.withColumn("_p", F.transform("_s", lambda s: F.substring_index(s, "\n", 1)))
    size = F.size("_p")
    again = F.when(size > 1, F.filter(F.sequence(F.lit(0), size - 1), lambda i: F.get("_p", i).eqNullSafe(
        F.get("_p", i + 1)) | F.get("_p", i).eqNullSafe(F.get("_p", i - 1)))).otherwise(_empty("int"))
    df = df.withColumn("_again", again)
    df = df.withColumn("_at", F.sort_array(F.transform("_again", lambda i: F.substring_index(F.get("_s", i), "\n", -1).cast("int"))))
    m = F.size("_at")
    gaps = F.when(m > 1, F.aggregate(F.sequence(F.lit(1), m - 1), F.lit(0), lambda a, j: a + F.least(
        F.lit(WINDOW), F.get("_at", j) - F.get("_at", j - 1)))).otherwise(F.lit(0))
    repeated = F.when(m > 0, gaps + WINDOW).otherwise(F.lit(0))
    t = F.col("_t")
    spaces, chars = " \t\n\x0b\x0c\r", F.length(t)
    out = {"n_words": n, "word_chars": F.length(F.translate(t, spaces, "")),
           "n_symbols": chars - F.length(F.translate(t, SYMBOLS, "")),
           "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")), "n_repeat_words": repeated,
           "n_lines": F.size("_l")}
    return df.select(*[F.col(k) for k in keep], *[e.cast("long").alias(k) for k, e in out.items()])


def _ratios(half: float = 0.5) -> dict[str, Column]:
    """The adaptive measures, as doubles; with a negative half what a text holds for certain (0 or
    less: nothing)."""
    part = lambda a, b: (F.col(a) + F.lit(half)) / (F.col(b) + F.lit(1.0))
    return {"symbols": part("n_symbols", "word_chars"), "dup_lines": part("n_dup_lines", "n_lines"),
            "repeats": part("n_repeat_words", "n_words"), "word_length": part("word_chars", "n_words")}


def _bin(x: Column) -> Column:
    return F.ceil(F.ln(x) / F.ln(F.lit(GAMMA))).cast("int")


def too_repetitive() -> Column:
    return 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | too_repetitive()


def sketches(rows: DataFrame) -> DataFrame:
    """Quantile sketches of ``rows`` (lang, source and the measures) that pass the base rules:
    one count per (lang, source, measure, bin)."""
    ratios = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), _bin(e).alias("bin")) for k, e in _ratios().items()]))
    long = rows.where(~base_failed()).select("lang", "source", ratios.alias("r")).select("lang", "source", "r.*")
    return long.groupBy("lang", "source", "measure", "bin").agg(F.count(F.lit(1)).alias("n"))


def fences(sketch: DataFrame, group: list[str]) -> DataFrame:
    """Merge sketches to ``group`` and read a fence per measure: columns f_<measure> (the last bin
    inside) and the documents of the group in ``docs``."""
    merged = sketch.groupBy(*group, "measure", "bin").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*group, "measure")
    at = merged.select(*group, "measure", "bin", F.sum("n").over(by.orderBy("bin")).alias("run"), F.sum("n").over(by).alias("all"),
                       (F.lead("bin").over(by.orderBy("bin")) - F.col("bin")).alias("gap"))
    least = lambda met: F.min(F.when(met, F.col("bin")))
    far = F.ceil(F.ln(F.lit(GAP)) / F.ln(F.lit(GAMMA)))
    q = at.groupBy(*group, "measure").agg(
        least(F.col("run") >= 0.9 * F.col("all")).alias("q90"), least(F.col("run") >= 0.99 * F.col("all")).alias("q99"),
        least((F.col("gap") >= far) & (F.col("run") >= (1 - BEYOND) * F.col("all"))).alias("edge"), F.max("all").alias("all"))
    fence = F.least(2 * F.col("q99") - F.col("q90"), F.col("edge"))
    return q.groupBy(*group).agg(*[F.max(F.when(F.col("measure") == k, fence)).alias(f"f_{k}") for k in RATIOS],
                                 F.max("all").alias("docs"))


def thresholds(rows: DataFrame) -> DataFrame:
    """A saved table of fences per (lang, source) of ``rows``: the group's own with at least
    ``MIN_GROUP`` documents, else those of its language, else those of the corpus."""
    sketch = saved(sketches(rows), "quality-sketch")
    names = [f"f_{k}" for k in RATIOS]
    lang = fences(sketch, ["lang"])
    lang = saved(lang.select("lang", *[F.col(c).alias(f"{c}_1") for c in [*names, "docs"]]), "quality-lang")
    corpus = fences(sketch.withColumn("_all", F.lit(1)), ["_all"]).first()   # one row
    t = join_measured(fences(sketch, ["lang", "source"]), lang, ["lang"])
    pick = lambda c: F.when(F.col("docs") >= MIN_GROUP, F.col(c)).when(F.col("docs_1") >= MIN_GROUP, F.col(f"{c}_1")) \
        .otherwise(F.lit(corpus[c] if corpus else None).cast("int"))
    made = saved(t.select("lang", "source", *[pick(c).alias(c) for c in names]), "quality-fences")
    discard(sketch, lang)
    return made


def _judged(rows: DataFrame, lang: Column, source: Column, limits: DataFrame) -> DataFrame:
    joined = join_measured(rows, limits, {"lang": lang, "source": source})
    inside = F.lit(True)
    for k, x in _ratios().items():
        inside = inside & F.coalesce(_bin(x) <= F.col(f"f_{k}"), F.lit(True))
    certain = F.lit(True)
    for k, x in _ratios(-0.5).items():
        certain = certain & F.coalesce((x <= 0) | (_bin(F.greatest(x, F.lit(1e-300))) <= F.col(f"f_{k}")), F.lit(True))
    short = F.col("n_words").between(1, MIN_WORDS - 1) & ~too_repetitive() & certain
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & inside).withColumn("short_kept", short)


def quality(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every row of ``docs`` (doc_id, text, lang, source), with the
    fences that decided it."""
    rows = saved(measured(docs, doc_id=F.col("doc_id"), lang=F.col("lang"), source=F.col("source")), "quality-rows")
    return _judged(rows, F.col("lang"), F.col("source"), thresholds(rows))


def keep_good(docs: DataFrame, judge_short: bool = False) -> DataFrame:
    """The rows of ``docs`` that the rules keep. With ``judge_short`` texts of fewer than ``MIN_WORDS`` words
    do not go for their length: they go if they have no words, if the rule on repetition rejects
    them, or if what they hold for certain, (count - 1/2) / (size + 1), is beyond a fence of their
    group. The rows travel packed beside their measures through one written table, so texts are
    measured once."""
    whole = packed(docs, text=F.col("text"))
    rows = saved(measured(whole, _row=F.col("_row")), "quality-rows")
    flat = rows.select(F.col("_row.lang").alias("lang"), F.col("_row.source").alias("source"), *MEASURES, "n_lines")
    judged = _judged(rows, F.col("_row.lang"), F.col("_row.source"), thresholds(flat))
    return judged.where(F.col("kept") | F.lit(judge_short) & F.col("short_kept")).select("_row.*")
