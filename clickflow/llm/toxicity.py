"""Toxicity by cumulative-link ordinal regression.

Severity grades 0 < 1 < ... < K are predicted from sparse text features: P(grade > k) =
sigmoid(w.x - c_k), with one weight vector shared by all ordered cutpoints c_0 < c_1 < ...
The output is the expected severity, the sum over k of P(grade > k).

Features are the distinct words of the whole text and their prefixes of four and five
letters, so inflected forms share weight. Training uses a bounded sample of labelled rows
(``MAX_CLEAN`` and ``MAX_TOXIC``, the smallest hashes of the id), whole texts, reduced to their features on the
executors. Spark counts each feature among the sample's clean and toxic rows; the ``MAX_FEATURES``
most associated with the label are kept, and each row keeps all of its own among them, so what reaches the driver is
bounded however long the texts are, and the model is a dictionary of bounded size that is shipped to the
executors. Scoring is one pass over all documents in Arrow batches (bounded in bytes), without a shuffle.

The label table is binary, so severity is a proxy: its toxic rows are graded 1 to 3 by terciles of the
number of their distinct features that are at least ``EVIDENCE`` times as frequent among toxic as
among clean rows of the sample. Of texts with one id the one with the least hash trains.

Defined results: a null or empty text has no features and gets the score of the cutpoints
alone; null grades take no part in training; without both clean and toxic labels nothing
is learnt and every severity is 0; repeated rows get equal scores; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import discard, saved

#: Labelled rows of either kind that the fit uses at most, and features that it keeps.
MAX_CLEAN, MAX_TOXIC, MAX_FEATURES = 4500, 1500, 4000
#: Rows that a feature must stand in.
LEAST_ROWS = 3
EVIDENCE = 10.0
#: A text is called toxic from this probability of a grade above 0.
TOXIC = 0.6
LETTERS = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    words = set(LETTERS.findall(text.lower()))
    out = set(words)
    for w in words:
        if len(w) > 4:
            out.add(w[:4] + "-")
            if len(w) > 5:
                out.add(w[:5] + "-")
    return out


def weight_of(word: str, weights: dict[str, float]) -> float:
    return sum(weights.get(f, 0.0) for f in ({word} if len(word) < 5 else {word, word[:4] + "-"} if len(word) < 6 else
                                             {word, word[:4] + "-", word[:5] + "-"}))


@dataclass
class OrdinalModel:
    """Weights by feature and the ordered cutpoints."""
    weights: dict[str, float] = field(default_factory=dict)
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and cutpoint."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.cuts[None, :], -50, 50)))


def fit(rows: list[tuple[str, ...]], grades: list[int], max_features: int = MAX_FEATURES, l2: float = 2e-3,
        rounds: int = 400, rate: float = 0.05) -> OrdinalModel:
    """Fit the cumulative-link model by full-batch gradient ascent (Adam) on the likelihood.

    Cutpoints are the first one plus positive steps, so they stay in order."""
    y = np.array(grades)
    top = int(y.max()) if len(y) else 0
    if len(y) == 0 or top == 0 or (y > 0).all():
        return OrdinalModel()
    seen, toxic = Counter(), Counter()
    for row, g in zip(rows, grades, strict=True):
        seen.update(row)
        if g:
            toxic.update(row)
    n, n1 = len(y), int((y > 0).sum())

    def chi2(f):  # association of presence with a grade above 0
        a, all_ = toxic[f], seen[f]
        e = all_ * n1 / n
        return (a - e) ** 2 * n / max(e * (n - all_) * (n - n1) / n, 1e-9)
    names = sorted((f for f in seen if LEAST_ROWS <= seen[f] < n), key=lambda f: (-chi2(f), f))[:max_features]
    index = {f: i for i, f in enumerate(names)}
    pairs = [(i, index[f]) for i, row in enumerate(rows) for f in row if f in index]
    at, of = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
    w, steps, first = np.zeros(len(names)), np.zeros(top - 1), 1.0
    share = np.where(y > 0, n / (2 * n1), n / (2 * (n - n1)))  # both sides weigh the same
    moment = [np.zeros(len(names) + top) for _ in range(2)]
    over = (y[:, None] > np.arange(top)[None, :]).astype(float)
    for t in range(1, rounds + 1):
        cuts = first + np.r_[0.0, np.cumsum(np.exp(steps))]
        scores = np.bincount(at, weights=w[of], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(scores[:, None] - cuts[None, :], -50, 50)))
        # P(grade = k) as differences of neighbouring cumulative probabilities
        full = np.c_[np.ones(n), p, np.zeros(n)]
        rows_at = np.arange(n)
        like = np.maximum(full[rows_at, y] - full[rows_at, y + 1], 1e-9)
        slope = np.c_[np.zeros(n), p * (1 - p), np.zeros(n)]
        d = (slope[rows_at, y] - slope[rows_at, y + 1]) / like * share / n  # d log P / d score
        cut_grad = np.zeros(top)
        np.add.at(cut_grad, np.maximum(y - 1, 0), np.where(y > 0, -slope[rows_at, y] / like, 0) * share / n)
        np.add.at(cut_grad, np.minimum(y, top - 1), np.where(y < top, slope[rows_at, y + 1] / like, 0) * share / n)
        w_grad = np.bincount(of, weights=d[at], minlength=len(names)) - l2 * w
        step_grad = np.cumsum(cut_grad[::-1])[::-1][1:] * np.exp(steps)
        grad = np.r_[w_grad, cut_grad.sum(), step_grad]
        moment[0] = 0.9 * moment[0] + 0.1 * grad
        moment[1] = 0.999 * moment[1] + 0.001 * grad ** 2
        move = rate * (moment[0] / (1 - 0.9 ** t)) / (np.sqrt(moment[1] / (1 - 0.999 ** t)) + 1e-8)
        w, first, steps = w + move[:len(names)], first + move[len(names)], steps + move[len(names) + 1:]
    cuts = first + np.r_[0.0, np.cumsum(np.exp(steps))]
    return OrdinalModel({f: float(x) for f, x in zip(names, w, strict=True) if abs(x) > 1e-6}, cuts)


def severity_grades(amount: list[int], toxic: list[int]) -> list[int]:
    """Grades of a binary sample: 0, and terciles of toxic evidence among the toxic rows."""
    held = [a for a, t in zip(amount, toxic, strict=True) if t]
    if not held or len(held) == len(toxic):
        return [0] * len(toxic)
    cuts = np.quantile(held, [1 / 3, 2 / 3])
    return [0 if not t else 1 + int(a > cuts[0]) + int(a > cuts[1]) for a, t in zip(amount, toxic, strict=True)]


def sample_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", clean: int = MAX_CLEAN, toxic: int = MAX_TOXIC) -> DataFrame:
    """(doc_id, label, features) of a bounded, hash-ordered sample of labelled documents, as a saved
    table. The ids of the sample are chosen among the labels first, so only their texts are read into
    Python."""
    import pyarrow as pa

    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.max(label).alias("_label"))
    known = known.withColumn("_h", F.xxhash64(F.lit("fit"), "doc_id"))
    kinds = ((F.col("_label") > 0, toxic), (F.col("_label") <= 0, clean))  # the limits bound the sample
    first, rest = (known.where(kind).orderBy("_h", "doc_id").limit(n) for kind, n in kinds)
    chosen = first.unionByName(rest)
    rows = docs.select("doc_id", "text").where("text is not null").join(
        F.broadcast(chosen.select(F.col("doc_id").alias("_id"), "_label")), F.col("doc_id") == F.col("_id"))

    def reduced(batches):
        for b in batches:
            for i in range(b.num_rows):   # a text at a time: its features can be many
                one = b.slice(i, 1)
                yield pa.RecordBatch.from_arrays([one.column(0), one.column(2), one.column(3), pa.array([sorted(features(one.column(1)[0].as_py()))], pa.list_(pa.string()))],
                                                 names=["doc_id", "label", "order", "features"])

    told = rows.select("doc_id", "text", F.col("_label").cast("int").alias("_label"), F.xxhash64("text").alias("_order")).mapInArrow(
        reduced, f"doc_id {dict(docs.dtypes)['doc_id']}, label int, order long, features array<string>")
    one = told.groupBy("doc_id").agg(F.min_by(F.struct("label", "features"), F.struct("order", F.size("features"))).alias("r"))
    return saved(one.select("doc_id", "r.*"), "toxic-sample")


def training_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", clean: int = MAX_CLEAN, toxic: int = MAX_TOXIC,
                    max_features: int = MAX_FEATURES) -> tuple[list[tuple[str, ...]], list[int], list[int]]:
    """Per row of the sample, in order of id: all its features among the ``max_features`` most associated with the
    label, its label, and its amount of toxic evidence. Chosen from counts that Spark makes over all features
    of the sample."""
    rows = sample_rows(docs, labels, label, clean, toxic)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((F.col("label") > 0).cast("long")), F.lit(0)).alias("n1")).first()
    n, n1 = size["n"], size["n1"]
    if not n1 or n1 == n:
        return [], [], []
    each = rows.select("doc_id", "label", F.explode("features").alias("f"))
    counts = saved(each.groupBy("f").agg(F.count(F.lit(1)).alias("seen"), F.sum((F.col("label") > 0).cast("long")).alias("bad"))
                   .where(F.col("seen") >= LEAST_ROWS), "toxic-counts")
    expected = F.col("seen") * (n1 / n)
    chi2 = F.pow(F.col("bad") - expected, 2) * n / F.greatest(expected * (n - F.col("seen")) * (n - n1) / n, F.lit(1e-9))
    chosen = counts.where(F.col("seen") < n).orderBy(chi2.desc(), "f").limit(max_features).select("f")   # the limit bounds the model
    telling = counts.where((F.col("bad") >= LEAST_ROWS) & (F.col("bad") / n1 >= EVIDENCE * (F.col("seen") - F.col("bad")) / (n - n1)))
    kept = each.join(F.broadcast(chosen), "f").groupBy("doc_id").agg(F.sort_array(F.collect_list("f")).alias("kept"))
    amount = each.join(telling.select("f"), "f").groupBy("doc_id").agg(F.count(F.lit(1)).alias("amount"))
    got = rows.select("doc_id", "label").join(kept, "doc_id", "left").join(amount, "doc_id", "left").toArrow().sort_by("doc_id")
    discard(rows, counts)
    pool: dict[str, str] = {}  # one string object per feature
    made = [tuple(pool.setdefault(f, f) for f in row.as_py() or ()) for row in got.column("kept")]
    return made, got.column("label").to_pylist(), [a or 0 for a in got.column("amount").to_pylist()]


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """(doc_id, expected_severity, p_toxic, grade, toxic) of every row of ``docs``."""
    import pyarrow as pa

    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        m = shipped.value
        known: dict[str, float] = {}
        top = len(m.cuts)
        for b in batches:
            totals = np.zeros(b.num_rows)
            for i, text in enumerate(b.column(1).to_pylist()):
                words = set(LETTERS.findall(text.lower())) if text else set()
                seen: set[str] = set()
                total = 0.0
                for w in words:
                    x = known.get(w)
                    if x is None:
                        x = weight_of(w, m.weights)
                        if len(w) <= 32:
                            known[w] = x
                    if x:  # rare: features count once per text
                        for f in (w, w[:4] + "-" if len(w) > 4 else w, w[:5] + "-" if len(w) > 5 else w):
                            if f not in seen:
                                seen.add(f)
                                total += m.weights.get(f, 0.0)
                totals[i] = total
                if len(known) > 500_000:
                    known.clear()
            above = m.above(totals) if top else np.zeros((b.num_rows, 0))
            severity = above.sum(axis=1)
            p = above[:, 0] if top else np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(severity), pa.array(p), pa.array((above > 0.5).sum(axis=1).astype(np.int64)),
                 pa.array(p > TOXIC)], names=["doc_id", "expected_severity", "p_toxic", "grade", "toxic"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        scored, f"doc_id {kind}, expected_severity double, p_toxic double, grade long, toxic boolean")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled sample of ``docs``, then score all of ``docs``."""
    rows, toxic, amount = training_sample(docs, labels)
    return score(docs, fit(rows, severity_grades(amount, toxic)))
