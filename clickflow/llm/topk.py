"""Exact top-k search by inner product over KD-trees, one per shard.

Rows are dealt evenly to shards of about ``SHARD_ROWS``. Each shard builds a KD-tree: median
splits along the widest side, a tight bounding box at every node. A query walks it best
first: the bound of a box is the largest inner product that any point inside could have,
nodes leave a heap in order of their bounds, and the walk ends when the best bound left is
below the k-th score found. That k-th score is propagated: every query first searches one
home shard, and what it finds there bounds its walks through all shards.

Rows and queries are dealt to the shards in one shuffle and sorted within a task, a shard's rows
before its queries: the task builds each tree once and streams the queries past it, in Arrow
batches. So rows are never copied (a query goes once to each shard), a task holds one shard and one batch whatever the
size of the table, and per query and shard at most k rows leave it. Scores are exact integers: doubles
while all sums stay below 2^53, else Python integers, cut to the range of a long.

Defined results: vectors that are null or hold null or non-finite components, and rows
without an id, take no part; vectors are compared with those of the same length only
(empty ones score 0); a query's candidates are all rows with another id, repeated rows
count as often as they stand; an id that is repeated asks with its least vector; ties go
to the smaller id; fewer than k candidates give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS, LEAF = 4096, 64
SCALE = 1024.0
_EXACT = float(2 ** 53)
_LONG = 2 ** 63 - 1


def quantised(rows: np.ndarray) -> np.ndarray:
    """floor(1024 x) of each component, as doubles that hold integers."""
    return np.floor(SCALE * rows)


def integers(m: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers."""
    return np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)


class KdTree:
    """Points in the order of the leaves, and a box and children per node."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        spans, self.children, boxes = [(0, len(points))], [], []
        at = 0
        while at < len(spans):
            a, b = spans[at]
            inside = points[self.order[a:b]]
            lo, hi = inside.min(axis=0), inside.max(axis=0)
            boxes.append((lo, hi))
            width = hi - lo
            if b - a <= leaf or not width.size or not width.max():
                self.children.append(None)
            else:
                axis, middle = int(width.argmax()), (b - a) // 2
                part = np.argpartition(inside[:, axis], middle)
                self.order[a:b] = self.order[a:b][part]
                self.children.append((len(spans), len(spans) + 1))
                spans += [(a, a + middle), (a + middle, b)]
            at += 1
        self.spans = spans
        self.lo, self.hi = (np.array([x[k] for x in boxes]) for k in (0, 1))
        self.points = points[self.order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product of each query with any point of each node's box."""
        zero = queries * 0
        up, down = np.where(queries > 0, queries, zero), np.where(queries < 0, queries, zero)
        return up @ self.hi.T + down @ self.lo.T


def search(tree: KdTree, ids: np.ndarray, query: np.ndarray, own: int, bounds: np.ndarray, k: int, kth):
    """The k best (scores, ids) of a query in a tree, among scores of at least ``kth`` (or None)."""
    scores, found = np.zeros(0, dtype=tree.points.dtype), np.zeros(0, dtype=np.int64)
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        if kth is not None and -bound < kth:
            break
        if tree.children[node]:
            for child in tree.children[node]:
                if kth is None or bounds[child] >= kth:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        a, b = tree.spans[node]
        s, i = tree.points[a:b] @ query, ids[a:b]
        keep = i != own if kth is None else (i != own) & (s >= kth)
        if not keep.any():
            continue
        scores, found = np.concatenate([scores, s[keep]]), np.concatenate([found, i[keep]])
        if len(scores) >= k:
            best = np.lexsort((found, -scores))[:k] if scores.dtype != object else \
                np.array(sorted(range(len(scores)), key=lambda x: (-scores[x], found[x]))[:k])
            scores, found = scores[best], found[best]
            kth = scores[-1] if kth is None else max(kth, scores[-1])
    return scores, found


class Shard:
    """Rows of a shard as they come, and its tree, built when the first query asks."""

    def __init__(self, key):
        self.key, self.ids, self.rows, self.trees = key, [], [], {}

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids.append(ids)
        self.rows.append(quantised(rows))

    def tree(self, exact: bool) -> tuple[KdTree, np.ndarray] | None:
        """The tree (over Python integers if ``exact``) and the ids in its order."""
        if not self.ids:
            return None
        if exact not in self.trees:
            points = np.concatenate(self.rows)
            made = KdTree(integers(points) if exact else points)
            self.trees[exact] = made, np.concatenate(self.ids)[made.order]
        return self.trees[exact]

    def search(self, own: np.ndarray, queries: np.ndarray, kths: list, k: int) -> tuple[np.ndarray, ...]:
        """All queries against the rows: (query ids, ids, scores)."""
        out: tuple[list, ...] = ([np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)])
        q = quantised(queries)
        largest = max((np.abs(r).max(initial=0) for r in self.rows), default=0)
        exact = q.shape[1] * max(1.0, np.abs(q).max(initial=0)) * max(1.0, largest) >= _EXACT
        held = self.tree(exact)
        if held is not None:
            tree, ids = held
            q = integers(q) if exact else q
            bounds = tree.bounds(q)
            for n in range(len(q)):
                # a score cut to the range of a long says nothing about what lies beyond
                kth = None if kths[n] is None or abs(kths[n]) >= _LONG else kths[n]
                scores, found = search(tree, ids, q[n], own[n], bounds[n], k, kth)
                out[0].append(np.full(len(found), own[n]))
                out[1].append(found)
                out[2].append(np.array([max(-_LONG - 1, min(_LONG, int(s))) for s in scores], dtype=np.int64))
        return tuple(np.concatenate(x) for x in out)


def searched(batches, k: int):
    """Results of a task's rows (dim, shard, kind, vec_id, vector, kth), sorted by the first three."""
    import pyarrow as pa

    at = None
    for batch in batches:
        key = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(3)], axis=1)
        cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, len(key)] if len(key) else np.zeros(1, dtype=np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            dim, shard, kind = key[a].tolist()
            if at is None or at.key != (dim, shard):
                at = Shard((dim, shard))
            run = batch.slice(a, b - a)
            ids = np.asarray(run.column(3))
            vectors = np.asarray(run.column(4).flatten()).reshape(b - a, dim)
            if kind == 0:
                at.add(ids, vectors)
            else:
                made = at.search(ids, vectors, run.column(5).to_pylist(), k)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["query_id", "vec_id", "score"])


def _valid(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``vectors`` (vec_id, embedding)
    for each row of ``queries`` (same columns)."""
    clean = lambda df: df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector")) \
        .where(F.col("vec_id").isNotNull() & _valid(F.col("vector"))).withColumn("dim", F.size("vector"))
    rows, asked = clean(vectors), clean(queries).groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    shards = max(1, -(-rows.count() // shard_rows))
    columns = ["dim", "shard", "kind", "vec_id", "vector", "kth"]
    dealt = rows.withColumns({"shard": F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards).cast("long")), "kind": F.lit(0),
                              "kth": F.lit(None).cast("long")}).select(*columns)

    def run(of: DataFrame) -> DataFrame:
        both = dealt.unionByName(of.withColumn("kind", F.lit(1)).select(*columns))
        ordered = both.repartition(_tasks(rows, shards), "dim", "shard").sortWithinPartitions("dim", "shard", "kind")
        return ordered.mapInArrow(lambda batches: searched(batches, k), "query_id long, vec_id long, score long")

    home = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards).cast("long"))
    first = run(asked.withColumn("shard", home).withColumn("kth", F.lit(None).cast("long")))
    kth = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    known = asked.join(kth, F.col("vec_id") == F.col("query_id"), "left").drop("query_id")
    every = known.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return run(every).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def _tasks(df: DataFrame, shards: int) -> int:
    """Tasks of the search: as many as the session shuffles into, or one per shard if that is fewer."""
    return max(1, min(shards, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
