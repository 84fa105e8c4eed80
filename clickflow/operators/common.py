"""Small shared helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_rows(*dfs: DataFrame) -> DataFrame:
    """Combine one-row aggregates side by side without a join: the rows are unioned by
    name (missing columns null) and folded back with one global max per column."""
    cols: list[str] = []
    for d in dfs:
        cols.extend(c for c in d.columns if c not in cols)
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    return u.agg(*[F.max(c).alias(c) for c in cols])
