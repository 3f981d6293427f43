"""Joins and lookups that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: No more than this many keys are ever broadcast as hot: a key is hot when it
#: owns more than 1/MAX_HOT_KEYS of all rows.
MAX_HOT_KEYS = 256


def skew_lookup(facts: DataFrame, dim: DataFrame, on: list[str], rows_col: str, how: str = "inner", min_hot_rows: int = 50_000) -> DataFrame:
    """Join ``facts`` to one ``dim`` row per key; hot keys are broadcast.

    ``dim[rows_col]`` is how many facts rows its key has. Keys with more than
    ``max(min_hot_rows, total / MAX_HOT_KEYS)`` rows, of which there are fewer
    than ``MAX_HOT_KEYS``, are joined by broadcast where the facts lie; all
    other rows go through a hash-partitioned join. Null keys match nothing.
    ``dim`` is read up to four times, so it should be a written table.
    """
    total = dim.agg(F.sum(rows_col)).first()[0] or 0
    limit = max(min_hot_rows, total // MAX_HOT_KEYS)
    if total <= min_hot_rows:
        return facts.join(dim, on, how)
    hot = dim.where(F.col(rows_col) > limit)
    marks = hot.select(*on, F.lit(True).alias("_is_hot"))
    marked = facts.join(F.broadcast(marks), on, "left")
    in_hot = marked.where(F.col("_is_hot")).drop("_is_hot").join(F.broadcast(hot), on, "inner")
    rest = marked.where(F.col("_is_hot").isNull()).drop("_is_hot").join(dim.where(F.col(rows_col) <= limit), on, how)
    return in_hot.unionByName(rest)
