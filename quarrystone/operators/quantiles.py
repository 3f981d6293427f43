"""Exact quantiles of groups of any size.

The built-in exact percentile keeps all distinct values of a group in one
buffer. Here mergeable sketches first give two values that enclose each wanted
rank, those of all groups together by merging the groups' own; a second pass
counts what lies below and keeps the few values between. Those are
range-partitioned by group and value, each partition adds up its own, and a
small table of partition totals turns that into ranks. No task ever holds a
group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add, or_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from quarrystone.session import materialize


#: Items a sketch keeps, and how far in rank a bracket reaches to either side; several times what a sketch of that size errs.
SKETCH_ITEMS, MARGIN = 4_000, 0.004


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to sorted counts the partition's number and how many values of the group come before, in this partition."""
    part, last, carried = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        group, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_g", "_n"))
        total = np.cumsum(n)
        opens = np.concatenate([[last is None or group[0] != last], group[1:] != group[:-1]])
        at = np.flatnonzero(opens)
        run = np.cumsum(opens) - 1  # -1: still the group of the batch before
        starts = np.append((total - n)[at], -carried)
        before = total - n - starts[run]
        last, carried = group[-1], int(before[-1] + n[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(before)], names=[*batch.schema.names, "_part", "_before"])


def _null_safe(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which null keys match; the keys of ``df`` stay."""
    renamed = other.withColumnsRenamed({c: f"_k{i}" for i, c in enumerate(keys)})
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return df.join(renamed, same, how).drop(*[f"_k{i}" for i in range(len(keys))])


def _ranked(values: DataFrame, by: list[str]) -> DataFrame:
    """(by, _v, _n, _before): equal values counted, with how many of the group are less. ``by`` never null-only."""
    # a group's rows lie together in the order of its keys; its hash tells where the next one begins
    counts = values.groupBy(*by, "_v").agg(F.sum("_n").alias("_n")).withColumn("_g", F.xxhash64(*[c for k in by for c in (F.col(k), F.col(k).isNull())]))
    schema = StructType([*counts.schema.fields, StructField("_part", IntegerType()), StructField("_before", LongType())])
    ranked = materialize(counts.repartitionByRange(*by, "_v").sortWithinPartitions(*by, "_v").mapInArrow(_running, schema), "quantiles")
    parts = ranked.groupBy(*by, "_part").agg(F.sum("_n").alias("_t"))  # rows: groups plus partitions at most
    shifts = parts.select(*by, "_part", (F.sum("_t").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_t")).alias("_shift"))
    return _null_safe(ranked, shifts, [*by, "_part"]).select(*by, "_v", "_n", (F.col("_before") + F.col("_shift")).alias("_before"))


def exact_quantiles(df: DataFrame, by: list[str], value: str, quantiles: list[float], overall: str | None = None) -> DataFrame:
    """(by, n, quantiles): linearly interpolated quantiles of the non-null values of each group, in an array.

    With ``overall``, one of ``by``, come the quantiles over all its values
    too: rows with it null and ``_all`` 1; those of its groups have ``_all``
    0, its null group has none of its own. Groups without values are left out;
    other null keys form a group. NaN is the greatest value. Should a sketch
    not enclose a rank, all values of the table are ranked instead.
    """
    if not by:
        return exact_quantiles(df.withColumn("_one", F.lit(1)), ["_one"], value, quantiles).drop("_one")
    k, v = range(len(quantiles)), F.col("_v")
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    probes = F.array(*[F.lit(p) for q in quantiles for p in (max(0.0, q - MARGIN), min(1.0, q + MARGIN))])
    sizes = [F.count(F.lit(1)).alias("n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.count_if(F.isnan("_v")).alias("_nan")]
    own = rows.groupBy(*by).agg(*sizes, F.kll_sketch_agg_double(F.nanvl("_v", F.lit(float("inf"))), F.lit(SKETCH_ITEMS)).alias("_s"))
    keys = ["_all", *by] if overall else by
    if overall:
        own = materialize(own, "quantile-sketches")
        rest, none = [c for c in by if c != overall], F.lit(None).cast(df.schema[overall].dataType).alias(overall)
        every = own.groupBy(*rest).agg(F.sum("n").alias("n"), F.min("_min").alias("_min"), F.max("_max").alias("_max"), F.sum("_nan").alias("_nan"), F.kll_merge_agg_double("_s", F.lit(SKETCH_ITEMS)).alias("_s"))
        own = own.withColumn("_all", F.lit(0)).unionByName(every.select(F.lit(1).alias("_all"), *rest, none, "n", "_min", "_max", "_nan", "_s"))
    found = own.select(*keys, "n", "_min", "_max", "_nan", F.kll_sketch_get_quantile_double("_s", probes).alias("_p"))

    def edge(i: int, low: bool) -> Column:
        q = quantiles[i]
        whole = (F.col("_nan") > 0) | F.lit(q - MARGIN <= 0 if low else q + MARGIN >= 1)
        return F.when(whole, F.col("_min" if low else "_max")).otherwise(F.col("_p")[2 * i + (not low)])

    brackets = materialize(found.select(*keys, "n", F.array(*[edge(i, True) for i in k]).alias("_low"), F.array(*[edge(i, False) for i in k]).alias("_high")), "quantile-brackets")
    # one pass: values inside a bracket are counted by value, all others by how many brackets they are above
    bounds = brackets
    if overall:
        mine = brackets.where("_all = 0").drop("_all", "n")
        whole = brackets.where("_all = 1").select(*rest, F.col("_low").alias("_low1"), F.col("_high").alias("_high1"))
        bounds = materialize(_null_safe(mine, whole, rest) if rest else mine.join(F.broadcast(whole)), "quantile-bounds")  # of known size
    placed = _null_safe(rows, bounds.drop("n"), by)
    sides = [("_low", "_high"), ("_low1", "_high1")][: 2 if overall else 1]
    inside = reduce(or_, [v.between(F.col(low)[i], F.col(high)[i]) for low, high in sides for i in k])
    above = [reduce(add, [(v >= F.col(low)[i]).cast("int") for i in k]).alias(f"_above{j}") for j, (low, _) in enumerate(sides)]
    counted = placed.select(*by, F.when(inside, v).alias("_x"), *above).groupBy(*by, "_x", *[f"_above{j}" for j in range(len(sides))]).agg(F.count(F.lit(1)).alias("_n"))
    counted = materialize(counted, "quantile-counts")
    if overall:
        counted = counted.where(F.col(overall).isNotNull()).select(F.lit(0).alias("_all"), *by, "_x", F.col("_above0").alias("_above"), "_n").unionByName(
            counted.select(F.lit(1).alias("_all"), *rest, none, "_x", F.col("_above1").alias("_above"), "_n")
        )
        brackets = brackets.where((F.col("_all") == 1) | F.col(overall).isNotNull())
    else:
        counted = counted.withColumnRenamed("_above0", "_above")
    counted = _null_safe(counted, brackets, keys)
    flat = counted.select(*keys, "n", "_x", "_above", "_n", F.posexplode(F.arrays_zip("_low", "_high")).alias("_i", "_b"))
    below = flat.groupBy(*keys, "n", "_i").agg(
        F.sum(F.when(F.when(F.col("_x").isNull(), F.col("_above") <= F.col("_i")).otherwise(F.col("_x") < F.col("_b._low")), F.col("_n")).otherwise(0)).alias("_below")
    )
    near = flat.where((F.col("_x") >= F.col("_b._low")) & (F.col("_x") <= F.col("_b._high"))).select(*keys, "_i", F.col("_x").alias("_v"), "_n")
    out = materialize(_interpolated(below, _ranked(near, [*keys, "_i"]), keys, quantiles), "quantile-results")
    if not out.where(F.exists("quantiles", lambda x: x.isNull())).isEmpty():
        all_rows = _levels(rows, overall) if overall else rows
        every_row = all_rows.select(*keys, "_v", F.lit(1).cast("bigint").alias("_n"), F.explode(F.array(*[F.lit(i) for i in k])).alias("_i"))
        out = _interpolated(below.withColumn("_below", F.lit(0).cast("bigint")), _ranked(every_row, [*keys, "_i"]), keys, quantiles)
    return out


def _levels(df: DataFrame, group: str) -> DataFrame:
    """Every row for its group and, where ``_all`` is 1, once more for all groups; null groups have no rows of their own."""
    none = F.lit(None).cast(df.schema[group].dataType)
    both = F.array(F.struct(F.lit(0).alias("_all"), F.col(group).alias(group)), F.struct(F.lit(1).alias("_all"), none.alias(group)))
    rest = [c for c in df.columns if c != group]
    return df.select(*rest, F.inline(both)).where((F.col("_all") == 1) | F.col(group).isNotNull())


def top_rows(df: DataFrame, by: list[str], score: str, key: str, k: int, name: str = "rank") -> DataFrame:
    """The ``k`` rows of highest ``score`` of each group, ranked from 1; ties by key. A null score is lowest.

    The k-th highest of the maxima of key buckets is reached by k rows at
    least, so only rows that reach it are sorted, however large the group.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(64 * k))
    maxima = materialize(df.where(F.col(score).isNotNull()).groupBy(*by, bucket.alias("_bucket")).agg(F.max(score).alias("_least")), "top-maxima")
    placed = maxima.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("_least"))))
    least = materialize(placed.where(F.col("_place") == k).select(*by, "_least"), "top-least")
    order = Window.partitionBy(*by).orderBy(F.col(score).desc_nulls_last(), F.col(key))
    kept = _null_safe(df, least, by, "left").where(F.col("_least").isNull() | (F.col(score) >= F.col("_least"))).drop("_least")
    return kept.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def with_running_sum(df: DataFrame, by: list[str], order: list[Column], value: Column, name: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of the group that come before, in an order that is total.

    The rows are range-partitioned by group and order, each partition adds up
    its own, and a table of partition totals shifts them: no task holds a group.
    """
    marks = [f"_o{i}" for i in range(len(order))]
    keyed = df.select("*", *[c.alias(m) for c, m in zip(order, marks)], value.cast("bigint").alias("_n")).withColumn("_g", F.xxhash64(*[c for b in by for c in (F.col(b), F.col(b).isNull())]))
    schema = StructType([*keyed.schema.fields, StructField("_part", IntegerType()), StructField("_before", LongType())])
    placed = materialize(keyed.repartitionByRange(*by, *marks).sortWithinPartitions(*by, *marks).mapInArrow(_running, schema), "running-sums")
    parts = placed.groupBy(*by, "_part").agg(F.sum("_n").alias("_t"))
    shifts = parts.select(*by, "_part", (F.sum("_t").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_t")).alias("_shift"))
    return _null_safe(placed, shifts, [*by, "_part"]).withColumn(name, F.col("_before") + F.col("_shift")).drop(*marks, "_n", "_g", "_part", "_before", "_shift")


def _interpolated(groups: DataFrame, ranked: DataFrame, by: list[str], quantiles: list[float]) -> DataFrame:
    rank = F.element_at(F.array(*[F.lit(float(q)) for q in quantiles]), F.col("_i") + 1) * (F.col("n") - 1)
    start = F.col("_below") + F.col("_before")
    rows = _null_safe(ranked, groups, [*by, "_i"]).withColumn("_h", rank).withColumn("_s", start)

    def at(place):
        return F.max(F.when((F.col("_s") <= place) & (place < F.col("_s") + F.col("_n")), F.col("_v")))

    ends = rows.groupBy(*by, "n", "_i").agg(F.max("_h").alias("_h"), at(F.floor("_h")).alias("_lo"), at(F.ceil("_h")).alias("_hi"))
    h = F.col("_h")
    value = F.when(F.floor(h) == F.ceil(h), F.col("_lo")).otherwise((F.ceil(h) - h) * F.col("_lo") + (h - F.floor(h)) * F.col("_hi"))
    found = ends.groupBy(*by, "n").agg(F.map_from_entries(F.collect_list(F.struct(F.col("_i"), value.alias("q")))).alias("_m"))
    return found.select(*by, "n", F.array(*[F.try_element_at("_m", F.lit(i)) for i in range(len(quantiles))]).alias("quantiles"))
