"""How far several numeric schemes agree on the same rows."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.functions.numbers import correlation, correlation_from_sums, finite
from quarrystone.functions.vectors import all_finite, cosine, norm
from quarrystone.operators.quantiles import _levels, _null_safe, exact_quantiles, top_rows


def scheme_pairs(df: DataFrame, schemes: dict[str, Column], keep: list[str]) -> DataFrame:
    """Long rows (keep, scheme_a, scheme_b, a, b) of every pair of schemes finite in a row."""
    names = list(schemes)
    values = {n: finite(c) for n, c in schemes.items()}
    pairs = F.array(*[F.struct(F.lit(x).alias("scheme_a"), F.lit(y).alias("scheme_b"), values[x].alias("a"), values[y].alias("b")) for x, y in combinations(names, 2)])
    return df.select(*keep, F.inline(pairs)).where(F.col("a").isNotNull() & F.col("b").isNotNull())


def residual_quantiles(pairs: DataFrame, group: str, residual: str = "residual") -> DataFrame:
    """(scheme_a, scheme_b, group, _all, n_obs, quantiles): quartiles of the residuals per pair and group and over all groups."""
    return exact_quantiles(pairs, ["scheme_a", "scheme_b", group], residual, [0.25, 0.5, 0.75], overall=group).withColumnRenamed("n", "n_obs")


def pair_agreement(df: DataFrame, schemes: dict[str, Column], group: str) -> DataFrame:
    """Sufficient statistics, Pearson's r and residual quantiles per scheme pair, over all rows and per group.

    NaN and infinities count as missing. A row is used by a pair if both
    values are finite; a pair without rows has no output row. ``level`` is
    ``all`` or ``group``; rows of a null group take part in ``all`` only.
    """
    pairs = scheme_pairs(df, schemes, [group])
    a, b = F.col("a"), F.col("b")
    sums = {"sum_a": a, "sum_b": b, "sum_aa": a * a, "sum_bb": b * b, "sum_ab": a * b, "sum_abs_residual": F.abs(a - b)}
    per_group = pairs.groupBy("scheme_a", "scheme_b", group).agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(name) for name, x in sums.items()])
    totals = _levels(per_group, group).groupBy("scheme_a", "scheme_b", "_all", group).agg(*[F.sum(c).alias(c) for c in ("n", *sums)])
    quartiles = residual_quantiles(pairs.select("scheme_a", "scheme_b", group, F.abs(a - b).alias("residual")), group)
    r = correlation_from_sums(*[F.col(c) for c in ("n", "sum_a", "sum_b", "sum_aa", "sum_bb", "sum_ab")])
    return _beside(totals, quartiles.drop("n_obs"), group).select(
        F.when(F.col("_all") == 1, "all").otherwise("group").alias("level"), "scheme_a", "scheme_b", group, "n", "sum_a", "sum_b", "sum_aa", "sum_bb", "sum_ab",
        (F.col("sum_abs_residual") / F.col("n")).alias("mean_abs_residual"), F.col("quantiles")[1].alias("median_abs_residual"), (F.col("quantiles")[2] - F.col("quantiles")[0]).alias("iqr_abs_residual"), r.alias("pearson"),
    )


def _beside(left: DataFrame, right: DataFrame, group: str) -> DataFrame:
    """Joined by pair, level and group; null groups match."""
    keys = ["scheme_a", "scheme_b", "_all", group]
    other = right.withColumnsRenamed({c: f"_r{i}" for i, c in enumerate(keys)})
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_r{i}"))
    return left.join(other, same).drop(*[f"_r{i}" for i in range(len(keys))])


def top_keys(pairs: DataFrame, by: list[str], key: str, score: Column, k: int) -> DataFrame:
    """(by, keys): the keys of the ``k`` highest scores as JSON text, repeated keys once, ties by key."""
    ranked = pairs.withColumn("_s", score).withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("_s"), F.col(key)))).where(F.col("_r") <= k)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_r", F.col(key).cast("string").alias("k")))), lambda x: x["k"])
    return ranked.groupBy(*by).agg(F.to_json(F.array_distinct(ordered)).alias("top_keys"))


def noise_floor(df: DataFrame, schemes: dict[str, Column], group: str, key: str, k: int = 50) -> DataFrame:
    """Median and spread of absolute residuals per scheme pair, over all rows and per group, with the keys that disagree most."""
    pairs = scheme_pairs(df, schemes, [group, key]).select(group, key, "scheme_a", "scheme_b", F.abs(F.col("a") - F.col("b")).alias("residual"))
    # the highest of all groups are among the highest of each
    highest = top_rows(pairs, ["scheme_a", "scheme_b", group], "residual", key, k)
    tops = top_keys(_levels(highest, group), ["scheme_a", "scheme_b", "_all", group], key, F.col("residual"), k)
    return _beside(residual_quantiles(pairs, group), tops, group).select(
        "scheme_a", "scheme_b", group, F.col("quantiles")[1].alias("mar"), (F.col("quantiles")[2] - F.col("quantiles")[0]).alias("iqr"), "n_obs", "top_keys"
    )


def exemplars(df: DataFrame, schemes: dict[str, Column], group: str, key: str, k: int) -> DataFrame:
    """The ``k`` rows of each group with the widest spread over at least two finite schemes; ties by key."""
    values = F.filter(F.array(*[finite(c) for c in schemes.values()]), lambda x: x.isNotNull())
    spread = df.select(group, key, values.alias("_v")).where((F.size("_v") >= 2) & F.col(group).isNotNull()).select(group, key, (F.array_max("_v") - F.array_min("_v")).alias("spread"))
    return top_rows(spread, [group], "spread", key, k)


def redundancy(df: DataFrame, descriptors: dict[str, Column], group: str, least: int = 2) -> DataFrame:
    """Pearson's r of every pair of descriptors, over all rows and per group of at least ``least`` rows."""
    pairs = scheme_pairs(df, descriptors, [group])
    out = _levels(pairs, group).groupBy("scheme_a", "scheme_b", "_all", group).agg(F.count(F.lit(1)).alias("n"), correlation(F.col("a"), F.col("b")).alias("pearson"))
    return out.where(F.col("n") >= least).select("scheme_a", "scheme_b", group, "n", "pearson")


def scheme_weighted_floor(floors: DataFrame, by: list[str], value: str = "mar", weight: str = "n_obs") -> DataFrame:
    """(by, scheme, n, weighted_mar): each scheme's mean over the pairs it takes part in, weighted; a missing weight is 0."""
    w = F.coalesce(F.col(weight), F.lit(0))
    long = floors.select(*by, F.explode(F.array("scheme_a", "scheme_b")).alias("scheme"), F.col(value).alias("v"), w.alias("w"))
    return long.groupBy(*by, "scheme").agg(F.sum("w").alias("n"), F.try_divide(F.sum(F.col("v") * F.col("w")), F.sum("w")).alias("weighted_mar"))


def vector_agreement(df: DataFrame, vectors: dict[str, Column], group: str) -> DataFrame:
    """Per pair of vector columns and group: rows with a cosine, its median and 10th percentile, and Pearson's r of the lengths.

    A vector must be finite; the cosine also needs vectors of one length that
    are not zero. Lengths count where both vectors are finite.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(x).alias("scheme_a"), F.lit(y).alias("scheme_b"), cosine(vectors[x], vectors[y]).alias("cosine"),
                F.when(all_finite(vectors[x]), norm(vectors[x])).alias("a"), F.when(all_finite(vectors[y]), norm(vectors[y])).alias("b"),
            )
            for x, y in combinations(list(vectors), 2)
        ]
    )
    long = df.select(group, F.inline(pairs)).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    keys = ["scheme_a", "scheme_b", group]
    sums = long.groupBy(*keys).agg(F.count("cosine").alias("n"), F.count(F.lit(1)).alias("n_lengths"), correlation(F.col("a"), F.col("b")).alias("pearson"))
    found = exact_quantiles(long, keys, "cosine", [0.5, 0.1]).drop("n")
    return _null_safe(sums, found, keys, "left").select(*keys, "n", F.col("quantiles")[0].alias("cosine_p50"), F.col("quantiles")[1].alias("cosine_p10"), "n_lengths", "pearson")


def pair_medians(pairs: DataFrame, by: list[str]) -> DataFrame:
    """(by, mar, n_obs): median absolute residual and rows of each group of scheme pairs."""
    residuals = pairs.select(*by, F.abs(F.col("a") - F.col("b")).alias("residual"))
    return exact_quantiles(residuals, by, "residual", [0.5]).select(*by, F.col("quantiles")[0].alias("mar"), F.col("n").alias("n_obs"))
