"""Counts, distributions and outliers of tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.functions.numbers import correlation, finite, signed_log
from quarrystone.operators.quantiles import _null_safe, exact_quantiles

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def unpivot(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Long rows (keep, name, value) of numeric columns, values as doubles."""
    return df.select(*keep, F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])))


def numeric_profile(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Per column: rows, known, NaN and infinite values; mean, population deviation, range and quantiles of the finite ones (null if none)."""
    long = unpivot(df, columns, list(by)).withColumn("x", finite(F.col("value")))
    out = long.groupBy(*by, "name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("x").alias("n_finite"), F.count_if(F.isnan("value")).alias("n_nan"), F.count_if(F.abs("value") == float("inf")).alias("n_inf"),
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"),
    )
    out = _null_safe(out, exact_quantiles(long, [*by, "name"], "x", list(QUANTILES)).drop("n"), [*by, "name"], "left")
    return out.select(*by, "name", "n_rows", "n_finite", "n_nan", "n_inf", "mean", "std", "min", "max", *[F.col("quantiles")[i].alias(f"p{int(q * 100)}") for i, q in enumerate(QUANTILES)])


def range_summary(profile: DataFrame) -> DataFrame:
    """(name, center, spread, low, high): mean and std, 5th and 95th percentile; without one the range stands in, else 0."""
    zero = F.lit(0.0)
    return profile.select("name", F.coalesce("mean", zero).alias("center"), F.coalesce("std", zero).alias("spread"), F.coalesce("p5", "min", zero).alias("low"), F.coalesce("p95", "max", zero).alias("high"))


def missing_share(df: DataFrame, columns: list[str], top: int = 30) -> DataFrame:
    """The ``top`` columns by share of values that are null or NaN; ties by name. The limit is the report's."""
    long = unpivot(df, columns)
    return long.groupBy("name").agg(F.avg((F.col("value").isNull() | F.isnan("value")).cast("double")).alias("missing_share")).orderBy(F.desc("missing_share"), "name").limit(top)


def histogram(df: DataFrame, column: str, bins: int, low: float = 0.01, high: float = 0.99, log: bool = False) -> DataFrame:
    """(bin, n) of the finite values between two percentiles, bounds included, optionally of their signed logarithm."""
    values = df.select(finite(F.col(column)).alias("x")).where(F.col("x").isNotNull())
    if log:
        values = values.select(signed_log(F.col("x")).alias("x"))
    bounds = exact_quantiles(values, [], "x", [low, high]).select(F.col("quantiles")[0].alias("lo"), F.col("quantiles")[1].alias("hi"))
    inside = values.join(F.broadcast(bounds)).where(F.col("x").between(F.col("lo"), F.col("hi")))
    place = F.least(F.lit(bins), F.floor(F.try_divide((F.col("x") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))).cast("int") + 1)
    return inside.select(F.coalesce(place, F.lit(1)).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def outlier_share(df: DataFrame, columns: list[str], sigmas: float) -> DataFrame:
    """Per column: finite values and the share farther than ``sigmas`` population deviations from the mean; null without spread."""
    long = unpivot(df, columns).select("name", finite(F.col("value")).alias("x")).where(F.col("x").isNotNull())
    stats = long.groupBy("name").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    far = F.avg(F.when(F.col("s") > 0, (F.abs(F.col("x") - F.col("m")) > sigmas * F.col("s")).cast("double")))
    return long.join(F.broadcast(stats), "name").groupBy("name").agg(F.count(F.lit(1)).alias("n"), far.alias("outlier_share"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, n, pearson) of every pair of columns over rows where both are finite; one pass."""
    pairs = list(combinations(columns, 2))
    aggs = []
    for i, (x, y) in enumerate(pairs):
        both = finite(F.col(x)).isNotNull() & finite(F.col(y)).isNotNull()
        aggs += [F.count_if(both).alias(f"n{i}"), correlation(F.col(x), F.col(y)).alias(f"r{i}")]
    row = df.agg(*aggs)
    return row.select(F.inline(F.array(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"n{i}").alias("n"), F.col(f"r{i}").alias("pearson")) for i, (x, y) in enumerate(pairs)])))


def top_group_distribution(df: DataFrame, group: str, value: str, top: int) -> DataFrame:
    """Quartiles of the finite values of the ``top`` groups by rows (NaN rows count in the ranking, groups without finite values drop out after it)."""
    largest = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), group).limit(top)
    x = finite(F.col(value))
    rows = df.select(group, x.alias("_x")).join(F.broadcast(largest), group)  # ``top`` rows
    found = exact_quantiles(rows, [group, "n_rows"], "_x", [0.25, 0.5, 0.75])
    return found.select(group, "n_rows", F.col("n").alias("n_finite"), *[F.col("quantiles")[i].alias(f"p{p}") for i, p in enumerate((25, 50, 75))])


def clipped_values(df: DataFrame, label: str, value: str, low: float, high: float) -> DataFrame:
    """Per label: bounds at two percentiles, how many finite values lie within (inclusive), their mean."""
    rows = df.select(label, finite(F.col(value)).alias("x")).where(F.col("x").isNotNull())
    bounds = exact_quantiles(rows, [label], "x", [low, high]).select(label, F.col("quantiles")[0].alias("low"), F.col("quantiles")[1].alias("high"))
    inside = _null_safe(rows, bounds, [label]).where(F.col("x").between(F.col("low"), F.col("high")))
    return inside.groupBy(label, "low", "high").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"))


def shared_profiles(left: DataFrame, right: DataFrame) -> DataFrame:
    """Profiles of the names both tables have, side by side."""
    return left.select("name", F.col("mean").alias("mean_left"), F.col("std").alias("std_left")).join(right.select("name", F.col("mean").alias("mean_right"), F.col("std").alias("std_right")), "name")


def pair_counts(df: DataFrame, left: str, right: str, record: list[str]) -> DataFrame:
    """(left, right, n_links, n_records), most links first; ties by the pair."""
    return df.groupBy(left, right).agg(F.count(F.lit(1)).alias("n_links"), F.countDistinct(F.struct(*record)).alias("n_records")).orderBy(F.desc("n_links"), left, right)


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def latest_records(records: DataFrame, key: str = "struct_id", loaded_at: str = "loaded_at") -> DataFrame:
    """One row per record, the one loaded last; ties by the row's hash, nulls earliest."""
    return latest(records, [key], [F.col(loaded_at).desc_nulls_last(), F.xxhash64(*[c for c in records.columns if c != key])])
