"""Scaling and imputation fitted on the training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.functions.numbers import finite
from quarrystone.operators.quantiles import _null_safe, exact_quantiles


def fit_partial(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """(by, name, n, total, squares) of the finite values: what partial fits are merged from."""
    long = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("name"), finite(F.col(c)).alias("x")) for c in columns])))
    return long.groupBy(*by, "name").agg(F.count("x").alias("n"), F.coalesce(F.sum("x"), F.lit(0.0)).alias("total"), F.coalesce(F.sum(F.col("x") * F.col("x")), F.lit(0.0)).alias("squares"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """(name, n, mean, std) over all partial fits; population deviation, null without rows."""
    sums = partials.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")])
    mean = F.try_divide(F.col("total"), F.col("n"))
    return sums.select("name", "n", mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("squares"), F.col("n")) - mean * mean)).alias("std"))


def check_scalers(scalers: DataFrame) -> None:
    """Raise if a deviation is 0, missing or not finite."""
    bad = [r["name"] for r in scalers.where(finite(F.col("std")).isNull() | (F.col("std") <= 0)).select("name").orderBy("name").limit(20).collect()]
    if bad:
        raise ValueError(f"no spread in {', '.join(bad)}")


def apply_zscore(df: DataFrame, scalers: DataFrame, columns: list[str], flag: str = "scaled") -> DataFrame:
    """(x - mean) / std of each column, null where undefined; rows already flagged stay as they are."""
    wide = scalers.where(F.col("name").isin(columns)).agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct("mean", "std")))).alias("_s"))
    out = df.join(F.broadcast(wide))
    done = F.coalesce(F.col(flag), F.lit(False)) if flag in df.columns else F.lit(False)

    def scaled(c: str) -> Column:
        s = F.try_element_at("_s", F.lit(c))
        return F.when(done, F.col(c)).otherwise(F.try_divide(finite(F.col(c)) - s["mean"], s["std"]))

    return out.withColumns({c: scaled(c) for c in columns} | {flag: F.lit(True)}).drop("_s")


def impute(df: DataFrame, columns: list[str], strategy: str = "median", fill: float = -1.0) -> DataFrame:
    """Columns without missing values: ``median`` or ``mean`` of the finite ones, ``fill`` a constant, ``drop`` leaves the rows out.

    NaN and infinities count as missing. A column without any finite value
    gets ``fill``. ``n_imputed`` counts the cells filled in the row.
    """
    if strategy not in ("median", "mean", "fill", "drop"):
        raise ValueError(f"unknown strategy {strategy!r}")
    known = {c: finite(F.col(c)) for c in columns}
    missing = sum((known[c].isNull().cast("int") for c in columns[1:]), known[columns[0]].isNull().cast("int"))
    if strategy == "drop":
        return df.where(missing == 0).withColumn("n_imputed", F.lit(0))
    if strategy == "fill":
        return df.withColumn("n_imputed", missing).withColumns({c: F.coalesce(known[c], F.lit(fill)) for c in columns})
    if strategy == "median":
        long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), known[c].alias("x")) for c in columns])))
        found = exact_quantiles(long, ["name"], "x", [0.5])
        middle = found.agg(*[F.max(F.when(F.col("name") == c, F.col("quantiles")[0])).alias(f"_m_{c}") for c in columns])
    else:
        middle = df.agg(*[F.avg(known[c]).alias(f"_m_{c}") for c in columns])
    out = df.withColumn("n_imputed", missing).join(F.broadcast(middle))
    return out.withColumns({c: F.coalesce(finite(F.col(c)), F.col(f"_m_{c}"), F.lit(fill)) for c in columns}).drop(*[f"_m_{c}" for c in columns])


def imputation_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, n_missing, mean, median) per column."""
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), finite(F.col(c)).alias("x")) for c in columns])))
    counts = long.groupBy("name").agg(F.count_if(F.col("x").isNull()).alias("n_missing"), F.avg("x").alias("mean"))
    return _null_safe(counts, exact_quantiles(long, ["name"], "x", [0.5]).drop("n"), ["name"], "left").select("name", "n_missing", "mean", F.col("quantiles")[0].alias("median"))
