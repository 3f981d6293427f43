"""Boolean predictions against a reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_predictions(df: DataFrame, predictions: dict[str, Column], truth: Column, keep: list[str]) -> DataFrame:
    """Long rows (keep, scheme, predicted, actual); null predictions or truths are left out."""
    cells = F.array(*[F.struct(F.lit(n).alias("scheme"), p.cast("boolean").alias("predicted")) for n, p in predictions.items()])
    return df.select(*keep, truth.cast("boolean").alias("actual"), F.inline(cells)).where(F.col("predicted").isNotNull() & F.col("actual").isNotNull())


def _counts() -> list[Column]:
    p, t = F.col("predicted"), F.col("actual")
    return [F.count_if(c).alias(n) for n, c in (("tp", p & t), ("fp", p & ~t), ("fn", ~p & t), ("tn", ~p & ~t))]


def with_scores(counts: DataFrame) -> DataFrame:
    """precision, recall and F1 from tp, fp, fn, tn; null where a denominator is 0."""
    precision, recall = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.withColumn("precision", precision).withColumn("recall", recall).withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def f1_by(long: DataFrame, *groups: str) -> DataFrame:
    """Counts and scores per scheme (and further groups) of unpivoted predictions."""
    return with_scores(long.groupBy("scheme", *groups).agg(*_counts()))


def f1_rollup(long: DataFrame, level: str) -> DataFrame:
    """Per scheme and ``level``, and per scheme over all levels (level null): sums of counts, scores derived anew."""
    return with_scores(long.groupingSets([["scheme", level], ["scheme"]], "scheme", level).agg(F.grouping(level).alias("combined"), *_counts()))


def disagreements(df: DataFrame, predictions: dict[str, Column], truth: Column) -> DataFrame:
    """Rows in which a known prediction differs from the known truth, with how many do."""
    wrong = F.filter(F.array(*[F.when(p.cast("boolean") != truth.cast("boolean"), F.lit(n)) for n, p in predictions.items()]), lambda x: x.isNotNull())
    return df.withColumn("n_wrong", F.size(wrong)).withColumn("wrong", F.array_join(wrong, ",")).where(F.col("n_wrong") > 0)
