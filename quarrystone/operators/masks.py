"""Column profiles from character-class masks of the values.

A value's mask replaces each run of digits by ``9``, of letters by ``a`` and
keeps other characters, so that ``56.313`` and ``118.9`` share ``9.9``. Masks
are counted per column and load; the frequent ones are the column's dominant
patterns, values with any other mask are suspects, and the distance between
the mask distributions of loads shows a shift.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.session import materialize

#: The spellings of an absent value, outer blanks and case aside.
ABSENT = ("", "none", "null", "nan")
#: Of masks longer than this a digest stands for the rest, so that a mask is always short and no two become one.
MASK_LENGTH = 48


def mask_of(value: Column) -> Column:
    """The character-class mask of a text; null for null."""
    masked = F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), r"[0-9]+", "9")
    return F.when(F.length(masked) > MASK_LENGTH, F.concat(F.substring(masked, 1, MASK_LENGTH), F.lit("~"), F.hex(F.xxhash64(masked)))).otherwise(masked)


def is_absent(value: Column) -> Column:
    """Null, or one of the absent spellings, ignoring outer U+0020 and case."""
    return value.isNull() | F.lower(F.trim(value)).isin(*ABSENT)


def is_truth(value: Column) -> Column:
    return F.lower(F.trim(value)).isin("true", "false")


def is_count(value: Column, low: int = 1, high: int = 10_000) -> Column:
    """ASCII digits only, worth ``low`` to ``high``."""
    text = F.trim(value)
    digits = F.regexp_replace(text, "^0+(?=[0-9])", "")
    return text.rlike(r"\A[0-9]+\z") & (F.length(digits) <= len(str(high))) & F.coalesce(F.try_to_number(digits, F.lit("9" * len(str(high)))).between(low, high), F.lit(False))


def is_seconds(value: Column) -> Column:
    """A finite number of at least 0: ASCII digits, optional fraction, optional exponent."""
    text = F.trim(value)
    number = text.try_cast("double")
    return text.rlike(r"\A[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?\z") & F.coalesce((number >= 0) & (number < float("inf")), F.lit(False))


@dataclass(frozen=True)
class ColumnRule:
    """What a column's values must be beyond having a usual mask."""

    name: str
    valid: object
    numeric: bool = False


#: The columns of the validation table and what their values must be.
VALIDATION_RULES = (
    ColumnRule("val_qtaim", is_truth),
    ColumnRule("val_charge", is_truth),
    ColumnRule("n_atoms", is_count, True),
    ColumnRule("total_time", is_seconds, True),
)


@dataclass(frozen=True)
class MaskProfile:
    """``share``: of its column, above which a mask is dominant."""

    rules: tuple[ColumnRule, ...] = field(default=VALIDATION_RULES)
    share: float = 0.01
    divergence: float = 0.005
    times_median: float = 3.0
    null_gap: float = 0.03

    def cells(self, df: DataFrame, id_col: str, load_col: str) -> DataFrame:
        """A row per cell: (row_id, load_no, field, value, mask, absent, valid, number)."""
        parts = []
        for rule in self.rules:
            value = F.col(rule.name).cast("string")
            ok = F.coalesce(rule.valid(value), F.lit(False))
            parts.append(
                F.struct(
                    F.lit(rule.name).alias("field"),
                    F.trim(value).alias("value"),
                    F.when(~is_absent(value), mask_of(F.trim(value))).alias("mask"),
                    is_absent(value).alias("absent"),
                    ok.alias("valid"),
                    (F.when(ok, F.trim(value).try_cast("double")) if rule.numeric else F.lit(None).cast("double")).alias("number"),
                )
            )
        return df.select(F.col(id_col).alias("row_id"), F.col(load_col).alias("load_no"), F.inline(F.array(*parts)))

    def mask_counts(self, cells: DataFrame) -> DataFrame:
        """(field, load_no, mask, n, n_valid) over the present cells."""
        return cells.where(~F.col("absent")).groupBy("field", "load_no", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("valid").cast("bigint")).alias("n_valid"))

    def judged(self, mask_counts: DataFrame) -> DataFrame:
        """Every mask of a column with how its values fare: (field, mask, n, n_valid, mask_share)."""
        per_mask = materialize(mask_counts.groupBy("field", "mask").agg(F.sum("n").alias("n"), F.sum("n_valid").alias("n_valid")), "masks")
        per_field = per_mask.groupBy("field").agg(F.sum("n").alias("total"))
        return per_mask.join(F.broadcast(per_field), "field").select("field", "mask", "n", "n_valid", (F.col("n") / F.col("total")).alias("mask_share"))

    def dominant(self, mask_counts: DataFrame) -> DataFrame:
        """The dominant masks: (field, mask, mask_share); at most 1/share per field."""
        return self.judged(mask_counts).where(F.col("mask_share") >= self.share).select("field", "mask", "mask_share")

    def violations(self, df: DataFrame, id_col: str, load_col: str) -> DataFrame:
        """Ill-formed cells: (row_id, load_no, field, value, mask, reason).

        Masks decide first: a mask of which all values are valid has no
        violations, one of which none is valid has only violations; the values
        of a mixed mask are put to the exact rule one by one. ``rare_mask``
        tells a mask that is rare in its column, ``bad_value`` a dominant one.
        Absent cells are none. The dominant masks are at most ``1/share`` per
        column, so their broadcast is bounded; cells of rare masks, none of
        which is hot, meet theirs in a hash join.
        """
        cells = self.cells(df, id_col, load_col).where(~F.col("absent"))
        judged = self.judged(self.mask_counts(cells))
        usual, suspect = F.col("mask_share") >= self.share, F.col("n_valid") < F.col("n")
        marked = cells.join(F.broadcast(judged.where(usual)), ["field", "mask"], "left")
        open_cells = materialize(marked.where(F.col("mask_share").isNull() | suspect), "mask-suspects")
        frequent = open_cells.where(F.col("mask_share").isNotNull()).withColumn("reason", F.lit("bad_value"))
        rare = open_cells.where(F.col("mask_share").isNull()).drop("n", "n_valid", "mask_share").join(judged.where(~usual & suspect), ["field", "mask"])
        return (
            frequent.unionByName(rare.withColumn("reason", F.lit("rare_mask")))
            .where((F.col("n_valid") == 0) | ~F.col("valid"))
            .select("row_id", "load_no", "field", "value", "mask", "reason")
        )

    def profile(self, df: DataFrame, id_col: str, load_col: str) -> DataFrame:
        """One row per column and load.

        Counts, absent and ill-formed shares, exact distinct values, range of
        the valid numbers, the commonest mask with its share, the
        Jensen-Shannon divergence of the load's masks from those of all other
        loads, the same of the values (numbers in eighths of the whole column,
        truth values by their spelling), the gap of the absent share to its
        median over loads, and ``differs`` where a divergence is above both
        ``divergence`` and ``times_median`` times its median over the column's
        loads, or the gap is above ``null_gap``. Columns without values have null ranges. Null loads
        form a load of their own.
        """
        cells = self.cells(df, id_col, load_col)
        values = cells.groupBy("field", "load_no", "value", "mask", "absent", "valid", "number").agg(F.count(F.lit(1)).alias("n"))
        base = values.groupBy("field", "load_no").agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.when(F.col("absent"), F.col("n")).otherwise(0)).alias("n_absent"),
            F.sum(F.when(~F.col("absent") & ~F.col("valid"), F.col("n")).otherwise(0)).alias("n_violations"),
            F.count(F.when(~F.col("absent"), 1)).alias("n_distinct"),
            F.min("number").alias("min_number"),
            F.max("number").alias("max_number"),
        )
        masks = values.where(~F.col("absent")).groupBy("field", "load_no", "mask").agg(F.sum("n").alias("n"))
        top = masks.groupBy("field", "load_no").agg(F.max_by("mask", F.struct("n", "mask")).alias("top_mask"), F.max("n").alias("_top"), F.sum("n").alias("_present"))
        edges = (
            values.where(F.col("number").isNotNull()).groupBy("field").agg(F.percentile_approx("number", F.array(*[F.lit(q / 8) for q in range(1, 8)]), F.lit(10_000)).alias("edges"))
        )
        bins = (
            values.where(F.col("number").isNotNull())
            .join(F.broadcast(edges), "field")
            .select("field", "load_no", "n", F.size(F.filter("edges", lambda e: e <= F.col("number"))).cast("string").alias("bin"))
            .unionByName(values.where(F.col("valid") & F.col("number").isNull()).select("field", "load_no", "n", F.lower("value").alias("bin")))
            .groupBy("field", "load_no", "bin")
            .agg(F.sum("n").alias("n"))
        )
        out = _attach(base, top)
        for gap in (_divergence(masks, "mask", "mask_divergence"), _divergence(bins, "bin", "value_divergence")):
            out = _attach(out, gap)
        out = out.withColumn("absent_share", F.col("n_absent") / F.col("n_rows"))
        usual = out.groupBy("field").agg(*[F.percentile(c, 0.5).alias(f"_{c}") for c in ("absent_share", "mask_divergence", "value_divergence")])
        out = out.join(F.broadcast(usual), "field").withColumn("absent_gap", F.col("absent_share") - F.col("_absent_share"))
        shifted = [F.col(c) > F.greatest(F.lit(self.divergence), self.times_median * F.col(f"_{c}")) for c in ("mask_divergence", "value_divergence")]
        return out.select(
            "field", "load_no", "n_rows", "n_absent", "absent_share", "n_violations", "n_distinct", "min_number", "max_number", "top_mask",
            F.try_divide(F.col("_top"), F.col("_present")).alias("top_mask_share"),
            "mask_divergence", "value_divergence", "absent_gap",
            (F.coalesce(shifted[0], F.lit(False)) | F.coalesce(shifted[1], F.lit(False)) | (F.abs("absent_gap") > self.null_gap)).alias("differs"),
        )


def _attach(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` with the other columns of ``right`` of the same column and load, nulls matching."""
    renamed = right.withColumnsRenamed({"field": "_field", "load_no": "_load_no"})
    on = (F.col("field") == F.col("_field")) & F.col("load_no").eqNullSafe(F.col("_load_no"))
    return left.join(renamed, on, "left").drop("_field", "_load_no")


def _divergence(counts: DataFrame, item: str, name: str) -> DataFrame:
    """Jensen-Shannon divergence (natural log) of each load's items from the rest of its column."""
    everywhere = counts.groupBy("field", item).agg(F.sum("n").alias("_all"))
    per_load = counts.groupBy("field", "load_no").agg(F.sum("n").alias("_load"))
    per_field = counts.groupBy("field").agg(F.sum("n").alias("_total"))
    grid = (
        everywhere.join(per_load, "field")  # loads of the same column, a handful
        .join(F.broadcast(per_field), "field")
        .join(counts.select("field", F.col("load_no").alias("_l"), F.col(item).alias("_i"), F.col("n")).withColumnRenamed("field", "_f"), (F.col("_f") == F.col("field")) & F.col("_l").eqNullSafe(F.col("load_no")) & (F.col("_i") == F.col(item)), "left")
    )
    p = F.coalesce(F.col("n"), F.lit(0)) / F.col("_load")
    q = F.coalesce(F.try_divide(F.col("_all") - F.coalesce(F.col("n"), F.lit(0)), F.col("_total") - F.col("_load")), F.lit(0.0))
    m = (p + q) / 2
    part = (F.when(p > 0, p * F.log(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log(q / m)).otherwise(0.0)) / 2
    return grid.groupBy("field", "load_no").agg(F.round(F.sum(part), 9).alias(name))
