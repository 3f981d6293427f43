"""Numbers: finite values, guarded division and correlation, text to number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    """The value as a double, null where it is NaN, infinite or null."""
    x = value.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def finite_or_zero(value: Column) -> Column:
    """A number from text or number: null if it is none, 0 for NaN and infinities."""
    x = value.try_cast("double")
    return F.when(x.isNull(), F.lit(None).cast("double")).when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)


def correlation_from_sums(n: Column, a: Column, b: Column, aa: Column, bb: Column, ab: Column) -> Column:
    """Pearson's r from sums; null below two rows or without variance."""
    var_a, var_b = n * aa - a * a, n * bb - b * b
    return F.when((n >= 2) & (var_a > 0) & (var_b > 0), F.try_divide(n * ab - a * b, F.sqrt(var_a) * F.sqrt(var_b)))


def correlation(a: Column, b: Column) -> Column:
    """Aggregate Pearson's r over rows where both are finite; null where undefined."""
    both = finite(a).isNotNull() & finite(b).isNotNull()
    x, y = F.when(both, finite(a)), F.when(both, finite(b))
    return F.try_divide(F.covar_pop(x, y), F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0)))


def fortran_number(text: Column) -> Column:
    """A number with ``D`` or ``E`` exponent; null for asterisks and other text."""
    t = F.trim(text)
    return F.when(~t.contains("*"), F.regexp_replace(t, "[Dd]", "E").try_cast("double"))


def overflow_number(text: Column) -> Column:
    """As fortran_number, but an exponent without its letter (``1.0+120``) is +-1e10."""
    t = F.trim(text)
    return F.when(t.rlike(r"^[+-]?[0-9]*\.?[0-9]+[+-][0-9]{3}$"), F.when(t.startswith("-"), F.lit(-1e10)).otherwise(F.lit(1e10))).otherwise(fortran_number(t))


def glued_numbers(text: Column) -> Column:
    """All numbers of a line, also where a minus follows the digit before; units are left out."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"([+-]?[0-9]+\.?[0-9]*(?:[EeDd][+-]?[0-9]+)?)"), F.lit(1)), fortran_number)


def run_seconds(text: Column) -> Column:
    """Seconds of a run time such as ``0 days 1 hours 2 minutes 3 seconds 456 msec``; null if it is none."""

    def part(unit: str) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(text, rf"([0-9]+)\s*{unit}", 1), F.lit("")).cast("double"), F.lit(0.0))

    total = part("days?") * 86400 + part("hours?") * 3600 + part("minutes?") * 60 + part("seconds?") + part("msec") / 1000
    return F.when(text.rlike(r"[0-9]+\s*(days?|hours?|minutes?|seconds?|msec)"), total)


def signed_log(value: Column) -> Column:
    """sign(x) log10(|x| + 1)."""
    return F.signum(value) * F.log10(F.abs(value) + 1)


def human_bytes(value: Column) -> Column:
    """Bytes in the largest binary unit up to T in which they are at least 1, two decimals."""
    x = value.cast("double")
    out = F.format_string("%.2f T", x / 2**40)
    for power, unit in ((3, "G"), (2, "M"), (1, "K"), (0, "B")):
        out = F.when(x < 1024 ** (power + 1), F.format_string(f"%.2f {unit}", x / 1024**power)).otherwise(out)
    return out
