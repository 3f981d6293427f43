"""Arrays of numbers as vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Norms below this are taken for 0 by the cosine.
NO_NORM = 1e-10


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def all_finite(a: Column) -> Column:
    return F.forall(a, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is null, differs in length, has no norm or an entry that is not finite."""
    good = (F.size(a) == F.size(b)) & all_finite(a) & all_finite(b) & (norm(a) >= NO_NORM) & (norm(b) >= NO_NORM)
    return F.when(good, F.try_divide(dot(a, b), norm(a) * norm(b)))


def unit(a: Column) -> Column:
    """Divided by its norm; unchanged if that is 0 or an entry is not finite."""
    n = norm(a)
    return F.when(all_finite(a) & (n > 0), F.transform(a, lambda x: x.cast("double") / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


def distance(ax: Column, ay: Column, az: Column, bx: Column, by: Column, bz: Column) -> Column:
    dx, dy, dz = ax - bx, ay - by, az - bz
    return F.sqrt(dx * dx + dy * dy + dz * dz)
