"""Nested records as rows of atoms, bonds and points, and their features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.functions.elements import ACTINIDES, LANTHANIDES, SYMBOLS, TRANSITION_METALS


def element(name: Column) -> Column:
    """An element's spelling without case and outer blanks: upper case."""
    return F.upper(F.trim(name))


def atom_rows(structures: DataFrame, keep: list[str], molecule: str = "molecule") -> DataFrame:
    """(keep, i, el, x, y, z), i from 0; records without molecule have no rows."""
    return structures.select(*keep, F.posexplode(molecule).alias("i", "a")).select(*keep, "i", element(F.col("a.elem")).alias("el"), "a.x", "a.y", "a.z")


def bond_rows(structures: DataFrame, keep: list[str], bonds: str = "bonds") -> DataFrame:
    """(keep, i, j) with i <= j, each bond once, a bond of an atom with itself left out."""
    flat = structures.select(*keep, F.explode(bonds).alias("b"))
    return flat.select(*keep, F.least("b.i", "b.j").alias("i"), F.greatest("b.i", "b.j").alias("j")).where(F.col("i") != F.col("j")).distinct()


def element_pairs(structures: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, i, j, el_a, el_b): listed bonds with their elements in order; ``?`` where the index is no atom's."""
    flat = structures.select(*keep, F.transform("molecule", lambda a: element(a["elem"])).alias("_e"), F.explode("bonds").alias("b"))
    a, b = (F.coalesce(F.get("_e", F.col(f"b.{c}")), F.lit("?")) for c in "ij")
    return flat.select(*keep, F.least("b.i", "b.j").alias("i"), F.greatest("b.i", "b.j").alias("j"), F.least(a, b).alias("el_a"), F.greatest(a, b).alias("el_b"))


def composition(molecule: Column) -> Column:
    """All elements in order, joined; the same for the same counts. Null for null."""
    return F.when(molecule.isNotNull(), F.array_join(F.array_sort(F.transform(molecule, lambda a: element(a["elem"]))), ","))


def _counted(molecule: Column, order) -> Column:
    symbols = F.transform(molecule, lambda a: F.initcap(F.trim(a["elem"])))
    kinds = F.array_sort(F.transform(F.array_distinct(symbols), lambda e: F.struct(order(e, symbols).alias("o"), e.alias("e"), F.size(F.filter(symbols, lambda x: x == e)).alias("n"))))
    return kinds


def _joined(kinds: Column, sep: str = "", ones: bool = False) -> Column:
    return F.array_join(F.transform(kinds, lambda k: F.concat(k["e"], F.when((k["n"] > 1) | F.lit(ones), k["n"].cast("string")).otherwise(F.lit("")))), sep)


def hill_formula(molecule: Column) -> Column:
    """C and H first, then by alphabet; all by alphabet without carbon. A count of 1 is not written."""
    return _joined(_counted(molecule, lambda e, all_: F.when(F.array_contains(all_, F.lit("C")) & (e == "C"), 0).when(F.array_contains(all_, F.lit("C")) & (e == "H"), 1).otherwise(2)))


def alphabetical_formula(molecule: Column) -> Column:
    """Elements by alphabet with their counts, also 1, apart by blanks."""
    return _joined(_counted(molecule, lambda e, _: F.lit(0)), " ", True)


def compact_formula(molecule: Column) -> Column:
    """As alphabetical_formula without the blanks."""
    return F.replace(alphabetical_formula(molecule), F.lit(" "), F.lit(""))


def atomic_number(symbol: Column) -> Column:
    """1.. of a symbol, ignoring case and blanks; null if it is none."""
    table = F.array(*[F.lit(s.upper()) for s in SYMBOLS])
    return F.nullif(F.array_position(table, element(symbol)).cast("int"), F.lit(0))


def element_class(z: Column) -> Column:
    """``tm``, ``ln``, ``an`` or null."""
    tm = F.lit(False)
    for low, high in TRANSITION_METALS:
        tm = tm | z.between(low, high)
    return F.when(tm, "tm").when(z.between(*LANTHANIDES), "ln").when(z.between(*ACTINIDES), "an")


def manifest(structures: DataFrame, key: str = "record_key") -> DataFrame:
    """One row per structure: the declared columns of a manifest.

    ``read_status`` is ok, missing_structure or missing_charge_or_spin; other
    columns are null where what they need is missing.
    """
    zs = F.transform("molecule", lambda a: atomic_number(a["elem"]))
    classes = F.transform(zs, element_class)
    symbols = F.array_sort(F.array_distinct(F.transform("molecule", lambda a: F.initcap(F.trim(a["elem"])))))
    known = F.size("molecule") > 0
    return structures.select(
        "vertical", F.col(key).alias("rel_path"), F.element_at(F.split(key, "__"), -1).alias("job_id"), F.size(F.split(key, "__")).alias("folder_depth"),
        "charge", F.col("spin").alias("mult"), ((F.col("spin") - 1) / 2).cast("float").alias("spin"), F.when(known, F.size("molecule")).alias("n_atoms"),
        F.when(known, F.array_join(symbols, ",")).alias("element_set"), F.when(known, F.size(symbols)).alias("n_unique_elements"), F.when(known, hill_formula(F.col("molecule"))).alias("formula_hill"),
        F.when(known, F.array_max(zs)).alias("heaviest_z"),
        *[F.when(known, F.coalesce(F.array_contains(classes, F.lit(c)), F.lit(False))).alias(n) for c, n in (("tm", "has_tm"), ("ln", "has_lanthanide"), ("an", "has_actinide"))],
        F.abs("charge").alias("net_charge_abs"),
        F.when(~F.coalesce(known, F.lit(False)), "missing_structure").when(F.col("charge").isNull() | F.col("spin").isNull(), "missing_charge_or_spin").otherwise("ok").alias("read_status"),
    )


def zero_filled(rows: DataFrame, items: DataFrame, on: list[str], features: list[str]) -> DataFrame:
    """Every item with every feature, 0.0 where the rows have none."""
    return items.join(rows.select(*on, *features), on, "left").fillna(0.0, features)
