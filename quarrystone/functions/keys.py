"""Keys of records, atoms, pairs and critical points.

Atom keys ``3_C`` and pair keys ``1_C_to_2_H`` count from 1, critical-point
keys ``2`` and ``0_4`` from 0; parsed indices count from 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names kept beside data in a store that are no records.
RESERVED = ("length", "scaled", "split_name", "scaler_finalized", "feature_names", "feature_size", "element_set", "ring_list", "allowed_charges", "allowed_spins")


def is_record_key(key: Column) -> Column:
    """ASCII and none of the reserved names; null is no key."""
    return F.coalesce(key.rlike(r"\A[\x00-\x7F]+\z") & ~key.isin(*RESERVED), F.lit(False))


def atom_index(key: Column) -> Column:
    """0-based index of an atom key, null if it is malformed."""
    i = F.regexp_extract(key, r"^([0-9]{1,9})_[^_].*$", 1)
    return F.when(i != "", i.try_cast("int") - 1)


def atom_element(key: Column) -> Column:
    return F.nullif(F.regexp_extract(key, r"^[0-9]{1,9}_([^_].*)$", 1), F.lit(""))


def pair_parts(key: Column) -> Column:
    """(i, j, element_i, element_j) of a pair key, 0-based with i <= j, elements swapped along; null if malformed."""
    sides = F.split(key, "_to_")
    a, b = F.try_element_at(sides, F.lit(1)), F.try_element_at(sides, F.lit(2))
    i, j, ei, ej = atom_index(a), atom_index(b), atom_element(a), atom_element(b)
    good = (F.size(sides) == 2) & i.isNotNull() & j.isNotNull() & (i >= 0) & (j >= 0)
    swap = i > j
    return F.when(
        good,
        F.struct(
            F.least(i, j).alias("i"), F.greatest(i, j).alias("j"), F.when(swap, ej).otherwise(ei).alias("element_i"), F.when(swap, ei).otherwise(ej).alias("element_j")
        ),
    )


def pair_label(a: Column, b: Column) -> Column:
    """Two names in order, joined by ``_``."""
    return F.concat_ws("_", F.least(a, b), F.greatest(a, b))


def point_parts(key: Column) -> Column:
    """(i, j) of a bond point key with i <= j; null for atom points and malformed keys."""
    i, j = (F.regexp_extract(key, r"^([0-9]{1,9})_([0-9]{1,9})$", k).try_cast("int") for k in (1, 2))
    return F.when(i.isNotNull() & j.isNotNull(), F.struct(F.least(i, j).alias("i"), F.greatest(i, j).alias("j")))


def build_atom_key(index: Column, element: Column) -> Column:
    return F.concat_ws("_", (index + 1).cast("string"), element)


def build_pair_key(i: Column, ei: Column, j: Column, ej: Column) -> Column:
    return F.concat(build_atom_key(i, ei), F.lit("_to_"), build_atom_key(j, ej))


def key_from_path(path: Column, root: str) -> Column:
    """The path below ``root`` with ``__`` for ``/``; a path outside keeps its whole length."""
    base = root.rstrip("/") + "/"
    below = F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30)).otherwise(F.regexp_replace(path, "^/", ""))
    return F.replace(F.rtrim(below, F.lit("/")), F.lit("/"), F.lit("__"))


def normal_key(key: Column, vertical: Column) -> Column:
    """Without a leading ``vertical/``, and ``__`` for the other slashes."""
    prefix = F.concat(vertical, F.lit("/"))
    return F.replace(F.when(F.startswith(key, prefix), F.substring(key, F.length(prefix) + 1, F.length(key))).otherwise(key), F.lit("/"), F.lit("__"))


def without_suffix(name: Column, suffix: str = "_bond") -> Column:
    return F.when(name.endswith(suffix), F.substring(name, F.lit(1), F.length(name) - len(suffix))).otherwise(name)


def unquoted(text: Column) -> Column:
    """What stands between the first pair of quotes, the text itself if there is none."""
    inner = F.regexp_extract(text, r"""(["'])(.*?)\1""", 2)
    return F.when(text.rlike(r"""(["']).*?\1"""), inner).otherwise(text)


def pair_as_written(key: Column) -> Column:
    """(i, j, element_i, element_j) of a pair key, 0-based, sides as they are written; null if malformed."""
    sides = F.split(key, "_to_")
    a, b = F.try_element_at(sides, F.lit(1)), F.try_element_at(sides, F.lit(2))
    i, j, ei, ej = atom_index(a), atom_index(b), atom_element(a), atom_element(b)
    return F.when((F.size(sides) == 2) & (i >= 0) & (j >= 0), F.struct(i.alias("i"), j.alias("j"), ei.alias("element_i"), ej.alias("element_j")))


def counted_pair(key: Column) -> Column:
    """The two indices of a pair key in order, still counted from 1; null if malformed."""
    p = pair_parts(key)
    return F.when(p.isNotNull(), F.array(p["i"] + 1, p["j"] + 1))


def without_units(text: Column) -> Column:
    """A line without a leading ``(a.u.)``."""
    return F.regexp_replace(text, r"^\s*\(a\.u\.\)\s*", "")


def first_element_set(schemes: Column, names: list[str]) -> Column:
    """Elements of the atom keys of the first named scheme that has any, in order, joined; null if none has.

    ``schemes`` is a map of scheme to map of atom key to value.
    """
    def elements(name: str) -> Column:
        keys = F.map_keys(F.try_element_at(schemes, F.lit(name)))
        found = F.array_sort(F.array_distinct(F.filter(F.transform(keys, atom_element), lambda e: e.isNotNull())))
        return F.when(F.size(found) > 0, F.array_join(found, ","))

    return F.coalesce(*[elements(n) for n in names])
