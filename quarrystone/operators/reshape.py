"""Nested maps and JSON text as rows, and rows as wide tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarrystone.functions.keys import atom_element, atom_index, pair_label, pair_parts, without_suffix
from quarrystone.functions.numbers import finite_or_zero
from quarrystone.session import materialize

MAP = "map<string,string>"
NESTED = "map<string,map<string,string>>"


def last_members(members: Column) -> Column:
    """The entries of a parsed JSON object without those a later entry of their key replaces."""
    entries = F.map_entries(members)
    return F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + F.lit(2), F.size(entries)), lambda later: later["key"] == e["key"]))


def json_members(df: DataFrame, content: str, keep: list[str]) -> DataFrame:
    """(keep, name, value): the members of JSON objects, values as JSON text; other content has none.

    Of a name given more than once in an object the last member holds.
    """
    return df.select(*keep, F.inline(last_members(F.from_json(content, MAP)))).withColumnsRenamed({"key": "name"})


def flat_leaves(df: DataFrame, content: str, keep: list[str]) -> DataFrame:
    """(keep, path, value): numeric leaves of nested JSON objects of any depth under dotted paths.

    Booleans, text and lists are no leaves. The objects of each level are
    materialized, until a level has none.
    """
    level = json_members(df, content, keep).select(*keep, F.col("name").alias("path"), "value")
    out = None
    while True:
        leaf = level.where(F.col("value").rlike(r"^-?[0-9]")).select(*keep, "path", F.col("value").try_cast("double").alias("value")).where(F.col("value").isNotNull())
        out = leaf if out is None else out.unionByName(leaf)
        objects = materialize(level.where(F.col("value").startswith("{")).withColumnRenamed("path", "_p"), "leaf-objects")
        if objects.isEmpty():
            return out
        level = json_members(objects, "value", [*keep, "_p"]).select(*keep, F.concat_ws(".", "_p", "name").alias("path"), "value")


def scheme_pairs_long(df: DataFrame, content: str, keep: list[str]) -> DataFrame:
    """(keep, scheme, i, j, element_pair, value): pair values of every scheme of bond JSON, 0-based i <= j, ``_bond`` dropped from names.

    Malformed pair keys and values that are no numbers are left out.
    """
    members = json_members(df, content, keep).where(F.col("value").startswith("{"))
    cells = members.select(*keep, without_suffix(F.col("name")).alias("scheme"), F.explode(F.from_json("value", MAP)).alias("pair", "v"))
    parts = cells.select(*keep, "scheme", pair_parts(F.col("pair")).alias("p"), F.col("v").try_cast("double").alias("value"))
    return parts.where(F.col("p").isNotNull() & F.col("value").isNotNull()).select(*keep, "scheme", "p.i", "p.j", pair_label(F.col("p.element_i"), F.col("p.element_j")).alias("element_pair"), "value")


def wide(long: DataFrame, keys: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """One column per listed name, the greatest value where a key has several."""
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])


def bond_orders(long: DataFrame, keys: list[str], cutoff: float | None = None) -> DataFrame:
    """Pair values at or above ``cutoff``; without one those that are not zero."""
    v = F.col("value")
    return long.where(v >= cutoff) if cutoff is not None else long.where(F.abs(v) > 1e-8)


def atom_values(df: DataFrame, schemes: Column, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Per-atom values of ``schemes`` (map of scheme to map of atom key to value).

    Returns (keep, scheme, i, el, value) and the keys of records dropped
    because two schemes name different elements at one index.
    """
    cells = df.select(*keep, F.explode(schemes).alias("scheme", "m")).select(*keep, "scheme", F.explode("m").alias("k", "value"))
    rows = cells.select(*keep, "scheme", atom_index(F.col("k")).alias("i"), atom_element(F.col("k")).alias("el"), "value").where((F.col("i") >= 0) & F.col("el").isNotNull())
    conflicts = rows.groupBy(*keep, "i").agg(F.count_distinct("el").alias("n")).where("n > 1").select(*keep).distinct()
    return rows.join(conflicts, keep, "left_anti"), conflicts


def split_sums(values: Column, sums: tuple[str, ...] = ("sum", "abs_sum")) -> tuple[Column, Column]:
    """(per-atom entries, sums) of a map that has both."""
    return F.map_filter(values, lambda k, _: ~k.isin(*sums)), F.map_filter(values, lambda k, _: k.isin(*sums))


def prefixed_globals(values: Column, prefix: str) -> Column:
    """A map of names to numbers with the prefix before each name, NaN and infinities as 0."""
    return F.transform_values(F.transform_keys(values, lambda k, _: F.concat(F.lit(prefix), k)), lambda _, v: finite_or_zero(v))


def merged_maps(*maps: Column) -> Column:
    """One map of all; of equal keys the last map's value holds. Null maps are empty."""
    out = None
    for m in maps:
        m = F.coalesce(m, F.create_map().cast("map<string,string>"))
        out = m if out is None else F.map_concat(F.map_filter(out, lambda k, _, m=m: ~F.map_contains_key(m, k)), m)
    return out


def needs_backfill(source: Column, target: Column, names: dict[str, str]) -> Column:
    """Whether the source has a name whose counterpart the target lacks."""
    out = F.lit(False)
    for s, t in names.items():
        out = out | (F.coalesce(F.map_contains_key(source, F.lit(s)), F.lit(False)) & ~F.coalesce(F.map_contains_key(target, F.lit(t)), F.lit(False)))
    return out


def first_of(values: Column, names: list[str]) -> Column:
    """The first present of several names, each tried with and without ``_bond``."""
    return F.coalesce(*[F.try_element_at(values, F.lit(n)) for name in names for n in (name, f"{name}_bond")])


def _first_object(text: str | None) -> str | None:
    depth = start = 0
    quoted = escaped = False
    for i, c in enumerate(text or ""):
        if quoted:
            quoted, escaped = escaped or c != '"', c == "\\" and not escaped
        elif c == '"' and depth:
            quoted = True
        elif c == "{":
            start, depth = (i if depth == 0 else start), depth + 1
        elif c == "}" and depth:
            depth -= 1
            if depth == 0:
                return text[start : i + 1]
    return None


@F.pandas_udf(StringType())
def first_json_object(texts: pd.Series) -> pd.Series:
    """The first balanced object of a text, braces inside quotes apart; null if none closes."""
    return texts.map(_first_object)


def repaired_json(content: Column, sibling: Column) -> Column:
    """The content if it is JSON, else a sibling copy that is, else the content's first object, else null."""
    def good(c: Column) -> Column:
        return F.when(F.get_json_object(c, "$").isNotNull(), c)

    return F.coalesce(good(content), good(sibling), good(first_json_object(content)))


def match_points(key: list[str], margin: float):
    """A function for applyInPandas: points of a record put to its atoms one to one.

    A point takes the atom of its own number if element and distance within
    ``margin`` agree, else the nearest free atom of its element within
    ``margin``; taken atoms are gone. Points in order of number. Input rows
    have kind ('point' or 'atom'), n, el, x, y, z.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        atoms = frame[frame["kind"] == "atom"].sort_values("n")
        free = {r.n: (r.el, r.x, r.y, r.z) for r in atoms.itertuples()}
        out = []
        for p in frame[frame["kind"] == "point"].sort_values("n").itertuples():
            near = sorted((((p.x - x) ** 2 + (p.y - y) ** 2 + (p.z - z) ** 2) ** 0.5, n) for n, (el, x, y, z) in free.items() if el == p.el)
            near = [d for d in near if d[0] <= margin]
            own = [d for d in near if d[1] == p.n]
            best = (own or near or [None])[0]
            if best is not None:
                del free[best[1]]
            out.append((*[getattr(p, k) for k in key], p.n, None if best is None else best[1], None if best is None else best[0]))
        return pd.DataFrame(out, columns=[*key, "point", "atom", "dist"])

    return run

