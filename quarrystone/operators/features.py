"""Feature rows of atoms, bonds and whole records, and what they are joined and cut by."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.functions.numbers import finite_or_zero
from quarrystone.functions.vectors import all_finite, norm
from quarrystone.operators.records import atomic_number, element_class


# --- maps of one record ---------------------------------------------------------------
def only_names(values: Column, names: list[str] | None, suffix: str = "") -> Column:
    """The entries of a map with one of the names, each with or without ``suffix``; all of them where names is None."""
    if names is None:
        return values
    wanted = [n + s for n in names for s in dict.fromkeys(("", suffix))]
    return F.map_filter(values, lambda k, _: k.isin(*wanted))


def indexed_features(df: DataFrame, values: Column, stem: str, keep: list[str], n_items: str) -> DataFrame:
    """(keep, i, value) of the map entries ``<stem>_<i>`` whose index is one of the record's items; text that is no number is left out, NaN is 0."""
    rows = df.select(*keep, n_items, F.explode(values).alias("_k", "_v"))
    rows = rows.select(*keep, n_items, F.regexp_extract("_k", rf"^{stem}_([0-9]{{1,9}})$", 1).try_cast("int").alias("i"), finite_or_zero(F.col("_v")).alias("value"))
    return rows.where((F.col("i") < F.col(n_items)) & F.col("value").isNotNull()).select(*keep, "i", "value")


def vector_features(values: Column, name: str, axes: tuple[str, ...] = ("x", "y", "z")) -> list[Column]:
    """A column per axis and the length of an array, all of them or, where it is not finite or of another size, none."""
    whole = (F.size(values) == len(axes)) & all_finite(values)
    parts = [F.when(whole, F.get(values, F.lit(i)).cast("double")).alias(f"{name}_{a}") for i, a in enumerate(axes)]
    return [F.when(whole, norm(values)).alias(f"{name}_mag"), *parts]


def enriched(target: Column, source: Column, names: dict[str, str]) -> Column:
    """``target`` with the source's entries under their new names; what the target has stays, so doing it twice changes nothing."""
    entries = F.filter(
        F.array(*[F.struct(F.lit(new).alias("key"), F.try_element_at(source, F.lit(old)).alias("value")) for old, new in names.items()]),
        lambda e: e["value"].isNotNull() & ~F.coalesce(F.map_contains_key(target, e["key"]), F.lit(False)),
    )
    return F.map_concat(F.coalesce(target, F.create_map().cast("map<string,string>")), F.map_from_entries(entries))


# --- rows of atoms and pairs ------------------------------------------------------------
def atoms_wide(long: DataFrame, record: list[str], schemes: list[str]) -> DataFrame:
    """(record, i, el, one column per scheme, n_atoms) from (record, scheme, i, el, value).

    A record in which an index has two elements is left out whole; n_atoms is
    its highest index and one.
    """
    rows = long.groupBy(*record, "i").agg(
        F.min("el").alias("el"), F.count_distinct("el").alias("_elements"), *[F.max(F.when(F.col("scheme") == s, F.col("value"))).alias(s) for s in schemes]
    )
    whole = long.groupBy(*record).agg((F.max("i") + 1).alias("n_atoms"))
    conflicts = rows.where(F.col("_elements") > 1).select(*record).distinct()
    return rows.drop("_elements").join(conflicts, record, "left_anti").join(whole, record)


def only_listed(pairs: DataFrame, listed: DataFrame, record: list[str]) -> DataFrame:
    """The pairs that are listed for their record, in whatever order the list has i and j."""
    ordered = listed.select(*record, F.least("i", "j").alias("_i"), F.greatest("i", "j").alias("_j")).distinct()
    keyed = pairs.withColumn("_i", F.least("i", "j")).withColumn("_j", F.greatest("i", "j"))
    return keyed.join(ordered, [*record, "_i", "_j"], "left_semi").drop("_i", "_j")


def neighbors_within(pairs: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Pairs not farther apart than the cut-off of their two elements, named in either order; both directions, pairs of unlisted elements none.

    ``pairs`` has a_el, b_el, a_i, b_i and dist, ``cutoffs`` el_a, el_b and cutoff.
    """
    table = cutoffs.groupBy(F.least("el_a", "el_b").alias("_a"), F.greatest("el_a", "el_b").alias("_b")).agg(F.max("cutoff").alias("cutoff"))
    near = pairs.withColumn("_a", F.least("a_el", "b_el")).withColumn("_b", F.greatest("a_el", "b_el")).join(table, ["_a", "_b"]).where(F.col("dist") <= F.col("cutoff"))
    rest = [c for c in pairs.columns if not c.startswith(("a_", "b_"))]
    both = F.array(*[F.struct(F.col(f"{s}_i").alias("center"), F.col(f"{s}_el").alias("center_el"), F.col(f"{o}_i").alias("partner"), F.col(f"{o}_el").alias("partner_el")) for s, o in ("ab", "ba")])
    return near.select(*rest, F.inline(both))


def metal_neighbors(pairs: DataFrame, keep: list[str], least: float = 0.3) -> DataFrame:
    """(keep, metal, metal_el, partner, partner_el, value): pairs with a finite value of at least ``least``, seen from their transition metal.

    A pair of two metals has two rows. ``pairs`` has i, j, el_i, el_j and value.
    """
    strong = pairs.where(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf")) & (F.col("value") >= least))
    both = F.array(*[F.struct(F.col(s).alias("metal"), F.col(f"el_{s}").alias("metal_el"), F.col(o).alias("partner"), F.col(f"el_{o}").alias("partner_el")) for s, o in ("ij", "ji")])
    sides = strong.select(*keep, "value", F.inline(both))
    return sides.where(F.coalesce(element_class(atomic_number(F.col("metal_el"))) == "tm", F.lit(False))).select(*keep, "metal", "metal_el", "partner", "partner_el", "value")


# --- records ------------------------------------------------------------------------------
def ordered_arrays(rows: DataFrame, record: list[str], index: str, columns: list[str]) -> DataFrame:
    """One row per record with an array per column, in order of the index (a record's own rows only)."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(index).alias("_at"), *columns)))
    return rows.groupBy(*record).agg(packed.alias("_rows")).select(*record, *[F.col("_rows")[c].alias(c) for c in columns])


def both_or_failure(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """(key, status): ``ok`` where both tables have the key, else ``missing_<name>`` of the one that lacks it."""
    sides = left.select(key).distinct().withColumn("_l", F.lit(True)).join(right.select(key).distinct().withColumn("_r", F.lit(True)), key, "full_outer")
    return sides.select(key, F.when(F.col("_l").isNull(), f"missing_{names[0]}").when(F.col("_r").isNull(), f"missing_{names[1]}").otherwise("ok").alias("status"))


def select_targets(df: DataFrame, keys: list[str], features: list[str], targets: list[str]) -> tuple[DataFrame, DataFrame]:
    """(keys and features without the targets, keys and targets); raises for a target that is no column."""
    unknown = [t for t in targets if t not in df.columns]
    if unknown:
        raise ValueError(f"unknown target {', '.join(unknown)}")
    return df.select(*keys, *[f for f in features if f not in targets]), df.select(*keys, *targets)


def same_schema_union(tables: list[DataFrame]) -> DataFrame:
    """All rows of tables of one schema; raises at the first table of another."""
    for i, t in enumerate(tables[1:], 1):
        if [(f.name, f.dataType) for f in t.schema] != [(f.name, f.dataType) for f in tables[0].schema]:
            raise ValueError(f"table {i} has another schema: {t.schema.simpleString()} instead of {tables[0].schema.simpleString()}")
    return reduce(DataFrame.unionAll, tables)


def union_keep_first(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of all tables that have any, one per key: of the earliest table, ties by the row's hash."""
    tagged = [t.withColumn("_t", F.lit(i)) for i, t in enumerate(tables)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rest = [c for c in every.columns if c not in keys]
    first = every.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("_t", F.xxhash64(*rest))).alias("_row"))
    return first.select(*keys, *[F.col("_row")[c].alias(c) for c in rest if c != "_t"])
