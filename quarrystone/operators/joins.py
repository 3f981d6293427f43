"""Joins of record tables by key, with what they drop, and joins by distance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.functions.vectors import distance


def inner_by_key(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """All tables joined on ``key``; other columns become ``<table>_<column>``."""
    renamed = [t.select(key, *[F.col(c).alias(f"{n}_{c}") for c in t.columns if c != key]) for n, t in tables.items()]
    return reduce(lambda a, b: a.join(b, key), renamed)


def dropped_keys(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, missing): keys of the first table that some other table lacks, with the tables that lack them."""
    first, *others = tables
    base = tables[first].select(key).distinct()
    for n in others:
        base = base.join(tables[n].select(key).distinct().withColumn(f"_{n}", F.lit(True)), key, "left")
    missing = F.filter(F.array(*[F.when(F.col(f"_{n}").isNull(), F.lit(n)) for n in others]), lambda x: x.isNotNull())
    return base.select(key, F.array_join(missing, ",").alias("missing")).where(F.col("missing") != "")


def key_audit(reference: DataFrame, others: dict[str, DataFrame], key: str) -> DataFrame:
    """Per table: its distinct keys, those of the reference, how many it lacks and how many it has beyond."""
    ref = reference.select(key).distinct()
    parts = []
    for n, t in others.items():
        sides = ref.withColumn("_r", F.lit(True)).join(t.select(key).distinct().withColumn("_o", F.lit(True)), key, "full_outer")
        parts.append(
            sides.agg(
                F.count("_r").alias("n_reference"), F.count("_o").alias("n_own"), F.count_if(F.col("_r").isNotNull() & F.col("_o").isNull()).alias("n_missing"),
                F.count_if(F.col("_r").isNull() & F.col("_o").isNotNull()).alias("n_extra"),
            ).withColumn("table", F.lit(n))
        )
    return reduce(DataFrame.unionByName, parts)


def cross_drop_keys(reference: DataFrame, others: dict[str, DataFrame], key: str) -> DataFrame:
    """Keys of the reference that at least one other table lacks."""
    ref = reference.select(key).distinct()
    return reduce(DataFrame.unionByName, [ref.join(t.select(key), key, "left_anti") for t in others.values()]).distinct()


def left_by_key(main: DataFrame, optional: dict[str, DataFrame], key: str, missing: str = "keep", fill: dict | None = None) -> DataFrame:
    """``main`` with the optional tables' columns by key.

    ``missing``: ``skip`` drops records an optional table lacks, ``keep``
    leaves nulls, ``fill`` puts the values of ``fill``. ``missing_tables``
    names what was lacking. Optional tables have one row per key.
    """
    if missing not in ("skip", "keep", "fill"):
        raise ValueError(f"unknown strategy {missing!r}")
    out = main
    for n, t in optional.items():
        out = out.join(t.select(key, *[F.col(c).alias(f"{n}_{c}") for c in t.columns if c != key], F.lit(True).alias(f"_has_{n}")), key, "left")
    lacking = F.filter(F.array(*[F.when(F.col(f"_has_{n}").isNull(), F.lit(n)) for n in optional]), lambda x: x.isNotNull())
    out = out.withColumn("missing_tables", F.array_join(lacking, ",")).drop(*[f"_has_{n}" for n in optional])
    if missing == "skip":
        return out.where(F.col("missing_tables") == "")
    return out.fillna(fill or {}) if missing == "fill" else out


def pull_keys(wanted: DataFrame, stores: dict[str, DataFrame], key: str, by: str) -> DataFrame:
    """(by, store, n_requested, n_found, n_absent): how many wanted keys each store has."""
    asked = wanted.select(by, key).distinct()
    parts = [
        asked.join(s.select(key).distinct().withColumn("_f", F.lit(True)), key, "left").groupBy(by).agg(F.count(F.lit(1)).alias("n_requested"), F.count("_f").alias("n_found")).withColumn("store", F.lit(n))
        for n, s in stores.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("n_absent", F.col("n_requested") - F.col("n_found"))


def exclude_keys(records: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """Records whose key is not excluded; null keys are never excluded."""
    return records.join(excluded.select(*keys).distinct(), keys, "left_anti")


def exclusion_misses(records: DataFrame, excluded: DataFrame, keys: list[str], by: str) -> DataFrame:
    """(by, n_requested, n_hit, n_missed) of the keys to exclude: how many the records have."""
    asked = excluded.select(by, *keys).distinct()
    hit = asked.join(records.select(*keys).distinct().withColumn("_hit", F.lit(True)), keys, "left")
    out = hit.groupBy(by).agg(F.count(F.lit(1)).alias("n_requested"), F.count("_hit").alias("n_hit"))
    return out.withColumn("n_missed", F.col("n_requested") - F.col("n_hit"))


def atom_pairs(atoms: DataFrame, record: list[str], index: str = "i", limit: Column | None = None) -> DataFrame:
    """Pairs i < j of atoms of a record with their distance, as columns a_*, b_*, dist.

    A join on the record, of which a record's atoms are few, with the index
    and ``limit`` (on a_*, b_*, dist) as residual conditions.
    """
    rest = [c for c in atoms.columns if c not in record]
    a = atoms.select(*record, *[F.col(c).alias(f"a_{c}") for c in rest])
    b = atoms.select(*record, *[F.col(c).alias(f"b_{c}") for c in rest])
    pairs = a.join(b, record).where(F.col(f"a_{index}") < F.col(f"b_{index}"))
    pairs = pairs.withColumn("dist", distance(*[F.col(f"{s}_{c}") for s in "ab" for c in "xyz"]))
    return pairs if limit is None else pairs.where(limit)


def bonded_pairs(atoms: DataFrame, record: list[str], radii: DataFrame, factor: float = 1.3) -> DataFrame:
    """Pairs closer than ``factor`` times the sum of their radii and not at one place; elements without radius take no part."""
    sized = atoms.join(F.broadcast(radii.select(F.col("symbol").alias("el"), "radius")), "el")
    return atom_pairs(sized, record, limit=(F.col("dist") > 0) & (F.col("dist") <= factor * (F.col("a_radius") + F.col("b_radius"))))


def nearest(points: DataFrame, atoms: DataFrame, record: list[str], point: str, k: int, margin: float | None = None) -> DataFrame:
    """The ``k`` atoms nearest to each point of the same record: (record, point, atom, dist, rank); ties by atom index."""
    a = atoms.select(*record, F.col("i").alias("atom"), F.col("x").alias("_ax"), F.col("y").alias("_ay"), F.col("z").alias("_az"))
    near = points.join(a, record).withColumn("dist", distance(F.col("x"), F.col("y"), F.col("z"), F.col("_ax"), F.col("_ay"), F.col("_az")))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy(*record, point).orderBy("dist", "atom"))).where(F.col("rank") <= k)
    return (ranked if margin is None else ranked.where(F.col("dist") <= margin)).select(*record, point, "atom", "dist", "rank")


def in_blocks(queries: DataFrame, rows: DataFrame, key: str, condition: Column, block_rows: int = 10_000) -> DataFrame:
    """All pairs of ``queries`` and ``rows`` that meet the condition.

    The queries are broadcast in blocks of about ``block_rows``, split by the
    hash of their ``key``, so no key brings rows together and no task holds
    more than a block.
    """
    n = max(1, -(-queries.count() // block_rows))
    block = F.pmod(F.xxhash64(key), F.lit(n))
    return reduce(DataFrame.unionByName, [rows.join(F.broadcast(queries.where(block == i)), condition) for i in range(n)])


def latest_wins(existing: DataFrame, incoming: DataFrame, key: list[str], version: str) -> DataFrame:
    """Upsert: both tables' rows, per key the one with the highest version; at a tie the incoming one."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    w = Window.partitionBy(*key).orderBy(F.col(version).desc_nulls_last(), F.desc("_new"), F.xxhash64(*existing.columns))
    return both.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n", "_new")
