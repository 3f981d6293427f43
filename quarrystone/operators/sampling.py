"""Splits, holdouts and samples that come out the same every time.

Random order is the order of a hash of key and seed, so that every operator
is deterministic whatever the partitioning. Ordinals over a whole table are
numbered per range partition and shifted by the counts before, not in one
window task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.operators.quantiles import with_running_sum
from quarrystone.session import materialize

BUCKETS = 10_000
#: The splits a composition hash tells apart, in the order of their ratios.
SPLITS = ("train", "val", "test")


def hash_order(key: Column, seed: int | str) -> Column:
    """A text by which keys are in a random order that depends on the seed only."""
    return F.sha2(F.concat_ws("_", key.cast("string"), F.lit(str(seed))), 256)


def hash_bucket(key: Column, seed: int | str) -> Column:
    """sha256(key_seed) modulo BUCKETS: four 64-bit limbs, each reduced by its weight."""
    digest = hash_order(key, seed)
    limbs = [F.conv(F.substring(digest, 1 + 16 * k, 16), 16, 10).cast("decimal(20,0)") for k in range(4)]
    weights = [pow(2, 64 * (3 - k), BUCKETS) for k in range(4)]
    total = reduce(lambda a, b: a + b, [(limb % BUCKETS).cast("bigint") * w for limb, w in zip(limbs, weights)])
    return F.pmod(total, F.lit(BUCKETS)).cast("int")


def hash_split(key: Column, ratios: tuple[float, ...], seed: int | str, names: tuple[str, ...] = SPLITS) -> Column:
    """The split of a key by its bucket; the last split takes what is left over, a null key goes to the first."""
    place = hash_bucket(key, seed) / float(BUCKETS)
    out, edge = F.lit(names[-1]), sum(ratios)
    for name, ratio in reversed(list(zip(names[:-1], ratios[:-1]))):
        edge = sum(ratios[: names.index(name) + 1])
        out = F.when(place < edge, F.lit(name)).otherwise(out)
    return F.when(key.isNull(), F.lit(names[0])).otherwise(out)


def with_ordinal(df: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """0-based place of each row in the whole table's order (which must be total)."""
    keyed = df.select("*", *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    keys = [f"_o{i}" for i in range(len(order))]
    placed = materialize(keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_m", F.monotonically_increasing_id()), "ordinal")
    part, place = F.shiftright("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    starts = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_s"))
    return placed.withColumn("_p", part).join(F.broadcast(starts), "_p").withColumn(name, F.col("_s") + place).drop("_p", "_m", "_s", *keys)


def systematic_sample(df: DataFrame, order: list[Column], sample: int) -> DataFrame:
    """Every n-th row in order, n = max(1, rows // sample)."""
    placed = with_ordinal(df, order, "_i")
    step = max(1, placed.count() // sample)
    return placed.where(F.pmod("_i", F.lit(step)) == 0).drop("_i")


def exact_count_split(df: DataFrame, key: str, ratios: tuple[float, ...], seed: int, names: tuple[str, ...] = SPLITS) -> DataFrame:
    """Splits of exactly int(n * ratio) rows in seeded order, the rest to the last."""
    placed = with_ordinal(df, [hash_order(F.col(key), seed), F.col(key)], "_i")
    n = placed.count()
    split, start = F.lit(names[-1]), 0
    cuts = []
    for name, ratio in zip(names[:-1], ratios[:-1]):
        start += int(n * ratio)
        cuts.append((name, start))
    for name, end in reversed(cuts):
        split = F.when(F.col("_i") < end, F.lit(name)).otherwise(split)
    return placed.withColumn("split", split).drop("_i")


def fixed_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows in seeded order (all if there are fewer)."""
    return df.orderBy(hash_order(F.col(key), seed), key).limit(n)


def shard_of(df: DataFrame, order: list[Column], shards: int, name: str = "shard") -> DataFrame:
    """Rows dealt to shards in turn, in the given total order."""
    return with_ordinal(df, order, "_i").withColumn(name, F.pmod("_i", F.lit(shards)).cast("int")).drop("_i")


def valid_choice(df: DataFrame, key: str, valid: DataFrame, n: int, seed: int, times: int = 10) -> DataFrame:
    """``n`` valid keys, in seeded order, out of the first ``times * n``; fewer where those have fewer."""
    drawn = fixed_sample(df.select(key).distinct(), key, times * n, seed)
    return fixed_sample(drawn.join(valid.select(key).distinct(), key, "left_semi"), key, n, seed)


def quota_sample(df: DataFrame, by: list[str], key: str, quota: Column | int, seed: int) -> DataFrame:
    """At most ``quota`` (a number, or an expression over columns of ``df``) rows of each group, in seeded order.

    A number is pushed below the shuffle as a limit per group; for an
    expression the rows are numbered in ranges, so no task sorts a group.
    """
    if isinstance(quota, int):
        w = Window.partitionBy(*by).orderBy(hash_order(F.col(key), seed), key)
        return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= quota).drop("_n")
    return with_running_sum(df, by, [hash_order(F.col(key), seed), F.col(key)], F.lit(1), "_before").where(F.col("_before") < quota).drop("_before")


def class_quota_sample(df: DataFrame, cls: str, part: str, key: str, per_class: int, seed: int) -> DataFrame:
    """ceil(per_class / parts of the class) rows of every part of a class."""
    parts = df.groupBy(cls).agg(F.countDistinct(part).alias("_parts"))
    return quota_sample(df.join(parts, cls), [cls, part], key, F.ceil(F.lit(per_class) / F.col("_parts")), seed).drop("_parts")


def complement_sample(df: DataFrame, taken: DataFrame, by: str, key: str, fraction: float, seed: int) -> DataFrame:
    """Of the rows not taken, max(1, round(fraction * n)) of each group."""
    rest = df.join(taken.select(key), key, "left_anti")
    sizes = rest.groupBy(by).agg(F.greatest(F.lit(1), F.floor(fraction * F.count(F.lit(1)) + 0.5)).alias("_quota"))
    return quota_sample(rest.join(sizes, by), [by], key, F.col("_quota"), seed).drop("_quota")


def band(size: Column, edges: list[float]) -> Column:
    """Number of the half-open band [edge, next edge) a size is in; null outside all."""
    out = F.lit(None).cast("int")
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        out = F.when((size >= low) & (size < high), F.lit(i)).otherwise(out)
    return out


def band_sample(pairs: DataFrame, pair: str, record: list[str], edges: list[float], shape: list[int], seed: int) -> DataFrame:
    """(pair, size, band): of each band of pair sizes (distinct records), min(shape, available) pairs in seeded order."""
    sizes = pairs.groupBy(pair).agg(F.countDistinct(F.struct(*record)).alias("size")).withColumn("band", band(F.col("size"), edges)).where(F.col("band").isNotNull())
    quota = F.element_at(F.array(*map(F.lit, shape)), F.col("band") + 1)
    return quota_sample(sizes, ["band"], pair, quota, seed)


def matched_records(pairs: DataFrame, chosen: DataFrame, pair: str, record: list[str]) -> DataFrame:
    """(record, matched_pairs, n_matched): records with a chosen pair, the sorted distinct pairs as text."""
    found = F.array_sort(F.collect_set(pair))
    return pairs.join(F.broadcast(chosen.select(pair)), pair, "left_semi").groupBy(*record).agg(F.concat_ws(",", found).alias("matched_pairs"), F.size(found).alias("n_matched"))


def greedy_prefix(df: DataFrame, by: str, item: str, target: Column, seed: int | str) -> DataFrame:
    """(by, item, n): items in seeded order until their rows reach ``target``, the crossing item included."""
    counts = df.groupBy(by, item).agg(F.count(F.lit(1)).alias("n"))
    return with_running_sum(counts, [by], [hash_order(F.col(item), seed), F.col(item)], F.col("n"), "_before").where(F.col("_before") < target).drop("_before")


def split_deviation(assigned: DataFrame, by: list[str], ratios: dict[str, float], warn: float = 0.05) -> DataFrame:
    """Requested and actual share of every split, and whether they are more than ``warn`` apart."""
    n = assigned.groupBy(*by, "split").agg(F.count(F.lit(1)).alias("n"))
    total = n.withColumn("total", F.sum("n").over(Window.partitionBy(*by))) if by else n.withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(1))))
    wanted = F.element_at(F.create_map(*[x for k, v in ratios.items() for x in (F.lit(k), F.lit(v))]), F.col("split"))
    return total.withColumn("actual", F.col("n") / F.col("total")).withColumn("requested", wanted).withColumn("off", F.abs(F.col("actual") - F.col("requested")) > warn)
