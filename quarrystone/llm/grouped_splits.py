"""Splits that keep related records together.

Records are related by keys they share (composition, origin), directly or by
chains. The chains are found over the keys: a record with two keys is an edge
between them, equal edges are one, so a key that a third of all records share
is one node. The components, with their label counts, are then placed whole
by grouped iterative stratification.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quarrystone.operators.components import connected_components
from quarrystone.operators.profiling import latest_records
from quarrystone.operators.skew import skew_lookup
from quarrystone.session import materialize

SPLITS = ("train", "val", "test")
#: Components placed together in one task; there are as many blocks as needed.
BLOCK_COMPONENTS = 4_000
#: A component with more than 1/LARGE_SHARE of all records is placed first, over all blocks; fewer than LARGE_SHARE exist.
LARGE_SHARE = 1_000


def composition_key(molecule: Column) -> Column:
    """The same text for molecules with the same count of each element.

    Case and outer U+0020 of symbols are ignored. Null for a null molecule and
    for one with an unknown (null) symbol; the empty molecule has ''.
    """
    symbols = F.transform(molecule, lambda a: F.lower(F.trim(a["elem"])))
    return F.when(~F.exists(symbols, lambda s: s.isNull()), F.array_join(F.array_sort(symbols), ","))


def related_groups(records: DataFrame, record_id: str, keys: dict[str, Column]) -> DataFrame:
    """(record_id, group_id, group_size): all records with their groups.

    ``keys`` are the columns by which records are related; a null key relates
    nothing. group_id is the smallest record_id of the group; a record without
    relatives is a group of one. Records are counted once by id.
    """
    names = list(keys)
    hashed = [F.when(k.isNotNull(), F.xxhash64(F.lit(n), k)) for n, k in keys.items()]
    rows = materialize(records.select(F.col(record_id).alias("record_id"), *[h.alias(n) for n, h in zip(names, hashed)]), "groups-rows")
    first = F.coalesce(*names)
    links = None
    for n in names:
        part = rows.where(F.col(n).isNotNull()).select(first.alias("a"), F.col(n).alias("b"))
        links = part if links is None else links.unionByName(part)
    roots = connected_components(links.distinct())
    heads = rows.groupBy(first.alias("node")).agg(F.min("record_id").alias("least"), F.count(F.lit(1)).alias("_rows")).where(F.col("node").isNotNull())
    placed = heads.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least", "_rows")
    placed = materialize(placed, "groups-placed")
    groups = placed.groupBy("root").agg(F.min("least").alias("group_id"), F.sum("_rows").alias("group_size"))
    by_key = placed.select("node", "root", "_rows").join(groups, "root").select("node", "group_id", "group_size", "_rows")
    keyed = rows.select("record_id", first.alias("node"))
    return (
        skew_lookup(keyed.where(F.col("node").isNotNull()), by_key, ["node"], "_rows").select("record_id", "group_id", "group_size")
        .unionByName(keyed.where(F.col("node").isNull()).select("record_id", F.col("record_id").alias("group_id"), F.lit(1).cast("bigint").alias("group_size")))
    )


def structure_groups(structures: DataFrame) -> DataFrame:
    """related_groups of structures by composition and origin_ref (case and outer U+0020 ignored)."""
    return related_groups(latest_records(structures), "struct_id", {"composition": composition_key(F.col("molecule")), "origin": F.lower(F.trim("origin_ref"))})


def setting_problem(method: Column, ratios: Column, seed: Column) -> Column:
    """What is wrong with a split setting, null if nothing is: the first of method, number, sign and sum of the ratios, and seed."""
    total = F.aggregate(ratios, F.lit(0.0), lambda s, r: s + r)
    return (
        F.when(~F.coalesce(method.isin("random", "composition"), F.lit(False)), "method")
        .when(~F.coalesce(F.size(ratios) == len(SPLITS), F.lit(False)), "number of ratios")
        .when(~F.forall(ratios, lambda r: F.coalesce((r > 0) & ~F.isnan(r), F.lit(False))), "ratio not above 0")
        .when(~(F.abs(total - 1) <= 1e-6), "ratios do not sum to 1")
        .when(seed.isNull(), "seed")
    )


def place(components: pd.DataFrame, want: np.ndarray, want_labels: np.ndarray, seed: int) -> np.ndarray:
    """The split of each component, by grouped iterative stratification.

    ``components`` has key, size and labels (an array of counts); ``want`` is
    the records each split still needs, ``want_labels`` (splits x labels) the
    same by label. Again and again the label with the fewest records left is
    taken, and the largest component with it goes to the split that needs most
    of this label, then most records. Both wants go down as components go in.
    """
    sizes = components["size"].to_numpy(np.float64)
    labels = np.stack(components["labels"].to_numpy()) if len(components) else np.zeros((0, want_labels.shape[1]))
    tie = pd.util.hash_array(components["key"].to_numpy(np.int64) * 1_000_003 + seed)
    order = np.lexsort((tie, -sizes))
    out = np.full(len(sizes), -1)
    left = labels.sum(axis=0)
    queues = [order[labels[order, k] > 0] for k in range(labels.shape[1])]
    heads = [0] * len(queues)
    want, want_labels = want.copy(), want_labels.copy()

    def put(i: int, k: int | None) -> None:
        need = want_labels[:, k] if k is not None else want
        best = np.flatnonzero(need >= need.max() - 1e-9)
        split = best[np.argmax(want[best])]
        # a component that outgrows what its split needs goes where the most room is
        if want[split] < sizes[i] / 2:
            split = int(np.argmax(want))
        out[i] = split
        want[split] -= sizes[i]
        want_labels[split] -= labels[i]
        np.subtract(left, labels[i], out=left)

    while (left > 0).any():
        k = int(np.argmin(np.where(left > 0, left, np.inf)))
        while out[queues[k][heads[k]]] >= 0:
            heads[k] += 1
        put(queues[k][heads[k]], k)
    for i in order[out[order] < 0]:
        put(i, None)
    return out


def stratified_assignment(groups: DataFrame, labels: DataFrame, settings: DataFrame, label_cols: list[str]) -> DataFrame:
    """(config_id, record_id, group_id, split_name) for each valid composition setting.

    ``settings`` has (config_id, method, ratios, seed), a row per setting; ``groups`` is what related_groups gives, ``labels`` (record_id, label_cols)
    what is to be spread evenly. Values of each label column count as labels
    of their own (a few dozen in all; null is one). Components larger than
    1/LARGE_SHARE of all records, fewer than LARGE_SHARE, are placed first on
    the driver; the rest, hashed into blocks, are placed block by block
    towards what is still wanted, each block by its share.
    """
    valid = setting_problem(F.col("method"), F.col("ratios"), F.col("seed")).isNull() & (F.col("method") == "composition")
    wanted = settings.where(valid).orderBy("config_id").collect()
    spark = groups.sparkSession
    schema = "config_id int, group_id bigint, split_name string"
    marked = groups.join(labels, "record_id").select(
        "group_id", F.explode(F.array(*[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for c in label_cols])).alias("label")
    )
    counts = materialize(marked.groupBy("group_id", "label").agg(F.count(F.lit(1)).alias("n")), "split-labels")
    totals = {r["label"]: r["n"] for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()}  # one row per label value
    names = sorted(totals)
    at = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))]) if names else F.create_map(F.lit(""), F.lit(0))
    by_label = F.map_from_entries(F.collect_list(F.struct(at[F.col("label")].alias("i"), F.col("n"))))
    vector = F.transform(F.sequence(F.lit(0), F.lit(max(0, len(names) - 1))), lambda i: F.coalesce(F.try_element_at(F.col("m"), i), F.lit(0).cast("bigint")))
    components = materialize(
        counts.groupBy("group_id").agg(by_label.alias("m"), (F.sum("n") / len(label_cols)).cast("bigint").alias("size")).select(F.col("group_id").alias("key"), "size", vector.alias("labels")), "split-components"
    )
    total, n_components = components.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not wanted or not total:
        return spark.createDataFrame([], "config_id int, record_id bigint, group_id bigint, split_name string")
    large = components.where(F.col("size") > max(1, total // LARGE_SHARE)).toPandas()  # under LARGE_SHARE rows
    small = components.where(F.col("size") <= max(1, total // LARGE_SHARE))
    all_labels = np.array([totals[n] for n in names], float)
    n_blocks = max(1, -(-n_components // BLOCK_COMPONENTS))
    done, tables = [], []
    for c in wanted:
        ratios = np.array(c.ratios)
        want, want_labels = ratios * total, ratios[:, None] * all_labels[None, :]
        first = place(large, want, want_labels, c.seed)
        for i, s in enumerate(first):
            want[s] -= large["size"][i]
            want_labels[s] -= np.asarray(large["labels"][i])
        done += [(c.config_id, int(large["key"][i]), SPLITS[s]) for i, s in enumerate(first)]
        tables.append(_place_blocks(small, c, want / max(1e-9, want.sum()), want_labels, n_blocks, schema))
    placed = spark.createDataFrame(done, schema)
    for t in tables:
        placed = placed.unionByName(t)
    placed = placed.withColumn("_key", F.col("group_id"))
    sizes = placed.join(components.select(F.col("key").alias("group_id"), (F.col("size")).alias("_rows")), "group_id").drop("_key")
    out = None
    for c in wanted:
        part = skew_lookup(groups.select("record_id", "group_id"), sizes.where(F.col("config_id") == c.config_id), ["group_id"], "_rows").select("config_id", "record_id", "group_id", "split_name")
        out = part if out is None else out.unionByName(part)
    return out


def _place_blocks(small: DataFrame, config: Row, shares: np.ndarray, want_labels: np.ndarray, n_blocks: int, schema: str) -> DataFrame:
    shares = np.maximum(shares, 0) / np.maximum(shares, 0).sum()
    by_label = np.maximum(want_labels, 0)
    by_label = by_label / np.maximum(by_label.sum(axis=0), 1e-9)
    seed, config_id = config.seed, config.config_id

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        here = np.stack(frame["labels"].to_numpy()).sum(axis=0)
        split = place(frame, shares * frame["size"].sum(), by_label * here[None, :], seed)
        return pd.DataFrame({"config_id": np.int32(config_id), "group_id": frame["key"], "split_name": [SPLITS[s] for s in split]})

    return small.groupBy(F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(n_blocks)).alias("_block")).applyInPandas(lambda key, frame: run(frame.reset_index(drop=True)), schema)
