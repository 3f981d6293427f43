"""Evaluation structures that training has too, the same or nearly.

A structure is read as a sequence of words: lengths of its shape that no
rotation, shift or renumbering of atoms changes, and that move by no more than
a known bound when every atom moves by at most the tolerance. Words are cut
into cells; five neighbouring words make a gram. Evaluation structures emit
each gram with every cell its words can fall in, training structures their own
cells only, so a near structure hits every gram of an evaluation structure:
its containment is 1 and no link can be lost. Hits of sufficient containment
whose words are within their bounds are then superposed atom by atom
(``superpose``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.llm.superpose import superposable
from quarrystone.operators.profiling import latest_records
from quarrystone.operators.skew import skew_lookup
from quarrystone.session import materialize

TOLERANCE = 0.05
GRAM_WORDS = 5
CONTAINMENT = 0.8
#: Words are cut into cells this wide, or of eight tolerances if that is more; a word can then fall in two cells at most.
CELL = 0.4
#: Beyond what the bounds prove, for rounding.
SLACK = 1e-6
#: A class with more records than this is spread over several join keys.
CLASS_ROWS = 50_000


def _radii(owner: np.ndarray, groups: int, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(principal radii, centre) of each group of points; ``owner`` is a point's group."""
    centre = np.stack([np.bincount(owner, points[:, k], groups) for k in range(3)], axis=1) / sizes[:, None]
    x = points - centre[owner]
    spread = np.empty((groups, 3, 3))
    for i in range(3):
        for k in range(i, 3):
            spread[:, i, k] = spread[:, k, i] = np.bincount(owner, x[:, i] * x[:, k], groups) / sizes
    return np.sqrt(np.maximum(np.linalg.eigvalsh(spread)[:, ::-1], 0.0)), centre


def shape_words(elements: np.ndarray, xyz: np.ndarray, lengths: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, how far each can move, words per structure) of structures whose atoms lie one after another.

    The three principal radii of all atoms; then, per element from the
    commonest on, those of its atoms and the distance of their centre from
    that of all atoms. Radii are singular values of centred coordinates over
    the root of the number of atoms, which by Weyl's inequality move no more
    than the root mean square of the atoms' moves; centres may part twice.
    """
    n = len(lengths)
    of = np.repeat(np.arange(n), lengths)
    sizes = np.bincount(of, minlength=n)
    xyz = xyz - (np.stack([np.bincount(of, xyz[:, k], n) for k in range(3)], axis=1) / sizes[:, None])[of]
    whole, _ = _radii(of, n, xyz, sizes)
    names, code = np.unique(elements, return_inverse=True)
    keys, part, counts = np.unique(of * len(names) + code, return_inverse=True, return_counts=True)
    radii, centre = _radii(part, len(keys), xyz, counts)
    owner, name = keys // len(names), keys % len(names)
    order = np.lexsort((name, -counts, owner))
    kinds = np.bincount(owner, minlength=n)
    per = 3 + 4 * kinds
    starts = np.concatenate([[0], np.cumsum(per)])[:-1]
    words = np.empty(per.sum())
    words[starts[:, None] + np.arange(3)] = whole
    rank = np.arange(len(keys)) - np.repeat(np.concatenate([[0], np.cumsum(kinds)])[:-1], kinds)
    at = starts[owner[order]] + 3 + 4 * rank
    words[at[:, None] + np.arange(3)] = radii[order]
    words[at + 3] = np.linalg.norm(centre[order], axis=1)
    return words, word_bounds(per, tolerance), per


def word_bounds(per: np.ndarray, tolerance: float) -> np.ndarray:
    """How far each word of structures with ``per`` words can move: a centre's distance twice the tolerance, radii once."""
    place = np.arange(per.sum()) - np.repeat(np.concatenate([[0], np.cumsum(per)])[:-1], per)
    return np.where((place >= 3) & (place % 4 == 2), 2 * tolerance, tolerance)


def _mixed(h: np.ndarray, value: np.ndarray) -> np.ndarray:
    h = (h ^ value.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def gram_table(words: np.ndarray, bounds: np.ndarray, per: np.ndarray, cell: float) -> tuple[np.ndarray, ...]:
    """(structure, place, n_grams, is_own, gram): every gram of every structure with all the cells its words can fall in.

    ``is_own`` tells the gram of the cells the words are in.
    """
    starts = np.concatenate([[0], np.cumsum(per)])[:-1]
    n_grams = per - GRAM_WORDS + 1
    of = np.repeat(np.arange(len(per)), n_grams)
    place = np.arange(len(of)) - np.repeat(np.concatenate([[0], np.cumsum(n_grams)])[:-1], n_grams)
    window = (starts[of] + place)[:, None] + np.arange(GRAM_WORDS)
    own, low, high = (np.floor(x / cell).astype(np.int64) for x in (words, words - bounds - SLACK, words + bounds + SLACK))
    parts = []
    for choice in range(1 << GRAM_WORDS):
        up = np.array([choice >> k & 1 for k in range(GRAM_WORDS)], bool)
        keep = (~up | (high > low)[window]).all(axis=1)
        if not keep.any():
            continue
        cells, w = np.where(up, high[window[keep]], low[window[keep]]), window[keep]
        gram = place[keep].astype(np.uint64)
        for k in range(GRAM_WORDS):
            gram = _mixed(gram, cells[:, k])
        parts.append((of[keep], place[keep], (cells == own[w]).all(axis=1), gram))
    structure, at, is_own, gram = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool), np.zeros(0, np.uint64))
    return structure, at, n_grams[structure], is_own, gram.view(np.int64)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _words(tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = batch.column("elements").value_lengths().to_numpy(zero_copy_only=False)
            words, _, per = shape_words(_flat(batch.column("elements")).astype(str), np.column_stack([_flat(batch.column(c)) for c in "xyz"]), lengths, tolerance)
            offsets = pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(words))], names=[*batch.schema.names, "words"])

    return run


def _gram_rows(tolerance: float, cell: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            per = batch.column("words").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            of, place, n_grams, is_own, gram = gram_table(_flat(batch.column("words")), word_bounds(per, tolerance), per, cell)
            in_train, in_eval = (batch.column(c).to_numpy(zero_copy_only=False)[of] for c in ("in_train", "in_eval"))
            up = pa.array(of)
            for keep, is_eval in ((in_train & is_own, False), (in_eval, True)):
                chosen = np.flatnonzero(keep)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).take(up.take(pa.array(chosen))) for c in ("class_id", "block")],
                        pa.array(place[chosen], pa.int32()), pa.array(n_grams[chosen], pa.int32()), pa.array(np.full(len(chosen), is_eval)), pa.array(gram[chosen]),
                    ],
                    names=["class_id", "block", "place", "n_grams", "is_eval", "gram"],
                )

    return run


def _verify(tolerance: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            keep = [
                superposable(np.asarray(r.ea), np.column_stack([r.xa, r.ya, r.za]), np.asarray(r.eb), np.column_stack([r.xb, r.yb, r.zb]), tolerance) for r in frame.itertuples(index=False)
            ]
            yield frame.loc[keep, ["train_class", "eval_class", "containment"]]

    return run


def _split_of(name: Column) -> Column:
    return F.lower(F.trim(name))


class SplitOverlap:
    """Overlaps between the train split and the evaluation splits.

    Records without molecule, charge, spin or split, with an atom of unknown
    element or position, or without atoms are compared with none. A record
    sent twice counts once, its latest copy. Identical molecules of the same
    charge and spin form a class; only classes are compared.
    """

    def __init__(self, structures: DataFrame, tolerance: float = TOLERANCE, train: str = "train", evaluation: tuple[str, ...] = ("val", "test")):
        self.tolerance = tolerance
        atoms = F.transform("molecule", lambda a: F.struct(F.lower(F.trim(a["elem"])).alias("e"), a["x"].cast("double").alias("x"), a["y"].cast("double").alias("y"), a["z"].cast("double").alias("z")))
        finite = F.forall("atoms", lambda a: F.coalesce(a["e"].isNotNull() & ~F.isnan(a["x"] + a["y"] + a["z"]) & (F.abs(a["x"]) + F.abs(a["y"]) + F.abs(a["z"]) < float("inf")), F.lit(False)))
        slim = latest_records(structures.select("struct_id", "molecule", "charge", "spin", "split_name", "vertical", "loaded_at"))
        known = (
            slim.withColumn("split", _split_of(F.col("split_name"))).where(F.col("split").isin(train, *evaluation) & F.col("charge").isNotNull() & F.col("spin").isNotNull() & (F.size("molecule") > 0))
            .withColumn("atoms", atoms).where(finite)
        )
        self.members = materialize(
            known.select("struct_id", "vertical", "split", (F.col("split") == train).alias("is_train"), "charge", "spin", F.xxhash64("atoms", "charge", "spin").alias("class_id"), "atoms"), "overlap-members"
        )
        grouped = self.members.groupBy("class_id").agg(
            F.min("struct_id").alias("struct_id"), F.max("is_train").alias("in_train"), F.max(~F.col("is_train")).alias("in_eval"), F.count(F.lit(1)).alias("_rows")
        )
        self.sizes = materialize(grouped, "overlap-sizes")
        block = F.xxhash64(F.array_sort("elements"), "charge", "spin")
        classes = (
            self.sizes.join(self.members.drop("class_id"), "struct_id")
            .select("class_id", "in_train", "in_eval", "charge", "spin", F.col("atoms.e").alias("elements"), F.col("atoms.x").alias("x"), F.col("atoms.y").alias("y"), F.col("atoms.z").alias("z"))
            .withColumn("block", block).drop("charge", "spin")
        )
        schema = "class_id bigint, in_train boolean, in_eval boolean, elements array<string>, x array<double>, y array<double>, z array<double>, block bigint, words array<double>"
        self.classes = materialize(classes.mapInArrow(_words(tolerance), schema), "overlap-classes")

    def hits(self) -> DataFrame:
        """(train_class, eval_class, containment) of at least CONTAINMENT.

        The gram join is a sort-merge join, whose hot grams adaptive execution splits.
        """
        slim = self.classes.select("class_id", "block", "in_train", "in_eval", "words")
        rows = slim.mapInArrow(_gram_rows(self.tolerance, max(CELL, 8 * self.tolerance)), "class_id bigint, block bigint, place int, n_grams int, is_eval boolean, gram bigint")
        rows = materialize(rows, "overlap-grams")
        train = rows.where(~F.col("is_eval")).select(F.col("class_id").alias("train_class"), "block", "place", "gram")
        evaluation = rows.where("is_eval").select(F.col("class_id").alias("eval_class"), "block", "place", "n_grams", "gram")
        return (
            train.join(evaluation, ["block", "place", "gram"])
            .groupBy("train_class", "eval_class")
            .agg((F.count(F.lit(1)) / F.max("n_grams")).alias("containment"))
            .where(F.col("containment") >= CONTAINMENT)
        )

    def class_pairs(self) -> DataFrame:
        """(train_class, eval_class, containment): classes that can be superposed."""

        def side(letter: str, name: str) -> DataFrame:
            return self.classes.select(F.col("class_id").alias(name), F.col("elements").alias(f"e{letter}"), *[F.col(c).alias(f"{c}{letter}") for c in "xyz"], F.col("words").alias(f"w{letter}"))

        hits = self.hits()
        same = hits.where(F.col("train_class") == F.col("eval_class"))
        other = hits.where(F.col("train_class") != F.col("eval_class")).join(side("a", "train_class"), "train_class").join(side("b", "eval_class"), "eval_class")
        apart = F.zip_with("wa", "wb", lambda a, b: F.abs(a - b))
        bound = [F.lit(k * self.tolerance + SLACK) for k in (1, 2)]
        too_far = F.filter(apart, lambda d, i: d > F.when((i >= 3) & (i % 4 == 2), bound[1]).otherwise(bound[0]))
        close = other.where(F.size(too_far) == 0).drop("wa", "wb")
        return same.unionByName(close.mapInPandas(_verify(self.tolerance), "train_class bigint, eval_class bigint, containment double"))

    def record_pairs(self) -> DataFrame:
        """(train_id, eval_id): every train record with every evaluation record it can be superposed on.

        The records of a class are dealt to as many salts as it has
        CLASS_ROWS, and a pair of classes to every two salts, so no join key
        has more than about CLASS_ROWS records of either side.
        """
        pairs = materialize(self.class_pairs(), "overlap-pairs").drop("containment")
        salts = self.sizes.select("class_id", "_rows", F.ceil(F.col("_rows") / CLASS_ROWS).cast("int").alias("salts"))
        wanted = pairs.select(F.explode(F.array("train_class", "eval_class")).alias("class_id")).distinct()
        members = skew_lookup(self.members.select("class_id", "struct_id", "is_train"), salts.join(wanted, "class_id"), ["class_id"], "_rows")
        members = materialize(members.select("class_id", "struct_id", "is_train", F.pmod(F.xxhash64("struct_id"), F.col("salts")).cast("int").alias("salt")), "overlap-salted")
        dealt = pairs
        for side in ("train", "eval"):
            own = salts.select(F.col("class_id").alias(f"{side}_class"), F.col("salts").alias(f"_{side}"))
            dealt = dealt.join(own, f"{side}_class").withColumn(f"{side}_salt", F.explode(F.sequence(F.lit(0), F.col(f"_{side}") - 1))).drop(f"_{side}")
        dealt = materialize(dealt, "overlap-dealt")
        sides = []
        for side, mine in (("train", F.col("is_train")), ("eval", ~F.col("is_train"))):
            own = members.where(mine).select(F.col("class_id").alias(f"{side}_class"), F.col("salt").alias(f"{side}_salt"), F.col("struct_id").alias(f"{side}_id"))
            sides.append(dealt.join(own, [f"{side}_class", f"{side}_salt"]))
        return sides[0].join(sides[1], ["train_class", "eval_class", "train_salt", "eval_salt"]).select("train_id", "eval_id")

    def report(self) -> DataFrame:
        """Per evaluation split and vertical: records, those with a relative in train, exact ones among them, links.

        Counted from class pairs and class sizes; links are not listed.
        """
        pairs = self.class_pairs()
        n_train = self.members.where("is_train").groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
        linked = (
            pairs.join(n_train.withColumnRenamed("class_id", "train_class"), "train_class")
            .groupBy(F.col("eval_class").alias("class_id"))
            .agg(F.sum("n").alias("n_links"), F.max((F.col("train_class") == F.col("eval_class")).cast("int")).alias("exact"))
            .join(self.sizes.select("class_id", "_rows"), "class_id")
        )
        records = self.members.where(~F.col("is_train")).select("class_id", "split", "vertical")
        found = skew_lookup(records, linked, ["class_id"], "_rows").groupBy("split", "vertical").agg(F.count(F.lit(1)).alias("n_overlapping"), F.sum("exact").alias("n_exact"), F.sum("n_links").alias("n_links"))
        every = records.groupBy("split", "vertical").agg(F.count(F.lit(1)).alias("n_records"))
        zero = F.lit(0).cast("bigint")
        return every.join(found, [every["split"] == found["split"], every["vertical"].eqNullSafe(found["vertical"])], "left").select(
            every["split"], every["vertical"], "n_records", *[F.coalesce(c, zero).cast("bigint").alias(c) for c in ("n_overlapping", "n_exact", "n_links")]
        )
