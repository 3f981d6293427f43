"""Schemas that drift from batch to batch of a feed.

The files of a batch are reduced to one row per field (types, number of
files, whether its value is a map of atom pairs) and the evidence that a gone
field and a come field hold the same values in folders sent in both batches.
Over these small summaries similarity flooding decides which gone field became
which new one; the changes follow, and with them each field's name throughout
its feed, under which all values are cast and united.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrystone.operators.skew import skew_lookup
from quarrystone.session import materialize

_PAIR = re.compile(r"[0-9]+_[A-Za-z]+_to_[0-9]+_[A-Za-z]+")
#: The JSON types, in the order ties between them are settled.
TYPES = ("number", "string", "boolean", "object", "array")
_FIELD_SCHEMA = "file_id bigint, field string, is_pairs boolean, known boolean, number bigint, string bigint, boolean bigint, object bigint, array bigint, cells map<string,string>"
FLOOD_ROUNDS, FLOOD_EPS = 50, 1e-4


def _kind(value: object) -> str | None:
    if value is None:
        return None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    return {str: "string", dict: "object", list: "array"}[type(value)]


def _reject(_: str) -> None:
    raise ValueError("not JSON")


def _text(value: object) -> str | None:
    return None if value is None else json.dumps(value, sort_keys=True)


def _fields(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        rows = []
        for file_id, content in zip(frame["file_id"], frame["content"]):
            try:
                record = json.loads(content, parse_constant=_reject)
            except (TypeError, ValueError, RecursionError):
                continue
            if not isinstance(record, dict):
                continue
            for name, value in record.items():
                is_pairs = isinstance(value, dict) and bool(value) and all(map(_PAIR.fullmatch, value))
                kinds = [_kind(x) for x in value.values()] if is_pairs else [_kind(value)]
                cells = value if is_pairs else {"": value}
                rows.append((file_id, name, is_pairs, any(kinds), *[sum(k == t for k in kinds) for t in TYPES], {k: _text(x) for k, x in cells.items()}))
        yield pd.DataFrame(rows, columns=["file_id", "field", "is_pairs", "known", *TYPES, "cells"])


def file_fields(files: DataFrame) -> DataFrame:
    """One row per field of each readable file, with where the file was sent.

    Readable is a JSON object as a whole; null, empty, cut or other content
    has no fields. A file sent twice (same file_id) counts once, its latest
    copy. A value that is null, or pairs that are all null, has no digest.
    """
    place = ["feed_id", "batch_no", "folder"]
    one = files.groupBy("file_id").agg(F.max_by(F.struct(*place, "written_at", "content"), F.struct(F.col("content").isNotNull(), "loaded_at")).alias("f")).select("file_id", "f.*")
    parsed = one.select("file_id", "content").mapInPandas(_fields, _FIELD_SCHEMA)
    return parsed.join(one.drop("content"), "file_id")


def batch_fields(fields: DataFrame) -> DataFrame:
    """(feed_id, batch_no, field, kind, kind_share, is_pairs, n_files): a row per field of each batch."""
    sums = fields.groupBy("feed_id", "batch_no", "field").agg(
        *[F.sum(t).alias(t) for t in TYPES], F.sum(F.col("is_pairs").cast("int")).alias("_pairs"), F.count(F.lit(1)).alias("n_files"), F.sum(F.col("known").cast("int")).alias("_known")
    )
    best = F.array_max(F.array(*[F.struct(F.col(t).alias("n"), F.lit(-i).alias("rank"), F.lit(t).alias("kind")) for i, t in enumerate(TYPES)]))
    total = sum((F.col(t) for t in TYPES[1:]), F.col(TYPES[0]))
    return sums.select(
        "feed_id", "batch_no", "field", F.when(best["n"] > 0, best["kind"]).alias("kind"), F.try_divide(best["n"], total).alias("kind_share"),
        (F.col("_pairs") * 2 > F.col("_known")).alias("is_pairs"), "n_files",
    )


def batch_steps(fields: DataFrame) -> DataFrame:
    """(feed_id, batch_no, before): each batch with the one before it in its feed."""
    return (
        fields.select("feed_id", "batch_no").distinct()
        .withColumn("before", F.lag("batch_no").over(Window.partitionBy("feed_id").orderBy("batch_no")))
        .where(F.col("before").isNotNull())
    )


def _name_similarity(a: str, b: str) -> float:
    grams = [{f" {x} "[i : i + 2] for i in range(len(x) + 1)} for x in (a.lower(), b.lower())]
    return len(grams[0] & grams[1]) / max(1, len(grams[0] | grams[1]))


def flood(start: np.ndarray, links: list[tuple[int, int, float]], rounds: int = FLOOD_ROUNDS, eps: float = FLOOD_EPS) -> np.ndarray:
    """Similarities at the fixpoint of s = normed(start + s + W (start + s)).

    ``links`` join nodes of the pairwise connectivity graph both ways; the
    weight a node sends is shared by its links, as their weights have it.
    """
    n = len(start)
    if not n:
        return start
    weight = np.zeros((n, n))
    for i, j, w in links:
        weight[i, j] += w
        weight[j, i] += w
    weight = weight / np.maximum(weight.sum(axis=0), 1e-12)
    score = start.copy()
    for _ in range(rounds):
        new = start + score + weight @ (start + score)
        new /= max(new.max(), 1e-12)
        done = np.abs(new - score).max() < eps
        score = new
        if done:
            break
    return score


def _match(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Gone and come fields of one step put in correspondence by similarity flooding.

    Nodes are the field pairs and, beside each, the pair of their types, of
    their shapes (atom pairs or plain) and of their values; those start from
    what is known of them and flow into the field pair and back.
    """
    gone, come = sorted(set(frame["old_field"])), sorted(set(frame["new_field"]))
    nodes, links, start = {}, [], []

    def node(label: tuple, value: float) -> int:
        if label not in nodes:
            nodes[label] = len(nodes)
            start.append(value)
        return nodes[label]

    for row in frame.itertuples():
        pair = node(("field", row.old_field, row.new_field), 0.5 * _name_similarity(row.old_field, row.new_field))
        links.append((pair, node(("type", row.old_kind, row.new_kind), float(row.old_kind == row.new_kind)), 0.5))
        links.append((pair, node(("shape", row.old_pairs, row.new_pairs), float(row.old_pairs == row.new_pairs)), 0.5))
        agree = row.n_equal / (row.n_equal + row.n_other) if row.n_equal else 0.0
        links.append((pair, node(("values", row.old_field, row.new_field), 2.0 * agree), 2.0))
    score = flood(np.array(start), links)
    evidence = {(r.old_field, r.new_field): (r.n_equal, r.n_other) for r in frame.itertuples()}
    ranked = sorted(((score[nodes["field", a, b]], a, b) for a in gone for b in come if ("field", a, b) in nodes), key=lambda x: (-x[0], x[1], x[2]))
    taken, out = set(), []
    for s, a, b in ranked:
        equal, other = evidence[a, b]
        if ("old", a) in taken or ("new", b) in taken or not equal or other >= equal:
            continue
        taken |= {("old", a), ("new", b)}
        out.append((*key, a, b, float(s)))
    return pd.DataFrame(out, columns=["feed_id", "batch_no", "old_field", "new_field", "score"])


def schema_changes(fields: DataFrame) -> DataFrame:
    """Every change between following batches: (feed_id, batch_no, change_kind, field, new_field, old_kind, new_kind, score).

    ``renamed`` needs more equal than unequal known values in the folders sent
    in both batches; among rivals flooding decides. A
    field whose values are all null has no type and is not retyped. ``fields``
    is what file_fields gives.
    """
    summary = materialize(batch_fields(fields), "drift-fields")
    steps = materialize(batch_steps(summary), "drift-steps")
    now = steps.join(summary, ["feed_id", "batch_no"]).select("feed_id", "batch_no", "field", F.col("kind").alias("new_kind"), F.col("is_pairs").alias("new_pairs"), F.lit(True).alias("_new"))
    old = (
        summary.withColumnRenamed("batch_no", "before").join(steps, ["feed_id", "before"])
        .select("feed_id", "batch_no", "field", F.col("kind").alias("old_kind"), F.col("is_pairs").alias("old_pairs"), F.lit(True).alias("_old"))
    )
    both = materialize(old.join(now, ["feed_id", "batch_no", "field"], "full_outer"), "drift-both")
    gone = both.where(F.col("_new").isNull()).select("feed_id", "batch_no", F.col("field").alias("old_field"), "old_kind", "old_pairs")
    come = both.where(F.col("_old").isNull()).select("feed_id", "batch_no", F.col("field").alias("new_field"), "new_kind", "new_pairs")

    # evidence: known values of gone and come fields, cell by cell in the folders sent in both
    latest = fields.where("known").groupBy("feed_id", "batch_no", "folder", "field").agg(F.max_by("cells", F.struct("written_at", "file_id")).alias("cells"))
    old_values = (
        latest.withColumnRenamed("batch_no", "before").join(steps, ["feed_id", "before"]).join(gone.select("feed_id", "batch_no", F.col("old_field").alias("field")), ["feed_id", "batch_no", "field"])
        .select("feed_id", "batch_no", "folder", F.col("field").alias("old_field"), F.col("cells").alias("old_cells"))
    )
    new_values = latest.join(come.select("feed_id", "batch_no", F.col("new_field").alias("field")), ["feed_id", "batch_no", "field"]).select("feed_id", "batch_no", "folder", F.col("field").alias("new_field"), F.col("cells").alias("new_cells"))
    cells = F.map_values(F.map_zip_with("old_cells", "new_cells", lambda _, a, b: a == b))
    evidence = (
        old_values.join(new_values, ["feed_id", "batch_no", "folder"])
        .select("feed_id", "batch_no", "old_field", "new_field", F.size(F.filter(cells, lambda x: x)).alias("eq"), F.size(F.filter(cells, lambda x: ~x)).alias("ne"))
        .groupBy("feed_id", "batch_no", "old_field", "new_field")
        .agg(F.sum("eq").alias("n_equal"), F.sum("ne").alias("n_other"))
    )
    rivals = gone.join(come, ["feed_id", "batch_no"]).join(evidence, ["feed_id", "batch_no", "old_field", "new_field"], "left").fillna(0, ["n_equal", "n_other"])
    # steps cost time, not bytes: adaptive execution must not put them together in a few tasks
    spread = rivals.repartition(int(fields.sparkSession.conf.get("spark.sql.shuffle.partitions")), "feed_id", "batch_no")
    renamed = materialize(spread.groupBy("feed_id", "batch_no").applyInPandas(_match, "feed_id bigint, batch_no int, old_field string, new_field string, score double"), "drift-renamed")

    none = F.lit(None)
    kept = both.where(F.col("_old") & F.col("_new") & (F.col("old_kind") != F.col("new_kind")))
    plain = {
        "removed": gone.join(renamed.select("feed_id", "batch_no", "old_field"), ["feed_id", "batch_no", "old_field"], "left_anti").select("feed_id", "batch_no", F.col("old_field").alias("field"), "old_kind", none.cast("string").alias("new_kind")),
        "added": come.join(renamed.select("feed_id", "batch_no", "new_field"), ["feed_id", "batch_no", "new_field"], "left_anti").select("feed_id", "batch_no", F.col("new_field").alias("field"), none.cast("string").alias("old_kind"), "new_kind"),
        "retyped": kept.select("feed_id", "batch_no", "field", "old_kind", "new_kind"),
    }
    out = (
        renamed.join(gone, ["feed_id", "batch_no", "old_field"]).join(come, ["feed_id", "batch_no", "new_field"])
        .select("feed_id", "batch_no", F.lit("renamed").alias("change_kind"), F.col("old_field").alias("field"), "new_field", "old_kind", "new_kind", "score")
    )
    for change, rows in plain.items():
        out = out.unionByName(rows.select("feed_id", "batch_no", F.lit(change).alias("change_kind"), "field", F.lit("").alias("new_field"), "old_kind", "new_kind", none.cast("double").alias("score")))
    return out


def field_names(fields: DataFrame, changes: DataFrame) -> DataFrame:
    """(feed_id, batch_no, field, canonical): one name per field through all renames.

    A field's run of batches begins where it is added or renamed into being;
    its canonical name is the one its chain of renames began with. Chains are
    shortened by pointer doubling, a join a round.
    """
    present = fields.select("feed_id", "batch_no", "field").distinct()
    begins = changes.where(F.col("change_kind").isin("added", "renamed")).select("feed_id", "batch_no", F.when(F.col("change_kind") == "renamed", F.col("new_field")).otherwise(F.col("field")).alias("field"), F.lit(True).alias("_begin"))
    runs = materialize(
        present.join(begins, ["feed_id", "batch_no", "field"], "left").withColumn(
            "born", F.coalesce(F.max(F.when(F.col("_begin"), F.col("batch_no"))).over(Window.partitionBy("feed_id", "field").orderBy("batch_no").rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
        ).drop("_begin"),
        "drift-runs",
    )
    renames = changes.where(F.col("change_kind") == "renamed").select("feed_id", "batch_no", F.col("field").alias("old"), F.col("new_field").alias("new"))
    before = batch_steps(fields)
    heads = (
        renames.join(before, ["feed_id", "batch_no"])
        .join(runs.select("feed_id", F.col("batch_no").alias("before"), F.col("field").alias("old"), F.col("born").alias("old_born")), ["feed_id", "before", "old"])
        .select("feed_id", F.col("new").alias("field"), F.col("batch_no").alias("born"), F.col("old").alias("to_field"), F.col("old_born").alias("to_born"))
    )
    heads = materialize(heads, "drift-heads")
    while True:
        onward = heads.select("feed_id", F.col("field").alias("to_field"), F.col("born").alias("to_born"), F.col("to_field").alias("_f"), F.col("to_born").alias("_b"), F.lit(1).alias("_moved"))
        stepped = materialize(
            heads.join(onward, ["feed_id", "to_field", "to_born"], "left").select("feed_id", "field", "born", F.coalesce("_f", "to_field").alias("to_field"), F.coalesce("_b", "to_born").alias("to_born"), "_moved"),
            "drift-heads",
        )
        heads = stepped.drop("_moved")
        if stepped.where(F.col("_moved") == 1).isEmpty():
            break
    return runs.join(heads, ["feed_id", "field", "born"], "left").select("feed_id", "batch_no", "field", F.coalesce("to_field", "field").alias("canonical"))


def consistent_table(fields: DataFrame, changes: DataFrame) -> DataFrame:
    """All values in one schema: (file_id, feed_id, batch_no, folder, field, source_field, pair, value, text).

    ``pair`` is the atom pair, '' for fields without pairs; ``value`` the
    number, cast from text or from a {value, unit} object where it was sent so;
    ``text`` the value as sent. Null values keep a row with nulls.
    """
    place = ["feed_id", "batch_no", "field"]
    sizes = fields.groupBy(*place).agg(F.count(F.lit(1)).alias("_rows"))
    named = skew_lookup(fields, materialize(field_names(fields, changes).join(sizes, place), "drift-names"), place, "_rows")
    rows = named.select("file_id", "feed_id", "batch_no", "folder", F.col("canonical").alias("field"), F.col("field").alias("source_field"), F.explode("cells").alias("pair", "_json"))
    text = F.from_json(F.concat(F.lit('{"v":'), F.col("_json"), F.lit("}")), "v string")["v"]
    unwrapped = F.when(F.ltrim("text").startswith("{"), F.from_json("text", "value string")["value"]).otherwise(F.col("text"))
    return rows.withColumn("text", text).select("file_id", "feed_id", "batch_no", "folder", "field", "source_field", "pair", F.trim(unwrapped).try_cast("double").alias("value"), "text")
