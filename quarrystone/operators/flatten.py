"""Deeply nested records turned into linked flat tables.

Spark parses each payload into typed nested columns; the tables are then cut
from the Arrow buffers of those columns: list offsets say how many children
each parent has, the parent index of every child is their run-length
expansion, and keys reach the children by a vectorised ``take``. No row is
looked at in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One schema for all children; ``child`` names the table a row belongs to.
CHILD_SCHEMA = (
    "rec_id bigint, child string, child_key string, parent_key string, position int, "
    "label string, value double, x double, y double, z double"
)
_CHILD = pa.schema([
    ("rec_id", pa.int64()), ("child", pa.string()), ("child_key", pa.string()), ("parent_key", pa.string()), ("position", pa.int32()),
    ("label", pa.string()), ("value", pa.float64()), ("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64()),
])

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
_GRAPH = "molecule struct<charge:string,spin_multiplicity:string,sites:array<string>>, graphs struct<adjacency:array<array<string>>>"
_SITE = "name string, xyz array<double>"
_LINK = "id int, weight double"
_POINT = "element string, pos_ang string, eig_hess variant, density_all double"


def _json(text: Column, schema: str) -> Column:
    return F.from_json(text, schema, _STRICT)


def _numbers(value: Column) -> Column:
    """A JSON list, or one bare value, as the list of its numbers; null in the place of what is none (text and true are none)."""

    def number(v: Column) -> Column:
        return F.when(F.schema_of_variant(v).rlike(r"^(BIGINT|DOUBLE|DECIMAL)"), F.try_variant_get(v, "$", "double"))

    listed = F.transform(F.try_variant_get(value, "$", "array<variant>"), number)
    return F.when(F.startswith(F.schema_of_variant(value), F.lit("ARRAY")), listed).when(value.isNotNull(), F.array(number(value)))


def _position(text: Column) -> Column:
    """[x, y, z] from a list, an {x, y, z} object or a list sent as text."""
    trimmed = F.ltrim(text)
    as_object = _json(text, "x double, y double, z double")
    bare = F.split(F.regexp_replace(text, r"[\[\]()]", " "), r"[\s,;]+")
    return (
        F.when(trimmed.startswith("["), _json(text, "array<double>"))
        .when(trimmed.startswith("{"), F.array(as_object["x"], as_object["y"], as_object["z"]))
        .otherwise(F.transform(F.filter(bare, lambda t: t != ""), lambda t: t.try_cast("double")))
    )


def _charge(text: Column) -> Column:
    """A charge sent as number, text, one-element list or {value, unit} object."""
    trimmed = F.ltrim(text)
    return (
        F.when(trimmed.startswith("{"), _json(text, "value double")["value"])
        .when(trimmed.startswith("["), F.try_element_at(_json(text, "array<double>"), F.lit(1)))
        .otherwise(F.trim(text).try_cast("double"))
    )


def parse_records(records: DataFrame, rec_id: str = "rec_id", payload: str = "payload", loaded_at: str = "loaded_at") -> DataFrame:
    """(rec_id, points, graphs): the nested columns of each record.

    A record sent more than once counts once (its content does not change). A
    payload that is null, empty or not JSON as a whole has no children. A
    record inside a list or under a ``qtaim`` member is unwrapped; of a list of
    several all are read, keys of the second and later ones behind their place
    (``1:``), so that they stay apart.
    """
    order = F.struct(F.col(payload).isNotNull(), F.col(loaded_at), F.col(payload))
    one = records.groupBy(F.col(rec_id).cast("bigint").alias("rec_id")).agg(F.max_by(payload, order).alias("payload"))
    text = F.trim(F.regexp_replace("payload", r"\A[\s﻿]+", ""))
    entries = F.when(text.startswith("["), _json(text, "array<string>")).otherwise(F.array(text))
    flat = one.select("rec_id", F.posexplode(entries).alias("_place", "_text")).select(
        "rec_id", F.when(F.col("_place") > 0, F.concat(F.col("_place").cast("string"), F.lit(":"))).otherwise("").alias("_at"), _json(F.col("_text"), "map<string,string>").alias("_top")
    )
    inner = F.when(F.map_contains_key("_top", F.lit("qtaim")), _json(F.try_element_at("_top", F.lit("qtaim")), "map<string,string>")).otherwise(F.col("_top"))
    flat = flat.where(F.col("_top").isNotNull()).select("rec_id", "_at", inner.alias("_top"))
    points = F.transform(
        F.filter(F.map_entries("_top"), lambda e: e["key"].rlike(r"\A[0-9]+(_[0-9]+)?\z") & e["value"].isNotNull() & F.ltrim(e["value"]).startswith("{")),
        lambda e: F.struct(F.concat("_at", e["key"]).alias("key"), _json(e["value"], _POINT).alias("p")),
    )
    graphs = F.array(
        *[
            F.struct(F.lit(side).alias("side"), F.try_element_at("_top", F.lit(f"{side}_molecule_graph")).alias("text"))
            for side in ("reactant", "product")
        ]
    )
    graphs = F.filter(graphs, lambda g: F.ltrim(g["text"]).startswith("{"))
    parsed = flat.select("rec_id", points.alias("points"), F.transform(graphs, lambda g: F.struct(F.concat("_at", g["side"]).alias("side"), _json(g["text"], _GRAPH).alias("g"))).alias("graphs"))
    return parsed.select(
        "rec_id",
        F.transform(
            "points",
            lambda p: F.struct(
                p["key"].alias("key"), p["p"]["element"].alias("element"), p["p"]["density_all"].alias("density"), _position(p["p"]["pos_ang"]).alias("pos"), _numbers(p["p"]["eig_hess"]).alias("eig")
            ),
        ).alias("points"),
        F.transform(
            "graphs",
            lambda g: F.struct(
                g["side"].alias("side"),
                _charge(g["g"]["molecule"]["charge"]).alias("charge"),
                F.transform(g["g"]["molecule"]["sites"], lambda s: _json(s, _SITE)).alias("sites"),
                F.transform(g["g"]["graphs"]["adjacency"], lambda row: F.transform(row, lambda k: _json(k, _LINK))).alias("adjacency"),
            ),
        ).alias("graphs"),
    )


def _children(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The values of a list column, the row each came from, its place in that row.

    The offsets are turned into counts (null rows have none), the counts into
    parent indices; values under a null row are left out by the flatten.
    """
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parents = np.repeat(np.arange(len(lists)), counts)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0, np.int64)
    return pc.list_flatten(lists), parents, np.arange(len(parents)) - np.repeat(starts, counts)


def _axis(positions: pa.Array, axis: int) -> pa.Array:
    """Entry ``axis`` of each list, null where there are fewer."""
    values, parents, place = _children(positions)
    at = np.full(len(positions), -1)
    hit = place == axis
    at[parents[hit]] = np.flatnonzero(hit)
    return values.take(pa.array(at, mask=at < 0))


def _joined(*parts: pa.Array | str) -> pa.Array:
    return pc.binary_join_element_wise(*[p if isinstance(p, str) else p.cast(pa.string()) for p in parts], "")


def _emit(child: str, **columns: pa.Array) -> pa.RecordBatch:
    n = len(columns["rec_id"])
    return pa.RecordBatch.from_arrays(
        [pa.array([child] * n, pa.string()) if f.name == "child" else (columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type)) for f in _CHILD], schema=_CHILD
    )


def _flatten_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rec_id = batch.column("rec_id")
        points, of_rec, place = _children(batch.column("points"))
        ids, key = rec_id.take(pa.array(of_rec)), points.field("key")
        pos = points.field("pos")
        yield _emit("cp", rec_id=ids, child_key=key, parent_key=pa.nulls(len(key), pa.string()), position=pa.array(place), label=points.field("element"), value=points.field("density"), x=_axis(pos, 0), y=_axis(pos, 1), z=_axis(pos, 2))
        number, of_point, place = _children(points.field("eig"))
        keep, up = pc.is_valid(number), pa.array(of_point)
        owner = key.take(up)
        yield _emit("eig", **{c: a.filter(keep) for c, a in {"rec_id": ids.take(up), "child_key": _joined(owner, "/", pa.array(place)), "parent_key": owner, "position": pa.array(place), "value": number}.items()})

        graphs, of_rec, place = _children(batch.column("graphs"))
        ids, side = rec_id.take(pa.array(of_rec)), graphs.field("side")
        yield _emit("molecule", rec_id=ids, child_key=side, position=pa.array(place), value=graphs.field("charge"))
        sites, of_graph, place = _children(graphs.field("sites"))
        up = pa.array(of_graph)
        owner, pos = side.take(up), sites.field("xyz")
        yield _emit("site", rec_id=ids.take(up), child_key=_joined(owner, "/", pa.array(place)), parent_key=owner, position=pa.array(place), label=sites.field("name"), x=_axis(pos, 0), y=_axis(pos, 1), z=_axis(pos, 2))
        rows, of_graph, row_place = _children(graphs.field("adjacency"))
        links, of_row, place = _children(rows)
        up = pa.array(of_graph[of_row])
        owner = _joined(side.take(up), "/", pa.array(row_place[of_row]))
        yield _emit("link", rec_id=ids.take(up), child_key=_joined(owner, "/", pa.array(place)), parent_key=owner, position=pa.array(place), label=links.field("id"), value=links.field("weight"))


def flatten_records(records: DataFrame, rec_id: str = "rec_id", payload: str = "payload", loaded_at: str = "loaded_at") -> DataFrame:
    """All children of all records in one table; see ``CHILD_SCHEMA``.

    ``cp``: points (label element, value density); ``eig``: eigenvalues of a
    point (parent_key its key); ``molecule``: graphs (value charge); ``site``:
    atoms of a graph; ``link``: entries of its adjacency (label the partner,
    value the weight, parent_key the site it starts from). Entries keep their
    place in the list they came from even if others are null; entries of an
    eigenvalue list that are no numbers are left out. Missing optional fields
    are null. Empty tables give an empty table.
    """
    return parse_records(records, rec_id, payload, loaded_at).mapInArrow(_flatten_batches, CHILD_SCHEMA)
