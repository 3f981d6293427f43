"""The general training-data operators against plain versions and on odd input."""

import json
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarrystone.operators import drift, flatten, lowrank, masks, packing
from quarrystone.operators.components import connected_components
from quarrystone.operators.quantiles import exact_quantiles
from quarrystone.operators.skew import skew_lookup

CPS = "record_key string, cp_key string, density_all double, ellip_e_dens double, eig_hess double, lap_e_density double, esp_total double, spin_density double, lagrangian_k double, eta double, elem string, loaded_at timestamp, density_all_filled string"


def _points(spark, n=400):
    rows = []
    for i in range(n):
        carbon = i % 2 == 0
        d, e = (120.0, -9e4) if carbon else (0.43, -0.5)
        rows.append((f"r{i // 10}", str(i % 10), d * (1 + 0.001 * (i % 7)), 0.01, e * (1 + 0.001 * (i % 5)), -2.7 * abs(e), 8e3 if carbon else 2.0, 0.0, 5.0, -1.0, " c" if carbon else "H", None, "x"))
    return rows


def test_fill_marks_and_decodes(spark):
    rows = [list(r) for r in _points(spark)]
    rows[0][2], rows[1][2], rows[2][10], rows[3][10], rows[4][3] = float("nan"), None, "?", None, -1.0
    rows.append(["b", "0_1", 0.3, None, -0.5, -1.0, 1.0, 0.0, 0.1, 0.5, None, None, "x"])
    df = spark.createDataFrame([tuple(r) for r in rows], CPS)
    model = lowrank.LowRankFill(lowrank.CRITICAL_POINTS.numbers, lowrank.CRITICAL_POINTS.category, rank=6)
    out = {(r["record_key"], r["cp_key"]): r for r in model.fill(df).collect()}
    assert out["r0", "0"]["density_all_filled"] and 60 < out["r0", "0"]["density_all"] < 240
    assert out["r0", "1"]["density_all_filled"] and 0.2 < out["r0", "1"]["density_all"] < 0.9
    assert out["r0", "2"]["elem"] == "C" and out["r0", "2"]["elem_filled"] and out["r0", "3"]["elem"] == "H"
    assert out["r0", "4"]["ellip_e_dens_filled"] and 0 <= out["r0", "4"]["ellip_e_dens"] <= 1000
    assert out["r0", "6"]["elem"] == "C" and not out["r0", "6"]["elem_filled"]
    assert out["b", "0_1"]["elem"] is None and not out["b", "0_1"]["elem_filled"] and out["b", "0_1"]["ellip_e_dens_filled"]
    cells = {tuple(r) for r in lowrank.filled_cells(model.fill(df), model).collect()}
    assert cells == {("r0", "0", "density_all"), ("r0", "1", "density_all"), ("r0", "2", "elem"), ("r0", "3", "elem"), ("r0", "4", "ellip_e_dens"), ("b", "0_1", "ellip_e_dens")}


def test_fill_of_nothing(spark):
    empty = spark.createDataFrame([], CPS)
    assert lowrank.CRITICAL_POINTS.fill(empty).count() == 0
    unknown = spark.createDataFrame([("r", "0", *[None] * 9, None, None)], CPS)
    row = lowrank.CRITICAL_POINTS.fill(unknown).first()
    assert row["density_all_filled"] and math.isfinite(row["density_all"]) and row["density_all"] > 0 and row["elem"]


def test_held_out_cells_come_back(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/qtaim_cps.parquet")
    points = lowrank.latest_points(df).withColumn("_t", F.pmod(F.xxhash64("record_key", "cp_key"), F.lit(10)))
    known = points.where("_t = 0 and not contains(cp_key, '_')").where(F.lower(F.trim("elem")).isin([s.lower() for s in lowrank.SYMBOLS]))
    hidden = known.withColumn("_true", F.initcap(F.trim("elem"))).withColumn("elem", F.lit(None).cast("string"))
    model = lowrank.CRITICAL_POINTS.fit(points.where("_t > 0"))
    got = lowrank.CRITICAL_POINTS.fill(hidden, model).select(F.avg((F.col("elem") == F.col("_true")).cast("double"))).first()[0]
    assert got > 0.95


NESTED = [
    (1, '{"0": {"pos_ang": [1, 2, 3], "eig_hess": [-1, null, 2.5]}, "0_1": {"pos_ang": "1 2 3", "eig_hess": -3}, "2": null}'),
    (2, '[{"reaction_id": 2, "reactant_molecule_graph": {"molecule": {"charge": "2", "sites": [{"name": "C", "xyz": [0, 0, 1]}, null]}, "graphs": {"adjacency": [[{"id": 1, "weight": 1}], []]}}, "product_molecule_graph": null}]'),
    (3, json.dumps({"product_molecule_graph": json.dumps({"molecule": {"charge": {"value": 1, "unit": "e"}}, "graphs": None})})),
    (4, '{"0": {"pos_ang": [1, 2'),
    (5, None),
    (6, ""),
    (7, '{"qtaim": {"3": {"eig_hess": []}}}'),
]


def test_flatten_links_children(spark):
    df = spark.createDataFrame([(i, p, None, "clash") for i, p in NESTED + NESTED[:2]], "rec_id bigint, payload string, loaded_at timestamp, child string")
    rows = flatten.flatten_records(df).collect()
    got = {(r["rec_id"], r["child"], r["child_key"]) for r in rows}
    assert len(got) == len(rows)
    assert got == {
        (1, "cp", "0"), (1, "cp", "0_1"), (1, "eig", "0/0"), (1, "eig", "0/2"), (1, "eig", "0_1/0"), (2, "molecule", "reactant"), (2, "site", "reactant/0"), (2, "site", "reactant/1"),
        (2, "link", "reactant/0/0"), (3, "molecule", "product"), (7, "cp", "3"),
    }
    by = {(r["rec_id"], r["child"], r["child_key"]): r for r in rows}
    assert by[2, "molecule", "reactant"]["value"] == 2.0 and by[3, "molecule", "product"]["value"] == 1.0
    assert by[1, "cp", "0_1"]["z"] == 3.0 and by[2, "link", "reactant/0/0"]["parent_key"] == "reactant/0" and by[1, "eig", "0/2"]["value"] == 2.5
    assert flatten.flatten_records(df.limit(0)).count() == 0


def _files(spark, batches):
    rows, n = [], 0
    for batch, files in batches.items():
        for folder, content in files.items():
            n += 1
            rows.append((n, 1, batch, folder, content if content is None or isinstance(content, str) else json.dumps(content), None, None))
    return spark.createDataFrame(rows, "file_id bigint, feed_id bigint, batch_no int, folder string, content string, written_at timestamp, loaded_at timestamp")


def test_drift(spark):
    df = _files(spark, {
        1: {"a": {"mayer": {"1_C_to_2_H": 1.0, "1_C_to_3_H": None}, "n": 3, "gone": 1}, "b": {"mayer": {"1_C_to_2_O": 2.0}, "n": 4}},
        2: {"a": {"mbo": {"1_C_to_2_H": 1.0, "1_C_to_3_H": 0.5}, "n": "3", "new": True}, "b": "{broken", "c": {"n": "5"}},
        3: {"a": {"mayer_bond": {"1_C_to_2_H": 1.0, "1_C_to_3_H": 0.5}, "n": "3", "new": None}, "d": None},
    })
    fields = drift.file_fields(df)
    changes = drift.schema_changes(fields)
    got = {tuple(r) for r in changes.select("batch_no", "change_kind", "field", "new_field").collect()}
    assert got == {(2, "renamed", "mayer", "mbo"), (2, "removed", "gone", ""), (2, "added", "new", ""), (2, "retyped", "n", ""), (3, "renamed", "mbo", "mayer_bond")}
    table = drift.consistent_table(fields, changes).toPandas()
    assert set(table[table.pair != ""].field) == {"mayer"} and table[(table.folder == "c") & (table.field == "n")].value.tolist() == [5.0]
    assert drift.schema_changes(drift.file_fields(df.limit(0))).count() == 0


def test_masks(spark):
    rows = [(1, 1, "True", "true", "12", "1.5"), (2, 1, " false ", None, "0", "1e999"), (3, 1, "ok", "nan", "10000", "-1"), (4, None, "False\t", "", "00012", "3.2e1"), (5, 2, None, "NONE", "10001", "5."), (6, 2, "True", "True", "1x", "NaN")]
    df = spark.createDataFrame(rows, "val_id bigint, load_no int, val_qtaim string, val_charge string, n_atoms string, total_time string").withColumn("field", F.lit("clash"))
    got = {(r["row_id"], r["field"]) for r in masks.MaskProfile().violations(df, "val_id", "load_no").collect()}
    assert got == {(3, "val_qtaim"), (4, "val_qtaim"), (2, "n_atoms"), (5, "n_atoms"), (6, "n_atoms"), (2, "total_time"), (3, "total_time"), (5, "total_time")}
    profile = masks.MaskProfile().profile(df, "val_id", "load_no").toPandas()
    assert len(profile) == 4 * 3 and profile.n_rows.sum() == 4 * 6
    assert masks.MaskProfile().violations(df.limit(0), "val_id", "load_no").count() == 0


def test_pack_round_trip(spark):
    long = "x" * 70_000
    rows = [
        (1, "/a/b", "f", "one"), (2, "\\a\\b\\", "f", "one"), (3, "/a/./c/../b//", "f", "one"), (4, "/a/b", "f", "two"), (5, "/a/b", "g", "one"), (6, "/a/b", "e", ""), (7, "/a/b", "e", None),
        (8, None, "f", "one"), (9, "/a/b", "long", long), (10, "//a/b", "e", ""), (11, "../x", "f", "é\r\n"), (12, "/../x", "f", "é\r\n"),
    ]
    df = spark.createDataFrame(rows, "file_id bigint, folder string, file_name string, content string")
    archive = packing.pack_files(df, block_bytes=1000)
    assert {r["file_id"] for r in archive.index.where("is_copy").collect()} == {2, 3, 10}
    back = {r["file_id"]: bytes(r["content"]).decode() for r in packing.unpack_files(archive).where("intact").collect()}
    assert back == {i: c or "" for i, _, _, c in rows}
    assert archive.blocks.count() > 1 and packing.pack_files(df.limit(0)).index.count() == 0


def test_components_against_union_find(spark):
    import random

    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            parent[find(a)] = find(b)
    least = {}
    for x in list(parent):
        least[find(x)] = min(least.get(find(x), x), x)
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {x: least[find(x)] for x in parent}


def test_hot_keys_are_all_looked_up(spark):
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    dim = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = skew_lookup(facts, dim, ["k"], "n", min_hot_rows=100)
    assert out.count() == 3000 and out.where("k = 0").select(F.max("n")).first()[0] == 1000


@pytest.mark.parametrize("q", [[0.0, 0.5, 1.0], [0.05, 0.25, 0.9]])
def test_quantiles_are_exact(spark, q):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.round(F.rand(5) * 1000, 1).alias("v")).withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(df, ["g"], "v", q).collect()}
    for g, frame in df.toPandas().groupby("g", dropna=False):
        assert got[None if pd.isna(g) else g] == pytest.approx(frame.v.quantile(q).tolist(), abs=1e-9)
    assert exact_quantiles(df.limit(0), ["g"], "v", q).count() == 0
