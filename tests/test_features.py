"""Feature operators on small rows."""

import pytest
from pyspark.sql import functions as F

from quarrystone.functions import keys
from quarrystone.operators import agreement, features, folders, joins, quantiles


def _one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("key, written, counted", [("2_H_to_1_C", (1, 0, "H", "C"), [1, 2]), ("1_C_to_1_C", (0, 0, "C", "C"), [1, 1]), ("1_C", None, None), ("x_C_to_1_H", None, None), ("0_C_to_1_H", None, None), (None, None, None)])
def test_pair_keys(spark, key, written, counted):
    got = _one(spark, keys.pair_as_written(F.col("k")), k=key)
    assert (got and tuple(got)) == written and _one(spark, keys.counted_pair(F.col("k")), k=key) == counted


def test_units_and_paths(spark):
    assert _one(spark, keys.without_units(F.col("t")), t=" (a.u.)  1.5 (a.u.)") == "1.5 (a.u.)"
    for path, to in (("/a/b/c", "/z/c"), ("/a/b", "/z"), ("/a/bc", "/a/bc"), (None, None)):
        assert _one(spark, folders.remapped(F.col("p"), "/a/b/", "/z"), p=path) == to


def test_maps(spark):
    df = spark.createDataFrame([({"a": "1", "b_bond": "2", "c": "3"}, {"s": {"1_C": 1.0, "2_H": 2.0, "3_C": 0.0}, "t": {}})], "m map<string,string>, s map<string,map<string,double>>")
    row = df.select(
        features.only_names(F.col("m"), ["a", "b"], "_bond").alias("some"), features.only_names(F.col("m"), None).alias("all"),
        features.enriched(F.col("m"), F.create_map(F.lit("x"), F.lit("9"), F.lit("y"), F.lit("8")), {"x": "x_orca", "y": "a", "z": "z_orca"}).alias("more"),
        features.enriched(F.lit(None).cast("map<string,string>"), F.create_map(F.lit("x"), F.lit("9")), {"x": "x_orca"}).alias("new"),
        keys.first_element_set(F.col("s"), ["u", "t", "s"]).alias("elements"), keys.first_element_set(F.col("s"), ["t"]).alias("none"),
    ).first()
    assert row["some"] == {"a": "1", "b_bond": "2"} and len(row["all"]) == 3 and row["more"] == {"a": "1", "b_bond": "2", "c": "3", "x_orca": "9"} and row["new"] == {"x_orca": "9"}
    assert row["elements"] == "C,H" and row["none"] is None


def test_vectors_are_whole_or_none(spark):
    rows = [(1, [3.0, 4.0, 0.0]), (2, [1.0, 2.0]), (3, [1.0, float("nan"), 0.0]), (4, None)]
    got = spark.createDataFrame(rows, "k int, v array<double>").select("k", *features.vector_features(F.col("v"), "d")).orderBy("k").collect()
    assert tuple(got[0]) == (1, 5.0, 3.0, 4.0, 0.0) and all(tuple(r)[1:] == (None,) * 4 for r in got[1:])


def test_vector_agreement_counts(spark):
    rows = [("g", [1.0, 0.0], [2.0, 0.0]), ("g", [1.0, 0.0], [0.0, 3.0]), ("g", [0.0, 0.0], [1.0, 1.0]), ("g", None, [1.0, 1.0])]
    got = agreement.vector_agreement(spark.createDataFrame(rows, "g string, a array<double>, b array<double>"), {"a": F.col("a"), "b": F.col("b")}, "g").first()
    assert got["n"] == 2 and got["n_lengths"] == 3 and got["cosine_p50"] == 0.5 and abs(got["cosine_p10"] - 0.1) < 1e-12


def test_conflicting_elements_drop_the_record(spark):
    rows = [("r", "a", 0, "C", 1.0), ("r", "b", 0, "C", 2.0), ("r", "a", 3, "H", None), ("q", "a", 0, "C", 1.0), ("q", "b", 0, "N", 1.0), ("q", "a", 1, "H", 1.0)]
    got = features.atoms_wide(spark.createDataFrame(rows, "k string, scheme string, i int, el string, value double"), ["k"], ["a", "b"]).orderBy("i").collect()
    assert [(r["k"], r["i"], r["a"], r["b"], r["n_atoms"]) for r in got] == [("r", 0, 1.0, 2.0, 4), ("r", 3, None, None, 4)]


def test_metals_on_both_sides(spark):
    rows = [(1, 0, 1, "FE", "CU", 0.5), (1, 0, 2, "FE", "C", 0.3), (1, 1, 2, "CU", "C", 0.2), (1, 2, 3, "C", "H", 0.9), (1, 0, 3, "FE", "H", float("nan"))]
    got = features.metal_neighbors(spark.createDataFrame(rows, "k int, i int, j int, el_i string, el_j string, value double"), ["k"]).collect()
    assert sorted((r["metal_el"], r["partner_el"]) for r in got) == [("CU", "FE"), ("FE", "C"), ("FE", "CU")]


def test_targets_and_unions(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "k int, a double, y double")
    x, y = features.select_targets(df, ["k"], ["a", "y"], ["y"])
    assert x.columns == ["k", "a"] and y.columns == ["k", "y"]
    with pytest.raises(ValueError, match="unknown target"):
        features.select_targets(df, ["k"], ["a"], ["z"])
    with pytest.raises(ValueError, match="another schema"):
        features.same_schema_union([df, df.withColumn("a", F.lit("x"))])
    assert features.same_schema_union([df, df]).count() == 2
    other = spark.createDataFrame([(1, 9.0, 9.0), (2, 8.0, 8.0), (2, 8.0, 8.0)], "k int, a double, y double")
    kept = features.union_keep_first([df.limit(0), df, other], ["k"]).orderBy("k").collect()
    assert [tuple(r) for r in kept] == [(1, 2.0, 3.0), (2, 8.0, 8.0)]


def test_top_rows_and_running_sums_of_one_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("g"), "id", F.pmod("id", F.lit(7)).cast("double").alias("s"))
    got = {(r["g"], r["id"], r["rank"]) for r in quantiles.top_rows(df, ["g"], "s", "id", 3).collect()}
    rows = [(r["g"], r["id"], r["s"]) for r in df.collect()]
    want = {(g, i, n + 1) for g in ("hot", "cold") for n, (_, i) in enumerate(sorted((-s, i) for h, i, s in rows if h == g)[:3])}
    assert got == want
    sums = {(r["g"], r["id"]): r["before"] for r in quantiles.with_running_sum(df, ["g"], [F.col("id")], F.col("s")).collect()}
    total = {"hot": 0, "cold": 0}
    for g, i, s in sorted(rows, key=lambda r: r[1]):
        assert sums[g, i] == total[g]
        total[g] += s
    assert quantiles.top_rows(df.limit(0), ["g"], "s", "id", 3).count() == 0


def test_exclusion_misses(spark):
    have, wanted = spark.createDataFrame([("a",), ("a",), ("b",)], "k string"), spark.createDataFrame([("l", "a"), ("l", "c"), ("m", "c"), ("l", "a")], "l string, k string")
    got = {r["l"]: (r["n_requested"], r["n_hit"], r["n_missed"]) for r in joins.exclusion_misses(have, wanted, ["k"], "l").collect()}
    assert got == {"l": (2, 1, 1), "m": (1, 0, 1)}


def test_reactions(spark, tmp_path):
    import json

    from quarrystone.plans import registry

    def graph(charge, sites, links):
        return {"molecule": {"charge": charge, "sites": [{"name": "C"}] * sites}, "graphs": {"adjacency": [[{"id": 0}] * links]}}

    payloads = [{"reactant_molecule_graph": graph(c, 2, 1), "product_molecule_graph": graph(p, 3, 2)} for c, p in ((1, -1), (3, None), (None, 2))] + [{"0": {"eig_hess": 1.0}}]
    rows = [(i, json.dumps(p), None) for i, p in enumerate(payloads)]
    spark.createDataFrame(rows, "rec_id bigint, payload string, loaded_at timestamp").write.parquet(f"{tmp_path}/nested_records.parquet")
    got = {r["rec_id"]: r for r in registry.queries()["reaction_rows"](spark, str(tmp_path)).collect()}
    assert {k: (r["reactant_charge"], r["product_charge"], r["n_imputed"]) for k, r in got.items()} == {0: (1.0, -1.0, 0), 1: (3.0, 0.5, 1), 2: (2.0, 2.0, 1)}
    assert (got[0]["reactant_sites"], got[0]["reactant_links"], got[0]["product_sites"], got[0]["product_links"]) == (2, 1, 3, 2)
