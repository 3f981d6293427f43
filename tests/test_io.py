"""Stores, text, writers, streaming and small functions."""

import io
import tarfile

import pytest
from pyspark.sql import functions as F

from quarrystone.functions import keys, numbers
from quarrystone.operators import joins, quality, records, reshape, scaling
from quarrystone.sinks import writers
from quarrystone.sources import geometry, stores
from quarrystone.streaming import incremental

TEXT = "! wtb\n*xyz -1 2\nO 0.0 0.0 0.1\nH 0.0 0.8 -0.4\nh bad\nH 0.0 -0.8 -0.4\n*\n"


def test_store_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", "k1", 1), ("b", "k2", 2), ("b", "length", 3), ("b", "ké", 4)], "vertical string, key string, n int")
    root = f"file://{tmp_path}/corpus"
    writers.write_store(rows, root, "structure")
    assert stores.discover_verticals(spark, root) == ["a", "b"]
    assert {r["key"] for r in stores.open_store(spark, root, "structure").collect()} == {"k1", "k2"}
    assert stores.open_store(spark, root, "structure", ["b"]).count() == 1
    with pytest.raises(ValueError):
        stores.open_store(spark, root, "nothing")
    with pytest.raises(FileNotFoundError):
        stores.open_store(spark, root, "charge")


def test_geometry_text(spark):
    df = spark.createDataFrame([(TEXT,), ("no block",), (None,)], "t string").select(geometry.parse_input(F.col("t")).alias("p"))
    got = [r["p"] for r in df.collect()]
    assert (got[0]["charge"], got[0]["spin"], [a["elem"] for a in got[0]["molecule"]]) == (-1, 2, ["O", "H", "H"]) and got[1] is None and got[2] is None
    back = df.where("p is not null").select(geometry.parse_xyz(geometry.write_xyz(F.col("p.molecule"), F.lit("c"))).alias("x"), geometry.parse_input(geometry.write_input(F.col("p.molecule"), F.col("p.charge"), F.col("p.spin"), "k")).alias("i")).first()
    assert back["x"]["n_atoms"] == 3 and back["x"]["molecule"] == got[0]["molecule"] and back["i"] == got[0]
    f = df.where("p is not null").select(records.hill_formula(F.col("p.molecule")), records.alphabetical_formula(F.col("p.molecule")), records.compact_formula(F.col("p.molecule"))).first()
    assert tuple(f) == ("H2O", "H2 O1", "H2O1")


def test_archives(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as tar:
        data = b"1\nc\nH 0 0 0\n"
        info = tarfile.TarInfo("m.xyz")
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))
    spark.dataSource.register(geometry.XyzArchives)
    row = spark.read.format("molecule_archives").option("path", f"{tmp_path}/*.tar.gz").load().first()
    assert row["name"] == "m.xyz" and row["content"].startswith("1\n")


def test_incremental_ingest(spark, tmp_path):
    src, sink, ckpt = (f"file://{tmp_path}/{n}" for n in ("src", "sink", "ckpt"))
    for start in (0, 5):
        spark.range(start, start + 10).withColumnRenamed("id", "key").write.mode("append").parquet(src)
        incremental.ingest_new_files(spark, src, sink, ckpt, "key").awaitTermination(60)
    assert sorted(r["key"] for r in spark.read.parquet(sink).collect()) == list(range(15))


def test_keys(spark):
    df = spark.createDataFrame([("1_C_to_3_H",), ("3_O_to_1_H",), ("x_C_to_1_H",), ("1_C",), (None,), ("0_C_to_1_H",)], "k string").select(keys.pair_parts(F.col("k")).alias("p"))
    got = [None if r["p"] is None else tuple(r["p"]) for r in df.collect()]
    assert got == [(0, 2, "C", "H"), (0, 2, "H", "O"), None, None, None, None]


def test_numbers(spark):
    df = spark.createDataFrame([("1.0D-3",), ("***",), ("-1.5+120",), (" 2 ",), (None,)], "t string")
    assert [r[0] for r in df.select(numbers.overflow_number(F.col("t"))).collect()] == [1e-3, None, -1e10, 2.0, None]
    one = spark.range(1).select(numbers.glued_numbers(F.lit("a 0.12-3.4 5E+2 a.u.")), numbers.run_seconds(F.lit("0 days 1 hours 2 minutes 3 seconds 500 msec")), numbers.run_seconds(F.lit("none")))
    assert tuple(one.first()) == ([0.12, -3.4, 500.0], 3723.5, None)


def test_point_matching(spark):
    rows = [("r", "atom", 0, "C", 0.0), ("r", "atom", 1, "C", 1.0), ("r", "atom", 2, "H", 2.0), ("r", "point", 0, "C", 0.9), ("r", "point", 1, "C", 0.95), ("r", "point", 5, "H", 2.1), ("r", "point", 6, "H", 2.1)]
    df = spark.createDataFrame([(*r, 0.0, 0.0) for r in rows], "record string, kind string, n int, el string, x double, y double, z double")
    got = df.groupBy("record").applyInPandas(reshape.match_points(["record"], 1.0), "record string, point int, atom int, dist double").collect()
    assert [(r["point"], r["atom"]) for r in sorted(got, key=lambda r: r["point"])] == [(0, 0), (1, 1), (5, 2), (6, None)]


def test_json_repair(spark):
    df = spark.createDataFrame([('{"a": 1}', None), ('x {"b": "}"} y', None), ("bad", '{"c": 1}'), (None, None)], "c string, s string")
    assert [r[0] for r in df.select(reshape.repaired_json(F.col("c"), F.col("s"))).collect()] == ['{"a": 1}', '{"b": "}"}', '{"c": 1}', None]


def test_guards(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 1.0, float("nan"))], "key string, x double, y double")
    with pytest.raises(ValueError):
        scaling.check_scalers(scaling.merge_partials(scaling.fit_partial(df, ["x"])))
    with pytest.raises(ValueError):
        quality.filter_records(df, df.select("key"), "key")
    with pytest.raises(ValueError):
        joins.left_by_key(df, {}, "key", "impute")
    filled = scaling.impute(df, ["x", "y"], "median").collect()
    assert [(r["y"], r["n_imputed"]) for r in filled] == [(-1.0, 1), (-1.0, 1)]
    assert scaling.impute(df, ["x", "y"], "drop").count() == 0


def test_splits_holdouts_and_vectors(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = spark.createDataFrame([("a", "k1", "train"), ("b", "k2", "train"), ("c", "k3", "test")], "vertical string, key string, split string")
    writers.write_splits(rows, f"{root}/splits")
    assert [r["key"] for r in stores.read_split(spark, f"{root}/splits", "train", ["b"]).collect()] == ["k2"]
    assert stores.split_verticals(spark, f"{root}/splits") == ["a", "b", "c"]
    index = writers.write_holdouts({"h1": rows.where("vertical = 'a'"), "h2": rows.where("vertical <> 'a'").drop("split")}, f"{root}/holdouts")
    assert {r["holdout_id"]: r["n_records"] for r in index.collect()} == {"h1": 1, "h2": 2}
    got = stores.read_holdouts(spark, f"{root}/holdouts").collect()
    assert sorted((r["holdout_id"], r["key"], r["split"]) for r in got) == [("h1", "k1", "train"), ("h2", "k2", None), ("h2", "k3", None)]
    vectors = spark.createDataFrame([("x", "own", [1.0]), ("y", "far", [2.0]), ("z", None, [3.0])], "key string, source string, vector array<double>")
    writers.write_vectors(vectors, f"{root}/v", {"width": "1"})
    assert spark.read.parquet(f"{root}/v").schema["vector"].metadata == {"width": "1"}
    assert [r["key"] for r in stores.read_vectors(spark, f"{root}/v", "own", ("own",)).collect()] == ["x"]
    assert sorted(r["key"] for r in stores.read_vectors(spark, f"{root}/v", "others", ("own",)).collect()) == ["y", "z"]
    assert stores.read_vectors(spark, f"{root}/v", keep=vectors.where("key = 'y'")).count() == 1
    near = spark.createDataFrame([("a", "p", "FE", "C", 1)], "vertical string, rel_path string, tm string, partner string, n int")
    near.write.csv(f"{root}/lists/tm.csv", header=True)
    assert stores.read_neighbors(spark, f"{root}/lists", "tm", "tm").first()["pair"] == "FE-C"
    with pytest.raises(FileNotFoundError):
        stores.read_neighbors(spark, f"{root}/lists", "ln", "ln")


def test_manifest_exclusions_and_folder_lists(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = spark.createDataFrame([("v", "a", "ok"), ("v", "b", "missing_structure")], "vertical string, rel_path string, read_status string")
    assert writers.write_manifest(rows, root) and not writers.write_manifest(rows, root) and writers.write_manifest(rows, root, overwrite=True)
    assert [r["rel_path"] for r in stores.read_manifest(spark, f"{root}/manifest").collect()] == ["a"]
    spark.createDataFrame([("v", "k"), ("v", "k")], "vertical string, key string").write.parquet(f"{root}/out")
    assert stores.read_exclusions(spark, f"{root}/out").count() == 1
    with pytest.raises(ValueError):
        stores.read_exclusions(spark, f"{root}/manifest")
    (tmp_path / "list.txt").write_text("# jobs\n\n /a/b \n#x\n/c\n")
    assert sorted(r["folder"] for r in stores.read_folder_list(spark, f"{root}/list.txt").collect()) == ["/a/b", "/c"]
    (tmp_path / "none.txt").write_text("# nothing\n")
    with pytest.raises(ValueError):
        stores.read_folder_list(spark, f"{root}/none.txt")
    merged = writers.merge_archives(spark.createDataFrame([("x", "old"), ("y", "longer")], "name string, content string"), spark.createDataFrame([("x", "new"), ("y", "s"), ("z", "z")], "name string, content string"))
    assert {r["name"]: r["content"] for r in merged.collect()} == {"x": "old", "y": "longer", "z": "z"}


def test_components_of_one_hub_and_a_chain(spark):
    from quarrystone.operators import components, skew

    edges = [(1000, i) for i in range(2000, 2300)] + [(i, i + 1) for i in range(300)] + [(7000, 7000), (None, 3)]
    least = skew.MAX_HOT_KEYS
    roots = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert roots == {i: 0 for i in range(301)} | {i: 1000 for i in [1000, *range(2000, 2300)]} and least == 256
