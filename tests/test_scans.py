"""Scans of job outputs and packed files."""

import gzip

import numpy as np
from pyspark.sql import functions as F

from quarrystone.operators import scans


def test_steps_and_timings(spark):
    log = "Completed a in 2.5 seconds\nCompleted b in 0 seconds\nCompleted a in 3.5 seconds\n"
    df = spark.createDataFrame([(log, {"c": 1.0}), ("", {"c": 1.0}), (None, None)], "log string, t map<string,double>")
    rows = df.select(scans.step_seconds(F.col("log")).alias("s"), scans.backfilled_timings(F.col("t"), scans.step_seconds(F.col("log")), ["a", "b", "c"]).alias("b")).collect()
    assert rows[0]["s"] == {"a": 3.5, "b": 0.0} and {k: tuple(v) for k, v in rows[0]["b"].items()} == {"a": (3.5, "log"), "b": (-1.0, "none"), "c": (1.0, "recorded")}
    assert rows[1]["s"] == {} and rows[2]["s"] is None and rows[2]["b"]["c"]["value"] == -1.0


def test_outputs(spark):
    df = spark.createDataFrame([("menu done menu",), ("menu done",), ("error menu done menu",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(scans.output_is_sound(F.col("c"), "done", "menu", ["error"])).collect()] == [True, False, False, False, False]
    assert spark.range(1).select(scans.last_value(F.lit("E = -1.5\nE = -2.5"), r"E = (-?[0-9.]+)")).first()[0] == -2.5


def test_packed_files(spark):
    df = spark.createDataFrame([("a.gz", gzip.compress(b"x")), ("b.gz", b"no"), ("c.xz", b""), ("d.gz", gzip.compress(b"")), (None, None)], "n string, c binary")
    assert [r[0] for r in df.select(scans.packed_status("n", "c")).collect()] == ["ok", "broken", "empty", "empty", "empty"]


def test_ranks_and_projection(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, None), (3, [2.0, 4.0, 6.0])], "id bigint, v array<double>")
    got = {r["id"]: r["v"] for r in scans.random_projection(df, "v", 3, 2, 5).collect()}
    assert got[2] is None and np.allclose(np.array(got[1]) * 2, got[3], atol=1e-5)
    a = [r[0] for r in df.select(scans.salted_rank(F.col("id").cast("string"), F.lit("s"))).collect()]
    assert len(set(a)) == 3 and a == [r[0] for r in df.repartition(3).orderBy("id").select(scans.salted_rank(F.col("id").cast("string"), F.lit("s"))).collect()]
