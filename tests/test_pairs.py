"""Cosines of the queries with every other vector against numpy."""

import numpy as np

from quarrystone.operators import joins
from quarrystone.plans import registry
from tests.compare import DATA


def test_cosines_with_all_vectors(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()
    unit = {r["vec_id"]: np.asarray(r["embedding"], float) / np.linalg.norm(np.asarray(r["embedding"], float)) for r in rows}
    want = {frozenset((a, b)): float(unit[a] @ unit[b]) for a in unit if a % 50 == 0 for b in unit if a != b}
    got = registry.queries()["cosine_pairs"](spark, DATA).collect()
    assert len(got) == len(want) and all(r["a"] % 50 == 0 for r in got)
    assert {frozenset((r["a"], r["b"])) for r in got} == set(want)
    assert all(abs(r["cosine"] - want[frozenset((r["a"], r["b"]))]) < 2e-6 for r in got)


def test_blocks_lose_nothing(spark):
    a, b = spark.range(25).withColumnRenamed("id", "a"), spark.range(40).withColumnRenamed("id", "b")
    got = [(r["a"], r["b"]) for r in joins.in_blocks(a, b, "a", a["a"] != b["b"], block_rows=4).collect()]
    assert sorted(got) == [(i, j) for i in range(25) for j in range(40) if i != j]
