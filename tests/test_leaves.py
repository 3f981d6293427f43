"""Leaves of JSON objects of any depth."""

from quarrystone.operators import reshape


def test_deep_leaves(spark):
    rows = [(1, '{"a": {"b": {"c": {"d": {"e": {"f": 6}}, "x": true}, "y": 3}}, "z": -1.5, "t": "7x", "l": [1]}'), (2, '{"k": 1}'), (3, "[]"), (4, None), (5, '{"a": {"b": 1, "b": 2}}')]
    got = {tuple(r) for r in reshape.flat_leaves(spark.createDataFrame(rows, "id int, j string"), "j", ["id"]).collect()}
    assert got == {(1, "a.b.c.d.e.f", 6.0), (1, "a.b.y", 3.0), (1, "z", -1.5), (2, "k", 1.0), (5, "a.b", 2.0)}
