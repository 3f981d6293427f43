"""Nested records against what is written in them."""

import json

from quarrystone.operators import flatten


def _children(spark, *payloads):
    rows = spark.createDataFrame([(i, p, None) for i, p in enumerate(payloads)], "rec_id bigint, payload string, loaded_at timestamp")
    return {(r["rec_id"], r["child"], r["child_key"]): r["value"] for r in flatten.flatten_records(rows).collect()}


def test_only_numbers_are_eigenvalues(spark):
    point = {"pos_ang": [0, 1, 2], "eig_hess": [1, "12 eV", -2.5, "2.5", None, True, 12345678901234567890123, 1e-3]}
    got = _children(spark, json.dumps({"0": point, "0_1": {"eig_hess": 4.5}, "2": {"eig_hess": "4.5"}, "3": {"eig_hess": {"a": 1}}, "4": {"eig_hess": []}, "5": None}))
    assert {k[2]: v for k, v in got.items() if k[1] == "eig"} == {"0/0": 1.0, "0/2": -2.5, "0/6": 12345678901234567890123.0, "0/7": 1e-3, "0_1/0": 4.5}
    assert sorted(k[2] for k in got if k[1] == "cp") == ["0", "0_1", "2", "3", "4"]


def test_every_record_of_a_list_is_read(spark):
    a, b = {"0": {"eig_hess": [1.0]}}, {"qtaim": {"0": {"eig_hess": [2.0, 3.0]}}, "n": 1}
    got = _children(spark, json.dumps([a, b]), json.dumps([a]), "[]", "[1, 2]", "{", None, "")
    assert {k: v for k, v in got.items() if k[1] == "eig"} == {(0, "eig", "0/0"): 1.0, (0, "eig", "1:0/0"): 2.0, (0, "eig", "1:0/1"): 3.0, (1, "eig", "0/0"): 1.0}


def test_the_same_payload_whatever_the_order(spark):
    first, second = json.dumps({"0": {"eig_hess": 1.0}}), json.dumps({"0": {"eig_hess": 1.0}, "x": 2}, indent=1)
    rows = [(7, first, None), (7, second, None), (7, None, None)]
    both = [spark.createDataFrame(r, "rec_id bigint, payload string, loaded_at timestamp") for r in (rows, rows[::-1])]
    assert [flatten.parse_records(b).collect() for b in both][0] == flatten.parse_records(both[1]).collect()
