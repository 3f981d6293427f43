"""Folder queries against plain Python over every row, however its folder is written."""

import pytest

from quarrystone.plans import registry

NEEDED = ["charge.json", "bond.json", "qtaim.json", "timings.json"]
EXTRA = [
    ("/scratch/omega/v-1/set.0/job", "charge.json", 5), ("\\scratch\\omega\\v-1\\set.0\\job\\", "bond.json", 5), ("/scratch/omega/v-1/set.0/x/../job", "qtaim.json", 5),
    ("//scratch/omega//v-1/./set.0/job/", "timings.json", 5), ("/scratch/omega/v-1/set.0/", "charge.json", 0), ("/", "bond.json", 1), ("rel/a/b", "bond.json", 1), ("rel/a", "bond.json", 1), (None, "bond.json", 1),
]


def _normal(path):
    if path is None:
        return None
    path, done = path.replace("\\", "/"), []
    for p in path.split("/"):
        if p == ".." and done and done[-1] != "..":
            done.pop()
        elif p not in ("", ".") and not (p == ".." and path.startswith("/")):
            done.append(p)
    return "/" * path.startswith("/") + "/".join(done)


@pytest.fixture(scope="module")
def job_files(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    real = spark.read.parquet("/root/testdata/sf0.01/job_files.parquet").select("folder", "file_name", "n_bytes")
    real.unionByName(spark.createDataFrame(EXTRA, "folder string, file_name string, n_bytes bigint")).write.parquet(f"{folder}/job_files.parquet")
    rows = spark.read.parquet(f"{folder}/job_files.parquet").collect()
    return folder, [(_normal(r["folder"]), r["file_name"], r["n_bytes"]) for r in rows]


def test_completeness_counts_every_file(spark, job_files):
    folder, rows = job_files
    have = {}
    for f, name, n in rows:
        have.setdefault(f, set()).update([name] if n and n > 0 else [])
    missing = {f: [x for x in NEEDED if x not in h] for f, h in have.items()}
    got = {r["folder"]: (r["n_needed"], r["missing"], r["complete"]) for r in registry.queries()["folder_completeness"](spark, folder).collect()}
    assert got == {f: (4 - len(m), ",".join(m), not m) for f, m in missing.items()}
    assert got["/scratch/omega/v-1/set.0/job"] == (4, "", True)


def test_leaves_of_all_folders(spark, job_files):
    folder, rows = job_files
    own = {f for f, _, _ in rows if f is not None}
    leaves = {f for f in own if not any(o != f and o.startswith(f.rstrip("/") + "/") for o in own)}
    got = [r["folder"] for r in registry.queries()["leaf_folders"](spark, folder).collect()]
    assert sorted(got) == sorted(leaves)


def test_keys_of_all_folders(spark, job_files):
    folder, rows = job_files
    keys = {f.removeprefix("/scratch/omega/").removeprefix("/").replace("/", "__") for f, _, _ in rows if f is not None}
    got = [r["key"] for r in registry.queries()["key_normalise"](spark, folder).collect()]
    assert sorted(got) == sorted(keys)
