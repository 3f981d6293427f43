"""Packed files of which no row has an id."""

from quarrystone.operators import packing


def test_files_without_id_are_packed(spark):
    rows = [
        (1, "/a", "f", "one", "/s"), (None, "/a/", "f", "one", "/s"), (None, "/a", "g", "two", "/s"), (None, "\\a", "g", "two", "/r"), (None, "/a", "h", None, "/s"), (None, "/b", "h", "", "/s"),
        (2, "/b", "f", "three", "/s"),
    ]
    df = spark.createDataFrame(rows, "file_id bigint, folder string, file_name string, content string, subroot string")
    archive = packing.pack_files(df)
    back = [(r["file_id"], r["folder"], r["file_name"], bytes(r["content"]).decode()) for r in packing.unpack_files(archive).where("intact").collect()]
    want = [(i, "/b" if "b" in folder else "/a", name, content or "") for i, folder, name, content, _ in rows]
    assert sorted(back, key=str) == sorted(want, key=str)
    assert sum(r["n_files"] for r in archive.blocks.collect()) == 5  # each different file once
    scans = spark.createDataFrame([("/s", "ok", 4, 11, 1)], "subroot string, status string, total_files bigint, total_bytes bigint, scanned_at int")
    got = {r["subroot"]: (r["packed_files"], r["packed_bytes"], r["files_off"]) for r in packing.compare_with_scans(archive.index, df, scans).collect()}
    assert got == {"/s": (4, 8, 0), "/r": (1, 3, None)}


def test_archive_on_disk(spark, tmp_path):
    rows = [(i, f"/a/{i % 3}", f"f{i % 5}", b"x" * (i % 7)) for i in range(60)] + [(100, "/hot", "same", b"copy")] * 1 + [(200 + i, "\\hot\\", "same", b"copy") for i in range(40)]
    files = spark.createDataFrame(rows, "file_id bigint, folder string, file_name string, content binary")
    root = str(tmp_path / "archive")
    assert packing.write_archive(packing.pack_files(files, block_bytes=64), root) == len(rows)
    archive = packing.read_archive(spark, root)
    back = packing.unpack_files(archive).collect()
    assert all(r["intact"] for r in back) and sorted((r["file_id"], bytes(r["content"])) for r in back) == sorted((r[0], r[3]) for r in rows)
    one = packing.read_files(archive, spark.createDataFrame([("//hot/", "same"), ("/none", "x")], "folder string, file_name string")).collect()
    assert [(r["folder"], bytes(r["content"]), r["intact"]) for r in one] == [("/hot", b"copy", True)]
