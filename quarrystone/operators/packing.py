"""Small files packed into indexed archive blocks.

Each different file (folder, name, bytes) is stored once, its original bytes
one after another inside a block of a few tens of megabytes; an index row per
*input* row says in which block, at which offset and with which length and
checksum its bytes lie. Copies point at the bytes of the row that was kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.operators.skew import skew_lookup
from quarrystone.session import materialize

BLOCK_SCHEMA = (
    "block_id string, block_bytes bigint, n_files int, block binary, "
    "members array<struct<file_id:bigint,key:string,folder:string,file_name:string,offset:bigint,length:bigint,crc32:bigint>>"
)
_MEMBER = pa.struct([("file_id", pa.int64()), ("key", pa.string()), ("folder", pa.string()), ("file_name", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("crc32", pa.int64())])
_BLOCK = pa.schema([("block_id", pa.string()), ("block_bytes", pa.int64()), ("n_files", pa.int32()), ("block", pa.binary()), ("members", pa.list_(_MEMBER))])


def normal_folder(path: Column) -> Column:
    """One spelling per folder.

    Backslashes read as slashes, empty and ``.`` parts dropped, ``..`` takes
    back the part before it (at the root it is dropped, at the start of a
    relative path it stays). Null stays null; the root is ``/``.
    """
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    absolute = F.startswith(slashed, F.lit("/"))
    parts = F.filter(F.split(slashed, "/"), lambda p: (p != "") & (p != "."))
    empty = F.array().cast("array<string>")

    def step(done: Column, part: Column) -> Column:
        climbs = part == ".."
        can_drop = (F.size(done) > 0) & (F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")) != "..")
        return (
            F.when(climbs & can_drop, F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .when(climbs & absolute, done)
            .otherwise(F.concat(done, F.array(part)))
        )

    return F.concat(F.when(absolute, F.lit("/")).otherwise(F.lit("")), F.array_join(F.aggregate(parts, empty, step), "/"))


def _pack(target: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        chunks: list[bytes] = []
        members: list[dict] = []
        offset = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"block_id": f"{part:06d}-{serial:05d}", "block_bytes": offset, "n_files": len(members), "block": b"".join(chunks), "members": members}], schema=_BLOCK
            )

        for batch in batches:
            names, folders, ids, keys = (batch.column(c).to_pylist() for c in ("file_name", "folder", "file_id", "_key"))
            for i, data in enumerate(batch.column("content").to_pylist()):
                data = data or b""
                if members and offset + len(data) > target:
                    yield flush()
                    serial, chunks, members, offset = serial + 1, [], [], 0
                members.append({"file_id": ids[i], "key": keys[i], "folder": folders[i], "file_name": names[i], "offset": offset, "length": len(data), "crc32": zlib.crc32(data)})
                chunks.append(data)
                offset += len(data)
        if members:
            yield flush()

    return run


@dataclass
class Archive:
    """``blocks``: the stored bytes; ``index``: a row per input row."""

    blocks: DataFrame
    index: DataFrame


def pack_files(files: DataFrame, file_id: str = "file_id", folder: str = "folder", file_name: str = "file_name", content: str = "content", block_bytes: int = 32 << 20) -> Archive:
    """Pack ``files`` so that each different file is stored once.

    Files are the same when their normalised folder, name and bytes are equal;
    the smallest ``file_id`` of them owns the stored bytes. Null folder, name
    or content count as values of their own (equal to other nulls, unlike the
    empty string) and null content is stored with length 0. Rows with a null
    id are packed like others but never found by id. A file larger than
    ``block_bytes`` has a block to itself. Empty input gives empty tables.

    The contents move once, range-partitioned by folder so that the files of
    a folder lie together; copies are found over digests only, grouped with
    map-side aggregation, so a file that makes up a third of the rows costs no
    more than any other.
    """
    keyed = _keyed(files.select(F.col(file_id).alias("file_id"), F.col(folder).alias("folder"), F.col(file_name).alias("file_name"), F.col(content).alias("content")))
    rows = keyed.select("file_id", "_key")
    groups = materialize(rows.groupBy("_key").agg(F.min("file_id").alias("kept_id"), F.count(F.lit(1)).alias("_rows")), "pack-groups")
    owners = groups.where(F.col("kept_id").isNotNull()).select("_key", F.col("kept_id").alias("file_id"))
    without = keyed.where(F.col("file_id").isNull()).dropDuplicates(["_key"]).join(groups.where(F.col("kept_id").isNull()), "_key", "left_semi")
    kept = keyed.join(owners, ["file_id", "_key"], "left_semi").dropDuplicates(["file_id", "_key"]).unionByName(without)
    blocks = materialize(
        kept.select("file_id", "_key", "folder", "file_name", "content").repartitionByRange("folder", "file_name", "file_id").sortWithinPartitions("folder", "file_name", "file_id").mapInArrow(_pack(block_bytes), BLOCK_SCHEMA),
        "pack-blocks",
    )
    placed = blocks.select("block_id", F.explode("members").alias("m")).select(
        F.col("m.key").alias("_key"), "block_id", "m.folder", "m.file_name", "m.offset", "m.length", "m.crc32"
    )
    index = skew_lookup(rows, materialize(placed.join(groups, "_key"), "pack-places"), ["_key"], "_rows").select(
        "file_id", "kept_id", (F.col("file_id") != F.col("kept_id")).alias("is_copy"), "block_id", "folder", "file_name", "offset", "length", "crc32"
    )
    return Archive(blocks, index)


def _keyed(files: DataFrame) -> DataFrame:
    """The files with normalised folder, bytes and ``_key``, which the same files share; further columns stay."""
    data = F.col("content").cast("binary")
    digest = F.coalesce(F.sha2(data, 256), F.lit("null"))
    rows = files.withColumns({"file_id": F.col("file_id").cast("bigint"), "folder": normal_folder(F.col("folder")), "content": data, "_digest": digest})
    return rows.withColumn("_key", F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null")) for c in ("folder", "file_name", "_digest")]), 256)).drop("_digest")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files of each block, cut from its bytes."""
    for batch in batches:
        for block_id, block, members in zip(batch.column("block_id"), batch.column("block"), batch.column("members").to_pylist()):
            data, full = memoryview(block.as_buffer()), [m for m in members if m["length"] > 0]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block_id.as_py()] * len(full), pa.string()), pa.array([m["offset"] for m in full], pa.int64()), pa.array([m["length"] for m in full], pa.int64()),
                    pa.array([bytes(data[m["offset"] : m["offset"] + m["length"]]) for m in full], pa.binary()),
                ],
                names=["block_id", "offset", "length", "_found"],
            )


def unpack_files(archive: Archive) -> DataFrame:
    """Every input row with its bytes again: (file_id, folder, file_name, content, intact)."""
    # empty files lie where the next one begins, so they are not looked up
    stored = archive.blocks.select("block_id", "block", "members").mapInArrow(_slices, "block_id string, offset bigint, length bigint, _found binary")
    place = ["block_id", "offset", "length"]
    copies = archive.index.groupBy(*place).agg(F.count(F.lit(1)).alias("_rows"))
    rows = skew_lookup(archive.index, materialize(stored.join(copies, place), "pack-found"), place, "_rows", "left").withColumn("content", F.coalesce("_found", F.lit("").cast("binary")))
    return rows.select("file_id", "folder", "file_name", "content", (F.crc32("content") == F.col("crc32")).alias("intact"))


def write_archive(archive: Archive, root: str, mode: str = "errorifexists") -> int:
    """Blocks and index under ``root``, the index ordered by folder and name; how many rows the index has.

    Raises where the stored blocks do not hold every different file just once.
    """
    archive.blocks.write.mode(mode).parquet(f"{root}/blocks")
    archive.index.repartitionByRange("folder", "file_name").sortWithinPartitions("folder", "file_name").write.mode(mode).parquet(f"{root}/index")
    stored = read_archive(archive.blocks.sparkSession, root)
    held = stored.blocks.agg(F.coalesce(F.sum("n_files"), F.lit(0))).first()[0]
    rows, different = stored.index.agg(F.count(F.lit(1)), F.count_distinct(F.struct("block_id", "offset", "length", "folder", "file_name", "crc32"))).first()
    if held != different:
        raise ValueError(f"{root}: {held} files stored, {different} indexed")
    return rows


def read_archive(spark: SparkSession, root: str) -> Archive:
    """An archive that ``write_archive`` wrote."""
    return Archive(spark.read.parquet(f"{root}/blocks"), spark.read.parquet(f"{root}/index"))


def read_files(archive: Archive, wanted: DataFrame) -> DataFrame:
    """(folder, file_name, content, intact) of the wanted (folder, file_name), however the folder is spelled; every version of a name.

    Only blocks that hold a wanted file are read into tasks; names the index
    lacks are left out.
    """
    names = wanted.select(normal_folder(F.col("folder")).alias("folder"), "file_name").distinct()
    index = archive.index.join(names, ["folder", "file_name"], "left_semi").drop("file_id", "kept_id", "is_copy").distinct()
    blocks = archive.blocks.join(index.select("block_id").distinct(), "block_id", "left_semi")
    return unpack_files(Archive(blocks, index.withColumn("file_id", F.lit(None).cast("bigint")))).drop("file_id")


def compare_with_scans(archive_index: DataFrame, files: DataFrame, scans: DataFrame) -> DataFrame:
    """Packed files and bytes of each subroot beside its latest good scan.

    A scan is good if its status is ``ok`` and total_files is known; of several
    the latest counts. A file of which no row has an id counts for the least of its
    subroots. Subroots without a good scan have null totals, scanned
    ones without files count 0.
    """
    with_id = (
        archive_index.where(~F.col("is_copy"))
        .select("file_id", "length")
        .join(files.select(F.col("file_id").cast("bigint").alias("file_id"), normal_folder(F.col("subroot")).alias("subroot")), "file_id")
        .select("subroot", "length")
    )
    keyed = _keyed(files)
    size = F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint")
    without_id = (
        keyed.where(F.col("file_id").isNull())
        .groupBy("_key")
        .agg(F.min(normal_folder(F.col("subroot"))).alias("subroot"), F.first(size).alias("length"))
        .join(keyed.where(F.col("file_id").isNotNull()).select("_key").distinct(), "_key", "left_anti")
        .select("subroot", "length")
    )
    packed = with_id.unionByName(without_id).groupBy("subroot").agg(F.count(F.lit(1)).alias("packed_files"), F.sum("length").alias("packed_bytes"))
    good = (
        scans.where((F.lower(F.trim("status")) == "ok") & F.col("total_files").isNotNull())
        .groupBy(normal_folder(F.col("subroot")).alias("subroot"))
        .agg(F.max_by(F.struct("total_files", "total_bytes"), F.struct("scanned_at", "total_files", "total_bytes")).alias("s"))
        .select("subroot", "s.total_files", "s.total_bytes")
    )
    return packed.join(good, "subroot", "full_outer").select(
        "subroot",
        F.coalesce("packed_files", F.lit(0)).cast("bigint").alias("packed_files"),
        F.coalesce("packed_bytes", F.lit(0)).cast("bigint").alias("packed_bytes"),
        "total_files",
        "total_bytes",
        (F.coalesce("packed_files", F.lit(0)) - F.col("total_files")).alias("files_off"),
    )
