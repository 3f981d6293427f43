"""Typed record stores of a corpus: one Parquet folder per record type, partitioned by vertical."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.functions.keys import is_record_key

#: The record types of a corpus.
STORE_TYPES = ("structure", "charge", "qtaim", "bond", "fuzzy", "other", "orca", "timings")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _children(spark: SparkSession, path: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return sorted(s.getPath().getName() for s in found if s.isDirectory())


def store_path(spark: SparkSession, root: str, kind: str) -> str | None:
    """The store of a type: its own name first, then ``merged_<type>`` and ``merged/<type>``."""
    if kind not in STORE_TYPES:
        raise ValueError(f"unknown record type {kind!r}")
    return next((p for p in (f"{root}/{kind}", f"{root}/merged_{kind}", f"{root}/merged/{kind}") if _exists(spark, p)), None)


def open_store(spark: SparkSession, root: str, kind: str, verticals: list[str] | None = None) -> DataFrame:
    """Records of one type, of some verticals if named (pruned as partitions); sentinel keys are left out."""
    path = store_path(spark, root, kind)
    if path is None:
        raise FileNotFoundError(f"{root}: no {kind} store")
    rows = spark.read.parquet(path).where(is_record_key(F.col("key")))
    return rows if verticals is None else rows.where(F.col("vertical").isin(verticals))


def discover_verticals(spark: SparkSession, root: str, skip: tuple[str, ...] = ()) -> list[str]:
    """Names of the verticals, sorted: partitions of the structure store, or folders that have a store of their own."""
    path = store_path(spark, root, "structure")
    if path is not None:
        names = [n.removeprefix("vertical=") for n in _children(spark, path) if n.startswith("vertical=")]
    else:
        names = [n for n in _children(spark, root) if store_path(spark, f"{root}/{n}", "structure")]
    return sorted(n for n in names if n not in skip)


def read_folder_list(spark: SparkSession, path: str) -> DataFrame:
    """(folder): lines of a list without blanks and ``#`` comments; raises if none is left."""
    lines = spark.read.text(path).select(F.trim("value").alias("folder")).where((F.col("folder") != "") & ~F.col("folder").startswith("#"))
    if lines.isEmpty():
        raise ValueError(f"{path}: no folders")
    return lines


def read_job_json(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(path, content, modified_at): every file called ``name`` under ``root``, whole."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(root)
    return files.select("path", F.decode("content", "UTF-8").alias("content"), F.col("modificationTime").alias("modified_at"))


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The rows of a manifest that were read well."""
    return spark.read.parquet(root).where(F.col("read_status") == "ok")


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """(vertical, key) of records to leave out; raises if a column is missing."""
    rows = spark.read.parquet(path)
    missing = {"vertical", "key"} - set(rows.columns)
    if missing:
        raise ValueError(f"{path}: no column {', '.join(sorted(missing))}")
    return rows.select("vertical", "key").distinct()


def read_split(spark: SparkSession, root: str, split: str, verticals: list[str] | None = None) -> DataFrame:
    """Records of one split, of some verticals if named (both pruned as partitions)."""
    rows = spark.read.parquet(root).where(F.col("split") == split)
    return rows if verticals is None else rows.where(F.col("vertical").isin(verticals))


def split_verticals(spark: SparkSession, root: str) -> list[str]:
    """Verticals that some split of a split store has, sorted."""
    splits = [n for n in _children(spark, root) if n.startswith("split=")]
    return sorted({v.removeprefix("vertical=") for s in splits for v in _children(spark, f"{root}/{s}") if v.startswith("vertical=")})


def read_holdouts(spark: SparkSession, root: str) -> DataFrame:
    """All holdouts the index of ``root`` names, each row with its ``holdout_id``; columns one of them lacks are null there."""
    names = [r["holdout_id"] for r in spark.read.csv(f"{root}/INDEX", header=True).orderBy("holdout_id").collect()]  # a row per holdout
    if not names:
        raise ValueError(f"{root}: no holdouts")
    parts = [spark.read.csv(f"{root}/{n}", header=True).withColumn("holdout_id", F.lit(n)) for n in names]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_neighbors(spark: SparkSession, root: str, kind: str, metal: str) -> DataFrame:
    """(vertical, rel_path, metal, partner, pair) of a neighbour list, ``merged/`` first, Parquet or CSV.

    ``metal`` is the class-specific name of the list's metal column.
    """
    for base in (f"{root}/merged", root):
        for suffix, read in ((".parquet", spark.read.parquet), (".csv", lambda p: spark.read.csv(p, header=True))):
            if _exists(spark, f"{base}/{kind}{suffix}"):
                rows = read(f"{base}/{kind}{suffix}").withColumnRenamed(metal, "metal")
                return rows.select("vertical", "rel_path", "metal", "partner", F.concat_ws("-", "metal", "partner").alias("pair"))
    raise FileNotFoundError(f"{root}: no {kind} list")


def read_vectors(spark: SparkSession, path: str, mode: str = "all", own: tuple[str, ...] = (), keep: DataFrame | None = None) -> DataFrame:
    """(key, source, vector) of a vector store.

    ``mode`` is ``all``, ``own`` (sources named in ``own``) or ``others``;
    ``keep`` limits to its keys.
    """
    if mode not in ("all", "own", "others"):
        raise ValueError(f"unknown mode {mode!r}")
    rows = spark.read.parquet(path).select("key", "source", "vector")
    if mode != "all":
        named = F.coalesce(F.col("source").isin(*own), F.lit(False))
        rows = rows.where(named if mode == "own" else ~named)
    return rows if keep is None else rows.join(keep.select("key").distinct(), "key", "left_semi")
