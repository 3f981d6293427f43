"""Partitioned tables, holdout lists and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_store(records: DataFrame, root: str, kind: str, mode: str = "errorifexists") -> None:
    """Records by vertical; the schema is written even without rows. Files have the advisory size of adaptive execution, however large a vertical is."""
    records.hint("rebalance", "vertical").write.mode(mode).partitionBy("vertical").parquet(f"{root}/{kind}")


def write_splits(records: DataFrame, root: str, mode: str = "errorifexists") -> None:
    """Records by split and vertical, in files of the advisory size."""
    records.hint("rebalance", "split", "vertical").write.mode(mode).partitionBy("split", "vertical").parquet(root)


def write_manifest(manifest: DataFrame, root: str, overwrite: bool = False) -> bool:
    """Manifest as Parquet and its failures as CSV; an existing one is kept unless ``overwrite``. Whether it was written."""
    spark = manifest.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) and not overwrite:
        return False
    manifest.write.mode("overwrite").parquet(f"{root}/manifest")
    manifest.where(F.col("read_status") != "ok").select("vertical", "rel_path", "read_status").write.mode("overwrite").csv(f"{root}/failures", header=True)
    return True


def write_holdouts(holdouts: dict[str, DataFrame], root: str) -> DataFrame:
    """A CSV folder per holdout and an index of their sizes, which is returned."""
    spark = next(iter(holdouts.values())).sparkSession
    sizes = []
    for name, rows in holdouts.items():
        rows.write.mode("overwrite").csv(f"{root}/{name}", header=True)
        sizes.append((name, spark.read.csv(f"{root}/{name}", header=True).count()))
    index = spark.createDataFrame(sizes, "holdout_id string, n_records bigint")
    index.coalesce(1).write.mode("overwrite").csv(f"{root}/INDEX", header=True)
    return index


def merge_archives(existing: DataFrame, incoming: DataFrame, name: str = "name", content: str = "content") -> DataFrame:
    """Entries of two archives by name: the larger content wins, at a tie the existing one."""
    both = existing.withColumn("_old", F.lit(1)).unionByName(incoming.withColumn("_old", F.lit(0)))
    return both.groupBy(name).agg(F.max_by(content, F.struct(F.length(content), "_old")).alias(content))


def write_vectors(vectors: DataFrame, path: str, about: dict[str, str]) -> None:
    """Vectors with what they are in the column's metadata, which Parquet keeps."""
    column = F.col("vector").cast("array<float>").alias("vector", metadata=about)
    vectors.select(*[c for c in vectors.columns if c != "vector"], column).write.mode("overwrite").parquet(path)
