"""Listings of job folders: what lies where, how big, how complete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def base_name(path: Column, last: int = 1) -> Column:
    """The last parts of a path, joined by ``/``."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    n = F.least(F.lit(last), F.size(parts))
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - n, F.lit(0)) + 1, F.greatest(n, F.lit(1))), "/")


def sizes_by(files: DataFrame, label: Column, size: str) -> DataFrame:
    """(label, n_files, n_bytes) of a listing."""
    return files.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n_files"), F.sum(size).alias("n_bytes"))


def scan_folders(files: DataFrame, folder: str, size: str) -> DataFrame:
    """(folder, depth, n_files, n_bytes): most files first, then the shallower, then by name."""
    out = files.groupBy(folder).agg(F.count(F.lit(1)).alias("n_files"), F.sum(size).alias("n_bytes"))
    depth = F.size(F.filter(F.split(folder, "/"), lambda p: p != ""))
    return out.withColumn("depth", depth).orderBy(F.desc("n_files"), "depth", folder)


def parents(folders: DataFrame, folder: str) -> DataFrame:
    """All proper ancestors of the folders, each once: ``/`` of an absolute path, none of a relative one's first part."""
    absolute = F.startswith(folder, F.lit("/"))
    parts = F.filter(F.split(folder, "/"), lambda p: p != "")
    first = F.when(absolute, 0).otherwise(1)
    up = F.transform(
        F.sequence(first, F.size(parts) - 1), lambda k: F.concat(F.when(absolute, F.lit("/")).otherwise(F.lit("")), F.array_join(F.slice(parts, F.lit(1), k), "/"))
    )
    return folders.where(F.size(parts) > first).select(F.explode(up).alias(folder)).distinct()


def leaf_folders(folders: DataFrame, folder: str, special: str = "generator") -> DataFrame:
    """Folders that are no other's ancestor; a leaf called ``special`` stands for its parent."""
    own = folders.select(folder).distinct()
    leaves = own.join(parents(own, folder), folder, "left_anti")
    return leaves.select(F.regexp_replace(folder, f"/{special}$", "").alias(folder)).distinct()


def outermost_jobs(folders: DataFrame, folder: str) -> DataFrame:
    """Job folders that do not lie under another one."""
    own = folders.select(folder).distinct()
    parts = F.split(F.regexp_replace(folder, "^/", ""), "/")
    up = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda k: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), k), "/")))
    below = own.where(F.size(parts) > 1).select(folder, F.explode(up).alias("_up"))
    nested = below.join(own.select(F.col(folder).alias("_up")), "_up").select(folder).distinct()
    return own.join(nested, folder, "left_anti")


def completeness(files: DataFrame, folder: str, name: str, size: str, needed: list[str]) -> DataFrame:
    """(folder, n_needed, missing, complete): a needed file counts if it is there and not empty."""
    out = files.groupBy(folder).agg(F.collect_set(F.when(F.col(size) > 0, F.col(name))).alias("_have"))
    missing = F.array_except(F.array(*map(F.lit, needed)), "_have")
    return out.select(folder, (F.lit(len(needed)) - F.size(missing)).alias("n_needed"), F.array_join(missing, ",").alias("missing"), (F.size(missing) == 0).alias("complete"))


def should_delete(name: Column, keep: list[str]) -> Column:
    """Files of a job that are neither results nor inputs."""
    return ~F.coalesce(name.isin(keep) | name.rlike(r"\.(json|inp|zip)$"), F.lit(False))


def remapped(path: Column, root: str, to: str) -> Column:
    """The path under ``to`` where it lies in ``root`` (or is it), else as it is."""
    base = root.rstrip("/")
    return F.when(path == base, F.lit(to.rstrip("/"))).when(path.startswith(base + "/"), F.concat(F.lit(to.rstrip("/")), F.substring(path, len(base) + 1, 1 << 30))).otherwise(path)
