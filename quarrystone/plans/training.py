"""Queries of the general training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.operators import drift, flatten, lowrank, masks, packing
from quarrystone.plans.quality import normal_folder_sql
from quarrystone.session import load, materialize


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = materialize(lowrank.latest_points(load(spark, sf_dir, "qtaim_cps")), "p1-points")
    return lowrank.CRITICAL_POINTS.fill(points)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells that had no usable value and were filled."""
    return lowrank.filled_cells(_filled(spark, sf_dir), lowrank.CRITICAL_POINTS)


def p1_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete table of points with a mark on each filled cell."""
    return _filled(spark, sf_dir)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key of every child of every readable payload."""
    return flatten.flatten_records(load(spark, sf_dir, "nested_records")).select("rec_id", "child", "child_key")


def p3_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All child tables with parent keys and values."""
    return flatten.flatten_records(load(spark, sf_dir, "nested_records"))


def _changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    fields = materialize(drift.file_fields(load(spark, sf_dir, "bond_files")), "p4-fields")
    return fields, drift.schema_changes(fields)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes between following batches of each feed."""
    return _changes(spark, sf_dir)[1].select("feed_id", "batch_no", "change_kind", "field", "new_field")


def p4_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value under its field's name throughout the feed."""
    fields, changes = _changes(spark, sf_dir)
    return drift.consistent_table(fields, materialize(changes, "p4-changes"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ill-formed cells of the validation table."""
    found = masks.MaskProfile().violations(load(spark, sf_dir, "validation"), "val_id", "load_no")
    return found.select(F.col("row_id").alias("val_id"), "field").distinct()


def p6_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile of each column and load, with the loads that differ."""
    return masks.MaskProfile().profile(load(spark, sf_dir, "validation"), "val_id", "load_no")


def p6_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ill-formed cells with value, mask and reason."""
    return masks.MaskProfile().violations(load(spark, sf_dir, "validation"), "val_id", "load_no")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose bytes the archive already holds under a smaller id."""
    return packing.pack_files(load(spark, sf_dir, "job_files")).index.where("is_copy").select("file_id")


def p7_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each input row's bytes lie in the archive."""
    return packing.pack_files(load(spark, sf_dir, "job_files")).index


def p7_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed files per subroot beside the latest good scan."""
    files = load(spark, sf_dir, "job_files")
    return packing.compare_with_scans(packing.pack_files(files).index, files, load(spark, sf_dir, "size_scan"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_filled, p3_found, p3_children, p4_found, p4_table, p6_found, p6_profile, p6_violations, p7_found, p7_index, p7_compare)
}

_SCANS = f"""
k AS (SELECT subroot, {normal_folder_sql('subroot')} AS root, {normal_folder_sql('folder')} AS nf, file_id, file_name, content FROM job_files),
u AS (SELECT arg_min(root, file_id) AS root, octet_length(encode(any_value(content))) AS size FROM k GROUP BY nf, file_name, content),
p AS (SELECT root AS subroot, count(*) AS packed_files, CAST(sum(coalesce(size, 0)) AS BIGINT) AS packed_bytes FROM u GROUP BY root),
g AS (SELECT {normal_folder_sql('subroot')} AS subroot, arg_max(total_files, (scanned_at, total_files, total_bytes)) AS total_files, arg_max(total_bytes, (scanned_at, total_files, total_bytes)) AS total_bytes
  FROM size_scan WHERE lower(trim(status, ' ')) = 'ok' AND total_files IS NOT NULL GROUP BY 1)
"""

SQL = {
    "p7_found": f"""
SELECT file_id FROM (SELECT file_id, min(file_id) OVER (PARTITION BY {normal_folder_sql('folder')}, file_name, content) AS kept FROM job_files) WHERE file_id <> kept
""",
    "p7_compare": f"""
WITH {_SCANS}
SELECT coalesce(p.subroot, g.subroot) AS subroot, coalesce(packed_files, 0) AS packed_files, coalesce(packed_bytes, 0) AS packed_bytes, total_files, total_bytes, coalesce(packed_files, 0) - total_files AS files_off
FROM p FULL JOIN g ON p.subroot = g.subroot
""",
    "p1_found": """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY record_key, cp_key ORDER BY loaded_at DESC NULLS LAST) AS copy FROM qtaim_cps), c AS (SELECT * FROM n WHERE copy = 1)
SELECT DISTINCT record_key, cp_key, field FROM (
  SELECT record_key, cp_key, 'density_all' AS field FROM c
  WHERE density_all IS NULL OR NOT isfinite(density_all) OR NOT (density_all > 0 AND density_all <= 100000)
  UNION ALL
  SELECT record_key, cp_key, 'ellip_e_dens' FROM c
  WHERE ellip_e_dens IS NULL OR NOT isfinite(ellip_e_dens) OR NOT (ellip_e_dens >= 0 AND ellip_e_dens <= 1000)
  UNION ALL
  SELECT record_key, cp_key, 'elem' FROM c
  WHERE NOT contains(cp_key, '_') AND (elem IS NULL OR lower(trim(elem, ' ')) NOT IN ({symbols})))
""".replace("{symbols}", ", ".join(f"'{s.lower()}'" for s in lowrank.SYMBOLS)),
    "p6_found": r"""
WITH cells AS (
  SELECT val_id, 'val_qtaim' AS field, trim(val_qtaim, ' ') AS v FROM validation
  UNION ALL SELECT val_id, 'val_charge', trim(val_charge, ' ') FROM validation
  UNION ALL SELECT val_id, 'n_atoms', trim(n_atoms, ' ') FROM validation
  UNION ALL SELECT val_id, 'total_time', trim(total_time, ' ') FROM validation)
SELECT DISTINCT val_id, field FROM cells
WHERE v IS NOT NULL AND lower(v) NOT IN ('', 'none', 'null', 'nan') AND NOT CASE
  WHEN field IN ('val_qtaim', 'val_charge') THEN lower(v) IN ('true', 'false')
  WHEN field = 'n_atoms' THEN regexp_full_match(v, '[0-9]+') AND coalesce(try_cast(v AS HUGEINT) BETWEEN 1 AND 10000, false)
  ELSE regexp_full_match(v, '[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?') AND coalesce(isfinite(try_cast(v AS DOUBLE)), false) END
""",
}
