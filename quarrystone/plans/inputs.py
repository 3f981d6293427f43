"""Queries: geometry text, event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.operators import records
from quarrystone.plans.base import QuerySet
from quarrystone.session import load
from quarrystone.sources.geometry import parse_input
from quarrystone.streaming.incremental import windowed_counts

query = QuerySet()


@query(r"""
WITH f AS (SELECT file_id, content FROM job_files WHERE file_name = 'orca.inp' AND regexp_matches(content, '\*\s*xyz\s+-?[0-9]+\s+[0-9]+')),
l AS (SELECT file_id, unnest(string_split(replace(content, chr(13), ''), chr(10))) AS line FROM f)
SELECT f.file_id, CAST(regexp_extract(content, '\*\s*xyz\s+(-?[0-9]+)\s+([0-9]+)', 1) AS INTEGER) AS charge, CAST(regexp_extract(content, '\*\s*xyz\s+(-?[0-9]+)\s+([0-9]+)', 2) AS INTEGER) AS spin,
  CAST((SELECT count(*) FROM l WHERE l.file_id = f.file_id AND regexp_full_match(line, '\s*[A-Z][a-z]?\s+[-+0-9.eE]+\s+[-+0-9.eE]+\s+[-+0-9.eE]+\s*')) AS INTEGER) AS n_atoms FROM f
""")
def input_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charge, multiplicity and atoms of the input files among the job files."""
    files = load(spark, sf_dir, "job_files").where("file_name = 'orca.inp'").select("file_id", parse_input(F.col("content")).alias("p")).where("p is not null")
    return files.select("file_id", "p.charge", "p.spin", F.size("p.molecule").alias("n_atoms"))


@query(r"""
WITH f AS (SELECT file_id, replace(content, chr(13), '') AS content FROM job_files WHERE file_name = 'orca.inp' AND regexp_matches(content, '\*\s*xyz\s+-?[0-9]+\s+[0-9]+')),
l AS (SELECT file_id, regexp_extract(line, '^\s*([A-Z][a-z]?)\s', 1) AS el FROM (SELECT file_id, unnest(string_split(content, chr(10))) AS line FROM f)
  WHERE regexp_full_match(line, '\s*[A-Z][a-z]?\s+[-+0-9.eE]+\s+[-+0-9.eE]+\s+[-+0-9.eE]+\s*')),
c AS (SELECT file_id, el, count(*) AS n FROM l GROUP BY ALL), h AS (SELECT file_id, bool_or(el = 'C') AS has_c FROM c GROUP BY file_id)
SELECT c.file_id, string_agg(el || CASE WHEN n > 1 THEN n::VARCHAR ELSE '' END, '' ORDER BY CASE WHEN has_c AND el = 'C' THEN 0 WHEN has_c AND el = 'H' THEN 1 ELSE 2 END, el) AS hill,
  string_agg(el || n, ' ' ORDER BY el) AS alphabetical, string_agg(el || n, '' ORDER BY el) AS compact FROM c JOIN h ON c.file_id = h.file_id GROUP BY c.file_id
""")
def input_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three formula spellings of the input files."""
    files = load(spark, sf_dir, "job_files").where("file_name = 'orca.inp'").select("file_id", parse_input(F.col("content")).alias("p")).where("size(p.molecule) > 0")
    m = F.col("p.molecule")
    return files.select("file_id", records.hill_formula(m).alias("hill"), records.alphabetical_formula(m).alias("alphabetical"), records.compact_formula(m).alias("compact"))



@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_counts(load(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))


QUERIES, SQL = query.queries, query.sql
