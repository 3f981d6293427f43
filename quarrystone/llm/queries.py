"""Queries of the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import encoding, grouped_splits, mixing, overlap, subjects
from quarrystone.operators.profiling import latest_records
from quarrystone.session import load, materialize


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train structures that superpose on an evaluation structure."""
    pairs = overlap.SplitOverlap(load(spark, sf_dir, "structure_store")).record_pairs()
    return pairs.select(F.least("train_id", "eval_id").alias("struct_a"), F.greatest("train_id", "eval_id").alias("struct_b"))


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps per evaluation split and vertical."""
    return overlap.SplitOverlap(load(spark, sf_dir, "structure_store")).report()


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_splits.structure_groups(load(spark, sf_dir, "structure_store"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every structure that has a relative."""
    return _groups(spark, sf_dir).where("group_size > 1").select(F.col("record_id").alias("struct_id"), "group_id")


def p5_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, val and test for each valid composition setting."""
    labels = latest_records(load(spark, sf_dir, "structure_store")).select(F.col("struct_id").alias("record_id"), "vertical", "charge", "spin")
    return grouped_splits.stratified_assignment(materialize(_groups(spark, sf_dir), "p5-groups"), labels, load(spark, sf_dir, "split_config"), ["vertical", "charge", "spin"])


def p5_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with each split setting, if anything."""
    rows = load(spark, sf_dir, "split_config")
    return rows.select("config_id", grouped_splits.setting_problem(F.col("method"), F.col("ratios"), F.col("seed")).alias("problem"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The byte_bpe_50k ids of every document."""
    return encoding.encode_corpus(load(spark, sf_dir, "documents"))


def _mix(spark: SparkSession, sf_dir: str) -> mixing.SourceMix:
    return mixing.SourceMix(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix and how often each is in it."""
    return _mix(spark, sf_dir).mixed()


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source."""
    return _mix(spark, sf_dir).shares()


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.SubjectModel(load(spark, sf_dir, "documents"), load(spark, sf_dir, "subject_labels"), load(spark, sf_dir, "subject_areas")).assign()


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subjects of every document."""
    return _assigned(spark, sf_dir).select("doc_id", "subject")


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of the corpus each subject is."""
    return subjects.subject_shares(_assigned(spark, sf_dir), load(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p2_report, p5_found, p5_splits, p5_configs, p8_ids, p9_mix, p9_shares, p10_found, p10_shares)}

SQL: dict[str, str] = {
    "p5_found": """
WITH RECURSIVE s0 AS (SELECT *, row_number() OVER (PARTITION BY struct_id ORDER BY loaded_at DESC NULLS LAST) AS n FROM structure_store), s AS (SELECT * FROM s0 WHERE n = 1),
k AS (SELECT struct_id, 'c' || array_to_string(list_sort(list_transform(molecule, lambda a: lower(trim(a.elem, ' ')))), ',') AS key FROM s
    WHERE molecule IS NOT NULL AND len(list_filter(molecule, lambda a: a.elem IS NULL)) = 0
  UNION ALL SELECT struct_id, 'o' || lower(trim(origin_ref, ' ')) FROM s WHERE origin_ref IS NOT NULL),
m AS (SELECT struct_id AS a, min(struct_id) OVER (PARTITION BY key) AS b FROM k), e AS (SELECT DISTINCT a, b FROM m UNION SELECT b, a FROM m),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT a AS struct_id, min(b) AS group_id FROM r GROUP BY a HAVING count(*) > 1
""",
    "p5_configs": """
SELECT config_id, CASE WHEN method IS NULL OR method NOT IN ('random', 'composition') THEN 'method' WHEN ratios IS NULL OR len(ratios) <> 3 THEN 'number of ratios'
  WHEN list_min(ratios) <= 0 THEN 'ratio not above 0' WHEN abs(list_sum(ratios) - 1) > 1e-6 THEN 'ratios do not sum to 1' WHEN seed IS NULL THEN 'seed' END AS problem FROM split_config
""",
}
