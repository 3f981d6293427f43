"""Status rules over records, expected contents and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statuses of a record, worst first.
STATUSES = ("unreadable", "empty", "malformed", "missing_critical", "no_bonds", "ok")
#: Statuses whose records are left out unless the caller says otherwise.
EXCLUDED = ("unreadable", "empty", "malformed", "missing_critical")
#: Above this share of dropped records a filter stops unless forced.
MOST_DROPPED = 0.5


def json_category(content: Column) -> Column:
    """``empty`` (null or no bytes), ``invalid``, ``empty_content`` ({} or []) or ``ok`` for JSON text.

    Names given more than once in an object do not make it invalid.
    """
    text = F.trim(content)
    parsed = F.get_json_object(text, "$")
    return F.when(content.isNull() | (F.length(text) == 0), "empty").when(parsed.isNull(), "invalid").when(F.regexp_replace(text, r"\s", "").isin("{}", "[]"), "empty_content").otherwise("ok")


def record_status(rules: list[tuple[Column, str]]) -> Column:
    """The status of the first rule that holds, else ok. An unknown condition does not hold."""
    out = F.lit("ok")
    for condition, status in reversed(rules):
        out = F.when(F.coalesce(condition, F.lit(False)), F.lit(status)).otherwise(out)
    return out


def status_counts(statuses: DataFrame, by: list[str], status: str = "status") -> DataFrame:
    """Records per group and status, and over all groups (group columns null, total 1)."""
    return statuses.groupingSets([[*by, status], [status]], *by, status).agg(F.grouping(by[0]).alias("total"), F.count(F.lit(1)).alias("n"))


def failed_samples(statuses: DataFrame, by: list[str], key: str, most: int = 200, status: str = "status") -> DataFrame:
    """Per group and failing status: how many, and the first ``most`` keys in order (the report's limit)."""
    from pyspark.sql import Window

    bad = statuses.where(F.col(status) != "ok")
    w = Window.partitionBy(*by, status).orderBy(key)
    n = bad.groupBy(*by, status).agg(F.count(F.lit(1)).alias("n"))
    first = bad.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).groupBy(*by, status).agg(F.array_join(F.array_sort(F.collect_list(key)), ",").alias("keys"))
    return n.join(first, [*by, status])


def bad_keys(statuses: DataFrame, key: str, excluded: tuple[str, ...] = EXCLUDED, status: str = "status") -> DataFrame:
    return statuses.where(F.col(status).isin(*excluded)).select(key).distinct()


def dropped_index(statuses: DataFrame, key: str, kind: str, excluded: tuple[str, ...] = EXCLUDED, status: str = "status") -> DataFrame:
    """(key, dropped): the failing types of each key as ``type:status`` text in order."""
    bad = statuses.where(F.col(status).isin(*excluded))
    return bad.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", kind, status))), ",").alias("dropped"))


def filter_records(records: DataFrame, bad: DataFrame, key: str, most: float = MOST_DROPPED, force: bool = False) -> DataFrame:
    """Records without the bad keys; raises if more than ``most`` of them would go, unless forced."""
    total, gone = records.select(key).distinct().count(), records.select(key).distinct().join(bad, key, "left_semi").count()
    if total and gone / total > most and not force:
        raise ValueError(f"{gone} of {total} records would be dropped")
    return records.join(bad, key, "left_anti")


def missing_keys(present: DataFrame, expected: DataFrame, kind: str, names: str) -> DataFrame:
    """(…, missing): expected names of the record's type that its array of ``names`` lacks, joined in order.

    ``expected`` has (kind, expected array), a row per type.
    """
    lacking = F.array_sort(F.array_except("expected", names))
    return present.join(F.broadcast(expected), kind).withColumn("missing", F.array_join(lacking, ",")).drop("expected")


def ingest_stats(present: DataFrame, by: list[str], missing: str = "missing", top: int = 10) -> DataFrame:
    """(by, name, n): the ``top`` names missing most often per group; ties by name."""
    from pyspark.sql import Window

    n = present.select(*by, F.explode(F.filter(F.split(missing, ","), lambda x: x != "")).alias("name")).groupBy(*by, "name").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by).orderBy(F.desc("n"), "name")
    return n.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def split_audit(rows: DataFrame, by: str, wanted: str, stored: str) -> DataFrame:
    """Per group: records, those stored in a split, those stored where wanted; NEVER_SPLIT, DRIFT or HEALTHY."""
    out = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n_source"), F.count(stored).alias("n_split"), F.count_if(F.col(stored) == F.col(wanted)).alias("n_agree"))
    status = F.when(F.col("n_split") == 0, "NEVER_SPLIT").when(F.col("n_split") != F.col("n_source"), "DRIFT").otherwise("HEALTHY")
    return out.withColumn("status", status)


# --- validity of job contents (maps of names to numbers) -----------------------------
def has_all(names: Column, needed: list[str]) -> Column:
    return F.size(F.array_except(F.array(*map(F.lit, needed)), names)) == 0


def timings_valid(timings: Column, needed: list[str], patched: Column, n_atoms: Column, tiny: float = 1e-6) -> Column:
    """Every needed step is there and took at least ``tiny`` seconds, unless it was patched or the molecule has at most two atoms."""
    def good(step: str) -> Column:
        t = F.try_element_at(timings, F.lit(step))
        return t.isNotNull() & ((t >= tiny) | F.coalesce(F.array_contains(patched, step), F.lit(False)) | (n_atoms <= 2))

    return F.coalesce(reduce(lambda a, b: a & b, [good(s) for s in needed]), F.lit(False))


def per_atom_valid(values: Column, n_atoms: Column, extra: int = 0) -> Column:
    """As many entries as atoms, plus ``extra`` sums."""
    return F.coalesce(F.size(values) == n_atoms + extra, F.lit(False))


def bonds_valid(names: Column, needed: list[str], n_atoms: Column) -> Column:
    """The needed schemes are there; not asked of molecules of at most two atoms."""
    return F.coalesce(has_all(names, needed) | (n_atoms <= 2), F.lit(False))


def points_valid(keys: Column, n_atoms: Column) -> Column:
    """As many atom points (keys without ``_``) as atoms."""
    return F.coalesce(F.size(F.filter(keys, lambda k: ~k.contains("_"))) == n_atoms, F.lit(False))


def folder_class(has_outputs: Column, flags: list[Column], truncated: Column) -> Column:
    """no_outputs, complete (all flags), needs_rerun (a truncated step) or validation_loop."""
    all_good = reduce(lambda a, b: a & b, flags)
    return F.when(~has_outputs, "no_outputs").when(F.coalesce(all_good, F.lit(False)), "complete").when(truncated, "needs_rerun").otherwise("validation_loop")
