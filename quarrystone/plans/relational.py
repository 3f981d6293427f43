"""Queries: joins by key and distance, set operations, sampling and splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.operators import joins, profiling, records, sampling
from quarrystone.plans.agreement import _STRUCTURES, _structures
from quarrystone.plans.base import QuerySet
from quarrystone.session import load

query = QuerySet()


def _stores(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The keyed tables: structures, and per record the number of points and of nested payloads."""
    cps, nested = load(spark, sf_dir, "qtaim_cps"), load(spark, sf_dir, "nested_records")
    return {
        "structure": _structures(spark, sf_dir).select("record_key", "vertical", F.size("molecule").alias("n_atoms")),
        "qtaim": cps.groupBy("record_key").agg(F.countDistinct("cp_key").alias("n_points")),
        "nested": nested.groupBy("record_key").agg(F.countDistinct("rec_id").alias("n_payloads")),
    }


_STORES = _STRUCTURES + """,
q AS (SELECT record_key, count(DISTINCT cp_key) AS n_points FROM qtaim_cps GROUP BY record_key),
d AS (SELECT record_key, count(DISTINCT rec_id) AS n_payloads FROM nested_records GROUP BY record_key)
"""


@query(_STORES + """
SELECT s.record_key, s.vertical AS structure_vertical, CAST(len(s.molecule) AS INTEGER) AS structure_n_atoms, q.n_points AS qtaim_n_points, d.n_payloads AS nested_n_payloads
FROM s JOIN q ON s.record_key = q.record_key JOIN d ON s.record_key = d.record_key
""")
def multiway_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.inner_by_key(_stores(spark, sf_dir), "record_key")


@query(_STORES + """
SELECT s.record_key, concat_ws(',', CASE WHEN q.record_key IS NULL THEN 'qtaim' END, CASE WHEN d.record_key IS NULL THEN 'nested' END) AS missing
FROM s LEFT JOIN q ON s.record_key = q.record_key LEFT JOIN d ON s.record_key = d.record_key WHERE q.record_key IS NULL OR d.record_key IS NULL
""")
def dropped_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.dropped_keys(_stores(spark, sf_dir), "record_key")


@query(_STORES + ",".join(["", *[f"""
a_{t} AS (SELECT '{t}' AS "table", count(s.record_key) AS n_reference, count({t}.record_key) AS n_own, count(*) FILTER ({t}.record_key IS NULL) AS n_missing, count(*) FILTER (s.record_key IS NULL) AS n_extra
  FROM (SELECT DISTINCT record_key FROM s) s FULL JOIN {t} ON s.record_key = {t}.record_key)""" for t in "qd"]]) + """
SELECT CASE "table" WHEN 'q' THEN 'qtaim' ELSE 'nested' END AS "table", n_reference, n_own, n_missing, n_extra FROM (SELECT * FROM a_q UNION ALL SELECT * FROM a_d)
""")
def missing_vs_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = _stores(spark, sf_dir)
    return joins.key_audit(stores.pop("structure"), stores, "record_key")


@query(_STORES + "SELECT DISTINCT record_key FROM s WHERE record_key NOT IN (SELECT record_key FROM q) OR record_key NOT IN (SELECT record_key FROM d)")
def cross_drop_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = _stores(spark, sf_dir)
    return joins.cross_drop_keys(stores.pop("structure"), stores, "record_key")


@query(_STORES + """
SELECT s.record_key, s.vertical, CAST(len(s.molecule) AS INTEGER) AS n_atoms, coalesce(q.n_points, 0) AS qtaim_n_points, coalesce(d.n_payloads, 0) AS nested_n_payloads,
  concat_ws(',', CASE WHEN q.record_key IS NULL THEN 'qtaim' END, CASE WHEN d.record_key IS NULL THEN 'nested' END) AS missing_tables
FROM s LEFT JOIN q ON s.record_key = q.record_key LEFT JOIN d ON s.record_key = d.record_key
""")
def skip_or_keep_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = _stores(spark, sf_dir)
    return joins.left_by_key(stores.pop("structure"), stores, "record_key", "fill", {"qtaim_n_points": 0, "nested_n_payloads": 0})


@query(_STORES + """,
w AS (SELECT DISTINCT vertical, record_key FROM s WHERE lower(trim(split_name, ' ')) = 'test')
SELECT w.vertical, 'qtaim' AS store, count(*) AS n_requested, count(q.record_key) AS n_found, count(*) - count(q.record_key) AS n_absent FROM w LEFT JOIN q ON w.record_key = q.record_key GROUP BY 1
UNION ALL SELECT w.vertical, 'nested', count(*), count(d.record_key), count(*) - count(d.record_key) FROM w LEFT JOIN d ON w.record_key = d.record_key GROUP BY 1
""")
def holdout_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _structures(spark, sf_dir).where(F.lower(F.trim("split_name")) == "test")
    stores = _stores(spark, sf_dir)
    stores.pop("structure")
    return joins.pull_keys(wanted, stores, "record_key", "vertical")


@query("""
SELECT cp_key, record_key, density_all FROM qtaim_cps q WHERE connected_bond_paths IS NOT NULL AND record_key IN (SELECT record_key FROM nested_records)
""")
def holdout_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = load(spark, sf_dir, "qtaim_cps").where(F.col("connected_bond_paths").isNotNull())
    return points.join(load(spark, sf_dir, "nested_records").select("record_key"), "record_key", "left_semi").select("cp_key", "record_key", "density_all")


@query(_STRUCTURES + "SELECT struct_id, record_key FROM s WHERE record_key NOT IN (SELECT record_key FROM nested_records WHERE record_key IS NOT NULL)")
def exclusion_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.exclude_keys(_structures(spark, sf_dir), load(spark, sf_dir, "nested_records"), ["record_key"]).select("struct_id", "record_key")


_CPS = """
WITH p AS (SELECT *, row_number() OVER (PARTITION BY record_key, cp_key ORDER BY loaded_at DESC) AS n FROM qtaim_cps),
c AS (SELECT * EXCLUDE (n) FROM p WHERE n = 1),
atoms AS (SELECT record_key, CAST(cp_key AS INTEGER) AS i, pos_ang[1] AS x, pos_ang[2] AS y, pos_ang[3] AS z FROM c WHERE NOT contains(cp_key, '_')),
bonds AS (SELECT record_key, cp_key, pos_ang[1] AS x, pos_ang[2] AS y, pos_ang[3] AS z FROM c WHERE contains(cp_key, '_'))
"""


def _latest_cps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.latest(load(spark, sf_dir, "qtaim_cps"), ["record_key", "cp_key"], [F.desc("loaded_at")])


@query(_CPS + """,
near AS (SELECT b.record_key, b.cp_key, a.i AS atom, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS d FROM bonds b JOIN atoms a ON a.record_key = b.record_key),
r AS (SELECT *, row_number() OVER (PARTITION BY record_key, cp_key ORDER BY d, atom) AS rank FROM near)
SELECT record_key, cp_key, atom, round(d, 6) AS dist, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 2
""")
def two_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two atoms nearest to each bond point."""
    points = _latest_cps(spark, sf_dir).select("record_key", "cp_key", *[F.get("pos_ang", F.lit(k)).alias(c) for k, c in enumerate("xyz")])
    is_bond = F.contains("cp_key", F.lit("_"))
    atoms = points.where(~is_bond).select("record_key", F.col("cp_key").cast("int").alias("i"), "x", "y", "z")
    found = joins.nearest(points.where(is_bond), atoms, ["record_key"], "cp_key", 2)
    return found.withColumn("dist", F.round("dist", 6))


@query(_STRUCTURES + """,
b AS (SELECT DISTINCT record_key, least(b.i, b.j) AS i, greatest(b.i, b.j) AS j FROM (SELECT record_key, unnest(bonds) AS b FROM s) WHERE b.i <> b.j),
k AS (SELECT DISTINCT record_key, least(a, b) AS i, greatest(a, b) AS j FROM (SELECT record_key, CAST(split_part(cp_key, '_', 1) AS INTEGER) AS a, CAST(split_part(cp_key, '_', 2) AS INTEGER) AS b FROM qtaim_cps WHERE contains(cp_key, '_'))),
r AS (SELECT DISTINCT record_key FROM qtaim_cps)
SELECT b.record_key, b.i, b.j, k.i IS NOT NULL AS has_point FROM b JOIN r ON b.record_key = r.record_key LEFT JOIN k ON b.record_key = k.record_key AND b.i = k.i AND b.j = k.j
""")
def bond_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each listed bond has a bond point, in either orientation of its key."""
    from quarrystone.functions.keys import point_parts

    bonds = records.bond_rows(_structures(spark, sf_dir), ["record_key"])
    cps = load(spark, sf_dir, "qtaim_cps")
    parts = cps.select("record_key", point_parts(F.col("cp_key")).alias("p")).where(F.col("p").isNotNull()).select("record_key", "p.i", "p.j").distinct()
    covered = bonds.join(cps.select("record_key"), "record_key", "left_semi")
    return covered.join(parts.withColumn("_p", F.lit(True)), ["record_key", "i", "j"], "left").select("record_key", "i", "j", F.col("_p").isNotNull().alias("has_point"))


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY job_id, subset, folder ORDER BY loaded_at DESC, val_id DESC) AS n FROM validation)
SELECT job_id, subset, folder, val_id, load_no, n_atoms, total_time FROM r WHERE n = 1
""")
def latest_wins_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tracking table after its loads, each row keyed by job, subset and folder."""
    rows = load(spark, sf_dir, "validation")
    return profiling.latest(rows, ["job_id", "subset", "folder"], [F.desc("loaded_at"), F.desc("val_id")]).select("job_id", "subset", "folder", "val_id", "load_no", "n_atoms", "total_time")


@query("""
WITH m AS (SELECT max(ts) - INTERVAL 1 DAY AS cut FROM events), r AS (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events)
SELECT user_id, event_type, event_id, value FROM r WHERE n = 1
""")
def upsert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each user and type: those up to the day before the last, brought up to date with the later ones."""
    events = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    timed = events.join(F.broadcast(events.agg((F.max("ts") - F.expr("INTERVAL 1 DAY")).alias("cut"))))
    old, new = (timed.where(c).drop("cut", "ts") for c in ("ts <= cut", "ts > cut or ts is null"))
    return joins.latest_wins(old, new, ["user_id", "event_type"], "event_id")


# --- set operations -------------------------------------------------------------------
@query("""
SELECT key, CAST(max(in_cps::INT) AS INTEGER) AS in_cps, CAST(max(in_nested::INT) AS INTEGER) AS in_nested FROM (
  SELECT record_key AS key, true AS in_cps, false AS in_nested FROM qtaim_cps UNION ALL SELECT record_key, false, true FROM nested_records) GROUP BY key
""")
def key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = load(spark, sf_dir, "qtaim_cps").select(F.col("record_key").alias("key"), F.lit(1).alias("in_cps"), F.lit(0).alias("in_nested"))
    b = load(spark, sf_dir, "nested_records").select(F.col("record_key").alias("key"), F.lit(0).alias("in_cps"), F.lit(1).alias("in_nested"))
    return a.unionByName(b).groupBy("key").agg(F.max("in_cps").alias("in_cps"), F.max("in_nested").alias("in_nested"))


@query("SELECT record_key FROM qtaim_cps INTERSECT SELECT record_key FROM nested_records")
def key_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "qtaim_cps").select("record_key").intersect(load(spark, sf_dir, "nested_records").select("record_key"))


@query("SELECT record_key FROM structure_store EXCEPT SELECT record_key FROM qtaim_cps")
def key_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "structure_store").select("record_key").subtract(load(spark, sf_dir, "qtaim_cps").select("record_key"))


@query("""
WITH a AS (SELECT vertical || '__' || record_key AS key, coalesce(lower(trim(split_name, ' ')), 'none') AS shard FROM structure_store)
SELECT key, max(shard) AS shard, count(*) AS n_put, count(DISTINCT shard) AS n_shards FROM a GROUP BY key
""")
def merged_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stores of all splits united under prefixed keys; puts are counted apart from distinct keys."""
    rows = load(spark, sf_dir, "structure_store").select(F.concat_ws("__", "vertical", "record_key").alias("key"), F.coalesce(F.lower(F.trim("split_name")), F.lit("none")).alias("shard"))
    named = ["train", "val", "test"]
    shards = [rows.where(F.col("shard") == n) for n in named] + [rows.where(~F.col("shard").isin(named))]
    return reduce(DataFrame.unionByName, shards).groupBy("key").agg(F.max("shard").alias("shard"), F.count(F.lit(1)).alias("n_put"), F.count_distinct("shard").alias("n_shards"))


# --- splits and samples ---------------------------------------------------------------
_LIMB = "CAST(CAST('0x' || substr(h, {a}, 16) AS UBIGINT) % 10000 AS BIGINT) * {w}"
_BUCKET = "CAST((" + " + ".join(_LIMB.format(a=1 + 16 * k, w=pow(2, 64 * (3 - k), 10000)) for k in range(4)) + ") % 10000 AS INTEGER)"
_COMPOSED = _STRUCTURES + """,
f AS (SELECT struct_id, string_agg(el, ',' ORDER BY el) AS formula FROM atoms GROUP BY struct_id),
k AS (SELECT s.struct_id, s.vertical, f.formula, sha256(f.formula || '_42') AS h FROM s LEFT JOIN f ON s.struct_id = f.struct_id),
a AS (SELECT struct_id, vertical, formula, CASE WHEN formula IS NULL THEN 'train' WHEN {b} / 10000.0 < 0.8 THEN 'train' WHEN {b} / 10000.0 < 0.9 THEN 'val' ELSE 'test' END AS split FROM k)
""".replace("{b}", _BUCKET)


def _hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _structures(spark, sf_dir).withColumn("formula", F.nullif(records.composition(F.col("molecule")), F.lit("")))
    return rows.select("struct_id", "vertical", "formula", sampling.hash_split(F.col("formula"), (0.8, 0.1, 0.1), 42).alias("split"))


@query(_COMPOSED + "SELECT struct_id, split FROM a")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hash_split(spark, sf_dir).select("struct_id", "split")


@query(_COMPOSED + """,
n AS (SELECT vertical, split, count(*) AS n FROM a GROUP BY ALL), t AS (SELECT *, CAST(sum(n) OVER (PARTITION BY vertical) AS BIGINT) AS total FROM n)
SELECT vertical, split, n, total, n / total AS actual, CASE split WHEN 'train' THEN 0.8::DOUBLE ELSE 0.1::DOUBLE END AS requested, abs(n / total - CASE split WHEN 'train' THEN 0.8::DOUBLE ELSE 0.1::DOUBLE END) > 0.05 AS off FROM t
""")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_deviation(_hash_split(spark, sf_dir), ["vertical"], {"train": 0.8, "val": 0.1, "test": 0.1})


@query(_COMPOSED + """,
x AS (SELECT struct_id, split FROM a), d AS (SELECT s.vertical, x.split, s.record_key, lower(trim(s.split_name, ' ')) AS stored FROM s JOIN x ON s.struct_id = x.struct_id)
SELECT vertical, count(*) AS n_source, count(stored) AS n_split, count(*) FILTER (stored = split) AS n_agree,
  CASE WHEN count(stored) = 0 THEN 'NEVER_SPLIT' WHEN count(stored) <> count(*) THEN 'DRIFT' ELSE 'HEALTHY' END AS status FROM d GROUP BY vertical
""")
def split_drift_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each vertical: records, those with a stored split, those stored where the hash puts them, and a verdict."""
    from quarrystone.operators.quality import split_audit

    stored = _structures(spark, sf_dir).select("struct_id", F.lower(F.trim("split_name")).alias("stored"))
    return split_audit(_hash_split(spark, sf_dir).join(stored, "struct_id"), "vertical", "split", "stored")


@query(_STRUCTURES + """,
o AS (SELECT record_key, row_number() OVER (ORDER BY sha256(record_key || '_7'), record_key) - 1 AS i, count(*) OVER () AS n FROM s)
SELECT record_key, CASE WHEN i < floor(n * 0.8) THEN 'train' WHEN i < floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM o
""")
def exact_count_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.exact_count_split(_structures(spark, sf_dir).select("record_key"), "record_key", (0.8, 0.1, 0.1), 7)


@query(_STRUCTURES + """,
o AS (SELECT record_key, row_number() OVER (ORDER BY record_key) - 1 AS i, count(*) OVER () AS n FROM s)
SELECT record_key FROM o WHERE i % greatest(1, n // 100) = 0
""")
def systematic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.systematic_sample(_structures(spark, sf_dir).select("record_key"), [F.col("record_key")], 100)


@query("SELECT CAST(event_id AS BIGINT) AS event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS ordinal FROM events")
def ordinal_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.with_ordinal(load(spark, sf_dir, "events").select("event_id", "ts"), [F.col("ts"), F.col("event_id")]).select("event_id", "ordinal")


@query("SELECT vec_id FROM embeddings ORDER BY sha256(vec_id::VARCHAR || '_3'), vec_id LIMIT 50")
def fixed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.fixed_sample(load(spark, sf_dir, "embeddings").select("vec_id"), "vec_id", 50, 3)


@query("""
WITH r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY sha256(vec_id::VARCHAR || '_42'), vec_id) AS n FROM embeddings) SELECT vec_id, label FROM r WHERE n <= 20
""")
def balanced_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.quota_sample(load(spark, sf_dir, "embeddings").select("vec_id", "label"), ["label"], "vec_id", 20, 42)


@query("""
WITH p AS (SELECT c_mktsegment, count(DISTINCT c_nationkey) AS parts FROM customer GROUP BY 1),
r AS (SELECT c_custkey, c.c_mktsegment, c_nationkey, parts, row_number() OVER (PARTITION BY c.c_mktsegment, c_nationkey ORDER BY sha256(c_custkey::VARCHAR || '_5'), c_custkey) AS n FROM customer c JOIN p ON c.c_mktsegment = p.c_mktsegment)
SELECT c_mktsegment, c_custkey, c_nationkey FROM r WHERE n <= ceil(60 / parts)
""")
def quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return sampling.class_quota_sample(rows, "c_mktsegment", "c_nationkey", "c_custkey", 60, 5)


@query("""
WITH t AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0), r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256(c_custkey::VARCHAR || '_9'), c_custkey) AS n,
  count(*) OVER (PARTITION BY c_mktsegment) AS size FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM t))
SELECT c_custkey, c_mktsegment FROM r WHERE n <= greatest(1, floor(0.1 * size + 0.5))
""")
def complement_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    taken = rows.where("c_acctbal < 0")
    return sampling.complement_sample(rows.drop("c_acctbal"), taken, "c_mktsegment", "c_custkey", 0.1, 9)


_PAIRS = _STRUCTURES + """,
b AS (SELECT struct_id, least(b.i, b.j) AS i, greatest(b.i, b.j) AS j FROM (SELECT struct_id, unnest(bonds) AS b FROM s)),
e AS (SELECT b.struct_id, least(x.el, y.el) || '-' || greatest(x.el, y.el) AS pair FROM b JOIN atoms x ON b.struct_id = x.struct_id AND b.i = x.i JOIN atoms y ON b.struct_id = y.struct_id AND b.j = y.i),
z AS (SELECT pair, count(DISTINCT struct_id) AS size FROM e GROUP BY pair),
d AS (SELECT pair, size, CASE WHEN size >= 1 AND size < 10 THEN 0 WHEN size >= 10 AND size < 100 THEN 1 WHEN size >= 100 AND size < 1000 THEN 2 END AS band FROM z),
r AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY sha256(pair || '_87'), pair) AS n FROM d WHERE band IS NOT NULL),
g AS (SELECT pair, size, band FROM r WHERE n <= CASE band WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 2 END)
"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.element_pairs(_structures(spark, sf_dir).where("molecule is not null"), ["struct_id"]).select("struct_id", F.concat_ws("-", "el_a", "el_b").alias("pair"))


@query(_PAIRS + "SELECT pair, size, CAST(band AS INTEGER) AS band FROM g")
def band_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.band_sample(_pairs(spark, sf_dir), "pair", ["struct_id"], [1, 10, 100, 1000], [3, 2, 2], 87)


@query(_PAIRS + "SELECT struct_id, string_agg(DISTINCT e.pair, ',' ORDER BY e.pair) AS matched_pairs, CAST(count(DISTINCT e.pair) AS INTEGER) AS n_matched FROM e JOIN g ON e.pair = g.pair GROUP BY struct_id")
def matched_pairs_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir)
    return sampling.matched_records(pairs, sampling.band_sample(pairs, "pair", ["struct_id"], [1, 10, 100, 1000], [3, 2, 2], 87), "pair", ["struct_id"])


@query(_COMPOSED + """,
n AS (SELECT vertical, formula, count(*) AS n FROM a WHERE formula IS NOT NULL GROUP BY ALL),
b AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY vertical ORDER BY sha256(formula || '_h3'), formula ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n)
SELECT vertical, formula, n FROM b WHERE before < 5
""")
def greedy_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.greedy_prefix(_hash_split(spark, sf_dir).where(F.col("formula").isNotNull()), "vertical", "formula", F.lit(5), "h3")


@query(_STRUCTURES + "SELECT struct_id, vertical, CAST(len(molecule) AS INTEGER) AS n_atoms FROM s WHERE len(molecule) > 22")
def holdout_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _structures(spark, sf_dir).where(F.size("molecule") > 22).select("struct_id", "vertical", F.size("molecule").alias("n_atoms"))


@query(_STRUCTURES + "SELECT struct_id, vertical, charge FROM s WHERE abs(charge) > 1")
def holdout_charged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _structures(spark, sf_dir).where(F.abs("charge") > 1).select("struct_id", "vertical", "charge")


@query("SELECT event_type, user_id, value, CAST(n AS INTEGER) AS n FROM (SELECT event_type, user_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS n FROM events) WHERE n <= 5")
def top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("event_type").orderBy(F.desc("value"), "event_id")
    return load(spark, sf_dir, "events").withColumn("n", F.row_number().over(w)).where("n <= 5").select("event_type", "user_id", "value", "n")


QUERIES, SQL = query.queries, query.sql
