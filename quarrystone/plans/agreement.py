"""Queries: agreement of schemes, classification against a reference, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.functions.elements import COVALENT_RADII
from quarrystone.operators import agreement, classify, joins, profiling, records
from quarrystone.plans.base import QuerySet
from quarrystone.session import load

query = QuerySet()

DESCRIPTORS = ("eig_hess", "lap_e_density", "lagrangian_k", "esp_total", "eta")


def _schemes() -> dict:
    return {"qty": F.col("l_quantity"), "disc": F.col("l_discount") * 100, "tax": F.col("l_tax") * 100, "price": F.col("l_extendedprice") / 1000}


def _rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


_LONG = """
WITH v AS (SELECT l_returnflag, l_orderkey * 10 + l_linenumber AS k, l_quantity AS qty, l_discount * 100 AS disc, l_tax * 100 AS tax, l_extendedprice / 1000 AS price FROM lineitem),
pairs AS (
  SELECT l_returnflag, k, 'qty' AS scheme_a, 'disc' AS scheme_b, qty AS a, disc AS b FROM v UNION ALL
  SELECT l_returnflag, k, 'qty', 'tax', qty, tax FROM v UNION ALL
  SELECT l_returnflag, k, 'qty', 'price', qty, price FROM v UNION ALL
  SELECT l_returnflag, k, 'disc', 'tax', disc, tax FROM v UNION ALL
  SELECT l_returnflag, k, 'disc', 'price', disc, price FROM v UNION ALL
  SELECT l_returnflag, k, 'tax', 'price', tax, price FROM v)
"""


@query(_LONG + """
SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'all' ELSE 'group' END AS level, scheme_a, scheme_b, l_returnflag, count(*) AS n,
  round(sum(a), 2) AS sum_a, round(sum(b), 2) AS sum_b, round(sum(a * b), 1) AS sum_ab, round(avg(abs(a - b)), 6) AS mean_abs_residual,
  round(median(abs(a - b)), 6) AS median_abs_residual, round(quantile_cont(abs(a - b), 0.75) - quantile_cont(abs(a - b), 0.25), 6) AS iqr_abs_residual,
  round(corr(a, b), 6) AS pearson
FROM pairs GROUP BY GROUPING SETS ((scheme_a, scheme_b), (scheme_a, scheme_b, l_returnflag))
""")
def pair_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = agreement.pair_agreement(load(spark, sf_dir, "lineitem"), _schemes(), "l_returnflag").drop("sum_aa", "sum_bb")
    out = _rounded(out, 6, "mean_abs_residual", "median_abs_residual", "iqr_abs_residual", "pearson")
    return _rounded(_rounded(out, 2, "sum_a", "sum_b"), 1, "sum_ab")


@query(_LONG + """,
res AS (SELECT l_returnflag, k, scheme_a, scheme_b, abs(a - b) AS r FROM pairs),
stats AS (SELECT scheme_a, scheme_b, l_returnflag, grouping(l_returnflag) AS g, round(median(r), 6) AS mar, round(quantile_cont(r, 0.75) - quantile_cont(r, 0.25), 6) AS iqr, count(*) AS n_obs
  FROM res GROUP BY GROUPING SETS ((scheme_a, scheme_b), (scheme_a, scheme_b, l_returnflag))),
tops AS (
  SELECT scheme_a, scheme_b, l_returnflag, 0 AS g, k, row_number() OVER (PARTITION BY scheme_a, scheme_b, l_returnflag ORDER BY r DESC, k) AS n FROM res UNION ALL
  SELECT scheme_a, scheme_b, NULL, 1, k, row_number() OVER (PARTITION BY scheme_a, scheme_b ORDER BY r DESC, k) FROM res),
keys AS (SELECT scheme_a, scheme_b, l_returnflag, g, '[' || string_agg('"' || k || '"', ',' ORDER BY n) || ']' AS top_keys FROM tops WHERE n <= 5 GROUP BY ALL)
SELECT s.scheme_a, s.scheme_b, s.l_returnflag, s.mar, s.iqr, s.n_obs, t.top_keys FROM stats s
JOIN keys t ON s.scheme_a = t.scheme_a AND s.scheme_b = t.scheme_b AND s.g = t.g AND s.l_returnflag IS NOT DISTINCT FROM t.l_returnflag
""")
def noise_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").withColumn("k", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return _rounded(agreement.noise_floor(rows, _schemes(), "l_returnflag", "k", 5), 6, "mar", "iqr")


@query(_LONG + """,
f AS (SELECT scheme_a, scheme_b, l_returnflag, median(abs(a - b)) AS mar, count(*) AS n_obs FROM pairs GROUP BY ALL),
long AS (SELECT l_returnflag, scheme_a AS scheme, mar, n_obs FROM f UNION ALL SELECT l_returnflag, scheme_b, mar, n_obs FROM f)
SELECT l_returnflag, scheme, CAST(sum(n_obs) AS BIGINT) AS n, round(sum(mar * n_obs) / sum(n_obs), 6) AS weighted_mar FROM long GROUP BY ALL
""")
def scheme_weighted_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = agreement.scheme_pairs(load(spark, sf_dir, "lineitem"), _schemes(), ["l_returnflag"])
    floors = agreement.pair_medians(pairs, ["scheme_a", "scheme_b", "l_returnflag"])
    return _rounded(agreement.scheme_weighted_floor(floors, ["l_returnflag"]), 6, "weighted_mar")


@query(_LONG + """,
f AS (SELECT scheme_a, scheme_b, l_returnflag, median(abs(a - b)) AS mar, count(*) AS n_obs FROM pairs GROUP BY ALL)
SELECT l_returnflag, round(median(mar), 6) AS floor, max(n_obs) AS n_obs FROM f GROUP BY l_returnflag
""")
def floor_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = agreement.scheme_pairs(load(spark, sf_dir, "lineitem"), _schemes(), ["l_returnflag"])
    floors = agreement.pair_medians(pairs, ["scheme_a", "scheme_b", "l_returnflag"])
    return floors.groupBy("l_returnflag").agg(F.round(F.percentile("mar", 0.5), 6).alias("floor"), F.max("n_obs").alias("n_obs")).orderBy("l_returnflag")


_POINTS = """
WITH p AS (SELECT vertical, record_key, cp_key, upper(trim(elem, ' ')) AS el, loaded_at, {cols},
  row_number() OVER (PARTITION BY record_key, cp_key ORDER BY loaded_at DESC) AS n FROM qtaim_cps),
c AS (SELECT * EXCLUDE (n) FROM p WHERE n = 1)
""".replace("{cols}", ", ".join(f"CASE WHEN isfinite({c}) THEN {c} END AS {c}" for c in DESCRIPTORS))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = load(spark, sf_dir, "qtaim_cps")
    return profiling.latest(points, ["record_key", "cp_key"], [F.desc("loaded_at")]).withColumn("el", F.upper(F.trim("elem")))


@query(_POINTS + """,
long AS (""" + " UNION ALL ".join(f"SELECT vertical, '{a}' AS scheme_a, '{b}' AS scheme_b, {a} AS a, {b} AS b FROM c" for i, a in enumerate(DESCRIPTORS) for b in DESCRIPTORS[i + 1 :]) + """)
SELECT scheme_a, scheme_b, vertical, count(*) AS n, round(corr(a, b), 6) AS pearson FROM long WHERE a IS NOT NULL AND b IS NOT NULL
GROUP BY GROUPING SETS ((scheme_a, scheme_b), (scheme_a, scheme_b, vertical)) HAVING count(*) >= 2
""")
def descriptor_redundancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(agreement.redundancy(_points(spark, sf_dir), {c: F.col(c) for c in DESCRIPTORS}, "vertical"), 6, "pearson")


@query(_POINTS + """,
s AS (SELECT el, record_key || '/' || cp_key AS k, greatest(lagrangian_k, esp_total, eta) - least(lagrangian_k, esp_total, eta) AS spread FROM c WHERE el IS NOT NULL
  AND (lagrangian_k IS NOT NULL)::INT + (esp_total IS NOT NULL)::INT + (eta IS NOT NULL)::INT >= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY el ORDER BY spread DESC, k) AS rank FROM s)
SELECT el, k, spread, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3
""")
def exemplars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _points(spark, sf_dir).withColumn("k", F.concat_ws("/", "record_key", "cp_key"))
    return agreement.exemplars(rows, {c: F.col(c) for c in ("lagrangian_k", "esp_total", "eta")}, "el", "k", 3)


@query(_POINTS + """
SELECT name, CAST(count(*) AS BIGINT) AS n_rows, count(v) AS n_finite, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS std, min(v) AS "min", max(v) AS "max",
  round(quantile_cont(v, 0.05), 8) AS p5, round(quantile_cont(v, 0.5), 8) AS p50, round(quantile_cont(v, 0.95), 8) AS p95
FROM (""" + " UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS v FROM c" for c in DESCRIPTORS) + """) GROUP BY name
""")
def numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profiling.numeric_profile(_points(spark, sf_dir), list(DESCRIPTORS)).select("name", "n_rows", "n_finite", "mean", "std", "min", "max", "p5", "p50", "p95")
    return _rounded(_rounded(out, 4, "mean", "std"), 8, "p5", "p50", "p95")


@query(_POINTS + """
SELECT name, round(coalesce(avg(v), 0), 4) AS center, round(coalesce(stddev_pop(v), 0), 4) AS spread, round(coalesce(quantile_cont(v, 0.05), 0), 8) AS low, round(coalesce(quantile_cont(v, 0.95), 0), 8) AS high
FROM (""" + " UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS v FROM c" for c in DESCRIPTORS) + """) GROUP BY name
""")
def range_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profiling.range_summary(profiling.numeric_profile(_points(spark, sf_dir), list(DESCRIPTORS)))
    return _rounded(_rounded(out, 4, "center", "spread"), 8, "low", "high")


@query(_POINTS + """,
atom AS (SELECT name, avg(v) AS m, stddev_pop(v) AS s FROM (""" + " UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS v FROM c WHERE cp_key NOT LIKE '%\\_%' ESCAPE '\\'" for c in DESCRIPTORS) + """) GROUP BY name),
bond AS (SELECT name, avg(v) AS m, stddev_pop(v) AS s FROM (""" + " UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS v FROM c WHERE cp_key LIKE '%\\_%' ESCAPE '\\'" for c in DESCRIPTORS[:3]) + """) GROUP BY name)
SELECT a.name, round(a.m, 3) AS mean_left, round(a.s, 3) AS std_left, round(b.m, 3) AS mean_right, round(b.s, 3) AS std_right FROM atom a JOIN bond b ON a.name = b.name
""")
def shared_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _points(spark, sf_dir)
    is_bond = F.contains("cp_key", F.lit("_"))
    left = profiling.numeric_profile(points.where(~is_bond), list(DESCRIPTORS))
    right = profiling.numeric_profile(points.where(is_bond), list(DESCRIPTORS[:3]))
    return _rounded(profiling.shared_profiles(left, right), 3, "mean_left", "std_left", "mean_right", "std_right")


@query("""
SELECT name, avg(CASE WHEN v IS NULL OR isnan(v) THEN 1.0 ELSE 0.0 END) AS missing_share FROM (
  SELECT 'density_all' AS name, density_all AS v FROM qtaim_cps UNION ALL SELECT 'ellip_e_dens', ellip_e_dens FROM qtaim_cps UNION ALL
  SELECT 'esp_total', esp_total FROM qtaim_cps UNION ALL SELECT 'eta', eta FROM qtaim_cps)
GROUP BY name ORDER BY missing_share DESC, name LIMIT 3
""")
def missing_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.missing_share(load(spark, sf_dir, "qtaim_cps"), ["density_all", "ellip_e_dens", "esp_total", "eta"], 3)


@query("""
WITH v AS (SELECT l_extendedprice AS x FROM lineitem), b AS (SELECT quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM v)
SELECT CAST(least(20, floor((x - lo) * 20 / (hi - lo)) + 1) AS INTEGER) AS bin, count(*) AS n FROM v, b WHERE x BETWEEN lo AND hi GROUP BY 1
""")
def histogram_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.histogram(load(spark, sf_dir, "lineitem"), "l_extendedprice", 20)


@query("""
WITH v AS (SELECT sign(c_acctbal) * log10(abs(c_acctbal) + 1) AS x FROM customer), b AS (SELECT quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM v)
SELECT CAST(least(10, floor((x - lo) * 10 / (hi - lo)) + 1) AS INTEGER) AS bin, count(*) AS n FROM v, b WHERE x BETWEEN lo AND hi GROUP BY 1
""")
def histogram_signed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.histogram(load(spark, sf_dir, "customer"), "c_acctbal", 10, log=True)


@query(_POINTS + """,
long AS (SELECT 'eig_hess' AS name, eig_hess AS x FROM c UNION ALL SELECT 'lagrangian_k', lagrangian_k FROM c UNION ALL SELECT 'eta', eta FROM c),
s AS (SELECT name, avg(x) AS m, stddev_pop(x) AS s FROM long GROUP BY name)
SELECT l.name, count(x) AS n, round(avg(CASE WHEN s > 0 THEN (abs(x - m) > 2 * s)::INT END), 9) AS outlier_share FROM long l JOIN s ON l.name = s.name WHERE x IS NOT NULL GROUP BY l.name
""")
def outlier_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiling.outlier_share(_points(spark, sf_dir), ["eig_hess", "lagrangian_k", "eta"], 2.0), 9, "outlier_share")


@query(_POINTS + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, round(corr({a}, {b}), 6) AS pearson FROM c" for i, a in enumerate(DESCRIPTORS) for b in DESCRIPTORS[i + 1 :]))
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiling.correlation_matrix(_points(spark, sf_dir), list(DESCRIPTORS)), 6, "pearson")


@query(_POINTS + """,
t AS (SELECT el, count(*) AS n_rows FROM c WHERE el IS NOT NULL GROUP BY el ORDER BY 2 DESC, 1 LIMIT 5)
SELECT c.el, t.n_rows, count(esp_total) AS n_finite, round(quantile_cont(esp_total, 0.25), 8) AS p25, round(quantile_cont(esp_total, 0.5), 8) AS p50, round(quantile_cont(esp_total, 0.75), 8) AS p75
FROM c JOIN t ON c.el = t.el GROUP BY c.el, t.n_rows HAVING count(esp_total) > 0
""")
def top_group_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiling.top_group_distribution(_points(spark, sf_dir), "el", "esp_total", 5), 8, "p25", "p50", "p75")


@query(_POINTS + """,
b AS (SELECT vertical, quantile_cont(lagrangian_k, 0.01) AS low, quantile_cont(lagrangian_k, 0.99) AS high FROM c GROUP BY vertical)
SELECT c.vertical, round(low, 8) AS low, round(high, 8) AS high, count(*) AS n, round(avg(lagrangian_k), 6) AS mean FROM c JOIN b ON c.vertical = b.vertical WHERE lagrangian_k BETWEEN low AND high GROUP BY ALL
""")
def clipped_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profiling.clipped_values(_points(spark, sf_dir), "vertical", "lagrangian_k", 0.01, 0.99)
    return _rounded(_rounded(out, 8, "low", "high"), 6, "mean")


# --- structures -----------------------------------------------------------------------
_STRUCTURES = """
WITH s0 AS (SELECT *, row_number() OVER (PARTITION BY struct_id ORDER BY loaded_at DESC) AS n FROM structure_store),
s AS (SELECT * EXCLUDE (n) FROM s0 WHERE n = 1),
atoms AS (SELECT struct_id, vertical, CAST(u.i - 1 AS INTEGER) AS i, upper(trim(molecule[u.i].elem, ' ')) AS el, molecule[u.i].x AS x, molecule[u.i].y AS y, molecule[u.i].z AS z
  FROM s, unnest(range(1, len(molecule) + 1)) AS u(i) WHERE molecule IS NOT NULL)
"""


def _structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.latest(load(spark, sf_dir, "structure_store"), ["struct_id"], [F.desc("loaded_at")])


@query(_STRUCTURES + """,
f AS (SELECT struct_id, string_agg(el, ',' ORDER BY el) AS comp FROM atoms GROUP BY struct_id)
SELECT s.vertical, count(*) AS n_records, count(molecule) AS n_with_molecule, count(DISTINCT comp) AS n_formulas, CAST(coalesce(sum(len(molecule)), 0) AS BIGINT) AS n_atoms,
  CAST(coalesce(sum(len(bonds)), 0) AS BIGINT) AS n_bonds, count(DISTINCT contributor) AS n_contributors
FROM s LEFT JOIN f ON s.struct_id = f.struct_id GROUP BY s.vertical
""")
def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _structures(spark, sf_dir).withColumn("comp", records.composition(F.col("molecule")))
    zero = F.lit(0).cast("bigint")
    return rows.groupBy("vertical").agg(
        F.count(F.lit(1)).alias("n_records"), F.count("molecule").alias("n_with_molecule"), F.countDistinct("comp").alias("n_formulas"), F.coalesce(F.sum(F.size("molecule")), zero).alias("n_atoms"),
        F.coalesce(F.sum(F.size("bonds")), zero).alias("n_bonds"), F.countDistinct("contributor").alias("n_contributors"),
    )


_HILL = """
c AS (SELECT struct_id, el, count(*) AS n FROM atoms GROUP BY ALL),
h AS (SELECT struct_id, bool_or(el = 'C') AS has_c FROM c GROUP BY struct_id),
hill AS (SELECT c.struct_id, string_agg(upper(el[1]) || lower(el[2:]) || CASE WHEN n > 1 THEN n::VARCHAR ELSE '' END, ''
  ORDER BY CASE WHEN has_c AND el = 'C' THEN 0 WHEN has_c AND el = 'H' THEN 1 ELSE 2 END, el) AS formula FROM c JOIN h ON c.struct_id = h.struct_id GROUP BY c.struct_id)
"""


@query(_STRUCTURES + "," + _HILL + "SELECT formula, count(*) AS n FROM hill GROUP BY formula")
def hill_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _structures(spark, sf_dir).where(F.size("molecule") > 0)
    return rows.select(records.hill_formula(F.col("molecule")).alias("formula")).groupBy("formula").agg(F.count(F.lit(1)).alias("n"))


@query(_STRUCTURES + "SELECT vertical, string_agg(DISTINCT el, ',' ORDER BY el) AS elements, count(DISTINCT el) AS n_elements FROM atoms GROUP BY vertical")
def element_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    atoms = records.atom_rows(_structures(spark, sf_dir), ["struct_id", "vertical"])
    found = F.array_sort(F.collect_set("el"))
    return atoms.groupBy("vertical").agg(F.array_join(found, ",").alias("elements"), F.size(found).cast("bigint").alias("n_elements"))


_RADII = "radii(symbol, radius) AS (VALUES " + ", ".join(f"('{k.upper()}', {v})" for k, v in COVALENT_RADII.items()) + ")"
_NEAR = _STRUCTURES + ", " + _RADII + """,
near AS (SELECT a.struct_id, a.i, b.i AS j, a.el AS el_i, b.el AS el_j, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS dist, ra.radius + rb.radius AS reach
  FROM atoms a JOIN atoms b ON a.struct_id = b.struct_id AND a.i < b.i JOIN radii ra ON ra.symbol = a.el JOIN radii rb ON rb.symbol = b.el)
"""


def _radii(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k.upper(), v) for k, v in COVALENT_RADII.items()], "symbol string, radius double")


@query(_NEAR + "SELECT struct_id, i, j, round(dist, 6) AS dist FROM near WHERE dist > 0 AND dist <= 1.3 * reach")
def geometric_bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    atoms = records.atom_rows(_structures(spark, sf_dir), ["struct_id"])
    return joins.bonded_pairs(atoms, ["struct_id"], _radii(spark)).select("struct_id", F.col("a_i").alias("i"), F.col("b_i").alias("j"), F.round("dist", 6).alias("dist"))


_CLASSIFIED = _NEAR + """,
stored AS (SELECT DISTINCT struct_id, least(b.i, b.j) AS i, greatest(b.i, b.j) AS j FROM (SELECT struct_id, unnest(bonds) AS b FROM s)),
classed AS (SELECT n.struct_id, concat_ws('_', least(el_i, el_j), greatest(el_i, el_j)) AS pair, s.i IS NOT NULL AS actual, dist <= 1.1 * reach AS near_110, dist <= 1.2 * reach AS near_120, dist <= 1.3 * reach AS near_130
  FROM near n LEFT JOIN stored s ON n.struct_id = s.struct_id AND n.i = s.i AND n.j = s.j WHERE dist <= 1.4 * reach),
long AS (SELECT 'near_110' AS scheme, pair, near_110 AS p, actual AS t FROM classed UNION ALL SELECT 'near_120', pair, near_120, actual FROM classed UNION ALL SELECT 'near_130', pair, near_130, actual FROM classed)
"""
_SCORES = """count(*) FILTER (p AND t) AS tp, count(*) FILTER (p AND NOT t) AS fp, count(*) FILTER (NOT p AND t) AS fn, count(*) FILTER (NOT p AND NOT t) AS tn"""
_F1 = """round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 9) AS "precision", round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 9) AS recall,
  round(CASE WHEN tp + fp > 0 AND tp + fn > 0 AND tp > 0 THEN 2.0 * tp / (2 * tp + fp + fn) END, 9) AS f1"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs (within 1.4 radii sums) with distance classes and whether the record lists the bond."""
    rows = _structures(spark, sf_dir)
    atoms = records.atom_rows(rows, ["struct_id"])
    near = joins.bonded_pairs(atoms, ["struct_id"], _radii(spark), 1.4)
    listed = records.bond_rows(rows, ["struct_id"]).withColumn("actual", F.lit(True))
    reach = F.col("a_radius") + F.col("b_radius")
    return near.select(
        "struct_id", F.col("a_i").alias("i"), F.col("b_i").alias("j"), F.concat_ws("_", F.least("a_el", "b_el"), F.greatest("a_el", "b_el")).alias("pair"),
        *[(F.col("dist") <= k * reach).alias(n) for n, k in (("near_110", 1.1), ("near_120", 1.2), ("near_130", 1.3))],
    ).join(listed, ["struct_id", "i", "j"], "left").withColumn("actual", F.coalesce("actual", F.lit(False)))


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.unpivot_predictions(_classified(spark, sf_dir), {n: F.col(n) for n in ("near_110", "near_120", "near_130")}, F.col("actual"), ["pair"])


@query(_CLASSIFIED + f"SELECT scheme, tp, fp, fn, tn, {_F1} FROM (SELECT scheme, {_SCORES} FROM long GROUP BY scheme)")
def f1_by_scheme(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(classify.f1_by(_long(spark, sf_dir)), 9, "precision", "recall", "f1")


@query(_CLASSIFIED + f"SELECT scheme, pair, combined, tp, fp, fn, tn, {_F1} FROM (SELECT scheme, pair, CAST(grouping(pair) AS TINYINT) AS combined, {_SCORES} FROM long GROUP BY GROUPING SETS ((scheme, pair), (scheme)))")
def f1_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(classify.f1_rollup(_long(spark, sf_dir), "pair"), 9, "precision", "recall", "f1")


@query(_CLASSIFIED.replace("SELECT n.struct_id, concat_ws", "SELECT n.struct_id, n.i, n.j, concat_ws") + """
SELECT struct_id, i, j, pair, CAST((near_110 <> actual)::INT + (near_120 <> actual)::INT + (near_130 <> actual)::INT AS INTEGER) AS n_wrong
FROM classed WHERE near_110 <> actual OR near_120 <> actual OR near_130 <> actual
""")
def disagreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify.disagreements(_classified(spark, sf_dir), {n: F.col(n) for n in ("near_110", "near_120", "near_130")}, F.col("actual"))
    return rows.select("struct_id", "i", "j", "pair", "n_wrong")


@query(_STRUCTURES + """,
b AS (SELECT struct_id, least(b.i, b.j) AS i, greatest(b.i, b.j) AS j FROM (SELECT struct_id, unnest(bonds) AS b FROM s))
SELECT least(x.el, y.el) AS el_a, greatest(x.el, y.el) AS el_b, count(*) AS n_links, count(DISTINCT b.struct_id) AS n_records
FROM b JOIN atoms x ON b.struct_id = x.struct_id AND b.i = x.i JOIN atoms y ON b.struct_id = y.struct_id AND b.j = y.i GROUP BY ALL
""")
def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _structures(spark, sf_dir)
    return profiling.pair_counts(records.element_pairs(rows, ["struct_id"]), "el_a", "el_b", ["struct_id"])


@query(_STRUCTURES + """,
v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))), 6) AS cosine
FROM v a JOIN v b ON a.vec_id <> b.vec_id AND (b.vec_id % 50 <> 0 OR a.vec_id < b.vec_id) WHERE a.vec_id % 50 = 0
""")
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosines of every 50th vector with all others, of whatever label; a pair of two such vectors once, the smaller id first."""
    from quarrystone.functions.vectors import cosine

    v = load(spark, sf_dir, "embeddings")
    a, b = (v.select(F.col("vec_id").alias(s), F.col("embedding").alias(f"e{s}")) for s in "ab")
    once = (F.col("b") % 50 != 0) | (F.col("a") < F.col("b"))
    return joins.in_blocks(a.where("a % 50 = 0"), b, "a", once).select("a", "b", F.round(cosine(F.col("ea"), F.col("eb")), 6).alias("cosine"))


@query("""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
SELECT vec_id, round(e[1] / sqrt(list_dot_product(e, e)), 8) AS first, round(list_sum(list_transform(e, lambda x: x / sqrt(list_dot_product(e, e)))), 6) AS total FROM v
""")
def unit_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarrystone.functions.vectors import unit

    u = load(spark, sf_dir, "embeddings").select("vec_id", unit(F.col("embedding")).alias("u"))
    return u.select("vec_id", F.round(F.col("u")[0], 8).alias("first"), F.round(F.aggregate("u", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


QUERIES, SQL = query.queries, query.sql
