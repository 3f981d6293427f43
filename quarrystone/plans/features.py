"""Queries: feature rows of atoms, bonds, vectors and job folders, with their validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.functions import keys
from quarrystone.functions.elements import SYMBOLS, TRANSITION_METALS
from quarrystone.functions.vectors import distance
from quarrystone.operators import agreement, classify, features, folders, joins, packing, profiling, quality, records, reshape, sampling
from quarrystone.plans.agreement import _CLASSIFIED, _F1, _NEAR, _POINTS, _RADII, _SCORES, _STRUCTURES, _points, _radii, _rounded, _structures
from quarrystone.plans.base import QuerySet
from quarrystone.plans.quality import _BOND_SQL, _bonds, normal_folder_sql
from quarrystone.session import load
from quarrystone.sources.geometry import parse_input

query = QuerySet()

# --- metals, cut-offs, listed bonds ------------------------------------------------------
#: How fast a bond's valence falls with its length, in ångström (Brown and Altermatt 1985).
VALENCE_FALL = 0.37
_METALS = ", ".join(f"'{SYMBOLS[z - 1].upper()}'" for low, high in TRANSITION_METALS for z in range(low, high + 1))
_METAL_SQL = _STRUCTURES + ", " + _RADII + f""",
b AS (SELECT struct_id, b.i AS i, b.j AS j FROM (SELECT struct_id, unnest(bonds) AS b FROM s)),
p AS (SELECT b.struct_id, b.i, b.j, x.el AS el_i, y.el AS el_j, exp((rx.radius + ry.radius - sqrt((x.x - y.x) ** 2 + (x.y - y.y) ** 2 + (x.z - y.z) ** 2)) / {VALENCE_FALL}) AS value
  FROM b JOIN atoms x ON b.struct_id = x.struct_id AND b.i = x.i JOIN atoms y ON b.struct_id = y.struct_id AND b.j = y.i JOIN radii rx ON rx.symbol = x.el JOIN radii ry ON ry.symbol = y.el),
m AS (SELECT * FROM (SELECT struct_id, i AS metal, el_i AS metal_el, j AS partner, el_j AS partner_el, value FROM p UNION ALL SELECT struct_id, j, el_j, i, el_i, value FROM p)
  WHERE metal_el IN ({_METALS}) AND value >= 0.3)
"""


def _metal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _structures(spark, sf_dir).select("struct_id", "molecule", F.explode("bonds").alias("b"))
    ends = {c: F.get("molecule", F.col(f"b.{c}")) for c in "ij"}
    pairs = flat.select(
        "struct_id", F.col("b.i").alias("i"), F.col("b.j").alias("j"), *[records.element(ends[c]["elem"]).alias(f"el_{c}") for c in "ij"],
        distance(*[ends[c][a] for c in "ij" for a in "xyz"]).alias("dist"),
    )
    for c in "ij":
        pairs = pairs.join(F.broadcast(_radii(spark).select(F.col("symbol").alias(f"el_{c}"), F.col("radius").alias(f"r_{c}"))), f"el_{c}")
    valence = pairs.withColumn("value", F.exp((F.col("r_i") + F.col("r_j") - F.col("dist")) / VALENCE_FALL))
    return features.metal_neighbors(valence, ["struct_id"])


@query(_METAL_SQL + "SELECT struct_id, metal, metal_el, partner, partner_el, round(value, 6) AS value FROM m")
def metal_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed bonds of transition metals, from the metal's side, with a valence of at least 0.3."""
    return _rounded(_metal_rows(spark, sf_dir), 6, "value")


@query(_METAL_SQL + "SELECT metal_el, partner_el, count(*) AS n_links, count(DISTINCT struct_id) AS n_records FROM m GROUP BY ALL")
def metal_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.pair_counts(_metal_rows(spark, sf_dir), "metal_el", "partner_el", ["struct_id"])


_CUTOFFS = (("C", "H", 1.2), ("C", "C", 1.7), ("O", "C", 1.6), ("N", "C", 1.6), ("N", "H", 1.2))


@query(_STRUCTURES + ", cut(a, b, cutoff) AS (VALUES " + ", ".join(f"('{min(a, b)}', '{max(a, b)}', {c})" for a, b, c in _CUTOFFS) + """),
n AS (SELECT x.struct_id, x.i AS xi, x.el AS xe, y.i AS yi, y.el AS ye, sqrt((x.x - y.x) ** 2 + (x.y - y.y) ** 2 + (x.z - y.z) ** 2) AS dist, cutoff
  FROM atoms x JOIN atoms y ON x.struct_id = y.struct_id AND x.i < y.i JOIN cut ON cut.a = least(x.el, y.el) AND cut.b = greatest(x.el, y.el)),
k AS (SELECT * FROM n WHERE dist <= cutoff)
SELECT struct_id, xi AS center, xe AS center_el, yi AS partner, ye AS partner_el FROM k UNION ALL SELECT struct_id, yi, ye, xi, xe FROM k
""")
def pair_cutoff_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atoms and their neighbours within a distance that depends on the two elements."""
    pairs = joins.atom_pairs(records.atom_rows(_structures(spark, sf_dir), ["struct_id"]), ["struct_id"])
    near = features.neighbors_within(pairs, spark.createDataFrame(_CUTOFFS, "el_a string, el_b string, cutoff double"))
    return near.select("struct_id", "center", "center_el", "partner", "partner_el")


@query(_CLASSIFIED + "SELECT n.struct_id, n.i, n.j, round(dist, 6) AS dist FROM near n JOIN stored t ON n.struct_id = t.struct_id AND n.i = t.i AND n.j = t.j WHERE dist > 0 AND dist <= 1.3 * reach")
def listed_bond_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of the bonds found from the geometry that the record lists as well."""
    rows = _structures(spark, sf_dir)
    near = joins.bonded_pairs(records.atom_rows(rows, ["struct_id"]), ["struct_id"], _radii(spark)).select("struct_id", F.col("a_i").alias("i"), F.col("b_i").alias("j"), F.round("dist", 6).alias("dist"))
    return features.only_listed(near, rows.select("struct_id", F.explode("bonds").alias("b")).select("struct_id", "b.i", "b.j"), ["struct_id"])


@query(_STRUCTURES + """,
b AS (SELECT DISTINCT record_key, least(b.i, b.j) AS i, greatest(b.i, b.j) AS j FROM (SELECT record_key, unnest(bonds) AS b FROM s) WHERE b.i <> b.j),
q0 AS (SELECT *, row_number() OVER (PARTITION BY record_key, cp_key ORDER BY loaded_at DESC) AS n FROM qtaim_cps),
q AS (SELECT record_key, least(split_part(cp_key, '_', 1)::INT, split_part(cp_key, '_', 2)::INT) AS i, greatest(split_part(cp_key, '_', 1)::INT, split_part(cp_key, '_', 2)::INT) AS j,
  max(CASE WHEN isfinite(lap_e_density) THEN lap_e_density END) AS lap FROM q0 WHERE n = 1 AND regexp_full_match(cp_key, '[0-9]+_[0-9]+') GROUP BY ALL)
SELECT b.record_key, b.i, b.j, lap AS lap_e_density FROM b LEFT JOIN q ON b.record_key = q.record_key AND b.i = q.i AND b.j = q.j
""")
def bond_point_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed bond with the value of its point, named in either direction; null without one."""
    from quarrystone.functions.numbers import finite

    points = _points(spark, sf_dir).select("record_key", keys.point_parts(F.col("cp_key")).alias("p"), finite(F.col("lap_e_density")).alias("lap_e_density"))
    points = points.where(F.col("p").isNotNull()).groupBy("record_key", F.col("p.i").alias("i"), F.col("p.j").alias("j")).agg(F.max("lap_e_density").alias("lap_e_density"))
    return records.bond_rows(_structures(spark, sf_dir), ["record_key"]).join(points, ["record_key", "i", "j"], "left")


@query(_STRUCTURES + """
SELECT coalesce(a.record_key, b.record_key) AS record_key, CASE WHEN a.record_key IS NULL THEN 'missing_structure' WHEN b.record_key IS NULL THEN 'missing_points' ELSE 'ok' END AS status
FROM (SELECT DISTINCT record_key FROM s WHERE molecule IS NOT NULL) a FULL JOIN (SELECT DISTINCT record_key FROM qtaim_cps) b ON a.record_key = b.record_key
""")
def graph_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which records have both a geometry and points, and what the others lack."""
    return features.both_or_failure(_structures(spark, sf_dir).where(F.col("molecule").isNotNull()), load(spark, sf_dir, "qtaim_cps"), "record_key", ("structure", "points"))


@query(_STRUCTURES + """
SELECT struct_id, CAST(count(*) AS INTEGER) AS n_kept FROM atoms WHERE el IN ('C', 'H', 'N', 'O') GROUP BY struct_id
""")
def species_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structures cut to four elements, those without any of them left out."""
    kept = F.filter("molecule", lambda a: records.element(a["elem"]).isin("C", "H", "N", "O"))
    return _structures(spark, sf_dir).select("struct_id", F.size(kept).alias("n_kept")).where("n_kept > 0")


@query(_STRUCTURES + """,
x AS (SELECT 'charged' AS list, record_key FROM s WHERE abs(charge) > 1 UNION SELECT 'nested', record_key FROM nested_records)
SELECT list, count(*) AS n_requested, count(q.record_key) AS n_hit, count(*) - count(q.record_key) AS n_missed FROM x LEFT JOIN (SELECT DISTINCT record_key FROM qtaim_cps) q ON x.record_key = q.record_key GROUP BY list
""")
def exclusion_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two lists of records to leave out, how many the points have."""
    charged = _structures(spark, sf_dir).where(F.abs("charge") > 1).select(F.lit("charged").alias("list"), "record_key")
    nested = load(spark, sf_dir, "nested_records").select(F.lit("nested").alias("list"), "record_key")
    return joins.exclusion_misses(load(spark, sf_dir, "qtaim_cps"), charged.unionByName(nested), ["record_key"], "list")


# --- points -----------------------------------------------------------------------------
@query("""
SELECT record_key, count(DISTINCT CASE WHEN NOT contains(cp_key, '_') THEN cp_key END) AS n_atom_points, count(DISTINCT CASE WHEN len(string_split(cp_key, '_')) = 2 THEN cp_key END) AS n_bcps FROM qtaim_cps GROUP BY record_key
""")
def record_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.size(F.split("cp_key", "_"))
    return load(spark, sf_dir, "qtaim_cps").groupBy("record_key").agg(
        F.count_distinct(F.when(parts == 1, F.col("cp_key"))).alias("n_atom_points"), F.count_distinct(F.when(parts == 2, F.col("cp_key"))).alias("n_bcps")
    )


_ATOM_SQL = _POINTS + """,
st0 AS (SELECT *, row_number() OVER (PARTITION BY struct_id ORDER BY loaded_at DESC) AS n FROM structure_store),
st AS (SELECT record_key, u.i - 1 AS i, upper(trim(molecule[u.i].elem, ' ')) AS el, molecule[u.i].x AS x FROM (SELECT * FROM st0 WHERE n = 1) z, unnest(range(1, len(molecule) + 1)) AS u(i)),
long AS (SELECT record_key, 'eta' AS scheme, cp_key::INT AS i, el, eta AS value FROM c WHERE NOT contains(cp_key, '_') UNION ALL SELECT record_key, 'esp', cp_key::INT, el, esp_total FROM c WHERE NOT contains(cp_key, '_')
  UNION ALL SELECT record_key, 'x', i, el, x FROM st WHERE record_key IN (SELECT record_key FROM c)),
w AS (SELECT record_key, i, min(el) AS el, count(DISTINCT el) AS k, max(value) FILTER (scheme = 'eta') AS eta, max(value) FILTER (scheme = 'esp') AS esp, max(value) FILTER (scheme = 'x') AS x FROM long GROUP BY record_key, i)
"""


@query(_ATOM_SQL + """
SELECT CAST(i AS INTEGER) AS i, record_key, el, eta, esp, x, CAST(max(i) OVER (PARTITION BY record_key) + 1 AS INTEGER) AS n_atoms FROM w WHERE record_key NOT IN (SELECT record_key FROM w WHERE k > 1)
""")
def atom_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Atoms with two point values and their place; records whose points and geometry name different elements are left out."""
    from quarrystone.functions.numbers import finite

    points = _points(spark, sf_dir).where(~F.contains("cp_key", F.lit("_"))).withColumn("i", F.col("cp_key").cast("int"))
    parts = [points.select("record_key", F.lit(n).alias("scheme"), "i", "el", finite(F.col(c)).alias("value")) for n, c in (("eta", "eta"), ("esp", "esp_total"))]
    places = records.atom_rows(_structures(spark, sf_dir), ["record_key"]).join(load(spark, sf_dir, "qtaim_cps").select("record_key").distinct(), "record_key", "left_semi")
    long = parts[0].unionByName(parts[1]).unionByName(places.select("record_key", F.lit("x").alias("scheme"), "i", "el", F.col("x").alias("value")))
    return features.atoms_wide(long, ["record_key"], ["eta", "esp", "x"])


@query(_POINTS + """,
a AS (SELECT record_key, cp_key::INT AS i, eta FROM c WHERE NOT contains(cp_key, '_'))
SELECT record_key, string_agg(i::VARCHAR, ',' ORDER BY i) AS numbers, count(eta) AS n_known, arg_max(coalesce(eta, -1.0), i) AS last_eta FROM a GROUP BY record_key
""")
def record_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's atom points as arrays in order."""
    from quarrystone.functions.numbers import finite

    atoms = _points(spark, sf_dir).where(~F.contains("cp_key", F.lit("_"))).select("record_key", F.col("cp_key").cast("int").alias("i"), finite(F.col("eta")).alias("eta"))
    out = features.ordered_arrays(atoms, ["record_key"], "i", ["i", "eta"])
    known = F.size(F.filter("eta", lambda v: v.isNotNull())).cast("bigint")
    return out.select("record_key", F.array_join("i", ",").alias("numbers"), known.alias("n_known"), F.coalesce(F.element_at("eta", -1), F.lit(-1.0)).alias("last_eta"))


@query(_POINTS + """,
long AS (SELECT vertical, el, 'eta' AS scheme_a, 'esp_total' AS scheme_b, abs(eta - esp_total) AS r FROM c UNION ALL SELECT vertical, el, 'eta', 'lagrangian_k', abs(eta - lagrangian_k) FROM c
  UNION ALL SELECT vertical, el, 'esp_total', 'lagrangian_k', abs(esp_total - lagrangian_k) FROM c),
m AS (SELECT scheme_a, scheme_b, vertical, el, median(r) AS mar, count(r) AS n FROM long WHERE el IS NOT NULL AND r IS NOT NULL GROUP BY ALL),
e AS (SELECT scheme_a, scheme_b, el, CAST(sum(n) AS BIGINT) AS n, round(sum(mar * n) / sum(n) + 1e-10, 8) AS weighted_mar FROM m GROUP BY ALL),
t AS (SELECT el FROM e GROUP BY el ORDER BY sum(n) DESC, el LIMIT 12)
SELECT e.* FROM e JOIN t ON e.el = t.el
""")
def element_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the verticals' median residuals by element and scheme pair, weighted by rows, of the twelve commonest elements."""
    pairs = agreement.scheme_pairs(_points(spark, sf_dir).where(F.col("el").isNotNull()), {c: F.col(c) for c in ("eta", "esp_total", "lagrangian_k")}, ["vertical", "el"])
    medians = agreement.pair_medians(pairs, ["scheme_a", "scheme_b", "vertical", "el"])
    per_element = medians.groupBy("scheme_a", "scheme_b", "el").agg(F.sum("n_obs").alias("n"), F.round(F.sum(F.col("mar") * F.col("n_obs")) / F.sum("n_obs") + 1e-10, 8).alias("weighted_mar"))
    top = per_element.groupBy("el").agg(F.sum("n").alias("_n")).orderBy(F.desc("_n"), "el").limit(12)
    return per_element.join(F.broadcast(top.select("el")), "el")


# --- vectors ------------------------------------------------------------------------------
_Z = "zs(symbol, z) AS (VALUES " + ", ".join(f"('{s.upper()}', {z})" for z, s in enumerate(SYMBOLS, 1)) + ")"
_METHODS = ("charge", "heavy", "radius")
_VECTORS_SQL = _STRUCTURES + ", " + _RADII + ", " + _Z + """,
g AS (SELECT struct_id, vertical, avg(x) AS mx, avg(y) AS my, avg(z0) AS mz,
  sum(zn * x) / sum(zn) AS cx, sum(zn * y) / sum(zn) AS cy, sum(zn * z0) / sum(zn) AS cz,
  avg(x) FILTER (zn > 1) AS hx, avg(y) FILTER (zn > 1) AS hy, avg(z0) FILTER (zn > 1) AS hz,
  sum(radius * x) / sum(radius) AS rx, sum(radius * y) / sum(radius) AS ry, sum(radius * z0) / sum(radius) AS rz
  FROM (SELECT a.struct_id, a.vertical, a.x, a.y, a.z AS z0, zs.z AS zn, radius FROM atoms a JOIN zs ON zs.symbol = a.el JOIN radii ON radii.symbol = a.el) GROUP BY struct_id, vertical),
v AS (SELECT struct_id, vertical, [cx - mx, cy - my, cz - mz] AS charge, CASE WHEN hx IS NOT NULL THEN [hx - mx, hy - my, hz - mz] END AS heavy, [rx - mx, ry - my, rz - mz] AS radius FROM g)
"""


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three vectors of each structure, from the centre of its atoms to their centres by nuclear charge, without hydrogen, and by radius."""
    atoms = records.atom_rows(_structures(spark, sf_dir), ["struct_id", "vertical"]).join(F.broadcast(_radii(spark).withColumnRenamed("symbol", "el")), "el").withColumn("zn", records.atomic_number(F.col("el")))
    weights = {"charge": F.col("zn").cast("double"), "heavy": F.when(F.col("zn") > 1, F.lit(1.0)), "radius": F.col("radius")}
    sums = [F.avg(a).alias(f"m_{a}") for a in "xyz"] + [F.try_divide(F.sum(w * F.col(a)), F.sum(w)).alias(f"{n}_{a}") for n, w in weights.items() for a in "xyz"]
    means = atoms.groupBy("struct_id", "vertical").agg(*sums)
    return means.select("struct_id", "vertical", *[F.when(F.col(f"{n}_x").isNotNull(), F.array(*[F.col(f"{n}_{a}") - F.col(f"m_{a}") for a in "xyz"])).alias(n) for n in weights])


@query(_VECTORS_SQL + "SELECT struct_id, " + ", ".join(f"round(sqrt({m}[1] ** 2 + {m}[2] ** 2 + {m}[3] ** 2) + 1e-10, 8) AS {m}_mag, " + ", ".join(f"round({m}[{i}] + 1e-10, 8) AS {m}_{a}" for i, a in enumerate("xyz", 1)) for m in _METHODS) + " FROM v")
def vector_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three vectors of each structure as lengths and axes; a hair is added so that halves round one way whatever the order of sums."""
    columns = [c for m in _METHODS for c in features.vector_features(F.col(m), m)]
    out = _vectors(spark, sf_dir).select("struct_id", *columns)
    return out.select("struct_id", *[F.round(F.col(c) + 1e-10, 8).alias(c) for c in out.columns[1:]])


_LENGTH = "sqrt(list_dot_product({0}, {0}))"


@query(_VECTORS_SQL + """,
p AS (""" + " UNION ALL ".join(
    f"SELECT vertical, '{a}' AS scheme_a, '{b}' AS scheme_b, {_LENGTH.format(a)} AS la, {_LENGTH.format(b)} AS lb, list_dot_product({a}, {b}) AS ab FROM v WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
    for i, a in enumerate(_METHODS) for b in _METHODS[i + 1 :]
) + """),
q AS (SELECT *, CASE WHEN la >= 1e-10 AND lb >= 1e-10 THEN ab / (la * lb) END AS c FROM p)
SELECT scheme_a, scheme_b, vertical, count(c) AS n, round(quantile_cont(c, 0.5), 6) AS cosine_p50, round(quantile_cont(c, 0.1), 6) AS cosine_p10, count(*) AS n_lengths, round(corr(la, lb), 6) AS pearson FROM q GROUP BY scheme_a, scheme_b, vertical
""")
def vector_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the three vectors of a structure lie to each other, by vertical."""
    out = agreement.vector_agreement(_vectors(spark, sf_dir), {m: F.col(m) for m in _METHODS}, "vertical")
    return _rounded(out, 6, "cosine_p50", "cosine_p10", "pearson")


# --- bonds of all schemes -----------------------------------------------------------------
_WIDE_SQL = _BOND_SQL + """,
w AS (SELECT file_id, i, j, element_pair, max(value) FILTER (scheme = 'mayer') AS mayer, max(value) FILTER (scheme = 'wiberg') AS wiberg, max(value) FILTER (scheme = 'fuzzy') AS fuzzy FROM bonds GROUP BY ALL)
"""


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.wide(_bonds(spark, sf_dir), ["file_id", "i", "j", "element_pair"], "scheme", "value", ["mayer", "wiberg", "fuzzy"])


@query(_WIDE_SQL + """,
pairs AS (SELECT element_pair, file_id || '/' || i || '/' || j AS k, 'mayer' AS scheme_a, 'wiberg' AS scheme_b, abs(mayer - wiberg) AS r FROM w UNION ALL
  SELECT element_pair, file_id || '/' || i || '/' || j, 'mayer', 'fuzzy', abs(mayer - fuzzy) FROM w UNION ALL SELECT element_pair, file_id || '/' || i || '/' || j, 'wiberg', 'fuzzy', abs(wiberg - fuzzy) FROM w),
res AS (SELECT * FROM pairs WHERE r IS NOT NULL AND isfinite(r)),
stats AS (SELECT scheme_a, scheme_b, element_pair, grouping(element_pair) AS g, round(median(r), 8) AS mar, round(quantile_cont(r, 0.75) - quantile_cont(r, 0.25), 8) AS iqr, count(*) AS n_obs
  FROM res GROUP BY GROUPING SETS ((scheme_a, scheme_b), (scheme_a, scheme_b, element_pair))),
tops AS (SELECT scheme_a, scheme_b, element_pair, 0 AS g, k, row_number() OVER (PARTITION BY scheme_a, scheme_b, element_pair ORDER BY r DESC, k) AS n FROM res UNION ALL
  SELECT scheme_a, scheme_b, NULL, 1, k, row_number() OVER (PARTITION BY scheme_a, scheme_b ORDER BY r DESC, k) FROM res),
names AS (SELECT scheme_a, scheme_b, element_pair, g, '[' || string_agg('"' || k || '"', ',' ORDER BY n) || ']' AS top_keys FROM tops WHERE n <= 5 GROUP BY ALL)
SELECT s.scheme_a, s.scheme_b, s.element_pair, s.mar, s.iqr, s.n_obs, t.top_keys FROM stats s
JOIN names t ON s.scheme_a = t.scheme_a AND s.scheme_b = t.scheme_b AND s.g = t.g AND s.element_pair IS NOT DISTINCT FROM t.element_pair
""")
def bond_noise_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residuals of bond values between schemes, over all and by pair of elements, with the bonds that differ most."""
    rows = _wide(spark, sf_dir).withColumn("k", F.concat_ws("/", "file_id", "i", "j"))
    return _rounded(agreement.noise_floor(rows, {c: F.col(c) for c in ("mayer", "wiberg", "fuzzy")}, "element_pair", "k", 5), 8, "mar", "iqr")


@query(_WIDE_SQL + f""",
long AS (SELECT 'wiberg' AS scheme, element_pair, wiberg >= 0.5 AS p, mayer >= 0.5 AS t FROM w WHERE wiberg IS NOT NULL AND mayer IS NOT NULL
  UNION ALL SELECT 'fuzzy', element_pair, fuzzy >= 0.5, mayer >= 0.5 FROM w WHERE fuzzy IS NOT NULL AND mayer IS NOT NULL)
SELECT scheme, element_pair, combined, tp, fp, fn, tn, {_F1} FROM (SELECT scheme, element_pair, CAST(grouping(element_pair) AS TINYINT) AS combined, {_SCORES} FROM long GROUP BY GROUPING SETS ((scheme, element_pair), (scheme)))
""")
def bond_scheme_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bonds by two schemes against those of a third, by pair of elements; where a scheme has no value it takes no part."""
    cells = {n: F.col(n) >= 0.5 for n in ("wiberg", "fuzzy")}
    long = classify.unpivot_predictions(_wide(spark, sf_dir), cells, F.col("mayer") >= 0.5, ["element_pair"])
    return _rounded(classify.f1_rollup(long, "element_pair"), 9, "precision", "recall", "f1")


@query(_BOND_SQL + "SELECT v.vertical, b.scheme, count(*) AS n_bonds, count(DISTINCT b.file_id) AS n_files FROM bonds b JOIN (SELECT file_id, vertical FROM f0 WHERE n = 1) v ON b.file_id = v.file_id GROUP BY ALL")
def scheme_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bond values and files of every scheme, by vertical."""
    files = profiling.latest(load(spark, sf_dir, "bond_files"), ["file_id"], [F.desc("loaded_at")])
    rows = reshape.scheme_pairs_long(files, "content", ["file_id", "vertical"])
    return rows.groupBy("vertical", "scheme").agg(F.count(F.lit(1)).alias("n_bonds"), F.count_distinct("file_id").alias("n_files"))


@query(_BOND_SQL + """
SELECT DISTINCT pair, CAST(k.a AS INTEGER) - 1 AS i, CAST(k.b AS INTEGER) - 1 AS j, k.ea AS element_i, k.eb AS element_j, least(k.a::INT, k.b::INT) || ',' || greatest(k.a::INT, k.b::INT) AS counted FROM c WHERE k.a <> ''
""")
def pair_key_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pair keys in use, as they are written and as ordered numbers from 1."""
    files = profiling.latest(load(spark, sf_dir, "bond_files"), ["file_id"], [F.desc("loaded_at")])
    members = reshape.json_members(files, "content", ["file_id"]).where(F.col("value").startswith("{"))
    pairs = members.select(F.explode(F.map_keys(F.from_json("value", reshape.MAP))).alias("pair")).distinct()
    out = pairs.select("pair", keys.pair_as_written(F.col("pair")).alias("p"), F.array_join(keys.counted_pair(F.col("pair")), ",").alias("counted"))
    return out.where(F.col("p").isNotNull()).select("pair", "p.i", "p.j", "p.element_i", "p.element_j", "counted")


# --- job folders ----------------------------------------------------------------------------
@query("SELECT record_key, CAST((row_number() OVER (ORDER BY record_key) - 1) % 4 AS INTEGER) AS shard FROM (SELECT DISTINCT record_key FROM structure_store)")
def shard_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records in order, dealt to four shards."""
    return sampling.shard_of(load(spark, sf_dir, "structure_store").select("record_key").distinct(), [F.col("record_key")], 4)


_FILES_SQL = f"WITH f AS (SELECT *, {normal_folder_sql('folder')} AS nf FROM job_files)"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "job_files").withColumn("folder", packing.normal_folder(F.col("folder")))


@query(_FILES_SQL + "SELECT DISTINCT CASE WHEN nf = '/scratch/omega' OR starts_with(nf, '/scratch/omega/') THEN '/archive/omega' || nf[15:] ELSE nf END AS folder FROM f WHERE nf IS NOT NULL")
def path_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job folders as they would lie under another root."""
    return _files(spark, sf_dir).where(F.col("folder").isNotNull()).select(folders.remapped(F.col("folder"), "/scratch/omega", "/archive/omega").alias("folder")).distinct()


@query(_FILES_SQL + """,
d AS (SELECT DISTINCT nf AS folder FROM f WHERE nf IS NOT NULL ORDER BY sha256(nf || '_5'), nf LIMIT 200), v AS (SELECT DISTINCT nf FROM f WHERE file_name = 'charge.json' AND n_bytes > 0)
SELECT folder FROM d WHERE folder IN (SELECT nf FROM v) ORDER BY sha256(folder || '_5'), folder LIMIT 20
""".replace("SELECT DISTINCT nf AS folder FROM f WHERE nf IS NOT NULL ORDER BY", "SELECT nf AS folder FROM (SELECT DISTINCT nf FROM f WHERE nf IS NOT NULL) ORDER BY"))
def folder_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty folders that have charges, drawn from ten times as many."""
    files = _files(spark, sf_dir).where(F.col("folder").isNotNull())
    return sampling.valid_choice(files, "folder", files.where((F.col("file_name") == "charge.json") & (F.col("n_bytes") > 0)), 20, 5)


@query(_FILES_SQL + "SELECT DISTINCT nf AS folder FROM f WHERE file_name = 'orca.inp' AND n_bytes > 0 AND nf NOT IN (SELECT nf FROM f WHERE file_name = 'qtaim.json' AND n_bytes > 0 AND nf IS NOT NULL)")
def orphan_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders with an input but no points."""
    files = _files(spark, sf_dir).where(F.col("n_bytes") > 0)
    return files.where(F.col("file_name") == "orca.inp").select("folder").distinct().join(files.where(F.col("file_name") == "qtaim.json").select("folder"), "folder", "left_anti")


_TYPES = ("charge", "bond", "qtaim", "timings", "fuzzy_full", "other")
_FOLDER_SQL = _FILES_SQL + r""",
l AS (SELECT nf AS folder, file_name, arg_max(coalesce(content, ''), (modified_at, file_id)) AS content FROM f WHERE nf IS NOT NULL GROUP BY ALL),
i0 AS (SELECT folder, content FROM l WHERE file_name = 'orca.inp' AND regexp_matches(content, '\*\s*xyz\s+-?[0-9]+\s+[0-9]+')),
il AS (SELECT folder, unnest(string_split(replace(content, chr(13), ''), chr(10))) AS line FROM i0),
n AS (SELECT i0.folder, CAST((SELECT count(*) FROM il WHERE il.folder = i0.folder AND regexp_full_match(line, '\s*[A-Z][a-z]?\s+[-+0-9.eE]+\s+[-+0-9.eE]+\s+[-+0-9.eE]+\s*')) AS INTEGER) AS n_atoms FROM i0),
k AS (SELECT folder, file_name, content, CASE WHEN json_valid(content) AND json_type(content) = 'OBJECT' THEN list_distinct(json_keys(content)) END AS names FROM l WHERE file_name LIKE '%.json'),
h AS (SELECT d.folder, n.n_atoms, """ + ", ".join(f"max(CASE WHEN file_name = '{t}.json' THEN coalesce(len(names), -1) END) AS n_{t}" for t in _TYPES) + r""",
  bool_or(file_name = 'bond.json' AND coalesce(list_contains(names, 'bond_0'), false)) AS has_bond, bool_or(file_name = 'other.json' AND coalesce(list_contains(names, 'other_0'), false)) AS has_other,
  bool_or(file_name = 'timings.json' AND coalesce(TRY_CAST(json_extract_string(CASE WHEN names IS NOT NULL THEN content END, '$.timings_0') AS DOUBLE) >= 1e-6, false)) AS has_time
  FROM (SELECT DISTINCT folder FROM l) d LEFT JOIN n ON d.folder = n.folder LEFT JOIN k ON d.folder = k.folder GROUP BY ALL),
v AS (SELECT folder, n_atoms, coalesce(n_charge = n_atoms, false) AS charge_ok, coalesce(n_fuzzy_full = n_atoms, false) AS fuzzy_ok, coalesce(n_qtaim = n_atoms, false) AS points_ok,
  coalesce(has_bond, false) OR coalesce(n_atoms <= 2, false) AS bonds_ok, coalesce(has_other, false) AS other_ok, coalesce(n_timings >= 1 AND (has_time OR n_atoms <= 2), false) AS timings_ok,
  coalesce(greatest(n_charge, n_bond, n_qtaim, n_timings, n_fuzzy_full, n_other) >= 1, false) AS has_outputs, coalesce(least(n_charge, n_bond, n_qtaim, n_timings, n_fuzzy_full, n_other) < 0, false) AS truncated FROM h),
w AS (SELECT *, CASE WHEN NOT has_outputs THEN 'no_outputs' WHEN charge_ok AND fuzzy_ok AND points_ok AND bonds_ok AND other_ok AND timings_ok THEN 'complete' WHEN truncated THEN 'needs_rerun' ELSE 'validation_loop' END AS class FROM v)
"""
_FLAGS = ("charge_ok", "fuzzy_ok", "points_ok", "bonds_ok", "other_ok", "timings_ok")


def _folder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per job folder: atoms of its input, validity of each kind of content in its latest version, and what is to be done."""
    files = _files(spark, sf_dir).where(F.col("folder").isNotNull())
    latest = files.groupBy("folder", "file_name").agg(F.max_by(F.coalesce("content", F.lit("")), F.struct("modified_at", "file_id")).alias("content"))
    atoms = F.size(parse_input(F.col("content"))["molecule"])
    parsed = latest.select("folder", "file_name", F.when(F.col("file_name") == "orca.inp", atoms).alias("n_atoms"), F.when(F.col("file_name").endswith(".json"), F.from_json("content", reshape.MAP)).alias("m"))

    def of(t: str) -> Column:
        return F.max(F.when(F.col("file_name") == f"{t}.json", F.struct(F.col("m").isNull().alias("bad"), F.map_keys("m").alias("names")))).alias(t)

    time = F.max(F.when(F.col("file_name") == "timings.json", F.try_element_at("m", F.lit("timings_0")).try_cast("double"))).alias("time")
    wide = parsed.groupBy("folder").agg(F.max("n_atoms").alias("n_atoms"), time, *[of(t) for t in _TYPES])
    n = F.col("n_atoms")

    def distinct(t: str) -> Column:
        return F.array_distinct(F.col(f"{t}.names"))

    rows = wide.select(
        "folder", "n_atoms", quality.per_atom_valid(distinct("charge"), n).alias("charge_ok"), quality.per_atom_valid(distinct("fuzzy_full"), n).alias("fuzzy_ok"), quality.per_atom_valid(distinct("qtaim"), n).alias("points_ok"),
        quality.bonds_valid(F.coalesce(distinct("bond"), F.array().cast("array<string>")), ["bond_0"], n).alias("bonds_ok"), F.coalesce(quality.has_all(distinct("other"), ["other_0"]), F.lit(False)).alias("other_ok"),
        (F.coalesce(F.size(distinct("timings")) >= 1, F.lit(False)) & quality.timings_valid(F.create_map(F.lit("timings_0"), F.coalesce("time", F.lit(0.0))), ["timings_0"], F.array().cast("array<string>"), F.coalesce(n, F.lit(3)))).alias("timings_ok"),
        F.coalesce(F.greatest(*[F.size(distinct(t)) for t in _TYPES]) >= 1, F.lit(False)).alias("has_outputs"), F.coalesce(F.greatest(*[F.col(f"{t}.bad").cast("int") for t in _TYPES]) == 1, F.lit(False)).alias("truncated"),
    )
    return rows.withColumn("class", quality.folder_class(F.col("has_outputs"), [F.col(f) for f in _FLAGS], F.col("truncated")))


@query(_FOLDER_SQL + "SELECT folder, n_atoms, " + ", ".join(_FLAGS) + ", class FROM w")
def folder_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folder_rows(spark, sf_dir).select("folder", "n_atoms", *_FLAGS, "class")


@query(_FOLDER_SQL + """, x AS (SELECT class, unnest(list_filter([""" + ", ".join(f"CASE WHEN NOT {f} THEN '{f[:-3]}' END" for f in _FLAGS) + """], lambda z: z IS NOT NULL)) AS step FROM w)
SELECT class, 'folders' AS step, count(*) AS n FROM w GROUP BY class UNION ALL SELECT class, step, count(*) FROM x GROUP BY ALL
""")
def step_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of each class, and of each class and step those in which the step is not valid."""
    rows = _folder_rows(spark, sf_dir)
    steps = F.filter(F.array(*[F.when(~F.col(f), F.lit(f[:-3])) for f in _FLAGS]), lambda s: s.isNotNull())
    return rows.select("class", F.explode(F.concat(F.array(F.lit("folders")), steps)).alias("step")).groupBy("class", "step").agg(F.count(F.lit(1)).alias("n"))


@query(_FOLDER_SQL + """,
c AS (SELECT k.folder, e.key AS name, TRY_CAST(arg_max(e.value, e.id) AS DOUBLE) AS value FROM k, json_each(k.content) AS e WHERE k.file_name = 'charge.json' AND k.names IS NOT NULL GROUP BY ALL),
p AS (SELECT c.folder, TRY_CAST(regexp_extract(name, '^charge_([0-9]+)$', 1) AS INTEGER) AS i, value, n_atoms FROM c JOIN n ON c.folder = n.folder)
SELECT folder, i, round(value, 9) AS value FROM p WHERE i < n_atoms AND value IS NOT NULL
""")
def atom_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The charges of each folder's atoms, only those its input has."""
    files = _files(spark, sf_dir).where(F.col("folder").isNotNull())
    latest = files.groupBy("folder", "file_name").agg(F.max_by(F.coalesce("content", F.lit("")), F.struct("modified_at", "file_id")).alias("content"))
    inputs = latest.where(F.col("file_name") == "orca.inp").select("folder", F.size(parse_input(F.col("content"))["molecule"]).alias("n_atoms"))
    charges = latest.where(F.col("file_name") == "charge.json").join(inputs, "folder").withColumn("m", F.map_from_entries(reshape.last_members(F.from_json("content", reshape.MAP))))
    return _rounded(features.indexed_features(charges, F.col("m"), "charge", ["folder"], "n_atoms"), 9, "value")


@query(_FILES_SQL + """,
o AS (SELECT file_id, 'other_' || e.key AS name, TRY_CAST(arg_max(e.value, e.id) AS DOUBLE) AS value FROM f, json_each(f.content) AS e
  WHERE file_name = 'other.json' AND content IS NOT NULL AND json_valid(content) AND json_type(content) = 'OBJECT' GROUP BY ALL)
SELECT file_id, name, round(CASE WHEN isfinite(value) THEN value WHEN value IS NOT NULL THEN 0.0 END, 9) AS value FROM o
""")
def global_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named numbers of each record under prefixed names, what is not finite as 0."""
    files = load(spark, sf_dir, "job_files").where(F.col("file_name") == "other.json").withColumn("m", F.map_from_entries(reshape.last_members(F.from_json("content", reshape.MAP))))
    return files.select("file_id", F.explode(reshape.prefixed_globals(F.col("m"), "other_")).alias("name", "value")).withColumn("value", F.round("value", 9))


def reaction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per reaction: charges of both sides, missing ones as the median of their side (``n_imputed``), and how many sites and links each has."""
    from quarrystone.operators import flatten, scaling

    children = flatten.flatten_records(load(spark, sf_dir, "nested_records")).where(F.col("child").isin("molecule", "site", "link"))
    side = F.split("child_key", "/")[0]
    counts = [F.count_if((F.col("child") == c) & (side == s)).alias(f"{s}_{c}s") for s in ("reactant", "product") for c in ("site", "link")]
    charges = [F.max(F.when((F.col("child") == "molecule") & (side == s), F.col("value"))).alias(f"{s}_charge") for s in ("reactant", "product")]
    return scaling.impute(children.groupBy("rec_id").agg(*charges, *counts), ["reactant_charge", "product_charge"])


query()(reaction_rows)

QUERIES, SQL = query.queries, query.sql
