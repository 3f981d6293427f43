"""Queries: record quality, tracking, folders, JSON contents, scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.functions import keys, numbers
from quarrystone.operators import folders, masks, packing, profiling, quality, records, reshape, scaling
from quarrystone.plans.agreement import _CLASSIFIED, _STRUCTURES, _structures
from quarrystone.plans.base import QuerySet
from quarrystone.session import load

query = QuerySet()

# --- statuses ---------------------------------------------------------------------------
_STATUS = _STRUCTURES + """,
z AS (SELECT vertical, record_key, CASE WHEN molecule IS NULL THEN 'unreadable' WHEN len(molecule) = 0 THEN 'empty' WHEN charge IS NULL OR spin IS NULL THEN 'missing_critical'
  WHEN bonds IS NULL OR len(bonds) = 0 THEN 'no_bonds' ELSE 'ok' END AS status FROM s)
"""


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        (F.col("molecule").isNull(), "unreadable"), (F.size("molecule") == 0, "empty"), (F.col("charge").isNull() | F.col("spin").isNull(), "missing_critical"),
        (F.col("bonds").isNull() | (F.size("bonds") == 0), "no_bonds"),
    ]
    return _structures(spark, sf_dir).select("vertical", "record_key", quality.record_status(rules).alias("status"))


@query(_STATUS + "SELECT vertical, status, CAST(grouping(vertical) AS TINYINT) AS total, count(*) AS n FROM z GROUP BY GROUPING SETS ((vertical, status), (status))")
def status_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.status_counts(_statuses(spark, sf_dir), ["vertical"])


@query(_STATUS + """,
r AS (SELECT *, row_number() OVER (PARTITION BY vertical, status ORDER BY record_key) AS n FROM z WHERE status <> 'ok')
SELECT vertical, status, count(*) AS n, string_agg(CASE WHEN n <= 3 THEN record_key END, ',' ORDER BY record_key) AS keys FROM r GROUP BY vertical, status
""")
def failed_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failed_samples(_statuses(spark, sf_dir), ["vertical"], "record_key", 3)


_TYPES = _STATUS + """,
y AS (SELECT record_key, 'structure' AS type, status FROM z UNION ALL
  SELECT record_key, 'payload', CASE WHEN payload IS NULL OR trim(payload, ' ') = '' THEN 'empty' WHEN NOT json_valid(payload) THEN 'unreadable' ELSE 'ok' END FROM nested_records)
"""


def _typed_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = quality.json_category(F.col("payload"))
    nested = load(spark, sf_dir, "nested_records").select(
        "record_key", F.lit("payload").alias("type"), F.when(category == "empty", "empty").when(category == "invalid", "unreadable").otherwise("ok").alias("status")
    )
    return _statuses(spark, sf_dir).select("record_key", F.lit("structure").alias("type"), "status").unionByName(nested)


@query(_TYPES + "SELECT record_key, string_agg(DISTINCT type || ':' || status, ',' ORDER BY type || ':' || status) AS dropped FROM y WHERE status IN ('unreadable', 'empty', 'malformed', 'missing_critical') GROUP BY record_key")
def dropped_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dropped_index(_typed_statuses(spark, sf_dir), "record_key", "type")


@query(_TYPES + "SELECT record_key, vertical FROM s WHERE record_key NOT IN (SELECT record_key FROM y WHERE status IN ('unreadable', 'empty', 'malformed', 'missing_critical'))")
def filtered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quality.bad_keys(_typed_statuses(spark, sf_dir), "record_key")
    return quality.filter_records(_structures(spark, sf_dir), bad, "record_key").select("record_key", "vertical")


@query("""
SELECT file_id, CASE WHEN content IS NULL OR trim(content, ' ') = '' THEN 'empty' WHEN NOT json_valid(content) THEN 'invalid' WHEN regexp_replace(content, '\\s', '', 'g') IN ('{}', '[]') THEN 'empty_content' ELSE 'ok' END AS category
FROM job_files WHERE file_name LIKE '%.json'
""")
def json_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = load(spark, sf_dir, "job_files").where(F.col("file_name").endswith(".json"))
    return files.select("file_id", quality.json_category(F.col("content")).alias("category"))


def normal_folder_sql(column: str) -> str:
    """SQL of a folder in one spelling, as ``packing.normal_folder`` has it."""
    slashed = f"replace({column}, chr(92), '/')"
    parts = f"list_transform(list_filter(string_split({slashed}, '/'), lambda p: p <> '' AND p <> '.'), lambda p: [p])"
    step = (
        "lambda done, part: CASE WHEN part[1] = '..' AND len(done) > 0 AND done[len(done)] <> '..' THEN done[1:len(done) - 1] "
        f"WHEN part[1] = '..' AND starts_with({slashed}, '/') THEN done ELSE list_concat(done, part) END"
    )
    return f"CASE WHEN {column} IS NOT NULL THEN CASE WHEN starts_with({slashed}, '/') THEN '/' ELSE '' END || array_to_string(list_reduce(list_concat([[]::VARCHAR[]], {parts}), {step}), '/') END"


_FOLDERS_SQL = f"WITH f AS (SELECT {normal_folder_sql('folder')} AS folder, file_name, n_bytes FROM job_files)"
NEEDED = ("charge.json", "bond.json", "qtaim.json", "timings.json")


def _in_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All job files, each folder in one spelling."""
    return load(spark, sf_dir, "job_files").withColumn("folder", packing.normal_folder(F.col("folder")))


@query(_FOLDERS_SQL + """,
h AS (SELECT folder, list(DISTINCT file_name) FILTER (n_bytes > 0) AS have FROM f GROUP BY folder),
m AS (SELECT folder, list_filter(['charge.json', 'bond.json', 'qtaim.json', 'timings.json'], lambda x: NOT list_contains(coalesce(have, []), x)) AS missing FROM h)
SELECT folder, CAST(4 - len(missing) AS INTEGER) AS n_needed, array_to_string(missing, ',') AS missing, len(missing) = 0 AS complete FROM m
""")
def folder_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file counts for its folder, however that is written; files without a folder are reported under null."""
    return folders.completeness(_in_folders(spark, sf_dir), "folder", "file_name", "n_bytes", list(NEEDED))


@query("""
SELECT regexp_extract(subroot, '[^/]+/[^/]+$') AS label, count(*) AS n_files, CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM job_files GROUP BY 1
""")
def path_size_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folders.sizes_by(load(spark, sf_dir, "job_files"), folders.base_name(F.col("subroot"), 2), "n_bytes")


@query("""
SELECT file_name AS label, count(*) AS n_files, CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM job_files GROUP BY 1 ORDER BY n_bytes DESC, label LIMIT 5
""")
def top_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folders.sizes_by(load(spark, sf_dir, "job_files"), F.col("file_name"), "n_bytes").orderBy(F.desc("n_bytes"), "label").limit(5)


@query("""
SELECT subroot, CASE WHEN total_bytes < 1024 THEN printf('%.2f B', total_bytes::DOUBLE) WHEN total_bytes < 1048576 THEN printf('%.2f K', total_bytes / 1024.0::DOUBLE) ELSE printf('%.2f M', total_bytes / 1048576.0::DOUBLE) END AS size
FROM size_scan WHERE total_bytes IS NOT NULL
""")
def human_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "size_scan").where(F.col("total_bytes").isNotNull()).select("subroot", numbers.human_bytes(F.col("total_bytes")).alias("size"))


@query("""
WITH f AS (SELECT folder, count(*) AS n_files, CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM job_files GROUP BY folder)
SELECT folder, n_files, n_bytes, CAST(len(list_filter(string_split(folder, '/'), lambda p: p <> '')) AS INTEGER) AS depth FROM f
""")
def folder_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folders.scan_folders(load(spark, sf_dir, "job_files"), "folder", "n_bytes")


@query(_FOLDERS_SQL + """,
o AS (SELECT DISTINCT folder, list_filter(string_split(folder, '/'), lambda p: p <> '') AS parts, starts_with(folder, '/') AS absolute FROM f WHERE folder IS NOT NULL),
up AS (SELECT DISTINCT CASE WHEN absolute THEN '/' ELSE '' END || array_to_string(parts[1:u.k], '/') AS folder FROM o, unnest(range(0, len(parts))) AS u(k) WHERE absolute OR u.k > 0)
SELECT DISTINCT regexp_replace(folder, '/generator$', '') AS folder FROM o WHERE folder NOT IN (SELECT folder FROM up)
""")
def leaf_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves among the job folders and all their ancestors."""
    own = _in_folders(spark, sf_dir).select("folder").where(F.col("folder").isNotNull()).distinct()
    return folders.leaf_folders(own.unionByName(folders.parents(own, "folder")), "folder")


@query(_FOLDERS_SQL + """
SELECT DISTINCT replace(rtrim(CASE WHEN starts_with(folder, '/scratch/omega/') THEN folder[16:] ELSE regexp_replace(folder, '^/', '') END, '/'), '/', '__') AS key FROM f WHERE folder IS NOT NULL
""")
def key_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _in_folders(spark, sf_dir).where(F.col("folder").isNotNull())
    return own.select(keys.key_from_path(F.col("folder"), "/scratch/omega").alias("key")).distinct()


# --- contents of small JSON files ---------------------------------------------------------
_JSON = "SELECT * FROM job_files WHERE file_name LIKE '%.json' AND content IS NOT NULL AND json_valid(content) AND json_type(content) = 'OBJECT'"


@query(f"""
WITH j AS ({_JSON})
SELECT file_id, e.key AS name, round(TRY_CAST(arg_max(e.value, e.id) AS DOUBLE), 9) AS value FROM j, json_each(j.content) AS e GROUP BY file_id, e.key
""")
def json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = load(spark, sf_dir, "job_files").where(F.col("file_name").endswith(".json"))
    return reshape.json_members(files, "content", ["file_id"]).select("file_id", "name", F.round(F.col("value").try_cast("double"), 9).alias("value"))


@query("SELECT event_id, 'k' AS path, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def flatten_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.flat_leaves(load(spark, sf_dir, "events"), "props", ["event_id"])


@query(f"""
WITH j AS ({_JSON.replace("job_files", "job_files").replace("file_name LIKE '%.json'", "file_name = 'timings.json'")}),
m AS (SELECT file_id, json_keys(content) AS names FROM j)
SELECT file_id, array_to_string(list_sort(list_filter(['timings_0', 'timings_1', 'timings_2', 'timings_3'], lambda x: NOT list_contains(names, x))), ',') AS missing FROM m
""")
def tier_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = load(spark, sf_dir, "job_files").where((F.col("file_name") == "timings.json"))
    have = files.select("file_id", "file_name", F.map_keys(F.from_json("content", reshape.MAP)).alias("names")).where(F.col("names").isNotNull())
    expected = spark.createDataFrame([("timings.json", [f"timings_{i}" for i in range(4)])], "file_name string, expected array<string>")
    return quality.missing_keys(have, expected, "file_name", "names").select("file_id", "missing")


@query(f"""
WITH j AS ({_JSON}), m AS (SELECT file_name, json_keys(content) AS names FROM j),
x AS (SELECT file_name, unnest(list_filter(['0', '1', '2', '3', '4'], lambda k: NOT list_contains(names, replace(file_name, '.json', '') || '_' || k))) AS name FROM m),
n AS (SELECT file_name, name, count(*) AS n FROM x GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY n DESC, name) AS rank FROM n)
SELECT file_name, name, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3
""")
def ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = load(spark, sf_dir, "job_files").where(F.col("file_name").endswith(".json"))
    stem = F.concat(F.replace("file_name", F.lit(".json"), F.lit("")), F.lit("_"))
    names = F.transform(F.map_keys(F.from_json("content", reshape.MAP)), lambda k: F.when(F.startswith(k, stem), F.substring(k, F.length(stem) + 1, F.length(k))))
    have = files.select("file_name", names.alias("names")).where(F.col("names").isNotNull())
    missing = F.array_join(F.array_except(F.array(*[F.lit(str(i)) for i in range(5)]), "names"), ",")
    return quality.ingest_stats(have.select("file_name", missing.alias("missing")), ["file_name"], top=3)


_BOND_SQL = """
WITH f0 AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY loaded_at DESC) AS n FROM bond_files),
f AS (SELECT file_id, content FROM f0 WHERE n = 1 AND content IS NOT NULL AND json_valid(content) AND json_type(content) = 'OBJECT'),
m AS (SELECT file_id, unnest(json_keys(content)) AS name, content FROM f),
o AS (SELECT file_id, regexp_replace(name, '_bond$', '') AS scheme, json_extract(content, '$."' || name || '"') AS v FROM m),
p AS (SELECT file_id, scheme, unnest(json_keys(v)) AS pair, v FROM o WHERE json_type(v) = 'OBJECT'),
c AS (SELECT file_id, scheme, pair, TRY_CAST(json_extract_string(v, '$."' || pair || '"') AS DOUBLE) AS value,
  regexp_extract(pair, '^([0-9]+)_([^_]+)_to_([0-9]+)_([^_]+)$', ['a', 'ea', 'b', 'eb']) AS k FROM p),
bonds AS (SELECT file_id, scheme, CAST(least(k.a::INT, k.b::INT) - 1 AS INTEGER) AS i, CAST(greatest(k.a::INT, k.b::INT) - 1 AS INTEGER) AS j,
  concat_ws('_', least(k.ea, k.eb), greatest(k.ea, k.eb)) AS element_pair, value FROM c WHERE k.a <> '' AND value IS NOT NULL)
"""


def _bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = profiling.latest(load(spark, sf_dir, "bond_files"), ["file_id"], [F.desc("loaded_at")])
    return reshape.scheme_pairs_long(files, "content", ["file_id"])


@query(_BOND_SQL + "SELECT file_id, scheme, i, j, element_pair, value FROM bonds")
def bond_pair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bonds(spark, sf_dir)


@query(_BOND_SQL + """
SELECT file_id, i, j, element_pair, max(value) FILTER (scheme = 'mayer') AS mayer, max(value) FILTER (scheme = 'wiberg') AS wiberg, max(value) FILTER (scheme = 'fuzzy') AS fuzzy FROM bonds GROUP BY ALL
""")
def bond_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.wide(_bonds(spark, sf_dir), ["file_id", "i", "j", "element_pair"], "scheme", "value", ["mayer", "wiberg", "fuzzy"])


@query(_BOND_SQL + "SELECT file_id, scheme, i, j, value FROM bonds WHERE value >= 0.5")
def bond_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.bond_orders(_bonds(spark, sf_dir), ["file_id"], 0.5).select("file_id", "scheme", "i", "j", "value")


@query(_BOND_SQL + """,
metal AS (SELECT * FROM bonds WHERE scheme = 'mayer' AND value >= 0.3),
n AS (SELECT file_id, split_part(element_pair, '_', 1) AS center, split_part(element_pair, '_', 2) AS partner, value FROM metal UNION ALL SELECT file_id, split_part(element_pair, '_', 2), split_part(element_pair, '_', 1), value FROM metal)
SELECT center, partner, count(*) AS n_links, count(DISTINCT file_id) AS n_records FROM n WHERE center IN ('S', 'P') GROUP BY ALL
""")
def neighbor_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of S and P above the cutoff, from both sides where both qualify."""
    strong = _bonds(spark, sf_dir).where((F.col("scheme") == "mayer") & (F.col("value") >= 0.3))
    sides = F.split("element_pair", "_")
    both = strong.select("file_id", F.inline(F.array(F.struct(sides[0].alias("center"), sides[1].alias("partner")), F.struct(sides[1].alias("center"), sides[0].alias("partner")))))
    return profiling.pair_counts(both.where(F.col("center").isin("S", "P")), "center", "partner", ["file_id"])


@query(_CLASSIFIED.rsplit("),\nlong", 1)[0].replace("SELECT n.struct_id, concat_ws", "SELECT n.struct_id, n.i, n.j, dist, concat_ws") + """),
z AS (SELECT DISTINCT st.struct_id, st.i, st.j FROM stored st WHERE st.i <> st.j)
SELECT z.struct_id, z.i, z.j, coalesce(round(c.dist, 6), 0.0) AS dist FROM z LEFT JOIN classed c ON z.struct_id = c.struct_id AND z.i = c.i AND z.j = c.j AND c.near_110
""")
def zero_filled_bonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed bond with its length where it is short, else 0.0."""
    from quarrystone.operators import joins
    from quarrystone.plans.agreement import _radii

    rows = _structures(spark, sf_dir)
    near = joins.bonded_pairs(records.atom_rows(rows, ["struct_id"]), ["struct_id"], _radii(spark), 1.1).select("struct_id", F.col("a_i").alias("i"), F.col("b_i").alias("j"), F.round("dist", 6).alias("dist"))
    return records.zero_filled(near, records.bond_rows(rows, ["struct_id"]), ["struct_id", "i", "j"], ["dist"])


@query(_STRUCTURES + """,
v AS (SELECT vertical, lower(trim(split_name, ' ')) AS split, count(*) AS n FROM s WHERE split_name IS NOT NULL GROUP BY ALL)
SELECT vertical, coalesce(sum(n) FILTER (split = 'train'), 0)::BIGINT AS train, coalesce(sum(n) FILTER (split = 'val'), 0)::BIGINT AS val, coalesce(sum(n) FILTER (split = 'test'), 0)::BIGINT AS test FROM v GROUP BY vertical
""")
def split_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _structures(spark, sf_dir).where(F.col("split_name").isNotNull()).withColumn("split", F.lower(F.trim("split_name")))
    return rows.groupBy("vertical").pivot("split", ["train", "val", "test"]).count().fillna(0, ["train", "val", "test"])


@query(_STRUCTURES + """,
c AS (SELECT struct_id, count(*) AS n, string_agg(DISTINCT el, ',' ORDER BY el) AS els FROM atoms GROUP BY struct_id)
SELECT s.vertical, s.record_key AS rel_path, CAST(c.n AS INTEGER) AS n_atoms, abs(s.charge) AS net_charge_abs, c.els,
  CASE WHEN c.n IS NULL THEN 'missing_structure' WHEN s.charge IS NULL OR s.spin IS NULL THEN 'missing_charge_or_spin' ELSE 'ok' END AS read_status,
  CASE WHEN c.n IS NOT NULL THEN list_has_any(string_split(c.els, ','), ['FE', 'CU', 'ZN', 'PD']) END AS has_tm
FROM s LEFT JOIN c ON s.struct_id = c.struct_id
""")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = records.manifest(_structures(spark, sf_dir))
    return out.select("vertical", "rel_path", "n_atoms", "net_charge_abs", F.upper(F.col("element_set")).alias("els"), "read_status", "has_tm")


# --- tracking ------------------------------------------------------------------------------
_VALID = "lower(trim({c}, ' ')) = 'true'"


@query(f"""
SELECT subset, count(DISTINCT job_id) AS n_jobs, count(DISTINCT CASE WHEN {_VALID.format(c="val_qtaim")} AND {_VALID.format(c="val_charge")} AND {_VALID.format(c="val_bond")} THEN job_id END) AS n_valid,
  count(DISTINCT CASE WHEN {_VALID.format(c="val_qtaim")} THEN job_id END) AS n_qtaim, round(avg(CASE WHEN isfinite(TRY_CAST(trim(total_time, ' ') AS DOUBLE)) THEN TRY_CAST(trim(total_time, ' ') AS DOUBLE) END), 7) AS mean_time
FROM validation GROUP BY subset
""")
def validity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "validation")

    def valid(c: str):
        return F.lower(F.trim(c)) == "true"

    return rows.groupBy("subset").agg(
        F.count_distinct("job_id").alias("n_jobs"), F.count_distinct(F.when(valid("val_qtaim") & valid("val_charge") & valid("val_bond"), F.col("job_id"))).alias("n_valid"),
        F.count_distinct(F.when(valid("val_qtaim"), F.col("job_id"))).alias("n_qtaim"), F.round(F.avg(numbers.finite(F.when(F.trim("total_time").rlike(r"^[0-9.eE+-]+$"), F.trim("total_time").try_cast("double")))), 7).alias("mean_time"),
    )


@query("""
WITH a AS (SELECT subset, count(DISTINCT job_id) AS n_done FROM validation WHERE load_no <= 6 GROUP BY subset), p AS (SELECT subset, count(DISTINCT job_id) AS n_planned FROM validation GROUP BY subset)
SELECT p.subset, n_planned, coalesce(n_done, 0) AS n_done, round(100.0 * coalesce(n_done, 0) / n_planned, 4)::DOUBLE AS percent FROM p LEFT JOIN a ON p.subset = a.subset
""")
def expected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "validation")
    planned = rows.groupBy("subset").agg(F.count_distinct("job_id").alias("n_planned"))
    done = rows.where("load_no <= 6").groupBy("subset").agg(F.count_distinct("job_id").alias("n_done"))
    out = planned.join(done, "subset", "left").fillna(0, ["n_done"])
    return out.withColumn("percent", F.round(100.0 * F.col("n_done") / F.col("n_planned"), 4))


@query("""
WITH n AS (SELECT max(ts) AS now FROM events)
SELECT event_type, count(*) FILTER (ts > now - INTERVAL 1 DAY) AS last_day, count(*) FILTER (ts > now - INTERVAL 1 HOUR) AS last_hour, count(*) AS total, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest FROM events, n GROUP BY event_type
""")
def activity_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the last day and hour before the latest one."""
    events = load(spark, sf_dir, "events")
    rows = events.join(F.broadcast(events.agg(F.max("ts").alias("now"))))
    return rows.groupBy("event_type").agg(
        F.count_if(F.col("ts") > F.col("now") - F.expr("INTERVAL 1 DAY")).alias("last_day"), F.count_if(F.col("ts") > F.col("now") - F.expr("INTERVAL 1 HOUR")).alias("last_hour"),
        F.count(F.lit(1)).alias("total"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("latest"),
    )


@query("""
WITH l AS (SELECT load_no, val_id, lower(trim(val_qtaim, ' ')) AS q FROM validation)
SELECT load_no, count(*) AS n_rows, count(*) FILTER (q IS NULL OR q IN ('', 'none', 'null', 'nan')) AS n_absent, count(*) FILTER (q = 'true') AS n_true, count(*) FILTER (q = 'false') AS n_false FROM l GROUP BY load_no
""")
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.lower(F.trim("val_qtaim"))
    return load(spark, sf_dir, "validation").groupBy("load_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(masks.is_absent(F.col("val_qtaim"))).alias("n_absent"), F.count_if(q == "true").alias("n_true"), F.count_if(q == "false").alias("n_false")
    )


# --- scaling ---------------------------------------------------------------------------------
_FEATURES = ("lagrangian_k", "eta")
_TRAIN = """
WITH p AS (SELECT record_key, cp_key, lagrangian_k, eta, row_number() OVER (PARTITION BY record_key, cp_key ORDER BY loaded_at DESC) AS n FROM qtaim_cps),
c AS (SELECT * FROM p WHERE n = 1),
t0 AS (SELECT record_key, split_name, row_number() OVER (PARTITION BY struct_id ORDER BY loaded_at DESC) AS n FROM structure_store),
train AS (SELECT DISTINCT record_key FROM t0 WHERE n = 1 AND lower(trim(split_name, ' ')) = 'train')
"""


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = profiling.latest(load(spark, sf_dir, "qtaim_cps"), ["record_key", "cp_key"], [F.desc("loaded_at")])
    return points.select("record_key", "cp_key", "vertical", *_FEATURES, "esp_total")


@query(_TRAIN + """,
t AS (SELECT avg(lagrangian_k) AS m1, stddev_pop(lagrangian_k) AS s1, avg(eta) AS m2, stddev_pop(eta) AS s2 FROM c WHERE record_key IN (SELECT record_key FROM train))
SELECT record_key, cp_key, round((lagrangian_k - m1) / s1, 6) AS lagrangian_k, round((eta - m2) / s2, 6) AS eta, true AS scaled FROM c, t
""")
def zscore_train_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All points scaled by what the points of training records are like."""
    rows = _features(spark, sf_dir)
    train = _structures(spark, sf_dir).where(F.lower(F.trim("split_name")) == "train").select("record_key").distinct()
    scalers = scaling.merge_partials(scaling.fit_partial(rows.join(train, "record_key", "left_semi"), list(_FEATURES)))
    out = scaling.apply_zscore(rows, scalers, list(_FEATURES))
    return out.select("record_key", "cp_key", *[F.round(c, 6).alias(c) for c in _FEATURES], "scaled")


@query(_TRAIN + """
SELECT 'lagrangian_k' AS name, count(lagrangian_k) AS n, round(avg(lagrangian_k), 8) AS mean, round(stddev_pop(lagrangian_k), 6) AS std FROM c
UNION ALL SELECT 'eta', count(eta), round(avg(eta), 8), round(stddev_pop(eta), 6) FROM c
""")
def partial_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalers merged from the partial fits of every vertical."""
    merged = scaling.merge_partials(scaling.fit_partial(_features(spark, sf_dir), list(_FEATURES), ["vertical"]))
    return merged.select("name", "n", F.round("mean", 8).alias("mean"), F.round("std", 6).alias("std"))


@query("""
WITH p AS (SELECT record_key, cp_key, CASE WHEN isfinite(esp_total) THEN esp_total END AS x, row_number() OVER (PARTITION BY record_key, cp_key ORDER BY loaded_at DESC) AS n FROM qtaim_cps),
c AS (SELECT * FROM p WHERE n = 1), m AS (SELECT median(x) AS m FROM c)
SELECT record_key, cp_key, round(coalesce(x, m), 8) AS esp_total, CAST((x IS NULL)::INT AS INTEGER) AS n_imputed FROM c, m
""")
def median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scaling.impute(_features(spark, sf_dir), ["esp_total"])
    return out.select("record_key", "cp_key", F.round("esp_total", 8).alias("esp_total"), "n_imputed")


@query("""
WITH p AS (SELECT CASE WHEN isfinite(density_all) THEN density_all END AS d, CASE WHEN isfinite(esp_total) THEN esp_total END AS e FROM qtaim_cps)
SELECT 'density_all' AS name, count(*) - count(d) AS n_missing, round(median(d), 8) AS median FROM p UNION ALL SELECT 'esp_total', count(*) - count(e), round(median(e), 8) FROM p
""")
def imputation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaling.imputation_counts(load(spark, sf_dir, "qtaim_cps"), ["density_all", "esp_total"]).select("name", "n_missing", F.round("median", 8).alias("median"))


QUERIES, SQL = query.queries, query.sql
