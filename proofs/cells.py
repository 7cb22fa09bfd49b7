"""Custom properties."""

from pyspark.sql import functions as F

from veritwin.plans import cells as ce
from veritwin.plans import reports as rp

from . import fixtures as fx
from .base import plain, query

# CELL: S is the first value of (owner, type), T the last one; perturbed.
_BASE = "SELECT concat('m', user_id % 4) AS pair_id, {owner} AS owner, event_type AS udp, {value} AS value, event_id AS ord, user_id FROM {{events}}"
CELL_S = _BASE.format(
    owner="CASE WHEN user_id % 37 = 0 THEN ' ' ELSE concat('User ', user_id) END",
    value="CASE WHEN (user_id + length(event_type)) % 13 = 0 THEN ' ' WHEN user_id % 2 = 0 THEN concat('v', user_id) ELSE props END")
CELL_T = _BASE.format(
    owner="CASE WHEN user_id % 37 = 0 THEN 'ROOT' ELSE concat('USER ', user_id) END",
    value="CASE WHEN user_id % 2 = 0 AND user_id % 8 <> 0 THEN concat('v', user_id) ELSE props END"
) + " WHERE user_id % 10 <> 0 AND NOT (user_id % 9 = 0 AND event_type = 'error') UNION ALL SELECT concat('m', user_id % 4), concat('Ghost ', user_id), event_type, 'x', event_id, user_id FROM {events} WHERE event_id % 97 = 0"

CELLS_SQL = f"""cs AS (SELECT * FROM (SELECT pair_id, lower(CASE WHEN trim(owner) = '' THEN 'Root' ELSE owner END) AS owner_key, udp, value AS s_value, CASE WHEN trim(owner) = '' THEN 'Model Root' ELSE 'Entity' END AS sa,
  row_number() OVER (PARTITION BY pair_id, lower(CASE WHEN trim(owner) = '' THEN 'Root' ELSE owner END), udp ORDER BY ord) AS rn FROM ({plain(CELL_S)}) a) b WHERE rn = 1),
ct AS (SELECT * FROM (SELECT pair_id, lower(owner) AS owner_key, udp, value AS t_value, row_number() OVER (PARTITION BY pair_id, lower(owner), udp ORDER BY ord DESC) AS rn FROM ({plain(CELL_T)}) a) b WHERE rn = 1),
ow AS (SELECT DISTINCT pair_id, owner_key FROM ct),
cell0 AS (SELECT pair_id, owner_key, udp, coalesce(sa, CASE WHEN owner_key = 'root' THEN 'Model Root' ELSE 'Entity' END) AS applied_to, s_value, t_value,
  CASE WHEN s_value IS NULL THEN 'EXTRA' WHEN trim(s_value) = '' THEN 'BLANK' WHEN t_value IS NULL THEN 'MISSING' WHEN s_value = t_value THEN 'PASS' ELSE 'MISMATCH' END AS status FROM cs FULL JOIN ct USING (pair_id, owner_key, udp)),
cell AS (SELECT c.*, status = 'MISSING' AND applied_to = 'Entity' AND ow.owner_key IS NULL AS owner_absent FROM cell0 c LEFT JOIN ow USING (pair_id, owner_key))"""


def roots(T):
    return T.events.select(F.concat(F.lit("m"), (F.col("user_id") % 4).cast("string")).alias("pair_id")).distinct().withColumn("root", F.lit("Root"))


def cells(T):
    return ce.cell_reconcile(T.sql(CELL_S), T.sql(CELL_T), roots(T))


@query("cell_reconcile", f"WITH {CELLS_SQL} SELECT * FROM cell")
def _cell_reconcile(T):
    return cells(T)


@query("cell_collapse_warnings", f"""WITH c AS (SELECT pair_id, lower(trim(owner)) AS o, udp, count(*) AS n FROM ({plain(CELL_S)}) a GROUP BY ALL)
SELECT pair_id, coalesce(sum(n) FILTER (o = ''), 0)::BIGINT AS nameless, sum(n - 1)::BIGINT AS collapsed FROM c GROUP BY pair_id""")
def _cell_collapse_warnings(T):
    return ce.collapse_warnings(T.sql(CELL_S))


_COUNTS = ", ".join(f"count(*) FILTER (status = '{s}') AS {s.lower()}" for s in ce.STATUSES)


@query("by_property_rollup", f"""WITH {CELLS_SQL}, c AS (SELECT pair_id, udp, count(*) AS rows, {_COUNTS} FROM cell GROUP BY ALL)
SELECT *, CASE WHEN pass + mismatch + missing = 0 THEN 0.0 ELSE round(pass / (pass + mismatch + missing), 4) END::DOUBLE AS pass_rate, CASE WHEN pass + mismatch + missing = 0 THEN 'NOTHING TO MIGRATE' WHEN pass = pass + mismatch + missing THEN 'PASS'
  WHEN pass = 0 THEN 'FAIL - NONE MATCHED' ELSE 'REVIEW REQUIRED' END AS verdict FROM c""")
def _by_property_rollup(T):
    return ce.by_property_rollup(cells(T), ["pair_id", "udp"])


def _sides(T):
    """One row per cell and side, for the readback check."""
    c = cells(T)
    s = c.where("s_value is not null").select("pair_id", "owner_key", "udp", F.col("s_value").alias("value"))
    t = c.where("t_value is not null").select("pair_id", "owner_key", "udp", F.col("t_value").alias("value"))
    return s, t


_RELIABLE = """rl AS (SELECT pair_id, count(*) FILTER (t_value IS NOT NULL) AS decoded, count(*) FILTER (s_value IS NOT NULL AND t_value IS NOT NULL) AS checked, count(*) FILTER (s_value = t_value) AS agreed FROM cell GROUP BY pair_id),
rb AS (SELECT *, round(agreed / checked, 4) AS confidence, coalesce(agreed / checked >= {floor}, FALSE) AS reliable FROM rl)"""


@query("readback_reliability", f"WITH {CELLS_SQL}, {_RELIABLE.format(floor=0.3)} SELECT * FROM rb")
def _readback_reliability(T):
    return ce.readback_reliability(*_sides(T), floor=0.3)


@query("cell_verdict", f"""WITH {CELLS_SQL}, {_RELIABLE.format(floor=0.3)}, c AS (SELECT pair_id, {_COUNTS} FROM cell GROUP BY pair_id)
SELECT pair_id, pass + mismatch + missing AS comparable, round(100.0 * pass / (pass + mismatch + missing), 2) AS pass_rate, CASE WHEN NOT reliable THEN 'NOT VERIFIED - READBACK UNRELIABLE' WHEN pass = pass + mismatch + missing THEN 'PASS'
  WHEN pass = 0 THEN 'FAIL - NONE MATCHED' ELSE 'REVIEW REQUIRED' END AS verdict FROM c JOIN rb USING (pair_id)""")
def _cell_verdict(T):
    return ce.cell_verdict(cells(T), ce.readback_reliability(*_sides(T), floor=0.3)).select("pair_id", "comparable", "pass_rate", "verdict")


@query("gate_on_reliability", f"WITH {CELLS_SQL}, {_RELIABLE.format(floor=0.3)} SELECT pair_id, status, count(*) AS cells FROM cell WHERE pair_id IN (SELECT pair_id FROM rb WHERE reliable) GROUP BY ALL")
def _gate_on_reliability(T):
    kept = ce.gate_on_reliability(cells(T), ce.readback_reliability(*_sides(T), floor=0.3))
    return kept.groupBy("pair_id", "status").agg(F.count("*").alias("cells"))


@query("persisted_status", f"""WITH {CELLS_SQL} SELECT pair_id, owner_key, udp, CASE WHEN trim(s_value) = '' THEN 'blank source' WHEN t_value IS NULL THEN 'no' WHEN s_value = t_value THEN 'yes' ELSE 'altered' END AS persisted FROM cell WHERE s_value IS NOT NULL""")
def _persisted_status(T):
    s, t = _sides(T)
    return ce.persisted_status(s, t).select("pair_id", "owner_key", "udp", "persisted")


# Property paths over events and parts: booleans, guids, dates, short and long lists.
PATHS = """SELECT 'core.flag' AS path, CASE WHEN event_id % 3 = 0 THEN ' TRUE' WHEN event_id % 3 = 1 THEN 'false' ELSE '' END AS value FROM {events}
UNION ALL SELECT 'core.type', event_type FROM {events} UNION ALL SELECT 'core.props', props FROM {events}
UNION ALL SELECT 'other.type', concat('t ', user_id) FROM {events} UNION ALL SELECT 'core.id', concat('{{ABCDEF01-', event_id) FROM {events}
UNION ALL SELECT 'core.when', concat(event_id % 28 + 1, '/', event_id % 12 + 1, '/2021 pass ', event_id % 5) FROM {events}
UNION ALL SELECT 'ext.Source_Model', concat('model ', event_id % 9) FROM {events} UNION ALL SELECT 'ext.blank', ' ' FROM {events}
UNION ALL SELECT 'docs.lang', lang FROM {documents} UNION ALL SELECT 'docs.text', text FROM {documents}""".replace("'{{ABC", "'ABC")

_PROFILE = f"""pf AS (SELECT path, count(*) AS observed, count(*) FILTER (trim(value) <> '') AS populated, count(DISTINCT value) AS distinct_values, count(DISTINCT value) FILTER (trim(value) <> '') AS distinct_filled, max(length(value))::INTEGER AS longest,
  coalesce(bool_and(lower(trim(value)) IN ('true', 'false')) FILTER (trim(value) <> ''), FALSE) AS all_boolean, coalesce(bool_and(regexp_matches(trim(value), '^\\{{?[0-9A-Fa-f]{{8}}-')) FILTER (trim(value) <> ''), FALSE) AS all_guid,
  coalesce(bool_and(regexp_matches(trim(value), '^[0-9]{{1,4}}[-/][0-9]{{1,2}}[-/][0-9]{{1,4}}')) FILTER (trim(value) <> ''), FALSE) AS all_date, list_sort(list_distinct(list(value) FILTER (trim(value) <> ''))) AS vals FROM ({plain(PATHS)}) x GROUP BY path)"""


@query("profile_properties", f"WITH {_PROFILE} SELECT * EXCLUDE (vals), round(100.0 * populated / observed, 2) AS coverage FROM pf")
def _profile_properties(T):
    return ce.profile_properties(T.sql(PATHS))


@query("infer_property_schema", f"""WITH {_PROFILE}, s AS (SELECT *, regexp_replace(list_last(string_split(path, '.')), '[^A-Za-z0-9_]', '_', 'g') AS leaf,
  all_boolean OR (NOT all_guid AND NOT all_date AND distinct_filled BETWEEN 1 AND 12) AS is_list FROM pf),
r AS (SELECT *, row_number() OVER (PARTITION BY leaf ORDER BY path) AS rn FROM s)
SELECT CASE WHEN rn = 1 AND leaf NOT IN ('Source_ObjectID', 'Source_Extraction', 'Source_Model') THEN leaf ELSE regexp_replace(path, '[^A-Za-z0-9_]', '_', 'g') END AS udp, CASE WHEN is_list THEN 'List' ELSE 'Text' END AS type,
  CASE WHEN all_boolean THEN NULL WHEN all_guid THEN 40 WHEN all_date THEN 60 WHEN is_list THEN NULL ELSE greatest(60, least(1024, longest + 40)) END::INTEGER AS length,
  CASE WHEN all_boolean THEN ['true', 'false'] WHEN is_list THEN vals END AS value_list, path AS source_path, round(100.0 * populated / observed, 2) AS coverage, distinct_values AS distinct_observed, CASE WHEN is_list THEN 'OBSERVED' ELSE '' END AS list_source FROM r""")
def _infer_property_schema(T):
    return ce.infer_property_schema(T.sql(PATHS))


_OBJECTS = "SELECT 'm' AS pair_id, p_partkey AS object_id, p_name AS name, concat('P', p_partkey) AS code, 'x-17' AS extraction, 'parts' AS model FROM {part}"
_PROPS = "SELECT 'm' AS pair_id, l_partkey AS object_id, concat('line.', l_returnflag, l_linenumber) AS path, l_linestatus AS value FROM {lineitem}"


@query("build_manifest", f"""WITH o AS ({plain(_OBJECTS)}), p AS ({plain(_PROPS)})
SELECT object_id, name, code, udp, value, '' AS source_path FROM o, LATERAL (VALUES ('Source_ObjectID', object_id::VARCHAR), ('Source_Extraction', extraction), ('Source_Model', model)) v(udp, value)
UNION ALL SELECT o.object_id, name, code, CASE WHEN path LIKE 'line.A%' THEN concat('schema_', substr(path, 6)) ELSE substr(path, 6) END, value, path FROM p JOIN o USING (object_id)""")
def _build_manifest(T):
    props = T.sql(_PROPS)
    schema = props.where("path like 'line.A%'").select("path").distinct().select(
        F.col("path").alias("source_path"), F.concat(F.lit("schema_"), F.substring_index("path", ".", -1)).alias("udp"))
    return ce.build_manifest(T.sql(_OBJECTS), props, schema).drop("pair_id")


_MAN = "SELECT concat('m', user_id % 4) AS pair_id, lower(concat('user ', user_id)) AS owner_key, event_type AS udp, 'p' AS source_path, CASE WHEN event_id % 21 = 0 THEN ' ' ELSE props END AS value, event_id FROM {events}"
_OUTCOME = "CASE event_id % 8 WHEN 0 THEN 'Applied - Value Altered' WHEN 1 THEN 'Skipped - Entity Not Found In Target' WHEN 2 THEN 'Skipped - Property Rejected By Target' WHEN 3 THEN 'Applied - Not Verified' ELSE 'Applied - Verified' END"
RECON_SQL = f"""mn AS (SELECT *, row_number() OVER (PARTITION BY owner_key, udp, source_path ORDER BY event_id) - 1 AS occurrence FROM ({plain(_MAN)}) a),
rc AS (SELECT pair_id, owner_key, udp, value, event_id, CASE WHEN event_id % 10 = 7 THEN 'Not Verified - No Injection Result' ELSE {_OUTCOME} END AS status FROM mn),
rm AS (SELECT *, CASE status WHEN 'Applied - Verified' THEN 'Match' WHEN 'Applied - Value Altered' THEN 'Mismatch' WHEN 'Applied - Not Verified' THEN 'Unverified' ELSE 'Not Applied' END AS match FROM rc)"""


def recon(T):
    from veritwin.operators.ordered import number_within

    manifest = T.sql(_MAN)
    key = ["owner_key", "udp", "source_path"]
    outcomes = number_within(manifest, key, ["event_id"], "n").where("event_id % 10 <> 7").select(
        *key, (F.col("n") - 1).alias("occurrence"), F.expr(_OUTCOME).alias("outcome"), F.col("value").alias("target_value"))
    return ce.reconcile_outcomes(manifest, outcomes, ["event_id"])


@query("reconcile_outcomes", f"WITH {RECON_SQL} SELECT event_id, status, match FROM rm")
def _reconcile_outcomes(T):
    return recon(T).select("event_id", "status", "match")


@query("verification_rates", f"""WITH {RECON_SQL}, c AS (SELECT pair_id, count(*) AS total, count(*) FILTER (status LIKE 'Applied%') AS applied, count(*) FILTER (match = 'Match') AS verified, count(*) FILTER (match = 'Mismatch') AS altered, count(*) FILTER (status LIKE 'Skipped%') AS skipped FROM rm GROUP BY pair_id)
SELECT *, round(applied / total, 4) AS application_rate, round(verified / total, 4) AS verification_rate, CASE WHEN verified = total THEN 'PASS' WHEN applied = 0 THEN 'FAIL - NOTHING APPLIED' WHEN altered > 0 OR skipped > 0 THEN 'REVIEW REQUIRED' ELSE 'PASS' END AS verdict FROM c""")
def _verification_rates(T):
    return ce.verification_rates(recon(T))


def dictionary(T):
    """Schema and dictionary of the event properties: one is rejected, one never created."""
    types = T.events.select(F.col("event_type").alias("udp")).distinct()
    schema = types.withColumn("value_list", F.when(F.col("udp") == "click", F.array(F.lit("a"), F.lit("b")))).unionByName(
        types.where("udp = 'view'").select(F.lit("unused").alias("udp"), F.lit(None).cast("array<string>").alias("value_list")))
    owners = schema.where("udp <> 'error'").withColumn("owner", F.explode(F.array(F.lit("Entity"), F.lit("Model"))))
    action = F.when((F.col("udp") == "purchase") & (F.col("owner") == "Model"), "failed").otherwise("created")
    return schema, owners.select("udp", "owner", action.alias("action"))


_DICT_SQL = """sch AS (SELECT DISTINCT event_type AS udp, CASE WHEN event_type = 'click' THEN 2 ELSE 0 END AS n FROM events UNION ALL SELECT 'unused', 0)"""


@query("definition_rollup", f"""WITH {RECON_SQL}, {_DICT_SQL}, u AS (SELECT udp, count(*) AS expected, count(*) FILTER (status LIKE 'Applied%') AS applied, count(*) FILTER (match = 'Match') AS verified FROM rm GROUP BY udp)
SELECT udp, CASE WHEN udp = 'error' THEN NULL ELSE 'Entity, Model' END AS owners, CASE WHEN udp = 'error' THEN NULL WHEN udp = 'purchase' THEN 'Created (Entity); Failed (Model)' ELSE 'Created (Entity); Created (Model)' END AS actions,
  coalesce(expected, 0) AS expected, coalesce(applied, 0) AS applied, coalesce(verified, 0) AS verified, CASE WHEN udp = 'error' THEN 'NOT CREATED' WHEN udp = 'purchase' THEN 'FAILED' WHEN coalesce(expected, 0) = 0 THEN 'DEFINED - NO VALUES' WHEN n > 0 THEN 'DEFINED AS LIST' ELSE 'DEFINED' END AS definition_status
FROM sch LEFT JOIN u USING (udp)""")
def _definition_rollup(T):
    schema, entries = dictionary(T)
    return ce.definition_rollup(schema, entries, recon(T)).drop("value_list")


EXC_SQL = f"""{RECON_SQL}, ex AS (SELECT 'High' AS severity, 'Definition failed' AS category, '' AS owner, 'purchase' AS udp
UNION ALL SELECT 'High', CASE status WHEN 'Skipped - Entity Not Found In Target' THEN 'Entity not found' WHEN 'Skipped - Property Rejected By Target' THEN 'Property rejected' ELSE 'Value altered' END, owner_key, udp FROM rm WHERE status IN ('Skipped - Entity Not Found In Target', 'Skipped - Property Rejected By Target', 'Applied - Value Altered')
UNION ALL SELECT 'Medium', 'Not verified', owner_key, udp FROM rm WHERE status = 'Not Verified - No Injection Result' UNION ALL SELECT 'Low', 'Empty source value', owner_key, udp FROM rm WHERE trim(value) = ''
UNION ALL SELECT 'Medium', 'Unnamed entity', concat('P', p_partkey), '' FROM part WHERE p_partkey % 300 = 0 UNION ALL SELECT 'Low', 'Inferred value list', '', 'click'
UNION ALL SELECT 'Informational', 'Not carried over', '', c FROM (SELECT DISTINCT p_brand FROM part) b, (VALUES ('Glossary bindings'), ('Templates'), ('Version history')) v(c))"""


def exception_rows(T):
    schema, entries = dictionary(T)
    entities = T.part.select(F.when(F.col("p_partkey") % 300 != 0, F.col("p_name")).alias("name"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("code"))
    from .reports import part_census

    return ce.exceptions(recon(T), entries, schema, entities, rp.non_equivalence_register(part_census(T)))


@query("exceptions", f"WITH {EXC_SQL} SELECT * FROM ex")
def _exceptions(T):
    return ce.or_no_exceptions(exception_rows(T))


@query("capped_exceptions", f"""WITH {EXC_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY severity, category ORDER BY owner, udp)::INTEGER AS rank, count(*) OVER (PARTITION BY severity, category) AS rows_in_category FROM ex)
SELECT severity, category, owner, udp, rank, rows_in_category, rank <= 100 AS example FROM r""")
def _capped_exceptions(T):
    return rp.ranked_exceptions(exception_rows(T), 100)
