"""Comparison of semantic models: findings, scores, gates."""

from pyspark.sql import functions as F

from veritwin.config import CONCEPTUAL, LOGICAL
from veritwin.operators import matching as m
from veritwin.operators import shaping as sh
from veritwin.plans import scoring
from veritwin.plans import semantic as sem
from veritwin.plans.findings import apply_severity, with_remedy

from . import fixtures as fx
from .base import (
    case_map, key, named_keys, norm, plain, q, query, similarity, squeeze, t_describe, t_dims_match, t_match, trim, txt, typed, ladder,
)
from .matching import (
    DOMAIN_S, DOMAIN_T, EDGE_KEYS, MEMB_DIFF, RULE_S, RULE_T, TREE_KEYS, domain_ladder, edge_ladder, edges, members, part_sides,
    rule_ladder, tree_sql, trees,
)
from .expressions import DOC_SPARK, DOC_SQL, card_sql

_S, _T = plain(fx.PART_S), plain(fx.PART_T)
_AUTO = ladder(_S, _T, ["pair_id"], named_keys())
COLS = ["pair_id", "category", "severity", "object_type", "object_name", "member", "message", "s_value", "t_value"]
SHOWN = ["pair_id", "category", "severity", "object_name", "member", "s_value", "t_value"]


def policy_sql(tier, category: str = "category") -> str:
    return case_map(category, {**tier.severities, **tier.overrides}, f"'{tier.default_severity}'")


def part_match(T):
    s, t = part_sides(T)
    return s, t, m.match_ladder(s, t, ["pair_id"], m.name_code_keys())


def part_findings(T, tier=LOGICAL):
    """All attribute findings of the PART pairs, with severities."""
    s, t, found = part_match(T)
    pairs = m.attach(found, s, t, ["pair_id"])
    s_only = found.s_only.withColumnRenamed("s_id", "id").join(s, ["pair_id", "id"])
    t_only = found.t_only.withColumnRenamed("t_id", "id").join(t, ["pair_id", "id"])
    rows = sem.compare_attributes(pairs, tier).unionByName(sem.attribute_presence(s_only, t_only, tier))
    return apply_severity(rows, tier), found


# --- SQL twin of the attribute comparison ---------------------------------------------


def pairs_sql(extra: str = "") -> str:
    """CTE ``pr``: matched PART pairs with s_* and t_* columns, types split, texts normalised."""
    cols = ["code", "name", "data_type", "length", "precision", "mandatory", "domain", "definition", "is_migrated", "ord"]
    sel = ", ".join(f"s.{c} AS s_{c}, t.{c} AS t_{c}" for c in cols)
    joined = f"SELECT lp.pair_id, lp.basis, s.id AS s_id, t.id AS t_id, {sel} FROM lp JOIN s0 s ON s.id = lp.s_id JOIN t0 t ON t.id = lp.t_id"
    return (
        f"{_AUTO}, pr AS (SELECT *, {similarity('sd', 'td')} AS sim FROM (SELECT *, lower({squeeze('s_definition')}) AS sd, "
        f"lower({squeeze('t_definition')}) AS td FROM {typed(joined, 's_data_type', 't_data_type')} a) b)")


def definition_arms(cols: str, name: str, member: str, threshold: float = 0.9, src: str = "pr", s="s_definition", t="t_definition") -> str:
    return f"""
SELECT {cols}, 'DEFINITION_LOSS' AS category, {name} AS object_name, {member} AS member, {txt(s)} AS s_value, '—' AS t_value FROM {src} WHERE {trim(s)} <> '' AND {trim(t)} = ''
UNION ALL SELECT {cols}, 'DEFINITION', {name}, {member}, '—', {txt(t)} FROM {src} WHERE {trim(s)} = '' AND {trim(t)} <> ''
UNION ALL SELECT {cols}, 'DEFINITION', {name}, {member}, {txt(s)}, {txt(t)} FROM {src} WHERE {trim(s)} <> '' AND {trim(t)} <> '' AND sim < {threshold}"""


def attribute_sql(tier=LOGICAL) -> str:
    """SELECT of (pair_id, category, object_name, member, s_value, t_value) over ``pr``."""
    m_ = "CASE WHEN s_code <> '' THEN s_code ELSE s_name END"
    match = t_match("s_data_type", "t_data_type", tier.type_mode, tier.approved_matrix)

    def dims(p):
        return f"concat('len=', CASE WHEN {p}_len = '' THEN '-' ELSE {p}_len END, ', prec=', CASE WHEN {p}_prec = '' THEN '-' ELSE {p}_prec END)"

    only = f"AND {match}" if tier.length_only_if_type_agrees else ""
    return f"""
SELECT pair_id, 'FALLBACK_MATCH' AS category, '' AS object_name, {m_} AS member, concat(s_name, ' / ', s_code) AS s_value, concat(t_name, ' / ', t_code) AS t_value FROM pr WHERE basis <> 'code'
UNION ALL SELECT pair_id, 'BUSINESS_NAME', '', {m_}, s_name, t_name FROM pr WHERE {norm('s_name')} <> {norm('t_name')}
UNION ALL SELECT pair_id, 'DATA_TYPE', '', {m_}, {t_describe('s_data_type')}, {t_describe('t_data_type')} FROM pr WHERE NOT {match}
UNION ALL SELECT pair_id, 'LENGTH_PRECISION', '', {m_}, {dims('s_data_type')}, {dims('t_data_type')} FROM pr WHERE NOT {t_dims_match('s_data_type', 't_data_type')} {only}
UNION ALL SELECT pair_id, 'MANDATORY', '', {m_}, CASE WHEN s_mandatory THEN 'Mandatory' ELSE 'Optional' END, CASE WHEN t_mandatory THEN 'Mandatory' ELSE 'Optional' END FROM pr WHERE s_mandatory <> t_mandatory
UNION ALL SELECT pair_id, 'DOMAIN', '', {m_}, CASE WHEN {trim('s_domain')} = '' THEN '(no domain)' ELSE {trim('s_domain')} END, CASE WHEN {trim('t_domain')} = '' THEN '(no domain)' ELSE {trim('t_domain')} END
  FROM pr WHERE ({trim('s_domain')} <> '' OR {trim('t_domain')} <> '') AND {norm('s_domain')} <> {norm('t_domain')}
UNION ALL {definition_arms('pair_id', "''", m_)}"""


def presence_sql(tier=LOGICAL) -> str:
    label = "CASE WHEN code <> '' THEN code ELSE name END"
    moved = "is_migrated" if tier.migrated_keys in ("info", "relationship") else "FALSE"
    typed_s = typed("SELECT pair_id, code, name, data_type FROM ls", "data_type")
    typed_t = typed("SELECT pair_id, code, name, data_type, is_migrated FROM lt", "data_type")
    return f"""
SELECT pair_id, 'ATTRIBUTE_MISSING' AS category, '' AS object_name, {label} AS member, {t_describe('data_type')} AS s_value, '—' AS t_value FROM {typed_s} a
UNION ALL SELECT pair_id, CASE WHEN {moved} THEN 'FALLBACK_MATCH' ELSE 'ATTRIBUTE_EXTRA' END, '', {label}, '—', CASE WHEN {moved} THEN {label} ELSE {t_describe('data_type')} END FROM {typed_t} a"""


def findings_sql(tier=LOGICAL) -> str:
    """CTE chain ending in ``f``: all PART findings with severities."""
    return (
        f"{pairs_sql()}, f0 AS ({attribute_sql(tier)} UNION ALL {presence_sql(tier)}), "
        f"f AS (SELECT *, {policy_sql(tier)} AS severity FROM f0 WHERE {policy_sql(tier)} <> 'IGNORE')")


@query("compare_attributes", f"WITH {pairs_sql()} {attribute_sql()}")
def _compare_attributes(T):
    s, t, found = part_match(T)
    return sem.compare_attributes(m.attach(found, s, t, ["pair_id"]), LOGICAL).select("pair_id", "category", "object_name", "member", "s_value", "t_value")


@query("compare_attributes_conceptual", f"WITH {pairs_sql()} SELECT category, count(*) AS findings FROM ({attribute_sql(CONCEPTUAL)}) x GROUP BY ALL")
def _compare_attributes_conceptual(T):
    s, t, found = part_match(T)
    return sem.compare_attributes(m.attach(found, s, t, ["pair_id"]), CONCEPTUAL).groupBy("category").agg(F.count("*").alias("findings"))


@query("attribute_presence", f"WITH {_AUTO} {presence_sql()}")
def _attribute_presence(T):
    s, t, found = part_match(T)
    s_only = found.s_only.withColumnRenamed("s_id", "id").join(s, ["pair_id", "id"])
    t_only = found.t_only.withColumnRenamed("t_id", "id").join(t, ["pair_id", "id"])
    return sem.attribute_presence(s_only, t_only, LOGICAL).select("pair_id", "category", "object_name", "member", "s_value", "t_value")


@query("apply_severity", f"WITH {findings_sql()} SELECT pair_id, category, severity, count(*) AS findings FROM f GROUP BY ALL")
def _apply_severity(T):
    return part_findings(T)[0].groupBy("pair_id", "category", "severity").agg(F.count("*").alias("findings"))


STRICT = LOGICAL.with_(overrides={"BUSINESS_NAME": "IGNORE", "DOMAIN": "CRITICAL"}, type_mode="exact", approved_matrix=False, definitions=False)
_NO_DEFS = "category NOT IN ('DEFINITION', 'DEFINITION_LOSS')"


@query("check_toggles", f"WITH {findings_sql(STRICT)} SELECT category, severity, count(*) AS findings FROM f WHERE {_NO_DEFS} GROUP BY ALL")
def _check_toggles(T):
    return part_findings(T, STRICT)[0].groupBy("category", "severity").agg(F.count("*").alias("findings"))


# --- scores ---------------------------------------------------------------------------


def part_results(T, tier=LOGICAL):
    """One row per pair: counts, score, status, identities, gate."""
    findings, found = part_findings(T, tier)
    status = [
        found.pairs.select("pair_id", F.lit("MATCHED").alias("status")), found.s_only.select("pair_id", F.lit("MISSING").alias("status")),
        found.t_only.select("pair_id", F.lit("EXTRA").alias("status"))]
    rows = status[0].unionByName(status[1]).unionByName(status[2])
    counters = scoring.join_counts(
        rows, [scoring.count_by_status(rows, "objects"), scoring.severity_counts(findings)])
    scored = scoring.count_identities(scoring.fidelity_score(counters, tier, F.col("objects_s")), ["objects"])
    return scoring.gate(scored, tier.promotion_target), findings


def results_sql(tier=LOGICAL) -> str:
    """CTE chain ending in ``res``."""
    return f"""{findings_sql(tier)},
cnt AS (SELECT pair_id, count(*) FILTER (k <> 'EXTRA') AS objects_s, count(*) FILTER (k <> 'MISSING') AS objects_t, count(*) FILTER (k = 'MATCHED') AS objects_matched,
  count(*) FILTER (k = 'MISSING') AS objects_missing, count(*) FILTER (k = 'EXTRA') AS objects_extra
  FROM (SELECT pair_id, 'MATCHED' AS k FROM lp UNION ALL SELECT pair_id, 'MISSING' FROM ls UNION ALL SELECT pair_id, 'EXTRA' FROM lt) u GROUP BY pair_id),
sev AS (SELECT pair_id, count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) FILTER (severity = 'WARNING') AS warning, count(*) FILTER (severity = 'INFO') AS info FROM f GROUP BY pair_id),
pen AS (SELECT cnt.*, coalesce(critical, 0) AS critical, coalesce(warning, 0) AS warning, coalesce(info, 0) AS info,
  least(coalesce(critical, 0) + 0.35 * coalesce(warning, 0) + 0.05 * coalesce(info, 0), greatest(objects_s, 1))::DOUBLE AS p FROM cnt LEFT JOIN sev USING (pair_id)),
sc AS (SELECT *, 100.0::DOUBLE - 100.0::DOUBLE * p / greatest(objects_s, 1)::DOUBLE AS raw FROM pen),
res AS (SELECT * EXCLUDE (p, raw), round(raw, 2) AS fidelity_score, round(raw, 8) AS fidelity_score_raw, round(raw, 2) < {tier.review_threshold} AS needs_review,
  CASE WHEN critical > 0 THEN 'FAIL' WHEN warning > 0 THEN 'WARN' ELSE 'PASS' END AS status, critical = 0 AND warning = 0 AND raw >= {tier.promotion_target} AS promote FROM sc)"""


RESULT_COLS = [
    "pair_id", "objects_s", "objects_t", "objects_matched", "objects_missing", "objects_extra", "critical", "warning", "info",
    "fidelity_score", "fidelity_score_raw", "needs_review", "status", "promote"]


@query("pair_results", f"WITH {results_sql()} SELECT {', '.join(RESULT_COLS)} FROM res")
def _pair_results(T):
    results = part_results(T)[0].withColumn("fidelity_score_raw", F.round("fidelity_score_raw", 8))
    return results.select(*RESULT_COLS)


@query("pair_counters", f"WITH {results_sql()} SELECT pair_id, objects_s, objects_t, objects_matched, objects_missing, objects_extra, critical, warning, info FROM res")
def _pair_counters(T):
    return part_results(T)[0].select("pair_id", "objects_s", "objects_t", "objects_matched", "objects_missing", "objects_extra", "critical", "warning", "info")


@query("fidelity_score", f"WITH {results_sql(CONCEPTUAL)} SELECT pair_id, fidelity_score, needs_review, status FROM res")
def _fidelity_score(T):
    return part_results(T, CONCEPTUAL)[0].select("pair_id", "fidelity_score", "needs_review", "status")


@query("clean_pairs", "SELECT p_brand AS pair_id, count(*) AS objects_matched, 0::BIGINT AS findings, 100.0::DOUBLE AS fidelity_score, 'PASS' AS status, TRUE AS promote FROM part GROUP BY p_brand")
def _clean_pairs(T):
    """T = S: nothing to report, score 100, promoted."""
    s, _ = part_sides(T)
    found = m.match_ladder(s, s, ["pair_id"], m.name_code_keys())
    findings = apply_severity(sem.compare_attributes(m.attach(found, s, s, ["pair_id"]), LOGICAL), LOGICAL)
    rows = found.pairs.select("pair_id", F.lit("MATCHED").alias("status"))
    counters = scoring.join_counts(rows, [
        scoring.count_by_status(rows, "objects"), scoring.severity_counts(findings), findings.groupBy("pair_id").agg(F.count("*").alias("findings"))])
    scored = scoring.count_identities(scoring.fidelity_score(counters, LOGICAL, F.col("objects_s")), ["objects"])
    return scoring.gate(scored).select("pair_id", "objects_matched", "findings", "fidelity_score", "status", "promote")


@query("gate", f"""WITH {results_sql()} SELECT pair_id, list_filter([CASE WHEN critical > 0 THEN 'CRITICAL_FINDINGS' END, CASE WHEN warning > 0 THEN 'WARNINGS_UNSIGNED' END,
  CASE WHEN fidelity_score_raw < 100 THEN 'BELOW_TARGET' END], lambda x: x IS NOT NULL) AS blockers, promote FROM res""")
def _gate(T):
    return part_results(T)[0].select("pair_id", "blockers", "promote")


# --- definitions ----------------------------------------------------------------------


@query("compare_definition", f"""WITH pr AS (SELECT *, {similarity('sd', 'td')} AS sim FROM (SELECT *, lower({squeeze('s_text')}) AS sd, lower({squeeze('t_text')}) AS td FROM ({DOC_SQL}) a) b)
{definition_arms('pair_id', 'id::VARCHAR', "''", s='s_text', t='t_text')}""")
def _compare_definition(T):
    return sem.compare_definition(T.sql(DOC_SPARK), LOGICAL).select("pair_id", "category", "object_name", "member", "s_value", "t_value")


# --- entities -------------------------------------------------------------------------

ENT = """SELECT e.*, CASE WHEN id % 6 = 0 THEN '' ELSE concat('area ', domain) END AS subject_area, coalesce(n_attributes, 0) AS n_attributes, id % 3 AS n_identifiers
FROM ({base}) e LEFT JOIN (SELECT l_partkey, count(*) AS n_attributes FROM {{lineitem}} GROUP BY l_partkey) l ON l_partkey = id"""


def ent(T, which):
    return T.sql(ENT.format(base=which))


_ENT_LADDER = ladder(plain(ENT.format(base=fx.PART_S)), plain(ENT.format(base=fx.PART_T)), ["pair_id"], named_keys())


def _label_sql(p: str = "") -> str:
    n, c = f"{p}name", f"{p}code"
    return f"(CASE WHEN {norm(n)} = {norm(c)} THEN {c} ELSE concat({n}, ' (', {c}, ')') END)"


@query("compare_entities", f"""WITH {_ENT_LADDER}, pr AS (SELECT *, {similarity('sd', 'td')} AS sim FROM (SELECT lp.pair_id, lp.basis, s.name AS s_name, s.code AS s_code, t.name AS t_name, t.code AS t_code,
  s.subject_area AS s_area, t.subject_area AS t_area, s.definition AS s_definition, t.definition AS t_definition, lower({squeeze('s.definition')}) AS sd, lower({squeeze('t.definition')}) AS td
  FROM lp JOIN s0 s ON s.id = lp.s_id JOIN t0 t ON t.id = lp.t_id) a)
SELECT pair_id, 'FALLBACK_MATCH' AS category, {_label_sql('s_')} AS object_name, '' AS member, concat(s_name, ' / ', s_code) AS s_value, concat(t_name, ' / ', t_code) AS t_value FROM pr WHERE basis <> 'code'
UNION ALL SELECT pair_id, 'BUSINESS_NAME', {_label_sql('s_')}, '', s_name, t_name FROM pr WHERE {norm('s_name')} <> {norm('t_name')}
UNION ALL SELECT pair_id, 'SUBJECT_AREA', {_label_sql('s_')}, '', CASE WHEN trim(s_area) = '' THEN '(none)' ELSE trim(s_area) END, CASE WHEN trim(t_area) = '' THEN '(none)' ELSE trim(t_area) END FROM pr
  WHERE (s_area <> '' OR t_area <> '') AND {norm('s_area')} <> {norm('t_area')}
UNION ALL {definition_arms('pair_id', _label_sql('s_'), "''")}
UNION ALL SELECT pair_id, 'ENTITY_MISSING', {_label_sql()}, '', concat(n_attributes, ' attributes, ', n_identifiers, ' identifiers'), '—' FROM ls
UNION ALL SELECT pair_id, 'ENTITY_EXTRA', {_label_sql()}, '', '—', concat(n_attributes, ' attributes, ', n_identifiers, ' identifiers') FROM lt""")
def _compare_entities(T):
    s, t = ent(T, fx.PART_S), ent(T, fx.PART_T)
    found = m.match_ladder(s, t, ["pair_id"], m.name_code_keys())
    s_only = found.s_only.withColumnRenamed("s_id", "id").join(s, ["pair_id", "id"])
    t_only = found.t_only.withColumnRenamed("t_id", "id").join(t, ["pair_id", "id"])
    sides = s.select("pair_id", F.lit("S").alias("side"), "subject_area").unionByName(t.select("pair_id", F.lit("T").alias("side"), "subject_area"))
    rows = sem.compare_entities(m.attach(found, s, t, ["pair_id"]), s_only, t_only, LOGICAL, sem.pairs_with_areas(sides))
    return rows.select("pair_id", "category", "object_name", "member", "s_value", "t_value")


@query("guard_pairs", """WITH e AS (SELECT p_brand AS pair_id, 'S' AS side FROM part WHERE p_brand NOT IN ('Brand#3', 'Brand#5') UNION ALL SELECT p_brand, 'T' FROM part WHERE p_brand NOT IN ('Brand#4', 'Brand#5')),
c AS (SELECT pair_id, count(*) FILTER (side = 'S') AS entities_s, count(*) FILTER (side = 'T') AS entities_t FROM e GROUP BY pair_id),
g AS (SELECT DISTINCT p_brand AS pair_id, coalesce(entities_s, 0) AS entities_s, coalesce(entities_t, 0) AS entities_t FROM part LEFT JOIN c ON c.pair_id = p_brand)
SELECT pair_id, entities_s, entities_t, CASE WHEN pair_id = 'Brand#7' THEN 'target parse error: not well formed' WHEN entities_s = 0 AND entities_t = 0 THEN 'neither side holds an entity'
  WHEN entities_t = 0 THEN 'the target holds no entity' WHEN entities_s = 0 THEN 'the source holds no entity' END AS error FROM g""")
def _guard_pairs(T):
    models, entities = guarded_input(T)
    return sem.guard_pairs(models, entities)


def guarded_input(T):
    p = T.part.select(F.col("p_brand").alias("pair_id"))
    brands = p.distinct()
    fault = F.when((F.col("pair_id") == "Brand#7") & (F.col("side") == "T"), "not well formed")
    models = brands.withColumn("side", F.explode(F.array(F.lit("S"), F.lit("T")))).withColumn("parse_error", fault)
    entities = p.where("pair_id not in ('Brand#3', 'Brand#5')").withColumn("side", F.lit("S")).unionByName(
        p.where("pair_id not in ('Brand#4', 'Brand#5')").withColumn("side", F.lit("T")))
    return models, entities


@query("guard_findings", """SELECT pair_id, 'PARSE_ERROR' AS category, 'CRITICAL' AS severity, count(*) AS findings FROM (VALUES ('Brand#3'), ('Brand#4'), ('Brand#5'), ('Brand#7')) v(pair_id) GROUP BY ALL
UNION ALL SELECT p_brand, 'PARSE_WARNING', 'WARNING', count(*) FROM (SELECT p_brand, p_name FROM part GROUP BY ALL HAVING count(*) > 1) x WHERE p_brand NOT IN ('Brand#3', 'Brand#4', 'Brand#5', 'Brand#7') GROUP BY ALL""")
def _guard_findings(T):
    guarded = sem.guard_pairs(*guarded_input(T))
    dup = sh.collision_warnings(T.part.withColumnRenamed("p_brand", "pair_id"), ["pair_id"], "p_name")
    warnings = dup.select("pair_id", F.concat(F.lit("shared by several objects: "), "code").alias("warning"))
    rows = apply_severity(sem.guard_findings(guarded, warnings), LOGICAL)
    return rows.groupBy("pair_id", "category", "severity").agg(F.count("*").alias("findings"))


# --- identifiers ----------------------------------------------------------------------


def key_pairs(T):
    """Primary keys of orders with every case: lost, added, migrated, documented, inherited."""
    x = F.col("id") % 11
    base = members(T).withColumn("k", x)
    extra = F.when(F.col("k").isin(5, 6, 7), F.concat("t_members", F.array(F.lit("ADDED_KEY")))).otherwise(F.col("t_members"))
    t_members = F.when(F.col("k").isin(5, 6, 7) & (F.col("id") % 4 > 1), F.concat("s_members", F.array(F.lit("ADDED_KEY")))).otherwise(extra)
    return base.select(
        F.concat(F.lit("pair "), (F.col("id") % 9).cast("string")).alias("pair_id"),
        F.concat(F.lit("ORDER "), F.col("id").cast("string")).alias("object_name"),
        F.lit("PK").alias("s_key_name"), F.lit("XPK").alias("t_key_name"),
        F.when(~F.col("k").isin(8, 9), F.col("s_members")).alias("s_members"),
        F.when(~F.col("k").isin(8, 10), t_members).alias("t_members"),
        F.when(F.col("k").isin(5, 6), F.array(F.lit("added key"))).when(F.col("k") == 9, t_members).otherwise(F.array().cast("array<string>")).alias("t_migrated"),
        (F.col("id") % 2 == 0).alias("is_subtype"), F.lit(False).alias("is_associative"),
        F.when(F.col("k") == 5, "Members:\nADDED_KEY\nsome prose here").otherwise("").alias("s_comment"), F.lit("").alias("t_comment"),
        F.array(F.array(F.lit("x"), F.lit("y"))).alias("t_aliases"))


_KEYS = f"""kp AS (SELECT id, id % 11 AS k, concat('ORDER ', id) AS object_name, concat('pair ', id % 9) AS pair_id, CASE WHEN id % 11 NOT IN (8, 9) THEN s_members END AS s,
  CASE WHEN id % 11 IN (8, 10) THEN NULL WHEN id % 11 IN (5, 6, 7) AND id % 4 > 1 THEN list_append(s_members, 'ADDED_KEY') WHEN id % 11 IN (5, 6, 7) THEN list_append(t_members, 'ADDED_KEY') ELSE t_members END AS t
  FROM ({MEMB_DIFF}) z),
kn AS (SELECT *, list_transform(s, lambda x: upper(replace(x, '_', ''))) AS a, list_transform(t, lambda x: upper(replace(x, '_', ''))) AS b FROM kp),
kd AS (SELECT *, list_filter(a, lambda x: NOT list_contains(b, x)) AS lost, list_distinct(list_filter(b, lambda x: NOT list_contains(a, x))) AS added FROM kn)"""


def _key_sql(tier) -> str:
    moved = "k IN (5, 6) AND len(lost) = 0 AND len(added) > 0 AND len(list_filter(added, lambda x: x <> 'ADDEDKEY')) = 0" if tier.recognise_key_migration else "FALSE"
    inherited = "len(t) > 0 AND id % 2 = 0 AND k = 9"
    return f"""WITH {_KEYS}, kc AS (SELECT pair_id, object_name, CASE
  WHEN s IS NULL AND t IS NULL THEN 'MODEL_QUALITY' WHEN s IS NULL AND {inherited} THEN 'INHERITED_IDENTITY' WHEN s IS NULL OR t IS NULL THEN 'PRIMARY_IDENTIFIER'
  WHEN (len(lost) > 0 OR len(added) > 0) AND {moved} THEN CASE WHEN k = 5 THEN 'IDENTIFIER_UNDERSPECIFIED' ELSE 'IDENTIFYING_KEY_MIGRATION' END
  WHEN len(lost) > 0 OR len(added) > 0 THEN 'PRIMARY_IDENTIFIER' WHEN a <> b THEN 'ALTERNATE_IDENTIFIER' ELSE 'IDENTIFIER_VERIFIED' END AS category,
  CASE WHEN s IS NULL AND t IS NULL THEN 'INFO' END AS explicit FROM kd)
SELECT pair_id, object_name, category, coalesce(explicit, {policy_sql(tier)}) AS severity FROM kc"""


def _compare_primary(tier):
    @query(f"compare_primary_key_{tier.name}", _key_sql(tier))
    def _run(T):
        rows = apply_severity(sem.compare_primary_key(key_pairs(T), tier), tier)
        return rows.select("pair_id", "object_name", "category", "severity")


_compare_primary(LOGICAL)
_compare_primary(CONCEPTUAL)

ALT_S = "SELECT concat('b', l_suppkey % 20) AS pair_id, l_orderkey AS entity, l_suppkey % 4 AS grp, l_partkey AS member, l_linenumber AS pos FROM {lineitem}"
ALT_T = "SELECT concat('b', l_suppkey % 20) AS pair_id, l_orderkey AS entity, l_suppkey % 4 AS grp, l_partkey AS member, l_linenumber AS pos FROM {lineitem} WHERE l_partkey % 23 <> 0"


def _alt(T, text):
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "member"))), lambda x: F.concat(F.lit("M"), x["member"].cast("string")))
    return T.sql(text).groupBy("pair_id", "entity", "grp").agg(listed.alias("members")).select(
        "pair_id", "entity", F.col("grp").alias("ord"), F.concat(F.lit("AK"), F.col("grp").cast("string")).alias("name"), "members")


def _alt_sql(text):
    return f"SELECT pair_id, entity, grp, string_agg('M' || member, '|' ORDER BY 'M' || member) AS sig FROM ({plain(text)}) a GROUP BY ALL"


@query("compare_alternate_keys", f"""WITH s AS (SELECT pair_id, entity, sig, max(grp) AS grp FROM ({_alt_sql(ALT_S)}) a GROUP BY ALL), t AS (SELECT pair_id, entity, sig, max(grp) AS grp FROM ({_alt_sql(ALT_T)}) a GROUP BY ALL)
SELECT pair_id, entity, CASE WHEN s.grp IS NOT NULL AND t.grp IS NOT NULL THEN 'IDENTIFIER_VERIFIED' ELSE 'ALTERNATE_IDENTIFIER' END AS category, 'AK' || coalesce(s.grp, t.grp) AS member FROM s FULL JOIN t USING (pair_id, entity, sig)""")
def _compare_alternate_keys(T):
    rows = sem.compare_alternate_keys(_alt(T, ALT_S), _alt(T, ALT_T), ["pair_id", "entity"])
    return rows.select("pair_id", "entity", "category", "member")


@query("list_inversion_entries", """SELECT concat('b', l_suppkey % 20) AS pair_id, l_orderkey::VARCHAR AS object_name, 'XIF' || l_linenumber AS member, 'XIF' || l_linenumber || ' → P' || l_partkey AS t_value FROM lineitem WHERE l_linenumber > 3""")
def _list_inversion_entries(T):
    rows = T.lineitem.select(
        F.concat(F.lit("b"), (F.col("l_suppkey") % 20).cast("string")).alias("pair_id"), F.col("l_orderkey").cast("string").alias("entity_key"),
        F.concat(F.lit("XIF"), F.col("l_linenumber").cast("string")).alias("name"), F.lit("").alias("code"),
        F.array(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("members"), (F.col("l_linenumber") > 3).alias("is_inversion_entry"))
    return sem.list_inversion_entries(rows).select("pair_id", "object_name", "member", "t_value")


# --- relationships --------------------------------------------------------------------

_LAB = "CASE WHEN {p}name <> '' THEN concat({p}name, ' (', {p}e1_entity, ' ↔ ', {p}e2_entity, ')') ELSE concat({p}e1_entity, ' ↔ ', {p}e2_entity) END"


def _deg(a, b):
    return f"CASE WHEN right({a}, 1) = 'n' AND right({b}, 1) = 'n' THEN 'M:N' WHEN right({a}, 1) = 'n' THEN '1:N' WHEN right({b}, 1) = 'n' THEN 'N:1' ELSE '1:1' END"


def edge_pairs() -> str:
    """CTE ``er``: matched relationships with aligned flag, label, degrees; ends of T lined up as u1, u2."""
    cols = ["name", "kind", "e1_entity", "e2_entity", "e1_role", "e2_role", "c1", "c2", "e1_dep", "e2_dep", "es", "swapped"]
    sel = ", ".join(f"s.{c} AS s_{c}, t.{c} AS t_{c}" for c in cols)

    def mir(a, b, c, d):
        return f"(({a} <> {b}) AND ({a} = {d}) AND ({b} = {c}))"

    m1, m2, n1, n2 = (f"right({x}, 1) = 'n'" for x in ("s_c1", "s_c2", "t_c1", "t_c2"))
    m1, m2, n1, n2 = (f"({x})" for x in (m1, m2, n1, n2))
    r = [f"(coalesce({x}, '') <> '')" for x in ("s_e1_role", "s_e2_role", "t_e1_role", "t_e2_role")]
    loop = f"({key('s_e1_entity')} = {key('s_e2_entity')} OR {key('t_e1_entity')} = {key('t_e2_entity')})"
    aligned = (
        f"CASE WHEN {loop} THEN CASE WHEN {mir(m1, m2, n1, n2)} THEN FALSE WHEN {m1} = {n1} AND {m2} = {n2} AND {m1} <> {m2} THEN TRUE "
        f"ELSE NOT {mir(*r)} END ELSE s_swapped = t_swapped END")
    return f"""{edge_ladder()}, e1 AS (SELECT lp.pair_id, lp.basis, lp.s_id, lp.t_id, {sel} FROM lp JOIN s0 s ON s.id = lp.s_id JOIN t0 t ON t.id = lp.t_id),
e2 AS (SELECT *, {aligned} AS aligned, {_LAB.format(p='s_')} AS label, {_deg('s_c1', 's_c2')} AS s_degree, s_es = t_es AS same FROM e1),
er AS (SELECT *, CASE WHEN aligned THEN {_deg('t_c1', 't_c2')} ELSE {_deg('t_c2', 't_c1')} END AS t_degree FROM e2)"""


@query("relationship_census", f"""WITH {edge_pairs()} SELECT pair_id, s_id, t_id, label, basis, s_degree, t_degree,
  CASE WHEN NOT same THEN 'ENDPOINTS_CHANGED' WHEN s_degree <> t_degree THEN 'CARDINALITY_CHANGED' ELSE 'MATCHED' END AS status FROM er
UNION ALL SELECT pair_id, id, NULL, {_LAB.format(p='')}, 'UNMATCHED', {_deg('c1', 'c2')}, NULL, 'MISSING' FROM ls
UNION ALL SELECT pair_id, NULL, id, {_LAB.format(p='')}, 'UNMATCHED', NULL, {_deg('c1', 'c2')}, 'EXTRA' FROM lt""")
def _relationship_census(T):
    pairs, s_only, t_only = edge_match(T)
    return sem.relationship_census(pairs, s_only.withColumnRenamed("id", "s_id"), t_only.withColumnRenamed("id", "t_id"))


def edge_match(T):
    s, t = edges(T, fx.EDGE_S), edges(T, fx.EDGE_T)
    found = m.match_ladder(s, t, ["pair_id"], m.relationship_keys())
    return (
        m.attach(found, s, t, ["pair_id"]), found.s_only.withColumnRenamed("s_id", "id").join(s, ["pair_id", "id"]),
        found.t_only.withColumnRenamed("t_id", "id").join(t, ["pair_id", "id"]))


def ends_sql() -> str:
    def arm(pos, se, sr, sc, sd, tr, tc, td):
        return f"SELECT pair_id, s_id, label, '{pos}' AS position, {se} AS entity, {sr} AS sr, {sc} AS sc, {sd} AS sd, {tr} AS tr, {tc} AS tc, {td} AS td, s_kind = 'ASSOCIATION' OR t_kind = 'ASSOCIATION' AS assoc FROM er WHERE same"

    def pick(a, b):
        return f"CASE WHEN aligned THEN {a} ELSE {b} END"

    one = arm("end 1", "s_e1_entity", "s_e1_role", "s_c1", "s_e1_dep", pick("t_e1_role", "t_e2_role"), pick("t_c1", "t_c2"), pick("t_e1_dep", "t_e2_dep"))
    two = arm("end 2", "s_e2_entity", "s_e2_role", "s_c2", "s_e2_dep", pick("t_e2_role", "t_e1_role"), pick("t_c2", "t_c1"), pick("t_e2_dep", "t_e1_dep"))
    return f"""en AS ({one} UNION ALL {two}), ef AS (
SELECT pair_id, 'OPTIONALITY' AS category, label AS object_name, concat(position, ' (', entity, ')') AS member, CASE WHEN left(sc, 1) = '1' THEN 'Mandatory' ELSE 'Optional' END AS s_value, CASE WHEN left(tc, 1) = '1' THEN 'Mandatory' ELSE 'Optional' END AS t_value FROM en WHERE (left(sc, 1) = '1') <> (left(tc, 1) = '1')
UNION ALL SELECT pair_id, 'DEPENDENCY', label, concat(position, ' (', entity, ')'), CASE WHEN sd THEN 'Dependent' ELSE 'Independent' END, CASE WHEN td THEN 'Dependent' ELSE 'Independent' END FROM en WHERE sd <> td AND NOT (assoc AND NOT sd)
UNION ALL SELECT pair_id, 'ROLE_NAME', label, concat(position, ' (', entity, ')'), CASE WHEN {trim('sr')} = '' THEN '(none)' ELSE {trim('sr')} END, CASE WHEN {trim('tr')} = '' THEN '(none)' ELSE {trim('tr')} END FROM en
  WHERE ({trim('sr')} <> '' OR {trim('tr')} <> '') AND {norm('sr')} <> {norm('tr')} AND NOT (assoc AND {trim('sr')} = ''))"""


@query("compare_relationship_ends", f"WITH {edge_pairs()}, {ends_sql()} SELECT * FROM ef")
def _compare_relationship_ends(T):
    return sem.compare_relationship_ends(edge_match(T)[0], LOGICAL).select("pair_id", "category", "object_name", "member", "s_value", "t_value")


def _rel_text(p):
    def role(x):
        return f"CASE WHEN coalesce({x}, '') = '' THEN 'relates to' ELSE {x} END"

    def cd(x):
        return f"CASE WHEN {x} = '' THEN '?' ELSE {x} END"

    return (
        f"concat({p}e1_entity, ' (', {cd(p + 'c1')}, ') ', {role(p + 'e1_role')}, ' → (', {cd(p + 'c2')}, ') ', {role(p + 'e2_role')}, ' ', "
        f"{p}e2_entity, ' [', {_deg(p + 'c1', p + 'c2')}, ']')")


@query("compare_relationships", f"""WITH {edge_pairs()}, {ends_sql()}
SELECT pair_id, 'RELATIONSHIP_MISSING' AS category, label AS object_name, '' AS member, {_rel_text('s_')} AS s_value, {_rel_text('t_')} AS t_value FROM er WHERE NOT same
UNION ALL SELECT pair_id, 'CARDINALITY', label, '', {_rel_text('s_')}, {_rel_text('t_')} FROM er WHERE same AND s_degree <> t_degree
UNION ALL SELECT pair_id, 'ASSOCIATION', label, '', s_kind, t_kind FROM er WHERE s_kind <> t_kind
UNION ALL SELECT * FROM ef
UNION ALL SELECT pair_id, 'RELATIONSHIP_MISSING', {_LAB.format(p='')}, '', {_rel_text('')}, '—' FROM ls
UNION ALL SELECT pair_id, 'RELATIONSHIP_EXTRA', {_LAB.format(p='')}, '', '—', {_rel_text('')} FROM lt""")
def _compare_relationships(T):
    return sem.compare_relationships(*edge_match(T), LOGICAL).select("pair_id", "category", "object_name", "member", "s_value", "t_value")


@query("collapsed_variance", """SELECT concat('m', c_nationkey) AS pair_id, count(*) AS relationships, min(a) AS end1, '1,1' AS end2
FROM (SELECT c_nationkey, CASE WHEN c_nationkey % 3 = 0 THEN '0,n' WHEN c_custkey % 2 = 0 THEN '0,1' ELSE '1,n' END AS a FROM customer) x GROUP BY c_nationkey HAVING count(*) >= 3 AND count(DISTINCT a) = 1""")
def _collapsed_variance(T):
    a = F.when(F.col("c_nationkey") % 3 == 0, "0,n").when(F.col("c_custkey") % 2 == 0, "0,1").otherwise("1,n")
    rows = T.customer.select(
        F.concat(F.lit("m"), F.col("c_nationkey").cast("string")).alias("pair_id"), F.struct(a.alias("cardinality")).alias("end1"),
        F.struct(F.lit("1,1").alias("cardinality")).alias("end2"))
    return sem.collapsed_variance(rows)


@query("cardinality_census", f"""WITH r AS (SELECT pair_id, e1_card AS raw FROM ({plain(fx.EDGE_S)}) a UNION ALL SELECT pair_id, e2_card FROM ({plain(fx.EDGE_S)}) a)
SELECT pair_id, raw, canonical, count(*) AS ends FROM {card_sql('r', 'raw')} x GROUP BY ALL""")
def _cardinality_census(T):
    rows = T.sql(fx.EDGE_S).select("pair_id", F.struct(F.col("e1_card").alias("cardinality")).alias("end1"), F.struct(F.col("e2_card").alias("cardinality")).alias("end2"))
    return sem.cardinality_census(rows)


# --- hierarchies ----------------------------------------------------------------------

_KID = """SELECT DISTINCT pair_id, concat(pair_id, '/', id) AS id, {c} AS child FROM ({t}) q"""


def tree_census_sql() -> str:
    s_k = _KID.format(c=norm("child"), t=plain(fx.TREE_S))
    t_k = _KID.format(c=norm("child"), t=plain(fx.TREE_T))
    return f"""{ladder(tree_sql(fx.TREE_S), tree_sql(fx.TREE_T), ['pair_id'], TREE_KEYS)},
kid AS (SELECT lp.s_id, s.child AS sc, t.child AS tc FROM lp JOIN ({s_k}) s ON s.id = lp.s_id LEFT JOIN ({t_k}) t ON t.id = lp.t_id AND t.child = s.child
  UNION ALL SELECT lp.s_id, NULL, t.child FROM lp JOIN ({t_k}) t ON t.id = lp.t_id WHERE NOT EXISTS (SELECT 1 FROM ({s_k}) s WHERE s.id = lp.s_id AND s.child = t.child)),
kc AS (SELECT s_id, count(*) FILTER (sc IS NOT NULL AND tc IS NOT NULL) AS common, count(*) FILTER (tc IS NULL) AS lost, count(*) FILTER (sc IS NULL) AS added FROM kid GROUP BY s_id),
tc AS (SELECT lp.*, s.parent AS s_parent, t.parent AS t_parent, s.name AS s_name, s.complete AS s_complete, t.complete AS t_complete, s.mutually_exclusive AS s_ex, t.mutually_exclusive AS t_ex,
  coalesce(common, 0) AS common, coalesce(lost, 0) AS lost, coalesce(added, 0) AS added FROM lp JOIN s0 s ON s.id = lp.s_id JOIN t0 t ON t.id = lp.t_id LEFT JOIN kc USING (s_id)),
ts AS (SELECT *, CASE WHEN lost > 0 OR added > 0 THEN 'STRUCTURE_DIFFERS' WHEN s_complete <> t_complete OR s_ex <> t_ex THEN 'CONSTRAINT_DIFFERS' ELSE 'MATCHED' END AS status FROM tc)"""


def tree_census(T):
    (s, s_kids), (t, t_kids) = trees(T, fx.TREE_S), trees(T, fx.TREE_T)
    found = m.match_ladder(s, t, ["pair_id"], m.hierarchy_keys())
    census = sem.hierarchy_census(m.attach(found, s, t, ["pair_id"]), s_kids, t_kids)
    s_only = found.s_only.withColumnRenamed("s_id", "id").join(s, ["pair_id", "id"])
    t_only = found.t_only.withColumnRenamed("t_id", "id").join(t, ["pair_id", "id"])
    return census, s_only, t_only


@query("hierarchy_census", f"WITH {tree_census_sql()} SELECT pair_id, s_id, t_id, basis, common, lost, added, status FROM ts")
def _hierarchy_census(T):
    return tree_census(T)[0].select("pair_id", "s_id", "t_id", "basis", "common", "lost", "added", "status")


@query("compare_hierarchies", f"""WITH {tree_census_sql()}, a AS (
SELECT pair_id, 'INHERITANCE_VERIFIED' AS category, s_name AS object_name FROM ts WHERE status = 'MATCHED'
UNION ALL SELECT pair_id, 'INHERITANCE_STRUCTURE', s_name FROM ts WHERE lost > 0 UNION ALL SELECT pair_id, 'INHERITANCE_EXTRA', s_name FROM ts WHERE added > 0
UNION ALL SELECT pair_id, 'INHERITANCE_CONSTRAINT', s_name FROM ts WHERE s_complete <> t_complete UNION ALL SELECT pair_id, 'INHERITANCE_CONSTRAINT', s_name FROM ts WHERE s_ex <> t_ex
UNION ALL SELECT pair_id, 'FALLBACK_MATCH', s_name FROM ts WHERE basis <> 'supertype'
UNION ALL SELECT pair_id, 'INHERITANCE_MISSING', name FROM ls UNION ALL SELECT pair_id, 'INHERITANCE_EXTRA', name FROM lt) SELECT *, {policy_sql(LOGICAL)} AS severity FROM a""")
def _compare_hierarchies(T):
    rows = apply_severity(sem.compare_hierarchies(*tree_census(T), LOGICAL), LOGICAL)
    return rows.select("pair_id", "category", "object_name", "severity")


# --- domains, rules, quality, items ---------------------------------------------------


@query("compare_domains", f"""WITH {domain_ladder()}, pr AS (SELECT *, {similarity('sd', 'td')} AS sim FROM (SELECT *, lower({squeeze('s_definition')}) AS sd, lower({squeeze('t_definition')}) AS td FROM
  {typed("SELECT lp.pair_id, lp.basis, s.name AS s_name, s.data_type AS s_type, t.data_type AS t_type, s.definition AS s_definition, t.definition AS t_definition FROM lp JOIN s0 s ON s.id = lp.s_id JOIN t0 t ON t.id = lp.t_id", 's_type', 't_type')} a) b)
SELECT pair_id, CASE WHEN {t_match('s_type', 't_type')} THEN 'DOMAIN_VERIFIED' ELSE 'DOMAIN' END AS category, s_name AS object_name, '' AS member, {t_describe('s_type')} AS s_value, {t_describe('t_type')} AS t_value FROM pr
UNION ALL {definition_arms('pair_id', 's_name', "''")}
UNION ALL SELECT pair_id, 'DOMAIN', name, '', {t_describe('data_type')}, '—' FROM {typed('SELECT pair_id, name, data_type FROM ls', 'data_type')} a
UNION ALL SELECT pair_id, 'DOMAIN', name, '', '—', {t_describe('data_type')} FROM {typed('SELECT pair_id, name, data_type FROM lt', 'data_type')} a""")
def _compare_domains(T):
    s, t = T.sql(DOMAIN_S), T.sql(DOMAIN_T)
    found = m.match_ladder(s, t, ["pair_id"], m.domain_keys())
    s_only = found.s_only.withColumnRenamed("s_id", "id").join(s, ["pair_id", "id"])
    t_only = found.t_only.withColumnRenamed("t_id", "id").join(t, ["pair_id", "id"])
    rows = sem.compare_domains(m.attach(found, s, t, ["pair_id"]), s_only, t_only, LOGICAL)
    return rows.select("pair_id", "category", "object_name", "member", "s_value", "t_value")


@query("compare_business_rules", f"""WITH {rule_ladder()}
SELECT lp.pair_id, 'BUSINESS_RULE' AS category, s.name AS object_name, {txt('s.expression')} AS s_value, {txt('t.expression')} AS t_value FROM lp JOIN s0 s ON s.id = lp.s_id JOIN t0 t ON t.id = lp.t_id
  WHERE lower({squeeze('s.expression')}) <> '' AND lower({squeeze('t.expression')}) <> '' AND lower({squeeze('s.expression')}) <> lower({squeeze('t.expression')})
UNION ALL SELECT pair_id, 'BUSINESS_RULE', name, {txt('expression')}, '—' FROM ls UNION ALL SELECT pair_id, 'BUSINESS_RULE', name, '—', {txt('expression')} FROM lt""")
def _compare_business_rules(T):
    s, t = T.sql(RULE_S), T.sql(RULE_T)
    found = m.match_ladder(s, t, ["pair_id"], m.rule_keys())
    s_only = found.s_only.withColumnRenamed("s_id", "id").join(s, ["pair_id", "id"])
    t_only = found.t_only.withColumnRenamed("t_id", "id").join(t, ["pair_id", "id"])
    rows = sem.compare_business_rules(m.attach(found, s, t, ["pair_id"]), s_only, t_only)
    return rows.select("pair_id", "category", "object_name", "s_value", "t_value")


@query("check_quality", """WITH n AS (SELECT c_custkey, count(o_orderkey) FILTER (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT') AS s_n,
  count(o_orderkey) FILTER (o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' AND o_totalprice > 400000) AS t_n, count(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
SELECT 'm' AS pair_id, 'MODEL_QUALITY' AS category, 'C' || c_custkey AS object_name, '0 relationships' AS t_value FROM n WHERE urgent = 0
UNION ALL SELECT 'm', 'MODEL_QUALITY', 'C' || c_custkey, '0 attributes' FROM n WHERE t_n = 0 AND s_n > 0 UNION ALL SELECT concat('r', r_regionkey), 'MODEL_METADATA', '(model)', 'Other Model' FROM region WHERE r_regionkey = 2""")
def _check_quality(T):
    some = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "1-URGENT")
    counted = T.customer.join(T.orders, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey").agg(
        m.count_when(some).alias("s_n"), m.count_when(some & (F.col("o_totalprice") > 400000)).alias("t_n"))
    code = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    base = counted.select(F.lit("m").alias("pair_id"), F.col("c_custkey").alias("id"), F.lit("").alias("name"), code.alias("code"), "s_n", "t_n")
    ends = T.orders.where("o_orderpriority = '1-URGENT'").select(F.lit("m").alias("pair_id"), F.concat(F.lit("c_"), F.col("o_custkey").cast("string")).alias("entity"))
    # One model per region; the names of all but one survive but for their spelling.
    models = T.region.select(
        F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("pair_id"), F.col("r_name").alias("s_model"),
        F.when(F.col("r_regionkey") == 2, F.lit("Other Model")).otherwise(F.lower("r_name")).alias("t_model"))
    rows = sem.check_quality(base.withColumnRenamed("t_n", "n_attributes"), ends, base.withColumnRenamed("s_n", "n_attributes"), models)
    return rows.select("pair_id", "category", "object_name", "t_value")


@query("resolve_owner_model", """SELECT concat('n', s_nationkey) AS pair_id, s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN concat('claimed ', s_suppkey) WHEN s_nationkey % 2 = 0 THEN concat('model ', s_nationkey) END AS target_model FROM supplier""")
def _resolve_owner_model(T):
    return owner_models(T).select("pair_id", "id", "target_model")


def owner_models(T):
    pair = F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("pair_id")
    shortcuts = T.supplier.select(pair, F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("").alias("code"), F.lit("Entity").alias("type"))
    claims = T.supplier.where("s_suppkey % 3 = 0").select(pair, F.col("s_suppkey").alias("id"), F.concat(F.lit("claimed "), F.col("s_suppkey").cast("string")).alias("target_model"))
    n = F.col("n_nationkey")
    model = F.concat(F.lit("model "), n.cast("string"))
    pid = F.concat(F.lit("n"), n.cast("string")).alias("pair_id")
    attached = T.nation.select(pid, model.alias("model"), F.lit(False).alias("is_extension")).unionByName(
        T.nation.where("n_nationkey % 2 = 1").select(pid, F.lit("second").alias("model"), F.lit(False).alias("is_extension"))).unionByName(
        T.nation.select(pid, F.lit("extension").alias("model"), F.lit(True).alias("is_extension")))
    return sem.resolve_owner_model(shortcuts, claims, attached)


@query("list_external_references", """SELECT concat('n', s_nationkey) AS pair_id, 'SHORTCUT' AS category, s_name AS object_name, 'VERIFIED' AS severity,
  'Entity in ' || CASE WHEN s_suppkey % 3 = 0 THEN concat('claimed ', s_suppkey) WHEN s_nationkey % 2 = 0 THEN concat('model ', s_nationkey) ELSE 'another model' END AS s_value FROM supplier""")
def _list_external_references(T):
    rows = with_remedy(apply_severity(sem.list_external_references(owner_models(T)), LOGICAL))
    return rows.select("pair_id", "category", "object_name", "severity", "s_value")


USE_S = """SELECT p_brand AS pair_id, p_partkey AS id, concat('E', p_size % 5) AS entity, lower(p_type) AS item, concat(p_name, ' ', p_partkey) AS name, concat('P', p_partkey) AS code, 'VARCHAR(10)' AS data_type FROM {part}"""
USE_T = """SELECT p_brand AS pair_id, concat('e', p_size % 5) AS entity, p_partkey AS ord, CASE WHEN p_partkey % 3 = 0 THEN concat('x', p_partkey) ELSE upper(concat(p_name, '_', p_partkey)) END AS name,
  CASE WHEN p_partkey % 4 = 0 THEN concat('Q', p_partkey) ELSE concat('P', p_partkey) END AS code, CASE WHEN p_partkey % 31 = 0 THEN 'DATE' ELSE 'VARCHAR(12)' END AS data_type FROM {part} WHERE p_partkey % 23 <> 0"""


def _uses(T):
    items = T.part.select(F.col("p_brand").alias("pair_id"), F.col("p_type").alias("item")).distinct().withColumn("data_type", F.lit("VA10"))
    unused = T.part.select(F.col("p_brand").alias("pair_id")).distinct().select("pair_id", F.lit("UNUSED").alias("item"), F.lit("").alias("data_type"))
    alias = T.part.select(F.col("p_brand").alias("pair_id"), F.concat(F.lit("E"), (F.col("p_size") % 5).cast("string")).alias("alias_key")).distinct().withColumn("t_code", F.col("alias_key"))
    everything = items.unionByName(unused)
    return everything, sem.usage_census(everything, T.sql(USE_S), T.sql(USE_T), alias, LOGICAL)


_USAGE = f"""u AS (SELECT s.pair_id, s.id, upper(s.item) AS item, t.data_type AS tt, t.pair_id IS NOT NULL AS hit FROM ({plain(USE_S)}) s LEFT JOIN ({plain(USE_T)}) t
  ON t.pair_id = s.pair_id AND upper(t.entity) = upper(s.entity) AND ({norm('t.code')} IN ({norm('s.code')}, {norm('s.name')}) OR {norm('t.name')} IN ({norm('s.code')}, {norm('s.name')}))),
uc AS (SELECT pair_id, id, item, CASE WHEN NOT hit THEN 'NOT_FOUND' WHEN tt = 'DATE' THEN 'TYPE_DIFFERS' ELSE 'ARRIVED' END AS outcome FROM u)"""


@query("usage_census", f"WITH {_USAGE} SELECT * FROM uc")
def _usage_census(T):
    return _uses(T)[1]


@query("compare_items", f"""WITH {_USAGE}, c AS (SELECT pair_id, item, count(*) AS used, count(*) FILTER (outcome <> 'ARRIVED') AS gaps FROM uc GROUP BY ALL)
SELECT pair_id, CASE WHEN gaps > 0 THEN 'DATA_ITEM' ELSE 'DATA_ITEM_VERIFIED' END AS category, item AS object_name, 'used by ' || used AS member FROM c
UNION ALL SELECT DISTINCT p_brand, 'DATA_ITEM', 'UNUSED', '' FROM part""")
def _compare_items(T):
    items, census = _uses(T)
    return sem.compare_items(items, census).select("pair_id", "category", "object_name", "member")
