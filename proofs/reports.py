"""Report tables, complexity, workflow."""

from pyspark.sql import functions as F


from veritwin.plans import flow
from veritwin.plans import reports as rp

from .base import case_map, query
from .semantic import findings_sql, part_findings, part_results, results_sql

# --- fleet ----------------------------------------------------------------------------


@query("fleet_dashboard", f"""WITH {results_sql()} SELECT count(*) AS pairs, count(*) FILTER (status = 'PASS') AS pass, count(*) FILTER (status = 'WARN') AS warn, count(*) FILTER (status = 'FAIL') AS fail, 0::BIGINT AS error,
  round(avg(fidelity_score), 4) AS average_score, count(*) FILTER (needs_review) AS needs_review, count(*) FILTER (promote) AS promoted, count(*) FILTER (NOT promote) AS held, sum(critical)::BIGINT AS critical, sum(warning)::BIGINT AS warning, sum(info)::BIGINT AS info, sum(objects_s)::BIGINT AS objects_compared FROM res""")
def _fleet_dashboard(T):
    return rp.fleet_dashboard(part_results(T)[0])


@query("worst_pairs", f"""WITH {results_sql().replace('res AS (', 'res AS MATERIALIZED (')}, r AS (SELECT *, row_number() OVER (ORDER BY fidelity_score, critical DESC, pair_id) AS rn FROM res)
SELECT pair_id, fidelity_score, critical, status FROM r WHERE rn <= 15""")
def _worst_pairs(T):
    return rp.worst_pairs(part_results(T)[0], 15).select("pair_id", "fidelity_score", "critical", "status")


@query("category_analysis", f"""WITH {findings_sql()} SELECT category, count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) FILTER (severity = 'WARNING') AS warning, count(*) FILTER (severity = 'INFO') AS info, count(*) FILTER (severity = 'VERIFIED') AS verified, count(*) AS total, count(DISTINCT pair_id) AS pairs FROM f GROUP BY category""")
def _category_analysis(T):
    return rp.category_analysis(part_findings(T)[0])


@query("summary_with_totals", f"""WITH {results_sql()} SELECT pair_id, objects_s, objects_matched, critical, warning, info, fidelity_score FROM res UNION ALL SELECT 'TOTAL', sum(objects_s)::BIGINT, sum(objects_matched)::BIGINT, sum(critical)::BIGINT, sum(warning)::BIGINT, sum(info)::BIGINT, round(avg(fidelity_score), 2) FROM res""")
def _summary_with_totals(T):
    return rp.summary_with_totals(part_results(T)[0], ["objects_s", "objects_matched", "critical", "warning", "info"])


_RANK = "CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'WARNING' THEN 1 WHEN 'INFO' THEN 2 ELSE 3 END"


@query("top_findings", f"""WITH {findings_sql()}, r AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY {_RANK}, category, object_name, member) AS rn FROM f)
SELECT pair_id, category, severity, member, rn::INTEGER AS rank, severity NOT IN ('CRITICAL', 'WARNING', 'ERROR') AND rn > 50 AS omitted FROM r""")
def _top_findings(T):
    return rp.top_findings(part_findings(T)[0], 50).select("pair_id", "category", "severity", "member", "rank", "omitted")


@query("entity_matrix", f"""WITH {findings_sql()}, o AS (SELECT pair_id, s_id AS id, 'MATCHED' AS status, code FROM lp JOIN s0 USING (pair_id) WHERE s0.id = lp.s_id UNION ALL SELECT pair_id, id, 'MISSING', code FROM ls),
l AS (SELECT l_partkey AS id, CASE WHEN l_orderkey % 5 = 0 THEN 'MISSING' WHEN l_orderkey % 7 = 0 THEN 'EXTRA' ELSE 'MATCHED' END AS st FROM lineitem),
k AS (SELECT id, count(*) FILTER (st <> 'EXTRA') AS children_s, count(*) FILTER (st <> 'MISSING') AS children_t, count(*) FILTER (st = 'MATCHED') AS children_matched, count(*) FILTER (st = 'MISSING') AS children_missing, count(*) FILTER (st = 'EXTRA') AS children_extra FROM l GROUP BY id),
v AS (SELECT pair_id, member AS code, count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) FILTER (severity = 'WARNING') AS warning, count(*) FILTER (severity = 'INFO') AS info FROM f GROUP BY ALL)
SELECT pair_id, code, status, coalesce(children_s, 0) AS children_s, coalesce(children_t, 0) AS children_t, coalesce(children_matched, 0) AS children_matched, coalesce(children_missing, 0) AS children_missing, coalesce(children_extra, 0) AS children_extra,
  coalesce(critical, 0) AS critical, coalesce(warning, 0) AS warning, coalesce(info, 0) AS info FROM o LEFT JOIN k USING (id) LEFT JOIN v USING (pair_id, code)""")
def _entity_matrix(T):
    from .matching import part_sides

    findings, found = part_findings(T)
    s, _ = part_sides(T)
    status = found.pairs.select("pair_id", F.col("s_id").alias("id"), F.lit("MATCHED").alias("status")).unionByName(
        found.s_only.select("pair_id", F.col("s_id").alias("id"), F.lit("MISSING").alias("status")))
    objects = status.join(s.select("pair_id", "id", "code"), ["pair_id", "id"]).drop("id")
    child = F.when(F.col("l_orderkey") % 5 == 0, "MISSING").when(F.col("l_orderkey") % 7 == 0, "EXTRA").otherwise("MATCHED")
    children = T.lineitem.select(F.col("l_partkey").alias("id"), child.alias("status")).join(s.select("pair_id", "id", "code"), "id").drop("id")
    marks = findings.select("pair_id", F.col("member").alias("code"), "severity")
    return rp.object_matrix(objects, children, marks, ["pair_id", "code"])


# --- complexity -----------------------------------------------------------------------


def part_census(T):
    """A census per brand, its counts made from parts."""
    n = F.count("*")

    def some(cond):
        return F.count(F.when(cond, True))

    p, size = F.col("p_partkey"), F.col("p_size")
    brand = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    counts = T.part.groupBy(F.col("p_brand").alias("pair_id")).agg(
        n.alias("entities"), F.sum(size).alias("attributes"), some(p % 2 == 0).alias("relationships"), some(p % 3 == 0).alias("relationship_joins"),
        some(p % 5 == 0).alias("identifiers"), F.max(F.when(brand % 4 == 0, 3).otherwise(0)).alias("inheritances"), some(p % 11 == 0).alias("inheritance_links"),
        some(size > 45).alias("diagrams"), some((brand % 2 == 0) | (p % 3 == 0)).alias("entities_with_comment"), some(p % 7 == 0).alias("attributes_with_comment"),
        some(p % 13 == 0).alias("entities_without_identifier"), some(p % 17 == 0).alias("attributes_untyped"), some(p % 10 == 0).alias("identifiers_primary"),
        some(size < 3).alias("shortcuts"), F.max(F.when(brand % 9 == 0, 2).otherwise(0)).alias("extension_definitions"), F.countDistinct("p_type").alias("extension_properties"),
        some(p % 4 == 0).alias("extension_values"), F.max(F.when(brand % 10 == 0, 1).otherwise(0)).alias("templates"), F.lit(0).alias("validation_rules"),
        F.max(F.when(brand % 7 == 0, 1).otherwise(0)).alias("exclusive_inheritances"), F.max(F.when(brand % 6 == 0, 1).otherwise(0)).alias("external_glossaries"),
        F.lit(1).alias("glossary_enforced"), F.max(F.when(brand % 3 == 0, 1).otherwise(0)).alias("has_physical_layer"), F.max(F.when(brand % 5 == 0, 0).otherwise(2)).alias("domains"))
    return counts


_B = "regexp_extract(p_brand, '(\\d+)$', 1)::INTEGER"
CENSUS_SQL = f"""cn AS (SELECT p_brand AS pair_id, any_value({_B}) AS b, count(*) AS entities, sum(p_size)::BIGINT AS attributes, count(*) FILTER (p_partkey % 2 = 0) AS relationships, count(*) FILTER (p_partkey % 3 = 0) AS relationship_joins, count(*) FILTER (p_partkey % 5 = 0) AS identifiers,
  max(CASE WHEN {_B} % 4 = 0 THEN 3 ELSE 0 END) AS inheritances, count(*) FILTER (p_size > 45) AS diagrams, count(*) FILTER ({_B} % 2 = 0 OR p_partkey % 3 = 0) AS entities_with_comment, count(*) FILTER (p_partkey % 7 = 0) AS attributes_with_comment, count(*) FILTER (p_partkey % 13 = 0) AS entities_without_identifier,
  count(*) FILTER (p_partkey % 17 = 0) AS attributes_untyped, count(*) FILTER (p_partkey % 10 = 0) AS identifiers_primary, count(*) FILTER (p_size < 3) AS shortcuts, count(DISTINCT p_type) AS extension_properties, count(*) FILTER (p_partkey % 4 = 0) AS extension_values,
  max(CASE WHEN {_B} % 10 = 0 THEN 1 ELSE 0 END) AS templates, max(CASE WHEN {_B} % 7 = 0 THEN 1 ELSE 0 END) AS exclusive_inheritances FROM part GROUP BY p_brand)"""


@query("complexity_band", f"""WITH {CENSUS_SQL}, e AS (SELECT pair_id, list_filter([CASE WHEN b % 9 = 0 THEN 'B4:EXTENSIONS' END, CASE WHEN b % 10 = 0 THEN 'B4:TEMPLATES' END, CASE WHEN b % 7 = 0 THEN 'B4:EXCLUSIVE_INHERITANCE' END, CASE WHEN b % 6 = 0 THEN 'B3:GLOSSARY' END, CASE WHEN b % 4 = 0 THEN 'B3:INHERITANCE' END,
  CASE WHEN 100.0 * (entities - entities_with_comment) / entities > 10 THEN 'B3:MISSING_DEFINITIONS' END, CASE WHEN b % 3 <> 0 THEN 'B2:NO_PHYSICAL_LAYER' END], lambda x: x IS NOT NULL) AS evidence FROM cn),
d AS (SELECT *, coalesce(left(list_max(evidence), 2), 'B1') AS band FROM e)
SELECT pair_id, evidence, band, CASE band WHEN 'B1' THEN 'Very Simple' WHEN 'B2' THEN 'Simple' WHEN 'B3' THEN 'Medium' ELSE 'High / Very High' END AS band_label, CASE band WHEN 'B1' THEN 85 WHEN 'B2' THEN 70 WHEN 'B3' THEN 50 ELSE 20 END AS automation_low,
  CASE band WHEN 'B1' THEN 95 WHEN 'B2' THEN 85 WHEN 'B3' THEN 70 ELSE 50 END AS automation_high, CASE band WHEN 'B1' THEN 1.0 WHEN 'B2' THEN 1.5 WHEN 'B3' THEN 2.5 ELSE 4.0 END::DOUBLE AS multiplier FROM d""")
def _complexity_band(T):
    return rp.complexity_band(part_census(T)).select("pair_id", "evidence", "band", "band_label", "automation_low", "automation_high", "multiplier")


@query("automation_coverage", f"""WITH {CENSUS_SQL}, a AS (SELECT pair_id, entities + attributes + relationships + relationship_joins + identifiers + inheritances + diagrams + entities_with_comment + attributes_with_comment AS delivered, extension_values + exclusive_inheritances AS reapplied,
  templates + CASE WHEN entities_without_identifier > 0 THEN 1 ELSE 0 END AS manual, shortcuts AS lost FROM cn)
SELECT pair_id, delivered, reapplied, manual, lost, round(100.0::DOUBLE * delivered / (delivered + reapplied + manual + lost), 1) AS delivered_pct, round(100.0::DOUBLE * (delivered + reapplied) / (delivered + reapplied + manual + lost), 1) AS automated_pct FROM a""")
def _automation_coverage(T):
    return rp.automation_coverage(part_census(T)).select("pair_id", "delivered", "reapplied", "manual", "lost", "delivered_pct", "automated_pct")


@query("non_equivalence_register", f"""WITH {CENSUS_SQL} SELECT pair_id, r.* FROM cn, LATERAL (VALUES ('Objects', concat_ws(' / ', entities, attributes, relationships, identifiers), 'DELIVERED', 'IN_SCOPE'), ('Definitions', concat_ws(' / ', entities_with_comment, attributes_with_comment), 'DELIVERED', 'VERIFY'), ('Diagrams', diagrams::VARCHAR, 'PARTIAL', 'IN_SCOPE'),
  ('Extension properties', concat_ws(' / ', extension_properties, extension_values), 'NOT_DELIVERED', 'AUTOMATION'), ('Inheritance flags', exclusive_inheritances::VARCHAR, 'DROPPED', 'AUTOMATION'), ('Glossary bindings', shortcuts::VARCHAR, 'NOT_DELIVERED', 'NOT_RECOVERABLE'), ('Templates', templates::VARCHAR, 'NOT_DELIVERED', 'NOT_RECOVERABLE'),
  ('Version history', '', 'NOT_DELIVERED', 'OUT_OF_SCOPE'), ('Primary identifiers', concat_ws(' / ', identifiers_primary, identifiers, entities_without_identifier), 'DELIVERED', 'SOURCE_CONDITION'), ('Untyped attributes', attributes_untyped::VARCHAR, 'DELIVERED', 'SOURCE_CONDITION'),
  (CASE WHEN b % 5 = 0 THEN 'Domains' END, '0', 'NONE', 'NOT_APPLICABLE')) r(construct, volume, bridge, disposition) WHERE construct IS NOT NULL""")
def _non_equivalence_register(T):
    return rp.non_equivalence_register(part_census(T))


@query("complexity_signals", """WITH e AS (SELECT p_brand AS pair_id, count(*) AS entities, count(*) FILTER (p_size % 2 = 0) AS entities_with_comment, count(*) FILTER (p_partkey % 9 = 0) AS entities_without_identifier FROM part GROUP BY ALL),
l AS (SELECT p_brand AS pair_id, count(*) AS attributes, count(*) FILTER (l_quantity > 40) AS attributes_untyped, count(*) FILTER (l_linenumber = 1) AS attributes_with_comment FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
x AS (SELECT p_brand AS pair_id, count(*) AS extension_values, count(DISTINCT concat(p_type, '.', p_size % 3)) AS extension_properties, count(DISTINCT p_type) AS extension_containers FROM part GROUP BY ALL)
SELECT * FROM e JOIN l USING (pair_id) JOIN x USING (pair_id)""")
def _complexity_signals(T):
    def flags(**conds):
        return F.create_map(*[v for k, c in conds.items() for v in (F.lit(k), c)]).alias("flags")

    brand, none = F.col("p_brand").alias("pair_id"), F.lit(None).cast("string").alias("path")
    entities = T.part.select(brand, F.lit("ENTITY").alias("kind"), flags(comment=F.col("p_size") % 2 == 0, no_identifier=F.col("p_partkey") % 9 == 0), none)
    lines = T.lineitem.join(T.part, F.col("p_partkey") == F.col("l_partkey"))
    attrs = lines.select(brand, F.lit("ATTRIBUTE").alias("kind"), flags(untyped=F.col("l_quantity") > 40, comment=F.col("l_linenumber") == 1), none)
    path = F.concat("p_type", F.lit("."), (F.col("p_size") % 3).cast("string"))
    values = T.part.select(brand, F.lit("EXTENSION_VALUE").alias("kind"), F.lit(None).cast("map<string,boolean>").alias("flags"), path.alias("path"))
    signals = rp.complexity_signals(entities.unionByName(attrs).unionByName(values))
    return signals.select(
        "pair_id", "entities", "entities_with_comment", "entities_without_identifier", "attributes", "attributes_untyped", "attributes_with_comment",
        "extension_values", "extension_properties", "extension_containers")


@query("top_contributors", """WITH c AS (SELECT event_type AS pair_id, user_id::VARCHAR AS who, count(*) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY n DESC, who) AS rn FROM c)
SELECT pair_id, string_agg(concat(who, ' (', n, ')'), ', ' ORDER BY rn) AS contributors FROM r WHERE rn <= 3 GROUP BY pair_id""")
def _top_contributors(T):
    return rp.top_contributors(T.events.select(F.col("event_type").alias("pair_id"), F.col("user_id").alias("who")), 3)


@query("timing_rollup", """WITH s AS (SELECT strftime(ts, '%Y-%m-%d %H') AS run, user_id % 3 + 1 AS size, round(sum(value), 3) AS t FROM events GROUP BY ALL), l AS (SELECT * FROM s WHERE run = (SELECT max(run) FROM s)), r AS (SELECT *, row_number() OVER (ORDER BY size) - 1 AS pos FROM l)
SELECT run, pos::INTEGER AS pos, size AS models, t AS total_s, round(t / size, 3) AS per_model_s, round((SELECT t FROM r WHERE pos = 0) * size, 1) AS one_at_a_time_s FROM r""")
def _timing_rollup(T):
    log = T.events.groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("run"), (F.col("user_id") % 3 + 1).alias("size")).agg(F.round(F.sum("value"), 3).alias("end_to_end_s"))
    return rp.timing_rollup(rp.timing_records(log))


# --- workflow -------------------------------------------------------------------------


@query("sign_off", """WITH f AS (SELECT user_id, event_id, CASE event_type WHEN 'error' THEN CASE WHEN user_id % 6 = 0 THEN 'CRITICAL' ELSE 'VERIFIED' END WHEN 'click' THEN 'WARNING' ELSE 'INFO' END AS severity, CASE WHEN user_id % 4 = 0 THEN 'Not Acceptable' WHEN event_id % 2 = 0 THEN ' acceptable' ELSE 'Acceptable' END AS review FROM events)
SELECT user_id AS pair_id, count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) FILTER (severity = 'WARNING' AND lower(trim(review)) <> 'acceptable') AS unapproved, count(*) FILTER (severity = 'CRITICAL') = 0 AND count(*) FILTER (severity = 'WARNING' AND lower(trim(review)) <> 'acceptable') = 0 AS approved FROM f GROUP BY ALL""")
def _sign_off(T):
    severity = F.when(F.col("event_type") == "error", F.when(F.col("user_id") % 6 == 0, "CRITICAL").otherwise("VERIFIED")).when(F.col("event_type") == "click", "WARNING").otherwise("INFO")
    review = F.when(F.col("user_id") % 4 == 0, "Not Acceptable").when(F.col("event_id") % 2 == 0, " acceptable").otherwise("Acceptable")
    findings = T.events.select(F.col("user_id").alias("pair_id"), F.col("event_id").alias("finding_id"), severity.alias("severity"))
    return flow.sign_off(findings, T.events.select(F.col("event_id").alias("finding_id"), review.alias("review")))


@query("review_list", f"""WITH {findings_sql()}, v AS (SELECT *, CASE WHEN s_value = '—' THEN '' ELSE s_value END AS a, CASE WHEN t_value = '—' THEN '' ELSE t_value END AS b FROM f WHERE severity IN ('CRITICAL', 'WARNING'))
SELECT pair_id, category, severity, concat(member, ' — ', CASE category WHEN 'BUSINESS_NAME' THEN 'business name differs' WHEN 'DATA_TYPE' THEN 'data type differs' WHEN 'LENGTH_PRECISION' THEN 'length or precision differs' WHEN 'MANDATORY' THEN 'mandatory flag differs' WHEN 'DOMAIN' THEN 'domain differs'
  WHEN 'DEFINITION_LOSS' THEN 'definition lost' WHEN 'ATTRIBUTE_MISSING' THEN 'attribute only in source' ELSE 'attribute only in target' END, '.', CASE WHEN a = '' AND b = '' THEN '' ELSE concat(' [S: ', CASE WHEN a = '' THEN '(none)' ELSE a END, ' vs T: ', CASE WHEN b = '' THEN '(none)' ELSE b END, ']') END) AS review FROM v""")
def _review_list(T):
    return flow.review_list(part_findings(T)[0]).drop("rank")


@query("pair_verdicts", f"""WITH {results_sql()} SELECT pair_id, CASE WHEN objects_missing + objects_extra + critical + warning = 0 THEN 'OK' ELSE concat_ws(', ', CASE WHEN objects_missing > 0 THEN objects_missing || ' missing' END, CASE WHEN objects_extra > 0 THEN objects_extra || ' extra' END,
  CASE WHEN critical > 0 THEN critical || ' critical' END, CASE WHEN warning > 0 THEN warning || ' warning' END) END AS verdict FROM res""")
def _pair_verdicts(T):
    rules = [("objects_missing", "missing"), ("objects_extra", "extra"), ("critical", "critical"), ("warning", "warning")]
    return flow.pair_verdicts(part_results(T)[0], rules).select("pair_id", "verdict")


@query("status_summary", f"""WITH {results_sql()} SELECT 'logical' AS tier, pair_id, status, fidelity_score, CASE WHEN promote THEN '3_final' ELSE '1_initial' END AS stage, concat_ws('; ', CASE WHEN critical > 0 THEN 'CRITICAL_FINDINGS' END, CASE WHEN warning > 0 THEN 'WARNINGS_UNSIGNED' END, CASE WHEN fidelity_score_raw < 100 THEN 'BELOW_TARGET' END) AS notes FROM res
UNION ALL SELECT 'physical', concat('m', n_nationkey), 'PASS', 100.0, '3_final', '' FROM nation""")
def _status_summary(T):
    other = T.nation.select(
        F.concat(F.lit("m"), F.col("n_nationkey").cast("string")).alias("pair_id"), F.lit("PASS").alias("status"), F.lit(100.0).alias("fidelity_score"),
        F.lit(True).alias("promote"), F.array().cast("array<string>").alias("blockers"))
    return flow.status_summary({"logical": part_results(T)[0], "physical": other})


ART_SQL = """ar AS (SELECT user_id AS model, ['source', 'binary', 'export', 'preprocessed', 'report', 'summary', 'mapping', 'final'][event_id % 8 + 1] AS artifact, max(ts) AS w FROM events GROUP BY ALL),
fa AS (SELECT model, CASE WHEN model % 3 = 0 THEN '.pdm' ELSE '.ldm' END AS suffix, max(w) FILTER (artifact = 'source') AS source, max(w) FILTER (artifact = 'export') AS export, count(*) FILTER (artifact = 'binary') > 0 AS b, count(*) FILTER (artifact = 'export') > 0 AS x, count(*) FILTER (artifact = 'preprocessed') > 0 AS pr,
  count(*) FILTER (artifact = 'report') > 0 AS rep, count(*) FILTER (artifact = 'summary') > 0 AS su, count(*) FILTER (artifact = 'mapping') > 0 AS ma, count(*) FILTER (artifact = 'final') > 0 AS fi FROM ar WHERE NOT (model % 5 = 0 AND artifact IN ('export', 'final', 'mapping')) GROUP BY model)"""


def artifacts(T):
    kinds = F.array(*[F.lit(a) for a in flow.ARTIFACTS])
    rows = T.events.select(
        F.col("user_id").alias("model"), F.when(F.col("user_id") % 3 == 0, ".pdm").otherwise(".ldm").alias("suffix"),
        F.element_at(kinds, (F.col("event_id") % 8 + 1).cast("int")).alias("artifact"), F.col("ts").alias("modified"), F.lit(1).alias("bytes"))
    return rows.where("not (model % 5 = 0 and artifact in ('export', 'final', 'mapping'))")


@query("artifact_staleness", f"WITH {ART_SQL} SELECT model, suffix, round((epoch_us(source) - epoch_us(export)) / 3600000000.0, 2) AS stale_hours FROM fa")
def _artifact_staleness(T):
    return flow.artifact_facts(artifacts(T)).select("model", "suffix", "stale_hours")


def steps(T):
    models = T.events.select(F.col("user_id").alias("model")).distinct()
    results = models.where("model % 4 <> 0").select(
        "model", F.when(F.col("model") % 2 == 0, "PASS").otherwise("FAIL").alias("status"), (F.col("model") % 2).cast("bigint").alias("critical"), (F.col("model") % 2 == 0).alias("promote"))
    inventory = models.select(
        "model", (F.col("model") % 7).alias("comments"), (F.col("model") % 2).alias("definitions"), (F.col("model") % 3).alias("notes"), F.lit(1).alias("t_definitions"))
    return flow.audit_steps(flow.artifact_facts(artifacts(T)), results, inventory)


STEP_SQL = f"""{ART_SQL}, st AS (SELECT model, suffix, v.step, v.who AS provenance, v.o AS outcome FROM (SELECT *, model % 4 <> 0 AS cmp, model % 4 <> 0 AND model % 2 = 0 AS ok, suffix = '.pdm' AS ph FROM fa) a, LATERAL (VALUES
  ('Author source model', 'MANUAL', 'DONE'), ('Extract properties', 'NOT_IMPLEMENTED', 'N/A'), ('Import into target tool', 'MANUAL', CASE WHEN b THEN 'DONE' ELSE 'PENDING' END), ('Export target XML', 'MANUAL', CASE WHEN x THEN 'DONE' ELSE 'PENDING' END),
  ('Import gate', 'PIPELINE', CASE WHEN x THEN 'DONE' ELSE 'FAILED' END), (CASE WHEN NOT ph THEN 'Comments to notes' END, 'PIPELINE', CASE WHEN model % 7 = 0 THEN 'N/A' WHEN pr AND model % 3 > 0 THEN 'DONE' ELSE 'PENDING' END),
  (CASE WHEN NOT ph THEN 'Definitions to definitions' END, 'PIPELINE', CASE WHEN model % 2 = 0 THEN 'N/A' WHEN pr THEN 'DONE' ELSE 'PENDING' END), (CASE WHEN NOT ph THEN 'Inject properties' END, 'NOT_IMPLEMENTED', 'N/A'),
  ('Reconcile', 'PIPELINE', CASE WHEN cmp THEN 'DONE' WHEN x THEN 'PENDING' ELSE 'N/A' END), (CASE WHEN ph THEN 'Remediate' END, 'PIPELINE', CASE WHEN pr THEN 'DONE' WHEN ok THEN 'N/A' WHEN x THEN 'PENDING' ELSE 'N/A' END),
  (CASE WHEN ph THEN 'Reconcile again' END, 'PIPELINE', CASE WHEN NOT pr THEN 'N/A' WHEN cmp THEN 'DONE' ELSE 'PENDING' END), ('Validation report', 'PIPELINE', CASE WHEN rep THEN 'DONE' ELSE 'PENDING' END), ('Status summary', 'PIPELINE', CASE WHEN su THEN 'DONE' ELSE 'PENDING' END),
  ('Field mapping report', 'SCRIPT', CASE WHEN ma THEN 'DONE' ELSE 'PENDING' END), ('Audit', 'SCRIPT', 'DONE'), ('Promote', 'PIPELINE', CASE WHEN fi THEN 'DONE' WHEN ok AND NOT ph THEN 'PENDING' ELSE 'N/A' END)) v(step, who, o) WHERE v.step IS NOT NULL)"""


@query("audit_steps", f"WITH {STEP_SQL} SELECT *, coalesce({case_map('concat(provenance, chr(47), outcome)', flow.STATUS_TEXT)}, 'Not applicable') AS status_text FROM st")
def _audit_steps(T):
    return steps(T).select("model", "suffix", "step", "provenance", "outcome", "status_text")


@query("audit_blockers", f"WITH {STEP_SQL} SELECT model, step, outcome FROM st WHERE outcome IN ('PENDING', 'FAILED')")
def _audit_blockers(T):
    return flow.audit_blockers(steps(T)).select("model", "step", "outcome")


@query("audit_counts", f"WITH {STEP_SQL} SELECT provenance, outcome, count(*) AS steps FROM st GROUP BY ALL")
def _audit_counts(T):
    return flow.audit_counts(steps(T))


