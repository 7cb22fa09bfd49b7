"""Sources, sinks, the whole comparison, and incremental runs."""

import uuid

from pyspark.sql import functions as F

from veritwin import streaming as st
from veritwin.config import LOGICAL
from veritwin.operators import matching as m
from veritwin.plans import models
from veritwin.session import shared_dir
from veritwin.sources import files

from . import fixtures as fx
from .base import ladder, named_keys, norm, plain, query, similarity, squeeze, typed
from .semantic import ENT, attribute_sql, definition_arms, findings_sql, part_findings, policy_sql


def scratch(T) -> str:
    """A new folder in the shared folder of the cluster."""
    return f"{shared_dir(T.spark)}/run-{uuid.uuid4().hex}"


@query("element_census", """WITH e AS (SELECT page_id, unnest(regexp_extract_all(html, '<((?:a|p|li|div)(?:\\s[^<>]*)?)/?>', 1)) AS e FROM pages)
SELECT page_id, lower(regexp_extract(e, '^(\\w+)', 1)) AS tag, count(*) FILTER (NOT regexp_matches(e, '\\shref\\s*=')) AS definitions, count(*) FILTER (regexp_matches(e, '\\shref\\s*=')) AS pointers FROM e GROUP BY ALL""")
def _element_census(T):
    return files.element_census(T.pages, ["page_id"], "html", ["a", "p", "li", "div"], "href")


@query("shred_nested", """SELECT l_orderkey, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1)::INTEGER AS ord, l_partkey, l_suppkey FROM lineitem""")
def _shred_nested(T):
    """Documents with nested collections, taken apart again in their order."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    nested = T.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    return nested.select("l_orderkey", F.posexplode_outer("lines").alias("ord", "l")).select("l_orderkey", "ord", "l.l_partkey", "l.l_suppkey")


_SF = "SELECT concat('/in/', s_nationkey, '/Model_', s_suppkey, '.ldm') AS path FROM {supplier} UNION ALL SELECT concat('/other/model_', s_suppkey, '.ldm') FROM {supplier} WHERE s_suppkey % 9 = 0"
_TF = "SELECT concat('/out/MODEL_', c_custkey, '.xml') AS path FROM {customer} WHERE c_custkey % 3 <> 0"


def _pairs_sql(key: str) -> str:
    return f"""s AS (SELECT {key.format(p='path')} AS pair_key, min(path) AS s_path, count(*) AS s_files FROM ({plain(_SF)}) a GROUP BY 1), t AS (SELECT {key.format(p='path')} AS pair_key, min(path) AS t_path, count(*) AS t_files FROM ({plain(_TF)}) a GROUP BY 1),
pr AS (SELECT pair_key, s_path, t_path, coalesce(s_files, 0) AS s_files, coalesce(t_files, 0) AS t_files, CASE WHEN s_files IS NULL THEN 'EXTRA' WHEN t_files IS NULL THEN 'MISSING' ELSE 'MATCHED' END AS status FROM s FULL JOIN t USING (pair_key))"""


_BASE = "upper(regexp_replace(list_last(string_split({p}, '/')), '\\.[^.]*$', ''))"


@query("discover_pairs", f"WITH {_pairs_sql(_BASE)} SELECT * FROM pr")
def _discover_pairs(T):
    return files.discover_pairs(T.sql(_SF), T.sql(_TF))


# Two customers share a file name: the later of two paths is a duplicate.
_TWICE = "SELECT concat('/in/', c_custkey, '/m', c_custkey DIV 2, '.x') AS path FROM {customer}"


@query("duplicate_files", """WITH p AS (SELECT concat('/in/', c_custkey, '/m', c_custkey // 2, '.x') AS path, 'M' || (c_custkey // 2) AS pair_key FROM customer),
f AS (SELECT *, min(path) OVER (PARTITION BY pair_key) AS first FROM p), d AS (SELECT pair_key, path FROM f WHERE path > first)
SELECT pair_key, 'S' AS side, path, 'DUPLICATE' AS status FROM d UNION ALL SELECT pair_key, 'T', path, 'DUPLICATE' FROM d""")
def _duplicate_files(T):
    twice = T.sql(_TWICE)
    return files.duplicate_files(twice, twice)


@query("discover_pairs_mapping", f"""WITH {_pairs_sql(_BASE)}, mp AS (SELECT 'MODEL_' || c_custkey AS sk, 'MODEL_' || (c_custkey + 1) AS tk FROM customer)
SELECT sk AS pair_key, s_path, t.t_path, coalesce(s_files, 0) AS s_files, coalesce(t.t_files, 0) AS t_files, CASE WHEN s_files IS NULL THEN 'EXTRA' WHEN t.t_files IS NULL THEN 'MISSING' ELSE 'MATCHED' END AS status
FROM mp LEFT JOIN s ON s.pair_key = sk LEFT JOIN t ON t.pair_key = tk WHERE s_files IS NOT NULL OR t.t_files IS NOT NULL""")
def _discover_pairs_mapping(T):
    def name(offset):
        return F.concat(F.lit("model_"), (F.col("c_custkey") + offset).cast("string"), F.lit(".x"))

    mapping = T.customer.select(name(0).alias("s_file"), name(1).alias("t_file"))
    return files.discover_pairs(T.sql(_SF), T.sql(_TF), "csv", mapping=mapping)


@query("pending_pairs", "SELECT o_orderkey AS pair_key FROM orders WHERE o_orderstatus <> 'F'")
def _pending_pairs(T):
    pairs = T.orders.select(F.col("o_orderkey").alias("pair_key"), "o_orderstatus")
    return files.pending_pairs(pairs.select("pair_key"), pairs.where("o_orderstatus = 'F'"))


_JSON = "CASE WHEN event_id % 9 = 0 THEN replace(props, '}}', '') ELSE props END".replace("}}", "}")


@query("quarantine_parse_errors", f"""WITH j AS (SELECT event_id, {_JSON} AS raw FROM events) SELECT event_id, json_valid(raw) AS good, CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.k')::BIGINT END AS k FROM j""")
def _quarantine(T):
    rows = T.events.select("event_id", F.expr(_JSON).alias("raw"))
    good, bad = files.quarantine_parse_errors(rows, "raw", "k bigint")
    return good.select("event_id", F.lit(True).alias("good"), "parsed.k").unionByName(
        bad.select("event_id", F.lit(False).alias("good"), F.lit(None).cast("bigint").alias("k")))


@query("write_findings", f"WITH {findings_sql()} SELECT severity, category, count(*) AS findings FROM f GROUP BY ALL")
def _write_findings(T):
    path = scratch(T)
    files.write_findings(part_findings(T)[0], path)
    return T.spark.read.parquet(path).groupBy("severity", "category").agg(F.count("*").alias("findings"))


@query("append_ledger", "SELECT user_id, count(*) AS runs, max(event_id) AS last FROM events GROUP BY user_id")
def _append_ledger(T):
    path = scratch(T)
    rows = T.events.select("user_id", "event_id", F.struct("event_type", "value").alias("validation"))
    for part in (0, 1):
        files.append_ledger(rows.where(F.col("event_id") % 2 == part), path)
    back = files.read_ledger(T.spark, path, rows.schema)
    return back.groupBy("user_id").agg(F.count("*").alias("runs"), F.max("event_id").alias("last"))


@query("latest_by", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def _latest_by(T):
    return files.latest_by(T.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


# --- the whole comparison -------------------------------------------------------------

ATT_S = """SELECT p_brand AS pair_id, l_partkey AS entity, concat(l_orderkey, '/', l_linenumber, '/', l_suppkey, '/', CAST(l_extendedprice * 100 AS BIGINT)) AS id, concat('A', l_orderkey, '_', l_linenumber, '_', l_suppkey) AS code,
  concat('line ', l_orderkey, ' no ', l_linenumber, ' of ', l_suppkey) AS name, concat('DECIMAL(', l_linenumber + 5, ')') AS data_type, '' AS length, '' AS precision, (l_linenumber % 2 = 0) AS mandatory, l_returnflag AS domain, '' AS definition,
  l_linenumber AS ord, FALSE AS is_migrated, l_orderkey FROM {lineitem} JOIN {part} ON p_partkey = l_partkey"""
ATT_T = f"""SELECT pair_id, entity, id, CASE WHEN l_orderkey % 10 = 3 THEN concat('Z', code) ELSE code END AS code, CASE WHEN l_orderkey % 50 = 3 THEN concat('other ', code) ELSE upper(name) END AS name,
  CASE WHEN l_orderkey % 40 = 0 THEN 'DATE' ELSE data_type END AS data_type, length, precision, mandatory, domain, definition, ord, FALSE AS is_migrated FROM ({ATT_S}) x WHERE l_orderkey % 20 <> 7"""


def fleet(T):
    s = {"entities": T.sql(ENT.format(base=fx.PART_S)), "attributes": T.sql(ATT_S).drop("l_orderkey")}
    t = {"entities": T.sql(ENT.format(base=fx.PART_T)), "attributes": T.sql(ATT_T)}
    return models.compare_models(s, t, LOGICAL)


def _fleet_sql() -> str:
    """Counts, findings by severity and score of the same comparison, level by level."""
    ent_s, ent_t = plain(ENT.format(base=fx.PART_S)), plain(ENT.format(base=fx.PART_T))
    ents = ladder(ent_s, ent_t, ["pair_id"], named_keys())
    att_s = f"SELECT a.* EXCLUDE (l_orderkey) FROM ({plain(ATT_S)}) a JOIN ep ON ep.pair_id = a.pair_id AND ep.s_id = a.entity"
    att_t = f"SELECT a.* EXCLUDE (entity), ep.s_id AS entity FROM ({plain(ATT_T)}) a JOIN ep ON ep.pair_id = a.pair_id AND ep.t_id = a.entity"
    atts = ladder(att_s, att_t, ["pair_id", "entity"], named_keys())
    cols = ["code", "name", "data_type", "length", "precision", "mandatory", "domain", "definition"]
    sel = ", ".join(f"s.{c} AS s_{c}, t.{c} AS t_{c}" for c in cols)
    joined = f"SELECT lp.pair_id, lp.basis, {sel} FROM lp JOIN s0 s ON s.id = lp.s_id JOIN t0 t ON t.id = lp.t_id"
    pr = f"pr AS (SELECT *, 1.0 AS sim FROM {typed(joined, 's_data_type', 't_data_type')} a)"
    ent_pr = (
        f"pr AS (SELECT *, {similarity('sd', 'td')} AS sim FROM (SELECT lp.pair_id, lp.basis, s.name AS s_name, t.name AS t_name, s.definition AS s_definition, "
        f"t.definition AS t_definition, lower({squeeze('s.definition')}) AS sd, lower({squeeze('t.definition')}) AS td FROM lp JOIN s0 s ON s.id = lp.s_id JOIN t0 t ON t.id = lp.t_id) a)")

    def counts(kind):
        return (
            "SELECT pair_id, count(*) FILTER (k <> 'E') AS s, count(*) FILTER (k <> 'M') AS t, count(*) FILTER (k = 'P') AS p FROM (SELECT pair_id, 'P' AS k FROM lp "
            "UNION ALL SELECT pair_id, 'M' FROM ls UNION ALL SELECT pair_id, 'E' FROM lt) u GROUP BY pair_id")

    return f"""WITH al AS (SELECT pair_id, count(*) AS attributes_all_s FROM ({plain(ATT_S)}) a GROUP BY pair_id), ep AS MATERIALIZED (WITH {ents} SELECT * FROM lp), ec AS (WITH {ents} {counts('e')}), ac AS MATERIALIZED (WITH {atts} {counts('a')}),
ef AS (WITH {ents}, {ent_pr} SELECT pair_id, 'FALLBACK_MATCH' AS category FROM pr WHERE basis <> 'code' UNION ALL SELECT pair_id, 'BUSINESS_NAME' FROM pr WHERE {norm('s_name')} <> {norm('t_name')}
  UNION ALL SELECT pair_id, category FROM ({definition_arms('pair_id', "''", "''")}) d UNION ALL SELECT pair_id, 'ENTITY_MISSING' FROM ls UNION ALL SELECT pair_id, 'ENTITY_EXTRA' FROM lt),
af AS MATERIALIZED (WITH {atts}, {pr} SELECT pair_id, category FROM ({attribute_sql(LOGICAL)}) x UNION ALL SELECT pair_id, 'ATTRIBUTE_MISSING' FROM ls UNION ALL SELECT pair_id, 'ATTRIBUTE_EXTRA' FROM lt),
sv AS (SELECT pair_id, {policy_sql(LOGICAL)} AS severity FROM (SELECT * FROM ef UNION ALL SELECT * FROM af) f),
n AS (SELECT pair_id, count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) FILTER (severity = 'WARNING') AS warning, count(*) FILTER (severity = 'INFO') AS info FROM sv GROUP BY pair_id),
r AS (SELECT ec.pair_id, ec.s AS entities_s, ec.t AS entities_t, ec.p AS entities_matched, ac.s AS attributes_s, ac.t AS attributes_t, ac.p AS attributes_matched, critical, warning, info,
  attributes_all_s, least(critical + 0.35 * warning + 0.05 * info, ec.s + attributes_all_s)::DOUBLE AS pen, (ec.s + attributes_all_s)::DOUBLE AS objects FROM ec JOIN ac USING (pair_id) JOIN n USING (pair_id) JOIN al USING (pair_id))
SELECT * EXCLUDE (pen, objects), round(100.0::DOUBLE - 100.0::DOUBLE * pen / objects, 2) AS fidelity_score, CASE WHEN critical > 0 THEN 'FAIL' WHEN warning > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM r"""


@query("compare_models", _fleet_sql())
def _compare_models(T):
    """25 models: entities by ladder, attributes by ladder inside matched entities, findings, scores, gate."""
    return fleet(T)["results"].select(
        "pair_id", "entities_s", "entities_t", "entities_matched", "attributes_s", "attributes_t", "attributes_matched", "attributes_all_s", "critical", "warning", "info",
        "fidelity_score", "status")


# --- incremental ----------------------------------------------------------------------

_PAIRED = f"SELECT concat('n', nation) AS pair_id, 'S' AS side, id, acctbal, segment FROM ({fx.CUST_S}) a UNION ALL SELECT concat('n', nation), 'T', id, acctbal, segment FROM ({fx.CUST_T}) b"


def reconcile_batch(batch):
    """The batch job: keyed reconcile of the complete pairs of one batch."""
    s, t = (batch.where(F.col("side") == x).drop("side") for x in ("S", "T"))
    out = m.reconcile_keyed(s, t, ["pair_id", "id"])
    changed = (F.col("status") == "MATCHED") & (F.col("s_acctbal") != F.col("t_acctbal"))
    return out.groupBy("pair_id").agg(
        *[m.count_when(F.col("status") == x).alias(x.lower()) for x in ("MATCHED", "MISSING", "EXTRA")], m.count_when(changed).alias("changed"))


@query("stream_reconcile", f"""WITH p AS ({plain(_PAIRED)}), s AS (SELECT * FROM p WHERE side = 'S'), t AS (SELECT * FROM p WHERE side = 'T')
SELECT pair_id, count(*) FILTER (s.side IS NOT NULL AND t.side IS NOT NULL) AS matched, count(*) FILTER (t.side IS NULL) AS missing, count(*) FILTER (s.side IS NULL) AS extra, count(*) FILTER (s.acctbal <> t.acctbal) AS changed FROM s FULL JOIN t USING (pair_id, id) GROUP BY pair_id""")
def _stream_reconcile(T):
    """One file a batch, in runs that resume: of half the pairs S comes long before T, of the others both come at once."""
    base = scratch(T)
    rows = T.sql(_PAIRED)
    early = F.expr("cast(substr(pair_id, 2) as int) % 2 = 0")
    for part in (early & (F.col("side") == "S"), ~early, early & (F.col("side") == "T")):
        rows.where(part).repartition(2, "pair_id").write.mode("append").parquet(f"{base}/in")
        st.stream_pairs(T.spark, f"{base}/in", rows.schema, reconcile_batch, f"{base}/out", f"{base}/progress", 1).awaitTermination()
    return st.latest_results(T.spark, f"{base}/out")


@query("stream_cells_vs_baseline", """WITH b AS (SELECT user_id, event_type, arg_min(props, event_id) AS v FROM events WHERE user_id % 10 <> 0 GROUP BY ALL)
SELECT e.event_type AS udp, CASE WHEN b.v IS NULL THEN 'EXTRA' WHEN b.v = e.props THEN 'PASS' ELSE 'MISMATCH' END AS status, count(*) AS cells FROM events e LEFT JOIN b USING (user_id, event_type) GROUP BY ALL""")
def _stream_cells(T):
    base = scratch(T)
    owner = F.concat(F.lit("User "), F.col("user_id").cast("string"))
    cells = T.events.select(owner.alias("owner"), F.col("event_type").alias("udp"), F.col("props").alias("value"), "user_id", "event_id")
    baseline = files.latest_by(cells.where("user_id % 10 <> 0").withColumn("first", -F.col("event_id")), ["owner", "udp"], ["first"]).select(
        F.lower("owner").alias("owner_key"), "udp", "value")
    arriving = cells.select("owner", "udp", "value")
    arriving.repartition(4).write.parquet(f"{base}/in")
    st.stream_cells_vs_baseline(T.spark, f"{base}/in", arriving.schema, baseline, f"{base}/out", f"{base}/progress", 2).awaitTermination()
    return T.spark.read.parquet(f"{base}/out")
