"""Comparison of physical models, repair, gates."""

from pyspark.sql import functions as F

from veritwin.config import PHYSICAL
from veritwin.operators import shaping as sh
from veritwin.plans import flow, scoring
from veritwin.plans import physical as ph
from veritwin.plans.findings import apply_severity

from . import fixtures as fx
from .base import key, plain, query, t_physical, t_physical_base, trim, txt

SHOWN = ["pair_id", "category", "object_name", "member", "s_value", "t_value"]

# TAB: orders as tables, lineitems as their columns. Names repeat, so duplicates occur.
_TAB = "concat('O', o_orderkey % 997)"
TAB_S = f"SELECT concat('m', o_custkey % 20) AS pair_id, {_TAB} AS code, o_orderkey AS ord, o_orderkey % 9 AS n_columns FROM {{orders}}"
TAB_T = f"SELECT concat('m', o_custkey % 20) AS pair_id, lower({_TAB}) AS code, o_orderkey AS ord, o_orderkey % 8 AS n_columns FROM {{orders}} WHERE o_orderkey % 9 <> 0 UNION ALL SELECT concat('m', o_custkey % 20), concat('N', o_custkey), o_orderkey, 1 FROM {{orders}} WHERE o_orderkey % 31 = 0"

_ORD = "l_orderkey * 10000000000 + l_partkey * 100000 + l_suppkey * 10 + l_linenumber"
COL_S = f"""SELECT concat('m', l_suppkey % 20) AS pair_id, concat('T', l_orderkey % 500) AS tab, concat('c_', l_partkey % 400) AS code, {_ORD} AS ord,
  CASE l_partkey % 7 WHEN 0 THEN concat('VARCHAR2(', l_partkey % 5 + 1, ')') WHEN 1 THEN 'Enum' WHEN 2 THEN 'int' WHEN 3 THEN '' ELSE 'NUMBER(18,4)' END AS data_type,
  (l_linenumber % 2 = 0) AS not_null, CASE WHEN l_linenumber % 3 = 0 THEN concat(' d', l_linenumber) ELSE '' END AS default_value FROM {{lineitem}}"""
COL_T = f"""SELECT concat('m', l_suppkey % 20) AS pair_id, concat('T', l_orderkey % 500) AS tab, upper(concat('c_', l_partkey % 400)) AS code, {_ORD} AS ord,
  CASE l_partkey % 7 WHEN 0 THEN concat('varchar(', l_partkey % 4 + 1, ')') WHEN 1 THEN 'CHAR(18)' WHEN 2 THEN CASE WHEN l_partkey % 3 = 0 THEN 'DATE' ELSE 'INTEGER' END WHEN 3 THEN 'DATE' ELSE 'numeric(18,4)' END AS data_type,
  CASE WHEN l_partkey % 13 = 0 THEN (l_linenumber % 2 <> 0) ELSE (l_linenumber % 2 = 0) END AS not_null, CASE WHEN l_linenumber % 6 = 0 THEN 'x' WHEN l_linenumber % 3 = 0 THEN concat('D', l_linenumber) ELSE '' END AS default_value
FROM {{lineitem}} WHERE l_partkey % 11 <> 0
UNION ALL SELECT concat('m', l_suppkey % 20), concat('T', l_orderkey % 500), concat('new_', l_partkey % 100), {_ORD}, 'DATE', FALSE, '' FROM {{lineitem}} WHERE l_partkey % 57 = 0"""
COLUMN = "pair_id, \"table\", \"column\""


def columns(T, text):
    return ph.keyed(ph.keyed(T.sql(text), "tab", "table"), "code", "column").select(
        "pair_id", "table", "column", "ord", "data_type", "not_null", "default_value")


def _last(text):
    return f"""SELECT * FROM (SELECT pair_id, tab, {key('code')} AS col, ord, data_type, not_null, default_value, row_number() OVER (PARTITION BY pair_id, tab, {key('code')} ORDER BY ord DESC) AS rn FROM ({plain(text)}) a) b WHERE rn = 1"""


def records_sql(s=COL_S, t=COL_T) -> str:
    """CTE ``rec``: column records; types normalised."""
    return f"""cs AS ({_last(s)}), ct AS ({_last(t)}),
rec0 AS (SELECT pair_id, tab, col, s.data_type AS sd, t.data_type AS td, s.not_null AS sn, t.not_null AS tn, s.default_value AS sdef, t.default_value AS tdef,
  CASE WHEN s.ord IS NULL THEN 'EXTRA' WHEN t.ord IS NULL THEN 'MISSING' ELSE 'MATCHED' END AS status FROM cs s FULL JOIN ct t USING (pair_id, tab, col)),
rec AS (SELECT *, {t_physical('sd')} AS sp, {t_physical('td')} AS tp FROM rec0)"""


def column_findings_sql() -> str:
    """CTE ``cf`` over ``rec``."""
    base = f"CASE WHEN upper({t_physical_base('sp')}) = 'ENUM' THEN 'DATA_TYPE_ABSTRACT' WHEN {t_physical_base('sp')} = {t_physical_base('tp')} THEN 'DATA_TYPE_LENGTH' ELSE 'DATA_TYPE' END"
    typ = f"{txt('sd')} <> '' AND {txt('td')} <> '' AND sp <> tp"
    nul, dft = "sn <> tn", f"{key('sdef')} <> {key('tdef')}"
    return f"""cf AS (
SELECT pair_id, {base} AS category, tab AS object_name, col AS member, concat(sd, ' → ', sp) AS s_value, concat(td, ' → ', tp) AS t_value FROM rec WHERE status = 'MATCHED' AND {typ}
UNION ALL SELECT pair_id, 'NULLABILITY', tab, col, CASE WHEN sn THEN 'NOT NULL' ELSE 'NULL' END, CASE WHEN tn THEN 'NOT NULL' ELSE 'NULL' END FROM rec WHERE status = 'MATCHED' AND {nul}
UNION ALL SELECT pair_id, 'DEFAULT', tab, col, CASE WHEN {trim('sdef')} = '' THEN '(none)' ELSE {trim('sdef')} END, CASE WHEN {trim('tdef')} = '' THEN '(none)' ELSE {trim('tdef')} END FROM rec WHERE status = 'MATCHED' AND {dft}
UNION ALL SELECT pair_id, 'COLUMN_VERIFIED', tab, col, CASE WHEN sd = '' THEN '(untyped)' ELSE sd END, CASE WHEN td = '' THEN '(untyped)' ELSE td END FROM rec WHERE status = 'MATCHED' AND NOT ({typ}) AND NOT ({nul}) AND NOT ({dft})
UNION ALL SELECT pair_id, 'COLUMN_MISSING', tab, col, col, '—' FROM rec WHERE status = 'MISSING' UNION ALL SELECT pair_id, 'COLUMN_EXTRA', tab, col, '—', col FROM rec WHERE status = 'EXTRA')"""


@query("compare_columns", f"WITH {records_sql()}, {column_findings_sql()} SELECT * FROM cf")
def _compare_columns(T):
    return ph.compare_columns(ph.column_records(columns(T, COL_S), columns(T, COL_T)), PHYSICAL).select(*SHOWN)


@query("compare_duplicate_columns", f"""WITH s AS (SELECT pair_id, tab, {key('code')} AS col, count(*) AS n FROM ({plain(COL_S)}) a GROUP BY ALL), t AS (SELECT pair_id, tab, {key('code')} AS col, count(*) AS n FROM ({plain(COL_T)}) a GROUP BY ALL),
j AS (SELECT pair_id, tab, col, coalesce(s.n, 1) AS a, coalesce(t.n, 1) AS b FROM s FULL JOIN t USING (pair_id, tab, col))
SELECT pair_id, 'COLUMN_DUPLICATE' AS category, tab AS object_name, col AS member, a || ' columns share this name' AS s_value, b::VARCHAR AS t_value FROM j WHERE a > 1
UNION ALL SELECT pair_id, 'COLUMN_DUPLICATE', tab, col, a::VARCHAR, b || ' columns share this name' FROM j WHERE b > 1""")
def _compare_duplicate_columns(T):
    return ph.compare_duplicate_columns(columns(T, COL_S), columns(T, COL_T)).select(*SHOWN)


def _tables(T, text):
    return ph.keyed(T.sql(text), "code", "table").select("pair_id", "table", "ord", "n_columns")


def _tab_sql(text):
    return f"SELECT pair_id, upper(code) AS tab, arg_min(n_columns, ord) AS n, count(*) AS objects FROM ({plain(text)}) a GROUP BY ALL"


TABLES_SQL = f"""ts AS ({_tab_sql(TAB_S)}), tt AS ({_tab_sql(TAB_T)}),
tr AS (SELECT pair_id, tab, s.n AS sn, t.n AS tn, s.objects AS so, t.objects AS tob, CASE WHEN s.n IS NULL THEN 'EXTRA' WHEN t.n IS NULL THEN 'MISSING' ELSE 'MATCHED' END AS status FROM ts s FULL JOIN tt t USING (pair_id, tab))"""


@query("compare_tables", f"""WITH {TABLES_SQL}
SELECT pair_id, CASE status WHEN 'MISSING' THEN 'TABLE_MISSING' WHEN 'EXTRA' THEN 'TABLE_EXTRA' ELSE 'TABLE_VERIFIED' END AS category, tab AS object_name,
  CASE status WHEN 'MISSING' THEN tab WHEN 'EXTRA' THEN '—' ELSE sn || ' columns' END AS s_value, CASE status WHEN 'MISSING' THEN '—' WHEN 'EXTRA' THEN tab ELSE tn || ' columns' END AS t_value FROM tr
UNION ALL SELECT pair_id, 'TABLE_DUPLICATE', tab, so || ' tables', '1 compared' FROM tr WHERE so > 1 UNION ALL SELECT pair_id, 'TABLE_DUPLICATE', tab, '1 compared', tob || ' tables' FROM tr WHERE tob > 1""")
def _compare_tables(T):
    return ph.compare_tables(_tables(T, TAB_S), _tables(T, TAB_T), PHYSICAL)[1].select("pair_id", "category", "object_name", "s_value", "t_value")


@query("compare_physical_pk", """WITH m AS (SELECT l_orderkey AS id, list_sort(list_distinct(list('P' || l_partkey))) AS s, list_sort(list_distinct(coalesce(list('P' || l_partkey) FILTER (l_partkey % 37 <> 0), []))) AS t FROM lineitem GROUP BY ALL),
k AS (SELECT id, CASE WHEN id % 13 = 1 THEN NULL ELSE s END AS s, CASE WHEN id % 11 = 1 THEN NULL WHEN id % 4 = 0 THEN t ELSE coalesce(s, []) END AS t FROM m)
SELECT concat('T', id) AS object_name, CASE WHEN s IS NULL THEN 'PRIMARY_KEY_T_ONLY' WHEN t IS NULL OR len(t) = 0 THEN 'PRIMARY_KEY' WHEN s <> t THEN 'PRIMARY_KEY' ELSE 'KEY_VERIFIED' END AS category,
  CASE WHEN s IS NULL THEN '(none)' ELSE array_to_string(s, ',') END AS s_value, CASE WHEN s IS NOT NULL AND (t IS NULL OR len(t) = 0) THEN '(none)' ELSE array_to_string(t, ',') END AS t_value FROM k WHERE NOT (s IS NULL AND t IS NULL)""")
def _compare_physical_pk(T):
    code = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    grouped = T.lineitem.groupBy("l_orderkey").agg(
        F.collect_list(code).alias("s"), F.collect_list(F.when(F.col("l_partkey") % 37 != 0, F.upper(code))).alias("t"))
    k = F.col("l_orderkey")
    pairs = grouped.select(
        F.lit("m").alias("pair_id"), F.concat(F.lit("T"), k.cast("string")).alias("table"), F.when(k % 13 != 1, F.col("s")).alias("s_members"),
        F.when(k % 11 == 1, F.lit(None)).when(k % 4 == 0, F.col("t")).otherwise(F.reverse("s")).alias("t_members"))
    return ph.compare_physical_pk(pairs).select("object_name", "category", "s_value", "t_value")


FK = "SELECT concat('m', l_suppkey % 10) AS pair_id, concat('Order', l_orderkey % 100) AS parent_table, concat('Supp', l_suppkey % 30) AS child_table, concat('c', l_partkey % 10) AS col, {o} AS ord, concat('FK', l_partkey) AS name FROM {{lineitem}}"
FK_S = FK.format(o=_ORD)
FK_T = FK_S + " WHERE l_partkey % 10 <> 3 AND l_orderkey % 7 <> 0"


def references(T, text):
    join = F.array(F.struct(F.col("col").alias("parent_col"), F.concat(F.col("col"), F.lit("_fk")).alias("child_col")))
    return ph.with_fk_signature(T.sql(text).withColumn("joins", join))


def _fk_sql(text, name):
    return f"{name} AS (SELECT pair_id, concat(upper(parent_table), '>', upper(child_table), ':', upper(col), '=', upper(col), '_FK') AS sig, ord, name, row_number() OVER (PARTITION BY pair_id, parent_table, child_table, col ORDER BY ord) AS rn FROM ({plain(text)}) a)"


@query("compare_foreign_keys", f"""WITH {_fk_sql(FK_S, 's')}, {_fk_sql(FK_T, 't')}, j AS (SELECT pair_id, sig, coalesce(s.name, t.name) AS member, CASE WHEN s.ord IS NULL THEN 'FOREIGN_KEY_EXTRA' WHEN t.ord IS NULL THEN 'FOREIGN_KEY_MISSING' ELSE 'REFERENCE_VERIFIED' END AS category
  FROM s FULL JOIN t USING (pair_id, sig, rn)), d AS (SELECT pair_id, sig, count(*) AS n FROM s GROUP BY ALL HAVING count(*) > 1)
SELECT pair_id, category, member, CASE WHEN category = 'FOREIGN_KEY_EXTRA' THEN '—' ELSE sig END AS s_value, CASE WHEN category = 'FOREIGN_KEY_MISSING' THEN '—' ELSE sig END AS t_value FROM j
UNION ALL SELECT d.pair_id, 'FOREIGN_KEY_DUPLICATE', '', d.sig, (SELECT count(*) FROM t WHERE t.pair_id = d.pair_id AND t.sig = d.sig)::VARCHAR FROM d""")
def _compare_foreign_keys(T):
    return ph.compare_foreign_keys(references(T, FK_S), references(T, FK_T))[1].select("pair_id", "category", "member", "s_value", "t_value")


IX_S = "SELECT concat('m', l_suppkey % 10) AS pair_id, concat('T', l_orderkey) AS tab, l_linenumber AS ord, concat('IX', l_linenumber) AS name, (l_linenumber % 2 = 0) AS is_unique, concat('c', l_partkey % 20) AS a, concat('c', l_suppkey % 20) AS b, (l_partkey % 6 = 0) AS mirror, (l_partkey % 5 = 0) AS is_pk, l_partkey, l_suppkey, l_extendedprice FROM {lineitem}"


def _indexes(T, text):
    from veritwin.operators.ordered import keep_one

    rows = T.sql(text).withColumnRenamed("tab", "table").withColumn("members", F.array("a", "b"))
    # One index per (table, position); lineitem repeats them.
    return keep_one(rows, ["pair_id", "table", "ord"], [F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_extendedprice")])


_IXB = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pair_id, tab, ord ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM ({plain(IX_S)}) a) b WHERE rn = 1"
_IXSIG = "concat(CASE WHEN is_unique THEN 'U' ELSE 'I' END, ':', upper(least(a, b)), ',', upper(greatest(a, b)))"


@query("compare_indexes", f"""WITH base AS ({_IXB}), s AS (SELECT *, {_IXSIG} AS sig FROM base WHERE NOT is_pk), t AS (SELECT *, {_IXSIG} AS sig FROM (SELECT * REPLACE (CASE WHEN ord % 3 = 0 THEN NOT is_unique ELSE is_unique END AS is_unique) FROM base WHERE l_partkey % 8 <> 0) x WHERE NOT is_pk),
ss AS (SELECT pair_id, tab, sig, arg_max(name, ord) AS name FROM s WHERE NOT mirror GROUP BY ALL), st AS (SELECT pair_id, tab, sig, arg_max(name, ord) AS name FROM t GROUP BY ALL)
SELECT pair_id, tab AS object_name, sig AS signature, CASE WHEN ss.name IS NULL THEN 'INDEX_EXTRA' WHEN st.name IS NULL THEN 'INDEX_MISSING' ELSE 'INDEX_VERIFIED' END AS category FROM ss FULL JOIN st USING (pair_id, tab, sig)
UNION ALL SELECT pair_id, tab, sig, 'INDEX_MIRROR' FROM s WHERE mirror""")
def _compare_indexes(T):
    s = _indexes(T, IX_S)
    unique = F.when(F.col("ord") % 3 == 0, ~F.col("is_unique")).otherwise(F.col("is_unique"))
    t = s.where("l_partkey % 8 <> 0").withColumn("is_unique", unique)
    rows = ph.compare_indexes(s, t, PHYSICAL)
    return rows.select("pair_id", "object_name", F.when(F.col("s_value") == "—", F.col("t_value")).otherwise(F.col("s_value")).alias("signature"), "category")


@query("physical_counters", f"""WITH {TABLES_SQL}, {records_sql()}, {_fk_sql(FK_S, 'fs')}, {_fk_sql(FK_T, 'ft')},
p AS (SELECT concat('m', x) AS pair_id FROM range(20) r(x)), j AS (SELECT pair_id, CASE WHEN s.ord IS NULL THEN 'EXTRA' WHEN t.ord IS NULL THEN 'MISSING' ELSE 'MATCHED' END AS status FROM fs s FULL JOIN ft t USING (pair_id, sig, rn)),
a AS (SELECT pair_id, (SELECT coalesce(sum(so), 0) FROM tr WHERE tr.pair_id = p.pair_id)::BIGINT AS tables_s, (SELECT coalesce(sum(tob), 0) FROM tr WHERE tr.pair_id = p.pair_id)::BIGINT AS tables_t,
  (SELECT count(*) FROM tr WHERE tr.pair_id = p.pair_id AND status = 'MATCHED') AS tables_matched, (SELECT coalesce(sum(so - 1), 0) FROM tr WHERE tr.pair_id = p.pair_id)::BIGINT AS tables_duplicate_s,
  (SELECT count(*) FROM ({plain(COL_S)}) c WHERE c.pair_id = p.pair_id) AS columns_s, (SELECT count(*) FROM rec WHERE rec.pair_id = p.pair_id AND status = 'MATCHED') AS columns_matched,
  (SELECT count(*) FROM rec WHERE rec.pair_id = p.pair_id AND status = 'MISSING') AS columns_missing, (SELECT count(*) FROM j WHERE j.pair_id = p.pair_id AND status = 'MATCHED') AS fks_matched, (SELECT count(*) FROM j WHERE j.pair_id = p.pair_id AND status = 'MISSING') AS fks_missing FROM p),
total AS (SELECT pair_id, label, count(*) AS n FROM (
  SELECT pair_id, 'tables_s' AS label FROM ({plain(TAB_S)}) x UNION ALL SELECT pair_id, 'tables_t' FROM ({plain(TAB_T)}) x UNION ALL SELECT pair_id, 'columns_s' FROM ({plain(COL_S)}) x
  UNION ALL SELECT pair_id, 'columns_t' FROM ({plain(COL_T)}) x UNION ALL SELECT pair_id, 'fks_s' FROM ({plain(FK_S)}) x UNION ALL SELECT pair_id, 'fks_t' FROM ({plain(FK_T)}) x) u GROUP BY ALL),
part AS (SELECT pair_id, label, sum(n) AS n FROM (
  SELECT pair_id, unnest(CASE status WHEN 'MATCHED' THEN [kind || '_s', kind || '_t'] WHEN 'MISSING' THEN [kind || '_s'] ELSE [kind || '_t'] END) AS label, 1 AS n FROM (
    SELECT pair_id, 'tables' AS kind, status FROM tr UNION ALL SELECT pair_id, 'columns', status FROM rec UNION ALL SELECT pair_id, 'fks', status FROM j) r
  UNION ALL SELECT pair_id, 'tables_s', so - 1 FROM tr WHERE so > 1 UNION ALL SELECT pair_id, 'tables_t', tob - 1 FROM tr WHERE tob > 1
  UNION ALL SELECT pair_id, 'columns_s', count(*) - 1 FROM ({plain(COL_S)}) x GROUP BY pair_id, tab, {key('code')} UNION ALL SELECT pair_id, 'columns_t', count(*) - 1 FROM ({plain(COL_T)}) x GROUP BY pair_id, tab, {key('code')}) u GROUP BY ALL),
wrong AS (SELECT pair_id, label FROM total FULL JOIN part USING (pair_id, label) WHERE coalesce(total.n, 0) <> coalesce(part.n, 0))
SELECT *, (SELECT count(*) FROM wrong w WHERE w.pair_id = a.pair_id) AS broken FROM a""")
def _physical_counters(T):
    """Counts and identities of the physical tier: every total, counted from its objects, is the sum of its parts."""
    s_t, t_t, s_c, t_c = _tables(T, TAB_S), _tables(T, TAB_T), columns(T, COL_S), columns(T, COL_T)
    s_r, t_r = references(T, FK_S), references(T, FK_T)
    tables = ph.compare_tables(s_t, t_t, PHYSICAL)[0]
    refs = ph.compare_foreign_keys(s_r, t_r)[0]
    counters = ph.physical_counters(tables, ph.column_records(s_c, t_c), s_t, t_t, s_c, t_c, refs, s_r, t_r)
    checked = scoring.count_identities(counters, ["tables", "columns", "fks"])
    return checked.select(
        "pair_id", "tables_s", "tables_t", "tables_matched", "tables_duplicate_s", "columns_s", "columns_matched", "columns_missing",
        "fks_matched", "fks_missing", F.size("broken").cast("bigint").alias("broken"))


@query("count_identities", """SELECT concat('m', c_nationkey) AS pair_id, CASE WHEN c_nationkey % 4 = 0 THEN ['objects_s'] ELSE [] END::VARCHAR[] AS broken FROM customer GROUP BY c_nationkey""")
def _count_identities(T):
    """A report whose totals do not add up is caught."""
    n = F.count("*")
    counts = T.customer.groupBy(F.concat(F.lit("m"), F.col("c_nationkey").cast("string")).alias("pair_id"), F.col("c_nationkey").alias("k")).agg(n.alias("n"))
    claimed = counts.select(
        "pair_id", (F.col("n") + F.when(F.col("k") % 4 == 0, 1).otherwise(0)).alias("objects_s"), F.col("n").alias("objects_t"),
        F.col("n").alias("objects_matched"), F.lit(0).alias("objects_missing"), F.lit(0).alias("objects_extra"))
    return scoring.count_identities(claimed, ["objects"]).select("pair_id", "broken")


# --- repair and gates -----------------------------------------------------------------

# Clean columns: the repair must bring the pair to 100. Duplicates are left out of both sides by the key.
FIX_S = "SELECT concat('m', l_suppkey % 20) AS pair_id, concat('T', l_orderkey % 50) AS tab, concat('c_', l_partkey) AS code, l_partkey AS ord, 'INTEGER' AS data_type, TRUE AS not_null, '' AS default_value FROM {lineitem} GROUP BY l_suppkey % 20, l_orderkey % 50, l_partkey"
FIX_T = "SELECT concat('m', l_suppkey % 20) AS pair_id, concat('T', l_orderkey % 50) AS tab, concat('c_', l_partkey) AS code, l_partkey AS ord, CASE WHEN l_suppkey % 20 = 3 AND l_partkey % 40 = 0 THEN 'DATE' ELSE 'int' END AS data_type, TRUE AS not_null, '' AS default_value FROM {lineitem} WHERE NOT (l_suppkey % 20 < 8 AND l_partkey % 29 = 0) AND NOT (l_suppkey % 20 = 5 AND l_orderkey % 50 = 7) GROUP BY l_suppkey % 20, l_orderkey % 50, l_partkey"


def two_passes(T):
    return flow.two_pass(columns(T, FIX_S), columns(T, FIX_T), PHYSICAL)


def _fix_counts(repaired: bool) -> str:
    gone = "p = 5 AND o = 7" if repaired else "(p < 8 AND l_partkey % 29 = 0) OR (p = 5 AND o = 7)"
    return f"""SELECT concat('m', p) AS pair_id, count(*) AS columns_s, count(*) FILTER ({gone}) AS columns_missing, count(*) FILTER (NOT ({gone}) AND p = 3 AND l_partkey % 40 = 0 {"AND l_partkey % 29 <> 0" if repaired else ""}) AS types
FROM (SELECT DISTINCT l_suppkey % 20 AS p, l_orderkey % 50 AS o, l_partkey FROM lineitem) x GROUP BY p"""


_FIRST = f"({_fix_counts(False)})"
_SECOND = f"({_fix_counts(True)})"


@query("two_pass", f"""WITH a AS (SELECT pair_id, columns_missing + types AS bad FROM {_FIRST} x), b AS (SELECT pair_id, columns_s, columns_missing, types FROM {_SECOND} x)
SELECT pair_id, columns_s, columns_missing, columns_missing + types AS critical, round(100.0::DOUBLE - 100.0::DOUBLE * (columns_missing + types)::DOUBLE / columns_s::DOUBLE, 2) AS fidelity_score,
  CASE WHEN columns_missing + types = 0 THEN '3_final' ELSE '2_preprocessed' END AS stage FROM b JOIN a USING (pair_id)""")
def _two_pass(T):
    return two_passes(T)["final"].select("pair_id", "columns_s", "columns_missing", "critical", "fidelity_score", "stage")


@query("remediate_columns", """SELECT pair_id, action, count(*) AS columns FROM (SELECT concat('m', p) AS pair_id, CASE WHEN p = 5 AND o = 7 THEN 'TABLE_MISSING' ELSE 'RESTORED' END AS action
  FROM (SELECT DISTINCT l_suppkey % 20 AS p, l_orderkey % 50 AS o, l_partkey FROM lineitem) x WHERE (p < 8 AND l_partkey % 29 = 0) OR (p = 5 AND o = 7)) y GROUP BY ALL""")
def _remediate_columns(T):
    return two_passes(T)["actions"].groupBy("pair_id", "action").agg(F.count("*").alias("columns"))


@query("as_imported", """SELECT pair_id, category, NOT still AS repaired, count(*) AS findings FROM (SELECT concat('m', p) AS pair_id, CASE WHEN lost THEN 'COLUMN_MISSING' ELSE 'DATA_TYPE' END AS category, (p = 5 AND o = 7) OR NOT lost AS still
  FROM (SELECT *, (p < 8 AND l_partkey % 29 = 0) OR (p = 5 AND o = 7) AS lost FROM (SELECT DISTINCT l_suppkey % 20 AS p, l_orderkey % 50 AS o, l_partkey FROM lineitem) x) y WHERE lost OR (p = 3 AND l_partkey % 40 = 0)) z GROUP BY ALL""")
def _as_imported(T):
    passes = two_passes(T)
    rows = flow.as_imported(passes["initial_findings"], passes["final_findings"])
    return rows.groupBy("pair_id", "category", "repaired").agg(F.count("*").alias("findings"))


@query("remediate_keys", """SELECT "table", action, count(*) AS members FROM (SELECT concat('T', l_orderkey % 300) AS "table", CASE WHEN l_partkey % 3 <> 0 THEN 'KEPT' WHEN l_partkey % 2 = 0 THEN 'RELINKED' ELSE 'COLUMN_MISSING' END AS action
  FROM (SELECT DISTINCT l_orderkey % 300 AS l_orderkey, l_partkey FROM lineitem) x) y GROUP BY ALL""")
def _remediate_keys(T):
    rows = T.lineitem.select((F.col("l_orderkey") % 300).alias("o"), F.col("l_partkey")).distinct()
    code = F.concat(F.lit("c"), F.col("l_partkey").cast("string"))
    table = F.concat(F.lit("T"), F.col("o").cast("string")).alias("table")
    m_ = F.lit("m").alias("pair_id")
    s = rows.groupBy(m_, table).agg(F.array_sort(F.collect_list(code)).alias("members"))
    t = rows.where("l_partkey % 3 <> 0").groupBy(m_, table).agg(F.collect_list(code).alias("members"))
    cols = rows.where("l_partkey % 3 <> 0 or l_partkey % 2 = 0").select(m_, table, code.alias("column"))
    return flow.remediate_keys(s, t, cols)[1].groupBy("table", "action").agg(F.count("*").alias("members"))


@query("remediate_joins", """SELECT l_orderkey AS ref, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 17 = 0 THEN 'SOURCE_INCOMPLETE' WHEN l_suppkey % 9 = 0 THEN 'NO_EDGE' WHEN l_partkey % 7 = 0 THEN 'COLUMN_MISSING' WHEN l_partkey % 5 = 0 THEN 'KEPT' ELSE 'FILLED' END AS outcome FROM lineitem""")
def _remediate_joins(T):
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    missing = T.lineitem.select(
        F.lit("m").alias("pair_id"), F.col("l_orderkey").alias("ref"), "l_linenumber", "l_partkey", "l_suppkey", F.lit("PART").alias("parent_table"),
        F.concat(F.lit("S"), s.cast("string")).alias("child_table"), F.when(p % 17 != 0, F.concat(F.lit("k"), p.cast("string"))).alias("parent_col"),
        F.lit("fk").alias("child_col"), (p % 5 == 0).alias("resolves"))
    cols = T.part.where("p_partkey % 7 <> 0").select(F.lit("m").alias("pair_id"), F.lit("PART").alias("table"), F.concat(F.lit("k"), F.col("p_partkey").cast("string")).alias("column"))
    child = T.supplier.select(F.lit("m").alias("pair_id"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("table"), F.lit("fk").alias("column"))
    edges = T.supplier.where("s_suppkey % 9 <> 0").select(F.lit("m").alias("pair_id"), F.lit("PART").alias("parent_table"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("child_table"))
    return flow.remediate_joins(missing, cols.unionByName(child), edges).select("ref", "l_linenumber", "l_partkey", "l_suppkey", "outcome")


@query("table_matrix", f"""WITH {records_sql()}, {column_findings_sql()}, k AS (SELECT pair_id, tab, count(*) FILTER (status <> 'EXTRA') AS children_s, count(*) FILTER (status <> 'MISSING') AS children_t, count(*) FILTER (status = 'MATCHED') AS children_matched,
  count(*) FILTER (status = 'MISSING') AS children_missing, count(*) FILTER (status = 'EXTRA') AS children_extra FROM rec GROUP BY ALL),
v AS (SELECT pair_id, object_name AS tab, count(*) FILTER (category IN ('COLUMN_MISSING', 'DATA_TYPE')) AS critical, count(*) FILTER (category IN ('COLUMN_EXTRA', 'DATA_TYPE_LENGTH')) AS warning,
  count(*) FILTER (category IN ('NULLABILITY', 'DEFAULT', 'DATA_TYPE_ABSTRACT')) AS info FROM cf GROUP BY ALL)
SELECT pair_id, tab AS "table", 'MATCHED' AS status, children_s, children_t, children_matched, children_missing, children_extra, critical, warning, info FROM k JOIN v USING (pair_id, tab)""")
def _table_matrix(T):
    from veritwin.plans.reports import object_matrix
    from veritwin.session import cut

    records = cut(ph.column_records(columns(T, COL_S), columns(T, COL_T)))
    findings = apply_severity(ph.compare_columns(records, PHYSICAL), PHYSICAL).withColumnRenamed("object_name", "table")
    tables = records.select("pair_id", "table").distinct().withColumn("status", F.lit("MATCHED"))
    return object_matrix(tables, records, findings, ["pair_id", "table"])


@query("edge_matrix", f"""WITH {_fk_sql(FK_S, 's')}, {_fk_sql(FK_T + " UNION ALL SELECT concat('m', l_suppkey % 10), concat('Order', l_orderkey % 100), concat('Supp', l_suppkey % 30), concat('z', l_partkey % 10), " + _ORD + ", concat('FK', l_partkey) FROM lineitem WHERE l_partkey % 10 = 3", 't')},
j AS (SELECT pair_id, sig, split_part(sig, ':', 1) AS ends, coalesce(s.ord, t.ord) AS ord, CASE WHEN s.ord IS NULL THEN 'EXTRA' WHEN t.ord IS NULL THEN 'MISSING' ELSE 'MATCHED' END AS status FROM s FULL JOIN t USING (pair_id, sig, rn)),
a AS (SELECT *, row_number() OVER (PARTITION BY pair_id, ends ORDER BY ord) AS rn2 FROM j WHERE status = 'MISSING'), b AS (SELECT *, row_number() OVER (PARTITION BY pair_id, ends ORDER BY ord) AS rn2 FROM j WHERE status = 'EXTRA')
SELECT pair_id, status, count(*) AS edges FROM (SELECT pair_id, status FROM j WHERE status = 'MATCHED' UNION ALL SELECT coalesce(a.pair_id, b.pair_id), CASE WHEN a.ord IS NULL THEN 'EXTRA' WHEN b.ord IS NULL THEN 'MISSING' ELSE 'JOIN_CHANGED' END FROM a FULL JOIN b ON a.pair_id = b.pair_id AND a.ends = b.ends AND a.rn2 = b.rn2) x GROUP BY ALL""")
def _edge_matrix(T):
    from veritwin.operators.matching import pair_changed_edges
    from veritwin.session import cut

    moved = FK_T + " UNION ALL SELECT concat('m', l_suppkey % 10), concat('Order', l_orderkey % 100), concat('Supp', l_suppkey % 30), concat('z', l_partkey % 10), " + _ORD + ", concat('FK', l_partkey) FROM {lineitem} WHERE l_partkey % 10 = 3"
    records = cut(ph.compare_foreign_keys(references(T, FK_S), references(T, moved))[0])

    def rest(status, side):
        return records.where(F.col("status") == status).select(
            "pair_id", F.upper(f"{side}_parent_table").alias("parent"), F.upper(f"{side}_child_table").alias("child"), F.col(f"{side}_ord").alias("ord"))

    changed = pair_changed_edges(rest("MISSING", "s"), rest("EXTRA", "t"), ["pair_id"]).select("pair_id", "status")
    rows = records.where("status = 'MATCHED'").select("pair_id", "status").unionByName(changed)
    return rows.groupBy("pair_id", "status").agg(F.count("*").alias("edges"))


# --- shaping --------------------------------------------------------------------------


@query("dedupe_objects", f"""SELECT l_orderkey, l_linenumber, first.l_partkey AS first_part, last.l_partkey AS last_part FROM
  (SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(fx.LINE_ORDER)}) AS rn FROM lineitem) x WHERE rn = 1) first
  JOIN (SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in fx.LINE_ORDER)}) AS rn FROM lineitem) x WHERE rn = 1) last USING (l_orderkey, l_linenumber)""")
def _dedupe_objects(T):
    k = ["l_orderkey", "l_linenumber"]
    first = sh.dedupe_objects(T.lineitem, k, fx.LINE_ORDER).select(*k, F.col("l_partkey").alias("first_part"))
    last = sh.dedupe_objects(T.lineitem, k, fx.LINE_ORDER, "last").select(*k, F.col("l_partkey").alias("last_part"))
    return first.join(last, k)


@query("duplicate_report", "SELECT l_orderkey, l_linenumber, count(*) AS objects FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _duplicate_report(T):
    return sh.duplicate_report(T.lineitem, ["l_orderkey", "l_linenumber"])


@query("unique_object_keys", """SELECT p_brand, p_partkey, upper(p_name) || CASE WHEN row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) > 1 THEN '#' || row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) ELSE '' END AS object_key FROM part""")
def _unique_object_keys(T):
    return sh.unique_object_keys(T.part, ["p_brand"], "p_name", ["p_partkey"]).select("p_brand", "p_partkey", "object_key")


@query("collision_warnings", "SELECT p_brand, upper(p_name) AS code, count(*) AS objects FROM part GROUP BY ALL HAVING count(*) > 1")
def _collision_warnings(T):
    return sh.collision_warnings(T.part, ["p_brand"], "p_name")


@query("resolve_refs", """SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN 'UNKNOWN' ELSE coalesce(n_name, s_nationkey::VARCHAR) END AS nation FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 3 <> 0) n ON n_nationkey = s_nationkey""")
def _resolve_refs(T):
    ref = F.when(F.col("s_suppkey") % 7 == 0, " ").otherwise(F.col("s_nationkey").cast("string"))
    rows = T.supplier.select(F.lit("m").alias("pair_id"), "s_suppkey", ref.alias("ref"))
    dim = T.nation.where("n_nationkey % 3 <> 0").select(F.lit("m").alias("pair_id"), F.col("n_nationkey").alias("oid"), F.col("n_name").alias("code"))
    return sh.resolve_refs(rows, ["pair_id"], "ref", dim, "nation").select("s_suppkey", "nation")


@query("inherit_scalar", """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'INT' WHEN p_type NOT IN ('SMALL', 'PROMO') THEN concat('D_', p_type) WHEN p_partkey % 2 = 0 THEN 'ITEM' ELSE '' END AS data_type,
  CASE WHEN p_partkey % 5 = 0 THEN '99' WHEN p_partkey % 3 = 0 THEN '' WHEN p_type NOT IN ('SMALL', 'PROMO') THEN length(p_type)::VARCHAR WHEN p_partkey % 2 = 0 THEN '7' ELSE '' END AS length FROM part""")
def _inherit_scalar(T):
    m_ = F.lit("m").alias("pair_id")
    attrs = T.part.select(
        m_, "p_partkey", F.col("p_type").alias("domain"), (F.col("p_partkey") % 2).alias("item"), F.when(F.col("p_partkey") % 3 == 0, "INT").otherwise("").alias("data_type"),
        F.when(F.col("p_partkey") % 5 == 0, "99").otherwise("").alias("length"), F.lit("").alias("precision"))
    domains = T.part.where("p_type not in ('SMALL', 'PROMO')").select(m_, F.col("p_type").alias("oid")).distinct().select(
        "pair_id", "oid", F.concat(F.lit("D_"), "oid").alias("data_type"), F.length("oid").cast("string").alias("length"), F.lit("").alias("precision"))
    items = T.part.select(m_, (F.col("p_partkey") % 2).alias("oid")).distinct().where("oid = 0").select(
        "pair_id", "oid", F.lit("ITEM").alias("data_type"), F.lit("7").alias("length"), F.lit("").alias("precision"))
    return sh.inherit_scalar(attrs, domains, ["pair_id"], "domain", items, "item").select("p_partkey", "data_type", "length")


@query("mark_primary", """WITH i AS (SELECT l_orderkey AS entity, l_linenumber % 3 AS ord, list_sort(list_distinct(list('A' || l_partkey))) AS members FROM lineitem GROUP BY ALL),
f AS (SELECT l_orderkey AS entity, list_sort(list_distinct(list('A' || l_partkey) FILTER (l_linenumber % 3 = 1))) AS flagged FROM lineitem GROUP BY ALL),
r AS (SELECT i.entity, ord, CASE WHEN i.entity % 4 = 0 AND ord = 2 THEN 1 WHEN members = flagged THEN 2 END AS ev FROM i LEFT JOIN f USING (entity)),
b AS (SELECT entity, ord, ev, row_number() OVER (PARTITION BY entity ORDER BY ev, ord) AS rn FROM r WHERE ev IS NOT NULL)
SELECT r.entity, r.ord, b.entity IS NOT NULL AS is_primary, CASE b.ev WHEN 1 THEN 'POINTER' WHEN 2 THEN 'FLAGS' END AS evidence FROM r LEFT JOIN (SELECT * FROM b WHERE rn = 1) b USING (entity, ord)""")
def _mark_primary(T):
    k = (F.col("l_linenumber") % 3).alias("ord")
    code = F.concat(F.lit("a"), F.col("l_partkey").cast("string"))
    ids = T.lineitem.groupBy(F.col("l_orderkey").alias("entity"), k).agg(F.collect_list(code).alias("members")).withColumn("oid", F.col("ord"))
    attrs = T.lineitem.select(F.col("l_orderkey").alias("entity"), F.upper(code).alias("code"), (k == 1).alias("is_primary"))
    pointers = T.lineitem.where("l_orderkey % 4 = 0").select(F.col("l_orderkey").alias("entity"), F.lit(2).alias("primary_oid")).distinct()
    return sh.mark_primary(ids, attrs, pointers, ["entity"]).select("entity", F.col("ord"), "is_primary", "evidence")


@query("derive_identifying", """WITH k AS (SELECT l_orderkey AS e, list(l_partkey % 40) AS m FROM lineitem GROUP BY ALL) SELECT o_orderkey, coalesce(list_has_any(a.m, b.m), FALSE) AS identifying
FROM orders LEFT JOIN k a ON a.e = o_orderkey LEFT JOIN k b ON b.e = o_custkey""")
def _derive_identifying(T):
    m_ = F.lit("m").alias("pair_id")
    keys = T.lineitem.groupBy(m_, F.col("l_orderkey").alias("entity")).agg(F.collect_set(F.concat(F.lit("k"), (F.col("l_partkey") % 40).cast("string"))).alias("members"))
    rel = T.orders.select(m_, F.col("o_orderkey").alias("parent"), F.col("o_custkey").alias("child"), "o_orderkey")
    return sh.derive_identifying(rel, keys, ["pair_id"]).select("o_orderkey", "identifying")


@query("subtype_trees", """SELECT o_custkey AS parent, count(DISTINCT o_orderkey % 50) AS children, min(o_orderkey) AS ord FROM orders WHERE o_orderkey % 3 = 0 GROUP BY o_custkey""")
def _subtype_trees(T):
    rel = T.orders.select(
        F.lit("m").alias("pair_id"), F.col("o_custkey").alias("parent"), (F.col("o_orderkey") % 50).alias("child"), F.col("o_orderkey").alias("ord"),
        F.when(F.col("o_orderkey") % 3 == 0, "SUBTYPE").otherwise("IDENTIFYING").alias("type"))
    return sh.subtype_trees(rel, ["pair_id"])[0].select("parent", "children", "ord")


@query("drop_hidden_duplicates", "SELECT l_partkey, l_suppkey, count(*) AS kept FROM lineitem WHERE l_linenumber <> 7 AND (l_partkey % 3 = 0 OR l_partkey % 3 = 1) GROUP BY ALL")
def _drop_hidden_duplicates(T):
    p = F.col("l_partkey")
    rows = T.lineitem.select(
        "l_partkey", "l_suppkey", F.col("l_orderkey").alias("oid"), (F.col("l_linenumber") == 7).alias("hidden"),
        F.when(p % 3 == 0, "").when(p % 3 == 1, F.col("l_orderkey").cast("string")).otherwise("another").alias("lead_ref"))
    return sh.drop_hidden_duplicates(rows).groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("kept"))


@query("drop_tool_objects", "SELECT p_partkey FROM part WHERE p_size % 3 = 0 AND p_partkey % 5 NOT IN (1, 2)")
def _drop_tool_objects(T):
    built_in = F.when(F.col("p_size") % 3 == 0, F.when(F.col("p_size") % 2 == 0, "0").otherwise("")).otherwise(F.col("p_size").cast("string"))
    group = F.when(F.col("p_partkey") % 5 == 1, "if3").when(F.col("p_partkey") % 5 == 2, "Inversion Entry").otherwise("AK1")
    rows = T.part.select("p_partkey", built_in.alias("built_in"), group.alias("key_group"))
    return sh.drop_tool_objects(rows, "built_in", "key_group").select("p_partkey")


@query("is_migrated_key", "SELECT o_orderstatus, o_orderpriority, count(*) FILTER (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT' OR o_orderkey % 5 = 0) AS migrated FROM orders GROUP BY ALL")
def _is_migrated_key(T):
    rows = T.orders.select(
        "o_orderstatus", "o_orderpriority", F.when(F.col("o_orderstatus") == "F", " TRUE ").otherwise("0").alias("flag"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "fk").otherwise("plain").alias("key_type"), F.when(F.col("o_orderkey") % 5 == 0, "p1").otherwise(" ").alias("parent_ref"))
    moved = rows.withColumn("m", sh.is_migrated_key(["flag"], "key_type", "parent_ref"))
    return moved.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.when(F.col("m"), True)).alias("migrated"))


@query("physical_fk_joins", """SELECT ref, evidence, count(*) AS joins FROM (SELECT l_orderkey AS ref, 'EXPLICIT' AS evidence FROM lineitem WHERE l_orderkey % 3 = 0
  UNION ALL SELECT l_orderkey, 'MIGRATED' FROM lineitem WHERE l_partkey % 2 = 0 AND l_orderkey % 3 <> 0) x GROUP BY ALL""")
def _physical_fk_joins(T):
    rows = T.lineitem.select(F.col("l_orderkey").alias("ref"), F.col("l_linenumber").alias("ord"), F.col("l_partkey").alias("parent_col"), F.col("l_suppkey").alias("child_col"))
    out = sh.physical_fk_joins(rows.where("ref % 3 = 0"), rows.where("parent_col % 2 = 0"), ["ref"])
    return out.groupBy("ref", "evidence").agg(F.count("*").alias("joins"))
