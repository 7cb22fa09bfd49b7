"""Matching operators."""

from pyspark.sql import functions as F

from veritwin.operators import matching as m

from . import fixtures as fx
from .base import ORACLES, Tables, key, ladder, named_keys, norm, plain, query, squeeze, txt

_FOUR = [k for k in named_keys() if k[0] != "name↔code"]
_PART_S, _PART_T = plain(fx.PART_S), plain(fx.PART_T)


def part_sides(T: Tables):
    return T.sql(fx.PART_S), T.sql(fx.PART_T)


def _ladder_rows(scope: list[str]) -> str:
    sc = ", ".join(scope)
    return (
        f"SELECT {sc}, s_id, t_id, basis FROM lp UNION ALL SELECT {sc}, id, NULL, 'S_ONLY' FROM ls "
        f"UNION ALL SELECT {sc}, NULL, id, 'T_ONLY' FROM lt"
    )


def ladder_rows(match: m.Match):
    nothing = F.lit(None).cast("bigint")
    s_only = match.s_only.withColumn("t_id", nothing).withColumn("basis", F.lit("S_ONLY"))
    t_only = match.t_only.withColumn("s_id", nothing).withColumn("basis", F.lit("T_ONLY"))
    return match.pairs.unionByName(s_only).unionByName(t_only)


@query("match_ladder", f"WITH {ladder(_PART_S, _PART_T, ['pair_id'], _FOUR)} {_ladder_rows(['pair_id'])}")
def _match_ladder(T):
    s, t = part_sides(T)
    keys = [k for k in m.name_code_keys() if k[0] != "name↔code"]
    return ladder_rows(m.match_ladder(s, t, ["pair_id"], keys))


def _by_mode(mode):
    sql = (
        f"WITH {ladder(_PART_S, _PART_T, ['pair_id'], named_keys(mode))} "
        "SELECT pair_id, basis, count(*) AS pairs FROM lp GROUP BY ALL"
    )

    @query(f"match_by_{mode}", sql)
    def _run(T):
        s, t = part_sides(T)
        found = m.match_ladder(s, t, ["pair_id"], m.name_code_keys(mode))
        return found.pairs.groupBy("pair_id", "basis").agg(F.count("*").alias("pairs"))


for _mode in ("code", "name", "normalized", "auto"):
    _by_mode(_mode)


# --- relationships, hierarchies, domains, rules ---------------------------------------


def edges(T: Tables, text: str):
    """EDGE rows with their ends as structs and canonical cardinalities."""
    from veritwin.functions import cardinality as card

    def end(p):
        return F.struct(
            F.col(f"{p}_entity").alias("entity"), F.col(f"{p}_role").alias("role"), F.col(f"{p}_card").alias("cardinality"),
            F.col(f"{p}_dep").alias("dependent"))

    rows = T.sql(text).select(
        "pair_id", "id", "ord", "name", "code", "definition", "kind", end("e1").alias("end1"), end("e2").alias("end2"))
    return card.with_signatures(card.canonical_ends(rows))


def edge_sql(text: str) -> str:
    """EDGE subquery with c1, c2 (canonical), es, ns, nes, fs (signatures) and the ends' keys."""
    from .expressions import card_sql

    inner = card_sql(card_sql(f"({plain(text)}) e0", "e1_card", out="c1"), "e2_card", out="c2")
    k1, k2 = norm("e1_entity"), norm("e2_entity")
    swap = f"{key('e1_entity')} > {key('e2_entity')}"
    label = norm(f"regexp_replace({trim_sql('CASE WHEN code <> chr(0) AND length(code) > 0 THEN code ELSE name END')}, '/\\d+$', '')")
    f1, f2 = f"concat({k1}, '[', CASE WHEN c1 = '' THEN '?' ELSE c1 END, ']')", f"concat({k2}, '[', CASE WHEN c2 = '' THEN '?' ELSE c2 END, ']')"
    return (
        f"(SELECT *, concat(ns, '##', es) AS nes FROM (SELECT *, {swap} AS swapped, "
        f"CASE WHEN {swap} THEN concat({k2}, '::', {k1}) ELSE concat({k1}, '::', {k2}) END AS es, {label} AS ns, "
        f"CASE WHEN {swap} THEN concat({f2}, '::', {f1}) ELSE concat({f1}, '::', {f2}) END AS fs FROM {inner} e1) e2)")


def trim_sql(x: str) -> str:
    from .base import trim

    return trim(x)


EDGE_KEYS = [("name", "ns", "ns"), ("name+endpoints", "nes", "nes"), ("endpoints+cardinality", "fs", "fs"), ("endpoints", "es", "es")]


def edge_ladder() -> str:
    s, t = edge_sql(fx.EDGE_S), edge_sql(fx.EDGE_T)
    return ladder(f"SELECT * FROM {s} a", f"SELECT * FROM {t} a", ["pair_id"], EDGE_KEYS)


@query("relationship_signatures", f"SELECT id, es AS endpoints, fs AS full_signature, ns AS name_key, nes AS name_endpoints FROM {edge_sql(fx.EDGE_S)} x")
def _relationship_signatures(T):
    return edges(T, fx.EDGE_S).select(
        "id", F.col("ends_key").alias("endpoints"), F.col("full_key").alias("full_signature"), F.col("name_key"),
        F.col("name_ends_key").alias("name_endpoints"))


@query("match_relationships", f"WITH {edge_ladder()} {_ladder_rows(['pair_id'])}")
def _match_relationships(T):
    s, t = edges(T, fx.EDGE_S), edges(T, fx.EDGE_T)
    return ladder_rows(m.match_ladder(s, t, ["pair_id"], m.relationship_keys()))


def trees(T: Tables, text: str):
    """(trees, children) of TREE rows."""
    rows = T.sql(text)
    heads = rows.select("pair_id", "id", "parent", "name", "code", "complete", "mutually_exclusive").distinct()
    return heads.withColumn("id", F.concat("pair_id", F.lit("/"), F.col("id").cast("string"))), rows.select(
        "pair_id", F.concat("pair_id", F.lit("/"), F.col("id").cast("string")).alias("id"), "child", "ord")


def tree_sql(text: str) -> str:
    return (
        "SELECT DISTINCT pair_id, concat(pair_id, '/', id) AS id, parent, name, code, complete, mutually_exclusive "
        f"FROM ({plain(text)}) q")


TREE_KEYS = [("supertype", norm("parent"), norm("parent")), ("name", norm("name"), norm("name"))]


def _tree_ladder() -> str:
    return ladder(tree_sql(fx.TREE_S), tree_sql(fx.TREE_T), ["pair_id"], TREE_KEYS)


def _string_ladder_rows(match):
    nothing = F.lit(None).cast("string")
    s_only = match.s_only.withColumn("t_id", nothing).withColumn("basis", F.lit("S_ONLY"))
    t_only = match.t_only.withColumn("s_id", nothing).withColumn("basis", F.lit("T_ONLY"))
    return match.pairs.unionByName(s_only).unionByName(t_only)


@query("match_hierarchies", f"WITH {_tree_ladder()} {_ladder_rows(['pair_id'])}")
def _match_hierarchies(T):
    return _string_ladder_rows(
        m.match_ladder(trees(T, fx.TREE_S)[0], trees(T, fx.TREE_T)[0], ["pair_id"], m.hierarchy_keys()))


DOMAIN_S = """SELECT p_brand AS pair_id, concat(p_brand, '/', p_type, '/', p_size % 10) AS id, concat(p_type, '_', p_size % 10) AS code,
  concat(lower(p_type), ' size ', p_size % 10) AS name, CASE WHEN p_size % 10 < 5 THEN 'VARCHAR(20)' ELSE 'DC10,2' END AS data_type,
  '' AS length, '' AS precision, concat('Domain of ', p_type) AS definition FROM {part} GROUP BY p_brand, p_type, p_size % 10"""
DOMAIN_T = """SELECT p_brand AS pair_id, concat(p_brand, '/', p_type, '/', p_size % 10) AS id,
  CASE WHEN p_size % 10 IN (3, 4) THEN concat('D', p_size % 10, p_type) ELSE concat(p_type, '_', p_size % 10) END AS code,
  CASE WHEN p_size % 10 = 4 THEN concat(p_type, '_SIZES_', p_size % 10) ELSE concat(lower(p_type), ' size ', p_size % 10) END AS name,
  CASE WHEN p_size % 10 = 7 THEN 'TIMESTAMP' WHEN p_size % 10 < 5 THEN 'VARCHAR(20)' ELSE 'NUMERIC(10,2)' END AS data_type,
  '' AS length, '' AS precision, CASE WHEN p_size % 10 = 8 THEN '' ELSE concat('Domain of ', p_type) END AS definition
FROM {part} WHERE p_size % 10 <> 9 GROUP BY p_brand, p_type, p_size % 10
UNION ALL SELECT p_brand, concat('new ', p_type), concat('new ', p_type), concat('new ', p_type), 'DATE', '', '', '' FROM {part} GROUP BY p_brand, p_type"""
DOMAIN_KEYS = [("code", key("code"), key("code")), ("name", key("name"), key("name")), ("normalized name", norm("name"), norm("name"))]


def domain_ladder() -> str:
    return ladder(plain(DOMAIN_S), plain(DOMAIN_T), ["pair_id"], DOMAIN_KEYS)


@query("match_domains", f"WITH {domain_ladder()} {_ladder_rows(['pair_id'])}")
def _match_domains(T):
    return _string_ladder_rows(m.match_ladder(T.sql(DOMAIN_S), T.sql(DOMAIN_T), ["pair_id"], m.domain_keys()))


# Rules: documents as expressions, matched by name.
RULE_S = """SELECT source AS pair_id, doc_id AS id, concat('rule ', doc_id) AS name, '' AS code, text AS expression, '' AS definition FROM {documents}"""
RULE_T = """SELECT source AS pair_id, doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN concat('RULE_', doc_id) ELSE concat('rule ', doc_id) END AS name, '' AS code,
  CASE WHEN doc_id % 5 = 0 THEN concat(text, ' unless revoked') WHEN doc_id % 3 = 0 THEN concat(' ', text, ' ') ELSE text END AS expression, '' AS definition
FROM {documents} WHERE doc_id % 17 <> 0"""
RULE_KEYS = [("name", key("name"), key("name")), ("normalized name", norm("name"), norm("name"))]


def rule_ladder() -> str:
    return ladder(plain(RULE_S), plain(RULE_T), ["pair_id"], RULE_KEYS)


@query("match_rules", f"WITH {rule_ladder()} {_ladder_rows(['pair_id'])}")
def _match_rules(T):
    return ladder_rows(m.match_ladder(T.sql(RULE_S), T.sql(RULE_T), ["pair_id"], m.rule_keys()))


# --- renamed entities -----------------------------------------------------------------

_ALIAS = """SELECT DISTINCT concat('R', {k} % 5) AS pair_id, concat('NATION', {k}) AS alias_key,
  CASE WHEN {k} % 2 = 0 THEN concat('LAND_', {k}) ELSE concat('NATION_', {k}) END AS t_code FROM {{nation}}"""


@query("rewrite_endpoints", f"""WITH al AS ({plain(_ALIAS.format(k='n_nationkey').replace('{{', '{').replace('}}', '}'))})
SELECT e.pair_id, e.id, coalesce(a.t_code, e.e1_entity) AS entity1, coalesce(b.t_code, e.e2_entity) AS entity2
FROM ({plain(fx.EDGE_S)}) e LEFT JOIN al a ON a.pair_id = e.pair_id AND a.alias_key = {norm('e.e1_entity')}
LEFT JOIN al b ON b.pair_id = e.pair_id AND b.alias_key = {norm('e.e2_entity')}""")
def _rewrite_endpoints(T):
    alias = T.sql(_ALIAS.format(k="n_nationkey"))
    out = m.rewrite_endpoints(edges(T, fx.EDGE_S), ["pair_id"], alias)
    return out.select("pair_id", "id", F.col("end1.entity").alias("entity1"), F.col("end2.entity").alias("entity2"))


# --- keyed and multiset matching ------------------------------------------------------


@query("reconcile_keyed", f"""SELECT id, CASE WHEN s.id IS NULL THEN 'EXTRA' WHEN t.id IS NULL THEN 'MISSING' ELSE 'MATCHED' END AS status,
  s.acctbal AS s_acctbal, t.acctbal AS t_acctbal, s.segment AS s_segment, t.segment AS t_segment
FROM ({plain(fx.CUST_S)}) s FULL JOIN ({plain(fx.CUST_T)}) t USING (id)""")
def _reconcile_keyed(T):
    out = m.reconcile_keyed(T.sql(fx.CUST_S), T.sql(fx.CUST_T), ["id"])
    return out.select("id", "status", "s_acctbal", "t_acctbal", "s_segment", "t_segment")


_LO = ", ".join(fx.LINE_ORDER)


def line_sql() -> str:
    return f"""l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LO}) AS rn FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LO}) AS rn FROM lineitem WHERE l_partkey % 10 <> 0),
j AS (SELECT l_orderkey, l_linenumber, rn, l.l_partkey AS s_part, r.l_partkey AS t_part,
  CASE WHEN l.l_partkey IS NULL THEN 'EXTRA' WHEN r.l_partkey IS NULL THEN 'MISSING' ELSE 'MATCHED' END AS status
  FROM l FULL JOIN r USING (l_orderkey, l_linenumber, rn))"""


@query("match_multiset", f"WITH {line_sql()} SELECT l_orderkey, l_linenumber, rn::INTEGER AS occurrence, s_part, t_part, status FROM j")
def _match_multiset(T):
    out = m.match_multiset(T.sql(fx.LINE_S), T.sql(fx.LINE_T), ["l_orderkey", "l_linenumber"], fx.LINE_ORDER, fx.LINE_ORDER)
    return out.select("l_orderkey", "l_linenumber", "occurrence", F.col("s_l_partkey").alias("s_part"), F.col("t_l_partkey").alias("t_part"), "status")


@query("match_multiset_hot_groups", """WITH l AS (SELECT l_returnflag AS flag, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_linestatus, l_shipdate) AS rn, l_orderkey, l_partkey % 10 = 0 AS gone FROM lineitem)
SELECT flag, count(*) AS rows, max(rn)::INTEGER AS last, sum(rn * (l_orderkey % 97))::BIGINT AS checksum FROM l GROUP BY flag""")
def _match_multiset_hot_groups(T):
    """Three groups hold the whole table: numbered in range blocks, not in one task each."""
    from veritwin.operators.ordered import number_within

    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linestatus", "l_shipdate"]
    rows = number_within(T.lineitem, ["l_returnflag"], order, "rn")
    return rows.groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.count("*").alias("rows"), F.max("rn").alias("last"), F.sum(F.col("rn") * (F.col("l_orderkey") % 97)).alias("checksum"))


@query("multiset_counts", """SELECT l_orderkey, l_linenumber, count(*) AS n_s, count(*) FILTER (l_partkey % 10 <> 0) AS n_t,
  count(*) FILTER (l_partkey % 10 <> 0) AS matched, count(*) FILTER (l_partkey % 10 = 0) AS missing, 0::BIGINT AS extra FROM lineitem GROUP BY ALL""")
def _multiset_counts(T):
    return m.multiset_counts(T.sql(fx.LINE_S), T.sql(fx.LINE_T), ["l_orderkey", "l_linenumber"])


_TIERED = f"""s AS ({_PART_S}), t AS ({_PART_T}),
t1 AS (SELECT pair_id, name, code, max(id) AS id FROM t GROUP BY ALL),
t2 AS (SELECT pair_id, code, min(id) AS id FROM t GROUP BY ALL HAVING count(*) = 1),
t3 AS (SELECT pair_id, lower(trim(name)) AS n, min(id) AS id FROM t GROUP BY ALL HAVING count(*) = 1),
h AS (SELECT s.pair_id, s.id AS s_id, s.ord, s.definition, CASE WHEN t1.id IS NOT NULL THEN 1 WHEN t2.id IS NOT NULL THEN 2 WHEN t3.id IS NOT NULL THEN 3 END AS tier,
  coalesce(t1.id, t2.id, t3.id) AS t_id FROM s LEFT JOIN t1 USING (pair_id, name, code) LEFT JOIN t2 USING (pair_id, code)
  LEFT JOIN t3 ON t3.pair_id = s.pair_id AND t3.n = lower(trim(s.name)))"""


@query("match_tiered", f"""WITH {_TIERED}, f AS (SELECT *, row_number() OVER (PARTITION BY pair_id, t_id ORDER BY ord) AS rn FROM h)
SELECT pair_id, s_id, CASE WHEN t_id IS NOT NULL AND rn = 1 THEN tier END AS tier, CASE WHEN t_id IS NOT NULL AND rn = 1 THEN t_id END AS t_id FROM f""")
def _match_tiered(T):
    s, t = part_sides(T)
    return m.match_tiered(s, t, ["pair_id"])


@query("match_tiered_shared", f"WITH {_TIERED} SELECT pair_id, s_id, tier, t_id FROM h")
def _match_tiered_shared(T):
    s, t = part_sides(T)
    return m.match_tiered(s, t, ["pair_id"], exclusive=False)


_EDGE_ENDS = "CASE WHEN upper(e1_entity) <= upper(e2_entity) THEN concat(e1_entity, '|', e2_entity) ELSE concat(e2_entity, '|', e1_entity) END AS ends"


@query("match_edges_tiered", f"""WITH s AS (SELECT pair_id, id, lower(trim(name)) AS n, {_EDGE_ENDS} FROM ({plain(fx.EDGE_S)}) a),
t AS (SELECT pair_id, id, lower(trim(name)) AS n, {_EDGE_ENDS} FROM ({plain(fx.EDGE_T)}) a),
u AS (SELECT pair_id, ends, n, min(id) AS t_id FROM t GROUP BY ALL HAVING count(*) = 1),
p1 AS (SELECT s.pair_id, min(s.id) AS s_id, u.t_id FROM s JOIN u USING (pair_id, ends, n) GROUP BY s.pair_id, u.t_id),
u2 AS (SELECT pair_id, ends, min(id) AS t_id FROM t WHERE id NOT IN (SELECT t_id FROM p1) GROUP BY ALL HAVING count(*) = 1),
p2 AS (SELECT s.pair_id, min(s.id) AS s_id, u2.t_id FROM s JOIN u2 USING (pair_id, ends) WHERE s.id NOT IN (SELECT s_id FROM p1) GROUP BY s.pair_id, u2.t_id)
SELECT pair_id, s_id, t_id, 1 AS tier FROM p1 UNION ALL SELECT pair_id, s_id, t_id, 2 FROM p2""")
def _match_edges_tiered(T):
    ends = F.expr(
        "CASE WHEN upper(e1_entity) <= upper(e2_entity) THEN concat(e1_entity, '|', e2_entity) ELSE concat(e2_entity, '|', e1_entity) END")
    s, t = (T.sql(x).select("pair_id", "id", "name", ends.alias("ends")) for x in (fx.EDGE_S, fx.EDGE_T))
    return m.match_edges_tiered(s, t, ["pair_id"])


def _claim_sql() -> str:
    parts = [
        f"s0 AS (SELECT pair_id, id, {norm('name')} AS n, {norm('code')} AS c FROM ({_CLAIM_S}) x)",
        f"t0 AS (SELECT pair_id, id, {norm('name')} AS n, {norm('code')} AS c FROM ({_CLAIM_T}) x)",
    ]
    for i, (a, b) in enumerate((("n", "n"), ("n", "c"), ("c", "n"), ("c", "c"))):
        parts.append(
            f"p{i} AS (SELECT a.pair_id, a.id AS s_id, b.id AS t_id FROM (SELECT *, row_number() OVER (PARTITION BY pair_id, {a} ORDER BY id) AS rn FROM s{i} WHERE {a} <> '') a "
            f"JOIN (SELECT *, row_number() OVER (PARTITION BY pair_id, {b} ORDER BY id) AS rn FROM t{i} WHERE {b} <> '') b ON a.pair_id = b.pair_id AND a.{a} = b.{b} AND a.rn = b.rn)")
        parts.append(f"s{i + 1} AS (SELECT * FROM s{i} WHERE id NOT IN (SELECT s_id FROM p{i}))")
        parts.append(f"t{i + 1} AS (SELECT * FROM t{i} WHERE id NOT IN (SELECT t_id FROM p{i}))")
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(f"SELECT * FROM p{i}" for i in range(4))


CLAIM_S = "SELECT p_brand AS pair_id, p_partkey AS id, p_partkey AS ord, p_name AS name, concat('P', p_partkey) AS code FROM {part}"
CLAIM_T = """SELECT p_brand AS pair_id, p_partkey AS id, p_partkey AS ord,
  CASE WHEN p_partkey % 4 = 0 THEN concat('P', p_partkey) WHEN p_partkey % 7 = 0 THEN concat('other ', p_partkey) ELSE upper(p_name) END AS name,
  CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE concat('P', p_partkey) END AS code FROM {part} WHERE p_partkey % 3 <> 0"""
_CLAIM_S, _CLAIM_T = plain(CLAIM_S), plain(CLAIM_T)


@query("claim_first", _claim_sql())
def _claim_first(T):
    return m.claim_first(T.sql(CLAIM_S), T.sql(CLAIM_T), ["pair_id"])


# --- members --------------------------------------------------------------------------


def members(T: Tables):
    """MEMB: ordered member arrays per order, lost members and reversed ones on the T side."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    orders = T.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("l"))
    code = F.transform("l", lambda x: F.concat(F.lit("P"), x["l_partkey"].cast("string")))
    kept = F.filter("l", lambda x: x["l_partkey"] % 37 != 0)
    t_code = F.transform(kept, lambda x: F.concat(F.lit("p_"), x["l_partkey"].cast("string")))
    k = F.col("l_orderkey") % 4
    return orders.select(
        F.col("l_orderkey").alias("id"), code.alias("s_members"),
        F.when(k == 0, t_code).when(k == 1, F.reverse(code)).otherwise(code).alias("t_members"))


MEMB_SQL = """SELECT l_orderkey AS id, list('P' || l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS s_members,
  CASE WHEN l_orderkey % 4 = 0 THEN coalesce(list('p_' || l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) FILTER (l_partkey % 37 <> 0), [])
    WHEN l_orderkey % 4 = 1 THEN list_reverse(list('P' || l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice))
    ELSE list('P' || l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) END AS t_members FROM lineitem GROUP BY l_orderkey"""
_NN = "lambda x: upper(replace(x, '_', ''))"
MEMB_DIFF = f"""SELECT *, list_sort(list_distinct(list_filter(a, lambda x: NOT list_contains(b, x)))) AS lost,
  list_sort(list_distinct(list_filter(b, lambda x: NOT list_contains(a, x)))) AS added
FROM (SELECT *, list_transform(s_members, {_NN}) AS a, list_transform(t_members, {_NN}) AS b FROM ({MEMB_SQL}) m0) m1"""


@query("member_diff", f"""SELECT id, lost, added, CASE WHEN len(lost) > 0 OR len(added) > 0 THEN 'COMPOSITION' WHEN a <> b THEN 'ORDER' ELSE 'EQUAL' END AS relation FROM ({MEMB_DIFF}) x""")
def _member_diff(T):
    return members(T).select("id", m.member_diff(F.col("s_members"), F.col("t_members")).alias("d")).select("id", "d.*")


_SIG_S = "SELECT l_orderkey, l_suppkey % 3 AS kind, concat(l_orderkey, '/', l_suppkey % 3, '/', l_linenumber % 3) AS sig, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS ord FROM {lineitem}"
_SIG_T = _SIG_S + " WHERE l_partkey % 10 <> 0 UNION ALL SELECT l_orderkey, 9, concat(l_orderkey, '/new'), l_partkey * 100000 + l_suppkey * 10 + l_linenumber FROM {lineitem} WHERE l_partkey % 19 = 0"


@query("match_by_signature", f"""WITH s AS (SELECT l_orderkey, kind, sig, max(ord) AS ord, count(*) AS holders FROM ({plain(_SIG_S)}) a GROUP BY ALL),
t AS (SELECT l_orderkey, kind, sig, max(ord) AS ord, count(*) AS holders FROM ({plain(_SIG_T)}) a GROUP BY ALL)
SELECT l_orderkey, kind, sig AS signature, s.ord AS s_row, t.ord AS t_row, s.holders AS s_holders, t.holders AS t_holders,
  CASE WHEN s.ord IS NULL THEN 'EXTRA' WHEN t.ord IS NULL THEN 'MISSING' ELSE 'MATCHED' END AS status FROM s FULL JOIN t USING (l_orderkey, kind, sig)""")
def _match_by_signature(T):
    s, t = (T.sql(x).withColumnRenamed("sig", "signature").withColumn("row", F.col("ord")) for x in (_SIG_S, _SIG_T))
    return m.match_by_signature(s, t, ["l_orderkey", "kind"])


_CE = "SELECT 'p' AS pair_id, concat('S', l_suppkey) AS parent, concat('P', l_partkey % 50) AS child, l_orderkey * 1000000000 + l_partkey * 10000 + l_suppkey * 10 + l_linenumber AS ord FROM {lineitem} WHERE l_partkey % 10 = "


@query("pair_changed_edges", f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY parent, child ORDER BY ord) AS rn FROM ({plain(_CE)}0) a),
t AS (SELECT *, row_number() OVER (PARTITION BY parent, child ORDER BY ord) AS rn FROM ({plain(_CE)}0 AND l_orderkey % 2 = 0 UNION ALL {plain(_CE)}3) a)
SELECT parent, child, CASE WHEN s.rn IS NULL THEN 'EXTRA' WHEN t.rn IS NULL THEN 'MISSING' ELSE 'JOIN_CHANGED' END AS status, count(*) AS edges
FROM s FULL JOIN t USING (parent, child, rn) GROUP BY ALL""")
def _pair_changed_edges(T):
    s, t = T.sql(_CE + "0"), T.sql(f"{_CE}0 AND l_orderkey % 2 = 0 UNION ALL {_CE}3")
    return m.pair_changed_edges(s, t, ["pair_id"]).groupBy("parent", "child", "status").agg(F.count("*").alias("edges"))


@query("orphans", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _orphans(T):
    return m.orphans(T.customer.select("c_custkey"), T.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


# --- as-of, prefixes, snapshots -------------------------------------------------------

_ASOF = """WITH a AS (SELECT user_id, ts, max(event_id) AS anchor FROM events WHERE event_type = 'signup' GROUP BY ALL)
SELECT v.user_id, v.event_id AS id, a.anchor AS owner FROM (SELECT * FROM events WHERE event_type = 'purchase') v
ASOF LEFT JOIN a ON a.user_id = v.user_id AND v.ts >= a.ts"""


def _asof(T):
    e = T.events.withColumnRenamed("event_id", "id")
    values = e.where("event_type = 'purchase'").select("user_id", "ts", "id")
    anchors = e.where("event_type = 'signup'").select("user_id", "ts", "id", F.col("id").alias("owner"))
    return m.asof_owner(values, anchors, ["user_id"], "ts", "owner").select("user_id", "id", "owner")


@query("asof_owner", _ASOF)
def _asof_owner(T):
    return _asof(T)


@query("asof_owner_hot_groups", """WITH e AS (SELECT event_id AS id, ts, user_id % 3 AS g, event_type FROM events), a AS (SELECT g, id AS anchor, row_number() OVER (PARTITION BY g ORDER BY ts, id) AS n, ts FROM e WHERE event_type = 'signup'),
v AS (SELECT g, id, ts FROM e WHERE event_type = 'purchase'), j AS (SELECT v.g, v.id, max(a.n) AS n FROM v LEFT JOIN a ON a.g = v.g AND a.ts <= v.ts GROUP BY ALL)
SELECT j.g, j.id, a.anchor AS owner FROM j LEFT JOIN a ON a.g = j.g AND a.n = j.n""")
def _asof_owner_hot(T):
    """Three groups hold the whole table."""
    e = T.events.withColumnRenamed("event_id", "id").withColumn("g", F.col("user_id") % 3)
    values = e.where("event_type = 'purchase'").select("g", "ts", "id")
    anchors = e.where("event_type = 'signup'").select("g", "ts", "id", F.col("id").alias("owner"))
    return m.asof_owner(values, anchors, ["g"], "ts", "owner").select("g", "id", "owner")


_EXTRA = "SELECT 'm' AS pair_id, concat('T', p_partkey % 10) AS owner, p_partkey AS id, concat(p_type, ' ', p_name) AS name, upper(replace(p_name, ' ', '_')) AS code FROM {part}"
_PARTNERS = """SELECT DISTINCT 'm' AS pair_id, concat('T', p_partkey % 7) AS owner, CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN concat(split_part(p_name, ' ', 1), ' thing') ELSE concat(p_type, ' ', split_part(p_name, ' ', 1)) END AS partner
FROM {part} WHERE p_partkey % 41 = 0"""


@query("explain_extra_by_prefix", f"""WITH e AS (SELECT *, upper(code) AS c, replace(upper(name), ' ', '_') AS n FROM ({plain(_EXTRA)}) a),
p AS (SELECT *, replace(upper(partner), ' ', '_') AS tok FROM ({plain(_PARTNERS)}) a),
h AS (SELECT e.owner, e.id, CASE WHEN starts_with(c, tok) OR starts_with(n, tok) THEN 1 ELSE 2 END AS tier, partner FROM e JOIN p USING (owner)
  WHERE starts_with(c, tok) OR starts_with(n, tok) OR (length(split_part(tok, '_', 1)) >= 4 AND (starts_with(c, split_part(tok, '_', 1)) OR starts_with(n, split_part(tok, '_', 1))))),
b AS (SELECT *, row_number() OVER (PARTITION BY owner, id ORDER BY tier, length(partner) DESC, partner) AS rn FROM h)
SELECT e.owner, e.id, CASE b.tier WHEN 1 THEN 'FK_PROPAGATED' WHEN 2 THEN 'POSSIBLY_FK' ELSE 'UNEXPLAINED' END AS reason, b.partner
FROM e LEFT JOIN (SELECT * FROM b WHERE rn = 1) b USING (owner, id)""")
def _explain_extra(T):
    return m.explain_extra_by_prefix(T.sql(_EXTRA), T.sql(_PARTNERS), ["pair_id"]).drop("pair_id")


_CELLS = """SELECT id, unnest([{{'property': 'name', 'value': name}}, {{'property': 'nation', 'value': nation::VARCHAR}}, {{'property': 'segment', 'value': segment}}], recursive := true) FROM ({x}) z"""


def diff_sql() -> str:
    return f"""b0 AS (SELECT * FROM ({_CELLS.format(x=plain(fx.CUST_S))}) y WHERE value IS NOT NULL), a0 AS (SELECT * FROM ({_CELLS.format(x=plain(fx.CUST_T))}) y WHERE value IS NOT NULL),
bo AS (SELECT DISTINCT id FROM b0 WHERE id IN (SELECT id FROM a0)),
d AS (SELECT property, count(*) FILTER (b.value IS NULL) AS added, count(*) FILTER (a.value IS NULL) AS removed, count(*) FILTER (b.value <> a.value) AS changed,
  count(*) FILTER (b.value = a.value) AS unchanged FROM (SELECT * FROM b0 WHERE id IN (SELECT id FROM bo)) b FULL JOIN (SELECT * FROM a0 WHERE id IN (SELECT id FROM bo)) a USING (id, property) GROUP BY property)"""


def cust_diff(T):
    cols = ["name", "nation", "segment"]
    return m.property_diff(m.unpivot(T.sql(fx.CUST_S), ["id"], cols), m.unpivot(T.sql(fx.CUST_T), ["id"], cols), ["id"])


@query("property_diff", f"WITH {diff_sql()} SELECT * FROM d")
def _property_diff(T):
    return cust_diff(T)


@query("edit_gate", f"""WITH {diff_sql()} SELECT property, CASE WHEN added + removed + changed = 0 THEN 'UNCHANGED' WHEN property = 'name' THEN 'PROTECTED_CHANGED'
  WHEN removed > 0 OR property <> 'segment' THEN 'NOT_ALLOWED' ELSE 'ALLOWED' END AS verdict FROM d""")
def _edit_gate(T):
    return m.edit_gate(cust_diff(T), ["segment"], ["name"]).select("property", "verdict")


@query("owner_exists", """SELECT event_id, lower(concat('User ', user_id)) IN (SELECT lower(concat('USER ', user_id)) FROM events WHERE user_id % 10 <> 0) AS owner_exists FROM events""")
def _owner_exists(T):
    owner = F.concat(F.lit("User "), F.col("user_id").cast("string"))
    cells = T.events.select(F.lit("p").alias("pair_id"), "event_id", owner.alias("owner"))
    owners = T.events.where("user_id % 10 <> 0").select(F.lit("p").alias("pair_id"), F.upper(owner).alias("owner"))
    return m.owner_exists(cells, owners, ["pair_id"]).select("event_id", "owner_exists")


_OUT = "SELECT lower(concat('User ', user_id)) AS owner_key, event_type AS udp, '' AS source_path, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS occ FROM events WHERE user_id % 10 <> 3"


@query("occurrence_join", f"""SELECT m.event_id, o.event_id AS outcome_event, m.occ::INTEGER AS occurrence FROM (SELECT lower(concat('User ', user_id)) AS owner_key, event_type AS udp, event_id,
  row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS occ FROM events) m LEFT JOIN ({_OUT}) o ON o.owner_key = m.owner_key AND o.udp = m.udp AND o.occ = m.occ AND o.occ < 5""")
def _occurrence_join(T):
    from veritwin.operators.ordered import number_within

    base = T.events.select(F.lower(F.concat(F.lit("User "), F.col("user_id").cast("string"))).alias("owner_key"), F.col("event_type").alias("udp"), "event_id", "user_id")
    outcomes = number_within(base.where("user_id % 10 <> 3"), ["owner_key", "udp"], ["event_id"], "n").select(
        "owner_key", "udp", (F.col("n") - 1).alias("occurrence"), F.col("event_id").alias("outcome_event")).where("occurrence < 5")
    return m.occurrence_join(base, outcomes, ["owner_key", "udp"], ["event_id"]).select("event_id", "outcome_event", "occurrence")
