"""Column expressions, as the censuses and cleaning jobs that use them."""

from pyspark.sql import functions as F

from veritwin.functions import cardinality as card
from veritwin.functions import records, richtext
from veritwin.functions import text as tx
from veritwin.functions import types as ty
from veritwin.functions.similarity import definitions_match, text_similarity
from veritwin.operators import shaping as sh

from . import fixtures as fx
from .base import (
    case_map, key, norm, plain, q, query, similarity, squeeze, t_base, t_canon_of_base, t_describe, t_dim, t_dims_match,
    t_match, t_physical, t_physical_base, trim, truncated, txt, typed,
)

_NAMES, _TYPES, _PART_T, _CARDS = plain(fx.NAMES), plain(fx.TYPES), plain(fx.PART_T), plain(fx.CARDS)
DOC_SPARK, DOC_SQL = fx.doc_sides(True), plain(fx.doc_sides(False))


@query("key_census", f"""
WITH k AS (SELECT pair_id, unnest([{{'basis': 'code', 'key': {key('code')}}}, {{'basis': 'name', 'key': {key('name')}}},
  {{'basis': 'normalized name', 'key': {norm('name')}}}], recursive := true) FROM ({_PART_T}) x),
g AS (SELECT pair_id, basis, key, count(*) AS n FROM k GROUP BY ALL)
SELECT pair_id, basis, sum(n)::BIGINT AS objects, coalesce(sum(n) FILTER (key = ''), 0)::BIGINT AS blank,
  count(*) FILTER (key <> '') AS distinct_keys, count(*) FILTER (key <> '' AND n > 1) AS ambiguous_keys,
  coalesce(sum(n) FILTER (key <> '' AND n > 1), 0)::BIGINT AS ambiguous_objects
FROM g GROUP BY ALL""")
def _key_census(T):
    keys = {"code": tx.compare_key("code"), "name": tx.compare_key("name"), "normalized name": tx.normalize_name("name")}
    return sh.key_census(T.sql(fx.PART_T), ["pair_id"], keys)


@query("type_census", f"""
SELECT pair_id, s_type AS spelling, count(*) AS objects, any_value(s_type_canon) AS canonical, any_value(s_type_family) AS family,
  any_value(s_type_base IN ({q(ty.CANONICAL)}) OR s_type_base IN ({q(ty.NO_TYPE)})) AS known
FROM {typed(_TYPES, 's_type')} GROUP BY pair_id, s_type""")
def _type_census(T):
    return sh.type_census(T.sql(fx.TYPES), "s_type", ["pair_id"])


@query("normalize_name", f"SELECT name, {norm('name')} AS token, count(*) AS objects FROM ({_NAMES}) x GROUP BY name")
def _normalize_name(T):
    return T.sql(fx.NAMES).groupBy("name").agg(F.count("*").alias("objects")).withColumn("token", tx.normalize_name("name"))


@query("compare_key", f"SELECT {key('name')} AS key, count(*) AS objects FROM ({_NAMES}) x GROUP BY ALL")
def _compare_key(T):
    return T.sql(fx.NAMES).groupBy(tx.compare_key("name").alias("key")).agg(F.count("*").alias("objects"))


@query("names_equivalent", f"SELECT id, {norm('name')} = {norm('other')} AS same FROM ({_NAMES}) x")
def _names_equivalent(T):
    return T.sql(fx.NAMES).select("id", tx.names_equivalent("name", "other").alias("same"))


@query("first_nonblank", f"""SELECT id, coalesce(nullif({trim('a')}, ''), nullif({trim('segment')}, ''), nullif({trim('name')}, '')) AS value
FROM (SELECT *, CASE WHEN id % 3 = 0 THEN ' ' ELSE concat(' ', id, ' ') END AS a FROM ({plain(fx.CUST_T)}) y) x""")
def _first_nonblank(T):
    a = F.when(F.col("id") % 3 == 0, " ").otherwise(F.concat(F.lit(" "), F.col("id").cast("string"), F.lit(" ")))
    return T.sql(fx.CUST_T).withColumn("a", a).select("id", tx.first_nonblank("a", "segment", "name").alias("value"))


@query("split_type", f"SELECT id, {t_base('s_type')} AS base, {t_dim('s_type', 1)} AS length, {t_dim('s_type', 2)} AS precision FROM ({_TYPES}) x")
def _split_type(T):
    return T.sql(fx.TYPES).select("id", ty.split_type("s_type").alias("p")).select("id", "p.*")


@query("canonical_type", f"SELECT id, s_type_canon AS canonical FROM {typed(_TYPES, 's_type')}")
def _canonical_type(T):
    return T.sql(fx.TYPES).select("id", ty.canonical_type("s_type").alias("canonical"))


@query("type_family", f"SELECT s_type_family AS family, count(*) AS objects FROM {typed(_TYPES, 's_type')} GROUP BY ALL")
def _type_family(T):
    return T.sql(fx.TYPES).groupBy(ty.type_family("s_type").alias("family")).agg(F.count("*").alias("objects"))


def typed_pairs(T):
    return ty.with_type_parts(ty.with_type_parts(T.sql(fx.TYPES), "s_type", "_s_"), "t_type", "_t_")


def physical_pairs(T):
    return ty.with_physical_type(ty.with_physical_type(T.sql(fx.TYPES), "s_type", "_s_"), "t_type", "_t_")


def _types_match(mode, matrix):
    name = f"types_match_{mode}" + ("_approved" if matrix else "")

    @query(name, f"SELECT id, {t_match('s_type', 't_type', mode, matrix)} AS same FROM {typed(_TYPES, 's_type', 't_type')}")
    def _run(T):
        return typed_pairs(T).select("id", ty.types_match("_s_", "_t_", mode, matrix).alias("same"))


for _mode, _matrix in (("exact", False), ("canonical", False), ("family", False), ("family", True)):
    _types_match(_mode, _matrix)


@query("dimensions_match", f"SELECT id, {t_dims_match('s_type', 't_type')} AS same FROM {typed(_TYPES, 's_type', 't_type')}")
def _dimensions_match(T):
    return typed_pairs(T).select("id", ty.dimensions_match("_s_", "_t_").alias("same"))


@query("describe_type", f"SELECT id, {t_describe('s_type')} AS shown FROM {typed(_TYPES, 's_type')}")
def _describe_type(T):
    return typed_pairs(T).select("id", ty.describe_type("_s_").alias("shown"))


@query("physical_type", f"SELECT id, {t_physical('s_type')} AS s, {t_physical('t_type')} AS t, {t_physical('s_type')} = {t_physical('t_type')} AS same FROM ({_TYPES}) x")
def _physical_type(T):
    rows = physical_pairs(T)
    return rows.select("id", F.col("_s_type").alias("s"), F.col("_t_type").alias("t"), (F.col("_s_type") == F.col("_t_type")).alias("same"))


@query("type_change_class", f"""SELECT id, CASE WHEN {txt('s_type')} = '' OR {txt('t_type')} = '' OR s = t THEN NULL
  WHEN upper({t_physical_base('s')}) = 'ENUM' THEN 'ABSTRACT' WHEN {t_physical_base('s')} = {t_physical_base('t')} THEN 'LENGTH' ELSE 'TYPE' END AS change
FROM (SELECT *, {t_physical('s_type')} AS s, {t_physical('t_type')} AS t FROM ({_TYPES}) y) x""")
def _type_change_class(T):
    return physical_pairs(T).select("id", ty.type_change_class("_s_", "_t_").alias("change"))


@query("normalize_definition", f"SELECT lower({squeeze('text')}) AS definition, count(*) AS copies FROM documents GROUP BY ALL HAVING count(*) > 1")
def _normalize_definition(T):
    return T.documents.groupBy(tx.normalize_definition("text").alias("definition")).agg(F.count("*").alias("copies")).where("copies > 1")


_SIMILAR = f"(SELECT *, lower({squeeze('s_text')}) AS a, lower({squeeze('t_text')}) AS b FROM ({DOC_SQL}) y) x"


@query("text_similarity", f"SELECT id, round({similarity('a', 'b')}, 6) AS similarity FROM {_SIMILAR}")
def _text_similarity(T):
    return T.sql(DOC_SPARK).select("id", F.round(text_similarity("s_text", "t_text"), 6).alias("similarity"))


@query("text_similarity_ratcliff")
def _text_similarity_ratcliff(T):
    return T.sql(DOC_SPARK).select("id", F.round(text_similarity("s_text", "t_text", "ratcliff"), 6).alias("similarity"))


@query("definitions_match", f"SELECT kind, {similarity('a', 'b')} >= 0.9 AS same, count(*) AS objects FROM {_SIMILAR} GROUP BY ALL")
def _definitions_match(T):
    same = definitions_match("s_text", "t_text").alias("same")
    return T.sql(DOC_SPARK).select("kind", same).groupBy("kind", "same").agg(F.count("*").alias("objects"))


@query("truncate", f"SELECT doc_id, {truncated('text', 120)} AS cell, {truncated('text', 500)} AS wide FROM documents")
def _truncate(T):
    return T.documents.select("doc_id", tx.truncate("text", 120).alias("cell"), tx.truncate("text", 500).alias("wide"))


@query("exclude", "SELECT p_partkey, p_name, p_brand FROM part WHERE NOT (regexp_matches(p_name, '(?i)(^RED )|(RING$)') OR regexp_matches(p_brand, '(?i)(^RED )|(RING$)'))")
def _exclude(T):
    return sh.exclude(T.part.select("p_partkey", "p_name", "p_brand"), ["^RED ", "RING$"], ["p_name", "p_brand"])


# --- cardinality ----------------------------------------------------------------------

_COMPACT = "replace(regexp_replace(regexp_replace(tok, '[\\s()\\[\\]]', '', 'g'), '([0-9A-Za-z*])-([0-9A-Za-z*])', '\\1,\\2', 'g'), '..', ',')"


def card_sql(source: str, raw: str, mandatory: str | None = None, many: str | None = None, out: str = "canonical") -> str:
    """Subquery that adds ``out``; every step is a column, in the order of the meaning."""
    words = "regexp_extract_all(tok, '[a-z]+')"
    fallback = "''" if mandatory is None else (
        f"CASE WHEN {mandatory} IS NULL AND {many} IS NULL THEN '' ELSE concat(CASE WHEN coalesce({mandatory}, FALSE) THEN '1' ELSE '0' END, ',', "
        f"CASE WHEN coalesce({many}, FALSE) THEN 'n' ELSE '1' END) END")
    return f"""(SELECT * EXCLUDE (tok, compact, words), CASE
  WHEN {case_map('tok', card.SPELLINGS)} IS NOT NULL THEN {case_map('tok', card.SPELLINGS)}
  WHEN regexp_matches(tok, '^exactly\\s*\\d+$') THEN CASE WHEN regexp_extract(tok, '(\\d+)$', 1) = '1' THEN '1,1' ELSE '1,n' END
  WHEN {case_map('compact', card.SPELLINGS)} IS NOT NULL THEN {case_map('compact', card.SPELLINGS)}
  WHEN list_has_any(words, [{q(card.BOUND_WORDS)}]) THEN concat(CASE WHEN list_has_any(words, [{q(card.ZERO_WORDS)}]) THEN '0' ELSE '1' END, ',',
    CASE WHEN list_has_any(words, [{q(card.MANY_WORDS)}]) OR contains(tok, '*') THEN 'n' ELSE '1' END)
  WHEN len(string_split(compact, ',')) = 2 AND regexp_matches(compact, '[\\d*]') THEN concat(
    CASE WHEN split_part(compact, ',', 1) IN ('1', 'one') THEN '1' ELSE '0' END, ',',
    CASE WHEN split_part(compact, ',', 2) IN ('n', 'm', '*', 'many', 'more') THEN 'n' ELSE '1' END)
  ELSE {fallback} END AS {out}
FROM (SELECT *, {_COMPACT} AS compact, {words} AS words FROM (SELECT *, lower({trim(raw)}) AS tok FROM {source}) c0) c1)"""


@query("normalize_cardinality", f"""SELECT raw, mandatory, many, canonical, count(*) AS ends
FROM {card_sql(f'({_CARDS}) s', 'raw', 'mandatory', 'many')} x GROUP BY ALL""")
def _normalize_cardinality(T):
    folded = T.sql(fx.CARDS).groupBy("raw", "mandatory", "many").agg(F.count("*").alias("ends"))
    return folded.withColumn("canonical", card.normalize_cardinality("raw", F.col("mandatory"), F.col("many")))


@query("resolve_enum", f"""SELECT code, coalesce({case_map('code', card.RELATIONSHIP_TYPES)}, code) AS meaning,
  {case_map('code', card.RELATIONSHIP_TYPES)} IS NOT NULL OR code = '' AS recognised, count(*) AS objects
FROM (SELECT CASE WHEN l_partkey % 11 = 10 THEN '' ELSE (l_partkey % 11)::VARCHAR END AS code FROM lineitem) x GROUP BY ALL""")
def _resolve_enum(T):
    code = F.when(F.col("l_partkey") % 11 == 10, "").otherwise((F.col("l_partkey") % 11).cast("string"))
    counted = T.lineitem.groupBy(code.alias("code")).agg(F.count("*").alias("objects"))
    e = card.resolve_enum("code", card.RELATIONSHIP_TYPES)
    return counted.select("code", e["value"].alias("meaning"), e["recognised"].alias("recognised"), "objects")


@query("cardinality_flags", f"""SELECT raw, other, left(c, 1) = '1' AS mandatory, right(c, 1) = 'n' AS many,
  CASE WHEN right(c, 1) = 'n' AND right(d, 1) = 'n' THEN 'M:N' WHEN right(c, 1) = 'n' THEN '1:N' WHEN right(d, 1) = 'n' THEN 'N:1' ELSE '1:1' END AS degree,
  CASE WHEN right(c, 1) = 'n' AND right(d, 1) = 'n' THEN 'M:N' WHEN right(c, 1) = 'n' THEN 'N:1' WHEN right(d, 1) = 'n' THEN '1:N' ELSE '1:1' END AS inverted,
  coalesce({case_map('c', card.DESCRIPTIONS)}, '(not stated)') AS shown, count(*) AS rows
FROM {card_sql(card_sql(f"(SELECT raw, CASE WHEN l_suppkey % 2 = 0 THEN '0,n' ELSE 'exactly one' END AS other FROM ({_CARDS}) s)", 'raw', out='c'), 'other', out='d')} x GROUP BY ALL""")
def _cardinality_flags(T):
    other = F.when(F.col("l_suppkey") % 2 == 0, "0,n").otherwise("exactly one")
    counted = T.sql(fx.CARDS).groupBy("raw", other.alias("other")).agg(F.count("*").alias("rows"))
    folded = counted.withColumn("c", card.normalize_cardinality("raw")).withColumn("d", card.normalize_cardinality("other"))
    return folded.select(
        "raw", "other", "rows", card.is_mandatory("c").alias("mandatory"), card.is_many("c").alias("many"),
        card.degree("c", "d").alias("degree"), card.invert_degree(card.degree("c", "d")).alias("inverted"),
        card.describe_cardinality("c").alias("shown"))


# --- labels, signatures, names --------------------------------------------------------


@query("object_label", f"""SELECT id, CASE WHEN {txt('other')} = '' THEN code WHEN {norm('other')} = {norm('code')} THEN code
  WHEN regexp_matches(other, concat('\\(\\s*', regexp_escape(code), '\\s*\\)\\s*$'), 'i') THEN code ELSE concat(other, ' (', code, ')') END AS label
FROM ({_NAMES}) x""")
def _object_label(T):
    return T.sql(fx.NAMES).select("id", tx.object_label("other", "code").alias("label"))


@query("documented_members", """SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[\\n,;+/]+'), lambda t: trim(t, E' \\t\\n\\r')),
  lambda t: regexp_full_match(t, '[A-Za-z0-9_\\-]+')) AS members FROM documents""")
def _documented_members(T):
    return T.documents.select("doc_id", tx.documented_members("text").alias("members"))


@query("index_signature", """SELECT l_orderkey, CASE WHEN l_orderkey % 2 = 0 THEN 'U' ELSE 'I' END || ':' ||
  string_agg('C' || l_partkey, ',' ORDER BY 'C' || l_partkey) AS signature FROM lineitem GROUP BY l_orderkey""")
def _index_signature(T):
    members = F.collect_list(F.concat(F.lit("c"), F.col("l_partkey").cast("string")))
    keys = T.lineitem.groupBy("l_orderkey").agg(members.alias("members"))
    return keys.select("l_orderkey", tx.index_signature(F.col("l_orderkey") % 2 == 0, F.col("members")).alias("signature"))


@query("fk_signature", """SELECT l_orderkey, concat('ORDER', l_orderkey % 7, '>', 'LINE', l_orderkey % 5, ':',
  string_agg(concat('P', l_partkey, '=', 'S', l_suppkey), ',' ORDER BY concat('P', l_partkey, '=', 'S', l_suppkey))) AS signature
FROM lineitem GROUP BY l_orderkey""")
def _fk_signature(T):
    join = F.struct(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("parent_col"),
        F.concat(F.lit(" s"), F.col("l_suppkey").cast("string")).alias("child_col"))
    refs = T.lineitem.groupBy("l_orderkey").agg(F.collect_list(join).alias("joins"))
    parent = F.concat(F.lit("Order"), (F.col("l_orderkey") % 7).cast("string"))
    child = F.concat(F.lit("Line"), (F.col("l_orderkey") % 5).cast("string"))
    return refs.select("l_orderkey", tx.fk_signature(parent, child, F.col("joins")).alias("signature"))


@query("udp_name", """SELECT path, regexp_replace(list_last(string_split(path, '.')), '[^A-Za-z0-9_]', '_', 'g') AS leaf,
  regexp_replace(path, '[^A-Za-z0-9_]', '_', 'g') AS full_name, count(*) AS cells
FROM (SELECT concat('core-', event_type, '.k ', user_id % 3, '.v') AS path FROM events) x GROUP BY ALL""")
def _udp_name(T):
    path = F.concat(F.lit("core-"), F.col("event_type"), F.lit(".k "), (F.col("user_id") % 3).cast("string"), F.lit(".v"))
    counted = T.events.groupBy(path.alias("path")).agg(F.count("*").alias("cells"))
    return counted.select("path", tx.udp_name("path").alias("leaf"), tx.udp_full_name("path").alias("full_name"), "cells")


# --- text cleaning jobs ---------------------------------------------------------------


@query("strip_control_chars", """SELECT doc_id, regexp_replace(concat(chr(7), text, chr(31), chr(11)), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g') AS clean FROM documents""")
def _strip_control_chars(T):
    dirty = F.concat(F.lit("\x07"), F.col("text"), F.lit("\x1f\x0b"))
    return T.documents.select("doc_id", tx.strip_control_chars(dirty).alias("clean"))


@query("carry_forward_lines", """SELECT doc_id, pos, line, last_value(CASE WHEN line LIKE '%.' THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS carried
FROM (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) y) x""")
def _carry_forward_lines(T):
    rows = records.carry_forward(T.documents, ["doc_id"], "text", r"\.$")
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "line", "carried")


def _kv_blob():
    return F.concat_ws(
        "\n", F.concat(F.lit("{0A1B-22},"), F.col("event_type"), F.lit(",12={0A-1},kind,3="), F.col("props")),
        F.lit("noise line"), F.concat(F.lit("{FF-2},amount,9="), F.col("value").cast("decimal(12,2)").cast("string")),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("{AA-9},other,4={AB-1},flag,1="), (F.col("event_id") % 4 == 0).cast("string"))),
        F.concat(F.lit("{FF-3},user,9="), F.col("user_id").cast("string")))


@query("explode_kv_text", """SELECT event_id, pos::BIGINT AS pos, path, value FROM (
  SELECT event_id, 0 AS pos, concat(event_type, '.kind') AS path, props AS value FROM events
  UNION ALL SELECT event_id, 2, concat(event_type, '.amount'), value::DECIMAL(12,2)::VARCHAR FROM events
  UNION ALL SELECT event_id, 3, 'other.flag', (event_id % 4 = 0)::VARCHAR FROM events WHERE event_id % 2 = 0
  UNION ALL SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 4 ELSE 3 END, CASE WHEN event_id % 2 = 0 THEN 'other.user' ELSE concat(event_type, '.user') END, user_id::VARCHAR FROM events) x""")
def _explode_kv_text(T):
    rows = records.explode_kv_text(T.events.select("event_id", _kv_blob().alias("blob")), ["event_id"], "blob")
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


@query("parse_options_blob", """SELECT event_id, key, value FROM (
  SELECT event_id, 'CaseSensitive' AS key, CASE WHEN event_id % 2 = 0 THEN 'Yes' ELSE 'No' END AS value FROM events
  UNION ALL SELECT event_id, event_type, concat('a=', props) FROM events
  UNION ALL SELECT event_id, 'Twice', user_id::VARCHAR FROM events) x""")
def _parse_options_blob(T):
    flag = F.when(F.col("event_id") % 2 == 0, "Yes").otherwise("No")
    blob = F.concat_ws(
        "\n", F.lit("[Model=Options]"), F.concat(F.lit("CaseSensitive = "), flag), F.lit("Twice=first"), F.lit("no pair here"),
        F.concat(F.col("event_type"), F.lit("=a="), F.col("props")), F.concat(F.lit(" Twice ="), F.col("user_id").cast("string")))
    parsed = T.events.select("event_id", records.parse_options_blob(blob).alias("m"))
    return parsed.select("event_id", F.explode("m").alias("key", "value"))


@query("packed_records", """SELECT conv_id, turn, replace(concat(text, chr(9), '\\#x41', chr(1)), chr(13), chr(10)) AS decoded, 12::BIGINT AS fields,
  TRUE AS newline_escaped FROM conversations""")
def _packed_records(T):
    source = F.concat(F.col("text"), F.lit("\t\\#x41\x01"))
    record = records.encode_packed_record(
        source, F.col("turn"), F.col("role"), F.lit("2024-01-01 00:00:00"), F.col("conv_id").cast("string"), F.lit("0"))
    packed = T.conversations.select("conv_id", "turn", record.alias("r"))
    return packed.select(
        "conv_id", "turn", records.decode_packed_record("r").alias("decoded"),
        F.size(F.split("r", r"\\#x1F")).cast("bigint").alias("fields"), (~F.contains("r", F.lit("\n"))).alias("newline_escaped"))


@query("join_notes", """SELECT conv_id, string_agg(trim(text, E' \\t\\n\\r'), chr(10) ORDER BY turn) FILTER (turn % 3 <> 1) AS notes FROM conversations GROUP BY conv_id""")
def _join_notes(T):
    blank = F.when(F.col("turn") % 3 == 1, " \n").otherwise(F.col("text"))
    record = records.encode_packed_record(blank, F.col("turn"), F.col("role"), F.lit(""), F.lit(""), F.lit(""))
    notes = F.transform(F.array_sort(F.collect_list(F.struct("turn", record.alias("r")))), lambda x: x["r"])
    return T.conversations.groupBy("conv_id").agg(records.join_notes(notes).alias("notes"))


@query("rich_text_to_plain", """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN trim(text, E' \\t\\n\\r')
  ELSE trim(regexp_replace(regexp_replace(text, '[ \\t]+', ' ', 'g'), '\\n\\s*\\n+', chr(10), 'g'), E' \\t\\n\\r') END AS clean FROM documents""")
def _rich_text_to_plain(T):
    """Two of three texts travel in an envelope with their braces escaped, the others as they are."""
    body = F.col("text")
    for char in ("\\", "{", "}"):
        body = F.replace(body, F.lit(char), F.lit("\\" + char))
    body = F.replace(body, F.lit("\n"), F.lit("\\par{}"))
    rich = F.concat(F.lit("{\\rtf1\\ansi{\\fonttbl{\\f0 Arial;}}{\\*\\generator x;}\\pard "), body, F.lit("}"))
    wrapped = T.documents.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(rich).alias("clean"))
    return richtext.rich_text_to_plain(wrapped, "clean")
