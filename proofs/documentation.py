"""Text field mapping, coverage, notes."""

from pyspark.sql import functions as F

from veritwin.operators import matching as m
from veritwin.plans import documentation as doc

from . import fixtures as fx
from .base import ladder, named_keys, plain, query, similarity, squeeze, trim, truncated
from .expressions import DOC_SPARK, DOC_SQL
from .matching import part_sides

# Documented objects: PART entities with three text fields on each side.
_S_TEXT = """SELECT x.*, concat('comment of ', name) AS comment, CASE WHEN id % 3 = 0 THEN '' ELSE definition END AS description,
  CASE WHEN id % 4 = 0 THEN concat('annotated ', code) ELSE '' END AS annotation FROM ({s}) x"""
_T_TEXT = """SELECT x.*, CASE WHEN id % 8 = 0 THEN '' WHEN id % 9 = 0 THEN concat('other words for ', name) ELSE concat('COMMENT  of ', name) END AS note,
  CASE WHEN id % 5 = 0 THEN concat('extended ', code) ELSE '' END AS extended_notes, concat('raw ', name) AS comment FROM ({t}) x"""
TEXT_S, TEXT_T = _S_TEXT.format(s=fx.PART_S), _T_TEXT.format(t=fx.PART_T)
_LADDER = ladder(plain(TEXT_S), plain(TEXT_T), ["pair_id"], named_keys())
MAPPED_SQL = f"""{_LADDER}, mp AS (SELECT lp.pair_id, lp.s_id AS id, r.mapping, r.s_text, r.t_text FROM lp JOIN s0 s ON s.id = lp.s_id JOIN t0 t ON t.id = lp.t_id,
  LATERAL (VALUES ('Comment → Note', s.comment, t.note), ('Description → Definition', s.description, t.definition), ('Annotation → Extended Notes', s.annotation, t.extended_notes)) r(mapping, s_text, t_text)
  UNION ALL SELECT lt.pair_id, lt.id, r.mapping, '', r.t_text FROM lt, LATERAL (VALUES ('Comment → Note', lt.note), ('Description → Definition', lt.definition), ('Annotation → Extended Notes', lt.extended_notes)) r(mapping, t_text) WHERE {trim('r.t_text')} <> '')"""


def matched_texts(T):
    s, t = T.sql(TEXT_S), T.sql(TEXT_T)
    found = m.match_ladder(s, t, ["pair_id"], m.name_code_keys())
    return m.attach(found, s, t, ["pair_id"]), found.t_only.withColumnRenamed("t_id", "id").join(t, ["pair_id", "id"])


def mapped(T):
    pairs, t_only = matched_texts(T)
    rows = doc.map_fields(pairs.withColumn("id", F.col("s_id")), ["pair_id", "id"])
    return rows.unionByName(doc.map_target_only(t_only, ["pair_id", "id"]))


@query("map_fields", f"WITH {MAPPED_SQL} SELECT * FROM mp")
def _map_fields(T):
    return mapped(T)


def _class_sql(rule: str, src: str) -> str:
    """SELECT * plus status and percent over a source with s_text and t_text."""
    fold = (lambda x: squeeze(x)) if rule == "exact" else (lambda x: f"lower({squeeze(x)})")
    base = f"(SELECT *, {fold('s_text')} AS a, {fold('t_text')} AS b FROM {src} z0) z1"
    if rule == "exact":
        return f"(SELECT *, CASE WHEN a = '' AND b = '' THEN 'BOTH_EMPTY' WHEN b = '' THEN 'MISSING_IN_T' WHEN a = '' THEN 'EXTRA_IN_T' WHEN a = b THEN 'MATCHED' ELSE 'TEXT_DIFFERS' END AS status FROM {base})"
    same = "r >= 0.9" if rule == "threshold" else "a = b"
    return f"""(SELECT *, CASE WHEN status = 'MATCHED' THEN 100.0 WHEN status = 'MISMATCH' THEN round(r * 100, 2) ELSE 0.0 END::DOUBLE AS similarity FROM (SELECT *,
  CASE WHEN a = '' AND b = '' THEN 'BOTH_EMPTY' WHEN b = '' THEN 'MISSING_IN_T' WHEN a = '' THEN 'MISSING_IN_S' WHEN {same} THEN 'MATCHED' ELSE 'MISMATCH' END AS status FROM (SELECT *, {similarity('a', 'b')} AS r FROM {base}) z2) z3)"""


for _rule in ("threshold", "equal", "exact"):

    def _make(rule):
        cols = "id, status" + ("" if rule == "exact" else ", similarity")

        @query(f"classify_text_{rule}", f"SELECT {cols} FROM {_class_sql(rule, f'({DOC_SQL})')} x")
        def _run(T):
            out = doc.classify_text(T.sql(DOC_SPARK), rule)
            return out.select("id", "status") if rule == "exact" else out.select("id", "status", "similarity")

    _make(_rule)


@query("classify_text_ratcliff")
def _classify_text_ratcliff(T):
    return doc.classify_text(T.sql(DOC_SPARK), "threshold", method="ratcliff").select("id", "status", "similarity")


@query("summarise_fields", f"""WITH {MAPPED_SQL} SELECT pair_id, mapping, {', '.join(f"count(*) FILTER (status = '{s}') AS {s.lower()}" for s in doc.STATUSES)} FROM {_class_sql('threshold', 'mp')} x GROUP BY ALL""")
def _summarise_fields(T):
    return doc.summarise_fields(doc.classify_text(mapped(T)), ["pair_id", "mapping"])


@query("documentation_rows", f"WITH {MAPPED_SQL} SELECT pair_id, id, mapping, status, similarity, {truncated('s_text', 500)} AS s_value, {truncated('t_text', 500)} AS t_value FROM {_class_sql('threshold', 'mp')} x")
def _documentation_rows(T):
    return doc.shown_values(doc.classify_text(mapped(T))).select("pair_id", "id", "mapping", "status", "similarity", "s_value", "t_value")


# Physical objects: documents as tables and columns with texts.
PHYS_SQL = """SELECT concat('m', doc_id % 4) AS pair_id, doc_id AS id, CASE WHEN doc_id % 10 = 0 THEN 'TABLE' ELSE 'COLUMN' END AS kind,
  CASE WHEN doc_id % 3 = 0 THEN lang ELSE '' END AS s_comment, CASE WHEN doc_id % 4 = 1 AND doc_id % 5 = 0 THEN source ELSE '' END AS s_description, '' AS s_annotation,
  CASE WHEN doc_id % 6 = 0 THEN upper(lang) WHEN doc_id % 7 = 0 THEN source ELSE ' ' END AS t_comment, CASE WHEN doc_id % 8 = 0 THEN source ELSE '' END AS t_definition, '' AS t_extended_notes FROM {documents}"""


@query("map_fields_physical", f"""WITH o AS ({plain(PHYS_SQL)}), u AS (SELECT pair_id, max(CASE WHEN s_description <> '' THEN 1 ELSE 0 END) AS d FROM o GROUP BY ALL)
SELECT o.pair_id, id, kind, mapping, s_text, t_text FROM o JOIN u USING (pair_id), LATERAL (VALUES ('Comment → Comment', s_comment, t_comment, 1), ('Description → Definition', s_description, t_definition, d)) r(mapping, s_text, t_text, used)
WHERE used = 1 AND (kind = 'TABLE' OR trim(s_comment) <> '' OR trim(s_description) <> '' OR trim(t_comment) <> '' OR trim(t_definition) <> '')""")
def _map_fields_physical(T):
    return doc.map_fields_physical(T.sql(PHYS_SQL), ["pair_id", "id", "kind"])


@query("field_coverage", """WITH c AS (SELECT source, count(*) AS objects, count(*) FILTER (trim(a) <> '') AS a, count(*) FILTER (trim(b) <> '') AS b FROM (SELECT source, CASE WHEN quality = 1 THEN text ELSE ' ' END AS a, CASE WHEN toxic = 1 THEN lang ELSE NULL END AS b FROM documents LEFT JOIN labels USING (doc_id)) x GROUP BY source)
SELECT source, objects, 'quality_text' AS field, a AS populated, round(100.0 * a / objects, 2) AS percent FROM c UNION ALL SELECT source, objects, 'toxic_lang', b, round(100.0 * b / objects, 2) FROM c""")
def _field_coverage(T):
    rows = T.documents.join(T.labels, "doc_id", "left").select(
        "source", F.when(F.col("quality") == 1, F.col("text")).otherwise(" ").alias("quality_text"), F.when(F.col("toxic") == 1, F.col("lang")).alias("toxic_lang"))
    return doc.field_coverage(rows, ["quality_text", "toxic_lang"], ["source"])


INV_SQL = """SELECT source AS pair_id, CASE doc_id % 4 WHEN 0 THEN 'ENTITY' WHEN 1 THEN 'ATTRIBUTE' WHEN 2 THEN 'TABLE' ELSE 'COLUMN' END AS kind, CASE WHEN doc_id % 2 = 0 THEN 'S' ELSE 'T' END AS side,
  CASE WHEN doc_id % 5 <> 0 THEN lang ELSE '' END AS comment, CASE WHEN doc_id % 3 = 0 THEN lang ELSE ' ' END AS definition, CASE WHEN doc_id % 7 = 0 THEN lang ELSE '' END AS note FROM {documents}
UNION ALL SELECT source, CASE doc_id % 4 WHEN 0 THEN 'ENTITY' WHEN 1 THEN 'ATTRIBUTE' WHEN 2 THEN 'TABLE' ELSE 'COLUMN' END, CASE WHEN doc_id % 2 = 0 THEN 'T' ELSE 'S' END, lang, '', CASE WHEN doc_id % 11 = 0 THEN '' ELSE lang END FROM {documents}"""


@query("content_inventory", f"""WITH b AS (SELECT pair_id, kind, count(*) FILTER (side = 'S') AS objects, count(*) FILTER (side = 'S' AND comment <> '') AS with_comment, count(*) FILTER (side = 'S' AND trim(definition) <> '') AS with_definition,
  count(*) FILTER (side = 'T' AND note <> '') AS t_notes, count(*) FILTER (side = 'T' AND trim(definition) <> '') AS t_definitions FROM ({plain(INV_SQL)}) x GROUP BY ALL),
g AS (SELECT *, greatest(with_comment - CASE WHEN kind IN ('TABLE', 'COLUMN') THEN greatest(t_notes, t_definitions) ELSE t_notes END, 0) AS gap FROM b)
SELECT * FROM g UNION ALL SELECT pair_id, 'TOTAL', sum(objects)::BIGINT, sum(with_comment)::BIGINT, sum(with_definition)::BIGINT, sum(t_notes)::BIGINT, sum(t_definitions)::BIGINT, sum(gap)::BIGINT FROM g GROUP BY pair_id""")
def _content_inventory(T):
    return doc.content_inventory(T.sql(INV_SQL))


NOTE_S = f"SELECT *, CASE WHEN id % 6 = 0 THEN ' ' ELSE concat('comment ', id) END AS comment, CASE WHEN id % 10 = 0 THEN 'DOMAIN' ELSE 'ENTITY' END AS kind FROM ({fx.PART_S}) x"
NOTE_T = f"SELECT *, CASE WHEN id % 10 = 0 THEN 'DOMAIN' ELSE 'ENTITY' END AS kind FROM ({fx.PART_T}) x"


def _notes_sql(mode: str) -> str:
    s, t = plain(NOTE_S), plain(NOTE_T)
    done = {"skip": "'NOTE_PRESENT'", "append": "'APPENDED'", "replace": "'REPLACED'"}[mode]
    size = {"skip": "n", "append": "n + 1", "replace": "1"}[mode]
    return f"""WITH s AS ({s}), t AS (SELECT *, id % 3 AS n FROM ({t}) y),
a1 AS (SELECT pair_id, kind, name, code, max(id) AS id FROM s GROUP BY ALL), a2 AS (SELECT pair_id, kind, code, min(id) AS id FROM s GROUP BY ALL HAVING count(*) = 1),
a3 AS (SELECT pair_id, kind, lower(trim(name)) AS nm, min(id) AS id FROM s GROUP BY ALL HAVING count(*) = 1),
h AS (SELECT t.pair_id, t.id, t.kind, t.n, CASE WHEN a1.id IS NOT NULL THEN 1 WHEN a2.id IS NOT NULL THEN 2 WHEN a3.id IS NOT NULL THEN 3 END AS tier, coalesce(a1.id, a2.id, a3.id) AS pid FROM t
  LEFT JOIN a1 USING (pair_id, kind, name, code) LEFT JOIN a2 USING (pair_id, kind, code) LEFT JOIN a3 ON a3.pair_id = t.pair_id AND a3.kind = t.kind AND a3.nm = lower(trim(t.name))),
r AS (SELECT h.*, CASE WHEN tier IS NULL THEN 'NO_PARTNER' WHEN h.kind <> 'ENTITY' THEN 'KIND_EXCLUDED' WHEN trim(s.comment) = '' THEN 'COMMENT_EMPTY' WHEN n > 0 THEN {done} ELSE 'INSERTED' END AS reason FROM h LEFT JOIN s ON s.id = h.pid)
SELECT pair_id, id, tier, reason, CASE WHEN reason = 'NO_PARTNER' THEN 'UNMATCHED' WHEN reason IN ('APPENDED', 'REPLACED', 'INSERTED') THEN 'UPDATED' ELSE 'SKIPPED' END AS status,
  (CASE reason WHEN 'INSERTED' THEN 1 WHEN {done} THEN {size} ELSE n END)::BIGINT AS notes FROM r"""


for _mode in ("skip", "append", "replace"):

    def _make_notes(mode):
        @query(f"enrich_notes_{mode}", _notes_sql(mode))
        def _run(T):
            held = F.array_repeat(F.lit("old note"), (F.col("id") % 3).cast("int"))
            out = doc.enrich_notes(T.sql(NOTE_T).withColumn("notes", held), T.sql(NOTE_S), ["pair_id"], mode)
            return out.select("pair_id", "id", "tier", "reason", "status", F.size("notes").cast("bigint").alias("notes"))

    _make_notes(_mode)


@query("unmatched_objects", f"""WITH {ladder(plain(fx.PART_S), plain(fx.PART_T), ['pair_id'], named_keys())}
SELECT 'S' AS side, pair_id, id, name, 'NOT_IN_TARGET' AS reason FROM ls UNION ALL
SELECT 'T', pair_id, id, name, CASE WHEN starts_with(upper(name), 'EXTRA') THEN 'FK_PROPAGATED' ELSE 'UNEXPLAINED' END FROM lt""")
def _unmatched_objects(T):
    s, t = part_sides(T)
    found = m.match_ladder(s, t, ["pair_id"], m.name_code_keys())
    s_only = found.s_only.withColumnRenamed("s_id", "id").join(s, ["pair_id", "id"])
    t_only = found.t_only.withColumnRenamed("t_id", "id").join(t, ["pair_id", "id"])
    partners = t.select("pair_id").distinct().select("pair_id", F.lit("E").alias("owner"), F.lit("Extra").alias("partner"))
    why = m.explain_extra_by_prefix(t_only.withColumn("owner", F.lit("E")), partners, ["pair_id"])
    return doc.unmatched_objects(s_only, t_only, why, ["pair_id"]).select("side", "pair_id", "id", "name", "reason")
