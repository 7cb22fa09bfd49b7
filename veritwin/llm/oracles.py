"""DuckDB twins of the queries that SQL can express."""

#: A-Z in lower case, nothing else; null is empty.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_CLOSURE = """reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
low AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a)"""

OP3 = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
k AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS shingle FROM k),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
{_CLOSURE}
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = doc_id"""

OP5 = f"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.93),
{_CLOSURE},
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.a = vec_id"""

_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_WINDOW = "array_to_string(ws[i : i + size - 1], ' ')"

OP7 = f"""WITH d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents), b AS (SELECT item_id, {_WORDS.format(_LOWER)} AS ws FROM benchmark),
bi AS (SELECT item_id, ws, least(13, len(ws)) AS size, unnest(range(1, greatest(len(ws) - 11, 2))) AS i FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, size, {_WINDOW} AS win FROM bi),
di AS (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM bw) z WHERE len(ws) >= size),
dw AS (SELECT doc_id, i, size, {_WINDOW} AS win FROM di),
hit AS (SELECT doc_id, i, size, item_id FROM dw JOIN bw USING (size, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) x GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) x GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

_DRAW = "('0x' || substr(sha256('7:' || doc_id), {}, 8))::UBIGINT"

OP11 = f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
  {_DRAW.format(1)} AS h1, {_DRAW.format(9)} AS h2, {_DRAW.format(25)} AS h4 FROM documents),
c AS (SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1))::INT AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1))::INT AS b FROM t),
p AS (SELECT *, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 :], '') AS s,
  CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, len(u) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(x) AS restored_sha256 FROM p"""

_NEAREST = """a{n} AS MATERIALIZED (SELECT rid, any_value(x.e) AS e, min(struct_pack(d := d, c := c)) AS best FROM (
  SELECT rid, v.e, c, list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - k.e[i]) * (v.e[i] - k.e[i])))::BIGINT AS d FROM v, k{n} k) x GROUP BY rid)"""
_MOVED = """s{n} AS (SELECT best.c AS c, i, sum(e[i])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{n}, range(1, 65) t(i) GROUP BY ALL),
k{m} AS MATERIALIZED (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS e FROM s{n} GROUP BY c
  UNION ALL SELECT c, e FROM k{n} WHERE c NOT IN (SELECT c FROM s{n}))"""

OP13 = f"""WITH u AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (SELECT rid, vec_id, list_transform(e, lambda x: floor(1024 * x)::BIGINT) AS e FROM u),
k0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1)::INT AS c, e FROM v ORDER BY c LIMIT 8),
{", ".join(_NEAREST.format(n=n) + ", " + _MOVED.format(n=n, m=n + 1) for n in range(10))},
{_NEAREST.format(n=10)}
SELECT vec_id, a.best.c AS cluster, a.best.d AS distance, sum(a.best.d) OVER (PARTITION BY a.best.c)::BIGINT AS cluster_inertia, sum(a.best.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(k.e, ',')) AS centroid_sha256
FROM a10 a JOIN v USING (rid) JOIN k10 k ON k.c = a.best.c"""

ORACLES = {
    "op3_near_duplicates": OP3, "op5_near_vectors": OP5, "op7_decontaminate": OP7, "op11_fill_in_middle": OP11, "op13_table_means": OP13,
}
