"""DuckDB SQL for the queries that SQL can express.

The media bytes, templates, draws, models, edit distances and trie scores of the other queries have
no SQL form; their tests hold them against plain versions, round trips and held-out rows.
"""

from __future__ import annotations

from .sharding import TABLE_SIZE, fill_table


def _shard_sql() -> str:
    from .queries import SHARDS

    table = ",".join(str(i) for i in fill_table(SHARDS))
    names = ",".join(f"'{s}'" for s in SHARDS)
    return f"""
WITH t AS (SELECT [{table}] AS slots, [{names}] AS names),
p AS (SELECT doc_id, source, n_chars, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT % {TABLE_SIZE})::INTEGER AS slot FROM documents)
SELECT p.doc_id, p.source, p.n_chars, p.slot, t.names[t.slots[p.slot + 1] + 1] AS shard FROM p, t
"""


# One bit of the CRC-32 table, with the reversed polynomial.
_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

ORACLES: dict[str, str] = {
    "op1_warc_captures": """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body)::BIGINT AS n, sha1(body) AS digest FROM p),
l AS (SELECT digest, max(page_id) AS lead FROM d WHERE n >= 1000 GROUP BY 1),
r AS (SELECT d.*, CASE WHEN n >= 1000 AND lead <> page_id THEN lead END AS refers_to FROM d LEFT JOIN l USING (digest))
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, true AS has_request FROM r
""",
    "op5_near_duplicates": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 1 THEN w WHEN len(w) = 0 THEN [] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
c AS (SELECT id, min(root) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.id = d.doc_id
""",
    "op6_shard_placement": _shard_sql(),
    "op11_hard_negatives": """
WITH v AS (SELECT vec_id::BIGINT AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, p.id AS positive_id, (row_number() OVER w)::INTEGER AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
WINDOW w AS (PARTITION BY anchor_id, p.id ORDER BY s.score DESC, s.id) QUALIFY rank <= 10
""",
    "op12_content_sort": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm, length(coalesce(text, '')) AS size FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256 FROM n WINDOW w AS (PARTITION BY norm ORDER BY size DESC, doc_id)
""",
    "op13_spelling_variants": rf"""
WITH RECURSIVE r AS MATERIALIZED (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
u AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM r GROUP BY 1, 2),
t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: {_CRC_STEP})) AS t),
h AS (SELECT run, n, length(run) AS size, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t.t[xor(c & 255, b) + 1])), 4294967295) AS h FROM u, t),
d AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % size) || substr(run, h % size + 2) ELSE run END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM d WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
c AS MATERIALIZED (SELECT word, n, pos, substr(word, 1, pos) || substr(word, pos + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS pos FROM w)),
i AS MATERIALIZED (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM c a JOIN w b ON a.rest = b.word),
p AS (SELECT a.word, b.word AS other, b.n AS m FROM c a JOIN c b ON a.pos = b.pos AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT word, other, m FROM i UNION ALL SELECT other, word, n FROM i),
b AS (SELECT word, count(*) AS n_near, max(m) AS m FROM p GROUP BY 1),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.m >= 10 * w.n THEN (SELECT min(p.other) FROM p WHERE p.word = w.word AND p.m = b.m) END AS form, CASE WHEN b.m >= 10 * w.n THEN b.m END AS form_n FROM w LEFT JOIN b USING (word)),
s(word, last) AS (SELECT word, word FROM f UNION ALL SELECT s.word, f.form FROM s JOIN f ON f.word = s.last WHERE f.form IS NOT NULL),
e AS (SELECT s.word, s.last AS root FROM s JOIN f ON f.word = s.last WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM f JOIN e USING (word)
""",
}
