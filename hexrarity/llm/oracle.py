"""The operators that SQL can express, from their definitions."""

from __future__ import annotations

_REACH = """reach(x, root) AS (
 SELECT id, id FROM nodes
 UNION SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.x)"""


def _half(first: int) -> str:
    """The signs of 32 components as a number."""
    return " + ".join(
        f"CASE WHEN embedding[{first + k + 1}] >= 0 THEN CAST({1 << k} AS BIGINT) ELSE 0 END"
        for k in range(32))


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(concat(" + ", ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + "))"


#: CRC-32 of a decimal number, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
 flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: list_concat([256 + ascii(c)], [0, 0, 0, 0, 0, 0, 0, 0])))),
 lambda crc, x: CASE WHEN x >= 256 THEN xor(crc, x - 256)
  WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END))"""

def _terms(table: str, key: str) -> str:
    return rf"""SELECT {key}, unnest(regexp_extract_all(translate(text,
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM {table}"""


ORACLE = {
    "op11_ranked_search": f"""
WITH counts AS (SELECT doc_id, term, count(*) AS tf FROM ({_terms("documents", "doc_id")}) GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
weights AS (
 SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
 FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), total),
asked AS (SELECT DISTINCT * FROM ({_terms("benchmark", "item_id")})),
scores AS (
 SELECT item_id, doc_id,
  CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words)))) AS BIGINT) AS score
 FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), total
 GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
 doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE rows AS (
 SELECT doc_id, source, {_leaf("text")} AS leaf, CASE WHEN {_CRC} % 5 = 0 THEN
  {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
 FROM documents),
placed AS (
 SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
  count(*) OVER (PARTITION BY source) AS many FROM rows),
own(tree, level, place, many, node) AS (
 SELECT tree, 0, place, many, leaf FROM placed
 UNION ALL SELECT tree, level + 1, place // 16, (many + 15) // 16, sha256(string_agg(node, '' ORDER BY place))
 FROM own WHERE many > 1 GROUP BY tree, level, many, place // 16),
subroots AS (SELECT tree, level AS height, node FROM own WHERE many = 1),
upper(level, place, many, node) AS (
 SELECT 0, tree, (SELECT count(*) FROM subroots), node FROM subroots
 UNION ALL SELECT level + 1, place // 16, (many + 15) // 16, sha256(string_agg(node, '' ORDER BY place))
 FROM upper WHERE many > 1 GROUP BY level, many, place // 16),
runs AS (
 SELECT tree, level, place // 16 AS run, list(node ORDER BY place) AS nodes FROM own WHERE many > 1 GROUP BY ALL
 UNION ALL SELECT -1, level, place // 16, list(node ORDER BY place) FROM upper WHERE many > 1 GROUP BY ALL),
steps AS (
 SELECT p.doc_id, p.tree, p.place, s.step, r.nodes, CAST(spot % 16 AS INTEGER) AS here
 FROM placed p JOIN subroots USING (tree), LATERAL (SELECT unnest(range(0, 14)) AS step) s,
  LATERAL (SELECT CASE WHEN step < height THEN p.place // CAST(16 ^ step AS BIGINT)
   ELSE p.tree // CAST(16 ^ (step - height) AS BIGINT) END AS spot) a
 JOIN runs r ON r.tree = CASE WHEN step < height THEN p.tree ELSE -1 END
  AND r.level = CASE WHEN step < height THEN step ELSE step - height END AND r.run = spot // 16),
proofs AS (
 SELECT tree, place, list(nodes ORDER BY step) AS nodes, list(here ORDER BY step) AS here,
  sha256(string_agg(array_to_string(nodes[:here] || nodes[here + 2:], ''), '' ORDER BY step)) AS proof
 FROM steps GROUP BY tree, place)
SELECT doc_id, leaf, s.node AS subroot, u.node AS root, coalesce(proof, sha256('')) AS proof_sha256,
 coalesce(list_reduce(list_concat([coalesce(tampered, leaf)], list_transform(nodes, lambda run, k:
   array_to_string(run[:here[k]], '') || '*' || array_to_string(run[here[k] + 2:], ''))),
  lambda digest, run: sha256(replace(run, '*', digest))), tampered, leaf) AS folded_root,
 folded_root = root AS verified
FROM placed JOIN subroots s USING (tree) CROSS JOIN (SELECT node FROM upper WHERE many = 1) u LEFT JOIN proofs USING (tree, place)""",
    "op2_topk_search": f"""
WITH codes AS (SELECT vec_id, {_half(0)} AS a, {_half(32)} AS b FROM embeddings)
SELECT q.vec_id AS query_id,
 CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY distance, r.vec_id) AS INTEGER) AS rank,
 r.vec_id AS neighbor_id, distance
FROM codes q JOIN codes r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id,
 LATERAL (SELECT CAST(bit_count(xor(q.a, r.a)) + bit_count(xor(q.b, r.b)) AS INTEGER) AS distance)
QUALIFY rank <= 10""",
    "op8_embedding_near_dedup": f"""
WITH RECURSIVE v AS (
 SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
 WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
 SELECT p.vec_id AS x, q.vec_id AS y FROM v p JOIN v q
 ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
 WHERE list_cosine_similarity(p.e, q.e) >= 0.93),
nodes AS (SELECT vec_id AS id FROM embeddings),
{_REACH}
SELECT x AS vec_id, (SELECT count(*) FROM links WHERE links.x = reach.x) AS n_links,
 min(root) AS component_id, x = min(root) AS kept
FROM reach GROUP BY x""",
    "op10_ngram_jaccard_join": f"""
WITH RECURSIVE words AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
 FROM documents),
sets AS (
 SELECT doc_id, list_distinct(CASE
  WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
 SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
 GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
nodes AS (SELECT doc_id AS id FROM documents),
{_REACH}
SELECT x AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(root) AS component_id
FROM reach JOIN sets ON doc_id = x GROUP BY x, s""",
}
