"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from .chat import op11_chat
from .language import op1_language
from .lexical import op12_ranked_search
from .line_dedup import op7_line_dedup
from .merkle import op13_merkle
from .near_dedup import op6_near_dedup
from .packing import op5_packing
from .sharding import op10_sharding
from .tiling import op4_decontamination
from .token_counts import op3_token_counts
from .topk import op8_topk
from .toxicity import op2_toxicity
from .warc import op9_warc

QUERIES = {
    "op1_language": op1_language,
    "op2_toxicity": op2_toxicity,
    "op3_token_counts": op3_token_counts,
    "op4_decontamination": op4_decontamination,
    "op5_packing": op5_packing,
    "op6_near_dedup": op6_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_topk": op8_topk,
    "op9_warc": op9_warc,
    "op10_sharding": op10_sharding,
    "op11_chat": op11_chat,
    "op12_ranked_search": op12_ranked_search,
    "op13_merkle": op13_merkle,
}


def _field(col: str) -> str:
    text = f"CAST({col} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _siblings(tree: str) -> str:
    run = f"OVER (PARTITION BY {tree}, i // 3 ORDER BY i ROWS BETWEEN"
    return (f"coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r")


SQL = {
    "op6_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
                              WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                              ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN edge e ON e.x = r.other),
root AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN root USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op9_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM s)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f""",
    "op8_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op13_merkle": f"""
WITH RECURSIVE b AS (
  SELECT *, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END)) AS inverse
  FROM documents),
f AS (SELECT doc_id, source, {_leaf('text')} AS leaf, CASE WHEN inverse % 2 = 1 THEN {_leaf("replace(text, chr(10), '')")} END AS tampered FROM b),
p AS (SELECT doc_id, leaf, tampered, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, count(*) OVER (PARTITION BY source) AS n,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM f),
node AS (SELECT s, 0 AS lev, i, n, leaf AS h FROM p
         UNION ALL SELECT s, lev + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY s, lev, n, i // 3),
sub AS (SELECT s, h FROM node WHERE n = 1),
top AS (SELECT 0 AS lev, s AS i, (SELECT count(*) FROM sub) AS n, h FROM sub
        UNION ALL SELECT lev + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lev, n, i // 3),
step AS (SELECT s, lev, i, {_siblings('s, lev')} FROM node WHERE n > 1 UNION ALL SELECT -1, lev, i, {_siblings('lev')} FROM top WHERE n > 1),
inner_walk AS (SELECT s, i AS leaf_no, 0 AS lev, i, '' AS proof, coalesce(tampered, leaf) AS cur FROM p
         UNION ALL SELECT w.s, leaf_no, w.lev + 1, w.i // 3, proof || l || r, sha256(l || cur || r) FROM inner_walk w JOIN step t ON t.s = w.s AND t.lev = w.lev AND t.i = w.i),
at_sub AS (SELECT s, leaf_no, arg_max(proof, lev) AS proof, arg_max(cur, lev) AS cur FROM inner_walk GROUP BY s, leaf_no),
walk AS (SELECT s, leaf_no, 0 AS lev, s AS i, proof, cur FROM at_sub
         UNION ALL SELECT w.s, leaf_no, w.lev + 1, w.i // 3, proof || l || r, sha256(l || cur || r) FROM walk w JOIN step t ON t.s = -1 AND t.lev = w.lev AND t.i = w.i),
ends AS (SELECT s, leaf_no, arg_max(proof, lev) AS proof, arg_max(cur, lev) AS cur FROM walk GROUP BY s, leaf_no),
root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, sub.h AS subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM p JOIN sub USING (s) JOIN ends e ON e.s = p.s AND e.leaf_no = p.i, root""",
}

#: Twins that read conversations or benchmark as well.
SQL_OF_OTHER_TABLES = {
    "op11_chat": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
f AS (SELECT *, replace(replace(role, '\', '\\'), chr(10), '\n') AS line FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>' || line || chr(10) || text || '<|im_end|>' || chr(10))
                + len(regexp_extract_all(line, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id""",
    "op12_ranked_search": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts, row_number() OVER () AS r FROM documents),
i AS (SELECT item_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM (SELECT DISTINCT item_id, text FROM benchmark)),
tot AS (SELECT count(*) AS big_n, CAST(sum(len(ts)) AS BIGINT) AS big_l FROM d WHERE len(ts) > 0),
post AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) GROUP BY r, t),
df AS (SELECT t, count(*) AS df FROM post GROUP BY t),
q AS (SELECT item_id, text, t, count(*) AS c FROM (SELECT item_id, text, unnest(ts) AS t FROM i) GROUP BY item_id, text, t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, tot),
m AS (SELECT r, doc_id, 75 + ((25 * len(ts) * big_n) // big_l) AS m FROM d, tot),
s AS (SELECT item_id, q.text, p.r, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN post p USING (t) JOIN w USING (t) JOIN m ON m.r = p.r GROUP BY item_id, q.text, p.r, doc_id),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20""",
}
