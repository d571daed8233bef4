"""The SQL that registered queries are checked against, where SQL can express them."""

from __future__ import annotations

_LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

OP2 = f"""
WITH digests AS (SELECT doc_id, sha256({_LOWERED}) AS text_sha256 FROM documents),
groups AS (
    SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size
    FROM digests GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM digests JOIN groups USING (text_sha256)
"""

OP8 = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id, score
FROM scores
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""

_TERMS = r"""
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')
"""

OP13 = f"""
WITH terms AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
sizes AS (SELECT doc_id, 100 - 50 + (50 * n * docs) // total AS m FROM lengths, whole),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, whole GROUP BY term
),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM items JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id)
    GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank,
       doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""

STATEMENTS = {"op2_exact_dedup": OP2, "op8_topk": OP8, "op13_ranked": OP13}
