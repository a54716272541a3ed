"""The SQL that the registered queries must agree with, where SQL can express the result."""

from __future__ import annotations

STATEMENTS = {
    "op5_exact_dedup": r"""
        WITH bare AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), best AS (
            SELECT text_sha256, count(*) AS group_size,
                   first(doc_id ORDER BY chars DESC, doc_id) AS keep_id
            FROM bare GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM bare JOIN best USING (text_sha256)
    """,
    "op6_warc": """
        WITH hashed AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
            FROM pages
        ), firsts AS (
            SELECT hex, min(page_id) AS first_id FROM hashed GROUP BY hex
        )
        SELECT page_id, payload_bytes,
               array_to_string([
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                          1 + ((CAST('0x' || substr(hex, 5 * (k // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31), 1)
                   FOR k IN range(32)], '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM hashed JOIN firsts USING (hex)
    """,
    "op11_hard_negatives": """
        WITH base AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
            FROM base a JOIN base b ON a.vec_id != b.vec_id
            WHERE a.vec_id % 50 = 0
        ), positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
               other_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
    """,
    # The sample tables' pages hold their text in one article element of paragraphs and a heading.
    "op13_host_paths": r"""
        WITH article AS (
            SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS body FROM pages
        ), bare AS (
            SELECT page_id, url,
                   regexp_replace(regexp_replace(body, '</?(p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS body
            FROM article
        ), decoded AS (
            SELECT page_id, url,
                   regexp_replace(replace(replace(replace(replace(body, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)),
                                  '&amp;?', '&', 'g') AS body
            FROM bare
        ), trimmed AS (
            SELECT page_id, url, trim(regexp_replace(coalesce(body, ''), '[\s\p{Z}]+', ' ', 'g')) AS text FROM decoded
        )
        SELECT page_id, url, text, length(text) AS n_chars FROM trimmed
    """,
}
