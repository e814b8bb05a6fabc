"""DuckDB SQL for the queries that SQL can express on whole tables."""

ORACLE: dict[str, str] = {
    "op12_hyperplane_tree": """
        WITH sound AS (
            SELECT vec_id,
                CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS point
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
                CAST(list_dot_product(a.point, b.point) AS BIGINT) AS score
            FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
            WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, vec_id, score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.vec_id AS positive_id,
            CAST(row_number() OVER nearest AS INTEGER) AS rank,
            n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
            AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        WINDOW nearest AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
        QUALIFY row_number() OVER nearest <= 10
    """,
    "op13_warc_dictionary": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), grouped AS (
            SELECT *,
                max(page_id) OVER same AS holder,
                row_number() OVER (
                    PARTITION BY payload_digest, payload_bytes ORDER BY page_id DESC NULLS LAST
                ) AS place
            FROM payloads
            WINDOW same AS (PARTITION BY payload_digest, payload_bytes)
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND place > 1 THEN holder END AS refers_to
        FROM grouped
    """,
}
