"""SQL of the queries whose rounds or steps make it long."""

from __future__ import annotations


def clusters_sql(k: int, dims: int, scale: int, rounds: int, seed: int) -> str:
    """Lloyd's rounds, each as two steps: the nearest centroid of every vector, then the floor of the means."""
    steps = [
        f"""kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS p
    FROM embeddings
    WHERE len(embedding) = {dims}
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {dims}
), started AS MATERIALIZED (
    SELECT p, sha256('{seed}:' || vec_id) AS h FROM kept ORDER BY h NULLS LAST, p LIMIT {k}
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h NULLS LAST, p) - 1 AS j, p AS c FROM started
)"""
    ]
    for step in range(rounds + 1):
        steps.append(
            f"""near{step} AS MATERIALIZED (
    SELECT r, min({{'d': d, 'j': j}}) AS best FROM (
        SELECT r, j, list_sum(list_transform(range(1, {dims + 1}), lambda i: (p[i] - c[i]) * (p[i] - c[i])))::BIGINT AS d
        FROM kept, c{step}
    ) GROUP BY r
)"""
        )
        if step == rounds:
            break
        steps.append(
            f"""c{step + 1} AS MATERIALIZED (
    SELECT c{step}.j, coalesce(m.c, c{step}.c) AS c FROM c{step} LEFT JOIN (
        SELECT j, list(v ORDER BY i) AS c FROM (
            SELECT j, i, CAST((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
            FROM (SELECT best.j AS j, unnest(p) AS x, unnest(range({dims})) AS i FROM near{step} JOIN kept USING (r))
            GROUP BY j, i
        ) GROUP BY j
    ) m ON m.j = c{step}.j
)"""
        )
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(best.j AS INTEGER) AS cluster, best.d AS distance,
    CAST(sum(best.d) OVER (PARTITION BY best.j) AS BIGINT) AS cluster_inertia,
    CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{rounds} JOIN kept USING (r) JOIN c{rounds} ON c{rounds}.j = best.j
"""


# Base32 of SHA-1: five bytes, ten hexadecimal digits, give eight digits of five bits.
WARC_SQL = """
WITH payload AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h
    FROM pages
), named AS (
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + CAST((CAST('0x' || substr(h, 1 + 10 * (i // 8), 10) AS BIGINT) >> (5 * (7 - i % 8))) & 31 AS INTEGER),
        1)), '') AS payload_digest
    FROM payload
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
FROM named WINDOW same AS (PARTITION BY payload_digest)
"""


# The damage by CRC-32 (its table made by eight steps for each byte), and the dynamic program as a recursion over rows.
# A state is {cost, audit, text}: structs compare by cost, then by audit, of which the text is a function.
AUDIT_SQL = r"""
WITH RECURSIVE crc_step AS (
    SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS n FROM range(256) t(i)
    UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM crc_step WHERE n < 8
), crc_table AS MATERIALIZED (
    SELECT list(c ORDER BY i) AS t FROM crc_step WHERE n = 8
), said AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
), dealt AS (
    SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS kind
    FROM said, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM dealt WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS seen,
        regexp_replace(text, '[\x20\x09-\x0D]+\z', '') AS body
    FROM damaged
), faulty AS MATERIALIZED (
    SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen THEN 'duplicate'
            WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
        CASE WHEN i > 1 THEN lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') END AS illegal
    FROM placed
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        CAST(count_if(fault = 'blank') AS BIGINT) AS blank, CAST(count_if(fault = 'duplicate') AS BIGINT) AS duplicate,
        CAST(count_if(fault = 'truncated') AS BIGINT) AS truncated, CAST(count_if(illegal) AS BIGINT) AS illegal
    FROM faulty GROUP BY conv_id
), path AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, {'c': 0, 'a': '', 't': ''} AS n, {'c': 1000000000, 'a': '', 't': ''} AS s,
        {'c': 5, 'a': 'I', 't': 'user:' || chr(10)} AS u, {'c': 10, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)} AS a
    FROM counted
    UNION ALL
    SELECT conv_id, i, n, s, u, list_min([a, {'c': u.c + 5, 'a': u.a || 'I', 't': u.t || 'assistant:' || chr(10)}])
    FROM (SELECT conv_id, i, n, s, a, list_min([u, {'c': a.c + 5, 'a': a.a || 'I', 't': a.t || 'user:' || chr(10)},
            {'c': s.c + 5, 'a': s.a || 'I', 't': s.t || 'user:' || chr(10)},
            {'c': n.c + 5, 'a': n.a || 'I', 't': n.t || 'user:' || chr(10)}]) AS u
    FROM (
        SELECT p.conv_id, f.i,
            {'c': n.c + 2, 'a': n.a || 'D', 't': n.t} AS n,
            list_min([{'c': s.c + 2, 'a': s.a || 'D', 't': s.t},
                {'c': n.c + CASE WHEN left(role, 1) = 's' THEN keep ELSE 1000000000 END, 'a': n.a || 'K', 't': n.t || own}]) AS s,
            list_min([{'c': u.c + 2, 'a': u.a || 'D', 't': u.t},
                {'c': n.c + to_u, 'a': n.a || e_u, 't': n.t || t_u}, {'c': s.c + to_u, 'a': s.a || e_u, 't': s.t || t_u},
                {'c': a.c + to_u, 'a': a.a || e_u, 't': a.t || t_u}]) AS u,
            list_min([{'c': a.c + 2, 'a': a.a || 'D', 't': a.t}, {'c': u.c + to_a, 'a': u.a || e_a, 't': u.t || t_a}]) AS a
        FROM path p JOIN (
            SELECT *, keep + CASE WHEN left(role, 1) = 'u' THEN 0 ELSE 1 END AS to_u, CASE WHEN left(role, 1) = 'u' THEN 'K' ELSE 'R' END AS e_u,
                CASE WHEN left(role, 1) = 'u' THEN own ELSE 'user:' || text || chr(10) END AS t_u,
                keep + CASE WHEN left(role, 1) = 'a' THEN 0 ELSE 1 END AS to_a, CASE WHEN left(role, 1) = 'a' THEN 'K' ELSE 'R' END AS e_a,
                CASE WHEN left(role, 1) = 'a' THEN own ELSE 'assistant:' || text || chr(10) END AS t_a
            FROM (SELECT *, role || ':' || text || chr(10) AS own,
                CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS keep FROM faulty)
        ) f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
    ))
), ended AS (
    SELECT conv_id, list_min([n, a]) AS best FROM (
        SELECT conv_id, n, a, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS last FROM path
    ) WHERE last = 1
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
    coalesce(best.a, '') AS audit, sha256(coalesce(left(best.t, length(best.t) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
