"""DuckDB SQL of the operators on centroids, conversations and benchmark items."""

from __future__ import annotations


def centroids(k: int = 8, rounds: int = 10) -> str:
    """Lloyd rounds as a chain of tables: a round assigns every vector, the next one moves the centroids."""
    head = f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), v) - 1 AS INTEGER) AS cluster, v
    FROM kept QUALIFY cluster < {k}
)"""
    assign = """
, a{r} AS MATERIALIZED (
    SELECT vec_id, x, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
    FROM (
        SELECT k.rowid, k.vec_id, k.v AS x, c.cluster,
            CAST(list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i]))) AS BIGINT) AS d
        FROM (SELECT row_number() OVER () AS rowid, * FROM kept) k, c{r} c
    ) GROUP BY rowid, vec_id, x
)"""
    move = """
, s{r} AS (
    SELECT cluster, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY cluster, i
), c{n} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
        SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY cluster
    ) m USING (cluster)
)"""
    chain = "".join(assign.format(r=r) + move.format(r=r, n=r + 1) for r in range(rounds)) + assign.format(r=rounds)
    return f"""{head}{chain}
SELECT vec_id, a.cluster, distance, CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.cluster
"""


# Checksums come from the usual table of 256 remainders, made by its rule. Turns are ordered by (turn, role, digest).
_DAMAGED = r"""
WITH RECURSIVE remainders AS MATERIALIZED (
    SELECT list(c ORDER BY b) AS t FROM (
        SELECT b, list_reduce(list_concat([b], range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256))
    )
), given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations
), fated AS MATERIALIZED (
    SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS fate
    FROM given, remainders
), damaged AS (
    SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM fated WHERE fate <> 0
), placed AS (
    SELECT conv_id, turn, role, text, substr(role, 1, 1) AS c,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
        regexp_extract(text, '^(?s:(.*[^\x20\x09-\x0D])?)[\x20\x09-\x0D]*$', 1) AS bare
    FROM damaged
), turns AS MATERIALIZED (
    SELECT conv_id, turn, role, text, c, i, bare = '' AS blank, bare <> '' AND again > 1 AS duplicate,
        bare <> '' AND again = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
        lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed
)"""

# States: 0 nothing, 1 system, 2 user last, 3 assistant last. Insertions are whole detours; lines are what a repair writes.
_REPAIR = _DAMAGED + r"""
, inserted(p, q, cost, edits, lines) AS (
    VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
        (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (3, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']),
        (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])
), steps(p, c, q) AS (
    VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), edits AS (
    SELECT conv_id, i, p, q, cost, edits, lines FROM (
        SELECT conv_id, i, n AS p, n AS q, 3 AS cost, 'D' AS edits, []::VARCHAR[] AS lines FROM turns, range(4) s(n)
        UNION ALL
        SELECT conv_id, i, p, q, CASE WHEN truncated THEN 1 ELSE 0 END, 'K', [role || ':' || text]
        FROM turns JOIN steps USING (c) WHERE NOT blank AND NOT duplicate
        UNION ALL
        SELECT conv_id, i, p, q, CASE WHEN truncated THEN 3 ELSE 2 END, 'R',
            [CASE steps.c WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text]
        FROM turns, steps WHERE NOT blank AND NOT duplicate AND steps.c <> 's'
    )
), moves AS MATERIALIZED (
    SELECT conv_id, i, n.p, e.q, min({'cost': n.cost + e.cost, 'audit': n.edits || e.edits, 'lines': list_concat(n.lines, e.lines)}) AS m
    FROM inserted n JOIN edits e ON n.q = e.p GROUP BY conv_id, i, n.p, e.q
), walked AS (
    SELECT conv_id, 0::BIGINT AS i, 0 AS state, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} AS best
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, i, q, best FROM (
        SELECT w.conv_id, m.i, m.q, min({'cost': w.best.cost + m.m.cost, 'audit': w.best.audit || m.m.audit,
            'lines': list_concat(w.best.lines, m.m.lines)}) AS best
        FROM walked w JOIN moves m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = w.i + 1 AND m.p = w.state
        GROUP BY w.conv_id, m.i, m.q
    )
), ended AS (
    SELECT w.conv_id, min({'cost': w.best.cost + n.cost, 'audit': w.best.audit || n.edits,
        'lines': list_concat(w.best.lines, n.lines)}) AS best
    FROM walked w JOIN inserted n ON n.p = w.state
    WHERE n.q IN (0, 3) AND w.i = (SELECT count(*) FROM turns t WHERE t.conv_id IS NOT DISTINCT FROM w.conv_id)
    GROUP BY w.conv_id
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
        count(*) FILTER (before || c NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
    sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_LEAKS = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM benchmark
), cut AS (
    SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS k FROM b WHERE len(ws) > 0
), windows AS MATERIALIZED (
    SELECT DISTINCT item_id, n, array_to_string(ws[k:k + n - 1], ' ') AS w FROM cut
), places AS (
    SELECT r, n, k, array_to_string(ws[k:k + n - 1], ' ') AS w
    FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM windows))
), found AS MATERIALIZED (
    SELECT r, n, k, w FROM places SEMI JOIN windows USING (n, w)
), hit AS (
    SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS j FROM found) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
        SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item
        FROM (SELECT DISTINCT r, n, w FROM found) JOIN windows USING (n, w) WHERE item_id IS NOT NULL
    ) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


def repairs() -> str:
    return _REPAIR


def leaks() -> str:
    return _LEAKS
