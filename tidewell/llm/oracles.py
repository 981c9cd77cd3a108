"""DuckDB SQL of the longer queries."""

from __future__ import annotations

SPACE = "[^ \\t-\\r]+"


def conversations() -> str:
    """Prefixes are named by a chain of MD5 digests of their turns."""
    bit = "CASE WHEN {0} % 2 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
    crc = f"""
        list_reduce(
            list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT)),
            lambda crc, byte: list_reduce(
                list_prepend(xor(crc, byte), list_transform(range(8), lambda i: i::UBIGINT)),
                lambda c, i: {bit.format("c")}
            )
        )
    """
    return f"""
    WITH RECURSIVE ids AS (
        SELECT conv_id, conv_id - conv_id % 20 AS base, xor(({crc}), 4294967295::UBIGINT) % 4 AS h
        FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
    ), numbered AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ), joined AS (
        SELECT i.conv_id, n.role, n.text, n.place, 0 AS own FROM ids i JOIN numbered n ON n.conv_id = i.base AND n.place <= i.h
        UNION ALL
        SELECT i.conv_id, n.role, n.text, n.place, 1 FROM ids i JOIN numbered n ON n.conv_id = i.conv_id AND n.place > i.h
    ), turns AS MATERIALIZED (
        SELECT conv_id, md5(length(role) || ':' || role || text) AS digest, len(regexp_extract_all(text, '{SPACE}')) AS words,
               row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth
        FROM joined
    ), steps AS (
        SELECT conv_id, 0::BIGINT AS depth, '' AS node, NULL::VARCHAR AS above, 0::BIGINT AS words FROM ids
        UNION ALL
        SELECT t.conv_id, t.depth, md5(s.node || t.digest), s.node, t.words
        FROM steps s JOIN turns t ON t.conv_id = s.conv_id AND t.depth = s.depth + 1
    ), passed AS MATERIALIZED (
        SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM steps
    ), nodes AS MATERIALIZED (
        SELECT node, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
        FROM passed GROUP BY node, depth
    ), children AS (
        SELECT above AS node, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above
    ), pairs AS MATERIALIZED (
        SELECT DISTINCT a.node AS top, b.node AS below
        FROM passed a JOIN passed b ON a.conv_id = b.conv_id AND a.depth <= b.depth
    ), sums AS (
        SELECT p.top, count(*) FILTER (c.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
        FROM pairs p JOIN nodes n ON n.node = p.below LEFT JOIN children c ON c.node = p.below GROUP BY p.top
    )
    SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves,
           s.saved::BIGINT AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums s ON s.top = n.node LEFT JOIN nodes u ON u.node = n.above LEFT JOIN children c ON c.node = n.node
    """


def centroids(dimensions: int = 64, clusters: int = 40, rounds: int = 5, seed: int = 2) -> str:
    steps = f"range(1, {dimensions + 1})"
    parts = [
        f"""kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = {dimensions}
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {dimensions}
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS cluster, v
            FROM kept QUALIFY cluster < {clusters}
        )""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
                SELECT vec_id, v, min(best) AS best FROM (
                    SELECT k.vec_id, k.v, {{'d': list_sum(list_transform({steps}, lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))::BIGINT,
                           'c': c.cluster}} AS best
                    FROM kept k, c{i} c
                ) GROUP BY vec_id, v
            )"""
        )
        if i < rounds:
            # The rest of a division by a positive number, never negative, makes it a floor.
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (
                    SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
                        SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
                            SELECT best.c AS cluster, i, sum(v[i])::BIGINT AS s, count(*) AS n
                            FROM a{i}, (SELECT unnest({steps}) AS i) GROUP BY best.c, i
                        ) GROUP BY cluster
                    ) m ON m.cluster = c.cluster
                )"""
            )
    return f"""
    WITH {", ".join(parts)}
    SELECT a.vec_id, a.best.c::INTEGER AS cluster, a.best.d AS distance,
           (sum(a.best.d) OVER (PARTITION BY a.best.c))::BIGINT AS cluster_inertia, (sum(a.best.d) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.best.c
    """


def phrases(window: int = 10) -> str:
    words = """regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
    return f"""
    WITH docs AS MATERIALIZED (
        SELECT row_number() OVER () AS number, doc_id, coalesce({words}, []::VARCHAR[]) AS w FROM documents
    ), items AS (
        SELECT item_id::VARCHAR AS item, coalesce({words}, []::VARCHAR[]) AS w FROM benchmark
    ), item_windows AS MATERIALIZED (
        SELECT DISTINCT item, length, array_to_string(w[pos:pos + length - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, len(w) - length + 2)) AS pos FROM (SELECT *, least({window}, len(w)) AS length FROM items))
        WHERE length > 0
    ), places AS (
        SELECT number, length, pos, array_to_string(w[pos:pos + length - 1], ' ') AS phrase
        FROM (SELECT number, w, length, unnest(range(1, len(w) - length + 2)) AS pos
              FROM docs, (SELECT DISTINCT length FROM item_windows))
    ), found AS MATERIALIZED (
        SELECT DISTINCT p.number, p.pos, p.length, i.item FROM places p JOIN item_windows i USING (length, phrase)
    ), words_hit AS (
        SELECT number, count(DISTINCT pos + step) AS n
        FROM (SELECT number, pos, unnest(range(length)) AS step FROM found) GROUP BY number
    ), items_hit AS (
        SELECT number, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT number, item FROM found WHERE item IS NOT NULL) GROUP BY number
    )
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
           sha256(coalesce(i.names, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
    FROM docs d LEFT JOIN words_hit h USING (number) LEFT JOIN items_hit i USING (number)
    """
