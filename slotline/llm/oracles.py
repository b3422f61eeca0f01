"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations


def _op10_chat() -> str:
    def escaped(column: str) -> str:
        control = r"(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])"
        return rf"regexp_replace(replace({column}, '\', '\\'), '{control}', '\1\3\\\2\4', 'g')"

    return f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), placed AS (
        SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after, row_number() OVER w AS n
        FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    ), sized AS (
        SELECT *, length({escaped("text")})
            + CASE WHEN before IS NOT DISTINCT FROM role THEN length('<|next|>')
                   ELSE length('<|start|>') + length({escaped("role")}) + length('<|body|>') END
            + CASE WHEN after IS NOT DISTINCT FROM role THEN 0 ELSE length('<|end|>') END AS chars
        FROM placed
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM sized GROUP BY conv_id"""


#: Strings are slices of the text's bytes; what is kept is put together in hexadecimal digits.
_OP5_SUBSTRINGS = """
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS o, encode(coalesce(text, '')) AS b FROM documents
    ), w AS (
        SELECT r, o, s, b[s + 1 : s + 50] AS x FROM (SELECT r, o, b, unnest(range(0, greatest(0, octet_length(b) - 49))) AS s FROM d)
    ), hit AS (
        SELECT w.r, w.s FROM w JOIN (SELECT x, min(o) AS low FROM w GROUP BY x HAVING min(o) < max(o)) m ON m.x = w.x AND w.o > m.low
    ), island AS (
        SELECT r, min(s) AS a, max(s) + 50 AS e FROM (
            SELECT *, sum(new) OVER (PARTITION BY r ORDER BY s) AS k FROM (
                SELECT r, s, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + 50 THEN 0 ELSE 1 END AS new FROM hit))
        GROUP BY r, k
    ), gap AS (
        SELECT r, a, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM island
    ), lost AS (
        SELECT d.r, sum(e - a) AS n_removed, count(*) AS n_spans, string_agg(hex(b[before + 1 : a]), '' ORDER BY a) AS kept, max(e) AS last
        FROM gap JOIN d ON d.r = gap.r GROUP BY d.r
    )
    SELECT doc_id, cast(octet_length(b) AS BIGINT) AS n_bytes, cast(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
        sha256(coalesce(unhex(kept || hex(b[last + 1 : octet_length(b)])), b)) AS kept_sha256
    FROM d LEFT JOIN lost USING (r)"""


def _op12_codes(rounds: int = 2) -> str:
    """Whole-number k-means by parts, every distance of every round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
            SELECT r, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (
                SELECT r, x.p, e, list_sum(list_transform(list_zip(x.y, c.y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM x JOIN c{i} c ON c.p = x.p)
            GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
                SELECT p, e, list(s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END ORDER BY j) AS y FROM (
                    SELECT x.p, a.e, j, sum(y[j])::BIGINT AS s, count(*) AS n FROM x JOIN a{i} a ON a.r = x.r AND a.p = x.p, (SELECT unnest(range(1, 1 + (SELECT max(len(y)) FROM x))) AS j)
                    GROUP BY ALL) GROUP BY p, e
            ), c{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.y, c.y) AS y FROM c{i} c LEFT JOIN m{i} m USING (p, e))""")
    return f"""
    WITH k AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), x AS MATERIALIZED (
        SELECT r, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS y FROM k, (SELECT unnest(range(16)) AS p)
    ), c0 AS (SELECT p, r - 1 AS e, y FROM x WHERE r <= 64), {', '.join(steps)}, f AS (
        SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY r
    )
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
        (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256 FROM k JOIN f USING (r)"""


#: Each order's steps by definition, row groups of equal failures at a time; a share is summed over the orders.
_OP13_FILTERS = r"""
    WITH d AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
            min(doc_id) OVER (PARTITION BY t) AS low FROM documents
    ), lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1
    ), j AS (
        SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
            regexp_matches(t, '[#$%&*|]'), coalesce(low < doc_id, low IS NOT NULL)] AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
        FROM d LEFT JOIN lab USING (doc_id)
    ), g AS (SELECT part, fails, good, toxic, count(*) AS n FROM j GROUP BY ALL
    ), f AS (SELECT unnest([1, 2, 3, 4, 5]) AS i
    ), o AS (
        SELECT [a.i, b.i, c.i, d.i, e.i] AS p FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
    ), s AS (
        SELECT array_to_string(list_transform(p, lambda x: 'ABCDE'[x]), '') AS filter_order, k AS step, p[k] AS own, p[1 : k - 1] AS before FROM o, (SELECT i AS k FROM f)
    ), r AS (
        SELECT *, len(list_filter(before, lambda x: fails[x])) > 0 AS gone, len(list_filter(fails, lambda x: x)) AS n_fails FROM s, g
    ), c AS (
        SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails[own]), 0) AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND fails[own]), 0) AS removed,
            coalesce(sum(n) FILTER (WHERE gone AND fails[own]), 0) AS redundant, coalesce(sum(n) FILTER (WHERE fails[own] AND n_fails = 1), 0) AS unique_fails,
            coalesce(sum(n) FILTER (WHERE NOT gone AND fails[own] AND good), 0) AS good_lost, coalesce(sum(n) FILTER (WHERE NOT gone AND fails[own] AND toxic), 0) AS toxic_lost
        FROM r GROUP BY ALL
    )
    SELECT part, filter_order, cast(step AS INT) AS step, cast(kept AS BIGINT) AS kept, cast(removed AS BIGINT) AS removed, cast(redundant AS BIGINT) AS redundant,
        cast(unique_fails AS BIGINT) AS unique_fails, cast(good_lost AS BIGINT) AS good_lost, cast(toxic_lost AS BIGINT) AS toxic_lost,
        cast(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM c"""


def oracle_sql() -> dict[str, str]:
    """By name."""
    return {"op5_substrings": _OP5_SUBSTRINGS, "op10_chat": _op10_chat(), "op12_codes": _op12_codes(), "op13_filters": _OP13_FILTERS}
