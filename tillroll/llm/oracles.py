"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_URLS = r"""
pages2 AS (
    SELECT page_id, url,
           date '2024-01-01' + CAST((page_id * 7) % 366 AS INTEGER) AS day,
           date '2024-01-01' + CAST((page_id * 13 + 30) % 366 AS INTEGER) AS later,
           lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
           regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS section
    FROM pages
),
entries AS (
    SELECT host || '/' || section AS pattern, later AS day, 'block' AS action
    FROM pages2 WHERE contains(url, 'utm_')
    UNION ALL SELECT host, later, 'allow' FROM pages2 WHERE contains(url, '#')
    UNION ALL SELECT substr(host, 5), later, 'block' FROM pages2 WHERE starts_with(host, 'www.')
),
daily AS (SELECT pattern, day, max(action) AS action FROM entries GROUP BY ALL),
intervals AS (
    SELECT pattern, action, day AS since,
           lead(day) OVER (PARTITION BY pattern ORDER BY day) AS until
    FROM daily
),
fits AS (
    SELECT page_id, url, day, host AS pattern FROM pages2 WHERE host <> ''
    UNION SELECT page_id, url, day, array_to_string(string_split(host, '.')[n:], '.')
          FROM pages2, range(2, 20) AS r(n) WHERE n < len(string_split(host, '.'))
    UNION SELECT page_id, url, day, host || '/' || section FROM pages2 WHERE host <> '' AND section <> ''
),
active AS (
    SELECT f.page_id, f.url, f.day, f.pattern, i.since, i.action
    FROM fits f JOIN intervals i
      ON f.pattern = i.pattern AND f.day >= i.since AND (i.until IS NULL OR f.day < i.until)
),
best AS (
    SELECT page_id, count(*) AS n_active,
           arg_max({'p': pattern, 's': since, 'a': action}, {'n': length(pattern), 'p': pattern}) AS b
    FROM active GROUP BY page_id
)
"""

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(table: str, key: str) -> str:
    """Distinct five-word shingles (key, s) of a table; a shorter text is one shingle."""
    return f"""
        SELECT DISTINCT {key}, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT {key}, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM {table}) AS x,
             unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i)
        WHERE len(w) > 0
    """


ORACLES: dict[str, str] = {
    "op3_tensored_minhash": f"""
        WITH RECURSIVE sh AS ({_shingles('documents', 'doc_id')}),
        sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
        ),
        links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)
        ),
        reach AS (
            SELECT a, b FROM links
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ),
        least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT doc_id, coalesce(sizes.n, 0) AS n_shingles,
               least(doc_id, coalesce(least.b, doc_id)) AS component_id,
               doc_id = least(doc_id, coalesce(least.b, doc_id)) AS kept
        FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.a = doc_id
    """,
    "op4_url_list": f"""
        WITH {_URLS}
        SELECT p.page_id, p.day, coalesce(n_active, 0) AS n_active, b.p AS pattern, b.s AS since,
               coalesce(b.a, 'allow') AS action, coalesce(b.a, 'allow') = 'allow' AS kept
        FROM pages2 p LEFT JOIN best USING (page_id)
    """,
    "op5_line_frequency": rf"""
        WITH docs AS (
            SELECT doc_id, source, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
            FROM documents
        ),
        lines AS (
            SELECT doc_id, source, text, i AS place, string_split(text, chr(10))[i] AS line
            FROM docs, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS r(i)
        ),
        worded AS (
            SELECT doc_id, source, text, place, line, len(regexp_extract_all(line, '{_WORD}')) AS n,
                   array_to_string(regexp_extract_all(lower(line), '{_WORD}'), ' ') AS norm
            FROM lines WHERE regexp_matches(line, '{_WORD}')
        ),
        dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY doc_id),
        frequent AS (
            SELECT source, norm, min(doc_id) AS first, count(DISTINCT text) AS n
            FROM worded GROUP BY source, norm
        ),
        gone AS (
            SELECT l.doc_id, sum(l.n) AS n
            FROM worded l JOIN frequent f
              ON l.source IS NOT DISTINCT FROM f.source AND l.norm = f.norm
            WHERE f.n > 5 AND l.doc_id <> f.first
            GROUP BY l.doc_id
        ),
        windows AS (
            SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
            FROM docs, unnest(range(1, len(w) - 1)) AS r(i)
        ),
        twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS n FROM windows),
        covered AS (
            SELECT doc_id, count(DISTINCT i + k) AS n
            FROM twice, range(0, 3) AS r(k) WHERE n > 1 GROUP BY doc_id
        ),
        base AS (
            SELECT d.doc_id, len(w) AS n_words,
                   length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars,
                   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
                   coalesce(gone.n, 0) AS n_removed_words
            FROM docs d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)
                 LEFT JOIN gone USING (doc_id)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
                 AND (n_removed_words = 0 OR (n_words - n_removed_words >= 50
                      AND n_words - n_removed_words >= 0.2 * n_words)) AS kept,
               CAST(n_removed_words AS BIGINT) AS n_removed_words
        FROM base
    """,
    "op9_grammar": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ),
        shown AS (
            SELECT *, length(role) + length(text) + 14 + CASE
                WHEN contains(text, '</turn>') OR contains(text, '### ') OR contains(text, '\b')
                  OR contains(text, '\h') OR contains(text, '\l')
                THEN length(regexp_replace(text, '[^\\#<]', '', 'g')) ELSE 0 END AS chars
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM shown GROUP BY conv_id
    """,
    "op10_containment": f"""
        WITH sh AS ({_shingles('documents', 'doc_id')}),
        items AS ({_shingles('benchmark', 'item_id')}),
        sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id)
        SELECT doc_id, item_id, n AS n_item, count(*) AS n_shared
        FROM sh JOIN items USING (s) JOIN sizes USING (item_id)
        GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 75 * n
    """,
    "op11_wide_counters": rf"""
        WITH docs AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
            FROM documents
        ),
        failed AS (
            SELECT part, l.quality, l.toxic,
                   CAST(len(w) < 200 AS INTEGER)
                   + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER)
                   + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS INTEGER)
                   + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
                   + 16 * CAST(doc_id > min(doc_id) OVER (PARTITION BY t) AS INTEGER) AS mask
            FROM docs LEFT JOIN labels l USING (doc_id)
        ),
        counts AS (
            SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good,
                   count(*) FILTER (toxic = 1) AS toxic
            FROM failed GROUP BY part, mask
        ),
        f(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        orders AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
                AND len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
        ),
        steps AS (
            SELECT filter_order, CAST(k AS INTEGER) AS step, bits[k] AS own,
                   CAST(coalesce(list_sum(bits[1:k - 1]), 0) AS INTEGER) AS earlier
            FROM orders, unnest(range(1, 6)) AS r(k)
        ),
        told AS (
            SELECT part, filter_order, step, own,
                   CAST(coalesce(sum(n) FILTER (mask & (own | earlier) = 0), 0) AS BIGINT) AS kept,
                   CAST(coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier = 0), 0) AS BIGINT) AS removed,
                   CAST(coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier > 0), 0) AS BIGINT) AS redundant,
                   CAST(coalesce(sum(n) FILTER (mask = own), 0) AS BIGINT) AS unique_fails,
                   CAST(coalesce(sum(good) FILTER (mask & own > 0 AND mask & earlier = 0), 0) AS BIGINT) AS good_lost,
                   CAST(coalesce(sum(toxic) FILTER (mask & own > 0 AND mask & earlier = 0), 0) AS BIGINT) AS toxic_lost
            FROM counts, steps GROUP BY part, filter_order, step, own
        )
        SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM told
    """,
    "op13_dense_tiles": rf"""
        WITH terms AS (
            SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents
        ),
        asked AS (
            SELECT item_id, term, count(*) AS q
            FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark)
            GROUP BY item_id, term
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
        whole AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS l FROM sizes),
        held AS (
            SELECT doc_id, term, count(*) AS tf FROM terms
            WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
        ),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM held GROUP BY term), whole
        ),
        impacts AS (
            SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // l))) AS i
            FROM held JOIN sizes USING (doc_id) JOIN weights USING (term), whole
        ),
        scores AS (
            SELECT item_id, doc_id, CAST(sum(q * i) AS BIGINT) AS score
            FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
            FROM scores WHERE score > 0
        )
        WHERE rank <= 20
    """,
}
