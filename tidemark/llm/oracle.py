"""DuckDB SQL for operators whose rows plain SQL can give."""

from __future__ import annotations

import zlib

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: CRC-32 of one byte, from an empty register
_STEPS = ", ".join(str(zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF) for b in range(256))
_WORDS = rf"unnest(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"

IMPORTANCE = rf"""
    WITH steps AS (SELECT [{_STEPS}]::BIGINT[] AS k),
    d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
    b AS (SELECT {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
    names AS (SELECT w, hex(w) AS h FROM (SELECT w FROM d UNION SELECT w FROM b)),
    buckets AS (
        SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
                                  lambda c, x: xor(k[(xor(c, x) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 10000 AS bucket
        FROM names, steps
    ),
    counts AS (SELECT doc_id, bucket, count(*) AS n FROM d JOIN buckets USING (w) GROUP BY ALL),
    s AS (SELECT bucket, sum(n) AS s FROM counts GROUP BY 1),
    t AS (SELECT bucket, count(*) AS t FROM b JOIN buckets USING (w) GROUP BY 1),
    sums AS (SELECT CAST((SELECT count(*) FROM d) + 10000 AS DOUBLE) AS all_s, CAST((SELECT count(*) FROM b) + 10000 AS DOUBLE) AS all_t),
    gain AS (
        SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1.0) * all_s / ((CAST(coalesce(s, 0) AS DOUBLE) + 1.0) * all_t))) AS BIGINT) AS gain
        FROM s FULL JOIN t USING (bucket), sums
    ),
    weighed AS (SELECT doc_id, sum(n) AS n, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight FROM counts JOIN gain USING (bucket) GROUP BY 1),
    scored AS (
        SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
        FROM documents LEFT JOIN weighed USING (doc_id)
    ),
    ranked AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT count(*) FROM scored WHERE n_features >= 20) * 10 // 100 THEN place END AS rank FROM ranked
"""

_P = "1 + 1000000000::HUGEINT * ({} + 2) // ({} + 2 * {})"
_F = "(({0}) - ({1})) * (({0}) - ({1})) // (({0}) + ({1}))"

DIVERGENCE = rf"""
    WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    words AS (SELECT id, lang, source, unnest(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT id) >= 10),
    sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY 1),
    groups AS (SELECT DISTINCT lang, source FROM d),
    own AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    totals AS (SELECT lang, source, sum(n) AS total FROM own GROUP BY ALL),
    p AS (
        SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n, {_P.format("coalesce(o.n, 0)", "coalesce(t.total, 0)", "s.v")} AS p, {_P.format("k.n", "s.total", "s.v")} AS q
        FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
        LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
    ),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum({_F.format("a.p", "b.p")}) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    found AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL SELECT lang, source, 'term', term, CAST({_F.format("p", "q")} AS BIGINT) FROM p WHERE n > 0 AND p > q
    ),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM found)
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
