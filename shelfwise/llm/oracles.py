"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Unrolled rounds over one row per component."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
        dist{k} AS (
            SELECT c.vec_id, c.part, b.entry, sum((c.val - b.val) * (c.val - b.val)) AS d
            FROM comp c JOIN book{k} b ON c.part = b.part AND c.place = b.place GROUP BY ALL
        ), near{k} AS (
            SELECT vec_id, part, entry, d FROM dist{k}
            QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1
        )""")
        if k < rounds:
            steps.append(f"""
        sums{k} AS (
            SELECT n.part, n.entry, c.place, sum(c.val) AS s, count(*)::HUGEINT AS n
            FROM near{k} n JOIN comp c ON c.vec_id = n.vec_id AND c.part = n.part GROUP BY ALL
        ), book{k + 1} AS (
            SELECT b.part, b.entry, b.place, CASE WHEN s.n IS NULL THEN b.val ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS val
            FROM book{k} b LEFT JOIN sums{k} s USING (part, entry, place)
        )""")
    return f"""
        WITH v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::HUGEINT) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), comp AS (
            SELECT vec_id, (i // w)::INTEGER AS part, (i % w)::INTEGER AS place, e[i + 1] AS val
            FROM (SELECT vec_id, e, unnest(range(len(e))) AS i, (SELECT max(len(e)) // {parts} FROM v) AS w FROM v)
        ), book0 AS (
            SELECT c.part, s.entry, c.place, c.val
            FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < {entries}) s JOIN comp c USING (vec_id)
        ), {",".join(steps)}, hashed AS (
            SELECT sha256(string_agg(val::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{rounds}
        ), coded AS (
            SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY v.label))::BIGINT AS label_error, codebooks_sha256
        FROM coded JOIN v USING (vec_id) CROSS JOIN hashed"""


def source_audit(least_docs: int = 3, top_terms: int = 200) -> str:
    """Every pair of sources over every kept term, without shortcuts."""
    return f"""
        WITH d AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
        ), w AS (
            SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
                                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
            FROM d
        ), kept AS (
            SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {least_docs}
        ), freq AS (
            SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY ALL
        ), v AS (
            SELECT lang, count(*) AS v FROM kept GROUP BY lang
        ), groups AS (
            SELECT g.lang, g.source, coalesce(v.v, 0) AS v, coalesce(n.n, 0) AS n
            FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN v ON v.lang = g.lang
            LEFT JOIN (SELECT lang, source, sum(c) AS n FROM freq GROUP BY ALL) n ON n.lang = g.lang AND n.source = g.source
        ), p AS (
            SELECT g.lang, g.source, k.term, coalesce(f.c, 0) AS c,
                   1 + (1000000000::HUGEINT * (coalesce(f.c, 0) + 1)) // (g.n + g.v) AS p
            FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN freq f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
        ), whole AS (
            SELECT f.lang, f.term, 1 + (1000000000::HUGEINT * (sum(f.c) + 1)) // (any_value(t.n) + any_value(t.v)) AS q
            FROM freq f JOIN (SELECT lang, sum(n) AS n, max(v) AS v FROM groups GROUP BY lang) t ON t.lang = f.lang GROUP BY ALL
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (
                SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
                FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
            ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        ), terms AS (
            SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p.p - q) * (p.p - q) // q)::BIGINT AS value
            FROM p JOIN whole USING (lang, term) WHERE c > 0 AND p.p > q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        )
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top_terms}"""


def jaccard_join(k: int = 4, num: int = 85, den: int = 100) -> str:
    """Every pair of documents that share a shingle; components by walking the links."""
    return f"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS id, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), places AS (
            SELECT id, w, unnest(range(1, greatest(len(w) - {k} + 1, 1) + 1)) AS p FROM d WHERE len(w) > 0
        ), s AS (
            SELECT DISTINCT id, array_to_string(w[p:p + {k} - 1], ' ') AS g FROM places
        ), n AS (
            SELECT id, count(*) AS n FROM s GROUP BY id
        ), link AS (
            SELECT x.id AS a, y.id AS b
            FROM (SELECT x.id AS x, y.id AS y, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.id <> y.id GROUP BY ALL) m
            JOIN n x ON x.id = m.x JOIN n y ON y.id = m.y WHERE {den} * c >= {num} * (x.n + y.n - c)
        ), reach AS (
            SELECT id AS a, id AS b FROM d
            UNION
            SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
        ), least AS (
            SELECT r.a, min(d.doc_id) AS component_id FROM reach r JOIN d ON d.id = r.b GROUP BY r.a
        )
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least.component_id, coalesce(l.c, 0)::BIGINT AS n_links
        FROM d JOIN least ON least.a = d.id LEFT JOIN n ON n.id = d.id LEFT JOIN (SELECT a, count(*) AS c FROM link GROUP BY a) l ON l.a = d.id"""


def repeated_windows(window: int = 35) -> str:
    """Every window as a string."""
    return f"""
        WITH d AS (
            SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), win AS (
            SELECT id, p, sha256(array_to_string(w[p:p + {window} - 1], ' ')) AS s
            FROM (SELECT id, w, unnest(range(1, len(w) - {window} + 2)) AS p FROM d WHERE len(w) >= {window})
        ), again AS (
            SELECT s FROM win GROUP BY s HAVING count(*) > 1
        ), gone AS (
            SELECT DISTINCT id, p + k AS p FROM win JOIN again USING (s) CROSS JOIN range({window}) t(k)
        ), kept AS (
            SELECT o.id, count(*) AS n, string_agg(o.w, ' ' ORDER BY o.p) AS words
            FROM (SELECT id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS p FROM d) o ANTI JOIN gone g ON g.id = o.id AND g.p = o.p GROUP BY o.id
        )
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.words, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON kept.id = d.id"""
