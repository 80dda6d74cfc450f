"""DuckDB SQL for the queries that SQL expresses, written from what they are to return."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words: ASCII lower case, split at ASCII white space.
_WORDS = f"""
words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
)"""

OP5 = f"""
WITH RECURSIVE {_WORDS},
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
    SELECT doc_id, i, n, array_to_string(w[i - n + 1 : i], ' ') AS g,
           CASE WHEN n > 1 THEN array_to_string(w[i - n + 1 : i - 1], ' ') END AS context
    FROM places, (VALUES (1), (2), (3)) AS orders(n) WHERE i >= n
),
own AS (SELECT doc_id, n, g, count(*) AS c FROM grams GROUP BY ALL),
corpus AS (SELECT n, g, sum(c) AS c FROM own GROUP BY ALL),
size AS (SELECT sum(len(w)) AS total FROM words),
seen AS (
    SELECT a.doc_id, a.i, a.n, k.c - o.c AS c, kc.c - oc.c AS context_c
    FROM grams a JOIN corpus k USING (n, g) JOIN own o USING (doc_id, n, g)
    LEFT JOIN corpus kc ON kc.n = a.n - 1 AND kc.g = a.context
    LEFT JOIN own oc ON oc.doc_id = a.doc_id AND oc.n = a.n - 1 AND oc.g = a.context
),
best AS (
    SELECT doc_id, i, max(n) AS longest, max(CASE WHEN c > 0 THEN n END) AS n,
           arg_max(c, CASE WHEN c > 0 THEN n END) AS c, arg_max(context_c, CASE WHEN c > 0 THEN n END) AS context_c
    FROM seen GROUP BY doc_id, i
),
scored AS (
    SELECT b.doc_id, b.n,
           ln(CASE WHEN b.n > 1 THEN b.c::DOUBLE / b.context_c
                   ELSE greatest(coalesce(b.c, 1), 1)::DOUBLE / greatest(s.total - len(w.w), 1) END)
           + (b.longest - coalesce(b.n, 1)) * ln(0.4) AS value
    FROM best b JOIN words w USING (doc_id), size s
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, round(coalesce(sum(s.value), 0), 6) AS score,
       count(s.doc_id) FILTER (WHERE s.n IS NULL) AS n_unseen,
       count(*) FILTER (WHERE s.n = 1) AS hits_1, count(*) FILTER (WHERE s.n = 2) AS hits_2, count(*) FILTER (WHERE s.n = 3) AS hits_3
FROM words w LEFT JOIN scored s USING (doc_id) GROUP BY w.doc_id, len(w.w)
"""

OP8 = f"""
WITH RECURSIVE {_WORDS},
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 90 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sizes UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT w.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, coalesce(c.least, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes z USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS least FROM reach GROUP BY x) c USING (doc_id)
"""

OP9 = """
WITH usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]), lambda a, b: a + b) AS score
    FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20
"""

OP10 = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS i FROM bytes)),
gone AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM starts) WHERE first < doc_id),
edges AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER w <= 50 THEN 0 ELSE 1 END AS new FROM gone WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM edges),
spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY ALL),
between_spans AS (
    SELECT b.doc_id, b.h, s.a, s.b, coalesce(lag(s.b) OVER w, 0) AS kept_from, row_number() OVER w AS k, count(s.a) OVER (PARTITION BY b.doc_id) AS n
    FROM bytes b LEFT JOIN spans s USING (doc_id) WINDOW w AS (PARTITION BY b.doc_id ORDER BY s.a)
),
kept AS (
    SELECT doc_id, any_value(length(h)) // 2 AS n_bytes, coalesce(sum(b - a), 0)::BIGINT AS n_removed, any_value(n)::BIGINT AS n_spans,
           string_agg(CASE WHEN n = 0 THEN h WHEN k = n THEN substr(h, 2 * kept_from + 1, 2 * (a - kept_from)) || substr(h, 2 * b + 1)
                           ELSE substr(h, 2 * kept_from + 1, 2 * (a - kept_from)) END, '' ORDER BY k) AS left_over
    FROM between_spans GROUP BY doc_id
)
SELECT doc_id, n_bytes, n_removed, n_spans, sha256(unhex(left_over)) AS kept_sha256 FROM kept
"""

OP11 = f"""
WITH rules(host, path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
rest AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT row_number() OVER () AS k, page_id, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (
    SELECT p.k, r.host || r.path AS rule, r.verdict FROM parts p JOIN rules r
    ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path)
),
best AS (SELECT k, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY k)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict FROM parts p LEFT JOIN best b USING (k)
"""

#: crc32 bit by bit; edits by a table with one row for each conversation and turn, strings copied whole.
OP12 = r"""
WITH RECURSIVE named AS (
    SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
),
coded AS (
    SELECT *, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)
    )) % 20 AS kind FROM named
),
damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
           unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM coded
),
placed AS (
    SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, role, text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i
    FROM damaged
),
faults AS (
    SELECT *, left(role, 1) AS initial, CASE
        WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before
    FROM placed
),
counts AS (
    SELECT c, any_value(conv_id) AS conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY c
),
steps AS (
    SELECT c, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': ''} AS n, {'c': 1000000000::BIGINT, 'a': ''} AS s, {'c': 1000000000::BIGINT, 'a': ''} AS u, {'c': 1000000000::BIGINT, 'a': ''} AS a FROM counts
    UNION ALL
    SELECT c, i,
           {'c': n.c + 3, 'a': n.a || 'D'},
           list_sort([{'c': s.c + 3, 'a': s.a || 'D'}, CASE WHEN NOT gone AND initial = 's' THEN {'c': n.c + cut, 'a': n.a || 'K'} ELSE {'c': 1000000000::BIGINT, 'a': ''} END])[1],
           list_sort([{'c': u.c + 3, 'a': u.a || 'D'}, CASE WHEN gone THEN {'c': 1000000000::BIGINT, 'a': ''} ELSE
               list_sort(list_transform([n, s, a], lambda z: {'c': z.c + cut + CASE initial WHEN 'u' THEN 0 ELSE 2 END, 'a': z.a || CASE initial WHEN 'u' THEN 'K' ELSE 'R' END}))[1] END])[1],
           list_sort([{'c': a.c + 3, 'a': a.a || 'D'}, CASE WHEN gone THEN {'c': 1000000000::BIGINT, 'a': ''} ELSE
               {'c': u.c + cut + CASE initial WHEN 'a' THEN 0 ELSE 2 END, 'a': u.a || CASE initial WHEN 'a' THEN 'K' ELSE 'R' END} END])[1]
    FROM (
        SELECT c, i, n, s, u, list_sort([a, {'c': u.c + 2, 'a': u.a || 'I'}])[1] AS a, initial, gone, cut
        FROM (
            SELECT t.c, r.i, t.n, t.s, list_sort([t.u, {'c': t.n.c + 2, 'a': t.n.a || 'I'}, {'c': t.s.c + 2, 'a': t.s.a || 'I'}, {'c': t.a.c + 2, 'a': t.a.a || 'I'}])[1] AS u, t.a,
                   r.initial, r.fault IN ('blank', 'duplicate') AS gone, CASE r.fault WHEN 'truncated' THEN 1 ELSE 0 END AS cut
            FROM steps t JOIN faults r ON r.c = t.c AND r.i = t.i + 1
        )
    )
),
chosen AS (
    SELECT t.c, list_sort([t.n, t.a, {'c': t.u.c + 2, 'a': t.u.a || 'I'}, {'c': t.s.c + 4, 'a': t.s.a || 'II'}])[1] AS best
    FROM steps t JOIN counts k ON k.c = t.c AND k.n = t.i
),
letters AS (SELECT c, best.a AS audit, unnest(range(1, length(best.a) + 1)) AS p FROM chosen),
edits AS (
    SELECT c, p, substr(audit, p, 1) AS edit, p - (length(substr(audit, 1, p)) - length(replace(substr(audit, 1, p), 'I', ''))) AS i,
           length(replace(substr(audit, 1, p), 'D', '')) AS place
    FROM letters
),
lines AS (
    SELECT e.*, r.role, r.text, max(CASE WHEN edit = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.c) AS system
    FROM edits e LEFT JOIN faults r ON r.c = e.c AND r.i = e.i
),
repaired AS (
    SELECT c, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS digest
    FROM lines WHERE edit <> 'D' GROUP BY c
)
SELECT o.conv_id, coalesce(k.gaps, 0) AS gaps, coalesce(k.blank, 0) AS blank, coalesce(k.duplicate, 0) AS duplicate, coalesce(k.truncated, 0) AS truncated,
       coalesce(k.illegal, 0) AS illegal, coalesce(x.best.c, 0) AS cost, coalesce(x.best.a, '') AS audit, coalesce(r.digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN chosen x ON x.c = k.c LEFT JOIN repaired r ON r.c = k.c
"""

OP13 = f"""
WITH numbered AS (
    SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
),
size AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM numbered WHERE len(w) > 0),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM benchmark
),
uses AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM numbered) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM uses, size GROUP BY term, docs),
scored AS (
    SELECT a.item_id, n.doc_id, sum(x.weight * ((1000000000 * u.tf) // (1000 * u.tf + 20 * (100 - 50 + (50 * len(n.w) * s.docs) // s.terms))))::BIGINT AS score
    FROM asked a JOIN uses u USING (term) JOIN weights x USING (term) JOIN numbered n USING (d), size s
    GROUP BY a.item_id, n.d, n.doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""

ORACLES: dict[str, str] = {
    "op5_backoff": OP5,
    "op8_jaccard_join": OP8,
    "op9_vantage": OP9,
    "op10_suffix_dedup": OP10,
    "op11_url_rules": OP11,
    "op12_conversation_repair": OP12,
    "op13_lexical_search": OP13,
}
