"""DuckDB SQL for the text queries that SQL can express, spelled out from their definitions."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"
_WORDS = f"list_filter(regexp_split_to_array({{0}}, '{_SPACE}'), lambda x: x <> '')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Windows of the items' sizes at the places that a shared shingle proposes, compared shingle by shingle.
_DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("lower(text)")} AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT row_number() OVER () AS i, item_id, {_WORDS.format("lower(text)")} AS w FROM benchmark WHERE text IS NOT NULL),
bg AS (SELECT i, len(w) AS n, least(5, len(w)) AS k, w[q:q + least(5, len(w)) - 1] AS g, q
       FROM (SELECT i, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS q FROM b WHERE len(w) > 0)),
dg AS (SELECT r, size, k, w[p:p + k - 1] AS g, p
       FROM (SELECT r, w, len(w) AS size, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM bg) WHERE len(w) >= k)),
win AS (SELECT DISTINCT r, bg.n, bg.k, greatest(0, least(p - q, size - bg.n)) AS start FROM dg JOIN bg USING (k, g)),
wg AS (SELECT r, n, start, g, count(*) AS c FROM (
         SELECT r, n, start, k, cut, unnest(range(1, len(cut) - k + 2)) AS p, cut[p:p + k - 1] AS g
         FROM (SELECT win.r, n, k, start, d.w[start + 1:start + n] AS cut FROM win JOIN d USING (r))) GROUP BY ALL),
ig AS (SELECT i, n, g, count(*) AS c FROM bg GROUP BY ALL),
sizes AS (SELECT r, n, start, sum(c) AS total FROM wg GROUP BY ALL),
isizes AS (SELECT i, n, sum(c) AS total FROM ig GROUP BY ALL),
met AS (SELECT r, i, wg.n AS n, start, sum(least(wg.c, ig.c)) AS shared FROM wg JOIN ig USING (n, g) GROUP BY ALL),
sim AS (SELECT doc_id, item_id, start, least(len(d.w), met.n) AS n_words,
               shared::DOUBLE / (sizes.total + isizes.total - shared)::DOUBLE AS similarity
        FROM met JOIN sizes USING (r, n, start) JOIN isizes USING (i, n) JOIN d USING (r) JOIN b USING (i))
SELECT doc_id, item_id, start::INT AS start, n_words::INT AS n_words, similarity FROM sim WHERE similarity >= 0.75
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, n_words DESC) = 1
"""

_JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' ')) END) AS s FROM d),
n AS (SELECT doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS k FROM g),
e AS (SELECT doc_id, unnest(s) AS t FROM g),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.t = b.t AND a.doc_id <> b.doc_id
          JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, CASE WHEN n = 0 THEN 1 ELSE count(*) OVER (PARTITION BY k) END AS class_size
FROM n JOIN comp USING (doc_id)
"""

_QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {_WORDS.format("text")} AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
grams AS (SELECT r, p, w[p:p + 4] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS p FROM w)),
twice AS (SELECT r, p FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
repeated AS (SELECT r, count(DISTINCT spot) AS n FROM (SELECT r, unnest(range(p, p + 5)) AS spot FROM twice) GROUP BY r),
lines AS (SELECT r, host, text, lower(trim(regexp_replace(line, '{_SPACE}', ' ', 'g'))) AS line, len({_WORDS.format("line")}) AS n
          FROM (SELECT r, host, text, unnest(lines) AS line FROM w)),
hosts AS (SELECT host, count(DISTINCT text) AS texts FROM lines GROUP BY host),
often AS (SELECT host, line FROM lines JOIN hosts USING (host) GROUP BY host, line, texts
          HAVING count(DISTINCT text) > 5 AND count(DISTINCT text) > 0.1::DOUBLE * texts),
removed AS (SELECT r, sum(n) AS n FROM lines JOIN often USING (host, line) GROUP BY r),
c AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(repeated.n, 0) AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS removed_words
      FROM w LEFT JOIN repeated USING (r) LEFT JOIN removed USING (r)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND NOT (n_words - removed_words < 0.2::DOUBLE * n_words) AS kept FROM v
"""

_WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM m
"""

_HOST = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', '')"
_URLS = rf"""
WITH p AS (SELECT page_id, url, {_HOST} AS host, lower(regexp_extract(url, '^[^/?#]*//[^/?#]*([^?#]*)', 1)) AS path,
                  TIMESTAMP '2024-01-01' + to_days((page_id % 30)::INT) + to_seconds((page_id * 7919 % 86400)::BIGINT) AS fetch_time FROM pages),
u AS (SELECT page_id, max_by(host, url) AS host, regexp_extract(max_by(path, url), '^/[^/]+/') AS folder FROM p GROUP BY page_id),
e AS (SELECT CASE WHEN event_type IN ('signup', 'error') THEN 'block' ELSE 'allow' END AS list,
             lower(CASE user_id % 3 WHEN 0 THEN regexp_replace(host, '^[^.]*\.', '') WHEN 1 THEN host || folder ELSE host END) AS pattern, ts AS at,
             max(CASE WHEN event_type IN ('signup', 'purchase') THEN 'add' ELSE 'remove' END) AS action
      FROM events JOIN u ON page_id = user_id % (SELECT max(page_id) + 1 FROM pages)
      WHERE event_type IN ('signup', 'purchase', 'error', 'click') GROUP BY ALL),
k AS (SELECT DISTINCT list, pattern, split_part(pattern, '/', 1) AS phost, substr(pattern, length(split_part(pattern, '/', 1)) + 1) AS ppath FROM e),
m AS (SELECT DISTINCT p.url, p.fetch_time, k.list, k.pattern FROM p JOIN k ON (p.host = phost OR ends_with(p.host, '.' || phost))
      AND (ppath = '' OR path = ppath OR (ends_with(ppath, '/') AND starts_with(path, ppath)))),
s AS (SELECT m.*, e.at AS valid_from, e.action FROM m ASOF JOIN e ON m.list = e.list AND m.pattern = e.pattern AND m.fetch_time >= e.at),
a AS (SELECT *, count(*) OVER (PARTITION BY url, fetch_time) AS n_active FROM s WHERE action = 'add'
      QUALIFY row_number() OVER (PARTITION BY url, fetch_time ORDER BY list = 'allow' DESC, length(pattern) DESC, pattern DESC, list DESC) = 1)
SELECT page_id, p.url, p.fetch_time, coalesce(list = 'block', false) AS blocked, coalesce(n_active, 0) AS n_active, list AS decided_by,
       pattern, valid_from
FROM p LEFT JOIN a ON p.url = a.url AND p.fetch_time = a.fetch_time
"""

_SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
c AS (SELECT count(*) FILTER (len(t) > 0) AS nn, sum(len(t))::BIGINT AS l FROM d),
i AS (SELECT row_number() OVER () AS i, * FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT i, item_id, term, count(*) AS reps FROM (SELECT i, item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i) GROUP BY ALL),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term, nn),
s AS (SELECT i, item_id, r, doc_id, sum(reps * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // l))))::BIGINT AS score
      FROM tf JOIN w USING (term) JOIN q USING (term), c GROUP BY i, item_id, r, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 10
"""


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd rounds with full scans, spelled out one after the other."""
    near = """{a} AS (SELECT x.r, x.p, min_by(e, (d, e)) AS e, min(d) AS d FROM (
      SELECT x.r, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
      FROM x JOIN {b} b USING (p)) x GROUP BY x.r, x.p)"""
    steps = []
    for i in range(rounds + 1):
        steps.append(near.format(a=f"a{i}", b=f"b{i}"))
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT p, e, list(c ORDER BY j) AS v FROM (
      SELECT p, e, j, (s - ((s % n) + n) % n) // n AS c FROM (
        SELECT p, e, j, sum(v[j])::BIGINT AS s, count(*) AS n FROM a{i} JOIN x USING (r, p), (SELECT unnest(range(1, w + 1)) AS j FROM size) GROUP BY ALL))
      GROUP BY p, e),
b{i + 1} AS (SELECT p, e, coalesce(s{i}.v, b{i}.v) AS v FROM b{i} LEFT JOIN s{i} USING (p, e))""")
    return f"""
WITH k AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda v: floor(4096 * v::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
size AS (SELECT max(len(v)) // {parts} AS w FROM k),
x AS (SELECT r, vec_id, label, p, v[p * w + 1:(p + 1) * w] AS v FROM k, size, (SELECT unnest(range({parts})) AS p)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM x QUALIFY e < {entries}),
{", ".join(steps)},
sha AS (SELECT sha256(string_agg(c, ',' ORDER BY p, e, j)) AS codebooks_sha256
        FROM (SELECT p, e, unnest(v)::VARCHAR AS c, generate_subscripts(v, 1) AS j FROM b{rounds})),
o AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
      FROM a{rounds} JOIN k USING (r) GROUP BY r, vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM o, sha
"""


ORACLES = {
    "op1_decontaminate": _DECONTAMINATE,
    "op2_jaccard_join": _JACCARD,
    "op5_quality_rules": _QUALITY,
    "op7_warc_zip": _WARC,
    "op10_url_lists": _URLS,
    "op11_lexical_search": _SEARCH,
    "op13_vector_codes": _vector_codes(),
}
