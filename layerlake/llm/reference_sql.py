"""DuckDB SQL for the rows of the operators' queries."""

from __future__ import annotations

from .licenses import LEAST, TEMPLATES
from .quality_rules import RULES, STOP_WORDS

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = r"list_filter(regexp_split_to_array({}, '[ \t\n\x0b\f\r]+'), lambda x: x <> '')"


def _names(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


def _rule(rule) -> str:
    tests = [f"({rule.measure}) < {rule.low}"] if rule.low is not None else []
    tests += [f"({rule.measure}) > {rule.high}"] if rule.high is not None else []
    return "coalesce(" + " OR ".join(tests) + ", false)"


QUALITY = f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {WORDS.format('text')} AS words,
             list_filter(string_split(text, chr(10)), lambda x: trim(x, {WS}) <> '') AS lines FROM t),
win AS (SELECT r, i, array_to_string(words[i : i + 7], ' ') AS h
        FROM w, unnest(range(1, greatest(len(words) - 6, 1))) AS u(i)),
rep AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, h) > 1),
cov AS (SELECT r, count(DISTINCT i + j) AS n FROM rep, range(8) AS k(j) GROUP BY r),
m AS (SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
             len(list_filter(words, lambda x: lower(x) IN ({_names(STOP_WORDS)}))) AS n_stop_words
      FROM w LEFT JOIN cov USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {" OR ".join(_rule(r) for r in RULES if r.base)} AS base_failed,
       NOT ({" OR ".join(_rule(r) for r in RULES)}) AS kept
FROM m"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
d AS (SELECT vec_id, i, v[i] AS x FROM v, unnest(range(1, len(v) + 1)) AS u(i)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
      FROM d AS q JOIN d AS c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10"""

REPEATS = f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, {WORDS.format("coalesce(text, '')")} AS words FROM documents),
win AS (SELECT r, i, md5(array_to_string(words[i : i + 34], ' ')) AS h
        FROM w, unnest(range(1, greatest(len(words) - 33, 1))) AS u(i)),
rep AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY h) > 1),
gone AS (SELECT r, list(DISTINCT i + j) AS gone_at FROM rep, range(35) AS k(j) GROUP BY r),
kept AS (SELECT doc_id, words, list_distinct(coalesce(gone_at, [])) AS ga FROM w LEFT JOIN gone USING (r))
SELECT doc_id, len(words) AS n_words, len(ga) AS n_removed,
       sha256(array_to_string(CASE WHEN len(ga) = 0 THEN words ELSE
           list_filter(list_transform(words, lambda x, i: CASE WHEN list_contains(ga, i) THEN NULL ELSE x END), lambda x: x IS NOT NULL) END,
           ' ')) AS kept_sha256
FROM kept"""

REVISITS = rf"""
WITH p AS (SELECT page_id, url, length(html) AS n, md5(html) AS d, 'u' AS of FROM pages),
a AS (SELECT * FROM p UNION ALL
      SELECT page_id, 'http://www.hot.example.org/news/?b=2&a=1', n, d, 'h' FROM p WHERE page_id % 3 = 0),
c AS (SELECT page_id, n, of, k, md5(concat_ws(':', d, of, k // 2)) AS state, 7 * page_id + 10000 * k AS ts,
             regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://(www\.)?', ''), '/+$', '') AS bare,
             list_sort(list_filter(string_split(regexp_extract(regexp_replace(url, '#.*$', ''), '\?(.*)$', 1), '&'),
                                   lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref)='))) AS q
      FROM a, (VALUES (0), (1), (2)) AS ks(k)),
u AS (SELECT *, bare || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS u FROM c),
resp AS (SELECT u, ts, 'p' || page_id || of || k AS id, n, CASE WHEN n % 4 <> 1 THEN '"' || state || '"' END AS tag,
                CASE WHEN n % 3 <> 2 THEN 'at ' || state END AS modified, CASE WHEN page_id % 7 <> 3 THEN state END AS digest
         FROM u WHERE (page_id + k) % 11 <> 0),
rev AS (SELECT u, ts + 600 AS ts, 'r' || page_id || of || k AS id, page_id,
               CASE (n + k) % 5 WHEN 0 THEN NULL WHEN 1 THEN 'W/"' || state || '"' WHEN 2 THEN '"old"' ELSE '"' || state || '"' END AS tag,
               CASE (n + k) % 3 WHEN 0 THEN 'at ' || state WHEN 1 THEN 'at first' END AS modified,
               CASE (page_id + k) % 4 WHEN 0 THEN state WHEN 1 THEN 'other' END AS digest FROM u),
m AS (SELECT rev.*, resp.id AS rid, resp.n, resp.tag AS rtag, resp.modified AS rmodified, resp.digest AS rdigest
      FROM rev LEFT JOIN resp ON rev.u = resp.u AND resp.ts < rev.ts
      QUALIFY row_number() OVER (PARTITION BY rev.id ORDER BY resp.ts DESC NULLS LAST, resp.id DESC) = 1),
v AS (SELECT *, coalesce(regexp_replace(tag, '^W/', '') = rtag, modified = rmodified) AS by_validator, digest = rdigest AS by_digest FROM m),
o AS (SELECT *, CASE WHEN rid IS NULL THEN 'no_response' WHEN by_validator IS NULL AND by_digest IS NULL THEN 'unvalidated'
                     WHEN coalesce(by_validator, true) AND coalesce(by_digest, true) THEN 'resolved' ELSE 'mismatch' END AS outcome FROM v),
t AS (SELECT *, outcome IN ('resolved', 'unvalidated') AS taken FROM o),
h AS (SELECT *, CASE WHEN taken THEN coalesce(tag, rtag) ELSE tag END AS etag,
             CASE WHEN taken THEN coalesce(modified, rmodified) ELSE modified END AS last FROM t)
SELECT id AS record_id, u AS canonical_url, outcome, rid AS refers_to,
       CASE WHEN taken THEN coalesce(rdigest, digest) END AS digest,
       'cache-control=max-age=' || page_id || CASE WHEN taken THEN ';content-length=' || n || ';content-type=text/html' ELSE ';content-length=0' END
       || coalesce(';etag=' || etag, '') || coalesce(';last-modified=' || last, '') AS headers, 1700000000 + ts AS "at"
FROM h"""

_TERMS = r"list_filter(regexp_split_to_array(regexp_replace({} || ' ', '[+.-]+([^a-z0-9+.-])', '\1', 'g'), '[^a-z0-9+.-]+'), lambda x: x <> '')"
_MODELS = ", ".join(f"({i}, {_names([name, text])})" for i, (name, text) in enumerate(TEMPLATES))

LICENSES = f"""
WITH f AS (SELECT doc_id, row_number() OVER () AS r, source || '/o' || (doc_id // 64)
                  || CASE WHEN doc_id % 64 = 0 THEN '' ELSE '/i' || (doc_id // 8) END AS folder,
                  CASE WHEN doc_id % 8 = 0 THEN 'LICENSE' ELSE 'f' || doc_id || '.txt' END AS name,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: NOT regexp_full_match(x, '[ \\t\\r]*')) AS lines
           FROM documents),
st AS (SELECT r, lines, i FROM f, unnest(range(1, len(lines) + 1)) AS u(i)
       WHERE regexp_matches(lines[i], '(licen[cs]|copyright|copyleft|permission|redistribut|warrant|spdx|creative commons|public domain)', 'i')),
ps AS (SELECT DISTINCT r, array_to_string(lines[i : i + n - 1], chr(10)) AS notice FROM st, (VALUES (1), (2), (4), (8), (16), (32)) AS s(n)),
nt AS (SELECT DISTINCT notice FROM ps),
words AS (SELECT notice, term, count(*) AS tf FROM (SELECT notice, unnest({_TERMS.format('lower(notice)')}) AS term FROM nt) GROUP BY ALL),
n AS (SELECT count(*) AS n FROM nt),
df AS (SELECT term, ln((1.0 + any_value(n.n)) / (1.0 + count(*))) + 1 AS idf FROM words, n GROUP BY term),
models(model, license, text) AS (VALUES {_MODELS}),
mw AS (SELECT model, license, term, count(*) AS tf
       FROM (SELECT model, license, unnest({_TERMS.format('lower(text)')}) AS term FROM models) GROUP BY ALL),
mv AS (SELECT model, license, term, tf * coalesce(idf, ln(1.0 + n.n) + 1) AS w FROM mw LEFT JOIN df USING (term), n),
mn AS (SELECT model, license, term, w / sqrt(sum(w * w) OVER (PARTITION BY model)) AS m FROM mv),
v AS (SELECT notice, term, tf * idf AS w FROM words JOIN df USING (term)),
len AS (SELECT notice, sqrt(sum(w * w)) AS size FROM v GROUP BY notice),
cos AS (SELECT notice, license, model, round(sum(w * m) / any_value(size), 6) AS cosine
        FROM v JOIN mn USING (term) JOIN len USING (notice) GROUP BY ALL),
best AS (SELECT notice, license AS own_license, cosine AS own_cosine FROM cos WHERE cosine >= {LEAST}),
first AS (SELECT r, CASE WHEN own_license = 'BSD-2-Clause'
                          AND regexp_matches(array_to_string(lines, chr(10)), 'neither\\s+the\\s+names?\\s+of', 'i') THEN 'BSD-3-Clause'
                          ELSE own_license END AS own_license, own_cosine FROM ps JOIN f USING (r) JOIN best USING (notice)
          QUALIFY row_number() OVER (PARTITION BY r ORDER BY own_cosine DESC, best.own_license) = 1),
own AS (SELECT f.doc_id, f.r, folder || '/' || name AS path, folder, name, own_license, own_cosine FROM f LEFT JOIN first USING (r)),
held AS (SELECT folder AS above, own_license AS given FROM own WHERE name = 'LICENSE' AND own_license IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY folder ORDER BY own_cosine DESC, own_license) = 1),
near AS (SELECT own.*, above, given FROM own LEFT JOIN held ON folder = above OR starts_with(folder, above || '/')
         QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(above) DESC NULLS LAST) = 1)
SELECT doc_id, path, own_license, own_cosine, coalesce(own_license, given) AS license,
       CASE WHEN own_license IS NOT NULL THEN 'own' WHEN given IS NOT NULL THEN 'inherited' ELSE 'none' END AS via,
       CASE WHEN own_license IS NULL THEN above END AS from_folder
FROM near"""


ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all({ASCII_LOWER.format('text')}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
n AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
each AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n
         FROM g JOIN kept USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
p AS (SELECT *, 1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER w + 5 * count(*) OVER w) AS p FROM each
      WINDOW w AS (PARTITION BY lang, source)),
whole AS (SELECT lang, term, sum(n) AS n FROM each GROUP BY ALL),
q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER w + 5 * count(*) OVER w) AS q FROM whole
      WINDOW w AS (PARTITION BY lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
      FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
out AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value
        FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
             LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM out QUALIFY part = 'pair' OR rank <= 50"""

URL_RULES = f"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT row_number() OVER () AS r, page_id, {ASCII_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
b AS (SELECT r, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
      FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN b USING (r)"""

FILL_MIDDLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h FROM documents),
t AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units FROM d),
r AS (SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
x AS (SELECT *, array_to_string(units[:a], '') AS p, array_to_string(units[a + 1 : b], '') AS m,
             array_to_string(units[b + 1 :], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM x"""
