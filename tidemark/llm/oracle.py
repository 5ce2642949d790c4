"""The queries that SQL can express, for DuckDB over views named like the tables."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"

OP5 = rf"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) AS h
  FROM documents
), g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS n FROM t GROUP BY h)
SELECT t.doc_id, g.keep_id, g.n AS group_size, t.doc_id = g.keep_id AS kept, t.h AS text_sha256
FROM t JOIN g USING (h)
"""



def _op7_level(level: int) -> str:
    """A level of templates: constants of most lines of a group, who fits, and where the rest go."""
    return f"""
c{level} AS (
  SELECT grp, pos, token, count(*) AS n, sum(count(*)) OVER (PARTITION BY grp, pos) AS every,
         count(*) OVER (PARTITION BY grp, pos) AS kinds
  FROM (SELECT grp, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM g{level})
  GROUP BY grp, pos, token
),
split{level} AS (
  SELECT grp, arg_min(pos, (kinds, pos)) AS pos FROM c{level} WHERE kinds > 1 GROUP BY grp
),
m{level} AS (
  SELECT g.line, g.grp, g.tokens, coalesce(h.hits, 0) >= 0.6 * len(g.tokens) AS fits,
         g.tokens[s.pos] AS next
  FROM g{level} g LEFT JOIN split{level} s USING (grp) LEFT JOIN (
    SELECT line, count(*) AS hits
    FROM (SELECT line, grp, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM g{level}) t
    JOIN c{level} c USING (grp, pos, token) WHERE 2 * c.n > c.every AND token <> '<*>' GROUP BY line
  ) h USING (line)
),
g{level + 1} AS (
  SELECT line, concat(grp, '/{level}:', coalesce(next, '')) AS grp, tokens FROM m{level} WHERE NOT fits
),"""


OP7 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT text, line, list_filter(string_split_regex(line, '{_SPACE}'), lambda x: x <> '') AS words
  FROM (SELECT DISTINCT text, unnest(string_split(text, chr(10))) AS line FROM d)
),
lines AS (
  SELECT text, line, list_transform(words,
    lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS tokens
  FROM found WHERE len(words) >= 4
),
g0 AS (SELECT DISTINCT line, concat(len(tokens)::VARCHAR, ' ', tokens[1:3]::VARCHAR) AS grp, tokens FROM lines),
{_op7_level(0)}{_op7_level(1)}{_op7_level(2)}
tpl AS (
  SELECT line, concat('0 ', grp) AS t FROM m0 WHERE fits UNION ALL
  SELECT line, concat('1 ', grp) FROM m1 WHERE fits UNION ALL
  SELECT line, concat('2 ', grp) FROM m2 WHERE fits
),
rec AS (SELECT t FROM lines JOIN tpl USING (line) GROUP BY t HAVING count(DISTINCT text) >= 5),
gone AS (
  SELECT line FROM tpl JOIN rec USING (t)
  UNION SELECT line FROM lines GROUP BY line HAVING count(*) >= 2
),
every AS (
  SELECT row_number() OVER () AS r, doc_id, text FROM d
),
cut AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS no FROM every
)
SELECT e.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE g.line IS NOT NULL) AS n_dropped,
       coalesce(string_agg(e.line, chr(10) ORDER BY no) FILTER (WHERE g.line IS NULL), '') AS text
FROM cut e LEFT JOIN gone g USING (line) GROUP BY e.r, e.doc_id
"""

# Written from the operator's description, not from its constants.
OP11 = r"""
WITH RECURSIVE rules(rule_host, rule_path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
found AS (
  SELECT url AS src, unnest(list_concat(
    regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*\burl\s*=\s*["'']?([^"''\s>]+)', 1)
  )) AS dst FROM pages
),
absolute AS (SELECT DISTINCT src, dst FROM found WHERE src IS NOT NULL AND dst LIKE '%://%'),
urls AS (SELECT url FROM pages UNION SELECT src FROM absolute UNION SELECT dst FROM absolute),
placed AS (
  SELECT url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: NOT regexp_matches(p, '^((utm_[a-z]+|ref|fbclid|gclid)=.*)?$')) AS kept
  FROM urls
),
judged AS (
  SELECT p.*, CASE WHEN url LIKE '%://%' THEN
      regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(/|\.html?|/index\.html?)$', '')
      || '?' || array_to_string(list_sort(kept), '&') ELSE '#' || url END AS page,
    r.rule_host || r.rule_path AS rule, r.verdict
  FROM placed p LEFT JOIN rules r
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1
),
edges AS (
  SELECT a.page AS x, b.page AS y FROM absolute JOIN judged a ON a.url = src JOIN judged b ON b.url = dst
),
twoway AS (SELECT x, y FROM edges UNION SELECT y, x FROM edges),
reach(page, other) AS (
  SELECT DISTINCT page, page FROM judged WHERE page IS NOT NULL
  UNION SELECT r.page, b.y FROM reach r JOIN twoway b ON b.x = r.other
),
class AS (SELECT page, min(other) AS label FROM reach GROUP BY page),
bad AS (
  SELECT label FROM judged JOIN class USING (page) GROUP BY label
  HAVING bool_or(verdict = 'block') AND NOT coalesce(bool_or(verdict = 'allow'), false)
),
aliased AS (SELECT page FROM class WHERE label IN (SELECT label FROM bad))
SELECT p.page_id, j.host, j.path, j.rule,
  coalesce(j.verdict, CASE WHEN a.page IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  CASE WHEN j.rule IS NOT NULL THEN 'rule' WHEN a.page IS NOT NULL THEN 'alias' ELSE 'default' END AS decided_by
FROM pages p JOIN judged j ON p.url IS NOT DISTINCT FROM j.url LEFT JOIN aliased a ON a.page = j.page
"""

_LEAF = """sha256(concat(
    coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id::VARCHAR, '-'),
    coalesce(octet_length(encode(source)) || ':' || source, '-'),
    coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
    coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars::VARCHAR, '-'),
    coalesce(octet_length(encode({text})) || ':' || {text}, '-')))"""

_CRC32 = """xor(4294967295::UBIGINT, list_reduce(
    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
    lambda crc, c: list_reduce(range(8)::UBIGINT[], lambda x, i:
      CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END, xor(crc, c)),
    4294967295::UBIGINT))"""

_RUN = "PARTITION BY {by}, lvl, rn // 3 ORDER BY rn ROWS BETWEEN {rows}"


def _beside(by: str) -> str:
    before = _RUN.format(by=by, rows="UNBOUNDED PRECEDING AND 1 PRECEDING")
    after = _RUN.format(by=by, rows="1 FOLLOWING AND UNBOUNDED FOLLOWING")
    return (
        f"coalesce(string_agg(h, '') OVER ({before}), '') AS b,"
        f" coalesce(string_agg(h, '') OVER ({after}), '') AS a"
    )


OP12 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_LEAF.format(text="text")} AS leaf,
    CASE WHEN {_CRC32} % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")} END AS other
  FROM documents
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rn,
    count(*) OVER (PARTITION BY source) AS n FROM leaves
),
up(source, lvl, rn, n, h) AS (
  SELECT source, 0, rn, n, leaf FROM ranked
  UNION ALL
  SELECT source, lvl + 1, rn // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY rn))
  FROM up WHERE n > 1 GROUP BY source, lvl, rn // 3, n
),
nodes AS (SELECT *, {_beside("source")} FROM up WHERE n > 1),
subroots AS (
  SELECT source, h, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS rn,
    count(*) OVER () AS n
  FROM up WHERE n = 1
),
top(lvl, rn, n, h) AS (
  SELECT 0, rn, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, rn // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY rn))
  FROM top WHERE n > 1 GROUP BY lvl, rn // 3, n
),
upper AS (SELECT *, {_beside("n")} FROM top WHERE n > 1),
upper_path AS (
  SELECT s.source, coalesce(list({{'b': u.b, 'h': '', 'a': u.a}} ORDER BY u.lvl) FILTER (WHERE u.lvl IS NOT NULL), []) AS path
  FROM subroots s LEFT JOIN upper u ON u.rn = s.rn // (3 ** u.lvl)::BIGINT GROUP BY s.source
),
lower_path AS (
  SELECT r.source, r.rn, coalesce(list({{'b': n.b, 'h': '', 'a': n.a}} ORDER BY n.lvl) FILTER (WHERE n.lvl IS NOT NULL), []) AS path
  FROM ranked r LEFT JOIN nodes n ON n.source IS NOT DISTINCT FROM r.source AND n.rn = r.rn // (3 ** n.lvl)::BIGINT
  GROUP BY r.source, r.rn
),
proofs AS (
  SELECT r.doc_id, r.leaf, coalesce(r.other, r.leaf) AS shown, s.h AS subroot,
    (SELECT h FROM top WHERE n = 1) AS root, list_concat(l.path, u.path) AS path
  FROM ranked r
  JOIN lower_path l ON l.rn = r.rn AND l.source IS NOT DISTINCT FROM r.source
  JOIN upper_path u ON u.source IS NOT DISTINCT FROM r.source
  JOIN subroots s ON s.source IS NOT DISTINCT FROM r.source
),
folds AS (
  SELECT doc_id, leaf, subroot, root,
    sha256(array_to_string(list_transform(path, lambda p: p.b || p.a), '')) AS proof_sha256,
    list_reduce(path, lambda x, p: {{'b': '', 'h': sha256(p.b || x.h || p.a), 'a': ''}},
      {{'b': '', 'h': shown, 'a': ''}}).h AS folded_root
  FROM proofs
)
SELECT *, folded_root = root AS verified FROM folds
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
),
totals AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS w
  FROM pieces, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k
),
f AS (SELECT lang, k, w, count(*)::HUGEINT AS c FROM grams GROUP BY ALL HAVING count(*) >= 100),
inner_of AS (
  SELECT lang, w[1:k - 1] AS w, c FROM f WHERE k > 2 UNION ALL SELECT lang, w[2:k], c FROM f WHERE k > 2
),
longest AS (SELECT lang, w, max(c) AS c FROM inner_of GROUP BY ALL),
own AS (
  SELECT f.* FROM f LEFT JOIN longest g ON g.lang = f.lang AND g.w = f.w
  WHERE f.k > 1 AND (g.c IS NULL OR g.c < f.c)
),
cuts AS (
  SELECT o.lang, o.w, o.c AS a, cut, l.c AS l, r.c AS r, t.n, (1000 * o.c * t.n) // (l.c * r.c) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM own) o
  JOIN f l ON l.lang = o.lang AND l.w = o.w[1:cut]
  JOIN f r ON r.lang = o.lang AND r.w = o.w[cut + 1:o.k]
  JOIN totals t ON t.lang = o.lang
),
best AS (
  SELECT *, array_to_string(w, ' ') AS phrase FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
  phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op5_exact_dedup": OP5,
    "op7_line_templates": OP7,
    "op11_url_filter": OP11,
    "op12_merkle_manifest": OP12,
    "op13_collocations": OP13,
}
