"""DuckDB statements for the queries that SQL can express, written from the contracts, not from the operators."""

from sellerlens.llm.license_scan import TEMPLATES  # data only

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = f"translate(coalesce(text, ''), '{UP}', '{LOW}')"

# All pairs that share a shingle, then closure by recursion.
OP2 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(m.m, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) m USING (doc_id)
"""

_ALNUM = "'[0-9a-z\\x{80}-\\x{10FFFF}]+'"
OP4 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLD}, {_ALNUM}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLD}, {_ALNUM}) AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(list_slice(w, p, p + least(13, len(w)) - 1), ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)
),
spot AS (
  SELECT doc_id, size, p, array_to_string(list_slice(w, p, p + size - 1), ' ') AS s
  FROM (SELECT d.*, z.size, unnest(range(1, len(w) - z.size + 2)) AS p
        FROM d, (SELECT DISTINCT size FROM win) z WHERE len(w) >= z.size)
),
met AS (SELECT spot.doc_id, spot.p, spot.size, win.item_id FROM spot JOIN win USING (size, s)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM met) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM met) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
  sha256(coalesce(it.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

# Equal lines of an earlier place, grouped into diagonals: a diagonal's stretch is a run with an earlier copy.
OP5 = """
WITH l AS (
  SELECT doc_id, unnest(range(len(ls))) AS p, unnest(ls) AS s
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)
),
lw AS (SELECT *, len(regexp_extract_all(s, '[^\\x20\\x09-\\x0D]+')) AS w FROM l),
m AS (
  SELECT a.doc_id, a.p, a.w, b.doc_id AS d2, a.p - b.p AS diag
  FROM lw a JOIN lw b ON a.s = b.s AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.p < a.p))
),
stretch AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id, d2, diag ORDER BY p) AS g FROM m),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS p
  FROM (SELECT doc_id, min(p) AS lo, max(p) AS hi FROM stretch GROUP BY doc_id, d2, diag, g HAVING sum(w) >= 51)
),
runs AS (
  SELECT doc_id, sum(n)::BIGINT AS n, string_agg(lo || ':' || (hi + 1), ',' ORDER BY lo) AS runs
  FROM (SELECT doc_id, min(p) AS lo, max(p) AS hi, count(*) AS n
        FROM (SELECT *, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS g FROM gone) GROUP BY doc_id, g)
  GROUP BY doc_id
),
kept AS (
  SELECT l.doc_id, string_agg(l.s, chr(10) ORDER BY l.p) AS t, count(*) AS n
  FROM l ANTI JOIN gone ON l.doc_id = gone.doc_id AND l.p = gone.p GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(runs.n, 0)::BIGINT AS n_deleted_lines,
  CASE WHEN coalesce(kept.t, '') = '' THEN 0 ELSE kept.n END::BIGINT AS n_kept_lines,
  coalesce(runs.runs, '') AS deleted_runs, sha256(coalesce(kept.t, '')) AS text_sha256
FROM documents d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _escaped(x: str) -> str:
    out = f"replace({x}, '\\', '\\\\')"
    for c in ("<s>", "</s>", "[INST]", "[/INST]", "<|text|>"):
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


OP9 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_escaped('role')}) + length({_escaped('text')}) + 15 + CASE WHEN role = 'user' THEN 13 ELSE 0 END)::BIGINT AS formatted_chars,
  false AS rewrites_history
FROM c GROUP BY conv_id
"""

# Key phrases by plain comparison at every position; the rarest words of the notice are sought near their place.
_NOTICE_ROWS = ", ".join(f"({i}, '{t.label}', '{t.notice}', '{t.key}', {int(t.base)})" for i, t in enumerate(TEMPLATES))
OP3 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLD}, {_ALNUM}) AS w FROM documents),
t AS (
  SELECT i, label, base, string_split(notice, ' ') AS nw, string_split(key, ' ') AS kw,
    len(string_split(split_part(' ' || notice || ' ', ' ' || key || ' ', 1), ' ')) - 1 AS shift
  FROM (VALUES {_NOTICE_ROWS}) v(i, label, notice, key, base)
),
vocab AS (SELECT DISTINCT unnest(list_concat(nw, kw)) AS x FROM t),
df AS (SELECT x, count(*) AS n FROM (SELECT unnest(list_distinct(w)) AS x FROM d) JOIN vocab USING (x) GROUP BY x),
idf AS (SELECT x, ln(((SELECT count(*) FROM d) + 1.0) / (coalesce(df.n, 0) + 1.0)) + 1e-9 AS v FROM vocab LEFT JOIN df USING (x)),
laid AS (
  SELECT i, k - shift AS k, x, v, row_number() OVER (PARTITION BY i ORDER BY n, k) AS r,
    k >= shift AND k < shift + n_key AND row_number() OVER (PARTITION BY i, k >= shift AND k < shift + n_key ORDER BY n, k) <= 2 AS of_key
  FROM (SELECT i, shift, len(kw) AS n_key, unnest(range(len(nw))) AS k, unnest(nw) AS x FROM t)
  JOIN (SELECT x, v, coalesce(df.n, 0) AS n FROM idf LEFT JOIN df USING (x)) USING (x)
),
posted AS (SELECT i, k, x, v FROM laid WHERE r <= 12 OR of_key),
spot AS (SELECT doc_id, w, unnest(range(len(w))) AS p FROM d),
place AS (
  SELECT o.doc_id, o.w, o.p, t.* FROM spot o JOIN t ON o.w[o.p + 1] = t.kw[1] WHERE list_slice(o.w, o.p + 1, o.p + len(t.kw)) = t.kw
),
scored AS (
  SELECT doc_id, p, i, least(1.0, sum(CASE WHEN p + k + 8 >= 0 AND list_contains(list_slice(w, greatest(p + k - 8, 0) + 1, p + k + 9), x)
    THEN v ELSE 0 END) / sum(v)) AS s
  FROM place JOIN posted USING (i) GROUP BY doc_id, p, i
),
doc AS (
  SELECT doc_id, count(*) FILTER (base = 1) AS n_base, min(p) FILTER (base = 1) AS first_word, max(p) FILTER (base = 1) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base = 1) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM place GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(coalesce((SELECT max(s) FROM scored WHERE scored.doc_id = d.doc_id), 0)::DOUBLE, 6) AS score
FROM d LEFT JOIN doc USING (doc_id)
"""

# Rules by comparing every url with every rule; aliases by recursive closure over redirect, canonical and refresh edges.
_RULES = "('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')"


def _host(url):
    return f"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{UP}', '{LOW}')"


def _path(url):
    return f"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


def _redirect(url):
    bare = f"CASE WHEN regexp_matches({_host(url)}, '^(www|m)[.][^.]+[.]') THEN regexp_replace({_host(url)}, '^(www|m)[.]', '') ELSE {_host(url)} END"
    path = f"regexp_replace(regexp_replace(regexp_replace({_path(url)}, '/index[.]html?$', '/'), '[.]html?$', ''), '/+$', '')"
    kept = (f"list_filter(string_split(regexp_extract({url}, '^[^?#]*[?]([^#]*)', 1), '&'), lambda p: p <> '' AND "
            "NOT regexp_matches(p, '^(utm_[a-z]+|ref|gclid|fbclid|mc_eid|igshid)(=|$)'))")
    return f"'https://' || ({bare}) || ({path}) || CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END"


def _value(tag, name):
    at = f"(?is)\\b{name}\\s*=\\s*"
    first = " WHEN ".join(f"regexp_extract({tag}, '{at}{q}([^{q}]*){q}', 1) <> '' THEN regexp_extract({tag}, '{at}{q}([^{q}]*){q}', 1)" for q in ('"', "''"))
    return f"replace(trim(CASE WHEN {first} ELSE regexp_extract({tag}, '{at}([^\\s\"''>]+)', 1) END), '&amp;', '&')"


OP8 = f"""
WITH RECURSIVE p AS (SELECT page_id, url, html FROM pages),
tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*>')) AS tag, true AS canonical FROM p
  UNION ALL
  SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b[^>]*>')), false FROM p
),
aim AS (
  SELECT url, CASE WHEN canonical THEN {_value('tag', 'href')}
    ELSE regexp_extract({_value('tag', 'content')}, '(?is)url\\s*=\\s*["'']?([^"'']*)', 1) END AS t
  FROM tags WHERE contains(url, '://')
),
declared AS (
  SELECT url AS a, CASE
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN starts_with(t, '//') THEN regexp_extract(url, '^([^:/?#]+)://', 1) || ':' || t
    WHEN starts_with(t, '/') THEN regexp_extract(url, '^([^:/?#]+)://', 1) || '://' || {_host('url')} || t
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:|^#') THEN NULL
    ELSE regexp_extract(url, '^([^:/?#]+)://', 1) || '://' || {_host('url')} || regexp_replace({_path('url')}, '[^/]*$', '')
      || CASE WHEN {_path('url')} = '' THEN '/' ELSE '' END || t END AS b
  FROM aim WHERE t <> ''
),
edge AS (
  SELECT DISTINCT a, b FROM (
    SELECT url AS a, {_redirect('url')} AS b FROM p WHERE contains(url, '://')
    UNION ALL SELECT a, b FROM declared WHERE contains(b, '://')
    UNION ALL SELECT b, {_redirect('b')} FROM declared WHERE contains(b, '://')
  ) WHERE a <> b
),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b),
u AS (SELECT url FROM p WHERE url IS NOT NULL UNION SELECT a FROM both_ways),
fit AS (
  SELECT url, rh || rp AS rule, rv, row_number() OVER (PARTITION BY url ORDER BY length(rh || rp) DESC, length(rh) DESC, rv) AS r
  FROM (SELECT url, {_host('url')} AS host, {_path('url')} AS path FROM u)
  JOIN (VALUES {_RULES}) v(rh, rp, rv) ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
),
judged AS (SELECT url, rule, rv FROM fit WHERE r = 1),
said AS (SELECT reach.a AS url, bool_or(rv = 'allow') AS allows, bool_or(rv = 'block') AS blocks FROM reach JOIN judged ON judged.url = reach.b GROUP BY reach.a)
SELECT page_id, coalesce({_host('p.url')}, '') AS host, coalesce({_path('p.url')}, '') AS path, rule,
  coalesce(rv, CASE WHEN allows THEN 'allow' WHEN blocks THEN 'block' END, 'allow') AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN allows OR blocks THEN 'alias' ELSE 'default' END AS decided_by
FROM p LEFT JOIN judged USING (url) LEFT JOIN said USING (url)
"""

# Every term of every document scored for every item that holds it, in 64-bit integers.
OP11 = f"""
WITH d AS (
  SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, regexp_extract_all({_FOLD}, {_ALNUM}) AS w FROM documents) WHERE len(w) > 0
),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d),
q AS (
  SELECT item_id, t, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({_FOLD}, {_ALNUM})) AS t FROM benchmark) GROUP BY item_id, t
),
tf AS (
  SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM q) GROUP BY doc_id, n, t
),
wt AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), c),
part AS (
  SELECT tf.doc_id, tf.t, wt.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * tf.n * c.docs) // c.terms))) AS s
  FROM tf JOIN wt USING (t), c
),
total AS (SELECT item_id, doc_id, sum(times * s)::BIGINT AS score FROM part JOIN q USING (t) GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM total WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

ORACLES = {
    "op11_ranked_search": OP11,
    "op3_license_scan": OP3,
    "op2_jaccard_join": OP2,
    "op4_decontaminate": OP4,
    "op5_line_dedup": OP5,
    "op8_url_filters": OP8,
    "op9_chat_format": OP9,
}
