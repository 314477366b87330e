"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from sparkdesk.llm.host_reputation import LEAST_RHO, MOST_RHO, RULES, TWO_LABEL_SUFFIXES
from sparkdesk.llm.quality_rules import CLASSES, COMMON_WORDS, LIMITS

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x20\x09-\x0D]+"


def _distance(names: list[str], total: str) -> str:
    """Jensen-Shannon distance of the columns d.x / total to r.x / r.total over ``names``."""
    parts = []
    for n in names:
        p, q = f"(d.{n} / (d.{total}::DOUBLE))", f"(r.{n} / (r.{total}::DOUBLE))"
        m = f"(({p} + {q}) / 2)"
        parts += [f"CASE WHEN {x} > 0 THEN {x} * log2({x} / {m}) ELSE 0 END" for x in (p, q)]
    return f"CASE WHEN d.{total} > 0 THEN sqrt(greatest(({' + '.join(parts)}) / 2, 0)) END"


def _wordless(names: list[str]) -> str:
    """The distance from r's word histogram to that of a text without any common word."""
    q = f"(r.{names[-1]} / r.wt::DOUBLE)"
    return (f"sqrt(greatest((CASE WHEN {q} > 0 THEN {q} * log2({q} / (({q} + 1) / 2)) ELSE 0 END"
            f" + log2(1 / (({q} + 1) / 2)) + (1 - {q})) / 2, 0))")


def quality_rules() -> str:
    most_class, most_share = LIMITS["max_class_distance"], LIMITS["max_word_share"]
    listed = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    langs = ", ".join(f"'{x}'" for x in sorted(COMMON_WORDS))
    taken, classes = "", []
    for i, cls in enumerate(CLASSES.values()):
        classes.append(f"len(regexp_replace(text, '[{taken}]+', '', 'g')) - len(regexp_replace(text, '[{taken}{cls}]+', '', 'g')) AS c{i}"
                       if taken else f"len(text) - len(regexp_replace(text, '[{cls}]+', '', 'g')) AS c{i}")
        taken += cls
    classes.append(f"len(regexp_replace(text, '[{taken}]+', '', 'g')) AS c{len(CLASSES)}")
    words = [f"len(list_filter(lw, lambda x: x = '{w}')) AS w{i}" for i, w in enumerate(listed)]
    words.append("len(ws) - (" + " + ".join(f"w{i}" for i in range(len(listed))) + f") AS w{len(listed)}")
    cs, wn = [f"c{i}" for i in range(len(CLASSES) + 1)], [f"w{i}" for i in range(len(listed) + 1)]
    sums = ", ".join(f"sum({c}) AS {c}" for c in [*cs, *wn])
    return rf"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '{_WORDS}') AS ws FROM t),
low AS (SELECT *, list_transform(ws, lambda x: lower(x)) AS lw FROM split),
counted AS (SELECT doc_id, lang, len(ws) AS n_words, list_sum(list_transform(ws, lambda x: len(x))) AS wc,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS lines, ws,
    {', '.join(classes)}, {', '.join(words)} FROM low),
d AS (SELECT *, {' + '.join(cs)} AS ct, {' + '.join(wn)} AS wt FROM counted),
r AS (SELECT *, {' + '.join(cs)} AS ct, {' + '.join(wn)} AS wt FROM
    (SELECT lang, {sums} FROM counted WHERE lang IN ({langs}) GROUP BY lang)),
far AS (SELECT d.doc_id, coalesce(d.lang, '') IN (SELECT lang FROM r) AS listed, coalesce(d.lang = r.lang, false) AS own,
    {_distance(cs, 'ct')} AS cd, {_distance(wn, 'wt')} / nullif({_wordless(wn)}, 0) AS ws FROM d, r),
dist AS (SELECT doc_id, min(cd) AS cd, min(ws) AS ws FROM far WHERE own OR NOT listed GROUP BY doc_id),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM split WHERE len(ws) >= 3)),
rep AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
f AS (SELECT d.doc_id, n_words::BIGINT AS n_words, coalesce(wc, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT b.*, NOT base_failed AND NOT (n_words >= 100 AND (coalesce(cd > {most_class}, false) OR coalesce(ws > {most_share}, false))) AS kept
FROM b LEFT JOIN dist USING (doc_id)
"""


BENCHMARK_DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, least(13, len(ws)) AS k, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS g
    FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM w),
dw AS (SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g
    FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks WHERE len(ws) >= k)),
h AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN w USING (k, g)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""


LINE_DEDUP = r"""
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, i, len(ls) AS n, ('0x' || substr(md5(ls[i]), 1, 8))::BIGINT AS x
    FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l)),
h AS (SELECT *, x + 31 * coalesce(lag(x) OVER (PARTITION BY doc_id ORDER BY i), 0) AS r FROM x),
e AS (SELECT doc_id, s, i FROM h, (SELECT unnest(range(0, 8)) AS s) WHERE i = 1 OR i = n OR (r >> s) % 2 = 0),
c AS (SELECT DISTINCT doc_id, a, b, lo, hi FROM (SELECT doc_id, i AS b, lag(i) OVER w AS a,
        coalesce(lag(i, 2) OVER w, lag(i) OVER w) AS lo, coalesce(lead(i) OVER w, i) AS hi
    FROM e WINDOW w AS (PARTITION BY doc_id, s ORDER BY i)) WHERE a IS NOT NULL),
k AS (SELECT c.*, array_to_string(ls[a:b], chr(10)) AS body, ls FROM c JOIN l USING (doc_id)),
f AS (SELECT body, doc_id AS fd, a AS fa, b AS fb, lo AS flo, hi AS fhi, ls AS fl FROM k
    QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, a, lo, hi DESC) = 1),
m AS (SELECT *, least(a - lo, fa - flo) AS most_back, least(hi - b, fhi - fb) AS most_ahead
    FROM k JOIN f USING (body) WHERE doc_id <> fd OR a <> fa),
g AS (SELECT doc_id, ls,
    a + 1 - coalesce(list_min(list_filter(range(1, most_back + 1), lambda j: ls[a - j] <> fl[fa - j])), most_back + 1) AS u,
    b - 1 + coalesce(list_min(list_filter(range(1, most_ahead + 1), lambda j: ls[b + j] <> fl[fb + j])), most_ahead + 1) AS v FROM m),
gone AS (SELECT DISTINCT doc_id, unnest(range(u, v + 1)) AS i FROM g
    WHERE len(list_filter(ls[u:v], lambda y: regexp_matches(y, '[^\x20\x09-\x0D]'))) >= 2),
kept AS (SELECT doc_id, count(*) AS n, string_agg(ls[i], chr(10) ORDER BY i) AS body
    FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l) ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ls)::BIGINT AS n_lines, (len(ls) - coalesce(n, 0))::BIGINT AS n_removed_lines,
    sha256(coalesce(body, '')) AS kept_sha256
FROM l LEFT JOIN kept USING (doc_id)
"""


SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
r AS (SELECT doc_id, i FROM w JOIN (SELECT g, min(doc_id) AS first FROM w GROUP BY g) USING (g) WHERE doc_id > first),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM r),
kept AS (SELECT doc_id, ws[p] AS word, p FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM d)
    ANTI JOIN gone USING (doc_id, p)),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS body FROM kept GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


def _shrunk(units: str, name: str) -> str:
    """Two CTEs: the level's correlation, and its units with the posterior's a and b."""
    p, spread = f"(bad / n::DOUBLE)", "(m * (1 - m))"
    return f"""
{name}_rho AS (SELECT CASE WHEN sum({spread} * (n - 1)) <> 0 THEN least({MOST_RHO}, greatest({LEAST_RHO},
    sum(n * ({p} - m) * ({p} - m) - {spread}) / sum({spread} * (n - 1)))) ELSE {MOST_RHO} END AS rho FROM {units} WHERE n > 0),
{name}_post AS (SELECT *, (1 / rho - 1) * m + bad AS a, (1 / rho - 1) * (1 - m) + n - bad AS b FROM {units}, {name}_rho)"""


def url_filters() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    two = ", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)
    rules = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '{r[r.find('/'):]}')" for v, r in RULES)
    return f"""
WITH u AS (SELECT page_id, {lower.format("coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(verdict, rule, rh, rp) AS (VALUES {rules}),
fit AS (SELECT page_id, arg_max(rule, len(rule)) AS rule, arg_max(verdict, len(rule)) AS verdict FROM u, rules
    WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
h0 AS (SELECT host, count(quality) AS n, coalesce(sum((quality = 0 OR toxic = 1)::INT), 0) AS bad
    FROM u LEFT JOIN labels ON page_id = doc_id GROUP BY host),
h1 AS (SELECT *, string_split(host, '.') AS x, array_to_string(string_split(host, '.')[-2:], '.') IN ({two}) AS wide FROM h0),
h AS (SELECT host, n, bad, array_to_string(CASE WHEN wide THEN x[-3:] ELSE x[-2:] END, '.') AS domain,
    array_to_string(CASE WHEN wide THEN x[-2:] ELSE x[-1:] END, '.') AS suffix FROM h1),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM h) AS m FROM h GROUP BY suffix),
{_shrunk("s0", "s")},
d0 AS (SELECT domain, suffix, sum(h.n) AS n, sum(h.bad) AS bad, any_value(a / (a + b)) AS m FROM h JOIN s_post USING (suffix) GROUP BY domain, suffix),
{_shrunk("d0", "d")},
host0 AS (SELECT host, h.n, h.bad, a / (a + b) AS m FROM h JOIN d_post USING (domain)),
{_shrunk("host0", "h_")}
SELECT u.page_id, u.host, u.path, rule, coalesce(fit.verdict,
    CASE WHEN a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM u JOIN h__post USING (host) LEFT JOIN fit USING (page_id)
"""

#: Each line a unit; four numbers of the hashed id choose form and cuts.
FILL_IN_MIDDLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
                  THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
             array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN len(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

#: crc32 bit by bit: numbers from 256 on mix in a character, zeros shift once.
CONVERSATION_TRIE = r"""
WITH turns AS (
  SELECT conv_id, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'k': key, 'n': n} ORDER BY turn NULLS FIRST, key) AS path FROM turns GROUP BY conv_id),
digits AS (SELECT conv_id, path, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                  lambda x: [256 + ascii(x), 0, 0, 0, 0, 0, 0, 0, 0]))::BIGINT[] AS steps FROM own),
crc AS (SELECT conv_id, path, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, steps), lambda c, x:
                  CASE WHEN x >= 256 THEN xor(c, x - 256) ELSE xor(c >> 1, (c & 1) * 3988292384) END)) % 4 AS h FROM digits),
rebuilt AS (SELECT c.conv_id, list_concat(coalesce(b.path[1:c.h], []), c.path[c.h + 1:]) AS path
            FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
steps AS (SELECT conv_id, d, path[1:d] AS prefix, len(path) = d AS last
          FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
nodes AS (SELECT list_transform(prefix, lambda x: x.k) AS keys, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(any_value(prefix[d].n), 0) AS n,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
          FROM steps GROUP BY ALL),
kids AS (SELECT keys[1:d - 1] AS keys, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
counted AS (SELECT a.*, coalesce(k.n_children, 0) AS n_children FROM nodes a LEFT JOIN kids k ON a.keys = k.keys),
tree AS (SELECT keys[1:e] AS keys, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * n) AS saved_tokens
         FROM (SELECT keys, n_children, n_convs, n, unnest(range(0, d + 1)) AS e FROM counted) GROUP BY 1)
SELECT a.conv_id, a.d AS depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, t.n_leaves::BIGINT AS n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, a.ends_sha256
FROM counted a JOIN tree t ON a.keys = t.keys LEFT JOIN nodes p ON a.d > 0 AND p.keys = a.keys[1:a.d - 1]
"""
