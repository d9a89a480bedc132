"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from docspark.llm import licenses

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Least id reachable from each node over the edges of `both(a, b)`.
_REACH = """reach AS (SELECT id, id AS c FROM nodes UNION SELECT both_ways.b, reach.c FROM reach JOIN both_ways ON reach.id = both_ways.a WHERE reach.c < both_ways.b),
least AS (SELECT id, min(c) AS component_id FROM reach GROUP BY id)"""


def jaccard(size: int = 4, percent: int = 85) -> str:
    """All pairs of documents that share a shingle, counted."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {size} THEN list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), nodes AS (SELECT doc_id AS id FROM documents),
{_REACH}
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least.component_id FROM w LEFT JOIN n USING (doc_id) JOIN least ON least.id = w.doc_id"""


VECTORS = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.9),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), nodes AS (SELECT vec_id AS id FROM embeddings),
{_REACH}
SELECT vec_id, coalesce(k.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON id = vec_id LEFT JOIN (SELECT a, count(*) AS n FROM both_ways GROUP BY a) k ON k.a = vec_id"""


def license_scan(threshold: float = 0.9) -> str:
    """Every run of words that starts with a template's word against that template, every word against every phrase."""
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    phrases = " UNION ALL ".join(f"SELECT '{label}' AS label, {listed(licenses.words_of(p))} AS p" for label, p in licenses.PHRASES)
    templates = " UNION ALL ".join(f"SELECT {i} AS t, '{label}' AS label, {listed(licenses.words_of(text))} AS s" for i, (label, text) in enumerate(licenses.TEMPLATES))
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_LOWER} AS t FROM documents), w AS (SELECT doc_id, r, regexp_extract_all(t, {word}) AS w FROM d),
ph AS ({phrases}),
te AS (SELECT t, label, s, list_distinct(s) AS words, list_distinct(list_transform(range(1, len(s)), lambda i: s[i] || ' ' || s[i + 1])) AS pairs,
  CAST(ceil(len(list_distinct(s)) * {threshold} - 1e-9) AS BIGINT) AS need FROM ({templates})),
places AS (SELECT r, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + len(p)] = p)) AS i FROM w, ph WHERE list_has_all(w, p)),
tw AS (SELECT t, unnest(words) AS x FROM te), tp AS (SELECT t, unnest(pairs) AS y FROM te),
dw AS (SELECT r, unnest(range(len(w))) AS p, unnest(w) AS x, unnest(list_transform(range(len(w)), lambda i: w[i + 1] || ' ' || w[i + 2])) AS y FROM w),
hits AS (SELECT r, t, p, dw.x, tp.y, len(te.words) AS size, len(te.pairs) - 2 * (len(te.words) - need) AS need_pairs, need, len(s) + len(te.words) - need AS win
  FROM dw JOIN tw USING (x) JOIN te USING (t) LEFT JOIN tp USING (t, y)),
full_ones AS (SELECT *, count(*) OVER (PARTITION BY r, t ORDER BY p RANGE BETWEEN CURRENT ROW AND win - 1 FOLLOWING) AS n FROM hits),
held AS (SELECT f.r, f.t, f.p, f.size, f.need, f.need_pairs, count(DISTINCT h.x) AS n, count(DISTINCT h.y) FILTER (WHERE h.p < f.p + f.win - 1) AS n_pairs
  FROM full_ones f JOIN hits h ON h.r = f.r AND h.t = f.t AND h.p >= f.p AND h.p < f.p + f.win WHERE f.n >= f.need GROUP BY ALL),
found AS (SELECT r, label, n / size AS c FROM held JOIN te USING (t) WHERE n >= held.need AND n_pairs >= need_pairs),
base AS (SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY r),
al AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(c) AS c
  FROM (SELECT r, label, 1.0::DOUBLE AS c FROM places UNION ALL SELECT r, label, c FROM found) GROUP BY r)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(base.n, 0) AS n_base, base.lo AS first_word, base.hi AS last_word,
  coalesce(base.labels, '') AS base_labels, coalesce(al.labels, '') AS labels, coalesce(al.c, 0.0)::DOUBLE AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN al USING (r)"""


#: Every alignment of a document and an item, by the tokens that agree.
DECONTAMINATION = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
dw AS (SELECT doc_id, len(w) AS n, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS p FROM d),
bw AS (SELECT item_id, len(w) AS m, unnest(w) AS t, generate_subscripts(w, 1) - 1 AS q FROM b WHERE len(w) >= 5),
s AS (SELECT doc_id, item_id, p - q AS shift, p, n, m, least(13, m) AS win FROM dw JOIN bw USING (t)),
k AS (SELECT *, win - greatest(0, (win - 5) // 4) AS need FROM s),
o AS (SELECT *, row_number() OVER x AS r, count(*) OVER (PARTITION BY doc_id, item_id, shift) AS c, min(p) OVER (PARTITION BY doc_id, item_id, shift) AS first
  FROM k WINDOW x AS (PARTITION BY doc_id, item_id, shift ORDER BY p)),
z AS (SELECT x.doc_id, x.item_id, x.shift, x.c, x.first FROM o x JOIN o y ON x.doc_id = y.doc_id AND x.item_id = y.item_id AND x.shift = y.shift AND y.r = x.r + x.need - 1
  WHERE x.c >= x.need AND y.p - x.p < x.win AND least(x.n, x.shift + x.m) - greatest(0, x.shift) >= x.win),
best AS (SELECT DISTINCT ON (doc_id, item_id) * FROM z ORDER BY doc_id, item_id, c DESC, shift)
SELECT doc_id, item_id, CAST(first AS BIGINT) AS doc_start, CAST(first - shift AS BIGINT) AS item_start, CAST(c AS BIGINT) AS n_matched FROM best"""


#: Every document against every item.
RANKED_SEARCH = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
n AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM n),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
s AS (SELECT q.item_id, n.doc_id, n.r, sum(CAST(floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT)
    * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 90 + (90 * n.n * big_n) // big_l))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN df USING (t) JOIN n USING (r), total GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""

#: Prefixes as lists of turns; every node against every node below it.
PREFIX_TRIE = r"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n::BIGINT], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
c AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, turns, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda s, b: xor(s >> 8, crc.t[(xor(s, b) & 255) + 1]))) % 4 AS h FROM c, crc),
p AS (SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) AS path FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 20),
m AS (SELECT conv_id, len(path) AS n, unnest(range(len(path) + 1)) AS depth, path FROM p),
nodes AS (SELECT depth, path[1:depth] AS node, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth) AS ends
  FROM m GROUP BY depth, node),
up AS (SELECT n.*, q.conv_id AS parent_conv_id, coalesce(len(regexp_extract_all(n.node[n.depth].text, '[^\x20\x09-\x0D]+')), 0) AS words
  FROM nodes n LEFT JOIN nodes q ON q.depth = n.depth - 1 AND q.node = n.node[1:n.depth - 1]),
kids AS (SELECT conv_id, depth, (SELECT count(*) FROM nodes k WHERE k.depth = u.depth + 1 AND k.node[1:u.depth] = u.node) AS n_children FROM up u),
below AS (SELECT d.conv_id, d.depth, d.words, d.n_convs, k.n_children, unnest(list_transform(range(d.depth + 1), lambda i: {'n': i, 'node': d.node[1:i]})) AS a FROM up d JOIN kids k USING (conv_id, depth)),
sums AS (SELECT a.n AS depth, a.node AS node, sum((n_convs - 1) * words)::BIGINT AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves FROM below GROUP BY ALL)
SELECT u.conv_id, u.depth, u.parent_conv_id, u.n_convs, k.n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(u.ends, '')) AS ends_sha256
FROM up u JOIN kids k USING (conv_id, depth) JOIN sums s ON s.depth = u.depth AND s.node = u.node"""
