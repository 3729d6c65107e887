"""SQL for the operators that it can express."""

MIXTURE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM s),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM r),
k AS (
  SELECT *, row_number() OVER byratio AS k, sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS budget,
    coalesce(sum(cap) OVER (byratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS capped,
    sum(weight) OVER (byratio ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS weights
  FROM w WINDOW byratio AS (ORDER BY cap::DOUBLE / weight, rank)),
v AS (SELECT *, (budget - capped) / weights AS own FROM k),
t AS (
  SELECT source, source_size, least(cap::DOUBLE, (SELECT arg_min(own, k) FROM v WHERE own * weight <= cap) * weight) AS target
  FROM v),
f AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS full_times,
    target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS rest
  FROM t),
g AS (SELECT source, place, sum(size) AS words FROM d GROUP BY source, place),
c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY place) AS upto FROM g),
cut AS (
  SELECT f.source, max(place) AS cut FROM c JOIN f ON c.source IS NOT DISTINCT FROM f.source
  WHERE upto - rest <= 0 OR upto - rest < words - (upto - rest) GROUP BY f.source)
SELECT doc_id, size, f.source_size, f.target,
  (size * (full_times + CASE WHEN source_size > 0 AND place <= coalesce(cut.cut, -1) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source LEFT JOIN cut ON d.source IS NOT DISTINCT FROM cut.source
"""

DECONTAMINATION = r"""
WITH cased AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM cased),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, array_to_string(w[pos:pos + 9], ' ') AS gram, least(len(w), 10) AS k FROM i),
ks AS (SELECT DISTINCT k FROM g),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS pos FROM d),
own AS (SELECT r, pos, ks.k, array_to_string(w[pos:pos + ks.k - 1], ' ') AS gram FROM p, ks WHERE pos + ks.k - 1 <= len(w)),
hits AS (SELECT r, pos, own.k, own.gram, item_id FROM own JOIN g ON own.gram = g.gram AND own.k = g.k),
hit_words AS (SELECT r, count(DISTINCT word) AS n FROM (SELECT r, unnest(range(pos, pos + k)) AS word FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit_words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items.items, '')) AS items_sha256, coalesce(hit_words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN items USING (r)
"""

QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT r, unnest(range(1, len(w) - 6)) AS pos, w FROM w),
g AS (SELECT r, pos, array_to_string(w[pos:pos + 7], ' ') AS gram FROM p),
twice AS (SELECT r, unnest(places) AS pos FROM (SELECT r, list(pos) AS places FROM g GROUP BY r, gram HAVING count(*) > 1)),
again AS (SELECT r, count(DISTINCT word)::BIGINT AS n FROM (SELECT r, unnest(range(pos, pos + 8)) AS word FROM twice) GROUP BY r),
f AS (
  SELECT r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '[!?]'))::BIGINT AS n_shouts,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(again.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN again USING (r)),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
m AS (
  SELECT r, base_failed, lang, source, unnest([
    {'metric': 'symbols', 'x': 1000 * n_symbols // nullif(n_words, 0)},
    {'metric': 'word_length', 'x': 1000 * word_chars // nullif(n_words, 0)},
    {'metric': 'dup_lines', 'x': 1000 * n_dup_lines // nullif(n_lines, 0)},
    {'metric': 'repeated', 'x': 1000 * n_repeat_words // nullif(n_words, 0)},
    {'metric': 'shouted', 'x': 1000 * n_shouts // nullif(n_words, 0)}], recursive := true) FROM j),
h AS (
  SELECT lang, source, metric, CASE WHEN x < 64 THEN x ELSE (x >> (length(bin(x)) - 6)) << (length(bin(x)) - 6) END AS bucket, count(*) AS n
  FROM m WHERE NOT base_failed AND x IS NOT NULL GROUP BY ALL),
levels AS (
  SELECT 1 AS level, lang, source, metric, bucket, sum(n) AS n FROM h GROUP BY ALL
  UNION ALL SELECT 2, lang, NULL, metric, bucket, sum(n) FROM h GROUP BY ALL
  UNION ALL SELECT 3, NULL, NULL, metric, bucket, sum(n) FROM h GROUP BY ALL),
c AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, metric ORDER BY bucket) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, metric) AS total,
    coalesce(sum(n) FILTER (bucket > 0) OVER (PARTITION BY level, lang, source, metric), 0) AS positives,
    bucket + CASE WHEN bucket < 64 THEN 1 ELSE 1::BIGINT << (length(bin(bucket)) - 6) END AS upper FROM levels),
q AS (
  SELECT level, lang, source, metric, max(total) AS n, {
    'q1': min(bucket) FILTER (upto * 4 >= total), 'q3': min(upper) FILTER (upto * 4 >= total * 3),
    'tail': min(upper) FILTER (upto * 20 >= total * 19),
    'top': min(bucket) FILTER (bucket > 0 AND (upto - total + positives) * 4 >= positives * 3)} AS q FROM c GROUP BY ALL),
t AS (
  SELECT o.lang, o.source, o.metric, unnest(CASE WHEN o.n >= 100 THEN o.q WHEN l.n >= 100 THEN l.q ELSE a.q END)
  FROM q o JOIN q l ON l.level = 2 AND l.lang IS NOT DISTINCT FROM o.lang AND l.metric = o.metric
  JOIN q a ON a.level = 3 AND a.metric = o.metric WHERE o.level = 1),
outside AS (
  SELECT DISTINCT r FROM m JOIN t ON t.lang IS NOT DISTINCT FROM m.lang AND t.source IS NOT DISTINCT FROM m.source AND t.metric = m.metric
  WHERE CASE WHEN t.metric = 'word_length' THEN x < q1 - 3 * (q3 - q1) OR x >= q3 + 3 * (q3 - q1) ELSE x >= greatest(tail, top) END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM outside) AS kept FROM j
"""

#: Unsigned crc32 of the decimal form of a whole number.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, 1 + length({0}::VARCHAR)), lambda i: ord(substr({0}::VARCHAR, i::INTEGER, 1))::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


def _leaf(text: str) -> str:
    fields = (f"coalesce(octet_length(encode({v}::VARCHAR)) || ':' || {v}::VARCHAR, '-')" for v in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({' || '.join(fields)})"


def _level(t: str, k: int) -> str:
    """Siblings of the nodes ``{t}{k} (tree, r, d)``, and the level above; a single node goes up as it is."""
    return f"""
{t}{k}n AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {t}{k}),
{t}{k}s AS (
  SELECT a.tree, a.r, max(a.n) AS n, coalesce(string_agg(b.d, '' ORDER BY b.r) FILTER (b.r < a.r), '') AS l,
    coalesce(string_agg(b.d, '' ORDER BY b.r) FILTER (b.r > a.r), '') AS g
  FROM {t}{k}n a JOIN {t}{k}n b ON a.tree = b.tree AND a.r // 8 = b.r // 8 GROUP BY a.tree, a.r),
{t}{k + 1} AS (
  SELECT tree, r // 8 AS r, CASE WHEN max(n) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY r)) END AS d
  FROM {t}{k}n GROUP BY tree, r // 8)"""


def _climb(t: str, k: int, before: str, after: str, place: str) -> str:
    """Every leaf one level up: its digest so far, and the siblings seen so far."""
    return f"""
{after} AS (
  SELECT f.* REPLACE (proof || l || g AS proof, CASE WHEN s.n = 1 THEN up ELSE sha256(l || up || g) END AS up)
  FROM {before} f JOIN {t}{k}s s ON s.tree = f.{t}tree AND s.r = f.{place} // {8**k})"""


#: Levels that the SQL spells out: up to 8 ** 7 documents in a language, up to 64 languages.
_DEEP, _WIDE = 7, 2
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
MANIFEST = f"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("text")} AS d,
    CASE WHEN {_CRC32.format("doc_id")} % 3 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf("text")} END AS up FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS r FROM leaves),
a0 AS (SELECT tree, r, d FROM o),{",".join(_level("a", k) for k in range(_DEEP))},
b0 AS (SELECT 'all' AS tree, tree AS lang, row_number() OVER (ORDER BY encode(tree)) - 1 AS r, d FROM a{_DEEP}),
{",".join(_level("b", k) for k in range(_WIDE))},
f0 AS (SELECT o.doc_id, o.d, o.up, o.tree AS atree, o.r, 'all' AS btree, b0.r AS br, b0.d AS subroot, '' AS proof FROM o JOIN b0 ON b0.lang = o.tree),
{",".join(_climb("a", k, f"f{k}", f"f{k + 1}", "r") for k in range(_DEEP))},
{",".join(_climb("b", k, f"f{_DEEP + k}", f"f{_DEEP + k + 1}", "br") for k in range(_WIDE))}
SELECT f.doc_id, f.d AS leaf, subroot, b.d AS root, sha256(proof) AS proof_sha256, up AS folded_root, up = b.d AS verified
FROM f{_DEEP + _WIDE} f CROSS JOIN b{_WIDE} b
"""

PREFIX_TRIE = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS lender, {_CRC32.format("conv_id")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)),
lent AS (SELECT c.conv_id, r, role, text FROM c JOIN own ON own.conv_id = c.lender AND r <= h),
k AS (SELECT c.conv_id, c.h, count(lent.r) AS taken FROM c LEFT JOIN lent USING (conv_id) GROUP BY ALL),
rows AS (
  SELECT * FROM lent UNION ALL
  SELECT own.conv_id, r - h + taken, role, text FROM own JOIN k USING (conv_id) WHERE r > h),
paths AS (
  SELECT c.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY r) FILTER (r IS NOT NULL), []) AS path
  FROM c LEFT JOIN rows USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, d AS depth, len(path) AS n, path[1:d] AS node FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM paths)),
nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM p GROUP BY node, depth),
up AS (SELECT *, CASE WHEN depth > 0 THEN node[1:depth - 1] END AS above FROM nodes),
kids AS (SELECT above, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY above),
e AS (
  SELECT u.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(octet_length(encode(u.node[depth].text)), 0) AS saved
  FROM up u LEFT JOIN kids ON kids.above = u.node),
below AS (
  SELECT node[1:d] AS node, sum(saved) AS saved, sum((n_children = 0)::INT) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM e) GROUP BY node[1:d])
SELECT e.conv_id, e.depth, a.conv_id AS parent_conv_id, e.n_convs, e.n_children, leaves::BIGINT AS n_leaves,
  below.saved::BIGINT AS saved_tokens, e.ends_sha256
FROM e JOIN below ON below.node = e.node LEFT JOIN nodes a ON a.node = e.above
"""
