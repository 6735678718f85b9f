"""SQL with the results of registered queries, where it is longer than a few lines."""

from grainline.llm.divergence import LEAST_DOCUMENTS, SCALE as SHARE_SCALE, TOP
from grainline.llm.infill import MIDDLE, PREFIX, SEED as INFILL_SEED, SUFFIX
from grainline.llm.licenses import TEMPLATES, THRESHOLD
from grainline.llm.mixing import BLOCK, REPEATS, SEED, SHARD_ROWS, SHARE, WEIGHTS
from grainline.llm.secrets import ACCESS, ALLOWED, ASSIGN, ASSIGN_LEAST, HEX, KINDS, LIMITS, SCALE, WINDOW, most_weight

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _hash(seed, *parts):
    text = " || ':' || ".join([f"'{seed}'", *(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _seats(name, parties, group, order, votes, house):
    """All quotients that can win a seat are listed and ranked."""
    by = f"PARTITION BY {group}" if group else ""
    most = f"CAST({votes} / (sum({votes}) OVER ({by})) * {house} AS BIGINT) + count(*) OVER ({by}) + 2"
    return f"""{name}_q AS (SELECT *, unnest(range(0, CASE WHEN {votes} > 0 AND {house} > 0 THEN most ELSE 0 END)) AS seat
      FROM (SELECT *, CASE WHEN {votes} > 0 THEN {most} END AS most FROM {parties})),
    {name}_r AS (SELECT *, row_number() OVER ({by} ORDER BY {votes} / CAST(2 * seat + 1 AS DOUBLE) DESC, {order}) AS place FROM {name}_q)"""


MIXING = f"""WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
g AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_rows FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM g),
w AS (SELECT *, CAST([{", ".join(map(str, WEIGHTS))}][(pos - 1) % {len(WEIGHTS)} + 1] AS DOUBLE) AS weight FROM o),
k AS (SELECT *, {REPEATS} * source_size / weight AS ratio,
  ({SHARE} * sum(source_size) OVER () - {REPEATS} * coalesce(sum(source_size) OVER (ORDER BY {REPEATS} * source_size / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY {REPEATS} * source_size / weight, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
l AS (SELECT arg_min(level, (ratio, pos)) FILTER (WHERE level <= ratio) AS level FROM k),
s AS (SELECT source, source_size, n_rows, pos, least(weight * (SELECT level FROM l), CAST({REPEATS} * source_size AS DOUBLE)) AS target FROM w),
h AS (SELECT *, CAST(round(sum(target) OVER () / {BLOCK}) AS BIGINT) AS house FROM s),
{_seats("a", "h", "", "pos", "target", "house")},
q AS (SELECT h.source, h.source_size, h.target, CAST(ceil(h.n_rows / {SHARD_ROWS}) AS BIGINT) AS shards, count(a_r.seat) AS quota
  FROM h LEFT JOIN a_r ON a_r.pos = h.pos AND a_r.place <= h.house GROUP BY ALL),
p AS (SELECT d.doc_id, d.source, d.size, q.source_size, q.target, q.quota, CAST(floor({_hash(SEED, "d.doc_id")} * q.shards / {1 << 32}) AS BIGINT) AS shard
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
c AS (SELECT source, shard, quota, CAST(sum(size) AS DOUBLE) AS shard_size FROM p GROUP BY ALL),
{_seats("b", "c", "source", "shard", "shard_size", "quota")},
t AS (SELECT c.source, c.shard, c.shard_size, CAST(ceil(c.shard_size / {BLOCK}) AS BIGINT) AS blocks, count(b_r.seat) AS got
  FROM c LEFT JOIN b_r ON b_r.source IS NOT DISTINCT FROM c.source AND b_r.shard = c.shard AND b_r.place <= c.quota GROUP BY ALL),
r AS (SELECT *, least(got, {REPEATS} * blocks) // greatest(blocks, 1) AS passes, least(got, {REPEATS} * blocks) % greatest(blocks, 1) AS run,
  {_hash(SEED, "source", "shard")} % greatest(blocks, 1) AS start FROM t),
x AS (SELECT p.*, sum(size) OVER (PARTITION BY source, shard ORDER BY {_hash(SEED + ":o", "doc_id")}, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM p)
SELECT x.doc_id, x.size, x.source_size, x.target, CAST(passes * size
  + greatest(0, least(upto, least(shard_size, least(start + run, blocks) * {BLOCK})) - greatest(upto - size, start * {BLOCK}))
  + greatest(0, least(upto, greatest(0, start + run - blocks) * {BLOCK}) - greatest(upto - size, 0)) AS BIGINT) AS taken
FROM x JOIN r ON r.source IS NOT DISTINCT FROM x.source AND r.shard = x.shard"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
JACCARD = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 2], ' ')) AS h FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 90 * (p.n + q.n - k)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x)
SELECT r.a AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a"""

_VALUES = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in TEMPLATES)
LICENSES = rf"""WITH t AS (SELECT row_number() OVER () AS tid, * FROM (VALUES {_VALUES}) v(license_id, text)),
tw AS (SELECT tid, license_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS ws FROM t),
tg AS (SELECT DISTINCT tid, license_id, ws[i] || ' ' || ws[i + 1] AS g FROM (SELECT *, unnest(range(1, len(ws))) AS i FROM tw)),
tn AS (SELECT tid, count(*) AS n FROM tg GROUP BY tid),
ln AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, coalesce(text, '') AS text FROM documents),
u AS (SELECT doc_id, 0 AS unit, text AS part FROM ln WHERE len(ls) > 1 UNION ALL SELECT doc_id, i, ls[i] FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM ln)),
uw AS (SELECT doc_id, unit, regexp_extract_all(lower(part), '[\p{{L}}\p{{N}}]+') AS ws FROM u),
ug AS (SELECT DISTINCT doc_id, unit, ws[i] || ' ' || ws[i + 1] AS g FROM (SELECT *, unnest(range(1, len(ws))) AS i FROM uw)),
un AS (SELECT doc_id, unit, count(*) AS n FROM ug GROUP BY 1, 2),
m AS (SELECT ug.doc_id, ug.unit, tg.tid, tg.license_id, count(*) AS k FROM ug JOIN tg ON ug.g = tg.g GROUP BY 1, 2, 3, 4),
f AS (SELECT m.doc_id, m.unit, m.license_id, 2 * k / (un.n + tn.n) AS dice FROM m JOIN un ON un.doc_id = m.doc_id AND un.unit = m.unit JOIN tn ON tn.tid = m.tid),
b AS (SELECT doc_id, arg_min(license_id, (-dice, license_id)) AS license_id, max(dice) AS dice, count(DISTINCT unit) AS n_matches FROM f WHERE dice >= {THRESHOLD} GROUP BY doc_id)
SELECT documents.doc_id, b.license_id, b.dice, coalesce(b.n_matches, 0) AS n_matches FROM documents LEFT JOIN b ON b.doc_id = documents.doc_id"""

_NUMBER = f"CAST('0x' || substr(sha256('{INFILL_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), {{}}, 8) AS BIGINT)"
INFILL = rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS ls,
  {_NUMBER.format(1)} AS h1, {_NUMBER.format(9)} AS h2, {_NUMBER.format(17)} AS h3, {_NUMBER.format(25)} AS h4 FROM documents),
c AS (SELECT *, len(ls) AS n, least(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS a, greatest(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= 100 THEN 'plain'
    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, array_to_string(ls[1:a], '') AS prefix, array_to_string(ls[a + 1:b], '') AS middle, array_to_string(ls[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
    ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""


def _places(name, pattern):
    """Place and value of every match: lengths of the matches and of the texts between them, added up."""
    quoted = pattern.replace("'", "''")
    return f"""{name}_l AS (SELECT r, doc_id, regexp_extract_all(text, '{quoted}') AS ms, regexp_split_to_array(text, '{quoted}') AS bs FROM docs),
{name}_u AS (SELECT r, unnest(range(1, len(ms) + 1)) AS i, ms, bs FROM {name}_l WHERE len(ms) > 0),
{name} AS (SELECT r, i, ms[i] AS value, CAST(sum(length(ms[i]) + length(bs[i])) OVER (PARTITION BY r ORDER BY i) AS BIGINT) AS stop FROM {name}_u)"""


_KIND_ORDER = " ".join(f"WHEN '{k}' THEN {n}" for n, k in enumerate(KINDS))
_LISTED = f"string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, CASE kind {_KIND_ORDER} END, stop)"
_ALLOWED = " OR ".join("regexp_matches(value, '{}')".format(p) for p in ALLOWED)
SECRETS = rf"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
{_places("a", ASSIGN)},
{_places("k", ACCESS)},
{_places("h", HEX)},
{_places("e", f"[A-Za-z0-9+/_=-]{{{WINDOW},}}")},
c AS (SELECT r, i, value, stop - length(value) AS start, CASE WHEN regexp_full_match(value, '[0-9A-Fa-f]+') THEN 'entropy_hex' ELSE 'entropy_base64' END AS kind
  FROM e WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND NOT ({_ALLOWED})),
w AS (SELECT *, unnest(range(1, length(value) - {WINDOW} + 2)) AS s FROM c),
x AS (SELECT r, i, kind, start + s - 1 AS start, substr(value, s, {WINDOW}) AS win FROM w),
n AS (SELECT r, i, kind, start, unnest(map_values(list_histogram(string_split(win, '')))) AS n FROM x
  WHERE regexp_matches(win, '[0-9]') AND regexp_matches(win, '[A-Za-z]')),
m AS (SELECT r, i, kind, start, sum(CAST(round(n * log2(n) * {SCALE}) AS BIGINT)) AS weight FROM n GROUP BY ALL),
f AS (SELECT *, CASE WHEN start > lag(start) OVER (PARTITION BY r, i ORDER BY start) + {WINDOW} THEN 1 ELSE 0 END AS fresh FROM m
  WHERE weight <= CASE kind WHEN 'entropy_hex' THEN {most_weight(LIMITS["entropy_hex"], WINDOW)} ELSE {most_weight(LIMITS["entropy_base64"], WINDOW)} END),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY r, i ORDER BY start) AS island FROM f),
s AS (SELECT r, 'assign' AS kind, stop - length(value) AS start, stop FROM a WHERE length(regexp_extract(value, '{ASSIGN.replace("'", "''")}', 2)) >= {ASSIGN_LEAST}
  UNION ALL SELECT r, 'access', stop - length(value), stop FROM k UNION ALL SELECT r, 'hex', stop - length(value), stop FROM h
  UNION ALL SELECT r, any_value(kind), min(start), max(start) + {WINDOW} FROM g GROUP BY r, i, island),
t AS (SELECT r, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  {_LISTED} FILTER (WHERE kind IN ('assign', 'access', 'hex')) AS base, {_LISTED} AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN t ON t.r = docs.r"""

DIVERGENCE = rf"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
x AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM x GROUP BY 1, 2 HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM x GROUP BY 1, 2, 3),
e AS (SELECT g.lang, g.source, k.term, k.lang_n, coalesce(c.n, 0) AS n FROM g JOIN k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT *, 1 + ({SHARE_SCALE}::HUGEINT * (n + 1)) // (sum(n) OVER w + count(*) OVER w) AS p,
  1 + ({SHARE_SCALE}::HUGEINT * (lang_n + 1)) // (sum(lang_n) OVER w + count(*) OVER w) AS q FROM e WINDOW w AS (PARTITION BY lang, source)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b
  ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q),
f AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o)
SELECT * FROM f WHERE part = 'pair' OR rank <= {TOP}"""
