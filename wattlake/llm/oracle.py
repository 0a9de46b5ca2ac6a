"""DuckDB twins of the queries that SQL can express (written on their own, not generated from the plans)."""

from __future__ import annotations

from . import queries as Q

_SITE = ", ".join(f"('{t}', '{a}')" for t, a in Q.SITE_RULES)


def _pattern_sql(text: str) -> str:
    body = text.replace("*", ".*")
    left = "" if text.startswith("*") else "(?:^|[^a-z0-9])"
    right = "" if text.endswith("*") else "(?:[^a-z0-9]|$)"
    return left + body + right


_PATTERNS = ", ".join(f"({i}, '{p}', '{a}', '{_pattern_sql(p)}')" for i, (p, a) in enumerate(Q.PATTERN_RULES))
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = f"""
WITH r AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UP}', '{_LOW}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
site(rule, action) AS (VALUES {_SITE}),
pat(rank, rule, action, re) AS (VALUES {_PATTERNS}),
parts AS (SELECT rule, action, split_part(rule, '/', 1) AS rhost, substr(rule, strpos(rule, '/')) AS rpath FROM site),
u AS (SELECT DISTINCT host, path FROM h),
s AS (SELECT host, path, max(struct_pack(n := length(rule), rule := rule, action := action)) AS best FROM u, parts
      WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path),
p AS (SELECT host, path, min(struct_pack(rank := rank, rule := rule, action := action)) AS best FROM u, pat
      WHERE regexp_matches(translate(host || path, '{_UP}', '{_LOW}'), re) GROUP BY host, path)
SELECT page_id, host, path, s.best.rule AS rule, coalesce(s.best.action, p.best.action, 'allow') AS verdict, p.best.rule AS method_rule
FROM h LEFT JOIN s USING (host, path) LEFT JOIN p USING (host, path)
"""

_SHARDS = ", ".join(f"({i}, '{s}')" for i, s in enumerate(Q.SHARDS))
_SLOTS = 3203       # the first prime from 100 x 32 on
OP4 = f"""
WITH RECURSIVE names(shard, name) AS (VALUES {_SHARDS}),
pref AS (SELECT list(CAST('0x' || substr(md5(name || ':offset'), 1, 8) AS BIGINT) % {_SLOTS} ORDER BY shard) AS ats,
                list(CAST('0x' || substr(md5(name || ':skip'), 1, 8) AS BIGINT) % {_SLOTS - 1} + 1 ORDER BY shard) AS steps FROM names),
turns(turn, slot, owner) AS (
  SELECT 0, CAST(-1 AS BIGINT), list_transform(range({_SLOTS}), lambda x: -1)
  UNION ALL
  SELECT turn + 1, claim, owner[:claim] || [turn % {len(Q.SHARDS)}] || owner[claim + 2:]
  FROM (SELECT turn, owner, list_filter(list_transform(range({_SLOTS}), lambda j: (a + j * s) % {_SLOTS}), lambda x: owner[x + 1] = -1)[1] AS claim
        FROM (SELECT turn, owner, ats[turn % {len(Q.SHARDS)} + 1] AS a, steps[turn % {len(Q.SHARDS)} + 1] AS s FROM turns, pref WHERE turn < {_SLOTS}))
),
placed AS (SELECT slot, (turn - 1) % {len(Q.SHARDS)} AS shard FROM turns WHERE turn > 0)
SELECT doc_id, source, CAST(d.slot AS INTEGER) AS slot, CAST(p.shard AS INTEGER) AS shard
FROM (SELECT doc_id, source, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % {_SLOTS} AS slot FROM documents) d
JOIN placed p ON p.slot = d.slot
"""


def _weight(column: str, level: str) -> str:
    cases = " ".join(f"WHEN {column} = '{k}' THEN {w}" for k, w in Q.MIX_WEIGHTS.get(level, {}).items())
    return f"CAST(CASE {cases} ELSE 1 END AS HUGEINT)" if cases else "CAST(1 AS HUGEINT)"


def _level(name: str, kids: str, parent: str, column: str) -> str:
    """One level of water-filling: ``kids`` has the parent columns, ``column``, w, cap, budget."""
    part = f"PARTITION BY {parent}" if parent else ""
    keep = f"{parent}, {column}" if parent else column
    return f"""
{name}_a AS (SELECT *, sum(cap) OVER ({part} ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE), {column}) - cap AS used_before,
                    sum(w) OVER ({part} ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE) DESC, {column} DESC) AS w_from FROM {kids}),
{name}_b AS (SELECT *, min(CASE WHEN cap * w_from <= greatest(budget - used_before, 0) * w THEN 1 ELSE 0 END)
                    OVER ({part} ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE), {column}) AS filled FROM {name}_a),
{name}_c AS (SELECT *, coalesce(sum(cap) FILTER (filled = 1) OVER ({part}), 0) AS used, sum(w) FILTER (filled = 0) OVER ({part}) AS open FROM {name}_b),
{name} AS (SELECT {keep}, CASE WHEN filled = 1 THEN cap ELSE least((CAST(budget AS HUGEINT) - CAST(used AS HUGEINT)) * CAST(w AS HUGEINT) // CAST(open AS HUGEINT), cap) END AS budget FROM {name}_c)"""


OP7 = f"""
WITH d AS (SELECT doc_id, coalesce(lang, '?') AS l, coalesce(source, '?') AS s, lang, source,
                  CASE WHEN left(md5(coalesce(source, '')), 1) < '6' THEN 'web' WHEN left(md5(coalesce(source, '')), 1) < 'b' THEN 'books' ELSE 'code' END AS dom,
                  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n FROM documents),
leaf AS (SELECT dom, l, s, CAST(sum(n) AS HUGEINT) AS supply, CAST(sum(n) AS HUGEINT) * {Q.MIX_EPOCHS} AS cap FROM d GROUP BY ALL),
k1 AS (SELECT dom, sum(cap) AS cap, {_weight('dom', 'domain')} AS w, (SELECT sum(supply) FROM leaf) AS budget FROM leaf GROUP BY dom),
{_level('b1', 'k1', '', 'dom')},
k2 AS (SELECT leaf.dom, l, sum(cap) AS cap, {_weight('l', 'lang')} AS w, any_value(budget) AS budget FROM leaf JOIN b1 USING (dom) GROUP BY leaf.dom, l),
{_level('b2', 'k2', 'dom', 'l')},
k3 AS (SELECT leaf.dom, leaf.l, s, cap, CAST(1 AS HUGEINT) AS w, budget FROM leaf JOIN b2 ON leaf.dom = b2.dom AND leaf.l = b2.l),
{_level('b3', 'k3', 'dom, l', 's')},
q AS (SELECT leaf.dom, leaf.l, leaf.s, CAST(budget AS HUGEINT) // supply AS whole, CAST(budget AS HUGEINT) % supply AS rest
      FROM leaf JOIN b3 ON leaf.dom = b3.dom AND leaf.l = b3.l AND leaf.s = b3.s WHERE supply > 0),
o AS (SELECT d.*, whole, rest, md5('{Q.MIX_SEED}:' || CAST(whole AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS u
      FROM d JOIN q ON d.dom = q.dom AND d.l = q.l AND d.s = q.s),
c AS (SELECT *, sum(n) OVER (PARTITION BY dom, l, s ORDER BY u RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM o),
e AS (SELECT *, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS copies FROM c)
SELECT doc_id, dom AS domain, lang, source, CAST(x.epoch AS INTEGER) AS epoch
FROM e, (SELECT unnest(range({Q.MIX_EPOCHS})) AS epoch) x WHERE x.epoch < copies
"""

OP8 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, p, md5(list_aggregate(ws[p:p + 12], 'string_agg', ' ')) AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM w WHERE len(ws) >= 13)),
m AS (SELECT k, min(doc_id) AS first FROM g GROUP BY k),
hit AS (SELECT g.doc_id, g.p FROM g JOIN m USING (k) WHERE m.first < g.doc_id),
gone AS (SELECT DISTINCT doc_id, p + o AS p FROM hit, (SELECT unnest(range(13)) AS o) x),
gl AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(ps, i)) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN gl ON w.doc_id = gl.doc_id
"""

OP3 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
             ELSE list_transform(range(1, len(ws) - 1), lambda p: array_to_string(ws[p:p + 2], ' ')) END) AS el FROM w),
e AS (SELECT doc_id, len(el) AS n, unnest(el) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
      GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
pair AS (SELECT a, b FROM c UNION ALL SELECT b, a FROM c),
r(a, b) AS (SELECT a, b FROM pair UNION SELECT r.a, pair.b FROM r JOIN pair ON r.b = pair.a),
low AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT doc_id, CAST(len(el) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id FROM s LEFT JOIN low ON low.a = s.doc_id
"""


def _crc_steps() -> str:
    """Effect of each byte on the CRC-32 register, from its rule."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ 0xEDB88320 if c & 1 else c >> 1
        out.append(c)
    return "[" + ", ".join(map(str, out)) + "]::BIGINT[]"


def _crc(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes."""
    byte = f"list_transform(range(0, length(hex({text})) // 2), lambda i: CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT))"
    return (f"xor(list_reduce([4294967295::BIGINT] || {byte}, lambda c, b: xor(({_crc_steps()})[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)")


_LOWERED = f"translate(coalesce(text, ''), '{_UP}', '{_LOW}')"
_FEATURES = """
SELECT id, unnest(CASE WHEN len(ws) = 0 THEN [] ELSE list_concat(ws, list_transform(range(1, len(ws)), lambda p: array_to_string(ws[p:p + 1], ' ')),
       list_transform(range(1, greatest(len(ws) - 1, 1)), lambda p: array_to_string(ws[p:p + 2], ' '))) END) AS f FROM {words}"""
OP12 = rf"""
WITH dw AS (SELECT doc_id AS id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (SELECT item_id AS id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
df AS ({_FEATURES.format(words='dw')}), bf AS ({_FEATURES.format(words='bw')}),
distinct_f AS (SELECT f, {_crc('f')} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf)),
db AS (SELECT id, bucket FROM df JOIN distinct_f USING (f)), bb AS (SELECT bucket FROM bf JOIN distinct_f USING (f)),
s AS (SELECT bucket, count(*) AS s FROM db GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM bb GROUP BY bucket),
gain AS (SELECT s.bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
           / ((s + 1)::DOUBLE * ((SELECT count(*) FROM bb) + 10000)::DOUBLE))) AS BIGINT) AS g FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT id, count(*) AS n, CAST(sum(g) AS BIGINT) AS weight FROM db JOIN gain USING (bucket) GROUP BY id),
x AS (SELECT dw.id AS doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || CAST(dw.id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM dw LEFT JOIN w ON w.id = dw.id),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM x WHERE n_words >= 20)
SELECT x.doc_id, n_features, weight, score, CASE WHEN rank <= 5 * r.n // 100 THEN rank END AS rank FROM x LEFT JOIN r USING (doc_id)
"""


def _value(column: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({column} AS VARCHAR))) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"


def _fold(name: str, base: str, levels: int) -> str:
    """Levels of the trees of ``base`` (tree, i, h): an unrolled fold in runs of eight; a tree that has one node stays as it is."""
    out = [f"{name}0 AS (SELECT tree, i, h, count(*) OVER (PARTITION BY tree) AS n FROM {base})"]
    for k in range(1, levels + 1):
        out.append(f"{name}{k} AS (SELECT tree, i // 8 AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, "
                   f"(any_value(n) + 7) // 8 AS n FROM {name}{k - 1} GROUP BY tree, i // 8)")
    return ",\n".join(out)


def _climb(name: str, levels_of: str, base: str, levels: int) -> str:
    """Fold a proof level by level: ``base`` (key, tree, i, cur, sib) -> the same one tree further up."""
    out = [f"{name}0 AS (SELECT * FROM {base})"]
    for k in range(1, levels + 1):
        out.append(f"""{name}{k} AS (SELECT p.key, p.tree, p.i // 8 AS i,
          CASE WHEN any_value(l.n) = 1 THEN any_value(p.cur) ELSE sha256(string_agg(CASE WHEN l.i = p.i THEN p.cur ELSE l.h END, '' ORDER BY l.i)) END AS cur,
          any_value(p.sib) || coalesce(string_agg(CASE WHEN l.i <> p.i THEN l.h END, '' ORDER BY l.i), '') AS sib
        FROM {name}{k - 1} p JOIN {levels_of}{k - 1} l ON l.tree = p.tree AND l.i // 8 = p.i // 8 GROUP BY p.key, p.tree, p.i // 8)""")
    return ",\n".join(out)


_DEPTH, _WIDE = 7, 3        # levels of the largest tree and of the tree of trees: 2,097,152 rows of a language, 512 languages
OP13 = f"""
WITH d AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, {' || '.join(_value(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} AS head, text,
             {_crc('CAST(doc_id AS VARCHAR)')} % 3 = 0 AS touched FROM documents),
leaf AS (SELECT doc_id, tree, sha256(head || {_value('text')}) AS h,
           sha256(head || CASE WHEN touched THEN {_value(f"translate(text, '{_UP}', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_value('text')} END) AS shown FROM d),
base AS (SELECT doc_id, tree, h, shown, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS i FROM leaf),
{_fold('a', 'base', _DEPTH)},
trees AS (SELECT '' AS tree, tree AS own, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS i FROM a{_DEPTH}),
{_fold('b', 'trees', _WIDE)},
start AS (SELECT doc_id AS key, tree, i, shown AS cur, '' AS sib FROM base),
{_climb('p', 'a', 'start', _DEPTH)},
middle AS (SELECT p.key, '' AS tree, t.i, p.cur, p.sib FROM p{_DEPTH} p JOIN trees t ON t.own = p.tree),
{_climb('q', 'b', 'middle', _WIDE)}
SELECT doc_id, base.h AS leaf, trees.h AS subroot, b{_WIDE}.h AS root, sha256(q.sib) AS proof_sha256, q.cur AS folded_root, q.cur = b{_WIDE}.h AS verified
FROM base JOIN q{_WIDE} q ON q.key = base.doc_id JOIN trees ON trees.own = base.tree, b{_WIDE}
"""

SQL = {"op3_ngram_join": OP3, "op8_substring_dedup": OP8, "op2_url_rules": OP2, "op4_sharding": OP4, "op7_mixing": OP7,
       "op12_importance_resampling": OP12, "op13_merkle_manifest": OP13}
