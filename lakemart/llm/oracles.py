"""Oracle SQL (DuckDB) of the operators' queries, written from the contracts
and the methods' formulas, not from the Spark code."""

from __future__ import annotations

from . import licenses, lines, mixing, quality, sharding

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
SPACED = r"'[^\x20\x09-\x0D]+'"
ROWS = "SELECT row_number() OVER () AS rid, * FROM documents"


def crc32(text: str) -> str:
    """CRC-32 of a text expression, two steps of four bits a byte."""
    table = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ (3988292384 if n & 1 else 0)
        table.append(n)
    t = f"{table}::BIGINT[]"
    step = f"xor(xor(c, b) >> 4, ({t})[(xor(c, b) & 15) + 1])"
    both = f"xor(({step}) >> 4, ({t})[(({step}) & 15) + 1])"
    hexes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {hexes}), lambda c, b: {both}), 4294967295)"


DECONTAMINATE = f"""
WITH d AS (SELECT rid, doc_id, regexp_extract_all({LOWER}, {ALNUM}) AS w FROM ({ROWS})),
b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all({LOWER}, {ALNUM}) AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(13, len(w)) AS m, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS k
       FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i) WHERE len(w) > 0),
dw AS (SELECT rid, i, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS k
       FROM d, (SELECT DISTINCT m FROM bw), unnest(range(1, len(w) - m + 2)) t(i)),
hit AS (SELECT DISTINCT rid, i, m, item FROM dw JOIN bw USING (m, k)),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + m)) t(p) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

QUALITY = f"""
WITH d AS (SELECT rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {SPACED}) AS w,
                  doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS trusted FROM ({ROWS})),
tok AS (SELECT rid, trusted, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM d),
h AS (SELECT word, {crc32('word')} AS h FROM (SELECT DISTINCT word FROM tok)),
hw AS (SELECT rid, trusted, i, h FROM tok JOIN h USING (word)),
hl AS (SELECT rid, list(h ORDER BY i) AS h FROM hw GROUP BY rid),
pr AS (SELECT d.rid, d.doc_id, trusted, md5(text) AS m, coalesce(h, []::BIGINT[]) AS h,
              [(h[j] * {quality.PAIR} + h[j + 1]) % {quality.PRIME} FOR j IN range(1, len(h))] AS p FROM d LEFT JOIN hl USING (rid)),
q AS (SELECT rid, doc_id, trusted, m, CASE WHEN len(h) >= 4
        THEN [((p[j] * {quality.PAIR} + p[j + 2]) % {quality.PRIME} * {quality.MIX} % {quality.PRIME}) * 2147483648 + (p[j] * {quality.SECOND} + p[j + 2]) % {quality.PRIME} FOR j IN range(1, len(h) - 2)]
        ELSE [-1 - list_reduce(list_prepend(0::BIGINT, h), lambda a, x: (a * {quality.PAIR} + x) % {quality.PRIME})] END AS q FROM pr),
cl AS (SELECT *, list_min(q) AS least, list_max(q) AS most FROM q),
raw1 AS (SELECT * FROM cl QUALIFY row_number() OVER (PARTITION BY least ORDER BY doc_id NULLS FIRST, m) = 1),
tgt1 AS (SELECT * FROM cl WHERE trusted QUALIFY row_number() OVER (PARTITION BY least ORDER BY doc_id NULLS FIRST, m) = 1),
reps AS (SELECT rid, row_number() OVER (PARTITION BY most ORDER BY doc_id NULLS FIRST, m) = 1 AS raw, FALSE AS target FROM raw1
         UNION ALL SELECT rid, FALSE, row_number() OVER (PARTITION BY most ORDER BY doc_id NULLS FIRST, m) = 1 FROM tgt1),
one AS (SELECT rid, bool_or(raw) AS raw, bool_or(target) AS target FROM reps GROUP BY rid),
g AS (SELECT rid, h % {quality.BUCKETS} AS bucket FROM hw
      UNION ALL SELECT a.rid, (a.h * {quality.PAIR} + b.h) % {quality.BUCKETS} FROM hw a JOIN hw b ON a.rid = b.rid AND b.i = a.i + 1),
c AS (SELECT bucket, count(*) FILTER (raw) AS r, count(*) FILTER (target) AS t FROM g JOIN one USING (rid) GROUP BY bucket),
s AS (SELECT greatest(sum(r), 1)::DOUBLE AS rs, sum(t)::DOUBLE AS ts, greatest(sum(t)::DOUBLE * {quality.SMOOTHING}::DOUBLE / {float(quality.BUCKETS)}::DOUBLE, 1e-9::DOUBLE) AS ps FROM c),
lr AS (SELECT bucket, round((ln(t + ps) - ln(r::DOUBLE * ts / rs + ps)) * 1e6)::BIGINT AS weight FROM c, s),
score AS (SELECT rid, sum(weight)::BIGINT AS total FROM g JOIN lr USING (bucket) GROUP BY rid),
win AS (SELECT rid, i, array_to_string(list_slice(w, i, i + 7), ' ') AS k FROM d, unnest(range(1, len(w) - 6)) t(i)),
twice AS (SELECT rid, k FROM win GROUP BY rid, k HAVING count(*) > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM win JOIN twice USING (rid, k), unnest(range(i, i + 8)) t(p) GROUP BY rid),
ln AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, {SPACED}) GROUP BY rid),
f AS (SELECT d.rid, doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(ln.n, 0)::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(total, 0) AS total
      FROM d LEFT JOIN ln USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN score USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND total >= {quality.THRESHOLD} * (2 * n_words - 1) AS kept
FROM f
"""

SUBSTRINGS = f"""
WITH d AS (SELECT rid, doc_id, regexp_extract_all(coalesce(text, ''), {SPACED}) AS w FROM ({ROWS})),
win AS (SELECT rid, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS k FROM d, unnest(range(1, len(w) - 33)) t(i)),
twice AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, p FROM win JOIN twice USING (k), unnest(range(i, i + 35)) t(p)),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY p) AS txt, count(*) AS n FROM
         (SELECT rid, generate_subscripts(w, 1) AS p, unnest(w) AS x FROM d) ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(txt, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

SHARDING = f"""
WITH RECURSIVE d AS (SELECT rid, doc_id, coalesce(text, '') AS text, md5(coalesce(doc_id::VARCHAR, 'null')) AS h FROM ({ROWS})),
jump(rid, k, j, shard, grown) AS (
  SELECT rid, ('0x' || substr(h, 1, 16))::UBIGINT::HUGEINT, 0::BIGINT, 0::BIGINT, 0::BIGINT FROM d
  UNION ALL
  SELECT rid, k2, j2, CASE WHEN j2 < {sharding.SHARDS} THEN j2 ELSE shard END, CASE WHEN j2 < {sharding.SHARDS + 1} THEN j2 ELSE grown END
  FROM (SELECT rid, shard, grown, k2, floor((j + 1) * (2147483648.0::DOUBLE / ((k2 >> 33) + 1)::DOUBLE))::BIGINT AS j2
        FROM (SELECT rid, j, shard, grown, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM jump WHERE j < {sharding.SHARDS + 1}))),
last AS (SELECT rid, max(shard) AS shard, max(grown) AS grown FROM jump GROUP BY rid),
f AS (SELECT doc_id, (octet_length(encode(text)) + 8)::BIGINT AS size, ({crc32('text')})::BIGINT AS text_crc32, shard::INTEGER AS shard, grown::INTEGER AS grown_shard, ('0x' || substr(h, 17, 8))::BIGINT AS spread
      FROM d JOIN last USING (rid))
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY (spread + text_crc32) % {sharding.BUCKETS}, doc_id NULLS LAST, size, text_crc32, grown_shard) - 1)::BIGINT AS slot, grown_shard
FROM f
"""

MIXING = f"""
WITH d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), {SPACED}))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, {list(mixing.WEIGHTS)}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::INTEGER] AS weight,
             {mixing.CAP} * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS nth FROM w),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                / (sum(weight) OVER (ORDER BY nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level FROM o),
fr AS (SELECT min(nth) AS nth, min_by(level, nth) AS level FROM l WHERE level * weight < cap),
t AS (SELECT source, source_size, CASE WHEN l.nth >= fr.nth THEN fr.level * weight ELSE cap::DOUBLE END AS target FROM l, fr),
r AS (SELECT d.doc_id, size, t.source_size, target, CASE WHEN t.source_size > 0 THEN target / t.source_size ELSE 0 END AS rate,
             count(*) OVER same AS n, row_number() OVER same AS j,
             ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 13))::UBIGINT / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source WINDOW same AS (PARTITION BY doc_id, md5(coalesce(text, '')), d.source)),
e AS (SELECT *, n * (rate - floor(rate)) AS more FROM r)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN j <= floor(more) + CASE WHEN u < more - floor(more) THEN 1 ELSE 0 END THEN 1 ELSE 0 END))::BIGINT AS taken FROM e
"""

_TRIM = "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
LINES = f"""
WITH d AS (SELECT rid, doc_id, source, text FROM ({ROWS})),
l AS (SELECT rid, source, generate_subscripts(string_split(text, chr(10)), 1) AS p, unnest(string_split(text, chr(10))) AS line FROM d),
n AS (SELECT *, {_TRIM} AS x FROM l),
bad AS (SELECT x FROM n WHERE x <> '' GROUP BY x HAVING count(DISTINCT coalesce('s:' || source, 'null')) >= {lines.MIN_SITES}),
f AS (SELECT rid, string_agg(line, chr(10) ORDER BY p) FILTER (b.x IS NULL) AS txt, count(*) FILTER (n.x <> '') AS n_lines, count(b.x) AS n_removed
      FROM n LEFT JOIN bad b ON n.x = b.x GROUP BY rid)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(txt, '')) AS kept_sha256
FROM d LEFT JOIN f USING (rid)
"""


def _licenses() -> str:
    names = ", ".join(f"({t}, '{label}', {licenses._words(notice)}, {licenses._words(key)})" for t, (label, notice, key) in enumerate(licenses.TEMPLATES))
    base = ", ".join(f"('{label}', {licenses._words(p)})" for p, label in licenses.BASE)
    return f"""
WITH d AS (SELECT rid, doc_id, regexp_extract_all({LOWER}, {ALNUM}) AS w FROM ({ROWS})),
tok AS (SELECT rid, (generate_subscripts(w, 1) - 1)::BIGINT AS i, unnest(w) AS word FROM d),
tpl(t, label, notice, phrase) AS (VALUES {names}),
tw AS (SELECT t, word, min(p) - 1 AS p FROM (SELECT t, generate_subscripts(notice, 1) AS p, unnest(notice) AS word FROM tpl) GROUP BY t, word),
df AS (SELECT word, count(DISTINCT rid) AS df FROM tok GROUP BY word),
idx AS (SELECT t, word, p, count(*) OVER (PARTITION BY t) AS m FROM
        (SELECT t, word, p, row_number() OVER (PARTITION BY t ORDER BY coalesce(df, 0), word) AS r FROM tw LEFT JOIN df USING (word)) WHERE r <= {licenses.RARE}),
al AS (SELECT rid, t, i - p AS o, count(*) AS n, max(m) AS m FROM tok JOIN idx USING (word) GROUP BY rid, t, i - p
       HAVING count(*) >= greatest(1, ceil({licenses.SHARE} * max(m)))),
ok AS (SELECT rid, label, n / m AS share FROM al JOIN tpl USING (t) JOIN d USING (rid)
       WHERE o + list_position(list_transform(range(1, len(notice) + 1), lambda q: list_slice(notice, q, q + len(phrase) - 1) = phrase), true) - 1 >= 0
         AND list_slice(w, o + list_position(list_transform(range(1, len(notice) + 1), lambda q: list_slice(notice, q, q + len(phrase) - 1) = phrase), true),
                        o + list_position(list_transform(range(1, len(notice) + 1), lambda q: list_slice(notice, q, q + len(phrase) - 1) = phrase), true) + len(phrase) - 1) = phrase),
bp(label, phrase) AS (VALUES {base}),
bt AS (SELECT rid, i, label FROM tok JOIN bp ON tok.word = bp.phrase[1] JOIN d USING (rid) WHERE list_slice(w, i + 1, i + len(phrase)) = phrase),
b AS (SELECT rid, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM bt GROUP BY rid),
al2 AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM ok UNION ALL SELECT rid, label FROM bt) GROUP BY rid),
sc AS (SELECT rid, max(share) AS share FROM ok GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(al2.labels, '') AS labels, (CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END)::DOUBLE AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN al2 USING (rid) LEFT JOIN sc USING (rid)
"""


LICENSES = _licenses()

DIVERGENCE = rf"""
WITH d AS (SELECT rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM ({ROWS})),
tok AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM tok JOIN kept USING (lang, term) GROUP BY ALL),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS size FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
m AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (size + 5 * v))::BIGINT AS p
      FROM gn JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, (1 + (1000000000::HUGEINT * (sum(n) + 5)) // (max(total) + 5 * max(v)))::BIGINT AS q
      FROM m JOIN v USING (lang) JOIN (SELECT lang, sum(size) AS total FROM gn GROUP BY lang) USING (lang) GROUP BY lang, term),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM m a JOIN m b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM m JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM (FROM pairs UNION ALL FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
"""

PHRASES = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all({LOWER}, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, count(*) AS f
      FROM w, unnest(range(1, 5)) t(m), unnest(range(1, len(w) - m + 2)) u(i) GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
         FROM (SELECT *, array_to_string(list_slice(w, 1, k), ' ') AS x, array_to_string(list_slice(w, k + 1, m), ' ') AS y FROM cand, unnest(range(1, m)) t(k)) c
         JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, f, array_to_string(list_slice(w, i, i + z - 1), ' ') AS phrase FROM cand, unnest(range(2, m)) t(z), unnest(range(1, m - z + 2)) u(i)),
gone AS (SELECT DISTINCT b.lang, b.phrase FROM best b JOIN inner_ i ON b.lang = i.lang AND b.phrase = i.phrase WHERE 100 * i.f >= 80 * b.a)
SELECT lang, (row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase))::BIGINT AS rank, phrase, a, l, r, n, score
FROM (FROM best ANTI JOIN gone USING (lang, phrase)) JOIN total USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
