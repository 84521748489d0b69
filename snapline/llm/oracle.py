"""The corpus queries in plain SQL for another engine, where SQL can express them.

Not expressed: toxicity and language (trained models), tested by held-out accuracy and against plain Python, the mix (drawn
by a hash that the other engine lacks), whose targets are tested against SQL, and packing (token ids), tested by round trip and brute force.
"""

from __future__ import annotations

from snapline.llm import secrets
from snapline.llm.quality import STOP_WORDS
from snapline.llm.urls import RULES

WORD = r"[^\x20\x09-\x0D]+"

_stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

OP1 = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines,
    row_number() OVER () AS r FROM documents),
windows AS (SELECT r, p, array_to_string(w[p:p + 7], ' ') AS x FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS p FROM w WHERE len(w) >= 8)),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest(range(p, p + 8)) AS i FROM twice) GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, length(regexp_replace(t, '[^!?]+', '', 'g')) AS marks,
    length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS capitals, len(list_filter(w, lambda x: lower(x) IN ({_stops}))) AS stops
  FROM w LEFT JOIN covered c ON c.r = w.r),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words <= 1000000 AND word_chars >= 2 * n_words AND word_chars <= 20 * n_words
    AND n_symbols / CAST(n_words AS DOUBLE) <= CAST(0.3 AS DOUBLE) AND marks / CAST(n_words AS DOUBLE) <= CAST(0.5 AS DOUBLE)
    AND capitals / CAST(word_chars AS DOUBLE) <= CAST(0.5 AS DOUBLE) AND stops / CAST(n_words AS DOUBLE) >= CAST(0.01 AS DOUBLE)
    AND n_dup_lines / CAST(n_lines AS DOUBLE) <= CAST(0.5 AS DOUBLE) AND n_repeat_words / CAST(n_words AS DOUBLE) <= CAST(0.3 AS DOUBLE) AS kept
FROM b
"""

OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP2 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s AS MATERIALIZED (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight FROM d GROUP BY source),
level AS (SELECT 1 AS round, (SELECT sum(source_size) FROM s) / (SELECT sum(weight) FROM s) AS x
  UNION ALL
  SELECT round + 1, ((SELECT CAST(sum(source_size) AS DOUBLE) FROM s)
      - (SELECT coalesce(sum(CASE WHEN level.x * weight > 3 * source_size THEN 3.0::DOUBLE * source_size ELSE 0 END), 0) FROM s))
    / (SELECT sum(CASE WHEN level.x * weight > 3 * source_size THEN 0 ELSE weight END) FROM s)
  FROM level WHERE round < 60 AND (SELECT count(*) FROM s WHERE level.x * weight <= 3 * source_size) > 0)
SELECT d.doc_id, d.size, s.source_size, least((SELECT max(x) FROM level) * s.weight, 3.0::DOUBLE * s.source_size) AS target
FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
"""

_rules = ", ".join("('{}', '{}', '{}', '{}')".format(r.split("/")[0], "/" + r.split("/", 1)[1], r, v) for r, v in RULES)

OP6 = rf"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS r FROM pages),
rules AS (SELECT * FROM (VALUES {_rules}) AS t(rule_host, rule_path, rule, verdict)),
best AS (SELECT r, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM u JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY r)
SELECT page_id, host, path, b.rule, coalesce(b.verdict,
  CASE WHEN regexp_matches(host, '(^|[.-])(spam|phish|malware|casino|xxx|porn|warez)') THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN best b ON b.r = u.r
"""

_lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS r FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
patterns AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[p:p + 9], ' ') AS x
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM patterns),
places AS (SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS x FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, sizes WHERE len(w) >= k)),
hits AS (SELECT r, p, places.k, item FROM places JOIN patterns ON places.k = patterns.k AND places.x = patterns.x),
words AS (SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest(range(p, p + k)) AS i FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.r = d.r LEFT JOIN items ON items.r = d.r
"""

OP8 = """
WITH RECURSIVE t AS (SELECT conv_id, turn, role, text, coalesce(length(text), 0) AS n, to_json(coalesce(text, ''))::VARCHAR AS q FROM conversations),
calls AS (SELECT conv_id, turn, concat('call_', turn) AS call_id, ['search', 'translate', 'summarize', 'plan'][1 + n % 4] AS name, n, q,
    CASE WHEN n % 3 = 0 THEN concat('call_', turn - 2) END AS after FROM t WHERE role = 'assistant'),
results AS (SELECT conv_id, turn, concat('call_', turn - 1) AS call_id, text FROM t WHERE role = 'user' AND turn > 0),
up AS (SELECT c.*, p.call_id AS parent FROM calls c LEFT JOIN calls p ON p.conv_id = c.conv_id AND p.call_id = c.after),
depth AS (SELECT conv_id, call_id, 0 AS d FROM up WHERE parent IS NULL
  UNION ALL SELECT u.conv_id, u.call_id, d + 1 FROM up u JOIN depth ON depth.conv_id = u.conv_id AND depth.call_id = u.parent),
bad AS (SELECT u.conv_id, u.call_id, u.turn, d, r.turn IS NULL AS unanswered, r.text, q, n, name,
    concat_ws('; ', CASE WHEN after IS NOT NULL AND parent IS NULL THEN 'needs an unknown call' END,
      CASE WHEN name = 'plan' THEN 'unknown tool' END,
      CASE WHEN name = 'translate' AND n % 13 = 0 THEN 'deep is missing' END,
      CASE WHEN name IN ('search', 'translate') AND n % 11 = 0 THEN 'limit is not integer' END,
      CASE WHEN name = 'summarize' THEN 'limit is unknown' END) AS errors
  FROM up u JOIN depth ON depth.conv_id = u.conv_id AND depth.call_id = u.call_id LEFT JOIN results r ON r.conv_id = u.conv_id AND r.call_id = u.call_id),
placed AS (
  SELECT conv_id, call_id, turn, d, NULL::VARCHAR AS role, NULL::VARCHAR AS tie, CASE WHEN unanswered THEN 1 ELSE 2 END AS turns, CASE WHEN unanswered THEN 'unanswered' ELSE 'linked' END AS status, errors,
    concat('{"arguments":{', CASE WHEN n % 13 = 0 THEN '' ELSE '"deep":{"a":null,"b":true},' END, '"limit":', CASE WHEN n % 11 = 0 THEN concat('"', n % 50, '"') ELSE CAST(n % 50 AS VARCHAR) END,
      ',"query":', q, '},"id":"', call_id, '","name":"', name, '","result":', coalesce(to_json(text)::VARCHAR, 'null'), '}') AS message
  FROM bad
  UNION ALL
  SELECT r.conv_id, r.call_id, r.turn, 2147483647, NULL, NULL, 1, 'orphan', '', concat('{"arguments":null,"id":"', r.call_id, '","name":null,"result":', coalesce(to_json(text)::VARCHAR, 'null'), '}')
  FROM results r WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = r.conv_id AND c.call_id = r.call_id)
  UNION ALL
  SELECT conv_id, NULL, turn, CASE WHEN role = 'system' THEN -2 ELSE -1 END, role, md5(coalesce(text, '')), 1, 'message', '',
    concat('{"content":', coalesce(to_json(text)::VARCHAR, 'null'), ',"role":', coalesce(to_json(role)::VARCHAR, 'null'), '}')
  FROM t WHERE NOT coalesce(role = 'assistant' OR (role = 'user' AND turn > 0), false))
SELECT conv_id, call_id, row_number() OVER (PARTITION BY conv_id ORDER BY d, turn, call_id, role, tie) - 1 AS position, status, errors, message, turns::BIGINT AS turns FROM placed
"""




def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _matches(name: str, pattern: str, kind: int, texts: str = "d") -> str:
    """Spans of all matches: the i-th begins after the gaps up to it and the matches before it."""
    p = _quoted(pattern)
    return rf"""{name} AS (SELECT r, {kind} AS kind, start, start + length(hit) AS finish, hit FROM (
  SELECT r, hits[i] AS hit, coalesce(list_sum(list_transform(gaps[1:i], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS start
  FROM (SELECT r, gaps, hits, unnest(range(1, len(hits) + 1)) AS i
    FROM (SELECT r, regexp_split_to_array(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS hits FROM {texts}))))"""


_classes = " ".join(f"WHEN regexp_matches(hit, '{shape}') THEN CAST({least} AS DOUBLE)" for _, shape, least in secrets.CLASSES)

OP3 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
{_matches("assigned", secrets.ASSIGN, 0)},
{_matches("access", secrets.ACCESS, 1)},
{_matches("hexes", secrets.HEX, 2)},
base AS (SELECT r, kind, start, finish FROM assigned WHERE length(regexp_extract(hit, '{_quoted(secrets.ASSIGN)}', 1)) >= 6
  UNION ALL SELECT r, kind, start, finish FROM access UNION ALL SELECT r, kind, start, finish FROM hexes),
covered AS (SELECT DISTINCT r, unnest(range(CAST(start AS BIGINT), CAST(finish AS BIGINT))) AS i FROM base),
letters AS (SELECT r, t, unnest(range(0, length(t))) AS i FROM d WHERE r IN (SELECT r FROM base)),
blanked AS (SELECT l.r, string_agg(CASE WHEN c.i IS NULL THEN substring(t, CAST(l.i + 1 AS BIGINT), 1) ELSE ' ' END, '' ORDER BY l.i) AS t
  FROM letters l LEFT JOIN covered c ON c.r = l.r AND c.i = l.i GROUP BY l.r),
shown AS (SELECT r, t FROM blanked UNION ALL SELECT r, t FROM d WHERE r NOT IN (SELECT r FROM base)),
{_matches("candidates", secrets.CANDIDATE, 3, "shown")},
fair AS (SELECT * FROM candidates WHERE NOT regexp_matches(hit, '{"|".join(x for x in secrets.ALLOWED if x != secrets.SLUG)}')
  AND NOT (regexp_matches(hit, '{secrets.SLUG}') AND len(list_filter(string_split_regex(hit, '[^a-z0-9]+'), lambda x:
    (length(x) >= 16 AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '[a-z]')) OR (length(x) >= 8 AND regexp_matches(x, '[0-9][a-z]+[0-9]')))) = 0)),
chars AS (SELECT r, start, hit, pos, substring(hit, CAST(pos + j AS BIGINT), 1) AS c
  FROM (SELECT r, start, hit, pos, unnest(range(1, {secrets.SPAN + 1})) AS j FROM (SELECT r, start, hit, unnest(range(0, length(hit) - {secrets.SPAN} + 1)) AS pos FROM fair))),
entropy AS (SELECT r, start, hit, pos, -sum(n / CAST({secrets.SPAN} AS DOUBLE) * log2(n / CAST({secrets.SPAN} AS DOUBLE))) AS bits
  FROM (SELECT r, start, hit, pos, c, count(*) AS n FROM chars GROUP BY ALL) GROUP BY ALL),
added AS (SELECT r, 3 AS kind, start + min(pos) AS start, start + max(pos) + {secrets.SPAN} AS finish FROM entropy
  WHERE bits >= CASE {_classes} END - CAST(1e-9 AS DOUBLE) GROUP BY r, start, hit),
spans AS (SELECT *, concat(['assign', 'access', 'hex', 'entropy'][kind + 1], ':', CAST(start AS BIGINT), ':', CAST(finish AS BIGINT)) AS span
  FROM (SELECT * FROM base UNION ALL SELECT * FROM added)),
told AS (SELECT r, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h,
    string_agg(span, ',' ORDER BY start, kind, finish) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind, finish) AS spans FROM spans GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told ON told.r = d.r
"""

_steps = ", ".join(f"c{i} AS (SELECT cap, {''.join(f'e{j}, ' for j in range(i))}coalesce(g.upto, e{i - 1}) AS e{i}, coalesce(g.upto, e{i - 1}) + cap AS aim FROM c{i - 1} ASOF LEFT JOIN g ON c{i - 1}.aim >= g.upto)" for i in range(1, 9))
_cuts = " + ".join(f"CASE WHEN upto > e{i} THEN 1 ELSE 0 END" for i in range(1, 8))

OP9 = f"""
WITH RECURSIVE bits AS (SELECT CAST(i AS UBIGINT) AS i, 0 AS k, CAST(i AS UBIGINT) AS c FROM range(256) AS x(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, text, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size, row_number() OVER () AS r FROM documents),
codes AS (SELECT text, h, t, list_transform(range(0, CAST(length(h) / 2 AS BIGINT)),
    lambda i: CAST(16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1 AS UBIGINT)) AS bytes
  FROM (SELECT DISTINCT text, hex(encode(text)) AS h FROM d WHERE text IS NOT NULL), crc),
sums AS MATERIALIZED (SELECT text, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), bytes), lambda c, b: xor(c >> 8, t[CAST(1 + (xor(c, b) & 255) AS BIGINT)])), CAST(4294967295 AS UBIGINT)) AS crc FROM codes),
groups AS (SELECT text, min(doc_id) AS first_id, CAST(sum(size) AS BIGINT) AS size FROM d GROUP BY text),
g AS MATERIALIZED (SELECT text, first_id, size, CAST(sum(size) OVER (ORDER BY first_id) AS BIGINT) AS upto FROM groups),
t AS (SELECT max(upto) AS total, max(size) AS largest, greatest(max(size), CAST(ceil(max(upto) / 8) AS BIGINT)) AS low FROM g),
c0 AS (SELECT cap, 0 AS e0, cap AS aim FROM (SELECT unnest(range(low, low + largest + 1)) AS cap FROM t)), {_steps},
best AS (SELECT * FROM c8 WHERE e8 = (SELECT total FROM t) ORDER BY cap LIMIT 1),
placed AS (SELECT text, first_id, {_cuts} AS shard FROM g, best)
SELECT d.doc_id, d.size, CAST(sums.crc AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY first_id, d.doc_id, d.r) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM d JOIN placed ON placed.text IS NOT DISTINCT FROM d.text LEFT JOIN sums ON sums.text = d.text
"""


# The checksum of an id's digits, by the table of a polynomial, as in OP9.
OP11 = rf"""
WITH RECURSIVE bits AS (SELECT CAST(i AS UBIGINT) AS i, 0 AS k, CAST(i AS UBIGINT) AS c FROM range(256) AS x(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
    CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
      lambda c, b: xor(c >> 8, t[CAST(1 + (xor(c, b) & 255) AS BIGINT)])), CAST(4294967295 AS UBIGINT)) AS BIGINT) AS h FROM documents, crc),
a AS (SELECT *, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (SELECT *, CAST(1 + floor((len(w) - a) / (3 + g % 8)) AS BIGINT) AS p FROM a),
texts AS (SELECT doc_id, r, CASE WHEN h % 10 = 0 AND len(w) > 0
    THEN list_transform(range(0, len(w)), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM p),
words AS MATERIALIZED (SELECT r, len(w) AS n, i, w[i + 1] AS x FROM (SELECT r, w, unnest(range(0, len(w))) AS i FROM texts)),
same AS (SELECT a.r, b.i - a.i AS q, a.i, a.i - row_number() OVER (PARTITION BY a.r, b.i - a.i ORDER BY a.i) AS island
  FROM words a JOIN words b ON a.r = b.r AND a.x = b.x AND a.i < b.i AND 4 * (b.i - a.i) <= a.n),
stretches AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM same GROUP BY r, q, island),
longs AS MATERIALIZED (SELECT * FROM stretches WHERE length >= greatest(6, 4 * q)),
runs AS MATERIALIZED (SELECT r, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(q AS BIGINT) AS period FROM longs x WHERE NOT EXISTS
  (SELECT 1 FROM longs y WHERE y.r = x.r AND y.q < x.q AND y.start <= x.start AND y.start + y.length >= x.start + x.length)),
told AS (SELECT r, count(*) AS n, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
    first(struct_pack(s := start, l := length, p := period) ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS best FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(told.n, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period, 1000 * best.l // best.p AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM texts LEFT JOIN told ON told.r = texts.r LEFT JOIN kept ON kept.r = texts.r
"""

_terms = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP13 = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_lower}, '{_terms}') AS w FROM documents),
i AS (SELECT item_id, row_number() OVER () AS k, regexp_extract_all({_lower}, '{_terms}') AS w FROM benchmark),
wanted AS (SELECT DISTINCT k, unnest(w) AS x FROM i),
held AS (SELECT r, doc_id, n, x, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS x FROM d) GROUP BY ALL),
totals AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
weights AS (SELECT x, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * coalesce(df, 0) + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM (SELECT DISTINCT x FROM wanted) LEFT JOIN (SELECT x, count(*) AS df FROM held GROUP BY x) USING (x), totals),
scores AS (SELECT k, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (x) JOIN held USING (x), totals GROUP BY k, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN i USING (k) WHERE rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": OP1, "op3_secret_scan": OP3, "op5_minhash_dedup": OP5, "op6_url_filter": OP6, "op7_decontamination": OP7, "op8_chat_format": OP8, "op9_sharding": OP9, "op11_periodic_runs": OP11, "op13_lexical_search": OP13}
