"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Sources in code point order with their weight; the level of the water, found from the sorted caps; the cells and
# places by which documents are taken once more; and the one document per source that changes sides.
ORACLE["op8_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
keyed AS (
  SELECT *, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
    md5('17:' || coalesce(doc_id::VARCHAR, '')) AS mark, len(size::VARCHAR) * 100 + left(size::VARCHAR, 2)::INT AS class
  FROM sized),
sources AS (
  SELECT skey, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
    (row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS weight
  FROM keyed GROUP BY skey),
fills AS (
  SELECT *, sum(cap) OVER w - cap AS before, sum(weight) OVER (ORDER BY cap / weight DESC, skey DESC) AS open,
    (SELECT sum(source_size) FROM sources) AS total
  FROM sources WINDOW w AS (ORDER BY cap / weight, skey)),
levels AS (SELECT *, (total - before) / open AS level FROM fills),
water AS (SELECT max(level) AS level FROM (SELECT level FROM levels WHERE cap > weight * level ORDER BY cap / weight, skey LIMIT 1)),
targets AS (
  SELECT skey, source_size, least(cap::DOUBLE, weight * coalesce((SELECT level FROM water), 0)) AS target FROM sources),
rated AS (
  SELECT k.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY k.skey ORDER BY class, left(mark, 2), size, mark, doc_id) AS place
  FROM keyed k JOIN targets t ON t.skey = k.skey),
drawn AS (
  SELECT *, floor((rate - floor(rate)) * place + 0.5) - floor((rate - floor(rate)) * (place - 1) + 0.5) AS extra FROM rated),
missing AS (SELECT skey, any_value(target) - sum((floor(rate) + extra) * size) AS missing FROM drawn GROUP BY skey),
changes AS (
  SELECT d.skey, d.place, sign(m.missing) AS change FROM drawn d JOIN missing m ON m.skey = d.skey
  WHERE rate > floor(rate) AND extra = CASE WHEN missing > 0 THEN 0 ELSE 1 END AND abs(abs(missing) - size) < abs(missing)
  QUALIFY row_number() OVER (PARTITION BY d.skey ORDER BY abs(abs(missing) - size), d.place) = 1)
SELECT d.doc_id, d.size, d.source_size, d.target, ((floor(rate) + extra + coalesce(change, 0)) * size)::BIGINT AS taken
FROM drawn d LEFT JOIN changes c ON c.skey = d.skey AND c.place = d.place
"""

ORACLE["op7_warc_round_trip"] = """
WITH bodies AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
digests AS (
  SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
    CASE WHEN octet_length(body) >= 1000 THEN max(page_id) OVER (PARTITION BY body) END AS response
  FROM bodies)
SELECT page_id, payload_bytes, payload_digest, TRUE AS verified,
  CASE WHEN response <> page_id OR (page_id IS NULL AND response IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN response <> page_id OR (page_id IS NULL AND response IS NOT NULL) THEN response END AS refers_to
FROM digests
"""

# Patterns as the scan has them, but that this dialect knows no look-around: a random-looking value is a whole run of
# its characters with a digit and letters of both cases in it.
_KINDS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
    "linked_id": r"""\b(?:A(?:SIA|ROA|IDA)[A-Z0-9]{12,}|(?:client_id|user(?:name)?|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,})""",
    "linked_secret": r"[A-Za-z0-9+/_-]{20,}",
    "linked_endpoint": r"""(?:https?|ftp|s3|jdbc|amqp|redis|mysql|postgres(?:ql)?|mongodb)://[^\s"'<>]+""",
    "break": r"\n[\x20\x09\r]*\n",
}
_KEPT = {
    "assign": f"len(regexp_extract(match, '{_KINDS['assign'].replace(chr(39), chr(39) * 2)}', 1)) >= 12",
    "linked_secret": "regexp_matches(match, '[0-9]') AND regexp_matches(match, '[A-Z]') AND regexp_matches(match, '[a-z]')",
}


def _found(order: int, kind: str) -> str:
    pattern = "'" + _KINDS[kind].replace("'", "''") + "'"
    return f"""
  SELECT doc, '{kind}' AS kind, {order} AS kind_order, match, end_ - len(match) AS start_, end_ FROM (
    SELECT doc, match, sum(len(gap) + len(match)) OVER (PARTITION BY doc ORDER BY n) AS end_ FROM (
      SELECT doc, unnest(whole) AS match, unnest(gaps[1:len(whole)]) AS gap, unnest(range(len(whole))) AS n FROM (
        SELECT doc, regexp_extract_all(x, {pattern}) AS whole, string_split_regex(x, {pattern}) AS gaps
        FROM docs WHERE regexp_matches(x, {pattern})))) WHERE {_KEPT.get(kind, "TRUE")}"""


ORACLE["op4_secret_links"] = f"""
WITH docs AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS x FROM documents),
parts AS ({" UNION ALL ".join(_found(i, k) for i, k in enumerate(_KINDS))}),
strong AS (SELECT * FROM parts WHERE kind IN ('assign', 'access', 'hex')),
placed AS (
  SELECT p.*, CASE WHEN kind IN ('access', 'linked_id') THEN 'id' WHEN kind = 'linked_endpoint' THEN 'endpoint'
      ELSE 'secret' END AS role,
    (SELECT count(*) FROM parts b WHERE b.doc = p.doc AND b.kind = 'break' AND b.start_ < p.start_) AS scope
  FROM parts p WHERE kind <> 'break' AND (kind NOT LIKE 'linked%' OR NOT EXISTS (
    SELECT 1 FROM strong s WHERE s.doc = p.doc AND s.start_ < p.end_ AND p.start_ < s.end_))),
near AS (
  SELECT w.doc, w.kind, w.kind_order, w.start_, w.end_, w.role, bool_or(o.role = 'id') AS has_id, bool_or(o.role = 'secret') AS has_secret
  FROM placed w JOIN placed o ON o.doc = w.doc AND o.scope = w.scope AND abs(o.start_ - w.start_) <= 300
  WHERE w.kind LIKE 'linked%' GROUP BY ALL),
found AS (
  SELECT doc, kind, kind_order, start_, end_ FROM strong
  UNION ALL SELECT doc, kind, kind_order, start_, end_ FROM near
  WHERE CASE role WHEN 'secret' THEN has_id WHEN 'id' THEN has_secret ELSE has_id AND has_secret END),
digests AS (
  SELECT doc, string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, kind_order, end_) AS spans,
    string_agg(kind || ':' || start_ || ':' || end_, ',' ORDER BY start_, kind_order, end_) FILTER (WHERE kind NOT LIKE 'linked%') AS base,
    count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex
  FROM found GROUP BY doc)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN digests g ON g.doc = d.doc
"""

# Five flags per document as a bit mask; documents left by every set of filters that ran, for all orders.
ORACLE["op11_filter_audit"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
flagged AS (
  SELECT doc_id, part,
    (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * len(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS flags
  FROM texts),
judged AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
counted AS (
  SELECT part, flags, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM flagged LEFT JOIN judged USING (doc_id) GROUP BY part, flags),
orders AS (
  SELECT '' AS filter_order, 0 AS done, 0 AS bit, 0 AS step
  UNION ALL
  SELECT filter_order || letter, done | (1 << k), 1 << k, step + 1
  FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([0, 1, 2, 3, 4]) AS k) WHERE done & (1 << k) = 0),
whole AS (SELECT filter_order FROM orders WHERE step = 5),
steps AS (
  SELECT w.filter_order, o.step, o.bit, o.done, o.done - o.bit AS before
  FROM whole w JOIN orders o ON o.step > 0 AND left(w.filter_order, o.step) = o.filter_order),
rows_ AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (WHERE flags & done = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE flags & before = 0 AND flags & bit > 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE flags & before > 0 AND flags & bit > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE flags = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE flags & before = 0 AND flags & bit > 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE flags & before = 0 AND flags & bit > 0), 0)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM rows_
"""

# Words of pieces in order, counts of one, two and three of them, the lowest cut, and what longer phrases cover.
ORACLE["op12_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, row_number() OVER () AS id,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
ones AS (SELECT lang, unnest(words) AS phrase FROM split),
first_words AS (SELECT lang, phrase, count(*) AS a FROM ones GROUP BY lang, phrase),
totals AS (SELECT lang, sum(a) AS n FROM first_words GROUP BY lang),
windows AS (
  SELECT lang, words[i : i + 1] AS two, CASE WHEN i + 2 <= len(words) THEN words[i : i + 2] END AS three
  FROM (SELECT lang, words, unnest(range(1, len(words))) AS i FROM split)),
two AS (SELECT lang, two AS words, count(*) AS a FROM windows GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, three AS words, count(*) AS a FROM windows WHERE three IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, words, max(a) AS longest FROM (
    SELECT lang, words[1:2] AS words, a FROM three UNION ALL SELECT lang, words[2:3], a FROM three) GROUP BY lang, words),
cuts AS (
  SELECT t.lang, t.words, t.a, 1 AS k, x.a AS l, y.a AS r
  FROM two t JOIN first_words x ON x.lang = t.lang AND x.phrase = t.words[1]
  JOIN first_words y ON y.lang = t.lang AND y.phrase = t.words[2]
  LEFT JOIN longer g ON g.lang = t.lang AND g.words = t.words
  WHERE g.longest IS NULL OR 100 * g.longest < 50 * t.a
  UNION ALL
  SELECT t.lang, t.words, t.a, 1, x.a, y.a
  FROM three t JOIN first_words x ON x.lang = t.lang AND x.phrase = t.words[1] JOIN two y ON y.lang = t.lang AND y.words = t.words[2:3]
  UNION ALL
  SELECT t.lang, t.words, t.a, 2, x.a, y.a
  FROM three t JOIN two x ON x.lang = t.lang AND x.words = t.words[1:2] JOIN first_words y ON y.lang = t.lang AND y.phrase = t.words[3]),
scored AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score, array_to_string(words, ' ') AS phrase FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score FROM lowest)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
