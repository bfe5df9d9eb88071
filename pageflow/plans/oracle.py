"""The same answers as plain SQL over the same tables, for checking."""

from __future__ import annotations

# Fixed values, written out here again so that a slip in the library shows.
SENTINEL_REFERRERS = ("other-internal", "other-search", "other-external", "other-empty", "other-other")
INDEX_EXCLUDES = (
    "a", "an", "the", "and", "or", "but", "is", "are", "was", "were",
    "be", "been", "being", "have", "has", "had", "do", "does", "did",
    "not", "no", "of", "off", "in", "on", "at", "by", "with", "about",
    "into", "to", "from", "up", "out", "over", "under",
    "I", "you", "he", "she", "it", "we", "they", "me", "my", "mine",
    "our", "ours", "your", "yours", "his", "her", "its", "their", "theirs",
    *SENTINEL_REFERRERS,
)
POINT_WORDS = ("small", "brand", "ring", "absent", "r")
POINT_PAGES = ("small ring", "economy brushed", "promo", "other-search", "absent")
LINE_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
EXTRA_TERMS = (
    "zzzz no such page", "!!!", "", "ring ring small", "the small ring", "Small_Ring_(Brand#12)", "brand",
    "The that, Ist", "de la las los", "für", "r",
)
RESPONSE_PAGE_ROWS = 100


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items: tuple[str, ...]) -> str:
    return ", ".join(_literal(i) for i in items)


SENTINELS = _list(SENTINEL_REFERRERS)
EXCLUDES = _list(INDEX_EXCLUDES)
EXTRA = ", ".join(f"({_literal(t)})" for t in EXTRA_TERMS) + ", (NULL)"
BLANKS = _literal(LINE_BLANKS)


def _sentinel(number: str) -> str:
    return f"([{SENTINELS}])[({number}) % 5 + 1]"


def _title(at: str) -> str:
    return (
        f"CASE ({at}) % 3 WHEN 1 THEN l[{at}] WHEN 2 THEN l[{at}] || '_' || l[{at} - 1] "
        f"ELSE l[{at}] || '_(' || l[{at} - 1] || ')' END"
    )


def _display(name: str) -> str:
    spaced = f"regexp_replace(lower({name}), '[\\s_-]+', ' ', 'g')"
    capital = f"array_to_string(list_transform(string_split({spaced}, ' '), lambda x: upper(x[1:1]) || x[2:]), ' ')"
    return f"CASE WHEN {name} IN ({SENTINELS}) THEN {name} ELSE {capital} END"


TRAFFIC = f"""
page_links AS (
  SELECT page_id AS id, regexp_extract_all(html, '<a[^>]*>([^<]*)</a>', 1) AS l FROM pages),
page_steps AS (SELECT id, l, unnest(range(1, len(l) + 1)) AS pos FROM page_links),
page_lines AS (
  SELECT 0 AS src, id, pos,
    concat_ws(chr(9),
      CASE WHEN pos = 1 THEN {_sentinel("id")} ELSE {_title("(pos - 1)")} END,
      {_title("pos")},
      CASE WHEN pos = 1 THEN 'external' WHEN (id // 10) % 5 = 0 THEN 'other' ELSE 'link' END,
      (10 + (id * 7 + pos * 13) % 100)::VARCHAR) AS value
  FROM page_steps),
catalogue_steps AS (
  SELECT p_partkey, p_size, 1 AS pos, {_sentinel("p_partkey")} AS a, p_type AS b, 'external' AS kind FROM part
  UNION ALL SELECT p_partkey, p_size, 2, p_type, replace(p_name, ' ', '_'), 'link' FROM part
  UNION ALL SELECT p_partkey, p_size, 3, replace(p_name, ' ', '_'),
    replace(p_name, ' ', '_') || '_(' || p_brand || ')', 'link' FROM part),
catalogue_lines AS (
  SELECT 1 AS src, p_partkey AS id, pos, concat_ws(chr(9), a, b, kind, (p_size + pos)::VARCHAR) AS value
  FROM catalogue_steps),
traffic AS (SELECT * FROM page_lines UNION ALL SELECT * FROM catalogue_lines)
"""

DIRTY = """
dirty AS (
  SELECT src, id, pos, CASE
    WHEN (id * 37 + pos) % 17 = 0 THEN regexp_replace(value, '\\t[^\\t]*$', '')
    WHEN (id * 37 + pos) % 19 = 0 THEN regexp_replace(value, '\\t[^\\t]*$', '') || chr(9) || 'x'
    WHEN (id * 37 + pos) % 23 = 0 THEN value || chr(9) || 'extra'
    WHEN (id * 37 + pos) % 29 = 0 THEN '  ' || value || chr(9)
    WHEN (id * 37 + pos) % 31 = 0 THEN regexp_replace(value, '^[^\\t]*\\t', chr(9))
    ELSE value END AS value
  FROM traffic)
"""

BIGRAMS = """
text_words AS (
  SELECT doc_id AS id, string_split(regexp_replace(text, '[\\t\\n\\r]', '_', 'g'), ' ') AS w FROM documents),
text_steps AS (SELECT id, w, unnest(range(1, len(w))) AS pos FROM text_words),
bigrams AS (
  SELECT 2 AS src, id, pos, concat_ws(chr(9), w[pos], w[pos + 1], 'link', '1') AS value FROM text_steps)
"""


def _parsed(lines: str, name: str = "parsed") -> str:
    return f"""
{name}_fields AS (SELECT * REPLACE (trim(value, {BLANKS}) AS value) FROM {lines}),
{name}_split AS (SELECT *, string_split(value, chr(9)) AS f FROM {name}_fields),
{name}_cast AS (
  SELECT * EXCLUDE (f), f[1] AS referrer, f[2] AS resource, f[3] AS type, len(f) AS n_fields,
    CASE WHEN regexp_full_match(f[4], '[+-]?[0-9]+') THEN TRY_CAST(f[4] AS BIGINT) END AS count
  FROM {name}_split),
{name} AS (
  SELECT *, count IS NOT NULL AND coalesce(referrer, '') <> '' AND coalesce(resource, '') <> '' AS valid
  FROM {name}_cast)
"""


def _normal(parsed: str = "parsed", name: str = "normal") -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (value, n_fields, valid) REPLACE (
    CASE WHEN referrer IN ({SENTINELS}) THEN referrer
      ELSE lower(regexp_replace(referrer, '[^a-zA-Z0-9]', ' ', 'g')) END AS referrer,
    lower(regexp_replace(resource, '[^a-zA-Z0-9 ]', ' ', 'g')) AS resource)
  FROM {parsed} WHERE valid)
"""


EDGES = """
edges AS (
  SELECT referrer, resource, arg_min(type, (src, id, pos)) AS type, sum(count)::BIGINT AS count
  FROM normal GROUP BY referrer, resource)
"""


def _index(edges: str = "edges", name: str = "word_index") -> str:
    return f"""
{name}_words AS (
  SELECT resource, unnest(string_split(regexp_replace(resource, '[^a-zA-Z0-9 ]', ' ', 'g'), ' ')) AS w
  FROM (SELECT DISTINCT resource FROM {edges})),
{name} AS (
  SELECT DISTINCT lower(w) AS word, resource FROM {name}_words
  WHERE w <> '' AND w NOT IN ({EXCLUDES}) AND lower(w) NOT IN ({EXCLUDES}))
"""


TERMS = f"""
terms AS (
  SELECT upper(p_name) AS term FROM part UNION SELECT p_brand FROM part UNION SELECT p_type FROM part
  UNION SELECT * FROM (VALUES {EXTRA})),
norms AS (
  SELECT term, trim(regexp_replace(regexp_replace(lower(term), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS norm
  FROM terms),
prepared AS (
  SELECT term, norm, string_split(norm, ' ') AS words,
    CASE WHEN coalesce(norm, '') = '' THEN 'invalid' ELSE 'ok' END AS status FROM norms),
query_words AS (
  SELECT *, unnest(words) AS word, unnest(range(0, len(words))) AS position FROM prepared)
"""

TEXT_TERMS = TERMS.replace(
    "UNION SELECT * FROM (VALUES",
    "UNION SELECT unnest(string_split(text, ' ')) FROM benchmark UNION SELECT * FROM (VALUES",
)

HITS = """
hits AS (
  SELECT q.term, q.norm, q.words, q.position, x.resource
  FROM query_words q JOIN word_index x ON q.word = x.word),
related AS (
  SELECT term, resource, count(*) AS matches, min(position) AS first_word FROM hits GROUP BY term, resource)
"""

SELECTED = """
choices AS (
  SELECT term, resource AS selected, resource = norm AS is_exact,
    row_number() OVER (PARTITION BY term ORDER BY resource <> norm, length(resource), position, resource) AS n
  FROM hits
  WHERE resource = norm OR len(list_filter(words, lambda w: NOT contains(resource, w))) = 0),
selection AS (SELECT term, selected, is_exact FROM choices WHERE n = 1)
"""

FOUND = """
incoming AS (
  SELECT s.term, s.selected, e.resource, e.referrer, e.type, e.count,
    row_number() OVER (PARTITION BY s.term ORDER BY e.count DESC, e.referrer) AS rank
  FROM selection s JOIN edges e ON e.resource = s.selected),
outgoing AS (
  SELECT s.term, s.selected, e.resource, e.referrer, e.type, e.count,
    row_number() OVER (PARTITION BY s.term ORDER BY e.count DESC, e.resource) AS rank
  FROM selection s JOIN edges e ON e.referrer = s.selected)
"""

RESPONSE = f"""
listed AS (
  SELECT r.term, r.resource,
    row_number() OVER (PARTITION BY r.term ORDER BY r.first_word, r.resource) AS rank
  FROM related r LEFT JOIN selection s ON s.term = r.term
  WHERE r.resource IS DISTINCT FROM s.selected),
entries AS (
  SELECT term, 'related' AS section, rank, {_display("resource")} AS entry FROM listed
  UNION ALL SELECT term, 'incoming', rank,
    concat_ws('|', {_display("referrer")}, {_display("resource")}, type, count::VARCHAR) FROM incoming
  UNION ALL SELECT term, 'outgoing', rank,
    concat_ws('|', {_display("referrer")}, {_display("resource")}, type, count::VARCHAR) FROM outgoing),
paged AS (
  SELECT term, section, ((rank - 1) // {RESPONSE_PAGE_ROWS})::BIGINT AS page, rank, entry FROM entries
  UNION ALL SELECT term, NULL, 0, NULL, NULL FROM prepared),
response AS (
  SELECT p.term, q.status, p.page, {_display("s.selected")} AS selected,
    coalesce(string_agg(p.entry, ', ' ORDER BY p.rank) FILTER (WHERE section = 'related'), '') AS related,
    coalesce(string_agg(p.entry, ', ' ORDER BY p.rank) FILTER (WHERE section = 'incoming'), '') AS incoming,
    coalesce(string_agg(p.entry, ', ' ORDER BY p.rank) FILTER (WHERE section = 'outgoing'), '') AS outgoing
  FROM paged p JOIN prepared q ON q.term IS NOT DISTINCT FROM p.term LEFT JOIN selection s ON s.term = p.term
  GROUP BY ALL)
"""

ANSWER = f"""
listed AS (
  SELECT r.term, r.resource,
    row_number() OVER (PARTITION BY r.term ORDER BY r.first_word, r.resource) AS rank
  FROM related r LEFT JOIN selection s ON s.term = r.term
  WHERE r.resource IS DISTINCT FROM s.selected),
edge_entries AS (
  SELECT term, 'incoming' AS section, rank, referrer, resource, type, count FROM incoming
  UNION ALL SELECT term, 'outgoing', rank, referrer, resource, type, count FROM outgoing),
paged AS (
  SELECT term, 'related' AS section, rank, {_display("resource")} AS name, NULL AS edge FROM listed
  UNION ALL SELECT term, section, rank, NULL, json_object('referrer', {_display("referrer")},
    'resource', {_display("resource")}, 'type', type, 'count', count)::VARCHAR FROM edge_entries
  UNION ALL SELECT term, NULL, 1, NULL, NULL FROM prepared),
answer AS (
  SELECT p.term, ((p.rank - 1) // {RESPONSE_PAGE_ROWS})::BIGINT AS page,
    CASE WHEN any_value(q.status) = 'invalid' THEN '{{"error":"Search term is required"}}' ELSE
      '{{"relatedResources":[' || coalesce(string_agg(to_json(name)::VARCHAR, ',' ORDER BY p.rank)
        FILTER (WHERE section = 'related'), '') || '],"selectedResourceData":{{"selectedResource":'
      || coalesce(to_json({_display("any_value(s.selected)")})::VARCHAR, 'null') || ',"incoming":['
      || coalesce(string_agg(edge, ',' ORDER BY p.rank) FILTER (WHERE section = 'incoming'), '') || '],"outgoing":['
      || coalesce(string_agg(edge, ',' ORDER BY p.rank) FILTER (WHERE section = 'outgoing'), '') || ']}}}}' END AS json
  FROM paged p JOIN prepared q ON q.term IS NOT DISTINCT FROM p.term LEFT JOIN selection s ON s.term = p.term
  GROUP BY ALL)
"""

MONTHS = """
listing AS (
  SELECT DISTINCT '<a href="' || strftime(o_orderdate, '%Y-%m') || '/">' || strftime(o_orderdate, '%Y-%m') || '/</a>'
    AS html FROM orders),
online AS (
  SELECT DISTINCT trim(a, '/') AS date
  FROM (SELECT unnest(regexp_extract_all(html, '<a[^>]*>([^<]*)</a>', 1)) AS a FROM listing)
  WHERE starts_with(trim(a, '/'), '20')),
ledger AS (SELECT DISTINCT strftime(o_orderdate - INTERVAL 12 MONTH, '%Y-%m') AS date FROM orders),
fresh AS (SELECT date FROM online WHERE date NOT IN (SELECT date FROM ledger))
"""

TERM_WORDS = "term, norm, status, position::BIGINT AS position, word"


def _with(parts: list[str], select: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + select


CLEAN = [TRAFFIC, _parsed("traffic"), _normal()]
DAMAGED = [TRAFFIC, DIRTY, _parsed("dirty")]
SEARCH = [*CLEAN, EDGES, _index(), TERMS, HITS]
VOLUME = [BIGRAMS, _parsed("bigrams"), _normal(), EDGES]

LINE_COLUMNS = "src::BIGINT AS src, id, pos::BIGINT AS pos, referrer, resource, type, count"


def _key_report(name: str, table: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, count(*)::BIGINT AS n_rows, count(DISTINCT ({key}))::BIGINT AS n_keys, "
        f"(count(*) - count(DISTINCT ({key})))::BIGINT AS n_excess FROM {table}"
    )


PAIR = "coalesce(referrer, '') <> '' AND coalesce(resource, '') <> ''"

DESTINATIONS = """
destinations AS (
  SELECT resource AS search_term, referrer AS source, type, arg_max(count, (src, id, pos)) AS count
  FROM normal GROUP BY ALL)
"""

ORACLE: dict[str, str] = {
    "parse_lenient": _with(DAMAGED, f"SELECT {LINE_COLUMNS} FROM parsed WHERE valid"),
    "parse_strict": _with(DAMAGED, f"SELECT {LINE_COLUMNS} FROM parsed WHERE valid AND n_fields = 4"),
    "quarantine": _with(
        DAMAGED,
        "SELECT src::BIGINT AS src, id, pos::BIGINT AS pos, value FROM parsed WHERE NOT (valid AND n_fields = 4)",
    ),
    "normalize_edges": _with([*DAMAGED, _normal()], f"SELECT {LINE_COLUMNS} FROM normal"),
    "edge_upsert": _with([*CLEAN, EDGES], "SELECT * FROM edges"),
    "trending_topics": _with(
        CLEAN,
        "SELECT resource AS search_term, sum(count)::BIGINT AS traffic_count FROM normal GROUP BY ALL",
    ),
    "last_write_wins": _with([*CLEAN, DESTINATIONS], "SELECT * FROM destinations"),
    "pair_projection": _with(DAMAGED, f"SELECT referrer, resource FROM parsed WHERE {PAIR}"),
    "symmetric_pairs": _with(
        DAMAGED,
        f"SELECT referrer, resource FROM parsed WHERE {PAIR} UNION ALL SELECT resource, referrer FROM parsed WHERE {PAIR}",
    ),
    "key_uniqueness": _with(
        [*CLEAN, EDGES, _index(), DESTINATIONS,
         "trends AS (SELECT resource AS search_term, sum(count) AS traffic_count FROM edges GROUP BY ALL)"],
        " UNION ALL ".join([
            _key_report("referrer_resource", "edges", "referrer, resource"),
            _key_report("search_index", "word_index", "word, resource"),
            _key_report("resource_destination", "destinations", "search_term, source, type"),
            _key_report("trending_topics", "trends", "search_term"),
        ]),
    ),
    "word_count": (
        "SELECT word, count(*)::BIGINT AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) "
        "GROUP BY word"
    ),
    "search_index": _with([*CLEAN, EDGES, _index()], "SELECT * FROM word_index"),
    "index_increment": _with(
        [TRAFFIC, _parsed("page_lines", "parsed_pages"), _normal("parsed_pages", "normal_pages"),
         _parsed("catalogue_lines", "parsed_parts"), _normal("parsed_parts", "normal_parts"),
         _index("normal_pages", "known"), _index("normal_parts", "added")],
        "SELECT word, resource FROM added EXCEPT SELECT word, resource FROM known",
    ),
    "term_tokens": _with([TERMS], f"SELECT {TERM_WORDS} FROM query_words"),
    "search_related": _with(SEARCH, "SELECT term, resource, first_word::BIGINT AS first_word FROM related"),
    "search_select": _with([*SEARCH, SELECTED], "SELECT * FROM selection"),
    "search_ranked": _with(
        SEARCH,
        "SELECT *, rank = 1 AS is_selected FROM (SELECT term, resource, matches::BIGINT AS matches, "
        "first_word::BIGINT AS first_word, "
        "row_number() OVER (PARTITION BY term ORDER BY matches DESC, first_word, resource) AS rank FROM related)",
    ),
    "search_first": _with(
        SEARCH,
        "SELECT term, resource AS selected FROM related "
        "QUALIFY row_number() OVER (PARTITION BY term ORDER BY first_word, resource) = 1",
    ),
    "direct_lookup": _with(
        [*CLEAN, EDGES, TERMS],
        "SELECT p.term, 'incoming' AS section, e.resource, e.referrer, e.type, e.count "
        "FROM prepared p JOIN edges e ON e.resource = p.norm "
        "UNION ALL SELECT p.term, 'outgoing', e.resource, e.referrer, e.type, e.count "
        "FROM prepared p JOIN edges e ON e.referrer = p.norm",
    ),
    "search_incoming": _with([*SEARCH, SELECTED, FOUND], "SELECT * FROM incoming"),
    "search_outgoing": _with([*SEARCH, SELECTED, FOUND], "SELECT * FROM outgoing"),
    "title_case": _with(
        CLEAN,
        f"SELECT name, {_display('name')} AS display FROM "
        "(SELECT referrer AS name FROM normal UNION SELECT resource FROM normal)",
    ),
    "traffic_series": _with(
        [*SEARCH, SELECTED, FOUND],
        f"SELECT term, 'incoming' AS section, rank, {_display('referrer')} AS label, count FROM incoming "
        f"UNION ALL SELECT term, 'outgoing', rank, {_display('resource')}, count FROM outgoing",
    ),
    "search_response": _with([*SEARCH, SELECTED, FOUND, RESPONSE], "SELECT * FROM response"),
    "extract_anchors": (
        "SELECT page_id, position::BIGINT AS position, trim(a, '/') AS anchor FROM ("
        "SELECT page_id, unnest(l) AS a, unnest(range(0, len(l))) AS position FROM ("
        "SELECT page_id, list_transform(regexp_extract_all(html, '(?is)<a(?:\\s[^>]*)?>(.*?)</a\\s*>', 1), "
        "lambda x: regexp_replace(x, '<[^>]*>', '', 'g')) AS l FROM pages))"
    ),
    "new_months": _with([MONTHS], "SELECT date FROM fresh ORDER BY date"),
    "updated_ledger": _with([MONTHS], "SELECT date FROM ledger UNION SELECT date FROM fresh ORDER BY date"),
    "monthly_traffic": _with(
        [TRAFFIC, _parsed("traffic")],
        "SELECT strftime(DATE '2018-01-01' + to_months((id % 12)::INT), '%Y-%m') AS month, "
        "count(*)::BIGINT AS n_lines, sum(count)::BIGINT AS traffic FROM parsed WHERE valid GROUP BY ALL",
    ),
    "stream_edge_upsert": _with([*DAMAGED, _normal(), EDGES], "SELECT * FROM edges"),
    "pair_stream": _with(
        DAMAGED,
        f"SELECT referrer, resource, 'table' AS sink FROM parsed WHERE {PAIR} "
        f"UNION ALL SELECT referrer, resource, 'documents' FROM parsed WHERE {PAIR} "
        f"UNION ALL SELECT NULL, value, 'aside' FROM parsed WHERE NOT ({PAIR})",
    ),
    "stream_last_write_wins": _with([*DAMAGED, _normal(), DESTINATIONS], "SELECT * FROM destinations"),
    "stream_index": _with([*DAMAGED, _normal(), EDGES, _index()], "SELECT * FROM word_index"),
    "stream_search": _with(
        [*DAMAGED, _normal(), EDGES, _index(), TERMS, HITS, SELECTED, FOUND, RESPONSE], "SELECT * FROM response"
    ),
    "dump_edge_upsert": _with(
        [TRAFFIC, _parsed("traffic"), _normal(), EDGES.replace("(src, id, pos)", "(id % 12, src, id, pos)")],
        "SELECT * FROM edges",
    ),
    "ingest_months": _with(
        [TRAFFIC, _parsed("traffic"),
         "names AS (SELECT DISTINCT strftime(DATE '2018-01-01' + to_months((id % 12)::INT), '%Y-%m') AS date FROM traffic)"],
        "SELECT date, 'recorded' AS state, NULL::BIGINT AS n FROM names UNION SELECT '2018-01', 'recorded', NULL "
        "UNION ALL SELECT '2019-13-extra', 'missing', NULL "
        "UNION ALL SELECT 'lines', 'traffic', sum(count)::BIGINT FROM parsed WHERE valid AND id % 12 <> 0",
    ),
    "search_json": _with([*SEARCH, SELECTED, FOUND, ANSWER], "SELECT * FROM answer"),
    "trending_windowed": (
        "SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, "
        "strftime(w + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, "
        "lower(regexp_replace(event_type, '[^a-zA-Z0-9 ]', ' ', 'g')) AS search_term, "
        "count(*)::BIGINT AS traffic_count "
        "FROM (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS w, event_type FROM events) "
        "WHERE w + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY ALL"
    ),
    "publish_lines": _with([TRAFFIC, DIRTY], f"SELECT trim(value, {BLANKS}) AS value FROM dirty"),
    "ingest_metrics": _with(
        DAMAGED,
        "SELECT count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE valid)::BIGINT AS n_valid, "
        "count(*) FILTER (WHERE NOT valid)::BIGINT AS n_quarantined, "
        "coalesce(sum(count) FILTER (WHERE valid), 0)::BIGINT AS traffic FROM parsed",
    ),
    "volume_edge_upsert": _with(VOLUME, "SELECT * FROM edges"),
    "volume_search_index": _with([*VOLUME, _index()], "SELECT * FROM word_index"),
    "volume_search_response": _with(
        [*VOLUME, _index(), TEXT_TERMS, HITS, SELECTED, FOUND, RESPONSE], "SELECT * FROM response"
    ),
}
ORACLE["batched_word_count"] = ORACLE["word_count"]
ORACLE["search_stored"] = ORACLE["search_shuffled"] = ORACLE["search_bucketed"] = ORACLE["search_response"]
ORACLE["stream_answers"] = ORACLE["search_response"]
ORACLE["stream_state_upsert"] = ORACLE["stream_edge_upsert"]
ORACLE["sql_index"] = ORACLE["search_index"]
ORACLE["search_top"] = _with(
    SEARCH,
    "SELECT term, resource, matches::BIGINT AS matches, first_word::BIGINT AS first_word, "
    "row_number() OVER (PARTITION BY term ORDER BY matches DESC, first_word, resource) AS rank FROM related QUALIFY rank <= 10",
)
ORACLE["point_reads"] = _with(
    [*CLEAN, EDGES, _index()],
    f"SELECT word AS looked_up, 'word' AS section, '' AS referrer, resource FROM word_index WHERE word IN ({_list(POINT_WORDS)}) "
    f"UNION ALL SELECT resource, 'incoming', referrer, resource FROM edges WHERE resource IN ({_list(POINT_PAGES)}) "
    f"UNION ALL SELECT referrer, 'outgoing', referrer, resource FROM edges WHERE referrer IN ({_list(POINT_PAGES)})",
)
ORACLE["trending_open"] = ORACLE["trending_windowed"].replace("INTERVAL 10 MINUTE <= (SELECT", "INTERVAL 10 MINUTE > (SELECT")
ORACLE["ingest_stream"] = _with(
    [TRAFFIC, _parsed("traffic")],
    "SELECT strftime(DATE '2018-01-01' + to_months((id % 12)::INT), '%Y-%m') AS month, (id % 12 >= 6)::BIGINT AS batch_id, "
    "count(*)::BIGINT AS n_lines, sum(count)::BIGINT AS traffic FROM parsed WHERE valid GROUP BY ALL",
)
ORACLE["stream_metrics"] = """
WITH loads AS (SELECT event_id % 3 + 1 AS load, event_id % 17 <> 0 AS valid, ts FROM events),
ends AS (SELECT load, max(ts) AS last FROM loads GROUP BY load),
marks AS (SELECT e.load, (SELECT date_trunc('millisecond', max(last)) FROM ends p WHERE p.load < e.load) - INTERVAL 10 MINUTE AS mark FROM ends e)
SELECT l.load, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE valid)::BIGINT AS n_valid,
  count(*) FILTER (WHERE NOT valid)::BIGINT AS n_quarantined, count(*) FILTER (WHERE valid)::BIGINT AS traffic,
  count(*) FILTER (WHERE valid AND ts <= mark)::BIGINT AS n_late
FROM loads l JOIN marks m ON m.load = l.load GROUP BY l.load
"""
