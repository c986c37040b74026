"""The catalogued queries as DuckDB SQL over the sample tables.

Common table expressions are declared once, with their dependencies read from the SQL, and a
query is a final SELECT plus the expressions it needs. Patterns are written for RE2 on their own;
only the names of elements and entities are those of the Spark side.
"""

from __future__ import annotations

import re
from html.entities import name2codepoint

from webloom.functions import html as P
from webloom.sources.demo import UUID_PREFIX

# Tags: attributes with their quoted values, which may hold anything but a tag start; where a quote is
# left open the tag ends at the first bracket.
INSIDE = r"""[^<>"']*(?:"[^"<]*"[^<>"']*|'[^'<]*'[^<>"']*)*"""
CLOSE_TAG = rf"(?:{INSIDE}>|[^<>]*>)"
NAME_END = rf"(?:>|[\s/]{CLOSE_TAG})"
ATTRIBUTE = r"""\s*=\s*(?:"([^"<]*)"|'([^'<]*)'|([^\s"'>]+))"""
ELEMENTS = "|".join(P.BLOCK_ELEMENTS)
BLOCK_TAG = rf"(?i)<(/?)(?:{ELEMENTS}){NAME_END}"
BR_TAG = rf"(?i)</?br{NAME_END}"
ANY_TAG = rf"<(?:[a-zA-Z]|/[a-zA-Z]|!|\?){CLOSE_TAG}"
ALT_TAG = (
    r"""(?i)<[a-z](?:[^<>"']|"[^"<]*"|'[^'<]*')*?(?:[\s/]|"[^"<]*"|'[^'<]*')alt"""
    rf"{ATTRIBUTE}{CLOSE_TAG}"
)
TITLE_TEXT = rf"(?is)<title{NAME_END}(.*?)(?:</title\s*>|\z)"
HEAD_TITLE = rf"(?is)<title{NAME_END}.*?(?:</title\s*>|\z)"
HEADING_TAG = rf"(?i)<(/?)h([1-6]){NAME_END}"
META_TAG = rf"(?i)<meta[\s/]{CLOSE_TAG}"
CONTENT_VALUE = rf"""(?i)[\s"'/]content(?:{ATTRIBUTE}|[\s/>])"""
HIDDEN = (
    rf"(?is)(<script{NAME_END}).*?(?:</script[^<>]*>|\z)|(<style{NAME_END}).*?(?:</style[^<>]*>|\z)|<!--.*?(?:-->|\z)"
)
WHITE = r"[ \t\n\f\r\x01-\x05]+"
REFERENCE = r"^(#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[a-zA-Z][a-zA-Z0-9]*)"

CONTROL = "".join(chr(c) for c in range(1, 0x21))
BLANKS = r"[ \t\n\f\r]+"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(s: str, pattern: str, by: str) -> str:
    return f"regexp_replace({s}, {lit(pattern)}, {lit(by)}, 'g')"


def strip(s: str) -> str:
    return f"trim({s}, {lit(CONTROL)})"


def squeeze(s: str) -> str:
    return strip(sub(s, BLANKS, " "))


def digits(n: str, width: int) -> str:
    return f"lpad(CAST({n} AS VARCHAR), {width}, '0')"


def collection_id(n: str) -> str:
    return (
        f"('clueweb12-en' || {digits(f'({n}) // 10000000', 4)} || '-' || "
        f"{digits(f'({n}) // 100000 % 100', 2)} || '-' || {digits(f'({n}) % 100000', 5)})"
    )


def snippet(s: str, n: int) -> str:
    cut = f"substr({s}, 1, {n})"
    back = f"instr(reverse({cut}), ' ')"
    return strip(
        f"CASE WHEN length({s}) <= {n} THEN {s} WHEN substr({s}, {n + 1}, 1) = ' ' OR {back} = 0 "
        f"OR {n} - {back} < {int(0.6 * n)} THEN {cut} ELSE substr({s}, 1, {n} - {back}) END"
    )


def character(code: str) -> str:
    return (
        f"CASE WHEN {code} IN (9, 10, 12, 13) THEN ' ' WHEN {code} BETWEEN 1 AND 31 THEN '' "
        f"WHEN {code} > 0 AND {code} < 1114112 AND {code} NOT BETWEEN 55296 AND 57343 "
        f"THEN chr(CAST({code} AS INTEGER)) ELSE chr(65533) END"
    )


NAMES = "MAP {" + ", ".join(f"{lit(n)}: {lit(c)}" for n, c in P.entities(name2codepoint).items()) + "}"
BARE = ", ".join(lit(n) for n in P.bare_names())


def entities(s: str) -> str:
    ref = f"regexp_extract(p, {lit(REFERENCE)}, 1)"
    closed = f"substr(p, length({ref}) + 1, 1) = ';'"
    hexa = f"TRY_CAST('0x' || substr({ref}, 3) AS BIGINT)"
    deci = f"TRY_CAST(substr({ref}, 2) AS BIGINT)"
    char = (
        f"CASE WHEN lower(left({ref}, 2)) = '#x' THEN {character(hexa)} "
        f"WHEN left({ref}, 1) = '#' THEN {character(deci)} "
        f"WHEN {closed} OR {ref} IN ({BARE}) THEN {NAMES}[{ref}] END"
    )
    rest = f"substr(p, length({ref}) + CASE WHEN {closed} THEN 2 ELSE 1 END)"
    return (
        f"array_to_string(list_transform(string_split({s}, '&'), lambda p, i: "
        f"CASE WHEN i = 1 THEN p ELSE coalesce({char} || {rest}, '&' || p) END), '')"
    )


def normal(s: str) -> str:
    return sub(f"lower(' ' || {s} || ' ')", r"[^\p{L}\p{M}]+", " ")


def grams(n: str) -> str:
    parts = [f"regexp_extract_all(substr({n}, {i}), '...')" for i in (1, 2, 3)]
    return f"list_concat(list_concat({parts[0]}, {parts[1]}), {parts[2]})"


def languages(texts: str, keys: str) -> str:
    """Language of each row of ``texts`` (columns ``keys`` and ``t``)."""
    on = " AND ".join(f"x.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    return f"""
    SELECT x.*, coalesce(b.lang, 'unknown') AS lang FROM {texts} x LEFT JOIN (
      SELECT {keys}, lang FROM (
        SELECT {keys}, p.lang, row_number() OVER (
          PARTITION BY {keys} ORDER BY sum(p.weight) DESC, p.lang) AS r
        FROM (SELECT {keys}, unnest({grams("n")}) AS gram
              FROM (SELECT {keys}, {normal("t")} AS n FROM {texts})) g
        JOIN profile p ON g.gram = p.gram GROUP BY {keys}, p.lang)
      WHERE r = 1) b ON {on}"""


def fragment(x: str) -> str:
    blank = sub(x, rf"{BR_TAG}|{BLOCK_TAG}", " ")
    return squeeze(entities(sub(blank, ANY_TAG, "")))


def meta(name: str) -> str:
    content = " || ".join(f"regexp_extract(tag, {lit(CONTENT_VALUE)}, {g})" for g in (1, 2, 3))
    found = (
        f"list_filter(regexp_extract_all(clean, {lit(META_TAG)}), lambda t: "
        f"regexp_matches(t, {lit(P.meta_name_pattern(name))}) AND "
        f"regexp_matches(t, {lit(CONTENT_VALUE)}))"
    )
    return (
        f"coalesce(list_transform(list_slice({found}, 1, 1), lambda tag: "
        f"{squeeze(entities(f'({content})'))})[1], '')"
    )


def http_date(s: str) -> str:
    """Day, month, year, time and zone are added up, so that each may run over."""
    shape = (
        r"(?i)^\w+, *(\d+) +(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)\w* +(\d+) +(\d+):(\d+):(\d+) +"
        r"(GMT|[+-]\d{4})"
    )
    day, month, year, hour, minute, second, zone = (
        f"regexp_extract({s}, {lit(shape)}, {g})" for g in range(1, 8)
    )
    number = f"(instr('janfebmaraprmayjunjulaugsepoctnovdec', lower({month})) + 2) // 3"
    start = f"make_timestamp(CAST({year} AS BIGINT), {number}, 1, 0, 0, 0.0)"
    plus = " + ".join(
        f"{unit}(CAST({value} AS BIGINT))"
        for unit, value in (("to_hours", hour), ("to_minutes", minute), ("to_seconds", second))
    )
    ahead = f"CASE WHEN {zone} = 'GMT' THEN 0 ELSE CAST({zone} AS BIGINT) // 100 END"
    moment = f"{start} + to_days(CAST({day} AS INTEGER) - 1) + {plus} - to_hours({ahead})"
    return f"CASE WHEN regexp_matches({s}, {lit(shape)}) THEN strftime({moment}, '%Y-%m-%dT%H:%M:%SZ') END"


CTES: dict[str, str] = {}

DATES = {
    1: "'Tue, 02 Jan 2024 03:04:'",
    2: "CASE WHEN page_id % 2 = 0 THEN 'Wed, 03 Jan 2024 03:04:' ELSE 'Mon, 01 Jan 2024 03:04:' END",
}
TITLED = "CASE WHEN page_id % 6 = 5 THEN regexp_replace(html, '<title>[^<]*</title>', '<title></title>', 'g') ELSE html END"
EDITED = f"""replace(replace({TITLED}, '<style>',
  '<meta name="keywords" content="k' || (page_id % 5) || ',  z"><meta name="description" content="' ||
  repeat('word' || (page_id % 10) || ' ', page_id % 200) || CASE WHEN page_id % 5 = 4 THEN ' > more' ELSE '' END || '"><style>'), '</article>',
  '<h3>Third ' || page_id || '</h3><h2> Second  ' || page_id || '</h2><img src="i.png" alt="pic ' ||
  page_id || CASE WHEN page_id % 4 = 3 THEN ' > next' ELSE '' END ||
  '"><p>The picture above shows what this page is about<a title="up > down" href=x>' ||
  CASE WHEN page_id % 3 = 1 THEN ' ' || chr(128512) ELSE '' END || ' and the link</a></p></article>')"""
SHAPED = f"""CASE WHEN page_id % 17 = 16 THEN replace({EDITED}, '</head><body>', '')
  WHEN page_id % 19 = 18 THEN replace({EDITED}, '</head><body>', '</head><div>Banner before the body</div><body>')
  ELSE {EDITED} END"""
BODIES = {
    1: f"""CASE WHEN page_id % 31 = 30 THEN '<html><body>x</body></html>'
      WHEN page_id % 97 = 96 THEN ({SHAPED}) || repeat('<!-- pad -->', {1048576 // 12 + 1}) ELSE {SHAPED} END""",
    2: "html",
}


def declare_crawl(v: int, z: str) -> None:
    """Records of one visit and all their page stages; names end in ``z``."""
    CTES[f"fields{z}"] = f"""
    SELECT page_id, CASE WHEN page_id % 7 <> 6 THEN {collection_id("page_id")} END AS trec_id,
      CASE WHEN page_id % 14 <> 13 AND page_id % 9 <> 8 THEN
        '<urn:uuid:00000000-0000-4000-8000-' || {digits("page_id", 12)} || '>' END AS record_id,
      CASE WHEN page_id % 23 = 22 THEN NULL WHEN page_id % 11 = 10 THEN 'request'
        WHEN page_id % 29 = 28 THEN 'Response' ELSE 'response' END AS warc_type,
      CASE WHEN page_id % 13 = 12 THEN 'base64' ELSE 'plain' END AS encoding,
      CASE WHEN page_id % 15 = 14 THEN url || ' x' ELSE url END AS target_uri,
      CASE WHEN page_id % 10 = 9 THEN NULL WHEN page_id % 21 = 20 THEN 'text/html' || chr(9) || '; charset=x'
        WHEN page_id % 3 = 0 THEN 'text/html; charset=UTF-8'
        ELSE ' text/html ' END AS content_type,
      CASE WHEN page_id % 12 = 11 THEN NULL WHEN page_id % 8 = 7 THEN 'not a date'
        WHEN page_id % 25 = 24 THEN 'Tuesday, 2 January 2024 03:04:05 GMT, or so'
        WHEN page_id % 25 = 23 THEN 'Thu, 32 Jan 2024 25:04:05 +0100'
        ELSE {DATES[v]} || {digits("page_id % 60", 2)} || ' GMT' END AS http_date,
      {BODIES[v]} AS body FROM pages"""
    CTES[f"records{z}"] = f"""
    SELECT CAST(page_id AS VARCHAR) AS key,
      CASE WHEN page_id % 37 = 36 THEN substr(v, 1, 100) ELSE v END AS value FROM (
      SELECT page_id, '{{"metadata":{{' || concat_ws(',',
        '"' || CASE WHEN page_id % 2 = 1 THEN 'warc-type' ELSE 'WARC-Type' END || '":' || to_json(warc_type),
        '"WARC-Record-ID":' || to_json(record_id), '"WARC-TREC-ID":' || to_json(trec_id),
        '"WARC-Target-URI":' || to_json(target_uri)) || '}},"payload":{{"headers":{{' || concat_ws(',',
        '"Content-Type":' || to_json(content_type), '"Date":' || to_json(http_date)) ||
        '}},"encoding":' || to_json(encoding) || ',"body":' || to_json(body) || '}}}}' AS v
      FROM fields{z})"""
    CTES[f"docs{z}"] = f"""
    SELECT key, strlen(value) AS n_bytes,
      CASE WHEN strlen(value) <= 1048576 AND json_valid(value) THEN CAST(value AS JSON) END AS doc
    FROM records{z}"""
    CTES[f"envelope{z}"] = f"""
    SELECT key, n_bytes, doc,
      len(json_keys(doc, '$.metadata')) AS n_metadata, len(json_keys(doc, '$.payload.headers')) AS n_headers,
      coalesce(doc->>'$.metadata."WARC-Type"', doc->>'$.metadata."warc-type"') AS warc_type,
      doc->>'$.metadata."WARC-Record-ID"' AS warc_record_id,
      doc->>'$.metadata."WARC-TREC-ID"' AS warc_trec_id,
      doc->>'$.metadata."WARC-Target-URI"' AS warc_target_uri,
      doc->>'$.payload.headers."Content-Type"' AS type_header,
      doc->>'$.payload.headers."Date"' AS date_header,
      CASE WHEN json_type(doc, '$.payload.encoding') = 'VARCHAR' THEN doc->>'$.payload.encoding' END AS encoding,
      CASE WHEN json_type(doc, '$.payload.body') = 'VARCHAR' THEN doc->>'$.payload.body' END AS body
    FROM docs{z}"""
    CTES[f"classified{z}"] = f"""
    SELECT *, CASE WHEN n_bytes > 1048576 THEN 'TOO_LARGE'
      WHEN doc IS NULL OR n_metadata IS NULL OR n_headers IS NULL OR encoding IS NULL OR body IS NULL
        THEN 'JSON_PARSE_ERROR'
      WHEN encoding <> 'plain' THEN 'BINARY' WHEN warc_type <> 'response' THEN 'NO_RESPONSE_RECORD'
      WHEN warc_record_id IS NULL AND warc_trec_id IS NULL THEN 'NO_ID' END AS status
    FROM envelope{z}"""
    valid = r"NOT regexp_matches(warc_target_uri, '[\s\"<>\\^`{|}]')"
    rest = "'^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)'"
    digest = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('{UUID_PREFIX}:' || id))"
    CTES[f"keyed{z}"] = f"""
    SELECT *, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
      translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' ||
      substr(h, 21, 12) AS uuid,
      CASE WHEN {valid} THEN regexp_extract(warc_target_uri, '://([^/:?#]*)', 1) END AS warc_target_hostname,
      CASE WHEN {valid} THEN url_decode(replace(regexp_extract(warc_target_uri, {rest}, 1), '+', '%2B')) END
        AS warc_target_path,
      CASE WHEN {valid} THEN url_decode(replace(regexp_extract(warc_target_uri, '^[^?#]*[?]([^#]*)', 1), '+', '%2B'))
        END AS warc_target_query_string,
      {strip("split_part(type_header, ';', 1)")} AS content_type,
      {http_date("date_header")} AS date
    FROM (SELECT *, {digest} AS h FROM (
      SELECT *, coalesce(warc_trec_id, warc_record_id) AS id FROM classified{z} WHERE status IS NULL))"""
    before = r"regexp_extract(clean, '(?is)\A(.*?)<body[\s/>]', 1)"
    body = (
        rf"CASE WHEN regexp_matches(clean, '(?i)<body[\s/>]') THEN {sub(before, HEAD_TITLE, '')} || "
        f"substr(clean, length({before}) + 1) ELSE {sub('clean', HEAD_TITLE, '')} END"
    )
    marked = sub(body, ALT_TAG, f"{P.ALT_START}\\1\\2\\3{P.ALT_END}")
    marked = sub(marked, BLOCK_TAG, f"{P.OPEN}\\1{P.CLOSE}")
    marked = sub(sub(marked, BR_TAG, P.BREAK), ANY_TAG, "")
    cleaned = sub(sub("body", WHITE, " "), HIDDEN, "\\1\\2")
    CTES[f"marked{z}"] = f"""
    SELECT * EXCLUDE (m), {entities("m")} AS marked FROM (
      SELECT *, {marked} AS m FROM (SELECT *, {cleaned} AS clean FROM keyed{z}))"""
    starts = f"replace(marked, {lit(P.OPEN + '/' + P.CLOSE)}, '')"
    shown = f"translate({starts}, {lit(P.ALT_END + P.BREAK + P.CLOSE + P.ALT_START)}, {lit(P.OPEN * 2)})"
    plain = sub("marked", f"{P.ALT_START}[^{P.ALT_END}]*{P.ALT_END}", "")
    CTES[f"texts{z}"] = f"""
    SELECT *, {strip(sub(shown, f" ?{P.OPEN}+", " "))} AS full_body FROM marked{z}"""
    CTES[f"page_text{z}"] = f"SELECT key, full_body AS t FROM texts{z}"
    CTES[f"page_lang{z}"] = languages(f"page_text{z}", "key")
    split = f"string_split_regex(translate({plain}, {lit(P.BREAK)}, ' '), {lit(f'{P.OPEN}/?{P.CLOSE}')})"
    blocks = (
        f"list_filter(list_transform({split}, lambda b: {squeeze('b')}), lambda b: length(b) >= 50)"
    )
    CTES[f"paragraph{z}"] = f"""
    SELECT key, unnest(range(len(bs))) AS pos, unnest(bs) AS t
    FROM (SELECT key, {blocks} AS bs FROM marked{z})"""
    CTES[f"paragraph_lang{z}"] = languages(f"paragraph{z}", "key, pos")
    CTES[f"main{z}"] = f"""
    SELECT d.key, d.lang, coalesce(string_agg(p.t, ' ' ORDER BY p.pos), '') AS main_text
    FROM page_lang{z} d LEFT JOIN paragraph_lang{z} p ON p.key = d.key AND p.lang IN (d.lang, 'en')
    GROUP BY d.key, d.lang"""
    CTES[f"extracted{z}"] = f"""
    SELECT x.*, m.lang, m.main_text FROM texts{z} x JOIN main{z} m ON x.key = m.key"""
    stripped = f"replace({plain}, {lit(P.OPEN + '/' + P.CLOSE)}, '')"
    spaced = f"translate({stripped}, {lit(P.OPEN + P.CLOSE + P.BREAK)}, '   ')"
    own = squeeze(entities(f"regexp_extract(clean, {lit(TITLE_TEXT)}, 1)"))
    cut = f"string_split({sub('clean', HEADING_TAG, f'{P.OPEN}{chr(92)}1{chr(92)}2{P.CLOSE}')}, {lit(P.OPEN)})"
    heads = ", ".join(
        f"list_transform(list_filter({cut}, lambda p: substr(p, 1, 2) = {lit(f'{n}{P.CLOSE}')}), "
        f"lambda p: substr(p, 3))"
        for n in (1, 2, 3)
    )
    CTES[f"head{z}"] = f"""
    SELECT key, headings, {snippet("t", 90)} AS title, {snippet("d", 400)} AS meta_desc,
      {snippet("k", 400)} AS meta_keywords
    FROM (SELECT key, array_to_string(list_transform(flatten([{heads}]), lambda x: {fragment("x")}), '') AS headings,
      CASE WHEN {own} <> '' THEN {own} ELSE {strip(sub(spaced, " +", " "))} END AS t,
      {meta("description")} AS d, {meta("keywords")} AS k FROM marked{z})"""
    CTES[f"final{z}"] = f"""
    SELECT x.id, x.uuid, warc_trec_id, warc_record_id, warc_target_uri, warc_target_hostname, warc_target_path,
      warc_target_query_string, content_type, date, lang, length(main_text) + length(regexp_replace(main_text, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) AS body_length, main_text AS body,
      full_body, headings, title, meta_desc, meta_keywords, x.key
    FROM extracted{z} x JOIN head{z} h ON x.key = h.key
    WHERE strlen(main_text) >= 5 AND {strip("main_text")} <> ''"""


declare_crawl(1, "1")
declare_crawl(2, "2")

CTES["profile"] = f"""
    SELECT * FROM (
      SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram) AS rank,
        301 - row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram) AS weight
      FROM (SELECT lang, unnest({grams("n")}) AS gram
            FROM (SELECT lang, {normal("text")} AS n FROM documents WHERE lang IS NOT NULL))
      WHERE substr(gram, 2, 1) <> ' ' GROUP BY lang, gram) WHERE rank <= 300"""
SHIFTED = "page_id + CASE WHEN page_id % {} = {} THEN 90000000 ELSE 0 END"
CTES["spam_lines"] = f"""
    SELECT ((page_id * 7) % 100) || ' ' || {collection_id(SHIFTED.format(4, 3))} AS value FROM pages"""
CTES["page_rank_lines"] = f"""
    SELECT {collection_id(SHIFTED.format(5, 4))} || '  0.' || {digits("(page_id * 37) % 10000", 4)} AS value
    FROM pages"""
CTES["anchor_lines"] = f"""
    SELECT CASE WHEN doc_id % 13 = 12 THEN '<urn:uuid:' || doc_id || '>'
      ELSE {collection_id("(doc_id * doc_id) % 300")} END || ' ' || replace(text, chr(10), ' ') AS value
    FROM documents"""
CTES["spam_rows"] = r"""
    SELECT string_split_regex(value, '\s+')[2] AS id, CAST(string_split_regex(value, '\s+')[1] AS BIGINT) AS spam_rank
    FROM spam_lines"""
CTES["page_rank_rows"] = r"""
    SELECT string_split_regex(value, '\s+')[1] AS id, CAST(string_split_regex(value, '\s+')[2] AS FLOAT) AS page_rank
    FROM page_rank_lines"""
CTES["spam"] = "SELECT id, max(spam_rank) AS spam_rank FROM spam_rows GROUP BY id"
CTES["page_ranks"] = "SELECT id, max(page_rank) AS page_rank FROM page_rank_rows GROUP BY id"
CTES["anchors"] = r"""
    SELECT regexp_extract(value, '^(clueweb\d{2}-\w{2}\d{4}-\d{2}-\d{5})\s', 1) AS id,
      regexp_extract(value, '^clueweb\d{2}-\w{2}\d{4}-\d{2}-\d{5}\s+(.*)$', 1) AS anchor
    FROM anchor_lines WHERE regexp_full_match(value, 'clueweb\d{2}-\w{2}\d{4}-\d{2}-\d{5}\s+.*')"""
CTES["anchors_cut"] = "SELECT id, substr(anchor, 1, 400) AS anchor FROM anchors"
CTES["anchor_texts"] = "SELECT row_number() OVER () AS nr, id, anchor, anchor AS t FROM anchors_cut"
CTES["anchor_langs"] = languages("anchor_texts", "nr")
CTES["anchor_groups"] = """
    SELECT id, lang, count(*) AS n_texts, string_agg(anchor, ' | ' ORDER BY anchor) AS texts
    FROM anchor_langs GROUP BY id, lang"""
CTES["anchors_flat"] = """
    SELECT id, count(*) AS n_langs, CAST(sum(n_texts) AS BIGINT) AS n_texts,
      string_agg(lang || ': ' || texts, chr(10) ORDER BY lang) AS anchors
    FROM anchor_groups GROUP BY id"""
CTES["outcomes"] = """
    SELECT c.key, coalesce(c.status, CASE WHEN strlen(m.main_text) < 5 THEN 'TOO_SMALL' ELSE 'RECORD' END)
      AS status, m.lang FROM classified1 c LEFT JOIN main1 m ON c.key = m.key"""
CTES["all_ids"] = """
    SELECT coalesce(c.warc_trec_id, c.warc_record_id) AS id
    FROM classified1 c JOIN outcomes o ON c.key = o.key WHERE o.status = 'RECORD'
    UNION SELECT id FROM spam UNION SELECT id FROM page_ranks UNION SELECT id FROM anchors"""
CTES["counts"] = """
    SELECT count(*) AS total, count(*) FILTER (status = 'RECORD') AS records,
      count(*) FILTER (status = 'TOO_LARGE') AS too_large, count(*) FILTER (status = 'JSON_PARSE_ERROR') AS json,
      count(*) FILTER (status = 'BINARY') AS bin, count(*) FILTER (status = 'NO_RESPONSE_RECORD') AS no_response,
      count(*) FILTER (status = 'NO_ID') AS no_id, count(*) FILTER (status = 'TOO_SMALL') AS too_small,
      count(*) FILTER (lang = 'unknown') AS lang_failed,
      (SELECT count(DISTINCT id) FROM final1) AS generated,
      (SELECT count(*) FROM all_ids WHERE id NOT IN (SELECT id FROM final1)) AS no_content
    FROM outcomes"""
COLUMNS = (
    "id, uuid, warc_trec_id, warc_record_id, warc_target_uri, warc_target_hostname, warc_target_path, "
    "warc_target_query_string, content_type, date, lang, body_length, body, full_body, headings, title, "
    "meta_desc, meta_keywords"
)
RANKED = "round(CAST(page_rank AS DOUBLE), 6) AS page_rank"
CTES["documents_built"] = f"""
    SELECT {", ".join("f." + c for c in COLUMNS.split(", "))}, spam_rank, page_rank, anchors
    FROM final1 f LEFT JOIN spam USING (id) LEFT JOIN page_ranks USING (id) LEFT JOIN anchors_flat USING (id)"""


def keep(*dropped: str) -> str:
    names = ", ".join(lit(d) for d in dropped)
    return f"SELECT key FROM classified1 WHERE status IS NULL OR status NOT IN ({names})"


def by_lang(field: str) -> str:
    return f"'{{' || to_json(lang) || ':' || to_json({field}) || '}}'"


def member(name: str, value: str) -> str:
    return f"""'"{name}":' || {value}"""


DROPS = ["TOO_LARGE", "JSON_PARSE_ERROR", "BINARY", "NO_RESPONSE_RECORD", "NO_ID"]
PLAIN = (
    "warc_trec_id warc_record_id warc_target_uri warc_target_hostname warc_target_path "
    "warc_target_query_string content_type date lang body_length meta_keywords spam_rank"
).split()
FAMILIES = {
    "title_lang": "title",
    "meta_desc_lang": "meta_desc",
    "headings_lang": "headings",
    "body_lang": "body",
    "full_body_lang": "full_body",
}
# small floats are written with an exponent on the Spark side
FLOAT_TEXT = """CASE WHEN page_rank > 0 AND page_rank < 0.001
    THEN CAST(CAST(round(page_rank * 10000) AS INTEGER) AS VARCHAR) || '.0E-4' ELSE CAST(page_rank AS VARCHAR) END"""
ANCHOR_MAP = """(SELECT '{' || string_agg(to_json(lang) || ':' || texts, ',' ORDER BY lang) || '}' FROM (
    SELECT lang, '[' || string_agg(to_json(anchor), ',' ORDER BY anchor) || ']' AS texts
    FROM anchor_langs a WHERE a.id = d.id GROUP BY lang))"""
JSON_FIELDS = ", ".join(
    [member(c, f"to_json({c})") for c in PLAIN]
    + [member("page_rank", FLOAT_TEXT)]
    + [member(k, by_lang(v)) for k, v in FAMILIES.items()]
    + [member("anchor_texts_lang", ANCHOR_MAP)]
)

SELECTS = {
    "scan_records": "SELECT key, value FROM records1",
    "batch_slice": """SELECT key, c AS container, CASE WHEN c < 99 THEN c // 33 + 1 ELSE 3 END AS batch,
        CASE WHEN c < 99 THEN c // 33 + 1 END AS strict_batch
        FROM (SELECT key, CAST(key AS BIGINT) % 100 AS c FROM records1)""",
    "scan_spam_ranks": "SELECT value FROM spam_lines",
    "scan_page_ranks": "SELECT value FROM page_rank_lines",
    "scan_anchors": "SELECT value FROM anchor_lines",
    "filter_oversize": keep(*DROPS[:1]),
    "filter_json_error": keep(*DROPS[:2]),
    "filter_binary": keep(*DROPS[:3]),
    "filter_response": keep(*DROPS[:4]),
    "filter_no_id": keep(*DROPS),
    "filter_too_small": "SELECT key, strlen(main_text) AS main_bytes FROM main1 WHERE strlen(main_text) >= 5",
    "filter_no_content": "SELECT id FROM final1",
    "parse_envelope": "SELECT key, n_bytes, n_metadata, n_headers, encoding, body FROM envelope1",
    "header_lookup": "SELECT key, warc_type, warc_target_uri, type_header AS content_type, date_header AS date FROM envelope1",
    "record_ids": "SELECT key, warc_trec_id, warc_record_id FROM envelope1",
    "join_key": "SELECT key, id FROM keyed1",
    "doc_uuid": "SELECT id, uuid FROM keyed1",
    "uri_host": "SELECT key, warc_target_uri, warc_target_hostname FROM keyed1",
    "uri_path": "SELECT key, warc_target_uri, warc_target_path FROM keyed1",
    "uri_query": "SELECT key, warc_target_uri, warc_target_query_string FROM keyed1",
    "content_type": "SELECT key, content_type FROM keyed1",
    "http_date": "SELECT key, date FROM keyed1",
    "full_text": "SELECT key, full_body FROM texts1",
    "lang_profile": "SELECT lang, gram, rank, weight FROM profile",
    "detect_lang": "SELECT key, lang FROM page_lang1",
    "paragraphs": "SELECT key, pos, t AS text, lang FROM paragraph_lang1",
    "main_content": "SELECT key, lang, main_text FROM main1",
    "body_length": "SELECT id, body_length FROM final1",
    "headings": "SELECT key, headings FROM head1",
    "doc_title": "SELECT key, title FROM head1",
    "meta_description": "SELECT key, meta_desc FROM head1",
    "meta_keywords": "SELECT key, meta_keywords FROM head1",
    "truncate_snippet": f"""SELECT doc_id, {snippet("text", 20)} AS snippet_20, {snippet("text", 90)} AS snippet_90,
        {snippet("text", 400)} AS snippet_400 FROM documents""",
    "lang_fields": f"SELECT uuid, {', '.join(f'{by_lang(v)} AS {k}' for k, v in FAMILIES.items())} FROM final1",
    "spam_parse": "SELECT id, spam_rank FROM spam_rows",
    "page_rank_parse": f"SELECT id, {RANKED} FROM page_rank_rows",
    "side_line_drops": """SELECT input, reason, count(*) AS n, min(left(value, 200)) AS first, max(left(value, 200)) AS last FROM (
        SELECT 'spam' AS input, value, CASE WHEN TRY_CAST(split_part(value, ' ', 1) AS BIGINT) IS NULL THEN 'rank is no number' ELSE 'kept' END AS reason
        FROM (SELECT value FROM spam_lines UNION ALL SELECT value FROM page_rank_lines)
        UNION ALL SELECT 'page_ranks', value, CASE WHEN TRY_CAST(regexp_extract(value, ' +(.*)$', 1) AS FLOAT) IS NULL THEN 'rank is no number' ELSE 'kept' END
        FROM (SELECT value FROM spam_lines UNION ALL SELECT value FROM page_rank_lines)
        UNION ALL SELECT 'anchors', value, CASE WHEN regexp_matches(value, '^clueweb[0-9]{2}-[0-9A-Za-z_]{2}[0-9]{4}-[0-9]{2}-[0-9]{5}[ \\t]') THEN 'kept' ELSE 'no id and text' END
        FROM anchor_lines) GROUP BY input, reason""",
    "anchor_parse": "SELECT id, anchor FROM anchors",
    "anchor_cut": "SELECT id, anchor FROM anchors_cut",
    "anchor_lang": "SELECT id, anchor, lang FROM anchor_langs",
    "live_anchors": "SELECT id, anchor FROM anchors_cut WHERE id IN (SELECT id FROM final1)",
    "anchors_by_lang": "SELECT id, lang, n_texts, texts FROM anchor_groups",
    "join_spam": "SELECT k.id, spam_rank FROM keyed1 k LEFT JOIN spam s ON k.id = s.id",
    "join_page_rank": f"SELECT k.id, {RANKED} FROM keyed1 k LEFT JOIN page_ranks s ON k.id = s.id",
    "join_anchors": """SELECT k.id, coalesce(n_langs, 0) AS n_langs, n_texts
        FROM keyed1 k LEFT JOIN anchors_flat a ON k.id = a.id""",
    "join_all": f"""SELECT k.id, k.uuid, spam_rank, {RANKED}, anchors FROM keyed1 k LEFT JOIN spam s ON k.id = s.id
        LEFT JOIN page_ranks p ON k.id = p.id LEFT JOIN anchors_flat a ON k.id = a.id""",
    "orphan_ids": """SELECT id FROM (SELECT id FROM spam UNION SELECT id FROM page_ranks UNION SELECT id FROM anchors)
        WHERE id NOT IN (SELECT id FROM final1)""",
    "merge_duplicates": f"""SELECT {COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY
        date DESC NULLS LAST, warc_record_id DESC NULLS LAST, warc_target_uri DESC NULLS LAST, 
        md5(concat_ws(chr(31), body, full_body, headings, title, meta_desc, meta_keywords)) DESC) AS r
        FROM (SELECT {COLUMNS} FROM final1 UNION ALL SELECT {COLUMNS} FROM final2)) WHERE r = 1""",
    "record_status": "SELECT key, status FROM outcomes",
    "job_counters": """SELECT unnest(['TOTAL_RECORDS', 'RECORDS', 'SKIPPED_RECORDS_JSON_PARSE_ERROR',
        'SKIPPED_RECORDS_TOO_LARGE', 'SKIPPED_RECORDS_TOO_SMALL', 'SKIPPED_RECORDS_NO_RESPONSE_RECORD',
        'SKIPPED_RECORDS_HTML_PARSE_ERROR', 'SKIPPED_RECORDS_BINARY', 'SKIPPED_RECORDS_NO_ID', 'LANGDETECT_FAILED',
        'GENERATED_DOCS', 'NO_CONTENT']) AS counter,
        unnest([total, records, json, too_large, too_small, no_response, 0, bin, no_id, lang_failed, generated,
        no_content]) AS value FROM counts""",
    "job_summary": """SELECT total AS total_records, records, too_large AS skipped_too_large,
        CAST(0 AS BIGINT) AS skipped_html_parse_error, generated, no_content FROM counts""",
    "index_documents": f"SELECT {COLUMNS}, spam_rank, {RANKED}, anchors FROM documents_built",
    "index_anchors": """SELECT f.uuid, a.lang, a.anchor, count(*) AS n
        FROM (SELECT DISTINCT id, uuid FROM final1) f JOIN anchor_langs a ON f.id = a.id GROUP BY f.uuid, a.lang, a.anchor""",
    "index_documents_batch": f"SELECT {COLUMNS}, spam_rank, {RANKED}, anchors FROM documents_built",
    "index_json": f"SELECT uuid, '{{' || concat_ws(',', {JSON_FIELDS}) || '}}' AS document FROM documents_built d",
    "upsert_runs": f"""SELECT {", ".join("f." + c for c in COLUMNS.split(", "))}, spam_rank, {RANKED}, n_anchors, n_lines FROM (
        SELECT f.* FROM final1 f WHERE uuid NOT IN (SELECT f.uuid FROM final2 f JOIN keyed2 k ON f.id = k.id WHERE CAST(k.key AS BIGINT) % 100 % 3 <> 0)
        UNION ALL SELECT f.* FROM final2 f JOIN (SELECT DISTINCT id FROM keyed2 WHERE CAST(key AS BIGINT) % 100 % 3 <> 0) k ON f.id = k.id) f
        LEFT JOIN spam s ON f.id = s.id LEFT JOIN page_ranks p ON f.id = p.id
        LEFT JOIN (SELECT id, count(DISTINCT anchor) AS n_anchors, count(*) AS n_lines FROM anchor_langs GROUP BY id) a ON f.id = a.id""",
    "upsert_documents": f"""SELECT {COLUMNS} FROM final1 WHERE uuid NOT IN (SELECT uuid FROM final2)
        UNION ALL SELECT {COLUMNS} FROM final2""",
}


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in re.findall(r"(?:FROM|JOIN)\s+(\w+)", sql):
        if name in CTES and name not in found:
            _needed(CTES[name], found)
            found.append(name)
    return found


def statement(select: str) -> str:
    names = _needed(select, [])
    if not names:
        return select
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in names) + "\n" + select


def oracle_sql() -> dict[str, str]:
    return {name: statement(select) for name, select in SELECTS.items()}
