"""SQL twins of the queries, for checking results in another engine."""

from __future__ import annotations

from ..functions import text
from ..operators.cost import DEFAULT_PRICING
from . import queries as q

#: The prompt of the queries' labels and window, written out.
SYSTEM = (
    "You edit news. Answer with one JSON object and nothing else. Its members:\n"
    '"title": a factual headline in sentence case, at most 80 characters;\n'
    '"category": one of these labels, spelled the same: src1, src2, src3, Other;\n'
    '"date": the likely year and month of publication as YYYY-MM, between 2007-04 and 2015-04, '
    "judged by the events, people and dates in the text.\n"
    'Example: {"title": "Storm closes two ports", "category": "src1", "date": "2007-04"}\n'
)

SPACES = "||".join(f"chr({ord(c)})" for c in text.WHITESPACE)


def strip(x: str) -> str:
    return f"trim({x}, {SPACES})"


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


def draw(purpose: str, id_: str) -> str:
    return f"CAST(('0x' || substr(md5('42:{purpose}:' || {id_}), 1, 8)) AS BIGINT)"


def hash_of(x: str) -> str:
    return f"(CASE WHEN {strip(x)} = '' THEN '' ELSE md5({strip(x)}) END)"


def truncated(x: str, n: int) -> str:
    return (
        f"(CASE WHEN length({x}) > {n} THEN "
        rf"regexp_replace(left({x}, {n}), '(?s) [^ ]*\z', '') || '...' ELSE {x} END)"
    )


def escaped(x: str) -> str:
    for char, entity in text.HTML_ENTITIES:
        x = f"replace({x}, {quoted(char)}, {quoted(entity)})"
    return x


def clean_title(x: str) -> str:
    line = strip(f"split_part({x}, chr(10), 1)")
    line = strip(rf"regexp_replace({line}, '(?i)\A(headline:|title:)', '')")
    for mark in ('"', "'", "*"):
        line = f"trim({line}, {quoted(mark)})"
    return strip(line)


def picked_author(id_: str) -> str:
    return f"{sql_list(q.POOL)}[CAST({draw('author', id_)} % {len(q.POOL)} + 1 AS INTEGER)]"


SPAN = f"(date_diff('second', TIMESTAMP '{q.START}', TIMESTAMP '{q.END}') + 1)"


def picked_date(id_: str) -> str:
    high = f"({draw('date_hi', id_)} & {2**30 - 1})"
    moment = f"TIMESTAMP '{q.START}' + to_seconds((({high} << 32) | {draw('date', id_)}) % {SPAN})"
    return f"strftime({moment}, '%Y-%m-%dT%H:%M:%S')"


def date_of_month(ym: str, id_: str, start: str, end: str) -> str:
    days = f"day(last_day(CAST({ym} || '-01' AS DATE)))"
    return (
        f"CASE WHEN {ym} BETWEEN '{start[:7]}' AND '{end[:7]}' THEN printf('%s-%02dT%02d:%02d:%02d', {ym}, "
        f"{draw('day', id_)} % {days} + 1, {draw('hour', id_)} % 24, "
        f"{draw('minute', id_)} % 60, {draw('second', id_)} % 60) END"
    )


def blocks(x: str) -> str:
    lines = rf"regexp_split_to_array({strip('p')}, '\r\n|[\n\x0b\f\r\x1c\x1d\x1e\x{{85}}\x{{2028}}\x{{2029}}]')"
    kept = f"list_filter({lines}, lambda s: {strip('s')} <> '')"
    body = f"array_to_string(list_transform({kept}, lambda s: {escaped('s')}), '<br/>')"
    paragraphs = rf"regexp_split_to_array({x}, '(?:\r?\n\s*){{2,}}')"
    made = f"list_filter(list_transform({paragraphs}, lambda p: {body}), lambda b: b <> '')"
    wrapped = (
        f"list_transform({made}, lambda b: {quoted(text.BLOCK_OPEN)} || b || {quoted(text.BLOCK_CLOSE)})"
    )
    return f"array_to_string({wrapped}, chr(10) || chr(10))"


DOCS = (
    "(SELECT doc_id, CAST(doc_id AS VARCHAR) AS source_id, text AS body, lang AS title, source AS category, "
    f"{hash_of('text')} AS content_hash, md5('42:sample:' || doc_id) AS sample_key FROM documents)"
)
KNOWN = f"(SELECT {hash_of('text')} AS h FROM documents WHERE source = 'src0')"
DONE = "(SELECT CAST(doc_id AS VARCHAR) AS id FROM labels)"
FIRST = "row_number() OVER (PARTITION BY content_hash ORDER BY sample_key, source_id) = 1"
FRESH = f"(SELECT * FROM {DOCS} WHERE source_id NOT IN (SELECT id FROM {DONE}))"


def kept(rows: str, columns: str, known: bool) -> str:
    drop = f" AND content_hash NOT IN (SELECT h FROM {KNOWN})" if known else ""
    return (
        f"SELECT {columns} FROM (SELECT * FROM {rows} WHERE content_hash <> ''{drop} QUALIFY {FIRST})"
        f" UNION ALL SELECT {columns} FROM {rows} WHERE content_hash = ''"
    )


POST = f"""CASE WHEN {strip('title')} = '' THEN 'Untitled' ELSE {strip('title')} END AS title,
    body AS content,
    CASE WHEN {strip('category')} = '' THEN 'src1' ELSE {strip('category')} END AS category,
    {picked_author('source_id')} AS author, {picked_date('source_id')} AS date_gmt, source_id, content_hash"""

KEPT = f"({kept(FRESH, '*', True)})"

FUNNEL = f"""
SELECT (SELECT count(*) FROM documents) AS fetched,
    count(*) AS after_source_id_resume,
    count(*) FILTER (content_hash <> '' AND known) AS cross_run,
    count(*) FILTER (content_hash <> '' AND NOT known AND n > 1) AS within_run,
    count(*) FILTER (content_hash = '') AS empty_hash,
    count(*) FILTER (content_hash = '' OR (NOT known AND n = 1)) AS after_content_dedup
FROM (SELECT *, content_hash IN (SELECT h FROM {KNOWN}) AS known,
        row_number() OVER (PARTITION BY content_hash ORDER BY sample_key) AS n FROM {FRESH})"""

# what each language's model output says; Spanish output is no JSON
PLAIN = "replace(replace(text, '{', '('), '}', ')')"
MONTH = "printf('%04d-%02d', n_chars % 10 + 2005, n_chars % 14)"


def label_in(x: str) -> str:
    cases = " ".join(f"WHEN contains(lower({x}), {quoted(v.lower())}) THEN {quoted(v)}" for v in q.LABELS)
    return f"CASE {cases} ELSE '' END"


def month_or_blank(x: str) -> str:
    return rf"CASE WHEN regexp_matches({x}, '^\d{{4}}-(0[1-9]|1[0-2])$') THEN {x} ELSE '' END"


# the synth stub, restated: cleaned body, message digest, and the answer drawn from it
STUB = f"""(SELECT *, CAST(('0x' || substr(md5(message), 1, 8)) AS BIGINT) AS d
    FROM (SELECT *, 'Article:' || chr(10) || chr(10) || left(cleaned, 4000) || chr(10) || chr(10) || 'JSON:' AS message
    FROM (SELECT *, {strip("regexp_replace(body, '([A-Za-z]+), ([a-z]+)', chr(92) || '2; ' || chr(92) || '1', 'g')")} AS cleaned
    FROM {DOCS})))"""
STUB_MONTH = "printf('%04d-%02d', 2005 + d % 12, d % 14)"
SUMMARY = truncated(strip(f"split_part({strip('body')}, '.', 1)"), q.TITLE_LIMIT)

CACHED = f"""(SELECT *, CASE WHEN toxic = 1 THEN 'second' ELSE 'first' END AS cached_title
    FROM labels WHERE quality = 1)"""

EVENT_LOG = """(SELECT CAST(user_id AS VARCHAR) AS source_id, event_id AS post_id,
    event_type || ':' || CAST(floor(value) AS BIGINT) AS content_hash FROM events WHERE event_id > 0)"""

LOG = """(SELECT CAST(o_orderkey AS VARCHAR) AS source_id, o_orderkey + 1 AS post_id,
    CASE WHEN o_orderpriority = '1-URGENT' THEN md5(CAST(o_orderkey AS VARCHAR)) END AS content_hash
    FROM orders WHERE o_orderstatus IN ('F', 'P'))"""
TARGET = """(SELECT CAST(o_orderkey AS VARCHAR) AS source_id,
    o_orderkey + 1 + CASE WHEN o_orderpriority = '2-HIGH' THEN 10000000 ELSE 0 END AS post_id,
    md5(CAST(o_orderkey AS VARCHAR)) AS content_hash FROM orders WHERE o_orderstatus IN ('F', 'O'))"""

SLUG = "regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g')"


def slug(x: str, default: str) -> str:
    return f"coalesce(nullif(trim({SLUG.format(x=x)}, '-'), ''), '{default}')"


CATEGORY_MATCH = f"""(SELECT w.name, {slug('w.name', 'category')} AS slug,
        coalesce(max(CASE WHEN lower(d.n_name) = lower(w.name) THEN d.n_nationkey END),
            max(CASE WHEN {slug('d.n_name', 'category')} = {slug('w.name', 'category')} THEN d.n_nationkey END)) AS id
    FROM (SELECT lower(n_name) AS name FROM nation UNION SELECT replace(n_name, '_', ' ') FROM nation
        UNION SELECT source FROM documents UNION SELECT upper(source) FROM documents) w
    LEFT JOIN nation d ON lower(d.n_name) = lower(w.name)
        OR {slug('d.n_name', 'category')} = {slug('w.name', 'category')}
    GROUP BY w.name)"""

PEOPLE = "(SELECT c_custkey, c_mktsegment, c_mktsegment || ' ' || c_name AS name FROM customer)"
AUTHOR_MATCH = f"""(SELECT name, {slug('name', 'author')} AS slug, max(CASE WHEN c_mktsegment = 'BUILDING'
    THEN c_custkey + 1 END) AS id FROM {PEOPLE} GROUP BY name)"""


def numbered(match: str, top: str) -> str:
    """New ids of the slugs without one, in the order of their MD5."""
    return f"""(SELECT slug, min(name) AS name, {top} + row_number() OVER (ORDER BY md5(slug), slug) AS new_id
        FROM {match} WHERE id IS NULL GROUP BY slug)"""


BUILDING_TOP = "(SELECT max(c_custkey) + 1 FROM customer WHERE c_mktsegment = 'BUILDING')"

TURNS = f"""(SELECT CAST(conv_id AS VARCHAR) AS source_id, CAST(turn AS VARCHAR) AS title, text AS body,
    role AS category, {hash_of('text')} AS content_hash,
    {picked_author('CAST(conv_id AS VARCHAR)')} AS author, {picked_date('CAST(conv_id AS VARCHAR)')} AS date_gmt,
    length(role) AS role_id, role IN (SELECT role FROM conversations WHERE turn > 0) AS has_category
    FROM conversations)"""
SYSTEMS = """(SELECT DISTINCT CAST(conv_id AS VARCHAR) AS source_id, conv_id + 1 AS post_id
    FROM conversations WHERE role = 'system')"""
NEW_IDS = f"""(SELECT source_id, 1000000 + row_number() OVER (ORDER BY md5(source_id), source_id) AS post_id
    FROM (SELECT DISTINCT source_id FROM {TURNS} WHERE has_category
        AND source_id NOT IN (SELECT source_id FROM {SYSTEMS})))"""
OUTCOMES = f"""(SELECT t.source_id, has_category AS ok,
    CASE WHEN has_category THEN coalesce(s.post_id, n.post_id) END AS post_id,
    CASE WHEN has_category AND (s.post_id IS NOT NULL OR
        row_number() OVER (PARTITION BY t.source_id, has_category ORDER BY t.title) > 1) THEN true END AS skipped,
    CASE WHEN NOT has_category THEN 'category not in mapping: ''' || category || '''' END AS error
    FROM {TURNS} t LEFT JOIN {SYSTEMS} s USING (source_id) LEFT JOIN {NEW_IDS} n USING (source_id))"""
CREATED = f"""(SELECT n.post_id, t.* FROM {TURNS} t JOIN {NEW_IDS} n USING (source_id) WHERE has_category
    QUALIFY row_number() OVER (PARTITION BY t.source_id ORDER BY content_hash, t.title, date_gmt) = 1)"""
AUTHOR_ID = f"CASE author WHEN {quoted(q.POOL[0])} THEN 1 WHEN {quoted(q.POOL[1])} THEN 2 END"


def request() -> str:
    """The JSON text of a publish request, put together by hand."""

    def text_of(x: str) -> str:
        return f"CAST(to_json({x}) AS VARCHAR)"

    byline = f"{quoted(text.BLOCK_OPEN + '<em>By ')} || {escaped('author')} || {quoted('</em>' + text.BLOCK_CLOSE)}"
    content = f"{byline} || chr(10) || chr(10) || {blocks('body')}"
    return f"""'{{"title":' || {text_of(escaped('title'))} || ',"content":' || {text_of(content)}
        || ',"status":"draft","date_gmt":' || {text_of('date_gmt')} || ',"categories":[' || role_id
        || '],"meta":{{"source_id":' || {text_of('source_id')} || ',"byline":' || {text_of('author')}
        || ',"content_hash":' || {text_of('content_hash')} || '}}'
        || coalesce(',"author":' || {AUTHOR_ID}, '') || '}}'"""


USAGE = f"""(SELECT {sql_list(q.MODELS)}[CAST(turn % {len(q.MODELS)} + 1 AS INTEGER)] AS model,
    CASE WHEN role = 'user' THEN length(text) // 4 ELSE 0 END AS input_tokens,
    CASE WHEN role = 'user' THEN 0 ELSE length(text) // 4 END AS output_tokens, turn AS retries
    FROM conversations)"""
PRICES = "(VALUES " + ", ".join(
    f"({quoted(m)}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for m, (a, b) in DEFAULT_PRICING.items()
) + ") AS p(listed, input_rate, output_rate)"
TOTALS = f"""(SELECT model, count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
    CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(retries) AS BIGINT) AS retries
    FROM {USAGE} GROUP BY model)"""

SPACED = r"CASE WHEN lang = 'fr' THEN text ELSE replace(text, '.' || chr(10), '.' || chr(10) || ' ' || chr(10)) END"

ORACLE: dict[str, str] = {
    "field_map_project": """SELECT CAST(doc_id AS VARCHAR) AS source_id, text AS body, lang AS title,
        source AS category, CASE WHEN n_chars = 0 THEN '' ELSE CAST(n_chars AS VARCHAR) END AS size, '' AS extra
        FROM documents""",
    "jsonl_parse": """SELECT event_id, json_extract_string(props, '$.k') AS raw_k,
        CASE WHEN json_extract_string(props, '$.k') = '0' THEN '' ELSE json_extract_string(props, '$.k') END AS k,
        '' AS missing FROM events WHERE json_valid(props)""",
    "jsonl_line_counts": """SELECT count(*) AS blank, count(*) FILTER (NOT json_valid(event_type))
        + count(*) FILTER (NOT json_valid(props)) AS malformed,
        count(*) FILTER (json_valid(props)) AS parsed FROM events""",
    "sample_seeded": f"""SELECT CAST(doc_id AS VARCHAR) AS source_id, md5('42:sample:' || doc_id) AS sample_key,
        text AS body FROM documents ORDER BY sample_key, doc_id LIMIT {q.SAMPLE}""",
    "position_id": """SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS source_id,
        md5(text) AS body_md5 FROM documents""",
    "content_hash": f"SELECT source_id, content_hash FROM {DOCS}",
    "resume_filter": f"SELECT source_id, body, category FROM {FRESH}",
    "within_run_dedup": kept(DOCS, "source_id, content_hash, body", False),
    "cross_run_dedup": kept(DOCS, "source_id, content_hash, body", True),
    "select_rows": kept(FRESH, "source_id, content_hash, body, category", True),
    "rows_funnel": FUNNEL,
    "hash_coverage": f"""SELECT n AS after_source_id_resume, e AS empty_hash,
        CASE WHEN n = 0 THEN 'ok' WHEN e >= n THEN 'none' WHEN e * 2 >= n THEN 'partial' ELSE 'ok' END AS coverage
        FROM (SELECT count(*) AS n, count(*) FILTER (lang = 'en' OR {hash_of('text')} = '') AS e FROM documents)""",
    "clean_regex_strip": "SELECT doc_id, regexp_replace(text, '(?sm)^[A-Z][a-z]+ ', '') AS cleaned FROM documents",
    "clean_regex_replace": r"""SELECT doc_id, regexp_replace(text, '([A-Za-z]+), ([a-z]+)', '\2; \1', 'g') AS cleaned
        FROM documents""",
    "clean_html_strip": "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS cleaned FROM pages",
    "clean_collapse": r"SELECT page_id, regexp_replace(html, '[ \t]+', ' ', 'g') AS cleaned FROM pages",
    "clean_chain": rf"""SELECT page_id, {strip(r"regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), "
        r"'[ \t]+', ' ', 'g'), '(?i)[a-z]+\*+', '')")} AS cleaned FROM pages""",
    "author_pick": f"SELECT doc_id, {picked_author('doc_id')} AS author FROM documents",
    "date_pick": f"SELECT doc_id, {picked_date('doc_id')} AS date_gmt FROM documents",
    "date_from_ym": f"""SELECT o_orderkey, {date_of_month('ym', 'o_orderkey', q.ORDER_START, q.ORDER_END)} AS date_gmt
        FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym FROM orders)""",
    "passthrough_posts": f"SELECT {POST} FROM {DOCS}",
    "prepared_posts": f"SELECT {POST} FROM {KEPT}",
    "model_output_parse": f"""SELECT doc_id, CASE WHEN lang = 'es' THEN '' ELSE {truncated('t', q.TITLE_LIMIT)} END AS title,
        CASE WHEN lang = 'es' THEN '' ELSE {label_in("source || ' section'")} END AS category,
        CASE WHEN lang = 'es' THEN '' ELSE {month_or_blank(MONTH)} END AS date_ym
        FROM (SELECT *, {clean_title(strip(PLAIN))} AS t FROM documents)""",
    "output_conforms": f"""SELECT doc_id, lang = 'en' AND n_chars % 14 BETWEEN 1 AND 12
        AND source IN ({", ".join(f"'src{i}'" for i in range(10))}) AS conforms FROM documents""",
    "title_from_summary": f"""SELECT doc_id, CASE WHEN t = '' THEN 'Untitled' ELSE {truncated('t', q.TITLE_LIMIT)} END AS title
        FROM (SELECT doc_id, {strip(f"split_part({strip('text')}, '.', 1)")} AS t FROM documents)""",
    "title_truncate": f"SELECT doc_id, {truncated('text', q.TITLE_LIMIT)} AS title FROM documents",
    "user_prompt": f"""SELECT doc_id, md5('Article:' || chr(10) || chr(10) || left({strip('text')}, 4000)
        || chr(10) || chr(10) || 'JSON:') AS user_md5,
        md5({quoted(SYSTEM)}) AS system_md5 FROM documents""",
    "synth_posts": f"""SELECT CASE WHEN d % 5 <> 0 THEN 'Item ' || d % 1000
            WHEN {SUMMARY} = '' THEN 'Untitled' ELSE {SUMMARY} END AS title,
        cleaned AS content, {sql_list(q.LABELS)}[CAST(d % 3 + 1 AS INTEGER)] AS category,
        {picked_author('source_id')} AS author,
        CASE WHEN d % 14 BETWEEN 1 AND 12
            THEN coalesce({date_of_month(f"CASE WHEN d % 14 BETWEEN 1 AND 12 THEN {STUB_MONTH} END", 'source_id', q.START, q.END)},
                {picked_date('source_id')})
            ELSE {picked_date('source_id')} END AS date_gmt,
        source_id, content_hash, length(message) // 4 AS input_tokens, d % 50 AS output_tokens FROM {STUB}""",
    "cache_lookup": f"""SELECT c.cached_title AS title, body AS content, category, 'cached author' AS author,
            '2001-01-01T00:00:00' AS date_gmt, source_id, content_hash
        FROM {DOCS} JOIN {CACHED} c USING (doc_id)
        UNION ALL SELECT {POST} FROM {DOCS} WHERE doc_id NOT IN (SELECT doc_id FROM {CACHED})""",
    "cache_counts": """SELECT count(*) FILTER (quality = 1) + count(*) FILTER (quality = 1 AND toxic = 1) AS loaded_at_start,
        count(*) FILTER (quality = 0) + count(*) FILTER (quality = 0 AND toxic = 1) AS stale_at_start,
        count(*) FILTER (quality = 1) AS hits,
        (SELECT count(*) FROM documents) - count(*) FILTER (quality = 1) AS misses,
        (SELECT count(*) FROM documents) AS size FROM labels""",
    "ledger_latest": f"SELECT source_id, max(post_id) AS post_id FROM {EVENT_LOG} GROUP BY source_id",
    "ledger_first_hash": f"SELECT content_hash, min(post_id) AS post_id FROM {EVENT_LOG} GROUP BY content_hash",
    "ledger_point_lookup": f"""SELECT source_id, max(post_id) AS post_id FROM {EVENT_LOG} WHERE source_id = '8'
        GROUP BY source_id""",
    "ledger_merge": f"""SELECT t.source_id, t.post_id, t.content_hash FROM {TARGET} t LEFT JOIN {LOG} l USING (source_id)
        WHERE l.post_id IS DISTINCT FROM t.post_id OR l.content_hash IS NULL""",
    "ledger_replace": f"""SELECT source_id, post_id, CASE WHEN content_hash < '8' THEN content_hash END AS content_hash
        FROM {TARGET}""",
    "ledger_drift": f"""SELECT count(*) FILTER (t.post_id IS NULL) AS only_in_log,
        count(*) FILTER (l.post_id IS NULL) AS only_on_target, count(*) FILTER (l.post_id <> t.post_id) AS differing
        FROM {LOG} l FULL JOIN {TARGET} t USING (source_id)""",
    "ledger_sets": f"""SELECT source_id, CASE WHEN t.post_id IS NULL THEN 'only_in_log'
            WHEN l.post_id IS NULL THEN 'only_on_target' ELSE 'differing' END AS part
        FROM {LOG} l FULL JOIN {TARGET} t USING (source_id) WHERE l.post_id IS DISTINCT FROM t.post_id""",
    "ledger_overlay": f"""SELECT source_id, coalesce(t.post_id, l.post_id) AS post_id
        FROM {LOG} l FULL JOIN {TARGET} t USING (source_id)""",
    "ledger_fill": f"""SELECT content_hash, coalesce(l.post_id, t.post_id) AS post_id
        FROM (SELECT * FROM {LOG} WHERE content_hash IS NOT NULL) l FULL JOIN {TARGET} t USING (content_hash)""",
    "meta_normalise": """SELECT 'pairs:' || user_id AS source_id, event_id AS post_id,
            CASE WHEN event_type <> 'view' THEN event_type END AS content_hash, event_id AS seq
        FROM events WHERE event_id > 0
        UNION ALL SELECT 'map:' || user_id, event_id, event_type, event_id FROM events WHERE event_id > 0""",
    "category_dim": f"""SELECT m.name, CAST(coalesce(m.id, n.new_id) AS BIGINT) AS id FROM {CATEGORY_MATCH} m
        LEFT JOIN {numbered(CATEGORY_MATCH, '(SELECT max(n_nationkey) FROM nation)')} n USING (slug)""",
    "author_dim": f"""SELECT m.name, CAST(coalesce(m.id, n.new_id) AS BIGINT) AS id FROM {AUTHOR_MATCH} m
        LEFT JOIN {numbered(AUTHOR_MATCH, BUILDING_TOP)} n USING (slug)""",
    "author_rows": f"""SELECT new_id AS id, name, slug, slug AS username, slug || '@example.org' AS email,
        split_part(name, ' ', 1) AS first_name, substr(name, instr(name, ' ') + 1) AS last_name
        FROM {numbered(AUTHOR_MATCH, BUILDING_TOP)}""",
    "publish_outcomes": f"SELECT * FROM {OUTCOMES}",
    "created_posts": f"""SELECT post_id, source_id, title, body AS content, role_id AS category_id,
        CAST({AUTHOR_ID} AS BIGINT) AS author_id FROM {CREATED}""",
    "payload": f"SELECT post_id, {request()} AS request FROM {CREATED}",
    "dry_run_outcomes": "SELECT CAST(conv_id AS VARCHAR) AS source_id, true AS ok, true AS dry_run FROM conversations",
    "dry_run_category_ids": f"""SELECT source_id, category, CASE WHEN list_contains({sql_list(q.LABELS)}, category)
        THEN CAST(999 + list_position({sql_list(q.LABELS)}, category) AS BIGINT) END AS category_id FROM {DOCS}""",
    "transform_errors": """SELECT CAST(event_id AS VARCHAR) AS source_id, false AS ok, 'transform: ' || props AS error
        FROM events WHERE event_type = 'error'""",
    "recover_lost": """SELECT CAST(o_orderkey AS VARCHAR) AS source_id, NOT failed OR hit AS ok,
            CASE WHEN NOT failed OR hit THEN o_orderkey + 1 END AS post_id,
            CASE WHEN failed AND hit THEN true END AS skipped,
            CASE WHEN failed AND hit THEN true END AS recovered_after_retry,
            CASE WHEN failed AND NOT hit THEN 'HTTP 503' END AS error,
            CASE WHEN failed AND NOT hit THEN CAST(503 AS INTEGER) END AS status
        FROM (SELECT *, o_orderstatus = 'F' AS failed, o_orderpriority = '1-URGENT' AS hit FROM orders)""",
    "block_content": f"SELECT doc_id, {blocks('t')} AS blocks FROM (SELECT doc_id, {SPACED} AS t FROM documents)",
    "redact": f"""SELECT doc_id, r AS redacted, left(r, 300) AS excerpt
        FROM (SELECT doc_id, regexp_replace(text, '{text.TOKEN_RUN}', '{text.REDACTED}', 'g') AS r FROM documents)""",
    "usage_totals": f"SELECT * FROM {TOTALS}",
    "chat_cost": f"""SELECT model, input_tokens, output_tokens,
            round((input_tokens * coalesce(r.input_rate, 0) + output_tokens * coalesce(r.output_rate, 0)) / 1000000, 6) AS est_usd,
            r.listed IS NOT NULL AS priced
        FROM {TOTALS} LEFT JOIN (SELECT model, listed, input_rate, output_rate
            FROM (SELECT DISTINCT model FROM {USAGE}), {PRICES}
            WHERE lower(model) = lower(listed) OR starts_with(lower(model), lower(listed) || '-')
            QUALIFY row_number() OVER (PARTITION BY model ORDER BY length(listed) DESC) = 1) r USING (model)""",
    "embedding_cost": """SELECT posts, est_tokens, 'openai' AS provider, 'text-embedding-3-small' AS model,
            CAST(768 AS INTEGER) AS dimensions, round(est_tokens * CAST(0.02 AS DOUBLE) / 1000000, 4) AS est_usd
        FROM (SELECT count(*) AS posts, CAST(sum(length(text)) AS BIGINT) // 4 AS est_tokens FROM documents)""",
    "summary_report": f"""SELECT f.fetched AS rows_fetched, f.fetched AS posts_prepared,
            count(*) FILTER (ok) AS posts_uploaded, count(*) FILTER (ok AND skipped IS NULL) AS posts_created,
            count(*) FILTER (skipped) AS posts_skipped_existing, CAST(0 AS BIGINT) AS posts_recovered,
            count(*) FILTER (NOT ok) AS posts_failed,
            CAST(CASE WHEN count(*) FILTER (NOT ok) > 0 THEN 1 ELSE 0 END AS INTEGER) AS exit_code,
            round(CAST(12.345 AS DOUBLE), 2) AS elapsed_sec,
            round(CAST(12.345 AS DOUBLE) / f.fetched, 4) AS pace_sec_per_post,
            any_value(f.after_content_dedup) AS after_content_dedup, any_value(f.within_run) AS within_run,
            (SELECT CAST(sum(length(text)) AS BIGINT) // 4 FROM documents) AS est_tokens
        FROM {OUTCOMES}, ({FUNNEL}) f GROUP BY f.fetched""",
    "stream_transform": f"SELECT {POST} FROM {DOCS}",
    "stream_distinct": f"""SELECT content_hash, {strip('any_value(body)')} AS body FROM {DOCS}
        WHERE content_hash <> '' GROUP BY content_hash
        UNION ALL SELECT content_hash, '' FROM {DOCS} WHERE content_hash = ''""",
    "stream_posts": f"""SELECT row_number() OVER (ORDER BY md5(source_id), source_id) AS post_id, source_id, {escaped('title')} AS title,
            {picked_date('source_id')} AS date_gmt, category_id, content_hash
        FROM ({kept(DOCS, '*', False)})
        JOIN (SELECT source AS category, min(doc_id) AS category_id FROM documents GROUP BY source) USING (category)""",
}
