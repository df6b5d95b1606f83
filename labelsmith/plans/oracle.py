"""DuckDB twins of the registered queries (SQL text over the pre-registered driver tables).

The CTE chain below restates each operator in plain SQL: ``parsed`` (B1-B3), ``answers``
(D1 + C1-C7), ``annotated``, ``states``, ``records`` and the taxonomy chain (F1-F3, G1).
Queries append their own ``SELECT``; unused CTEs cost nothing in DuckDB.
"""

from __future__ import annotations

from .. import config as C
from ..fixtures import A_CTE, H_CTE, PRIOR_CTE, T_CTE

WS = C.WHITESPACE_CLASS


def trim_ws(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def ascii_lower(x: str) -> str:
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def looks_html(ct: str, body: str) -> str:
    head = ascii_lower(f"substr({body}, 1, {C.HTML_PREFIX_CHARS})")
    markers = " OR ".join(f"contains({head}, '{m}')" for m in C.HTML_MARKERS)
    return f"(contains({ascii_lower(f'coalesce({ct}, {chr(39)}{chr(39)})')}, 'text/html') OR {markers})"


def html_summary(body: str) -> str:
    title = trim_ws(f"regexp_extract({body}, '(?is)<title>(.*?)</title>', 1)")
    snippet = f"substr(regexp_replace({trim_ws(body)}, '{WS}+', ' ', 'g'), 1, {C.HTML_SNIPPET_CHARS})"
    return (f"(CASE WHEN {title} <> '' THEN 'title: ' || {title} "
            f"WHEN {snippet} <> '' THEN 'snippet: ' || {snippet} ELSE 'empty HTML body' END)")


def looks_not_found(body: str) -> str:
    return f"contains({ascii_lower(body)}, '{C.NOT_FOUND_TEXT.replace(chr(39), chr(39) * 2)}')"


def json_object(body: str) -> str:
    return f"coalesce(json_valid({body}) AND regexp_matches({body}, '^[ \\t\\n\\r]*\\{{'), false)"


def has_classification(body: str) -> str:
    parts = " OR ".join(f"coalesce(json_type({body}, '$.{n}') <> 'NULL', false)"
                        for n in C.LAYER_NAMES)
    return f"({parts})"


def compact_error(msg: str) -> str:
    low = ascii_lower(msg)
    whens = " ".join(f"WHEN contains({low}, '{n}') THEN '{b}'" for n, b in C.ERROR_BUCKETS)
    return f"(CASE {whens} ELSE '{C.ERROR_BUCKET_DEFAULT}' END)"


def backoff_reason(msg: str) -> str:
    low = ascii_lower(msg)
    return (f"(CASE WHEN contains({low}, 'throttled') THEN 'throttle' "
            f"WHEN contains({low}, 'returned html') THEN 'html' END)")


def display_name(x: str) -> str:
    t = trim_ws(x)
    return f"(CASE WHEN {t} = '' THEN '{C.UNNAMED_CLASS}' ELSE {t} END)"


PARSED_CTE = f"""
split0 AS (SELECT row_index, line, string_split(regexp_replace(line, '[\\r\\n]+$', ''), chr(9)) AS parts FROM submissions),
split1 AS (SELECT row_index, line, {trim_ws('parts[1]')} AS t1,
    CASE WHEN len(parts) >= 2 THEN {trim_ws('parts[2]')} END AS inchi,
    CASE WHEN len(parts) >= 3 THEN {trim_ws("array_to_string(parts[3:], chr(9))")} END AS inchikey FROM split0),
parsed AS (SELECT row_index, line,
    CASE WHEN regexp_full_match(t1, '[+-]?[0-9]+') THEN try_cast(t1 AS BIGINT) END AS cid, inchi, inchikey,
    CASE WHEN NOT regexp_full_match(t1, '[+-]?[0-9]+') OR try_cast(t1 AS BIGINT) IS NULL THEN '{C.MSG_CID_NOT_INTEGER}'
         WHEN inchi IS NULL THEN '{C.MSG_MISSING_INCHI}'
         WHEN inchikey IS NULL THEN '{C.MSG_MISSING_INCHIKEY}'
         WHEN inchi = '' OR inchikey = '' THEN '{C.MSG_EMPTY_FIELD}'
         WHEN NOT (strlen(inchikey) = 27 AND regexp_full_match(inchikey, '[A-Z]{{14}}-[A-Z]{{10}}-[A-Z]')) THEN '{C.MSG_BAD_KEY}'
    END AS invalid_reason FROM split1)"""

ANSWER_STATE = f"""CASE WHEN status = 429 THEN '{C.FAILED}'
    WHEN {looks_html('content_type', 'body')} THEN '{C.FAILED}'
    WHEN status = 404 OR {looks_not_found('body')} THEN '{C.MISS}'
    WHEN status >= 400 THEN '{C.FAILED}'
    WHEN {trim_ws('body')} = '' THEN '{C.MISS}'
    WHEN NOT {json_object('body')} THEN '{C.FAILED}'
    WHEN {has_classification('body')} THEN '{C.SUCCESS}'
    ELSE '{C.MISS}' END"""

ANSWER_REASON = f"""CASE WHEN status = 429 THEN '{C.MSG_THROTTLED}'
    WHEN {looks_html('content_type', 'body')} THEN '{C.MSG_HTML_PREFIX} (' || {html_summary('body')} || ')'
    WHEN status = 404 OR {looks_not_found('body')} THEN NULL
    WHEN status >= 400 THEN '{C.MSG_STATUS_PREFIX}' || cast(status AS VARCHAR)
    WHEN {trim_ws('body')} = '' THEN NULL
    WHEN NOT {json_object('body')} THEN '{C.MSG_BAD_JSON}' END"""

ANNOTATED_CTE = f"""
joined AS (SELECT p.*, r.status, r.content_type, r.body, r.fetched_at FROM parsed p
    LEFT JOIN responses r ON p.invalid_reason IS NULL AND p.inchikey = r.inchikey),
annotated AS (SELECT *,
    CASE WHEN invalid_reason IS NOT NULL THEN '{C.INVALID}' WHEN status IS NULL THEN '{C.PENDING}'
         ELSE ({ANSWER_STATE}) END AS state,
    CASE WHEN invalid_reason IS NOT NULL THEN invalid_reason WHEN status IS NULL THEN NULL
         ELSE ({ANSWER_REASON}) END AS reason FROM joined),
states AS (SELECT row_index, state, reason FROM annotated WHERE state <> '{C.PENDING}'),
records AS (SELECT row_index, cid, inchi, inchikey, fetched_at, body AS {C.ANSWER_FIELD} FROM annotated WHERE state = '{C.SUCCESS}')"""


def _layer_select(no: int, name: str) -> str:
    node = f"json_extract({C.ANSWER_FIELD}, '$.{name}')"
    return (f"SELECT row_index, {no} AS layer_no, '{name}' AS layer, "
            f"json_extract_string({node}, '$.name') AS name, "
            f"json_extract_string({node}, '$.chemont_id') AS chemont_id FROM records "
            f"WHERE json_type({node}) = 'OBJECT'")


TAXONOMY_CTE = f"""
tax_long AS ({' UNION ALL '.join(_layer_select(no, name) for no, name, _, _ in C.LAYERS)}),
tax_nodes AS (SELECT row_index, layer_no, layer, {display_name('name')} AS name, chemont_id,
    coalesce(chemont_id, {ascii_lower(display_name('name'))}) AS class_key FROM tax_long),
tax_first AS (SELECT layer_no, layer, class_key,
    min_by(struct_pack(name := name, chemont_id := chemont_id), row_index) AS f, count(*) AS label_count
    FROM tax_nodes GROUP BY layer_no, layer, class_key),
tax_counts AS (SELECT layer_no, layer, class_key, f.name AS name, f.chemont_id AS chemont_id, label_count
    FROM tax_first),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY layer_no ORDER BY label_count DESC, name, class_key) AS INTEGER) AS rk
    FROM tax_counts),
layers AS (SELECT * FROM (VALUES {', '.join(f"({no}, '{name}', '{label}', {lim})" for no, name, label, lim in C.LAYERS)})
    AS v(layer_no, layer, label, panel_limit))"""

COUNTS_CTE = f"""
counts AS (SELECT {', '.join(f"CAST(count_if(state = '{s}') AS BIGINT) AS {s}_rows" for s in C.STATES)} FROM states),
totals AS (SELECT count(*) AS total_rows FROM submissions)"""

BASE = ("WITH " + T_CTE.strip() + "," + PARSED_CTE + "," + ANNOTATED_CTE + "," + TAXONOMY_CTE
        + "," + COUNTS_CTE + "," + PRIOR_CTE)

ATTEMPTS = "WITH " + A_CTE.strip()
BODIES = "WITH " + H_CTE.strip()


def on_t(select: str) -> str:
    return BASE + "\n" + select


def on_a(select: str, extra_ctes: str = "") -> str:
    return ATTEMPTS + (("," + extra_ctes) if extra_ctes else "") + "\n" + select


def on_h(select: str) -> str:
    return BODIES + "\n" + select
