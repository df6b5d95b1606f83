"""

Every query reads the driver's tables (through the fixtures) and runs over the whole tables.
Keys without an entry in ``ORACLE`` are checked rows-only by the driver (file listings and
stream checkpoints, whose content SQL cannot see).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .. import fixtures as X
from ..functions import (has_classification, held, html_summary, json_object_body, looks_html,
                         looks_not_found, read_answers, valid_key)
from ..operators import classify, lookup, parse, report, taxonomy
from ..session import apply_query_conf, scratch_dir
from . import annotate as P
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_query_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return run
    return deco


# ------------------------------------------------------------------ 2.2 parsing and validation

@query("parse_submissions", O.on_t(
    "SELECT row_index, cid, inchi, inchikey, invalid_reason FROM parsed"))
def q_parse(spark, d):
    """B1: split, trim and type every input line."""
    return P.parsed(spark, d).select("row_index", "cid", "inchi", "inchikey", "invalid_reason")


@query("valid_key", O.on_t(
    "SELECT row_index, inchikey, coalesce(strlen(inchikey) = 27 AND "
    "regexp_full_match(inchikey, '[A-Z]{14}-[A-Z]{10}-[A-Z]'), false) AS key_ok "
    "FROM parsed WHERE inchikey IS NOT NULL"))
def q_valid_key(spark, d):
    """B2: key shape test on every parsed key."""
    p = P.parsed(spark, d).where(F.col("inchikey").isNotNull())
    return p.select("row_index", "inchikey", valid_key("inchikey").alias("key_ok"))


@query("invalid_reason", O.on_t(
    "SELECT row_index, line, invalid_reason FROM parsed WHERE invalid_reason IS NOT NULL"))
def q_invalid_reason(spark, d):
    """First failing check per invalid row."""
    p = P.parsed(spark, d)
    return p.where(F.col("invalid_reason").isNotNull()).select("row_index", "line", "invalid_reason")


@query("quarantine_split", O.on_t(
    "SELECT CASE WHEN invalid_reason IS NULL THEN 'valid' ELSE 'invalid' END AS split, "
    "count(*) AS rows FROM parsed GROUP BY 1"))
def q_quarantine(spark, d):
    """Valid vs invalid rows, counted in one pass."""
    return parse.quarantine_counts(P.parsed(spark, d))


@query("success_records", O.on_t(
    f"SELECT row_index, cid, inchi, inchikey, fetched_at, {C.ANSWER_FIELD} FROM records"))
def q_success_records(spark, d):
    """Successful rows as records, body verbatim."""
    return P.records(P.annotated(spark, d))


# ------------------------------------------------------------------ 2.3 answer classification

@query("looks_html", O.on_h(
    f"SELECT src, body_id, {O.looks_html('content_type', 'body')} AS looks_html FROM bodies"))
def q_looks_html(spark, d):
    """HTML detection over pages and documents."""
    b = X.bodies(spark, d)
    return b.select("src", "body_id", looks_html("content_type", "body").alias("looks_html"))


@query("html_summary", O.on_h(
    f"SELECT src, body_id, {O.html_summary('body')} AS summary FROM bodies"))
def q_html_summary(spark, d):
    """Title or whitespace-collapsed snippet of every body (whole texts)."""
    b = X.bodies(spark, d)
    return b.select("src", "body_id", html_summary("body").alias("summary"))


@query("looks_not_found", O.on_t(
    f", {X.H_CTE.strip()} "
    f"SELECT 'answers' AS src, inchikey AS body_key, {O.looks_not_found('body')} AS not_found "
    f"FROM responses UNION ALL "
    f"SELECT src, cast(body_id AS VARCHAR), {O.looks_not_found('body')} FROM bodies"))
def q_looks_not_found(spark, d):
    """Not-found page text over answers, pages and documents."""
    a = X.responses(spark, d).select(F.lit("answers").alias("src"),
                                     F.col("inchikey").alias("body_key"), "body")
    h = X.bodies(spark, d).select("src", F.col("body_id").cast("string").alias("body_key"), "body")
    return a.unionByName(h).select("src", "body_key", looks_not_found("body").alias("not_found"))


@query("json_valid_body", O.on_t(
    f"SELECT inchikey, {O.json_object('body')} AS json_object FROM responses"))
def q_json_valid(spark, d):
    """C4: body is exactly one JSON object."""
    r = X.responses(spark, d)
    return read_answers(r).select("inchikey", json_object_body(F.col("_entries")).alias("json_object"))


@query("has_classification", O.on_t(
    f"SELECT inchikey, {O.has_classification('body')} AS has_classification FROM responses "
    f"WHERE {O.json_object('body')}"))
def q_has_classification(spark, d):
    """Any of the five taxonomy fields present and not null."""
    r = held(read_answers(X.responses(spark, d)), "_entries").where(json_object_body(F.col("_entries")))
    return r.select("inchikey", has_classification(F.col("_entries")).alias("has_classification"))


@query("classify_answer", O.on_t(
    f"SELECT inchikey, status, ({O.ANSWER_STATE}) AS state FROM responses"))
def q_classify(spark, d):
    """Outcome of every stored answer."""
    return classify.classify_answers(X.responses(spark, d)).select("inchikey", "status", "state")


@query("failure_reason", O.on_t(
    f"SELECT inchikey, reason FROM (SELECT inchikey, ({O.ANSWER_STATE}) AS state, "
    f"({O.ANSWER_REASON}) AS reason FROM responses) WHERE state = 'failed'"))
def q_failure_reason(spark, d):
    """Message of every failed answer."""
    c = classify.classify_answers(X.responses(spark, d))
    return c.where(F.col("state") == C.FAILED).select("inchikey", "reason")


@query("compact_error", O.on_t(
    f"SELECT {O.compact_error('reason')} AS bucket, count(*) AS messages FROM states "
    f"WHERE reason IS NOT NULL GROUP BY 1"))
def q_compact_error(spark, d):
    """Error messages of failed and invalid rows per bucket."""
    return classify.error_buckets(P.terminal_states(P.annotated(spark, d)))


@query("backoff_reason", O.on_t(
    f"SELECT row_index, {O.backoff_reason('reason')} AS backoff_reason FROM states "
    f"WHERE state = 'failed' AND {O.backoff_reason('reason')} IS NOT NULL"))
def q_backoff_reason(spark, d):
    """Failed rows that close the request gate, with the reason."""
    st = P.terminal_states(P.annotated(spark, d)).where(F.col("state") == C.FAILED)
    return classify.backoff_rows(st).select("row_index", "backoff_reason")


# ------------------------------------------------------------------ 2.4 joins

@query("lookup_join", O.on_t(
    "SELECT row_index, inchikey, status, content_type, body FROM joined"))
def q_lookup_join(spark, d):
    """Every row with its stored answer (NULLs for invalid and pending rows)."""
    j = lookup.lookup_join(P.parsed(spark, d), X.responses(spark, d))
    return j.select("row_index", "inchikey", "status", "content_type", "body")


@query("stored_lookup_join", O.on_t(
    "SELECT row_index, inchikey, status, content_type, body FROM joined"))
def q_stored_lookup_join(spark, d):
    """D1 over answers stored as Parquet: bodies are fetched last, by their place."""
    path = scratch_dir(spark, "responses")
    X.responses(spark, d).write.parquet(path)
    j = lookup.stored_lookup_join(P.parsed(spark, d), spark.read.parquet(path))
    return j.select("row_index", "inchikey", "status", "content_type", "body")


@query("unprocessed_rows", O.on_t(
    "SELECT s.row_index, s.line FROM submissions s WHERE NOT EXISTS (SELECT 1 FROM states t "
    "JOIN prior_rows p ON t.row_index = p.row_index WHERE t.row_index = s.row_index)"))
def q_unprocessed(spark, d):
    """Rows left after an earlier run that finished the orders placed before 1998."""
    prior = P.terminal_states(P.annotated(spark, d)).join(
        X.prior_run_rows(spark, d), "row_index", "left_semi")
    return lookup.unprocessed_rows(X.submissions(spark, d), prior)


@query("retry_candidates", O.on_t(
    f"SELECT s.row_index, s.line, t.reason, coalesce({O.backoff_reason('t.reason')}, 'error') "
    f"AS backoff_reason FROM submissions s JOIN states t ON s.row_index = t.row_index "
    f"WHERE t.state = 'failed'"))
def q_retry(spark, d):
    """D3: failed rows with their message and backoff class."""
    st = P.terminal_states(P.annotated(spark, d))
    return lookup.retry_candidates(X.submissions(spark, d), st).select(
        "row_index", "line", "reason", "backoff_reason")


# ------------------------------------------------------------------ 2.5 row states (table form)

@query("append_states", O.on_t("SELECT row_index, state, reason FROM states"))
def q_append_states(spark, d):
    """The earlier run's states, then the rest in a batch that is appended twice, as after a lost driver."""
    from ..operators import states as S
    st = P.terminal_states(P.annotated(spark, d))
    path, prior = scratch_dir(spark, "state-table"), X.prior_run_rows(spark, d)
    S.append_states(st.join(prior, "row_index", "left_semi"), path, batch=1)
    rest = st.join(prior, "row_index", "left_anti")
    for _ in range(2):
        S.append_states(rest, path, batch=2)
    return spark.read.parquet(path).select("row_index", "state", "reason")


@query("append_conflicts", O.on_t(
    "SELECT n.row_index, p.state AS existing_state, n.state AS new_state FROM states n "
    "JOIN (SELECT t.row_index, t.state FROM states t JOIN prior_rows r ON t.row_index = r.row_index) p "
    "ON n.row_index = p.row_index"))
def q_append_conflicts(spark, d):
    """Conflicts when a full re-run appends onto the states of the earlier run."""
    from ..operators import states as S
    st = P.terminal_states(P.annotated(spark, d))
    existing = st.join(X.prior_run_rows(spark, d), "row_index", "left_semi")
    return S.append_conflicts(existing, st)


@query("state_conflicts", O.on_t(
    "SELECT row_index, count(DISTINCT state) AS states FROM (SELECT row_index, state FROM states "
    "UNION ALL SELECT t.row_index, 'miss' FROM states t JOIN prior_rows p ON t.row_index = p.row_index "
    "WHERE t.state = 'success') GROUP BY row_index HAVING count(DISTINCT state) > 1"))
def q_state_conflicts(spark, d):
    """Rows with more than one state in a log where the earlier run's hits were re-logged as
    misses."""
    from ..operators import states as S
    st = P.terminal_states(P.annotated(spark, d)).select("row_index", "state")
    relogged = (st.where(F.col("state") == C.SUCCESS)
                .join(X.prior_run_rows(spark, d), "row_index", "left_semi")
                .select("row_index", F.lit(C.MISS).alias("state")))
    return S.state_conflicts(st.unionByName(relogged))


@query("state_counts", O.on_t("SELECT * FROM counts"))
def q_state_counts(spark, d):
    """Four terminal counts."""
    return P.state_counts(P.terminal_states(P.annotated(spark, d)))


@query("resume_point", O.on_t(
    "SELECT coalesce(max(row_index) FILTER (WHERE state <> 'pending') + 1, 0) AS resume_point, "
    "coalesce(min(row_index) FILTER (WHERE state = 'pending'), count(*)) AS first_gap FROM annotated"))
def q_resume_point(spark, d):
    """High-water mark and first unhandled row."""
    from ..operators import states as S
    return S.resume_point(P.annotated(spark, d))


# ------------------------------------------------------------------ 2.6 aggregations

@query("taxonomy_long", O.on_t("SELECT * FROM tax_long"))
def q_taxonomy_long(spark, d):
    """one row per present node of every record."""
    return taxonomy.taxonomy_long(parse.success_nodes(P.annotated(spark, d)))


@query("taxonomy_nodes", O.on_t("SELECT * FROM tax_nodes"))
def q_taxonomy_nodes(spark, d):
    """display name and grouping key per node."""
    return taxonomy.taxonomy_nodes(taxonomy.taxonomy_long(parse.success_nodes(P.annotated(spark, d))))


@query("taxonomy_counts", O.on_t("SELECT * FROM tax_counts"))
def q_taxonomy_counts(spark, d):
    """labels per (layer, class) with first-seen name."""
    return P.class_counts(spark, d)


@query("layer_totals", O.on_t(
    "SELECT layer_no, layer, cast(sum(label_count) AS BIGINT) AS assigned_records, "
    "count(*) AS unique_class_count FROM tax_counts GROUP BY layer_no, layer"))
def q_layer_totals(spark, d):
    """assigned records and class count per non-empty layer."""
    return taxonomy.layer_totals(P.class_counts(spark, d))


@query("all_layers", O.on_t(
    "SELECT l.layer_no, l.layer, coalesce(t.a, 0) AS assigned_records, coalesce(t.u, 0) AS "
    "unique_class_count FROM layers l LEFT JOIN (SELECT layer_no, cast(sum(label_count) AS BIGINT) AS a, "
    "count(*) AS u FROM tax_counts GROUP BY layer_no) t ON l.layer_no = t.layer_no"))
def q_all_layers(spark, d):
    """all five layers, zeros for empty ones."""
    return taxonomy.all_layers(spark, P.class_counts(spark, d))


_METRICS_SQL = (
    "SELECT total_rows, success_rows, miss_rows, invalid_rows, failed_rows, "
    "success_rows + miss_rows + invalid_rows + failed_rows AS handled_rows, "
    "success_rows + miss_rows + failed_rows AS executed_rows, "
    "success_rows + miss_rows + invalid_rows AS completed_rows, "
    "greatest(total_rows - (success_rows + miss_rows + invalid_rows + failed_rows), 0) AS pending_rows "
    "FROM counts, totals")


def _metrics(spark, d):
    return report.progress_metrics(report.crawl_counts(P.annotated(spark, d)))


@query("progress_metrics", O.on_t(_METRICS_SQL))
def q_progress_metrics(spark, d):
    """handled, executed, completed and pending rows."""
    return _metrics(spark, d)


@query("progress_ratios", O.on_t(
    "SELECT CASE WHEN total_rows = 0 THEN 0.0 ELSE success_rows / total_rows END AS coverage, "
    "CASE WHEN executed_rows = 0 THEN 0.0 ELSE success_rows / executed_rows END AS request_success "
    f"FROM ({_METRICS_SQL})"))
def q_progress_ratios(spark, d):
    """coverage and request success ratios."""
    return report.progress_ratios(_metrics(spark, d))


@query("progress_summary", O.on_t(
    "SELECT c.total_rows, c.success_rows, c.miss_rows, c.invalid_rows, c.failed_rows, "
    "l.layer_no, l.layer, l.assigned_records, l.unique_class_count, r.rk AS class_no, r.name, "
    "r.chemont_id, r.label_count FROM (SELECT l.layer_no, l.layer, coalesce(t.a, 0) AS assigned_records, "
    "coalesce(t.u, 0) AS unique_class_count FROM layers l LEFT JOIN (SELECT layer_no, "
    "cast(sum(label_count) AS BIGINT) AS a, count(*) AS u FROM tax_counts GROUP BY layer_no) t "
    "ON l.layer_no = t.layer_no) l LEFT JOIN ranked r ON l.layer_no = r.layer_no, "
    "(SELECT * FROM counts, totals) c"))
def q_progress_summary(spark, d):
    """the summary document in long form (one row per layer and class)."""
    ann = P.land_annotation(spark, d, scratch_dir(spark, "annotation"))
    counts = report.crawl_counts(ann)
    ranked = taxonomy.taxonomy_ranked(taxonomy.taxonomy_counts(
        taxonomy.taxonomy_nodes(taxonomy.taxonomy_long(parse.success_nodes(ann)))))
    return report.summary_rows(spark, counts, ranked)


def _panel_sql(name: str, slices, center, note_sql: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {no} AS slice_no, '{label}: ' || format('{{:,}}', {col}) AS label, "
        f"cast({col} AS BIGINT) AS value FROM m" for no, (label, col) in enumerate(slices))
    num, den = center
    pct = (f"CASE WHEN {den} = 0 THEN 0 ELSE (cast({num} AS BIGINT) * 20000 + {den}) // "
           f"(cast({den} AS BIGINT) * 2) END")
    return O.on_t(
        f", m AS ({_METRICS_SQL}), p AS (SELECT {pct} AS h, {note_sql} AS note FROM m) "
        f"SELECT '{name}' AS panel, cast(h // 100 AS VARCHAR) || '.' || lpad(cast(h % 100 AS VARCHAR), 2, '0') "
        f"|| '%' AS center_value, note, s.* FROM p, ({rows}) s")


@query("coverage_panel", _panel_sql(
    "coverage", [("Collected", "success_rows"), ("Pending", "pending_rows"), ("Miss", "miss_rows"),
                 ("Failed", "failed_rows"), ("Invalid", "invalid_rows")],
    ("success_rows", "total_rows"), "cast(NULL AS VARCHAR)"))
def q_coverage_panel(spark, d):
    """coverage panel slices and centre value."""
    return report.coverage_panel(_metrics(spark, d))


@query("request_panel", _panel_sql(
    "requests", [("Success", "success_rows"), ("Miss", "miss_rows"), ("Failed", "failed_rows")],
    ("success_rows", "executed_rows"),
    "'Invalid rows skipped before request: ' || format('{:,}', invalid_rows)"))
def q_request_panel(spark, d):
    """request outcome panel slices, centre value and note."""
    return report.request_panel(_metrics(spark, d))


# ------------------------------------------------------------------ 2.7 ordering, top-k

@query("taxonomy_ranked", O.on_t("SELECT * FROM ranked"))
def q_ranked(spark, d):
    """G1: classes ranked per layer."""
    return P.ranked(spark, d)


@query("taxonomy_topk", O.on_t(
    "SELECT r.* FROM ranked r JOIN layers l ON r.layer_no = l.layer_no WHERE r.rk <= l.panel_limit"))
def q_topk(spark, d):
    """G2 (flagship): first 6 classes per layer, 5 for direct_parent."""
    return taxonomy.taxonomy_topk(spark, P.ranked(spark, d))


@query("taxonomy_tail", O.on_t(
    "SELECT r.layer_no, r.layer, CAST(count_if(r.rk > l.panel_limit) AS BIGINT) AS tail_classes, "
    "cast(sum(CASE WHEN r.rk > l.panel_limit THEN r.label_count ELSE 0 END) AS BIGINT) AS tail_labels, "
    "CAST(count_if(r.rk > l.panel_limit) AS BIGINT) > 0 AS has_tail "
    "FROM ranked r JOIN layers l ON r.layer_no = l.layer_no GROUP BY r.layer_no, r.layer"))
def q_tail(spark, d):
    """Hidden classes and labels per layer."""
    return taxonomy.taxonomy_tail(spark, P.ranked(spark, d))


@query("class_share", O.on_t(
    "SELECT layer_no, class_key, label_count, label_count / sum(label_count) OVER (PARTITION BY layer_no) "
    "AS share FROM ranked"))
def q_share(spark, d):
    """Share of each class in its layer."""
    return taxonomy.class_share(P.ranked(spark, d)).select(
        "layer_no", "class_key", "label_count", "share")


@query("cumulative_share", O.on_t(
    "SELECT layer_no, class_key, rk, (run - label_count) / total AS start_share, run / total AS end_share "
    "FROM (SELECT *, sum(label_count) OVER (PARTITION BY layer_no ORDER BY rk ROWS BETWEEN UNBOUNDED "
    "PRECEDING AND CURRENT ROW) AS run, sum(label_count) OVER (PARTITION BY layer_no) AS total FROM ranked)"))
def q_cumulative(spark, d):
    """Running share per class in rank order."""
    return taxonomy.cumulative_share(P.ranked(spark, d)).select(
        "layer_no", "class_key", "rk", "start_share", "end_share")


# ------------------------------------------------------------------ 2.10 report projection

def _pct_sql(num: str, den: str) -> str:
    h = (f"(CASE WHEN {den} = 0 THEN 0 ELSE (cast({num} AS BIGINT) * 20000 + {den}) // "
         f"(cast({den} AS BIGINT) * 2) END)")
    return f"cast({h} // 100 AS VARCHAR) || '.' || lpad(cast({h} % 100 AS VARCHAR), 2, '0') || '%'"


@query("taxonomy_report", O.on_t(
    ", tot AS (SELECT layer_no, cast(sum(label_count) AS BIGINT) AS assigned FROM ranked GROUP BY layer_no), "
    "tl AS (SELECT r.layer_no, r.layer, CAST(count_if(r.rk > l.panel_limit) AS BIGINT) AS tc, "
    "cast(sum(CASE WHEN r.rk > l.panel_limit THEN r.label_count ELSE 0 END) AS BIGINT) AS tlab "
    "FROM ranked r JOIN layers l ON r.layer_no = l.layer_no GROUP BY r.layer_no, r.layer) "
    f"SELECT r.layer_no, r.layer, cast(r.rk AS INTEGER) AS line_no, r.name AS label, "
    f"{_pct_sql('r.label_count', 't.assigned')} AS percent, format('{{:,}}', r.label_count) AS count "
    "FROM ranked r JOIN layers l ON r.layer_no = l.layer_no JOIN tot t ON r.layer_no = t.layer_no "
    "WHERE r.rk <= l.panel_limit UNION ALL "
    f"SELECT tl.layer_no, tl.layer, cast(NULL AS INTEGER), 'Tail: ' || format('{{:,}}', tl.tc) || ' classes', "
    f"{_pct_sql('tl.tlab', 't.assigned')}, format('{{:,}}', tl.tlab) "
    "FROM tl JOIN tot t ON tl.layer_no = t.layer_no WHERE tl.tlab > 0"))
def q_report(spark, d):
    """Printed report rows (top classes, then tail)."""
    return report.taxonomy_report(spark, P.ranked(spark, d))


# ------------------------------------------------------------------ attempt log (fixture A)

from ..operators import timeline  # noqa: E402

SESSION_START = "2024-01-15 00:00:00"
_DONE = "state IN ('success', 'miss', 'invalid')"


def _line_sql(bucket: bool) -> str:
    msg = O.compact_error("message") if bucket else "coalesce(message, '')"
    key = "cast(row_key AS VARCHAR)"
    return (f"CASE WHEN kind = 'error' THEN 'error ' || {key} || ': ' || {msg} "
            f"WHEN state = 'success' THEN 'hit ' || {key} WHEN state = 'miss' THEN 'miss ' || {key} "
            f"ELSE 'error ' || {key} || ': ' || {msg} END")


@query("session_delta", O.on_a(
    f"SELECT CAST(count_if({_DONE} AND ts < TIMESTAMP '{SESSION_START}') AS BIGINT) AS completed_at_start, "
    f"CAST(count_if({_DONE}) AS BIGINT) AS completed_now, greatest(CAST(count_if({_DONE}) AS BIGINT) - "
    f"CAST(count_if({_DONE} AND ts < TIMESTAMP '{SESSION_START}') AS BIGINT), 0) AS session_completed FROM attempts"))
def q_session_delta(spark, d):
    """F8: rows completed since a session started mid-log."""
    return timeline.session_delta(X.attempts(spark, d), SESSION_START)


@query("recent_events", O.on_a(
    f"SELECT kind, attempt_id, ts, row_key, state, {_line_sql(False)} AS line, "
    f"least(count(*) OVER (PARTITION BY kind), 8) - rn + 1 AS pos FROM (SELECT *, row_number() "
    f"OVER (PARTITION BY kind ORDER BY ts DESC, attempt_id DESC) AS rn FROM attempts) WHERE rn <= 8"))
def q_recent_events(spark, d):
    """Newest 8 event lines and newest 8 error lines."""
    return timeline.recent_events(X.attempts(spark, d))


@query("last_result", O.on_a(
    f"SELECT attempt_id, ts, row_key, state, {_line_sql(True)} AS result FROM attempts "
    f"ORDER BY ts DESC, attempt_id DESC LIMIT 1"))
def q_last_result(spark, d):
    """Latest outcome line."""
    return timeline.last_result(X.attempts(spark, d))


@query("daily_status", O.on_a(
    "SELECT day_end, state, rows, cast(sum(rows) OVER (PARTITION BY state ORDER BY day_end ROWS "
    "BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_rows FROM (SELECT "
    "time_bucket(INTERVAL 1 DAY, ts, INTERVAL 18 HOUR) + INTERVAL 1 DAY AS day_end, state, "
    "count(*) AS rows FROM attempts GROUP BY 1, 2)"))
def q_daily_status(spark, d):
    """Counts per state per day ending 18:00 UTC, with running totals."""
    return timeline.daily_status(X.attempts(spark, d))


@query("release_cadence", O.on_a(
    "SELECT release_no, count(*) AS success_rows, cast(sum(count(*)) OVER (ORDER BY release_no ROWS "
    "BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_success FROM (SELECT "
    "(epoch_us(a.ts) - s.start_us) // 604800000000 AS release_no FROM attempts a, "
    "(SELECT min(epoch_us(ts)) AS start_us FROM attempts) s WHERE a.state = 'success') GROUP BY release_no"))
def q_release_cadence(spark, d):
    """Success rows per 7-day release period and so far."""
    return timeline.release_cadence(X.attempts(spark, d))


_THROUGHPUT_SQL = (
    f"SELECT CAST(count_if({_DONE}) AS BIGINT) AS completed_rows, (max(epoch_us(ts)) - min(epoch_us(ts))) / 1000000 "
    f"AS elapsed_seconds, CAST(count_if({_DONE}) AS BIGINT) * 60 / greatest((max(epoch_us(ts)) - min(epoch_us(ts))) "
    f"/ 1000000, 1.0) AS per_minute FROM attempts")


@query("throughput", O.on_a(_THROUGHPUT_SQL))
def q_throughput(spark, d):
    """Completed rows per minute over the log."""
    return timeline.throughput(X.attempts(spark, d))


@query("backoff_spans", O.on_a(
    f"SELECT min(ts) AS span_start, max(ts) + INTERVAL 300 SECOND AS span_end, count(*) AS hits FROM ("
    f"SELECT ts, sum(nw) OVER (ORDER BY ts, attempt_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
    f"AS span FROM (SELECT ts, attempt_id, CASE WHEN lag(ts) OVER (ORDER BY ts, attempt_id) IS NULL OR "
    f"epoch_us(ts) > epoch_us(lag(ts) OVER (ORDER BY ts, attempt_id)) + 300000000 THEN 1 ELSE 0 END AS nw "
    f"FROM attempts WHERE state = 'failed' AND {O.backoff_reason('message')} IS NOT NULL)) GROUP BY span"))
def q_backoff_spans(spark, d):
    """Merged 300 s gate-closed spans after throttle/HTML failures."""
    return timeline.backoff_spans(X.attempts(spark, d))


@query("throughput_windows", O.on_a(
    f"SELECT date_trunc('minute', ts) AS minute, CAST(count_if({_DONE}) AS BIGINT) AS completed_rows, count(*) AS attempts "
    "FROM attempts GROUP BY 1"))
def q_throughput_windows(spark, d):
    """Completed rows of each minute of the log."""
    return timeline.throughput_windows(X.attempts(spark, d))


@query("eta", O.on_t(
    f", {X.A_CTE.strip()}, m AS ({_METRICS_SQL}), r AS ({_THROUGHPUT_SQL}), e AS (SELECT max(epoch_us(ts)) AS last_us FROM attempts) "
    "SELECT m.pending_rows, r.per_minute, CASE WHEN r.per_minute > 0 THEN m.pending_rows / r.per_minute "
    "END AS minutes_left, CASE WHEN r.per_minute > 0 THEN m.pending_rows / r.per_minute END / 1440.0 "
    "AS days_left, CASE WHEN r.per_minute > 0 THEN make_timestamp((e.last_us // 86400000000 + "
    "cast(ceil((e.last_us % 86400000000) / 86400000000.0 + m.pending_rows / r.per_minute / 1440.0) AS BIGINT) - 1) * 86400000000)::DATE::VARCHAR END AS finish_date FROM m, r, e"))
def q_eta(spark, d):
    """Time left for the pending rows at the log's completion rate, and the day they are done."""
    att = X.attempts(spark, d)
    return timeline.eta(_metrics(spark, d), timeline.throughput(att), att)


# ------------------------------------------------------------------ bitmaps, files, release

from ..operators import bitmaps as B  # noqa: E402
from ..operators import release as R  # noqa: E402
from ..operators import snapshots as SN  # noqa: E402
from ..operators import states as S  # noqa: E402
from ..sources import lines as L  # noqa: E402
from ..sources.zstd import write_zstd_shards  # noqa: E402

# Shard limits for the fixture: small enough that sf0.01 spreads over several shards.
FIXTURE_SHARD_RECORDS = 1000
FIXTURE_SHARD_BYTES = 100_000


def _states(spark, d):
    return P.terminal_states(P.annotated(spark, d)).select("row_index", "state")


def _relogged_log(spark, d):
    st = _states(spark, d)
    relogged = (st.where(F.col("state") == C.SUCCESS)
                .join(X.prior_run_rows(spark, d), "row_index", "left_semi")
                .select("row_index", F.lit(C.MISS).alias("state")))
    return st.unionByName(relogged)


@query("bitmap_encode", O.on_t(
    "SELECT state, row_index // 32768 AS bucket_no, count(*) AS set_bits, 4096 AS bytes FROM states "
    "GROUP BY 1, 2"))
def q_bitmap_encode(spark, d):
    """State row sets compacted to 4 KiB bitmap buckets."""
    bm = B.bitmap_encode(_states(spark, d))
    return bm.select("state", "bucket_no", F.bitmap_count("bitmap").alias("set_bits"),
                     F.octet_length("bitmap").alias("bytes"))


@query("bitmap_popcount", O.on_t(
    "SELECT s.state, coalesce(c.n, 0) AS set_bits FROM (VALUES ('success'), ('miss'), ('invalid'), "
    "('failed')) s(state) LEFT JOIN (SELECT state, count(*) AS n FROM states GROUP BY state) c "
    "ON s.state = c.state"))
def q_bitmap_popcount(spark, d):
    """E5: set bits per state from the bitmaps."""
    return B.bitmap_popcount(spark, B.bitmap_encode(_states(spark, d)))


@query("bitmap_membership", O.on_t("SELECT row_index, state FROM states"))
def q_bitmap_membership(spark, d):
    """State of every input row looked up in the bitmaps."""
    return B.bitmap_membership(X.submissions(spark, d).select("row_index"),
                               B.bitmap_encode(_states(spark, d)))


@query("bitmap_merge", O.on_t(
    ", lg AS (SELECT row_index, state FROM states UNION ALL SELECT t.row_index, 'miss' FROM states t "
    "JOIN prior_rows p ON t.row_index = p.row_index WHERE t.state = 'success') "
    "SELECT row_index // 32768 AS bucket_no, count(DISTINCT row_index) AS handled_bits, "
    "count(*) - count(DISTINCT row_index) AS overlap_bits FROM lg GROUP BY 1"))
def q_bitmap_merge(spark, d):
    """Handled rows (union) and overlaps per bucket of a log with re-logged rows."""
    return B.bitmap_merge(B.bitmap_encode(_relogged_log(spark, d)))


@query("scan_state_bitmaps", O.on_t("SELECT row_index, state FROM states"))
def q_scan_bitmaps(spark, d):
    """Bitmaps stored as Parquet, read back and exploded into row states."""
    out = scratch_dir(spark, "bitmaps")
    B.bitmap_encode(_states(spark, d)).write.mode("overwrite").parquet(out)
    return B.bitmap_rows(spark.read.parquet(out))


def _write_submission_text(spark, d) -> str:
    """Submissions as text files in row order (file names sort in row order)."""
    out = scratch_dir(spark, "submissions-text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (X.submissions(spark, d).repartitionByRange(n, "row_index").sortWithinPartitions("row_index")
     .select("line").write.option("lineSep", "\n").text(out))
    return out


@query("scan_lines", O.on_t("SELECT line FROM submissions"))
def q_scan_lines(spark, d):
    """A1: submissions written as text and read back line by line."""
    return L.scan_lines(spark, _write_submission_text(spark, d)).select("line")


@query("number_rows", O.on_t("SELECT row_index, line FROM submissions"))
def q_number_rows(spark, d):
    """A2: zero-based line numbers recovered from the text files."""
    return L.number_lines(spark, _write_submission_text(spark, d))


@query("number_zstd_rows", O.on_t("SELECT row_index, line FROM submissions"))
def q_number_zstd_rows(spark, d):
    """A1: submissions as zstd files of many frames, read in ranges smaller than a file and numbered."""
    out = scratch_dir(spark, "submissions-zstd")
    lines = X.submissions(spark, d).select("row_index", F.col("line").alias("value"))
    write_zstd_shards(lines.repartitionByRange("row_index").sortWithinPartitions("row_index"), out, 1 << 22, 1 << 20, frame=1 << 14)
    return L.number_lines(spark, out, width=1 << 17)


@query("count_input_rows", O.on_t("SELECT count(*) AS input_rows FROM submissions"))
def q_count_input_rows(spark, d):
    """A3: line count of the submission text."""
    return L.count_lines(spark, _write_submission_text(spark, d))


@query("input_fingerprint", "SELECT * FROM (VALUES (1, NULL), (2, 'input size'), (3, 'input mtime'), "
       "(4, 'input path'), (5, 'input path')) AS v(run_id, mismatch)")
def q_input_fingerprint(spark, d):
    """A5: five stored runs against the current text files: unchanged, one file of another size, one of
    another mtime, one file gone, one file added since."""
    cur = L.file_metadata(spark, _write_submission_text(spark, d) + "/part-*")
    one = cur.agg(F.min("input_path")).first()[0]  # the file that each run differs in
    hit = F.col("input_path") == one
    stored = L.run_fingerprint(cur, 1)
    for run_id, change in ((2, stored.withColumn("input_size_bytes", F.col("input_size_bytes") + hit.cast("long"))),
                           (3, stored.withColumn("input_mtime_epoch", F.col("input_mtime_epoch") + hit.cast("long"))),
                           (4, stored.withColumn("input_path", F.when(hit, F.concat("input_path", F.lit(".moved"))).otherwise(F.col("input_path")))),
                           (5, stored.where(~hit))):
        stored = stored.unionByName(change.where("run_id = 1").withColumn("run_id", F.lit(run_id)))
    return L.input_fingerprint(cur, stored)


def _write_shards(spark, d, fmt="jsonl") -> str:
    out = scratch_dir(spark, "success-shards")
    R.write_success_shards(P.land_records(spark, d, scratch_dir(spark, "records")), out,
                           max_records=FIXTURE_SHARD_RECORDS, max_bytes=FIXTURE_SHARD_BYTES, fmt=fmt)
    return out


def _shards_and_states(spark, d) -> tuple[str, DataFrame]:
    """Shards of the records and the states of all rows, from one annotation."""
    out, ann = scratch_dir(spark, "success-shards"), P.land_outcomes(spark, d, scratch_dir(spark, "outcomes"))
    R.write_success_shards(P.records(ann), out, max_records=FIXTURE_SHARD_RECORDS, max_bytes=FIXTURE_SHARD_BYTES, fmt="jsonl")
    return out, P.terminal_states(ann)


@query("scan_success_records", O.on_t(
    f"SELECT row_index, cid, inchi, inchikey, fetched_at, {C.ANSWER_FIELD} FROM records"))
def q_scan_success_records(spark, d):
    """A4: records written as JSONL shards and read back (body kept as raw JSON)."""
    return R.read_success_records(spark, _write_shards(spark, d))


_SHARD_SQL = (
    "SELECT row_index, pos, size, shard_no FROM (WITH RECURSIVE sized AS (SELECT row_index, row_number() OVER (ORDER BY row_index) - 1 AS pos, "
    f"strlen({C.ANSWER_FIELD}) AS size, cast(coalesce(sum(strlen({C.ANSWER_FIELD})) OVER (ORDER BY row_index ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING), 0) AS BIGINT) AS before FROM records), "
    f"follow AS (SELECT pos, least(pos + {FIXTURE_SHARD_RECORDS}, coalesce(min(pos) OVER (ORDER BY before RANGE BETWEEN "
    f"{FIXTURE_SHARD_BYTES} FOLLOWING AND UNBOUNDED FOLLOWING), pos + {FIXTURE_SHARD_RECORDS})) AS then FROM sized), "
    "cut AS (SELECT cast(0 AS BIGINT) AS pos, cast(1 AS BIGINT) AS shard_no UNION ALL "
    "SELECT follow.then, cut.shard_no + 1 FROM cut JOIN follow USING (pos) WHERE follow.then <= (SELECT max(pos) FROM sized)) "
    "SELECT s.row_index, s.pos, s.size, cast(count(c.pos) OVER (ORDER BY s.pos) AS BIGINT) AS shard_no "
    "FROM sized s LEFT JOIN cut c ON s.pos = c.pos)")


@query("shard_assignment", O.on_t(_SHARD_SQL))
def q_shard_assignment(spark, d):
    """H1: shards cut by their own records and bytes, counted anew from each begin."""
    sh = R.shard_assignment(P.land_records(spark, d, scratch_dir(spark, "records")), FIXTURE_SHARD_RECORDS,
                            FIXTURE_SHARD_BYTES)
    return sh.select("row_index", "pos", "size", "shard_no")


@query("write_success_shards", O.on_t(
    f"SELECT row_index, 'success-' || lpad(cast(shard_no AS VARCHAR), 6, '0') AS shard "
    f"FROM ({_SHARD_SQL})"))
def q_write_shards(spark, d):
    """H2: every record lands in the shard directory of its number."""
    out = _write_shards(spark, d)
    return spark.read.text(out).select(
        F.get_json_object("value", "$.row_index").cast("long").alias("row_index"), "shard")


@query("write_zstd_shards", O.on_t(
    f"SELECT row_index, cid, inchi, inchikey, fetched_at, {C.ANSWER_FIELD} FROM records"))
def q_write_zstd_shards(spark, d):
    """H2: zstd JSONL shards under a limit on compressed bytes, read back."""
    return R.read_success_records(spark, _write_shards(spark, d, "jsonl.zst"), "jsonl.zst")


@query("merge_release", O.on_t(
    f"SELECT row_index, cid, inchi, inchikey, fetched_at, {C.ANSWER_FIELD} FROM records"))
def q_merge_release(spark, d):
    """H3: all shards merged into one ordered release dataset."""
    return R.merge_release(spark, _write_shards(spark, d))


def _overlapping_shards(spark, d) -> str:
    """zstd shards of two writes: all records, then those of the earlier run once more."""
    out = scratch_dir(spark, "zstd-shards")
    recs = P.land_records(spark, d, scratch_dir(spark, "records"))
    again = recs.join(X.prior_run_rows(spark, d), "row_index", "left_semi").where("row_index % 2 = 0")
    for part in (recs, again):
        R.write_success_shards(part, out, max_records=FIXTURE_SHARD_RECORDS, max_bytes=FIXTURE_SHARD_BYTES, fmt="jsonl.zst")
    return out


@query("merge_units", O.on_t(
    f"SELECT row_index, cid, inchi, inchikey, fetched_at, {C.ANSWER_FIELD} FROM records"))
def q_merge_units(spark, d):
    """H3: shards that overlap merged to one record per row, the others as they stand."""
    return SN.merge_units(spark, _overlapping_shards(spark, d))


@query("release_counts", ORACLE["taxonomy_counts"])
def q_release_counts(spark, d):
    """class counts of a release from stored counts of the shards before, and of the new shards alone."""
    out, store = scratch_dir(spark, "zstd-shards"), scratch_dir(spark, "release-counts")
    recs = P.land_records(spark, d, scratch_dir(spark, "records"))
    first = recs.join(X.prior_run_rows(spark, d), "row_index", "left_semi")
    for part in (first, recs.join(first.select("row_index"), "row_index", "left_anti")):
        R.write_success_shards(part, out, max_records=FIXTURE_SHARD_RECORDS, max_bytes=FIXTURE_SHARD_BYTES, fmt="jsonl.zst")
        SN.counted_units(spark, out, store)
    return SN.release_counts(spark, out, store)


@query("release_manifest", O.on_t(
    f"SELECT 'jsonl' AS format, success_rows, miss_rows, invalid_rows, failed_rows, "
    f"(SELECT count(DISTINCT shard_no) FROM ({_SHARD_SQL})) AS shard_dirs FROM counts"))
def q_release_manifest(spark, d):
    """H4: manifest counts and the number of shard directories listed."""
    out, states = _shards_and_states(spark, d)
    m = R.release_manifest(P.state_counts(states), R.shard_files(spark, out))
    dirs = F.size(F.array_distinct(F.transform(
        "shards", lambda s: F.regexp_extract(s["filename"], r"^(shard=[^/]+)/", 1))))
    return m.select("format", *[f"{s}_rows" for s in C.STATES], dirs.cast("long").alias("shard_dirs"))


@query("release_gate", O.on_t(
    f"SELECT row_index, cid, inchi, inchikey, fetched_at, {C.ANSWER_FIELD} FROM records "
    "WHERE (SELECT success_rows FROM counts) > 0"))
def q_release_gate(spark, d):
    """H5: the release exists only with successful rows and a non-empty shard."""
    out, states = _shards_and_states(spark, d)
    counts = P.state_counts(states)
    if not R.release_gate(counts, R.shard_files(spark, out)):
        return spark.createDataFrame([], R.RECORD_SCHEMA)
    return R.merge_release(spark, out)


def _summary_doc(spark, d, generated_at=None):
    ann = P.land_annotation(spark, d, scratch_dir(spark, "annotation"))
    ranked = taxonomy.taxonomy_ranked(taxonomy.taxonomy_counts(
        taxonomy.taxonomy_nodes(taxonomy.taxonomy_long(parse.success_nodes(ann)))))
    return report.summary_document(spark, report.crawl_counts(ann), ranked, generated_at)


_SUMMARY_SQL = ORACLE["progress_summary"]


SUMMARY_TIME = "2024-01-31T18:00:00.000000Z"


@query("write_summary", f"SELECT '{SUMMARY_TIME}' AS generated_at, s.* FROM ({_SUMMARY_SQL}) s")
def q_write_summary(spark, d):
    """H6: the summary document written as one JSON file with a given time, read back field by field."""
    out = scratch_dir(spark, "summary")
    R.write_json_document(_summary_doc(spark, d, SUMMARY_TIME), out)
    doc = R.read_summary(spark, out)
    return report.attach_one_row(R.flatten_summary(doc), doc.agg(F.max("generated_at").alias("generated_at")))


@query("read_summary", _SUMMARY_SQL)
def q_read_summary(spark, d):
    """The stored summary read back and flattened."""
    out = scratch_dir(spark, "summary")
    R.write_json_document(_summary_doc(spark, d), out)
    return R.flatten_summary(R.read_summary(spark, out))


@query("read_manifest_counts", O.on_t(
    "SELECT success_rows, miss_rows, invalid_rows, failed_rows FROM counts"))
def q_read_manifest_counts(spark, d):
    """Four counts from a written release manifest."""
    out = scratch_dir(spark, "manifest")
    shards, states = _shards_and_states(spark, d)
    m = R.release_manifest(P.state_counts(states), R.shard_files(spark, shards))
    R.write_json_document(m, out)
    return R.read_manifest_counts(spark, out)


@query("summary_or_recompute", _SUMMARY_SQL)
def q_summary_or_recompute(spark, d):
    """A release without stored summary: recomputed from dataset, manifest counts, total."""
    rel = scratch_dir(spark, "release")
    shards, states = _shards_and_states(spark, d)
    m = R.release_manifest(P.state_counts(states), R.shard_files(spark, shards))
    R.write_json_document(m, rel + "/manifest")
    dataset = R.merge_release(spark, shards)
    total = X.submissions(spark, d).count()
    doc = R.summary_or_recompute(spark, rel, dataset, R.read_manifest_counts(spark, rel + "/manifest"),
                                 total)
    return R.flatten_summary(doc)


# ------------------------------------------------------------------ 2.9 streams

from ..streaming import annotate as SA  # noqa: E402
from ..streaming import status as SS  # noqa: E402


def _land_files(df: DataFrame, order_col: str, name: str, spark, files: int = 8) -> str:
    """Write a frame as several Parquet files in ``order_col`` order (arrivals for a stream).

    The files of one write get arbitrary modification times, while a file stream takes files
    oldest first; the times are stamped in name order so the files arrive in time order.
    """
    out = scratch_dir(spark, name)
    df.repartitionByRange(files, order_col).sortWithinPartitions(order_col).write.parquet(out)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(out)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((st.getPath().toString() for st in fs.listStatus(root)
                    if st.getPath().getName().startswith("part-")))
    base = 1_700_000_000_000
    for i, p in enumerate(parts):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(p), base + i * 1000, -1)
    return out


@query("stream_annotate", O.on_t("SELECT row_index, state FROM states"))
def q_stream_annotate(spark, d):
    """Submissions arriving as files, annotated by a resumable stream; rows with a state."""
    src = _land_files(X.submissions(spark, d), "row_index", "arrivals", spark)
    answers = SA.land_answers(X.responses(spark, d), scratch_dir(spark, "answers"), letters=1)
    out, ckpt = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-ckpt")
    q = SA.start_annotation_stream(spark, src, answers, out, ckpt, files_per_trigger=2, letters=1)
    q.awaitTermination()
    return SA.read_states(spark, out).select("row_index", "state")


@query("stream_back_fill", O.on_t("SELECT row_index, state FROM states"))
def q_stream_back_fill(spark, d):
    """The stream runs while answers of half the keys are there; a back-fill brings the others."""
    src = _land_files(X.submissions(spark, d), "row_index", "arrivals", spark, files=4)
    responses = X.responses(spark, d)
    early = F.crc32(F.coalesce(F.col("inchikey"), F.lit(""))) % 2 == 0
    answers = SA.land_answers(responses.where(early), scratch_dir(spark, "answers"), letters=1)
    out, ckpt = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-ckpt")
    SA.start_annotation_stream(spark, src, answers, out, ckpt, files_per_trigger=2, letters=1).awaitTermination()
    SA.back_fill(spark, responses.where(~early), answers, out, run=1, letters=1)
    return SA.read_states(spark, out).select("row_index", "state")


def _attempt_source(spark, d) -> tuple[str, object]:
    att = X.attempts(spark, d)
    return _land_files(att, "ts", "attempt-arrivals", spark), att.schema


@query("stream_state_counts", O.on_a("SELECT state, count(*) AS rows FROM attempts GROUP BY state"))
def q_stream_state_counts(spark, d):
    """Running counts per state over an attempt stream (complete mode)."""
    src, schema = _attempt_source(spark, d)
    out, ckpt = scratch_dir(spark, "counts-out"), scratch_dir(spark, "counts-ckpt")
    SS.start_state_counts(SS.attempt_stream(spark, src, schema, 2), out, ckpt).awaitTermination()
    return SS.read_state_counts(spark, out)


@query("stream_daily_status", ORACLE["daily_status"])
def q_stream_daily_status(spark, d):
    """I4: daily status per state from a watermarked stream, running totals on read."""
    src, schema = _attempt_source(spark, d)
    out, ckpt = scratch_dir(spark, "daily-out"), scratch_dir(spark, "daily-ckpt")
    SS.start_daily_status(SS.attempt_stream(spark, src, schema, 2), out, ckpt).awaitTermination()
    return SS.read_daily_status(spark, out)


@query("stream_backoff_spans", ORACLE["backoff_spans"])
def q_stream_backoff_spans(spark, d):
    """Backoff spans from session windows over an attempt stream; a last attempt two days on closes all."""
    att = X.attempts(spark, d)
    beat = att.agg(*[(F.max("ts") + F.expr("INTERVAL 2 DAYS") if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in att.schema])
    src = _land_files(att.unionByName(beat), "ts", "attempt-arrivals", spark)
    out, ckpt = scratch_dir(spark, "spans-out"), scratch_dir(spark, "spans-ckpt")
    SS.start_backoff_spans(SS.attempt_stream(spark, src, att.schema, 2), out, ckpt).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


@query("stream_dedupe", O.on_a("SELECT DISTINCT row_key FROM attempts"))
def q_stream_dedupe(spark, d):
    """I8: each row key emitted once although it arrives many times."""
    src, schema = _attempt_source(spark, d)
    out, ckpt = scratch_dir(spark, "dedupe-out"), scratch_dir(spark, "dedupe-ckpt")
    SS.start_dedupe(SS.attempt_stream(spark, src, schema, 2), "row_key", out, ckpt, bitmap=True).awaitTermination()
    return spark.read.parquet(out).select("row_key")
