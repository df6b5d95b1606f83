"""Answer classification (C1-C9): one CASE cascade over stored answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import (backoff_reason, compact_error, has_classification, held, html_summary,
                         json_object_body, looks_html, looks_not_found, read_answers, trim_ws,
                         with_taxonomy)

_HELPERS = ("_st", "_html", "_nf", "_blank", "_entries")


def with_helpers(answers: DataFrame) -> DataFrame:
    """Per-answer checks, computed once per row (state, reason and nodes all read them).

    A body is parsed only where no earlier rule decides."""
    st, ct, b = F.col("status"), F.col("content_type"), F.col("body")
    checked = answers.withColumns({"_st": st, "_html": looks_html(ct, b), "_nf": (st == 404) | looks_not_found(b),
                                   "_blank": trim_ws(b) == ""})
    early = F.col("_html") | F.col("_nf") | (F.col("_st") >= 400) | F.col("_blank")
    return read_answers(checked, ~F.coalesce(early, F.lit(False)))


def answer_state(body="body") -> tuple[Column, Column]:
    """(state, reason) of one answer over the helper columns; first matching rule wins.

    429 -> failed (throttled); HTML -> failed; 404 or not-found page -> miss; >= 400 -> failed;
    blank -> miss; not one JSON object -> failed; classified -> success; else miss.
    """
    st, html, nf, blank, entries = (F.col(c) for c in _HELPERS)
    b = F.col(body)
    good_json = json_object_body(entries)
    state = (
        F.when(st == 429, F.lit(C.FAILED))
        .when(html, F.lit(C.FAILED))
        .when(nf, F.lit(C.MISS))
        .when(st >= 400, F.lit(C.FAILED))
        .when(blank, F.lit(C.MISS))
        .when(~good_json, F.lit(C.FAILED))
        .when(has_classification(entries), F.lit(C.SUCCESS))
        .otherwise(F.lit(C.MISS))
    )
    reason = (
        F.when(st == 429, F.lit(C.MSG_THROTTLED))
        .when(html, F.concat(F.lit(C.MSG_HTML_PREFIX + " ("), html_summary(b), F.lit(")")))
        .when(nf, F.lit(None).cast("string"))
        .when(st >= 400, F.concat(F.lit(C.MSG_STATUS_PREFIX), st.cast("string")))
        .when(blank, F.lit(None).cast("string"))
        .when(~good_json, F.lit(C.MSG_BAD_JSON))
    )
    return state, reason


def with_answer_state(answers: DataFrame) -> DataFrame:
    """Add ``state``, ``reason`` and ``nodes`` (the five taxonomy nodes) to a frame of answers."""
    state, reason = answer_state()
    return with_taxonomy(with_helpers(answers)).withColumns({"state": state, "reason": reason}).drop(*_HELPERS)


def classify_answers(answers: DataFrame) -> DataFrame:
    """Add ``state`` and ``reason`` to a frame of answers; a filter on them parses no body again."""
    return held(with_answer_state(answers).drop("nodes"), "state", "reason")


def with_error_bucket(df: DataFrame, message_col: str = "reason") -> DataFrame:
    return df.withColumn("bucket", compact_error(F.col(message_col)))


def error_buckets(messages: DataFrame, message_col: str = "reason") -> DataFrame:
    """Count of messages per bucket (partial aggregation absorbs the few hot buckets)."""
    return (messages.where(F.col(message_col).isNotNull())
            .groupBy(compact_error(F.col(message_col)).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("messages")))


def backoff_rows(failed: DataFrame, message_col: str = "reason") -> DataFrame:
    """Failures that close the request gate, with their reason (throttle wins over html)."""
    return (failed.withColumn("backoff_reason", backoff_reason(F.col(message_col)))
            .where(F.col("backoff_reason").isNotNull()))
