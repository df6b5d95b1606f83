"""String column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (ERROR_BUCKET_DEFAULT, ERROR_BUCKETS, HTML_MARKERS, HTML_PREFIX_CHARS,
                      HTML_SNIPPET_CHARS, NOT_FOUND_TEXT, UNNAMED_CLASS, WHITESPACE_CHARS,
                      WHITESPACE_CLASS)

_WS = WHITESPACE_CLASS


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Strip Unicode White_Space at both ends (plain ``trim`` strips ASCII spaces only).

    ``trim`` with an explicit character set touches only the two ends of the string."""
    return F.trim(as_col(c), F.lit(WHITESPACE_CHARS))


def strip_line_end(c) -> Column:
    """Drop trailing ``\\r``/``\\n`` characters of a line."""
    return F.regexp_replace(as_col(c), r"[\r\n]+$", "")


def collapse_ws(c) -> Column:
    """Split on Unicode whitespace and join with single spaces (trimmed)."""
    return F.regexp_replace(trim_ws(c), f"{_WS}+", " ")


def collapsed_head(c, n: int) -> Column:
    """First ``n`` characters of ``collapse_ws(c)``, exactly.

    Every word is at least one character, so the first ``n`` words joined by single spaces
    already hold the first ``n`` collapsed characters. The regex takes the shortest leading
    stretch holding ``n`` words (possessive, no backtracking) and only that stretch is
    collapsed, instead of rewriting every whitespace run of a long text.
    """
    word = f"[^{_WS[1:-1]}]"
    head = F.regexp_extract(as_col(c), f"^(?:{_WS}*+{word}++){{0,{n}}}", 0)
    return F.substring(collapse_ws(head), 1, n)


def ascii_lower(c) -> Column:
    """Lower-case A-Z only, like an ASCII case fold; ``lower`` does just that where every character is one byte
    (and costs a pass over the bytes, ``translate`` a map lookup per character)."""
    c = as_col(c)
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def looks_html(content_type, body) -> Column:
    """Content type says text/html, or the first 256 characters carry an HTML marker."""
    ct = ascii_lower(F.coalesce(as_col(content_type), F.lit("")))
    head = ascii_lower(F.substring(as_col(body), 1, HTML_PREFIX_CHARS))
    by_marker = F.lit(False)
    for marker in HTML_MARKERS:
        by_marker = by_marker | F.contains(head, F.lit(marker))
    return F.contains(ct, F.lit("text/html")) | by_marker


def html_title(body) -> Column:
    """Trimmed text between the first ``<title>`` and the next ``</title>`` (case-insensitive)."""
    raw = F.regexp_extract(as_col(body), r"(?is)<title>(.*?)</title>", 1)
    return trim_ws(raw)


def html_summary(body) -> Column:
    """``title: ...`` if a non-empty title exists, else ``snippet: <80 chars>``, else empty."""
    title = html_title(body)
    snippet = collapsed_head(body, HTML_SNIPPET_CHARS)
    return (F.when(title != "", F.concat(F.lit("title: "), title))
            .when(snippet != "", F.concat(F.lit("snippet: "), snippet))
            .otherwise(F.lit("empty HTML body")))


def looks_not_found(body) -> Column:
    return F.contains(ascii_lower(as_col(body)), F.lit(NOT_FOUND_TEXT))


def compact_error(message) -> Column:
    """Bucket of an error message; first matching substring wins."""
    low = ascii_lower(as_col(message))
    out = None
    for needle, bucket in ERROR_BUCKETS:
        cond = F.contains(low, F.lit(needle))
        out = F.when(cond, F.lit(bucket)) if out is None else out.when(cond, F.lit(bucket))
    return out.otherwise(F.lit(ERROR_BUCKET_DEFAULT))


def backoff_reason(message) -> Column:
    """``throttle``/``html`` for messages that close the request gate, else NULL."""
    low = ascii_lower(as_col(message))
    return (F.when(F.contains(low, F.lit("throttled")), F.lit("throttle"))
            .when(F.contains(low, F.lit("returned html")), F.lit("html")))


def display_class_name(name) -> Column:
    t = trim_ws(name)
    return F.when(t == "", F.lit(UNNAMED_CLASS)).otherwise(t)
