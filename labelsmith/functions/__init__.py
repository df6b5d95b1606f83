"""Column expressions shared by the operators."""

from .answers import (has_classification, held, json_object_body, read_answers, valid_key,
                      with_taxonomy)
from .fmt import format_count, format_percent, percent_hundredths, safe_ratio
from .text import (ascii_lower, backoff_reason, collapse_ws, compact_error, display_class_name,
                   html_summary, html_title, looks_html, looks_not_found, strip_line_end, trim_ws)

__all__ = [
    "ascii_lower", "backoff_reason", "collapse_ws", "compact_error",
    "display_class_name", "format_count", "format_percent", "has_classification", "held", "html_summary",
    "html_title", "json_object_body", "looks_html", "looks_not_found", "percent_hundredths",
    "read_answers", "safe_ratio", "strip_line_end", "trim_ws", "valid_key", "with_taxonomy",
]
