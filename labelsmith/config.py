"""Defaults and fixed values.

Everything in the "fixed values" block must equal the annotation service's conventions for the
results to agree (marker strings, layer order, panel limits, limits and intervals).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------------
# Fixed values (must match the original tool's behaviour; kept together and in natural order)
# ---------------------------------------------------------------------------------------------

# Substrings that mark an answer body as an HTML page (searched in the first 256 characters,
# ASCII lower-cased).
HTML_MARKERS = ("<!doctype html", "<html", "<head", "unsupported browser")
HTML_PREFIX_CHARS = 256
HTML_SNIPPET_CHARS = 80

# Body text that marks a "not found" page.
NOT_FOUND_TEXT = "the page you were looking for doesn't exist"

# Taxonomy layers in report order: (layer_no, JSON field / layer name, display label, panel limit).
LAYERS = (
    (0, "kingdom", "Kingdom", 6),
    (1, "superclass", "Superclass", 6),
    (2, "class", "Class", 6),
    (3, "subclass", "Subclass", 6),
    (4, "direct_parent", "Direct parent", 5),
)
LAYER_NAMES = tuple(name for _, name, _, _ in LAYERS)
UNNAMED_CLASS = "<unnamed>"

# Terminal row states.
SUCCESS, MISS, INVALID, FAILED = "success", "miss", "invalid", "failed"
STATES = (SUCCESS, MISS, INVALID, FAILED)
PENDING = "pending"

# Messages of invalid input rows, in the order the checks run.
MSG_CID_NOT_INTEGER = "CID is not an integer"
MSG_MISSING_INCHI = "missing InChI"
MSG_MISSING_INCHIKEY = "missing InChIKey"
MSG_EMPTY_FIELD = "empty InChI or InChIKey"
MSG_BAD_KEY = "invalid inchikey format in PubChem input"

# Messages of failed lookups.
MSG_THROTTLED = "entity request was throttled"
MSG_HTML_PREFIX = "entity request returned HTML"
MSG_STATUS_PREFIX = "entity request failed with status "
MSG_BAD_JSON = "failed to parse entity response JSON"

# Error buckets (first match wins): (substring of the lower-cased message, bucket).
ERROR_BUCKETS = (
    ("throttled", "throttled"),
    ("returned html", "html"),
    ("timed out", "timeout"),
    ("failed get /entities", "transport"),
)
ERROR_BUCKET_DEFAULT = "error"

# Unicode White_Space code points (what the original's `trim` and whitespace split use):
# U+0009-U+000D, U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F, U+205F,
# U+3000.
WHITESPACE_CODEPOINTS = (
    list(range(0x09, 0x0E)) + [0x20, 0x85, 0xA0, 0x1680] + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
WHITESPACE_CHARS = "".join(chr(c) for c in WHITESPACE_CODEPOINTS)
# The same set as a compact regex character class (Java regex and RE2): U+0009-U+000D, U+0085
# and the Unicode separators Zs/Zl/Zp (which are exactly the remaining code points above).
WHITESPACE_CLASS = r"[\t-\r\x{85}\p{Z}]"

# JSON key under which a success record keeps the raw answer (record format of the shards).
ANSWER_FIELD = "answer"
# Field of the summary document that holds the total number of input rows.
SUMMARY_TOTAL_FIELD = "pubchem_total_rows"

# Shard and release formats.
SHARD_NAME_FORMAT = "success-%06d"
RELEASE_FORMAT = "jsonl"

# ---------------------------------------------------------------------------------------------
# Defaults of the run configuration (keyword arguments of the operators)
# ---------------------------------------------------------------------------------------------
THROTTLE_BACKOFF_SECONDS = 300
SHARD_MAX_RECORDS = 100_000
SHARD_MAX_BYTES = 128 * 1024 * 1024
RELEASE_INTERVAL_DAYS = 7
DAILY_STATUS_HOUR_UTC = 18
RECENT_EVENTS = 8
RECENT_ERRORS = 8

# Bitmap layout: Spark's bitmap functions use 32,768-bit buckets (4 KiB each).
BITMAP_BUCKET_BITS = 32768
