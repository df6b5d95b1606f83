"""Key shape and answer-body checks.

An answer body is parsed once, as the entries of its outermost object with their values as JSON text
(``read_answers``); validity, classification and the five taxonomy nodes all come from that.
The built-in parser refuses some valid bodies (nesting or strings beyond its limits), so its NULL says
nothing about a body: what it refuses is read again by ``jsoncheck``, which has no such limits, and
only a body that this rejects too is bad JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LAYER_NAMES
from .jsoncheck import checked_answer
from .text import as_col

KEY_PATTERN = r"^[A-Z]{14}-[A-Z]{10}-[A-Z]\z"


def valid_key(c) -> Column:
    r"""27 bytes: 14 A-Z, '-', 10 A-Z, '-', 1 A-Z.

    ``\z`` (not ``$``) so a trailing newline fails; one reference to the key, so a key that is
    itself an expression is evaluated once when the filter is pushed below its projection."""
    return F.coalesce(as_col(c).rlike(KEY_PATTERN), F.lit(False))


def body_mark(body) -> Column:
    return F.hex(F.xxhash64(as_col(body)))


def parsed_objects(body) -> Column:
    """The body's object with its values as JSON text, and an object with the body's mark as key.

    The parser stops where a value ends, so the body stands in a list before the marked object: whatever
    follows the body's own object fails the parse or keeps the mark away from the second place.
    """
    b = as_col(body)
    return F.from_json(F.concat(F.lit("["), b, F.lit(',{"'), body_mark(b), F.lit('":0}]')), "array<map<string,string>>",
                       {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"})


def taxonomy_entries(objects: Column, mark: Column) -> Column:
    """Entries of the five taxonomy keys alone; NULL where the built-in parser refused the body."""
    whole = (F.size(objects) == 2) & F.map_contains_key(F.get(objects, 1), mark)
    return F.filter(F.when(whole, F.map_entries(F.get(objects, 0))), lambda e: e["key"].isin(*LAYER_NAMES))


def refused_body(body, entries: Column) -> Column:
    """The body where the built-in parser refused what begins like an object, else NULL."""
    b = as_col(body)
    return F.when(entries.isNull() & b.rlike(r"^[ \t\n\r]*\{"), b)


def single_entries(entries: Column) -> Column:
    """Entries unless a taxonomy key stands twice (a bad answer; other repeated keys are ignored)."""
    keys = F.transform(entries, lambda e: e["key"])
    return F.when(F.size(keys) == F.size(F.array_distinct(keys)), entries)


def read_answers(df: DataFrame, usable: Column | None = None, body: str = "body", out: str = "_entries") -> DataFrame:
    """Add ``out``: entries of the five taxonomy keys of a body that is one JSON object, else NULL; and
    ``_refused``: the body where the built-in parser refused it.

    In steps, so that the body is parsed once. Rows where ``usable`` is false are not parsed.
    """
    b = F.col(body) if usable is None else F.when(usable, F.col(body))
    step = df.withColumn("_objects", parsed_objects(b))
    step = step.withColumn("_parsed", taxonomy_entries(F.col("_objects"), body_mark(b)))
    step = step.withColumn("_refused", refused_body(b, F.col("_parsed")))
    step = step.withColumn("_checked", checked_answer(F.col("_refused")))
    return step.withColumn(out, single_entries(F.coalesce("_parsed", "_checked"))).drop("_objects", "_parsed", "_checked")


def held(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` with ``cols`` (moved to the end) as what a generator puts out: a filter on them stays above it, so
    that their expressions, a parse among them, stand in the plan once and not again in the filter below."""
    return df.select(*[c for c in df.columns if c not in cols], F.inline(F.array(F.struct(*cols))))


def json_object_body(entries: Column) -> Column:
    """Body is exactly one JSON object, without trailing text and without a repeated taxonomy key."""
    return entries.isNotNull()


def has_classification(entries: Column) -> Column:
    """Any of the five fields present and not JSON null (any value type counts)."""
    return F.coalesce(F.exists(entries, lambda x: x["value"].isNotNull()), F.lit(False))


NODES = ", ".join(f"`{name}` STRUCT<name: VARIANT, chemont_id: VARIANT>" for name in LAYER_NAMES)


def with_taxonomy(df: DataFrame, entries: str = "_entries", body: str = "body", out: str = "nodes") -> DataFrame:
    """Add ``out``: the five nodes of an answer; ``bad``: present, but no object with a string ``name``.

    The nodes of a classified answer are read at once, with their two fields alone; where the built-in
    parser refused the body, from its entries. In steps, so that nothing is read twice.
    """
    e = F.col(entries)
    present = F.transform(F.filter(e, lambda x: x["value"].isNotNull()), lambda x: x["key"])
    rebuilt = F.concat(F.lit("{"), F.array_join(F.transform(F.filter(e, lambda x: x["value"].isNotNull()), lambda x: F.concat(
        F.lit('"'), x["key"], F.lit('":'), x["value"])), ","), F.lit("}"))
    step = df.withColumn("_present", present)
    text = F.when(F.size("_present") > 0, F.when(F.col("_refused").isNull(), F.col(body)).otherwise(rebuilt))
    step = step.withColumn("_tax", F.from_json(text, NODES))

    def node(name: str) -> Column:
        n = F.col("_tax")[name]
        named = F.coalesce(F.schema_of_variant(n["name"]) == "STRING", F.lit(False))
        return F.when(F.array_contains("_present", name), F.struct(
            F.try_variant_get(n["name"], "$", "string").alias("name"),
            F.try_variant_get(n["chemont_id"], "$", "string").alias("chemont_id"), (~named).alias("bad"))).alias(name)

    return step.withColumn(out, F.struct(*[node(name) for name in LAYER_NAMES])).drop("_present", "_tax", "_refused")
