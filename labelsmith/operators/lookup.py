"""Joins of submissions to stored answers and to earlier row states.

Scale notes
-----------
* Answers are read where they are scanned: one parse per answer gives state, reason and the five
  taxonomy nodes, tens of bytes. Then they are reduced to one row per key by an aggregate with an
  expression per column, so that a plan moves only the columns it uses: counts and reports shuffle no
  body, and ``lookup_join`` parses none.
* Partial aggregation collapses a key answered many times before the shuffle. The join shuffles the
  deduplicated answers once more (see ``join_answers``) so that AQE may split a hot submission key.
* Invalid rows must not meet any answer. Instead of a NULL join key (all NULLs hash to one
  reducer: a hot partition when a third of the input is bad) they get a per-row key that can
  never match a well-formed key, which spreads them evenly.
* AQE turns the sort-merge join into a broadcast join when the deduplicated answers turn out
  small at run time; nothing is broadcast on a guess.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import backoff_reason, valid_key
from .classify import with_answer_state

ANSWER_COLS = ("status", "content_type", "body")
READ_COLS = ("state", "reason", "nodes")


def dedupe_responses(responses: DataFrame) -> DataFrame:
    """One answer per well-formed key, read (``state, reason, nodes``): the newest by ``fetched_at``
    when present, ties (and tables without ``fetched_at``) broken by a hash of the answer, so the
    pick is deterministic. ``answered`` is true in every row (a NULL status is an answer too).

    An aggregate rather than a window: partial aggregation collapses a key asked a million
    times to one row per task before the shuffle, so a hot key cannot overload a reducer.
    """
    ans = with_answer_state(responses.where(valid_key(F.col("inchikey"))))
    content_hash = F.xxhash64(*[F.col(c) for c in ANSWER_COLS])
    cols = [*ANSWER_COLS, *READ_COLS]
    if "fetched_at" in responses.columns:
        cols.append("fetched_at")
        order = F.struct(F.col("fetched_at"), content_hash)
    else:
        order = content_hash
    ans = ans.withColumn("_order", order)
    return ans.groupBy("inchikey").agg(F.lit(True).alias("answered"), *[F.max_by(c, "_order").alias(c) for c in cols])


def lookup_key() -> F.Column:
    """Join key: the inchikey of a valid row, a never-matching per-row key otherwise."""
    return F.when(F.col("invalid_reason").isNull(), F.col("inchikey")).otherwise(
        F.concat(F.lit("~invalid~"), F.col("row_index").cast("string")))


def join_answers(parsed: DataFrame, answers: DataFrame, split_hot_keys: bool = True) -> DataFrame:
    """Left outer equi join of parsed rows to answers that are already one row per key.

    AQE splits a hot join partition only across a shuffle that the planner itself inserted for
    the join. Joined on the bare key, the answers would keep the dedupe aggregate's hash
    partitioning, no such shuffle would exist, and a key held by a third of the submissions
    would stay in one task. The answer side's key is therefore ``upper(inchikey)``: identical
    for every well-formed key (A-Z and '-', enforced by the filter), but not the aggregate's
    partitioning expression, so the planner adds a join shuffle of the deduplicated answers
    (one row per key) and the skew split applies.

    ``split_hot_keys=False`` joins on the bare key instead, which keeps a table bucketed by
    ``inchikey`` usable without a shuffle (the stream path, whose micro-batches are bounded).
    """
    key = F.upper(F.col("inchikey")) if split_hot_keys else F.col("inchikey")
    right = answers.where(valid_key(F.col("inchikey"))).select(
        key.alias("lookup_key"), *[c for c in answers.columns if c != "inchikey"])
    left = parsed.withColumn("lookup_key", lookup_key())
    return left.join(right, "lookup_key", "left").drop("lookup_key")


def lookup_join(parsed: DataFrame, responses: DataFrame) -> DataFrame:
    """Left outer equi join of parsed rows to their (deduplicated) answer.

    Repeated keys fan the single stored answer out to every row carrying that key.
    """
    return join_answers(parsed, dedupe_responses(responses)).drop("answered", *READ_COLS)


def stored_lookup_join(parsed: DataFrame, stored: DataFrame) -> DataFrame:
    """``lookup_join`` against answers read from Parquet files, which moves each body at most once.

    The answer of a key is picked by its place (file and row there), its time and a hash alone; the rows are joined to
    that place, and the bodies to the rows at the end. Both sides of that last join are shuffled for it alone, so a key
    that many rows share is split by AQE. Rows without an answer carry a place of their own that no
    body has, so they spread evenly.
    """
    order = [F.col("fetched_at")] if "fetched_at" in stored.columns else []
    place = F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*order, F.xxhash64(*[F.col(c) for c in ANSWER_COLS])])],
                     F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    best = (stored.where(valid_key(F.col("inchikey"))).select("inchikey", place.alias("place"))
            .groupBy("inchikey").agg(F.max("place").alias("place")).select("inchikey", "place.file", "place.row"))
    rows = join_answers(parsed, best).withColumns({
        "_file": F.coalesce("file", F.lit("")), "_row": F.coalesce("row", -1 - F.col("row_index"))}).drop("file", "row")
    bodies = stored.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"),
                           *ANSWER_COLS, *[c for c in ("fetched_at",) if c in stored.columns])
    return rows.join(bodies, ["_file", "_row"], "left").drop("_file", "_row")


def annotate(parsed: DataFrame, responses: DataFrame) -> DataFrame:
    """Every parsed row with exactly one outcome.

    ``state`` is invalid / success / miss / failed, or ``pending`` when no answer is stored yet
    (pending rows get no terminal state). ``reason`` carries the invalid or failure message, ``nodes``
    the taxonomy nodes of the answer.
    """
    return annotate_with_answers(parsed, dedupe_responses(responses))


def annotate_with_answers(parsed: DataFrame, answers: DataFrame,
                          split_hot_keys: bool = True) -> DataFrame:
    """``annotate`` against answers that are already one row per key (e.g. a landed table)."""
    joined = join_answers(parsed, answers, split_hot_keys)
    state = (F.when(F.col("invalid_reason").isNotNull(), F.lit(C.INVALID))
             .when(F.col("answered").isNull(), F.lit(C.PENDING))
             .otherwise(F.col("state")))
    reason = (F.when(F.col("invalid_reason").isNotNull(), F.col("invalid_reason"))
              .otherwise(F.col("reason")))
    return joined.withColumns({"state": state, "reason": reason}).drop("answered")


def unprocessed_rows(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Rows that have no terminal state yet (anti join on ``row_index``, before parsing).

    A failed row counts as terminal and is not retried here.
    """
    return rows.join(states.select("row_index"), "row_index", "left_anti")


def retry_candidates(rows: DataFrame, states: DataFrame) -> DataFrame:
    """Failed rows with their message and the backoff class of that message."""
    failed = states.where(F.col("state") == C.FAILED).select("row_index", "reason")
    return (rows.join(failed, "row_index", "inner")
            .withColumn("backoff_reason",
                        F.coalesce(backoff_reason(F.col("reason")), F.lit("error"))))
