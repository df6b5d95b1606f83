"""Attempt-log operators over time.

Inputs are attempt logs ``(attempt_id, ts, row_key, state, kind, message)``. Time arithmetic is
done on microseconds since the epoch (exact integers) so boundaries agree with any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import backoff_reason, compact_error
from .report import attach_one_row

COMPLETED = (C.SUCCESS, C.MISS, C.INVALID)


def micros(c: str = "ts") -> F.Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column (UTC clock)."""
    return F.unix_micros(F.col(c).cast("timestamp"))


def session_delta(attempts: DataFrame, session_start: str) -> DataFrame:
    """Completed rows (success + miss + invalid) at session start, now, and the difference
    floored at 0; one keyless aggregate."""
    done = F.col("state").isin(*COMPLETED)
    before = F.col("ts") < F.lit(session_start).cast(attempts.schema["ts"].dataType)
    agg = attempts.agg(F.count_if(done & before).alias("completed_at_start"),
                       F.count_if(done).alias("completed_now"))
    return agg.withColumn("session_completed",
                          F.greatest(F.col("completed_now") - F.col("completed_at_start"), F.lit(0)))


def attempt_line(prefix_error_bucket: bool = False) -> F.Column:
    """Text of an event line: ``hit KEY``, ``miss KEY`` or ``error KEY: message``."""
    key = F.col("row_key").cast("string")
    msg = compact_error(F.col("message")) if prefix_error_bucket else F.coalesce(F.col("message"), F.lit(""))
    return (F.when(F.col("kind") == "error", F.concat(F.lit("error "), key, F.lit(": "), msg))
            .when(F.col("state") == C.SUCCESS, F.concat(F.lit("hit "), key))
            .when(F.col("state") == C.MISS, F.concat(F.lit("miss "), key))
            .otherwise(F.concat(F.lit("error "), key, F.lit(": "), msg)))


def recent_events(attempts: DataFrame, events: int = C.RECENT_EVENTS,
                  errors: int = C.RECENT_ERRORS) -> DataFrame:
    """Newest ``events`` lines of kind event and ``errors`` of kind error; ``pos`` 1 = oldest.

    ``row_number() <= k`` lets Spark insert a partial per-task group limit before the shuffle,
    so only k rows per kind and task move, whatever the log size.
    """
    w = Window.partitionBy("kind").orderBy(F.desc("ts"), F.desc("attempt_id"))
    limit = F.when(F.col("kind") == "error", F.lit(errors)).otherwise(F.lit(events))
    # literal bound first (enables the partial group limit), then the per-kind bound
    top = (attempts.withColumn("rn", F.row_number().over(w))
           .where(F.col("rn") <= max(events, errors)).where(F.col("rn") <= limit))
    n_kind = F.least(F.count(F.lit(1)).over(Window.partitionBy("kind")), limit)
    return top.select("kind", "attempt_id", "ts", "row_key", "state",
                      attempt_line().alias("line"), (n_kind - F.col("rn") + 1).alias("pos"))


def last_result(attempts: DataFrame) -> DataFrame:
    """Latest outcome: ``hit KEY`` / ``miss KEY`` / ``error KEY: bucket`` (keyless max_by)."""
    latest = F.max_by(F.struct("attempt_id", "ts", "row_key", "state", "kind", "message"),
                      F.struct("ts", "attempt_id"))
    one = attempts.agg(latest.alias("r")).select("r.*")
    return one.select("attempt_id", "ts", "row_key", "state",
                      attempt_line(prefix_error_bucket=True).alias("result"))


def daily_status(attempts: DataFrame, hour: int = C.DAILY_STATUS_HOUR_UTC) -> DataFrame:
    """Counts per state and UTC day ending at ``hour``:00, plus the running total per state.

    A row at exactly the boundary belongs to the next day. The window aggregate is partial per
    task; the running sum runs on the (days x states) result only.
    """
    day = F.window("ts", "1 day", "1 day", f"{hour} hours")
    per_day = (attempts.groupBy(day.alias("w"), "state").agg(F.count(F.lit(1)).alias("rows"))
               .select(F.col("w.end").alias("day_end"), "state", "rows"))
    run = Window.partitionBy("state").orderBy("day_end").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.withColumn("cumulative_rows", F.sum("rows").over(run))


def release_cadence(attempts: DataFrame, interval_days: int = C.RELEASE_INTERVAL_DAYS) -> DataFrame:
    """Success rows per release period (``interval_days`` from the first attempt) and so far."""
    period = interval_days * 86_400_000_000
    start = attempts.agg(F.min(micros()).alias("start_us"))
    rel = attach_one_row(attempts.where(F.col("state") == C.SUCCESS), start).select(
        F.expr(f"(unix_micros(cast(ts AS TIMESTAMP)) - start_us) div {period}").alias("release_no"))
    per = rel.groupBy("release_no").agg(F.count(F.lit(1)).alias("success_rows"))
    run = Window.orderBy("release_no").rowsBetween(Window.unboundedPreceding, 0)
    # one row per release period: a handful of rows, so an unpartitioned window is fine here
    return per.withColumn("cumulative_success", F.sum("success_rows").over(run))


def throughput(attempts: DataFrame) -> DataFrame:
    """Completed rows per minute over the log's span: n * 60 / max(elapsed seconds, 1)."""
    done = F.col("state").isin(*COMPLETED)
    agg = attempts.agg(F.count_if(done).alias("completed_rows"),
                       ((F.max(micros()) - F.min(micros())) / F.lit(1_000_000)).alias("elapsed_seconds"))
    return agg.withColumn("per_minute", F.col("completed_rows") * 60
                          / F.greatest(F.col("elapsed_seconds"), F.lit(1.0)))


def throughput_windows(attempts: DataFrame) -> DataFrame:
    """``(minute, completed_rows, attempts)``: completed rows of each minute that has attempts."""
    done = F.col("state").isin(*COMPLETED)
    return attempts.groupBy(F.date_trunc("minute", F.col("ts")).cast(attempts.schema["ts"].dataType).alias("minute")).agg(
        F.count_if(done).alias("completed_rows"), F.count(F.lit(1)).alias("attempts"))


def gap_islands(events: DataFrame, ts_col: str, gap_seconds: int, bucket_seconds: int = 3600) -> DataFrame:
    """Merge events into spans: a new span starts when an event comes more than ``gap_seconds``
    after the previous one. Returns ``(span_start, span_last, hits)``.

    Events of one instant are counted first, so a hot instant is one row. Islands are found within
    buckets of time, each a window of its own, and stitched across the borders of buckets by a
    summary of one row per non-empty bucket. Everything depends on values alone.
    """
    gap, width = gap_seconds * 1_000_000, bucket_seconds * 1_000_000
    ev = events.groupBy(micros(ts_col).alias("t")).agg(F.count(F.lit(1)).alias("n"))
    ev = ev.withColumn("bucket", F.floor(F.col("t") / width).cast("long"))
    w = Window.partitionBy("bucket").orderBy("t")
    prev = F.lag("t").over(w)
    local = (ev.withColumn("new", F.when(prev.isNull() | (F.col("t") > prev + gap), 1).otherwise(0))
             .withColumn("local_id", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    islands = local.groupBy("bucket", "local_id").agg(
        F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.sum("n").alias("hits"))
    parts = islands.groupBy("bucket").agg(F.min("first_t").alias("p_first"),
                                          F.max("last_t").alias("p_last"),
                                          F.count(F.lit(1)).alias("p_islands"))
    # one row per hour that has events (a century: 876,000): an unpartitioned window
    pw = Window.orderBy("bucket")
    parts = parts.withColumn(
        "cont", F.when(F.col("p_first") <= F.lag("p_last").over(pw) + gap, 1).otherwise(0))
    parts = parts.withColumn(
        "offset", F.coalesce(F.sum(F.col("p_islands") - F.col("cont")).over(
            pw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    glob = islands.join(parts.select("bucket", "cont", "offset"), "bucket").withColumn(
        "span_id", F.col("offset") - F.col("cont") + F.col("local_id"))
    spans = glob.groupBy("span_id").agg(F.min("first_t").alias("s"), F.max("last_t").alias("l"),
                                        F.sum("hits").cast("long").alias("hits"))
    to_ts = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return spans.select(to_ts("s").alias("span_start"), to_ts("l").alias("span_last"), "hits")


def backoff_spans(attempts: DataFrame, backoff_seconds: int = C.THROTTLE_BACKOFF_SECONDS) -> DataFrame:
    """Gate-closed spans: each throttle/HTML failure closes the gate for ``backoff_seconds``;
    overlapping closures merge. ``(span_start, span_end, hits)``."""
    hits = attempts.where((F.col("state") == C.FAILED)
                          & backoff_reason(F.col("message")).isNotNull())
    spans = gap_islands(hits, "ts", backoff_seconds)
    return spans.select("span_start",
                        (F.col("span_last") + F.expr(f"INTERVAL {backoff_seconds} SECONDS"))
                        .alias("span_end"), "hits")


def eta(metrics: DataFrame, rate: DataFrame, attempts: DataFrame) -> DataFrame:
    """Remaining rows / completed-per-minute rate -> minutes and days left, and the UTC day on which the
    last one is done, counted from the log's last attempt (NULLs at rate 0)."""
    both = attach_one_row(metrics.select("pending_rows"), rate.select("per_minute"))
    both = attach_one_row(both, attempts.agg(F.max(micros()).alias("last_us")))
    minutes = F.when(F.col("per_minute") > 0, F.col("pending_rows") / F.col("per_minute"))
    day = 86_400_000_000
    ahead = F.ceil((F.col("last_us") % day) / F.lit(float(day)) + minutes / F.lit(1440.0)) - 1
    finish = F.date_from_unix_date((F.expr(f"last_us div {day}") + ahead).cast("int")).cast("string")
    return both.select("pending_rows", "per_minute", minutes.alias("minutes_left"),
                       (minutes / F.lit(1440.0)).alias("days_left"), finish.alias("finish_date"))
