"""Attempt-log operators: daily boundary, session delta, spans, recent lines."""

import datetime as dt

from labelsmith.operators import timeline as TL

SCHEMA = "attempt_id BIGINT, ts TIMESTAMP_NTZ, row_key BIGINT, state STRING, kind STRING, message STRING"


def _att(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_days_end_at_18_utc_across_a_month(spark):
    t = dt.datetime
    times = [t(2024, 2, 28, 17, 59, 59, 999999), t(2024, 2, 28, 18, 0), t(2024, 2, 29, 17, 59), t(2024, 2, 29, 18, 0, 0, 1), t(2024, 3, 1, 0, 0)]
    a = _att(spark, [(i, x, i, "miss", "event", None) for i, x in enumerate(times)])
    got = sorted((r.day_end, r.rows, r.cumulative_rows) for r in TL.daily_status(a).collect())
    assert got == [(t(2024, 2, 28, 18), 1, 1), (t(2024, 2, 29, 18), 2, 3), (t(2024, 3, 1, 18), 2, 5)]


def test_session_counts_completed_rows_alone(spark):
    t, n = dt.datetime, iter(range(1000))
    rows = [(next(n), t(2024, 6, day), 1, state, "event", None) for day, state, k in
            ((1, "success", 3), (1, "failed", 9), (2, "invalid", 1), (5, "miss", 4), (5, "failed", 2), (6, "success", 6)) for _ in range(k)]
    d = TL.session_delta(_att(spark, rows), "2024-06-05 00:00:00").first()
    assert (d.completed_at_start, d.completed_now, d.session_completed) == (4, 14, 10)


def test_minutes_rate_and_finish_date(spark):
    t = dt.datetime
    a = _att(spark, [(i, t(2024, 12, 31, 23, 0) + dt.timedelta(seconds=20 * i), i, "success" if i % 2 else "failed", "event", None) for i in range(10)])
    got = sorted((r.minute, r.completed_rows, r.attempts) for r in TL.throughput_windows(a).collect())
    assert got == [(t(2024, 12, 31, 23, 0), 1, 3), (t(2024, 12, 31, 23, 1), 2, 3), (t(2024, 12, 31, 23, 2), 1, 3), (t(2024, 12, 31, 23, 3), 1, 1)]
    for pending, day in ((0, dt.date(2024, 12, 31)), (96, dt.date(2025, 1, 1)), (3000, dt.date(2025, 1, 2))):
        m = spark.createDataFrame([(pending,)], "pending_rows BIGINT")
        r = TL.eta(m, TL.throughput(a), a).first()
        assert r.per_minute == 5 * 60 / 180 and r.finish_date == str(day)
    none = TL.eta(spark.createDataFrame([(5,)], "pending_rows BIGINT"), TL.throughput(a.where("state = 'failed'")), a).first()
    assert none.minutes_left is None and none.finish_date is None


def test_backoff_spans_merge_and_split(spark):
    t = dt.datetime
    msg = "entity request was throttled"
    a = _att(spark, [(1, t(2026, 1, 1, 0, 0, 0), 1, "failed", "error", msg),
                     (2, t(2026, 1, 1, 0, 5, 0), 2, "failed", "error", msg),   # exactly at end: merges
                     (3, t(2026, 1, 1, 0, 10, 1), 3, "failed", "error", msg),  # after end: new span
                     (4, t(2026, 1, 1, 0, 11, 0), 4, "failed", "error", "operation timed out")])
    spans = sorted((r.span_start, r.span_end, r.hits) for r in TL.backoff_spans(a).collect())
    assert spans == [(t(2026, 1, 1, 0, 0), t(2026, 1, 1, 0, 10), 2),
                     (t(2026, 1, 1, 0, 10, 1), t(2026, 1, 1, 0, 15, 1), 1)]


def test_gap_islands_across_buckets(spark):
    base = dt.datetime(2026, 1, 1)
    rows = [(i, base + dt.timedelta(seconds=100 * i), i, "failed", "error", "x throttled")
            for i in range(200)]
    rows += [(1000 + i, base + dt.timedelta(days=1, seconds=400 * i), i, "failed", "error", "throttled")
             for i in range(50)]
    a = _att(spark, rows)
    spans = TL.gap_islands(a, "ts", 300, bucket_seconds=250).collect()
    assert sorted(r.hits for r in spans) == [1] * 50 + [200]


def test_recent_ring_keeps_newest(spark):
    t = dt.datetime
    a = _att(spark, [(i, t(2026, 1, 1, 0, i), i, "success", "event", None) for i in range(1, 4)])
    got = sorted((r.pos, r.line) for r in TL.recent_events(a, events=2, errors=2).collect())
    assert got == [(1, "hit 2"), (2, "hit 3")]
    last = TL.last_result(a).first()
    assert last.result == "hit 3"
