"""Streams: result equals the batch twin, and a restart from the checkpoint adds nothing."""

import os

from pyspark.sql import functions as F

from labelsmith import fixtures as X
from labelsmith.plans import annotate as P
from labelsmith.session import scratch_dir
from labelsmith.streaming import annotate as SA
from labelsmith.streaming import status as SS

from conftest import SF_SMALL


def test_stream_annotate_equals_batch_and_restarts_cleanly(spark):
    src = scratch_dir(spark, "t-arrivals")
    X.submissions(spark, SF_SMALL).repartitionByRange(4, "row_index").write.parquet(src)
    answers = SA.land_answers(X.responses(spark, SF_SMALL), scratch_dir(spark, "t-answers"), letters=1)
    out, ckpt = scratch_dir(spark, "t-out"), scratch_dir(spark, "t-ckpt")
    SA.start_annotation_stream(spark, src, answers, out, ckpt, files_per_trigger=1, letters=1).awaitTermination()
    streamed = {(r.row_index, r.state) for r in SA.read_states(spark, out).collect()}
    batch = {(r.row_index, r.state) for r in P.terminal_states(P.annotated(spark, SF_SMALL)).collect()}
    assert streamed == batch
    n_files = sum(len(f) for _, _, f in os.walk(out))
    SA.start_annotation_stream(spark, src, answers, out, ckpt, letters=1).awaitTermination()
    assert sum(len(f) for _, _, f in os.walk(out)) == n_files
    assert SA.read_states(spark, out).count() == len(batch)


def test_a_finished_row_that_comes_again_is_skipped(spark):
    src = scratch_dir(spark, "t-again")
    rows = X.submissions(spark, SF_SMALL).where("row_index < 400")
    rows.write.parquet(src + "/a")
    answers = SA.land_answers(X.responses(spark, SF_SMALL), scratch_dir(spark, "t-answers"), letters=1)
    out, ckpt = scratch_dir(spark, "t-out"), scratch_dir(spark, "t-ckpt")
    SA.start_annotation_stream(spark, src + "/*", answers, out, ckpt, letters=1).awaitTermination()
    before = [spark.read.parquet(f"{out}/{x}").count() for x in ("states", "records")]
    rows.write.parquet(src + "/b")
    SA.start_annotation_stream(spark, src + "/*", answers, out, ckpt, letters=1).awaitTermination()
    assert [spark.read.parquet(f"{out}/{x}").count() for x in ("states", "records")] == before
    assert "fetched_at" in spark.read.parquet(f"{out}/records").columns


LINE = "{i}\tInChI=1S/C{i}\t{key}"
ROWS = "row_index BIGINT, line STRING"
ANSWERS = "inchikey STRING, status INT, content_type STRING, body STRING, fetched_at STRING"


def _key(k):
    return "".join(chr(65 + (k // 26 ** j) % 26) for j in range(14)) + "-UHFFFAOYSA-N"


def _arrive(spark, src, name, ids):
    spark.createDataFrame([(i, LINE.format(i=i, key=_key(i % 50) if i % 10 else "bad")) for i in ids], ROWS).coalesce(1).write.parquet(f"{src}/{name}")


def _answers(spark, ks, body='{"kingdom":{"name":"n"}}'):
    return spark.createDataFrame([(_key(k), 200, "application/json", body, "2024-01-01") for k in ks], ANSWERS)


def _held(spark, out):
    table = lambda name: sorted(r.row_index for r in spark.read.parquet(f"{out}/{name}").collect())
    return table("states"), table("records")


def test_back_fill_finishes_waiting_rows_once(spark):
    src, out, ckpt = (scratch_dir(spark, f"t-fill-{x}") for x in ("src", "out", "ckpt"))
    answers = SA.land_answers(_answers(spark, range(0, 50, 2)), scratch_dir(spark, "t-fill-answers"), letters=1)
    stream = lambda: SA.start_annotation_stream(spark, src + "/*", answers, out, ckpt, letters=1).awaitTermination()
    _arrive(spark, src, "a", range(100))
    stream()
    valid = [i for i in range(100) if i % 10]
    even = [i for i in valid if i % 50 % 2 == 0]
    assert _held(spark, out) == (sorted([*even, *range(0, 100, 10)]), even)
    for _ in range(2):  # a repeated run changes nothing; keys that had an answer keep it
        SA.back_fill(spark, _answers(spark, [1, 3, 2, 4]).unionByName(_answers(spark, [2], "{}")), answers, out, 1, letters=1)
        some = sorted([*even, *[i for i in valid if i % 50 in (1, 3)]])
        assert _held(spark, out) == (sorted([*some, *range(0, 100, 10)]), some)
    _arrive(spark, src, "b", range(90, 160))  # rows that came before, and new ones: the stream sees the new answers
    stream()
    done = [i for i in range(160) if i % 10 and (i % 50 % 2 == 0 or i % 50 in (1, 3))]
    assert _held(spark, out) == (sorted([*done, *range(0, 160, 10)]), done)
    SA.back_fill(spark, _answers(spark, range(50)), answers, out, 2, letters=1)
    assert _held(spark, out) == (list(range(160)), [i for i in range(160) if i % 10])
    SA.back_fill(spark, _answers(spark, range(50)), answers, out, 3, letters=1)
    assert _held(spark, out)[0] == list(range(160)) and SA.read_states(spark, out).count() == 160
    shards = scratch_dir(spark, "t-fill-shards")
    assert SA.seal(spark, out, shards) == 4 and SA.seal(spark, out, shards) == 0
    _arrive(spark, src, "c", range(160, 170))
    stream()
    assert SA.seal(spark, out, shards) == 1
    from labelsmith.operators import release as R
    merged = R.merge_release(spark, shards, "jsonl.zst").collect()
    assert [r.row_index for r in merged] == [i for i in range(170) if i % 10]


def test_a_new_checkpoint_knows_what_is_done(spark):
    src, out = scratch_dir(spark, "t-new-src"), scratch_dir(spark, "t-new-out")
    answers = SA.land_answers(_answers(spark, range(50)), scratch_dir(spark, "t-new-answers"), letters=1)
    _arrive(spark, src, "a", range(40))
    for k in range(2):
        SA.start_annotation_stream(spark, src + "/*", answers, out, scratch_dir(spark, f"t-new-ckpt{k}"), letters=1).awaitTermination()
        if not k:
            _arrive(spark, src, "b", range(30, 60))
            spark.read.parquet(f"{out}/states").count()
    states = spark.read.parquet(f"{out}/states")
    assert states.count() == 60 == states.select("row_index").distinct().count()


def test_a_trigger_reads_the_folders_of_its_keys(spark):
    """Neither earlier states nor other answers are touched, and what a trigger reads doesn't grow with the number before it."""
    src, out, ckpt = (scratch_dir(spark, f"t-flat-{x}") for x in ("src", "out", "ckpt"))
    answers = SA.land_answers(_answers(spark, range(50)), scratch_dir(spark, "t-flat-answers"), letters=1)
    one = spark.createDataFrame([(_key(3),), (_key(29),), ("bad",)], "inchikey STRING")
    read = SA.answers_of(spark, answers, one, letters=1)
    assert {f.split("/prefix=")[1][0] for f in read.inputFiles()} == {"D"} and {r.inchikey for r in read.collect()} == {_key(3), _key(29)}
    assert SA.answers_of(spark, answers, one.where("inchikey = 'bad'"), letters=1).collect() == []
    opened, real = [], spark.read.__class__.parquet
    type(spark.read).parquet = lambda self, *paths, **kw: opened.append(paths) or real(self, *paths, **kw)
    counts = []
    try:
        for k in range(5):
            _arrive(spark, src, f"p{k}", range(20 * k, 20 * k + 20))
            SA.start_annotation_stream(spark, src + "/*", answers, out, ckpt, letters=1).awaitTermination()
            counts.append(len(opened))
            assert not any(f"{out}/states" in p for paths in opened for p in paths)
    finally:
        type(spark.read).parquet = real
    assert len({b - a for a, b in zip(counts, counts[1:])}) == 1
    assert sorted(r.row_index for r in SA.read_states(spark, out).collect()) == list(range(100))


def test_bitmap_dedupe_equals_exact(spark):
    att = X.attempts(spark, SF_SMALL)
    src = scratch_dir(spark, "t-bits")
    att.repartitionByRange(3, "ts").write.parquet(src)
    out, ckpt = scratch_dir(spark, "t-bits-out"), scratch_dir(spark, "t-bits-ckpt")
    SS.start_dedupe(SS.attempt_stream(spark, src, att.schema), "row_key", out, ckpt, bitmap=True).awaitTermination()
    keys = [r.row_key for r in spark.read.parquet(out).collect()]
    assert len(keys) == len(set(keys)) and set(keys) == {r.row_key for r in att.select("row_key").distinct().collect()}


def test_counts_are_replaced_by_versions(spark):
    out = scratch_dir(spark, "t-versions")
    assert SS.read_state_counts(spark, out).collect() == []
    for k in range(4):
        SS._versions(out)(spark.createDataFrame([("miss", k)], "state string, rows long"), k)
        half = spark.createDataFrame([("miss", 99)], "state string, rows long")
        half.write.mode("overwrite").parquet(f"{out}/version={k + 1}")
        os.remove(f"{out}/version={k + 1}/_SUCCESS")  # a write that is under way
        assert [r.rows for r in SS.read_state_counts(spark, out).collect()] == [k]
    assert SS._complete(spark, out) == [2, 3]


def test_stream_dedupe_and_counts(spark):
    att = X.attempts(spark, SF_SMALL)
    src = scratch_dir(spark, "t-att")
    att.repartitionByRange(3, "ts").write.parquet(src)
    out, ckpt = scratch_dir(spark, "t-dd"), scratch_dir(spark, "t-dd-ckpt")
    SS.start_dedupe(SS.attempt_stream(spark, src, att.schema), "row_key", out, ckpt).awaitTermination()
    keys = [r.row_key for r in spark.read.parquet(out).collect()]
    assert len(keys) == len(set(keys)) == att.select("row_key").distinct().count()
    out2, ckpt2 = scratch_dir(spark, "t-cnt"), scratch_dir(spark, "t-cnt-ckpt")
    SS.start_state_counts(SS.attempt_stream(spark, src, att.schema), out2, ckpt2).awaitTermination()
    got = {r.state: r.rows for r in SS.read_state_counts(spark, out2).collect()}
    want = {r.state: r["count"] for r in att.groupBy("state").count().collect()}
    assert got == want


def test_daily_status_stream_drops_rows_behind_the_watermark(spark):
    import datetime as dt
    schema = ("attempt_id BIGINT, ts TIMESTAMP_NTZ, row_key BIGINT, state STRING, kind STRING, "
              "message STRING")
    src = scratch_dir(spark, "t-late")
    early = [(1, dt.datetime(2026, 1, 10, 12), 1, "success", "event", None),
             (2, dt.datetime(2026, 1, 12, 12), 2, "success", "event", None)]
    late = [(3, dt.datetime(2026, 1, 5, 12), 3, "success", "event", None),   # 7 days behind
            (4, dt.datetime(2026, 1, 12, 13), 4, "miss", "event", None)]
    spark.createDataFrame(early, schema).coalesce(1).write.parquet(src + "/a")
    out, ckpt = scratch_dir(spark, "t-late-out"), scratch_dir(spark, "t-late-ckpt")
    stream = SS.attempt_stream(spark, src + "/*", spark.createDataFrame([], schema).schema, 1)
    q = SS.start_daily_status(stream, out, ckpt, watermark="1 day")
    q.awaitTermination()
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(src + "/b")
    SS.start_daily_status(SS.attempt_stream(spark, src + "/*", stream.schema, 1), out, ckpt,
                          watermark="1 day").awaitTermination()
    got = {(r.day_end.day, r.state): r.rows for r in SS.read_daily_status(spark, out).collect()}
    assert got == {(10, "success"): 1, (12, "success"): 1, (12, "miss"): 1}


def test_backoff_spans_stream_equals_batch(spark):
    import datetime as dt

    from labelsmith.operators import timeline as TL
    schema = "attempt_id BIGINT, ts TIMESTAMP_NTZ, row_key BIGINT, state STRING, kind STRING, message STRING"
    at = dt.datetime(2026, 1, 10)
    seconds = [0, 299, 300, 600, 601, 1000, 1300, 1601, 1901, 5000, 5000, 5000, 5299, 5599, 9000]
    hits = [(k, at + dt.timedelta(seconds=s), k, "failed", "request", "entity request was throttled") for k, s in enumerate(seconds)]
    others = [(100, at + dt.timedelta(seconds=3000), 1, "success", "event", None), (101, at + dt.timedelta(days=2), 1, "success", "event", None)]
    att = spark.createDataFrame([*hits, *others], schema)
    batch = sorted(map(tuple, TL.backoff_spans(att).collect()))
    assert len(batch) > 3
    src = scratch_dir(spark, "t-spans")
    att.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(src)
    out, ckpt = scratch_dir(spark, "t-spans-out"), scratch_dir(spark, "t-spans-ckpt")
    SS.start_backoff_spans(SS.attempt_stream(spark, src, att.schema, 10), out, ckpt).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).drop("batch_id").collect())) == batch


def test_landed_answers_hold_no_nodes(spark):
    path = SA.land_answers(_answers(spark, range(5)), scratch_dir(spark, "t-light-answers"), letters=1)
    assert {"inchikey", "answered", "state", "reason", "body", "fetched_at"} <= set(SA.answer_schema(spark, path).names)
    assert "nodes" not in SA.answer_schema(spark, path).names
