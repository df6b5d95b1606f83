"""Line sources, numbering, counting and input fingerprints."""

import os
import time

import pytest
from pyspark.sql import functions as F

from labelsmith.sources import lines as L


def _write(path, text, mode="w"):
    with open(path, mode, newline="") as f:
        f.write(text)


def test_number_lines_across_files_and_crlf(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "a.tsv"), "l0\r\n\nl2\rx\n")
    _write(os.path.join(tmpdir_path, "b.tsv"), "l4\nl5")
    got = sorted((r.row_index, r.line) for r in L.number_lines(spark, tmpdir_path).collect())
    assert got == [(0, "l0\r"), (1, ""), (2, "l2\rx"), (3, "l4"), (4, "l5")]
    assert L.count_lines(spark, tmpdir_path).first().input_rows == 5


def test_number_lines_many_splits(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "big.tsv")
    _write(path, "".join(f"{i}\tline\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        got = L.number_lines(spark, path).select(
            (F.col("row_index") == F.split("line", "\t")[0].cast("long")).alias("ok"))
        assert got.where(~F.col("ok")).count() == 0 and got.count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_count_override(spark, tmpdir_path):
    assert L.count_lines(spark, tmpdir_path, override=7).first().input_rows == 7
    with pytest.raises(ValueError):
        L.count_lines(spark, tmpdir_path, override=0)


def test_empty_file(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "e.tsv"), "")
    assert L.count_lines(spark, tmpdir_path).first().input_rows == 0


def test_fingerprint_mismatch_order(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "in.tsv")
    _write(path, "1\ta\tb\n")
    cur = L.file_metadata(spark, path)
    c = cur.first()
    runs = spark.createDataFrame(
        [(1, c.input_path, c.input_size_bytes, c.input_mtime_epoch),
         (2, c.input_path + ".other", c.input_size_bytes, c.input_mtime_epoch),
         (3, c.input_path, c.input_size_bytes + 1, c.input_mtime_epoch),
         (4, c.input_path, c.input_size_bytes, c.input_mtime_epoch + 1),
         (5, c.input_path, c.input_size_bytes + 1, c.input_mtime_epoch + 1)],
        "run_id INT, input_path STRING, input_size_bytes BIGINT, input_mtime_epoch BIGINT")
    got = {r.run_id: r.mismatch for r in L.input_fingerprint(cur, runs).collect()}
    assert got == {1: None, 2: "input path", 3: "input size", 4: "input mtime", 5: "input size"}


def test_added_files_and_stored_runs(spark, tmpdir_path):
    src, runs = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "runs")
    os.makedirs(src)
    _write(os.path.join(src, "a.tsv"), "1\n")
    L.record_run(L.file_metadata(spark, src), 1, runs)
    with pytest.raises(ValueError):
        L.record_run(L.file_metadata(spark, src), 1, runs)
    assert [r.mismatch for r in L.input_fingerprint(L.file_metadata(spark, src), spark.read.parquet(runs)).collect()] == [None]
    _write(os.path.join(src, "b.tsv"), "2\n")
    L.record_run(L.file_metadata(spark, src), 2, runs)
    got = {r.run_id: r.mismatch for r in L.input_fingerprint(L.file_metadata(spark, src), spark.read.parquet(runs)).collect()}
    assert got == {1: "input path", 2: None}


def test_multi_frame_zstd_input(spark, tmpdir_path):
    import zstandard
    data = "".join(f"{i}\tInChI\tKEY\n" for i in range(1000)).encode()
    c = zstandard.ZstdCompressor(level=3)
    with open(os.path.join(tmpdir_path, "in.tsv.zst"), "wb") as f:
        f.write(c.compress(data[:5000]) + c.compress(data[5000:]))
    open(os.path.join(tmpdir_path, "empty.tsv.zst"), "wb").close()
    rows = L.number_lines(spark, tmpdir_path).orderBy("row_index").collect()
    assert len(rows) == 1000 and rows[-1].row_index == 999 and rows[-1].line == "999\tInChI\tKEY"


def test_land_lines_pins_numbering(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    _write(os.path.join(src, "a.tsv"), "x\ny\n")
    landed = L.land_lines(spark, src, os.path.join(tmpdir_path, "landed"))
    assert sorted((r.row_index, r.line) for r in landed.collect()) == [(0, "x"), (1, "y")]


def test_bucketed_resume_join_needs_no_shuffle(spark, tmpdir_path):
    from labelsmith.operators import lookup
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    _write(os.path.join(src, "a.tsv"), "".join(f"{i}\tx\tK\n" for i in range(500)))
    rows = L.land_lines(spark, src, os.path.join(tmpdir_path, "rows"), buckets=4)
    done = rows.where("row_index % 3 = 0").select("row_index", F.lit("success").alias("state"))
    states = L.bucketed_by_row(done, os.path.join(tmpdir_path, "states"), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        todo = lookup.unprocessed_rows(rows, states)
        assert todo.count() == 500 - 167
        plan = todo._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
