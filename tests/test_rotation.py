"""Rotation with reset against a loop, over many blocks and levels; one exchange of answers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelsmith import config as C
from labelsmith.operators import release as R
from labelsmith.operators import rotation as rot


def _loop(sizes, max_records, max_bytes):
    out, no, records, size = [], 1, 0, 0
    for n in sizes:
        if records >= max_records or size >= max_bytes:
            no, records, size = no + 1, 0, 0
        out.append(no)
        records, size = records + 1, size + n
    return out


def _run(spark, sizes, max_records, max_bytes):
    rows = [(3 * i + i % 2, n) for i, n in enumerate(sizes)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "row_index long, size long").repartition(3)
    got = sorted(map(tuple, rot.rotate(df, max_records, max_bytes).collect()))
    assert [r[1] for r in got] == list(range(len(sizes))) and [r[2] for r in got] == [n or 0 for n in sizes]
    return [r[3] for r in got]


def test_the_open_shard_counts_from_nought(spark):
    assert _run(spark, [60, 60, 60] + [10] * 7, 4, 100) == [1, 1, 2, 2, 2, 2, 3, 3, 3, 3]


@pytest.mark.parametrize("fan", [2, 3, 256])
def test_against_a_loop(spark, monkeypatch, fan):
    monkeypatch.setattr(rot, "FAN", fan)
    rnd = random.Random(fan)
    for max_records, max_bytes, block in ((7, 50, 16), (1, 1000, 8), (30, 1, 8), (5, 10 ** 18, 5), (100, 60, 20)):
        monkeypatch.setattr(rot, "BLOCK", block)
        sizes = [rnd.choice([0, 1, 5, 20, 49, 50, 51, 300]) for _ in range(rnd.randrange(150, 260))]
        assert _run(spark, sizes, max_records, max_bytes) == _loop(sizes, max_records, max_bytes)


def test_edges(spark):
    assert _run(spark, [], 3, 3) == []
    assert _run(spark, [None, 5, None], 10, 5) == [1, 1, 2]
    assert _run(spark, [0] * 5, 2, 1) == [1, 1, 2, 2, 3]
    for args in ((0, 1), (1, 0), (rot.MOST_RECORDS + 1, 1)):
        with pytest.raises(ValueError):
            rot.rotate(spark.createDataFrame([], "row_index long, size long"), *args)


def test_next_begins_by_definition():
    sizes = np.array([5, 0, 7, 100, 3, 3, 3, 3])
    assert rot._next_begins(sizes, 3, 12).tolist() == [3, 4, 4, 4, 7, 8, 8, 8]


def _records(spark, n):
    rnd = random.Random(n)
    return spark.createDataFrame([(i * 5, i, f"InChI={i}", "K", "2024-01-01", '{"v":"' + "x" * rnd.randrange(200) + '"}') for i in range(n)],
                                 "row_index BIGINT, cid BIGINT, inchi STRING, inchikey STRING, fetched_at STRING, " + C.ANSWER_FIELD + " STRING").repartition(5)


def test_records_meet_their_shard_over_bucket_borders(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD_BUCKET", 64)
    recs = _records(spark, 300)
    got = sorted((r.row_index, r.shard_no) for r in R.with_shards(recs, R.shard_assignment(recs, 9, 700)).collect())
    sizes = [len(r[C.ANSWER_FIELD]) for r in recs.orderBy("row_index").collect()]
    assert [g[1] for g in got] == _loop(sizes, 9, 700)


def test_answers_are_exchanged_once(spark, tmpdir_path):
    _records(spark, 50).write.parquet(tmpdir_path + "/r")
    recs = spark.read.parquet(tmpdir_path + "/r")
    sharded = R.with_shards(recs, R.shard_assignment(recs, 10, 500)).sortWithinPartitions("shard_no", "row_index")
    plan = sharded._jdf.queryExecution().optimizedPlan().toString(), sharded._jdf.queryExecution().executedPlan()
    text = plan[1].toString()
    initial = text.split("== Initial Plan ==")[-1]
    moved = 0
    lines = initial.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(_bucket" in line or "Exchange rangepartitioning" in line:
            moved += any(C.ANSWER_FIELD in x for x in lines[i + 1:i + 4])
    assert moved == 1 and "SortMergeJoin" not in initial


def test_shard_directories_follow_the_loop(spark, tmpdir_path):
    recs = _records(spark, 120)
    out = tmpdir_path + "/s"
    R.write_success_shards(recs, out, max_records=11, max_bytes=800)
    got = spark.read.text(out).select(F.get_json_object("value", "$.row_index").cast("long").alias("r"), "shard").orderBy("r").collect()
    sizes = [len(r[C.ANSWER_FIELD]) for r in recs.orderBy("row_index").collect()]
    assert [r.shard for r in got] == [C.SHARD_NAME_FORMAT % n for n in _loop(sizes, 11, 800)]
