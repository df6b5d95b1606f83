"""Releases from listed shards: units by a sweep, no shuffle for shards that stand alone, counts of new units only."""

import json
import random

from pyspark.sql import functions as F

from labelsmith import config as C
from labelsmith.operators import release as R
from labelsmith.operators import snapshots as SN
from labelsmith.operators import taxonomy

SCHEMA = "row_index BIGINT, cid BIGINT, inchi STRING, inchikey STRING, fetched_at STRING, " + C.ANSWER_FIELD + " STRING"


def _records(spark, rows, when="2024-01-01"):
    rnd = random.Random(len(rows))
    body = lambda: json.dumps({k: {"name": rnd.choice(["Rings", "rings", " Salts", "Acids"])} for k in ("kingdom", "class") if rnd.random() < 0.8})
    return spark.createDataFrame([(i, i, f"I{i}", "K", when, body()) for i in rows], SCHEMA)


def _write(spark, out, rows, when="2024-01-01", max_records=10):
    recs = _records(spark, rows, when)
    R.write_success_shards(recs, out, max_records=max_records, fmt="jsonl.zst")
    return recs


def _units_by_loop(ranges):
    units, reach = [], None
    for first, last, path in sorted(ranges):
        if reach is None or first > reach:
            units.append(set())
        units[-1].add(path)
        reach = last if reach is None else max(reach, last)
    return {frozenset(u) for u in units}


def test_units_against_a_loop(spark):
    rnd = random.Random(3)
    for n in (0, 1, 40):
        rows = []
        for k in range(n):
            first = rnd.randrange(300)
            rows.append((f"/s/f{k}", 1, 1, first, first + rnd.choice([0, 1, 5, 40])))
        index = spark.createDataFrame(rows, "path string, bytes long, records long, first_row long, last_row long")
        got = SN.release_units(index).collect()
        by = {}
        for r in got:
            by.setdefault(r.unit, set()).add(r.path)
            assert r.files == sum(x.unit == r.unit for x in got)
        assert {frozenset(u) for u in by.values()} == _units_by_loop([(r[3], r[4], r[0]) for r in rows])


def test_shards_alone_pass_without_a_shuffle(spark, tmpdir_path):
    out = tmpdir_path + "/z"
    recs = _write(spark, out, list(range(0, 100)))
    merged = SN.merge_units(spark, out)
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, merged.select(*recs.columns).collect())) == sorted(map(tuple, recs.collect()))


def test_overlaps_keep_the_newest_record(spark, tmpdir_path):
    out = tmpdir_path + "/z"
    _write(spark, out, list(range(0, 100)))
    again = _write(spark, out, [3, 4, 55, 150], when="2024-06-01")
    later = _write(spark, out, list(range(200, 230)))
    got = {r.row_index: r for r in SN.merge_units(spark, out).collect()}
    assert sorted(got) == sorted({*range(100), 150, *range(200, 230)}) and SN.merge_units(spark, out).count() == len(got)
    assert all(got[r.row_index].fetched_at == "2024-06-01" and got[r.row_index][C.ANSWER_FIELD] == r[C.ANSWER_FIELD] for r in again.collect())
    assert {r.row_index for r in later.collect()} <= set(got)
    want = R.merge_release(spark, out, "jsonl.zst")
    assert sorted(map(tuple, want.collect()), key=repr) == sorted(map(tuple, SN.merge_units(spark, out).select(*want.columns).collect()), key=repr)


def _recount(spark, out):
    nodes = taxonomy.taxonomy_nodes(taxonomy.taxonomy_long(R.merge_release(spark, out, "jsonl.zst")))
    return sorted(map(tuple, taxonomy.taxonomy_counts(nodes).collect()))


def test_counts_read_new_units_only(spark, tmpdir_path):
    out, store = tmpdir_path + "/z", tmpdir_path + "/counts"
    assert SN.release_counts(spark, out, store).collect() == []
    read = []
    for rows, when in ((range(0, 60), "2024-01-01"), (range(100, 130), "2024-01-01"), ([5, 70], "2024-02-01"), ([], "")):
        if len(rows):
            _write(spark, out, list(rows), when)
        read.append(SN.counted_units(spark, out, store)[1])
        assert sorted(map(tuple, SN.release_counts(spark, out, store).collect())) == _recount(spark, out)
    assert read[1] < read[0] + 1 and read[3] == 0
    assert SN.counted_units(spark, out, store)[1] == 0


def test_counts_of_a_failed_run_are_not_added(spark, tmpdir_path):
    out, store = tmpdir_path + "/z", tmpdir_path + "/counts"
    _write(spark, out, list(range(20)))
    long = taxonomy.taxonomy_long(SN.unit_records(spark, SN.release_units(SN.shard_index(spark, out))), keep=("unit",))
    taxonomy.spelling_counts(taxonomy.taxonomy_nodes(long), "unit").write.parquet(f"{store}/counts/run=dead")  # died before its units were noted
    assert sorted(map(tuple, SN.release_counts(spark, out, store).collect())) == _recount(spark, out)
    assert SN.shard_index(spark, out).agg(F.sum("records")).first()[0] == 20


def test_many_shards_are_one_read(spark, tmpdir_path):
    out = tmpdir_path + "/z"
    recs = _write(spark, out, list(range(0, 120)), max_records=4)
    merged = SN.merge_units(spark, out)
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1  # however many shards
    assert sorted(map(tuple, merged.select(*recs.columns).collect())) == sorted(map(tuple, recs.collect()))
    files = SN.shard_index(spark, out).select("path").collect()
    both = R.read_success_records(spark, [*(r.path for r in files), out + "/success-999999.jsonl.zst"], "jsonl.zst")
    assert len(files) >= 30 and both.count() == 120
