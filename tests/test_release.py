"""Shards, release merge, manifest and summary round trips."""

import gzip
import json
import os

from pyspark.sql import functions as F

from labelsmith import config as C
from labelsmith.operators import release as R
from labelsmith.operators import report, taxonomy
from labelsmith.operators.positions import with_positions

BODY = '{"direct_parent":{"name":"Alkanes","chemont_id":"C:1"}}'


def _records(spark, n=2):
    return spark.createDataFrame(
        [(i * 3, 100 + i, f"InChI=1S/C{i}", "ABCDEFGHIJKLMN-OPQRSTUVWX-Y", BODY) for i in range(n)],
        "row_index BIGINT, cid BIGINT, inchi STRING, inchikey STRING, " + C.ANSWER_FIELD + " STRING")


def test_shards_rotate_at_limit(spark):
    sh = R.shard_assignment(_records(spark), max_records=1, max_bytes=10)
    got = sorted((r.row_index, r.pos, r.size, r.shard_no) for r in sh.collect())
    assert got == [(0, 0, len(BODY), 1), (3, 1, len(BODY), 2)]


def test_the_first_limit_met_cuts_the_shard(spark):
    sizes = [10, 10, 500, 10, 10, 10, 10, 10, 10, 10, 990, 10]
    recs = spark.createDataFrame([(7 * i, i, "x", "k", "a" * n) for i, n in enumerate(sizes)], _records(spark).schema)
    rows = sorted(R.shard_assignment(recs, max_records=4, max_bytes=500).collect(), key=lambda r: r.row_index)
    assert [r.shard_no for r in rows] == [1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 3, 4]


def test_positions_sparse_keys(spark):
    df = spark.createDataFrame([(k, 1) for k in (5, 3_000_000, 7, 2_500_000, 1 << 21)], "k BIGINT, s INT")
    got = sorted((r.k, r.pos, r.size_before) for r in with_positions(df, "k", "s", width=1 << 20).collect())
    assert got == [(5, 0, 0), (7, 1, 1), (1 << 21, 2, 2), (2_500_000, 3, 3), (3_000_000, 4, 4)]


def test_write_merge_manifest(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "success")
    R.write_success_shards(_records(spark), out, max_records=1)
    dirs = sorted(d for d in os.listdir(out) if d.startswith("shard="))
    assert dirs == ["shard=success-000001", "shard=success-000002"]
    # the shard files are gzip JSON lines with the answer embedded as raw JSON
    f = [x for x in os.listdir(os.path.join(out, dirs[0])) if x.startswith("part-")][0]
    line = gzip.open(os.path.join(out, dirs[0], f), "rt").read().strip()
    assert json.loads(line)[C.ANSWER_FIELD] == json.loads(BODY)
    merged = R.merge_release(spark, out).collect()
    assert [r.row_index for r in merged] == [0, 3] and merged[0][C.ANSWER_FIELD] == BODY
    counts = spark.createDataFrame([(2, 3, 4, 5)], "success_rows BIGINT, miss_rows BIGINT, "
                                   "invalid_rows BIGINT, failed_rows BIGINT")
    files = R.shard_files(spark, out)
    m = R.release_manifest(counts, files).first()
    assert (m.success_rows, m.miss_rows, m.invalid_rows, m.failed_rows) == (2, 3, 4, 5)
    assert [s.filename.split("/")[0] for s in m.shards] == dirs
    assert R.release_gate(counts, files)
    zero = counts.withColumn("success_rows", F.lit(0).cast("long"))
    assert not R.release_gate(zero, files)


def test_duplicate_record_dropped_on_merge(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "success")
    recs = _records(spark, 3)
    R.write_success_shards(recs, out, max_records=2)
    R.write_success_shards(recs.where("row_index = 3"), os.path.join(tmpdir_path, "again"), 2)
    both = R.merge_release(spark, [out, os.path.join(tmpdir_path, "again")])
    assert [r.row_index for r in both.collect()] == [0, 3, 6]


def test_missing_shard_paths_are_skipped(spark, tmpdir_path):
    out, gone = os.path.join(tmpdir_path, "success"), os.path.join(tmpdir_path, "gone")
    R.write_success_shards(_records(spark, 1), out, max_records=5)
    assert R.read_success_records(spark, [gone, out, gone + "2"]).count() == 1
    assert R.read_success_records(spark, [gone]).collect() == [] == R.merge_release(spark, gone).collect()


def test_newest_of_two_records_stays(spark, tmpdir_path):
    schema = "row_index BIGINT, cid BIGINT, inchi STRING, inchikey STRING, fetched_at STRING, " + C.ANSWER_FIELD + " STRING"
    for name, when, body in (("a", "2024-02-01", '{"v":1}'), ("b", "2024-03-01", '{"v":2}'), ("c", None, '{"v":3}')):
        R.write_success_shards(spark.createDataFrame([(5, 1, "x", "k", when, body)], schema), os.path.join(tmpdir_path, name))
    got = R.merge_release(spark, [os.path.join(tmpdir_path, n) for n in "cab"]).collect()
    assert [(r.fetched_at, r[C.ANSWER_FIELD]) for r in got] == [("2024-03-01", '{"v":2}')]


def test_shards_of_others_name_their_answer(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "foreign")
    spark.createDataFrame([('{"row_index":3,"cid":4,"inchi":"x","inchikey":"k","reply":{"class":{"name":"n"}}}',)], "value STRING").write.text(out)
    assert [(r.row_index, r[C.ANSWER_FIELD]) for r in R.read_success_records(spark, out, answer_field="reply").collect()] == [(3, '{"class":{"name":"n"}}')]


def test_cut_release_publishes_the_manifest_last(spark, tmpdir_path):
    shards, out = os.path.join(tmpdir_path, "s"), os.path.join(tmpdir_path, "r1")
    states = spark.createDataFrame([(0, "success"), (3, "success"), (4, "miss")], "row_index BIGINT, state STRING")
    R.write_success_shards(_records(spark), shards, max_records=1)
    assert not R.cut_release(spark, shards, out, states.where("state = 'miss'"), 9)
    assert R.cut_release(spark, shards, out, states, 9, generated_at="2024-01-01T00:00:00Z")
    assert spark.read.parquet(out + "/dataset").count() == 2
    doc = R.read_summary(spark, out + "/progress-summary").first()
    assert doc[C.SUMMARY_TOTAL_FIELD] == 9 and doc.counts.miss_rows == 1
    assert R.read_manifest_counts(spark, out + "/manifest").first().success_rows == 2
    listed = [tuple(r) for r in R.read_manifest_files(spark, out).collect()]
    assert sorted(listed) == sorted((r.filename, r.bytes) for r in R.shard_files(spark, shards).collect()) and len(listed) == 2
    head = spark.read.json(out + "/manifest").first()
    assert (head.files, head.bytes, head.format, head.generated_at) == (2, sum(b for _, b in listed), "jsonl", "2024-01-01T00:00:00Z")


def test_releases_of_listed_shards(spark, tmpdir_path):
    shards, states = os.path.join(tmpdir_path, "z"), spark.createDataFrame([(0, "success"), (3, "success"), (4, "miss")], "row_index BIGINT, state STRING")
    for k, n in enumerate((2, 3)):  # a second cut, with a record of a row that is there and a new one
        R.write_success_shards(_records(spark, n).where(f"row_index >= {3 * k}").withColumn("fetched_at", F.lit(f"2024-0{k + 1}-01")), shards, max_records=1, fmt="jsonl.zst")
        out = os.path.join(tmpdir_path, f"r{k}")
        assert R.cut_release(spark, shards, out, states, 9, fmt="jsonl.zst")
        assert sorted(r.row_index for r in spark.read.parquet(out + "/dataset").collect()) == [0, 3, 6][:n]
        classes = R.read_summary(spark, out + "/progress-summary").first().taxonomy_layers[4].classes
        assert [(c.name, c.label_count) for c in classes] == [("Alkanes", n)]
        assert R.read_manifest_files(spark, out).count() == (2, 4)[k]


def test_summary_round_trip(spark, tmpdir_path):
    recs = _records(spark, 2)
    ranked = taxonomy.taxonomy_ranked(taxonomy.taxonomy_counts(
        taxonomy.taxonomy_nodes(taxonomy.taxonomy_long(recs))))
    counts = spark.createDataFrame([(5, 2, 1, 1, 1)], "total_rows BIGINT, success_rows BIGINT, "
                                   "miss_rows BIGINT, invalid_rows BIGINT, failed_rows BIGINT")
    doc = report.summary_document(spark, counts, ranked, generated_at="2026-01-01T00:00:00Z")
    path = os.path.join(tmpdir_path, "summary")
    R.write_json_document(doc, path)
    back = R.read_summary(spark, path).first()
    assert back[C.SUMMARY_TOTAL_FIELD] == 5 and back.counts.success_rows == 2
    assert [l.layer for l in back.taxonomy_layers] == [
        "kingdom", "superclass", "class", "subclass", "direct_parent"]
    dp = back.taxonomy_layers[4]
    assert dp.assigned_records == 2 and dp.classes[0].name == "Alkanes" and dp.classes[0].label_count == 2
    flat = R.flatten_summary(R.read_summary(spark, path))
    assert flat.count() == 5
    # no stored summary: recompute from dataset + manifest counts + given total
    rel = os.path.join(tmpdir_path, "release")
    os.makedirs(rel)
    again = R.summary_or_recompute(spark, rel, recs, counts.drop("total_rows"), 5).first()
    assert again.taxonomy_layers[4].classes[0].label_count == 2
    stored = R.summary_or_recompute(spark, tmpdir_path, None, None, None, summary_name="summary")
    assert stored.first()[C.SUMMARY_TOTAL_FIELD] == 5


def test_recompute_needs_a_total(spark, tmpdir_path):
    import pytest
    with pytest.raises(ValueError):
        R.summary_or_recompute(spark, tmpdir_path, _records(spark), None, None)
    counts = spark.createDataFrame([(1, 0, 0, 0)], "success_rows BIGINT, miss_rows BIGINT, "
                                   "invalid_rows BIGINT, failed_rows BIGINT")
    with pytest.raises(ValueError):
        R.summary_or_recompute(spark, tmpdir_path, _records(spark), counts, 0)
