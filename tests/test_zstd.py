"""zstd shards under limits on records and compressed bytes; split reading; bitmap files by byte range."""

import json
import os
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from labelsmith import config as C
from labelsmith.operators import bitmaps as B
from labelsmith.operators import release as R
from labelsmith.sources import lines as L
from labelsmith.sources import zstd as Z
from labelsmith.sources.files import data_files

SCHEMA = "row_index BIGINT, cid BIGINT, inchi STRING, inchikey STRING, fetched_at STRING, " + C.ANSWER_FIELD + " STRING"


def _records(spark, n, seed=1):
    rnd = random.Random(seed)
    return spark.createDataFrame([(7 * i, i, f"InChI={i}é", "K", "2024-01-01", json.dumps({"v": "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(400)))})) for i in range(n)],
                                 SCHEMA).repartition(5)


def _shards(path):
    out = []
    for name, size in data_files(path):
        with open(name, "rb") as f:
            text = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read().decode()
        out.append((os.path.basename(name), size, [json.loads(x)["row_index"] for x in text.splitlines()]))
    return out


def _listed(path):
    out = []
    for f in sorted(os.listdir(path + "/_shards")):
        out += [json.loads(x) for x in open(f"{path}/_shards/{f}")]
    return sorted(out, key=lambda r: r["filename"])


# ---- writing

@pytest.mark.parametrize("max_records,max_bytes,frame", [(13, 10 ** 9, 1 << 20), (10 ** 6, 3000, 1000), (9, 900, 300), (1, 10 ** 9, 50), (10 ** 6, 1, 600)])
def test_limits_are_kept_and_rows_read_back(spark, tmpdir_path, max_records, max_bytes, frame):
    recs, out = _records(spark, 200), tmpdir_path + "/z"
    lines = recs.select("row_index", R.record_line(recs).alias("value")).repartitionByRange(3, "row_index").sortWithinPartitions("row_index")
    Z.write_zstd_shards(lines, out, max_records, max_bytes, frame)
    shards = _shards(out)
    assert [s[0] for s in shards] == [f"success-{k + 1:06d}.jsonl.zst" for k in range(len(shards))]
    assert [r for s in shards for r in s[2]] == [7 * i for i in range(200)]
    assert all(len(rows) <= max_records and (size <= max_bytes or max_bytes < 300) for _, size, rows in shards)
    assert [(x["filename"], x["bytes"], x["records"], x["first_row"], x["last_row"]) for x in _listed(out)] == [(n, b, len(r), r[0], r[-1]) for n, b, r in shards]
    assert sorted(os.listdir(out)) == ["_shards", *[s[0] for s in shards]]
    back = R.read_success_records(spark, out, "jsonl.zst")
    assert sorted(map(tuple, back.select(*recs.columns).collect())) == sorted(map(tuple, recs.collect()))


def test_a_task_fills_its_shards(spark, tmpdir_path):
    """Within a task a file is left only when the next frame would pass a limit."""
    recs, out = _records(spark, 300), tmpdir_path + "/z"
    lines = recs.select("row_index", R.record_line(recs).alias("value")).repartitionByRange(1, "row_index").sortWithinPartitions("row_index")
    Z.write_zstd_shards(lines, out, 40, 10 ** 9, 500)
    assert [len(s[2]) for s in _shards(out)] == [40] * 7 + [20]


def test_later_writes_go_on_numbering(spark, tmpdir_path):
    out = tmpdir_path + "/z"
    for k in range(3):
        R.write_success_shards(_records(spark, 10).withColumn("row_index", F.col("row_index") + 1000 * k), out, max_records=1000, fmt="jsonl.zst")
    shards = _shards(out)
    assert [s[0] for s in shards] == [f"success-{k + 1:06d}.jsonl.zst" for k in range(len(shards))] and len(_listed(out)) == len(shards)
    assert [r for s in shards for r in s[2]] == [1000 * k + 7 * i for k in range(3) for i in range(10)]
    files = R.shard_files(spark, out)
    assert {r.filename: r.bytes for r in files.collect()} == {s[0]: s[1] for s in shards}


def test_a_failed_write_leaves_no_file(spark, tmpdir_path):
    out = tmpdir_path + "/z"
    lines = spark.range(0, 100, 1, 4).select(F.col("id").alias("row_index"), F.when(F.col("id") == 90, F.raise_error(F.lit("stop"))).otherwise(F.lit("{}")).alias("value"))
    with pytest.raises(Exception, match="stop"):
        Z.write_zstd_shards(lines, out, 5, 100, 10)
    assert data_files(out) == [] and not [x for x in os.listdir(out) if not x.startswith(".")]
    R.write_success_shards(_records(spark, 0), out, fmt="jsonl.zst")
    assert data_files(out) == []
    with pytest.raises(ValueError):
        Z.write_zstd_shards(lines, out, 0, 1)


# ---- reading

def _pack(parts, rnd, level=1):
    out = b""
    for p in parts:
        if rnd.random() < 0.2:
            out += bytes([0x50 + rnd.randrange(16)]) + Z.SKIPPABLE + (5).to_bytes(4, "little") + b"skip\n"
        out += zstandard.ZstdCompressor(level=level, write_checksum=rnd.random() < 0.5, write_content_size=rnd.random() < 0.5).compress(p)
    return out


def _split_read(data, width):
    read = lambda at, n: data[at:at + n]
    out = []
    for begin in range(0, len(data), width):
        for lines in Z.lines_of(Z.range_text(read, begin, min(begin + width, len(data)), len(data))):
            out += lines
    return out


@pytest.mark.parametrize("seed", range(12))
def test_every_line_once_whatever_the_ranges(seed, monkeypatch):
    rnd = random.Random(seed)
    monkeypatch.setattr(Z, "STEP", rnd.choice([7, 64, 1 << 20]))
    alphabet = [b"a", b"b\xc3\xa9", b"\n", b"\n\n", b"line ", Z.MAGIC, Z.MAGIC + b"\x00x", rnd.randbytes(40).replace(b"\n", b"")]
    for _ in range(6):
        text = b"".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 120)))
        cuts = sorted(rnd.sample(range(len(text) + 1), min(len(text), rnd.randrange(1, 9))))
        data = _pack([text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])], rnd)
        want = text.split(b"\n")[:-1] if text.endswith(b"\n") else text.split(b"\n")
        for width in (1, 3, 10, 33, 100, len(data) // 2 + 1, len(data)):
            assert _split_read(data, width) == want


def test_large_blocks_and_repeated_bytes():
    rnd = random.Random(4)
    text = b"\n".join([rnd.randbytes(300_000).replace(b"\n", b" "), b"x" * 400_000, b"end"])
    data = _pack([text[:150_000], text[150_000:500_000], text[500_000:]], rnd)
    for width in (1000, 77_777, 200_000):
        assert _split_read(data, width) == text.split(b"\n")
    assert Z.frame_end(lambda at, n: data[at:at + n], 1, len(data)) is None
    with pytest.raises(ValueError):
        list(Z.range_text(lambda at, n: b"plain text, no frame"[at:at + n], 0, 20, 20))


def test_split_file_is_many_tasks_with_the_same_numbers(spark, tmpdir_path):
    rnd = random.Random(2)
    lines = [f"{i}\t{'x' * rnd.randrange(50)}\té" for i in range(3000)]
    text = ("\n".join(lines) + "\n").encode()
    with open(tmpdir_path + "/b.tsv.zst", "wb") as f:
        f.write(_pack([text[k:k + 4001] for k in range(0, len(text), 4001)], rnd))
    open(tmpdir_path + "/a.tsv.zst", "wb").close()
    with open(tmpdir_path + "/c.tsv", "w") as f:
        f.write("plain\nlast")
    scan = Z.read_zstd_lines(spark, tmpdir_path + "/b.tsv.zst", 2000)
    assert scan.rdd.getNumPartitions() > 5 and scan.select("split_start").distinct().count() > 5
    assert sorted(r.line for r in scan.collect()) == sorted(lines)
    got = L.number_lines(spark, tmpdir_path).orderBy("row_index").collect()
    assert [r.line for r in got] == [*lines, "plain", "last"] and [r.row_index for r in got] == list(range(3002))
    assert L.number_lines(spark, tmpdir_path + "/b.tsv.zst").count() == 3000


# ---- bitmap files

def test_bitmap_files_by_range(spark, tmpdir_path):
    rows = random.Random(3).sample(range(5_000_000), 3000)
    for state, at in (("success", 0), ("failed", 1)):
        data = bytearray(625_000)
        for r in rows[at::2]:
            data[r >> 3] |= 1 << (r & 7)
        with open(f"{tmpdir_path}/state.{state}.bits", "wb") as f:
            f.write(data.rstrip(b"\0"))
    open(tmpdir_path + "/state.miss.bits", "wb").close()
    open(tmpdir_path + "/state.other.bits", "wb").write(b"\1")
    for width in (1, 50_000, 64 << 20):
        read = B.read_bitmap_files(spark, tmpdir_path, width)
        assert {(r.row_index, r.state) for r in B.bitmap_rows(read).collect()} == {(r, ("success", "failed")[k % 2]) for k, r in enumerate(rows)}
    assert B.read_bitmap_files(spark, tmpdir_path, 50_000).rdd.getNumPartitions() >= 24
    assert B.read_bitmap_files(spark, tmpdir_path + "/none").collect() == []


def test_bitmap_file_beyond_two_gibibytes(spark, tmpdir_path):
    far = (3 << 30) * 8 + 5
    with open(tmpdir_path + "/state.success.bits", "wb") as f:  # sparse
        f.seek(far >> 3)
        f.write(bytes([1 << (far & 7)]))
        f.seek(123)
        f.write(b"\x01")
    got = B.bitmap_rows(B.read_bitmap_files(spark, tmpdir_path, 256 << 20)).collect()
    assert sorted((r.row_index, r.state) for r in got) == [(123 * 8, "success"), (far, "success")]
