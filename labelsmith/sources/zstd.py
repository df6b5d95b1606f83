"""zstd text in both directions: shards under a limit on compressed bytes, and reading by byte range.

Writing (H2): each task turns its rows, a run of row numbers, into files of independent zstd frames,
measures what it has written, and begins a new file before a limit would be passed. Files lie in a folder of
the write until the driver's commit gives them their numbers in row order, so a failed or repeated
task leaves nothing behind.

Reading (A1): a file of many frames is cut into byte ranges. A task looks for the first frame that
begins in its range (the magic number, confirmed by walking the frame's block headers to another frame or the
file's end, and by decoding its first bytes; only a text that holds a whole frame as it stands could pass for one), decodes the frames that begin there, leaves the line that began before to the range before, and
reads on over its end to finish its own last line.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .files import data_files, opened, ranges, uri

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: First bytes of a frame and of a skippable frame (its first byte from 0x50 to 0x5f).
MAGIC, SKIPPABLE = b"\x28\xb5\x2f\xfd", b"\x2a\x4d\x18"
#: Most bytes of lines in a frame, bytes of a range, lines of a batch, and bytes read at a time.
FRAME, RANGE, LINES, STEP = 1 << 20, 64 << 20, 20_000, 1 << 20
LEVEL = 3
NAME = "success-{:06d}.jsonl.zst"


# ---- writing


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: (path, records, bytes, first row, last row), in row order."""

    files: list[tuple[str, int, int, int, int]]


class ShardFile:
    """A file that takes frames, and what it holds."""

    def __init__(self, store, path: str):
        self.path, self.out = path, store.open_output_stream(path, compression=None)
        self.records, self.bytes, self.first, self.last = 0, 0, None, None

    def add(self, frame: bytes, rows: list[int]) -> None:
        self.out.write(frame)
        self.records, self.bytes, self.last = self.records + len(rows), self.bytes + len(frame), rows[-1]
        self.first = rows[0] if self.first is None else self.first

    def close(self) -> tuple:
        self.out.close()
        return self.path, self.records, self.bytes, self.first, self.last


class ZstdShardWriter(DataSourceArrowWriter):
    """Writes ``row_index, value`` (sorted by ``row_index`` within a task, tasks in order) as shards."""

    def __init__(self, options: dict):
        self.path, self.max_records, self.max_bytes = options["path"].rstrip("/"), int(options["max_records"]), int(options["max_bytes"])
        self.frame, self.job = int(options.get("frame", FRAME)), f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import zstandard

        store, root = opened(self.path)
        context = TaskContext.get()
        folder = f"{root}/{self.job}/{context.partitionId()}-{context.taskAttemptId()}"
        store.create_dir(folder, recursive=True)
        compressor, done, rows, lines, size = zstandard.ZstdCompressor(level=LEVEL), [], [], [], 0
        shard: ShardFile | None = None

        def put() -> None:
            nonlocal shard, size
            if not rows:
                return
            frame = compressor.compress(b"\n".join(lines) + b"\n")
            if shard and (shard.records + len(rows) > self.max_records or shard.bytes + len(frame) > self.max_bytes):
                done.append(shard.close())
                shard = None
            shard = shard or ShardFile(store, f"{folder}/{len(done):06d}")
            shard.add(frame, rows)
            rows.clear(), lines.clear()
            size = 0

        for batch in iterator:
            for row, line in zip(batch.column("row_index").to_pylist(), batch.column("value").cast(pa.binary()).to_pylist()):
                rows.append(row)
                lines.append(line)
                size += len(line) + 1
                open_records = shard.records if shard and shard.records < self.max_records else 0
                if size >= self.frame or open_records + len(rows) >= self.max_records:
                    put()
        put()
        if shard:
            done.append(shard.close())
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        """Numbers the files in row order behind those that are there, and lists them in ``_shards``."""
        store, root = opened(self.path)
        there = [int(p.rsplit("-", 1)[1].split(".")[0]) for p, _ in data_files(self.path) if "/success-" in p]
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f[3])
        listed = []
        for no, (path, records, size, first, last) in enumerate(files, max(there, default=0) + 1):
            store.move(path, f"{root}/{NAME.format(no)}")
            listed.append({"filename": NAME.format(no), "bytes": size, "records": records, "first_row": first, "last_row": last})
        if listed:
            store.create_dir(f"{root}/_shards", recursive=True)
            with store.open_output_stream(f"{root}/_shards/{self.job[1:]}.json", compression=None) as out:
                out.write("".join(json.dumps(x) + "\n" for x in listed).encode())
        self._clear(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*opened(self.path))

    def _clear(self, store, root: str) -> None:
        store.delete_dir_contents(f"{root}/{self.job}", missing_dir_ok=True)
        if store.get_file_info(f"{root}/{self.job}").type.name == "Directory":
            store.delete_dir(f"{root}/{self.job}")


def write_zstd_shards(lines: DataFrame, out: str, max_records: int, max_bytes: int, frame: int = FRAME) -> None:
    """``row_index, value`` as ``success-NNNNNN.jsonl.zst`` of at most ``max_records`` lines and ``max_bytes`` bytes.

    A frame of more than ``max_bytes`` has a file of its own. A task's first file begins anew, so there are at most as
    many part-filled files as tasks. ``_shards`` below ``out`` lists name, bytes, records and row range.
    """
    if max_records <= 0 or max_bytes <= 0:
        raise ValueError("shard limits must be positive")
    spark = lines.sparkSession
    spark.dataSource.register(ZstdShards)
    (lines.select("row_index", "value").write.format("labelsmith_zstd_shards").mode("append")
     .option("path", out).option("max_records", str(max_records)).option("max_bytes", str(max_bytes)).option("frame", str(frame)).save())


class ZstdShards(DataSource):
    @classmethod
    def name(cls) -> str:
        return "labelsmith_zstd_shards"

    def schema(self) -> str:
        return "row_index long, value string"

    def writer(self, schema, overwrite: bool) -> ZstdShardWriter:
        return ZstdShardWriter(dict(self.options))


# ---- reading


def frame_end(read, at: int, size: int) -> int | None:
    """Where the frame at ``at`` ends, by its headers alone; None if no whole frame begins there."""
    head = read(at, 18)
    if len(head) >= 8 and 0x50 <= head[0] <= 0x5F and head[1:4] == SKIPPABLE:
        end = at + 8 + int.from_bytes(head[4:8], "little")
        return end if end <= size else None
    if len(head) < 6 or head[:4] != MAGIC:
        return None
    flags = head[4]
    if flags & 8:  # a reserved bit
        return None
    single, content = flags >> 5 & 1, flags >> 6
    at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[content]
    while True:
        block = read(at, 3)
        if len(block) < 3:
            return None
        word = int.from_bytes(block, "little")
        kind, n = word >> 1 & 3, word >> 3
        if kind == 3 or n > 1 << 17 and kind != 1:
            return None
        at += 3 + (1 if kind == 1 else n)
        if word & 1:
            at += 4 * (flags >> 2 & 1)
            return at if at <= size else None


def _decodes(read, at: int, behind: int) -> bool:
    """Whether the frame's first ``STEP`` bytes decode."""
    import zstandard

    if read(at, 4) != MAGIC:
        return True
    try:
        zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj().decompress(read(at, min(STEP, behind - at)))
    except zstandard.ZstdError:
        return False
    return True


def first_frame(read, begin: int, end: int, size: int) -> int | None:
    """The first frame that begins in ``begin..end``: its magic number, and a frame or the file's end behind it."""
    at = begin
    while at < end:
        chunk = read(at, min(STEP, end - at) + 3)
        found = min((k for k in (chunk.find(MAGIC), chunk.find(SKIPPABLE) - 1 if chunk.find(SKIPPABLE) > 0 else -1) if k >= 0), default=-1)
        if found < 0:
            at += max(1, len(chunk) - 3)
            continue
        at += found
        if at >= end:
            return None
        behind = frame_end(read, at, size)
        if behind is not None and (behind == size or frame_end(read, behind, size) is not None) and _decodes(read, at, behind):
            return at
        at += 1
    return None


def range_text(read, begin: int, end: int, size: int) -> Iterator[bytes]:
    """Decoded bytes of the whole lines that belong to a range: those that begin in its frames, but for a
    line that began before. Pieces come as they are decoded, in order."""
    import zstandard

    at = 0 if begin == 0 else first_frame(read, begin, end, size)
    if at is None:
        return
    skip = at > 0  # up to the first line end belongs to the range before
    while at < size:
        over = at >= end  # the range's own frames are done: only the rest of its last line
        if over and skip:
            return
        behind = frame_end(read, at, size)
        if behind is None:
            raise ValueError(f"not a zstd frame at byte {at}")
        if read(at, 4) == MAGIC:
            decoder, place = zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj(), at
            while place < behind:
                piece = decoder.decompress(read(place, min(STEP, behind - place)))
                place += min(STEP, behind - place)
                cut = piece.find(b"\n") if skip or over else -1
                if skip:
                    if cut < 0:
                        continue
                    piece, skip = piece[cut + 1:], False
                elif over and cut >= 0:
                    yield piece[:cut + 1]
                    return
                if piece:
                    yield piece
        at = behind


def lines_of(pieces: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Lines without their end, some at a time; a last line without one counts."""
    rest: list[bytes] = []
    for piece in pieces:
        head, mark, tail = piece.rpartition(b"\n")
        if not mark:
            rest.append(piece)
            continue
        yield b"".join([*rest, head]).split(b"\n")
        rest = [tail] if tail else []
    if rest:
        yield [b"".join(rest)]


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int
    size: int


class ZstdLinesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.width = options["path"], int(options.get("width", RANGE))

    def partitions(self) -> list[Range]:
        return [Range(*r) for r in ranges([f for f in data_files(self.path) if f[0].endswith(".zst")], self.width)] or [Range("", 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.size:
            return
        name = uri(self.path, partition.path)
        store, path = opened(name)
        with store.open_input_file(path) as f:
            read = lambda at, n: f.read_at(max(0, min(n, partition.size - at)), at) if at < partition.size else b""
            for lines in lines_of(range_text(read, partition.begin, partition.end, partition.size)):
                for k in range(0, len(lines), LINES):
                    some = [x.decode("utf-8", "replace") for x in lines[k:k + LINES]]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array([partition.begin] * len(some), pa.int64()), pa.array(some)],
                                                     ["file", "split_start", "line"])


class ZstdLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "labelsmith_zstd_lines"

    def schema(self) -> str:
        return "file string, split_start long, line string"

    def reader(self, schema) -> ZstdLinesReader:
        return ZstdLinesReader(dict(self.options))


def read_zstd_lines(spark: SparkSession, path: str, width: int = RANGE) -> DataFrame:
    """``file, split_start, line`` of the zstd text file(s) at ``path``, by ranges of ``width`` compressed bytes.

    A frame is decoded by one task, so a file of one frame is one task whatever its size.
    """
    spark.dataSource.register(ZstdLines)
    return spark.read.format("labelsmith_zstd_lines").option("path", path).option("width", str(width)).load()
