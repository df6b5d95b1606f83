"""Packing token sequences by shortest-pack-first over the length histogram (operator 7)."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, landed

MAX_LEN = 1024
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
#: A space between two other characters always begins a new pre-token of the byte-level pattern.
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
BLOCK = 1 << 18


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Byte-level BPE with the ids of ``byte_bpe_50k.json``; texts are encoded block by block.

    The same vocabulary as ranks, through the library that encodes it six times faster; the special
    token's string is one id wherever it stands, as there.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path) as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.core = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def blocks(self, text: str) -> Iterator[np.ndarray]:
        parts = text.split(SPECIAL)
        for k, part in enumerate(parts):
            at = 0
            while at < len(part):
                cut = SAFE_CUT.search(part, at + BLOCK) if len(part) > at + BLOCK else None
                end = cut.start() if cut else len(part)
                yield np.array(self.core.encode_ordinary(part[at:end]), "<u4")
                at = end
            if k < len(parts) - 1:
                yield np.array([SPECIAL_ID], "<u4")


def cut_pieces(blocks: Iterator[np.ndarray], max_len: int, end_id: int = 0) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of ids, closing one included, and pieces ``(start, length, crc32)``: full ones, then the rest."""
    pieces, rest, start = [], np.zeros(0, "<u4"), 0

    def cut(ids: np.ndarray, last: bool) -> np.ndarray:
        nonlocal start
        at = 0
        while len(ids) - at >= max_len or last and at < len(ids):
            piece = ids[at:at + max_len]
            pieces.append((start, len(piece), zlib.crc32(piece.tobytes())))
            start += len(piece)
            at += len(piece)
        return ids[at:]

    for block in blocks:
        rest = cut(np.concatenate([rest, block]), False)
    cut(np.concatenate([rest, np.array([end_id], "<u4")]), True)
    return start, pieces


def pieces_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
              vocabulary: str | None = None) -> DataFrame:
    """``id, start, length, crc, doc_tokens``: each document's ids and the closing id 0, cut at ``max_len``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary or vocabulary_path())
        for batch in batches:
            rows, take = [], []
            for k, text in enumerate(batch.column("text")):
                n, pieces = cut_pieces(encoder.blocks(text.as_py() or ""), max_len)
                rows += [(*p, n) for p in pieces]
                take += [k] * len(pieces)
            cols = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(take, pa.int64())), *map(pa.array, np.ascontiguousarray(cols))],
                                             ["id", "start", "length", "crc", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, start long, length long, crc long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, list[int]]]:
    """``(count, lengths)`` of each packing pattern; all lengths of the histogram are placed.

    From the longest length down, each is added to the pattern that is filled least among those with
    room. A pattern of more packs than there are sequences left is split in two. The number of
    patterns depends on ``max_len`` alone, whatever the counts.
    """
    open_: dict[int, list[tuple[int, list[int]]]] = {}
    done: list[tuple[int, list[int]]] = []
    put = lambda room, count, pattern: (open_.setdefault(room, []) if room else done).append((count, pattern))
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(open_, default=0)
            if room < length:
                put(max_len - length, left, [length])
                left = 0
                continue
            count, pattern = open_[room].pop()
            n = min(count, left)
            if count > n:
                open_[room].append((count - n, pattern))
            if not open_[room]:
                del open_[room]
            put(room - length, n, [*pattern, length])
            left -= n
    return done + [x for xs in open_.values() for x in xs]


def slots(patterns: list[tuple[int, list[int]]]) -> np.ndarray:
    """``(length, first rank, first sequence, offset)`` rows, by length and rank.

    Sequences are numbered pattern by pattern; within a length, ranks go to the patterns in turn.
    """
    rows, used, sequence = [], {}, 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + count
            offset += length
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
         vocabulary: str | None = None, buckets: int = 1024) -> DataFrame:
    """``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece.

    A document's ids, then id 0, are cut into pieces of ``max_len`` and a rest. The histogram of piece
    lengths (at most ``max_len`` rows) goes to the driver, which packs lengths, not pieces. Pieces get
    a rank within their length: a number within a hash bucket of documents plus the counts of the
    buckets before it, so that one length held by a third of all pieces is ranked in ``buckets`` parts.
    Rank and length then find pattern, sequence and offset in the table of slots, whose size depends
    on ``max_len`` alone.

    Null and empty texts are the closing id only. Repeated rows and null ids are packed like any
    other; an empty table gives an empty result; other columns are not read.
    """
    pieces = landed(pieces_of(docs, id_col, text_col, max_len, vocabulary), "pieces")
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "doc_tokens"), F.lit(buckets)))
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(shortest_pack_first(histogram, max_len))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (table[:, 0] << 48) | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            slot = table[np.searchsorted(keys, (length << 48) | rank, side="right") - 1] if len(table) else np.zeros((0, 4), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "start", "length", "crc", "doc_tokens")),
                 pa.array(slot[:, 2] + rank - slot[:, 1]), pa.array(slot[:, 3])],
                ["id", "start", "length", "crc", "doc_tokens", "sequence_id", "offset"])

    order = Window.partitionBy("length", "bucket").orderBy("id", "start", "doc_tokens", "crc")
    ranked = (pieces.withColumn("place", F.row_number().over(order) - 1).join(bases, ["length", "bucket"])
              .select("id", "start", "length", "crc", "doc_tokens", (F.col("base") + F.col("place")).alias("rank")))
    kind = docs.schema[id_col].dataType.simpleString()
    out = ranked.mapInArrow(run, f"id {kind}, start long, length long, crc long, doc_tokens long, sequence_id long, offset long")
    return out.select(F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
