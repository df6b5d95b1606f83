"""SimHash near-duplicates by multi-index hashing (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keyed, landed
from .components import components

BITS = 64


def word_blocks(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in blocks of about ``size`` bytes, cut only at ASCII white space."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[at:end]
        at = end


def fingerprint(data: bytes, shingle: int = 3, seed: int = 42, block: int = 1 << 20) -> int:
    """64-bit SimHash of a UTF-8 text: bit set if set in over half the shingles' XXH64 (repeats count).

    Words are runs without ASCII white space, A-Z lower-cased (``bytes.lower`` and ``bytes.split``
    treat exactly these). Fewer words than a shingle: the whole sequence is one; none: zero. Long
    texts are taken in blocks, so only a block's words are in memory at once.
    """
    counts, n, words = np.zeros(BITS, np.int64), 0, []
    hash64 = xxhash.xxh64_intdigest
    for part in word_blocks(data, block):
        words += part.lower().split()
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [hash64(joined[s:e], seed) for s, e in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
        words = words[len(words) - shingle + 1:]
    if not n:
        return hash64(b" ".join(words), seed) if words else 0
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(id, fp)`` per row; fp: the fingerprint as a signed long. Null texts have no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py() or b"", shingle, seed) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _segments(n: int) -> list[tuple[int, int]]:
    """(first bit, width) of each of ``n`` segments."""
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _segment(fp: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))


def _flips(value: Column, width: int, unset_only: bool) -> Column:
    """The Hamming ball of radius 1 without its centre; optionally only the bits not yet set."""
    bits = F.array(*[F.lit(1 << i) for i in range(width)])
    if unset_only:
        bits = F.filter(bits, lambda bit: value.bitwiseAND(bit) == 0)
    return F.transform(bits, lambda bit: value.bitwiseXOR(bit))


def _dealt(df: DataFrame) -> DataFrame:
    """``df``, to be dealt by key in the join that follows, never broadcast.

    Spark sizes an exploded table by its rows before (a fingerprint has some 66 probes), and a stored one by its
    compressed files, so it may take either for small enough to be gathered by the driver.
    """
    return df.hint("merge")


def links(fps: DataFrame, max_bits: int = 2, crowded: int = 16) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that join all pairs within ``max_bits``.

    Multi-index hashing: the fingerprint is cut into segments, so many that fingerprints within
    ``max_bits`` differ in at most one bit of some segment. A table per segment holds fingerprints
    by the segment's value; a probe looks up its own value and the ball of radius 1 around it (of a
    pair that differs in one bit of a segment, the side without that bit looks up the other, so one
    direction is enough), and whole distances are verified.

    An entry with over ``crowded`` fingerprints would yield the square of its size in candidates.
    For up to two bits such entries are indexed once more by the ball around the remaining bits:
    two fingerprints within two bits share a point that is at most one bit from either, so an entry
    of this second index has at most 65 members, all linked to its least one (for one bit: to that point). Every link is
    verified; pairs of a crowded entry may be joined over a third member instead of directly, so
    the components are those of all pairs. Above two bits crowded entries are paired directly.
    """
    if not 0 <= max_bits < BITS:
        raise ValueError("max_bits must be from 0 to 63")
    fps = fps.select("fp").where("fp is not null").distinct()
    segments = _segments(max(2, max_bits // 2 + 1))
    of = lambda s, key, own: F.struct(F.lit(s).alias("seg"), key.alias("key"), F.lit(own).alias("own"))
    fp = F.col("fp")
    table = fps.select("fp", F.inline(F.array(*[of(s, _segment(fp, *cut), True) for s, cut in enumerate(segments)])))
    around = lambda s, cut: F.transform(_flips(_segment(fp, *cut), cut[1], True), lambda key: of(s, key, False))
    balls = F.flatten(F.array(*[around(s, cut) for s, cut in enumerate(segments)]))
    probes = table.union(fps.select("fp", F.inline(balls)))
    sizes = table.groupBy("seg", "key").agg(F.count("*").alias("size"))
    full = sizes.where(F.col("size") > crowded) if max_bits <= 2 else sizes.limit(0)
    few = (sizes.where(F.col("size") <= crowded) if max_bits <= 2 else sizes).drop("size")
    entries = _dealt(table).join(few, ["seg", "key"]).select("seg", "key", F.col("fp").alias("b"))
    pairs = (_dealt(probes.select("seg", "key", "own", F.col("fp").alias("a"))).join(entries, ["seg", "key"])
             .where((~F.col("own") | (F.col("a") < F.col("b"))) & (_distance(F.col("a"), F.col("b")) <= max_bits)).select("a", "b"))
    if max_bits > 2:
        return pairs
    if not max_bits:
        return pairs.limit(0)
    outside = [[_signed(1 << i) for i in range(BITS) if not first <= i < first + width] for first, width in segments]
    near = F.coalesce(*[F.when(F.col("seg") == s, F.transform(F.array(*map(F.lit, masks)), lambda bit: fp.bitwiseXOR(bit)))
                        for s, masks in enumerate(outside)])
    moved = F.coalesce(*[F.when(F.col("seg") == s, fp.bitwiseXOR(F.shiftleft(_segment(fp, *cut).bitwiseXOR(F.col("key")), cut[0])))
                         for s, cut in enumerate(segments)])
    points = F.when(F.col("own"), F.concat(F.array(fp), near)).otherwise(F.array(moved))
    second = _dealt(probes).join(full.drop("size"), ["seg", "key"]).select("seg", "fp", F.explode(points).alias("point"))
    center = F.array_min("fps") if max_bits == 2 else F.col("point")  # at one bit, links lead to the point itself
    stars = (second.groupBy("seg", "point").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
             .where(F.array_contains("fps", center)).select(center.alias("a"), F.explode("fps").alias("b"))
             .where((F.col("a") != F.col("b")) & (_distance(F.col("a"), F.col("b")) <= max_bits)))
    return pairs.union(stars)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42,
                   max_bits: int = 2) -> DataFrame:
    """``id_col, fingerprint, component_id`` per row: the least id reachable over links of ``max_bits``.

    Equal texts share a fingerprint, so only distinct fingerprints are linked and components are
    found among these. Null and empty texts have fingerprint zero and are linked like any other.
    Null ids never become a component's id unless it has no other (then null). Repeated rows are
    returned as often as they come; an empty table gives an empty result; other columns are not read.
    """
    prints = landed(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    least = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(prints, max_bits)).withColumnRenamed("node", "fp")
    rooted = least.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.join(of_root, "root").select("fp", "component_id")
    return _dealt(prints).join(of_fp, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_least(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **args) -> DataFrame:
    """One row of each group of near copies, with its columns unchanged.

    The row with the least id stays; null ids come behind all others, and rows that share an id are ordered
    by a hash of their text, then as written. Rows are told apart by a key that is written with them, so a row goes
    only for its own group. Null and empty texts are one group; an empty table gives an empty result;
    a text of any length is fingerprinted whole.
    """
    rows, row = keyed(docs, "near-rows")
    own = F.struct(F.col(id_col).isNull().alias("absent"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(row).alias("row"))
    groups = simhash_groups(rows.select(own.alias("own"), F.col(text_col)), "own", text_col, **args)
    gone = groups.where("own <> component_id").select(F.col("own.row").alias(row))
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir))
