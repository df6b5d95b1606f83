"""State bitmaps.

Layout: bit ``r % 8`` (least significant first) of byte ``r / 8`` marks row ``r``. Spark's bitmap
functions use exactly that layout in 4 KiB buckets of 32,768 rows, so a state's bitmap is stored
as rows ``(state, bucket_no, bitmap BINARY)``; concatenating a state's buckets in order gives the
single-file layout, and a single file cut into 4 KiB chunks gives the buckets back.

Scale: building bitmaps is a partial aggregate keyed by (state, bucket); a bucket holds at most
32,768 rows, so no key can be hot. Membership joins a probe row to one row per bucket, which holds
the bucket's four 4 KiB bitmaps.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import config as C
from ..sources.files import data_files, opened, ranges, uri

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

BUCKET = C.BITMAP_BUCKET_BITS
BUCKET_BYTES = BUCKET // 8
#: Bytes of a bitmap file that a task reads, and that it reads at a time.
RANGE, STEP = 64 << 20, 4 << 20


def bitmap_encode(states: DataFrame) -> DataFrame:
    """``(state, bucket_no, bitmap)`` with ``bucket_no = row_index div 32768``."""
    r1 = F.col("row_index") + 1
    return (states.groupBy("state", (F.bitmap_bucket_number(r1) - 1).alias("bucket_no"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(r1)).alias("bitmap")))


def bitmap_popcount(spark: SparkSession, bitmaps: DataFrame) -> DataFrame:
    """Set bits per state; all four states appear (0 when a state has no bitmap)."""
    dim = spark.createDataFrame([(s,) for s in C.STATES], "state STRING")
    per = bitmaps.groupBy("state").agg(F.sum(F.bitmap_count("bitmap")).cast("long").alias("set_bits"))
    return dim.join(per, "state", "left").select(
        "state", F.coalesce("set_bits", F.lit(0).cast("long")).alias("set_bits"))


def _byte_at(bitmap: F.Column, byte_index: F.Column) -> F.Column:
    """Unsigned value of one byte of a binary column (NULL past its end)."""
    one = bitmap.substr(byte_index + 1, F.lit(1))
    return F.when(F.octet_length(one) == 1, F.conv(F.hex(one), 16, 10).cast("int"))


def bitmap_membership(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(row_index, state)`` for every probe row whose bit is set in a state's bitmap.

    The bitmaps of a bucket (one per state) are put into one row first, so a probe row meets one row.
    """
    wide = bitmaps.groupBy("bucket_no").agg(
        F.map_from_entries(F.collect_list(F.struct("state", "bitmap"))).alias("maps"))
    probe = rows.select("row_index", F.expr(f"row_index div {BUCKET}").alias("bucket_no"),
                        (F.col("row_index") % BUCKET).cast("int").alias("bit_no"))
    byte_no, bit = F.expr("bit_no div 8"), F.expr("bit_no % 8")
    is_set = lambda state: F.coalesce(
        F.call_function("getbit", _byte_at(F.try_element_at("maps", state), byte_no).cast("long"), bit) == 1, F.lit(False))
    found = F.filter(F.array(*[F.lit(x) for x in C.STATES]), is_set)
    return probe.join(wide, "bucket_no").select("row_index", F.explode(found).alias("state"))


def bitmap_merge(bitmaps: DataFrame) -> DataFrame:
    """Per bucket: rows handled (union of states) and bits set in more than one state."""
    agg = bitmaps.groupBy("bucket_no").agg(
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("handled_bits"),
        F.sum(F.bitmap_count("bitmap")).cast("long").alias("all_bits"))
    return agg.select("bucket_no", "handled_bits",
                      (F.col("all_bits") - F.col("handled_bits")).alias("overlap_bits"))


def bitmap_rows(bitmaps: DataFrame) -> DataFrame:
    """Explode bitmaps back into ``(row_index, state)``: bytes, then set bits of non-zero bytes."""
    hx = F.hex("bitmap")
    by = bitmaps.select("state", "bucket_no", hx.alias("hx"),
                        F.explode(F.sequence(F.lit(0), F.octet_length("bitmap") - 1)).alias("byte_no"))
    by = by.withColumn("v", F.conv(F.col("hx").substr(F.col("byte_no") * 2 + 1, F.lit(2)), 16, 10)
                       .cast("int")).where(F.col("v") != 0)
    bits = by.select("state", "bucket_no", "byte_no", "v",
                     F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
    bits = bits.where(F.expr("(v >> bit) & 1 = 1"))
    return bits.select(
        (F.col("bucket_no") * BUCKET + F.col("byte_no") * 8 + F.col("bit")).cast("long")
        .alias("row_index"), "state")


STATE_FILES = {f"state.{s}.bits": s for s in C.STATES}


def read_bitmap_files(spark: SparkSession, directory: str, width: int = RANGE) -> DataFrame:
    """Single-file bitmaps (``state.<state>.bits``) -> ``(state, bucket_no, bitmap)`` buckets.

    Each file is read in ranges of ``width`` bytes, a task each, whatever its size; 4 KiB chunks without a
    bit are left out, as ``bitmap_encode`` has none either. A missing file simply contributes nothing.
    """
    spark.dataSource.register(BitmapFiles)
    return spark.read.format("labelsmith_bitmap_files").option("path", directory).option("width", str(width)).load()


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int
    size: int


class BitmapReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.width = options["path"], int(options.get("width", RANGE)) // BUCKET_BYTES * BUCKET_BYTES or BUCKET_BYTES

    def partitions(self) -> list[Range]:
        files = [f for f in data_files(self.path) if f[0].rsplit("/", 1)[-1] in STATE_FILES]
        return [Range(*r) for r in ranges(files, self.width)] or [Range("", 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.size:
            return
        store, path = opened(uri(self.path, partition.path))
        state = STATE_FILES[path.rsplit("/", 1)[-1]]
        with store.open_input_file(path) as f:
            for at in range(partition.begin, partition.end, STEP):
                data = f.read_at(min(STEP, partition.end - at), at)
                whole = np.frombuffer(data.ljust(-(-len(data) // BUCKET_BYTES) * BUCKET_BYTES, b"\0"), np.uint8).reshape(-1, BUCKET_BYTES)
                set_ = np.flatnonzero(whole.any(axis=1)).tolist()
                if set_:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([state] * len(set_)), pa.array([at // BUCKET_BYTES + k for k in set_], pa.int64()),
                         pa.array([data[k * BUCKET_BYTES:(k + 1) * BUCKET_BYTES] for k in set_], pa.binary())], ["state", "bucket_no", "bitmap"])


class BitmapFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "labelsmith_bitmap_files"

    def schema(self) -> str:
        return "state string, bucket_no long, bitmap binary"

    def reader(self, schema) -> BitmapReader:
        return BitmapReader(dict(self.options))
