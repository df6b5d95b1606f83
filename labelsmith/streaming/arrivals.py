"""First arrivals of whole-number keys, as bitmaps in the state store.

One bit per key that came: a bucket of 32,768 keys in a row is one value of 4 KiB, in the layout of
``operators.bitmaps``. A trigger reads and writes the buckets of its own rows and nothing of the past,
so its cost doesn't grow with what was done before.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import config as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

BITS = C.BITMAP_BUCKET_BITS
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstArrivals(StatefulProcessor):
    """Of the rows of a bucket, those whose key has not come before, each key once."""

    def __init__(self, key: str, columns: list[str]):
        self.key, self.columns = key, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bits = handle.getValueState("bits", "bits binary")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.bits.update((bytes(initialState["bitmap"].iloc[0]).ljust(BITS // 8, b"\0"),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = np.frombuffer(self.bits.get()[0], np.uint8).copy() if self.bits.exists() else np.zeros(BITS // 8, np.uint8)
        for some in rows:
            some = some.drop_duplicates(self.key)
            place = (some[self.key] % BITS).to_numpy(np.int64)
            mask = (1 << (place & 7)).astype(np.uint8)
            new = (seen[place >> 3] & mask) == 0
            np.bitwise_or.at(seen, place[new] >> 3, mask[new])
            yield some.loc[new, self.columns]
        self.bits.update((seen.tobytes(),))

    def close(self) -> None:
        pass


def first_arrivals(stream: DataFrame, key: str, done: DataFrame | None = None) -> DataFrame:
    """The rows of ``stream`` whose ``key`` (a whole number, not negative or null) comes for the first time.

    ``done``: bitmaps ``(bucket_no, bitmap)`` of keys that count as having come, read when the stream
    begins. Of rows that share a key in one trigger any one is taken.
    """
    bucket = F.expr(f"{key} div {BITS}")
    initial = done.select(F.col("bucket_no").cast("long").alias("bucket_no"), "bitmap").groupBy("bucket_no") if done is not None else None
    return (stream.withColumn("bucket_no", bucket).groupBy("bucket_no")
            .transformWithStateInPandas(FirstArrivals(key, stream.columns), stream.schema, "Append", "None", initial))


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A setting for streams that start inside (they keep it); the session's own comes back after."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which the state of arrivals needs."""
    return setting(spark, PROVIDER, ROCKSDB)
