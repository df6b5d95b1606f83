"""Shards that are cut one after another by their own records and bytes (H1), found in parallel.

A shard ends before the next record when it holds ``max_records`` records or at least ``max_bytes``
bytes; the next one begins from nought. Where a shard begins thus depends on where the one before
began, back to the first row. Blocks of rows make this parallel: of any place where a shard could begin
in a block, the block alone tells where the first shard of the next block begins and how many begin
here. These tables are composed over runs of blocks, level by level, until one begin is known (the
first row); back down, every block gets its own first begin and cuts its rows.

A shard holds at most ``max_records`` records, so with blocks at least that long only the first
``max_records`` places of a block matter: a table has so many entries, whatever the size of the input.
Rows here are numbers and sizes; no answer is moved.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .positions import with_positions

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

#: Least rows of a block, and tables that a task composes one after another.
BLOCK, FAN = 1 << 16, 256
#: Most records per shard: a block of so many numbers is held by one task.
MOST_RECORDS = 1 << 22
TABLE = "block long, follow binary, begun binary"


def _next_begins(sizes: np.ndarray, max_records: int, max_bytes: int) -> np.ndarray:
    """Of a shard that begins at each place: the place where the next begins (the end, if none does)."""
    before = np.concatenate([[0], np.cumsum(sizes)])
    full = np.searchsorted(before, before[:-1] + min(max_bytes, int(before[-1]) + 1))
    return np.minimum(np.minimum(full, np.arange(len(sizes)) + max_records), len(sizes))


def _table(max_records: int, max_bytes: int):
    """Task: a block's table, from its sizes and the ``max_records`` after it."""
    def run(rows: pa.Table) -> pa.Table:
        pos = rows.column("pos").to_numpy()
        sizes = rows.column("size").to_numpy()[np.argsort(pos)]
        n = int((~rows.column("ahead").to_numpy(zero_copy_only=False)).sum())
        to, begun = _next_begins(sizes, max_records, max_bytes)[:n], np.ones(n, np.int64)
        while (inside := to < n).any():  # jump until all point beyond the block
            begun[inside] += begun[to[inside]]
            to[inside] = to[to[inside]]
        block = rows.column("block")[0].as_py()
        return pa.table({"block": [block], "follow": [(to - n)[:max_records].astype("<i8").tobytes()], "begun": [begun[:max_records].astype("<i8").tobytes()]})

    return run


def _read(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["follow"], "<i8"), np.frombuffer(row["begun"], "<i8")


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: the tables of each run of blocks (rows sorted by run and block) as one table."""
    run, follow, begun = None, None, None
    out = lambda: pa.RecordBatch.from_pylist([{"block": run, "follow": follow.tobytes(), "begun": begun.tobytes()}], pa.schema([("block", pa.int64()), ("follow", pa.binary()), ("begun", pa.binary())]))
    for batch in batches:
        for row in batch.to_pylist():
            to, n = _read(row)
            if row["run"] != run:
                if run is not None:
                    yield out()
                run, follow, begun = row["run"], to, n
                continue
            at = np.minimum(follow, len(to) - 1)  # only the very last block is short, and nothing follows it
            follow, begun = to[at], begun + n[at]
    if run is not None:
        yield out()


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: first begin and its shard's number for every block of a run, from those of the run."""
    run, place, number = None, 0, 0
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["run"] != run:
                run, place, number = row["run"], row["place"], row["number"]
            out.append({"block": row["block"], "place": place, "number": number})
            to, n = _read(row)
            if place < len(to):
                place, number = int(to[place]), number + int(n[place])
        yield pa.RecordBatch.from_pylist(out, pa.schema([("block", pa.int64()), ("place", pa.int64()), ("number", pa.int64())]))


def _landed(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _first_begins(tables: DataFrame, blocks: int) -> DataFrame:
    """``block, place, number`` for blocks 0 to ``blocks`` - 1."""
    runs = tables.withColumn("run", F.expr(f"block div {FAN}"))
    if blocks <= FAN:
        known = tables.sparkSession.range(1).select(F.col("id").alias("run"), F.lit(0).cast("long").alias("place"), F.lit(1).cast("long").alias("number"))
    else:
        upper = _landed(runs.repartition("run").sortWithinPartitions("run", "block").mapInArrow(_composed, TABLE), "rotation-tables")
        known = _first_begins(upper, -(-blocks // FAN)).withColumnRenamed("block", "run")
    rows = runs.join(known, "run").repartition("run").sortWithinPartitions("run", "block")
    return rows.mapInArrow(_walked, "block long, place long, number long")


def _cut(max_records: int, max_bytes: int):
    """Task: the shard number of every row of a block whose first begin is known."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        sizes, place, number = rows.column("size").to_numpy(), rows.column("place")[0].as_py(), rows.column("number")[0].as_py()
        to, begins = _next_begins(sizes, max_records, max_bytes).tolist(), []
        while place < len(to):
            begins.append(place)
            place = to[place]
        shard = number - 1 + np.searchsorted(np.array(begins, np.int64), np.arange(len(to)), side="right")
        return rows.select(["row_index", "pos", "size"]).append_column("shard_no", pa.array(shard, pa.int64()))

    return run


def rotate(sized: DataFrame, max_records: int, max_bytes: int) -> DataFrame:
    """``row_index, pos, size, shard_no`` (from 1) of ``row_index, size`` in ``row_index`` order.

    ``row_index`` is unique. Sizes are not negative; a null size counts as nought. A record larger than
    ``max_bytes`` fills its shard alone or ends it. An empty table gives an empty result.
    """
    if not 0 < max_records <= MOST_RECORDS or max_bytes <= 0:
        raise ValueError(f"shard limits must be positive, and records at most {MOST_RECORDS}")
    width = max(BLOCK, max_records)
    rows = sized.select("row_index", F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"))
    rows = _landed(with_positions(rows, "row_index").withColumn("block", F.expr(f"pos div {width}")), "rotation-rows")
    last = rows.agg(F.max("block")).first()[0]
    begins = F.expr(f"pos % {width} < {max_records} and block > 0")
    ahead = rows.where(begins).withColumn("block", F.col("block") - 1)
    both = rows.withColumn("ahead", F.lit(False)).unionByName(ahead.withColumn("ahead", F.lit(True))).drop("row_index")
    tables = _landed(both.groupBy("block").applyInArrow(_table(max_records, max_bytes), TABLE), "rotation-tables")
    known = _first_begins(tables, (last or 0) + 1)
    return rows.join(known, "block").groupBy("block").applyInArrow(_cut(max_records, max_bytes), "row_index long, pos long, size long, shard_no long")
