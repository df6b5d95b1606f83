"""Row-state table operators.

States live as a table ``(row_index, state, reason)``: appends are plain writes, the checks
are joins and aggregates on ``row_index``, which hash-partitions evenly (row numbers are unique
and dense, so no key is hot).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import scratch_dir
from ..sources.lines import path_exists, table_name


def append_conflicts(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New states for rows that already have one: ``(row_index, existing_state, new_state)``."""
    old = existing.select("row_index", F.col("state").alias("existing_state"))
    return new.select("row_index", F.col("state").alias("new_state")).join(old, "row_index").select(
        "row_index", "existing_state", "new_state")


def append_states(new: DataFrame, path: str, batch: int, buckets: int | None = None) -> None:
    """Append the states of a batch to the table at ``path``, partitioned by ``batch``.

    A row that has a state from another batch fails, and so does one that ``new`` holds twice; nothing is
    then written. A batch is one unit: appended again, as after a driver that was lost on the way, it
    replaces what it wrote. ``new`` is landed first, so what is written is what was checked.

    With ``buckets`` the table is also bucketed by ``row_index`` (see ``sources.lines.bucketed_by_row``) so the
    next resume joins it without a shuffle."""
    spark = new.sparkSession
    landing = scratch_dir(spark, "new-states")
    new.select("row_index", "state", "reason").write.parquet(landing)
    rows = spark.read.parquet(landing)
    if not rows.groupBy("row_index").count().where("count > 1").isEmpty():
        raise ValueError("row has more than one new state")
    there = path_exists(spark, path)
    if there and not append_conflicts(spark.read.parquet(path).where(F.col("batch") != batch), rows).isEmpty():
        raise ValueError("row already has a terminal state")
    if not buckets:
        rows.write.mode("overwrite").parquet(f"{path}/batch={int(batch)}")
        return
    name = table_name(path)
    if there:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (batch = {int(batch)}) SELECT row_index, state, reason FROM {{rows}}", rows=rows)
    else:
        (rows.withColumn("batch", F.lit(int(batch))).write.partitionBy("batch").bucketBy(int(buckets), "row_index")
         .sortBy("row_index").option("path", path).saveAsTable(name))


def state_conflicts(states: DataFrame) -> DataFrame:
    """Rows carrying more than one distinct state: ``(row_index, states)``."""
    return (states.groupBy("row_index").agg(F.count_distinct("state").alias("states"))
            .where(F.col("states") > 1))


def state_counts(states: DataFrame) -> DataFrame:
    st = F.col("state")
    return states.agg(*[F.count_if(st == s).alias(f"{s}_rows") for s in C.STATES])


def resume_point(rows: DataFrame) -> DataFrame:
    """``resume_point`` = last handled row + 1 (0 if none); ``first_gap`` = smallest unhandled
    row (the row count when every row is handled). ``rows`` carries ``state`` with ``pending``
    for unhandled rows. One keyless aggregate, partial per task."""
    handled = F.col("state") != C.PENDING
    return rows.agg(
        F.coalesce(F.max(F.when(handled, F.col("row_index"))) + 1, F.lit(0).cast("long"))
        .alias("resume_point"),
        F.coalesce(F.min(F.when(~handled, F.col("row_index"))), F.count(F.lit(1)))
        .alias("first_gap"))
