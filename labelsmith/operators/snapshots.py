"""Releases that cost what is new since the last one.

zstd shards come with a list of their row ranges (``_shards``, written by the sink). Shards whose ranges
overlap form a unit, and so does a shard that overlaps none: no row lies in two units. A unit of one shard
goes into the release as it stands, with no shuffle; only units of several are merged, one record per
row. A unit is named by its files, which never change, so what was counted of it once stays right: counts per
spelling are stored by unit, and a release reads the records of units without counts alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.lines import path_exists
from . import release, taxonomy


def shard_index(spark: SparkSession, shards: str) -> DataFrame:
    """``path, bytes, records, first_row, last_row`` of every published shard."""
    schema = "filename string, bytes long, records long, first_row long, last_row long"
    if not path_exists(spark, f"{shards}/_shards"):
        return spark.createDataFrame([], schema.replace("filename", "path"))
    rows = spark.read.schema(schema).json(f"{shards}/_shards")
    return rows.select(F.concat(F.lit(f"{shards.rstrip('/')}/"), "filename").alias("path"), "bytes", "records", "first_row", "last_row")


def release_units(index: DataFrame) -> DataFrame:
    """The index with ``unit`` (a digest of the unit's files) and ``files`` (how many it has).

    A sweep over the shards in row order: a shard that begins behind all before it opens a unit. One
    narrow row per shard (800,000 for 100 TB) passes the one window without a key.
    """
    order = Window.orderBy("first_row", "last_row", "path")
    before = F.max("last_row").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = index.withColumn("opens", (before.isNull() | (F.col("first_row") > before)).cast("long"))
    numbered = opened.withColumn("no", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    named = numbered.groupBy("no").agg(F.sha1(F.array_join(F.sort_array(F.collect_list(F.regexp_extract("path", "([^/]+)$", 1))), "\n")).alias("unit"),
                                       F.count("*").alias("files"))
    return numbered.join(named, "no").drop("no", "opens")


def _paths(units: DataFrame) -> list[str]:
    return sorted(r["path"] for r in units.select("path").collect())


def unit_records(spark: SparkSession, units: DataFrame) -> DataFrame:
    """The records of the units, one per row, with their ``unit``; only units of several shards are shuffled."""
    out = None
    for several in (False, True):
        some = units.where((F.col("files") > 1) == several)
        paths = _paths(some)
        if not paths:
            continue
        name = F.regexp_extract(F.input_file_name(), "([^/]+)$", 1)
        found = release.read_success_records(spark, paths, "jsonl.zst").withColumn("_file", name)
        of = some.select(F.regexp_extract("path", "([^/]+)$", 1).alias("_file"), "unit")
        found = found.join(of, "_file").drop("_file")
        found = release.newest_of_each_row(found.repartitionByRange("row_index")).sortWithinPartitions("row_index") if several else found
        out = found if out is None else out.unionByName(found)
    return release.read_success_records(spark, [], "jsonl.zst").withColumn("unit", F.lit(None).cast("string")) if out is None else out


def merge_units(spark: SparkSession, shards: str) -> DataFrame:
    """H3 over listed shards: all records, one per row. Rows are in order within a task, and no two tasks' rows
    interleave but those of an overlap with each other's; ``orderBy`` where a total order is wanted."""
    units = release_units(shard_index(spark, shards))
    alone, rest = _paths(units.where("files = 1")), units.where("files > 1")
    out = release.read_success_records(spark, alone, "jsonl.zst")
    return out.unionByName(unit_records(spark, rest).drop("unit"), allowMissingColumns=True) if not rest.isEmpty() else out


def counted_units(spark: SparkSession, shards: str, store: str) -> tuple[DataFrame, int]:
    """``spelling_counts`` of all units, and how many shards were read for it.

    Counts of new units are written below ``store/counts/run=...``, then the units are noted with that run, so counts
    that were written before a failure belong to no unit and are never added.
    """
    units = release_units(shard_index(spark, shards))
    known = f"{store}/units"
    noted = spark.read.parquet(known) if path_exists(spark, known) else spark.createDataFrame([], "unit string, run string")
    missing = units.join(noted, "unit", "left_anti")
    n = missing.count()
    if n:
        run = uuid.uuid4().hex
        long = taxonomy.taxonomy_long(unit_records(spark, missing), keep=("unit",))
        taxonomy.spelling_counts(taxonomy.taxonomy_nodes(long), "unit").write.parquet(f"{store}/counts/run={run}")
        missing.select("unit").distinct().withColumn("run", F.lit(run)).write.mode("append").parquet(known)
        noted = spark.read.parquet(known)
    if not path_exists(spark, f"{store}/counts"):
        return taxonomy.spelling_counts(taxonomy.taxonomy_nodes(taxonomy.taxonomy_long(release.read_success_records(spark, [], "jsonl.zst")))), n
    now = noted.join(units.select("unit").distinct(), "unit", "left_semi")
    return spark.read.parquet(f"{store}/counts").join(now, ["unit", "run"]).drop("unit", "run"), n


def release_counts(spark: SparkSession, shards: str, store: str) -> DataFrame:
    """F3 over listed shards: equal to ``taxonomy_counts`` of all records; reads the shards of new units alone."""
    spelled, _ = counted_units(spark, shards, store)
    added = spelled.groupBy("layer_no", "layer", "class_key", "name", "chemont_id").agg(F.sum("n").alias("n"), F.min("first_row").alias("first_row"))
    return taxonomy.class_counts(added)
