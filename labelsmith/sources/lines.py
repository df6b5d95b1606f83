"""Line-oriented inputs (A1-A3, A5).

* ``scan_lines``: plain or compressed text; lines end at ``\\n`` only (a bare ``\\r`` stays in
  the line and is stripped by parsing).
* ``number_lines``: zero-based position of every line (blank and bad ones too) in file order:
  files by name, then byte offset. Computed from ``_metadata`` (file and split start) plus the
  position inside the split, with per-split counts turned into offsets in two levels (splits
  within a file, then one row per file). Nothing is broadcast on a guess and no driver loop runs;
  the result is meant to be landed once as Parquet and reused.
* ``count_lines``: number of lines (``\\n`` count, plus one for an unterminated last line).
* ``input_fingerprint``: compare stored (path, size, mtime) with the files' current metadata.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .files import data_files, reachable, uri
from .zstd import RANGE, read_zstd_lines

_LOW33 = (1 << 33) - 1


def scan_lines(spark: SparkSession, path: str, width: int = RANGE) -> DataFrame:
    """``(file, split_start, line)`` for every line of the text file(s) at ``path``.

    zstd files are read in ranges of ``width`` compressed bytes (``zstd``), so one large file of many frames
    is many tasks; all else, and stores that only Spark can open, by Spark's text source.
    """
    files = [uri(path, p) for p, _ in data_files(path)] if reachable(path) and not any(c in path for c in "*?[{,") else []
    packed = [f for f in files if f.endswith(".zst")]
    if not packed:
        return _scan_text(spark, path)
    rest = [f for f in files if not f.endswith(".zst")]
    found = read_zstd_lines(spark, path, width)
    return found.unionByName(_scan_text(spark, rest)) if rest else found


def _scan_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    df = spark.read.option("lineSep", "\n").text(path)
    return df.select(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("split_start"),
                     F.col("value").alias("line"))


def number_lines(spark: SparkSession, path: str, width: int = RANGE) -> DataFrame:
    """``(row_index, line)``: zero-based line numbers in (file name, byte offset) order."""
    raw = scan_lines(spark, path, width).withColumn(
        "_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
    splits = raw.groupBy("file", "split_start").agg(
        F.min("_local").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # two levels: splits within their file, then files (one row each)
    inside = Window.partitionBy("file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg(F.sum("_rows").alias("_file_rows"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("_file_rows").over(before), F.lit(0)).alias("_file_off"))
    offs = splits.withColumn("_in", F.coalesce(F.sum("_rows").over(inside), F.lit(0))).join(files, "file")
    offs = offs.select("file", "split_start", "_first", (F.col("_file_off") + F.col("_in")).alias("_off"))
    return raw.join(offs, ["file", "split_start"]).select(
        (F.col("_off") + F.col("_local") - F.col("_first")).cast("long").alias("row_index"), "line")


def land_lines(spark: SparkSession, path: str, out: str, buckets: int | None = None) -> DataFrame:
    """Number the lines once and store them as Parquet; later runs read the landed table.

    The numbering reads the text twice (split counts, then rows); landing pins the result so
    that a lost executor or a rerun cannot renumber anything. With ``buckets`` the table is
    bucketed by ``row_index`` (see ``bucketed_by_row``), so the resume anti join against a state
    table bucketed the same way runs without a shuffle.
    """
    rows = number_lines(spark, path)
    if buckets:
        return bucketed_by_row(rows, out, buckets)
    rows.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def table_name(path: str) -> str:
    """Catalog name of the bucketed table at ``path``."""
    return "rows_" + hashlib.sha1(path.encode()).hexdigest()[:16]


def bucketed_by_row(df: DataFrame, out: str, buckets: int, mode: str = "overwrite",
                    name: str | None = None) -> DataFrame:
    """Write ``df`` as an external table at ``out`` bucketed and sorted by ``row_index``.

    Two tables written this way with the same bucket count join on ``row_index`` partition by
    partition: no exchange on either side. The bucket layout lives in the catalog, so read the
    table back by ``name`` (``spark.table``), not by path."""
    name = name or table_name(out)
    (df.write.mode(mode).bucketBy(int(buckets), "row_index").sortBy("row_index")
     .option("path", out).saveAsTable(name))
    return df.sparkSession.table(name)


def count_lines(spark: SparkSession, path: str, override: int | None = None) -> DataFrame:
    """One row ``input_rows``; an override replaces the count and must be positive."""
    if override is not None:
        if int(override) <= 0:
            raise ValueError("total rows must be greater than zero")
        return spark.range(1).select(F.lit(int(override)).cast("long").alias("input_rows"))
    return spark.read.option("lineSep", "\n").text(path).agg(
        F.count(F.lit(1)).alias("input_rows"))


def file_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``(input_path, input_size_bytes, input_mtime_epoch)`` per input file (whole seconds)."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("input_path"),
                        F.col("length").alias("input_size_bytes"),
                        F.unix_seconds(F.col("modificationTime")).alias("input_mtime_epoch"))


def run_fingerprint(current: DataFrame, run_id: int) -> DataFrame:
    """The rows that a run stores about its input: ``run_id`` and the three fields of every file."""
    return current.select(F.lit(run_id).alias("run_id"), "input_path", "input_size_bytes", "input_mtime_epoch")


def record_run(current: DataFrame, run_id: int, path: str) -> None:
    """Store the fingerprint of a run that begins; a run id is stored once."""
    spark = current.sparkSession
    rows = run_fingerprint(current, run_id)
    if path_exists(spark, path) and not spark.read.parquet(path).where(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run {run_id} is stored already")
    rows.write.mode("append").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def input_fingerprint(current: DataFrame, runs: DataFrame) -> DataFrame:
    """``(run_id, mismatch)``: per stored run the first mismatch of its files with the current ones.

    Paths are compared as whole sets (a file gone or added since is ``input path``), then sizes, then
    mtimes; NULL when the run may resume. ``runs`` has a row per run and file.
    """
    cur = current.select(F.col("input_path").alias("cur_path"), F.col("input_size_bytes").alias("cur_size"),
                         F.col("input_mtime_epoch").alias("cur_mtime"))
    n_current = current.agg(F.count(F.lit(1)).alias("n")).scalar()
    j = runs.join(cur, runs.input_path == cur.cur_path, "left")
    per = j.groupBy("run_id").agg(
        F.count("cur_path").alias("found"), F.count(F.lit(1)).alias("stored"),
        F.bool_or(F.col("cur_size") != F.col("input_size_bytes")).alias("size"),
        F.bool_or(F.col("cur_mtime") != F.col("input_mtime_epoch")).alias("mtime"))
    reason = (F.when((F.col("found") < F.col("stored")) | (F.col("found") < n_current), F.lit("input path"))
              .when(F.col("size"), F.lit("input size")).when(F.col("mtime"), F.lit("input mtime")))
    return per.select("run_id", reason.alias("mismatch"))
