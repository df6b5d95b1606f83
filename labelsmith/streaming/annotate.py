"""Continuous annotation of arriving submissions, back-fill and sealing.

Source: a directory of landed submission files ``(row_index, line)`` read as a file stream;
``maxFilesPerTrigger`` paces the work. No step of a trigger reads what earlier triggers did:

* which rows have come is kept in the state store, a bit per row (``arrivals``);
* answers are landed by the first letters of their key, and a trigger reads the folders of its own keys, the
  light columns for the outcome and the bodies of its successful rows;
* rows whose key has no answer yet are kept by the same letters (``pending``). ``back_fill`` takes the answers
  that are new, reads the folders of their keys alone, and finishes the rows that waited for them, once.

Each batch (a trigger by its number, counted on over checkpoints, a back-fill by its negative number) writes folders of its own, whole; a
repeated one writes them anew, so no row is finished twice. ``seal`` turns the records of batches that are not
sealed yet into release shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import valid_key
from ..operators import bitmaps, lookup, parse, release
from ..session import scratch_dir
from ..sources.lines import path_exists
from .arrivals import first_arrivals, rocksdb

SUBMISSION_SCHEMA = T.StructType([T.StructField("row_index", T.LongType()),
                                  T.StructField("line", T.StringType())])
#: Leading letters of a key that name its folder: at most 26 to that power of them.
LETTERS = 2


def _prefix(letters: int) -> F.Column:
    return F.substring("inchikey", 1, letters).alias("prefix")


def _prefixes(keyed: DataFrame, letters: int) -> list[str]:
    """The folders that the keys of ``keyed`` lie in; at most 26 to the power of ``letters``."""
    return sorted(r["prefix"] for r in keyed.where(valid_key(F.col("inchikey"))).select(_prefix(letters)).distinct().collect())


def _folders(spark: SparkSession, path: str, prefixes: list[str], schema: T.StructType) -> DataFrame:
    """The rows below ``path/<any>/prefix=...`` of the given prefixes; other folders are not even listed."""
    jvm, at = spark.sparkContext._jvm, f"{path}/*/prefix={{{','.join(prefixes)}}}"
    found = []
    if prefixes and path_exists(spark, path):
        glob = jvm.org.apache.hadoop.fs.Path(at)
        found = [s.getPath().toString() for s in glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob)]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*found)


def land_answers(responses: DataFrame, path: str, letters: int = LETTERS, run: int = 0) -> str:
    """Write the deduplicated answers of a run by the first ``letters`` of their key; returns ``path``.

    A run is written whole, so writing it again changes nothing. Outcome and answer alone are landed: the nodes,
    which no trigger reads, would be most of what the two exchanges move.
    """
    deduped = lookup.dedupe_responses(responses).drop("nodes")
    (deduped.withColumn("prefix", _prefix(letters)).repartition("prefix").sortWithinPartitions("prefix", "inchikey")
     .write.mode("overwrite").partitionBy("prefix").parquet(f"{path}/run={int(run)}"))
    return path


def answer_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType([f for f in spark.read.parquet(path).schema if f.name != "run"])


def answers_of(spark: SparkSession, path: str, keyed: DataFrame, letters: int = LETTERS, schema: T.StructType | None = None) -> DataFrame:
    """The landed answers in the folders of the keys of ``keyed``."""
    return _folders(spark, path, _prefixes(keyed, letters), schema or answer_schema(spark, path))


def _write(df: DataFrame, out_dir: str, table: str, batch_id: int, *by: str) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{out_dir}/{table}/batch_id={batch_id}")


def _finish(spark: SparkSession, parsed: DataFrame, answers: DataFrame, out_dir: str, batch_id: int) -> DataFrame:
    """States and records of the parsed rows that have an outcome; returns all of them with their state, landed.

    Only light columns meet the rows; bodies are read again for the successful ones. Landed rows keep what is still
    read of them: the line of a pending one, the fields of a successful one.
    """
    light = lookup.annotate_with_answers(parsed, answers.select("inchikey", "answered", "state", "reason"))
    path = scratch_dir(spark, "batch")
    kept = {"line": C.PENDING, "cid": C.SUCCESS, "inchi": C.SUCCESS}
    light = light.withColumns({c: F.when(F.col("state") == s, F.col(c)) for c, s in kept.items()})
    light.select("row_index", "line", "cid", "inchi", "inchikey", "state", "reason").write.parquet(path)
    light = spark.read.parquet(path)
    _write(light.where(F.col("state") != C.PENDING).select("row_index", "state", "reason"), out_dir, "states", batch_id)
    bodies = answers.select(F.col("inchikey").alias("answer_key"), *[c for c in ("body", "fetched_at") if c in answers.columns])
    found = light.where(F.col("state") == C.SUCCESS).join(bodies, F.col("inchikey") == F.upper("answer_key")).drop("answer_key")
    _write(parse.success_records(found), out_dir, "records", batch_id)
    return light


def _first_batch(spark: SparkSession, out_dir: str, checkpoint: str) -> int:
    """Number of a checkpoint's first trigger in ``out_dir``: behind all that other checkpoints wrote there; noted once."""
    noted = f"{out_dir}/begins"
    if path_exists(spark, noted):
        mine = spark.read.parquet(noted).where(F.col("checkpoint") == checkpoint).first()
        if mine:
            return mine["first"]
    last = spark.read.parquet(f"{out_dir}/states").agg(F.max("batch_id")).first()[0] if path_exists(spark, f"{out_dir}/states") else None
    first = max(-1 if last is None else last, -1) + 1
    spark.createDataFrame([(checkpoint, first)], "checkpoint string, first long").write.mode("append").parquet(noted)
    return first


def _write_batch(out_dir: str, answers: str, letters: int, schema: T.StructType, first: int):
    def write(rows: DataFrame, trigger: int) -> None:
        spark, batch_id = rows.sparkSession, first + trigger
        path = scratch_dir(spark, "arrivals")
        rows.write.parquet(path)  # the state of arrivals is asked once
        parsed = parse.parse_submissions(spark.read.schema(SUBMISSION_SCHEMA).parquet(path))
        light = _finish(spark, parsed, answers_of(spark, answers, parsed, letters, schema), out_dir, batch_id)
        waiting = light.where(F.col("state") == C.PENDING).select("row_index", "line", _prefix(letters))
        _write(waiting, out_dir, "pending", batch_id, "prefix")
    return write


def start_annotation_stream(spark: SparkSession, source_dir: str, answers: str,
                            out_dir: str, checkpoint: str, files_per_trigger: int = 1,
                            available_now: bool = True, every: str = "10 seconds", letters: int = LETTERS):
    """Start the stream; returns the ``StreamingQuery``. A row that has come already is skipped.

    ``answers``: folder of ``land_answers`` (with the same ``letters``). A new checkpoint over an old
    ``out_dir`` begins with the states that are there.
    """
    rows = (spark.readStream.schema(SUBMISSION_SCHEMA)
            .option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir))
    done = None
    if path_exists(spark, f"{out_dir}/states") and not path_exists(spark, f"{checkpoint}/offsets"):
        known = spark.read.parquet(f"{out_dir}/states").select("row_index", F.lit("done").alias("state"))
        done = bitmaps.bitmap_encode(known)
    write = _write_batch(out_dir, answers, letters, answer_schema(spark, answers), _first_batch(spark, out_dir, checkpoint))
    with rocksdb(spark):
        writer = (first_arrivals(rows, "row_index", done).writeStream.foreachBatch(write)
                  .option("checkpointLocation", checkpoint))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
            processingTime=every)
        return writer.start()


def back_fill(spark: SparkSession, responses: DataFrame, answers: str, out_dir: str, run: int, letters: int = LETTERS) -> None:
    """Land the answers that are new and finish the pending rows that waited for them.

    ``run``: a number from 1 that grows with each back-fill; repeating the last one changes nothing. Keys
    that had an answer before keep it. Only folders of the new answers' keys are read, of answers, pending rows and
    rows filled before. Run it between triggers: rows that a running trigger is about to put down as
    pending are found by the next back-fill that has answers for their keys.
    """
    if run < 1:
        raise ValueError("runs of back-fills are numbered from 1")
    schema = answer_schema(spark, answers)
    path = scratch_dir(spark, "new-answers")
    responses.where(valid_key(F.col("inchikey"))).write.parquet(path)
    new = spark.read.parquet(path)
    earlier = _folders(spark, answers, _prefixes(new, letters), T.StructType([*schema, T.StructField("run", T.LongType())]))
    new = new.join(earlier.where(F.col("run") < run).select("inchikey"), "inchikey", "left_anti")
    land_answers(new, answers, letters, run)
    fresh = spark.read.schema(schema).option("basePath", f"{answers}/run={run}").parquet(f"{answers}/run={run}")
    touched = _prefixes(fresh, letters)
    row = T.StructType([T.StructField("row_index", T.LongType()), T.StructField("line", T.StringType()), T.StructField("prefix", T.StringType())])
    filled = T.StructType([T.StructField("row_index", T.LongType()), T.StructField("prefix", T.StringType()), T.StructField("batch_id", T.LongType())])
    waiting = _folders(spark, f"{out_dir}/pending", touched, row).dropDuplicates(["row_index"])
    before = _folders(spark, f"{out_dir}/filled", touched, filled).where(F.col("batch_id") > -run)
    waiting = waiting.join(before.select("row_index"), "row_index", "left_anti")
    parsed = parse.parse_submissions(waiting.select("row_index", "line"))
    parsed = parsed.join(fresh.select("inchikey").distinct(), "inchikey", "left_semi")
    light = _finish(spark, parsed, fresh, out_dir, -run)
    _write(light.where(F.col("state") != C.PENDING).select("row_index", _prefix(letters)), out_dir, "filled", -run, "prefix")


def seal(spark: SparkSession, out_dir: str, shards: str, max_records: int = C.SHARD_MAX_RECORDS, max_bytes: int = C.SHARD_MAX_BYTES) -> int:
    """Append the records of batches that are not sealed yet to the zstd shards; returns how many batches.

    The batches are noted after the shards are published: a run that dies in between seals them again, and the
    release keeps one record per row.
    """
    batches = spark.read.parquet(f"{out_dir}/records").select("batch_id").distinct()
    if path_exists(spark, f"{out_dir}/sealed"):
        batches = batches.join(spark.read.parquet(f"{out_dir}/sealed"), "batch_id", "left_anti")
    ids = [r["batch_id"] for r in batches.collect()]  # a number per trigger since the last seal
    if ids:
        records = spark.read.parquet(f"{out_dir}/records").where(F.col("batch_id").isin(ids)).drop("batch_id")
        release.write_success_shards(records, shards, max_records, "jsonl.zst", max_bytes)
        spark.createDataFrame([(i,) for i in ids], "batch_id long").write.mode("append").parquet(f"{out_dir}/sealed")
    return len(ids)


def read_states(spark: SparkSession, out_dir: str) -> DataFrame:
    """States written by the stream and its back-fills, one per row."""
    st = spark.read.parquet(f"{out_dir}/states")
    latest = F.max_by(F.struct("state", "reason"), F.col("batch_id"))
    return st.groupBy("row_index").agg(latest.alias("s")).select("row_index", "s.state", "s.reason")
