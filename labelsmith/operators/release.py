"""Success shards and release snapshots.

Shards are directories by Spark's own writers (``shard=success-000001``) or zstd files of the writer in
``sources.zstd``; either way names sort in shard order. The release is the union of the shard files read back as one
dataset, with duplicate ``row_index`` dropped (a record can be written twice when a run dies
between writing it and recording its state) and sorted by ``row_index`` with a range sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..sources.lines import path_exists
from ..sources.zstd import write_zstd_shards
from .rotation import rotate

#: Row numbers whose shards are listed in one row.
SHARD_BUCKET = 1 << 16

RECORD_SCHEMA = T.StructType([
    T.StructField("row_index", T.LongType()),
    T.StructField("cid", T.LongType()),
    T.StructField("inchi", T.StringType()),
    T.StructField("inchikey", T.StringType()),
    T.StructField("fetched_at", T.StringType()),
    T.StructField(C.ANSWER_FIELD, T.StringType()),  # raw JSON text of the answer
])

SUMMARY_SCHEMA = (
    f"generated_at STRING, {C.SUMMARY_TOTAL_FIELD} BIGINT, "
    "counts STRUCT<success_rows: BIGINT, miss_rows: BIGINT, invalid_rows: BIGINT, failed_rows: BIGINT>, "
    "taxonomy_layers ARRAY<STRUCT<layer: STRING, assigned_records: BIGINT, unique_class_count: BIGINT, "
    "classes: ARRAY<STRUCT<name: STRING, chemont_id: STRING, label_count: BIGINT>>>>")

MANIFEST_SCHEMA = (
    "generated_at STRING, format STRING, success_rows BIGINT, miss_rows BIGINT, invalid_rows BIGINT, "
    "failed_rows BIGINT, shards ARRAY<STRUCT<filename: STRING, bytes: BIGINT>>")


def shard_assignment(records: DataFrame, max_records: int = C.SHARD_MAX_RECORDS,
                     max_bytes: int = C.SHARD_MAX_BYTES) -> DataFrame:
    """``row_index, pos, size, shard_no``: shard numbers (from 1) in ``row_index`` order.

    A shard ends when it holds ``max_records`` records or at least ``max_bytes`` bytes of answers itself,
    and the next one counts from nought (``rotation``). Numbers and sizes alone are moved, no answer.
    """
    sized = records.select("row_index", F.octet_length(C.ANSWER_FIELD).cast("long").alias("size"))
    return rotate(sized, int(max_records), int(max_bytes))


def with_shards(records: DataFrame, assigned: DataFrame) -> DataFrame:
    """``records`` with their ``shard_no``: the only exchange of answers on the way to the shards.

    Answers meet one narrow row per ``SHARD_BUCKET`` row numbers, which lists the shards that begin there; they
    are hashed into its partitions, never sorted or sampled for it.
    """
    bucket = F.expr(f"row_index div {SHARD_BUCKET}").alias("_bucket")
    pieces = assigned.groupBy(bucket, "shard_no").agg(F.min("row_index").alias("first"))
    begins = pieces.groupBy("_bucket").agg(F.sort_array(F.collect_list(F.struct("first", "shard_no"))).alias("_begins"))
    mine = F.element_at(F.filter("_begins", lambda x: x["first"] <= F.col("row_index")), -1)["shard_no"]
    return (records.withColumn("_bucket", bucket).join(begins.hint("shuffle_hash"), "_bucket")
            .withColumn("shard_no", mine).drop("_bucket", "_begins"))


def record_line(df: DataFrame) -> F.Column:
    """One JSON line per record with the answer spliced in as raw JSON (line breaks inside the
    body become spaces: they cannot occur inside JSON strings, only between tokens)."""
    head = F.to_json(F.struct("row_index", "cid", "inchi", "inchikey",
                              *(["fetched_at"] if "fetched_at" in df.columns else [])))
    body = F.regexp_replace(F.col(C.ANSWER_FIELD), r"[\r\n]+", " ")
    return F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(f',"{C.ANSWER_FIELD}":'), body, F.lit("}"))


def write_success_shards(records: DataFrame, out: str, max_records: int = C.SHARD_MAX_RECORDS,
                         fmt: str = C.RELEASE_FORMAT, max_bytes: int = C.SHARD_MAX_BYTES) -> None:
    """Write records into shards under the record and byte limit.

    ``fmt`` is ``jsonl`` (gzip text, one JSON record per line) or ``parquet`` (zstd), both in directories
    ``shard=success-NNNNNN`` cut by ``shard_assignment`` (a shard over a border of ``SHARD_BUCKET`` row numbers has
    a file from each side), or ``jsonl.zst``: files ``success-NNNNNN.jsonl.zst`` whose limit is on
    compressed bytes (``sources.zstd``). ``records`` is read twice but for ``jsonl.zst``: land it first.
    """
    if fmt == "jsonl.zst":
        last = records.agg(F.max("row_index")).first()[0]
        if last is None:
            return
        parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        part = F.expr(f"cast(row_index * cast({parts} as decimal(10,0)) div {last + 1} as int)")
        lines = records.select("row_index", record_line(records).alias("value")).repartitionById(parts, part)
        write_zstd_shards(lines.sortWithinPartitions("row_index"), out, max_records, max_bytes)
        return
    named = with_shards(records, shard_assignment(records, max_records=max_records, max_bytes=max_bytes))
    named = named.withColumn("shard", F.format_string(C.SHARD_NAME_FORMAT, F.col("shard_no"))).sortWithinPartitions("shard", "row_index")
    if fmt == "jsonl":
        out_df = named.select("shard", record_line(named).alias("value"))
        (out_df.write.mode("overwrite").partitionBy("shard").option("compression", "gzip")
         .option("lineSep", "\n").text(out))
    elif fmt == "parquet":
        cols = [c.name for c in RECORD_SCHEMA.fields if c.name in named.columns] + ["shard"]
        (named.select(*cols).write.mode("overwrite").partitionBy("shard")
         .option("compression", "zstd").parquet(out))
    else:
        raise ValueError(f"unknown shard format {fmt}")


def read_success_records(spark: SparkSession, path, fmt: str = C.RELEASE_FORMAT,
                         answer_field: str = C.ANSWER_FIELD) -> DataFrame:
    """All shard records; missing paths and zero-length files are skipped, blank lines ignored,
    a malformed line fails the read (FAILFAST). ``answer_field`` names the answer in shards of others."""
    there = [p for p in ([path] if isinstance(path, str) else list(path)) if path_exists(spark, p)]
    listed = fmt.startswith("jsonl")  # one read of all paths: a plan that does not grow with their number
    schema = T.StructType([T.StructField(answer_field if f.name == C.ANSWER_FIELD else f.name, f.dataType) for f in RECORD_SCHEMA.fields])
    out = spark.createDataFrame([], schema) if not there else None
    for p in [there] if listed and there else there:
        if listed:
            df = (spark.read.schema(schema).option("mode", "FAILFAST").option("ignoreMissingFiles", "true")
                  .option("recursiveFileLookup", "true").json(p))
        else:
            df = spark.read.option("ignoreMissingFiles", "true").parquet(p)
        df = df.select(*[c for c in schema.names if c in df.columns])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.withColumnRenamed(answer_field, C.ANSWER_FIELD)


def merge_release(spark: SparkSession, shards, fmt: str = C.RELEASE_FORMAT,
                  partitions: int | None = None) -> DataFrame:
    """Union of all shards as one dataset in ``row_index`` order, one record per row.

    Of different records of one row the one fetched last stays, of equally old ones that of the larger
    hash. One shuffle: range partitioning on ``row_index`` already clusters equal keys, so the pick
    reuses it, and sorting inside the ranges gives the global order. AQE sets the number of ranges
    from the data unless ``partitions`` is given.
    """
    recs = read_success_records(spark, shards, fmt)
    ranged = recs.repartitionByRange(partitions, "row_index") if partitions else recs.repartitionByRange("row_index")
    return newest_of_each_row(ranged).sortWithinPartitions("row_index")


def newest_of_each_row(records: DataFrame) -> DataFrame:
    """Of different records of one row the one fetched last, of equally old ones that of the larger hash."""
    rest = [c for c in records.columns if c != "row_index"]
    order = [F.desc_nulls_last(c) for c in ("fetched_at",) if c in records.columns] + [F.desc(F.xxhash64(*rest))]
    best = F.row_number().over(Window.partitionBy("row_index").orderBy(*order))
    return records.withColumn("_n", best).where("_n = 1").drop("_n")


def cut_release(spark: SparkSession, shards, out: str, states: DataFrame, total_rows: int, fmt: str = C.RELEASE_FORMAT,
                generated_at: str | None = None) -> bool:
    """Gate, merged dataset, summary and manifest of one release; False when the gate is shut.

    Of listed shards (``jsonl.zst``) only overlaps are merged, and class counts of shards that an earlier release saw
    come from their store beside the shards (``snapshots``). The manifest is written last: a folder without one
    is no release, and a cut that failed is cut again into another folder.
    """
    from . import report, snapshots, taxonomy
    from .states import state_counts
    counts, files = state_counts(states), shard_files(spark, shards)
    if not release_gate(counts, files):
        return False
    if fmt == "jsonl.zst":
        snapshots.merge_units(spark, shards).write.parquet(f"{out}/dataset")
        classes = snapshots.release_counts(spark, shards, f"{shards.rstrip('/')}/_counts")
    else:
        merge_release(spark, shards, fmt).write.parquet(f"{out}/dataset")
        classes = taxonomy.taxonomy_counts(taxonomy.taxonomy_nodes(taxonomy.taxonomy_long(spark.read.parquet(f"{out}/dataset"))))
    ranked = taxonomy.taxonomy_ranked(classes)
    write_json_document(report.summary_document(spark, report.with_total(counts, total_rows), ranked, generated_at), f"{out}/progress-summary")
    write_manifest(counts, files, out, fmt, generated_at)
    return True


def write_manifest(counts: DataFrame, files: DataFrame, out: str, fmt: str = C.RELEASE_FORMAT, generated_at: str | None = None) -> None:
    """``manifest-files`` (a JSON line per file, by name, written by as many tasks as it takes), then ``manifest``.

    The latter is one document: time, format, the four counts, the number of files and their bytes.
    """
    from .report import attach_one_row
    files.orderBy("filename").write.mode("overwrite").json(f"{out}/manifest-files")
    total = files.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    head = attach_one_row(counts.select(*[f"{s}_rows" for s in C.STATES]), total)
    write_json_document(head.select(_generated(generated_at).alias("generated_at"), F.lit(fmt).alias("format"), *[f"{s}_rows" for s in C.STATES], "files", "bytes"),
                        f"{out}/manifest")


def read_manifest_files(spark: SparkSession, out: str) -> DataFrame:
    """``(filename, bytes)`` of a release's shards."""
    return spark.read.schema("filename string, bytes long").json(f"{out}/manifest-files")


def _generated(at: str | None) -> F.Column:
    return F.lit(at) if at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def shard_files(spark: SparkSession, shards: str) -> DataFrame:
    """``(filename, bytes)`` of every non-empty data file below the shard directory, by name.

    Only file metadata is read (the content column is pruned)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "{part-*,success-*}").load(shards))
    rel = F.regexp_extract("path", r"((?:shard=[^/]+/)?[^/]+)$", 1)
    return files.where(F.col("length") > 0).select(rel.alias("filename"),
                                                    F.col("length").alias("bytes"))


def release_manifest(counts: DataFrame, files: DataFrame, fmt: str = C.RELEASE_FORMAT,
                     generated_at: str | None = None) -> DataFrame:
    """The manifest as one row, file list included: for lists that fit in one cell (``write_manifest`` has no such limit)."""
    from .report import attach_one_row
    flist = files.agg(F.sort_array(F.collect_list(F.struct("filename", "bytes"))).alias("shards"))
    return attach_one_row(counts.select(*[f"{s}_rows" for s in C.STATES]), flist).select(
        _generated(generated_at).alias("generated_at"), F.lit(fmt).alias("format"),
        *[f"{s}_rows" for s in C.STATES], "shards")


def release_gate(counts: DataFrame, files: DataFrame) -> bool:
    """A release is cut only with successful rows and at least one non-empty shard file."""
    has_success = counts.where(F.col("success_rows") > 0).limit(1).count() > 0
    return has_success and not files.limit(1).isEmpty()


def write_json_document(doc: DataFrame, out: str) -> None:
    """Write a one-row document as a single JSON file (job commit makes the swap atomic)."""
    doc.select(F.to_json(F.struct(*doc.columns)).alias("value")).coalesce(1) \
        .write.mode("overwrite").text(out)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY_SCHEMA).option("multiLine", "true").json(path)


def read_manifest_counts(spark: SparkSession, path: str) -> DataFrame:
    m = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", "true").json(path)
    return m.select(*[f"{s}_rows" for s in C.STATES])


def flatten_summary(doc: DataFrame) -> DataFrame:
    """Long form of a summary document, same columns as ``report.summary_rows``."""
    layer_no = {name: no for no, name, _, _ in C.LAYERS}
    lay = doc.select(C.SUMMARY_TOTAL_FIELD, "counts.*",
                     F.posexplode("taxonomy_layers").alias("li", "l"))
    lay = lay.select("*", "l.*").drop("l")
    mapping = F.create_map(*[x for k, v in layer_no.items() for x in (F.lit(k), F.lit(v))])
    rows = lay.select("*", F.explode_outer(F.transform(
        "classes", lambda c, i: F.struct((i + 1).alias("class_no"), c.alias("c")))).alias("x"))
    return rows.select(
        F.col(C.SUMMARY_TOTAL_FIELD).alias("total_rows"), *[f"{s}_rows" for s in C.STATES],
        mapping[F.col("layer")].alias("layer_no"), "layer", "assigned_records",
        "unique_class_count", F.col("x.class_no").alias("class_no"), F.col("x.c.name").alias("name"),
        F.col("x.c.chemont_id").alias("chemont_id"), F.col("x.c.label_count").alias("label_count"))


def summary_or_recompute(spark: SparkSession, release_dir: str, dataset: DataFrame | None,
                         manifest_counts: DataFrame | None, total_rows: int | None,
                         summary_name: str = "progress-summary") -> DataFrame:
    """Stored summary if the release has one, else recompute it from the dataset, the manifest
    counts and a given total (which is then required)."""
    from . import report, taxonomy
    path = release_dir.rstrip("/") + "/" + summary_name
    if path_exists(spark, path):
        return read_summary(spark, path)
    if total_rows is None or dataset is None or manifest_counts is None:
        raise ValueError("no stored summary: dataset, manifest counts and total rows are needed")
    counts = report.with_total(manifest_counts, total_rows)
    ranked = taxonomy.taxonomy_ranked(taxonomy.taxonomy_counts(
        taxonomy.taxonomy_nodes(taxonomy.taxonomy_long(dataset))))
    return report.summary_document(spark, counts, ranked)

