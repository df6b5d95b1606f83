"""Progress numbers, metric panels and report rows.

All inputs here are already aggregated (one row of counts, or one row per class), so these are
narrow projections; the only aggregate over row-level data is ``crawl_counts`` (partial + final,
no key, so nothing is shuffled but one row per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import format_count, format_percent, safe_ratio
from . import taxonomy


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a keyless aggregate (exactly one row) to every row of ``df``.

    The aggregate becomes a scalar subquery: it runs once, its single value is embedded in the
    projection, and no join (let alone a pairing of two data sets) is planned.
    """
    cols = [c for c in one_row.columns if c not in df.columns]
    packed = one_row.select(F.struct(*cols).alias("__one_row")).scalar()
    return df.select("*", packed.alias("__one_row")).select(
        *[F.col(c) for c in df.columns], *[F.col("__one_row")[c].alias(c) for c in cols])


def crawl_counts(annotated: DataFrame) -> DataFrame:
    """One row: ``total_rows`` (every input row) and the four terminal counts, one pass."""
    st = F.col("state")
    return annotated.agg(F.count(F.lit(1)).alias("total_rows"),
                         *[F.count_if(st == s).alias(f"{s}_rows") for s in C.STATES])


def with_total(counts: DataFrame, total_rows: int) -> DataFrame:
    """Replace the counted total by an override; it must be positive."""
    if total_rows is None or int(total_rows) <= 0:
        raise ValueError("total rows must be greater than zero")
    return counts.withColumn("total_rows", F.lit(int(total_rows)).cast("long"))


def progress_metrics(counts: DataFrame) -> DataFrame:
    """handled = all four; executed = success+miss+failed; completed = success+miss+invalid;
    pending = max(total - handled, 0)."""
    s, m, i, f = (F.col(f"{x}_rows") for x in C.STATES)
    return counts.select(
        "total_rows", "success_rows", "miss_rows", "invalid_rows", "failed_rows",
        (s + m + i + f).alias("handled_rows"),
        (s + m + f).alias("executed_rows"),
        (s + m + i).alias("completed_rows"),
        F.greatest(F.col("total_rows") - (s + m + i + f), F.lit(0)).cast("long").alias("pending_rows"))


def progress_ratios(metrics: DataFrame) -> DataFrame:
    """coverage = success / total; request_success = success / executed; 0 on a 0 denominator."""
    return metrics.select(
        safe_ratio("success_rows", "total_rows").alias("coverage"),
        safe_ratio("success_rows", "executed_rows").alias("request_success"))


def _panel(metrics: DataFrame, name: str, slices: list[tuple[str, str]], center: tuple[str, str],
           note: F.Column | None) -> DataFrame:
    arr = F.array(*[
        F.struct(F.lit(no).alias("slice_no"),
                 F.concat(F.lit(f"{label}: "), format_count(F.col(col))).alias("label"),
                 F.col(col).cast("long").alias("value"))
        for no, (label, col) in enumerate(slices)])
    center_text = format_percent(*center)
    return metrics.select(F.lit(name).alias("panel"), center_text.alias("center_value"),
                          (note if note is not None else F.lit(None).cast("string")).alias("note"),
                          F.inline(arr))


def coverage_panel(metrics: DataFrame) -> DataFrame:
    """Slices Collected, Pending, Miss, Failed, Invalid; centre = success / total."""
    return _panel(metrics, "coverage",
                  [("Collected", "success_rows"), ("Pending", "pending_rows"),
                   ("Miss", "miss_rows"), ("Failed", "failed_rows"), ("Invalid", "invalid_rows")],
                  ("success_rows", "total_rows"), None)


def request_panel(metrics: DataFrame) -> DataFrame:
    """Slices Success, Miss, Failed; centre = success / executed; note = invalid rows."""
    note = F.concat(F.lit("Invalid rows skipped before request: "), format_count("invalid_rows"))
    return _panel(metrics, "requests",
                  [("Success", "success_rows"), ("Miss", "miss_rows"), ("Failed", "failed_rows")],
                  ("success_rows", "executed_rows"), note)


def taxonomy_report(spark: SparkSession, ranked: DataFrame) -> DataFrame:
    """Printed rows per layer: shown classes, then one tail row when hidden labels exist.

    ``(layer_no, layer, line_no, label, percent, count)``; percent of the layer's records with
    two decimals, count with thousands separators. One pass over the ranked classes: layer
    totals and tail figures are windows on the rank partitioning, and the tail row is emitted
    from the first hidden class, so no branch recomputes the classes.
    """
    r = taxonomy.with_panel_limit(spark, ranked)
    w = Window.partitionBy("layer_no")
    hidden = F.col("rk") > F.col("panel_limit")
    r = (r.withColumn("assigned", F.sum("label_count").over(w))
         .withColumn("tail_classes", F.count(F.when(hidden, 1)).over(w))
         .withColumn("tail_labels", F.sum(F.when(hidden, F.col("label_count")).otherwise(0)).over(w)))
    shown = F.col("rk") <= F.col("panel_limit")
    first_hidden = (F.col("rk") == F.col("panel_limit") + 1) & (F.col("tail_labels") > 0)
    rows = r.where(shown | first_hidden)
    return rows.select(
        "layer_no", "layer",
        F.when(shown, F.col("rk")).cast("int").alias("line_no"),
        F.when(shown, F.col("name")).otherwise(
            F.concat(F.lit("Tail: "), format_count("tail_classes"), F.lit(" classes"))).alias("label"),
        F.when(shown, format_percent("label_count", "assigned")).otherwise(
            format_percent("tail_labels", "assigned")).alias("percent"),
        F.when(shown, format_count("label_count")).otherwise(format_count("tail_labels")).alias("count"))


def summary_rows(spark: SparkSession, counts: DataFrame, ranked: DataFrame) -> DataFrame:
    """Long form of the progress summary: one row per (layer, class); empty layers keep one row
    with NULL class fields. Counts and the total repeat on each row (they are one row).

    One pass over the ranked classes: layer totals are windows, and the five-row layer table
    (broadcast) is the preserved side of an outer join so empty layers survive."""
    w = Window.partitionBy("layer_no")
    classes = ranked.select(
        "layer_no", F.col("rk").alias("class_no"), "name", "chemont_id", "label_count",
        F.sum("label_count").over(w).cast("long").alias("assigned_records"),
        F.count(F.lit(1)).over(w).alias("unique_class_count"))
    dim = F.broadcast(taxonomy.layers_dim(spark).select("layer_no", "layer"))
    body = classes.join(dim, "layer_no", "right").select(
        "layer_no", "layer",
        F.coalesce("assigned_records", F.lit(0).cast("long")).alias("assigned_records"),
        F.coalesce("unique_class_count", F.lit(0).cast("long")).alias("unique_class_count"),
        "class_no", "name", "chemont_id", "label_count")
    return attach_one_row(body, counts).select(
        "total_rows", *[f"{s}_rows" for s in C.STATES], "layer_no", "layer",
        "assigned_records", "unique_class_count", "class_no", "name", "chemont_id",
        "label_count")


def summary_document(spark: SparkSession, counts: DataFrame, ranked: DataFrame,
                     generated_at: str | None = None) -> DataFrame:
    """The nested summary: one row with counts and five layers, each with its sorted classes.

    One pass over the ranked classes (layer totals are windows; the five-row layer table is the
    preserved side of an outer join). The class lists are gathered per layer after aggregation;
    their length is the number of distinct classes (bounded by the taxonomy vocabulary), never
    the number of records.
    """
    w = Window.partitionBy("layer_no")
    cls = F.struct(F.col("name"), F.col("chemont_id"), F.col("label_count"))
    per_layer = (ranked.select("layer_no", F.struct("rk", cls.alias("c")).alias("rc"),
                               F.sum("label_count").over(w).cast("long").alias("assigned"),
                               F.count(F.lit(1)).over(w).alias("uniq"))
                 .groupBy("layer_no")
                 .agg(F.sort_array(F.collect_list("rc")).alias("cs"),
                      F.max("assigned").alias("assigned_records"),
                      F.max("uniq").alias("unique_class_count")))
    dim = F.broadcast(taxonomy.layers_dim(spark).select("layer_no", "layer"))
    empty = F.array().cast("array<struct<name:string,chemont_id:string,label_count:bigint>>")
    layers = per_layer.join(dim, "layer_no", "right").select(
        "layer_no", F.struct(
            "layer",
            F.coalesce("assigned_records", F.lit(0).cast("long")).alias("assigned_records"),
            F.coalesce("unique_class_count", F.lit(0).cast("long")).alias("unique_class_count"),
            F.coalesce(F.transform("cs", lambda x: x["c"]), empty).alias("classes")).alias("l"))
    doc_layers = layers.agg(F.sort_array(F.collect_list(F.struct("layer_no", "l"))).alias("ls"))
    ts = F.lit(generated_at) if generated_at else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return attach_one_row(doc_layers, counts).select(
        ts.alias("generated_at"),
        F.col("total_rows").alias(C.SUMMARY_TOTAL_FIELD),
        F.struct(*[f"{s}_rows" for s in C.STATES]).alias("counts"),
        F.transform("ls", lambda x: x["l"]).alias("taxonomy_layers"))
