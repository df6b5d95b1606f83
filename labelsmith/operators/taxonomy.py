"""Five-layer taxonomy roll-up (F1-F5) and class ranking.

One scan of the records feeds all five layers: the nodes that annotation read from the answer (or
that are read here, once, from a stored body) are unpivoted with ``inline`` and grouped
on ``(layer, class_key)``. Partial aggregation runs map-side, so the shuffle carries at most one
row per (task, layer, class): the skew of a hot class never reaches a single reducer.
Windows (ranking, shares) run only on the aggregated classes, whose number is bounded by the
taxonomy's vocabulary, not by the record count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import ascii_lower, display_class_name, read_answers, with_taxonomy

def layers_dim(spark: SparkSession) -> DataFrame:
    """Five-row layer dimension ``(layer_no, layer, label, panel_limit)``."""
    return spark.createDataFrame(list(C.LAYERS),
                                 "layer_no INT, layer STRING, label STRING, panel_limit INT")


def with_nodes(records: DataFrame, body_col: str = C.ANSWER_FIELD, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(row_index, nodes)`` and the columns to ``keep``: the nodes as annotation left them, or read from the stored answer."""
    if "nodes" in records.columns:
        return records.select("row_index", *keep, "nodes")
    read = read_answers(records.select("row_index", *keep, body_col), body=body_col)
    return with_taxonomy(read, body=body_col).select("row_index", *keep, "nodes")


def _unpivoted(records: DataFrame, body_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    tax = F.col("nodes")
    nodes = F.array(*[
        F.struct(F.lit(no).alias("layer_no"), F.lit(name).alias("layer"), tax[name]["name"].alias("name"),
                 tax[name]["chemont_id"].alias("chemont_id"), tax[name]["bad"].alias("bad"))
        for no, name, _, _ in C.LAYERS
    ])
    return with_nodes(records, body_col, keep).select("row_index", *keep, F.inline(nodes)).where("bad is not null")


def taxonomy_long(records: DataFrame, body_col: str = C.ANSWER_FIELD, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(row_index, layer_no, layer, name, chemont_id)``: one row per present node, and the columns to ``keep``.

    A node that is no object with a string ``name`` fails the query, in the same pass; with
    ``strict=False`` it is left to ``bad_nodes`` and not returned.
    """
    long = _unpivoted(records, body_col, keep)
    if not strict:
        return long.where("not bad").drop("bad")
    checked = F.when(~F.col("bad"), F.col("name")).otherwise(F.raise_error(F.concat(
        F.lit("taxonomy node without a name: row "), F.col("row_index").cast("string"), F.lit(", "), F.col("layer"))))
    return long.withColumn("name", checked).drop("bad")


def taxonomy_nodes(long: DataFrame) -> DataFrame:
    """Display name (trimmed, blank -> ``<unnamed>``) and grouping key per node."""
    disp = display_class_name(F.col("name"))
    return long.withColumn("name", disp).withColumn(
        "class_key", F.coalesce(F.col("chemont_id"), ascii_lower(F.col("name"))))


def bad_nodes(records: DataFrame, body_col: str = C.ANSWER_FIELD) -> DataFrame:
    """``(row_index, layer_no, layer)`` of the nodes that exist but are no object with a string name."""
    return _unpivoted(records, body_col).where("bad").select("row_index", "layer_no", "layer")


def check_nodes(records: DataFrame, body_col: str = C.ANSWER_FIELD) -> None:
    """Raise when any present node has no string ``name``."""
    first = bad_nodes(records, body_col).first()
    if first:
        raise ValueError(f"taxonomy node without a name: row {first.row_index}, {first.layer}")


def spelling_counts(nodes: DataFrame, *by: str) -> DataFrame:
    """``(layer_no, layer, class_key, name, chemont_id, n, first_row)``, for each value of ``by`` where given.

    A hash aggregate with numbers alone as its state. Counts of disjoint sets of records add up: sum of
    ``n``, least ``first_row``."""
    return nodes.groupBy(*by, "layer_no", "layer", "class_key", "name", "chemont_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_index").alias("first_row"))


def class_counts(spelled: DataFrame) -> DataFrame:
    """Counts per class of ``spelling_counts``; the first record's spelling is picked among the few of a class."""
    first = F.min_by(F.struct("name", "chemont_id"), F.col("first_row"))
    return (spelled.groupBy("layer_no", "layer", "class_key")
            .agg(F.sum("n").alias("label_count"), first.alias("f"))
            .select("layer_no", "layer", "class_key", "f.name", "f.chemont_id", "label_count"))


def taxonomy_counts(nodes: DataFrame) -> DataFrame:
    """``(layer_no, layer, class_key, name, chemont_id, label_count)``.

    Name and id shown for a class are those of its first record (smallest ``row_index``).
    """
    return class_counts(spelling_counts(nodes))


def layer_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("layer_no", "layer").agg(
        F.sum("label_count").cast("long").alias("assigned_records"),
        F.count(F.lit(1)).alias("unique_class_count"))


def all_layers(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """All five layers in fixed order, zeros for empty ones."""
    totals = layer_totals(counts).drop("layer")
    return (layers_dim(spark).join(totals, "layer_no", "left")
            .select("layer_no", "layer",
                    F.coalesce("assigned_records", F.lit(0).cast("long")).alias("assigned_records"),
                    F.coalesce("unique_class_count", F.lit(0).cast("long")).alias("unique_class_count")))


def taxonomy_ranked(counts: DataFrame) -> DataFrame:
    """Rank classes per layer: count desc, then name (byte order), then key for equal pairs."""
    w = Window.partitionBy("layer_no").orderBy(F.desc("label_count"), "name", "class_key")
    return counts.withColumn("rk", F.row_number().over(w))


def with_panel_limit(spark: SparkSession, ranked: DataFrame) -> DataFrame:
    lim = layers_dim(spark).select("layer_no", "panel_limit")
    return ranked.join(F.broadcast(lim), "layer_no")


def taxonomy_topk(spark: SparkSession, ranked: DataFrame) -> DataFrame:
    """First N classes per layer (6, 5 for direct_parent)."""
    return (with_panel_limit(spark, ranked).where(F.col("rk") <= F.col("panel_limit"))
            .drop("panel_limit"))


def taxonomy_tail(spark: SparkSession, ranked: DataFrame) -> DataFrame:
    """Hidden classes per layer: how many, their labels, and whether a tail exists."""
    r = with_panel_limit(spark, ranked)
    hidden = F.col("rk") > F.col("panel_limit")
    agg = r.groupBy("layer_no", "layer").agg(
        F.count_if(hidden).alias("tail_classes"),
        F.sum(F.when(hidden, F.col("label_count")).otherwise(0)).cast("long").alias("tail_labels"))
    return agg.withColumn("has_tail", F.col("tail_classes") > 0)


def class_share(ranked: DataFrame) -> DataFrame:
    """Share of each class in its layer's assigned records."""
    total = F.sum("label_count").over(Window.partitionBy("layer_no"))
    return ranked.withColumn("share", F.col("label_count") / total)


def cumulative_share(ranked: DataFrame) -> DataFrame:
    """Running share in rank order: start = labels before / total, end = labels through / total."""
    total = F.sum("label_count").over(Window.partitionBy("layer_no"))
    run = F.sum("label_count").over(
        Window.partitionBy("layer_no").orderBy("rk")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranked.withColumn("_total", total).withColumn("_run", run)
            .withColumn("start_share", (F.col("_run") - F.col("label_count")) / F.col("_total"))
            .withColumn("end_share", F.col("_run") / F.col("_total"))
            .drop("_total", "_run"))
