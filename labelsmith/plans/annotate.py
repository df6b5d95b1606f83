"""Batch plans over fixture T: submissions -> parsed -> looked up -> classified -> rolled up.

Each function returns a lazy DataFrame; nothing is cached or collected. Physical shape of the
main plan: parquet scans (column-pruned) -> answers read where scanned (state, reason, nodes) and
reduced to one light row per key -> shuffle join on the key -> optional aggregation on (layer, class).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .. import fixtures
from ..operators import lookup, parse, taxonomy
from ..operators.states import state_counts  # noqa: F401 - part of the plans' interface


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_submissions(fixtures.submissions(spark, sf_dir))


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every submission row with ``state`` (incl. pending) and ``reason``."""
    return lookup.annotate(parsed(spark, sf_dir), fixtures.responses(spark, sf_dir))


def land_annotation(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """Write the light annotation (no bodies) once, partitioned by state, and read it back.

    Readers then prune: counts read only the partition column, the taxonomy reads ``state=success``,
    so a report built from it does not evaluate the lookup join a second time.
    """
    annotated(spark, sf_dir).select("row_index", "reason", "nodes", "state").write.mode("overwrite").partitionBy("state").parquet(out)
    return spark.read.parquet(out)


def terminal_states(ann: DataFrame) -> DataFrame:
    """``(row_index, state, reason)`` for rows that reached a terminal state."""
    return ann.where(F.col("state") != C.PENDING).select("row_index", "state", "reason")


def records(ann: DataFrame) -> DataFrame:
    return parse.success_records(ann)


def land_records(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """The success records written once and read back: shards are cut from stored records, so that their
    positions cost a scan of narrow columns and not the lookup join again."""
    records(annotated(spark, sf_dir)).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def land_outcomes(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    """Every row with its state, reason and, of a successful one, its answer, written once and read back: for plans
    that need the records and the counts of all states."""
    ann = annotated(spark, sf_dir)
    body = F.when(F.col("state") == C.SUCCESS, F.col("body")).alias("body")
    ann.select("row_index", "cid", "inchi", "inchikey", "fetched_at", body, "state", "reason").write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = parse.success_nodes(annotated(spark, sf_dir))
    nodes = taxonomy.taxonomy_nodes(taxonomy.taxonomy_long(recs))
    return taxonomy.taxonomy_counts(nodes)


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.taxonomy_ranked(class_counts(spark, sf_dir))
