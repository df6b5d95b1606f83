"""Exact deduplication by skew-safe combining (operator 2)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, documents, keyed, landed


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64,
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per distinct text: ``digest, keep_id, group_size, n_texts, text``.

    Three stages, each comparing digest and whole text: Spark's map-side aggregate folds the copies
    within a task; salted digest groups merge what the tasks send (the salt is the task's number,
    so a text that a third of all rows share meets in ``salts`` places, with a row per task); the
    winners of the salts meet globally, at most ``salts`` rows per text. ``n_texts`` counts the
    different texts of one digest, and ``text`` is kept only where that is more than one.
    """
    norm = docs.select(F.col(id_col).alias("id"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    salted = (norm.select("id", "norm", digest(F.col("norm")).alias("digest"),
                          F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
              .groupBy("digest", "norm", "salt").agg(F.max("id").alias("id"), F.count("*").alias("n")))
    classes = (salted.repartition("digest").groupBy("digest", "norm")
               .agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size")))
    n_texts = F.count("*").over(Window.partitionBy("digest"))
    return classes.withColumn("n_texts", n_texts).select(
        "digest", "keep_id", "group_size", "n_texts", F.when(F.col("n_texts") > 1, F.col("norm")).alias("text"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                payload: tuple[str, ...] = (), salts: int = 64,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``id_col, keep_id, group_size, kept, text_sha256`` and the ``payload`` columns, per row.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the
    row with the largest id stays. Null ids lose against any id; a group of null ids alone keeps
    ``keep_id`` null and all its rows. Rows that repeat an id together with its text are the same
    document and share ``kept``. An empty table gives an empty result; columns other than the named
    ones are neither read nor returned, so their names cannot clash.

    Classes come from ``text_classes``; rows find theirs by digest. Should different texts share a
    digest (possible with a short ``digest``), their rows are compared by whole text as well.
    """
    classes = landed(text_classes(docs, id_col, text_col, salts, digest), "text-classes")
    own = F.struct(F.col(id_col).alias("id"), *[F.col(c) for c in payload]).alias("own")
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(own, norm.alias("norm")).select(
        "own", "norm", digest(F.col("norm")).alias("digest"), sha256(F.col("norm")).alias("sha"))
    found = rows.drop("norm").join(classes.where("n_texts = 1").drop("text", "n_texts"), "digest")
    if not classes.where("n_texts > 1").isEmpty():
        alike = classes.where("n_texts > 1").select("digest", F.col("text").alias("norm"), "keep_id", "group_size")
        found = found.unionByName(rows.join(alike, ["digest", "norm"]).drop("norm"))
    return found.select(
        F.col("own.id").alias(id_col), "keep_id", "group_size", F.col("own.id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"), *[F.col(f"own.{c}").alias(c) for c in payload])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each distinct text, with its columns unchanged.

    The row with the largest id stays; of rows that share it (or have none, where no row of the text has
    one) the one with the largest hash of its text, then the last written. Rows are told apart by a key that is
    written with them. Null texts count as empty; an empty table gives an empty result; a text of any length
    is compared whole.
    """
    rows, row = keyed(docs, "exact-rows")
    light = rows.select(F.col(id_col), F.col(text_col), F.col(row).alias("row"), F.xxhash64(text_col).alias("hash"))
    stays = (exact_dedup(light, id_col, text_col, payload=("hash", "row")).where("kept")
             .groupBy("text_sha256").agg(F.max(F.struct("hash", "row")).alias("best")).select(F.col("best.row").alias(row)))
    return rows.join(stays, row, "left_semi").select(*docs.columns)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


OP2_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
