"""Helpers shared by the operators of this package."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelsmith.session import scratch_dir


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` would change other letters too).

    A text of ASCII alone takes the built-in, which works on bytes.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the cluster's shared checkpoint folder, and read again.

    Cuts the lineage: an executor lost later costs nothing but a new read.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` landed with a row key, and the name of the key's column, which ``df`` doesn't have.

    Ids may be null or repeat; a stage that drops rows names them by this key, written once.
    """
    row = "row"
    while row in df.columns:
        row += "_"
    return landed(df.withColumn(row, F.monotonically_increasing_id()), name), row


def crc32_mod(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus
