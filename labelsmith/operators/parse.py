"""Input parsing and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import strip_line_end, trim_ws, valid_key

_INT_PATTERN = r"^[+-]?[0-9]+$"


def split_fields(line) -> tuple[Column, Column, Column]:
    """At most three tab-separated parts; the third keeps later tabs. Missing parts are NULL."""
    parts = F.split(strip_line_end(line), "\t", 3)
    return F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)


def parse_submissions(rows: DataFrame, line_col: str = "line") -> DataFrame:
    """Add ``cid BIGINT, inchi, inchikey`` and ``invalid_reason`` (NULL for a valid row).

    Checks run in the original order: integer id, second field, third field, non-empty fields,
    key shape. Parsing is a pure projection: no shuffle, stays inside whole-stage codegen.
    """
    p1, p2, p3 = split_fields(F.col(line_col))
    t1, t2, t3 = trim_ws(p1), trim_ws(p2), trim_ws(p3)
    cid = F.when(t1.rlike(_INT_PATTERN), t1.try_cast("bigint"))
    parsed = rows.withColumns({"cid": cid, "inchi": t2, "inchikey": t3})
    reason = (
        F.when(F.col("cid").isNull(), F.lit(C.MSG_CID_NOT_INTEGER))
        .when(F.col("inchi").isNull(), F.lit(C.MSG_MISSING_INCHI))
        .when(F.col("inchikey").isNull(), F.lit(C.MSG_MISSING_INCHIKEY))
        .when((F.col("inchi") == "") | (F.col("inchikey") == ""), F.lit(C.MSG_EMPTY_FIELD))
        .when(~valid_key(F.col("inchikey")), F.lit(C.MSG_BAD_KEY))
    )
    return parsed.withColumn("invalid_reason", reason)


def quarantine_split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) as two filters over one plan; invalid rows never reach the lookup."""
    return (parsed.where(F.col("invalid_reason").isNull()),
            parsed.where(F.col("invalid_reason").isNotNull()))


def quarantine_counts(parsed: DataFrame) -> DataFrame:
    """Rows per side of the split, one aggregate over one scan."""
    side = F.when(F.col("invalid_reason").isNull(), "valid").otherwise("invalid")
    return parsed.groupBy(side.alias("split")).agg(F.count(F.lit(1)).alias("rows"))


def success_records(classified: DataFrame) -> DataFrame:
    """Successful rows projected to the record layout; the answer body is kept verbatim."""
    cols = ["row_index", "cid", "inchi", "inchikey", F.col("body").alias(C.ANSWER_FIELD)]
    if "fetched_at" in classified.columns:
        cols.insert(4, "fetched_at")
    return classified.where(F.col("state") == C.SUCCESS).select(*cols)


def success_nodes(classified: DataFrame) -> DataFrame:
    """``(row_index, nodes)`` of successful rows: all that the taxonomy report needs of a record."""
    return classified.where(F.col("state") == C.SUCCESS).select("row_index", "nodes")
