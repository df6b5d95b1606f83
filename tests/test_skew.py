"""A key held by a third of the rows: the lookup join is split by AQE and stays exact."""

from pyspark.sql import functions as F

from labelsmith import config as C
from labelsmith.operators import lookup, parse

HOT = "HHHHHHHHHHHHHH-OOOOOOOOOO-T"
BODY = '{"kingdom":{"name":"Things"}}'


def _key(i):
    s = "".join(chr(65 + (i // 26 ** k) % 26) for k in range(14))
    return f"{s}-KKKKKKKKKK-E"


def _moved_bodies(plan: str) -> int:
    """Exchanges below which a body comes up, in the plan as first made."""
    lines = plan.split("== Initial Plan ==")[-1].splitlines()
    return sum("Exchange hashpartitioning" in x and any("body#" in y for y in lines[i + 1:i + 2]) for i, x in enumerate(lines))


def test_stored_answers_are_moved_once(spark, tmpdir_path):
    answers = spark.createDataFrame([(_key(i), 200, "application/json", BODY[:-1] + f',"n":{i},"v":{v}}}', when) for i in range(50) for v, when in ((1, "2024-01-01"), (2, "2024-02-01"), (2, "2024-02-01"))]
                                    + [("bad", 200, None, "x", "2025-01-01"), (_key(60), None, None, None, None)],
                                    "inchikey STRING, status INT, content_type STRING, body STRING, fetched_at STRING")
    answers.repartition(3).write.parquet(tmpdir_path + "/a")
    stored = spark.read.parquet(tmpdir_path + "/a")
    rows = spark.createDataFrame([(i, f"{i}\tInChI\t{_key(i % 70)}" if i % 7 else "broken") for i in range(400)], "row_index long, line string")
    parsed = parse.parse_submissions(rows)
    cols = ["row_index", "inchikey", "status", "content_type", "body", "fetched_at"]
    got, want = lookup.stored_lookup_join(parsed, stored), lookup.lookup_join(parsed, stored)
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(map(tuple, want.select(*cols).collect()), key=repr)
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        again = lookup.stored_lookup_join(parsed, stored)
        assert _moved_bodies(again._jdf.queryExecution().executedPlan().toString()) == 1
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_join_is_split_and_exact(spark):
    n = 30000
    rows = spark.range(n).select(
        F.col("id").alias("row_index"),
        F.when(F.col("id") % 3 == 0, F.lit(f"1\tInChI\t{HOT}"))
        .otherwise(F.concat(F.lit("1\tInChI\t"), F.col("id").cast("string"))).alias("line"))
    # every third row is the hot key; the others are invalid (no key shape) and must not join
    answers = spark.createDataFrame([(HOT, 200, "application/json", BODY)] * 50
                                    + [(_key(i), 404, None, "") for i in range(2000)],
                                    "inchikey STRING, status INT, content_type STRING, body STRING")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ann = lookup.annotate(parse.parse_submissions(rows), answers)
        got = {r.state: r["count"] for r in ann.groupBy("state").count().collect()}
        assert got == {C.SUCCESS: n // 3, C.INVALID: n - n // 3}
        assert len(ann.collect()) == n
        plan = ann._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan
        assert "isSkew=true" in plan or "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
