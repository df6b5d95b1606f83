"""Test inputs derived from the driver's tables (see FIXTURES.md).

* ``T``: ``submissions(row_index, line)`` and ``responses(inchikey, status, content_type, body)``
  from orders + customer + nation + region.
* ``A``: ``attempts(attempt_id, ts, row_key, state, kind, message)`` from events.
* ``H``: answer-like bodies from pages.html and documents.text.

Every frame is built with the DataFrame API so that the work grows with the given tables; the
same definitions as SQL text (``*_CTE``) feed the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import held
from .session import table_path


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the synthetic key and the dimension names used in answers."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation/region are fixed 25/5-row dimensions: joined first into one tiny frame so the
    # order rows meet a single small side (AQE / size threshold decide on broadcast).
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        "c_custkey", "c_mktsegment", "n_name", "r_name")
    j = o.join(cust, o.o_custkey == cust.c_custkey)
    ri = F.col("o_orderkey")
    src = F.when(ri % 101 == 5, ri - 1).otherwise(ri)
    k = F.upper(F.translate(F.md5(src.cast("string")), "0123456789", "ghijklmnop"))
    inchikey = F.concat(F.substring(k, 1, 14), F.lit("-"), F.substring(k, 15, 10), F.lit("-"),
                        F.substring(k, 25, 1))
    return j.select(ri.alias("row_index"), inchikey.alias("inchikey"), "r_name", "n_name",
                    "c_mktsegment", "o_orderpriority")


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_index BIGINT, line STRING)``: tab-separated input lines with injected bad shapes."""
    k = keyed_orders(spark, sf_dir)
    ri = F.col("row_index")
    ris = ri.cast("string")
    tab = F.lit("\t")
    inchi = F.concat(F.lit("InChI=1S/C"), ris)
    line = (
        F.when(ri % 97 == 1, F.lit("bad-row"))
        .when(ri % 89 == 2, F.concat(F.lit("x"), ris, tab, inchi, tab, F.col("inchikey")))
        .when(ri % 83 == 3, F.concat(ris, tab, F.lit(" "), tab, F.col("inchikey")))
        .when(ri % 79 == 4, F.concat(ris, tab, inchi, tab, F.lit("bad")))
        .otherwise(F.concat(ris, tab, inchi, tab, F.col("inchikey")))
    )
    return k.select(ri, line.alias("line"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(inchikey, status INT, content_type, body, fetched_at)``: one stored answer per looked-up key."""
    k = held(keyed_orders(spark, sf_dir), "inchikey")  # a filter on the key does not hash the number again
    ri = F.col("row_index")
    status = (F.when(ri % 11 == 0, 404).when(ri % 13 == 0, 429).when(ri % 17 == 0, 500)
              .otherwise(200).cast("int"))
    ctype = F.when(ri % 19 == 0, "text/html").otherwise("application/json")
    sup = F.when(ri % 2 == 0, F.col("n_name")).otherwise(F.lower("n_name"))
    cls = F.when(ri % 3 == 0, F.lit("null")).otherwise(
        F.concat(F.lit('{"name":"'), F.col("c_mktsegment"), F.lit('","chemont_id":null}')))
    dp = F.when(ri % 41 == 0, F.lit(" ")).otherwise(F.col("o_orderpriority"))
    classified = F.concat(
        F.lit('{"kingdom":{"name":"'), F.col("r_name"), F.lit('","chemont_id":"ID:'),
        F.col("r_name"), F.lit('"},"superclass":{"name":" '), sup, F.lit(' "},"class":'), cls,
        F.lit(',"direct_parent":{"name":"'), dp, F.lit('"}}'))
    body = (
        F.when(ri % 19 == 0, F.lit("<html><head><title>Gateway</title></head></html>"))
        .when(ri % 23 == 0, F.lit("{"))
        .when(ri % 29 == 0, F.lit("   "))
        .when(ri % 31 == 0, F.lit('{"kingdom":null,"superclass":null}'))
        .otherwise(classified)
    )
    # Keys of rows 37k never got an answer (pending); rows 101k+5 repeat the previous key,
    # whose answer is already stored once.
    return k.where((ri % 37 != 0) & (ri % 101 != 5)).select(
        "inchikey", status.alias("status"), ctype.alias("content_type"), body.alias("body"),
        F.concat(F.lit("2024-01-"), F.lpad((ri % 28 + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z")).alias("fetched_at"))


def prior_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows an earlier run already finished: orders placed before 1998 (``row_index``)."""
    o = _read(spark, sf_dir, "orders")
    return o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("row_index"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup attempt log derived from events (fixture A)."""
    e = _read(spark, sf_dir, "events")
    et = F.col("event_type")
    state = (F.when(et.isin("purchase", "signup"), "success").when(et == "view", "miss")
             .when(et == "click", "invalid").otherwise("failed"))
    kind = F.when(et.isin("error", "click"), "error").otherwise("event")
    eid = F.col("event_id")
    message = (
        F.when(et == "click", F.lit("invalid inchikey format in PubChem input"))
        .when(et != "error", F.lit(None).cast("string"))
        .when(eid % 4 == 0, F.lit("entity request was throttled"))
        .when(eid % 4 == 1, F.lit("entity request returned HTML (title: Gateway)"))
        .when(eid % 4 == 2, F.lit("operation timed out"))
        .otherwise(F.lit("entity request failed with status 500"))
    )
    return e.select(eid.alias("attempt_id"), "ts", F.col("user_id").alias("row_key"),
                    state.alias("state"), kind.alias("kind"), message.alias("message"))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture H: ``(src, body_id, content_type, body)`` from pages and documents."""
    pages = _read(spark, sf_dir, "pages").select(
        F.lit("pages").alias("src"), F.col("page_id").alias("body_id"),
        F.lit(None).cast("string").alias("content_type"), F.col("html").alias("body"))
    docs = _read(spark, sf_dir, "documents").select(
        F.lit("documents").alias("src"), F.col("doc_id").alias("body_id"),
        F.lit(None).cast("string").alias("content_type"), F.col("text").alias("body"))
    return pages.unionByName(docs)


# ---------------------------------------------------------------------------------------------
# SQL text of the same fixtures (DuckDB dialect; also valid Spark SQL). Used by the oracle.
# ---------------------------------------------------------------------------------------------

T_CTE = """
k0 AS (SELECT o.o_orderkey AS row_index,
    upper(translate(md5(cast(CASE WHEN o.o_orderkey % 101 = 5 THEN o.o_orderkey - 1 ELSE o.o_orderkey END AS string)),
                    '0123456789','ghijklmnop')) AS k,
    r.r_name, n.n_name, c.c_mktsegment, o.o_orderpriority
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
k1 AS (SELECT *, concat(substr(k,1,14),'-',substr(k,15,10),'-',substr(k,25,1)) AS inchikey FROM k0),
submissions AS (SELECT row_index, CASE
    WHEN row_index % 97 = 1 THEN 'bad-row'
    WHEN row_index % 89 = 2 THEN concat('x',cast(row_index AS string),chr(9),'InChI=1S/C',cast(row_index AS string),chr(9),inchikey)
    WHEN row_index % 83 = 3 THEN concat(cast(row_index AS string),chr(9),' ',chr(9),inchikey)
    WHEN row_index % 79 = 4 THEN concat(cast(row_index AS string),chr(9),'InChI=1S/C',cast(row_index AS string),chr(9),'bad')
    ELSE concat(cast(row_index AS string),chr(9),'InChI=1S/C',cast(row_index AS string),chr(9),inchikey) END AS line FROM k1),
responses AS (SELECT inchikey,
    CAST(CASE WHEN row_index % 11 = 0 THEN 404 WHEN row_index % 13 = 0 THEN 429 WHEN row_index % 17 = 0 THEN 500 ELSE 200 END AS INTEGER) AS status,
    CASE WHEN row_index % 19 = 0 THEN 'text/html' ELSE 'application/json' END AS content_type,
    CASE WHEN row_index % 19 = 0 THEN '<html><head><title>Gateway</title></head></html>'
         WHEN row_index % 23 = 0 THEN '{'
         WHEN row_index % 29 = 0 THEN '   '
         WHEN row_index % 31 = 0 THEN '{"kingdom":null,"superclass":null}'
         ELSE concat('{"kingdom":{"name":"',r_name,'","chemont_id":"ID:',r_name,'"},"superclass":{"name":" ',
              CASE WHEN row_index % 2 = 0 THEN n_name ELSE lower(n_name) END,' "},"class":',
              CASE WHEN row_index % 3 = 0 THEN 'null' ELSE concat('{"name":"',c_mktsegment,'","chemont_id":null}') END,
              ',"direct_parent":{"name":"',CASE WHEN row_index % 41 = 0 THEN ' ' ELSE o_orderpriority END,'"}}') END AS body,
    concat('2024-01-', lpad(cast(row_index % 28 + 1 AS string), 2, '0'), 'T00:00:00Z') AS fetched_at
  FROM k1 WHERE row_index % 37 <> 0 AND row_index % 101 <> 5)"""

PRIOR_CTE = """
prior_rows AS (SELECT o_orderkey AS row_index FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00')"""

A_CTE = """
attempts AS (SELECT event_id AS attempt_id, ts, user_id AS row_key,
    CASE event_type WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'success' WHEN 'view' THEN 'miss'
                    WHEN 'click' THEN 'invalid' ELSE 'failed' END AS state,
    CASE WHEN event_type IN ('error','click') THEN 'error' ELSE 'event' END AS kind,
    CASE WHEN event_type = 'click' THEN 'invalid inchikey format in PubChem input'
         WHEN event_type <> 'error' THEN cast(NULL AS string)
         WHEN event_id % 4 = 0 THEN 'entity request was throttled'
         WHEN event_id % 4 = 1 THEN 'entity request returned HTML (title: Gateway)'
         WHEN event_id % 4 = 2 THEN 'operation timed out'
         ELSE 'entity request failed with status 500' END AS message
  FROM events)"""

H_CTE = """
bodies AS (SELECT 'pages' AS src, page_id AS body_id, cast(NULL AS string) AS content_type, html AS body FROM pages
  UNION ALL SELECT 'documents', doc_id, cast(NULL AS string), text FROM documents)"""
