"""Session helpers: a tuned local session for tests/bench and a shared scratch area.

Scratch data (file round trips, stream checkpoints, landed inputs) goes below the folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is absent and Spark runs in
local mode (tests, bench) is a private temporary folder created and registered.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "labelsmith"):
    """Session for tests and the bench: local master, AQE on, UTC clock, no UI."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in _SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_query_conf(spark: SparkSession) -> None:
    """Settings every query relies on (UTC clock for 18:00 boundaries, AQE for join choice)."""
    for key, value in _SESSION_CONF.items():
        if key == "spark.sql.execution.arrow.pyspark.enabled":
            continue
        spark.conf.set(key, value)
        if spark.conf.get(key) != value and key == "spark.sql.session.timeZone":
            raise RuntimeError(f"{key} must be {value}; the session holds {spark.conf.get(key)}")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; created only for local sessions."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="labelsmith-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root.rstrip("/"), "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"
