"""Session settings the plans rely on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more exchange: a third
    # of all rows on one key must not become one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Stream state lies on disk: it may outgrow memory.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings a session takes only when it is built.
BUILD_CONF = {
    # Plans are built from many small expressions; skip the call-site lookup of each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above; safe to call repeatedly."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(app: str = "shelfline", cpus: int | str = "*", shuffle: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle))
    )
    for name, value in {**RUNTIME_CONF, **BUILD_CONF}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    On a cluster this lies under ``spark.checkpoint.dir``. Only a local master
    may fall back to this machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/shelfline/{label}-{uuid.uuid4().hex[:12]}"
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        return tempfile.mkdtemp(prefix=f"shelfline-{label}-")
    raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate that several branches read, and continue from the table.

    The result is computed once, its lineage ends at files that outlive any executor,
    and its measured size guides the joins above it.
    """
    path = f"{work_dir(df.sparkSession, label)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
