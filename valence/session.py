"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Matches the Spark build: streaming jobs load it with spark.jars.packages.
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"

_local_base: str | None = None


def build_session(app: str, master: str | None = None, kafka: bool = False, **conf: str) -> SparkSession:
    """A session for the jobs. ``conf`` keys use ``__`` for dots; paths may be any Hadoop file system."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if kafka:
        builder = builder.config("spark.jars.packages", KAFKA_PACKAGE)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that results depend on; everything else is left to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def prepare_streaming(spark: SparkSession) -> SparkSession:
    """Keep streaming state outside the JVM heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return prepare(spark)


def work_dir(spark: SparkSession, label: str, base: str | None = None) -> str:
    """A new path for one run under ``base`` or ``spark.checkpoint.dir``, a folder all executors share.

    Only a local session without that setting gets a folder of its own.
    """
    global _local_base
    base = base or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _local_base = _local_base or tempfile.mkdtemp(prefix="valence-")
        base = _local_base
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
