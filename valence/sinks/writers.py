"""Batch sinks and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import work_dir
from ..sources.messages import INPUT_TOPIC, kafka_options


def write_kafka(records: DataFrame, topic: str = INPUT_TOPIC, servers: str | None = None) -> None:
    """Write ``key, value`` records to a topic. Needs the Kafka connector on the class path."""
    records.write.format("kafka").options(**kafka_options(topic, servers)).save()


def write_table(rows: DataFrame, path: str, partition_by: str | None = None, mode: str = "append") -> None:
    """Write Parquet, so that later time filters and column choices reach the scan."""
    writer = rows.write.mode(mode)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def stage(rows: DataFrame, label: str, base: str | None = None) -> DataFrame:
    """Write rows to the shared work folder and read them back: later passes start there, also after a lost executor."""
    path = work_dir(rows.sparkSession, label, base)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def preview(rows: DataFrame, n: int = 20) -> None:
    """Print ``n`` rows in full."""
    rows.show(n, truncate=False)
