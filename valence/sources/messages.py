"""Message sources: Kafka, or any file format Spark streams."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import MESSAGE

# Topic names and options of the message topics.
INPUT_TOPIC, RESULT_TOPIC = "sentiment_inputs", "sentiment_results"
SERVERS_VARIABLE, DEFAULT_SERVERS = "KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"
READ_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def kafka_options(topic: str | None = None, servers: str | None = None) -> dict[str, str]:
    servers = servers or os.environ.get(SERVERS_VARIABLE, DEFAULT_SERVERS)
    return {"kafka.bootstrap.servers": servers} | ({"topic": topic} if topic else {})


def kafka_stream(spark: SparkSession, topic: str = INPUT_TOPIC, servers: str | None = None, **options: str) -> DataFrame:
    """Raw Kafka records. Needs the Kafka connector on the class path.

    One task reads one topic partition; ``minPartitions`` splits large ones, and
    ``maxOffsetsPerTrigger`` bounds a batch.
    """
    settings = kafka_options(servers=servers) | READ_OPTIONS | {"subscribe": topic} | options
    return spark.readStream.format("kafka").options(**settings).load()


# A batch of a file source reads so many new files at most, also where it starts on a long backlog.
FILES_PER_BATCH = "1000"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, format: str = "json", **options: str) -> DataFrame:
    """Stream new files of a folder, or of what a path pattern matches."""
    settings = {"maxFilesPerTrigger": FILES_PER_BATCH} | options
    return spark.readStream.format(format).schema(schema).options(**settings).load(path)


def message_stream(spark: SparkSession, format: str, path: str | None = None, **options: str) -> DataFrame:
    """Messages from ``kafka``, ``json``, ``parquet`` or ``text`` (one JSON object per line)."""
    if format == "kafka":
        return decode(kafka_stream(spark, **options))
    if path is None:
        raise ValueError(f"source format {format!r} needs a path")
    if format == "text":
        return decode(file_stream(spark, path, T.StructType([T.StructField("value", T.StringType())]), "text", **options))
    return file_stream(spark, path, MESSAGE, format, **options)


def decode(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Message columns of JSON values; a malformed value gives nulls and stays a row."""
    data = F.from_json(F.col("value").cast("string"), MESSAGE, {"mode": "PERMISSIVE"})
    return records.select(*keep, data.alias("data")).select(*keep, "data.*")
