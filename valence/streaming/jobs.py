"""Structured Streaming queries. Every query has its own checkpoint folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from ..operators.analyze import analyze, encode_analyzed
from ..operators.keywords import keyword_counts
from ..operators.metrics import count_columns
from ..session import prepare_streaming
from ..sources.messages import RESULT_TOPIC, kafka_options

Sink = Callable[[DataFrame, int], None]

# At most 148 keywords: more state partitions would be empty.
KEYWORD_PARTITIONS = 4
# The rows of resets lie in folders of days; up to so many are named to the scan.
_DAY, MOST_DAYS = "yyyyMMdd", 1000
_SLIM = "source string, event_ts timestamp, sentiment string, polarity double, batch int, day string"


def start(
    stream: DataFrame,
    format: str,
    checkpoint: str,
    path: str | None = None,
    mode: str = "append",
    once: bool = False,
    **options: str,
) -> StreamingQuery:
    """Start a query; ``once`` reads what is there and ends."""
    writer = stream.writeStream.format(format).outputMode(mode).options(**options)
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()


def start_console(analyzed: DataFrame, checkpoint: str, **kwargs) -> StreamingQuery:
    return start(analyzed, "console", checkpoint, truncate="false", **kwargs)


def start_parquet(analyzed: DataFrame, path: str, checkpoint: str, **kwargs) -> StreamingQuery:
    """Exactly once: the file sink keeps a log of the files of each batch."""
    return start(analyzed, "parquet", checkpoint, path, **kwargs)


def start_kafka(analyzed: DataFrame, checkpoint: str, topic: str = RESULT_TOPIC, servers: str | None = None, **kwargs):
    """At least once: a batch that is repeated after a failure writes its records again."""
    return start(encode_analyzed(analyzed), "kafka", checkpoint, **kafka_options(topic, servers), **kwargs)


def own_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A session whose streams split their state into so many partitions; other sessions keep their number.

    A checkpoint keeps the first value. State of a few keys needs few partitions.
    """
    own = prepare_streaming(spark.newSession())
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def start_batches(
    stream: DataFrame, write: Sink, checkpoint: str, mode: str = "append", once: bool = False
) -> StreamingQuery:
    """Start a query that hands each batch to ``write``."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def fan_out(*sinks: Sink) -> Sink:
    """Score a batch once for several sinks. A single sink gets the batch as it comes, without a copy of it."""
    if len(sinks) == 1:
        return sinks[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def run_folder(path: str, checkpoint: str) -> str:
    """A folder in ``path`` for the runs that share a checkpoint, whose batch numbers go on from run to run."""
    return f"{path.rstrip('/')}/run={hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:16]}"


def batch_folder(path: str, *partition_by: str) -> Sink:
    """Write each batch to its own folder; repeating a batch overwrites it, so it counts once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch={batch_id}")

    return write


def snapshot_folder(path: str) -> Sink:
    """Keep the newest snapshot of a complete-mode query, and the one before it until the next is written."""

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch", F.lit(batch_id).cast("bigint"))
        numbered.write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")

    return write


def console_sink(n: int = 20) -> Sink:
    return lambda batch, batch_id: batch.show(n, truncate=False)


def kafka_sink(topic: str = RESULT_TOPIC, servers: str | None = None) -> Sink:
    def write(batch: DataFrame, batch_id: int) -> None:
        encode_analyzed(batch).write.format("kafka").options(**kafka_options(topic, servers)).save()

    return write


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot that ``snapshot_folder`` keeps; there are two at most, however long the query has run."""
    rows = spark.read.parquet(path)
    return rows.where(F.col("batch") == rows.agg(F.max("batch")).scalar()).drop("batch", "slot")


def read_newest(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """Of rows that an update-mode query wrote with ``batch_folder``, the last one of each key."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    last = F.max_by(F.struct(*values), "batch").alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, "last.*")


def read_state(spark: SparkSession, checkpoint: str, value: str, key: str = "") -> DataFrame:
    """Rows of the state that a query with one stateful step has in its checkpoint after its last batch; no sink is needed.

    ``key`` and ``value`` list the columns with their types, in the order of the
    aggregation: what state calls them says nothing.
    """
    rows = spark.read.format("statestore").load(checkpoint)
    named = lambda column, fields: [f"inline(array(CAST({column} AS STRUCT<{', '.join(fields)}>)))"]
    typed = lambda text: [f"{name}: {kind}" for name, kind in (part.split() for part in text.split(", "))] if text else []
    if not key:
        return rows.selectExpr(*named("value", typed(value)))
    both = rows.selectExpr("value", *named("key", typed(key)))
    return both.selectExpr(*[part.split()[0] for part in key.split(", ")], *named("value", typed(value)))


# Transformations of streams

def score_stream(messages: DataFrame, **kwargs) -> DataFrame:
    return analyze(messages, **kwargs)


def metrics_stream(analyzed: DataFrame) -> DataFrame:
    """Running counts; complete mode, one row of state."""
    return analyzed.groupBy().agg(*count_columns())


def keyword_stream(analyzed: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Running keyword counts; complete mode, at most 148 rows of state."""
    return keyword_counts(analyzed, ts)


def throughput_stream(messages: DataFrame, ts: str = "event_ts", delay: str = "10 minutes") -> DataFrame:
    """Events per minute and source. A minute is final, and leaves the state, ``delay`` after its end."""
    minutes = messages.withWatermark(ts, delay).groupBy(F.window(ts, "60 seconds"), "source")
    return minutes.agg(F.count("*").alias("events")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "source", "events"
    )


def once_only(records: DataFrame, ts: str, *keys: str, delay: str = "10 minutes") -> DataFrame:
    """Each record once, also where an at-least-once sink has written a batch again.

    ``keys`` tell what was written apart: a record's place in its source, not a message's id,
    which may repeat. They are remembered for ``delay`` of event time. A record without a
    time can never leave the state, so it counts by the beginning of time and is passed on
    only while the watermark has not risen.
    """
    return records.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def routed(**channels: DataFrame) -> DataFrame:
    """Streams of messages as one, with the name of each as ``kind``; each keeps the watermark it has.

    The watermark of the whole is that of the slowest, so a busy feed does not make the
    commands late.
    """
    parts = [rows.withColumn("kind", F.lit(kind)) for kind, rows in channels.items()]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


# Metrics since the last reset of a source

def reset_sinks(path: str) -> Sink:
    """Write a batch of scored events and reset messages so that resets apply when reading.

    Columns: ``source, event_ts, is_reset, sentiment, polarity``. Counts per
    source and minute are additive, so no reset has to reach any state: a reset
    only moves the point from which minutes count. The slim rows, in a folder for
    each day, serve the one minute in which a reset falls.
    """

    def minutes(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("minute", F.date_trunc("minute", "event_ts"))
        as_event = marked.withColumn("sentiment", F.expr("CASE WHEN NOT is_reset THEN sentiment END"))
        as_event = as_event.withColumn("polarity", F.expr("CASE WHEN NOT is_reset THEN polarity END"))
        total, *others = count_columns()
        counts = as_event.groupBy("source", "minute").agg(
            F.count_if(~F.col("is_reset")).alias("total"), *others, F.expr("max(CASE WHEN is_reset THEN event_ts END)").alias("reset_at")
        )
        batch_folder(f"{path}/minutes")(counts, batch_id)

    def rows(batch: DataFrame, batch_id: int) -> None:
        events = batch.where(~F.col("is_reset")).withColumn("day", F.date_format("event_ts", _DAY))
        batch_folder(f"{path}/rows", "day")(events.select("source", "day", "event_ts", "sentiment", "polarity"), batch_id)

    return fan_out(minutes, rows)


def read_since_reset(spark: SparkSession, path: str) -> DataFrame:
    """Counts per source after its last reset, exact whatever order the messages came in.

    A source with no events since then shows zeros.
    """
    minutes = spark.read.parquet(f"{path}/minutes")
    marks = minutes.groupBy(F.col("source").alias("mark")).agg(F.max("reset_at").alias("reset_at")).where("reset_at IS NOT NULL")
    marks = marks.select("mark", "reset_at", F.date_trunc("minute", "reset_at").alias("edge"), F.date_format("reset_at", _DAY).alias("edge_day"))
    same_source = F.col("source").eqNullSafe(F.col("mark"))
    later = minutes.drop("reset_at").join(marks, same_source, "left").where("edge IS NULL OR minute > edge")
    # Of each source one minute counts in part: only the folders of the days of the resets are read.
    days = [r["edge_day"] for r in marks.select("edge_day").distinct().limit(MOST_DAYS).collect()]
    stored = spark.read.option("basePath", f"{path}/rows").schema(_SLIM).parquet(f"{path}/rows")
    stored = stored.where(F.col("day").isin(days)) if len(days) < MOST_DAYS else stored
    edge = (
        stored.join(marks, same_source & (F.col("day") == F.col("edge_day")))
        .where("date_trunc('minute', event_ts) = edge AND event_ts > reset_at")
        .groupBy("source")
        .agg(*count_columns())
    )
    names = ["total", "positive", "negative", "neutral", "polarity_milli"]
    none = marks.select(F.col("mark").alias("source"), *[F.lit(0).cast("bigint").alias(name) for name in names])
    both = later.select("source", *names).unionByName(edge.select("source", *names)).unionByName(none)
    return both.groupBy("source").agg(*[F.sum(name).alias(name) for name in names])
