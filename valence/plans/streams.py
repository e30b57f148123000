"""Streaming queries over the given tables; each one reads what is there, ends, and gives what its sink holds."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators import classifier, messages, metrics as m
from ..operators.analyze import analyze
from ..operators.latest import HISTORY_SIZE
from ..session import prepare_streaming, work_dir
from ..sources.messages import decode, file_stream
from ..sources.tables import feed_of, table
from ..streaming import jobs, state
from . import sql
from .ingest import socket_records
from .learning import _fit
from .registry import ORACLES, query
from .reporting import _KEYWORDS, _MARKER, _RATE, IS_RESET, analyzed_feed

_NTZ = "timestamp_ntz"


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = table(spark, folder, name).schema
    # A pattern, as the file source takes a plain path for a folder, and the table may be one file.
    return file_stream(prepare_streaming(spark), f"{folder.rstrip('/')}/{name}.parque[t]", schema, "parquet")


def feed_stream(spark: SparkSession, folder: str) -> DataFrame:
    return feed_of(table_stream(spark, folder, "events"))


def analyzed_stream(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.score_stream(feed_stream(spark, folder), processed_at=F.col("event_ts"), keep=("event_ts",))


def _in_turn(spark: SparkSession, path: str, schema: StructType, *parts: str) -> Iterator[DataFrame]:
    """A stream for each part of a written table, to be run one after the other on one checkpoint.

    A part is a batch, however many files it has: with a batch for each file the batches grow with the table.
    The last part may name all files: those that were read before are known to the checkpoint.
    """
    for part in parts:
        yield file_stream(spark, f"{path}/{part}", schema, "parquet")


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", "text", "source", "user", "input_timestamp", "sentiment", "emoji", "label", "polarity", "confidence",
        "pos_score", "neg_score", F.array_join("keywords", ",").alias("keywords"),
    )


_FEED_ROWS = f"""WITH {sql.SCORED_FEED}
SELECT id, text, source, "user", "timestamp" AS input_timestamp, {sql.SCORE_COLUMNS} FROM scored"""


@query(_FEED_ROWS)
def score_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Feed stream, scored, to Parquet."""
    out = work_dir(spark, "score-stream")
    stream = analyzed_stream(spark, folder)
    jobs.start_parquet(stream, f"{out}/rows", f"{out}/checkpoint", once=True).awaitTermination()
    return _flat(spark.read.schema(stream.schema).parquet(f"{out}/rows"))


@query(_FEED_ROWS)
def score_stream_json(spark: SparkSession, folder: str) -> DataFrame:
    """Messages as JSON lines in files, streamed, decoded and scored."""
    out = work_dir(spark, "score-stream-json")
    feed = feed_of(table(spark, folder, "events"))
    feed.select(F.to_json(F.struct("id", "text", "source", "user", "timestamp")).alias("value")).write.text(f"{out}/in")
    lines = file_stream(prepare_streaming(spark), f"{out}/in", spark.read.text(f"{out}/in").schema, "text")
    stream = jobs.score_stream(decode(lines))
    jobs.start_parquet(stream, f"{out}/rows", f"{out}/checkpoint", once=True).awaitTermination()
    return _flat(spark.read.schema(stream.schema).parquet(f"{out}/rows"))


@query(f"""WITH {sql.SCORED_FEED}, k AS ({sql.kpi('scored')}), c AS ({sql.kpi('scored', 'source')})
SELECT 'all' AS source, * FROM k UNION ALL SELECT * FROM c""")
def two_sinks_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Each batch is scored once and goes to two sinks: the rows, and counts per source."""
    out = work_dir(spark, "two-sinks")

    def counts(batch: DataFrame, batch_id: int) -> None:
        jobs.batch_folder(f"{out}/counts")(batch.groupBy("source").agg(*m.count_columns()), batch_id)

    sinks = jobs.fan_out(jobs.batch_folder(f"{out}/rows"), counts)
    jobs.start_batches(analyzed_stream(spark, folder), sinks, f"{out}/checkpoint", once=True).awaitTermination()
    rows = jobs.read_batches(spark, f"{out}/rows").withColumn("source", F.lit("all"))
    names = ["total", "positive", "negative", "neutral", "polarity_milli"]
    summed = jobs.read_batches(spark, f"{out}/counts").groupBy("source").agg(*[F.sum(n).alias(n) for n in names])
    return m.kpi(rows, "source").unionByName(m.finish_counts(summed, "source"))


@query(f"WITH {sql.SCORED_FEED} {sql.kpi('scored')}")
def metrics_stream(spark: SparkSession, folder: str) -> DataFrame:
    out = work_dir(spark, "metrics-stream")
    counts = jobs.metrics_stream(analyzed_stream(spark, folder))
    write = jobs.snapshot_folder(f"{out}/rows")
    jobs.start_batches(counts, write, f"{out}/checkpoint", mode="complete", once=True).awaitTermination()
    return m.finish_counts(jobs.read_snapshot(spark, f"{out}/rows"))


@query(f"{_KEYWORDS} SELECT keyword, cnt, first_seen FROM counts")
def keyword_stream(spark: SparkSession, folder: str) -> DataFrame:
    out = work_dir(spark, "keyword-stream")
    own = jobs.own_session(spark, jobs.KEYWORD_PARTITIONS)
    counts = jobs.keyword_stream(analyzed_stream(own, folder))
    write = jobs.snapshot_folder(f"{out}/rows")
    jobs.start_batches(counts, write, f"{out}/checkpoint", mode="complete", once=True).awaitTermination()
    rows = jobs.read_snapshot(spark, f"{out}/rows")
    return rows.select("keyword", "cnt", F.col("first_seen").cast(_NTZ).alias("first_seen"))


@query("""WITH w AS (SELECT time_bucket(INTERVAL 60 SECOND, ts) AS window_start, event_type AS source, count(*) AS events
  FROM events GROUP BY ALL)
SELECT window_start, window_start + INTERVAL 60 SECOND AS window_end, source, events FROM w""")
def throughput_stream(spark: SparkSession, folder: str) -> DataFrame:
    """All minutes, those that are still open included: each batch writes the minutes that it changed."""
    out = work_dir(spark, "throughput-stream")
    minutes = jobs.throughput_stream(feed_stream(spark, folder))
    write = jobs.batch_folder(f"{out}/rows")
    jobs.start_batches(minutes, write, f"{out}/checkpoint", mode="update", once=True).awaitTermination()
    rows = jobs.read_newest(spark, f"{out}/rows", "window_start", "window_end", "source")
    return rows.withColumns({name: F.col(name).cast(_NTZ) for name in ("window_start", "window_end")})


@query(f"""WITH {sql.SCORED_FEED},
r AS (SELECT event_type AS source, max(ts) AS reset_at FROM events WHERE {_MARKER} GROUP BY ALL),
since AS (SELECT scored.* FROM scored JOIN events USING (event_id) LEFT JOIN r USING (source)
          WHERE NOT coalesce({_MARKER}, false) AND (reset_at IS NULL OR event_ts > reset_at)),
k AS ({sql.kpi('since', 'source')}), s AS (SELECT DISTINCT event_type AS source FROM events)
SELECT source, coalesce(total, 0) AS total, coalesce(positive, 0) AS positive, coalesce(negative, 0) AS negative,
  coalesce(neutral, 0) AS neutral, coalesce(positive_pct, 0.0) AS positive_pct, coalesce(negative_pct, 0.0) AS negative_pct,
  coalesce(neutral_pct, 0.0) AS neutral_pct, coalesce(avg_polarity, 0.0) AS avg_polarity FROM s LEFT JOIN k USING (source)""")
def reset_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics per source since its last reset; an event whose property k is 0 is a reset message of its source."""
    out = work_dir(spark, "reset-stream")
    events = table_stream(spark, folder, "events")
    feed = feed_of(events, keep=(f"{IS_RESET} AS is_reset",))
    scored = analyze(feed, keep=("event_ts", "is_reset"))
    slim = scored.select("source", "event_ts", "is_reset", "sentiment", "polarity")
    jobs.start_batches(slim, jobs.reset_sinks(out), f"{out}/checkpoint", once=True).awaitTermination()
    return m.finish_counts(jobs.read_since_reset(spark, out), "source")


@query(ORACLES["history_latest"])
def history_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The newest events, kept as a list in the state of a stream that is stopped and started again after each part."""
    out = work_dir(spark, "history-stream")
    own = jobs.own_session(spark, 1)
    # Several parts, so that there are several batches, and rows that the state has to give up.
    given = table(spark, folder, "events")
    given.withColumn("slice", F.col("event_id") % 4).write.partitionBy("slice").parquet(f"{out}/events")
    for events in _in_turn(own, f"{out}/events", given.schema, "slice=[0]", "slice=[1]", "slice=[2]", "slice=*"):
        feed = feed_of(events).select("id", "text", "source", "user", "timestamp", "event_ts", "event_id")
        newest = state.history_stream(feed, HISTORY_SIZE, "event_ts", "event_id")
        write = jobs.snapshot_folder(f"{out}/rows")
        jobs.start_batches(newest, write, f"{out}/checkpoint", mode="update", once=True).awaitTermination()
    kept = jobs.read_snapshot(spark, f"{out}/rows").where(F.col("place") < HISTORY_SIZE)
    rows = analyze(kept, processed_at=F.col("event_ts"), keep=("event_ts",))
    return rows.withColumn("keywords", F.array_join("keywords", ",")).select(
        "id", "text", "source", "user", F.col("event_ts").cast(_NTZ).alias("event_ts"), "sentiment", "emoji", "label",
        "polarity", "confidence", "pos_score", "neg_score", "keywords",
    )


@query(f"""WITH newest AS (SELECT event_type AS source, max(ts) AS event_ts FROM events GROUP BY ALL),
n AS (SELECT source, event_ts, count(*) AS events_60s FROM newest JOIN events ON event_type = source AND ts >= event_ts - INTERVAL 60 SECOND
  GROUP BY ALL)
SELECT source, event_ts, events_60s, {_RATE('events_60s')} AS throughput_eps, {_RATE('least(events_60s, 60)')} AS throughput_eps_saturated FROM n""")
def throughput_now_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Rate of the last minute of each source, as the stream's state holds it after the last batch."""
    out = work_dir(spark, "throughput-now")
    # Later days first: what comes in the second and third batch is older than what the state holds, or interleaved with it.
    given = table(spark, folder, "events")
    events = given.withColumn("slice", F.expr("CASE WHEN event_id % 3 = 0 THEN 0 ELSE day(ts) % 2 + 1 END"))
    own = jobs.own_session(spark, 2)
    events.write.partitionBy("slice").parquet(f"{out}/events")
    write = jobs.batch_folder(f"{out}/rows")
    for stream in _in_turn(own, f"{out}/events", given.schema, "slice=[2]", "slice=[1]", "slice=*"):
        now = state.throughput_now(feed_of(stream), delay="90 days")
        jobs.start_batches(now, write, f"{out}/checkpoint", mode="update", once=True).awaitTermination()
    rows = jobs.read_newest(spark, f"{out}/rows", "source")
    return rows.withColumn("event_ts", F.col("event_ts").cast(_NTZ))


@query(ORACLES["reset_stream"])
def reset_state_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the reset applied in the stream's state, and messages that come out of order over three batches."""
    out = work_dir(spark, "reset-state")
    own = jobs.own_session(spark, 2)
    given = table(spark, folder, "events")
    given.withColumn("slice", F.expr("event_id * 7 % 3")).write.partitionBy("slice").parquet(f"{out}/events")
    write = jobs.batch_folder(f"{out}/rows")
    for events in _in_turn(own, f"{out}/events", given.schema, "slice=[0]", "slice=[1]", "slice=*"):
        scored = analyze(feed_of(events, keep=(f"{IS_RESET} AS is_reset",)), keep=("event_ts", "is_reset"))
        counts = state.since_reset(scored.select("source", "event_ts", "is_reset", "sentiment", "polarity"), delay="90 days")
        jobs.start_batches(counts, write, f"{out}/checkpoint", mode="update", once=True).awaitTermination()
    return m.finish_counts(jobs.read_newest(spark, f"{out}/rows", "source"), "source")


@query(ORACLES["metrics_stream"])
def metrics_from_state(spark: SparkSession, folder: str) -> DataFrame:
    """The metrics as the running query's checkpoint holds them; its sink keeps nothing."""
    out = work_dir(spark, "metrics-state")
    own = jobs.own_session(spark, 1)
    jobs.start(jobs.metrics_stream(analyzed_stream(own, folder)), "noop", f"{out}/checkpoint", mode="complete", once=True).awaitTermination()
    counts = "total bigint, positive bigint, negative bigint, neutral bigint, polarity_milli bigint"
    return m.finish_counts(jobs.read_state(own, f"{out}/checkpoint", counts))


@query(f"{_KEYWORDS} SELECT keyword, cnt, first_seen FROM counts")
def keywords_from_state(spark: SparkSession, folder: str) -> DataFrame:
    out = work_dir(spark, "keywords-state")
    own = jobs.own_session(spark, jobs.KEYWORD_PARTITIONS)
    jobs.start(jobs.keyword_stream(analyzed_stream(own, folder)), "noop", f"{out}/checkpoint", mode="complete", once=True).awaitTermination()
    rows = jobs.read_state(own, f"{out}/checkpoint", "cnt bigint, first_seen timestamp, place decimal(38,0)", key="keyword string")
    return rows.select("keyword", "cnt", F.col("first_seen").cast(_NTZ).alias("first_seen"))


@query(ORACLES["kpi_by_source"])
def replayed_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Scored records of a sink that wrote a part of them twice; each counts once."""
    out = work_dir(spark, "replayed")
    scored = analyzed_feed(spark, folder).select("event_id", "source", "event_ts", "sentiment", "polarity")
    scored.write.parquet(f"{out}/records/batch=0")
    again = spark.read.parquet(f"{out}/records/batch=0")
    again.where("event_id % 3 = 0").write.parquet(f"{out}/records/batch=1")
    own = jobs.own_session(spark, 4)

    def counts(batch: DataFrame, batch_id: int) -> None:
        jobs.batch_folder(f"{out}/counts")(batch.groupBy("source").agg(*m.count_columns()), batch_id)

    for records in _in_turn(own, f"{out}/records", again.schema, "batch=[0]", "batch=*"):
        once = jobs.once_only(records, "event_ts", "event_id", delay="90 days")
        jobs.start_batches(once, counts, f"{out}/checkpoint", once=True).awaitTermination()
    names = ["total", "positive", "negative", "neutral", "polarity_milli"]
    summed = jobs.read_batches(spark, f"{out}/counts").groupBy("source").agg(*[F.sum(n).alias(n) for n in names])
    return m.finish_counts(summed, "source")


@query(f"""WITH {sql.FEED}, {sql.score("""(SELECT id, text FROM feed UNION ALL
  SELECT 'cmd_' || conv_id || '_' || turn, CASE WHEN turn % 4 = 2 THEN '' ELSE text END FROM conversations WHERE role = 'user')""", "id")},
u AS (SELECT 'feed' AS kind, id, text, source, "user" FROM feed UNION ALL
  SELECT 'command', 'cmd_' || conv_id || '_' || turn, CASE WHEN turn % 4 = 2 THEN '' ELSE text END,
    CASE WHEN turn = 0 THEN 'WebClient' ELSE 'turn_' || turn END, 'dashboard_user' FROM conversations WHERE role = 'user')
SELECT kind, id, text, source, "user", {sql.SCORE_COLUMNS} FROM u JOIN score ON k = id""")
def routed_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The feed and the socket's commands in one query: scored together, each once, and written apart by kind."""
    out = work_dir(spark, "routed")
    own = jobs.own_session(spark, 4)
    feed = feed_stream(own, folder).select("id", "text", "source", "user", "timestamp", "event_ts").withWatermark("event_ts", "90 days")
    sent = socket_records(table_stream(own, folder, "conversations"))
    sent = sent.withColumn("event_ts", F.expr("timestamp_seconds(1704067200 + turn)"))
    texts = messages.commands(sent, keep=("conv_id", "turn", "event_ts")).withWatermark("event_ts", "1 hour")
    texts = texts.selectExpr(
        "concat('cmd_', conv_id, '_', turn) AS id", "text", "source", "user", "CAST(NULL AS STRING) AS timestamp", "event_ts"
    )
    both = jobs.routed(feed=feed, command=texts).dropDuplicatesWithinWatermark(["kind", "id"])
    scored = jobs.score_stream(both, processed_at=F.col("event_ts"), keep=("kind",))
    jobs.start_batches(scored, jobs.batch_folder(f"{out}/rows", "kind"), f"{out}/checkpoint", once=True).awaitTermination()
    rows = jobs.read_batches(spark, f"{out}/rows")
    return rows.withColumn("keywords", F.array_join("keywords", ",")).select(
        "kind", "id", "text", "source", "user", "sentiment", "emoji", "label", "polarity", "confidence", "pos_score", "neg_score", "keywords"
    )


@query()
def classify_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The trained classifier on a stream of all documents."""
    model, _ = _fit(spark, folder)
    out = work_dir(spark, "classify-stream")
    stream = classifier.classify(model, table_stream(spark, folder, "documents"), keep=("doc_id",))
    jobs.start_parquet(stream, f"{out}/rows", f"{out}/checkpoint", once=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")
