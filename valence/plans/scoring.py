"""Scored rows of the feed, documents and conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.sentiment import register_sql, with_sentiment
from ..operators.analyze import analyze, encode_analyzed, score_texts
from ..sources.tables import event_feed, table
from . import sql
from .registry import query

_FLAT = ("sentiment", "emoji", "label", "polarity", "confidence", "pos_score", "neg_score")


def flat_keywords() -> Column:
    return F.array_join("keywords", ",").alias("keywords")


def flat_score(df: DataFrame, *keep: str) -> DataFrame:
    """Score struct as columns, keywords as one text."""
    score = lambda name: F.col(f"analysis.{name}")
    return df.select(
        *keep,
        *[score(name).alias(name) for name in ("sentiment", "emoji", "label", "polarity", "confidence")],
        score("positive_score").alias("pos_score"),
        score("negative_score").alias("neg_score"),
        F.array_join(score("keywords"), ",").alias("keywords"),
    )


def analyzed_feed(spark: SparkSession, folder: str, rounding: str = "exact") -> DataFrame:
    return analyze(
        event_feed(spark, folder), processed_at=F.col("event_ts"), keep=("event_ts", "event_id"), rounding=rounding
    )


def _feed_rows(spark: SparkSession, folder: str, rounding: str) -> DataFrame:
    return analyzed_feed(spark, folder, rounding).select(
        "id", "text", "source", "user", "input_timestamp", *_FLAT, flat_keywords()
    )


_FEED_COLUMNS = f'id, text, source, "user", "timestamp" AS input_timestamp, {sql.SCORE_COLUMNS}'


@query(f"WITH {sql.SCORED_FEED} SELECT {_FEED_COLUMNS} FROM scored")
def scored_feed(spark: SparkSession, folder: str) -> DataFrame:
    return _feed_rows(spark, folder, "exact")


@query(
    f"WITH {sql.FEED}, {sql.score('feed', 'id', rounding='binary')} "
    f"SELECT {_FEED_COLUMNS} FROM feed JOIN score ON k = id"
)
def scored_feed_binary(spark: SparkSession, folder: str) -> DataFrame:
    """Scores in double arithmetic, rounded half to even."""
    return _feed_rows(spark, folder, "binary")


@query(f"WITH {sql.score('documents', 'doc_id')} SELECT k AS doc_id, {sql.SCORE_COLUMNS} FROM score")
def scored_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return flat_score(with_sentiment(documents), "doc_id")


@query(f"WITH {sql.score('documents', 'doc_id')} SELECT k AS doc_id, {sql.SCORE_COLUMNS} FROM score")
def sql_function(spark: SparkSession, folder: str) -> DataFrame:
    """The documents, scored by the SQL function."""
    register_sql(spark, "sentiment")
    documents = table(spark, folder, "documents")
    return flat_score(spark.sql("SELECT doc_id, sentiment(text) AS analysis FROM {documents}", documents=documents), "doc_id")


_TURN_KEY = "conv_id || '_' || turn"


@query(
    f"WITH {sql.score('conversations', _TURN_KEY)} SELECT conv_id, turn, {sql.SCORE_COLUMNS} "
    f"FROM conversations JOIN score ON k = {_TURN_KEY}"
)
def scored_conversations(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return flat_score(with_sentiment(turns), "conv_id", "turn")


@query(
    f"WITH {sql.score('conversations', _TURN_KEY)} SELECT conv_id, turn, "
    "CASE WHEN role = 'user' THEN 'ManualInput' ELSE role END AS source, 'LiveTester' AS \"user\", "
    f"{sql.SCORE_COLUMNS} FROM conversations JOIN score ON k = {_TURN_KEY}"
)
def adhoc_score(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as score requests; those of users give no source."""
    requests = table(spark, folder, "conversations").select(
        "conv_id", "turn", "text", F.nullif(F.col("role"), F.lit("user")).alias("source")
    )
    return flat_score(score_texts(requests), "conv_id", "turn", "source", "user")


_PAYLOAD = f"""WITH {sql.SCORED_FEED}
SELECT id AS "key", to_json(struct_pack(id := id, text := text, source := source, "user" := "user",
  input_timestamp := "timestamp", processed_at := strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%fZ'), sentiment := sentiment,
  emoji := emoji, label := label, polarity := CAST(polarity AS DOUBLE), confidence := CAST(confidence AS DOUBLE),
  pos_score := CAST(pos_score AS DOUBLE), neg_score := CAST(neg_score AS DOUBLE), keywords := keywords))::VARCHAR
  AS "value" FROM scored"""


@query(_PAYLOAD)
def payload_json(spark: SparkSession, folder: str) -> DataFrame:
    """Kafka records of the scored feed. The processing time is the event time, so that runs repeat."""
    return encode_analyzed(analyzed_feed(spark, folder))
