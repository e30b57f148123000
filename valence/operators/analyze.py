"""Messages to scored rows, the same in batch and in streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sentiment import with_sentiment
from ..schemas import ANALYZED


def analyze(
    messages: DataFrame,
    processed_at: Column | None = None,
    keep: tuple[str, ...] = (),
    rounding: str = "exact",
) -> DataFrame:
    """Score messages into the ``ANALYZED`` columns, and pass the columns ``keep`` on."""
    scored = with_sentiment(messages, rounding=rounding)
    score = lambda name: F.col(f"analysis.{name}")
    return scored.select(
        "id", "text", "source", "user",
        F.col("timestamp").alias("input_timestamp"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
        *[score(name) for name in ("sentiment", "emoji", "label", "polarity", "confidence")],
        score("positive_score").alias("pos_score"),
        score("negative_score").alias("neg_score"),
        score("keywords"),
        *keep,
    )


def score_texts(requests: DataFrame, source: str = "ManualInput", user: str = "LiveTester") -> DataFrame:
    """Score ad-hoc requests: ``text`` and, where given, ``source`` and ``user``."""
    given = lambda name, default: F.coalesce(F.col(name), F.lit(default)) if name in requests.columns else F.lit(default)
    return with_sentiment(requests.withColumns({"source": given("source", source), "user": given("user", user)}))


def server_view(analyzed: DataFrame) -> DataFrame:
    """Scored rows under the names of the server's events."""
    return analyzed.drop("processed_at").withColumnsRenamed(
        {"input_timestamp": "timestamp", "pos_score": "positive_score", "neg_score": "negative_score"}
    )


def encode_analyzed(analyzed: DataFrame) -> DataFrame:
    """Kafka records of scored rows: the key is the id, the value a JSON object with all columns."""
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    return analyzed.select(
        F.col("id").alias("key"), F.to_json(F.struct(*ANALYZED.names), options).alias("value")
    )
