"""Schemas of messages, scored rows and the labelled corpus."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.DoubleType()) for name in names]


_KEYWORDS = [T.StructField("keywords", T.ArrayType(T.StringType()))]

# Field names and order are the interface of the topics and files.
MESSAGE = T.StructType(_strings("id", "text", "source", "user", "timestamp"))
COMMAND = T.StructType(_strings("action", "text", "source"))
SCORE = T.StructType(
    _strings("sentiment", "emoji", "label")
    + _doubles("polarity", "confidence", "positive_score", "negative_score")
    + _KEYWORDS
)
ANALYZED = T.StructType(
    _strings("id", "text", "source", "user", "input_timestamp")
    + [T.StructField("processed_at", T.TimestampType())]
    + _strings("sentiment", "emoji", "label")
    + _doubles("polarity", "confidence", "pos_score", "neg_score")
    + _KEYWORDS
)
CORPUS = T.StructType(
    [T.StructField("target", T.IntegerType()), T.StructField("id", T.LongType())]
    + _strings("date", "flag", "user", "text")
)
