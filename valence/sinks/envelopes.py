"""JSON envelopes for clients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.analyze import server_view

_JSON = {"ignoreNullFields": "false"}
# The fields of an event, in order.
EVENT_FIELDS = (
    "id", "text", "source", "user", "timestamp", "sentiment", "emoji", "label", "polarity", "confidence",
    "positive_score", "negative_score", "keywords",
)


def event_json(analyzed: DataFrame, time: Column, *keep: str) -> DataFrame:
    """Scored rows as event objects, whose ``timestamp`` is ``time``."""
    events = server_view(analyzed).withColumn("timestamp", time)
    return events.select(*keep, "id", F.to_json(F.struct(*EVENT_FIELDS), _JSON).alias("event"))


def new_events(events: DataFrame) -> DataFrame:
    """One ``NEW_EVENT`` envelope per event (``id, event, metrics``), with the metrics after it."""
    body = F.concat(
        F.lit('{"type":"NEW_EVENT","data":'), F.col("event"), F.lit(',"metrics":'), F.col("metrics"), F.lit("}")
    )
    return events.select("id", body.alias("envelope"))


def initial_state(events: DataFrame, metrics: Column, *order: str) -> DataFrame:
    """One ``INITIAL_STATE`` envelope, newest event first. Only for the bounded history."""
    entries = F.collect_list(F.struct(*order, "event"))
    history = F.transform(F.sort_array(entries, asc=False), lambda e: e["event"])
    return events.agg(F.array_join(history, ",").alias("history")).select(
        F.concat(
            F.lit('{"type":"INITIAL_STATE","history":['), F.col("history"), F.lit('],"metrics":'), metrics, F.lit("}")
        ).alias("envelope")
    )
