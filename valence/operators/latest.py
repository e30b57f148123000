"""Newest rows: history, feed and timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.arithmetic import literal
from ..functions.text import escape_html, signed_text, time_of_day
from .messages import CHANNEL_SOURCE, CHANNEL_USER, DISPLAY_TIME

# Sizes of the history, the feed and the timeline.
HISTORY_SIZE, FEED_SIZE, TIMELINE_SIZE = 100, 50, 25

DISPLAY_DEFAULTS = {"source": CHANNEL_SOURCE["display"], "user": CHANNEL_USER["display"]}


def latest(rows: DataFrame, k: int, ts: str, *ties: str, arrival: str | None = None) -> DataFrame:
    """The ``k`` newest rows, newest first.

    A row without a time counts by the column ``arrival``; without that as well
    it is older than any other, but not lost. A first pass reads the time columns
    only and finds the time of the k-th row. The second pass pushes that time
    down to the scan, so that wide columns are read from few row groups. Call it
    before scoring: then k texts are scored.
    """
    kind = rows.schema[ts].dataType
    came = F.coalesce(*([F.col(arrival).cast(kind)] if arrival else []), F.lit("0001-01-01 00:00:00").cast(kind))
    time = F.coalesce(F.col(ts), came)
    cutoff = rows.select(time.alias("time")).orderBy(F.desc("time")).limit(k).agg(F.min("time")).scalar()
    kept = rows.where((F.col(ts) >= cutoff) | (F.col(ts).isNull() & (came >= cutoff)))
    return kept.orderBy(time.desc(), *[F.desc(c) for c in ties]).limit(k)


def feed_view(analyzed: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Display columns of scored rows."""
    shown = lambda name: escape_html(f"coalesce(nullif({name}, ''), {literal(DISPLAY_DEFAULTS[name])})")
    return analyzed.selectExpr(
        "id",
        f"coalesce({time_of_day(ts)}, {literal(DISPLAY_TIME)}) AS time",
        f"{escape_html('text')} AS text_html",
        f"{shown('source')} AS source",
        f"{shown('user')} AS user",
        "emoji",
        "sentiment",
        f"{signed_text('polarity')} AS polarity_text",
        "confidence",
    )
