"""Given tables, and the event feed derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.arithmetic import literals
from ..functions.text import iso_utc
from ..operators.messages import message_id
from .samples import FEED_PHRASES


# Unset by default. A caller that reads files of one row group each, which no scan setting can split, may name a number.
INPUT_PARTITIONS = "spark.valence.inputPartitions"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, as its scan splits it; dealt out only where the caller has set ``INPUT_PARTITIONS``."""
    rows = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get(INPUT_PARTITIONS, None)
    return rows.repartition(int(parts), rows.columns[0]) if parts else rows


def feed_of(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages of an event table: one per row, with a phrase chosen by ``event_id``.

    The phrase list is a folded array literal, so the lookup needs no join.
    """
    place = f"CAST(pmod(event_id, {len(FEED_PHRASES)}) AS INT)"
    event_ts = "CAST(ts AS TIMESTAMP)"
    return events.selectExpr(
        f"{message_id('event_id')} AS id",
        f"get(array({literals(FEED_PHRASES)}), {place}) AS text",
        "event_type AS source",
        "concat('user_', user_id) AS user",
        f"{iso_utc(event_ts)} AS timestamp",
        f"{event_ts} AS event_ts",
        "event_id",
        *keep,
    )


def event_feed(spark: SparkSession, folder: str) -> DataFrame:
    return feed_of(table(spark, folder, "events"))
