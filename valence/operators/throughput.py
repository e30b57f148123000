"""Events of the last 60 seconds, now or at each event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.arithmetic import half_up_ratio

# Length of the trailing window in seconds, and the number of
# events that the saturating display counts at most.
SPAN, CAP = 60, 60
_MICROS = 1_000_000
_CHUNK = 3600


def rate_columns(n: str) -> list[str]:
    """Events per second, and the same where the display stops counting."""
    rate = lambda count: f"{half_up_ratio(count, str(SPAN), 100)} / 100.0D"
    return [f"{rate(n)} AS throughput_eps", f"{rate(f'least({n}, {CAP})')} AS throughput_eps_saturated"]


def throughput_asof(events: DataFrame, ts: str, asof: Column | None = None) -> DataFrame:
    """Rate of the 60 seconds up to ``asof`` (default: the newest event), both ends included.

    The window's start is a scalar subquery, pushed down to the scan.
    """
    span = F.expr(f"INTERVAL {SPAN} SECONDS")
    if asof is None:
        recent = events.where(F.col(ts) >= events.agg(F.max(ts) - span).scalar())
    else:
        recent = events.where((F.col(ts) >= asof - span) & (F.col(ts) <= asof))
    return recent.agg(F.count("*").alias("events_60s")).selectExpr("events_60s", *rate_columns("events_60s"))


def throughput_series(events: DataFrame, ts: str, key: str) -> DataFrame:
    """Events of the same key in the 60 seconds up to each distinct event time.

    A window over all rows of a key would put a hot key into one task. Here the
    count is a sum of three parts: the rest of the second 60 seconds ago, the 59
    whole seconds between, and the current second so far. Rows are summed per
    key and microsecond before any shuffle, so a group is one key and one
    second, at most a million cells of its own and a million of the second 60
    seconds ago, however many events there are.
    """
    micros = f"unix_micros(CAST(`{ts}` AS TIMESTAMP))"
    offset = f"pmod({micros}, {_MICROS})"
    # A marker stands for the key, so that the join below is on plain equality and keeps the partitioning.
    key, given = "marker", key
    kind = events.schema[given].dataType.simpleString()
    stamped = events.where(F.col(ts).isNotNull()).selectExpr(
        f"coalesce(concat('=', CAST(`{given}` AS STRING)), '') AS marker",
        f"({micros} - {offset}) div {_MICROS} AS sec",
        f"{offset} AS offset",
    )
    cells = stamped.groupBy(key, "sec", "offset").agg(F.count("*").alias("n"))
    entries = f"array(struct(sec, n AS own, 0L AS old), struct(sec + {SPAN} AS sec, 0L AS own, n AS old))"
    second = Window.partitionBy(key, "sec")
    # At the same offset the second's own cell comes first, so the running sum
    # of old cells leaves out the one that still lies inside the window.
    so_far = second.orderBy("offset", "old").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_ends = F.sum("own").over(so_far) + F.sum("old").over(second) - F.sum("old").over(so_far)
    ends = (
        cells.selectExpr(f"`{key}`", "offset", f"inline({entries})")
        .select(key, "sec", "offset", "own", at_ends.alias("at_ends"))
        .where("own > 0")
    )

    seconds = cells.groupBy(key, "sec").agg(F.sum("n").alias("n"))
    chunk = lambda sec: f"({sec} - pmod({sec}, {_CHUNK})) div {_CHUNK}"
    reach = f"array_distinct(array({chunk('sec')}, {chunk(f'(sec + {SPAN - 1})')}))"
    whole = Window.partitionBy(key, "chunk").orderBy("sec").rangeBetween(1 - SPAN, -1)
    between = (
        seconds.selectExpr(f"`{key}`", "sec", "n", f"explode({reach}) AS chunk")
        .withColumn("between", F.coalesce(F.sum("n").over(whole), F.lit(0)))
        .where(f"chunk = {chunk('sec')}")
        .select(key, "sec", "between")
    )
    return ends.join(between, [key, "sec"]).selectExpr(
        f"CASE WHEN marker <> '' THEN CAST(substr(marker, 2) AS {kind}) END AS `{given}`",
        f"timestamp_micros(sec * {_MICROS} + offset) AS event_ts",
        "own AS events",
        "at_ends + `between` AS events_60s",
        *rate_columns("(at_ends + `between`)"),
    )
