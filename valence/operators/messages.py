"""Message ids, assembly, defaults and commands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.arithmetic import literal, lookup
from ..functions.sentiment import BROWSER_SPACE, is_blank, strip
from ..functions.text import iso_utc, stable_hash
from ..schemas import COMMAND, MESSAGE

# Source and user of a message that has none, by channel.
CHANNEL_SOURCE = {
    "producer": "LiveStream", "function": "LiveFeed", "request": "ManualInput", "socket": "WebClient",
    "display": "Stream",
}
CHANNEL_USER = {
    "function": "user_live", "request": "LiveTester", "socket": "dashboard_user", "display": "anon",
}
DISPLAY_TIME = "00:00:00"
SEND_ACTION = "SEND_TEXT"


def message_id(number: str) -> str:
    """At least five digits. Padding by hand takes a fraction of the time of ``format_string``."""
    return f"concat('msg_', lpad({number}, greatest(5, length({number})), '0'))"


def event_id(ts: str) -> str:
    """Id from the clock. It repeats every 1000 seconds: no key for deduplication."""
    return f"format_string('evt_%06d', pmod(unix_millis({ts}), 1000000))"


def stand_in_user(key: str) -> str:
    """``user_100`` to ``user_999``, fixed by the key instead of drawn at random."""
    return f"concat('user_', {stable_hash(key)} % 900 + 100)"


def fill_defaults(messages: DataFrame, channel: str) -> DataFrame:
    """Fill missing source, user and time as the message's channel does.

    ``channel`` is an SQL expression. The socket sets its user on every message;
    the display also replaces empty text.
    """
    value = lambda name: f"CASE WHEN {channel} <> 'display' OR `{name}` <> '' THEN `{name}` END"
    fallback = f"coalesce({lookup(CHANNEL_USER, channel)}, {stand_in_user('id')})"
    time = f"CASE WHEN {channel} = 'display' THEN coalesce({value('timestamp')}, {literal(DISPLAY_TIME)}) ELSE `timestamp` END"
    filled = {
        "source": f"coalesce({value('source')}, {lookup(CHANNEL_SOURCE, channel)})",
        "user": f"coalesce(CASE WHEN {channel} <> 'socket' THEN {value('user')} END, {fallback})",
        "timestamp": time,
    }
    return messages.selectExpr(*[f"{filled[c]} AS `{c}`" if c in filled else f"`{c}`" for c in messages.columns])


def decode_with_defaults(records: DataFrame, channel: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Message columns of JSON values, filled as ``fill_defaults`` does, but only where a *key is missing*.

    A JSON null or an empty text that the sender wrote stays (the display alone takes both
    for missing). The value is read as a variant, which knows a missing key from a null, as
    ``from_json`` does not; what stands behind the object is not read. Numbers and objects in place of a text are kept as text. A value
    that is no JSON object gives nulls and stays a row. ``channel`` is an SQL expression.
    """
    parsed = records.selectExpr(*[f"`{c}`" for c in records.columns], "try_parse_json(CAST(value AS STRING)) AS __v")
    parsed = parsed.withColumn("__v", F.expr("CASE WHEN schema_of_variant(__v) LIKE 'OBJECT%' THEN __v END"))
    piece = lambda name: f"variant_get(__v, '$.{name}')"
    text = lambda name: (
        f"CASE WHEN NOT is_variant_null({piece(name)}) THEN CASE WHEN schema_of_variant({piece(name)}) RLIKE '^(OBJECT|ARRAY)'"
        f" THEN to_json({piece(name)}) ELSE CAST({piece(name)} AS STRING) END END"
    )
    given = lambda name: f"CASE WHEN {channel} <> 'display' OR ({text(name)}) <> '' THEN {text(name)} END"
    missing = lambda name: f"(__v IS NOT NULL AND ({piece(name)} IS NULL OR ({channel} = 'display' AND ({given(name)}) IS NULL)))"
    fallback = {
        "text": f"CASE WHEN {channel} = 'socket' THEN '' END",
        "source": lookup(CHANNEL_SOURCE, channel),
        "user": f"coalesce({lookup(CHANNEL_USER, channel)}, {stand_in_user(f'({text('id')})')})",
        "timestamp": f"CASE WHEN {channel} = 'display' THEN {literal(DISPLAY_TIME)} END",
    }
    value = {name: text(name) for name in MESSAGE.names} | {
        name: f"CASE WHEN {missing(name)} THEN {default} ELSE {given(name)} END" for name, default in fallback.items()
    }
    # The socket sets its user on every message.
    value["user"] = f"CASE WHEN {channel} = 'socket' AND __v IS NOT NULL THEN {literal(CHANNEL_USER['socket'])} ELSE {value['user']} END"
    return parsed.selectExpr(*[f"`{c}`" for c in keep], *[f"{value[name]} AS `{name}`" for name in MESSAGE.names])


def nonblank(messages: DataFrame) -> DataFrame:
    """Drop blank texts and trim the others, as a browser does before it sends a text."""
    kept = messages.where(f"NOT {is_blank('text', BROWSER_SPACE)}")
    return kept.withColumn("text", F.expr(strip("text", BROWSER_SPACE)))


def number_rows(items: DataFrame, into: str = "number") -> DataFrame:
    """Number items from 1 without a gap, in their order, and without bringing them together.

    A row's place in its partition is known where it is read; the counts of the
    partitions before it, one row each, are added. ``items`` must read the same
    partitions in both passes, as files and fixed rows do.
    """
    bits = 33  # Spark puts the partition above these bits of its row ids.
    placed = items.withColumn("__id", F.monotonically_increasing_id())
    placed = placed.withColumn("__part", F.expr(f"shiftright(__id, {bits})"))
    counts = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.expr(f"__before + (__id & {(1 << bits) - 1}L) + 1")
    return placed.join(offsets, "__part").withColumn(into, place).drop("__id", "__part", "__before")


def build_messages(items: DataFrame, number: str, ts: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Number and stamp items that have ``text``, ``source`` and ``user``."""
    return items.selectExpr(
        f"{message_id(number)} AS id", "text", "source", "user", f"{iso_utc(ts)} AS timestamp", *keep
    )


def encode(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Kafka records (``key``, JSON ``value``) of messages; null fields are written."""
    body = F.to_json(F.struct(*MESSAGE.names), {"ignoreNullFields": "false"})
    return messages.select(F.col("id").alias("key"), body.alias("value"), *keep)


def commands(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Texts to score from socket messages (column ``value``); all else is ignored."""
    parsed = records.select(*keep, F.from_json(F.col("value").cast("string"), COMMAND).alias("c"))
    return parsed.where(F.col("c.action") == SEND_ACTION).selectExpr(
        *keep,
        "coalesce(c.text, '') AS text",
        f"coalesce(c.source, {literal(CHANNEL_SOURCE['socket'])}) AS source",
        f"{literal(CHANNEL_USER['socket'])} AS user",
    )
