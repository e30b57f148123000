"""Message sources, defaults, commands and the CSV corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.arithmetic import lookup
from ..operators import classifier
from ..operators import messages as msg
from ..schemas import MESSAGE
from ..session import work_dir
from ..sources import files
from ..sources.messages import decode
from ..sources.samples import sample_messages
from ..sources.tables import event_feed, table
from . import sql
from .registry import query


def feed_records(spark: SparkSession, folder: str) -> DataFrame:
    """The feed as Kafka records. Error events carry their bare text, which is no JSON object."""
    feed = event_feed(spark, folder)
    body = F.to_json(F.struct(*MESSAGE.names))
    value = F.when(F.col("source") == "error", F.col("text")).otherwise(body)
    return feed.select("event_id", value.cast("binary").alias("value"))


_GOOD = lambda name: f"CASE WHEN source <> 'error' THEN {name} END AS {name}"


@query(
    f"WITH {sql.FEED} SELECT event_id, "
    + ", ".join(_GOOD(n) for n in ("id", "text", "source", '"user"', '"timestamp"'))
    + " FROM feed"
)
def json_parse(spark: SparkSession, folder: str) -> DataFrame:
    return decode(feed_records(spark, folder), keep=("event_id",))


@query(f"""WITH {sql.FEED} SELECT id AS "key",
  to_json(struct_pack(id := id, text := text, source := source, "user" := "user", "timestamp" := "timestamp"))::VARCHAR
  AS "value", printf('evt_%06d', (epoch_us(event_ts) // 1000) % 1000000) AS event_key FROM feed""")
def message_build(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered, time-stamped JSON records of the events, and their clock ids."""
    feed = event_feed(spark, folder).drop("id", "timestamp")
    built = msg.build_messages(feed, "event_id", "event_ts", keep=(f"{msg.event_id('event_ts')} AS event_key",))
    return msg.encode(built, keep=("event_key",))


_STAND_IN = lambda key: f"'user_' || ({sql.bucket(key)} % 900 + 100)"


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
s AS (SELECT doc_id, {sql.strip('line')} AS text FROM l)
SELECT doc_id, text, 'FileStream' AS source, {_STAND_IN('text')} AS "user" FROM s
WHERE length(text) > 0 AND NOT starts_with(text, '#')""")
def text_lines_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of the documents, cleaned as lines of a text file."""
    lines = table(spark, folder, "documents").select("doc_id", "text").select("doc_id", F.explode_outer(F.split("text", "\n")).alias("value"))
    return files.clean_lines(lines, keep=("doc_id",))


# Which channel an event type stands for, and what its events lack.
_CHANNELS = {
    "click": "producer", "view": "function", "purchase": "request", "signup": "socket", "error": "display",
}


@query(f"""WITH {sql.FEED}, c AS (SELECT * FROM {sql.values(_CHANNELS.items())} AS v(event_type, channel)),
g AS (SELECT id, text, channel, CASE WHEN event_id % 3 = 0 THEN source WHEN event_id % 3 = 1 THEN '' END AS source,
  CASE WHEN event_id % 2 = 0 THEN "user" END AS "user", CASE WHEN event_id % 5 > 0 THEN "timestamp" END AS "timestamp"
  FROM feed JOIN c ON event_type = source)
SELECT id, text, channel,
  CASE channel WHEN 'display' THEN coalesce(nullif(source, ''), 'Stream') WHEN 'producer' THEN coalesce(source, 'LiveStream')
    WHEN 'function' THEN coalesce(source, 'LiveFeed') WHEN 'request' THEN coalesce(source, 'ManualInput')
    ELSE coalesce(source, 'WebClient') END AS source,
  CASE channel WHEN 'display' THEN coalesce("user", 'anon') WHEN 'producer' THEN coalesce("user", {_STAND_IN('id')})
    WHEN 'function' THEN coalesce("user", 'user_live') WHEN 'request' THEN coalesce("user", 'LiveTester')
    ELSE 'dashboard_user' END AS "user",
  CASE WHEN channel = 'display' THEN coalesce("timestamp", '00:00:00') ELSE "timestamp" END AS "timestamp" FROM g""")
def defaults_fill(spark: SparkSession, folder: str) -> DataFrame:
    """All events, with some fields taken away, filled as their channels do."""
    feed = event_feed(spark, folder)
    gaps = feed.selectExpr(
        "id",
        "text",
        f"{lookup(_CHANNELS, 'source')} AS channel",
        "CASE WHEN event_id % 3 = 0 THEN source WHEN event_id % 3 = 1 THEN '' END AS source",
        "CASE WHEN event_id % 2 = 0 THEN user END AS user",
        "CASE WHEN event_id % 5 > 0 THEN timestamp END AS timestamp",
    )
    return msg.fill_defaults(gaps, "channel")


# Fields of a message as JSON: there, empty, null or missing by the event's number; some values are no object.
_ODD = "event_id % 89 = 7"


@query(f"""WITH {sql.FEED}, c AS (SELECT * FROM {sql.values(_CHANNELS.items())} AS v(event_type, channel)),
g AS (SELECT feed.*, channel, {_ODD} AS odd, event_id % 4 AS s, event_id % 3 AS u, event_id % 5 AS t FROM feed JOIN c ON event_type = source)
SELECT event_id, channel, CASE WHEN NOT odd THEN id END AS id,
  CASE WHEN odd THEN NULL WHEN t < 4 THEN text WHEN channel = 'socket' THEN '' END AS text,
  CASE WHEN odd THEN NULL WHEN s = 0 THEN source WHEN s = 1 AND channel <> 'display' THEN '' WHEN s = 2 AND channel <> 'display' THEN NULL
    ELSE CASE channel WHEN 'display' THEN 'Stream' WHEN 'producer' THEN 'LiveStream' WHEN 'function' THEN 'LiveFeed'
      WHEN 'request' THEN 'ManualInput' ELSE 'WebClient' END END AS source,
  CASE WHEN odd THEN NULL WHEN channel = 'socket' THEN 'dashboard_user' WHEN u = 0 THEN "user" WHEN u = 1 AND channel <> 'display' THEN NULL
    ELSE CASE channel WHEN 'display' THEN 'anon' WHEN 'producer' THEN {_STAND_IN('id')} WHEN 'function' THEN 'user_live' ELSE 'LiveTester' END
    END AS "user",
  CASE WHEN odd THEN NULL WHEN t > 0 THEN "timestamp" WHEN channel = 'display' THEN '00:00:00' END AS "timestamp" FROM g""")
def defaults_variant(spark: SparkSession, folder: str) -> DataFrame:
    """All events as JSON with missing, null and empty fields; defaults stand only where a key is missing."""
    field = lambda name: f"concat(',\"{name}\":', substr(to_json(array({name})), 2, length(to_json(array({name}))) - 2))"
    parts = [
        f"CASE WHEN event_id % 5 < 4 THEN {field('text')} ELSE '' END",
        f"CASE event_id % 4 WHEN 0 THEN {field('source')} WHEN 1 THEN ',\"source\":\"\"' WHEN 2 THEN ',\"source\":null' ELSE '' END",
        f"CASE event_id % 3 WHEN 0 THEN {field('user')} WHEN 1 THEN ',\"user\":null' ELSE '' END",
        f"CASE WHEN event_id % 5 > 0 THEN {field('timestamp')} ELSE '' END",
    ]
    body = f"concat('{{\"id\":\"', id, '\"', {', '.join(parts)}, '}}')"
    odd = f"CASE event_id % 3 WHEN 0 THEN '[1]' WHEN 1 THEN rtrim('}}', {body}) ELSE '17' END"
    records = event_feed(spark, folder).selectExpr(
        "event_id", f"{lookup(_CHANNELS, 'source')} AS channel", f"CASE WHEN {_ODD} THEN {odd} ELSE {body} END AS value"
    )
    return msg.decode_with_defaults(records, "channel", keep=("event_id", "channel"))


@query(f"""WITH {sql.FEED} SELECT id, {sql.strip('text', sql.BROWSER_SPACE)} AS text, source, "user", "timestamp"
FROM feed WHERE NOT {sql.blank('text', sql.BROWSER_SPACE)}""")
def nonblank_filter(spark: SparkSession, folder: str) -> DataFrame:
    return msg.nonblank(event_feed(spark, folder).select(*MESSAGE.names))


def socket_records(conversations: DataFrame) -> DataFrame:
    """Turns as socket messages: of users a command, of assistants another action, of the system no JSON."""
    turn = F.col("turn")
    send = F.struct(
        F.lit(msg.SEND_ACTION).alias("action"),
        F.when(turn % 4 != 2, F.col("text")).alias("text"),
        F.when(turn > 0, F.concat(F.lit("turn_"), turn)).alias("source"),
    )
    value = (
        F.when(F.col("role") == "user", F.to_json(send))
        .when(F.col("role") == "assistant", F.to_json(F.struct(F.lit("PING").alias("action"), "text")))
        .otherwise(F.col("text"))
    )
    return conversations.select("conv_id", "turn", value.alias("value"))


@query("""SELECT conv_id, turn, CASE WHEN turn % 4 = 2 THEN '' ELSE text END AS text,
  CASE WHEN turn = 0 THEN 'WebClient' ELSE 'turn_' || turn END AS source, 'dashboard_user' AS "user"
FROM conversations WHERE role = 'user'""")
def command_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of users among the turns sent to the socket."""
    records = socket_records(table(spark, folder, "conversations"))
    return msg.commands(records, keep=("conv_id", "turn"))


@query(f"""WITH {sql.FEED}, {sql.SAMPLES}, l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
s AS (SELECT {sql.strip('line')} AS text FROM l)
SELECT text, source, "user" FROM samples
UNION ALL SELECT text, 'FileStream', {_STAND_IN('text')} FROM s WHERE length(text) > 0 AND NOT starts_with(text, '#')
UNION ALL SELECT text, source, "user" FROM feed""")
def feed_union(spark: SparkSession, folder: str) -> DataFrame:
    """Sample messages, document lines and the event feed, with all copies kept."""
    lines = text_lines_clean(spark, folder).drop("doc_id")
    feed = event_feed(spark, folder).select("text", "source", "user")
    return sample_messages(spark).unionByName(lines).unionByName(feed)


# Corpus

_CSV = {"escape": '"'}


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a label; the target is 4 where the quality is 1, else 0."""
    labels = table(spark, folder, "labels").select("doc_id", (F.col("quality") * 4).alias("target"), "toxic")
    documents = table(spark, folder, "documents").select("doc_id", "text", "source")
    return documents.join(labels, "doc_id")


def _one_line(text: str) -> Column:
    return F.regexp_replace(text, r"[\r\n]+", " ")


def write_corpus(spark: SparkSession, folder: str) -> str:
    """The labelled documents as a header-less CSV corpus, one record per line."""
    path = work_dir(spark, "corpus")
    rows = labelled_documents(spark, folder).select(
        "target", F.col("doc_id").alias("id"), F.lit("2024-01-01").alias("date"), F.lit("NO_QUERY").alias("flag"),
        F.col("source").alias("user"), _one_line("text").alias("text"),
    )
    rows.write.options(quoteAll="true", **_CSV).csv(path)
    return path


_CORPUS = """corpus AS (SELECT CAST(quality * 4 AS INTEGER) AS target, doc_id AS id, '2024-01-01' AS date,
  'NO_QUERY' AS flag, source AS "user", regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS text
  FROM documents JOIN labels USING (doc_id))"""


@query(f"WITH {_CORPUS} SELECT * FROM corpus")
def corpus_load(spark: SparkSession, folder: str) -> DataFrame:
    return files.read_corpus(
        spark, write_corpus(spark, folder), ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", **_CSV
    )


@query("""SELECT doc_id, target, CASE WHEN target = 4 THEN 1 ELSE 0 END AS label FROM (
  SELECT doc_id, CASE WHEN quality = 1 THEN 4 WHEN toxic = 1 THEN 2 WHEN toxic = 0 THEN 0 END AS target
  FROM documents LEFT JOIN labels USING (doc_id))""")
def label_binarize(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of all documents; those without one have a null target."""
    labels = table(spark, folder, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, 4).when(F.col("toxic") == 1, 2).when(F.col("toxic") == 0, 0).alias("target")
    )
    documents = table(spark, folder, "documents").select("doc_id")
    return classifier.binarize(documents.join(labels, "doc_id", "left"))
