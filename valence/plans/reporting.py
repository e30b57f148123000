"""Metrics, keywords, throughput and newest rows of the scored feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import keywords as kw, latest as newest, metrics as m, throughput as tp
from ..operators.analyze import analyze
from ..sinks.envelopes import event_json, initial_state, new_events
from ..functions.text import time_of_day
from ..sources.tables import feed_of, table
from . import sql
from .registry import query
from .scoring import analyzed_feed

_NTZ = "timestamp_ntz"


@query(
    f"WITH {sql.SCORED_FEED}, k AS ({sql.kpi('scored')}) "
    "SELECT (SELECT min(ts) FROM events) AS started_at, k.* FROM k"
)
def kpi_metrics(spark: SparkSession, folder: str) -> DataFrame:
    row = m.kpi(analyzed_feed(spark, folder), ts="event_ts")
    return row.withColumn("started_at", F.col("started_at").cast(_NTZ))


@query(f"WITH {sql.SCORED_FEED} {sql.kpi('scored', 'source', 'binary')}")
def kpi_metrics_binary(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics as plain double arithmetic rounds them, per source so that several values are shown."""
    return m.kpi(analyzed_feed(spark, folder), "source", rounding="binary")


@query(f"WITH {sql.SCORED_FEED} {sql.kpi('scored', 'source')}")
def kpi_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return m.kpi(analyzed_feed(spark, folder), "source")


@query(f"""WITH {sql.SCORED_FEED}, k AS ({sql.kpi('scored', 'source')}),
v AS (SELECT *, CAST(round(avg_polarity * 1000) AS BIGINT) AS milli FROM k)
SELECT * EXCLUDE (milli), {sql.signed('avg_polarity', 'milli')} AS polarity_text,
  CASE WHEN milli > 100 THEN 'good' WHEN milli < -100 THEN 'bad' ELSE 'mid' END AS polarity_band,
  greatest(0.0, least(100.0, (avg_polarity::DOUBLE + 1.0) / 2.0 * 100.0)) AS pointer_pct FROM v""")
def kpi_display(spark: SparkSession, folder: str) -> DataFrame:
    """Display values of the metrics, per source so that several values are shown."""
    return m.kpi_display(m.kpi(analyzed_feed(spark, folder), "source"))


@query(f"""WITH {sql.SCORED_FEED}, c AS (SELECT * FROM (VALUES ('Positive'), ('Negative'), ('Neutral')) AS v(sentiment)),
g AS (SELECT sentiment, count(*) AS n FROM scored GROUP BY sentiment),
j AS (SELECT sentiment, coalesce(n, 0) AS cnt, (SELECT count(*) FROM scored) AS total FROM c LEFT JOIN g USING (sentiment))
SELECT sentiment, cnt, {sql.percent('cnt', 'total')} AS pct FROM j""")
def sentiment_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return m.distribution(analyzed_feed(spark, folder))


_KEYWORDS = f"""WITH {sql.SCORED_FEED}, x AS (SELECT unnest(keywords) AS keyword, event_ts, event_id FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY event_ts, event_id) AS place FROM x),
counts AS (SELECT keyword, count(*) AS cnt, max(event_ts) FILTER (place = 1) AS first_seen,
  max(event_id) FILTER (place = 1) AS first_id FROM ranked GROUP BY keyword)"""


@query(f"{_KEYWORDS} SELECT keyword, cnt, first_seen FROM counts")
def keyword_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = kw.keyword_counts(analyzed_feed(spark, folder), number="event_id")
    return counts.select("keyword", "cnt", F.col("first_seen").cast(_NTZ).alias("first_seen"))


@query(f"""{_KEYWORDS}, top AS (SELECT * FROM counts ORDER BY cnt DESC, first_seen, first_id, keyword LIMIT 10),
lex AS (SELECT word, weight FROM weights UNION ALL SELECT 'not ' || word, -weight FROM weights
        UNION ALL SELECT 'positive_emoji', 1 UNION ALL SELECT 'negative_emoji', -1)
SELECT keyword, cnt, regexp_matches(keyword, 'terrible|boring|hate|bad|not') AS is_neg_display, weight < 0 AS is_neg
FROM top JOIN lex ON word = keyword""")
def top_keywords(spark: SparkSession, folder: str) -> DataFrame:
    return kw.top_keywords(kw.keyword_counts(analyzed_feed(spark, folder), number="event_id"))


_RATE = lambda n: f"{sql.half_up(n, '60', 100)} / 100.0"
_RATES = f"{_RATE('events_60s')} AS throughput_eps, {_RATE('least(events_60s, 60)')} AS throughput_eps_saturated"


@query(f"""WITH n AS (SELECT count(*) AS events_60s FROM events
  WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 60 SECOND) SELECT events_60s, {_RATES} FROM n""")
def throughput_asof(spark: SparkSession, folder: str) -> DataFrame:
    return tp.throughput_asof(table(spark, folder, "events"), "ts")


@query(f"""WITH w AS (SELECT event_type AS source, ts AS event_ts,
  count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW)
    AS events_60s FROM events WHERE ts IS NOT NULL),
n AS (SELECT source, event_ts, count(*) AS events, max(events_60s) AS events_60s FROM w GROUP BY ALL)
SELECT *, {_RATES} FROM n""")
def throughput_series(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumnRenamed("event_type", "source")
    series = tp.throughput_series(events, "ts", "source")
    return series.withColumn("event_ts", F.col("event_ts").cast(_NTZ))


# A reset marker is an event whose property k is 0.
_MARKER = "CAST(json_extract(props, '$.k') AS INTEGER) = 0"


IS_RESET = "coalesce(get_json_object(props, '$.k') = '0', false)"


@query(f"""WITH {sql.SCORED_FEED}, r AS (SELECT max(ts) AS reset_at FROM events WHERE {_MARKER}),
since AS (SELECT scored.* FROM scored, r WHERE reset_at IS NULL OR event_ts > reset_at)
{sql.kpi('since')}""")
def metrics_since_reset(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    rows = m.after_reset(events, events.where(IS_RESET), "ts")
    return m.kpi(analyze(feed_of(rows)))


@query("""SELECT 'events' AS name, count(*) AS cnt FROM events UNION ALL SELECT 'documents', count(*) FROM documents
UNION ALL SELECT 'conversations', count(*) FROM conversations UNION ALL SELECT 'labels', count(*) FROM labels
UNION ALL SELECT 'benchmark', count(*) FROM benchmark UNION ALL SELECT 'pages', count(*) FROM pages""")
def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table; Parquet answers from its footers, without reading columns."""
    names = ("events", "documents", "conversations", "labels", "benchmark", "pages")
    counts = [
        table(spark, folder, name).agg(F.count("*").alias("cnt")).select(F.lit(name).alias("name"), "cnt")
        for name in names
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def newest_analyzed(spark: SparkSession, folder: str, k: int) -> DataFrame:
    """The newest events, scored after they are chosen."""
    events = newest.latest(table(spark, folder, "events"), k, "ts", "event_id")
    return analyze(feed_of(events), processed_at=F.col("event_ts"), keep=("event_ts", "event_id"))


_NEWEST = lambda k: f"newest AS (SELECT * FROM scored ORDER BY event_ts DESC, event_id DESC LIMIT {k})"


@query(f"""WITH {sql.SCORED_FEED}, {_NEWEST(newest.HISTORY_SIZE)}
SELECT id, text, source, "user", event_ts, {sql.SCORE_COLUMNS} FROM newest""")
def history_latest(spark: SparkSession, folder: str) -> DataFrame:
    rows = newest_analyzed(spark, folder, newest.HISTORY_SIZE)
    return rows.select(
        "id", "text", "source", "user", F.col("event_ts").cast(_NTZ).alias("event_ts"), "sentiment", "emoji", "label",
        "polarity", "confidence", "pos_score", "neg_score", F.array_join("keywords", ",").alias("keywords"),
    )


@query(f"""WITH {sql.SCORED_FEED}, {_NEWEST(newest.FEED_SIZE)}
SELECT id, strftime(event_ts, '%H:%M:%S') AS "time", {sql.escape('text')} AS text_html, {sql.escape('source')} AS source,
  {sql.escape('"user"')} AS "user", emoji, sentiment, {sql.signed('polarity', 'milli')} AS polarity_text, confidence
FROM newest""")
def feed_latest(spark: SparkSession, folder: str) -> DataFrame:
    return newest.feed_view(newest_analyzed(spark, folder, newest.FEED_SIZE))


@query(f"""WITH {sql.SCORED_FEED}, {_NEWEST(newest.TIMELINE_SIZE)}
SELECT event_ts, strftime(event_ts, '%H:%M:%S') AS "time", polarity FROM newest""")
def polarity_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """Time and polarity of the newest events, oldest first."""
    rows = newest_analyzed(spark, folder, newest.TIMELINE_SIZE)
    return rows.orderBy("event_ts", "event_id").select(
        F.col("event_ts").cast(_NTZ).alias("event_ts"), F.expr(time_of_day("event_ts")).alias("time"), "polarity"
    )


def feed_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of the feed: one pass for counts and keywords, one over the last minute."""
    rate = tp.throughput_asof(table(spark, folder, "events"), "ts").select("throughput_eps").scalar()
    return m.snapshot(analyzed_feed(spark, folder), rate, number="event_id")


_METRICS = f"""{_KEYWORDS}, k AS ({sql.kpi('scored')}),
n AS (SELECT count(*) AS events_60s FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 60 SECOND),
top AS (SELECT * FROM counts ORDER BY cnt DESC, first_seen, first_id, keyword LIMIT 10),
pairs AS (SELECT string_agg('["' || keyword || '",' || cnt || ']', ',' ORDER BY cnt DESC, first_seen, first_id, keyword) AS pairs
          FROM top),
metrics AS (SELECT k.*, {_RATE('events_60s')} AS throughput_eps, coalesce(pairs, '') AS pairs
            FROM k, n, pairs),
payload AS (SELECT '{{"total":' || total || ',"positive":' || positive || ',"negative":' || negative
  || ',"neutral":' || neutral || ',"positive_pct":' || positive_pct || ',"negative_pct":' || negative_pct
  || ',"neutral_pct":' || neutral_pct || ',"avg_polarity":' || avg_polarity || ',"throughput_eps":' || throughput_eps
  || ',"top_keywords":[' || pairs || ']}}' AS metrics FROM metrics)"""

_EVENT = """to_json(struct_pack(id := id, text := text, source := source, "user" := "user",
  "timestamp" := strftime(event_ts, '%H:%M:%S'), sentiment := sentiment, emoji := emoji, label := label,
  polarity := CAST(polarity AS DOUBLE), confidence := CAST(confidence AS DOUBLE),
  positive_score := CAST(pos_score AS DOUBLE), negative_score := CAST(neg_score AS DOUBLE),
  keywords := keywords))::VARCHAR"""


@query(f"{_METRICS} SELECT metrics FROM payload")
def metrics_payload(spark: SparkSession, folder: str) -> DataFrame:
    return feed_snapshot(spark, folder).select("metrics")


# Each event's envelope carries the metrics after it: one window over all events, and all keywords seen at each event.
_AT_EVENTS = f"""WITH {sql.SCORED_FEED}, e AS (SELECT *, row_number() OVER (ORDER BY event_ts NULLS FIRST, event_id) AS rn FROM scored),
upto AS (SELECT rn, count(*) OVER w AS total, count(*) FILTER (sentiment = 'Positive') OVER w AS positive,
  count(*) FILTER (sentiment = 'Negative') OVER w AS negative, count(*) FILTER (sentiment = 'Neutral') OVER w AS neutral,
  CAST(sum(milli) OVER w AS BIGINT) AS milli_sum, count(event_ts) OVER w - CASE WHEN event_ts IS NULL THEN 0 ELSE count(event_ts) OVER
    (ORDER BY event_ts NULLS FIRST RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 60000001 MICROSECOND PRECEDING) END AS n
  FROM e WINDOW w AS (ORDER BY rn)),
kw AS (SELECT rn, unnest(keywords) AS keyword FROM e),
seen AS (SELECT keyword, min(rn) AS place FROM kw GROUP BY keyword),
grid AS (SELECT e.rn, seen.keyword, place, CASE WHEN kw.rn IS NULL THEN 0 ELSE 1 END AS n FROM e JOIN seen ON place <= e.rn
  LEFT JOIN kw ON kw.rn = e.rn AND kw.keyword = seen.keyword),
kwc AS (SELECT rn, keyword, place, sum(n) OVER (PARTITION BY keyword ORDER BY rn) AS cnt FROM grid),
best AS (SELECT *, row_number() OVER (PARTITION BY rn ORDER BY cnt DESC, place, keyword) AS r FROM kwc),
top AS (SELECT rn, string_agg('["' || keyword || '",' || cnt || ']', ',' ORDER BY r) AS pairs FROM best WHERE r <= 10 GROUP BY rn),
metrics AS (SELECT rn, '{{"total":' || total || ',"positive":' || positive || ',"negative":' || negative
  || ',"neutral":' || neutral || ',"positive_pct":' || {sql.percent('positive', 'total')}
  || ',"negative_pct":' || {sql.percent('negative', 'total')} || ',"neutral_pct":' || {sql.percent('neutral', 'total')}
  || ',"avg_polarity":' || {sql.mean('milli_sum', 'total')} || ',"throughput_eps":' || {_RATE('n')}
  || ',"top_keywords":[' || coalesce(pairs, '') || ']}}' AS metrics FROM upto LEFT JOIN top USING (rn))"""


def _json_rows(rows: DataFrame) -> DataFrame:
    return event_json(rows, F.expr(time_of_day("event_ts")), "event_ts", "event_id")


@query(f"""{_AT_EVENTS}
SELECT id, '{{"type":"NEW_EVENT","data":' || {_EVENT} || ',"metrics":' || metrics || '}}' AS envelope FROM e JOIN metrics USING (rn)""")
def event_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """One envelope for every event, with the metrics as they stand after it."""
    rows = analyzed_feed(spark, folder)
    event = event_json(rows, F.expr(time_of_day("event_ts")), "event_ts", "event_id", "sentiment", "polarity", "keywords")
    return new_events(m.metrics_at_events(event, keep=("id", "event")))


@query(f"""{_METRICS}, {_NEWEST(newest.HISTORY_SIZE)},
h AS (SELECT string_agg({_EVENT}, ',' ORDER BY event_ts DESC, event_id DESC) AS history FROM newest)
SELECT '{{"type":"INITIAL_STATE","history":[' || coalesce(history, '') || '],"metrics":' || metrics || '}}' AS envelope
FROM h, payload""")
def initial_envelope(spark: SparkSession, folder: str) -> DataFrame:
    metrics = feed_snapshot(spark, folder).select("metrics").scalar()
    newest_rows = newest_analyzed(spark, folder, newest.HISTORY_SIZE)
    return initial_state(_json_rows(newest_rows), metrics, "event_ts", "event_id")
