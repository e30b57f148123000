"""Metrics, keywords, newest rows, sampling, messages and classifier on small input."""

import datetime as dt
import hashlib
import json
import math

import pytest
from pyspark.sql import functions as F

from valence.functions.text import escape_html, event_time, iso_utc, pointer_percent, polarity_band, signed_text
from valence.operators import classifier, keywords, latest, messages, metrics, prefix, sampling, terms
from valence.operators.analyze import analyze, encode_analyzed, score_texts, server_view
from valence.schemas import ANALYZED, MESSAGE
from valence.sinks import envelopes
from valence.sources import files
from valence.sources.messages import decode, kafka_options, message_stream
from valence.sources.samples import PRESET_SAMPLES, PRODUCER_SAMPLES, sample_messages

NAMES = ("total", "positive", "negative", "neutral")


def message_rows(spark, texts):
    rows = [(f"m{i}", t, "s", "u", f"2024-01-01T00:00:{i:02d}Z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, MESSAGE).withColumn("event_ts", F.expr(event_time("timestamp")))


def scored(spark, texts):
    return analyze(message_rows(spark, texts), keep=("event_ts",))


def test_analyzed_schema(spark):
    df = analyze(message_rows(spark, ["good"]))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in ANALYZED]


def test_metrics_of_no_rows(spark):
    (row,) = metrics.kpi(scored(spark, ["x"]).where("false")).collect()
    assert [row[n] for n in NAMES] == [0, 0, 0, 0]
    assert row.avg_polarity == row.positive_pct == row.negative_pct == row.neutral_pct == 0.0
    assert {r.sentiment: (r.cnt, r.pct) for r in metrics.distribution(scored(spark, ["x"]).where("false")).collect()} == {
        "Positive": (0, 0.0), "Negative": (0, 0.0), "Neutral": (0, 0.0)
    }


def test_metrics_add_up(spark):
    (row,) = metrics.kpi(scored(spark, ["good", "bad", "bad", None, "chair"])).collect()
    assert [row[n] for n in NAMES] == [5, 1, 2, 2]
    assert (row.positive_pct, row.negative_pct, row.neutral_pct) == (20.0, 40.0, 40.0)
    assert row.avg_polarity == pytest.approx(round((0.583 - 1.2) / 5, 3))


def test_snapshot_is_one_pass_and_handles_no_rows(spark):
    rows = scored(spark, ["good good", "good bad", "not bad", "\U0001F44D"])
    payload = json.loads(metrics.snapshot(rows, F.lit(0.25)).first().metrics)
    assert payload["total"] == 4 and payload["throughput_eps"] == 0.25
    assert payload["top_keywords"] == [["good", 2], ["bad", 1], ["not bad", 1], ["positive_emoji", 1]]
    assert list(payload) == [
        "total", "positive", "negative", "neutral", "positive_pct", "negative_pct", "neutral_pct", "avg_polarity",
        "throughput_eps", "top_keywords",
    ]
    (empty,) = metrics.snapshot(rows.where("false"), F.lit(0.0)).collect()
    assert json.loads(empty.metrics)["top_keywords"] == [] and empty.total == 0


def test_keywords_count_texts_and_flag_both_ways(spark):
    rows = scored(spark, ["good good", "good top-notch", "worst", "not bad"])
    got = {r.keyword: (r.cnt, r.is_neg_display, r.is_neg) for r in keywords.top_keywords(keywords.keyword_counts(rows)).collect()}
    assert got == {
        "good": (2, False, False), "top-notch": (1, True, False), "worst": (1, False, True), "not bad": (1, True, False)
    }


def test_equal_keyword_counts_keep_the_first_seen(spark):
    rows = scored(spark, ["worst", "amazing", "bad"])
    assert [r.keyword for r in keywords.top_keywords(keywords.keyword_counts(rows), 2).collect()] == ["worst", "amazing"]
    at = message_rows(spark, ["worst", "amazing", "bad"]).withColumns(
        {"event_ts": F.lit("1969-01-01").cast("timestamp"), "n": F.expr("CAST(substr(id, 2) AS BIGINT)")}
    )
    same = analyze(at, keep=("event_ts", "n"))
    top = keywords.top_keywords(keywords.keyword_counts(same, number="n"), 2)
    assert [r.keyword for r in top.collect()] == ["worst", "amazing"]
    payload = json.loads(metrics.snapshot(same, F.lit(0.0), number="n").first().metrics)
    assert [k for k, _ in payload["top_keywords"]] == ["worst", "amazing", "bad"]


def test_latest_with_ties_and_few_rows(spark):
    rows = spark.createDataFrame([(i, dt.datetime(2024, 1, 1, 0, 0, i // 4)) for i in range(20)], "id int, ts timestamp")
    assert [r.id for r in latest.latest(rows, 6, "ts", "id").collect()] == [19, 18, 17, 16, 15, 14]
    assert latest.latest(rows, 100, "ts", "id").count() == 20
    assert latest.latest(rows.where("false"), 5, "ts", "id").count() == 0


def test_latest_keeps_rows_without_a_time(spark):
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    rows = spark.createDataFrame([(1, at(1), at(9)), (2, None, at(5)), (3, at(3), at(9)), (4, None, None)], "id int, ts timestamp, came timestamp")
    assert [r.id for r in latest.latest(rows, 100, "ts", "id").collect()] == [3, 1, 4, 2]
    assert [r.id for r in latest.latest(rows, 3, "ts", "id", arrival="came").collect()] == [2, 3, 1]
    assert latest.latest(rows, 2, "ts", "id").count() == 2


def _plain_metrics(rows):
    """The server's loop: counts, the last minute and the ten most frequent keywords after each event."""
    counts, keywords, times, total = {}, {}, [], 0
    for r in sorted(rows, key=lambda r: (r.event_ts is not None, r.event_ts or dt.datetime.min, r.number)):
        total += round(r.polarity * 1000)
        counts[r.sentiment] = counts.get(r.sentiment, 0) + 1
        for word in r.keywords:
            keywords[word] = keywords.get(word, 0) + 1
        if r.event_ts is not None:
            times.append(r.event_ts)
        recent = sum(t >= r.event_ts - dt.timedelta(seconds=60) for t in times) if r.event_ts else 0
        top = [[k, n] for k, n in sorted(keywords.items(), key=lambda e: e[1], reverse=True)[:10]]
        yield r.id, {**counts}, total, recent, top


@pytest.mark.parametrize("bits", [1, 3, 13])
def test_envelopes_carry_the_metrics_after_their_event(spark, monkeypatch, bits):
    """Ties in time, bursts, events without a time, and blocks of a few events."""
    monkeypatch.setattr(prefix, "BLOCK_BITS", bits)
    texts = ["good", "bad", "chair", "not good and great", "awful terrible boring", "love love hate", "superb nice happy sad worst best"] * 30
    second = lambda i: i // 3 * 7 % 400
    rows = [(f"m{i:03d}", t, "s", "u", f"2024-01-01T00:{second(i) // 60:02d}:{second(i) % 60:02d}Z" if i % 50 else None) for i, t in enumerate(texts)]
    scored = analyze(spark.createDataFrame(rows, MESSAGE).repartition(5).withColumn("event_ts", F.expr(event_time("timestamp"))), keep=("event_ts",))
    scored = scored.withColumn("number", F.expr("CAST(substr(id, 2) AS BIGINT)"))
    events = envelopes.event_json(scored, F.lit("x"), "event_ts", "number", "sentiment", "polarity", "keywords")
    after = metrics.metrics_at_events(events, number="number", keep=("id", "event"))
    got = {r.id: json.loads(r.envelope)["metrics"] for r in envelopes.new_events(after).collect()}
    assert len(got) == len(rows)
    for id, counts, milli, recent, top in _plain_metrics(scored.collect()):
        m, total = got[id], sum(counts.values())
        assert (m["total"], m["positive"], m["negative"], m["neutral"]) == (total, *(counts.get(c, 0) for c in metrics.CLASSES))
        assert m["top_keywords"] == top and abs(m["throughput_eps"] - recent / 60) <= 0.005 + 1e-9 and abs(m["avg_polarity"] - milli / total / 1000) < 0.00051
    assert after.limit(0).count() == metrics.metrics_at_events(events.limit(0), number="number", keep=("id",)).count() == 0


def test_numbers_without_gaps(spark):
    rows = spark.range(0, 1000, 1, 7).union(spark.range(1000, 1005, 1, 3))
    assert sorted((r.id, r.number) for r in messages.number_rows(rows).collect()) == [(i, i + 1) for i in range(1005)]


def test_binary_rounding_of_metrics(spark):
    counts = spark.createDataFrame([(16, 1, 15, 0, 62), (3, 1, 2, 0, 1)], "total long, positive long, negative long, neutral long, polarity_milli long")
    for rounding, percents in (("exact", [6.3, 33.3]), ("binary", [6.2, 33.3])):
        rows = metrics.finish_counts(counts, rounding=rounding).orderBy(F.desc("total")).collect()
        assert [r.positive_pct for r in rows] == percents
    binary = metrics.finish_counts(counts, rounding="binary").collect()
    assert [(r.positive_pct, r.avg_polarity) for r in binary] == [(round(1 / 16 * 100, 1), round(0.062 / 16, 3)), (round(1 / 3 * 100, 1), round(0.001 / 3, 3))]


def test_after_reset(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, i),) for i in range(5)], "ts timestamp")
    resets = rows.where(F.col("ts") <= dt.datetime(2024, 1, 1, 0, 0, 2))
    assert metrics.after_reset(rows, resets, "ts").count() == 2
    assert metrics.after_reset(rows, rows.where("false"), "ts").count() == 5
    untimed = rows.union(spark.createDataFrame([(None,)], "ts timestamp"))
    assert metrics.after_reset(untimed, rows.where("false"), "ts").count() == 6
    assert metrics.after_reset(untimed, resets, "ts").count() == 2


def test_display_helpers(spark):
    values = [0.655, 0.605, -0.137, 0.0, -0.004, 0.125, -0.125, 1.0, 0.1, 0.101, -0.101]
    row = spark.createDataFrame([(v,) for v in values], "v double").select(
        F.expr(signed_text("v")).alias("t"), F.expr(polarity_band("v")).alias("b"), F.expr(pointer_percent("v")).alias("p")
    ).collect()
    assert [r.t for r in row] == [
        "+0.66", "+0.60", "-0.14", "+0.00", "-0.00", "+0.13", "-0.13", "+1.00", "+0.10", "+0.10", "-0.10"
    ]
    assert [r.b for r in row][-3:] == ["mid", "good", "bad"] and row[7].p == 100.0 and row[3].p == 50.0


def test_escape(spark):
    df = spark.createDataFrame([("<a href=\"x\">&'",), (None,)], "t string").select(F.expr(escape_html("t")).alias("t"))
    assert [r.t for r in df.collect()] == ["&lt;a href=&quot;x&quot;&gt;&amp;&#039;", ""]


def test_iso_time_has_a_fraction_only_where_needed(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:07.179575' AS a, timestamp'2024-01-01 00:00:07' AS b")
    row = df.select(F.expr(iso_utc("a")).alias("a"), F.expr(iso_utc("b")).alias("b")).first()
    assert (row.a, row.b) == ("2024-01-01T00:00:07.179575Z", "2024-01-01T00:00:07Z")
    back = spark.createDataFrame([(row.a,), ("noon",)], "t string").select(F.expr(event_time("t")).alias("t")).collect()
    assert back[0].t == dt.datetime(2024, 1, 1, 0, 0, 7, 179575) and back[1].t is None


def test_malformed_messages_survive(spark):
    values = ["nope", '{"id":"a","text":null}', '{"id":"b","text":"good","user":7}', "", None]
    records = spark.createDataFrame([(v.encode() if v is not None else None,) for v in values], "value binary")
    rows = analyze(decode(records)).collect()
    assert len(rows) == 5
    assert [(r.id, r.sentiment, r.confidence) for r in rows] == [
        (None, "Neutral", 50.0), ("a", "Neutral", 50.0), ("b", "Positive", 87.5), (None, "Neutral", 50.0), (None, "Neutral", 50.0)
    ]
    assert rows[2].user == "7" and rows[0].label == "\U0001F610 Neutral"


def test_payload_keeps_nulls_and_round_trips(spark):
    df = analyze(spark.createDataFrame([("a", "not bad", "s", None, None)], MESSAGE))
    body = encode_analyzed(df).first().value
    assert '"user":null' in body
    value = json.loads(body)
    assert list(value) == ANALYZED.names and value["keywords"] == ["not bad"] and value["pos_score"] == 0.53
    record = messages.encode(spark.createDataFrame([("a", "x", None, None, None)], MESSAGE))
    assert decode(record).first().asDict() == {"id": "a", "text": "x", "source": None, "user": None, "timestamp": None}


def test_server_view_names(spark):
    assert server_view(analyze(message_rows(spark, ["x"]))).columns == [
        "id", "text", "source", "user", "timestamp", "sentiment", "emoji", "label", "polarity", "confidence",
        "positive_score", "negative_score", "keywords",
    ]


def test_score_texts_defaults(spark):
    row = score_texts(spark.createDataFrame([("This movie was fantastic!",)], "text string")).first()
    assert (row.source, row.user, row.analysis.polarity) == ("ManualInput", "LiveTester", 0.655)


def test_nonblank_trims_as_a_browser(spark):
    rows = spark.createDataFrame([(t,) for t in (" \ufeff a b\u00a0\n", "\ufeff", "  ", None, "\x1c")], "text string")
    assert [r.text for r in messages.nonblank(rows).collect()] == ["a b", "\x1c"]


def test_commands(spark):
    values = ['{"action":"SEND_TEXT","text":"a","source":"S","user":"x"}', '{"action":"SEND_TEXT"}', '{"action":"PING"}', "{", "[]", None]
    rows = messages.commands(spark.createDataFrame([(v,) for v in values], "value string")).collect()
    assert [tuple(r) for r in rows] == [("a", "S", "dashboard_user"), ("", "WebClient", "dashboard_user")]


def test_ids(spark):
    df = spark.sql("SELECT 7 AS n, timestamp'2024-01-01 00:00:07.179999' AS t")
    row = df.select(F.expr(messages.message_id("n")).alias("m"), F.expr(messages.event_id("t")).alias("e")).first()
    assert row.m == "msg_00007" and row.e == f"evt_{1704067207179 % 1000000:06d}"


def test_line_file(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("# note\n   \n  I feel terrible  \n #x\n padded \na # b\n", encoding="utf-8")
    rows = files.read_lines(spark, str(tmp_path / "lines.txt")).collect()
    assert sorted(r.text for r in rows) == ["I feel terrible", "a # b", "padded"]
    assert all(r.source == "FileStream" and 100 <= int(r.user.split("_")[1]) <= 999 for r in rows)
    assert files.read_lines(spark, str(tmp_path / "missing.txt")).count() == 0


def test_samples(spark):
    assert (len(PRODUCER_SAMPLES), len(PRESET_SAMPLES)) == (17, 14)
    assert sample_messages(spark).count() == 31
    first = [r.analysis.label.split()[1] for r in score_texts(sample_messages(spark).limit(4)).collect()]
    assert first == ["Positive", "Positive", "Negative", "Negative"]


def test_corpus_file(spark, tmp_path):
    (tmp_path / "c.csv").write_text('"0","1","d","NO_QUERY","u","bad, very bad"\n"4","2","d","NO_QUERY","v","good"\n')
    rows = classifier.binarize(files.read_corpus(spark, str(tmp_path / "c.csv"))).collect()
    assert [(r.target, r.id, r.text, r.label) for r in rows] == [(0, 1, "bad, very bad", 0), (4, 2, "good", 1)]


def test_label_rule(spark):
    rows = classifier.binarize(spark.createDataFrame([(4,), (0,), (2,), (None,)], "target int")).collect()
    assert [r.label for r in rows] == [1, 0, 0, 0]


def md5(key):
    return hashlib.md5(str(key).encode()).hexdigest()


def test_exact_sample(spark):
    rows = spark.range(0, 3000).repartition(7)
    for n in (0, 1, 999, 3000, 5000):
        want = sorted(range(3000), key=lambda i: (md5(i), i))[:n]
        assert sorted(r.id for r in sampling.exact_sample(rows, "id", n).collect()) == sorted(want)


def test_exact_sample_with_a_hot_key(spark):
    rows = spark.range(0, 900).select(F.when(F.col("id") < 300, 5).otherwise(F.col("id")).alias("id"))
    keys = [r.id for r in rows.collect()]
    for n in (100, 400, 899):
        want = sorted(keys, key=lambda i: (md5(i), i))[:n]
        assert sorted(r.id for r in sampling.exact_sample(rows, "id", n).collect()) == sorted(want)


def test_exact_sample_of_equal_and_null_keys_repeats(spark):
    rows = spark.range(0, 500).select(F.expr("CASE WHEN id % 2 = 0 THEN 5 WHEN id % 5 = 0 THEN NULL ELSE id END").alias("k"), "id")
    first = sorted(r.id for r in sampling.exact_sample(rows, "k", 120).collect())
    assert len(first) == 120
    assert sorted(r.id for r in sampling.exact_sample(rows.repartition(9), "k", 120).collect()) == first


def test_split_is_stable_and_whole(spark):
    rows = spark.range(0, 2000)
    train, test = sampling.train_test_split(rows, "id")
    again, _ = sampling.train_test_split(rows.repartition(13), "id")
    ids = {r.id for r in train.collect()}
    assert ids == {r.id for r in again.collect()} == {i for i in range(2000) if int(md5(i)[:8], 16) % 100 < 80}
    assert train.count() + test.count() == 2000


def test_terms(spark):
    docs = spark.createDataFrame([(1, "The cat  cat"), (2, "dog cat"), (3, None), (4, "")], "doc_id int, text string")
    docs = docs.where("text IS NOT NULL")
    tf = terms.term_counts(docs, "doc_id")
    got = {(r.doc_id, r.term): r.tf for r in tf.collect()}
    assert got == {(1, "cat"): 2, (1, ""): 1, (2, "dog"): 1, (2, "cat"): 1, (4, ""): 1}
    weights = {r.term: r.idf for r in terms.idf(docs).collect()}
    assert weights["cat"] == pytest.approx(math.log(4 / 3)) and weights["dog"] == pytest.approx(math.log(2))


def test_classifier_learns_saves_and_loads(spark, tmp_path):
    rows = spark.range(0, 200).select(
        F.when(F.col("id") % 2 == 0, "what a great happy film").otherwise("an awful sad film").alias("text"),
        (F.col("id") % 2 == 0).cast("int").alias("label"),
    )
    model = classifier.fit(rows)
    assert [type(s).__name__ for s in model.stages] == [
        "Tokenizer", "StopWordsRemover", "HashingTF", "IDFModel", "LogisticRegressionModel"
    ]
    classifier.save(model, str(tmp_path / "m"))
    classifier.save(model, str(tmp_path / "m"))
    predicted = classifier.classify(classifier.load(str(tmp_path / "m")), rows)
    assert classifier.accuracy(predicted) == 1.0
    (row,) = classifier.accuracy_row(predicted).collect()
    assert (row.total, row.correct, row.accuracy_pct) == (200, 200, 100.0)


def test_kafka_options(monkeypatch, spark):
    monkeypatch.delenv("KAFKA_BOOTSTRAP_SERVERS", raising=False)
    assert kafka_options() == {"kafka.bootstrap.servers": "localhost:9092"}
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "a:1,b:2")
    assert kafka_options("t") == {"kafka.bootstrap.servers": "a:1,b:2", "topic": "t"}
    assert kafka_options("t", "c:3")["kafka.bootstrap.servers"] == "c:3"
    with pytest.raises(ValueError):
        message_stream(spark, "json")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 17, 100, 1009, 4097])
def test_shuffle_is_a_bijection_that_depends_on_the_seed(spark, n):
    place = lambda seed: [r.p for r in spark.range(n).coalesce(1).selectExpr(f"{sampling.shuffled_place('id', n, seed)} AS p").collect()]
    first = place(1)
    assert sorted(first) == list(range(n))
    if n > 99:
        moved = [abs(a - b) for a, b in zip(first, range(n))]
        assert first != place(2) and n / 4 < sum(moved) / n < n / 2.2  # a third of n on average
        ups = sum(b > a for a, b in zip(first, first[1:]))
        assert 0.4 * n < ups < 0.6 * n


def test_shuffled_rows_keep_null_and_repeated_keys(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), (3, 3), (3, 3), (1, 4)], "id int, x int").repartition(3)
    assert sorted(r.place for r in sampling.shuffle_order(rows, "id").collect()) == [0, 1, 2, 3, 4]
    assert sampling.shuffle_order(rows.limit(0), "id").count() == 0


def test_envelopes_shuffle_no_column_for_each_keyword(spark):
    """Rows on their way to their block stay narrow, whatever the number of keywords."""
    rows = [("a", "good", "s", "u", "2024-01-01T00:00:00Z"), ("b", "bad", "s", "u", None)]
    scored = analyze(spark.createDataFrame(rows, MESSAGE).withColumn("event_ts", F.expr(event_time("timestamp"))), keep=("event_ts",))
    after = metrics.metrics_at_events(scored, number="id", keep=("id",))
    widths, todo = [], [after._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        widths.append(node.output().size())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert max(widths) < 30
