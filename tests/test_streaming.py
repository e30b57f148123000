"""Streams equal batch, survive malformed input and restarts, and apply resets exactly."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from valence.functions.text import event_time
from valence.operators import metrics as m
from valence.operators.analyze import analyze
from valence.operators.keywords import keyword_counts
from valence.schemas import MESSAGE
from valence.session import prepare_streaming, work_dir
from valence.sources.messages import decode, file_stream, message_stream
from valence.streaming import jobs

TEXTS = ["good", "not bad", "worst", None, "  ", "\U0001F44D", "chair", "really good, not slow"]


def put(folder, name, values):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(values) + "\n", encoding="utf-8")


def lines(start, n):
    out = []
    for i in range(start, start + n):
        text = TEXTS[i % len(TEXTS)]
        out.append(json.dumps({"id": f"m{i}", "text": text, "source": "ab"[i % 2], "user": "u", "timestamp": f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}Z"}))
    return out


def stream(spark, folder):
    messages = message_stream(prepare_streaming(spark), "text", str(folder))
    return analyze(messages.withColumn("event_ts", F.expr(event_time("timestamp"))), keep=("event_ts",))


def batch(spark, folder):
    messages = decode(spark.read.text(str(folder)))
    return analyze(messages.withColumn("event_ts", F.expr(event_time("timestamp"))), keep=("event_ts",))


def test_rows_metrics_and_keywords_equal_batch_across_restarts(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path)
    for part, (start, n) in enumerate([(0, 20), (20, 13)]):
        put(folder, f"{part}.txt", lines(start, n) + ["nope", "{"])
        rows = stream(spark, folder)
        jobs.start_parquet(rows, f"{out}/rows", f"{out}/c1", once=True).awaitTermination()
        jobs.start_batches(
            jobs.metrics_stream(rows), jobs.snapshot_folder(f"{out}/metrics"), f"{out}/c2", "complete", True
        ).awaitTermination()
        own = stream(jobs.own_session(spark, jobs.KEYWORD_PARTITIONS), folder)
        jobs.start_batches(
            jobs.keyword_stream(own), jobs.snapshot_folder(f"{out}/keywords"), f"{out}/c3", "complete", True
        ).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert len(os.listdir(f"{out}/c3/state/0")) == jobs.KEYWORD_PARTITIONS + 1  # and _metadata
    want = batch(spark, folder)
    got = spark.read.parquet(f"{out}/rows")
    columns = [c for c in want.columns if c != "processed_at"]
    assert got.count() == 37
    key = lambda r: repr(tuple(r))
    assert sorted(got.select(columns).collect(), key=key) == sorted(want.select(columns).collect(), key=key)
    assert m.finish_counts(jobs.read_snapshot(spark, f"{out}/metrics")).collect() == m.kpi(want).collect()
    assert sorted(jobs.read_snapshot(spark, f"{out}/keywords").collect()) == sorted(keyword_counts(want).collect())


def test_metrics_of_an_empty_stream(spark, tmp_path):
    put(tmp_path / "in", "0.txt", [""])
    (tmp_path / "in" / "0.txt").write_text("")
    rows = stream(spark, tmp_path / "in")
    jobs.start_batches(
        jobs.metrics_stream(rows), jobs.snapshot_folder(f"{tmp_path}/m"), f"{tmp_path}/c", "complete", True
    ).awaitTermination()
    (row,) = m.finish_counts(jobs.read_snapshot(spark, f"{tmp_path}/m")).collect()
    assert row.total == 0 and row.avg_polarity == 0.0


def test_json_files_and_console(spark, tmp_path):
    put(tmp_path / "in", "0.json", lines(0, 8))
    messages = message_stream(prepare_streaming(spark), "json", str(tmp_path / "in"))
    assert messages.schema == MESSAGE
    query = jobs.start_console(analyze(messages), f"{tmp_path}/c", once=True)
    query.awaitTermination()
    assert query.lastProgress["numInputRows"] == 8


def test_two_sinks_read_the_source_once(spark, tmp_path):
    put(tmp_path / "in", "0.txt", lines(0, 16))
    seen = []
    sinks = jobs.fan_out(jobs.batch_folder(f"{tmp_path}/a"), lambda b, i: seen.append(b.count()), jobs.console_sink(1))
    query = jobs.start_batches(stream(spark, tmp_path / "in"), sinks, f"{tmp_path}/c", once=True)
    query.awaitTermination()
    assert seen == [16] and jobs.read_batches(spark, f"{tmp_path}/a").count() == 16
    assert query.lastProgress["sources"][0]["numInputRows"] == 16


def test_throughput_emits_final_minutes_and_drops_late_rows(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path)
    row = lambda i, minute, s=0: json.dumps({"id": str(i), "source": "a", "timestamp": f"2024-01-01T01:{minute:02d}:{s:02d}Z"})
    run = lambda: jobs.start_parquet(
        jobs.throughput_stream(stream(spark, folder)), f"{out}/rows", f"{out}/c", once=True
    ).awaitTermination()
    put(folder, "0.txt", [row(0, 0), row(1, 0, 59), row(2, 1), row(3, 11, 30)])
    run()
    first = {(r.window_start.minute, r.events) for r in spark.read.parquet(f"{out}/rows").collect()}
    assert first == {(0, 2)}
    put(folder, "1.txt", [row(4, 0, 5), row(5, 1, 40), row(6, 40)])
    run()
    assert {(r.window_start.minute, r.events) for r in spark.read.parquet(f"{out}/rows").collect()} == {(0, 2), (1, 2), (11, 1)}


def reset_stream(spark, folder):
    schema = T.StructType([*MESSAGE.fields, T.StructField("is_reset", T.BooleanType())])
    rows = file_stream(prepare_streaming(spark), str(folder), schema)
    rows = rows.withColumn("event_ts", F.expr(event_time("timestamp")))
    return analyze(rows, keep=("event_ts", "is_reset")).select("source", "event_ts", "is_reset", "sentiment", "polarity")


def test_resets_apply_exactly_in_any_order_of_arrival(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    item = lambda source, second, reset=False, text="good": (source, second, reset, text)
    parts = [
        [item("a", 10), item("a", 70), item("a", 130), item("b", 5), item("c", 5), item("c", 9, True)],
        # The reset arrives after later events; one event shares its moment.
        [item("a", 70, True), item("a", 71, text="bad"), item("a", 40), item("a", 30, True), item("b", 200, text="chair")],
    ]
    for i, part in enumerate(parts):
        values = [
            json.dumps({"id": "x", "text": t, "source": s, "timestamp": (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=n)).isoformat() + "Z", "is_reset": r})
            for s, n, r, t in part
        ]
        put(folder, f"{i}.json", values)
        jobs.start_batches(reset_stream(spark, folder), jobs.reset_sinks(out), f"{tmp_path}/c", once=True).awaitTermination()
    got = {r.source: (r.total, r.positive, r.negative, r.neutral) for r in m.finish_counts(jobs.read_since_reset(spark, out), "source").collect()}
    assert got == {"a": (2, 1, 1, 0), "b": (2, 1, 0, 1), "c": (0, 0, 0, 0)}


def test_repeating_a_batch_does_not_count_twice(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (2,)], "n int")
    write = jobs.batch_folder(str(tmp_path / "o"))
    write(rows, 0)
    write(rows, 0)
    write(rows, 1)
    assert jobs.read_batches(spark, str(tmp_path / "o")).count() == 4


def test_snapshots_are_kept_twice_at_most(spark, tmp_path):
    write = jobs.snapshot_folder(str(tmp_path / "o"))
    for batch in range(5):
        write(spark.createDataFrame([(batch,)], "n int"), batch)
        assert [r.n for r in jobs.read_snapshot(spark, str(tmp_path / "o")).collect()] == [batch]
    assert len([d for d in os.listdir(tmp_path / "o") if d.startswith("slot=")]) == 2


def test_open_minutes_are_kept_up_to_date(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path)
    row = lambda i, minute: json.dumps({"id": str(i), "source": "a", "timestamp": f"2024-01-01T01:{minute:02d}:00Z"})
    for part, values in enumerate([[row(0, 0), row(1, 1)], [row(2, 1), row(3, 2)]]):
        put(folder, f"{part}.txt", values)
        minutes = jobs.throughput_stream(stream(spark, folder))
        jobs.start_batches(minutes, jobs.batch_folder(f"{out}/rows"), f"{out}/c", "update", True).awaitTermination()
    got = jobs.read_newest(spark, f"{out}/rows", "window_start", "window_end", "source").collect()
    assert {(r.window_start.minute, r.events) for r in got} == {(0, 1), (1, 2), (2, 1)}


def test_a_single_sink_gets_the_batch_as_it_is(spark):
    sink = jobs.console_sink()
    assert jobs.fan_out(sink) is sink


class Session:
    """The parts of a session that the work folder depends on."""

    def __init__(self, conf, master="yarn"):
        self.conf, self.sparkContext, self.master = conf, self, master

    def getCheckpointDir(self):
        return None


def test_work_folder_follows_the_cluster_setting(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a.startswith(f"{base}/x-") and a != b
    assert work_dir(Session({"spark.checkpoint.dir": "hdfs:///shared/"}), "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError):
        work_dir(Session({}), "x")
    assert work_dir(Session({}, "local[2]"), "x")


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        message_stream(spark, "kafka")
