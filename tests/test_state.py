"""Defaults for missing keys, and state of streams, against plain versions in odd cases."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from valence.operators import messages
from valence.plans import QUERIES, streams
from valence.schemas import MESSAGE
from valence.sources.messages import file_stream
from valence.streaming import jobs, state


def test_defaults_stand_for_missing_keys_only(spark):
    rows = [
        ('{"id":"a","text":"t"}', "request"), ('{"id":"a","text":"t","source":null,"user":null}', "request"), ('{"id":"a","source":"","user":""}', "request"),
        ('{"id":"a","source":"","user":null}', "display"), ('{"source":null}', "socket"), ('{"text":null,"user":"x"}', "socket"), ("{}", "producer"),
        ("[]", "request"), ("null", "request"), ("{", "request"), (None, "socket"), ('{"id":7,"text":{"a":[1]},"user":true}', "function"),
    ]
    got = messages.decode_with_defaults(spark.createDataFrame(rows, "value string, channel string").coalesce(1), "channel")
    assert got.columns == MESSAGE.names
    anyone = got.collect()[6].user
    assert anyone.startswith("user_")
    nothing = (None,) * 5
    assert [tuple(r) for r in got.collect()] == [
        ("a", "t", "ManualInput", "LiveTester", None), ("a", "t", None, None, None), ("a", None, "", "", None),
        ("a", None, "Stream", "anon", "00:00:00"), (None, "", None, "dashboard_user", None), (None, None, "WebClient", "dashboard_user", None),
        (None, None, "LiveStream", anyone, None), nothing, nothing, nothing, nothing, ("7", '{"a":[1]}', "LiveFeed", "true", None),
    ]


def _batches(spark, tmp_path, parts, schema):
    """A stream that reads one part a batch, in order."""
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).repartition(3).write.mode("overwrite").parquet(str(tmp_path / f"in/n={i}"))
        import time

        time.sleep(1.1)  # the source orders files by their second
    return file_stream(jobs.own_session(spark, 2), str(tmp_path / "in/n=*"), spark.createDataFrame([], schema).schema, "parquet", maxFilesPerTrigger="3")


def test_history_keeps_the_newest_rows_of_all_batches(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s) if s is not None else None
    parts = [[(i, at(i % 40 if i % 9 else None), f"t{i}") for i in range(60)], [(i, at(i - 100), None) for i in range(100, 130)], [(5, at(5), "t5"), (500, at(39), "x")]]
    rows = _batches(spark, tmp_path, parts, "number bigint, ts timestamp, text string")
    newest = state.history_stream(rows, 7, "ts", "number")
    write = jobs.snapshot_folder(str(tmp_path / "rows"))
    for _ in range(2):  # the second run finds nothing new
        jobs.start_batches(newest, write, str(tmp_path / "checkpoint"), mode="update", once=True).awaitTermination()
    got = [(r.number, r.ts, r.text) for r in jobs.read_snapshot(spark, str(tmp_path / "rows")).orderBy("place").collect()]
    every = {(r[0], r[1]): r for part in parts for r in part}.values()
    assert got == sorted(every, key=lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[0]), reverse=True)[:7]


def test_rate_counts_late_events_and_both_ends(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    parts = [[("a", at(0)), ("a", at(0)), ("a", at(10)), ("b", at(5)), ("b", None)], [("a", at(60)), ("a", at(1)), ("b", at(5.000001))], [("a", at(-30)), ("b", at(65.5)), ("b", at(5.5))]]
    rows = _batches(spark, tmp_path, parts, "source string, event_ts timestamp")
    write = jobs.batch_folder(str(tmp_path / "rows"))
    jobs.start_batches(state.throughput_now(rows, delay="1 hour"), write, str(tmp_path / "checkpoint"), mode="update", once=True).awaitTermination()
    got = {r.source: (r.event_ts, r.events_60s) for r in jobs.read_newest(spark, str(tmp_path / "rows"), "source").collect()}
    assert got == {"a": (at(60), 5), "b": (at(65.5), 2)}


def test_counts_since_the_last_reset_do_not_depend_on_the_order(spark, tmp_path):
    """Late resets, resets beside events of the same time, resets older than the last, and times that the watermark has settled."""
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    event = lambda key, s, name="Positive": (key, at(s), False, name, 0.5)
    reset = lambda key, s: (key, at(s), True, "Neutral", 0.0)
    parts = [
        [event("a", 10), event("a", 20, "Negative"), event("a", 20), event("b", 1), reset("c", 5), event("d", 3), ("b", None, False, "Positive", 0.5)],
        [reset("a", 20), event("a", 21), reset("a", 15), event("b", 4000), event("c", 5), event("c", 6, "Neutral"), event("d", 4000)],
        [event("a", 4001), event("b", 4002), reset("d", 4000), event("d", 4000.5), event("c", 4003)],
        [event("b", 4004), reset("b", 2), event("d", 4000.2), event("a", 4005)],
    ]
    rows = _batches(spark, tmp_path, parts, "source string, event_ts timestamp, is_reset boolean, sentiment string, polarity double")
    write = jobs.batch_folder(str(tmp_path / "rows"))
    jobs.start_batches(state.since_reset(rows, delay="10 minutes"), write, str(tmp_path / "checkpoint"), mode="update", once=True).awaitTermination()
    got = {r.source: (r.total, r.positive, r.negative, r.neutral, r.polarity_milli) for r in jobs.read_newest(spark, str(tmp_path / "rows"), "source").collect()}
    # The reset of b at 2 comes more than the delay late, so it does not count.
    assert got == {"a": (3, 3, 0, 0, 1500), "b": (4, 4, 0, 0, 2000), "c": (2, 1, 0, 1, 1000), "d": (2, 2, 0, 0, 1000)}


@pytest.mark.parametrize("name", ["throughput_now_stream", "reset_state_stream", "history_stream", "replayed_stream"])
def test_batches_do_not_grow_with_the_files(spark, tmp_path, monkeypatch, name):
    """A table of many files makes no more batches than one of a single file; ids below zero and missing ones are read as well."""
    monkeypatch.setattr(streams, "work_dir", lambda spark, label: str(tmp_path / "work"))
    given = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    odd = given.limit(40).withColumn("event_id", F.expr("CASE WHEN event_id % 5 > 0 THEN -event_id END"))
    given.unionByName(odd).repartition(7).write.parquet(str(tmp_path / "events.parquet"))
    rows = QUERIES[name](spark, str(tmp_path)).collect()
    assert len(list((tmp_path / "work/checkpoint/commits").glob("[0-9]*"))) <= 8
    if name == "reset_state_stream":  # the same sums from stored minutes
        monkeypatch.setattr(streams, "work_dir", lambda spark, label: str(tmp_path / "other"))
        assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["reset_stream"](spark, str(tmp_path)).collect()))


def test_tasks_hand_on_what_can_still_count():
    """Of many batches of a task: the times of the last span, and the last reset with the times after it, null keys included."""
    n = 120_000
    at = pd.to_datetime(pd.Series(range(n)) * 10_000_000, unit="ns")  # 100 a second
    rows = pd.DataFrame({"source": [None if i % 2 else "a" for i in range(n)], "event_ts": at, "n": 1})
    parts = lambda rows: (rows.iloc[i : i + 10_000] for i in range(0, len(rows), 10_000))
    (got,) = state._folded(parts(pd.concat([rows, rows])), lambda part: state._last_span(part, "source"))
    assert len(got) == 6001 + 1 and set(got["n"]) == {2} and got["source"].isna().sum() == 3001
    marks = rows.assign(is_reset=[i in (10, 60_000, 119_000, 119_001) for i in range(n)], **{name: 1 for name in state._COUNTS})
    (got,) = state._folded(parts(marks.sample(frac=1, random_state=1)), lambda part: state._after_resets(part, "source"))
    assert len(got) == 1000 and got["is_reset"].sum() == 2 and got["event_ts"].min() == at[119_000]
    kept = marks.assign(is_reset=False)  # without a reset every time can still count
    (got,) = state._folded(parts(kept), lambda part: state._after_resets(part, "source"))
    assert len(got) == n and got["total"].sum() == n
