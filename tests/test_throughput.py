"""Trailing throughput against a direct count."""

import datetime as dt
import random

from pyspark.sql import functions as F

from valence.operators.throughput import throughput_asof, throughput_series

START = dt.datetime(2024, 1, 1, 0, 59, 30)


def events(spark, rows):
    return spark.createDataFrame(rows, "source string, ts timestamp_ntz").repartition(5)


def at(seconds, micros=0):
    return START + dt.timedelta(seconds=seconds, microseconds=micros)


def direct(rows):
    span = dt.timedelta(seconds=60)
    out = {}
    for source, ts in rows:
        if ts is not None:
            near = [t for s, t in rows if s == source and t is not None and ts - span <= t <= ts]
            out[source, ts] = (rows.count((source, ts)), len(near))
    return out


def test_series_matches_direct_count(spark):
    rng = random.Random(1)
    rows = [("hot", at(rng.randint(0, 90), rng.choice([0, 1, 500_000, 999_999]))) for _ in range(300)]
    rows += [("b", at(rng.randint(-4000, 4000), rng.randint(0, 999_999))) for _ in range(200)]
    rows += [("edge", at(s, m)) for s in (0, 59, 60, 61) for m in (0, 1)] + [("edge", at(60)), ("late", None)]
    rows += [(None, at(s)) for s in (0, 30, 60, 200)]
    rows += [("old", dt.datetime(1969, 12, 31, 23, 59, s, 250_000)) for s in range(0, 60, 7)] + [("old", dt.datetime(1970, 1, 1))]
    got = {
        (r.source, r.event_ts): (r.events, r.events_60s)
        for r in throughput_series(events(spark, rows), "ts", "source")
        .withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))
        .collect()
    }
    assert got == direct(rows)


def test_series_of_one_hot_moment_sums_copies_before_the_shuffle(spark):
    copies = spark.range(0, 50_000).select(F.lit("hot").alias("source"), F.lit(at(0)).cast("timestamp_ntz").alias("ts"))
    (row,) = throughput_series(copies, "ts", "source").collect()
    assert (row.events, row.events_60s) == (50_000, 50_000)
    assert (row.throughput_eps, row.throughput_eps_saturated) == (833.33, 1.0)


def test_asof_counts_both_ends(spark):
    rows = [("a", at(-1))] + [("a", at(0))] * 40 + [("b", at(60))] * 50
    (row,) = throughput_asof(events(spark, rows), "ts").collect()
    assert (row.events_60s, row.throughput_eps, row.throughput_eps_saturated) == (90, 1.5, 1.0)
    (row,) = throughput_asof(events(spark, rows), "ts", F.lit(at(59)).cast("timestamp_ntz")).collect()
    assert row.events_60s == 41 and row.throughput_eps == 0.68


def test_asof_of_nothing(spark):
    (row,) = throughput_asof(events(spark, []), "ts").collect()
    assert (row.events_60s, row.throughput_eps, row.throughput_eps_saturated) == (0, 0.0, 0.0)
