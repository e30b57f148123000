"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
runs once to warm up, then ``BENCH_RUNS`` times; the best time counts. The
``twin`` figures are a row-at-a-time Python UDF on the same texts: the second
implementation of the rules that the tests use, in double arithmetic.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark import cloudpickle
from pyspark.sql import SparkSession, functions as F

from valence.functions import lexicon
from valence.functions.sentiment import with_sentiment
from valence.plans import QUERIES
from valence.session import prepare
from valence.sources.tables import INPUT_PARTITIONS, event_feed, table

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tests"))
import brute  # noqa: E402

# The twin runs in workers that may not have this folder.
for module in (brute, lexicon):
    cloudpickle.register_pickle_by_value(module)

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
# The rates are taken on this many copies of the texts, so that planning does not hide them.
COPIES = int(os.environ.get("BENCH_COPIES", "5"))

HEADLINE = [
    "scored_feed", "scored_documents", "scored_conversations", "kpi_metrics", "kpi_by_source", "sentiment_distribution",
    "keyword_counts", "top_keywords", "throughput_asof", "throughput_series", "metrics_since_reset", "history_latest",
    "feed_latest", "polarity_timeline", "metrics_payload", "json_parse", "payload_json", "message_build",
    "text_lines_clean", "feed_union", "hash_sample", "hash_sample_exact", "train_test_split", "ml_tokenize",
    "ml_stopwords", "tf_exact", "idf_exact", "tfidf_exact", "eval_accuracy", "classify", "score_stream",
    "metrics_stream", "keyword_stream", "throughput_stream", "reset_stream", "event_envelopes", "initial_envelope",
    "two_sinks_stream", "classify_stream", "corpus_load", "sql_function", "kpi_metrics_binary",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The tables are files of one row group: name the number of parts to use all cores.
    spark.conf.set(INPUT_PARTITIONS, str(CPUS))
    return prepare(spark)


TWIN = "sentiment string, polarity double, confidence double, positive double, negative double, keywords array<string>"


def seconds(build) -> float:
    """Best time to build and fully run a query."""
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def rates(spark: SparkSession) -> dict[str, dict[str, float]]:
    """Texts per second, native against the row-at-a-time twin, on the same stored input."""
    udf = F.udf(lambda text: brute.score(text, binary=True), TWIN)
    texts = {
        "documents": table(spark, FOLDER, "documents").select("text"),
        "feed": event_feed(spark, FOLDER).select("text"),
    }
    out = {}
    for name, df in texts.items():
        kept = df.select("text", F.explode(F.sequence(F.lit(1), F.lit(COPIES)))).select("text").persist()
        n = kept.count()
        native = seconds(lambda: with_sentiment(kept).select("analysis.*"))
        binary = seconds(lambda: with_sentiment(kept, rounding="binary").select("analysis.*"))
        twin = seconds(lambda: kept.select(udf("text").alias("analysis")).select("analysis.*"))
        out[name] = {
            "texts": n, "native_sec": native, "native_binary_sec": binary, "twin_sec": twin, "speedup": round(twin / native, 2),
        }
        kept.unpersist()
    return out


def main() -> None:
    spark = session()
    only = sys.argv[1:] or HEADLINE
    for name in only[:3]:
        seconds(lambda: QUERIES[name](spark, FOLDER))
    timed = {}
    for name in only:
        timed[name] = seconds(lambda: QUERIES[name](spark, FOLDER))
        print(f"{name} {timed[name]}", file=sys.stderr, flush=True)
    twin = rates(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": float(re.search(r"sf([\d.]+)", FOLDER).group(1)) if re.search(r"sf([\d.]+)", FOLDER) else None,
                "cpus": CPUS,
                "native_vs_row_udf": twin,
            }
        )
    )


if __name__ == "__main__":
    main()
