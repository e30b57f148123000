"""What the optimizer makes of the queries."""

import re

import pytest

from valence.plans import QUERIES
from valence.functions.sentiment import with_sentiment
from valence.operators import terms
from valence.operators.throughput import throughput_series
from valence.plans.learning import labelled_features
from valence.sources.tables import INPUT_PARTITIONS, feed_of, table

FOLDER = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


SCORED = [
    "scored_feed", "scored_documents", "scored_conversations", "kpi_metrics", "kpi_by_source", "keyword_counts",
    "top_keywords", "sentiment_distribution", "history_latest", "feed_latest", "eval_accuracy", "payload_json",
]


@pytest.mark.parametrize("name", SCORED)
def test_texts_are_tokenized_once(spark, name):
    assert optimized(QUERIES[name](spark, FOLDER)).count("regexp_extract_all") == 1


@pytest.mark.parametrize("name", sorted(set(QUERIES)))
def test_no_python_workers_and_no_cross_joins(spark, name):
    plan = physical(QUERIES[name](spark, FOLDER))
    assert not re.search(r"EvalPython|InPandas|InArrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_scoring_needs_no_shuffle(spark):
    assert "Exchange" not in physical(with_sentiment(feed_of(table(spark, FOLDER, "events"))))


def test_a_filter_on_the_key_reaches_the_scan_and_only_needed_columns_are_read(spark):
    rows = with_sentiment(table(spark, FOLDER, "documents")).where("doc_id < 10").select("doc_id", "analysis.polarity")
    plan = physical(rows)
    assert "LessThan(doc_id,10)" in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "sort_array" not in plan


def test_newest_rows_are_chosen_before_scoring_by_the_time_column(spark):
    plan = physical(QUERIES["history_latest"](spark, FOLDER))
    assert plan.index("regexp_extract_all") < plan.index("TakeOrderedAndProject")
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan
    assert re.search(r"DataFilters: \[.*\(ts#\d+ >= Subquery", plan)


def test_metrics_combine_before_the_shuffle(spark):
    for name in ("kpi_by_source", "keyword_counts", "throughput_series", "idf_exact"):
        plan = physical(QUERIES[name](spark, FOLDER))
        assert "SortAggregate" not in plan and "partial_" in plan, name


def test_series_windows_are_keyed_by_short_spans(spark):
    events = table(spark, FOLDER, "events")
    plan = physical(throughput_series(events, "ts", "event_type"))
    windows = re.findall(r"Window \[.*\], \[([^\]]*)\]", plan)
    assert windows and "SinglePartition" not in plan
    assert "hashpartitioning(marker" in plan and not re.search(r"hashpartitioning\(marker#\d+, \d+\)", plan)


def test_term_counts_need_no_shuffle(spark):
    plan = physical(terms.term_counts(table(spark, FOLDER, "documents"), "doc_id"))
    assert "Exchange" not in plan


def test_ml_words_are_taken_once(spark):
    assert optimized(QUERIES["tf_exact"](spark, FOLDER)).count("UDF(UDF(") == 1


def test_scans_are_dealt_out_only_where_the_caller_says_so(spark):
    assert "Exchange" not in physical(QUERIES["scored_documents"](spark, FOLDER))
    spark.conf.set(INPUT_PARTITIONS, "3")
    try:
        assert table(spark, FOLDER, "documents").rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(INPUT_PARTITIONS)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_are_not_shuffled(spark, no_broadcast):
    for df in (QUERIES["eval_accuracy"](spark, FOLDER), labelled_features(spark, FOLDER)):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", df._jdf.queryExecution().explainString(mode))
        assert shuffled and not any("text#" in columns for columns in shuffled)


def test_frequent_terms_are_not_shuffled(spark, no_broadcast):
    tf = spark.createDataFrame([(1, "a", 2)], "doc_id int, term string, tf long")
    plan = physical(terms.tfidf(tf, spark.createDataFrame([("a", 1, 0.5)], "term string, df long, idf double")))
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1


def test_the_series_is_shuffled_once_for_cells_and_once_for_spans(spark, no_broadcast):
    plan = physical(throughput_series(table(spark, FOLDER, "events"), "ts", "event_type"))
    assert plan.count("Exchange hashpartitioning") <= 6
