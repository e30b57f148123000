"""Term counts, document frequency and TF-IDF over the exact vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.arithmetic import bind
from .classifier import content_words


def _runs(words: str) -> str:
    """Distinct words of an array with their counts: sorted, equal words are neighbours."""
    # Of an empty array the sequence is [0, -1], places without a word; they give null and are left out.
    starts = "filter(sequence(0, size(sorted) - 1), i -> get(sorted, i) <> get(sorted, i - 1) OR (i = 0 AND size(sorted) > 0))"
    term = "struct(get(sorted, start) AS term, CAST(coalesce(get(starts, n + 1), size(sorted)) - start AS BIGINT) AS tf)"
    return bind("sorted", f"sort_array({words})", bind("starts", starts, f"transform(starts, (start, n) -> {term})"))


def term_counts(documents: DataFrame, key: str) -> DataFrame:
    """``tf`` of each term of each document (row), counted within the row: no shuffle."""
    words = content_words(documents.select(key, "text"))
    # The outer form, as Spark derives a filter on the array from the plain one and takes the words twice.
    counted = words.selectExpr(f"`{key}`", f"inline_outer({_runs('filtered')})")
    return counted.where(F.col("term").isNotNull())


# Terms that are joined by a copy of their weights in every task: a bound on what is broadcast.
FREQUENT = 10_000


def idf_of_counts(tf: DataFrame, documents: DataFrame) -> DataFrame:
    """The same as ``idf`` from stored term counts: a document has a row for each of its terms."""
    n_docs = documents.agg(F.count("*")).scalar()
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    return df.select("term", "df", F.ln((n_docs + 1) / (F.col("df") + 1)).alias("idf"))


def idf(documents: DataFrame) -> DataFrame:
    """``ln((documents + 1) / (df + 1))`` per term. The document count is a scalar subquery.

    A document hands on each of its words once, and each task one row per term.
    """
    n_docs = documents.agg(F.count("*")).scalar()
    terms = content_words(documents.select("text")).selectExpr("explode_outer(array_distinct(filtered)) AS term")
    df = terms.where(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("df"))
    return df.select("term", "df", F.ln((n_docs + 1) / (F.col("df") + 1)).alias("idf"))


def tfidf(tf: DataFrame, weights: DataFrame) -> DataFrame:
    """Weights of all terms. ``tf`` and ``weights`` should be stored tables, as they are read twice.

    The ``FREQUENT`` most frequent terms are joined where they are read, so that
    no task gets all rows of a hot term; the others meet by their term.
    """
    top = F.broadcast(weights.orderBy(F.desc("df"), "term").limit(FREQUENT).select("term", "idf"))
    often = tf.join(top, "term")
    seldom = tf.join(top, "term", "left_anti").join(weights.select("term", "idf"), "term")
    return often.unionByName(seldom).withColumn("tfidf", F.col("tf") * F.col("idf"))
