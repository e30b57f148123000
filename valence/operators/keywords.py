"""Keyword counts and the most frequent keywords."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import adds_negative, displays_negative


_ABOVE = 10**19  # more than any bigint


def first_place(ts: str, number: str | None) -> Column:
    """Smallest (time, number), as one decimal: such a minimum is hashed, that of a struct would have to be sorted."""
    micros = f"CAST(unix_micros(CAST({ts} AS TIMESTAMP)) AS DECIMAL(38, 0))"
    return F.min(F.expr(f"{micros} * {_ABOVE} + coalesce({number}, 0L)" if number else f"{micros} * {_ABOVE}"))


def keyword_counts(scored: DataFrame, ts: str = "event_ts", number: str | None = None) -> DataFrame:
    """Texts per keyword, the time of the first one, and its place in the order of time and, where given, ``number``.

    There are at most 148 keys (each listed word, plain or negated, and two for
    emoji), so every task hands on at most that many partial rows.
    """
    # The outer form, as Spark derives a filter on the array from the plain one and scores texts twice.
    columns = [ts, number] if number else [ts]
    hits = scored.select(F.explode_outer("keywords").alias("keyword"), *columns).where(F.col("keyword").isNotNull())
    return hits.groupBy("keyword").agg(
        F.count("*").alias("cnt"), F.min(ts).alias("first_seen"), first_place(ts, number).alias("first_place")
    )


def top_keywords(counts: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent keywords; of equal counts, the one seen first, by time and number.

    ``is_neg_display`` is the display's substring test, ``is_neg`` the word list's answer.
    """
    ranked = counts.orderBy(F.desc("cnt"), F.asc("first_place"), F.asc("keyword")).limit(k)
    return ranked.selectExpr(
        "keyword", "cnt", f"{displays_negative('keyword')} AS is_neg_display", f"{adds_negative('keyword')} AS is_neg"
    )
