"""Running totals, class shares and average polarity of scored rows."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arithmetic import literal, literals, mean_milli, percent, to_milli
from ..functions.lexicon import KEYWORDS
from ..functions.text import pointer_percent, polarity_band, signed_text
from ..sinks.writers import stage
from .keywords import first_place
from .prefix import before_blocks, block_of, numbered
from .throughput import SPAN, rate_columns

CLASSES = ("Positive", "Negative", "Neutral")


def count_columns() -> list[Column]:
    """Additive counts: one partial row per task and group, whatever the input size."""
    return [
        F.count("*").alias("total"),
        *[F.expr(f"count_if(sentiment = {literal(name)}) AS {name.lower()}") for name in CLASSES],
        F.expr(f"sum({to_milli('polarity')}) AS polarity_milli"),
    ]


def finish_counts(counts: DataFrame, *keys: str, rounding: str = "exact") -> DataFrame:
    """Shares and average of summed counts.

    ``rounding="binary"`` rounds the double quotients half to even, as plain
    double arithmetic does; the sum of polarities stays exact.
    """
    classes = [name.lower() for name in CLASSES]
    return counts.selectExpr(
        *[f"`{key}`" for key in keys],
        "total",
        *[f"coalesce({name}, 0L) AS {name}" for name in classes],
        *[f"{percent(name, 'total', rounding)} AS {name}_pct" for name in classes],
        f"{mean_milli('polarity_milli', 'total', rounding)} AS avg_polarity",
    )


def kpi(scored: DataFrame, *keys: str, ts: str | None = None, rounding: str = "exact") -> DataFrame:
    """Metrics of all rows (one row, also on empty input) or per ``keys``; with ``ts``, their start time too."""
    start = [F.min(ts).alias("started_at")] if ts else []
    counts = scored.groupBy(*keys).agg(*start, *count_columns())
    return finish_counts(counts, *keys, *(["started_at"] if ts else []), rounding=rounding)


def kpi_display(metrics: DataFrame) -> DataFrame:
    """Display values of a metrics row."""
    return metrics.selectExpr(
        "*",
        f"{signed_text('avg_polarity')} AS polarity_text",
        f"{polarity_band('avg_polarity')} AS polarity_band",
        f"{pointer_percent('avg_polarity')} AS pointer_pct",
    )


def distribution(scored: DataFrame) -> DataFrame:
    """Count and share per class. All three classes appear, also with no rows."""
    counts = scored.agg(*count_columns())
    classes = ", ".join(f"struct({literal(name)} AS sentiment, {name.lower()} AS cnt)" for name in CLASSES)
    rows = counts.selectExpr("total", f"inline(array({classes}))")
    return rows.selectExpr("sentiment", "cnt", f"{percent('cnt', 'total')} AS pct")


def snapshot(scored: DataFrame, throughput_eps: Column, ts: str = "event_ts", number: str | None = None, k: int = 10) -> DataFrame:
    """One row: the metrics and the top keywords as JSON, from one pass over the scored rows.

    Each row counts once under the null keyword, which carries the totals, and
    once under each of its keywords: at most 149 groups reach the shuffle, and
    the lists below hold at most 148 entries.
    """
    tagged = scored.selectExpr(
        "sentiment", "polarity", *([ts, number] if number else [ts]), "explode_outer(concat(array(CAST(NULL AS STRING)), keywords)) AS keyword"
    )
    groups = tagged.groupBy("keyword").agg(*count_columns(), first_place(ts, number).alias("first_seen"))
    total_of = lambda name: f"max(CASE WHEN keyword IS NULL THEN {name} END)"
    entry = "CASE WHEN keyword IS NOT NULL THEN struct(-total AS order, first_seen, keyword, total AS cnt) END"
    row = groups.agg(
        F.expr(f"coalesce({total_of('total')}, 0L) AS total"),
        *[F.expr(f"{total_of(name)} AS {name}") for name in ("positive", "negative", "neutral", "polarity_milli")],
        F.expr(f"slice(sort_array(collect_list({entry})), 1, {k}) AS top"),
    )
    numbers = finish_counts(row, "top").withColumn("throughput_eps", throughput_eps)
    fields = [name for name in numbers.columns if name != "top"]
    return numbers.selectExpr(*fields, f"{_payload(fields)} AS metrics")


def metrics_at_events(scored: DataFrame, ts: str = "event_ts", number: str = "event_id", keep: tuple[str, ...] = (), k: int = 10) -> DataFrame:
    """``keep, metrics``: for each event the metrics and top keywords after it, as JSON.

    Events are ordered by time, those without a time first, then by ``number``. Each event
    stands in that order twice: at its time, and where it leaves the trailing window. The
    rate at an event is then a difference of two running counts. A task holds a block of
    the order at a time, and adds to what the block begins with: the sums, and 148 keyword
    counts, which stand in no row that is shuffled or sorted.
    """
    columns = {"at": f"CAST({ts} AS TIMESTAMP)", "number": number, "sentiment": "sentiment", "milli": to_milli("polarity"), "keywords": "keywords"}
    # Written once: texts are scored once, and what is kept of an event meets its metrics by the row's place.
    rows = scored.selectExpr("monotonically_increasing_id() AS row", *[f"{e} AS {c}" for c, e in columns.items()], *quoted(keep))
    rows = stage(rows, "scored")
    enters = rows.select(F.lit(0).alias("kind"), "row", *columns)
    # The end of the window counts as inside: of equal times, entries come before exits.
    away = rows.where("at IS NOT NULL").selectExpr("1 AS kind", "-1L AS row", f"at + INTERVAL {SPAN} SECONDS AS at", "number")
    placed = numbered(enters.unionByName(away, allowMissingColumns=True), F.col("at").asc_nulls_first(), F.col("kind"), F.col("number"))
    placed = placed.withColumn("block", block_of())

    names = ["total", "timed", "left", *[name.lower() for name in CLASSES], "polarity_milli"]
    sums = placed.groupBy("block").agg(
        F.expr("count_if(kind = 0) AS total"), F.expr("count_if(kind = 0 AND at IS NOT NULL) AS timed"), F.expr("count_if(kind = 1) AS left"),
        *[F.expr(f"count_if(sentiment = {literal(name)}) AS {name.lower()}") for name in CLASSES], F.expr("coalesce(sum(milli), 0L) AS polarity_milli"),
    )
    begins = before_blocks(sums, names).select("block", *[F.col(n).alias(f"{n}_before") for n in names])
    hits = placed.where("kind = 0").select("block", "pos", F.explode_outer("keywords").alias("keyword")).where("keyword IS NOT NULL")
    hits = hits.groupBy("block", "keyword").agg(F.count("*").alias("cnt"), F.min("pos").alias("first"))
    grid = sums.selectExpr("block", f"posexplode(array({literals(KEYWORDS)})) AS (i, keyword)").join(hits, ["block", "keyword"], "left")
    grid = grid.withColumn("cnt", F.coalesce("cnt", F.lit(0)))
    known = before_blocks(grid, ["cnt"], "keyword", least=("first",)).withColumnsRenamed({"cnt": "before", "first": "earlier"})
    known = grid.join(known, ["block", "keyword"]).selectExpr("block", "struct(i, before, least(first, earlier) AS first) AS entry")
    known = known.groupBy("block").agg(F.sort_array(F.collect_list("entry")).alias("known"))
    known = known.selectExpr("block", "known.before AS before", "known.first AS first")

    # Within a block: running sums, one for each keyword too, and of these the k largest at each event.
    slim = placed.select("block", "pos", "row", "kind", F.col("at").isNotNull().alias("timed"), "sentiment", "milli", "keywords")
    out = ", ".join([f"{name} bigint" for name in ("row", *names)]) + ", top array<bigint>"
    starts = begins.join(known, "block").withColumnRenamed("block", "of")
    ran = slim.groupBy("block").cogroup(starts.groupBy("of")).applyInArrow(_run_block(names, k), out)
    # Texts are put together after the join: until then an event is its row, some numbers and ``k`` places in the list of keywords.
    ran = rows.select("row", *[F.col(name).alias(f"kept_{i}") for i, name in enumerate(quoted(keep))]).join(ran, "row")
    kept = [f"kept_{i}" for i in range(len(keep))]
    ran = ran.selectExpr(*kept, *[n for n in names if n not in ("timed", "left")], rate_columns("(timed - left)")[0], f"{_PAIRS} AS pairs")
    numbers = finish_counts(ran, *kept, "throughput_eps", "pairs")
    fields = [c for c in numbers.columns if c not in (*kept, "throughput_eps", "pairs")]
    body = f"to_json(struct({', '.join([*fields, 'throughput_eps'])}))"
    return numbers.selectExpr(
        *[f"{c} AS {name}" for c, name in zip(kept, quoted(keep))], f"concat(rtrim('}}', {body}), ',\"top_keywords\":[', pairs, ']}}') AS metrics"
    )


# A keyword's place in ``KEYWORDS`` or in an order of them, and a count, in one number.
_PLACE_BITS = len(KEYWORDS).bit_length()


def _run_block(names: list[str], k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Running values of the events of one block: sums of ``names``, and the ``k`` most frequent keywords as counts with places."""
    # Held by the function, which workers get by value: they need Arrow and numpy only, not this package.
    words, classes, bits = list(KEYWORDS), list(CLASSES), _PLACE_BITS
    alphabet = np.argsort(sorted(range(len(words)), key=lambda i: words[i].encode()))

    def run(rows: pa.Table, start: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        begin = start.to_pylist()[0]
        kind = rows["kind"].to_numpy()
        enters = kind == 0
        steps = {"total": enters, "timed": enters & rows["timed"].to_numpy(), "left": ~enters, "polarity_milli": pc.fill_null(rows["milli"], 0).to_numpy()}
        steps |= {name.lower(): pc.fill_null(pc.equal(rows["sentiment"], name), False).to_numpy() for name in classes}
        out = {"row": rows["row"].to_numpy()[enters]}
        out |= {name: begin[f"{name}_before"] + np.cumsum(steps[name], dtype=np.int64)[enters] for name in names}

        lists = pa.concat_arrays(rows["keywords"].chunks)
        found = pc.index_in(pc.list_flatten(lists), value_set=pa.array(words))
        at, word = pc.list_parent_indices(lists).to_numpy(), found.fill_null(-1).to_numpy()
        counts = np.bincount((at * len(words) + word)[word >= 0], minlength=len(kind) * len(words)).reshape(len(kind), len(words))
        counts = np.array(begin["before"], dtype=np.int64) + np.cumsum(counts, axis=0, dtype=np.int64)[enters]
        # Of equal counts the keyword seen first wins, and of those of one event the smaller one: an order that the block keeps.
        first = np.array([np.iinfo(np.int64).max if f is None else f for f in begin["first"]], dtype=np.int64)
        order = np.lexsort((alphabet, first))
        place = np.argsort(order)
        best = np.sort(np.partition(place - (counts << bits), min(k, len(words)) - 1, axis=1)[:, :k], axis=1)
        seen = best < 0
        # Places in the order become places in the list.
        mask = (1 << bits) - 1
        top = (-(best >> bits) << bits | order[best & mask])[seen]
        ends = np.concatenate([[0], np.cumsum(seen.sum(axis=1))]).astype(np.int32)
        return pa.table(out | {"top": pa.ListArray.from_arrays(ends, pa.array(top, pa.int64()))})

    return run


def quoted(names: tuple[str, ...]) -> list[str]:
    return [f"`{name}`" for name in names]


# A pair holds a text and a number, which no array type does: the list of keywords is put together as text, from its literal beginnings.
_BEGINNINGS = f"array({literals(f'[{json.dumps(word, ensure_ascii=False)},' for word in KEYWORDS)})"
_PAIRS = f"array_join(transform(top, e -> concat(get({_BEGINNINGS}, CAST(e & {(1 << _PLACE_BITS) - 1} AS INT)), shiftright(e, {_PLACE_BITS}), ']')), ',')"


def _payload(fields: list[str]) -> str:
    """JSON of numbers and the list ``top`` of keywords with counts."""
    # A pair holds a text and a number, which no array type does: the list is put together as text.
    pair = "concat(rtrim(']', to_json(array(e.keyword))), ',', e.cnt, ']')"
    pairs = f"array_join(transform(coalesce(top, array()), e -> {pair}), ',')"
    return f"concat(rtrim('}}', to_json(struct({', '.join(fields)}))), ',\"top_keywords\":[', {pairs}, ']}}')"


def after_reset(rows: DataFrame, resets: DataFrame, ts: str) -> DataFrame:
    """Rows after the last reset; all rows where there was none.

    Of a row without a time it is not known that it came after a reset: it counts
    only where there was none. The last reset is a scalar subquery, known before
    the scan starts.
    """
    last = resets.agg(F.max(ts).alias("reset_at"))
    return rows.where(last.scalar().isNull() | (F.col(ts) > last.scalar()))
