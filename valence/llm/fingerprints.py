"""Document fingerprints of closed syncmers over words.

A text is a sequence of words (an ideograph is a word of its own). Of every run of
``K`` words the inner runs of ``S`` words are hashed; the run is an anchor if the
smallest of these hashes lies at its first or last place. The choice looks at
nothing outside the run, so a passage keeps its anchors wherever it stands. The fingerprint
is all anchors with their places. Two fingerprints are compared by all of them: how
many they have in common, and where neighbouring anchors moved by the same number of
words, which makes them one shared passage.

All steps are Spark SQL expressions; a text is compared within its row.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from ..sinks.writers import stage

K, S = 5, 2
#: Letters of scripts without spaces between words; each is a word of its own.
ALONE = r"[\u0E00-\u0E7F\u2E80-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]"


def words(text: str) -> str:
    """SQL for the words of a text: what stands between white space; plain ASCII needs no look at scripts."""
    body = f"coalesce(`{text}`, '')"
    parted = f"CASE WHEN octet_length({body}) = char_length({body}) THEN {body} ELSE regexp_replace({body}, r'({ALONE})', ' $1 ') END"
    return f"array_remove(split({parted}, r'\\s+'), '')"


def with_anchors(rows: DataFrame, text: str, into: str = "anchors") -> DataFrame:
    """Add ``into``: array of ``hash, pos, words`` of a text's closed syncmers, in order; ``pos`` counts words.

    ``hash`` has 32 bits, ``words`` is the number of words of the run.

    A text of fewer than ``K`` words has one anchor, its whole word sequence; a
    null text or one without words has none.
    """
    own = [F.col(f"`{c}`") for c in rows.columns]
    last = K - S
    inner = ", ".join(f"get(__g, i + {j})" for j in range(1, last))
    pair = ", ".join(["h", *(f"get(__h, i + {j})" for j in range(1, S))])
    run = ", ".join(f"get(__h, i + {j})" for j in range(K))
    hashed = rows.select(*own, F.expr(f"transform({words(text)}, w -> xxhash64(w))").alias("__h"))
    # The last hashes lack words of their run; no anchor looks at them.
    inners = hashed.select(*own, "__h", F.expr(f"CASE WHEN size(__h) >= {K} THEN transform(__h, (h, i) -> xxhash64({pair})) END").alias("__g"))
    closed = f"least(get(__g, i), get(__g, i + {last})) <= least({inner})"
    anchors = f"""CASE WHEN __g IS NOT NULL THEN
          transform(filter(sequence(0, size(__h) - {K}), i -> {closed}),
                    i -> named_struct('hash', CAST(shiftright(xxhash64({run}), 32) AS INT), 'pos', i, 'words', {K}))
        WHEN size(__h) > 0 THEN array(named_struct('hash', CAST(shiftright(xxhash64(__h), 32) AS INT), 'pos', 0, 'words', size(__h)))
        ELSE CAST(array() AS ARRAY<STRUCT<hash: INT, pos: INT, words: INT>>) END"""
    return inners.select(*own, F.expr(anchors).alias(into))


def digest(anchors: str) -> Column:
    """Anchors as text, in order: a hex digit for the words since the anchor before (three at most), eight for the hash.

    Empty for a text without words.
    """
    gap = f"hex(a.pos - IF(i = 0, 0, get(`{anchors}`, i - 1).pos))"
    return F.expr(f"lower(array_join(transform(`{anchors}`, (a, i) -> concat({gap}, right(concat('0000000', hex(a.hash)), 8))), ''))")


def with_ranked(rows: DataFrame, anchors: str, into: str, side: int) -> DataFrame:
    """Add ``into``: the anchors by hash, numbered (``nth``) where one stands several times; ``side`` tells two texts apart."""
    own = [F.col(f"`{c}`") for c in rows.columns]
    by_hash = rows.select(*own, F.sort_array(anchors).alias("__s"))
    # Where a hash begins. What a lambda looks up is a column of the select before, or it would be made anew for each element.
    fresh = "filter(sequence(0, size(__s) - 1), i -> i = 0 OR get(__s, i).hash <> get(__s, i - 1).hash)"
    begun = by_hash.select(*own, "__s", F.expr(f"IF(size(__s) > 0, {fresh}, CAST(array() AS ARRAY<INT>))").alias("__b"))
    one = f"named_struct('hash', x.hash, 'nth', {{}}, 'side', {side}, 'pos', x.pos, 'words', x.words)"
    run = f"transform(slice(__s, b + 1, coalesce(get(__b, j + 1), size(__s)) - b), (x, i) -> {one.format('i')})"
    # In most texts no anchor stands twice.
    ranked = f"IF(size(__b) = size(__s), transform(__s, x -> {one.format('0')}), flatten(transform(__b, (b, j) -> {run})))"
    return begun.select(*own, F.expr(ranked).alias(into))


def with_matches(rows: DataFrame, a: str, b: str, into: str) -> DataFrame:
    """Add ``into``: array of ``pos, other, words`` of the anchors that two texts have in common, in the order of the first.

    ``a`` and ``b`` are made by ``with_ranked`` with the sides 0 and 1; the n-th place of a hash is matched with its n-th in the other text.
    """
    own = [F.col(f"`{c}`") for c in rows.columns]
    # Both are sorted, so the sort is one merge.
    merged = rows.select(*own, F.expr(f"sort_array(concat(`{a}`, `{b}`))").alias("__m"))
    same = "get(__m, i).hash = get(__m, i - 1).hash AND get(__m, i).nth = get(__m, i - 1).nth"
    pairs = f"filter(sequence(1, size(__m) - 1), i -> {same})"
    pairs = f"IF(size(__m) > 1, {pairs}, CAST(array() AS ARRAY<INT>))"
    met = f"transform({pairs}, i -> named_struct('pos', get(__m, i - 1).pos, 'other', get(__m, i).pos, 'words', get(__m, i).words))"
    return merged.select(*own, F.expr(f"sort_array({met})").alias(into))


def likeness(a: str, b: str, matches: str) -> Column:
    """Share of anchors that two texts have in common, each as often as it stands, 0 to 1; two texts without one are alike."""
    common = f"size(`{matches}`)"
    return F.expr(f"CASE WHEN size(`{a}`) + size(`{b}`) = 0 THEN 1.0D ELSE {common} / CAST(size(`{a}`) + size(`{b}`) - {common} AS DOUBLE) END")


def with_passages(rows: DataFrame, matches: str, into: str) -> DataFrame:
    """Add ``into``: array of ``pos, other, words``: shared passages, with their first words in both texts.

    A passage is a row of matched anchors that leave no word between them and moved by the same number of words.
    """
    own = [F.col(f"`{c}`") for c in rows.columns]
    now, last = f"get(`{matches}`, i)", f"get(`{matches}`, i - 1)"
    apart = f"{now}.pos - {last}.pos > {K} OR {now}.pos - {now}.other <> {last}.pos - {last}.other"
    starts = f"filter(sequence(0, size(`{matches}`) - 1), i -> i = 0 OR {apart})"
    begun = rows.select(*own, F.expr(f"IF(size(`{matches}`) > 0, {starts}, CAST(array() AS ARRAY<INT>))").alias("__b"))
    end = f"get(`{matches}`, coalesce(get(__b, j + 1), size(`{matches}`)) - 1)"
    first = f"get(`{matches}`, b)"
    one = f"named_struct('pos', {first}.pos, 'other', {first}.other, 'words', {end}.pos + {end}.words - {first}.pos)"
    return begun.select(*own, F.expr(f"transform(__b, (b, j) -> {one})").alias(into))


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, anchors, fingerprint`` of each whole text; equal texts have equal ones.

    Null and empty texts have no anchors and an empty fingerprint. Repeated rows
    and null keys keep their rows; other columns are not read. Very long texts are
    read whole; a row holds some 30 bytes for each word.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = with_anchors(rows, "text").select("key", "anchors", digest("anchors").alias("fingerprint"))
    return rows.withColumnRenamed("key", key)


def _in_ranges(rows: DataFrame, ranges: int) -> DataFrame:
    """Add ``range``: rows of neighbouring keys, about evenly many; null keys come first.

    Ranges of numbers are cut where their quantiles lie. Those of other keys are Spark's
    range partitions, fixed in a written table, so that a lost task does not draw them anew.
    """
    if not isinstance(rows.schema["key"].dataType, NumericType):
        return stage(rows.repartitionByRange(ranges, "key", "tie").withColumn("range", F.spark_partition_id()), "key-ranges")
    bounds = sorted(set(rows.approxQuantile("key", [i / ranges for i in range(1, ranges)], 0.2 / ranges)))
    if not bounds:
        return rows.withColumn("range", F.when(F.col("key").isNull(), -1).otherwise(0))
    cut = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="__k", outputCol="__r", handleInvalid="keep")
    placed = cut.transform(rows.withColumn("__k", F.expr("CAST(coalesce(key, 0) AS DOUBLE)")))
    return placed.withColumn("range", F.expr("CASE WHEN key IS NULL THEN -1 ELSE CAST(__r AS INT) END")).drop("__k", "__r")


def with_next(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """Add ``next_text`` of the row with the next ``key``; after the last comes the first.

    Rows are dealt out by ranges of keys. Each range also gets a copy of the first
    row of the range after it, so no range has to look into another. Rows with
    equal keys follow each other by the hash of their text.
    """
    ranges = ranges or 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = _in_ranges(rows.withColumn("tie", F.xxhash64("text")), ranges)
    firsts = placed.groupBy("range").agg(F.expr("min(struct(key, tie))").alias("first"))
    # At most one row for each range.
    around = Window.orderBy("range")
    before = F.coalesce(F.lag("range").over(around), F.last("range").over(around.rowsBetween(0, Window.unboundedFollowing)))
    firsts = firsts.select("range", "first", before.alias("before"))
    same = "p.range = f.range AND p.key <=> f.first.key AND p.tie = f.first.tie"
    heads = placed.alias("p").join(F.broadcast(firsts.alias("f")), F.expr(same)).select("p.*", "f.before")
    heads = heads.groupBy("before").agg(F.min(F.struct("key", "tie", "text")).alias("row"))
    guests = heads.select("row.key", "row.text", "row.tie", F.col("before").alias("range"), F.lit(1).alias("guest"))
    both = placed.select("key", "text", "tie", "range", F.lit(0).alias("guest")).union(guests)
    order = Window.partitionBy("range").orderBy("guest", "key", "tie")
    followed = both.select("*", F.lead("text").over(order).alias("next_text"))
    return followed.where("guest = 0").drop("guest", "range", "tie")


def edited(text: str, following: str, n: str) -> Column:
    """A text whose last half is replaced by the start of another."""
    half = f"CAST(floor({n} / 2) AS INT)"
    return F.expr(f"concat(substring({text}, 1, CAST({n} AS INT) - {half}), substring({following}, 1, {half}))")


def edit_study(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """How fingerprints follow an edit, for every document.

    ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, shared_edited, shared_next``; the last two are the passages that the
    text shares with the edited and with the next one. The edited text keeps the first
    part of the document; its last half (rounded down) is replaced by the start of the
    next document, or all of it if shorter. A null text counts as empty, a lone document
    is followed by itself, null keys come first; keys may be of any type that can be
    sorted. Repeated rows follow each other. Very long texts are compared whole. Columns
    other than ``key`` and ``text`` are not read. An empty table gives no rows.
    """
    rows = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(rows).withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("edited", edited("text", "next_text", "n_chars"))
    kept = ["key", "n_chars", F.sha2("edited", 256).alias("edited_sha256")]
    rows = with_anchors(rows.select(*kept, "text", "next_text", "edited"), "text", "own").drop("text")
    rows = with_anchors(rows, "edited", "changed").drop("edited")
    rows = with_anchors(rows, "next_text", "after").drop("next_text")
    rows = rows.withColumns({"fingerprint": digest("own"), "edited_fingerprint": digest("changed")})
    for name, side in (("own", 0), ("changed", 1), ("after", 1)):
        rows = with_ranked(rows, name, f"{name}_ranked", side).drop(name)
    for name, into in (("changed", "edited"), ("after", "next")):
        rows = with_matches(rows, "own_ranked", f"{name}_ranked", "matches")
        rows = rows.withColumn(f"near_{into}", likeness("own_ranked", f"{name}_ranked", "matches")).drop(f"{name}_ranked")
        rows = with_passages(rows, "matches", f"shared_{into}").drop("matches")
    columns = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "shared_edited", "shared_next"]
    return rows.select(F.col("key").alias(key), *columns)
