"""Near-duplicate documents: SimHash fingerprints joined by fuzzy keys of the binary Golay code.

A fingerprint's 64 bits are cut into segments of 23, 23 and 18 bits. With four or
fewer differing bits, the two segments that differ least differ in at most two
bits together. The Golay code (23, 12, 7) is perfect: any point lies within three
bits of a codeword, so for two points at most two bits apart, a codeword within
three bits of a point between them lies within four bits of both. The codewords
within four bits of a point (one, or six if the nearest is three bits away) are
therefore keys of which two such segments share at least one. A fingerprint gets
the products of the keys of two segments, for each of the three pairs. Those that
share a key are compared; no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField

from ..sinks.writers import stage
from .common import map_batches, quoted, unused
from .components import components

# Fixed value: generator polynomial of the Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = ((0, 1), (0, 2), (1, 2))
#: Differing bits up to which two fingerprints link; the keys are made for this number.
RADIUS = 4
#: Members of one key that are compared with each other; a key with more takes the way of ``_ball_keys``.
PAIRWISE = 4096
SHINGLES_AT_ONCE = 1 << 16


# --- fingerprints ---------------------------------------------------------------------------------------------------


def simhash(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of a text as a signed number; zero without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    ends -= 1
    if len(words) >= shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        part = slice(at, at + SHINGLES_AT_ONCE)
        hashes = b"".join([digest(line[i:j], 42) for i, j in zip(starts[part].tolist(), ends[part].tolist())])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``key, fp``: the SimHash of each whole text."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([simhash(t, shingle) for t in batch["text"]], dtype=np.int64)
            yield pd.DataFrame({"key": batch["key"], "fp": fps})

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInPandas(work, f"key {rows.schema['key'].dataType.simpleString()}, fp bigint")


# --- keys -----------------------------------------------------------------------------------------------------------


def _syndrome_table() -> list[np.ndarray]:
    """Remainders by the generator, for each byte of a 23-bit word."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GOLAY << (bit - 11)
        return word

    return [np.array([remainder(b << s & 0x7FFFFF) for b in range(256)], np.int64) for s in (0, 8, 16)]


def _syndromes(words: np.ndarray, table: list[np.ndarray]) -> np.ndarray:
    return table[0][words & 255] ^ table[1][words >> 8 & 255] ^ table[2][words >> 16 & 255]


def _error_table(table: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome: the error patterns of at most four bits (six columns), and how many there are."""
    one = 1 << np.arange(23, dtype=np.int64)
    two = (one[:, None] | one[None, :])[np.triu_indices(23, 1)]
    grow = lambda known: np.unique((known[:, None] | one[None, :])[(known[:, None] & one[None, :]) == 0])
    three = grow(two)
    patterns, counts = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for group in (np.zeros(1, np.int64), one, two, three, grow(three)):
        for pattern, syndrome in zip(group.tolist(), _syndromes(group, table).tolist()):
            if counts[syndrome] < 6:
                patterns[syndrome, counts[syndrome]] = pattern
                counts[syndrome] += 1
    return patterns, counts


class Golay:
    """Fuzzy keys of 23-bit words."""

    def __init__(self) -> None:
        self.table = _syndrome_table()
        self.patterns, self.counts = _error_table(self.table)

    def keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices (12 bits) of the codewords within four bits of each word, and how many of the six columns hold."""
        syndrome = _syndromes(words, self.table)
        return (words[:, None] ^ self.patterns[syndrome]) >> 11, self.counts[syndrome]


def fuzzy_keys(fps: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """Keys, and the place in ``fps`` that each belongs to."""
    bits = fps.view(np.uint64)
    segments = [code.keys((bits >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64)) for at, width in SEGMENTS]
    column, keys, rows = np.arange(6), [], []
    for number, (left, right) in enumerate(PAIRS):
        (a, n), (b, m) = segments[left], segments[right]
        holds = (column < n[:, None])[:, :, None] & (column < m[:, None])[:, None, :]
        key = number << 24 | a[:, :, None] << 12 | b[:, None, :]
        keys.append(key[holds])
        rows.append(np.nonzero(holds)[0])
    return np.concatenate(keys), np.concatenate(rows)


def _emit_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    code = Golay()
    for batch in batches:
        every = batch["fp"].to_numpy(np.int64)
        for at in range(0, len(every), 2000):
            fps = every[at : at + 2000]
            keys, rows = fuzzy_keys(fps, code)
            yield pd.DataFrame({"key": keys, "fp": fps[rows]})


def _ball_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All points within two bits of a fingerprint: those that share one are four bits apart at most, and all such do."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    masks = np.concatenate(([np.uint64(0)], one, (one[:, None] | one[None, :])[np.triu_indices(64, 1)]))
    for batch in batches:
        every = batch["fp"].to_numpy(np.int64)
        for at in range(0, len(every), 100):
            fps = every[at : at + 100]
            keys = (fps.view(np.uint64)[:, None] ^ masks[None, :]).view(np.int64)
            yield pd.DataFrame({"key": keys.ravel(), "fp": np.repeat(fps, len(masks))})


# --- links ----------------------------------------------------------------------------------------------------------


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with fewer links: each node of ``a, b`` tied to the smallest one it reaches here."""
    nodes, places = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root) and np.array_equal(root[left], root[right]):
            break
        root = new
    away = root != np.arange(len(nodes))
    return nodes[away], nodes[root[away]]


class _Links:
    """Links found in a task, kept as a forest."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.parts.append((a, b))
            self.n += len(a)
        if self.n > 1_000_000 and len(self.parts) > 1:
            self.parts = [forest(*map(np.concatenate, zip(*self.parts)))]
            self.n = len(self.parts[0][0])

    def take(self) -> pd.DataFrame:
        empty = np.zeros(0, np.int64)
        a, b = forest(*map(np.concatenate, zip(*self.parts))) if self.parts else (empty, empty)
        self.parts, self.n = [], 0
        return pd.DataFrame({"a": a, "b": b, "many": False})


def _compare(keys: np.ndarray, fps: np.ndarray, links: _Links) -> None:
    """Compare all rows with an equal key; the rows are sorted by key."""
    at, step = np.arange(len(keys)), 1
    while True:
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            return
        near = np.bitwise_count((fps[at] ^ fps[at + step]).view(np.uint64)) <= RADIUS
        links.add(fps[at[near]], fps[at[near] + step])
        step += 1


def _near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links between rows with one key, over rows sorted by key; members of keys with too many rows are passed on."""
    links, many = _Links(), None
    keys = fps = np.zeros(0, np.int64)
    for batch in batches:
        keys, fps = np.concatenate((keys, batch["key"].to_numpy(np.int64))), np.concatenate((fps, batch["fp"].to_numpy(np.int64)))
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(keys)))
        large = (sizes > PAIRWISE) | (keys[starts] == many if many is not None else False)
        rows = np.repeat(large, sizes)
        if rows.any():
            yield pd.DataFrame({"a": fps[rows], "b": fps[rows], "many": True})
        many = int(keys[-1]) if len(large) and large[-1] else None
        open_at = len(keys) if many is not None or not len(starts) else starts[-1]
        done = ~rows[:open_at]
        _compare(keys[:open_at][done], fps[:open_at][done], links)
        keys, fps = keys[open_at:], fps[open_at:]
        if links.n > 4_000_000:
            yield links.take()
    _compare(keys, fps, links)
    yield links.take()


def _chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tie each row to the one before it with the same key."""
    links, last = _Links(), (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for batch in batches:
        keys = np.concatenate((last[0], batch["key"].to_numpy(np.int64)))
        fps = np.concatenate((last[1], batch["fp"].to_numpy(np.int64)))
        same = keys[1:] == keys[:-1]
        links.add(fps[1:][same], fps[:-1][same])
        last = (keys[-1:], fps[-1:])
        if links.n > 4_000_000:
            yield links.take()
    yield links.take()


_KEYED, _LINKED = "key bigint, fp bigint", "a bigint, b bigint, many boolean"


def links(distinct: DataFrame) -> DataFrame:
    """``a, b``: links whose components are those of all pairs of ``fp`` that differ in at most ``RADIUS`` bits.

    ``distinct`` holds each fingerprint once. Rows with a key meet in one sorted
    partition, which is read as a stream: what is held is a batch and at most
    ``PAIRWISE`` rows of a key. Keys with more rows hand their members on, and
    these are linked exactly through the points within two bits of each: that
    costs 2,081 rows a fingerprint, however many share the key.
    """
    # Fingerprints are few bytes and their keys many: a file's worth of them would be too much for a task.
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = distinct.select("fp").repartition(tasks, "fp").mapInPandas(_emit_keys, _KEYED)
    met = keyed.repartition("key").sortWithinPartitions("key")
    found = stage(met.mapInPandas(_near, _LINKED), "near")
    crowded = found.where("many").select(F.col("a").alias("fp")).distinct()
    ball = crowded.repartition(tasks, "fp").mapInPandas(_ball_keys, _KEYED).repartition("key").sortWithinPartitions("key", "fp")
    near = ball.mapInPandas(_chain, _LINKED)
    return found.where("NOT many").union(near).select("a", "b")


def _rooted(documents: DataFrame, key: str, text: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """``key, fp`` of each row, and ``fp, least, root`` of each fingerprint: its smallest key and its group."""
    fps = stage(fingerprints(documents, key, text, shingle), "simhash")
    distinct = stage(fps.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
    roots = components(links(distinct))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return fps, stage(rooted, "roots")


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """``key, fp, component_id``: SimHash and group of each document; a group's id is its smallest key.

    Text is lower-cased in A-Z only and cut at white space (space, tab to carriage
    return); shingles are four words, repeats included, hashed by XXH64 with seed
    42. Fingerprints link at four or fewer differing bits, and links chain.

    Null and empty texts, and texts of white space, have fingerprint zero and link
    like any other. Equal texts and repeated rows share a fingerprint, which is
    compared once. A row with a null key keeps its row; a group of such rows alone
    has a null id. Other columns are not read. An empty table gives no rows.
    """
    fps, rooted = _rooted(documents, key, text, shingle)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return fps.join(of_fp, "fp").select(F.col("key").alias(key), "fp", "component_id")


def hex_of(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_first(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near copies: of each group the one with the smallest key stays, once; null keys stay.

    Groups are those of ``near_duplicates``. A key may stand at several texts: one text of
    each group stays. Null and empty texts, and texts of white space, are fingerprint zero
    and one group. Repeated rows stay once. Texts of any length are read whole, some
    megabytes at a time. An empty table gives no rows. Columns keep their names and values,
    whatever they are called.
    """
    fp = unused(documents, "fp")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([simhash(t) for t in batch.column(text).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, fps], names=[*batch.schema.names, fp])

    _, rooted = _rooted(documents.where(F.col(key).isNotNull()), key, text, 4)
    firsts = rooted.groupBy("root").agg(F.min(F.struct("least", "fp")).alias("first"))
    firsts = firsts.select(F.col("first.least").alias(key), F.col("first.fp").alias(fp))
    marked = map_batches(documents, mark, StructField(fp, LongType()))
    kept = marked.join(firsts, [key, fp], "left_semi").dropDuplicates([key, fp])
    return kept.select(quoted(documents.columns)).union(documents.where(F.col(key).isNull()))
