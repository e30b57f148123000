"""Benchmark passages in documents: SimHash over windows of an item's size, looked up by Hamming blocks, then verified.

An item of ``m`` words is looked for in every window of ``m`` words (the whole
document, if shorter). A window's fingerprint sums the bits of its shingles, each
as often as it stands there. Fingerprints are compared through blocks: with at
most ``RADIUS`` differing bits, one of four blocks differs in at most a quarter of
them, so items are taken from the blocks that close, and no fingerprint within
the radius is missed. Candidates are then verified by the weighted Jaccard
similarity of their shingles: common over all occurrences.

A window without any shingle of the benchmark has similarity zero with every item
and is not fingerprinted. That is a fact about the window, not a search: which
item a window is compared with is decided by fingerprints alone.

The items are broadcast in blocks of bounded size; documents are read once for
each block, are never shuffled, and no window leaves its task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches

SHINGLE, SIMILARITY = 5, 0.8
BLOCKS, BLOCK_BITS = 4, 16
#: Differing bits of 64; similarity 0.8 differs in ten on average.
RADIUS = 19
#: Bounds of a broadcast block of items.
ITEMS_AT_ONCE, CHARS_AT_ONCE = 20_000, 16_000_000
#: Characters of documents whose words a task holds at once (a longer document is held alone).
TEXT_AT_ONCE = 2_000_000
WORD = r"[^\W_]+"


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` word hashes."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(size, np.uint64)
    for j in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[j : j + size]
    return _mix(total)


def word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(w, 7) for w in words], dtype=np.uint64)


def window_fingerprints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of ``size`` shingles at ``starts``: a bit is set if over half of the shingles have it."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    over = 2 * (sums[starts + size] - sums[starts]) > size
    return np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard of two shingle counts."""
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common / max(sum(a.values()) + sum(b.values()) - common, 1)


def shingles(words: list[str], n: int) -> Counter:
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


@dataclass
class Sized:
    """Items of one number of words: their fingerprints, cut into blocks."""

    items: list[int] = field(default_factory=list)
    fps: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    blocks: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def close(self) -> None:
        for b in range(BLOCKS):
            self.blocks.append(np.unique(self.fps >> np.uint64(b * BLOCK_BITS) & np.uint64(0xFFFF), return_inverse=True))

    def within(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows and items at most ``RADIUS`` bits apart, with their distance; found by blocks."""
        candidate = np.zeros((len(windows), len(self.fps)), bool)
        for b, (values, place) in enumerate(self.blocks):
            own = windows >> np.uint64(b * BLOCK_BITS) & np.uint64(0xFFFF)
            close = np.bitwise_count(own[:, None] ^ values[None, :]) <= RADIUS // BLOCKS
            candidate |= close[:, place]
        w, i = np.nonzero(candidate)
        distance = np.bitwise_count(windows[w] ^ self.fps[i])
        near = distance <= RADIUS
        return w[near], i[near], distance[near]


class Index:
    """A block of items, for windows of documents."""

    def __init__(self, ids: list, texts: list[str]):
        import re

        find = re.compile(WORD).findall
        self.ids = ids
        shared: dict[str, str] = {}
        self.words = [[shared.setdefault(w, w) for w in find(t.lower())] for t in texts]
        self.vocabulary = {w: i for i, w in enumerate(sorted(shared))}
        names = list(self.vocabulary)
        self.hashes = word_hashes(names) if names else np.zeros(0, np.uint64)
        #: Shingle length (five, or the words of a shorter item) -> words of an item -> the items.
        self.sized: dict[int, dict[int, Sized]] = {}
        known: dict[int, list[np.ndarray]] = {}
        for number, words in enumerate(self.words):
            n = min(SHINGLE, len(words))
            if n:
                hashes = shingle_hashes(self.hashes[[self.vocabulary[w] for w in words]], n)
                known.setdefault(n, []).append(hashes)
                sized = self.sized.setdefault(n, {}).setdefault(len(words), Sized())
                sized.items.append(number)
                sized.fps = np.append(sized.fps, window_fingerprints(hashes, np.zeros(1, int), len(hashes)))
        for sizes in self.sized.values():
            for sized in sizes.values():
                sized.close()
        self.known = {n: np.unique(np.concatenate(h)) for n, h in known.items()}
        self.filters: dict[int, tuple[np.uint64, np.ndarray]] = {}  # made where they are used, not sent

    def hits(self, words: np.ndarray, n: int) -> np.ndarray:
        """Places of the shingles that some item has."""
        known = self.known[n]
        if n not in self.filters:
            shift = np.uint64(64 - max(16, (32 * len(known)).bit_length()))
            self.filters[n] = (shift, np.zeros(1 << (64 - int(shift)), bool))
            self.filters[n][1][known >> shift] = True
        shift, may_be = self.filters[n]
        hashes = shingle_hashes(words, n)
        places = np.flatnonzero(may_be[hashes >> shift])
        at = np.minimum(np.searchsorted(known, hashes[places]), len(known) - 1)
        return places[known[at] == hashes[places]]

    def matches(self, words: list[str], hits: np.ndarray, n: int) -> dict[int, tuple[float, int, int, int]]:
        """For each matching item the best window of a document: similarity, distance, first word, words."""
        best: dict[int, tuple[float, int, int, int]] = {}
        items: dict[int, Counter] = {}
        longest = max(self.sized[n])
        for group in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * longest) + 1):
            low = max(0, int(group[0]) - longest)
            part = words[low : int(group[-1]) + longest + n]
            hashes = shingle_hashes(word_hashes(part), n)
            for m, sized in self.sized[n].items():
                size = min(m - n + 1, len(hashes))
                starts = np.unique((group - low)[:, None] - np.arange(size)[None, :])
                starts = np.unique(np.clip(starts, 0, len(hashes) - size))
                w, i, distance = sized.within(window_fingerprints(hashes, starts, size))
                counted: dict[int, Counter] = {}
                for window, item, bits in zip(starts[w].tolist(), i.tolist(), distance.tolist()):
                    number = sized.items[item]
                    if window not in counted:
                        counted[window] = shingles(part[window : window + size + n - 1], n)
                    if number not in items:
                        items[number] = shingles(self.words[number], n)
                    found = similarity(counted[window], items[number])
                    if found >= SIMILARITY and (number not in best or found > best[number][0]):
                        best[number] = (found, bits, low + window, size + n - 1)
        return best


    def search(self, texts: list[str | None]) -> Iterator[tuple]:
        """``(place, item_id, similarity, distance, first_word, n_words, first_char, last_char, passage)`` of each match, by
        place in ``texts``.
        """
        part, size = [], 0
        for place, text in enumerate(texts):
            part.append((place, text or ""))
            size += len(part[-1][1])
            if size > TEXT_AT_ONCE:
                yield from self._search(part)
                part, size = [], 0
        if part:
            yield from self._search(part)

    def _search(self, part: list[tuple[int, str]]) -> list[tuple]:
        import re

        pattern, get, gap = re.compile(WORD), self.vocabulary.get, [-1] * SHINGLE
        hashes = np.append(self.hashes, np.uint64(1))  # the last one stands for words that no item has
        found, ids, starts = [], [], []
        for _, text in part:
            starts.append(len(ids))
            ids.extend([get(w, -1) for w in pattern.findall(text.lower())])
            ids.extend(gap)
        starts, line = np.array(starts), hashes[np.array(ids, np.int64)]
        for n in self.sized:
            places = self.hits(line, n)
            owner = np.searchsorted(starts, places, side="right") - 1
            for d in np.unique(owner):
                place, text = part[d]
                words, spans = pattern.findall(text.lower()), [m.span() for m in pattern.finditer(text)]
                best = self.matches(words, places[owner == d] - starts[d], n)
                for number, (alike, bits, first, count) in best.items():
                    # Lower case may change the number of words of rare scripts: then there are no places in the text.
                    span = (spans[first][0], spans[first + count - 1][1]) if len(spans) == len(words) else (None, None)
                    cut = text[span[0] : span[1]] if span[1] else " ".join(words[first : first + count])
                    found.append((place, self.ids[number], alike, bits, first, count, *span, cut))
        return sorted(found, key=lambda row: row[0])


def indexes(items: DataFrame, item_key: str = "item_id", item_text: str = "text") -> Iterator[Index]:
    """The items in blocks of bounded size, in a repeatable order."""
    items = items.select(F.col(item_key).alias("id"), F.col(item_text).alias("text")).where("trim(text) <> ''")
    count, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-count // ITEMS_AT_ONCE), -(-chars // CHARS_AT_ONCE)) if count else 0
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).orderBy("id", "text").collect()
        yield Index([row["id"] for row in part], [row["text"] for row in part])


def _scan(index: Index):
    columns = ["key", "item_id", "similarity", "distance", "first_word", "n_words", "first_char", "last_char", "passage"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["key"].tolist()
            rows = [(keys[place], *rest) for place, *rest in index.search(batch["text"].tolist())]
            frame = pd.DataFrame(rows, columns=columns)
            yield frame.astype({"key": object, "item_id": object, "first_char": "Int64", "last_char": "Int64"})

    return work


def leaks(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """A row for each document and benchmark item of which it holds a passage of similarity 0.8 or more.

    ``key, item_id, similarity, distance, first_word, n_words, first_char,
    last_char, passage``: the item's best window, the first of equal ones. Words are runs of letters and
    digits, in lower case; shingles are five words, of an item with fewer words
    all of them. Null and empty texts and items match nothing. Repeated rows and
    repeated items are reported each; null ids are kept. Other columns are not
    read. Empty tables give no rows.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind, item_kind = rows.schema["key"].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = (
        f"key {kind}, item_id {item_kind}, similarity double, distance int, first_word bigint, n_words bigint, "
        "first_char bigint, last_char bigint, passage string"
    )
    found = documents.sparkSession.createDataFrame([], schema)
    for index in indexes(items, item_key, item_text):
        found = found.union(rows.mapInPandas(_scan(index), schema))
    return found.withColumnRenamed("key", key)


def without_leaks(documents: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text") -> DataFrame:
    """The documents that hold no benchmark passage, with all their columns; rows are judged where they are read.

    Passages are those of ``leaks``: null and empty texts hold none and stay, as do all
    documents where there are no items; repeated rows go or stay together; texts of any
    length are read whole. An empty table gives no rows. Columns keep their names and values.
    """

    def clean(index: Index):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for place, *_ in index.search(batch.column(text).to_pylist()):
                    keep[place] = False
                yield batch.filter(pa.array(keep))

        return work

    for index in indexes(items, item_text, item_text):
        documents = map_batches(documents, clean(index))
    return documents
