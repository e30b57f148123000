"""Removal of repeated byte strings by suffix sorting with difference covers.

A string of ``LENGTH`` bytes that starts in two documents is found where the suffixes
that begin with it stand beside each other. Sorting every suffix of a corpus in one
order would shuffle each byte many times, so the suffixes are first brought together:

* Each window of ``LENGTH`` bytes has an anchor, the least hash of its inner runs of
  ``GRAM`` bytes. Equal windows have equal anchors, so windows whose anchor no other
  document has cannot repeat, and all others meet where their anchor is dealt to.
* What is dealt out is the stretch of text around an anchor, once for each different
  stretch of a portion of documents, with the smallest document that has it.
* An anchor so common that its stretches would be too many for a bucket is dealt out by
  whole windows instead, which come together again only where they are equal.
* There the stretches are sorted by the difference-cover algorithm modulo three: triples
  at two of three places are named, the names are sorted the same way until they span
  ``LENGTH`` bytes, and the suffixes left over are merged in. Neighbours in the order
  whose first ``LENGTH`` bytes agree are one string; its smallest document keeps it.

The answers go back to the portions, which cut their documents. Nothing is sampled, and
a task holds one portion or one bucket: a common string is one entry for each portion.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..sinks.writers import stage

#: Fixed value of the contract: bytes of a string that may not repeat.
LENGTH = 50
#: Bytes of an anchor; every window of LENGTH bytes holds REACH of them.
GRAM = 24
REACH = LENGTH - GRAM + 1
#: Bytes of text of a portion (and of the longest document more), and of a bucket.
PORTION_BYTES, BUCKET_BYTES = 4 << 20, 2 << 20
WINDOWS_AT_ONCE, ROWS_AT_ONCE = 1 << 18, 1 << 13
#: Portions that share an anchor, or records of one in a portion, from which its windows are dealt out one by one.
COMMON_PORTIONS, COMMON_RECORDS = 1024, 256
_STRETCH = REACH + LENGTH - 1
_RECORD = 8 + 2 + _STRETCH
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_PLACE = np.uint64((1 << 24) - 1)


# --- suffix order by difference covers ------------------------------------------------------------------------------


def _merged_keys(first: np.ndarray, second: np.ndarray, rank: np.ndarray, n: int) -> np.ndarray:
    """One number for (first, second, rank), in the same order."""
    pair = first * (int(second.max(initial=0)) + 1) + second
    if int(pair.max(initial=0)) * (n + 4) >= 1 << 62:
        pair = np.unique(pair, return_inverse=True)[1]
    return pair * (n + 4) + rank


def suffix_order(s: np.ndarray, need: int, span: int = 3) -> np.ndarray:
    """Starts of the suffixes of ``s`` (whole numbers above zero), sorted by their first ``need`` symbols at least.

    Names of triples span ``span`` symbols of the text; once that covers ``need``, equal names need no further order.
    """
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate((s, np.zeros(3, np.int64)))
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    at = np.concatenate((ones, twos))
    top = int(t.max()) + 1
    if top**3 < 1 << 63:
        code = (t[at] * top + t[at + 1]) * top + t[at + 2]
        order = np.argsort(code, kind="stable")
        fresh = code[order][1:] != code[order][:-1]
    else:
        order = np.lexsort((t[at + 2], t[at + 1], t[at]))
        o = at[order]
        fresh = np.zeros(len(o) - 1, bool)
        for k in range(3):
            fresh |= t[o[1:] + k] != t[o[:-1] + k]
    names = np.empty(len(at), np.int64)
    names[order] = np.concatenate(([1], 1 + np.cumsum(fresh)))
    if span < need and not fresh.all():
        order = suffix_order(names, need, span * 3)
    sample = at[order]
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = np.arange(1, len(sample) + 1)
    # The suffixes left over: by symbol, then by the rank of the sampled suffix behind it.
    rest = sample[sample % 3 == 1] - 1
    rest = rest[np.argsort(t[rest], kind="stable")]
    sample = sample[sample < n]
    one, two = sample[sample % 3 == 1], sample[sample % 3 == 2]
    before = np.searchsorted(t[one] * (n + 4) + rank[one + 1], t[rest] * (n + 4) + rank[rest + 1])
    both = np.concatenate((two, rest))
    keys = _merged_keys(t[both], t[both + 1], rank[both + 2], n)
    before += np.searchsorted(keys[: len(two)], keys[len(two) :])
    before = np.maximum.accumulate(before)
    out = np.empty(n, np.int64)
    places = before + np.arange(len(rest))
    out[places] = rest
    free = np.ones(n, bool)
    free[places] = False
    out[free] = sample
    return out


def _words(s: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    padded = np.concatenate((s, np.zeros(8, np.uint8)))
    return np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(s), 8), (1, 1)).copy().view(np.uint64).ravel()


def equal_windows(stretches: list[bytes] | np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of equal bytes among rows of padded stretches, ``widths`` windows in each: row, place and class of each window."""
    rows, columns = np.nonzero(np.arange(_STRETCH)[None, :] < (widths + LENGTH - 1)[:, None])
    ends = np.cumsum(widths + LENGTH)
    starts = ends - widths - LENGTH
    text = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    s = np.ones(len(text), np.int64)  # one stands between stretches
    text[starts[rows] + columns] = stretches[rows, columns]
    s[starts[rows] + columns] = text[starts[rows] + columns].astype(np.int64) + 2
    order = suffix_order(s, LENGTH)
    row = np.searchsorted(starts, order, side="right") - 1
    place = order - starts[row]
    holds = place < widths[row]
    order, row, place = order[holds], row[holds], place[holds]
    words = _words(text)
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        part = words[order + k]
        same &= part[1:] == part[:-1]
    return row, place, np.concatenate((np.zeros(min(1, len(order)), np.int64), np.cumsum(~same)))


# --- portions of documents ------------------------------------------------------------------------------------------


def portions(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``c, n_bytes, keys, lens, body``: documents as they are read, some megabytes a row. The result is a written table."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=3).compress
        task, number, keys, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def row() -> pd.DataFrame:
            lens, body = [len(t) for t in texts], pack(b"".join(texts))
            return pd.DataFrame({"c": [task << 32 | number], "n_bytes": [size], "keys": [keys], "lens": [lens], "body": [body]})

        for batch in batches:
            for k, t in zip(batch["key"], batch["text"]):
                keys.append(int(k) if k is not None else None)
                texts.append(t or b"")
                size += len(texts[-1])
                if size >= PORTION_BYTES or len(texts) >= 1 << 16:
                    yield row()
                    number, keys, texts, size = number + 1, [], [], 0
        if texts:
            yield row()

    # As text: pandas would hold nullable whole numbers as doubles.
    rows = documents.select(F.col(f"`{key}`").cast("bigint").cast("string").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    return stage(rows.mapInPandas(work, "c bigint, n_bytes bigint, keys array<bigint>, lens array<bigint>, body binary"), "portions")


class Portion:
    """A portion's documents, and the records of its windows: each is a run of windows with one anchor."""

    def __init__(self, keys, lens, body: bytes):
        import zstandard

        keys = list(keys)
        self.body = np.frombuffer(zstandard.ZstdDecompressor().decompress(body) if len(body) else b"", np.uint8)
        self.lens = np.array(lens, np.int64)
        self.known = np.array([k is not None and k == k for k in keys], bool)
        self.keys = np.array([int(k) if known else 0 for k, known in zip(keys, self.known)], np.int64)
        self.names = [int(k) if known else None for k, known in zip(keys, self.known)]
        self.ends = np.cumsum(self.lens)
        self.starts = self.ends - self.lens
        self._find()

    def _find(self) -> None:
        n = len(self.body)
        usable = self.known & (self.lens >= LENGTH)
        step = np.zeros(n + 1, np.int32)
        np.add.at(step, self.starts[usable], 1)
        np.add.at(step, self.ends[usable] - LENGTH + 1, -1)
        valid = np.cumsum(step[:n]) > 0
        anchors, starts, widths = [], [], []
        for at in range(0, max(n - LENGTH + 1, 0), WINDOWS_AT_ONCE):
            many = min(WINDOWS_AT_ONCE, n - LENGTH + 1 - at)
            a, s, w = self._slice(self.body[at : at + many + LENGTH - 1], valid[at : at + many])
            anchors.append(a), starts.append(s + at), widths.append(w)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.anchor, self.start, self.width = join(anchors, np.uint64), join(starts, np.int64), join(widths, np.int64)
        self.doc = np.searchsorted(self.starts, self.start, side="right") - 1
        # Empty documents start where the next one does; records lie in the one that has bytes.
        self.key = self.keys[self.doc]

    @staticmethod
    def _slice(s: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not valid.any():
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            w = _words(s)
            n = len(s) - GRAM + 1
            h = w[:n] * _A
            h ^= h >> np.uint64(32)
            h += w[8 : n + 8]
            h *= _B
            h ^= h >> np.uint64(29)
            h += w[16 : n + 16]
            h *= _C
            h ^= h >> np.uint64(32)
            h *= _A
            h ^= h >> np.uint64(31)
        m = (h & ~_PLACE) | np.arange(n, dtype=np.uint64)
        reach = 1
        while 2 * reach <= REACH:
            m = np.minimum(m[:-reach], m[reach:])
            reach *= 2
        if reach < REACH:
            m = np.minimum(m[: reach - REACH], m[REACH - reach :])
        place = (m & _PLACE).astype(np.int64)
        turn = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(valid & np.concatenate(([True], turn)))
        last = np.flatnonzero(valid & np.concatenate((turn, [True])))
        with np.errstate(over="ignore"):
            anchor = h[place[first]] * _B  # least hashes are small: scattered anew, so that all buckets get as many
            anchor ^= anchor >> np.uint64(32)
            anchor *= _C
            anchor ^= anchor >> np.uint64(29)
        return anchor, first, last - first + 1

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchors, sorted; which of them two documents here have, which are common here; and the anchor's number of each record."""
        anchors, number, count = np.unique(self.anchor, return_inverse=True, return_counts=True)
        least, most = np.full(len(anchors), np.iinfo(np.int64).max), np.full(len(anchors), np.iinfo(np.int64).min)
        np.minimum.at(least, number, self.key)
        np.maximum.at(most, number, self.key)
        return anchors, least != most, count >= COMMON_RECORDS, number

    def _stretches(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different stretches of the chosen records, their smallest documents, and the number of each record's."""
        start, width = self.start[chosen], self.width[chosen]
        rows = np.zeros((len(chosen), _RECORD), np.uint8)
        rows[:, :8] = self.anchor[chosen].astype(">u8").view(np.uint8).reshape(-1, 8)
        rows[:, 8] = width
        column = np.arange(_STRETCH)
        for at in range(0, len(chosen), 1 << 16):
            part = slice(at, at + (1 << 16))
            inside = column[None, :] < (width[part] + LENGTH - 1)[:, None]
            places = np.minimum(start[part][:, None] + column[None, :], len(self.body) - 1)
            rows[part, 10:] = np.where(inside, self.body[places], 0)
        return _distinct_rows(rows, self.key[chosen])

    def entries(self, chosen: np.ndarray, common: np.ndarray) -> Entries:
        """What is dealt out of the chosen records: their stretches, or the windows of those whose anchor is ``common``."""
        rows, least, number = self._stretches(chosen)
        split = np.zeros(len(rows), bool)
        split[number] = common
        plain = np.flatnonzero(~split)
        entry, bit = np.zeros((len(rows), REACH), np.int64), np.zeros((len(rows), REACH), np.uint32)
        entry[plain] = np.arange(len(plain))[:, None]
        bit[plain] = np.arange(REACH, dtype=np.uint32)
        sent, smallest = rows[plain], least[plain]
        many = np.flatnonzero(split)
        if len(many):
            row, place = np.nonzero(np.arange(REACH)[None, :] < rows[many, 8].astype(np.int64)[:, None])
            windows = np.zeros((len(row), _RECORD), np.uint8)
            for at in range(0, len(row), 1 << 16):
                part = slice(at, at + (1 << 16))
                windows[part, 10 : 10 + LENGTH] = rows[many[row[part]][:, None], 10 + place[part][:, None] + np.arange(LENGTH)[None, :]]
            windows[:, 8] = 1
            windows[:, :8] = _window_hash(windows[:, 10 : 10 + LENGTH]).astype(">u8").view(np.uint8).reshape(-1, 8)
            windows, low, which = _distinct_rows(windows, least[many[row]])
            entry[many[row], place] = len(plain) + which
            sent, smallest = np.concatenate((sent, windows)), np.concatenate((smallest, low))
        order = np.argsort(_anchors_of(sent), kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return Entries(sent[order], smallest[order], number, back[entry] if len(order) else entry, bit)


class Entries(NamedTuple):
    """Rows dealt out, sorted by bucket; their smallest documents; each record's stretch; entry and bit of a stretch's windows."""

    rows: np.ndarray
    least: np.ndarray
    number: np.ndarray
    entry: np.ndarray
    bit: np.ndarray


def _window_hash(windows: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(windows), -(-LENGTH // 8) * 8), np.uint8)
    padded[:, :LENGTH] = windows
    h = np.zeros(len(windows), np.uint64)
    with np.errstate(over="ignore"):
        for column in padded.view(np.uint64).T:
            h = (h ^ column) * _B
            h ^= h >> np.uint64(29)
        h *= _C
    return h ^ h >> np.uint64(32)


def _distinct_rows(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(rows):
        return rows, keys, np.zeros(0, np.int64)
    found, number = np.unique(np.ascontiguousarray(rows).view(f"V{_RECORD}").ravel(), return_inverse=True)
    least = np.full(len(found), np.iinfo(np.int64).max)
    np.minimum.at(least, number, keys)
    return found.view(np.uint8).reshape(-1, _RECORD), least, number


def _dealt(anchors: np.ndarray, buckets: int) -> np.ndarray:
    """Ends of the buckets in sorted anchors."""
    bucket = ((anchors >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets, dtype=np.uint64), side="right")


def _anchors_of(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows[:, :8]).view(">u8").ravel().astype(np.uint64)


# --- exchange -------------------------------------------------------------------------------------------------------

_SENT = "bucket bigint, c bigint, n bigint, body binary, more binary"
_ANSWER = "c bigint, kind int, bucket bigint, n bigint, bits binary"


def _bits(a: np.ndarray, b: np.ndarray) -> bytes:
    return np.packbits(np.concatenate((a, b))).tobytes()


def _unbits(bits: bytes, n: int) -> np.ndarray:
    """Both of the flags, a row for each."""
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=2 * n).astype(bool).reshape(2, n)


def _send_anchors(buckets: int):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                anchors, many, common, _ = Portion(row.keys, row.lens, row.body).distinct()
                low, out, at = anchors.astype(np.uint32), [], 0
                for bucket, end in enumerate(_dealt(anchors, buckets).tolist()):
                    if end > at:
                        out.append((bucket, row.c, end - at, low[at:end].tobytes(), _bits(many[at:end], common[at:end])))
                    at = end
                yield pd.DataFrame(out, columns=["bucket", "c", "n", "body", "more"])

    return work


def _meet_anchors(key: tuple, sent: pd.DataFrame) -> pd.DataFrame:
    """Which anchors of each portion another document has. Two that agree in 32 bits of the bucket count as one: that adds work, not results."""
    low = np.concatenate([np.frombuffer(b, np.uint32) for b in sent["body"]])
    many, common = np.concatenate([_unbits(m, n) for m, n in zip(sent["more"], sent["n"])], axis=1)
    found, number, count = np.unique(low, return_inverse=True, return_counts=True)
    again = count > 1
    again[number[many]] = True
    split = count >= COMMON_PORTIONS
    split[number[common]] = True
    again, split, ends = again[number], split[number], np.cumsum(sent["n"].to_numpy())
    bits = [_bits(again[e - n : e], split[e - n : e]) for e, n in zip(ends, sent["n"])]
    return pd.DataFrame({"c": sent["c"].to_numpy(), "kind": 0, "bucket": key[0], "n": sent["n"].to_numpy(), "bits": bits})


def _flags(answers: pd.DataFrame) -> np.ndarray:
    """Answers of all buckets, put together in their order."""
    parts = answers.sort_values("bucket")
    return np.concatenate([np.zeros((2, 0), bool), *[_unbits(b, n) for b, n in zip(parts["bits"], parts["n"])]], axis=1)


def _chosen(row, answers: pd.DataFrame) -> tuple[Portion, np.ndarray, Entries]:
    """A portion, its records whose anchor repeats, and what is dealt out of them."""
    portion = Portion(row.keys, row.lens, row.body)
    number = portion.distinct()[3]
    again, common = _flags(answers[answers["kind"] == 0])
    chosen = np.flatnonzero(again[number])
    return portion, chosen, portion.entries(chosen, common[number[chosen]])


def _send_stretches(buckets: int):
    def work(portion: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        pack, out = zstandard.ZstdCompressor(level=3).compress, []
        for row in portion.itertuples():
            rows, least, *_ = _chosen(row, answers)[2]
            at = 0
            for bucket, end in enumerate(_dealt(_anchors_of(rows), buckets).tolist()):
                if end > at:
                    out.append((bucket, row.c, end - at, pack(rows[at:end].tobytes()), pack(least[at:end].tobytes())))
                at = end
        return pd.DataFrame(out, columns=["bucket", "c", "n", "body", "more"])

    return work


def _blocks(anchors: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of sorted rows that are sorted one after the other; rows with one anchor stay together."""
    at = 0
    while at < len(anchors):
        end = int(np.searchsorted(anchors, anchors[min(at + ROWS_AT_ONCE, len(anchors)) - 1], side="right"))
        yield at, end
        at = end


def _meet_stretches(key: tuple, sent: pd.DataFrame) -> pd.DataFrame:
    """For each stretch sent, its windows that start in a smaller document than the portion's smallest."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    rows = np.concatenate([np.frombuffer(unpack(b), np.uint8).reshape(-1, _RECORD) for b in sent["body"]])
    least = np.concatenate([np.frombuffer(unpack(b), np.int64) for b in sent["more"]])
    found, first, number = _distinct_rows(rows, least)
    # A stretch that is its anchor's only one has its windows to itself; where there are several, they are sorted.
    by_window = np.repeat(first[:, None], REACH, axis=1)
    anchors = _anchors_of(found)
    near = anchors[1:] == anchors[:-1]
    several = np.flatnonzero(np.concatenate((near, [False])) | np.concatenate(([False], near)))
    for at, end in _blocks(anchors[several]):
        part = several[at:end]
        row, place, kind = equal_windows(found[part, 10:], found[part, 8].astype(np.int64))
        smallest = np.full(int(kind.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(smallest, kind, first[part[row]])
        by_window[part[row], place] = smallest[kind]
    weights = np.int64(1) << np.arange(REACH, dtype=np.int64)
    masks = np.concatenate(
        [((by_window[number[at : at + 65536]] < least[at : at + 65536, None]) * weights).sum(axis=1) for at in range(0, len(number), 65536)]
    ).astype(np.uint32)
    ends, pack = np.cumsum(sent["n"].to_numpy()), zstandard.ZstdCompressor(level=3).compress
    bits = [pack(masks[e - n : e].tobytes()) for e, n in zip(ends, sent["n"])]
    return pd.DataFrame({"c": sent["c"].to_numpy(), "kind": 1, "bucket": key[0], "n": sent["n"].to_numpy(), "bits": bits})


def _cut(portion: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """What is left of each document of a portion."""
    import zstandard

    unpack, out = zstandard.ZstdDecompressor().decompress, []
    for row in portion.itertuples():
        p, chosen, (_, least, number, entry, bit) = _chosen(row, answers)
        parts = answers[answers["kind"] == 1].sort_values("bucket")["bits"]
        masks = np.concatenate([np.zeros(0, np.uint32), *[np.frombuffer(unpack(b), np.uint32) for b in parts]])
        start, width, key = p.start[chosen], p.width[chosen], p.key[chosen]
        hits = [np.zeros(0, np.int64)]
        for k in range(REACH if len(chosen) else 0):
            at = entry[number, k]
            # Behind the smallest document here a window repeats; of that one, if the answer says so.
            repeats = (key > least[at]) | ((masks[at] >> bit[number, k]) & np.uint32(1) > 0)
            hits.append(start[repeats & (k < width)] + k)
        hit, n = np.concatenate(hits), len(p.body) + 1
        step = np.bincount(hit, minlength=n) - np.bincount(hit + LENGTH, minlength=n)
        gone = np.cumsum(step[:-1]) > 0
        total = np.concatenate(([0], np.cumsum(gone)))
        for name, a, b in zip(p.names, p.starts.tolist(), p.ends.tolist()):
            removed = int(total[b] - total[a])
            inside = gone[a:b]
            spans = int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum()) if removed else 0
            kept = p.body[a:b][~inside] if removed else p.body[a:b]
            out.append((str(name) if name is not None else None, b - a, removed, spans, hashlib.sha256(kept.tobytes()).hexdigest()))
    return pd.DataFrame(out, columns=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def cut_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` of each document without the strings of ``LENGTH`` bytes that a smaller key has.

    Texts are UTF-8 bytes; null and empty texts have none. Keys are whole numbers. Rows
    with one key are one document's: they remove nothing from each other, and of equal
    texts all rows but those with the smallest key lose everything. A row with a null key
    is kept whole and removes nothing. Long texts are handled in slices; a task holds the
    portion that a text lies in. An empty table gives no rows. Other columns are not read.
    """
    parts = portions(documents, key, text)
    size = parts.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    sent = parts.mapInPandas(_send_anchors(buckets), _SENT)
    again = stage(sent.groupBy("bucket").applyInPandas(_meet_anchors, _ANSWER), "anchors")
    sent = parts.groupBy("c").cogroup(again.groupBy("c")).applyInPandas(_send_stretches(buckets), _SENT)
    found = stage(sent.groupBy("bucket").applyInPandas(_meet_stretches, _ANSWER), "stretches")
    out = "key string, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    cut = parts.groupBy("c").cogroup(again.union(found).groupBy("c")).applyInPandas(_cut, out)
    return cut.withColumn("key", F.col("key").cast("bigint")).withColumnRenamed("key", key)
