"""Training sequences by bounded-space online packing.

Each task keeps a fixed number of open windows. A document's ids first fill whole
windows; the rest goes to the open window that it fits best. If it fits none and
no more windows may be opened, the fullest is topped up with the start of the rest
and goes out full. At the end of a task the open windows are poured together, so
that one window at most is left over; the left-over windows of all tasks are
packed again in ever fewer tasks, the last of which cuts its remainder into
sequences of a power of two. No sequence needs padding, and what a task holds does
not depend on its input.
"""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sinks.writers import stage
from .common import once_per_worker

WINDOW, OPEN = 2048, 64
END = 1
#: Left-over windows that one task packs again.
FAN_IN = 256

# Fixed value: the split of the byte-level pre-tokenizer.
BYTE_LEVEL_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def public_vocabulary() -> str:
    """Path of the public byte-level vocabulary, as each machine finds it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Byte strings and ids of a byte-level BPE file whose ids follow its merges; None for any other file."""
    split = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or spec.get("normalizer") or any(before.get(k) != v for k, v in split.items()):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    vocabulary = model["vocab"]
    merged = ["".join(m if isinstance(m, list) else m.split(" ", 1)) for m in model["merges"]]
    first = len(vocabulary) - len(merged)
    if any(vocabulary.get(token) != first + i for i, token in enumerate(merged)):
        return None
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Ids of a text by a tokenizer file, as the ``tokenizers`` library gives them without special tokens added.

    A plain byte-level BPE file runs through the faster rank encoder, which gives
    the same ids; texts that spell out an added token go through the library itself.
    """
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    by_library = lambda text: np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4")
    ranks = _ranks(spec)
    if ranks is None:
        return by_library
    import tiktoken

    fast = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})
    added = [token["content"] for token in spec.get("added_tokens", [])]

    def encode(text: str) -> np.ndarray:
        if any(token in text for token in added):
            return by_library(text)
        return np.array(fast.encode_ordinary(text), dtype="<u4")

    return encode


class Packer:
    """The open windows of one task; a piece is ``(key, start, ids, doc_tokens)``."""

    def __init__(self, window: int, most: int, first_sequence: int):
        self.window, self.most, self.next = window, most, first_sequence
        self.open: list[tuple[int, int]] = []  # gap and number of each open window, in order
        self.pieces: dict[int, list[tuple]] = {}
        self.count = 0
        self.out: list[tuple] = []
        self.held = 0

    def emit(self, pieces: list[tuple], left_over: bool = False) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            self.out.append((key, start, ids.tobytes(), total, self.next, offset, left_over))
            offset += len(ids)
        self.held += offset
        self.next += 1

    def add(self, key, start: int, ids: np.ndarray, total: int) -> None:
        """Place the ids of a document from ``start`` on."""
        whole = len(ids) // self.window * self.window
        for at in range(0, whole, self.window):
            self.emit([(key, start + at, ids[at : at + self.window], total)])
        start, ids = start + whole, ids[whole:]
        while len(ids):
            best = bisect_left(self.open, (len(ids), -1))
            if best < len(self.open):
                gap, number = self.open.pop(best)
            elif len(self.open) < self.most:
                gap, number = self.window, self.count
                self.count += 1
                self.pieces[number] = []
            else:
                gap, number = self.open.pop(0)
            taken, ids = ids[:gap], ids[gap:]
            self.pieces[number].append((key, start, taken, total))
            start += len(taken)
            if gap == len(taken):
                self.emit(self.pieces.pop(number))
            else:
                insort(self.open, (gap - len(taken), number))

    def close(self, last: bool) -> None:
        """Pour the open windows together, the emptiest into the fullest; ``last`` cuts what is left by powers of two."""
        windows = [self.pieces.pop(number) for _, number in self.open]
        gaps = [gap for gap, _ in self.open]
        self.open = []
        while len(windows) > 1:
            gap, target, source = gaps[0], windows[0], windows[-1]
            key, start, ids, total = source.pop()
            cut = len(ids) - min(gap, len(ids))
            target.append((key, start + cut, ids[cut:], total))
            if cut:
                source.append((key, start, ids[:cut], total))
            gaps[0] -= len(ids) - cut
            gaps[-1] += len(ids) - cut
            if not gaps[0]:
                self.emit(target)
                windows.pop(0), gaps.pop(0)
            if windows and not windows[-1]:
                windows.pop(), gaps.pop()
        if windows and not last:
            self.emit(windows[0], left_over=True)
        elif windows:
            for piece in self._by_powers(windows[0]):
                self.emit(piece)

    def _by_powers(self, pieces: list[tuple]) -> Iterator[list[tuple]]:
        left = sum(len(p[2]) for p in pieces)
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            sequence = []
            while room:
                key, start, ids, total = pieces.pop(0)
                sequence.append((key, start, ids[:room], total))
                if len(ids) > room:
                    pieces.insert(0, (key, start + room, ids[room:], total))
                room -= len(sequence[-1][2])
            yield sequence

    def take(self) -> pd.DataFrame:
        rows, self.out, self.held = self.out, [], 0
        frame = pd.DataFrame(rows, columns=["key", "start", "ids", "doc_tokens", "sequence_id", "offset", "left_over"])
        return frame.astype({"key": object})


def _first_sequence(level: int) -> int:
    """Sequence numbers that no other task of any round uses."""
    return level << 58 | TaskContext.get().partitionId() << 33


def _output(kind: str) -> str:
    return f"key {kind}, start bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, left_over boolean"


def _tokenize_and_pack(tokenizer: str | None, window: int, most: int, end: int):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path = tokenizer or public_vocabulary()
        encode = once_per_worker(f"encoder {path}", lambda: encoder(path))
        tail, packer = np.array([end], dtype="<u4"), Packer(window, most, _first_sequence(0))
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"]):
                ids = np.concatenate((encode(text), tail)) if text else tail
                packer.add(key, 0, ids, len(ids))
                if packer.held > 1_000_000:
                    yield packer.take()
        packer.close(last=False)
        yield packer.take()

    return work


def _pack_again(window: int, most: int, level: int, last: bool):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = Packer(window, most, _first_sequence(level))
        for batch in batches:
            for key, start, ids, total in zip(batch["key"], batch["start"], batch["ids"], batch["doc_tokens"]):
                packer.add(key, start, np.frombuffer(ids, "<u4"), total)
            yield packer.take()
        packer.close(last)
        yield packer.take()

    return work


def pack(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    window: int = WINDOW,
    open_windows: int = OPEN,
    end: int = END,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` ids.

    ``key, start, length, ids, doc_tokens, sequence_id, offset``: ``ids`` are
    little-endian unsigned 32-bit numbers, ``start`` counts the document's ids
    before the piece, ``offset`` those before it in its sequence. ``tokenizer`` is
    the path of a tokenizer file on each machine. A document is its ids and then
    ``end``; a null or empty text is ``end`` alone. Every id is in one piece.
    Sequences are full, but for the last few, whose lengths are powers of two.
    Repeated rows and null keys are documents of their own; other columns are not
    read. An empty table gives no rows.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = _output(rows.schema["key"].dataType.simpleString())
    packed = stage(rows.mapInPandas(_tokenize_and_pack(tokenizer, window, open_windows, end), kind), "packed")
    done, level = packed.where("NOT left_over"), 0
    while True:
        level += 1
        left = packed.where("left_over")
        tasks = -(-left.agg(F.count_distinct("sequence_id")).first()[0] // FAN_IN)
        # Whole windows meet in a task; the table itself is read by many.
        met = left.repartitionByRange(tasks, "sequence_id") if tasks > 1 else left.repartition(1)
        met = met.sortWithinPartitions("sequence_id", "offset").select("key", "start", "ids", "doc_tokens")
        packed = stage(met.mapInPandas(_pack_again(window, open_windows, level, tasks <= 1), kind), "packed")
        done = done.union(packed.where("NOT left_over"))
        if tasks <= 1:
            break
    return done.select(
        F.col("key").alias(key), "start", F.expr("CAST(octet_length(ids) / 4 AS BIGINT)").alias("length"), "ids",
        "doc_tokens", "sequence_id", "offset",
    )
