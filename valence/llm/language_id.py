"""Language identification by error-correcting output codes.

Each language has a codeword. For each bit a binary n-gram classifier tells the
languages with a 1 from those with a 0; its weights are the logarithms of the two
sides' n-gram frequencies. A text's margins are decoded to the codeword with the
smallest weighted loss; a bit weighs as much as it separates its sides. If the
second codeword is nearly as close, the answer is flagged as ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches

#: Hash buckets of the two- and three-byte n-grams of a text, each.
BUCKETS = 4096
MAX_LANGUAGES = 256
BITS_OF_RANDOM_CODE = 63
AMBIGUOUS = 0.1
#: How fast the score falls as another codeword comes near.
SHARPNESS = 8.0
UNDETERMINED = "und"
AT_ONCE = 1 << 20
#: Texts whose n-gram counts are held at once.
AT_A_TIME = 500

# ASCII letters and the bytes of other scripts stand for themselves, all else for a space.
_BYTES = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], dtype=np.uint32)


def ngrams(text: str) -> np.ndarray:
    """Counts of a whole text's n-gram buckets."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(2 * BUCKETS, np.int64)
    for at in range(0, len(raw), AT_ONCE):
        b = _BYTES[raw[at : at + AT_ONCE + 2]]
        two = b[:-1] << np.uint32(8) | b[1:]
        three = two[:-1] << np.uint32(8) | b[2:]
        if at + AT_ONCE + 2 <= len(raw):  # the last two-byte n-gram is the first of the next part
            two = two[:-1]
        for place, grams in ((0, two), (BUCKETS, three)):
            bucket = grams * np.uint32(2654435761) >> np.uint32(20)
            counts[place : place + BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
    return counts


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages: all splits for up to six, else the best of many random codes."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 6:
        sides = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1)]
        return np.array([s for s in sides if -1 in s], dtype=float).T
    draw, best, found = np.random.default_rng(42), None, -1
    for _ in range(200):
        code = draw.choice((-1.0, 1.0), (n, BITS_OF_RANDOM_CODE))
        if (np.abs(code.sum(axis=0)) == n).any():
            continue
        gap = (BITS_OF_RANDOM_CODE - (code @ code.T - np.eye(n) * 3 * BITS_OF_RANDOM_CODE).max()) / 2
        if gap > found:
            best, found = code, gap
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    middle: np.ndarray
    scale: np.ndarray
    importance: np.ndarray

    def losses(self, counts: np.ndarray) -> np.ndarray:
        """Loss of each language's codeword for each row of n-gram counts."""
        share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        margin = (share @ self.weights - self.middle) / self.scale
        return np.logaddexp(0.0, -2.0 * margin[:, None, :] * self.code[None, :, :]) @ self.importance

    def judge(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, second language and whether the answer is ambiguous, of each text."""
        import regex

        letter = regex.compile(r"\p{L}")
        known = np.array([bool(self.languages) and t is not None and letter.search(t) is not None for t in texts], bool)
        best, second = np.full(len(texts), UNDETERMINED, object), np.full(len(texts), None, object)
        score, ambiguous = np.zeros(len(texts)), np.zeros(len(texts), bool)
        if known.any():
            losses = self.losses(np.stack([ngrams(t) for t, k in zip(texts, known) if k]))
            order = np.argsort(losses, axis=1, kind="stable")
            rows, names = np.arange(len(losses)), np.array(self.languages, object)
            away = losses - losses[rows, order[:, 0]][:, None]
            best[known] = names[order[:, 0]]
            score[known] = 1.0 / np.exp(-SHARPNESS * away).sum(axis=1)
            if len(names) > 1:
                second[known] = names[order[:, 1]]
                ambiguous[known] = away[rows, order[:, 1]] < AMBIGUOUS
        return best, score, second, ambiguous


def model_of(languages: list[str], counts: np.ndarray) -> Model:
    """The bits' classifiers from n-gram counts of each language; languages weigh alike, however many texts they have."""
    smooth = counts + 0.5
    share = smooth / smooth.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    side = lambda sign: np.stack([share[code[:, b] == sign].mean(axis=0) for b in range(code.shape[1])], axis=1)
    if not code.shape[1]:
        nothing = np.zeros(0)
        return Model(languages, code, np.zeros((counts.shape[1], 0)), nothing, nothing, nothing)
    ones, zeros = side(1), side(-1)
    weights = np.log(ones) - np.log(zeros)
    high, low = (ones * weights).sum(axis=0), (zeros * weights).sum(axis=0)
    gap = np.maximum(high - low, 1e-9)
    return Model(languages, code, weights, (high + low) / 2, gap / 2, gap / gap.sum())


def learn(documents: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Fit on all rows with a language: n-gram counts are summed over partitions, then over the table."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, body in zip(batch["lang"], batch["text"]):
                sums[language] = sums.get(language, 0) + ngrams(body)
        for language, total in sums.items():
            places = np.flatnonzero(total)
            yield pd.DataFrame({"lang": language, "place": places, "n": total[places]})

    rows = documents.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    totals = rows.mapInPandas(work, "lang string, place bigint, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    # A row for each language and bucket at most.
    found = totals.limit(MAX_LANGUAGES * 2 * BUCKETS + 1).toPandas()
    languages = sorted(found["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((len(languages), 2 * BUCKETS))
    place = {language: i for i, language in enumerate(languages)}
    counts[found["lang"].map(place).to_numpy(int), found["place"].to_numpy(int)] = found["n"].to_numpy(float)
    return model_of(languages, counts)


def identify(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score, runner_up, ambiguous`` of each whole text.

    ``und`` with score 0 if the text is null or has no letter, or if no language
    was learned. Ties go to the first language by name. Repeated rows and null
    keys keep their rows; other columns are not read.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), AT_A_TIME):
                part = batch.iloc[at : at + AT_A_TIME]
                best, score, second, ambiguous = model.judge(part["text"].tolist())
                yield pd.DataFrame({"key": part["key"], "lang_pred": best, "score": score, "runner_up": second, "ambiguous": ambiguous})

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInPandas(work, f"key {kind}, lang_pred string, score double, runner_up string, ambiguous boolean")
    return out.withColumnRenamed("key", key)


def with_language(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents whose language can be told, with all their columns; rows are judged where they are read.

    Null texts and texts without a letter go, and all texts where no language was learned;
    texts of any length are read whole, repeated rows and null keys stay like any other. An
    empty table gives no rows. Columns keep their names and values.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column(text).to_pylist(), []
            for at in range(0, len(texts), AT_A_TIME):
                keep.append(model.judge(texts[at : at + AT_A_TIME])[0] != UNDETERMINED)
            yield batch.filter(pa.array(np.concatenate([np.zeros(0, bool), *keep]).astype(bool)))

    return map_batches(documents, work)
