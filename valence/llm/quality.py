"""Document quality by ridge regression on random Fourier features, with isotonic calibration.

A text becomes a few statistics of its letters, words and lines. Random cosines of
these approximate a Gaussian kernel. Each task sums its part of the normal
equations over all labelled rows it holds; the sums, whose size is fixed, are
added up and solved. The raw scores of a fold of their own, counted in narrow
bins, give the isotonic calibration.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..sinks.writers import stage
from .common import Isotonic, fold, held_out

FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
FEATURES, SEED, RIDGE, FAR = 256, 42, 1.0, 6.0
BINS, LOW, HIGH = 3000, -1.0, 2.0
THRESHOLD = 0.3

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "lower", "upper", "digits", "spaces", "marks", "beyond_ascii",
    "commonest_mark", "mark_kinds", "mean_word", "spread_word", "plain_words", "upper_words", "short_words",
    "distinct_words", "commonest_word", "word_entropy", "repeated_next", "distinct_lines", "words_a_line",
    "ended_lines", "compressed",
)
_MARKS = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])


def statistics(text: str | None) -> np.ndarray:
    """``STATISTICS`` of a whole text; all zero without a character."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return np.zeros(len(STATISTICS))
    size, seen = len(raw), np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    marks = seen[_MARKS]
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    n, m = max(len(words), 1), max(len(lines), 1)
    lengths = np.array([len(w) for w in words] or [0])
    often = np.array(list(Counter(words).values()) or [1])
    share = often / n
    return np.array([
        np.log1p(size), np.log1p(len(words)), np.log1p(len(lines)),
        seen[97:123].sum() / size, seen[65:91].sum() / size, seen[48:58].sum() / size,
        (seen[32] + seen[9:14].sum()) / size, marks.sum() / size, seen[128:].sum() / size,
        marks.max() / max(marks.sum(), 1), (marks > 0).sum() / 32,
        np.log1p(lengths.mean()), np.log1p(lengths.std()),
        sum(map(str.isalpha, words)) / n, sum(map(str.isupper, words)) / n, (lengths <= 3).sum() / n,
        len(often) / n, share.max(), -(share * np.log(share)).sum() / np.log1p(n),
        sum(map(operator.eq, words, words[1:])) / n,
        len(set(lines)) / m, np.log1p(len(words) / m),
        sum(line.rstrip()[-1] in ".!?:;\"'" for line in lines) / m,
        len(zlib.compress(raw, 1)) / size,
    ])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    calibration: Isotonic | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random cosines of the standardised statistics, the statistics themselves and a constant."""
        z = np.clip((x - self.mean) / self.scale, -FAR, FAR)
        waves = np.sqrt(2.0 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.hstack([waves, z, np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibration(self.raw(x))


def described(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, x``: the statistics of each whole text."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "x": [statistics(t) for t in batch["text"]]})

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInPandas(work, f"key {rows.schema['key'].dataType.simpleString()}, x array<double>")


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_list()) if len(rows) else np.zeros((0, len(STATISTICS)))


def _equations(rows: DataFrame, model: Model, size: int) -> np.ndarray:
    """``[Z'Z | Z'y]`` summed over all rows: each task sends one row for each line, added by line in two steps."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        total = np.zeros((size, size + 1))
        for batch in batches:
            z = model.features(_matrix(batch["x"]))
            total += z.T @ np.hstack([z, batch["y"].to_numpy(float)[:, None]])
        yield pd.DataFrame({"line": np.arange(size), "part": TaskContext.get().partitionId() % 64, "sums": list(total)})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"line": rows["line"][:1], "part": 0, "sums": [np.stack(rows["sums"].to_list()).sum(axis=0)]})

    schema = "line int, part int, sums array<double>"
    lines = rows.mapInPandas(work, schema)
    lines = lines.groupBy("line", "part").applyInPandas(add, schema).groupBy("line").applyInPandas(add, schema)
    out = np.zeros((size, size + 1))
    for row in lines.select("line", "sums").collect():  # a matrix of fixed size
        out[row["line"]] = row["sums"]
    return out


def learn(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Model:
    """Fit on all labelled rows that are not held out; of repeated labels the larger counts."""
    learnable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (fold(key, FOLDS) != HELD_OUT))
    learnable = learnable.groupBy(F.col(key).alias("key")).agg(F.max(F.col(label).cast("double")).alias("y"))
    rows = stage(stats.join(learnable, "key").select("x", "y", (fold("key", FOLDS) == CALIBRATION).alias("late")), "learnable")
    fit, n = rows.where("NOT late"), len(STATISTICS)
    moments = [f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in range(n)]
    found = np.array([v if v is not None else 0.0 for v in fit.agg(*moments).first()])
    scale = np.where(found[n:] > 1e-9, found[n:], 1.0)
    draw = np.random.default_rng(SEED)
    directions = draw.normal(size=(n, FEATURES)) / np.sqrt(n)
    model = Model(found[:n], scale, directions, draw.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + n + 1))
    size = len(model.weights)
    sums = _equations(fit, model, size)
    penalty = np.full(size, RIDGE)
    penalty[-1] = 1e-6
    model.weights = np.linalg.solve(sums[:, :-1] + np.diag(penalty), sums[:, -1])

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, BINS))
        for batch in batches:
            place = np.clip(((model.raw(_matrix(batch["x"])) - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
            y = batch["y"].to_numpy(float)
            counts += [np.bincount(place, minlength=BINS), np.bincount(place, weights=y, minlength=BINS)]
        at = np.flatnonzero(counts[0])
        yield pd.DataFrame({"bin": at, "n": counts[0][at], "y": counts[1][at]})

    bins = rows.where("late").mapInPandas(binned, "bin int, n double, y double")
    bins = bins.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).orderBy("bin").toPandas()  # at most BINS rows
    weight = bins["n"].to_numpy(float)
    centre = LOW + (bins["bin"].to_numpy(float) + 0.5) * (HIGH - LOW) / BINS
    model.calibration = Isotonic(centre, bins["y"].to_numpy(float) / np.maximum(weight, 1), weight)
    return model


def score(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``key, held_out, score, predicted`` of each whole text.

    Null and empty texts have statistics of zero and are scored like any other.
    Without labels of the fitted folds all scores are zero. Repeated rows and null
    keys keep their rows; other columns are not read. An empty table gives no rows.
    """
    stats = stage(described(documents, key, text), "statistics")
    model = learn(stats, labels, key, label)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "score": model.score(_matrix(batch["x"]))})

    scored = stats.mapInPandas(work, f"key {stats.schema['key'].dataType.simpleString()}, score double")
    return scored.select(
        F.col("key").alias(key), held_out("key", FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
