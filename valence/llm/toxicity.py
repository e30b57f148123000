"""Toxicity by the nearest labelled examples in exact TF-IDF cosine, found with a block-max inverted index.

Learning takes a bounded sample of the labelled texts: ``EXAMPLES`` toxic and as
many clean ones for the index, and ``CALIBRATION`` of each for the calibration,
chosen by a hash among distinct texts. Terms (words and beginnings of words) that
the sample ties to either class (chi-squared above ``CHI``, at most ``TERMS``)
span the vectors; document frequencies are counted over all documents. An example's vector is stored by
blocks of ``BLOCK`` examples: for each block the largest weight of each term, and
the postings. A query visits blocks in the order of their bounds, and stops when
no block can hold a nearer example; the nearest are exact. They vote by distance,
each example weighing as many labelled texts as it stands for, and the vote is
calibrated on the other part of the sample.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sinks.writers import stage
from .common import Isotonic, fold, held_out, map_batches

FOLDS, HELD_OUT = 5, 0
EXAMPLES, CALIBRATION = 2000, 1000
TERMS, CHI, LEAST_TEXTS = 2048, 25.0, 5
BLOCK, NEAREST, EVIDENCE = 64, 15, 5
NEAR = 0.05
WORD = r"[^\W\d_]+"
#: Letters of a word's beginnings that are terms as well, for inflected and compound words.
BEGINNINGS = (5, 6, 7, 8)


def _finder():
    import re

    return re.compile(WORD).findall


def terms_of(text: str | None, find) -> Counter:
    """How often a text holds each term: words, beginnings of longer words (``abcde-``), and both again
    where they stand twice or more (``abcde-+``), as a vector of length one has no other way to tell that.
    """
    out = Counter(find((text or "").lower()))
    for word, n in list(out.items()):
        for size in BEGINNINGS:
            if len(word) > size:
                out[word[:size] + "-"] += n
    out.update({term + "+": n for term, n in out.items() if n > 1})
    return out


class Vocabulary:
    """The chosen terms and their places; counts them without making the other terms of a text."""

    def __init__(self, terms: list[str]):
        self.terms, self.place = terms, {t: i for i, t in enumerate(terms)}
        # Beginnings that have to be counted, also where only their repetition is a term.
        self.counted = {t.rstrip("+") for t in terms}
        self.starts = {t[: BEGINNINGS[0]] for t in self.counted if t.endswith("-")}
        self.again = {t.rstrip("+") for t in terms if t.endswith("+")}

    def counts(self, text: str | None, find) -> dict[int, int]:
        found: dict[str, int] = {}
        for word, n in Counter(find((text or "").lower())).items():
            if word in self.counted:
                found[word] = n
            if word[: BEGINNINGS[0]] in self.starts:
                for size in BEGINNINGS:
                    start = word[:size] + "-"
                    if len(word) > size and start in self.counted:
                        found[start] = found.get(start, 0) + n
        out = {self.place[t]: n for t, n in found.items() if t in self.place}
        out.update({self.place[t + "+"]: n for t, n in found.items() if n > 1 and t in self.again})
        return out


class Index:
    """Unit vectors of examples in blocks, with the largest weight of each term in each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int):
        self.size = len(vectors)
        # Examples with the same heaviest term stand together, so that blocks have few terms.
        heaviest = [int(t[np.argmax(w)]) if len(t) else terms for t, w in vectors]
        self.order = np.array(sorted(range(self.size), key=lambda i: (heaviest[i], i)), dtype=np.int64)
        blocks = -(-self.size // BLOCK)
        self.most = np.zeros((terms, blocks))
        self.postings: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []
        for b in range(blocks):
            lists: dict[int, list[tuple[int, float]]] = {}
            for place, example in enumerate(self.order[b * BLOCK : (b + 1) * BLOCK]):
                for t, w in zip(*vectors[example]):
                    lists.setdefault(int(t), []).append((place, float(w)))
            kept = {}
            for t, rows in lists.items():
                self.most[t, b] = max(w for _, w in rows)
                kept[t] = (np.array([p for p, _ in rows]), np.array([w for _, w in rows]))
            self.postings.append(kept)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> list[tuple[float, int]]:
        """The ``k`` examples of the largest cosine above zero, exact; ties go to the first example."""
        bounds = weights @ self.most[terms]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or (len(best) == k and bounds[b] < -best[-1][0] - 1e-12):
                break
            cosine = np.zeros(BLOCK)
            for t, w in zip(terms.tolist(), weights.tolist()):
                if t in self.postings[b]:
                    places, stored = self.postings[b][t]
                    cosine[places] += w * stored
            found = [(-cosine[p], int(self.order[b * BLOCK + p])) for p in np.flatnonzero(cosine > 0)]
            best = sorted(best + [f for f in found if f[1] != without])[:k]
        return [(-c, example) for c, example in best]


@dataclass
class Model:
    vocabulary: Vocabulary
    idf: np.ndarray
    index: Index
    ids: list
    labels: np.ndarray
    weight: np.ndarray
    base: float
    calibration: Isotonic

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        terms = np.array(sorted(counts), dtype=np.int64)
        weights = (1.0 + np.log(np.array([counts[t] for t in terms.tolist()], float))) * self.idf[terms]
        length = np.sqrt((weights**2).sum())
        return (terms, weights / length) if length > 0 else (terms[:0], weights[:0])

    def vote(self, counts: dict[int, int], without: int = -1) -> tuple[float, list[tuple[float, int]]]:
        """Weighted share of toxic examples among the nearest; without any near example, their share among such texts."""
        found = self.index.nearest(*self.vector(counts), NEAREST, without) if counts else []
        if not found:
            return self.base, []
        near = np.array([1.0 / (1.0 - min(c, 1.0) + NEAR) for c, _ in found])
        examples = np.array([i for _, i in found])
        weight = near * self.weight[examples]
        return float((weight * self.labels[examples]).sum() / weight.sum()), found

    def judge(self, counted: list[dict[int, int]]) -> tuple[np.ndarray, list[list[dict]]]:
        """Calibrated scores, and the nearest examples as evidence; equal vectors are judged once."""
        known: dict[tuple, tuple[float, list]] = {}
        raw, evidence = [], []
        for counts in counted:
            name = tuple(sorted(counts.items()))
            if name not in known:
                known[name] = self.vote(counts)
            share, found = known[name]
            raw.append(share)
            evidence.append([{"id": self.ids[i], "cosine": c, "label": int(self.labels[i])} for c, i in found[:EVIDENCE]])
        return self.calibration(np.array(raw)), evidence


def vectors(documents: DataFrame, vocabulary: Vocabulary, key: str, text: str) -> DataFrame:
    """``key, terms, counts``: how often each whole text holds the chosen terms."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = _finder()
        for batch in batches:
            counted = [vocabulary.counts(t, find) for t in batch["text"]]
            yield pd.DataFrame({"key": batch["key"], "terms": [list(c) for c in counted], "counts": [list(c.values()) for c in counted]})

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInPandas(work, f"key {rows.schema['key'].dataType.simpleString()}, terms array<int>, counts array<int>")


def _document_frequencies(stored: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """In how many documents each term stands, and the number of documents; a task hands on one row of each term."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, rows = np.zeros(terms, np.int64), 0
        for batch in batches:
            rows += len(batch)
            counts += np.bincount(np.concatenate([np.zeros(0, np.int64), *batch["terms"]]).astype(np.int64), minlength=terms)
        place = np.flatnonzero(counts)
        yield pd.DataFrame({"term": np.append(place, -1), "n": np.append(counts[place], rows)})

    sums = stored.select("terms").mapInPandas(work, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {row["term"]: row["n"] for row in sums}
    return np.array([found.get(t, 0) for t in range(terms)], float), found.get(-1, 0)


def _sample(documents: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> tuple[DataFrame, dict[int, int]]:
    """``key, label, role`` of the chosen rows, and the number of distinct labelled texts of each class."""
    learnable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (fold(key, FOLDS) != HELD_OUT))
    learnable = learnable.groupBy(F.col(key).alias("key")).agg(F.max(label).alias("label"))
    texts = documents.select(F.col(key).alias("key"), F.xxhash64(text).alias("of")).where(F.col(text).isNotNull())
    distinct = texts.join(learnable, "key").groupBy("of").agg(F.min("key").alias("key"), F.avg("label").alias("share"))
    distinct = stage(distinct.select("key", "of", F.expr("CAST(share >= 0.5 AS INT)").alias("label")), "labelled")
    totals = {row["label"]: row["n"] for row in distinct.groupBy("label").agg(F.count("*").alias("n")).collect()}
    size = EXAMPLES + CALIBRATION
    first = lambda value: distinct.where(F.col("label") == value).orderBy(F.xxhash64("of"), "of").limit(size)
    chosen = first(1).union(first(0))
    # Every third text is for calibration, so that a short list serves both.
    ranked = chosen.withColumn("role", F.expr("row_number() OVER (PARTITION BY label ORDER BY xxhash64(of), of) % 3"))
    return ranked.select("key", "label", F.expr(f"CASE WHEN role = 0 THEN 'calibrate' ELSE 'index' END").alias("role")), totals


def _chosen_terms(texts: DataFrame) -> list[str]:
    """The terms that the sample ties to a class."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find, sums = _finder(), ({}, {})
        for batch in batches:
            for body, label in zip(batch["text"], batch["label"]):
                for term in terms_of(body, find):
                    sums[label][term] = sums[label].get(term, 0) + 1
        for label in (0, 1):
            yield pd.DataFrame({"term": list(sums[label]), "label": label, "n": list(sums[label].values())})

    n = {row["label"]: row["n"] for row in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    a, b = float(n.get(1, 0)), float(n.get(0, 0))
    if not a or not b:
        return []
    counted = texts.select("text", "label").mapInPandas(work, "term string, label int, n bigint").groupBy("term")
    sums = counted.agg(F.expr("sum(CASE WHEN label = 1 THEN n ELSE 0 END)").alias("p"), F.expr("sum(CASE WHEN label = 0 THEN n ELSE 0 END)").alias("q"))
    chi = f"({a + b} * pow(p * ({b} - q) - q * ({a} - p), 2)) / ({a} * {b} * (p + q) * ({a + b} - p - q))"
    tied = sums.where(f"p + q >= {LEAST_TEXTS} AND p + q < {a + b}").withColumn("chi", F.expr(chi)).where(f"chi >= {CHI}")
    return sorted(row["term"] for row in tied.orderBy(F.desc("chi"), "term").limit(TERMS).select("term").collect())


def learn(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> tuple[Model, DataFrame]:
    """The model, and the stored vectors of all documents."""
    chosen, totals = _sample(documents, labels, key, text, label)
    chosen = stage(chosen, "chosen")
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col(text).isNotNull())
    # At most 2 * (EXAMPLES + CALIBRATION) chosen keys; a repeated key brings its texts once.
    texts = rows.join(F.broadcast(chosen), "key").groupBy("key").agg(F.min("text").alias("text"), F.first("label").alias("label"), F.first("role").alias("role"))
    texts = stage(texts, "examples")
    terms = _chosen_terms(texts.where("role = 'index'"))
    vocabulary = Vocabulary(terms)
    stored = stage(vectors(documents, vocabulary, key, text), "vectors")
    df, total = _document_frequencies(stored, len(terms))
    idf = np.log((1.0 + total) / (1.0 + df)) + 1e-6
    # Bounded: the sample's rows, and of each the terms of the vocabulary.
    sample = texts.select("key", "label", "role").join(vectors(texts, vocabulary, "key", "text"), "key").orderBy("key").collect()
    of = lambda role: [(r["key"], r["label"], dict(zip(r["terms"], r["counts"]))) for r in sample if r["role"] == role]
    return _fit(vocabulary, idf, of("index"), of("calibrate"), totals), stored


def _fit(vocabulary: Vocabulary, idf: np.ndarray, examples: list[tuple], others: list[tuple], totals: dict[int, int]) -> Model:
    def weights(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        label = np.array([r[1] for r in rows], float)
        stands = {c: totals.get(c, 0) / max(1, int((label == c).sum())) for c in (0, 1)}
        return label, np.array([stands[r[1]] for r in rows], float)

    label, weight = weights(examples)
    empty = np.array([not r[2] for r in examples], bool)
    of = empty if empty.any() else ~empty
    base = float((weight * label)[of].sum() / max(weight[of].sum(), 1e-9)) if len(examples) else 0.0
    model = Model(vocabulary, idf, Index([], len(idf)), [r[0] for r in examples], label, weight, base, Isotonic(*[np.zeros(0)] * 3))
    model.index = Index([model.vector(r[2]) for r in examples], len(idf))
    target, share = weights(others)
    model.calibration = Isotonic(np.array([model.vote(r[2])[0] for r in others]), target, share)
    return model


def _judged(model: Model):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counted = [dict(zip(t.tolist(), c.tolist())) for t, c in zip(batch["terms"], batch["counts"])]
            score, evidence = model.judge(counted)
            yield pd.DataFrame({"key": batch["key"], "score": score, "evidence": evidence})

    return work


def score(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``key, held_out, score, predicted, evidence`` of each whole text.

    ``evidence`` lists the nearest examples with cosine and label. A null, empty
    or uncharacteristic text has no near example and gets the share of toxic ones
    among such examples. Labels of held-out rows and null labels are not read; of
    repeated labels the larger counts; equal texts are one example, toxic if half
    of their labels say so. Without labels of both classes all texts get one
    score. Repeated rows and null keys keep their rows; other columns are not read.
    """
    model, stored = learn(documents, labels, key, text, label)
    kind = stored.schema["key"].dataType.simpleString()
    schema = f"key {kind}, score double, evidence array<struct<id: {kind}, cosine: double, label: int>>"
    judged = stored.mapInPandas(_judged(model), schema)
    return judged.select(
        F.col("key").alias(key), held_out("key", FOLDS, HELD_OUT).alias("held_out"), "score",
        F.expr("CAST(score >= 0.5 AS INT)").alias("predicted"), "evidence",
    )


def without_toxic(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """The documents that score below one half, with all their columns; rows are judged where they are read.

    Scores are those of ``score``: null, empty and uncharacteristic texts get the share of
    toxic ones among such examples, texts of any length are judged whole, repeated rows and
    null keys like any other. Without labels of both classes all stay or all go by the one
    score. An empty table gives no rows. Columns keep their names and values.
    """
    model, _ = learn(documents, labels, key, text, label)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder()
        for batch in batches:
            found, _ = model.judge([model.vocabulary.counts(t, find) for t in batch.column(text).to_pylist()])
            yield batch.filter(pa.array(found < 0.5))

    return map_batches(documents, work)
