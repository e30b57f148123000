"""What several operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand whole texts to Python workers a few megabytes at a time, not ten thousand rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def quoted(names: list[str]) -> list[str]:
    """Column names as they stand, dots and ticks included."""
    return [f"`{name.replace('`', '``')}`" for name in names]


def unused(rows: DataFrame, name: str) -> str:
    """``name``, or a longer one if a column has it."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(rows: DataFrame, work: Callable[[Iterator[Any]], Iterator[Any]], *added: StructField) -> DataFrame:
    """``mapInArrow`` with the columns of ``rows`` and those added. Names with dots, which it does not take, are put aside for it."""
    schema = StructType([*rows.schema.fields, *added])
    if not any("." in name or "`" in name for name in rows.columns):
        return rows.mapInArrow(work, schema)
    names, n = schema.names, len(rows.columns)
    plain = [f"c{i}" for i in range(len(names))]

    def renamed(batches: Iterator[Any]) -> Iterator[Any]:
        for batch in work(b.rename_columns(names[:n]) for b in batches):
            yield batch.rename_columns(plain)

    fields = [StructField(name, field.dataType, field.nullable) for name, field in zip(plain, schema.fields)]
    return rows.toDF(*plain[:n]).mapInArrow(renamed, StructType(fields)).toDF(*names)


def fold(key: str | Column, parts: int) -> Column:
    """Fold of a row: CRC-32 of its key as text, modulo ``parts``; null for a null key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(column.cast("string")), F.lit(parts))


def held_out(key: str | Column, parts: int, kept_out: int) -> Column:
    """Whether a row's label may not be learned from; a null key has no fold and no label: false."""
    return F.coalesce(fold(key, parts) == kept_out, F.lit(False))


def once_per_worker(name: str, build: Callable[[], Any]) -> Any:
    """A read-only object, built once in each Python worker, which runs many tasks."""
    kept = sys.__dict__.setdefault("_once_per_worker", {})
    if name not in kept:
        kept[name] = build()
    return kept[name]


class Isotonic:
    """Non-decreasing calibration of a raw score: pooled blocks, with straight lines between their centres.

    Each block is drawn to the mean of all by one average observation, so that no score is certain.
    """

    def __init__(self, raw: np.ndarray, target: np.ndarray, weight: np.ndarray):
        order = np.argsort(raw, kind="stable")
        blocks: list[list[float]] = []
        for x, y, w in zip(raw[order], target[order], weight[order]):
            if w <= 0:
                continue
            blocks.append([x * w, y * w, w])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
        total = max(sum(b[2] for b in blocks), 1e-12)
        mean, one = sum(b[1] for b in blocks) / total, total / max(int((weight > 0).sum()), 1)
        self.x = np.array([b[0] / b[2] for b in blocks])
        self.y = np.array([(b[1] + one * mean) / (b[2] + one) for b in blocks])

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        if not len(self.x):
            return np.clip(raw, 0.0, 1.0)
        return np.clip(np.interp(raw, self.x, self.y), 0.0, 1.0)
