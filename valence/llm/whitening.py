"""Whitening of embeddings: principal components of a distributed covariance, refined in mixed precision.

Entries become whole numbers, so the sums and the centred products that the tasks
hand on are exact, whatever the order of the rows. The driver gets them once for
each pair of dimensions, never by row: float32 eigenvectors of the covariance are
corrected by the iteration of Ogita and Aishima, which needs matrix products only.
Eigenvectors of a cluster of eigenvalues, which that correction cannot tell apart,
come from a small eigenproblem of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Fixed values of the contract: an entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Entries stay below this, so that products of a block are exact in a double and sums in 64 bits.
LARGEST = 1 << 40
#: Below this share of the largest eigenvalue a component has no spread that doubles can tell from zero.
NO_SPREAD = 1e-13
ROUNDS = 30
_EXACT = 1 << 53


# --- exact sums -----------------------------------------------------------------------------------------------------


def whole_numbers(vectors: pd.Series, width: int) -> np.ndarray:
    """``floor(SCALE * c) + OFFSET`` of the entries, a row for each vector."""
    if not len(vectors):
        return np.zeros((0, width), np.int64)
    scaled = np.floor(SCALE * np.stack(vectors.to_numpy()).astype(np.float64)) + OFFSET
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise OverflowError(f"an entry lies beyond {LARGEST // SCALE}: it has no place in this whole-number form")
    return scaled.astype(np.int64)


def exact_gram(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` of whole numbers, exact as Python numbers: by blocks whose sums a double holds."""
    width = y.shape[1]
    if not len(y):
        return np.zeros((width, width), object)
    most = max(int(np.abs(y).max()), 1)
    rows = _EXACT // (most * most)
    if rows == 0:  # too large for doubles: high and low halves
        high, low = y >> 20, y & ((1 << 20) - 1)
        cross = exact_product(high, low)
        return (exact_gram(high) << 40) + ((cross + cross.T) << 20) + exact_gram(low)
    total = np.zeros((width, width), object)
    for at in range(0, len(y), rows):
        part = y[at : at + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of whole numbers below 2**21, exact."""
    total, rows = np.zeros((a.shape[1], b.shape[1]), object), 1 << 11
    for at in range(0, len(a), rows):
        total += (a[at : at + rows].astype(np.float64).T @ b[at : at + rows].astype(np.float64)).astype(np.int64)
    return total


def usable(embeddings: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, vector`` of the rows whose vector is there and whole."""
    column = F.col(f"`{vector}`").cast("array<double>")
    rows = embeddings.select(F.col(f"`{key}`").alias("key"), column.alias("vector")).where("vector IS NOT NULL")
    odd = "exists(vector, c -> c IS NULL OR isnan(c) OR abs(c) = double('Infinity'))"
    return rows.where(f"NOT {odd}")


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n, total = 0, None
    for batch in batches:
        if len(batch):
            x = whole_numbers(batch["vector"], 0)
            n, total = n + len(x), x.sum(axis=0) if total is None else total + x.sum(axis=0)
    if n:
        yield pd.DataFrame({"n": n, "i": np.arange(len(total)), "s": total})


def _products(centre: np.ndarray):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = len(centre)
        total = np.zeros((width, width), object)
        for batch in batches:
            total += exact_gram(whole_numbers(batch["vector"], width) - centre)
        i, j = np.triu_indices(width)
        yield pd.DataFrame({"i": i, "j": j, "p": [str(v) for v in total[i, j]]})

    return work


def moments(rows: DataFrame, width: int) -> tuple[int, list[int], list[list[Fraction]]]:
    """Number of rows, sums by dimension and the exact covariance (divisor n) of ``vector`` as whole numbers.

    Two passes: the products are of entries less the rounded mean. Each task hands on
    a number for each pair of dimensions, added up by pair before the driver gets them.
    """
    parts = rows.select("vector").mapInPandas(_sums, "n bigint, i int, s bigint")
    summed = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    if not summed:
        return 0, [], []
    n, sums = int(summed[0]["n"]), [0] * width
    for row in summed:
        sums[row["i"]] = int(row["s"])
    centre = [round(Fraction(s, n)) for s in sums]
    pairs = rows.select("vector").mapInPandas(_products(np.array(centre, np.int64)), "i int, j int, p string")
    pairs = pairs.groupBy("i", "j").agg(F.sum(F.col("p").cast("decimal(38,0)")).alias("p"))
    rest = [Fraction(s, n) - c for s, c in zip(sums, centre)]
    covariance = [[Fraction(0)] * width for _ in range(width)]
    for row in pairs.collect():
        i, j = row["i"], row["j"]
        covariance[i][j] = covariance[j][i] = Fraction(int(row["p"]), n) - rest[i] * rest[j]
    return n, sums, covariance


# --- eigenvectors ---------------------------------------------------------------------------------------------------


def refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One correction of approximate eigenvectors ``x`` of symmetric ``a``: eigenvalues, vectors, and which are in clusters.

    With R = I - X'X and S = X'AX, eigenvalues are S_ii / (1 - R_ii) and X moves by X E, where
    E_ij = (S_ij + w_j R_ij) / (w_j - w_i) for eigenvalues that are apart, else R_ij / 2.
    """
    product = a @ x
    r, s = np.eye(len(a), dtype=x.dtype) - x.T @ x, x.T @ product
    s = (s + s.T) / 2  # else rounding, divided by a small gap, would cost the vectors their right angles
    w = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(w)
    norm = lambda m: np.sqrt((m * m).sum())
    limit = 2 * (norm(off) + np.abs(w).max() * norm(r))
    gap = w[None, :] - w[:, None]
    apart = np.abs(gap) > limit
    e = np.where(apart, (s + w[None, :] * r) / np.where(apart, gap, 1), r / 2)
    close = ~apart
    np.fill_diagonal(close, False)
    return w, x + x @ e, close


def _clusters(close: np.ndarray) -> list[np.ndarray]:
    """Groups of indices tied by ``close``, for eigenvalues in order."""
    found, seen = [], np.zeros(len(close), bool)
    for i in range(len(close)):
        if seen[i] or not close[i].any():
            continue
        group, todo = set(), [i]
        while todo:
            k = todo.pop()
            if k not in group:
                group.add(k)
                todo.extend(np.flatnonzero(close[k]).tolist())
        seen[list(group)] = True
        found.append(np.array(sorted(group)))
    return found


def _solve_cluster(a: np.ndarray, x: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Turn the vectors of a cluster within their span: the shifted matrix there is small, so its own spread shows."""
    part = x[:, members]
    product = a @ part
    middle = np.mean(np.einsum("ij,ij->j", part, product) / np.einsum("ij,ij->j", part, part))
    small = part.T @ (product - middle * part)
    scale = np.abs(small).max()
    if scale == 0:
        return part
    _, turn = np.linalg.eigh(((small + small.T) / (2 * scale)).astype(np.float64))
    return part @ turn.astype(x.dtype)


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix of long doubles.

    A start in float32, then corrections in long double until they no longer change a
    double. While eigenvalues are too close for the correction, their vectors are
    solved for among themselves; exact multiples keep any basis of their space.
    """
    width = len(matrix)
    scale = np.abs(matrix).max()
    if width == 0 or scale == 0:
        return np.zeros(width), np.eye(width)
    a = (matrix / scale).astype(np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    for _ in range(ROUNDS):
        before = x
        w, x, close = refine(a, x)
        for members in _clusters(close):
            x[:, members] = _solve_cluster(a, x, members)
        if not close.any() and np.abs(x - before).max() < 1e-17:
            break
    x = x / np.sqrt((x * x).sum(axis=0))
    w = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-w, kind="stable")
    w, x = w[order] * scale, x[:, order]
    sign = np.where(x[np.abs(x).argmax(axis=0), np.arange(width)] < 0, -1, 1)
    return w.astype(np.float64), (x * sign).astype(np.float64)


# --- the operator ---------------------------------------------------------------------------------------------------

_OUT = "key {kind}, components array<struct<component int, whitened double, explained double>>, n bigint, deviation bigint"


def _project(n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float, kept: int):
    """A worker that whitens vectors on the first ``kept`` components."""
    width = len(sums)
    centre = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    rest = np.array([float(Fraction(s, n) - int(c)) for s, c in zip(sums, centre)])
    spread = values[:kept] > NO_SPREAD * max(values[0], 0) if kept else np.zeros(0, bool)
    scale = np.sqrt(np.where(spread, values[:kept], 1.0))
    explained = np.maximum(values[:kept], 0) / trace if trace > 0 else np.zeros(kept)
    exact_rest = np.array([s - n * int(c) for s, c in zip(sums, centre)], object)

    def deviations(y: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2; null if it is beyond 64 bits."""
        most = n * (int(np.abs(y).max()) + 1) if y.size else 0
        if most * most * max(width, 1) < 1 << 63:
            d = n * y - exact_rest.astype(np.int64)
            return [int(v) for v in (d * d).sum(axis=1)]
        whole = [int((d * d).sum()) for d in (n * y.astype(object) - exact_rest)]
        return [v if v < 1 << 63 else None for v in whole]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            y = whole_numbers(batch["vector"], width) - centre
            z = (y - rest) @ vectors[:, :kept] / scale
            numbers = [
                [{"component": k + 1, "whitened": float(v) if spread[k] else None, "explained": float(explained[k])} for k, v in enumerate(row)]
                for row in z
            ]
            yield pd.DataFrame({"key": batch["key"], "components": numbers, "n": n, "deviation": pd.array(deviations(y), "Int64")})

    return work


def _identity_error(whitened: DataFrame) -> float:
    """Largest absolute entry of the covariance of ``whitened`` (centred, divisor n) minus the identity, over components with a spread."""
    row = whitened.select(F.expr("filter(transform(components, c -> c.whitened), v -> v IS NOT NULL)").alias("v"))
    numbered = row.select("v", F.posexplode("v").alias("i", "z"))
    means = {r["i"]: r["m"] for r in numbered.groupBy("i").agg(F.avg("z").alias("m")).collect()}
    if not means:
        return 0.0
    centred = f"zip_with(v, array({', '.join(repr(means[i]) + 'D' for i in sorted(means))}), (z, m) -> z - m)"
    entries = row.selectExpr(f"{centred} AS v").selectExpr("v", "posexplode(v) AS (i, z)").selectExpr("i", "z", "posexplode(v) AS (j, y)")
    covariance = entries.where("i <= j").groupBy("i", "j").agg(F.avg(F.col("z") * F.col("y")).alias("c"))
    error = covariance.agg(F.max(F.abs(F.col("c") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))).alias("e"))
    return float(error.first()["e"])


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` of each vector and component.

    Rows whose vector is null or holds a null, NaN or infinite entry go. So do vectors
    whose length is not the most frequent one (of equally frequent ones the longest):
    they have no place in one covariance. All others fit it, repeated rows and rows with
    a null key included, and keep their key. A component without spread (constant or
    dependent dimensions, a single vector) has a null ``whitened`` and explains 0;
    ``deviation`` is null where it is beyond 64 bits. An empty table, and vectors without
    entries, give no rows. Other columns are not read. Entries beyond 2**30 raise an error.
    """
    rows = usable(embeddings, key, vector)
    lengths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = lengths["width"] if lengths else 0
    rows = rows.where(F.size("vector") == width)
    kept = min(components, width)
    kind = rows.schema["key"].dataType.simpleString()
    n, sums, exact = moments(rows, width) if width else (0, [], [])
    longs = np.array([[np.longdouble(v.numerator) / np.longdouble(v.denominator) for v in line] for line in exact], np.longdouble)
    values, vectors = eigenvectors(longs.reshape(width, width)) if n else (np.zeros(0), np.zeros((0, 0)))
    trace = float(sum(exact[i][i] for i in range(width))) if n else 0.0
    if not n:
        names = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], names)
    whitened = rows.mapInPandas(_project(n, sums, values, vectors, trace, kept), _OUT.format(kind=kind))
    error = _identity_error(whitened)
    return whitened.select("key", "n", "deviation", F.inline("components")).select(
        F.col("key").alias(key), "component", "n", "deviation", "whitened", "explained", F.lit(error).alias("identity_error")
    )
