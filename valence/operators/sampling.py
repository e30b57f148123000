"""Repeatable samples and splits by the MD5 of a key."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import digest, stable_hash
from ..sinks.writers import stage
from .prefix import numbered

_HASHES = 1 << 32


def hash_sample(rows: DataFrame, key: str, fraction: float) -> DataFrame:
    """About ``fraction`` of the keys: a filter, so no sort and no shuffle."""
    return rows.where(f"{stable_hash(key)} < {int(fraction * _HASHES)}")


def train_test_split(rows: DataFrame, key: str, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Split by key. A row's side depends on its key only, never on partitioning."""
    in_train = f"{stable_hash(key)} % 100 < {train_percent}"
    return rows.where(in_train), rows.where(f"NOT {in_train}")


def exact_sample(rows: DataFrame, key: str, n: int, work: str | None = None) -> DataFrame:
    """The ``n`` rows that come first by MD5 of the key (all rows where there are fewer).

    Two passes over the rows. The first counts 65,536 hash prefixes and finds the
    one in which row ``n`` lies. The second writes the rows up to that prefix, a
    little more than the sample; only those with that prefix are sorted. Equal
    and null keys are ordered by the other columns, so the choice repeats.
    ``work`` is the folder to write to, else that of the session.
    """
    if n <= 0:
        return rows.limit(0)
    code = F.expr(digest(key))
    prefix = F.substring(code, 1, 4)
    counts = rows.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("cnt"))
    # At most 65,536 rows.
    upto = counts.select("prefix", "cnt", F.sum("cnt").over(Window.orderBy("prefix")).alias("upto"))
    hit = upto.where(F.col("upto") >= n).orderBy("prefix").first()
    if hit is None:
        return rows
    kept = stage(rows.where(prefix <= hit["prefix"]), "sample", work)
    others = [F.col(f"`{c}`") for c in kept.columns if c != key]
    last = kept.where(prefix == hit["prefix"]).orderBy(code, F.col(key), *others).limit(n - hit["upto"] + hit["cnt"])
    return kept.where(prefix < hit["prefix"]).unionByName(last)


# Rounds of the permutation, and steps after which a number is back below the row count (see ``shuffled_place``).
ROUNDS, STEPS = 6, 64
_MODULUS = 1 << 31
# Multipliers of the mixing step, below the modulus.
_MIX = (1103515245, 747796405)


def round_keys(seed: int) -> list[int]:
    """A number for each half round, made from the seed by the mixing step itself."""
    keys, x = [], seed % _MODULUS
    for i in range(2 * ROUNDS):
        x = (x + i + 1) * _MIX[0] % _MODULUS
        x ^= x >> 15
        x = x * _MIX[1] % _MODULUS
        x ^= x >> 13
        keys.append(x)
    return keys


def grid_of(n: int) -> tuple[int, int]:
    """Sides of the smallest grid, about square, that has ``n`` places."""
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, -(-n // a) if n else 1


def shuffled_place(x: str, n: int, seed: int) -> str:
    """A permutation of the numbers below ``n``: the place of number ``x`` (an SQL expression).

    A Feistel network over a grid of two sides: the row moves by a mix of the column, then
    the column by a mix of the row, and so on; each half round can be undone, so all are
    bijections of the grid. A number that falls on one of the few places from ``n`` on goes
    through again until it does not. Those places are fewer than a side, and in a grid of up
    to ``STEPS`` rows a walk cannot be longer; in a larger one the chance of it is below
    (1 / STEPS) ** STEPS.
    """
    a, b = grid_of(n)
    first = lambda v: f"(({v} + element_at(keys, i)) % {_MODULUS}L * {_MIX[0]}L % {_MODULUS}L)"
    fold = lambda v, bits: f"transform(array({v}), m -> m ^ shiftright(m, {bits}))[0]"
    mixed = lambda v: fold(f"({fold(first(v), 15)} * {_MIX[1]}L % {_MODULUS}L)", 13)
    keys = f"array({', '.join(f'{k}L' for k in round_keys(seed))})"
    row = f"named_struct('l', (s.l + {mixed('s.r')}) % {a}L, 'r', s.r)"
    column = f"named_struct('l', s.l, 'r', (s.r + {mixed('s.l')}) % {b}L)"
    once = (
        f"aggregate(sequence(1, {2 * ROUNDS}), named_struct('l', y div {b}L, 'r', y % {b}L), (s, i) -> CASE WHEN i % 2 = 1 THEN {row} ELSE {column} END,"
        f" s -> s.l * {b}L + s.r)"
    )
    walk = f"aggregate(sequence(1, {STEPS}), CAST({x} AS BIGINT), (y, step) -> CASE WHEN step = 1 OR y >= {n}L THEN {once} ELSE y END)"
    return f"transform(array({keys}), keys -> {walk})[0]"


def shuffle_order(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Rows with ``place``, a number from 0 without a gap: a random order that no sort has made.

    Rows are numbered by ``key`` (nulls first, equal keys in no fixed order among themselves),
    and the numbers permuted where they stand: the order depends on the keys, their number
    and the seed only. A slice of places is a sample without replacement of an exact size.
    An empty table gives no rows.
    """
    place = numbered(rows, F.col(key).asc_nulls_first(), into="place")
    n = place.count()
    return place.withColumn("place", F.expr(shuffled_place("place", n, seed)))
