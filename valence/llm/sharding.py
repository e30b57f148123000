"""Shards by a hierarchical weighted hash tree: region, then rack, then shard.

At each level a row draws ``-ln(u) / weight`` for every child, with ``u`` from the
hash of the row's key and the child's place in the tree; the smallest draw wins,
so a child gets rows in proportion to the weight below it. A change of weight
changes the draws of the changed child alone at each level: rows move only into
or out of subtrees whose weight changes. A new shard opens a region of its own,
so it takes rows only into itself.

Everything is a SQL expression of the row; the tree is part of the expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..sinks.writers import stage


@dataclass(frozen=True)
class Leaf:
    """A shard, its place and its weight."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(shards: int, base: int = 40, racks: int = 5, per_rack: int = 4) -> list[Leaf]:
    """The tree of a shard count: ``base`` shards in regions of ``racks`` racks, every further one in its own region."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    size = racks * per_rack
    regions = -(-base // size)
    return [
        Leaf(s // size, s // per_rack % racks, s) if s < base else Leaf(regions + s - base, 0, s) for s in range(shards)
    ]


def tree(leaves: list[Leaf]) -> str:
    """The tree as a SQL constant: regions, each with its racks, each with its shards."""
    regions: dict[int, dict[int, dict[int, float]]] = {}
    for leaf in leaves:
        regions.setdefault(leaf.region, {}).setdefault(leaf.rack, {})[leaf.shard] = leaf.weight

    def node(name: int, weight: float, below: str) -> str:
        return f"named_struct('id', {name}, 'weight', {float(weight)!r}D, 'below', {below})"

    def shards(rack: dict[int, float]) -> str:
        return f"array({', '.join(node(s, w, '0') for s, w in sorted(rack.items()))})"

    def racks(region: dict[int, dict[int, float]]) -> str:
        return f"array({', '.join(node(r, sum(x.values()), shards(x)) for r, x in sorted(region.items()))})"

    total = lambda region: sum(sum(rack.values()) for rack in region.values())
    return f"array({', '.join(node(g, total(x), racks(x)) for g, x in sorted(regions.items()))})"


def _winner(children: str, path: str, key: str) -> str:
    """The child with the smallest draw, the first of equal ones; ``u`` has 52 bits of a MD5."""
    bits = f"conv(substr(md5(concat_ws('/', {path}, c.id, {key})), 1, 13), 16, 10)"
    draw = f"-ln((CAST({bits} AS DOUBLE) + 0.5D) / 4503599627370496.0D) / c.weight"
    return f"array_min(transform({children}, c -> named_struct('draw', {draw}, 'id', c.id, 'below', c.below)))"


def shard_of(rows: DataFrame, leaves: list[Leaf], key: str = "doc_id", into: str = "shard") -> DataFrame:
    """Add the shard of each row's key; a null key is drawn for like the empty text."""
    name, own = f"coalesce(CAST(`{key}` AS STRING), '')", [F.col(f"`{c}`") for c in rows.columns]
    rows = rows.select(*own, F.expr(_winner(tree(leaves), "'tree'", name)).alias("__region"))
    rows = rows.select(*own, "__region", F.expr(_winner("__region.below", "__region.id", name)).alias("__rack"))
    shard = _winner("__rack.below", "__region.id, __rack.id", name)
    return rows.select(*own, F.expr(f"{shard}.id").alias(into))


def number(rows: DataFrame, shard: str = "shard", part: str = "part", order: tuple[str, ...] = ()) -> DataFrame:
    """Add ``slot``: numbers without a gap in each shard, from 0.

    Rows are numbered within a shard and part, then moved by the count of the
    parts before. A part is one input split, whose size Spark bounds, so that
    neither a large shard nor a hot key is numbered in one task.
    """
    counts = rows.groupBy(shard, part).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    own = Window.partitionBy(shard, part).orderBy(*(order or (part,)))
    numbered = rows.withColumn("__own", F.row_number().over(own))
    return numbered.join(offsets, [shard, part]).withColumn("slot", F.expr("__before + __own - 1")).drop("__own", "__before")


def assign(
    documents: DataFrame, leaves: list[Leaf], grown: list[Leaf] | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, size, text_crc32, shard, grown_shard, slot`` of each row.

    ``size`` is the text's bytes and 16; a null text counts as empty. Rows with
    one key go to one shard; a null key is drawn for like the empty text. Repeated
    rows stay apart and get slots of their own. Other columns are not read. An
    empty table gives no rows. Whole texts stay in the scan: later steps carry
    six numbers a row, and the written table fixes each row's part.
    """
    body = f"coalesce(`{text}`, '')"
    rows = documents.select(
        F.col(key).alias("key"),
        F.expr(f"CAST(octet_length({body}) + 16 AS BIGINT)").alias("size"),
        F.expr(f"crc32(CAST({body} AS BINARY))").alias("text_crc32"),
        F.spark_partition_id().alias("part"),
    )
    rows = shard_of(rows, leaves, "key")
    rows = shard_of(rows, grown, "key", "grown_shard") if grown else rows.withColumn("grown_shard", F.lit(None).cast("int"))
    rows = number(stage(rows, "shards"), order=("key", "text_crc32", "size"))
    return rows.select(F.col("key").alias(key), "size", "text_crc32", "shard", "grown_shard", "slot")
