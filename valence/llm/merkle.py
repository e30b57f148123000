"""Merkle manifest of a table: hash trees by language under one root, with a proof and a recomputed root for each row.

Leaves are numbered within their tree by ranges, not by a window over a language.
A superblock is ``2 ** BITS`` neighbouring nodes of a tree and the unit of work: a
first pass reduces each superblock to the node above it, level of superblocks by
level, until each tree has one left. On the way back the nodes of a superblock are
cogrouped with the siblings that their paths need outside it, so that a task
finishes the local reduction, joins the proofs and folds them in one go. It holds
one superblock at a time, however large a language is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sinks.writers import stage

#: Levels of a tree that a superblock covers.
BITS = 10
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 7
_NODES = "tree string, pos bigint, size bigint, node string"
_OUTER = "tree string, block bigint, path array<string>, subroot string"


# --- hashes ---------------------------------------------------------------------------------------------------------


def digest(*parts: str) -> str:
    """SHA-256 of texts put together, as lower-case hex."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes: list[str], size: int, bits: int) -> list[list[str]]:
    """A superblock's nodes and all levels above, up to ``bits`` or the root of a tree of ``size`` nodes."""
    left = min(bits, max(size - 1, 0).bit_length())
    found = [nodes]
    for _ in range(left):
        below = found[-1]
        found.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return found


def steps(found: list[list[str]], at: int) -> list[str]:
    """The way of node ``at`` through the levels: its sibling on the right (R) or left (L) of each, or nothing."""
    path = []
    for level in found[:-1]:
        if at % 2:
            path.append("L" + level[at - 1])
        else:
            path.append("R" + level[at + 1] if at + 1 < len(level) else "")
        at //= 2
    return path


def fold(node: str, path: list[str]) -> str:
    """The root that a node and its siblings give."""
    for step in path:
        node = digest(step[1:], node) if step[:1] == "L" else digest(node, step[1:])
    return node


def proof(path: list[str]) -> str:
    """Digest of the siblings of a path."""
    return digest(*[step[1:] for step in path])


# --- leaves and their places ----------------------------------------------------------------------------------------


def _leaf(values: list[str]) -> str:
    fields = [f"coalesce(concat(octet_length({v}), ':', {v}), '-')" for v in values]
    return f"sha2(CAST(concat({', '.join(fields)}) AS BINARY), 256)"


def leaves(documents: DataFrame) -> DataFrame:
    """``key, tree, node, tampered``: leaf of each row, and of the row with one more in ``n_chars`` where it is tampered with.

    Hashed where the texts are read; these go no further.
    """
    text = {name: f"CAST(`{name}` AS STRING)" for name in FIELDS}
    more = text | {"n_chars": "CAST(CAST(`n_chars` AS DECIMAL(20, 0)) + 1 AS STRING)"}
    hit = f"pmod(crc32(CAST({text['doc_id']} AS BINARY)), {TAMPER_EVERY}) = 0 AND `n_chars` IS NOT NULL"
    return documents.selectExpr(
        "`doc_id` AS key",
        "coalesce(concat('=', CAST(`lang` AS STRING)), '') AS tree",
        f"{_leaf(list(text.values()))} AS node",
        f"CASE WHEN {hit} THEN {_leaf(list(more.values()))} END AS tampered",
    )


def ranked(rows: DataFrame, *order: str | Column) -> DataFrame:
    """Add ``pos`` and ``size``: the place in the tree, and the nodes of that tree. The result is a written table.

    Rows are dealt out by ranges of the order; equal rows differ by their place in the
    scan, so that a key which many rows share is dealt out as well. A row's place in its
    range is known there; the counts of the ranges before, one row each, are added.
    """
    by = ["tree", *order, "__scan"]
    dealt = rows.withColumn("__scan", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    dealt = dealt.withColumn("__part", F.spark_partition_id()).withColumn("__id", F.monotonically_increasing_id())
    dealt = stage(dealt.drop("__scan"), "ranges")
    counts = dealt.groupBy("tree", "__part").agg(F.count("*").alias("n"), F.min("__id").alias("first"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree", "__part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(tree).alias("size")
    )
    placed = dealt.join(counts, ["tree", "__part"]).withColumn("pos", F.expr("before + __id - first"))
    return placed.drop("__part", "__id", "first", "before")


# --- reduction and proofs -------------------------------------------------------------------------------------------


def _blocked(nodes: DataFrame, bits: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"shiftright(pos, {bits})"))


def _reduced(nodes: DataFrame, bits: int) -> DataFrame:
    """One node for each superblock."""

    def work(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block, size = block.sort_values("pos"), int(block["size"].iloc[0])
        top = levels(block["node"].tolist(), size, bits)[-1]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "size": [-(-size >> bits)], "node": top})

    return _blocked(nodes.select("tree", "pos", "size", "node"), bits).groupBy("tree", "block").applyInPandas(work, _NODES)


def _up(nodes: DataFrame, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes and all levels of superblock nodes above them, and the root of each tree (``tree, root``)."""
    found = [nodes]
    while True:
        above = stage(_reduced(found[-1], bits), "superblocks")
        largest = above.agg(F.max("size")).first()[0]
        if largest is None or largest <= 1:
            return found, above.select("tree", F.col("node").alias("root"))
        found.append(above)


def _no_rows(*names: str) -> pd.DataFrame:
    return pd.DataFrame({name: pd.Series([], dtype=object) for name in names})


def _down(found: list[DataFrame], outer: DataFrame, bits: int) -> DataFrame:
    """Siblings outside each superblock of the lowest level, from those outside whole trees."""

    def work(key: tuple, block: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        if block.empty:
            return _no_rows("tree", "block", "path", "subroot")
        block = block.sort_values("pos")
        local = levels(block["node"].tolist(), int(block["size"].iloc[0]), bits)
        rest, subroot = list(around["path"].iloc[0]), around["subroot"].iloc[0]
        paths = [steps(local, at) + rest for at in range(len(block))]
        return pd.DataFrame({"tree": key[0], "block": block["pos"].to_numpy(), "path": paths, "subroot": subroot})

    for nodes in reversed(found[1:]):
        outer = _blocked(nodes, bits).groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(work, _OUTER)
    return outer


def _proved(nodes: DataFrame, outer: DataFrame, root: str, bits: int) -> DataFrame:
    def work(key: tuple, block: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        if block.empty:
            return _no_rows("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
        block = block.sort_values("pos")
        found = levels(block["node"].tolist(), int(block["size"].iloc[0]), bits)
        rest, subroot = list(around["path"].iloc[0]), around["subroot"].iloc[0]
        above: dict[str, str] = {}
        proofs, folded = [], []
        for at, (leaf, changed) in enumerate(zip(block["node"], block["tampered"])):
            path = steps(found, at)
            proofs.append(proof(path + rest))
            top = fold(changed or leaf, path)
            if top not in above:
                above[top] = fold(top, rest)
            folded.append(above[top])
        verified = [f == root for f in folded]
        return pd.DataFrame(
            {"key": block["key"].to_numpy(), "leaf": block["node"].to_numpy(), "subroot": subroot, "root": root,
             "proof_sha256": proofs, "folded_root": folded, "verified": verified}
        )

    kind = nodes.schema["key"].dataType.simpleString()
    out = "key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    # Keys travel as text: pandas would hold nullable whole numbers as doubles.
    texts = _blocked(nodes.withColumn("key", F.col("key").cast("string")), bits)
    proved = texts.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(work, out)
    return proved.withColumn("key", F.col("key").cast(kind))


def manifest(documents: DataFrame, bits: int = BITS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of each row.

    A null field is a dash in the leaf; null languages form the first tree. Leaves of a
    tree stand by ``doc_id``, nulls first; rows with one ``doc_id`` by their leaf, equal
    rows beside each other, each with its own place and proof. A tree of one leaf is that
    leaf; the siblings of a lone row are none, so its proof is the digest of nothing. A
    row with a null key or null ``n_chars`` is not tampered with. Texts of any length are
    hashed where they are read. An empty table gives no rows. Other columns are not read.
    """
    nodes = stage(ranked(leaves(documents), "key", "node"), "leaves")
    found, roots = _up(nodes, bits)
    tops = roots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("node"))
    trees = stage(ranked(tops, "key"), "trees")
    above, whole = _up(trees, bits)
    top = whole.first()
    root = top["root"] if top else ""

    # The siblings of each tree among the trees, then of each superblock in its tree.
    spark = documents.sparkSession
    outer = _down(above, spark.range(1).selectExpr("'' AS tree", "0L AS block", "CAST(array() AS array<string>) AS path", "'' AS subroot"), bits)

    def of_trees(key: tuple, block: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        if block.empty:
            return _no_rows("tree", "block", "path", "subroot")
        block = block.sort_values("pos")
        local = levels(block["node"].tolist(), int(block["size"].iloc[0]), bits)
        rest = list(around["path"].iloc[0])
        paths = [steps(local, at) + rest for at in range(len(block))]
        return pd.DataFrame({"tree": block["key"].to_numpy(), "block": 0, "path": paths, "subroot": block["node"].to_numpy()})

    outer = _blocked(trees, bits).groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(of_trees, _OUTER)
    outer = _down(found, outer, bits)
    return _proved(nodes, outer, root, bits).withColumnRenamed("key", "doc_id")
