"""Shards of equal bytes by a k-d tree over the documents' metadata.

Each dimension is scaled to whole numbers from 0 to 2**30.  A node of k shards is split
at the weighted k//2 : k - k//2 quantile of its widest dimension, until each leaf is one
shard.  Rows weigh their bytes.  All nodes of a level are split together: a pass takes
their extents, and passes of ``BINS`` bins each narrow the cuts down until the rows
between two bins weigh next to nothing.  Rows equal in a dimension are told apart by a
hash, so a cut can go through any group of equals; a shard is off its size by at most
``slack`` of it per level, or by one row.

What reaches the driver is one number for each bin of a node, and the tree has as many
cuts as shards.  Slots are counted in pieces of a shard, so no task numbers a whole one.

Null texts weigh ``OVERHEAD`` bytes, null metadata counts as the smallest value.  Rows
equal in all columns are spread like others.  An empty table gives an empty table.  Other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.common import written

OVERHEAD, BINS, GRID, TIES = 16, 4096, 30, 30
PIECE_ROWS = 1_000_000


@dataclass
class _Node:
    shards: int
    first: int  # number of its first shard


def _measured(docs: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return written(
        docs.select(
            "doc_id",
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64("text").alias("place"),
            *[c.cast("double").alias(f"_d{i}") for i, c in enumerate(dimensions.values())],
        ).withColumn("_row", F.monotonically_increasing_id()),
        "measured",
    )


def default_dimensions() -> dict[str, Column]:
    return {
        "doc_id": F.col("doc_id"),
        "bytes": F.log2(F.octet_length(F.coalesce("text", F.lit(""))) + OVERHEAD),
        "source": F.crc32(F.coalesce("source", F.lit("")).cast("binary")),
        "lang": F.crc32(F.coalesce("lang", F.lit("")).cast("binary")),
    }


def sharded(
    docs: DataFrame, shards: int = 40, dimensions: dict[str, Column] | None = None, slack: float = 0.0005
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of each row."""
    dimensions = dimensions or default_dimensions()
    dims = range(len(dimensions))
    rows = _measured(docs, dimensions)
    ends = rows.agg(
        F.count("*").alias("n"),
        F.sum("size").alias("bytes"),
        *[f(F.nanvl(f"_d{i}", F.lit(None))).alias(f"{k}{i}") for i in dims for k, f in (("lo", F.min), ("hi", F.max))],
    ).first()
    for i in dims:
        lo, hi = ends[f"lo{i}"] or 0.0, ends[f"hi{i}"] or 0.0
        unit = (2**GRID - 1) / (hi - lo) if hi > lo else 0.0
        at = F.floor((F.nanvl(f"_d{i}", F.lit(lo)) - lo) * unit)
        rows = rows.withColumn(f"_d{i}", F.coalesce(F.greatest(F.lit(0), F.least(at, F.lit(2**GRID - 1))), F.lit(0)).cast("long"))
    # Ties: by content, and only among repeated rows by where they were read.
    tie = F.xxhash64("doc_id", "place").bitwiseAND(F.lit(2**20 - 1)) * F.lit(1 << 10)
    rows = rows.withColumn("_tie", tie + F.xxhash64("_row").bitwiseAND(F.lit(2**10 - 1)))
    rows = rows.withColumn("_dims", F.array(*[f"_d{i}" for i in dims]))
    nodes, cuts = {0: _Node(shards, 0)}, {}
    target = (ends["bytes"] or 0) / shards
    while ends["n"] and any(n.shards > 1 for n in nodes.values()):
        parting = {k for k, n in nodes.items() if n.shards > 1}
        cuts |= _level(rows.withColumn("_node", _node(cuts)), {k: nodes[k] for k in parting}, len(dimensions), slack * target)
        nodes = _children(nodes, parting)
    first = _cases(_node(cuts), {k: n.first for k, n in nodes.items()})
    placed = rows.select("doc_id", "size", "text_crc32", first.alias("shard"), "_row", "place")
    return _slotted(placed, ends["n"])


def _cases(key: Column, values: dict[int, int]) -> Column:
    """A look-up in a map as small as the tree; null where it has no entry."""
    if not values:
        return F.lit(None).cast("long")
    pairs = [F.lit(x).cast(t) for k, v in sorted(values.items()) for x, t in ((k, "int"), (v, "long"))]
    return F.try_element_at(F.create_map(*pairs), key)


def _key(dim: Column) -> Column:
    return F.get("_dims", dim) * F.lit(1 << TIES) + F.col("_tie")


def _node(cuts: dict[int, tuple[int, int]]) -> Column:
    """The node of a row below the ``cuts`` (dimension, key) of the nodes above: 2n + 1 to
    the left of node n, 2n + 2 to the right.  One step for each level of the tree."""
    if not cuts:
        return F.lit(0)
    depth = (max(cuts) + 1).bit_length()
    dim = {k: d for k, (d, _) in cuts.items()}
    cut = {k: c for k, (_, c) in cuts.items()}
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(depth)),
        F.lit(0),
        lambda node, _: F.when(_cases(node, cut).isNull(), node)
        .when(_key(_cases(node, dim).cast("int")) < _cases(node, cut), 2 * node + 1)
        .otherwise(2 * node + 2),
    )


def _level(rows: DataFrame, parting: dict[int, _Node], dims: int, enough: float) -> dict[int, tuple[int, int]]:
    """Dimension and cut of each node in ``parting``; of an empty node, any."""
    open_ = rows.where(F.col("_node").isin(*parting))
    extents = {
        r["_node"]: r
        for r in open_.groupBy("_node")
        .agg(
            F.sum("size").alias("bytes"),
            *[f(f"_d{i}").alias(f"{k}{i}") for i in range(dims) for k, f in (("lo", F.min), ("hi", F.max))],
        )
        .collect()
    }
    widest = {k: max(range(dims), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"], -i)) for k, r in extents.items()}
    # Of each node: bytes wanted to the left, the range that holds the cut, bytes below it.
    want = {k: r["bytes"] * (parting[k].shards // 2) / parting[k].shards for k, r in extents.items()}
    low = {k: r[f"lo{widest[k]}"] << TIES for k, r in extents.items()}
    high = {k: (r[f"hi{widest[k]}"] + 1) << TIES for k, r in extents.items()}
    below = dict.fromkeys(extents, 0)
    cut: dict[int, int] = {}
    node = F.col("_node")
    keyed = open_.select("_node", "size", _key(_cases(node, widest).cast("int")).alias("_key"))
    while len(cut) < len(extents):
        todo = [k for k in extents if k not in cut]
        width = {k: -(-(high[k] - low[k]) // BINS) for k in todo}
        lo, hi, w = (_cases(node, {k: v[k] for k in todo}) for v in (low, high, width))
        part = keyed.where(node.isin(*todo) & (F.col("_key") >= lo) & (F.col("_key") < hi))
        bin_ = F.expr("(_key - _lo) div _width")
        bins = part.withColumn("_lo", lo).withColumn("_width", w).groupBy("_node", bin_.alias("bin"))
        got = {}
        for r in bins.agg(F.sum("size").alias("bytes")).collect():
            got.setdefault(r["_node"], []).append((r["bin"], r["bytes"]))
        for k in todo:
            total, b, size = below[k], 0, 0
            for b, size in sorted(got.get(k, [])):
                if total + size >= want[k]:
                    break
                total += size
            edge = low[k] + b * width[k]
            if size <= enough or width[k] == 1:
                cut[k] = edge + width[k] if total + size - want[k] < want[k] - total else edge
            else:
                low[k], high[k], below[k] = edge, min(edge + width[k], high[k]), total
    return {k: (widest.get(k, 0), cut.get(k, 0)) for k in parting}


def _children(nodes: dict[int, _Node], parting: set[int]) -> dict[int, _Node]:
    out = {}
    for k, n in nodes.items():
        if k in parting:
            out[2 * k + 1] = _Node(n.shards // 2, n.first)
            out[2 * k + 2] = _Node(n.shards - n.shards // 2, n.first + n.shards // 2)
        else:
            out[k] = n
    return out


def _slotted(placed: DataFrame, n: int) -> DataFrame:
    """Add ``slot``, from 0 without gaps in each shard."""
    pieces = max(1, n // PIECE_ROWS)
    rows = written(placed.withColumn("_piece", F.pmod(F.xxhash64("_row"), F.lit(pieces)).cast("int")), "placed")
    before = W.partitionBy("shard").orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "_piece")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    number = F.row_number().over(W.partitionBy("shard", "_piece").orderBy("doc_id", "place", "_row"))
    return (
        rows.withColumn("_number", number)
        .join(starts, ["shard", "_piece"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("_start") + F.col("_number") - 1).alias("slot"))
    )


def digest(placed: DataFrame) -> DataFrame:
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
