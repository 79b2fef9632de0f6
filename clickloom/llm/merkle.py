"""Merkle manifest of a table: one tree for each group, and a tree over the groups.

A row's place in its tree is the rank of its id among the ids of its group.  It comes from
bitmaps, not from sorting rows: the ids of a group are or-ed into words of 64 bits (partial
words per task, merged by key), words stand in containers, and a directory
holds the running population count of containers and words.  A rank is the directory's
count plus the bits below the id's own in its word.  Only words that hold an id are
stored.  Slots with the same ``slot div ARITY**DEPTH`` then meet in one keyed slot array,
which climbs ``DEPTH`` levels at once; its root is one slot of the next array, until each
tree has one node.  Sibling paths travel the other way, one for each array and not for each
row, so a group of any size is spread over tasks and no row is shuffled once per level.

Digests are lowercase hex sha256.  A leaf hashes its columns as ``byte count:value``, or
``-`` for null; an inner node hashes the hex digests of up to three children.

Rows without group form a group of their own, the first; rows without id come first in
their group.  Rows that share an id are ordered by their digest, equal rows take
neighbouring slots.  Empty and very long texts are hashed like others.  An empty table gives
no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.common import released, written
from clickloom.operators.ordered import position_in_chunks

ARITY, DEPTH = 3, 6
WIDTH = ARITY**DEPTH  # slots of an array
CONTAINER = 9  # a container has 2**9 words
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass
class Forest:
    """Arrays of each tier, the lowest first, and the top node of each tree."""

    tiers: list[DataFrame] = field(default_factory=list)  # tree, block, height, slots
    tops: DataFrame | None = None  # tree, node


@dataclass
class Manifest:
    rows: Forest  # a tree for each group
    groups: Forest  # the tree over the groups; one tree named ""
    order: DataFrame  # tree, slot of a group in the upper tree


def digest(parts: Sequence[Column]) -> Column:
    """Of the values, each as ``byte count:value`` or ``-``."""
    texts = [p.cast("string") for p in parts]
    named = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*named), 256)


def entries(
    rows: DataFrame, group: str, key: str, columns: Sequence[str], claims: Mapping[str, Column]
) -> DataFrame:
    """(tree, id, leaf, claimed, copies): different rows with their digest and the digest
    of what is claimed to be the row, null where that is the row itself."""
    own = [F.col(c) for c in columns]
    other = [claims.get(c, F.col(c)) for c in columns]
    same = F.lit(True)
    for c, value in claims.items():
        same = same & value.eqNullSafe(F.col(c))
    tree = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("-"))
    named = rows.select(
        tree.alias("tree"),
        F.col(key).cast("long").alias("id"),
        digest(own).alias("leaf"),
        F.when(~same, digest(other)).alias("claimed"),
    )
    return written(
        named.groupBy("tree", "id", "leaf", "claimed")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("word", F.shiftright("id", 6)),
        "entries",
    )


def directory(of: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, word, bits, many, before) for each word of a group's bitmap, and the size
    of each tree.  ``many`` lists the bits that stand for more than one row, ``before`` counts
    the rows of earlier words."""
    at = F.expr("cast(id & 63 as int)")
    ids = of.groupBy("tree", "word", "id").agg(F.sum("copies").alias("n"))
    words = written(
        ids.groupBy("tree", "word").agg(
            F.expr("bit_or(shiftleft(1L, cast(id & 63 as int)))").alias("bits"),
            F.sum("n").alias("n"),
            F.collect_list(F.when(F.col("n") > 1, F.struct(at.alias("at"), (F.col("n") - 1).alias("more")))).alias("many"),
        ).withColumn("container", F.shiftright("word", CONTAINER)),
        "words",
    )
    containers = written(words.groupBy("tree", "container").agg(F.sum("n").alias("n")), "containers")
    sizes = containers.groupBy("tree").agg(F.sum("n").alias("n"))
    bases = position_in_chunks(containers, ["tree"], ["container"], "end", "n")
    bases = bases.select("tree", "container", (F.col("end") - F.col("n")).alias("base"))
    inside = W.partitionBy("tree", "container").orderBy("word").rowsBetween(W.unboundedPreceding, W.currentRow)
    near = words.withColumn("before", F.sum("n").over(inside) - F.col("n"))
    here = (near.tree == bases.tree) & near.container.eqNullSafe(bases.container)
    found = near.join(bases, here).select(
        near.tree, "word", "bits", "many", near.n, (F.col("before") + F.col("base")).alias("before")
    )
    return found, sizes


def slots(of: DataFrame, words: DataFrame) -> DataFrame:
    """``of`` with the slot of each row, copies written out."""
    at = F.expr("cast(id & 63 as int)")
    words = words.withColumnsRenamed({"tree": "_tree", "word": "_word"})
    met = of.join(words, (F.col("tree") == F.col("_tree")) & F.col("word").eqNullSafe(F.col("_word")))
    below = F.bit_count(F.expr("bits & ~shiftleft(-1L, cast(id & 63 as int))"))
    more_below = F.aggregate(F.filter("many", lambda m: m["at"] < at), F.lit(0).cast("long"), lambda a, m: a + m["more"])
    own = F.aggregate(F.filter("many", lambda m: m["at"] == at), F.lit(1).cast("long"), lambda a, m: a + m["more"])
    ranked = written(
        met.select(
            *of.columns,
            F.when(F.col("id").isNull(), F.col("before")).otherwise(F.col("before") + below + more_below).alias("slot"),
            (F.col("copies") < F.when(F.col("id").isNull(), F.col("n")).otherwise(own)).alias("tied"),
        ),
        "ranked",
    )
    shared = ranked.where("tied").withColumn("_c", F.coalesce("claimed", F.lit("")))
    after = position_in_chunks(shared, ["tree", "id"], ["leaf", "_c"], "end", "copies")
    after = after.withColumn("slot", F.col("slot") + F.col("end") - F.col("copies"))
    both = ranked.where("not tied").unionByName(after.select(ranked.columns))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    return both.select("*", copy).select(
        "tree", (F.col("slot") + F.col("copy")).alias("slot"), F.col("leaf").alias("node"), "id", "claimed"
    )


def _levels(nodes: list[str], height: int) -> list[list[str]]:
    out = [nodes]
    for _ in range(height):
        under = out[-1]
        out.append(
            [hashlib.sha256("".join(under[i : i + ARITY]).encode()).hexdigest() for i in range(0, len(under), ARITY)]
        )
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.StructArray]]:
    """The plain columns of each row, and its slots; one array at a time is in Python."""
    for b in batches:
        plain = [n for n in b.schema.names if n != "slots"]
        for i in range(b.num_rows):
            yield {n: b.column(n)[i].as_py() for n in plain}, b.column("slots")[i].values


def _sent(rows: Iterator[tuple], names: Sequence[str], types: Sequence[pa.DataType], most: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=list(names))

    for r in rows:
        held.append(r)
        if len(held) == most:
            yield batch()
            held = []
    if held:
        yield batch()


def climb(nodes: DataFrame, sizes: DataFrame) -> Forest:
    """Trees over ``nodes`` (tree, slot, node, …) with ``sizes`` (tree, n)."""

    def roots(batches):
        def found():
            for r, s in _rows(batches):
                yield r["tree"], r["block"], _levels(s.field("node").to_pylist(), r["height"])[-1][0]

        return _sent(found(), ("tree", "slot", "node"), (pa.string(), pa.int64(), pa.string()), 10_000)

    # The smallest height of which the power reaches n.
    height = F.expr(f"size(filter(sequence(0, 39), i -> pow({ARITY}, i) < n))")
    heights = written(sizes.select("tree", height.alias("height")), "heights")
    tallest = heights.agg(F.max("height")).first()[0] or 0
    out, tier = Forest(), 0
    while True:
        extra = [c for c in nodes.columns if c not in ("tree", "slot", "node")]
        arrays = nodes.groupBy("tree", F.expr(f"slot div {WIDTH}").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("slot", "node", *extra))).alias("slots")
        )
        left = F.greatest(F.lit(0), F.least(F.lit(DEPTH), F.col("height") - tier * DEPTH))
        arrays = written(arrays.join(heights, "tree").select("tree", "block", left.alias("height"), "slots"), "arrays")
        out.tiers.append(arrays)
        nodes = written(arrays.mapInArrow(roots, "tree string, slot long, node string"), "nodes")
        tier += 1
        if tallest <= tier * DEPTH:
            out.tops = nodes.select("tree", "node")
            return out


def manifest(
    rows: DataFrame,
    group: str = "source",
    key: str = "doc_id",
    columns: Sequence[str] = COLUMNS,
    claims: Mapping[str, Column] | None = None,
) -> Manifest:
    """The trees of ``rows``.  ``claims`` replaces columns by what someone says they are."""
    of = entries(rows, group, key, columns, claims or {})
    words, sizes = directory(of)
    forest = climb(slots(of, words), sizes)
    one = forest.tops.withColumn("all", F.lit(""))
    order = position_in_chunks(one, ["all"], ["tree"], "slot")
    order = written(order.select("tree", (F.col("slot") - 1).alias("slot"), "node"), "order")
    upper = order.select(F.lit("").alias("tree"), "slot", "node")
    released(of)
    return Manifest(forest, climb(upper, upper.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))), order)


def _step(levels: list[list[str]], i: int) -> Iterator[tuple[int, str]]:
    """The own position in its run and the siblings' digests, upwards from node ``i``."""
    for level in levels[:-1]:
        first = i - i % ARITY
        run = level[first : first + ARITY]
        yield i - first, "".join(run[: i - first] + run[i - first + 1 :])
        i //= ARITY


def _written_path(steps: Iterator[tuple[int, str]]) -> str:
    return "".join(f"{at}{len(others) // 64}{others}" for at, others in steps)


def _read_path(path: str) -> Iterator[tuple[int, str]]:
    i = 0
    while i < len(path):
        n = 64 * int(path[i + 1])
        yield int(path[i]), path[i + 2 : i + 2 + n]
        i += 2 + n


def paths(forest: Forest, above: DataFrame, down_to: int = 0) -> DataFrame:
    """(tree, slot, path) of the nodes under tier ``down_to``; ``above`` has (tree, path) of
    each tree's top."""

    def below(batches):
        def found():
            for r, s in _rows(batches):
                levels = _levels(s.field("node").to_pylist(), r["height"])
                for i, slot in enumerate(s.field("slot").to_pylist()):
                    yield r["tree"], slot, _written_path(_step(levels, i)) + r["path"]

        return _sent(found(), ("tree", "slot", "path"), (pa.string(), pa.int64(), pa.string()), 1000)

    known = above.select("tree", F.lit(0).cast("long").alias("block"), "path")
    for arrays in reversed(forest.tiers[down_to:]):
        met = arrays.join(known, ["tree", "block"])
        known = written(met.mapInArrow(below, "tree string, slot long, path string"), "paths")
        known = known.withColumnRenamed("slot", "block")
    return known.withColumnRenamed("block", "slot")


def proofs(m: Manifest) -> DataFrame:
    """A row for each row of the table: id, leaf, subroot, root, proof_sha256 (of the
    siblings up to the root) and folded_root (what the claimed leaf and the siblings give)."""
    spark = m.order.sparkSession
    start = spark.range(1).select(F.lit("").alias("tree"), F.lit("").alias("path"))
    upper = paths(m.groups, start).select("slot", "path")
    above = m.order.join(upper, "slot").select("tree", "path", F.col("node").alias("subroot"))
    root = m.groups.tops.first()
    arrays = m.rows.tiers[0]
    # One path for each array of the lowest tier: of its own root upwards.
    top = above.select("tree", "path")
    if len(m.rows.tiers) > 1:
        own = paths(m.rows, top, down_to=1).select("tree", F.col("slot").alias("block"), "path")
    else:
        own = top.select("tree", F.lit(0).cast("long").alias("block"), "path")

    names = ("tree", "slot", "id", "leaf", "proof_sha256", "folded_root")

    def folded(batches):
        def found():
            for r, s in _rows(batches):
                nodes, claimed, ids = (s.field(n).to_pylist() for n in ("node", "claimed", "id"))
                levels, rest = _levels(nodes, r["height"]), list(_read_path(r["path"]))
                for i, slot in enumerate(s.field("slot").to_pylist()):
                    steps = [*_step(levels, i), *rest]
                    node = claimed[i] or nodes[i]
                    for at, others in steps:
                        node = hashlib.sha256((others[: 64 * at] + node + others[64 * at :]).encode()).hexdigest()
                    proof = hashlib.sha256("".join(o for _, o in steps).encode()).hexdigest()
                    yield r["tree"], slot, ids[i], nodes[i], proof, node

        types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        return _sent(found(), names, types, 5000)

    met = arrays.join(own, ["tree", "block"])
    schema = "tree string, slot long, id long, leaf string, proof_sha256 string, folded_root string"
    rows = met.mapInArrow(folded, schema)
    root_text = F.lit(root["node"] if root else None).cast("string")
    return rows.join(above.select("tree", "subroot"), "tree").withColumn("root", root_text)
