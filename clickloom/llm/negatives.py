"""Hard negatives by scores bounded along spanning trees of the anchors.

Anchors are grouped by nearest reference anchor into blocks of ``BLOCK``, and each block is
laid out as a minimum spanning tree by distance.  Rows are scored against the root of a tree;
for every other anchor the score of a row lies within edge length times the row's norm of
its parent's score (or of the bounds on that).  Only rows of which the bounds overlap the
anchor's window are scored again: for positives the scores from the fifth best so far, for
negatives those between the window's ends and from the tenth best so far.  The best so far
begin with what the anchors of the block give each other.  Bounds only ever leave out what
cannot be in the answer, so results are exact.

Rows are read in place, with a broadcast of at most ``PASS_BYTES`` of anchors; more anchors
take more passes, two reads each.  A task returns its best few rows for each anchor.

Scores are exact integers; beyond the range of a long they stand for its ends.  Rows with a
null id, label or vector, with null or non-finite components (also after scaling), or with
vectors of another than the most frequent length take no part.  Rows that repeat an id
count once, with their smallest label and vector.  An empty table, or one without anchors, gives an
empty table.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.llm.common import written

BLOCK, SLICE = 1024, 2048
PASS_BYTES = 64 << 20
MOST_CELLS = 256
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def prepared(rows: DataFrame, key: str, label: Column, vector: str, scale: float) -> DataFrame:
    """(id, label, vec) of the rows that take part, whole numbers packed as doubles."""
    sizes = rows.where(F.size(vector) > 0).groupBy(F.size(vector).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    often = sizes.orderBy(F.desc("rows"), "n").first()
    width = often.n if often else 0

    def run(batches):
        for b in batches:
            x = b.column("v").flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width or 1)
            with np.errstate(all="ignore"):
                x = np.floor(x * scale)
            good = np.isfinite(x).all(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id").filter(pa.array(good)),
                    b.column("label").filter(pa.array(good)),
                    pa.array([v.tobytes() for v in x[good]], pa.binary()),
                ],
                names=["id", "label", "vec"],
            )

    named = rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("v"))
    named = named.where(f"id is not null and label is not null and size(v) = {width}")
    ready = written(named.mapInArrow(run, "id long, label long, vec binary"), "scaled")
    twice = ready.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    once = ready.join(twice, "id", "left_anti")
    first = ready.join(twice, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "vec")).alias("f"))
    return written(once.unionByName(first.select("id", "f.label", "f.vec")), "ready")


def _matrix(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def _tree(x: np.ndarray) -> tuple[list[int], list[int], list[float]]:
    """A minimum spanning tree by Prim: places in order of entry, the parent's position in
    that order, and the edge's length.  It starts near the middle."""
    squares = np.einsum("ij,ij->i", x, x)
    start = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    order, parent, edge = [start], [-1], [0.0]
    near = np.maximum(squares + squares[start] - 2 * (x @ x[start]), 0)
    via = np.zeros(len(x), int)
    out = np.zeros(len(x), bool)
    out[start] = True
    for at in range(1, len(x)):
        k = int(np.argmin(np.where(out, np.inf, near)))
        order.append(k)
        parent.append(int(via[k]))
        edge.append(float(np.linalg.norm(x[k] - x[order[via[k]]])))
        out[k] = True
        own = np.maximum(squares + squares[k] - 2 * (x @ x[k]), 0)
        closer = own < near
        near[closer], via[closer] = own[closer], at
    return order, parent, edge


def laid_out(anchors: DataFrame, n: int) -> DataFrame:
    """(block, at, parent, edge, id, label, vec) of each anchor in its tree."""
    wanted = int(min(MOST_CELLS, -(-2 * n // BLOCK)))
    drawn = anchors.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()
    references = anchors.sparkSession.sparkContext.broadcast(_matrix([r.vec for r in drawn]))

    def nearest(batches):
        r = references.value
        for b in batches:
            x = _matrix(b.column("vec").to_pylist()) if b.num_rows else np.zeros((0, r.shape[1]))
            cell = np.argmin((r * r).sum(axis=1)[None, :] - 2 * (x @ r.T), axis=1)
            yield b.append_column("cell", pa.array(cell, pa.int32()))

    def tree(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        order, parent, edge = _tree(_matrix(table.column("vec").to_pylist()))
        table = table.take(pa.array(order))
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64())
        made = (table.column("block"), np.arange(len(order)), parent, edge)
        columns = [made[0], *[pa.array(c, t) for c, t in zip(made[1:], kinds[1:])], *[table.column(c) for c in ("id", "label", "vec")]]
        return pa.table(columns, names=["block", "at", "parent", "edge", "id", "label", "vec"])

    placed = written(anchors.mapInArrow(nearest, "id long, label long, vec binary, cell int"), "cells")
    parts = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))  # MOST_CELLS rows at most
    cut = placed.join(F.broadcast(parts), "cell")
    block = F.pmod(F.xxhash64("id"), F.col("parts")) * MOST_CELLS + F.col("cell")
    schema = "block long, at int, parent int, edge double, id long, label long, vec binary"
    return written(cut.select("id", "label", "vec", block.alias("block")).groupBy("block").applyInArrow(tree, schema), "trees")


@dataclass
class _Node:
    id: int
    label: int
    vec: np.ndarray
    parent: int  # position in its tree, -1 at the root
    edge: float
    last: int  # position of its last child
    windows: list[list[float]]  # lowest and highest score wanted, narrowed as rows are found


class _Best:
    """The first ``k`` by falling score, then rising id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> bool:
        """Whether there are ``k`` by now."""
        if len(scores) > self.k:  # none below the k-th score can stay
            kth = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[scores >= kth], ids[scores >= kth]
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, ~scores))[: self.k]  # ~ turns the order round without overflow
        self.scores, self.ids = scores[order], ids[order]
        return len(order) == self.k


def _scores(x: np.ndarray, a: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as longs.  Sums of whole numbers below 2**53 are exact in doubles."""
    if exact:
        return (x @ a).astype(np.int64)
    whole = [int(v) for v in a]
    found = (sum(int(p) * q for p, q in zip(row, whole)) for row in x)
    return np.array([min(max(s, LOWEST), HIGHEST) for s in found], np.int64)


class _Search:
    """Rows against trees of anchors; ``same`` looks for rows of the anchor's label."""

    def __init__(self, trees: list[list[_Node]], k: int, same: bool, exact: bool):
        self.trees, self.k, self.same, self.exact = trees, k, same, exact
        self.clear()

    def clear(self) -> None:
        """Forget the rows found, but not how far they have narrowed the windows."""
        self.best = [[[_Best(self.k) for _ in n.windows] for n in t] for t in self.trees]

    def rows(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        for at in range(0, len(ids), SLICE):
            part = slice(at, at + SLICE)
            norms = np.sqrt((x[part] ** 2).sum(axis=1)) * (1 + 1e-9)
            for t in range(len(self.trees)):
                self.tree(t, x[part], norms, ids[part], labels[part])

    def tree(self, t: int, x: np.ndarray, norms: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for at, node in enumerate(self.trees[t]):
            if node.parent < 0:
                low = high = None
            else:
                parent_low, parent_high = bounds[node.parent]
                off = node.edge * norms + 1e-9 * np.maximum(np.abs(parent_low), np.abs(parent_high))
                low, high = parent_low - off, parent_high + off
                if self.trees[t][node.parent].last == at:
                    del bounds[node.parent]
            kind = (labels == node.label) & (ids != node.id) if self.same else labels != node.label
            if node.windows and low is not None:
                kind &= (high >= min(w[0] for w in node.windows)) & (low <= max(w[1] for w in node.windows))
            wanted = np.nonzero(kind)[0] if node.windows else np.empty(0, int)
            if low is None or 2 * len(wanted) > len(ids):
                every = _scores(x, node.vec, self.exact)
                low = high = every.astype(np.float64)
                scores = every[wanted]
            else:
                scores = _scores(x[wanted], node.vec, self.exact)
                low[wanted] = high[wanted] = scores
            if node.last >= 0:
                bounds[at] = low, high
            if len(wanted):
                for w, best in zip(node.windows, self.best[t][at]):
                    inside = (scores >= w[0]) & (scores <= w[1])
                    if inside.any() and best.add(scores[inside], ids[wanted[inside]]):
                        w[0] = max(w[0], int(best.scores[-1]))

    def found(self) -> Iterator[tuple[int, int, int, int]]:
        """(anchor, window, id, score)"""
        for t, of in zip(self.trees, self.best):
            for node, windows in zip(t, of):
                for j, best in enumerate(windows):
                    for i, s in zip(best.ids.tolist(), best.scores.tolist()):
                        yield node.id, j, i, s


def _scan(ready: DataFrame, trees: list[list[_Node]], k: int, same: bool, exact: bool, name: str) -> DataFrame:
    """(anchor, window, id, score): the best ``k`` of each window."""
    begun = _Search(trees, k, same, exact)
    for t, nodes in enumerate(trees):
        x = np.stack([n.vec for n in nodes])
        norms = np.sqrt((x**2).sum(axis=1)) * (1 + 1e-9)
        begun.tree(t, x, norms, np.array([n.id for n in nodes]), np.array([n.label for n in nodes]))
    shared = ready.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        import copy

        search = _Search(copy.deepcopy(shared.value), k, same, exact)
        for b in batches:
            if b.num_rows:
                ids, labels = (b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
                search.rows(_matrix(b.column("vec").to_pylist()), ids, labels)
        held = list(search.found())
        for at in range(0, len(held), 50_000):
            columns = zip(*held[at : at + 50_000])
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=["anchor", "window", "id", "score"]
            )

    tasks = 4 * ready.sparkSession.sparkContext.defaultParallelism
    every = ready.coalesce(tasks).mapInArrow(run, "anchor long, window int, id long, score long")
    place = F.row_number().over(W.partitionBy("anchor", "window").orderBy(F.desc("score"), "id"))
    return written(every.withColumn("rank", place).where(F.col("rank") <= k), name)


def _window(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def mine(
    rows: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    label: Column | str = "label",
    vector: str = "embedding",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` is a condition on ``id``.  Scores are inner products of ``floor(scale * x)``; a
    negative's lies between ``low`` and ``high`` hundredths of the positive's."""
    spark = rows.sparkSession
    ready = prepared(rows, key, F.col(label) if isinstance(label, str) else label, vector, scale)
    empty = spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    anchors = ready.where(anchor)
    n = anchors.count()
    if not n:
        return empty

    def squares(batches):
        for b in batches:
            most = float((_matrix(b.column("vec").to_pylist()) ** 2).sum(axis=1).max()) if b.num_rows else 0.0
            yield pa.RecordBatch.from_arrays([pa.array([most])], names=["most"])

    largest = ready.select("vec").mapInArrow(squares, "most double").agg(F.max("most")).first()[0]
    exact = largest < 2**53  # no inner product, nor any part of its sum, is larger
    trees = laid_out(anchors, n)
    width = len(trees.select("vec").first().vec)
    room, passes, filled = max(BLOCK, PASS_BYTES // width), [[]], 0
    for r in trees.groupBy("block").agg(F.count(F.lit(1)).alias("n")).orderBy("block").toLocalIterator():
        if filled + r.n > room and passes[-1]:
            passes.append([])
            filled = 0
        passes[-1].append(r.block)
        filled += r.n

    out = empty
    for blocks in passes:
        here = trees.where(F.col("block").between(blocks[0], blocks[-1])).orderBy("block", "at").collect()
        laid: dict[int, list[_Node]] = {}
        for r in here:
            laid.setdefault(r.block, []).append(
                _Node(r.id, r.label, np.frombuffer(r.vec, np.float64), r.parent, r.edge, -1, [[LOWEST, HIGHEST]])
            )
            if r.parent >= 0:
                laid[r.block][r.parent].last = r.at
        nodes = list(laid.values())
        good = _scan(ready, nodes, positives, True, exact, "positives").select(
            "anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        told: dict[int, set[int]] = {}  # at most ``positives`` for each anchor of the pass
        for r in good.select("anchor", "positive_score").distinct().collect():
            told.setdefault(r.anchor, set()).add(r.positive_score)
        limits = []
        for t in nodes:
            for node in t:
                of = [(s, *_window(s, low, high)) for s in sorted(told.get(node.id, ()))]
                of = [w for w in of if w[1] <= w[2]]
                node.windows = [[a, b] for _, a, b in of]
                limits += [(node.id, j, s) for j, (s, _, _) in enumerate(of)]
        if not limits:
            continue
        bad = _scan(ready, nodes, negatives, False, exact, "negatives")
        named = spark.createDataFrame(limits, "anchor long, window int, positive_score long")
        met = bad.join(named, ["anchor", "window"]).join(good, ["anchor", "positive_score"])
        out = out.union(
            met.select(
                F.col("anchor").alias("anchor_id"),
                "positive_id",
                F.col("rank").cast("int").alias("rank"),
                F.col("id").alias("negative_id"),
                "positive_score",
                F.col("score").alias("negative_score"),
            )
        )
    return out
