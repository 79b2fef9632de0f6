"""Near-duplicate vectors by a pivot-permutation index.

Reference points ("pivots") are vectors of a bounded sample (``SAMPLE`` rows for each pivot,
``MOST_PIVOTS`` pivots at most) that are not near each other, filled up with random
directions.  Each vector is described by its ``NEAREST`` nearest pivots.  Two vectors as
similar as 0.95 share ``SHARED`` of them or more, others seldom do.

1. Balls: rows with the same two nearest pivots, ``PART`` at a time, are searched for balls of
   half the linking angle.  Any two vectors of a ball are linked, so a group of copies, however
   large, is a few items from here on.
2. Inverted lists: each item is entered under the pairs of its pivots.  Of ``NEAREST`` sorted
   pivots the two lowest that are shared are among the first ``NEAREST - SHARED + 2``, so
   no other pairs are needed.  Within a list, items are compared by their count of shared
   pivots, each two only in the list of their two lowest shared ones.
3. Verification: only items with a partner in a list bring their vectors there; cosines are
   taken in double precision.  Items whose balls are partly linked are compared row by row.
   Long lists are cut into blocks of ``PART`` against ``PART`` rows.  Tasks return counts and
   the edges of a spanning forest, never pairs.
4. Components of the edges give ``component_id``.

What is found is exact; recall of the candidates is measured in the tests and in README.

Null vectors, vectors with null or non-finite components, zero vectors and vectors of
another than the most frequent length link with nothing.  Each row counts as a vector of
its own, also where an id or a whole row is repeated.  A component without any id has a null
``component_id``; ``kept`` is true then for each of its rows.  An empty table gives an empty
table.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import released, written
from clickloom.llm.minhash import components

NEAREST, SHARED = 10, 4
MOST_PIVOTS, SAMPLE = 4096, 4
PART, SMALLEST_BALL = 4096, 16
#: Angles nearer than this to a limit are settled by the cosines themselves.
MARGIN = 1e-9


def valid_rows(rows: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame, int]:
    """All rows (row, id, usable), unit vectors (row, unit) of the usable ones, and how many those are.

    ``unit`` holds doubles; a row number is given once and written down."""
    sizes = rows.where(F.size(vector) > 0).groupBy(F.size(vector).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    often = sizes.orderBy(F.desc("rows"), "n").first()
    width = often.n if often else 0

    def units(batches):
        for b in batches:
            column = b.column("vector")
            found = [None] * b.num_rows
            lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            at = np.nonzero(lengths == width)[0] if width else np.empty(0, int)
            if len(at):
                flat = column.take(pa.array(at)).flatten().cast(pa.float64())
                x = flat.to_numpy(zero_copy_only=False).reshape(len(at), width)
                with np.errstate(all="ignore"):
                    largest = np.abs(x).max(axis=1)
                    good = np.isfinite(x).all(axis=1) & (largest > 0)  # nulls are NaN by now
                    x = x / largest[:, None]
                    x = x / np.linalg.norm(x, axis=1)[:, None]
                for i in np.nonzero(good)[0]:
                    found[at[i]] = x[i].tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("id"), pa.array(found, pa.binary())], names=["row", "id", "unit"]
            )

    numbered = rows.select(F.col(key).alias("id"), F.col(vector).alias("vector")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    kind = rows.schema[key].dataType.simpleString()
    made = written(numbered.mapInArrow(units, f"row long, id {kind}, unit binary"), "units")
    usable = made.where("unit is not null").select("row", "unit")
    return made.select("row", "id"), usable, usable.count()


def _matrix(column: pa.Array) -> np.ndarray:
    """Packed doubles as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def choose_pivots(units: DataFrame, n: int, seed: int = 7) -> np.ndarray:
    """About 16 pivots for each cube root of rows: lists stay short, descriptions cheap."""
    wanted = int(min(MOST_PIVOTS, max(64, 16 * n ** (1 / 3))))
    drawn = units.orderBy(F.xxhash64("row"), "row").limit(SAMPLE * wanted).collect()
    chosen: list[np.ndarray] = []
    width = len(drawn[0].unit) // 8
    kept = np.zeros((wanted, width))
    for r in drawn:
        x = np.frombuffer(r.unit, np.float64)
        if len(chosen) < wanted and (not chosen or (kept[: len(chosen)] @ x).max() < 0.8):
            kept[len(chosen)] = x
            chosen.append(x)
    others = np.random.default_rng(seed).normal(size=(wanted - len(chosen), width))
    kept[len(chosen) :] = others / np.linalg.norm(others, axis=1)[:, None]
    return kept


def described(units: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(row, unit, nearest, cell): the pivots in ascending number, and the two nearest."""
    shared = units.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, PART):
                part = b.slice(at, PART)
                near = _matrix(part.column("unit")) @ shared.value.T
                top = np.argpartition(-near, NEAREST - 1, axis=1)[:, :NEAREST]
                order = np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable")
                two = np.sort(np.take_along_axis(top, order[:, :2], 1), axis=1)
                rows = np.sort(top, axis=1).astype(np.int16)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("unit"),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                        pa.array(two[:, 0] * MOST_PIVOTS + two[:, 1], pa.int32()),
                    ],
                    names=["row", "unit", "nearest", "cell"],
                )

    return written(units.mapInArrow(run, "row long, unit binary, nearest binary, cell int"), "described")


def _balls(rows: np.ndarray, units: np.ndarray, angle: float) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Members (places), centre and radius of each ball among ``units``."""
    left = np.arange(len(rows))
    while len(left) >= SMALLEST_BALL:
        x = units[left]
        near = x @ x[0] >= np.cos(angle)
        took = np.zeros(len(left), bool)
        if near.sum() >= SMALLEST_BALL:
            centre = x[near].mean(axis=0)
            centre /= np.linalg.norm(centre)
            off = np.arccos(np.clip(x @ centre, -1, 1))
            took = off <= angle / 2 - MARGIN
            if took.sum() >= SMALLEST_BALL:
                yield left[took], centre, float(off[took].max())
            else:
                took[:] = False
        took[0] = True
        left = left[~took]


def find_balls(of: DataFrame, angle: float) -> DataFrame:
    """(row, ball, nearest, centre, radius) of rows in balls; ``ball`` is below zero.  The
    centre stands with one member only."""
    cells = of.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SMALLEST_BALL)
    parts = F.ceil(F.col("n") / PART)
    cut = of.join(cells.select("cell", parts.alias("parts")), "cell")
    cut = cut.withColumn("part", F.pmod(F.xxhash64("row"), "parts")).repartition("cell", "part")

    def run(table: pa.Table) -> pa.Table:
        rows = table.column("row").to_numpy()
        order = np.argsort(rows)
        rows = rows[order]
        table = table.take(pa.array(order))
        units = _matrix(table.column("unit").combine_chunks())
        got: dict[str, list] = {k: [] for k in ("row", "ball", "nearest", "centre", "radius")}
        near = table.column("nearest").to_pylist()
        for members, centre, radius in _balls(rows, units, angle):
            name = -int(rows[members[0]]) - 1
            got["row"] += rows[members].tolist()
            got["ball"] += [name] * len(members)
            got["nearest"] += [near[i] for i in members]
            got["centre"] += [centre.tobytes()] + [None] * (len(members) - 1)
            got["radius"] += [radius] * len(members)
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.float64())
        return pa.table([pa.array(v, t) for v, t in zip(got.values(), kinds)], names=list(got))

    schema = "row long, ball long, nearest binary, centre binary, radius double"
    return written(cut.groupBy("cell", "part").applyInArrow(run, schema), "balls")


def items_of(of: DataFrame, balls: DataFrame) -> DataFrame:
    """(item, pivots, n, radius, unit): single rows outside the balls, and the balls with
    all pivots that a member is near to."""
    alone = of.join(balls.select("row"), "row", "left_anti").select(
        F.col("row").alias("item"), F.col("nearest").alias("pivots"), F.lit(1).cast("long").alias("n"),
        F.lit(0.0).alias("radius"), "unit",
    )

    def split(batches):
        for b in batches:
            x = np.frombuffer(b"".join(b.column("nearest").to_pylist()), np.int16).reshape(-1, NEAREST)
            yield pa.RecordBatch.from_arrays(
                [b.column("ball"), pa.array(list(x), pa.list_(pa.int16()))], names=["ball", "near"]
            )

    def joined(batches):
        for b in batches:
            sets = [np.sort(np.array(x, np.int16)).tobytes() for x in b.column("near").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("ball"), pa.array(sets, pa.binary())], names=["ball", "pivots"])

    near = balls.select("ball", "nearest").mapInArrow(split, "ball long, near array<short>")
    sets = near.select("ball", F.explode("near").alias("p")).groupBy("ball").agg(F.collect_set("p").alias("near"))
    sets = sets.mapInArrow(joined, "ball long, pivots binary")
    whole = balls.groupBy(F.col("ball").alias("_b")).agg(
        F.count(F.lit(1)).alias("n"), F.max("radius").alias("radius"), F.max("centre").alias("unit")
    )
    made = sets.join(whole, F.col("ball") == F.col("_b"))
    return written(alone.union(made.select(F.col("ball").alias("item"), "pivots", "n", "radius", "unit")), "items")


def postings(items: DataFrame) -> DataFrame:
    """(list, item, pivots) for each pair of an item's pivots that can be its lowest shared."""

    def run(batches):
        for b in batches:
            lists, at = [], []
            for i, (p, n) in enumerate(zip(b.column("pivots").to_pylist(), b.column("n").to_pylist())):
                x = np.frombuffer(p, np.int16).astype(np.int32)
                first, second = np.triu_indices(len(x), 1)
                if n == 1:  # in a single vector's own set the lowest two shared come early
                    early = second < NEAREST - SHARED + 2
                    first, second = first[early], second[early]
                lists.append(x[first] * MOST_PIVOTS + x[second])
                at.append(np.full(len(first), i))
            if not lists:
                continue
            at = pa.array(np.concatenate(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(lists), pa.int32()), b.column("item").take(at), b.column("pivots").take(at)],
                names=["list", "item", "pivots"],
            )

    return items.select("item", "pivots", "n").mapInArrow(run, "list int, item long, pivots binary")


class Lists:
    """Arrow batches sorted by ``keys``, given out as tables that hold whole keys."""

    def __init__(self, batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]):
        self.batches, self.keys = batches, keys

    def __iter__(self) -> Iterator[tuple[pa.Table, np.ndarray]]:
        """A table, and where its keys begin, with the end."""
        held: list[pa.RecordBatch] = []
        for b in self.batches:
            if not b.num_rows:
                continue
            starts = self._starts(b)
            if held and not self._same(held[-1], b):
                yield self._whole(held)
                held = []
            if held and len(starts) > 1:  # the first key of b ends here
                yield self._whole([*held, b.slice(0, starts[1])])
                held, b, starts = [], b.slice(starts[1]), starts[1:] - starts[1]
            if len(starts) > 1:  # all but the last key
                yield self._whole([b.slice(0, starts[-1])])
                b = b.slice(starts[-1])
            held.append(b)
        if held:
            yield self._whole(held)

    def _codes(self, b) -> list[np.ndarray]:
        return [b.column(k).to_numpy(zero_copy_only=False) for k in self.keys]

    def _starts(self, b) -> np.ndarray:
        new = np.zeros(b.num_rows, bool)
        new[:1] = True
        for c in self._codes(b):
            new[1:] |= c[1:] != c[:-1]
        return np.nonzero(new)[0]

    def _same(self, a, b) -> bool:
        return all(a.column(k)[a.num_rows - 1].as_py() == b.column(k)[0].as_py() for k in self.keys)

    def _whole(self, held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        return table, np.append(self._starts(table), table.num_rows)


def _pairs(starts: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), i < j, of each two rows of a key, some at a time."""
    ends = np.repeat(starts[1:], np.diff(starts))
    ahead = ends - np.arange(starts[-1]) - 1  # partners behind each row
    total = np.concatenate([[0], np.cumsum(ahead)])
    at = 0
    while at < len(ahead):
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        i = np.repeat(np.arange(at, to), ahead[at:to])
        yield i, i + 1 + np.arange(len(i)) - np.repeat(total[at:to] - total[at], ahead[at:to])
        at = to


def _sets(pivots: list[bytes], n_pivots: int) -> np.ndarray:
    """Bitmaps of pivots, one row each."""
    words = -(-n_pivots // 64)
    out = np.zeros((len(pivots), words), np.uint64)
    of = np.repeat(np.arange(len(pivots)), [len(p) // 2 for p in pivots])
    x = np.frombuffer(b"".join(pivots), np.int16).astype(np.int64)
    np.bitwise_or.at(out, (of, x >> 6), np.uint64(1) << (x & 63).astype(np.uint64))
    return out


def _met(sets: np.ndarray, low: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j share enough pivots, and the list's are their two lowest.

    ``low`` has the bits up to the list's second pivot."""
    both = sets[i] & sets[j]
    enough = np.bitwise_count(both).sum(axis=1) >= SHARED
    return enough & (np.bitwise_count(both & low).sum(axis=1) == 2)


def _low(lists: np.ndarray, n_pivots: int) -> np.ndarray:
    second = (lists % MOST_PIVOTS).astype(np.int64)
    words = np.arange(-(-n_pivots // 64))[None, :]
    left = np.clip(second[:, None] + 1 - 64 * words, 0, 64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    return np.where(left == 0, np.uint64(0), full >> (64 - np.maximum(left, 1)).astype(np.uint64))


def partnered(entered: DataFrame, n_pivots: int) -> DataFrame:
    """(list, item, n): items that have a partner in the list, and how many those are."""

    def run(batches):
        for table, starts in Lists(batches, ("list",)):
            sizes = np.diff(starts)
            alone = np.repeat(sizes == 1, sizes)
            if alone.all():
                continue
            table = table.filter(pa.array(~alone))
            starts = np.concatenate([[0], np.cumsum(sizes[sizes > 1])])
            sets = _sets(table.column("pivots").to_pylist(), n_pivots)
            lists = table.column("list").to_numpy()
            low = _low(lists, n_pivots)
            hit = np.zeros(len(sets), bool)
            for i, j in _pairs(starts):
                ok = _met(sets, low[i], i, j)
                hit[i[ok]] = hit[j[ok]] = True
            found = table.filter(pa.array(hit))
            counts = np.add.reduceat(hit, starts[:-1]) if len(starts) > 1 else hit
            n = np.repeat(counts, np.diff(starts))[hit]
            for b in found.select(["list", "item"]).append_column("n", pa.array(n, pa.int64())).combine_chunks().to_batches():
                yield b

    # A list is as long as its two pivots have vectors in common that are in no ball.
    by_list = entered.repartition("list").sortWithinPartitions("list")
    return written(by_list.mapInArrow(run, "list int, item long, n long"), "partnered")


class _Found:
    """Counts and edges of one task's batch, as rows (kind, a, b)."""

    def __init__(self):
        self.rows: dict[str, list] = {"kind": [], "a": [], "b": []}

    def add(self, kind: str, a, b) -> None:
        self.rows["kind"] += [kind] * len(a)
        self.rows["a"] += np.asarray(a, np.int64).tolist()
        self.rows["b"] += np.asarray(b, np.int64).tolist()

    def batch(self) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(self.rows.values(), kinds)], names=["kind", "a", "b"]
        )


def verified(met: DataFrame, items: DataFrame, n_pivots: int, cosine: float) -> DataFrame:
    """Rows (kind, a, b): ``count`` (item a has b more links, for each of its members), ``edge``
    (items a and b have a link), ``part`` (which of the links of a and b hold is open)."""
    angle = float(np.arccos(cosine))
    parts = F.ceil(F.col("n") / PART).cast("int")
    own = F.pmod(F.xxhash64("item"), parts).cast("int")
    spread = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    blocks = spread.select(
        "list", "item", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    with_vectors = blocks.join(items.withColumnRenamed("n", "weight"), "item")

    def run(batches):
        for table, starts in Lists(batches, ("list", "low", "high")):
            sets = _sets(table.column("pivots").to_pylist(), n_pivots)
            low_bits = _low(table.column("list").to_numpy(), n_pivots)
            units = _matrix(table.column("unit").combine_chunks())
            item, weight, radius, own, low, high = (
                table.column(c).to_numpy() for c in ("item", "weight", "radius", "own", "low", "high")
            )
            across = low != high
            found, counts, edges = _Found(), np.zeros(len(item), np.int64), []
            for i, j in _pairs(starts):
                ok = _met(sets, low_bits[i], i, j) & (~across[i] | (own[i] != own[j]))
                i, j = i[ok], j[ok]
                dots = np.einsum("ij,ij->i", units[i], units[j])
                reach = radius[i] + radius[j]
                off = np.arccos(np.clip(dots, -1, 1))
                single = reach == 0
                links = np.where(single, dots >= cosine, off + reach <= angle - MARGIN)
                open_ = ~single & ~links & (off - reach <= angle + MARGIN)
                np.add.at(counts, i[links], weight[j[links]])
                np.add.at(counts, j[links], weight[i[links]])
                edges.append(np.stack([i[links], j[links]]))
                a, b = item[i[open_]], item[j[open_]]
                found.add("part", np.maximum(a, b), np.minimum(a, b))
            some = np.nonzero(counts)[0]
            found.add("count", item[some], counts[some])
            a, b = _spanning(np.concatenate(edges, axis=1), len(item)) if edges else ([], [])
            found.add("edge", item[a], item[b])
            yield found.batch()

    by_block = with_vectors.repartition("list", "low", "high").sortWithinPartitions("list", "low", "high")
    return written(by_block.mapInArrow(run, "kind string, a long, b long"), "found")


def _spanning(edges: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each linked place with the smallest it is joined to through ``edges``."""
    label = np.arange(n)
    while edges.shape[1]:
        a, b = label[edges[0]], label[edges[1]]
        apart = a != b
        if not apart.any():
            break
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        label = label[label]
        while (label[label] != label).any():
            label = label[label]
    moved = np.nonzero(label != np.arange(n))[0]
    return label[moved], moved


def row_by_row(open_pairs: DataFrame, units: DataFrame, balls: DataFrame, cosine: float) -> DataFrame:
    """The links between the members of two items, the second a ball: rows (kind, a, b) with
    ``row`` (row a has b more links) and ``edge`` (items)."""
    pairs = open_pairs.select("a", "b").distinct()  # a single row or the higher ball, and a ball
    inside = balls.select(F.col("row").alias("member"), F.col("ball").alias("of"))
    single = pairs.where("a >= 0").select(F.col("b").alias("ball"), F.col("a").alias("row"), F.col("a").alias("item"))
    of_ball = pairs.where("a < 0").join(inside, F.col("a") == F.col("of")).select(
        F.col("b").alias("ball"), F.col("member").alias("row"), F.col("a").alias("item")
    )
    left = single.union(of_ball).withColumn("side", F.lit(0))
    right = (
        pairs.select(F.col("b").alias("ball")).distinct()
        .join(inside, F.col("ball") == F.col("of"))
        .select("ball", F.col("member").alias("row"), F.col("ball").alias("item"), F.lit(1).alias("side"))
    )
    sides = written(left.union(right), "sides")
    sizes = sides.groupBy("ball").agg(
        F.ceil(F.count_if(F.col("side") == 0) / PART).cast("int").alias("n0"),
        F.ceil(F.count_if(F.col("side") == 1) / PART).cast("int").alias("n1"),
    )
    own = F.pmod(F.xxhash64("row"), F.when(F.col("side") == 0, F.col("n0")).otherwise(F.col("n1"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("n1")).otherwise(F.col("n0")) - 1))
    cut = sides.join(sizes, "ball").withColumn("own", own).withColumn("other", other)
    at0, at1 = (F.when(F.col("side") == s, F.col("own")).otherwise(F.col("other")) for s in (0, 1))
    blocks = cut.select("ball", "row", "item", "side", at0.alias("at0"), at1.alias("at1")).join(units, "row")

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        found = _Found()
        one, two = table.filter(pa.array(side == 0)), table.filter(pa.array(side == 1))
        if one.num_rows and two.num_rows:
            links = _matrix(one.column("unit").combine_chunks()) @ _matrix(two.column("unit").combine_chunks()).T >= cosine
            for part, counts in ((one, links.sum(axis=1)), (two, links.sum(axis=0))):
                some = np.nonzero(counts)[0]
                found.add("row", part.column("row").to_numpy()[some], counts[some])
            items = np.unique(one.column("item").to_numpy()[links.any(axis=1)])
            found.add("edge", items, np.full(len(items), two.column("item")[0].as_py()))
        return pa.Table.from_batches([found.batch()])

    done = blocks.groupBy("ball", "at0", "at1").applyInArrow(run, "kind string, a long, b long")
    return written(done, "row_links")


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.95) -> DataFrame:
    """(key, n_links, component_id, kept) of each row."""
    everything, units, n = valid_rows(rows, key, vector)
    if not n:
        return everything.select(
            F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
        )
    pivots = choose_pivots(units, n)
    of = described(units, pivots)
    balls = find_balls(of, float(np.arccos(cosine)))
    items = items_of(of, balls)
    met = partnered(postings(items), len(pivots))
    found = verified(met, items, len(pivots), cosine)
    whole = row_by_row(found.where("kind = 'part'"), units, balls, cosine)

    per_item = found.where("kind = 'count'").groupBy("a").agg(F.sum("b").alias("links"))
    per_row = whole.where("kind = 'row'").groupBy(F.col("a").alias("_r")).agg(F.sum("b").alias("more"))
    edges = found.where("kind = 'edge'").union(whole.where("kind = 'edge'")).select("a", "b")
    label = components(edges).withColumnsRenamed({"node": "_n", "label": "_l"})
    sizes = balls.groupBy("ball").agg((F.count(F.lit(1)) - 1).alias("inside"))
    members = balls.select(F.col("row").alias("_m"), "ball").join(sizes, "ball")
    placed = (
        everything.join(members, F.col("row") == F.col("_m"), "left")
        .withColumn("item", F.coalesce("ball", "row"))
        .join(per_item, F.col("item") == F.col("a"), "left")
        .join(per_row, F.col("row") == F.col("_r"), "left")
        .join(label, F.col("item") == F.col("_n"), "left")
    )
    links = sum((F.coalesce(c, F.lit(0)) for c in ("inside", "links", "more")), F.lit(0).cast("long"))
    counted = written(
        placed.select("id", links.cast("long").alias("n_links"), F.coalesce("_l", "item").alias("component")), "counted"
    )
    low = counted.groupBy("component").agg(F.min("id").alias("component_id"))
    released(found)
    return counted.join(low, "component").select(
        F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
