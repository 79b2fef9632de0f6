"""Top-k overall and per group."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.grouped import key_at, run_starts, same_key

# Up to this k one step is enough: Spark trims every task's rows to k per group
# before the shuffle, so a hot group brings k rows from each task.
ONE_STEP_K = 100
# At most so many groups, those with most rows, get a cut-off; the list is broadcast.
MOST_CUT_GROUPS = 10_000

_AT = "__at"


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """The first ``k`` rows; ``order`` should end in a unique key."""
    return df.orderBy(*map(_sort_column, order)).limit(k)


def _sort_column(by: str | Column) -> Column:
    if isinstance(by, Column):
        return by
    name, descending = _parsed(by)
    return F.desc(name) if descending else F.asc(name)


def _parsed(by: str) -> tuple[str, bool]:
    """Name and direction of ``"name"``, ``"name asc"`` or ``"name desc"``."""
    name, _, way = by.strip().partition(" ")
    way = way.strip().lower()
    if way not in ("", "asc", "desc"):
        raise ValueError(f"no order: {by!r}")
    return name, way == "desc"


def _first(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], k: int, rank: str
) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*map(_sort_column, order))
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def first_of_each_task(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group within each input task, numbered in ``__at``.

    Nothing is exchanged: each task sorts its own rows, and they stream by.
    """
    group = list(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0  # the group that the batch before ended in, and its rows so far
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = run_starts(batch, group)
            place = np.arange(batch.num_rows) - np.repeat(starts, np.diff([*starts, batch.num_rows])) + 1
            if last is not None and same_key(last, key_at(batch, group, 0)):
                place[: starts[1] if len(starts) > 1 else None] += seen
            last, seen = key_at(batch, group, batch.num_rows - 1), int(place[-1])
            keep = place <= k
            if keep.any():
                kept = batch.append_column(_AT, pa.array(place, pa.int64()))
                yield kept if keep.all() else kept.filter(pa.array(keep))

    schema = T.StructType([*df.schema.fields, T.StructField(_AT, T.LongType())])
    return df.sortWithinPartitions(*group, *map(_sort_column, order)).mapInArrow(run, schema)


def cut_offs(df: DataFrame, group: Sequence[str], order: Sequence[str], k: int) -> DataFrame:
    """(group, columns of ``order``) of a row that at least ``k`` rows of its group come up to, and not
    many more, for the groups with most rows.

    Every task gives each s-th of its first ``k`` rows of a group, s being the root of ``k``.  Such a
    mark stands for s rows up to it, whatever the other tasks have, so the marks of
    all tasks merge by counting.  ``k`` / s marks make ``k`` rows; a task can have
    less than s more rows up to there than its marks tell: at most
    ``k`` + (tasks + 1) * s rows of a group pass the cut-off, ties with it aside.
    """
    names = [_parsed(o)[0] for o in order]
    columns = list(dict.fromkeys([*group, *names]))
    step = math.isqrt(k)
    marks = first_of_each_task(df.select(*columns), group, order, k).where(F.col(_AT) % step == 0)
    needed = -(-k // step)
    in_order = Window.partitionBy(*group).orderBy(*map(_sort_column, order))
    placed = marks.withColumn("__mark", F.row_number().over(in_order)).withColumn(
        "__marks", F.count(F.lit(1)).over(Window.partitionBy(*group))
    )
    cut = placed.where((F.col("__mark") == needed) & (F.col("__marks") > needed))
    return cut.orderBy(F.desc("__marks")).limit(MOST_CUT_GROUPS).select(*columns)


def _not_after(order: Sequence[str], prefix: str) -> Column:
    """Whether a row comes up to the cut-off, NULLs where Spark sorts them."""
    fits = F.lit(True)
    for by in reversed(order):
        name, descending = _parsed(by)
        own, cut = F.col(name), F.col(prefix + name)
        if descending:  # NULLs last
            before = F.coalesce(own > cut, own.isNotNull() & cut.isNull())
        else:
            before = F.coalesce(own < cut, own.isNull() & cut.isNotNull())
        fits = before | (own.eqNullSafe(cut) & fits)
    return fits


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    k: int,
    rank: str = "rank",
    one_step_k: int = ONE_STEP_K,
) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank`` (bigint, from 1).

    ``order`` has names, ``"name desc"`` or columns.  For a ``k`` above ``one_step_k`` each task keeps
    its first ``k`` rows of a group, and of those only the ones up to the group's
    cut-off are exchanged: see ``cut_offs``.  That needs an order in names; with columns,
    each task's first ``k`` rows are exchanged.  ``df`` is then read twice and has
    to give the same rows each time.
    """
    if k > one_step_k:
        kept = first_of_each_task(df, group, order, k).drop(_AT)
        if all(isinstance(o, str) for o in order):
            prefix = "__cut_"
            cut = cut_offs(df, group, order, k)
            cut = cut.select(*[F.col(c).alias(prefix + c) for c in cut.columns], F.lit(True).alias("__cut"))
            same = F.lit(True)
            for g in group:
                same = same & F.col(g).eqNullSafe(F.col(prefix + g))
            # At most MOST_CUT_GROUPS rows are broadcast.
            met = kept.join(F.broadcast(cut), same, "left")
            kept = met.where(F.col("__cut").isNull() | _not_after(order, prefix)).select(*df.columns)
        df = kept
    return _first(df, group, order, k, rank).withColumn(rank, F.col(rank).cast("bigint"))
