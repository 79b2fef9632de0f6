"""Merging the values of equal keys under a policy, and vector sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ordered import HOT_GROUP_ROWS, ordered_lists

POLICIES = ("replace", "keep", "add", "list", "set")


def merge_by_key(
    df: DataFrame,
    key: str,
    value: str,
    policy: str,
    order: Sequence[str] = (),
    list_rows: int = 10_000,
    hot_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """One result per key.

    * ``replace``: the last value in ``order``; ``keep``: the first one.
    * ``add``: the sum.
    * ``list``: all values in ``order``; if ``value`` is an array, its elements.
    * ``set``: the distinct values, ascending; likewise for arrays.

    The first three combine before the shuffle and keep one row per key.  Lists
    and sets come in parts of at most ``list_rows`` elements (column ``part``); a key
    without elements has one empty part.
    ``order`` should be unique within a key.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    if policy in ("replace", "keep", "list") and not order:
        raise ValueError(f"policy {policy!r} needs an order")
    if policy == "add":
        return df.groupBy(key).agg(F.sum(value).alias(value))
    if policy in ("replace", "keep"):
        at = F.struct(*order) if len(order) > 1 else F.col(order[0])
        pick = F.max_by if policy == "replace" else F.min_by
        # The value travels in a struct so that a NULL value can win too.
        chosen = pick(F.struct(F.col(value).alias("v")), at)
        return df.groupBy(key).agg(chosen["v"].alias(value))

    # A row without element, a NULL array say, stays as a marker that keeps its key.  Lists of
    # plain values have NULLs as elements; markers are no elements.
    nested = df.schema[value].dataType.typeName() == "array"
    if policy == "list":
        columns = list(dict.fromkeys([key, *order]))
        if not nested:
            return ordered_lists(df, [key], value, order, value, list_rows, hot_rows, nulls=True)
        element = F.posexplode_outer(F.transform(value, lambda e: F.struct(e.alias("e")))).alias("__i", "__e")
        lists = ordered_lists(
            df.select(*columns, element), [key], "__e", [*order, "__i"], value, list_rows, hot_rows
        )
        return lists.withColumn(value, F.transform(value, lambda e: e["e"]))
    items = df.select(key, F.explode_outer(F.array_compact(value)).alias(value) if nested else value)
    return ordered_lists(items.distinct(), [key], value, [value], value, list_rows, hot_rows)


def vector_sum(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    initial: Sequence[float] | None = None,
    width: int | None = None,
) -> DataFrame:
    """Element-wise sum of a vector column as rows (by…, ``pos``, ``total``).

    ``initial`` is added once to each group, at all its positions; without groups also
    where there is no row.  Positions of NULLs alone are left out.  With a known ``width`` every
    position is an aggregate of its own; elements beyond ``width`` are then an error.  Without it
    vectors may differ in length.
    """
    by = list(by)
    if width is None:
        return _sum_by_position(df, column, by, list(initial or ()))
    element = [F.get(column, F.lit(i)).cast("double") for i in range(width)]
    too_long = F.raise_error(F.lit(f"a vector is longer than {width}")).cast("double")
    element[0] = F.when(F.size(column) > width, too_long).otherwise(element[0])
    wide = df.groupBy(*by).agg(*[F.sum(e).alias(f"__{i}") for i, e in enumerate(element)])
    totals = [F.col(f"__{i}") for i in range(width)]
    for i, start in enumerate(initial or ()):
        add = F.lit(float(start))
        if i < width:
            totals[i] = F.coalesce(totals[i], F.lit(0.0)) + add
        else:
            totals.append(add)
    return wide.select(*by, F.posexplode(F.array(*totals)).alias("pos", "total")).where(F.col("total").isNotNull())


def _sum_by_position(df: DataFrame, column: str, by: Sequence[str], initial: Sequence[float]) -> DataFrame:
    """One read and one exchange: the elements are summed by group and position within each task
    first, so what is dealt out is one row for each group and position of a task.

    Vectors shorter than ``initial`` are filled up with NULLs, which gives each group all positions of
    ``initial``; it is added once the sums are whole.
    """
    rows = df.select(*by, column)
    n = len(initial)
    vector = F.col(column)
    if initial:
        if not by:  # an empty table has one group too
            rows = rows.unionByName(df.sparkSession.range(1).select(F.lit(None).cast(df.schema[column].dataType).alias(column)))
        filled = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get(vector, i))
        vector = F.when(F.size(vector) >= n, vector).otherwise(filled)
    sums = (
        rows.select(*by, F.posexplode(vector).alias("pos", "x"))
        .groupBy(*by, "pos")
        .agg(F.sum(F.col("x").cast("double")).alias("total"))
    )
    if initial:
        start = F.get(F.array(*[F.lit(float(v)) for v in initial]), F.col("pos"))
        total = F.when(F.col("pos") < n, F.coalesce("total", F.lit(0.0)) + start).otherwise(F.col("total"))
        sums = sums.withColumn("total", total)
    return sums.where(F.col("total").isNotNull())
