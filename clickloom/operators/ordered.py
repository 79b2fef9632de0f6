"""Order-aware operators over groups of any size.

A plain window sorts each group inside one task, which is right for groups of
ordinary size.  One group may hold a large part of all rows, though, so groups
above ``hot_rows`` are cut into chunks that many tasks share.

``next_in_group`` and ``position_in_group`` know the chunks before they deal out a row: the
pass that counts the groups' rows also samples them, and sampled rows of hot groups become the
bounds of their chunks.  Every row then goes straight to (group, chunk), ordinary groups
having one chunk, so there is one exchange of rows and one window whatever the groups.  As a
chunk begins with the row that is its bound, the bounds also tell what follows the
chunk before.

The lists and paths, in which masses of rows may tie, merge equal rows first and take two
ways: hot groups are range-partitioned by (group, order), each chunk is windowed on its own,
and the seams between chunks are closed over the few edge rows.  When no group is hot,
adaptive execution sees the empty list of hot groups and drops that way before it runs.

``order`` has to be total within a group.  Rows that tie in it must be
interchangeable, and they stay together in one chunk.  The input is computed more
than once and has to give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from clickloom.functions.exprs import whole_div

# Rows of one group that a single task sorts without trouble.
HOT_GROUP_ROWS = 2_000_000

# Sampled rows for each ``hot_rows`` of a group.  A group has SEARCHED**2 bounds at most, searched
# in two steps of SEARCHED.
SAMPLED, SEARCHED = 64, 32

_CHUNK = "__chunk"
_EDGE = "__edge"


def _as_columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def split_hot(
    df: DataFrame, group: Sequence[str], hot_rows: int = HOT_GROUP_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (rows of ordinary groups, rows of hot groups).

    Groups are told apart by a 64-bit hash, and there are at most rows / ``hot_rows``
    hot ones; Spark chooses the join by the size of that list.  Where two
    groups share a hash both go the same way, which changes no result: either
    way is right for any group as long as all its rows take it together.
    """
    key = F.xxhash64(*group)
    hot = (
        df.groupBy(key.alias("__hot"))
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > hot_rows)
        .select("__hot")
    )
    is_hot = key == F.col("__hot")
    return (
        df.join(hot, is_hot, "left_anti"),
        df.join(hot, is_hot, "left_semi"),
    )


def _chunked(df: DataFrame, group: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Rows of each group cut into consecutive chunks, numbered in order."""
    return df.repartitionByRange(*_as_columns(group), *_as_columns(order)).withColumn(
        _CHUNK, F.spark_partition_id()
    )


def _both_ways(
    df: DataFrame,
    group: Sequence[str],
    hot_rows: int | None,
    plain: Callable[[DataFrame], DataFrame],
    split: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    if hot_rows is None:
        return plain(df)
    usual, hot = split_hot(df, group, hot_rows)
    return plain(usual).unionByName(split(hot))


def next_plain(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], value: str, out: str
) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*_as_columns(order))
    return df.withColumn(out, F.lead(value).over(w))


def next_in_chunks(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], value: str, out: str
) -> DataFrame:
    """``next_plain`` for hot groups: lead inside chunks, then across the seams.

    The value travels in a struct, so that "no next row" and "next row holds
    NULL" stay apart.
    """
    keys = _as_columns(order)
    in_chunk = Window.partitionBy(*group, _CHUNK).orderBy(*keys)
    follower = F.lead(F.struct(F.col(value).alias("v")))
    chunked = (
        _chunked(df, group, order)
        .withColumn("__near", follower.over(in_chunk))
        .withColumn("__first", F.row_number().over(in_chunk) == 1)
    )
    # First and last rows of all chunks of a group meet in bucket -1, at most two
    # per chunk; inner rows stay in the bucket of their chunk.
    edges = chunked.withColumn(
        _EDGE,
        F.when(F.col("__first") | F.col("__near").isNull(), F.lit(-1)).otherwise(F.col(_CHUNK)),
    )
    across = Window.partitionBy(*group, _EDGE).orderBy(*keys)
    return (
        edges.withColumn("__far", follower.over(across))
        .withColumn(out, F.coalesce("__near", "__far")["v"])
        .select(*df.columns, out)
    )


def _same_group(group: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(prefix + g))
    return same


def chunk_bounds(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str | None, hot_rows: int
) -> DataFrame:
    """(group, ``__bounds``) of the groups above ``hot_rows``: rows that begin chunks, ascending, as structs of
    the order and, in ``v``, the value.

    One pass counts rows by group and, for one row in ``hot_rows`` / ``SAMPLED`` chosen by a hash, by
    that row, so ordinary groups add next to nothing.  All tuples together are about one for half of
    ``hot_rows`` rows, so their broadcast is bounded by the rows of the input and not by its groups.
    """
    columns = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]
    carried = F.col(value) if value else F.lit(None).cast("int")
    chosen = F.pmod(F.xxhash64(*group, *order), F.lit(max(1, hot_rows // SAMPLED))) == 0
    mark = F.when(chosen, F.struct(*columns, carried.alias("v"))).alias("__mark")
    # Both uses below need all of the counts, so that Spark counts once and reuses the exchange.
    counts = df.groupBy(*group, mark).agg(
        F.count(F.lit(1)).alias("__n"), F.max(F.when(chosen, 1).otherwise(0)).alias("__chosen")
    )
    rows = F.sum(F.when(F.col("__chosen") >= 0, F.col("__n")))
    hot = counts.groupBy(*group).agg(rows.alias("__rows")).where(F.col("__rows") > hot_rows)
    hot = hot.select(*[F.col(g).alias(f"__hot_{g}") for g in group])
    sampled = counts.where((F.col("__chosen") == 1) & (F.col("__n") > 0))
    marks = sampled.join(hot, _same_group(group, "__hot_")).select(*group, "__mark")
    place = F.row_number().over(Window.partitionBy(*group).orderBy("__mark"))
    number = F.count(F.lit(1)).over(Window.partitionBy(*group))
    step = F.greatest(F.lit(SAMPLED // 2), F.ceil(number / (SEARCHED * SEARCHED)))
    picked = marks.withColumn("__step", step).withColumn("__place", place).where(F.col("__place") % F.col("__step") == 0)
    return picked.groupBy(*group).agg(F.sort_array(F.collect_list("__mark")).alias("__bounds"))


def _with_chunks(df: DataFrame, bounds: DataFrame, group: Sequence[str], order: Sequence[str], how: str) -> DataFrame:
    """``df`` with the number of its chunk (0 in groups without) and the value that begins the next."""
    named = bounds.select(*[F.col(g).alias(f"__of_{g}") for g in group], "__bounds")
    own = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    fields = [f"o{i}" for i in range(len(order))]

    def up_to_own(tuples: Column) -> Column:
        return F.size(F.filter(tuples, lambda b: F.struct(*[b[f].alias(f) for f in fields]) <= own))

    # Every SEARCHED-th bound first, then those behind the last of them that fits.
    count = F.size("__bounds")
    far = F.transform(
        F.sequence(F.lit(1), F.ceil(count / SEARCHED).cast("int")),
        lambda i: F.get("__bounds", (i - 1) * SEARCHED),
    )
    coarse = up_to_own(far)
    near = up_to_own(F.slice("__bounds", F.greatest(F.lit(0), coarse - 1) * SEARCHED + 1, F.lit(SEARCHED)))
    chunk = F.when(count > 0, F.greatest(F.lit(0), coarse - 1) * SEARCHED + near).otherwise(0)
    placed = df.join(F.broadcast(named), _same_group(group, "__of_"), how).withColumn(_CHUNK, chunk)
    after = F.get("__bounds", F.col(_CHUNK))
    return placed.withColumn("__seam", F.when(after.isNotNull(), F.struct(after["v"].alias("v")))).drop(
        "__bounds", *[f"__of_{g}" for g in group]
    )


def next_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    out: str,
    hot_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """Add ``out``: ``value`` of the next row of the same group, NULL on the last.

    ``hot_rows=None`` asserts that no group is large and skips the check.  An ``order`` with
    other than names goes by ranges.
    """
    if hot_rows is None:
        return next_plain(df, group, order, value, out)
    if not all(isinstance(o, str) for o in order):
        return _both_ways(
            df,
            group,
            hot_rows,
            lambda part: next_plain(part, group, order, value, out),
            lambda part: next_in_chunks(part, group, order, value, out),
        )
    needed = df.select(*dict.fromkeys([*group, *order, value]))
    placed = _with_chunks(df, chunk_bounds(needed, group, order, value, hot_rows), group, order, "left")
    w = Window.partitionBy(*group, _CHUNK).orderBy(*order)
    # The value travels in a struct, so that "no next row" and "next row holds NULL" stay apart.
    follower = F.lead(F.struct(F.col(value).alias("v"))).over(w)
    return placed.withColumn("__near", follower).select(
        *df.columns, F.coalesce("__near", "__seam")["v"].alias(out)
    )


def _up_to(weight: Column, group: WindowSpec, order: Sequence[str | Column]) -> Column:
    """Sum of ``weight`` up to and including the row, in order."""
    so_far = group.orderBy(*_as_columns(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return F.sum(weight).over(so_far)


def position_plain(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], out: str
) -> DataFrame:
    return df.withColumn(out, _up_to(F.lit(1).cast("bigint"), Window.partitionBy(*group), order))


def position_in_chunks(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    out: str,
    copies: str | None = None,
) -> DataFrame:
    """``position_plain`` for hot groups: position inside the chunk plus the sizes
    of the chunks before it.

    A row may stand for ``copies`` equal ones, or for none; it gets the position of the last.
    """
    chunk = Window.partitionBy(*group, _CHUNK)
    weight = F.col(copies) if copies else F.lit(1).cast("bigint")
    chunked = (
        _chunked(df, group, order)
        .withColumn("__near", _up_to(weight, chunk, order))
        .withColumn("__size", F.sum(weight).over(chunk))
        .withColumn("__first", F.row_number().over(chunk.orderBy(*_as_columns(order))) == 1)
        .withColumn(_EDGE, F.when(F.col("__first"), F.lit(-1)).otherwise(F.col(_CHUNK)))
    )
    before = (
        Window.partitionBy(*group, _EDGE)
        .orderBy(_CHUNK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        chunked.withColumn(
            "__before",
            F.when(F.col("__first"), F.coalesce(F.sum("__size").over(before), F.lit(0))),
        )
        .withColumn(out, F.col("__near") + F.max("__before").over(chunk))
        .select(*df.columns, out)
    )


def position_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    out: str = "position",
    hot_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """Add ``out``: 1, 2, 3 … in order within the group.

    The rows of the chunks of hot groups are counted once their bounds are known, by a read of the
    group and order alone.
    """
    if hot_rows is None:
        return position_plain(df, group, order, out)
    if not all(isinstance(o, str) for o in order):
        return _both_ways(
            df,
            group,
            hot_rows,
            lambda part: position_plain(part, group, order, out),
            lambda part: position_in_chunks(part, group, order, out),
        )
    needed = df.select(*dict.fromkeys([*group, *order]))
    bounds = chunk_bounds(needed, group, order, None, hot_rows)
    sizes = _with_chunks(needed, bounds, group, order, "inner").groupBy(*group, _CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*group).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        *[F.col(g).alias(f"__in_{g}") for g in group], F.col(_CHUNK).alias("__in"), F.sum("__n").over(earlier).alias("__before")
    )
    placed = _with_chunks(df, bounds, group, order, "left")
    here = _same_group(group, "__in_") & (F.col(_CHUNK) == F.col("__in"))
    placed = placed.join(F.broadcast(before), here, "left")
    position = _up_to(F.lit(1).cast("bigint"), Window.partitionBy(*group, _CHUNK), order)
    return placed.withColumn("__near", position).select(
        *df.columns, (F.col("__near") + F.coalesce("__before", F.lit(0))).alias(out)
    )


def _lists_plain(
    df: DataFrame, group: Sequence[str], value: str, order: Sequence[str], out: str, list_rows: int, nulls: bool
) -> DataFrame:
    weight = F.lit(1) if nulls else F.col(value).isNotNull().cast("int")
    placed = df.withColumn("__pos", _up_to(weight.cast("bigint"), Window.partitionBy(*group), order))
    # What weighs nothing opens no part of its own, but for the first.
    part = whole_div(F.greatest(F.col("__pos"), F.lit(1)) - 1, F.lit(list_rows)).alias("part")
    element = F.struct("__pos", F.col(value).alias("v"))
    return (
        placed.groupBy(*group, part)
        .agg(F.sort_array(F.collect_list(element if nulls else F.when(weight == 1, element))).alias("l"))
        .select(*group, "part", F.transform("l", lambda e: e["v"]).alias(out))
    )


def _lists_of_runs(
    df: DataFrame, group: Sequence[str], value: str, order: Sequence[str], out: str, list_rows: int, nulls: bool
) -> DataFrame:
    """``_lists_plain`` for hot groups.  Equal rows are merged first; a run of them
    is cut where a part ends, and written out only inside its part."""
    columns = list(dict.fromkeys([*group, *order]))
    copies = F.count(F.lit(1)) if nulls else F.count(value)
    runs = df.groupBy(*columns).agg(copies.alias("__n"))
    size = F.lit(list_rows).cast("bigint")
    end = F.col("__end")
    start = end - F.col("__n")
    last = F.greatest(end, F.lit(1)) - 1
    parts = F.sequence(whole_div(F.least(start, last), size), whole_div(last, size))
    inside = F.least(end, (F.col("part") + 1) * size) - F.greatest(start, F.col("part") * size)
    element = F.struct("__end", F.col(value).alias("v"), "__m")
    return (
        position_in_chunks(runs, group, order, "__end", "__n")
        .withColumn("part", F.explode(parts))
        .withColumn("__m", F.greatest(inside, F.lit(0)).cast("int"))
        .groupBy(*group, "part")
        .agg(F.sort_array(F.collect_list(F.when(F.col("__m") > 0, element))).alias("l"))
        .select(
            *group,
            "part",
            F.flatten(F.transform("l", lambda e: F.array_repeat(e["v"], e["__m"]))).alias(out),
        )
    )


def ordered_lists(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    order: Sequence[str],
    out: str = "values",
    list_rows: int = 10_000,
    hot_rows: int | None = HOT_GROUP_ROWS,
    nulls: bool = False,
) -> DataFrame:
    """The values of each group as ordered lists of at most ``list_rows`` elements.

    Columns: the group, ``part`` (0, 1, 2 …) and ``out``.  A group that fits has
    one row, part 0; a larger one continues in the following parts, so no row
    and no task has to hold a whole group.  As in ``collect_list``, NULLs are left out, and a group
    of NULLs alone has an empty list; ``nulls`` keeps them as elements.  Rows that tie in ``order`` come by
    value, so the order need not be unique here, and any number of equal rows is
    no burden.
    """
    by = list(dict.fromkeys([*order, value]))
    return _both_ways(
        df.select(*dict.fromkeys([*group, *by])),
        group,
        hot_rows,
        lambda part: _lists_plain(part, group, value, by, out, list_rows, nulls),
        lambda part: _lists_of_runs(part, group, value, by, out, list_rows, nulls),
    )


def ordered_rows(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    order: Sequence[str],
    out: str = "position",
    hot_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """Rows (group, ``out``, value) with ``out`` counting 1, 2, 3 … within the group.

    The long form of ``ordered_lists``, with the same order.
    """
    by = list(dict.fromkeys([*order, value]))
    list_rows = 10_000

    def split(part: DataFrame) -> DataFrame:
        lists = _lists_of_runs(part, group, value, by, "__list", list_rows, True)
        elements = lists.select(*group, "part", F.posexplode("__list").alias("__i", value))
        position = F.col("part") * list_rows + F.col("__i") + 1
        return elements.select(*group, position.alias(out), value)

    return _both_ways(
        df.select(*dict.fromkeys([*group, *by])),
        group,
        hot_rows,
        lambda part: position_plain(part, group, by, out).select(*group, out, value),
        split,
    )
