"""Joins, semi joins and bag union."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.ordered import HOT_GROUP_ROWS
from clickloom.operators.sized import MOST_BROADCAST_ROWS, Bounded
from clickloom.sources.writers import write_text

# Rows that one hash table should hold at most.
BUILD_ROWS = 1_000_000
# At most so many keys, those with most rows, are cut in pieces; the list is broadcast.
MOST_CUT_KEYS = 100_000


def join(
    a: DataFrame,
    b: DataFrame | Bounded,
    on: str | Sequence[str],
    how: str = "inner",
    strategy: str | None = None,
    small: bool = False,
) -> DataFrame:
    """Equi-join; all columns and all matches of both sides are kept.

    ``strategy``: None leaves the choice to Spark, which goes by measured sizes
    at run time; ``merge`` sorts both sides, and adaptive execution splits skewed
    partitions; ``shuffle_hash`` is ``hash_join``.  ``broadcast`` sends ``b`` to all tasks if it is
    ``Bounded``, that is small by how it is made; a plain DataFrame is broadcast only if Spark
    measures it below ``spark.sql.autoBroadcastJoinThreshold``, and merged otherwise.
    ``small`` is the caller's word that ``b`` is small by nature.
    """
    keys = [on] if isinstance(on, str) else list(on)
    proven = isinstance(b, Bounded) and b.rows <= MOST_BROADCAST_ROWS
    b = b.df if isinstance(b, Bounded) else b
    if strategy is None:
        return a.join(b, keys, how)
    if strategy == "broadcast":
        return a.join(F.broadcast(b) if small or proven else b, keys, how)
    if strategy == "shuffle_hash":
        return a.join(b.hint("shuffle_hash"), keys, how) if small or proven else hash_join(a, b, keys, how)
    if strategy == "merge":
        return a.join(b.hint("merge"), keys, how)
    raise ValueError(f"unknown join strategy {strategy!r}")


def _heavy(df: DataFrame, keys: Sequence[str], rows: int, out: str) -> DataFrame:
    """(keys, ``out``): pieces of the keys that have more than ``rows`` rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows)
    most = counts.orderBy(F.desc("__n")).limit(MOST_CUT_KEYS)
    return most.select(*keys, F.ceil(F.col("__n") / rows).cast("int").alias(out))


def _with_pieces(df: DataFrame, keys: Sequence[str], cuts: Sequence[DataFrame]) -> DataFrame:
    """``df`` with the pieces of its key from each of ``cuts``, 1 for most; NULL is a key here."""
    for cut in cuts:
        named = cut.select(*[F.col(k).alias(f"__key_{k}") for k in keys], cut.columns[-1])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
        df = df.join(F.broadcast(named), same, "left").drop(*[f"__key_{k}" for k in keys])
        df = df.withColumn(cut.columns[-1], F.coalesce(cut.columns[-1], F.lit(1)))
    return df


def hash_join(
    a: DataFrame,
    b: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    build_rows: int = BUILD_ROWS,
    probe_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Both sides are dealt out by key and each task looks its rows of ``a`` up in a hash
    table of its rows of ``b``; nothing is sorted.

    A hash table has to fit in memory, so its size is made sure of: the rows of ``b`` are counted
    first (a job over its key columns alone), and where ``spark.sql.shuffle.partitions`` tables of
    ``build_rows`` would not hold them there are more partitions.  A key with more than
    ``build_rows`` rows in ``b`` is cut in pieces, which the rows of ``a`` with that key meet one
    by one; inner joins only, as rows without a match would come once for each piece.

    A key may have any number of rows in ``a``: adaptive execution splits skewed partitions of a
    shuffled hash join as those of a merge join.  It does not do so where the number of partitions is
    set as above; there keys with more than ``probe_rows`` rows in ``a`` are cut in pieces here, and
    their rows of ``b`` are repeated for each.

    Right and full outer joins go by ``spark.sql.shuffle.partitions`` alone.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        return a.join(b.hint("shuffle_hash"), keys, how)
    sizes = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    usual = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = math.ceil(2 * rows / build_rows)  # twice, as keys are not dealt out evenly
    cuts = []
    if how == "inner" and largest > build_rows:
        cuts.append((_heavy(b, keys, build_rows, "__b"), "__b"))
    if partitions > usual:
        cuts.append((_heavy(a, keys, probe_rows, "__a"), "__a"))
    if not cuts and partitions <= usual:
        return a.join(b.hint("shuffle_hash"), keys, how)

    # The side that is cut takes one piece of each row, the other side takes all.
    pieces = [name for _, name in cuts]
    left, right = (_with_pieces(side, keys, [c for c, _ in cuts]) for side in (a, b))
    for name in pieces:
        one = F.pmod(F.monotonically_increasing_id(), F.col(name)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(name) - 1))
        left = left.withColumn(name, one if name == "__a" else every)
        right = right.withColumn(name, one if name == "__b" else every)
    by = [*keys, *pieces]
    if partitions > usual:
        left, right = (side.repartition(partitions, *by) for side in (left, right))
    return left.join(right.hint("shuffle_hash"), by, how).drop(*pieces)


def join_text_files(
    spark: SparkSession,
    a_path: str,
    a_columns: Sequence[str],
    b_path: str,
    b_columns: Sequence[str],
    target: str,
    strategy: str | None = None,
    single_file: bool = False,
) -> None:
    """Join two comma-separated text tables by their first fields and write the
    rows (key, rest of a, rest of b) as comma-separated text.

    Lines are cut at plain commas: quote signs, empty fields and empty keys count as
    they stand, and fields beyond the named columns are kept.  The first names of
    ``a_columns`` and ``b_columns`` must agree.
    """
    if a_columns[0] != b_columns[0]:
        raise ValueError("the key has to be the first column of both tables")
    key = a_columns[0]

    def read(path: str, rest: str) -> DataFrame:
        fields = F.split("value", ",", -1)
        return spark.read.text(path).select(
            fields[0].alias(key), F.slice(fields, 2, F.size(fields)).alias(rest)
        )

    joined = join(read(a_path, "__a"), read(b_path, "__b"), key, "inner", strategy)
    line = F.concat(F.array(key), "__a", "__b")
    write_text(joined.select(F.array_join(line, ",").alias("line")), target, single_file=single_file)


def keep_members(df: DataFrame, column: str, members: Iterable | DataFrame) -> DataFrame:
    """Rows whose ``column`` is in a constant list, or in the column of the same
    name of another DataFrame (semi join; the list never visits the driver)."""
    if isinstance(members, DataFrame):
        return df.join(members.select(column), column, "left_semi")
    return df.where(F.col(column).isin(list(members)))


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Bag union by column name; a column missing on one side is NULL there."""
    return a.unionByName(b, allowMissingColumns=True)
