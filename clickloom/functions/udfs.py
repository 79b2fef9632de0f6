"""User functions, and user aggregates that merge.

Scalar functions work on Arrow batches.  Where Spark has the function built in
(``length``, ``upper``, ``+``, ``avg``, ``count_if``) queries should use that; the
ones here show and test the way for code Spark does not have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.grouped import fold_values


@F.pandas_udf(T.IntegerType())
def text_length(s: pd.Series) -> pd.Series:
    """Number of characters; NULL for NULL."""
    return s.str.len().astype("Int32")


@F.pandas_udf(T.StringType())
def to_upper(s: pd.Series) -> pd.Series:
    return s.str.upper()


@F.arrow_udf(T.LongType())
def add_one(x: pa.Array) -> pa.Array:
    return pc.add_checked(x, 1)


def register_all(spark: SparkSession) -> None:
    """Make the scalar functions callable from SQL."""
    spark.udf.register("text_length", text_length)
    spark.udf.register("to_upper", to_upper)
    spark.udf.register("add_one", add_one)


def aggregate_in_batches(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    partial: Callable[[pd.core.groupby.SeriesGroupBy], pd.DataFrame],
    merge: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """A user aggregate in Python that never needs a whole group in one place.

    ``partial`` gets the values of one Arrow batch grouped by ``keys`` and
    returns a frame with one row per group, as ``grouped.agg(...)`` does.
    ``merge`` names its columns: ``{column: (type, "sum" | "min" | "max")}``.
    Only the partial rows are shuffled, and Spark merges them.
    """
    keys = list(keys)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join(
        [f"`{k}` {kinds[k]}" for k in keys] + [f"`{c}` {kind}" for c, (kind, _) in merge.items()]
    )
    columns = [*keys, *merge]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                # Arrow's own types: a NULL beside large integers or NaN changes neither.
                frame = batch.to_pandas(types_mapper=pd.ArrowDtype)
                grouped = frame.groupby(keys, dropna=False, sort=False)[value]
                got = partial(grouped).reset_index()[columns]
                yield pa.RecordBatch.from_pandas(got, preserve_index=False)

    combine = {"sum": F.sum, "min": F.min, "max": F.max}
    return (
        df.select(*keys, value)
        .mapInArrow(run, schema)
        .groupBy(*keys)
        .agg(*[combine[how](c).alias(c) for c, (_, how) in merge.items()])
    )


def mean_by_key(df: DataFrame, keys: Sequence[str], value: str, out: str = "mean") -> DataFrame:
    """The mean as a user aggregate: partial sums and counts, then their ratio."""
    keys = list(keys)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table({**{k: batch.column(k) for k in keys}, "v": batch.column(value).cast(pa.float64())})
            got = table.group_by(keys).aggregate([("v", "sum"), ("v", "count")])
            yield from got.rename_columns([*keys, "s", "n"]).select([*keys, "s", "n"]).combine_chunks().to_batches()

    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + ["s double", "n bigint"])
    sums = df.select(*keys, value).mapInArrow(run, schema).groupBy(*keys).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return sums.select(*keys, F.when(F.col("n") > 0, F.col("s") / F.col("n")).alias(out))


def fold_in_batches(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fold: Callable[[list], float],
    merge: str,
    kind: str = "bigint",
    out: str = "n",
) -> DataFrame:
    """A Python function over parts of each key's values, and how parts merge.

    ``fold`` is applied to the values of single Arrow batches and the results are
    combined by ``merge`` ("sum", "min" or "max"), so the two have to belong
    together, as a count and "sum" do.  For other functions see ``over_lists``.
    """
    keys = list(keys)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.table({**{k: batch.column(k) for k in keys}, "v": batch.column(value)})
                got = table.group_by(keys).aggregate([("v", "list")])
                folded = pa.array([fold(v) for v in got.column("v_list").to_pylist()])
                yield from got.select(keys).append_column(out, folded).combine_chunks().to_batches()

    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + [f"`{out}` {kind}"])
    combine = {"sum": F.sum, "min": F.min, "max": F.max}[merge]
    return df.select(*keys, value).mapInArrow(run, schema).groupBy(*keys).agg(combine(out).alias(out))


def list_function(fold: Callable[[list], float], kind: str = "bigint"):
    """``fold`` as a function of an array column, for DataFrames and, registered, SQL.

    It is for columns that hold lists.  Over ``collect_list(v)`` a key's values would have to fit
    in one row; ``grouped.register_fold`` has no such limit."""

    @F.arrow_udf(kind)
    def over(lists: pa.Array) -> pa.Array:
        return pa.array([None if x is None else fold(x) for x in lists.to_pylist()])

    return over


def over_lists(
    df: DataFrame, keys: Sequence[str], value: str, fold: Callable[[Iterator], object], kind: str = "bigint", out: str = "n"
) -> DataFrame:
    """Any Python function over all values of each key, without NULLs.  It is given an
    iterator and may read any number of values: see ``grouped.fold_values``."""
    return fold_values(df, keys, value, fold, kind, out)
