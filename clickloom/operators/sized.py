"""Tables whose number of rows is bounded by how they are made.

A broadcast is safe if its size does not follow the data.  ``Bounded`` carries that
proof to ``joins.join``: the first k rows of an order, rows written down in code, or
the values of a small domain.  Each bound is part of the plan itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from clickloom.operators.ranking import top_k
from clickloom.sources.readers import values

# A table of more rows is not broadcast, whatever its proof.
MOST_BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Bounded:
    """``df`` has at most ``rows`` rows."""

    df: DataFrame
    rows: int


def first_rows(df: DataFrame, order: Sequence[str | Column], k: int) -> Bounded:
    """The first ``k`` rows."""
    return Bounded(top_k(df, order, k), k)


def constant(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> Bounded:
    """Literal rows."""
    rows = list(rows)
    return Bounded(values(spark, rows, schema), len(rows))


def at_most(df: DataFrame, rows: int) -> Bounded | DataFrame:
    """``df`` bounded by ``rows`` if it has no more; else ``df`` as it is, and a join then goes by
    measured sizes.  The check is a job that counts the rows in each task; ``df`` has to
    give the same rows when it is read again."""
    if rows <= MOST_BROADCAST_ROWS and df.count() <= rows:
        return Bounded(df.limit(rows), rows)
    return df


def domain(df: DataFrame, columns: Sequence[str], rows: int) -> Bounded | DataFrame:
    """The different values of ``columns``, bounded if there are no more than ``rows``."""
    return at_most(df.select(*columns).distinct(), rows)
