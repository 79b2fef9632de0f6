"""Word count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.ranking import top_k

# Only these part words; tabs and punctuation stay in the word.
SPACE = " "
LINE_ENDS = ("\n", "\r")


def words(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per non-empty word, column ``word``.

    Line ends become spaces first: a split at one plain character needs no
    regular expression and is the faster of the two.
    """
    flat = F.col(column)
    for end in LINE_ENDS:
        flat = F.replace(flat, F.lit(end), F.lit(SPACE))
    return df.select(F.explode(F.split(flat, SPACE)).alias("word")).where("word <> ''")


def word_count(df: DataFrame, column: str = "value", k: int | None = None) -> DataFrame:
    """``word`` and its number ``n``; the ``k`` most frequent ones if given."""
    counted = words(df, column).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted if k is None else top_k(counted, [F.desc("n"), F.asc("word")], k)
