"""Keyed and global summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.exprs import half_up_mean
from clickloom.sources.readers import read_csv
from clickloom.sources.schemas import CHARGE_EVENTS
from clickloom.sources.writers import write_parquet


def charge_summary(
    df: DataFrame,
    key: str = "chargepoint_id",
    value: str = "plugin_duration",
    decimals: int | None = None,
) -> DataFrame:
    """``max_duration`` and ``avg_duration`` per key, rounded to two decimals.

    A mean of doubles depends in its last bits on the order of addition, and so
    may its rounding.  If the values are known to carry at most ``decimals``
    decimals the mean is taken over whole numbers and rounds half up exactly.
    """
    top = F.round(F.max(value), 2).alias("max_duration")
    if decimals is None:
        return df.groupBy(key).agg(top, F.round(F.avg(value), 2).alias("avg_duration"))
    units = F.round(F.col(value) * 10**decimals).cast("bigint")
    sums = df.groupBy(key).agg(top, F.sum(units).alias("__sum"), F.count(value).alias("__n"))
    mean = half_up_mean(F.col("__sum"), F.col("__n"), held=decimals, kept=2)
    return sums.select(key, "max_duration", mean.alias("avg_duration"))


def charge_etl(spark, source: str, target: str, mode: str = "errorifexists") -> None:
    """CSV of charge events in, parquet of the summary out."""
    write_parquet(charge_summary(read_csv(spark, source, CHARGE_EVENTS)), target, mode)


def keyed_sum(df: DataFrame, key: str, value: str, out: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(out))


def global_sum(df: DataFrame, value: str, out: str = "total") -> DataFrame:
    return df.agg(F.sum(value).alias(out))


def count_matching(df: DataFrame, key: str, condition: Column, out: str = "n") -> DataFrame:
    """Rows per key that meet ``condition``; a key without any has 0."""
    return df.groupBy(key).agg(F.count_if(condition).alias(out))
