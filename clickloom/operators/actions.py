"""The action log: which kind of action a row is, and counts per category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.sources.schemas import NOT_A_CLICK


def is_click() -> Column:
    return F.col("click_category_id") != NOT_A_CLICK


def clicks(actions: DataFrame) -> DataFrame:
    return actions.where(is_click())


def with_action_type(actions: DataFrame) -> DataFrame:
    """Add ``action_type``; the first kind that fits wins, NULL if none does."""
    kind = (
        F.when(is_click(), "click")
        .when(F.col("order_category_ids").isNotNull(), "order")
        .when(F.col("pay_category_ids").isNotNull(), "pay")
        .when(F.col("search_keyword").isNotNull(), "search")
    )
    return actions.withColumn("action_type", kind)


def _tokens(column: str, sep: str = ",") -> Column:
    """The ids of a list in text; NULL, and so none, for an empty one."""
    return F.split(F.nullif(F.col(column), F.lit("")), rf"\Q{sep}\E")


def explode_ids(df: DataFrame, column: str, out: str = "id", sep: str = ",") -> DataFrame:
    """One row per id of a list parted by ``sep`` (plain text), as ``bigint``; a NULL or empty list gives
    no row and an id that is no number becomes NULL."""
    tokens = df.withColumn(out, F.explode(_tokens(column, sep)))
    return tokens.withColumn(out, F.col(out).try_cast("bigint"))


def explode_action_ids(actions: DataFrame) -> DataFrame:
    """One row per (action, category touched): columns of ``actions``,
    ``action_type`` and ``category_id``.  Searches touch no category, nor do empty lists."""
    is_click_row = F.col("action_type") == "click"
    tokens = (
        F.when(is_click_row, F.array(F.lit("")))
        .when(F.col("action_type") == "order", _tokens("order_category_ids"))
        .when(F.col("action_type") == "pay", _tokens("pay_category_ids"))
    )
    category = F.when(is_click_row, F.col("click_category_id")).otherwise(
        F.col("category_id").try_cast("bigint")
    )
    return (
        with_action_type(actions)
        .withColumn("category_id", F.explode(tokens))
        .withColumn("category_id", category)
    )


def action_counts(actions: DataFrame, key: str = "category_id") -> DataFrame:
    """Clicks, orders and payments per category in one pass and one shuffle."""

    def of(kind: str, name: str) -> Column:
        return F.count_if(F.col("action_type") == kind).alias(name)

    return (
        explode_action_ids(actions)
        .groupBy(F.col("category_id").alias(key))
        .agg(of("click", "click_count"), of("order", "order_count"), of("pay", "pay_count"))
    )


def full_outer_counts(actions: DataFrame) -> DataFrame:
    """The same counts from three count tables joined full outer.

    Each of the three columns is counted on its own, so a row that were click
    and order at once would count in both.  ``action_counts`` reads the input
    once; this form reads it three times.
    """

    def count(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("category_id").agg(F.count(F.lit(1)).alias(name))

    clicked = clicks(actions).select(F.col("click_category_id").alias("category_id"))
    ordered = explode_ids(actions, "order_category_ids", "category_id").select("category_id")
    paid = explode_ids(actions, "pay_category_ids", "category_id").select("category_id")
    joined = (
        count(clicked, "click_count")
        .join(count(ordered, "order_count"), "category_id", "full_outer")
        .join(count(paid, "pay_count"), "category_id", "full_outer")
    )
    return joined.select(
        "category_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("click_count", "order_count", "pay_count")],
    )
