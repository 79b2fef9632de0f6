"""Product clicks per area, with a text of each product's main cities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.exprs import percent_text
from clickloom.operators.ranking import top_k_per_group

# Fixed value: the label for all cities after the second.
OTHER = "其他"


def star_join(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """Product clicks with the area and city they came from and the product name.

    Spark broadcasts a dimension while it is below the size threshold.
    """
    return (
        actions.where(F.col("click_product_id") > -1)
        .join(cities, "city_id")
        .join(products, F.col("click_product_id") == F.col("product_id"))
        .select("area", "city_name", "click_product_id", "product_name")
    )


def _named_counts(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """(area, product_name, city_name, n), counted per city id and product before any
    join: a popular product is then no hot join key, as it has one row per city."""
    chosen = actions.where(F.col("click_product_id") > -1)
    pairs = chosen.groupBy("city_id", "click_product_id").agg(F.count(F.lit(1)).alias("n"))
    products = products.select("product_id", "product_name")
    named = pairs.join(products, F.col("click_product_id") == F.col("product_id"))
    return named.join(cities, "city_id").select("area", "product_name", "city_name", "n")


def city_counts(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """Clicks per (area, product_name, city_name), column ``n``.

    The rows are counted already, so they are hashed by (area, product_name) once: what
    comes after, per city or per product, needs no other exchange.
    """
    counts = _named_counts(actions, cities, products).repartition("area", "product_name")
    return counts.groupBy("area", "product_name", "city_name").agg(F.sum("n").alias("n"))


def area_product_clicks(actions: DataFrame, cities: DataFrame, products: DataFrame) -> DataFrame:
    """Clicks per (area, product_name), column ``click_count``."""
    counts = _named_counts(actions, cities, products)
    return counts.groupBy("area", "product_name").agg(F.sum("n").alias("click_count"))


def _remark(mode: str, other: str) -> Column:
    """Text over the columns made by ``share_summary``."""
    lost = {"exact": 0, "legacy": 1}[mode]
    total = F.col("total")

    def segment(label: Column, n: Column) -> Column:
        return F.concat(label, F.lit(":"), percent_text(n, total))

    first = F.col("first_n") - lost
    second = F.col("second_n") - lost
    rest = total - first - F.coalesce(second, F.lit(0))
    show_rest = F.col("items") > (2 if mode == "exact" else 1)
    # A segment that does not apply is NULL, and concat_ws leaves it out.
    return F.concat_ws(
        ",",
        segment(F.col("first_item"), first),
        segment(F.col("second_item"), second),
        F.when(show_rest, segment(F.lit(other), rest)),
    )


def share_summary(counts: DataFrame, group: Sequence[str], item: str, n: str = "n") -> DataFrame:
    """Per group: ``total``, number of ``items`` and the two largest items.

    Works on counted rows, so a group is as large as its number of items.
    """
    w = Window.partitionBy(*group).orderBy(F.desc(n), F.asc(item))
    ranked = counts.withColumn("__rn", F.row_number().over(w))

    def pick(place: int, column: str) -> Column:
        return F.max(F.when(F.col("__rn") == place, F.col(column)))

    return ranked.groupBy(*group).agg(
        F.sum(n).alias("total"),
        F.count(F.lit(1)).alias("items"),
        pick(1, item).alias("first_item"),
        pick(1, n).alias("first_n"),
        pick(2, item).alias("second_item"),
        pick(2, n).alias("second_n"),
    )


def share_remark(
    counts: DataFrame,
    group: Sequence[str],
    item: str,
    n: str = "n",
    mode: str = "exact",
    other: str = OTHER,
) -> DataFrame:
    """Per group ``total`` and ``remark``, e.g. ``A:50.0%,B:30.0%,其他:20.0%``.

    ``exact`` uses the true counts and names the rest only if there are three or
    more items.  ``legacy`` counts every item one short, gives the difference to
    the rest and always names the rest from two items on.
    """
    return share_summary(counts, group, item, n).select(
        *group, "total", _remark(mode, other).alias("remark")
    )


def area_top_products(
    actions: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    k: int = 3,
    remark: str | None = "exact",
    other: str = OTHER,
) -> DataFrame:
    """Top ``k`` products of each area by clicks: area, product_name,
    click_count, city_remark (unless ``remark`` is None), rank."""
    order = [F.desc("click_count"), F.asc("product_name")]
    if remark is None:
        counts = area_product_clicks(actions, cities, products)
        return top_k_per_group(counts, ["area"], order, k)
    counts = city_counts(actions, cities, products)
    summary = share_summary(counts, ["area", "product_name"], "city_name")
    ranked = summary.withColumnRenamed("total", "click_count")
    top = top_k_per_group(ranked, ["area"], order, k).withColumnRenamed("click_count", "total")
    return top.select(
        "area",
        "product_name",
        F.col("total").alias("click_count"),
        _remark(remark, other).alias("city_remark"),
        "rank",
    )
