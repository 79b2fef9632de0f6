"""The driver's parquet tables, and their reading as an action log and a star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources.schemas import NOT_A_CLICK

# Which event types stand for which action; other events are neither.
CLICK_EVENT = "view"
ORDER_EVENT = "click"
PAY_EVENT = "purchase"


# Stated so that opening a table needs no job to read a file footer first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as page visits: session_id, page_id and the unique order ts, event_id."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("session_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("page_id"),
        "ts",
        "event_id",
    )


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the thirteen columns of the action log.  Orders and payments name no, one, two or three ids."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    ids = table(spark, sf_dir, "events").withColumn("k", k)
    number = F.pmod("event_id", F.lit(4)).cast("int")
    every = [F.pmod(F.col("k").cast("bigint") + 7 * j, F.lit(100)).cast("string") for j in range(3)]
    several = F.array_join(F.slice(F.array(*every), F.lit(1), number), ",")
    click_id = F.when(kind == CLICK_EVENT, F.col("k").cast("bigint")).otherwise(F.lit(NOT_A_CLICK))
    return ids.select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        "user_id",
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("session_id"),
        F.col("k").cast("bigint").alias("page_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        F.when(kind == "signup", kind).alias("search_keyword"),
        click_id.cast("bigint").alias("click_category_id"),
        click_id.cast("bigint").alias("click_product_id"),
        F.when(kind == ORDER_EVENT, several).alias("order_category_ids"),
        F.when(kind == ORDER_EVENT, several).alias("order_product_ids"),
        F.when(kind == PAY_EVENT, several).alias("pay_category_ids"),
        F.when(kind == PAY_EVENT, several).alias("pay_product_ids"),
        F.pmod("user_id", F.lit(25)).alias("city_id"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as product clicks: the customer's nation is the city, the part
    the product."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    buyers = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return items.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("c_nationkey").cast("bigint").alias("city_id"),
        F.col("l_partkey").alias("click_product_id"),
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as cities, regions as areas."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )
