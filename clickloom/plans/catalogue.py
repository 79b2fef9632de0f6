"""One query per operator of the library, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import grouped, udfs
from clickloom.operators import actions as act
from clickloom.operators import funnel, joins, merge, ordered, ranking, sales, sized, summary, text
from clickloom.plans import tables as t
from clickloom.sources import readers, writers
from clickloom.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

# Groups above this many rows take the split way in the ``*_split`` queries.
SPLIT_ROWS = 66


def query(f: Query) -> Query:
    _REGISTRY[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- sources and sinks ------------------------------------------------------


@query
def scan_text_lines(spark, d):
    path = scratch_path(spark, "lines")
    writers.write_text(t.table(spark, d, "documents").select("text"), path)
    size = F.length("value").cast("bigint")
    return readers.read_lines(spark, path).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("value") == "").alias("n_empty"),
        F.sum(size).alias("n_chars"),
        F.max(size).alias("longest"),
    )


def _log_with_bad_lines(spark, d):
    """The action log as text, with lines that break off, run on, or have a word for a number."""
    rows = t.actions(spark, d)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in rows.columns]
    at = rows.columns.index("page_id")
    kind = F.pmod("user_id", F.lit(50))
    odd = [
        rows.where(kind == 0).select(F.concat_ws("_", *fields[:5])),
        rows.where(kind == 1).select(F.concat_ws("_", *fields, F.lit("more"))),
        rows.where(kind == 2).select(F.concat_ws("_", *fields[:at], F.lit("page"), *fields[at + 1 :])),
    ]
    lines = rows.select(F.concat_ws("_", *fields).alias("line"))
    for more in odd:
        lines = lines.union(more)
    path = scratch_path(spark, "actions")
    writers.write_text(lines, path)
    return readers.load_action_log(spark, path, scratch_path(spark, "loaded"), tolerated_share=0.5)


@query
def scan_action_log(spark, d):
    return _log_with_bad_lines(spark, d).good


@query
def scan_action_log_bad(spark, d):
    return _log_with_bad_lines(spark, d).bad.select("line")


@query
def scan_csv(spark, d):
    path = scratch_path(spark, "csv")
    writers.write_csv(t.table(spark, d, "part"), path)
    schema = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    return readers.read_csv(spark, path, schema)


@query
def scan_tsv(spark, d):
    path = scratch_path(spark, "tsv")
    writers.write_csv(t.table(spark, d, "supplier"), path, sep="\t")
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    return readers.read_tsv(spark, path, schema)


@query
def scan_json(spark, d):
    path = scratch_path(spark, "json")
    t.table(spark, d, "customer").write.json(path)
    people = readers.read_json(spark, path)
    return people.select("c_custkey", "c_name", "c_acctbal")


@query
def values_scan(spark, d):
    rows = [(t.CLICK_EVENT, "click"), (t.ORDER_EVENT, "order"), (t.PAY_EVENT, "pay")]
    names = readers.values(spark, rows, "event_type string, action string")
    events = t.table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return events.join(F.broadcast(names), "event_type").select("event_type", "action", "n")


def _orders_by_status(spark, d):
    return t.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )


@query
def sink_text(spark, d):
    path = scratch_path(spark, "orders")
    writers.write_text(_orders_by_status(spark, d), path)
    return readers.read_lines(spark, path).select(F.col("value").alias("line"))


@query
def sink_text_single(spark, d):
    """Orders per customer as one ordered file."""
    path = scratch_path(spark, "one_file")
    per_customer = t.table(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last")
    )
    writers.write_text(per_customer, path, single_file=True, order=["o_custkey"])
    return readers.read_lines(spark, path).select(F.col("value").alias("line"))


@query
def sink_parquet(spark, d):
    path = scratch_path(spark, "summary")
    durations = t.table(spark, d, "lineitem").select("l_partkey", "l_extendedprice")
    writers.write_parquet(summary.charge_summary(durations, "l_partkey", "l_extendedprice", 2), path)
    return spark.read.parquet(path)


# --- projection, filters, row expansion -------------------------------------


@query
def project_columns(spark, d):
    return t.table(spark, d, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("kind")
    )


@query
def filter_clicks(spark, d):
    return act.clicks(t.actions(spark, d)).select("session_id", "action_time", "click_category_id")


@query
def filter_in_set(spark, d):
    return joins.keep_members(t.visits(spark, d), "page_id", funnel.DEFAULT_PAGES).select(
        "event_id", "session_id", "page_id"
    )


@query
def sql_view_filter(spark, d):
    t.table(spark, d, "customer").createOrReplaceTempView("people")
    return spark.sql("SELECT c_custkey, c_acctbal FROM people WHERE c_acctbal >= 1000")


@query
def dsl_filter(spark, d):
    people = t.table(spark, d, "customer")
    return people.where(people.c_acctbal >= 1000).select("c_custkey", "c_acctbal")


@query
def explode_ids(spark, d):
    items = t.table(spark, d, "lineitem").select(
        F.when(
            F.col("l_returnflag") != "N", F.concat_ws(",", "l_orderkey", "l_partkey", "l_suppkey")
        ).alias("ids")
    )
    return act.explode_ids(items, "ids").groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query
def word_count(spark, d):
    return text.word_count(t.table(spark, d, "documents"), "text", k=10)


@query
def word_count_all(spark, d):
    return text.word_count(t.table(spark, d, "documents"), "text")


# --- aggregates --------------------------------------------------------------


@query
def keyed_sum(spark, d):
    return summary.keyed_sum(t.table(spark, d, "lineitem"), "l_suppkey", "l_quantity")


@query
def global_sum(spark, d):
    return summary.global_sum(t.table(spark, d, "lineitem"), "l_quantity")


@query
def charge_summary(spark, d):
    return summary.charge_summary(
        t.table(spark, d, "lineitem"), "l_partkey", "l_extendedprice", decimals=2
    )


@query
def charge_summary_plain(spark, d):
    return summary.charge_summary(t.table(spark, d, "lineitem"), "l_suppkey", "l_quantity")


@query
def action_counts(spark, d):
    return act.action_counts(t.actions(spark, d))


@query
def full_outer_counts(spark, d):
    return act.full_outer_counts(t.actions(spark, d))


def _rated_orders(spark, d):
    """Orders of which two priorities count as none, so that some customers have NULLs alone."""
    orders = t.table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey")
    rated = F.when(~F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"), F.col("o_orderpriority"))
    return orders.withColumn("o_orderpriority", rated)


@query
def collect_list_agg(spark, d):
    lists = ordered.ordered_lists(
        _rated_orders(spark, d), ["o_custkey"], "o_orderpriority", ["o_orderpriority", "o_orderkey"]
    )
    return lists.select("o_custkey", "part", F.array_join("values", ",").alias("priorities"))


@query
def collect_list_nulls(spark, d):
    """NULLs kept in place, in parts of three elements, from split groups."""
    lists = ordered.ordered_lists(
        _rated_orders(spark, d), ["o_custkey"], "o_orderpriority", ["o_orderkey"], list_rows=3, hot_rows=8, nulls=True
    )
    return lists.select("o_custkey", "part", F.array_join("values", ",", "none").alias("priorities"))


@query
def collect_list_split(spark, d):
    """The lists cut into parts of at most 5, most of them from split groups."""
    lists = ordered.ordered_lists(
        t.table(spark, d, "orders").select("o_custkey", "o_orderkey"),
        ["o_custkey"],
        "o_orderkey",
        ["o_orderkey"],
        list_rows=5,
        hot_rows=8,
    )
    return lists.select("o_custkey", "part", F.array_join("values", ",").alias("order_keys"))


@query
def count_matching(spark, d):
    orders = t.table(spark, d, "orders")
    return summary.count_matching(orders, "o_custkey", F.col("o_orderpriority") == "1-URGENT")


def _count_urgent(priorities):
    return sum(p == "1-URGENT" for p in priorities)


@query
def udf_over_list(spark, d):
    return udfs.over_lists(t.table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", _count_urgent)


@query
def udf_over_list_sql(spark, d):
    grouped.register_fold(spark, "count_urgent", _count_urgent, "o_custkey bigint", "n bigint")
    t.table(spark, d, "orders").createOrReplaceTempView("orders_udf")
    return spark.sql(
        "SELECT * FROM count_urgent(TABLE(SELECT o_custkey, o_orderpriority FROM orders_udf) "
        "PARTITION BY pmod(hash(o_custkey), 4096) ORDER BY o_custkey)"
    )


@query
def udf_over_array(spark, d):
    """A Python function of a column that holds lists: the span of each embedding."""

    def span(values):
        return max(values) - min(values)

    vectors = t.table(spark, d, "embeddings")
    spans = vectors.select("vec_id", udfs.list_function(span, "double")("embedding").alias("span"))
    return spans.select("vec_id", F.round("span", 4).alias("span"))


@query
def longest_gap(spark, d):
    """The longest pause between two events of a user, by a function over their times in order."""

    def longest(times):
        most, before = 0, None
        for now in times:
            if before is not None:
                most = max(most, now - before)
            before = now
        return most

    seconds = t.table(spark, d, "events").select(
        "user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at")
    )
    return grouped.fold_values(seconds, ["user_id"], "at", longest, out="seconds", order=["at"])


@query
def fold_in_batches(spark, d):
    return udfs.fold_in_batches(
        t.table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", _count_urgent, "sum"
    )


@query
def udaf_mean(spark, d):
    means = udfs.mean_by_key(t.table(spark, d, "events"), ["event_type"], "value")
    return means.select("event_type", F.round("mean", 4).alias("mean"))


@query
def scalar_udfs(spark, d):
    return t.table(spark, d, "customer").select(
        "c_custkey",
        udfs.text_length("c_name").alias("name_length"),
        udfs.to_upper("c_name").alias("name_upper"),
        udfs.add_one("c_custkey").alias("next_key"),
    )


@query
def scalar_builtins(spark, d):
    return t.table(spark, d, "customer").select(
        "c_custkey",
        F.length("c_name").alias("name_length"),
        F.upper("c_name").alias("name_upper"),
        (F.col("c_custkey") + 1).alias("next_key"),
    )


@query
def udf_sql(spark, d):
    udfs.register_all(spark)
    t.table(spark, d, "customer").createOrReplaceTempView("people_udf")
    return spark.sql(
        "SELECT to_upper(c_name) AS name_upper, add_one(c_custkey) AS next_key, c_acctbal "
        "FROM people_udf WHERE c_acctbal >= 1000"
    )


# --- joins and union ----------------------------------------------------------


def _orders_with_customer(spark, d, strategy, most=None):
    orders = t.table(spark, d, "orders").select(
        F.col("o_custkey").alias("custkey"), "o_orderkey", "o_orderpriority"
    )
    customers = t.table(spark, d, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment"
    )
    if most:
        customers = sized.at_most(customers, most)
    return joins.join(orders, customers, "custkey", "inner", strategy)


@query
def join_inner(spark, d):
    return _orders_with_customer(spark, d, "merge")


@query
def join_broadcast(spark, d):
    """All orders with their customers.  The customers are broadcast if a count shows them to be few, and
    merged otherwise."""
    return _orders_with_customer(spark, d, "broadcast", most=200_000)


@query
def join_broadcast_checked(spark, d):
    """Each part with the number of parts of its brand; the list of brands is checked to be short."""
    part = t.table(spark, d, "part")
    brands = sized.at_most(part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_parts")), 10_000)
    return joins.join(part.select("p_partkey", "p_brand"), brands, "p_brand", "inner", "broadcast")


@query
def join_shuffle_hash(spark, d):
    return _orders_with_customer(spark, d, "shuffle_hash")


@query
def join_shuffle_hash_cut(spark, d):
    """Orders beside the counts of all priorities of their status.  Hash tables may hold two rows
    only, so that keys of both sides are cut and there are more partitions."""
    orders = t.table(spark, d, "orders")
    counts = orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    rows = orders.select("o_orderstatus", "o_orderkey")
    return joins.hash_join(rows, counts, "o_orderstatus", "inner", build_rows=2, probe_rows=1000)


@query
def join_text_files(spark, d):
    a, b, out = (scratch_path(spark, name) for name in ("a", "b", "joined"))
    orders = t.table(spark, d, "orders")
    writers.write_text(orders.select("o_custkey", "o_orderkey", "o_orderpriority"), a)
    writers.write_text(t.table(spark, d, "customer").select("c_custkey", "c_mktsegment"), b)
    joins.join_text_files(
        spark, a, ["custkey", "orderkey", "priority"], b, ["custkey", "segment"], out
    )
    return readers.read_lines(spark, out).select(F.col("value").alias("line"))


@query
def semi_join_topk(spark, d):
    return funnel.clicks_in_hot_categories(t.actions(spark, d)).select(
        "session_id", "action_time", "click_category_id"
    )


@query
def star_join(spark, d):
    return sales.star_join(t.sales(spark, d), t.cities(spark, d), t.products(spark, d))


@query
def union_all(spark, d):
    customers = t.table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_mktsegment"
    )
    suppliers = t.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    return joins.union_all(customers, suppliers)


# --- ranking and windows ------------------------------------------------------


@query
def top_k_per_group(spark, d):
    items = t.table(spark, d, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    return ranking.top_k_per_group(items, ["l_suppkey"], order, 3)


@query
def top_k_per_group_steps(spark, d):
    """As ``top_k_per_group`` with a k for which tasks trim their rows and groups have a cut-off."""
    items = t.table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    return ranking.top_k_per_group(items, ["o_orderstatus"], ["o_totalprice desc", "o_orderkey"], 2000)


@query
def top_k_per_group_large(spark, d):
    """As ``top_k_per_group_steps`` with a k beyond what one task should hand on, and many ties."""
    items = t.table(spark, d, "lineitem").select("l_linestatus", "l_quantity", "l_orderkey", "l_linenumber")
    order = ["l_quantity desc", "l_orderkey", "l_linenumber"]
    return ranking.top_k_per_group(items, ["l_linestatus"], order, 100_000)


def _adjacent(spark, d, **options):
    pairs = funnel.adjacent_pairs(t.visits(spark, d), ["ts", "event_id"], **options)
    return pairs.select("session_id", "event_id", "page_id", "next_page_id")


@query
def adjacent_pairs(spark, d):
    return _adjacent(spark, d)


@query
def adjacent_pairs_split(spark, d):
    return _adjacent(spark, d, hot_rows=SPLIT_ROWS)


@query
def session_path(spark, d):
    return funnel.session_path(t.visits(spark, d), ["ts", "event_id"])


@query
def session_path_split(spark, d):
    return funnel.session_path(t.visits(spark, d), ["ts", "event_id"], hot_rows=SPLIT_ROWS)


# --- composite queries ---------------------------------------------------------


@query
def hot_categories(spark, d):
    return funnel.hot_categories(t.actions(spark, d), 10)


@query
def category_sessions(spark, d):
    return funnel.category_sessions(t.actions(spark, d), 10, 10)


def _flow(spark, d, **options):
    return funnel.page_flow(t.visits(spark, d), order=("ts", "event_id"), **options)


@query
def page_flow_filtered(spark, d):
    return _flow(spark, d)


@query
def page_flow_strict(spark, d):
    return _flow(spark, d, adjacency="strict")


@query
def page_flow_configured(spark, d):
    return _flow(spark, d, adjacency="strict", pairs="configured")


@query
def page_flow_split(spark, d):
    return _flow(spark, d, adjacency="strict", hot_rows=SPLIT_ROWS)


def _star(spark, d):
    return t.sales(spark, d), t.cities(spark, d), t.products(spark, d)


@query
def area_product_clicks(spark, d):
    return sales.area_product_clicks(*_star(spark, d))


@query
def area_top3(spark, d):
    return sales.area_top_products(*_star(spark, d), k=3, remark=None)


@query
def area_top3_remark(spark, d):
    return sales.area_top_products(*_star(spark, d), k=3, remark="exact")


@query
def area_top3_remark_large_products(spark, d):
    """As ``area_top3_remark``, on the way taken when products are not broadcast."""
    return sales.area_top_products(*_star(spark, d), k=3, remark="exact")


@query
def area_top3_remark_legacy(spark, d):
    return sales.area_top_products(*_star(spark, d), k=3, remark="legacy")


# --- merges ---------------------------------------------------------------------


def _merge(spark, d, value, policy, **options):
    orders = t.table(spark, d, "orders").select("o_custkey", value, "o_orderdate", "o_orderkey")
    return merge.merge_by_key(
        orders, "o_custkey", value, policy, ["o_orderdate", "o_orderkey"], **options
    )


@query
def merge_replace(spark, d):
    return _merge(spark, d, "o_orderstatus", "replace")


@query
def merge_keep(spark, d):
    return _merge(spark, d, "o_orderstatus", "keep")


@query
def merge_add(spark, d):
    orders = t.table(spark, d, "orders").select(
        "o_custkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    )
    return merge.merge_by_key(orders, "o_custkey", "cents", "add")


@query
def merge_list(spark, d):
    lists = _merge(spark, d, "o_orderpriority", "list")
    return lists.withColumn("o_orderpriority", F.array_join("o_orderpriority", ","))


@query
def merge_set(spark, d):
    sets = _merge(spark, d, "o_orderpriority", "set")
    return sets.withColumn("o_orderpriority", F.array_join("o_orderpriority", ","))


def _rounded(sums):
    return sums.select("label", F.col("pos").cast("bigint").alias("pos"), F.round("total", 4).alias("total"))


@query
def vector_sum(spark, d):
    vectors = t.table(spark, d, "embeddings")
    return _rounded(merge.vector_sum(vectors, "embedding", ["label"], initial=[1.0, 2.0, 3.0]))


@query
def vector_sum_fixed(spark, d):
    vectors = t.table(spark, d, "embeddings")
    return _rounded(merge.vector_sum(vectors, "embedding", ["label"], width=64))
