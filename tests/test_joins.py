"""That joins are what they are called, and stay right when they are cut."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.operators import joins, sized
from clickloom.plans.catalogue import all_queries

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    """The plan that ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def set_conf(spark):
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def no_broadcast(set_conf):
    set_conf("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.mark.parametrize(
    "name, operator",
    [
        ("join_inner", "SortMergeJoin"),
        ("join_broadcast", "BroadcastHashJoin"),
        ("join_broadcast_checked", "BroadcastHashJoin"),
        ("join_shuffle_hash", "ShuffledHashJoin"),
    ],
)
def test_queries_run_the_join_they_name(spark, no_broadcast, name, operator):
    """Also where Spark itself would broadcast nothing."""
    plan = plan_of(all_queries()[name](spark, SF_DIR))
    assert [j for j in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin") if j in plan] == [operator]


def test_broadcast_join_has_all_orders(spark, set_conf, tmp_path):
    """Of 1,500 customers, and of more than are broadcast."""
    small, large = "/root/testdata/sf0.01", str(tmp_path)
    pairs = spark.read.parquet(f"{small}/orders.parquet").join(
        spark.read.parquet(f"{small}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey")
    )
    rows = pairs.selectExpr("o_custkey", "o_orderkey", "o_orderpriority", "c_name", "c_mktsegment").collect()
    assert len(rows) == 15_000
    made = all_queries()["join_broadcast"](spark, small)
    assert Counter(map(tuple, made.collect())) == Counter(map(tuple, rows))

    set_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    more = spark.read.parquet(f"{small}/customer.parquet").crossJoin(spark.range(140).withColumnRenamed("id", "by"))
    more = more.withColumn("c_custkey", F.col("c_custkey") + 1500 * F.col("by")).drop("by")
    more.write.parquet(f"{large}/customer.parquet")
    spark.read.parquet(f"{small}/orders.parquet").write.parquet(f"{large}/orders.parquet")
    made = all_queries()["join_broadcast"](spark, large)
    assert "SortMergeJoin" in plan_of(made)
    assert Counter(map(tuple, made.collect())) == Counter(map(tuple, rows))


def test_broadcast_needs_a_proof(spark, no_broadcast, monkeypatch):
    a = spark.range(100).withColumnRenamed("id", "key")
    b = spark.range(50).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    proven = [
        sized.first_rows(b, ["key"], 20),
        sized.at_most(b, 50),
        sized.domain(b, ["key"], 50),
        sized.constant(spark, [(3, "x")], "key bigint, name string"),
    ]
    for side, n in zip(proven, (20, 50, 50, 1)):
        assert isinstance(side, sized.Bounded)
        made = joins.join(a, side, "key", strategy="broadcast")
        assert "BroadcastHashJoin" in plan_of(made) and made.count() == n
    # Without one, or with more rows than thought, both sides are sorted.
    for side in (b, sized.at_most(b, 49), sized.domain(b, ["twice", "key"], 49)):
        assert not isinstance(side, sized.Bounded)
        made = joins.join(a, side, "key", strategy="broadcast")
        assert "SortMergeJoin" in plan_of(made) and made.count() == 50
    monkeypatch.setattr(joins, "MOST_BROADCAST_ROWS", 10)
    assert "SortMergeJoin" in plan_of(joins.join(a, sized.first_rows(b, ["key"], 20), "key", strategy="broadcast"))


def sides(spark):
    r = random.Random(2)
    a = [(None if r.random() < 0.2 else r.choice([1, 1, 1, 1, 2, 3, 4, 5]), i) for i in range(900)]
    b = [(None if r.random() < 0.1 else r.choice([1, 1, 1, 2, 3, 7]), f"n{i % 40}") for i in range(150)]
    return a, b, spark.createDataFrame(a, "key int, x int").repartition(5), spark.createDataFrame(b, "key int, y string").repartition(3)


@pytest.mark.parametrize("sizes", [(10**6, 10**6), (20, 10**6), (20, 50), (10**6, 50)])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti", "full_outer", "right"])
def test_cut_joins_are_right(spark, how, sizes):
    a, b, left, right = sides(spark)
    got = joins.hash_join(left, right, "key", how, *sizes)
    want = left.join(right.hint("merge"), "key", how)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_hash_tables_stay_small(spark, set_conf):
    """With a key of 700 rows in b, no partition holds many more than build_rows."""
    a = spark.range(200).select((F.col("id") % 9).alias("key"), "id")
    b = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id") % 9).cast("bigint").alias("key"), F.col("id").alias("y"))
    set_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    made = joins.hash_join(a, b, "key", build_rows=50)
    assert "ShuffledHashJoin" in plan_of(made)
    assert made.count() == a.join(b, "key").count()
    parts = made.select("y", F.spark_partition_id().alias("p")).distinct().groupBy("p").count()
    assert parts.agg(F.max("count")).first()[0] <= 150


def test_a_hot_key_is_split(spark, set_conf, no_broadcast):
    """A third of the rows of a have one key; adaptive execution splits its partition."""
    set_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    set_conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k")
    set_conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    set_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    a = spark.range(0, 200_000, 1, 16).select(key.alias("key"), F.xxhash64("id").alias("x"))
    b = spark.range(1000).select(F.col("id").alias("key"), F.xxhash64("id").alias("y"))
    made = joins.join(a, b, "key", strategy="shuffle_hash")
    plan = plan_of(made)
    assert "ShuffledHashJoin(skew=true)" in plan, plan[:600]
    # All columns are read, or the partitions would be too small to be split.
    by_task = made.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.bit_xor("x"), F.bit_xor("y"))
    sizes = [r.n for r in by_task.collect()]
    assert sum(sizes) == 200_000 and max(sizes) < 200_000 / 6


def test_a_hot_key_is_cut_where_partitions_are_set(spark, set_conf):
    set_conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    a = spark.range(0, 60_000, 1, 16).select(key.cast("bigint").alias("key"), "id")
    b = spark.range(1000).select(F.col("id").alias("key"), F.xxhash64("id").alias("y"))
    made = joins.hash_join(a, b, "key", build_rows=100, probe_rows=1000)
    sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) < 10_000
