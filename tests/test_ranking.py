"""Top-k per group for a large k."""

import math
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import ranking


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def asc(v):
    """NULL first, NaN last."""
    return (0,) if v is None else (2,) if v != v else (1, v)


def data(n, seed=4):
    rng = random.Random(seed)
    found = []
    for i in range(n):
        g = rng.choice(["hot"] * 6 + ["warm", "cool", None])
        v = rng.choice([None, float("nan"), 1.0, 2.0, *[rng.uniform(-5, 5) for _ in range(6)]])
        found.append((g, v, i))
    return found


def best(found, k, falling):
    want = []
    for g in {r[0] for r in found}:
        of = sorted((r for r in found if r[0] == g), key=lambda r: r[2])
        of.sort(key=lambda r: asc(r[1]), reverse=falling)
        want += [(*r, i) for i, r in enumerate(of[:k], start=1)]
    return sorted(map(str, want))


@pytest.mark.parametrize("k", [3, 50, 300, 5000])
@pytest.mark.parametrize("way", ["asc", "desc"])
def test_large_k(spark, k, way):
    found = data(3000)
    df = spark.createDataFrame(found, "g string, v double, id bigint").repartition(7)
    got = ranking.top_k_per_group(df, ["g"], [f"v {way}", "id"], k, one_step_k=2)
    assert rows(got) == best(found, k, way == "desc")
    as_columns = [F.desc("v") if way == "desc" else F.asc("v"), F.asc("id")]
    assert rows(ranking.top_k_per_group(df, ["g"], as_columns, k, one_step_k=2)) == best(found, k, way == "desc")


def test_masses_of_ties_pass_the_cut(spark):
    df = spark.range(6000).select((F.col("id") % 2).alias("g"), F.lit(1).alias("v"), F.col("id")).repartition(6)
    got = ranking.top_k_per_group(df, ["g"], ["v desc", "id desc"], 400, one_step_k=2)
    assert sorted((r.g, r.id) for r in got.collect()) == sorted((i % 2, i) for i in range(5200, 6000))
    tied = ranking.top_k_per_group(df, ["g"], ["v"], 400, one_step_k=2)
    assert [r["count"] for r in tied.groupBy("g").count().collect()] == [400, 400]


def shipped(df, k):
    """Rows of each group up to its cut-off, of those that tasks have kept."""
    kept = ranking.first_of_each_task(df, ["g"], ["v", "id"], k)
    cut = ranking.cut_offs(df, ["g"], ["v", "id"], k).withColumnsRenamed({"g": "h", "v": "w", "id": "i"})
    met = kept.join(cut, kept.g == cut.h).where("v < w or (v = w and id <= i)")
    return {r.g: r["count"] for r in met.groupBy("g").count().collect()}


@pytest.mark.parametrize("k", [2000, 100_000])
def test_few_more_than_k_rows_are_exchanged(spark, k):
    tasks = 20
    df = spark.range(0, 3_000_000, 1, tasks).select(
        (F.col("id") % 3 == 0).cast("int").alias("g"), F.xxhash64("id").alias("v"), "id"
    )
    got = shipped(df, k)
    assert set(got) == {0, 1}
    for n in got.values():
        assert k <= n <= k + (tasks + 1) * (math.isqrt(k) + 1)
    plan = ranking.top_k_per_group(df, ["g"], ["v", "id"], k)._jdf.queryExecution().executedPlan().toString()
    # The rows meet the cut-offs by broadcast before the one exchange by group.
    assert plan.index("BroadcastHashJoin") > plan.index("hashpartitioning(g")


def test_groups_without_cut_off_are_whole(spark, monkeypatch):
    monkeypatch.setattr(ranking, "MOST_CUT_GROUPS", 1)
    found = data(2000, 9)
    df = spark.createDataFrame(found, "g string, v double, id bigint").repartition(5)
    got = ranking.top_k_per_group(df, ["g"], ["v", "id"], 100, one_step_k=2)
    assert rows(got) == best(found, 100, False)


def test_order_by_name(spark):
    df = spark.range(5)
    assert [r.id for r in ranking.top_k(df, ["id desc"], 2).collect()] == [4, 3]
    with pytest.raises(ValueError):
        ranking.top_k_per_group(df, ["id"], ["id upwards"], 2)
    assert rows(ranking.top_k_per_group(df.limit(0), ["id"], ["id"], 500)) == []
