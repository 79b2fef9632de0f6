"""Joins, ranking, merges, vector sums and user functions."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickloom.functions import udfs
from clickloom.functions.exprs import percent_text
from clickloom.operators import joins, merge, ranking

A = [("1", "a", "27"), ("2", "b", "24"), ("2", "b2", "25"), ("3", "c", "23"), (None, "n", "1")]
B = [("1", "m"), ("2", "f"), ("2", "f2"), ("4", "f"), (None, "x")]
JOINED = [
    ("1", "a", "27", "m"),
    ("2", "b", "24", "f"),
    ("2", "b", "24", "f2"),
    ("2", "b2", "25", "f"),
    ("2", "b2", "25", "f2"),
]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def tables(spark):
    return (
        spark.createDataFrame(A, "key string, name string, age string"),
        spark.createDataFrame(B, "key string, sex string"),
    )


@pytest.mark.parametrize("strategy", [None, "merge", "broadcast", "shuffle_hash"])
def test_join_strategies_agree(tables, strategy):
    assert rows(joins.join(*tables, "key", strategy=strategy)) == JOINED


@pytest.mark.parametrize("strategy", [None, "merge", "broadcast", "shuffle_hash"])
def test_join_of_text_files(spark, tmp_path, strategy):
    a, b, out = tmp_path / "a", tmp_path / "b", str(tmp_path / "out")
    a.write_text('7,lamp,90\n8,"desk,15\n9,rug,3\n,none,1\n6,"q",2,extra\n5,,')
    b.write_text("7,hall\n8,study\n,attic\n6,den\n5,loft")
    names = ["key", "name", "age"], ["key", "sex"]
    joins.join_text_files(spark, str(a), names[0], str(b), names[1], out, strategy)
    got = sorted(r.value for r in spark.read.text(out).collect())
    assert got == [",none,1,attic", "5,,,loft", '6,"q",2,extra,den', "7,lamp,90,hall", '8,"desk,15,study']
    with pytest.raises(ValueError):
        joins.join_text_files(spark, str(a), ["x", "y"], str(b), ["k"], out + "2")


def test_unknown_strategy(tables):
    with pytest.raises(ValueError):
        joins.join(*tables, "key", strategy="nested")


def test_full_outer(tables):
    got = joins.join(*tables, "key", "full_outer")
    assert got.count() == len(JOINED) + 2 + 2


def test_keep_members(spark):
    df = spark.range(6)
    assert rows(joins.keep_members(df, "id", [1, 4, 9])) == [(1,), (4,)]
    assert rows(joins.keep_members(df, "id", spark.range(4, 9))) == [(4,), (5,)]


def test_union_all_keeps_copies(spark):
    a = spark.createDataFrame([(1, "x")], "k bigint, a string")
    b = spark.createDataFrame([(1,), (1,)], "k bigint")
    got = joins.union_all(a, b).collect()
    assert sorted((r.k, r.a or "") for r in got) == [(1, ""), (1, ""), (1, "x")]


@pytest.mark.parametrize("one_step_k", [100, 2])
def test_top_k_per_group(spark, one_step_k):
    rng = random.Random(1)
    data = [(rng.choice("aaab"), rng.randrange(20), i) for i in range(300)]
    df = spark.createDataFrame(data, "g string, v bigint, id bigint").repartition(4)
    got = ranking.top_k_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 5, one_step_k=one_step_k)
    want = []
    for g in "ab":
        best = sorted((r for r in data if r[0] == g), key=lambda r: (-r[1], r[2]))[:5]
        want += [(*r, i) for i, r in enumerate(best, start=1)]
    assert rows(got) == sorted(want)


def test_top_k(spark):
    assert [r.id for r in ranking.top_k(spark.range(10), [F.desc("id")], 3).collect()] == [9, 8, 7]


EVENTS = [("x", 1, "a"), ("x", 2, None), ("y", 1, "c"), ("x", 0, "b"), ("y", 3, "c"), ("y", 2, "a")]


@pytest.fixture
def events(spark):
    return spark.createDataFrame(EVENTS, "k string, t bigint, v string").repartition(3)


def test_merge_replace_and_keep(events):
    assert rows(merge.merge_by_key(events, "k", "v", "replace", ["t"])) == [("x", None), ("y", "c")]
    assert rows(merge.merge_by_key(events, "k", "v", "keep", ["t"])) == [("x", "b"), ("y", "c")]
    assert rows(merge.merge_by_key(events, "k", "v", "keep", ["t", "v"])) == [("x", "b"), ("y", "c")]


def test_merge_replace_of_single_values(spark):
    df = spark.range(40, 46).select("id", F.concat("id", F.lit(" lamps")).alias("v"))
    got = rows(merge.merge_by_key(df, "id", "v", "replace", ["id"]))
    assert got == [(i, f"{i} lamps") for i in range(40, 46)]


def test_merge_add(events):
    assert rows(merge.merge_by_key(events, "k", "t", "add")) == [("x", 3), ("y", 6)]


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_merge_list_and_set(events, hot_rows):
    got = merge.merge_by_key(events, "k", "v", "list", ["t"], hot_rows=hot_rows)
    assert rows(got) == [("x", 0, ["b", "a", None]), ("y", 0, ["c", "a", "c"])]
    got = merge.merge_by_key(events, "k", "v", "set", hot_rows=hot_rows)
    assert rows(got) == [("x", 0, ["a", "b"]), ("y", 0, ["a", "c"])]


def test_merge_of_arrays(spark):
    df = spark.createDataFrame(
        [("x", 2, [3, 1]), ("x", 1, [1, 2]), ("y", 1, [])], "k string, t bigint, v array<bigint>"
    )
    assert rows(merge.merge_by_key(df, "k", "v", "list", ["t"])) == [("x", 0, [1, 2, 3, 1]), ("y", 0, [])]
    assert rows(merge.merge_by_key(df, "k", "v", "set")) == [("x", 0, [1, 2, 3]), ("y", 0, [])]
    parts = merge.merge_by_key(df, "k", "v", "list", ["t"], list_rows=3)
    assert rows(parts) == [("x", 0, [1, 2, 3]), ("x", 1, [1]), ("y", 0, [])]


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_merge_keeps_every_key(spark, hot_rows):
    df = spark.createDataFrame([("x", 1, "a"), ("y", 1, None), (None, 1, "b")], "k string, t bigint, v string")
    got = merge.merge_by_key(df, "k", "v", "set", hot_rows=hot_rows)
    assert {(r.k, r.part, tuple(r.v)) for r in got.collect()} == {("x", 0, ("a",)), ("y", 0, ()), (None, 0, ("b",))}
    arrays = spark.createDataFrame([("x", 1, [None, 1]), ("y", 1, None), ("y", 2, [])], "k string, t bigint, v array<int>")
    got = merge.merge_by_key(arrays, "k", "v", "list", ["t"], hot_rows=hot_rows)
    assert {(r.k, r.part, tuple(r.v)) for r in got.collect()} == {("x", 0, (None, 1)), ("y", 0, ())}


@pytest.mark.parametrize("width", [None, 3])
def test_vector_sum_with_a_longer_start(spark, width):
    df = spark.createDataFrame([("g", [1.0, None]), ("h", [None])], "g string, v array<double>")
    got = merge.vector_sum(df, "v", ["g"], initial=[1.0, 2.0, 3.0], width=width)
    assert sorted(map(tuple, got.collect())) == [
        ("g", 0, 2.0), ("g", 1, 2.0), ("g", 2, 3.0), ("h", 0, 1.0), ("h", 1, 2.0), ("h", 2, 3.0)
    ]
    plain = merge.vector_sum(df, "v", ["g"], width=width)
    assert sorted(map(tuple, plain.collect())) == [("g", 0, 1.0)]
    none = merge.vector_sum(df.limit(0), "v", initial=[1.0, 2.0], width=width)
    assert sorted(map(tuple, none.collect())) == [(0, 1.0), (1, 2.0)]


def test_merge_needs_policy_and_order(events):
    with pytest.raises(ValueError):
        merge.merge_by_key(events, "k", "v", "first")
    with pytest.raises(ValueError):
        merge.merge_by_key(events, "k", "v", "replace")


@pytest.mark.parametrize("width", [None, 3])
def test_vector_sum(spark, width):
    df = spark.createDataFrame([([0.5 * x, 4.0, -x],) for x in (3.0, 8.0)], "v array<double>")
    assert rows(merge.vector_sum(df, "v", width=width)) == [(0, 5.5), (1, 8.0), (2, -11.0)]
    started = merge.vector_sum(df, "v", initial=[0.5, 0.25, 10.0], width=width)
    assert rows(started) == [(0, 6.0), (1, 8.25), (2, -1.0)]


def test_vector_sum_of_any_lengths(spark):
    """Vectors of 0 to 40 elements, with NULLs, in one read and one exchange."""
    rng = random.Random(6)
    data = [(rng.choice("gh"), [rng.choice([None, 1.0, 2.5]) for _ in range(rng.randrange(41))]) for _ in range(80)]
    data += [("g", None), ("alone", None)]
    start = [float(i) for i in range(20)]
    df = spark.createDataFrame(data, "g string, v array<double>").repartition(4)
    for initial in (None, start):
        want = {}
        for g, v in data:
            for i, x in enumerate(v or []):
                if x is not None:
                    want[g, i] = want.get((g, i), 0.0) + x
            want |= {} if initial is None else {(g, i): want.get((g, i), 0.0) for i in range(20)}
        if initial:
            want = {(g, i): x + (initial[i] if i < 20 else 0.0) for (g, i), x in want.items()}
        got = merge.vector_sum(df, "v", ["g"], initial=initial)
        assert {(r.g, r.pos): r.total for r in got.collect()} == want
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("partial_sum") == 1


def test_vector_sum_by_group_and_length(spark):
    df = spark.createDataFrame(
        [("a", [1.0, 2.0]), ("a", [1.0]), ("b", [5.0])], "g string, v array<double>"
    )
    want = [("a", 0, 2.0), ("a", 1, 2.0), ("b", 0, 5.0)]
    assert rows(merge.vector_sum(df, "v", ["g"])) == want
    assert rows(merge.vector_sum(df, "v", ["g"], width=2)) == want
    with pytest.raises(Exception, match="longer than 1"):
        merge.vector_sum(df, "v", ["g"], width=1).collect()


def test_scalar_functions(spark):
    df = spark.createDataFrame(
        [(1, "Ann Oak", 40), (1, "Tomas", 55), (2, None, None), (3, "ß", 2**60 + 1)],
        "id bigint, name string, age bigint",
    )
    got = df.select(udfs.text_length("name"), udfs.to_upper("name"), udfs.add_one("age"))
    assert [tuple(r) for r in got.collect()] == [
        (7, "ANN OAK", 41), (5, "TOMAS", 56), (None, None, None), (1, "SS", 2**60 + 2),
    ]
    udfs.register_all(spark)
    df.createOrReplaceTempView("people_test")
    sql = spark.sql("SELECT to_upper(name), age FROM people_test WHERE age >= 50 AND id = 1")
    assert [tuple(r) for r in sql.collect()] == [("TOMAS", 55)]


def test_mean_by_key(spark):
    df = spark.createDataFrame(
        [(7, 0.5), (7, 4.5), (8, 1.0), (8, 6.0), (8, 8.0), (3, None), (None, 4.0)],
        "id bigint, v double",
    ).repartition(3)
    got = {r.id: r["mean"] for r in udfs.mean_by_key(df, ["id"], "v").collect()}
    assert got == {7: 2.5, 8: 5.0, 3: None, None: 4.0}


def test_user_aggregates_keep_large_keys_and_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(2**53, 1.0), (2**53 + 1, 2.0), (None, 3.0), (1, nan), (1, 2.0), (2, None)], "id bigint, v double"
    ).repartition(1)
    got = {r.id: r["mean"] for r in udfs.mean_by_key(df, ["id"], "v").collect()}
    assert got.pop(1) != got.get(1, 0) and got == {2**53: 1.0, 2**53 + 1: 2.0, None: 3.0, 2: None}
    big = spark.createDataFrame([(1, 2**53 + 1), (1, None)], "id bigint, v bigint").repartition(1)
    fold = udfs.fold_in_batches(big, ["id"], "v", lambda v: max(x for x in v if x is not None), "max")
    assert rows(fold) == [(1, 2**53 + 1)]
    with pytest.raises(Exception, match="overflow"):
        spark.createDataFrame([(2**63 - 1,)], "x bigint").select(udfs.add_one("x")).collect()


def test_function_over_whole_lists(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 7), (2, None)], "id bigint, v bigint").repartition(3)
    got = udfs.over_lists(df, ["id"], "v", lambda values: len(set(values)))
    assert rows(got) == [(1, 2), (2, 0)]


def test_fold_in_batches(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "c")], "id bigint, value string")

    def count_a(values):
        return sum(v == "a" for v in values)

    assert rows(udfs.fold_in_batches(df.repartition(3), ["id"], "value", count_a, "sum")) == [(1, 2), (2, 0)]


def test_fold_in_batches_over_many_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
        got = udfs.fold_in_batches(df, ["k"], "v", max, "max")
        assert rows(got) == [(0, 999), (1, 997), (2, 998)]
        two = udfs.aggregate_in_batches(
            df, ["k"], "v", lambda g: g.agg(lo="min", n="count"), {"lo": ("bigint", "min"), "n": ("bigint", "sum")}
        )
        assert rows(two) == [(0, 0, 334), (1, 1, 333), (2, 2, 333)]
    finally:
        spark.conf.set(key, before)


def test_partial_gets_a_grouped_series(spark):
    seen = []

    def partial(grouped):
        assert isinstance(grouped, pd.core.groupby.SeriesGroupBy), type(grouped)
        return grouped.agg(n="count")

    df = spark.createDataFrame([(1, "x", 5), (1, "y", 6), (1, "x", 7)], "a bigint, b string, v bigint")
    out = udfs.aggregate_in_batches(df, ["a", "b"], "v", partial, {"n": ("bigint", "sum")})
    assert rows(out) == [(1, "x", 2), (1, "y", 1)] and not seen


def test_percent_text_prints_as_python_does(spark):
    df = spark.range(1, 301).select(
        F.col("id").alias("total"), F.explode(F.sequence(F.lit(0), F.col("id"))).alias("n")
    )
    got = df.select("n", "total", percent_text(F.col("n"), F.col("total")).alias("t")).collect()
    assert len(got) > 45_000
    assert all(r.t == format(r.n * 100 / r.total, ".1f") + "%" for r in got)
    large = spark.createDataFrame(
        [(10**12 // 16, 10**12), (3 * 10**11, 10**12), (10**12 + 7, 10**12 + 7)], "n bigint, total bigint"
    )
    texts = [r[0] for r in large.select(percent_text(F.col("n"), F.col("total"))).collect()]
    assert texts == ["6.2%", "30.0%", "100.0%"]
