"""Python functions over all values of a key."""

from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.functions import grouped, udfs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def tiny_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    yield
    spark.conf.set(key, before)


def test_whole_lists(spark):
    df = spark.createDataFrame([(4, 9), (4, 9), (4, 2), (6, None), (None, 1)], "id bigint, v bigint").repartition(3)
    got = udfs.over_lists(df, ["id"], "v", lambda values: len(set(values)))
    assert rows(got) == [(4, 2), (6, 0), (None, 1)]
    with_nulls = grouped.fold_values(df, ["id"], "v", lambda v: len(list(v)), nulls=True)
    assert rows(with_nulls) == [(4, 3), (6, 1), (None, 1)]
    assert rows(grouped.fold_values(df.limit(0), ["id"], "v", len)) == []


def test_keys_run_over_batches(spark, tiny_batches):
    df = spark.range(1000).select(
        F.when(F.col("id") % 5 < 3, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        (F.col("id") % 2 == 0).alias("even"),
        F.col("id").alias("v"),
    )
    want = {}
    for i in range(1000):
        want.setdefault(("hot" if i % 5 < 3 else f"k{i % 40}", i % 2 == 0), []).append(i)
    joined = grouped.fold_values(
        df, ["k", "even"], "v", lambda v: ",".join(map(str, v)), "string", "l", [F.desc("v")]
    )
    assert rows(joined) == rows_of((*k, ",".join(map(str, reversed(v)))) for k, v in want.items())
    # A function may stop early, in or between batches, or read nothing.
    for n in (0, 1, 7, 8, 20):
        head = grouped.fold_values(df, ["k", "even"], "v", lambda v, n=n: sum(next(v, 0) for _ in range(n)), order=["v"])
        assert rows(head) == rows_of((*k, sum(v[:n])) for k, v in want.items())


def rows_of(found):
    return sorted(found, key=str)


def test_nan_and_null_keys_are_keys(spark, tiny_batches):
    nan = float("nan")
    df = spark.createDataFrame([(x, 1) for x in [nan, None, 0.0, -0.0] * 20], "k double, v int").repartition(4)
    got = [r.n for r in grouped.fold_values(df, ["k"], "v", sum).collect()]
    assert sorted(got) == [20, 20, 40]


def test_streamed_groups(spark, tiny_batches):
    def running(key, batches):
        total = 0
        for b in batches:
            assert b.num_rows <= 7
            values = b.column("v").to_pylist()
            sums = []
            for v in values:
                total += v
                sums.append(total)
            yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(values)), pa.array(sums)], names=["k", "total"])

    df = spark.range(90).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).repartition(5)
    got = grouped.stream_groups(df, ["k"], running, "k bigint, total bigint", order=["v"])
    want = []
    for k in range(3):
        total = 0
        for v in range(k, 90, 3):
            total += v
            want.append((k, total))
    assert rows(got) == sorted(want, key=str)


def test_fold_in_sql(spark, tiny_batches):
    def first_and_count(values):
        first, n = next(values, None), 0
        for _ in values:
            n += 1
        return f"{first}+{n}"

    df = spark.createDataFrame([(k, v) for k in (1, 2, None) for v in range(50, 20, -1)] + [(3, None)], "k bigint, v bigint")
    df.repartition(4).createOrReplaceTempView("to_fold")
    grouped.register_fold(spark, "first_and_count", first_and_count, "k bigint", "t string")
    got = spark.sql("SELECT * FROM first_and_count(TABLE(SELECT k, v FROM to_fold) PARTITION BY k ORDER BY v)")
    assert rows(got) == [(1, "21+29"), (2, "21+29"), (3, "None+0"), (None, "21+29")]
    grouped.register_fold(spark, "only_first", lambda v: next(v, None), "k bigint", "f bigint")
    got = spark.sql("SELECT * FROM only_first(TABLE(SELECT k, v FROM to_fold) PARTITION BY k ORDER BY v DESC)")
    assert rows(got) == [(1, 50), (2, 50), (3, None), (None, 50)]


@pytest.mark.parametrize("buckets", [1, 3, 500])
def test_fold_in_sql_over_buckets_of_keys(spark, tiny_batches, buckets):
    """Many keys in one call: as many results as keys, also of keys that go on over batches."""
    long = [(k, v) for k in (1, 2, None) for v in range(50, 20, -1)]
    df = spark.createDataFrame([*long, (3, None), *[(k, k) for k in range(100, 400)]], "k bigint, v bigint")
    df.repartition(4).createOrReplaceTempView("to_fold")
    grouped.register_fold(spark, "text_of", lambda values: ",".join(map(str, values)), "k bigint", "t string")
    got = spark.sql(
        f"SELECT * FROM text_of(TABLE(SELECT k, v FROM to_fold) PARTITION BY pmod(hash(k), {buckets}) ORDER BY (k, v DESC))"
    )
    all_of_it = ",".join(map(str, range(50, 20, -1)))
    want = [(1, all_of_it), (2, all_of_it), (None, all_of_it), (3, ""), *[(k, str(k)) for k in range(100, 400)]]
    assert rows(got) == rows_of(want)
    grouped.register_fold(spark, "first_of", lambda v: next(v, None), "k bigint", "f bigint")
    got = spark.sql(
        f"SELECT * FROM first_of(TABLE(SELECT k, v FROM to_fold) PARTITION BY pmod(hash(k), {buckets}) ORDER BY (k, v))"
    )
    assert rows(got) == rows_of([(1, 21), (2, 21), (None, 21), (3, None), *[(k, k) for k in range(100, 400)]])


def test_a_key_within_a_batch_starts_no_thread(monkeypatch):
    """Nor does it make a batch of results of its own."""
    made = {}

    class Session:
        udtf = SimpleNamespace(register=lambda name, f: made.update({name: f.func}))

    monkeypatch.setattr(grouped, "_Pushed", None)
    grouped.register_fold(Session, "total", sum, "k bigint", "n bigint")
    over = made["total"]()
    batch = pa.RecordBatch.from_pydict({"k": [1, 1, 2, 3, 3, 3], "v": [1, 2, 3, 4, None, 6]})
    assert list(over.eval(batch)) == []
    (table,) = over.terminate()
    assert table.to_pydict() == {"k": [1, 2, 3], "n": [3, 3, 10]}


def test_errors_come_through(spark):
    def broken(values):
        raise ValueError("not this one")

    df = spark.createDataFrame([(1, 1)] * 30, "k bigint, v bigint")
    with pytest.raises(Exception, match="not this one"):
        grouped.fold_values(df, ["k"], "v", broken).collect()
    df.createOrReplaceTempView("to_break")
    grouped.register_fold(spark, "broken", broken, "k bigint", "n bigint")
    with pytest.raises(Exception, match="not this one"):
        spark.sql("SELECT * FROM broken(TABLE(SELECT k, v FROM to_break) PARTITION BY k)").collect()
