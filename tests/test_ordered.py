"""The plain and the split way over ordered groups give what plain Python gives."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.operators import ordered
from clickloom.operators.funnel import page_flow

SCHEMA = "g string, t bigint, id bigint, v bigint"


def make_rows(seed, groups=("a", "b", None), n=200):
    """Most rows are in group a; times tie, ids do not; some values are NULL."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        g = groups[0] if rng.random() < 0.6 else rng.choice(groups)
        rows.append((g, rng.randrange(n // 4), i, rng.choice([None, *range(9)])))
    rng.shuffle(rows)
    return rows


def by_group(rows):
    grouped = defaultdict(list)
    for row in rows:
        grouped[row[0]].append(row)
    return {g: sorted(part, key=lambda r: (r[1], r[2])) for g, part in grouped.items()}


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("hot_rows", [None, 0, 60, 10**6])
@pytest.mark.parametrize("seed", [1, 2])
def test_next_in_group(spark, many_chunks, seed, hot_rows):
    rows = make_rows(seed)
    want = set()
    for part in by_group(rows).values():
        for row, after in zip(part, part[1:] + [None]):
            want.add((*row, after[3] if after else None))
    out = ordered.next_in_group(frame(spark, rows), ["g"], ["t", "id"], "v", "nxt", hot_rows)
    assert out.columns == ["g", "t", "id", "v", "nxt"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(rows)
    assert set(got) == want


@pytest.mark.parametrize("hot_rows", [None, 0, 60, 10**6])
@pytest.mark.parametrize("seed", [3, 4])
def test_position_in_group(spark, many_chunks, seed, hot_rows):
    rows = make_rows(seed)
    want = {
        (*row, i) for part in by_group(rows).values() for i, row in enumerate(part, start=1)
    }
    out = ordered.position_in_group(frame(spark, rows), ["g"], ["t", "id"], "pos", hot_rows)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(rows)
    assert set(got) == want


def test_descending_order(spark, many_chunks):
    rows = make_rows(5)
    order = [F.desc("t"), F.desc("id")]
    plain = ordered.position_in_group(frame(spark, rows), ["g"], order, "pos", None)
    split = ordered.position_in_group(frame(spark, rows), ["g"], order, "pos", 0)
    assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, split.collect()))


def test_chunks_really_split_a_group(spark, many_chunks):
    chunked = ordered._chunked(frame(spark, make_rows(6, groups=("a",))), ["g"], ["t", "id"])
    assert chunked.select("__chunk").distinct().count() > 3


def test_single_rows_per_chunk(spark, many_chunks):
    """Chunks of one row: that row is first and last at once."""
    rows = [("a", i, i, i) for i in range(6)]
    out = ordered.next_in_group(frame(spark, rows), ["g"], ["t"], "v", "nxt", 0)
    assert sorted((r.v, r.nxt) for r in out.collect() if r.v < 5) == [(i, i + 1) for i in range(5)]
    pos = ordered.position_in_group(frame(spark, rows), ["g"], ["t"], "pos", 0)
    assert sorted((r.v, r.pos) for r in pos.collect()) == [(i, i + 1) for i in range(6)]


def test_split_hot_parts_make_the_whole(spark):
    rows = make_rows(7)
    df = frame(spark, rows)
    usual, hot = ordered.split_hot(df, ["g"], 60)
    assert Counter(map(tuple, usual.unionByName(hot).collect())) == Counter(rows)
    assert {r.g for r in hot.collect()} == {"a"}


def test_every_hot_group_is_split(spark, many_chunks):
    rows = make_rows(11)
    df = frame(spark, rows)
    usual, hot = ordered.split_hot(df, ["g"], 0)
    assert usual.count() == 0 and hot.count() == len(rows)
    some = ordered.position_in_group(df, ["g"], ["t", "id"], "pos", 0)
    none = ordered.position_in_group(df, ["g"], ["t", "id"], "pos", None)
    assert Counter(map(tuple, some.collect())) == Counter(map(tuple, none.collect()))


def test_groups_of_several_columns(spark, many_chunks):
    rows = make_rows(12)
    df = frame(spark, rows).withColumn("h", F.col("id") % 2)
    some = ordered.next_in_group(df, ["g", "h"], ["t", "id"], "v", "nxt", 20)
    none = ordered.next_in_group(df, ["g", "h"], ["t", "id"], "v", "nxt", None)
    assert Counter(map(tuple, some.collect())) == Counter(map(tuple, none.collect()))


@pytest.mark.parametrize("searched, sampled", [(2, 2), (3, 2), (8, 4), (32, 64)])
def test_bounds_are_found_in_two_steps(spark, monkeypatch, searched, sampled):
    """Up to searched**2 bounds, NULLs and ties in the order, next values that are NULL."""
    monkeypatch.setattr(ordered, "SEARCHED", searched)
    monkeypatch.setattr(ordered, "SAMPLED", sampled)
    rng = random.Random(21)
    rows = [(rng.choice(["a", "a", None]), rng.choice([None, *range(40)]), i, rng.choice([None, 1, 2])) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, t bigint, id bigint, v bigint").repartition(5)
    bounds = ordered.chunk_bounds(df, ["g"], ["t", "id"], "v", 10).collect()
    assert len(bounds) == 2 and all(1 < len(r["__bounds"]) <= searched**2 + 1 for r in bounds)
    for f, value in ((ordered.next_in_group, ["v", "nxt"]), (ordered.position_in_group, ["pos"])):
        some, none = (f(df, ["g"], ["t", "id"], *value, hot_rows=h) for h in (10, None))
        assert Counter(map(tuple, some.collect())) == Counter(map(tuple, none.collect()))


def test_rows_are_exchanged_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(5000).select(
        (F.col("id") % 3).alias("g"), F.xxhash64("id").alias("t"), "id", F.col("id").alias("v")
    ).write.parquet(path)
    got = ordered.next_in_group(spark.read.parquet(path), ["g"], ["t", "id"], "v", "nxt", 100)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "rangepartitioning" not in plan and plan.count("Exchange hashpartitioning(g") - plan.count("ReusedExchange") <= 4
    chunks = ordered._with_chunks(
        spark.read.parquet(path), ordered.chunk_bounds(spark.read.parquet(path), ["g"], ["t", "id"], "v", 100), ["g"], ["t", "id"], "left"
    )
    sizes = [r["count"] for r in chunks.groupBy("g", "__chunk").count().collect()]
    assert len(sizes) > 30 and max(sizes) < 300


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ordered.next_in_group(empty, ["g"], ["t"], "v", "nxt").count() == 0
    assert ordered.position_in_group(empty, ["g"], ["t"], "pos", 0).count() == 0


@pytest.mark.parametrize("hot_rows", [None, 0, 60])
def test_lists_come_in_parts(spark, many_chunks, hot_rows):
    rows = make_rows(8)
    out = ordered.ordered_lists(
        frame(spark, rows), ["g"], "v", ["t", "id"], list_rows=7, hot_rows=hot_rows, nulls=True
    ).collect()
    want = {g: [r[3] for r in part] for g, part in by_group(rows).items()}
    got = defaultdict(list)
    for row in sorted(out, key=lambda r: r.part):
        assert 1 <= len(row["values"]) <= 7
        got[row.g] += row["values"]
    assert got == want


@pytest.mark.parametrize("hot_rows", [None, 0, 90])
@pytest.mark.parametrize("list_rows", [1, 7, 1000])
@pytest.mark.parametrize("nulls", [False, True])
def test_lists_and_rows_with_many_copies(spark, many_chunks, hot_rows, list_rows, nulls):
    """Times tie, and a third of all rows are copies of one; one group has NULLs alone."""
    rng = random.Random(10)
    rows = [(rng.choice("aab"), rng.randrange(9), rng.choice([None, 1, 2])) for _ in range(200)]
    rows += [("a", 4, 2)] * 100 + [("n", i // 2, None) for i in range(5)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, t bigint, v bigint").repartition(4)
    want = defaultdict(list)
    for g, _, v in sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0)):
        want[g].append(v)

    got = defaultdict(list)
    lists = ordered.ordered_lists(df, ["g"], "v", ["t"], list_rows=list_rows, hot_rows=hot_rows, nulls=nulls)
    for row in sorted(lists.collect(), key=lambda r: (r.g, r.part)):
        assert row.part * list_rows == len(got[row.g])
        assert len(row["values"]) <= list_rows
        got[row.g] += row["values"]
    assert got == {g: [v for v in values if nulls or v is not None] for g, values in want.items()}

    placed = ordered.ordered_rows(df, ["g"], "v", ["t"], "pos", hot_rows).collect()
    assert sorted(r.pos for r in placed) == sorted(
        i for values in want.values() for i in range(1, len(values) + 1)
    )
    assert all(want[r.g][r.pos - 1] == r.v for r in placed)


def test_long_runs_cross_many_parts(spark, many_chunks):
    df = spark.range(25_000).select(F.lit("a").alias("g"), F.lit(1).alias("t"), F.lit("x").alias("v"))
    df = df.union(spark.createDataFrame([("a", 0, "w"), ("a", 2, "z")], df.schema))
    out = ordered.ordered_rows(df, ["g"], "v", ["t"], "pos", hot_rows=0)
    assert out.count() == out.select("pos").distinct().count() == 25_002
    ends = out.where("v <> 'x'").collect()
    assert sorted((r.pos, r.v) for r in ends) == [(1, "w"), (25_002, "z")]


def flow_by_hand(rows, pages, adjacency, order):
    visits, jumps = Counter(), Counter()
    sessions = defaultdict(list)
    for row in rows:
        if adjacency == "strict" or row["page_id"] in pages:
            sessions[row["session_id"]].append(row)
    for path in sessions.values():
        path.sort(key=lambda r: (*[r[c] for c in order], r["page_id"]))
        for row in path:
            visits[row["page_id"]] += row["page_id"] in pages
        for a, b in zip(path, path[1:]):
            if a["page_id"] in pages and b["page_id"] in pages:
                jumps[a["page_id"], b["page_id"]] += 1
    return {(a, b, n, visits[a], n / visits[a]) for (a, b), n in jumps.items()}


@pytest.mark.parametrize("hot_rows", [None, 0, 90])
@pytest.mark.parametrize("adjacency", ["filtered", "strict"])
def test_page_flow_with_copies(spark, many_chunks, adjacency, hot_rows):
    """A third of all rows are copies of one visit, within a large session."""
    rng = random.Random(9)
    rows = [
        {"session_id": rng.choice("aab"), "action_time": f"{rng.randrange(30):02d}", "page_id": rng.randrange(6)}
        for _ in range(200)
    ] + [{"session_id": "a", "action_time": "17", "page_id": 2}] * 100
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "session_id string, action_time string, page_id bigint")
    got = page_flow(df.repartition(4), [1, 2, 3], adjacency, hot_rows=hot_rows)
    want = flow_by_hand(rows, {1, 2, 3}, adjacency, ["action_time"])
    assert {tuple(r) for r in got.collect()} == want
