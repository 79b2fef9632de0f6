"""Composite queries on small invented logs."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators import actions as act
from clickloom.operators import funnel, sales, summary, text
from clickloom.sources.readers import read_action_log
from clickloom.sources.schemas import USER_VISIT_ACTION

# Thirteen fields each: search, clicks, orders and payments of three sessions.
LOG = """\
2021-03-01_1_s1_3_2021-03-01 08:00:01_phone_-1_-1_null_null_null_null_2
2021-03-01_1_s1_10_2021-03-01 08:00:05_null_7_70_null_null_null_null_2
2021-03-01_1_s1_5_2021-03-01 08:00:09_null_7_71_null_null_null_null_3
2021-03-01_1_s1_6_2021-03-01 08:00:12_null_-1_-1_7,8,9_70,80_null_null_2
2021-03-01_2_s2_3_2021-03-01 09:10:00_null_8_80_null_null_null_null_1
2021-03-01_2_s2_5_2021-03-01 09:10:02_null_7_70_null_null_null_null_1
2021-03-01_2_s2_5_2021-03-01 09:10:03_null_-1_-1_null_null_7,20_70,99_1
2021-03-01_3_s3_1_2021-03-01 10:00:00_null_9_90_null_null_null_null_3
2021-03-01_3_s3_2_2021-03-01 10:00:30_null_8_80_null_null_null_null_3
2021-03-01_3_s3_2_2021-03-01 10:00:31_null_-1_-1_8_80_null_null_3
"""


@pytest.fixture(scope="module")
def actions(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("log") / "actions.txt"
    path.write_text(LOG)
    return read_action_log(spark, str(path))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_action_types(actions):
    counted = act.with_action_type(actions).groupBy("action_type").count()
    assert rows(counted) == [("click", 6), ("order", 2), ("pay", 1), ("search", 1)]


# category: clicks, orders, payments
COUNTS = [(7, 3, 1, 1), (8, 2, 2, 0), (9, 1, 1, 0), (20, 0, 0, 1)]


def test_counts_in_one_pass_and_by_outer_joins(actions):
    assert rows(act.action_counts(actions)) == COUNTS
    assert rows(act.full_outer_counts(actions)) == COUNTS


def test_category_known_from_payments_only(actions):
    paid = act.full_outer_counts(actions).where("category_id = 20")
    assert rows(paid) == [(20, 0, 0, 1)]


def test_counts_of_own_name(actions):
    assert act.action_counts(actions, "cat").columns[0] == "cat"


def test_hot_categories_break_ties_by_all_three_counts(actions, spark):
    assert [r.category_id for r in funnel.hot_categories(actions, 3).collect()] == [7, 8, 9]
    lists = [
        (None, "1", None), (None, "2", None), (None, "2", "1"), (None, "3,2", "3"), (5, None, None)
    ]
    made = spark.createDataFrame(
        [
            ("d", 1, "s", 1, "t", None, c or -1, -1, o, None, None if o else p, None, 1)
            for c, o, p in lists
        ]
        + [("d", 1, "s", 1, "t", None, -1, -1, None, None, "1", None, 1)],
        USER_VISIT_ACTION,
    )
    got = [tuple(r) for r in funnel.hot_categories(made, 10).collect()]
    assert got == [(5, 1, 0, 0), (2, 0, 3, 0), (1, 0, 1, 1), (3, 0, 1, 0)]


def test_category_sessions(actions):
    got = rows(funnel.category_sessions(actions, k=4, n=1))
    assert got == [(7, "s1", 2, 1), (8, "s2", 1, 1), (9, "s3", 1, 1)]
    assert len(rows(funnel.category_sessions(actions, k=2, n=10))) == 4


def test_clicks_in_hot_categories(actions):
    assert funnel.clicks_in_hot_categories(actions, 1).count() == 3


def test_long_lists_of_hot_categories_are_not_broadcast_by_hint(actions, monkeypatch):
    want = rows(funnel.clicks_in_hot_categories(actions, 2))
    monkeypatch.setattr(funnel, "_TOP_BROADCAST", 0)
    assert rows(funnel.clicks_in_hot_categories(actions, 2)) == want


def test_shares_add_up(spark, actions):
    counts = spark.createDataFrame(
        [("g", f"c{i}", i + 1) for i in range(9)] + [("h", "x", 3), ("h", "y", 4)],
        "g string, city string, n bigint",
    )
    total = {r.g: r.total for r in sales.share_summary(counts, ["g"], "city").collect()}
    assert total == {"g": 45, "h": 7}
    for row in sales.share_remark(counts, ["g"], "city").collect():
        shares = [float(part.split(":")[1].rstrip("%")) for part in row.remark.split(",")]
        assert abs(sum(shares) - 100) < 0.2


def test_page_flow_modes(actions):
    pages = [3, 5, 6]
    assert rows(funnel.page_flow(actions, pages)) == [
        (3, 5, 2, 2, 1.0),
        (5, 5, 1, 3, 1 / 3),
        (5, 6, 1, 3, 1 / 3),
    ]
    strict = rows(funnel.page_flow(actions, pages, adjacency="strict"))
    assert strict == [(3, 5, 1, 2, 0.5), (5, 5, 1, 3, 1 / 3), (5, 6, 1, 3, 1 / 3)]
    configured = funnel.page_flow(actions, [3, 5, 6, 4], "strict", "configured")
    assert rows(configured) == [(3, 5, 1, 2, 0.5), (5, 6, 1, 3, 1 / 3), (6, 4, 0, 1, 0.0)]
    unseen = funnel.page_flow(actions, [41, 42], "strict", "configured")
    assert rows(unseen) == [(41, 42, 0, 0, 0.0)]


def test_page_flow_rejects_unknown_modes(actions):
    with pytest.raises(ValueError):
        funnel.page_flow(actions, [1], adjacency="loose")
    with pytest.raises(ValueError):
        funnel.page_flow(actions, [1], pairs="some")


def test_jumps_never_exceed_visits(actions):
    flow = funnel.page_flow(actions, range(1, 11))
    out = flow.groupBy("from_page").agg(F.sum("jumps").alias("j"), F.max("visits").alias("v"))
    assert all(r.j <= r.v for r in out.collect())


def test_session_path(actions):
    path = funnel.session_path(actions, ["action_time", "page_id"])
    assert [r.page_id for r in path.where("session_id = 's1'").orderBy("step").collect()] == [3, 10, 5, 6]


def test_ids_that_are_no_numbers(spark):
    df = spark.createDataFrame([("1,x,,3",), (None,)], "ids string")
    assert [r.id for r in act.explode_ids(df, "ids").collect()] == [1, None, None, 3]


def test_empty_log(spark):
    empty = spark.createDataFrame([], USER_VISIT_ACTION)
    assert rows(funnel.hot_categories(empty)) == []
    assert rows(funnel.category_sessions(empty)) == []
    assert rows(funnel.page_flow(empty, [1, 2])) == []
    assert rows(funnel.page_flow(empty, [1, 2], pairs="configured")) == [(1, 2, 0, 0, 0.0)]


# --- shares per area -----------------------------------------------------------

REMARKS = [
    ({"A": 63, "B": 53}, "A:54.3%,B:45.7%", "A:53.4%,B:44.8%,其他:1.7%"),
    ({"A": 5, "B": 3, "C": 2}, "A:50.0%,B:30.0%,其他:20.0%", "A:40.0%,B:20.0%,其他:40.0%"),
    ({"A": 4}, "A:100.0%", "A:75.0%"),
    ({"B": 2, "A": 2, "C": 1, "D": 1}, "A:33.3%,B:33.3%,其他:33.3%", "A:16.7%,B:16.7%,其他:66.7%"),
]


@pytest.mark.parametrize("cities, exact, legacy", REMARKS)
def test_share_remark(spark, cities, exact, legacy):
    counts = spark.createDataFrame(
        [("g", c, n) for c, n in cities.items()], "g string, city string, n bigint"
    )
    for mode, want in (("exact", exact), ("legacy", legacy)):
        row = sales.share_remark(counts, ["g"], "city", mode=mode).first()
        assert (row.total, row.remark) == (sum(cities.values()), want)


def test_area_top_products(spark, actions):
    cities = spark.createDataFrame(
        [(1, "P", "north"), (2, "Q", "north"), (3, "R", "south"), (4, "S", "west")],
        "city_id bigint, city_name string, area string",
    )
    products = spark.createDataFrame(
        [(70, "tea"), (71, "milk"), (80, "cup"), (90, "pot"), (91, "pan")],
        "product_id bigint, product_name string",
    )
    assert sales.star_join(actions, cities, products).count() == 6
    assert rows(sales.area_product_clicks(actions, cities, products)) == [
        ("north", "cup", 1), ("north", "tea", 2), ("south", "cup", 1), ("south", "milk", 1), ("south", "pot", 1),
    ]
    assert rows(sales.area_top_products(actions, cities, products, 2)) == [
        ("north", "cup", 1, "P:100.0%", 2),
        ("north", "tea", 2, "P:50.0%,Q:50.0%", 1),
        ("south", "cup", 1, "R:100.0%", 1),
        ("south", "milk", 1, "R:100.0%", 2),
    ]
    plain = sales.area_top_products(actions, cities, products, 2, remark=None)
    assert rows(plain)[1] == ("north", "tea", 2, 1)
    assert plain.columns == ["area", "product_name", "click_count", "rank"]


def test_shares_with_repeated_dimension_rows(spark, actions):
    """Counting before the joins weighs repeated dimension rows as a join would."""
    cities = spark.createDataFrame(
        [(1, "P", "north"), (1, "P2", "north"), (3, "R", "south")],
        "city_id bigint, city_name string, area string",
    )
    products = spark.createDataFrame(
        [(70, "tea"), (70, "tea"), (80, "tea")], "product_id bigint, product_name string"
    )
    joined = sales.star_join(actions, cities, products).groupBy("area", "product_name").count()
    assert rows(sales.area_product_clicks(actions, cities, products)) == rows(joined)


# --- summaries and text ----------------------------------------------------------


def test_charge_summary(spark):
    df = spark.createDataFrame(
        [("p1", 4.25), ("p1", 10.50), ("p2", 17.125), ("p3", 31.748), ("p4", None)],
        "chargepoint_id string, plugin_duration double",
    )
    want = [("p1", 10.5, 7.38), ("p2", 17.13, 17.13), ("p3", 31.75, 31.75), ("p4", None, None)]
    assert sorted(map(tuple, summary.charge_summary(df).collect())) == want


def test_exact_mean_rounds_halves_away_from_zero(spark):
    df = spark.createDataFrame(
        [("a", 1.00), ("a", 1.01), ("b", -1.00), ("b", -1.01), ("c", 2.0)], "k string, v double"
    )
    got = {r.k: r.avg_duration for r in summary.charge_summary(df, "k", "v", decimals=2).collect()}
    assert got == {"a": 1.01, "b": -1.01, "c": 2.0}
    five = spark.createDataFrame([("a", 3.66633), ("a", 11.8166)], "k string, v double")
    assert summary.charge_summary(five, "k", "v", decimals=5).first().avg_duration == 7.74


def test_charge_etl(spark, tmp_path):
    source = tmp_path / "charge.csv"
    source.write_text(
        "1,X1,2020-01-01,10:00:00,2020-01-01,11:00:00,5.3,1.5\n"
        "2,X1,2020-01-02,10:00:00,2020-01-02,11:00:00,5.3,2.255\n"
    )
    target = str(tmp_path / "out")
    summary.charge_etl(spark, str(source), target)
    assert rows(spark.read.parquet(target)) == [("X1", 2.26, 1.88)]
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        summary.charge_etl(spark, str(source), target)


def test_word_count(spark):
    df = spark.createDataFrame([("a  b\nc a",), ("b,\tb a",), ("",), (None,)], "value string")
    assert rows(text.word_count(df)) == [("a", 3), ("b", 1), ("b,\tb", 1), ("c", 1)]
    assert [tuple(r) for r in text.word_count(df, k=2).collect()] == [("a", 3), ("b", 1)]


def test_sums(spark):
    df = spark.createDataFrame([("oak", 12), ("elm", -5), ("oak", 30), ("elm", None)], "k string, v bigint")
    assert rows(summary.keyed_sum(df, "k", "v")) == [("elm", -5), ("oak", 42)]
    assert summary.global_sum(spark.range(20, 23), "id").first().total == 63


def test_count_matching(spark):
    df = spark.createDataFrame([(9, "late"), (9, "late"), (5, None), (9, "due"), (6, "due")], "id bigint, value string")
    assert rows(summary.count_matching(df, "id", F.col("value") == "late")) == [(5, 0), (6, 0), (9, 2)]
