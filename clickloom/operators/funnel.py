"""Hot categories, their most active sessions, and page-to-page conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.actions import action_counts, clicks
from clickloom.operators.joins import keep_members
from clickloom.operators.ordered import (
    HOT_GROUP_ROWS,
    next_in_chunks,
    next_in_group,
    next_plain,
    ordered_rows,
    split_hot,
)
from clickloom.operators.ranking import top_k, top_k_per_group

# Fixed value: the pages whose conversion is asked for by default.
DEFAULT_PAGES = (1, 2, 3, 4, 5, 6, 7)

# A top-k list of at most this many ids is broadcast by hint.
_TOP_BROADCAST = 10_000


def hot_categories(actions: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` categories by clicks, then orders, then payments."""
    order = [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")]
    return top_k(action_counts(actions), order, k)


def clicks_in_hot_categories(actions: DataFrame, k: int = 10) -> DataFrame:
    """Click rows whose category is among the top ``k``."""
    top = hot_categories(actions, k).select(F.col("category_id").alias("click_category_id"))
    if k <= _TOP_BROADCAST:
        top = F.broadcast(top)
    return keep_members(clicks(actions), "click_category_id", top)


def category_sessions(actions: DataFrame, k: int = 10, n: int = 10) -> DataFrame:
    """For each of the top ``k`` categories the ``n`` sessions with most clicks.

    A category that reached the top without a click has no row.
    """
    counts = (
        clicks_in_hot_categories(actions, k)
        .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )
    order = [F.desc("click_count"), F.asc("session_id")]
    return top_k_per_group(counts, ["category_id"], order, n)


def adjacent_pairs(
    actions: DataFrame,
    order: Sequence[str | Column],
    session: str = "session_id",
    page: str = "page_id",
    hot_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """Each row that has a successor in its session, with ``next_page_id``.

    ``order`` has to be unique within a session, and pages must not be NULL.
    """
    paired = next_in_group(actions, [session], order, page, "next_page_id", hot_rows)
    return paired.where(F.col("next_page_id").isNotNull())


def session_path(
    actions: DataFrame,
    order: Sequence[str] = ("action_time",),
    session: str = "session_id",
    page: str = "page_id",
    hot_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """The page path of each session as rows (session, step, page), step from 1.

    Visits that tie in ``order`` come by page id.
    """
    return ordered_rows(actions, [session], page, list(order), "step", hot_rows)


def _page_transitions(
    visits: DataFrame, session: str, order: Sequence[str], page: str, hot_rows: int | None
) -> DataFrame:
    """Count (page, next page) over all visits; next is NULL at a session's end.

    Visits that agree in session, time and page cannot be told apart, so within
    hot sessions they are merged first and carry their number.  A run of n such
    visits makes n - 1 steps from the page to itself and one step onward.
    """
    sort_by = list(dict.fromkeys([*order, page]))
    columns = list(dict.fromkeys([session, *sort_by]))
    visits = visits.select(*columns)

    def steps(rows: DataFrame) -> DataFrame:
        return rows.select(F.col(page).alias("page"), "next_page", F.lit(1).alias("n"))

    def steps_of_runs(rows: DataFrame) -> DataFrame:
        onward = F.struct(F.col("next_page").alias("to"), F.lit(1).alias("n"))
        onto_itself = F.struct(F.col(page).alias("to"), (F.col("copies") - 1).alias("n"))
        made = rows.select(
            F.col(page).alias("page"), F.explode(F.array(onward, onto_itself)).alias("step")
        )
        return made.select("page", F.col("step.to").alias("next_page"), "step.n").where("n > 0")

    if hot_rows is None:
        made = steps(next_plain(visits, [session], sort_by, page, "next_page"))
    else:
        usual, hot = split_hot(visits, [session], hot_rows)
        runs = hot.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
        made = steps(next_plain(usual, [session], sort_by, page, "next_page")).unionByName(
            steps_of_runs(next_in_chunks(runs, [session], sort_by, page, "next_page"))
        )
    return made.groupBy("page", "next_page").agg(F.sum("n").alias("n"))


def page_flow(
    actions: DataFrame,
    pages: Sequence[int] = DEFAULT_PAGES,
    adjacency: str = "filtered",
    pairs: str = "all",
    order: Sequence[str] = ("action_time",),
    session: str = "session_id",
    page: str = "page_id",
    hot_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """Single-jump conversion between the given pages.

    Columns: ``from_page``, ``to_page``, ``jumps``, ``visits`` of the first page,
    ``rate`` = jumps / visits.

    * ``adjacency="filtered"``: pages outside the list are removed first, so
      3, 10, 5 counts as a jump from 3 to 5.  ``"strict"``: the second page must
      follow immediately.
    * ``pairs="all"``: every pair seen.  ``"configured"``: exactly the consecutive
      pairs of ``pages``, with zeros where nothing was seen.

    Visits at the same time are taken in order of page id.  The input is read
    once for the visits and the jumps together.
    """
    if adjacency not in ("filtered", "strict"):
        raise ValueError(f"unknown adjacency {adjacency!r}")
    if pairs not in ("all", "configured"):
        raise ValueError(f"unknown pairs {pairs!r}")
    pages = list(pages)
    chosen = actions.where(F.col(page).isin(pages)) if adjacency == "filtered" else actions
    seen = _page_transitions(chosen, session, list(order), page, hot_rows).where(
        F.col("page").isin(pages)
    )
    seen = seen.withColumn("visits", F.sum("n").over(Window.partitionBy("page")))
    if pairs == "configured":
        flow = _configured(seen, pages)
    else:
        flow = seen.where(F.col("next_page").isin(pages)).select(
            F.col("page").cast("bigint").alias("from_page"),
            F.col("next_page").cast("bigint").alias("to_page"),
            F.col("n").alias("jumps"),
            "visits",
        )
    rate = F.when(F.col("visits") > 0, F.col("jumps") / F.col("visits")).otherwise(F.lit(0.0))
    return flow.withColumn("rate", rate)


def _configured(seen: DataFrame, pages: Sequence[int]) -> DataFrame:
    """The consecutive pairs of ``pages`` with their counts, zero-filled."""
    wanted = seen.sparkSession.createDataFrame(
        list(dict.fromkeys(zip(pages, pages[1:]))), "from_page bigint, to_page bigint"
    )
    jumps = F.sum(F.when(F.col("next_page") == F.col("to_page"), F.col("n")))
    return (
        wanted.join(seen, F.col("from_page") == F.col("page"), "left")
        .groupBy("from_page", "to_page")
        .agg(
            F.coalesce(jumps, F.lit(0)).alias("jumps"),
            F.coalesce(F.max("visits"), F.lit(0)).alias("visits"),
        )
    )
