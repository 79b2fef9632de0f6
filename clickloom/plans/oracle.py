"""The queries of the catalogue in SQL, for a second engine on the same tables."""

from __future__ import annotations

# Events as rows of the action log: k is page, category and product; orders and payments have no,
# one, two or three ids.
_ACTIONS = """
log AS (
  SELECT *, list_transform(range(event_id % 4), lambda j: (k + 7 * j) % 100) AS ids
  FROM (
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           's' || CAST(user_id AS VARCHAR) AS session_id,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time
    FROM events)
)"""

_COUNTS = """
counts AS (
  SELECT category_id,
         count(*) FILTER (event_type = 'view') AS click_count,
         count(*) FILTER (event_type = 'click') AS order_count,
         count(*) FILTER (event_type = 'purchase') AS pay_count
  FROM (SELECT k AS category_id, event_type FROM log WHERE event_type = 'view'
        UNION ALL SELECT unnest(ids), event_type FROM log WHERE event_type IN ('click', 'purchase'))
  GROUP BY category_id
)"""

# The texts of a log line.
_TEXTS = """
texts AS (
  SELECT user_id, strftime(ts, '%Y-%m-%d') AS f1, CAST(user_id AS VARCHAR) AS f2, session_id AS f3,
         CAST(k AS VARCHAR) AS f4, action_time AS f5,
         CASE WHEN event_type = 'signup' THEN 'signup' ELSE 'null' END AS f6,
         CASE WHEN event_type = 'view' THEN CAST(k AS VARCHAR) ELSE '-1' END AS f7,
         CASE WHEN event_type = 'click' THEN array_to_string(ids, ',') ELSE 'null' END AS f9,
         CASE WHEN event_type = 'purchase' THEN array_to_string(ids, ',') ELSE 'null' END AS f11,
         CAST(user_id % 25 AS VARCHAR) AS f13
  FROM log
)"""

_TOP = """
top AS (
  SELECT * FROM counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
)"""

# Each row with the next page of its session; {where} limits the rows considered.
_NEXT = """
visit AS (
  SELECT user_id AS session_id, event_id, ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS page_id
  FROM events
),
step AS (
  SELECT *, lead(page_id) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS next_page_id
  FROM visit {where}
)"""

_FLOW = """
WITH {next},
seen AS (SELECT page_id, count(*) AS visits FROM step WHERE page_id BETWEEN 1 AND 7 GROUP BY 1),
jump AS (
  SELECT page_id, next_page_id, count(*) AS jumps FROM step
  WHERE page_id BETWEEN 1 AND 7 AND next_page_id BETWEEN 1 AND 7 GROUP BY 1, 2
)"""

_FLOW_ALL = """
SELECT page_id AS from_page, next_page_id AS to_page, jumps, visits,
       CAST(jumps AS DOUBLE) / visits AS rate
FROM jump JOIN seen USING (page_id)"""

_STRICT = _FLOW.format(next=_NEXT.format(where="")) + _FLOW_ALL

_STAR = """
star AS (
  SELECT r_name AS area, n_name AS city_name, l_partkey AS click_product_id, p_name AS product_name
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  WHERE l_partkey > -1
)"""

_AREA_RANKED = """
ranked AS (
  SELECT area, product_name, count(*) AS click_count,
         row_number() OVER (PARTITION BY area ORDER BY count(*) DESC, product_name) AS rank
  FROM star GROUP BY area, product_name
)"""

# {lost} clicks are taken off every city; from {rest} cities on the rest is named.
_REMARK = """
WITH {star}, {ranked},
city AS (
  SELECT area, product_name, city_name, count(*) - {lost} AS n,
         row_number() OVER (PARTITION BY area, product_name ORDER BY count(*) DESC, city_name) AS rn,
         count(*) OVER (PARTITION BY area, product_name) AS cities
  FROM star GROUP BY area, product_name, city_name
),
share AS (
  SELECT area, product_name, max(cities) AS cities,
         max(CASE WHEN rn = 1 THEN city_name END) AS c1, max(CASE WHEN rn = 1 THEN n END) AS n1,
         max(CASE WHEN rn = 2 THEN city_name END) AS c2, max(CASE WHEN rn = 2 THEN n END) AS n2
  FROM city GROUP BY area, product_name
)
SELECT area, product_name, click_count, rank,
       c1 || ':' || printf('%.1f', CAST(n1 * 100 AS DOUBLE) / click_count) || '%'
       || CASE WHEN cities > 1 THEN ',' || c2 || ':' || printf('%.1f', CAST(n2 * 100 AS DOUBLE) / click_count) || '%' ELSE '' END
       || CASE WHEN cities >= {rest} THEN ',其他:' || printf('%.1f', CAST((click_count - n1 - n2) * 100 AS DOUBLE) / click_count) || '%' ELSE '' END
       AS city_remark
FROM ranked JOIN share USING (area, product_name) WHERE rank <= 3"""

_CENTS = """
SELECT l_partkey, max(l_extendedprice) AS max_duration,
       CAST((2 * sum(c) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_duration
FROM (SELECT l_partkey, l_extendedprice, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem)
GROUP BY l_partkey"""

_ORDERS_CUSTOMER = """
SELECT o_custkey AS custkey, o_orderkey, o_orderpriority, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey"""

# Lists in parts of {size}: {value} in the order {order}.
_LISTS = """
SELECT o_custkey, CAST((pos - 1) // {size} AS BIGINT) AS part,
       string_agg({value}, ',' ORDER BY pos) AS {out}
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {order}) AS pos FROM {rows})
GROUP BY 1, 2"""

# Two priorities count as none.
_RATED = """(SELECT o_custkey, o_orderkey,
       CASE WHEN o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') THEN o_orderpriority END AS p FROM orders)"""

_ADJACENT = (
    f"WITH {_NEXT.format(where='')} "
    "SELECT session_id, event_id, page_id, next_page_id FROM step WHERE next_page_id IS NOT NULL"
)

_PATH = """
SELECT user_id AS session_id,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS page_id
FROM events"""

_SCALARS = """
SELECT c_custkey, CAST(length(c_name) AS INTEGER) AS name_length, upper(c_name) AS name_upper,
       c_custkey + 1 AS next_key
FROM customer"""

_WORDS = """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split_regex(text, '[ \\n\\r]')) AS word FROM documents)
WHERE word <> '' GROUP BY word"""

_URGENT = """
SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT') AS n FROM orders GROUP BY o_custkey"""


def _pick(function: str) -> str:
    return (
        f"SELECT o_custkey, {function}(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus "
        "FROM orders GROUP BY o_custkey"
    )


def _vector_sum(initial: str) -> str:
    return f"""
SELECT label, pos, round(sum(x) + {initial}, 4) AS total
FROM (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x,
             unnest(range(len(embedding))) AS pos FROM embeddings)
GROUP BY label, pos"""


_ORACLES = {
    "scan_text_lines": """
        SELECT count(*) AS n_lines, count(*) FILTER (line = '') AS n_empty,
               CAST(sum(length(line)) AS BIGINT) AS n_chars, max(length(line)) AS longest
        FROM (SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM documents)""",
    "scan_action_log": f"""
        WITH {_ACTIONS}
        SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, session_id, k AS page_id, action_time,
               CASE WHEN event_type = 'signup' THEN event_type END AS search_keyword,
               CASE WHEN event_type = 'view' THEN k ELSE -1 END AS click_category_id,
               CASE WHEN event_type = 'view' THEN k ELSE -1 END AS click_product_id,
               CASE WHEN event_type = 'click' THEN nullif(array_to_string(ids, ','), '') END AS order_category_ids,
               CASE WHEN event_type = 'click' THEN nullif(array_to_string(ids, ','), '') END AS order_product_ids,
               CASE WHEN event_type = 'purchase' THEN nullif(array_to_string(ids, ','), '') END AS pay_category_ids,
               CASE WHEN event_type = 'purchase' THEN nullif(array_to_string(ids, ','), '') END AS pay_product_ids,
               user_id % 25 AS city_id
        FROM log""",
    "scan_action_log_bad": f"""
        WITH {_ACTIONS}, {_TEXTS}
        SELECT concat_ws('_', f1, f2, f3, f4, f5) AS line FROM texts WHERE user_id % 50 = 0
        UNION ALL SELECT concat_ws('_', f1, f2, f3, f4, f5, f6, f7, f7, f9, f9, f11, f11, f13, 'more')
        FROM texts WHERE user_id % 50 = 1
        UNION ALL SELECT concat_ws('_', f1, f2, f3, 'page', f5, f6, f7, f7, f9, f9, f11, f11, f13)
        FROM texts WHERE user_id % 50 = 2""",
    "scan_csv": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "scan_tsv": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "scan_json": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "values_scan": """
        SELECT event_type, action, count(*) AS n FROM events
        JOIN (VALUES ('view', 'click'), ('click', 'order'), ('purchase', 'pay')) v(event_type, action)
        USING (event_type) GROUP BY event_type, action""",
    "sink_text": "SELECT concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority) AS line FROM orders",
    "sink_text_single": """
        SELECT concat_ws(',', o_custkey, count(*), max(o_orderkey)) AS line FROM orders GROUP BY o_custkey""",
    "sink_parquet": _CENTS,
    "project_columns": "SELECT event_id AS id, event_type AS kind FROM events",
    "filter_clicks": f"""
        WITH {_ACTIONS} SELECT session_id, action_time, k AS click_category_id
        FROM log WHERE event_type = 'view'""",
    "filter_in_set": f"""
        WITH {_ACTIONS} SELECT event_id, user_id AS session_id, k AS page_id
        FROM log WHERE k IN (1, 2, 3, 4, 5, 6, 7)""",
    "sql_view_filter": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 1000",
    "dsl_filter": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 1000",
    "explode_ids": """
        SELECT id, count(*) AS n
        FROM (SELECT unnest([l_orderkey, l_partkey, l_suppkey]) AS id FROM lineitem WHERE l_returnflag <> 'N')
        GROUP BY id""",
    "word_count": _WORDS + " ORDER BY n DESC, word LIMIT 10",
    "word_count_all": _WORDS,
    "keyed_sum": "SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey",
    "global_sum": "SELECT sum(l_quantity) AS total FROM lineitem",
    "charge_summary": _CENTS,
    # Rounds the shortest decimal text of the mean half up, as Spark does.
    "charge_summary_plain": """
        SELECT l_suppkey, max(l_quantity) AS max_duration,
               CAST(round(CAST(CAST(avg(l_quantity) AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE)
               AS avg_duration
        FROM lineitem GROUP BY l_suppkey""",
    "action_counts": f"WITH {_ACTIONS}, {_COUNTS} SELECT * FROM counts",
    "full_outer_counts": f"WITH {_ACTIONS}, {_COUNTS} SELECT * FROM counts",
    "collect_list_agg": f"""
        SELECT o_custkey, CAST((greatest(pos, 1) - 1) // 10000 AS BIGINT) AS part,
               coalesce(string_agg(p, ',' ORDER BY pos) FILTER (p IS NOT NULL), '') AS priorities
        FROM (SELECT *, count(p) OVER (PARTITION BY o_custkey ORDER BY p NULLS FIRST, o_orderkey ROWS UNBOUNDED PRECEDING) AS pos
              FROM {_RATED})
        GROUP BY 1, 2""",
    "collect_list_nulls": f"""
        SELECT o_custkey, CAST((pos - 1) // 3 AS BIGINT) AS part,
               string_agg(coalesce(p, 'none'), ',' ORDER BY pos) AS priorities
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos FROM {_RATED})
        GROUP BY 1, 2""",
    "collect_list_split": _LISTS.format(
        size=5, value="CAST(o_orderkey AS VARCHAR)", order="o_orderkey", rows="orders", out="order_keys"
    ),
    "count_matching": _URGENT,
    "udf_over_list": _URGENT,
    "udf_over_list_sql": _URGENT,
    "fold_in_batches": _URGENT,
    "udf_over_array": """
        SELECT vec_id, round(CAST(list_max(embedding) AS DOUBLE) - CAST(list_min(embedding) AS DOUBLE), 4) AS span
        FROM embeddings""",
    "longest_gap": """
        SELECT user_id, CAST(coalesce(max(t1 - t0), 0) AS BIGINT) AS seconds
        FROM (SELECT user_id, t1, lag(t1) OVER (PARTITION BY user_id ORDER BY t1) AS t0
              FROM (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t1 FROM events))
        GROUP BY user_id""",
    "udaf_mean": "SELECT event_type, round(avg(value), 4) AS mean FROM events GROUP BY event_type",
    "scalar_udfs": _SCALARS,
    "scalar_builtins": _SCALARS,
    "udf_sql": """
        SELECT upper(c_name) AS name_upper, c_custkey + 1 AS next_key, c_acctbal
        FROM customer WHERE c_acctbal >= 1000""",
    "join_inner": _ORDERS_CUSTOMER,
    "join_broadcast": _ORDERS_CUSTOMER,
    "join_broadcast_checked": """
        SELECT p_brand, p_partkey, n_parts FROM part
        JOIN (SELECT p_brand, count(*) AS n_parts FROM part GROUP BY p_brand) USING (p_brand)""",
    "join_shuffle_hash": _ORDERS_CUSTOMER,
    "join_shuffle_hash_cut": """
        SELECT o_orderstatus, o_orderkey, o_orderpriority, n
        FROM (SELECT o_orderstatus, o_orderkey FROM orders)
        JOIN (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) USING (o_orderstatus)""",
    "join_text_files": """
        SELECT concat_ws(',', o_custkey, o_orderkey, o_orderpriority, c_mktsegment) AS line
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "semi_join_topk": f"""
        WITH {_ACTIONS}, {_COUNTS}, {_TOP}
        SELECT session_id, action_time, k AS click_category_id FROM log
        WHERE event_type = 'view' AND k IN (SELECT category_id FROM top)""",
    "star_join": f"WITH {_STAR} SELECT * FROM star",
    "union_all": """
        SELECT c_custkey AS key, c_name AS name, c_mktsegment FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
    "top_k_per_group": """
        SELECT * FROM (
          SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice,
                 row_number() OVER (PARTITION BY l_suppkey
                   ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank
          FROM lineitem)
        WHERE rank <= 3""",
    "top_k_per_group_steps": """
        SELECT * FROM (
          SELECT o_orderstatus, o_orderkey, o_totalprice,
                 row_number() OVER (PARTITION BY o_orderstatus
                   ORDER BY o_totalprice DESC, o_orderkey) AS rank
          FROM orders)
        WHERE rank <= 2000""",
    "top_k_per_group_large": """
        SELECT * FROM (
          SELECT l_linestatus, l_quantity, l_orderkey, l_linenumber,
                 row_number() OVER (PARTITION BY l_linestatus
                   ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS rank
          FROM lineitem)
        WHERE rank <= 100000""",
    "adjacent_pairs": _ADJACENT,
    "adjacent_pairs_split": _ADJACENT,
    "session_path": _PATH,
    "session_path_split": _PATH,
    "hot_categories": f"WITH {_ACTIONS}, {_COUNTS}, {_TOP} SELECT * FROM top",
    "category_sessions": f"""
        WITH {_ACTIONS}, {_COUNTS}, {_TOP},
        clicked AS (
          SELECT k AS category_id, session_id, count(*) AS click_count FROM log
          WHERE event_type = 'view' AND k IN (SELECT category_id FROM top) GROUP BY 1, 2)
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY category_id
                      ORDER BY click_count DESC, session_id) AS rank FROM clicked)
        WHERE rank <= 10""",
    "page_flow_filtered": _FLOW.format(next=_NEXT.format(where="WHERE page_id BETWEEN 1 AND 7"))
    + _FLOW_ALL,
    "page_flow_strict": _STRICT,
    "page_flow_split": _STRICT,
    "page_flow_configured": _FLOW.format(next=_NEXT.format(where=""))
    + """
        SELECT CAST(p AS BIGINT) AS from_page, CAST(p + 1 AS BIGINT) AS to_page,
               coalesce(jumps, 0) AS jumps, coalesce(visits, 0) AS visits,
               CASE WHEN visits > 0 THEN CAST(coalesce(jumps, 0) AS DOUBLE) / visits ELSE 0.0 END AS rate
        FROM (VALUES (1), (2), (3), (4), (5), (6)) w(p)
        LEFT JOIN jump ON jump.page_id = p AND jump.next_page_id = p + 1
        LEFT JOIN seen ON seen.page_id = p""",
    "area_product_clicks": f"""
        WITH {_STAR} SELECT area, product_name, count(*) AS click_count
        FROM star GROUP BY area, product_name""",
    "area_top3": f"WITH {_STAR}, {_AREA_RANKED} SELECT * FROM ranked WHERE rank <= 3",
    "area_top3_remark": _REMARK.format(star=_STAR, ranked=_AREA_RANKED, lost=0, rest=3),
    "area_top3_remark_large_products": _REMARK.format(
        star=_STAR, ranked=_AREA_RANKED, lost=0, rest=3
    ),
    "area_top3_remark_legacy": _REMARK.format(star=_STAR, ranked=_AREA_RANKED, lost=1, rest=2),
    "merge_replace": _pick("max_by"),
    "merge_keep": _pick("min_by"),
    "merge_add": """
        SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM orders GROUP BY o_custkey""",
    "merge_list": _LISTS.format(
        size=10000, value="o_orderpriority", order="o_orderdate, o_orderkey", rows="orders", out="o_orderpriority"
    ),
    "merge_set": _LISTS.format(
        size=10000,
        value="o_orderpriority",
        order="o_orderpriority",
        rows="(SELECT DISTINCT o_custkey, o_orderpriority FROM orders)",
        out="o_orderpriority",
    ),
    "vector_sum": _vector_sum("CASE pos WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 0 END"),
    "vector_sum_fixed": _vector_sum("0"),
}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
