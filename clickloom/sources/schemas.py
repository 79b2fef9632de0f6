"""Explicit schemas of the input tables.

Ids are ``bigint``; dates and times stay text, as in the files.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
}


def _struct(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


USER_VISIT_ACTION = _struct(
    date="string",
    user_id="bigint",
    session_id="string",
    page_id="bigint",
    action_time="string",
    search_keyword="string",
    click_category_id="bigint",
    click_product_id="bigint",
    order_category_ids="string",
    order_product_ids="string",
    pay_category_ids="string",
    pay_product_ids="string",
    city_id="bigint",
)

CITY_INFO = _struct(city_id="bigint", city_name="string", area="string")

PRODUCT_INFO = _struct(product_id="bigint", product_name="string", extend_info="string")

CHARGE_EVENTS = _struct(
    charging_event="int",
    chargepoint_id="string",
    start_date="string",
    start_time="string",
    end_date="string",
    end_time="string",
    energy="string",
    plugin_duration="double",
)

# Marks used inside the action log.
ABSENT_TEXT = "null"
NOT_A_CLICK = -1
