"""Inner join of two timed frames: equal keys, times within a bound, both ends inclusive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.timeparts import slot_of
from tagloom.operators.parsing import with_key

# The bounds of the two joins.
USER_BOUND_MS = 30 * 60 * 1000
ORDER_BOUND_MS = 2 * 60 * 1000


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_ms: str,
    right_ms: str,
    bound_ms: int,
    slot_bounds: int = 16,
    slot: str | None = None,
) -> DataFrame:
    """Batch form.

    An equi join on the key alone would put all rows of a hot key into one task
    and compare every pair of them. So time is cut into slots of
    ``slot_bounds`` bounds and the join is on (key, slot): a right row is in
    its own slot, a left row in the one or two slots its interval touches
    (1 + 2 / ``slot_bounds`` copies on average). Each pair meets in exactly one
    slot, the right row's, so nothing is doubled. A (key, slot) that is still
    hot is an ordinary skewed inner join, which AQE splits.

    Both sides are facts. The size Spark expects of rows parsed from text is a
    fraction of their real one, so a sort-merge join is asked for rather than
    leaving it a broadcast to choose.

    ``slot`` names a column for the slot a pair has met in: with the right key it says where the pairs lie.

    Give the smaller side as ``left``. The frames must not share column names.
    """
    width = slot_bounds * bound_ms
    first = slot_of(F.col(left_ms) - bound_ms, width)
    last = slot_of(F.col(left_ms) + bound_ms, width)
    lefts = left.withColumn("_left_slot", F.explode(F.sequence(first, last)))
    rights = right.withColumn("_right_slot", slot_of(F.col(right_ms), width))
    pairs = lefts.join(
        rights.hint("merge"),
        (F.col(left_key) == F.col(right_key))
        & (F.col("_left_slot") == F.col("_right_slot"))
        & F.col(right_ms).between(F.col(left_ms) - bound_ms, F.col(left_ms) + bound_ms),
        "inner",
    ).drop("_left_slot")
    return pairs.drop("_right_slot") if slot is None else pairs.withColumnRenamed("_right_slot", slot)


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns renamed with a prefix, to keep the two sides of a join apart."""
    return df.withColumnsRenamed({name: prefix + name for name in df.columns})


def users_with_supplements(users: DataFrame, supplements: DataFrame, bound_ms: int = USER_BOUND_MS) -> DataFrame:
    """User rows paired with their supplementary rows (columns ``s_*``)."""
    return interval_join(users, prefixed(supplements, "s_"), "id", "s_uid", "ts_ms", "s_ts_ms", bound_ms)


def orders_with_details(
    orders: DataFrame, details: DataFrame, bound_ms: int = ORDER_BOUND_MS, slot: str | None = None
) -> DataFrame:
    """Order rows merged with each of their details; with ``slot``, next to the slot they have met in."""
    return merged_order(
        interval_join(
            with_key(orders, "id"),
            prefixed(with_key(details, "order_id"), "d_"),
            "id",
            "d_order_id",
            "ts_ms",
            "d_ts_ms",
            bound_ms,
            slot=slot,
        ),
        *([] if slot is None else [slot]),
    )


# Fixed order: all order fields and nine detail fields; the order's times win, the detail's id becomes ``detail_id``.
_MERGED = {
    "order_id": "d_order_id",
    "detail_id": "d_id",
    "uid": "uid",
    "consignee": "consignee",
    "create_time": "create_time",
    "ts_ms": "ts_ms",
    "original_total_amount": "original_total_amount",
    "total_amount": "total_amount",
    "province_id": "province_id",
    "pay_time_slot": "pay_time_slot",
    "sku_id": "d_sku_id",
    "sku_num": "d_sku_num",
    "sku_name": "d_sku_name",
    "order_price": "d_order_price",
    "split_total_amount": "coalesce(try_cast(d_split_total_amount AS double), 0D)",
    "split_activity_amount": "coalesce(try_cast(d_split_activity_amount AS double), 0D)",
    "split_coupon_amount": "d_split_coupon_amount",
    "detail_ts_ms": "d_ts_ms",
}
MERGED_COLUMNS = list(_MERGED)


def merged_order(pairs: DataFrame, *kept: str) -> DataFrame:
    """Merged rows of pairs of an order and a detail, next to the ``kept`` columns."""
    return pairs.selectExpr(*[f"{source} AS {name}" for name, source in _MERGED.items()], *kept)
