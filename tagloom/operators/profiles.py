"""Running user profiles: page views so far and the distinct device and search values so far."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.timeparts import slot_of
from tagloom.operators.page_logs import PROFILE_FIELDS
from tagloom.operators.prefix_scan import (
    RunningSet,
    by_key,
    first_slots,
    prefix_scan,
    running_count,
    values_before,
)

# Fixed value: length of the tumbling window.
WINDOW_MS = 2 * 60 * 1000

# A user's records and windows are scanned by the day: what is carried from slot to slot, the values of a user for each of
# their slots, is less than the records if a slot has several of them.
RECORD_SLOT_MS = 24 * 60 * 60 * 1000
WINDOW_SLOTS = 720

# Total order of a user's records once repeats are gone.
RECORD_ORDER = ["ts", *PROFILE_FIELDS, "other_info"]


def joined(values: Column) -> Column:
    """A set as text: sorted, comma-joined; empty text for no values."""
    return F.array_join(F.array_sort(values), ",")


def running_views(records: DataFrame, slot_ms: int = RECORD_SLOT_MS) -> DataFrame:
    """Each record with the user's page views up to it (``pv``)."""
    return prefix_scan(records, "uid", RECORD_ORDER, slot_of(F.col("ts"), slot_ms), [running_count("pv")])


def running_profile(records: DataFrame, slot_ms: int = RECORD_SLOT_MS) -> DataFrame:
    """Each record with page views and value sets up to it; one output row per input row."""
    scans = [running_count("pv"), *[RunningSet(f"{name}_set", name) for name in PROFILE_FIELDS]]
    return prefix_scan(records, "uid", RECORD_ORDER, slot_of(F.col("ts"), slot_ms), scans)


def last_profile(records: DataFrame) -> DataFrame:
    """Each user's page views and value sets over all records; what a stream can start from. Combines before the shuffle."""
    return records.groupBy("uid").agg(
        F.count(F.lit(1)).alias("pv"), *[F.collect_set(name).alias(f"{name}_set") for name in PROFILE_FIELDS]
    )


def last_in_window(rows: DataFrame, order: list[str], width_ms: int = WINDOW_MS, time: str = "ts") -> DataFrame:
    """The last row per user and tumbling window; combines before the shuffle, so hot users are no problem.

    Windows are on event time; give an arrival-time column as ``time`` for windows on arrival.
    """
    payload = [name for name in rows.columns if name != "uid"]
    return (
        rows.groupBy("uid", slot_of(F.col(time), width_ms).alias("_slot"))
        .agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_last"))
        .select("uid", (F.col("_slot") * width_ms).alias("window_start"), "_last.*")
    )


def profile_values(records: DataFrame, width_ms: int = WINDOW_MS) -> DataFrame:
    """The value sets in long form: one row per user, field and value, with the window it was first seen in."""
    slotted = by_key(records, "uid").withColumn("_slot", slot_of(F.col("ts"), width_ms))
    return first_slots(slotted, {name: name for name in PROFILE_FIELDS}).select(
        F.col("_key.key").alias("uid"), "field", "value", (F.col("_slot") * width_ms).alias("window_start")
    )


def windowed_profile(records: DataFrame, width_ms: int = WINDOW_MS, range_slots: int = WINDOW_SLOTS) -> DataFrame:
    """The running profile as of the last record of each user and window.

    Equal to ``last_in_window`` of ``running_profile``, without ever running
    over single records: views are counted per window and each value is kept
    with the window it was first seen in, both with map-side combining. Those
    rows are scanned by user and range of windows; what earlier ranges add up to
    is one row per user and range, so a user with very many windows, such as all
    guests together, is spread over tasks like any others.
    """
    slotted = by_key(records, "uid").withColumn("_slot", slot_of(F.col("ts"), width_ms))
    views = slotted.groupBy("_key", "_slot").agg(F.count(F.lit(1)).alias("views"))
    firsts = first_slots(slotted, {name: name for name in PROFILE_FIELDS})
    in_range = F.floor(F.col("_slot") / range_slots).cast("long")

    whole = views.groupBy("_key", in_range.alias("_slot")).agg(F.sum("views").alias("_views"))
    earlier = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select(
        "_key", "_slot", F.coalesce(F.sum("_views").over(earlier), F.lit(0).cast("long")).alias("_before_pv")
    )
    sets = values_before(whole, firsts.withColumn("_slot", in_range), list(PROFILE_FIELDS))
    carried = carried.join(sets, ["_key", "_slot"])
    # A range frame takes in all rows of a window, so the views row sees the values first seen in it.
    so_far = "OVER (PARTITION BY _key, _slot ORDER BY _window RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    scanned = (
        views.unionByName(firsts, allowMissingColumns=True)
        .select("*", in_range.alias("_range"))
        .withColumnsRenamed({"_slot": "_window", "_range": "_slot"})
        .selectExpr(
            "_key",
            f"_window * {width_ms} AS window_start",
            "_slot",
            "views",
            f"sum(views) {so_far} AS pv",
            *[f"collect_list(CASE WHEN field = '{name}' THEN value END) {so_far} AS {name}_set" for name in PROFILE_FIELDS],
        )
        .filter(F.col("views").isNotNull())
    )
    return scanned.join(carried, ["_key", "_slot"]).select(
        F.col("_key.key").alias("uid"),
        "window_start",
        (F.col("_before_pv") + F.col("pv")).alias("pv"),
        *[F.concat(f"_before_{name}", f"{name}_set").alias(f"{name}_set") for name in PROFILE_FIELDS],
    )


# Bits of a sketch's register number: 4,096 registers, a relative standard error of 1.04 / sqrt(4096) = 1.6 %.
SKETCH_BITS = 12


def windowed_distinct(records: DataFrame, width_ms: int = WINDOW_MS, range_slots: int = WINDOW_SLOTS) -> DataFrame:
    """Page views and the number of different values so far, as of the end of each user and window, by bounded sketches.

    The bounded form of ``windowed_profile``: a set never takes more than a
    sketch of 4,096 registers, however many values a user (all guests, say) has
    seen. Counts are estimates with a relative standard error of 1.6 %, exact to
    rounding up to a few hundred values. Sketches combine before the shuffle,
    are united along a range of windows, and one sketch per user and range is
    carried to the next.
    """
    slotted = by_key(records, "uid").withColumn("_window", slot_of(F.col("ts"), width_ms))
    views = slotted.groupBy("_key", "_window").agg(
        F.count(F.lit(1)).alias("views"),
        *[F.hll_sketch_agg(name, F.lit(SKETCH_BITS)).alias(f"_in_{name}") for name in PROFILE_FIELDS],
    )
    views = views.withColumn("_slot", F.floor(F.col("_window") / range_slots).cast("long"))
    united = [F.hll_union_agg(f"_in_{name}").alias(f"_in_{name}") for name in PROFILE_FIELDS]
    whole = views.groupBy("_key", "_slot").agg(F.sum("views").alias("_views"), *united)
    earlier = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select(
        "_key",
        "_slot",
        F.coalesce(F.sum("_views").over(earlier), F.lit(0).cast("long")).alias("_before_pv"),
        *[F.hll_union_agg(f"_in_{name}").over(earlier).alias(f"_before_{name}") for name in PROFILE_FIELDS],
    )
    so_far = Window.partitionBy("_key", "_slot").orderBy("_window").rowsBetween(Window.unboundedPreceding, 0)
    scanned = views.select(
        "_key",
        "_slot",
        (F.col("_window") * width_ms).alias("window_start"),
        F.sum("views").over(so_far).alias("pv"),
        *[F.hll_union_agg(f"_in_{name}").over(so_far).alias(f"_so_far_{name}") for name in PROFILE_FIELDS],
    )

    def estimate(name: str) -> Column:
        before, within = F.col(f"_before_{name}"), F.col(f"_so_far_{name}")
        both = F.when(before.isNull(), within).otherwise(F.hll_union(before, within))
        return F.hll_sketch_estimate(both).alias(f"n_{name}")

    return scanned.join(carried, ["_key", "_slot"]).select(
        F.col("_key.key").alias("uid"), "window_start", (F.col("_before_pv") + F.col("pv")).alias("pv"), *[estimate(name) for name in PROFILE_FIELDS]
    )
