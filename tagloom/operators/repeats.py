"""Removal of repeated records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.operators.prefix_scan import by_key
from tagloom.session import written


def without_repeats(rows: DataFrame) -> DataFrame:
    """One of each full record. Copies combine before the shuffle and spread by the whole record, not by user."""
    return rows.distinct()


def rising_only(rows: DataFrame, key: str, value: str, order: list[str], slot: Column) -> DataFrame:
    """Per key in arrival order, the rows whose value exceeds that of every row before them.

    The first row of a key always passes, and a NULL value counts as 0.
    ``order`` must be a total order and ``slot`` follow it, as in ``prefix_scan``.

    Rows move once, to the others of their (key, slot): what does not rise there never passes. The slots' largest values,
    a row per (key, slot), are then carried along the key; they join back only where an earlier slot has one.
    """
    known = by_key(rows.withColumn(value, F.coalesce(value, F.lit(0).cast("long"))), key)
    known = known.withColumn("_slot", F.coalesce(slot, F.lit(-(1 << 63)).cast("long")))
    before = Window.partitionBy("_key", "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rising = known.withColumn("_seen", F.max(value).over(before))
    rising = rising.filter(F.col("_seen").isNull() | (F.col(value) > F.col("_seen"))).drop("_seen")
    earlier = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rising.groupBy("_key", "_slot").agg(F.max(value).alias("_top"))
        .select("_key", "_slot", F.max("_top").over(earlier).alias("_before"))
        .filter(F.col("_before").isNotNull())
    )
    return (
        rising.join(carried, ["_key", "_slot"], "left")
        .filter(F.col("_before").isNull() | (F.col(value) > F.col("_before")))
        .select(*rows.columns)
    )


def rising_where_met(rows: DataFrame, key: str, value: str, order: list[str], slot: Column, met: list[str]) -> DataFrame:
    """``rising_only`` of rows that lie by the columns ``met`` already, as those of a join do.

    What does not rise among the rows of its key that lie with it never passes, so it falls away there, and the rest is
    written. For a key whose rows have all met in one place that is all; only rows of the other keys move.
    """
    known = rows.withColumn(value, F.coalesce(value, F.lit(0).cast("long")))
    before = Window.partitionBy(*met, key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rising = known.withColumn("_seen", F.max(value).over(before))
    kept = written(rising.filter(F.col("_seen").isNull() | (F.col(value) > F.col("_seen"))).drop("_seen"), "rising-rows")
    places = kept.select(key, *met).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("_places"))
    several = written(by_key(places.filter("_places > 1"), key).select("_key"), "keys-in-several-places")
    if several.isEmpty():
        return kept
    keyed = by_key(kept, key)
    moved = rising_only(keyed.join(several, "_key", "left_semi").drop("_key"), key, value, order, slot)
    return keyed.join(several, "_key", "left_anti").drop("_key").unionByName(moved)
