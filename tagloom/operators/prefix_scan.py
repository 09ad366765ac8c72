"""Running values per key in a total order, in one plan for every key.

A window function over a whole key puts all of its rows into one task, and some
keys (guests, NULL) hold a third of the log. So every key is cut into slots that
follow the order: rows are scanned within (key, slot), each slot adds up to one
row, and what earlier slots add up to is joined back. How often a key occurs
makes no difference to the plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scan:
    """A running value: within a slot, of a whole slot, over earlier slots, and the two put together."""

    name: str
    within: Callable[[WindowSpec], Column]
    whole: Column
    earlier: Callable[[Column, WindowSpec], Column]
    together: Callable[[Column, Column], Column]


@dataclass(frozen=True)
class RunningSet:
    """Distinct non-null values of a column so far, the current row included."""

    name: str
    column: str


def running_count(name: str) -> Scan:
    return Scan(
        name,
        lambda w: F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        F.count(F.lit(1)),
        lambda whole, w: F.sum(whole).over(w),
        lambda before, within: F.coalesce(before, F.lit(0).cast("long")) + within,
    )


def max_before(name: str, column: str) -> Scan:
    """Largest value of the rows before the current one."""
    return Scan(
        name,
        lambda w: F.max(column).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        F.max(column),
        lambda whole, w: F.max(whole).over(w),
        lambda before, within: F.greatest(before, within),
    )


def min_before(name: str, column: str) -> Scan:
    """Smallest value of the rows before the current one."""
    return Scan(
        name,
        lambda w: F.min(column).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        F.min(column),
        lambda whole, w: F.min(whole).over(w),
        lambda before, within: F.least(before, within),
    )


def last_known(name: str, column: str, order: list[str]) -> Scan:
    """The last value that is not NULL up to the current row; ``order`` is the scan's."""
    return Scan(
        name,
        lambda w: F.last(column, True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*order))),
        lambda whole, w: F.last(whole, True).over(w),
        lambda before, within: F.coalesce(within, before),
    )


def running_sum(name: str, column: str) -> Scan:
    """Sum of the rows before the current one."""
    nothing = F.lit(0).cast("long")
    return Scan(
        name,
        lambda w: F.sum(column).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        F.sum(column),
        lambda whole, w: F.sum(whole).over(w),
        lambda before, within: F.coalesce(before, nothing) + F.coalesce(within, nothing),
    )


def by_key(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_key``: the key in a struct, which is never NULL.

    So a NULL key meets a NULL key in a plain equi join, by the same expression as rows are grouped and scanned by: what
    is joined to scanned rows moves to where they already lie.
    """
    return rows.withColumn("_key", F.struct(F.col(key).alias("key")))


def first_slots(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """(_key, field, value, _slot): the slot each value was first seen in; combines before the shuffle.

    ``rows`` have ``_key`` and ``_slot``; ``fields`` maps the name of a field to its column.
    """
    pairs = ", ".join(f"struct('{name}' AS field, {column} AS value)" for name, column in fields.items())
    return (
        rows.selectExpr("_key", "_slot", f"inline(array({pairs}))")
        .filter(F.col("value").isNotNull())
        .groupBy("_key", "field", "value")
        .agg(F.min("_slot").alias("_slot"))
    )


def values_before(slots: DataFrame, firsts: DataFrame, names: list[str]) -> DataFrame:
    """(_key, _slot) of ``slots`` with, per field, the array ``_before_<name>`` of the values first seen in earlier slots.

    Values stay rows until the arrays that are asked for are made: ``slots`` meet the first-seen rows of their key, a
    plain join whose skewed keys AQE splits, and what meets is as much as the arrays hold.
    """
    known = firsts.select(F.col("_key").alias("_its_key"), "field", "value", F.col("_slot").alias("_seen_in"))
    met = slots.select("_key", "_slot").join(
        known, (F.col("_key") == F.col("_its_key")) & (F.col("_seen_in") < F.col("_slot")), "left"
    )
    # One list for all fields, taken apart afterwards: a list of each would be kept and handed on for every row that meets.
    both = F.when(F.col("field").isNotNull(), F.struct("field", "value"))
    together = met.groupBy("_key", "_slot").agg(F.collect_list(both).alias("_met"))
    return together.select(
        "_key",
        "_slot",
        *[
            F.expr(f"transform(filter(_met, one -> one.field = '{name}'), one -> one.value)").alias(f"_before_{name}")
            for name in names
        ],
    )


def prefix_scan(rows: DataFrame, key: str, order: list[str], slot: Column, scans: list[Scan | RunningSet]) -> DataFrame:
    """``rows`` with one column per scan.

    ``order`` must be a total order within a key, and ``slot`` a number that
    never falls along it (such as a time divided by a width); NULL comes first.
    """
    columns = rows.columns
    simple = [scan for scan in scans if isinstance(scan, Scan)]
    sets = [scan for scan in scans if isinstance(scan, RunningSet)]
    slotted = by_key(rows, key).withColumn("_slot", F.coalesce(slot, F.lit(-(1 << 63)).cast("long")))
    whole = slotted.groupBy("_key", "_slot").agg(
        F.count(F.lit(1)).alias("_rows"), *[scan.whole.alias(f"_whole_{scan.name}") for scan in simple]
    )
    earlier = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select(
        "_key",
        "_slot",
        *[scan.earlier(F.col(f"_whole_{scan.name}"), earlier).alias(f"_before_{scan.name}") for scan in simple],
    )
    if sets:
        firsts = first_slots(slotted, {scan.name: scan.column for scan in sets})
        carried = carried.join(values_before(whole, firsts, [scan.name for scan in sets]), ["_key", "_slot"])
    window = Window.partitionBy("_key", "_slot").orderBy(*order)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = slotted.select(
        "*",
        *[scan.within(window).alias(f"_within_{scan.name}") for scan in simple],
        *[F.collect_set(scan.column).over(so_far).alias(f"_within_{scan.name}") for scan in sets],
    )
    return scanned.join(carried, ["_key", "_slot"]).select(
        *columns,
        *[scan.together(F.col(f"_before_{scan.name}"), F.col(f"_within_{scan.name}")).alias(scan.name) for scan in simple],
        *[F.array_union(f"_before_{scan.name}", f"_within_{scan.name}").alias(scan.name) for scan in sets],
    )
