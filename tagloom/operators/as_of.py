"""Rows with what was valid at their own time: as-of joins and versioned dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.timeparts import slot_of
from tagloom.operators.prefix_scan import last_known, min_before, prefix_scan

# A key's rows are scanned by the day.
SLOT_MS = 24 * 60 * 60 * 1000


def as_of_join(
    rows: DataFrame, rules: DataFrame, key: str, ms: str, values: list[str], order: list[str], slot_ms: int = SLOT_MS
) -> DataFrame:
    """``rows`` with ``values`` of the latest rule of their ``key`` at or before their time ``ms``; NULL without one.

    Both frames have ``key`` and ``ms``. Rules of the same time follow each
    other in ``order``. A row without a key or time meets no rule.

    Rows and rules are put in one line per key and the last rule known is
    carried along it, slot by slot, so neither a key with very many rows nor
    one with very many rules is gathered in a task, and no pairs are made.
    """
    kind = rules.select(F.struct(*values).alias("s")).schema["s"].dataType
    held = rows.select(F.struct(*rows.columns).alias("s")).schema["s"].dataType
    places = [F.struct(*order).alias("_place")] if order else [F.struct(F.lit(0)).alias("_place")]
    place = rules.select(*places).schema["_place"].dataType
    lefts = rows.select(
        F.col(key).alias("_key_of"), F.col(ms).alias("_ms"), F.lit(1).alias("_side"), F.lit(None).cast(place).alias("_place"),
        F.lit(None).cast(kind).alias("_rule"), F.struct(*rows.columns).alias("_row"),
    )
    known = rules.filter(F.col(key).isNotNull() & F.col(ms).isNotNull())
    rights = known.select(
        F.col(key).alias("_key_of"), F.col(ms).alias("_ms"), F.lit(0).alias("_side"), *places,
        F.struct(*values).alias("_rule"), F.lit(None).cast(held).alias("_row"),
    )
    line = ["_ms", "_side", "_place"]
    scanned = prefix_scan(
        lefts.unionByName(rights), "_key_of", line, slot_of(F.col("_ms"), slot_ms), [last_known("_found", "_rule", line)]
    )
    return scanned.filter("_side = 1").select("_row.*", "_found.*")


def versions(
    changes: DataFrame, key: str, ms: str, values: list[str], order: list[str], deleted: str | None = None, slot_ms: int = SLOT_MS
) -> DataFrame:
    """(key, values, valid_from, valid_to) of a dimension row from its changes; ``valid_to`` is NULL while it is valid.

    Of changes at one time the last in ``order`` counts. A delete ends a
    version and begins none. Changes without a key or time fall away.
    """
    flag = F.col(deleted) if deleted else F.lit(False)
    last = (
        changes.filter(F.col(key).isNotNull() & F.col(ms).isNotNull())
        .groupBy(F.col(key).alias("_of"), F.col(ms).alias("valid_from"))
        .agg(F.max_by(F.struct(flag.alias("_deleted"), *values), F.struct(*order)).alias("_row"))
    )
    # Backwards along the line, the next version's time is the smallest one met so far.
    back = last.withColumn("_back", -F.col("valid_from"))
    scanned = prefix_scan(back, "_of", ["_back"], slot_of(F.col("_back"), slot_ms), [min_before("valid_to", "valid_from")])
    return scanned.filter(~F.coalesce("_row._deleted", F.lit(False))).select(
        F.col("_of").alias(key), *[F.col(f"_row.{name}").alias(name) for name in values], "valid_from", "valid_to"
    )


def with_version(rows: DataFrame, dimension: DataFrame, key: str, ms: str) -> DataFrame:
    """``rows`` with the version of their ``key`` that was valid at their time; NULL without one.

    A join by key and range of time; write the versions first (``session.written``), so that Spark chooses how by bytes.
    """
    dim = dimension.withColumnRenamed(key, "_dim_key")
    valid = (F.col(ms) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(ms) < F.col("valid_to")))
    return rows.join(dim, (F.col(key) == F.col("_dim_key")) & valid, "left").drop("_dim_key", "valid_from", "valid_to")
