"""A table's snapshot and its change log as one stream of changes, each of them once, and the table's state from it.

A table is snapshotted in chunks while its log goes on. A chunk holds every
change up to the log position it was read at, so of the log only later changes
of the chunk's rows count; earlier ones are in the snapshot already, and what
the log has forgotten is only there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.operators import parsing

# Fixed value: the operation of a record that was read, not changed.
READ_OP = "r"


def changes(messages: DataFrame, table: str) -> DataFrame:
    """(row_key, position, op, and the table's fields as text) of every usable change or snapshot record of a table.

    ``position`` is the place in the log (the capture time if a record names none). A delete has the key of the row it
    removed and no fields. Records without a key, of other tables, or for ``parsing.quarantine`` fall away.
    """
    key = parsing.KEYS[table]
    deleted = F.col("after").isNull() | F.col("op").eqNullSafe(parsing.DELETE_OP)
    fields = [F.when(~deleted, F.col(f"after.{name}")).alias(name) for name in parsing.TABLES[table].names]
    return (
        parsing.parsed(parsing.drop_tombstones(messages), schemas.change_record(parsing.TABLES[table]))
        .filter(F.col("_corrupt").isNull() & F.col("source.table").eqNullSafe(table))
        .select(
            F.coalesce(f"after.{key}", f"before.{key}").alias("row_key"),
            F.coalesce("source.pos", "ts_ms").alias("position"),
            F.when(deleted, parsing.DELETE_OP).otherwise(F.coalesce("op", F.lit("u"))).alias("op"),
            *fields,
        )
        .filter(F.col("row_key").isNotNull() & F.col("position").isNotNull())
    )


def handed_over(records: DataFrame, positions: DataFrame, chunk: Column) -> DataFrame:
    """Snapshot records, and of each row's changes those that its chunk's snapshot does not hold; every one once.

    ``records`` are what ``changes`` gives for snapshot and log together, in any
    arrangement and delivered any number of times. ``positions`` has (chunk,
    position) of every chunk read so far and ``chunk`` says which one a row
    belongs to; all changes of a chunk that is not read yet count.
    """
    read = positions.select(F.col("chunk").alias("_chunk"), F.col("position").alias("_read_at"))
    found = records.withColumn("_of", chunk).join(read, F.col("_of") == F.col("_chunk"), "left")
    later = (F.col("op") == READ_OP) | F.col("_read_at").isNull() | (F.col("position") > F.col("_read_at"))
    return found.filter(later).select(*records.columns).distinct()


def last_state(events: DataFrame) -> DataFrame:
    """The last record of each row by position, without rows whose last record is a delete; combines before the shuffle.

    Of records at the same position that differ, that with the larger fields counts.
    """
    held = [name for name in events.columns if name not in ("row_key", "position")]
    last = F.max(F.struct("position", *held)).alias("_last")
    rows = events.groupBy("row_key").agg(last).select("row_key", "_last.*")
    return rows.filter(F.col("op") != parsing.DELETE_OP).drop("op")


def table_state(messages: DataFrame, table: str, positions: DataFrame, chunk: Column) -> DataFrame:
    """Rows of a table as of the end of its log, in the types of the table's contract, from snapshot and log messages."""
    state = last_state(handed_over(changes(messages, table), positions, chunk))
    fields = [f"try_cast({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in parsing.TABLES[table]]
    return state.selectExpr(*fields, "position")
