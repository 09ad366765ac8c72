"""Change records from JSON text to typed rows.

Input frames have one STRING column ``value``. Every function parses each
record once; records that cannot be used go to ``quarantine`` instead of
failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom import schemas
from tagloom.functions import timeparts
from tagloom.session import STEP, settings

_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def drop_tombstones(messages: DataFrame) -> DataFrame:
    """A null message marks a compacted key; it carries no record."""
    return messages.filter(F.col("value").isNotNull())


def parsed(messages: DataFrame, schema: StructType, *kept: str) -> DataFrame:
    """``value`` text as top-level columns of ``schema``, next to the ``kept`` columns; all NULL for a null message.

    The record goes through ``inline``: a filter on parsed fields stays above
    it, while over a plain projection the optimizer would push the filter down
    and parse the text once more for every condition.
    """
    return messages.select(*kept, F.inline(F.array(F.from_json("value", schema, _JSON_OPTIONS))))


# What a record says it did to its row.
DELETE_OP = "d"

# Numeric keys by table.
NUMERIC_KEYS = {"user_info": "id", "user_info_sup": "uid"}
KEYS = {**NUMERIC_KEYS, "order_info": "id", "order_detail": "id"}


def _schema_change() -> Column:
    """A change of a table, not of a row: it holds a statement and no operation."""
    return F.col("op").isNull() & (F.col("ddl").isNotNull() | F.col("historyRecord").isNotNull())


def _deleted() -> Column:
    return F.col("op").eqNullSafe(DELETE_OP) | F.col("after").isNull()


def _bad_key() -> Column:
    """A row whose key should be a number and isn't."""
    table = F.col("source.table")
    bad = F.lit(False)
    for name, key in NUMERIC_KEYS.items():
        bad = bad | ((table == name) & F.expr(f"try_cast(after.{key} AS bigint)").isNull())
    return bad & ~_deleted()


def _reason() -> Column:
    """Why a record cannot be used; NULL if it can."""
    return (
        F.when(F.col("_corrupt").isNotNull(), "not json")
        .when(_schema_change(), "schema change")
        .when(F.col("source.table").isNull(), "no table")
        .when(_bad_key(), "bad key")
    )


def envelope(messages: DataFrame) -> DataFrame:
    """Table, capture time, kind (``row`` or ``delete``) and row key of each usable change record.

    A record without an operation is a delete if it has no row.
    """
    return (
        parsed(drop_tombstones(messages), schemas.ENVELOPE_HEAD)
        .filter(_reason().isNull())
        .select(
            F.col("source.table").alias("table"),
            "ts_ms",
            F.when(_deleted(), "delete").otherwise("row").alias("kind"),
            F.coalesce("after.id", "after.uid").alias("row_id"),
        )
    )


def quarantine(messages: DataFrame) -> DataFrame:
    """Messages that cannot be used, with the reason.

    Not JSON, a schema change, no table, or a row whose numeric key is none: together with rows, deletes and
    tombstones they make up all messages.
    """
    return (
        parsed(drop_tombstones(messages), schemas.ENVELOPE_HEAD, "value")
        .select("value", _reason().alias("reason"))
        .filter(F.col("reason").isNotNull())
    )


def route(messages: DataFrame, routes: dict[str, str]) -> DataFrame:
    """Target of each change record by the table it comes from; tables without a target are dropped.

    One pass for any number of targets: the target is a column, which the
    message and file sinks write by.
    """
    targets = F.create_map(*[F.lit(part) for pair in routes.items() for part in pair])
    return (
        parsed(messages, schemas.ROUTING, "value")
        .filter(F.col("source.table").isin(*routes))
        .select(targets[F.col("source.table")].alias("topic"), F.col("source.table").alias("table"), "ts_ms", "value")
    )


TABLES = {
    "user_info": schemas.USER_INFO,
    "user_info_sup": schemas.USER_INFO_SUP,
    "order_info": schemas.ORDER_INFO,
    "order_detail": schemas.ORDER_DETAIL,
}


def _rows_of(messages: DataFrame, table: str) -> DataFrame:
    """Rows of one table, as text, with their capture time ``_ts_ms``. Deletes, other tables and unreadable records fall away."""
    return (
        parsed(messages, schemas.envelope(TABLES[table]))
        .filter(F.col("source.table").eqNullSafe(table) & F.col("_corrupt").isNull() & ~_deleted())
        .select("after.*", F.col("ts_ms").alias("_ts_ms"))
    )


def split(messages: DataFrame, folder: str, *tables: str) -> dict[str, DataFrame]:
    """Rows of several tables of one log, each record read and parsed once.

    They are written below ``folder`` by table, so that whoever needs a table reads that one alone. Fields of the same
    name in several tables are text until the table's own function casts them.
    """
    fields = {field.name: field for table in tables for field in TABLES[table]}
    rows = (
        parsed(messages, schemas.envelope(StructType(list(fields.values()))))
        .filter(F.col("source.table").isin(*tables) & F.col("_corrupt").isNull() & ~_deleted())
        .select(F.col("source.table").alias("_table"), "after.*", F.col("ts_ms").alias("_ts_ms"))
    )
    with settings(messages.sparkSession, STEP):
        rows.write.partitionBy("_table").parquet(folder)
    stored = messages.sparkSession.read.schema(rows.schema).parquet(folder)
    return {table: stored.filter(F.col("_table") == table) for table in tables}


def _typed(rows: DataFrame, table: str) -> DataFrame:
    """Fields in their types; one that does not fit is NULL, and a row without its numeric key is left out."""
    fields = [f"try_cast({field.name} AS {field.dataType.simpleString()}) AS {field.name}" for field in TABLES[table]]
    typed = rows.selectExpr(*fields, "_ts_ms")
    return typed.filter(F.col(NUMERIC_KEYS[table]).isNotNull()) if table in NUMERIC_KEYS else typed


def users_of(rows: DataFrame, birthday_unit: str = "days", zone: str = "UTC") -> DataFrame:
    typed = _typed(rows, "user_info")
    return typed.withColumn("birthday", timeparts.birth_date(F.col("birthday"), birthday_unit, zone)).withColumnsRenamed(
        {"phone_num": "phone", "_ts_ms": "ts_ms"}
    )


def user_info(messages: DataFrame, birthday_unit: str = "days", zone: str = "UTC") -> DataFrame:
    return users_of(_rows_of(messages, "user_info"), birthday_unit, zone)


def supplements_of(rows: DataFrame) -> DataFrame:
    return _typed(rows, "user_info_sup").withColumnRenamed("_ts_ms", "ts_ms")


def user_info_sup(messages: DataFrame) -> DataFrame:
    return supplements_of(_rows_of(messages, "user_info_sup"))


def orders_of(rows: DataFrame, zone: str = "UTC") -> DataFrame:
    """Order rows with the pay-time slot; missing numbers count as 0."""
    return (
        _typed(rows, "order_info")
        .selectExpr(
            "coalesce(_ts_ms, 0L) AS ts_ms",
            "id",
            "user_id AS uid",
            "consignee",
            "coalesce(create_time, 0L) AS create_time",
            "original_total_amount",
            "total_amount",
            "coalesce(province_id, 0L) AS province_id",
        )
        .withColumn("pay_time_slot", timeparts.pay_time_slot(F.col("create_time"), zone))
    )


def order_info(messages: DataFrame, zone: str = "UTC") -> DataFrame:
    return orders_of(_rows_of(messages, "order_info"), zone)


def details_of(rows: DataFrame) -> DataFrame:
    """Order-detail rows; missing numbers count as 0."""
    return _typed(rows, "order_detail").selectExpr(
        "coalesce(_ts_ms, 0L) AS ts_ms",
        "id",
        "order_id",
        "coalesce(sku_id, 0L) AS sku_id",
        "coalesce(sku_num, 0L) AS sku_num",
        "sku_name",
        "order_price",
        "split_total_amount",
        "split_activity_amount",
        "split_coupon_amount",
        "coalesce(create_time, 0L) AS create_time",
    )


def order_detail(messages: DataFrame) -> DataFrame:
    return details_of(_rows_of(messages, "order_detail"))


def tag_records(messages: DataFrame) -> DataFrame:
    """Base-tag records back from their JSON text, with ``ts`` as a number."""
    text = schemas.as_text(schemas.TAGS)
    fields = [name for name in schemas.TAGS.names if name != "ts"]
    return (
        parsed(messages, text).filter(F.col("user_id").isNotNull()).selectExpr(*fields, "try_cast(ts AS bigint) AS ts")
    )


def with_key(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key is there and not empty."""
    return rows.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def as_messages(rows: DataFrame) -> DataFrame:
    """Rows as JSON text in ``value``; absent fields are left out."""
    return rows.select(F.to_json(F.struct(*[F.col(name) for name in rows.columns])).alias("value"))
