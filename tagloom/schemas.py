"""Explicit schemas of the message contracts."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructField, StructType


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_STRING, _LONG = StringType(), LongType()

USER_INFO = _struct(
    id=_LONG, login_name=_STRING, name=_STRING, phone_num=_STRING, email=_STRING, birthday=_LONG, gender=_STRING
)

USER_INFO_SUP = _struct(
    uid=_LONG, gender=_STRING, height=_STRING, unit_height=_STRING, weight=_STRING, unit_weight=_STRING
)

ORDER_INFO = _struct(
    id=_STRING,
    user_id=_STRING,
    consignee=_STRING,
    create_time=_LONG,
    original_total_amount=_STRING,
    total_amount=_STRING,
    province_id=_LONG,
)

ORDER_DETAIL = _struct(
    id=_STRING,
    order_id=_STRING,
    sku_id=_LONG,
    sku_num=_LONG,
    sku_name=_STRING,
    order_price=_STRING,
    split_total_amount=_STRING,
    split_activity_amount=_STRING,
    split_coupon_amount=_STRING,
    create_time=_LONG,
)


def as_text(row: StructType) -> StructType:
    """The same fields, all as text."""
    return StructType([StructField(field.name, _STRING) for field in row])


def envelope(after: StructType) -> StructType:
    """Change record of one table; ``_corrupt`` keeps the text of a record that is not JSON.

    Row fields are read as text: one topic holds many tables, and a field that
    is a number in one and text in another must not spoil (and slow down) the
    parse. Whoever picks the rows of a table casts them.
    """
    return StructType(
        [
            StructField("after", as_text(after)),
            StructField("source", _struct(table=_STRING)),
            StructField("ts_ms", _LONG),
            StructField("op", _STRING),
            StructField("_corrupt", _STRING),
        ]
    )


def change_record(row: StructType) -> StructType:
    """Change or snapshot record of one table with the row before and after, and its place in the log."""
    return StructType(
        [
            StructField("before", as_text(row)),
            StructField("after", as_text(row)),
            StructField("source", _struct(table=_STRING, pos=_LONG)),
            StructField("ts_ms", _LONG),
            StructField("op", _STRING),
            StructField("_corrupt", _STRING),
        ]
    )


# Which table, when, what kind of record, and the key of its row under either of its names.
ENVELOPE_HEAD = StructType(
    [
        StructField("after", _struct(id=_STRING, uid=_STRING)),
        StructField("source", _struct(table=_STRING)),
        StructField("ts_ms", _LONG),
        StructField("op", _STRING),
        StructField("ddl", _STRING),
        StructField("historyRecord", _STRING),
        StructField("_corrupt", _STRING),
    ]
)

TAGS = _struct(
    user_id=_STRING,
    login_name=_STRING,
    name=_STRING,
    phone=_STRING,
    email=_STRING,
    age=_STRING,
    age_group=_STRING,
    gender=_STRING,
    height_cm=_STRING,
    weight_kg=_STRING,
    constellation=_STRING,
    ts=_LONG,
)

ROUTING = StructType([StructField("source", _struct(table=_STRING)), StructField("ts_ms", _LONG)])

# Page logs carry more device fields than the ones profiled, and a repeat is a repeat of all of them,
# so the common part is read as a map.
PAGE_LOG = StructType(
    [
        StructField("common", MapType(_STRING, _STRING)),
        StructField("page", _struct(item_type=_STRING, item=_STRING)),
        StructField("ts", _LONG),
        StructField("_corrupt", _STRING),
    ]
)

# A weather reading is passed on as it came, so each element of ``lives`` stays JSON text.
WEATHER_RESPONSE = _struct(status=_STRING, info=_STRING, lives=ArrayType(_STRING))
