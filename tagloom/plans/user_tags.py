"""Base tags of users joined with their supplementary data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import tags
from tagloom.operators.interval_join import users_with_supplements


def tag_rows(pairs: DataFrame, as_of: dt.date) -> DataFrame:
    """Twelve tags per pair, as text; a tag that cannot be derived is NULL."""
    years = tags.age(F.col("birthday"), as_of)
    return pairs.select(
        F.col("id").cast("string").alias("user_id"),
        "login_name",
        "name",
        "phone",
        "email",
        years.cast("string").alias("age"),
        tags.age_group(years).alias("age_group"),
        tags.gender(F.col("gender"), F.col("s_gender")).alias("gender"),
        tags.height_cm(F.col("s_height"), F.col("s_unit_height")).alias("height_cm"),
        tags.weight_kg(F.col("s_weight"), F.col("s_unit_weight")).alias("weight_kg"),
        tags.zodiac(F.col("birthday")).alias("constellation"),
        F.col("ts_ms").cast("string").alias("ts"),
    )


def user_tags(users: DataFrame, supplements: DataFrame, as_of: dt.date) -> DataFrame:
    return tag_rows(users_with_supplements(users, supplements), as_of)
