"""Weather responses, one per city, to table rows and an outcome summary. Responses are already fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom import schemas

# Provinces the city list leaves out, the status of a good response, and the batch size.
LEFT_OUT_PROVINCES = ("澳门特别行政区", "台湾省", "香港特别行政区")
GOOD_STATUS = "1"
BATCH_ROWS = 500


def cities(codes: DataFrame) -> DataFrame:
    """Cities to ask for."""
    return codes.filter(F.col("city").isNotNull() & ~F.col("province").isin(*LEFT_OUT_PROVINCES))


def outcomes(responses: DataFrame) -> DataFrame:
    """City rows with the ``response`` text, read; ``ok`` says whether it gives a row.

    Not JSON, another status or an empty reading list is a failure. A missing
    reading list is an empty reading.
    """
    reading = F.col("lives").isNull() | (F.size("lives") > 0)
    return responses.select(
        "code", "province", "city", "area", F.inline(F.array(F.from_json("response", schemas.WEATHER_RESPONSE)))
    ).withColumn("ok", F.coalesce(F.col("status") == GOOD_STATUS, F.lit(False)) & reading)


def weather_rows(read: DataFrame) -> DataFrame:
    """Table rows of the good outcomes; the first reading is kept as JSON text."""
    reading = F.coalesce(F.get("lives", F.lit(0)), F.lit("{}"))
    empty = F.lit("")
    return read.filter("ok").select(
        F.coalesce(F.col("code").cast("int"), F.lit(0)).alias("code"),
        F.coalesce("province", empty).alias("province"),
        F.coalesce("city", "province", empty).alias("city"),
        F.coalesce("area", "city", "province", empty).alias("area"),
        F.coalesce("info", empty).alias("info"),
        reading.alias("lives"),
        F.nullif(F.get_json_object(reading, "$.reporttime"), empty).alias("report_time"),
    )


def batch_summary(read: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Good and failed cities per batch of codes, with the failed codes as text.

    A batch is a range of ``batch_rows`` codes, so its list of failed codes has
    a bound that does not grow with the data.
    """
    code = F.col("code").cast("long")
    return (
        read.groupBy(F.floor(code / batch_rows).cast("long").alias("batch"))
        .agg(
            F.sum(F.col("ok").cast("long")).alias("success_count"),
            F.sum((~F.col("ok")).cast("long")).alias("fail_count"),
            F.collect_set(F.when(~F.col("ok"), code)).alias("failed"),
            F.min(code).alias("first_code"),
            F.max(code).alias("last_code"),
        )
        .withColumn("failed", F.array_join(F.array_sort("failed").cast("array<string>"), ","))
    )


def failures(read: DataFrame) -> DataFrame:
    """One row per failed city with the reason."""
    reason = (
        F.when(F.col("status").isNull(), "no readable response")
        .when(F.col("status") != GOOD_STATUS, "bad status")
        .otherwise("no reading")
    )
    return read.filter(~F.col("ok")).select("code", "province", "city", reason.alias("reason"))


def total_summary(batches: DataFrame) -> DataFrame:
    return batches.agg(
        F.sum("success_count").alias("success_count"),
        F.sum("fail_count").alias("fail_count"),
        F.count(F.lit(1)).alias("batches"),
    )


def run_report(read: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Every failed city with its batch and reason, next to the totals of the whole run.

    The totals are one row, which Spark works out once and puts in as a
    constant, so the list of failed cities may have any length. A run without
    failures has no rows; its totals are those of ``total_summary``.
    """
    totals = total_summary(batch_summary(read, batch_rows)).select(F.struct("*")).scalar()
    batch = F.floor(F.col("code").cast("long") / batch_rows).cast("long")
    return (
        failures(read)
        .withColumns({"batch": batch, "_totals": totals})
        .select("code", "province", "city", "reason", "batch", "_totals.*")
    )
