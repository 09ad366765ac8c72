"""Page logs: identity, device and search fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom import schemas
from tagloom.functions import device
from tagloom.operators.parsing import drop_tombstones, parsed

# The key all guests share, and the page item type that holds a search term.
GUEST = "-1"
SEARCH_ITEM_TYPE = "keyword"

# Fields of the common part that do not describe the device.
_SESSION_FIELDS = ("sid", "mid", "is_new")

PROFILE_FIELDS = ("os", "ch", "md", "ba", "search_item")


def page_logs(messages: DataFrame) -> DataFrame:
    """Readable page logs: JSON with the common part."""
    return parsed(messages, schemas.PAGE_LOG).filter(F.col("_corrupt").isNull() & F.col("common").isNotNull())


def quarantine(messages: DataFrame) -> DataFrame:
    """Messages of no use to ``device_and_search``, with the reason; logs of an empty user are left out there, not here."""
    reason = (
        F.when(F.col("_corrupt").isNotNull(), "not json")
        .when(F.col("common").isNull(), "no common part")
        .when(F.col("common")["os"].isNull(), "no system name")
    )
    return (
        parsed(drop_tombstones(messages), schemas.PAGE_LOG, "value")
        .select("value", reason.alias("reason"))
        .filter(F.col("reason").isNotNull())
    )


def identities(logs: DataFrame) -> DataFrame:
    return logs.select(F.col("common")["mid"].alias("mid"), F.col("common")["uid"].alias("uid"), "ts")


def device_and_search(logs: DataFrame, drop_guests: bool = False) -> DataFrame:
    """One row per log with a user key: key, time, device fields and search term.

    Guests share one key. They are kept by default; at scale they are the
    hottest key there is, and ``drop_guests`` leaves them out.
    ``other_info`` keeps the remaining device fields, which count when repeats are looked for.
    """
    common = F.col("common")
    named = (*_SESSION_FIELDS, "uid", "os", "ch", "md", "ba")
    others = F.map_filter("common", lambda name, _: ~name.isin(*named))
    rows = (
        logs.filter(common["os"].isNotNull())
        .select(
            F.coalesce(common["uid"], F.lit(GUEST)).alias("uid"),
            F.coalesce("ts", F.lit(0).cast("long")).alias("ts"),
            device.system_name(common["os"]).alias("os"),
            common["ch"].alias("ch"),
            common["md"].alias("md"),
            common["ba"].alias("ba"),
            F.when(F.col("page.item_type") == SEARCH_ITEM_TYPE, F.col("page.item")).alias("search_item"),
            F.when(
                F.size(others) > 0, F.to_json(F.map_from_entries(F.array_sort(F.map_entries(others))))
            ).alias("other_info"),
        )
        .filter(F.col("uid") != "")
    )
    return rows.filter(F.col("uid") != GUEST) if drop_guests else rows
