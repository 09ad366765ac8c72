"""Device and search scores of users per two-minute window of their page logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import device
from tagloom.functions.rules import DEVICE, SEARCH
from tagloom.functions.scoring import with_scores
from tagloom.operators import dimensions
from tagloom.operators.page_logs import PROFILE_FIELDS
from tagloom.operators.profiles import WINDOW_MS, joined, windowed_profile
from tagloom.operators.repeats import without_repeats


def profile_text(profiles: DataFrame) -> DataFrame:
    """Value sets as sorted, comma-joined text."""
    kept = [name for name in profiles.columns if not name.endswith("_set")]
    return profiles.select(*kept, *[joined(F.col(f"{name}_set")).alias(name) for name in PROFILE_FIELDS])


def score_profiles(profiles: DataFrame, searches: DataFrame) -> DataFrame:
    """Adds the judged system, both categories and twelve scores to profiles with value sets."""
    kept = [name for name in profiles.columns if not name.endswith("_set")]
    judged = profiles.select(
        *kept,
        *[joined(F.col(f"{name}_set")).alias(name) for name in PROFILE_FIELDS],
        device.judged_system(F.col("os_set")).alias("judge_os"),
    )
    found = dimensions.with_search_category(judged, searches)
    return with_scores(found, (DEVICE, "judge_os"), (SEARCH, "search_category")).select(
        *kept, *PROFILE_FIELDS, "judge_os", "b1_category", "search_category", *DEVICE.columns, *SEARCH.columns
    )


def behavior_scores(records: DataFrame, searches: DataFrame, width_ms: int = WINDOW_MS) -> DataFrame:
    """Scores per user and window, from device-and-search records."""
    return score_profiles(windowed_profile(without_repeats(records), width_ms), searches)
