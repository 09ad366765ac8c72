"""Device names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The systems the device score knows, the first one found wins.
KNOWN_SYSTEMS = ("iOS", "Android")


def system_name(os: Column) -> Column:
    """``Android 13`` -> ``Android``."""
    return F.substring_index(os, " ", 1)


def judged_system(systems: Column) -> Column:
    """The one system of an array of system names that the device score uses."""
    judged = F.array_min(systems)
    for name in reversed(KNOWN_SYSTEMS):
        judged = F.when(F.array_contains(systems, name), name).otherwise(judged)
    return judged


def judged_system_agg(system: Column) -> Column:
    """The same choice as an aggregate over a group's rows; keeps three values, never the set."""
    judged = F.min(system)
    for name in reversed(KNOWN_SYSTEMS):
        judged = F.when(F.max(system == name), name).otherwise(judged)
    return judged
