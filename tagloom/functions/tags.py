"""Base user tags: age, age group, gender, height, weight and zodiac sign."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.textrows import fixed_point

# First age above the group, and the group's name.
AGE_GROUPS = ((18, "under 18"), (25, "18-24"), (30, "25-29"), (35, "30-34"), (40, "35-39"), (50, "40-49"))
OLDEST_GROUP = "50+"

# Fixed value: gender of an account that states none.
HOUSEHOLD = "home"

# Factor to centimetres and to kilograms by lower-case unit; any other unit is taken as it is.
TO_CENTIMETRES = {"in": 2.54, "m": 100.0}
POUND_IN_KILOGRAMS = 0.453592
GRAMS_IN_KILOGRAM = 1000

# By month, the last day of the sign that began the month before, that sign, and the sign that follows.
ZODIAC = (
    (19, "摩羯座", "水瓶座"),
    (18, "水瓶座", "双鱼座"),
    (20, "双鱼座", "白羊座"),
    (19, "白羊座", "金牛座"),
    (20, "金牛座", "双子座"),
    (21, "双子座", "巨蟹座"),
    (22, "巨蟹座", "狮子座"),
    (22, "狮子座", "处女座"),
    (22, "处女座", "天秤座"),
    (23, "天秤座", "天蝎座"),
    (22, "天蝎座", "射手座"),
    (21, "射手座", "摩羯座"),
)


def age(birthday: Column, as_of: dt.date) -> Column:
    """Calendar years between the birth year and the year of ``as_of``."""
    return F.lit(as_of.year) - F.year(birthday)


def age_group(years: Column) -> Column:
    group = F.when(years.isNull(), F.lit(None).cast("string"))
    for below, name in AGE_GROUPS:
        group = group.when(years < below, name)
    return group.otherwise(OLDEST_GROUP)


def gender(main: Column, supplement: Column) -> Column:
    return F.coalesce(main, supplement, F.lit(HOUSEHOLD))


def _one_decimal(value: Column, unit: Column) -> Column:
    """Text with one decimal, halves up; NULL when the number or the unit is missing."""
    return F.when(value.isNotNull() & unit.isNotNull(), fixed_point(value, 1))


def height_cm(height: Column, unit: Column) -> Column:
    number = height.try_cast("double")
    scaled = number
    for name, factor in TO_CENTIMETRES.items():
        scaled = F.when(F.lower(unit) == name, number * factor).otherwise(scaled)
    return _one_decimal(scaled, unit)


def weight_kg(weight: Column, unit: Column) -> Column:
    number = weight.try_cast("double")
    scaled = (
        F.when(F.lower(unit) == "lb", number * POUND_IN_KILOGRAMS)
        .when(F.lower(unit) == "g", number / GRAMS_IN_KILOGRAM)
        .otherwise(number)
    )
    return _one_decimal(scaled, unit)


def zodiac(birthday: Column) -> Column:
    """Zodiac sign; NULL for no birthday and for 1970-01-01, which stands for an unset one."""
    month = F.month(birthday)
    last_day, earlier, later = (
        F.get(F.expr(f"array({', '.join(repr(row[i]) for row in ZODIAC)})"), month - 1) for i in range(3)
    )
    sign = F.when(F.dayofmonth(birthday) <= last_day, earlier).otherwise(later)
    return F.when(birthday != F.lit(dt.date(1970, 1, 1)), sign)
