"""Scalar rules and scores at every boundary."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagloom.functions import device, tags, textrows, timeparts
from tagloom.functions.rules import AMOUNT, BRAND, CATEGORY, DEVICE, PAY_TIME, SEARCH
from tagloom.functions.scoring import with_scores

HOUR = 3600 * 1000


def values(spark, schema, rows, *columns):
    return [tuple(row) for row in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_pay_time_slot(spark):
    expected = {
        0: "凌晨", 5: "凌晨", 6: "早晨", 8: "早晨", 9: "上午", 11: "上午", 12: "中午", 13: "中午",
        14: "下午", 17: "下午", 18: "晚上", 21: "晚上", 22: "夜间", 23: "夜间",
    }
    rows = [(hour * HOUR,) for hour in expected] + [(hour * HOUR + HOUR - 1,) for hour in expected]
    got = values(spark, "ms long", rows, timeparts.pay_time_slot(F.col("ms")))
    assert [value for (value,) in got] == list(expected.values()) * 2
    assert values(spark, "ms long", [(None,)], timeparts.pay_time_slot(F.col("ms"))) == [(None,)]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_slot_follows_the_data_zone_not_the_session(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        got = values(
            spark,
            "ms long",
            [(1747270800000,)],  # 2025-05-15 01:00 UTC, 09:00 in Shanghai
            timeparts.pay_time_slot(F.col("ms")),
            timeparts.pay_time_slot(F.col("ms"), "Asia/Shanghai"),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [("凌晨", "上午")]


def test_age_groups(spark):
    expected = {
        17: "under 18", 18: "18-24", 24: "18-24", 25: "25-29", 29: "25-29", 30: "30-34", 34: "30-34",
        35: "35-39", 39: "35-39", 40: "40-49", 49: "40-49", 50: "50+", None: None,
    }
    got = values(spark, "age int", [(age,) for age in expected], tags.age_group(F.col("age")))
    assert [value for (value,) in got] == list(expected.values())


def test_age_counts_years_only(spark):
    rows = [(dt.date(2000, 12, 31),), (dt.date(2000, 1, 1),), (None,)]
    assert values(spark, "b date", rows, tags.age(F.col("b"), dt.date(2024, 6, 1))) == [(24,), (24,), (None,)]


def test_zodiac_cutoffs(spark):
    last_days = {
        1: (19, "摩羯座", "水瓶座"), 2: (18, "水瓶座", "双鱼座"), 3: (20, "双鱼座", "白羊座"),
        4: (19, "白羊座", "金牛座"), 5: (20, "金牛座", "双子座"), 6: (21, "双子座", "巨蟹座"),
        7: (22, "巨蟹座", "狮子座"), 8: (22, "狮子座", "处女座"), 9: (22, "处女座", "天秤座"),
        10: (23, "天秤座", "天蝎座"), 11: (22, "天蝎座", "射手座"), 12: (21, "射手座", "摩羯座"),
    }
    rows = [(dt.date(1990, month, day + more),) for month, (day, _, _) in last_days.items() for more in (0, 1)]
    got = values(spark, "b date", rows, tags.zodiac(F.col("b")))
    assert [value for (value,) in got] == [sign for _, *signs in last_days.values() for sign in signs]
    unset = [(None,), (dt.date(1970, 1, 1),), (dt.date(1969, 12, 31),)]
    assert values(spark, "b date", unset, tags.zodiac(F.col("b"))) == [(None,), (None,), ("摩羯座",)]


def test_birth_date_units(spark):
    rows = [(10957, 946684800000)]
    got = values(
        spark, "d long, ms long", rows, timeparts.birth_date(F.col("d")), timeparts.birth_date(F.col("ms"), "ms")
    )
    assert got == [(dt.date(2000, 1, 1), dt.date(2000, 1, 1))]
    with pytest.raises(ValueError):
        timeparts.birth_date(F.col("d"), "weeks")


def test_gender(spark):
    rows = [("M", "F"), (None, "F"), (None, None), ("M", None)]
    assert values(spark, "a string, b string", rows, tags.gender(F.col("a"), F.col("b"))) == [
        ("M",), ("F",), ("home",), ("M",)
    ]


def test_body_metrics(spark):
    heights = [("180", "cm", "180.0"), ("70", "in", "177.8"), ("1.75", "M", "175.0"), ("5", "ft", "5.0"),
               ("abc", "cm", None), (None, "cm", None), ("180", None, None), ("2.25", "cm", "2.3")]
    got = values(spark, "h string, u string, e string", heights, tags.height_cm(F.col("h"), F.col("u")), "e")
    assert all(value == expected for value, expected in got)
    weights = [("70", "kg", "70.0"), ("154", "LB", "69.9"), ("65050", "g", "65.1"), ("70", "st", "70.0"),
               ("x", "kg", None), (None, "kg", None), ("70", None, None)]
    got = values(spark, "w string, u string, e string", weights, tags.weight_kg(F.col("w"), F.col("u")), "e")
    assert all(value == expected for value, expected in got)


def test_device_names(spark):
    assert values(spark, "os string", [("Android 13",), ("iOS",)], device.system_name(F.col("os"))) == [
        ("Android",), ("iOS",)
    ]
    sets = [(["Android", "iOS"],), (["Windows", "Android"],), (["Windows", "Linux"],), ([],)]
    assert values(spark, "s array<string>", sets, device.judged_system(F.col("s"))) == [
        ("iOS",), ("Android",), ("Linux",), (None,)
    ]


def test_fixed_point(spark):
    rows = [(90.045,), (1e7,), (0.0,), (-2.005,), (None,)]
    got = values(spark, "x double", rows, textrows.fixed_point(F.col("x"), 2))
    assert got == [("90.05",), ("10000000.00",), ("0.00",), ("-2.01",), (None,)]


def scored(spark, rule, kind, keys):
    df = with_scores(spark.createDataFrame([(key,) for key in keys], f"k {kind}"), (rule, "k"))
    return {row["k"]: tuple(row[name] for name in rule.columns) for row in df.collect()}


NONE = (None,) * 6


def test_device_scores(spark):
    got = scored(spark, DEVICE, "string", ["iOS", "Android", "Windows", None])
    assert got["iOS"] == (0.07, 0.06, 0.05, 0.04, 0.03, 0.02)
    assert got["Android"] == (0.08, 0.07, 0.06, 0.05, 0.04, 0.03)
    assert got["Windows"] == NONE and got[None] == NONE


def test_search_scores(spark):
    got = scored(spark, SEARCH, "string", ["时尚与潮流", "性价比", "家庭与育儿", "健康与养生", "科技与数码", "学习与发展", "?", None])
    assert got["时尚与潮流"] == (0.135, 0.105, 0.075, 0.045, 0.03, 0.015)
    assert got["性价比"] == (0.03, 0.06, 0.09, 0.105, 0.12, 0.12)
    assert got["家庭与育儿"] == got["健康与养生"] == (0.015, 0.03, 0.06, 0.09, 0.12, 0.105)
    assert got["科技与数码"] == (0.12, 0.09, 0.06, 0.045, 0.03, 0.015)
    assert got["学习与发展"] == (0.06, 0.075, 0.09, 0.105, 0.12, 0.105)
    assert got["?"] == got[None] == (0.0,) * 6


def test_pay_time_scores(spark):
    got = scored(spark, PAY_TIME, "string", ["凌晨", "早晨", "上午", "中午", "下午", "晚上", "夜间", "", None])
    assert got["凌晨"] == (0.02, 0.01, 0.01, 0.01, 0.01, 0.01)
    assert got["早晨"] == (0.01, 0.01, 0.01, 0.01, 0.02, 0.03)
    assert got["上午"] == (0.02, 0.02, 0.02, 0.02, 0.03, 0.04)
    assert got["中午"] == (0.04, 0.04, 0.04, 0.04, 0.04, 0.03)
    assert got["下午"] == (0.04, 0.05, 0.05, 0.05, 0.05, 0.04)
    assert got["晚上"] == (0.08, 0.07, 0.06, 0.05, 0.04, 0.03)
    assert got["夜间"] == (0.09, 0.07, 0.05, 0.03, 0.02, 0.01)
    assert got[""] == got[None] == NONE


def test_amount_scores(spark):
    got = scored(spark, AMOUNT, "string", [None, "x", "999.99", "1000", "1000.01", "3999.99", "4000", "4000.01"])
    low, middle, high = (
        (0.12, 0.09, 0.06, 0.045, 0.03, 0.015),
        (0.03, 0.06, 0.09, 0.105, 0.12, 0.105),
        (0.015, 0.03, 0.045, 0.06, 0.075, 0.09),
    )
    assert got[None] == got["x"] == got["999.99"] == low
    assert got["1000.01"] == got["3999.99"] == middle
    assert got["1000"] == got["4000"] == got["4000.01"] == high


def test_brand_scores(spark):
    got = scored(spark, BRAND, "string", ["TCL", "苹果", "联想", "小米", "欧莱雅", "香奈儿", "Redmi", "", None])
    assert got["TCL"] == (0.04, 0.06, 0.08, 0.1, 0.12, 0.14)
    assert got["苹果"] == got["联想"] == got["小米"] == (0.18, 0.16, 0.14, 0.14, 0.14, 0.1)
    assert got["欧莱雅"] == (0.1, 0.12, 0.16, 0.16, 0.18, 0.04)
    assert got["香奈儿"] == (0.06, 0.08, 0.12, 0.16, 0.18, 0.04)
    assert got["Redmi"] == (0.02, 0.04, 0.06, 0.08, 0.1, 0.12)
    assert got[""] == got[None] == NONE


def test_category_scores(spark):
    got = scored(spark, CATEGORY, "string", ["数码", "服饰内衣", "图书、音像、电子书刊", "家用电器", "钟表", "食品饮料、保健食品", None])
    assert got["数码"] == got["服饰内衣"] == (0.27, 0.24, 0.18, 0.12, 0.06, 0.03)
    assert got["图书、音像、电子书刊"] == got["家用电器"] == (0.06, 0.12, 0.18, 0.24, 0.27, 0.21)
    assert got["钟表"] == got["食品饮料、保健食品"] == (0.03, 0.06, 0.12, 0.15, 0.24, 0.27)
    assert got[None] == NONE


@pytest.mark.parametrize("rule", [DEVICE, SEARCH, PAY_TIME, BRAND, CATEGORY])
def test_scores_lie_within_the_coefficient(rule):
    weights = [row for _, row in rule.rows] + ([rule.default] if rule.default else [])
    assert all(0 <= score <= rule.coefficient for row in weights for score in rule.scores(row))
