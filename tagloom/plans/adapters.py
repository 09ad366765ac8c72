"""The message and table contracts, filled from the star-schema tables of a data folder.

Only arithmetic any SQL engine can repeat. Times are epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import timeparts
from tagloom.operators import dimensions, page_logs, parsing, weather
from tagloom.session import new_folder, written
from tagloom.sources.messages import replayed
from tagloom.sources.tables import Tables

# 2024-01-01 00:00:00 UTC; orders and users spread over the 30 days after it.
START_MS = 1704067200000
SPREAD_SECONDS = 2592000
SPREAD_MINUTES = 43200

# First-level category names by id, from 1.
TOP_CATEGORIES = (
    "图书、音像、电子书刊",
    "手机",
    "家用电器",
    "数码",
    "家居家装",
    "电脑办公",
    "厨具",
    "个护化妆",
    "服饰内衣",
    "钟表",
    "鞋靴",
    "母婴",
    "礼品箱包",
    "食品饮料、保健食品",
    "珠宝",
    "汽车用品",
    "运动健康",
)

# Brand names by id, from 1.
BRANDS = ("Redmi", "苹果", "联想", "TCL", "小米", "长粒香", "金沙河", "索芙特", "CAREMiLLE", "欧莱雅", "香奈儿")

# Search category of a first-level category: id, category, search category. 数码 is listed twice, the first wins.
COMPARISON = (
    (1, "数码", "科技与数码"),
    (2, "手机", "科技与数码"),
    (3, "电脑办公", "科技与数码"),
    (4, "数码", "性价比"),
    (5, "服饰内衣", "时尚与潮流"),
    (6, "珠宝", "时尚与潮流"),
    (7, "家用电器", "性价比"),
    (8, "厨具", "家庭与育儿"),
    (9, "母婴", "家庭与育儿"),
    (10, "运动健康", "健康与养生"),
    (11, "图书、音像、电子书刊", "学习与发展"),
    (12, "汽车用品", "性价比"),
)

# Search terms by user id; two of them name no category.
SEARCH_TERMS = ("red widget", "hot rod", "扫地机器人", "old bolt", "new ring", "iPhone14")


_ORDER_TIME = f"{START_MS} + ({{}} * 7919 % {SPREAD_SECONDS}) * 1000"
_USER_TIME = f"{START_MS} + (c_custkey % {SPREAD_MINUTES}) * 60000"


def _money(column: str) -> str:
    return f"CAST(CAST({column} AS decimal(16,2)) AS string)"


def _quoted(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _order_after(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "CAST(o_orderkey AS string) AS id",
        "CAST(o_custkey AS string) AS user_id",
        "o_orderpriority AS consignee",
        f"{_ORDER_TIME.format('o_orderkey')} AS create_time",
        f"{_money('o_totalprice')} AS original_total_amount",
        f"{_money('o_totalprice')} AS total_amount",
        "o_custkey % 34 + 1 AS province_id",
        "o_orderstatus",
    )


def order_rows(orders: DataFrame) -> DataFrame:
    """Parsed order rows, straight from the table."""
    return _order_after(orders).select(
        F.col("create_time").alias("ts_ms"),
        "id",
        F.col("user_id").alias("uid"),
        "consignee",
        "create_time",
        "original_total_amount",
        "total_amount",
        "province_id",
        timeparts.pay_time_slot(F.col("create_time")).alias("pay_time_slot"),
    )


def order_info(t: Tables) -> DataFrame:
    return order_rows(t["orders"])


def _detail_after(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        "CAST(l_orderkey * 10 + l_linenumber AS string) AS id",
        "CAST(l_orderkey AS string) AS order_id",
        "l_partkey AS sku_id",
        "CAST(l_quantity AS bigint) AS sku_num",
        "concat('sku ', l_partkey) AS sku_name",
        f"{_money('l_extendedprice')} AS order_price",
        f"{_money('l_extendedprice')} AS split_total_amount",
        f"{_money('l_discount')} AS split_activity_amount",
        f"{_money('l_tax')} AS split_coupon_amount",
        f"{_ORDER_TIME.format('l_orderkey')} + ((l_linenumber * 53 + l_partkey) % 400 - 200) * 1000 AS create_time",
        "l_shipdate",
    )


def detail_rows(lines: DataFrame) -> DataFrame:
    """Parsed detail rows, straight from the table; times fall within 200 s of the order's."""
    after = _detail_after(lines).drop("l_shipdate")
    return after.select(F.col("create_time").alias("ts_ms"), *after.columns)


def order_detail(t: Tables) -> DataFrame:
    return detail_rows(t["lineitem"])


def arriving_detail_rows(lines: DataFrame) -> DataFrame:
    """Detail rows with an arrival time that is not their creation time."""
    return _detail_after(lines).withColumn("arrived_ms", timeparts.epoch_ms(F.col("l_shipdate"))).drop("l_shipdate")


def arriving_details(t: Tables) -> DataFrame:
    return arriving_detail_rows(t["lineitem"])


def _user_after(customers: DataFrame) -> DataFrame:
    """Birthdays are epoch days from 1950-01-01 on; one market segment states none."""
    return customers.selectExpr(
        "c_custkey AS id",
        "lower(c_name) AS login_name",
        "c_name AS name",
        "concat('139', c_custkey) AS phone_num",
        "concat(c_custkey, '@example.com') AS email",
        "CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey * 37 % 22000 - 7305 END AS birthday",
        "CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender",
        f"{_USER_TIME} AS _ts_ms",
        "c_acctbal",
    )


def user_rows(customers: DataFrame) -> DataFrame:
    """Parsed user rows, straight from the table."""
    return _user_after(customers).select(
        "id",
        "login_name",
        "name",
        F.col("phone_num").alias("phone"),
        "email",
        timeparts.birth_date(F.col("birthday")).alias("birthday"),
        "gender",
        F.col("_ts_ms").alias("ts_ms"),
    )


def user_info(t: Tables) -> DataFrame:
    return user_rows(t["customer"])


def _sup_after(customers: DataFrame) -> DataFrame:
    return customers.selectExpr(
        "c_custkey AS uid",
        "CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 2 THEN 'M' END AS gender",
        """CASE c_custkey % 5 WHEN 0 THEN CAST(150 + c_custkey % 50 AS string)
             WHEN 1 THEN CAST(58 + c_custkey % 20 AS string)
             WHEN 2 THEN concat('1.', 50 + c_custkey % 50)
             WHEN 3 THEN 'abc' END AS height""",
        "CASE c_custkey % 5 WHEN 1 THEN 'in' WHEN 2 THEN 'M' ELSE 'cm' END AS unit_height",
        """CAST(CASE c_custkey % 4 WHEN 0 THEN 45 + c_custkey % 60 WHEN 1 THEN 100 + c_custkey % 120
                  WHEN 2 THEN 45000 + c_custkey % 60000 ELSE c_custkey END AS string) AS weight""",
        "CASE c_custkey % 4 WHEN 0 THEN 'kg' WHEN 1 THEN 'LB' WHEN 2 THEN 'g' END AS unit_weight",
        f"{_USER_TIME} + (c_custkey * 7 % 90 - 45) * 60000 AS _ts_ms",
        "c_acctbal",
    )


def sup_rows(customers: DataFrame) -> DataFrame:
    """Parsed supplementary rows, straight from the table; some lie outside the 30 minutes."""
    after = _sup_after(customers)
    return after.select(
        "uid", "gender", "height", "unit_height", "weight", "unit_weight", F.col("_ts_ms").alias("ts_ms")
    )


def user_info_sup(t: Tables) -> DataFrame:
    return sup_rows(t["customer"])


def _records(
    rows: DataFrame, table: str, fields: list[str], ts: str, deleted: str = "false", broken: str = "false"
) -> DataFrame:
    """Change records as text: deletes carry no row, broken ones stop in the middle."""
    after = f"CASE WHEN NOT ({deleted}) THEN struct({', '.join(fields)}) END"
    text = f"to_json(struct({after} AS after, struct('{table}' AS table) AS source, {ts} AS ts_ms))"
    return rows.selectExpr(f"CASE WHEN {broken} THEN substring({text}, 1, 12) ELSE {text} END AS value")


_USER_FIELDS = ["id", "login_name", "name", "phone_num", "email", "birthday", "gender"]
_SUP_FIELDS = ["uid", "gender", "height", "unit_height", "weight", "unit_weight"]
_ORDER_FIELDS = [
    "id",
    "user_id",
    "consignee",
    "create_time",
    "original_total_amount",
    "total_amount",
    "province_id",
]
_DETAIL_FIELDS = [
    "id",
    "order_id",
    "sku_id",
    "sku_num",
    "sku_name",
    "order_price",
    "split_total_amount",
    "split_activity_amount",
    "split_coupon_amount",
    "create_time",
]


def user_records(customers: DataFrame) -> DataFrame:
    """Accounts in debt arrive as deletes."""
    return _records(_user_after(customers), "user_info", _USER_FIELDS, "_ts_ms", deleted="c_acctbal < 0")


def sup_records(customers: DataFrame) -> DataFrame:
    """Records of accounts in debt arrive broken."""
    return _records(_sup_after(customers), "user_info_sup", _SUP_FIELDS, "_ts_ms", broken="c_acctbal < 0")


def order_records(orders: DataFrame) -> DataFrame:
    """Pending orders arrive as deletes."""
    return _records(_order_after(orders), "order_info", _ORDER_FIELDS, "create_time", deleted="o_orderstatus = 'P'")


def detail_records(lines: DataFrame) -> DataFrame:
    return _records(_detail_after(lines), "order_detail", _DETAIL_FIELDS, "create_time")


# Times of the records of each stream, over the columns of the table it comes from.
_EVENT_TIME = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)"
_DETAIL_TIME = f"{_ORDER_TIME.format('l_orderkey')} + ((l_linenumber * 53 + l_partkey) % 400 - 200) * 1000"
STREAM_TIMES = {
    "customer": _USER_TIME,
    "supplements": f"{_USER_TIME} + (c_custkey * 7 % 90 - 45) * 60000",
    "orders": _ORDER_TIME.format("o_orderkey"),
    "lineitem": _DETAIL_TIME,
    "arrivals": "timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', l_shipdate)",
    "events": _EVENT_TIME,
}


def streamed(t: Tables, name: str, times: str | None = None, tail: DataFrame | None = None) -> DataFrame:
    """A stored table as a stream of three micro-batches by the time of its records, and one of the ``tail``."""
    return replayed(t[name], STREAM_TIMES[times or name], new_folder(t.spark, f"stream-{name}"), tail=tail)


# Users of events that no table has: of those that come too late, and of the one that closes all windows.
LATE_USER, CLOSING_USER = 900_000_001, 900_000_002


def late_events(t: Tables) -> DataFrame:
    """Events of the first half of the time, of a user of their own, to be sent after everything else."""
    events = t["events"].filter("event_id % 40 = 0 AND value BETWEEN 1 AND 149")
    middle = t["events"].selectExpr(
        "min(ts) + make_dt_interval(0, 0, 0, timestampdiff(SECOND, min(ts), max(ts)) / 2) AS middle"
    )
    return events.join(F.broadcast(middle), F.col("ts") < F.col("middle")).withColumn(
        "user_id", F.lit(LATE_USER).cast("long")
    )


def closing_event(t: Tables) -> DataFrame:
    """One event a day after the last: the watermark then passes the end of every other window."""
    return t["events"].selectExpr(
        "max(event_id) + 1 AS event_id", "max(ts) + INTERVAL 1 DAY AS ts", f"CAST({CLOSING_USER} AS bigint) AS user_id",
        "'view' AS event_type", "1.0D AS value",
    )


# Order updates: so many versions of each order, this long apart.
VERSIONS = 3
VERSION_MS = 30_000


def order_versions(orders: DataFrame) -> DataFrame:
    """Records of orders that are updated twice: other totals, later capture times, one of them with a later time of its own."""
    rows = _order_after(orders).selectExpr("*", f"explode(sequence(0, {VERSIONS - 1})) AS version").selectExpr(
        "id",
        "user_id",
        "consignee",
        "IF(version = 2 AND province_id % 2 = 0, create_time + 1000, create_time) AS create_time",
        "original_total_amount",
        "CAST(CAST(CAST(total_amount AS decimal(16,2)) + version * 1500 AS decimal(16,2)) AS string) AS total_amount",
        "province_id",
        f"create_time + version * {VERSION_MS} AS _ts_ms",
    )
    return _records(rows, "order_info", _ORDER_FIELDS, "_ts_ms")


def versioned_log(t: Tables) -> DataFrame:
    """A log in which orders are updated; some records are delivered twice."""
    twice = order_versions(t["orders"].filter("o_orderkey % 5 = 0"))
    return order_versions(t["orders"]).unionByName(twice).unionByName(detail_records(t["lineitem"]))


def dirty_log(t: Tables) -> DataFrame:
    """Change records of which many cannot be used: keys that are no numbers, schema changes, no table, broken text, tombstones."""
    return t["customer"].selectExpr(
        """CASE c_custkey % 8
             WHEN 0 THEN concat('{"after":{"id":"x', c_custkey, '"},"source":{"table":"user_info"},"op":"c","ts_ms":1}')
             WHEN 1 THEN concat('{"source":{"table":"user_info"},"ddl":"ALTER ', c_custkey, '","ts_ms":1}')
             WHEN 2 THEN concat('{"after":{"id":', c_custkey, '},"ts_ms":1}')
             WHEN 3 THEN concat('{"after":{"id":', c_custkey)
             WHEN 4 THEN NULL
             WHEN 5 THEN concat('{"after":null,"source":{"table":"user_info"},"op":"d","ts_ms":', c_custkey, '}')
             WHEN 6 THEN concat('{"after":{"gender":"M"},"source":{"table":"user_info_sup"},"ts_ms":', c_custkey, '}')
             ELSE concat('{"after":{"id":', c_custkey, '},"source":{"table":"user_info"},"op":"u","ts_ms":', c_custkey, '}')
           END AS value"""
    )


def dirty_page_logs(t: Tables) -> DataFrame:
    """Page logs of which some have no common part, no system name, or are broken."""
    return t["events"].selectExpr(
        """CASE event_id % 5
             WHEN 0 THEN concat('{"page":{"item":"', event_id, '"},"ts":1}')
             WHEN 1 THEN concat('{"common":{"uid":"', user_id, '","sid":"', event_id, '"},"ts":1}')
             WHEN 2 THEN concat('{"common":{"uid":"', event_id)
             WHEN 3 THEN NULL
             ELSE concat('{"common":{"uid":"', user_id, '","os":"iOS 1"},"ts":', event_id, '}')
           END AS value"""
    )


def change_log(t: Tables) -> DataFrame:
    """All four tables as one log of change records."""
    if (stored := t.topic("change_log")) is not None:
        return stored
    customers = t["customer"]
    return (
        user_records(customers)
        .unionByName(sup_records(customers))
        .unionByName(order_records(t["orders"]))
        .unionByName(detail_records(t["lineitem"]))
    )


def any_table_log(t: Tables) -> DataFrame:
    """The log of the four tables and of one that no contract knows, with numbers, flags, nested objects and lists."""
    spu = t["part"].selectExpr(
        """to_json(struct(struct(p_partkey AS id, p_name AS spu_name, CAST(p_retailprice AS decimal(16,2)) AS price,
             CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 3 = 0 END AS on_sale,
             CASE WHEN p_partkey % 2 = 0 THEN struct(p_size AS size, p_brand AS brand, struct(p_type AS kind) AS more) END AS detail,
             array(p_size, 1) AS sizes) AS after,
           struct('spu_info' AS table) AS source, 1704067200000 + p_partkey AS ts_ms)) AS value"""
    )
    return change_log(t).unionByName(spu)


def log_messages(events: DataFrame) -> DataFrame:
    """Page logs as text. Sign-ups come from guests, error reports carry an empty user id.

    A value of 150 or more loses its message (null), a click below 1 arrives broken.
    """
    common = """struct(
        CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN NULL ELSE CAST(user_id AS string) END AS uid,
        concat('mid_', user_id) AS mid,
        concat('sid_', event_id) AS sid,
        CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
        CASE user_id % 4 WHEN 0 THEN 'iOS 15.4' WHEN 1 THEN 'Android 13'
             WHEN 2 THEN if(event_id % 2 = 0, 'iOS 16', 'Android 12') ELSE 'Windows 11' END AS os,
        array('xiaomi', 'oppo', 'Appstore', 'web')[int(event_id % 4)] AS ch,
        concat('md_', event_id % 7) AS md,
        concat('ba_', event_id % 5) AS ba,
        concat('v2.1.', user_id % 3) AS vc)"""
    term = f"""array({_quoted(SEARCH_TERMS)})[
        int(if(user_id % 5 = 0 AND event_id % 2 = 1, user_id + 1, user_id) % 6)]"""
    page = f"""CASE WHEN event_type = 'view' THEN struct('keyword' AS item_type, {term} AS item)
        WHEN event_type IN ('click', 'purchase')
        THEN struct('sku_id' AS item_type, CAST(event_id AS string) AS item) END"""
    ms = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)"
    text = f"to_json(struct({common} AS common, {page} AS page, {ms} AS ts))"
    return events.selectExpr(
        f"""CASE WHEN value >= 150 THEN NULL
                 WHEN event_type = 'click' AND value < 1 THEN substring({text}, 1, 20) ELSE {text} END AS value"""
    )


def page_log_messages(t: Tables) -> DataFrame:
    if (stored := t.topic("page_log")) is not None:
        return stored
    return log_messages(t["events"])


def log_records(t: Tables) -> DataFrame:
    """Device-and-search records of the page log."""
    return page_logs.device_and_search(page_logs.page_logs(page_log_messages(t)))


# Events reach the log up to four minutes after they happen.
_EVENT_ARRIVAL = f"{_EVENT_TIME} + (event_id * 37 % 240) * 1000"
STREAM_TIMES["event arrivals"] = _EVENT_ARRIVAL


def arriving_events(events: DataFrame) -> DataFrame:
    """Events with the time they carry and the time they arrive."""
    return events.selectExpr(
        "CAST(user_id AS string) AS uid", f"{_EVENT_TIME} AS ts", "event_id", "event_type", f"{_EVENT_ARRIVAL} AS arrived_ms"
    )


def returning_orders(orders: DataFrame) -> DataFrame:
    """Orders that arrive three times: the second, of a lower time, after half an hour or one and a half, the third, higher
    than that, ten minutes later."""
    second = "if(o_orderkey % 2 = 0, 30, 90)"
    return _order_after(orders).selectExpr("id", "create_time", "CAST(id AS bigint) AS o_orderkey", "explode(sequence(0, 2)) AS nth").selectExpr(
        "id",
        "create_time - element_at(array(0, 1000, 500), nth + 1) AS create_time",
        f"create_time + element_at(array(0, {second}, {second} + 10), nth + 1) * 60000L AS arrived_ms",
    )


def middle_of_events(t: Tables) -> int:
    """The time halfway through the events."""
    return t["events"].selectExpr(f"(min({_EVENT_TIME}) + max({_EVENT_TIME})) div 2").first()[0]


def redelivered(messages: DataFrame) -> DataFrame:
    """Every message twice, as at-least-once delivery may send them."""
    return messages.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")


def category3(t: Tables) -> DataFrame:
    """Third-level categories; names repeat."""
    return t["part"].select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").cast("long").alias("category2_id")
    )


def category2(t: Tables) -> DataFrame:
    """One per part size; some point to no first-level category."""
    sizes = t["part"].select(F.col("p_size").cast("long").alias("id")).distinct()
    return sizes.select(
        "id", F.concat(F.lit("size "), F.col("id").cast("string")).alias("name"), (F.col("id") % 18).alias("category1_id")
    )


def category1(t: Tables) -> DataFrame:
    return F.broadcast(t.spark.createDataFrame(list(enumerate(TOP_CATEGORIES, start=1)), "id long, name string"))


def categories(t: Tables) -> DataFrame:
    third = category3(t)
    return dimensions.category_dim(third, category2(t), category1(t))


def skus(t: Tables) -> DataFrame:
    """Four sale units make a product; some products have no known brand."""
    parts = t["part"]
    product = F.floor(F.col("p_partkey") / 4).cast("long")
    brand = F.substring("p_brand", 7, 10).cast("long") % 12
    sku = parts.select(F.col("p_partkey").alias("id"), product.alias("spu_id"))
    spu = parts.groupBy(product.alias("id")).agg(
        F.min("p_partkey").alias("category3_id"), F.min(brand).alias("tm_id")
    )
    trademark = t.spark.createDataFrame(list(enumerate(BRANDS, start=1)), "id long, tm_name string")
    return dimensions.sku_dim(sku, spu, F.broadcast(trademark))


def products(t: Tables) -> DataFrame:
    return written(dimensions.product_dim(skus(t), categories(t)), "products")


def comparison(t: Tables) -> DataFrame:
    return F.broadcast(t.spark.createDataFrame(list(COMPARISON), "id int, category_name string, search_category string"))


def searches(t: Tables) -> DataFrame:
    return written(dimensions.search_dim(categories(t), comparison(t)), "searches")


def priced_items(t: Tables) -> DataFrame:
    """Order lines as ``id,name,price`` text."""
    return t["lineitem"].selectExpr(
        f"concat_ws(',', concat('P', l_partkey), concat('sku ', l_partkey), {_money('l_extendedprice')}) AS value"
    )


def rate_rules(t: Tables) -> DataFrame:
    """``id:rate`` rules: a first one for two part types, a later one for one of them."""
    rules = """CASE p_type WHEN 'PROMO' THEN array(':0.9', ':0.75') WHEN 'ECONOMY' THEN array(':0.9') END"""
    return t["part"].selectExpr("p_partkey", f"posexplode({rules}) AS (seq, rate)").selectExpr(
        "seq", "concat('P', p_partkey, rate) AS value"
    )


def rates(t: Tables) -> DataFrame:
    return written(dimensions.latest_rates(rate_rules(t)), "rates")


def timed_items(t: Tables) -> DataFrame:
    """Order lines as ``id,name,price`` text, with their time."""
    return t["lineitem"].selectExpr(
        f"concat_ws(',', concat('P', l_partkey), concat('sku ', l_partkey), {_money('l_extendedprice')}) AS value",
        f"{_DETAIL_TIME} AS ts_ms",
    )


RULES = 3


def timed_rules(t: Tables) -> DataFrame:
    """``id:rate`` rules that change as time goes on, for two parts of three; every tenth part is corrected at once."""
    rules = t["part"].filter("p_partkey % 3 <> 0").selectExpr("p_partkey", f"explode(sequence(0, {RULES - 1})) AS n")
    first = rules.selectExpr(
        "concat('P', p_partkey, ':', element_at(array('0.95', '0.8', '0.65'), n + 1)) AS value",
        f"{START_MS} + ((p_partkey * 131 + n * 997331) % {SPREAD_SECONDS}) * 1000 AS ts_ms",
        "n AS seq",
    )
    corrected = rules.filter("p_partkey % 10 = 1 AND n = 1").selectExpr(
        "concat('P', p_partkey, ':0.5') AS value",
        f"{START_MS} + ((p_partkey * 131 + n * 997331) % {SPREAD_SECONDS}) * 1000 AS ts_ms",
        f"{RULES} AS seq",
    )
    return first.unionByName(corrected)


def price_log(t: Tables) -> DataFrame:
    """Order lines (no ``seq``) and rules in one log."""
    return timed_items(t).withColumn("seq", F.lit(None).cast("int")).unionByName(timed_rules(t))


def closing_price(t: Tables) -> DataFrame:
    """An order of a product of its own, a day after everything else."""
    return t["lineitem"].agg(F.count(F.lit(1)).alias("rows")).selectExpr(
        "'none,none,0' AS value", f"{START_MS} + ({SPREAD_SECONDS} + 86400) * 1000L AS ts_ms", "CAST(NULL AS int) AS seq"
    )


# Captured customers: so many versions this long apart, snapshot chunks, and where the log begins.
CAPTURED = 3
CAPTURED_MS = 172_800_000
CHUNKS = 8
CHUNK_MS = 259_200_000
LOG_FROM_MS = START_MS + 172_800_000


def _captured(customers: DataFrame) -> DataFrame:
    """Every version of a customer: created, changed or (some) deleted and created anew, and at last deleted if in debt."""
    return customers.selectExpr("*", f"explode(sequence(0, {CAPTURED - 1})) AS version").selectExpr(
        "c_custkey AS id", "lower(c_name) AS login_name", "c_name AS name", "concat('139', c_custkey) AS phone_num",
        "concat(c_custkey, '@v', version, '.example.com') AS email", "CAST(NULL AS bigint) AS birthday",
        "CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender",
        "CASE WHEN version = 1 AND c_custkey % 7 = 0 OR version = 2 AND c_acctbal < 0 THEN 'd' WHEN version = 0 OR c_custkey % 7 = 0 THEN 'c' ELSE 'u' END AS op",
        f"{START_MS} + (c_custkey * 7919 % {SPREAD_SECONDS}) * 1000 + version * {CAPTURED_MS} AS ts",
        "version",
    ).withColumn("pos", F.expr("ts * 4 + version"))


def _capture_text(rows: DataFrame) -> DataFrame:
    row = f"struct({', '.join(_USER_FIELDS)})"
    return rows.selectExpr(
        f"""to_json(struct(CASE WHEN op NOT IN ('c', 'r') THEN {row} END AS before, CASE WHEN op <> 'd' THEN {row} END AS after,
            struct('user_info' AS table, pos AS pos) AS source, op, ts AS ts_ms)) AS value"""
    )


def capture_log(t: Tables) -> DataFrame:
    """Changes of customers from when the log begins; a fifth of them is delivered twice."""
    logged = _captured(t["customer"]).filter(F.col("ts") >= LOG_FROM_MS)
    return _capture_text(logged.unionByName(logged.filter("id % 5 = 0")))


def chunk_of(key: Column) -> Column:
    return key.cast("long") % CHUNKS


def chunk_positions(t: Tables) -> DataFrame:
    """Log position at which each chunk of the snapshot was read, one chunk after the other."""
    return t.spark.range(CHUNKS).selectExpr("id AS chunk", f"({START_MS} + (id + 1) * {CHUNK_MS}) * 4 + 3 AS position")


def capture_snapshot(t: Tables) -> DataFrame:
    """Each customer as it was when its chunk was read, if it was there."""
    read_at = f"({START_MS} + (id % {CHUNKS} + 1) * {CHUNK_MS})"
    held = _captured(t["customer"]).filter(F.expr(f"ts <= {read_at}"))
    last = held.groupBy("id").agg(F.max_by(F.struct(*held.columns), "version").alias("last")).select("last.*")
    return _capture_text(last.filter("op <> 'd'").selectExpr(*_USER_FIELDS, "'r' AS op", f"{read_at} AS ts", f"{read_at} * 4 + 3 AS pos"))


def sku_changes(t: Tables) -> DataFrame:
    """Brand changes of sale units over time; some are corrected at once, some end in a delete."""
    brand = "(CAST(substring(p_brand, 7, 10) AS int) + 5 * fix + n) % 12"
    changes = t["part"].selectExpr("*", "explode(sequence(0, CAST(p_partkey % 3 AS int))) AS n").selectExpr(
        "*", "explode(sequence(0, if(n = 1 AND p_partkey % 10 = 1, 1, 0))) AS fix"
    )
    names = ", ".join(f"'{name}'" for name in BRANDS)
    return changes.selectExpr(
        "p_partkey AS sku_id",
        f"{START_MS} + (p_partkey * 613 % 800000 + n * 600000) * 1000 AS ts_ms",
        "fix AS seq",
        "n = 2 AND p_partkey % 5 = 0 AS deleted",
        f"CASE WHEN {brand} > 0 THEN element_at(array({names}), {brand}) END AS tname",
    )


def city_codes(t: Tables) -> DataFrame:
    """Cities: the nation is the province, three of them named as the left-out ones."""
    customers = t["customer"]
    nations = t["nation"]
    province = (
        F.when(F.col("n_nationkey") == 0, weather.LEFT_OUT_PROVINCES[0])
        .when(F.col("n_nationkey") == 1, weather.LEFT_OUT_PROVINCES[1])
        .when(F.col("n_nationkey") == 2, weather.LEFT_OUT_PROVINCES[2])
        .otherwise(F.col("n_name"))
    )
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("code"),
        province.alias("province"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("city"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.lower("c_mktsegment")).alias("area"),
        "c_acctbal",
        "c_mktsegment",
    )


def weather_responses(t: Tables) -> DataFrame:
    """Cities with the text of their response: bad status in debt, no reading or an empty list in two segments."""
    segment = F.col("c_mktsegment")
    head = F.concat(
        F.lit('{"status":"'), F.when(F.col("c_acctbal") < 0, "0").otherwise("1"), F.lit('","info":"OK"')
    )
    reading = F.concat(
        F.lit('[{"city":"'),
        F.col("city"),
        F.lit('","reporttime":"'),
        F.when(F.col("c_acctbal") > 5000, "2024-01-01 08:00:00").otherwise(""),
        F.lit('"}]'),
    )
    response = (
        F.when(segment == "MACHINERY", F.concat(head, F.lit(',"lives":[]}')))
        .when(segment == "FURNITURE", F.concat(head, F.lit("}")))
        .otherwise(F.concat(head, F.lit(',"lives":'), reading, F.lit("}")))
    )
    return weather.cities(city_codes(t)).withColumn("response", response)
