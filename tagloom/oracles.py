"""The SQL each query is checked against, written against the stored tables and apart from the Spark code."""

from __future__ import annotations

_ORDERS = """
oi AS (
  SELECT 1704067200000 + (o_orderkey * 7919 % 2592000) * 1000 AS ts_ms,
         CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS uid, o_orderpriority AS consignee,
         1704067200000 + (o_orderkey * 7919 % 2592000) * 1000 AS create_time,
         CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS original_total_amount,
         CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS total_amount,
         o_custkey % 34 + 1 AS province_id,
         CASE WHEN h < 6 THEN '凌晨' WHEN h < 9 THEN '早晨' WHEN h < 12 THEN '上午' WHEN h < 14 THEN '中午'
              WHEN h < 18 THEN '下午' WHEN h < 22 THEN '晚上' ELSE '夜间' END AS pay_time_slot,
         o_orderstatus
  FROM (SELECT *, (o_orderkey * 7919 % 86400) // 3600 AS h FROM orders)
)"""

_DETAILS = """
od AS (
  SELECT 1704067200000 + (l_orderkey * 7919 % 2592000) * 1000
           + ((l_linenumber * 53 + l_partkey) % 400 - 200) * 1000 AS ts_ms,
         CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
         l_partkey AS sku_id, CAST(l_quantity AS BIGINT) AS sku_num, 'sku ' || l_partkey AS sku_name,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS order_price,
         CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS split_total_amount,
         CAST(CAST(l_discount AS DECIMAL(16,2)) AS VARCHAR) AS split_activity_amount,
         CAST(CAST(l_tax AS DECIMAL(16,2)) AS VARCHAR) AS split_coupon_amount,
         1704067200000 + (l_orderkey * 7919 % 2592000) * 1000
           + ((l_linenumber * 53 + l_partkey) % 400 - 200) * 1000 AS create_time,
         epoch_ms(l_shipdate) AS arrived_ms
  FROM lineitem
)"""

_USERS = """
u AS (
  SELECT c_custkey AS id, lower(c_name) AS login_name, c_name AS name, '139' || c_custkey AS phone,
         c_custkey || '@example.com' AS email,
         CASE WHEN c_mktsegment <> 'MACHINERY'
              THEN DATE '1950-01-01' + CAST(c_custkey * 37 % 22000 AS INTEGER) END AS birthday,
         CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender,
         1704067200000 + (c_custkey % 43200) * 60000 AS ts_ms, c_acctbal
  FROM customer
), s AS (
  SELECT c_custkey AS uid, CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 2 THEN 'M' END AS gender,
         CASE c_custkey % 5 WHEN 0 THEN CAST(150 + c_custkey % 50 AS VARCHAR)
                            WHEN 1 THEN CAST(58 + c_custkey % 20 AS VARCHAR)
                            WHEN 2 THEN '1.' || (50 + c_custkey % 50)
                            WHEN 3 THEN 'abc' END AS height,
         CASE c_custkey % 5 WHEN 1 THEN 'in' WHEN 2 THEN 'M' ELSE 'cm' END AS unit_height,
         CASE c_custkey % 4 WHEN 0 THEN CAST(45 + c_custkey % 60 AS VARCHAR)
                            WHEN 1 THEN CAST(100 + c_custkey % 120 AS VARCHAR)
                            WHEN 2 THEN CAST(45000 + c_custkey % 60000 AS VARCHAR)
                            ELSE CAST(c_custkey AS VARCHAR) END AS weight,
         CASE c_custkey % 4 WHEN 0 THEN 'kg' WHEN 1 THEN 'LB' WHEN 2 THEN 'g' END AS unit_weight,
         1704067200000 + (c_custkey % 43200) * 60000 + (c_custkey * 7 % 90 - 45) * 60000 AS ts_ms, c_acctbal
  FROM customer
)"""

_AGE_GROUP = """CASE WHEN age IS NULL THEN NULL WHEN age < 18 THEN 'under 18' WHEN age < 25 THEN '18-24'
  WHEN age < 30 THEN '25-29' WHEN age < 35 THEN '30-34' WHEN age < 40 THEN '35-39' WHEN age < 50 THEN '40-49'
  ELSE '50+' END"""

_ZODIAC = """CASE WHEN birthday IS NULL OR birthday = DATE '1970-01-01' THEN NULL
  WHEN md BETWEEN 120 AND 218 THEN '水瓶座' WHEN md BETWEEN 219 AND 320 THEN '双鱼座'
  WHEN md BETWEEN 321 AND 419 THEN '白羊座' WHEN md BETWEEN 420 AND 520 THEN '金牛座'
  WHEN md BETWEEN 521 AND 621 THEN '双子座' WHEN md BETWEEN 622 AND 722 THEN '巨蟹座'
  WHEN md BETWEEN 723 AND 822 THEN '狮子座' WHEN md BETWEEN 823 AND 922 THEN '处女座'
  WHEN md BETWEEN 923 AND 1023 THEN '天秤座' WHEN md BETWEEN 1024 AND 1122 THEN '天蝎座'
  WHEN md BETWEEN 1123 AND 1221 THEN '射手座' ELSE '摩羯座' END"""

_HEIGHT = """CAST(CAST(round(CAST(CAST(TRY_CAST(height AS DOUBLE)
  * CASE lower(unit_height) WHEN 'in' THEN 2.54::DOUBLE WHEN 'm' THEN 100::DOUBLE ELSE 1::DOUBLE END
  AS VARCHAR) AS DECIMAL(38,15)), 1) AS DECIMAL(20,1)) AS VARCHAR)"""

_WEIGHT = """CASE WHEN unit_weight IS NOT NULL THEN CAST(CAST(round(CAST(CAST(
  CASE lower(unit_weight) WHEN 'lb' THEN TRY_CAST(weight AS DOUBLE) * 0.453592::DOUBLE
       WHEN 'g' THEN TRY_CAST(weight AS DOUBLE) / 1000 ELSE TRY_CAST(weight AS DOUBLE) END
  AS VARCHAR) AS DECIMAL(38,15)), 1) AS DECIMAL(20,1)) AS VARCHAR) END"""

_PAIRS = """
p AS (
  SELECT u.id, u.login_name, u.name, u.phone, u.email, u.birthday, u.gender AS u_gender, u.ts_ms, u.c_acctbal,
         s.uid AS s_uid, s.gender AS s_gender, s.height, s.unit_height, s.weight, s.unit_weight, s.ts_ms AS s_ts_ms
  FROM u JOIN s ON u.id = s.uid AND s.ts_ms BETWEEN u.ts_ms - 1800000 AND u.ts_ms + 1800000
)"""

_TAGS = f"""
t AS (
  SELECT CAST(id AS VARCHAR) AS user_id, login_name, name, phone, email, CAST(age AS VARCHAR) AS age,
         {_AGE_GROUP} AS age_group, coalesce(u_gender, s_gender, 'home') AS gender,
         {_HEIGHT} AS height_cm, {_WEIGHT} AS weight_kg, {_ZODIAC} AS constellation,
         CAST(ts_ms AS VARCHAR) AS ts, c_acctbal
  FROM (SELECT *, 2024 - year(birthday) AS age, month(birthday) * 100 + day(birthday) AS md FROM p)
)"""

_TAG_COLUMNS = (
    "user_id, login_name, name, phone, email, age, age_group, gender, height_cm, weight_kg, constellation, ts"
)


def _json_field(name: str) -> str:
    return f"""CASE WHEN {name} IS NULL THEN '' ELSE ',"{name}":"' || {name} || '"' END"""


_TAG_JSON = "'{\"user_id\":\"' || user_id || '\"' || " + " || ".join(
    _json_field(name) for name in _TAG_COLUMNS.split(", ")[1:]
) + " || '}'"

_LOGS = """
m AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ms,
         CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS raw_uid,
         CASE user_id % 4 WHEN 0 THEN 'iOS 15.4' WHEN 1 THEN 'Android 13'
              WHEN 2 THEN CASE WHEN event_id % 2 = 0 THEN 'iOS 16' ELSE 'Android 12' END ELSE 'Windows 11' END AS raw_os,
         CASE event_id % 4 WHEN 0 THEN 'xiaomi' WHEN 1 THEN 'oppo' WHEN 2 THEN 'Appstore' ELSE 'web' END AS ch,
         'md_' || (event_id % 7) AS md, 'ba_' || (event_id % 5) AS ba, 'v2.1.' || (user_id % 3) AS vc,
         CASE WHEN event_type = 'view' THEN 'keyword' WHEN event_type IN ('click', 'purchase') THEN 'sku_id' END
           AS item_type,
         CASE WHEN event_type = 'view' THEN
                CASE CASE WHEN user_id % 5 = 0 AND event_id % 2 = 1 THEN (user_id + 1) % 6 ELSE user_id % 6 END
                WHEN 0 THEN 'red widget' WHEN 1 THEN 'hot rod' WHEN 2 THEN '扫地机器人' WHEN 3 THEN 'old bolt'
                WHEN 4 THEN 'new ring' ELSE 'iPhone14' END
              WHEN event_type IN ('click', 'purchase') THEN CAST(event_id AS VARCHAR) END AS item,
         event_type = 'click' AND value < 1 AS broken
  FROM events WHERE value < 150
), rec AS (
  SELECT coalesce(raw_uid, '-1') AS uid, ms AS ts, split_part(raw_os, ' ', 1) AS os, ch, md, ba,
         CASE WHEN item_type = 'keyword' THEN item END AS search_item, '{"vc":"' || vc || '"}' AS other_info
  FROM m WHERE NOT broken AND (raw_uid IS NULL OR raw_uid <> '')
), d AS (SELECT DISTINCT * FROM rec)"""

_RECORD_ORDER = (
    "ts, os NULLS FIRST, ch NULLS FIRST, md NULLS FIRST, ba NULLS FIRST, search_item NULLS FIRST, other_info NULLS FIRST"
)

_DIMS = """
c3 AS (SELECT p_partkey AS id, p_name AS name, p_size AS category2_id FROM part),
c2 AS (SELECT DISTINCT p_size AS id, 'size ' || p_size AS name, p_size % 18 AS category1_id FROM part),
c1(id, name) AS (VALUES (1,'图书、音像、电子书刊'),(2,'手机'),(3,'家用电器'),(4,'数码'),(5,'家居家装'),(6,'电脑办公'),
  (7,'厨具'),(8,'个护化妆'),(9,'服饰内衣'),(10,'钟表'),(11,'鞋靴'),(12,'母婴'),(13,'礼品箱包'),
  (14,'食品饮料、保健食品'),(15,'珠宝'),(16,'汽车用品'),(17,'运动健康')),
cat AS (
  SELECT c3.id, c3.name AS b3name, c2.name AS b2name, c1.name AS b1name
  FROM c3 JOIN c2 ON c3.category2_id = c2.id JOIN c1 ON c2.category1_id = c1.id
),
tm(id, tm_name) AS (VALUES (1,'Redmi'),(2,'苹果'),(3,'联想'),(4,'TCL'),(5,'小米'),(6,'长粒香'),(7,'金沙河'),
  (8,'索芙特'),(9,'CAREMiLLE'),(10,'欧莱雅'),(11,'香奈儿')),
spu AS (
  SELECT p_partkey // 4 AS id, min(p_partkey) AS category3_id, min(CAST(substr(p_brand, 7) AS BIGINT) % 12) AS tm_id
  FROM part GROUP BY p_partkey // 4
),
sku AS (
  SELECT p_partkey AS skuid, spu.id AS spuid, spu.category3_id AS c3id, tm.tm_name AS tname
  FROM part JOIN spu ON p_partkey // 4 = spu.id JOIN tm ON spu.tm_id = tm.id
)"""

_SEARCH = """
cmp(id, category_name, search_category) AS (VALUES (1,'数码','科技与数码'),(2,'手机','科技与数码'),
  (3,'电脑办公','科技与数码'),(4,'数码','性价比'),(5,'服饰内衣','时尚与潮流'),(6,'珠宝','时尚与潮流'),
  (7,'家用电器','性价比'),(8,'厨具','家庭与育儿'),(9,'母婴','家庭与育儿'),(10,'运动健康','健康与养生'),
  (11,'图书、音像、电子书刊','学习与发展'),(12,'汽车用品','性价比')),
term AS (
  SELECT b3name, b1name AS b1_category,
         (SELECT search_category FROM cmp WHERE category_name = b1name ORDER BY id LIMIT 1) AS search_category
  FROM cat WHERE id = (SELECT max(o.id) FROM cat o WHERE o.b3name = cat.b3name)
)"""


def _scores(name: str, coefficient: str, alias: str) -> str:
    buckets = ("18_24", "25_29", "30_34", "35_39", "40_49", "50_plus")
    return ", ".join(
        f"CAST(round({alias}.w{i} * {coefficient}, 3) AS DOUBLE) AS {name}_{bucket}"
        for i, bucket in enumerate(buckets, start=1)
    )


_W = "w1, w2, w3, w4, w5, w6"

_DEVICE_RULE = f"""
device_rule(k, {_W}) AS (VALUES ('iOS', 0.7, 0.6, 0.5, 0.4, 0.3, 0.2), ('Android', 0.8, 0.7, 0.6, 0.5, 0.4, 0.3))"""
_DEVICE_SCORES = _scores("device", "0.1", "dr")

_SEARCH_RULE = f"""
search_rule(k, {_W}) AS (VALUES ('时尚与潮流', 0.9, 0.7, 0.5, 0.3, 0.2, 0.1), ('性价比', 0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
  ('健康与养生', 0.1, 0.2, 0.4, 0.6, 0.8, 0.7), ('家庭与育儿', 0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
  ('科技与数码', 0.8, 0.6, 0.4, 0.3, 0.2, 0.1), ('学习与发展', 0.4, 0.5, 0.6, 0.7, 0.8, 0.7),
  ('none', 0.0, 0.0, 0.0, 0.0, 0.0, 0.0))"""
_SEARCH_SCORES = _scores("search", "0.15", "sr")
_SEARCH_KEY = """CASE WHEN search_category IN ('时尚与潮流', '性价比', '健康与养生', '家庭与育儿', '科技与数码', '学习与发展')
  THEN search_category ELSE 'none' END"""

_TIME_RULE = f"""
time_rule(k, {_W}) AS (VALUES ('凌晨', 0.2, 0.1, 0.1, 0.1, 0.1, 0.1), ('早晨', 0.1, 0.1, 0.1, 0.1, 0.2, 0.3),
  ('上午', 0.2, 0.2, 0.2, 0.2, 0.3, 0.4), ('中午', 0.4, 0.4, 0.4, 0.4, 0.4, 0.3), ('下午', 0.4, 0.5, 0.5, 0.5, 0.5, 0.4),
  ('晚上', 0.8, 0.7, 0.6, 0.5, 0.4, 0.3), ('夜间', 0.9, 0.7, 0.5, 0.3, 0.2, 0.1))"""
_TIME_SCORES = _scores("pay_time", "0.1", "ptr")

_AMOUNT_RULE = f"""
amount_rule(k, {_W}) AS (VALUES (1, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1), (2, 0.2, 0.4, 0.6, 0.7, 0.8, 0.7),
  (3, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6))"""
_AMOUNT_SCORES = _scores("amount", "0.15", "ar")


def _amount_key(amount: str) -> str:
    return (
        f"CASE WHEN CAST({amount} AS DOUBLE) < 1000 THEN 1 "
        f"WHEN CAST({amount} AS DOUBLE) > 1000 AND CAST({amount} AS DOUBLE) < 4000 THEN 2 ELSE 3 END"
    )


_BRAND_RULE = f"""
brand_rule(k, {_W}) AS (VALUES ('TCL', 0.2, 0.3, 0.4, 0.5, 0.6, 0.7), ('苹果', 0.9, 0.8, 0.7, 0.7, 0.7, 0.5),
  ('联想', 0.9, 0.8, 0.7, 0.7, 0.7, 0.5), ('小米', 0.9, 0.8, 0.7, 0.7, 0.7, 0.5), ('欧莱雅', 0.5, 0.6, 0.8, 0.8, 0.9, 0.2),
  ('香奈儿', 0.3, 0.4, 0.6, 0.8, 0.9, 0.2), ('other', 0.1, 0.2, 0.3, 0.4, 0.5, 0.6))"""
_BRAND_SCORES = _scores("brand", "0.2", "br")
_BRAND_KEY = """CASE WHEN tname IN ('TCL', '苹果', '联想', '小米', '欧莱雅', '香奈儿') THEN tname
  WHEN tname <> '' THEN 'other' END"""

_CATEGORY_RULE = f"""
category_rule(k, {_W}) AS (VALUES ('young', 0.9, 0.8, 0.6, 0.4, 0.2, 0.1), ('home', 0.2, 0.4, 0.6, 0.8, 0.9, 0.7),
  ('other', 0.1, 0.2, 0.4, 0.5, 0.8, 0.9))"""
_CATEGORY_SCORES = _scores("category", "0.3", "cr")
_CATEGORY_KEY = """CASE WHEN b1_name IN ('数码', '手机', '电脑办公', '个护化妆', '服饰内衣') THEN 'young'
  WHEN b1_name IN ('家居家装', '图书、音像、电子书刊', '厨具', '鞋靴', '母婴', '汽车用品', '珠宝', '家用电器') THEN 'home'
  WHEN b1_name <> '' THEN 'other' END"""

_ENRICHED = """
en AS (
  SELECT od.id AS detail_id, od.sku_id, sku.c3id, sku.tname, cat.b1name AS b1_name
  FROM od LEFT JOIN sku ON od.sku_id = sku.skuid LEFT JOIN cat ON sku.c3id = cat.id
)"""

_MERGED_COLUMNS = """
  od.order_id, od.id AS detail_id, oi.uid, oi.consignee, oi.create_time, oi.ts_ms, oi.original_total_amount,
  oi.total_amount, oi.province_id, oi.pay_time_slot, od.sku_id, od.sku_num, od.sku_name, od.order_price,
  CAST(od.split_total_amount AS DOUBLE) AS split_total_amount,
  CAST(od.split_activity_amount AS DOUBLE) AS split_activity_amount, od.split_coupon_amount,
  od.ts_ms AS detail_ts_ms"""
_MERGED = f"""
SELECT {_MERGED_COLUMNS}
FROM oi JOIN od ON oi.id = od.order_id AND od.ts_ms BETWEEN oi.ts_ms - 120000 AND oi.ts_ms + 120000"""

_ORDER_BY_ARRIVAL = (
    "greatest(ts_ms, detail_ts_ms), ts_ms, detail_ts_ms, order_id, uid, consignee, create_time, original_total_amount, "
    "total_amount, province_id, pay_time_slot, sku_id, sku_num, sku_name, order_price, split_total_amount, "
    "split_activity_amount, split_coupon_amount"
)

# Three records of each order: later totals, half of them with a later time in the last.
_VERSIONS = """
oi AS (
  SELECT ts_ms, id, uid, consignee, create_time, original_total_amount, total_amount, province_id,
         CASE WHEN h < 6 THEN '凌晨' WHEN h < 9 THEN '早晨' WHEN h < 12 THEN '上午' WHEN h < 14 THEN '中午'
              WHEN h < 18 THEN '下午' WHEN h < 22 THEN '晚上' ELSE '夜间' END AS pay_time_slot
  FROM (
    SELECT *, create_time // 3600000 % 24 AS h FROM (
      SELECT t0 + version * 30000 AS ts_ms, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS uid,
             o_orderpriority AS consignee,
             CASE WHEN version = 2 AND (o_custkey % 34 + 1) % 2 = 0 THEN t0 + 1000 ELSE t0 END AS create_time,
             CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS original_total_amount,
             CAST(CAST(CAST(o_totalprice AS DECIMAL(16,2)) + version * 1500 AS DECIMAL(16,2)) AS VARCHAR) AS total_amount,
             o_custkey % 34 + 1 AS province_id
      FROM (SELECT *, 1704067200000 + (o_orderkey * 7919 % 2592000) * 1000 AS t0 FROM orders),
           (VALUES (0), (1), (2)) v(version)))
)"""


def _order_scores(where: str = "", orders: str = _ORDERS) -> str:
    return f"""WITH {orders}, {_DETAILS}, {_DIMS}, {_TIME_RULE}, {_AMOUNT_RULE}, {_BRAND_RULE}, {_CATEGORY_RULE},
mg AS (
  SELECT *, max(create_time) OVER (PARTITION BY detail_id ORDER BY {_ORDER_BY_ARRIVAL}
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM ({_MERGED} {where})
),
k AS (
  SELECT mg.*, sku.c3id, sku.tname, cat.b1name AS b1_name
  FROM mg LEFT JOIN sku ON mg.sku_id = sku.skuid LEFT JOIN cat ON sku.c3id = cat.id
  WHERE seen IS NULL OR create_time > seen
)
SELECT order_id, detail_id, uid, b1_name, tname, sku_name, order_price, sku_num, original_total_amount, total_amount,
  split_total_amount, split_activity_amount, split_coupon_amount, pay_time_slot, create_time, ts_ms, province_id, c3id,
  consignee, sku_id, {_CATEGORY_SCORES}, {_BRAND_SCORES}, {_AMOUNT_SCORES}, {_TIME_SCORES}
FROM k LEFT JOIN category_rule cr ON cr.k = {_CATEGORY_KEY} LEFT JOIN brand_rule br ON br.k = {_BRAND_KEY}
  LEFT JOIN amount_rule ar ON ar.k = {_amount_key("total_amount")} LEFT JOIN time_rule ptr ON ptr.k = pay_time_slot"""


def _set(name: str) -> str:
    return f"coalesce(array_to_string(list_sort(list_distinct(list({name}))), ','), '')"


_PROFILE = f"""
win AS (SELECT DISTINCT uid, ts // 120000 AS slot FROM d),
prof AS (
  SELECT win.uid, win.slot * 120000 AS window_start, count(*) AS pv, {_set("os")} AS os, {_set("ch")} AS ch,
         {_set("md")} AS md, {_set("ba")} AS ba, {_set("search_item")} AS search_item
  FROM win JOIN d ON d.uid = win.uid AND d.ts // 120000 <= win.slot GROUP BY win.uid, win.slot
)"""

def _behavior_scores() -> str:
    return f"""WITH {_LOGS}, {_DIMS}, {_SEARCH}, {_DEVICE_RULE}, {_SEARCH_RULE}, {_PROFILE},
j AS (
  SELECT prof.*, CASE WHEN list_contains(string_split(os, ','), 'iOS') THEN 'iOS'
                      WHEN list_contains(string_split(os, ','), 'Android') THEN 'Android'
                      ELSE string_split(os, ',')[1] END AS judge_os, b1_category, search_category
  FROM prof LEFT JOIN term ON search_item = b3name
)
SELECT uid, window_start, pv, os, ch, md, ba, search_item, judge_os, b1_category, search_category,
  {_DEVICE_SCORES}, {_SEARCH_SCORES}
FROM j LEFT JOIN device_rule dr ON dr.k = judge_os LEFT JOIN search_rule sr ON sr.k = {_SEARCH_KEY}"""


def _profile() -> str:
    return f"WITH {_LOGS}, {_PROFILE} SELECT * FROM prof"


_WINDOW_SETS = ", ".join(
    f"array_to_string(list_sort(list_distinct(list({name}) OVER w)), ',') AS {name}"
    for name in ("os", "ch", "md", "ba", "search_item")
)
_RUNNING_SETS = f"""WITH {_LOGS}
SELECT uid, ts, count(*) OVER w AS pv, {_WINDOW_SETS} FROM d
WINDOW w AS (PARTITION BY uid ORDER BY {_RECORD_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

_RUNNING_PV = f"""
SELECT uid, ts, os, ch, md, ba, count(*) OVER (PARTITION BY uid ORDER BY {_RECORD_ORDER}
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv FROM d"""

_DETAIL_MONOTONE = f"""WITH {_DETAILS}
SELECT id, arrived_ms, create_time FROM (
  SELECT *, max(create_time) OVER (
    PARTITION BY id ORDER BY arrived_ms, create_time, sku_id, sku_num, order_price, split_activity_amount
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM od)
WHERE seen IS NULL OR create_time > seen"""

_USER_JOIN = f"""WITH {_USERS}, {_PAIRS}
SELECT id, name, ts_ms, s_uid, s_ts_ms, height AS s_height, weight AS s_weight FROM p"""

_USER_TAGS = f"WITH {_USERS}, {_PAIRS}, {_TAGS} SELECT {_TAG_COLUMNS} FROM t WHERE c_acctbal >= 0"

_TAG_RECORDS = f"WITH {_USERS}, {_PAIRS}, {_TAGS} SELECT * EXCLUDE (ts, c_acctbal), CAST(ts AS BIGINT) AS ts FROM t"

_LOG_IDENTITY = f"""WITH {_LOGS}
SELECT 'mid_' || user_id AS mid, raw_uid AS uid, ms AS ts FROM m WHERE NOT broken"""

_LOG_TEXT = """
'{"common":{' || CASE WHEN raw_uid IS NULL THEN '' ELSE '"uid":"' || raw_uid || '",' END
  || '"mid":"mid_' || user_id || '","sid":"sid_' || event_id || '","is_new":"'
  || CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END || '","os":"' || raw_os || '","ch":"' || ch || '","md":"'
  || md || '","ba":"' || ba || '","vc":"' || vc || '"}'
  || CASE WHEN item_type IS NULL THEN ''
          ELSE ',"page":{"item_type":"' || item_type || '","item":"' || item || '"}' END
  || ',"ts":' || ms || '}'"""

_CITIES = """
cty AS (
  SELECT c_custkey AS code, CASE n_nationkey WHEN 0 THEN '澳门特别行政区' WHEN 1 THEN '台湾省' WHEN 2 THEN '香港特别行政区'
         ELSE n_name END AS province, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS city,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN lower(c_mktsegment) END AS area, c_acctbal, c_mktsegment
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_mktsegment <> 'BUILDING' AND n_nationkey NOT IN (0, 1, 2)
), res AS (SELECT *, c_acctbal >= 0 AND c_mktsegment <> 'MACHINERY' AS ok FROM cty)"""

_WEATHER_ROWS = f"""WITH {_CITIES}
SELECT CAST(code AS INTEGER) AS code, province, city, coalesce(area, city) AS area, 'OK' AS info,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN '{{}}' ELSE '{{"city":"' || city || '","reporttime":"'
         || CASE WHEN c_acctbal > 5000 THEN '2024-01-01 08:00:00' ELSE '' END || '"}}' END AS lives,
       CASE WHEN c_mktsegment <> 'FURNITURE' AND c_acctbal > 5000 THEN '2024-01-01 08:00:00' END AS report_time
FROM res WHERE ok"""

_WEATHER_SUMMARY = f"""
SELECT code // 500 AS batch, count(*) FILTER (WHERE ok) AS success_count, count(*) FILTER (WHERE NOT ok) AS fail_count,
       coalesce(array_to_string(list_sort(list(code) FILTER (WHERE NOT ok)), ','), '') AS failed,
       min(code) AS first_code, max(code) AS last_code
FROM res GROUP BY code // 500"""

_MONEY_2 = "CAST(CAST(round(CAST(CAST({} AS VARCHAR) AS DECIMAL(38,15)), 2) AS DECIMAL(20,2)) AS VARCHAR)"

_ITEMS = """
rule AS (
  SELECT p_partkey, n, 1704067200000 + ((p_partkey * 131 + n * 997331) % 2592000) * 1000 AS ts
  FROM part, range(3) r(n) WHERE p_partkey % 3 <> 0
), rr AS (
  SELECT p_partkey, ts, arg_max(rate, seq) AS rate FROM (
    SELECT p_partkey, ts, n AS seq, CASE n WHEN 0 THEN 0.95::DOUBLE WHEN 1 THEN 0.8::DOUBLE ELSE 0.65::DOUBLE END AS rate FROM rule
    UNION ALL SELECT p_partkey, ts, 3, 0.5::DOUBLE FROM rule WHERE n = 1 AND p_partkey % 10 = 1)
  GROUP BY p_partkey, ts
), li AS (
  SELECT l_partkey, l_extendedprice, 1704067200000 + (l_orderkey * 7919 % 2592000) * 1000
           + ((l_linenumber * 53 + l_partkey) % 400 - 200) * 1000 AS ts_ms FROM lineitem
)"""

_RATES_AS_OF = f"""WITH {_ITEMS}
SELECT 'P' || l_partkey AS id, 'sku ' || l_partkey AS name, CAST(CAST(l_extendedprice AS DECIMAL(20,2)) AS VARCHAR) AS price,
       CAST(CAST(coalesce(rate, 1.0::DOUBLE) AS DECIMAL(20,2)) AS VARCHAR) AS rate,
       {_MONEY_2.format("l_extendedprice * coalesce(rate, 1.0::DOUBLE)")} AS adjusted, ts_ms
FROM li ASOF LEFT JOIN rr ON l_partkey = rr.p_partkey AND ts_ms >= rr.ts"""

_VERSIONED = f"""{_DIMS}, chg AS (
  SELECT p_partkey AS sku_id, 1704067200000 + (p_partkey * 613 % 800000 + n * 600000) * 1000 AS ts, n, fix,
         (CAST(substr(p_brand, 7) AS BIGINT) + 5 * fix + n) % 12 AS brand
  FROM part, range(3) r(n), range(2) f(fix)
  WHERE n <= p_partkey % 3 AND (fix = 0 OR n = 1 AND p_partkey % 10 = 1)
), ver AS (
  SELECT sku_id, tm_name AS tname, ts AS valid_from, lead(ts) OVER (PARTITION BY sku_id ORDER BY ts) AS valid_to,
         n = 2 AND sku_id % 5 = 0 AS gone
  FROM (SELECT * FROM chg c WHERE fix = (SELECT max(o.fix) FROM chg o WHERE o.sku_id = c.sku_id AND o.ts = c.ts))
  LEFT JOIN tm ON tm.id = brand
)"""

_CAPTURED = """
ev AS (
  SELECT c_custkey AS ck, v, 1704067200000 + (c_custkey * 7919 % 2592000) * 1000 + v * 172800000 AS ts,
         1704067200000 + (c_custkey % 8 + 1) * 259200000 AS read_at, c_custkey || '@v' || v || '.example.com' AS email,
         CASE WHEN v = 1 AND c_custkey % 7 = 0 OR v = 2 AND c_acctbal < 0 THEN 'd'
              WHEN v = 0 OR c_custkey % 7 = 0 THEN 'c' ELSE 'u' END AS op
  FROM customer, range(3) r(v)
)"""


def _types(table: str, source: str, paths: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS source_table, '{path}' AS path, '{kind}' AS type, count({value}) AS rows FROM {source}"
        for path, (kind, value) in paths.items()
    )


_VARIANT = f"""WITH {_USERS}, {_ORDERS}, {_DETAILS}, found AS ({" UNION ALL ".join([
    _types("user_info", "u WHERE c_acctbal >= 0", {
        "id": ("BIGINT", "id"), "login_name": ("STRING", "login_name"), "name": ("STRING", "name"),
        "phone_num": ("STRING", "phone"), "email": ("STRING", "email"), "birthday": ("BIGINT", "birthday"),
        "gender": ("STRING", "gender")}),
    _types("user_info_sup", "s WHERE c_acctbal >= 0", {
        "uid": ("BIGINT", "uid"), "gender": ("STRING", "gender"), "height": ("STRING", "height"),
        "unit_height": ("STRING", "unit_height"), "weight": ("STRING", "weight"), "unit_weight": ("STRING", "unit_weight")}),
    _types("order_info", "oi WHERE o_orderstatus <> 'P'", {
        "id": ("STRING", "id"), "user_id": ("STRING", "uid"), "consignee": ("STRING", "consignee"),
        "create_time": ("BIGINT", "create_time"), "original_total_amount": ("STRING", "original_total_amount"),
        "total_amount": ("STRING", "total_amount"), "province_id": ("BIGINT", "province_id")}),
    _types("order_detail", "od", {
        "id": ("STRING", "id"), "order_id": ("STRING", "order_id"), "sku_id": ("BIGINT", "sku_id"),
        "sku_num": ("BIGINT", "sku_num"), "sku_name": ("STRING", "sku_name"), "order_price": ("STRING", "order_price"),
        "split_total_amount": ("STRING", "split_total_amount"), "split_activity_amount": ("STRING", "split_activity_amount"),
        "split_coupon_amount": ("STRING", "split_coupon_amount"), "create_time": ("BIGINT", "create_time")}),
    _types("spu_info", "part", {
        "id": ("BIGINT", "p_partkey"), "spu_name": ("STRING", "p_name"), "price": ("DECIMAL", "p_retailprice"),
        "on_sale": ("BOOLEAN", "CASE WHEN p_partkey % 4 = 0 THEN 1 END"), "sizes": ("ARRAY", "*"),
        "detail.size": ("BIGINT", "CASE WHEN p_partkey % 2 = 0 THEN p_size END"),
        "detail.brand": ("STRING", "CASE WHEN p_partkey % 2 = 0 THEN p_brand END"),
        "detail.more.kind": ("STRING", "CASE WHEN p_partkey % 2 = 0 THEN p_type END")}),
])})
SELECT * FROM found WHERE rows > 0"""

ORACLES: dict[str, str] = {
    "rates_as_of": _RATES_AS_OF,
    "stream_rates": _RATES_AS_OF,
    "dim_versions": f"WITH {_VERSIONED} SELECT sku_id, tname, valid_from, valid_to FROM ver WHERE NOT gone",
    "order_enrich_as_of": f"""WITH {_VERSIONED}, {_DETAILS}
SELECT od.id AS detail_id, od.sku_id, od.ts_ms, ver.tname
FROM od LEFT JOIN ver ON ver.sku_id = od.sku_id AND NOT gone AND od.ts_ms >= valid_from AND (valid_to IS NULL OR od.ts_ms < valid_to)""",
    "cdc_state": """
SELECT c_custkey AS id, lower(c_name) AS login_name, c_name AS name, '139' || c_custkey AS phone_num,
       c_custkey || '@v2.example.com' AS email, CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender
FROM customer WHERE c_acctbal >= 0""",
    "cdc_handover": f"""WITH {_CAPTURED}
SELECT CAST(ck AS VARCHAR) AS row_key, read_at * 4 + 3 AS position, 'r' AS op, email
FROM ev e WHERE v = (SELECT max(o.v) FROM ev o WHERE o.ck = e.ck AND o.ts <= o.read_at) AND op <> 'd'
UNION ALL SELECT CAST(ck AS VARCHAR), ts * 4 + v, op, CASE WHEN op <> 'd' THEN email END
FROM ev WHERE ts >= 1704240000000 AND ts * 4 + v > read_at * 4 + 3""",
    "cdc_variant": _VARIANT,
    "cdc_any_table": """
SELECT 1704067200000 + p_partkey AS ts_ms, p_partkey AS id, p_name AS spu_name,
       CAST(CAST(p_retailprice AS DECIMAL(16,2)) AS DOUBLE) AS price,
       CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 3 = 0 END AS on_sale,
       CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS BIGINT) END AS detail_size,
       CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS detail_brand,
       CASE WHEN p_partkey % 2 = 0 THEN p_type END AS detail_more_kind, '[' || p_size || ',1]' AS sizes
FROM part""",
    "window_distinct": f"""WITH {_LOGS}, {_PROFILE}
SELECT uid, window_start, pv, {", ".join(
        f"CASE WHEN {name} = '' THEN 0 ELSE CAST(len(string_split({name}, ',')) AS BIGINT) END AS n_{name}"
        for name in ("os", "ch", "md", "ba", "search_item"))} FROM prof""",
    "order_csv_packed": _order_scores(),
    "weather_upsert": f"SELECT *, code % 3 AS reading FROM ({_WEATHER_ROWS})",
    "stream_arrival_window": """WITH a AS (
  SELECT CAST(user_id AS VARCHAR) AS uid, epoch_us(ts) // 1000 AS ts, event_id, event_type,
         epoch_us(ts) // 1000 + (event_id * 37 % 240) * 1000 AS arrived_ms FROM events
)
SELECT uid, arrived_ms // 120000 * 120000 AS window_start, ts, event_id, event_type, arrived_ms FROM a
QUALIFY row_number() OVER (PARTITION BY uid, arrived_ms // 120000 ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_last_forgotten": f"""WITH {_ORDERS}
SELECT id, create_time, create_time AS arrived_ms FROM oi
UNION ALL SELECT id, create_time - 1000, create_time + 5400000 FROM oi WHERE CAST(id AS BIGINT) % 2 = 1
UNION ALL SELECT id, create_time - 500, create_time + 6000000 FROM oi WHERE CAST(id AS BIGINT) % 2 = 1""",
    "stream_late_counts": f"""WITH {_LOGS}, half AS (
  SELECT epoch_us(min(ts)) + ((epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000) * 500000 AS middle FROM events
), n AS (
  SELECT (SELECT count(*) FROM rec) AS recs, (SELECT count(*) FROM d) AS kept,
         (SELECT count(*) FROM events, half WHERE event_id % 40 = 0 AND value BETWEEN 1 AND 149
            AND epoch_us(ts) < middle AND event_type <> 'error') AS late
)
SELECT CAST(2 * (recs + late) AS BIGINT) AS incoming, CAST(kept AS BIGINT) AS kept, CAST(2 * recs - kept AS BIGINT) AS repeated,
       CAST(2 * late AS BIGINT) AS late FROM n""",
    "stream_profile_resumed": _RUNNING_SETS,
    "state_values": f"""WITH {_DETAILS}
SELECT id, create_time AS value, min(arrived_ms) AS passed_ms FROM od
WHERE create_time = (SELECT max(o.create_time) FROM od o WHERE o.id = od.id) GROUP BY id, create_time""",
    "pay_time_slot": f"WITH {_ORDERS} SELECT id, create_time, pay_time_slot FROM oi",
    "score_time": f"""WITH {_ORDERS}, {_TIME_RULE}
SELECT id, pay_time_slot, {_TIME_SCORES} FROM oi LEFT JOIN time_rule ptr ON ptr.k = pay_time_slot""",
    "score_amount": f"""WITH {_DETAILS}, {_AMOUNT_RULE}
SELECT id, order_price, {_AMOUNT_SCORES} FROM od JOIN amount_rule ar ON ar.k = {_amount_key("order_price")}""",
    "score_brand": f"""WITH {_DETAILS}, {_DIMS}, {_ENRICHED}, {_BRAND_RULE}
SELECT detail_id, tname, {_BRAND_SCORES} FROM en LEFT JOIN brand_rule br ON br.k = {_BRAND_KEY}""",
    "score_category": f"""WITH {_DETAILS}, {_DIMS}, {_ENRICHED}, {_CATEGORY_RULE}
SELECT detail_id, b1_name, {_CATEGORY_SCORES} FROM en LEFT JOIN category_rule cr ON cr.k = {_CATEGORY_KEY}""",
    "score_device": f"""WITH {_LOGS}, {_DEVICE_RULE}, j AS (
  SELECT uid, CASE WHEN bool_or(os = 'iOS') THEN 'iOS' WHEN bool_or(os = 'Android') THEN 'Android' ELSE min(os) END
    AS judge_os FROM rec GROUP BY uid)
SELECT uid, judge_os, {_DEVICE_SCORES} FROM j LEFT JOIN device_rule dr ON dr.k = judge_os""",
    "score_search": f"""WITH {_LOGS}, {_DIMS}, {_SEARCH}, {_SEARCH_RULE}, j AS (
  SELECT uid, CASE WHEN count(DISTINCT search_item) = 1 THEN min(search_item) END AS search_item FROM rec GROUP BY uid),
k AS (SELECT j.*, b1_category, search_category FROM j LEFT JOIN term ON search_item = b3name)
SELECT uid, search_item, b1_category, search_category, {_SEARCH_SCORES}
FROM k JOIN search_rule sr ON sr.k = {_SEARCH_KEY}""",
    "age_group": f"""WITH {_USERS}
SELECT id, age, {_AGE_GROUP} AS age_group FROM (SELECT *, CAST(2024 - year(birthday) AS INTEGER) AS age FROM u)""",
    "gender_tag": f"WITH {_USERS}, {_PAIRS} SELECT id, coalesce(u_gender, s_gender, 'home') AS gender FROM p",
    "body_metrics": f"WITH {_USERS} SELECT uid, {_HEIGHT} AS height_cm, {_WEIGHT} AS weight_kg FROM s",
    "zodiac": f"""WITH {_USERS}
SELECT id, {_ZODIAC} AS constellation FROM (SELECT *, month(birthday) * 100 + day(birthday) AS md FROM u)""",
    "dim_category": f"WITH {_DIMS} SELECT * FROM cat",
    "dim_sku": f"WITH {_DIMS} SELECT * FROM sku",
    "order_enrich": f"WITH {_DETAILS}, {_DIMS}, {_ENRICHED} SELECT * FROM en",
    "search_category": f"""WITH {_LOGS}, {_DIMS}, {_SEARCH}
SELECT uid, ts, search_item, b1_category, search_category FROM rec LEFT JOIN term ON search_item = b3name""",
    "broadcast_rules": f"""
SELECT 'P' || l_partkey AS id, 'sku ' || l_partkey AS name,
       CAST(CAST(l_extendedprice AS DECIMAL(20,2)) AS VARCHAR) AS price,
       CASE p_type WHEN 'PROMO' THEN '0.75' WHEN 'ECONOMY' THEN '0.90' ELSE '1.00' END AS rate,
       {_MONEY_2.format("l_extendedprice * CASE p_type WHEN 'PROMO' THEN 0.75::DOUBLE WHEN 'ECONOMY' THEN 0.9::DOUBLE "
                        "ELSE 1.0::DOUBLE END")} AS adjusted
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "user_interval_join": _USER_JOIN,
    "order_interval_join": f"WITH {_ORDERS}, {_DETAILS} {_MERGED}",
    "log_dedup": f"WITH {_LOGS} SELECT * FROM d",
    "detail_monotone": _DETAIL_MONOTONE,
    "running_pv": f"WITH {_LOGS} {_RUNNING_PV}",
    "running_sets": _RUNNING_SETS,
    "window_last": f"""WITH {_LOGS}, r AS ({_RUNNING_PV})
SELECT uid, ts // 120000 * 120000 AS window_start, arg_max(ts, pv) AS ts, arg_max(os, pv) AS os, arg_max(ch, pv) AS ch,
       arg_max(md, pv) AS md, arg_max(ba, pv) AS ba, max(pv) AS pv FROM r GROUP BY uid, ts // 120000""",
    "window_profile": _profile(),
    "cdc_envelope": f"""WITH {_USERS}, {_ORDERS}, {_DETAILS}
SELECT 'user_info' AS source_table, ts_ms, CASE WHEN c_acctbal < 0 THEN 'delete' ELSE 'row' END AS kind,
       CASE WHEN c_acctbal >= 0 THEN CAST(id AS VARCHAR) END AS row_id FROM u
UNION ALL SELECT 'user_info_sup', ts_ms, 'row', CAST(uid AS VARCHAR) FROM s WHERE c_acctbal >= 0
UNION ALL SELECT 'order_info', ts_ms, CASE WHEN o_orderstatus = 'P' THEN 'delete' ELSE 'row' END,
       CASE WHEN o_orderstatus <> 'P' THEN id END FROM oi
UNION ALL SELECT 'order_detail', ts_ms, 'row', id FROM od""",
    "cdc_route": f"""WITH {_USERS}, {_ORDERS}, {_DETAILS}
SELECT 'users' AS topic, 'user_info' AS source_table, ts_ms FROM u
UNION ALL SELECT 'supplements', 'user_info_sup', ts_ms FROM s WHERE c_acctbal >= 0
UNION ALL SELECT 'orders', 'order_info', ts_ms FROM oi
UNION ALL SELECT 'details', 'order_detail', ts_ms FROM od""",
    "cdc_quarantine": f"""WITH {_USERS}
SELECT '{{"after":{{"u' AS value, 'not json' AS reason FROM s WHERE c_acctbal < 0
UNION ALL SELECT CASE c_custkey % 8
    WHEN 0 THEN '{{"after":{{"id":"x' || c_custkey || '"}},"source":{{"table":"user_info"}},"op":"c","ts_ms":1}}'
    WHEN 1 THEN '{{"source":{{"table":"user_info"}},"ddl":"ALTER ' || c_custkey || '","ts_ms":1}}'
    WHEN 2 THEN '{{"after":{{"id":' || c_custkey || '}},"ts_ms":1}}'
    WHEN 3 THEN '{{"after":{{"id":' || c_custkey
    WHEN 6 THEN '{{"after":{{"gender":"M"}},"source":{{"table":"user_info_sup"}},"ts_ms":' || c_custkey || '}}' END,
  CASE c_custkey % 8 WHEN 0 THEN 'bad key' WHEN 1 THEN 'schema change' WHEN 2 THEN 'no table' WHEN 3 THEN 'not json'
    WHEN 6 THEN 'bad key' END
FROM customer WHERE c_custkey % 8 IN (0, 1, 2, 3, 6)""",
    "log_quarantine": f"""WITH {_LOGS}, x AS (SELECT broken, {_LOG_TEXT} AS txt FROM m)
SELECT substr(txt, 1, 20) AS value, 'not json' AS reason FROM x WHERE broken
UNION ALL SELECT CASE event_id % 5
    WHEN 0 THEN '{{"page":{{"item":"' || event_id || '"}},"ts":1}}'
    WHEN 1 THEN '{{"common":{{"uid":"' || user_id || '","sid":"' || event_id || '"}},"ts":1}}'
    ELSE '{{"common":{{"uid":"' || event_id END,
  CASE event_id % 5 WHEN 0 THEN 'no common part' WHEN 1 THEN 'no system name' ELSE 'not json' END
FROM events WHERE event_id % 5 < 3""",
    "profile_values": f"""WITH {_LOGS}, long AS (
  SELECT uid, ts, unnest(['os', 'ch', 'md', 'ba', 'search_item']) AS field, unnest([os, ch, md, ba, search_item]) AS value FROM d)
SELECT uid, field, value, min(ts) // 120000 * 120000 AS window_start FROM long WHERE value IS NOT NULL GROUP BY 1, 2, 3""",
    "order_versions": _order_scores(orders=_VERSIONS),
    "stream_order_versions": _order_scores(orders=_VERSIONS),
    "weather_failures": f"""WITH {_CITIES}
SELECT code, province, city, CASE WHEN c_acctbal < 0 THEN 'bad status' ELSE 'no reading' END AS reason FROM res WHERE NOT ok""",
    "user_info_parse": f"""WITH {_USERS}
SELECT id, login_name, name, phone, email, strftime(birthday, '%Y-%m-%d') AS birthday, gender, ts_ms
FROM u WHERE c_acctbal >= 0""",
    "user_sup_parse": f"""WITH {_USERS}
SELECT uid, gender, height, unit_height, weight, unit_weight, ts_ms FROM s WHERE c_acctbal >= 0""",
    "order_info_project": f"""WITH {_ORDERS}
SELECT ts_ms, id, uid, consignee, create_time, original_total_amount, total_amount, province_id, pay_time_slot
FROM oi WHERE o_orderstatus <> 'P'""",
    "order_detail_project": f"""WITH {_DETAILS}
SELECT ts_ms, id, order_id, sku_id, sku_num, sku_name, order_price, split_total_amount, split_activity_amount,
       split_coupon_amount, create_time FROM od""",
    "log_parse": f"""WITH {_LOGS}
SELECT 'sid_' || event_id AS sid, raw_uid AS uid, raw_os AS os, item_type, item, ms AS ts FROM m WHERE NOT broken""",
    "log_identity": _LOG_IDENTITY,
    "device_extract": f"WITH {_LOGS} SELECT * FROM rec",
    "tombstone_filter": f"""WITH {_LOGS}, x AS (SELECT broken, {_LOG_TEXT} AS txt FROM m)
SELECT CASE WHEN broken THEN substr(txt, 1, 20) ELSE txt END AS value FROM x""",
    "tags_json": f"WITH {_USERS}, {_PAIRS}, {_TAGS} SELECT {_TAG_JSON} AS value FROM t",
    "tag_records": _TAG_RECORDS,
    "user_tags": _USER_TAGS,
    "behavior_scores": _behavior_scores(),
    "order_scores": _order_scores("WHERE oi.o_orderstatus <> 'P'"),
    "order_csv": _order_scores(),
    "city_scan": f"WITH {_CITIES} SELECT code, province, city, area FROM cty",
    "weather_normalize": _WEATHER_ROWS,
    "weather_summary": f"WITH {_CITIES} {_WEATHER_SUMMARY}",
    "weather_total": f"""WITH {_CITIES}, b AS ({_WEATHER_SUMMARY})
SELECT CAST(sum(success_count) AS BIGINT) AS success_count, CAST(sum(fail_count) AS BIGINT) AS fail_count,
       count(*) AS batches FROM b""",
    "weather_report": f"""WITH {_CITIES}, b AS ({_WEATHER_SUMMARY})
SELECT code, province, city, CASE WHEN c_acctbal < 0 THEN 'bad status' ELSE 'no reading' END AS reason, CAST(code AS BIGINT) // 500 AS batch,
       (SELECT CAST(sum(success_count) AS BIGINT) FROM b) AS success_count,
       (SELECT CAST(sum(fail_count) AS BIGINT) FROM b) AS fail_count, (SELECT count(*) FROM b) AS batches
FROM res WHERE NOT ok""",
    "weather_write": _WEATHER_ROWS,
    "stream_user_join": _USER_JOIN,
    "stream_user_tags": _USER_TAGS,
    "stream_tag_records": _TAG_RECORDS,
    "stream_log_identity": _LOG_IDENTITY,
    "stream_order_join": f"WITH {_ORDERS}, {_DETAILS} {_MERGED}",
    "stream_order_scores": _order_scores("WHERE oi.o_orderstatus <> 'P'"),
    "stream_dedup": f"WITH {_LOGS} SELECT * FROM d",
    "stream_window_last": _profile(),
    "stream_behavior_scores": _behavior_scores(),
    "stream_running_profile": _RUNNING_SETS,
    "stream_detail_monotone": _DETAIL_MONOTONE,
}
