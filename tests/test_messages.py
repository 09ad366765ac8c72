"""Parsing, routing, sources and sinks."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tagloom.operators import page_logs, parsing, weather
from tagloom.sinks import files, messages as message_sink, tables as table_sink
from tagloom.sources import messages as message_source, tables as table_source


def log(spark, *records):
    texts = [record if record is None or isinstance(record, str) else json.dumps(record, ensure_ascii=False) for record in records]
    return spark.createDataFrame([(text,) for text in texts], "value string")


def change(table, after, ts=1000):
    return {"after": after, "source": {"table": table}, "ts_ms": ts}


USER = {"id": 7, "login_name": "l", "name": "张", "phone_num": "1", "email": "e", "birthday": 10957, "gender": None}
ORDER = {"id": "5", "user_id": "7", "consignee": "c", "create_time": 43200000, "original_total_amount": "2.00",
         "total_amount": "1.00", "province_id": 3}


@pytest.fixture
def mixed(spark):
    return log(
        spark,
        change("user_info", USER),
        change("user_info", None),
        change("user_info_sup", {"uid": 7, "height": "1.8", "unit_height": "m"}),
        change("order_info", ORDER),
        change("cart_info", {"id": 1}),
        {"after": {"id": 1}, "ts_ms": 1},
        '{"after": {"id": 7, "na',
        "not json",
        None,
    )


def test_rows_of_each_table(spark, mixed):
    (user,) = parsing.user_info(mixed).collect()
    assert (user.id, user.phone, user.birthday, user.gender, user.ts_ms) == (7, "1", dt.date(2000, 1, 1), None, 1000)
    (sup,) = parsing.user_info_sup(mixed).collect()
    assert (sup.uid, sup.height, sup.weight) == (7, "1.8", None)
    (order,) = parsing.order_info(mixed).collect()
    assert (order.id, order.uid, order.pay_time_slot, order.province_id) == ("5", "7", "中午", 3)
    assert parsing.order_detail(mixed).count() == 0


def test_numbers_as_text_and_missing_numbers(spark):
    after = {"id": 11, "order_id": 5, "sku_id": "4", "order_price": "1.00"}
    (row,) = parsing.order_detail(log(spark, change("order_detail", after, None))).collect()
    assert (row.id, row.order_id, row.sku_id, row.sku_num, row.create_time, row.ts_ms) == ("11", "5", 4, 0, 0, 0)


def test_envelope_and_quarantine(spark, mixed):
    kinds = sorted((row.table, row.kind) for row in parsing.envelope(mixed).collect())
    assert kinds == [("cart_info", "row"), ("order_info", "row"), ("user_info", "delete"), ("user_info", "row"),
                     ("user_info_sup", "row")]
    bad = sorted(row.reason for row in parsing.quarantine(mixed).collect())
    assert bad == ["no table", "not json", "not json"]
    assert parsing.drop_tombstones(mixed).count() == 8


def test_every_message_is_a_row_a_delete_a_tombstone_or_in_quarantine(spark):
    messages = log(
        spark,
        change("user_info", USER),
        change("user_info", USER | {"id": "abc"}),
        change("user_info", None),
        {**change("user_info", USER), "op": "d"},
        {**change("user_info", USER), "op": "u"},
        {"source": {"table": "user_info"}, "ddl": "ALTER TABLE", "ts_ms": 1},
        {"historyRecord": "x"},
        change("user_info_sup", {"height": "1"}),
        {"after": {"id": 1}},
        "broken",
        None,
    )
    kinds = [row.kind for row in parsing.envelope(messages).collect()]
    reasons = sorted(row.reason for row in parsing.quarantine(messages).collect())
    assert sorted(kinds) == ["delete", "delete", "row", "row"]
    assert reasons == ["bad key", "bad key", "no table", "not json", "schema change", "schema change"]
    assert len(kinds) + len(reasons) + 1 == messages.count()
    assert parsing.user_info(messages).count() == 2 and parsing.user_info_sup(messages).count() == 0


def test_split_reads_and_parses_each_record_once(spark, mixed, tmp_path):
    rows = parsing.split(mixed, str(tmp_path / "split"), "user_info", "order_info")
    assert tuple(parsing.users_of(rows["user_info"]).first()) == tuple(parsing.user_info(mixed).first())
    assert tuple(parsing.orders_of(rows["order_info"]).first()) == tuple(parsing.order_info(mixed).first())
    for df in (parsing.users_of(rows["user_info"]), parsing.envelope(mixed), parsing.route(mixed, {"user_info": "u"})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") <= 1 and "get_json_object" not in plan
    none = parsing.split(mixed.limit(0), str(tmp_path / "none"), "user_info")
    assert none["user_info"].count() == 0


def test_log_quarantine_names_its_reasons(spark):
    messages = log(spark, {"common": {"uid": "1", "os": "iOS 1"}, "ts": 1}, {"common": {"uid": "1"}, "ts": 2}, {"ts": 3}, "broken", None)
    assert sorted(row.reason for row in page_logs.quarantine(messages).collect()) == ["no common part", "no system name", "not json"]
    assert page_logs.device_and_search(page_logs.page_logs(messages)).count() == 1


def test_routing_is_null_safe_and_writes_one_folder_per_topic(spark, mixed, tmp_path):
    routed = parsing.route(mixed, {"user_info": "users", "user_info_sup": "supplements"})
    assert sorted((row.topic, row.table) for row in routed.collect()) == [
        ("supplements", "user_info_sup"), ("users", "user_info"), ("users", "user_info")
    ]
    message_sink.write_routed(routed, str(tmp_path / "routed"))
    read = message_source.read_messages(spark, str(tmp_path / "routed" / "topic=users"))
    assert parsing.user_info(read).count() == 1


def test_each_record_is_parsed_once(spark, mixed):
    plan = parsing.order_info(mixed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_page_logs(spark):
    common = {"uid": "8", "mid": "m", "sid": "s", "is_new": "0", "os": "Android 13", "ch": "web", "md": "x", "ba": "y"}
    guest = {k: v for k, v in common.items() if k != "uid"}
    no_os = {k: v for k, v in common.items() if k != "os"}
    logs = page_logs.page_logs(
        log(
            spark,
            {"common": common, "page": {"item_type": "keyword", "item": "衬衫"}, "ts": 1},
            {"common": {**guest, "vc": "2", "ar": "1"}, "page": {"item_type": "sku_id", "item": "9"}, "ts": 2},
            {"common": {**common, "uid": ""}, "ts": 3},
            {"common": no_os, "ts": 4},
            {"ts": 5},
            "broken",
            None,
        )
    )
    assert logs.count() == 4
    rows = sorted(page_logs.device_and_search(logs).collect(), key=lambda r: r.ts)
    assert [(r.uid, r.ts, r.os, r.search_item, r.other_info) for r in rows] == [
        ("8", 1, "Android", "衬衫", None), ("-1", 2, "Android", None, '{"ar":"1","vc":"2"}')
    ]
    assert page_logs.device_and_search(logs, drop_guests=True).count() == 1
    assert sorted(r.ts for r in page_logs.identities(logs).collect()) == [1, 2, 3, 4]


def test_messages_leave_absent_fields_out(spark):
    rows = spark.createDataFrame([(1, None, "张")], "a int, b string, c string")
    assert parsing.as_messages(rows).first().value == '{"a":1,"c":"张"}'


def response(spark, text):
    rows = spark.createDataFrame([(1, "p", None, None, text)], "code long, province string, city string, area string, response string")
    return weather.outcomes(rows)


@pytest.mark.parametrize(
    ("text", "ok", "lives", "report_time"),
    [
        ('{"status":"1","info":"OK","lives":[{"a":"b","reporttime":"t"},{"x":1}]}', True, '{"a":"b","reporttime":"t"}', "t"),
        ('{"status":"1","lives":[{"reporttime":""}]}', True, '{"reporttime":""}', None),
        ('{"status":"1"}', True, "{}", None),
        ('{"status":"1","lives":[]}', False, None, None),
        ('{"status":"0","lives":[{}]}', False, None, None),
        ("oops", False, None, None),
        (None, False, None, None),
    ],
)
def test_weather_outcomes(spark, text, ok, lives, report_time):
    read = response(spark, text)
    assert read.first().ok is ok
    rows = weather.weather_rows(read).collect()
    assert [(r.province, r.city, r.area, r.lives, r.report_time) for r in rows] == (
        [("p", "p", "p", lives, report_time)] if ok else []
    )


def test_weather_summary_and_cities(spark):
    read = spark.createDataFrame([(1, True), (2, False), (499, False), (500, True), (1200, False)], "code long, ok boolean")
    batches = weather.batch_summary(read)
    assert sorted(tuple(r) for r in batches.collect()) == [
        (0, 1, 2, "2,499", 1, 499), (1, 1, 0, "", 500, 500), (2, 0, 1, "1200", 1200, 1200)
    ]
    assert tuple(weather.total_summary(batches).first()) == (2, 3, 3)
    codes = spark.createDataFrame([(1, "台湾省", "x"), (2, "p", None), (3, "p", "x")], "code int, province string, city string")
    assert [row.code for row in weather.cities(codes).collect()] == [3]


def test_weather_run_report(spark):
    schema = "code long, province string, city string, status string, ok boolean"
    rows = [(1, "p", "a", "1", True), (2, "p", "b", None, False), (499, "p", "c", "0", False), (1200, "q", "d", "1", False)]
    report = weather.run_report(spark.createDataFrame([*rows, (1200, "q", "d", "1", False)], schema))
    assert sorted(tuple(row) for row in report.collect()) == [
        (2, "p", "b", "no readable response", 0, 1, 4, 2), (499, "p", "c", "bad status", 0, 1, 4, 2),
        (1200, "q", "d", "no reading", 2, 1, 4, 2), (1200, "q", "d", "no reading", 2, 1, 4, 2),
    ]
    assert report.columns == ["code", "province", "city", "reason", "batch", "success_count", "fail_count", "batches"]
    for good in (rows[:1], []):
        assert weather.run_report(spark.createDataFrame(good, schema)).collect() == []


def test_options():
    source = message_source.kafka_options("h:1", "t")
    assert source["subscribe"] == "t" and source["startingOffsets"] == "earliest"
    further = {"maxOffsetsPerTrigger": "5", "kafka.security.protocol": "SASL_SSL", "kafka.group.id": "g"}
    assert further.items() <= message_source.kafka_options("h:1", "t", **further).items()
    assert message_sink.kafka_options("h:1", "t", True, **further | {"kafka.acks": "1"})["kafka.acks"] == "1"
    assert message_sink.kafka_options("h:1", durable=True) == {
        "kafka.bootstrap.servers": "h:1", "kafka.acks": "all", "kafka.enable.idempotence": "true"
    }
    assert message_sink.kafka_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
    assert table_sink.jdbc_write_options("jdbc:x", "t")["batchsize"] == "500"
    whole = table_source.jdbc_options("jdbc:x", "select 1", user="u")
    assert whole["query"] == "select 1" and "password" not in whole
    ranged = table_source.jdbc_options("jdbc:x", "select 1", partition_column="id", lower=0, upper=9, partitions=4)
    assert ranged["dbtable"] == "(select 1) q" and ranged["numPartitions"] == "4" and "query" not in ranged
    with pytest.raises(ValueError):
        table_source.jdbc_options("jdbc:x", "select 1", partition_column="id")


def test_camel_columns(spark):
    assert table_source.camel_columns(spark.range(1).select(F.lit(1).alias("tm_name"), "id")).columns == ["tmName", "id"]
    upper = spark.range(1).select(F.lit(1).alias("TM_NAME"), F.lit(1).alias("SEARCH_CATEGORY"), F.lit(1).alias("ID"))
    assert table_source.camel_columns(upper).columns == ["tmName", "searchCategory", "id"]


def test_csv_has_44_columns_in_order_and_survives_quotes(spark, tmp_path):
    assert len(files.ORDER_CSV_COLUMNS) == 44 == len(set(files.ORDER_CSV_COLUMNS))
    row = spark.createDataFrame([(1,)], "x int").select(
        *[F.lit(f'{name} "q", 中').alias(name) if i % 3 else F.lit(None).cast("string").alias(name)
          for i, name in enumerate(files.ORDER_CSV_COLUMNS)]
    )
    files.write_order_csv(row, str(tmp_path / "csv"))
    back = files.read_order_csv(spark, str(tmp_path / "csv"), row.schema)
    assert back.collect() == row.collect()


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    write = table_sink.write_each_batch(str(tmp_path / "batches"))
    for batch_id, n in ((0, 3), (1, 4), (1, 4), (0, 3)):
        write(spark.range(n), batch_id)
    rows = spark.read.parquet(str(tmp_path / "batches"))
    assert sorted(tuple(row) for row in rows.groupBy("batch_id").count().collect()) == [(0, 3), (1, 4)]


def test_every_row_is_printed(spark, capsys):
    files.print_rows("label")(spark.range(50).select("id", F.repeat(F.lit("x"), 300).alias("long")), 0)
    printed = capsys.readouterr().out.splitlines()
    assert len(printed) == 50 and all(line.startswith("label> ") and "x" * 300 in line for line in printed)


def test_failed_cities_are_listed_with_their_reason(spark):
    texts = ['{"status":"0"}', '{"status":"1","lives":[]}', "oops", '{"status":"1"}']
    rows = [(n, "p", "c", None, text) for n, text in enumerate(texts)]
    read = weather.outcomes(spark.createDataFrame(rows, "code long, province string, city string, area string, response string"))
    assert sorted((row.code, row.reason) for row in weather.failures(read).collect()) == [
        (0, "bad status"), (1, "no reading"), (2, "no readable response")
    ]


def test_table_sink_appends(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        table_sink.append_rows(spark.range(3), "parquet", path=path)
    assert spark.read.parquet(path).count() == 6
    assert os.path.isdir(path)
