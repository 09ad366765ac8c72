"""Streams against their batch forms, and what only streams do."""

import datetime as dt
import json
import os
import random
import time
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tagloom.operators import interval_join, page_logs, parsing, profiles, repeats
from tagloom.sinks import files, messages as message_sink
from tagloom.sources.messages import read_messages, replayed
from tagloom.streaming import flows

MINUTE = 60 * 1000


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


class Inbox:
    """A folder that a file stream reads one file per micro-batch from, in the order they were put in."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, folder, schema
        folder.mkdir()

    def put(self, rows):
        part = self.spark.createDataFrame(rows, self.schema).toPandas()
        part.to_json(self.folder / f"{time.time_ns()}.json", orient="records", lines=True, force_ascii=False)
        time.sleep(0.02)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(str(self.folder))

    def batch(self):
        return self.spark.read.schema(self.schema).json(str(self.folder))


def run(df, path, close_windows=True):
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(close_windows).lower())
    flows.start_files(df, path.name, str(path / "rows"), str(path / "checkpoint"), availableNow=True).awaitTermination()
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    return spark.read.schema(df.schema).parquet(str(path / "rows"))


RECORDS = "uid string, ts long, os string, ch string, md string, ba string, search_item string, other_info string"


def records(n, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["-1", "-1", "a", "b", "c"]), rng.randrange(0, 30 * MINUTE), rng.choice(["iOS", "Android"]),
         rng.choice(["web", "app"]), "m", "b", rng.choice([None, "x", "y"]), None)
        for _ in range(n)
    ]
    return sorted(rows, key=lambda row: row[1])


def test_join_in_several_files_equals_batch(spark, tmp_path):
    users = Inbox(spark, tmp_path / "users", "id long, ts_ms long")
    sups = Inbox(spark, tmp_path / "sups", "uid long, ts_ms long")
    rng = random.Random(1)
    for start in range(0, 120, 30):
        users.put([(rng.randrange(8), (start + 1 + rng.randrange(30)) * MINUTE) for _ in range(25)])
        sups.put([(rng.randrange(8), (start + 1 + rng.randrange(30)) * MINUTE) for _ in range(25)])
    # Everything arrives before the watermark has moved past its partners' interval.
    streamed = run(flows.users_with_supplements(users.stream(), sups.stream()), tmp_path / "out")
    pairs = interval_join.users_with_supplements(users.batch(), sups.batch()).select(*streamed.columns)
    assert set(tuples(streamed)) <= set(tuples(pairs))
    in_time = interval_join.users_with_supplements(users.batch(), sups.batch()).count()
    assert streamed.count() == in_time


def test_join_ends_are_inclusive(spark, tmp_path):
    users = Inbox(spark, tmp_path / "users", "id long, ts_ms long")
    sups = Inbox(spark, tmp_path / "sups", "uid long, ts_ms long")
    users.put([(1, 100 * MINUTE)])
    offsets = (-30 * MINUTE - 1, -30 * MINUTE, 30 * MINUTE, 30 * MINUTE + 1)
    sups.put([(1, 100 * MINUTE + offset) for offset in offsets])
    streamed = run(flows.users_with_supplements(users.stream(), sups.stream()), tmp_path / "out")
    assert [row.s_ts_ms - 100 * MINUTE for row in streamed.orderBy("s_ts_ms").collect()] == list(offsets[1:3])


def test_dedup_and_late_rows(spark, tmp_path):
    inbox = Inbox(spark, tmp_path / "in", RECORDS)
    early, middle, end = ("a", 1000, "iOS", "w", "m", "b", None, None), ("a", 60000, "iOS", "w", "m", "b", "x", None), (
        "a", 10 * MINUTE, "iOS", "w", "m", "b", None, None)
    late = ("a", 2000, "Android", "w", "m", "b", None, None)
    inbox.put([early, middle, middle])
    inbox.put([early, end])
    inbox.put([end])
    inbox.put([late, early])
    out = run(flows.without_repeats(inbox.stream()).drop("event_time"), tmp_path / "out")
    assert tuples(out) == sorted([early, middle, end], key=repr)


def test_windowed_profile_equals_batch_over_closed_windows(spark, tmp_path):
    rows = records(400, seed=2)
    inbox = Inbox(spark, tmp_path / "in", RECORDS)
    for i in range(0, 400, 100):
        part = rows[i : i + 100]
        random.Random(i).shuffle(part)
        inbox.put(part + part[:10])
    streamed = run(flows.windowed_profile(inbox.stream()), tmp_path / "out")
    sets = [profiles.joined(F.col(f"{name}_set")).alias(name) for name in page_logs.PROFILE_FIELDS]
    expected = profiles.windowed_profile(repeats.without_repeats(inbox.batch())).filter(
        F.col("window_start") + 2 * MINUTE <= rows[-1][1] - 3000
    )
    columns = ["uid", "window_start", "pv", *sets]
    assert expected.count() > 20
    assert tuples(streamed.select(*columns)) == tuples(expected.select(*columns))


def test_arrival_windows_take_the_last_row_of_each_batch(spark, tmp_path):
    inbox = Inbox(spark, tmp_path / "in", "uid string, ts long, pv long")
    batches = [[("a", 9, 1), ("a", 1, 2), ("b", 5, 1)], [("a", 3, 3)], [("a", 2, 4), ("b", 0, 2)]]
    for batch in batches:
        inbox.put(batch)
    out = run(flows.last_in_arrival_window(inbox.stream(), ["pv"], width_ms=1), tmp_path / "out")
    assert tuples(out.select("uid", "ts", "pv")) == [("a", 1, 2), ("a", 3, 3), ("b", 5, 1)]
    assert out.select("window_start").distinct().count() == 2


def test_running_profile_equals_batch(spark, tmp_path):
    rows = records(150, seed=4)
    inbox = Inbox(spark, tmp_path / "in", RECORDS)
    for i in range(0, 150, 50):
        inbox.put(rows[i : i + 50])
    streamed = run(flows.running_profile(inbox.stream()), tmp_path / "out")
    sets = [profiles.joined(F.col(f"{name}_set")).alias(name) for name in page_logs.PROFILE_FIELDS]
    expected = profiles.running_profile(repeats.without_repeats(inbox.batch()))
    columns = ["uid", "ts", "pv", *sets]
    assert tuples(streamed.select(*columns)) == tuples(expected.select(*columns))


@pytest.mark.parametrize(("ttl_ms", "kept"), [(3_600_000, [5, 6]), (1, [5, 5, 6])])
def test_rising_only_forgets_after_its_time(spark, tmp_path, ttl_ms, kept):
    inbox = Inbox(spark, tmp_path / "in", "k string, v long")
    for value in (5, 5, 6, 4):
        inbox.put([("a", value)])
    out = run(flows.rising_only(inbox.stream(), "k", "v", ["v"], ttl_ms), tmp_path / "out", close_windows=False)
    got = sorted(row.v for row in out.collect())
    assert got == kept if ttl_ms > 1 else got == [4, 5, 5, 6]


def test_restart_goes_on_without_repeats(spark, tmp_path):
    rows = records(60, seed=9)
    inbox = Inbox(spark, tmp_path / "in", RECORDS)
    inbox.put(rows[:30])
    first = run(flows.without_repeats(inbox.stream()).drop("event_time"), tmp_path / "out", close_windows=False)
    assert first.count() == len(set(rows[:30]))
    inbox.put(rows[25:])
    again = run(flows.without_repeats(inbox.stream()).drop("event_time"), tmp_path / "out", close_windows=False)
    assert tuples(again) == sorted(set(rows), key=repr)


def test_messages_to_tags_to_files(spark, tmp_path):
    user = {"after": {"id": 1, "name": "n", "birthday": 10957, "gender": None}, "source": {"table": "user_info"}, "ts_ms": 2}
    sup = {"after": {"uid": 1, "gender": "F", "height": "70", "unit_height": "in"}, "source": {"table": "user_info_sup"}, "ts_ms": 5}
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "1.txt").write_text("\n".join([json.dumps(user), json.dumps(sup), "broken"]), encoding="utf-8")
    log = read_messages(spark, str(tmp_path / "log"), streaming=True)
    tagged = flows.user_tags(parsing.user_info(log), parsing.user_info_sup(log), dt.date(2024, 1, 1))
    (row,) = run(tagged, tmp_path / "out").collect()
    assert (row.user_id, row.age, row.age_group, row.gender, row.height_cm, row.weight_kg) == ("1", "24", "18-24", "F", "177.8", None)
    routed = parsing.route(log, {"user_info": "users", "user_info_sup": "supplements"})
    message_sink.stream_routed(
        routed, "routed", str(tmp_path / "routed"), str(tmp_path / "routed-checkpoint"), availableNow=True
    ).awaitTermination()
    assert sorted((row.topic, json.loads(row.value)["ts_ms"]) for row in spark.read.text(str(tmp_path / "routed")).collect()) == [
        ("supplements", 5), ("users", 2)
    ]


def test_csv_stream(spark, tmp_path):
    one = spark.range(3).select(*[F.col("id").cast("string").alias(name) for name in files.ORDER_CSV_COLUMNS])
    one.write.parquet(str(tmp_path / "in.parquet"))
    rows = replayed(spark.read.parquet(str(tmp_path / "in.parquet")), "CAST(uid AS bigint)", str(tmp_path / "feed"))
    files.stream_order_csv(
        rows, "csv", str(tmp_path / "csv"), str(tmp_path / "checkpoint"), availableNow=True
    ).awaitTermination()
    back = files.read_order_csv(spark, str(tmp_path / "csv"), one.schema)
    assert tuples(back) == tuples(one)


def buckets_of(spark, path):
    """How many values the keyed state holds after a stream's last batch."""
    with flows.settings(spark, {"spark.sql.streaming.stateStore.providerClass": flows.ROCKSDB}):
        reader = spark.read.format("statestore").option("stateVarName", "last")
        return reader.load(str(path / "checkpoint")).count()


def rising_rows(seed, n=400):
    rng = random.Random(seed)
    return [(rng.choice([None, "", *map(str, range(60))]), rng.randrange(30), at * MINUTE) for at in range(n)]


def test_rising_only_holds_many_keys_in_few_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(flows.processors, "BUCKETS", 4)
    rows = rising_rows(1)
    inbox = Inbox(spark, tmp_path / "in", "k string, v long, at long")
    for i in range(0, 400, 100):
        inbox.put(rows[i : i + 100])
    out = run(flows.rising_only(inbox.stream(), "k", "v", ["at"]), tmp_path / "out", close_windows=False)
    last, kept = {}, []
    for row in rows:
        if row[0] not in last or row[1] > last[row[0]]:
            last[row[0]] = row[1]
            kept.append(row)
    assert tuples(out) == sorted(kept, key=repr)
    assert buckets_of(spark, tmp_path / "out") <= 4


def test_rising_on_arrival_holds_many_keys_in_few_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(flows.processors, "BUCKETS", 4)
    rows, ttl = rising_rows(2), 90 * MINUTE
    inbox = Inbox(spark, tmp_path / "in", "k string, v long, at long")
    for i in range(0, 400, 100):
        inbox.put(rows[i : i + 100])
    out = run(flows.rising_on_arrival(inbox.stream(), "k", "v", ["at"], "at", ttl), tmp_path / "out")
    last, kept = {}, []
    for key, value, at in rows[1:]:  # the first has time 0, which is late
        if key not in last or value > last[key][0] or at - last[key][1] > ttl:
            last[key] = (value, at)
            kept.append((key, value, at))
    assert tuples(out) == sorted(kept, key=repr)
    held = flows.stored_entries(spark, str(tmp_path / "out" / "checkpoint"), "last", "k string, value bigint, passed_ms bigint")
    held = {row.k: (row.value, row.passed_ms) for row in held.collect()}
    end = rows[-1][2]
    assert held.items() <= last.items()  # what is too old to be met may be gone
    assert {key for key, (_, at) in last.items() if at + ttl >= end} <= set(held)
    assert buckets_of(spark, tmp_path / "out") <= 4


def test_rates_wait_in_buckets_with_one_timer(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(flows.processors, "BUCKETS", 2)
    rng = random.Random(3)
    log = []
    for at in range(1, 301):
        name = f"P{rng.randrange(20)}"
        log.append((f"{name}:0.{rng.randrange(1, 10)}", at * 60_000, float(at)) if at % 3 == 0 else (f"{name},n,{at}.0", at * 60_000, None))
    inbox = Inbox(spark, tmp_path / "in", "value string, ts_ms long, seq double")
    for i in range(0, 300, 100):
        part = log[i : i + 100]
        random.Random(i).shuffle(part)
        inbox.put(part)
    out = run(flows.prices_as_of(inbox.stream()), tmp_path / "out")
    rates, expected = {}, []
    for value, ts, seq in log:
        if seq is not None:
            name, rate = value.split(":")
            rates[name] = float(rate)
        elif ts < log[-1][1] - 3000:
            name, _, price = value.split(",")
            rate = rates.get(name, 1.0)
            expected.append((name, f"{float(price):.2f}", f"{rate:.2f}", ts))
    assert tuples(out.select("id", "price", "rate", "ts_ms")) == sorted(expected, key=repr)
    with flows.settings(spark, {"spark.sql.streaming.stateStore.providerClass": flows.ROCKSDB}):
        held = spark.read.format("statestore").option("stateVarName", "held").load(str(tmp_path / "out" / "checkpoint"))
        assert held.count() <= 2


@pytest.mark.parametrize("form", ["running", "windowed", "resumed"])
def test_profiles_of_many_users_are_held_in_few_buckets(spark, tmp_path, monkeypatch, form):
    monkeypatch.setattr(flows.processors, "BUCKETS", 3)
    rows = [(None if row[0] == "c" else f"{row[0]}{row[1] % 7}", *row[1:]) for row in records(240, seed=6)]
    old, new = (rows[:80], rows[80:]) if form == "resumed" else ([], rows)
    inbox = Inbox(spark, tmp_path / "in", RECORDS)
    for i in range(0, len(new), 80):
        inbox.put(new[i : i + 80])
    history = spark.createDataFrame(old, RECORDS).distinct()
    if form == "windowed":
        streamed = run(flows.windowed_profile(inbox.stream()), tmp_path / "out")
    else:
        known = profiles.last_profile(history) if old else None
        streamed = run(flows.running_profile(inbox.stream(), history=known), tmp_path / "out")
    seen = repeats.without_repeats(spark.createDataFrame(rows, RECORDS))
    if form == "windowed":
        expected = profiles.windowed_profile(seen).filter(F.col("window_start") + 2 * MINUTE <= rows[-1][1] - 3000)
    else:
        expected = profiles.running_profile(seen).filter(F.col("ts") > (old[-1][1] if old else -1))
    sets = [profiles.joined(F.col(f"{name}_set")).alias(name) for name in page_logs.PROFILE_FIELDS]
    columns = ["uid", "window_start" if form == "windowed" else "ts", "pv", *sets]
    assert tuples(streamed.select(*columns)) == tuples(expected.select(*columns))
    with flows.settings(spark, {"spark.sql.streaming.stateStore.providerClass": flows.ROCKSDB}):
        held = spark.read.format("statestore").option("stateVarName", "held").option("operatorId", 0)
        assert held.load(str(tmp_path / "out" / "checkpoint")).count() <= 3


class HeldValue:
    """A state variable of one bucket."""

    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Timers:
    def getCurrentProcessingTimeInMs(self):
        return 1000

    def getCurrentWatermarkInMs(self):
        return 0

    def getValueState(self, *_):
        return HeldValue()

    def registerTimer(self, _):
        pass


@pytest.mark.parametrize("form", ["only", "on arrival"])
def test_rising_filters_take_whole_frames(form):
    """Cells are read column by column; numbers that tell rows apart come as text and are compared as numbers."""
    kinds = {"at": int, "a": int, "b": float, "c": int}
    order = ["at", "a", "b", "c"]
    if form == "only":
        filtered = flows.processors.RisingOnly("k", "v", order, kinds, 10**9)
    else:
        filtered = flows.processors.RisingOnArrival("k", "v", order, kinds, "at", 10**9)
    filtered.init(Timers())
    rows = [
        ("x", 5, "9", "1", "1.0", "10", "p"), ("x", 7, "10", None, "1.0", "10", "q"), (None, 1, "3", "1", None, "2", "r"),
        ("x", 5, "9", "1", "1.0", "9", "s"), (None, 1, "3", "1", None, "10", "t"), ("y", 2, "1", "1", "1.0", "1", None),
        ("x", 6, "10", "1", "1.0", "1", "u"),
    ]
    frames = lambda rows: iter([pd.DataFrame(rows[i : i + 3], columns=["k", "v", *order, "text"]) for i in range(0, len(rows), 3)])
    out = pd.concat(list(filtered.handleInputRows((0,), frames(rows), Timers())))
    # NULLs come first, 9 before 10; what repeats a value or is lower falls away.
    assert sorted(map(str, out["text"])) == ["None", "q", "r", "s"]
    again = [("x", 7, "11", "1", "1.0", "1", "v"), ("x", 8, "12", "1", "1.0", "1", "w"), ("z", 0, "1", "1", "1.0", "1", "z")]
    out = pd.concat(list(filtered.handleInputRows((0,), frames(again), Timers())))
    assert sorted(out["text"]) == ["w", "z"]


def test_rising_only_keeps_large_numbers_beside_nulls(spark, tmp_path):
    inbox = spark.createDataFrame(
        [("a", 1, 2**60 + 1, None, 0.1), ("b", None, None, 3, float("nan")), (None, 2, -(2**62) - 1, 4, None)],
        "k string, v long, `_big` long, small int, `x y` double",
    )
    inbox.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(inbox.schema).parquet(str(tmp_path / "in"))
    kept = flows.rising_only(stream, "k", "v", ["_big", "small", "x y"])
    assert kept.schema.simpleString() == inbox.schema.simpleString()
    out = run(kept, tmp_path / "out", close_windows=False)
    expected = [("a", 1, 2**60 + 1, None, 0.1), ("b", 0, None, 3, float("nan")), (None, 2, -(2**62) - 1, 4, None)]
    assert list(map(repr, tuples(out))) == sorted(map(repr, expected))


def test_state_stores_do_not_count_their_rows(spark, monkeypatch):
    """Counting reads every key again before it is written."""
    name, seen = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", []

    class Ended:
        def awaitTermination(self):
            pass

    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    monkeypatch.setattr(flows, "start_files", lambda rows, *_, **__: seen.append(spark.conf.get(name)) or Ended())
    flows.checkpoint_of(spark.range(1), "uncounted")
    assert seen == ["false"]
    assert spark.conf.get(name) == "true"
    spark.conf.set(name, before or "false")


def test_state_stores_are_as_many_as_tasks_need(spark, monkeypatch):
    """A store costs the same in every micro-batch, however few rows it has."""
    name, seen = "spark.sql.shuffle.partitions", []

    class Ended:
        def awaitTermination(self):
            pass

    before = spark.conf.get(name)
    monkeypatch.setattr(flows, "start_files", lambda rows, *_, **__: seen.append(int(spark.conf.get(name))) or Ended())
    for asked in ("1000", "3"):
        spark.conf.set(name, asked)
        flows.checkpoint_of(spark.range(1), "few-stores")
        assert spark.conf.get(name) == asked
    spark.conf.set(name, before)
    assert seen == [max(4, 2 * spark.sparkContext.defaultParallelism), 3]


def test_windowed_profiles_take_whole_frames():
    """Windows come as frames and go as frames, in the order of time; a NULL user is a user."""
    grown = flows.processors.WindowedProfile()
    grown.init(Timers())
    names = ["uid", "window_start", "views", *[f"{name}_set" for name in page_logs.PROFILE_FIELDS]]
    frames = lambda *rows: iter([pd.DataFrame([row], columns=names) for row in rows])
    shown = lambda out: [(None if row[0] != row[0] else row[0], *row[1:3], *map(list, row[3:])) for row in out.itertuples(index=False)]
    first = [("a", 20, 2, ["x"], [], ["m"], [], ["q", "p"]), (None, 10, 1, ["y"], [], [], [], []), ("a", 10, 3, ["w"], [], ["m"], [], [])]
    out = pd.concat(list(grown.handleInputRows((0,), frames(*first), Timers())))
    assert sorted(map(repr, shown(out))) == sorted(map(repr, [
        ("a", 10, 3, ["w"], [], ["m"], [], []), (None, 10, 1, ["y"], [], [], [], []), ("a", 20, 5, ["w", "x"], [], ["m"], [], ["p", "q"])
    ]))
    again = [("a", 30, 1, ["x"], ["c"], [], [], ["o"]), (None, 30, 1, [], [], [], [], [])]
    out = pd.concat(list(grown.handleInputRows((0,), frames(*again), Timers())))
    assert sorted(map(repr, shown(out))) == sorted(map(repr, [
        ("a", 30, 6, ["w", "x"], ["c"], ["m"], [], ["o", "p", "q"]), (None, 30, 2, ["y"], [], [], [], [])
    ]))
    assert list(grown.handleInputRows((0,), iter(()), Timers())) == []


def test_running_profiles_sort_by_all_columns_only_where_times_repeat(monkeypatch):
    names, sorted_by = ["uid", "ts", *page_logs.PROFILE_FIELDS, "other_info"], []
    plain = pd.DataFrame.sort_values
    monkeypatch.setattr(pd.DataFrame, "sort_values", lambda self, by, **how: sorted_by.append(len(by)) or plain(self, by, **how))
    apart = [("a", 20, "x", None, "m", "b", None, None), ("b", 10, "y", "c", "m", "b", "q", "o"), (None, 10, "w", None, "m", "b", None, None)]
    tied = [("a", 30, "z", "c", "m", "b", None, "p"), ("a", 30, "z", None, "m", "b", "s", "p"), (None, 31, "v", "c", "m", "b", "s", None)]
    grown = flows.processors.RunningProfile()
    grown.init(Timers())
    frame = lambda rows: iter([pd.DataFrame(rows, columns=names)])
    shown = lambda out: [(None if row[0] != row[0] else row[0], *row[1:3], *map(list, row[3:])) for row in out.itertuples(index=False)]
    out = shown(pd.concat(list(grown.handleInputRows((0,), frame(apart), Timers()))))
    assert sorted(map(repr, out)) == sorted(map(repr, [
        ("b", 10, 1, ["y"], ["c"], ["m"], ["b"], ["q"]), (None, 10, 1, ["w"], [], ["m"], ["b"], []), ("a", 20, 1, ["x"], [], ["m"], ["b"], [])
    ]))
    out = shown(pd.concat(list(grown.handleInputRows((0,), frame(tied), Timers()))))
    assert sorted(map(repr, out)) == sorted(map(repr, [
        ("a", 30, 2, ["x", "z"], [], ["m"], ["b"], ["s"]), ("a", 30, 3, ["x", "z"], ["c"], ["m"], ["b"], ["s"]),
        (None, 31, 2, ["v", "w"], ["c"], ["m"], ["b"], ["s"]),
    ]))
    assert sorted_by == [1, len(names) - 1]


def test_running_profiles_carry_a_user_once_a_day(spark, monkeypatch):
    """What earlier slots add up to is joined for each slot of a user, so there are fewer of them than records."""
    from tagloom.operators import prefix_scan

    carried, plain = [], prefix_scan.values_before
    monkeypatch.setattr(prefix_scan, "values_before", lambda slots, *rest: carried.append(slots) or plain(slots, *rest))
    rows = [(uid, at * 60 * MINUTE, "iOS", "w", "m", f"b{at}", None, None) for uid in ("a", "b") for at in range(48)]
    out = profiles.running_profile(spark.createDataFrame(rows, RECORDS))
    got = {(row.uid, row.ts): (row.pv, sorted(row.ba_set)) for row in out.collect()}
    assert got == {(row[0], row[1]): (at + 1, sorted(f"b{n}" for n in range(at + 1))) for row in rows for at in [row[1] // (60 * MINUTE)]}
    assert carried[0].count() == 4


def shuffle_files(spark):
    local = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f"{top}/{name}" for root in local for top, _, names in os.walk(root) for name in names if name.startswith("shuffle_")}


def test_a_drained_stream_leaves_no_shuffle_files(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id % 50 AS k", "id AS at", "uuid() AS v")
    first = shuffle_files(spark)
    feed = replayed(rows, "at", str(tmp_path / "feed"))
    before = shuffle_files(spark)
    assert sum(os.path.getsize(path) for path in before - first) < 3000  # what finds the first and the last time
    counts = flows.with_event_time(feed, "at", "1 second").groupBy("k", F.window("event_time", "1 second")).count()
    found = flows.drained(counts.select("k", "count"), "counts")
    assert shuffle_files(spark) <= before
    assert found.agg(F.sum("count")).first()[0] > 0


def test_a_drained_join_keeps_what_a_restart_needs(spark, tmp_path):
    """Rows behind the watermark do not stay in the versions of the state that are kept."""
    hour = 60 * 60 * 1000
    orders = spark.range(3000).selectExpr(f"id * {hour} AS ts_ms", "CAST(id AS string) AS id", "sha2(CAST(id AS string), 512) AS consignee")
    details = orders.selectExpr("ts_ms AS d_ts_ms", "id AS d_id")
    left, right = (replayed(rows, ms, str(tmp_path / ms)) for rows, ms in ((orders, "ts_ms"), (details, "d_ts_ms")))
    joined = flows._joined(left, right, "id", "d_id", "ts_ms", "d_ts_ms", 60_000, "3 seconds")
    checkpoint = Path(flows.checkpoint_of(joined, "joined").replace("file:", "", 1))
    held = [path.stat().st_size for path in checkpoint.rglob("left-keyWithIndexToValue/SSTs/*.sst")]
    assert 0 < sum(held) < 3000 * 128
