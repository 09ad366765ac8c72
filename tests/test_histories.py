"""Snapshot hand-over, as-of joins, versions, records of any table, packed files, keyed tables and bounded sets."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import as_of, profiles, snapshots, variants
from tagloom.plans import adapters
from tagloom.queries import QUERIES
from tagloom.sinks import packing, upserts
from tagloom.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def record(op, key, pos, email=None, table="user_info"):
    row = {"id": key, "email": email}
    held = {"source": {"table": table, "pos": pos}, "op": op, "ts_ms": pos}
    return json.dumps(held | ({"before": row} if op == "d" else {"after": row}))


def history(seed, rows=40, chunks=4):
    """A table's changes, a snapshot of each chunk at its own position, and the state at the end."""
    rng = random.Random(seed)
    state, log, reads, pos = {}, [], [], 0
    read_at = {chunk: rng.randrange(50, 250) for chunk in range(chunks)}
    for pos in range(300):
        key = rng.randrange(rows)
        if key in state and rng.random() < 0.4:
            del state[key]
            log.append((pos, record("d", key, pos)))
        else:
            op = "u" if key in state else "c"
            state[key] = f"{key}@{pos}"
            log.append((pos, record(op, key, pos, state[key])))
        for chunk, at in read_at.items():
            if at == pos:
                reads += [record("r", k, pos, email) for k, email in state.items() if k % chunks == chunk]
    kept = [text for at, text in log if at >= min(read_at.values())]  # older ones the log has forgotten
    return kept, reads, [(c, p) for c, p in read_at.items()], state


@pytest.mark.parametrize("seed", range(4))
def test_state_from_any_arrangement_of_snapshot_and_log(spark, seed):
    log, reads, positions, state = history(seed)
    junk = ["{", None, record("c", 1, 10**6, "x", "other"), '{"source":{"table":"user_info"},"op":"u","ts_ms":5}']
    messages = (log + reads + junk) * 2
    random.Random(seed).shuffle(messages)
    frame = spark.createDataFrame([(m,) for m in messages], "value string").repartition(5)
    read = spark.createDataFrame(positions, "chunk long, position long")
    chunk = F.col("row_key").cast("long") % 4
    found = snapshots.table_state(frame, "user_info", read, chunk)
    assert {row.id: row.email for row in found.collect()} == state
    events = snapshots.handed_over(snapshots.changes(frame, "user_info"), read, chunk)
    rows = [(row.row_key, row.position) for row in events.collect()]
    assert len(rows) == len(set(rows))
    at = dict(positions)
    later = [json.loads(m) for m in log]
    expected = {(str(r.get("after", r.get("before"))["id"]), r["ts_ms"]) for r in later if r["ts_ms"] > at[r.get("after", r.get("before"))["id"] % 4]}
    assert {row for row in rows if row not in {(str(json.loads(m)["after"]["id"]), json.loads(m)["ts_ms"]) for m in reads}} == expected


def test_a_chunk_not_read_yet_lives_on_its_log(spark):
    frame = spark.createDataFrame([(record("c", 1, 5, "a"),), (record("u", 1, 6, "b"),), (record("d", 2, 7),)], "value string")
    none = spark.createDataFrame([], "chunk long, position long")
    found = snapshots.table_state(frame, "user_info", none, F.lit(0).cast("long")).collect()
    assert [(row.id, row.email) for row in found] == [(1, "b")]


@pytest.mark.parametrize("slot_ms", [1, 7, 10**6])
def test_as_of_join_against_brute_force(spark, slot_ms):
    rng = random.Random(slot_ms)
    keys = ["hot"] * 6 + ["a", "b", None]
    rows = [(n, rng.choice(keys), rng.choice([None, *range(60)])) for n in range(300)]
    rules = [(rng.choice(keys), rng.choice([None, *range(60)]), float(n), n) for n in range(80)]
    frame = spark.createDataFrame(rows, "n int, k string, ms long")
    known = spark.createDataFrame(rules, "k string, ms long, rate double, seq int")
    found = {row.n: row.rate for row in as_of.as_of_join(frame, known, "k", "ms", ["rate"], ["seq"], slot_ms).collect()}
    assert len(found) == len(rows)
    for n, key, ms in rows:
        met = [(at, seq, rate) for k, at, rate, seq in rules if key is not None and k == key and ms is not None and at is not None and at <= ms]
        assert found[n] == (max(met)[2] if met else None)


@pytest.mark.parametrize("slot_ms", [3, 10**6])
def test_versions_against_brute_force(spark, slot_ms):
    rng = random.Random(slot_ms)
    changes = [(rng.choice(["x", "y", "z", None]), rng.choice([None, *range(40)]), n, f"v{n}", rng.random() < 0.3) for n in range(120)]
    frame = spark.createDataFrame(changes, "k string, ms long, seq int, v string, gone boolean")
    found = as_of.versions(frame, "k", "ms", ["v"], ["seq"], "gone", slot_ms)
    last = {}
    for key, ms, seq, value, gone in changes:
        if key is not None and ms is not None:
            last[key, ms] = (value, gone)
    expected = set()
    for (key, ms), (value, gone) in last.items():
        later = [at for k, at in last if k == key and at > ms]
        if not gone:
            expected.add((key, value, ms, min(later) if later else None))
    assert {tuple(row) for row in found.collect()} == expected
    facts = spark.createDataFrame([(n, rng.choice(["x", "y", "w", None]), rng.choice([None, *range(-5, 50)])) for n in range(200)], "n int, k string, at long")
    for row in as_of.with_version(facts, found, "k", "at").collect():
        met = [value for k, value, a, b in expected if k == row.k and row.at is not None and a <= row.at and (b is None or row.at < b)]
        assert row.v == (met[0] if met else None)


def test_records_of_any_table(spark):
    texts = [
        '{"after":{"a":1,"b":"x","c":{"d":[1],"e":null}},"source":{"table":"t"},"ts_ms":1}',
        '{"after":{"a":2.5,"b":null,"c":{"d":[],"e":{"f":true}}},"source":{"table":"t"},"ts_ms":2}',
        '{"after":{"a":"one"},"source":{"table":"u"},"ts_ms":3}', '{"after":{},"source":{"table":"u"}}',
        '{"after":null,"source":{"table":"t"}}', '{"after":{"a":1},"source":{}}', "{", None, "[1]", "7",
    ]
    rows = variants.variant_rows(spark.createDataFrame([(text,) for text in texts], "value string"))
    types = variants.found_types(rows)
    assert {tuple(row) for row in types.collect()} == {
        ("t", "a", "BIGINT", 1), ("t", "a", "DECIMAL", 1), ("t", "b", "STRING", 1), ("t", "b", "VOID", 1), ("t", "c.d", "ARRAY", 2),
        ("t", "c.e", "VOID", 1), ("t", "c.e.f", "BOOLEAN", 1), ("u", "a", "STRING", 1),
    }
    schema = variants.schema_of(types, "t")
    assert schema == {"a": "DECIMAL(38,10)", "b": "STRING", "c.d": "STRING", "c.e": "STRING", "c.e.f": "BOOLEAN"}
    found = {row.ts_ms: (float(row.a), row.b, row.c_d, row.c_e_f) for row in variants.typed_rows(rows, "t", schema).collect()}
    assert found == {1: (1.0, "x", "[1]", None), 2: (2.5, None, "[]", True)}
    assert variants.found_types(rows.filter("false")).collect() == []


def small_files(spark, folder, n, start=0):
    lines = [f'{i},"text ""{i}""",{"x" * (i % 50)}' for i in range(start, start + n)]
    spark.createDataFrame([(line,) for line in lines], "value string").repartition(12).write.mode("append").option("compression", "none").format("text").save(folder)
    return lines


def test_packs_by_size_and_after_a_failure(spark, tmp_path, monkeypatch):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    lines = small_files(spark, folder, 600)
    monkeypatch.setattr(packing, "listed", lambda s, f, pattern="*.txt", real=packing.listed: real(s, f, "*.txt"))
    sizes = [size for _, _, size in packing.listed(spark, folder)]
    wanted = 3 * max(sizes)
    assert packing.pack_files(spark, folder, target, wanted) == 0  # nothing has been left alone for long enough

    commit = packing.commit
    monkeypatch.setattr(packing, "commit", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        packing.pack_files(spark, folder, target, wanted, idle_ms=0)
    assert packing.manifest(spark, target) == []
    monkeypatch.setattr(packing, "commit", commit)
    made = packing.pack_files(spark, folder, target, wanted, idle_ms=0)
    packs = packing.manifest(spark, target)
    assert made == len(packs) < len(sizes) and sum(row.bytes for row in packs) == sum(sizes)
    assert all(row.bytes <= wanted for row in packs) and min(row.bytes for row in packs[:-1]) > wanted - max(sizes)
    read = lambda: sorted(row.value for row in spark.read.text([row.pack for row in packing.manifest(spark, target)]).select("value").collect())
    assert read() == sorted(lines)
    for row in packs:  # in the order of the files and their lines
        whole = "".join(open(path.replace("file:", "", 1)).read() for path in row.sources)
        assert [r.value for r in spark.read.text(row.pack).select("value").coalesce(1).collect()] == whole.splitlines()
        assert len(spark.read.text(row.pack).inputFiles()) == 1
    assert packing.pack_files(spark, folder, target, wanted, idle_ms=0) == 0
    lines += small_files(spark, folder, 100, 600)
    assert packing.pack_files(spark, folder, target, wanted, idle_ms=0) > 0
    assert read() == sorted(lines)


def test_keyed_table_with_replays_and_reordered_batches(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], "k int, at int, v string").schema
    rng = random.Random(2)
    batches = [[(rng.randrange(30), rng.randrange(1000), f"{n}-{i}") for i in range(25)] for n in range(6)]
    last = {}
    for batch in batches:
        for key, at, value in batch:
            last[key] = max(last.get(key, (-1, "")), (at, value))

    def table(name):
        return upserts.KeyedTable(spark, str(tmp_path / name), schema, ["k"], ["at", "v"], 5)

    for seed in range(2):
        arranged = list(enumerate(batches))
        random.Random(seed).shuffle(arranged)
        held = table(f"t{seed}")
        assert held.read().collect() == []
        for batch_id, (_, rows) in enumerate(arranged):
            frame = spark.createDataFrame(rows, schema)
            if batch_id == 3:  # fails before the manifest is there
                monkeypatch.setattr(upserts.KeyedTable, "_commit", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
                before = sorted(map(tuple, held.read().collect()))
                with pytest.raises(RuntimeError):
                    held.merge(frame, batch_id)
                assert sorted(map(tuple, held.read().collect())) == before
                monkeypatch.undo()
            held.merge(frame, batch_id)
            held.merge(frame.withColumn("v", F.lit("replayed")), batch_id)
        found = table(f"t{seed}").read()
        assert {row.k: (row.at, row.v) for row in found.collect()} == last


def test_sketches_stay_within_their_error(spark):
    rows = [("-1" if n % 3 else f"u{n % 5}", n * 1000, f"os{n % 40}", f"ch{n % 9000}", f"md{n}", None, f"s{n % 2}") for n in range(60_000)]
    frame = spark.createDataFrame(rows, "uid string, ts long, os string, ch string, md string, ba string, search_item string")
    exact = profiles.windowed_profile(frame, 600_000, 20).select(
        "uid", "window_start", "pv", *[F.size(F.array_distinct(f"{name}_set")).cast("long").alias(f"x_{name}") for name in ("os", "ch", "md", "ba", "search_item")]
    )
    both = profiles.windowed_distinct(frame, 600_000, 20).join(exact, ["uid", "window_start", "pv"]).collect()
    assert len(both) == exact.count() > 100
    for row in both:
        assert row.n_os == row.x_os and row.n_ba == 0 and row.n_search_item == row.x_search_item
        for name in ("ch", "md"):  # five standard errors
            assert abs(row[f"n_{name}"] - row[f"x_{name}"]) <= 5 * 0.01625 * row[f"x_{name}"] + 0.5


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("stream_", "weather_", "order_csv", "state_"))])
def test_facts_are_not_dealt_anew(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "RoundRobin" not in plan


def test_a_feed_is_read_by_several_tasks(spark, tmp_path):
    feed = adapters.streamed(Tables(spark, "/root/testdata/sf0.1"), "lineitem")
    seen = feed.select(F.spark_partition_id().alias("task"), F.col("_metadata.file_path").alias("file"))
    seen.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(str(tmp_path / "o")).withColumn("batch", F.regexp_extract("file", r"/(\d+)/[^/]*$", 1))
    tasks = {row.batch: row.n for row in found.groupBy("batch").agg(F.count_distinct("task").alias("n")).collect()}
    assert len(tasks) == 3 and min(tasks.values()) > 1


def test_work_folder_goes_when_told(spark):
    from pathlib import Path

    from tagloom.session import remove_work_folder, work_folder, written

    assert written(spark.range(3), "numbers").count() == 3
    assert list(Path(work_folder(spark)).glob("numbers-*"))
    remove_work_folder(spark)
    assert not Path(work_folder(spark)).exists()


def test_paths_of_odd_names_are_those_of_the_opened_objects(spark):
    texts = ['{"a b":1,"c`d":{"":2,"x:y, z<":[{"q":1},{"r":[1,2.5]}]},"n":null,"2":1.50,"ü":true,"e":{},"d":1e300,"OBJECT":"s"}', '[1,{"a":2},[3]]', "[]", "7", "{}"]
    messages = [(f'{{"after":{text},"source":{{"table":"t"}}}}',) for text in texts]
    rows = variants.variant_rows(spark.createDataFrame(messages, "value string"))
    by_level = variants._types_by_level(rows)
    expected = by_level.groupBy("source_table", "path", "type").agg(F.sum("rows").alias("rows"))
    assert sorted(map(tuple, variants.found_types(rows).collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_types_are_found_in_one_pass(spark):
    messages = [(f'{{"after":{{"a":{{"b":{{"c":{{"d":{n}}}}}}}}},"source":{{"table":"t"}}}}',) for n in range(4)]
    rows = variants.variant_rows(spark.createDataFrame(messages, "value string"))
    types = variants.found_types(rows)
    assert [tuple(row) for row in types.collect()] == [("t", "a.b.c.d", "BIGINT", 4)]
    assert "Generate variant_explode" not in types._jdf.queryExecution().toString()


def test_a_record_is_parsed_once(spark):
    rows = variants.variant_rows(spark.createDataFrame([('{"after":{"a":1},"source":{"table":"t"},"ts_ms":2}',)], "value string"))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("parseJson(") == 1
    assert [(row.source_table, row.ts_ms) for row in rows.collect()] == [("t", 2)]


def test_rows_are_read_once_for_their_types(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    messages = spark.createDataFrame([(f'{{"after":{{"a":{n}}},"source":{{"table":"t"}}}}',) for n in range(7)], "value string")
    types = variants.found_types(variants.variant_rows(messages.mapInArrow(counted, "value string")))
    assert [tuple(row) for row in types.collect()] == [("t", "a", "BIGINT", 7)]
    assert read.value == 7


def test_gzip_files_are_packed_by_their_text(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    lines = [f"{n},{'x' * (n % 50)}" for n in range(600)]
    frame = spark.createDataFrame([(line,) for line in lines], "value string").repartition(8)
    frame.write.option("compression", "gzip").csv(folder, quote="")
    stored = packing.listed(spark, folder)
    assert len(stored) == 8 and all(path.endswith(".csv.gz") for _, path, _ in stored)
    text = {path: sum(len(row.value) + 1 for row in spark.read.text(path).collect()) for _, path, _ in stored}
    wanted = 3 * max(text.values())
    made = packing.pack_files(spark, folder, target, wanted, idle_ms=0)
    packs = packing.manifest(spark, target)
    assert 1 < made == len(packs) < 8 and sum(row.bytes for row in packs) == sum(text.values())
    assert all(row.bytes == sum(text[path] for path in row.sources) <= wanted for row in packs)
    for row in packs:
        whole = [r.value for path in row.sources for r in spark.read.text(path).collect()]
        assert [r.value for r in spark.read.text(row.pack).select("value").collect()] == whole
        assert [path.endswith(".gz") for path in spark.read.text(row.pack).inputFiles()] == [True]
    assert packing.pack_files(spark, folder, target, wanted, idle_ms=0) == 0


@pytest.mark.parametrize("name", ["order_csv", "order_csv_packed"])
def test_order_files_are_packed_text(spark, name):
    found = QUERIES[name](spark, FOLDER).inputFiles()
    assert found and all(path.endswith(".gz") for path in found)
