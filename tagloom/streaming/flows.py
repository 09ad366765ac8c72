"""Streaming forms of the joins, the deduplication and the profiles.

The parsing, scoring and tagging functions are the same ones the batch plans
use; only what needs a watermark or keyed state is here. Rows behind the
watermark are dropped.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tagloom.functions import textrows
from tagloom.operators import page_logs, parsing
from tagloom.operators.dimensions import rated_columns
from tagloom.operators.interval_join import ORDER_BOUND_MS, USER_BOUND_MS, merged_order, prefixed
from tagloom.operators.page_logs import PROFILE_FIELDS
from tagloom.operators.parsing import with_key
from tagloom.operators.profiles import WINDOW_MS
from tagloom.plans.behavior_scores import score_profiles
from tagloom.plans.order_scores import ARRIVAL, pair_arrival, score_orders
from tagloom.plans.user_tags import tag_rows
from tagloom.session import ROCKSDB, STEP, UNCOUNTED, new_folder, settings, ship, written
from tagloom.streaming import processors

# How far event time may run behind, for typed user and log rows and for raw records.
TYPED_DELAY = "20 seconds"
RAW_DELAY = "3 seconds"


def with_event_time(rows: DataFrame, ms: str, delay: str, name: str = "event_time") -> DataFrame:
    """Watermarked event time from epoch milliseconds.

    A missing time counts as 0, which is never ahead of the watermark: such a row is late.
    """
    return rows.withColumn(name, F.timestamp_millis(F.coalesce(ms, F.lit(0).cast("long")))).withWatermark(name, delay)


def _joined(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ms: str, right_ms: str, bound_ms: int, delay: str
) -> DataFrame:
    lefts = with_event_time(left, left_ms, delay, "_left_time")
    rights = with_event_time(right, right_ms, delay, "_right_time")
    bound = F.expr(f"INTERVAL {bound_ms // 1000} SECONDS")
    return lefts.join(
        rights,
        (F.col(left_key) == F.col(right_key))
        & (F.col("_right_time") >= F.col("_left_time") - bound)
        & (F.col("_right_time") <= F.col("_left_time") + bound),
        "inner",
    ).drop("_left_time", "_right_time")


def users_with_supplements(users: DataFrame, supplements: DataFrame) -> DataFrame:
    return _joined(users, prefixed(supplements, "s_"), "id", "s_uid", "ts_ms", "s_ts_ms", USER_BOUND_MS, TYPED_DELAY)


def orders_with_details(orders: DataFrame, details: DataFrame) -> DataFrame:
    pairs = _joined(
        with_key(orders, "id"),
        prefixed(with_key(details, "order_id"), "d_"),
        "id",
        "d_order_id",
        "ts_ms",
        "d_ts_ms",
        ORDER_BOUND_MS,
        RAW_DELAY,
    )
    return merged_order(pairs)


def without_repeats(records: DataFrame, delay: str = RAW_DELAY) -> DataFrame:
    """One of each full record. Copies share their event time, so a record is forgotten once the watermark passes it."""
    return with_event_time(records, "ts", delay).dropDuplicates()


def windowed_profile(records: DataFrame, width_ms: int = WINDOW_MS, delay: str = RAW_DELAY) -> DataFrame:
    """Profile as of the end of each closed window, from raw records (repeats are removed first)."""
    ship(processors)
    windows = (
        without_repeats(records, delay)
        .groupBy("uid", F.window("event_time", f"{width_ms} milliseconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("views"), *[F.collect_set(name).alias(f"{name}_set") for name in PROFILE_FIELDS])
        .select(
            "uid",
            F.unix_millis("w.start").alias("window_start"),
            "views",
            *[f"{name}_set" for name in PROFILE_FIELDS],
        )
    )
    return bucketed(windows, "uid").transformWithStateInPandas(
        processors.WindowedProfile(), processors.WINDOWED_PROFILE, "Append", "None"
    )


def last_in_arrival_window(
    rows: DataFrame, order: list[str], width_ms: int = WINDOW_MS, arrived_ms: str | None = None
) -> DataFrame:
    """The last row per user and tumbling window of the time rows arrive, whatever time they carry.

    ``arrived_ms`` is the column that says when a row arrived (at the broker, say); without one it is when the batch
    is read. Combines before the shuffle. A window is written once a row has arrived after its end.
    """
    payload = [name for name in rows.columns if name != "uid"]
    arrived = F.current_timestamp() if arrived_ms is None else F.timestamp_millis(arrived_ms)
    return (
        rows.withColumn("_arrived", arrived)
        .withWatermark("_arrived", "0 seconds")
        .groupBy("uid", F.window("_arrived", f"{width_ms} milliseconds").alias("_window"))
        .agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_last"))
        .select("uid", F.unix_millis("_window.start").alias("window_start"), "_last.*")
    )


def running_profile(records: DataFrame, delay: str = RAW_DELAY, history: DataFrame | None = None) -> DataFrame:
    """One profile row per record; repeats are removed first.

    ``history`` has the profile that each user starts from (``profiles.last_profile``): a stream that is begun anew goes
    on from what a batch over the older log has found.

    A micro-batch of one bucket of users is sorted in memory, so bound the batch
    (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) and leave guests out of
    this form; ``windowed_profile`` has no such limit.
    """
    ship(processors)
    kept = without_repeats(records, delay).drop("event_time")
    return bucketed(kept, "uid").transformWithStateInPandas(
        processors.RunningProfile(), processors.RUNNING_PROFILE, "Append", "None",
        None if history is None else bucketed(history, "uid"),
    )


def bucketed(rows: DataFrame, key: str) -> GroupedData:
    """Rows by the bucket of their key: what keyed state is held by where keys are many and small."""
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(processors.BUCKETS))).groupBy("_bucket")


# What the text of a number stands for in Python.
_NUMBERS = {
    "tinyint": int, "smallint": int, "int": int, "bigint": int, "float": float, "double": float,
}


def _places(rows: DataFrame) -> dict[str, str]:
    """Names for columns that pandas frames of keyed state keep: it renames those that begin with an underscore, say."""
    return {name: f"c{n}" for n, name in enumerate(rows.columns)}


def _text_columns(rows: DataFrame, value: str) -> list[Column]:
    """Numbers but for ``value`` as text: pandas would hold a column of them that has NULLs as double precision."""
    places = _places(rows)
    return [
        (F.col(name).cast("string") if kind in _NUMBERS and name != value else F.col(name)).alias(places[name])
        for name, kind in rows.dtypes
    ]


def _kinds(rows: DataFrame) -> dict[str, type]:
    places = _places(rows)
    return {places[name]: _NUMBERS[kind] for name, kind in rows.dtypes if kind in _NUMBERS}


def _typed(rows: DataFrame) -> list[Column]:
    places = _places(rows)
    return [
        (F.col(places[name]).cast(kind) if kind in _NUMBERS else F.col(places[name])).alias(name) for name, kind in rows.dtypes
    ]


def rising_only(
    rows: DataFrame, key: str, value: str, order: list[str], ttl_ms: int = processors.LAST_VALUE_TTL_MS
) -> DataFrame:
    """Rows whose value exceeds the last one passed for the key within the time to live; a NULL value counts as 0."""
    ship(processors)
    known = rows.withColumn(value, F.coalesce(value, F.lit(0).cast("long")))
    texts, at = known.select(*_text_columns(known, value)), _places(known)
    kept = bucketed(texts, at[key]).transformWithStateInPandas(
        processors.RisingOnly(at[key], at[value], [at[name] for name in order], _kinds(known), ttl_ms, key),
        texts.schema, "Append", "ProcessingTime",
    )
    return kept.select(*_typed(known))


def prices_as_of(log: DataFrame, delay: str = RAW_DELAY) -> DataFrame:
    """Order lines at the rate that held at their own time, from one log of orders and rules (``value``, ``ts_ms``, ``seq``).

    A row with ``seq`` is a rule ``id:rate``, one without an order ``id,name,price``. An order is written once the
    watermark has passed its time; one that comes later than that is dropped, and a rule too. Only orders that wait, and
    rules they can meet, are kept for a product.
    """
    ship(processors)
    rule = F.col("seq").isNotNull()
    item, rate = textrows.priced_item(F.col("value")), textrows.rate_rule(F.col("value"))
    rows = log.select(
        F.when(rule, rate[0]).otherwise(item[0]).alias("id"), item[1].alias("name"), item[2].alias("price"),
        F.when(rule, rate[1]).alias("rate"), "seq", "ts_ms",
    )
    priced = bucketed(with_event_time(rows, "ts_ms", delay), "id").transformWithState(
        processors.PricedOrders(), processors.PRICED_ORDERS, "Append", "EventTime"
    )
    return priced.select(*rated_columns(), "ts_ms")


def rising_on_arrival(
    rows: DataFrame, key: str, value: str, order: list[str], arrived_ms: str, ttl_ms: int = processors.LAST_VALUE_TTL_MS
) -> DataFrame:
    """``rising_only`` whose time to live runs by the rows' arrival time, so that a replay forgets what the first run did."""
    ship(processors)
    known = rows.withColumn(value, F.coalesce(value, F.lit(0).cast("long")))
    texts, at = _text_columns(known, value), _places(known)
    timed = with_event_time(known, arrived_ms, "0 seconds", "_arrived").select(*texts, "_arrived")
    kept = bucketed(timed, at[key]).transformWithStateInPandas(
        processors.RisingOnArrival(
            at[key], at[value], [at[name] for name in order], _kinds(known), at[arrived_ms], ttl_ms, key
        ),
        known.select(*texts).schema, "Append", "EventTime",
    )
    return kept.select(*_typed(known))


def tag_records(messages: DataFrame) -> DataFrame:
    """Base-tag records read back from their topic, watermarked on their own time."""
    return with_event_time(parsing.tag_records(messages), "ts", TYPED_DELAY)


def identities(logs: DataFrame) -> DataFrame:
    """Who was on which device when, watermarked."""
    return with_event_time(page_logs.identities(logs), "ts", TYPED_DELAY)


def user_tags(users: DataFrame, supplements: DataFrame, as_of: dt.date) -> DataFrame:
    return tag_rows(users_with_supplements(users, supplements), as_of)


def behavior_scores(records: DataFrame, searches: DataFrame) -> DataFrame:
    return score_profiles(windowed_profile(records), searches)


def order_scores(orders: DataFrame, details: DataFrame, products: DataFrame) -> DataFrame:
    arriving = orders_with_details(orders, details).withColumn("_arrival", pair_arrival())
    kept = rising_only(arriving, "detail_id", "create_time", ARRIVAL).drop("_arrival")
    return score_orders(kept, products)


def start_files(rows: DataFrame, name: str, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Streams rows to parquet files; a restart with the same checkpoint goes on without repeats or gaps."""
    return (
        rows.writeStream.format("parquet")
        .queryName(name)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .start()
    )


# Fixed value: state stores per task that runs at once.
STORES_PER_TASK = 2


def state_partitions(spark: SparkSession) -> int:
    """How many state stores each operator of a new stream has: the session's shuffle partitions, but no more than two rounds of tasks.

    Every store is opened, written and, for Python, given a worker anew in each micro-batch, however few rows it has: what
    would grow with the number of partitions. Rows of a store lie on disk, so fewer stores may be larger.
    """
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(asked, max(4, STORES_PER_TASK * spark.sparkContext.defaultParallelism))


# What lies in a state store is packed, what a micro-batch has removed goes with its commit, and of the versions
# only those go on that a restart can read.
STATE = {
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true",
    "spark.sql.streaming.stateStore.maintenanceInterval": "15s",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def _drain(rows: DataFrame, folder: str, close_windows: bool) -> StreamingQuery:
    spark = rows.sparkSession
    wanted = {
        "spark.sql.streaming.noDataMicroBatches.enabled": str(close_windows).lower(),
        # Arbitrary keyed state needs this state store; the session's own setting comes back afterwards.
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **UNCOUNTED,
        **STEP,
        **STATE,
        "spark.sql.shuffle.partitions": str(state_partitions(spark)),
    }
    with settings(spark, wanted):
        query = start_files(
            rows, folder.rsplit("/", 1)[1], f"{folder}/rows", f"{folder}/checkpoint", availableNow=True
        )
        query.awaitTermination()
    return query


def drained(rows: DataFrame, name: str, close_windows: bool = True) -> DataFrame:
    """Runs a stream over all input available now and reads back what it wrote to the shared folder.

    ``close_windows`` lets batches without input follow, which write the
    windows the last watermark closed. State with a processing-time limit asks
    for such batches for ever, so turn it off there.
    """
    folder = new_folder(rows.sparkSession, name)
    _drain(rows, folder, close_windows)
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/rows")


def checkpoint_of(rows: DataFrame, name: str) -> str:
    """Runs a stream over all input available now; where its checkpoint, with the state it ended in, lies."""
    folder = new_folder(rows.sparkSession, name)
    _drain(rows, folder, True)
    return f"{folder}/checkpoint"


ACCOUNTS = "batch bigint, incoming bigint, kept bigint, repeated bigint, late bigint"


def deduplication_account(records: DataFrame, name: str, delay: str = RAW_DELAY) -> DataFrame:
    """Runs ``without_repeats`` over all input available now; per micro-batch, where its records went.

    ``incoming`` and ``kept`` are counted on the way, ``repeated`` and ``late`` by the state operator: the three add up
    to the first. One row per micro-batch, of the last hundred (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    spark = records.sparkSession
    count = F.count(F.lit(1)).alias("n")
    kept = without_repeats(records.observe("incoming", count), delay).drop("event_time").observe("kept", count)
    query = _drain(kept, new_folder(spark, name), True)
    accounts = []
    for progress in query.recentProgress:
        seen, (state,) = progress.observedMetrics, progress.stateOperators
        accounts.append(
            (progress.batchId, seen["incoming"]["n"], seen["kept"]["n"],
             state.customMetrics["numDroppedDuplicateRows"], state.numRowsDroppedByWatermark)
        )
    return spark.createDataFrame(accounts, ACCOUNTS)


def stored_state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """(key, value) of a keyed-state variable, read from the checkpoint of a stopped query by Spark's state reader."""
    with settings(spark, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}):
        state = spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
        return written(state.select("key.*", "value.*"), "state")


def stored_entries(spark: SparkSession, checkpoint: str, variable: str, schema: str) -> DataFrame:
    """The entries of all buckets of a variable that holds them packed, by their ``schema``."""
    wanted = to_arrow_schema(StructType.fromDDL(schema))

    def entries(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for blob in batch.column(0):
                yield from pa.ipc.open_stream(blob.as_buffer()).read_all().cast(wanted).to_batches()

    return stored_state(spark, checkpoint, variable).select("entries").mapInArrow(entries, schema)
