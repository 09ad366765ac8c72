"""Times the headline queries: median of three runs after a warm-up, each writing every column to the no-op sink.

The tables are first stored in a few files each, as a table of any size is, and messages are written as text, so that
neither a single row group nor the making of messages is measured. The streams write their micro-batches first
and run to the end of their input, once after the warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tagloom.plans import adapters
from tagloom.queries import BY_TABLES
from tagloom.session import configure, new_folder
from tagloom.sources.tables import Tables

HEADLINE = [
    "pay_time_slot",
    "score_amount",
    "order_enrich",
    "user_interval_join",
    "order_interval_join",
    "log_dedup",
    "detail_monotone",
    "running_pv",
    "running_sets",
    "window_profile",
    "cdc_route",
    "order_detail_project",
    "broadcast_rules",
    "rates_as_of",
    "order_enrich_as_of",
    "cdc_state",
    "weather_summary",
    "user_tags",
    "behavior_scores",
    "order_scores",
    "stream_dedup",
    "stream_order_join",
    "stream_behavior_scores",
]


def timed(query, tables: Tables) -> float:
    start = time.perf_counter()
    query(tables).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def warmed_up(query, tables: Tables) -> int:
    """Runs the query once and returns how many rows it gave."""
    seen = Observation()
    df = query(tables).observe(seen, F.count(F.lit(1)).alias("rows"))
    df.write.format("noop").mode("overwrite").save()
    return seen.get["rows"]


TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")


def with_topics(spark: SparkSession, folder: str, files: int) -> Tables:
    """The tables of a folder in so many files, and the messages made from them written as text."""
    given, folder = Tables(spark, folder), new_folder(spark, "bench-tables")
    for name in TABLES:
        given[name].repartition(files).write.parquet(f"{folder}/{name}.parquet")
    tables, topics = Tables(spark, folder), {}
    for name, messages in (("change_log", adapters.change_log), ("page_log", adapters.page_log_messages)):
        topics[name] = new_folder(spark, f"bench-{name}")
        messages(tables).write.parquet(topics[name])
    return Tables(spark, folder, topics=topics)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    memory = os.environ.get("BENCH_MEMORY", "12g")
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", memory)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_WORK", tempfile.mkdtemp(prefix="bench-")))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    stored = with_topics(spark, folder, int(cpus))
    seconds, rows = {}, {}
    for name in chosen:
        query = BY_TABLES[name]
        rows[name] = warmed_up(query, stored)
        times = 1 if name.startswith("stream_") else runs
        seconds[name] = round(statistics.median(timed(query, stored) for _ in range(times)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of the median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "sf": folder.rsplit("sf", 1)[-1],
                "cpus": cpus,
                "memory": memory,
                "runs": runs,
                "shuffle_partitions": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
