"""Captured messages as a frame with one STRING column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import STEP, settings


def kafka_options(servers: str, topic: str, starting: str = "earliest", **further: str) -> dict[str, str]:
    """Reader options; ``further`` ones (rate limit, security, group, partition bounds) by the names Spark gives them."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        # A log that was truncated behind a stopped query is reported, not skipped.
        "failOnDataLoss": "true",
        **further,
    }


def read_messages(
    spark: SparkSession,
    source: str,
    streaming: bool = False,
    format: str = "text",
    max_files: int = 1000,
    **options: str,
) -> DataFrame:
    """Messages of a topic (``format="kafka"``, ``source`` is the topic) or of files with one message per line.

    Text values only; keys and headers are dropped. New partitions or files are
    found with each micro-batch. Null values are passed on: see ``drop_tombstones``.
    """
    reader = spark.readStream if streaming else spark.read
    if format == "kafka":
        servers = options.pop("servers")
        loaded = reader.format("kafka").options(**kafka_options(servers, source, **options)).load()
        return loaded.select(F.col("value").cast("string").alias("value"))
    if streaming:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(format).schema("value STRING").options(**options).load(source)


def spread(rows: DataFrame, pieces: int) -> DataFrame:
    """Batch rows dealt evenly into ``pieces``, for work bound by the processor over input that is stored in too few."""
    return rows.repartition(pieces)


def replayed(
    rows: DataFrame, ms: str, folder: str, batches: int = 3, tail: DataFrame | None = None, files: int | None = None
) -> DataFrame:
    """Stored rows as a bounded stream of ``batches`` micro-batches, ``files`` files each, by the time ``ms`` (an SQL expression).

    Without ``files`` there are as many as tasks run at once, four at least, so that all of them write and read.

    The span of time is cut evenly, so a batch holds nothing older than the one before. ``tail`` rows
    follow in a batch of their own. For data that stands in for a topic.
    """
    files = files or max(4, rows.sparkSession.sparkContext.defaultParallelism)
    first, last = rows.selectExpr(f"min({ms})", f"max({ms})").first()
    width = ((last or 0) - (first or 0)) // batches + 1
    number = F.coalesce(F.expr(f"floor(({ms} - {first or 0}L) / {width}L)"), F.lit(0))
    for n in range(batches):  # the file source takes files by age
        _written_in(rows.filter(number == n), f"{folder}/{n}", files)
    if tail is not None:
        _written_in(tail.select(*rows.columns), f"{folder}/{batches}", files)
    reader = rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{folder}/*")


def _written_in(rows: DataFrame, path: str, files: int) -> None:
    """Exactly so many files, some of them empty if there are few rows: a micro-batch is counted in files."""
    spark = rows.sparkSession
    with settings(spark, STEP):
        spread(rows, files).write.parquet(path)
        none = spark.createDataFrame([], rows.schema).coalesce(1)
        for _ in range(files - len(spark.read.parquet(path).inputFiles())):
            none.write.mode("append").parquet(path)
