"""Finished small files packed into files of about a wanted size, with a manifest of what has been packed."""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom.session import STEP, qualified, settings
from tagloom.sinks.files import read_order_csv

# A pack's size, and how long a file must have been left alone to count as finished.
PACK_BYTES = 1 << 30
IDLE_MS = 5 * 60 * 1000

MANIFEST = "pack string, bytes bigint, sources array<string>"


def listed(spark: SparkSession, folder: str, pattern: str = "*.{csv,csv.gz}") -> list[tuple[int, str, int]]:
    """(time of last change, path, bytes) of the files below a folder, oldest first; contents are not read.

    The list is as long as the one Spark's own file index holds in the driver.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    rows = files.select(F.unix_millis("modificationTime"), "path", "length").collect()
    return sorted((row[0], row[1], row[2]) for row in rows)


def manifest(spark: SparkSession, target: str) -> list:
    """(pack, bytes, sources) of every pack that counts."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{qualified(spark, target)}/manifest")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    return spark.read.schema(MANIFEST).json(f"{target}/manifest").collect()


def _planned(files: list[tuple[int, str, int]], pack_bytes: int) -> Iterator[list[tuple[str, int]]]:
    """Files in their order, as many to a pack as fit, or one larger file."""
    pack, held = [], 0
    for _, path, size in files:
        if pack and held + size > pack_bytes:
            yield pack
            pack, held = [], 0
        pack.append((path, size))
        held += size
    if pack:
        yield pack


GZIP = ".gz"


def _plain(path: Column) -> Column:
    """A path with one slash after its scheme, however it was written."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def _by_text(spark: SparkSession, files: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """The files with the bytes of their text, line ends included, for those that are packed themselves: one row a file."""
    zipped = [path for _, path, _ in files if path.endswith(GZIP)]
    lines = spark.read.text(zipped).select(F.col("_metadata.file_path").alias("path"), (F.octet_length("value") + 1).alias("bytes"))
    listed_as = F.broadcast(spark.createDataFrame([(path,) for path in zipped], "listed string"))
    summed = lines.groupBy("path").agg(F.sum("bytes").alias("bytes"))
    found = summed.join(listed_as, _plain(F.col("path")) == _plain(F.col("listed"))).select("listed", "bytes").collect()
    text = dict(map(tuple, found))
    return [(changed, path, text.get(path, 0) if path.endswith(GZIP) else size) for changed, path, size in files]


def pack_files(
    spark: SparkSession, folder: str, target: str, pack_bytes: int = PACK_BYTES, idle_ms: int = IDLE_MS, now_ms: int | None = None
) -> int:
    """Packs the finished files of ``folder`` that no pack holds yet; returns how many packs were made.

    A file is finished once it has not changed for ``idle_ms``. A pack is
    written by one task, line by line in the order of its files. Packs count
    once the run's manifest, one file, is there: a run that failed before left
    packs nobody reads, and the next one packs their files again. Run one at a
    time.

    Gzip files are packed by the bytes of their text, and packs with such a file are gzip files themselves.
    """
    now_ms = round(time.time() * 1000) if now_ms is None else now_ms
    done = {source for row in manifest(spark, target) for source in row.sources}
    files = [f for f in listed(spark, folder) if f[0] + idle_ms <= now_ms and f[1] not in done]
    zipped = any(path.endswith(GZIP) for _, path, _ in files)
    packs = list(_planned(_by_text(spark, files) if zipped else files, pack_bytes))
    if not packs:
        return 0
    run = f"{target}/packs/run-{now_ms}-{len(done)}-{len(manifest(spark, target))}"
    places = [(path, number, nth) for number, pack in enumerate(packs) for nth, (path, _) in enumerate(pack)]
    # As many rows as files in this run, each of them opened by Spark anyway.
    plan = F.broadcast(spark.createDataFrame(places, "path string, pack int, nth int"))
    lines = spark.read.text([path for path, _, _ in places]).select(
        "value",
        _plain(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    plan = plan.withColumn("path", _plain(F.col("path")))
    dealt = lines.join(plan, "path").repartition(len(packs), "pack").sortWithinPartitions("pack", "nth", "block", "line")
    with settings(spark, STEP):
        writer = dealt.select("pack", "value").write.mode("overwrite").partitionBy("pack")
        writer.text(run, compression="gzip" if zipped else "none")
    rows = [(f"{run}/pack={n}", sum(size for _, size in pack), [path for path, _ in pack]) for n, pack in enumerate(packs)]
    commit(spark, rows, target)
    return len(packs)


def commit(spark: SparkSession, rows: list[tuple], target: str) -> None:
    """The run's manifest as one file, which is there as a whole or not at all."""
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").json(f"{target}/manifest")


def read_packed(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """Rows of all packs that count, by an explicit schema."""
    packs = [row.pack for row in manifest(spark, target)]
    return read_order_csv(spark, packs, schema) if packs else spark.createDataFrame([], schema)
