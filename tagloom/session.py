"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Counting the rows of a state store reads each key before it is written or removed, for a metric only.
UNCOUNTED = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}

# For steps that are written: a step's shuffle files go when it has ended, not when the driver happens to collect its garbage,
# and what is kept for the next step is small.
STEP = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

# What the plans expect of a cluster session.
SETTINGS = {
    **UNCOUNTED,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The time-slotted joins can still meet one hot (key, slot): let AQE split it even if that costs an exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def ship(module: ModuleType) -> None:
    """The classes of a module travel with the query, so the package need not be installed on the workers."""
    cloudpickle.register_pickle_by_value(module)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``, else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return named.rstrip("/")


def work_folder(spark: SparkSession) -> str:
    """What this application writes for itself lies here, below the shared folder."""
    return f"{shared_folder(spark)}/tagloom/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the work folder."""
    return f"{work_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_work_folder(spark: SparkSession) -> None:
    """Deletes all that this application has written for itself. Results are lazy, so store those that are still wanted first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a full URI, for code that opens it without Spark: one without a scheme is on the default file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop).toString()


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: from then on Spark knows its size in bytes."""
    path = new_folder(df.sparkSession, purpose)
    with settings(df.sparkSession, STEP):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block; what was there before comes back."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
