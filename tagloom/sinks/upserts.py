"""A table kept by key: each micro-batch is merged into the buckets it touches, and a manifest says what counts."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom.session import qualified


class KeyedTable:
    """Rows by ``keys``, of each the last by ``order``, in ``buckets`` of the key's hash.

    A batch rewrites the buckets it touches into new folders; then its manifest,
    which names the folder of every bucket, is put in place by one rename. A
    reader goes by the newest manifest, so it sees a batch as a whole or not at
    all, and what a failed attempt has written is never read. A batch that was
    merged already is skipped; an older row never replaces a newer one, so
    batches may come in any arrangement of rows. One writer at a time.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, keys: list[str], order: list[str], buckets: int = 64
    ) -> None:
        self.spark, self.schema, self.keys, self.order, self.buckets = spark, schema, keys, order, buckets
        self.path = qualified(spark, path.rstrip("/"))
        self._files = spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifests/{name}")

    def _manifest(self) -> dict:
        """The newest manifest: the batches merged so far and the folder of every bucket that holds rows."""
        folder = self._at(".").getParent()
        names = [f.getPath().getName() for f in self._files.listStatus(folder)] if self._files.exists(folder) else []
        whole = sorted(name for name in names if name.endswith(".json"))
        if not whole:
            return {"batches": [], "folders": {}}
        return json.loads("\n".join(row.value for row in self.spark.read.text(f"{self.path}/manifests/{whole[-1]}").collect()))

    def _commit(self, held: dict, version: int) -> None:
        draft, final = self._at(f"{uuid.uuid4().hex}.draft"), self._at(f"{version:012d}.json")
        out = self._files.create(draft, False)
        out.write(bytearray(json.dumps(held).encode()))
        out.close()
        if self._files.exists(final) or not self._files.rename(draft, final):
            raise RuntimeError(f"another writer has committed version {version}")

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Merges a micro-batch; the function to give to ``foreachBatch``."""
        held = self._manifest()
        if batch_id in held["batches"] or (held["batches"] and batch_id < max(held["batches"]) - KEPT_BATCHES):
            return
        rows = batch.select(*self.schema.names).withColumn("_bucket", self._bucket())
        touched = [row[0] for row in rows.select("_bucket").distinct().collect()]  # at most as many as buckets
        old = self._rows({str(n): held["folders"][str(n)] for n in touched if str(n) in held["folders"]})
        both = rows.unionByName(old.withColumn("_bucket", self._bucket()))
        last = both.groupBy("_bucket", *self.keys).agg(
            F.max_by(F.struct(*self.schema.names), F.struct(*self.order)).alias("_last")
        )
        folder = f"{self.path}/data/{batch_id}-{uuid.uuid4().hex}"
        last.select("_bucket", "_last.*").write.partitionBy("_bucket").parquet(folder)
        folders = held["folders"] | {str(n): f"{folder}/_bucket={n}" for n in touched}
        batches = sorted([*held["batches"], batch_id])[-KEPT_BATCHES:]
        self._commit({"batches": batches, "folders": folders, "version": held.get("version", 0) + 1}, held.get("version", 0) + 1)

    def _rows(self, folders: dict[str, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders.values())

    def read(self) -> DataFrame:
        """The rows as of the newest manifest."""
        return self._rows(self._manifest()["folders"])


# A manifest names so many of the last batches; a stream replays its last one only.
KEPT_BATCHES = 1000
