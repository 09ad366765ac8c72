"""Near-duplicates by SimHash, found by meet-in-the-middle ball hashing."""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import free_name, map_texts, shingle_hashes, word_runs
from tagloom.llm.components import components
from tagloom.session import written

BITS = 64
# Fingerprints that one task turns into balls.
FINGERPRINTS_PER_TASK = 100_000
SEED = 42


def fingerprint(data: bytes, shingle: int) -> int:
    """SimHash of a whole text: a bit is set if it is set in over half of the XXH64 of its shingles.

    Words are cut at ASCII white space with A-Z lowered; a text with fewer words than ``shingle`` has one
    shingle, all of it; one without words has fingerprint zero. The text is walked in bounded pieces.
    """
    ones, total, carried = np.zeros(BITS, np.int64), 0, []
    for run in word_runs(data):
        words = carried + run
        if len(words) >= shingle:
            hashes = shingle_hashes(words, shingle, xxhash.xxh64_intdigest, SEED)
            ones += _ones(hashes)
            total += len(hashes)
        carried = words[max(0, len(words) - shingle + 1) :]
    if not total and carried:
        ones, total = _ones([xxhash.xxh64_intdigest(b" ".join(carried), SEED)]), 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def _ones(hashes: list[int]) -> np.ndarray:
    raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(raw), 1 << 15):
        ones += np.unpackbits(raw[at : at + (1 << 15)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return ones


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, bits): the fingerprint of each whole text as a signed long. A NULL text is an empty one."""

    def make():
        return lambda texts: [(fingerprint(data, shingle),) for data in texts]

    made = T.StructType([T.StructField("bits", T.LongType())])
    return map_texts(docs.select(F.col(key), F.col(text).alias("_text")), "_text", make, made, raw=True)


def ball(bits: str, radius: int):
    """All values within ``radius`` (0 to 2) flipped bits, the value itself included."""
    one = F.array(*[F.lit(1 << n if n < 63 else -(1 << 63)).cast("long") for n in range(BITS)])
    flips = {0: F.array(F.lit(0).cast("long"))}
    flips[1] = F.concat(flips[0], one)
    if radius == 2:
        two = [(1 << i | 1 << j) - (1 << 64 if j == 63 else 0) for j in range(BITS) for i in range(j)]
        flips[2] = F.concat(flips[1], F.array(*[F.lit(n).cast("long") for n in two]))
    return F.transform(flips[radius], lambda flip: F.col(bits).bitwiseXOR(flip))


def links(distinct_bits: DataFrame, distance: int = 2) -> DataFrame:
    """Pairs (a, b) of different fingerprints at most ``distance`` bits apart that connect all such fingerprints.

    Every fingerprint emits all values within half the distance (rounded up);
    two fingerprints within the distance meet in at least one of them. Each
    bucket holds distinct fingerprints inside one small ball (65 at most for
    distance 1 and 2), whatever the data. In an even distance all of a bucket
    are within it of each other, so linking each to the smallest of its bucket
    keeps every connection; for an odd distance the pairs inside the bounded
    bucket are verified one by one.
    """
    if not 0 < distance <= 4:
        raise ValueError("distance must be 1 to 4")
    variants = distinct_bits.select(F.col("bits"), F.explode(ball("bits", (distance + 1) // 2)).alias("variant"))
    if distance % 2:
        buckets = variants.groupBy("variant").agg(F.collect_set("bits").alias("near")).filter(F.size("near") > 1)
        pairs = buckets.select("near", F.explode("near").alias("a")).select("a", F.explode("near").alias("b"))
        pairs = pairs.filter(F.col("a") < F.col("b"))
    else:
        least = F.min("bits").over(Window.partitionBy("variant"))
        pairs = variants.select(least.alias("a"), F.col("bits").alias("b")).filter(F.col("a") != F.col("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return pairs.distinct().filter(apart <= distance)


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, bits, component_id): documents whose fingerprints are linked, directly or through others.

    ``component_id`` is the smallest key of the component. Texts with equal
    fingerprints collapse to one before any bucket is made, so groups of copies
    cost one row. Rows with a NULL key get a fingerprint and the component of
    the documents they are near to (NULL if there are none); repeated rows stay.
    Other columns of ``docs`` are ignored; no documents give no rows.
    """
    marked = written(fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), shingle, "key"), "fingerprints")
    distinct = written(marked.groupBy("bits").agg(F.min("key").alias("first_key")), "fingerprint-classes")
    # Few bytes, but each becomes a whole ball: dealt out by number, not by size.
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, math.ceil(distinct.count() / FINGERPRINTS_PER_TASK))
    spread = distinct.select("bits").repartition(tasks)
    roots = components(links(spread, distance)).select(F.col("node").alias("bits"), "root")
    rooted = distinct.join(roots, "bits", "left").select("bits", "first_key", F.coalesce("root", "bits").alias("root"))
    rooted = written(rooted, "fingerprint-roots")
    smallest = written(rooted.groupBy("root").agg(F.min("first_key").alias("component_id")), "fingerprint-components")
    classes = written(rooted.join(smallest, "root").select("bits", "component_id"), "fingerprint-classes")
    return marked.join(classes, "bits").select(F.col("key").alias(key), "bits", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without documents that are near-duplicates of one with a smaller key.

    Of rows with the same key all stay if the key is the smallest of its component; rows with a NULL key go only if
    they have a near-duplicate with a key. All columns of ``docs`` stay, whatever their names.
    """
    name = free_name(docs, "_dropped")
    found = near_duplicates(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), shingle, distance, "key", "text")
    dropped = written(
        found.filter(F.col("key") != F.col("component_id")).select(F.col("key").alias(name)).distinct(), "near-duplicates"
    )
    return docs.join(dropped, F.col(key) == F.col(name), "left_anti")
