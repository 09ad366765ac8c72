"""Placement of documents on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from bisect import bisect_right

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import numbered
from tagloom.session import written

# Places of the ring; a key's place is its hash modulo this.
PLACES = 1 << 16
VIRTUAL_NODES = 64


def ring(n_shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node in ring order; a place hit twice belongs to the smaller shard.

    A place belongs to the last virtual node at or before it; those before the first belong to the last.
    """
    taken: dict[int, int] = {}
    for shard in range(n_shards):
        for node in range(virtual_nodes):
            taken.setdefault(xxhash.xxh64_intdigest(f"{shard}/{node}") % PLACES, shard)
    return sorted(taken.items())


def fill(loads: list[int], owners: list[int], n_shards: int) -> list[tuple[int, int, int, int, int]]:
    """Where the keys of each arc go: (arc, first, after, shard, slot), keys of an arc numbered from 0 in ring order.

    Shards have room for the ``n``-th part of all keys, the first few for one
    more, so that everything fits exactly. First every shard takes the keys of
    its own arcs, in ring order, while it has room. What overflows then goes on
    clockwise from its arc to the next virtual nodes whose shards have room.
    """
    total = sum(loads)
    room = [total // n_shards + (shard < total % n_shards) for shard in range(n_shards)]
    slot = [0] * n_shards
    pieces, over = [], []

    def put(arc: int, first: int, n: int, shard: int) -> None:
        if n:
            pieces.append((arc, first, first + n, shard, slot[shard]))
            slot[shard] += n
            room[shard] -= n

    for arc, (load, shard) in enumerate(zip(loads, owners)):
        stays = min(load, room[shard])
        put(arc, 0, stays, shard)
        if stays < load:
            over.append((arc, stays, load - stays))
    for arc, first, left in over:
        step = arc
        while left:
            step = (step + 1) % len(owners)
            moved = min(left, room[owners[step]])
            put(arc, first, moved, owners[step])
            first, left = first + moved, left - moved
    return pieces


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A broadcast table whose size depends on the ring alone."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def placed(
    docs: DataFrame, n_shards: int = 24, virtual_nodes: int = VIRTUAL_NODES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard): a shard and a place in it for every document.

    The law is ``rows``: counts of any two shards differ by one at most. Shards
    own arcs of a ring at their virtual nodes; a document belongs to the arc its
    key hashes into, and what a full shard can't take goes on clockwise. Within
    an arc documents are in the order of their hash and key. ``size`` is the
    UTF-8 length of the text (NULL: none) plus 8, ``slot`` counts from 0 in each
    shard without gaps, ``grown_shard`` is NULL under this law.

    A NULL key is placed by the hash of its text. Repeated rows are rows of
    their own; rows equal in key and text may swap places. Other columns are
    ignored; no documents give no rows. Copies of a text spread by their keys.

    The plan is made from one count for each place of the ring (65,536 at most,
    whatever the data), and rows are ranked within their place of the ring by
    ranges, so that rows of one key, however many, spread over tasks. Texts are
    read once, for their length and checksum only.
    """
    spark = docs.sparkSession
    hashed = F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key))).otherwise(F.xxhash64(F.lit("no key"), F.col(text)))
    rows = docs.select(
        F.col(key).alias("key"),
        hashed.alias("hash"),
        F.pmod(hashed, F.lit(PLACES)).cast("int").alias("place"),
        (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
    )
    rows = written(rows, "shard-keys")
    nodes = ring(n_shards, virtual_nodes)
    starts = [place for place, _ in nodes]
    counts = dict(rows.groupBy("place").count().collect())  # at most PLACES rows
    loads, places = [0] * len(nodes), []
    # Ring order starts at the first node; places before it close the last arc.
    for place in [*range(starts[0], PLACES), *range(starts[0])]:
        if place in counts:
            arc = (bisect_right(starts, place) - 1) % len(nodes)
            places.append((place, arc, loads[arc]))
            loads[arc] += counts[place]
    pieces = fill(loads, [shard for _, shard in nodes], n_shards) if places else []
    before = _table(spark, places, "place int, arc int, before long")
    pieces_table = _table(spark, pieces, "piece_arc int, first long, after long, shard int, base long")

    ranked = numbered(rows, "place", ["hash", "key", "text_crc32", "size"], "shard-places").join(before, "place")
    rank = F.col("before") + F.col("position")
    found = ranked.join(
        pieces_table, (F.col("arc") == F.col("piece_arc")) & (rank >= F.col("first")) & (rank < F.col("after"))
    )
    return found.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("base") + rank - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
