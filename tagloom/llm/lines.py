"""Removal of lines that repeat across documents, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import ascii_lower
from tagloom.session import written

BLANKS = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lowered."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(key: Column) -> list[Column]:
    """128 bits in two independent halves: the second hashes on from that of a constant."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def drop_repeated_lines(
    docs: DataFrame,
    min_length: int = 10,
    min_docs: int = 2,
    key: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(key, text, n_lines, n_dropped) without lines that ``min_docs`` or more documents share, and the columns ``keep``.

    Lines are cut at ``\\n``; two are the same if their keys (``line_key``) are,
    keys of fewer than ``min_length`` characters are left alone, and the document
    with the smallest key keeps its lines. A NULL or empty text is one empty
    line. Rows with a NULL key are returned whole and count for nothing; rows
    that repeat a key count as one document and each lose the same lines. Other
    columns but those of ``keep`` are ignored; a column of ``keep`` named as one
    of the result's own raises ``ValueError``; no documents give no rows.

    Only 128-bit hashes of lines are shuffled to find the repeated ones, with
    map-side combining, so a line that most documents hold is one row per task;
    the text itself moves once, to meet the positions that its document loses.
    """
    if twice := {name for name in keep if name.lower() in {key.lower(), "text", "n_lines", "n_dropped"}}:
        raise ValueError(f"columns {sorted(twice)} would be there twice; rename them first")
    kept = [F.col(name).alias(f"kept_{at}") for at, name in enumerate(keep)]
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"),
        F.struct(F.lit(None).alias("none"), *kept).alias("rest"),
    )
    lines = (
        rows.filter(F.col("key").isNotNull())
        .select("key", "version", F.posexplode(_split(F.col("text"))).alias("position", "line"))
        .select("key", "version", "position", line_key(F.col("line")).alias("line"))
        .filter(F.length("line") >= min_length)
        .select("key", "version", "position", *_hash(F.col("line")))
    )
    lines = written(lines, "line-hashes")
    if min_docs <= 2:  # found in two documents if the smallest and the largest key differ: one shuffle, no distinct count
        shared = F.lit(min_docs < 2) | (F.min("key") < F.max("key"))
    else:
        shared = F.count_distinct("key") >= min_docs
    repeated = (
        lines.groupBy("h1", "h2")
        .agg(F.min("key").alias("owner"), shared.alias("shared"))
        .filter("shared")
        .select("h1", "h2", "owner")
    )
    repeated = written(repeated, "repeated-lines")
    dropped = (
        lines.join(repeated, ["h1", "h2"])
        .filter(F.col("key") != F.col("owner"))
        .groupBy("key", "version")
        .agg(F.sort_array(F.collect_set("position")).alias("dropped"))
    )
    # The lines that stay are the slices between lost positions: linear in the lines, however many are lost.
    lost = F.coalesce("dropped", F.array().cast("array<int>"))
    starts, ends = F.concat(F.array(F.lit(-1)), "lost"), F.concat("lost", F.array(F.size("parts")))
    stretches = F.zip_with(starts, ends, lambda a, b: F.slice("parts", a + 2, b - a - 1))
    return (
        rows.select("key", "version", "rest", _split(F.col("text")).alias("parts"))
        .join(dropped, ["key", "version"], "left")
        .select("key", "rest", "parts", lost.alias("lost"))
        .select(
            F.col("key").alias(key),
            F.array_join(F.flatten(stretches), "\n").alias("text"),
            F.size("parts").cast("long").alias("n_lines"),
            F.size("lost").cast("long").alias("n_dropped"),
            *[F.col("rest").getField(f"kept_{at}").alias(name) for at, name in enumerate(keep)],
        )
    )
