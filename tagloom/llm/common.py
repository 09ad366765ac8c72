"""What the operators share: whole-text walks in bounded pieces, and Arrow maps over texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tagloom.session import written


# Bytes of text that one step of a Python worker holds at a time.
PIECE_BYTES = 1 << 20
SPACE = re.compile(rb"[\x09-\x0d ]")
# The white space of Unicode's property, which is what the vocabularies' patterns mean by it; Python's
# own \\s adds the separators U+001C to U+001F.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPACE_AFTER_TEXT = re.compile(f"(?<=[^{WHITE}])[{WHITE}]")


def word_runs(data: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """Words of a whole text (cut at ASCII white space, A-Z lowered), some at a time.

    ``bytes.split`` cuts at exactly ``[\\x20\\x09-\\x0D]`` and ``bytes.lower`` touches A-Z alone.
    """
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            found = SPACE.search(data, end)
            end = found.start() if found else len(data)
        yield data[at:end].lower().split()
        at = end


def text_runs(text: str, size: int = PIECE_BYTES) -> Iterator[str]:
    """A whole text in pieces that end before white space which follows something else."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            found = SPACE_AFTER_TEXT.search(text, end)
            end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def free_name(rows: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores before it until ``rows`` has no such column."""
    taken = {name.lower() for name in rows.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def shingle_hashes(words: list[bytes], k: int, digest: Callable[[bytes, int], int], seed: int) -> list[int]:
    """Hash of each run of ``k`` space-joined words."""
    joined = b" ".join(words)
    starts, ends, at = [], [], 0
    for word in words:
        starts.append(at)
        at += len(word)
        ends.append(at)
        at += 1
    return [digest(joined[s:e], seed) for s, e in zip(starts, ends[k - 1 :])]


def map_texts(
    rows: DataFrame,
    text: str,
    make: Callable[[], Callable[[list], list[tuple]]],
    made: T.StructType,
    raw: bool = False,
    piece_bytes: int = PIECE_BYTES,
    keep_text: bool = False,
) -> DataFrame:
    """``rows`` (without ``text``, unless it is kept) with the columns ``made`` that a function gives for it.

    ``make`` is called once a task and gives a function from a list of texts
    (``bytes`` if ``raw``, NULL as empty) to one tuple for each. It is called
    with about ``piece_bytes`` of text at a time, or one longer text.
    """
    kept = [name for name in rows.columns if keep_text or name != text]
    schema = T.StructType([rows.schema[name] for name in kept] + made.fields)
    types = [to_arrow_type(field.dataType) for field in made.fields]
    empty = b"" if raw else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            column = column.cast(pa.binary()) if raw else column
            others = [batch.column(batch.schema.get_field_index(name)) for name in kept]
            for first, last in _slices(column, piece_bytes):
                texts = [value.as_py() or empty for value in column[first:last]]
                results = list(zip(*each(texts)))
                arrays = [pa.array(values, kind) for values, kind in zip(results, types)]
                yield pa.RecordBatch.from_arrays(
                    [other[first:last] for other in others] + arrays, [*kept, *made.names]
                )

    return rows.mapInArrow(run, schema)


def _slices(column: pa.Array, piece_bytes: int) -> Iterator[tuple[int, int]]:
    lengths = pa.compute.binary_length(column).to_pylist()
    first = held = 0
    for at, length in enumerate(lengths):
        held += length or 0
        if held >= piece_bytes:
            yield first, at + 1
            first, held = at + 1, 0
    if first < len(lengths):
        yield first, len(lengths)


# monotonically_increasing_id: a partition's number above these bits, the row's below.
_ROW = (1 << 33) - 1


def numbered(rows: DataFrame, part: str, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``position`` (from 0 in the order given, within its ``part``) and ``n`` (rows of the part).

    Rows are dealt into ranges of (part, order), so that a part of any size
    spreads; a row's place is its place in the range plus what the part's
    earlier ranges hold. Rows equal in all of that may swap places,
    and a group of them spreads like any others. ``part`` must not be NULL.
    """
    tie = F.monotonically_increasing_id()
    dealt = rows.withColumn("_tie", tie).repartitionByRange(part, *order, "_tie").sortWithinPartitions(part, *order, "_tie")
    stored = written(dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), purpose)
    stored = stored.withColumn("_range", F.shiftright("_at", 33))
    ranges = stored.groupBy(part, "_range").agg(F.count(F.lit(1)).alias("_held"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        part,
        "_range",
        (F.coalesce(F.sum("_held").over(earlier), F.lit(0)) - F.col("_first").bitwiseAND(F.lit(_ROW))).alias("_before"),
        F.sum("_held").over(Window.partitionBy(part)).alias("n"),
    )
    found = stored.join(written(ranges, f"{purpose}-ranges"), [part, "_range"])
    position = F.col("_before") + F.col("_at").bitwiseAND(F.lit(_ROW))
    return found.select(*rows.columns, position.alias("position"), "n")


def forget(known: dict, most: int) -> None:
    """Drops the older half of a memo that holds more than ``most`` entries."""
    if len(known) > most:
        for key in list(islice(known, len(known) // 2)):
            del known[key]


def ascii_lower(column: Column) -> Column:
    """A-Z lowered, everything else untouched."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, upper, upper.lower())
