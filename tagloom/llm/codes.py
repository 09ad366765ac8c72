"""Vectors as short codes: codebooks per part, fitted and applied over a trie of the distinct parts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tagloom.session import written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Nodes of the trie that are worked on together: each holds a distance to every entry.
NODES = 512
# Components from here on are added up as Python's own integers, smaller ones in 64 bits.
WIDE = 1 << 27
LARGEST = float(1 << 62)


def usable(vector: Column, scale: int = SCALE) -> Column:
    """Not NULL, not empty, no NULL or non-finite component, and none that scaled goes beyond 62 bits."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * F.lit(float(scale))) < F.lit(LARGEST)))
    return F.coalesce(fits & (F.size(vector) > 0), F.lit(False))


def nearest_entries(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the entry nearest to each of the sorted, distinct rows of ``parts``; ties to the lower index.

    The rows are the leaves of a trie by dimension. It is walked depth first, a
    block of sibling subtrees at a time; a node's distances to all entries, over
    the dimensions down to it, are added up once for all rows that begin alike.
    """
    n, dims = parts.shape
    index, error = np.zeros(n, np.int64), np.zeros(n, parts.dtype)
    if not n or not dims:
        return index, error
    first = np.concatenate([[0], (parts[1:] != parts[:-1]).argmax(axis=1)])
    # Rows where the nodes of each depth begin.
    begins = [np.flatnonzero(first <= depth) for depth in range(dims)]
    begins[0] = begins[0] if n == 1 else np.flatnonzero(np.concatenate([[True], parts[1:, 0] != parts[:-1, 0]]))
    stack = [(0, 0, len(begins[0]), np.zeros((1, len(entries)), parts.dtype), np.zeros(1, np.int64))]
    while stack:
        depth, low, high, above, parents = stack.pop()
        if high - low > NODES:
            stack.append((depth, low + NODES, high, above, parents))
            high = low + NODES
        rows = begins[depth][low:high]
        away = parts[rows, depth][:, None] - entries[:, depth]
        away *= away
        away += above[np.searchsorted(parents, rows, "right") - 1]
        if depth == dims - 1:
            index[rows] = away.argmin(axis=1)
            error[rows] = away[np.arange(len(rows)), index[rows]]
        else:
            end = begins[depth][high] if high < len(begins[depth]) else n
            inner = begins[depth + 1]
            stack.append((depth + 1, *np.searchsorted(inner, [rows[0], end]).tolist(), away, rows))
    return index, error


@dataclass
class Cut:
    """How vectors become whole numbers, parts and bytes: ``bounds`` of the parts, ``width`` bytes a component.

    The bytes of a part sort as its numbers do, component by component.
    """

    length: int
    scale: int
    parts: int
    wide: bool

    @property
    def bounds(self) -> list[int]:
        return [part * self.length // self.parts for part in range(self.parts + 1)]

    @property
    def width(self) -> int:
        return 8 if self.wide else 4

    def scaled(self, vectors: pa.ListArray) -> np.ndarray:
        flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        return np.floor(flat * self.scale).astype(np.int64).reshape(-1, self.length)

    def packed(self, numbers: np.ndarray) -> np.ndarray:
        """Rows of numbers as rows of bytes."""
        if not numbers.shape[1]:
            return np.zeros(len(numbers), "V1")
        bias = np.uint64(1 << (8 * self.width - 1))
        raw = (numbers.astype(np.uint64) + bias).astype(f">u{self.width}")
        return np.ascontiguousarray(raw).view(f"V{self.width * numbers.shape[1]}").ravel()

    def numbers(self, packed: np.ndarray, dims: int) -> np.ndarray:
        """Rows of bytes back as rows of numbers to calculate with."""
        if not dims:
            return np.zeros((len(packed), 0), np.int64)
        raw = np.ascontiguousarray(packed).view(f">u{self.width}").reshape(-1, dims)
        found = (raw.astype(np.uint64) - np.uint64(1 << (8 * self.width - 1))).astype(np.int64)
        return found.astype(object) if self.wide else found

    def dims(self, part: int) -> int:
        return self.bounds[part + 1] - self.bounds[part]


def _binary(packed: np.ndarray) -> pa.Array:
    offsets = np.arange(len(packed) + 1, dtype=np.int32) * packed.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(packed), [None, pa.py_buffer(offsets), pa.py_buffer(packed.tobytes())])


def _fixed(column: pa.Array) -> np.ndarray:
    """A column of equally long byte strings as one array."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    texts = column.to_pylist()
    return np.frombuffer(b"".join(texts), f"V{len(texts[0])}")


def distinct_parts(rows: DataFrame, vector: str, cut: Cut) -> DataFrame:
    """(position, part, weight): each distinct part once, with the number of vectors that hold it, in lexicographic runs.

    Equal parts are added up before they move, batch by batch, so copies of one vector are a row per batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = cut.scaled(batch.column(0))
            for part in range(cut.parts):
                packed = cut.packed(numbers[:, cut.bounds[part] : cut.bounds[part + 1]])
                found, counts = np.unique(packed, return_counts=True)
                place = pa.array(np.full(len(found), part, np.int32))
                yield pa.RecordBatch.from_arrays([place, _binary(found), pa.array(counts)], ["position", "part", "weight"])

    parts = rows.select(vector).mapInArrow(run, "position int, part binary, weight long")
    # Dealt by range, equal parts meet and neighbours stay together: the sum needs no further shuffle.
    return (
        parts.repartitionByRange("position", "part")
        .groupBy("position", "part")
        .agg(F.sum("weight").alias("weight"))
        .sortWithinPartitions("position", "part")
    )


def refitted(distinct: DataFrame, cut: Cut, books: list[np.ndarray]) -> list[np.ndarray]:
    """Every part to its nearest entry, every entry to the floor of the mean of its parts; an entry without parts stays.

    A task adds up its own runs; the sums that leave it are as many as the codebooks have numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(book.shape, object) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            positions = batch.column(0).to_numpy()
            weights = batch.column(2).to_numpy()
            for part in np.unique(positions).tolist():
                held = np.flatnonzero(positions == part)
                packed = _fixed(batch.column(1).take(pa.array(held)))
                order = np.argsort(packed, kind="stable")
                numbers = cut.numbers(packed[order], cut.dims(part))
                index, _ = nearest_entries(numbers, books[part])
                weight = weights[held][order]
                np.add.at(counts[part], index, weight)
                added = np.zeros(books[part].shape, numbers.dtype)
                np.add.at(added, index, numbers * weight[:, None])
                sums[part] += added
        for part, count in enumerate(counts):
            used = np.flatnonzero(count)
            totals = [[Decimal(int(x)) for x in sums[part][entry]] for entry in used]
            arrays = [
                pa.array(np.full(len(used), part, np.int32)),
                pa.array(used.astype(np.int32)),
                pa.array(count[used]),
                pa.array(totals, pa.list_(pa.decimal128(38, 0))),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["position", "entry", "n", "totals"])

    sums = distinct.mapInArrow(run, "position int, entry int, n long, totals array<decimal(38,0)>")
    summed = (
        sums.select("position", "entry", "n", F.posexplode("totals").alias("dim", "total"))
        .groupBy("position", "entry", "dim")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    moved = [book.copy() for book in books]
    for position, entry, dim, n, total in summed.collect():  # as many rows as the codebooks have numbers
        moved[position][entry, dim] = int(total) // n
    return moved


@dataclass
class Codebooks:
    cut: Cut
    books: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all numbers by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(int(x)) for book in self.books for x in book.ravel()).encode()).hexdigest()


def fit(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks of the usable vectors, ``None`` without any.

    They start as the parts of the vectors with the smallest keys (NULL last,
    ties by vector, a row each) and are refitted ``rounds`` times over all
    vectors of those vectors' length.
    """
    kept = rows.select(F.col(key).alias("key"), F.col(vector).alias("vector")).filter(usable(F.col("vector"), scale))
    first = kept.orderBy(F.col("key").asc_nulls_last(), "vector").limit(1).collect()
    if not first:
        return None
    length = len(first[0].vector)
    kept = kept.filter(F.size("vector") == length)
    seeds = kept.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).collect()
    largest = kept.agg(F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))).first()[0]
    cut = Cut(length, scale, parts, largest * scale >= WIDE - 1)
    numbers = np.floor(np.array([row.vector for row in seeds], np.float64) * scale).astype(np.int64)
    numbers = numbers.astype(object) if cut.wide else numbers
    books = [numbers[:, a:b] for a, b in zip(cut.bounds, cut.bounds[1:])]
    distinct = written(distinct_parts(kept, "vector", cut), "vector-parts")
    for _ in range(rounds):
        books = refitted(distinct, cut, books)
    return Codebooks(cut, books)


def encode(rows: DataFrame, fitted: Codebooks | None, vector: str = "embedding") -> DataFrame:
    """Usable rows of the fitted length, without the vector, with ``code`` and ``error``.

    ``code`` has two hexadecimal digits (more, if there are over 256 entries) a
    part. ``error`` is the sum of the parts' squared distances, NULL if it does
    not fit in 64 bits. Vectors are coded where they are, each batch over a
    trie of its own distinct parts.
    """
    kept = [name for name in rows.columns if name != vector]
    made = T.StructType([T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    clash = {name for name in kept if name.lower() in ("code", "error")}
    if clash:
        raise ValueError(f"columns {sorted(clash)} would be there twice; rename them first")
    schema = T.StructType([rows.schema[name] for name in kept] + made.fields)
    if fitted is None:
        return rows.sparkSession.createDataFrame([], schema)
    cut, books = fitted.cut, fitted.books
    digits = max(2, len(f"{len(books[0]) - 1:x}"))
    types = [to_arrow_type(field.dataType) for field in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.schema.get_field_index(vector)
            numbers = cut.scaled(batch.column(place))
            codes, errors = [""] * len(numbers), np.zeros(len(numbers), object)
            for part in range(cut.parts):
                packed = cut.packed(numbers[:, cut.bounds[part] : cut.bounds[part + 1]])
                found, back = np.unique(packed, return_inverse=True)
                index, error = nearest_entries(cut.numbers(found, cut.dims(part)), books[part])
                codes = [code + f"{entry:0{digits}x}" for code, entry in zip(codes, index[back.ravel()].tolist())]
                errors = errors + error[back.ravel()].astype(object)
            errors = [int(error) if error < 1 << 63 else None for error in errors]
            others = [batch.column(batch.schema.get_field_index(name)) for name in kept]
            arrays = [*others, pa.array(codes), pa.array(errors, pa.int64())]
            arrays = [array.cast(kind) for array, kind in zip(arrays, types)]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    usable_rows = rows.filter(usable(F.col(vector), cut.scale) & (F.size(vector) == cut.length))
    return usable_rows.mapInArrow(run, schema)


def compressed(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", **sizes: int
) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every usable vector.

    Components become whole numbers, the floor of 1024 times their value, and
    vectors are cut into four parts (as equal as their length allows), each with
    a codebook of up to 256 entries; see ``fit`` and ``encode``. ``label_error``
    adds up the errors of equal labels, NULLs together (NULL if beyond 64 bits). Vectors that are NULL
    or empty, hold a NULL or non-finite component (or one beyond 62 bits), or
    are not as long as that with the smallest key, have no row. Rows with a
    NULL key are coded, but seed no codebook before others do; repeated rows
    are rows of their own; no vectors give no rows. Other columns are ignored.
    """
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    fitted = fit(rows, "key", "vector", **sizes)
    coded = written(encode(rows, fitted, "vector"), "vector-codes")
    totals = coded.groupBy("label").agg(F.expr("try_cast(sum(CAST(error AS decimal(38,0))) AS bigint)").alias("label_error"))
    totals = written(totals.withColumnRenamed("label", "of"), "label-errors")
    found = coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left")
    digest = F.lit(fitted.digest() if fitted else None).cast("string")
    return found.select(F.col("key").alias(key), "code", "error", "label_error", digest.alias("codebooks_sha256"))
