"""Benchmark items inside documents: size-partitioned MinHash containment search, verified on exact shingles."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import forget, free_name, map_texts, text_runs
from tagloom.session import new_folder, written

# Items are sent to the tasks in blocks of about so many characters, or one longer item.
BLOCK_CHARS = 4_000_000
FILTER_BITS = 22
CANDIDATES_REMEMBERED = 2_000
REMEMBERED = 300_000
WORD = re.compile(r"\w+")
POWER = 0x9E3779B97F4A7C15


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return WORD.findall(text.lower())


def rolled(numbers: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` word hashes."""
    n = len(numbers) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for at in range(k):
        out = out * np.uint64(POWER) + numbers[at : at + n]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


class SizeClass:
    """Sketches of the items of one size class: which items hold a hash, and how many of its own an item needs."""

    def __init__(self, sketches: list[tuple[int, list[int], int]]):
        held = sorted((value, at) for at, (_, sketch, _) in enumerate(sketches) for value in sketch)
        values, self.holders = np.array([v for v, _ in held], np.uint64), np.array([at for _, at in held], np.int64)
        self.items = np.array([item for item, _, _ in sketches], np.int64)
        self.needs = np.array([need for _, _, need in sketches], np.int64)
        self.values, firsts = np.unique(values, return_index=True)
        self.bounds = np.append(firsts, len(values))

    def among(self, values: np.ndarray) -> np.ndarray:
        """Places of the hashes that some item of the class has sketched."""
        at = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        return np.unique(at[self.values[at] == values])

    def candidates(self, places: np.ndarray) -> list[int]:
        """Items with as many of their sketched hashes among these as they need."""
        holders = np.concatenate([self.holders[self.bounds[at] : self.bounds[at + 1]] for at in places.tolist()])
        shared = np.bincount(holders, minlength=len(self.items))
        return self.items[shared >= self.needs].tolist()


class ItemIndex:
    """A block of items, partitioned by size, with a MinHash sketch of each item.

    The size of an item is its number of different shingles. Partitions are
    bounded by powers of two. A sketch holds the item's smallest shingle hashes:
    as many as an item of the partition's upper size may miss, and an eighth of
    that size more (one at least). An item contained to the threshold has all
    but what it may miss of them in the document, so the larger the class, the
    more hashes must be found, and no contained item is lost. Items with fewer
    words than a shingle have one shingle, all of their words, in partitions of
    their own. Shingles themselves are worked out for candidates only.
    """

    def __init__(self, items: list[tuple[int, str]], shingle: int, threshold: float):
        self.shingle, self.threshold = shingle, threshold
        self.names: list[int] = []
        self.texts: list[str] = []
        self.lengths: list[int] = []
        hashes = _Hashes()
        sketches: dict[tuple[int, int], list[tuple[int, list[int], int]]] = defaultdict(list)
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            k = min(shingle, len(words))
            different = len({tuple(words[at : at + k]) for at in range(len(words) - k + 1)})
            values = np.unique(rolled(np.array([hashes[word] for word in words], np.uint64), k)).tolist()
            upper = (1 << different.bit_length()) - 1
            sketch = values[: self._may_miss(upper) + max(1, upper // 8)]
            sketches[k, different.bit_length()].append((len(self.names), sketch, len(sketch) - self._may_miss(different)))
            self.names.append(name)
            self.texts.append(text)
            self.lengths.append(k)
        self.classes = {size: SizeClass(found) for size, found in sketches.items()}
        self.filters = {}
        for (k, _), held in self.classes.items():
            seen = self.filters.setdefault(k, np.zeros(1 << FILTER_BITS, bool))
            seen[(held.values >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.known: dict[int, dict[tuple[str, ...], int]] = {}

    def _may_miss(self, n: int) -> int:
        return int((1 - self.threshold) * n + 1e-9)

    def shingles(self, at: int, hashes: _Hashes) -> dict[tuple[str, ...], int]:
        """Hash of each different shingle of an item; those last asked for are remembered."""
        if at not in self.known:
            forget(self.known, CANDIDATES_REMEMBERED)
            words, k = words_of(self.texts[at]), self.lengths[at]
            values = rolled(np.array([hashes[word] for word in words], np.uint64), k).tolist()
            self.known[at] = dict(zip((tuple(words[n : n + k]) for n in range(len(words) - k + 1)), values))
        return self.known[at]

    def walk(self, text: str, hashes: _Hashes, lengths: list[int]) -> Iterator[tuple[int, list[str], np.ndarray]]:
        """(shingle length, words, hash of the shingle at each word) of a whole text, piece by piece."""
        longest, carried = max(lengths), []
        for run in text_runs(text):
            words = carried + words_of(run)
            numbers = np.array([hashes[word] for word in words], np.uint64)
            for k in lengths:
                # Shorter shingles that lie wholly in what was carried over were seen before: finding them twice is harmless.
                yield k, words, rolled(numbers, k)
            carried = words[max(0, len(words) - longest + 1) :]

    def candidates(self, text: str, hashes: _Hashes) -> list[int]:
        """Items of every size class that share enough sketched shingles with the text."""
        places: dict[tuple[int, int], list[np.ndarray]] = defaultdict(list)
        for k, _, values in self.walk(text, hashes, list(self.filters)):
            likely = values[self.filters[k][(values >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]]
            if len(likely):
                for size, held in self.classes.items():
                    if size[0] == k and len(found := held.among(likely)):
                        places[size].append(found)
        found = [self.classes[size].candidates(np.unique(np.concatenate(parts))) for size, parts in places.items()]
        return sorted(at for items in found for at in items)

    def contained(self, text: str, hashes: _Hashes) -> list[tuple[int, int, int]]:
        """(item, its shingles, those found in the text) of every item contained to the threshold."""
        if not self.classes:
            return []
        candidates = self.candidates(text, hashes)
        if not candidates:
            return []
        own = {at: self.shingles(at, hashes) for at in candidates}
        wanted: dict[int, set[int]] = defaultdict(set)
        for at in candidates:
            wanted[self.lengths[at]].update(own[at].values())
        sought = {k: np.array(sorted(values), np.uint64) for k, values in wanted.items()}
        present: dict[int, set[tuple[str, ...]]] = defaultdict(set)
        for k, words, values in self.walk(text, hashes, list(sought)):
            at = np.minimum(np.searchsorted(sought[k], values), len(sought[k]) - 1)
            for place in np.flatnonzero(sought[k][at] == values).tolist():
                present[k].add(tuple(words[place : place + k]))
        out = []
        for at in candidates:
            shared = sum(shingle in present[self.lengths[at]] for shingle in own[at])
            if shared >= self.threshold * len(own[at]) - 1e-9:
                out.append((self.names[at], len(own[at]), shared))
        return out


def _blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[list[tuple[int, str]]]:
    rows = benchmark.select(F.col(key).cast("long"), F.coalesce(F.col(text), F.lit(""))).distinct()
    block, held = [], 0
    for name, value in rows.toLocalIterator():  # a partition at a time
        block.append((name, value))
        held += len(value)
        if held >= BLOCK_CHARS:
            yield block
            block, held = [], 0
    if block:
        yield block


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = 5,
    threshold: float = 0.8,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(key, item_id, n_shingles, n_shared, containment) of every item contained in a document to ``threshold`` or more.

    Containment is the share of the item's different word shingles found
    anywhere in the whole document, by exact comparison of words (lower-cased
    runs of letters and digits). An item of fewer than ``shingle`` words has one
    shingle, all of its words; one without words is in no document. NULL texts
    are empty; NULL keys are carried through; a repeated item counts once and
    repeated documents are rows of their own; other columns are ignored.

    Items are the stated queries and go to the tasks in blocks of bounded size.
    A block's index passes over all documents once and its results are written
    before the next block is read, so that the driver holds one block however
    many there are; nothing is shuffled.
    """
    pairs = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("item_id", "n_shingles", "n_shared")]))
    made = T.StructType([T.StructField("items", pairs)])
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("_text"))

    def found(block: list[tuple[int, str]]) -> DataFrame:
        index = ItemIndex(block, shingle, threshold)

        def make() -> Callable[[list[str]], list[tuple]]:
            hashes = _Hashes()
            names = ("item_id", "n_shingles", "n_shared")
            return lambda texts: [([dict(zip(names, row)) for row in index.contained(t, hashes)],) for t in texts]

        return map_texts(rows, "_text", make, made).select("key", F.inline("items"))

    folder = new_folder(docs.sparkSession, "contained-items")
    schema = found([]).schema
    docs.sparkSession.createDataFrame([], schema).write.parquet(folder)
    for block in _blocks(benchmark, item_key, item_text):
        found(block).write.mode("append").parquet(folder)
    stored = docs.sparkSession.read.schema(schema).parquet(folder)
    return stored.select(
        F.col("key").alias(key), "item_id", "n_shingles", "n_shared",
        (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
    )


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = 5,
    threshold: float = 0.8,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text holds no item to ``threshold`` or more; see ``contained_items``.

    Rows are judged one by one, whatever their keys, keep all their columns, and nothing is shuffled: each block of
    items filters what the blocks before it have left, which is written in between.
    """
    name = free_name(docs, "_clean")
    made = T.StructType([T.StructField(name, T.BooleanType())])

    def clean(rows: DataFrame, block: list[tuple[int, str]]) -> DataFrame:
        index = ItemIndex(block, shingle, threshold)

        def make() -> Callable[[list[str]], list[tuple]]:
            hashes = _Hashes()
            return lambda texts: [(not index.contained(value, hashes),) for value in texts]

        return map_texts(rows, text, make, made, keep_text=True).filter(F.col(name)).drop(name)

    blocks = _blocks(benchmark, item_key, item_text)
    block = next(blocks, None)
    while block is not None:
        docs, block = clean(docs, block), next(blocks, None)
        docs = docs if block is None else written(docs, "decontaminated")
    return docs
