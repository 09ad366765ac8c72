"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the rest by a heap over linked bytes."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import forget, map_texts, text_runs

# Pre-tokens whose ids a task remembers at most, about 60 MB; beyond it the older half goes.
REMEMBERED = 300_000
# Characters of a text that are looked at together.
RUN_CHARS = 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 of the bytes, a blank, the rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class PerfectHash:
    """Minimal perfect hash by hash and displace: n keys in n places, a displacement for each bucket of about two.

    Large buckets are placed first. A bucket with one key names its place
    directly (negative), so the last free places are always filled.
    """

    MIX, SCATTER, MASK = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, (1 << 64) - 1

    def __init__(self, keys: list[bytes]):
        self.size = n = len(keys)
        self.buckets = max(1, n // 2)
        hashes = self.hashes(keys).tolist()
        if len(set(hashes)) < n:
            raise ValueError("keys must differ in their 64-bit hashes")
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for key, value in enumerate(hashes):
            members[value % self.buckets].append(key)
        moves, key_at = [0] * self.buckets, [-1] * n
        single = []
        for bucket in sorted(range(self.buckets), key=lambda bucket: -len(members[bucket])):
            group = members[bucket]
            if len(group) < 2:
                single += [bucket] if group else []
                continue
            move = 0
            while True:
                shift = move * self.MIX & self.MASK
                places = {((hashes[key] ^ shift) * self.SCATTER & self.MASK) >> 29 for key in group}
                places = {place % n for place in places}
                if len(places) == len(group) and all(key_at[place] < 0 for place in places):
                    break
                move += 1
            moves[bucket] = move
            for key in group:
                key_at[(((hashes[key] ^ shift) * self.SCATTER & self.MASK) >> 29) % n] = key
        for bucket, place in zip(single, [place for place in range(n) if key_at[place] < 0]):
            moves[bucket], key_at[place] = -1 - place, members[bucket][0]
        self.moves, self.key_at = np.array(moves, np.int64), np.array(key_at, np.int64)

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(key) for key in keys), np.uint64, len(keys))

    def _places(self, hashes: np.ndarray, moves: np.ndarray) -> np.ndarray:
        mixed = (hashes ^ (moves.astype(np.uint64) * np.uint64(self.MIX))) * np.uint64(self.SCATTER)
        return ((mixed >> np.uint64(29)) % np.uint64(self.size)).astype(np.int64)

    def candidates(self, keys: list[bytes]) -> np.ndarray:
        """Which key each of ``keys`` is, if it is one at all: the caller compares."""
        hashes = self.hashes(keys)
        moves = self.moves[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        places = np.where(moves < 0, -1 - moves, self._places(hashes, np.maximum(moves, 0)))
        return self.key_at[places]


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: always the lowest-ranked neighbouring pair, the leftmost of equals, from a heap over linked bytes.

    A node is the byte it starts at; ``after[i]`` is where the node ends and the
    next begins. A heap entry is void once one of its nodes has changed.
    """
    n, rank_of = len(piece), ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, i, i + 1, i + 2) for i in range(n - 1) if (rank := rank_of(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, left, middle, end = heappop(heap)
        if after[left] != middle or after[middle] != end:
            continue
        after[left], after[middle] = end, -1
        if end < n:
            before[end] = left
            rank = rank_of(piece[left : after[end]])
            if rank is not None:
                heappush(heap, (rank, left, end, after[end]))
        if left > 0:
            start = before[left]
            rank = rank_of(piece[start:end])
            if rank is not None:
                heappush(heap, (rank, start, left, end))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : after[at]]])
        at = after[at]
    return ids


class Codec:
    """Encodes and decodes texts; ``shared`` is what the driver builds once and every task gets."""

    def __init__(self, shared: tuple[list[bytes], list[int], PerfectHash, str]):
        self.tokens, self.ids, self.perfect, pattern = shared
        self.ranks = dict(zip(self.tokens, self.ids))
        self.bytes_of = dict(zip(self.ids, self.tokens))
        self.split = regex.compile(pattern).findall
        # Ids of pre-tokens seen before, as the bytes of an int32 array.
        self.known: dict[str, bytes] = {}

    @staticmethod
    def shared(path: str, pattern: str) -> tuple[list[bytes], list[int], PerfectHash, str]:
        ranks = read_ranks(path)
        tokens = list(ranks)
        missing = [value for value in range(256) if bytes([value]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing}")
        return tokens, list(ranks.values()), PerfectHash(tokens), pattern

    def _learn(self, new: list[str]) -> None:
        raw = [piece.encode() for piece in new]
        for text, piece, at in zip(new, raw, self.perfect.candidates(raw).tolist()):
            ids = [self.ids[at]] if self.tokens[at] == piece else merged(piece, self.ranks)
            self.known[text] = array("i", ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        parts = []
        for run in text_runs(text, RUN_CHARS):
            pieces = self.split(run)
            forget(self.known, REMEMBERED)
            self._learn(list(set(pieces).difference(self.known)))
            parts.append(b"".join(map(self.known.__getitem__, pieces)))
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


ENCODED = T.StructType([T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])


def encode(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, token_ids, decoded): the ids of each whole text and the bytes they decode to.

    ``vocabulary`` is a rank file, read by the driver; ``pattern`` cuts a text
    into pre-tokens, each encoded by itself. A NULL or empty text has no ids.
    NULL and repeated keys are rows like any other; other columns are ignored.
    Nothing is shuffled. A text is walked in bounded pieces cut before white
    space that follows something else, where no pre-token spans the cut.
    """
    shared = Codec.shared(vocabulary, pattern)

    def make() -> Callable[[list[str]], list[tuple]]:
        codec = Codec(shared)

        def each(texts: list[str]) -> list[tuple]:
            found = [codec.encode(value) for value in texts]
            return [(ids, codec.decode(ids)) for ids in found]

        return each

    return map_texts(docs.select(F.col(key), F.col(text).alias("_text")), "_text", make, ENCODED)


def digests(encoded: DataFrame, key: str = "doc_id", *keep: str) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of what ``encode`` gives, and the columns ``keep`` of it."""
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return encoded.select(
        key,
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *keep,
    )
