"""Merkle manifests against a tree built in one place."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tagloom.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, tree string, position int, root string"


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, arity):
    """The root, and each node's siblings (its place, the others) level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[at : at + arity] for at in range(0, len(nodes), arity)]
        for leaf, place in enumerate(places):
            run, nth = runs[place // arity], place % arity
            paths[leaf].append((nth, run[:nth] + run[nth + 1 :]))
        nodes, places = [digest(*run) for run in runs], [place // arity for place in places]
    return nodes[0], paths


def brute(rows, arity=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], leaf_of(row[:5]), row))
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    climbed = {}
    for lang in order:
        groups[lang].sort(key=lambda held: (held[0] is not None, held[0] or 0, held[1]))
        climbed[lang] = climb([leaf for _, leaf, _ in groups[lang]], arity)
    root, outer = climb([climbed[lang][0] for lang in order], arity) if order else (None, [])
    out = []
    for lang, above in zip(order, outer):
        subroot, paths = climbed[lang]
        for (key, leaf, row), inner in zip(groups[lang], paths):
            path = inner + above
            start = leaf
            if key is not None and zlib.crc32(str(key).encode()) % 7 == 0 and row[3] is not None:
                start = leaf_of([*row[:3], row[3] + 1, row[4]])
            for nth, others in path:
                start = digest(*others[:nth], start, *others[nth:])
            proof = digest(*[other for _, others in path for other in others])
            out.append((key, leaf, subroot, root, proof, start, start == root))
    return sorted(out, key=str)


def made(spark, rows, **sizes):
    frame = spark.createDataFrame([(*row, "x", 1, "y") for row in rows], COLUMNS)
    return sorted(map(tuple, merkle.manifest(frame, **sizes).collect()), key=str)


ODD = [
    (1, "a", "en", 3, "abc"), (1, "a", "en", 3, "abc"), (1, "b", "en", None, None), (None, None, None, None, None),
    (None, None, None, None, None), (2, "é", None, 1, ""), (-7, "", "", 0, "x\ny"), (3, "a", "zh", 5, "ü" * 50_000),
    (4, "a", "Ω", 5, "-"), (5, "a", "en", 5, "1:1"), (0, "a", "=en", 1, "t"),
]


@pytest.mark.parametrize("arity, block_levels", [(2, 8), (2, 1), (3, 2)])
def test_odd_rows(spark, arity, block_levels):
    assert made(spark, ODD, arity=arity, block_levels=block_levels) == brute(ODD, arity)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 8, 9, 31])
def test_sizes_around_whole_superblocks(spark, n):
    rows = [(key * 3, "s", "en", key, f"text {key}") for key in range(n)]
    assert made(spark, rows, block_levels=1) == brute(rows)


def test_many_groups_and_one_large(spark):
    rows = [(key, "s", "en" if key % 3 else f"l{key % 40}", key, f"text {key % 50}") for key in range(700)]
    found = made(spark, rows, block_levels=3)
    assert found == brute(rows)
    tampered = {key for key in range(700) if zlib.crc32(str(key).encode()) % 7 == 0}
    assert {row[0] for row in found if not row[6]} == tampered


def test_largest_and_smallest_numbers(spark):
    keys = [key for key in range(200) if zlib.crc32(str(key).encode()) % 7 == 0][:4]
    rows = [(key, "s", "en", number, "t") for key, number in zip(keys, (2**63 - 1, -(2**63), -1, 0))]
    assert made(spark, rows) == brute(rows)
    assert not any(row[6] for row in made(spark, rows))


def test_large_keys_beside_a_null(spark):
    rows = [(key, "s", "en", 1, "t") for key in (None, 2**60 + 1, 2**63 - 1, -(2**63), 2**53 + 1)]
    assert made(spark, rows) == brute(rows)


def test_does_not_depend_on_the_split(spark):
    rows = [(key % 90, "s", None if key % 5 else "de", key, "t") for key in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    one = sorted(merkle.manifest(frame.coalesce(1), block_levels=2).collect())
    assert one == sorted(merkle.manifest(frame.repartition(7, F.rand(3)), block_levels=2).collect())
