"""Collision-counting neighbours against brute force."""

import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import neighbours, queries

FOLDER = "/root/testdata/sf0.01"


def frame(spark, rows):
    rows = [(key, vector, 1, "x") for key, vector in rows]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, id int, score string")


def brute(rows, queries_, k):
    out = {}
    for key, vector in queries_:
        others = [(-sum(a * b for a, b in zip(vector, v)), n) for n, v in rows if n != key and len(v) == len(vector)]
        out[key] = [n for _, n in sorted(others)[:k]]
    return out


def test_recall_and_scores_on_a_whole_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    vectors = {row.vec_id: np.array(row.embedding, np.float64) for row in rows}
    found = {}
    for row in queries.op1_nearest_neighbours(spark, FOLDER).collect():
        found.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    assert set(found) == {key for key in vectors if key % 20 == 0}
    hits = 0
    for query, listed in found.items():
        listed.sort()
        assert [rank for rank, _, _ in listed] == list(range(1, 21))
        assert [(-s, v) for _, v, s in listed] == sorted((-s, v) for _, v, s in listed)
        for _, other, score in listed:
            assert score == pytest.approx(float(vectors[query] @ vectors[other]), rel=1e-12)
        exact = sorted((-float(vectors[query] @ v), key) for key, v in vectors.items() if key != query)[:20]
        hits += len({key for _, key in exact} & {key for _, key, _ in listed})
    assert hits / (20 * len(found)) >= 0.95


def test_recall_over_several_blocks_and_norms(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", 300)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 20)
    random = np.random.RandomState(5)
    centres = random.standard_normal((20, 16))
    data = centres[random.randint(0, 20, 1500)] + 0.5 * random.standard_normal((1500, 16))
    data *= random.uniform(0.2, 5, (1500, 1))
    rows = [(n, vector.tolist()) for n, vector in enumerate(data)]
    vectors = frame(spark, rows)
    exact = brute(rows, rows[::25], 10)
    found = {}
    for row in neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 25 == 0), 10).collect():
        found.setdefault(row.query_id, []).append(row.vec_id)
    assert sum(len(set(exact[key]) & set(found[key])) for key in exact) / (10 * len(exact)) >= 0.95
    assert all(len(listed) == 10 and key not in listed for key, listed in found.items())


TABLES = [("sf0.1", 0.4), ("check_s", 0.2), ("check_h", 0.2)]


@pytest.mark.parametrize("table, most", [found for found in TABLES if Path(f"/root/testdata/{found[0]}").exists()])
def test_few_vectors_are_verified(spark, table, most):
    """Recall, and the share of all vectors that is verified, which falls with size, with the bound of another block."""
    rows = spark.read.parquet(f"/root/testdata/{table}/embeddings.parquet").filter(neighbours.usable(F.col("embedding"))).collect()
    ids, vectors = np.array([row.vec_id for row in rows]), np.array([row.embedding for row in rows], np.float64)
    largest = float(np.linalg.norm(vectors, axis=1).max()) * (1 + 1e-12)
    block = neighbours.Block(ids, vectors, largest)
    asked = np.flatnonzero(ids % 20 == 0)[:150]
    hits, bounds = 0, np.empty(len(asked))
    exact = {}
    for n, at in enumerate(asked):
        products = vectors @ vectors[at]
        others = np.flatnonzero((np.arange(len(ids)) != at) & (np.arange(len(ids)) % 2 == 0))
        bounds[n] = np.sort(products[others])[-20]
        exact[ids[at]] = sorted((-products[j], ids[j]) for j in np.flatnonzero(ids != ids[at]))[:20]
    found = {}
    for query, other, score in block.nearest(ids[asked], vectors[asked], bounds, 20):
        found.setdefault(query, []).append(score)
    for query, best in exact.items():
        hits += sum(score >= -best[-1][0] - 1e-9 for score in found.get(query, []))
    assert hits / (20 * len(asked)) >= 0.95
    assert block.verified / (len(asked) * len(ids)) < most


@pytest.mark.parametrize("dims", [1, 2, 9, 64, 65, 200])
def test_directions_are_at_right_angles(dims):
    lines = neighbours.directions(dims)
    assert len(lines) >= neighbours.PROJECTIONS
    first = lines[: min(dims, neighbours.PROJECTIONS)]
    assert np.allclose(first @ first.T, dims * np.eye(len(first)))


def test_copies_tie_by_key(spark):
    rows = [(n, [1.0, 2.0, 3.0]) for n in range(40, 0, -1)] + [(100, [-1.0, 0.0, 0.5])]
    vectors = frame(spark, rows)
    found = neighbours.nearest(vectors, vectors.filter("vec_id = 7"), 5).orderBy("rank").collect()
    assert [row.vec_id for row in found] == [1, 2, 3, 4, 5]
    assert {row.score for row in found} == {14.0}


def test_odd_vectors_take_no_part(spark):
    good = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [-1.0, 0.1]), (4, [1.0, 0.0, 0.0]), (2, [0.5, 0.5]), (2, [9.0, 9.0])]
    odd = [(5, None), (6, []), (7, [0.0, 0.0]), (8, [1.0, None]), (9, [math.nan, 1.0]), (10, [math.inf, 1.0]), (None, [1.0, 1.0])]
    vectors = frame(spark, good + odd)
    found = {}
    for row in neighbours.nearest(vectors, vectors, 20).collect():
        found.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    assert {key: sorted(listed) for key, listed in found.items()} == {
        1: [(1, 2, 0.5), (2, 3, -1.0)],
        2: [(1, 1, 0.5), (2, 3, -0.45)],
        3: [(1, 2, -0.45), (2, 1, -1.0)],
    }


def test_no_rows(spark):
    none, one = frame(spark, []), frame(spark, [(1, [1.0])])
    assert neighbours.nearest(none, none).collect() == []
    assert neighbours.nearest(one, one).collect() == []
    assert neighbours.nearest(none, one).collect() == []
