"""Nearest neighbours by inner product with collision-counting hashing."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import written


# Vectors in a block, with its own sorted projections, and queries that go over it together.
BLOCK_VECTORS = 16384
BLOCK_QUERIES = 8192
PROJECTIONS = 65
# Share of the projections that a vector must collide in to be verified.
COLLISIONS = 0.82
# Windows reach this many radii to either side of the query; radii grow by this factor from this start (of a diameter of 2).
REACH = 1.5
GROWTH = 1.2
FIRST_RADIUS = 0.6
SEED = 97


def usable(vector: Column) -> Column:
    """Not NULL, not zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def directions(dims: int) -> np.ndarray:
    """Random directions at right angles to each other, of length sqrt(dims); several such bases if ``dims`` is small.

    The squares of a difference's projections on a basis add up to its squared
    length (times ``dims``), so counts scatter less than over independent
    directions.
    """
    random = np.random.RandomState(SEED)
    if dims >= PROJECTIONS:
        return np.linalg.qr(random.standard_normal((dims, PROJECTIONS)))[0].T * math.sqrt(dims)
    bases = [np.linalg.qr(random.standard_normal((dims, dims)))[0] for _ in range(math.ceil(PROJECTIONS / dims))]
    return np.concatenate(bases) * math.sqrt(dims)


class Block:
    """A block's vectors on the unit sphere of one more dimension, and one sorted array per projection.

    With every vector scaled by the largest norm and a last component that
    fills it up to length one, the nearest point to a query's direction is the
    vector with the largest inner product.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float):
        self.ids, self.vectors, self.largest = ids, vectors, largest
        scaled = vectors / largest
        rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", scaled, scaled)))
        points = np.column_stack([scaled, rest])
        self.lines = directions(points.shape[1])
        self.need = math.ceil(COLLISIONS * len(self.lines))
        projected = self.lines @ points.T
        self.order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, axis=1)
        self.verified = 0  # vectors verified so far, over all queries

    def _windows(self, centres: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last places of each query's (row's) window in every projection."""
        low = np.empty(centres.shape, np.int32)
        high = np.empty_like(low)
        for p, line in enumerate(self.sorted):
            low[:, p] = np.searchsorted(line, centres[:, p] - reach)
            high[:, p] = np.searchsorted(line, centres[:, p] + reach, "right")
        return low, high

    def nearest(
        self, ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int
    ) -> list[tuple[int, int, float]]:
        """(query, vector, inner product) of up to ``k`` nearest found for each query.

        ``bounds`` are inner products that a query's neighbours have at least,
        known from elsewhere; its windows open to that radius at once. Without
        one (NaN) they widen radius by radius, and a step scans only what it
        adds on either side, until ``k`` verified vectors lie within the radius
        or, beyond the sphere's diameter, all vectors are verified. Whatever has
        collided in enough projections is verified, without a limit.
        """
        norms = np.linalg.norm(queries, axis=1)
        centres = (queries / norms[:, None]) @ self.lines[:, :-1].T
        # Rounding must not put a bound's own vector outside its radius.
        radii = np.sqrt(np.maximum(0, 2 - 2 * bounds / (norms * self.largest))) + 1e-9
        known = radii < 2
        low, high = self._windows(centres, REACH * np.where(known, radii, 0))
        growing = FIRST_RADIUS * GROWTH ** np.arange(math.ceil(math.log(2 / FIRST_RADIUS, GROWTH)))
        unknown = np.flatnonzero(~known)
        steps = [self._windows(centres[unknown], np.full(len(unknown), REACH * radius)) for radius in growing]
        of_unknown = {at: n for n, at in enumerate(unknown.tolist())}
        found = []
        for at in range(len(queries)):
            own = self.ids == ids[at]
            if at in of_unknown:
                windows = [(a[of_unknown[at]], b[of_unknown[at]]) for a, b in steps]
                rows, scores = self._widening(own, queries[at], norms[at], windows, growing, k)
            else:
                rows = np.flatnonzero((self._collisions(low[at], high[at]) >= self.need) & ~own)
                scores = np.einsum("ij,j->i", self.vectors[rows], queries[at])
                slack = 1e-9 * norms[at] * self.largest
                rows, scores, verified = rows[scores >= bounds[at] - slack], scores[scores >= bounds[at] - slack], len(rows)
                self.verified += verified
            if len(rows) > k:  # anything within rounding of the k-th best
                rows = rows[scores >= np.partition(scores, -k)[-k] - 1e-9 * norms[at] * self.largest]
            # Summed along each row, so that equal vectors have equal scores.
            scores = (self.vectors[rows] * queries[at]).sum(axis=1)
            best = np.lexsort((self.ids[rows], -scores))[:k]
            found += [(int(ids[at]), int(self.ids[rows[b]]), float(scores[b])) for b in best]
        return found

    def _collisions(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """In how many projections each vector lies within the window; what is shorter is scanned, its inside or its outside."""
        n = len(self.ids)
        inside = [(line, a, b) for line, a, b in zip(self.order, low.tolist(), high.tolist())]
        if 2 * int((high - low).sum()) <= n * len(self.lines):
            return np.bincount(np.concatenate([line[a:b] for line, a, b in inside]), minlength=n)
        outside = [part for line, a, b in inside for part in (line[:a], line[b:])]
        return len(self.lines) - np.bincount(np.concatenate(outside), minlength=n)

    def _widening(
        self, own: np.ndarray, query: np.ndarray, norm: float, windows: list, radii: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Verified vectors and their inner products, by virtual rehashing from radius to radius."""
        n = len(self.ids)
        counts, verified = np.zeros(n, np.int64), own.copy()
        wanted = min(k, n - int(own.sum()))
        rows, scores, near = [np.zeros(0, np.int64)], [np.zeros(0)], np.zeros(0)
        for step in range(len(radii) + 1 if wanted else 0):
            if step == len(radii):
                new = np.flatnonzero(~verified)
            else:
                low, high = windows[step]
                if step == 0:
                    added = [line[a:b] for line, a, b in zip(self.order, low.tolist(), high.tolist())]
                else:
                    before = zip(self.order, low.tolist(), windows[step - 1][0].tolist(), windows[step - 1][1].tolist(), high.tolist())
                    added = [part for line, a, b, c, d in before for part in (line[a:b], line[c:d])]
                counts += np.bincount(np.concatenate(added), minlength=n)
                new = np.flatnonzero((counts >= self.need) & ~verified)
            if len(new):
                verified[new] = True
                self.verified += len(new)
                products = np.einsum("ij,j->i", self.vectors[new], query)
                rows.append(new)
                scores.append(products)
                near = np.concatenate([near, 2 - 2 * products / (norm * self.largest)])
            if step < len(radii) and (near <= radii[step] * radii[step]).sum() >= wanted:
                break
        return np.concatenate(rows), np.concatenate(scores)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the ``k`` nearest found rows of ``vectors``.

    Nearness is the largest inner product, in double precision on the original
    vectors; ties go to the smaller key. A query's own key is no candidate, and
    only vectors of the query's length are. Vectors that are NULL, empty, zero
    or hold NULL or non-finite components, and rows with a NULL key, take no
    part; a key that repeats counts once, with its smallest vector. Queries with
    no candidates have no rows. Other columns are ignored.

    Vectors are dealt into blocks by hash and a block's sorted arrays are built
    once for up to ``BLOCK_QUERIES`` queries. First a query goes over the block
    that its own key falls into; its ``k``-th best there bounds all others, in
    which only what reaches the bound is looked for and returned. Copies of one
    vector spread over the blocks.
    """

    def clean(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
        return rows.groupBy("id").agg(F.min("vector").alias("vector"))

    base, asked = written(clean(vectors), "vectors"), written(clean(queries), "query-vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    total, largest = base.agg(F.count(F.lit(1)), F.max(norm)).first()
    n_asked = asked.count()
    blocks = max(1, math.ceil(total / BLOCK_VECTORS))
    largest = (largest or 1.0) * (1 + 1e-12)

    def place(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))

    def search(block: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if block.empty or group.empty:
            return pd.DataFrame({name: [] for name in names})
        held = Block(block["id"].to_numpy(np.int64), np.array(block["vector"].tolist(), np.float64), largest)
        rows = np.array(group["vector"].tolist(), np.float64)
        bounds = group["bound"].to_numpy(np.float64, na_value=np.nan)
        return pd.DataFrame(held.nearest(group["id"].to_numpy(np.int64), rows, bounds, k), columns=names)

    dealt = base.select("id", "vector", F.size("vector").alias("length"), place(blocks, 0).alias("block"))

    def over_blocks(rows: DataFrame, groups: int) -> DataFrame:
        """Queries (with the ``block`` to go over) in so many groups, each with a copy of its blocks."""
        numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
        keys = ["length", "block", "group"]
        asking = rows.select("id", "vector", F.size("vector").alias("length"), "block", place(groups, 1).alias("group"), "bound")
        copies = dealt.withColumn("group", numbers).groupBy(*keys)
        return copies.cogroup(asking.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")

    home = asked.withColumn("block", place(blocks, 0)).withColumn("bound", F.lit(None).cast("double"))
    found = written(over_blocks(home, max(1, math.ceil(n_asked / blocks / BLOCK_QUERIES))), "neighbours-at-home")
    if blocks > 1:
        bounds = found.groupBy(F.col("query_id").alias("id")).agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound")
        )
        others = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
        away = asked.join(bounds, "id", "left").withColumn("block", others).filter(F.col("block") != place(blocks, 0))
        found = found.unionByName(over_blocks(away, max(1, math.ceil(n_asked / BLOCK_QUERIES))))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
