"""Approximate nearest neighbours by collision counting over query-centred windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Projections, the share of them that must collide, and the growth of the radius.
PROJECTIONS = 48
THRESHOLD = 0.72
GROWTH = 1.4
# Share of a block that the first windows hold; beginning wider only verifies more.
_FIRST_SHARE = 0.05
# Width of a window at radius 1: near points fall inside in 83 % of the projections.
_WIDTH = 2.72
# Vectors indexed together.
BLOCK_VECTORS = 8192


class Index:
    """Sorted single projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 0) -> None:
        self.ids, self.vectors = ids, vectors
        rng = np.random.default_rng([seed, vectors.shape[1]])
        self.lines = rng.standard_normal((vectors.shape[1], PROJECTIONS))
        values = vectors @ self.lines
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.values = np.sort(values, axis=0).T.copy()
        self.scale = float(np.abs(values).max(initial=0.0))
        # All sorted arrays in one, each shifted past the one before, to look up all windows at once.
        self.shift = (4 * self.scale + 1) * np.arange(PROJECTIONS)
        self.flat = (self.values + self.shift[:, None]).ravel()
        self.begin = len(ids) * np.arange(PROJECTIONS)

    def nearest(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the ``k`` nearest found, ties to the smaller id; never ``own``.

        At radius R a vector collides on a projection if it lies within half a window
        of R from the query there. Growing R widens every window on both sides, and only
        what comes in is counted. A vector that has collided often enough is verified on the
        original vectors. The search ends when ``k`` verified ones are no farther than R, or
        when all vectors are verified.
        """
        n = len(self.ids)
        centre = query @ self.lines
        at = self._rank(centre, "left")
        low, high = at.copy(), at.copy()
        counts = np.zeros(n, np.int32)
        verified = self.ids == own
        wanted = min(k, n - int(verified.sum()))
        ids, distances = np.zeros(0, np.int64), np.zeros(0)
        radius, slack = self._first_radius(centre, at, wanted), 1e-9 * (self.scale + 1e-300)
        needed = int(np.ceil(THRESHOLD * PROJECTIONS))
        while wanted and not verified.all():
            half = _WIDTH * radius / 2 + slack
            came = []
            new_low = np.minimum(low, self._rank(centre - half, "left"))
            new_high = np.maximum(high, self._rank(centre + half, "right"))
            for order, a, b, c, d in zip(
                self.order, new_low.tolist(), low.tolist(), high.tolist(), new_high.tolist(), strict=True
            ):
                came += [order[a:b], order[c:d]]
            low, high = new_low, new_high
            counts += np.bincount(np.concatenate(came), minlength=n).astype(np.int32)
            found = np.flatnonzero((counts >= needed) & ~verified)
            if len(found):
                verified[found] = True
                apart = self.vectors[found] - query
                ids = np.concatenate([ids, self.ids[found]])
                distances = np.concatenate([distances, np.sqrt(np.square(apart).sum(axis=1))])
                best = np.lexsort((ids, distances))[:k]
                ids, distances = ids[best], distances[best]
            if len(ids) >= wanted and distances[wanted - 1] <= radius:
                break
            radius = radius * GROWTH if radius else 1e-3 * self.scale
        return ids, distances

    def _rank(self, points: np.ndarray, side: str) -> np.ndarray:
        """Where one point per projection stands in its sorted array."""
        bound = 2 * self.scale + 0.25
        found = np.searchsorted(self.flat, np.clip(points, -bound, bound) + self.shift, side)
        return np.clip(found - self.begin, 0, len(self.ids))

    def _first_radius(self, centre: np.ndarray, at: np.ndarray, k: int) -> float:
        """Where typical windows hold a small share of the vectors, at least ``k``."""
        n = len(self.ids)
        k = max(k, int(_FIRST_SHARE * n))
        gaps = []
        for values, c, i in zip(self.values, centre, at, strict=True):
            around = np.abs(values[max(0, i - k) : min(n, i + k)] - c)
            gaps.append(np.sort(around)[min(k, len(around)) - 1] if len(around) else 0.0)
        return 2 / _WIDTH * float(np.median(gaps))


def _usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    big = F.lit(float("inf"))
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x < big) & (x > -big)
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_vectors: int = BLOCK_VECTORS,
    seed: int = 0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` nearest vectors found.

    The score is the Euclidean distance in double precision; ties go to the smaller
    id. Vectors are dealt by hash into blocks of bounded size. A block is shuffled and indexed
    once; the queries then stream past it, so a task holds one block and one batch of queries
    whatever the number of either. Only queries are sent more than once, to every block; the best
    of each block meet per query. Queries and vectors are compared only if they have the same
    length. A row is no neighbour of a query of its own id.

    Rows without an id, and vectors that are null, empty, zero or hold a null or non-finite
    component, take no part. Repeated query rows are answered once; repeated vectors are
    found as often as they occur. Empty tables give an empty result. Columns
    other than the two named are not carried.
    """
    rows, asked = (
        df.filter(F.col(id_column).isNotNull() & _usable(F.col(vector_column))).select(
            F.col(id_column).cast("long").alias("id"),
            F.transform(vector_column, lambda x: x.cast("double")).alias("vector"),
            F.size(vector_column).alias("length"),
        )
        for df in (vectors, queries)
    )
    asked = asked.distinct()
    n_blocks = max(1, -(-rows.count() // block_vectors))
    block = F.pmod(F.xxhash64(F.lit("block"), "id", "vector"), F.lit(n_blocks))
    data = rows.select(
        "*", F.lit(0).alias("asked"), F.lit(0).cast("long").alias("mark"), block.alias("block")
    )
    wanted = asked.select(
        "*",
        F.lit(1).alias("asked"),
        F.xxhash64("vector").alias("mark"),
        F.explode(_numbers(n_blocks)).alias("block"),
    )

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _search(frames, k, seed)

    near = (
        data.unionByName(wanted)
        .repartitionById(n_blocks, F.col("block").cast("int"))
        .sortWithinPartitions("length", "block", "asked", "id")
        .mapInPandas(search, "query_id long, mark long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id", "mark").orderBy("score", "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search(frames: Iterator[pd.DataFrame], k: int, seed: int) -> Iterator[pd.DataFrame]:
    """Rows come by (length, block), the vectors of each before its queries."""
    at, kept, index = None, [], None
    for frame in frames:
        for (length, block, asked), part in frame.groupby(["length", "block", "asked"], sort=True):
            if at != (length, block):
                at, kept, index = (length, block), [], None
            if not asked:
                kept.append((part["id"].to_numpy(np.int64), np.stack(part["vector"].to_numpy())))
                continue
            if index is None:
                if not kept:
                    continue
                ids = np.concatenate([i for i, _ in kept])
                vectors = np.concatenate([v for _, v in kept]).astype(np.float64)
                order = np.argsort(ids, kind="stable")
                index, kept = Index(ids[order], vectors[order], seed), []
            yield _answers(index, part, k)


def _answers(index: Index, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    found = []
    for own, mark, query in zip(queries["id"], queries["mark"], queries["vector"], strict=True):
        ids, distances = index.nearest(int(own), np.asarray(query, np.float64), k)
        found.append(
            pd.DataFrame(
                {"query_id": int(own), "mark": int(mark), "vec_id": ids, "score": distances}
            )
        )
    return pd.concat(found)
