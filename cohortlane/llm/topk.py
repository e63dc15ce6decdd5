"""Exact top-k by inner product through a pivot-distance index.

Vectors become points of one distance: with M the largest norm, x goes to (x, sqrt(M^2 - |x|^2)) and a
query q to (q, 0), so the largest inner products are the smallest distances. Points are keyed by their
nearest pivot and their distance to it, range-partitioned and cut into annuli: blocks of neighbours in
that order. A query block visits the annuli from the nearest on; an annulus [low, high] around a pivot at
distance d from a query has no point nearer than d - high or low - d, and is left out once that is beyond
the query's k-th distance so far. The k best of a query's own annulus give the first such distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import Shared, Steps

#: Pivots are picked from a sample of the vectors whose ids hash lowest; every vector is indexed.
SAMPLE_ROWS = 4096
PIVOTS = 64
ANNULUS_ROWS = 512
QUERY_ROWS = 256
#: Bounds are compared with this much room for rounding.
SLACK = 1e-6


@dataclass
class Space:
    """width: numbers of a vector (shorter ones are filled with 0); most: largest squared norm."""

    width: int
    most: float
    pivots: np.ndarray

    def points(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.most - (x * x).sum(1), 0.0))
        return np.concatenate([x, rest[:, None]], 1)

    def queries(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.zeros((len(x), 1))], 1)

    def distances(self, points: np.ndarray) -> np.ndarray:
        """To every pivot: (points, pivots)."""
        square = (points * points).sum(1)[:, None] + (self.pivots * self.pivots).sum(1) - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(square, 0.0))


def pick_pivots(points: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """The point farthest from all picked so far, again and again; then a few rounds of means."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    picked = [0]
    near = ((points - points[0]) ** 2).sum(1)
    while len(picked) < min(count, len(points)) and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, ((points - points[picked[-1]]) ** 2).sum(1))
    pivots = points[picked].copy()
    for _ in range(rounds):
        square = (pivots * pivots).sum(1) - 2 * points @ pivots.T
        own = square.argmin(1)
        for k in range(len(pivots)):
            if (own == k).any():
                pivots[k] = points[own == k].mean(0)
    return pivots


def _whole_numbers(scale: float):
    """(id, list of floats) to (id, floor(scale * x) as bytes); rows without a whole vector go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, squares = [], [], []
            for key, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key is None or not vector.is_valid:
                    continue
                x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if vector.values.null_count or not np.isfinite(x).all():
                    continue
                x = np.floor(scale * x)
                square = float((x * x).sum())
                if square >= 2.0**53:
                    raise OverflowError("a vector's squared norm exceeds 2 ** 53: scores would not be exact")
                ids.append(key)
                vectors.append(x.astype(np.int64).tobytes())
                squares.append(square)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), pa.array(squares, pa.float64())],
                names=["id", "vector", "square"],
            )

    return run


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for n, v in enumerate(vectors):
        x = np.frombuffer(v, np.int64)
        out[n, : len(x)] = x
    return out


def _keyed(shared: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for batch in batches:
            if not len(batch):
                continue
            far = space.distances(space.points(_matrix(batch.column(1).to_pylist(), space.width)))
            own = far.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own.astype(np.int32)), pa.array(far[np.arange(len(far)), own])],
                names=["id", "vector", "pivot", "far"],
            )

    return run


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query: highest score, then smallest id."""
    order = np.lexsort((ids, -score, query))
    q = query[order]
    first = np.searchsorted(q, q, "left")
    return order[np.arange(len(q)) - first < k]


def _annuli(shared: Shared, every: int, k: int):
    """Sorted (id, vector, pivot, far) to blocks, with the seeds of the queries among their rows."""

    def block(pivot: int, rows: list[tuple]) -> pa.RecordBatch:
        space = shared.value
        ids = np.array([r[0] for r in rows], np.int64)
        x = _matrix([r[1] for r in rows], space.width)
        asked = np.flatnonzero(ids % every == 0)
        score = x[asked] @ x.T
        score[ids[asked][:, None] == ids[None, :]] = -np.inf
        seed = np.sort(score, 1)[:, -k] if score.shape[1] >= k else np.full(len(asked), -np.inf)
        values = [
            pivot, rows[0][3], rows[-1][3], int(ids[0]), ids.tobytes(), x.astype(np.int64).tobytes(),
            ids[asked].tobytes(), x[asked].astype(np.int64).tobytes(), seed.tobytes(),
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCK, strict=True)], schema=_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (row[2] != rows[0][2] or len(rows) == ANNULUS_ROWS):
                    yield block(rows[0][2], rows)
                    rows = []
                rows.append(row)
        if rows:
            yield block(rows[0][2], rows)

    return run


_BLOCK = pa.schema(
    [
        ("pivot", pa.int32()),
        ("low", pa.float64()),
        ("high", pa.float64()),
        ("first", pa.int64()),
        ("ids", pa.binary()),
        ("vectors", pa.binary()),
        ("asked", pa.binary()),
        ("asked_vectors", pa.binary()),
        ("seeds", pa.binary()),
    ]
)
_BLOCK_SQL = "pivot int, low double, high double, first long, ids binary, vectors binary, asked binary, asked_vectors binary, seeds binary"
_QUERY_SQL = "query_block long, asked binary, vectors binary, seeds binary, reach array<struct<pivot: int, near: double, far: double, radius: double>>"


def _query_blocks(shared: Shared):
    """Queries of neighbouring blocks together, with their range of distances to every pivot."""
    reach_type = pa.list_(
        pa.struct([("pivot", pa.int32()), ("near", pa.float64()), ("far", pa.float64()), ("radius", pa.float64())])
    )

    def block(ids: np.ndarray, vectors: np.ndarray, seeds: np.ndarray) -> pa.RecordBatch:
        space = shared.value
        x = vectors.reshape(len(ids), space.width).astype(np.float64)
        far = space.distances(space.queries(x))
        radius = np.sqrt(np.maximum((x * x).sum(1) + space.most - 2 * seeds, 0.0)).max()
        reach = [
            {"pivot": p, "near": float(far[:, p].min()), "far": float(far[:, p].max()), "radius": float(radius)}
            for p in range(far.shape[1])
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(ids[0])], pa.int64()),
                pa.array([ids.tobytes()], pa.binary()),
                pa.array([vectors.tobytes()], pa.binary()),
                pa.array([seeds.tobytes()], pa.binary()),
                pa.array([reach], reach_type),
            ],
            names=["query_block", "asked", "vectors", "seeds", "reach"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for asked, vectors, seeds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((np.frombuffer(asked, np.int64), np.frombuffer(vectors, np.int64), np.frombuffer(seeds, np.float64)))
                if sum(len(h[0]) for h in held) >= QUERY_ROWS:
                    yield block(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held = []
        if sum(len(h[0]) for h in held):
            yield block(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _search(shared: Shared, k: int):
    """Pairs of query block and annulus, sorted by query block and gap: the k best of each query so far."""
    names = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        now = None
        for batch in batches:
            for number, asked, vectors, seeds, pivot, low, high, ids, block in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if number != now:
                    if now is not None:
                        yield done(best)
                    now = number
                    queries = np.frombuffer(asked, np.int64)
                    q = np.frombuffer(vectors, np.int64).reshape(len(queries), space.width).astype(np.float64)
                    square = (q * q).sum(1)
                    far = space.distances(space.queries(q))
                    least = np.frombuffer(seeds, np.float64).copy()
                    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
                gap = np.maximum(np.maximum(low - far[:, pivot], far[:, pivot] - high), 0.0)
                radius = np.sqrt(np.maximum(square + space.most - 2 * least, 0.0))
                open_ = np.flatnonzero(gap <= radius * (1 + SLACK) + SLACK)
                if not len(open_):
                    continue
                others = np.frombuffer(ids, np.int64)
                score = q[open_] @ np.frombuffer(block, np.int64).reshape(len(others), space.width).astype(np.float64).T
                score[queries[open_][:, None] == others[None, :]] = -np.inf
                row, column = np.nonzero((score >= least[open_][:, None]) & (score > -np.inf))
                who = np.concatenate([best[0], queries[open_[row]]])
                what = np.concatenate([best[1], others[column]])
                value = np.concatenate([best[2], score[row, column]])
                top = _best(who, value, what, k)
                best = (who[top], what[top], value[top])
                # The k-th score of each query that has k by now.
                order = np.argsort(queries)
                counts = np.bincount(np.searchsorted(queries[order], best[0]), minlength=len(queries))
                worst = np.full(len(queries), np.inf)
                np.minimum.at(worst, np.searchsorted(queries[order], best[0]), best[2])
                full = order[counts == k]
                least[full] = np.maximum(least[full], worst[counts == k])
        if now is not None:
            yield done(best)

    def done(best: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        who, what, value = best
        return pa.RecordBatch.from_arrays([pa.array(who), pa.array(what), pa.array(value.astype(np.int64))], names=names)

    return run


def top_k(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, every: int = 50, scale: float = 256.0
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query, exactly.

    Components are floor(scale * x). Queries are the rows whose id is divisible by `every`; candidates are
    all rows with another id. Ties go to the smaller id. Defined cases: vectors that are null or hold a
    null or a number that is not finite, and rows without an id, take no part; shorter vectors count as
    filled with 0; rows with equal ids are one, the least vector of them; fewer candidates than k give
    fewer rows; an empty table gives none. Squared norms of 2 ** 53 or more raise OverflowError.
    """
    spark = vectors.sparkSession
    steps = Steps(spark, "topk")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    whole = rows.mapInArrow(_whole_numbers(scale), "id long, vector binary, square double")
    whole = steps.keep(whole.groupBy("id").agg(F.min(F.struct("vector", "square")).alias("x")).select("id", "x.*"), "whole")
    size = whole.agg(F.max(F.length("vector")), F.max("square")).first()
    width, most = max(1, (size[0] or 0) // 8), float(size[1] or 0.0)
    sample = whole.select("vector").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).toPandas()["vector"]
    space = Space(width, most, np.zeros((1, width + 1)))
    space.pivots = pick_pivots(space.points(_matrix([bytes(v) for v in sample], width)), PIVOTS)
    shared = Shared(spark, space)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = whole.select("id", "vector").mapInArrow(_keyed(shared), "id long, vector binary, pivot int, far double")
    ordered = keyed.repartitionByRange(parts, "pivot", "far", "id").sortWithinPartitions("pivot", "far", "id")
    annuli = steps.keep(ordered.mapInArrow(_annuli(shared, every, k), _BLOCK_SQL), "annuli")
    asked = annuli.select("asked", "asked_vectors", "seeds").filter(F.length("asked") > 0)
    queries = steps.keep(asked.mapInArrow(_query_blocks(shared), _QUERY_SQL), "queries")

    reach = queries.select("query_block", F.explode("reach").alias("r")).select("query_block", "r.*")
    rings = annuli.select(F.col("pivot").alias("around"), "low", "high", "first")
    gap = F.greatest(F.col("low") - F.col("far"), F.col("near") - F.col("high"), F.lit(0.0))
    near = gap <= F.col("radius") * (1 + SLACK) + SLACK
    pairs = reach.join(rings, (F.col("pivot") == F.col("around")) & near)
    pairs = pairs.select("query_block", "pivot", "first", "low", "high", gap.alias("gap"))
    blocks = annuli.select(F.col("pivot").alias("around"), F.col("first").alias("at"), "ids", F.col("vectors").alias("block"))
    same = (F.col("pivot") == F.col("around")) & (F.col("first") == F.col("at"))
    asking = queries.select(F.col("query_block").alias("number"), "asked", "vectors", "seeds")
    met = (
        pairs.join(blocks, same)
        .join(asking, F.col("query_block") == F.col("number"))
        .withColumn("shard", F.pmod(F.xxhash64("first", "pivot"), F.lit(parts)))
        .repartition(parts, "query_block", "shard")
        .sortWithinPartitions("query_block", "gap")
        .select("query_block", "asked", "vectors", "seeds", "pivot", "low", "high", "ids", "block")
    )
    found = met.mapInArrow(_search(shared, k), "query_id long, vec_id long, score long")
    place = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
