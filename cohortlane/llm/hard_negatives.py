"""Hard-negative mining through a cover tree over norm-augmented vectors.

With M the largest squared norm, a vector x becomes the point (x, sqrt(M - |x|^2)) and an anchor q the
point (q, 0); then <q, x> equals the inner product of the two points, and for any point x within r of
a centre c, <q, x> lies in <q, c> -+ |q| r. The tree is fitted by farthest-first traversal of a
bounded sample of points (SAMPLE_ROWS, those whose ids hash lowest): each centre hangs below the
nearest centre picked before it, and its level is the logarithm of its distance to them. Every row
of the table is indexed: Spark gives it to its nearest centre, whose cell is cut into blocks of about
TILE_ROWS rows by a hash of the id, so a cell of a third of all rows is still many tasks; smaller
neighbouring cells share a tile, the unit in which anchors meet rows. Covering
radii are measured, not assumed: a block's radius is the largest distance of its rows, a node's the
largest of its cell's and its children's (distance to the child plus the child's radius).

An anchor walks the tree best first by the upper bound of a subtree and skips a subtree whose whole
range of scores lies outside what it looks for. Three Spark rounds, each joining anchors in chunks
with the blocks of the cells they visit and scoring them exactly in integers:

1. seed: the SEED_CELLS cells of highest bound; per label the best SEED_KEEP rows are kept;
2. positives: every cell that may hold a same-label row above the seed's 5th positive score;
3. negatives: every cell that may hold a different-label row inside a positive's window and above the
   seed's 3rd such score for the positive that needs least.

Each round only ever raises what the answer must beat, so it is exact: a row outside the visited cells
has a score below a bound that the answer already reaches.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import Shared, Steps

#: The tree is fitted on so many rows at most; all rows are indexed.
SAMPLE_ROWS = 4096
#: Nodes of the tree (centres of the sample picked first).
NODES = 256
#: Neighbouring cells are packed into tiles of about so many rows; a larger cell is cut into parts.
TILE_ROWS = 4096
#: Anchors that meet a tile together.
ANCHOR_ROWS = 1024
SEED_CELLS = 8
SEED_KEEP = 16
#: Fixed values of the contract.
SCALE = 256
ANCHOR_EVERY = 50
FLIP_EVERY = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)
SLACK = 1e-6


@dataclass
class Tree:
    centres: np.ndarray  # augmented points, one per node
    parent: np.ndarray  # -1 at the root
    level: np.ndarray
    most: float
    width: int
    cell: np.ndarray | None = None  # radius of a node's own cell
    subtree: np.ndarray | None = None  # radius of the node with all below it
    tile: np.ndarray | None = None  # the tile that holds a node's cell

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.most - (x * x).sum(1), 0.0))
        return np.concatenate([x, rest[:, None]], 1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.lift(x)
        square = (p * p).sum(1)[:, None] + (self.centres**2).sum(1) - 2 * p @ self.centres.T
        own = square.argmin(1)
        return own, np.sqrt(np.maximum(square[np.arange(len(p)), own], 0.0))

    def children(self) -> list[list[int]]:
        below: list[list[int]] = [[] for _ in self.parent]
        for node, up in enumerate(self.parent):
            if up >= 0:
                below[up].append(node)
        return below


def fit_tree(sample: np.ndarray, most: float, nodes: int = NODES) -> Tree:
    """Farthest-first traversal of the sample: node i hangs below the nearest node picked before it."""
    width = sample.shape[1]
    probe = Tree(np.zeros((1, width + 1)), np.array([-1]), np.array([0]), most, width)
    points = probe.lift(sample) if len(sample) else np.zeros((1, width + 1))
    picked, parent, level = [0], [-1], [0.0]
    near = np.sqrt(((points - points[0]) ** 2).sum(1))
    owner = np.zeros(len(points), int)
    while len(picked) < min(nodes, len(points)) and near.max() > 0:
        i = int(near.argmax())
        parent.append(int(owner[i]))
        level.append(float(np.floor(np.log2(near[i]))))
        picked.append(i)
        d = np.sqrt(((points - points[i]) ** 2).sum(1))
        closer = d < near
        near[closer], owner[closer] = d[closer], len(picked) - 1
    return Tree(points[picked], np.array(parent), np.array(level), most, width)


def set_radii(tree: Tree, cells: dict[int, float]) -> Tree:
    """Cell radii measured over all rows; subtree radii from the leaves up (children come after parents)."""
    n = len(tree.parent)
    tree.cell = np.array([cells.get(i, -1.0) for i in range(n)])
    tree.subtree = tree.cell.copy()
    for node in range(n - 1, 0, -1):
        up = tree.parent[node]
        if tree.subtree[node] >= 0:
            reach = np.sqrt(((tree.centres[node] - tree.centres[up]) ** 2).sum()) + tree.subtree[node]
            tree.subtree[up] = max(tree.subtree[up], reach)
    return tree


def pack_tiles(tree: Tree, counts: dict[int, int]) -> list[tuple[int, int, int]]:
    """(cell, tile, parts): cells in node order packed into tiles of up to TILE_ROWS rows; a larger
    cell is a tile of its own, cut into ceil(rows / TILE_ROWS) parts by a hash of the id."""
    tile = np.full(len(tree.parent), -1)
    out, current, filled = [], 0, 0
    for cell in range(len(tree.parent)):
        n = counts.get(cell, 0)
        if not n:
            continue
        if n > TILE_ROWS:
            current += 1
            tile[cell] = current
            out.append((cell, current, -(-n // TILE_ROWS)))
            current, filled = current + 1, 0
            continue
        if filled + n > TILE_ROWS:
            current, filled = current + 1, 0
        tile[cell] = current
        filled += n
        out.append((cell, current, 1))
    tree.tile = tile
    return out


def _bounds(tree: Tree, q: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = tree.centres[:, :-1] @ q
    room = np.sqrt(float(q @ q)) * radius * (1 + SLACK) + 1
    return at - room, at + room


def visit(tree: Tree, q: np.ndarray, low: float, high: float, floor: float, cells: int | None = None) -> list[int]:
    """Cells whose scores may lie in [low, high] and reach floor, best first; the first `cells` if given."""
    below = tree.children()
    sub_lo, sub_hi = _bounds(tree, q, tree.subtree)
    cell_lo, cell_hi = _bounds(tree, q, tree.cell)
    found, heap = [], [(-sub_hi[0], 0)]
    while heap and (cells is None or len(found) < cells):
        _, node = heapq.heappop(heap)
        if tree.subtree[node] < 0 or sub_hi[node] < max(low, floor) or sub_lo[node] > high:
            continue
        if tree.cell[node] >= 0 and cell_hi[node] >= max(low, floor) and cell_lo[node] <= high:
            found.append(node)
        for child in below[node]:
            heapq.heappush(heap, (-sub_hi[child], child))
    return found


def clean(embeddings: DataFrame) -> DataFrame:
    """id, label, x (array of longs): rows that take part, labels turned where the id says so."""
    x = F.col("embedding")
    whole = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % FLIP_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return embeddings.filter(whole & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").alias("id"),
        label.alias("label"),
        F.transform(x, lambda v: F.floor(F.lit(float(SCALE)) * v.cast("double")).cast("long")).alias("x"),
    )


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for n, v in enumerate(rows):
        v = np.asarray(v, np.int64)
        out[n, : len(v)] = v[:width]
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond 2^62 in magnitude through Python integers, then held in a long."""
    big = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if big == 0 or big * big * a.shape[1] < 2**62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _cells(shared: Shared):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = shared.value
        for f in frames:
            if not len(f):
                continue
            own, far = tree.nearest(_matrix(f["x"], tree.width).astype(np.float64))
            yield f.assign(cell=own.astype(np.int32), far=far)

    return run


def _plans(shared: Shared, mode: str):
    """cells an anchor visits in a round: seed (best first), or by the floors the last round set."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = shared.value
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                q = _matrix(pd.Series([r.x]), tree.width)[0].astype(np.float64)
                if mode == "seed":
                    found = visit(tree, q, -np.inf, np.inf, -np.inf, SEED_CELLS)
                elif mode == "positives":
                    found = visit(tree, q, -np.inf, np.inf, r.floor)
                else:
                    found = visit(tree, q, r.low, r.high, r.floor)
                out += [(r.anchor, int(t)) for t in sorted({tree.tile[c] for c in found})]
            yield pd.DataFrame(out, columns=["anchor", "tile"]).astype({"anchor": "int64", "tile": "int32"})

    return run


def _best(order_score: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Positions of the `keep` highest scores, ties to smaller ids."""
    return np.lexsort((ids, -order_score))[:keep]


def _score(shared: Shared, mode: str):
    """Candidates of a round for each anchor of a chunk against one block."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = shared.value
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                if r.anchors is None or r.ids is None:
                    continue
                ids, labels = np.asarray(r.ids, np.int64), np.asarray(r.labels, np.int64)
                rows = _matrix(pd.Series(list(r.xs)), tree.width)
                for a in r.anchors:
                    q = _matrix(pd.Series([a["x"]]), tree.width)[0]
                    s = scores(q[None, :], rows)[0]
                    other = ids != a["anchor"]
                    if mode == "seed":
                        for lab in np.unique(labels[other]):
                            at = np.flatnonzero(other & (labels == lab))
                            for k in at[_best(s[at], ids[at], SEED_KEEP)]:
                                out.append((a["anchor"], -1, ids[k], int(labels[k]), int(s[k])))
                    elif mode == "positives":
                        at = np.flatnonzero(other & (labels == a["label"]) & (s >= a["floor"]))
                        for k in at[_best(s[at], ids[at], POSITIVES)]:
                            out.append((a["anchor"], -1, ids[k], int(labels[k]), int(s[k])))
                    else:
                        differ = labels != a["label"]
                        for p, ps in zip(a["positives"], a["scores"], strict=True):
                            inside = differ & (WINDOW[0] * ps <= 100 * s) & (100 * s <= WINDOW[1] * ps)
                            at = np.flatnonzero(inside)
                            for k in at[_best(s[at], ids[at], NEGATIVES)]:
                                out.append((a["anchor"], p, ids[k], int(labels[k]), int(s[k])))
            yield pd.DataFrame(out, columns=["anchor", "positive", "id", "label", "score"]).astype(
                {"anchor": "int64", "positive": "int64", "id": "int64", "label": "int64", "score": "int64"}
            )

    return run


_CANDIDATES = "anchor long, positive long, id long, label long, score long"


def _round(steps: Steps, shared: Shared, anchors: DataFrame, blocks: DataFrame, mode: str, name: str) -> DataFrame:
    """Plans the tiles of the anchors' cells, deals the anchors of a tile into chunks and scores them against
    its parts. Rows of a tile outside the visited cells are scored too: exact scores of real rows never
    change a top list that already holds all rows it needs."""
    plans = steps.keep(
        anchors.mapInPandas(_plans(shared, mode), "anchor long, tile int"), f"{name}_plans"
    )
    visits = plans.groupBy("tile").agg(F.count(F.lit(1)).alias("visits"))  # a row per tile
    chunked = (
        plans.join(F.broadcast(visits), "tile")
        .join(anchors, "anchor")
        .withColumn("chunk", F.pmod(F.xxhash64("anchor"), F.ceil(F.col("visits") / ANCHOR_ROWS)))
        .groupBy("tile", "chunk")
        .agg(F.collect_list(F.struct(*[c for c in anchors.columns])).alias("anchors"))
    )
    met = chunked.join(blocks, "tile").select("anchors", "ids", "labels", "xs")
    return steps.keep(met.mapInPandas(_score(shared, mode), _CANDIDATES), name)


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id"))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label or vector, or a null or non-finite component, take no part; where the
    id is divisible by 7 the label becomes (label + 1) % 10; components become floor(256 x). Anchors:
    ids divisible by 50. Positives: an anchor's first 5 other rows of its label by score, ties to the
    smaller id; for each, the first 3 rows of another label with 50 ps <= 100 s <= 95 ps (none when
    ps < 0). Vectors of different lengths are padded with zeros. Repeated ids are separate rows, an
    anchor never meets a row of its own id. Empty tables give no rows; only vec_id, embedding and
    label are read, so other columns do not clash.
    """
    spark = embeddings.sparkSession
    steps = Steps(spark, "hard_negatives")
    rows = steps.keep(clean(embeddings.select("vec_id", "embedding", "label")), "rows")
    sizes = rows.agg(
        F.max(F.size("x")).alias("width"),
        F.max(F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))).alias("most"),
    ).first()
    width, most = int(sizes["width"] or 1), float(sizes["most"] or 0.0)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("x").toPandas()
    tree = fit_tree(_matrix(sample["x"], width).astype(np.float64), most)
    shared = Shared(spark, tree)
    placed = steps.keep(
        rows.mapInPandas(_cells(shared), "id long, label long, x array<long>, cell int, far double"), "placed"
    )
    measured = placed.groupBy("cell").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    # One row per node at most: the tree and its tiles have a size that the sample bounds.
    tree = set_radii(tree, {int(r["cell"]): float(r["radius"]) for r in measured})
    tiles = pack_tiles(tree, {int(r["cell"]): int(r["n"]) for r in measured})
    shared = Shared(spark, tree)
    cell_map = spark.createDataFrame(tiles or [(-1, -1, 1)], "cell int, tile int, parts int")
    blocks = steps.keep(
        placed.join(F.broadcast(cell_map), "cell")
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        .groupBy("tile", "part")
        .agg(F.collect_list("id").alias("ids"), F.collect_list("label").alias("labels"), F.collect_list("x").alias("xs")),
        "blocks",
    )
    anchors = steps.keep(
        placed.filter(F.col("id") % ANCHOR_EVERY == 0).select(F.col("id").alias("anchor"), "label", "x"), "anchors"
    )

    seed = _round(steps, shared, anchors, blocks, "seed", "seed")
    seed_pos = _first(seed.join(anchors.select("anchor", "label"), ["anchor", "label"]), ["anchor"], POSITIVES)
    floors = seed_pos.groupBy("anchor").agg(
        F.when(F.count(F.lit(1)) >= POSITIVES, F.min("score")).otherwise(F.lit(-(2**63))).alias("floor")
    )
    asked = anchors.join(floors, "anchor", "left").select(
        "anchor", "label", "x", F.coalesce("floor", F.lit(-(2**63))).alias("floor")
    )
    found = _round(steps, shared, asked, blocks, "positives", "positives")
    positives = steps.keep(_first(found, ["anchor"], POSITIVES).select("anchor", F.col("id").alias("positive"), F.col("score").alias("ps")), "chosen")

    # What the seed already found inside each positive's window sets how high a negative must reach.
    lo, hi = WINDOW
    seeded = seed.drop("positive").join(positives, "anchor").join(anchors.select("anchor", F.col("label").alias("own")), "anchor")
    seeded = seeded.filter((F.col("label") != F.col("own")) & (lo * F.col("ps") <= 100 * F.col("score")) & (100 * F.col("score") <= hi * F.col("ps")))
    third = _first(seeded.select("anchor", "positive", "id", "score"), ["anchor", "positive"], NEGATIVES).groupBy("anchor", "positive").agg(
        F.when(F.count(F.lit(1)) >= NEGATIVES, F.min("score")).alias("third")
    )
    need = positives.join(third, ["anchor", "positive"], "left").groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("positive", "ps"))).alias("pos"),
        F.min(F.coalesce("third", F.lit(-(2**63)))).alias("floor"),
        F.min(F.col("ps") * lo / 100.0).alias("low"),
        F.max(F.col("ps") * hi / 100.0).alias("high"),
    )
    asked = anchors.join(need, "anchor").select(
        "anchor",
        "label",
        "x",
        F.col("floor").cast("double").alias("floor"),
        "low",
        "high",
        F.col("pos.positive").alias("positives"),
        F.col("pos.ps").alias("scores"),
    )
    negatives = _round(steps, shared, asked, blocks, "negatives", "negatives")
    best = _first(negatives, ["anchor", "positive"], NEGATIVES)
    return best.join(positives, ["anchor", "positive"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("ps").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
