"""MinHash near-dedup with an LSH forest.

A document is its set of distinct 5-word shingles; documents with equal sets are one node from then on.
A node's 128 MinHash values are read in TREES different orders. In each tree the nodes that agree on the
first DEPTH values are a region; a region of more than REGION nodes is not cut deeper, which would part
linked nodes, but dealt into blocks that meet two by two. Within a region, nodes whose signatures agree on
enough places are candidates; only forests that hold them together leave the tasks, as stars. The components
of all these forests are clusters: any two linked documents lie in one cluster but for the small chance that
they meet in no region or that their signatures agree too little, whatever the size of the regions.

Each cluster's whole sets then meet in one task, or, for a large cluster, in blocks that meet two by two.
There pairs are confirmed on the whole sets from the most alike on, and a pair that is already held
together by confirmed links is not looked at again: the components stay the same, and no list of all pairs
of a group is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import pack
from .components import connected_components
from .store import Steps
from .words import chunks, gram_names, mix, words_of

PERMUTATIONS = 128
TREES = 20
DEPTH = 3
#: Nodes of a region, or of a block of one, that meet in one task.
REGION = 4096
#: Shingles of a cluster, or of a block of one, that meet in one task.
BLOCK_SHINGLES = 1_500_000
#: Nodes likewise.
BLOCK_NODES = 512
#: Share of places on which signatures must agree: 0.75 less four deviations of 128 draws.
ALIKE = 0.60

_U64 = np.uint64


def _factors() -> tuple[np.ndarray, np.ndarray]:
    base = np.arange(1, PERMUTATIONS + 1, dtype=_U64)
    return mix(base) | _U64(1), mix(base + _U64(1 << 20))


_TIMES, _PLUS = _factors()


def _orders() -> np.ndarray:
    """For each tree the places it reads; trees read different places as far as there are any."""
    return np.arange(TREES * DEPTH).reshape(TREES, DEPTH) % PERMUTATIONS


ORDERS = _orders()


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(number of the first text, sorted distinct shingles of each) for chunks of whole texts."""
    for i, j, data, offsets in chunks(texts):
        words = words_of(data, offsets, lower=True)
        grams = gram_names(words.names, width)
        sets = []
        for k in range(j - i):
            start, end = words.first[k], words.first[k + 1]
            if end - start >= width:
                sets.append(np.unique(grams[start : end - width + 1]))
            else:
                sets.append(gram_names(words.names[start:end], int(end - start)) if end > start else np.zeros(0, _U64))
        yield i, sets


def node_name(shingles: np.ndarray) -> int:
    """One number for a whole set, as a signed long."""
    total = mix(shingles).sum(dtype=_U64) + _U64(len(shingles)) * _U64(0x9E3779B97F4A7C15)
    return int(mix(np.array([total]))[0].view(np.int64))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, PERMUTATIONS) MinHash values; sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), PERMUTATIONS), _U64)
    for k in range(PERMUTATIONS):
        out[:, k] = np.minimum.reduceat(flat * _TIMES[k] + _PLUS[k], starts)
    return mix(out.ravel()).reshape(out.shape)


def _tree_keys(values: np.ndarray) -> np.ndarray:
    """(nodes, TREES): names of the regions at DEPTH."""
    keys = np.empty((len(values), TREES), _U64)
    for tree in range(TREES):
        total = np.full(len(values), _U64(tree + 1))
        for place in ORDERS[tree]:
            total = mix(total + values[:, place])
        keys[:, tree] = total
    return keys


def _nodes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, version = batch.column(0), batch.column(1)
            for i, sets in shingle_sets(batch.column(2), width):
                sizes = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(sizes)
                names = np.zeros(len(sets), np.int64)
                keys: list = [None] * len(sets)
                signs: list = [None] * len(sets)
                if len(some):
                    values = signatures([sets[k] for k in some])
                    trees = _tree_keys(values).view(np.int64)
                    short = values.astype(np.uint16)
                    for n, k in enumerate(some):
                        names[k] = node_name(sets[k])
                        keys[k] = trees[n].tolist()
                        signs[k] = short[n].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        doc.slice(i, len(sets)),
                        version.slice(i, len(sets)),
                        pa.array(sizes),
                        pa.array(names),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(signs, pa.binary()),
                    ],
                    names=["doc", "version", "n", "node", "keys", "signature"],
                )

    return run


def _by_key(batches: Iterator[pa.RecordBatch], key_columns: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches, key by key."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            key = row[:key_columns]
            if key != now:
                if rows:
                    yield now, rows
                now, rows = key, []
            rows.append(row[key_columns:])
    if rows:
        yield now, rows


class Joined:
    """Labels of a growing forest over nodes 0 .. n - 1; the smaller side takes the larger's label."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members = [[i] for i in range(n)]

    def join(self, a: int, b: int) -> None:
        a, b = self.label[a], self.label[b]
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        self.label[self.members[b]] = a
        self.members[a] += self.members[b]
        self.members[b] = []


def _agreement(signs: np.ndarray, i: int) -> np.ndarray:
    """Number of places on which each later node agrees with node i."""
    return (signs[i + 1 :] == signs[i]).sum(1)


def _comparable(sizes: np.ndarray, i: int, share: float) -> np.ndarray:
    later = sizes[i + 1 :]
    return np.minimum(later, sizes[i]) >= share * np.maximum(later, sizes[i])


def _regions(share: float):
    """Sorted (key, i, j, node, n, signature) to stars over candidates of each region, or two blocks of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = int(np.ceil(ALIKE * PERMUTATIONS))
        for _, rows in _by_key(batches, 3):
            nodes = [r[0] for r in rows]
            sizes = np.array([r[1] for r in rows])
            signs = np.frombuffer(b"".join(r[2] for r in rows), np.uint16).reshape(len(rows), -1)
            forest = Joined(len(rows))
            for i in range(len(rows) - 1):
                if (forest.label[i + 1 :] == forest.label[i]).all():
                    continue
                alike = (_agreement(signs, i) >= least) & _comparable(sizes, i, share)
                for j in np.flatnonzero(alike) + i + 1:
                    if forest.label[i] != forest.label[j]:
                        forest.join(i, int(j))
            hubs, leaves = [], []
            for members in forest.members:
                if len(members) > 1:
                    hub = min(nodes[m] for m in members)
                    hubs += [hub] * len(members)
                    leaves += [nodes[m] for m in members]
            yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array(leaves, pa.int64())], names=["a", "b"])

    return run


def _sets(width: int):
    """(cluster, key, node, signature, text) to the same with the text's set, if it is the node's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(1).to_pylist()
            for i, sets in shingle_sets(batch.column(3), width):
                own = [k for k, s in enumerate(sets) if node_name(s) == nodes[i + k]]
                taken = batch.slice(i, len(sets)).take(pa.array(own, pa.int64()))
                packed = pa.array([sets[k].tobytes() for k in own], pa.binary())
                yield pa.RecordBatch.from_arrays([*taken.columns[:3], packed], names=["cluster", "node", "signature", "shingles"])

    return run


def _confirm(share: float):
    """Sorted (cluster, i, j, node, signature, shingles) to stars over the confirmed links of each block."""

    def linked(a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= round(100 * share) * (len(a) + len(b) - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = int(np.ceil(ALIKE * PERMUTATIONS))
        bands = [*range(PERMUTATIONS, least, -8), least]
        for _, rows in _by_key(batches, 3):
            rows = list({r[0]: r for r in rows}.values())
            nodes = [r[0] for r in rows]
            signs = np.frombuffer(b"".join(r[1] for r in rows), np.uint16).reshape(len(rows), -1)
            sets = [np.frombuffer(r[2], _U64) for r in rows]
            sizes = np.array([len(s) for s in sets])
            # Pairs worth confirming, by how much their signatures agree; kept as bytes, row by row.
            agree = [np.where(_comparable(sizes, i, share), _agreement(signs, i), 0).astype(np.uint8) for i in range(len(rows))]
            forest = Joined(len(rows))
            above = PERMUTATIONS + 1
            for band in bands:
                for i in range(len(rows) - 1):
                    found = np.flatnonzero((agree[i] >= band) & (agree[i] < above)) + i + 1
                    for j in found[forest.label[found] != forest.label[i]]:
                        if forest.label[i] != forest.label[j] and linked(sets[i], sets[j]):
                            forest.join(i, int(j))
                above = band
            hubs, leaves = [], []
            for members in forest.members:
                if len(members) > 1:
                    hub = min(nodes[m] for m in members)
                    hubs += [hub] * len(members)
                    leaves += [nodes[m] for m in members]
            yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array(leaves, pa.int64())], names=["a", "b"])

    return run


def _met(rows: DataFrame, key: str) -> DataFrame:
    """(key, node, ..., blocks) to (key, i, j, node, ...), sorted: what meets in one task.

    A key in one block meets once, as (0, 0); of more blocks each meets each other, as (i, j).
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j != own)
    )
    carried = [c for c in rows.columns if c not in (key, "blocks")]
    met = rows.select(key, own.alias("own"), F.explode(other).alias("other"), *carried)
    met = met.select(key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *carried)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return met.repartition(parts, key, "i", "j").sortWithinPartitions(key, "i", "j")


def find_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    share: float = 0.75,
    region: int = REGION,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """row (struct of the columns of docs in carry, or all), n_shingles, component_id, kept.

    Words are runs of anything but white space, A-Z lower-cased; a document's set has its distinct shingles
    of `width` words, or with fewer words the whole sequence as one. Documents are linked if intersection
    over union is at least `share`, confirmed on whole sets; component_id is the smallest id reached.
    Defined cases: null and empty texts have an empty set and are linked with nothing; rows with equal ids
    are documents of their own, and kept is true for each of them whose id is its component's; a missing id
    counts after all others and is kept where nothing with an id is linked to it. Sets, and likewise
    shingles and words, are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    steps = Steps(spark, "near_dedup")
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("version"), text.alias("text"))
    long, doc = T.LongType(), source.schema["doc"]
    fields = [("version", long), ("n", long), ("node", long), ("keys", T.ArrayType(long)), ("signature", T.BinaryType())]
    schema = T.StructType([doc, *(T.StructField(n, t) for n, t in fields)])
    members = steps.keep(source.mapInArrow(_nodes(width), schema), "documents")
    place = F.struct(F.col("doc").isNull().alias("missing"), "doc", "version")
    classes = (
        members.filter("n > 0")
        .groupBy("node")
        .agg(F.min(place).alias("at"), F.max("n").alias("n"), F.first("keys").alias("keys"), F.first("signature").alias("signature"))
        .select("node", F.col("at.doc").alias("least"), F.col("at.version").alias("text_version"), "n", "keys", "signature")
    )
    classes = steps.keep(classes, "classes")

    regions = classes.select("node", F.posexplode("keys").alias("tree", "key"))
    counts = regions.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("which"))
    counts = counts.filter("size > 1")
    # Trees often find the same region; one of them is enough.
    chosen = counts.groupBy("which", "size").agg(F.min("key").alias("key")).select("key", "size")
    inside = steps.keep(regions.join(chosen, "key"), "regions")
    signed = classes.select("node", "n", "signature")
    blocks = F.ceil(F.col("size") / region).cast("int").alias("blocks")
    gathered = _met(inside.select("key", "node", blocks).join(signed, "node").select("key", "node", "n", "signature", "blocks"), "key")
    stars = gathered.mapInArrow(_regions(share), "a long, b long")
    clusters = steps.keep(connected_components(stars, steps, "clusters"), "clusters")

    # Whole sets of the nodes in clusters, from one text of each.
    chosen = clusters.join(classes.select("node", "least", "text_version", "n", "signature"), "node")
    blocks = F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_NODES)).cast("int")
    total = chosen.groupBy("root").agg(blocks.alias("blocks"))
    chosen = chosen.select(F.col("root").alias("cluster"), "node", "signature", "least", "text_version")
    same = F.col("doc").eqNullSafe(F.col("least")) & (F.col("version") == F.col("text_version"))
    texts = chosen.join(source, same).select("cluster", "node", "signature", "text")
    sets = texts.mapInArrow(_sets(width), "cluster long, node long, signature binary, shingles binary")
    sets = steps.keep(sets, "sets")
    blocks = sets.join(total.withColumnRenamed("root", "cluster"), "cluster")
    met = _met(blocks.select("cluster", "node", "signature", "shingles", "blocks"), "cluster")
    links = met.mapInArrow(_confirm(share), "a long, b long")
    reached = steps.keep(connected_components(links, steps, "linked"), "linked")

    rooted = classes.select("node", "least").join(reached, "node", "left")
    rooted = rooted.select("node", "least", F.coalesce("root", "node").alias("root"))
    # Written before it is joined, so that a component with very many nodes can be split.
    first = steps.keep(rooted.groupBy("root").agg(F.min("least").alias("component")), "first")
    named = steps.keep(rooted.join(first, "root").select("node", "component"), "named")

    # Documents with an empty set stand for themselves.
    empty = members.filter("n = 0").select("doc", "version", "n", F.col("doc").alias("component"))
    full = members.filter("n > 0").join(named, "node").select("doc", "version", "n", "component")
    judged = empty.unionByName(full).dropDuplicates(["doc", "version"])
    judged = judged.select(F.col("doc").alias("in_doc"), F.col("version").alias("in_version"), "n", "component")
    packed = docs.select(pack(docs, carry), F.col(id_col).alias("doc"), F.xxhash64(text).alias("version"))
    same = F.col("doc").eqNullSafe(F.col("in_doc")) & (F.col("version") == F.col("in_version"))
    return packed.join(judged, same).select(
        "row",
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("doc").eqNullSafe(F.col("component")).alias("kept"),
    )
