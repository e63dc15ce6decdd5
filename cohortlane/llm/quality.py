"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few numbers; each number falls into one of a few bins. Boosting goes round the
numbers, each time fitting a tree of three leaves to what is still unexplained and adding it to that
number's lookup table; then tables of pairs of numbers are learned the same way. A score is a sum of
table entries, so scoring a batch is a handful of vectorised lookups.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import pack, packed_schema
from .store import Shared

#: Labelled rows that a model is fitted on at most; those whose ids hash lowest are taken.
SAMPLE_ROWS = 40_000
BINS = 32
PAIR_BINS = 8

FEATURES = (
    "log_words",
    "letters_per_word",
    "upper_share",
    "digit_share",
    "symbol_share",
    "exclamation_share",
    "bar_share",
    "stop_share",
    "non_ascii_share",
    "distinct_words",
    "distinct_lines",
    "words_per_line",
    "short_words",
    "longest_word",
    "top_word_share",
)
_SYMBOLS = np.frombuffer(b"#$%&*@^~+=<>_\\", np.uint8)
_STOPS = np.frombuffer(b".,;:?", np.uint8)


def features(text: str | None) -> list[float]:
    """Numbers about a whole text; all are defined for a null and an empty one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    lines = data.split(b"\n")
    n, size = max(1, len(words)), max(1, len(data))
    used: dict[bytes, int] = {}
    for w in words:
        used[w] = used.get(w, 0) + 1
    return [
        float(np.log1p(len(words))),
        (size - int(count[[9, 10, 11, 12, 13, 32]].sum())) / n,
        int(count[65:91].sum()) / size,
        int(count[48:58].sum()) / size,
        int(count[_SYMBOLS].sum()) / size,
        int(count[33]) / size,
        int(count[124]) / size,
        int(count[_STOPS].sum()) / size,
        int(count[128:].sum()) / size,
        len(used) / n,
        len(set(lines)) / len(lines),
        n / len(lines),
        sum(len(w) <= 3 for w in words) / n,
        float(np.log1p(max(map(len, words), default=0))),
        max(used.values(), default=0) / n,
    ]


def feature_matrix(texts: Sequence[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class Model:
    start: float
    edges: list[np.ndarray]
    tables: np.ndarray
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        total = np.full(len(x), self.start)
        b = self.bins(x)
        for j, table in enumerate(self.tables):
            total += table[b[j]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[self.coarse[i][b[i]], self.coarse[j][b[j]]]
        return 1.0 / (1.0 + np.exp(-total))


def _tree(gradient: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    """A step for each bin: the best split, then the best one within either side: three leaves."""

    def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g * g / (h + penalty)

    def best(lo: int, hi: int) -> tuple[float, int]:
        g, h = np.cumsum(gradient[lo:hi]), np.cumsum(weight[lo:hi])
        if hi - lo < 2:
            return 0.0, lo
        gains = gain(g[:-1], h[:-1]) + gain(g[-1] - g[:-1], h[-1] - h[:-1]) - gain(g[-1], h[-1])
        k = int(gains.argmax())
        return float(gains[k]), lo + k + 1

    n = len(gradient)
    value, cut = best(0, n)
    step = np.zeros(n)
    cuts = {0, n}
    if value > 0:
        cuts.add(cut)
        inner = max(best(0, cut), best(cut, n))
        if inner[0] > 0:
            cuts.add(inner[1])
    ends = sorted(cuts)
    for lo, hi in zip(ends[:-1], ends[1:], strict=True):
        step[lo:hi] = gradient[lo:hi].sum() / (weight[lo:hi].sum() + penalty)
    return step


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, penalty: float = 5.0, pairs: int = 6) -> Model:
    """Cyclic boosting of single numbers, then of the pairs that explain most of what is left.

    With no rows the score is a half for every text; with labels of one kind it is near that kind.
    """
    width = x.shape[1]
    inner = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, j], inner)) if len(x) else np.zeros(0) for j in range(width)]
    model = Model(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), edges, np.zeros((width, BINS)))
    if not len(x):
        return model
    b = model.bins(x)
    total = np.full(len(x), model.start)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = residual()
            step = rate * _tree(np.bincount(b[j], g, BINS), np.bincount(b[j], h, BINS), penalty)
            model.tables[j] += step
            total += step[b[j]]
    model.coarse = [np.minimum(np.arange(BINS) * PAIR_BINS // (len(e) + 1), PAIR_BINS - 1) for e in edges]
    c = np.stack([model.coarse[j][b[j]] for j in range(width)])
    g, h = residual()
    cells = PAIR_BINS * PAIR_BINS

    def explained(i: int, j: int) -> float:
        cell = c[i] * PAIR_BINS + c[j]
        gc, hc = np.bincount(cell, g, cells), np.bincount(cell, h, cells)
        return float((gc * gc / (hc + penalty)).sum())

    ranked = sorted(((explained(i, j), i, j) for i in range(width) for j in range(i)), reverse=True)
    model.pairs = [(i, j) for _, i, j in ranked[:pairs]]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(rounds // 2):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            g, h = residual()
            cell = c[i] * PAIR_BINS + c[j]
            gc = np.bincount(cell, g, cells).reshape(PAIR_BINS, PAIR_BINS)
            hc = np.bincount(cell, h, cells).reshape(PAIR_BINS, PAIR_BINS)
            # A shallow tree over both: a cut of one number, and on each side a tree over the other.
            step, most = np.zeros_like(table), -1.0
            for turn in (False, True):
                gt, ht = (gc.T, hc.T) if turn else (gc, hc)
                for cut in range(1, PAIR_BINS):
                    low = _tree(gt[:cut].sum(0), ht[:cut].sum(0), penalty)
                    high = _tree(gt[cut:].sum(0), ht[cut:].sum(0), penalty)
                    made = np.concatenate([np.tile(low, (cut, 1)), np.tile(high, (PAIR_BINS - cut, 1))])
                    gain = float((2 * made * gt - made * made * ht).sum())
                    if gain > most:
                        most, step = gain, made.T if turn else made
            table += rate * step
            total += rate * step[c[i], c[j]]
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fits on at most sample_rows rows of labels, those whose ids hash lowest.

    The sample's ids have a fixed bound, so they may be sent to every task that reads documents. Labels
    other than 0 and 1 and rows without an id are not learned from.
    """
    order = F.xxhash64(F.col(id_col), F.col(label_col))
    chosen = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .select(F.col(id_col).alias("in_id"), F.col(label_col).cast("double").alias("y"), order.alias("place"))
        .orderBy("place", "in_id", "y")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(chosen), F.col("id") == F.col("in_id")).select("text", "place", "in_id", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.list_(pa.float64())), *batch.columns[1:]], names=["x", "place", "in_id", "y"]
            )

    kind = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), *[found.schema[c] for c in ("place", "in_id", "y")]])
    rows = found.mapInArrow(run, kind).orderBy("place", "in_id", "y", "x").limit(sample_rows).select("x", "y").toPandas()
    x = np.array(rows["x"].tolist(), np.float64).reshape(len(rows), len(FEATURES))
    return fit(x, rows["y"].to_numpy(np.float64))


def score_quality(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3, carry: Sequence[str] | None = None) -> DataFrame:
    """row (struct of the columns of docs in carry, or all), score, predicted; one row per row of docs.

    Defined cases: null and empty texts have the numbers of an empty text and so a score; equal texts
    have equal scores; only the text is looked at.
    """
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(feature_matrix(batch.column(1).to_pylist()))
            predicted = (scores >= threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array(predicted)], names=["row", "score", "predicted"]
            )

    packed = docs.select(pack(docs, carry), F.col(text_col).alias("text"))
    return packed.mapInArrow(run, packed_schema(packed, score=T.DoubleType(), predicted=T.IntegerType()))
