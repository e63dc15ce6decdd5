"""Secret scans: patterns, and a battery of randomness tests with false-discovery control.

Three patterns find assignments, access keys and long hexadecimal runs. Beside them every run of 20 or more
characters of [A-Za-z0-9+/_-] is a candidate, with the = signs that pad its end; an = before more of them
parts a name from a value, which is a candidate of its own. Its encoding is the smallest alphabet that
holds its characters, and three statistics tell how unlike random text over that alphabet it is:
chi-squared against equal use of all characters, the number of runs above and below the alphabet's middle,
and the correlation of neighbours. Ordinary writing is the null hypothesis: the corpus's own pairs of
neighbouring characters, counted over all texts, are drawn from to learn how the battery is distributed
over ordinary runs of each length. A candidate is reported if its p-value under ordinary writing passes
Benjamini and Hochberg's rule among all candidates of its class of lengths, and no test rejects that it is
random. So short runs, on which ordinary and random text look alike, need no limit of their own.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import pack, packed_schema
from .store import Shared, Steps

KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# The same matches as AKIA[A-Z0-9]+ of 20 and [0-9a-f]+ of 24 characters or more: both runs are maximal.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?")

_ORDER = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_"
#: Encodings from the smallest alphabet to the largest; a candidate has the first that holds it.
ENCODINGS: tuple[tuple[str, str], ...] = (
    ("decimal", _ORDER[:10]),
    ("hex", _ORDER[:10] + "abcdef"),
    ("HEX", _ORDER[:10] + "ABCDEF"),
    ("base32", _ORDER[10:36] + "234567"),
    ("lower36", _ORDER[:10] + _ORDER[36:62]),
    ("UPPER36", _ORDER[:36]),
    ("base62", _ORDER[:62]),
    ("base64", _ORDER[:62] + "+/"),
    ("base64url", _ORDER[:62] + "-_"),
    ("any", _ORDER),
)
#: Lengths for which ordinary text is drawn; a candidate is compared with the longest not above its own.
GRID = (20, 24, 32, 40, 48, 64, 96, 128, 192, 256, 512)
DRAWS = 400
#: p-values are held as whole numbers of -100 log10 p, up to this.
MOST = 3000


def battery(symbols: np.ndarray, size: int) -> np.ndarray:
    """(texts, 3): standardised chi-squared, runs and serial correlation of rows of symbols below size."""
    rows, n = symbols.shape
    at = np.arange(rows)[:, None] * size + symbols
    counts = np.bincount(at.ravel(), minlength=rows * size).reshape(rows, size)
    chi = (size / n * (counts.astype(float) ** 2).sum(1) - n - (size - 1)) / math.sqrt(2 * (size - 1))
    high = symbols * 2 >= size
    above = high.sum(1).astype(float)
    below = n - above
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(1)
    mean = 1 + 2 * above * below / n
    var = np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    run_z = np.where((above > 0) & (below > 0), np.abs(runs - mean) / np.sqrt(var), math.sqrt(n))
    x = symbols - symbols.mean(1, keepdims=True)
    power = (x * x).sum(1)
    serial = np.where(power > 0, np.abs((x[:, 1:] * x[:, :-1]).sum(1)) / np.maximum(power, 1e-9), 1.0) * math.sqrt(n)
    return np.stack([chi, run_z, serial], 1)


def unlike_random(z: np.ndarray, size: int) -> np.ndarray:
    """One number for the battery: chi-squared by its logarithm, whose tails are even, and a tenth of the rest."""
    chi = z[:, 0] * math.sqrt(2 * (size - 1)) + size - 1
    return np.log1p(np.maximum(chi, 0.0)) + 0.1 * (z[:, 1] + z[:, 2])


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


@dataclass
class Ordinary:
    """mean and deviation of unlike_random() over ordinary writing: (encodings, lengths)."""

    mean: np.ndarray
    deviation: np.ndarray

    def judge(self, token: str) -> tuple[int, int] | None:
        """(class of lengths, -100 log10 p under ordinary writing); None if it is not like random text."""
        body = token.rstrip("=")
        kind = next((k for k, (_, a) in enumerate(ENCODINGS) if set(body) <= set(a)), None)
        if kind is None or len(body) < GRID[0]:
            return None
        alphabet = ENCODINGS[kind][1]
        place = {c: i for i, c in enumerate(alphabet)}
        tests = battery(np.array([[place[c] for c in body]]), len(alphabet))
        if tests[0, 0] > 4.5 or tests[0, 1] > 3.5 or tests[0, 2] > 3.5:
            return None
        length = int(np.searchsorted(GRID, len(body), "right")) - 1
        far = (self.mean[kind, length] - unlike_random(tests, len(alphabet))[0]) / self.deviation[kind, length]
        p = _tail(far)
        score = MOST if p <= 10.0 ** (-MOST / 100) else int(-100 * math.log10(p))
        return length, min(score, MOST)


def learn_ordinary(pairs: np.ndarray, seed: int = 7) -> Ordinary:
    """pairs: counts of neighbouring characters, by their codes below 128."""
    rng = np.random.default_rng(seed)
    mean = np.zeros((len(ENCODINGS), len(GRID)))
    deviation = np.ones_like(mean)
    for k, (_, alphabet) in enumerate(ENCODINGS):
        codes = [ord(c) for c in alphabet]
        size = len(codes)
        own = pairs[np.ix_(codes, codes)].astype(float) + 1e-6
        first = np.cumsum(own.sum(0) / own.sum())
        onward = np.cumsum(own / own.sum(1, keepdims=True), 1)
        symbols = np.zeros((DRAWS, GRID[-1]), np.int64)
        symbols[:, 0] = np.minimum(np.searchsorted(first, rng.random(DRAWS)), size - 1)
        for i in range(1, GRID[-1]):
            symbols[:, i] = np.minimum((onward[symbols[:, i - 1]] < rng.random(DRAWS)[:, None]).sum(1), size - 1)
        for g, n in enumerate(GRID):
            total = unlike_random(battery(symbols[:, :n], size), size)
            mean[k, g], deviation[k, g] = total.mean(), max(total.std(), 0.05)
    return Ordinary(mean, deviation)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns, in order."""
    found = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    for m in _CANDIDATE.finditer(text):
        run, at = m[0], m.start()
        found += [(at + x.start(), 1, at + x.end()) for x in _ACCESS.finditer(run)]
        found += [(at + x.start(), 2, at + x.end()) for x in _HEX.finditer(run)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, str]]:
    """Runs that no pattern's span holds."""
    for m in _CANDIDATE.finditer(text):
        if not any(s <= m.start() and m.end() <= e for s, _, e in base):
            yield m.start(), m.end(), m[0]


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 14, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
            for at in range(0, len(data), 1 << 22):
                part = data[at : at + (1 << 22) + 1].astype(np.int32)
                pair = part[:-1] << 7 | part[1:]
                total += np.bincount(pair[(part[:-1] < 128) & (part[1:] < 128)], minlength=1 << 14)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["pair", "n"])


def ordinary_writing(docs: DataFrame, text_col: str = "text") -> Ordinary:
    """From the neighbouring characters of every text; the driver gets at most 2 ** 14 sums."""
    sums = docs.select(F.col(text_col).alias("text")).mapInArrow(_count_pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = np.zeros(1 << 14)
    for pair, n in sums.collect():
        pairs[pair] = n
    return learn_ordinary(pairs.reshape(128, 128))


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType())])
_FOUND = T.StructType([*_SPAN.fields, T.StructField("length", T.IntegerType()), T.StructField("score", T.IntegerType())])


def scan_secrets(docs: DataFrame, text_col: str = "text", rate: float = 0.01, carry: Sequence[str] | None = None) -> DataFrame:
    """row (struct of the columns of docs in carry, or all), base, random: arrays of struct(start, kind, end).

    Starts and ends count code points, ends are exclusive, kind is a place in KINDS; both arrays are in
    order. rate is the share of false discoveries among the random spans of a class of lengths. Defined
    cases: null and empty texts have no spans; equal texts have equal spans; an empty table gives none.
    """
    spark = docs.sparkSession
    steps = Steps(spark, "secrets")
    shared = Shared(spark, ordinary_writing(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value.judge
        for batch in batches:
            base, random = [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                own = base_spans(text)
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in own])
                random.append(
                    [
                        {"start": s, "kind": 3, "end": e, "length": seen[0], "score": seen[1]}
                        for s, e, token in candidates(text, own)
                        if (seen := judge(token) or (int(np.searchsorted(GRID, len(token), "right")) - 1, -1))
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, base_type), pa.array(random, found_type)], names=["row", "base", "found"]
            )

    base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    found_type = pa.list_(
        pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("length", pa.int32()), ("score", pa.int32())])
    )
    packed = docs.select(pack(docs, carry), F.col(text_col).alias("text"))
    kind = packed_schema(packed, base=T.ArrayType(_SPAN), found=T.ArrayType(_FOUND))
    scanned = steps.keep(packed.mapInArrow(run, kind), "scanned")

    # Benjamini and Hochberg within each class of lengths, on counts of scores: a few thousand numbers.
    tested = scanned.select(F.explode("found").alias("f")).groupBy("f.length", "f.score").agg(F.count(F.lit(1)).alias("n"))
    of_class = W.partitionBy("length")
    ranked = tested.select(
        "length", "score",
        F.sum("n").over(of_class.orderBy(F.col("score").desc())).alias("found"),
        F.sum("n").over(of_class).alias("tested"),
    )
    passing = F.pow(F.lit(10.0), -F.col("score") / 100) * F.col("tested") <= F.lit(rate) * F.col("found")
    limits = ranked.filter((F.col("score") >= 0) & passing).groupBy("length").agg(F.min("score").alias("least"))
    least = {r["length"]: r["least"] for r in limits.collect()}  # one number per class of lengths
    table = F.array(*[F.lit(least.get(i, MOST + 1)) for i in range(len(GRID))])
    kept = F.filter("found", lambda f: f["score"] >= F.element_at(table, f["length"] + 1))
    slim = F.transform(kept, lambda f: F.struct(f["start"].alias("start"), f["kind"].alias("kind"), f["end"].alias("end")))
    return scanned.select("row", "base", slim.alias("random"))


def span_text(spans):
    """Column of kind:start:end, comma-joined, of an array of spans."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )
