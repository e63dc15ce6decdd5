"""Language identification: multinomial naive Bayes over hashed character n-grams.

Tasks count hashed 1- to 3-grams per language in numpy, Spark adds the counts up, and the matrix of log
probabilities (languages x buckets, a size checked beforehand) is broadcast. Scoring looks up the
n-grams of a batch of texts at once and adds them up per text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import pack, packed_schema
from .store import Shared

BUCKET_BITS = 16
LENGTHS = (1, 2, 3)
#: Most languages of a model: the matrix has 4 << BUCKET_BITS bytes for each.
MAX_LANGUAGES = 500
#: Characters that are looked up at once; longer texts are taken in pieces.
PIECE = 1 << 18
UNKNOWN = "und"

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
#: Places of n-grams that run over the end of a text count in a bucket of their own, which weighs nothing.
_NONE = 1 << BUCKET_BITS


def _codes(text: str) -> np.ndarray:
    """Code points in lower case; ASCII that is no letter becomes a blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes[(codes < 97) | ((codes > 122) & (codes < 128))] = 32
    return codes


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """(number of the text, its buckets by n-gram length) for pieces of about PIECE characters together."""
    owners: list[int] = []
    parts: list[np.ndarray] = []
    starts: list[int] = []
    size = 0
    for n, text in enumerate(texts):
        if not text:
            continue
        codes = _codes(text)
        for at in range(0, len(codes), PIECE):
            part = codes[at : at + PIECE + max(LENGTHS) - 1]
            owners.append(n)
            parts.append(part)
            starts.append(min(PIECE, len(codes) - at))
            size += len(part)
            if size >= PIECE:
                yield owners, _buckets(parts, starts)
                owners, parts, starts, size = [], [], [], 0
    if parts:
        yield owners, _buckets(parts, starts)


def _buckets(parts: list[np.ndarray], starts: list[int]) -> list:
    codes = np.concatenate(parts)
    lengths = np.array([len(p) for p in parts])
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(codes)) - np.repeat(first, lengths)
    room = np.repeat(lengths, lengths) - place
    own = place < np.repeat(np.array(starts), lengths)
    out = []
    for n in LENGTHS:
        h = np.full(len(codes), np.uint64(n))
        for j in range(n):
            h[: len(codes) - j] += codes[j:] * _FACTORS[j]
        h ^= h >> np.uint64(29)
        h *= _SPREAD
        bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        bucket[(room < n) | ~own] = _NONE
        out.append(bucket)
    return [first, *out]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    """languages in order of their names; logs: (languages, buckets + 1); priors: log shares."""

    languages: list[str]
    logs: np.ndarray
    priors: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log probabilities of each text with each language."""
        total = np.tile(self.priors, (len(texts), 1))
        for owners, (first, *by_length) in _pieces(texts):
            for k, log in enumerate(self.logs):
                values = log[by_length[0]]
                for bucket in by_length[1:]:
                    values = values + log[bucket]
                np.add.at(total[:, k], owners, np.add.reduceat(values, first, dtype=np.float64))
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [n for n, t in enumerate(texts) if has_letter(t)] if self.languages else []
        languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if known:
            logs = self.scores([texts[n] for n in known])
            best = logs.argmax(axis=1)
            share = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            for n, b, s in zip(known, best, share, strict=True):
                languages[n], scores[n] = self.languages[b], float(s)
        return languages, scores


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: counts of buckets by language, and of documents under bucket -1."""
    counts: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    for batch in batches:
        languages, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for language in set(languages):
            own = [t or "" for t, x in zip(texts, languages, strict=True) if x == language]
            documents[language] = documents.get(language, 0) + len(own)
            total = counts.setdefault(language, np.zeros(_NONE + 1, np.int64))
            for _, (_, *by_length) in _pieces(own):
                for bucket in by_length:
                    total += np.bincount(bucket, minlength=_NONE + 1)
    for language, total in counts.items():
        used = np.flatnonzero(total[:_NONE])
        buckets = np.concatenate(([-1], used)).astype(np.int32)
        numbers = np.concatenate(([documents[language]], total[used])).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(buckets)), pa.array(buckets), pa.array(numbers)], names=["lang", "bucket", "n"]
        )


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model:
    """Learns from every row of labelled with a language; counts are added up by Spark."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang IS NOT NULL")
    languages = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the matrix would outgrow its bound")
    counted = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toPandas()
    names = sorted(found["lang"].unique())
    logs = np.zeros((len(names), _NONE + 1), np.float32)
    documents = np.zeros(len(names))
    for k, name in enumerate(names):
        own = found[found["lang"] == name]
        counts = np.zeros(_NONE)
        real = own[own["bucket"] >= 0]
        counts[real["bucket"]] = real["n"]
        documents[k] = own.loc[own["bucket"] == -1, "n"].sum()
        logs[k, :_NONE] = np.log(counts + smoothing) - np.log(counts.sum() + smoothing * _NONE)
    priors = np.log(documents / documents.sum()) if len(names) else documents
    return Model(names, logs, priors)


def identify(
    docs: DataFrame, model: Model, text_col: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """row (struct of the columns of docs in carry, or all), lang_pred, score; one row per row of docs.

    score is the model's posterior of its language. Defined cases: a null text, an empty one, one without
    a letter and any text under a model that learned nothing are "und" with score 0; ties go to the
    language first by name; equal texts are judged alike; labels of the row are not looked at.
    """
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, scores = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    packed = docs.select(pack(docs, carry), F.col(text_col).alias("text"))
    return packed.mapInArrow(run, packed_schema(packed, lang_pred=T.StringType(), score=T.DoubleType()))
