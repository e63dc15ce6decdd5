"""Substring dedup by recompression: words of long passages that an earlier document also holds go.

Each document's words become symbols in rounds. The first round names runs of one word; each further
round calls every symbol left or right by a bit of its name and names each pair of a left and a right
neighbour. A name is a hash of what it stands for, so all tasks and all documents name alike without
meeting, and equal passages get equal symbols except near their ends. For each symbol the range of words
that decided on it is carried along: a window of words that holds this range holds the symbol, wherever
the window occurs.

Each window of 50 words belongs to the highest symbol that it surely holds (the longest, then the least
name, then the first), so neighbouring windows of one document form groups and a symbol that no other
document has clears its whole group at once. Spark compares the groups: first by their symbol alone, then
by symbol and name of all words of the group, which decides whole groups, and only for groups that share
a symbol but not their words (the ends of passages) window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import pack, packed_schema
from .store import Steps
from .words import Ranges, chunks, mix, words_of

ROUNDS = 6
#: Symbols of more words are left as they are.
LONGEST = 16

_U64 = np.uint64


class Symbols:
    """Symbols of the words of many documents; word ranges are [start, end) and context [low, high)."""

    def __init__(self, names: np.ndarray, document: np.ndarray):
        n = len(names)
        self.name = names
        self.document = document
        self.start = np.arange(n)
        self.end = self.start + 1
        self.low = self.start.copy()
        self.high = self.end.copy()

    def _keep(self, heads: np.ndarray) -> None:
        """Only the symbols at heads stay."""
        for field in ("name", "document", "start", "end", "low", "high"):
            setattr(self, field, getattr(self, field)[heads])

    def _looked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contexts once symbols have also looked at their left or right neighbours.

        Who looks beyond its document's first or last symbol learns of the border, which no window holds.
        """
        n = len(self.name)
        same = self.document[1:] == self.document[:-1]
        before = np.full(n, -1)
        before[1:] = np.where(same, self.low[:-1], -1)
        after = np.full(n, 1 << 60)
        after[:-1] = np.where(same, self.high[1:], 1 << 60)
        low = np.where(left, np.minimum(self.low, before), self.low)
        high = np.where(right, np.maximum(self.high, after), self.high)
        return low, high

    def name_runs(self) -> None:
        """Runs of one symbol of at most LONGEST words become one; longer runs stay single symbols.

        A single symbol has looked at both neighbours. In a run too long to be named, a symbol has looked
        at as many of the run's symbols as are needed to know that, on one side of it or on both.
        """
        n = len(self.name)
        if not n:
            return
        new = np.ones(n, bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.document[1:] != self.document[:-1])
        heads = np.flatnonzero(new)
        count = np.diff(np.append(heads, n))
        run = np.cumsum(new) - 1
        everyone = np.ones(n, bool)
        low, high = self._looked(everyone, everyone)
        long = count[run] > LONGEST
        place = np.arange(n)
        first, last = heads[run], heads[run] + count[run] - 1
        since = np.maximum(first, place - LONGEST)
        until = np.minimum(last, place + LONGEST)
        low = np.where(long, self.low[since], low)
        high = np.where(long, self.high[until], high)
        tails = heads + count - 1
        merged = (count > 1) & (count <= LONGEST)
        named = mix(self.name[heads] + mix(count.astype(_U64)))
        self.name = np.where(merged[run], named[run], self.name)
        self.end = np.where(merged[run], self.end[tails][run], self.end)
        self.low = np.where(merged[run], low[heads][run], low)
        self.high = np.where(merged[run], high[tails][run], high)
        self._keep(np.flatnonzero(new | ~merged[run]))

    def name_pairs(self, turn: int) -> None:
        n = len(self.name)
        if n < 2:
            return
        size = self.end - self.start
        left = (mix(self.name + _U64(turn)) & _U64(1)) == 0
        same = self.document[1:] == self.document[:-1]
        fits = size[1:] + size[:-1] <= LONGEST
        pair = np.zeros(n, bool)
        pair[:-1] = same & left[:-1] & ~left[1:] & fits
        second = np.zeros(n, bool)
        second[1:] = pair[:-1]
        # A left symbol looked at its right neighbour, a right one at its left, unless it was too long for any.
        able = size < LONGEST
        alone = ~pair & ~second & able
        low, high = self._looked(alone & ~left, alone & left)
        low[:-1] = np.where(pair[:-1], np.minimum(self.low[:-1], self.low[1:]), low[:-1])
        high[:-1] = np.where(pair[:-1], np.maximum(self.high[:-1], self.high[1:]), high[:-1])
        named = self.name.copy()
        named[:-1] = np.where(pair[:-1], mix(mix(self.name[:-1]) + self.name[1:] * _U64(3)), self.name[:-1])
        end = self.end.copy()
        end[:-1] = np.where(pair[:-1], self.end[1:], self.end[:-1])
        self.name, self.end, self.low, self.high = named, end, low, high
        self._keep(np.flatnonzero(~second))


def _least_in(ranks: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Place of the least rank in each [lo, hi), the first of equals; lo < hi everywhere."""
    best = np.arange(len(ranks))
    levels = [best]
    width = 1
    widest = int((hi - lo).max()) if len(lo) else 1
    while width * 2 <= widest:
        a, b = levels[-1][:-width], levels[-1][width:]
        levels.append(np.where(ranks[b] < ranks[a], b, a))
        width *= 2
    level = np.log2(hi - lo).astype(np.int64)
    out = np.empty(len(lo), np.int64)
    for k, table in enumerate(levels):
        at = np.flatnonzero(level == k)
        if len(at):
            a, b = table[lo[at]], table[hi[at] - (1 << k)]
            out[at] = np.where(ranks[b] < ranks[a], b, a)
    return out


def groups(names: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(document, symbol, words, start, end) of all groups of windows of the documents first[i]:first[i + 1].

    start and end are places of windows within the document. A window that surely holds no symbol is a
    group of its own under its own name.
    """
    document = np.repeat(np.arange(len(first) - 1), np.diff(first))
    symbols = Symbols(names, document)
    symbols.name_runs()
    for turn in range(ROUNDS):
        symbols.name_pairs(turn)
    # Where windows start: all places with a window within their document.
    at = np.arange(len(names))
    at = at[at + window <= first[1:][document]] if len(names) else at
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none.astype(_U64), none.astype(_U64), none, none
    # Contexts of neighbours are in order; one that reaches a border reaches beyond every window.
    low = np.maximum(symbols.low, first[:-1][symbols.document] - 1)
    high = np.minimum(symbols.high, first[1:][symbols.document] + 1)
    lo = np.searchsorted(low, at, "left")
    hi = np.searchsorted(high, at + window, "right")
    size = (symbols.end - symbols.start).astype(_U64)
    ranks = ((_U64(63) - np.minimum(size, _U64(62))) << _U64(57)) | (symbols.name >> _U64(7))
    some = lo < hi
    owner = np.full(len(at), -1)
    owner[some] = _least_in(ranks, lo[some], hi[some])
    new = np.ones(len(at), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (owner[1:] < 0) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    begin, final = at[heads], at[tails] + 1
    owner = owner[heads]
    ranges = Ranges(names)
    words = ranges.name(begin, final - 1 + window)
    offset = np.where(owner >= 0, symbols.start[np.maximum(owner, 0)] - begin, 0)
    words = mix(words + offset.astype(_U64) * _U64(0x9E3779B97F4A7C15) + (final - begin).astype(_U64))
    symbol = np.where(owner >= 0, mix(symbols.name[np.maximum(owner, 0)] + _U64(1)), words)
    own = document[begin]
    return own, symbol, words, begin - first[own], final - first[own]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _all_groups(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, version = batch.column(0), batch.column(1)
            for i, _, data, offsets in chunks(batch.column(2)):
                words = words_of(data, offsets, lower=False)
                own, symbol, name, start, end = groups(words.names, words.first, window)
                row = pa.array(own + i)
                yield pa.RecordBatch.from_arrays(
                    [doc.take(row), version.take(row), _signed(symbol), _signed(name), pa.array(start << 32 | end)],
                    names=["doc", "version", "symbol", "words", "span"],
                )

    return run


def _window_names(window: int):
    """(doc, version, text, spans of windows) to one row per window in these spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(3)
            for i, j, data, offsets in chunks(batch.column(2)):
                words = words_of(data, offsets, lower=False)
                ranges = Ranges(words.names)
                rows, places = [], []
                for k in range(j - i):
                    spans = np.unique(np.array(parts[i + k].as_py(), np.int64))
                    at = np.unique(np.concatenate([np.arange(x >> 32, x & 0xFFFFFFFF) for x in spans]))
                    rows.append(np.full(len(at), k))
                    places.append(at)
                row, at = np.concatenate(rows), np.concatenate(places)
                begin = at + words.first[row]
                row = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        _signed(ranges.name(begin, begin + window)),
                        pa.array(at << 32 | (at + 1)),
                    ],
                    names=["doc", "version", "words", "span"],
                )

    return run


def _without(window: int):
    """(row, text, spans of windows that go) to the kept words and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_words, n_removed, digests = [], [], [], []
            for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                n_words.append(len(words))
                if gone:
                    change = np.zeros(len(words) + 1, np.int64)
                    spans = np.array(gone, np.int64)
                    np.add.at(change, spans >> 32, 1)
                    np.add.at(change, (spans & 0xFFFFFFFF) - 1 + window, -1)
                    stays = np.cumsum(change[:-1]) == 0
                    words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                n_removed.append(n_words[-1] - len(words))
                joined = b" ".join(words)
                kept.append(joined.decode("utf-8", "surrogatepass"))
                digests.append(hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(kept, pa.string()),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(digests, pa.string()),
                ],
                names=["row", "kept_text", "n_words", "n_removed", "kept_sha256"],
            )

    return run


def dedup_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, carry: Sequence[str] | None = None
) -> DataFrame:
    """row (struct of the columns of docs in carry, or all), kept_text, n_words, n_removed, kept_sha256.

    A word goes if a window of `window` words that covers it also starts in a document with a smaller id;
    windows are judged on the input. Kept words are joined by one blank. Defined cases: null and empty
    texts have no words; texts of fewer words than the window stay; rows with equal ids are one document,
    each row losing its own words; rows without an id come after all others and, among themselves, lose
    nothing; what repeats within one document alone stays.
    """
    spark = docs.sparkSession
    steps = Steps(spark, "substring_dedup")
    text, doc = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).alias("doc")
    texts = docs.select(pack(docs, carry), doc, F.xxhash64(text).alias("version"), text.alias("text"))
    source = texts.select("doc", "version", "text")
    place = [source.schema["doc"], T.StructField("version", T.LongType())]

    def rows(*longs: str) -> T.StructType:
        return T.StructType([*place, *(T.StructField(n, T.LongType()) for n in longs)])

    found = steps.keep(source.mapInArrow(_all_groups(window), rows("symbol", "words", "span")), "groups")

    # Symbols of at least two documents; all others are done with.
    both = (F.min("doc") < F.max("doc")) | ((F.count("doc") < F.count(F.lit(1))) & (F.count("doc") > 0))
    # Written before it is joined: between two exchanges a symbol with very many groups can be split.
    common = steps.keep(found.groupBy("symbol").agg(both.alias("both")).filter("both").select("symbol"), "common")
    shared = steps.keep(found.join(common, "symbol", "left_semi"), "shared")
    steps.drop("groups")
    later = F.col("least").isNotNull() & (F.col("doc").isNull() | (F.col("least") < F.col("doc")))
    least = steps.keep(shared.groupBy("symbol", "words").agg(F.min("doc").alias("least")), "least")
    judged = shared.join(least, ["symbol", "words"]).select("doc", "version", "symbol", "span", later.alias("later"))
    judged = steps.keep(judged, "judged")
    steps.drop("shared")

    # Groups that are first of their kind but have a symbol with groups of other words: window by window.
    several = least.groupBy("symbol").agg((F.count(F.lit(1)) > 1).alias("several")).filter("several").select("symbol")
    several = steps.keep(several, "several")
    parts = _spans(judged.filter("NOT later").join(several, "symbol", "left_semi"))
    opened = source.join(parts, _same_place()).select("doc", "version", "text", "spans")
    named = steps.keep(opened.mapInArrow(_window_names(window), rows("words", "span")), "windows")
    first = steps.keep(named.groupBy("words").agg(F.min("doc").alias("least")), "first")
    met = named.join(first, "words").filter(later)

    gone = _spans(judged.filter("later").select("doc", "version", "span").unionByName(met.select("doc", "version", "span")))
    done = texts.join(gone, _same_place(), "left").select("row", "text", "spans")
    added = {"kept_text": T.StringType(), "n_words": T.LongType(), "n_removed": T.LongType(), "kept_sha256": T.StringType()}
    return done.mapInArrow(_without(window), packed_schema(done, **added))


def _spans(rows: DataFrame) -> DataFrame:
    """All spans of a document's version as one list, which its text bounds."""
    listed = rows.groupBy("doc", "version").agg(F.collect_set("span").alias("spans"))
    return listed.withColumnsRenamed({"doc": "in_doc", "version": "in_version"})


def _same_place() -> Column:
    return F.col("doc").eqNullSafe(F.col("in_doc")) & (F.col("version") == F.col("in_version"))
