"""Benchmark decontamination with a suffix automaton of all benchmark items.

The automaton holds every run of words of every item. A task streams the words of its documents through
it and so knows at each word the longest run ending there that some item holds; a run of `window` words
or more marks the last `window` words as hit. One automaton has at most WORDS_IN_AN_AUTOMATON words of
items; larger benchmarks are cut into several, and the documents pass through each in turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import pack
from .store import Shared

#: A bound on what one broadcast holds: about 500 bytes a word within a Python worker.
WORDS_IN_AN_AUTOMATON = 100_000

#: A-Z to lower case; every byte that no word holds to a space. Bytes from 0x80 on belong to words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def item_words(text: str | None) -> list[bytes]:
    """The runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] of a text whose A-Z are lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


@dataclass
class Automaton:
    """A generalised suffix automaton over words; state 0 is the empty run."""

    window: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    following: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    items: list[set | tuple] = field(default_factory=lambda: [()])
    #: For a state whose runs have window words or more: the state of their last window words.
    whole: list[int] = field(default_factory=list)
    #: Short items, as (number of words, item), that end every run of a state.
    short: list[tuple] = field(default_factory=list)

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.following.append(following)
        self.link.append(link)
        self.length.append(length)
        self.items.append(())
        return len(self.length) - 1

    def _extend(self, last: int, word: int) -> int:
        following, link, length = self.following, self.link, self.length
        known = following[last].get(word)
        if known is not None and length[known] == length[last] + 1:
            return known
        if known is None:
            new = self._state(length[last] + 1, 0, {})
        while last != -1 and word not in following[last]:
            following[last][word] = new
            last = link[last]
        if last == -1:
            return new
        target = following[last][word]
        if length[target] != length[last] + 1:
            copy = self._state(length[last] + 1, link[target], dict(following[target]))
            link[target] = copy
            while last != -1 and following[last].get(word) == target:
                following[last][word] = copy
                last = link[last]
            target = copy
        if known is not None:
            return target
        link[new] = target
        return new

    def add_all(self, items: Iterable[tuple[str, list[bytes]]]) -> None:
        """items: (id, words); those without words are left out."""
        alike: dict[tuple[bytes, ...], list[str]] = {}
        for item, words in items:
            if words:
                alike.setdefault(tuple(words), []).append(item)
        ends = []
        for words, ids in alike.items():
            at, path = 0, []
            for w in words:
                at = self._extend(at, self.vocabulary.setdefault(w, len(self.vocabulary)))
                path.append(at)
            ends.append((words, path, ids))
        holders: list[set] = [set() for _ in self.length]
        short: list[list] = [[] for _ in self.length]
        for words, _, ids in ends:
            at = 0
            for place, w in enumerate(words):
                at = self.following[at][self.vocabulary[w]]
                if place + 1 >= self.window:
                    holders[at].update(ids)
            if len(words) < self.window:
                short[at].append((len(words), tuple(ids)))
        by_length = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        for state in reversed(by_length):
            above = self.link[state]
            if self.length[above] >= self.window:
                holders[above] |= holders[state]
        self.whole, self.short = [0] * len(self.length), [()] * len(self.length)
        for state in by_length:
            above = self.link[state]
            self.short[state] = (*short[state], *self.short[above])
            if self.length[state] >= self.window:
                self.whole[state] = self.whole[above] if self.length[above] >= self.window else state
        self.items = [
            tuple(sorted(h)) if self.whole[s] == s and s else () for s, h in enumerate(holders)
        ]

    def hits(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """Spans of hit words, flat as start, end, start, end ...; ids of the items that occur."""
        following, link, length, window = self.following, self.link, self.length, self.window
        whole, short = self.whole, self.short
        spans: list[int] = []
        states, found = set(), set()
        at = run = 0
        for place, word in enumerate(map(self.vocabulary.get, words)):
            if word is None:
                at = run = 0
                continue
            to = following[at].get(word)
            while to is None and at:
                at = link[at]
                run = length[at]
                to = following[at].get(word)
            if to is None:
                continue
            at = to
            run += 1
            start = place + 1
            if run >= window:
                start -= window
                states.add(whole[at])
            for size, ids in short[at]:
                if size <= run:
                    start = min(start, place + 1 - size)
                    found.update(ids)
            if start <= place:
                while spans and spans[-1] >= start:
                    start = min(start, spans[-2])
                    del spans[-2:]
                spans += (start, place + 1)
        for state in states:
            found.update(self.items[state])
        return spans, found


def _joined(spans: list[int]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (start, end)
    return out


def automata(items: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[Automaton]:
    """Items in the order of their ids, as many to an automaton as it may hold."""
    batch, words = [], 0
    for item, text in items.select(id_col, text_col).orderBy(id_col, text_col).toLocalIterator():
        own = item_words(text)
        if batch and words + len(own) > WORDS_IN_AN_AUTOMATON:
            yield _built(batch, window)
            batch, words = [], 0
        batch.append(("null" if item is None else str(item), own))
        words += len(own)
    yield _built(batch, window)


def _built(batch: list[tuple[str, list[bytes]]], window: int) -> Automaton:
    made = Automaton(window)
    made.add_all(batch)
    return made


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    coverage: float | Fraction = 0.05,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """row (struct of the columns of docs in carry, or all), n_words, spans, item_ids, n_hit, contaminated.

    spans are [start, end) places of hit words, flat and apart; item_ids are sorted as strings. A document
    is contaminated if it has a hit and n_hit is at least coverage times n_words. Defined cases: null and
    empty texts have no words and no hits; an item without words never occurs, one of fewer words than
    the window occurs as a whole; items without an id are named "null"; rows with equal ids are judged
    each on its own; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    state = docs.select(
        pack(docs, carry),
        F.col(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("spans"),
        F.array().cast("array<string>").alias("item_ids"),
    )
    made = list(automata(items, item_id_col, item_text_col, window))
    for place, automaton in enumerate(made):
        last = place == len(made) - 1
        shared = Shared(spark, automaton)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            scan = shared.value.hits
            for batch in batches:
                n_words, spans, found = [], [], []
                before = zip(*(batch.column(i).to_pylist() for i in (1, 3, 4)), strict=True)
                for text, old_spans, old_items in before:
                    words = item_words(text)
                    new_spans, new_items = scan(words)
                    n_words.append(len(words))
                    spans.append(_joined(old_spans + new_spans) if old_spans else new_spans)
                    found.append(sorted({*old_items, *new_items}))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.nulls(len(batch), batch.column(1).type) if last else batch.column(1),
                        pa.array(n_words, pa.int64()),
                        pa.array(spans, pa.list_(pa.int32())),
                        pa.array(found, pa.list_(pa.string())),
                    ],
                    names=batch.schema.names,
                )

        state = state.mapInArrow(run, state.schema)
    # Ends count up and starts count down.
    signed = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("long"))
    n_hit = F.aggregate(signed, F.lit(0).cast("long"), lambda n, x: n + x)
    state = state.select("row", "n_words", "spans", "item_ids", n_hit.alias("n_hit"))
    # One rule in whole numbers: coverage as the fraction it is written as (0.05 is 1/20), never a float product.
    share = coverage if isinstance(coverage, Fraction) else Fraction(str(coverage)).limit_denominator(10**6)
    over = (F.col("n_hit") > 0) & (F.lit(share.denominator) * F.col("n_hit") >= F.lit(share.numerator) * F.col("n_words"))
    return state.withColumn("contaminated", over)


def digest(item_ids: list[str]) -> str:
    return hashlib.sha256(",".join(item_ids).encode()).hexdigest()
