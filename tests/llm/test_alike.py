"""Near and passage dedup and exact top-k against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlane.llm import near_dedup, substring_dedup, topk
from cohortlane.llm.components import connected_components
from cohortlane.llm.store import Steps
from cohortlane.llm.words import mix

from . import cases


def shingles(text):
    words = cases.words_of(cases.lower(text or ""))
    if not words:
        return frozenset()
    size = min(5, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_near(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    out = []
    for i, r in enumerate(rows):
        component = least.get(find(i))
        out.append((r[0], "kept node", len(sets[i]), component, r[0] == component))
    return sorted(out, key=repr)


def copies(rng):
    """Groups around a base with edits on both sides of the limit, and documents that share a passage."""
    rows, n = [], 1000
    for _ in range(8):
        base = cases.prose(rng, 120).replace("\n", " ")
        for _ in range(rng.choice([1, 2, 12])):
            rows.append((n, cases.edited(rng, base, rng.choice([0.0, 0.01, 0.02, 0.03, 0.04, 0.06])), "en", "a", 1))
            n += 1
    passage = cases.prose(rng, 40).replace("\n", " ")
    rows += [(n + i, cases.prose(rng, 100).replace("\n", " ") + " " + passage, "en", "a", 1) for i in range(30)]
    return rows


@pytest.mark.parametrize("region", [near_dedup.REGION, 3])
def test_near_duplicates(spark, monkeypatch, region):
    """Also with regions cut deeper and clusters in several blocks."""
    rng = random.Random(8)
    rows = cases.awkward(rng) + copies(rng)
    if region == 3:
        monkeypatch.setattr(near_dedup, "BLOCK_NODES", 4)
    done = near_dedup.find_near_duplicates(cases.frame(spark, rows), region=region)
    got = cases.collected(done.select("row.doc_id", "row.node", "n_shingles", "component_id", "kept"))
    want = brute_near(rows)
    if region == 3:  # deeper regions may miss a link; none may be made up
        assert [g[:3] for g in got] == [w[:3] for w in want]
        wrong = sum(g[3] != w[3] for g, w in zip(got, want, strict=True))
        assert wrong <= 3
    else:
        assert got == want
    assert near_dedup.find_near_duplicates(cases.empty(spark)).count() == 0


def test_large_regions_lose_no_link(spark):
    """Pairs barely linked, half of every document one template; each region of two or more is above the limit."""
    rng = random.Random(12)
    template = cases.prose(rng, 120).replace("\n", " ")
    rows = []
    for i in range(40):
        own = cases.prose(rng, 120).replace("\n", " ")
        rows.append((2 * i, f"{template} {own}", "en", "a", 1))
        words = own.split(" ")
        for k in (10, 30, 50, 70, 90, 110):
            words[k] = "X" + words[k]
        rows.append((2 * i + 1, f"{template} {' '.join(words)}", "en", "a", 1))
    done = near_dedup.find_near_duplicates(cases.frame(spark, rows), region=1)
    got = cases.collected(done.select("row.doc_id", "row.node", "n_shingles", "component_id", "kept"))
    assert sum(g[4] for g in got) == 40
    assert got == brute_near(rows)


def test_components(spark):
    rng = random.Random(9)
    pairs = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5)]
    root = {x: x for p in pairs for x in p}
    for _ in range(80):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    used = {x for a, b in pairs if a != b for x in (a, b)}
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"), Steps(spark, "test"), "c").collect()
    assert {(r.node, r.root) for r in got} == {(x, root[x]) for x in used} and len(got) == len(used)


def brute_passages(rows, window=50):
    first: dict = {}
    words = [cases.words_of(r[1]) for r in rows]
    for r, w in zip(rows, words, strict=True):
        for i in range(len(w) - window + 1):
            if r[0] is not None:
                run = tuple(w[i : i + window])
                first[run] = min(first.get(run, r[0]), r[0])
    out = []
    for r, w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            least = first.get(tuple(w[i : i + window]))
            if least is not None and (r[0] is None or least < r[0]):
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((r[0], "kept words", len(w), len(gone), cases.sha(" ".join(kept))))
    return sorted(out, key=repr)


def test_passages(spark):
    rng = random.Random(10)
    rows = cases.awkward(rng) + copies(rng)
    long = cases.prose(rng, 300)
    cut = lambda a, b: " ".join(long.split()[a:b])
    for i in range(40):
        a = rng.randint(0, 240)
        rows.append((2000 + i, cases.prose(rng, rng.randint(0, 30)) + " " + cut(a, a + rng.randint(45, 160)) + " " + cases.prose(rng, rng.randint(0, 30)), "en", "a", 1))
    done = substring_dedup.dedup_passages(cases.frame(spark, rows))
    assert cases.collected(done.select("row.doc_id", "row.words", "n_words", "n_removed", "kept_sha256")) == brute_passages(rows)
    assert substring_dedup.dedup_passages(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 5, 5000])
@pytest.mark.parametrize("window", [12, 50])
def test_equal_windows_have_equal_symbols(letters, window):
    rng = np.random.default_rng(letters * window)
    passage = mix(rng.integers(1, letters + 1, 200).astype(np.uint64))
    docs = []
    for _ in range(12):
        parts = [mix(rng.integers(1, letters + 1, int(rng.integers(0, 120))).astype(np.uint64))]
        a = int(rng.integers(0, 100))
        parts.append(passage[a : a + int(rng.integers(20, 100))])
        docs.append(np.concatenate([*parts, mix(rng.integers(1, letters + 1, int(rng.integers(0, 60))).astype(np.uint64))]))
    first = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    seen, covered = {}, 0
    for own, symbol, _, start, end in zip(*substring_dedup.groups(np.concatenate(docs), first, window), strict=True):
        for at in range(start, end):
            assert seen.setdefault(docs[own][at : at + window].tobytes(), symbol) == symbol
            covered += 1
    assert covered == sum(max(0, len(d) - window + 1) for d in docs)


def brute_top(rows, every, k):
    whole: dict = {}
    for key, v in rows:
        if key is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = [int(np.floor(256 * float(c))) for c in v]
        raw = np.array(x, np.int64).tobytes()
        whole[key] = min(whole.get(key, raw), raw)
    full = {key: np.frombuffer(raw, np.int64) for key, raw in whole.items()}
    out = []
    for q, x in full.items():
        if q % every == 0:
            scores = []
            for key, y in full.items():
                n = min(len(x), len(y))
                if key != q:
                    scores.append((-int((x[:n] * y[:n]).sum()), key))
            out += [(q, n + 1, key, -s) for n, (s, key) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "ANNULUS_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    rng = np.random.default_rng(12)
    kind = lambda n: [[float(x) for x in v] for v in np.float32(rng.normal(size=(n, 8)))]
    rows = list(enumerate(kind(900)))
    rows += [(2000 + i, rows[7][1]) for i in range(200)]
    rows += [(3000, None), (3001, [1.0, None]), (3002, [float("nan")]), (3003, [float("inf"), 1.0]), (3010, []), (3020, [1.0])]
    rows += [(None, [1.0] * 8), (30, kind(1)[0]), (30, kind(1)[0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("id", "pivot", "score", "rank")})
    got = topk.top_k(df.repartition(4), every=10)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 10, 5)
    assert topk.top_k(df.limit(0)).count() == 0
    few = topk.top_k(df.filter("vec_id IN (0, 50, 100)"))
    assert sorted((r.query_id, r.rank) for r in few.collect()) == [(q, n) for q in (0, 50, 100) for n in (1, 2)]
