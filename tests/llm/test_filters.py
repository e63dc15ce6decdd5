"""Secret scans, line dedup, decontamination and URL filters against plain Python."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cohortlane.llm import decontamination, line_dedup, queries, secrets, url_filter

from . import cases


def brute_base(text):
    text = text or ""
    assign = re.compile(
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
    )
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


SECRET_TEXTS = [
    "secret=token: abcdef", "secret=token=abcdefgh", 'API_KEY" : "abc.def=="', "pass\u017fword=abcdef", "to\u212aen=abcdef",
    "x AKIA" + "A1" * 8 + " AKIAAKIA" + "Z" * 12, "AKIA123 " + "0a" * 12 + "G" + "f" * 23, "é" * 30 + "TOKEN='" + "q" * 6,
    "apikey:x", "api_key = " + "deadbeef" * 5, "password: " + "A" * 5, None, "",
]


def test_base_patterns_match_as_written():
    for text in SECRET_TEXTS:
        assert secrets.base_spans(text or "") == brute_base(text), text


def test_secret_scan_adds_random_runs_and_no_words(spark):
    rng = random.Random(3)
    rows = cases.awkward(rng)
    alphabet = secrets._ORDER[:62] + "+/"
    planted = {}
    for i in range(100, 160):
        token = "".join(rng.choice(alphabet) for _ in range(44))
        planted[i] = token
        rows.append((i, cases.prose(rng, 60) + " " + token + " thisisaverylongwordofordinarywriting", "en", "a", 1))
    rows += [(200 + i, t, "en", "a", 1) for i, t in enumerate(SECRET_TEXTS)]
    done = secrets.scan_secrets(cases.frame(spark, rows)).select("row.doc_id", "row.text", "row.key", "base", "random").collect()
    assert len(done) == len(rows)
    caught = 0
    for doc_id, text, key, base, extra in done:
        assert key == "kept key"
        assert [tuple(b) for b in base] == brute_base(text)
        found = [text[s:e] for s, _, e in extra]
        caught += doc_id in planted and planted[doc_id] in found
        assert all(f in planted.values() for f in found), found
    assert caught >= 54
    assert secrets.scan_secrets(cases.empty(spark)).count() == 0


def test_secret_scan_tests_values_after_names(spark):
    """NAME=value without blanks: the value is a candidate, also padded, and the name is no part of it."""
    rng = random.Random(4)
    rows = cases.awkward(rng)
    alphabet = secrets._ORDER[:62] + "+/"
    shapes = ["AWS_SECRET_ACCESS_KEY={}", "SESSION_KEY={}", "https://example.org/a?sig={}&x=1", "k=={}==", "{}==", "_AVERYLONGNAMEOFSOMEVALUE={}="]
    planted = {}
    for i in range(100, 160):
        token = "".join(rng.choice(alphabet) for _ in range(44))
        shape = shapes[i % len(shapes)]
        planted[i] = token + "=" * (len(shape) - len(shape.rstrip("=")))
        rows.append((i, cases.prose(rng, 60) + " " + shape.format(token) + " thisisaverylongwordofordinarywriting", "en", "a", 1))
    found = {}
    for doc_id, text, spans in secrets.scan_secrets(cases.frame(spark, rows)).select("row.doc_id", "row.text", "random").collect():
        for s, _, e in spans:
            assert planted.get(doc_id) == text[s:e], text[s:e]
            found[doc_id] = text[s:e]
    for k, shape in enumerate(shapes):
        assert sum(i % len(shapes) == k for i in found) >= 8, shape


def test_secret_query_counts_each_kind(spark, tmp_path):
    """Each count is that of its kind, also where a kind is missing, alone, or not in the order of KINDS."""
    assign, access, hexa = "token=abcdef", "AKIA" + "Z9" * 8, "0a" * 12
    texts = [*SECRET_TEXTS, assign, access, hexa, *(" ".join(x) for x in ([hexa, access, assign], [access] * 3, [hexa, assign, hexa, assign]))]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)] + [(None, assign, "en", "a", 1)] + [(0, access, "en", "a", 1)] * 2
    cases.frame(spark, rows, False).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for doc_id, text, *_ in rows:
        base = brute_base(text)
        digest = cases.sha(",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in base))
        want.append((doc_id, *(sum(k == kind for _, k, _ in base) for kind in range(3)), digest))
    done = queries.op1_secret_scan(spark, str(tmp_path)).drop("spans")
    assert done.dtypes == [("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string")]
    assert cases.collected(done) == sorted(want, key=repr)


def test_lines(spark):
    rows = cases.awkward(random.Random(5))
    key = lambda line: cases.lower(line.strip(" \t\n\x0b\x0c\r"))
    held: dict[str, set] = {}
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(doc)
    first = lambda docs: min((d for d in docs if d is not None), default=None)
    want = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= 2 and first(held[key(x)]) != doc)]
        want.append((doc, "kept pos", len(lines), len(lines) - len(kept), "\n".join(kept)))
    done = line_dedup.dedup_lines(cases.frame(spark, rows))
    assert cases.collected(done.select("row.doc_id", "row.pos", "n_lines", "n_dropped", "kept_text")) == sorted(want, key=repr)
    assert line_dedup.dedup_lines(cases.empty(spark)).count() == 0


def test_lines_of_every_document_but_one_go_whole(spark):
    rows = [(i, "the very same line\nand another one", None, None, None) for i in range(40)]
    done = line_dedup.dedup_lines(cases.frame(spark, rows, False)).select("row.doc_id", "kept_text").collect()
    assert {r.doc_id: r.kept_text for r in done} == {i: rows[0][1] if i == 0 else "" for i in range(40)}


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", cases.lower(text or ""))


def brute_contamination(text, items, window=13):
    words = item_words(text)
    hit, found = set(), set()
    for item, item_text in items:
        own = item_words(item_text)
        size = min(window, len(own))
        runs = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1 if own else 0):
            if tuple(words[i : i + size]) in runs:
                hit.update(range(i, i + size))
                found.add("null" if item is None else str(item))
    return len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("seed", range(4))
def test_automaton_finds_what_windows_find(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdef"
    text = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    for window in (3, 5):
        items = [(i, text(rng.randint(0, 9))) for i in range(8)] + [(8, None), (9, "x"), (10, "A b-A")]
        made = decontamination.Automaton(window)
        made.add_all((str(i), decontamination.item_words(t)) for i, t in items)
        for _ in range(40):
            doc = text(rng.randint(0, 30))
            words = decontamination.item_words(doc)
            spans, found = made.hits(words)
            n = sum(e - s for s, e in zip(spans[::2], spans[1::2], strict=True))
            want = brute_contamination(doc, items, window)
            assert (len(words), n, sorted(found)) == want[:3]


def test_contamination_with_one_and_with_many_automata(spark, monkeypatch):
    rows = cases.awkward(random.Random(7))
    passage = item_words(rows[18][1])
    items = [(3, " ".join(passage[:30])), (12, " ".join(passage[20:])), (None, "one, two"), (5, None), (6, "zz zz zz")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((r[0], "kept spans", *brute_contamination(r[1], items)) for r in rows), key=repr)
    columns = ("row.doc_id", "row.spans", "n_words", "n_hit", "item_ids", "contaminated")
    for bound in (decontamination.WORDS_IN_AN_AUTOMATON, 20):
        monkeypatch.setattr(decontamination, "WORDS_IN_AN_AUTOMATON", bound)
        done = decontamination.find_contamination(cases.frame(spark, rows), bench)
        assert cases.collected(done.select(*columns)) == want
    assert decontamination.find_contamination(cases.empty(spark), bench).count() == 0
    none = decontamination.find_contamination(cases.frame(spark, rows), bench.limit(0))
    assert none.filter("n_hit > 0 OR contaminated").count() == 0


def brute_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = cases.lower(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fits, key=url_filter.Rule.rank, default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


@pytest.mark.parametrize("bound", [200_000, 2])
def test_urls(spark, monkeypatch, bound):
    monkeypatch.setattr(url_filter, "RULES_IN_A_SWEEP", bound)
    rng = random.Random(11)
    rules = [*queries.URL_RULES, url_filter.Rule("block", "b.a.net", "/x"), url_filter.Rule("allow", "a.net", ""), url_filter.Rule("block", "a.net", "/x/y")]
    hosts = ["net", "a.net", "b.a.net", "c.b.a.net", "ba.net", "EXAMPLE.net", "m.example.com", "org", "x.org", "net.", ".net", "", "\u00e9.org:80"]
    paths = ["", "/", "/en/1", "/x/y?z=/fr/", "/fr/#a", "?q=/x", "#f", "/x", "/de/"]
    rows = [(i, "https://" + rng.choice(hosts) + rng.choice(paths)) for i in range(200)]
    rows += [(None, "http://net/"), (7, None), (7, "no scheme net/"), (8, "://net/"), (9, "a://b://net/"), (9, "a://b://net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit(1) for c in ("key", "host", "path", "found")})
    done = url_filter.judge_urls(pages.repartition(3), rules)
    assert cases.collected(done) == sorted(((i, *brute_url(u, rules)) for i, u in rows), key=repr)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert url_filter.judge_urls(pages, []).filter("rule IS NOT NULL").count() == 0


def test_coverage_is_compared_in_whole_numbers(spark):
    """3 of 10 words at coverage 0.3 is contaminated; 10 * 0.3 in floating point is above 3."""
    bench = spark.createDataFrame([(1, "zebra")], "item_id long, text string")
    rows = [(1, "zebra zebra zebra a b c d e f g", "en", "a", 1), (2, "zebra zebra a b c d e f g h", "en", "a", 1)]
    done = decontamination.find_contamination(cases.frame(spark, rows), bench, coverage=0.3)
    got = {r["row"]["doc_id"]: (r["n_hit"], r["n_words"], r["contaminated"]) for r in done.collect()}
    assert got == {1: (3, 10, True), 2: (2, 10, False)}
