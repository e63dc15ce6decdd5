"""URL filters: rules on hosts and path prefixes, met by a sorted sweep over reversed-host keys.

The key of a host is its labels from right to left, each ended by a dot ("m.example.net" becomes
"net.example.m."), so a rule's host and all its subdomains are one interval of keys, and intervals of
different rules either nest or lie apart. Urls are range-partitioned and sorted by key; each task walks
its sorted urls beside the sorted rules and keeps a stack of the rules whose interval it is in.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import lower_ascii

#: Rules that one sweep holds in a task; more are met in further sweeps over the same sorted urls.
RULES_IN_A_SWEEP = 200_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def key(self) -> str:
        return host_key(self.host)

    def rank(self) -> tuple:
        """The longest rule wins, then the longer host, then the smaller verdict."""
        return (-len(self.text), -len(self.host), self.text, self.verdict)


def host_key(host: str) -> str:
    return "".join(label + "." for label in reversed(host.split(".")))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url and for one without ://."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    after = F.when(at > 0, F.substr(text, at + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(after, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(after, r"\A[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def _sweep(rules: list[Rule], ranks: list[int]):
    """Walks batches sorted by key; a rule that ranks before the one found so far takes its place."""
    keys = [r.key for r in rules]

    def around(key: str) -> list[list[int]]:
        """The stack at a key: places of the rules whose interval holds it, outermost first."""
        stack = []
        for end in (i + 1 for i, c in enumerate(key) if c == "."):
            lo, hi = bisect.bisect_left(keys, key[:end]), bisect.bisect_right(keys, key[:end])
            if lo < hi:
                stack.append(list(range(lo, hi)))
        return stack

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list[int]] = []
        upcoming = None
        for batch in batches:
            ids, hosts, paths, sorted_keys, found, texts, verdicts = batch.columns
            best, texts, verdicts = found.to_pylist(), texts.to_pylist(), verdicts.to_pylist()
            for row, (key, path) in enumerate(zip(sorted_keys.to_pylist(), paths.to_pylist(), strict=True)):
                if upcoming is None:
                    stack, upcoming = around(key), bisect.bisect_right(keys, key)
                while upcoming < len(keys) and keys[upcoming] <= key:
                    while stack and not keys[upcoming].startswith(keys[stack[-1][0]]):
                        stack.pop()
                    if stack and keys[stack[-1][0]] == keys[upcoming]:
                        stack[-1].append(upcoming)
                    else:
                        stack.append([upcoming])
                    upcoming += 1
                while stack and not key.startswith(keys[stack[-1][0]]):
                    stack.pop()
                for level in stack:
                    for i in level:
                        if path.startswith(rules[i].path) and (best[row] is None or ranks[i] < best[row]):
                            best[row], texts[row], verdicts[row] = ranks[i], rules[i].text, rules[i].verdict
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    hosts,
                    paths,
                    sorted_keys,
                    pa.array(best, pa.int32()),
                    pa.array(texts, pa.string()),
                    pa.array(verdicts, pa.string()),
                ],
                names=batch.schema.names,
            )

    return run


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    default_verdict: str = "allow",
) -> DataFrame:
    """The id column, host, path, rule (its text, or null), verdict; one row per row of pages.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest wins, then
    the longer host. Defined cases: a null url and one without :// have empty host and path and get
    default_verdict; a missing id stays missing; equal rows are judged alike; no rules and no pages are
    fine. User names and ports are part of the host. Other columns of pages are left out.
    """
    by_rank = sorted(set(rules), key=Rule.rank)
    by_key = sorted(range(len(by_rank)), key=lambda i: by_rank[i].key)
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    labels = F.transform(F.reverse(F.split("host", r"\.", -1)), lambda c: F.concat(c, F.lit(".")))
    kind = urls.schema["id"].dataType.simpleString()
    nothing = {"found": "int", "rule": "string", "verdict": "string"}
    keyed = urls.select(
        "*", F.array_join(labels, "").alias("key"), *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()]
    )
    # The id is part of the range, so that one host with very many urls is spread over tasks.
    partitions = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    swept = keyed.repartitionByRange(partitions, "key", "id").sortWithinPartitions("key")
    schema = f"id {kind}, host string, path string, key string, found int, rule string, verdict string"
    for start in range(0, len(by_key), RULES_IN_A_SWEEP):
        ranks = by_key[start : start + RULES_IN_A_SWEEP]
        swept = swept.mapInArrow(_sweep([by_rank[i] for i in ranks], ranks), schema)
    return swept.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.lit(default_verdict)).alias("verdict"),
    )
