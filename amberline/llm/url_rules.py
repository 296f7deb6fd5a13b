"""Allow and block rules on URLs by a sorted sweep over reversed-host keys.

A host becomes its labels in reverse order, each closed by a zero character, so that a host and all its
subdomains are one interval of keys.  Pages are range-partitioned and sorted by (key, path); every partition is
swept once against the sorted rules with a stack of the rules whose interval is open.  A hot host is split
by path and page id, as those belong to the range key.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, map_arrow

CLOSE = "\x00"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule_key(host: str) -> str:
    return "".join(x + CLOSE for x in reversed(host.split(".")))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


class Sweep:
    """Finds the longest fitting rule of (key, path) pairs that come in key order."""

    def __init__(self, rules: Sequence[Rule]):
        by_key: dict[str, list[Rule]] = {}
        for r in sorted(set(rules), key=lambda r: (rule_key(r.host), -len(r.text), r)):
            by_key.setdefault(rule_key(r.host), []).append(r)
        self.keys, self.rules = list(by_key), list(by_key.values())
        self.next, self.stack, self.last = 0, [], None

    def start(self, key: str) -> None:
        """Opens the rules whose interval holds the first key of a partition."""
        labels = key.split(CLOSE)[:-1]
        self.stack = []
        for n in range(1, len(labels) + 1):
            prefix = "".join(x + CLOSE for x in labels[:n])
            at = bisect_right(self.keys, prefix) - 1
            if at >= 0 and self.keys[at] == prefix:
                self.stack.append(at)
        self.next = bisect_right(self.keys, key)

    def find(self, key: str, path: str) -> Rule | None:
        if self.last is None:
            self.start(key)
        elif key != self.last:
            while self.stack and not key.startswith(self.keys[self.stack[-1]]):
                self.stack.pop()
            if self.next < len(self.keys) and self.keys[self.next] <= key:
                end = bisect_right(self.keys, key, self.next)
                # of the rules passed over, only prefixes of the key are still open
                for at in range(self.next, end) if end - self.next < 64 else self._open(key, end):
                    if key.startswith(self.keys[at]):
                        self.stack.append(at)
                self.next = end
        self.last = key
        fits = [r for at in self.stack for r in self.rules[at] if path.startswith(r.path)]
        return max(fits, key=lambda r: (len(r.text), len(r.host), r.text)) if fits else None

    def _open(self, key: str, end: int) -> Iterator[int]:
        labels = key.split(CLOSE)[:-1]
        for n in range(1, len(labels) + 1):
            at = bisect_right(self.keys, "".join(x + CLOSE for x in labels[:n])) - 1
            if self.next <= at < end:
                yield at


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", block_rules: int = 100_000,
               key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict) for each row of ``pages``.

    A rule fits its host and all subdomains if the path starts with the rule's.  The longest rule (host plus path) wins; among equally
    long ones the longer host, then the greater text.  Two rules of the same host and path: block comes before allow.  A url that is null or has no ``://`` has empty host and path, which no rule
    fits; what no rule fits gets ``default``.  Null and repeated keys are kept, one result per row; an empty table gives
    no rows; other columns are ignored.  Rules are given as a list and go to the executors in blocks of at most ``block_rules``,
    each swept over the same sorted rows.
    """
    host, path = host_and_path(F.col(url))
    labels = F.reverse(F.split("host", r"\.", -1))
    rows = (pages.select(F.col(key).alias("id"), host.alias("host"), path.alias("path"))
            .withColumn("k", F.concat(F.array_join(labels, CLOSE), F.lit(CLOSE))))
    rows = (rows.repartitionByRange("k", "path", "id").sortWithinPartitions("k", "path", "id")
            .withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string"), "score": F.lit(-1).cast("long"),
                          "host_score": F.lit(-1).cast("long")}))
    unique: dict[tuple[str, str], Rule] = {}
    for r in sorted(rules, key=lambda r: r.verdict, reverse=True):
        unique[r.host, r.path] = r
    ordered = sorted(unique.values(), key=lambda r: (rule_key(r.host), r.path))
    spark = pages.sparkSession
    for first in range(0, len(ordered), block_rules):
        block = spark.sparkContext.broadcast([tuple(r) for r in ordered[first:first + block_rules]])
        rows = map_arrow(rows, _sweeper(block), rows.schema)
    return rows.select(F.col("id").alias(key), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _sweeper(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = Sweep([Rule(*r) for r in block.value])
        for batch in batches:
            keys, paths = batch.column("k").to_pylist(), batch.column("path").to_pylist()
            rule, verdict = batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()
            score, host_score = batch.column("score").to_pylist(), batch.column("host_score").to_pylist()
            for i, (k, p) in enumerate(zip(keys, paths)):
                r = sweep.find(k, p)
                if r and (len(r.text), len(r.host), r.text) > (score[i], host_score[i], rule[i] or ""):
                    rule[i], verdict[i], score[i], host_score[i] = r.text, r.verdict, len(r.text), len(r.host)
            columns = {"rule": rule, "verdict": verdict, "score": score, "host_score": host_score}
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else batch.column(f.name) for f in batch.schema],
                schema=batch.schema)

    return run
