"""URL rules by a sort-merge range join over reversed-host keys.

A domain's reversed-host key is a prefix of the keys of all its subdomains, so a rule's host is an
interval of keys, and such intervals are nested or apart. URLs and rules are dealt by ranges of
keys (a rule goes to each range that it overlaps), sorted, and swept once: a stack holds the
hosts whose intervals are open, and each open host holds its rules' paths, nested as well.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visittrail.llm.common import prepare
from visittrail.llm.urls import host_of, path_of, reversed_host

#: Keys that the ranges are cut from: at most so many for each range. Only balance depends on it.
KEYS_PER_RANGE, MOST_KEYS = 50, 100_000


class OpenHost:
    """A rule host whose interval is open, with its paths in order and their nesting."""

    def __init__(self, key: str, host: str):
        self.key, self.host = key, host
        self.paths: list[str] = []
        self.verdicts: dict[str, str] = {}
        self._outer: list[int] | None = None

    def add(self, path: str, verdict: str) -> None:
        """Of equal rules with different verdicts the first in order of verdict holds."""
        if path not in self.verdicts:
            self.paths.append(path)
        self.verdicts[path] = min(verdict, self.verdicts.get(path, verdict))
        self._outer = None

    def longest(self, path: str) -> str | None:
        if self._outer is None:
            self.paths.sort()
            self._outer, stack = [], []
            for i, p in enumerate(self.paths):
                while stack and not p.startswith(self.paths[stack[-1]]):
                    stack.pop()
                self._outer.append(stack[-1] if stack else -1)
                stack.append(i)
        i = bisect.bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self._outer[i]
        return self.paths[i] if i >= 0 else None


class Sweep:
    """Takes rules and URLs in the order of their keys, rules first."""

    def __init__(self, default: str):
        self.default, self.stack = default, []

    def _close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1].key):
            self.stack.pop()

    def rule(self, key: str, host: str, path: str, verdict: str) -> None:
        self._close(key)
        for level in self.stack:
            if level.host == host:
                level.add(path, verdict)
                return
        self.stack.append(OpenHost(key, host))
        self.stack[-1].add(path, verdict)

    def url(self, key: str, host: str, path: str) -> tuple[str | None, str]:
        """The longest rule that fits, host and path together, and among equals the longest host."""
        self._close(key)
        best, verdict = None, self.default
        for level in reversed(self.stack):
            if host != level.host and not host.endswith("." + level.host):
                continue
            fits = level.longest(path)
            if fits is not None and (best is None or len(level.host + fits) > len(best)):
                best, verdict = level.host + fits, level.verdicts[fits]
        return best, verdict


def judged(urls: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = (),
           default: str = "allow") -> DataFrame:
    """The columns to keep, and host, path, rule, verdict of every row of urls.

    rules: (host, path, verdict). A rule fits its host and all its subdomains, if the URL's path
    starts with its path; the longest wins; a URL that no rule fits gets `default`, and no rule. A
    null URL or one without :// has an empty host and path. A rule with a null or empty host or a
    null verdict is left out, a null path is empty. Repeated rows of urls each give a row.
    """
    spark = prepare(urls.sparkSession)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = urls.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)),
                        host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    given = given.withColumn("key", F.concat(reversed_host(F.col("host")), "path"))
    kept = [f"k{i}" for i in range(len(keep))]

    share = min(1.0, KEYS_PER_RANGE * n / max(given.count(), 1))
    some = sorted(r[0] for r in given.sample(share, 7).select("key").limit(MOST_KEYS).collect())
    bounds = [some[i * len(some) // n] for i in range(1, n)] if some else []

    # A key equal to several bounds may go to any range between them, so that a URL that many rows
    # share is dealt out; rules go to each of these ranges.
    place = _range_of(bounds)
    at = place("key", "key")
    width = at["high"] - at["low"] + 1
    part = at["low"] + F.pmod(F.xxhash64(F.monotonically_increasing_id()), width).cast("int")
    left = given.select(
        part.alias("part"), "key", F.lit(1).alias("is_url"), "host", "path",
        F.lit(None).cast("string").alias("verdict"), *kept)

    sound = rules.filter("host <> '' and verdict is not null").select(
        F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    sound = sound.distinct().withColumn("key", reversed_host(F.col("host")))
    span = place(F.col("key"), F.concat("key", F.lit("\U0010ffff")))
    right = sound.select(
        F.explode(F.sequence(span["low"], span["high"])).alias("part"), "key",
        F.lit(0).alias("is_url"), "host", "path", "verdict",
        *(F.lit(None).cast(t).alias(k) for k, t in given.select(*kept).dtypes))

    swept = left.unionByName(right).repartition(n, "part").sortWithinPartitions(
        "part", "key", "is_url", "path", "verdict")
    schema = ", ".join([*(f"{k} {t}" for k, t in given.select(*kept).dtypes),
                        "host string, path string, rule string, verdict string"])
    out = swept.mapInArrow(lambda batches: _sweep(batches, kept, default), schema)
    return out.withColumnsRenamed(dict(zip(kept, keep, strict=True)))


def _range_of(bounds: list[str]):
    """Numbers of the first and last range that keys from `first` to `last` may be in."""
    @F.arrow_udf("struct<low: int, high: int>")
    def place(first: pa.Array, last: pa.Array) -> pa.Array:
        low = [bisect.bisect_left(bounds, k) for k in first.to_pylist()]
        high = [bisect.bisect_right(bounds, k) for k in last.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array(low, pa.int32()), pa.array(high, pa.int32())], ["low", "high"])

    return lambda first, last: place(first, last)


def _sweep(batches: Iterator[pa.RecordBatch], kept: list[str], default: str):
    part, sweep = None, None
    for batch in batches:
        rows = [batch.column(n).to_pylist()
                for n in ("part", "key", "is_url", "host", "path", "verdict")]
        urls, rule, verdict = [], [], []
        for i, (own, key, is_url, host, path, said) in enumerate(zip(*rows, strict=True)):
            if own != part:
                part, sweep = own, Sweep(default)
            if is_url:
                found = sweep.url(key, host, path)
                urls.append(i)
                rule.append(found[0])
                verdict.append(found[1])
            else:
                sweep.rule(key, host, path, said)
        some = batch.take(pa.array(urls, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*(some.column(k) for k in kept), some.column("host"), some.column("path"),
             pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
            [*kept, "host", "path", "rule", "verdict"])
