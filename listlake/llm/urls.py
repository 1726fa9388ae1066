"""URL rules by a sort-merge range join on reversed hosts.

The canonical key of a host is its labels from the last to the first, each followed by a dot:
``m.a.net`` becomes ``net.a.m.``. A rule's host and all its subdomains are then one interval of keys, those
that begin with the rule's, and two intervals either nest or lie apart. URLs and rules are cut into ranges
of positions ``(key, place)`` and sorted; one sweep over a range keeps the rules whose interval holds the
current key on a stack, host within host, and reads a URL's rule off it. A range starts with the rules
that are open at its first position: their keys are the beginnings of that one, so they are found by equality.

A hot host's URLs differ in ``place`` and fill as many ranges as they need. A task holds the rules of one
chain of hosts, from a top domain down; the driver holds one position a range.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listlake.llm.common import saved

#: Code points of a key that count for its position; rules reach all ranges whose first position may hold them.
POSITION = 256
#: URLs of a range at most, and positions drawn for each range to choose the bounds.
RANGE_ROWS = 2_000_000
DRAWN = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A to Z lower-cased: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; path: from
    there up to ``?``, ``#`` or the end. Both are empty without ``://`` and for NULL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]", -1)), "."), F.lit("."))


class _Frame:
    """The rules of one host: path to rule, and the lengths of their paths, longest first."""

    __slots__ = ("key", "sizes", "paths")

    def __init__(self, key: str) -> None:
        self.key, self.sizes, self.paths = key, [], {}

    def add(self, host: str, path: str, verdict: str) -> None:
        known = self.paths.get(path)
        if known is None:
            if -len(path) not in self.sizes:
                insort(self.sizes, -len(path))
            self.paths[path] = (host + path, verdict)
        elif verdict == "block":
            self.paths[path] = (host + path, verdict)

    def find(self, path: str) -> tuple[str, str] | None:
        for size in self.sizes:
            if -size <= len(path) and (found := self.paths.get(path[:-size] if size else "")):
                return found
        return None


def _sweep(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    stack: list[_Frame] = []
    now = None
    for batch in batches:
        place, rules, verdicts = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("part", "key", "rule", "host", "path", "verdict"))
        for i, (part, key, rule, host, path, verdict) in enumerate(zip(*columns, strict=True)):
            if part != now:
                stack.clear()
                now = part
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            if rule:
                if not stack or stack[-1].key != key:
                    stack.append(_Frame(key))
                stack[-1].add(host, path, verdict)
                continue
            best = None
            for frame in reversed(stack):  # the longer host first, so that it wins a tie
                found = frame.find(path)
                if found and (best is None or len(found[0]) > len(best[0])):
                    best = found
            place.append(i)
            rules.append(best and best[0])
            verdicts.append(best[1] if best else default)
        rows = batch.take(pa.array(place, pa.int64())).select(["id", "host", "path"])
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], ["id", "host", "path", "rule", "verdict"])


def _ranged(rows: DataFrame, bounds: list[tuple[str, int]]) -> DataFrame:
    """``part`` in front: how many bounds are at or before a row's position."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = zip(batch.column("key").to_pylist(), batch.column("place").to_pylist(), strict=True)
            part = pa.array([bisect_right(bounds, (key[:POSITION], place)) for key, place in at], pa.int32())
            yield pa.RecordBatch.from_arrays([part, *batch.columns], ["part", *batch.schema.names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(work, f"part int, {fields}")


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``<key>, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` holds ``host, path, verdict`` (``allow`` or ``block``). A rule fits its host and all subdomains
    if the URL's path starts with the rule's (compared as they are; a rule's host is lower-cased). Of those
    that fit, the one with the most characters in ``host`` and ``path`` wins, then the longer host; of two
    rules with one host and path ``block`` wins. Rules without a host fit nothing, a NULL path is empty.
    ``rule`` is its host and path, or NULL where none fits; ``verdict`` is then ``default``. A NULL URL, or one
    without ``://``, has an empty host and no rule. Repeated and NULL keys give a row each; other columns are ignored.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url).cast("string"))
    parsed = pages.select(F.col(key).alias("id"), host.alias("host"), path.alias("path"))
    # The number of a stored row does not change any more, so its hash may decide where the row goes.
    urls = saved(parsed.withColumn("place", F.xxhash64(F.monotonically_increasing_id())), "urls")
    named = urls.filter("host <> ''").withColumn("key", reversed_host(F.col("host")))

    n = named.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // range_rows + 1)
    drawn = named.filter(F.pmod("place", F.lit(max(1, n // (DRAWN * parts)))) == 0).select(F.substring("key", 1, POSITION), "place")
    drawn = sorted((r[0], r[1]) for r in drawn.collect())
    bounds = sorted({drawn[i * len(drawn) // parts] for i in range(1, parts)}) if drawn else []

    given = rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    given = given.filter("host <> ''").distinct().withColumn("key", reversed_host(F.col("host")))
    starts = {(p + 1, k[:i]) for p, (k, _) in enumerate(bounds) for i in [*(i + 1 for i, c in enumerate(k) if c == "."), len(k)]}
    starts = spark.createDataFrame(sorted(starts), "part int, begin string")
    here = _ranged(given.withColumn("place", F.lit(-(1 << 63))), bounds).drop("place")
    carried = starts.join(given, F.substring("key", 1, POSITION) == F.col("begin")).select(*here.columns)
    every = here.unionByName(carried).withColumn("rule", F.lit(True))
    rows = _ranged(named, bounds).drop("place").withColumn("rule", F.lit(False))
    rows = rows.unionByName(every, allowMissingColumns=True)
    rows = rows.repartition(parts, "part").sortWithinPartitions("part", "key", F.desc("rule"))
    kind = urls.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(lambda b: _sweep(b, default), f"id {kind}, host string, path string, rule string, verdict string")
    without = urls.filter("host = ''").select("id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    return found.unionByName(without).withColumnRenamed("id", key)
