"""Importance resampling towards a target text: array-scored weights, exact ranks by regular sampling.

Words, and runs of words, are hashed into a fixed number of buckets. How often each bucket occurs in all
documents and in the target text gives its gain; a document's weight is the sum of its features' gains, read
from one array. Gumbel noise from a hash of the key turns the greatest scores into a draw without replacement.

Ranks come from a parallel sort by regular sampling. Every task stores its rows as a sorted run; rows at
regular places of all runs are the samples, and samples at regular places are the splitters. Each run falls
into segments between splitters, the segments' sizes summed over all runs say at which rank a segment
starts, and the segments that hold drawn ranks are exchanged and merged, one task each. Stored rows have a
number of their own, so that equal rows can be split as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listlake.llm.common import LOWER, saved, slices, utf8

BUCKETS = 10_000
SEED = 2024
#: Rows of a segment at most (about), and samples for each segment.
SEGMENT_ROWS = 4_000_000
SAMPLES = 16

LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


CRC = _table()


def _advance(state: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The states of crc32 after reading ``size`` bytes from ``start`` each; one byte of all words at a time."""
    state = state.copy()
    left, at = np.arange(len(state)), 0
    while len(left := left[size[left] > at]):
        s = state[left]
        state[left] = CRC[(s ^ data[start[left] + at]) & 0xFF] ^ (s >> np.uint32(8))
        at += 1
    return state


def features(data: np.ndarray, offsets: np.ndarray, longest: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row, and row and bucket of every feature.

    Words are runs of digits, letters a to z and characters beyond ASCII, A to Z lower-cased. Features are
    all runs of one to ``longest`` words of a row, joined by a space; the bucket is their crc32.
    """
    low = LOWER[data].astype(np.uint8)
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = LETTERS[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    row = np.searchsorted(offsets, start, "right") - 1
    state = np.full(len(start), 0xFFFFFFFF, np.uint32)
    found_rows, found = [], []
    for run in range(longest):
        n = max(0, len(start) - run)
        state = state[:n]
        if run:
            state = CRC[(state ^ np.uint32(32)) & 0xFF] ^ (state >> np.uint32(8))
        state = _advance(state, low, start[run:], (end - start)[run:])
        whole = row[:n] == row[run:]
        found_rows.append(row[:n][whole])
        found.append((~state[whole]) % np.uint32(buckets))
    return np.bincount(row, minlength=len(offsets) - 1), np.concatenate(found_rows), np.concatenate(found)


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows fall into each bucket: one array a task, summed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            total += np.bincount(features(*utf8(batch.column("text")), longest, buckets)[2], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "n"])

    rows = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(work, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket at most
        out[r["bucket"]] = r["n"]
    return out


def gains(given: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of a bucket's share in the target over its share in the documents, add-one smoothed."""
    b, all_given, all_wanted = len(given), float(given.sum()), float(wanted.sum())
    ratio = ((wanted + 1.0) * (all_given + b)) / ((given + 1.0) * (all_wanted + b))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def noise(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variable from the key's hash."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = 1, seed: int = SEED) -> DataFrame:
    """``id, n_words, n_features, weight, score`` for every row of ``docs``."""
    gain = gains(bucket_counts(docs, text, longest), bucket_counts(target, target_text, longest))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n_words, row, bucket = features(*utf8(batch.column("text")), longest, len(gain))
            sums = np.bincount(row, gain[bucket], batch.num_rows).astype(np.int64)
            counts = np.bincount(row, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, (n_words, counts, sums))], ["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    weighed = rows.mapInArrow(work, "id long, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed))


#: Greatest score first, then the smaller key (NULL last); the rest only makes the order total.
ORDER = ("score", "id", "n_features", "place")


def _sorted(rows: DataFrame, *first: str) -> DataFrame:
    return rows.sortWithinPartitions(*first, F.desc("score"), F.asc_nulls_last("id"), "n_features", "place")


def _order_keys(batch: pa.RecordBatch) -> np.ndarray:
    """32 bytes a row that compare as the order does."""
    out = np.empty((batch.num_rows, 4), ">u8")
    for i, name in enumerate(ORDER):
        x = batch.column(name)
        if name == "score":
            v = ~x.to_numpy(zero_copy_only=False)
        else:
            v = x.fill_null((1 << 63) - 1).to_numpy(zero_copy_only=False)
        out[:, i] = v.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return out.view("S32").ravel()


def ranked(rows: DataFrame, drawn: int, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The columns of ``rows`` and ``rank``: 1 to ``drawn`` in the order of ``ORDER``, NULL beyond.

    ``rows`` are read several times and have to be stored, as sorted runs.
    """
    spark, names = rows.sparkSession, rows.columns
    n = rows.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // segment_rows + 1)
    gap = max(1, n // (SAMPLES * parts))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at = np.arange(-seen % gap, batch.num_rows, gap)
            seen += batch.num_rows
            yield batch.take(pa.array(at))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    order = ", ".join(f"{c} long" for c in ORDER)
    samples = rows.select(*ORDER).mapInArrow(sample, order).toArrow().combine_chunks()
    keys = np.sort(np.concatenate([_order_keys(b) for b in samples.to_batches()] or [np.zeros(0, "S32")]))
    splitters = keys[np.arange(1, parts) * len(keys) // parts] if len(keys) else keys

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            segment = np.searchsorted(splitters, _order_keys(batch), "right")
            yield pa.RecordBatch.from_arrays([pa.array(segment, pa.int64()), *batch.columns], ["segment", *batch.schema.names])

    segments = rows.mapInArrow(cut, f"segment long, {kinds}")
    sizes = {r["segment"]: r["count"] for r in segments.groupBy("segment").count().collect()}  # one row a segment
    before, total = {}, 0
    for segment in sorted(sizes):
        before[segment], total = total, total + sizes[segment]
    last = max((s for s in before if before[s] < drawn), default=-1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, 0
        for batch in batches:
            segment = batch.column("segment").to_numpy()
            rank = np.empty(len(segment), np.int64)
            edges = [0, *(np.flatnonzero(segment[1:] != segment[:-1]) + 1).tolist(), len(segment)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if segment[a] != now:
                    now, seen = segment[a], before[segment[a]]
                rank[a:b] = np.arange(seen + 1, seen + 1 + b - a)
                seen += b - a
            rank = pa.array(rank, mask=rank > drawn)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], rank], [*names, "rank"])

    exchanged = segments.filter(F.col("segment") <= last).repartition(parts, "segment")
    merged = _sorted(exchanged, "segment").mapInArrow(place, f"{kinds}, rank long")
    return merged.unionByName(segments.filter(F.col("segment") > last).select(*names, F.lit(None).cast("long").alias("rank")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    seed: int = SEED,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """``<key>, n_features, weight, score, rank`` for every row of ``docs``.

    Of the rows with ``least_words`` words or more, ``percent`` of a hundred are drawn (rounded down), those of
    the highest scores, ties to the smaller key; ``rank`` counts them from 1 and is NULL for all others. A
    NULL or empty text has no features and weight 0; a NULL key counts as empty text in the hash and comes last
    among equal scores. Repeated rows are rows of their own; an empty target or no row at all is no error.
    Other columns are ignored.
    """
    scored = scores(docs, target, key, text, target_text, longest, seed)
    runs = scored.sortWithinPartitions(F.desc("score"), F.asc_nulls_last("id"), "n_features")
    runs = saved(runs.withColumn("place", F.monotonically_increasing_id()), "runs")
    able = runs.filter(F.col("n_words") >= least_words)
    out = ranked(able, able.count() * percent // 100, segment_rows)
    out = out.unionByName(runs.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(key), "n_features", "weight", "score", "rank")
