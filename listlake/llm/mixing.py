"""Mixing sources to target weights by balanced sampling (cube method).

A source's target over its size is the number of times its documents are wanted: the whole part is
taken of all, and the fraction is an inclusion probability. The flight phase moves the probabilities
of three documents at a time along the direction that changes neither their expected words nor their
expected number, until one of them is 0 or 1. Documents are dealt to buckets of their source, each
flown on its own; what is left of a bucket (at most two documents and a few that were reserved) is
flown again with the rest of the source, until a landing problem of at most RESERVED + 2 documents per
source remains. It is solved by trying all choices.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listlake.llm.common import mix, numbered, runs, saved, utf8, words
from listlake.operators.joins import unused

WEIGHTS = (5, 2, 1)
CAP = 3
#: Documents of a bucket; each step of the flight over what is left has so many buckets fewer.
BUCKET = 20_000
RESERVED = 12
#: Probabilities nearer than this to 0 or 1 count as decided.
TINY = 1e-9


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", row: str | None = None) -> DataFrame:
    """``id, source, size``: the number of words of each row's whole text (null: 0); ``row`` is carried along."""
    carried = ["id", "source", *([row] if row else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, row = words(*utf8(batch.column("text")))
            size = np.bincount(row, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*map(batch.column, carried), pa.array(size, pa.int64())], [*carried, "size"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(source).cast("string").alias("source"), *carried[2:], F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, "id long, source string, " + (f"`{row}` long, " if row else "") + "size long")


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, rows, target``: one row per source, all of them sharing the total size.

    Weights repeat over the sources in the order of their code points, null last. A target stops at
    ``cap`` times its source's size; what it leaves is shared by weight among the others. With sources in
    the order of cap by weight, the capped ones come first, so running sums give the answer at once.
    """
    each = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    # One row per source from here on.
    place = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    each = each.withColumn("weight", F.get(F.array(*(F.lit(float(w)) for w in weights)), place))
    each = each.withColumn("most", (cap * F.col("source_size")).cast("long")).withColumn("ratio", F.col("most") / F.col("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("total", F.sum("source_size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
    level = (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))) / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    each = each.withColumn("level", level).withColumn("free", F.col("level") <= F.col("ratio"))
    # The level of the first source that is not capped, which is the highest of these, holds for all after it.
    each = each.withColumn("shared", F.max(F.when(F.col("free"), F.col("level"))).over(everything))
    return each.select("source", "source_size", "rows", F.when(F.col("free"), F.col("weight") * F.col("shared")).otherwise(F.col("most").cast("double")).alias("target"))


def uniform(ids: np.ndarray, sizes: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) from key, size and salt: the same on every run."""
    return (mix(mix(ids.view(np.uint64) + np.uint64(salt)) ^ sizes.view(np.uint64)) >> np.uint64(11)) / 2.0**53


def flight(p: list[float], size: list[float], chance: list[float]) -> list[int]:
    """Moves ``p`` in place, three at a time, keeping its sum and its sum weighted by size; the places left.

    A step's direction u solves ``u1 + u2 + u3 = 0`` and ``s1 u1 + s2 u2 + s3 u3 = 0``; it goes one of
    two ways, each as far as possible, with the odds that keep every probability's expectation.
    """
    open_: list[int] = []
    for n, x in enumerate(p):
        if TINY < x < 1 - TINY:
            open_.append(n)
        else:
            p[n] = float(round(x))
        while len(open_) == 3:
            a, b, c = open_
            u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
            if u == (0, 0, 0):
                u = (1.0, -1.0, 0.0)
            up = min(((1 - p[k]) / v if v > 0 else -p[k] / v) for k, v in zip(open_, u, strict=True) if v)
            down = min((p[k] / v if v > 0 else (p[k] - 1) / v) for k, v in zip(open_, u, strict=True) if v)
            step = up if chance[c] * (up + down) < down else -down
            for k, v in zip(open_, u, strict=True):
                p[k] += step * v
                if p[k] <= TINY:
                    p[k] = 0.0
                elif p[k] >= 1 - TINY:
                    p[k] = 1.0
            left = [k for k in open_ if 0 < p[k] < 1]
            if len(left) == 3:  # rounding: decide the nearest
                near = min(left, key=lambda k: min(p[k], 1 - p[k]))
                p[near] = float(round(p[near]))
                left.remove(near)
            chance[c] = (chance[c] * 7919.0 + 0.5) % 1
            open_ = left
    return open_


def landing(p: list[float], size: list[float], left: list[int]) -> None:
    """Decides the last few so that words and documents differ least from what was expected."""
    if not left:
        return
    amount, chance = np.array([size[k] for k in left]), np.array([p[k] for k in left])
    taken = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    off = np.abs(taken @ amount - chance @ amount) / max(1.0, amount.mean()) + 0.02 * np.abs(taken.sum(1) - chance.sum())
    for k, bit in zip(left, taken[int(np.argmin(off))].tolist(), strict=True):
        p[k] = float(bit)


def reserve(p: list[float], size: np.ndarray, chance: np.ndarray) -> list[int]:
    """A few documents of ordinary size that stay out of the flight and make the landing fine."""
    open_ = np.flatnonzero((np.array(p) > TINY) & (np.array(p) < 1 - TINY))
    small = open_[size[open_] <= size[open_].mean()] if len(open_) else open_
    return small[np.argsort(chance[small], kind="stable")[:RESERVED]].tolist()


def _flown(rows: DataFrame, salt: int, last: bool) -> DataFrame:
    """The flight of every ``(source, bucket)``; the last one also lands."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["source", "bucket"]):
            ids, size = group.column("id").fill_null(-1).to_numpy(), group.column("size").to_numpy()
            p = group.column("p").to_numpy().tolist()
            amount = size.astype(float).tolist()
            chance = uniform(ids, size, salt)
            kept = reserve(p, size, chance)
            flown = np.setdiff1d(np.arange(len(p)), kept).tolist()
            part = [p[k] for k in flown]
            left = [flown[k] for k in flight(part, [amount[k] for k in flown], chance[flown].tolist())]
            for k, x in zip(flown, part, strict=True):
                p[k] = x
            if last:
                landing(p, amount, left + kept)
            at = group.schema.get_field_index("p")
            yield from group.set_column(at, "p", pa.array(p)).to_batches()

    dealt = rows.repartition("source", "bucket").sortWithinPartitions("source", "bucket", "id", "size", "p")
    return dealt.mapInArrow(work, rows.schema)


def mixed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, cap: int = CAP, bucket: int = BUCKET, seed: int = 11, row: str | None = None,
) -> DataFrame:
    """``<key>, <source>, size, source_size, target, copies, taken`` for every row of ``docs``, and the column
    ``row``, if one is named.

    ``copies`` (0 to ``cap``) says how often the mix takes the row and ``taken`` how many words these are.
    A null source is a source; a null or empty text has size 0. A source without words has target 0 and
    is not taken. Rows that are equal in key and size are decided apart. Runs over the same rows agree,
    however they are partitioned. Other columns are ignored.
    """
    sized = saved(sizes(docs, key, text, source, row), "sizes")
    carried = [row] if row else []
    wanted = targets(sized, weights, cap).withColumnRenamed("source", "of")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sized.join(wanted, F.col("source").eqNullSafe(F.col("of"))).select(
        "id", "source", *carried, "size", "source_size", "target", F.floor(times).cast("long").alias("whole"), (times - F.floor(times)).alias("p"),
        F.pmod(F.xxhash64("id", F.lit(seed)), F.greatest(F.ceil(F.col("rows") / bucket), F.lit(1))).alias("bucket"),
    )
    decided, salt = None, seed
    while True:
        most = rows.agg(F.max("bucket")).first()[0]
        rows = saved(_flown(rows, salt, not most), "flown")
        if not most:
            break
        done = rows.filter((F.col("p") == 0) | (F.col("p") == 1))
        decided = done if decided is None else decided.unionAll(done)
        rows = rows.filter("p > 0 and p < 1").withColumn("bucket", F.floor(F.col("bucket") / bucket))
        salt += 1
    rows = rows if decided is None else decided.unionAll(rows)
    copies = (F.col("whole") + F.col("p")).cast("long")
    return rows.select(F.col("id").alias(key), F.col("source").alias(source), *carried, "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with all its columns.

    Rows are decided one by one, also where keys are null or repeated.
    """
    rows, row = numbered(docs, "dealt")
    copies, times = mixed(rows, key, text, source, weights, cap, row=row), unused("times", rows)
    taken = copies.filter("copies > 0").select(row, F.col("copies").cast("int").alias(times))
    joined = rows.join(taken, row).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return joined.select(*docs.columns)
