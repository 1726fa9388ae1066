"""Exact top-k inner products by block-at-a-time pruning.

Vectors are put in order of the nearest of a few pivots, so that neighbours are alike, and cut into blocks. A
block has a forward index (its vectors) and, for each term (a dimension), the largest and smallest weight in
it. A query's bound on a block is the sum over its terms of weight times that maximum (the minimum for
negative weights). Each query takes blocks in the order of their bounds until the next one falls below
its k-th score.

On Spark this takes three steps. Blocks are packed into groups, and a query gets a first k-th score from the group it
lies in. Then batches of queries meet the maxima of all groups, without their vectors. Only blocks whose bound
reaches the k-th score of a query go on, with those queries alone, to be scored. Neither order nor
pivots change a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listlake.llm.common import discard, long_lists, saved

BLOCK = 128
BLOCKS_A_GROUP = 64
BATCH = 4096
PIVOTS = 256
#: Numbers that a group or a batch holds at most, unless one row has more.
VALUES = 1 << 22
#: Groups whose maxima one key of the join with a batch has, about.
SLOT = 64
#: Queries that are scored against their own group at a time.
STRIP = 256
LEAST = np.iinfo(np.int64).min


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Consecutive rows with vectors ``v``: at most ``most`` rows and, padded, ``VALUES`` numbers, or one row."""
    held, rows, width = [], 0, 1
    for batch in batches:
        start = 0
        for n, own in enumerate(batch.column("v").value_lengths().to_pylist()):
            if rows and (rows == most or (rows + 1) * max(width, own) > VALUES):
                yield pa.Table.from_batches([*held, batch.slice(start, n - start)])
                held, rows, width, start = [], 0, 1, n
            rows, width = rows + 1, max(width, own)
        held.append(batch.slice(start))
    if rows:
        yield pa.Table.from_batches(held)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """The vectors as rows, padded with zeros."""
    counts = np.concatenate([c.value_lengths().to_numpy() for c in vectors.chunks])
    flat = np.concatenate([c.flatten().to_numpy() for c in vectors.chunks])
    out = np.zeros((len(counts), max(1, counts.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < counts[:, None]] = flat
    return out


def _bytes(x: np.ndarray) -> bytes:
    """In the narrowest of three integer types that holds all values."""
    least, most = x.min(initial=0), x.max(initial=0)
    kind = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= least and most <= np.iinfo(t).max)
    return x.astype(kind).tobytes()


def _rows(data: bytes, count: int, width: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // (count * width)}").reshape(count, width).astype(np.int64) if count else np.zeros((0, width), np.int64)


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8")


def _padded(*matrices: np.ndarray) -> list[np.ndarray]:
    width = max(m.shape[1] for m in matrices)
    return [np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in matrices]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in floating point where no sum can pass 2^53, else in 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _extremes(vectors: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.arange(0, len(vectors), block)
    return np.maximum.reduceat(vectors, starts), np.minimum.reduceat(vectors, starts)


def _bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return _product(np.maximum(queries, 0), high) + _product(np.minimum(queries, 0), low)


def _first_kth(asked: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each row ``asked`` among the rows with other keys; the least number if there are fewer."""
    out = np.full(len(asked), LEAST)
    for a in range(0, len(asked), STRIP):
        some = asked[a : a + STRIP]
        scores = _product(vectors[some], vectors)
        scores[ids[some][:, None] == ids] = LEAST
        if len(ids) >= k:
            out[a : a + STRIP] = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
    return out


def search(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, block: int, kth: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """Place of the query, key and score of each query's k best, ties to the smaller key; and the blocks scored.

    Scores below ``kth``, what is known of each query's k-th score, are left out.
    """
    queries, vectors = _padded(queries, vectors)
    starts = np.arange(0, len(ids), block)
    bounds = _bounds(queries, *_extremes(vectors, block))
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth = np.full(len(queries), LEAST) if kth is None else kth.copy()
    q = i = s = np.zeros(0, np.int64)
    scored = 0
    for turn in range(len(starts)):
        best = order[:, turn]
        active = np.flatnonzero(bounds[np.arange(len(queries)), best] >= kth)
        if not len(active):
            break
        scored += len(active)
        by = active[np.argsort(best[active], kind="stable")]
        cuts = np.flatnonzero(np.diff(best[by])) + 1
        found = [(q, i, s)]
        for some in np.split(by, cuts):
            a = starts[best[some[0]]]
            scores = _product(queries[some], vectors[a : a + block])
            x, y = np.nonzero((scores >= kth[some][:, None]) & (ids[a : a + block][None, :] != query_ids[some][:, None]))
            found.append((some[x], ids[a + y], scores[x, y]))
        q, i, s = (np.concatenate(c) for c in zip(*found, strict=True))
        sort = np.lexsort((i, -s, q))
        q, i, s = q[sort], i[sort], s[sort]
        first = np.searchsorted(q, q, "left")
        keep = np.arange(len(q)) - first < k
        full = np.arange(len(q)) - first == k - 1
        kth[q[full]] = np.maximum(kth[q[full]], s[full])
        q, i, s = q[keep], i[keep], s[keep]
    return q, i, s, scored


def beside_pivots(good: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """The rows with ``pivot``, the nearest of as many rows as asked for, chosen by a hash of the key."""
    chosen = [np.array(r["v"], np.int64) for r in good.select("v").orderBy(F.xxhash64("id"), "v").limit(pivots).collect()]
    points = np.zeros((len(chosen), max([1, *map(len, chosen)])))
    for n, v in enumerate(chosen):
        points[n, : len(v)] = v

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, BLOCK * BLOCKS_A_GROUP):
            x = _matrix(table.column("v")).astype(np.float64)
            x, p = _padded(x, points)
            # By distance; rounding may move a vector to another pivot, which changes no result.
            nearest = np.argmin((p * p).sum(1) - 2 * (x @ p.T), axis=1)
            yield from table.append_column("pivot", pa.array(nearest)).combine_chunks().to_batches()

    return good.mapInArrow(work, "id long, v array<long>, asked boolean, pivot long")


def packed_groups(good: DataFrame, k: int, block: int, group: int, pivots: int = PIVOTS) -> DataFrame:
    """A row for each group of blocks: keys, blocks, their maxima and minima, places and first k-th scores of queries."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, block * group):
            ids, vectors = table.column("id").to_numpy(), _matrix(table.column("v"))
            asked = np.flatnonzero(table.column("asked").to_numpy())
            high, low = _extremes(vectors, block)
            yield pa.RecordBatch.from_pydict({
                "width": [vectors.shape[1]], "ids": [ids.astype("<i8").tobytes()],
                "blocks": [[_bytes(vectors[a : a + block]) for a in range(0, len(ids), block)]],
                "high": [_bytes(high)], "low": [_bytes(low)], "asked": [asked.astype("<i8").tobytes()],
                "kth": [_first_kth(asked, ids, vectors, k).astype("<i8").tobytes()], "n_asked": [len(asked)],
            })

    dealt = beside_pivots(good, pivots).repartitionByRange("pivot", "id").sortWithinPartitions("pivot", "id", "v")
    fields = "width long, ids binary, blocks array<binary>, high binary, low binary, asked binary, kth binary, n_asked long"
    return saved(dealt.mapInArrow(work, fields).withColumn("group", F.monotonically_increasing_id()), "groups")


def packed_queries(groups: DataFrame, block: int, batch: int) -> tuple[DataFrame, int]:
    """Queries in the order of groups, ``batch`` to a row or fewer; and the number that all names of batches are below."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            for r in some.to_pylist():
                ids, at = _longs(r["ids"]), _longs(r["asked"])
                if len(at):
                    sizes = np.diff([*range(0, len(ids), block), len(ids)]).tolist()
                    vectors = np.concatenate([_rows(d, n, r["width"]) for d, n in zip(r["blocks"], sizes, strict=True)])[at]
                    lists = long_lists(vectors.ravel(), np.full(len(at), r["width"]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r["group"])), pa.array(ids[at]), lists, pa.array(_longs(r["kth"]))], ["group", "id", "v", "kth"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches, batch):
            vectors = _matrix(table.column("v"))
            columns = {c: [table.column(c).to_numpy().astype("<i8").tobytes()] for c in ("place", "id", "kth")}
            yield pa.RecordBatch.from_pydict({"qplaces": columns["place"], "qids": columns["id"], "qkth": columns["kth"], "qdata": [_bytes(vectors)], "qwidth": [vectors.shape[1]]})

    parts = max(1, -(-(groups.agg(F.sum("n_asked")).first()[0] or 0) // batch))
    rows = groups.select("group", "width", "ids", "blocks", "asked", "kth").mapInArrow(rows_of, "group long, id long, v array<long>, kth long")
    rows = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(parts, "group", "place").sortWithinPartitions("group", "place")
    packed = rows.mapInArrow(pack, "qplaces binary, qids binary, qkth binary, qdata binary, qwidth long")
    return saved(packed.withColumn("batch", F.spark_partition_id()), "queries"), parts


def wanted_blocks(groups: DataFrame, queries: DataFrame, parts: int) -> DataFrame:
    """``group, need, pairs`` and queries: the blocks of a group whose bounds reach the k-th score of a query of
    a batch, how many pairs of query and block do, and those queries. Only maxima and minima are read of groups."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for r in rows.to_pylist():
                ids, places, kth = _longs(r["qids"]), _longs(r["qplaces"]), _longs(r["qkth"])
                queries, high, low = _padded(_rows(r["qdata"], len(ids), r["qwidth"]), *(_rows(r[c], r["n_blocks"], r["width"]) for c in ("high", "low")))
                reach = _bounds(queries, high, low) >= kth[:, None]
                who = np.flatnonzero(reach.any(1))
                if len(who):
                    yield pa.RecordBatch.from_pydict({
                        "group": [r["group"]], "need": [np.flatnonzero(reach.any(0)).astype(np.int32)], "pairs": [int(reach.sum())],
                        "qplaces": [places[who].tobytes()], "qids": [ids[who].tobytes()], "qkth": [kth[who].tobytes()],
                        "qdata": [_bytes(queries[who])], "qwidth": [queries.shape[1]],
                    })

    slots = max(1, -(-groups.count() // SLOT))
    maxima = groups.select("group", "width", F.size("blocks").alias("n_blocks"), "high", "low", F.pmod(F.xxhash64("group"), F.lit(slots)).cast("int").alias("slot"))
    maxima = maxima.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = queries.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    fields = "group long, need array<int>, pairs long, qplaces binary, qids binary, qkth binary, qdata binary, qwidth long"
    return maxima.join(asked, ["batch", "slot"]).mapInArrow(work, fields)


def top_k(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", is_query: Column | None = None, k: int = 10, scale: int = 1024,
    block: int = BLOCK, group: int = BLOCKS_A_GROUP, batch: int = BATCH, pivots: int = PIVOTS,
) -> DataFrame:
    """``query_id, rank, <key>, score``: the ``k`` largest inner products of every query row.

    Components are ``floor(scale * x)``; scores are exact as long as they fit a long. Queries are rows for
    which ``is_query`` (default: key divisible by 100) holds, candidates all rows with another key; fewer
    than ``k`` candidates are all returned. Rows without key or with a null vector, or one that holds null or
    non-finite components, take no part; missing dimensions count as 0. A repeated query row repeats its
    results. Other columns are ignored. ``pivots`` vectors are held by the driver.
    """
    is_query = (F.col("id") % 100 == 0) if is_query is None else is_query
    good = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    good = good.select("id", quantised(F.col("v"), scale).alias("v")).withColumn("asked", F.coalesce(is_query, F.lit(False)))
    groups = packed_groups(good, k, block, group, pivots)
    queries, parts = packed_queries(groups, block, batch)
    wanted = saved(wanted_blocks(groups, queries, parts), "wanted")
    discard(queries)
    # A group's row is read once, whatever the number of batches that want it.
    pairs = wanted.join(groups.select("group", "width", "ids", "blocks"), "group")
    pairs = pairs.withColumn("blocks", F.transform("need", lambda n: F.get("blocks", n)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for r in rows.to_pylist():
                ids, qids, places = _longs(r["ids"]), _longs(r["qids"]), _longs(r["qplaces"])
                own = [ids[n * block : (n + 1) * block] for n in r["need"]]
                vectors = np.concatenate([_rows(d, len(i), r["width"]) for d, i in zip(r["blocks"], own, strict=True)])
                at, found, scores, _ = search(qids, _rows(r["qdata"], len(qids), r["qwidth"]), np.concatenate(own), vectors, k, block, _longs(r["qkth"]))
                yield pa.RecordBatch.from_arrays([pa.array(places[at]), pa.array(qids[at]), pa.array(found), pa.array(scores)], ["place", "query_id", "id", "score"])

    found = pairs.mapInArrow(work, "place long, query_id long, id long, score long")
    place = F.row_number().over(Window.partitionBy("place", "query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
