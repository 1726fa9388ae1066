"""Near-duplicate documents: bottom-k sketches, sketch estimates, exact Jaccard, components.

One hash function orders all word shingles; a document's sketch is the k smallest hashes of its set.
Documents with equal sets are one class and go on as one row. Inverted lists over retained values
give the candidates: two linked documents share at least ``need`` sketch values (certain for sets of
at most k shingles, else with a probability of missing below 1e-9), so with the values of every
sketch in order of their document frequency, rarest first, they meet in a list of the first
``size - need + 1``. Very frequent shingles come last and hardly ever make a list.

Candidates are taken in two rounds. The first pairs every member of a list with the list's centre, the
document with the most values that others have too, which joins large groups of copies without forming
their pairs. The second looks at all other pairs of a list, in blocks of bounded size. What is compared there is a
bitmap of each sketch: two bitmaps differ in no more bits than the sketches do in values, so a pair
whose bitmaps differ in more than a pair that passes the estimate could is out, and most pairs that share a phrase
by chance are. Of the others no more than a spanning forest is kept: its trees are groups that hold every
further link. In each group, again block against block, pairs of documents that are not yet connected
are tested. A link counts after the union-sketch estimate and the exact test on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listlake.llm.common import discard, long_lists, mix, numbered, runs, saved, slices, utf8, word_hashes, words

K = 96
#: Shared sketch values that a linked pair has at least, if both sets have K shingles or more.
NEED = 50
#: Estimates may fall short of the threshold by so much (five standard errors).
SLACK = 0.2
#: Lists that a document shares with a centre before the first round compares them.
STAR = 4
#: Bits of a sketch's bitmap: sketches of different documents differ in far more of them than linked ones may.
BITS = 512
#: Documents of a block of bitmaps, and of full sets.
BLOCK = 1024
SET_BLOCK = 128
#: Rows of a block whose differences are computed at a time.
STRIP = 128


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each row's n-word shingles; a row of fewer words has one, of none none."""
    start, end, row = words(data, offsets)
    h = word_hashes(data, start, end)
    counts = np.bincount(row, minlength=len(offsets) - 1)
    at = np.concatenate([[0], np.cumsum(counts)])
    s = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for i in range(n):
        s = mix(s * np.uint64(0x2545F4914F6CDD1D) + h[i : i + len(s)])
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(s[a : b - n + 1]))
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for x in h[a:b]:
                whole = mix(whole * np.uint64(0x2545F4914F6CDD1D) + x)
            out.append(mix(whole + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    """Order-preserving: the smallest unsigned hash becomes the smallest long."""
    return (x ^ np.uint64(1 << 63)).view(np.int64)


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, k: int = K, full: bool = False) -> DataFrame:
    """``id, size, f1, f2, sketch`` per row: set size, a 128-bit fingerprint of the set, its k smallest hashes.

    ``full`` gives ``id, shingles`` with the whole sorted set instead.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [_signed(x) for x in shingles(*utf8(batch.column("text")), n)]
            if full:
                yield pa.RecordBatch.from_arrays([batch.column("id"), long_lists(sets)], ["id", "shingles"])
                continue
            prints = [
                np.array([mix(s.view(np.uint64) + np.uint64(c)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                for c in (0x51ED270B, 0x7F4A7C15)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, prints), long_lists([s[:k] for s in sets])],
                ["id", "size", "f1", "f2", "sketch"],
            )

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, "id long, shingles array<long>" if full else "id long, size long, f1 long, f2 long, sketch array<long>")


def postings(classes: DataFrame, k: int = K, need: int = NEED, share: float = 0.8) -> DataFrame:
    """``v, id, size, rank``: the inverted lists, rarest values first, without values of a single class.

    ``rank`` orders documents by the number of their values that others have too, then by a hash of the id.
    """
    values = classes.select("id", "size", F.explode("sketch").alias("v"))
    frequent = values.groupBy("v").count().filter("count > 1").withColumnRenamed("count", "df")
    least = F.least(F.lit(need), F.ceil(F.col("size") * share - 1e-9))
    kept = F.least(F.lit(k), F.col("size"))
    return (
        values.join(frequent, "v")
        .groupBy("id", "size")
        .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("common"))
        # Values of one class only are the rarest: they come first and make no list.
        .withColumn("take", (kept - least + 1) - (kept - F.size("common")))
        .filter("take > 0")
        .withColumn("rank", F.size("common").cast("long") * F.lit(1 << 52) + F.pmod(F.xxhash64("id"), F.lit(1 << 52)))
        .select("id", "size", "rank", F.explode(F.slice("common", 1, F.col("take").cast("int"))).alias("c"))
        .select("id", "size", "rank", F.col("c.v").alias("v"))
    )


def different_lists(lists: DataFrame) -> DataFrame:
    """``v, id`` of one list for each set of members: copies share many values, and so many lists, which would
    all be compared anew. Sets are told apart by their size and two sums of 64 bits."""
    sums = [F.bit_xor(F.xxhash64("id", F.lit(salt))).alias(f"s{salt}") for salt in (1, 2)]
    sets = lists.groupBy("v").agg(F.count(F.lit(1)).alias("n"), *sums).filter("n > 1")
    return lists.join(sets.groupBy("n", "s1", "s2").agg(F.min("v").alias("v")).select("v"), "v", "left_semi")


def of_like_size(lists: DataFrame, percent: int) -> DataFrame:
    """Without members whose set is too small or too large to be linked with any other of their list: in the
    order of sizes a neighbour has to be in reach."""
    by_size = Window.partitionBy("v").orderBy("size")
    reach = (100 * F.lag("size").over(by_size) >= percent * F.col("size")) | (100 * F.col("size") >= percent * F.lead("size").over(by_size))
    return lists.withColumn("reach", reach).filter("reach").drop("reach")


def bitmaps(classes: DataFrame, bits: int = BITS) -> DataFrame:
    """``id, items``: the bits that a sketch's values set, 64 in a number, and how many values it has."""
    words_ = bits // 64

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("sketch")
            at = column.offsets.to_numpy().astype(np.int64)
            values = column.values.to_numpy()[at[0] : at[-1]].view(np.uint64)
            counts = np.diff(at)
            row = np.repeat(np.arange(batch.num_rows), counts)
            bit = mix(values) & np.uint64(bits - 1)
            out = np.zeros((batch.num_rows, words_ + 1), np.uint64)
            np.bitwise_or.at(out, (row, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
            out[:, -1] = counts
            yield pa.RecordBatch.from_arrays([batch.column("id"), long_lists(out.ravel(), np.full(batch.num_rows, words_ + 1))], ["id", "items"])

    return classes.select("id", "sketch").mapInArrow(work, "id long, items array<long>")


def estimated(pairs: DataFrame, classes: DataFrame, k: int, least: float) -> DataFrame:
    """The pairs whose union sketch holds a share of ``least`` or more common values."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("sketch").alias(f"s{x}"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    common = F.size(F.array_intersect(F.array_intersect("sa", "sb"), F.col("u")))
    joined = pairs.join(side("b"), "b").join(side("a"), "a").withColumn("u", union)
    return joined.filter(common >= least * F.size("u")).select("a", "b").distinct()


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, link``: the exact test ``100 * intersection >= percent * union`` on full sets."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"s{x}"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - F.col("common")
    return (
        pairs.join(side("b"), "b").join(side("a"), "a").withColumn("common", common)
        .groupBy("a", "b").agg(F.max(100 * F.col("common") >= percent * union).alias("link"))
    )


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for every node of ``a, b``: the smallest id that it reaches.

    Every round points each node's neighbours, then each node, to the smallest id around it.
    """
    around = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = around.unionAll(around.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        joined = small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after = saved(joined.filter("a <> b").distinct(), "edges")
        # Done once every node has one edge and it leads to a node without one.
        most = after.groupBy("a").count().filter("count > 1").limit(1).count()
        if not most and not after.select("b").join(after.select("a"), F.col("b") == F.col("a"), "left_semi").limit(1).count():
            break
        around = after
    roots = after.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionAll(roots.select("root", "root").toDF("id", "root").distinct())


def _forest(roots: np.ndarray, found: list[tuple[int, int]], link) -> list[tuple[int, int]]:
    """Of the pairs in order, those that connect what was not connected before and that ``link`` accepts; rows
    of one root are connected from the start."""
    tree = list(range(len(roots)))

    def top(n: int) -> int:
        while tree[n] != n:
            tree[n] = n = tree[tree[n]]
        return n

    by_root: dict[int, int] = {}
    for n, root in enumerate(roots.tolist()):
        tree[n] = by_root.setdefault(root, n)
    apart, out = len(by_root) - 1, []
    for a, b in found:
        p, q = top(a), top(b)
        if p != q and link(a, b):
            tree[q] = p
            out.append((a, b))
            apart -= 1
            if not apart:
                break
    return out


def _forest_of_bits(items: list[np.ndarray], roots: np.ndarray, part: np.ndarray | None, least: float) -> list[tuple[int, int]]:
    """Pairs that connect all rows which bitmaps connect: two rows may pass the estimate if their bitmaps differ in
    no more bits than their sketches may in values. Rows of one root are connected; with ``part`` only
    rows of different parts are compared."""
    rows = np.stack(items)
    sizes = rows[:, -1].astype(np.float32)
    bits = np.unpackbits(np.ascontiguousarray(rows[:, :-1]).view(np.uint8), axis=1).astype(np.float32)
    ones = bits.sum(1)
    near = np.empty((len(rows), len(rows)), bool)
    for a in range(0, len(rows), STRIP):  # so that no more than a strip is held in numbers
        z = slice(a, a + STRIP)
        # Of the union's least values that share is common, which are at least so many of the larger sketch.
        common = np.ceil(np.float32(least) * np.maximum(sizes[z, None], sizes) - np.float32(1e-3))
        near[z] = ones[z, None] + ones - 2 * (bits[z] @ bits.T) <= sizes[z, None] + sizes - 2 * common
    if part is not None:
        _, part = np.unique(part.astype(str), return_inverse=True)
        near &= part[:, None] != part
    _, root = np.unique(roots, return_inverse=True)
    mates: dict[int, list[int]] = {}
    for n, r in enumerate(root.tolist()):
        mates.setdefault(r, []).append(n)
    seen = np.zeros(len(items), bool)
    out: list[tuple[int, int]] = []
    for first in range(len(items)):
        if seen[first]:
            continue
        open_ = list(mates[root[first]])
        seen[open_] = True
        while open_:
            n = open_.pop()
            for m in np.flatnonzero(near[n] & ~seen).tolist():
                if not seen[m]:
                    out.append((n, m))
                    seen[mates[root[m]]] = True
                    open_ += mates[root[m]]
    return out


def _by_sketches(sets: list[np.ndarray], k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``x, y`` of all pairs that pass the union-sketch estimate, the best first; ``sets`` are sorted."""
    lists = [x[:k] for x in sets]
    sizes = np.array([len(x) for x in lists])
    values, where = np.unique(np.concatenate(lists), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    often = np.bincount(where, minlength=len(values)) > 1
    column = np.cumsum(often) - 1
    inside = np.zeros((len(sets), max(1, int(often.sum()))), np.float32)
    keep = often[where]
    inside[owner[keep], column[where[keep]]] = 1
    x, y = np.nonzero(np.triu(inside @ inside.T >= least * np.maximum(sizes[:, None], sizes[None, :]), 1))
    ranks = np.arange(len(sets) * k, dtype=np.int32).reshape(len(sets), k) + len(values)  # padding, all different
    ranks[owner, np.concatenate([np.arange(n) for n in sizes])] = where
    share = np.zeros(len(x))
    for a in range(0, len(x), 20_000):
        p, q = x[a : a + 20_000], y[a : a + 20_000]
        both = np.sort(np.concatenate([ranks[p], ranks[q]], axis=1), axis=1)
        twice = both[:, 1:] == both[:, :-1]
        real = (both < len(values)).sum(1) - twice.sum(1)  # of the union
        size = np.minimum(real, k)
        distinct = 1 + np.arange(1, 2 * k) - np.cumsum(twice, axis=1)
        share[a : a + 20_000] = (twice & (distinct <= size[:, None])).sum(1) / size
    order = np.argsort(-share, kind="stable")
    order = order[share[order] >= least]
    return x[order], y[order]


def _compare(batches: Iterator[pa.RecordBatch], k: int, least: float, percent: int | None) -> Iterator[pa.RecordBatch]:
    """Pairs ``a, b`` of each block against block that form a spanning forest, on top of the known components.

    Its edges are pairs whose bitmaps say that they may pass the estimate; with ``percent``, rows hold full sets
    and edges pass the estimate, best first, and the exact test.
    """
    for group in runs(batches, ["v", "i", "j"]):
        ids, roots = group.column("id").to_numpy(), group.column("root").to_numpy()
        block = group.column("block").to_numpy(zero_copy_only=False)
        across = group.column("i")[0] != group.column("j")[0]
        items = [x.values.to_numpy() for x in group.column("items").combine_chunks()]
        if percent is None:
            out = _forest_of_bits(items, roots, block if across else None, least)
        else:
            x, y = _by_sketches(items, k, least)
            other = (roots[x] != roots[y]) & ((block[x] != block[y]) if across else True)

            def link(a: int, b: int, items: list[np.ndarray] = items) -> bool:
                common = len(np.intersect1d(items[a], items[b], assume_unique=True))
                return 100 * common >= percent * (len(items[a]) + len(items[b]) - common)

            out = _forest(roots, list(zip(x[other].tolist(), y[other].tolist(), strict=True)), link)
        if out:
            a, b = map(np.array, zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(ids[a], ids[b])), pa.array(np.minimum(ids[a], ids[b]))], ["a", "b"])


def block_pairs(lists: DataFrame, roots: DataFrame, items: DataFrame, k: int, least: float, percent: int | None = None) -> DataFrame:
    """Pairs ``a, b`` of all lists ``v, id`` that hold several components, see ``_compare``.

    ``items`` has the bitmap of each id's sketch or, with ``percent``, its set.
    A component with many members in a list fills blocks of its own, which are not compared with each
    other; the rest is dealt by component. No task sees more than a few blocks at a time.
    """
    block = BLOCK if percent is None else SET_BLOCK
    members = lists.join(roots, "id", "left").select("v", "id", F.coalesce("root", "id").alias("root"))
    sizes = members.groupBy("v", "root").agg(F.count(F.lit(1)).alias("own"))
    several = sizes.groupBy("v").agg(
        F.count(F.lit(1)).alias("roots"), F.sum(F.when(F.col("own") < block, F.col("own")).otherwise(0)).alias("rest")
    ).filter("roots > 1")
    sizes = sizes.join(several, "v").withColumn("alone", F.col("own") >= block)
    parts = F.ceil(F.when(F.col("alone"), F.col("own")).otherwise(F.col("rest")) / block).cast("int")
    members = members.join(sizes.select("v", "root", "alone", parts.alias("parts")), ["v", "root"]).select(
        "v", "id", "root", F.when(F.col("alone"), F.col("root")).alias("owner"),
        F.pmod(F.xxhash64(F.when(F.col("alone"), F.col("id")).otherwise(F.col("root"))), "parts").alias("part"),
    )
    # Names of blocks: the owner (or none) and the part.
    members = members.withColumn("block", F.concat_ws("/", F.col("owner").cast("string"), F.col("part").cast("string")))
    blocks = members.groupBy("v", "block", "owner").agg(F.count(F.lit(1)).alias("n"))
    other = blocks.select("v", F.col("block").alias("j"), F.col("owner").alias("other"))
    met = blocks.withColumnRenamed("block", "i").join(other, "v").filter("i <= j and (owner is null or other is null or owner <> other)")
    dealt = met.select("v", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    rows = members.join(dealt, ["v", "block"]).join(items.toDF("id", "items"), "id")
    rows = rows.select("v", "i", "j", "block", "id", "root", "items").repartition("v", "i", "j").sortWithinPartitions("v", "i", "j")
    return rows.mapInArrow(lambda batches: _compare(batches, k, least, percent), "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80, k: int = K, need: int = NEED
) -> DataFrame:
    """``<key>, n_shingles, component_id, kept`` per row of documents linked at ``percent`` % Jaccard or more.

    A row's set: its distinct n-word shingles, A to Z lower-cased; with fewer words the whole sequence
    as one shingle; a row without words is empty and linked with nothing. ``component_id`` is the
    smallest key reachable over links. Rows of one key are one node; rows without a key are kept and
    have no component. Other columns are ignored.
    """
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    share, least = percent / 100, percent / 100 - SLACK
    rows = saved(sketches(docs, "id", "text", n, k), "sketches")
    usable = rows.filter("size > 0 and id is not null")
    first = usable.groupBy("size", "f1", "f2").agg(F.min("id").alias("class"))
    classed = rows.join(first, ["size", "f1", "f2"], "left").withColumn("class", F.when(F.col("id").isNotNull(), F.col("class")))
    known = saved(classed.select("id", "class", "size", F.when(F.col("id") == F.col("class"), F.col("sketch")).alias("sketch")), "classes")
    discard(rows)
    classes = known.filter("sketch is not null").select("id", "size", "sketch")

    def confirmed(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct()
        sets = saved(sketches(docs.join(wanted, "id", "left_semi"), "id", "text", n, k, full=True), "sets")
        out = saved(linked(pairs, sets, percent), "links")
        discard(sets)
        return out

    lists = postings(classes, k, need, share)
    centres = lists.groupBy("v").agg(F.max("rank").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    lists = saved(lists.join(centres.select("v", "top"), "v"), "lists")
    named = lists.filter("rank = top").select(F.col("rank").alias("top"), F.col("id").alias("centre")).distinct()
    # Pairs that share few lists are left to the second round.
    spokes = lists.filter("rank < top").groupBy("id", "top").count().filter(F.col("count") >= STAR).join(named, "top")
    pairs = spokes.select(F.greatest("id", "centre").alias("a"), F.least("id", "centre").alias("b")).distinct()
    stars = saved(estimated(pairs, classes, k, least), "stars")
    tested = confirmed(stars)
    roots = saved(components(tested.filter("link")), "roots")
    # Groups: documents that forests of pairs that may pass the estimate, or links, connect.
    tested = saved(tested.filter("link").select("a", "b"), "links")
    near = saved(block_pairs(different_lists(of_like_size(lists.select("v", "id", "size"), percent).drop("size")), roots, bitmaps(classes), k, least).distinct(), "near")
    groups = components(near.unionAll(roots.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))))
    groups = saved(groups.select(F.col("root").alias("v"), "id"), "groups")
    apart = groups.join(roots, "id", "left").groupBy("v").agg(F.min(F.coalesce("root", "id")).alias("low"), F.max(F.coalesce("root", "id")).alias("high"))
    open_ = saved(groups.join(apart.filter("low <> high").select("v"), "v"), "open")
    sets = saved(sketches(docs.join(open_.select("id").distinct(), "id", "left_semi"), "id", "text", n, k, full=True), "sets")
    more = saved(block_pairs(open_, roots, sets, k, least, percent).distinct(), "links")
    discard(sets)
    # The classes of one key are one node.
    own = known.filter("class is not null").select("id", "class").distinct()
    low = own.groupBy("id").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high")
    same = own.join(low, "id").filter("class <> low").select(F.col("class").alias("a"), F.col("low").alias("b"))
    roots = saved(components(tested.select("a", "b").unionAll(more).unionAll(same)), "roots")
    discard(lists, stars, near, groups, open_)
    ends = known.filter("class is not null").select("id", "class").distinct()
    ends = ends.join(roots.select(F.col("id").alias("class"), "root"), "class", "left")
    ends = ends.groupBy("id").agg(F.min(F.coalesce("root", "class")).alias("component"))
    out = known.select("id", "size").join(ends, "id", "left").withColumn("component", F.coalesce("component", "id"))
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return out.select(F.col("id").alias(key), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of linked rows, that with the smallest key (null last), with all its columns.

    Every row is a node of its own, so copies without a key and repeated rows are linked like others. A row
    without words is linked with nothing and stays.
    """
    rows, row = numbered(docs, "compared")
    groups = near_duplicates(rows.select(row, text), row, text, n, percent)
    first = F.min(F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.col(row).alias("row")))
    kept = groups.select(row, "component_id").join(rows.select(row, key), row).groupBy("component_id").agg(first.alias("first"))
    return rows.join(kept.select(F.col("first.row").alias(row)), row, "left_semi").select(*docs.columns)
