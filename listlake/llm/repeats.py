"""Removal of repeated byte strings across documents, by suffix arrays of shards.

A shard must hold all places of a repeated string. Each string of ``length`` bytes has an anchor: the
gram of ``GRAM`` bytes in it with the least hash (the leftmost). The strings with one anchor follow each
other, and the bytes they cover are a piece; equal strings have equal anchors, so they lie in pieces of
one gram. Grams that occur once go at once. Equal pieces are one group: all but the first are repeats.
Two different pieces share a string only if they agree beside the gram too: of the other bytes of the string
at least half lie on one side of it. So a piece whose neighbouring grams, left and right, both differ from those of
all other pieces of its gram is left out before any bytes are moved.
The different pieces of a gram that remain, one of each, go to one shard, where a suffix array by induced sorting
and permuted common prefixes show the strings that they share. A gram with very many different pieces
(the edge of a passage that many documents hold) is cut further, into single strings, which are
aggregated like pieces. Nothing is sampled, and no gram or document has to fit a limit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listlake.llm.common import discard, long_lists, mix, runs, saved, slices, utf8, word_hashes
from listlake.llm.suffixes import repeated

LENGTH = 100
GRAM = 32
#: Different pieces of a gram from which on it is cut into strings, and bytes of a suffix array at most.
HOT = 1500
SHARD = 1 << 20


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two) from each place, put together by doubling."""
    part, power, size = data.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    while size < gram:
        part = part[:-size] * np.uint64(power) + part[size:]
        power, size = power * power % 2**64, 2 * size
    return mix(part)


def pieces(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, gram's hash, first byte and end byte of all pieces, in order, whether a piece may repeat itself,
    and 16 bits each for the grams left and right of its gram (0: not in the piece)."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int32))
    if len(data) < length:
        return none
    h = gram_hashes(data, gram)
    window = length - gram + 1
    # Hash above, place below; longer texts leave fewer bits of the hash, whose ties stay leftmost.
    below = np.uint64((1 << max(24, len(h).bit_length())) - 1)
    key = (h & ~below) | np.arange(len(h), dtype=np.uint64)
    size = 1
    low = key
    while 2 * size <= window:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < window:
        low = np.minimum(low[: -(window - size)], low[window - size :])
    # ``low[s]``: the least gram of the string that starts at s. Strings never cross rows.
    begins = offsets[:-1][np.diff(offsets) >= length]
    stops = offsets[1:][np.diff(offsets) >= length] - length + 1
    if not len(begins):
        return none
    counts = stops - begins
    start = np.arange(counts.sum()) + np.repeat(begins - np.cumsum(counts) + counts, counts)
    anchor = (low[start] & below).astype(np.int64)
    cut = np.ones(len(start), bool)
    cut[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(cut)
    first, last = start[at], start[np.append(at[1:], len(start)) - 1]
    anchor = anchor[at]
    # In runs of one gram each string has an anchor of its own: take the farthest that serves.
    loops = np.zeros(len(anchor), bool)
    chained = (h[anchor][1:] == h[anchor][:-1]) & (first[1:] == last[:-1] + 1)
    if chained.any():
        chain = np.concatenate([[0], np.cumsum(~chained)])
        sizes = np.bincount(chain)
        keep, more = sizes[chain] == 1, []
        ends = np.cumsum(sizes)
        for c in np.flatnonzero(sizes > 1).tolist():
            a, b = int(ends[c] - sizes[c]), int(ends[c])
            s, stop = int(first[a]), int(last[b - 1])
            while s <= stop:
                p = int(anchor[a + np.searchsorted(anchor[a:b], s + window, "left") - 1])
                more.append((p, s, min(p, stop)))
                s = min(p, stop) + 1
        p, s, e = (np.array(x, np.int64) for x in zip(*more, strict=True))
        anchor, first, last = (np.concatenate([x[keep], y]) for x, y in ((anchor, p), (first, s), (last, e)))
        loops = np.arange(len(anchor)) >= keep.sum()
        order = np.argsort(first, kind="stable")
        anchor, first, last, loops = anchor[order], first[order], last[order], loops[order]
    return np.searchsorted(offsets, first, "right") - 1, h[anchor], first, last + length, loops, _beside(h, anchor, first, last + length, length, gram)


def _beside(h: np.ndarray, anchor: np.ndarray, first: np.ndarray, end: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The grams on both sides of the anchor, as far as a string with half of its other bytes there reaches."""
    half = (length - gram) // 2
    out = np.zeros(len(anchor), np.uint32)
    for shift, there, at in ((16, anchor - first >= half, anchor - gram), (0, end - anchor - gram >= half, anchor + gram)):
        out[there] |= (h[at[there]] % np.uint64(65535) + np.uint64(1)).astype(np.uint32) << np.uint32(shift)
    return out.view(np.int32)


def _again(row: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Whether the same keys came before in the same row."""
    order = np.lexsort((*keys, row))
    same = np.zeros(len(row), bool)
    same[1:] = row[order][1:] == row[order][:-1]
    for k in keys:
        same[1:] &= k[order][1:] == k[order][:-1]
    out = np.zeros(len(row), bool)
    out[order] = same
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def cut_pieces(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``g, k, id, start, size, again, loop, beside``: gram, hash of the piece, place, whether it came before in its
    document and may repeat itself, and the grams beside the gram."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            row, g, first, end, loops, beside = pieces(data, offsets, length, gram)
            k = word_hashes(data, first, end, lower=False)
            columns = [_signed(g), _signed(k), batch.column("id").take(pa.array(row)), pa.array((first - offsets[row]).astype(np.int64)), pa.array((end - first).astype(np.int32)), pa.array(_again(row, k, g)), pa.array(loops), pa.array(beside)]
            yield pa.RecordBatch.from_arrays(columns, ["g", "k", "id", "start", "size", "again", "loop", "beside"])

    return docs.mapInArrow(work, "g long, k long, id long, start long, size int, again boolean, loop boolean, beside int")


def agreeing(different: DataFrame) -> DataFrame:
    """Pieces whose left or right gram another piece of their gram has too; all of a gram with a piece that may
    repeat itself, as its strings have anchors of their own. A gram has ``HOT`` pieces at most here."""
    left, right = F.shiftrightunsigned("beside", 16), F.col("beside").bitwiseAND(F.lit(0xFFFF))
    of = lambda *also: F.count(F.lit(1)).over(Window.partitionBy("g", *also))
    told = different.select(
        "*", left.alias("left"), right.alias("right"), F.max("loop").over(Window.partitionBy("g")).alias("loops")
    ).withColumns({"on_left": of("left"), "on_right": of("right")})
    same = ((F.col("left") != 0) & (F.col("on_left") > 1)) | ((F.col("right") != 0) & (F.col("on_right") > 1))
    return told.filter(F.col("loops") | same).select(different.columns)


def _parts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``g, hot, id, start, bytes`` of the pieces at ``places`` (``id, start, size, g, hot``)."""
    lists = places.groupBy("id").agg(F.collect_list(F.struct("start", "size", "g", "hot")).alias("cut"))  # of one document

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for key, text, cut in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), batch.column("cut").to_pylist(), strict=True):
                data = (text or "").encode()
                out += [(c["g"], c["hot"], key, c["start"], data[c["start"] : c["start"] + c["size"]]) for c in cut]
            if out:
                kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["g", "hot", "id", "start", "bytes"])

    return docs.join(lists, "id").select("id", "text", "cut").mapInArrow(work, "g long, hot boolean, id long, start long, bytes binary")


def _spans(ids: np.ndarray, starts: np.ndarray, length: int) -> pa.RecordBatch:
    """``id, start, size`` of the bytes covered by the strings at ``starts``; ids and starts in order."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (starts[1:] > starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ids)) - 1
    return pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(starts[first]), pa.array((starts[last] - starts[first] + length).astype(np.int64))], ["id", "start", "size"])


def _shard(held: list[pa.Table], length: int) -> pa.RecordBatch:
    """The repeats among the pieces of a shard, by its suffix array."""
    rows = pa.concat_tables(held)
    texts = rows.column("bytes").to_pylist()
    sizes = np.array([len(t) for t in texts])
    ids = np.repeat(rows.column("id").to_numpy(), sizes)
    places = np.repeat(rows.column("start").to_numpy(), sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((places, ids))
    # Places of one key are in order of their start; those of another text with the same key count as equal.
    step = np.ones(len(order), np.int64)
    step[1:] = (ids[order][1:] != ids[order][:-1]) | (places[order][1:] != places[order][:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(step)
    found = np.flatnonzero(repeated(texts, rank, length))
    found = found[np.lexsort((places[found], ids[found]))]
    return _spans(ids[found], places[found], length)


def repeat_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``id, start, size`` of bytes to remove; spans of one document may overlap. ``docs`` has ``id, text``."""
    cut = cut_pieces(docs, length, gram)
    cut = saved(cut, "pieces")
    often = cut.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("loop").alias("own")).filter("n > 1 or own")
    shared = saved(cut.join(often.select("g"), "g"), "shared")
    discard(cut)
    first = shared.filter("not again").groupBy("g", "k").agg(F.min("id").alias("lowest"))
    kinds = first.groupBy("g").agg(F.count(F.lit(1)).alias("kinds"))
    placed = saved(shared.join(first, ["g", "k"]).join(kinds, "g").select("g", "id", "start", "size", (F.col("again") | (F.col("id") > F.col("lowest"))).alias("repeat"), "kinds", "loop", "beside"), "placed")
    discard(shared)
    whole = placed.filter("repeat").select("id", "start", F.col("size").cast("long").alias("size"))
    different = placed.filter("not repeat and (kinds > 1 or loop)").select("id", "start", "size", "g", (F.col("kinds") > HOT).alias("hot"), "loop", "beside")
    if (length - gram) // 2 >= gram:  # else a string may end within the grams beside
        different = different.filter("hot").unionAll(agreeing(different.filter("not hot")))
    different = different.drop("loop", "beside")
    parts = saved(_parts(docs, different), "parts")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in runs(batches, ["g"]):
            held.append(group)
            size += sum(len(x.as_buffer()) for x in group.column("bytes"))
            if size >= SHARD:
                yield _shard(held, length)
                held, size = [], 0
        if held:
            yield _shard(held, length)

    dealt = parts.filter("not hot").select("g", "id", "start", "bytes").repartition("g").sortWithinPartitions("g", "id", "start")
    inner = dealt.mapInArrow(shards, "id long, start long, size long")

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("bytes").to_pylist()
            sizes = np.array([len(t) for t in texts], np.int64)
            counts = np.maximum(sizes - length + 1, 0)
            if not counts.sum():
                continue
            row = np.repeat(np.arange(len(texts)), counts)
            inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            data = np.frombuffer(b"".join(texts), np.uint8)
            at = (np.cumsum(sizes) - sizes)[row] + inside
            h = [word_hashes(data, at, at + length, lower=False), word_hashes(data ^ np.uint8(0x5A), at, at + length, lower=False)]
            ids = batch.column("id").to_numpy()[row]
            places = batch.column("start").to_numpy()[row] + inside
            yield pa.RecordBatch.from_arrays([_signed(h[0]), _signed(h[1]), pa.array(ids), pa.array(places)], ["a", "b", "id", "place"])

    each = parts.filter("hot").select("id", "start", "bytes").mapInArrow(strings, "a long, b long, id long, place long")
    each = saved(each, "strings")
    lowest = each.groupBy("a", "b").agg(F.min("id").alias("lowest"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # In the first document that has it, the first place stays.
    inside = each.join(lowest, ["a", "b"]).filter("id = lowest").groupBy("a", "b").agg(F.min("place").alias("stays"))
    edge = each.join(lowest.join(inside, ["a", "b"]), ["a", "b"]).filter("id > lowest or place > stays")
    edge = edge.select("id", F.col("place").alias("start"), F.lit(length).cast("long").alias("size"))
    return whole.unionAll(inner).unionAll(edge)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``<key>, n_bytes, n_removed, n_spans, kept_sha256, spans`` for every row of ``docs``.

    A byte is removed if a string of ``length`` bytes over it starts earlier too: in a document with a
    smaller key, or further left in the same one. ``spans`` are the maximal removed runs as first byte
    and length, one after the other. Texts are UTF-8 (null: empty); rows without key keep all their bytes.
    Several rows with one key: none makes bytes of another go, and each loses what any of them has to.
    Other columns are ignored.
    """
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    spans = repeat_spans(docs.filter("id is not null and text is not null"), length, gram)
    lists = saved(spans.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias("cut")), "spans")  # of one document

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out, found = [], []
            for value, cut in zip(batch.column("text").to_pylist(), batch.column("cut").to_pylist(), strict=True):
                data, merged = (value or "").encode(), []
                for c in cut or ():
                    a, b = c["start"], min(c["start"] + c["size"], len(data))
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    elif b > a:
                        merged.append([a, b])
                digest, at = hashlib.sha256(), 0
                for a, b in merged:
                    digest.update(data[at:a])
                    at = b
                digest.update(data[at:])
                out.append((len(data), sum(b - a for a, b in merged), len(merged), digest.hexdigest()))
                found.append(np.array([x for a, b in merged for x in (a, b - a)], np.int64))
            numbers = list(zip(*out, strict=True))
            columns = [batch.column("id"), *(pa.array(c, pa.int64()) for c in numbers[:3]), pa.array(numbers[3], pa.string()), long_lists(found)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    joined = docs.join(lists, "id", "left").select("id", "text", "cut")
    fields = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
    return joined.mapInArrow(work, fields).withColumnRenamed("id", key)
