"""Token ids as raw binary shards with a minimal perfect hash index.

A store is a folder of shards in ascending key order. Shard ``n`` has two files:

* ``n.ids``: the ids of its documents one after the other, as little-endian unsigned integers of 16 bits
  if the vocabulary has no larger ids, else of 32.
* ``n.idx``: magic, then little-endian 64-bit counts ``keys, records, levels, width``, the last one in
  bytes of an id; the size in bits of each level; the levels' bits and a running count for every 512 of them; per slot of the hash
  a 32-bit fingerprint and the number of its first record; per record its key (64-bit), a null flag
  and the place of its first id in the shard, with the end as one more place.

``manifest.tsv`` has a line for each shard: its number, the ids in all shards before it, its records,
its ids, and its first and last key. The hash: a key's slot in level l is its hash
for l modulo the level's bits; keys that are alone in their bit stay there, the rest go on to the next
level. The rank of the bit among all set bits is the slot, so n keys have slots 0 to n - 1. A lookup
reads a few words and compares the fingerprint.
"""

from __future__ import annotations

import contextlib
import os
import string
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listlake.llm.common import fresh_path, mix, runs, slices

MAGIC = b"TOKSTOR1"
TOKENIZER = "word_bpe_49k.json"
#: Bits of a level for each key that enters it, pieces of words kept by a worker, and rows of a shard aimed at.
GAMMA = 2.0
CACHE = 400_000
SHARD_ROWS = 8_000


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def put(files: pafs.FileSystem, path: str, parts: list[bytes]) -> None:
    """Writes beside the place and moves it there, so that a lost or repeated task leaves whole files."""
    part = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        for x in parts:
            out.write(x)
    files.move(part, path)


# ------------------------------------------------------------------------------ the hash


def key_hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mix(mix(keys.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) + np.uint64(level * 0xD1B54A32D192ED03 % 2**64))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        padded = np.zeros(-(-len(bits) // 512) * 512, bool)
        padded[: len(bits)] = bits
        self.blocks = padded.reshape(-1, 512)
        self.ranks = np.concatenate([[0], np.cumsum(self.blocks.sum(1))]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, parts, left = [], [], keys
        while len(left):
            size = max(64, int(GAMMA * len(left)))
            slot = (key_hash(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(slot, minlength=size) == 1
            sizes.append(size)
            parts.append(alone)
            left = left[~alone[slot]]
        return cls(sizes, np.concatenate(parts) if parts else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some keys that are not in the set, any slot for the others."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            bit = (key_hash(keys[left], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            hit = self.bits[bit]
            block, inside = bit[hit] // 512, bit[hit] % 512
            out[left[hit]] = self.ranks[block] + (self.blocks[block] & (np.arange(512) < inside[:, None])).sum(1)
            left = left[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (key_hash(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def index_bytes(keys: np.ndarray, nulls: np.ndarray, ends: np.ndarray, width: int) -> bytes:
    """The index file of records in key order; ``ends`` are the places after each record's last id."""
    distinct, first = np.unique(keys[~nulls], return_index=True)
    first = np.flatnonzero(~nulls)[first]
    perfect = PerfectHash.build(distinct)
    slot = perfect.slots(distinct)
    prints, record = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.uint64)
    prints[slot], record[slot] = fingerprints(distinct), first
    head = struct.pack("<8sQQQQ", MAGIC, len(distinct), len(keys), len(perfect.sizes), width)
    return b"".join([
        head, np.array(perfect.sizes, "<u8").tobytes(), np.packbits(perfect.bits).tobytes(), perfect.ranks.astype("<u8").tobytes(),
        prints.astype("<u4").tobytes(), record.astype("<u8").tobytes(), keys.astype("<i8").tobytes(), nulls.astype(np.uint8).tobytes(),
        np.concatenate([[0], ends]).astype("<u8").tobytes(),
    ])


class Shard:
    """One shard opened for reading: keyed access, or all records in order."""

    def __init__(self, files: pafs.FileSystem, path: str):
        self.files, self.path = files, path
        with files.open_input_file(f"{path}.idx") as f:
            data = f.readall()
        magic, keys, records, levels, self.width = struct.unpack_from("<8sQQQQ", data)
        if magic != MAGIC:
            raise ValueError(f"{path}.idx is not an index")
        at = 40

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        sizes = take("<u8", levels).astype(np.int64).tolist()
        bits = np.unpackbits(take("u1", -(-sum(sizes) // 8)))[: sum(sizes)].astype(bool)
        self.hash = PerfectHash(sizes, bits)
        take("<u8", len(self.hash.ranks))
        self.prints, self.record, self.keys = take("<u4", keys), take("<u8", keys).astype(np.int64), take("<i8", records)
        self.nulls, self.places = take("u1", records).astype(bool), take("<u8", records + 1).astype(np.int64)

    def records(self, keys: np.ndarray) -> np.ndarray:
        """The first record of each key, -1 for keys that the shard does not hold."""
        slot = self.hash.slots(keys)
        found = slot >= 0
        found[found] = self.prints[slot[found]] == fingerprints(keys[found])
        out = np.full(len(keys), -1, np.int64)
        out[found] = self.record[slot[found]]
        out[found] = np.where(self.keys[out[found]] == keys[found], out[found], -1)
        return out

    def read(self, record: int) -> np.ndarray:
        """The ids of one record, by one ranged read."""
        with self.files.open_input_file(f"{self.path}.ids") as f:
            a, b = self.places[record] * self.width, self.places[record + 1] * self.width
            return np.frombuffer(f.read_at(int(b - a), int(a)), f"<u{self.width}")


# --------------------------------------------------------------------- encoding and writing


#: Letters that stay one letter when they are normalised and lower-cased, and marks that may follow them.
STEM = "[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+"
SIMPLE = f"^{STEM}[!-/:-@\\[-`{{-~]*$"


def byte_letters() -> np.ndarray:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, then from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return np.array([b if b in shown else 256 + rest.index(b) for b in range(256)], "<u4")


def gathered(values: np.ndarray, places: np.ndarray, rows: np.ndarray, most: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """The values of the given rows one after the other, and their places; row i has those from ``places[i]`` to ``places[i + 1]``."""
    at = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(places[rows + 1] - places[rows], out=at[1:])
    out = np.empty(at[-1], values.dtype)
    for a in range(0, len(rows), most):
        z = min(a + most, len(rows))
        start = np.repeat(places[rows[a:z]] - at[a:z], np.diff(at[a : z + 1]))
        out[at[a] : at[z]] = values[start + np.arange(at[a], at[z])]
    return out, at


class Encoder:
    """The tokenizer, with the ids of words seen before.

    Its normaliser and pattern never join characters over a space or line feed, so a text's ids are its
    words' ids in order; texts with special token strings are split the same way. Words of plain
    letters go straight to the library's model, in lower case and as byte letters, as they are one piece
    to its pattern; marks after them are another. All other words take the library's whole way.
    Arrow splits the texts and finds the different words of a batch, so that Python meets each once.
    """

    def __init__(self, path: str, end_id: int | None = None, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer, self.cache, self.end_id = Tokenizer.from_file(path), cache, end_id
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.letters[32] = 32  # stays between stems
        most = max([*self.tokenizer.get_vocab(with_added_tokens=True).values(), end_id or 0])
        self.kind = "<u2" if most < 1 << 16 else "<u4"
        # Piece n has the ids from places[n] to places[n + 1], and is the n-th known; piece 0 is the empty one.
        self.known, self.ids, self.places, self.again = {"": 0}, np.zeros(0, self.kind), np.zeros(2, np.int64), np.zeros(1, bool)
        # A tokenizer that works in another way takes the whole way for every word.
        probe = ["Héllo", "abc", "Straße", "onTHE"]
        (whole, sizes), (direct, same) = self._whole(probe), self._direct([w.lower() for w in probe])
        self.direct = sizes.tolist() == same.tolist() and whole.tolist() == direct.tolist()

    def _forget(self) -> None:
        """Keeps the pieces that came again since the last time; none, if they are too many."""
        kept = np.flatnonzero(self.again[1:]) + 1
        kept = np.concatenate([[0], kept[: len(kept) * (2 * len(kept) <= self.cache)]])
        texts = list(self.known)
        self.known = {texts[n]: i for i, n in enumerate(kept.tolist())}
        self.ids, self.places = gathered(self.ids, self.places, kept)
        self.again = np.zeros(len(kept), bool)

    def _direct(self, stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all stems by the model alone, and how many each has."""
        text = self.letters[np.frombuffer(" ".join(stems).encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids, sizes, tokenize = [], [], self.model.tokenize
        for stem in text.split(" "):
            found = [t.id for t in tokenize(stem)]
            ids += found
            sizes.append(len(found))
        return np.array(ids, self.kind), np.array(sizes, np.int64)

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same by the whole tokenizer."""
        ids, sizes = [], []
        for a in range(0, len(words), 5000):
            for e in self.tokenizer.encode_batch_fast(words[a : a + 5000], add_special_tokens=False):
                ids += e.ids
                sizes.append(len(e))
        return np.array(ids, self.kind), np.array(sizes, np.int64)

    def _numbers(self, pieces: pa.Array, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The number of each of some different pieces; ``learn`` encodes the new ones."""
        texts = pieces.to_numpy(zero_copy_only=False).tolist()
        out = np.array(list(map(self.known.get, texts, repeat(-1))), np.int64)
        fresh = np.flatnonzero(out < 0)
        self.again[out[out >= 0]] = True
        if len(fresh):
            new, first = [texts[i] for i in fresh.tolist()], len(self.places) - 1
            ids, sizes = learn(new)
            out[fresh] = np.arange(first, first + len(new))
            self.known.update(zip(new, range(first, first + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, ids])
            self.places = np.concatenate([self.places, self.places[-1] + np.cumsum(sizes)])
            self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        return out

    def _pieces(self, words: pa.Array) -> np.ndarray:
        """The numbers of the two pieces of each of some different words; the second may be the empty one."""
        out = np.zeros((len(words), 2), np.int64)
        simple = np.zeros(len(words), bool)
        if self.direct:
            simple = pc.match_substring_regex(words, SIMPLE).to_numpy(zero_copy_only=False)
            own, at = words.filter(pa.array(simple)), np.flatnonzero(simple)
            stems = pc.ascii_rtrim(own, string.punctuation)
            marked = np.flatnonzero(pc.not_equal(pc.binary_length(own), pc.binary_length(stems)).to_numpy(zero_copy_only=False))
            stems = pc.utf8_lower(stems).dictionary_encode()
            marks = pc.replace_substring_regex(own.take(pa.array(marked)), f"^{STEM}", "").dictionary_encode()
            out[at, 0] = self._numbers(stems.dictionary, self._direct)[stems.indices.to_numpy()]
            out[at[marked], 1] = self._numbers(marks.dictionary, self._whole)[marks.indices.to_numpy()]
        out[~simple, 0] = self._numbers(words.filter(pa.array(~simple)), self._whole)
        return out

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """The ids of each text and the end id, as bytes."""
        if len(self.known) > self.cache:
            self._forget()
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        pieces = self._pieces(words.dictionary)
        ids, places = gathered(self.ids, self.places, pieces.ravel())
        ids, places = gathered(ids, places[::2], words.indices.to_numpy())
        ends = places[np.cumsum(split.value_lengths().to_numpy())]
        if self.end_id is not None:
            ids = np.insert(ids, ends, self.end_id)
            ends = ends + np.arange(1, len(ends) + 1)
        at = np.concatenate([[0], ends]) * ids.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(ids)]).cast(pa.binary())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.encode_column(pa.array(texts, pa.string())).to_pylist()


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int | None) -> Encoder:
    """One per worker process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path, end_id)


def write_store(docs: DataFrame, tokenizer: str, end_id: int | None, folder: str, key: str = "doc_id", text: str = "text", shards: int | None = None) -> DataFrame:
    """Encodes every row's whole text and writes the store; the manifest's rows.

    Null and empty texts have no ids but the end id. Rows are in ascending order of key, null first, rows
    of one key in order of their ids. Shards are cut by ranges of keys; a key is never split.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    count = shards or max(1, -(-rows.count() // SHARD_ROWS))
    # Bounds from the keys alone: sampling the encoded rows would encode them twice.
    shares = [(i + 1) / count for i in range(count - 1)]
    cuts = rows.agg(F.percentile_approx("id", shares, min(100 * count, 1_000_000))).first()[0] if shares else None
    bounds = np.array(sorted(set(cuts or ())), np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer, end_id)
        for batch in slices(batches, "text"):
            ids = codec.encode_column(batch.column("text"))
            shard = np.searchsorted(bounds, batch.column("id").fill_null(np.iinfo(np.int64).min).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), batch.column("id"), ids], ["shard", "id", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = int(encoder(tokenizer, end_id).kind[-1])
        files, path = opened(folder)
        with contextlib.suppress(OSError):
            files.create_dir(path, recursive=True)
        for rows in runs(batches, ["shard"]):  # SHARD_ROWS rows or so
            number = rows.column("shard")[0].as_py()
            payload = rows.column("ids").to_pylist()
            sizes = [len(x) // width for x in payload]
            nulls = rows.column("id").is_null().to_numpy()
            keys = rows.column("id").fill_null(0).to_numpy()
            put(files, f"{path}/{number:06d}.ids", payload)
            put(files, f"{path}/{number:06d}.idx", [index_bytes(keys, nulls, np.cumsum(sizes), width)])
            real = keys[~nulls] if not nulls.all() else np.zeros(1, np.int64)
            row = (number, len(sizes), sum(sizes), int(real[0]), int(real[-1]))
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in row], ["shard", "records", "ids", "first", "last"])

    dealt = rows.mapInArrow(encode, "shard long, id long, ids binary")
    dealt = dealt.repartition(count, "shard").sortWithinPartitions("shard", "id", "ids")
    written = sorted(tuple(r) for r in dealt.mapInArrow(write, "shard long, records long, ids long, first long, last long").collect())  # a row per shard
    base, out = 0, []
    for shard, records, ids, first, last in written:
        out.append((shard, base, records, ids, first, last))
        base += ids
    files, path = opened(folder)
    files.create_dir(path, recursive=True)
    put(files, f"{path}/manifest.tsv", ["".join("\t".join(map(str, x)) + "\n" for x in out).encode()])
    return docs.sparkSession.createDataFrame(out, "shard long, base long, records long, ids long, first long, last long")


def read_store(spark, shards: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:  # noqa: ANN001
    """``<key>, start, n_tokens, ids_crc32, indexed`` of every record, read from the files.

    ``start`` counts the ids of all records before it. Every record is looked up through the index:
    ``indexed`` says that the lookup of its key led to the key's records.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = opened(folder)
        for batch in batches:
            for number, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist(), strict=True):
                shard = Shard(files, f"{path}/{number:06d}")
                found = shard.records(shard.keys)
                order = np.arange(len(found))
                ok = shard.nulls | ((found >= 0) & (found <= order))
                crc, at = np.zeros(len(order), np.int64), shard.places * shard.width
                with files.open_input_stream(f"{shard.path}.ids") as f:
                    for n in order.tolist():
                        ids = np.frombuffer(f.read(int(at[n + 1] - at[n])), f"<u{shard.width}")
                        crc[n] = zlib.crc32(ids.astype("<u4").tobytes())
                for a in range(0, len(order), 10_000):
                    s = slice(a, a + 10_000)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard.keys[s], pa.int64(), mask=shard.nulls[s]), pa.array(base + shard.places[:-1][s]),
                        pa.array(np.diff(shard.places)[s]), pa.array(crc[s]), pa.array(ok[s]),
                    ], ["id", "start", "n_tokens", "ids_crc32", "indexed"])

    listed = shards.select("shard", "base").repartition(max(1, shards.count()), "shard")
    out = listed.mapInArrow(work, "id long, start long, n_tokens long, ids_crc32 long, indexed boolean")
    return out.withColumnRenamed("id", key)


def token_output(docs: DataFrame, tokenizer: str, end_id: int | None = 2, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the store and reads it back, see ``write_store`` and ``read_store``."""
    folder = folder or fresh_path(docs.sparkSession, "token-store")
    return read_store(docs.sparkSession, write_store(docs, tokenizer, end_id, folder, key, text), folder, key)
