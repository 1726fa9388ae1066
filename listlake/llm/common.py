"""Helpers shared by the text operators: working tables, UTF-8 buffers, hashes and word positions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listlake.operators.joins import unused

#: Settings for the time of a write. Shuffle files of the write go at once; a Python worker gets a few MB of rows
#: at a time, as 10,000 long texts are too much for each of an executor's workers and for its own buffers.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}
#: Bytes between words: space and the control characters 0x09 to 0x0D.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True

_rng = np.random.default_rng(20240229)
#: A random 64-bit value for each byte, and an odd base for polynomial hashes with its inverse.
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
LOWER = np.arange(256)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in a local session without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="listlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts lineage, survives lost executors.

    The shuffle files of the write are of no use afterwards and go at once.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    before = {key: spark.conf.get(key) for key in WRITING}
    try:
        for key, value in WRITING.items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes working tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.saved_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows stored with a number of their own, and the name of its column, which no other column has.

    Decisions about rows go by that number: keys may be null or repeated.
    """
    row = unused("row", docs)
    return saved(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def fingerprinted(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    """The rows with 64 bits of their key and text, for decisions that depend on nothing else."""
    row = unused("row", docs)
    return docs.withColumn(row, F.xxhash64(F.col(key), F.col(text))), row


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 4; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4


def held_out(key: Column) -> Column:
    return fold(key) == 2


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; equal input, equal output on every machine."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the offsets of its rows (null: empty)."""
    import pyarrow.compute as pc

    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most about ``most`` bytes of text, or of one row.

    Hashing words takes some 50 bytes of memory for each byte of a piece, in every worker of an executor.
    """
    for batch in batches:
        at = np.cumsum([0, *(len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(text))])
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(at, at[start] + most, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, np.uint64(base % 2**64), np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte and row of every word; words never cross rows."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~SPACES[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & (~before | edge))
    end = np.flatnonzero(before & (~inside | edge))
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes, A to Z lower-cased if asked."""
    values = BYTE_VALUES[LOWER] if lower else BYTE_VALUES
    n = len(data)
    if not n:
        return np.zeros(len(start), np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * powers(n, BASE), out=sums[1:])
    back = powers(n + 1, BASE_INVERSE)
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows with equal keys, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for key in keys:
            x = batch.column(key).to_numpy(zero_copy_only=False)
            changed[1:] |= x[1:] != x[:-1]
        cuts = [*np.flatnonzero(changed).tolist(), batch.num_rows]
        first = batch.slice(0, cuts[0])
        if held and all(held[-1].column(k)[0].as_py() == first.column(k)[0].as_py() for k in keys):
            held.append(first)
        else:
            if held:
                yield pa.Table.from_batches(held)
            held = [first]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield pa.Table.from_batches(held)
            held = [batch.slice(a, b - a)]
    if held:
        yield pa.Table.from_batches(held)


def long_lists(values: list[np.ndarray] | np.ndarray, counts: np.ndarray | None = None) -> pa.Array:
    """An array<long> column from one array a row, or from all values and the rows' counts."""
    if counts is None:
        counts = np.array([len(v) for v in values], np.int64)
        values = np.concatenate(values) if len(values) else np.zeros(0, np.int64)
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).view(np.int64)))
