"""The lake: Parquet, one folder per listing day, merged by key.

File tables have no MERGE, and overwriting days in place is neither atomic nor able to empty a day
whose last row moved away. So a merge writes the days it touches into a new folder and then adds one
small manifest that names, for every day, the folder holding it::

    <root>/data/v=3-<id>/listing_start_date=2024-10-06/…
    <root>/manifest/v=3/…

A manifest is a single file and appears by one rename. A job that dies before that leaves the table
as it was, and running it again is safe. Of two writers that start from one version the first to store
its manifest wins, the other fails.

Where the session has a table format with row-level operations, :func:`merge_statement` gives the
equivalent ``MERGE INTO``.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listlake.operators.upsert import DuplicateKeyError, dedupe_source, marked_keys, upsert_rows
from listlake.schemas import LAKE, LAKE_DAY, LAKE_KEY
from listlake.session import discard

MANIFEST = T.StructType(
    [
        T.StructField("day", T.DateType(), True),
        T.StructField("folder", T.StringType(), True),
        # Rows without a folder: the last batch that a stream has merged.
        T.StructField("stream", T.StringType(), True),
        T.StructField("batch", T.LongType(), True),
        T.StructField("v", T.LongType(), True),
    ]
)

# A working table's writer holds a group of rows for each task, and so does whoever reads it.
GROUP_BYTES = 16 << 20


class LakeTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType = LAKE,
        key: str = LAKE_KEY,
        day: str = LAKE_DAY,
    ) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.schema, self.key, self.day = schema, key, day

    def create_if_absent(self) -> LakeTable:
        """An empty version 0; does nothing to a table that exists."""
        empty = self.spark.createDataFrame([], MANIFEST)
        empty.coalesce(1).write.mode("ignore").parquet(f"{self.root}/manifest/v=0")
        return self

    def _manifest(self) -> tuple[int, dict[date | None, str], dict[str, int]]:
        """Current version, the folder of every day, and the last batch of every stream: one entry per
        day of the table's life and per stream that ever wrote to it."""
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        # The newest version is a scalar subquery on the partition column: older ones stay closed.
        current = rows.where(F.col("v") == rows.agg(F.max("v")).scalar()).collect()
        folders = {r["day"]: r["folder"] for r in current if r["folder"] is not None}
        batches = {r["stream"]: r["batch"] for r in current if r["stream"] is not None}
        return max((r["v"] for r in current), default=0), folders, batches

    def version(self) -> int:
        return self._manifest()[0]

    def _read(self, folders: dict[date | None, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        paths = [
            f"{self.root}/data/v={v}/{self.day}="
            + (d.isoformat() if d else "__HIVE_DEFAULT_PARTITION__")
            for d, v in folders.items()
        ]
        schema = T.StructType(self.schema.fields + [T.StructField("v", T.StringType(), True)])
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*self.schema.names)

    def read(self) -> DataFrame:
        """The current version. A filter on the day prunes folders."""
        return self._read(self._manifest()[1])

    def set_aside(self, df: DataFrame) -> tuple[DataFrame, str]:
        """The rows as a working table beside the lake's data, and its path, which the caller discards.

        Rows that several jobs read are stored and not cached: a cache of whole texts fills the executors'
        memory, and its blocks leave it and come back in one piece. Of a stored table each job reads the columns
        that it needs, a group of rows at a time.
        """
        path = f"{self.root}/work/{uuid.uuid4().hex}"
        known = {f.name: f.dataType for f in self.schema}
        # Files have no column of NULLs without a type; the lake knows what it would be.
        untyped = [f.name for f in df.schema if f.name in known and "void" in f.dataType.simpleString()]
        df = df.withColumns({c: F.col(c).cast(known[c]) for c in untyped}) if untyped else df
        try:
            df.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
        except Exception:
            discard(self.spark, path)
            raise
        return self.spark.read.schema(df.schema).parquet(path), path

    def _distinct_days(self, df: DataFrame) -> set[date | None]:
        # One value per day of the table's life.
        return {r[0] for r in df.select(self.day).distinct().collect()}

    def _touched(self, matched: DataFrame, keys: DataFrame) -> set[date | None]:
        """Days of matched rows and of the source; raises if a key is NULL or not unique."""
        key, day, bad = keys.columns
        rows = matched.select(day, F.lit(0).alias(bad), F.lit(None).cast("string").alias(key)).unionByName(
            keys.select(day, bad, F.when(F.col(bad) == 1, F.col(key).cast("string")).alias(key))
        )
        # One row per day of the table's life.
        found = rows.groupBy(day).agg(F.sum(bad).alias(bad), F.min(key).alias(key)).collect()
        faults = sum(r[bad] for r in found)
        if faults:
            example = min((r[key] for r in found if r[key] is not None), default=None)
            raise DuplicateKeyError(f"{faults} {key} values are NULL or not unique, e.g. {example!r}")
        return {r[day] for r in found}

    def matched(self, folders: dict[date | None, str], keys: DataFrame) -> DataFrame:
        """Keys and days of the lake's rows that ``keys`` names.

        Keys are compared with the empty text, which every one passes but NULL, because Spark builds a
        runtime filter only over a side that is filtered: beyond the size of a broadcast, a Bloom filter of the
        source's keys then meets the lake's rows in the scan, and those shuffled are in proportion to the
        matches and not to the lake.
        """
        some = keys.select(self.key)
        if isinstance(self.schema[self.key].dataType, T.StringType):
            some = some.where(F.col(self.key) >= "")
        return self._read(folders).select(self.key, self.day).join(some, self.key, "left_semi")

    def merge(
        self,
        source: DataFrame,
        on_duplicate: str = "error",
        order: list[str] | None = None,
        batch: tuple[str, int] | None = None,
    ) -> int:
        """Upsert ``source`` and return the new version.

        Days that hold a matched row or receive one are rewritten, no others. The search for matched
        rows reads the key column only. The source is computed once, into a working table that is gone when the
        merge ends, unless the caller has cached it. ``batch`` names the stream and batch that ``source`` is: it is
        stored with the version, and a batch that was merged before is left out without reading it.
        """
        version, folders, batches = self._manifest()
        if batch and batches.get(batch[0], -1) >= batch[1]:
            return version
        names = self.schema.names
        rows = source.select(*names, *[c for c in order or [] if c not in names])
        unique = dedupe_source(rows, self.key, on_duplicate, order, check=False).select(*names)
        # What the caller has cached is read from there; anything else is computed once.
        unique, aside = (unique, None) if source.is_cached else self.set_aside(unique)
        try:
            # One job finds the days and, on the way, the source's faults. Keys of a source that may
            # repeat them have been reduced to one row, whose day counts.
            keys = marked_keys(unique, self.key, self.day, repeated=on_duplicate == "error")
            touched = self._touched(self.matched(folders, keys).select(self.day), keys)
            if not touched:
                return version
            old = self._read({d: v for d, v in folders.items() if d in touched})
            merged = upsert_rows(old, unique, self.key)
            new = version + 1
            # Every attempt has a folder of its own, so a second writer, or a hung one that comes back,
            # never writes where a manifest points to. Who stores the manifest first has merged.
            folder = f"{new}-{uuid.uuid4().hex}"
            path = f"{self.root}/data/v={folder}"
            # Rebalance brings the rows of a day together, yet cuts a hot day into several files.
            merged.hint("rebalance", self.day).write.partitionBy(self.day).parquet(path)
        finally:
            if aside:
                discard(self.spark, aside)

        written = self.spark.read.schema(self.schema).parquet(path)
        entries = {d: v for d, v in folders.items() if d not in touched}
        # Reads no column: the days are the names of the folders.
        entries |= {d: folder for d in self._distinct_days(written)}
        if batch:
            batches[batch[0]] = batch[1]
        rows = [(d, v, None, None) for d, v in entries.items()] + [(None, None, *b) for b in batches.items()]
        manifest = self.spark.createDataFrame(rows, "day date, folder string, stream string, batch bigint")
        manifest.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/manifest/v={new}")
        return new


def merge_statement(target: str, source: str, schema: T.StructType = LAKE, key: str = LAKE_KEY) -> str:
    """``MERGE INTO`` over two tables or views, for catalogs with row-level operations."""
    names = schema.names
    sets = ", ".join(f"t.{c} = s.{c}" for c in names if c != key)
    return (
        f"MERGE INTO {target} t USING {source} s ON t.{key} = s.{key} "
        f"WHEN MATCHED THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) "
        f"VALUES ({', '.join(f's.{c}' for c in names)})"
    )


# ---------------------------------------------------------------------------- catalog and models


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def ensure_day_table(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType = LAKE,
    day: str = LAKE_DAY,
    key: str = LAKE_KEY,
) -> None:
    """Catalog table partitioned by day, if absent. The key is kept as a property: nothing enforces
    it, the uniqueness check verifies it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (`{day}`) "
        f"LOCATION '{path}' TBLPROPERTIES ('primary_key' = '{key}')"
    )


def footer_stats(
    spark: SparkSession, tables: dict[str, str], columns: dict[str, list[str]] | None = None
) -> dict[str, DataFrame]:
    """Row count, and ``min_<c>``, ``max_<c>`` of the columns named, of Parquet tables, from file footers alone.

    ``tables`` maps names to paths. The aggregate is pushed into the scan, which then opens no data page; that
    needs the newer Parquet source and a setting, so they belong to a session of their own and the caller's is not
    touched. Footers hold no exact bounds of texts, so take numbers and dates.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    out = {}
    for name, path in tables.items():
        wanted = [f(c).alias(f"{n}_{c}") for c in (columns or {}).get(name, []) for n, f in (("min", F.min), ("max", F.max))]
        out[name] = own.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), *wanted)
    return out


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def publish_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write a model as a catalog table of ``buckets`` sorted buckets of ``key``, one file each, so that
    tables bucketed alike are joined on the key without an exchange or a sort. The files are at ``path`` and
    stay there if the table is dropped."""
    rows = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    rows.option("path", path).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def stored_bytes(df: DataFrame) -> int:
    """Size of a stored table's files."""
    spark = df.sparkSession
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f) for f in df.inputFiles()]
    conf = spark._jsc.hadoopConfiguration()
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def publish_table(df: DataFrame, path: str, day: str | None = None) -> DataFrame:
    """Write a model once and read it back, so that later readers do not expand it again."""
    if day:
        df.hint("rebalance", day).write.partitionBy(day).mode("overwrite").parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
