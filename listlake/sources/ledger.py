"""Ledger of processed trigger messages, one folder per day of processing.

Ids are only ever added, and an id that is stored twice means the same as once. So small files can be
replaced by large ones while others read: the large file appears first, then the small ones go.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listlake.operators.joins import anti_join
from listlake.schemas import LEDGER
from listlake.session import discard


DAY = "processed_day"
STORED = T.StructType(LEDGER.fields + [T.StructField(DAY, T.DateType(), True)])
#: Bytes of a compacted file, about.
FILE_BYTES = 128 << 20


def read_ledger(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """Processed messages; an empty ledger is made where there is none yet.

    ``since`` leaves out the folders of earlier days, for a source that never delivers older messages again.
    """
    spark.createDataFrame([], STORED).write.mode("ignore").partitionBy(DAY).parquet(path)
    rows = spark.read.schema(STORED).parquet(path)
    return (rows if since is None else rows.where(F.col(DAY) >= F.lit(since))).select(*LEDGER.names)


def anti_join_ledger(
    messages: DataFrame, ledger: DataFrame, hot: list | None = None
) -> DataFrame:
    """Messages whose id the ledger does not hold. An id replayed very often is a hot key."""
    return anti_join(messages, ledger, "message_id", hot)


def ledger_rows(
    messages: DataFrame, processed_at: datetime, metadata: dict[str, object] | None = None
) -> DataFrame:
    """One ledger row per message id."""
    entries = [F.lit(x) for k, v in (metadata or {}).items() for x in (k, str(v))]
    values = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    return messages.select("message_id").distinct().select(
        "message_id", F.lit(processed_at).alias("processed_at"), values.alias("metadata")
    )


def append_ledger(rows: DataFrame, path: str) -> None:
    """Mark as processed. Call it after the work is stored, never before: a failure in between means
    the message is worked again, which the keyed upsert makes harmless."""
    dated = rows.select(*LEDGER.names, F.to_date("processed_at").alias(DAY))
    dated.write.mode("append").partitionBy(DAY).parquet(path)


def _files(spark: SparkSession, folder: str) -> list:
    """Names and sizes of a folder's data files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return [f for f in found if not f.getPath().getName().startswith(("_", "."))]


def ledger_days(spark: SparkSession, path: str) -> dict[str, int]:
    """How many files each day's folder holds. One entry a day of the ledger's life."""
    days = [f.getPath().getName() for f in _files(spark, path) if f.isDirectory()]
    return {d: len(_files(spark, f"{path}/{d}")) for d in sorted(days)}


def compact_ledger(spark: SparkSession, path: str, before: date | None = None, file_bytes: int = FILE_BYTES) -> int:
    """Rewrite each day that has several files as few, every id once, and return how many days that were.

    Days from ``before`` on are left alone, as a stream may be writing to them. The new files are written beside
    the ledger, moved into the day's folder, and only then the old ones are removed: a reader may meet an id
    twice but never misses one, and a compaction that dies is simply done again.
    """
    system = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    done = 0
    for day, n in ledger_days(spark, path).items():
        if n < 2 or (before is not None and day >= f"{DAY}={before.isoformat()}"):
            continue
        old = _files(spark, f"{path}/{day}")
        parts = max(1, -(-sum(f.getLen() for f in old) // file_bytes))
        if parts >= n:
            continue
        rows = spark.read.schema(LEDGER).parquet(*[f.getPath().toString() for f in old])
        # Of an id's entries the latest; the rest breaks ties.
        first = rows.withColumn("told", F.to_json("metadata")).groupBy("message_id").agg(
            F.max(F.struct("processed_at", "told")).alias("last")
        )
        whole = first.select("message_id", "last.processed_at", F.from_json("last.told", "map<string,string>").alias("metadata"))
        beside = f"{path}/_compact-{uuid.uuid4().hex}"
        whole.repartition(parts, "message_id").write.parquet(beside)
        for f in _files(spark, beside):
            target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{day}/{f.getPath().getName()}")
            if not system.rename(f.getPath(), target):
                raise OSError(f"cannot move {f.getPath().toString()}")
        for f in old:
            system.delete(f.getPath(), False)
        discard(spark, beside)
        done += 1
    return done
