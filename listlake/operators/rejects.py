"""The dead-letter lane: records that cannot be used go to a table of their own, whole and with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listlake.operators.joins import left_join_bounded, unused
from listlake.sources.daily_csv import REJECT, is_header

REJECTS = ["file", "reason", "record", "copies"]


def split_rejects(
    rows: DataFrame, schema: T.StructType, key: str, order: list[str], file: str, max_files: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Usable rows, and rejects ``(file, reason, record, copies)``; copies and rows add up to the records.

    ``rows`` are those of a lenient read: ``schema``, the column of rejects, ``order`` and the ``file`` they are
    from. Rejected are records that cannot be read, all records of a file without the right header, rows
    without a key, and of several rows of one file with one key all but the greatest by ``order`` and content.
    The same key in several files is no fault. ``max_files`` bounds the number of files, if it is known.

    Whether a key is repeated is asked first, of the keys alone; only then are whole rows brought together. Equal
    ones are counted before they are compared with others of their key, so that copies of a hot row are one
    row by then. ``rows`` are read several times, so they should be stored or cached.
    """
    names = schema.names
    extra = [c for c in order if c != file]
    headed, of_file, why, place, n = (unused(c, rows) for c in ("headed", "of_file", "why", "place", "n"))
    files = rows.groupBy(file).agg(F.max(is_header(schema)).alias(headed)).withColumnRenamed(file, of_file)
    told = left_join_bounded(rows.where(~is_header(schema)), files, F.col(file).eqNullSafe(F.col(of_file)), max_files)
    content = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    reason = (
        F.when(~F.col(headed), "wrong header")
        .when(F.col(REJECT).isNotNull(), "unreadable record")
        .when(F.col(key).isNull(), f"no {key}")
    )
    told = told.withColumn(why, reason)
    record = F.coalesce(REJECT, content)
    bad = told.where(F.col(why).isNotNull()).groupBy(F.col(file), F.col(why), record).agg(F.count(F.lit(1)))
    sound = told.where(F.col(why).isNull()).select(*names, *extra, file)
    if sound.groupBy(key, file).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).isEmpty():
        return sound, bad.toDF(*REJECTS)
    keyed = sound.groupBy(*names, *extra, file).agg(F.count(F.lit(1)).alias(n))
    # The columns are compared one by one, so the choice is the same in every run.
    greatest = W.partitionBy(key, file).orderBy(*[F.desc(c) for c in (*extra, *names)])
    placed = keyed.withColumn(place, F.row_number().over(greatest))
    good = placed.where(F.col(place) == 1).select(*names, *extra, file)
    lost = F.col(n) - F.when(F.col(place) == 1, 1).otherwise(0)
    again = placed.where(lost > 0).select(F.col(file), F.lit(f"repeated {key}"), content, lost)
    return good, bad.toDF(*REJECTS).unionByName(again.toDF(*REJECTS))


def records(schema: T.StructType) -> list[Column]:
    """Counts of a lenient read, for ``observe``: records without headers, and those that cannot be read."""
    header = is_header(schema)
    return [F.count_if(~header).alias("records"), F.count_if(~header & F.col(REJECT).isNotNull()).alias("unreadable")]


def store_rejects(rejects: DataFrame, path: str) -> int:
    """Write the rejects of one run into its own folder, replacing those of an earlier attempt; how many
    records they stand for comes from the write."""
    seen = Observation()
    counted = rejects.observe(seen, F.coalesce(F.sum("copies"), F.lit(0)).alias("records"))
    counted.write.mode("overwrite").parquet(path)
    return seen.get["records"]
