"""Run accounting: row counts and run records."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listlake.schemas import RUNS


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``(name, n)`` for each frame. Counting reads no columns; where a frame is written anyway, the
    sinks return the count of the write instead."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def run_record(
    spark: SparkSession,
    run_id: str,
    status: str,
    message: str,
    loaded_rows: int | None = None,
    limit_date: date | None = None,
    saved_path: str | None = None,
    rejected_rows: int | None = None,
) -> DataFrame:
    """Outcome of one run as a row of the runs table."""
    return spark.createDataFrame(
        [(run_id, status, message, loaded_rows, limit_date, saved_path, rejected_rows)], RUNS
    )


def append_run(record: DataFrame, path: str) -> None:
    record.coalesce(1).write.mode("append").parquet(path)


def islands(days: DataFrame, day: str = "day") -> DataFrame:
    """Runs of consecutive days: ``(first_day, last_day, n_days)``, each as long as it goes.

    A day's number less its place among the different days is the same for neighbours. There is one row a
    day of the calendar at most, so the one window is small; NULL days belong to no island.
    """
    unique = days.where(F.col(day).isNotNull()).select(F.col(day).cast("date").alias("day")).distinct()
    place = F.row_number().over(W.orderBy("day"))
    start = unique.select("day", F.date_sub("day", place).alias("start"))
    return start.groupBy("start").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n_days")
    ).drop("start")


def gaps(days: DataFrame, day: str, first: date, last: date) -> DataFrame:
    """The islands of days from ``first`` to ``last`` that ``days`` does not hold."""
    spark = days.sparkSession
    wanted = spark.range((last - first + timedelta(days=1)).days).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("day")
    )
    there = days.select(F.col(day).cast("date").alias("day")).distinct()
    return islands(wanted.join(there, "day", "left_anti"))


def missing_days(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """Islands of days without a successful run that loaded rows, from the run records below ``path``.

    A run that found no file loaded nothing, so its day is still missing; no record at all leaves one island.
    """
    spark.createDataFrame([], RUNS).coalesce(1).write.mode("ignore").parquet(path)
    done = spark.read.schema(RUNS).parquet(path).where("status = 'success' AND loaded_rows > 0")
    return gaps(done, "limit_date", first, last)
