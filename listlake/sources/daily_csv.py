"""Raw day files: ``<root>/partition_date=yyyyMMdd/*.csv``."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from listlake.functions.scalars import date_to_partition
from listlake.schemas import LAKE

# A header, a line break and a value: a shorter file holds no record.
MIN_BYTES = 3
ROWS_PER_FILE = 500_000
DAY = "partition_date"

CSV = {
    "header": "true",
    "encoding": "UTF-8",
    # Lists are separated by newlines inside quoted fields; quotes are doubled.
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
REJECT = "_reject"
READ = {
    **CSV,
    # The files are read by position, so a header in another order has to fail, not shift columns.
    "enforceSchema": "false",
    "mode": "FAILFAST",
}
# NULL and '' are both written as nothing at all.
WRITE = {**CSV, "nullValue": "", "emptyValue": ""}


# Every line is a record, the header too: a file whose header is wrong can then be told from the others
# of a read, which the reader itself would end.
LENIENT = {**CSV, "header": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT}


def with_rejects(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(REJECT, T.StringType(), True)])


def is_header(schema: T.StructType) -> Column:
    """Whether a record of a ``LENIENT`` read is the header that the schema asks for. It is no good record
    where a column is not text, so it then stands in the column of rejects."""
    line = F.regexp_replace(REJECT, "[\"\ufeff\r\n]", "") == ",".join(schema.names)
    if all(isinstance(f.dataType, T.StringType) for f in schema.fields):
        named = reduce(Column.__and__, [F.col(f.name) == f.name for f in schema.fields])
        return F.coalesce(line, F.lit(False)) | F.coalesce(named, F.lit(False))
    return F.coalesce(line, F.lit(False))


def read_csv_typed(
    spark: SparkSession, path: str, schema: T.StructType = LAKE, rejects: bool = False
) -> DataFrame:
    """Typed scan of one or more day files. A bad record fails the job.

    ``rejects=True`` keeps bad records instead, whole, in a column ``_reject`` that is NULL on good
    rows, so a job can store them apart.
    """
    reader = spark.read.options(**READ)
    if rejects:
        schema = with_rejects(schema)
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=REJECT)
    return reader.schema(schema).csv(path)


def file_gate(df: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Leave out files that are too short to hold a record. The filter is on file metadata: such files
    are dropped while planning and never opened."""
    return df.where(F.col("_metadata.file_size") >= min_bytes)


def read_days(
    spark: SparkSession,
    root: str,
    day: date | None = None,
    schema: T.StructType = LAKE,
    min_bytes: int = MIN_BYTES,
) -> DataFrame | None:
    """Rows of one day, or of all days, with ``partition_date``; None where there is no folder."""
    try:
        df = read_csv_typed(spark, root, schema)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if DAY not in df.columns:
        return None
    if day is not None:
        df = df.where(F.col(DAY) == int(day.strftime("%Y%m%d")))
    return file_gate(df, min_bytes)


def _write(df: DataFrame, path: str, by_day: bool) -> int:
    seen = Observation()
    writer = (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        # A multi-line file cannot be split when it is read back.
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .options(**WRITE)
    )
    if by_day:
        # Days without a row in ``df`` are left alone.
        writer = writer.partitionBy(DAY).option("partitionOverwriteMode", "dynamic")
    writer.csv(path)
    return seen.get["rows"]


def save_day(df: DataFrame, root: str, day: date) -> tuple[str, int]:
    """A run's output as the files of one day: ``(folder, rows)``. Replaces that day, also when there
    is no row.

    Every task writes what it holds, without a shuffle; the row count comes from the write itself.
    """
    path = f"{root}/{DAY}={day.strftime('%Y%m%d')}"
    return path, _write(df, path, by_day=False)


def write_days(df: DataFrame, root: str, day: str) -> int:
    """Many days at once: every row goes to the folder of its ``day`` column.

    Rebalance gathers the rows of a day into few files and cuts a hot day into several.
    """
    dated = df.withColumn(DAY, date_to_partition(F.col(day)))
    return _write(dated.hint("rebalance", DAY), root, by_day=True)
