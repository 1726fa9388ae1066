"""Newest-first paging and the cut-off that ends a collection run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listlake.operators.joins import unused
from listlake.session import work_dir


def filter_since(df: DataFrame, day: str, limit: date) -> DataFrame:
    """Rows dated ``limit`` or later. A plain comparison, so it reaches the scan."""
    return df.where(F.col(day) >= F.lit(limit))


def latest_first_pages(
    df: DataFrame, newest_first: list[Column], page_size: int, max_pages: int | None = None
) -> DataFrame:
    """Number pages of ``page_size`` rows, newest first, as a listing site shows them.

    All rows get a page; only with ``max_pages`` are those of later pages left out, which makes it a
    top-k. The rows are sorted once, by ranges, and stored; a row's place is its place in its own
    range plus the rows of the ranges before, of which there is one number each. ``newest_first`` has to
    be a total order.
    """
    ordered = df.orderBy(*newest_first)
    if max_pages is not None:
        ordered = ordered.limit(max_pages * page_size)
    path = work_dir(df.sparkSession, "ordered")
    at, in_part, n, earlier = (unused(c, df) for c in ("at", "in_part", "n", "earlier"))
    ordered.withColumn(at, F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    part, inside = F.shiftright(at, 33), F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias(in_part)).agg(F.count(F.lit(1)).alias(n))
    before = W.orderBy(in_part).rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(in_part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(earlier))
    place = F.col(earlier) + inside
    numbered = rows.withColumn(in_part, part).join(sizes, in_part)
    return numbered.withColumn("page", (F.floor(place / page_size) + 1).cast("bigint")).select(*df.columns, "page")


def pages_since(
    df: DataFrame, moment: str, tie: str, since: date, page_size: int, bucket_seconds: int = 600, page: str = "page",
    bucket_rows: int = 5_000_000,
) -> DataFrame:
    """What :func:`page_cutoff` keeps of pages newest first by ``moment`` (then by ``tie``), without numbering
    all rows: rows of ``since`` or later, with their page.

    In that order every kept row comes before the first older one, so the cut-off page follows from their
    number and only their places are needed. A place is the count of rows in later spans of ``bucket_seconds``,
    of which there is one number each, plus the place within the span; nothing is sorted as a whole, and
    older rows are left out by the scan. A span with more than ``bucket_rows`` rows is too much for one task: then
    the kept rows are sorted by ranges instead.
    """
    span, n, before = (unused(c, df) for c in ("span", "n", "before"))
    kept = df.where(F.col(moment) >= F.lit(since).cast(df.schema[moment].dataType))
    spans = kept.withColumn(span, F.floor(F.unix_seconds(F.col(moment).cast("timestamp")) / bucket_seconds))
    sizes = spans.groupBy(span).agg(F.count(F.lit(1)).alias(n))
    if (sizes.agg(F.max(n)).first()[0] or 0) > bucket_rows:
        return latest_first_pages(kept, [F.desc(moment), F.asc(tie)], page_size).withColumnRenamed("page", page)
    later = W.orderBy(F.desc(span)).rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(span, F.coalesce(F.sum(n).over(later), F.lit(0)).alias(before))
    place = F.row_number().over(W.partitionBy(span).orderBy(F.desc(moment), F.asc(tie))) - 1
    placed = spans.withColumn(n, place).join(sizes, span)
    number = F.floor((F.col(before) + F.col(n)) / page_size) + 1
    return placed.withColumn(page, number.cast("bigint")).select(*df.columns, page)


def page_min_date(df: DataFrame, day: str, page: str = "page") -> DataFrame:
    """Oldest date on every page."""
    return df.groupBy(page).agg(F.min(day).alias("min_date"))


def last_page(
    df: DataFrame, day: str, limit: date, page: str = "page", max_pages: int | None = None
) -> DataFrame:
    """One row: the last page a run reads, 0 if there is none.

    That is the first page holding a row older than ``limit``, or the page before the first empty one,
    or ``max_pages`` if that is given, whichever comes first. The first empty page follows the lowest
    page that has no successor.
    """
    pages = df.where(F.col(page) >= 1).groupBy(F.col(page).cast("bigint").alias("p")).agg(
        F.coalesce(F.max(F.col(day) < F.lit(limit)), F.lit(False)).alias("old")
    )
    follows = pages.select((F.col("p") - 1).alias("p"), F.lit(True).alias("more"))
    ends = pages.join(follows, "p", "left").agg(
        F.min("p").alias("first"),
        F.min(F.when(F.col("old"), F.col("p"))).alias("old"),
        F.min(F.when(F.col("more").isNull(), F.col("p"))).alias("gap"),
    )
    last = F.least("old", "gap", F.lit(max_pages).cast("bigint"))  # NULL is no limit
    return ends.select(F.when(F.col("first") == 1, last).otherwise(0).alias("last_page"))


def page_cutoff(
    df: DataFrame, day: str, limit: date, page: str = "page", max_pages: int | None = None
) -> DataFrame:
    """Rows a run keeps: pages up to the cut-off, and of those the rows dated ``limit`` or later.

    The cut-off is a scalar subquery, so the rows are filtered where they lie.
    """
    return filter_since(read_pages(df, day, limit, page, max_pages), day, limit)


def read_pages(
    df: DataFrame, day: str, limit: date, page: str = "page", max_pages: int | None = None
) -> DataFrame:
    """All rows of the pages up to the cut-off."""
    cut = last_page(df, day, limit, page, max_pages).scalar()
    return df.where((F.col(page) >= 1) & (F.col(page) <= cut))


def assign_runs(df: DataFrame, day: str, days_back: int = 1, run: str = "run_date") -> DataFrame:
    """One row per daily run whose window ``[run_date - days_back, run_date]`` holds the row.

    A run on one date is ``filter_since(day, run_date - days_back)``; this is the same for a whole
    range of runs at once, without a range join: a row names its own runs.
    """
    runs = F.sequence(F.col(day), F.date_add(F.col(day), days_back))
    return df.withColumn(run, F.explode(runs))
