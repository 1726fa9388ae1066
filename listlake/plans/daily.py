"""The two daily jobs: collect a day's listings into a day file, load a day file into the lake."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listlake.operators.pages import attach_list_to_detail, listing_columns, listings, parse_detail_page
from listlake.operators.paging import filter_since, read_pages
from listlake.operators.upsert import last_per_key
from listlake.operators.runs import append_run, missing_days, run_record
from listlake.schemas import LAKE
from listlake.session import discard, work_dir
from listlake.sources.daily_csv import read_days, save_day
from listlake.sources.lake import LakeTable, publish_table

JST_ZONE = timezone(timedelta(hours=9))
REJECT = "reject"


class RejectedListings(ValueError):
    """Some listings of a run could not be used."""


def jst_today() -> date:
    return datetime.now(JST_ZONE).date()


def jst_yesterday() -> date:
    return jst_today() - timedelta(days=1)


def outcome(status: str, message: str, **facts) -> dict:
    """What a run reports; the keys are those of the run record."""
    return {"status": status, "message": message, **facts}


def collect_listings(list_pages: DataFrame, detail_pages: DataFrame, limit: date) -> DataFrame:
    """Rows of the lake from pages, and ``reject``: NULL, or why a listing cannot be used.

    ``list_pages(page, html)`` are numbered newest first; ``detail_pages(detail_link, html)`` hold
    the page behind each link. Every listing of the pages up to the cut-off comes out once, but for
    those older than ``limit`` and for repeated ones.
    """
    return _collected(listings(_told_apart(list_pages)), detail_pages, limit)


def _told_apart(list_pages: DataFrame) -> DataFrame:
    return list_pages.select("page", F.col("html").isNull().alias("blank"), "html")


def _collected(parsed: DataFrame, detail_pages: DataFrame, limit: date) -> DataFrame:
    """The same from parsed pages ``(page, blank, listings)``.

    Only a page that was read and holds no listing ends paging. A page without text, or one that cannot be
    read, is a reject of its own and the pages behind it are read on.
    """
    unread = F.col("listings").isNull()
    rows = parsed.where(unread | (F.size("listings") > 0)).select(
        "page", F.when(unread, F.when(F.col("blank"), "page without text").otherwise("page not readable")).alias("fault"),
        F.explode_outer("listings").alias("listing"),
    )
    seen = read_pages(rows.select("page", "fault", *listing_columns("listing")), "listing_start_date", limit).drop("page")
    blank = seen.where(F.col("fault").isNotNull()).select(F.col("fault").alias(REJECT))
    seen = seen.where(F.col("fault").isNull()).drop("fault")
    fault = F.when(F.col("detail_link").isNull(), "no link").when(F.col("listing_start_date").isNull(), "no date")
    bad = seen.where(fault.isNotNull()).withColumn(REJECT, fault)
    # A listing that moves to the next page between two requests is seen twice.
    good = filter_since(seen.where(F.col("detail_link").isNotNull()), "listing_start_date", limit)
    good = last_per_key(good, "detail_link", ["listing_start_date"])
    details = parse_detail_page(detail_pages.where("html IS NOT NULL").select("detail_link", "html"))
    rows = attach_list_to_detail(details, good, found="page_found")
    rows = rows.withColumn(REJECT, F.when(F.col("page_found").isNull(), "no detail page")).drop("page_found")
    for more in (bad, blank):
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows.select(*LAKE.names, REJECT)


def collect_day(
    list_pages: DataFrame,
    detail_pages: DataFrame,
    raw_root: str,
    run_date: date | None = None,
    on_reject: str = "store",
) -> dict:
    """A daily run: everything dated the day before ``run_date`` or later becomes that day's file.

    Rejected listings are stored beside it, below ``<raw_root>-rejects``, and counted; with
    ``on_reject="error"`` one is enough to end the run before anything is written.
    """
    if on_reject not in ("store", "error"):
        raise ValueError(f"unknown on_reject {on_reject!r}")
    run_date = run_date or jst_today()
    limit = run_date - timedelta(days=1)
    # Parsed once: the cut-off, the rejects and the listings are all read from the stored arrays.
    path = work_dir(list_pages.sparkSession, "parsed")
    parsed = publish_table(listings(_told_apart(list_pages)), path)
    rows = _collected(parsed, detail_pages, limit).persist()
    try:
        rejects = rows.where(F.col(REJECT).isNotNull())
        lost = rejects.count()
        if lost and on_reject == "error":
            reasons = rejects.groupBy(REJECT).count().orderBy(REJECT).collect()
            raise RejectedListings(", ".join(f"{r['count']} with {r[REJECT]}" for r in reasons))
        saved, count = save_day(rows.where(F.col(REJECT).isNull()).select(*LAKE.names), raw_root, run_date)
        beside = f"{raw_root}-rejects/partition_date={run_date.strftime('%Y%m%d')}"
        rejects.write.mode("overwrite").parquet(beside)
    finally:
        rows.unpersist()
        discard(parsed.sparkSession, path)
    return outcome(
        "success", f"{count} listings in {saved}, {lost} rejected", record_count=count, reject_count=lost,
        limit_date=limit.isoformat(), saved_path=saved, rejects_path=beside,
    )


def _load(spark: SparkSession, raw_root: str, lake: LakeTable, day: date, merge) -> dict:
    rows = read_days(spark, raw_root, day)
    if rows is None:
        return outcome("success", f"no file of {day}", loaded_rows=0)
    # Parsed once: a multi-line file is one task and the merge reads its source several times.
    rows = rows.select(*LAKE.names).persist()
    try:
        loaded = rows.count()
        if loaded:
            lake.create_if_absent()
            merge(rows)
    finally:
        rows.unpersist()
    return outcome("success", f"{loaded} listings of {day} merged into {lake.root}", loaded_rows=loaded)


def load_day(
    spark: SparkSession,
    raw_root: str,
    lake: LakeTable,
    day: date | None = None,
    on_duplicate: str = "error",
    order: list[str] | None = None,
) -> dict:
    """Merge one day's file into the lake and report what was loaded.

    An absent or empty file is a success without rows; any failure is reported, not raised, and
    leaves the lake at its former version.
    """
    merge = partial(lake.merge, on_duplicate=on_duplicate, order=order)
    try:
        return _load(spark, raw_root, lake, day or jst_yesterday(), merge)
    except Exception as fault:
        return outcome("error", f"{type(fault).__name__}: {fault}")


def backfill(
    spark: SparkSession, raw_root: str, lake: LakeTable, first: date, last: date, **merge
) -> list[dict]:
    """Load a range of days, oldest first, so that later files win.

    Stops at the first day that fails: a later day must not be in the lake before it, or loading the
    failed one afterwards would put older rows over newer ones.
    """
    reports = []
    for offset in range((last - first).days + 1):
        reports.append(load_day(spark, raw_root, lake, first + timedelta(days=offset), **merge))
        if reports[-1]["status"] != "success":
            break
    return reports


def resume(
    spark: SparkSession, raw_root: str, lake: LakeTable, runs: str, first: date, last: date, **merge
) -> list[dict]:
    """Load the days of a range that no run record reports as loaded, oldest first, and record each run.

    It begins at the first missing day and stops at the first that fails, so calling it again goes on from
    there. Days behind the first missing one are loaded again even if they were before: their files have to win
    over the older one's. The records say which range was covered, so nothing else has to be remembered.
    """
    gap = missing_days(spark, runs, first, last).orderBy("first_day").first()  # the oldest island
    reports: list[dict] = []
    day = gap["first_day"] if gap else last + timedelta(days=1)
    while day <= last and all(r["status"] == "success" for r in reports):
        reports.append(load_day(spark, raw_root, lake, day, **merge))
        append_run(run_record(spark, f"load-{day.isoformat()}", limit_date=day, **reports[-1]), runs)
        day += timedelta(days=1)
    return reports
