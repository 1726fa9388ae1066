"""The warehouse: staging, fact, details, dimensions, bridges, calendar and the two reports.

Each model is a function ``DataFrame -> DataFrame`` and thereby a view; :func:`publish_models` stores
the ones that are read again.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listlake.functions import scalars as S
from listlake.functions.calendar import CALENDAR_END, CALENDAR_START, dim_date
from listlake.operators.joins import hot_keys, left_join_bounded, left_join_unique
from listlake.operators.multivalue import (
    Attribute,
    bridge,
    dimension,
    explode_product,
    join_bridge_dim,
    join_fact_multivalue,
)
from listlake.operators.quality import Suite, dq_unique, run_checks
from listlake.sources.lake import publish_bucketed, publish_table, stored_bytes

JOB_KEY = "job_id"

LANGUAGE = Attribute("programming_language", "lang_id", "lang")
TOOL = Attribute("tool", "tool_id", "tool")
FRAMEWORK = Attribute("framework", "framework_id", "framework")
ATTRIBUTES = {"language": LANGUAGE, "tool": TOOL, "framework": FRAMEWORK}

PASSED = [
    "detail_link", "listing_start_date", "monthly_salary", "occupation", "work_type",
    "work_location", "industry", "job_content", "required_skills", "preferred_skills",
    "rate_of_work", "job_title",
]
MEASURES = [
    "monthly_salary", "number_of_recruitment_interviews", "number_of_days_worked",
    "number_of_applicants",
]
FACT = [JOB_KEY, "listing_start_date", *MEASURES]
DETAILS = [
    JOB_KEY, "detail_link", "job_title", "occupation", "work_type", "work_location", "industry",
    "job_content", "required_skills", "preferred_skills",
]
REPORT_DETAILS = [
    "job_title", "detail_link", "occupation", "work_type", "work_location", "industry",
    "job_content", "required_skills", "preferred_skills",
]
# Report column -> calendar column.
REPORT_CALENDAR = {
    "listing_day_of_week": "day_of_week_name_short",
    "listing_week": "week_start_date",
    "listing_month": "month_start_date",
    "listing_quarter": "quarter_start_date",
    "listing_year": "year_start_date",
}
REPORT = [JOB_KEY, *MEASURES, *REPORT_DETAILS, "listing_start_date", *REPORT_CALENDAR]
REPORT_DETAIL = [
    JOB_KEY, *[a.id for a in ATTRIBUTES.values()], *MEASURES, *REPORT_DETAILS,
    *[a.value for a in ATTRIBUTES.values()], "listing_start_date", *REPORT_CALENDAR,
]

PUBLISHED_AT_ONCE = 4
#: Rows of one job that are too many for the task of a bucket.
BUCKET_ROWS = 1_000_000
#: Files of a dimension up to this size are broadcast.
BROADCAST_BYTES = 8 << 20
REPORTS = ("bi__job_analysis", "bi__job_analysis_detail")


def staging(lake: DataFrame) -> DataFrame:
    """Lake rows with a hashed key, lists as arrays and counts as integers."""
    return lake.select(
        *PASSED,
        S.md5_key(F.col("detail_link")).alias(JOB_KEY),
        *[S.split_lines(F.col(a.array)).alias(a.array) for a in ATTRIBUTES.values()],
        S.regex_int(F.col("number_of_recruitment_interviews")).alias(
            "number_of_recruitment_interviews"
        ),
        S.days_per_week(F.col("number_of_days_worked")).alias("number_of_days_worked"),
        S.regex_int(F.col("number_of_applicants")).alias("number_of_applicants"),
    )


def fct_jobs(stg: DataFrame) -> DataFrame:
    return stg.select(*FACT)


def dim_job_details(stg: DataFrame) -> DataFrame:
    return stg.select(*DETAILS)


def dim_attribute(stg: DataFrame, name: str) -> DataFrame:
    return dimension(stg, ATTRIBUTES[name])


def bridge_attribute(stg: DataFrame, name: str) -> DataFrame:
    return bridge(stg, JOB_KEY, ATTRIBUTES[name])


# ---------------------------------------------------------------------------------------- joins


def join_fact_details(
    fact: DataFrame, details: DataFrame, key: str = JOB_KEY, hot: list | None = ()
) -> DataFrame:
    """Fact LEFT JOIN details. ``hot=()`` states the fact's key is unique; ``None`` looks for keys
    that many fact rows share."""
    return left_join_unique(fact, details, key, None if hot is None else list(hot))


def join_fact_date(
    fact: DataFrame,
    calendar: DataFrame,
    day: str = "listing_start_date",
    max_days: int | None = None,
) -> DataFrame:
    """Fact LEFT JOIN calendar. ``max_days`` bounds the calendar's rows and so the broadcast; without
    a bound there is no hint, and Spark chooses by measured size."""
    return left_join_bounded(fact, calendar, F.col(day) == F.col("date_day"), max_days)


def _calendar_for_report(calendar: DataFrame) -> DataFrame:
    return calendar.select(
        "date_day", *[F.col(source).alias(name) for name, source in REPORT_CALENDAR.items()]
    )


# -------------------------------------------------------------------------------------- reports


def bi_job_analysis(
    fact: DataFrame, details: DataFrame, calendar: DataFrame, hot: list | None = (), max_days: int | None = None
) -> DataFrame:
    """One wide row per job. ``max_days`` is as in :func:`join_fact_date`."""
    # Calendar first: narrow rows meet the broadcast before the wide join.
    dated = join_fact_date(fact, _calendar_for_report(calendar), max_days=max_days)
    return join_fact_details(dated, details, hot=hot).select(*REPORT)


def bi_job_analysis_fused(stg: DataFrame, calendar: DataFrame, max_days: int | None = None) -> DataFrame:
    """The same rows without joining two projections of one table back together.

    Needs a unique job key in staging, which the data tests establish.
    """
    return join_fact_date(stg, _calendar_for_report(calendar), max_days=max_days).select(*REPORT)


def bi_job_analysis_detail(
    stg: DataFrame, calendar: DataFrame, strategy: str = "fused", max_days: int | None = None
) -> DataFrame:
    """One row per job x language x tool x framework.

    ``"star"`` joins fact, details, bridges and dimensions as modelled and makes no assumption on
    keys. ``"fused"`` explodes staging's arrays in place: one scan, no shuffle; it is equal to the
    star when the job key is unique.
    """
    attrs = list(ATTRIBUTES.values())
    if strategy == "fused":
        # Attributes of the date are added before the rows multiply.
        wide = join_fact_date(stg, _calendar_for_report(calendar), max_days=max_days)
        return explode_product(wide, attrs).select(*REPORT_DETAIL)
    if strategy != "star":
        raise ValueError(f"unknown strategy {strategy!r}")
    sides = [
        join_bridge_dim(bridge(stg, JOB_KEY, a), dimension(stg, a), a) for a in attrs
    ]
    base = bi_job_analysis(fct_jobs(stg), dim_job_details(stg), calendar, max_days=max_days)
    return join_fact_multivalue(base, JOB_KEY, sides).select(*REPORT_DETAIL)


# ----------------------------------------------------------------------------------- publishing


def models(
    stg: DataFrame, calendar: DataFrame, strategy: str = "fused", max_days: int | None = None
) -> dict[str, DataFrame]:
    """All models by name, lazily. ``max_days`` is the calendar's known bound, if there is one."""
    out = {
        "stg_joblist": stg,
        "fct_jobs": fct_jobs(stg),
        "dim_job_details": dim_job_details(stg),
        "dim_date": calendar,
    }
    for name in ATTRIBUTES:
        out[f"dim_{name}"] = dim_attribute(stg, name)
        out[f"bridge_{name}"] = bridge_attribute(stg, name)
    out["bi__job_analysis"] = (
        bi_job_analysis_fused(stg, calendar, max_days)
        if strategy == "fused"
        else bi_job_analysis(out["fct_jobs"], out["dim_job_details"], calendar, max_days=max_days)
    )
    out["bi__job_analysis_detail"] = bi_job_analysis_detail(stg, calendar, strategy, max_days)
    return out


def build_models(
    spark: SparkSession,
    lake: DataFrame,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
    strategy: str = "fused",
) -> dict[str, DataFrame]:
    return models(staging(lake), dim_date(spark, start, end), strategy, (end - start).days)


def choose_strategy(stg: DataFrame) -> str:
    """``fused`` where the job key is unique, which one aggregate over the key column decides."""
    return "fused" if dq_unique(stg, JOB_KEY).isEmpty() else "star"


def publish_models(
    spark: SparkSession,
    lake: DataFrame,
    root: str,
    run_id: str,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
) -> dict[str, DataFrame]:
    """Build the warehouse: staging, bridges, dimensions and the reports as tables below
    ``<root>/<run_id>``, fact and details as projections of the stored staging. A run has its own folder,
    so readers of the previous one are not disturbed."""
    stg = publish_table(staging(lake), f"{root}/{run_id}/stg_joblist")
    tables = models(stg, dim_date(spark, start, end), choose_strategy(stg), (end - start).days)
    links = [f"{kind}_{name}" for kind in ("bridge", "dim") for name in ATTRIBUTES]

    def publish(name: str) -> DataFrame:
        return publish_table(tables[name], f"{root}/{run_id}/{name}")

    # None reads another, so their jobs run side by side; the longest is begun first.
    names = [*reversed(REPORTS), *links]
    with ThreadPoolExecutor(PUBLISHED_AT_ONCE) as pool:
        stored = list(pool.map(inheritable_thread_target(spark)(publish), names))
    return {**tables, **dict(zip(names, stored, strict=True))}


@dataclass
class Star:
    """A published star: staging and bridges by buckets of the job key, dimensions, calendar, and each
    bridge's hot jobs."""

    stg: DataFrame
    bridges: dict[str, DataFrame]
    dims: dict[str, DataFrame]
    calendar: DataFrame
    max_days: int
    hot: dict[str, dict]


def publish_star(
    spark: SparkSession,
    lake: DataFrame,
    root: str,
    run_id: str,
    buckets: int | None = None,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
) -> Star:
    """Store the star so that its reports join on the job key without an exchange.

    ``buckets`` (by default as many as shuffle partitions) should leave a bucket of the largest table a few
    hundred megabytes. A bridge with a job in which a bucket would be lost is stored as it is; its hot jobs are
    looked for here, once, and not by every report.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def table(name: str) -> tuple[str, str]:
        return f"{name}_{re.sub('[^0-9a-zA-Z]', '_', run_id)}", f"{root}/{run_id}/{name}"

    stg = publish_bucketed(staging(lake), *table("stg_joblist"), JOB_KEY, buckets)

    def publish(name: str) -> tuple[DataFrame, DataFrame, dict]:
        link = bridge_attribute(stg, name)
        hot = hot_keys(link, JOB_KEY, rows=BUCKET_ROWS)
        stored = publish_table(link, table(f"bridge_{name}")[1]) if hot else publish_bucketed(link, *table(f"bridge_{name}"), JOB_KEY, buckets)
        return stored, publish_table(dim_attribute(stg, name), table(f"dim_{name}")[1]), hot

    with ThreadPoolExecutor(PUBLISHED_AT_ONCE) as pool:
        links, dims, hot = zip(*pool.map(inheritable_thread_target(spark)(publish), ATTRIBUTES), strict=True)
    by_name = [dict(zip(ATTRIBUTES, x, strict=True)) for x in (links, dims, hot)]
    return Star(stg, by_name[0], by_name[1], dim_date(spark, start, end), (end - start).days, by_name[2])


def star_detail(star: Star, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The detail report of a published star.

    Fact, details and bridges meet bucket by bucket. A dimension whose files are small is broadcast to its
    bridge, which leaves the buckets as they are; a larger one is joined to the finished product by its own key.
    """
    base = bi_job_analysis(fct_jobs(star.stg), dim_job_details(star.stg), star.calendar, max_days=star.max_days)
    sides, late = [], []
    for name, attr in ATTRIBUTES.items():
        side, dim = star.bridges[name], star.dims[name]
        if stored_bytes(dim) <= broadcast_bytes:
            side = side.join(F.broadcast(dim), attr.id, "left")
        else:
            late.append((attr, dim))
        sides.append(side)
    out = join_fact_multivalue(base, JOB_KEY, sides, [star.hot[name] for name in ATTRIBUTES])
    for attr, dim in late:
        out = join_bridge_dim(out, dim, attr)
    return out.select(*REPORT_DETAIL)


# ----------------------------------------------------------------------------------- data tests


def declared_suite() -> Suite:
    """The data tests declared on the warehouse."""
    suite = (
        Suite()
        .unique("lake__joblist", "detail_link")
        .not_null("lake__joblist", "detail_link", "listing_start_date")
        .freshness("lake__joblist", "listing_start_date")
        .unique("stg_joblist", JOB_KEY, "detail_link")
        .not_null("stg_joblist", JOB_KEY, "detail_link", "listing_start_date")
        .unique("fct_jobs", JOB_KEY)
        .not_null("fct_jobs", JOB_KEY, "listing_start_date")
        .unique("dim_job_details", JOB_KEY)
        .not_null("dim_job_details", JOB_KEY)
        .relationships("dim_job_details", JOB_KEY, "fct_jobs", JOB_KEY)
        .unique("bi__job_analysis", JOB_KEY)
        .not_null("bi__job_analysis", JOB_KEY)
        .not_null("bi__job_analysis_detail", JOB_KEY)
        .unique_combination(
            "bi__job_analysis_detail", JOB_KEY, *[a.id for a in ATTRIBUTES.values()]
        )
    )
    for name, attr in ATTRIBUTES.items():
        dim, link = f"dim_{name}", f"bridge_{name}"
        suite.unique(dim, attr.id).not_null(dim, attr.id, attr.value)
        suite.not_null(link, JOB_KEY, attr.id)
        suite.relationships(link, JOB_KEY, "fct_jobs", JOB_KEY)
        suite.relationships(link, attr.id, dim, attr.id)
        suite.unique_combination(link, JOB_KEY, attr.id)
    return suite


def check_warehouse(lake: DataFrame, tables: dict[str, DataFrame], as_of: date) -> DataFrame:
    """Results of every declared test. Pass published tables: views would expand once per test."""
    return run_checks({"lake__joblist": lake, **tables}, declared_suite().checks, as_of)
