"""The listing tables, derived by Spark from the given tables.

No given table holds job listings, so ``documents`` stands in: one listing per document, with the
lines of its whole text as the multi-valued attribute. Row counts and sizes follow the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listlake.operators.paging import latest_first_pages
from listlake.schemas import DETAIL_LABELS, LAKE

PER_PAGE = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18 columns of the lake."""
    return table(spark, sf_dir, "documents").selectExpr(
        "n_chars AS monthly_salary",
        "lang AS occupation",
        "source AS work_type",
        "concat(lang, '-', source) AS work_location",
        "source AS industry",
        "concat(source, ' & ', lang) AS job_content",
        "concat(lang, '\n', source) AS required_skills",
        "CASE WHEN n_chars % 3 = 0 THEN NULL ELSE source END AS preferred_skills",
        "text AS programming_language",
        "concat(lang, '\n', source) AS tool",
        "CASE n_chars % 4 WHEN 0 THEN NULL WHEN 1 THEN concat(source, '\n', source) "
        "WHEN 2 THEN concat(lang, '\n\n', source) ELSE lang END AS framework",
        "concat(n_chars % 101, '%') AS rate_of_work",
        "CASE WHEN n_chars % 5 = 0 THEN '応相談' "
        "ELSE concat(n_chars % 5, '回（予定', n_chars % 7, '）') END "
        "AS number_of_recruitment_interviews",
        "CASE WHEN n_chars % 6 = 0 THEN '週3〜5日' ELSE concat('週', n_chars % 6, '日') END "
        "AS number_of_days_worked",
        "CASE WHEN n_chars % 9 = 0 THEN NULL ELSE concat(n_chars % 30, '名') END "
        "AS number_of_applicants",
        "concat(source, ' ', lang, ' ', doc_id) AS job_title",
        "date_add(DATE'2025-11-15', cast(n_chars % 60 AS int)) AS listing_start_date",
        "concat('/jobs/', doc_id) AS detail_link",
    ).select(*LAKE.names)


def _escape(c):
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def list_pages(
    spark: SparkSession, sf_dir: str, newest_first: bool = False, damaged: bool = False
) -> DataFrame:
    """``(page, html)``: listing pages of ``PER_PAGE`` documents, so a group has a fixed size.

    ``newest_first`` puts them in the order of their dates, as a site does. ``damaged`` takes the date
    from every 11th and the link from every 13th listing.
    """
    docs = table(spark, sf_dir, "documents").withColumn(
        "day", F.expr("date_add(DATE'2025-11-15', cast(n_chars % 60 AS int))")
    )
    if newest_first:
        docs = latest_first_pages(docs.select("doc_id", "source", "lang", "day"), [F.desc("day"), F.asc("doc_id")], PER_PAGE)
    else:
        docs = docs.withColumn("page", (F.floor(F.col("doc_id") / PER_PAGE) + 1).cast("bigint"))
    day = F.expr("date_format(day, \"y'年'M'月'd'日'\")")
    link = F.concat(F.lit(' href="/jobs/'), F.col("doc_id").cast("string"), F.lit('"'))
    if damaged:
        day = F.when(F.col("doc_id") % 11 == 0, "未定").otherwise(day)
        link = F.when(F.col("doc_id") % 13 == 0, "").otherwise(link)
    item = F.concat(
        F.lit('<div class="job-Title">'),
        _escape(F.concat_ws(" & ", "source", "lang")),
        F.lit('</div><div class="time-Stamp">掲載開始日：'),
        day,
        F.lit('</div><ul><li class="detail-Btn02"><a class="btn"'),
        link,
        F.lit(">詳細</a></li></ul>"),
    )
    items = docs.select("page", F.struct("doc_id", item.alias("item")).alias("s"))
    ordered = F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["item"]), "\n")
    return items.groupBy("page").agg(
        F.concat(F.lit("<!DOCTYPE html><html><body>"), ordered, F.lit("</body></html>")).alias("html")
    )


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(detail_link, html)``: one page per document with its whole text in a table cell."""
    lake = listing_lake(spark, sf_dir)
    basics = ["occupation", "work_type", "work_location", "industry"]
    items = F.concat(
        F.lit("<li>〜"), F.format_number("monthly_salary", 0), F.lit("円</li>"),
        *[F.concat(F.lit("<li>"), _escape(F.col(c)), F.lit("</li>")) for c in basics],
    )
    rows = [
        F.when(
            F.col(name).isNotNull(),
            F.concat(F.lit(f"<tr><th>{label}</th><td>"), _escape(F.col(name)), F.lit("</td></tr>")),
        )
        for label, name in DETAIL_LABELS.items()
    ]
    return lake.select(
        "detail_link",
        F.concat(
            F.lit('<html><body><div class="job-Box"><ul>'), items, F.lit("</ul></div><table>"),
            F.concat_ws("", *rows), F.lit("</table></body></html>"),
        ).alias("html"),
    )


def trigger_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, body)``: every event as a trigger message.

    Clicks and views ask for the daily run; errors carry broken base64, sign-ups lack the
    subscription, purchases have another type. A user's events share the message id, so most
    messages are replays.
    """
    payload = F.when(F.col("event_type") == "error", F.lit("%%%")).otherwise(
        F.base64(
            F.encode(
                F.concat(
                    F.lit('{"type":"'),
                    F.when(F.col("event_type") == "purchase", "other").otherwise("daily_scraping"),
                    F.lit('"}'),
                ),
                "UTF-8",
            )
        )
    )
    message = F.struct(payload.alias("data"), F.col("user_id").cast("string").alias("messageId"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(
            F.col("event_type") == "signup", F.to_json(F.struct(message.alias("message")))
        )
        .otherwise(
            F.to_json(F.struct(message.alias("message"), F.lit("daily").alias("subscription")))
        )
        .alias("body"),
    )
