"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listlake.functions import scalars as S
from listlake.functions.calendar import dim_date, dim_date_spanning
from listlake.functions.html import Extract, Field, Selector, extract
from listlake.operators import joins as J
from listlake.operators import multivalue as M
from listlake.operators import pages as P
from listlake.operators import paging as G
from listlake.operators import quality as Q
from listlake.operators import runs as R
from listlake.operators import upsert as U
from listlake.plans import daily
from listlake.plans import warehouse as W
from listlake.session import tune, work_dir
from listlake.sources import daily_csv as C
from listlake.sources import lake as K
from listlake.sources import ledger as L
from listlake.streaming.file_ingest import ingest_and_record, stream_file_ingest
from listlake.streaming.message_gate import envelope_filter, stream_message_gate
from workload.standins import detail_pages, list_pages, listing_lake, table, trigger_messages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SINCE = date(2024, 1, 15)
CRAWL_LIMIT = date(2024, 1, 26)
PAGE_SIZE = 50
AS_OF = date(2024, 2, 2)
CHECKED_ON = date(2026, 1, 16)
PROCESSED_AT = datetime(2024, 2, 1, 5, 0, 0)
ORDER_DAYS = (date(1996, 1, 1), date(2001, 1, 1))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def day_of(column: str):
    return F.col(column).cast("date")


def lines_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", S.split_lines(F.col("text")).alias("lines"))


LINES = M.Attribute("lines", "line_id", "line")


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", day_of("ts").alias("day"))
    return G.latest_first_pages(events, [F.desc("ts"), F.asc("event_id")], PAGE_SIZE)


# ------------------------------------------------------------------------- scans, sources, sinks


@query
def scan_csv_typed(spark, sf_dir):
    path, _ = C.save_day(listing_lake(spark, sf_dir), work_dir(spark, "raw"), AS_OF)
    return C.read_csv_typed(spark, path)


@query
def scan_partition_date(spark, sf_dir):
    root = work_dir(spark, "raw")
    C.write_days(listing_lake(spark, sf_dir), root, "listing_start_date")
    days = C.read_days(spark, root)
    newest = days.agg(F.max(C.DAY)).scalar()
    return days.where(F.col(C.DAY) == newest).select(C.DAY, "detail_link", "programming_language")


@query
def scan_file_gate(spark, sf_dir):
    root = work_dir(spark, "raw")
    C.write_days(listing_lake(spark, sf_dir), root, "listing_start_date")
    # A day without listings: its file is a lone newline.
    blank = spark.createDataFrame([("",)], "line string").coalesce(1)
    blank.write.text(f"{root}/{C.DAY}=19700101")
    return C.read_days(spark, root).select(C.DAY, "detail_link", "monthly_salary")


def _merged_lake(spark, sf_dir) -> K.LakeTable:
    lake = K.LakeTable(spark, work_dir(spark, "lake")).create_if_absent()
    lake.merge(listing_lake(spark, sf_dir))
    return lake


@query
def scan_lake(spark, sf_dir):
    return _merged_lake(spark, sf_dir).read()


@query
def sink_daily_csv(spark, sf_dir):
    root = work_dir(spark, "raw")
    lake = listing_lake(spark, sf_dir)
    # The second write replaces the days of the first.
    C.write_days(lake.withColumn("job_title", F.lit("draft")), root, "listing_start_date")
    C.write_days(lake, root, "listing_start_date")
    return C.read_days(spark, root).select(C.DAY, "detail_link", "job_title", "programming_language")


@query
def sink_lake_partitioned(spark, sf_dir):
    path = work_dir(spark, "table")
    name = "lake_" + path.rsplit("-", 1)[1]
    K.ensure_day_table(spark, name, path)
    lake = listing_lake(spark, sf_dir).select(*spark.table(name).columns)
    lake.hint("rebalance", "listing_start_date").write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")  # the table is external: its files stay
    stored = spark.read.schema(lake.schema).parquet(path)
    return stored.groupBy("listing_start_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("monthly_salary").alias("salary")
    )


@query
def materialize_model(spark, sf_dir):
    lake = K.publish_view(listing_lake(spark, sf_dir), "lake__joblist")
    tables = W.publish_models(spark, lake, work_dir(spark, "warehouse"), "run-1")
    return tables["bi__job_analysis"]


# ------------------------------------------------------------------------------------- page parsing


@query
def parse_list_page(spark, sf_dir):
    return P.parse_list_page(list_pages(spark, sf_dir))


@query
def extract_titles(spark, sf_dir):
    pages = P.extract_titles(table(spark, sf_dir, "pages"), Selector(tag="title"))
    return J.unnest(pages, "titles", "title", keep=["page_id"], pos="pos")


@query
def extract_dates(spark, sf_dir):
    pages = P.extract_dates(list_pages(spark, sf_dir))
    return J.unnest(pages, "dates", "date_text", keep=["page"], pos="pos")


@query
def extract_links(spark, sf_dir):
    pages = P.extract_links(table(spark, sf_dir, "pages"), Selector(tag="li"))
    return J.unnest(pages, "links", "link", keep=["page_id"], pos="pos")


@query
def parse_detail_page(spark, sf_dir):
    return P.parse_detail_page(detail_pages(spark, sf_dir))


@query
def positional_fields(spark, sf_dir):
    pages = P.positional_fields(table(spark, sf_dir, "pages"), Selector(tag="nav"))
    return pages.select("page_id", *[F.get("items", F.lit(i)).alias(f"item_{i}") for i in range(5)])


@query
def label_value_pivot(spark, sf_dir):
    roles = {role: f"first_{role}" for role in ("system", "user", "assistant")}
    talks = table(spark, sf_dir, "conversations")
    return P.pivot_labels(talks, ["conv_id"], "role", "text", "turn", roles)


@query
def digits_to_int(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", S.digits_to_int(F.col("props")).alias("k"),
        S.digits_to_int(F.col("event_type")).alias("none"),
    )


@query
def parse_jp_date(spark, sf_dir):
    text = F.date_format("ts", "y'年'M'月'd'日'")
    return table(spark, sf_dir, "events").select(
        "event_id", S.parse_jp_date(text).alias("day"), S.parse_jp_date(F.col("props")).alias("none")
    )


@query
def html_tokens_udf(spark, sf_dir):
    anchors = Extract((Selector(tag="a"),), (Field("href", value="href"), Field("text", strip=False)))
    found = table(spark, sf_dir, "pages").select("page_id", extract(F.col("html"), {"e": anchors})["e"].alias("e"))
    return J.unnest(found, "e", "e", keep=["page_id"], pos="pos").select("page_id", "pos", "e.href", "e.text")


# -------------------------------------------------------------------- projections, filters, predicates


@query
def project_staging(spark, sf_dir):
    stg = W.staging(listing_lake(spark, sf_dir))
    arrays = {a.array: F.array_join(a.array, "|") for a in W.ATTRIBUTES.values()}
    return stg.withColumns(arrays)


@query
def project_fact(spark, sf_dir):
    return W.fct_jobs(W.staging(listing_lake(spark, sf_dir)))


@query
def project_details(spark, sf_dir):
    return W.dim_job_details(W.staging(listing_lake(spark, sf_dir)))


@query
def filter_since(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return G.filter_since(events, "ts", SINCE).drop("ts")


@query
def page_cutoff(spark, sf_dir):
    """Events newest first, by the places of the kept ones alone."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", day_of("ts").alias("day"))
    return G.pages_since(events, "ts", "event_id", CRAWL_LIMIT, PAGE_SIZE).drop("ts")


@query
def page_cutoff_numbered(spark, sf_dir):
    """The same from pages that are numbered already, in any order of dates."""
    return G.page_cutoff(event_pages(spark, sf_dir), "day", CRAWL_LIMIT).drop("ts")


@query
def envelope_filter_query(spark, sf_dir):
    return envelope_filter(trigger_messages(spark, sf_dir)).select("event_id", "message_id")


QUERIES["envelope_filter"] = QUERIES.pop("envelope_filter_query")


@query
def latest_first_pages(spark, sf_dir):
    return event_pages(spark, sf_dir).select("event_id", "day", "page")


# ------------------------------------------------------------------------------------------- joins


def _orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("order_day", day_of("o_orderdate")).drop("o_orderdate")


@query
def join_fact_details(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return W.join_fact_details(_orders(spark, sf_dir), customers, "o_custkey", hot=None)


@query
def join_fact_date(spark, sf_dir):
    calendar = dim_date(spark, *ORDER_DAYS).select(
        "date_day", "day_of_week_name_short", "week_start_date", "month_start_date"
    )
    days = (ORDER_DAYS[1] - ORDER_DAYS[0]).days
    return W.join_fact_date(_orders(spark, sf_dir), calendar, "order_day", days)


@query
def join_bridge_dim(spark, sf_dir):
    docs = lines_of_documents(spark, sf_dir)
    return M.join_bridge_dim(M.bridge(docs, "doc_id", LINES), M.dimension(docs, LINES), LINES)


@query
def join_fact_multivalue(spark, sf_dir):
    stg = W.staging(listing_lake(spark, sf_dir))
    sides = [M.bridge(stg, W.JOB_KEY, a) for a in W.ATTRIBUTES.values()]
    return M.join_fact_multivalue(W.fct_jobs(stg), W.JOB_KEY, sides)


@query
def unnest_lateral(spark, sf_dir):
    return J.unnest(lines_of_documents(spark, sf_dir), "lines", "line", keep=["doc_id"])


def _labelled_links(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.concat(F.lit("/jobs/"), F.col("doc_id").cast("string")).alias("detail_link")).distinct()


@query
def attach_list_to_detail(spark, sf_dir):
    lists = P.parse_list_page(list_pages(spark, sf_dir)).drop("page")
    # Only listings of labelled documents have a page.
    labelled = _labelled_links(spark, sf_dir)
    details = P.parse_detail_page(detail_pages(spark, sf_dir)).join(labelled, "detail_link", "left_semi")
    return P.attach_list_to_detail(details, lists)


@query
def anti_join_ledger(spark, sf_dir):
    messages = envelope_filter(trigger_messages(spark, sf_dir)).select("event_id", "message_id")
    # Users who had an error of a high value have been served.
    served = table(spark, sf_dir, "events").where("event_type = 'error' AND value > 100")
    done = served.select(F.col("user_id").cast("string").alias("message_id"))
    return L.anti_join_ledger(messages, L.ledger_rows(done, PROCESSED_AT))


# ------------------------------------------------------------------------------------------- upsert


def _changes(spark, sf_dir) -> DataFrame:
    """Every French listing moved by a week with a new salary, and a new listing per benchmark item."""
    lake = listing_lake(spark, sf_dir)
    moved = lake.where("occupation = 'fr'").withColumns(
        {
            "monthly_salary": F.col("monthly_salary") + 1,
            "listing_start_date": F.date_add("listing_start_date", 7),
        }
    )
    added = table(spark, sf_dir, "benchmark").selectExpr(
        "concat('/jobs/new/', item_id) AS detail_link", "text AS programming_language",
        "DATE'2024-12-01' AS listing_start_date",
    )
    return moved.unionByName(added, allowMissingColumns=True)


@query
def upsert_merge(spark, sf_dir):
    lake = _merged_lake(spark, sf_dir)
    changes = _changes(spark, sf_dir)
    for _ in range(2):  # merging the same file again changes nothing
        lake.merge(changes)
    return lake.read()


@query
def upsert_rows(spark, sf_dir):
    return U.upsert_rows(listing_lake(spark, sf_dir), _changes(spark, sf_dir), "detail_link")


@query
def dedupe_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return U.dedupe_source(docs, "text", on_duplicate="last", order=["doc_id"])


# ------------------------------------------------------------------------------------- aggregations


@query
def distinct_dim(spark, sf_dir):
    return M.dimension(lines_of_documents(spark, sf_dir), LINES)


@query
def page_min_date(spark, sf_dir):
    return G.page_min_date(event_pages(spark, sf_dir), "day")


@query
def row_counts(spark, sf_dir):
    names = ("documents", "events", "lineitem", "orders", "pages", "conversations", "labels")
    return R.row_counts({n: table(spark, sf_dir, n) for n in names})


@query
def max_loaded_at(spark, sf_dir):
    return Q.max_loaded_at(table(spark, sf_dir, "events").select(day_of("ts").alias("day")), "day")


@query
def footer_stats(spark, sf_dir):
    """Counts and bounds of whole tables from their footers."""
    wanted = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "user_id", "documents": "n_chars", "conversations": "turn"}
    found = K.footer_stats(spark, {t: f"{sf_dir}/{t}.parquet" for t in wanted}, {t: [c] for t, c in wanted.items()})
    rows = [(t, *found[t].first()) for t in wanted]  # one row a table
    return spark.createDataFrame(rows, "name string, n bigint, low bigint, high bigint")


@query
def group_having(spark, sf_dir):
    return Q.group_having(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


# ----------------------------------------------------------------------------------- set operations


@query
def union_pages(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    kinds = ("signup", "error", "click", "view", "purchase")
    return P.union_pages([events.where(F.col("event_type") == k) for k in kinds])


@query
def union_details(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_nationkey AS nation", "s_name AS name")
    return P.union_details([customers, suppliers])


# ---------------------------------------------------------------------------------- scalar functions


@query
def md5_key(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.md5_key(F.col("text")).alias("text_id"))


@query
def split_lines(spark, sf_dir):
    return lines_of_documents(spark, sf_dir).select(
        "doc_id", F.size("lines").cast("bigint").alias("n"), F.array_join("lines", "|").alias("lines")
    )


@query
def regex_int(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", S.regex_int(F.col("p_brand")).alias("brand"),
        S.regex_int(F.col("p_type")).alias("none"),
    )


@query
def regex_days_per_week(spark, sf_dir):
    return listing_lake(spark, sf_dir).select(
        "detail_link", S.days_per_week(F.col("number_of_days_worked")).alias("days")
    )


@query
def trim_text(spark, sf_dir):
    padded = F.concat(F.lit("　 \t\n"), F.col("text"), F.lit(" \n　"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", S.trim_text(padded).alias("text")
    )


@query
def strip_prefix(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", S.strip_prefix(F.col("c_name"), len("Customer#")).alias("number")
    )


@query
def resolve_url(spark, sf_dir):
    pages = P.extract_links(table(spark, sf_dir, "pages"), Selector(tag="li"))
    links = J.unnest(pages, "links", "link", keep=["page_id", "url"], pos="pos")
    return links.select(
        "page_id", "pos", S.resolve_url(F.col("url"), F.col("link")).alias("absolute"),
        S.resolve_url(F.col("url"), F.col("url")).alias("unchanged"),
    )


@query
def jst_today(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.jst_date(F.col("ts")).alias("today"))


@query
def jst_yesterday(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", S.jst_yesterday(F.col("ts")).alias("yesterday")
    )


@query
def date_to_partition(spark, sf_dir):
    days = S.date_to_partition(day_of("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", days.alias("partition_date"))


@query
def base64_json(spark, sf_dir):
    encoded = F.base64(F.encode(F.col("props"), "UTF-8"))
    return table(spark, sf_dir, "events").select(
        "event_id", S.base64_json(encoded, "k").alias("k"),
        S.base64_json(F.col("props"), "k").alias("none"),
    )


@query
def ledger_json(spark, sf_dir):
    metadata = F.create_map(F.lit("type"), F.col("event_type"), F.lit("props"), F.col("props"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        "event_id", S.ledger_json(F.col("event_id").cast("string"), stamp, metadata).alias("body")
    )


@query
def dim_date_query(spark, sf_dir):
    per_day = _orders(spark, sf_dir).groupBy("order_day").agg(F.count(F.lit(1)).alias("n_orders"))
    calendar = dim_date_spanning(_orders(spark, sf_dir), "order_day")
    joined = calendar.join(per_day, F.col("date_day") == F.col("order_day"), "left")
    return joined.drop("order_day")


QUERIES["dim_date"] = QUERIES.pop("dim_date_query")


# ------------------------------------------------------------------------------------------ reports


@query
def bi_job_analysis(spark, sf_dir):
    stg = W.staging(listing_lake(spark, sf_dir))
    return W.bi_job_analysis(W.fct_jobs(stg), W.dim_job_details(stg), dim_date(spark))


@query
def bi_job_analysis_fused(spark, sf_dir):
    return W.bi_job_analysis_fused(W.staging(listing_lake(spark, sf_dir)), dim_date(spark))


@query
def bi_order_analysis(spark, sf_dir):
    """The wide report over the sales tables, whose fact is not unique by the joined key."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice", "order_day")
    calendar = dim_date(spark, *ORDER_DAYS).select(
        "date_day", *[F.col(c).alias(n) for n, c in W.REPORT_CALENDAR.items()]
    )
    days = (ORDER_DAYS[1] - ORDER_DAYS[0]).days
    dated = W.join_fact_date(orders, calendar, "order_day", days).drop("date_day")
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return W.join_fact_details(dated, customers, "o_custkey", hot=None)


@query
def bi_job_analysis_detail(spark, sf_dir):
    return W.bi_job_analysis_detail(W.staging(listing_lake(spark, sf_dir)), dim_date(spark))


@query
def bi_job_analysis_detail_star(spark, sf_dir):
    return W.bi_job_analysis_detail(W.staging(listing_lake(spark, sf_dir)), dim_date(spark), "star")


@query
def bi_job_analysis_detail_bucketed(spark, sf_dir):
    """The star over published tables that are bucketed by the job key."""
    path = work_dir(spark, "star")
    star = W.publish_star(spark, listing_lake(spark, sf_dir), path, path.rsplit("-", 1)[1])
    return W.star_detail(star)


# -------------------------------------------------------------------------------------- data quality


@query
def dq_unique(spark, sf_dir):
    return Q.dq_unique(table(spark, sf_dir, "documents"), "text")


@query
def dq_not_null(spark, sf_dir):
    lake = listing_lake(spark, sf_dir)
    return Q.dq_not_null(lake, lake.columns)


@query
def dq_relationships(spark, sf_dir):
    events, labels = table(spark, sf_dir, "events"), table(spark, sf_dir, "labels")
    return Q.dq_relationships(events, "user_id", labels, "doc_id")


@query
def dq_unique_combination(spark, sf_dir):
    stg = W.staging(listing_lake(spark, sf_dir))
    return Q.dq_unique_combination(W.bridge_attribute(stg, "language"), ["job_id", "lang_id"])


@query
def dq_freshness(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(day_of("ts").alias("day"))
    return Q.dq_freshness(events, "day", AS_OF)


@query
def dq_results_sink(spark, sf_dir):
    root = work_dir(spark, "warehouse")
    lake = listing_lake(spark, sf_dir)
    results = W.check_warehouse(lake, W.publish_models(spark, lake, root, "run-1"), CHECKED_ON)
    Q.append_results(results, f"{root}/results", "run-1", PROCESSED_AT)
    return spark.read.parquet(f"{root}/results").drop("checked_at")


# --------------------------------------------------------------------------- streaming, run accounting


@query
def stream_file_ingest_query(spark, sf_dir):
    root = work_dir(spark, "stream")
    lake = K.LakeTable(spark, f"{root}/lake")
    current, changes = listing_lake(spark, sf_dir), _changes(spark, sf_dir)
    for day, rows in ((date(2024, 2, 1), current), (date(2024, 2, 2), changes)):
        C.save_day(rows, f"{root}/raw", day)
        stream_file_ingest(spark, f"{root}/raw", lake, f"{root}/checkpoint").awaitTermination()
    return lake.read()


def _poisoned_files(spark, sf_dir, root, swapped: bool = True) -> None:
    """Day files of the listings, with what goes wrong in practice.

    English listings have a salary that is no number, listings of documents without a label no link, and
    the French ones come twice; the Spanish ones lie in a file with two columns of its header swapped.
    """
    labelled = _labelled_links(spark, sf_dir)
    lake = listing_lake(spark, sf_dir)
    linked = lake.join(labelled.withColumn("kept", F.lit(True)), "detail_link", "left")
    linked = linked.withColumns({
        "detail_link": F.when(F.col("kept") | (F.col("occupation") != "de"), F.col("detail_link")),
        "monthly_salary": F.when(F.col("occupation") == "en", "n/a").otherwise(F.col("monthly_salary").cast("string")),
    }).select(*lake.columns)
    C.save_day(linked.where("occupation <> 'es'"), root, AS_OF)
    again = linked.where("occupation = 'fr'").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    C.save_day(again, root, CHECKED_ON)
    if swapped:
        C.save_day(lake.where("occupation = 'es'").select("occupation", "monthly_salary", *lake.columns[2:]), root, SINCE)


@query
def stream_rejects(spark, sf_dir):
    """Rejected and loaded records of a stream over poisoned files."""
    root = work_dir(spark, "poisoned")
    lake = K.LakeTable(spark, f"{root}/lake")
    _poisoned_files(spark, sf_dir, f"{root}/raw")
    stream_file_ingest(spark, f"{root}/raw", lake, f"{root}/checkpoint").awaitTermination()
    bad = spark.read.parquet(f"{root}/lake-rejects").where("record NOT LIKE 'occupation,monthly_salary,%'")  # headers, one a file
    bad = bad.groupBy("reason").agg(F.sum("copies").alias("n"))
    loaded = lake.read().agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("n"))
    return loaded.unionByName(bad)


@query
def stream_run_records(spark, sf_dir):
    """What each batch read, loaded and rejected, from the records that a listener wrote."""
    root = work_dir(spark, "recorded")
    lake = K.LakeTable(spark, f"{root}/lake")
    C.save_day(listing_lake(spark, sf_dir), f"{root}/raw", SINCE)
    ingest_and_record(spark, f"{root}/raw", lake, f"{root}/checkpoint", f"{root}/runs")
    _poisoned_files(spark, sf_dir, f"{root}/raw", swapped=False)
    ingest_and_record(spark, f"{root}/raw", lake, f"{root}/checkpoint", f"{root}/runs")
    stored = spark.read.parquet(f"{root}/runs")
    return stored.select("status", "loaded_rows", "rejected_rows", (F.col("loaded_rows") + F.col("rejected_rows")).alias("records"))


@query
def stream_message_gate_query(spark, sf_dir):
    root = work_dir(spark, "gate")
    trigger_messages(spark, sf_dir).select("body").write.parquet(f"{root}/inbox")
    for _ in range(2):  # a second consumer gets every message again
        inbox = spark.readStream.schema("body string").parquet(f"{root}/inbox")
        checkpoint = work_dir(spark, "gate-checkpoint")
        stream_message_gate(
            inbox, f"{root}/ledger", checkpoint, lambda fresh, i: {"record_count": fresh.count()}
        ).awaitTermination()
    return L.read_ledger(spark, f"{root}/ledger").select("message_id")


for _name in ("stream_file_ingest", "stream_message_gate"):
    QUERIES[_name] = QUERIES.pop(f"{_name}_query")


@query
def ledger_append(spark, sf_dir):
    path = work_dir(spark, "ledger")
    valid = envelope_filter(trigger_messages(spark, sf_dir))
    L.append_ledger(L.ledger_rows(valid, PROCESSED_AT, {"saved_path": "raw/jobs"}), path)
    stored = L.read_ledger(spark, path)
    return stored.select("message_id", F.col("metadata")["saved_path"].alias("saved_path"))


@query
def ledger_compact(spark, sf_dir):
    """Messages marked in several runs of each day; each id once after compaction, with its latest entry."""
    path = work_dir(spark, "ledger")
    events = table(spark, sf_dir, "events")
    for kinds in (("click", "view"), ("view", "purchase"), ("error",)):
        marked = events.where(F.col("event_type").isin(*kinds)).groupBy(day_of("ts").alias("day"), F.col("user_id").cast("string").alias("message_id")).agg(
            F.max("ts").cast("timestamp").alias("processed_at"))
        L.append_ledger(marked.withColumn("metadata", F.create_map(F.lit("kinds"), F.lit("+".join(kinds)))), path)
    L.compact_ledger(spark, path)
    return L.read_ledger(spark, path).select("message_id", F.col("processed_at").cast("timestamp_ntz").alias("processed_at"), F.col("metadata")["kinds"].alias("kinds"))


@query
def backfill_gaps(spark, sf_dir):
    """Islands of days without a finished order: a day's run succeeded if one of its orders is finished."""
    done = _orders(spark, sf_dir).where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    return R.gaps(done, "order_day", *ORDER_DAYS)


@query
def daily_backfill_window(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("value", S.jst_date(F.col("ts")).alias("day"))
    runs = G.assign_runs(events, "day")
    return runs.groupBy("run_date").agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )


@query
def run_record(spark, sf_dir):
    root = work_dir(spark, "runs")
    lake = K.LakeTable(spark, f"{root}/lake")
    path, _ = C.save_day(listing_lake(spark, sf_dir), f"{root}/raw", AS_OF)
    for run_id, day in (("loaded", AS_OF), ("absent", SINCE)):
        out = daily.load_day(spark, f"{root}/raw", lake, day)
        R.append_run(R.run_record(spark, run_id, limit_date=day, **out), f"{root}/runs")
    stored = spark.read.parquet(f"{root}/runs")
    return stored.select("run_id", "status", "loaded_rows", "limit_date")


@query
def collect_day(spark, sf_dir):
    """The whole collection: list pages, cut-off, detail pages, day file."""
    root = work_dir(spark, "collected")
    lists = list_pages(spark, sf_dir, newest_first=True)
    out = daily.collect_day(lists, detail_pages(spark, sf_dir), root, date(2025, 12, 16))
    return C.read_csv_typed(spark, out["saved_path"])


@query
def collect_rejects(spark, sf_dir):
    """Listings without date, link or detail page, and pages without text, stored with their reason; all
    others are kept. Every fifth page lost its text; only labelled documents have a detail page."""
    root = work_dir(spark, "collected")
    lists = list_pages(spark, sf_dir, damaged=True)
    lists = lists.withColumn("html", F.when(F.col("page") % 5 != 0, F.col("html")))
    details = detail_pages(spark, sf_dir).join(_labelled_links(spark, sf_dir), "detail_link", "left_semi")
    out = daily.collect_day(lists, details, root, date(2025, 11, 16))
    kept = C.read_csv_typed(spark, out["saved_path"]).select("detail_link", F.lit("kept").alias("outcome"))
    return kept.unionByName(spark.read.parquet(out["rejects_path"]).select("detail_link", F.col("reject").alias("outcome")))


def run(name: str) -> Query:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return QUERIES[name](tune(spark), sf_dir)

    return call
