"""The same queries as DuckDB SQL over the given tables."""

from __future__ import annotations

from listlake.plans.warehouse import ATTRIBUTES, declared_suite
from listlake.schemas import LAKE

NL = "chr(10)"

LAKE_CTE = f"""lake AS (
  SELECT n_chars AS monthly_salary, lang AS occupation, source AS work_type,
         lang || '-' || source AS work_location, source AS industry,
         source || ' & ' || lang AS job_content, lang || {NL} || source AS required_skills,
         CASE WHEN n_chars % 3 = 0 THEN NULL ELSE source END AS preferred_skills,
         text AS programming_language, lang || {NL} || source AS tool,
         CASE n_chars % 4 WHEN 0 THEN NULL WHEN 1 THEN source || {NL} || source
              WHEN 2 THEN lang || {NL} || {NL} || source ELSE lang END AS framework,
         (n_chars % 101) || '%' AS rate_of_work,
         CASE WHEN n_chars % 5 = 0 THEN '応相談'
              ELSE (n_chars % 5) || '回（予定' || (n_chars % 7) || '）' END
           AS number_of_recruitment_interviews,
         CASE WHEN n_chars % 6 = 0 THEN '週3〜5日' ELSE '週' || (n_chars % 6) || '日' END
           AS number_of_days_worked,
         CASE WHEN n_chars % 9 = 0 THEN NULL ELSE (n_chars % 30) || '名' END
           AS number_of_applicants,
         source || ' ' || lang || ' ' || doc_id AS job_title,
         DATE '2025-11-15' + CAST(n_chars % 60 AS INTEGER) AS listing_start_date,
         '/jobs/' || doc_id AS detail_link
  FROM documents)"""

STG_CTE = f"""stg AS (
  SELECT detail_link, listing_start_date, monthly_salary, occupation, work_type, work_location,
         industry, job_content, required_skills, preferred_skills, rate_of_work, job_title,
         md5(detail_link) AS job_id,
         string_split(programming_language, {NL}) AS programming_language,
         string_split(tool, {NL}) AS tool, string_split(framework, {NL}) AS framework,
         TRY_CAST(regexp_extract(number_of_recruitment_interviews, '([0-9]+)', 1) AS BIGINT)
           AS number_of_recruitment_interviews,
         TRY_CAST(regexp_extract(number_of_days_worked, '週([0-9]+)日', 1) AS BIGINT)
           AS number_of_days_worked,
         TRY_CAST(regexp_extract(number_of_applicants, '([0-9]+)', 1) AS BIGINT)
           AS number_of_applicants
  FROM lake)"""

WITH_LAKE = f"WITH {LAKE_CTE} "
WITH_STG = f"WITH {LAKE_CTE}, {STG_CTE} "

DETAILS = (
    "job_title, detail_link, occupation, work_type, work_location, industry, job_content, "
    "required_skills, preferred_skills"
)
MEASURES = (
    "monthly_salary, number_of_recruitment_interviews, number_of_days_worked, number_of_applicants"
)


def calendar(day: str, first: str, last: str) -> str:
    """Report calendar columns, NULL outside the calendar."""
    inside = f"{day} BETWEEN DATE '{first}' AND DATE '{last}'"

    def column(expression: str, name: str) -> str:
        return f"CASE WHEN {inside} THEN {expression} END AS {name}"

    return ", ".join(
        [
            column(f"strftime({day}, '%a')", "listing_day_of_week"),
            column(f"{day} - CAST(dayofweek({day}) AS INTEGER)", "listing_week"),
            column(f"CAST(date_trunc('month', {day}) AS DATE)", "listing_month"),
            column(f"CAST(date_trunc('quarter', {day}) AS DATE)", "listing_quarter"),
            column(f"CAST(date_trunc('year', {day}) AS DATE)", "listing_year"),
        ]
    )


JOB_CALENDAR = calendar("listing_start_date", "2024-10-01", "2025-12-30")
REPORT = (
    f"SELECT job_id, {MEASURES}, {DETAILS}, listing_start_date, {JOB_CALENDAR} FROM stg"
)
PRODUCT_CTE = """product AS (
  SELECT *, unnest(coalesce(framework, [NULL])) AS fw FROM (
    SELECT *, unnest(coalesce(tool, [NULL])) AS tl FROM (
      SELECT *, unnest(coalesce(programming_language, [NULL])) AS lg FROM stg)))"""
REPORT_DETAIL = (
    f"SELECT job_id, md5(lg) AS lang_id, md5(tl) AS tool_id, md5(fw) AS framework_id, {MEASURES}, "
    f"{DETAILS}, lg AS lang, tl AS tool, fw AS framework, listing_start_date, {JOB_CALENDAR} "
    "FROM product"
)
FACT = f"SELECT job_id, listing_start_date, {MEASURES} FROM stg"

LINES_CTE = f"lines AS (SELECT doc_id, unnest(string_split(text, {NL})) AS line FROM documents)"

EVENT_PAGES_CTE = """ranked AS (
  SELECT event_id, CAST(ts AS DATE) AS day,
         (row_number() OVER (ORDER BY ts DESC, event_id) - 1) // 50 + 1 AS page FROM events)"""

MESSAGES_CTE = """valid AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS message_id FROM events
  WHERE event_type IN ('click', 'view'))"""

CHANGES_CTE = """changes AS (
  SELECT * REPLACE (monthly_salary + 1 AS monthly_salary,
                    listing_start_date + 7 AS listing_start_date)
  FROM lake WHERE occupation = 'fr'
  UNION ALL BY NAME
  SELECT '/jobs/new/' || item_id AS detail_link, text AS programming_language,
         DATE '2024-12-01' AS listing_start_date FROM benchmark)"""
#: What becomes of each record of the poisoned files: the main one, the French one (every row twice), the Spanish one.
POISONED_CTE = """sorted AS (
  SELECT lang = 'en' AS en, lang = 'fr' AS fr, lang = 'es' AS es, lang <> 'de' OR doc_id IN (SELECT doc_id FROM labels) AS k FROM documents),
outcomes AS (
  SELECT CASE WHEN es THEN 'wrong header' WHEN en THEN 'unreadable record' WHEN NOT k THEN 'no detail_link' ELSE 'loaded' END AS reason, 1 AS n FROM sorted
  UNION ALL SELECT 'repeated detail_link', 1 FROM sorted WHERE fr)"""

MERGED = (
    f"WITH {LAKE_CTE}, {CHANGES_CTE} "
    "SELECT * FROM lake WHERE detail_link NOT IN (SELECT detail_link FROM changes) "
    "UNION ALL BY NAME SELECT * FROM changes"
)

PARTITION = "CAST(strftime(listing_start_date, '%Y%m%d') AS INTEGER) AS partition_date"
LIST_ROWS = (
    "SELECT doc_id // 20 + 1 AS page, source || ' & ' || lang AS job_title, "
    "DATE '2025-11-15' + CAST(n_chars % 60 AS INTEGER) AS listing_start_date, "
    "'/jobs/' || doc_id AS detail_link FROM documents"
)
DETAIL_COLUMNS = ", ".join(
    f"regexp_replace({c}, '^[\\s　]+|[\\s　]+$', '', 'g') AS {c}"
    if c == "programming_language" else c
    for c in LAKE.names[:15]
)


def entities(text: str) -> str:
    """HTML allows these entities without their semicolon, as where a text was cut."""
    for entity, char in (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&amp;?", "&")):
        text = f"regexp_replace({text}, '{entity}', '{char}', 'g')"
    return text


def checks_sql() -> str:
    """Failures of every declared test, in the form of the results table."""
    ctes = [LAKE_CTE, STG_CTE, PRODUCT_CTE]
    ctes += [
        "lake__joblist AS (SELECT * FROM lake)",
        "stg_joblist AS (SELECT * FROM stg)",
        f"fct_jobs AS ({FACT})",
        f"dim_job_details AS (SELECT job_id, {DETAILS} FROM stg)",
        f"bi__job_analysis AS ({REPORT})",
        f"bi__job_analysis_detail AS ({REPORT_DETAIL})",
    ]
    for name, a in ATTRIBUTES.items():
        ctes.append(f"elements_{name} AS (SELECT job_id, unnest({a.array}) AS v FROM stg)")
        ctes.append(
            f"dim_{name} AS (SELECT DISTINCT md5(v) AS {a.id}, v AS {a.value} FROM elements_{name})"
        )
        ctes.append(f"bridge_{name} AS (SELECT job_id, md5(v) AS {a.id} FROM elements_{name})")
    selects = []
    for c in declared_suite().checks:
        columns = ", ".join(c.columns)
        if c.kind == "freshness":
            selects.append(
                f"SELECT 'freshness' AS check_type, '{c.table}' AS table_name, '{c.label}' AS column_names, "
                f"CAST(s <> 'pass' AS BIGINT) AS failures, s AS status FROM (SELECT CASE "
                f"WHEN max({columns}) IS NULL OR max({columns}) + {c.error_days} < DATE '2026-01-16' THEN 'error' "
                f"WHEN max({columns}) + {c.warn_days} < DATE '2026-01-16' THEN 'warn' ELSE 'pass' END AS s FROM {c.table})"
            )
            continue
        if c.kind == "not_null":
            failing = f"SELECT 1 FROM {c.table} WHERE {columns} IS NULL"
        elif c.kind == "relationships":
            failing = (
                f"SELECT 1 FROM {c.table} x WHERE {columns} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {c.parent} p WHERE p.{c.parent_key} = x.{columns})"
            )
        else:
            where = f"WHERE {columns} IS NOT NULL" if c.kind == "unique" else ""
            failing = f"SELECT 1 FROM {c.table} {where} GROUP BY {columns} HAVING count(*) > 1"
        selects.append(
            f"SELECT '{c.kind}' AS check_type, '{c.table}' AS table_name, "
            f"'{c.label}' AS column_names, count(*) AS failures, "
            f"CASE WHEN count(*) > 0 THEN 'fail' ELSE 'pass' END AS status FROM ({failing})"
        )
    return (
        "WITH " + ", ".join(ctes) + " SELECT 'run-1' AS run_id, * FROM ("
        + " UNION ALL ".join(selects) + ")"
    )


CALENDAR_SQL = """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS order_day FROM orders),
per_day AS (SELECT order_day, count(*) AS n_orders FROM o GROUP BY order_day),
days AS (SELECT CAST(unnest(generate_series(min(order_day), max(order_day), INTERVAL 1 DAY)) AS DATE) AS d
         FROM o),
base AS (SELECT d, d - 364 AS p, CAST(d - INTERVAL 1 YEAR AS DATE) AS y FROM days)
SELECT d AS date_day, d - 1 AS prior_date_day, d + 1 AS next_date_day, y AS prior_year_date_day,
  p AS prior_year_over_year_date_day,
  dayofweek(d) + 1 AS day_of_week, isodow(d) AS day_of_week_iso,
  strftime(d, '%A') AS day_of_week_name, strftime(d, '%a') AS day_of_week_name_short,
  day(d) AS day_of_month, dayofyear(d) AS day_of_year,
  d - CAST(dayofweek(d) AS INTEGER) AS week_start_date,
  d - CAST(dayofweek(d) AS INTEGER) + 6 AS week_end_date,
  p - CAST(dayofweek(p) AS INTEGER) AS prior_year_week_start_date,
  p - CAST(dayofweek(p) AS INTEGER) + 6 AS prior_year_week_end_date,
  CAST(strftime(d, '%U') AS BIGINT) AS week_of_year,
  CAST(strftime(p, '%U') AS BIGINT) AS prior_year_week_of_year,
  CAST(date_trunc('week', d) AS DATE) AS iso_week_start_date,
  CAST(date_trunc('week', d) AS DATE) + 6 AS iso_week_end_date,
  CAST(date_trunc('week', p) AS DATE) AS prior_year_iso_week_start_date,
  CAST(date_trunc('week', p) AS DATE) + 6 AS prior_year_iso_week_end_date,
  weekofyear(d) AS iso_week_of_year, weekofyear(p) AS prior_year_iso_week_of_year,
  month(d) AS month_of_year, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_name_short,
  CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
  CAST(date_trunc('month', y) AS DATE) AS prior_year_month_start_date,
  last_day(y) AS prior_year_month_end_date,
  quarter(d) AS quarter_of_year, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
  CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
  year(d) AS year_number, CAST(date_trunc('year', d) AS DATE) AS year_start_date,
  CAST(date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end_date,
  n_orders
FROM base LEFT JOIN per_day ON d = order_day
"""

LINK_ROWS = """
SELECT page_id, url, generate_subscripts(links, 1) - 1 AS pos, unnest(links) AS link
FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS links FROM pages)
"""

ORDERS = "SELECT * EXCLUDE (o_orderdate), CAST(o_orderdate AS DATE) AS order_day FROM orders"
IN_ORDER_DAYS = "order_day BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"
JST = "CAST(ts + INTERVAL 9 HOUR AS DATE)"

ORACLE: dict[str, str] = {
    # scans, sources, sinks
    "scan_csv_typed": WITH_LAKE + "SELECT * FROM lake",
    "scan_partition_date": WITH_LAKE
    + f"SELECT {PARTITION}, detail_link, programming_language FROM lake "
    "WHERE listing_start_date = (SELECT max(listing_start_date) FROM lake)",
    "scan_file_gate": WITH_LAKE + f"SELECT {PARTITION}, detail_link, monthly_salary FROM lake",
    "scan_lake": WITH_LAKE + "SELECT * FROM lake",
    "sink_daily_csv": WITH_LAKE
    + f"SELECT {PARTITION}, detail_link, job_title, programming_language FROM lake",
    "sink_lake_partitioned": WITH_LAKE
    + "SELECT listing_start_date, count(*) AS n, CAST(sum(monthly_salary) AS BIGINT) AS salary "
    "FROM lake GROUP BY listing_start_date",
    "materialize_model": WITH_STG + REPORT,
    # page parsing
    "parse_list_page": LIST_ROWS,
    "extract_titles": "SELECT page_id, CAST(0 AS BIGINT) AS pos, trim("
    + entities("regexp_extract(html, '<title>(.*?)</title>', 1)") + ") AS title FROM pages",
    "extract_dates": "SELECT doc_id // 20 + 1 AS page, "
    "row_number() OVER (PARTITION BY doc_id // 20 ORDER BY doc_id) - 1 AS pos, "
    "strftime(DATE '2025-11-15' + CAST(n_chars % 60 AS INTEGER), '%Y年%-m月%-d日') AS date_text "
    "FROM documents",
    "extract_links": f"SELECT page_id, pos, link FROM ({LINK_ROWS})",
    "parse_detail_page": WITH_LAKE + f"SELECT detail_link, {DETAIL_COLUMNS} FROM lake",
    "positional_fields": "SELECT page_id, "
    + ", ".join(f"trim({entities(f'items[{i + 1}]')}) AS item_{i}" for i in range(5))
    + " FROM (SELECT page_id, regexp_extract_all("
    "regexp_extract(html, '<nav><ul>(.*?)</ul>', 1), '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1) "
    "AS items FROM pages)",
    "label_value_pivot": "SELECT conv_id, "
    + ", ".join(
        f"arg_min(text, turn) FILTER (WHERE role = '{r}') AS first_{r}"
        for r in ("system", "user", "assistant")
    )
    + " FROM conversations WHERE role IN ('system', 'user', 'assistant') GROUP BY conv_id",
    "digits_to_int": "SELECT event_id, TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS BIGINT) "
    "AS k, CAST(NULL AS BIGINT) AS none FROM events",
    "parse_jp_date": "SELECT event_id, CAST(ts AS DATE) AS day, CAST(NULL AS DATE) AS none FROM events",
    "html_tokens_udf": "SELECT page_id, generate_subscripts(hrefs, 1) - 1 AS pos, "
    f"unnest(hrefs) AS href, {entities('unnest(texts)')} AS text FROM (SELECT page_id, "
    "regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 1) AS hrefs, "
    "regexp_extract_all(html, '<a href=\"([^\"]*)\">([^<]*)</a>', 2) AS texts FROM pages)",
    # projections, filters, predicates
    "project_staging": WITH_STG
    + "SELECT * REPLACE (array_to_string(programming_language, '|') AS programming_language, "
    "array_to_string(tool, '|') AS tool, array_to_string(framework, '|') AS framework) FROM stg",
    "project_fact": WITH_STG + FACT,
    "project_details": WITH_STG + f"SELECT job_id, {DETAILS} FROM stg",
    "filter_since": "SELECT event_id, user_id, event_type, value FROM events "
    "WHERE ts >= TIMESTAMP '2024-01-15'",
    "page_cutoff": f"WITH {EVENT_PAGES_CTE} SELECT event_id, day, page FROM ranked "
    "WHERE day >= DATE '2024-01-26' AND page <= coalesce("
    "(SELECT min(page) FROM ranked WHERE day < DATE '2024-01-26'), (SELECT max(page) FROM ranked))",
    "page_cutoff_numbered": f"WITH {EVENT_PAGES_CTE} SELECT event_id, day, page FROM ranked "
    "WHERE day >= DATE '2024-01-26' AND page <= coalesce("
    "(SELECT min(page) FROM ranked WHERE day < DATE '2024-01-26'), (SELECT max(page) FROM ranked))",
    "envelope_filter": f"WITH {MESSAGES_CTE} SELECT event_id, message_id FROM valid",
    "latest_first_pages": f"WITH {EVENT_PAGES_CTE} SELECT event_id, day, page FROM ranked",
    # joins
    "join_fact_details": f"SELECT o.*, c.* EXCLUDE (c_custkey) FROM ({ORDERS}) o "
    "LEFT JOIN customer c ON o.o_custkey = c.c_custkey",
    "join_fact_date": "SELECT *, "
    f"CASE WHEN {IN_ORDER_DAYS} THEN order_day END AS date_day, "
    f"CASE WHEN {IN_ORDER_DAYS} THEN strftime(order_day, '%a') END AS day_of_week_name_short, "
    f"CASE WHEN {IN_ORDER_DAYS} THEN order_day - CAST(dayofweek(order_day) AS INTEGER) END "
    "AS week_start_date, "
    f"CASE WHEN {IN_ORDER_DAYS} THEN CAST(date_trunc('month', order_day) AS DATE) END "
    f"AS month_start_date FROM ({ORDERS})",
    "join_bridge_dim": f"WITH {LINES_CTE} SELECT doc_id, md5(line) AS line_id, line FROM lines",
    "join_fact_multivalue": f"WITH {LAKE_CTE}, {STG_CTE}, {PRODUCT_CTE} "
    f"SELECT job_id, listing_start_date, {MEASURES}, md5(lg) AS lang_id, md5(tl) AS tool_id, "
    "md5(fw) AS framework_id FROM product",
    "unnest_lateral": f"WITH {LINES_CTE} SELECT doc_id, line FROM lines",
    "attach_list_to_detail": WITH_LAKE
    + f"SELECT l.detail_link, d.* EXCLUDE (detail_link), l.job_title, l.listing_start_date FROM ({LIST_ROWS}) l "
    f"LEFT JOIN (SELECT detail_link, {DETAIL_COLUMNS} FROM lake WHERE detail_link IN (SELECT '/jobs/' || doc_id FROM labels)) d USING (detail_link)",
    "anti_join_ledger": f"WITH {MESSAGES_CTE} SELECT event_id, message_id FROM valid "
    "WHERE message_id NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'error' AND value > 100)",
    # upsert
    "upsert_merge": MERGED,
    "upsert_rows": MERGED,
    "dedupe_source": "SELECT arg_max(doc_id, doc_id) AS doc_id, text, arg_max(lang, doc_id) AS lang, "
    "arg_max(source, doc_id) AS source, arg_max(n_chars, doc_id) AS n_chars "
    "FROM documents GROUP BY text",
    # aggregations
    "distinct_dim": f"WITH {LINES_CTE} SELECT DISTINCT md5(line) AS line_id, line FROM lines",
    "page_min_date": f"WITH {EVENT_PAGES_CTE} SELECT page, min(day) AS min_date FROM ranked "
    "GROUP BY page",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS n FROM {t}"
        for t in ("documents", "events", "lineitem", "orders", "pages", "conversations", "labels")
    ),
    "max_loaded_at": "SELECT CAST(max(ts) AS DATE) AS max_loaded_at FROM events",
    "group_having": "SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem "
    "GROUP BY l_partkey, l_suppkey HAVING count(*) > 1",
    # set operations
    "union_pages": "SELECT event_id, event_type, value FROM events",
    "union_details": "SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment "
    "FROM customer UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier",
    # scalar functions
    "md5_key": "SELECT doc_id, md5(text) AS text_id FROM documents",
    "split_lines": f"SELECT doc_id, len(string_split(text, {NL})) AS n, "
    f"array_to_string(string_split(text, {NL}), '|') AS lines FROM documents",
    "regex_int": "SELECT p_partkey, TRY_CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) "
    "AS brand, TRY_CAST(regexp_extract(p_type, '([0-9]+)', 1) AS BIGINT) AS none FROM part",
    "regex_days_per_week": WITH_STG + "SELECT detail_link, number_of_days_worked AS days FROM stg",
    "trim_text": "SELECT conv_id, turn, regexp_replace(text, '^[\\s　]+|[\\s　]+$', '', 'g') "
    "AS text FROM conversations",
    "strip_prefix": "SELECT c_custkey, substr(c_name, 10) AS number FROM customer",
    "resolve_url": "SELECT page_id, pos, regexp_extract(url, '^(https?://[^/?#]+)', 1) || link "
    f"AS absolute, url AS unchanged FROM ({LINK_ROWS})",
    "jst_today": f"SELECT event_id, {JST} AS today FROM events",
    "jst_yesterday": f"SELECT event_id, {JST} - 1 AS yesterday FROM events",
    "date_to_partition": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS partition_date "
    "FROM orders",
    "base64_json": "SELECT event_id, json_extract_string(props, '$.k') AS k, "
    "CAST(NULL AS VARCHAR) AS none FROM events",
    "ledger_json": "SELECT event_id, '{\"message_id\":\"' || event_id || '\",\"processed_at\":\"' "
    "|| strftime(ts, '%Y-%m-%dT%H:%M:%S') || '\",\"metadata\":{\"type\":\"' || event_type "
    "|| '\",\"props\":\"' || replace(props, '\"', '\\\"') || '\"}}' AS body FROM events",
    "dim_date": CALENDAR_SQL,
    # reports
    "bi_job_analysis": WITH_STG + REPORT,
    "bi_job_analysis_fused": WITH_STG + REPORT,
    "bi_order_analysis": "SELECT o_orderkey, o_custkey, o_totalprice, order_day, "
    + calendar("order_day", "1996-01-01", "2000-12-31")
    + f", c_name, c_nationkey, c_acctbal, c_mktsegment FROM ({ORDERS}) o "
    "LEFT JOIN customer c ON o.o_custkey = c.c_custkey",
    "bi_job_analysis_detail": f"WITH {LAKE_CTE}, {STG_CTE}, {PRODUCT_CTE} {REPORT_DETAIL}",
    "bi_job_analysis_detail_star": f"WITH {LAKE_CTE}, {STG_CTE}, {PRODUCT_CTE} {REPORT_DETAIL}",
    "bi_job_analysis_detail_bucketed": f"WITH {LAKE_CTE}, {STG_CTE}, {PRODUCT_CTE} {REPORT_DETAIL}",
    # data quality
    "dq_unique": "SELECT text, count(*) AS n FROM documents WHERE text IS NOT NULL "
    "GROUP BY text HAVING count(*) > 1",
    "dq_not_null": WITH_LAKE
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM lake"
        for c in LAKE.names
    ),
    "dq_relationships": "SELECT user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = user_id) GROUP BY user_id",
    "dq_unique_combination": f"WITH {LINES_CTE} SELECT md5('/jobs/' || doc_id) AS job_id, "
    "md5(line) AS lang_id, count(*) AS n FROM lines GROUP BY ALL HAVING count(*) > 1",
    "dq_freshness": "SELECT m AS max_loaded_at, CASE WHEN m + 4 < DATE '2024-02-02' THEN 'error' "
    "WHEN m + 2 < DATE '2024-02-02' THEN 'warn' ELSE 'pass' END AS status "
    "FROM (SELECT CAST(max(ts) AS DATE) AS m FROM events)",
    "dq_results_sink": checks_sql(),
    "footer_stats": " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS n, min({c}) AS low, max({c}) AS high FROM {t}"
        for t, c in (("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("events", "user_id"), ("documents", "n_chars"), ("conversations", "turn"))
    ),
    # streaming, run accounting
    "stream_file_ingest": MERGED,
    "stream_message_gate": f"WITH {MESSAGES_CTE} SELECT DISTINCT message_id FROM valid",
    "ledger_append": f"WITH {MESSAGES_CTE} SELECT DISTINCT message_id, 'raw/jobs' AS saved_path "
    "FROM valid",
    "daily_backfill_window": f"WITH e AS (SELECT {JST} AS day FROM events), "
    "r AS (SELECT day, unnest([day, day + 1]) AS run_date FROM e) "
    "SELECT run_date, count(*) AS n, min(day) AS first_day, max(day) AS last_day FROM r "
    "GROUP BY run_date",
    "run_record": "SELECT 'loaded' AS run_id, 'success' AS status, count(*) AS loaded_rows, "
    "DATE '2024-02-02' AS limit_date FROM documents UNION ALL "
    "SELECT 'absent', 'success', 0, DATE '2024-01-15'",
    "collect_day": WITH_LAKE
    + f"SELECT {DETAIL_COLUMNS}, l.job_title, l.listing_start_date, l.detail_link FROM lake "
    f"JOIN ({LIST_ROWS}) l USING (detail_link) WHERE l.listing_start_date >= DATE '2025-12-15'",
    "collect_rejects": "WITH d AS (SELECT *, doc_id // 20 + 1 AS page FROM documents) "
    "SELECT CASE WHEN doc_id % 13 <> 0 THEN '/jobs/' || doc_id END AS detail_link, "
    "CASE WHEN doc_id % 13 = 0 THEN 'no link' WHEN doc_id % 11 = 0 THEN 'no date' "
    "WHEN doc_id NOT IN (SELECT doc_id FROM labels) THEN 'no detail page' ELSE 'kept' END AS outcome "
    "FROM d WHERE page % 5 <> 0 UNION ALL SELECT NULL, 'page without text' FROM (SELECT DISTINCT page FROM d WHERE page % 5 = 0)",
    "stream_rejects": f"WITH {POISONED_CTE} SELECT reason, CAST(sum(n) AS BIGINT) AS n FROM outcomes GROUP BY reason",
    "stream_run_records": f"WITH {POISONED_CTE}, c AS (SELECT count(*) FILTER (reason = 'loaded') + count(*) FILTER (reason LIKE 'repeated%') AS loaded, "
    "count(*) FILTER (reason <> 'loaded') AS lost FROM outcomes WHERE reason <> 'wrong header') "
    "SELECT 'success' AS status, count(*) AS loaded_rows, 0::BIGINT AS rejected_rows, count(*) AS records FROM documents "
    "UNION ALL SELECT 'success', loaded, lost, loaded + lost FROM c",
    "ledger_compact": "WITH m AS (SELECT CAST(ts AS DATE) AS day, CAST(user_id AS VARCHAR) AS message_id, max(ts) AS processed_at, kinds "
    "FROM events JOIN (VALUES ('click', 'click+view'), ('view', 'click+view'), ('view', 'view+purchase'), ('purchase', 'view+purchase'), "
    "('error', 'error')) k(event_type, kinds) USING (event_type) GROUP BY ALL) "
    "SELECT message_id, max({'p': processed_at, 'k': kinds}).p AS processed_at, max({'p': processed_at, 'k': kinds}).k AS kinds "
    "FROM m GROUP BY day, message_id",
    "backfill_gaps": f"WITH d AS (SELECT CAST(unnest(range(DATE '1996-01-01', DATE '2001-01-02', INTERVAL 1 DAY)) AS DATE) AS day), "
    f"m AS (SELECT day FROM d WHERE day NOT IN (SELECT order_day FROM ({ORDERS}) WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')), "
    "n AS (SELECT day, day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS start FROM m) "
    "SELECT min(day) AS first_day, max(day) AS last_day, count(*) AS n_days FROM n GROUP BY start",
}
