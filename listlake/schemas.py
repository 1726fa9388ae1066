"""Fixed schemas of the tables the jobs exchange."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


PAGES = _struct(("page_id", _L), ("url", _S), ("html", _S))

LIST_ROWS = _struct(("job_title", _S), ("listing_start_date", _D), ("detail_link", _S))

BASIC_FIELDS = ["monthly_salary", "occupation", "work_type", "work_location", "industry"]

# Detail-page labels (text of the <th>) and the column each one fills.
DETAIL_LABELS = {
    "案件内容": "job_content",
    "必須スキル": "required_skills",
    "尚可スキル": "preferred_skills",
    "言語": "programming_language",
    "環境・ツール": "tool",
    "フレームワーク・ライブラリ": "framework",
    "稼働率": "rate_of_work",
    "面談回数": "number_of_recruitment_interviews",
    "稼働日数": "number_of_days_worked",
    "募集人数": "number_of_applicants",
}

DETAIL_ROWS = _struct(
    ("monthly_salary", _L),
    *[(name, _S) for name in BASIC_FIELDS[1:]],
    *[(name, _S) for name in DETAIL_LABELS.values()],
)

# Day files are read by position, so this order is also the file order.
LAKE = T.StructType(DETAIL_ROWS.fields + LIST_ROWS.fields)
LAKE_KEY = "detail_link"
LAKE_DAY = "listing_start_date"

MESSAGE = _struct(("message_id", _S), ("subscription", _S), ("data", _S))

LEDGER = _struct(
    ("message_id", _S),
    ("processed_at", T.TimestampType()),
    ("metadata", T.MapType(_S, _S)),
)

RUNS = _struct(
    ("run_id", _S),
    ("status", _S),
    ("message", _S),
    ("loaded_rows", _L),
    ("limit_date", _D),
    ("saved_path", _S),
    ("rejected_rows", _L),
)

CHECK_RESULTS = _struct(
    ("check_type", _S),
    ("table_name", _S),
    ("column_names", _S),
    ("failures", _L),
    ("status", _S),
)
