"""Value tests of the column helpers, on the awkward inputs."""

import hashlib
from datetime import date, datetime, timedelta, timezone
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from listlake.functions import scalars as S


def evaluate(spark, helper, values, schema="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(helper(F.col("x"))).collect()]


def test_md5_key(spark):
    assert evaluate(spark, S.md5_key, ["/jobs/123", "あ", "", None]) == [
        hashlib.md5(b"/jobs/123").hexdigest(),
        hashlib.md5("あ".encode()).hexdigest(),
        "d41d8cd98f00b204e9800998ecf8427e",
        None,
    ]


def test_split_lines_keeps_blanks(spark):
    got = evaluate(spark, S.split_lines, ["a\n\nb\n", "", None, " Go \nGo"])
    assert got == [["a", "", "b", ""], [""], None, [" Go ", "Go"]]


def test_regex_int(spark):
    values = ["2回（予定3）", "応相談", "１０名", None, "", "99999999999999999999", "10名"]
    assert evaluate(spark, S.regex_int, values) == [2, None, None, None, None, None, 10]


def test_days_per_week(spark):
    values = ["週5日", "週3〜5日", "5日", "リモート週2日可"]
    assert evaluate(spark, S.days_per_week, values) == [5, None, None, 2]


def test_digits_to_int(spark):
    values = ["〜500,000円", "〜５0,0円", "50〜80万円", "応相談", None, "〜500000円"]
    assert evaluate(spark, S.digits_to_int, values) == [500000, 500, 5080, None, None, 500000]


def test_trim_text_equals_python_strip(spark):
    blanks = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    values = [" a ", "　Go ", "a \n b", "", "   ", blanks + "x" + blanks, "​z", None]
    assert evaluate(spark, S.trim_text, values) == [v if v is None else v.strip() for v in values]


def test_date_text(spark):
    values = ["掲載開始日：2024年12月27日", "掲載開始日：2024年3月1日", "未定", "掲載開始日：2024年13月1日", "掲載開始日：２０２４年０３月1日", "掲載開始日：24年3月1日", None]
    got = evaluate(spark, lambda c: S.parse_jp_date(S.strip_prefix(S.trim_text(c))), values)
    assert got == [date(2024, 12, 27), date(2024, 3, 1), None, None, date(2024, 3, 1), None, None]


def test_jst_dates(spark):
    df = spark.createDataFrame([("2024-03-14 15:00:00",), ("2024-03-14 14:59:59",)], "x string")
    df = df.select(F.col("x").cast("timestamp_ntz").alias("ts"))
    got = df.select(S.jst_date(F.col("ts")), S.jst_yesterday(F.col("ts"))).collect()
    assert [tuple(r) for r in got] == [
        (date(2024, 3, 15), date(2024, 3, 14)),
        (date(2024, 3, 14), date(2024, 3, 13)),
    ]


def test_jst_today_ignores_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = spark.range(1).select(S.jst_today_now()).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    now = datetime.now(timezone(timedelta(hours=9)))
    assert got in {now.date(), (now - timedelta(minutes=5)).date()}


def test_date_to_partition(spark):
    got = evaluate(spark, lambda c: S.date_to_partition(c.cast("date")), ["2024-03-05", None])
    assert got == ["20240305", None]


def test_base64_json(spark):
    import base64

    good = base64.b64encode(b'{"type":"daily_scraping"}').decode()
    bad = base64.b64encode(b"{oops").decode()
    got = evaluate(spark, lambda c: S.base64_json(c, "type"), [good, bad, "###", "", None])
    assert got == ["daily_scraping", None, None, None, None]


def test_ledger_json(spark):
    df = spark.range(1).select(
        S.ledger_json(
            F.lit("m1"), F.lit("2024-03-15T05:00:00"), F.create_map(F.lit("record_count"), F.lit("3"))
        ),
        S.ledger_json(F.lit("m2"), F.lit("t"), F.lit(None).cast("map<string,string>")),
    )
    assert tuple(df.first()) == (
        '{"message_id":"m1","processed_at":"2024-03-15T05:00:00","metadata":{"record_count":"3"}}',
        '{"message_id":"m2","processed_at":"t","metadata":{}}',
    )


@pytest.mark.parametrize("base", ["https://www.example.com", "http://a.example.com/x/y?q=1#f"])
def test_resolve_url_equals_urljoin(spark, base):
    links = [
        "/jobs/123", "https://example.com/jobs", "jobs/1", "../up", "?page=2", "//cdn.example.com/x",
        "/a//b", "/a/../b", "/a/./b", "/a/.", "#top", "", "/x?y=/../z", "/é,", "mailto:a@b.c", None,
    ]
    expected = [
        None if v is None else v if v.startswith("http") else urljoin(base, v) for v in links
    ]
    assert evaluate(spark, lambda c: S.resolve_url(F.lit(base), c), links) == expected


def test_resolve_url_without_udf(spark):
    df = spark.createDataFrame([("/jobs/1",)], "x string")
    out = df.select(S.resolve_url(F.lit("https://h.example.com/a"), F.col("x"), rooted_only=True))
    assert "Arrow" not in out._jdf.queryExecution().toString()
    assert out.first()[0] == "https://h.example.com/jobs/1"
