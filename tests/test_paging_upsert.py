"""Paging cut-off and keyed upsert, against plain Python."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from listlake.operators import paging as G
from listlake.operators import upsert as U

LIMIT = date(2025, 1, 1)


def loop(pages, limit):
    """What reading page after page gives."""
    kept = []
    for n in range(1, 1000):
        if not pages.get(n):
            break
        kept += [(n, d) for d in pages[n]]
        if min(pages[n]) < limit:
            break
    return sorted(((n, d) for n, d in kept if d >= limit), key=repr)


def frame(spark, pages):
    return spark.createDataFrame([(n, d) for n, ds in pages.items() for d in ds] or [], "page long, d date")


def test_cutoff_on_the_first_page(spark, rows):
    pages = {1: [date(2025, 1, 5), date(2024, 12, 28)]}
    assert rows(G.page_cutoff(frame(spark, pages), "d", LIMIT)) == [(1, date(2025, 1, 5))]


def test_later_pages_are_never_seen(spark, rows):
    pages = {1: [date(2025, 1, 3)], 2: [date(2024, 12, 28)], 3: [date(2025, 1, 4)]}
    assert rows(G.page_cutoff(frame(spark, pages), "d", LIMIT)) == [(1, date(2025, 1, 3))]


@pytest.mark.parametrize("seed", range(8))
def test_cutoff_equals_the_loop(spark, rows, seed):
    rng = random.Random(seed)
    pages = {
        n: [LIMIT + timedelta(days=rng.randint(-1 if rng.random() < 0.1 else 0, 9)) for _ in range(rng.randint(1, 4))]
        for n in range(1, rng.choice([1, 5, 30, 250])) if rng.random() < 0.995
    }
    assert rows(G.page_cutoff(frame(spark, pages), "d", LIMIT)) == loop(pages, LIMIT)


def test_no_page_at_all(spark):
    assert G.page_cutoff(frame(spark, {}), "d", LIMIT).count() == 0


def test_every_row_gets_a_page(spark, rows):
    df = spark.range(0, 3000, 1, 7).selectExpr("id", "id % 7 as day")
    order = sorted((-(i % 7), i) for i in range(3000))
    want = sorted(((i, n // 10 + 1) for n, (_, i) in enumerate(order)), key=repr)
    got = G.latest_first_pages(df, [F.desc("day"), F.asc("id")], 10)
    assert got.columns == ["id", "day", "page"] and rows(got, "id", "page") == want
    some = G.latest_first_pages(df, [F.desc("day"), F.asc("id")], 10, max_pages=5)
    assert rows(some, "id", "page") == [r for r in want if r[1] <= 5]
    assert G.latest_first_pages(df.limit(0), [F.asc("id")], 10).count() == 0


@pytest.mark.parametrize("bucket_rows", [1_000_000, 3])
def test_pages_since_equals_the_cutoff(spark, rows, bucket_rows):
    df = spark.range(0, 4000, 1, 7).selectExpr("id", "timestamp_ntz'2025-01-09 00:00:00' - make_dt_interval(0, 0, 0, (id * 7919) % 500 * 3001) AS ts", "'x' AS span")
    pages = G.latest_first_pages(df, [F.desc("ts"), F.asc("id")], 10).withColumn("day", F.col("ts").cast("date"))
    want = rows(G.page_cutoff(pages, "day", LIMIT), "id", "page")
    got = G.pages_since(df, "ts", "id", LIMIT, 10, bucket_rows=bucket_rows)
    assert got.columns == [*df.columns, "page"] and rows(got, "id", "page") == want and 100 < len(want) < 4000
    if bucket_rows > 3:
        assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert G.pages_since(df.limit(0), "ts", "id", LIMIT, 10).count() == 0


def test_cutoff_beyond_a_hundred_pages(spark):
    pages = {n: [LIMIT] for n in range(1, 131)}
    assert G.page_cutoff(frame(spark, pages), "d", LIMIT).count() == 130
    assert G.page_cutoff(frame(spark, pages), "d", LIMIT, max_pages=7).count() == 7
    del pages[120]
    assert G.page_cutoff(frame(spark, pages), "d", LIMIT).count() == 119
    del pages[1]
    assert G.page_cutoff(frame(spark, pages), "d", LIMIT).count() == 0


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.sql("select date'2025-01-02' d, 1 x").write.parquet(str(tmp_path / "t"))
    plan = G.filter_since(spark.read.parquet(str(tmp_path / "t")), "d", LIMIT)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(d,2025-01-01)" in plan


def test_runs_of_a_row(spark, rows):
    df = spark.sql("select date'2024-03-14' d")
    assert rows(G.assign_runs(df, "d"), "run_date") == [(date(2024, 3, 14),), (date(2024, 3, 15),)]


# ---------------------------------------------------------------------------------------- upsert


def kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v int, o int")


def test_upsert(spark, rows):
    target, source = kv(spark, ("a", 1, 0), ("b", 2, 0)), kv(spark, ("b", 9, 1), ("c", 3, 1))
    once = U.upsert_rows(target, source, "k")
    assert rows(once) == [("a", 1, 0), ("b", 9, 1), ("c", 3, 1)]
    assert rows(U.upsert_rows(once, source, "k")) == rows(once)


def test_duplicate_source(spark, rows):
    source = kv(spark, ("a", 1, 1), ("a", 2, 3), ("a", 5, 3), ("b", 4, 0))
    with pytest.raises(U.DuplicateKeyError, match="'a'"):
        U.dedupe_source(source, "k")
    assert rows(U.dedupe_source(source, "k", "last", ["o"])) == [("a", 5, 3), ("b", 4, 0)]
    with pytest.raises(U.DuplicateKeyError):
        U.dedupe_source(kv(spark, (None, 1, 1)), "k")
    with pytest.raises(U.DuplicateKeyError, match="NULL"):
        U.dedupe_source(kv(spark, (None, 1, 1), ("a", 2, 1)), "k", "last", ["o"])
    assert U.dedupe_source(kv(spark, ("a", 1, 1)), "k").count() == 1


def test_copies_collapse_before_the_shuffle(spark):
    plan = U.last_per_key(kv(spark, ("a", 1, 1)), "k", ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan
