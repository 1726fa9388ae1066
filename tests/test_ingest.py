"""Day files, lake merges, daily jobs and the streaming variants."""

import base64
import hashlib
import json
import os
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from listlake.operators.rejects import split_rejects
from listlake.operators.runs import append_run, gaps, islands, missing_days, row_counts, run_record
from listlake.operators.upsert import DuplicateKeyError
from listlake.plans import daily
from listlake.schemas import LAKE, RUNS
from listlake.session import shared_root, work_dir
from listlake.sources import daily_csv as C
from listlake.sources import ledger as L
from listlake.sources.lake import LakeTable, ensure_database, ensure_day_table, footer_stats, merge_statement
from listlake.streaming.file_ingest import ingest_and_record, stream_file_ingest
from listlake.streaming.message_gate import envelope_filter, stream_message_gate
from test_pages import detail_page, list_page
from test_warehouse import lake_rows, listing

D = [date(2024, 10, n) for n in range(1, 10)]


def lake_of(spark, tmp_path, name="lake"):
    return LakeTable(spark, str(tmp_path / name)).create_if_absent()


def links(df):
    return sorted((r["detail_link"], r["listing_start_date"], r["job_title"]) for r in df.collect())


# ------------------------------------------------------------------------------------- day files


def test_csv_round_trip(spark, rows, tmp_path):
    df = lake_rows(spark, [
        listing("/1", programming_language='a\n"q",x\n', tool=" padded ", framework="", occupation="a,b",
                industry="\\", monthly_salary=500000),
        listing("/2", job_content="\r\n", job_title="日本語\t", work_type="'", work_location="#c"),
    ])
    path, n = C.save_day(df, str(tmp_path / "raw"), date(2024, 3, 15))
    assert path.endswith("raw/partition_date=20240315") and n == 2
    back = C.read_days(spark, str(tmp_path / "raw"), date(2024, 3, 15))
    want = df.withColumn("framework", F.nullif("framework", F.lit("")))
    assert rows(back, *LAKE.names) == rows(want)
    assert back.select("partition_date").distinct().collect() == [(20240315,)]


def test_same_day_is_replaced_and_other_days_stay(spark, tmp_path):
    root = str(tmp_path / "raw")
    for day, link in ((D[0], "/old"), (D[1], "/kept"), (D[0], "/new")):
        C.save_day(lake_rows(spark, [listing(link, job_content="x" * 60)]), root, day)
    got = C.read_days(spark, root).select("partition_date", "detail_link").collect()
    assert sorted(map(tuple, got)) == [(20241001, "/new"), (20241002, "/kept")]


def test_rerun_without_rows_replaces_the_day(spark, tmp_path):
    root = str(tmp_path / "raw")
    C.save_day(lake_rows(spark, [listing("/old", job_content="x" * 60)]), root, D[0])
    assert C.save_day(lake_rows(spark, []), root, D[0])[1] == 0
    assert C.read_days(spark, root, D[0]).isEmpty()
    lake = LakeTable(spark, str(tmp_path / "lake"))
    assert daily.load_day(spark, root, lake, D[0])["loaded_rows"] == 0


def test_small_and_missing_files(spark, tmp_path):
    root = tmp_path / "raw"
    assert C.read_days(spark, str(root)) is None
    C.save_day(lake_rows(spark, [listing("/1", job_content="x" * 60)]), str(root), D[0])
    header = ",".join(LAKE.names) + "\n"
    for day, text in (("20241002", "\n"), ("20241003", ""), ("20241004", header)):
        os.makedirs(root / f"partition_date={day}")
        (root / f"partition_date={day}" / "jobs.csv").write_text(text)
    assert C.read_days(spark, str(root)).count() == 1
    assert C.read_days(spark, str(root), D[1]).isEmpty()
    assert C.read_days(spark, str(root), D[8]).isEmpty()


def test_short_files_with_rows_are_read(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    os.makedirs(tmp_path / "partition_date=20241001")
    (tmp_path / "partition_date=20241001" / "x.csv").write_text("a\n1")
    schema = _parse_datatype_string("a int")
    assert C.read_days(spark, str(tmp_path), schema=schema).select("a").collect() == [(1,)]


def test_reordered_header_fails(spark, tmp_path):
    (tmp_path / "f.csv").write_text("occupation,monthly_salary\nSE,1\n")
    schema = "monthly_salary bigint, occupation string"
    from pyspark.sql.types import _parse_datatype_string

    with pytest.raises(Exception, match="header"):
        C.read_csv_typed(spark, str(tmp_path / "f.csv"), _parse_datatype_string(schema)).collect()


def test_bad_record_fails_or_is_set_apart(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string("monthly_salary bigint, occupation string")
    (tmp_path / "f.csv").write_text("monthly_salary,occupation\n1,ok\nx,bad\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        C.read_csv_typed(spark, str(tmp_path / "f.csv"), schema).collect()
    got = C.read_csv_typed(spark, str(tmp_path / "f.csv"), schema, rejects=True).collect()
    assert [tuple(r) for r in got] == [(1, "ok", None), (None, "bad", "x,bad")]


def test_partition_filter_is_pushed(spark, tmp_path):
    C.save_day(lake_rows(spark, [listing("/1", job_content="x" * 60)]), str(tmp_path / "raw"), D[0])
    plan = C.read_days(spark, str(tmp_path / "raw"), D[0])._jdf.queryExecution().executedPlan().toString()
    assert "(partition_date#" in plan.split("PartitionFilters")[1].split("]")[0]


# ------------------------------------------------------------------------------------------ lake


def test_merge_inserts_updates_and_keeps(spark, tmp_path):
    lake = lake_of(spark, tmp_path)
    assert lake.read().count() == 0
    lake.merge(lake_rows(spark, [listing("/1", D[0], job_title="a"), listing("/2", D[0], job_title="b"),
                                 listing("/3", D[1], job_title="c")]))
    batch = lake_rows(spark, [listing("/2", D[0], job_title="B"), listing("/4", D[2], job_title="d")])
    want = [("/1", D[0], "a"), ("/2", D[0], "B"), ("/3", D[1], "c"), ("/4", D[2], "d")]
    for _ in range(2):
        lake.merge(batch)
        assert links(lake.read()) == want
    assert lake.read().schema.names == LAKE.names


def test_row_moving_out_of_a_day_leaves_nothing_behind(spark, tmp_path):
    lake = lake_of(spark, tmp_path)
    lake.merge(lake_rows(spark, [listing("/1", D[0], job_title="a"), listing("/2", None, job_title="n")]))
    lake.merge(lake_rows(spark, [listing("/1", D[5], job_title="a2"), listing("/2", D[5], job_title="n2")]))
    assert links(lake.read()) == [("/1", D[5], "a2"), ("/2", D[5], "n2")]


def test_only_touched_days_are_rewritten(spark, tmp_path):
    lake = lake_of(spark, tmp_path)
    lake.merge(lake_rows(spark, [listing("/1", D[0]), listing("/2", D[1])]))
    lake.merge(lake_rows(spark, [listing("/3", D[1])]))
    version, folders, _ = lake._manifest()
    assert version == 2 and {d: f.split("-")[0] for d, f in folders.items()} == {D[0]: "1", D[1]: "2"}


def test_a_merge_filters_the_lake_by_its_keys(spark, tmp_path):
    """Beyond a broadcast's size, a Bloom filter of the source's keys meets the lake's rows in the scan."""
    lake = lake_of(spark, tmp_path)
    rows = spark.range(3000).selectExpr("concat('/', id) AS detail_link", "date_add(DATE'2024-10-01', cast(id % 3 AS int)) AS listing_start_date")
    for name in LAKE.names:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(LAKE[name].dataType))
    lake.merge(rows)
    source = rows.where("detail_link IN ('/1', '/2998')").persist()
    source.count()
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {c: spark.conf.get(c) for c in confs}
    for c, v in confs.items():
        spark.conf.set(c, v)
    try:
        found = lake.matched(lake._manifest()[1], source)
        assert "might_contain" in found._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(r[0] for r in found.collect()) == ["/1", "/2998"]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
        source.unpersist()


def test_footer_stats_read_no_data(spark, tmp_path):
    for n in range(3):
        spark.range(n * 10, n * 10 + 7).selectExpr("id", "date_add(DATE'2024-10-01', cast(id AS int)) AS d").write.mode("append").parquet(str(tmp_path / "t"))
    found = footer_stats(spark, {"t": str(tmp_path / "t")}, {"t": ["id", "d"]})["t"]
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(d), MAX(d)]" in found._jdf.queryExecution().executedPlan().toString()
    assert found.first()[:] == (21, 0, 26, date(2024, 10, 1), date(2024, 10, 27))
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_failed_merge_changes_nothing(spark, tmp_path):
    lake = lake_of(spark, tmp_path)
    lake.merge(lake_rows(spark, [listing("/1", D[0], job_title="a")]))
    twice = lake_rows(spark, [listing("/1", D[0], job_title="x"), listing("/1", D[1], job_title="y")])
    with pytest.raises(ValueError):
        lake.merge(twice)
    assert links(lake.read()) == [("/1", D[0], "a")]
    lake.merge(twice, on_duplicate="last", order=["listing_start_date"])
    assert links(lake.read()) == [("/1", D[1], "y")]
    assert lake.merge(lake_rows(spark, [])) == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_random_merges_equal_a_dict(spark, tmp_path, seed):
    rng, lake, want = random.Random(seed), lake_of(spark, tmp_path), {}
    for step in range(4):
        batch = {f"/{rng.randint(0, 12)}": (rng.choice(D[:4]), f"s{step}") for _ in range(6)}
        want.update(batch)
        lake.merge(lake_rows(spark, [listing(k, d, job_title=t) for k, (d, t) in batch.items()]))
    assert links(lake.read()) == sorted((k, d, t) for k, (d, t) in want.items())


def test_hot_day_is_cut_into_several_files(spark, tmp_path):
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
        rows = spark.range(3000).selectExpr(
            "concat('/jobs/', id) detail_link", "repeat(sha2(cast(id AS string), 256), 2) job_content",
            "if(id % 3 = 0, date'2024-10-01', date_add(date'2024-10-02', cast(id % 5 AS int))) listing_start_date",
        ).repartition(16)
        lake = lake_of(spark, tmp_path)
        lake.merge(lake_rows(spark, []).unionByName(rows, allowMissingColumns=True))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = lake.read().where("listing_start_date = '2024-10-01'").select("_metadata.file_path").distinct()
    assert lake.read().count() == 3000 and files.count() > 4


def test_day_filter_prunes_folders(spark, tmp_path):
    lake = lake_of(spark, tmp_path)
    lake.merge(lake_rows(spark, [listing("/1", D[0]), listing("/2", D[1])]))
    plan = lake.read().where(F.col("listing_start_date") == D[0])._jdf.queryExecution().executedPlan().toString()
    assert "listing_start_date" in plan.split("PartitionFilters")[1].split("]")[0]


def test_catalog_table(spark, tmp_path):
    ensure_database(spark, "shop")
    for _ in range(2):
        ensure_day_table(spark, "shop.lake_joblist", str(tmp_path / "t"))
    assert spark.table("shop.lake_joblist").columns == [c for c in LAKE.names if c != "listing_start_date"] + ["listing_start_date"]
    ddl = spark.sql("show create table shop.lake_joblist").first()[0]
    assert "PARTITIONED BY (listing_start_date)" in ddl and "'primary_key' = 'detail_link'" in ddl
    spark.sql("drop table shop.lake_joblist")
    text = merge_statement("t1", "t2")
    assert "detail_link = s.detail_link WHEN" in text and text.count("t.") == 18


# -------------------------------------------------------------------------------------- daily jobs


def test_collect_and_load(spark, rows, tmp_path):
    pages = spark.createDataFrame(
        [(1, list_page(("A", "2024年3月15日", "/1"), ("B", "2024年3月14日", "/2"), ("C", "2024年3月13日", "/3"))),
         (2, list_page(("D", "2024年3月14日", "/4")))], "page long, html string")
    details = spark.createDataFrame(
        [(f"/{i}", detail_page([f"{i}0万円", "SE", "正社員", "東京都", "IT"], [("言語", "Go\nC"), ("稼働日数", "週5日")]))
         for i in range(1, 5)], "detail_link string, html string")
    raw, lake = str(tmp_path / "raw"), LakeTable(spark, str(tmp_path / "lake"))
    nothing = daily.load_day(spark, raw, lake, D[0])
    assert (nothing["status"], nothing["loaded_rows"]) == ("success", 0)
    out = daily.collect_day(pages, details, raw, date(2024, 3, 15))
    assert out["record_count"] == 2 and out["limit_date"] == "2024-03-14"
    assert daily.load_day(spark, raw, lake, date(2024, 3, 15))["loaded_rows"] == 2
    assert links(lake.read()) == [("/1", date(2024, 3, 15), "A"), ("/2", date(2024, 3, 14), "B")]
    row = lake.read().where("detail_link = '/2'").first()
    assert (row["monthly_salary"], row["programming_language"], row["number_of_days_worked"]) == (20, "Go\nC", "週5日")
    twice = lake_rows(spark, [listing("/9", D[0]), listing("/9", D[1])])
    C.save_day(twice, raw, date(2024, 3, 16))
    failed = daily.load_day(spark, raw, lake, date(2024, 3, 16))
    assert failed["status"] == "error" and "loaded_rows" not in failed
    assert len(daily.backfill(spark, raw, lake, date(2024, 3, 14), date(2024, 3, 15))) == 2


def test_every_listing_is_kept_or_rejected(spark, rows, tmp_path):
    broken = list_page(("A", "2024年3月15日", "/1"), ("B", "未定", "/2"), ("D", "2024年3月15日", "/4")) + (
        '<div class="job-Title">C</div><div class="time-Stamp">掲載開始日：2024年3月15日</div><ul><li class="detail-Btn02">x</li></ul>'
    )
    pages = spark.createDataFrame([(1, broken), (2, None)], "page long, html string")
    details = spark.createDataFrame(
        [("/1", detail_page(["1円"], [])), ("/2", detail_page(["1円"], [])), ("/4", None)], "detail_link string, html string"
    )
    raw = str(tmp_path / "raw")
    out = daily.collect_day(pages, details, raw, date(2024, 3, 15))
    assert (out["record_count"], out["reject_count"]) == (1, 4)
    stored = spark.read.parquet(out["rejects_path"])
    assert rows(stored, "job_title", "reject") == sorted(
        [("B", "no date"), ("C", "no link"), ("D", "no detail page"), (None, "page without text")], key=repr
    )
    with pytest.raises(daily.RejectedListings, match="1 with no date"):
        daily.collect_day(pages, details, str(tmp_path / "none"), date(2024, 3, 15), on_reject="error")
    assert not (tmp_path / "none").exists()


def test_a_page_that_was_not_read_does_not_end_paging(spark, rows, tmp_path):
    """Page 2 has no text: 3 and 4 are read on. Page 5 holds no listing: 6 is not read."""
    page = lambda n: list_page((f"T{n}", f"2024年3月{16 - n // 4}日", f"/{n}"))
    pages = spark.createDataFrame(
        [(1, page(1)), (2, None), (3, page(3)), (4, page(4)), (5, "<html></html>"), (6, page(6)), (7, None)], "page long, html string"
    )
    details = spark.createDataFrame([(f"/{n}", detail_page(["1円"], [])) for n in range(1, 8)], "detail_link string, html string")
    out = daily.collect_day(pages, details, str(tmp_path / "raw"), date(2024, 3, 15))
    assert (out["record_count"], out["reject_count"]) == (3, 1)
    assert rows(C.read_csv_typed(spark, out["saved_path"]), "job_title") == [("T1",), ("T3",), ("T4",)]
    assert rows(spark.read.parquet(out["rejects_path"]), "reject") == [("page without text",)]
    got = daily.collect_listings(pages.where("page < 5"), details, date(2024, 3, 16))
    assert rows(got.where("reject IS NULL"), "job_title") == [("T1",), ("T3",)]


def test_backfill_stops_where_a_day_fails(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), LakeTable(spark, str(tmp_path / "lake"))
    C.save_day(lake_rows(spark, [listing("/1", D[0], job_title="old"), listing("/1", D[0], job_title="again")]), raw, D[0])
    C.save_day(lake_rows(spark, [listing("/1", D[1], job_title="new")]), raw, D[1])
    assert [r["status"] for r in daily.backfill(spark, raw, lake, D[0], D[1])] == ["error"]
    C.save_day(lake_rows(spark, [listing("/1", D[0], job_title="old")]), raw, D[0])
    assert [r["status"] for r in daily.backfill(spark, raw, lake, D[0], D[1])] == ["success"] * 2
    assert links(lake.read()) == [("/1", D[1], "new")]


def test_backfill_resumes_at_the_first_missing_day(spark, rows, tmp_path):
    raw, runs, lake = str(tmp_path / "raw"), str(tmp_path / "runs"), LakeTable(spark, str(tmp_path / "lake"))

    def save(n, *titles):
        C.save_day(lake_rows(spark, [listing("/1", D[n], job_title=t) for t in titles]), raw, D[n])

    save(0, "d0"), save(1, "twice", "twice"), save(2, "d2")
    assert [r["status"] for r in daily.resume(spark, raw, lake, runs, D[0], D[2])] == ["success", "error"]
    assert rows(missing_days(spark, runs, D[0], D[3])) == [(D[1], D[3], 3)]
    save(1, "d1")
    assert [r["status"] for r in daily.resume(spark, raw, lake, runs, D[0], D[2])] == ["success"] * 2
    assert links(lake.read()) == [("/1", D[2], "d2")]
    assert daily.resume(spark, raw, lake, runs, D[0], D[2]) == []
    assert spark.read.parquet(runs).count() == 4


def test_islands_and_gaps(spark, rows):
    days = spark.createDataFrame([(D[n],) for n in (0, 1, 1, 3, 6, 7)] + [(None,)], "d date")
    assert rows(islands(days, "d")) == sorted([(D[0], D[1], 2), (D[3], D[3], 1), (D[6], D[7], 2)], key=repr)
    assert rows(gaps(days, "d", D[0], D[8])) == sorted([(D[2], D[2], 1), (D[4], D[5], 2), (D[8], D[8], 1)], key=repr)
    assert rows(gaps(days.limit(0), "d", D[0], D[2])) == [(D[0], D[2], 3)]


def test_null_keys_never_reach_the_lake(spark, tmp_path):
    lake = LakeTable(spark, str(tmp_path / "lake")).create_if_absent()
    rows = lake_rows(spark, [listing(None, D[0]), listing("/1", D[0])])
    for mode in ("error", "last"):
        with pytest.raises(DuplicateKeyError):
            lake.merge(rows, mode)
    assert lake.read().count() == 0


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    """The second to store its manifest fails and changes nothing of the first."""
    lake, late = (LakeTable(spark, str(tmp_path / "lake")).create_if_absent() for _ in range(2))
    lake.merge(lake_rows(spark, [listing("/0", D[0])]))
    before = late._manifest()
    lake.merge(lake_rows(spark, [listing("/1", D[1])]))
    monkeypatch.setattr(late, "_manifest", lambda: before)
    with pytest.raises(Exception, match="(?i)exist"):
        late.merge(lake_rows(spark, [listing("/2", D[1])]))
    assert [r[0] for r in links(lake.read())] == ["/0", "/1"]


def test_empty_collection(spark, tmp_path):
    pages = spark.createDataFrame([(1, "<html></html>")], "page long, html string")
    details = spark.createDataFrame([], "detail_link string, html string")
    got = daily.collect_listings(pages, details, D[0])
    assert got.columns == [*LAKE.names, "reject"] and got.count() == 0


def test_run_record_and_counts(spark, rows, tmp_path):
    append_run(run_record(spark, "r1", "success", "ok", 10), str(tmp_path / "runs"))
    append_run(run_record(spark, "r2", "error", "boom"), str(tmp_path / "runs"))
    assert rows(spark.read.schema(RUNS).parquet(str(tmp_path / "runs")), "run_id", "loaded_rows") == [("r1", 10), ("r2", None)]
    assert rows(row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]


# --------------------------------------------------------------------------------------- streaming


def test_stream_equals_batch(spark, tmp_path):
    raw, cp = str(tmp_path / "raw"), str(tmp_path / "cp")
    days = {
        D[0]: [listing("/1", D[0], job_title="a"), listing("/2", D[0], job_title="b")],
        D[1]: [listing("/2", D[1], job_title="B"), listing("/3", D[1], job_title="c")],
    }
    streamed, batch = LakeTable(spark, str(tmp_path / "s")), LakeTable(spark, str(tmp_path / "b"))
    for day, content in days.items():
        C.save_day(lake_rows(spark, content), raw, day)
    seen = []
    stream_file_ingest(spark, raw, streamed, cp, after_merge=lambda b, i: seen.append(b.count())).awaitTermination()
    daily.backfill(spark, raw, batch, D[0], D[1])
    assert links(streamed.read()) == links(batch.read()) == [
        ("/1", D[0], "a"), ("/2", D[1], "B"), ("/3", D[1], "c")]
    stream_file_ingest(spark, raw, streamed, cp, after_merge=lambda b, i: seen.append(b.count())).awaitTermination()
    assert sum(seen) == 4
    C.save_day(lake_rows(spark, [listing("/3", D[1], job_title="rewritten")]), raw, D[1])
    stream_file_ingest(spark, raw, streamed, cp).awaitTermination()
    assert ("/3", D[1], "rewritten") in links(streamed.read())


HEADER = ",".join(LAKE.names)


def write_file(root, day, name, text):
    folder = root / f"partition_date={day:%Y%m%d}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def line(link, day, title="t", salary="1"):
    return ",".join({"detail_link": link, "listing_start_date": day, "job_title": title, "monthly_salary": salary}.get(c, "") for c in LAKE.names)


def test_a_poisoned_file_does_not_stop_the_stream(spark, rows, tmp_path):
    raw, lake = tmp_path / "raw", LakeTable(spark, str(tmp_path / "lake"))
    bad = [
        line("/bad", "2024-10-01", salary="many"), line("", "2024-10-01", "no link"), "a,b", line("/day", "yesterday"),
        line("/two", "2024-10-01", "a"), line("/two", "2024-10-01", "b"), line("/two", "2024-10-01", "b"), line("/ok", "2024-10-01", '"multi\nline ""q"""'),
    ]
    write_file(raw, D[0], "a.csv", "\n".join([HEADER, *bad]) + "\n")
    swapped = HEADER.replace("monthly_salary,occupation", "occupation,monthly_salary")
    write_file(raw, D[1], "b.csv", "\n".join([swapped, line("/shifted", "2024-10-02", salary="")]) + "\n")
    write_file(raw, D[2], "c.csv", "\n".join([HEADER, line("/later", "2024-10-03"), line("/ok", "2024-10-03", "newer")]) + "\n")
    write_file(raw, D[3], "d.csv", "\n")
    for _ in range(2):
        stream_file_ingest(spark, str(raw), lake, str(tmp_path / "cp"), files_per_batch=1).awaitTermination()
    write_file(raw, D[4], "e.csv", "\n".join([HEADER, line("/last", "2024-10-05")]) + "\n")
    stream_file_ingest(spark, str(raw), lake, str(tmp_path / "cp"), files_per_batch=1).awaitTermination()
    assert [k for k, *_ in links(lake.read())] == ["/last", "/later", "/ok", "/two"]
    assert {k: t for k, _, t in links(lake.read())}["/two"] == "b"
    stored = spark.read.parquet(f"{lake.root}-rejects")
    assert {c for c in stored.columns} == {"file", "reason", "record", "copies", "query", "batch"}
    found = sorted((r["reason"], r["copies"]) for r in stored.collect())
    assert found == [
        ("no detail_link", 1), ("repeated detail_link", 1), ("repeated detail_link", 1), *[("unreadable record", 1)] * 3, ("wrong header", 1), ("wrong header", 1),
    ]
    whole = stored.where("reason = 'unreadable record'").select("record").collect()
    assert bad[0] in {r["record"].strip() for r in whole}


def test_rejects_and_rows_add_up(spark, rows, tmp_path):
    """Text columns only, a hot repeated row, clashing names."""
    schema = spark.createDataFrame([], "k string, reason string, copies string").schema
    hot = "h,x,y\n" * 500
    (tmp_path / "f.csv").write_text('"k",reason,copies\n' + hot + "h,a,y\nz,,\n,q,r\n1,2,3,4\n")
    read = spark.read.options(**C.LENIENT).schema(C.with_rejects(schema)).csv(str(tmp_path / "f.csv"))
    good, bad = split_rejects(read.selectExpr("*", "'f' AS place"), schema, "k", ["place"], "place")
    assert rows(good, "k", "reason", "copies") == [("h", "x", "y"), ("z", None, None)]
    assert rows(bad, "reason", "copies") == sorted(
        [("repeated k", 499), ("repeated k", 1), ("no k", 1), ("unreadable record", 1)], key=repr
    )


def test_a_replayed_batch_is_skipped(spark, tmp_path):
    """The lake knows the last batch of a stream; the batch is not even read again."""
    lake = LakeTable(spark, str(tmp_path / "lake")).create_if_absent()
    first = lake_rows(spark, [listing("/1", D[0], job_title="first")])
    assert lake.merge(first, batch=("q", 0)) == 1
    assert lake.merge(lake_rows(spark, [listing("/1", D[0], job_title="late")]), batch=("q", 0)) == 1
    assert lake.merge(lake_rows(spark, [listing("/2", D[1])])) == 2  # another writer keeps the mark
    assert lake.merge(first, batch=("q", 0)) == 2 and lake.merge(first, batch=("other", 0)) == 3
    assert lake.merge(lake_rows(spark, [listing("/3", D[1])]), batch=("q", 1)) == 4
    assert links(lake.read()) == [("/1", D[0], "first"), ("/2", D[1], None), ("/3", D[1], None)]


def test_a_stream_that_dies_after_its_merge_does_not_merge_again(spark, tmp_path):
    raw, lake = str(tmp_path / "raw"), LakeTable(spark, str(tmp_path / "lake"))
    C.save_day(lake_rows(spark, [listing("/1", D[0])]), raw, D[0])

    def die(batch, i):
        raise RuntimeError("power cut")

    with pytest.raises(Exception, match="power cut"):
        stream_file_ingest(spark, raw, lake, str(tmp_path / "cp"), after_merge=die).awaitTermination()
    assert lake.version() == 1
    stream_file_ingest(spark, raw, lake, str(tmp_path / "cp")).awaitTermination()
    assert lake.version() == 1 and lake.read().count() == 1


def test_streaming_runs_are_recorded(spark, tmp_path):
    raw, lake, runs = tmp_path / "raw", LakeTable(spark, str(tmp_path / "lake")), str(tmp_path / "runs")
    write_file(raw, D[0], "a.csv", "\n".join([HEADER, line("/1", "2024-10-01"), line("", "2024-10-01"), "x"]) + "\n")
    ingest_and_record(spark, str(raw), lake, str(tmp_path / "cp"), runs)
    write_file(raw, D[1], "b.csv", "\n".join([HEADER, line("/2", "2024-10-02"), line("/3", "2024-10-02")]) + "\n")
    ingest_and_record(spark, str(raw), lake, str(tmp_path / "cp"), runs)
    ingest_and_record(spark, str(raw), lake, str(tmp_path / "cp"), runs)  # nothing new, no record
    stored = sorted(tuple(r) for r in spark.read.schema(RUNS).parquet(runs).select("status", "loaded_rows", "rejected_rows").collect())
    assert stored == [("success", 1, 2), ("success", 2, 0)]

    def die(batch, i):
        raise RuntimeError("power cut")

    write_file(raw, D[2], "c.csv", "\n".join([HEADER, line("/4", "2024-10-02")]) + "\n")
    with pytest.raises(Exception, match="power cut"):
        ingest_and_record(spark, str(raw), lake, str(tmp_path / "cp"), runs, after_merge=die)
    assert spark.read.parquet(runs).where("status = 'error' AND message LIKE '%power cut%'").count() == 1


def test_a_stream_caches_no_rows(spark, tmp_path, monkeypatch):
    """While a batch is split and merged its rows are in stored tables, parsed once; these go when it ends."""
    raw, lake = tmp_path / "raw", LakeTable(spark, str(tmp_path / "lake"))
    work, cached, stored, matched = tmp_path / "lake/work", [], [], LakeTable.matched

    def watched(self, *args):
        cached.append(set(spark.sparkContext._jsc.sc().getPersistentRDDs().keySet().mkString(",").split(",")))
        stored.append(len(os.listdir(work)) if work.exists() else 0)
        return matched(self, *args)

    before = set(spark.sparkContext._jsc.sc().getPersistentRDDs().keySet().mkString(",").split(","))
    monkeypatch.setattr(LakeTable, "matched", watched)
    twice = [line("/1", "2024-10-01", "a"), line("/1", "2024-10-01", "b"), line("", "2024-10-01")]
    write_file(raw, D[0], "a.csv", "\n".join([HEADER, *twice]) + "\n")
    stream_file_ingest(spark, str(raw), lake, str(tmp_path / "cp")).awaitTermination()
    assert links(lake.read()) == [("/1", D[0], "b")]
    assert len(cached) == 1 and cached[0] <= before and stored == [2]  # the batch and the merge's source
    assert os.listdir(work) == []

    def die(batch, i):
        raise RuntimeError("power cut")

    write_file(raw, D[1], "b.csv", "\n".join([HEADER, line("/2", "2024-10-02")]) + "\n")
    with pytest.raises(Exception, match="power cut"):
        stream_file_ingest(spark, str(raw), lake, str(tmp_path / "cp"), after_merge=die).awaitTermination()
    assert os.listdir(work) == []


def test_a_merge_reads_its_source_once(spark, tmp_path):
    """Also one with a column of NULLs without a type; a fault in the source leaves no working table."""
    lake = lake_of(spark, tmp_path)
    reads = spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            reads.add(1)
            yield r

    rows = lake_rows(spark, [listing("/1", D[0], job_title="x"), listing("/2", D[1])])
    once = spark.createDataFrame(rows.rdd.mapPartitions(counted), LAKE).withColumn("tool", F.lit(None))
    lake.merge(once, on_duplicate="last", order=["job_title"])
    assert reads.value == 2 and links(lake.read()) == [("/1", D[0], "x"), ("/2", D[1], None)]
    assert {r["tool"] for r in lake.read().collect()} == {None}
    with pytest.raises(DuplicateKeyError):
        lake.merge(rows.union(rows))
    assert os.listdir(tmp_path / "lake/work") == []


def body(message_id, payload=None, raw=None, **extra):
    data = raw if raw is not None else base64.b64encode(json.dumps(payload).encode()).decode()
    return json.dumps({"message": {"data": data, "messageId": message_id}, "subscription": "s", **extra})


GOOD = {"type": "daily_scraping"}


def test_envelope_filter(spark, rows):
    no_subscription = json.dumps({"message": {"data": base64.b64encode(b"{}").decode()}})
    messages = [
        body("1", GOOD), body("2", {"type": "other"}), body("3", raw="%%%"), body("4", [1]), no_subscription,
        "not json", "[1]", None, json.dumps({"message": {}, "subscription": "s"}), body("5", {}), body(None, GOOD),
        json.dumps({"message": None, "subscription": "s"}), body("6", raw=base64.b64encode(b"{oops").decode()),
    ]
    df = spark.createDataFrame([(m,) for m in messages], "body string")
    unnamed = "sha256:" + hashlib.sha256(body(None, GOOD).encode()).hexdigest()
    assert rows(envelope_filter(df), "message_id") == [("1",), (unnamed,)]
    assert envelope_filter(df)._jdf.queryExecution().optimizedPlan().toString().count("map<string,string>") <= 1


def test_message_gate(spark, rows, tmp_path):
    inbox, ledger, cp = (str(tmp_path / n) for n in ("in", "ledger", "cp"))
    worked = []

    def run(*bodies, work=lambda fresh, i: worked.append(sorted(r[0] for r in fresh.collect())) or {"n": 1}):
        if bodies:
            spark.createDataFrame([(b,) for b in bodies], "body string").write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("body string").parquet(inbox)
        stream_message_gate(stream, ledger, cp, work).awaitTermination()

    run(body("m1", GOOD), body("m1", GOOD), body("m2", GOOD), body("x", {"type": "no"}))
    run(body("m2", GOOD), body("m3", GOOD))
    run(body("m1", GOOD))
    assert worked == [["m1", "m2"], ["m3"]]
    assert rows(L.read_ledger(spark, ledger), "message_id") == [("m1",), ("m2",), ("m3",)]
    assert L.read_ledger(spark, ledger).first()["metadata"] == {"n": "1"}

    def fail(fresh, i):
        raise RuntimeError("no luck")

    with pytest.raises(Exception, match="no luck"):
        run(body("m4", GOOD), work=fail)
    assert L.read_ledger(spark, ledger).count() == 3
    run()
    assert worked[-1] == ["m4"] and L.read_ledger(spark, ledger).count() == 4


def test_ledger_rows(spark, rows, tmp_path):
    ids = spark.createDataFrame([("a",), ("a",), ("b",)], "message_id string")
    now = datetime(2024, 3, 15, 5)
    L.append_ledger(L.ledger_rows(ids, now, {"record_count": 3}), str(tmp_path / "l"))
    assert rows(L.anti_join_ledger(spark.createDataFrame([("b",), ("c",)], "message_id string"),
                                   L.read_ledger(spark, str(tmp_path / "l")))) == [("c",)]
    assert L.read_ledger(spark, str(tmp_path / "l")).count() == 2


def test_ledger_by_days_and_compaction(spark, rows, tmp_path):
    path = str(tmp_path / "l")
    assert L.read_ledger(spark, path).count() == 0 and L.compact_ledger(spark, path) == 0
    for day in (1, 2, 3):
        for n in range(3):
            ids = spark.createDataFrame([(f"m{day}-{n}",), (f"again{n % 2}",)], "message_id string")
            L.append_ledger(L.ledger_rows(ids, datetime(2024, 3, day, n), {"n": n}), path)
    before = rows(L.read_ledger(spark, path).select("message_id").distinct())
    recent = L.read_ledger(spark, path, date(2024, 3, 3))
    assert recent.count() == 6 and "PartitionFilters: [isnotnull(processed_day" in recent._jdf.queryExecution().toString()
    sizes = L.ledger_days(spark, path)
    assert list(sizes) == [f"processed_day=2024-03-0{d}" for d in (1, 2, 3)] and min(sizes.values()) >= 3
    assert L.compact_ledger(spark, path, before=date(2024, 3, 3)) == 2
    assert [L.ledger_days(spark, path)[d] for d in sizes] == [1, 1, sizes["processed_day=2024-03-03"]]
    assert rows(L.read_ledger(spark, path).select("message_id").distinct()) == before
    kept = {r["message_id"]: r["metadata"] for r in L.read_ledger(spark, path).where("processed_at < '2024-03-02'").collect()}
    assert kept["again0"] == {"n": "2"} and kept["again1"] == {"n": "1"} and len(kept) == 5
    assert L.compact_ledger(spark, path, before=date(2024, 3, 3)) == 0
    assert not [n for n in os.listdir(path) if n.startswith("_compact")]


def test_shared_folder(spark):
    assert work_dir(spark, "x").startswith(shared_root(spark) + "/x-")
