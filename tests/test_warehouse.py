"""Models and joins: traps, the two report strategies, and skewed keys against brute force."""

import hashlib
import itertools
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from listlake.functions.calendar import dim_date, dim_date_spanning
from listlake.operators import joins as J
from listlake.operators.multivalue import Attribute, bridge, dimension, explode_product, join_fact_multivalue
from listlake.plans import warehouse as W
from listlake.schemas import LAKE


def md5(text):
    return None if text is None else hashlib.md5(text.encode()).hexdigest()


def lake_rows(spark, rows):
    """Rows given as dicts over the lake's 18 columns."""
    return spark.createDataFrame([tuple(r.get(c) for c in LAKE.names) for r in rows], LAKE)


def listing(link, day=date(2024, 10, 6), **kw):
    return {"detail_link": link, "listing_start_date": day, **kw}


def random_lake(spark, n, seed):
    rng = random.Random(seed)
    values = ["Go", "Python", "", "C++", " Go ", "日本語"]

    def text():
        return rng.choice([None, "", "\n".join(rng.choices(values, k=rng.randint(1, 4)))])

    return lake_rows(
        spark,
        [
            listing(f"/jobs/{i}", date(2024, 9, 28) + timedelta(days=rng.randint(0, 500)),
                    programming_language=text(), tool=text(), framework=text(),
                    monthly_salary=rng.choice([None, 500000]), rate_of_work="100%",
                    number_of_recruitment_interviews=rng.choice(["2回（予定3）", "応相談", None]),
                    number_of_days_worked=rng.choice(["週5日", "週3〜5日"]), number_of_applicants="10名")
            for i in range(n)
        ],
    )


def test_staging(spark):
    stg = W.staging(lake_rows(spark, [
        listing("/jobs/1", programming_language="a\n\nb\n", tool="", number_of_days_worked="週5日",
                number_of_recruitment_interviews="2回（予定3）", number_of_applicants="１０名"),
    ]))
    row = stg.first()
    assert len(stg.columns) == 19 and row["job_id"] == md5("/jobs/1")
    assert (row["programming_language"], row["tool"], row["framework"]) == (["a", "", "b", ""], [""], None)
    assert (row["number_of_recruitment_interviews"], row["number_of_days_worked"],
            row["number_of_applicants"]) == (2, 5, None)


def test_bridges_keep_copies_and_dims_do_not(spark, rows):
    stg = W.staging(lake_rows(spark, [
        listing("/1", programming_language="Go\nGo"), listing("/2", programming_language="Go\nC"), listing("/3"),
    ]))
    assert rows(W.bridge_attribute(stg, "language")) == sorted(
        [(md5("/1"), md5("Go"))] * 2 + [(md5("/2"), md5("Go")), (md5("/2"), md5("C"))], key=repr)
    assert rows(W.dim_attribute(stg, "language")) == sorted([(md5("Go"), "Go"), (md5("C"), "C")], key=repr)


def test_calendar(spark):
    cal = dim_date(spark)
    assert cal.count() == 456
    assert cal.agg(F.min("date_day"), F.max("date_day")).first()[:] == (date(2024, 10, 1), date(2025, 12, 30))
    by_day = {r["date_day"]: r for r in cal.collect()}
    for d, r in by_day.items():
        sunday = d - timedelta(days=(d.weekday() + 1) % 7)
        jan1 = date(d.year, 1, 1)
        first_sunday = jan1 + timedelta(days=(6 - jan1.weekday()) % 7)
        assert r["week_start_date"] == sunday and r["week_end_date"] == sunday + timedelta(days=6)
        assert r["week_of_year"] == ((d - first_sunday).days // 7 + 1)
        assert (r["day_of_week"], r["day_of_week_iso"]) == ((d.weekday() + 1) % 7 + 1, d.isoweekday())
        assert r["iso_week_of_year"] == d.isocalendar()[1]
        assert r["month_start_date"] == d.replace(day=1) and r["year_start_date"] == jan1
        assert r["quarter_start_date"] == date(d.year, (d.month - 1) // 3 * 3 + 1, 1)
        assert r["quarter_end_date"] < d + timedelta(days=92) and r["quarter_end_date"] >= d
        assert r["day_of_week_name_short"] == d.strftime("%a") and r["month_name"] == d.strftime("%B")
        assert r["prior_year_over_year_date_day"] == d - timedelta(days=364)
    monday = {r["date_day"]: r["week_start_date"] for r in dim_date(spark, first_day="monday").collect()}
    assert monday[date(2024, 10, 6)] == date(2024, 9, 30)
    assert dim_date(spark, end_exclusive=False).count() == 457


def test_calendar_of_a_table(spark):
    df = spark.sql("select explode(array(date'2024-02-27', date'2024-03-01')) d")
    assert dim_date_spanning(df, "d").count() == 4
    assert dim_date_spanning(df.where("false"), "d").count() == 0


def test_report_outside_calendar_keeps_nulls(spark):
    stg = W.staging(lake_rows(spark, [listing("/1", date(2025, 12, 31)), listing("/2", date(2024, 10, 6))]))
    cal = dim_date(spark)
    got = {r["detail_link"]: r for r in
           W.bi_job_analysis(W.fct_jobs(stg), W.dim_job_details(stg), cal).collect()}
    assert got["/1"]["listing_week"] is None and got["/1"]["listing_start_date"] == date(2025, 12, 31)
    assert got["/2"]["listing_week"] == date(2024, 10, 6) and got["/2"]["listing_day_of_week"] == "Sun"


@pytest.mark.parametrize("seed", [1, 2])
def test_star_equals_fused(spark, seed):
    stg = W.staging(random_lake(spark, 60, seed)).persist()
    cal = dim_date(spark)
    star, fused = (W.models(stg, cal, s) for s in ("star", "fused"))
    for name in ("bi__job_analysis", "bi__job_analysis_detail"):
        a, b = star[name], fused[name]
        assert a.columns == b.columns and a.count() == b.count() > 0
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_publish_models(spark, tmp_path):
    cal, lake = dim_date(spark), random_lake(spark, 30, 4)
    tables = W.publish_models(spark, lake, str(tmp_path), "run1")
    assert len(tables) == 12
    for name, want in W.models(W.staging(lake), cal).items():
        assert tables[name].exceptAll(want).isEmpty() and want.exceptAll(tables[name]).isEmpty(), name
    files = {f for t in ("stg_joblist", "bi__job_analysis_detail") for f in tables[t].inputFiles()}
    assert files and all("/run1/" in f for f in files)


@pytest.mark.parametrize("small", [True, False])
def test_bucketed_star_joins_without_exchange(spark, no_broadcast, tmp_path, small):
    """Equal to the fused report; no exchange on the job key, whether dimensions are broadcast or not."""
    lake = random_lake(spark, 60, 5)
    star = W.publish_star(spark, lake, str(tmp_path), f"star-{small}", buckets=4)
    got = W.star_detail(star, broadcast_bytes=W.BROADCAST_BYTES if small else 0)
    want = W.bi_job_analysis_detail(W.staging(lake), dim_date(spark))
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    if small:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and plan.count("SortMergeJoin") == 4, [x[:300] for x in plan.split("\n") if "hashpart" in x or "SortM" in x]
    else:
        late = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(job_id" not in late and "hashpartitioning(lang_id" in late


def test_star_with_a_hot_job(spark, no_broadcast, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "BUCKET_ROWS", 20)
    lake = lake_rows(spark, [listing("/1", tool="\n".join(f"t{i}" for i in range(50)), framework="a\nb"), listing("/2", tool="t1"), listing("/3")])
    star = W.publish_star(spark, lake, str(tmp_path), "hot", buckets=4)
    assert len(star.hot["tool"]) == 1 and star.hot["language"] == {}
    got, want = W.star_detail(star), W.bi_job_analysis_detail(W.staging(lake), dim_date(spark))
    assert got.count() == want.count() == 102 and got.exceptAll(want).isEmpty()


def test_repeated_job_key_selects_the_star(spark):
    once, twice = [listing("/1", tool="a\nb")], [listing("/1", tool="a\nb"), listing("/1", tool="c")]
    assert W.choose_strategy(W.staging(lake_rows(spark, once))) == "fused"
    assert W.choose_strategy(W.staging(lake_rows(spark, twice))) == "star"


def test_detail_report_multiplies_and_keeps_empty_jobs(spark):
    stg = W.staging(lake_rows(spark, [
        listing("/1", programming_language="a\nb", tool="x\ny\nz", framework="f"), listing("/2"),
    ]))
    got = W.bi_job_analysis_detail(stg, dim_date(spark))
    counts = {r["detail_link"]: r["count"] for r in got.groupBy("detail_link").count().collect()}
    assert counts == {"/1": 6, "/2": 1}
    row = got.where("detail_link = '/2'").first()
    assert (row["lang_id"], row["lang"], row["tool_id"]) == (None, None, None)


def test_fused_report_has_no_shuffle(spark, tmp_path):
    random_lake(spark, 5, 1).write.parquet(str(tmp_path / "lake"))
    stg = W.staging(spark.read.parquet(str(tmp_path / "lake")))
    plan = W.bi_job_analysis_detail(stg, dim_date(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


# ------------------------------------------------------------------------------------- skewed keys


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(J, "HOT_ROWS", 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_keys(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 7, id + 100) as k")
    assert list(J.hot_keys(df, "k")) == [7] and J.hot_keys(df, "k")[7] == 11  # a third of 4 x 8 slots
    assert J.hot_keys(df.where("k <> 7"), "k") == {}
    assert J.hot_keys(df.where("false"), "k") == {}
    assert list(J.hot_keys(df.selectExpr("cast(null as string) as k"), "k")) == [None]


@pytest.mark.parametrize("hot", [None, [], [7], [7, 104, -1], [None], {7: 3, None: 2, 5: 1}])
def test_left_join_unique_equals_plain_join(spark, no_broadcast, hot):
    left = spark.range(3000).selectExpr("case when id % 3 = 0 then 7 when id % 5 = 0 then null else id end as k", "id as v")
    right = spark.range(0, 2000, 1).selectExpr("id as k", "id * 2 as w")
    plain = left.join(right, "k", "left")
    got = J.left_join_unique(left, right, "k", hot)
    assert got.columns == plain.columns and got.count() == 3000
    assert got.exceptAll(plain).isEmpty()


def test_hot_rows_are_dealt_over_the_tasks(spark, no_broadcast):
    # A third of the rows on one key, a third without a key; half of the columns are the same.
    left = spark.range(0, 30000, 1, 32).selectExpr("case id % 3 when 0 then 7 when 1 then id end as k")
    right = spark.range(30000).selectExpr("id as k", "id as w")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for got, n in ((J.left_join_unique(left, right, "k"), 30000),
                       (J.anti_join(left, right.where("k < 100"), "k"), 20000 - 33)):
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "Broadcast" not in plan and plan.count("Range (0, 30000, step=1, splits=32)") == 1
            sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == n and max(sizes) < n / 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_join_fact_multivalue_with_hot_jobs_equals_brute_force(spark, no_broadcast, rows):
    rng = random.Random(3)
    jobs = list(range(40))
    sides = [
        [(0 if rng.random() < 0.4 else rng.choice(jobs), f"{n}{rng.randint(0, 5)}") for _ in range(90)]
        for n in "abc"
    ]
    fact = spark.createDataFrame([(j, f"f{j}") for j in jobs], "job int, f string")
    frames = [
        spark.createDataFrame(s, f"job int, {n} string") for s, n in zip(sides, ("a", "b", "c"))
    ]
    from listlake.operators.multivalue import join_fact_multivalue

    got = join_fact_multivalue(fact, "job", frames)
    want = []
    for j in jobs:
        lists = [[v for k, v in s if k == j] or [None] for s in sides]
        want += [(j, f"f{j}", *combo) for combo in itertools.product(*lists)]
    assert rows(got, "job", "f", "a", "b", "c") == sorted(want, key=repr)


@pytest.mark.parametrize("hot", [None, [], [1], [2, 9, None]])
def test_anti_join_keeps_null_keys(spark, rows, hot):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(J.anti_join(left, right, "k", hot)) == [(2,), (2,), (None,)]


def test_unnest_and_product(spark, rows):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "k int, arr array<string>")
    assert rows(J.unnest(df, "arr", "v"), "k", "v") == [(1, "a"), (1, None)]
    attr = Attribute("arr", "arr_id", "arr")
    assert rows(explode_product(df, [attr]), "k", "arr", "arr_id") == sorted(
        [(1, "a", md5("a")), (1, None, None), (2, None, None), (3, None, None)], key=repr)
    assert rows(dimension(df, attr)) == sorted([(md5("a"), "a"), (None, None)], key=repr)
    assert bridge(df, "k", attr).count() == 2


def test_hot_keys_on_every_side_take_one_pass(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(J, "HOT_ROWS", 5)
    spark.range(30).selectExpr("cast(nullif(id, 29) as string) k", "id x").write.parquet(str(tmp_path / "fact"))
    sides = []
    for n in range(3):
        # Keys 1 and 2 are frequent, 20 and above are absent.
        keys = [1] * 12 + [2] * (9 if n else 0) + list(range(20)) + [None] * 8
        side = spark.createDataFrame([(None if k is None else str(k), i) for i, k in enumerate(keys)], f"k string, v{n} int")
        side.write.parquet(str(tmp_path / f"side{n}"))
        sides.append(spark.read.parquet(str(tmp_path / f"side{n}")))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    got = join_fact_multivalue(fact, "k", sides)
    plain = fact
    for side in sides:
        plain = plain.join(side, "k", "left")
    assert rows(got, "k", "x", "v0", "v1", "v2") == rows(plain, "k", "x", "v0", "v1", "v2")
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 4 and plan.count("LeftOuter") == 3


def test_calendar_of_unknown_length_has_no_hint(spark):
    stg = W.staging(lake_rows(spark, [listing("/1", date(2024, 10, 6))]))
    long = dim_date(spark, date(1700, 1, 1), date(2200, 1, 1))
    bare = W.bi_job_analysis_fused(stg, long)
    assert "broadcast" not in bare._jdf.queryExecution().analyzed().toString().lower()
    assert bare.first()["listing_start_date"] == date(2024, 10, 6)
    known = W.bi_job_analysis_fused(stg, dim_date(spark, date(2024, 10, 1), date(2024, 11, 1)), max_days=31)
    assert "broadcast" in known._jdf.queryExecution().analyzed().toString().lower()
