"""Data-quality checks."""

from datetime import date, datetime

import pytest

from listlake.operators import quality as Q


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, None), (None, "b"), (None, "b"), (None, None), (3, "c")], "k int, v string"
    )


def test_unique_ignores_nulls(df, rows):
    assert rows(Q.dq_unique(df, "k")) == [(1, 2)]


def test_combination_treats_nulls_as_equal(df, rows):
    assert rows(Q.dq_unique_combination(df, ["k", "v"])) == [(1, "a", 2), (None, "b", 2)]


def test_not_null_in_one_pass(df, rows):
    out = Q.dq_not_null(df, ["k", "v"])
    assert rows(out) == [("k", 3), ("v", 2)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_relationships(spark, df, rows):
    parent = spark.createDataFrame([(2,), (2,), (None,)], "p int")
    assert rows(Q.dq_relationships(df, "k", parent, "p")) == [(1, 2), (3, 1)]


@pytest.mark.parametrize(
    "as_of, status",
    [
        (date(2024, 3, 12), "pass"), (datetime(2024, 3, 12, 0, 0, 1), "warn"), (date(2024, 3, 14), "warn"),
        (date(2024, 3, 15), "error"), (date(2024, 3, 1), "pass"),
    ],
)
def test_freshness(spark, as_of, status):
    df = spark.sql("select explode(array(date'2024-03-10', date'2024-01-01', null)) d")
    assert Q.dq_freshness(df, "d", as_of).first()[:] == (date(2024, 3, 10), status)
    assert Q.dq_freshness(df.where("false"), "d", as_of).first()[:] == (None, "error")


def test_one_scan_per_family(spark, df, rows):
    """Several unique columns and combinations, in one aggregate; several children of one parent, without a join."""
    parent = spark.createDataFrame([(1,), (1,), (None,)], "p int")
    suite = (
        Q.Suite().unique("t", "k", "v").unique_combination("t", "k", "v").unique_combination("t", "v", "k").unique("t", "k")
        .relationships("t", "k", "parent", "p").relationships("copy", "k", "parent", "p").unique("parent", "p").unique("none", "k", "v")
        .relationships("none", "k", "parent", "p").not_null("none", "k", "v").unique_combination("none", "k")
    )
    tables = {"t": df, "copy": df, "parent": parent, "none": df.limit(0)}
    results = Q.run_checks(tables, suite.checks)
    got = {(r["check_type"], r["table_name"], r["column_names"]): r["failures"] for r in results.collect()}
    assert got == {
        ("unique", "t", "k"): 1, ("unique", "t", "v"): 2, ("unique_combination", "t", "k,v"): 2, ("unique_combination", "t", "v,k"): 2,
        ("relationships", "t", "k"): 2, ("relationships", "copy", "k"): 2, ("unique", "parent", "p"): 1, ("unique", "none", "k"): 0,
        ("unique", "none", "v"): 0, ("unique_combination", "none", "k"): 0, ("relationships", "none", "k"): 0, ("not_null", "none", "k"): 0, ("not_null", "none", "v"): 0,
    }
    assert results.count() == len(suite.checks)
    plan = Q.run_checks({"t": df}, Q.Suite().unique("t", "k", "v").unique_combination("t", "k", "v").checks)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Expand") == 1 and text.count("LogicalRDD") == 1
    plan = Q.run_checks(tables, Q.Suite().relationships("t", "k", "parent", "p").relationships("copy", "k", "parent", "p").checks)
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_suite_and_results_table(spark, df, rows, tmp_path):
    parent = spark.createDataFrame([(1,)], "p int")
    suite = (
        Q.Suite().unique("t", "k").not_null("t", "k", "v").unique_combination("t", "k", "v")
        .relationships("t", "k", "parent", "p").not_null("parent", "p")
    )
    results = Q.run_checks({"t": df, "parent": parent}, suite.checks)
    assert rows(results) == sorted([
        ("unique", "t", "k", 1, "fail"), ("not_null", "t", "k", 3, "fail"), ("not_null", "t", "v", 2, "fail"),
        ("unique_combination", "t", "k,v", 2, "fail"), ("relationships", "t", "k", 2, "fail"),
        ("not_null", "parent", "p", 0, "pass"),
    ], key=repr)
    path = str(tmp_path / "results")
    for run in ("r1", "r2"):
        assert Q.append_results(results, path, run, datetime(2024, 1, 1)) == {"checks": 6, "failed": 5}
    stored = spark.read.parquet(path)
    assert stored.count() == 12 and stored.select("run_id").distinct().count() == 2
