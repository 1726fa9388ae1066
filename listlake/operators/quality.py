"""Data-quality checks. A check is a query for its failures; none of them changes data.

Every check aggregates before it shuffles, so a value held by a third of all rows arrives as one
row per task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from listlake.schemas import CHECK_RESULTS


def group_having(df: DataFrame, columns: list[str], more_than: int = 1) -> DataFrame:
    """Key tuples occurring more than ``more_than`` times, with their count ``n``."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than)


def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once; NULLs are not looked at."""
    return group_having(df.where(F.col(column).isNotNull()), [column])


def dq_unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Tuples occurring more than once; NULL equals NULL here."""
    return group_having(df, columns)


def dq_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, failures)`` for all columns from a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures"))
                  for c in columns]
            )
        )
    )


def dq_relationships(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child keys without a parent and the number ``n`` of child rows holding them.

    Both sides are reduced to distinct keys before they meet, so neither a popular child key nor
    copies in the parent load one task.
    """
    keys = (
        child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    )
    parents = parent.select(F.col(parent_key).alias(key)).distinct()
    return keys.join(parents, key, "left_anti")


def max_loaded_at(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max_loaded_at"))


def dq_freshness(
    df: DataFrame,
    column: str,
    as_of: date | datetime,
    warn_days: int = 2,
    error_days: int = 4,
) -> DataFrame:
    """Age of the newest row at ``as_of``: pass, warn or error. No row at all is an error."""
    newest = F.col("max_loaded_at").cast("timestamp_ntz")
    now = F.lit(as_of.isoformat()).cast("timestamp_ntz")

    def older_than(days: int):
        return newest < now - F.make_dt_interval(days=F.lit(days))

    return max_loaded_at(df, column).select(
        "max_loaded_at",
        F.when(newest.isNull() | older_than(error_days), "error")
        .when(older_than(warn_days), "warn")
        .otherwise("pass")
        .alias("status"),
    )


# ---------------------------------------------------------------------------------- check suites


@dataclass(frozen=True)
class Check:
    kind: str  # unique, not_null, relationships, unique_combination, freshness
    table: str
    columns: tuple[str, ...]
    parent: str | None = None
    parent_key: str | None = None
    warn_days: int = 2
    error_days: int = 4

    @property
    def label(self) -> str:
        return ",".join(self.columns)


@dataclass
class Suite:
    """Checks declared table by table."""

    checks: list[Check] = field(default_factory=list)

    def unique(self, table: str, *columns: str) -> Suite:
        self.checks += [Check("unique", table, (c,)) for c in columns]
        return self

    def not_null(self, table: str, *columns: str) -> Suite:
        self.checks += [Check("not_null", table, (c,)) for c in columns]
        return self

    def relationships(self, table: str, column: str, parent: str, parent_key: str) -> Suite:
        self.checks.append(Check("relationships", table, (column,), parent, parent_key))
        return self

    def freshness(self, table: str, column: str, warn_days: int = 2, error_days: int = 4) -> Suite:
        self.checks.append(Check("freshness", table, (column,), warn_days=warn_days, error_days=error_days))
        return self

    def unique_combination(self, table: str, *columns: str) -> Suite:
        self.checks.append(Check("unique_combination", table, columns))
        return self


def _result(kind: str, table: str, columns, failures, status=None) -> list:
    return [
        F.lit(kind).alias("check_type"),
        F.lit(table).alias("table_name"),
        columns.alias("column_names"),
        failures.cast("bigint").alias("failures"),
        (F.when(failures > 0, "fail").otherwise("pass") if status is None else status).alias("status"),
    ]


def _rows(numbers: DataFrame, checks: list[Check], family: list[str]) -> DataFrame:
    """Result rows from one row of failure counts ``f0``, ``f1``, ..."""
    results = [
        F.struct(*_result(c.kind, c.table, F.lit(c.label), F.coalesce(F.col(f), F.lit(0))))
        for c, f in zip(checks, family, strict=True)
    ]
    return numbers.select(F.inline(F.array(*results)))


def _numbered(checks: list[Check]) -> list[str]:
    return [f"f{i}" for i in range(len(checks))]


def _repeated(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Unique and combination checks of one table: its keys are expanded once, one grouping set a check,
    and counted by one aggregate."""
    columns = list(dict.fromkeys(c for check in checks for c in check.columns))
    sets = list(dict.fromkeys(tuple(sorted(check.columns, key=columns.index)) for check in checks))
    if len(sets) == 1:
        counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n rows")).withColumn("set", F.lit(0))
    else:
        counted = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns])
        counted = counted.agg(F.count(F.lit(1)).alias("n rows"), F.grouping_id().alias("set"))

    def number(group: tuple[str, ...]) -> int:
        # A bit is set for every column that is not part of the grouping set.
        return sum(1 << i for i, c in enumerate(reversed(columns)) if c not in group) if len(sets) > 1 else 0

    def failures(check: Check):
        group = tuple(sorted(check.columns, key=columns.index))
        failed = (F.col("set") == number(group)) & (F.col("n rows") > 1)
        # A unique column may hold many NULLs; in a combination NULL equals NULL.
        return F.count_if(failed & F.col(check.columns[0]).isNotNull() if check.kind == "unique" else failed)

    names = _numbered(checks)
    return _rows(counted.agg(*[failures(c).alias(f) for c, f in zip(checks, names, strict=True)]), checks, names)


def _missing(df: DataFrame, checks: list[Check]) -> DataFrame:
    """NOT NULL checks of one table: one pass, no shuffle but a row a task."""
    names = _numbered(checks)
    counts = [F.count_if(F.col(c.columns[0]).isNull()).alias(f) for c, f in zip(checks, names, strict=True)]
    return _rows(df.agg(*counts), checks, names)


def _orphans(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """All relationship checks against one parent key.

    The keys of children and parent go into one aggregate that counts a key's rows by child and knows whether
    it is a parent's, so there is no join, and neither a popular key nor copies load one task.
    """
    parent = tables[checks[0].parent].select(F.col(checks[0].parent_key).alias("key"), F.lit(-1).alias("child"))
    children = [
        tables[c.table].select(F.col(c.columns[0]).alias("key"), F.lit(i).alias("child")) for i, c in enumerate(checks)
    ]
    every = reduce(DataFrame.unionByName, children, parent).where(F.col("key").isNotNull())
    names = _numbered(checks)
    counts = [F.count_if(F.col("child") == i).alias(f) for i, f in enumerate(names)]
    keys = every.groupBy("key").agg(F.max(F.col("child") == -1).alias("known"), *counts)
    return _rows(keys.where(~F.col("known")).agg(*[F.sum(f).alias(f) for f in names]), checks, names)


def run_checks(
    tables: dict[str, DataFrame], checks: list[Check], as_of: date | datetime | None = None
) -> DataFrame:
    """One result row per check.

    A table is read once for all its unique and combination checks, once for all its NOT NULL checks, and
    once for each parent that its keys are held against. Freshness is judged at ``as_of``; its status may also be
    ``warn`` or ``error``, either of which is one failure.
    """
    parts = []
    families: dict[tuple, list[Check]] = {}
    for check in checks:
        if check.kind == "freshness":
            if as_of is None:
                raise ValueError("freshness needs as_of")
            fresh = dq_freshness(tables[check.table], check.columns[0], as_of, check.warn_days, check.error_days)
            stale = (F.col("status") != "pass").cast("int")
            parts.append(fresh.select(*_result(check.kind, check.table, F.lit(check.label), stale, F.col("status"))))
        elif check.kind == "relationships":
            families.setdefault(("parent", check.parent, check.parent_key), []).append(check)
        elif check.kind in ("unique", "unique_combination", "not_null"):
            families.setdefault((check.kind == "not_null", check.table), []).append(check)
        else:
            raise ValueError(f"unknown check {check.kind!r}")
    for (kind, *name), family in families.items():
        if kind == "parent":
            parts.append(_orphans(tables, family))
        else:
            parts.append((_missing if kind else _repeated)(tables[name[0]], family))
    return reduce(DataFrame.unionByName, parts).select(*CHECK_RESULTS.names)


def append_results(results: DataFrame, path: str, run_id: str, checked_at: datetime) -> dict:
    """Append a suite's results to the monitoring table and report how many failed.

    The counts come from the write itself; the checks run once.
    """
    seen = Observation()
    stamped = results.select(
        F.lit(run_id).alias("run_id"),
        F.lit(checked_at).alias("checked_at"),
        *CHECK_RESULTS.names,
    ).observe(
        seen,
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") != "pass").alias("failed"),
    )
    # A suite has tens of rows: one file per run.
    stamped.coalesce(1).write.mode("append").parquet(path)
    return seen.get
