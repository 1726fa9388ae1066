"""Keyed upsert: matched rows are replaced, new ones added, all others kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listlake.operators.joins import unused


class DuplicateKeyError(ValueError):
    """The source of an upsert holds a key more than once, or a NULL key."""


def last_per_key(source: DataFrame, key: str, order: list[str], nulls: bool = True) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the other columns, so that the choice is
    the same in every run.

    An aggregate rather than ``row_number``: copies of a hot key collapse inside each task before
    the shuffle. Rows with a NULL key are no copies of each other and all stay; without ``nulls``, for callers that
    allow none, they are like any other key, and the source is read once and not twice.
    """
    rest = [c for c in source.columns if c != key and c not in order]
    row = F.struct(*[c for c in order if c != key], *rest)
    some = source.where(F.col(key).isNotNull()) if nulls else source
    keyed = some.groupBy(key).agg(F.max(row).alias("_row"))
    out = keyed.select(key, "_row.*").select(*source.columns)
    return out.unionByName(source.where(F.col(key).isNull())) if nulls else out


def check_keys(source: DataFrame, key: str) -> None:
    """Raise when a key is NULL."""
    missing = source.where(F.col(key).isNull()).count()
    if missing:
        raise DuplicateKeyError(f"{missing} rows have a NULL {key}")


def check_source(source: DataFrame, key: str) -> None:
    """Raise when a key is NULL or occurs twice."""
    bad = (
        source.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col(key).isNull() | (F.col("n") > 1))
        .agg(F.count(F.lit(1)).alias("keys"), F.min(key).alias("example"))
        .first()
    )
    if bad["keys"]:
        raise DuplicateKeyError(
            f"{bad['keys']} {key} values are NULL or not unique, e.g. {bad['example']!r}"
        )


def marked_keys(source: DataFrame, key: str, day: str, repeated: bool = True) -> DataFrame:
    """``(key, day, bad)``: each different key with a day of its, and whether it is NULL or (with ``repeated``)
    not unique, so that whoever reads the keys can count the faults."""
    n = F.count(F.lit(1))
    bad = (F.col(key).isNull() | (n > 1)) if repeated else F.col(key).isNull()
    return source.groupBy(key).agg(F.max(day).alias(day), bad.cast("int").alias(unused("bad", source)))


def dedupe_source(
    source: DataFrame, key: str, on_duplicate: str = "error", order: list[str] | None = None, check: bool = True
) -> DataFrame:
    """Guard the merge rule "one source row per key". Without ``check`` the caller does it, a NULL key included."""
    if on_duplicate == "error":
        if check:
            check_source(source, key)
        return source
    if on_duplicate == "last":
        if check:
            check_keys(source, key)
        return last_per_key(source, key, order or [], nulls=False)
    raise ValueError(f"unknown on_duplicate {on_duplicate!r}")


def upsert_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Content of ``target`` after merging ``source``, which holds each key once.

    Only the source's key column takes part in the join.
    """
    kept = target.join(source.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))
