"""Multi-valued attributes: an array column becomes a dimension and a bridge.

One factory serves languages, tools and frameworks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listlake.functions.scalars import md5_key
from listlake.operators.joins import left_join_many, left_join_unique, unnest


@dataclass(frozen=True)
class Attribute:
    """``array`` holds the values; ``id``/``value`` name the dimension's columns."""

    array: str
    id: str
    value: str


def dimension(df: DataFrame, attr: Attribute) -> DataFrame:
    """Distinct values with their key.

    Copies collapse before the shuffle (partial aggregate), and the key is hashed once per distinct
    value rather than once per element.
    """
    values = unnest(df, attr.array, attr.value, keep=[]).distinct()
    return values.select(md5_key(F.col(attr.value)).alias(attr.id), attr.value)


def bridge(df: DataFrame, key: str, attr: Attribute) -> DataFrame:
    """One row per list element, repeated elements included. Narrow: no shuffle."""
    return unnest(df, attr.array, "_v", keep=[key]).select(key, md5_key(F.col("_v")).alias(attr.id))


def join_bridge_dim(
    bridge_df: DataFrame, dim: DataFrame, attr: Attribute, hot: dict | list | None = None
) -> DataFrame:
    """Bridge rows with their value. A popular value (a language in a third of all listings) is a
    hot key of the bridge and is joined apart."""
    return left_join_unique(bridge_df, dim, attr.id, hot)


def join_fact_multivalue(
    fact: DataFrame, key: str, sides: list[DataFrame], hot: list[dict] | None = None
) -> DataFrame:
    """Fact LEFT JOIN every side on the key: the product of a key's lists, one NULL row for none.

    ``fact`` holds each key once. A key with very long lists is hot from the first join that
    multiplies it onwards, so the hot keys are carried along the chain. ``hot`` has those of each side, if
    they are known; an empty one states there are none.
    """
    out, carried = fact, {}
    for i, side in enumerate(sides):
        out, carried = left_join_many(out, side, key, carried, None if hot is None else hot[i])
    return out


def explode_product(df: DataFrame, attrs: list[Attribute], with_id: bool = True) -> DataFrame:
    """The same rows straight from the arrays, without bridge, dimension, join or shuffle.

    Equal to joining bridges and dimensions when the row key is unique.
    """
    for attr in attrs:
        # A value column may reuse its array's name, so the array moves aside first.
        df = df.withColumnRenamed(attr.array, f"_array_{attr.id}")
    for attr in attrs:
        df = df.select(
            *[c for c in df.columns if c != f"_array_{attr.id}"],
            F.explode_outer(f"_array_{attr.id}").alias(attr.value),
        )
        if with_id:
            df = df.withColumn(attr.id, md5_key(F.col(attr.value)))
    return df
