"""Equi joins that hold up when one key carries a large share of the rows.

Rules used here:

* a side is broadcast only when its row count has a bound that does not grow with data, such as a
  calendar built from fixed dates;
* rows of hot keys, and rows whose key is NULL, are dealt out over many tasks, and just the few
  matching rows of the other side are repeated;
* which keys are hot only steers the plan. Results are the same for any list of hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.01
HOT_LIMIT = 200  # at most 1 / HOT_SHARE keys can pass, doubled for the sketch's rounding
HOT_ROWS = 1_000  # fewer rows than this are no burden for a task
TRACKED = 20_000
SALTS = 64  # slots of a key that is only said to be hot
SLOT_SHARE = 4  # slots that make up the rows of an average partition
MOST_SLOTS = 4096
GRID = 8  # cells along one side for a key that is hot on both
BROADCAST_ROWS = 100_000


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores in front until no column of the frames has it, whatever its case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, rows: int | None = None) -> dict:
    """Keys holding at least ``share`` of the rows, and at least ``rows`` (``HOT_ROWS`` by default), each with
    the number of slots that its rows are worth; None stands for NULL.

    One pass over the key column with a frequent-items sketch: its state is of fixed size, nothing
    is shuffled but one sketch per task, and at most ``HOT_LIMIT`` keys reach the driver. A slot is a
    quarter of an average partition, so that slots that meet in one task make no large one.
    """
    top, total, nulls = df.agg(
        F.expr(f"approx_top_k(`{key}`, {HOT_LIMIT}, {TRACKED})"),
        F.count(F.lit(1)),
        F.count_if(F.col(key).isNull()),
    ).first()
    floor = max(share * total, HOT_ROWS if rows is None else rows)
    counts = {e["item"]: e["count"] for e in top or [] if e["item"] is not None and e["count"] >= floor}
    if nulls >= floor:
        counts[None] = nulls
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return {k: min(MOST_SLOTS, max(2, -(-SLOT_SHARE * parts * n // total))) for k, n in counts.items()}


def _is_hot(key: str, hot) -> Column:
    known = [k for k in hot if k is not None]
    found = F.coalesce(F.col(key).isin(known), F.lit(False)) if known else F.lit(False)
    return found | F.col(key).isNull() if None in hot else found


def _deal(df: DataFrame) -> Column:
    """A number for every row. Copies of a row in different partitions get different ones, and a task
    that is run again deals the same way, which a random number would not."""
    return F.xxhash64(F.spark_partition_id(), *df.columns)


def _slots(hot, key) -> int:
    return hot[key] if isinstance(hot, dict) else SALTS


def _of_key(key: str, slots: dict) -> Column:
    """The number given to the key, 1 for all others. Keys with one number are asked for together."""
    number = F.lit(1)
    for n in sorted({n for n in slots.values() if n > 1}):
        number = F.when(_is_hot(key, [k for k, m in slots.items() if m == n]), n).otherwise(number)
    return number.cast("bigint")


def _up_to(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))


def _join_unique(
    left: DataFrame, right: DataFrame, key: str, how: str, hot
) -> DataFrame:
    if hot is None:
        hot = hot_keys(left, key)
    if not hot:
        return left.join(right, key, how)
    slots = _of_key(key, {k: _slots(hot, k) for k in hot})
    salt = unused("salt", left, right)
    dealt = left.withColumn(salt, F.pmod(_deal(left), slots))
    # At most HOT_LIMIT rows are repeated, as the right side holds a key once.
    repeated = right.withColumn(salt, _up_to(slots))
    return dealt.join(repeated, [key, salt], how).drop(salt)


def left_join_unique(
    left: DataFrame, right: DataFrame, key: str, hot: dict | list | None = None
) -> DataFrame:
    """``left`` LEFT JOIN ``right`` where ``right`` holds each key once.

    One pass over either side. ``hot=None`` looks for hot keys first; ``hot=[]`` states there are
    none, as for a primary key.
    """
    return _join_unique(left, right, key, "left", hot)


def anti_join(
    left: DataFrame, right: DataFrame, key: str, hot: dict | list | None = None
) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right``; NULL keys stay.

    The right side is reduced to distinct keys first, so copies there do not travel. ``hot`` is as
    in :func:`left_join_unique`.
    """
    return _join_unique(left, right.select(key).distinct(), key, "left_anti", hot)


def left_join_bounded(
    left: DataFrame, right: DataFrame, condition, max_rows: int | None
) -> DataFrame:
    """LEFT JOIN with a side whose size follows from fixed arguments, e.g. a calendar's days.

    ``max_rows`` is that bound; beyond ``BROADCAST_ROWS``, or without one, there is no hint.
    """
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        right = F.broadcast(right)
    return left.join(right, condition, "left")


def left_join_many(
    left: DataFrame, right: DataFrame, key: str, hot_left=(), hot_right: dict | list | None = None
) -> tuple[DataFrame, dict]:
    """``left`` LEFT JOIN ``right`` where a key may be frequent on either side.

    Returns the join and the keys that are hot in it, for the next join of a chain. One join, one
    pass over either side: each row of a hot key belongs to a cell of a grid of tasks, one way by the
    left row and the other by the right one; the rows of either side are copied along the other's axis.
    Cold keys have a grid of one cell. ``hot_left`` names the keys frequent on the left (none by
    default: a fact unique by key); ``hot_right`` is looked for unless it is given.
    """
    if hot_right is None:
        hot_right = hot_keys(right, key)
    on_left = {k: _slots(hot_left, k) for k in hot_left}
    on_right = {k: _slots(hot_right, k) for k in hot_right if k is not None}
    if not (on_left or on_right):
        return left.join(right, key, "left"), {}
    for k in on_left.keys() & on_right.keys():  # either side is copied so many times
        on_left[k], on_right[k] = min(on_left[k], GRID), min(on_right[k], GRID)
    # NULL keys match nothing, so they are dealt out wherever they are many.
    rows = _of_key(key, {None: SALTS, **on_left})
    columns = _of_key(key, on_right)
    row, col, cols, hit = (unused(n, left, right) for n in ("row", "col", "cols", "hit"))
    few_left = left.withColumns({row: F.pmod(_deal(left), rows), cols: columns}).withColumn(col, _up_to(F.col(cols)))
    few_right = right.where(F.col(key).isNotNull()).withColumns({col: F.pmod(_deal(right), columns), hit: F.lit(True)})
    few_right = few_right.withColumn(row, _up_to(rows))
    joined = few_left.join(few_right, [key, row, col], "left")
    # A key the sketch found on the right is there, so a copy without a partner is in another cell whole.
    joined = joined.where((F.col(cols) == 1) | F.col(hit)).drop(row, col, cols, hit)
    return joined, {**on_right, **on_left}


def unnest(
    df: DataFrame, array, value: str, keep: list[str] | None = None, pos: str | None = None
) -> DataFrame:
    """One row per array element; rows with a NULL or empty array give none.

    ``keep`` lists the other columns (all by default); ``pos`` names the element's position, from 0.
    The outer generator with a filter on the position is deliberate: for an inner one the optimizer
    adds a "size > 0" filter and pushes it down to the scan, computing the array twice.
    """
    keep = df.columns if keep is None else keep
    index = pos or unused("pos", df)
    rows = df.select(*keep, F.posexplode_outer(array).alias(index, value))
    rows = rows.where(F.col(index).isNotNull())
    return rows.withColumn(pos, F.col(pos).cast("bigint")) if pos else rows.drop(index)
