"""Column -> Column helpers. All of them stay inside the JVM unless noted.

Text that was scraped is never trusted: every parse is a ``try_*`` form, so one bad value becomes
NULL under ANSI mode instead of failing the job. A failing ``try_*`` throws and catches inside, which
costs ten times a good value, so text that cannot parse is turned into NULL before it gets there.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors get the UDFs of this module by value, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The characters str.strip() removes.
BLANKS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

FIRST_DIGITS = r"(\d+)"
DAYS_PER_WEEK = r"週(\d+)日"
FULL_WIDTH = "０１２３４５６７８９"
JP_DATE = "y'年'M'月'd'日'"
JP_DATE_SHAPE = r"\A[0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日\z"
BASE64_SHAPE = r"\A[A-Za-z0-9+/\s]*=*\s*\z"
JST = "+09:00"


def md5_key(c: Column) -> Column:
    """Surrogate key: lower-case hex md5 of the UTF-8 text; NULL stays NULL."""
    return F.md5(c)


def split_lines(c: Column) -> Column:
    """Newline-separated list -> array. Blank elements are kept and nothing is trimmed."""
    return F.split(c, "\n")


def regex_int(c: Column, pattern: str = FIRST_DIGITS) -> Column:
    """First capture of ``pattern`` as BIGINT; NULL on no match or overflow."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).try_cast("bigint")


def days_per_week(c: Column) -> Column:
    return regex_int(c, DAYS_PER_WEEK)


def digits_to_int(c: Column) -> Column:
    """All decimal digits of the text joined and read as one BIGINT; NULL when there are none.

    Full-width digits count too.
    """
    digits = F.nullif(F.regexp_replace(c, "[^0-9０-９]+", ""), F.lit(""))
    return F.translate(digits, FULL_WIDTH, "0123456789").try_cast("bigint")


def trim_text(c: Column) -> Column:
    """Strip every Unicode blank from both ends, not only U+0020."""
    return F.btrim(c, F.lit(BLANKS))


def strip_prefix(c: Column, length: int = 6) -> Column:
    """Drop the first ``length`` characters (the label in front of a listing date)."""
    return F.substr(c, F.lit(length + 1))


def parse_jp_date(c: Column) -> Column:
    """``2024年3月1日`` -> DATE; NULL when the text is not such a date."""
    text = F.translate(c, FULL_WIDTH, "0123456789")
    return F.try_to_date(F.when(text.rlike(JP_DATE_SHAPE), text), JP_DATE)


def jst_date(ts: Column, source_zone: str = "UTC") -> Column:
    """Civil date in Japan (UTC+9, no DST) of a TIMESTAMP_NTZ holding ``source_zone`` time."""
    return F.to_date(F.convert_timezone(F.lit(source_zone), F.lit(JST), ts))


def jst_yesterday(ts: Column, source_zone: str = "UTC") -> Column:
    return F.date_sub(jst_date(ts, source_zone), 1)


def jst_today_now() -> Column:
    return F.to_date(F.convert_timezone(None, F.lit(JST), F.current_timestamp()))


def date_to_partition(d: Column) -> Column:
    """DATE -> ``yyyyMMdd`` text used in day-partition paths."""
    return F.date_format(d, "yyyyMMdd")


def base64_json(c: Column, field: str) -> Column:
    """One field of a base64-encoded JSON object; NULL if either layer is malformed."""
    plausible = F.when(c.rlike(BASE64_SHAPE), c)
    text = F.try_to_binary(plausible, F.lit("base64")).cast("string")
    return F.get_json_object(text, f"$.{field}")


def ledger_json(message_id: Column, processed_at: Column, metadata: Column) -> Column:
    """The stored form of one processed message."""
    return F.to_json(
        F.struct(
            message_id.alias("message_id"),
            processed_at.alias("processed_at"),
            F.coalesce(metadata, F.create_map().cast("map<string,string>")).alias("metadata"),
        )
    )


@F.pandas_udf(T.StringType())
def _urljoin(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for bases, links in batches:
        yield pd.Series(
            [
                None if link is None or base is None else urljoin(base, link)
                for base, link in zip(bases, links)
            ],
            dtype=object,
        )


def resolve_url(base: Column, link: Column, rooted_only: bool = False) -> Column:
    """Absolute form of ``link`` seen from ``base``.

    ``http…`` links pass through and ``/path`` links are appended to scheme and host, both in the
    JVM. Every other form (``../x``, ``?q``, ``//host``) needs RFC 3986 resolution in an Arrow UDF,
    which then receives only those links. ``rooted_only=True`` leaves the UDF out of the plan where
    the caller knows that links are absolute or rooted.
    """
    absolute = F.startswith(link, F.lit("http"))
    # Empty, ``.`` and ``..`` segments get collapsed, so such links are not plain rooted paths.
    rooted = F.startswith(link, F.lit("/")) & ~link.rlike(r"//|/\.\.?(?:/|\z)|[\t\n\r;#?]")
    origin = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    native = F.when(absolute, link).when(rooted & (origin != ""), F.concat(origin, link))
    if rooted_only:
        return native
    return F.coalesce(native, _urljoin(base, F.when(native.isNull(), link)))
