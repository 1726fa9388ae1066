"""Page-parsing jobs over a table of pages ``(page_id, url, html)``.

Each operator adds columns or rows by narrow transformations only: no shuffle, one read of ``html``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listlake.functions.html import Extract, Field, Selector, extract
from listlake.functions.scalars import digits_to_int, parse_jp_date, strip_prefix
from listlake.operators.joins import unnest, unused
from listlake.operators.upsert import last_per_key
from listlake.schemas import BASIC_FIELDS, DETAIL_LABELS, DETAIL_ROWS

# Class names of the page format.
TITLE = Selector(cls="job-Title")
DATE = Selector(cls="time-Stamp")
LINK_BOX = Selector(cls="detail-Btn02")
BASIC_BOX = Selector(cls="job-Box")

ANCHOR = Selector(tag="a")


def texts(selector: Selector) -> Extract:
    """Stripped text of every element the selector names."""
    return Extract((selector,), (Field("value"),))


def links(selector: Selector) -> Extract:
    """``href`` of the first ``a`` inside every element the selector names."""
    return Extract((selector,), (Field("value", ANCHOR, "href"),))


def _values(records: Column) -> Column:
    return records["value"]


def _added(pages: DataFrame, html: str, output: str, one: Extract) -> DataFrame:
    """``pages`` with the records of one extract; no array for a page without text."""
    return pages.withColumn(output, extract(F.col(html), {"records": one})["records"])


def extract_texts(pages: DataFrame, selector: Selector, output: str, html: str = "html") -> DataFrame:
    """Add ``output``: stripped text of every element the selector names, in page order."""
    return _added(pages, html, output, texts(selector)).withColumn(output, _values(F.col(output)))


def extract_titles(pages: DataFrame, selector: Selector = TITLE, **kw) -> DataFrame:
    return extract_texts(pages, selector, "titles", **kw)


def extract_dates(
    pages: DataFrame, selector: Selector = DATE, prefix: int = 6, **kw
) -> DataFrame:
    """Add ``dates``: element texts without their leading label."""
    df = extract_texts(pages, selector, "dates", **kw)
    return df.withColumn("dates", F.transform("dates", lambda t: strip_prefix(t, prefix)))


def extract_links(pages: DataFrame, selector: Selector = LINK_BOX, html: str = "html") -> DataFrame:
    """Add ``links``: the first ``a[href]`` inside every element the selector names."""
    return _added(pages, html, "links", links(selector)).withColumn("links", _values(F.col("links")))


def listings(
    pages: DataFrame,
    output: str = "listings",
    html: str = "html",
    title: Selector = TITLE,
    date: Selector = DATE,
    link: Selector = LINK_BOX,
) -> DataFrame:
    """``html`` replaced by ``output``: the three lists of a page side by side, cut to the shortest.

    NULL for a page without text or one that cannot be read; every other page has an array.
    """
    found = extract(F.col(html), {"title": texts(title), "date": texts(date), "link": links(link)})
    keep = [c for c in pages.columns if c != html]
    lists = pages.select(*keep, found.alias(output))
    parts = [F.col(output)[name] for name in ("title", "date", "link")]
    shortest = F.least(*[F.size(p) for p in parts])
    rows = F.arrays_zip(*[F.slice(_values(p), F.lit(1), shortest).alias(n) for p, n in zip(parts, ("title", "date", "link"))])
    return lists.withColumn(output, F.when(F.col(output).isNotNull(), rows))


def listing_columns(listing: str) -> list[Column]:
    """The columns of a listing from one element of :func:`listings`."""
    row = F.col(listing)
    return [
        row["title"].alias("job_title"),
        parse_jp_date(strip_prefix(row["date"])).alias("listing_start_date"),
        row["link"].alias("detail_link"),
    ]


def parse_list_page(
    pages: DataFrame,
    html: str = "html",
    title: Selector = TITLE,
    date: Selector = DATE,
    link: Selector = LINK_BOX,
) -> DataFrame:
    """One row per listing: the three lists of a page side by side, cut to the shortest.

    Other columns of ``pages`` are kept; a page without listings gives no row.
    """
    keep = [c for c in pages.columns if c != html]
    inner = unused("listing", pages)
    found = listings(pages, inner, html, title, date, link)
    return unnest(found, inner, inner, keep=keep).select(*keep, *listing_columns(inner))


# --------------------------------------------------------------------------------- detail pages

LI = Selector(tag="li")
UL = Selector(tag="ul")
TABLE = Selector(tag="table")
TR, TH, TD = Selector(tag="tr"), Selector(tag="th"), Selector(tag="td")


def list_items(box: Selector, most: int | None = None) -> Extract:
    """Texts of the ``li`` in the first list of the first box."""
    return Extract((box, UL, LI), (Field("value"),), most)


#: Label and value of every row of the first table that has both.
LABEL_VALUES = Extract((TABLE, TR), (Field("label", TH), Field("value", TD)), whole=True)


def positional_fields(pages: DataFrame, box: Selector = BASIC_BOX, html: str = "html") -> DataFrame:
    """Add ``items``: texts of the ``li`` in the first list of the first box.

    Take the i-th with ``F.get("items", i)``, which is NULL where the list is short.
    """
    items = F.coalesce(_values(F.col("items")), F.array().cast("array<string>"))
    return _added(pages, html, "items", list_items(box)).withColumn("items", items)


def label_values(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``pairs``: label and value of every row of the first table."""
    pairs = F.coalesce(F.col("pairs"), F.array().cast(LABEL_VALUES.type))
    return _added(pages, html, "pairs", LABEL_VALUES).withColumn("pairs", pairs)


def pick_labels(pairs: Column, labels: dict[str, str]) -> list[Column]:
    """One column per label: the first value carrying it, NULL where the label is absent."""

    def first_value(label: str) -> Column:
        return F.get(pairs["value"], F.array_position(pairs["label"], label).cast("int") - 1)

    return [first_value(label).alias(name) for label, name in labels.items()]


def pivot_labels(
    rows: DataFrame, keys: list[str], label: str, value: str, order: str, labels: dict[str, str]
) -> DataFrame:
    """The same for long-form input: first value by ``order`` per key and label.

    ``min_by`` combines on the map side, so a hot key sends one row per task, not its whole group.
    """
    wanted = rows.where(F.col(label).isin(list(labels)))

    def first_value(text: str) -> Column:
        hit = F.col(label) == text
        return F.min_by(F.when(hit, F.col(value)), F.when(hit, F.col(order)))

    return wanted.groupBy(*keys).agg(
        *[first_value(text).alias(name) for text, name in labels.items()]
    )


def parse_detail_page(
    pages: DataFrame,
    html: str = "html",
    box: Selector = BASIC_BOX,
    labels: dict[str, str] = DETAIL_LABELS,
) -> DataFrame:
    """One row of 15 fields per page: five list items by position and ten table cells by label."""
    keep = [c for c in pages.columns if c != html]
    inner = unused("found", pages)
    found = extract(F.col(html), {"items": list_items(box, len(BASIC_FIELDS)), "pairs": LABEL_VALUES})
    df = pages.select(*keep, found.alias(inner))
    items = [F.get(_values(F.col(inner)["items"]), F.lit(i)) for i in range(len(BASIC_FIELDS))]
    return df.select(
        *keep,
        digits_to_int(items[0]).alias(BASIC_FIELDS[0]),
        *[item.alias(name) for item, name in zip(items[1:], BASIC_FIELDS[1:])],
        *pick_labels(F.col(inner)["pairs"], labels),
    )


def attach_list_to_detail(
    details: DataFrame, lists: DataFrame, key: str = "detail_link", found: str | None = None
) -> DataFrame:
    """Every listing with the fields of the detail page behind its link.

    A listing without a page has NULL in those fields; ``found`` names a column that tells. Of several
    pages with one link the greatest row counts, so a listing is never multiplied, and listings of a
    hot link can be split by AQE, as the other side has one row for it.
    """
    one = last_per_key(details.where(F.col(key).isNotNull()), key, [])
    if found is not None:
        one = one.withColumn(found, F.lit(True))
    return lists.join(one, key, "left")


# -------------------------------------------------------------------------------------- unions


def union_pages(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_details(frames: list[DataFrame], spark=None, schema=DETAIL_ROWS) -> DataFrame:
    """Rows of all frames, columns by name, absent ones NULL; no frame at all gives an empty result
    that still has its columns."""
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
