"""Records from HTML columns in one pass over each page.

An :class:`Extract` says which elements are records and what belongs to one. ``extract`` compiles a few of them
into one automaton: while the standard-library parser reads a page, selectors are matched against the start tag at
hand and the state that open elements have left, so no element is looked at twice and no list of elements
is built. An Arrow UDF returns the records as arrays, ready to be unnested; the other columns of the
table stay in the JVM. Time is linear in the page. Output is too, unless texts of nested elements are asked
for: then it is as long as those texts are together.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Executors get the UDFs of this module by value, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN_TAGS = frozenset(("script", "style", "template"))
TEXT = "text"
#: Bytes of pages that are read at a time.
PIECE = 1 << 20


@dataclass(frozen=True)
class Selector:
    """An element by tag, by one of its classes, or by both."""

    tag: str | None = None
    cls: str | None = None

    def __post_init__(self) -> None:
        if not (self.tag or self.cls):
            raise ValueError("a selector needs a tag or a class")

    def matches(self, tag: str, classes: list[str]) -> bool:
        return self.tag in (None, tag) and (self.cls is None or self.cls in classes)


@dataclass(frozen=True)
class Field:
    """A value of a record: text or an attribute of the element itself, or of the first one inside it that
    ``of`` names."""

    name: str
    of: Selector | None = None
    value: str = TEXT
    strip: bool = True


@dataclass(frozen=True)
class Extract:
    """Every element that the last selector of ``scope`` names is a record.

    Selectors before it narrow the search, each to the first such element within the one before. ``most`` ends it
    after so many records; ``whole`` leaves out records with a missing field.
    """

    scope: tuple[Selector, ...]
    fields: tuple[Field, ...]
    most: int | None = None
    whole: bool = False

    @property
    def type(self) -> str:
        return f"array<struct<{','.join(f'{f.name}:string' for f in self.fields)}>>"

    @property
    def arrow(self) -> pa.DataType:
        return pa.list_(pa.struct([(f.name, pa.string()) for f in self.fields]))


class _Span:
    """The two ends of an element's text in the page's."""

    __slots__ = ("start", "end")

    def __init__(self, start: int) -> None:
        self.start, self.end = start, None


class _Record:
    __slots__ = ("values", "open")

    def __init__(self, n: int) -> None:
        self.values: list = [None] * n
        self.open = True


class _Search:
    """One extract's state: the step of its scope, and records that still lack a field."""

    __slots__ = ("given", "step", "over", "records", "lacking", "inner")

    def __init__(self, given: Extract) -> None:
        self.given, self.step, self.over = given, 0, False
        self.records: list[_Record] = []
        self.lacking: list[list[_Record]] = [[] for _ in given.fields]
        self.inner = [(i, f) for i, f in enumerate(given.fields) if f.of is not None]


class _Reader(HTMLParser):
    """Runs the searches over a page, closing tags the way a browserless tree does: an end tag closes its
    nearest open start tag and everything opened after it.

    Text is kept once for the page while an element whose text is wanted is open. Text below a script,
    style or template does not count.
    """

    def __init__(self, extracts: list[Extract]) -> None:
        super().__init__(convert_charrefs=True)
        self.searches = [_Search(e) for e in extracts]
        named = [s for e in extracts for s in (*e.scope, *(f.of for f in e.fields if f.of is not None))]
        self.tags = frozenset(s.tag for s in named if s.cls is None)
        self.classes = frozenset(s.cls for s in named if s.cls is not None)
        self.stack: list[tuple[str, list | None]] = []
        self.open: Counter[str] = Counter()
        self.parts: list[str] = []
        self.wanted = self.length = self.hidden = 0

    def parse_html_declaration(self, i):
        # ``<![`` opens a marked section; on a page it is text that nothing should stumble over.
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def handle_starttag(self, tag, attrs):
        ends = None
        values = dict(attrs)
        classes = (values.get("class") or "").split() if self.classes else []
        if tag in self.tags or (classes and not self.classes.isdisjoint(classes)):
            ends = self._matched(tag, classes, values)
        self.stack.append((tag, ends))
        self.open[tag] += 1
        self.hidden += tag in HIDDEN_TAGS
        if tag in VOID_TAGS:
            self._close()

    def _matched(self, tag: str, classes: list[str], attributes: dict) -> list | None:
        """What has to be ended with this element: spans, records and searches that it took a step of."""
        ends: list = []
        span = None
        for search in self.searches:
            if search.over:
                continue
            given, last = search.given, len(search.given.scope) - 1
            for i, field in search.inner:
                if search.lacking[i] and field.of.matches(tag, classes):
                    takers = [r for r in search.lacking[i] if r.open]
                    search.lacking[i] = []
                    if takers and field.value == TEXT and span is None:
                        span = self._span(ends)
                    for record in takers:
                        record.values[i] = span if field.value == TEXT else attributes.get(field.value)
            if not given.scope[search.step].matches(tag, classes):
                continue
            if search.step < last:
                search.step += 1
                ends.append(search)
                continue
            if given.most is not None and len(search.records) >= given.most:
                continue
            record = _Record(len(given.fields))
            search.records.append(record)
            ends.append(record)
            for i, field in enumerate(given.fields):
                if field.of is not None:
                    search.lacking[i].append(record)
                elif field.value == TEXT:
                    span = span or self._span(ends)
                    record.values[i] = span
                else:
                    record.values[i] = attributes.get(field.value)
        return ends or None

    def _span(self, ends: list) -> _Span:
        span = _Span(self.length)
        ends.append(span)
        self.wanted += 1
        return span

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in VOID_TAGS and self.open[tag]:
            while self._close() != tag:
                pass

    def handle_data(self, data):
        if not self.hidden and self.wanted:
            self.parts.append(data)
            self.length += len(data)

    def _close(self) -> str:
        tag, ends = self.stack.pop()
        self.open[tag] -= 1
        self.hidden -= tag in HIDDEN_TAGS
        for end in ends or ():
            if isinstance(end, _Span):
                end.end = self.length
                self.wanted -= 1
            elif isinstance(end, _Record):
                end.open = False
            else:  # nothing after the first element of a step counts
                end.over = True
        return tag

    def finish(self) -> list[list[tuple]]:
        self.close()
        while self.stack:
            self._close()
        page = "".join(self.parts)

        def value(field: Field, found):
            if isinstance(found, _Span):
                found = page[found.start : found.end]
            return found.strip() if found is not None and field.strip and field.value == TEXT else found

        out = []
        for search in self.searches:
            fields = search.given.fields
            rows = (tuple(map(value, fields, r.values)) for r in search.records)
            out.append([r for r in rows if not (search.given.whole and None in r)])
        return out


def read_page(page: str, extracts: list[Extract]) -> list[list[tuple]] | None:
    """The records of each extract; None for a page that the parser gives up on."""
    reader = _Reader(extracts)
    try:
        reader.feed(page)
        return reader.finish()
    except AssertionError:
        return None


def pieces(pages: pa.Array, most: int = PIECE) -> Iterator[pa.Array]:
    """The pages in order, so many at a time as have ``most`` bytes together, or one."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(pages):
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield pages.slice(start, end - start)
        start = end


def read_pages(batches: Iterator[pa.Array], extracts: dict[str, Extract]) -> Iterator[pa.Array]:
    """A struct of records per page. Of a batch no more than a piece is held as Python's strings and records,
    which take several times the memory of the pages."""
    names, given = list(extracts), list(extracts.values())

    def arrays(pages: list[list[list[tuple]] | None]) -> pa.Array:
        columns = []
        for i, one in enumerate(given):
            found = [p[i] if p is not None else [] for p in pages]
            offsets = [0]
            for records in found:
                offsets.append(offsets[-1] + len(records))
            flat = list(zip(*(r for records in found for r in records), strict=True)) or [()] * len(one.fields)
            values = pa.StructArray.from_arrays([pa.array(v, pa.string()) for v in flat], [f.name for f in one.fields])
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values))
        missing = pa.array([p is None for p in pages], pa.bool_())
        return pa.StructArray.from_arrays(columns, names, mask=missing)

    for batch in batches:
        for pages in pieces(batch):
            yield arrays([None if p is None else read_page(p, given) for p in pages.to_pylist()])


def extract(html: Column, extracts: dict[str, Extract]) -> Column:
    """A struct with one array of records per extract; NULL for a NULL or unreadable page."""
    kind = f"struct<{','.join(f'{n}:{e.type}' for n, e in extracts.items())}>"

    @F.arrow_udf(kind)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return read_pages(batches, extracts)

    return read(html)
