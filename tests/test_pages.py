"""Page parsing: values, traps, and pages that are broken in every way."""

import random
import time
import tracemalloc
from datetime import date

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from listlake.functions.html import Extract, Field, Selector, extract, pieces, read_page, read_pages
from listlake.operators import pages as P
from listlake.schemas import DETAIL_ROWS, LIST_ROWS, PAGES

LISTING = (
    '<div class="job-Title">{title}</div><div class="time-Stamp">掲載開始日：{day}</div>'
    '<ul><li class="detail-Btn02"><a href="{link}">詳細</a></li></ul>'
)


def page_table(spark, *htmls):
    return spark.createDataFrame([(i, f"https://h.example.com/{i}", h) for i, h in enumerate(htmls)], PAGES)


def list_page(*listings):
    return "<html><body>" + "".join(
        LISTING.format(title=t, day=d, link=k) for t, d, k in listings
    ) + "</body></html>"


def detail_page(items, cells):
    lis = "".join(f"<li>{i}</li>" for i in items)
    rows = "".join(f"<tr><th>{a}</th><td>{b}</td></tr>" for a, b in cells)
    return f'<div class="job-Box"><ul>{lis}</ul></div><table><tbody>{rows}</tbody></table>'


def test_list_page(spark, rows):
    df = P.parse_list_page(
        page_table(spark, list_page(("倉庫の在庫係", "2023年11月7日", "/o/77")))
    )
    assert rows(df, *LIST_ROWS.names) == [("倉庫の在庫係", date(2023, 11, 7), "/o/77")]


def test_list_page_is_cut_to_the_shortest_list(spark, rows):
    html = list_page(("a", "2024年3月1日", "/1")) + '<div class="job-Title">b</div>' \
        '<div class="time-Stamp">掲載開始日：2024年3月2日</div>'
    empty = "<html><body>no listing</body></html>"
    df = P.parse_list_page(page_table(spark, html, empty, None))
    assert rows(df, *LIST_ROWS.names) == [("a", date(2024, 3, 1), "/1")]


def test_detail_page(spark, rows):
    html = detail_page(
        ["〜314159円", "検査員", "短期", "松本市", "食品"],
        [("案件内容", "瓶の検査"), ("必須スキル", "読み書き"), ("言語", "Ada\nGo"), ("言語", "second")],
    )
    short = detail_page(["応相談", "x"], [("稼働率", " 100% ")])
    df = P.parse_detail_page(page_table(spark, html, short, "<p>nothing</p>"))
    assert [c for c in df.columns if c not in ("page_id", "url")] == DETAIL_ROWS.names
    none = (None,) * 5
    assert rows(df.drop("url")) == sorted(
        [
            (0, 314159, "検査員", "短期", "松本市", "食品", "瓶の検査", "読み書き",
             None, "Ada\nGo", None, None, None, None, None, None),
            (1, None, "x", None, None, None, None, None, None, None, None, None, "100%", None, None, None),
            (2,) + none + none + none,
        ],
        key=repr,
    )


def test_rows_without_both_cells_are_skipped(spark):
    html = "<table><tr><th>言語</th></tr><tr><td>v</td></tr><tr><th>言語</th><td>Go</td></tr></table>"
    pairs = P.label_values(page_table(spark, html)).first()["pairs"]
    assert [tuple(p) for p in pairs] == [("言語", "Go")]


FRAGMENTS = [
    '<div class="job-Title">a &amp; b</div>', '<div class="big job-Title">x<br>y</div>',
    '<div class="job-Title"><div>nested</div> tail</div>', "<div class='job-Title'>single</div>",
    "<p class=job-Title>bare</p>", '<div class="job-Title">open', '<div class="job-Title"><b>bold</b></div>',
    '<!-- <div class="job-Title">hidden</div> -->', '<script>var s=\'<div class="job-Title">js</div>\';</script>',
    '<div class="job-Title">cut &amp</div>', '<div class="job-Title">&amp;lt; &ampx &#38;</div>',
    '<div class="job-Title">&copy; &#12354;</div>', '<div class="job-Titles">other</div>',
    '<h2 class="job-Title">　Wide　</h2>', "job-Title as text", "</div>", "<br/>", "<li><ul>", "plain &lt;x&gt;",
    '<div class="time-Stamp">掲載開始日：2024年3月1日</div>', '<div class="time-Stamp"><i><b>掲載開始日：</b>2024年3月2日</i></div>',
    '<li class="detail-Btn02"><a href="/jobs/1">go</a></li>', '<li class="detail-Btn02"><a href="/j?a=1&amp;b=2">go</a></li>',
    "<li class=\"detail-Btn02\"><a class=\"k\" href='/q'>go</a><a href=\"/second\">2</a></li>",
    '<li class="detail-Btn02">no link</li>', '<li class="detail-Btn02"><span><a href="/deep">x</a></span></li>',
    '<div class="job-Box"><p>t</p><ul><li>1万円</li><li>b</li></ul></div>', '<div class="job-Box"></div>',
    '<div class="job-Box"><ul><li>5円<li>unclosed</ul></div>', "<ul><li>stray</li></ul>",
    "<table><tr><th>言語</th><td>Go</td></tr></table>", "<table><tr><th>稼働率</th><td><p>80%<p>90%</td></tr></table>",
    "<table><thead><tr><th>面談回数</th><td>2回</td></tr></thead><tr><td>only</td></tr></table>",
    "<table><tr><td><table><tr><th>言語</th><td>inner</td></tr></table></td></tr></table>", "<style>p{}</style>",
]


ODD = [
    "<![hello]>", "<![if x]>", "<![CDATA[ <b> ]]>", "<!DOCTYPE [ <x", "<!--", "-->", '<p title="<!-- ">',
    '<div class="job-Title" class="other">x</div>', '<template><div class="job-Title">x</div></template>',
    "<template>", "</script>", "&#x110000;", "<a <b>", "\x00",
]


def test_no_page_ends_the_job(spark):
    rng = random.Random(7)
    pages = page_table(
        spark, *["".join(rng.choices(FRAGMENTS + ODD, k=rng.randint(1, 6))) for _ in range(1500)], *FRAGMENTS, *ODD
    ).repartition(8).persist()
    for read in (P.extract_titles, P.extract_dates, P.extract_links, P.positional_fields, P.label_values, P.parse_detail_page):
        assert read(pages).where("page_id is not null").count() == pages.count()
    assert P.parse_list_page(pages).count() > 0
    pages.unpersist()


@pytest.mark.parametrize(
    ("html", "texts"),
    [
        ("<![hello]><div class='job-Title'>x</div>", ["x"]),
        ("<template><div class='job-Title'>x</div></template><div class='job-Title'>y</div>", ["", "y"]),
        ('<p title="<!-- "><div class="job-Title">x</div><i>--></i>', ["x"]),
        ('<div class="job-Title" class="other">x</div>', []),
        ('<div class="job-Title">a &amp; <b>b</b><br>c<script>d</script></div>', ["a & bc"]),
        ('<div class="job-Title">a<div class="job-Title">b</div>c', ["abc", "b"]),
    ],
)
def test_texts_of_elements(html, texts):
    (found,) = read_page(html, [Extract((Selector(cls="job-Title"),), (Field("t", strip=False),))])
    assert [t for (t,) in found] == texts


def test_many_unclosed_elements_are_kept(spark):
    labels = [f"k{i}" for i in range(700)]
    cells = "".join(f"<tr><th>{a}</th><td>v{a}</td>" for a in labels)
    items = "".join(f"<li class='detail-Btn02'><a href='/{i}'>あ{i}</a>" for i in range(700))
    pages = page_table(spark, f'<div class="job-Box"><nav><ul>{items}</ul></nav></div><table>{cells}<tr><th>言語</th><td>Go</td></table>')
    texts = P.positional_fields(pages).first()["items"]
    assert len(texts) == 700 and texts[0] == "".join(f"あ{i}" for i in range(700)) and texts[-1] == "あ699"
    assert [tuple(p) for p in P.label_values(pages).first()["pairs"]] == [*((a, f"v{a}") for a in labels), ("言語", "Go")]
    assert P.extract_links(pages).first()["links"] == [f"/{i}" for i in range(700)]
    row = P.parse_detail_page(pages, labels={"言語": "language"}).first()
    assert row["language"] == "Go" and row["occupation"].endswith("あ699")


@pytest.mark.parametrize("kind", ["titles", "links", "items", "pairs", "unclosed"])
def test_time_grows_with_the_page(kind):
    """Twice the elements take about twice the time, as the best of three runs."""
    page = {
        "titles": '<div class="job-Title">x y</div>', "links": '<li class="detail-Btn02"><a href="/1">go</a></li>',
        "items": "<li>a b</li>", "pairs": "<tr><th>k</th><td>v</td></tr>", "unclosed": '<tr><div class="job-Title"><li class="detail-Btn02">',
    }[kind]
    reads = [P.texts(P.TITLE), P.links(P.LINK_BOX), P.list_items(P.BASIC_BOX), P.LABEL_VALUES]
    reads = [reads[2], P.links(P.LINK_BOX)] if kind == "unclosed" else reads

    def seconds(n):
        html, best = f'<div class="job-Box"><ul>{page * n if kind != "pairs" else ""}</ul></div><table>{page * n}</table>', 1e9
        for _ in range(3):
            start = time.perf_counter()
            read_page(html, reads)
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(16_000) <= 2.2 * seconds(8_000) + 0.05


def test_many_open_elements_take_linear_time():
    start = time.perf_counter()
    boxes = Extract((Selector(cls="job-Title"),), (Field("k", value="id"), Field("first", Selector(tag="b"))))
    (found,) = read_page('<div class="job-Title" id=1>' * 100_000 + "<b>x</b>" + "</i>" * 100_000, [boxes])
    assert found == [("1", "x")] * 100_000 and time.perf_counter() - start < 20


def slow_records(page, one):
    """The same by searching a tree: every element with its descendants."""
    from html.parser import HTMLParser

    tree, stack = [], []

    class Tree(HTMLParser):
        def handle_starttag(self, tag, attrs):
            values = dict(attrs)
            tree.append({"tag": tag, "cls": (values.get("class") or "").split(), "attrs": values, "in": [i for i, _ in stack], "text": ""})
            if tag not in ("br", "img"):
                stack.append((len(tree) - 1, tag))

        def handle_endtag(self, tag):
            if tag in [t for _, t in stack]:
                while stack.pop()[1] != tag:
                    pass

        def handle_data(self, data):
            for i, _ in stack:
                tree[i]["text"] += data

    Tree().feed(page)
    named = lambda s, below: [i for i, e in enumerate(tree) if s.matches(e["tag"], e["cls"]) and (below is None or below in e["in"])]
    below = None
    for step in one.scope[:-1]:
        hit = named(step, below)[:1]
        if not hit:
            return []
        below = hit[0]
    out = []
    for i in named(one.scope[-1], below)[: one.most]:
        row = []
        for f in one.fields:
            hit = [i] if f.of is None else named(f.of, i)[:1]
            value = None if not hit else tree[hit[0]]["text"] if f.value == "text" else tree[hit[0]]["attrs"].get(f.value)
            row.append(value.strip() if value is not None and f.strip and f.value == "text" else value)
        out.append(tuple(row))
    return [r for r in out if not (one.whole and None in r)]


def test_records_equal_a_search_in_the_tree():
    rng = random.Random(3)
    pieces = ["<div class='b c'>", "<div class=c>", "</div>", "<ul>", "</ul>", "<li>", "</li>", "<a href=/x>", "<a>", "</a>", "<br>", " t ", "u", "<p class=b>", "</p>", "<table>", "<tr>", "</tr>", "<th>", "<td>", "</td>", "</table>"]
    b, c, ul, li, a = Selector(cls="b"), Selector(tag="div", cls="c"), Selector(tag="ul"), Selector(tag="li"), Selector(tag="a")
    extracts = [
        Extract((b,), (Field("t"),)), Extract((li,), (Field("h", a, "href"), Field("t", a), Field("own", strip=False))), Extract((b, ul, li), (Field("t"),), 2),
        Extract((c, b), (Field("x", c), Field("t"))), P.LABEL_VALUES, Extract((b, b), (Field("cls", value="class"),), whole=True),
    ]
    for _ in range(3000):
        page = "".join(rng.choices(pieces, k=rng.randint(1, 25)))
        assert read_page(page, extracts) == [slow_records(page, e) for e in extracts]


def test_pivot_labels_takes_the_first(spark, rows):
    df = spark.createDataFrame(
        [(1, 2, "a", "late"), (1, 1, "a", "early"), (1, 3, "b", None), (2, 1, "c", "x"), (3, 1, "b", "y")],
        "k int, pos int, label string, value string",
    )
    got = P.pivot_labels(df, ["k"], "label", "value", "pos", {"a": "va", "b": "vb"})
    assert rows(got) == [(1, "early", None), (3, None, "y")]


def test_attach_and_union(spark, rows):
    details = spark.createDataFrame(
        [("/o/1", 5, "SE"), ("/o/1", 4, "SE"), (None, 1, "x"), ("/o/3", 2, "y")], "detail_link string, monthly_salary long, occupation string"
    )
    lists = spark.createDataFrame([("a", "/o/1"), ("b", "/o/2"), ("c", None)], "job_title string, detail_link string")
    joined = P.attach_list_to_detail(details, lists, found="there")
    assert rows(joined, "job_title", "detail_link", "monthly_salary", "occupation", "there") == sorted(
        [("a", "/o/1", 5, "SE", True), ("b", "/o/2", None, None, None), ("c", None, None, None, None)], key=repr
    )
    details, lists = details.where("monthly_salary = 5"), lists.where("job_title <> 'c'")
    assert rows(P.union_details([details, lists]), "detail_link", "job_title") == [
        ("/o/1", "a"), ("/o/1", None), ("/o/2", "b"),
    ]
    empty = P.union_details([], spark)
    assert empty.schema == DETAIL_ROWS and empty.count() == 0
    assert P.union_pages([lists, lists]).count() == 4


def test_page_operators_do_not_shuffle(spark):
    plan = P.parse_list_page(page_table(spark, "")).select(F.col("job_title"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan  # one narrow stage


def test_pages_of_a_batch_are_read_in_pieces():
    """Ten times the pages in a batch take no more memory to read; a page above the size of a piece is whole."""
    page = "<li>" + "語 " * 5_000 + "</li>"
    given = {"records": P.texts(Selector(tag="li"))}

    def peak(n):
        batch = pa.array([page] * n, pa.string())
        tracemalloc.start()
        try:
            found = sum(len(x) for x in read_pages(iter([batch]), given))
            return found, tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    few, many = peak(100), peak(1_000)
    assert (few[0], many[0]) == (100, 1_000)
    assert many[1] <= 1.5 * few[1]
    texts = ["a" * 9, None, "", "b", "語" * 20, None, "c" * 4, "d" * 4]
    cut = [x.to_pylist() for x in pieces(pa.array(texts), 10)]
    assert [t for x in cut for t in x] == texts
    assert all(len(x) == 1 or sum(len((t or "").encode()) for t in x) <= 10 for x in cut)
    assert list(pieces(pa.array([], pa.string()))) == []


def test_workers_get_pages_a_few_megabytes_at_a_time(spark):
    """The settings of every job bound a batch by its bytes; records come back in their rows."""
    pages = spark.range(0, 3_000, 1, 1).select("id", F.concat(F.lit("<li>"), "id", F.lit("</li>"), F.repeat(F.lit("x"), 4_000)).alias("html"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    assert pages.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] <= 5 << 20
    read = pages.select("id", extract(F.col("html"), {"x": P.texts(Selector(tag="li"))})["x"]["value"].alias("x"))
    assert [(r["id"], r["x"]) for r in read.orderBy("id").collect()] == [(i, [str(i)]) for i in range(3_000)]
