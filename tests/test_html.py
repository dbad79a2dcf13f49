"""Parsing, cleaning and result extraction on small pages."""

import pytest

from folioflow.functions import html_nodes as hn
from folioflow.functions.html_reader import PageReader
from folioflow.operators import html


def pages_of(spark, *markup):
    return spark.createDataFrame(
        [(i, f"http://site.test/p/{i}", m) for i, m in enumerate(markup)],
        "page_id long, url string, html string",
    )


def one(spark, markup, operator, column):
    return operator(pages_of(spark, markup)).collect()[0][column]


def clean(spark, markup):
    return one(spark, markup, html.clean_html, "clean_html")


def normal(spark, markup):
    return one(spark, markup, html.normalize_html, "normal_html")


ROUND_TRIPS = {
    "unclosed": ("<p><b>a<br>c", "<p><b>a<br/>c</b></p>"),
    "no implied end": ("<p>a<p>b", "<p>a<p>b</p></p>"),
    "stray end": ("a</i>b<b>c</b></b>", "ab<b>c</b>"),
    "crossed": ("<b><i>x</b>y</i>", "<b><i>x</i></b>y"),
    "void with end": ("<br></br>x<br></br>", "<br/>x<br/>"),
    "self-closed": ("<p/>x<hr/>", "<p></p>x<hr/>"),
    "script text": ('<script>var t="</p>&amp;<b>";</script>', '<script>var t="</p>&amp;<b>";</script>'),
    "entities": ("&lt;a&gt; &amp; &quot;b&quot; &copy;&nbsp;&#233;&#x41;", '&lt;a&gt; &amp; "b" ©\xa0éA'),
    "unknown entity": ("a &foo; b", "a &amp;foo b"),
    "cut entity": ("<p>x &am</p>", "<p>x &amp;am</p>"),
    "bare ampersand": ("a & b", "a &amp; b"),
    "windows code": ("&#150;", "–"),
    "comment": ("<!-- x --><p>y</p>", "<!-- x --><p>y</p>"),
    "doctype": ("<!doctype html><p>", "<!DOCTYPE html>\n<p></p>"),
    "sorted attributes": ('<a href="x" class="c  d">t</a>', '<a class="c d" href="x">t</a>'),
    "quotes": ("<a title='say \"hi\"'>t</a>", "<a title='say \"hi\"'>t</a>"),
    "both quotes": ("<a title=\"it's &quot;x&quot;\">t</a>", '<a title="it\'s &quot;x&quot;">t</a>'),
    "no value": ("<input disabled>", '<input disabled=""/>'),
    "duplicate attribute": ('<p id="a" id="b">x</p>', '<p id="b">x</p>'),
    "blank text": ("<p>a</p> \n  <p>   </p>", "<p>a</p>\n<p> </p>"),
    "pre keeps blanks": ("<pre>  \n  </pre>", "<pre>  \n  </pre>"),
    "meta charset": ('<meta charset="latin-1">', '<meta charset="utf-8"/>'),
    "upper case": ("<DIV ID=x>T</DIV>", '<div id="x">T</div>'),
}


@pytest.mark.parametrize("name", ROUND_TRIPS)
def test_normalize(name):
    markup, expected = ROUND_TRIPS[name]
    rows, _ = PageReader().read(markup)
    events = [(r[0], r[10]) for r in rows] + [(r[1], r[11]) for r in rows if r[11] is not None]
    assert "".join(text for _, text in sorted(events)) == expected


def test_normalize_column(spark):
    pages = pages_of(spark, *[m for m, _ in ROUND_TRIPS.values()])
    got = {r.page_id: r.normal_html for r in html.normalize_html(pages).collect()}
    assert [got[i] for i in range(len(ROUND_TRIPS))] == [e for _, e in ROUND_TRIPS.values()]


def test_normalising_twice_changes_nothing(spark):
    # A doctype is always followed by one more line break.
    once = [e for _, e in ROUND_TRIPS.values() if "DOCTYPE" not in e]
    got = {r.page_id: r.normal_html for r in html.normalize_html(pages_of(spark, *once)).collect()}
    assert [got[i] for i in range(len(once))] == once


def test_positions_are_nested():
    rows, _ = PageReader().read("<div><p>a<b>c</b></p><p>d</p></div>")
    spans = [(r[0], r[1]) for r in rows]
    flat = sorted({p for s in spans for p in s})
    assert flat == list(range(len(flat)))
    for a, b in spans:
        for c, d in spans:
            assert b < c or d < a or (a <= c and d <= b) or (c <= a and b <= d)


CLEANING = {
    "main": ("<body><main><h1>T</h1><p>x</p></main></body>", "<main><h1>T</h1><p>x</p></main>"),
    "nav beside main": ("<nav>n</nav><main>m</main>", "<main>m</main>"),
    "header and footer": ("<header>h</header><main>m</main><footer>f</footer>", "<main>m</main>"),
    "head contents": (
        "<html><head><style>s</style><script>x</script></head><body><main>m</main></body></html>",
        "<main>m</main>",
    ),
    "button inside": ("<main>a<button>b</button>c</main>", "<main>ac</main>"),
    "article": ("<nav>n</nav><article>a</article>", "<article>a</article>"),
    "body fallback": ("<html><body><div>d</div></body></html>", "<body><div>d</div></body>"),
    "no body": ("<div>d</div>t", "<div>d</div>t"),
    "main before article": ("<article>a</article><main>m</main>", "<main>m</main>"),
    "content before other divs": (
        '<div class="post">p</div><div class="my-CONTENT">c</div>',
        '<div class="my-CONTENT">c</div>',
    ),
    "div main": ('<div class="mainly">m</div><section class="content">s</section>', '<div class="mainly">m</div>'),
    "div article": ('<div class="article">a</div>', '<div class="article">a</div>'),
    "div post": ('<div class="post-1">a</div>', '<div class="post-1">a</div>'),
    "section content": ('<p>x</p><section class="content">s</section>', '<section class="content">s</section>'),
    "empty main wins": ("<main></main><article>a</article>", "<main></main>"),
    "class part": ('<main>a<p class="unavailable">b</p><p class="downloads">c</p>d</main>', "<main>ad</main>"),
    "class of body": ('<body class="no-sidebar"><p>x</p></body><p>y</p>', "<p>y</p>"),
    "document header": (
        '<body><div class="document-header">h</div><div class="content">c</div></body>',
        '<div class="content">c</div>',
    ),
    "ad is no ads": ('<main><div class="ad">a</div></main>', '<main><div class="ad">a</div></main>'),
    "role": ('<main><p role="navigation">a</p><p role="Navigation">b</p></main>', '<main><p role="Navigation">b</p></main>'),
    "nested removal": ('<main><div class="menu"><nav>a</nav><p>b</p></div>c</main>', "<main>c</main>"),
    "main inside removed": ("<header><main>m</main></header><article>a</article>", "<article>a</article>"),
    "unclosed": ("<article><p><b>x<br></article>", "<article><p><b>x<br/></b></p></article>"),
    "all removed": ("<nav>x</nav>", ""),
    "empty": ("", ""),
}


def test_clean_html(spark):
    pages = pages_of(spark, *[m for m, _ in CLEANING.values()])
    got = {r.page_id: r.clean_html for r in html.clean_html(pages).collect()}
    for i, (name, (_, expected)) in enumerate(CLEANING.items()):
        assert got[i] == expected, name


def test_page_with_very_many_removed_elements(spark):
    n = 3000
    markup = "<main>" + "".join(
        f'<p>{i}</p><div class="menu"><nav>n</nav><button>b</button>x</div>' for i in range(n)
    )
    assert clean(spark, markup) == "<main>" + "".join(f"<p>{i}</p>" for i in range(n)) + "</main>"


def test_clean_html_is_idempotent(spark):
    once = [e for _, e in CLEANING.values()]
    got = {r.page_id: r.clean_html for r in html.clean_html(pages_of(spark, *once)).collect()}
    assert [got[i] for i in range(len(once))] == once


def test_missing_and_unreadable_pages(spark):
    rows = html.clean_html(pages_of(spark, None, "<p>x</p>", "<p>&#xD800;</p>")).orderBy("page_id").collect()
    assert (rows[0].clean_html, rows[0].error) == (None, None)
    assert rows[1].clean_html == "<p>x</p>"
    assert rows[2].clean_html is None and "Unicode" in rows[2].error


def test_same_result_for_any_partitioning(spark):
    pages = pages_of(spark, *[m for m, _ in CLEANING.values()])
    one_part = html.clean_html(pages.coalesce(1)).orderBy("page_id").collect()
    many = html.clean_html(pages.repartition(7)).orderBy("page_id").collect()
    assert one_part == many


def test_node_text_skips_comments_and_hidden_text(spark):
    markup = "<p class='d'> a <!-- no --><b> b\n</b><script>s</script><template>t</template> c </p>"
    parsed = html.parse_pages(pages_of(spark, markup))
    assert [r.node_text for r in html.node_text(parsed, "p", "d").collect()] == ["abc"]
    assert html.node_text(parsed, "p", "x").count() == 0


def test_drop_boilerplate_keeps_the_rest_in_order(spark):
    parsed = html.drop_boilerplate(html.parse_pages(pages_of(spark, "<p>a</p><nav>n</nav><p>b</p>")))
    assert parsed.select(hn.to_html().alias("h")).collect()[0].h == "<p>a</p><p>b</p>"


RESULT = (
    '<div class="row"><h2 class="title"><a href="{href}">t</a></h2><span class="date"> {date} </span></div>'
    '<p class="description">{text}</p><div class="bottom-ref"><span class="refNO"> {ref} </span></div>'
)


def results(spark, *markup):
    facts = html.page_facts(html.parse_pages(pages_of(spark, *markup)))
    return [
        (r.identifier, r.published_date, r.doc_link, r.description)
        for r in html.result_records(facts).orderBy("page_id", "pos").collect()
    ]


def test_result_records(spark):
    page = RESULT.format(href="/d/1", date="1 May", text="one", ref="A-1") + RESULT.format(
        href="2.pdf", date="2 May", text="two", ref="A-2"
    )
    assert results(spark, page) == [
        ("A-1", "1 May", "http://site.test/d/1", "one"),
        ("A-2", "2 May", "http://site.test/p/2.pdf", "two"),
    ]


def test_result_without_identifier_or_title_is_skipped(spark):
    assert results(spark, '<div class="bottom-ref"><span class="refNO">A</span></div>') == []
    assert results(spark, RESULT.format(href="x", date="d", text="t", ref=" ")) == []


def test_result_with_missing_parts(spark):
    page = '<div class="row"></div><div class="bottom-ref"><span class="refNO">A</span></div>'
    assert results(spark, page) == [("A", None, "http://site.test/p/0", None)]
    page = '<div class="row"><h2 class="title">x</h2></div><div class="bottom-ref"><span class="refNO">A</span></div>'
    assert results(spark, page) == [("A", None, "http://site.test/p/0", None)]


def test_result_takes_its_neighbours_title_and_description(spark):
    page = RESULT.format(href="/d/1", date="1 May", text="one", ref="A-1")
    page += '<div class="bottom-ref"><span class="refNO">A-2</span></div>'
    assert results(spark, page)[1] == ("A-2", "1 May", "http://site.test/d/1", "one")
    page = '<div class="row"></div><div class="bottom-ref"><span class="refNO">A</span></div>' + RESULT.format(
        href="/d/2", date="2 May", text="two", ref="B"
    )
    assert results(spark, page)[0] == ("A", None, "http://site.test/p/0", "two")


def test_result_classes_match_exactly(spark):
    page = RESULT.format(href="/d", date="d", text="t", ref="A").replace('"row"', '"rows"')
    assert results(spark, page) == []
    page = RESULT.format(href="/d", date="d", text="t", ref="A").replace('"row"', '"x row y"')
    assert results(spark, page)[0][0] == "A"


def test_links_follow_the_base_element(spark):
    page = '<base href="http://other.test/b/">' + RESULT.format(href="c", date="d", text="t", ref="A")
    assert results(spark, page) == [("A", "d", "http://other.test/b/c", "t")]


def next_urls(spark, *markup):
    links = html.next_link(html.parse_pages(pages_of(spark, *markup)))
    return [r.next_url for r in links.orderBy("url").collect()]


def test_next_link(spark):
    assert next_urls(
        spark,
        '<a href="?p=2"> » </a>',
        '<a href="/x"><b>next »</b></a>',
        '<a href="/x">a <b>»</b></a>',
        '<a>»</a><a href="/x">»</a>',
        '<a href="/x">></a>',
        '<a href="/1">»</a><a href="/2">»</a>',
    ) == [
        "http://site.test/p/0?p=2",
        "http://site.test/x",
        None,
        None,
        None,
        "http://site.test/1",
    ]


def test_page_captured_twice_counts_once(spark):
    twice = spark.createDataFrame(
        [(2, "http://u", '<a href="/b">»</a>'), (1, "http://u", '<a href="/a">»</a>')],
        "page_id long, url string, html string",
    )
    assert [r.next_url for r in html.next_link(html.parse_pages(twice)).collect()] == ["http://u/a"]


def chain(spark, links, seeds):
    links = spark.createDataFrame(links, "url string, next_url string")
    seeds = spark.createDataFrame(seeds, "url string, body string")
    return sorted((r.url, r.body, r.hop) for r in html.pagination_chain(links, seeds).collect())


def test_pagination_chain_long(spark):
    n = 37
    links = [(f"u{i:03d}", f"u{i + 1:03d}" if i < n - 1 else None) for i in range(n)]
    assert chain(spark, links, [("u000", "A")]) == [(f"u{i:03d}", "A", i) for i in range(n)]


def test_pagination_chain_circle_and_dead_ends(spark):
    links = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "gone"), ("lonely", None)]
    assert chain(spark, links, [("b", "B"), ("x", "X"), ("nowhere", "N")]) == [
        ("a", "B", 2),
        ("b", "B", 0),
        ("c", "B", 1),
        ("x", "X", 0),
    ]


def test_pagination_chain_joined_chains_visit_once(spark):
    links = [("a1", "m"), ("b1", "b2"), ("b2", "m"), ("m", "n"), ("n", None)]
    got = chain(spark, links, [("a1", "A"), ("b1", "B")])
    assert ("m", "A", 1) in got and ("n", "A", 2) in got and len(got) == 5
