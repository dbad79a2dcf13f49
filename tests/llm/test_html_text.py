import random
import time

import pytest

from folioflow.llm import html_text
from folioflow.llm.html_text import extract_text, main_text

BODY = "<p>First, a paragraph that is long enough, with commas, to count as text of the page.</p><p>Second one &amp; more.</p>"
WRAPS = [
    "<article><h1>Title</h1>{}</article>",
    "<main><h1>Title</h1><section>{}</section></main>",
    "<div class=content><h1>Title</h1>{}</div>",
    "<div id='post'><h1>Title</h1><div>{}</div></div>",
]


@pytest.mark.parametrize("wrap", WRAPS)
def test_surroundings_go(wrap):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class='ad'>Buy, buy, buy this thing now, it is very good.</div>"
        "<div class=\"cookie-notice\">We use cookies, as everyone does, to know more about you.</div>" + wrap.format(BODY)
        + "<aside>Related, stories, here and there and everywhere else</aside><div id=comments><p>I, a reader, think that this is all wrong, and bad.</p></div>"
        "<form><p>Subscribe</p></form><footer>&copy; 2024</footer></body></html>"
    )
    assert main_text(page) == "Title First, a paragraph that is long enough, with commas, to count as text of the page. Second one & more."


def test_broken_markup():
    assert main_text("<article><p><b>One two.<br><p>Three &eacute; four</article>") == "One two. Three é four"
    assert main_text("<article><p>a < b &lt;i&gt; <i>c</i>d<p>e</article><p") == "a < b <i> cd e"
    assert main_text("just text") == "just text"
    assert main_text("<p>" * 5000 + "deep" + "<div>" * 5000) == "deep"
    assert main_text(None) == "" and main_text("  ") == "" and main_text("<nav>x</nav>") == ""


TEXT = "A paragraph that is long enough, with commas, and more, to count as text of a page."
P = f"<p>{TEXT}</p>"


@pytest.mark.parametrize("page", ["<div>" * 1100 + P, "<span>" * 5000 + P, "<div class=a>" * 3000 + P + "</div>" * 3000])
def test_deep_pages(page):
    assert main_text(page) == TEXT


@pytest.mark.parametrize(
    "page,want",
    [
        ("<div>" + P * 6 + "</div><article><p>One teaser that is long enough to be text, you see.</p></article>", [TEXT] * 6),
        ('<div class="content has-sidebar">' + P * 3 + "</div>", [TEXT] * 3),
        ('<div class="site with-header">' + P * 3 + "</div>", [TEXT] * 3),
        ('<div class="legal-news">' + P * 3 + "</div>", [TEXT] * 3),
        ("<form><nav>Menu</nav>" + P * 3 + "<input></form>", [TEXT] * 3),
        ("<article>" + P * 2 + '<article class="comment">' + P + "</article></article>", [TEXT] * 2),
        ("<article>" + P * 2 + '</article><div id="comments">' + P * 30 + "</div>", [TEXT] * 2),
        ("<article>" + P * 2 + '</article><div class="sidebar">' + P * 3 + "</div>", [TEXT] * 2),
        ("<main><h1>Head</h1><p>Standfirst here.</p><article>" + P * 3 + "</article></main>", ["Head", "Standfirst here.", *[TEXT] * 3]),
        ("<article><h1>Short.</h1></article><div class=ad>" + P + "</div>", ["Short."]),
        ("<article><section>" + P * 5 + "</section><section><p>Short end.</p></section></article>", [*[TEXT] * 5, "Short end."]),
    ],
)
def test_scores_decide(page, want):
    assert main_text(f"<html><body><header>Site</header>{page}<footer>End</footer></body></html>") == " ".join(want)


@pytest.mark.parametrize(
    "page",
    ["<" + "a" * 40000, "<b>" * 20000 + "</i>" * 20000, "<a " * 9000, '<a "' * 9001, "<x y='" * 9000, "<p><span>" * 9000 + "<li>" * 9000, "</a" * 20000],
)
def test_time_grows_with_the_page(page):
    start = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - start < 2


def brute_points(tree):
    """Points by walking from every element down to all paragraphs below it."""
    points = {}

    def below(node, level):
        got = 0.0
        for x in node.parts:
            if isinstance(x, str):
                continue
            text = html_text._inline_text(x).strip() if x.name in html_text.PARAGRAPH else ""
            if x.name not in html_text.TEXT_ROOTS:
                got += html_text.paragraph_points(text) * (1 - html_text._link_share(x)) / 2**level
            got += below(x, level + 1)
        return got

    def whole(node):
        own = html_text._inline_text(node).strip() if node.name in html_text.PARAGRAPH else ""
        got = html_text.paragraph_points(own) * (1 - html_text._link_share(node))
        return got + sum(whole(x) for x in node.parts if not isinstance(x, str))

    stack = [tree]
    while stack:
        node = stack.pop()
        points[id(node)] = whole(node) if node.name in html_text.TEXT_ROOTS else below(node, 0)
        stack += [x for x in node.parts if not isinstance(x, str)]
    return points


def test_points_agree_with_brute_force_on_random_trees():
    rng = random.Random(6)
    names = ["div", "p", "section", "td", "blockquote", "span", "a", "main", "b"]

    def made(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(["", "short", "a text, with commas, that is long enough, I think, to count", "x" * 130])
        name = rng.choice(names)
        return f"<{name}>" + "".join(made(depth - 1) for _ in range(rng.randrange(4))) + f"</{name}>"

    for _ in range(200):
        tree = html_text.parse("".join(made(5) for _ in range(3)))
        order = html_text._measure(tree)
        html_text._give_points(order)
        # An article's points within others are halved from the article on; text roots alone are compared below one another.
        want = brute_points(tree)
        for node in order:
            inner = [n for n in order if n.name == "main"]
            if not inner or node.name == "main":
                assert node.points == pytest.approx(want[id(node)])


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "<p>x</p>" * 3, None), (2, "", "b"), (3, "<article>" + "<p>some words here</p>" * 20_000, "c")]
    df = extract_text(spark.createDataFrame(rows, "page_id bigint, html string, main_text string"))
    got = sorted((r["page_id"] or 0, r["n_chars"]) for r in df.collect())
    assert got == [(0, 5), (1, 0), (2, 0), (2, 0), (3, 16 * 20_000 - 1)]
    assert extract_text(df.limit(0)).collect() == []
