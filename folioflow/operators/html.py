"""Page operators: parsing, cleaning, normalising, result extraction and pagination.

A parsed page stays one row with its node list, so removal, selection and
serialisation are array expressions without a shuffle. Only the few nodes that
result extraction looks at are turned into rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from folioflow.functions import html_nodes as hn
from folioflow.functions.content import content_hash
from folioflow.functions.links import abs_link
from folioflow.operators.records import first_wins
from folioflow.scale import materialise, spread

# Fixed value: the mark of a link to the next result page.
NEXT_PAGE_MARK = "»"


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the markup by ``nodes``, ``texts`` and ``error`` (set if a page is unreadable)."""
    kept = [c for c in pages.columns if c != html]
    return (
        spread(pages)
        .withColumn("_parsed", hn.parse_html(F.col(html)))
        .select(*kept, "_parsed.nodes", "_parsed.texts", "_parsed.error")
    )


def node_rows(parsed: DataFrame) -> DataFrame:
    """One row per node of parsed pages."""
    kept = [c for c in parsed.columns if c not in ("nodes", "texts", "error")]
    return parsed.select(*kept, F.inline("nodes"))


def html_nodes(pages: DataFrame) -> DataFrame:
    """One row per node of every page."""
    return node_rows(parse_pages(pages))


def drop_boilerplate(parsed: DataFrame) -> DataFrame:
    """Remove navigation, headers, footers, scripts, buttons and the like from the node lists."""
    return parsed.withColumn("nodes", hn.without_boilerplate())


def main_content(parsed: DataFrame) -> DataFrame:
    """Keep the main-content element of cleaned node lists, else the body, else everything."""
    return parsed.withColumn("nodes", hn.main_nodes())


def clean_html(pages: DataFrame) -> DataFrame:
    """Main content of every page as markup, with its hash; NULL and ``error`` if unreadable."""
    parsed = parse_pages(pages)
    kept = [c for c in parsed.columns if c not in ("nodes", "texts", "error")]
    clean = F.when(F.col("error").isNull(), hn.clean_html())
    return parsed.select(*kept, clean.alias("clean_html"), "error").withColumn(
        "clean_hash", content_hash(F.col("clean_html").cast("binary"))
    )


def normalize_html(pages: DataFrame) -> DataFrame:
    """Every page re-serialised without removing anything, with its hash."""
    parsed = parse_pages(pages)
    kept = [c for c in parsed.columns if c not in ("nodes", "texts", "error")]
    normal = F.when(F.col("error").isNull(), hn.to_html())
    return parsed.select(*kept, normal.alias("normal_html"), "error").withColumn(
        "stored_hash", content_hash(F.col("normal_html").cast("binary"))
    )


def node_text(parsed: DataFrame, tag: str, cls: str | None = None) -> DataFrame:
    """Visible text of every element of that name (and exact class)."""
    kept = [c for c in parsed.columns if c not in ("nodes", "texts", "error")]

    found = f"""transform(
        filter(nodes, n -> {hn.is_element("n", tag, cls)}),
        n -> named_struct('pos', n.pos, 'node_text', {hn.node_text("texts", "n")}))"""
    return parsed.select(*kept, F.inline(F.expr(found)))


# -- result pages ------------------------------------------------------------------


# The parts a node may play in a result: column, element and exact class.
_RESULT_PARTS = {
    "is_result": ("div", "bottom-ref"),
    "is_title": ("div", "row"),
    "is_ref": ("span", "refNO"),
    "is_date": ("span", "date"),
    "is_head": ("h2", "title"),
    "is_link": ("a", None),
    "is_description": ("p", "description"),
}


def _result_marks() -> Column:
    """The nodes result extraction needs, each with the parts it may play."""
    flags = {name: hn.is_element("n", *part) for name, part in _RESULT_PARTS.items()}
    speaks = " or ".join(flags[name] for name in ("is_ref", "is_date", "is_description"))
    flag_fields = ", ".join(f"'{name}', {flag}" for name, flag in flags.items())
    return F.expr(
        f"""transform(
            filter(nodes, n -> {" or ".join(flags.values())}),
            n -> named_struct(
                'pos', n.pos, 'end_pos', n.end_pos, 'parent_pos', n.parent_pos, 'href', n.href,
                'text', case when {speaks} then {hn.node_text("texts", "n")} end, {flag_fields}))"""
    )


def page_facts(parsed: DataFrame) -> DataFrame:
    """What crawling needs from each result page: its address, next link and result nodes.

    Pages captured more than once under one address count once, the lowest ``page_id``.
    """
    base = "get(filter(nodes, n -> n.tag = 'base' and n.href is not null), 0).href"
    following = (
        f"get(filter(nodes, n -> n.tag = 'a' and contains(n.link_text, {hn.quoted(NEXT_PAGE_MARK)})), 0).href"
    )
    facts = parsed.select(
        "page_id",
        "url",
        F.expr(base).alias("_base"),
        F.expr(following).alias("_next"),
        _result_marks().alias("marks"),
    )
    facts = facts.withColumn("base_url", abs_link(F.col("_base"), F.col("url")))
    facts = facts.withColumn(
        "next_url",
        F.when(F.coalesce("_next", F.lit("")) != "", abs_link(F.col("_next"), F.col("base_url"))),
    )
    return first_wins(
        facts.select("page_id", "url", "base_url", "next_url", "marks"), ["page_id"], key="url"
    )


def next_link(parsed: DataFrame) -> DataFrame:
    """Address of each page and of the page after it, NULL on the last."""
    return page_facts(parsed).select("url", "next_url")


def result_records(facts: DataFrame) -> DataFrame:
    """One row per search result of each page: identifier, date, link and description.

    The title row is the nearest one before the result among its siblings, the
    description the nearest one after that title row. All windows run within a page
    and share one partitioning by page.
    """
    rows = facts.select("page_id", "url", "base_url", F.inline("marks"))
    later = W.partitionBy("url").orderBy(F.desc("pos")).rowsBetween(W.unboundedPreceding, -1)
    siblings = W.partitionBy("url", "parent_pos")
    later_siblings = siblings.orderBy(F.desc("pos")).rowsBetween(W.unboundedPreceding, -1)
    earlier_siblings = siblings.orderBy("pos").rowsBetween(W.unboundedPreceding, -1)

    def nearest(flag: str, window, *fields: str) -> Column:
        """The next node in window order that plays a part."""
        value = F.struct(F.col("pos"), *[F.col(f) for f in fields])
        return F.last(F.when(F.col(flag), value), ignorenulls=True).over(window)

    def if_inside(node: str, field: str) -> Column:
        return F.when(F.col(f"{node}.pos") <= F.col("end_pos"), F.col(f"{node}.{field}"))

    rows = (
        rows.withColumn("ref", nearest("is_ref", later, "text"))
        .withColumn("date", nearest("is_date", later, "text"))
        .withColumn("link", nearest("is_link", later, "href"))
        .withColumn("head_href", if_inside("link", "href"))
        .withColumn("head", nearest("is_head", later, "head_href"))
        .withColumn("title_date", if_inside("date", "text"))
        .withColumn("title_href", if_inside("head", "head_href"))
        .withColumn(
            "title_description",
            F.last(F.when(F.col("is_description"), F.col("text")), ignorenulls=True).over(
                later_siblings
            ),
        )
        .withColumn(
            "title",
            nearest("is_title", earlier_siblings, "title_date", "title_href", "title_description"),
        )
    )
    href = F.col("title.title_href")
    return (
        rows.where("is_result")
        .withColumn("identifier", if_inside("ref", "text"))
        .where((F.col("identifier") != "") & F.col("title").isNotNull())
        .select(
            "page_id",
            F.col("url").alias("source_url"),
            "pos",
            "identifier",
            F.col("title.title_description").alias("description"),
            F.col("title.title_date").alias("published_date"),
            F.when(F.coalesce(href, F.lit("")) != "", abs_link(href, F.col("base_url")))
            .otherwise(F.col("url"))
            .alias("doc_link"),
        )
    )


def pagination_chain(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """All pages reachable from the seeds by next links, each once, with its number of hops.

    ``links`` is ``(url, next_url)``, ``seeds`` is ``(url, ...)``; the other seed
    columns are handed down the chain. Jumps double twice in every round, so a chain
    of ``n`` pages takes about ``log4(n)`` rounds instead of ``n``. Circles end by
    themselves: a round that reaches nothing new is the last.
    """
    handed_down = [c for c in seeds.columns if c != "url"]
    order = ["hop", *handed_down]

    def advance(reached: DataFrame, jumps: DataFrame, step: int) -> DataFrame:
        ahead = reached.join(jumps, "url").select(
            F.col("next_url").alias("url"), *handed_down, (F.col("hop") + step).alias("hop")
        )
        return first_wins(reached.unionByName(ahead), order, key="url")

    def doubled(jumps: DataFrame) -> DataFrame:
        second = jumps.select(F.col("url").alias("next_url"), F.col("next_url").alias("_target"))
        return jumps.join(second, "next_url").select("url", F.col("_target").alias("next_url"))

    links = materialise(links.select("url", "next_url"), "links")
    pages = links.select("url").distinct()
    captured_next = pages.withColumnRenamed("url", "next_url")
    jumps = materialise(
        links.join(captured_next, "next_url", "left_semi").select("url", "next_url"), "jumps"
    )
    start = seeds.join(pages, "url", "left_semi").withColumn("hop", F.lit(0).cast("long"))
    reached = materialise(first_wins(start, order, key="url"), "reached")
    n_reached, step = reached.count(), 1
    while not jumps.isEmpty():
        twice = doubled(jumps)
        grown = advance(advance(reached, jumps, step), twice, 2 * step)
        reached = materialise(grown, "reached")
        n_before, n_reached, step = n_reached, reached.count(), 4 * step
        if n_reached == n_before:
            break
        jumps = materialise(doubled(twice), "jumps")
    return reached
