"""Node lists as a Spark column: parsing, tree predicates and serialisation.

A parsed page is a struct ``(nodes, texts, error)`` in the page's own row. All
tree logic below consists of Spark array expressions over that row, so cleaning a
page never moves it to another task. They are written as SQL text, with ``nodes``
naming the node list column.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.functions.html_reader import NODE_FIELDS, PageReader

_INT_FIELDS = {"pos", "end_pos", "parent_pos", "depth", "text_from", "text_to"}

NODE_TYPE = T.StructType(
    [
        T.StructField(name, T.IntegerType() if name in _INT_FIELDS else T.StringType())
        for name in NODE_FIELDS
    ]
)
PARSED_TYPE = T.StructType(
    [
        T.StructField("nodes", T.ArrayType(NODE_TYPE)),
        T.StructField("texts", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)

# Elements taken out wherever they occur.
BOILERPLATE_TAGS = [
    "nav", "header", "footer", "script", "style", "noscript", "iframe", "button",
]
# Class parts taken out wherever they occur inside a class name.
BOILERPLATE_CLASS_PARTS = [
    "navigation", "nav", "sidebar", "menu", "header", "footer", "breadcrumb", "pagination",
    "advertisement", "ads", "social-share", "related-posts", "comments",
]
# Where the main content is looked for, best first (tag, class part).
MAIN_CONTENT_CHOICES = [
    ("main", None),
    ("article", None),
    ("div", "content"),
    ("div", "main"),
    ("div", "main-content"),
    ("div", "article"),
    ("div", "post"),
    ("div", "entry-content"),
    ("section", "content"),
    ("body", None),
]


def _parse_batch(pages: pa.Array) -> pa.Array:
    """Parse one Arrow batch; a page that cannot be read yields its error, never a failed task.

    Missing and unreadable pages have NULL lists.
    """
    reader = PageReader()
    node_columns: list[list] = [[] for _ in NODE_FIELDS]
    texts: list[str] = []
    node_starts, text_starts, errors = [], [], []
    for html in pages:
        rows, pieces, error = [], [], None
        if html.is_valid:
            try:
                rows, pieces = reader.read(html.as_py())
                # A lone surrogate cannot be written back as UTF-8.
                "".join(f"{r[6]}{r[7]}{r[8]}{r[10]}" for r in rows).encode("utf-8")
            except Exception as exc:  # one bad page must not stop the run
                rows, pieces, error = [], [], f"{type(exc).__name__}: {exc}"
                error = error.encode("utf-8", "replace").decode("utf-8")
        read = html.is_valid and error is None
        node_starts.append(len(node_columns[0]) if read else None)
        text_starts.append(len(texts) if read else None)
        errors.append(error)
        for column, values in zip(node_columns, zip(*rows)):
            column.extend(values)
        texts.extend(pieces)
    node_starts.append(len(node_columns[0]))
    text_starts.append(len(texts))
    nodes = pa.StructArray.from_arrays(
        [
            pa.array(values, pa.int32() if name in _INT_FIELDS else pa.string())
            for name, values in zip(NODE_FIELDS, node_columns)
        ],
        names=list(NODE_FIELDS),
    )
    return pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array(node_starts, pa.int32()), nodes),
            pa.ListArray.from_arrays(pa.array(text_starts, pa.int32()), pa.array(texts, pa.string())),
            pa.array(errors, pa.string()),
        ],
        names=["nodes", "texts", "error"],
    )


def parse_html(html: Column) -> Column:
    """Parsed page struct ``(nodes, texts, error)`` of an HTML string column.

    Marked non-deterministic so that the optimiser never evaluates it twice.
    """
    udf = F.arrow_udf(_parse_batch, returnType=PARSED_TYPE).asNondeterministic()
    return udf(html)


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is evaluated once per row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# -- predicates over one node ------------------------------------------------


def is_element(node: str, tag: str, cls: str | None = None) -> str:
    """Element of that name (and exact class token)."""
    hit = f"{node}.tag = {quoted(tag)}"
    if cls is not None:
        hit += f" and contains(concat(' ', {node}.classes, ' '), {quoted(f' {cls} ')})"
    return f"coalesce({hit}, false)"


def is_boilerplate(node: str) -> str:
    tags = ", ".join(map(quoted, BOILERPLATE_TAGS))
    parts = quoted("|".join(BOILERPLATE_CLASS_PARTS))
    return (
        f"(coalesce({node}.tag in ({tags}), false)"
        f" or coalesce(lower({node}.classes) rlike {parts}, false)"
        f" or coalesce({node}.role = 'navigation', false))"
    )


def main_rank(node: str) -> str:
    """Position in the list of main-content choices, NULL if the node is none of them."""
    cases = []
    for rank, (tag, part) in enumerate(MAIN_CONTENT_CHOICES):
        hit = f"{node}.tag = {quoted(tag)}"
        if part is not None:
            hit += f" and contains(lower({node}.classes), {quoted(part)})"
        cases.append(f"when {hit} then {rank}")
    return f"case {' '.join(cases)} end"


# -- whole node lists ----------------------------------------------------------


# Pages with more removed elements than this are searched by halving.
FEW_SPANS = 32


def _count_below(numbers: str, cond: str) -> str:
    """How many leading values of an ascending array satisfy ``cond`` (on ``value``)."""
    middle = "shiftright(at.low + at.high, 1)"
    hit = cond.replace("value", f"{numbers}[{middle}]")
    return f"""aggregate(
        page.steps, named_struct('low', 0, 'high', size({numbers})),
        (at, step) -> case
            when at.low >= at.high then at
            when {hit} then named_struct('low', {middle} + 1, 'high', at.high)
            else named_struct('low', at.low, 'high', {middle}) end,
        at -> at.low)"""


def _without_boilerplate(nodes: str) -> str:
    spans = f"""transform(filter({nodes}, n -> {is_boilerplate("n")}),
                          n -> named_struct('pos', n.pos, 'end_pos', n.end_pos))"""
    many = f"size(spans) > {FEW_SPANS}"
    page = f"""named_struct(
        'nodes', {nodes}, 'spans', spans,
        'starts', if({many}, transform(spans, s -> s.pos), null),
        'ends', if({many}, sort_array(transform(spans, s -> s.end_pos)), null),
        'steps', sequence(0, cast(log2(size(spans) + 1) as int)))"""
    in_few = "exists(page.spans, s -> n.pos between s.pos and s.end_pos)"
    # As many elements are open around a node as have begun up to it and not ended before it.
    begun = _count_below("page.starts", "value <= n.pos")
    ended = _count_below("page.ends", "value < n.pos")
    removed = f"if(page.starts is null, {in_few}, {begun} > {ended})"
    return _let("spans", spans, _let("page", page, f"filter(page.nodes, n -> not {removed})"))


def _main_nodes(nodes: str) -> str:
    best = f"""array_min(transform(
        filter(kept, n -> {main_rank("n")} is not null),
        n -> named_struct('rank', {main_rank("n")}, 'pos', n.pos, 'end_pos', n.end_pos)))"""
    whole = f"""named_struct('rank', {len(MAIN_CONTENT_CHOICES)}, 'pos', 0, 'end_pos', {2**31 - 1})"""
    inside = "filter(kept, n -> n.pos between main.pos and main.end_pos)"
    return _let("kept", nodes, _let("main", f"coalesce({best}, {whole})", inside))


def _to_html(nodes: str) -> str:
    opens = "transform(ns, n -> named_struct('at', n.pos, 'markup', n.open_str))"
    closes = """transform(filter(ns, n -> n.close_str is not null),
                          n -> named_struct('at', n.end_pos, 'markup', n.close_str))"""
    in_order = f"transform(sort_array(concat({opens}, {closes})), e -> e.markup)"
    return _let("ns", nodes, f"array_join({in_order}, '')")


def without_boilerplate(nodes: str = "nodes") -> Column:
    """Nodes that are no boilerplate element and lie in none."""
    return F.expr(_without_boilerplate(nodes))


def main_nodes(nodes: str = "nodes") -> Column:
    """Nodes of the main-content element, else of the body, else all, of a cleaned list."""
    return F.expr(_main_nodes(nodes))


def to_html(nodes: str = "nodes") -> Column:
    """A node list as markup: opening and closing strings in the order of their positions."""
    return F.expr(_to_html(nodes))


def clean_html(nodes: str = "nodes") -> Column:
    """Markup of the main content without boilerplate."""
    return F.expr(_to_html(_main_nodes(_without_boilerplate(nodes))))


def node_text(texts: str, node: str) -> str:
    """SQL for the visible text below a node: its stripped pieces joined without a separator."""
    pieces = f"slice({texts}, {node}.text_from + 1, {node}.text_to - {node}.text_from)"
    return f"array_join({pieces}, '')"
