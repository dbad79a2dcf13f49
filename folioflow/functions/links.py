"""Column expressions over URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: address the search tasks are sent to.
SEARCH_ADDRESS = "https://www.workplacerelations.ie/en/search/"

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def form_encode(text: Column) -> Column:
    """Percent-encoding of form fields; ``~`` stays, ``*`` does not."""
    return F.replace(
        F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A")
    )


def search_url(
    body_code: Column, start: Column, end: Column, address: str = SEARCH_ADDRESS
) -> Column:
    """Search address of one body and period."""

    def day(date: Column) -> Column:
        return form_encode(F.date_format(date, "dd/MM/yyyy"))

    return F.concat(
        F.lit(f"{address}?decisions=1&body="),
        form_encode(body_code),
        F.lit("&from="),
        day(start),
        F.lit("&to="),
        day(end),
    )


def _without_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` in an absolute path."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)),
        F.slice(parts, 1, 0),
        lambda acc, part: F.when(part == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(part == ".", acc)
        .otherwise(F.array_append(acc, part)),
    )
    trailing = F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(
        F.concat(path, F.lit("/")).rlike(r"/\.{1,2}/"),
        F.concat(F.lit("/"), F.array_join(kept, "/"), trailing),
    ).otherwise(path)


def abs_link(href: Column, page_url: Column) -> Column:
    """``href`` as seen from ``page_url``; a missing or empty one is the page itself.

    Leading control characters and spaces are dropped, tabs and line ends within as well; empty
    queries and fragments go, as do empty segments of a path that is joined to the page's folder.
    """
    href = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    base = F.regexp_replace(page_url, "#.*$", "")
    document = F.regexp_replace(base, r"\?.*$", "")
    origin = F.regexp_extract(base, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?", 0)
    # Folder of the page within its site, up to the last slash.
    folder = F.regexp_extract(document, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/]*)?(.*/)?", 1)

    path = F.regexp_extract(href, r"^[^?#]*", 0)
    joined = F.concat(F.when(folder == "", "/").otherwise(folder), path)
    full_path = F.when(path.startswith("/"), path).otherwise(F.regexp_replace(joined, "/{2,}", "/"))
    tail = F.regexp_replace(F.regexp_extract(href, r"[?#].*$", 0), r"^\?(?=#|$)|#$", "")
    bare = F.regexp_replace(F.regexp_replace(href, r"^([^?#]*)\?(?=#|$)", "$1"), "#$", "")
    scheme = F.regexp_extract(base, _SCHEME, 0)
    return (
        F.when(F.coalesce(href, F.lit("")) == "", page_url)
        .when(href.rlike(_SCHEME), F.when(F.regexp_extract(href, _SCHEME, 0) == scheme, bare).otherwise(href))
        .when(href.startswith("//"), F.concat(scheme, bare))
        .when(href.rlike(r"^\?(#|$)"), F.concat(base, tail))
        .when(href.startswith("?"), F.concat(document, tail))
        .when(href.startswith("#"), F.concat(base, tail))
        .otherwise(F.concat(origin, _without_dot_segments(full_path), tail))
    )
