"""Page html in a table -> one struct of raw texts per page, in one pass over Arrow batches.

Each page is read once by the forward scanner of ``markup``, which matches the selectors of the wanted texts and no others.
What is wanted follows from the columns asked for (``operators.extract.extract_pages``).

Broken markup can nest a text in itself hundreds of times. There are two ways of reading such pages: with a limit, beyond which
a page is an error that stands in its row, or whole, where elements are places in the text of their page, which is given once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotframe.functions.text import once, piece
from lotframe.sources.markup import Page, Selectors

#: A page that is not read whole gives so many characters of text at most, counted as often as they are given; beyond that it
#: is an error.
MOST = 64 << 20
#: Characters of markup after which the rows read so far are handed on.
BATCH = 8 << 20

# The selectors of a detail page and of a category page.
SELECTORS = {
    "title": "h1.post-title",
    "country": ".show-country-name",
    "group_titles": ".group-title",
    "essentials": ".essentials",
    "links": ".essentials a",
    "stats": "#listing-bid",
    "stat_row": ".listing-stats-stat",
    "stat_label": ".listing-stats-label",
    "stat_value": ".listing-stats-value",
    "excerpt": ".post-excerpt",
    "map_link": 'a[href*="google.com/maps"]',
    "member_link": 'a[href*="/member/"]',
    "bids": ".bid-notification-link",
    "comments": "#comments",
    "author_comments": "#comments .bypostauthor",
    "results": ".item-results",
    "cards": ".listing-card",
}
PLAIN = ("strong", "ul", "li", "p", "a")


PAIR = "struct<label: string, value: string>"
RAW_KIND = (
    "struct<title: string, country: string, group_titles: array<string>, essentials: array<struct<label: string, parent_text: string, map_link: string, member_link: string>>, "
    f"links: array<string>, details: array<string>, stats: array<{PAIR}>, bids: array<struct<bidder: string, text: string>>, excerpt: array<string>, comments: array<string>, "
    "author_comments: array<string>, results: string, cards: array<string>, picks: map<string, array<string>>>"
)
#: The raw kind of pages that are read whole: attributes of picks are texts, all other lists are places in ``text``.
WHOLE_KIND = f"{RAW_KIND[:-1]}, text: binary, places: map<string, array<bigint>>>"
FIELDS = ("title", "country", "group_titles", "essentials", "links", "details", "stats", "bids", "excerpt", "comments", "author_comments", "results", "cards")


#: The selectors that a wanted text needs.
NEEDS = {name: (name,) for name in FIELDS} | {
    "essentials": ("essentials", "strong", "map_link", "member_link"),
    "details": ("essentials", "ul", "li"),
    "stats": ("stats", "stat_row", "stat_label", "stat_value"),
    "excerpt": ("excerpt", "p"),
    "cards": ("cards", "a"),
}


def compiled(wanted: Iterable[str], selectors: Mapping[str, str] | None = None, picks: Iterable[tuple[str, str]] = ()) -> Selectors:
    """The selectors that the wanted texts and picks need; others are not even looked at."""
    css = {**SELECTORS, **(selectors or {}), **{n: n for n in PLAIN}}
    names = dict.fromkeys(n for w in wanted for n in NEEDS[w])
    return Selectors({n: css[n] for n in names} | {f"pick {selector}": selector for selector, _ in picks})


def read_page(html: str, wanted: Iterable[str], css: Selectors, picks: Iterable[tuple[str, str]] = (), most: int = MOST, closed: bool = False, whole: bool = False) -> dict:
    """The raw texts of a page; only the wanted ones are looked for. picks: (selector, attribute or ``text``), of which every
    fitting element gives its value. whole: without a limit, and lists of texts as ``places``."""
    page = Page(html, css, closed)
    given = 0
    lists: dict[str, list[int]] = {}

    def text(x: int | None) -> str | None:
        nonlocal given
        if x is None:
            return None
        given += page.end[x] - page.begin[x]
        if given > most and not whole:
            raise ValueError(f"elements hold more than {most} characters of text")
        return page.text_of(x)

    def not_blank(found: Iterable[int]) -> list[int]:
        return [x for x in found if page.end[x] > page.begin[x]]

    out: dict = {}

    def give(name: str, found: list[int]) -> None:
        if whole:
            lists[name] = found
        else:
            out[name] = [text(x) for x in found]

    for name in wanted:
        box = page.first("essentials" if name == "details" else name)
        if name in ("title", "country", "results"):
            out[name] = text(box)
        elif name in ("group_titles", "links", "author_comments"):
            give(name, page.all_of(name))
        elif name == "comments":
            give(name, [] if box is None else [box])
        elif name == "essentials":
            strong = [] if box is None else [(x, page.parent[x]) for x in page.all_of("strong", box)]
            out[name] = [{"label": text(x), "parent_text": text(up), "map_link": text(page.first("map_link", up)), "member_link": text(page.first("member_link", up))} for x, up in strong]
        elif name == "details":
            items = None if box is None else page.first("ul", box)
            give(name, [] if items is None else not_blank(page.all_of("li", items)))
        elif name == "excerpt":
            give(name, [] if box is None else not_blank(page.all_of("p", box)))
        elif name == "stats":
            rows = [] if box is None else page.all_of("stat_row", box)
            out[name] = [{"label": text(page.first("stat_label", r)), "value": text(page.first("stat_value", r))} for r in rows]
        elif name == "bids":
            out[name] = [{"bidder": text(x), "text": text(max(0, page.parent[page.parent[x]]))} for x in page.all_of(name)]
        elif name == "cards":
            links = [c if page.tag[c] == "a" else page.first("a", c) for c in page.all_of(name)]
            out[name] = [None if x is None else page.attributes[x].get("href") for x in links]
    if picks:
        out["picks"] = []
    for selector, attribute in picks:
        key, found = f"{selector} @{attribute}", page.all_of(f"pick {selector}")
        if whole and attribute == "text":
            lists[key] = found
        else:
            out["picks"].append((key, [text(x) if attribute == "text" else page.attributes[x].get(attribute) for x in found]))
    if whole:
        out["text"], out["places"] = places(page, lists)
    return out


def places(page: Page, lists: Mapping[str, list[int]]) -> tuple[bytes, list[tuple[str, list[int]]]]:
    """The text that the elements of lists hold, as UTF-8, each part of it once however many elements share it; and for each
    element its place there, 2 ** 32 times where it begins and its length (``functions.text.piece``)."""
    change: dict[int, int] = {}  # of the number of elements that hold what follows
    for x in (x for found in lists.values() for x in found):
        change[page.begin[x]] = change.get(page.begin[x], 0) + 1
        change[page.end[x]] = change.get(page.end[x], 0) - 1
    at: dict[int, int] = {}
    parts, size, holders, last = [], 0, 0, 0
    for edge in sorted(change):
        if holders:
            parts.append(page.text[last:edge].encode())
            size += len(parts[-1])
        at[edge] = size
        holders += change[edge]
        last = edge
    return b"".join(parts), [(name, [at[page.begin[x]] << 32 | at[page.end[x]] - at[page.begin[x]] for x in found]) for name, found in lists.items()]


def texts_of(name: str) -> Column:
    """The texts of a list of pages that were read whole."""
    return once(F.col("raw.text"), lambda t: F.transform(F.try_element_at(F.col("raw.places"), F.lit(name)), lambda p: piece(t, p)))


def read_pages(pages: DataFrame, wanted: Iterable[str] = FIELDS, selectors: Mapping[str, str] | None = None, html: str = "html", picks: Iterable[tuple[str, str]] = (), most: int = MOST, closed: bool = False, whole: bool = False) -> DataFrame:
    """``pages`` with ``html`` replaced by ``raw`` (texts; what is not wanted is null) and ``_error`` (null, or why a page
    could not be read). A null html is an empty page; bytes that are no UTF-8 are read as replacement characters. Pass only the
    fields needed: the others are then not looked for. closed: only character references that end with a semicolon are decoded.
    whole: for results that have no place for ``_error``. Every page is read, however much text its elements hold (``raw`` is
    of ``WHOLE_KIND``), and one that cannot be read ends the job, instead of looking like a page without texts."""
    wanted, picks = tuple(wanted), tuple(dict.fromkeys(picks))
    css = compiled(wanted, selectors, picks)
    others = [c for c in pages.columns if c != html]
    kind = pages.sparkSession.createDataFrame([], f"raw {WHOLE_KIND if whole else RAW_KIND}").schema["raw"]
    schema = T.StructType([*(pages.schema[c] for c in others), kind, T.StructField("_error", T.StringType())])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(kind.dataType)
        for batch in batches:
            rows, errors, held, since = [], [], 0, 0
            for i, x in enumerate(batch.column(0), 1):
                markup = x.as_py() or ""
                try:
                    rows.append(read_page(markup, wanted, css, picks, most, closed, whole))
                    errors.append(None)
                except Exception as e:  # one page never costs another
                    if whole:  # but what is read of it is not to be taken for its texts
                        row = {c: str(batch.column(k)[i - 1].as_py())[:100] for k, c in enumerate(others, 1)}
                        raise RuntimeError(f"page {row} of {len(markup)} characters cannot be read: {type(e).__name__}: {str(e)[:200]}") from e
                    rows.append({})
                    errors.append(f"{type(e).__name__}: {e}"[:200])
                held += len(markup)
                if held >= BATCH or i == len(batch):
                    yield pa.RecordBatch.from_arrays([*batch.slice(since, i - since).columns[1:], pa.array(rows, arrow), pa.array(errors, pa.string())], [*others, "raw", "_error"])
                    rows, errors, held, since = [], [], 0, i

    return pages.select(F.make_valid_utf8(F.col(html).cast("string")), *(F.col(f"`{c}`") for c in others)).mapInArrow(run, schema)
