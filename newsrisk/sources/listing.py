"""Articles from archived listing pages.

Four page layouts are rows of data (:data:`LAYOUTS`); a new source is a new row.  A page goes
through one Arrow-batched Python call that returns its list items, then everything is native:
date normalisation, the newest-first cut, the target-date filter and the reject reasons.  A
page's items stay in one array until they are exploded, so nothing here shuffles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from newsrisk.functions.dates import as_date, long_date, relative_date
from newsrisk.sources.html import parse, release, select, select_one


@dataclass(frozen=True)
class ListingLayout:
    """How one kind of listing page is read.

    Selector tuples are tried in order.  ``title_attr`` takes the title from an attribute
    instead of the text.  ``link`` is ``title`` (the title element's address) or
    ``enclosing`` (the surrounding anchor, else the first anchor inside the item).
    ``link_rule``: ``optional`` (missing becomes ""), ``present`` or ``nonempty``.
    ``date_rule``: ``relative``, ``long``, ``target`` (the server already filtered by date)
    or ``text`` (kept as text, no filter).
    """

    item: tuple[str, ...]
    title: tuple[str, ...]
    title_attr: str | None = None
    date: tuple[str, ...] = ()
    date_default: str | None = None
    date_rule: str = "text"
    link: str = "title"
    link_rule: str = "nonempty"
    next_page: tuple[str, ...] = ()
    newest_first: bool = False


# Selectors and rules of the four supported page layouts.
LAYOUTS: dict[str, ListingLayout] = {
    "post_rows": ListingLayout(
        item=("div.row",),
        title=("h2.post_title a",),
        date=("span.text-secondary",),
        date_rule="relative",
        link_rule="optional",
    ),
    "media_list": ListingLayout(
        item=("article.list-content__item", ".list-content__item"),
        title=("h3.media__title a", ".media__title a"),
        date_rule="target",
        next_page=("a.next, a.pagination__next, li.pagination__next a",),
    ),
    "linked_cards": ListingLayout(
        item=("div.articleItem-wrap",),
        title=("h2.articleTitle",),
        date=("div.articlePost-date",),
        date_default="Date not available",
        link="enclosing",
    ),
    "dated_index": ListingLayout(
        item=("li.ptb15",),
        title=("h3.f16.fbo a",),
        title_attr="title",
        date=("time.grey",),
        date_rule="long",
        link_rule="present",
        newest_first=True,
    ),
}

_PARSED = (
    "struct<has_more: boolean, items: array<struct<"
    "pos: int, title: string, link: string, date_text: string>>>"
)


_ARROW_PARSED = pa.struct(
    [
        ("has_more", pa.bool_()),
        (
            "items",
            pa.list_(
                pa.struct(
                    [
                        ("pos", pa.int32()),
                        ("title", pa.string()),
                        ("link", pa.string()),
                        ("date_text", pa.string()),
                    ]
                )
            ),
        ),
    ]
)


def _items(html: str, layout: ListingLayout) -> tuple[bool, list[dict]]:
    root = parse(html)
    nodes = next((n for s in layout.item if (n := select(root, s))), [])
    items = []
    for pos, node in enumerate(nodes):
        title_node = select_one(node, layout.title)
        date_node = select_one(node, layout.date)
        title = link = None
        if title_node is not None:
            attr = layout.title_attr
            title = title_node.attrs.get(attr, "").strip() if attr else title_node.text()
        if layout.link == "title":
            link = title_node.attrs.get("href") if title_node is not None else None
        else:
            around = node.ancestor("a")
            link = around.attrs.get("href") if around is not None else None
            if not link:
                inside = select_one(node, ("a[href]",))
                link = inside.attrs["href"] if inside is not None else None
        date_text = date_node.text() if date_node is not None else layout.date_default
        items.append({"pos": pos, "title": title, "link": link, "date_text": date_text})
    more = select_one(root, layout.next_page)
    found = more is not None and not more.attrs.get("disabled"), items
    release(root)
    return found


def _parser(layouts: Mapping[str, ListingLayout]):
    layouts = dict(layouts)

    @arrow_udf(_PARSED)
    def parse_pages(html: pa.Array, layout: pa.Array) -> pa.Array:
        pages = []
        for page, name in zip(html.to_pylist(), layout.to_pylist()):
            more, items = False, []
            if page and name in layouts:
                try:
                    more, items = _items(page, layouts[name])
                except AssertionError:  # markup the standard parser refuses
                    items = None
            pages.append({"has_more": more, "items": items})
        return pa.array(pages, type=_ARROW_PARSED)

    return parse_pages


def _names(layouts: Mapping[str, ListingLayout], test) -> Column:
    return F.col("layout").isin([n for n, l in layouts.items() if test(l)])


def parse_listing(
    pages: DataFrame,
    as_of: Column | dt.date | str,
    target: Column | dt.date | str,
    layouts: Mapping[str, ListingLayout] = LAYOUTS,
) -> DataFrame:
    """One row per page: its columns without ``html``, page facts, and ``items``.

    ``pages`` needs ``layout`` and ``html``.  ``as_of`` is the day the page was fetched and
    ``target`` the wanted date; both may be columns, so an archive of many days is one job.
    Added: ``has_more`` (a next-page link exists), ``readable``, ``oldest_date``, ``found_any`` (an item
    has a readable date), ``stopped`` (an item older than the target ends the listing).

    Parsing is the expensive part: store or persist the result when more than one of page
    facts, articles and rejects is wanted.
    """
    parsed = pages.withColumns(
        {
            "_p": _parser(layouts)(F.col("html"), F.col("layout")),
            "_as_of": as_date(as_of),
            "target_date": as_date(target),
        }
    ).drop("html")

    rule = lambda r: _names(layouts, lambda l: l.date_rule == r)

    def dated(item: Column) -> Column:
        text = item["date_text"]
        date = (
            F.when(rule("relative"), relative_date(text, F.col("_as_of")))
            .when(rule("long"), long_date(text))
            .when(rule("target"), F.col("target_date"))
        )
        shown = F.when(
            rule("target"), F.date_format(F.col("target_date"), "yyyy-MM-dd")
        ).otherwise(text)
        return F.struct(
            item["pos"].alias("pos"),
            item["title"].alias("title"),
            item["link"].alias("link"),
            shown.alias("date_text"),
            F.when(item["title"].isNotNull(), date).alias("article_date"),
        )

    page = parsed.select(
        *[c for c in parsed.columns if c not in ("_p", "_as_of")],
        F.col("_p.has_more").alias("has_more"),
        F.col("_p.items").isNotNull().alias("readable"),
        F.transform("_p.items", dated).alias("items"),
    )
    dates = F.transform("items", lambda i: i["article_date"])
    older = F.filter("items", lambda i: i["article_date"] < F.col("target_date"))
    first_older = F.array_min(F.transform(older, lambda i: i["pos"]))
    return page.withColumns(
        {
            "oldest_date": F.array_min(dates),
            "found_any": F.coalesce(F.exists(dates, lambda d: d.isNotNull()), F.lit(False)),
            "_cut": F.when(_names(layouts, lambda l: l.newest_first), first_older),
        }
    ).withColumn("stopped", F.col("_cut").isNotNull())


def listing_items(
    parsed: DataFrame, layouts: Mapping[str, ListingLayout] = LAYOUTS
) -> DataFrame:
    """One row per list item of :func:`parse_listing`, with ``reason`` NULL when accepted.

    ``reason`` is the first of: ``missing_title``, ``missing_date``, ``bad_date``,
    ``after_cut``, ``other_date``, ``missing_link``.  An unusable item never costs more than
    itself.  A page of an unknown layout, or with markup the parser refuses, is one row with
    reason ``unknown_layout`` or ``unreadable_page``.
    """
    unknown = ~F.coalesce(_names(layouts, lambda _: True), F.lit(False))
    # explode_outer, because an inner explode makes the optimizer test the size of the array
    # first, and it would run the page parser a second time to do so.
    rows = (
        parsed.select(
            *[c for c in parsed.columns if c != "items"], F.explode_outer("items").alias("_i")
        )
        .where(F.col("_i").isNotNull() | unknown | ~F.col("readable"))
        .select("*", "_i.*")
    )
    by = lambda test: _names(layouts, test)
    filtered = by(lambda l: l.date_rule in ("relative", "long", "target"))
    no_link = (by(lambda l: l.link_rule == "present") & F.col("link").isNull()) | (
        by(lambda l: l.link_rule == "nonempty") & (F.coalesce("link", F.lit("")) == "")
    )
    reason = (
        F.when(unknown, "unknown_layout")
        .when(~F.col("readable"), "unreadable_page")
        .when(F.col("title").isNull(), "missing_title")
        .when(filtered & F.col("date_text").isNull(), "missing_date")
        .when(filtered & F.col("article_date").isNull(), "bad_date")
        .when(F.col("pos") >= F.col("_cut"), "after_cut")
        .when(filtered & (F.col("article_date") != F.col("target_date")), "other_date")
        .when(no_link, "missing_link")
    )
    optional = by(lambda l: l.link_rule == "optional")
    link = F.when(optional, F.coalesce("link", F.lit(""))).otherwise(F.col("link"))
    return rows.withColumn("reason", reason).withColumn("link", link).drop(
        "_i", "_cut", "readable"
    )


# Reasons that mean "this item is broken", as opposed to "not wanted on this date".
REJECT_REASONS = (
    "unknown_layout",
    "unreadable_page",
    "missing_title",
    "missing_date",
    "bad_date",
    "missing_link",
)


def accepted(items: DataFrame) -> DataFrame:
    """Items that become articles."""
    return items.where(F.col("reason").isNull())


def rejects(items: DataFrame) -> DataFrame:
    """Broken items, kept for inspection instead of aborting their source."""
    return items.where(reduce(or_, [F.col("reason") == r for r in REJECT_REASONS]))
