"""Articles from sitemap XML, entry by entry.

A text is cut into entries by one Arrow-batched Python call, which also reads the fields of
plain entries (``_PLAIN``); all other entries go through Spark's own XML parser, which costs
several times as much.  Both give the same fields.

Sitemap files are read in byte ranges (``read_sitemaps``): records end at ``</url>``, so every
entry lies within one record and no entry is shuffled.  What crosses records is whether a
comment is open; it follows from the last comment mark before a record (``<!--`` opens, ``-->``
closes).  Each task notes it for the records of its ranges, one row per range carries the last
mark of the range and whether it holds entries, and a window over the few ranges of a file gives
each range the state at its start.  A file written with prefixed end tags (``</s:url>``) has no such records and is one
record.  A ``</url>`` inside CDATA is taken for an end tag.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.functions import arrow_udf

from newsrisk.functions.dates import as_date, iso_date, let, strip
from newsrisk.functions.text import slug_title

ENTRY = (
    "loc array<string>, lastmod array<string>, news_title array<string>, "
    "news_news struct<news_title: array<string>>, _corrupt_record string"
)
FIELDS = ("loc", "lastmod", "news_title", "reason")

# An entry ends with its end tag, before the next entry, or where the text ends; its tags may
# carry a prefix.  Comments are blanked first (an unclosed one to the end of the text).
_COMMENT = re.compile(r"<!--.*?-->", re.DOTALL)
_CLOSE = re.compile(r"</(?:[A-Za-z][\w.-]*:)?url\s*>", re.ASCII)
_START = re.compile(r"<(?:[A-Za-z][\w.-]*:)?url[\s>]", re.ASCII)
_OPEN = r"^<([A-Za-z][\w.-]*:)?url[\s>]"
_BARE_AND = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)"

# A plain entry: these elements in this order, each once at most, without attributes, and texts
# without markup, numeric references and characters that XML treats specially or refuses.
_CHARS = r"[^<>&\x00-\x08\x0B-\x1F\x7F-\x9F\uD800-\uDFFF\uFFFE\uFFFF]*+"
_TEXT = rf"{_CHARS}(?:&(?!#){_CHARS})*+"
_GAP = r"[ \t\r\n]*+"


def _leaf(name: str, text: str = _TEXT) -> str:
    return f"(?:<{name}>{text}</{name}>{_GAP})?"


_PLAIN = re.compile(
    f"<url>{_GAP}{_leaf('loc', f'({_TEXT})')}{_leaf('lastmod', f'({_TEXT})')}"
    f"{_leaf('changefreq')}{_leaf('priority')}(?:<news:news>{_GAP}"
    f"(?:<news:publication>{_GAP}{_leaf('news:name')}{_leaf('news:language')}</news:publication>{_GAP})?"
    f"{_leaf('news:publication_date')}{_leaf('news:title', f'({_TEXT})')}{_leaf('news:keywords')}"
    f"</news:news>{_GAP})?"
)
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))

#: An entry as it is found: the fields of a plain one, or its text (``piece``) for the parser.
FOUND = "array<struct<piece: string, loc: string, lastmod: string, news_title: string>>"


def _value(text: str | None) -> str | None:
    """What the XML parser makes of the text of a plain element."""
    if text is None:
        return None
    if "&" in text:
        for entity, char in _ENTITIES:
            text = text.replace(entity, char)
    return text.strip(" \t\n")


def _entries(xml: str) -> list[tuple[str | None, str | None, str | None, str | None]]:
    """The entries of a text (``FOUND``), in order."""
    if "<!--" in xml:
        xml = _COMMENT.sub("", xml).partition("<!--")[0]
    found = []
    for part in _CLOSE.split(xml):
        starts = [m.start() for m in _START.finditer(part)]
        for at, end in zip(starts, [*starts[1:], len(part)]):
            if plain := _PLAIN.fullmatch(part, at, end):
                found.append((None, *map(_value, plain.groups())))
            else:
                found.append((part[at:end], None, None, None))
    return found


def _column(lists: list[list[tuple] | None]) -> pa.Array:
    """Lists of entries as an Arrow column of ``FOUND``."""
    offsets, rows = [0], []
    for entries in lists:
        rows.extend(entries or ())
        offsets.append(len(rows))
    fields = list(zip(*rows, strict=True)) or [()] * 4
    names = ["piece", "loc", "lastmod", "news_title"]
    values = pa.StructArray.from_arrays([pa.array(f, pa.string()) for f in fields], names)
    absent = pa.array([entries is None for entries in lists], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=absent)


def _texts(column: pa.Array) -> list[str | None]:
    try:
        return column.to_pylist()
    except UnicodeDecodeError:  # what is not UTF-8 becomes U+FFFD, as in Spark's functions
        return [None if b is None else b.decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]


def _find(xml: pa.Array) -> pa.Array:
    return _column([None if text is None else _entries(text) for text in _texts(xml)])


def _walk(batches: Iterator[pa.RecordBatch], marks: bool) -> Iterator[pa.RecordBatch]:
    """The records of byte ranges with the comment state they start in.

    The state is that of the last mark before a record in its range, and unknown up to the
    first mark; so there are two answers for each record, if its range starts outside a comment
    (``out``) and if it starts inside one (``in``).  With ``marks``: one row per stretch of a
    range in a batch, its place in the range, the last state its marks leave (null: no mark) and whether
    it holds entries.  Otherwise: the entries of each record.
    """
    at, seq, state = None, 0, None
    for batch in batches:
        values = _texts(batch.column("value"))
        places = zip(batch.column("file_path").to_pylist(), batch.column("block").to_pylist(), strict=True)
        stretches: list[list] = []
        out: list[list[tuple]] = []
        inside: list[list[tuple]] = []
        seqs = []
        for value, place in zip(values, places, strict=True):
            if place != at or not stretches:
                if place != at:
                    at, seq, state = place, 0, None
                stretches.append([*place, seq, None, False, False])
            opened, closed = value.rfind("<!--"), value.rfind("-->")
            rest = value[value.find("-->") + 3 :] if closed >= 0 and state != 0 else ""
            if marks:
                stretch = stretches[-1]
                if not stretch[4] and _START.search(value if state != 1 else rest):
                    stretch[4] = bool(_entries(value if state != 1 else rest))
                if not stretch[5] and _START.search(value if state == 0 else rest):
                    stretch[5] = bool(_entries(value if state == 0 else rest))
            else:
                out.append(_entries(value if state != 1 else rest))
                inside.append(out[-1] if state is not None else _entries(rest))
            seqs.append(seq)
            seq += 1
            if opened >= 0 or closed >= 0:
                state = int(opened > closed)
                stretches[-1][3] = state
        if marks:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]
            names = ["file_path", "block", "seq", "leaves", "any_out", "any_in"]
            columns = list(zip(*stretches, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        else:
            yield pa.RecordBatch.from_arrays(
                [batch.column("file_path"), batch.column("block"), pa.array(seqs, pa.int64()), _column(out), _column(inside)],
                names=["file_path", "block", "seq", "out", "inside"],
            )


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``<url>`` element of the XML files below ``path``, read in byte ranges.

    Rows are those of ``sitemap_urls``; a file without any entry is one ``unreadable_document``.
    """
    records = (
        spark.read.option("recursiveFileLookup", "true")
        .option("lineSep", "</url>")
        .text(path)
        .select("value", "_metadata.file_path", F.col("_metadata.file_block_start").alias("block"))
    )
    stretches = records.mapInArrow(
        partial(_walk, marks=True),
        "file_path string, block long, seq long, leaves int, any_out boolean, any_in boolean",
    )
    # A stretch's own answers hold from the start of its range: its walk knows the marks before it.
    last = F.max(F.when(F.col("leaves").isNotNull(), F.struct("seq", "leaves")))
    ranges = stretches.groupBy("file_path", "block").agg(
        last["leaves"].alias("leaves"), F.max("any_out").alias("any_out"), F.max("any_in").alias("any_in")
    )
    file = Window.partitionBy("file_path").orderBy("block")
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("start", F.coalesce(F.last("leaves", ignorenulls=True).over(earlier), F.lit(0)))
    some = F.when(F.col("start") == 1, F.col("any_in")).otherwise(F.col("any_out"))
    ranges = ranges.select(
        "file_path",
        "block",
        "start",
        (~F.max(some).over(Window.partitionBy("file_path")) & (F.row_number().over(file) == 1)).alias("alone"),
    )
    walked = records.mapInArrow(
        partial(_walk, marks=False), f"file_path string, block long, seq long, out {FOUND}, inside {FOUND}"
    )
    # One row per byte range of the input.
    placed = walked.join(F.broadcast(ranges), ["file_path", "block"])
    entries = F.when(F.col("start") == 1, F.col("inside")).otherwise(F.col("out"))
    found = placed.select("seq", "alone", F.explode_outer(entries).alias("_found"))
    # The first record of a file without entries stands for the file.
    return _fields(found.where(F.col("_found").isNotNull() | (F.col("alone") & (F.col("seq") == 0))), [])


def _entry(piece: Column) -> Column:
    """One piece of text as an entry; what is unusual but readable in it is mended first."""
    # The entry's own prefix is the sitemap's: its tags lose it.  Other prefixes are declared
    # at the document's root, which a piece does not have.
    prefix = F.regexp_extract(piece, _OPEN, 1)
    own = F.concat(F.lit("(</?)"), F.regexp_replace(prefix, r"\.", r"\\."))
    bare = F.when(prefix != "", F.regexp_replace(piece, own, F.lit("$1"))).otherwise(piece)
    plain = F.regexp_replace(bare, r"(</?)([A-Za-z][\w.-]*):", "$1$2_")
    closed = F.concat(plain, F.lit("</url>"))
    mended = F.when(closed.contains("<![CDATA["), closed).otherwise(
        F.regexp_replace(closed, _BARE_AND, "&amp;")
    )
    parsed = F.from_xml(mended, ENTRY, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    first = lambda array: F.get(array, F.lit(0))
    return let(
        parsed,
        lambda u: F.struct(
            (u.isNull() | u["_corrupt_record"].isNotNull()).alias("broken"),
            first(u["loc"]).alias("loc"),
            first(u["lastmod"]).alias("lastmod"),
            F.coalesce(first(u["news_news"]["news_title"]), first(u["news_title"])).alias("news_title"),
        ),
    )


def sitemap_urls(documents: DataFrame, xml: str) -> DataFrame:
    """One row per ``<url>`` of the sitemaps in the text column ``xml``, or more exactly:

    ``position`` is the entry's place in its document (from 0).
    ``loc``, ``lastmod`` and ``news_title`` are the entry's first of each.  Entries are read
    one by one, so a broken one does not take its document along; entries inside comments are
    none, and ``<s:url>`` is read as ``<url>`` with its ``s:`` tags.  ``reason`` tells why an
    entry cannot become an article: ``unreadable_document`` (no entry in it),
    ``unreadable_entry``, ``missing_link`` or ``bad_date``.
    """
    kept = [c for c in documents.columns if c != xml]
    found = documents.select(*kept, arrow_udf(_find, FOUND)(F.col(xml)).alias("_found"))
    # Outer, because an inner explode makes the optimizer test the size of the array first.
    entries = found.select(*kept, F.posexplode_outer("_found").alias("position", "_found"))
    return _fields(entries, [*kept, "position"])


def _fields(entries: DataFrame, kept: list[str]) -> DataFrame:
    """Entries (``_found``, null for a document without any) with their fields and ``reason``."""
    plain = F.struct(F.lit(False).alias("broken"), *[f"_found.{c}" for c in ("loc", "lastmod", "news_title")])
    read = F.when(F.col("_found.piece").isNull(), plain).otherwise(_entry(F.col("_found.piece")))
    # Behind a generator the parse is made once, not again inside every filter on its fields.
    parsed = entries.select("*", F.explode(F.array(read)).alias("_u"))
    fields = parsed.select(
        *kept,
        F.col("_found").isNull().alias("_absent"),
        F.col("_u.broken").alias("_broken"),
        "_u.loc",
        "_u.lastmod",
        "_u.news_title",
    )
    reason = (
        F.when(F.col("_absent"), "unreadable_document")
        .when(F.col("_broken"), "unreadable_entry")
        .when(F.coalesce(F.col("loc"), F.lit("")) == "", "missing_link")
        .when(iso_date(F.col("lastmod")).isNull(), "bad_date")
    )
    return fields.withColumn("reason", reason).drop("_absent", "_broken")


def sitemap_rejects(urls: DataFrame) -> DataFrame:
    """The entries that cannot become articles, with ``reason``."""
    return urls.where(F.col("reason").isNotNull())


def sitemap_articles(urls: DataFrame, target: Column | dt.date | str) -> DataFrame:
    """Entries of ``target``: title, link and date text next to the carried columns.

    Entries without an address are skipped.  The title is the news title when there is one,
    otherwise it is read from the address.
    """
    link = strip(F.col("loc"))
    title = F.when(F.coalesce("news_title", F.lit("")) != "", strip(F.col("news_title"))).otherwise(
        slug_title(link)
    )
    wanted = urls.where(F.col("reason").isNull() & (iso_date(F.col("lastmod")) == as_date(target)))
    # After the filter the entry's date is the target, so it is not worked out again.
    return wanted.select(
        *[c for c in urls.columns if c not in FIELDS],
        title.alias("title"),
        link.alias("link"),
        F.date_format(as_date(target), "yyyy-MM-dd").alias("date_text"),
        as_date(target).alias("article_date"),
    )
