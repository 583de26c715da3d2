"""Date normalisation for article pages, as native columns.

Every parser returns a DATE, or NULL for text it cannot read; none of them raises under ANSI
mode and none looks at the clock: "today" is always the caller's ``as_of``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Month names in calendar order.
INDONESIAN_MONTHS = (
    "januari", "februari", "maret", "april", "mei", "juni", "juli", "agustus", "september",
    "oktober", "november", "desember",
)
ENGLISH_MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december",
)

ISO_DATE = r"\d{4}-\d{2}-\d{2}"


# The characters that count as white space around a text.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def plain_blanks(text: Column) -> Column:
    """White space of any kind as ordinary blanks, as the patterns below expect it."""
    return F.translate(text, BLANKS, " " * len(BLANKS))


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` only removes blanks)."""
    return F.btrim(text, F.lit(BLANKS))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Written out, a value used in several branches of a CASE is computed once per use; for
    regular expressions that multiplies.
    """
    return F.transform(F.array(value), body)[0]


def as_date(value: Column | dt.date | str) -> Column:
    """A DATE column from a column, a ``date`` or an ISO string."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def month_number(name: Column, months: tuple[str, ...] = INDONESIAN_MONTHS) -> Column:
    """1..12, or NULL for a name that is not in ``months``."""
    position = F.array_position(F.array(*[F.lit(m) for m in months]), F.lower(name))
    return F.nullif(position, F.lit(0).cast("bigint"))


def _ymd(year: Column, month: Column, day: Column) -> Column:
    """DATE from digits, NULL when they do not form one (``make_date`` would raise)."""
    iso = F.concat(year, F.lit("-"), month.cast("string"), F.lit("-"), day)
    return F.when(~iso.startswith("0000"), iso).try_cast("date")


def _whole(text: Column) -> Column:
    """Text of a whole number without leading zeros, NULL for anything else."""
    return text.try_cast("int").cast("string")


def _year(text: Column) -> Column:
    """A whole number of four digits at most."""
    return F.when(F.length(_whole(text)) <= 4, _whole(text))


def _token(tokens: Column, position: int) -> Column:
    return F.try_element_at(tokens, F.lit(position))


def relative_date(text: Column | str, as_of: Column | dt.date | str) -> Column:
    """Listing dates that may be relative to the day the page was fetched.

    In order: anything containing ``lalu`` (ago) but not ``kemarin`` is ``as_of``;
    ``kemarin`` (yesterday) is the day before; a leading ``D month YYYY``; an embedded ISO
    date; otherwise NULL.  A known month with an impossible day does not fall through.
    """
    text = F.col(text) if isinstance(text, str) else text
    today = as_date(as_of)

    def written(clean: Column) -> Column:
        leading = F.regexp_extract(clean, r"^\d{1,2}\s+[a-z]+\s+\d{4}", 0)
        return let(
            F.split(leading, r"\s+"),
            lambda p: F.when(
                month_number(_token(p, 2)).isNotNull(),
                _ymd(_token(p, 3), month_number(_token(p, 2)), _token(p, 1)),
            ).otherwise(F.regexp_extract(clean, ISO_DATE, 0).try_cast("date")),
        )

    return let(
        F.lower(F.trim(plain_blanks(text))),
        lambda clean: F.when(clean.contains("kemarin"), F.date_sub(today, 1))
        .when(clean.contains("lalu"), today)
        .otherwise(written(clean)),
    )


def long_date(text: Column | str) -> Column:
    """``"Sabtu, 16 Mei 2026 10:37 WIB"``: day, month name and year are tokens two to four."""
    text = F.col(text) if isinstance(text, str) else text
    return let(
        F.split(F.trim(plain_blanks(F.replace(text, F.lit(","), F.lit("")))), r"\s+"),
        lambda p: _ymd(_year(_token(p, 4)), month_number(_token(p, 3)), _whole(_token(p, 2))),
    )


def iso_date(text: Column | str) -> Column:
    """Sitemap dates; the written calendar date is kept, no zone shift is applied.

    A first blank-separated token shaped like an ISO date decides alone.  Otherwise any
    embedded ISO date, then ISO with one-digit month or day, then English long forms.
    """
    text = F.col(text) if isinstance(text, str) else text
    loose = r"^(\d{4}-\d{1,2}-\d{1,2})(?:T\d{1,2}:\d{1,2}:\d{1,2}(?:Z|[+-]\d{2}:?\d{2}))?$"

    def english(clean: Column) -> Column:
        clean = plain_blanks(clean)
        parts = F.split(F.replace(clean, F.lit(","), F.lit("")), r"\s+")
        day_first = clean.rlike(r"^\d{1,2}\s+[A-Za-z]+\s+\d{4}$")
        month_first = clean.rlike(r"^[A-Za-z]+\s+\d{1,2},\s+\d{4}$")
        month = lambda i: month_number(_token(parts, i), ENGLISH_MONTHS)
        return (
            F.when(day_first, _ymd(_token(parts, 3), month(2), _token(parts, 1)))
            .when(month_first, _ymd(_token(parts, 3), month(1), _token(parts, 2)))
        )

    def unspaced(clean: Column) -> Column:
        return let(
            F.regexp_extract(clean, ISO_DATE, 0),
            lambda iso: F.when(iso != "", iso.try_cast("date"))
            .when(clean.rlike(loose), F.regexp_extract(clean, loose, 1).try_cast("date"))
            .otherwise(english(clean)),
        )

    def anywhere(text: Column) -> Column:
        return let(
            strip(text),
            lambda clean: F.when(
                clean.rlike(r"^[^ ]{4}-[^ ]{2}-[^ ]{2} "), F.left(clean, F.lit(10)).try_cast("date")
            ).otherwise(unspaced(clean)),
        )

    # Text that begins with an ISO date is decided by it, whatever follows.
    return F.when(text.rlike(f"^{ISO_DATE}"), F.left(text, F.lit(10)).try_cast("date")).otherwise(anywhere(text))


def stringify_dates(df: DataFrame) -> DataFrame:
    """Every DATE or TIMESTAMP column as ``YYYY-MM-DD`` text; other columns untouched."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
            if isinstance(f.dataType, kinds)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
