"""Title text derived from article addresses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def title_case(text: Column | str) -> Column:
    """Capitalise each run of letters and lower the rest, also after digits (``1a`` -> ``1A``).

    ``initcap`` only starts a word after a blank, so a blank is put behind every other
    character first and taken out again afterwards.
    """
    text = F.col(text) if isinstance(text, str) else text
    spaced = F.regexp_replace(text, f"([^{_CASED}])", "$1 ")
    return F.regexp_replace(F.initcap(spaced), f"([^{_CASED}]) ", "$1")


def slug_title(url: Column | str) -> Column:
    """Readable title from the last path segment of an address.

    Query string, trailing slashes, one trailing numeric id and ``.html`` are removed.
    """
    url = F.col(url) if isinstance(url, str) else url
    path = F.regexp_replace(F.split_part(url, F.lit("?"), F.lit(1)), "/+$", "")
    slug = F.regexp_replace(F.split_part(path, F.lit("/"), F.lit(-1)), r"-\d+$", "")
    words = F.replace(F.replace(slug, F.lit(".html"), F.lit("")), F.lit("-"), F.lit(" "))
    return title_case(words)
