"""Text clean-up: strip, tag removal, position and fallback values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.binding import let
from threadloom.functions.entities import decode_entities
from threadloom.functions.markup import Tag, inner_html

# Every character Python's str.strip removes; Spark's own trim knows the plain space only.
WHITESPACE = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())

# One scan drops script and style blocks, comments and tags. A '<' only opens a tag before a
# letter or one of / ! ?, so "1 < 2" is text.
_MARKUP = r"(?s)<(?:((?i)script|style)\b.*?</\1\s*>|!--.*?-->|[/!?a-zA-Z][^>]*>)"
_COMMENTS_AND_TAGS = r"(?s)<(?:!--.*?-->|[/!?a-zA-Z][^>]*>)"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def collapse_spaces(c: Column) -> Column:
    # (?U) makes \s cover the no-break and ideographic spaces too.
    return F.regexp_replace(c, r"(?U)\s+", " ")


def _visible(c: Column, border: str) -> Column:
    """Markup replaced by ``border`` (texts without any '<' skip the scan), entities decoded."""

    def without_markup(text: Column) -> Column:
        return F.when(text.contains("<"), F.regexp_replace(text, _MARKUP, border)).otherwise(text)

    return decode_entities(let(c, without_markup), html5=True, bare=True)


def clean_inline(c: Column) -> Column:
    """Visible text on one line: no markup, entities decoded, single spaces."""
    return F.trim(collapse_spaces(_visible(c, " ")))


def clean_block(c: Column) -> Column:
    """Visible text of the first ``div.bbWrapper``, one line per text node; null without one."""
    inner = inner_html(c, Tag("div", ("bbWrapper",)))
    return F.regexp_replace(strip(_visible(inner, "\n")), r"(?U)\n\s*\n", "\n")


def element_text(c: Column) -> Column:
    """All text below an element in document order, nothing trimmed or put between."""
    return decode_entities(F.regexp_replace(c, _COMMENTS_AND_TAGS, ""))


def joined_text(nodes: Column) -> Column:
    """Text nodes stripped, empty ones dropped, joined without separator."""
    return F.array_join(F.filter(F.transform(nodes, lambda x: strip(x)), lambda x: x != ""), "")


def clean_position(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"(?U)\s+", "")


def fallback(c: Column, other: Column) -> Column:
    """``other`` where the value is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), other)
