"""Records and fields out of page HTML (one projection, no shuffle)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.binding import let
from threadloom.functions.links import absolute_link
from threadloom.functions.markup import Tag, first, nested_regions, without_hidden

_TAIL_DATE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}"


@dataclass(frozen=True)
class Records:
    """What repeats in a page: elements at the end of a tag path, or a one-group pattern.

    The pattern form is for elements that are always closed and never nest. ``merged`` makes one
    record of all that is found.
    """

    path: tuple[Tag, ...] = ()
    pattern: str | None = None
    only_first: bool = False
    skip: int = 0
    merged: bool = False

    def column(self, html: Column) -> Column:
        """The records of a page."""
        return self.inside(html if self.pattern else without_hidden(html))

    def inside(self, text: Column) -> Column:
        """The records of a text that is free of comments and scripts."""
        if self.pattern:
            found = F.regexp_extract_all(text, F.lit(self.pattern), F.lit(1))
        else:
            found = nested_regions(text, self.path)
        return self.chosen(found)

    def chosen(self, found: Column) -> Column:
        """Those of the elements found that count, or one for all."""
        if self.merged:
            return let(found, lambda x: F.when(F.size(x) > 0, F.array(F.array_join(x, ""))).otherwise(x))
        if self.only_first:
            return F.slice(found, 1, 1)
        return F.slice(found, self.skip + 1, 1 << 30) if self.skip else found


def explode_items(df: DataFrame, array: str, item: str) -> DataFrame:
    """One row per array element; rows with an empty array vanish.

    The outer form followed by a filter: for a plain ``explode`` Catalyst puts a size check
    below the generator, and the pushed-down check would run the whole extraction a second time.
    """
    others = [c for c in df.columns if c != array]
    exploded = df.select(*others, F.explode_outer(array).alias(item))
    return exploded.filter(F.col(item).isNotNull())


def extract_records(df: DataFrame, records: Records, html: str = "html") -> DataFrame:
    """``item_no`` (from 1, document order) and ``record``; the page text is dropped at once."""
    others = [c for c in df.columns if c != html]
    numbered = F.transform(
        records.column(F.col(html)),
        lambda r, i: F.struct((i + 1).alias("item_no"), r.alias("record")),
    )
    items = explode_items(df.select(*others, numbered.alias("_items")), "_items", "_item")
    return items.select(*others, "_item.item_no", "_item.record")


def next_page_edges(
    df: DataFrame, pattern: str, base: str | Column, html: str = "html", url: str = "url"
) -> DataFrame:
    """``page_url -> next_url`` for pages that link to a next page."""
    root = F.lit(base) if isinstance(base, str) else base
    hrefs = F.array(first(F.col(html), pattern))
    pages = df.select(F.col(url).alias("page_url"), root.alias("_base"), hrefs.alias("_hrefs"))
    edges = explode_items(pages, "_hrefs", "_href")
    return edges.select("page_url", absolute_link(F.col("_href"), F.col("_base")).alias("next_url"))


def tail_position(texts: Column) -> Column:
    """Last text that names a floor (ends in 楼)."""
    return F.try_element_at(F.filter(texts, lambda x: x.endswith("楼")), F.lit(-1))


def tail_date(texts: Column) -> Column:
    """Last text that begins like ``YYYY-MM-DD HH:MM`` and names no floor."""
    dates = F.filter(texts, lambda x: ~x.endswith("楼") & x.rlike(_TAIL_DATE))
    return F.try_element_at(dates, F.lit(-1))
