"""Row filters: keywords, date range, allowed domains, work-list rows and repeated links."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.binding import let
from threadloom.functions.dates import instant
from threadloom.functions.links import canonical_url, host

KEEP, SKIP = "keep", "skip"


def keyword_pattern(keywords: Iterable[str], literal: bool = False) -> str:
    """One pattern for all keywords. They are regular expressions unless ``literal`` is set."""
    words = list(keywords)
    if literal:
        words = ["\\Q" + w.replace("\\E", "\\E\\\\E\\Q") + "\\E" for w in words]
    return "(?iu)(?:" + "|".join(words) + ")"


def matches_keyword(c: Column, keywords: Iterable[str], literal: bool = False) -> Column:
    """Case-insensitive search anywhere in the text; an empty list matches every text."""
    return c.rlike(keyword_pattern(keywords, literal))


def in_date_range(ts: Column, start: str | datetime | Column, as_of: Column) -> Column:
    """From the start date at 00:00 UTC up to ``as_of``, both ends included."""
    return ts.between(start if isinstance(start, Column) else instant(start), as_of)


def link_status(
    title: Column, target: Column, date_text: Column, ts: Column, keep: str, start: str, as_of: Column
) -> Column:
    """``keep``, ``skip`` or a reject reason for one listed thread.

    A missing date means the keyword decides alone; a date that cannot be read is a reject, and so is one that
    cannot be judged because it is not known when the page was fetched.
    """
    dated = date_text.isNotNull()
    timeless = dated & as_of.isNull() & (ts.isNull() | target.rlike(keep))
    return (
        F.when(F.coalesce(title, F.lit("")) == "", SKIP)
        .when(F.coalesce(target, F.lit("")) == "", SKIP)
        .when(timeless, "Missing fetched_at")
        .when(dated & ts.isNull(), "Invalid thread_date")
        .when(target.rlike(keep) & (~dated | in_date_range(ts, start, as_of)), KEEP)
        .otherwise(SKIP)
    )


def usable_worklist(df: DataFrame) -> DataFrame:
    """Work-list rows that have both a title and a link."""
    return df.filter((F.col("thread_title") != "") & (F.col("thread_link") != ""))


def allowed_host(url: Column, domains: Iterable[str]) -> Column:
    """Whether the URL's host is one of the domains or below one; no domains allow every URL."""
    names = [d.lower() for d in domains]
    if not names:
        return F.lit(True)

    def verdict(found: Column) -> Column:
        inside = [found.endswith("." + name) for name in names]
        return reduce(Column.__or__, inside, found.isin(names))

    return let(F.coalesce(host(url), F.lit("")), verdict)


def first_per_link(df: DataFrame, link: str, order: Iterable[str]) -> DataFrame:
    """The first row, by ``order``, of every canonical link.

    ``row_number = 1`` lets Spark keep a single row per link before the shuffle, so one link
    that makes up a third of the rows costs one row per task, not one huge group.
    """
    key = Window.partitionBy("_key").orderBy(*order)
    return (
        df.withColumn("_key", canonical_url(F.col(link)))
        .withColumn("_rank", F.row_number().over(key))
        .filter("_rank = 1")
        .drop("_key", "_rank")
    )
