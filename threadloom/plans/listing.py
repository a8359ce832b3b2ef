"""Listing job: forum list pages to thread rows, rejects and forum statistics."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.dates import forum_date_text, forum_date_ts, instant, offset_date_ts
from threadloom.functions.links import absolute_link
from threadloom.functions.markup import firsts
from threadloom.functions.text import strip
from threadloom.operators import crawl
from threadloom.operators.filters import KEEP, SKIP, first_per_link, keyword_pattern, link_status
from threadloom.operators.lookup import with_forum
from threadloom.operators.records import explode_items
from threadloom.operators.validate import REASON, accepted, clean_validate, rejects
from threadloom.profiles import Listing, SiteProfile
from threadloom.session import configure, stored


def _instant(listing: Listing, zone: str, raw: Column, as_of: Column) -> Column:
    """Instant of a listed date; null for dates that are only shown."""
    if listing.dates == "forum":
        return forum_date_ts(raw, as_of, zone)
    if listing.dates == "offset":
        return offset_date_ts(raw)
    return F.lit(None).cast("timestamp")


def page_items(
    pages: DataFrame,
    profile: SiteProfile,
    keywords: Iterable[str],
    as_of: datetime | str | Column | None = None,
    base: Column | None = None,
) -> DataFrame:
    """One row per page with its listed threads as an array; the HTML ends here.

    Relative dates and the end of the date range count from ``as_of``: one moment, a column, or by
    default the time at which each page was fetched.

    Every later step (page limits, statistics, thread rows) works on these narrow rows.
    """
    listing, now = profile.listing, instant(F.col("fetched_at") if as_of is None else as_of)
    pattern = keyword_pattern(keywords)
    base_url = profile.base_url if base is None else base

    def texts(r: Column) -> Column:
        return firsts(r, listing.title, listing.link, listing.date)

    def fields(x: Column, i: Column) -> Column:
        title, raw_date = x[0], x[2]
        return F.struct(
            (i + 1).alias("item_no"),
            title.alias("thread_title"),
            x[1].alias("href"),
            raw_date.alias("raw_date"),
            _instant(listing, profile.zone, raw_date, now).alias("thread_ts"),
        )

    def judged(x: Column) -> Column:
        if listing.dates == "forum":
            text = forum_date_text(x["raw_date"], x["thread_ts"], profile.zone)
        else:
            text = x["raw_date"]
        filter_text = F.lit(None).cast("string") if listing.dates == "shown" else text
        on_link = listing.keyword_on == "thread_link"
        status = link_status(
            x["thread_title"],
            x["href"] if on_link else x["thread_title"],
            filter_text,
            x["thread_ts"],
            pattern,
            listing.start_date,
            now,
        )
        link = absolute_link(x["href"], base_url)
        return F.struct(
            x["item_no"].alias("item_no"),
            (strip(x["thread_title"]) if listing.strip_title else x["thread_title"]).alias("thread_title"),
            (link if listing.join_links else F.when(x["href"].startswith("/"), link).otherwise(x["href"])).alias(
                "thread_link"
            ),
            text.alias("thread_date"),
            x["thread_ts"].alias("thread_ts"),
            status.alias("status"),
        )

    items = listing.records.column(F.col("html"))
    items = F.transform(F.transform(F.transform(items, texts), fields), judged)
    keys = [c for c in pages.columns if c != "html"]
    return pages.select(*keys, items.alias("items"))


def listed_threads(items: DataFrame, profile: SiteProfile) -> DataFrame:
    """Thread rows of all pages: kept ones, and rejected ones with their reason."""
    rows = explode_items(items, "items", "_t").filter(F.col("_t.status") != SKIP)
    status = F.col("_t.status")
    reason = F.when(status != KEEP, status).when(
        F.col("_t.thread_link").isNull(), "Missing thread_link"
    )
    threads = rows.select(
        "site",
        "_t.thread_title",
        "_t.thread_link",
        "_t.thread_date",
        "_t.thread_ts",
        "forum_name",
        "forum_url",
        "page_no",
        "_t.item_no",
        reason.alias(REASON),
    )
    return clean_validate(threads, profile.listing.rules, profile.zone) if profile.listing.rules else threads


def prepare_seeds(seeds: DataFrame, profile: SiteProfile) -> DataFrame:
    """The site's seed forums, one per canonical link."""
    return first_per_link(seeds.filter(F.col("site") == profile.site), "url", ["ord", "url"])


@dataclass(frozen=True)
class ListingResult:
    threads: DataFrame
    rejects: DataFrame
    stats: DataFrame


def listing_job(
    pages: DataFrame,
    seeds: DataFrame,
    profile: SiteProfile,
    keywords: Iterable[str],
    as_of: datetime | str | Column | None = None,
    reuse: bool = True,
) -> ListingResult:
    """Threads, rejects and statistics of one site's list pages.

    ``reuse`` stores the extracted page items in the shared folder, so the HTML is read and
    searched once for all three results; without it each result scans the pages. A profile that
    stops at an empty page or has a page cap needs the items twice, so there they are always
    stored; both work on these narrow rows, never on HTML.
    """
    configure(pages.sparkSession)
    listing = profile.listing
    site_seeds = prepare_seeds(seeds, profile)
    site_pages = pages.filter(F.col("site") == profile.site)
    items = with_forum(page_items(site_pages, profile, keywords, as_of), site_seeds)
    if reuse or listing.stop_at_empty or listing.page_cap:
        items = stored(items, "items")
    if listing.page_cap:
        items = crawl.first_pages(items, listing.page_cap)
    if listing.stop_at_empty:
        items = crawl.pages_until_empty(items.withColumn("n_items", F.size("items")))
    stats = crawl.forum_stats(items)
    if listing.zero_rows:
        stats = crawl.with_zero_rows(stats, site_seeds)
    threads = listed_threads(items, profile)
    return ListingResult(accepted(threads), rejects(threads), stats)
