"""Content job: thread pages and a work list to post rows, accepted or rejected."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.binding import let
from threadloom.functions.markup import every, firsts, nested_regions, without_hidden
from threadloom.functions.text import fallback
from threadloom.operators.filters import allowed_host, first_per_link, usable_worklist
from threadloom.operators.lookup import with_thread, with_thread_salted
from threadloom.operators.records import explode_items, tail_date, tail_position
from threadloom.operators.validate import accepted, clean_validate, rejects
from threadloom.profiles import PostPart, SiteProfile
from threadloom.session import configure, stored


def _posts(records: Column, part: PostPart) -> Column:
    """The posts of one part of a profile, as an array of structs."""

    def fields(r: Column, i: Column) -> Column:
        tail = every(r, part.tail) if part.tail else F.lit(None).cast("array<string>")
        return F.struct(
            firsts(r, part.author, part.date, part.position).alias("found"),
            part.text(r).alias("text"),
            tail.alias("tail"),
            (i + part.first_position).cast("string").alias("ordinal"),
        )

    def post(x: Column) -> Column:
        if part.tail:
            date, position = tail_date(x["tail"]), tail_position(x["tail"])
        else:
            date, position = x["found"][1], x["found"][2] if part.position else x["ordinal"]
        return F.struct(
            x["found"][0].alias("author_id"),
            date.alias("date"),
            position.alias("position"),
            x["text"].alias("text"),
            F.lit(not (part.date or part.tail)).alias("thread_dated"),
        )

    return F.transform(F.transform(records, fields), post)


def page_posts(pages: DataFrame, profile: SiteProfile) -> DataFrame:
    """One row per page with all its posts, main post first, as an array; the HTML ends here."""
    keys = [c for c in pages.columns if c != "html"]
    html, parts, scope = F.col("html"), profile.posts, profile.post_scope
    if not scope:
        lists = [_posts(part.records.column(html), part) for part in parts]
        posts = F.concat(*lists) if len(lists) > 1 else lists[0]
    elif len(parts) == 1:
        path = (*scope, *parts[0].records.path)
        posts = _posts(nested_regions(without_hidden(html), path), parts[0])
    else:
        # The scopes are cut out once and every part looks for its records in them.
        def all_parts(scopes: Column) -> Column:
            found = []
            for part in parts:
                records = part.records
                inside = F.flatten(F.transform(scopes, lambda x: nested_regions(x, records.path)))
                found.append(_posts(records.chosen(inside), part))
            return F.concat(*found)

        posts = let(nested_regions(without_hidden(html), scope), all_parts)
    return pages.select(*keys, posts.alias("posts"))


def extract_posts(pages: DataFrame, worklist: DataFrame, profile: SiteProfile, salted: bool = False) -> DataFrame:
    """Raw post rows. Thread fields join the extracted arrays, one row per page, not the HTML.

    ``salted`` splits large threads by their counted pages, for jobs without adaptive execution. It counts
    pages by link first and reads no HTML for that.
    """
    join = with_thread_salted if salted else with_thread
    return post_rows(join(page_posts(pages, profile), worklist), profile)


def post_rows(joined: DataFrame, profile: SiteProfile) -> DataFrame:
    """One row per post of pages that have met their thread."""
    rows = explode_items(joined.withColumn("posts", _numbered("posts")), "posts", "_p")
    return rows.select(
        F.lit(profile.site).alias("site"),
        "_p.p.author_id",
        F.when(F.col("_p.p.thread_dated"), F.col("thread_date"))
        .otherwise(F.col("_p.p.date"))
        .alias("date"),
        "_p.p.position",
        "_p.p.text",
        "thread_title",
        fallback(F.col("thread_link"), F.col("url")).alias("thread_link"),
        "page_no",
        "_p.item_no",
    )


def _numbered(posts: str) -> Column:
    return F.transform(posts, lambda p, i: F.struct((i + 1).alias("item_no"), p.alias("p")))


@dataclass(frozen=True)
class ContentResult:
    posts: DataFrame
    rejects: DataFrame
    checked: DataFrame


def prepare_worklist(worklist: DataFrame, profile: SiteProfile) -> DataFrame:
    """Usable rows of the site's own hosts, one per canonical link.

    ``ord``, where there is one, orders repeated links; the fields settle what it leaves open.
    """
    order = [c for c in ("ord", "thread_title", "thread_date", "thread_link") if c in worklist.columns]
    usable = usable_worklist(worklist).filter(allowed_host(F.col("thread_link"), profile.domains))
    return first_per_link(usable, "thread_link", order)


def content_job(
    pages: DataFrame, worklist: DataFrame, profile: SiteProfile, reuse: bool = True
) -> ContentResult:
    """Clean posts and rejects. ``checked`` holds both, for a single write split by reason.

    ``reuse`` stores the checked rows in the shared folder, so the HTML is read and searched once
    for all results; without it each result scans the pages.
    """
    configure(pages.sparkSession)
    site_pages = pages.filter(F.col("site") == profile.site)
    raw = extract_posts(site_pages, prepare_worklist(worklist, profile), profile)
    checked = clean_validate(raw, profile.post_rules, profile.zone)
    if reuse:
        checked = stored(checked, "posts")
    return ContentResult(accepted(checked), rejects(checked), checked)
