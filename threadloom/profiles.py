"""What differs between sites, as data: where records and fields are, and which rules apply."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.markup import (
    OwnText,
    Tag,
    attr_in,
    direct_texts,
    inner_html,
    nested_regions,
    outer_html,
    text_in,
)
from threadloom.functions.text import element_text, joined_text
from threadloom.operators.records import Records
from threadloom.operators.validate import LISTING_RULES, POST_RULES, QUOTED_POST_RULES, Check


@dataclass(frozen=True)
class Listing:
    """A forum list page. ``dates``: 'forum' (absolute or n days ago), 'offset' (ISO text) or
    'shown' (kept as text, not used to filter). ``page_cap`` is a crawler's guard; over stored
    pages there is none unless a caller sets one. ``join_links`` puts the host before every
    link without one, not only before those that begin with a slash."""

    records: Records
    title: str | OwnText
    link: str
    date: str | OwnText
    dates: str
    keyword_on: str = "thread_title"
    start_date: str = "2020-07-01"
    page_cap: int | None = None
    stop_at_empty: bool = False
    strip_title: bool = False
    zero_rows: bool = False
    join_links: bool = True
    rules: tuple[Check, ...] = ()


@dataclass(frozen=True)
class PostPart:
    """One kind of post in a thread page. A missing ``date`` pattern means the thread's date, a
    missing ``position`` the ordinal from ``first_position``; ``tail`` yields both instead."""

    records: Records
    author: str | OwnText
    text: Callable[[Column], Column]
    date: str | OwnText | None = None
    position: str | OwnText | None = None
    tail: str | OwnText | None = None
    first_position: int = 1


@dataclass(frozen=True)
class SiteProfile:
    """A site. ``post_scope`` is the tag path all parts of a thread page lie in."""

    site: str
    base_url: str
    domains: tuple[str, ...]
    zone: str
    listing: Listing
    posts: tuple[PostPart, ...]
    post_scope: tuple[Tag, ...] = ()
    next_page: str | None = None
    post_rules: tuple[Check, ...] = field(default=POST_RULES)


# ---- Fixed values: hosts, selectors, limits and start dates of the supported sites. ----

_AH_AUTHOR = text_in(Tag("div", ("user-name",)), Tag("a", ("name",)))

AUTOHOME = SiteProfile(
    site="autohome",
    base_url="https://club.autohome.com.cn",
    domains=("club.autohome.com.cn",),
    zone="Asia/Shanghai",
    listing=Listing(
        records=Records(path=(Tag("ul", ("post-list",)), Tag("li"))),
        title=text_in(Tag("p", ("post-title",)), Tag("a"), strict=True),
        link=attr_in("href", Tag("p", ("post-title",)), Tag("a"), strict=True),
        date=text_in(Tag("div", ("post-basic-info",)), Tag("i", ("time",))),
        dates="forum",
    ),
    posts=(
        PostPart(
            records=Records(path=(Tag("div", ("post-wrap",)),), merged=True),
            author=_AH_AUTHOR,
            text=lambda r: joined_text(
                F.flatten(
                    F.transform(
                        nested_regions(r, (Tag("div", ("tz-paragraph",)),)),
                        lambda x: direct_texts(x),
                    )
                )
            ),
        ),
        PostPart(
            records=Records(
                path=(Tag("ul", ("reply-wrap",)), Tag("li", ("js-reply-floor-container",)))
            ),
            author=_AH_AUTHOR,
            date=text_in(Tag("span", ("reply-static-text",)), Tag("strong"), strict=True),
            text=lambda r: joined_text(
                F.flatten(
                    F.transform(
                        nested_regions(
                            F.coalesce(inner_html(r, Tag("div", ("reply-detail",))), F.lit("")),
                            (Tag("div"),),
                        ),
                        lambda x: direct_texts(x),
                    )
                )
            ),
            first_position=2,
        ),
    ),
    post_scope=(Tag("section", ("fn-container",)),),
)

TIEBA = SiteProfile(
    site="tieba",
    base_url="https://tieba.baidu.com",
    domains=("tieba.baidu.com",),
    zone="Asia/Shanghai",
    listing=Listing(
        records=Records(
            path=(
                Tag("ul", ("threadlist_bright",), id="thread_list"),
                Tag("li", ("j_thread_list",)),
            )
        ),
        title=text_in(Tag("a", ("j_th_tit",))),
        link=attr_in("href", Tag("a", ("j_th_tit",))),
        date=text_in(Tag("span", ("threadlist_reply_date",))),
        dates="shown",
    ),
    posts=(
        PostPart(
            records=Records(path=(Tag("div", ("l_post",)),)),
            author=text_in(Tag("a", ("p_author_name",))),
            tail=text_in(Tag("span", ("tail-info",))),
            text=lambda r: element_text(outer_html(r, Tag("div", ("d_post_content",)))),
        ),
    ),
    post_scope=(Tag("div", ("p_postlist",)),),
)

TESLA = SiteProfile(
    site="teslaowners",
    base_url="https://www.teslaownersonline.com",
    domains=("www.teslaownersonline.com",),
    zone="UTC",
    listing=Listing(
        records=Records(path=(Tag("div", ("structItem-cell", "structItem-cell--main")),)),
        title=text_in(Tag("a", ("thread-title--gtm",))),
        link=attr_in("href", Tag("a", ("thread-title--gtm",))),
        date=attr_in("datetime", Tag("time", ("thread-time--gtm",))),
        dates="offset",
        keyword_on="thread_link",
        start_date="2023-07-01",
        stop_at_empty=True,
        strip_title=True,
        zero_rows=True,
        join_links=False,
        rules=LISTING_RULES,
    ),
    posts=(
        PostPart(
            records=Records(path=(Tag("div", ("MessageCard",)),)),
            author=attr_in("data-user-id", Tag("a", ("MessageCard__user-info__name",))),
            date=attr_in("datetime", Tag("a", ("MessageCard__date-created",)), Tag("time", ("u-dt",))),
            position=text_in(Tag("a", ("MessageCard__post-position",))),
            text=lambda r: outer_html(r, Tag("div", ("bbWrapper",))),
        ),
    ),
    next_page=attr_in(
        "href",
        Tag("div", ("block-outer-opposite",)),
        Tag("a", ("pageNav-jump", "pageNav-jump--next", "button", "button--icon-only")),
    ),
    post_rules=QUOTED_POST_RULES,
)

# Plain article pages: the navigation list is the listing, the paragraphs are the posts.
# A paragraph ends at its end tag, at the next paragraph or with the article; tags inside it stay.
_PARAGRAPH = r"<p>([^<]*+(?:<(?!/?p>|/article>)[^<]*+)*+)"
_NAV_ITEM = r'(<li><a href="[^"]*">[^<]*</a></li>)'
ARTICLES = SiteProfile(
    site="articles",
    base_url="",
    domains=(),
    zone="UTC",
    listing=Listing(
        records=Records(pattern=_NAV_ITEM),
        title=r"<a [^>]*>([^<]+)",
        link=r'href="([^"]+)"',
        date=r'datetime="([^"]+)"',
        dates="shown",
    ),
    posts=(
        PostPart(
            records=Records(pattern=_PARAGRAPH, only_first=True),
            author=r"@([\w.]+)",
            text=lambda r: r,
        ),
        PostPart(
            records=Records(pattern=_PARAGRAPH, skip=1),
            author=r"@([\w.]+)",
            date=r'datetime="([^"]+)"',
            text=lambda r: r,
            first_position=2,
        ),
    ),
    next_page=r'<li><a href="([^"]*)">',
)

PROFILES = {p.site: p for p in (AUTOHOME, TIEBA, TESLA, ARTICLES)}
