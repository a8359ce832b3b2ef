"""Literal pages of each site through the listing and content jobs."""

from datetime import datetime

import pytest

from threadloom import profiles, schemas
from threadloom.operators.validate import accepted
from threadloom.plans.content import content_job
from threadloom.plans.listing import listing_job

AS_OF = "2024-02-01 00:00:00"
AUTOHOME_LIST = (
    '<div><ul class="post-list"><li><p class="post-title"><a href="/bbs/thread/1.html">违章怎么办</a></p>'
    '<div class="post-basic-info"><i class="time">2天前</i></div></li></ul></div>'
)
TESLA_LIST = (
    '<div class="structItem-cell structItem-cell--main"><a class="thread-title--gtm" href="/threads/crash.1/">'
    'Crash on I-95</a><time class="thread-time--gtm" datetime="2024-01-10T10:00:00-0400"></time></div>'
)
TIEBA_LIST = (
    '<div><ul id="thread_list" class="threadlist_bright"><li class="j_thread_list"><a class="j_th_tit" '
    'href="/p/123">交通事故</a><span class="threadlist_reply_date">10:30</span></li></ul></div>'
)
AUTOHOME_POSTS = (
    '<section class="fn-container"><div class="post-wrap"><div class="user-name"><a class="name">u1</a></div>'
    '<div class="tz-paragraph"> one </div><div class="tz-paragraph">two</div></div><ul class="reply-wrap">'
    '<li class="js-reply-floor-container"><div class="user-name"><a class="name">u2</a></div>'
    '<span class="reply-static-text"><strong>2024-05-01 10:30</strong></span>'
    '<div class="reply-detail"><div> okay </div></div></li></ul></section>'
)
TIEBA_POSTS = (
    '<div class="p_postlist"><div class="l_post"><a class="p_author_name">u1</a><div class="d_post_content">'
    'a <b>b</b></div><span class="tail-info">1楼</span><span class="tail-info">2024-05-01 10:30</span></div></div>'
)
TESLA_POSTS = (
    '<div class="MessageCard"><a class="MessageCard__user-info__name" data-user-id="7">x</a>'
    '<a class="MessageCard__date-created"><time class="u-dt" datetime="2024-05-01T10:00:00-0400"></time></a>'
    '<a class="MessageCard__post-position"> #1 </a><div class="bbWrapper">line one<br>line two</div></div>'
)


def pages_of(spark, profile, *htmls, seed="https://f/"):
    rows = [(profile.site, seed, n, f"{seed}?{n}", h, None) for n, h in enumerate(htmls, 1)]
    return spark.createDataFrame(rows, schemas.PAGES)


def seeds_of(spark, profile, *rows):
    rows = rows or (("f1", "https://f/"),)
    return spark.createDataFrame(
        [(profile.site, n, name, url, None) for n, (name, url) in enumerate(rows)], schemas.SEEDS
    )


def run_listing(spark, profile, keywords, *htmls, **kw):
    return listing_job(pages_of(spark, profile, *htmls), seeds_of(spark, profile), profile, keywords, AS_OF, **kw)


@pytest.mark.parametrize("reuse", [True, False])
def test_autohome_listing(spark, reuse):
    got = run_listing(spark, profiles.AUTOHOME, ["违章"], AUTOHOME_LIST, reuse=reuse)
    row = got.threads.first()
    assert row.thread_title == "违章怎么办"
    assert row.thread_link == "https://club.autohome.com.cn/bbs/thread/1.html"
    assert row.thread_date == "2024-01-30T08:00:00+0800"
    assert row.thread_ts == datetime(2024, 1, 30)
    assert (row.forum_name, row.forum_url, row.page_no, row.item_no) == ("f1", "https://f/", 1, 1)
    assert got.rejects.count() == 0
    assert got.stats.collect() == [("autohome", "f1", 1, 1, 1)]


def test_autohome_listing_ignores_other_lists_and_bad_rows(spark):
    bad = (
        "<ul><li>nav</li></ul><ul class='post-list hot'>"
        '<li><p class="post-title"><a href="//club.autohome.com.cn/2">违章 A&amp;B</a></p></li>'
        '<li><p class="post-title"><a>违章 no link</a></p></li>'
        '<li><p class="post-title"><a href="/3">违章</a></p><div class="post-basic-info"><i class="time">junk</i></div></li>'
        '<li><p class="post-title"><a href="/4">天气</a></p></li>'
        "<li><p>no title</p></li></ul>"
    )
    got = run_listing(spark, profiles.AUTOHOME, ["违章"], bad)
    assert [(r.thread_title, r.thread_link, r.thread_date, r.item_no) for r in got.threads.collect()] == [
        ("违章 A&B", "https://club.autohome.com.cn/2", None, 1)
    ]
    assert {(r.item_no, r.reject_reason) for r in got.rejects.collect()} == {
        (2, "Missing thread_link"),
        (3, "Invalid thread_date"),
    }
    assert got.stats.collect() == [("autohome", "f1", 1, 5, 2)]


def test_tesla_listing_stops_at_empty_page_and_filters_on_link(spark):
    got = run_listing(spark, profiles.TESLA, ["Crash", "Traffic violation"], TESLA_LIST, "<p>none</p>", TESLA_LIST)
    assert [(r.thread_title, r.thread_link, r.thread_date, r.page_no) for r in got.threads.collect()] == [
        ("Crash on I-95", "https://www.teslaownersonline.com/threads/crash.1/", "2024-01-10 14:00:00 UTC", 1)
    ]
    assert got.stats.collect() == [("teslaowners", "f1", 2, 1, 1)]


def test_tesla_keyword_with_space_cannot_match_a_slug(spark):
    page = TESLA_LIST.replace("crash.1", "traffic-violation.1").replace("Crash on", "Traffic violation on")
    got = run_listing(spark, profiles.TESLA, ["Traffic violation"], page)
    assert got.threads.count() == 0 and got.rejects.count() == 0
    assert got.stats.first().yielded == 0


def test_tesla_listing_without_date_is_counted_then_rejected(spark):
    page = TESLA_LIST.replace(' datetime="2024-01-10T10:00:00-0400"', "")
    got = run_listing(spark, profiles.TESLA, ["crash"], page)
    assert [r.reject_reason for r in got.rejects.collect()] == ["Missing thread_date"]
    assert got.stats.first().yielded == 1


def test_zero_rows_only_where_the_profile_says(spark):
    tesla = listing_job(
        pages_of(spark, profiles.TESLA, TESLA_LIST),
        seeds_of(spark, profiles.TESLA, ("f1", "https://f/"), ("f2", "https://g/")),
        profiles.TESLA,
        ["crash"],
        AS_OF,
    )
    assert {tuple(r) for r in tesla.stats.collect()} == {
        ("teslaowners", "f1", 1, 1, 1),
        ("teslaowners", "f2", 0, 0, 0),
    }


def test_tieba_listing_keeps_shown_date(spark):
    got = run_listing(spark, profiles.TIEBA, ["事故"], TIEBA_LIST)
    assert [(r.thread_title, r.thread_link, r.thread_date, r.thread_ts) for r in got.threads.collect()] == [
        ("交通事故", "https://tieba.baidu.com/p/123", "10:30", None)
    ]


def run_content(spark, profile, html, *threads):
    seed = threads[0][1] if threads else f"{profile.base_url}/t/1"
    worklist = spark.createDataFrame(list(threads), schemas.WORKLIST)
    return content_job(pages_of(spark, profile, html, seed=seed), worklist, profile)


def test_autohome_posts(spark):
    link = "https://club.autohome.com.cn/bbs/thread/1.html"
    got = run_content(spark, profiles.AUTOHOME, AUTOHOME_POSTS, ("违章怎么办", link, "2024-01-30T08:00:00+0800"))
    rows = sorted(got.posts.collect(), key=lambda r: r.item_no)
    assert [(r.author_id, r.position, r.text, r.date, r.thread_title, r.thread_link) for r in rows] == [
        ("u1", "1", "onetwo", "2024-01-30 00:00:00 UTC", "违章怎么办", link),
        ("u2", "2", "okay", "2024-05-01 02:30:00 UTC", "违章怎么办", link),
    ]


def test_autohome_replies_start_at_two_and_keep_only_direct_text(spark):
    html = (
        '<section class="fn-container"><ul class="reply-wrap">'
        '<li class="js-reply-floor-container"><div class="user-name"><a class="name">a</a></div>'
        '<span class="reply-static-text"><strong>2024-05-01 10:30</strong></span>'
        '<div class="reply-detail"><div> first<br>second <b>bold</b> third&amp;</div><div>next</div></div></li>'
        "</ul></section>"
    )
    link = "https://club.autohome.com.cn/1"
    got = run_content(spark, profiles.AUTOHOME, html, ("title", link, None))
    assert [(r.position, r.text) for r in got.posts.collect()] == [("2", "firstsecondthird&next")]


def test_tieba_posts(spark):
    link = "https://tieba.baidu.com/p/123"
    got = run_content(spark, profiles.TIEBA, TIEBA_POSTS, ("交通事故", link, None))
    assert [(r.author_id, r.position, r.date, r.text, r.thread_link) for r in got.posts.collect()] == [
        ("u1", "1楼", "2024-05-01 02:30:00 UTC", "a b", link)
    ]


def test_tesla_posts(spark):
    link = "https://www.teslaownersonline.com/threads/a.1/"
    got = run_content(spark, profiles.TESLA, TESLA_POSTS, ("t", link, None))
    assert [(r.author_id, r.position, r.date, r.text) for r in got.posts.collect()] == [
        ("7", "#1", "2024-05-01 14:00:00 UTC", "line one\nline two")
    ]


def test_post_of_unlisted_thread_falls_back_to_page_url_and_is_rejected(spark):
    got = run_content(spark, profiles.TIEBA, TIEBA_POSTS)
    assert [(r.thread_link, r.reject_reason) for r in got.rejects.collect()] == [
        ("https://tieba.baidu.com/t/1?1", "Missing thread_title")
    ]
    assert accepted(got.checked).count() + got.rejects.count() == got.checked.count() == 1
