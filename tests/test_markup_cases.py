"""Ordinary pages with icons, labels and nested elements of the same kind."""

import time
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_sites import AS_OF, TIEBA_LIST, pages_of, run_listing, seeds_of

from threadloom import profiles
from threadloom.functions.markup import Tag, direct_texts, every, first, regions, text_in
from threadloom.operators.validate import accepted
from threadloom.plans.content import content_job
from threadloom.plans.listing import listing_job
from threadloom.session import clear, stored
from threadloom.sources.readers import read_worklist
from threadloom.sources.writers import write_rows
from threadloom.streaming import incremental


def value(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column(F.col("html"))).first()[0]


@pytest.mark.parametrize(
    "html, text",
    [
        ('<a class="x">Crash</a>', "Crash"),
        ('<a class="x"><i class="icon"></i>Crash on road</a>', "Crash on road"),
        ('<a class="x"><b>Top</b><img src="a"> Crash <i>!</i></a>', " Crash "),
        ('<a class="x"></a><a class="x">Second</a>', "Second"),
    ],
)
def test_first_text_node(spark, html, text):
    assert value(spark, html, lambda c: first(c, text_in(Tag("a", ("x",))))) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ('<a class="x" href=x><span><i></i></span>Title</a>', "Title"),
        ('<a class="x"><svg><path/></svg>Title</a><a class="x">Later</a>', "Title"),
        ('<a class="x"><span>1<span>2<b>3</b></span></span>T&amp;t<i>!</i>end</a>', "T&t"),
        ('<a class="x"><span><i></i></span></a>between<a class="x"><b><i></i></b>Second</a>', "Second"),
        ('<p>a<a class="x"><b>c</a>d</p><a class="x"></i>Title</a>', "Title"),
        ('<a class="x"><!-- n --><b>c</b>Title</a>', "Title"),
        ('<a class="x"><a class="x"><b></b>in</a>out</a>', "in"),
        ('<a class="x"><b><i>no</i></b></a>outside', None),
        ("none", None),
    ],
)
def test_first_text_node_behind_nested_elements(spark, html, text):
    assert value(spark, html, lambda c: first(c, text_in(Tag("a", ("x",))))) == text


@pytest.mark.parametrize("strict, text", [(True, "in"), (False, "early")])
def test_first_text_node_at_the_end_of_a_path(spark, strict, text):
    html = '<a>none</a><p class="t"><i></i></p><a><b><i></i></b>early</a><p class="t"><a><b><i></i></b></a><a>in</a></p>'
    assert value(spark, html, lambda c: first(c, text_in(Tag("p", ("t",)), Tag("a"), strict=strict))) == text


def test_every_text_node_of_all_elements(spark):
    html = '<span class="t"><b><i>x</i></b>1楼<br>2024</span><span>no</span><span class="t">end</span>'
    assert value(spark, html, lambda c: every(c, text_in(Tag("span", ("t",))))) == ["1楼", "2024", "end"]


@pytest.mark.parametrize(
    "tag, html, want",
    [
        (Tag("div"), "<div>aaa<div>bbb</div>ccc</div><div>d</div>", ["<div>aaa<div>bbb</div>ccc</div>", "<div>d</div>"]),
        (Tag("div", ("k",)), '<div><div class="k">a<div class="k">b</div></div></div>', ['<div class="k">a<div class="k">b</div></div>']),
        (Tag("div"), "<div>open <div>in</div>", ["<div>open <div>in</div>"]),
        (Tag("li"), "<ul><li>a<ul><li>b</li></ul>c</li><li>d</ul>e", ["<li>a<ul><li>b</li></ul>c</li>", "<li>d"]),
        (Tag("li"), "<ul><li>a<li>b</ul><ul><li>c</li></ul>", ["<li>a", "<li>b", "<li>c</li>"]),
        (Tag("li", ("k",)), '<ul><li>a</li><li class="k">b</li><li>c</li></ul>', ['<li class="k">b</li>']),
        (Tag("span"), "none", []),
    ],
)
def test_outermost_elements(spark, tag, html, want):
    assert value(spark, html, lambda c: regions(c, tag)) == want


def test_direct_texts_of_nested_elements(spark):
    html = "<div>aaa<div>bbb</div>ccc<br>d￿d</div>"
    assert value(spark, html, direct_texts) == ["aaa", "ccc", "dd"]


def test_many_text_nodes_take_linear_time(spark):
    html = "<div>" + "a<br>" * 80_000 + "</div>"
    start = time.perf_counter()
    assert len(value(spark, html, direct_texts)) == 80_000
    assert time.perf_counter() - start < 30


@pytest.mark.parametrize("tag, record", [(Tag("div"), "<div>a<div>b</div></div>"), (Tag("li"), "<li>a<li>b</li>")])
def test_many_elements_take_linear_time(spark, tag, record):
    # The first call plans and warms up.
    for count in (100, 40_000):
        start = time.perf_counter()
        found = value(spark, record * count, lambda c: regions(c, tag))
        assert len(found) == (1 if tag.name == "div" else 2) * count
    assert time.perf_counter() - start < 12


def test_many_texts_of_elements_take_linear_time(spark):
    for count in (100, 20_000):
        start = time.perf_counter()
        found = value(spark, '<span class="t"><b>x</b>text</span>' * count, lambda c: every(c, text_in(Tag("span", ("t",)))))
        assert found == ["text"] * count
    assert time.perf_counter() - start < 12


@pytest.mark.parametrize("count", [1, 511, 512, 1023, 1024, 1025, 2500])
def test_elements_across_runs(spark, count):
    html = "<div>" + "<div>x</div>" * count + "</div>" + "<div>y</div>" * count
    assert value(spark, html, lambda c: regions(c, Tag("div"))) == ["<div>" + "<div>x</div>" * count + "</div>"] + ["<div>y</div>"] * count
    page = '<span class="t">' + "a<br>" * count + "</span>"
    assert value(spark, page, lambda c: every(c, text_in(Tag("span", ("t",))))) == ["a"] * count


def test_icon_in_a_title_keeps_the_thread(spark):
    page = TIEBA_LIST.replace("交通事故", '<i class="icon"></i>交通事故')
    got = run_listing(spark, profiles.TIEBA, ["事故"], page)
    assert [r.thread_title for r in got.threads.collect()] == ["交通事故"]


def test_nested_icon_in_a_title_keeps_the_thread(spark):
    page = TIEBA_LIST.replace("交通事故", '<span><i class="icon"></i></span>交通事故')
    got = run_listing(spark, profiles.TIEBA, ["事故"], page)
    assert [r.thread_title for r in got.threads.collect()] == ["交通事故"]


def test_list_inside_an_item_is_no_thread(spark):
    page = (
        '<ul class="post-list"><li><ul><li>tag</li></ul><p class="post-title"><a href="/1">违章</a></p></li></ul>'
    )
    got = run_listing(spark, profiles.AUTOHOME, ["违章"], page)
    assert [r.thread_title for r in got.threads.collect()] == ["违章"] and got.stats.first().crawled == 1


def posts_of(spark, profile, html, work=(("Title", "https://f/", "2024-01-01T00:00:00Z"),)):
    table = spark.createDataFrame(list(work), "thread_title string, thread_link string, thread_date string")
    return content_job(pages_of(spark, profile, html), table, profile)


def test_all_main_blocks_and_nested_replies(spark):
    html = (
        '<section class="fn-container"><div class="post-wrap"><div class="user-name"><a class="name">u1</a></div>'
        '<div class="tz-paragraph">first</div></div><div class="post-wrap"><div class="tz-paragraph">second</div></div>'
        '<ul class="reply-wrap"><li class="js-reply-floor-container"><span class="reply-static-text">'
        "<strong>2024-05-01 10:30</strong></span>"
        '<div class="reply-detail"><div>aaa<div>bbb</div>ccc</div></div></li></ul></section>'
    )
    checked = posts_of(spark, replace(profiles.AUTOHOME, domains=()), html).checked
    assert {r.position: r.text for r in checked.collect()} == {"1": "firstsecond", "2": "aaaccc"}


def test_nested_quote_keeps_the_rest_of_the_post(spark):
    html = (
        '<div class="MessageCard"><a class="MessageCard__date-created"><time class="u-dt" datetime='
        '"2024-05-01T10:00:00-0400"></time></a><a class="MessageCard__post-position">#1</a>'
        '<div class="bbWrapper">before text<div class="bbWrapper">quoted</div>after text</div></div>'
    )
    checked = posts_of(spark, replace(profiles.TESLA, domains=()), html).checked
    assert checked.first().text.split() == ["before", "text", "quoted", "after", "text"]


def test_links_meet_by_their_canonical_form(spark):
    work = [("Title", "https://f/?b=1&a=2#reply", "2024-01-01T00:00:00Z"), ("Other", "https://f/?a=2&b=1", None)]
    profile = replace(profiles.TESLA, domains=())
    pages = pages_of(spark, profile, "<p>x</p>", seed="https://f/?a=2&b=1")
    post = '<div class="MessageCard"><div class="bbWrapper">text</div></div>'
    got = content_job(pages.withColumn("html", F.lit(post)), spark.createDataFrame(work, "thread_title string, thread_link string, thread_date string"), profile)
    assert [r.thread_title for r in got.checked.collect()] in (["Title"], ["Other"])
    pages = pages_of(spark, profiles.TIEBA, TIEBA_LIST, seed="https://F/#top")
    found = listing_job(pages, seeds_of(spark, profiles.TIEBA, ("f1", "https://f/#a"), ("f2", "https://f/")), profiles.TIEBA, ["事故"], AS_OF)
    assert found.threads.count() == 1 and found.stats.count() == 1


def test_tesla_titles_and_links(spark):
    cell = '<div class="structItem-cell structItem-cell--main"><a class="thread-title--gtm" href="{}">{}</a>'
    cell += '<time class="thread-time--gtm" datetime="2024-01-10T10:00:00-0400"></time></div>'
    page = cell.format("threads/crash", "  ") + cell.format("threads/crash2", "Crash two")
    got = run_listing(spark, profiles.TESLA, ["crash"], page)
    assert got.stats.first().yielded == 2
    assert [(r.thread_link, r.thread_title) for r in got.threads.collect()] == [("threads/crash2", "Crash two")]
    assert [r.reject_reason for r in got.rejects.collect()] == ["Missing thread_title"]


def test_work_list_between_jobs(spark, tmp_path):
    rows = spark.createDataFrame([("A", "https://a/", None), ("B", "https://b/", "d")], "thread_title string, thread_link string, thread_date string")
    rows.withColumn("day", F.lit("x")).write.partitionBy("day").parquet(str(tmp_path / "list"))
    back = read_worklist(spark, str(tmp_path / "list"))
    assert sorted((r.thread_title, r.thread_link) for r in back.collect()) == [("A", "https://a/"), ("B", "https://b/")]
    path = write_rows(rows, str(tmp_path / "out"), "tieba", "forum_threads", datetime(2024, 2, 1))
    assert read_worklist(spark, path).count() == 2
    with pytest.raises(ValueError):
        read_worklist(spark, str(tmp_path / "list"), fmt="orc")


def test_streams_use_each_link_once(spark, tmp_path):
    profile = profiles.TIEBA
    pages_of(spark, profile, TIEBA_LIST).write.parquet(str(tmp_path / "pages"))
    seeds = seeds_of(spark, profile, ("f1", "https://f/"), ("f1", "https://f/#again"))
    stream = incremental.thread_stream(incremental.read_page_stream(spark, str(tmp_path / "pages")), seeds, profile, ["事故"], AS_OF)
    incremental.append_to(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert accepted(spark.read.parquet(str(tmp_path / "out"))).count() == 1


def test_each_page_has_its_own_now(spark):
    profile = profiles.AUTOHOME
    page = (
        '<ul class="post-list"><li><p class="post-title"><a href="/1">违章</a></p>'
        '<div class="post-basic-info"><i class="time">2天前</i></div></li></ul>'
    )
    days = spark.createDataFrame([(1, "2024-02-01 00:00:00"), (2, "2024-03-05 00:00:00")], "page_no long, day string")
    pages = pages_of(spark, profile, page, page).drop("fetched_at").join(days, "page_no")
    pages = pages.withColumn("fetched_at", F.col("day").cast("timestamp"))
    got = listing_job(pages, seeds_of(spark, profile), profile, ["违章"]).threads
    assert {r.page_no: r.thread_date for r in got.collect()} == {
        1: "2024-01-30T08:00:00+0800",
        2: "2024-03-03T08:00:00+0800",
    }


def test_page_without_fetch_time_is_a_reject(spark):
    item = '<li><p class="post-title"><a href="/{}">违章</a></p><div class="post-basic-info"><i class="time">{}</i></div></li>'
    page = '<ul class="post-list">' + item.format(1, "2天前") + item.format(2, "2024/01/05 10:00:00") + "</ul>"
    pages = pages_of(spark, profiles.AUTOHOME, page).withColumn("fetched_at", F.lit(None).cast("timestamp"))
    got = listing_job(pages, seeds_of(spark, profiles.AUTOHOME), profiles.AUTOHOME, ["违章"])
    assert [r.reject_reason for r in got.rejects.collect()] == ["Missing fetched_at"] * 2
    assert got.stats.first().crawled == 2 and got.stats.first().yielded == 0
    other = listing_job(pages, seeds_of(spark, profiles.AUTOHOME), profiles.AUTOHOME, ["other"])
    assert [r.thread_link[-1] for r in other.rejects.collect()] == ["1"]


def test_stored_tables_can_be_cleared(spark):
    clear(spark)
    table = stored(spark.range(3), "numbers")
    assert table.count() == 3 and clear(spark) == 1 and clear(spark) == 0
