"""Column functions on literal rows."""

import html
import random

import pytest
from pyspark.sql import functions as F

from threadloom.functions import dates, links, markup, text
from threadloom.functions.binding import let
from threadloom.functions.entities import decode_entities
from threadloom.operators.records import tail_date, tail_position

AS_OF = "2024-02-01 00:00:00"


def apply(spark, values, *columns, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    got = rows.select("i", *(c.alias(f"x{n}") for n, c in enumerate(columns))).orderBy("i").collect()
    return [r[1] if len(columns) == 1 else tuple(r)[1:] for r in got]


C = None


@pytest.fixture(autouse=True, scope="module")
def column(spark):
    global C
    C = F.col("c")


def test_let_binds_once_and_keeps_null(spark):
    assert apply(spark, ["a", None], let(C, lambda x: F.concat(x, x))) == ["aa", None]


def test_forum_dates(spark):
    raw = ["2025/03/16 12:36:26", "2天前", "3小时前", "15分钟前", "invalid date", " 4天前 ", "", None,
           "2025/03/16 12:36:26 edited", "2025/13/16 12:36:26", "99999999999天前", "700001天前", "1天前 更新"]
    ts = dates.forum_date_ts(C, dates.instant(AS_OF))
    assert apply(spark, raw, dates.forum_date_text(C, ts)) == [
        "2025-03-16T12:36:26+0800", "2024-01-30T08:00:00+0800", "2024-02-01T05:00:00+0800",
        "2024-02-01T07:45:00+0800", "invalid date", "2024-01-28T08:00:00+0800", None, None,
        "2025/03/16 12:36:26 edited", "2025/13/16 12:36:26", "99999999999天前", "700001天前",
        "2024-01-31T08:00:00+0800",
    ]


@pytest.mark.parametrize(
    "raw, zone, expected",
    [
        ("2024-05-01T10:00:00-0400", "UTC", "2024-05-01 14:00:00 UTC"),
        ("2024-05-01T10:00:00Z", "Asia/Shanghai", "2024-05-01 10:00:00 UTC"),
        ("2024-05-01 10:30", "Asia/Shanghai", "2024-05-01 02:30:00 UTC"),
        ("2024-05-01 14:00:00 UTC", "Asia/Shanghai", "2024-05-01 14:00:00 UTC"),
        ("2024-05-01", "UTC", "2024-05-01 00:00:00 UTC"),
        ("10:30", "UTC", None),
        ("2024", "UTC", None),
        ("2024-02-30", "UTC", None),
        ("junk", "UTC", None),
    ],
)
def test_iso_dates(spark, raw, zone, expected):
    ts = dates.iso_date_ts(C, zone)
    assert apply(spark, [raw], ts.isNotNull(), dates.utc_text(C, ts)) == [(expected is not None, expected or raw)]


def test_strict_dates_need_an_offset(spark):
    raw = ["2024-05-01T10:00:00-0400", "2024-05-01T10:00:00", "2024-05-01 10:00:00-0400", None]
    assert apply(spark, raw, dates.offset_date_ts(C).isNotNull()) == [True, False, False, False]


def test_clean_inline(spark):
    raw = ["  Crash <b>on</b>\n I-95 ", "a<br>b&amp;c", 'x<script>var t="</p>";</script>y',
           "1 < 2 and 3 > 2", "违章　处理 ", "a<!-- <p> -->b", "<STYLE>p{}</STYLE>t", "", None, "a&nbsp;&lt;b&gt;"]
    assert apply(spark, raw, text.clean_inline(C)) == [
        "Crash on I-95", "a b&c", "x y", "1 < 2 and 3 > 2", "违章 处理", "a b", "t", "", None, "a <b>"]


def test_clean_block(spark):
    raw = ['<p>no</p><div class="bbWrapper">line one<br>line two</div><div>no</div>',
           '<div class="x bbWrapper"><div>quote</div>\n  <br/> reply &amp; more</div>', "<div>other</div>", None]
    assert apply(spark, raw, text.clean_block(C)) == ["line one\nline two", "quote\n reply & more", None, None]


def test_strip_and_position(spark):
    assert apply(spark, ["　 a b \n", " ", None], text.strip(C)) == ["a b", "", None]
    assert apply(spark, [" 3 楼\n"], text.clean_position(C)) == ["3楼"]
    assert apply(spark, [12], text.clean_position(C), kind="int") == ["12"]
    assert apply(spark, ["", None, "x"], text.fallback(C, F.lit("url"))) == ["url", "url", "x"]


def test_absolute_links(spark):
    raw = ["/p/123", "//club.autohome.com.cn/1", "https://a/b", "HTTP/x", "p", "", None]
    assert apply(spark, raw, links.absolute_link(C, "https://t.com/")) == [
        "https://t.com/p/123", "https://club.autohome.com.cn/1", "https://a/b", "https://t.com/HTTP/x",
        "https://t.com/p", None, None]


def test_canonical_urls(spark):
    groups = [
        ["http://ex.com/", "HTTP://EX.com", "http://ex.com/#f", "http://ex.com/?", "http://ex.com?&&"],
        ["http://ex.com/a?x=1&y=2", "http://ex.com/a?y=2&x=1#z", "http://ex.com/a?y=2&&x=1"],
        ["http://ex.com/a?b", "http://ex.com/a?b="],
        ["http://ex.com/%e4%bA", "http://ex.com/%E4%BA"],
        ["http://ex.com/A"],
        ["http://ex.com/a"],
        ["no-url"],
    ]
    got = [set(apply(spark, g, links.canonical_url(C))) for g in groups]
    assert all(len(g) == 1 for g in got) and len(set.union(*got)) == len(groups)


def test_host(spark):
    raw = ["https://A.b.c:80/x", "http://u@h_1.d/?q=http://z", "/rel", None]
    assert apply(spark, raw, links.host(C)) == ["a.b.c", "h_1.d", None, None]


def test_tail_info(spark):
    rows = [["来自Android", "3楼", "2024-05-01 10:30"], ["1楼", "2楼"], [], ["2024-05-01 10:30", "2024-06-01 10:30x"]]
    got = apply(spark, rows, tail_position(C), tail_date(C), kind="array<string>")
    assert got == [("3楼", "2024-05-01 10:30"), ("2楼", None), (None, None), (None, "2024-06-01 10:30x")]


def test_entities_agree_with_the_standard_library(spark):
    rng = random.Random(7)
    refs = ["&amp;", "&lt;", "&nbsp;", "&hellip;", "&#39;", "&#x27;", "&#128512;", "&#150;", "&hyphen;", "&", "&;",
            "&unknown;", "& amp;", "&#;", "&#x;", "&#0;", "&#xD800;", "&#1114112;", "&amp;lt;", "a", " ", ";", "#"]
    values = ["".join(rng.choice(refs) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    got = apply(spark, values, decode_entities(C, html5=True))
    assert got == [html.unescape(v) for v in values]


def test_entities_of_selectors_need_a_semicolon(spark):
    raw = ["/f?a=1&copy=2&amp;lt=3", "&apos;&copy", "&bare no", None]
    assert apply(spark, raw, decode_entities(C)) == ["/f?a=1&copy=2&lt=3", "'&copy", "&bare no", None]
    assert apply(spark, ["&copy 2024"], decode_entities(C, html5=True, bare=True)) == ["© 2024"]


def test_tag_matches_class_tokens_only(spark):
    tag = markup.Tag("li", ("j_thread_list",))
    raw = ['<li class="a j_thread_list b">1</li>', "<LI id=x class='j_thread_list'>2</li>",
           '<li class="j_thread_list2">3</li>', '<link class="j_thread_list">4', "<li>5</li>"]
    assert apply(spark, raw, F.size(markup.regions(C, tag))) == [1, 1, 0, 0, 0]


def test_regions_end_at_their_own_end_tag(spark):
    tag = markup.Tag("div", ("q",))
    raw = ['a<div class="q">1<div>2</div>3</div>4<div class="q">5</div>6', '<div class="q">never <b>closed', "", None]
    assert apply(spark, raw, markup.regions(C, tag)) == [
        ['<div class="q">1<div>2</div>3</div>', '<div class="q">5</div>'], ['<div class="q">never <b>closed'], [], None]


def test_inner_html(spark):
    raw = ['a<div class="q">1<DIV>2</DIV>3</Div >4', '<div class="q"></div>', '<div class="q">open <b>x</b>', "none", None]
    assert apply(spark, raw, markup.inner_html(C, markup.Tag("div", ("q",)))) == [
        "1<DIV>2</DIV>3", "", "open <b>x</b>", None, None]


def test_fields(spark):
    a = markup.Tag("a", ("t",))
    raw = ['<p class="h"><a>x</a></p><a class="t" href="/1?a=1&amp;b">T &amp; U<b>v</b></a>', "<p>none</p>", None]
    got = apply(spark, raw, markup.firsts(C, markup.text_in(a), markup.attr_in("href", a), None))
    assert got == [["T & U", "/1?a=1&b", None], [None] * 3, [None] * 3]
    strict = markup.text_in(markup.Tag("p", ("h",)), markup.Tag("a"), strict=True)
    assert apply(spark, ['<p class="h"></p><a>no</a>', raw[0]], markup.first(C, strict)) == [None, "x"]


def test_direct_texts(spark):
    raw = ['<div class="x">one<br>two<b>in <i>deep</i></b>three<img src="a">fourfive</div>', "<div></div>"]
    assert apply(spark, raw, markup.direct_texts(C)) == [
        ["one", "two", "three", "fourfive"], []]
