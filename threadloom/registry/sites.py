"""X7, X8 and A1 with the real site profiles, over the given pages rebuilt in each site's layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.plans.content import content_job
from threadloom.plans.listing import listing_job
from threadloom.profiles import ARTICLES, AUTOHOME, TESLA, TIEBA
from threadloom.registry.base import (
    AS_OF,
    HOST_SQL,
    KEYWORD_SQL,
    KEYWORDS,
    MARKUP_SQL,
    PARAGRAPHS_SQL,
    absolute,
    bare_decoded,
    decoded,
    inline,
    page_table,
    query,
    seed_table,
    stripped,
    unnested,
)

_NAV = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def _list_pages(spark, sf_dir, site, opening, closing, item, nav_of=lambda html: html):
    """The pages with their navigation list turned into a site's thread list."""
    html = F.regexp_replace(nav_of(F.col("html")), _NAV, item)
    html = F.replace(F.replace(html, F.lit("<nav><ul>"), F.lit(opening)), F.lit("</ul></nav>"), F.lit(closing))
    return page_table(spark, sf_dir, site).withColumn("html", html)


def _run(pages, profile, as_of=AS_OF):
    return listing_job(pages, seed_table(pages), profile, KEYWORDS, as_of, reuse=False)


def _items(profile):
    """Listed threads of all pages."""
    hrefs = r'''regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1)'''
    titles = r'''regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)'''
    rows = unnested(hrefs, f"{HOST_SQL} AS host, {titles}[i] AS raw_title")
    return f"""SELECT *, {decoded("raw_title")} AS title, {decoded("x")} AS href FROM ({rows})"""


# --- autohome: dates relative to the fetch of their page, some missing, some unreadable, some pages without fetch time ---


def _autohome_pages(spark, sf_dir):
    n = F.col("page_no")
    time = (
        F.when(n % 5 == 0, F.lit(""))
        .when(n % 7 == 0, F.lit('<i class="time">刚刚</i>'))
        .otherwise(
            F.concat(F.lit('<i class="icon">.</i><i class="time"> '), (n * 8 % 2000).cast("string"), F.lit("天前</i>"))
        )
    )
    item = F.concat(
        F.lit('<li class="x"><p class="post-title"><span>顶</span><a target="_blank" href="$1">$2</a></p>'),
        F.lit('<div class="post-basic-info">'),
        time,
        F.lit("</div></li>"),
    )
    pages = _list_pages(spark, sf_dir, AUTOHOME.site, '<div><ul class="hot post-list">', "</ul></div>", item)
    fetched = F.to_timestamp(F.lit(AS_OF)) + F.make_dt_interval(days=(n % 3).cast("int"))
    return pages.withColumn("fetched_at", F.when(n % 11 != 10, fetched))


_AUTOHOME = f"""SELECT *, {absolute("href", "'" + AUTOHOME.base_url + "'")} AS link,
    CASE WHEN page_no % 5 = 0 OR page_no % 7 = 0 THEN NULL
         ELSE TIMESTAMP '{AS_OF}' + to_days(CAST(page_no % 3 - page_no * 8 % 2000 AS INTEGER)) END AS ts,
    CASE WHEN page_no % 5 = 0 THEN NULL WHEN page_no % 11 = 10 THEN 'Missing fetched_at'
         WHEN page_no % 7 = 0 THEN 'Invalid thread_date' END AS reason,
    regexp_matches(title, '{KEYWORD_SQL}', 'i') AND (page_no % 5 = 0 OR
        (page_no % 7 > 0 AND page_no % 11 < 10 AND page_no * 8 % 2000 <= 1310 + page_no % 3)) AS keep
    FROM ({_items(AUTOHOME)}) WHERE title <> ''"""


@query(
    "x7_autohome",
    f"""SELECT page_no, item_no, title AS thread_title, link AS thread_link,
        strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+0800' AS thread_date, host AS forum_name
        FROM ({_AUTOHOME}) WHERE keep AND link IS NOT NULL""",
)
def x7_autohome(spark, sf_dir):
    threads = _run(_autohome_pages(spark, sf_dir), AUTOHOME, None).threads
    return threads.select("page_no", "item_no", "thread_title", "thread_link", "thread_date", "forum_name")


@query(
    "x7_autohome_rejects",
    f"""SELECT page_no, item_no, title AS thread_title,
        coalesce(reason, 'Missing thread_link') AS reject_reason
        FROM ({_AUTOHOME}) WHERE reason IS NOT NULL OR (keep AND link IS NULL)""",
)
def x7_autohome_rejects(spark, sf_dir):
    rejected = _run(_autohome_pages(spark, sf_dir), AUTOHOME, None).rejects
    return rejected.select("page_no", "item_no", "thread_title", "reject_reason")


@query(
    "a1_autohome_stats",
    f"""SELECT h.host AS forum_name, any_value(pages) AS pages, count(page_no) AS crawled,
        count(*) FILTER (keep) AS yielded
        FROM (SELECT {HOST_SQL} AS host, count(*) AS pages
              FROM pages GROUP BY ALL) h
        LEFT JOIN ({_AUTOHOME}) i ON i.host = h.host GROUP BY h.host""",
)
def a1_autohome_stats(spark, sf_dir):
    return _run(_autohome_pages(spark, sf_dir), AUTOHOME, None).stats.drop("site")


# --- Tieba: no date filter, the date of the last reply is shown ---


def _tieba_pages(spark, sf_dir):
    item = F.lit(
        '<li class=" j_thread_list clearfix" data-field="1"><div><a rel="noreferrer" href="$1" title="t" '
        'class="j_th_tit ">$2</a></div><span class="threadlist_reply_date pull_right">10:30</span></li>'
    )
    opening = '<div><ul id="thread_list" class="threadlist_bright j_threadlist_bright">'
    return _list_pages(spark, sf_dir, TIEBA.site, opening, "</ul></div>", item)


@query(
    "x7_tieba",
    f"""SELECT page_no, item_no, title AS thread_title, {absolute("href", "'" + TIEBA.base_url + "'")} AS thread_link,
        '10:30' AS thread_date, host AS forum_name
        FROM ({_items(TIEBA)}) WHERE regexp_matches(title, '{KEYWORD_SQL}', 'i') AND href <> ''""",
)
def x7_tieba(spark, sf_dir):
    threads = _run(_tieba_pages(spark, sf_dir), TIEBA).threads
    return threads.select("page_no", "item_no", "thread_title", "thread_link", "thread_date", "forum_name")


# --- Tesla: keyword on the link, date attribute, stop at the first empty page, listing rules ---


def _tesla_pages(spark, sf_dir):
    n = F.col("page_no")
    item = F.concat(
        F.lit('<div class="structItem-cell structItem-cell--main"><a data-x="1" class="thread-title--gtm" href="$1"> $2 </a>'),
        F.lit('<time class="u-dt thread-time--gtm" datetime="2023-'),
        F.lpad((n % 12 + 1).cast("string"), 2, "0"),
        F.lit('-15T10:00:00-0400"></time></div>'),
    )
    # Every sixth page came back without its list.
    empty = lambda html: F.when(n % 6 == 5, F.regexp_replace(html, _NAV, "")).otherwise(html)
    return _list_pages(spark, sf_dir, TESLA.site, "<div>", "</div>", item, empty)


_TESLA = f"""SELECT *, CASE WHEN href LIKE '/%' THEN {absolute("href", "'" + TESLA.base_url + "'")} ELSE href END AS link,
    '2023-' || lpad(CAST(page_no % 12 + 1 AS VARCHAR), 2, '0') || '-15 14:00:00 UTC' AS day,
    regexp_matches(href, '{KEYWORD_SQL}', 'i') AND title <> '' AND page_no % 12 + 1 >= 7 AS keep,
    FROM ({_items(TESLA)}) i JOIN (SELECT {HOST_SQL} AS stop_host, min(page_id) FILTER (page_id % 6 = 5) AS stop
        FROM pages GROUP BY ALL) s ON s.stop_host = i.host
    WHERE page_no % 6 < 5 AND (stop IS NULL OR page_no < stop)"""


@query(
    "x7_tesla",
    f"""SELECT page_no, item_no, {inline("title")} AS thread_title, link AS thread_link, day AS thread_date,
        host AS forum_name FROM ({_TESLA}) WHERE keep AND length({inline("title")}) >= 3""",
)
def x7_tesla(spark, sf_dir):
    threads = _run(_tesla_pages(spark, sf_dir), TESLA).threads
    return threads.select("page_no", "item_no", "thread_title", "thread_link", "thread_date", "forum_name")


@query(
    "a1_tesla_stats",
    f"""SELECT h.host AS forum_name, any_value(pages) AS pages, count(page_no) AS crawled,
        count(*) FILTER (keep) AS yielded
        FROM (SELECT {HOST_SQL} AS host, count(*) FILTER (stop IS NULL OR page_id <= stop) AS pages
              FROM pages JOIN (SELECT {HOST_SQL} AS stop_host, min(page_id) FILTER (page_id % 6 = 5) AS stop
                               FROM pages GROUP BY ALL) s ON s.stop_host = {HOST_SQL} GROUP BY ALL) h
        LEFT JOIN ({_TESLA}) i ON i.host = h.host GROUP BY h.host""",
)
def a1_tesla_stats(spark, sf_dir):
    return _run(_tesla_pages(spark, sf_dir), TESLA).stats.drop("site")


# --- thread pages: all paragraphs become the posts of one thread per page ---


def _closed(x):
    """A paragraph with the tags it leaves open closed, so that it ends where the post does."""
    ends = lambda tag: F.repeat(F.lit(f"</{tag}>"), F.regexp_count(x, F.lit(f"<{tag}>")) - F.regexp_count(x, F.lit(f"</{tag}>")))
    return F.concat(x, *(ends(tag) for tag in ("a", "b", "i")))


def _thread_pages(spark, sf_dir, profile, path, posts):
    link = F.concat(F.lit(profile.base_url + path), F.col("page_no").cast("string"))
    texts = F.transform(F.regexp_extract_all("html", F.lit(ARTICLES.posts[0].records.pattern), F.lit(1)), _closed)
    pages = page_table(spark, sf_dir, profile.site).withColumn("seed_url", link)
    head = F.regexp_extract("html", "(?s)^(.*?</nav>)", 1)
    return pages.withColumn("html", F.concat(head, posts(texts), F.lit("<footer>x</footer>")))


def _joined(texts, before, after):
    """``before`` text ``after`` for every post; ``{n}`` in either stands for its number."""

    def post(x, i):
        n = (i + 1).cast("string")
        return F.concat(F.replace(F.lit(before), F.lit("{n}"), n), x, F.replace(F.lit(after), F.lit("{n}"), n))

    return F.array_join(F.transform(texts, post), "\n")


def _worklist(pages, spark, sf_dir):
    """Every sixth thread is missing from the list; each link comes twice, once with a fragment."""
    titles = page_table(spark, sf_dir).select("page_no", F.regexp_extract("html", "<h1>([^<]*)", 1).alias("h1"))
    listed = pages.select("page_no", "seed_url").filter(F.col("page_no") % 6 != 0).join(titles, "page_no")
    links = F.array("seed_url", F.concat("seed_url", F.lit("#reply")))
    return listed.select(
        F.concat(F.lit("On "), "h1").alias("thread_title"),
        F.posexplode(links).alias("ord", "thread_link"),
        F.lit("2024-01-30T08:00:00+0800").alias("thread_date"),
    )


_TEXTS = unnested(PARAGRAPHS_SQL, "html, url")


def _threads_sql(base, path, text, least):
    return f"""SELECT page_no, item_no, {inline("'On ' || regexp_extract(html, '<h1>([^<]*)', 1)")} AS thread_title,
        '{base}{path}' || page_no AS thread_link, {text} AS text
        FROM ({_TEXTS}) WHERE page_no % 6 <> 0 AND length({text}) >= {least}"""


# All text of the post, tags taken out.
_TIEBA_TEXT = inline(decoded("' ' || regexp_replace(x, '<[/!?a-zA-Z][^>]*>', '', 'g') || 'bold '"))


@query(
    "x8_tieba",
    f"""SELECT *, 'u' || item_no AS author_id, '2024-01-15 00:00:00 UTC' AS date, item_no || '楼' AS position
        FROM ({_threads_sql(TIEBA.base_url, "/p/", _TIEBA_TEXT, 3)})""",
)
def x8_tieba(spark, sf_dir):
    def posts(texts):
        body = _joined(
            texts,
            '<div class="l_post l_post_bright"><a class="p_author_name j_user_card" href="#">u{n}</a>'
            '<div class="d_post_content j_d_post_content"> <div>',
            '<!-- <div> --></div><b>bold</b> </div><span class="tail-info">来自Android客户端</span>'
            '<span class="tail-info">{n}楼</span><span class="tail-info">2024-01-15 08:00</span></div>',
        )
        return F.concat(F.lit('<div class="p_postlist" id="j_p_postlist">'), body, F.lit("</div>"))

    pages = _thread_pages(spark, sf_dir, TIEBA, "/p/", posts)
    return content_job(pages, _worklist(pages, spark, sf_dir), TIEBA, reuse=False).posts.drop("site", "date_ts")


# The text of the block itself: what stands in an element of its own is left out.
_DIRECT = "regexp_replace(x, '(?s)<b>.*$', '')"
_AUTOHOME_TEXT = inline(f"{stripped(decoded(_DIRECT))} || 'last&'")


@query(
    "x8_autohome",
    f"""SELECT *, 'u' || item_no AS author_id, CAST(item_no AS VARCHAR) AS position,
        CASE WHEN item_no = 1 THEN '2024-01-30 00:00:00 UTC' ELSE '2024-01-15 00:00:00 UTC' END AS date
        FROM ({_threads_sql(AUTOHOME.base_url, "/bbs/thread/", _AUTOHOME_TEXT, 3)})""",
)
def x8_autohome(spark, sf_dir):
    body = "{}<br/><b>not direct</b> last&amp; </div>"

    def posts(texts):
        main = _joined(
            F.slice(texts, 1, 1),
            '<div class="post-wrap"><div class="user-name"><a class="name" href="#">u{n}</a></div><div class="tz-paragraph"> ',
            body.format("") + "</div>",
        )
        first = F.coalesce(F.try_element_at(texts, F.lit(1)), F.lit(""))
        replies = F.transform(
            F.slice(texts, 2, 1 << 30),
            lambda x, i: F.concat(
                F.lit('<li class="js-reply-floor-container"><div class="user-name"><a class="name">u'),
                (i + 2).cast("string"),
                F.lit('</a></div><span class="reply-static-text"><strong>2024-01-15 08:00</strong></span>'),
                F.lit('<div class="reply-detail"><div> '),
                x,
                F.lit(body.format("") + "</div></li>"),
            ),
        )
        return F.concat(
            F.lit('<section class="fn-container">'),
            F.when(first.isNotNull(), main),
            F.lit('<ul class="reply-wrap">'),
            F.array_join(replies, ""),
            F.lit("</ul></section>"),
        )

    pages = _thread_pages(spark, sf_dir, AUTOHOME, "/bbs/thread/", posts)
    return content_job(pages, _worklist(pages, spark, sf_dir), AUTOHOME, reuse=False).posts.drop("site", "date_ts")


# One line for each text node.
_TESLA_LINES = bare_decoded(f"regexp_replace(x || '<br><div> line two</div>', '{MARKUP_SQL}', chr(10), 'g')")
_TESLA_TEXT = rf"regexp_replace({stripped(_TESLA_LINES)}, '\n\s*\n', chr(10), 'g')"


@query(
    "x8_tesla",
    f"""SELECT page_no, item_no, 'On ' || regexp_extract(html, '<h1>([^<]*)', 1) AS thread_title,
        '{TESLA.base_url}/threads/' || page_no AS thread_link, CAST(item_no * 10 AS VARCHAR) AS author_id,
        '2024-01-15 14:00:00 UTC' AS date, '#' || item_no AS position,
        {_TESLA_TEXT} AS text
        FROM ({_TEXTS}) WHERE page_no % 6 <> 0
        UNION ALL
        SELECT page_no, item_no, NULL, url, CAST(item_no * 10 AS VARCHAR), '2024-01-15 14:00:00 UTC', '#' || item_no,
        {_TESLA_TEXT} FROM ({_TEXTS}) WHERE page_no % 6 = 0""",
)
def x8_tesla(spark, sf_dir):
    def posts(texts):
        return _joined(
            texts,
            '<div class="MessageCard js-post"><a class="MessageCard__user-info__name" data-user-id="{n}0">x</a>'
            '<a class="MessageCard__date-created"><time class="u-dt" datetime="2024-01-15T10:00:00-0400"></time></a>'
            '<a class="MessageCard__post-position"> #{n} </a><div class="bbWrapper">',
            "<br><div> line two</div></div></div>",
        )

    pages = _thread_pages(spark, sf_dir, TESLA, "/threads/", posts)
    return content_job(pages, _worklist(pages, spark, sf_dir), TESLA, reuse=False).posts.drop("site", "date_ts")
