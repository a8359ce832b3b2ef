"""Whole runs over the page table."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions.text import fallback
from threadloom.operators import crawl
from threadloom.operators.lookup import with_forum, with_thread
from threadloom.operators.records import explode_items
from threadloom.operators.validate import POST_RULES, accepted
from threadloom.plans.content import extract_posts, page_posts
from threadloom.plans.listing import listed_threads, page_items
from threadloom.plans.stages import run_stages, validation_stage
from threadloom.profiles import ARTICLES
from threadloom.registry.base import (
    AS_OF,
    HOST_SQL,
    KEYWORD_SQL,
    KEYWORDS,
    ORIGIN_SQL,
    PARAGRAPHS_SQL,
    absolute,
    decoded,
    inline,
    origin,
    page_table,
    query,
    seed_table,
    unnested,
)

_TITLES = r"""regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)"""
_HREFS = r"""regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1)"""


def article_items(spark, sf_dir):
    pages = page_table(spark, sf_dir)
    items = page_items(pages, ARTICLES, KEYWORDS, AS_OF, base=origin())
    return with_forum(items, seed_table(pages))


@query(
    "a1_forum_stats",
    f"""SELECT 'articles' AS site, {HOST_SQL} AS forum_name, count(*) AS pages,
        CAST(sum(len({_TITLES})) AS BIGINT) AS crawled,
        CAST(sum(len(list_filter({_TITLES}, lambda x: regexp_matches(x, '{KEYWORD_SQL}', 'i')))) AS BIGINT) AS yielded
        FROM pages GROUP BY ALL""",
)
def a1_forum_stats(spark, sf_dir):
    return crawl.forum_stats(article_items(spark, sf_dir))


@query(
    "a1_forum_stats_zero_rows",
    f"""SELECT 'articles' AS site, {HOST_SQL} AS forum_name, count(*) FILTER (page_id % 2 = 0) AS pages,
        CAST(coalesce(sum(len({_TITLES})) FILTER (page_id % 2 = 0), 0) AS BIGINT) AS crawled,
        CAST(coalesce(sum(len(list_filter({_TITLES}, lambda x: regexp_matches(x, '{KEYWORD_SQL}', 'i'))))
             FILTER (page_id % 2 = 0), 0) AS BIGINT) AS yielded
        FROM pages GROUP BY ALL""",
)
def a1_forum_stats_zero_rows(spark, sf_dir):
    # Odd pages failed to load here: their forums keep a row, the pages do not count.
    pages = page_table(spark, sf_dir)
    items = page_items(pages, ARTICLES, KEYWORDS, AS_OF, base=origin())
    seeds = seed_table(pages)
    loaded = with_forum(items.filter(F.col("page_no") % 2 == 0), seeds)
    return crawl.with_zero_rows(crawl.forum_stats(loaded), seeds)


@query(
    "w1_page_cap",
    f"""SELECT host AS forum, page_no, n_chars FROM (SELECT {HOST_SQL} AS host, page_id AS page_no,
        length(html) AS n_chars, row_number() OVER (PARTITION BY {HOST_SQL} ORDER BY page_id) AS r FROM pages)
        WHERE r <= 3""",
)
def w1_page_cap(spark, sf_dir):
    # The limit ranks narrow rows; no HTML goes through its exchange.
    pages = page_table(spark, sf_dir).withColumn("n_chars", F.length("html").cast("bigint")).drop("html")
    return crawl.first_pages(pages, 3).select(
        F.regexp_extract("seed_url", "^https://(.*)/$", 1).alias("forum"), "page_no", "n_chars"
    )


_HITS = f"list_filter({PARAGRAPHS_SQL}, lambda x: regexp_matches(x, 'the|qui|die'))"


@query(
    "w2_page_prefix",
    f"""SELECT host AS forum, page_no, n_items FROM (SELECT *, coalesce(sum(CASE WHEN n_items = 0 THEN 1 ELSE 0 END) OVER
        (PARTITION BY host ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM (SELECT {HOST_SQL} AS host, page_id AS page_no, CAST(len({_HITS}) AS INTEGER) AS n_items FROM pages))
        WHERE before = 0""",
)
def w2_page_prefix(spark, sf_dir):
    paragraphs = F.regexp_extract_all("html", F.lit(ARTICLES.posts[0].records.pattern), F.lit(1))
    hits = F.filter(paragraphs, lambda x: x.rlike("the|qui|die"))
    pages = page_table(spark, sf_dir).withColumn("n_items", F.size(hits)).drop("html")
    return crawl.pages_until_empty(pages).select(
        F.regexp_extract("seed_url", "^https://(.*)/$", 1).alias("forum"), "page_no", "n_items"
    )


@query(
    "w3_ordinal",
    f"""SELECT page_no, item_no, CAST(item_no AS VARCHAR) AS position, length(x) AS n_chars
        FROM ({unnested(PARAGRAPHS_SQL)})""",
)
def w3_ordinal(spark, sf_dir):
    rows = _posts(spark, sf_dir)
    return rows.select("page_no", "item_no", "position", F.length("text").cast("bigint").alias("n_chars"))


def _posts(spark, sf_dir):
    posts = page_posts(page_table(spark, sf_dir), ARTICLES)
    numbered = F.transform("posts", lambda p, i: F.struct((i + 1).alias("item_no"), p.alias("p")))
    rows = explode_items(posts.select("page_no", "url", numbered.alias("posts")), "posts", "x")
    return rows.select("page_no", "url", "x.item_no", "x.p.position", "x.p.author_id", "x.p.text")


@query(
    "u1_posts",
    f"""SELECT page_no, 'main' AS kind, 1 AS item_no, xs[1] AS text
            FROM (SELECT page_id AS page_no, {PARAGRAPHS_SQL} AS xs FROM pages) WHERE len(xs) > 0
        UNION ALL SELECT page_no, 'reply' AS kind, item_no, x AS text
            FROM ({unnested(PARAGRAPHS_SQL)}) WHERE item_no > 1""",
)
def u1_posts(spark, sf_dir):
    kind = F.when(F.col("position") == "1", "main").otherwise("reply")
    return _posts(spark, sf_dir).select("page_no", kind.alias("kind"), "item_no", "text")


@query(
    "j1_forum",
    f"""SELECT page_id AS page_no, {HOST_SQL} AS forum_name, 'https://' || {HOST_SQL} || '/' AS forum_url,
        CASE WHEN length({HOST_SQL}) % 2 = 1 THEN 'Pages of https://' || {HOST_SQL} || '/'
             ELSE 'No description provided' END AS forum_description FROM pages""",
)
def j1_forum(spark, sf_dir):
    pages = page_table(spark, sf_dir)
    joined = with_forum(pages.drop("html"), seed_table(pages))
    return joined.select("page_no", "forum_name", "forum_url", "forum_description")


def thread_list(pages):
    """Hosts with an odd-length name are listed threads; their first page gives the title."""
    first_title = F.min_by(F.regexp_extract("html", "<h1>([^<]+)", 1), "page_no")
    threads = pages.groupBy("seed_url").agg(first_title.alias("thread_title"))
    return threads.filter(F.length("seed_url") % 2 == 0).select(
        "thread_title",
        F.col("seed_url").alias("thread_link"),
        F.lit("2024-01-15 08:00").alias("thread_date"),
    )


_WORKLIST = f"""SELECT {HOST_SQL} AS host, 'https://' || {HOST_SQL} || '/' AS thread_link,
    min_by(regexp_extract(html, '<h1>([^<]+)', 1), page_id) AS thread_title
    FROM pages WHERE length({HOST_SQL}) % 2 = 1 GROUP BY ALL"""


@query(
    "j2_thread",
    f"""SELECT page_id AS page_no, thread_title, coalesce(thread_link, url) AS thread_link,
        CASE WHEN thread_link IS NOT NULL THEN '2024-01-15 08:00' END AS thread_date
        FROM pages LEFT JOIN ({_WORKLIST}) w ON w.host = {HOST_SQL}""",
)
def j2_thread(spark, sf_dir):
    pages = page_table(spark, sf_dir)
    joined = with_thread(pages.drop("html"), thread_list(pages))
    return joined.select(
        "page_no",
        "thread_title",
        fallback(F.col("thread_link"), F.col("url")).alias("thread_link"),
        "thread_date",
    )


@query(
    "x7_listing",
    f"""SELECT 'articles' AS site, page_no, item_no, {decoded("title")} AS thread_title,
        {absolute(decoded("x"), "base")} AS thread_link, host AS forum_name, 'https://' || host || '/' AS forum_url,
        CASE WHEN x = '' THEN 'Missing thread_link' END AS reject_reason
        FROM ({unnested(_HREFS, f"{HOST_SQL} AS host, {ORIGIN_SQL} AS base, {_TITLES}[i] AS title")})
        WHERE regexp_matches({decoded("title")}, '{KEYWORD_SQL}', 'i')""",
)
def x7_listing(spark, sf_dir):
    threads = listed_threads(article_items(spark, sf_dir), ARTICLES)
    return threads.drop("thread_date", "thread_ts")


_POSTS = f"""SELECT page_no, item_no, CASE WHEN thread_link IS NOT NULL THEN thread_title END AS thread_title,
    coalesce(thread_link, url) AS thread_link,
    CASE WHEN thread_link IS NOT NULL AND item_no = 1 THEN '2024-01-15 00:00:00 UTC' END AS date,
    CAST(item_no AS VARCHAR) AS position, x AS text
    FROM ({unnested(PARAGRAPHS_SQL, "url, html")}) LEFT JOIN ({_WORKLIST}) w ON w.host = {HOST_SQL}"""


@query(
    "x8_content",
    f"""SELECT page_no, item_no, thread_title, thread_link,
        CASE WHEN date IS NOT NULL THEN '2024-01-15 08:00' END AS date, position, text FROM ({_POSTS})""",
)
def x8_content(spark, sf_dir):
    pages = page_table(spark, sf_dir)
    return extract_posts(pages, thread_list(pages), ARTICLES).drop("site", "author_id")


@query(
    "t1_stages",
    f"""SELECT page_no, item_no, {inline("thread_title")} AS thread_title, thread_link, date,
        {inline("text")} AS text, position || '#' AS position FROM ({_POSTS})
        WHERE thread_title IS NOT NULL AND length({inline("thread_title")}) >= 3 AND date IS NOT NULL
          AND length({inline("text")}) >= 3""",
)
def t1_stages(spark, sf_dir):
    pages = page_table(spark, sf_dir)
    raw = extract_posts(pages, thread_list(pages), ARTICLES).drop("site", "author_id")
    stages = {
        accepted: 900,
        (lambda df: df.drop("date_ts")): 950,
        validation_stage(POST_RULES, "Asia/Shanghai"): 300,
        (lambda df: df.withColumn("position", F.concat("position", F.lit(" #")))): 100,
    }
    return run_stages(raw, stages)
