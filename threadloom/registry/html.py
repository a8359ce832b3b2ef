"""Records and fields of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions.markup import Tag, all_texts, attr_in, firsts, outer_html, text_in
from threadloom.functions.text import element_text, joined_text
from threadloom.operators.records import (
    Records,
    extract_records,
    next_page_edges,
    tail_date,
    tail_position,
)
from threadloom.profiles import ARTICLES
from threadloom.registry.base import (
    NAV_SQL,
    PARAGRAPHS_SQL,
    ORIGIN_SQL,
    absolute,
    decoded,
    origin,
    page_table,
    query,
    stripped,
    table,
    unnested,
)

RECORDS_SQL = f"SELECT page_no, item_no, x AS record FROM ({unnested(NAV_SQL)})"


@query("x1_records", RECORDS_SQL)
def x1_records(spark, sf_dir):
    pages = page_table(spark, sf_dir).select("page_no", "html")
    return extract_records(pages, ARTICLES.listing.records)


@query(
    "x1_nested_records",
    f"""SELECT page_no, item_no, x AS record FROM ({unnested(
        "regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '(?s)(<li>.*?</li>)', 1)"
    )})""",
)
def x1_nested_records(spark, sf_dir):
    pages = page_table(spark, sf_dir).select("page_no", "html")
    return extract_records(pages, Records(path=(Tag("nav"), Tag("ul"), Tag("li"))))


@query(
    "x2_first_field",
    f"""SELECT page_id AS page_no,
        nullif({decoded("regexp_extract(html, '<h1>([^<]+)', 1)")}, '') AS title,
        nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang,
        nullif(regexp_extract(html, '<time datetime="([^"]*)"', 1), '') AS date
        FROM pages""",
)
def x2_first_field(spark, sf_dir):
    found = firsts(
        F.col("html"),
        text_in(Tag("h1")),
        attr_in("lang", Tag("html")),
        attr_in("datetime", Tag("time")),
    )
    pages = page_table(spark, sf_dir).select("page_no", F.explode_outer(F.array(found)).alias("f"))
    return pages.select("page_no", *(F.col("f")[i].alias(n) for i, n in enumerate(("title", "lang", "date"))))


@query(
    "x1_child_records",
    f"""SELECT page_no, item_no, '<li><ul><li>tag</li></ul>' || substr(x, 5) AS record FROM ({unnested(
        "regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '(?s)(<li>.*?</li>)', 1)"
    )})""",
)
def x1_child_records(spark, sf_dir):
    """Items that begin with a list of their own are one record each."""
    pages = page_table(spark, sf_dir).select(
        "page_no", F.replace("html", F.lit("<li>"), F.lit("<li><ul><li>tag</li></ul>")).alias("html")
    )
    return extract_records(pages, Records(path=(Tag("nav"), Tag("ul"), Tag("li"))))


@query(
    "x2_first_text_node",
    f"""SELECT page_id AS page_no, nullif({decoded("regexp_extract(html, '<h1>([^<]+)', 1)")}, '') AS title FROM pages""",
)
def x2_first_text_node(spark, sf_dir):
    """A title behind an icon and a label."""
    html = F.replace("html", F.lit("<h1>"), F.lit('<h1 class="t"><i class="icon"></i><b>new</b><img src="x">'))
    title = firsts(html, text_in(Tag("h1", ("t",))))
    return page_table(spark, sf_dir).select("page_no", title[0].alias("title"))


@query(
    "x4_nested",
    f"""SELECT page_id AS page_no, {decoded(
        "regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[/!?a-zA-Z][^>]*>', '', 'g')"
    )} || 'quoted' || 'tail' AS text FROM pages""",
)
def x4_nested(spark, sf_dir):
    """The text of a block that holds a block of the same kind."""
    article = F.regexp_extract("html", "(?s)<article>(.*?)</article>", 1)
    block = F.concat(
        F.lit('<div>x</div><div class="bbWrapper">'),
        article,
        F.lit('<div class="bbWrapper">quoted</div>tail</div><div>y</div>'),
    )
    text = element_text(outer_html(block, Tag("div", ("bbWrapper",))))
    return page_table(spark, sf_dir).select("page_no", text.alias("text"))


@query(
    "x3_joined_paragraphs",
    f"""SELECT page_id AS page_no, array_to_string(list_filter(list_transform(flatten(list_transform(
        {PARAGRAPHS_SQL}, lambda p: string_split_regex(p, '<[/!?a-zA-Z][^>]*>'))),
        lambda x: {stripped(decoded("x"))}), lambda x: x <> ''), '') AS text FROM pages""",
)
def x3_joined_paragraphs(spark, sf_dir):
    paragraphs = ARTICLES.posts[0].records.pattern
    found = F.regexp_extract_all("html", F.lit(paragraphs), F.lit(1))
    texts = joined_text(F.flatten(F.transform(found, all_texts)))
    return page_table(spark, sf_dir).select("page_no", texts.alias("text"))


@query(
    "x4_element_text",
    f"""SELECT page_id AS page_no, {decoded(
        "regexp_replace(regexp_extract(html, '(?s)(<article>.*?</article>)', 1), '<[/!?a-zA-Z][^>]*>', '', 'g')"
    )} AS text FROM pages""",
)
def x4_element_text(spark, sf_dir):
    text = element_text(outer_html(F.col("html"), Tag("article")))
    return page_table(spark, sf_dir).select("page_no", text.alias("text"))


@query(
    "x5_next_edges",
    f"""SELECT page_url, next_url FROM (SELECT url AS page_url, href, {absolute("href", "base")} AS next_url
        FROM (SELECT url, {ORIGIN_SQL} AS base,
              {decoded("regexp_extract(html, '<li><a href=\"([^\"]*)\">', 1)")} AS href FROM pages))
        WHERE href <> ''""",
)
def x5_next_edges(spark, sf_dir):
    return next_page_edges(page_table(spark, sf_dir), ARTICLES.next_page, origin())


@query(
    "x6_tail_info",
    r"""SELECT event_id,
        list_filter(xs, lambda x: x LIKE '%楼')[-1] AS position,
        list_filter(xs, lambda x: x NOT LIKE '%楼' AND regexp_matches(x, '^\d{4}-\d{2}-\d{2} \d{2}:\d{2}'))[-1] AS date
        FROM (SELECT event_id, CASE event_id % 4
            WHEN 0 THEN [event_type, event_id || '楼', strftime(ts, '%Y-%m-%d %H:%M')]
            WHEN 1 THEN [event_id || '楼', user_id || '楼', event_type]
            WHEN 2 THEN [strftime(ts, '%Y-%m-%d %H:%M:%S'), strftime(ts, '%Y-%m-%d %H:%M'), strftime(ts, '%Y-%m-%d %H:%M') || '楼']
            ELSE [] END AS xs FROM events)""",
)
def x6_tail_info(spark, sf_dir):
    floor = F.concat(F.col("event_id").cast("string"), F.lit("楼"))
    minute = F.date_format("ts", "yyyy-MM-dd HH:mm")
    kind = F.col("event_id") % 4
    texts = (
        F.when(kind == 0, F.array("event_type", floor, minute))
        .when(kind == 1, F.array(floor, F.concat(F.col("user_id").cast("string"), F.lit("楼")), "event_type"))
        .when(kind == 2, F.array(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), minute, F.concat(minute, F.lit("楼"))))
        .otherwise(F.array().cast("array<string>"))
    )
    rows = table(spark, sf_dir, "events").select("event_id", texts.alias("xs"))
    return rows.select(
        "event_id", tail_position(F.col("xs")).alias("position"), tail_date(F.col("xs")).alias("date")
    )
