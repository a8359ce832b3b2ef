"""Scalar projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions.dates import (
    forum_date_text,
    forum_date_ts,
    instant,
    iso_date_ts,
    offset_date_ts,
    utc_text,
)
from threadloom.functions.links import absolute_link
from threadloom.functions.markup import Tag, inner_html
from threadloom.functions.text import clean_block, clean_inline, clean_position, fallback, strip
from threadloom.operators.records import explode_items
from threadloom.registry.base import (
    AS_OF,
    ORIGIN_SQL,
    absolute,
    bare_decoded,
    inline,
    origin,
    page_table,
    query,
    stripped,
    text_table,
    unnested,
)


def text_of(ts):
    """Instants leave as text, which every engine prints alike."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


@query(
    "p1_absolute_links",
    f"""SELECT page_no, item_no, {absolute("x", "base")} AS link FROM ({unnested(
        "list_concat(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), "
        "[url, regexp_replace(url, '^https?:', ''), regexp_replace(url, '^https?://[^/]*/', ''), ''])",
        ORIGIN_SQL + " AS base",
    )})""",
)
def p1_absolute_links(spark, sf_dir):
    hrefs = F.concat(
        F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)),
        F.array(
            "url",
            F.regexp_replace("url", "^https?:", ""),
            F.regexp_replace("url", "^https?://[^/]*/", ""),
            F.lit(""),
        ),
    )
    items = F.transform(hrefs, lambda h, i: F.struct((i + 1).alias("item_no"), h.alias("href")))
    rows = page_table(spark, sf_dir).select("page_no", origin().alias("base"), items.alias("xs"))
    return explode_items(rows, "xs", "x").select(
        "page_no", "x.item_no", absolute_link(F.col("x.href"), F.col("base")).alias("link")
    )


@query(
    "p2_dates_abs",
    """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN raw || ' edited' WHEN event_id % 9 = 1 THEN NULL
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+0800' END AS post_date,
        CASE WHEN event_id % 9 > 1 THEN strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') END AS post_ts
        FROM (SELECT *, strftime(ts, '%Y/%m/%d %H:%M:%S') AS raw FROM events)""",
)
def p2_dates_abs(spark, sf_dir):
    day = F.date_format("ts", "yyyy/MM/dd HH:mm:ss")
    kind = F.col("event_id") % 9
    raw = (
        F.when(kind == 0, F.concat(day, F.lit(" edited")))
        .when(kind == 1, F.lit(""))
        .otherwise(F.concat(F.lit(" "), day, F.lit("\n")))
    )
    return _forum_dates(text_table(spark, sf_dir, "events").select("event_id", raw.alias("raw")))


def _forum_dates(df):
    ts = forum_date_ts(F.col("raw"), instant(AS_OF))
    return df.withColumn("ts", ts).select(
        "event_id",
        forum_date_text(F.col("raw"), F.col("ts")).alias("post_date"),
        text_of("ts").alias("post_ts"),
    )


@query(
    "p2_dates_rel",
    f"""SELECT event_id, CASE WHEN ts IS NULL THEN event_type
            ELSE strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+0800' END AS post_date,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS post_ts
        FROM (SELECT *, CASE event_id % 4
            WHEN 0 THEN TIMESTAMP '{AS_OF}' - to_days(CAST(user_id % 400 AS INTEGER))
            WHEN 1 THEN TIMESTAMP '{AS_OF}' - to_hours(user_id)
            WHEN 2 THEN TIMESTAMP '{AS_OF}' - to_minutes(event_id) END AS ts FROM (SELECT * EXCLUDE (ts) FROM events))""",
)
def p2_dates_rel(spark, sf_dir):
    kind = F.col("event_id") % 4
    raw = (
        F.when(kind == 0, F.concat((F.col("user_id") % 400).cast("string"), F.lit("天前")))
        .when(kind == 1, F.concat(F.col("user_id").cast("string"), F.lit("小时前 更新")))
        .when(kind == 2, F.concat(F.lit("  "), F.col("event_id").cast("string"), F.lit("分钟前")))
        .otherwise(F.col("event_type"))
    )
    return _forum_dates(text_table(spark, sf_dir, "events").select("event_id", raw.alias("raw")))


@query(
    "p2_dates_fetched",
    """SELECT event_id, strftime(CASE WHEN event_id % 2 = 0 THEN ts - to_days(CAST(user_id % 400 AS INTEGER))
            ELSE ts - to_hours(user_id) END, '%Y-%m-%d %H:%M:%S') AS post_ts FROM events""",
)
def p2_dates_fetched(spark, sf_dir):
    """Relative dates, each against the moment of its own row."""
    ago = F.when(
        F.col("event_id") % 2 == 0, F.concat((F.col("user_id") % 400).cast("string"), F.lit("天前"))
    ).otherwise(F.concat(F.col("user_id").cast("string"), F.lit("小时前")))
    events = text_table(spark, sf_dir, "events").select("event_id", ago.alias("raw"), F.col("ts").cast("timestamp").alias("now"))
    found = forum_date_ts(F.col("raw"), instant(F.col("now")))
    return events.select("event_id", F.date_format(found, "yyyy-MM-dd HH:mm:ss").alias("post_ts"))


@query("p3_clean_inline", f"SELECT page_id AS page_no, {inline('html')} AS text FROM pages")
def p3_clean_inline(spark, sf_dir):
    return page_table(spark, sf_dir).select("page_no", clean_inline(F.col("html")).alias("text"))


_BLOCK = "regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
_LINES = bare_decoded(f"regexp_replace({_BLOCK}, '<[/!?a-zA-Z][^>]*>', chr(10), 'g')")


@query(
    "p4_clean_block",
    rf"SELECT page_id AS page_no, regexp_replace({stripped(_LINES)}, '\n\s*\n', chr(10), 'g') AS text FROM pages",
)
def p4_clean_block(spark, sf_dir):
    # The article stands in for the quoted block the cleaner looks for.
    article = inner_html(F.col("html"), Tag("article"))
    block = F.concat(F.lit('<p>x</p><div class="bbWrapper">'), article, F.lit("</div><div>y</div>"))
    return page_table(spark, sf_dir).select("page_no", clean_block(block).alias("text"))


@query(
    "p5_position",
    r"""SELECT conv_id, turn, '#' || turn || '楼' AS position,
        regexp_replace(text, '\s+', '', 'g') AS squeezed FROM conversations""",
)
def p5_position(spark, sf_dir):
    turn = F.concat(F.lit(" #"), F.col("turn").cast("string"), F.lit("\n　楼 "))
    return text_table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        clean_position(turn).alias("position"),
        clean_position(F.col("text")).alias("squeezed"),
    )


_ISO_FORMS = r"""SELECT event_id, CASE event_id % 7
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-0400'
    WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30'
    WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
    WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M')
    WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC'
    WHEN 5 THEN strftime(ts, '%H:%M')
    ELSE event_type END AS raw,
    CASE event_id % 7
    WHEN 0 THEN ts + INTERVAL 4 HOUR
    WHEN 1 THEN ts - INTERVAL 330 MINUTE
    WHEN 2 THEN ts
    WHEN 3 THEN date_trunc('minute', ts) - INTERVAL 8 HOUR
    WHEN 4 THEN ts END AS moment FROM events"""


def iso_forms(spark, sf_dir):
    """Event times written in every form a page may hold, junk included."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_id") % 7
    raw = (
        F.when(kind == 0, F.concat(iso, F.lit("-0400")))
        .when(kind == 1, F.concat(iso, F.lit("+05:30")))
        .when(kind == 2, F.concat(iso, F.lit("Z")))
        .when(kind == 3, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .when(kind == 4, F.date_format("ts", "yyyy-MM-dd HH:mm:ss 'UTC'"))
        .when(kind == 5, F.date_format("ts", "HH:mm"))
        .otherwise(F.col("event_type"))
    )
    return text_table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))


@query(
    "p6_utc",
    f"""SELECT event_id, coalesce(strftime(moment, '%Y-%m-%d %H:%M:%S') || ' UTC', raw) AS utc,
        CASE WHEN event_id % 7 < 3 THEN strftime(moment, '%Y-%m-%d %H:%M:%S') END AS strict_ts
        FROM ({_ISO_FORMS})""",
)
def p6_utc(spark, sf_dir):
    rows = iso_forms(spark, sf_dir).withColumn("ts", iso_date_ts(F.col("raw"), "Asia/Shanghai"))
    return rows.select(
        "event_id",
        utc_text(F.col("raw"), F.col("ts")).alias("utc"),
        text_of(offset_date_ts(F.col("raw"))).alias("strict_ts"),
    )


@query(
    "f6_date_valid",
    f"""SELECT event_id, moment IS NOT NULL AS lenient, event_id % 7 < 3 AS strict FROM ({_ISO_FORMS})""",
)
def f6_date_valid(spark, sf_dir):
    return iso_forms(spark, sf_dir).select(
        "event_id",
        iso_date_ts(F.col("raw"), "Asia/Shanghai").isNotNull().alias("lenient"),
        offset_date_ts(F.col("raw")).isNotNull().alias("strict"),
    )


@query("p7_strip", f"SELECT conv_id, turn, {stripped('text')} AS text FROM conversations")
def p7_strip(spark, sf_dir):
    padded = F.concat(F.lit("　\n\t "), F.col("text"), F.lit("  \r\n"))
    return text_table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", strip(padded).alias("text")
    )


@query(
    "p8_fallback",
    """SELECT page_id AS page_no, CASE WHEN page_id % 3 < 2 THEN url
        ELSE regexp_extract(html, '<h1>([^<]+)', 1) END AS link FROM pages""",
)
def p8_fallback(spark, sf_dir):
    kind = F.col("page_no") % 3
    link = F.when(kind == 0, F.lit("")).when(kind == 2, F.regexp_extract("html", "<h1>([^<]+)", 1))
    return page_table(spark, sf_dir).select("page_no", fallback(link, F.col("url")).alias("link"))
