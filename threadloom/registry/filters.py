"""Predicates, validation and work-list filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions.dates import instant, offset_date_ts
from threadloom.functions.text import clean_position
from threadloom.operators.filters import (
    allowed_host,
    first_per_link,
    in_date_range,
    keyword_pattern,
    link_status,
    matches_keyword,
    usable_worklist,
)
from threadloom.operators.validate import (
    POST_RULES,
    Check,
    accepted,
    clean_validate,
    is_long_enough,
    rejects,
)
from threadloom.registry.base import (
    AS_OF,
    HOST_SQL,
    KEYWORD_SQL,
    KEYWORDS,
    inline,
    page_table,
    query,
    stripped,
    table,
    text_table,
)


@query(
    "f1_keyword",
    f"SELECT doc_id, lang, source FROM documents WHERE regexp_matches(text, '{KEYWORD_SQL}', 'i')",
)
def f1_keyword(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.filter(matches_keyword(F.col("text"), KEYWORDS)).select("doc_id", "lang", "source")


@query(
    "f2_date_range",
    f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
        WHERE o_orderdate BETWEEN TIMESTAMP '1995-03-05' AND TIMESTAMP '{AS_OF}'""",
)
def f2_date_range(spark, sf_dir):
    # The column has no zone, so the bounds are brought to its type: a cast of the column
    # instead would keep the range away from the Parquet reader.
    start, end = (instant(x).cast("timestamp_ntz") for x in ("1995-03-05", AS_OF))
    orders = table(spark, sf_dir, "orders").filter(in_date_range(F.col("o_orderdate"), start, end))
    return orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query(
    "f3_link_filter",
    f"""SELECT event_id, CASE
        WHEN title = '' THEN 'skip'
        WHEN event_id % 11 = 0 AND event_id % 7 <> 0 THEN 'Invalid thread_date'
        WHEN regexp_matches(title, '(?:click|SIGN|err.r)', 'i') AND (event_id % 7 = 0 OR
            ts - INTERVAL 8 HOUR BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20 12:00:00') THEN 'keep'
        ELSE 'skip' END AS status
        FROM (SELECT event_id, date_trunc('second', ts) AS ts,
              CASE WHEN event_id % 13 = 0 THEN '' ELSE upper(event_type) END AS title FROM events)""",
)
def f3_link_filter(spark, sf_dir):
    n = F.col("event_id")
    title = F.when(n % 13 == 0, F.lit("")).otherwise(F.upper("event_type"))
    text = (
        F.when(n % 7 == 0, F.lit(None).cast("string"))
        .when(n % 11 == 0, "some day")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+0800'"))
    )
    rows = table(spark, sf_dir, "events").select("event_id", title.alias("title"), text.alias("text"))
    rows = rows.withColumn("at", offset_date_ts(F.col("text")))
    status = link_status(
        F.col("title"),
        F.col("title"),
        F.col("text"),
        F.col("at"),
        keyword_pattern(["click", "SIGN", "err.r"]),
        "2024-01-10",
        instant("2024-01-20 12:00:00"),
    )
    return rows.select("event_id", status.alias("status"))


@query(
    "f4_required",
    """SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'Missing thread_title'
        WHEN doc_id % 5 = 1 THEN 'Missing thread_link'
        WHEN coalesce(text, '') = '' THEN 'Missing text' END AS reject_reason FROM documents""",
)
def f4_required(spark, sf_dir):
    n = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(n % 10 == 5, F.lit("")).when(n % 5 != 0, F.col("lang")).alias("thread_title"),
        F.when(n % 5 == 1, F.lit("")).otherwise(F.col("source")).alias("thread_link"),
        "text",
    )
    rules = [Check(f, "plain") for f in ("thread_title", "thread_link", "text")]
    return clean_validate(docs, rules).select("doc_id", "reject_reason")


@query(
    "f5_length_valid",
    f"""SELECT conv_id, turn, length(role) >= 10 AS role_long,
        length(text) >= 10 AND {stripped("text")} <> '' AS text_long,
        length(text) >= 3 AND {stripped("text")} <> '' AS text_valid FROM conversations""",
)
def f5_length_valid(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        is_long_enough(F.col("role"), 10).alias("role_long"),
        is_long_enough(text, 10).alias("text_long"),
        is_long_enough(text, 3).alias("text_valid"),
    )


@query(
    "f7_position_valid",
    "SELECT conv_id, turn, turn % 3 <> 0 AS valid FROM conversations",
)
def f7_position_valid(spark, sf_dir):
    raw = F.when(F.col("turn") % 3 == 0, F.lit(" \n　")).otherwise(F.col("role"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", (clean_position(raw) != "").alias("valid")
    )


# Documents stand in for posts; the event of the same number lends the date.
_POSTS_SQL = f"""SELECT doc_id, event_id, title, link,
    CASE WHEN doc_id % 7 = 0 THEN 'some day' ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS raw_date,
    CASE WHEN doc_id % 13 = 0 THEN '<p> </p>' ELSE '<p>' || text || '</p>' END AS raw_text,
    CASE WHEN doc_id % 17 = 0 THEN ' ' ELSE ' ' || doc_id || ' 楼' END AS raw_position,
    CASE WHEN title IS NULL THEN 'Missing thread_title' WHEN length(title) < 3 THEN 'Invalid thread_title'
         WHEN link = '' THEN 'Missing thread_link'
         WHEN event_id IS NULL THEN 'Missing date' WHEN doc_id % 7 = 0 THEN 'Invalid date'
         WHEN doc_id % 13 = 0 OR length({inline("text")}) < 3 THEN 'Invalid text'
         WHEN doc_id % 17 = 0 THEN 'Invalid position' END AS reject_reason, ts, text
    FROM (SELECT *, CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 23 = 0 THEN 'ab' ELSE 'on ' || source END AS title,
          CASE WHEN doc_id % 29 = 0 THEN '' ELSE 'https://f/' || doc_id END AS link
          FROM documents LEFT JOIN events ON event_id = doc_id)"""


def post_rows(spark, sf_dir):
    n = F.col("doc_id")
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), "ts")
    return (
        text_table(spark, sf_dir, "documents")
        .join(events, "doc_id", "left")
        .select(
            "doc_id",
            F.when(n % 19 == 0, F.lit(None).cast("string"))
            .when(n % 23 == 0, "ab")
            .otherwise(F.concat(F.lit("on "), "source"))
            .alias("thread_title"),
            F.when(n % 29 == 0, "").otherwise(F.concat(F.lit("https://f/"), n.cast("string"))).alias("thread_link"),
            F.when(F.col("ts").isNotNull() & (n % 7 == 0), "some day")
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
            .alias("date"),
            F.when(n % 13 == 0, "<p> </p>")
            .otherwise(F.concat(F.lit("<p>"), "text", F.lit("</p>")))
            .alias("text"),
            F.when(n % 17 == 0, " ").otherwise(F.format_string(" %d 楼", n)).alias("position"),
        )
    )


@query(
    "f8_accepted",
    f"""SELECT doc_id, title AS thread_title, link AS thread_link,
        strftime(date_trunc('minute', ts) - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') || ' UTC' AS date,
        {inline("raw_text")} AS text, doc_id || '楼' AS position
        FROM ({_POSTS_SQL}) WHERE reject_reason IS NULL""",
)
def f8_accepted(spark, sf_dir):
    checked = clean_validate(post_rows(spark, sf_dir), POST_RULES, "Asia/Shanghai")
    return accepted(checked).drop("date_ts")


@query(
    "f8_rejects",
    f"""SELECT doc_id, title AS thread_title, link AS thread_link,
        CASE WHEN event_id IS NOT NULL THEN raw_date END AS date, raw_text AS text, raw_position AS position,
        reject_reason FROM ({_POSTS_SQL}) WHERE reject_reason IS NOT NULL""",
)
def f8_rejects(spark, sf_dir):
    checked = clean_validate(post_rows(spark, sf_dir), POST_RULES, "Asia/Shanghai")
    return rejects(checked).drop("date_ts")


@query(
    "f9_worklist",
    """SELECT title AS thread_title, url AS thread_link, NULL::VARCHAR AS thread_date FROM
        (SELECT url, page_id, regexp_extract(html, '<h1>([^<]+)', 1) AS title FROM pages)
        WHERE page_id % 4 > 1 AND page_id % 5 > 0 AND title <> ''""",
)
def f9_worklist(spark, sf_dir):
    n, title = F.col("page_no"), F.regexp_extract("html", "<h1>([^<]+)", 1)
    rows = page_table(spark, sf_dir).select(
        F.when(n % 4 == 0, "").when(n % 4 > 1, title).alias("thread_title"),
        F.when(n % 5 > 0, F.col("url")).otherwise(F.lit("")).alias("thread_link"),
        F.lit(None).cast("string").alias("thread_date"),
    )
    return usable_worklist(rows)


@query(
    "f10_domains",
    f"""SELECT page_id AS page_no, url FROM (SELECT *, {HOST_SQL} AS host FROM pages)
        WHERE host IN ('example.com', 'blog.tionsh.example.net')
           OR host LIKE '%.example.com' OR host LIKE '%.blog.tionsh.example.net'""",
)
def f10_domains(spark, sf_dir):
    pages = page_table(spark, sf_dir).select("page_no", "url")
    return pages.filter(allowed_host(F.col("url"), ["example.com", "blog.tionsh.example.net"]))


@query(
    "f11_dedupe",
    r"""WITH links AS (
            SELECT page_no, CAST(i AS INTEGER) AS link_no, xs[i] AS thread_link FROM (
                SELECT page_id AS page_no, regexp_replace(url, '#.*$', '') AS u,
                    CASE WHEN strpos(url, '?') > 0 THEN '&' ELSE '?' END AS sep,
                    regexp_extract(url, '^(https?://[^/]*)', 1) AS base,
                    [u || '#reply', u, u || sep || 'b=2&a=1', u || sep || 'a=1&b=2#x', u || sep || 'a=1&&b=2', base, upper(base) || '/'] AS xs
                FROM pages), unnest(range(1, 8)) AS t(i)),
        keyed AS (
            SELECT *, regexp_replace(thread_link, '#.*$', '') AS plain,
                lower(regexp_extract(plain, '^([A-Za-z]+://[^/?]*)', 1)) AS head,
                regexp_extract(plain, '^[A-Za-z]+://[^/?]*([^?]*)', 1) AS path,
                list_sort(list_filter(string_split(regexp_extract(plain, '\?(.*)$', 1), '&'), lambda a: a <> '')) AS args
            FROM links),
        ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY head, CASE WHEN path = '' THEN '/' ELSE path END, array_to_string(args, '&')
                ORDER BY page_no, link_no) AS r FROM keyed)
        SELECT page_no, link_no, thread_link FROM ranked WHERE r = 1""",
)
def f11_dedupe(spark, sf_dir):
    plain, base = F.col("plain"), F.regexp_extract("plain", "^(https?://[^/]*)", 1)
    sep = F.when(F.col("plain").contains("?"), "&").otherwise("?")
    links = F.array(
        F.concat(plain, F.lit("#reply")),
        plain,
        F.concat(plain, sep, F.lit("b=2&a=1")),
        F.concat(plain, sep, F.lit("a=1&b=2#x")),
        F.concat(plain, sep, F.lit("a=1&&b=2")),
        base,
        F.concat(F.upper(base), F.lit("/")),
    )
    rows = (
        page_table(spark, sf_dir)
        .select("page_no", F.regexp_replace("url", "#.*$", "").alias("plain"))
        .select("page_no", F.posexplode(links).alias("link_no", "thread_link"))
        .withColumn("link_no", F.col("link_no") + 1)
    )
    return first_per_link(rows, "thread_link", ["page_no", "link_no"])
