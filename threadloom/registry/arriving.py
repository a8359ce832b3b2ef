"""R1 with state, X5 with W2, J2 with hot threads: each over the whole page table, beside its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions.text import fallback
from threadloom.operators.lookup import with_thread_salted
from threadloom.operators.page_order import numbered_pages
from threadloom.operators.records import next_page_edges
from threadloom.plans.content import content_job
from threadloom.profiles import ARTICLES
from threadloom.registry.base import HOST_SQL, ORACLES, PARAGRAPHS_SQL, page_table, query
from threadloom.registry.forums import thread_list
from threadloom.session import fresh_folder
from threadloom.streaming.arriving import (
    arriving_posts,
    checked_posts,
    posts_once,
    prefix_so_far,
    prefix_to,
    read_worklist_stream,
)
from threadloom.streaming.incremental import append_to, read_page_stream

_DAY = 1_704_067_200


def _fetched(spark, sf_dir):
    """The pages as fetched within one hour."""
    moment = F.timestamp_seconds(F.lit(_DAY) + F.col("page_no") % 3600)
    return page_table(spark, sf_dir).withColumn("fetched_at", moment)


def _both(stream, batch):
    """How often each post comes from either side; a field that differs makes two rows of one."""
    keys = [c for c in batch.columns if c != "site"]
    both = stream.select(*keys, F.lit(1).alias("s")).unionByName(batch.select(*keys, F.lit(0).alias("s")))
    counted = both.groupBy(*keys).agg(F.sum("s").alias("in_stream"), F.sum(1 - F.col("s")).alias("in_batch"))
    return counted.select("page_no", "item_no", "thread_link", "position", "in_stream", "in_batch")


_POSTS_SQL = f"""SELECT page_no, CAST(i AS INTEGER) AS item_no, CASE WHEN length(host) % 2 = 1 THEN 'https://' || host || '/' ELSE url END
    AS thread_link, CAST(i AS VARCHAR) AS position, CAST(1 AS BIGINT) AS in_stream, CAST(1 AS BIGINT) AS in_batch
    FROM (SELECT page_id AS page_no, url, {HOST_SQL} AS host, {PARAGRAPHS_SQL} AS xs FROM pages), unnest(range(1, len(xs) + 1)) AS t(i)"""


@query("r1_arriving_worklist", _POSTS_SQL)
def r1_arriving_worklist(spark, sf_dir):
    """Posts of pages that come partly before and partly after their threads, beside those of the batch job."""
    folder, lists, out, state = (fresh_folder(spark, n) for n in ("pages", "lists", "posts", "state"))
    pages = _fetched(spark, sf_dir)
    threads = thread_list(pages).withColumn("listed_at", F.timestamp_seconds(F.lit(_DAY)))
    part = F.pmod(F.xxhash64("thread_link"), F.lit(3))
    # Days later one page and its thread move the time on, so that pages without a thread wait no longer.
    later = F.timestamp_seconds(F.lit(_DAY + 40 * 86_400))
    last = spark.range(1).select(
        F.lit(ARTICLES.site).alias("site"), F.lit("https://later/").alias("seed_url"), F.lit(-1).cast("long").alias("page_no"),
        F.lit("https://later/1").alias("url"), F.lit("<p>later</p>").alias("html"), later.alias("fetched_at"),
    )
    last_thread = last.select(F.lit("later").alias("thread_title"), F.col("seed_url").alias("thread_link"), F.lit(None).cast("string").alias("thread_date"), "fetched_at")
    for n in range(4):
        (pages.filter(F.col("page_no") % 3 == n) if n < 3 else last).write.mode("append").parquet(folder)
        listed = threads.filter(part == n) if n < 3 else last_thread.withColumnRenamed("fetched_at", "listed_at")
        listed.write.mode("append").parquet(lists)
        posts = arriving_posts(read_page_stream(spark, folder), read_worklist_stream(spark, lists), ARTICLES)
        append_to(posts, out, state).awaitTermination()
    batch = content_job(pages, threads.drop("listed_at"), ARTICLES).checked
    return _both(spark.read.schema(posts.schema).parquet(out).filter("page_no >= 0"), batch)


@query("r1_pages_once", _POSTS_SQL.replace("ELSE url END", "ELSE 'https://' || host || '/' || page_no END"))
def r1_pages_once(spark, sf_dir):
    """Posts of pages that are all fetched twice, the second time under a link with a fragment, beside the batch job."""
    folder, out, state = (fresh_folder(spark, n) for n in ("pages", "posts", "state"))
    # Links of its own for each page: some of the given ones differ in their fragment alone.
    pages = _fetched(spark, sf_dir).withColumn("url", F.concat("seed_url", F.col("page_no").cast("string")))
    threads = thread_list(pages)
    for mark in ("", "#again"):
        pages.withColumn("url", F.concat("url", F.lit(mark))).write.mode("append").parquet(folder)
        found = posts_once(read_page_stream(spark, folder), ARTICLES)
        append_to(checked_posts(found, threads, ARTICLES), out, state).awaitTermination()
    return _both(spark.read.parquet(out), content_job(pages, threads, ARTICLES).checked)


@query("r1_page_prefix", ORACLES["w2_page_prefix"])
def r1_page_prefix(spark, sf_dir):
    """``w2_page_prefix`` over pages that arrive in four parts, the later ones first."""
    folder, root, state = (fresh_folder(spark, n) for n in ("pages", "prefix", "state"))
    pages = page_table(spark, sf_dir)
    paragraphs = F.regexp_extract_all("html", F.lit(ARTICLES.posts[0].records.pattern), F.lit(1))
    for part in (3, 1, 0, 2):
        pages.filter(F.col("page_no") % 4 == part).write.mode("append").parquet(folder)
        hits = F.size(F.filter(paragraphs, lambda x: x.rlike("the|qui|die"))).alias("n_items")
        arriving = read_page_stream(spark, folder).select("site", "seed_url", "page_no", "url", hits)
        prefix_to(arriving, root, state).awaitTermination()
    forum = F.regexp_extract("seed_url", "^https://(.*)/$", 1)
    return prefix_so_far(spark, root).select(forum.alias("forum"), "page_no", "n_items")


_NEXT = r'<link rel="next" href="([^"]*)">'


@query(
    "x5_page_order",
    """SELECT page_id, row_number() OVER w AS page_no, CAST(min(page_id) OVER w AS BIGINT) AS first_id, false AS on_ring
        FROM (SELECT page_id, page_id - row_number() OVER (ORDER BY page_id) AS run FROM pages)
        WINDOW w AS (PARTITION BY page_id // 100, run ORDER BY page_id)""",
)
def x5_page_order(spark, sf_dir):
    """Numbers of pages saved without one: each page links to the next page id of its hundred."""
    n = F.col("page_no")
    ahead = F.when((n + 1) % 100 > 0, F.format_string('<link rel="next" href="https://saved/%d">', n + 1))
    saved = page_table(spark, sf_dir).select(
        n.alias("page_id"),
        F.format_string("https://saved/%d", n).alias("url"),
        F.concat("html", F.coalesce(ahead, F.lit(""))).alias("html"),
    )
    numbered = numbered_pages(saved.drop("html"), next_page_edges(saved, _NEXT, ""))
    first_id = F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long")
    return numbered.select("page_id", "page_no", first_id.alias("first_id"), "on_ring")


@query("j2_hot_thread", ORACLES["j2_thread"])
def j2_hot_thread(spark, sf_dir):
    """``j2_thread`` with large threads split by their counted pages."""
    pages = page_table(spark, sf_dir)
    joined = with_thread_salted(pages.drop("html"), thread_list(pages))
    link = fallback(F.col("thread_link"), F.col("url"))
    return joined.select("page_no", "thread_title", link.alias("thread_link"), "thread_date")
