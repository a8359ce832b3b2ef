"""Files written from the tables, read back by the job sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from threadloom.operators.filters import usable_worklist
from threadloom.plans.content import content_job
from threadloom.plans.listing import listed_threads
from threadloom.profiles import ARTICLES
from threadloom.registry.base import (
    AS_OF,
    HOST_SQL,
    KEYWORDS,
    ORACLES,
    PARAGRAPHS_SQL,
    page_table,
    query,
    seed_table,
    table,
)
from threadloom.registry.forums import article_items, thread_list
from threadloom.session import fresh_folder
from threadloom.sources.readers import (
    latest_committed,
    latest_output,
    read_keywords,
    read_pages,
    read_seeds,
    read_worklist,
)
from threadloom.sources.writers import output_name, write_rows
from threadloom.streaming.incremental import (
    append_to,
    item_stream,
    latest,
    listing_so_far,
    listing_to,
    post_stream,
    read_page_stream,
    stats_stream,
    thread_stream,
    update_to,
)

STARTED = datetime(2024, 2, 1, 12, 30, 5)


@query(
    "s1_keywords",
    """SELECT 'docs' AS site, keyword FROM (SELECT lang || ' ' || source AS keyword FROM documents
        UNION ALL SELECT '# ' || doc_id FROM documents WHERE doc_id % 10 = 0)""",
)
def s1_keywords(spark, sf_dir):
    n = F.col("doc_id")
    lines = table(spark, sf_dir, "documents").select(
        F.explode(
            F.array(
                F.concat(F.lit("  "), "lang", F.lit(" "), "source", F.lit("　")),
                F.when(n % 10 == 0, F.concat(F.lit("# "), n.cast("string"))).otherwise(" \t"),
            )
        ).alias("value")
    )
    path = fresh_folder(spark, "keywords")
    lines.write.text(path)
    return read_keywords(spark, path, "docs").select("site", "keyword")


@query(
    "s2_seeds",
    """SELECT 'pages' AS site, 'page ' || page_id AS name, url,
        CASE WHEN page_id % 3 > 0 THEN 'about ' || url END AS description FROM pages""",
)
def s2_seeds(spark, sf_dir):
    n = F.col("page_no")
    seed = F.struct(
        F.concat(F.lit("page "), n.cast("string")).alias("name"),
        "url",
        F.when(n % 3 > 0, F.concat(F.lit("about "), "url")).alias("description"),
    )
    path = fresh_folder(spark, "seeds")
    page_table(spark, sf_dir).select(F.to_json(F.array(seed)).alias("value")).write.text(path)
    return read_seeds(spark, path, "pages", multi_line=False).drop("ord")


@query("s3_pages", "SELECT page_id, url, CAST(length(html) AS INTEGER) AS n_chars FROM pages")
def s3_pages(spark, sf_dir):
    return read_pages(spark, f"{sf_dir}/pages.parquet").select(
        "page_id", "url", F.length("html").alias("n_chars")
    )


def _threads(spark, sf_dir):
    """Work-list rows whose titles hold quotes, commas and line breaks."""
    title = F.concat(F.lit('违章 "'), F.col("page_no").cast("string"), F.lit('",\n第二行'))
    return page_table(spark, sf_dir).select(
        F.col("page_no").alias("n"),
        title.alias("post_title"),
        F.col("url").alias("post_link"),
        F.when(F.col("page_no") % 2 == 0, "2024-01-30T08:00:00+0800").alias("post_date"),
    )


_THREAD_SQL = """'违章 "' || page_id || '",' || chr(10) || '第二行' AS thread_title, url AS thread_link,
    CASE WHEN page_id % 2 = 0 THEN '2024-01-30T08:00:00+0800' END AS thread_date"""


@query("s4_latest_output", f"SELECT {_THREAD_SQL} FROM pages")
def s4_latest_output(spark, sf_dir):
    threads, root = _threads(spark, sf_dir).drop("n"), fresh_folder(spark, "listings")
    older = threads.withColumn("post_title", F.lit("old"))
    # The newer folder has the older start time in its name: the time of writing decides.
    write_rows(older, root, "articles", "forum_threads", STARTED, "csv")
    write_rows(threads, root, "articles", "forum_threads", STARTED.replace(hour=1), "csv")
    newest = latest_output(spark, f"{root}/articles_forum_threads_*/*.csv", folder=True)
    return read_worklist(spark, newest).drop("ord")


@query("s4_latest_committed", f"SELECT {_THREAD_SQL} FROM pages")
def s4_latest_committed(spark, sf_dir):
    threads, root = _threads(spark, sf_dir).drop("n"), fresh_folder(spark, "listings")
    write_rows(threads, root, "articles", "forum_threads", STARTED)
    # The newer folder is that of a run which ended before its mark was written.
    unfinished = threads.withColumn("post_title", F.lit("half")).write
    unfinished = unfinished.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    unfinished.parquet(f"{root}/{output_name('articles', 'forum_threads', STARTED.replace(hour=23))}")
    return read_worklist(spark, latest_committed(spark, f"{root}/articles_forum_threads_*")).drop("ord")


@query("s5_worklist_csv", f"SELECT {_THREAD_SQL} FROM pages")
def s5_worklist_csv(spark, sf_dir):
    threads, root = _threads(spark, sf_dir), fresh_folder(spark, "worklists")
    for part, charset in enumerate(("UTF-8", "GBK", "UTF-16")):
        rows = threads.filter(F.col("n") % 3 == part).drop("n")
        if charset == "GBK":
            rows = rows.withColumnsRenamed(
                {"post_title": "thread_title", "post_link": "thread_link", "post_date": "thread_date"}
            )
        rows.write.option("header", True).option("escape", '"').option("encoding", charset).csv(
            f"{root}/{charset}"
        )
    return usable_worklist(read_worklist(spark, f"{root}/*/*.csv")).drop("ord")


@query(
    "s6_roundtrip",
    "SELECT fmt, conv_id, turn, text FROM conversations, (VALUES ('csv'), ('parquet')) AS f(fmt)",
)
def s6_roundtrip(spark, sf_dir):
    rows, root = table(spark, sf_dir, "conversations").drop("role"), fresh_folder(spark, "outputs")
    parquet = write_rows(rows, root, "talks", "content", STARTED)
    csv = write_rows(rows, root, "talks", "content_text", STARTED, "csv")
    reader = spark.read.schema(rows.schema).option("header", True).option("multiLine", True)
    back = reader.option("escape", '"').csv(csv).withColumn("fmt", F.lit("csv"))
    return back.unionByName(spark.read.parquet(parquet).withColumn("fmt", F.lit("parquet")))


def _stream(spark, sf_dir):
    folder = fresh_folder(spark, "arriving")
    pages = page_table(spark, sf_dir)
    pages.repartition(4, "page_no").write.parquet(folder)
    profile = ARTICLES
    threads = thread_stream(
        read_page_stream(spark, folder, max_files=2), seed_table(pages), profile, KEYWORDS, AS_OF
    )
    out, state = fresh_folder(spark, "threads"), fresh_folder(spark, "state")
    append_to(threads, out, state).awaitTermination()
    return spark.read.parquet(out)


@query(
    "r1_stream",
    f"""SELECT page_no, item_no, title AS thread_title, 'https://' || {HOST_SQL} || '/' AS forum_url
        FROM (SELECT page_id AS page_no, url, CAST(i AS INTEGER) AS item_no, xs[i] AS title FROM
            (SELECT *, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS xs FROM pages),
            unnest(range(1, len(xs) + 1)) AS t(i))
        WHERE regexp_matches(title, '(?:the|tion|über|q[eu])', 'i')""",
)
def r1_stream(spark, sf_dir):
    rows = _stream(spark, sf_dir)
    return rows.select("page_no", "item_no", "thread_title", "forum_url")


def _counted(stream, batch, keys):
    """How often each row comes from either side; a repeated row shows as a second copy."""
    both = stream.select(*keys, F.lit("stream").alias("side")).unionByName(
        batch.select(*keys, F.lit("batch").alias("side"))
    )
    return both.groupBy(*keys, "side").agg(F.count("*").alias("copies"))


@query(
    "r1_stream_equals_batch",
    f"""SELECT page_no, item_no, title AS thread_title, {HOST_SQL} AS forum_name, side, CAST(1 AS BIGINT) AS copies,
        CASE WHEN href = '' THEN 'Missing thread_link' END AS reject_reason
        FROM (SELECT page_id AS page_no, url, CAST(i AS INTEGER) AS item_no, xs[i] AS title, hs[i] AS href FROM
            (SELECT *, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS xs,
                regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1) AS hs FROM pages),
            unnest(range(1, len(xs) + 1)) AS t(i)), (VALUES ('stream'), ('batch')) AS s(side)
        WHERE regexp_matches(title, '(?:the|tion|über|q[eu])', 'i')""",
)
def r1_stream_equals_batch(spark, sf_dir):
    keys = ["page_no", "item_no", "thread_title", "forum_name", "reject_reason"]
    batch = listed_threads(article_items(spark, sf_dir), ARTICLES)
    return _counted(_stream(spark, sf_dir), batch, keys)


@query(
    "r1_post_stream",
    f"""SELECT page_no, CAST(i AS INTEGER) AS item_no, side, CAST(1 AS BIGINT) AS copies
        FROM (SELECT page_id AS page_no, {PARAGRAPHS_SQL} AS xs FROM pages),
            unnest(range(1, len(xs) + 1)) AS t(i), (VALUES ('stream'), ('batch')) AS s(side)""",
)
def r1_post_stream(spark, sf_dir):
    """Posts of arriving pages, with every thread twice in the work list, beside those of the batch job."""
    folder = fresh_folder(spark, "arriving-posts")
    pages = page_table(spark, sf_dir)
    pages.repartition(4, "page_no").write.parquet(folder)
    once = thread_list(pages)
    threads = once.unionByName(once.withColumn("thread_link", F.concat("thread_link", F.lit("#again"))))
    posts = post_stream(read_page_stream(spark, folder, max_files=2), threads, ARTICLES)
    out, state = fresh_folder(spark, "posts"), fresh_folder(spark, "post-state")
    append_to(posts, out, state).awaitTermination()
    keys = ["page_no", "item_no"]
    return _counted(spark.read.parquet(out), content_job(pages, threads, ARTICLES).checked, keys)


def _arrivals(spark, sf_dir, start):
    """Pages that arrive in three parts; the stream that ``start`` makes of their items ends and starts again after each."""
    folder, state = fresh_folder(spark, "arriving"), fresh_folder(spark, "state")
    pages = page_table(spark, sf_dir)
    for part in range(3):
        pages.filter(F.col("page_no") % 3 == part).write.mode("append").parquet(folder)
        items = item_stream(read_page_stream(spark, folder), seed_table(pages), ARTICLES, KEYWORDS, AS_OF)
        start(items, state).awaitTermination()


@query("r1_stats", ORACLES["a1_forum_stats"])
def r1_stats(spark, sf_dir):
    out = fresh_folder(spark, "running-stats")
    _arrivals(spark, sf_dir, lambda items, state: update_to(stats_stream(items), out, state))
    return latest(spark, out, ["site", "forum_name"]).drop("site")


@query(
    "r1_sinks",
    f"""SELECT 'thread' AS kind, {HOST_SQL} AS forum_name, page_no, item_no, href <> '' AS accepted, CAST(NULL AS BIGINT) AS pages
        FROM (SELECT page_id AS page_no, url, CAST(i AS INTEGER) AS item_no, xs[i] AS title, hs[i] AS href FROM
            (SELECT *, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS xs,
                regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1) AS hs FROM pages),
            unnest(range(1, len(xs) + 1)) AS t(i))
        WHERE regexp_matches(title, '(?:the|tion|über|q[eu])', 'i')
        UNION ALL SELECT 'forum', {HOST_SQL}, NULL, NULL, NULL, count(*) FROM pages GROUP BY ALL""",
)
def r1_sinks(spark, sf_dir):
    """Accepted and rejected threads and the pages of each forum, from one extraction of each micro-batch."""
    root = fresh_folder(spark, "sinks")
    _arrivals(spark, sf_dir, lambda items, state: listing_to(items, ARTICLES, root, state))
    threads, stats = listing_so_far(spark, root)
    rows = threads.select(F.lit("thread").alias("kind"), "forum_name", "page_no", "item_no", "accepted")
    forums = stats.select(F.lit("forum").alias("kind"), "forum_name", "pages")
    return rows.unionByName(forums, allowMissingColumns=True)
