"""Streams that remember: work lists that arrive beside pages, repeated pages, and the first empty page.

State is bounded by watermarks: hours of pages and threads, never the whole history. A row that comes more
than its delay behind the newest one of its stream is late, and Spark leaves it out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from threadloom import schemas
from threadloom.functions.links import canonical_url
from threadloom.operators import crawl
from threadloom.operators.filters import allowed_host, usable_worklist
from threadloom.operators.lookup import with_thread
from threadloom.operators.validate import clean_validate
from threadloom.plans.content import page_posts, post_rows, prepare_worklist
from threadloom.profiles import SiteProfile
from threadloom.session import configure

LISTED = T.StructType([*schemas.WORKLIST, T.StructField("listed_at", T.TimestampType(), True)])
_STOPS = "site string, seed_url string, _stop struct<page_no bigint, url string>, batch bigint"


def read_worklist_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Parquet work lists appearing in a folder, each row with the time ``listed_at`` of its listing."""
    configure(spark)
    reader = spark.readStream.schema(LISTED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def once_per_link(rows: DataFrame, link: str, time: str, hours: int) -> DataFrame:
    """The first row to arrive of every canonical link; one that comes again within ``hours`` is dropped.

    The state holds one key a link for ``hours``. A page fetched again later than that counts as a
    new page. Rows without a link or a time cannot be recognised: all of them pass. Rows are shuffled by
    their link, so take the text out of pages before.
    """
    known = F.col(link).isNotNull() & F.col(time).isNotNull()
    timed = rows.filter(known).withWatermark(time, f"{hours} hours")
    once = timed.withColumn("_link", canonical_url(F.col(link))).dropDuplicatesWithinWatermark(["_link"])
    return once.drop("_link").unionByName(rows.filter(~known))


def posts_once(pages: DataFrame, profile: SiteProfile, hours: int = 24) -> DataFrame:
    """One row per page with its posts as an array, each page once however often it is fetched within ``hours``."""
    return once_per_link(page_posts(pages.filter(F.col("site") == profile.site), profile), "url", "fetched_at", hours)


def checked_posts(found: DataFrame, worklist: DataFrame, profile: SiteProfile) -> DataFrame:
    """Checked post rows of pages whose posts are extracted; the work list is a fixed table."""
    joined = with_thread(found, prepare_worklist(worklist, profile))
    return clean_validate(post_rows(joined, profile), profile.post_rules, profile.zone)


def arriving_posts(
    pages: DataFrame, worklist: DataFrame, profile: SiteProfile, within: int = 24, delay: int = 1
) -> DataFrame:
    """Checked posts of arriving pages and an arriving work list, whichever of the two comes first.

    A page meets the thread that was listed up to ``within`` hours before or after it was fetched; its posts
    come out as soon as both are there. Pages whose thread does not come are given out without thread fields
    once the watermarks have passed, as the batch job gives them at once. Both streams may run ``delay`` hours out of
    order. Pages without fetch time have no place in a window: they come out at once, without thread fields.
    Threads without ``listed_at`` can meet no page. Of a thread listed again within two windows the first
    to arrive counts, so no page can meet it twice. The state holds extracted posts, no HTML.
    """
    # Listings are remembered for two windows: of two that one page could meet, the second is still recognised.
    memory = max(delay, 2 * within)
    usable = usable_worklist(worklist).filter(allowed_host(F.col("thread_link"), profile.domains))
    threads = usable.filter("listed_at IS NOT NULL").withColumn("_thread", canonical_url(F.col("thread_link")))
    threads = threads.withWatermark("listed_at", f"{memory} hours").dropDuplicatesWithinWatermark(["_thread"])
    found = page_posts(pages.filter(F.col("site") == profile.site), profile)
    timed = found.filter("fetched_at IS NOT NULL").withColumn("_key", canonical_url(F.col("seed_url")))
    timed = timed.withWatermark("fetched_at", f"{delay} hours")
    window = F.expr(f"interval {within} hours")
    near = F.col("listed_at").between(F.col("fetched_at") - window, F.col("fetched_at") + window)
    met = timed.join(threads, (F.col("_key") == F.col("_thread")) & near, "left").drop("_key", "_thread", "listed_at")
    nothing = {c: F.lit(None).cast("string") for c in ("thread_title", "thread_link", "thread_date")}
    met = met.unionByName(found.filter("fetched_at IS NULL").withColumns(nothing))
    return clean_validate(post_rows(met, profile), profile.post_rules, profile.zone)


def prefix_to(pages: DataFrame, root: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start keeping, under ``root``, the pages before the first empty one of each forum, in any order of arrival.

    ``pages`` are narrow rows with ``site``, ``seed_url``, ``page_no``, ``url`` and ``n_items``. Each micro-batch leaves out
    what lies behind an empty page known so far, and writes its pages and its own first empty pages into
    folders of its number, so a replayed batch changes nothing. Pages that an earlier empty page overtakes
    later are taken back by ``prefix_so_far``.
    """
    spark = pages.sparkSession
    stops = f"{root}/stops"
    # An empty folder for the first batch to read.
    spark.createDataFrame([], _STOPS).drop("batch").write.mode("ignore").parquet(f"{stops}/batch=-1")

    def save(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        place = f"{root}/pages/batch={number}"
        known = _first_stops(session, root, F.col("batch") < number)
        kept = crawl.not_behind(batch.join(known, ["site", "seed_url"], "left"))
        kept.write.mode("overwrite").parquet(place)
        written = session.read.schema(kept.schema).parquet(place)
        crawl.first_empty(written).write.mode("overwrite").parquet(f"{stops}/batch={number}")

    writer = pages.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _first_stops(spark: SparkSession, root: str, which) -> DataFrame:
    stops = spark.read.schema(_STOPS).parquet(f"{root}/stops").filter(which)
    return stops.groupBy("site", "seed_url").agg(F.min("_stop").alias("_stop"))


def prefix_so_far(spark: SparkSession, root: str) -> DataFrame:
    """The pages up to the first empty one of each forum, of all that ``prefix_to`` has written."""
    pages = spark.read.parquet(f"{root}/pages").drop("batch")
    stops = _first_stops(spark, root, F.lit(True))
    return crawl.not_behind(crawl.lookup_join(pages, stops, ["site", "seed_url"], "left"))
