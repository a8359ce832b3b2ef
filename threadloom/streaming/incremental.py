"""Structured Streaming form of both jobs.

Extraction is stateless and row-local, so threads and posts are appended as pages arrive. Statistics keep one
row of state per forum. Page limits need whole forums and stay with the batch job.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadloom import schemas
from threadloom.operators import crawl
from threadloom.operators.lookup import with_forum
from threadloom.operators.validate import REASON, clean_validate
from threadloom.plans.content import extract_posts, prepare_worklist
from threadloom.plans.listing import listed_threads, page_items, prepare_seeds
from threadloom.profiles import SiteProfile
from threadloom.session import configure


def read_page_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Page files appearing in a folder; ``max_files`` bounds one micro-batch."""
    configure(spark)
    reader = spark.readStream.schema(schemas.PAGES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def thread_stream(
    pages: DataFrame,
    seeds: DataFrame,
    profile: SiteProfile,
    keywords: Iterable[str],
    as_of: datetime | str | Column | None = None,
) -> DataFrame:
    """Thread rows with ``reject_reason``, as the batch listing job gives them without limits.

    Each page's own fetch time is "now" unless ``as_of`` says otherwise, so a stream may run on.
    """
    return listed_threads(item_stream(pages, seeds, profile, keywords, as_of), profile)


def item_stream(
    pages: DataFrame,
    seeds: DataFrame,
    profile: SiteProfile,
    keywords: Iterable[str],
    as_of: datetime | str | Column | None = None,
) -> DataFrame:
    """Arriving pages with their forum and judged items, from which threads and statistics are made."""
    site_pages = pages.filter(F.col("site") == profile.site)
    return with_forum(page_items(site_pages, profile, keywords, as_of), prepare_seeds(seeds, profile))


def stats_stream(items: DataFrame) -> DataFrame:
    """Running statistics per forum, as ``forum_stats`` gives them for all pages that have come so far.

    The state holds three sums a forum; each task adds up its pages before the exchange.
    """
    return crawl.forum_stats(items)


def post_stream(pages: DataFrame, worklist: DataFrame, profile: SiteProfile) -> DataFrame:
    """Checked post rows; the work list is a fixed table looked up by every micro-batch."""
    site_pages = pages.filter(F.col("site") == profile.site)
    threads = prepare_worklist(worklist, profile)
    return clean_validate(extract_posts(site_pages, threads, profile), profile.post_rules, profile.zone)


def append_to(df: DataFrame, folder: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start appending to a Parquet folder; ``once`` stops after what is there now."""
    writer = df.writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", folder).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def update_to(df: DataFrame, folder: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start writing changed rows of a stateful stream, each micro-batch into a folder of its own number.

    A batch that is replayed after a failure replaces its folder; ``latest`` reads the folders.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = df.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def latest(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The last row that ``update_to`` wrote for each key; every key shrinks to one row per task first."""
    rows = spark.read.parquet(folder)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_last")).select(*keys, "_last.*")


def listing_to(items: DataFrame, profile: SiteProfile, root: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start writing threads (``accepted=true`` and ``=false``) and statistics of each micro-batch under ``root``.

    The batch's items are written first and read back, so pages are searched once for all outputs. Every
    output of a batch lies in a folder of its number, so a replayed batch changes nothing.
    """

    def save(batch: DataFrame, number: int) -> None:
        place = lambda kind: f"{root}/{kind}/batch={number}"
        batch.write.mode("overwrite").parquet(place("items"))
        stored = batch.sparkSession.read.schema(batch.schema).parquet(place("items"))
        threads = listed_threads(stored, profile).withColumn("accepted", F.col(REASON).isNull())
        threads.write.mode("overwrite").partitionBy("accepted").parquet(place("threads"))
        crawl.forum_stats(stored).write.mode("overwrite").parquet(place("stats"))

    writer = items.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def listing_so_far(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Threads and statistics that ``listing_to`` has written under ``root``."""
    stats = spark.read.parquet(f"{root}/stats").groupBy("site", "forum_name")
    # Folder names come back as texts.
    threads = spark.read.parquet(f"{root}/threads").withColumn("accepted", F.col("accepted").cast("boolean"))
    return threads.drop("batch"), stats.agg(*(F.sum(c).alias(c) for c in ("pages", "crawled", "yielded")))
