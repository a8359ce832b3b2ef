"""Lookup joins that carry parent fields to pages. Broadcasts depend on known file sizes.

Pages meet their forum or thread by the canonical link, the same key by which repeated rows of the
lookup tables are recognised; the lookup table must hold each key once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.links import canonical_url
from threadloom.session import stored

NO_DESCRIPTION = "No description provided"
#: Cells of a part: the finer the cells, the more evenly they fall on the parts.
CELLS = 16


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a wide table with a derived lookup table without moving the wide one when that is safe.

    Spark can only guess how large an aggregate will be, and guesses high, so the lookup table
    is stored first. Its file size is then a fact: below ``spark.sql.autoBroadcastJoinThreshold``
    it is broadcast, above it both sides are shuffled and hot keys split. No hint is given.
    """
    return big.join(stored(small, "lookup"), on, how)


def with_forum(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """Forum name, URL and description for every page of a known forum.

    No hint: a seed file is small by its file size, which is what Spark checks by itself.
    """
    forums = seeds.select(
        "site",
        canonical_url(F.col("url")).alias("_key"),
        F.col("name").alias("forum_name"),
        F.col("url").alias("forum_url"),
        F.coalesce("description", F.lit(NO_DESCRIPTION)).alias("forum_description"),
    )
    return pages.withColumn("_key", canonical_url(F.col("seed_url"))).join(forums, ["site", "_key"], "inner").drop("_key")


def _threads(worklist: DataFrame) -> DataFrame:
    return worklist.select(
        canonical_url(F.col("thread_link")).alias("_key"), "thread_title", "thread_link", "thread_date"
    )


def with_thread(pages: DataFrame, worklist: DataFrame) -> DataFrame:
    """Thread title, link and date for every page; pages of unknown threads keep nulls.

    The work list can be large, so this is a shuffle join; call it on extracted rows, never on
    page HTML. A thread that owns a third of the pages is split by the adaptive skew join
    (a left join may split its left side).
    """
    keyed = pages.withColumn("_key", canonical_url(F.col("seed_url")))
    return keyed.join(_threads(worklist), "_key", "left").drop("_key")


def hot_threads(pages: DataFrame, parts: int) -> DataFrame:
    """(_key, cells): threads with more pages than a sixteenth of an even part, and how many such cells they fill.

    Of ``parts`` parts at most ``16 * parts`` threads can be that large, so the result is small whatever the data.
    """
    counts = pages.groupBy(canonical_url(F.col("seed_url")).alias("_key")).agg(F.count("*").alias("n"))
    counts = stored(counts.filter("_key IS NOT NULL"), "thread-sizes")
    total = counts.agg(F.sum("n")).first()[0] or 0
    cell = max(1, total // (CELLS * parts))
    return stored(counts.filter(F.col("n") > cell).select("_key", F.ceil(F.col("n") / cell).alias("cells")), "hot-threads")


def with_thread_salted(pages: DataFrame, worklist: DataFrame, parts: int | None = None) -> DataFrame:
    """``with_thread`` that splits large threads by a count, with or without adaptive execution.

    Pages of a large thread are dealt out to cells by a hash of their link and number, and the one work-list row
    of that thread is repeated for each cell; all other rows stay as they are. Pages without a thread link
    match nothing and are dealt out the same way. The work list holds each thread once. Repeated rows
    of one page share a cell.
    """
    spark = pages.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_threads(pages, parts)
    spread = F.xxhash64("url", "page_no")
    # At most 16 rows a part, by construction: the broadcast does not grow with the pages.
    sized = pages.withColumn("_key", canonical_url(F.col("seed_url"))).join(F.broadcast(hot), "_key", "left")
    cells = F.when(F.col("_key").isNull(), F.lit(CELLS * parts)).otherwise(F.coalesce("cells", F.lit(1)))
    dealt = sized.withColumn("_cell", F.pmod(spread, cells)).drop("cells")
    listed = _threads(worklist).join(F.broadcast(hot), "_key", "left")
    last = F.coalesce("cells", F.lit(1)) - 1
    repeated = listed.withColumn("_cell", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("cells")
    return dealt.join(repeated, ["_key", "_cell"], "left").drop("_key", "_cell")
