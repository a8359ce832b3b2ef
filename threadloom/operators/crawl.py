"""Page limits per forum, and the statistics of a listing run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.filters import KEEP
from threadloom.operators.lookup import lookup_join

SALTS = 512


def _last_of_first(keys: DataFrame, n: int) -> DataFrame:
    """Per forum, the (page_no, url) of its n-th page, or of its last page when it has fewer.

    Two ranks: the first inside salted parts of a forum, the second over what is left. No task
    sorts a whole forum, however large it is, because each part passes on at most n rows.
    """
    part = Window.partitionBy("site", "seed_url", "_salt").orderBy("page_no", "url")
    whole = Window.partitionBy("site", "seed_url").orderBy("page_no", "url")
    return (
        keys.withColumn("_salt", F.pmod(F.xxhash64("page_no", "url"), F.lit(SALTS)))
        .withColumn("_rank", F.row_number().over(part))
        .filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(whole))
        .filter(F.col("_rank") <= n)
        .groupBy("site", "seed_url")
        .agg(F.max(F.struct("page_no", "url")).alias("_last"))
    )


def first_pages(pages: DataFrame, n: int) -> DataFrame:
    """The first ``n`` pages of every forum by page number.

    Only page keys are ranked. The pages themselves, with their HTML, meet one limit row per
    forum in a lookup join and are not shuffled.
    """
    keys = pages.select("site", "seed_url", "page_no", "url")
    limits = _last_of_first(keys, n)
    kept = lookup_join(pages, limits, ["site", "seed_url"])
    return kept.filter(F.struct("page_no", "url") <= F.col("_last")).drop("_last")


def first_empty(pages: DataFrame, n_items: str = "n_items") -> DataFrame:
    """Per forum, the (page_no, url) of its first page without records as ``_stop``; forums without one have no row."""
    empty = pages.filter(F.col(n_items) == 0)
    return empty.groupBy("site", "seed_url").agg(F.min(F.struct("page_no", "url")).alias("_stop"))


def not_behind(kept: DataFrame) -> DataFrame:
    """Pages that do not come after the ``_stop`` of their row."""
    inside = F.col("_stop").isNull() | (F.struct("page_no", "url") <= F.col("_stop"))
    return kept.filter(inside).drop("_stop")


def pages_until_empty(pages: DataFrame, n_items: str = "n_items") -> DataFrame:
    """Pages up to and including the first page without records, per forum.

    The first empty page is a minimum, which is aggregated before the shuffle; a running sum
    would have to sort each forum in one task.
    """
    return not_behind(lookup_join(pages, first_empty(pages, n_items), ["site", "seed_url"], "left"))


def forum_stats(page_items: DataFrame, items: str = "items") -> DataFrame:
    """Pages, threads seen and threads kept per forum name.

    Counts come from each page's item array, so pages without items count, nothing is
    exploded, and one partial aggregation per task goes before the only shuffle.
    """
    counted = page_items.select(
        "site",
        "forum_name",
        F.size(items).cast("bigint").alias("_seen"),
        F.size(F.filter(items, lambda x: x["status"] == KEEP)).cast("bigint").alias("_kept"),
    )
    return counted.groupBy("site", "forum_name").agg(
        F.count("*").alias("pages"),
        F.sum("_seen").alias("crawled"),
        F.sum("_kept").alias("yielded"),
    )


def with_zero_rows(stats: DataFrame, seeds: DataFrame) -> DataFrame:
    """Statistics plus a row of zeros for every forum that has none."""
    names = seeds.select("site", F.col("name").alias("forum_name")).distinct()
    zero = {c: 0 for c in ("pages", "crawled", "yielded")}
    return names.join(stats, ["site", "forum_name"], "left").fillna(zero)
