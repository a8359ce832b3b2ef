"""Page numbers from next links, for pages that were saved without one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.links import canonical_url
from threadloom.session import stored


def _links(edges: DataFrame, pages: DataFrame) -> DataFrame:
    """(key, before): each page and the page before it, itself where there is none.

    Every page goes on to one page at most and follows one page at most, so pages form paths and rings.
    Links to a page itself or to pages that were not fetched count for nothing. Of several links
    from or to a page the smallest counts; both choices are minima, which shrink before the shuffle.
    """
    keys = pages.select(canonical_url(F.col("url")).alias("key")).filter("key IS NOT NULL").distinct()
    ahead = edges.select(canonical_url(F.col("page_url")).alias("before"), canonical_url(F.col("next_url")).alias("key"))
    ahead = ahead.filter("key <> before").join(keys, "key", "left_semi")
    ahead = ahead.join(keys.withColumnRenamed("key", "before"), "before", "left_semi")
    one_next = ahead.groupBy("before").agg(F.min("key").alias("key"))
    one_before = one_next.groupBy("key").agg(F.min("before").alias("before"))
    return keys.join(one_before, "key", "left")


def chain_positions(edges: DataFrame, pages: DataFrame) -> DataFrame:
    """(key, first, page_no) for each canonical link of ``pages``; both are null for pages on a ring.

    Pointer doubling: every page points at a page ``steps`` before it, and each round adds the steps
    of the page it points at, so a chain of n pages takes about log2(n) rounds. Pages that have
    found their first page are not joined again, and no two others point at the same page: no key is hot.
    A round in which no page arrives leaves rings only. Each round is stored, so a lost executor
    costs one round at most.
    """
    before = F.col("before")
    state = _links(edges, pages).select(
        "key",
        F.coalesce(before, "key").alias("at"),
        before.isNotNull().cast("bigint").alias("steps"),
        before.isNull().alias("done"),
    )
    state = stored(state, "chain")
    left = state.filter("NOT done").count()
    while left:
        jump = state.select(F.col("key").alias("at"), F.col("at").alias("_at"), F.col("steps").alias("_steps"), F.col("done").alias("_done"))
        moved = state.filter("NOT done").join(jump, "at").select(
            "key", F.col("_at").alias("at"), (F.col("steps") + F.col("_steps")).alias("steps"), F.col("_done").alias("done")
        )
        state = stored(state.filter("done").unionByName(moved), "chain")
        still = state.filter("NOT done").count()
        if still == left:
            break
        left = still
    return state.select(
        "key", F.when(F.col("done"), F.col("at")).alias("first"), F.when(F.col("done"), F.col("steps") + 1).alias("page_no")
    )


def numbered_pages(pages: DataFrame, edges: DataFrame) -> DataFrame:
    """``pages`` with ``seed_url`` and ``page_no`` from their chain of next links, and ``on_ring``.

    The first page of a chain is its thread or forum, in canonical form. Pages without next links are chains
    of one page. Pages on a ring, and pages without a link, have nulls and keep their row. Rows that
    repeat a link get the same number. Only links are joined and sorted; the page text meets one narrow row.
    """
    found = chain_positions(edges, pages).select(
        F.col("key").alias("_key"), F.col("first").alias("seed_url"), "page_no", F.col("first").isNull().alias("on_ring")
    )
    keyed = pages.drop("seed_url", "page_no", "on_ring").withColumn("_key", canonical_url(F.col("url")))
    joined = keyed.join(stored(found, "positions"), "_key", "left").drop("_key")
    return joined.withColumn("on_ring", F.coalesce("on_ring", F.lit(False)))
