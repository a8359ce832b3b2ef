"""Page numbers from next links, and large threads split by their counted pages."""

import statistics

import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.operators.lookup import with_thread, with_thread_salted
from threadloom.operators.page_order import chain_positions, numbered_pages


def order_of(spark, links, pages):
    edges = spark.createDataFrame(links, "page_url string, next_url string")
    df = spark.createDataFrame([(u, "x") for u in pages], "url string, html string")
    return {r.url: (r.seed_url, r.page_no, r.on_ring) for r in numbered_pages(df, edges).collect()}


def u(n):
    return f"https://f/{n}"


def test_paths_rings_and_single_pages(spark):
    links = [(u(1), u(2)), (u(2), u(3)), (u(3), u(3)), (u(5), u(6)), (u(6), u(5)), (u(8), u("gone"))]
    got = order_of(spark, links, [u(n) for n in (1, 2, 3, 5, 6, 7, 8)] + [None])
    assert got == {
        u(1): (u(1), 1, False), u(2): (u(1), 2, False), u(3): (u(1), 3, False),
        u(5): (None, None, True), u(6): (None, None, True),
        u(7): (u(7), 1, False), u(8): (u(8), 1, False), None: (None, None, False),
    }


def test_several_links_and_repeated_pages(spark):
    # 1 and 2 both lead to 9: the smaller link counts. 3 leads to 4 and 5: the smaller one counts.
    links = [(u(2), u(9)), (u(1), u(9) + "#a"), (u(3), u(5)), (u(3), u(4)), (None, u(1)), (u(1), None)]
    got = order_of(spark, links, [u(n) for n in (1, 2, 3, 4, 5, 9, 9)])
    assert got[u(9)] == (u(1), 2, False) and got[u(2)] == (u(2), 1, False)
    assert got[u(4)] == (u(3), 2, False) and got[u(5)] == (u(5), 1, False)


@pytest.mark.parametrize("n", [0, 1])
def test_empty_tables(spark, n):
    edges = spark.createDataFrame([], "page_url string, next_url string")
    pages = spark.createDataFrame([(u(1), "x")] * n, "url string, html string")
    assert numbered_pages(pages, edges).count() == n


def test_long_chain(spark):
    n = 2_000
    ids = spark.range(n).select(F.col("id"), F.format_string("https://f/%d", "id").alias("url"))
    edges = ids.filter(f"id < {n - 1}").select(
        F.col("url").alias("page_url"), F.format_string("https://f/%d", F.col("id") + 1).alias("next_url")
    )
    found = chain_positions(edges, ids).withColumn("id", F.regexp_extract("key", r"(\d+)$", 1).cast("long"))
    assert found.filter("page_no = id + 1 AND first = 'https://f/0'").count() == n


def test_hot_thread_is_split_without_adaptive_execution(spark):
    n, parts = 24_000, 8
    number = F.col("id")
    link = F.when(number % 3 == 0, "https://f/hot").when(number % 3 == 1, F.format_string("https://f/%d", number))
    pages = spark.range(n).select(
        link.alias("seed_url"), F.format_string("https://f/p/%d", number).alias("url"), number.alias("page_no")
    )
    threads = [("hot", "https://f/hot", "d")] + [(str(i), f"https://f/{i}", None) for i in range(1, 3_000, 3)]
    worklist = spark.createDataFrame(threads, schemas.WORKLIST)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = with_thread_salted(pages, worklist)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == n and max(sizes) <= 2 * statistics.median(sizes), sizes
        want = with_thread(pages, worklist)
        assert got.exceptAll(want.select(got.columns)).isEmpty() and want.count() == n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
