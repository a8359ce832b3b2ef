"""Page limits, statistics and lookups, with one forum holding a third of all pages."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom import schemas
from threadloom.operators import crawl
from threadloom.operators.lookup import NO_DESCRIPTION, with_forum, with_thread


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    rows = []
    for n in range(6000):
        seed = "hot" if rng.random() < 0.35 else f"s{rng.randint(0, 200)}"
        rows.append(("x", seed, rng.randint(1, 400), f"u{n}", rng.choice([0, 1, 2, 3]) if n % 50 else 0))
    df = spark.createDataFrame(rows, "site string, seed_url string, page_no long, url string, n_items int")
    return rows, df.repartition(9)


def by_seed(rows):
    forums = {}
    for row in sorted(rows, key=lambda r: (r[2], r[3])):
        forums.setdefault(row[1], []).append(row)
    return forums


@pytest.mark.parametrize("n", [1, 5, 1000])
def test_first_pages_equals_brute_force(skewed, n):
    rows, df = skewed
    want = [r[3] for pages in by_seed(rows).values() for r in pages[:n]]
    assert sorted(r.url for r in crawl.first_pages(df, n).collect()) == sorted(want)


def test_pages_until_empty_equals_brute_force(skewed):
    rows, df = skewed
    want = []
    for pages in by_seed(rows).values():
        for row in pages:
            want.append(row[3])
            if row[4] == 0:
                break
    assert sorted(r.url for r in crawl.pages_until_empty(df).collect()) == sorted(want)


def test_lookup_without_broadcast_gives_the_same_rows(spark, skewed):
    _, df = skewed
    want = sorted(r.url for r in crawl.first_pages(df, 3).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        kept = crawl.first_pages(df, 3)
        assert sorted(r.url for r in kept.collect()) == want
        assert "SortMergeJoin" in kept._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pages_until_empty_literal(spark):
    rows = [("x", "s", i, f"u{i}", n) for i, n in enumerate([3, 2, 0, 4], 1)]
    df = spark.createDataFrame(rows, "site string, seed_url string, page_no long, url string, n_items int")
    assert sorted(r.page_no for r in crawl.pages_until_empty(df).collect()) == [1, 2, 3]


def test_forum_stats_merges_forums_of_one_name(spark):
    pages = [("f1", 1, 3, 1), ("f1", 2, 2, 0), ("f2", 1, 0, 0), ("f1b", 1, 1, 1)]
    rows = [("x", seed, no, [("keep",)] * kept + [("skip",)] * (n - kept)) for seed, no, n, kept in pages]
    items = spark.createDataFrame(rows, "site string, seed_url string, page_no long, items array<struct<status:string>>")
    seeds = spark.createDataFrame(
        [("x", 0, "f1", "f1", "d"), ("x", 1, "f2", "f2", None), ("x", 2, "f1", "f1b", None), ("x", 3, "f3", "f3", None)],
        schemas.SEEDS,
    )
    stats = crawl.forum_stats(with_forum(items, seeds))
    want = {("x", "f1", 3, 6, 2), ("x", "f2", 1, 0, 0)}
    assert {tuple(r) for r in stats.collect()} == want
    assert {tuple(r) for r in crawl.with_zero_rows(stats, seeds).collect()} == want | {("x", "f3", 0, 0, 0)}


def test_with_forum_adds_default_description_and_drops_unknown_pages(spark):
    pages = spark.createDataFrame([("x", "a", 1), ("x", "b", 1), ("x", "zz", 1)], "site string, seed_url string, page_no long")
    seeds = spark.createDataFrame([("x", 0, "A", "a", None), ("x", 1, "B", "b", "about b")], schemas.SEEDS)
    got = {(r.forum_name, r.forum_url, r.forum_description) for r in with_forum(pages, seeds).collect()}
    assert got == {("A", "a", NO_DESCRIPTION), ("B", "b", "about b")}


def test_with_thread_splits_a_hot_thread(spark):
    pages = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("seed_url"),
        F.col("id").alias("page_no"),
        F.repeat(F.lit("x"), 300).alias("body"),
    )
    worklist = spark.createDataFrame([("t", "hot", "d")] + [(f"t{i}", str(i), "d") for i in range(2000)], schemas.WORKLIST)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = with_thread(pages.repartition(16), worklist)
        n, titles = joined.agg(F.count("*"), F.count_if(F.col("thread_title") == "t")).first()
        assert (n, titles) == (60000, 20000)
        rows = joined.select("page_no", "thread_title")
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
