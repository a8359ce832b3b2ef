"""Streams give what the batch jobs give, also when pages arrive in several runs."""

from test_sites import AS_OF, AUTOHOME_LIST, TIEBA_POSTS, pages_of, seeds_of

from threadloom import profiles, schemas
from threadloom.operators.lookup import with_forum
from threadloom.operators.validate import clean_validate
from threadloom.plans.content import extract_posts
from threadloom.plans.listing import listed_threads, page_items
from threadloom.operators.crawl import forum_stats
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


def rows(df):
    return sorted(str(r) for r in df.collect())


def test_threads(spark, tmp_path):
    profile, keywords = profiles.AUTOHOME, ["违章"]
    htmls = [AUTOHOME_LIST.replace("1.html", f"{n}.html").replace("2天前", t) for n, t in enumerate(["2天前", "junk", ""])]
    pages, seeds = pages_of(spark, profile, *htmls), seeds_of(spark, profile)
    folder, out, state = (str(tmp_path / n) for n in ("pages", "out", "state"))
    for part in ("page_no = 1", "page_no > 1"):
        pages.filter(part).write.mode("append").parquet(folder)
        stream = thread_stream(read_page_stream(spark, folder, max_files=1), seeds, profile, keywords, AS_OF)
        append_to(stream, out, state).awaitTermination()
    batch = listed_threads(with_forum(page_items(pages, profile, keywords, AS_OF), seeds), profile)
    got = spark.read.parquet(out)
    assert rows(got.select(batch.columns)) == rows(batch)
    assert got.count() == 3 and got.filter("reject_reason is null").count() == 2


def test_posts(spark, tmp_path):
    profile = profiles.TIEBA
    link = "https://tieba.baidu.com/p/123"
    pages = pages_of(spark, profile, TIEBA_POSTS, TIEBA_POSTS.replace("1楼", ""), seed=link)
    worklist = spark.createDataFrame([("交通事故", link, None)], schemas.WORKLIST)
    folder, out, state = (str(tmp_path / n) for n in ("pages", "out", "state"))
    pages.write.parquet(folder)
    append_to(post_stream(read_page_stream(spark, folder), worklist, profile), out, state).awaitTermination()
    batch = clean_validate(extract_posts(pages, worklist, profile), profile.post_rules, profile.zone)
    got = spark.read.parquet(out)
    assert rows(got.select(batch.columns)) == rows(batch)
    assert {r.reject_reason for r in got.collect()} == {None, "Missing position"}


def test_statistics_and_sinks_over_restarts(spark, tmp_path):
    profile, keywords = profiles.AUTOHOME, ["违章"]
    htmls = [AUTOHOME_LIST.replace("2天前", t) for t in ("2天前", "junk", "", "3天前")]
    pages, seeds = pages_of(spark, profile, *htmls), seeds_of(spark, profile)
    folder, out, root = (str(tmp_path / n) for n in ("pages", "out", "root"))
    for part in ("page_no = 1", "page_no > 2", "page_no = 2"):
        pages.filter(part).write.mode("append").parquet(folder)
        items = item_stream(read_page_stream(spark, folder, max_files=1), seeds, profile, keywords, AS_OF)
        update_to(stats_stream(items), out, str(tmp_path / "state")).awaitTermination()
        listing_to(items, profile, root, str(tmp_path / "state2")).awaitTermination()
    whole = with_forum(page_items(pages, profile, keywords, AS_OF), seeds)
    want = rows(forum_stats(whole))
    assert rows(latest(spark, out, ["site", "forum_name"])) == want
    threads, stats = listing_so_far(spark, root)
    batch = listed_threads(whole, profile)
    assert rows(stats) == want and rows(threads.select(batch.columns)) == rows(batch)
    assert threads.filter("accepted").count() == batch.filter("reject_reason IS NULL").count()


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    profile = profiles.AUTOHOME
    pages, seeds = pages_of(spark, profile, AUTOHOME_LIST), seeds_of(spark, profile)
    folder, root = str(tmp_path / "pages"), str(tmp_path / "root")
    pages.write.parquet(folder)
    # Without its checkpoint the second run knows nothing of the first and writes batch 0 again.
    for run in ("a", "b"):
        items = item_stream(read_page_stream(spark, folder), seeds, profile, ["违章"], AS_OF)
        listing_to(items, profile, root, str(tmp_path / run)).awaitTermination()
        threads, stats = listing_so_far(spark, root)
        assert threads.count() == 1 and stats.first().pages == 1
