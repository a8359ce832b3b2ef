"""Streams with memory give what the batch jobs give, in any order of arrival."""

from datetime import datetime, timedelta

import pytest
from test_sites import TIEBA_POSTS
from test_streaming import rows

from threadloom import profiles, schemas
from threadloom.operators import crawl
from threadloom.plans.content import content_job
from threadloom.streaming.arriving import (
    LISTED,
    arriving_posts,
    checked_posts,
    once_per_link,
    posts_once,
    prefix_so_far,
    prefix_to,
    read_worklist_stream,
)
from threadloom.streaming.incremental import append_to, read_page_stream

START = datetime(2024, 2, 1)
PROFILE = profiles.TIEBA


def link(n):
    return f"https://tieba.baidu.com/p/{n}"


def pages(spark, *threads, hours=0, page=1):
    at = None if hours is None else START + timedelta(hours=hours)
    made = [(PROFILE.site, link(n), page, f"{link(n)}?pn={page}", TIEBA_POSTS, at) for n in threads]
    return spark.createDataFrame(made, schemas.PAGES)


def listed(spark, *threads, hours=0, title="交通事故", mark=""):
    at = None if hours is None else START + timedelta(hours=hours)
    return spark.createDataFrame([(title, link(n) + mark, None, at) for n in threads], LISTED)


@pytest.fixture
def arrive(spark, tmp_path):
    """Lets pages and threads arrive and runs the stream once; returns all rows so far."""
    folders = {k: str(tmp_path / k) for k in ("pages", "lists", "out", "state")}
    none = {"pages": pages(spark), "lists": listed(spark)}

    def step(**new):
        for kind, empty in none.items():
            new.get(kind, empty).write.mode("append").parquet(folders[kind])
        stream = arriving_posts(
            read_page_stream(spark, folders["pages"]), read_worklist_stream(spark, folders["lists"]), PROFILE
        )
        append_to(stream, folders["out"], folders["state"]).awaitTermination()
        return spark.read.schema(stream.schema).parquet(folders["out"])

    step.folders = folders
    return step


def test_threads_and_pages_in_any_order(spark, arrive):
    assert arrive(pages=pages(spark, 1, 2)).count() == 0
    assert arrive(lists=listed(spark, 1, 3)).select("thread_link").collect()[0][0] == link(1)
    # Listed again with another title: the first to arrive counts.
    arrive(pages=pages(spark, 1, 3, hours=2, page=2), lists=listed(spark, 1, hours=3, title="other", mark="#x"))
    # Days later both streams go on, so page 2 no longer waits for its thread.
    got = arrive(pages=pages(spark, 9, hours=400), lists=listed(spark, 9, hours=400))
    every = spark.read.schema(schemas.PAGES).parquet(arrive.folders["pages"])
    batch = content_job(every, listed(spark, 1, 3, 9).drop("listed_at"), PROFILE).checked
    assert rows(got.select(batch.columns)) == rows(batch)
    assert {r.thread_title for r in got.collect()} == {None, "交通事故"}


def test_rows_without_times(spark, arrive):
    got = arrive(pages=pages(spark, 1, hours=None), lists=listed(spark, 1, hours=None).unionByName(listed(spark, 1)))
    assert [(r.thread_link, r.thread_title) for r in got.collect()] == [(link(1) + "?pn=1", None)]


def test_a_page_fetched_twice_gives_its_posts_once(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("pages", "out", "state"))
    worklist = listed(spark, 1, 2).drop("listed_at")
    for hours in (0, 5):
        pages(spark, 1, 2, hours=hours).write.mode("append").parquet(folder)
        found = posts_once(read_page_stream(spark, folder), PROFILE)
        append_to(checked_posts(found, worklist, PROFILE), out, state).awaitTermination()
    batch = content_job(pages(spark, 1, 2), worklist, PROFILE).checked
    assert rows(spark.read.parquet(out).select(batch.columns)) == rows(batch)


def test_rows_that_cannot_be_recognised_all_pass(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("pages", "out", "state"))
    odd = pages(spark, 1, 1, hours=None).unionByName(pages(spark, 2, 2)).unionByName(pages(spark, 3).drop("url").selectExpr("*", "CAST(NULL AS STRING) AS url"))
    odd.write.parquet(folder)
    append_to(once_per_link(read_page_stream(spark, folder), "url", "fetched_at", 24), out, state).awaitTermination()
    got = [r.url for r in spark.read.parquet(out).collect()]
    assert sorted(got, key=str) == [None, link(1) + "?pn=1", link(1) + "?pn=1", link(2) + "?pn=1"]


@pytest.mark.parametrize("order", [(1, 2, 3, 4, 5), (5, 4, 3, 2, 1), (4, 1, 5, 3, 2)])
def test_first_empty_page_in_any_order(spark, tmp_path, order):
    kind = "site string, seed_url string, page_no bigint, url string, n_items int"
    table = spark.createDataFrame(
        [("s", f, n, f"{f}{n}", int((f, n) not in {("a", 3), ("a", 5), ("b", 1)})) for f in "abc" for n in range(1, 6)], kind
    )
    folder, root, state = (str(tmp_path / n) for n in ("pages", "root", "state"))
    for n in order:
        table.filter(f"page_no = {n}").write.mode("append").parquet(folder)
        prefix_to(spark.readStream.schema(kind).parquet(folder), root, state).awaitTermination()
    want = rows(crawl.pages_until_empty(table))
    assert len(want) == 3 + 1 + 5 and rows(prefix_so_far(spark, root).select(table.columns)) == want
    # Without its checkpoint the second run knows nothing of the first and writes batch 0 again.
    again = str(tmp_path / "again")
    for run in ("s2", "s3"):
        prefix_to(spark.readStream.schema(kind).parquet(folder), again, str(tmp_path / run)).awaitTermination()
    assert rows(prefix_so_far(spark, again).select(table.columns)) == want
