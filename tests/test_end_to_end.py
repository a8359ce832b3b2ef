"""A listing run whose output folder feeds a content run, and next-page links."""

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F
from test_sites import AS_OF, AUTOHOME_LIST, AUTOHOME_POSTS, pages_of, seeds_of

from threadloom import profiles, schemas
from threadloom.operators.records import next_page_edges
from threadloom.plans.content import content_job
from threadloom.plans.listing import listing_job
from threadloom.sources.readers import keyword_list, latest_output, read_keywords, read_worklist
from threadloom.sources.writers import write_checked, write_rows


def test_listing_output_is_the_work_list_of_the_content_run(spark, tmp_path):
    profile = profiles.AUTOHOME
    (tmp_path / "keywords.txt").write_text("# words\n违章\n", encoding="utf-8")
    keywords = keyword_list(read_keywords(spark, str(tmp_path / "keywords.txt")))
    htmls = [AUTOHOME_LIST, AUTOHOME_LIST.replace("1.html", "1.html#reply"), AUTOHOME_LIST.replace("违章", "天气")]
    listed = listing_job(pages_of(spark, profile, *htmls), seeds_of(spark, profile), profile, keywords, AS_OF)
    assert listed.stats.collect() == [("autohome", "f1", 3, 3, 2)]

    out = str(tmp_path / "out")
    older, newer = datetime(2024, 2, 1, 8), datetime(2024, 2, 1, 9)
    write_rows(listed.threads.limit(0), out, profile.site, "forum_threads", older, "csv")
    write_rows(listed.threads.orderBy("page_no").coalesce(1), out, profile.site, "forum_threads", newer, "csv")
    folder = latest_output(spark, f"{out}/{profile.site}_forum_threads_*/*.csv", folder=True)
    assert folder.endswith("_20240201_090000")
    worklist = read_worklist(spark, folder)
    assert worklist.count() == 2

    link = "https://club.autohome.com.cn/bbs/thread/1.html"
    pages = pages_of(spark, profile, AUTOHOME_POSTS, seed=link)
    got = content_job(pages, worklist, profile)
    assert sorted((r.position, r.text, r.thread_title, r.date) for r in got.posts.collect()) == [
        ("1", "onetwo", "违章怎么办", "2024-01-30 00:00:00 UTC"),
        ("2", "okay", "违章怎么办", "2024-05-01 02:30:00 UTC"),
    ]
    path = write_checked(got.checked, out, profile.site, "content", newer)
    assert spark.read.parquet(path).filter(F.col("accepted") == "true").count() == 2


def test_next_page_edges(spark):
    profile = profiles.TESLA
    pager = (
        '<div class="block-outer-main"><a class="pageNav-jump pageNav-jump--next button button--icon-only" href="/no">x</a></div>'
        '<div class="block-outer-opposite"><a class="button pageNav-jump button--icon-only pageNav-jump--next" '
        'href="/threads/a.1/page-2?a=1&amp;b=2">Next</a></div>'
    )
    last = '<div class="block-outer-opposite"><a class="pageNav-jump pageNav-jump--prev button button--icon-only" href="/p">x</a></div>'
    pages = pages_of(spark, profile, pager, last, seed="https://f/")
    edges = next_page_edges(pages, profile.next_page, profile.base_url)
    assert edges.collect() == [("https://f/?1", "https://www.teslaownersonline.com/threads/a.1/page-2?a=1&b=2")]


def test_repeated_seeds_count_once(spark):
    profile = profiles.AUTOHOME
    seeds = spark.createDataFrame(
        [(profile.site, 1, "second", "https://f/#again", None), (profile.site, 0, "first", "https://f/", None)], schemas.SEEDS
    )
    got = listing_job(pages_of(spark, profile, AUTOHOME_LIST), seeds, profile, ["违章"], AS_OF)
    assert [r.forum_name for r in got.threads.collect()] == ["first"]


def test_every_page_counts_unless_a_cap_is_set(spark):
    profile = profiles.TIEBA
    htmls = ["<p>x</p>"] * 300
    pages, seeds = pages_of(spark, profile, *htmls), seeds_of(spark, profile)
    assert listing_job(pages, seeds, profile, ["x"], AS_OF).stats.collect() == [("tieba", "f1", 300, 0, 0)]
    capped = replace(profile, listing=replace(profile.listing, page_cap=100))
    assert listing_job(pages, seeds, capped, ["x"], AS_OF).stats.collect() == [("tieba", "f1", 100, 0, 0)]
