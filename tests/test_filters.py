"""Predicates, validation and work-list filters on literal rows."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.functions.dates import instant, offset_date_ts
from threadloom.operators import filters
from threadloom.operators.validate import (
    LISTING_RULES,
    POST_RULES,
    QUOTED_POST_RULES,
    accepted,
    clean_validate,
    rejects,
)
from threadloom.plans.stages import run_stages, validation_stage

AS_OF = "2024-02-01 00:00:00"


@pytest.mark.parametrize(
    "keywords, literal, text, found",
    [
        (["违章", "Crash"], False, "CRASH report", True),
        (["über"], False, "ÜBER alles", True),
        (["a.c"], False, "abc", True),
        (["a.c"], True, "abc", False),
        (["a.c", "x\\E+"], True, "see A.C", True),
        (["x\\E+"], True, "X\\e+", True),
        (["# List of keywords"], False, "keywords", False),
        ([], False, "anything", True),
    ],
)
def test_keywords(spark, keywords, literal, text, found):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.filter(filters.matches_keyword(F.col("t"), keywords, literal)).count() == int(found)


@pytest.mark.parametrize(
    "title, date, status",
    [
        ("违章怎么办", None, "keep"),
        ("CRASH report", "2024-01-30T08:00:00+0800", "keep"),
        ("Crash", "2020-07-01T08:00:00+0800", "keep"),
        ("Crash", "2020-07-01T07:59:59+0800", "skip"),
        ("Crash", "2025-03-16T12:36:26+0800", "skip"),
        ("Crash", "2024-02-01T08:00:00+0800", "keep"),
        ("hello", None, "skip"),
        ("Crash", "invalid date", "Invalid thread_date"),
        ("", "invalid date", "skip"),
        (None, None, "skip"),
    ],
)
def test_link_status(spark, title, date, status):
    df = spark.createDataFrame([(title, date)], "t string, d string")
    pattern = filters.keyword_pattern(["违章", "Crash"])
    got = filters.link_status(
        F.col("t"), F.col("t"), F.col("d"), offset_date_ts(F.col("d")), pattern, "2020-07-01", instant(AS_OF)
    )
    assert df.select(got).first()[0] == status


POSTS = "thread_title string, thread_link string, date string, text string, position string"


@pytest.mark.parametrize(
    "row, reason",
    [
        (("abc", "u", "2024-05-01 10:30", "hello", " 3 楼"), None),
        ((None,) * 5, "Missing thread_title"),
        (("ab", "u", "2024-05-01 10:30", "hello", "1楼"), "Invalid thread_title"),
        (("abc", "", "junk", "hello", "1楼"), "Missing thread_link"),
        (("abc", "u", None, "hello", "1楼"), "Missing date"),
        (("abc", "u", "junk", "hello", "1楼"), "Invalid date"),
        (("abc", "u", "2024-05-01 10:30", None, "1楼"), "Missing text"),
        (("abc", "u", "2024-05-01 10:30", "<p></p>", "1楼"), "Invalid text"),
        (("abc", "u", "2024-05-01 10:30", "hello", ""), "Missing position"),
        (("abc", "u", "2024-05-01 10:30", "hello", "  "), "Invalid position"),
        (("abc", " ", "2024-05-01 14:00:00 UTC", "hello", "1楼"), None),
    ],
)
def test_post_rules(spark, row, reason):
    checked = clean_validate(spark.createDataFrame([row], POSTS), POST_RULES, "Asia/Shanghai")
    got = checked.first()
    assert got.reject_reason == reason
    if reason:
        assert tuple(got)[:5] == row
    elif row[4] == " 3 楼":
        assert tuple(got)[:5] == ("abc", "u", "2024-05-01 02:30:00 UTC", "hello", "3楼")
    assert accepted(checked).count() + rejects(checked).count() == 1


def test_listing_rules(spark):
    rows = [
        (" <b>Crash</b>  x", " u ", "2024-01-10T10:00:00-0400", " f ", " g "),
        ("Crash", "u", None, "f", "g"),
        ("Crash", "u", "2024-01-10T10:00:00-0400", "", "g"),
        ("Crash", "u", "2024-01-10T10:00:00-0400", "f", None),
    ]
    df = spark.createDataFrame(
        rows, "thread_title string, thread_link string, thread_date string, forum_name string, forum_url string"
    )
    got = clean_validate(df, LISTING_RULES).collect()
    assert tuple(got[0])[:5] == ("Crash x", "u", "2024-01-10 14:00:00 UTC", "f", "g")
    assert [r.reject_reason for r in got] == [None, "Missing thread_date", "Missing forum_name", "Missing forum_url"]


@pytest.mark.parametrize(
    "row, reason",
    [
        (('<div class="bbWrapper">line one<br>line two</div>', "# 1", "2024-05-01T10:00:00-0400"), None),
        (('<div class="bbWrapper">line one</div>', None, None), "Invalid text"),
        (("no wrapper here", "#1", None), "Invalid text"),
        ((None, "#1", None), "Missing text"),
        (('<div class="bbWrapper">0123456789</div>', None, ""), None),
        (('<div class="bbWrapper">0123456789</div>', " ", None), "Invalid position"),
        (('<div class="bbWrapper">0123456789</div>', "#1", "2024-05-01 10:00"), "Invalid date"),
    ],
)
def test_quoted_post_rules(spark, row, reason):
    df = spark.createDataFrame([row], "text string, position string, date string")
    assert clean_validate(df, QUOTED_POST_RULES).first().reject_reason == reason


def test_stages_run_by_priority_and_keep_earlier_reasons(spark):
    df = spark.createDataFrame([("abc", "u", "junk", "hello", "1楼")], POSTS)
    early = lambda d: d.withColumn("reject_reason", F.lit("Not wanted"))
    assert run_stages(df, {validation_stage(POST_RULES): 300, early: 100}).first().reject_reason == "Not wanted"
    assert run_stages(df, []).columns == df.columns


def test_usable_worklist_and_domains(spark):
    df = spark.createDataFrame([("a", "l"), ("", "l"), (None, "l"), ("a", None)], "thread_title string, thread_link string")
    assert filters.usable_worklist(df).count() == 1
    urls = ["https://a.com/x", "https://b.a.com", "https://xa.com", "https://a.com.evil.org", "/rel", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    ok = df.filter(filters.allowed_host(F.col("u"), ["A.com"]))
    assert [r.u for r in ok.collect()] == urls[:2]
    assert df.filter(filters.allowed_host(F.col("u"), [])).count() == 6


def test_first_per_link_on_a_hot_link_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "http://h/hot#%d" % i if rng.random() < 0.4 else "http://h/%d?b=1&a=%d" % (rng.randint(0, 99), i % 2))
            for i in range(5000)]
    rng.shuffle(rows)
    first = {}
    for i, link in sorted(rows):
        first.setdefault(link.split("#")[0], i)
    df = spark.createDataFrame(rows, "ord long, link string").repartition(7)
    kept = filters.first_per_link(df, "link", ["ord"])
    assert sorted(r.ord for r in kept.collect()) == sorted(first.values())
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()
