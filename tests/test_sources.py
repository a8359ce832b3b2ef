"""Readers and writers on files in fresh folders."""

import codecs
import csv
import io
import json
import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from threadloom.operators.filters import keyword_pattern
from threadloom.sources import readers, writers

STARTED = datetime(2025, 6, 4, 11, 32, 40)


def test_keywords_keep_the_comment_line(spark, tmp_path):
    path = tmp_path / "keywords.txt"
    path.write_text("# List of words\n违章\n\n  Turn left　\n\t\n如何处理", encoding="utf-8")
    df = readers.read_keywords(spark, str(path), "s")
    words = readers.keyword_list(df)
    assert words == ["# List of words", "违章", "Turn left", "如何处理"]
    assert keyword_pattern(words) == "(?iu)(?:# List of words|违章|Turn left|如何处理)"
    assert readers.keyword_list(readers.read_keywords(spark, str(path), skip_comments=True)) == words[1:]
    with pytest.raises(ValueError):
        readers.keyword_list(df, limit=5)


def test_seeds(spark, tmp_path):
    path = tmp_path / "start_urls.json"
    seeds = [{"name": "论坛", "url": "https://f/1#x", "description": "d"}, {"name": "B", "url": "https://f/2"}]
    path.write_text(json.dumps(seeds, ensure_ascii=False, indent=2), encoding="utf-8")
    rows = readers.read_seeds(spark, str(path), "s").orderBy("ord").collect()
    assert [(r.site, r.name, r.url, r.description) for r in rows] == [
        ("s", "论坛", "https://f/1#x", "d"), ("s", "B", "https://f/2", None)]
    with pytest.raises(FileNotFoundError, match="nowhere.json"):
        readers.read_seeds(spark, str(tmp_path / "nowhere.json"), "s")


def test_latest_output(spark, tmp_path):
    for age, name in ((30, "s_forum_threads_3.csv"), (10, "s_forum_threads_1.csv"), (0, "other_1.csv")):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1_700_000_000 - age, 1_700_000_000 - age))
    got = readers.latest_output(spark, f"{tmp_path}/s_forum_threads_*.csv")
    assert got.endswith("/s_forum_threads_1.csv")
    with pytest.raises(FileNotFoundError):
        readers.latest_output(spark, f"{tmp_path}/none_*.csv")


def test_worklist_charsets_headers_and_quoting(spark, tmp_path):
    body = 'post_title,post_link,post_date\n"违章 ""A"",\n第二行",https://f/{n},2天前\n,https://f/blank,\n'
    files = {
        "utf8.csv": body.format(n=1).encode("utf-8"),
        "bom.csv": codecs.BOM_UTF8 + body.format(n=2).encode("utf-8"),
        "gbk.csv": body.format(n=3).encode("gbk"),
        "utf16.csv": body.format(n=4).encode("utf-16"),
        "other.csv": "thread_link,extra,thread_title\nhttps://f/5,e,Title\n".encode("utf-8"),
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    charsets = {r.path.rsplit("/", 1)[1]: r.charset for r in readers.file_charsets(spark, str(tmp_path)).collect()}
    assert charsets == {"utf8.csv": "utf-8", "bom.csv": "utf-8", "gbk.csv": "gbk", "utf16.csv": "utf-16", "other.csv": "utf-8"}
    rows = readers.read_worklist(spark, str(tmp_path)).collect()
    good = {(r.thread_title, r.thread_link, r.thread_date) for r in rows if r.thread_title}
    assert good == {('违章 "A",\n第二行', f"https://f/{n}", "2天前") for n in (1, 2, 3, 4)} | {("Title", "https://f/5", None)}
    assert sum(r.thread_title is None for r in rows) == 4


def test_latest_committed_passes_over_unfinished_folders(spark, tmp_path):
    df = spark.createDataFrame([("a", "l", None)], "thread_title string, thread_link string, reject_reason string")
    first = writers.write_rows(df, str(tmp_path), "s", "forum_threads", STARTED)
    second = writers.write_checked(df, str(tmp_path), "s", "forum_threads", STARTED.replace(hour=1))
    third = writers.write_rows(df, str(tmp_path), "s", "forum_threads", STARTED.replace(hour=23), "csv")
    for age, folder in ((30, first), (10, second), (0, third)):
        os.utime(f"{folder}/_SUCCESS", (1_700_000_000 - age,) * 2)
    name = lambda: readers.latest_committed(spark, f"{tmp_path}/s_forum_threads_*").rsplit("/", 1)[1]
    assert name() == os.path.basename(third)
    os.remove(f"{third}/_SUCCESS")
    assert name() == os.path.basename(second)
    with pytest.raises(FileNotFoundError, match="no finished output"):
        readers.latest_committed(spark, f"{tmp_path}/none_*")


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _csv(rows, newline="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=newline).writerows(rows)
    return out.getvalue()


def test_worklist_rows_meet_across_every_seam(spark, tmp_path, small_splits):
    """One file cut at each of its bytes: breaks, quotes and commas inside quotes on both sides of a seam."""
    rows = [("a\n\nb", "l1", "x"), ('"', "l2", ""), ('\n"\n', "l3", ",\n"), ("违", "l4", "2天前"), ("", "l5", '""\n"')]
    names = ("post_title", "post_link", "post_date")
    (tmp_path / "one.csv").write_bytes(_csv([names, *rows]).encode("utf-8"))
    want = [tuple(v or None for v in r) for r in rows]
    size = (tmp_path / "one.csv").stat().st_size
    for cut in range(5, size, 11):
        small_splits(cut)
        got = readers.read_worklist(spark, str(tmp_path), fmt="csv").orderBy("ord").collect()
        assert [(r.thread_title, r.thread_link, r.thread_date) for r in got] == want, cut


@pytest.mark.parametrize("charset", ["utf-8", "gbk"])
def test_worklist_split_small_equals_the_csv_module(spark, tmp_path, small_splits, charset):
    rnd = random.Random(7)
    want = set()
    for f in range(4):
        alphabet = ['"', ",", "\n", "a", " ", "违章", "，"]
        rows = [("".join(rnd.choices(alphabet, k=rnd.randint(0, 9))), f"https://f/{f}/{i}") for i in range(60)]
        names = ("thread_title", "thread_link") if f % 2 else ("Post_Link", "post_title")
        laid = [r if f % 2 else r[::-1] for r in rows]
        (tmp_path / f"{f}.csv").write_bytes(_csv([names, *laid], "\r\n" if f == 1 else "\n").encode(charset))
        want |= {(title or None, link) for title, link in rows}
    for size in (64, 301):
        small_splits(size)
        got = readers.read_worklist(spark, str(tmp_path), fmt="csv").collect()
        assert len(got) == 240 and {(r.thread_title, r.thread_link) for r in got} == want


def test_worklist_odd_files(spark, tmp_path):
    """Stray quotes inside a field, an unclosed one, rows too short and too long, blank lines, bytes of no charset."""
    (tmp_path / "odd.csv").write_bytes(
        b'\n\nthread_link,thread_title\nl1,5" screen\n\nl2\nl3,t,more,"x\ny"\nl4,\xff\xc4\nl5,"open,\n\nl6,x\n'
    )
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "head.csv").write_bytes(b"thread_link\n")
    got = readers.read_worklist(spark, str(tmp_path)).orderBy("ord").collect()
    assert [r.thread_link for r in got] == ["l1", "l2", "l3", "l4", "l5"]
    assert [r.thread_title for r in got][:3] == ['5" screen', None, "t"]
    assert "\ufffd" in got[3].thread_title and got[4].thread_title.startswith("open,\n\nl6,x")
    (tmp_path / "bad.csv").write_bytes(b"title,link\na,b\n")
    with pytest.raises(ValueError, match="no thread_link or post_link"):
        readers.read_worklist(spark, str(tmp_path))


def test_output_names_and_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(' a "q",\nb ', None), ("违章", "x")], "thread_title string, thread_link string")
    path = writers.write_rows(df, str(tmp_path), "tieba", "forum_threads", STARTED, "csv")
    assert path.endswith("/tieba_forum_threads_20250604_113240")
    back = readers.read_worklist(spark, path)
    assert {(r.thread_title, r.thread_link) for r in back.collect()} == {(' a "q",\nb ', None), ("违章", "x")}
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        writers.write_rows(df, str(tmp_path), "tieba", "forum_threads", STARTED, "csv")
    parquet = writers.write_rows(df, str(tmp_path), "tieba", "content", STARTED)
    assert spark.read.parquet(parquet).count() == 2


def test_checked_rows_are_split_in_one_write(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", "Missing text"), ("c", None)], "x string, reject_reason string")
    path = writers.write_checked(df, str(tmp_path), "s", "content", STARTED)
    back = spark.read.parquet(path)
    assert {(r.x, r.accepted) for r in back.collect()} == {("a", "true"), ("b", "false"), ("c", "true")}
    assert back.filter("accepted = true").count() == 2


def test_page_files(spark, tmp_path):
    for n in (1, 12):
        (tmp_path / f"page_{n}.html").write_text(f"<p>违{n}</p>", encoding="utf-8")
    pages = readers.read_page_files(spark, f"{tmp_path}/*.html", "s", "https://f/")
    assert {(r.seed_url, r.page_no, r.html) for r in pages.collect()} == {
        ("https://f/", 1, "<p>违1</p>"), ("https://f/", 12, "<p>违12</p>")}
    assert pages.filter(F.col("url").contains("page_12")).count() == 1
