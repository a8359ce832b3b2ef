import gzip
import io
import zipfile

import pytest
from edges import LONG
from pyspark.sql import functions as F

from threadloom.llm import warc
from threadloom.llm.zip_directory import data_start, directory, filesystem, read_range
from threadloom.session import fresh_folder


class Sized(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def archive(entries, comment=b"", wide=False):
    made = Sized()
    with zipfile.ZipFile(made, "w", zipfile.ZIP_STORED) as z:
        for name, data in entries:
            with z.open(name, "w", force_zip64=wide) as member:
                member.write(data)
        z.comment = comment
    return made


@pytest.mark.parametrize("entries", [[], [("a", b"x")], [(f"dir/ü{i}", b"y" * i) for i in range(50)]])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 a comment that looks like an end"])
@pytest.mark.parametrize("wide", [False, True])
def test_directory(entries, comment, wide):
    file = archive(entries, comment, wide)
    found = directory(file)
    assert [m.name for m in found] == [n for n, _ in entries]
    for m, (_, data) in zip(found, entries):
        assert read_range(file, data_start(file, m), m.size) == data


def test_zip64_directory_of_many_members():
    entries = [(f"{i}", b"%d" % i) for i in range(66000)]
    file = archive(entries)
    found = directory(file)
    assert len(found) == 66000
    assert read_range(file, data_start(file, found[-1]), found[-1].size) == b"65999"


def test_zip64_places_are_taken_from_the_extra_field(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    file = archive([("a", b"x" * 300), ("b", b"y" * 300)], wide=True)
    assert [read_range(file, data_start(file, m), m.size) for m in directory(file)] == [b"x" * 300, b"y" * 300]


def test_broken_and_packed_archives():
    with pytest.raises(ValueError):
        directory(Sized(b"no archive at all"))
    made = Sized()
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    with pytest.raises(ValueError):
        data_start(made, directory(made)[0])


PAGES = [
    (5, "http://a/", "<p>same</p>"),
    (3, "http://b/\r\nx", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (3, "http://b/again", "<p>same</p>"),
    (4, "", None),
    (2, "u", ""),
    (7, "u", "é漢\r\n\r\n😀"),
    (8, "u", LONG),
    (None, "u", "<p>same</p>"),
]


def pages(spark, rows=PAGES):
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    return made.withColumns({n: F.lit("old") for n in ("payload_digest", "payload", "path", "refers_to")}).repartition(3)


def test_round_trip(spark):
    rows = warc.round_trip(spark, pages(spark)).collect()
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in rows), key=str)
    first = {"<p>same</p>": 3, "": 2}
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        least = first.get(html or "")
        revisit = page is not None and least is not None and page > least
        want.append((page or 0, "revisit" if revisit else "response", least if revisit else None, len(data), warc.digest(data)))
    assert got == sorted(want, key=str)
    whole = {r.page_id: bytes(r.payload) for r in rows if r.record_type == "response" and r.page_id is not None}
    assert whole == {3: b"<p>same</p>", 2: b"", 7: "é漢\r\n\r\n😀".encode(), 8: LONG.encode()}
    assert {r.url for r in rows if r.page_id == 3} == {"http://b/%0D%0Ax", "http://b/again"}


def test_empty_table_and_small_archives(spark, monkeypatch):
    assert warc.round_trip(spark, pages(spark).limit(0)).count() == 0


def test_least_payload_of_a_revisit(spark):
    narrow = warc.with_digest(pages(spark)).drop("refers_to")
    assert {r.page_id for r in warc.revisits(narrow, 1).collect()} == {5, 9}
    assert {r.page_id for r in warc.revisits(narrow, 0).collect()} == {5, 9, 4}


def test_archive_without_index(spark):
    folder = fresh_folder(spark, "plain")
    files, base = filesystem(folder)
    files.create_dir(base, recursive=True)
    record = [warc.warc_record(i, None, b"p%d" % i, warc.digest(b"p%d" % i), None) for i in range(3)]
    with files.open_output_stream(f"{base}/a.zip") as out:
        out.write(archive([("x.warc.gz", b"".join(gzip.compress(r) for r in record))]).getvalue())
    found = warc.read_records(warc.locate_records(spark.createDataFrame([(f"{folder}/a.zip",)], "path string")))
    assert sorted((r.page_id, bytes(r.payload)) for r in found.collect()) == [(i, b"p%d" % i) for i in range(3)]


def whole_archive(spark, entries):
    folder = fresh_folder(spark, "plain")
    files, base = filesystem(folder)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/a.zip") as out:
        out.write(archive(entries).getvalue())
    paths = spark.createDataFrame([(f"{folder}/a.zip",), (None,)], "path string")
    return sorted((r.page_id, bytes(r.payload)) for r in warc.read_records(warc.locate_records(paths)).collect())


def test_members_that_no_index_line_names_are_read_whole(spark):
    data = [warc.warc_record(i, None, b"p%d\r\n\r\n" % i, warc.digest(b"p%d\r\n\r\n" % i), None) for i in range(6)]
    packed = [gzip.compress(r) for r in data]
    line = b'com,a)/ 2024 {"filename": "x.warc.gz", "offset": "%d", "length": "%d"}\n' % (len(packed[0]), len(packed[1]))
    entries = [
        ("archive/x.warc.gz", packed[0] + packed[1]),
        ("archive/y.warc.gz", packed[2] + packed[3]),
        ("archive/z.warc", data[4] + data[5]),
        ("archive/empty.warc", b""),
        ("indexes/index.cdxj", line + b"\n"),
    ]
    # Of the first member one record is named, and only that one is read.
    assert whole_archive(spark, entries) == [(i, b"p%d\r\n\r\n" % i) for i in range(1, 6)]


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_records_across_pieces(size):
    data = [warc.warc_record(i, None, LONG[:n].encode(), warc.digest(LONG[:n].encode()), None) for i, n in enumerate((0, 5, 3000))]
    cut = lambda x: (x[i : i + size] for i in range(0, len(x), size))
    assert list(warc.plain_records(cut(b"".join(data)))) == data
    assert list(warc.packed_records(cut(b"".join(map(gzip.compress, data))))) == data
    for reader, whole in ((warc.plain_records, data[2]), (warc.packed_records, gzip.compress(data[2]))):
        with pytest.raises(ValueError):
            list(reader(cut(whole[:-20])))
