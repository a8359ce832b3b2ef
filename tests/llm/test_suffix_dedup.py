import random

import numpy as np
import pytest
from edges import edge_docs, empty_docs

from threadloom.llm import suffix_dedup as S


def plain(docs):
    """Removed runs of each text, in the order given."""
    seen, made = set(), []
    for data in docs:
        gone = bytearray(len(data))
        for p in range(len(data) - S.MATCH + 1):
            if data[p : p + S.MATCH] in seen:
                gone[p : p + S.MATCH] = b"\1" * S.MATCH
            seen.add(data[p : p + S.MATCH])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(gone), np.uint8), [0]])))
        made.append([tuple(x) for x in edges.reshape(-1, 2).tolist()])
    return made


def corpus(seed=6):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choices("abcdefg hij é", k=n))
    parts = [text(n) for n in (60, 99, 100, 101, 150, 400)]
    made = []
    for _ in range(60):
        made.append("".join(rnd.choice([text(rnd.randint(0, 120)), rnd.choice(parts)]) for _ in range(rnd.randint(0, 6))))
    return made + ["z" * 500, "z" * 250, "ab" * 200, made[3], ""]


@pytest.mark.parametrize("hot", [1, 3, S.HOT_ANCHOR])
def test_equals_plain_removal(spark, hot):
    texts = corpus()
    docs = edge_docs(spark, [(i, t, "en", 0) for i, t in enumerate(texts)])
    rows = {r.doc_id: r for r in S.deduplicate(docs, hot_anchor=hot).collect()}
    want = plain([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert [tuple(s) for s in rows[i].spans] == want[i], i
        data, rest = text.encode(), bytearray()
        at = 0
        for a, b in want[i]:
            rest += data[at:a]
            at = b
        assert bytes(rows[i].kept) == bytes(rest + data[at:]) and rows[i].score == "old"
    assert sum(map(len, want)) > 40


def test_edges(spark):
    rows = S.deduplicate(edge_docs(spark)).collect()
    assert len(rows) == edge_docs(spark).count()
    by = {r.doc_id: r for r in rows}
    assert by[2].spans == [] and bytes(by[2].kept) == b"" and bytes(by[3].kept) == b""
    # A text of one repeated byte keeps its first string only.
    assert [tuple(s) for s in by[7].spans] == [(1, 3000)]
    # A repeated row is the same document, not a copy.
    assert by[1].spans == [] and S.deduplicate(empty_docs(spark)).count() == 0


def test_null_ids_come_first(spark):
    text = "0123456789" * 9 + "".join(random.Random(1).choices("qrstuv", k=60))
    rows = S.deduplicate(spark.createDataFrame([(1, text), (None, text)], "doc_id long, text string")).collect()
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in rows} == {None: [], 1: [(0, 150)]}


def test_refined_buckets_are_equal_strings():
    rnd = random.Random(2)
    part = bytes(rnd.choices(b"abc", k=130))
    data = b"".join(part if rnd.random() < 0.5 else bytes(rnd.choices(b"abc", k=90)) for _ in range(20))
    shared, pointer = S.refine(np.frombuffer(data, np.uint8))
    strings = {}
    for p in range(len(data) - S.MATCH + 1):
        strings.setdefault(data[p : p + S.MATCH], []).append(p)
    got = {}
    for p, b in zip(shared.tolist(), pointer.tolist()):
        if p + S.MATCH <= len(data):
            got.setdefault(b, []).append(p)
    assert sorted(v for v in got.values() if len(v) > 1) == sorted(v for v in strings.values() if len(v) > 1)


@pytest.mark.parametrize("hot", [1, S.HOT_ANCHOR])
def test_rows_that_repeat_id_and_text_cost_no_more_than_rows(spark, hot):
    rnd = random.Random(7)
    text = "".join(rnd.choices("abcdefgh", k=3000))
    same = spark.range(1500).selectExpr("1L AS doc_id", f"'{text}' AS text")
    docs = same.unionByName(spark.createDataFrame([(2, text[500:900])], "doc_id long, text string"))
    rows = S.deduplicate(docs, hot_anchor=hot).groupBy("doc_id", "spans").count().collect()
    assert sorted((r.doc_id, [tuple(x) for x in r.spans], r["count"]) for r in rows) == [(1, [], 1500), (2, [(0, 400)], 1)]
