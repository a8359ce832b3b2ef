import random
import re
from collections import Counter

import pytest
from edges import edge_docs, empty_docs

from threadloom.llm import substring_dedup as S


def plain(texts, window):
    """(words, removed) of each text by counting every window."""
    split = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
    starts = lambda words: range(len(words) - window + 1)
    seen = Counter(tuple(w[i : i + window]) for w in split for i in starts(w))
    made = []
    for words in split:
        gone = set()
        for i in starts(words):
            if seen[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        made.append((words, gone))
    return made


def corpus(seed, words=12):
    rnd = random.Random(seed)
    some = lambda n: [rnd.choice("a b cé d x e f g h i j".split(" ")[:words]) for _ in range(n)]
    parts = [some(n) for n in (5, 17, 34, 35, 36, 80, 200)]
    texts = []
    for _ in range(60):
        made = []
        for _ in range(rnd.randint(0, 5)):
            made += some(rnd.randint(0, 40)) if rnd.random() < 0.6 else rnd.choice(parts)
        texts.append("".join(w + rnd.choice([" ", "  ", "\n", "\t\x0b"]) for w in made))
    return texts + ["z " * 36, "z " * 35, "q " * 34, "ab cd " * 100, texts[3], "", None]


@pytest.mark.parametrize("window, first, block, shard", [(35, 12, 4 << 20, 1 << 20), (35, 4, 600, 300), (7, 2, 200, 100), (1, 1, 900, 40)])
def test_equals_counting(spark, window, first, block, shard):
    texts = corpus(window)
    docs = edge_docs(spark, [(i, t, "en", 0) for i, t in enumerate(texts)])
    rows = {r.doc_id: r for r in S.deduplicate(docs, window, first=first, block_bytes=block, shard_words=shard).collect()}
    assert len(rows) == len(texts)
    removed = 0
    for i, (words, gone) in enumerate(plain(texts, window)):
        got = {w for s in rows[i].spans for w in range(s.start, s.end)}
        assert got == gone and rows[i].n_words == len(words), i
        assert rows[i].kept == " ".join(w for k, w in enumerate(words) if k not in gone)
        assert rows[i].score == "old" and rows[i].lang == "en"
        removed += len(gone)
    assert removed > 300


def test_lengths():
    assert S.lengths_up_to(35) == [9, 18, 35] and S.lengths_up_to(1) == [1] and S.lengths_up_to(12) == [12]
    assert all(b <= 2 * a for n in range(1, 99) for a, b in zip(S.lengths_up_to(n, 1), S.lengths_up_to(n, 1)[1:]))


def test_edges(spark):
    rows = S.deduplicate(edge_docs(spark)).collect()
    assert len(rows) == edge_docs(spark).count() and "text" not in S.deduplicate(edge_docs(spark)).columns
    by = {r.doc_id: r for r in rows}
    for none in (2, 3, 4):
        assert by[none].n_words == 0 and by[none].spans == [] and by[none].kept == ""
    # One sentence over and over: all of it occurs again.
    assert by[5].kept == "" and by[5].n_words == 40000 and [tuple(s) for s in by[5].spans] == [(0, 40000)]
    assert by[6].kept == "ünïcödé 漢字 😀 don't stop x" and by[None].spans == []
    assert S.deduplicate(empty_docs(spark)).count() == 0


def test_repeated_rows_are_copies(spark):
    text = " ".join(f"w{i}" for i in range(35))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text[:-1])], "doc_id long, text string")
    rows = S.deduplicate(docs).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == ["", "", text[:-1]]
