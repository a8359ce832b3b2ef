import random

import pytest
from edges import edge_docs, empty_docs

from threadloom.llm import decontaminate as D

RND = random.Random(8)
COMMON = ["the", "of", "and", "to", "in", "a", "is"]
WORDS = ["".join(RND.choices("abcdefghiklmnoprstuvw", k=RND.randint(3, 9))) for _ in range(3000)]


def prose(n):
    return [RND.choice(COMMON if RND.random() < 0.3 else WORDS) for _ in range(n)]


ITEMS = [prose(RND.choice([18, 40, 59, 150])) for _ in range(30)]


def planted():
    """(text, items in it): clean, exact, other case and marks, reworded, and only a few words."""
    rows = []
    for i, item in enumerate(ITEMS):
        around = lambda x: " ".join([*prose(RND.randint(0, 300)), *x, *prose(RND.randint(0, 300))])
        rows += [(around([]), set()), (around(item), {i}), (around([f"{w.upper()}," for w in item]), {i})]
        reworded = [w if RND.random() < 0.85 else RND.choice(WORDS) for w in item]
        rows += [(around(reworded), {i}), (around(item[: len(item) // 5]), set())]
    return rows


@pytest.mark.parametrize("block_items", [D.BLOCK_ITEMS, 10])
def test_planted_passages(spark, monkeypatch, block_items):
    monkeypatch.setattr(D, "BLOCK_ITEMS", block_items)
    rows = planted()
    docs = edge_docs(spark, [(i, t, "en", 0) for i, (t, _) in enumerate(rows)])
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(ITEMS)] + [(90, None), (91, ""), (92, "?")], "item_id long, text string")
    found = D.mark(docs, items, D.fit(docs, items)).collect()
    assert len(found) == len(rows) and all(r.score == "old" for r in found)
    got = {r.doc_id: {m.item for m in r.matches} for r in found}
    wrong = [i for i, (_, want) in enumerate(rows) if got[i] != want]
    assert not [i for i in wrong if i % 5 != 3], wrong
    assert len(wrong) <= 1


def test_short_last_sentence_cut_or_changed(spark):
    bodies = [prose(40) for _ in range(12)]
    ends = [["answer"], ["short", "end"], ["one", "of", "five", "words", "here"]]
    items, rows = [], []
    for i, body in enumerate(bodies):
        items.append((i, f"{' '.join(body)}. {' '.join(ends[i % 3])}."))
        for end in ([], ["changed"]):
            rows.append((" ".join([*prose(120), *body, *end, *prose(120)]), i))
    docs = edge_docs(spark, [(i, t, "en", 0) for i, (t, _) in enumerate(rows)])
    table = spark.createDataFrame(items, "item_id long, text string")
    found = D.mark(docs, table, D.fit(docs, table)).collect()
    assert {r.doc_id: [m.item for m in r.matches] for r in found} == {i: [item] for i, (_, item) in enumerate(rows)}
    assert all(m.answer_share is None for r in found for m in r.matches)


def test_named_answers_and_the_window_that_holds_them(spark):
    # The first passage holds more of the item, only the second one its answer.
    body, answer = prose(64), ["tungsten", "lamps"]
    first, second = [*body, "paper", "bags"], [*body[:52], *prose(12), *answer]
    texts = [[*first, *prose(600), *second], first, [*body, *answer]]
    docs = edge_docs(spark, [(i, " ".join(t), "en", 0) for i, t in enumerate(texts)])
    names = "item_id long, text string, answer string"
    items = spark.createDataFrame([(1, " ".join([*body, *answer]), " ".join(answer)), (2, " ".join([*body, *answer]), None), (3, " ".join(body), "?")], names)
    found = D.mark(docs, items, D.fit(docs, items), answer="answer").collect()
    assert {r.doc_id: sorted(m.item for m in r.matches) for r in found} == {0: [1, 2, 3], 1: [2, 3], 2: [1, 2, 3]}


def test_edges(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(1, "Plain words stand here. And more of them follow!"), (None, "No id")], "item_id long, text string")
    latent = D.fit(docs, items)
    got = {(r.doc_id, tuple(m.item for m in r.matches)) for r in D.mark(docs, items, latent).collect()}
    assert (1, (1,)) in got and (2, ()) in got and (5, ()) in got
    nothing = items.limit(0)
    assert all(not r.matches for r in D.mark(docs, nothing, D.fit(docs, nothing)).collect())
    assert D.mark(empty_docs(spark), items, D.fit(empty_docs(spark), items)).count() == 0


def test_common_subsequence():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row, last = [0], row
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(row[-1], last[j + 1]))
        return row[-1]

    for _ in range(200):
        a, b = (RND.choices("abcd", k=RND.randint(1, 40)) for _ in "ab")
        assert D.common(a, b) == plain(a, b)
