import random
import re

from edges import edge_docs, empty_docs

from threadloom.llm import wordpiece
from threadloom.llm.queries import rank_pieces


def greedy(word, first, later):
    n = at = 0
    longest = lambda at, known: next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
    while at < len(word):
        # Where no word-initial piece fits, the word begins with a continuing one.
        end = longest(at, later if at else first) or longest(at, later)
        if end is None:
            return 1
        n, at = n + 1, end
    return n


def test_automaton_equals_the_greedy_search():
    rnd = random.Random(5)
    for _ in range(60):
        letters = b"abcd"
        pieces = lambda n: {bytes(rnd.choices(letters, k=rnd.randint(1, 5))) for _ in range(n)}
        first, later = pieces(8), pieces(8)
        automaton = wordpiece.Automaton(first, later)
        for _ in range(200):
            word = bytes(rnd.choices(letters + b"x", k=rnd.randint(1, 12)))
            assert automaton.count(word) == greedy(word, first, later), (first, later, word)


def test_counts_of_whole_texts(spark):
    first, later = (set(x) for x in rank_pieces())
    for r in wordpiece.token_counts(edge_docs(spark), rank_pieces).collect():
        words = re.findall(wordpiece.WORD, (r.text or "").encode())
        assert (r.n_words, r.n_tokens) == (len(words), sum(greedy(w, first, later) for w in words))
        assert r.ids == "old"
    assert wordpiece.token_counts(empty_docs(spark), rank_pieces).count() == 0


def test_unspaced_scripts_are_split_whatever_their_first_character(spark):
    texts = ["한국어문장입니다", "中国的大学里有很多学生在学习", "这是一个没有空格"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    first, later = (set(x) for x in rank_pieces())
    for r in wordpiece.token_counts(docs, rank_pieces).collect():
        assert r.n_words == 1 and r.n_tokens == greedy(r.text.encode(), first, later) > len(r.text) / 2
