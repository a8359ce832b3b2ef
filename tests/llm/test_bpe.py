import random

import public_tokenizers
import pytest
import tiktoken
from edges import ROWS, edge_docs, empty_docs

from threadloom.llm import bpe
from threadloom.llm.queries import RANKS

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_the_library_and_round_trips(spark, library):
    apart = bpe.decode(bpe.encode(edge_docs(spark), RANKS, PATTERN), RANKS).collect()
    together = bpe.encode_decode(edge_docs(spark), RANKS, PATTERN).collect()
    assert len(apart) == len(together) == len(ROWS)
    for r in apart + together:
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.key == "old" and r.score == "old"


def test_empty_table(spark):
    made = bpe.decode(bpe.encode(empty_docs(spark), RANKS, PATTERN), RANKS)
    assert made.count() == 0 and {"ids", "decoded"} <= set(made.columns)
    both = bpe.encode_decode(empty_docs(spark), RANKS, PATTERN)
    assert both.count() == 0 and both.schema == made.schema


def test_replay_of_many_pieces(ranks, library):
    rnd = random.Random(3)
    pieces = ["".join(rnd.choice("aethions .,é中1") for _ in range(rnd.randint(0, 12))) for _ in range(20000)]
    pieces += ["a" * n for n in (1, 2, 3, 500, 4001)] + ["the" * 900, " " * 700]
    replay = bpe.Replay(ranks)
    made = replay.encode(p.encode() for p in pieces)
    for piece, ids in zip(pieces, made):
        assert ids.tolist() == library._core_bpe.encode_single_piece(piece.encode()) if piece else not len(ids)


def test_a_merge_that_gives_a_lower_rank_comes_next():
    letters = {bytes([b]): 1000 + b for b in range(256)}
    ranks = letters | {b"cd": 50, b"bcd": 40, b"ab": 60, b"aa": 45, b"aaa": 30}
    library = tiktoken.Encoding("low", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    replay = bpe.Replay(ranks)
    texts = ["abcd", "abcdabcd", "aaaa", "aaaaa", "aaaaaaab", "cdcdab"] * 30
    assert [x.tolist() for x in replay.encode(t.encode() for t in texts)] == [library.encode_ordinary(t) for t in texts]
