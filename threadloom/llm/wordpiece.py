"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary is a trie with two roots, for the first piece of a word and for those that follow. Each
node knows where to go on when no edge fits (its failure link) and how many pieces that step
takes off the word, counted beforehand. The first root fails to the second, so a word that begins with
no word-initial piece is split into continuing ones. One walk over the bytes of a word then gives the number of
its pieces, which are never built.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from threadloom.llm.arrow import add_columns, raw

#: A word is a run of letters, digits and bytes beyond ASCII, or one other visible character.
WORD = rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]"
CACHE_WORDS = 1_000_000
CACHE_BYTES = 64
NONE = -1


class Automaton:
    """Piece counts for words over ``first`` (word-initial) and ``later`` (continuing) pieces."""

    def __init__(self, first: Iterable[bytes], later: Iterable[bytes]):
        self.edges: list[dict[int, int]] = [{}, {}]
        piece = [False, False]
        for root, pieces in ((0, first), (1, later)):
            for p in pieces:
                node = root
                for b in p:
                    to = self.edges[node].get(b)
                    if to is None:
                        to = self.edges[node][b] = len(self.edges)
                        self.edges.append({})
                        piece.append(False)
                    node = to
                if p:
                    piece[node] = True
        self.fail = [NONE] * len(piece)
        self.pops = [0] * len(piece)
        # A word that no word-initial piece begins, as in unspaced scripts, begins with a continuing one.
        self.fail[0] = 1
        queue = deque([0, 1])
        while queue:
            parent = queue.popleft()
            for b, node in self.edges[parent].items():
                queue.append(node)
                if piece[node]:
                    self.fail[node], self.pops[node] = 1, 1
                    continue
                at, popped = self.fail[parent], self.pops[parent]
                while at != NONE and b not in self.edges[at]:
                    popped += self.pops[at]
                    at = self.fail[at]
                if at != NONE:
                    self.fail[node], self.pops[node] = self.edges[at][b], popped

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest-match split; 1, the unknown piece, where there is none."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node = n = 0
        for b in word:
            while b not in edges[node]:
                if fail[node] == NONE:
                    return 1
                n += pops[node]
                node = fail[node]
            node = edges[node][b]
        while node != 1:
            if fail[node] == NONE:
                return 1
            n += pops[node]
            node = fail[node]
        return n


def split_vocabulary(tokens: Iterable[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Word-initial pieces (tokens after a space) and continuing ones (all others)."""
    tokens = list(tokens)
    return [t[1:] for t in tokens if t[:1] == b" " and len(t) > 1], [t for t in tokens if t[:1] != b" "]


def token_counts(
    docs: DataFrame, read_tokens, text: str = "text", words: str = "n_words", tokens: str = "n_tokens"
) -> DataFrame:
    """``docs`` with the number of words and of word pieces of each whole text (long).

    ``read_tokens`` is called in each task and returns the two piece lists. Null and empty texts count
    0; a word without a split counts one unknown piece; words may have any length. Columns of the two
    new names are replaced.
    """

    def make():
        count = Automaton(*read_tokens()).count
        find = re.compile(WORD).findall
        known: dict[bytes, int] = {}

        def block(values: pa.Array) -> list[pa.Array]:
            nonlocal known
            found = [find(t) for t in raw(values)]
            distinct = set().union(*found)
            if len(known) + len(distinct) > CACHE_WORDS:
                known = {}
            new = distinct.difference(known)
            known.update((w, count(w)) for w in new)
            sums = [sum(map(known.__getitem__, ws)) for ws in found]
            for w in new:
                if len(w) > CACHE_BYTES:
                    del known[w]
            return [pa.array(np.array([len(ws) for ws in found], np.int64)), pa.array(np.array(sums, np.int64))]

        return block

    return add_columns(docs, text, [StructField(words, LongType()), StructField(tokens, LongType())], make)
