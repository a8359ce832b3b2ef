"""Byte-level BPE by corpus-level merge replay, and the way back.

A task gathers the distinct pieces of a block of texts, lays their symbols out one after the other
and keeps an inverted index from each mergeable pair to its positions. Ranks are replayed from the
lowest on, for all pieces at once; a merge looks at the two new neighbour pairs only. No shuffle is
needed, as a piece is encoded alike wherever it stands.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField

from threadloom.llm.arrow import add_columns, lists

#: Encoded pieces that a task remembers, and the longest it remembers; neither changes a result.
CACHE_PIECES = 60_000
CACHE_CHARS = 64
#: Bytes of text encoded, and ids decoded, at once.
BLOCK, BLOCK_IDS = 2 << 20, 1 << 17
SHIFT = 20
#: Posting lists of at least this length are merged as arrays, shorter ones one by one.
LONG_LIST = 24


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank from a rank file: one base64 token and one number a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class Replay:
    """Encodes sets of pieces by replaying the merges of a rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.merged = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.merged[left << SHIFT | right] = rank
        self.keys = np.array(sorted(self.merged), np.int64)
        self.ranks = np.array([self.merged[k] for k in self.keys.tolist()], np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it does not merge."""
        if not len(self.keys):
            return np.full(len(left), -1, np.int32)
        pair = left.astype(np.int64) << SHIFT | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], -1).astype(np.int32)

    def encode(self, pieces: Iterable[bytes]) -> list[np.ndarray]:
        """Token ids of each piece; a piece that is a token itself is that token."""
        pieces = list(pieces)
        whole = {i: rank for i, p in enumerate(pieces) if (rank := self.tokens.get(p)) is not None}
        if whole:
            rest = iter(self.encode(p for i, p in enumerate(pieces) if i not in whole))
            return [np.array([whole[i]], np.int32) if i in whole else next(rest) for i in range(len(pieces))]
        ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
        text = np.frombuffer(b"".join(pieces), np.uint8)
        if not len(text):
            return [np.zeros(0, np.int32) for _ in pieces]
        replay = _Block(self, self.byte_ids[text], ends)
        replay.run()
        left = replay.symbol >= 0
        ids = replay.symbol[left]
        cuts = np.concatenate([[0], np.cumsum(left)])[np.concatenate([[0], ends])].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


class _Block:
    """The symbols of many pieces, their links, and the index from pair rank to positions.

    Numbers lie in arrays that Python reads one by one and numpy as a whole. Pending ranks lie in
    a heap, because a merge may give a pair of lower rank; what is left of the present rank then
    waits, so each piece sees the order of a replay of its own.
    """

    def __init__(self, table: Replay, symbols: np.ndarray, ends: np.ndarray):
        size = len(symbols)
        self.table = table
        self.at_symbol = array("i", symbols.tobytes())
        self.at_next = array("i", np.arange(1, size + 1, dtype=np.int32).tobytes())
        self.at_before = array("i", np.arange(-1, size - 1, dtype=np.int32).tobytes())
        self.at_rank = array("i", bytes(4 * size))
        self.symbol, self.next, self.before, self.rank = (
            np.frombuffer(x, np.int32) for x in (self.at_symbol, self.at_next, self.at_before, self.at_rank)
        )
        self.next[ends[ends > 0] - 1] = -1
        self.before[ends[ends < size]] = -1
        self.before[0] = -1
        self.rank[:-1] = table.rank_of(symbols[:-1], symbols[1:])
        self.rank[self.next < 0] = -1
        self.index: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        self.heap: list[int] = []
        self.add(np.flatnonzero(self.rank >= 0))

    def add(self, positions: np.ndarray) -> None:
        """Index positions by the ranks of their pairs."""
        if not len(positions):
            return
        ranks = self.rank[positions]
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for rank, a, b in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)]):
            self.postings(rank)[1].append(positions[a:b])

    def postings(self, rank: int) -> tuple[list[int], list[np.ndarray]]:
        """Positions of a rank, one by one and in arrays."""
        found = self.index.get(rank)
        if found is None:
            found = self.index[rank] = [], []
            heapq.heappush(self.heap, rank)
        return found

    def run(self) -> None:
        while self.heap:
            rank = heapq.heappop(self.heap)
            one, many = self.index.pop(rank)
            if not many and len(one) < LONG_LIST:
                self.merge_each(rank, sorted(one))
                continue
            positions = many[0] if len(many) == 1 and not one else np.unique(np.concatenate([one, *many]).astype(np.int32))
            if len(positions) < LONG_LIST or not self.merge_all(rank, positions):
                self.merge_each(rank, positions.tolist())

    def merge_all(self, rank: int, positions: np.ndarray) -> bool:
        """Merge all positions of a rank; no (and nothing done) where their order matters."""
        at = positions[self.rank[positions] == rank]
        right = self.next[at]
        if np.any(right[:-1] == at[1:]):
            return False
        after, before = self.next[right], self.before[at]
        behind, ahead = at[after >= 0], at[before >= 0]
        merged = np.full(len(at), rank, np.int32)
        new = self.table.rank_of(merged[: len(behind)], self.symbol[after[after >= 0]])
        old = self.table.rank_of(self.symbol[before[before >= 0]], merged[: len(ahead)])
        if np.any((new >= 0) & (new < rank)) or np.any((old >= 0) & (old < rank)):
            return False
        self.symbol[at], self.symbol[right] = rank, -1
        self.next[at] = after
        self.before[after[after >= 0]] = behind
        self.rank[at] = self.rank[right] = -1
        # Two merges side by side share the pair between them, so look at symbols once more.
        touched = np.unique(np.concatenate([at, before[before >= 0]]))
        touched = touched[(self.symbol[touched] >= 0)]
        touched = touched[self.next[touched] >= 0]
        self.rank[touched] = self.table.rank_of(self.symbol[touched], self.symbol[self.next[touched]])
        self.add(touched[self.rank[touched] >= 0])
        return True

    def merge_each(self, rank: int, positions: list[int]) -> None:
        symbol, following, preceding, ranks = self.at_symbol, self.at_next, self.at_before, self.at_rank
        merged = self.table.merged
        for done, at in enumerate(positions, 1):
            if ranks[at] != rank:
                continue
            right = following[at]
            symbol[at], symbol[right] = rank, -1
            after, before = following[right], preceding[at]
            following[at] = after
            ranks[at] = ranks[right] = -1
            lower = False
            if after >= 0:
                preceding[after] = at
                new = merged.get(rank << SHIFT | symbol[after])
                if new is not None:
                    ranks[at] = new
                    self.postings(new)[0].append(at)
                    lower |= new < rank
            if before >= 0:
                new = merged.get(symbol[before] << SHIFT | rank)
                ranks[before] = -1 if new is None else new
                if new is not None:
                    self.postings(new)[0].append(before)
                    lower |= new < rank
            if lower and done < len(positions):
                self.postings(rank)[0].extend(positions[done:])
                return


Block = Callable[[pa.Array], pa.Array]


def encoder(ranks: dict[bytes, int], pattern: str) -> Block:
    """A function from a block of texts to their token ids, which remembers the pieces it has met."""
    import regex

    find = regex.compile(pattern).findall
    replay = Replay(ranks)
    known: dict[str, bytes] = {}
    older: dict[str, bytes] = {}

    def block(values: pa.Array) -> pa.Array:
        nonlocal known, older
        found = [find(t) if t else [] for t in values.to_pylist()]
        pieces = set().union(*found)
        if len(known) > CACHE_PIECES:
            known, older = {}, known
        new = pieces.difference(known)
        again = new.intersection(older)
        known.update((p, older[p]) for p in again)
        new = list(new - again)
        known.update(zip(new, (x.tobytes() for x in replay.encode([p.encode() for p in new]))))
        parts = [b"".join(map(known.__getitem__, words)) for words in found]
        for piece in new:
            if len(piece) > CACHE_CHARS:
                del known[piece]
        lengths = np.array([len(p) // 4 for p in parts], np.int64)
        return lists(np.frombuffer(b"".join(parts), np.int32), lengths)

    return block


def decoder(ranks: dict[bytes, int]) -> Block:
    """A function from a block of id lists to the bytes that they stand for."""
    pieces: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    tokens = pa.array(pieces, pa.binary())

    def block(values: pa.Array) -> pa.Array:
        # Tokens taken one after the other lie as one run of bytes: the texts are cut from it by offsets.
        taken = tokens.take(values.flatten())
        if taken.null_count:
            raise ValueError("an id is no token")
        cuts = np.concatenate([[0], np.cumsum(values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        _, starts, data = taken.buffers()
        starts = np.frombuffer(starts, np.int32)[cuts] if len(taken) else np.zeros(len(cuts), np.int32)
        offsets = pa.py_buffer(np.ascontiguousarray(starts, np.int32))
        return pa.Array.from_buffers(pa.binary(), len(values), [None, offsets, data or pa.py_buffer(b"")])

    return block


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text in ``ids`` (array of int).

    Every match of ``pattern`` is encoded by itself; there are no special tokens. A null or empty
    text gives an empty list, a repeated row the same ids again, and a column of the name ``ids``
    is replaced. The rank file must lie at ``ranks_path`` on every executor.
    """

    def make():
        block = encoder(read_ranks(ranks_path), pattern)
        return lambda values: [block(values)]

    return add_columns(docs, text, [StructField(ids, ArrayType(IntegerType(), True))], make, BLOCK)


def decode(docs: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that the ids stand for in ``out`` (binary); null ids give no bytes."""

    def make():
        block = decoder(read_ranks(ranks_path))
        return lambda values: [block(values)]

    return add_columns(docs, ids, [StructField(out, BinaryType())], make, BLOCK_IDS)


def encode_decode(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """``docs`` with the columns of ``encode`` and ``decode``, both made in one task.

    One Python process a task holds one rank table, where the two calls in a row take two of each
    and send the ids there and back.
    """

    def make():
        ranks = read_ranks(ranks_path)
        forth, back = encoder(ranks, pattern), decoder(ranks)

        def both(values: pa.Array) -> list[pa.Array]:
            made = forth(values)
            return [made, back(made)]

        return both

    fields = [StructField(ids, ArrayType(IntegerType(), True)), StructField(out, BinaryType())]
    return add_columns(docs, text, fields, make, BLOCK)
