"""Removal of word sequences that occur more than once, by level-wise doubling of repeated windows.

Texts lie packed in blocks. At the first length every window of a block goes to the shard that its hash
names, once a block; the shard answers with one bit an entry, set where several blocks sent it. Windows
repeated at one length alone, the one at a position and the one that ends the doubled window, make a candidate
of twice the length. Short lengths compare 32 bits inside a shard, as a chance hit only keeps a candidate alive;
the last length compares 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from threadloom.llm.arrow import blocks, quoted, without
from threadloom.session import stored

#: Words of a window, and the longest first length; lengths in between are halves, rounded up.
WINDOW, FIRST = 35, 12
#: Bytes of text in a block, words that a shard answers for, blocks in a task. None of them changes a result.
BLOCK_BYTES, SHARD_WORDS, TASK_BLOCKS = 4 << 20, 2 << 20, 4
#: Values hashed at once.
CHUNK = 1 << 19
SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
NO_TEXT = "__no_text"
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def lengths_up_to(window: int, first: int = FIRST) -> list[int]:
    """Window lengths in order: each at most twice the one before, the last one ``window``."""
    made = [window]
    while made[0] > first:
        made.insert(0, -(-made[0] // 2))
    return made


class Hash:
    """64-bit polynomial hash of slices of an array of numbers, modulo 2 to the 64th, then mixed."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.of_byte = random.integers(0, 1 << 64, 256, np.uint64)
        self.base = int(random.integers(1 << 61, 1 << 62)) | 1
        self.powers = self.inverse = np.zeros(0, np.uint64)

    def grow(self, size: int) -> None:
        if size > len(self.powers):
            for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                made = np.full(size, base, np.uint64)
                made[0] = 1
                setattr(self, name, np.multiply.accumulate(made))

    def slices(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``values[start:end]``; both arrays rise. Bytes count by a table of random numbers."""
        made = np.empty(len(starts), np.uint64)
        a = 0
        while a < len(starts):
            low = int(starts[a])
            b = max(a + 1, int(np.searchsorted(ends, low + CHUNK, "right")))
            part = values[low : int(ends[b - 1])]
            self.grow(max(len(part) + 1, CHUNK + 1))
            part = self.of_byte[part] if part.dtype == np.uint8 else part
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * self.powers[: len(part)], out=sums[1:])
            made[a:b] = (sums[ends[a:b] - low] - sums[starts[a:b] - low]) * self.inverse[starts[a:b] - low]
            a = b
        made ^= made >> np.uint64(30)
        made *= np.uint64(0xBF58476D1CE4E5B9)
        made ^= made >> np.uint64(27)
        made *= np.uint64(0x94D049BB133111EB)
        return made ^ (made >> np.uint64(31))


class Words:
    """The words of a packed block."""

    def __init__(self, packed: bytes, hashes: tuple[Hash, Hash]):
        raw = zstandard.ZstdDecompressor().decompress(packed)
        count = int(np.frombuffer(raw, np.int64, 1)[0])
        self.sizes = np.frombuffer(raw, np.int64, count, 8)
        self.data = np.frombuffer(raw, np.uint8, offset=8 + 8 * count)
        self.hashes = hashes
        edges = np.flatnonzero(np.diff(SPACE[self.data], prepend=True, append=True))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.text_starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        #: Place of each text's first word, and of the end of the last text's words.
        self.first = np.searchsorted(self.starts, np.append(self.text_starts, len(self.data)))
        self.counts = np.diff(self.first)

    def fitting(self, length: int) -> np.ndarray:
        """Whether a window of so many words of one text starts at each word."""
        room = np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))
        return room >= length

    def windows(self, at: np.ndarray, length: int, which: int) -> np.ndarray:
        hasher = self.hashes[which]
        return hasher.slices(hasher.slices(self.data, self.starts, self.ends), at, at + length)

    def texts(self) -> Iterator[bytes]:
        for start, size in zip(self.text_starts.tolist(), self.sizes.tolist()):
            yield self.data[start : start + size].tobytes()


class Level:
    """The candidates of a block at one length: their distinct entries, in order of shard and hash."""

    def __init__(self, words: Words, candidates: np.ndarray, length: int, shards: int, exact: bool):
        self.size = len(candidates)
        self.at = np.flatnonzero(candidates)
        low = words.windows(self.at, length, 0)
        shard = (low >> np.uint64(32)) % np.uint64(shards)
        if exact:
            high = words.windows(self.at, length, 1)
            order = np.lexsort((high, low, shard))
            new = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
        else:
            low = shard << np.uint64(32) | low & np.uint64(0xFFFFFFFF)
            order = np.argsort(low)
            new = low[order][1:] != low[order][:-1]
        new = np.append(np.ones(min(1, len(order)), bool), new)
        chosen = order[new]
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.often = np.bincount(self.entry, minlength=len(chosen)) > 1
        self.shard, self.low, self.high = shard[chosen], low[chosen], high[chosen] if exact else None

    def payloads(self) -> Iterator[tuple[int, bytes]]:
        cuts = np.flatnonzero(np.diff(self.shard)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(self.shard)]):
            if b > a:
                low = self.low[a:b]
                sent = low.astype(np.uint32).tobytes() if self.high is None else low.tobytes() + self.high[a:b].tobytes()
                yield int(self.shard[a]), sent

    def repeated(self, answers: dict[int, bytes]) -> np.ndarray:
        """Whether each position starts a window that occurs again, by the answers of the shards."""
        often = self.often.copy()
        cuts = np.flatnonzero(np.diff(self.shard)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(self.shard)]):
            if b > a:
                bits = np.frombuffer(answers[int(self.shard[a])], np.uint8)
                often[a:b] |= np.unpackbits(bits, count=b - a).astype(bool)
        made = np.zeros(self.size, bool)
        made[self.at] = often[self.entry]
        return made


def pack(docs: DataFrame, text: str, block_bytes: int) -> DataFrame:
    """One row a block: its number, the other columns of its rows, its texts and their number of words."""
    others = [c for c in docs.columns if c.lower() != text.lower()]
    kept = StructType([*(docs.schema[c] for c in others), StructField(NO_TEXT, IntegerType())])
    schema = StructType(
        [
            StructField("block", LongType()),
            StructField("rows", ArrayType(kept)),
            StructField("packed", BinaryType()),
            StructField("words", LongType()),
        ]
    )
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for block in blocks(batch, block_bytes):
                column = block.column(len(others))
                texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
                missing = column.is_null().cast(pa.int32())
                rows = pa.StructArray.from_arrays([*block.columns[: len(others)], missing], names)
                held = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
                sizes = np.array([len(texts), *map(len, texts)], np.int64).tobytes()
                packed = press.compress(sizes + b" ".join([*texts, b""]))
                words = sum(len(t.split()) for t in texts)
                columns = [pa.array([number]), held, pa.array([packed], pa.binary()), pa.array([words])]
                yield pa.RecordBatch.from_arrays(columns, ["block", "rows", "packed", "words"])
                number += 1

    return docs.select(*(F.col(quoted(c)) for c in others), F.col(quoted(text))).mapInArrow(run, schema)


#: What blocks send: the shard it goes to, whether it is the block's mask of candidates, and the bytes.
SENT = "shard int, block long, mask boolean, payload binary"


def _sent(block: int, level: Level, shards: int, mask: np.ndarray | None) -> pa.Table:
    rows = [(shard, block, False, payload) for shard, payload in level.payloads()]
    if mask is not None and rows:
        rows.append((block % shards, block, True, zstandard.compress(np.packbits(mask).tobytes())))
    shard, number, kind, payload = zip(*rows) if rows else ((), (), (), ())
    return pa.table(
        {
            "shard": pa.array(shard, pa.int32()),
            "block": pa.array(number, pa.int64()),
            "mask": pa.array(kind, pa.bool_()),
            "payload": pa.array(payload, pa.binary()),
        }
    )


def _answer(exact: bool) -> Callable[[pa.Table], pa.Table]:
    """A shard's answers: for each entry of a block whether another block sent it too. Masks pass."""

    def run(sent: pa.Table) -> pa.Table:
        masks = sent["mask"].to_numpy()
        payloads = sent["payload"].to_pylist()
        votes = [np.frombuffer(p, np.uint64 if exact else np.uint32) for p, m in zip(payloads, masks) if not m]
        width = 2 if exact else 1
        sizes = np.array([len(v) // width for v in votes], np.int64)
        made: list[bytes] = []
        if len(votes):
            low = np.concatenate([v[:n] for v, n in zip(votes, sizes)])
            if exact:
                high = np.concatenate([v[n:] for v, n in zip(votes, sizes)])
                order = np.lexsort((high, low))
                same = (low[order][1:] == low[order][:-1]) & (high[order][1:] == high[order][:-1])
            else:
                order = np.argsort(low)
                same = low[order][1:] == low[order][:-1]
            often = np.zeros(len(low), bool)
            often[order[1:]] = same
            often[order[:-1]] |= same
            made = [np.packbits(x).tobytes() for x in np.split(often, np.cumsum(sizes)[:-1])]
        answers = iter(made)
        full = [p if m else next(answers) for p, m in zip(payloads, masks)]
        return sent.set_column(3, "payload", pa.array(full, pa.binary()))

    return run


def deduplicate(
    docs: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    first: int = FIRST,
    block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Each text without the words of every ``window``-word sequence that occurs again, all copies of it.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text; a window lies in one text, and its copy may overlap it.
    Returns the columns of ``docs`` except ``text``, with ``n_words`` (long), ``spans`` (removed runs as
    start and end word, end exclusive) and ``kept`` (the other words, joined by one space) in place of columns of
    those names. Every row is a document of its own, so the windows of a repeated row occur again. Null and empty
    texts have no words; an empty table stays empty; the order of rows does not matter, so there are no ties.
    """
    lengths = lengths_up_to(window, first)
    packed = stored(pack(docs, text, block_bytes), "blocks")
    total, count = packed.agg(F.sum("words"), F.count("*")).first()
    shards = max(1, -(-(total or 0) // shard_words))
    tasks = max(1, -(-count // TASK_BLOCKS))
    dealt = packed.repartition(tasks, "block")

    def level(words: Words, k: int, mask: np.ndarray) -> Level:
        return Level(words, mask, lengths[k], shards, k == len(lengths) - 1)

    def mask_of(words: Words, k: int, got: pa.Table) -> tuple[np.ndarray, dict[int, bytes]]:
        """Candidates of length ``k`` and the shards' answers about them."""
        answers = dict(zip(got["shard"].to_pylist(), got["payload"].to_pylist()))
        if not k:
            return words.fitting(lengths[0]), answers
        rows = list(zip(got["shard"].to_pylist(), got["mask"].to_pylist(), got["payload"].to_pylist()))
        size = len(words.starts)
        mask = np.zeros(size, bool)
        for _, kind, payload in rows:
            if kind:
                mask = np.unpackbits(np.frombuffer(zstandard.decompress(payload), np.uint8), count=size).astype(bool)
        return mask, {shard: payload for shard, kind, payload in rows if not kind}

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hash(1), Hash(2)
        for batch in batches:
            for block, data in zip(batch["block"].to_pylist(), batch["packed"].to_pylist()):
                words = Words(data, hashes)
                found = _sent(block, level(words, 0, words.fitting(lengths[0])), shards, None)
                yield from found.combine_chunks().to_batches()

    def double(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def run(held: pa.Table, got: pa.Table) -> pa.Table:
            words = Words(held["packed"][0].as_py(), (Hash(1), Hash(2)))
            mask, answers = mask_of(words, k, got)
            again = level(words, k, mask).repeated(answers)
            longer, shift = lengths[k + 1], lengths[k + 1] - lengths[k]
            both = words.fitting(longer)
            both[: max(0, len(both) - shift)] &= again[shift:]
            both &= again
            return _sent(held["block"][0].as_py(), level(words, k + 1, both), shards, both)

        return run

    def finish(held: pa.Table, got: pa.Table) -> pa.Table:
        k = len(lengths) - 1
        words = Words(held["packed"][0].as_py(), (Hash(1), Hash(2)))
        mask, answers = mask_of(words, k, got)
        starts = np.flatnonzero(level(words, k, mask).repeated(answers))
        change = np.zeros(len(mask) + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        spans, kept = [], []
        for data, a, b in zip(words.texts(), words.first.tolist(), words.first[1:].tolist()):
            part = gone[a:b]
            left = data.split()
            if part.any():
                edges = np.flatnonzero(np.diff(part, prepend=False, append=False)).tolist()
                spans.append([{"start": x, "end": y} for x, y in zip(edges[::2], edges[1::2])])
                left = [left[i] for i in np.flatnonzero(~part).tolist()]
            else:
                spans.append([])
            kept.append(b" ".join(left).decode())
        rows = held["rows"].combine_chunks().flatten()
        columns = {name: rows.field(name) for name in others}
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        columns["n_words"] = pa.array(words.counts.astype(np.int64))
        columns["spans"], columns["kept"] = pa.array(spans, span), pa.array(kept, pa.string())
        return pa.table(columns)

    others = without(docs, [text, "n_words", "spans", "kept"])
    schema = StructType(
        [
            *(docs.schema[c] for c in others),
            StructField("n_words", LongType()),
            StructField("spans", SPANS),
            StructField("kept", StringType()),
        ]
    )
    sent = packed.select("block", "packed").mapInArrow(start, SENT)
    for k in range(len(lengths)):
        exact = k == len(lengths) - 1
        voted = sent.repartition(shards, "shard").groupBy("shard").applyInArrow(_answer(exact), SENT)
        got = stored(voted, "answers").repartition(tasks, "block").groupBy("block")
        if exact:
            return dealt.groupBy("block").cogroup(got).applyInArrow(finish, schema)
        sent = dealt.select("block", "packed").groupBy("block").cogroup(got).applyInArrow(double(k), SENT)
