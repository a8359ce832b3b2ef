"""Removal of byte strings that occur earlier, by bucket-pointer refinement over anchored contexts.

Equal strings of ``MATCH`` bytes have their smallest ``GRAM``-byte gram, by hash, at the same place: their
anchor. Anchors that occur once are dropped; the text around the others (the windows that chose the anchor) meets
by anchor. There, positions start in buckets of equal grams; buckets with more than one position are refined by
sorting on the bucket pointers at a later offset, and the updated pointers serve the next, twice as
far, until a bucket stands for ``MATCH`` equal bytes. All but the first position of a bucket are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from threadloom.llm.arrow import blocks, quoted, raw, without
from threadloom.session import stored

MATCH, GRAM = 100, 25
WINDOW = MATCH - GRAM + 1
#: Anchors that occur more often meet window by window, not in one task.
HOT_ANCHOR = 50_000
BLOCK = 1 << 20
BATCH_BYTES = 4 << 20
SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
FIRST_ID = -(1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """64-bit hash of the ``size`` bytes at each position that has so many."""
    random = np.random.default_rng(seed)
    table = random.integers(0, 1 << 63, 256).astype(np.uint64)
    base = int(random.integers(1 << 61, 1 << 62)) | 1
    # Hashes of 1, 2, 4, ... bytes, joined for the bits of ``size``.
    power, known = table[data], 1
    total, done = None, 0
    while True:
        if size & known:
            if total is None:
                total, done = power, known
            else:
                shift = np.uint64(pow(base, known, 1 << 64))
                total = total[: len(power) - done] * shift + power[done:] if len(power) > done else total[:0]
                done += known
        if 2 * known > size:
            break
        shift = np.uint64(pow(base, known, 1 << 64))
        power = power[:-known] * shift + power[known:] if len(power) > known else power[:0]
        known *= 2
    return _mix(total[: max(0, len(data) - size + 1)])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    span, low = 1, values
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[: len(low) - (width - span)], low[width - span :])


class Anchors:
    """Anchors of a block of texts: for each its gram hash, text, and the windows that chose it."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(sizes)
        self.starts = ends - sizes
        self.hashes = gram_hashes(self.data, GRAM)
        if len(self.data) < MATCH:
            self.text = self.first = self.last = np.zeros(0, np.int64)
            self.names = np.zeros(0, np.uint64)
            return
        place = np.arange(len(self.hashes), dtype=np.uint64)
        chosen = smallest((self.hashes & np.uint64(0xFFFFFFFF00000000)) | place, WINDOW) & np.uint64(0xFFFFFFFF)
        # Windows that cross the end of a text are none.
        inside = np.zeros(len(self.data) + 1, np.int32)
        long = sizes >= MATCH
        np.add.at(inside, self.starts[long], 1)
        np.add.at(inside, ends[long] - MATCH + 1, -1)
        windows = np.flatnonzero(np.cumsum(inside[: len(chosen)]) > 0)
        chosen = chosen[windows].astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (np.diff(windows) != 1)]))
        if not len(windows):
            new = np.zeros(0, np.int64)
        self.first = windows[new]
        self.last = windows[np.append(new[1:], len(windows)) - 1] if len(new) else self.first
        self.names = self.hashes[chosen[new]]
        self.text = np.searchsorted(ends, self.first, "right")


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(anchor, doc) for each anchor of each text, from (doc, text); once for each text."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, BLOCK):
                found = Anchors(raw(block.column(1)))
                docs = block.column(0).to_numpy()[found.text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.names.view(np.int64)), pa.array(docs)], ["anchor", "doc"]
                )

    return docs.mapInArrow(emit, "anchor long, doc long")


def _chosen(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, Anchors, np.ndarray]]:
    """Blocks of (.., anchors, text) with the anchors of each text that its list names."""
    for block in blocks(batch, BLOCK):
        found = Anchors(raw(block.column(block.num_columns - 1)))
        lists = block.column(column)
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(block.num_rows), counts)
        named = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        # (text, anchor) pairs by a number for each distinct anchor.
        names, place = np.unique(np.concatenate([named, found.names]), return_inverse=True)
        wanted = np.isin(
            found.text * len(names) + place[len(named) :], owner * np.int64(len(names)) + place[: len(named)]
        )
        yield block, found, np.flatnonzero(wanted)


def context_rows(named: DataFrame) -> DataFrame:
    """(anchor, doc_id, doc, at, context) from (doc_id, doc, anchors, text)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, found, at in _chosen(batch, 2):
                text = found.text[at]
                stops = found.last[at] + MATCH
                data = found.data.tobytes()
                contexts = [data[a:b] for a, b in zip(found.first[at].tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.names[at].view(np.int64)),
                        block.column(0).take(pa.array(text)),
                        block.column(1).take(pa.array(text)),
                        pa.array((found.first[at] - found.starts[text]).astype(np.int32)),
                        pa.array(contexts, pa.binary()),
                    ],
                    ["anchor", "doc_id", "doc", "at", "context"],
                )

    return named.mapInArrow(emit, "anchor long, doc_id long, doc long, at int, context binary")


def window_rows(named: DataFrame) -> DataFrame:
    """(a, b, doc_id, doc, at): two hashes of each window of the named anchors."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, found, at in _chosen(batch, 2):
                if not len(at):
                    continue
                a, b = gram_hashes(found.data, MATCH, 2), gram_hashes(found.data, MATCH, 3)
                counts = found.last[at] - found.first[at] + 1
                offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                windows = np.repeat(found.first[at], counts) + offset
                text = np.repeat(found.text[at], counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a[windows].view(np.int64)),
                        pa.array(b[windows].view(np.int64)),
                        block.column(0).take(pa.array(text)),
                        block.column(1).take(pa.array(text)),
                        pa.array((windows - found.starts[text]).astype(np.int32)),
                    ],
                    ["a", "b", "doc_id", "doc", "at"],
                )

    return named.mapInArrow(emit, "a long, b long, doc_id long, doc long, at int")


def refine(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose ``MATCH`` bytes occur more than once in ``data``, and their bucket pointers.

    Pointers start as the buckets of grams. A round sorts the positions of shared buckets by the pointer they
    have and the pointer one reach further; new pointers reach twice as far and serve the next round. A position
    alone in its bucket is done, and its pointer stays.
    """
    hashes = gram_hashes(data, GRAM)
    pointer = np.full(len(data) + MATCH, -1, np.int64)
    _, start = np.unique(hashes, return_inverse=True)
    pointer[: len(start)] = start
    shared = np.flatnonzero(np.bincount(start)[start] > 1)
    reach, top = GRAM, len(start)
    while reach < MATCH and len(shared):
        own, later = pointer[shared], pointer[shared + reach]
        order = np.lexsort((later, own))
        own, later = own[order], later[order]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (later[1:] != later[:-1])])
        bucket = np.cumsum(new) - 1
        counts = np.bincount(bucket)
        pointer[shared[order]] = top + bucket
        top += len(counts)
        shared = np.sort(shared[order][counts[bucket] > 1])
        reach *= 2
    return shared, pointer[shared]


def repeats(ids: np.ndarray, docs: np.ndarray, at: np.ndarray, contexts: list[bytes]):
    """(doc, start, end) of the runs of windows that occur earlier, for whole groups of contexts.

    Of equal contexts only the first is refined; all of the others occurs earlier.
    """
    known: dict[bytes, int] = {}
    same = np.fromiter((known.setdefault(c, len(known)) for c in contexts), np.int64, len(contexts))
    order = np.lexsort((at, docs, ids, same))
    head = order[np.flatnonzero(np.concatenate([[True], same[order][1:] != same[order][:-1]]))]
    first = head[same]
    # A repeated row is the same place, not a later one.
    copy = (docs != docs[first]) | (at != at[first]) | (ids != ids[first])
    length = np.array([len(c) for c in contexts], np.int64)
    found = distinct_repeats(ids[head], docs[head], at[head], list(known))
    return tuple(np.concatenate(x) for x in zip((docs[copy], at[copy], (at + length)[copy]), found))


def distinct_repeats(ids: np.ndarray, docs: np.ndarray, at: np.ndarray, contexts: list[bytes]):
    """As ``repeats``, where no two contexts are equal."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    shared, pointer = refine(np.frombuffer(b"".join(contexts), np.uint8))
    ends = np.cumsum(sizes)
    row = np.searchsorted(ends, shared, "right")
    offset = shared - (ends - sizes)[row]
    # Grams may run on into the next context; only windows within one count.
    whole = offset + MATCH <= sizes[row]
    row, offset, pointer = row[whole], offset[whole], pointer[whole]
    if not len(row):
        return docs[:0], at[:0], at[:0]
    start = at[row] + offset
    order = np.lexsort((start, docs[row], ids[row], pointer))
    row, offset, pointer, start = row[order], offset[order], pointer[order], start[order]
    new = np.concatenate([[True], pointer[1:] != pointer[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    later = np.arange(len(row)) != first
    row, start = row[later], start[later]
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    run = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]))
    if not len(row):
        return docs[:0], at[:0], at[:0]
    last = np.append(run[1:], len(row)) - 1
    return docs[row[run]], start[run], start[last] + MATCH


def search_contexts(contexts: DataFrame) -> DataFrame:
    """(doc, start, end) of removed runs; the contexts of an anchor are searched together."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def found(rows: pa.Table) -> pa.RecordBatch:
            columns = [rows[c].to_numpy() for c in ("doc_id", "doc", "at")]
            docs, start, end = repeats(*columns, rows["context"].to_pylist())
            arrays = [pa.array(docs), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))]
            return pa.RecordBatch.from_arrays(arrays, ["doc", "start", "end"])

        for batch in batches:
            for block in blocks(batch, BATCH_BYTES):
                held.append(block)
                size += block.nbytes
                if size < BATCH_BYTES:
                    continue
                rows = pa.Table.from_batches(held)
                names = rows["anchor"].to_numpy()
                done = int(np.searchsorted(names, names[-1]))
                if done:
                    yield found(rows.slice(0, done))
                held = rows.slice(done).combine_chunks().to_batches()
                size = sum(b.nbytes for b in held)
        if held:
            yield found(pa.Table.from_batches(held))

    return (
        contexts.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(search, "doc long, start int, end int")
    )


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs that intervals cover; touching ones are one."""
    made: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts.tolist(), ends.tolist())):
        if made and a <= made[-1][1]:
            made[-1] = made[-1][0], max(b, made[-1][1])
        else:
            made.append((a, b))
    return made


def deduplicate(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    spans: str = "spans",
    kept: str = "kept",
    hot_anchor: int = HOT_ANCHOR,
) -> DataFrame:
    """``docs`` with the removed byte runs of each whole text in ``spans`` and the rest in ``kept`` (binary).

    A byte goes if a string of ``MATCH`` bytes around it also starts earlier: in a document of smaller id, or
    earlier in the same one; overlaps count, and strings are judged on the input. Null texts are empty; null ids come
    first; rows with one id and different texts are ordered by a hash of the text, and rows that repeat id and
    text are one document. Matches never cross texts. Columns of the two names are replaced.
    """
    keep = without(docs, [spans, kept])
    name = F.xxhash64(F.col(doc_id), F.col(text))
    # Both joins below meet this one table by the same key, so its texts are shuffled once.
    base = docs.select(*(F.col(quoted(c)) for c in keep), name.alias("__doc"))
    order = F.coalesce(F.col(quoted(doc_id)).cast("long"), F.lit(FIRST_ID)).alias("doc_id")
    anchors = anchor_rows(docs.select(name.alias("doc"), F.col(quoted(text)).alias("text")))
    shared = stored(anchors.groupBy("anchor").count().filter("count > 1"), "anchors")

    def texts_with(named: DataFrame) -> DataFrame:
        lists = named.groupBy(F.col("doc").alias("__doc")).agg(F.collect_set("anchor").alias("__anchors"))
        joined = base.join(lists.hint("shuffle_hash"), "__doc")
        return joined.select(
            order, F.col("__doc").alias("doc"), F.col("__anchors").alias("anchors"), F.col(quoted(text)).alias("text")
        )

    met = lambda some: anchors.join(some.hint("shuffle_hash"), "anchor").select("anchor", "doc")
    removed = search_contexts(context_rows(texts_with(met(shared.filter(F.col("count") <= hot_anchor)))))
    hot = shared.filter(F.col("count") > hot_anchor)
    if not hot.isEmpty():
        windows = window_rows(texts_with(met(hot)))
        place = F.struct("doc_id", "doc", "at")
        firsts = windows.groupBy("a", "b").agg(F.min(place).alias("first"))
        later = windows.join(firsts, ["a", "b"]).filter(place != F.col("first"))
        removed = removed.unionByName(
            later.select("doc", F.col("at").alias("start"), (F.col("at") + MATCH).alias("end"))
        )
    # Sets, so that rows which repeat id and text do not pile up what each of them finds.
    runs = removed.groupBy(F.col("doc").alias("__doc")).agg(
        F.collect_set(F.struct("start", "end")).alias("__runs")
    )
    marked = base.join(runs.hint("shuffle_hash"), "__doc", "left")
    both = F.struct(F.col("__runs").alias("runs"), F.encode(F.coalesce(F.col(quoted(text)), F.lit("")), "UTF-8").alias("text"))
    return cut(marked.select(*(F.col(quoted(c)) for c in keep), both.alias("__both")), keep, spans, kept)


def cut(marked: DataFrame, keep: list[str], spans: str, kept: str) -> DataFrame:
    """Merge the runs of ``__both`` and cut them out of its text."""
    schema = StructType(
        [marked.schema[c] for c in keep] + [StructField(spans, SPANS), StructField(kept, BinaryType())]
    )
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                lists, rests = [], []
                for both in part.column(len(keep)).to_pylist():
                    found = both["runs"] or []
                    held = merged(np.array([r["start"] for r in found]), np.array([r["end"] for r in found]))
                    data, at, pieces = both["text"], 0, []
                    for start, end in held:
                        pieces.append(data[at:start])
                        at = end
                    lists.append([{"start": s, "end": e} for s, e in held])
                    rests.append(b"".join([*pieces, data[at:]]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], pa.array(lists, kind), pa.array(rests, pa.binary())], schema.names
                )

    return marked.mapInArrow(run, schema)
