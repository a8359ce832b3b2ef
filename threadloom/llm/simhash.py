"""SimHash near-duplicates: fingerprints of word shingles, linked through Gray-order indexes.

Equal fingerprints are one from the start. Fingerprints within ``bits`` differing bits agree in at least
two of ``bits + 2`` blocks, so the values of every two blocks deal them out to groups without losing a
link. A task walks its groups in Gray order and searches each with a hierarchical index; what leaves it
are links that span components, never all pairs. Groups beyond ``GROUP_ROWS`` are split into chunks, of which every
two meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from threadloom.llm.arrow import add_columns, raw
from threadloom.llm.components import components
from threadloom.llm.gray_index import group_links
from threadloom.session import stored

SEED = 42
GROUP_ROWS = 20_000
TASK_ROWS = 200_000
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 of each run of ``size`` words, or of all words if there are fewer."""
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER).split()
    if not words:
        return []
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(size, len(words))
    starts = np.concatenate([[0], ends[:-size] + 1]).tolist()
    return [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())]


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", out: str = "fingerprint", keep=None) -> DataFrame:
    """``docs`` with the 64-bit fingerprint of each whole text (long); 0 for null texts and those without words."""

    def make():
        def block(values: pa.Array) -> list[pa.Array]:
            hashes = [shingle_hashes(t, shingle) for t in raw(values)]
            made = np.zeros(len(hashes), np.uint64)
            counts = np.array([len(h) for h in hashes])
            some = np.flatnonzero(counts)
            if len(some):
                flat = np.concatenate([np.array(hashes[i], np.uint64) for i in some])
                starts = np.cumsum(counts[some]) - counts[some]
                bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
                over = 2 * sums > counts[some][:, None]
                made[some] = np.packbits(over, axis=1, bitorder="little").view(np.uint64)[:, 0]
            return [pa.array(made.view(np.int64))]

        return block

    return add_columns(docs, text, [StructField(out, LongType())], make, 2 << 20, keep)


def gray_rank(code: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def block_keys(code: Column, bits: int) -> Column:
    """For every two of ``bits + 2`` blocks, a key of their numbers and values."""
    count = bits + 2
    cuts = [round(i * 64 / count) for i in range(count + 1)]
    values = [
        F.shiftrightunsigned(code, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:])
    ]
    return F.array(
        *(
            F.xxhash64(F.lit(number), values[i], values[j])
            for number, (i, j) in enumerate(combinations(range(count), 2))
        )
    )


def links(codes: DataFrame, bits: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links that join all distinct ``code`` values within ``bits`` bits, spanning each group."""
    rows = codes.select(gray_rank(F.col("code")).alias("rank"), F.explode(block_keys(F.col("code"), bits)).alias("key"))
    hot = stored(rows.groupBy("key").count().filter(F.col("count") > group_rows), "hot-groups")
    rows = (
        rows.join(hot, "key", "left")
        .withColumn("chunks", F.coalesce(F.ceil(F.col("count") / group_rows), F.lit(1)).cast("int"))
        .withColumn("mine", F.pmod(F.xxhash64("rank"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("group"),
            "rank",
        )
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, ranks, held = [], [], 0

        def searched(group, rank):
            a, b = group_links(group, rank, bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            groups.append(batch.column(0).to_numpy())
            ranks.append(batch.column(1).to_numpy().view(np.uint64))
            held += batch.num_rows
            if held >= TASK_ROWS:
                group, rank = np.concatenate(groups), np.concatenate(ranks)
                done = int(np.flatnonzero(group != group[-1])[-1]) + 1 if group[0] != group[-1] else 0
                if done:
                    yield searched(group[:done], rank[:done])
                groups, ranks, held = [group[done:]], [rank[done:]], len(group) - done
        if held:
            yield searched(np.concatenate(groups), np.concatenate(ranks))

    return (
        rows.repartition("group")
        .sortWithinPartitions("group", "rank")
        .mapInArrow(search, "a long, b long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, shingle: int, bits: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    Fingerprints link at ``bits`` or fewer differing bits; ``component_id`` is the smallest id in reach.
    Null and empty texts have fingerprint 0, linked like any other. A null id never is the smallest one, unless its
    component has no other; repeated rows share a component; other columns are not looked at.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = stored(fingerprints(named, shingle, keep=["doc_id"]), "fingerprints")
    firsts = stored(marked.groupBy(F.col("fingerprint").alias("code")).agg(F.min("doc_id").alias("first")), "codes")
    stars = components(links(firsts, bits))
    rooted = firsts.join(stars, F.col("code") == F.col("u"), "left").select(
        "code", "first", F.coalesce("v", "code").alias("root")
    )
    named_roots = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = rooted.join(named_roots, "root").select(F.col("code").alias("fingerprint"), "component_id")
    return marked.join(ids, "fingerprint").select("doc_id", "fingerprint", "component_id")
