"""Codes of vectors by product quantisation, with codebooks made by active-entry Lloyd rounds.

Vectors become integers and are cut into parts. Each part position has a codebook. A part whose assigned
entry stayed fixed in an update keeps its stored exact distance and compares only the entries that moved;
all other parts rescan the whole codebook. Of equally near entries the lower index is taken. The state of all
parts is a stored table, and codebooks are renewed from sums over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.arrow import quoted, without
from threadloom.session import stored

SCALE = 1024
#: Parts compared at once.
SLICE = 8192
#: A distance of two parts is below two to this power; components are held so that it stays so.
DISTANCE_BITS = 62
EXACT = 1 << 53



def integers(vectors: DataFrame, vector: str, parts: int) -> tuple[DataFrame, int]:
    """The rows whose vector is whole, with it as integers in ``__ints``, and the length of a part.

    Shorter vectors are filled up with zeros to the longest length, and that to a multiple of ``parts``.
    """
    usable = F.col(quoted(vector)).isNotNull() & ~F.exists(
        quoted(vector), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )
    kept = vectors.filter(usable)
    longest = kept.agg(F.max(F.size(quoted(vector)))).first()[0] or 0
    width = -(-longest // parts)
    most = float(1 << (DISTANCE_BITS - max(width - 1, 0).bit_length()) // 2 - 1)
    held = F.transform(
        quoted(vector),
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(most)), F.lit(-most))).cast("long"),
    )
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width * parts) - F.size(quoted(vector)))
    return kept.withColumn("__ints", F.concat(held, zeros)), width


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` and ``b``."""
    largest = max((int(np.abs(x).max()) for x in (a, b) if x.size), default=0)
    if 4 * largest * largest * max(1, a.shape[1]) < EXACT:
        # Every product and sum is an integer that a double holds.
        x, y = a.astype(float), b.astype(float)
        return ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None]).astype(np.int64)
    made = np.zeros((len(a), len(b)), np.int64)
    for i in range(a.shape[1]):
        made += (a[:, i, None] - b[None, :, i]) ** 2
    return made


def assign(
    x: np.ndarray, book: np.ndarray, moved: np.ndarray | None, code: np.ndarray, error: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row and its distance. ``moved`` tells the entries that an update changed since ``code``
    and ``error`` were found; None: nothing is known yet."""
    scan = np.ones(len(x), bool) if moved is None else moved[code]
    code, error = code.copy(), error.copy()
    active = np.arange(len(book)) if moved is None else np.flatnonzero(moved)
    for rows, entries in ((np.flatnonzero(scan), np.arange(len(book))), (np.flatnonzero(~scan), active)):
        for a in range(0, len(rows) if len(entries) else 0, SLICE):
            part = rows[a : a + SLICE]
            far = squared(x[part], book[entries])
            best = far.argmin(1)
            near, index = far[np.arange(len(part)), best], entries[best]
            if entries is active:
                better = (near < error[part]) | ((near == error[part]) & (index < code[part]))
                part, near, index = part[better], near[better], index[better]
            code[part], error[part] = index, near
    return code, error


class Books:
    """The codebooks: entries by part, entry and place, and which of them the last update moved."""

    def __init__(self, entries: np.ndarray, moved: np.ndarray | None = None):
        self.entries, self.moved = entries, moved

    def renewed(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Books:
        """Each used entry as the floor of its parts' mean; others stay."""
        made = self.entries.copy()
        for (part, entry), (count, total) in sums.items():
            made[part, entry] = [x // count for x in total]
        return Books(made, (made != self.entries).any(2))

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _ints(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width)


def _scan(state: DataFrame, books: Books, width: int) -> DataFrame:
    """The state with each part assigned anew."""
    parts = len(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            x = _ints(batch["__ints"], parts * width)
            code, error = _ints(batch["__codes"], parts).copy(), _ints(batch["__errors"], parts).copy()
            for p in range(parts):
                piece = x[:, p * width : (p + 1) * width]
                moved = None if books.moved is None else books.moved[p]
                code[:, p], error[:, p] = assign(piece, books.entries[p], moved, code[:, p], error[:, p])
            size = pa.array(np.arange(0, len(x) * parts + 1, parts, dtype=np.int32))
            made = {n: batch.column(i) for i, n in enumerate(names)}
            made["__codes"] = pa.ListArray.from_arrays(size, pa.array(code.ravel()))
            made["__errors"] = pa.ListArray.from_arrays(size, pa.array(error.ravel()))
            yield pa.RecordBatch.from_pydict(made)

    return state.mapInArrow(run, state.schema)


def _sums(state: DataFrame, parts: int, entries: int, width: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry): number and componentwise sum of its parts over all tasks; of fixed size."""
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            x = _ints(batch["__ints"], parts * width)
            slot = _ints(batch["__codes"], parts) + np.arange(parts) * entries
            count += np.bincount(slot.ravel(), minlength=len(count))
            np.add.at(total, slot.ravel(), x.reshape(-1, width))
        used = np.flatnonzero(count)
        columns = [pa.array(used), pa.array(count[used]), *(pa.array(c) for c in total[used].T.copy())]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "n", *names])

    schema = "slot long, n long" + "".join(f", {n} long" for n in names)
    wide = [F.sum(F.col(n).cast("decimal(38,0)")).alias(n) for n in ("n", *names)]
    rows = state.select("__ints", "__codes").mapInArrow(run, schema).groupBy("slot").agg(*wide).collect()
    return {divmod(r[0], entries): (int(r[1]), [int(v) for v in r[2:]]) for r in rows}


def compress(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    vector: str = "embedding",
    order: str = "vec_id",
    each_round: Callable[[int, Books], None] | None = None,
) -> DataFrame:
    """``vectors`` with ``code`` (two hex digits a part), ``error`` (long) and ``codebooks_sha256``.

    Component x counts as floor(1024 x). The first codebooks are the parts of the ``entries`` (256 at most) smallest rows by
    ``order`` and vector, null orders last; with fewer rows the codebooks are smaller. Rows without a vector, or with a null
    or non-finite component, are dropped; an empty table stays empty. Vectors of other lengths count as filled up
    with zeros to the longest. A component whose square would not fit a long is held at the bound. Repeated
    rows count each; columns of the new names are replaced. ``each_round`` sees the codebooks after each update.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits names 1 to 256 entries")
    rows, width = integers(vectors, vector, parts)
    state = stored(
        rows.withColumns({n: F.array_repeat(F.lit(0).cast("long"), parts) for n in ("__codes", "__errors")}), "vectors"
    )
    first = state.select(order, "__ints").orderBy(F.asc_nulls_last(order), "__ints").limit(entries).collect()
    books = Books(np.array([r["__ints"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2))
    for k in range(rounds if first else 0):
        state = stored(_scan(state, books, width), "codes")
        books = books.renewed(_sums(state, parts, len(first), width))
        if each_round:
            each_round(k, books)
    if first:
        state = _scan(state, books, width)
    hexes = F.transform("__codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    made = {
        "code": F.array_join(hexes, ""),
        "error": F.aggregate("__errors", F.lit(0).cast("decimal(38,0)"), lambda a, e: (a + e).cast("decimal(38,0)")),
        "codebooks_sha256": F.lit(books.digest()),
    }
    made["error"] = F.least(made["error"], F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")
    return state.select(*(F.col(quoted(c)) for c in without(vectors, list(made))), *(c.alias(n) for n, c in made.items()))


#: Groups with more than one row in so many of all rows: there are fewer of them than this, so they may be broadcast.
HOT_ONE_IN = 1000


def with_group_error(coded: DataFrame, group: str, out: str) -> DataFrame:
    """``coded`` with the sum of ``error`` over rows of equal ``group`` in ``out``; nulls are one group.

    Sums shrink in each task before they meet. Those of large groups, fewer than ``HOT_ONE_IN`` by their
    definition, are broadcast to the rows; all others join by group. A sum beyond a long is held at its bound.
    """
    coded = stored(coded, "coded")
    limit = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = stored(
        coded.groupBy(F.col(quoted(group)).alias("__group"))
        .agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), limit).cast("long").alias(out), F.count("*").alias("__n")),
        "sums",
    )
    hot = F.col("__n") * HOT_ONE_IN > coded.count()
    rows = coded.select(*map(quoted, without(coded, [out])))
    here = rows[quoted(group)].eqNullSafe(F.col("__group"))
    named = [*map(quoted, rows.columns), out]
    large = rows.join(F.broadcast(sums.filter(hot)), here, "left")
    small = large.filter("__n IS NULL").select(*map(quoted, rows.columns))
    rest = small.join(sums.filter(~hot), small[quoted(group)].eqNullSafe(F.col("__group")))
    return large.filter("__n IS NOT NULL").select(*named).unionByName(rest.select(*named))
