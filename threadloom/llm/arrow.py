"""Arrow helpers: add columns to a table from Python tasks, block by block."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

BLOCK_BYTES = 4 << 20


def without(df: DataFrame, names: list[str]) -> list[str]:
    """The columns that do not clash with ``names``, which Spark compares without case."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def blocks(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes in the last column; one long value is a slice."""
    if batch.num_rows == 0:
        return
    column = batch.column(batch.num_columns - 1)
    offsets = np.frombuffer(column.buffers()[1], np.int32, batch.num_rows + 1, 4 * column.offset)
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def release() -> None:
    """Give memory back at the end of a task: the worker lives on, and other stages run in it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: Most bytes of an Arrow batch between the JVM and a Python task, where a run asks for small ones.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of ``BATCH_BYTES`` at most from now on; results stay the same."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def add_columns(
    df: DataFrame,
    source: str,
    fields: list[StructField],
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    most: int = BLOCK_BYTES,
    keep: list[str] | None = None,
    beside: list[str] | None = None,
) -> DataFrame:
    """``df`` with new columns computed from ``source``; columns of the same names are replaced.

    ``make`` is called once in each task and returns the function from a block of values to
    one Arrow array for each field. ``keep`` names the columns that stay, by default all. The columns
    ``beside``, which do not stay, are further arguments of that function.
    """
    beside = beside or []
    keep = without(df, [*beside, *(f.name for f in fields)]) if keep is None else keep
    schema = StructType([df.schema[c] for c in keep] + fields)
    count = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for block in blocks(batch, most):
                made = function(block.column(count + len(beside)), *block.columns[count : count + len(beside)])
                names = [*keep, *(f.name for f in fields)]
                yield pa.RecordBatch.from_arrays([*block.columns[:count], *made], names)
        release()

    value = F.col(quoted(source))
    stay = (F.col(quoted(c)) for c in keep)
    more = (F.col(quoted(c)).alias(f"__beside{i}") for i, c in enumerate(beside))
    return df.select(*stay, *more, value.alias("__value")).mapInArrow(run, schema)


def lists(flat: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    """A list column from its values one after the other and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def raw(values: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [v or b"" for v in values.cast(pa.binary()).to_pylist()]
