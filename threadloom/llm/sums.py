"""Sums over all partitions of arrays that the tasks build."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.arrow import release


def summed(df: DataFrame, size: int, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """The sum of what ``partial`` makes of each task's rows, an array of ``size`` numbers.

    Tasks send (slot, value) rows, combined before and after one exchange; the driver gets ``size``
    numbers at most, whatever the input. An empty table sums to zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = partial(batches)
        release()
        slots = np.flatnonzero(made)
        for a in range(0, len(slots), 1 << 16):
            part = slots[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(made[part].astype(float))], ["slot", "value"])

    total = np.zeros(size)
    for table in (
        df.mapInArrow(run, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value")).toArrow(),
    ):
        total[table["slot"].to_numpy()] = table["value"].to_numpy()
    return total
