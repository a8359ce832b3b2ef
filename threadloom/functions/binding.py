"""Naming an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body(c)`` with ``c`` computed once, however often the body mentions it.

    Catalyst inlines a column wherever it is mentioned; a one-element array makes it a variable.
    """
    return F.try_element_at(F.transform(F.array(c), body), F.lit(1))


RUN = 256


def _sums_before(numbers: Column) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(
        numbers,
        start,
        lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["all"], a["at"]).alias("all")),
        lambda a: a["all"],
    )


def runs(xs: Column, size: int = RUN) -> Column:
    """An array in pieces of ``size`` elements, which are fetched by place: ``slice`` walks the array once a piece."""

    def pieces(xs: Column) -> Column:
        last = F.size(xs) - 1
        starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(size))).otherwise(F.array().cast("array<int>"))
        places = lambda start: F.sequence(start, F.least(start + (size - 1), last))
        return F.transform(starts, lambda start: F.transform(places(start), lambda i: F.get(xs, i)))

    return let(xs, pieces)


def sums_before(numbers: Column) -> Column:
    """For each element of an int array the sum of those before it.

    A fold that appends copies its array each time, so long arrays are summed in runs: first the
    sums of the runs, then inside each run.
    """

    def by_runs(parts: Column) -> Column:
        whole = F.transform(parts, lambda r: F.aggregate(r, F.lit(0), lambda a, x: a + x))
        placed = F.zip_with(
            parts, _sums_before(whole), lambda r, base: F.transform(_sums_before(r), lambda x: base + x)
        )
        return F.flatten(placed)

    return let(runs(numbers), by_runs)
