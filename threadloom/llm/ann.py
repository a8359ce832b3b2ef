"""Approximate nearest neighbours by multiprobe p-stable hashing, with exact distances.

Every table cuts Gaussian projections of a vector into steps; the step numbers name its bucket. A query
visits its own bucket and perturbed ones, in the order in which they are expected to hold near vectors: steps whose
border lies close come first. All vectors of a visited bucket are compared with the query by exact distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import stored

#: Tables, projections in each, visited buckets in each table, and the step as a share of the typical distance.
TABLES, PROJECTIONS, PROBES, STEP = 6, 8, 96, 1.77
SEED = 5
#: Buckets with more rows are split, and every part is visited.
BUCKET_ROWS = 20_000
#: Queries whose best rows a task holds before it passes them on.
HELD_QUERIES = 50_000
#: Queries compared with all rows in one pass, where their buckets hold too few.
BLOCK_QUERIES = 2_000
CHUNK = 512


def probe_sets(projections: int, probes: int) -> list[tuple[int, ...]]:
    """Perturbation sets by expected cost, the empty one first.

    Elements number the 2M borders from the nearest to the farthest; the expected squared distance of the j-th
    is that of order statistics. Two borders of one projection are never crossed together.
    """
    m = projections
    near = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    far = [
        1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
        for j in range(m + 1, 2 * m + 1)
    ]
    cost = near + far
    sets: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(sets) < probes:
        total, chosen = heapq.heappop(heap)
        if not any(2 * m - 1 - x in chosen for x in chosen):
            sets.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
    return sets


@dataclass(frozen=True)
class Hashing:
    """Random tables for vectors of one length and typical distance."""

    width: int
    step: float

    def tables(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        random = np.random.default_rng(SEED)
        for _ in range(TABLES):
            yield (
                random.standard_normal((self.width, PROJECTIONS)) / self.step,
                random.uniform(0, 1, PROJECTIONS),
                random.integers(1, 1 << 62, PROJECTIONS + 1),
            )

    def buckets(self, rows: np.ndarray) -> np.ndarray:
        """Bucket of each row in each table."""
        return np.stack([np.floor(rows @ a + b).astype(np.int64) @ m[:-1] + m[-1] for a, b, m in self.tables()], 1)

    def probes(self, rows: np.ndarray) -> np.ndarray:
        """Buckets that each row visits, in all tables."""
        sets = probe_sets(PROJECTIONS, PROBES)
        made = []
        for a, b, m in self.tables():
            place = rows @ a + b
            cell = np.floor(place).astype(np.int64)
            inside = place - cell
            order = np.argsort(np.concatenate([inside, 1 - inside], 1), axis=1, kind="stable")
            home = cell @ m[:-1] + m[-1]
            move = np.where(order < PROJECTIONS, -m[:-1][order % PROJECTIONS], m[:-1][order % PROJECTIONS])
            made += [home + move[:, list(s)].sum(1) for s in sets]
        return np.stack(made, 1)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def usable(vector: Column) -> Column:
    """Not null, not all zero, all components there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def best_rows(found: DataFrame, count: int) -> DataFrame:
    """The nearest ``count`` rows of each query, ties to the smaller id, each id once."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


class Nearest:
    """The best rows of each query that a task has seen."""

    def __init__(self, count: int):
        self.count = count
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, query: int, ids: np.ndarray, distances: np.ndarray) -> None:
        if query in self.held:
            old = self.held[query]
            ids, distances = np.concatenate([old[0], ids]), np.concatenate([old[1], distances])
        # Held rows may come again: where no id repeats within the new ones, so many hold enough ids.
        size = 2 * self.count
        while True:
            close = np.arange(len(ids))
            if len(ids) > size:
                close = np.flatnonzero(distances <= np.partition(distances, size - 1)[size - 1])
            close = close[np.lexsort((ids[close], distances[close]))]
            first = np.sort(np.unique(ids[close], return_index=True)[1])[: self.count]
            if len(first) == self.count or len(close) == len(ids):
                break
            size *= 4
        self.held[query] = ids[close[first]], distances[close[first]]

    def batch(self) -> pa.RecordBatch:
        queries = np.repeat(np.fromiter(self.held, np.int64, len(self.held)), [len(i) for i, _ in self.held.values()])
        parts = list(self.held.values())
        ids = np.concatenate([i for i, _ in parts]) if parts else np.zeros(0, np.int64)
        scores = np.concatenate([d for _, d in parts]) if parts else np.zeros(0)
        self.held = {}
        return pa.RecordBatch.from_arrays(
            [pa.array(queries.astype(np.int64)), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"]
        )


FOUND = "query_id long, vec_id long, score double"


def compare(nearest: Nearest, query: int, vector: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
    """All rows but those of the query's own id, by Euclidean distance in double precision."""
    distances = np.sqrt(((rows - vector) ** 2).sum(1))
    others = ids != query
    if others.all():
        nearest.add(query, ids, distances)
    elif others.any():
        nearest.add(query, ids[others], distances[others])


def search_buckets(visits: DataFrame, width: int, count: int) -> DataFrame:
    """Best rows by task, from (bucket, asks, id, vector) with the rows of a bucket together."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(count)
        bucket, parts, whole = None, [], None
        for batch in batches:
            keys, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            ids, rows = batch.column(2).to_numpy(), matrix(batch.column(3), width)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if a == b:
                    continue
                if keys[a] != bucket:
                    bucket, parts, whole = keys[a], [], None
                if not asks[a]:
                    parts.append((ids[a:b], rows[a:b]))
                elif parts:
                    if whole is None:
                        whole = tuple(np.concatenate(x) for x in zip(*parts))
                    for i in range(a, b):
                        compare(nearest, int(ids[i]), rows[i], *whole)
            if len(nearest.held) > HELD_QUERIES:
                yield nearest.batch()
        yield nearest.batch()

    return (
        visits.repartition("bucket").sortWithinPartitions("bucket", "asks", "id").mapInArrow(search, FOUND)
    )


def search_all(vectors: DataFrame, queries: DataFrame, width: int, count: int) -> DataFrame:
    """Best rows by task from all rows, for one bounded block of queries."""
    asked = queries.toArrow()
    names, targets = asked["id"].to_numpy(), matrix(asked["vector"].combine_chunks(), width)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(count)
        for batch in batches:
            ids, rows = batch.column(0).to_numpy(), matrix(batch.column(1), width)
            for a in range(0, len(ids), CHUNK):
                for name, target in zip(names.tolist(), targets):
                    compare(nearest, name, target, ids[a : a + CHUNK], rows[a : a + CHUNK])
        yield nearest.batch()

    return vectors.select("id", "vector").mapInArrow(search, FOUND)


def neighbours(
    vectors: DataFrame, asks: Column, count: int = 10, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``count`` nearest rows found for each row where ``asks`` holds.

    Null, zero and non-finite vectors, null ids, and vectors whose length is not the most common one take no part. A
    query never finds its own id; rows that repeat an id count once, at their nearest. Of equal vectors only
    the smallest ``count + 1`` ids are indexed, as no other can be among the nearest. Queries whose buckets hold fewer than
    ``count`` rows are compared with all rows.
    """
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    numbers = "array<float>" if single else "array<double>"
    named = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast(numbers).alias("vector"), asks.alias("asks")
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    sizes = named.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = sizes["width"]
    rows = named.filter(F.size("vector") == width)
    per_column = [F.var_pop(F.col("vector")[i]).alias(f"v{i}") for i in range(width)]
    spread = float(sum(x or 0 for x in rows.agg(*per_column).first()))
    hashing = Hashing(width, STEP * max((2 * spread) ** 0.5, 1e-12))

    same = Window.partitionBy("same").orderBy("id")
    indexed = (
        rows.select("id", "vector")
        .distinct()
        .withColumn("same", F.xxhash64("vector"))
        .withColumn("place", F.row_number().over(same))
        .filter(F.col("place") <= count + 1)
        .select("id", "vector")
    )

    def dealt(kind: str):
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = getattr(hashing, kind)
            for batch in batches:
                for a in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(a, CHUNK)
                    buckets = find(matrix(part.column(1), width))
                    at = pa.array(np.repeat(np.arange(len(buckets)), buckets.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(buckets.ravel()), part.column(0).take(at), part.column(1).take(at)],
                        ["bucket", "id", "vector"],
                    )

        return deal

    kind = f"bucket long, id long, vector {numbers}"
    queries = rows.filter("asks").select("id", "vector")
    members = indexed.mapInArrow(dealt("buckets"), kind)
    visits = queries.mapInArrow(dealt("probes"), kind)
    hot = stored(members.groupBy("bucket").count().filter(F.col("count") > BUCKET_ROWS), "hot-buckets")
    parts = F.coalesce(F.ceil(F.col("count") / BUCKET_ROWS), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("id"), parts).cast("int")
    split = members.join(hot, "bucket", "left").select(
        F.xxhash64("bucket", mine).alias("bucket"), F.lit(False).alias("asks"), "id", "vector"
    )
    spread_visits = (
        visits.join(hot, "bucket", "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select(F.xxhash64("bucket", "part").alias("bucket"), F.lit(True).alias("asks"), "id", "vector")
    )
    found = stored(best_rows(search_buckets(split.unionByName(spread_visits), width, count), count), "neighbours")
    few = stored(
        queries.join(found.groupBy(F.col("query_id").alias("id")).count(), "id", "left").filter(
            F.coalesce("count", F.lit(0)) < count
        ).select("id", "vector"),
        "few",
    )
    passes = -(-few.count() // BLOCK_QUERIES)
    for i in range(passes):
        block = few.filter(F.pmod(F.xxhash64("id"), F.lit(passes)) == i)
        exact = search_all(rows, block, width, count)
        found = found.select("query_id", "vec_id", "score").unionByName(exact)
    if passes:
        found = best_rows(found.select("query_id", "vec_id", "score"), count)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
