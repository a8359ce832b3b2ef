import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import ann

SF = "/root/testdata/sf0.1"


def plain(rows, count):
    """For each query the whole order of all other rows, by distance and id."""
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], float)
    made = {}
    for i, v in rows:
        if i % 100 == 0:
            distance = np.sqrt(((matrix - np.array(v, float)) ** 2).sum(1))
            made[i] = [(int(ids[j]), float(distance[j])) for j in np.lexsort((ids, distance)) if ids[j] != i][:count]
    return made


def found(table, count=10):
    rows = ann.neighbours(table, F.col("vec_id") % 100 == 0, count).collect()
    made = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        made.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(made[r.query_id])
    return made


def test_recall_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    got, want = found(table), plain([(r.vec_id, r.embedding) for r in table.collect()], 10)
    assert set(got) == set(want) and all(len(x) == 10 for x in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.9
    for q, rows in got.items():
        assert rows == sorted(rows, key=lambda x: (x[1], x[0]))


@pytest.mark.parametrize("bucket_rows", [5, 20_000])
def test_copies_ties_and_split_buckets(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(ann, "BUCKET_ROWS", bucket_rows)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 8))
    rows = [(i, (base[0] if i % 3 == 0 else base[i % 40] + 0.01 * (i % 7)).tolist()) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = found(table.repartition(4)), plain(rows, 10)
    for q in want:
        assert got[q][0] == want[q][0] and len(got[q]) == 10
        assert len({i for i, _ in got[q]} & {i for i, _ in want[q]}) >= 9
    assert got[0] == want[0]


def test_awkward_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]),
        (5, [float("inf"), 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, []), (None, [1.0, 0.5]), (100, [1.0, 0.0]), (1, [5.0, 5.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "'x' AS bucket")
    got = found(table)
    assert got[0] == [(100, 0.0), (1, 1.0)] and got[100] == [(0, 0.0), (1, 1.0)] and set(got) == {0, 100}
    assert found(table.limit(0)) == {} and found(table.filter("vec_id = 2")) == {}
    assert found(table.filter("vec_id = 100")) == {}


def nearest_ids(rows, count):
    """As ``plain``, for rows that repeat ids: each id at its nearest."""
    made = {}
    for i, v in rows:
        if i % 100 == 0:
            best = {}
            for j, w in rows:
                if j != i:
                    best[j] = min(best.get(j, np.inf), float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())))
            made[i] = sorted(best.items(), key=lambda x: (x[1], x[0]))[:count]
    return made


def test_rows_repeated_many_times(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal(8)
    others = [(i, (v + 0.01 * rng.standard_normal(8)).tolist()) for i in range(20, 60)]
    rows = [(0, v.tolist())] * 30 + [(6, v.tolist()), (100, v.tolist()), *others]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = found(table.repartition(3)), nearest_ids(dict(rows).items(), 10)
    assert got[0][:2] == [(6, 0.0), (100, 0.0)] and got[100][:2] == [(0, 0.0), (6, 0.0)]
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}


def test_one_id_with_many_near_vectors():
    nearest = ann.Nearest(3)
    nearest.add(0, np.array([7] * 40 + [8, 9, 5]), np.array([*np.linspace(2, 1, 40), 3.0, 4.0, 5.0]))
    assert [x.tolist() for x in nearest.held[0]] == [[7, 8, 9], [1.0, 3.0, 4.0]]
    nearest.add(0, np.array([8, 5, 5]), np.array([0.5, 2.0, 1.0]))
    assert [x.tolist() for x in nearest.held[0]] == [[8, 5, 7], [0.5, 1.0, 1.0]]
