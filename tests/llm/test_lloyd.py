import hashlib
import math
import random

import numpy as np
import pytest

from threadloom.llm import lloyd as L

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts, entries, rounds):
    """Full scans of every round, in whole numbers."""
    kept = []
    for vec_id, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append([vec_id, [math.floor(1024 * float(np.float32(x))) for x in vector], label])
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    for row in kept:
        row[1] += [0] * (parts * width - len(row[1]))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda x, book: min((far(x, c), i) for i, c in enumerate(book))
    for _ in range(rounds):
        codes = [[nearest(c[p], books[p])[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                used = [c[p] for c, code in zip(cut, codes) if code[p] == e]
                if used:
                    books[p][e] = [sum(xs) // len(used) for xs in zip(*used)]
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    made, sums = [], {}
    for (vec_id, _, label), c in zip(kept, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        error = sum(b[0] for b in best)
        sums[label] = sums.get(label, 0) + error
        made.append((vec_id, "".join(f"{b[1]:02x}" for b in best), error, label))
    return sorted(((v, c, e, sums[label], digest) for v, c, e, label in made), key=str)


def run(spark, rows, *sizes):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'old' AS code", "1 AS error", "2 AS LABEL_ERROR", "3 AS slot")
    made = L.with_group_error(L.compress(df.repartition(3), *sizes), "label", "label_error")
    assert "slot" in made.columns and len(made.columns) == 8
    return sorted(map(tuple, made.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


@pytest.mark.parametrize("parts, entries, rounds, values", [(4, 6, 4, None), (2, 16, 3, (-1, 0, 1)), (1, 256, 2, None), (4, 5, 6, (0, 1))])
def test_equals_full_scans(spark, parts, entries, rounds, values):
    rnd = random.Random(parts)
    number = lambda: rnd.choice(values) / 1024 if values else rnd.gauss(0, 1)
    rows = [(i, [number() for _ in range(8)], rnd.choice([1, 1, 2, None])) for i in range(150)]
    rows += rows[:5] + [(3, [0.5] * 8, 9), (900, None, 1), (901, [1.0, None] * 4, 1), (902, [math.nan] * 8, None)]
    rows += [(903, [math.inf] * 8, 1), (None, [0.25] * 8, 2)]
    rnd.shuffle(rows)
    assert run(spark, rows, parts, entries, rounds) == plain(rows, parts, entries, rounds)


def test_lengths_and_sizes(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [], 1), (3, [0.1] * 9, None), (4, [30000.0, -30000.0], 1)]
    assert run(spark, rows, 4, 256, 4) == plain(rows, 4, 256, 4)
    assert run(spark, [(1, None, 1)], 4, 256, 4) == [] and run(spark, [], 4, 256, 4) == []
    # Beyond the bound components are held there, and nothing overflows.
    made = run(spark, [(i, [3e38 * (-1) ** i] * 8, 1) for i in range(3)], 4, 2, 1)
    assert len(made) == 3 and all(r[2] >= 0 for r in made)


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(L, "HOT_ONE_IN", 3)
    rows = [(i, [float(i), 0.5], None if i % 2 else i % 7) for i in range(60)]
    assert run(spark, rows, 2, 3, 2) == plain(rows, 2, 3, 2)


def test_active_entries_change_nothing():
    rnd = np.random.default_rng(3)
    x, book = rnd.integers(-3, 4, (500, 2)), rnd.integers(-3, 4, (20, 2))
    code, error = L.assign(x, book, None, np.zeros(500, int), np.zeros(500, int))
    moved = np.zeros(20, bool)
    moved[[2, 7, 19]] = True
    after = book.copy()
    after[moved] = rnd.integers(-3, 4, (3, 2))
    for got, want in zip(L.assign(x, after, moved, code, error), L.assign(x, after, None, code, error)):
        assert (got == want).all()
    assert (L.squared(x << 29, book << 29)[:5, :5] == L.squared(x, book)[:5, :5] << 58).all()
