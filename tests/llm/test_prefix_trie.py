import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from threadloom.llm import prefix_trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Nodes of the trie, as the contract says, with tuples for prefixes."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            convs[conv].append((turn is not None, turn or 0, digest, (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in convs.items()}
    members, ends = defaultdict(set), defaultdict(set)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
        for d in range(len(built) + 1):
            members[tuple(built[:d])].add(c)
        ends[tuple(built)].add(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    made = []
    below = {}
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(below[x][0] for x in children[node]) or 1
        saved = sum(below[x][1] for x in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        below[node] = leaves, saved
        parent = min(members[node[:-1]]) if node else None
        joined = ",".join(map(str, sorted(ends[node])))
        made.append((min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves, saved,
                     hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(made, key=str)


def check(spark, rows, **sizes):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    # Other columns, also of names that the operator uses itself.
    df = df.selectExpr("*", "'old' AS conv", "'old' AS `key`", "1 AS depth", "true AS last").repartition(3)
    made = T.trie(df, **sizes)
    assert made.columns == COLUMNS
    assert sorted(map(tuple, made.collect()), key=str) == plain(rows)


def talk(seed, convs=130, long=0):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(convs), 250, 907, 1000, 1001]:
        for t in range(rnd.randint(1, 9)):
            rows.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(["", "é😀", "one text", "another"])))
    rows += [(907, t, "user", f"turn {t % 7}") for t in range(20, 20 + long)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment, shard, long", [(4096, 50_000, 0), (3, 40, 0), (16, 25, 300)])
def test_equals_plain(spark, segment, shard, long):
    check(spark, talk(segment, long=long), segment=segment, shard_rows=shard)


def test_edges(spark):
    rows = talk(5, 20) + [(3, None, None, None), (3, None, None, None), (3, 0, "user", "x"), (3, 0, "user", "x")]
    rows += [(None, 1, "user", "no id"), (-7, 1, "user", "minus"), (12, 5, "user", "long " * 50_000), (99, 1, None, "")]
    rows += [(c, 1, "user", "the same") for c in range(2000, 2300)] + [(5000 + c, 0, "", "") for c in range(40)]
    check(spark, rows, segment=2, shard_rows=30)
    check(spark, rows)
    assert T.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_perfect_hash():
    random_ = np.random.default_rng(1)
    keys = np.unique(random_.integers(0, 1 << 64, (5000, 2), np.uint64), axis=0)
    table = T.PerfectHash(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    other = random_.integers(0, 1 << 64, (5000, 2), np.uint64)
    assert (table.slots(other) == -1).all() and len(T.PerfectHash(keys[:0]).slots(other)) == 5000
