import random
import re

import numpy as np
import pytest
import xxhash
from edges import edge_docs, empty_docs

from threadloom.llm import gray_index, simhash
from threadloom.llm.components import components


def fingerprint(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [words[i : i + size] for i in range(len(words) - size + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def copies(n=60, seed=2):
    rnd = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)]
    made = []
    for i in range(n):
        words = rnd.choices(vocabulary, k=rnd.choice([2, 5, 200]))
        for _ in range(rnd.choice([1, 1, 4])):
            edited = list(words)
            if len(words) > 50:
                edited[rnd.randrange(len(edited))] = "edit"
            made.append((len(made) + 1, " ".join(edited), "en", 0))
    rnd.shuffle(made)
    return made


def test_equals_all_pairs(spark):
    docs = edge_docs(spark, copies()).union(edge_docs(spark))
    rows = simhash.near_duplicates(docs, 4, 4).collect()
    source = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(i, fingerprint(t, 4)) for i, t in source]
    codes = sorted({c for _, c in want})
    root = plain_components([(a, b) for a in codes for b in codes if (a ^ b).bit_count() <= 4])
    least = {}
    for i, c in want:
        if i is not None:
            least[root[c]] = min(i, least.get(root[c], i))
    key = lambda x: tuple(-1 if v is None else v for v in x)
    got = sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in rows), key=key)
    assert got == sorted(((i, c, least.get(root[c])) for i, c in want), key=key)
    assert simhash.near_duplicates(empty_docs(spark), 4, 4).count() == 0


@pytest.mark.parametrize("group_rows", [3, 1000])
def test_split_groups_lose_no_link(spark, group_rows):
    rnd = random.Random(4)
    base = rnd.getrandbits(64)
    codes = {base}
    while len(codes) < 40:
        codes.add(rnd.choice(sorted(codes)) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 6))))
    table = spark.createDataFrame([(int(np.uint64(c).astype(np.int64)),) for c in codes], "code long")
    found = {(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(table, 4, group_rows).collect()}
    assert all((a ^ b).bit_count() for a, b in found)
    own = lambda links: plain_components([*links, *((c, c) for c in codes)])
    assert own(found) == own((a, b) for a in codes for b in codes if (a ^ b).bit_count() <= 4)


def test_dense_group_is_one_component():
    rng = np.random.default_rng(1)
    codes = np.full(20000, np.uint64(77))
    for _ in range(4):
        codes ^= np.uint64(1) << rng.integers(0, 64, len(codes)).astype(np.uint64)
    ranks = codes = np.unique(codes)
    for shift in (1, 2, 4, 8, 16, 32):
        ranks = ranks ^ (ranks >> np.uint64(shift))
    ranks = np.sort(ranks)
    assert set(gray_index.gray_code(ranks).tolist()) == set(codes.tolist())
    a, b = gray_index.group_links(np.zeros(len(ranks), int), ranks, 4)
    assert len(a) == len(ranks) - 1 and len(set(b.tolist())) == 1


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(7, 7), (300, 301), (301, 300)]
    table = spark.createDataFrame(links + [(None, 1)], "x long, y long")
    want = plain_components((a, b) for a, b in links if a != b)
    assert {(r.u, r.v) for r in components(table).collect()} == {(a, b) for a, b in want.items() if a != b}
    assert components(table.limit(0)).count() == 0
