import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from visittrail.llm import simhash
from visittrail.llm.components import connected_components


def brute_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [words] if len(words) < shingle else [
        words[i:i + shingle] for i in range(len(words) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(p), seed=42) for p in parts]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, distance=3):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    values = sorted(parent)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def expected(rows):
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    roots = brute_components([p for _, p in prints])
    least = defaultdict(list)
    for i, p in prints:
        if i is not None:
            least[roots[p]].append(i)
    return Counter((i, p, min(least[roots[p]], default=None)) for i, p in prints)


def got(rows):
    return Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in rows)


def changed(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"z{rng.random()}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(5)
    rows, n = [], 100
    for _ in range(6):
        base = [f"v{rng.randrange(3000)}" for _ in range(400)]
        for k in range(40):
            rows.append((n, changed(rng, base, k % 5)))
            n += 1
    rows += [(n + i, " ".join(f"q{rng.randrange(10**6)}" for _ in range(50))) for i in range(100)]
    return rows


def test_groups_are_those_of_all_pairs(documents, copies, odd):
    rows = copies + odd
    assert got(simhash.near_duplicates(documents(rows)).collect()) == expected(rows)


def test_hot_values_in_blocks_lose_no_link(documents, copies, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 16)
    assert got(simhash.near_duplicates(documents(copies)).collect()) == expected(copies)


def test_empty_table(documents):
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.one_of_each(documents([])).collect() == []


def test_random_fingerprints_at_every_distance(spark):
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(300)}
    for v in list(values)[:200]:
        flips = rng.sample(range(64), rng.randrange(1, 5))
        values.add(v ^ sum(1 << b for b in flips))
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    fps = spark.createDataFrame(signed, "fp long").repartition(4)
    for parts in (2, 3, 4):
        links = simhash.fingerprint_links(fps, 3, parts)
        found = {r["node"] % (1 << 64): r["component"] % (1 << 64)
                 for r in connected_components(links).collect()}
        brute = brute_components(values)
        groups = defaultdict(set)
        for v, root in brute.items():
            groups[root].add(v)
        mine = defaultdict(set)
        for v in values:
            mine[found.get(v, v)].add(v)
        assert {frozenset(g) for g in mine.values()} == {frozenset(g) for g in groups.values()}


def test_one_of_each_keeps_the_smallest_id(documents, copies, odd):
    rows = copies + odd
    docs = documents(rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter({c for _, _, c in expected(rows)})


def test_limits_add_up():
    costs = np.random.default_rng(0).random((3, 4, 50))
    limits = simhash.allocate(costs, 3)
    assert (limits.sum(axis=1) == 1).all() and (limits >= -1).all()
    for row in range(50):
        best = min(costs[0, a, row] + costs[1, b, row] + costs[2, c, row]
                   for a in range(4) for b in range(4) for c in range(4) if a + b + c == 4)
        mine = sum(costs[i, limits[row, i] + 1, row] for i in range(3))
        assert abs(best - mine) < 1e-12


def test_components_of_a_path(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 500), (7, 7), (300, 301), (301, 300)]
    edges = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert found == {**{i: 0 for i in range(201)}, 300: 300, 301: 300}
