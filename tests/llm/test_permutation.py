import numpy as np
import pytest

from visittrail.llm import permutation

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id string"


def frame(spark, rows):
    made = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, "v", "i")
            for i, v in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(4)


def brute(rows, top=20, every=20):
    sound = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows
             if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    ids = np.array([i for i, _ in sound])
    vectors = np.stack([v for _, v in sound])
    out = {}
    for i, v in sound:
        if i % every == 0:
            scores = vectors @ v
            order = np.lexsort((ids, -scores.round(12)))
            out[i] = [(int(ids[j]), scores[j]) for j in order if ids[j] != i][:top]
    return out


def answers(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        own = out.setdefault(r["query_id"], [])
        own.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(own)
    return out


def query(vec_id):
    return vec_id % 20 == 0


def recall(found, expected):
    hits = sum(len({i for i, _ in expected[q]} & {i for i, _ in found[q]}) for q in expected)
    return hits / sum(len(x) for x in expected.values())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    made = [(i, rng.normal(size=64).tolist()) for i in range(6000)]
    same = rng.normal(size=64).tolist()
    return made + [(10_000 + i, same) for i in range(300)]


def test_recall(spark, rows):
    found = answers(permutation.nearest_neighbours(frame(spark, rows), query, shard_rows=2000))
    expected = brute(rows)
    assert found.keys() == expected.keys()
    assert recall(found, expected) >= 0.9
    copies = [q for q in expected if q >= 10_000]
    assert copies and all([i for i, _ in found[q]] == [i for i, _ in expected[q]] for q in copies)


@pytest.mark.parametrize("n", [8_000, 32_000])
def test_recall_for_unequal_norms(spark, n):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(n, 64))
    vectors *= np.exp(0.5 * rng.normal(size=(n, 1))) / np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = list(enumerate(vectors.tolist()))
    few = n // 100
    found = answers(permutation.nearest_neighbours(
        frame(spark, rows), lambda vec_id: vec_id % few == 0))
    expected = brute(rows, every=few)
    assert found.keys() == expected.keys() and recall(found, expected) >= 0.9


def test_each_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-9, 10, 3 + i % 3).tolist()) for i in range(300)]
    rows += [(400, [5, 5, 5, 5, 5]), (400, [1, 2, 3]), (401, [1, 2, 3])]
    found = permutation.nearest_neighbours(frame(spark, rows), query).collect()
    for n in (3, 4, 5):
        some = [(i, v) for i, v in rows if len(v) == n and any(v)]
        expected = brute(some)
        for q in expected.keys() - {400}:
            own = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == q)
            assert [i for _, i in own] == [i for i, _ in expected[q]]
    assert sum(r["query_id"] == 400 for r in found) == 40


def test_few_rows_are_ranked_exactly(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 8).tolist()) for i in range(90)]
    rows += [(20, None), (40, []), (60, [0] * 8), (80, [1, None] * 4), (81, [float("nan")] * 8),
             (82, [float("inf")] * 8), (None, [1] * 8), (100, [1] * 8), (101, [1] * 8)]
    found = answers(permutation.nearest_neighbours(frame(spark, rows), query))
    expected = brute(rows)
    assert {q: [i for i, _ in x] for q, x in found.items()} == \
        {q: [i for i, _ in x] for q, x in expected.items()}
    assert all(abs(a - b) < 1e-9 for q in found
               for (_, a), (_, b) in zip(found[q], expected[q], strict=True))


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1, 2]), (1, [2, 1]), (2, [1, 1])]
    found = answers(permutation.nearest_neighbours(frame(spark, rows), query))
    assert found == {0: [(1, 4.0), (2, 3.0)]}
    assert permutation.nearest_neighbours(frame(spark, rows[:1]), query).collect() == []
    assert permutation.nearest_neighbours(frame(spark, []), query).collect() == []


def test_footrule():
    rng = np.random.default_rng(0)
    order = np.array([rng.permutation(12)[:5] for _ in range(40)])
    file = permutation.InvertedFile(order, 12)

    def place(own, pivot):
        at = np.flatnonzero(own == pivot)
        return at[0] if len(at) else 5

    for q in order[:5]:
        expected = [sum(abs(place(o, p) - place(q, p)) for p in range(12)) for o in order]
        assert file.footrule(q).tolist() == expected
