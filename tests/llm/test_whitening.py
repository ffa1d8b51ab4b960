import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from visittrail.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, w long, dims string"


def frame(spark, rows, kind=SCHEMA):
    return spark.createDataFrame([(i, v, "x", 1, "d") for i, v in rows], kind).repartition(3)


def integers(vector):
    return tuple(math.floor(64 * float(c)) + 1_000_000 for c in vector)


def brute(rows, weights="one"):
    """By length of vector: n, exact deviations, covariance, and the distinct vectors."""
    spaces = defaultdict(Counter)
    for _, v in rows:
        if v is not None and v and all(c is not None and math.isfinite(c) for c in v):
            spaces[len(v)][integers(v)] += 1
    out = {}
    for dims, counts in spaces.items():
        w = {x: c if weights == "count" else 1 for x, c in counts.items()}
        n = sum(w.values())
        sums = [sum(c * x[i] for x, c in w.items()) for i in range(dims)]
        off = np.array([[(n * x[i] - sums[i]) / n for i in range(dims)] for x in w])
        share = np.array(list(w.values()))[:, None]
        out[dims] = (n, {x: sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for x in w},
                     (off * share).T @ off / n, dict(zip(w, off, strict=True)))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(13)
    mixed = rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) * [1, 2, 3, 4, 5, 6]
    made = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(mixed)]
    made += [(1000 + i, made[0][1]) for i in range(200)]
    made += [(None, made[1][1]), (7, made[2][1]), (7, made[3][1])]
    made += [(2000, None), (2001, []), (2002, [None] * 6), (2003, [float("nan")] + [1.0] * 5),
             (2004, [float("inf")] * 6), (2005, [0.0] * 6), (2006, [1.0, 2.0]), (2007, [3.0, 5.0]),
             (2008, [4.0, 4.5])]
    return made


@pytest.mark.parametrize("weights", ["one", "count"])
def test_equals_numpy(spark, rows, weights):
    out = whitening.whitened(frame(spark, rows), components=4, weights=weights).collect()
    expected = brute(rows, weights)
    own = defaultdict(list)
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            own[i].append(integers(v))
    assert Counter((r["vec_id"], r["component"]) for r in out) == Counter(
        (i, k) for i, xs in own.items() for x in xs for k in range(1, min(len(x), 4) + 1))
    for dims, (n, deviations, covariance, off) in expected.items():
        values, axes = np.linalg.eigh(covariance)
        mine = [r for r in out if r["dims"] == dims]
        assert {r["n"] for r in mine} == {n}
        assert Counter((r["vec_id"], r["deviation"]) for r in mine if r["component"] == 1) == Counter(
            (i, deviations[x]) for i, xs in own.items() for x in xs if len(x) == dims)
        for k in range(1, min(dims, 4) + 1):
            e, axis = values[-k], axes[:, -k]
            found = sorted((str(r["vec_id"]), r["whitened"]) for r in mine if r["component"] == k)
            for sign in (1, -1):
                wanted = sorted((str(i), float(sign * off[x] @ axis / math.sqrt(e)))
                                for i, xs in own.items() for x in xs if len(x) == dims)
                if np.allclose([v for _, v in found], [v for _, v in wanted], atol=1e-9):
                    break
            else:
                raise AssertionError((dims, k))
            share = {r["explained"] for r in mine if r["component"] == k}
            assert np.allclose(list(share), e / np.trace(covariance), rtol=1e-10) and len(share) == 1
        assert len({r["identity_error"] for r in mine}) == 1 and mine[0]["identity_error"] < 1e-8


def test_axes_without_variance_are_left_out(spark):
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    assert {r["component"] for r in whitening.whitened(frame(spark, line)).collect()} == {1}
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0])] * 3)).collect() == []


def test_large_entries_stay_exact(spark):
    kind = SCHEMA.replace("float", "double")
    big = [(1, [1e13, 0.0]), (2, [-1e13, 1.0]), (3, [3.0, 1e300]), (4, [7.0, -2.0])]
    out = whitening.whitened(frame(spark, big, kind)).collect()
    assert {r["vec_id"] for r in out} == {1, 2, 3, 4}
    assert {r["deviation"] for r in out} == {None}
    fair = [(i, [2.0 ** 30 + i, float(i)]) for i in range(5)]
    out = whitening.whitened(frame(spark, fair, kind)).collect()
    expected = brute(fair)[2][1]
    assert {(r["vec_id"], r["deviation"]) for r in out} == {
        (i, expected[integers(v)]) for i, v in fair}


def test_copies_are_whitened_once(spark, rows):
    out = whitening.whitened(frame(spark, rows)).filter("dims = 6 and component = 1").collect()
    same = {r["whitened"] for r in out if r["vec_id"] == 0 or 1000 <= (r["vec_id"] or 0) < 1200}
    assert len(same) == 1


def test_empty_table_and_wrong_weights(spark):
    out = whitening.whitened(frame(spark, []))
    assert out.collect() == [] and out.columns == [
        "vec_id", "dims", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    with pytest.raises(ValueError):
        whitening.whitened(frame(spark, []), weights="two")
