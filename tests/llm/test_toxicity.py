import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from visittrail.llm import common, toxicity


def made(n=1500, seed=3):
    rng = random.Random(seed)
    plain, rude = [f"w{i}" for i in range(300)], ["rude1", "rude2", "rude3", "rude4"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randrange(20, 80))
        bad = rng.random() < 0.15
        if bad:
            words += rng.choices(rude, k=2)
            rng.shuffle(words)
        rows.append((i, " ".join(words)))
        if rng.random() < 0.6:
            labels.append((i, int(bad)))
    truth = {i: int("rude" in t) for i, t in rows}
    return rows, labels, truth


@pytest.fixture(scope="module")
def case():
    return made()


def label_frame(spark, labels):
    return spark.createDataFrame([(i, 1, t) for i, t in labels],
                                 "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, documents, case, odd):
    rows, labels, truth = case
    extra = [(None if i is None else 10_000 + i, t) for i, t in odd]
    known = [*labels, (5, None), (99_999, 1), labels[0]]
    out = toxicity.scored(documents(rows + extra), label_frame(spark, known)).collect()
    assert len(out) == len(rows) + len(extra)
    for r in out:
        text = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(text.encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert right / len(held) > 0.97
    empty = {r["score"] for r in out if r["doc_id"] in (10_001, 10_002, 10_003)}
    assert len(empty) == 1 and empty.pop() < 0.5


def test_held_out_labels_are_not_used(spark, documents, case):
    rows, labels, _ = case
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    scores = [{r["doc_id"]: r["score"] for r in toxicity.scored(
        documents(rows), label_frame(spark, x)).collect()} for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_filter_keeps_clean_documents(spark, documents, case):
    rows, labels, truth = case
    docs = documents([*rows, (None, None)])
    kept = toxicity.not_toxic(docs, label_frame(spark, labels))
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    clean = {i for i, t in truth.items() if not t} | {None}
    assert len(clean - ids) <= 0.01 * len(clean) and len(ids - clean) <= 0.05 * len(rows)


def test_empty_tables(spark, documents, case):
    none = label_frame(spark, [])
    assert toxicity.scored(documents([]), none).collect() == []
    out = toxicity.scored(documents(case[0]), none).collect()
    assert len(out) == len(case[0]) and {r["predicted"] for r in out} == {0}


def test_risk_of_the_clean_part_does_not_fall_below_zero():
    rng = np.random.default_rng(0)
    p, u = rng.random((200, 5)) + [2, 0, 0, 0, 0], rng.random((2000, 5))
    u[:200, 0] += 2
    w, b = toxicity.nn_pu(p, u, 0.1)
    found = u @ w + b > 0
    assert found[:200].mean() > 0.9 and found[200:].mean() < 0.1


def test_scoring_drops_what_a_worker_kept_for_another_operator(spark):
    common.kept("words", lambda: [1])
    assert common.kept("words", lambda: [2]) == [1]
    scores = toxicity.toxicity(toxicity.Model(0.0)).func(pa.array(["a", None]))
    assert scores.to_pylist() == [0.5, 0.5]
    assert common.kept("words", lambda: [2]) == [2]
