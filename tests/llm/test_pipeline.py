"""run() and the registered queries against brute force over the small tables."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import test_decontaminate, test_linededup, test_simhash
from visittrail.llm import toxicity
from visittrail.llm.decontaminate import cut_words
from visittrail.llm.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    names = ("documents", "labels", "benchmark", "pages")
    return {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in names}


def test_queries_are_registered():
    assert set(entry.queries()) >= {*QUERIES, "pipeline"}
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*SQL} <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    expected = connection.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert Counter(map(tuple, frame.select(*columns).collect())) == Counter(expected)


def test_run_equals_brute_force(spark, tables):
    model = toxicity.train(tables["documents"], tables["labels"])
    rows = [(r["doc_id"], r["text"], r["source"]) for r in tables["documents"].collect()
            if model.score(toxicity.features_of((r["text"] or "").encode())) < 0.5]
    cleaned = test_linededup.brute(rows).elements()
    groups = test_simhash.expected(list(cleaned))
    first = {i for i, _, component in groups if i == component}
    items = [tuple(r) for r in tables["benchmark"].select("item_id", "text").collect()]
    kept = {}
    for i, text in test_linededup.brute(rows).elements():
        if i in first:
            runs, n = hit_runs(text, items)
            if sum(b - a for a, b in runs) <= 0.5 * n:
                kept[i] = cut_words((text or "").encode(), runs).decode()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for i, text in kept.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at:at + 4096], "<u4")
            expected[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    found = corpus_pipeline.run(spark, SF).collect()
    assert Counter(tuple(r[:5]) for r in found) == expected
    places = defaultdict(int)
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert places[r["sequence_id"]] == r["offset"]
        places[r["sequence_id"]] += r["length"]
    assert max(places.values()) <= 4096


def hit_runs(text, items, window=10):
    words = test_decontaminate.words(text)
    hit = [False] * len(words)
    for _, item in items:
        own = test_decontaminate.words(item)
        n = min(window, len(own))
        wins = {tuple(own[k:k + n]) for k in range(len(own) - n + 1)} if own else set()
        for k in range(len(words) - n + 1 if wins else 0):
            if tuple(words[k:k + n]) in wins:
                hit[k:k + n] = [True] * n
    runs, at = [], None
    for k, h in enumerate([*hit, False]):
        if h and at is None:
            at = k
        elif not h and at is not None:
            runs.append((at, k))
            at = None
    return runs, len(words)


def test_stages_keep_columns_and_empty_tables(spark, tables):
    docs = tables["documents"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and not out.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).collect() == []
