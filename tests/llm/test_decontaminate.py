import hashlib
import random
import re
from collections import Counter

import pytest

from visittrail.llm import decontaminate
from visittrail.llm.decontaminate import SuffixAutomaton, cut_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(rows, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(k) for k in wins}
    out = []
    for doc, text in rows:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                own = wins.get(tuple(w[i:i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(found),
                    hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return Counter(out)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(1)
    vocabulary = ["a", "b", "c", "d", "é", "7"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice((2, 4, 9, 10, 12, 30)))))
             for i in range(25)]
    items += [(100, None), (101, ""), (102, "!!"), (None, "rare words with no number at all"),
              (3, "another row of three"), (103, "single")]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(6)):
            text = rng.choice(items)[1] or ""
            if rng.random() < 0.5:
                text = text[rng.randrange(len(text) + 1):]
            parts += [text, " ".join(rng.choices([*vocabulary, "zz"], k=rng.randrange(20)))]
        rows.append((i, rng.choice((" ", ". ", ", ")).join(parts).upper()))
    return rows, items


@pytest.mark.parametrize("block", [1, 300, 1 << 20])
def test_equals_search_for_every_window(spark, documents, case, odd, block):
    rows, items = case[0] + odd, case[1]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(documents(rows), benchmark, block_bytes=block) \
        if block > 1 else decontaminate.contamination(documents(rows), benchmark)
    assert Counter(map(tuple, found.collect())) == brute(rows, items)


def test_empty_tables(spark, documents, case):
    none = spark.createDataFrame([], "item_id long, text string")
    benchmark = spark.createDataFrame(case[1], "item_id long, text string")
    assert decontaminate.contamination(documents([]), benchmark).collect() == []
    assert {r["n_hit"] for r in decontaminate.contamination(documents(case[0]), none).collect()} \
        == {0}
    kept = decontaminate.decontaminate(documents(case[0]), none)
    assert kept.count() == len(case[0])


def test_passages_are_cut_and_copies_go(spark, documents):
    passage = " ".join(f"q{i}" for i in range(12))
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    clean = " ".join(f"c{i}" for i in range(40))
    rows = [(1, f"{clean}. {passage}! Then {clean}"), (2, passage), (3, clean), (4, None), (5, "")]
    docs = documents(rows)
    out = decontaminate.decontaminate(docs, benchmark)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {
        1: f"{clean}. ! Then {clean}", 3: clean, 4: None, 5: ""}


def test_cut_words():
    assert cut_words(b"one two, three four", [(1, 3)]) == b"one  four"
    assert cut_words(b"one two", [(0, 2)]) == b""


def test_automaton_lengths():
    rng = random.Random(2)
    items = [(i, [rng.choice([b"x", b"y", b"z"]) for _ in range(30)]) for i in range(5)]
    automaton = SuffixAutomaton(items)
    runs = {tuple(w[i:j]) for _, w in items for i in range(30) for j in range(i + 1, 31)}
    text = [rng.choice([b"x", b"y", b"z", b"-"]) for _ in range(300)]
    codes = [automaton.words.get(w, 0) for w in text]
    for end, (_, length) in enumerate(automaton.stream(codes), 1):
        longest = max((n for n in range(min(end, 30) + 1)
                       if n == 0 or tuple(text[end - n:end]) in runs))
        assert length == longest
