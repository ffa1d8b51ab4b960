import random
import re
from collections import Counter, defaultdict

import pytest

from visittrail.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, digest long, term string, n long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    words = [(lang or "", source or "", re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER)))
        for text, lang, source in rows]
    df, counts, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, own in words:
        sources[lang].add(source)
        df[lang].update(set(own))
        counts[lang, source].update(own)
    out = set()
    for lang, names in sources.items():
        kept = sorted(t for t, n in df[lang].items() if n >= least)

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        whole = shares(sum((counts[lang, s] for s in names), Counter()))
        of = {s: shares(counts[lang, s]) for s in names}
        for s in names:
            pairs = [(-sum(abs(of[s][t] - of[o][t]) for t in kept), o.encode())
                     for o in names if o != s]
            own = [(whole[t] - of[s][t], t.encode()) for t in kept
                   if counts[lang, s][t] and of[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(own)[:top])):
                out |= {(lang, s, part, item.decode(), -value, i)
                        for i, (value, item) in enumerate(found, 1)}
    return out


@pytest.fixture(scope="module")
def rows(odd):
    rng = random.Random(11)
    vocabulary = ["The", "the", "x1y", "é", "Été", "a_b", "z", *(f"w{chr(97 + i % 26)}{'q' * (i // 26)}"
                                                                for i in range(120))]
    made = []
    for _ in range(400):
        own = rng.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rng.randrange(30))
        made.append((" ".join(own), rng.choice(["en", "en", "fr", None, "EN"]),
                     rng.choice(["hot", "hot", "hot", "b", "c", None, "B"])))
    made += [("rare words only", "xx", "s1"), (None, "xx", "s2"), ("1 2 3", "one", "alone")]
    return made + [(t, "en", "odd") for _, t in odd]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, *r, 1, "t", 2) for i, r in enumerate(rows)], SCHEMA).repartition(5)


def found(docs, **more):
    out = divergence.divergence(docs, **more)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    collected = [tuple(r) for r in out.collect()]
    assert len(collected) == len(set(collected))
    return set(collected)


def test_equals_counting(spark, rows):
    expected = brute(rows, 9, 7)
    assert any(r[0] == "xx" and r[2] == "pair" and r[4] == 0 for r in expected)
    assert found(frame(spark, rows), least_docs=9, top=7) == expected


def test_colliding_digests_are_told_apart(spark, rows):
    assert found(frame(spark, rows), least_docs=9, top=7, digest_bits=5) == brute(rows, 9, 7)


@pytest.mark.parametrize("bits", [5, 64])
def test_small_tasks_and_blocks(spark, rows, bits):
    few = dict(held_terms=20, salt_bytes=1000, cells=15, sources=2, digest_bits=bits)
    assert found(frame(spark, rows), least_docs=9, top=3, **few) == brute(rows, 9, 3)


def test_many_sources(spark):
    rows = [(f"alpha beta {'gamma ' * (i % 7)}", "en", f"s{i}") for i in range(60)]
    assert found(frame(spark, rows), least_docs=3) == brute(rows, 3, 50)


def test_empty_table(spark):
    assert found(frame(spark, [])) == set()
