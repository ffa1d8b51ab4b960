import random
from collections import Counter, defaultdict

import pytest

from visittrail.llm import linededup


def brute(rows, ratio=0.1, least=5):
    pages = defaultdict(set)
    for _, text, host in rows:
        if text is not None:
            pages[host].add(text)
    bad = {}
    for host, texts in pages.items():
        counts = Counter(line for t in texts for line in set(t.split("\n")) if line.strip(" "))
        bad[host] = {x for x, n in counts.items() if n >= least and n > ratio * len(texts)}
    return Counter(
        (i, text if text is None else "\n".join(
            x for x in text.split("\n") if x not in bad[host]))
        for i, text, host in rows)


@pytest.fixture(scope="module")
def rows(odd):
    rng = random.Random(6)
    lines = ["menu", "about us", "", "  ", "footer\t", *(f"line {i}" for i in range(400))]
    made = []
    for i in range(200):
        own = rng.choices(lines[5:], k=rng.randrange(8)) + rng.choices(lines[:5], k=2)
        made.append((i, "\n".join(own), rng.choice(["a", "a", "a", "b", None])))
    made += [(300 + i, "a copied page\nof two lines", "a") for i in range(50)]
    return made + [(i, t, "odd") for i, t in odd]


def test_equals_counting(documents, rows):
    docs = documents(rows)
    out = linededup.line_dedup(docs)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == brute(rows)


def test_large_lists_meet_pages_by_copy(documents, rows):
    docs = documents(rows)
    out = linededup.line_dedup(docs, sent_bytes=0, dropped="N_Chars")
    assert out.columns == [*(c for c in docs.columns if c != "n_chars"), "N_Chars"]
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == brute(rows)
    assert "BroadcastExchange" not in linededup.line_dedup(
        docs, sent_bytes=0)._jdf.queryExecution().optimizedPlan().toString()


def test_copies_of_a_page_stay(documents, rows):
    out = linededup.line_dedup(documents(rows), dropped="n").filter("doc_id between 300 and 349")
    assert {(r["text"], r["n"]) for r in out.collect()} == {("a copied page\nof two lines", 0)}


def test_dropped_lines_are_counted(documents):
    rows = [(i, f"top\nown {i}\ntop", "h") for i in range(6)] + [(9, None, "h")]
    out = linededup.line_dedup(documents(rows), dropped="n").collect()
    assert {(r["doc_id"], r["text"], r["n"]) for r in out} == {
        *((i, f"own {i}", 2) for i in range(6)), (9, None, 0)}


def test_empty_table(documents):
    assert linededup.line_dedup(documents([])).collect() == []


def test_plan_has_no_python(documents, rows):
    plan = linededup.line_dedup(documents(rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
