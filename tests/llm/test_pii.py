import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from visittrail.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def sound(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def brute(text):
    spans = sorted(
        (m.start(), rank, m.end(), kind)
        for rank, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "") if sound(kind, m.group()))
    return spans


def written(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def got(docs, **options):
    found = pii.personal_data(docs, **options).select(
        "doc_id", pii.written(F.col("base")).alias("base"),
        pii.written(F.col("added")).alias("added"))
    return [tuple(r) for r in found.collect()]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    parts = [
        "ann.b@mail.example.com", "x@y", "@a.b", "a@b@c.d", "a@b.c_d@e.f", "a@b..c", "a@b.c.",
        "a@b-.c-", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.4", "1.2.3", "..1.2.3.4",
        "4111 1111 1111 1111", "4111-1111-1111-1111", "4111  1111", "4984250489669609",
        "+1 (988) 555-2485", "+44 20 7946 0958 ext", "+1-", "++12345678901", "+12345678", "+1(((",
        "", "12 3", "é", "\U0001f600", " ", " ", "-", ".", "word", "\n", "12345", "@",
        "+", "%", "id7", "٣.٣.٣.٣",
    ]
    return [(i, "".join(rng.choices(parts, k=rng.randrange(1, 25)))) for i in range(300)]


def test_base_spans_are_those_of_the_patterns(documents, texts, odd):
    rows = texts + odd
    # Matching one number of 50,000 digits the plain way takes the regular expression too long.
    expected = Counter((i, written(brute(t) if len(t or "") != 50_000 or not t.isdigit() else []))
                       for i, t in rows)
    found = Counter((i, base) for i, base, _ in got(documents(rows)))
    assert found == expected


def test_contexts_find_what_patterns_miss(documents):
    rows = [(i, f"some text then call me {'' if i % 2 else 'now '}at number "
                f"+1 (555) 010-{1000 + i} soon") for i in range(20)]
    rows += [(100, "so it goes at number 5550109999, good"), (101, "page 5550109999 of it"),
             (102, "text at number é and on"), (103, "At  NUMBER x7-y8."), (104, None)]
    found = {i: added for i, _, added in got(documents(rows))}
    assert found[100] == "phone:21:31"
    assert found[101] == ""
    assert found[103] == "phone:11:16"
    assert not any(found[i] for i in range(20))


def test_mixed_contexts_are_not_trusted(documents):
    rows = [(i, f"see item +1 (555) 010-{1000 + i} soon") for i in range(20)]
    rows += [(100 + i, f"see item {i}77") for i in range(20)]
    assert not any(added for _, _, added in got(documents(rows)))


def words_of(text, spans):
    """(start, end, value, patterns, seed) of identifier-like words, as the operator sees them."""
    out, ends = [], -1
    found = list(re.finditer(r"(?<!\S)[^\s0-9@]*[0-9@]\S*", text))
    for n, m in enumerate(found):
        end = m.start() + len(m.group().rstrip(".,;:!?)]}\"'>"))
        later = found[n + 1].start() if n + 1 < len(found) else len(text) + 1
        inside = any(s[0] < m.start() < s[2] for s in spans)
        own = next((s for s in spans if m.start() <= s[0] < min(end, later)), None)
        if inside:
            continue
        value = text[own[0]:own[2]] if own else text[m.start():end]
        gap = text[found[n - 1].end() if n else 0:m.start()]
        left = re.sub("[0-9]+", "0", gap[-64:].lower()).split()
        gap = text[m.end():later if n + 1 < len(found) else len(text)]
        right = re.sub("[0-9]+", "0", gap[:64].lower()).split()[:1]
        if own and own[2] > end:
            right = []
        shape = re.sub("[A-Z]+", "A", re.sub("[a-z]+", "a", re.sub("[0-9]", "9", value)))
        patterns = [f"l{k} " + " ".join(left[-k:]) for k in (1, 2, 3) if len(left) >= k]
        patterns += [f"r {right[0]}"] if right else []
        patterns += [f"lr {left[-1]} {right[0]}"] if left and right else []
        patterns += [f"ls {left[-1]} {shape[:64]}"] if left else []
        out.append((m.start(), end, value, patterns, own[3] if own else None))
    return out


def bootstrap(texts, trust=0.9, least=5, rounds=20):
    """The whole method over, in plain Python: added spans by document."""
    words = [(i, *w) for i, t in texts for w in words_of(t, brute(t))]
    edges, seeds = {}, {}
    for _, _, _, value, patterns, seed in words:
        for p in patterns if value else ():
            edges.setdefault(p, {}).setdefault(value, set()).update({seed} - {None})
    scores, good = {}, {}
    for _ in range(rounds):
        old, good = (dict(scores), dict(good)), {}
        for p, values in edges.items():
            for k in PATTERNS:
                total = sum(1.0 if k in s else 0.0 if s else scores.get((v, k), 0.0)
                            for v, s in values.items()) / len(values)
                if total >= trust and sum(k in s for s in values.values()) >= least:
                    good[p, k] = total
        best = {}
        for (p, k), score in good.items():
            for v, s in edges[p].items():
                if not s:
                    key = (v, k, p.split(" ")[0])
                    best[key] = max(best.get(key, 0), score)
        doubt = {}
        for (v, k, _), score in best.items():
            doubt[v, k] = doubt.get((v, k), 1.0) * max(1 - score, 1e-9)
        scores = {key: 1 - d for key, d in doubt.items()}
        if old == (scores, good):
            break
    added = {i: [] for i, _ in texts}
    for i, start, end, value, patterns, seed in words:
        kinds = [k for k in PATTERNS if scores.get((value, k), 0) >= trust
                 and any((p, k) in good for p in patterns)]
        if not seed and kinds:
            kind = max(kinds, key=lambda k: scores[value, k])
            added[i].append(f"{kind}:{start}:{end}")
    return {i: ",".join(x) for i, x in added.items()}


def test_bootstrap_equals_plain_python(documents):
    rng = random.Random(21)
    lead = ["mail to", "write", "number is", "call", "from host", "see item", "the", "so"]
    tail = ["today", "or not", "please", ".", ""]
    make = {
        "phone": lambda: f"+1 (555) 010-{rng.randrange(1000, 9999)}",
        "email": lambda: f"u{rng.randrange(999)}@mail.example.com",
        "ip": lambda: f"10.0.{rng.randrange(255)}.{rng.randrange(255)}",
        "item": lambda: f"x{rng.randrange(99)}", "local": lambda: f"user{rng.randrange(99)}@intranet",
        "short": lambda: f"555-{rng.randrange(1000, 9999)}",
    }
    fits = {"mail to": ["email", "email", "email", "local"], "write": ["email", "local"],
            "number is": ["phone"] * 30 + ["short"], "call": ["phone"] * 12 + ["short"],
            "from host": ["ip"], "see item": ["item", "ip"], "the": list(make), "so": list(make)}
    rows = []
    for i in range(400):
        start = rng.choice(lead)
        rows.append((i, f"some {start} {make[rng.choice(fits[start])]()} {rng.choice(tail)}"))
    expected = bootstrap(rows)
    assert sum(x != "" for x in expected.values()) >= 5
    assert {i: added for i, _, added in got(documents(rows))} == expected


def test_long_identifiers_are_found(documents):
    rows = [(i, f"write to u{i}@mail.example.com now") for i in range(30)]
    long = "u" * 5000 + "@intranet"
    rows += [(100, f"please write to {long} now"), (101, "." * 1_000_000), (102, "1" + "." * 1_000_000)]
    found = {i: added for i, _, added in got(documents(rows))}
    assert found[100] == f"email:16:{16 + len(long)}"


def test_empty_table(documents):
    assert got(documents([])) == []


def test_plan_has_no_python(documents, texts):
    plan = pii.personal_data(documents(texts))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_digest(documents):
    text = "a@b.cc and 1.2.3.4"
    row = pii.personal_data(documents([(1, text)])).select(
        F.sha2(pii.written(F.col("base")), 256)).first()
    assert row[0] == hashlib.sha256(b"email:0:6,ip:11:18").hexdigest()
