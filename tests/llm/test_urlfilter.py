import random
import re
from collections import Counter

import pytest

from visittrail.llm import urlfilter

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return m[1].translate(UPPER), m[2]


def brute(rows, rules, default="allow"):
    out = []
    for page, url in rows:
        host, path = parts(url)
        fits = [(len(h + (p or "")), len(h), h + (p or ""), v) for h, p, v in rules
                if h and v and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
        best = min(fits, key=lambda x: (-x[0], -x[1], x[3]), default=None)
        out.append((page, host, path, best and best[2], best[3] if best else default))
    return Counter(out)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    labels = ["a", "b", "net", "org", "x,y", "A", "", "é", "a-b", "b:80"]
    paths = ["", "/", "/en", "/en/", "/en/a", "/en/a/b", "/é", "/e", "//"]
    hosts = [".".join(rng.choices(labels, k=rng.randrange(1, 5))) for _ in range(40)]
    rules = [(rng.choice(hosts).lower(), rng.choice(paths), rng.choice(["block", "allow"]))
             for _ in range(60)]
    rules += [("net", "/", "block"), (None, "/", "block"), ("", "/", "block"), ("net", None, "allow"),
              ("b", "/", None), ("net", "/", "block")]
    urls = [(i, f"http://{rng.choice(hosts)}{rng.choice(paths)}"
             f"{rng.choice(['', 'z', '?q=1', '#f', '/x://y'])}") for i in range(800)]
    urls += [(None, None), (900, ""), (901, "net/"), (902, "://net/"), (903, "ftp://NET/" + "a" * 99999),
             (904, "http://net/\n?x")] + [(905, "http://a.net/en/a")] * 300
    return urls, rules


def test_equals_every_rule_for_every_url(spark, case):
    urls = spark.createDataFrame([(*u, "x") for u in case[0]],
                                 "page_id long, url string, host string").repartition(5)
    rules = spark.createDataFrame(case[1], "host string, path string, verdict string")
    out = urlfilter.judged(urls, rules, keep=("page_id",))
    assert Counter(map(tuple, out.collect())) == brute(*case)


def test_empty_tables(spark, case):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    urls = spark.createDataFrame(case[0], "page_id long, url string")
    out = urlfilter.judged(urls, none, keep=("page_id",), default="block").collect()
    assert Counter(map(tuple, out)) == brute(case[0], [], "block")
    assert urlfilter.judged(urls.limit(0), none, keep=("page_id",)).collect() == []
