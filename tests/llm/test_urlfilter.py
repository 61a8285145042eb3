import random

import numpy as np
import pytest

from tabeval.llm import urlfilter
from tabeval.llm.queries import URL_RULES

SCHEMA = "page_id bigint, url string, host int, keys string, rule string"


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def run(spark, urls, rules=URL_RULES, **more):
    frame = spark.createDataFrame([(i, u, 1, "k", "r") for i, u in urls], SCHEMA)
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(frame, listed, **more).collect()}


ODD = [None, "", "no scheme", "http://", "://", "HTTP://EXAMPLE.COM/en/x", "https://WWW.Example.com/en/", "http://notexample.com/en/", "http://example.com", "http://example.com/en",
       "http://example.com?x=/en/", "http://a.b.example.com/en/#f", "http://x.net/fr/?q#z", "http://net/es/", "http://.com/", "http://com./", "a://b://com/en/", "http://ÄÖ.com/é", "http://com/" + "x" * 5000]


@pytest.mark.parametrize("more", [{}, {"max_bytes": 0}])
def test_same_as_matching_every_rule(spark, more):
    """Also with a list that no cascade may hold."""
    rng = random.Random(1)
    labels = ["www", "m", "example", "com", "net", "org", "a"]
    urls = ODD + [f"http://{'.'.join(rng.choices(labels, k=rng.randint(1, 4)))}/{rng.choice(['en/', 'fr/', 'es/', '', 'EN/', 'en'])}{rng.choice(['', 'x', '?a', '#en/'])}" for _ in range(400)]
    got = run(spark, list(enumerate(urls)), **more)
    assert got == {i: plain(u, URL_RULES) for i, u in enumerate(urls)}


def test_long_lists(spark):
    rng = random.Random(2)
    hosts = [f"h{i}.com" for i in range(3000)]
    rules = [(h, rng.choice(["/", "/p/"]), rng.choice(["allow", "block"])) for h in hosts[:1500]]
    urls = list(enumerate(f"http://{rng.choice(['', 'w.'])}{h}{rng.choice(['/', '/p/', '/q'])}" for h in hosts))
    assert run(spark, urls, rules) == {i: plain(u, rules) for i, u in urls}


def test_no_rules_null_keys_and_empty_tables(spark):
    assert run(spark, [(None, "http://a.com/"), (1, "x")], []) == {None: ("a.com", "/", None, "allow"), 1: ("", "", None, "allow")}
    assert run(spark, []) == {}


def test_a_cascade_is_exact_over_its_universe(spark):
    rng = np.random.default_rng(3)
    keys = rng.integers(-(2**63), 2**63 - 1, (5000, 2))
    universe = spark.createDataFrame([tuple(map(int, k)) for k in keys], "h1 bigint, h2 bigint")
    listed = universe.limit(0).union(spark.createDataFrame([tuple(map(int, k)) for k in keys[::4]], "h1 bigint, h2 bigint"))
    levels = urlfilter.cascade(listed, universe)
    assert len(levels) > 2  # the first level takes some by mistake
    expected = np.zeros(5000, dtype=bool)
    expected[::4] = True
    assert (urlfilter.member(levels, keys[:, 0].copy(), keys[:, 1].copy()) == expected).all()
