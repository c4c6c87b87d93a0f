from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from merchlens.llm import url_filter as uf


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://A.Example.NET/en/1?x=/#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://example.net/de/", "example.net", "/de/", "net/", "block"),
        ("https://example.net", "example.net", "", None, None),
        ("ftp://badexample.net/en/", "badexample.net", "/en/", "net/", "block"),
        ("http://m.example.com/de/5", "m.example.com", "/de/5", "example.com/de/", "block"),
        ("http://notexample.com/de/5", "notexample.com", "/de/5", None, None),
        ("x://z.org/fr/?u=a://b.net/", "z.org", "/fr/", "org/fr/", "allow"),
        ("no scheme.net/", "", "", None, None),
        ("http://ÄB.Org#f", "Äb.org", "", None, None),
        ("a\nb://c.net/\nd", "c.net", "/\nd", "net/", "block"),
        ("", "", "", None, None),
        (None, "", "", None, None),
    ],
)
def test_rules(llm, url, host, path, rule, verdict):
    df = llm.createDataFrame([(1, url)], "page_id bigint, url string")
    h, p = uf.host_and_path(F.col("url"))
    r, v = uf.matched_rule(h, p)
    assert tuple(df.select(h, p, r, v).first()) == (host, path, rule, verdict)


def urls(n=400):
    rng, out = random.Random(0), []
    for _ in range(n):
        host = rng.choice(["a", "bb", "shop"]) + rng.choice([".example.net", ".example.com", ".other.org"])
        out.append(f"http://{host}/{rng.choice(['en', 'de', 'fr'])}/{rng.choice(['news', 'spam', 'Ünï'])}{rng.randint(0, 99)}")
    return out + [None, "", "plain", out[0]]


def cells(url):
    out, two, one = [], 0, 0
    for c in url or "":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else "0" if c in "0123456789" else c
        code = uf.LETTERS.find(c) + 1 or uf.SIZE - 1
        out.append((two, one, code))
        two, one = one, code
    return out


def brute_model(lists):
    three = Counter(x for cells_ in lists for x in cells_)
    two, alone = Counter(), Counter()
    for (_, b, c), n in three.items():
        two[b, c] += n
        alone[c] += n

    def p(a, b, c):
        value = (alone[c] + 1) / (sum(alone.values()) + uf.SIZE)
        after = [n for (x, _), n in two.items() if x == b]
        if after:
            value = (two[b, c] + len(after) * value) / (sum(after) + len(after))
        after = [n for (x, y, _), n in three.items() if (x, y) == (a, b)]
        if after:
            value = (three[a, b, c] + len(after) * value) / (sum(after) + len(after))
        return math.log(value)

    return p


def test_scores_match_brute_force(llm):
    pages = llm.createDataFrame([(i, u, "x", 1.0) for i, u in enumerate(urls())], "page_id bigint, url string, host string, score double")
    rows = {r.page_id: r for r in uf.filter_urls(pages).collect()}
    held = {r.page_id: r.h for r in pages.select("page_id", (F.pmod(F.xxhash64("url"), F.lit(uf.FOLDS)) == 0).alias("h")).collect()}
    ruled = {i: r.verdict for i, r in rows.items() if r.rule}
    models = {
        v: brute_model([cells(u) for i, u in enumerate(urls()) if ruled.get(i) == v and not held[i]])
        for v in ("allow", "block")
    }
    assert len(rows) == len(urls())
    memo = {}
    for i, u in enumerate(urls()):
        total = 0.0
        for cell in cells(u):
            if cell not in memo:
                memo[cell] = models["allow"](*cell) - models["block"](*cell)
            total += memo[cell]
        assert rows[i].score == pytest.approx(total / len(u) if u else 0.0, abs=1e-9)
    # The threshold separates the calibration URLs as well as any value does, and decides all URLs without a rule.
    free = [r for r in rows.values() if not r.rule]
    allowed, blocked = ([r.score for r in free if r.verdict == v] for v in ("allow", "block"))
    assert min(allowed, default=9) > max(blocked, default=-9)
    good = [rows[i].score for i, v in ruled.items() if held[i] and v == "allow"]
    bad = [rows[i].score for i, v in ruled.items() if held[i] and v == "block"]

    def error(limit):
        return sum(s < limit for s in good) / len(good) + sum(s >= limit for s in bad) / len(bad)

    limit = uf.threshold(llm.createDataFrame([("allow", s) for s in good] + [("block", s) for s in bad], "verdict string, score double"))
    assert error(limit) == pytest.approx(min(error(b * uf.BIN) for b in range(-300, 300)))


def test_one_class_or_none(llm):
    pages = llm.createDataFrame([(1, "http://a.net/x"), (2, "http://b.com/x"), (None, None)], "page_id bigint, url string")
    assert {r.page_id: r.verdict for r in uf.filter_urls(pages).collect()}[1] == "block"
    assert uf.filter_urls(pages.where("false")).count() == 0
