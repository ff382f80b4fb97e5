from __future__ import annotations

import random
import re

import pytest

import __spark_entry__ as contract
from tallymill.llm import url_filters
from tallymill.llm.queries import URL_RULES
from tallymill.llm.url_filters import Index, Rule
from tests.compare import differences, duck
from tests.conftest import SMALL


def plain(url, rules):
    """Every rule tried on the URL, by string comparison."""
    rest = (url or "").partition("://")[2]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(str(r)), len(r.host), r.verdict == "block"), default=None)
    return host, path, best and str(best), best.verdict if best else "allow"


def test_query_equals_sql(spark):
    got = contract.queries()["op13_url_filters"](spark, SMALL).toArrow()
    assert got.num_rows > 0
    assert differences(got, duck(SMALL).sql(contract.oracle_sql()["op13_url_filters"]).to_arrow_table()) == []


URLS = [
    None, "", "no scheme", "://", "http://", "http://ORG", "http://org/", "http://Org/x", "http://a.ORG/EN/1", "http://example.org/en/1",
    "http://example.org/en/12?x=/es/", "http://example.org/en/?1", "http://example.org/es", "http://example.org/es/", "http://notexample.org/es/a",
    "http://www.example.org/es/#a://b", "https://a.com/fr/x", "https://a.com/FR/x", "https://a.com/de/", "https://com/de/", "https://acom/de/",
    "a://b://c.com/de/", "http://c.com:80/de/", "http://u@c.com/de/", "http://c.com.net/de/", "http://c.com?/de/", "http://c.com\n/de/x\ny", "http://é.org/日本",
    "http://İ.com/de/" + "x" * 100_000, "//c.com/de/", "http://.org/", "http://org./", "http:///org/",
]


def test_odd_urls(spark):
    rows = [(i if i % 7 else None, url, "x", "y") for i, url in enumerate(URLS)] + [(1, URLS[1], None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string").repartition(3)
    got = url_filters.judged(pages, URL_RULES)
    expected = [(i, *plain(url, URL_RULES)) for i, url, _, _ in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert url_filters.judged(pages.limit(0), URL_RULES).collect() == []
    assert {r.verdict for r in url_filters.judged(pages, [], unlisted="block").collect()} == {"block"}


@pytest.mark.parametrize("seen", [None, {"a": 100, "b": 3}])
def test_the_index_finds_what_trying_every_rule_finds(seen):
    draw = random.Random(6)
    name = lambda: draw.choice(["a", "b", "ab", "c", "é"])
    host = lambda: ".".join(name() for _ in range(draw.randrange(1, 4)))
    path = lambda: "/" + draw.choice(["/", "-", ""]).join(name() for _ in range(draw.randrange(0, 4))) + draw.choice(["", "/"])
    rules = [Rule(draw.choice(["allow", "block"]), host(), draw.choice(["", path()])) for _ in range(150)]
    index = Index(rules, seen)
    fetched = 0
    for _ in range(3000):
        url = f"http://{host()}{draw.choice(['', path()])}{draw.choice(['', '?q', '#f'])}"
        h, p, rule, verdict = plain(url, rules)
        hit = index.fitting(h, p)
        assert (hit and str(hit), hit.verdict if hit else "allow") == (rule, verdict)
        fetched += len(index.candidates(h + p))
    assert fetched < 0.5 * 3000 * len(index.rules)


def test_rules_lie_under_their_rarest_token():
    rules = [Rule("block", "example.org", "/ads/banner"), Rule("block", "example.org", "/ads/x|"), Rule("block", "example.org", "/a*b/c/*d")]
    assert [r.tokens() for r in rules] == [["example", "org", "ads"], ["example", "org", "ads", "x"], ["example", "org", "c"]]
    index = Index(rules, {"example": 5, "org": 9, "ads": 2, "x": 1, "c": 7})
    assert {t: [str(index.rules[i]) for i in v] for t, v in index.under.items()} == {
        "ads": ["example.org/ads/banner"], "x": ["example.org/ads/x|"], "example": ["example.org/a*b/c/*d"],
    }


def test_wildcards_ends_and_contradictions():
    index = Index([Rule("allow", "x.org", "/a*z|"), Rule("block", "x.org", "/a"), Rule("allow", "x.org", "/b"), Rule("block", "x.org", "/b"), Rule("block", "y.net")])
    judge = lambda host, path: (lambda r: r and (str(r), r.verdict))(index.fitting(host, path))
    assert judge("x.org", "/a/b/z") == ("x.org/a*z|", "allow")
    assert judge("x.org", "/a/b/zz/y") == ("x.org/a", "block")
    assert judge("w.x.org", "/b1") == ("x.org/b", "block")
    assert judge("y.net", "") == ("y.net", "block") and judge("y.net:80", "") is None and judge("yy.net", "/") is None
    for bad in [("maybe", "a.org", "/"), ("block", "", "/x"), ("block", "a*.org", "/"), ("block", "a.org", "x")]:
        with pytest.raises(ValueError):
            Rule(*bad)
