import math
from collections import defaultdict

import pytest

from stallkeeper.llm import url_model
from stallkeeper.llm.queries import URL_RULES
from stallkeeper.llm.url_model import judge_urls


def pages_of(spark, urls):
    rows = [(i, u, "x", "y") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule string")


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("https://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
        ("http://x.com/de/a", "x.com", "/de/a", "com/de/", "block"),
        ("http://x.org", "x.org", "", None, "allow"),
        ("http://x.org?a/b", "x.org", "", None, "allow"),
        ("x.org/a", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    r = judge_urls(pages_of(spark, [url]), URL_RULES).first()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_model_equals_a_plain_one(spark):
    """Scores of URLs without a rule, computed with dictionaries."""
    import hashlib

    urls = [f"http://good{i % 7}.org/fine/{i}" for i in range(60)]
    urls += [f"http://example.org/es/bad/{i}{i}" for i in range(60)]
    urls += [f"http://x.net/{w}/{i}" for i in range(5) for w in ("fine", "es/bad")]
    found = judge_urls(pages_of(spark, urls), URL_RULES).collect()
    n = url_model.ORDER
    counts = {c: defaultdict(int) for c in "ar"}
    contexts = {c: defaultdict(int) for c in "ar"}

    def grams(r):
        text = "\x02" * (n - 1) + r.host + r.path + "\x03"
        return [text[i : i + n] for i in range(len(text) - n + 1)]

    seen = set()
    for r in found:
        text = r.host + r.path
        if r.rule and text not in seen:
            seen.add(text)
            if hashlib.md5(text.encode()).hexdigest()[0] not in "0123":
                c = "r" if r.verdict == "block" else "a"
                for g in grams(r):
                    for k in range(1, n + 1):
                        counts[c][g[n - k :]] += 1
                        contexts[c][g[n - k : -1], k] += 1

    def p(c, g):
        if not g:
            return 1 / url_model.ALPHABET
        w = url_model.WEIGHT
        return (counts[c][g] + w * p(c, g[1:])) / (contexts[c][g[:-1], len(g)] + w)

    verdicts = defaultdict(set)
    for r in found:
        if not r.rule:
            ratios = [math.log(p("r", g)) - math.log(p("a", g)) for g in grams(r)]
            assert math.isclose(r.score, sum(ratios) / len(ratios), rel_tol=1e-9)
            verdicts["bad" in r.path].add(r.verdict)
    assert verdicts == {True: {"block"}, False: {"allow"}}


def test_empty_table_and_no_rules(spark):
    assert judge_urls(pages_of(spark, ["a"]).limit(0), URL_RULES).collect() == []
    r = judge_urls(pages_of(spark, ["http://x.org/a"]), {}).first()
    assert (r.rule, r.verdict, r.log_odds) == (None, "allow", None)
