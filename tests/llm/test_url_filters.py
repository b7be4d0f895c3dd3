"""URL rules against trying every rule on every url."""

import random

from formspark.llm import url_filters
from formspark.llm.queries import URL_RULES
from pyspark.sql import functions as F

RULES = [*URL_RULES, ("example.org/en/", "allow"), ("x", "block"), ("a.b/c/d", "block"), ("b/c/", "allow"), ("t.st/(a)", "block")]


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, path = rest[:cut], rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] + [len(path)])]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len(rule), verdict == "block", rule, verdict))
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_random_urls(llm):
    r = random.Random(6)
    hosts = ["example.org", "www.Example.ORG", "notexample.org", "a.com", "com", "org", "x", "y.x", "a.b", "q.a.b", "b", "t.st", "É.org", ""]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12", "/en/", "/de/x", "/fr/", "/c/", "/c/d", "/c/de", "/(a)", "//es/"]
    urls = [r.choice(["http://", "https://", "://", "x:", ""]) + r.choice(hosts) + r.choice(paths) + r.choice(["", "?q=/es/", "#a?b", "/z\n"])
            for _ in range(400)] + [None, "", "http://a.com/http://b.org/", "http://" + "w" * 50_000 + ".org/"]
    df = llm.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in url_filters.judge(df, RULES).collect()}
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls)}


def test_defined_cases(llm):
    df = llm.createDataFrame([(1, "http://a.org/"), (1, "http://a.org/"), (None, None)], "page_id long, url string")
    df = df.withColumns({"host": F.lit(1), "rule": F.lit(2), "token": F.lit(3), "n": F.lit(4)})
    got = url_filters.judge(df, URL_RULES)
    assert sorted((str(x.page_id), x.rule, x.verdict) for x in got.collect()) == [("1", "org/", "allow")] * 2 + [("None", None, "allow")]
    assert url_filters.judge(df.limit(0), URL_RULES).count() == 0
    assert {x.verdict for x in url_filters.judge(df, [], default="block").collect()} == {"block"}
