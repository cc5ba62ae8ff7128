"""URL parsing and rules against brute force; the template tree."""
import random
import re

from starledger.llm import url_filter as uf

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for verdict, rule in RULES:
        name, slash, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + tail):
            if best is None or len(rule) > len(best[1]):
                best = verdict, rule
    return host, path, best and best[1], best and best[0]


URLS = [None, "", "no scheme/en/", "http://", "http://WWW.Example.COM/en/1?x#y", "https://example.com/en/", "http://example.com/en",
        "http://badexample.com/en/x", "http://a.net/es/1", "http://net/fr/", "http://x.net?/es/", "http://a.com", "http://É.COM/q",
        "http://a.org/" + "x/" * 300, "a://b://c/d", "http://h.org/\n/x", "http://x.NET#/fr/", "http://*/*/**"]


def test_parse_and_rules_match_brute_force(spark):
    urls = URLS + [f"http://h{i % 5}.org/en/{i}" for i in range(40)]
    rows = [(i, u, "junk", 1) for i, u in enumerate(urls)] + [(None, "http://a.com/x", "junk", 1), (3, "http://", "junk", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, template int")
    got = uf.filter_urls(pages, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is None:
            continue
        host, path, rule, verdict = brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), r
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    assert uf.filter_urls(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in uf.filter_urls(pages, []).collect()} == {"allow"}


def test_tree_generalises_merges_and_rejects(spark):
    rnd = random.Random(2)
    urls, labels = [], []
    for i in range(400):
        word = "".join(rnd.choice("abcdefgh") for _ in range(8))
        urls += [f"http://shop.org/deal/{word}", f"http://shop.org/news/{word}", f"http://other.org/deal/{word}"]
        if i % 2:
            labels += [(urls[-3], 1), (urls[-2], 0)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = uf.filter_urls(pages, [], labels=spark.createDataFrame(labels, "url string, bad int")).collect()
    by = {}
    for r in got:
        by.setdefault((r.host, r.template), set()).add(r.verdict)
    assert by == {("shop.org", "/deal/*"): {"block"}, ("shop.org", "/news/*"): {"allow"},
                  ("other.org", "/deal/*"): {"block"}}  # no labels of its own: the template's rate over all hosts


def test_branches_that_differ_deep_in_the_path(spark):
    stem = "http://deep.org/" + "/".join(f"l{c}" for c in "abcdefghijk")      # eleven levels in common
    pages = [(i, f"{stem}/{'bad' if i % 2 else 'good'}/w{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(200)]
    labels = spark.createDataFrame([(u, i % 2) for i, u in pages[:100]], "url string, bad int")
    got = uf.filter_urls(spark.createDataFrame(pages, "page_id long, url string"), [], labels=labels).collect()
    assert {(r.page_id % 2, r.verdict) for r in got} == {(0, "allow"), (1, "block")}
    assert all(r.template.endswith("/*") and r.template.count("/") == 13 for r in got)


def test_one_path_of_very_many_segments_takes_no_job_each(spark):
    pages = spark.createDataFrame([(1, "http://a.org/" + "x/" * 900), (2, "http://a.org/" + "x/" * 900 + "/"), (3, "http://a.org/y"),
                                   (4, "http://b.org/" + "z/" * 500)], "page_id long, url string")
    rows = {r.page_id: r.template for r in uf.filter_urls(pages, []).collect()}
    assert rows == {1: "/x" * 900, 2: "/x" * 900, 3: "/y", 4: "/z" * 500}
