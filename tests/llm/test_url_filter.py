import re

from claimspark.llm import url_filter as U

URLS = [None, "", "no scheme", "http://x.org", "http://X.ORG/", "https://a.example.org/es/1", "https://example.org/en/1",
        "https://example.org/en/19?utm_source=x", "https://example.org/en/2", "https://notexample.org/es/1", "https://b.com/fr/",
        "https://b.com/frx", "https://b.com/de/?page=2", "https://b.com?/de/", "http://b.net/q?page=3", "http://b.net/#page=3",
        "http://é.COM/fr/ü", "x://y.com/de/://z.org/", "://com/de/", "http://b.net/login", "http://b.net/?sessionid=4&utm_source=1",
        "http://org/", "http://a.b.net/print/77?x", "http://com/FR/", "http://b.com/de/\nx", "a" * 50_000 + "://q.com/de/"]


def expected(url, rules):
    if url is None or "://" not in url:
        return "", "", None, None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for r in rules:
        if r.is_host:
            h, slash, p = r.text.partition("/")
            fits += [r] * ((host == h or host.endswith("." + h)) and path.startswith(slash + p))
        else:
            fits += [r] * bool(re.search(r.pattern, url))
    best = min(fits, key=lambda r: (not r.is_host, -len(r.text), r.text), default=None)
    return host, path, best.text if best and best.is_host else None, best.text if best and not best.is_host else None, \
        best.verdict if best else "allow"


def test_rules_against_brute_force(spark):
    rules = U.HOST_RULES + U.PATTERN_RULES
    rows = [(i, u, "extra", "clash") for i, u in enumerate(URLS)] + [(None, URLS[5], "", ""), (6, URLS[6], "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, token string")
    got = U.judge_urls(pages, rules).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.pattern_rule, r.verdict) == expected(r.url, rules), r.url
    assert U.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in U.judge_urls(pages, ()).collect()} == {"allow"}


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.createDataFrame([(f"http://a{i}.com/de/x",) for i in range(9)] + [("http://b.org/en/1",)], "url string")
    rules = U.rule_frame(spark, U.HOST_RULES + (U.pattern_rule("block", "x$"),))
    got = {r.rule: r.token for r in U.index_rules(urls, rules).collect()}
    assert got["com/de/"] in ("com", "de") and got["org/"] == "org" and got["x$"] == ""
    assert got["example.org/es/"] in ("es", "example")
