import re

from txflow.llm import url_rules
from txflow.llm.queries import URL_RULES
from txflow.llm.url_rules import judge_urls, rules_frame

from .conftest import plain


def brute(url, rules, default="allow"):
    rest = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


RULES = [*URL_RULES, ("block", "example.com", "/"), ("allow", "b.example.com", "/x/"), ("block", "example.com", "/x/y/"),
         ("allow", "a,b.com", "/"), ("block", "com", "/en"), ("block", "b.c.d.e.f.g.com", "/")]
URLS = [None, "", "no scheme", "http://", "http://COM/", "http://com", "https://Example.com/en/1?x#y", "http://www.example.com/en/z",
        "http://a.b.example.com/x/y/z", "http://b.example.com/x/y/z", "http://example.com/x/y", "ftp://a,b.com/", "http://b.a.com/en",
        "http://user@host.net:80/es/1", "http://x.net/es/1", "http://net/fr/", "x://y://com/", "http://É.com/", "http://..com//",
        "http://a.b.c.d.e.f.g.com/q", "http://com?x/", "http://com#/x", "http://example.com/" + "x/" * 5000]


def frame(spark, urls):
    return spark.createDataFrame([(i if i else None, u, "h", "k", "r") for i, u in enumerate(urls)],
                                 "page_id long, url string, host string, key string, rule string")


def test_brute_force_over_odd_urls(spark):
    urls = URLS + URLS[5:9]
    got = judge_urls(frame(spark, urls), rules_frame(spark, RULES)).collect()
    assert plain(got) == plain((i if i else None, *brute(u, RULES)) for i, u in enumerate(urls))


def test_ranges_do_not_change_the_answer(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "shuffle_width", lambda s: 7)
    urls = [f"http://{h}.example.com/{p}/{i}" for i in range(60) for h in ("a", "www", "b.c") for p in ("en", "x", "x/y")]
    got = judge_urls(frame(spark, urls), rules_frame(spark, RULES)).collect()
    assert plain(got) == plain((i if i else None, *brute(u, RULES)) for i, u in enumerate(urls))


def test_empty_tables_and_rules(spark):
    assert judge_urls(frame(spark, URLS).limit(0), rules_frame(spark, RULES)).count() == 0
    none = rules_frame(spark, RULES).limit(0)
    assert {r["verdict"] for r in judge_urls(frame(spark, URLS), none, default="block").collect()} == {"block"}


def test_unusable_and_repeated_rules(spark):
    rules = [("block", None, "/"), ("block", "", "/"), ("block", "com", None), ("block", "com", "en"),
             ("block", "COM", "/a"), ("allow", "com", "/a")]
    got = judge_urls(frame(spark, ["http://com/x", "http://com/x", "http://com/a"]), rules_frame(spark, rules)).collect()
    assert sorted((r["rule"], r["verdict"]) for r in got if r["rule"]) == [("com/a", "allow")]
