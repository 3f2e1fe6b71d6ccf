import random
import re

from telemetra.llm import url_rules


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, key string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    return {r.page_id: tuple(r)[1:] for r in url_rules.judge(pages, table).collect()}


def test_equals_brute_force(spark):
    draw = random.Random(8)
    labels, parts = ["net", "com", "org", "example", "a", "b", "xnet", "exa"], ["/", "/en/", "/en", "/de/x", "/fr/", ""]
    urls = ["http://" + ".".join(draw.choices(labels, k=draw.randrange(1, 5))) + draw.choice(parts) + draw.choice(["", "?q=/en/", "#/"]) for _ in range(600)]
    urls += ["https://Hot.Example.NET/en/1"] * 300 + [None, "", "no scheme", "://", "x://ÄB.net/", "a://b://c.net/", "http://net", "http://.net/", "http://net./", "http:// /\n/en"]
    rules = RULES + [(".".join(draw.choices(labels, k=draw.randrange(1, 4))), draw.choice(parts), draw.choice(["allow", "block"])) for _ in range(60)]
    rules += [(None, "/", "block"), ("net", "/", "block"), ("net", "/", "allow")]
    known = [r for r in rules if r[0] is not None]
    for some in (RULES, rules):
        found = judged(spark, urls, some)
        assert found == {i: brute(u, [r for r in some if r in known]) for i, u in enumerate(urls)}


def test_empty_tables(spark):
    assert judged(spark, [], RULES) == {}
    assert judged(spark, ["http://a.net/"], []) == {0: ("a.net", "/", None, "allow")}
