import random

from framelake.llm import urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:n], rest[n:]
    n = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return host.translate({c: c + 32 for c in range(65, 91)}), rest[:n]


def plain(url, rules):
    host, path = split(url)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def check(spark, found, rules, **more):
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(found)], "page_id long, url string, path string")
    got = urls.judged(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), **more)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert got == {k: plain(u, rules) for k, u in enumerate(found)}


def test_given_rules(spark):
    check(spark, ["http://Example.com/en/1", "https://www.example.com/en/", "https://a.www.example.com/en/x?q", "http://xexample.com/en/", "http://example.com", "http://example.com?x=/en/",
                  "http://a.net/es/1", "http://a.net/es", "https://b.net/fr/#t", "http://c.org/en/", "nope", None, "", "://", "a://b://com/", "http://com/\n/x", "ftp://É.COM/"], RULES)


def test_nested_rules_and_parts(spark):
    r = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net"]
    rules = list({(r.choice(hosts), "/" + "".join(r.choice("ab/") for _ in range(r.randrange(5))), r.choice(["allow", "block"])) for _ in range(60)})
    rules = [x for x in rules if not any(y[:2] == x[:2] and y[2] == "block" and x[2] == "allow" for y in rules)]
    found = ["http://" + r.choice([*hosts, "q.a.com", "z.com", "org"]) + "/" + "".join(r.choice("ab/") for _ in range(r.randrange(8))) for _ in range(500)]
    check(spark, found, rules, part_rows=20)


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert urls.judged(pages.limit(0), rules).count() == 0
    assert urls.judged(pages, rules.limit(0)).select("rule", "verdict").collect() == [(None, "allow")]
