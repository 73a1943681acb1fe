import random
import re

from tallyspark.llm import url_filter as U


def brute(url):
    """Host, path, rule and verdict from the text of the contract."""
    rest = (url or "").partition("://")
    if not rest[1]:
        host = path = ""
    else:
        host = re.split("[/?#]", rest[2])[0]
        path = re.split("[?#]", rest[2][len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    low = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    count = lambda terms: sum(bool(re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", low)) for t in terms)
    strict, soft = count(U.STRICT), count(U.SOFT)
    allow = rule.allow if rule else not (strict or soft >= U.SOFT_HITS)
    return host, path, rule.name if rule else None, "allow" if allow else "block", strict, soft


def test_against_brute_force(spark):
    rng = random.Random(1)
    hosts = ["example.net", "a.example.net", "xexample.net", "example.com", "B.Example.COM", "org", "x.org", "net", "casino.io", "win-free.io", "é.org", ""]
    paths = ["", "/", "/en/", "/en", "/de/x", "/fr/y/porn", "/sex/hot", "/sexhot", "/win", "/free/free", "/EN/", "/xxx", "?a=://b/c", "#/en/"]
    urls = [f"{s}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?bet=1&poker', '#win'])}" for s in ("http://", "", "ftp://", "x://y://") for _ in range(80)]
    urls += [None, "", "://", "http://", "no scheme poker bonus", "http://h/" + "a" * 50_000 + "/casino", "line\nhttp://x.net/\n/en/"]
    rows = [(k if k % 7 else None, u) for k, u in enumerate(urls)] * 2
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in rows], "page_id long, url string, html string, verdict string")
    found = sorted((tuple(map(str, r)) for r in U.judge(pages).collect()))
    assert found == sorted(tuple(map(str, (i, *brute(u)))) for i, u in rows)
    assert U.judge(pages.limit(0)).collect() == []


def test_terms_inside_terms():
    automaton = U.vocabulary(["porn", "porno"], ["cam", "camp"])
    assert U.hits(automaton, "porno camp") == (1, 1)
    assert U.hits(automaton, "porn-porno.cam/camp/camp") == (2, 2)
    assert U.hits(automaton, "xporn pornx") == (0, 0)
