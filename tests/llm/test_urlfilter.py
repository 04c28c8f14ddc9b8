from quarry.llm import urlfilter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.b", "", "block"), ("x.org", "/p", "allow"), ("x.org", "/p", "block"), (None, "/", "block"), ("com", None, "block")]
URLS = ["http://x.net/", "http://x.net", "https://EXAMPLE.net/en/a?b", "https://sub.example.net/en", "http://badexample.net/en/", "ftp://example.com/de/?x#y", "example.com/de/", None, "", "://", "http:///path", "http://a.org/fr/x", "http://q.x.org/p/q", "http://x.org?/p", "http://c.a.b#z", "a://b://c/net/", "http://" + "a." * 3000 + "net/" + "x/" * 3000, "http://net/", "http://user@x.net/a\nb"]


def brute(url, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in ((h.lower(), p, v) for h, p, v in RULES if h is not None and p is not None) if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


def test_against_brute_force(spark):
    rows = [(k if k != 3 else None, u) for k, u in enumerate(URLS * 2)]
    df = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, host string, row int").repartition(3)
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    got = sorted((tuple(r) for r in urlfilter.judge(df, rules).collect()), key=str)
    assert got == sorted(((k, *brute(u)) for k, u in rows), key=str)
    assert urlfilter.judge(df.limit(0), rules).collect() == []
    assert {r.verdict for r in urlfilter.judge(df, rules.limit(0)).collect()} == {"allow"}
