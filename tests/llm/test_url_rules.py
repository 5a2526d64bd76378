import re

from helpers import nothing

from tidemark.llm.url_rules import BASE_RULES, PRODUCTION, Rule, host_path_rules, index_of, judged, listed_rules, rule_table

URLS = [
    None, "", "no scheme", "http://", "https://Example.COM/en/a?x#y", "http://www.example.com/en/", "http://WWW.example.com/EN/",
    "http://a.b.example.com/en/x", "http://notexample.com/en/x", "http://example.com", "http://example.com?/en/", "x://y.net/fr/1",
    "https://y.net/es", "https://net/es/", "http://blog.cheap-pills.example.org/de/1", "http://cheap.example.net/pills",
    "ftp://a.net/de/online-casino/", "http://a.org/x#://b.com/", "http://a.org/free-downloads", "http://É.com/é", "http://a.org/PHPSESSID=1",
    "http://a.org/phpsessid=1", "http://user@host.com:80/p", "http://a.com\n/b", "http://xxx.a.org/",
]


def plain(url):
    """Host, path, rule, verdict by trying every rule."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url[url.index("://") + 3 :]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, h, p in (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")):
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), h + p, verdict))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    spam = [r for r in PRODUCTION if not r.length and re.search(r.pattern, host + path)]
    return host, path, None, "block" if spam else "allow"


def test_equals_trying_every_rule(spark):
    pages = spark.createDataFrame([(k, u, "own") for k, u in enumerate(URLS)], "page_id bigint, url string, host string")
    rows = judged(pages).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == plain(URLS[r.page_id]), URLS[r.page_id]
    assert {r.verdict for r in rows} == {"allow", "block"}


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = rule_table(spark, (Rule("a", "block", "x", ("com", "pills")), Rule("b", "block", "y", ()), Rule("c", "block", "z", ("new", "com"))))
    tokens = spark.createDataFrame([(k, "com") for k in range(9)] + [(1, "pills"), (2, "other")], "seq long, token string")
    assert sorted((r.name, r.token) for r in index_of(rules, tokens).collect()) == [("a", "pills"), ("b", ""), ("c", "new")]
    # Tokens of host and path rules are whole tokens of every URL that fits.
    assert [r.tokens for r in BASE_RULES[:2]] == [("com",), ("example", "com", "en")]
    assert all(r.tokens for r in PRODUCTION)


def test_rules_of_a_table_equal_those_written_here(spark):
    listed = [("allow", "com", "/"), ("block", "Example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
    dropped = [(None, "a.org", "/"), ("block", None, "/"), ("block", "", "/x")]
    table = host_path_rules(spark.createDataFrame(listed + dropped, "verdict string, host string, path string"))
    assert sorted((r.name, r.verdict, r.pattern, tuple(r.tokens), r.length) for r in table.collect()) == sorted(
        (r.name, r.verdict, r.pattern, r.tokens, r.length) for r in BASE_RULES
    )


def test_many_listed_rules(spark, tmp_path):
    """100,000 rules of a text file; the verdicts are those of a lookup of all hosts and prefixes."""
    rules = {f"site{k}.host{k % 997}.com": ("block" if k % 3 else "allow", "" if k % 2 else "/a+b/") for k in range(100_000)}
    lines = ["# list", "no rule at all", "block", ""] + [f"{v} {h}{p}" for h, (v, p) in rules.items()]
    (tmp_path / "list.txt").write_text("\n".join(lines))
    urls = [
        (k, f"http://{sub}site{k}.host{(k + off) % 997}.com{tail}")
        for k in range(0, 100_000, 331) for sub in ("", "www.", "x") for off in (0, 1) for tail in ("/a+b/c", "/aab/", "", "?q", "x/a+b/")
    ]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    found = {r.url: (r.rule, r.verdict) for r in judged(pages, listed_rules(spark, str(tmp_path))).collect()}
    for _, url in urls:
        host, slash, path = url[7:].partition("?")[0].partition("/")
        want = (None, "allow")
        for name in (host, host.partition(".")[2]):
            verdict, prefix = rules.get(name, (None, ""))
            if verdict and (slash + path).startswith(prefix):
                want = (name + prefix, verdict)
        assert found[url] == want, url


def test_very_long_urls_and_no_rules(spark):
    tail = "/a-b" * 100_000
    pages = spark.createDataFrame([(1, "http://www.example.com/en" + tail), (2, "http://" + "a." * 50_000 + "net/es/"), (3, "http://" + "x" * 200_000)], "page_id long, url string")
    assert [r.verdict for r in judged(pages).orderBy("page_id").collect()] == ["allow", "block", "allow"]
    assert {r.verdict for r in judged(pages, ()).collect()} == {"allow"}


def test_empty_and_repeated_rows(spark):
    assert judged(nothing(spark, "page_id bigint, url string")).count() == 0
    twice = spark.createDataFrame([(None, "http://a.net/es/"), (None, "http://a.net/es/"), (1, None)], "page_id bigint, url string")
    assert sorted(r.verdict for r in judged(twice).collect()) == ["allow", "block", "block"]
