import random

from pyspark.sql import functions as F

from annolytics.llm import url_filter as U


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    cut = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:cut]


def brute(url, rules, default="allow"):
    host, path = split(url)
    fit = [r for r in rules if host and (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    if not fit:
        return host, path, None, default
    v, h, p = max(fit, key=lambda r: (len(r[1] + r[2]), len(r[1])))
    return host, path, h + p, v


def check(spark, urls, rules, **kw):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, verdict string, host string")
    got = {r["page_id"]: r for r in U.judge_urls(df, U.rules_frame(spark, rules), **kw).collect()}
    for i, u in enumerate(urls):
        r = got[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(u, rules), u


def test_against_brute_force(spark):
    rnd = random.Random(3)
    labels = ["a", "b", "a-b", "ab", "com", "org", "x1"]
    hosts = [".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4))) for _ in range(150)]
    rules = list({(h, p): (rnd.choice(["allow", "block"]), h, p) for h, p in ((rnd.choice(hosts), rnd.choice(["/", "/a", "/a/b", ""])) for _ in range(40))}.values())
    urls = [f"http://{rnd.choice(hosts).upper()}{rnd.choice(['', '/', '/a', '/a/b/c?x=/a', '#/a', '?q'])}" for _ in range(300)]
    check(spark, urls, rules, slices=8)


def test_odd_urls(spark):
    rules = [("block", "a.com", "/"), ("allow", "com", "/x")]
    check(spark, [None, "", "a.com/", "://", "http://", "http://a.com", "http://a.com:80/", "ftp://b://a.com/", "http://.a.com/", "http://xa.com/x", "HTTP://A.COM/X#://", "http://é.com/x"], rules)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(empty, U.rules_frame(spark, [("block", "a", "/")])).count() == 0
    none = U.rules_frame(spark, [("block", "a", "/")]).filter("false")
    got = U.judge_urls(spark.createDataFrame([(1, "http://a/")], "page_id long, url string"), none).first()
    assert got["rule"] is None and got["verdict"] == "allow"


def test_repeated_rows_keep_their_number(spark):
    df = spark.createDataFrame([(1, "http://a/")] * 3, "page_id long, url string")
    rows = U.judge_urls(df, U.rules_frame(spark, [("allow", "a", "/"), ("block", "a", "/")])).collect()
    assert [r["verdict"] for r in rows] == ["block"] * 3


def test_many_path_rules_on_one_host_stay_few_rows(spark, monkeypatch):
    written = {}
    original = U.materialize

    def counted(df, name):
        out = original(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(U, "materialize", counted)
    rules = [("block" if i % 3 else "allow", "com", f"/p{i}/") for i in range(3000)] + [("allow", "h7.com", "/p7"), ("block", "com", "/")]
    urls = [f"http://h{i}.com/p{i * 7 % 3100}/x?y" for i in range(2000)]
    check(spark, urls, rules)
    assert max(written.values()) <= len(rules) + 2 * len(urls)
    cells = U.sweep(spark.createDataFrame([(f"com.h{i}.",) for i in range(2000)], "key string"), U.rules_frame(spark, rules[:50]).select(U.host_key(F.col("host")).alias("key")))
    assert max(len(r["stack"]) for r in cells.collect()) == 1


def test_nested_paths(spark):
    rules = [("block", "com", "/a"), ("allow", "com", "/a/b"), ("block", "com", "/a/b/c"), ("allow", "x.com", "/a/"), ("block", "com", "/a/b/d/e"), ("block", "com", "")]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a/b/", "/a/b/c", "/a/b/cc/", "/a/b/d", "/a/b/d/e/f", "/a/c", "/ab", "/b", "/a/é", "/a\n/b"]
    check(spark, [f"http://{h}{p}" for h in ("com", "x.com", "y.x.com", "org") for p in paths], rules, slices=4)
