import random

from pyspark.sql import functions as F

from annolytics.llm import warc_revisits as W

SCHEMA = "record_id long, uri string, time long, record_type string, http_status int, headers map<string,string>, payload_digest string, status string, url string, slice int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def resolve(spark, rows, **kw):
    return {r["record_id"]: r for r in W.resolve_revisits(frame(spark, rows), **kw).collect()}


def test_canonical_url(spark):
    cases = {
        "HTTP://WWW.A.com:80/x/?b=2&a=1&utm_source=q#f": "a.com/x?a=1&b=2",
        "https://a.com": "a.com",
        "https://a.com/": "a.com",
        "https://a.com/X?": "a.com/X",
        "a.com/x//": "a.com/x",
        "http://a.com:8080/?gclid=1": "a.com:8080",
        "": "",
    }
    got = spark.createDataFrame([(u,) for u in cases], "u string").select("u", W.canonical_url(F.col("u")).alias("c")).collect()
    assert {r["u"]: r["c"] for r in got} == cases


def test_headers_and_validators(spark):
    full = {"ETag": '"1"', "Content-Length": "9", "X": "old", "Y": "keep", "Last-Modified": "d"}
    rows = [
        (1, "http://a/", 10, "response", 200, full, "D"),
        (2, "http://A", 20, "revisit", 304, {"etag": 'W/"1"', "content-length": "0", "x": "new", "Connection": "close"}, None),
        (3, "http://a", 20, "revisit", 304, {"ETag": '"2"'}, None),
        (4, "http://a", 20, "revisit", 304, {"last-modified": "d"}, None),
        (5, "http://a", 20, "revisit", 304, None, None),
        (6, "http://a", 10, "revisit", 304, {"etag": '"1"'}, None),
        (7, None, 20, "revisit", 304, {}, None),
        (8, "http://a", None, "revisit", 304, {}, None),
        (9, "http://b", 5, "response", 404, {}, None),
        (10, "http://b", 6, "revisit", 304, {}, None),
        (11, "http://a", 9, "request", None, {}, None),
    ]
    got = resolve(spark, rows)
    assert {k: r["status"] for k, r in got.items()} == {
        2: "resolved", 3: "validator_mismatch", 4: "resolved", 5: "validator_mismatch", 6: "no_earlier", 7: "no_earlier", 8: "no_earlier", 10: "no_earlier",
    }
    assert got[2]["headers"] == {"etag": 'W/"1"', "content-length": "9", "x": "new", "y": "keep", "last-modified": "d"}
    assert got[2]["payload_digest"] == "D" and got[2]["source_id"] == 1 and got[3]["headers"] is None


def test_against_brute_force_with_a_hot_url(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(1500):
        url = "http://hot/" if rnd.random() < 0.5 else f"http://h{rnd.randint(0, 30)}/"
        tag = {"etag": f'"{rnd.randint(0, 2)}"'}
        if rnd.random() < 0.4:
            rows.append((i, url, rnd.randint(0, 300), "response", 200, tag, f"d{i}"))
        else:
            rows.append((i, url, rnd.randint(0, 300), "revisit", 304, tag, None))
    got = resolve(spark, rows, slices=16)
    for i, url, t, kind, _, tag, _ in rows:
        if kind == "revisit":
            before = [r for r in rows if r[3] == "response" and r[1] == url and r[2] < t]
            want = max(before, key=lambda r: (r[2], r[0])) if before else None
            status = "no_earlier" if not want else "resolved" if want[5] == tag else "validator_mismatch"
            assert got[i]["status"] == status and got[i]["source_id"] == (want[0] if status == "resolved" else None)


def test_repeats_and_empty(spark):
    rows = [(1, "http://a", 1, "response", 200, {}, "D"), (2, "http://a", 2, "revisit", 304, {}, None), (2, "http://a", 2, "revisit", 304, {}, None)]
    out = W.resolve_revisits(frame(spark, rows)).collect()
    assert [(r["record_id"], r["status"]) for r in out] == [(2, "resolved")] * 2
    assert W.resolve_revisits(frame(spark, [])).count() == 0
