import random

from oracle import compare, connect

from provenlake.llm import op5_warc_revisits as op
from provenlake.llm import registry

SCHEMA = "record_id long, warc_type string, url string, ts long, status int, headers map<string,string>, kind string, found int"


def test_query_equals_its_sql(spark):
    for sf in ("0.001", "0.01"):
        rows, problems = compare(spark, connect(sf), "op5", registry.QUERIES["op5_warc_revisits"], registry.ORACLES["op5_warc_revisits"], sf)
        assert rows > 0 and problems == []


def brute(records):
    out = {}
    for rid, kind, url, ts, _, headers, *_ in records:
        if kind != "revisit":
            continue
        before = [r for r in records if r[1] == "response" and r[4] == 200 and r[2] == url and r[3] is not None and ts is not None and r[3] < ts]
        if url is None or ts is None:
            out[rid] = ("no_url" if url is None else "no_time", None)
        elif not before:
            out[rid] = ("no_response", None)
        else:
            r = max(before, key=lambda r: (r[3], r[0]))
            a, b = (headers or {}).get("ETag"), (r[5] or {}).get("ETag")
            out[rid] = ("no_validator", None) if a is None or b is None else ("resolved", r[0]) if a == b else ("changed", None)
    return out


def test_a_hot_url_over_many_ranges(spark):
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        url = "http://hot.example/a" if rng.random() < 0.7 else rng.choice(["http://x.example/b", "http://y.example/c", None])
        tag = rng.choice(['"1"', '"1"', '"1"', '"2"', None])
        ts = None if rng.random() < 0.02 else rng.randrange(900)
        rows.append((i, "response" if rng.random() < 0.1 else "revisit", url, ts, rng.choice([200, 200, 206]), {"ETag": tag} if tag else None, "k", 1))
    got = {r.record_id: (r.state, r.refers_to) for r in op.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


def test_headers_and_validators(spark):
    full = {"ETag": '"a"', "Last-Modified": "mon", "Content-Length": "9", "X-Own": "1", "x-own": "2", "Date": "d1"}
    rows = [
        (1, "response", "http://WWW.Example.com:80/p/?b=2&utm_source=x&a=1#top", 10, 200, full, None, None),
        (2, "revisit", "https://example.com/p?a=1&b=2", 11, 304, {"etag": 'W/"a"', "Date": "d2", "Content-Length": "0", "Vary": "v"}, None, None),
        (3, "revisit", "https://example.com/p?a=1&b=2", 12, 304, {"last-modified": "tue"}, None, None),
        (4, "revisit", "https://example.com/p?a=1&b=2", 10, 304, {"etag": '"a"'}, None, None),
        (5, "revisit", "https://example.com/P?a=1&b=2", 12, 304, {}, None, None),
        (6, "revisit", "https://example.com/p?a=1&b=2", 13, 304, None, None, None),
    ]
    got = {r.record_id: r for r in op.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {k: r.state for k, r in got.items()} == {2: "resolved", 3: "changed", 4: "no_response", 5: "no_response", 6: "no_validator"}
    assert got[2].headers == {"etag": 'W/"a"', "last-modified": "mon", "content-length": "9", "x-own": "1", "date": "d2", "vary": "v"}
    assert got[2].refers_to == 1 and got[3].refers_to is None
    assert op.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0
